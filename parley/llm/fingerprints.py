"""Document fingerprints from closed syncmers, and how alike two documents are by them."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parley.llm.common import chunks, to_arrow, utf8, with_python_columns

# A k-mer has K bytes, its inner substrings S.
K, S = 56, 8
WINDOW = K - S + 1
# Texts of so many bytes hold a syncmer for certain.
CERTAIN = 2 * K - S - 1
BLOCK = 1 << 20
M1, M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def mixed(x: np.ndarray) -> np.ndarray:
    x = x * M1
    x ^= x >> np.uint64(29)
    x *= M2
    x ^= x >> np.uint64(32)
    return x


def anchors(text: bytes) -> np.ndarray:
    """The text's closed syncmers in order, each as 24 hash bits and 8 bits of distance from the one before.

    A k-mer is chosen if the smallest hash among its inner substrings is the
    first's or the last's, which depends on nothing outside the k-mer. Of K - S
    neighbouring k-mers one at least is chosen, so a distance fits into 8 bits.
    A text of fewer than 2 K - S - 1 bytes may hold no such k-mer; its k-mer of
    least hash is an anchor, too, which short texts that are near copies mostly
    share. A text shorter than a k-mer is one anchor, only an empty text has none.
    """
    n = len(text)
    if n == 0:
        return np.empty(0, np.uint32)
    if n < K:
        h = int.from_bytes(hashlib.blake2b(text, digest_size=3).digest(), "little")
        return np.array([h << 8], np.uint32)
    found = []
    if n < CERTAIN:
        raw = np.frombuffer(text, np.uint8)
        hashes = kmer_hashes(inner_words(raw), np.arange(n - K + 1))
        at = np.union1d(syncmers(raw)[0], hashes.argmin())
        found.append((at, (hashes[at] >> np.uint64(40)).astype(np.uint32)))
    for start in range(0, n - K + 1 if not found else 0, BLOCK):
        raw = np.frombuffer(text, np.uint8, min(BLOCK + K - 1, n - start), start)
        at, hashes = syncmers(raw)
        found.append((at + start, hashes))
    at, hashes = (np.concatenate(x) for x in zip(*found))
    gaps = np.diff(at, prepend=0).astype(np.uint32)
    return hashes << np.uint32(8) | gaps


def inner_words(raw: np.ndarray) -> np.ndarray:
    """The inner substrings as numbers, by place."""
    two = raw[:-1].astype(np.uint64) | raw[1:].astype(np.uint64) << np.uint64(8)
    four = two[:-2] | two[2:] << np.uint64(16)
    return four[:-4] | four[4:] << np.uint64(32)


def kmer_hashes(eight: np.ndarray, at: np.ndarray) -> np.ndarray:
    """64-bit hashes of the k-mers that begin ``at`` these places."""
    whole = np.zeros(len(at), np.uint64)
    for part in range(0, K, 8):
        whole = mixed(whole ^ eight[at + part])
    return whole


def syncmers(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and 24-bit hashes of the closed syncmers that begin in ``raw``."""
    eight = inner_words(raw)
    h = mixed(eight)
    least, width = h, 1
    while width * 2 <= WINDOW:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < WINDOW:
        least = np.minimum(least[: len(least) - (WINDOW - width)], least[WINDOW - width :])
    at = np.flatnonzero((h[: len(least)] == least) | (h[WINDOW - 1 :] == least))
    return at, (kmer_hashes(eight, at) >> np.uint64(40)).astype(np.uint32)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of the anchors of both texts that match in place: matched / all, from 0 to 1.

    The n-th occurrence of a hash in one text is paired with the n-th in the
    other. A pair counts if another pair stands the same distance apart, as
    within a shared passage, or if one of the texts has a single anchor. Two
    texts without anchors are alike.
    """
    if len(a) == 0 or len(b) == 0:
        return float(len(a) == len(b))
    if np.array_equal(a, b):
        return 1.0
    at_a, at_b = (np.cumsum(x & np.uint32(255), dtype=np.int64) for x in (a, b))
    key_a, order_a = occurrences(a >> np.uint32(8))
    key_b, order_b = occurrences(b >> np.uint32(8))
    shared, i, j = np.intersect1d(key_a, key_b, assume_unique=True, return_indices=True)
    if not len(shared):
        return 0.0
    apart = at_a[order_a[i]] - at_b[order_b[j]]
    _, line, support = np.unique(apart, return_inverse=True, return_counts=True)
    matched = len(shared) if min(len(a), len(b)) == 1 else int((support[line] > 1).sum())
    return matched / (len(a) + len(b) - matched)


def occurrences(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted keys that tell apart the occurrences of each hash, and the places they come from."""
    order = np.argsort(hashes, kind="stable")
    ranked = hashes[order].astype(np.int64)
    first = np.r_[True, ranked[1:] != ranked[:-1]]
    start = np.maximum.accumulate(np.where(first, np.arange(len(ranked)), 0))
    return ranked << 32 | (np.arange(len(ranked)) - start), order


def with_fingerprints(docs: DataFrame, text: str = "text", out: str = "fingerprint") -> DataFrame:
    """``docs`` with each whole text's anchors, packed as little-endian unsigned 32-bit integers."""
    return with_python_columns(
        docs, utf8(F.col(text)), [T.StructField(out, T.BinaryType())], lambda: lambda x: [[pack(anchors(t)) for t in x]]
    )


def pack(a: np.ndarray) -> bytes:
    return a.astype("<u4").tobytes()


def unpack(a: bytes) -> np.ndarray:
    return np.frombuffer(a, "<u4")


# -- a document beside the next one --------------------------------------------

# A range of documents, read by one task as a stream, has about so many bytes; there are at most so many ranges.
RANGE_BYTES, RANGES = 16 << 20, 4096
PAIR = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("n_chars", T.LongType()),
        T.StructField("edited", T.StringType()),
        T.StructField("fingerprint", T.BinaryType()),
        T.StructField("edited_fingerprint", T.BinaryType()),
        T.StructField("near_edited", T.DoubleType()),
        T.StructField("near_next", T.DoubleType()),
    ]
)


def code_points(text: bytes) -> np.ndarray:
    """The bytes where the text's code points begin."""
    return np.flatnonzero((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)


def head(text: bytes, begins: np.ndarray, chars: int) -> bytes:
    return text[: int(begins[chars])] if chars < len(begins) else text


class Document:
    def __init__(self, doc_id, text: bytes, guest: bool):
        self.doc_id, self.text, self.guest = doc_id, text, guest
        self.begins, self.anchors = code_points(text), anchors(text)

    def beside(self, following: Document) -> tuple:
        n = len(self.begins)
        text = head(self.text, self.begins, n - n // 2) + head(following.text, following.begins, n // 2)
        own, other = self.anchors, anchors(text)
        near = likeness(own, other), likeness(own, following.anchors)
        return (self.doc_id, n, text.decode(), pack(own), pack(other), *near)


def neighbours(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Each document's fingerprint beside those of its edited text and of the next document.

    In the edited text the last floor(n/2) code points are replaced by the first
    as many (or all) of the next document. That is the one before it by id,
    for the smallest id the largest; null ids come after all others, rows of
    equal id in the order of their texts' MD5. A single document is its own
    next. Null and empty texts have no characters and no anchors. An empty
    table gives an empty result; further columns are not read.

    Rows are dealt into ranges of ids, each read in order as a stream that holds
    two documents. The first row of a range is also sent to the range before it.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), utf8(F.col(text)).alias("text"))
    grid = [i / RANGES for i in range(1, RANGES)]
    found = rows.agg(F.sum(F.octet_length("text") + 64), F.percentile_approx("doc_id", grid, 10 * RANGES)).first()
    n = min(RANGES, int(found[0] or 0) // RANGE_BYTES + 1)
    bounds = sorted({found[1][RANGES * i // n - 1] for i in range(1, n)}, reverse=True) if found[1] else []
    # Range 0 holds the ids above the first bound, and so on; null ids are in the last.
    if bounds:
        above = F.size(F.filter(F.lit(bounds), lambda b: b >= F.col("doc_id")))
        place = F.when(F.col("doc_id").isNull(), len(bounds)).otherwise(above)
    else:
        place = F.lit(0)
    rows = rows.withColumns({"range": place.cast("int"), "known": F.col("doc_id").isNotNull(), "digest": F.md5("text")})
    # One row per range.
    heads = rows.groupBy("range").agg(F.max(F.struct("known", "doc_id", "digest")).alias("h")).orderBy("range").collect()
    also = spark.createDataFrame(
        [(r["range"], r["h"]["doc_id"], r["h"]["digest"], heads[i - 1]["range"]) for i, r in enumerate(heads)],
        "r int, id long, md5 string, goes int",
    )
    same = (F.col("range") == F.col("r")) & F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("digest") == F.col("md5"))
    home = F.struct(F.col("range").alias("to"), F.lit(False).alias("guest"))
    visit = F.struct(F.col("goes").alias("to"), F.lit(True).alias("guest"))
    sent = rows.join(F.broadcast(also), same, "left").select(
        "doc_id",
        "known",
        "digest",
        "text",
        F.explode(F.when(F.col("goes").isNull(), F.array(home)).otherwise(F.array(home, visit))).alias("at"),
    )
    order = [F.col("at.to"), F.col("at.guest"), F.desc("known"), F.desc("doc_id"), F.desc("digest")]
    dealt = sent.repartition(max(1, len(heads)), "at.to").sortWithinPartitions(*order)
    dealt = dealt.select(F.col("at.to").alias("to"), F.col("at.guest").alias("guest"), "doc_id", "text")
    types = [to_arrow(f.dataType) for f in PAIR.fields]

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, at = None, None
        for batch in batches:
            for part in chunks(batch, 3):
                made = []
                for to, guest, number, body in zip(*(c.to_pylist() for c in part.columns)):
                    document = Document(number, body, guest)
                    if to == at and not held.guest:
                        made.append(held.beside(document))
                    held, at = document, to
                columns = zip(*made) if made else [[] for _ in types]
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, types)], names=PAIR.names)

    return dealt.mapInArrow(walk, PAIR)
