"""Ranked search, term at a time with a limit on accumulators, over shards of the documents."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parley.llm.common import Scratch, chunks, utf8

TOP = 50
# Bytes of query text whose terms are sent to the workers at once; more queries go in further blocks.
BLOCK_BYTES = 4 << 20
# Postings a worker searches at once. Any number gives the same ranking; more of them stop accumulators earlier.
SHARD_POSTINGS = 2 << 20
# Ranked rows of a query pass through this many groups before the last one.
GROUPS = 64

# Bytes as they count in terms: letters and digits, A-Z lower-cased, and all beyond ASCII; anything else parts terms.
_BYTES = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256)
)


def terms_of(text: bytes) -> list[bytes]:
    """The terms of a text in UTF-8, in order and with repeats."""
    return text.translate(_BYTES).split()


def with_postings(docs: DataFrame, numbers: dict[bytes, int], doc_id: str, text: str) -> DataFrame:
    """(doc_id, n, terms, counts) of each document with at least one term.

    ``n`` counts its terms with repeats; ``terms`` holds the numbers of those
    in ``numbers``, ``counts`` how often each occurs.
    """
    schema = T.StructType(
        [
            T.StructField("doc_id", T.LongType()),
            T.StructField("n", T.LongType()),
            T.StructField("terms", T.ArrayType(T.IntegerType())),
            T.StructField("counts", T.ArrayType(T.IntegerType())),
        ]
    )
    sent = docs.sparkSession.sparkContext.broadcast(numbers)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        for batch in batches:
            for part in chunks(batch, 1):
                rows, sizes, starts, terms, counts = [], [], [0], [], []
                for i, body in enumerate(part.column(1).to_pylist()):
                    words = terms_of(body)
                    if not words:
                        continue
                    found = Counter(map(known.get, words))
                    found.pop(None, None)
                    rows.append(i)
                    sizes.append(len(words))
                    terms += found.keys()
                    counts += found.values()
                    starts.append(len(terms))
                at = pa.array(starts, pa.int32())
                lists = [pa.ListArray.from_arrays(at, pa.array(x, pa.int32())) for x in (terms, counts)]
                columns = [part.column(0).take(pa.array(rows, pa.int64())), pa.array(sizes, pa.int64()), *lists]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), utf8(F.col(text)).alias("body")).mapInArrow(run, schema)


class Shard:
    """Documents and their postings by term, with the part of the score that no query changes."""

    def __init__(self, n: np.ndarray, sizes: np.ndarray, terms: np.ndarray, counts: np.ndarray, documents: int, length: int):
        doc = np.repeat(np.arange(len(n)), sizes)
        m = 50 + 50 * n.astype(np.int64) * documents // length
        tf = counts.astype(np.int64)
        impact = 1_000_000_000 * tf // (1000 * tf + 20 * m[doc])
        order = np.argsort(terms, kind="stable")
        kinds, starts = np.unique(terms[order], return_index=True)
        self.span = dict(zip(kinds.tolist(), zip(starts.tolist(), [*starts[1:].tolist(), len(terms)])))
        self.doc, self.impact = doc[order], impact[order]
        self.highest = dict(zip(kinds.tolist(), np.maximum.reduceat(self.impact, starts).tolist() if len(terms) else []))
        self.score = np.zeros(len(n), np.int64)
        self.has = np.zeros(len(n), bool)

    def search(self, query: list[int], weight: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents and scores that hold all of the ``k`` best, ties included.

        The rarest term goes first. Once all terms left together cannot lift a
        new document to the kth score so far, no accumulator is made any more,
        and those that cannot reach it either are let go; the others get every
        further term. A bound equal to that score still counts, as ids break ties.
        """
        terms = sorted((t for t in query if t in self.span and weight[t] > 0), key=lambda t: (-weight[t], t))
        bounds = [int(weight[t]) * self.highest[t] for t in terms]
        left = [sum(bounds[i:]) for i in range(len(bounds) + 1)]
        score, has, made, open_, kth = self.score, self.has, [], True, 0
        alive = np.empty(0, np.int64)
        for i, t in enumerate(terms):
            if open_ and sum(map(len, made)) >= k:
                alive = np.concatenate(made)
                kth = kth_largest(score[alive], k)
                open_, made = left[i] >= kth, [alive]
            lo, hi = self.span[t]
            docs, gain = self.doc[lo:hi], int(weight[t]) * self.impact[lo:hi]
            if open_:
                score[docs] += gain
                new = docs[~has[docs]]
                has[new] = True
                made.append(new)
            else:
                kth = max(kth, kth_largest(score[alive], k))
                alive = alive[score[alive] + left[i] >= kth]
                at = np.searchsorted(docs, alive)
                at[at == len(docs)] = 0
                hit = docs[at] == alive
                score[alive[hit]] += gain[at[hit]]
        touched = np.concatenate(made) if made else alive
        if open_:
            alive = touched
        alive = alive[score[alive] > 0]
        if len(alive) > k:
            alive = alive[score[alive] >= kth_largest(score[alive], k)]
        out = score[alive].copy()
        score[touched], has[touched] = 0, False
        return alive, out


def kth_largest(values: np.ndarray, k: int) -> int:
    return int(np.partition(values, len(values) - k)[len(values) - k]) if len(values) >= k else 0


def best_rows(score: np.ndarray, ids: np.ndarray, missing: np.ndarray, k: int) -> np.ndarray:
    """The first ``k`` by falling score, then by rising id; rows without an id come last among equals."""
    return np.lexsort((ids, missing, -score))[:k]


def term_weight(documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


def _search_block(docs: DataFrame, items: list, doc_id: str, text: str, k: int, scratch: Scratch) -> DataFrame | None:
    """The best rows of each shard for a block of queries (number, item_id, terms)."""
    spark = docs.sparkSession
    numbers = {t: i for i, t in enumerate(sorted(set().union(*(terms for _, _, terms in items))))}
    postings = scratch.write(with_postings(docs, numbers, doc_id, text))
    documents, length = postings.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    if not documents:
        return None
    # One row per term of the block.
    counted = postings.select(F.explode("terms").alias("t")).groupBy("t").count().collect()
    weight = np.zeros(len(numbers), np.int64)
    for r in counted:
        weight[r["t"]] = term_weight(documents, r["count"])
    queries = [(number, item, sorted(numbers[t] for t in terms)) for number, item, terms in items]
    sent = spark.sparkContext.broadcast((weight, queries))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += len(batch.column(2).flatten())
            if size >= SHARD_POSTINGS:
                yield best(held)
                held, size = [], 0
        if held:
            yield best(held)

    def best(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held).combine_chunks()
        lists = [table.column(c).combine_chunks() for c in ("terms", "counts")]
        ids = table.column("doc_id").combine_chunks()
        missing = ids.is_null().to_numpy(zero_copy_only=False)
        own = ids.fill_null(0).to_numpy()
        sizes = np.diff(lists[0].offsets.to_numpy())
        parts = [x.flatten().to_numpy() for x in lists]
        shard = Shard(table.column("n").to_numpy(), sizes, *parts, documents, length)
        weights, wanted = sent.value
        out: list[list] = [[], [], [], []]
        for number, item, query in wanted:
            found, score = shard.search(query, weights, k)
            top = best_rows(score, own[found], missing[found], k)
            for column, values in zip(
                out, ([number] * len(top), [item] * len(top), ids.take(pa.array(found[top])).to_pylist(), score[top].tolist())
            ):
                column += values
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], names=["number", "item_id", "doc_id", "score"])

    return postings.where(F.size("terms") > 0).mapInArrow(run, "number long, item_id long, doc_id long, score long")


def ranked_documents(
    docs: DataFrame,
    items: DataFrame,
    k: int = TOP,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents of each row of ``items``, equal scores by rising id.

    Terms are runs of ASCII letters and digits and of characters beyond ASCII,
    A-Z lower-cased. Null and empty texts have none; they neither find nor are
    found. Every row is a document or a query of its own, whether its id is
    null or repeats; documents without an id come last among equal scores. An
    empty table on either side gives an empty result; further columns are not read.

    Queries go in blocks of about ``block_bytes``. For each block the documents
    are read once, and the postings of its terms are written. Every task
    searches its own documents and passes on ``k`` rows a query.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "search")
    asked = scratch.write(
        items.select(F.col(item_id).cast("long").alias("item_id"), utf8(F.col(item_text)).alias("body"))
        .where(F.length("body") > 0)
        .withColumn("number", F.monotonically_increasing_id())
    )
    total = asked.agg(F.coalesce(F.sum(F.length("body")), F.lit(0))).first()[0]
    blocks = max(1, -(-total // block_bytes))
    result = None
    for block in range(blocks):
        rows = asked.where(F.pmod(F.xxhash64("number"), F.lit(blocks)) == block).collect()
        known = [(r["number"], r["item_id"], set(terms_of(r["body"]))) for r in rows]
        known = [q for q in known if q[2]]
        found = _search_block(docs, known, doc_id, text, k, scratch) if known else None
        if found is not None:
            result = found if result is None else result.unionByName(found)
    if result is None:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    grouped = result.withColumn("part", F.pmod(F.spark_partition_id(), F.lit(GROUPS)))
    first = Window.partitionBy("number", "part").orderBy(*order)
    last = Window.partitionBy("number").orderBy(*order)
    few = grouped.withColumn("r", F.row_number().over(first)).where(F.col("r") <= k).drop("r", "part")
    ranked = few.withColumn("rank", F.row_number().over(last)).where(F.col("rank") <= k)
    return ranked.select("item_id", "rank", "doc_id", "score")
