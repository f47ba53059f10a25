"""Packing token sequences: bins of minimum slack, planned on the lengths and carried out on the rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parley.llm.common import Scratch, chunks, to_arrow, utf8
from parley.llm.word_tokens import load

CAPACITY = 4096
END = 1


def with_pieces(docs: DataFrame, path: str, text: str = "text", capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """A row per piece of each document: its columns and piece, start, length, ids (packed) and shard, rank.

    A document is the ids of its whole text and the id ``end``; a null text
    counts as empty, so every document has a piece. Longer documents are cut
    every ``capacity`` ids. ``shard`` is the task that made the piece, ``rank``
    counts its pieces of that length. Columns of ``docs`` with these names are replaced.
    """
    added = [
        T.StructField("piece", T.IntegerType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids", T.BinaryType()),
        T.StructField("shard", T.IntegerType()),
        T.StructField("rank", T.LongType()),
    ]
    names = {f.name for f in added}
    kept = docs.select(*[c for c in docs.columns if c not in names], utf8(F.col(text)).alias("__source"))
    passed = kept.drop("__source", *([text] if text not in names else [])).schema.fields
    schema = T.StructType([*passed, *added])
    last, own = len(kept.columns) - 1, [i for i, c in enumerate(kept.columns) if c in {f.name for f in passed}]
    types = [to_arrow(f.dataType) for f in added]
    width = 4 * capacity

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        tail = np.array([end], "<u4").tobytes()
        for batch in batches:
            for part in chunks(batch, last):
                rows, made = [], []
                for i, ids in enumerate(load(path).encode(part.column(last).to_pylist())):
                    ids += tail
                    for n, at in enumerate(range(0, len(ids), width)):
                        piece = ids[at : at + width]
                        length = len(piece) // 4
                        rows.append(i)
                        made.append((n, at // 4, length, piece, shard, seen[length]))
                        seen[length] += 1
                columns = [part.column(i).take(pa.array(rows, pa.int64())) for i in own]
                columns += [pa.array(x, t) for x, t in zip(zip(*made), types)]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return kept.mapInArrow(run, schema)


# -- the plan ------------------------------------------------------------------


def fullest(room: int, lengths: list[int], counts: list[int]) -> dict[int, int]:
    """How many of each length (longest first) fill ``room`` as far as any combination does.

    Bit s of ``sums`` tells whether the lengths so far can make s; a length
    that may be used several times is taken in powers of two. The search ends
    early when the room is filled exactly.
    """
    mask, full = (1 << (room + 1)) - 1, 1 << room
    sums, steps = 1, []
    for length, count in zip(lengths, counts):
        if length > room:
            continue
        left, size = min(count, room // length), 1
        while left and not sums & full:
            take = min(size, left)
            steps.append((length, take, sums))
            sums |= (sums << (length * take)) & mask
            left -= take
            size *= 2
        if sums & full:
            break
    at = sums.bit_length() - 1
    used: dict[int, int] = {}
    for length, take, before in reversed(steps):
        if not before >> at & 1:
            at -= length * take
            used[length] = used.get(length, 0) + take
    return used


def plan_bins(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[dict[int, int], int]]:
    """Bins as (how many of each length, how many such bins).

    Each bin takes the longest length left and the combination of the others
    that fills it best; it is repeated as long as its lengths last. Work and
    result depend on the number of lengths, at most ``capacity``, not on how
    many rows there are.
    """
    left = dict(sorted(((n, c) for n, c in histogram.items() if c), reverse=True))
    bins = []
    while left:
        longest = next(iter(left))
        rest = dict(left)
        rest[longest] -= 1
        order = [n for n in rest if rest[n]]
        used = fullest(capacity - longest, order, [rest[n] for n in order])
        used[longest] = used.get(longest, 0) + 1
        times = min(left[n] // k for n, k in used.items())
        for n, k in used.items():
            left[n] -= times * k
            if not left[n]:
                del left[n]
        bins.append((used, times))
    return bins


def slots(bins: list[tuple[dict[int, int], int]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, ranks, per bin, first sequence, offset) for each length of each kind of bin."""
    out, next_rank, sequence = [], {}, 0
    for used, times in bins:
        offset = 0
        for length in sorted(used, reverse=True):
            first = next_rank.get(length, 0)
            out.append((length, first, times * used[length], used[length], sequence, offset))
            next_rank[length] = first + times * used[length]
            offset += length * used[length]
        sequence += times
    return out


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` with sequence_id and offset, in as few sequences as the method finds.

    ``pieces`` is a written table with length (1 to ``capacity``), shard and
    rank, as ``with_pieces`` gives it. Only the counts of the lengths go through
    the plan; rows find their place by arithmetic on their global rank within
    their length. No group of equal lengths is gathered. An empty table gives
    an empty result.
    """
    spark = pieces.sparkSession
    per_shard = pieces.groupBy("length", "shard").agg(F.count("*").alias("n"))
    # At most ``capacity`` rows.
    counts = {r["length"]: r["n"] for r in per_shard.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    places: dict[int, list] = {}
    for length, first, ranks, each, sequence, offset in slots(plan_bins(counts, capacity)):
        places.setdefault(length, []).append((first, ranks, each, sequence, offset))
    arrays = {n: np.array(rows, np.int64).T for n, rows in places.items()}
    sent = spark.sparkContext.broadcast(arrays)
    # One row per shard and length in a window over the shards.
    before = F.expr(
        "coalesce(sum(n) over (partition by length order by shard rows between unbounded preceding and 1 preceding), 0)"
    )
    ahead = per_shard.select("length", "shard", before.cast("long").alias("__before"))
    ranked = pieces.join(ahead, ["length", "shard"])
    names = [c for c in pieces.columns if c not in ("shard", "rank", "sequence_id", "offset")]
    kept = ranked.select(*names, F.col("length").alias("__length"), (F.col("rank") + F.col("__before")).alias("__rank"))
    fields = [T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]
    schema = T.StructType([*kept.drop("__length", "__rank").schema.fields, *fields])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, ranks = (batch.column(i).to_numpy(zero_copy_only=False) for i in (-2 + batch.num_columns, -1 + batch.num_columns))
            sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
            order = np.argsort(lengths, kind="stable")
            values, starts = np.unique(lengths[order], return_index=True)
            for length, rows in zip(values.tolist(), np.split(order, starts[1:])):
                first, _, each, begins, at = sent.value[length]
                k = np.searchsorted(first, ranks[rows], side="right") - 1
                within = ranks[rows] - first[k]
                sequence[rows] = begins[k] + within // each[k]
                offset[rows] = at[k] + within % each[k] * length
            columns = [*batch.columns[:-2], pa.array(sequence), pa.array(offset)]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return kept.mapInArrow(place, schema)


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids, doc_ids, starts, lengths) with each sequence's ids joined; ``packed`` still has its ids.

    A sequence holds at most the capacity, so each group is small.
    """
    part = F.struct("offset", "ids", "doc_id", "start", "length")
    grouped = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(part)).alias("p"))
    joined = F.aggregate("p", F.lit(b"").cast("binary"), lambda a, x: F.concat(a, x["ids"]))
    return grouped.select(
        "sequence_id",
        joined.alias("ids"),
        F.col("p.doc_id").alias("doc_ids"),
        F.col("p.start").alias("starts"),
        F.col("p.length").alias("lengths"),
    )


def pack_documents(docs: DataFrame, path: str, text: str = "text", carried: dict | None = None) -> DataFrame:
    """Pieces of all documents with sequence_id and offset, and columns ``carried`` made from the ids.

    The pieces are written once; the ids themselves are left there unless
    ``carried`` names them.
    """
    scratch = Scratch(docs.sparkSession, "pieces")
    pieces = with_pieces(docs, path, text)
    made = {"ids": F.col("ids")} if carried is None else carried
    names = [c for c in pieces.columns if c != "ids" and c not in made]
    return pack(scratch.write(pieces.select(*names, *[c.alias(n) for n, c in made.items()])))
