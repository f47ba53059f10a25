"""Exact global positions without moving all rows to one task."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parley.functions.keys import shuffle_key
from parley.session import cut_lineage

# A table of at most this many rows and stored bytes may be broadcast; compressed files grow a few times in memory.
BROADCAST_ROWS, BROADCAST_BYTES = 500_000, 16 << 20
# Parts a hot file is split into when its offset cannot be broadcast.
SALTS = 32
# Four hex digits of a digest: 65,536 even buckets whatever the data.
BUCKET_DIGITS = 4
AFTER_ALL_DIGESTS = "g"


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> tuple[DataFrame, bool]:
    """The table with a broadcast hint when it was counted and measured to be small, and whether it was.

    Pass a written table: the count runs at once, and its size is that of its files, as rows may hold long ids or names.
    """
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    small = size <= max_bytes and df.count() <= max_rows
    return (F.broadcast(df) if small else df), small


def _range_positions(df: DataFrame, *order: str, partitions: int | None = None) -> DataFrame:
    """Rows ranged and sorted, with ``_part`` and ``_pos`` inside it, materialised.

    Once written, the positions no longer depend on sampled range bounds, so a
    lost executor cannot change them between the two passes that use them.
    """
    # Without a number, adaptive execution may merge neighbouring small ranges.
    ranged = df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    row = F.monotonically_increasing_id()
    placed = ranged.sortWithinPartitions(*order).withColumn("_row", row)
    # The id holds the partition in its upper bits and the row in the lower 33.
    return cut_lineage(
        placed.select("*", F.shiftright("_row", 33).alias("_part"), F.col("_row").bitwiseAND((1 << 33) - 1).alias("_pos")).drop("_row")
    )


def _before(sizes: DataFrame, amount: str) -> DataFrame:
    """Running total before each partition; one row per partition, so one task is enough."""
    w = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select("_part", F.coalesce(F.sum(amount).over(w), F.lit(0)).alias("_before"))


def global_rank(
    df: DataFrame, *order: str, name: str = "rank", partitions: int | None = None, carry: tuple[str, ...] = ()
) -> DataFrame:
    """Order columns plus a dense rank position from 0. The order must be unique.

    Only the order columns, and narrow ones named in ``carry``, are shuffled: join them back where the rows are needed.
    """
    placed = _range_positions(df.select(*order, *carry), *order, partitions=partitions)
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    return placed.join(F.broadcast(_before(sizes, "_n")), "_part").select(
        *order, *carry, (F.col("_before") + F.col("_pos")).alias(name)
    )


def prefix_sum(df: DataFrame, order: str, amount: str, name: str, partitions: int | None = None) -> DataFrame:
    """``order, name``: total amount of all rows with a smaller order value."""
    placed = _range_positions(df.select(order, amount), order, partitions=partitions)
    totals = placed.groupBy("_part").agg(F.sum(amount).alias("_n"))
    inside = Window.partitionBy("_part").orderBy("_pos").rowsBetween(Window.unboundedPreceding, -1)
    return placed.join(F.broadcast(_before(totals, "_n")), "_part").select(
        order, (F.col("_before") + F.coalesce(F.sum(amount).over(inside), F.lit(0))).alias(name)
    )


def file_offsets(sizes: DataFrame, file: str, name: str = "_offset") -> DataFrame:
    """``file, name``: the records before each file in name order, from (file, n_records).

    One row per file is sorted; join it with the files before their records are exploded.
    """
    offsets = cut_lineage(prefix_sum(sizes.select(file, F.col("n_records").alias("_size")), file, "_size", name))
    return broadcast_if_small(offsets)[0]


def global_index(
    records: DataFrame, file: str, pos: str, name: str = "global_index", sizes: DataFrame | None = None
) -> DataFrame:
    """Running index over files in name order, then dense position inside the file.

    Only one row per file is sorted. Records meet the file offsets by broadcast
    when there are few files; otherwise by a join on file and salt, which spreads
    the records of a very large file. ``sizes`` (file, n_records) saves the
    counting pass where the scan knows the counts already.
    """
    if sizes is None:
        sizes = records.groupBy(file).agg(F.count(F.lit(1)).alias("n_records"))
    sizes = sizes.select(file, F.col("n_records").alias("_size"))
    offsets = cut_lineage(prefix_sum(sizes, file, "_size", "_offset"))
    offsets, small = broadcast_if_small(offsets)
    if small:
        joined = records.join(offsets, file)
    else:
        salted = offsets.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        salt = F.pmod(F.col(pos), F.lit(SALTS)).cast("int")
        joined = records.withColumn("_salt", salt).join(salted, [file, "_salt"]).drop("_salt")
    return joined.withColumn(name, F.col("_offset") + F.col(pos)).drop("_offset")


def _cut_digests(keyed: DataFrame, cuts: tuple[float, ...]) -> DataFrame:
    """One row: for each cut, the digest of the first row that lies beyond it.

    Digests are counted per bucket (a fixed number of buckets), which tells in
    which bucket each cut falls; only those buckets are then looked at in detail.
    """
    bucket = F.substring("_digest", 1, BUCKET_DIGITS)
    counts = keyed.groupBy(bucket.alias("_bucket")).agg(F.count(F.lit(1)).alias("_n"))
    upto = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    everything = Window.partitionBy()
    # Double product, then floor: the arithmetic that fixes the split sizes.
    wanted = F.explode(
        F.array(
            *[
                F.struct(F.lit(i).alias("cut"), F.floor(F.lit(float(c)) * F.col("_total").cast("double")).alias("at"))
                for i, c in enumerate(cuts)
            ]
        )
    )
    edges = (
        counts.select(
            "_bucket", "_n", F.sum("_n").over(upto).alias("_upto"), F.sum("_n").over(everything).alias("_total")
        )
        .select("_bucket", (F.col("_upto") - F.col("_n")).alias("_below"), "_upto", wanted.alias("w"))
        .filter((F.col("w.at") >= F.col("_below")) & (F.col("w.at") < F.col("_upto")))
        .select("_bucket", F.col("w.cut").alias("_cut"), (F.col("w.at") - F.col("_below")).alias("_skip"))
    )
    # At most one row per cut, so the broadcast has a fixed size.
    near = keyed.withColumn("_bucket", bucket).join(F.broadcast(edges), "_bucket")
    inside = Window.partitionBy("_cut").orderBy("_digest").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = (
        near.groupBy("_cut", "_skip", "_digest")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_upto", F.sum("_n").over(inside))
        .filter((F.col("_skip") >= F.col("_upto") - F.col("_n")) & (F.col("_skip") < F.col("_upto")))
    )
    return found.agg(
        F.struct(
            *[F.max(F.when(F.col("_cut") == i, F.col("_digest"))).alias(f"c{i}") for i in range(len(cuts))]
        ).alias("digests")
    )


def split_assign(
    df: DataFrame,
    *key: str,
    cuts: tuple[float, ...] = (0.70, 0.85),
    names: tuple[str, ...] = ("train", "val", "test"),
    seed: int = 42,
) -> DataFrame:
    """Adds ``shuffle_key`` and ``split``: exact proportional split in shuffled order.

    A row's split follows from comparing its digest with one digest per cut, so
    the rows themselves are neither sorted nor shuffled. The key should name a
    row; rows with the same key always share a split.
    """
    if len(names) != len(cuts) + 1:
        raise ValueError("one name more than cuts")
    digest = shuffle_key(*[F.col(k) for k in key], seed=seed)
    limits = _cut_digests(df.select(digest.alias("_digest")), cuts).scalar()

    # A cut at or after the last row finds no digest: then every row lies before it.
    def beyond(i: int) -> Column:
        return F.col("shuffle_key") >= F.coalesce(limits[f"c{i}"], F.lit(AFTER_ALL_DIGESTS))

    split = reduce(
        lambda chosen, i: F.when(beyond(i), F.lit(names[i + 1])).otherwise(chosen),
        range(len(cuts)),
        F.lit(names[0]),
    )
    return df.withColumn("shuffle_key", digest).withColumn("split", split)


def split_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("split").agg(F.count(F.lit(1)).alias("n"))
