"""Training arrays: collation into padded batches and packing into fixed lengths."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parley.functions.keys import shuffle_key
from parley.functions.tokens import prompt_mask, truncate
from parley.operators.ranks import global_rank
from parley.schemas import IGNORE_LABEL, MAX_SEQ_LENGTH
from parley.session import cut_lineage


def token_samples(df: DataFrame, ids: str = "full_ids", prompt_len: str = "prompt_len", max_len: int = MAX_SEQ_LENGTH) -> DataFrame:
    """Adds ``input_ids`` and ``labels``, both cut to ``max_len``."""
    return df.withColumns(
        {
            "input_ids": truncate(F.col(ids), max_len),
            "labels": prompt_mask(F.col(ids), F.col(prompt_len), max_len),
        }
    )


def collate_pad(samples: DataFrame, rank: str = "rank", batch_size: int = 2, pad_id: int = 0) -> DataFrame:
    """Pads samples to the longest of their batch; adds ``batch_id`` and ``attention_mask``.

    ``rank`` is a dense position from 0 (see ``global_rank``). Batch lengths come
    from ranks and sizes alone, so the arrays themselves move once, to the join.
    """
    batch = F.floor(F.col(rank) / batch_size).cast("bigint")
    longest = samples.groupBy(batch.alias("batch_id")).agg(F.max(F.size("input_ids")).alias("_len"))
    return _padded(samples.withColumn("batch_id", batch).join(longest, "batch_id"), pad_id)


def collate_in_order(samples: DataFrame, key: str, batch_size: int = 2, pad_id: int = 0) -> DataFrame:
    """``collate_pad`` of samples in the order of ``key``, which names a sample.

    The samples are written once. Ranks and the lengths of batches are found on
    keys and sizes only; then the arrays meet their batch in one join.
    """
    samples = cut_lineage(samples)
    ranked = global_rank(samples.select(key, F.size("input_ids").alias("_n")), key, carry=("_n",))
    batch = F.floor(F.col("rank") / batch_size).cast("bigint")
    longest = F.max("_n").over(Window.partitionBy("batch_id"))
    batches = ranked.withColumn("batch_id", batch).withColumn("_len", longest).drop("_n")
    return _padded(samples.join(batches, key), pad_id)


def _padded(samples: DataFrame, pad_id: int) -> DataFrame:
    size = F.size("input_ids")
    pad = F.col("_len") - size
    return (
        samples.withColumn("attention_mask", F.concat(F.array_repeat(F.lit(1), size), F.array_repeat(F.lit(0), pad)))
        .withColumn("labels", F.concat("labels", F.array_repeat(F.lit(IGNORE_LABEL), pad)))
        .withColumn("input_ids", F.concat("input_ids", F.array_repeat(F.lit(pad_id), pad)))
        .drop("_len")
    )


def pack_sequences(
    samples: DataFrame,
    key: str,
    ids: str = "input_ids",
    max_len: int = MAX_SEQ_LENGTH,
    shards: int = 64,
    seed: int = 42,
    digits: int = 2,
) -> DataFrame:
    """``shard, chunk, input_ids``: samples of a shard run together and cut every ``max_len``.

    The key names a sample. A shard is a hash class of it, so shards are even, and
    is cut by the leading ``digits`` of the digest into 16^digits groups in
    order. The samples are written once; the groups' token counts give each group its
    place in the shard, and samples are put in order inside a group only. A
    chunk that lies within a group is made there. Of each group at most the
    chunk it begins in and the one it ends in move again, to meet their other parts. The
    last chunk of a shard may be short.
    """
    digest = shuffle_key(F.col(key), seed=seed)
    shard = F.pmod(F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint"), F.lit(shards)).cast("int")
    rows = samples.select(F.col(key).alias("key"), F.col(ids).alias("ids"), F.size(ids).cast("bigint").alias("n"), digest.alias("digest"), shard.alias("shard"))
    rows = cut_lineage(rows.filter(F.col("n") > 0)).withColumn("part", F.substring("digest", 1, digits))
    # One row for each shard and group.
    earlier = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy("shard", "part").agg(F.sum("n").alias("n"))
    begins = totals.select("shard", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("begin"))
    inside = Window.partitionBy("shard", "part").orderBy("digest", "key").rowsBetween(Window.unboundedPreceding, -1)
    at = F.col("begin") + F.coalesce(F.sum("n").over(inside), F.lit(0))
    placed = rows.join(begins, ["shard", "part"]).withColumn("at", at)

    first = F.floor(F.col("at") / max_len).cast("bigint")
    last = F.floor((F.col("at") + F.col("n") - 1) / max_len).cast("bigint")
    start = F.greatest(F.col("chunk") * max_len - F.col("at"), F.lit(0))
    end = F.least((F.col("chunk") + 1) * max_len - F.col("at"), F.col("n"))
    tokens = F.slice("ids", (start + 1).cast("int"), (end - start).cast("int"))
    piece = F.struct((F.col("at") + start).alias("at"), tokens.alias("tokens"))

    def joined(df: DataFrame, *by: str) -> DataFrame:
        met = df.groupBy(*by).agg(F.array_sort(F.collect_list("piece")).alias("pieces"))
        whole = F.struct(F.get("pieces", F.lit(0))["at"].alias("at"), F.flatten("pieces.tokens").alias("tokens"))
        return met.select(*by, whole.alias("piece"))

    pieces = placed.withColumn("chunk", F.explode(F.sequence(first, last))).select("shard", "part", "chunk", piece.alias("piece"))
    local = joined(pieces, "shard", "part", "chunk")
    full = F.size("piece.tokens") == max_len
    met = joined(local.filter(~full), "shard", "chunk")
    done = local.filter(full).select("shard", "chunk", "piece").unionByName(met)
    return done.select("shard", "chunk", F.col("piece.tokens").alias("input_ids"))
