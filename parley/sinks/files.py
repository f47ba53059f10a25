"""File sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.operators.ranks import broadcast_if_small
from parley.session import cut_lineage, exists


def done_batches(spark, path: str, key: str) -> DataFrame | None:
    """Batches already in the sink, or None when nothing was written yet."""
    return spark.read.parquet(path).select(key).distinct() if exists(spark, path) else None


def write_batches(df: DataFrame, path: str, key: str = "batch_num") -> None:
    """Append batches the sink does not hold yet.

    The batch stays a column: a folder per batch of thirty records would end in
    millions of tiny files. The list of batches is broadcast when it was counted
    to be short, so records are written where they were read.
    """
    done = done_batches(df.sparkSession, path, key)
    todo = df if done is None else df.join(broadcast_if_small(cut_lineage(done))[0], key, "left_anti")
    todo.write.mode("append").parquet(path)


def write_splits(df: DataFrame, path: str, order: str = "shuffle_key") -> None:
    """``split=train|val|test`` folders of JSON lines in shuffled order, UTF-8 unescaped."""
    (
        df.select("split", order, "conversations")
        .repartitionByRange("split", order)
        .sortWithinPartitions("split", order)
        .drop(order)
        .write.mode("overwrite")
        .option("ignoreNullFields", "false")
        .partitionBy("split")
        .json(path)
    )


def write_payloads(payloads: DataFrame, path: str) -> None:
    """Inference payloads, one JSON line per request, keyed by ``request_id``."""
    payloads.select("request_id", "payload").write.mode("append").json(path)


def write_raw_replies(rejects: DataFrame, path: str) -> None:
    """Replies in which nothing parsed, kept whole."""
    rejects.write.mode("append").json(path)


def write_run_meta(meta: DataFrame, path: str) -> None:
    """Run metadata, one JSON line per run."""
    meta.write.mode("append").option("ignoreNullFields", "false").json(path)
