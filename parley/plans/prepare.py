"""Batch files to train, validation and test splits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parley.functions.chat import chat_format
from parley.functions.text import Names
from parley.operators.merges import skip_done
from parley.operators.ranks import split_assign
from parley.operators.records import clean_records, other_fields, with_defaults
from parley.schemas import BATCH_TOKEN, DEFAULT_SYSTEM_PROMPT
from parley.session import cut_lineage
from parley.sinks.files import write_batches, write_splits
from parley.sources.batches import bad_records, explode_records, scan_files

TOO_LARGE = "too_large"
# Bytes of a record that any version of the JSON value type holds.
SURELY_READABLE = 1 << 20
KEY = ("file_name", "record_index")


def clean(spark: SparkSession, raw_dir: str, interim: str, names: Names = None) -> DataFrame:
    """Masks batch files into the interim table; returns records per batch file.

    Batches already there are skipped. A file without records counts as failed.
    What else a record holds goes along as JSON text in ``extra``, unmasked as in its file.
    Records that are too large to be read go whole to ``rejected(interim)`` with a reason;
    with them the interim table holds every record of the good files.
    """
    files = scan_files(spark, raw_dir)
    longest = F.coalesce(F.array_max(F.transform("elements", lambda e: F.octet_length(e))), F.lit(0))
    sizes = F.when(F.col("state") == "ok", F.col("n_records")).otherwise(0).alias("n_records")
    sizes = cut_lineage(files.select("file_name", sizes, longest.alias("longest")))
    # Only files with a very long record are looked at again.
    if sizes.where(F.col("longest") > SURELY_READABLE).take(1):
        long = files.where(longest > SURELY_READABLE)
        write_batches(bad_records(long).withColumn("reason", F.lit(TOO_LARGE)), rejected(interim), "file_name")
    records = with_defaults(explode_records(files))
    records = records.withColumn("extra", other_fields())
    masked = clean_records(records, names).select("file_name", "batch_num", "record_index", "user", "assistant", "extra")
    write_batches(masked, interim, "file_name")
    return sizes.select(F.col("file_name").alias("batch_num"), "n_records")


def rejected(interim: str) -> str:
    """Where ``clean`` keeps the records it could not read; there is no table as long as there are none."""
    return f"{interim.rstrip('/')}-rejected"


def format_and_split(records: DataFrame, *key: str, system: str = DEFAULT_SYSTEM_PROMPT, seed: int = 42) -> DataFrame:
    """Chat records with their split, from masked ``user`` and ``assistant``."""
    chats = records.withColumn("conversations", chat_format(F.col("user"), F.col("assistant"), system))
    return split_assign(chats, *(key or KEY), seed=seed)


def prepare(spark: SparkSession, interim: str, out: str, system: str = DEFAULT_SYSTEM_PROMPT) -> DataFrame:
    """Interim table to split JSON lines; returns the split rows."""
    splits = format_and_split(spark.read.parquet(interim), *KEY, system=system)
    write_splits(splits, out)
    return splits


def prepare_processed(spark: SparkSession, store: str, out: str) -> DataFrame:
    """The same from the processed store, whose records are formatted already."""
    splits = split_assign(spark.read.parquet(store), "source_id")
    write_splits(splits, out)
    return splits


def generation_worklist(spark: SparkSession, start: int, count: int, template: str, done: DataFrame | None = None) -> DataFrame:
    """``batch_num, prompt`` of the batches still to be generated."""
    work = spark.range(start, start + count).select(F.col("id").alias("batch_num"))
    todo = work if done is None else skip_done(work, done, "batch_num")
    return todo.withColumn("prompt", F.replace(F.lit(template), F.lit(BATCH_TOKEN), F.col("batch_num").cast("string")))


def batch_range(df: DataFrame, start: int, count: int) -> DataFrame:
    """Rows of the batches ``start .. start + count - 1``."""
    return df.filter(F.col("batch_num").between(start, start + count - 1))

