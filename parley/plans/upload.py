"""All batch files into one indexed table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from parley.operators.merges import COUNTS, bulk_upsert, merge_counted
from parley.operators.ranks import file_offsets
from parley.operators.records import indexed_docs, with_defaults
from parley.session import exists
from parley.sources.batches import explode_records, scan_files
from parley.sources.keyed import KeyedTable


def unified(spark: SparkSession, raw_dir: str) -> DataFrame:
    """Unified documents of a folder of batch files; unreadable files are skipped."""
    files = scan_files(spark, raw_dir)
    # A file is one row here: it meets its offset before its records are exploded, and no record moves.
    offsets = file_offsets(files.filter("state = 'ok'").select("file_name", "n_records"), "file_name")
    records = explode_records(files.join(offsets, "file_name"))
    return indexed_docs(with_defaults(records).withColumn("global_index", F.col("_offset") + F.col("record_index")))


def upload(
    spark: SparkSession, raw_dir: str, current: str, result: str, overwrite: bool = False, dry_run: bool = False
) -> DataFrame:
    """Merges the unified documents into the table at ``current`` and writes it to ``result``.

    A folder cannot be overwritten while it is read, so the caller swaps the two.
    Returns the stats row, counted while the result was written.
    """
    source = unified(spark, raw_dir)
    target = spark.read.parquet(current) if exists(spark, current) else spark.createDataFrame([], source.schema)
    if dry_run:
        return bulk_upsert(target, source, "global_index", overwrite, dry_run, unique=True)[1]
    counted = Observation("upload")
    merged = merge_counted(target, source, "global_index", counted, overwrite, unique=True)
    merged.write.mode("errorifexists").parquet(result)
    found = counted.get
    return spark.createDataFrame([tuple(found[c] for c in COUNTS)], ", ".join(f"{c} bigint" for c in COUNTS))


def upload_into(
    spark: SparkSession, raw_dir: str, table: KeyedTable, version: int, overwrite: bool = False, dry_run: bool = False
) -> dict[str, int]:
    """Merges the unified documents into a stored table keyed by ``global_index``; returns the counts.

    What is written are the documents that are new or, with ``overwrite``, differ.
    """
    return table.upsert(unified(spark, raw_dir), version, overwrite, dry_run)
