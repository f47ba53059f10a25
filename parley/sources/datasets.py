"""Chat JSONL files, numbered text lines and CSV datasets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from parley.operators.ranks import broadcast_if_small
from parley.schemas import CHAT
from parley.session import cut_lineage


def read_chat_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """Chat records; blank lines are skipped and a broken line fails the job."""
    return spark.read.schema(CHAT).option("mode", "FAILFAST").json(path)


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """``file_name, lineno, line`` with exact numbers. Reads each file whole, so
    it suits files far below 2 GB."""
    # A final line break ends the last line and opens no further one.
    body = F.regexp_replace("value", r"\r?\n\z", "")
    return (
        spark.read.text(path, wholetext=True)
        .filter(F.col("value") != "")
        .select(F.col("_metadata.file_name").alias("file_name"), F.posexplode(F.split(body, r"\r?\n", -1)).alias("_pos", "line"))
        .select("file_name", (F.col("_pos") + 1).alias("lineno"), "line")
    )


def block_numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """``file_name, lineno, line`` as :func:`numbered_lines`, for files of any size, which are read in blocks.

    A task reads the lines of a block one after another, so their ids run on
    without gaps. The lines are written once with these ids; line counts of the blocks, one row
    each, are summed up in block order and tell where a block's numbers begin.
    No line moves for it. A line belongs to the block it begins in.
    """
    lines = spark.read.option("lineSep", "\n").text(path)
    placed = cut_lineage(
        lines.select(
            F.col("_metadata.file_path").alias("_file"),
            F.col("_metadata.file_block_start").alias("_block"),
            F.col("_metadata.file_name").alias("file_name"),
            F.monotonically_increasing_id().alias("_row"),
            F.regexp_replace("value", r"\r\z", "").alias("line"),
        )
    )
    counts = placed.groupBy("_file", "_block").agg(F.count(F.lit(1)).alias("_n"), F.min("_row").alias("_first"))
    earlier = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    begins = counts.select("_file", "_block", (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first")).alias("_begin"))
    blocks = broadcast_if_small(cut_lineage(begins))[0]
    return placed.join(blocks, ["_file", "_block"]).select("file_name", (F.col("_begin") + F.col("_row") + 1).alias("lineno"), "line")


def hashed_lines(spark: SparkSession, path: str) -> DataFrame:
    """``file_name, line_hash, line`` for files of any size: the scan is split,
    so a line is named by its digest instead of its number."""
    return spark.read.text(path).select(
        F.col("_metadata.file_name").alias("file_name"),
        F.md5("value").alias("line_hash"),
        F.col("value").alias("line"),
    )


def read_csv_dataset(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """CSV dataset with a header; the schema is given, so no inference pass runs."""
    return spark.read.schema(schema).csv(path, header=True, multiLine=False)
