"""Batch files: one JSON array of raw records per file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parley.functions.jsontext import END_MARK, STRICT, is_json, strict_parse
from parley.functions.keys import batch_number

BATCH_GLOB = "batch_*.json"


def scan_files(spark: SparkSession, path: str, glob: str = BATCH_GLOB) -> DataFrame:
    """One row per file: ``file_name, batch_num, elements, n_records, state``.

    ``state`` is ``ok``, ``empty``, ``not_array``, ``bad_json`` or ``bad_number`` (a batch
    number beyond 64 bits). A JSON array cannot be split, so each file is one row
    and has to stay below 2 GB. A good file is parsed once, by the same reading
    whatever its size: it is followed by a mark, which is found in second place
    only if the file is a single array. ``elements`` are the records' texts.
    """
    body = F.col("value")
    marked = F.from_json(F.concat(F.lit("["), body, F.lit(f',["{END_MARK}"]]')), "array<array<string>>", STRICT)
    single = (F.size("_marked") == 2) & F.get("_marked", F.lit(1)).eqNullSafe(F.array(F.lit(END_MARK)))
    # A text that holds the mark itself takes the longer way.
    plain = F.when(is_json(body), F.from_json(body, "array<string>", STRICT))
    good = F.when(F.contains(body, F.lit(END_MARK)), plain).when(single, F.get("_marked", F.lit(0)))
    number = batch_number(F.col("file_name"))
    state = (
        F.when(F.col("elements").isNull(), F.when(is_json(body), F.lit("not_array")).otherwise(F.lit("bad_json")))
        .when(F.size("elements") == 0, F.lit("empty"))
        .when(F.col("file_name").isNotNull() & F.col("batch_num").isNull(), F.lit("bad_number"))
        .otherwise(F.lit("ok"))
    )
    return (
        spark.read.option("pathGlobFilter", glob)
        .text(path, wholetext=True)
        .select(F.col("_metadata.file_name").alias("file_name"), body, marked.alias("_marked"))
        .select("file_name", "value", number.alias("batch_num"), good.alias("elements"))
        .select(
            "file_name",
            "batch_num",
            "elements",
            F.coalesce(F.array_size("elements"), F.lit(0)).alias("n_records"),
            state.alias("state"),
        )
    )


def bad_files(files: DataFrame) -> DataFrame:
    """Files that yield no records, with the reason."""
    return files.filter(F.col("state") != "ok").select("file_name", "state")


def _elements(files: DataFrame) -> DataFrame:
    exploded = files.filter(F.col("state") == "ok").select(
        "file_name", "batch_num", F.posexplode("elements").alias("record_index", "record_text"), *_beside(files)
    )
    # Elements are text until here: a VARIANT of a whole file has a size limit.
    return exploded.withColumn("record", strict_parse(F.col("record_text")))


def _beside(files: DataFrame) -> list[str]:
    return [c for c in files.columns if c not in ("file_name", "batch_num", "elements", "n_records", "state")]


def _lost():
    return F.col("record").isNull() & F.col("record_text").isNotNull()


def explode_records(files: DataFrame, on_bad_file: str = "skip") -> DataFrame:
    """``file_name, batch_num, record_index, record_text, record`` per array element.

    Further columns of ``files`` go along. ``on_bad_file='fail'`` raises while the
    scan runs; an empty array is no failure. ``skip`` and ``report`` leave bad files
    and records out here; see :func:`bad_files` and :func:`bad_records`.
    """
    if on_bad_file not in ("skip", "fail", "report"):
        raise ValueError(f"on_bad_file: {on_bad_file}")
    if on_bad_file == "fail":
        broken = F.col("state").isin("bad_json", "not_array", "bad_number")
        message = F.concat_ws(" ", F.lit("bad batch file"), F.col("file_name"), F.col("state"))
        files = files.filter(F.when(broken, F.raise_error(message).cast("boolean")).otherwise(F.lit(True)))
    return _elements(files).filter(~_lost())


def bad_records(files: DataFrame) -> DataFrame:
    """Elements too large for a VARIANT, with their whole text: ``file_name, batch_num, record_index, record_text``."""
    return _elements(files).filter(_lost()).select("file_name", "batch_num", "record_index", "record_text")


def read_batches(spark: SparkSession, path: str, on_bad_file: str = "skip") -> DataFrame:
    return explode_records(scan_files(spark, path), on_bad_file)
