"""Key scalars: batch numbers, request ids, composite keys, shuffle keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from parley.schemas import INPUT_PREFIX


def batch_number(file: Column) -> Column:
    """Number between the first and second underscore of the file stem, 0 where none stands there.

    A number beyond 64 bits gives NULL: such a file is reported, not mixed up with others.
    """
    name = F.substring_index(file, "/", -1)
    stem = F.regexp_replace(name, r"(?<=.)\.[^.]*\z", "")
    part = F.trim(F.get(F.split(stem, "_"), F.lit(1)))
    return F.when(F.rlike(part, F.lit(r"\A[+-]?[0-9]+\z")), part.try_cast("bigint")).otherwise(F.lit(0).cast("bigint"))


def record_key(batch_num: Column, record_index: Column) -> Column:
    return F.concat_ws(":", batch_num.cast("string"), record_index.cast("string"))


def shuffle_key(*key: Column, seed: int = 42) -> Column:
    """Hex digest whose order is the shuffled order, on any number of machines."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[k.cast("string") for k in key]))


def is_output_key(key: Column) -> Column:
    return ~F.contains(key, F.lit(INPUT_PREFIX))


def decode_key(key: Column) -> Column:
    """URL-decode; a percent sign without two hex digits is kept as it is."""
    return F.try_url_decode(F.regexp_replace(key, "%(?![0-9A-Fa-f]{2})", "%25"))


def result_request_id(key: Column) -> Column:
    """Request id of an output object key, NULL when none is left."""
    name = F.substring_index(decode_key(key), "/", -1)
    bare = F.regexp_replace(F.regexp_replace(name, r"\.out\z", ""), r"\.json\z", "")
    # Worked out once, whereas a condition and its value would each do all of it.
    return F.nullif(bare, F.lit(""))


def request_id(record_id: Column, seed: str | int = 42) -> Column:
    """Record id plus eight hex digits; a retry gives the same id again."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), record_id))
    return F.concat_ws("-", record_id, F.substring(digest, 1, 8))


def run_id(at: Column, seed: str | int = 42) -> Column:
    stamp = F.date_format(at, "yyyyMMdd_HHmmss")
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), stamp))
    return F.concat_ws("_", F.lit("run"), stamp, F.substring(digest, 1, 6))
