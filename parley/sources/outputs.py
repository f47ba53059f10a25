"""Model output objects: one file per request."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parley.functions.chat import generated_text
from parley.functions.jsontext import encode, strict_parse
from parley.functions.keys import is_output_key, result_request_id


def parse_output(body: Column) -> Column:
    """VARIANT of the body; a body that is not JSON becomes ``{"raw_output": body}``."""
    return F.coalesce(strict_parse(body), F.to_variant_object(F.struct(body.alias("raw_output"))))


def outputs_of(objects: DataFrame, key: str = "key", body: str = "body") -> DataFrame:
    """``key, request_id, result, raw`` of each output object; input payloads are left out."""
    wrapped = F.struct(F.col("body").alias("raw_output"))
    parsed = objects.filter(is_output_key(F.col(key))).select(
        F.col(key).alias("key"),
        result_request_id(F.col(key)).alias("request_id"),
        F.col(body).alias("body"),
        strict_parse(F.col(body)).alias("json"),
    )
    # A column of its own, since the answer is looked for in several places of it.
    parsed = parsed.withColumn("output", F.coalesce("json", F.to_variant_object(wrapped)))
    return parsed.select(
        "key",
        "request_id",
        generated_text(F.col("output")).alias("result"),
        F.when(F.col("json").isNull(), encode(wrapped)).otherwise(F.col("body")).alias("raw"),
    )


def output_objects(df: DataFrame) -> DataFrame:
    """``key, body`` of a whole-text scan, batch or streaming."""
    # A file's URI keeps a plus sign, while the keys that events carry write a blank so.
    uri = F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))
    return df.select(uri.alias("key"), F.col("value").alias("body"))


def read_outputs(spark: SparkSession, path: str) -> DataFrame:
    files = spark.read.option("recursiveFileLookup", "true").text(path, wholetext=True)
    return outputs_of(output_objects(files))
