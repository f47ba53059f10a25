"""Views of the test tables in the shapes the operators expect."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parley.functions.jsontext import encode
from parley.functions.keys import record_key, request_id
from parley.functions.text import words
from parley.operators.records import merge_batches


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def turn_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw records: each user turn with the assistant turn after it.

    Both turns are keyed by the user turn's position, so one aggregation on
    (conversation, turn) pairs them and a long conversation spreads over tasks.
    A user turn without a reply has a missing assistant, hence "".
    """
    turns = table(spark, sf_dir, "conversations")
    is_user, is_reply = F.col("role") == "user", F.col("role") == "assistant"
    at = F.when(is_user, F.col("turn")).otherwise(F.col("turn") - 1)
    return (
        turns.filter(is_user | is_reply)
        .groupBy(F.col("conv_id").alias("batch_num"), at.alias("record_index"))
        .agg(
            F.bool_or(is_user).alias("has_user"),
            F.bool_or(is_reply).alias("has_reply"),
            F.max(F.when(is_user, F.col("text"))).alias("user"),
            F.max(F.when(is_reply, F.col("text"))).alias("reply"),
        )
        .filter("has_user")
        .select(
            record_key(F.col("batch_num"), F.col("record_index")).alias("mongo_id"),
            "batch_num",
            "record_index",
            "user",
            F.when(F.col("has_reply"), F.col("reply")).otherwise(F.lit("")).alias("assistant"),
        )
    )


def raw_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turn pairs together with the documents, which hold personal data."""
    documents = table(spark, sf_dir, "documents").select(
        F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("mongo_id"),
        F.lit(-1).cast("bigint").alias("batch_num"),
        F.col("doc_id").alias("record_index"),
        F.col("text").alias("user"),
        F.concat_ws(" ", "lang", "source").alias("assistant"),
    )
    return merge_batches(turn_pairs(spark, sf_dir), documents)


def raw_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw documents; those without a reply count as already taken."""
    status = F.when(F.col("assistant") == "", F.lit("in_progress")).otherwise(F.lit("pending"))
    return raw_records(spark, sf_dir).withColumnRenamed("mongo_id", "doc_id").withColumn("etl_status", status)


def json_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One batch file per conversation, one JSON record per turn, with missing and null keys."""
    text = F.col("text")
    record = (
        F.when(F.col("role") == "user", encode(F.struct(text.alias("user"))))
        .when(F.col("role") == "assistant", encode(F.struct(text.alias("assistant"))))
        .otherwise(encode(F.struct(F.lit(None).cast("string").alias("user"), text.alias("assistant"))))
    )
    return table(spark, sf_dir, "conversations").select(
        F.format_string("batch_%03d.json", F.col("conv_id")).alias("file_name"),
        F.col("conv_id").alias("batch_num"),
        F.col("turn").alias("record_index"),
        record.alias("record_text"),
        F.try_parse_json(record).alias("record"),
    )


def chat_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSONL lines ``kind, a, b, line``: turns around each user turn, event props, prose."""
    turns = table(spark, sf_dir, "conversations")
    place = F.explode(
        F.array(
            F.struct((F.col("turn") + 1).alias("at"), F.lit(0).alias("place")),
            F.struct(F.col("turn").alias("at"), F.lit(1).alias("place")),
            F.struct((F.col("turn") - 1).alias("at"), F.lit(2).alias("place")),
        )
    )
    said = F.struct("role", F.col("text").alias("content"))

    around = (
        turns.select("conv_id", said.alias("said"), place.alias("p"))
        .groupBy("conv_id", F.col("p.at").alias("at"))
        .agg(*[F.max(F.when(F.col("p.place") == i, F.col("said"))).alias(f"m{i}") for i in range(3)])
        .filter(F.col("m1.role") == "user")
    )
    following = F.when(F.col("m2.role") == "assistant", F.col("m2"))
    line = encode(F.struct(F.array_compact(F.array("m0", "m1", following)).alias("conversations")))
    return merge_batches(
        around.select(F.lit("turns").alias("kind"), F.col("conv_id").alias("a"), F.col("at").alias("b"), line.alias("line")),
        table(spark, sf_dir, "events").select(
            F.lit("props").alias("kind"), F.col("event_id").alias("a"), F.lit(0).cast("bigint").alias("b"), F.col("props").alias("line")
        ),
        table(spark, sf_dir, "documents").select(
            F.lit("prose").alias("kind"), F.col("doc_id").alias("a"), F.lit(0).cast("bigint").alias("b"), F.col("text").alias("line")
        ),
    )


def replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model replies: English documents come fenced, after a JSON line; others are prose only."""
    head = encode(F.struct("doc_id", "lang", "source", "n_chars"))
    fenced = F.concat(F.lit("```json\n"), head, F.lit("\n"), F.col("text"), F.lit("\n```"))
    reply = F.when(F.col("lang") == "en", fenced).otherwise(F.col("text"))
    return table(spark, sf_dir, "documents").select("doc_id", reply.alias("raw"))


def leads(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey").cast("string")
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    nothing = F.lit(None)
    asks = F.concat(F.lit("customer "), F.col("o_custkey").cast("string"), F.lit(" asks at "), priority)
    return orders.select(
        key.alias("_id"),
        F.when(priority == "5-LOW", F.lit("")).when(priority != "4-NOT SPECIFIED", asks).alias("conversation"),
        F.when(status == "O", F.lit("pending"))
        .when(status == "P", F.lit("processing"))
        .otherwise(F.lit("completed"))
        .alias("inference_status"),
        F.when(status == "P", request_id(key)).alias("sagemaker_request_id"),
        nothing.cast("string").alias("inference_result"),
        nothing.cast("string").alias("inference_raw_output"),
        nothing.cast("timestamp").alias("inference_completed_at"),
        F.when(status == "F", F.lit("processed")).otherwise(F.lit("pending")).alias("etl_status"),
        F.when(priority == "1-URGENT", F.lit("run_0")).alias("training_run_id"),
        nothing.cast("timestamp").alias("queued_at"),
    )


def output_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Output objects ``key, body``: answers, unknown requests, inputs, keys without an id."""
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    key = F.col("o_orderkey").cast("string")
    answer = F.concat(F.lit("answer "), key)
    body = (
        F.when(priority == "1-URGENT", F.concat(F.lit('[{"generated_text":"'), answer, F.lit('"}]')))
        .when(priority == "2-HIGH", F.concat(F.lit('{"generated_text":"'), answer, F.lit('"}')))
        .when(priority == "3-MEDIUM", F.concat(F.lit('{"other":'), key, F.lit("}")))
        .when(priority == "4-NOT SPECIFIED", F.lit("[]"))
        .otherwise(F.concat(answer, F.lit(" is not json")))
    )
    name = (
        F.when((status == "F") & (priority == "5-LOW"), F.lit("inference-outputs/.out"))
        .when(status == "F", F.concat(F.lit("inference-inputs/"), request_id(key), F.lit(".json")))
        .otherwise(F.concat(F.lit("inference-outputs/"), F.replace(request_id(key), F.lit("-"), F.lit("%2D")), F.lit(".out")))
    )
    return table(spark, sf_dir, "orders").select(name.alias("key"), body.alias("body"), key.alias("_id"))


def label_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label columns per order, one batch per customer."""
    status, priority, key = F.col("o_orderstatus"), F.col("o_orderpriority"), F.col("o_orderkey")
    drop = priority == "5-LOW"
    intent = (
        F.when(priority == "1-URGENT", F.lit("buy"))
        .when(priority == "2-HIGH", F.lit("rent"))
        .when(priority == "3-MEDIUM", F.lit("invest"))
        .when(priority == "4-NOT SPECIFIED", F.lit("browse"))
        .otherwise(F.lit("drop"))
    )
    brand = F.concat(F.lit("brand_"), (key % 6).cast("string"))
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("batch_num"),
        key.alias("record_index"),
        intent.alias("intent"),
        F.when(status == "O", F.lit("hot")).when(status == "P", F.lit("warm")).otherwise(F.lit("N/A")).alias("urgency"),
        F.lit("unknown").alias("budget_range"),
        F.when(~drop, F.month("o_orderdate")).alias("timeline_months"),
        F.concat(F.lit("city_"), (key % 50).cast("string")).alias("preferred_locality"),
        F.lit("condo").alias("property_type"),
        F.when(drop & (status == "F"), F.lit("N/A")).otherwise(brand).alias("brand_fit"),
        F.when(drop, F.lit("drop")).when(status == "P", F.lit("call_back")).otherwise(F.lit("agent_call")).alias("next_action"),
        F.floor(F.col("o_totalprice") / 4500).cast("int").alias("score"),
        F.lit("").alias("reasoning"),
        F.when(drop, status).alias("flaw"),
    )


LABEL_KEYS = (
    "intent",
    "urgency",
    "budget_range",
    "timeline_months",
    "preferred_locality",
    "property_type",
    "brand_fit",
    "next_action",
    "score",
    "reasoning",
)


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``batch_num, record_index, assistant``: label JSON, sometimes cut short or missing a key."""
    whole = encode(F.struct(*LABEL_KEYS))
    text = (
        F.when(F.col("flaw") == "P", F.lit("{not json"))
        .when(F.col("flaw") == "O", encode(F.struct(*LABEL_KEYS[:-1])))
        .otherwise(whole)
    )
    return label_rows(spark, sf_dir).select("batch_num", "record_index", text.alias("assistant"))


def losses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``run_id, loss, tokens`` per event; decimals, so that sums do not depend on row order."""
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("run_"), F.col("user_id").cast("string")).alias("run_id"),
        (F.col("value").cast("decimal(10,2)") * F.lit(Decimal("0.05"))).alias("loss"),
        F.get_json_object("props", "$.k").cast("int").alias("tokens"),
    )


def metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "ts", "event_type", F.col("value").cast("decimal(10,2)").alias("value")
    )


def token_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, full_ids, prompt_len``: the length of each word stands for its token id."""
    ids = F.transform(words(F.col("text")), lambda w: F.length(w))
    return (
        table(spark, sf_dir, "documents")
        .select("doc_id", ids.alias("full_ids"))
        .withColumn("prompt_len", F.floor(F.size("full_ids") / 3).cast("int"))
    )
