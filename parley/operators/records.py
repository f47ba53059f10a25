"""Record shapes: defaults, provenance, raw documents, messages, processed documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.functions.chat import chat_format, validate_chat
from parley.functions.jsontext import encode, field_or, is_json, is_object_text, strict_parse
from parley.functions.keys import record_key
from parley.functions.text import Names, mask_pii
from parley.operators.ranks import global_index
from parley.schemas import DEFAULT_SYSTEM_PROMPT, ETL_DONE, ETL_PENDING, PROCESSED_MESSAGE, REJECTED

MESSAGE_FIELDS = ("mongo_id", "batch_num", "record_index", "user", "assistant")


def with_defaults(df: DataFrame, record: str = "record") -> DataFrame:
    """Adds ``user`` and ``assistant``: missing keys become "", a JSON null stays NULL."""
    value = F.col(record)
    return df.withColumns(
        {"user": field_or(value, "user", F.lit("")), "assistant": field_or(value, "assistant", F.lit(""))}
    )


def clean_records(df: DataFrame, names: Names = None, strict: bool = True) -> DataFrame:
    """Masks ``user`` and ``assistant`` and leaves other columns alone."""
    return df.withColumns({c: mask_pii(F.col(c), names, strict) for c in ("user", "assistant")})


def other_fields(record: str = "record") -> Column:
    """JSON text of a record's keys other than ``user`` and ``assistant``, NULL where it has none."""
    fields = F.try_variant_get(F.col(record), "$", "map<string,variant>")
    rest = F.map_filter(fields, lambda k, _: ~k.isin("user", "assistant"))
    return F.when(F.cardinality(rest) > 0, F.to_json(rest))


def to_raw_docs(df: DataFrame) -> DataFrame:
    """Raw documents in state pending; ``raw_record`` is the record's own JSON text."""
    return df.select(
        "batch_num", "record_index", "user", "assistant", "raw_record", F.lit(ETL_PENDING).alias("etl_status")
    )


def with_provenance(
    records: DataFrame, file: str = "file_name", pos: str = "record_index", sizes: DataFrame | None = None
) -> DataFrame:
    """Unified documents: global index, batch and position, the original record."""
    return indexed_docs(global_index(records, file, pos, sizes=sizes), pos)


def indexed_docs(records: DataFrame, pos: str = "record_index") -> DataFrame:
    """The same from records that have their ``global_index``."""
    return records.select(
        "global_index",
        "batch_num",
        F.col(pos).alias("record_index"),
        F.col("batch_num").alias("source_batch"),
        F.col(pos).alias("batch_index"),
        "user",
        "assistant",
        F.col("record_text").alias("raw_record"),
        F.lit(ETL_PENDING).alias("etl_status"),
    )


def merge_batches(*dfs: DataFrame) -> DataFrame:
    """Bag union of batches; a missing column is NULL."""
    merged = dfs[0]
    for df in dfs[1:]:
        merged = merged.unionByName(df, allowMissingColumns=True)
    return merged


def to_messages(docs: DataFrame, topic: str, doc_id: str = "doc_id") -> DataFrame:
    """Raw-topic rows ``(topic, key, value)`` of raw documents.

    A NULL text stays NULL: a missing field was already defaulted when the
    document was written.
    """
    body = F.struct(
        F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("mongo_id"),
        F.coalesce(F.col("batch_num").cast("bigint"), F.lit(-1)).alias("batch_num"),
        F.coalesce(F.col("record_index").cast("bigint"), F.lit(-1)).alias("record_index"),
        F.col("user"),
        F.col("assistant"),
    )
    return docs.select(body.alias("m")).select(
        F.lit(topic).alias("topic"),
        record_key(F.col("m.batch_num"), F.col("m.record_index")).alias("key"),
        encode(F.col("m")).alias("value"),
    )


def parse_messages(messages: DataFrame) -> DataFrame:
    """Message fields of topic rows, with ``is_message`` false for anything but an object.

    The one-element explode keeps a later filter from being pushed below the
    parse, where it would repeat the parse for each field it mentions.
    """
    v = F.col("_v")
    return messages.select("value", F.explode(F.array(strict_parse(F.col("value")))).alias("_v")).select(
        "value",
        (v.isNotNull() & is_object_text(F.col("value"))).alias("is_message"),
        field_or(v, "mongo_id", F.lit("")).alias("mongo_id"),
        field_or(v, "batch_num", F.lit(-1).cast("bigint"), "bigint").alias("batch_num"),
        field_or(v, "record_index", F.lit(-1).cast("bigint"), "bigint").alias("record_index"),
        field_or(v, "user", F.lit("")).alias("user"),
        field_or(v, "assistant", F.lit("")).alias("assistant"),
    )


def transform_records(
    records: DataFrame, system: str = DEFAULT_SYSTEM_PROMPT, names: Names = None, strict: bool = True
) -> DataFrame:
    """Mask, format and validate: adds ``conversations`` and ``reason`` (NULL = accepted).

    The unmasked texts stay beside them, since a dead letter holds what came in.
    Masking neither empties a text nor fills a blank one, so the reason is taken
    from the unmasked texts: a filter on it then runs no pattern at all.
    """
    user, assistant = F.col("user"), F.col("assistant")
    masked = chat_format(mask_pii(user, names, strict), mask_pii(assistant, names, strict), system)
    return records.withColumns(
        {"conversations": masked, "reason": validate_chat(chat_format(user, assistant, system))}
    )


def partition_valid(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Accepted and rejected rows; together they are the input."""
    return df.filter(F.col("reason").isNull()), df.filter(F.col("reason").isNotNull())


def processed_struct(system: str = DEFAULT_SYSTEM_PROMPT) -> Column:
    """Value of a processed message."""
    return F.struct(
        F.coalesce(F.col("mongo_id"), F.lit("")).alias("source_mongo_id"),
        F.col("batch_num").cast("bigint").alias("batch_num"),
        F.col("record_index").cast("bigint").alias("record_index"),
        F.col("conversations"),
        F.struct(F.lit(system).alias("system_prompt")).alias("metadata"),
    )


def dead_letter_value() -> Column:
    """The incoming payload with ``_dlq_reason``; text that is no message is kept raw."""
    reason = F.when(
        F.col("is_message"), F.concat(F.lit(REJECTED), F.col("reason"))
    ).otherwise(F.lit("not a JSON object"))
    payload = F.struct(*MESSAGE_FIELDS, reason.alias("_dlq_reason"))
    raw = F.struct(F.col("value").alias("raw_value"), reason.alias("_dlq_reason"))
    return F.when(F.col("is_message"), encode(payload)).otherwise(encode(raw))


def parse_processed(messages: DataFrame) -> DataFrame:
    """Processed documents of processed-topic rows; ``source_id`` is the raw document's id.

    A value that is no JSON object is kept as ``raw_value``, which is NULL otherwise.
    """
    value = F.col("value")
    sound = F.coalesce(is_object_text(value) & is_json(value), F.lit(False))
    m = F.from_json("value", PROCESSED_MESSAGE)
    return messages.select(m.alias("m"), F.when(~sound, value).alias("raw_value")).select(
        F.coalesce("m.source_mongo_id", F.lit("")).alias("source_id"),
        F.col("m.conversations").alias("conversations"),
        F.lit(ETL_DONE).alias("etl_status"),
        F.struct(
            F.col("m.metadata.system_prompt").alias("system_prompt"),
            F.coalesce("m.batch_num", F.lit(-1).cast("bigint")).alias("batch_num"),
            F.coalesce("m.record_index", F.lit(-1).cast("bigint")).alias("record_index"),
        ).alias("metadata"),
        "raw_value",
    )
