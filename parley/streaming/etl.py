"""Extract, transform and load between document store and topics."""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from parley.functions.jsontext import encode
from parley.functions.keys import record_key
from parley.functions.text import Names
from parley.operators.merges import apply_status_log, first_per_key
from parley.operators.records import (
    dead_letter_value,
    parse_messages,
    parse_processed,
    processed_struct,
    to_messages,
    transform_records,
)
from parley.schemas import DEFAULT_SYSTEM_PROMPT, ETL_DONE, ETL_FAILED, ETL_IN_PROGRESS, PROCESSED_DOC
from parley.session import cut_lineage, exists, file_system, read_note, write_note
from parley.sources.keyed import BUCKETS, bucket_of
from parley.sources.store import pending
from parley.sources.topics import DEAD_LETTERS, PROCESSED, RAW

# Holds a store's number of buckets.
STORE_LAYOUT = "_buckets"


def still_pending(docs: DataFrame, status_log: str | None = None, doc_id: str = "doc_id") -> DataFrame:
    """Documents in state pending after the entries of the status log, if there is one."""
    if status_log and exists(docs.sparkSession, status_log):
        log = docs.sparkSession.read.option("recursiveFileLookup", "true").parquet(status_log)
        log = log.withColumnRenamed("doc_id", "_id")
        keyed = docs.withColumn("_id", F.col(doc_id).cast("string"))
        docs = apply_status_log(keyed, log, "_id").drop("_id")
    return pending(docs)


def run_extract(
    docs: DataFrame, topics, status_log: str | None = None, doc_id: str = "doc_id", log_root: str | None = None, where: Column | None = None
) -> int:
    """Publishes documents to the raw topic, logs them as in progress, returns their number.

    By default these are the documents still pending after the status log at
    ``log_root`` (default ``status_log``); ``where`` chooses others.
    """
    chosen = still_pending(docs, log_root or status_log, doc_id) if where is None else docs.filter(where)
    # Written first: the log that chooses the documents grows while they are published.
    docs = cut_lineage(chosen)
    published = Observation("extract")
    messages = to_messages(docs, RAW, doc_id).observe(published, F.count(F.lit(1)).alias("n"))
    topics.write(messages)
    n = published.get["n"]
    if status_log and n:
        append_status(docs.select(F.col(doc_id).alias("doc_id")), ETL_IN_PROGRESS, status_log)
    return n


def append_status(ids: DataFrame, status: str, path: str, mode: str = "append") -> None:
    """Entries ``(doc_id, status, at)`` for ``apply_status_log``."""
    entry = ids.select(F.col("doc_id").cast("string"), F.lit(status).alias("status"), F.current_timestamp().alias("at"))
    entry.write.mode(mode).parquet(path)


def transform_rows(raw: DataFrame, system: str = DEFAULT_SYSTEM_PROMPT, names: Names = None) -> DataFrame:
    """Processed-topic and dead-letter rows of raw-topic rows, in one pass.

    Each row carries its topic, so nothing is computed twice for two branches.
    """
    checked = transform_records(parse_messages(raw), system, names)
    accepted = F.col("is_message") & F.col("reason").isNull()
    return checked.select(
        F.when(accepted, F.lit(PROCESSED)).otherwise(F.lit(DEAD_LETTERS)).alias("topic"),
        F.when(accepted, record_key(F.col("batch_num"), F.col("record_index"))).alias("key"),
        F.when(accepted, encode(processed_struct(system))).otherwise(dead_letter_value()).alias("value"),
    )


def stream_transform(
    raw: DataFrame,
    out,
    checkpoint: str,
    system: str = DEFAULT_SYSTEM_PROMPT,
    available_now: bool = True,
    names: Names = None,
) -> StreamingQuery:
    return out.write_stream(transform_rows(raw, system, names), checkpoint, available_now)


def log_failures(dead_letters: DataFrame, status_log: str) -> None:
    """Marks the documents of dead letters as failed."""
    doc_id = F.get_json_object("value", "$.mongo_id")
    failed = dead_letters.select(doc_id.alias("doc_id")).filter(F.coalesce("doc_id", F.lit("")) != "")
    append_status(failed, ETL_FAILED, status_log)


def open_store(spark: SparkSession, store: str, buckets: int = BUCKETS) -> None:
    """Gives a new store its schema and its number of buckets; does nothing to a store in use.

    Choose ``buckets`` so that the ids of one bucket of the full store are a task's worth.
    """
    if not exists(spark, f"{store}/{STORE_LAYOUT}"):
        empty = spark.createDataFrame([], PROCESSED_DOC).withColumn("bucket", F.lit(0))
        empty.write.mode("ignore").parquet(f"{store}/load_id=open/bucket=0")
        write_note(spark, f"{store}/{STORE_LAYOUT}", str(buckets))


def read_store(spark: SparkSession, store: str) -> DataFrame:
    """The stored documents, each once even while the store is being compacted."""
    return first_per_key(_loads(spark, store).drop("load_id", "bucket"), ["source_id"])


def _loads(spark: SparkSession, store: str) -> DataFrame:
    places = T.StructType([T.StructField("load_id", T.StringType()), T.StructField("bucket", T.IntegerType())])
    return spark.read.schema(T.StructType([*PROCESSED_DOC.fields, *places.fields])).parquet(store)


def compact_store(spark: SparkSession, store: str) -> None:
    """Puts the files of all loads so far together, one or few for each bucket.

    Not to run beside a load. The joined files are written before the old ones
    go; ``read_store`` and further loads find every document once at any time.
    """
    fs, at = file_system(spark, store)
    old = [s.getPath() for s in fs.listStatus(at) if s.getPath().getName().startswith("load_id=")]
    docs = first_per_key(_loads(spark, store).drop("load_id"), ["bucket", "source_id"])
    write_load(docs, store, f"base-{uuid.uuid4().hex}")
    for path in old:
        fs.delete(path, True)


def write_load(docs: DataFrame, store: str, load_id: str) -> None:
    # The rows of a bucket meet in one task, so a load adds one file for each of its buckets.
    docs.repartition("bucket").write.partitionBy("bucket").mode("overwrite").parquet(f"{store}/load_id={load_id}")


def present_ids(spark: SparkSession, store: str, buckets: list[int], load_id: str) -> DataFrame:
    """``source_id`` of the documents other loads have put into these buckets; no other file is read."""
    held = _loads(spark, store).where(F.col("bucket").isin(buckets) & (F.col("load_id") != load_id))
    return held.select("source_id")


def load_batch(
    batch: DataFrame,
    load_id: str,
    store: str,
    rejects: str,
    status_log: str | None = None,
    stats: str | None = None,
) -> None:
    """Insert-if-absent of one micro-batch, written under its own ``load_id``.

    A replay overwrites just its own partition and does not count that partition
    as already present, so running a batch twice equals running it once. Of several
    messages with one ``source_id`` the smallest is stored, so a replay stores the same
    one. Messages that are no JSON objects go to ``rejects`` with a reason. Of the
    store only the ids in the buckets of this batch are read.
    """
    spark = batch.sparkSession
    buckets = int(read_note(spark, f"{store}/{STORE_LAYOUT}"))
    parsed = parse_processed(batch).withColumn("bucket", bucket_of(["source_id"], buckets)).persist()
    try:
        valid = parsed.filter(F.col("raw_value").isNull()).drop("raw_value")
        ids = valid.select("source_id").distinct()
        # At most as many values as the store has buckets.
        n, touched = parsed.agg(F.count(F.lit(1)), F.collect_set(F.when(F.col("raw_value").isNull(), F.col("bucket")))).first()
        present = present_ids(spark, store, sorted(touched), load_id)
        fresh = first_per_key(valid.join(present, "source_id", "left_anti"), ["bucket", "source_id"])
        write_load(fresh, store, load_id)
        if status_log:
            done = ids.filter(F.col("source_id") != "").select(F.col("source_id").alias("doc_id"))
            append_status(done, ETL_DONE, f"{status_log}/load_id={load_id}", "overwrite")
        reason = F.lit("not a JSON object").alias("_dlq_reason")
        bad = parsed.filter(F.col("raw_value").isNotNull()).select("raw_value", reason)
        bad.write.mode("overwrite").parquet(f"{rejects}/load_id={load_id}")
        if stats:
            inserted = spark.read.schema(PROCESSED_DOC).parquet(f"{store}/load_id={load_id}").agg(F.count(F.lit(1)))
            loaded = valid.agg(F.count(F.lit(1)).alias("loaded"))
            loaded.select(
                "loaded",
                inserted.scalar().alias("inserted"),
                (F.col("loaded") - inserted.scalar()).alias("skipped"),
                (F.lit(n) - F.col("loaded")).alias("failed"),
            ).write.mode("overwrite").parquet(f"{stats}/load_id={load_id}")
    finally:
        parsed.unpersist()


def stream_load(
    processed: DataFrame,
    store: str,
    checkpoint: str,
    rejects: str,
    status_log: str | None = None,
    stats: str | None = None,
    available_now: bool = True,
) -> StreamingQuery:
    """Loads processed-topic rows into the store, once per ``source_id``.

    A micro-batch reads the ids in its own buckets of the store, so one of few
    messages reads little of a store with many buckets. Messages that are no
    JSON objects go to ``rejects``.
    """
    # Batch numbers start at 0 in each checkpoint; its digest keeps them apart.
    writer = hashlib.md5(checkpoint.encode()).hexdigest()[:8]
    open_store(processed.sparkSession, store)

    def load(batch: DataFrame, batch_id: int) -> None:
        load_batch(batch, f"{writer}-{batch_id}", store, rejects, status_log, stats)

    sink = processed.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
    sink = sink.trigger(availableNow=True) if available_now else sink.trigger(processingTime="1 second")
    return sink.start()
