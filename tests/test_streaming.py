"""Streams: same results as the batch operators, idempotent, bounded."""

import datetime as dt
import json

from pyspark.sql import functions as F

from conftest import SF
from parley.operators import leads as lead_ops
from parley.operators import merges, monitoring, records
from parley.plans.etl import EtlLayout, read_status_log, run_etl
from parley.sources.topics import DEAD_LETTERS, PROCESSED, RAW, FolderTopics, KafkaTopics
from parley.streaming import etl
from parley.streaming.results import stream_metric_windows, stream_results

DOC = "doc_id string, batch_num long, record_index long, user string, assistant string, etl_status string"


def docs(spark):
    rows = [(f"m{i}", 1, i, f"user {i} a@b.co", "{}", "pending") for i in range(8)]
    rows += [("bad1", 1, 8, "  ", "{}", "pending"), ("bad2", 1, 9, None, "{}", "pending"), ("bad3", 1, 10, "u", "", "pending")]
    return spark.createDataFrame(rows, DOC)


def as_set(df):
    return {tuple(r) for r in df.collect()}


def test_transform_stream_equals_batch(spark, tmp_path):
    raw, out = FolderTopics(f"{tmp_path}/raw"), FolderTopics(f"{tmp_path}/out")
    assert etl.run_extract(docs(spark).repartition(4), raw) == 11
    query = etl.stream_transform(raw.stream(spark, RAW, 1), out, f"{tmp_path}/cp")
    query.awaitTermination()
    assert len([p for p in query.recentProgress if p["numInputRows"]]) > 1  # one file per micro-batch
    batch = etl.transform_rows(raw.read(spark, RAW))
    streamed = out.read(spark, PROCESSED).union(out.read(spark, DEAD_LETTERS))
    assert as_set(streamed.select("topic", "key", "value")) == as_set(batch)
    dead = [json.loads(r["value"]) for r in out.read(spark, DEAD_LETTERS).collect()]
    assert {d["mongo_id"]: d["_dlq_reason"] for d in dead} == {
        "bad1": "Quality check failed: Empty user content after PII clean",
        "bad2": "Quality check failed: null user content",
        "bad3": "Quality check failed: Empty assistant content after PII clean",
    }
    # Nothing new: a second run with the same checkpoint adds nothing.
    etl.stream_transform(raw.stream(spark, RAW), out, f"{tmp_path}/cp").awaitTermination()
    assert out.read(spark, PROCESSED).count() == 8


def test_malformed_messages_become_dead_letters(spark):
    df = spark.createDataFrame([("k", "not json", RAW), ("k", "[1]", RAW), ("k", "{}", RAW)], "key string, value string, topic string")
    rows = etl.transform_rows(df).collect()
    assert [r["topic"] for r in rows] == [DEAD_LETTERS] * 3 and all(r["key"] is None for r in rows)
    assert json.loads(rows[0]["value"]) == {"raw_value": "not json", "_dlq_reason": "not a JSON object"}


def test_load_batch_replay_and_redelivery(spark, tmp_path):
    rows = etl.transform_rows(records.to_messages(docs(spark), RAW)).filter(F.col("topic") == PROCESSED).select("key", "value", "topic")
    store, stats = f"{tmp_path}/store", f"{tmp_path}/stats"
    etl.open_store(spark, store)
    etl.load_batch(rows, "w-0", store, f"{tmp_path}/rejects", None, stats)
    etl.load_batch(rows, "w-0", store, f"{tmp_path}/rejects", None, stats)  # replay of the same batch
    assert spark.read.parquet(store).count() == 8
    more = rows.union(rows).union(spark.createDataFrame([("k", "broken", PROCESSED)], rows.schema))
    etl.load_batch(more, "w-1", store, f"{tmp_path}/rejects", None, stats)  # redelivery, twice over
    assert spark.read.parquet(store).count() == 8
    got = {r["load_id"]: (r["loaded"], r["inserted"], r["skipped"], r["failed"]) for r in spark.read.parquet(stats).collect()}
    assert got == {"w-0": (8, 8, 0, 0), "w-1": (16, 0, 16, 1)}
    assert [r["raw_value"] for r in spark.read.parquet(f"{tmp_path}/rejects").collect()] == ["broken"]


def check_run(spark, tmp_path, parallel):
    layout = EtlLayout.folders(f"{tmp_path}/run")
    table = docs(spark)
    summary = run_etl(spark, table, layout, parallel=parallel).first().asDict()
    assert summary == {"published": 11, "transformed": 8, "failed": 3, "dlq": 3, "loaded": 8, "inserted": 8, "skipped": 0}
    status = merges.apply_status_log(table, read_status_log(spark, layout.status_log))
    got = {r["doc_id"]: r["etl_status"] for r in status.collect()}
    assert got == {**{f"m{i}": "done" for i in range(8)}, "bad1": "failed", "bad2": "failed", "bad3": "failed"}
    row = spark.read.parquet(layout.store).filter("source_id = 'm3'").first()
    assert row["conversations"][1]["content"] == "user 3 [EMAIL]" and row["metadata"]["record_index"] == 3

    again = run_etl(spark, table, EtlLayout.folders(f"{tmp_path}/run2", layout.store, layout.status_log), parallel=parallel)
    assert again.first().asDict()["inserted"] == 0 and spark.read.parquet(layout.store).count() == 8
    left = status.filter(F.col("etl_status") == "pending")
    nothing = run_etl(spark, left, EtlLayout.folders(f"{tmp_path}/run3"))
    assert set(nothing.first().asDict().values()) == {0}


def test_run_etl(spark, tmp_path):
    check_run(spark, tmp_path, parallel=False)


def test_run_etl_in_parallel(spark, tmp_path):
    check_run(spark, tmp_path, parallel=True)


def test_results_stream(spark, tmp_path):
    folder = tmp_path / "inference-outputs"
    folder.mkdir()
    (folder / "a-1.out").write_text('[{"generated_text":"x"}]')
    log, cp = f"{tmp_path}/log", f"{tmp_path}/cp"
    stream_results(spark, str(folder), log, cp).awaitTermination()
    (folder / "b-2.out").write_text('{"generated_text":"y"}')
    stream_results(spark, str(folder), log, cp).awaitTermination()
    table = spark.createDataFrame(
        [("a", "processing", "a-1", None, None, None), ("b", "processing", "b-2", None, None, None)],
        "_id string, inference_status string, sagemaker_request_id string, inference_result string, inference_raw_output string, inference_completed_at timestamp",
    )
    updated, stats = lead_ops.ingest_results(table, spark.read.parquet(log), F.current_timestamp())
    assert {r["_id"]: r["inference_result"] for r in updated.collect()} == {"a": "x", "b": "y"}
    assert stats.first().asDict() == {"processed": 2, "not_found": 0, "errors": 0}


def test_metric_stream_equals_batch(spark, tmp_path):
    events = spark.read.parquet(f"{SF}/events.parquet").select("ts", F.col("value").cast("decimal(10,2)").alias("value"))
    src = f"{tmp_path}/events"
    events.write.parquet(src)
    streamed = stream_metric_windows(spark.readStream.schema(events.schema).parquet(src), "ts", "value", "1 day", "1 hour")
    query = streamed.writeStream.format("memory").queryName("daily").outputMode("complete").trigger(availableNow=True).start()
    query.awaitTermination()
    batch = monitoring.metric_windows(events.withColumn("ts", F.col("ts").cast("timestamp")), "ts", "value", "1 day", ("sum", "avg"))
    assert as_set(spark.table("daily")) == as_set(batch)


def test_kafka_topics_need_the_connector(spark):
    topics = KafkaTopics("localhost:9092")
    try:
        topics.read(spark, RAW)
    except Exception as e:
        assert "kafka" in str(e).lower()


def test_status_log_order(spark):
    log = spark.createDataFrame([("a", "done", dt.datetime(2024, 1, 2)), ("a", "in_progress", dt.datetime(2024, 1, 1))], "doc_id string, status string, at timestamp")
    table = spark.createDataFrame([("a", "pending")], "doc_id string, etl_status string")
    assert merges.apply_status_log(table, log).first()["etl_status"] == "done"
