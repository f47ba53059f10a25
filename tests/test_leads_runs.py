"""Lead cycle, run control and monitoring."""

import datetime as dt
import math

from pyspark.sql import functions as F

from parley.operators import leads, monitoring, runs
from parley.plans import lead_cycle
from parley.sources.outputs import outputs_of

LEAD = (
    "_id string, conversation string, inference_status string, sagemaker_output_s3 string, sagemaker_request_id string, "
    "inference_triggered_at timestamp, inference_error string, inference_error_at timestamp, inference_result string, "
    "inference_raw_output string, inference_completed_at timestamp, etl_status string, training_run_id string, queued_at timestamp"
)
AT = "2024-02-01 00:00:00"


def lead(i, status="pending", conversation="hello", request=None, etl=None, run=None):
    return (i, conversation, status, None, request, None, None, None, None, None, None, etl, run, None)


def at():
    return F.lit(AT).cast("timestamp")


def test_dispatch(spark):
    table = spark.createDataFrame(
        [lead("a"), lead("b", conversation=""), lead("c", conversation=None), lead("d", "processing"), lead("e")], LEAD
    )
    assert [r["_id"] for r in leads.pending_leads(table, 3).collect()] == ["a", "b", "c"]
    work = lead_cycle.next_dispatch(table)
    rows = work.orderBy("_id").collect()
    assert [r["_id"] for r in rows] == ["a", "e"]
    assert rows[0]["payload"] == '{"inputs":"hello","parameters":{"max_new_tokens":512,"temperature":0.1,"do_sample":true}}'
    sent = work.select(
        "_id",
        "request_id",
        F.concat(F.lit("out/"), "request_id").alias("output_location"),
        F.when(F.col("_id") == "e", F.lit("boom")).alias("error"),
    )
    after = {r["_id"]: r for r in leads.apply_dispatch(table, sent, at()).collect()}
    assert len(after) == 5
    assert after["a"]["inference_status"] == "processing" and after["a"]["sagemaker_output_s3"].startswith("out/a-")
    assert after["e"]["inference_status"] == "error" and after["e"]["inference_error"] == "boom"
    assert after["e"]["sagemaker_request_id"] is None and after["b"]["inference_status"] == "pending"
    summary = leads.dispatch_summary(leads.pending_leads(table), sent).first().asDict()
    assert summary == {"status": "completed", "total_pending": 4, "triggered": 1, "errors": 1}
    empty = leads.dispatch_summary(leads.pending_leads(table).limit(0), sent.limit(0)).first()
    assert empty["status"] == "no_pending_data"


def test_result_ingest(spark):
    table = spark.createDataFrame([lead("a", "processing", request="a-1"), lead("b", "processing", request="b-2"), lead("c")], LEAD)
    objects = spark.createDataFrame(
        [
            ("inference-outputs/a%2D1.json", '[{"generated_text":"one"}]'),
            ("inference-outputs/a-1.out", '[{"generated_text":"two"}]'),
            ("inference-outputs/zz-9.out", "{}"),
            ("inference-outputs/", "{}"),
            ("inference-inputs/b-2.json", "{}"),
        ],
        "key string, body string",
    )
    updated, stats = leads.ingest_results(table, outputs_of(objects), at())
    assert stats.first().asDict() == {"processed": 2, "not_found": 1, "errors": 1}
    got = {r["_id"]: (r["inference_status"], r["inference_result"]) for r in updated.collect()}
    assert got == {"a": ("completed", "two"), "b": ("processing", None), "c": ("pending", None)}


def test_trigger(spark):
    table = spark.createDataFrame(
        [lead("a", etl="processed"), lead("b", etl="processed", run="run_0"), lead("c", etl="processed"), lead("d")], LEAD
    )
    assert leads.eligible_count(table).first()[0] == 2
    gate, tagged, ledger = lead_cycle.trigger_training(table, at(), threshold=2)
    assert gate.first().asDict() == {"status": "triggered", "reason": None, "eligible_records": 2, "threshold": 2}
    run = ledger.first()
    assert run["record_count"] == 2 and run["status"] == "triggered" and run["deployed"] is False
    assert {r["_id"]: r["training_run_id"] for r in tagged.collect()} == {"a": run["_id"], "b": "run_0", "c": run["_id"], "d": None}
    gate, tagged, ledger = lead_cycle.trigger_training(table, at(), threshold=3)
    assert gate.first()["reason"] == "below_threshold" and ledger.count() == 0
    assert tagged.filter("training_run_id is not null").count() == 1


def test_eval_metrics_and_gate(spark):
    df = spark.createDataFrame(
        [("low", 0.25, 4), ("half", 0.5, 1), ("half", 0.5, 3), ("edge", 1.5, 2), ("none", 3.0, 0), ("ppl", 2.5, 2)],
        "run_id string, loss double, tokens int",
    )
    got = {r["run_id"]: r for r in runs.quality_gate(runs.eval_metrics(df, "run_id")).collect()}
    assert [got[k]["quality_tier"] for k in ("low", "half", "edge", "none")] == ["excellent", "good", "needs_improvement", "needs_improvement"]
    assert got["none"]["avg_loss"] == math.inf and got["none"]["total_tokens"] == 0
    assert math.isclose(got["half"]["perplexity"], math.exp(0.5))
    assert [got[k]["reason"] for k in ("low", "half", "edge", "none", "ppl")] == [None, None, "quality_tier", "perplexity", "perplexity"]
    assert runs.eval_metrics(df.limit(0)).first()["avg_loss"] == math.inf
    missing = spark.createDataFrame([(None, 0.1, "good"), (2.0, None, "good")], "perplexity double, avg_loss double, quality_tier string")
    assert [r["reason"] for r in runs.quality_gate(missing).collect()] == ["perplexity", "val_loss"]


def test_reported_metrics_are_rounded_by_their_value(spark):
    # As doubles the first two lie below and above the tie that their shortest text shows; 0.03125 is a tie.
    values = [float.fromhex("0x1.605a1cac08312p+1"), 1.00005, 0.03125, 15.6857, 2.0, 1e9 + 0.12345]
    df = spark.createDataFrame(list(enumerate(values)), "i int, v double")
    got = [str(r[0]) for r in df.orderBy("i").select(runs.reported(F.col("v"))).collect()]
    assert got == ["2.7527", "1.0001", "0.0313", "15.6857", "2.0000", "1000000000.1235"]
    assert got[0] == f"{values[0]:.4f}" and got[1] == f"{values[1]:.4f}"


def test_run_meta(spark):
    splits = spark.createDataFrame([("train",), ("train",), ("val",), ("test",)], "split string")
    meta = runs.run_meta(splits, F.lit("r"), "p/", at()).first().asDict()
    assert meta == {"run_id": "r", "dataset_prefix": "p/r/", "train_count": 2, "val_count": 1, "created_at": "2024-02-01T00:00:00"}


def events(spark, minutes):
    base = dt.datetime(2024, 1, 31, 23, 0)
    return spark.createDataFrame([(base + dt.timedelta(minutes=m), float(v)) for m, v in minutes], "ts timestamp, value double")


def test_metric_windows(spark):
    df = events(spark, [(0, 1), (5, 2), (59, 3), (60, 10)])
    rows = monitoring.metric_windows(df, "ts", "value", "1 hour").orderBy("window_start").collect()
    assert [(r["sum"], r["avg"], r["p50"], r["p99"]) for r in rows] == [(6.0, 2.0, 2.0, 3.0), (10.0, 10.0, 10.0, 10.0)]


def test_alarm_needs_consecutive_periods(spark):
    # Periods of 15 minutes: 5, 5, none, 5, 4, 6, 7
    df = events(spark, [(0, 5), (15, 5), (45, 5), (60, 4), (75, 6), (90, 7)])
    series = monitoring.metric_windows(df, "ts", "value", "15 minutes", ("sum",))
    rows = monitoring.alarm_state(series, threshold=5).orderBy("window_start").collect()
    assert [r["sum"] for r in rows] == [5, 5, None, 5, 4, 6, 7]
    assert [r["state"] for r in rows] == ["OK", "ALARM", "OK", "OK", "OK", "OK", "ALARM"]


def test_budget_restarts_each_month(spark):
    df = events(spark, [(0, 40), (30, 1), (60, 30), (60 * 26, 11)]).withColumnRenamed("value", "cost")
    rows = monitoring.budget_alert(df).orderBy("day").collect()
    assert [(r["spend_to_date"], r["alert"]) for r in rows] == [(41.0, True), (30.0, False), (41.0, True)]
