"""Keyed merges."""

import pytest
from pyspark.sql import functions as F

from parley.operators import merges


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def test_latest_per_key(spark):
    df = spark.createDataFrame([(1, "a", 1), (1, "b", 3), (1, "c", 2), (2, None, 1)], "k int, s string, v int")
    assert rows(merges.latest_per_key(df, ["k"], "v"), "k") == [(1, "b", 3), (2, None, 1)]
    assert rows(merges.latest_per_key(df.select("k"), ["k"], "k"), "k") == [(1,), (2,)]
    assert rows(merges.first_per_key(df, ["k"], "v"), "k") == [(1, "a", 1), (2, None, 1)]


@pytest.mark.parametrize("parts", [1, 2, 3, 5])
def test_choice_does_not_depend_on_partitions(spark, parts):
    df = spark.createDataFrame([(1, x, 1) for x in "zxyzx"], "k int, s string, v int").repartition(parts)
    assert rows(merges.latest_per_key(df, ["k"], "v"), "k") == [(1, "z", 1)]
    assert rows(merges.first_per_key(df, ["k"]), "k") == [(1, "x", 1)]
    assert rows(merges.insert_if_absent(df.limit(0), df, "k"), "k") == [(1, "x", 1)]


def test_upsert_replace(spark):
    target = spark.createDataFrame([(1, 0, "old"), (1, 1, "old")], "b int, i int, s string")
    source = spark.createDataFrame([(1, 1, "v1", 1), (1, 1, "v2", 2), (2, 0, "new", 1)], "b int, i int, s string, v int")
    assert rows(merges.upsert_replace(target, source, ["b", "i"], "v"), "b", "i") == [(1, 0, "old"), (1, 1, "v2"), (2, 0, "new")]


def test_insert_if_absent_twice_is_once(spark):
    store = spark.createDataFrame([("a", 1)], "source_id string, n int")
    source = spark.createDataFrame([("a", 9), ("b", 2), ("b", 2)], "source_id string, n int")
    once = merges.insert_if_absent(store, source, "source_id")
    assert rows(once, "source_id") == [("a", 1), ("b", 2)]
    assert rows(merges.insert_if_absent(once, source, "source_id"), "source_id") == [("a", 1), ("b", 2)]


def test_bulk_upsert(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (9, "z")], "k int, s string")
    source = spark.createDataFrame([(1, "a"), (2, "B"), (3, None), (4, "d"), (None, "x")], "k int, s string")
    merged, stats = merges.bulk_upsert(target, source, "k", overwrite=True)
    assert rows(merged, "k") == [(1, "a"), (2, "B"), (3, None), (4, "d"), (9, "z")]
    assert stats.first().asDict() == {"inserted": 1, "updated": 1, "skipped": 2, "failed": 1}
    merged, stats = merges.bulk_upsert(target, source, "k")
    assert rows(merged, "k") == [(1, "a"), (2, "b"), (3, None), (4, "d"), (9, "z")]
    assert stats.first().asDict() == {"inserted": 1, "updated": 0, "skipped": 3, "failed": 1}
    merged, stats = merges.bulk_upsert(target, source, "k", overwrite=True, dry_run=True)
    assert merged is target
    assert stats.first().asDict() == {"inserted": 0, "updated": 0, "skipped": 0, "failed": 1}


def test_status(spark):
    docs = spark.createDataFrame([("a", "pending"), ("b", "pending"), ("c", "done")], "doc_id string, etl_status string")
    ids = spark.createDataFrame([("a",), ("a",), ("zz",)], "doc_id string")
    assert rows(merges.set_status(docs, ids, "done"), "doc_id") == [("a", "done"), ("b", "pending"), ("c", "done")]
    log = spark.createDataFrame([("a", "in_progress", 1), ("a", "done", 2), ("b", "failed", 5)], "doc_id string, status string, at int")
    assert rows(merges.apply_status_log(docs, log), "doc_id") == [("a", "done"), ("b", "failed"), ("c", "done")]


def test_skip_done(spark):
    work = spark.createDataFrame([(1,), (2,)], "batch_num int")
    done = spark.createDataFrame([(2,), (2,)], "batch_num int")
    assert rows(merges.skip_done(work, done, "batch_num"), "batch_num") == [(1,)]


def test_run_report(spark):
    metrics = spark.createDataFrame([("r1", 0.5, None, "good", 3)], "run_id string, val_loss double, perplexity double, quality_tier string, record_count int")
    none = spark.createDataFrame([], "run_id string, model_s3_prefix string, model_package_arn string, endpoint_name string, status string")
    reg = none.union(spark.createDataFrame([("r1", "p", "arn", "e", "s")], none.schema))
    got = merges.run_report(metrics, none, reg, none).first().asDict()
    assert got == {
        "run_id": "r1",
        "val_loss": "0.5",
        "perplexity": "n/a",
        "quality_tier": "good",
        "record_count": "3",
        "model_s3_prefix": "n/a",
        "model_package_arn": "arn",
        "endpoint_name": "n/a",
        "deployment_status": "n/a",
    }


def test_hot_key_is_thinned_before_the_shuffle(spark):
    # One key holds a third of the rows: the map side sends one row per task for it.
    df = spark.range(30000).select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"), "id")
    out = merges.latest_per_key(df, ["k"], "id")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("partial_max") >= 1
    assert out.filter("k = 0").first()["id"] == 29997
