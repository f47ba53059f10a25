"""Percentiles: exact ones for groups of any size, sketched ones on streams."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from conftest import SF
from parley.operators import monitoring
from parley.streaming.results import stream_metric_sketches, stream_metric_windows
from plans import executed

START = dt.datetime(2024, 1, 1)


def plain(rows, shares=(0.5, 0.99)):
    groups = {}
    for hour, kind, v in rows:
        groups.setdefault((START + dt.timedelta(hours=hour), kind), []).append(v)
    out = {}
    for key, values in groups.items():
        known = sorted((v for v in values if v is not None), key=lambda v: (math.isnan(v), v))
        out[key] = (len(known), *[known[max(math.ceil(p * len(known)), 1) - 1] if known else None for p in shares])
    return out


def table(spark, rows):
    data = [(START + dt.timedelta(hours=h, minutes=i % 60), k, v) for i, (h, k, v) in enumerate(rows)]
    return spark.createDataFrame(data, "ts timestamp, kind string, value double").repartition(5)


def close(got, expected):
    same = lambda a, b: a == b or (a is not None and b is not None and math.isnan(a) and math.isnan(b))
    assert got.keys() == expected.keys()
    for key in expected:
        assert all(same(a, b) for a, b in zip(got[key], expected[key], strict=True)), (key, got[key], expected[key])


def mixed():
    rng = random.Random(6)
    rows = [(h, k, rng.choice([rng.gauss(0, 1), rng.gauss(50, 1000), 0.0, -7.25])) for h in range(3) for k in ("a", None) for _ in range(200)]
    rows += [(0, "hot", rng.lognormvariate(3, 2)) for _ in range(3000)] + [(0, "same", 4.0)] * 500
    # All within one cell of the logarithmic scale: the fine cells tell them apart.
    rows += [(1, "near", 1.7e9 + i) for i in range(700)] + [(2, "tiny", i * 1e-9) for i in range(300)]
    rows += [(2, "none", None)] * 3 + [(2, "odd", v) for v in (float("nan"), float("inf"), -float("inf"), -1.0, None, 2.0)]
    rows += [(1, "huge", s * 10.0**e) for e in range(-300, 308, 7) for s in (1, -1)]
    return rows


@pytest.mark.parametrize("group_rows,cell_rows", [(100_000, 100_000), (150, 100_000), (0, 0), (0, 5)])
def test_exact_percentiles_of_any_path(spark, monkeypatch, group_rows, cell_rows):
    monkeypatch.setattr(monitoring, "GROUP_ROWS", group_rows)
    monkeypatch.setattr(monitoring, "CELL_ROWS", cell_rows)
    rows = mixed()
    windows = monitoring.metric_windows(table(spark, rows), "ts", "value", "1 hour", ("count", "p50", "p99", "p0", "p100"), by=("kind",))
    got = {(r.window_start, r.kind): (r["count"], r.p50, r.p99, r.p0, r.p100) for r in windows.collect()}
    close(got, plain(rows, (0.5, 0.99, 0.0, 1.0)))


def test_a_large_group_is_never_put_in_order(spark, monkeypatch):
    """Of a group selected by counting only the values of the cut cells reach a sort."""
    monkeypatch.setattr(monitoring, "GROUP_ROWS", 100)
    rng = random.Random(2)
    rows = [(0, "hot", rng.lognormvariate(3, 1)) for _ in range(20_000)]
    seen = []
    in_order = monitoring._in_order
    monkeypatch.setattr(monitoring, "_in_order", lambda near, facts: seen.append(near) or in_order(near, facts))
    windows = monitoring.metric_windows(table(spark, rows), "ts", "value", "1 hour", ("p50", "p99"), by=("kind",))
    assert [(r.p50, r.p99) for r in windows.collect()] == [plain(rows)[START, "hot"][1:]]
    assert sum(df.count() for df in seen) < 200
    plan = executed(windows)
    assert "collect_list" not in plan.split("_cell")[0] or "_large" in plan


def test_percentiles_on_a_stream(spark, tmp_path):
    events = spark.read.parquet(f"{SF}/events.parquet").select(F.col("ts").cast("timestamp").alias("ts"), "event_type", "value")
    events.repartition(3).write.parquet(f"{tmp_path}/events")
    source = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/events")
    stats = ("sum", "count", "p50", "p99")
    streamed = stream_metric_windows(source, "ts", "value", "30 days", "100 days", stats, by=("event_type",))
    streamed.writeStream.format("memory").queryName("monthly").outputMode("complete").trigger(availableNow=True).start().awaitTermination()
    exact = monitoring.metric_windows(events, "ts", "value", "30 days", stats, by=("event_type",))
    expected = {(r.window_start, r.event_type): r for r in exact.collect()}
    values = {}
    for r in events.select(F.window("ts", "30 days").start.alias("w"), "event_type", "value").collect():
        values.setdefault((r.w, r.event_type), []).append(r.value)
    got = spark.table("monthly").collect()
    assert len(got) == len(expected)
    for r in got:
        e, own = expected[r.window_start, r.event_type], values[r.window_start, r.event_type]
        assert r["count"] == e["count"] and math.isclose(r["sum"], e["sum"])
        for p, share in ((r.p50, 0.5), (r.p99, 0.99)):
            below, upto = sum(v < p for v in own), sum(v <= p for v in own)
            slack = 0.01 * len(own) + 1
            assert below - slack <= share * len(own) <= upto + slack


def test_sketches_of_hours_merge_to_days(spark, tmp_path):
    rng = random.Random(4)
    rows = [(h, "a", rng.gauss(100, 30)) for h in range(24) for _ in range(300)] + [(3, "b", None)]
    df = table(spark, rows)
    df.write.parquet(f"{tmp_path}/events")
    source = spark.readStream.schema(df.schema).parquet(f"{tmp_path}/events")
    hourly = stream_metric_sketches(source, "ts", "value", "1 hour", "1 hour", ("kind",))
    hourly.writeStream.format("memory").queryName("hourly").outputMode("complete").trigger(availableNow=True).start().awaitTermination()
    daily = monitoring.merge_sketches(spark.table("hourly"), "1 day", ("kind",))
    got = {r.kind: r for r in monitoring.sketched_windows(daily, ("sum", "count", "p50", "p99"), ("kind",)).collect()}
    own = sorted(v for _, k, v in rows if k == "a")
    assert got["a"]["count"] == len(own) and math.isclose(got["a"]["sum"], sum(own)) and got["b"].p50 is None
    for p, share in ((got["a"].p50, 0.5), (got["a"].p99, 0.99)):
        assert abs(sum(v <= p for v in own) / len(own) - share) < 0.01
