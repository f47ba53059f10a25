"""Ranks, splits and the global index: exactness, independence of partitioning, plans."""

import hashlib
import math

import pytest
from pyspark.sql import functions as F

from conftest import SF
from parley.operators import ranks, records
from plans import executed, exchanges


def py_split(ids, cuts=(0.70, 0.85)):
    order = sorted(ids, key=lambda i: hashlib.md5(f"42:{i}".encode()).hexdigest())
    marks = [math.floor(c * len(ids)) for c in cuts]
    return {i: sum(r >= m for m in marks) for r, i in enumerate(order)}


@pytest.mark.parametrize("n", [0, 1, 2, 3, 7, 20, 1000])
def test_split_is_exact(spark, n):
    rows = ranks.split_assign(spark.range(n), "id").collect()
    names = ["train", "val", "test"]
    assert {r["id"]: names.index(r["split"]) for r in rows} == py_split(range(n))


def test_split_does_not_depend_on_partitions(spark):
    ids = spark.range(5000)
    a = ranks.split_assign(ids.repartition(1), "id").select("id", "split")
    b = ranks.split_assign(ids.repartition(13), "id").select("id", "split")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_split_with_a_hot_key(spark):
    # A third of the rows share one key: they stay together and nothing is lost.
    keys = spark.range(3000).withColumn("k", F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")))
    out = ranks.split_assign(keys, "k")
    assert out.count() == 3000
    assert out.filter("k = -1").select("split").distinct().count() == 1


def test_extreme_cuts(spark):
    for cut, expected in ((0.0, {"b": 10}), (1.0, {"a": 10})):
        out = ranks.split_assign(spark.range(10), "id", cuts=(cut,), names=("a", "b"))
        assert {r["split"]: r["n"] for r in ranks.split_counts(out).collect()} == expected
    with pytest.raises(ValueError):
        ranks.split_assign(spark.range(1), "id", cuts=(0.5,))


def test_split_moves_no_rows(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet")
    plan = executed(ranks.split_assign(rows, "doc_id"))
    main, _, subqueries = plan.partition("Subquery")
    assert exchanges(main) == []
    # The passes over the digests read the key column only.
    assert "ReadSchema: struct<doc_id:bigint>" in subqueries


def test_global_rank(spark):
    orders = spark.read.parquet(f"{SF}/orders.parquet").repartition(5)
    for parts in (None, 1, 4, 16):
        ranked = ranks.global_rank(orders, "o_orderdate", "o_orderkey", partitions=parts).collect()
        assert sorted(r["rank"] for r in ranked) == list(range(len(ranked)))
        in_order = sorted(ranked, key=lambda r: r["rank"])
        assert in_order == sorted(in_order, key=lambda r: (r["o_orderdate"], r["o_orderkey"]))


def test_global_rank_with_a_hot_leading_key(spark):
    df = spark.range(9000).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"), "id")
    placed = ranks._range_positions(df, "k", "id", partitions=8)
    largest = max(r["count"] for r in placed.groupBy("_part").count().collect())
    assert largest < 9000 / 3
    assert ranks.global_rank(df, "k", "id").agg(F.count_distinct("rank"), F.max("rank")).first() == (9000, 8999)


def test_prefix_sum(spark):
    df = spark.createDataFrame([(f"f{i:03d}", i) for i in range(100)], "f string, n int").repartition(7)
    got = {r["f"]: r["before"] for r in ranks.prefix_sum(df, "f", "n", "before").collect()}
    assert got == {f"f{i:03d}": sum(range(i)) for i in range(100)}


@pytest.mark.parametrize("limit", [1000, 3])
def test_global_index_with_and_without_broadcast(spark, monkeypatch, limit):
    monkeypatch.setattr(ranks, "broadcast_if_small", lambda df: _limited(df, limit))
    sizes = {"batch_1.json": 50, "batch_10.json": 3, "batch_2.json": 1, "batch_3.json": 4}
    rows = [(f, i) for f, n in sizes.items() for i in range(n)]
    df = spark.createDataFrame(rows, "f string, pos int").repartition(5)
    got = {(r["f"], r["pos"]): r["global_index"] for r in ranks.global_index(df, "f", "pos").collect()}
    assert got == {key: i for i, key in enumerate(sorted(rows))}


def _limited(df, limit):
    small = df.count() <= limit
    return (F.broadcast(df) if small else df), small


def test_broadcast_only_when_counted_small(spark):
    assert ranks.broadcast_if_small(spark.range(5), 5)[1] is True
    assert ranks.broadcast_if_small(spark.range(6), 5)[1] is False


def test_merge_batches_is_a_bag_union(spark):
    a, b = spark.createDataFrame([(1, "x")], "i int, s string"), spark.createDataFrame([(1,), (1,)], "i int")
    assert sorted(map(tuple, records.merge_batches(a, b, a).collect()), key=str) == [(1, "x"), (1, "x"), (1, None), (1, None)]
