"""Driver contract: entry, queries and their SQL agree on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SF
from plans import no_python

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
# Kept to a few queries: tools/check_oracle.py compares all of them.
SAMPLE = ["mask_pii", "split_assign", "etl_transform", "verify_jsonl", "unified_index", "bulk_upsert_stats", "stream_load"]


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for name in TABLES.split():
        con.execute(f"create view {name} as select * from '{SF}/{name}.parquet'")
    return con


def test_entry(spark):
    counts = {r["split"]: r["n"] for r in entry.entry(spark).collect()}
    assert set(counts) == {"train", "val", "test"} and counts["train"] > counts["val"]


def test_every_query_has_sql():
    assert set(entry.QUERIES) == set(entry.ORACLE)


@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_sql(spark, db, name):
    df = entry.queries()[name](spark, SF)
    result = db.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(columns)
    expected = sorted(map(str, result.fetchall()))
    assert sorted(str(tuple(r)) for r in df.select(*[f"`{c}`" for c in columns]).collect()) == expected


@pytest.mark.parametrize("name", ["mask_pii", "clean_records", "etl_transform", "label_audit", "pack_sequences"])
def test_default_paths_stay_in_the_jvm(spark, name):
    assert no_python(entry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString())
