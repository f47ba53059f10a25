"""Exact duplicates: against plain code, with equal digests, ties and the odd inputs."""

import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from parley.llm.exact import exact_groups, first_of_equal

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def body(text):
    return (text or "").translate(LOWER)


def checked(rows, got):
    """(doc_id, text) rows against results with doc_id, keep_id, group_size, kept."""
    groups = defaultdict(list)
    for i, text in rows:
        groups[body(text)].append(i)
    expected, stays = [], []
    for ids in groups.values():
        known = [i for i in ids if i is not None]
        top = max(known) if known else None
        expected += [(i, top, len(ids)) for i in ids]
        stays.append(top)
    assert sorted([(r.doc_id, r.keep_id, r.group_size) for r in got], key=str) == sorted(expected, key=str)
    assert sorted([r.doc_id for r in got if r.kept], key=str) == sorted(stays, key=str)
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


ROWS = [(1, "Abc"), (2, "aBC"), (3, "abc "), (4, None), (5, ""), (6, "É"), (7, "é"), (8, "É"), (9, "İX"), (10, "İx"), (11, "i̇x")]
ROWS += [(12, "ẞ"), (12, "ẞ"), (12, "ẞ"), (None, "Abc"), (None, "lone"), (None, "Lone"), (None, None), (13, "Ⅳ"), (14, "ⅳ")]
ROWS += [(100 + i, "x" * 300_000 + "Yz"[i % 2]) for i in range(6)] + [(200 + i, "hot") for i in range(400)]


@pytest.mark.parametrize("digest_bytes", [32, 1, 0])
def test_groups_equal_plain_code(spark, digest_bytes):
    df = spark.createDataFrame(ROWS, "doc_id long, text string").repartition(7)
    digest = lambda c: F.substring(F.unhex(F.sha2(c, 256)), 1, digest_bytes)
    checked(ROWS, exact_groups(df, digest=digest, salts=5).collect())


def test_digest_is_that_of_the_normalised_text(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string")
    got = exact_groups(df, columns=["doc_id", "text"]).collect()
    assert len(got) == len(ROWS)
    assert all(r.digest == hashlib.sha256(body(r.text).encode()).digest() for r in got)


def test_clashing_names_and_rows_that_stay(spark):
    names = "doc_id long, text string, digest string, row int, salt int, own int, kept string, body string, top int, n int"
    df = spark.createDataFrame([(i, t, "d", 1, 2, 3, "k", "b", 4, 5) for i, t in ROWS], names)
    got = exact_groups(df)
    assert got.columns == ["doc_id", "row", "salt", "own", "body", "top", "n", "keep_id", "group_size", "kept", "digest"]
    checked(ROWS, got.collect())
    left = first_of_equal(df)
    assert left.columns == df.columns and left.count() == len({body(t) for _, t in ROWS})


def test_text_ids_and_empty_table(spark):
    rows = [("b", "x"), ("a", "X"), (None, "x"), ("c", "y")]
    checked(rows, exact_groups(spark.createDataFrame(rows, "doc_id string, text string")).collect())
    assert exact_groups(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_texts_combine_in_the_task_and_in_salts_without_python(spark):
    from plans import no_python

    from parley.llm.exact import normalised, sha256, text_totals

    rows = spark.createDataFrame(ROWS, "doc_id long, text string").repartition(7)
    rows = rows.select("doc_id", normalised(F.col("text")).alias("body")).withColumn("digest", sha256(F.col("body")))
    plan = text_totals(rows)._jdf.queryExecution().sparkPlan().toString()
    assert "Exchange" in text_totals(rows)._jdf.queryExecution().executedPlan().toString() and no_python(plan)
    # Combined before each of the two movements of texts; counting a digest's texts needs none.
    executed = text_totals(rows)._jdf.queryExecution().executedPlan().toString()
    assert executed.count("Exchange hashpartitioning(") == 2
    assert "partial_max(doc_id" in executed


def test_query_equals_plain_code_on_the_table(spark):
    from conftest import SF
    from parley.llm.queries import QUERIES

    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = QUERIES["op11_exact_dedup"](spark, SF).collect()
    checked(rows, got)
    by_id = dict(rows)
    assert all(r.text_sha256 == hashlib.sha256(body(by_id[r.doc_id]).encode()).hexdigest() for r in got)
