"""URL rules and aliases: against plain code, and the odd inputs."""

import random

import duckdb
import pytest

from parley.llm.oracle import ORACLE
from parley.llm.queries import QUERIES
from parley.llm.urls import RULES, judge_urls

SCHEMA = "page_id long, url string, html string, host string, alias string"


def canonical(to):
    return f'<html><head><LINK rel="canonical" href="{to}"></head><p>x</p></html>'


def judged(spark, rows, **more):
    df = spark.createDataFrame([(*r, "h", "a") for r in rows], SCHEMA)
    return {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in judge_urls(df, **more).collect()}


def test_rules_and_parts(spark):
    rows = [
        (1, "http://WWW.Example.ORG/es/x?q#f", None),
        (2, "https://example.org/en/12", ""),
        (3, "https://example.org/en/2", "<p>"),
        (4, "x://notexample.org", None),
        (5, "http://a.com/fr/", None),
        (6, "http://com/de/ü?x", None),
        (7, None, canonical("http://com/de/")),
        (8, "no scheme com/de/", canonical("http://com/de/")),
        (9, "http://É.COM?x/y", None),
        (10, "", None),
        (11, "a://b://c/d", None),
        (12, "http://org/", None),
        (13, "http://borg/", None),
    ]
    assert judged(spark, rows) == {
        1: ("www.example.org", "/es/x", "example.org/es/", "block"),
        2: ("example.org", "/en/12", "example.org/en/1", "block"),
        3: ("example.org", "/en/2", "org/", "allow"),
        4: ("notexample.org", "", None, "allow"),
        5: ("a.com", "/fr/", "com/fr/", "allow"),
        6: ("com", "/de/ü", "com/de/", "block"),
        7: ("", "", None, "allow"),
        8: ("", "", None, "allow"),
        9: ("É.com", "", None, "allow"),
        10: ("", "", None, "allow"),
        11: ("b:", "//c/d", None, "allow"),
        12: ("org", "/", "org/", "allow"),
        13: ("borg", "/", None, "allow"),
    }


def test_blocks_reach_aliases_and_allows_stay(spark):
    rows = [
        (1, "http://a.net/1", canonical("http://b.com/de/1")),  # alias of a blocked address that is no page here
        (2, "https://a.net/2#top", canonical("/1")),  # alias of an alias
        (3, "http://a.net/dir/3", "<meta http-equiv='refresh' content='0; url=../x'><meta http-equiv=refresh content=\"1;URL='//a.net/2'\">"),
        (4, "http://x.org/4", canonical("http://a.net/9")),  # allowed itself
        (5, "http://a.net/9", canonical("http://b.com/de/9")),  # its chain holds an allowed address
        (6, "http://a.net/1?x=1&y=2", canonical("?x=1&amp;y=3")),
        (7, "http://a.net/1?x=1&y=3", canonical("mailto:x@com/de/")),
        (8, "http://c.net", canonical("sub/8")),
        (9, "http://c.net/sub/8", canonical("http://com/de/8")),
        (9, "http://c.net/sub/8", canonical("http://com/de/8")),
        (10, "http://d.net/1", "<link rel=stylesheet href='http://com/de/1'><a href=http://com/de/1>"),
    ]
    got = judged(spark, rows)
    assert {k: v[3] for k, v in got.items()} == {
        1: "block", 2: "block", 3: "block", 4: "allow", 5: "allow", 6: "allow", 7: "allow", 8: "block", 9: "block", 10: "allow",
    }
    links = spark.createDataFrame([("d.net/1", "e.net/1"), ("e.net/1", "com/de/1"), (None, "x"), ("q", "q")], "a string, b string")
    assert judged(spark, rows, links=links)[10][3] == "block"
    assert judged(spark, []) == {}


@pytest.mark.parametrize("seed", [0, 1])
def test_query_equals_sql_on_random_links(spark, tmp_path, seed):
    rng = random.Random(seed)
    hosts = ["a.net", "b.com", "example.org", "w.example.org", "c.net"]
    paths = ["", "/", "/de/1", "/fr/1", "/es/2", "/en/1", "/x", "/x/y"]
    urls = [f"http://{h}{p}" for h in hosts for p in paths]
    rows = [(i, rng.choice([*urls, None, "odd"]), canonical(rng.choice([*urls, "/x", "y", "#", ""])) if rng.random() < 0.4 else None) for i in range(150)]
    spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1).write.parquet(f"{tmp_path}/pages.parquet")
    got = QUERIES["op6_url_filter"](spark, str(tmp_path))
    con = duckdb.connect()
    con.execute(f"create view pages as select * from '{tmp_path}/pages.parquet/*.parquet'")
    result = con.execute(ORACLE["op6_url_filter"])
    columns = [d[0] for d in result.description]
    expected = sorted(map(str, result.fetchall()))
    assert sorted(columns) == sorted(got.columns)
    assert sorted(str(tuple(r)) for r in got.select(*columns).collect()) == expected
    assert any("block" in e for e in expected) and len(RULES) == 5
