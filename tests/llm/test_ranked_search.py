"""Ranked search: against plain scoring of every document, with ties, blocks, shards and the odd inputs."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from parley.llm import ranked_search
from parley.llm.ranked_search import Shard, ranked_documents, terms_of

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return [w.translate(LOWER) for w in TERM.findall(text or "")]


def plain(docs, items, k=50):
    counted = [(i, Counter(words(t))) for i, t in docs]
    counted = [(i, c, sum(c.values())) for i, c in counted if c]
    n_docs, length = len(counted), sum(n for _, _, n in counted)
    df = Counter(t for _, c, _ in counted for t in c)
    out = []
    for item, text in items:
        scores = []
        for i, c, n in counted:
            m = 100 - 50 + (50 * n * n_docs) // length
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 20 * m))
                for t in set(words(text))
                if c[t]
            )
            if score > 0:
                scores.append((-score, i is None, i or 0, i))
        out += [(item, r + 1, s[3], -s[0]) for r, s in enumerate(sorted(scores)[:k])]
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def tables(spark, docs, items):
    return (
        spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, score int"),
        spark.createDataFrame([(*i, 1) for i in items], "item_id long, text string, doc_id int"),
    )


def made(seed, n_docs, n_items):
    rng = random.Random(seed)
    known = ["Alpha", "beta", "ñandú", "ÉTÉ", "été", "x1", "1", "日本", "a_b", "it's"] + [f"w{i}" for i in range(60)]
    weights = [1 / (i + 1) for i in range(len(known))]
    text = lambda top: rng.choice([" ", "-", "\n"]).join(rng.choices(known, weights, k=rng.randint(0, top)))
    docs = [(i, text(40)) for i in range(n_docs)]
    docs += [(n_docs + i, docs[i % 5][1]) for i in range(30)] + [(None, docs[1][1]), (3, docs[1][1]), (3, docs[1][1])]
    docs += [(9000, None), (9001, ""), (9002, "--- ,"), (9003, "beta " * 50_000)]
    items = [(i, text(12)) for i in range(n_items)] + [(None, "beta w3"), (2, "w5 w6"), (500, None), (501, ""), (502, "nowhere")]
    return docs, items


@pytest.mark.parametrize("shard,block,k", [(1 << 20, 1 << 20, 50), (40, 300, 5), (1, 100, 3)])
def test_ranks_equal_plain_scoring(spark, monkeypatch, shard, block, k):
    monkeypatch.setattr(ranked_search, "SHARD_POSTINGS", shard)
    docs, items = made(k, 150, 12)
    d, i = tables(spark, docs, items)
    assert found(ranked_documents(d.repartition(5), i, k, block_bytes=block)) == plain(docs, items, k)


def test_empty_tables(spark):
    docs, items = made(1, 5, 3)
    d, i = tables(spark, docs, items)
    none_d, none_i = tables(spark, [], [])
    for a, b in ((none_d, i), (d, none_i), (none_d, none_i), (d.where("doc_id = 9002"), i)):
        got = ranked_documents(a, b)
        assert got.count() == 0 and got.columns == ["item_id", "rank", "doc_id", "score"]


def test_terms_equal_the_pattern():
    rng = random.Random(4)
    letters = [*"aZ09_-'.@[`{~\x7f\x00\t\n ", "é", "É", " ", "日", "😀", " "]
    for _ in range(2000):
        text = "".join(rng.choices(letters, k=rng.randint(0, 30)))
        assert [t.decode() for t in terms_of(text.encode())] == words(text)


def test_accumulators_stop_and_survivors_stay_exact():
    """A rare term fills the ranking, so the common one makes no accumulator but still counts for the others."""
    rng = np.random.default_rng(5)
    n = 4000
    rare = np.sort(rng.choice(n, 60, replace=False))
    terms, counts, sizes = [], [], []
    for d in range(n):
        own = [1] + ([0] if d in set(rare.tolist()) else [])
        terms += own
        counts += rng.integers(1, 4, len(own)).tolist()
        sizes.append(len(own))
    shard = Shard(np.full(n, 10), np.array(sizes), np.array(terms), np.array(counts), n, 10 * n)
    weight = np.array([9000, 10])
    alive, score = shard.search([0, 1], weight, 50)
    assert set(alive.tolist()) <= set(rare.tolist()) and len(alive) >= 50
    full = np.zeros(n, np.int64)
    for t in (0, 1):
        lo, hi = shard.span[t]
        full[shard.doc[lo:hi]] += weight[t] * shard.impact[lo:hi]
    assert (score == full[alive]).all() and score.min() >= np.sort(full)[-50]
    assert not shard.score.any() and not shard.has.any()
    assert len(shard.search([1], weight, 50)[0]) >= 50


def test_query_equals_plain_scoring_on_the_table(spark):
    from conftest import SF
    from parley.llm.queries import QUERIES

    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert found(QUERIES["op12_ranked_search"](spark, SF)) == plain(docs, items)
