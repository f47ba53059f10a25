"""Near copies by fingerprint: against brute force, and the odd inputs."""

import random

import numpy as np
import pytest
import xxhash

from parley.llm import simhash
from parley.llm.simhash import first_of_group, fit_tree, link_labels, near_links, route, simhash_groups


def plain_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in __import__("re").split("[\x20\x09-\x0d]+", low) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    bits = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    return bits - (1 << 64) if bits >> 63 else bits


def plain_groups(rows):
    """{(id, fp): component id} by union of all pairs."""
    fps = [plain_fingerprint(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if bin((fps[i] ^ fps[j]) & (2**64 - 1)).count("1") <= 3:
                parent[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        r = find(i)
        least[r] = d if least.get(r) is None else least[r] if d is None else min(d, least[r])
    return sorted(((d, fps[i], least[find(i)]) for i, (d, _) in enumerate(rows)), key=str)


def texts(n, seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    out = []
    for _ in range(n):
        if out and rng.random() < 0.5:
            base = rng.choice(out).split(" ")
            for _ in range(rng.randint(0, 2)):
                base[rng.randrange(len(base))] = rng.choice(words)
            out.append(" ".join(base))
        else:
            out.append(" ".join(rng.choices(words, k=rng.randint(1, 120))))
    return out


def test_groups_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(simhash, "RESIDENTS", 16)
    monkeypatch.setattr(simhash, "VISITORS", 16)
    monkeypatch.setattr(simhash, "LEAF", 8)
    rows = list(enumerate(texts(260, 1))) + [(900, None), (901, ""), (902, " \n"), (None, "a b"), (None, "a b"), (3, "x")]
    rows += [(950, "Été " * 5000), (951, "été " * 5000)]
    df = spark.createDataFrame([(d, t, 1, "z") for d, t in rows], "doc_id long, text string, fp int, component_id string")
    got = sorted(((r.doc_id, r.fp, r.component_id) for r in simhash_groups(df).collect()), key=str)
    assert got == plain_groups(rows)
    kept = first_of_group(df)
    assert kept.columns == df.columns
    groups = {r.component: r.component_id for r in simhash_groups(df).collect()}
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(map(str, groups.values()))


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert simhash_groups(df).count() == 0 and first_of_group(df).count() == 0


@pytest.mark.parametrize("seed", [0, 1])
def test_tree_loses_no_pair(seed):
    rng = np.random.default_rng(seed)
    base = rng.integers(0, 2**63, 300, dtype=np.uint64)
    flips = base[:, None] ^ (np.uint64(1) << rng.integers(0, 64, (300, 4)).astype(np.uint64))
    points = np.unique(np.concatenate([base, flips.ravel()]))
    nodes = fit_tree(points[::2], 20, 3)
    assert nodes
    index, leaf, home = route(nodes, points, 3)
    assert np.array_equal(np.sort(index[home]), np.arange(len(points)))
    homes = dict(zip(index[home], leaf[home]))
    visits = set(zip(index, leaf))
    a, b = np.nonzero(np.bitwise_count(points[:, None] ^ points[None, :]) <= 3)
    assert all((i, homes[j]) in visits or (j, homes[i]) in visits for i, j in zip(a, b))
    labels = link_labels(points, points[:0], True, 3)
    assert all(labels[i] == labels[j] for i, j in zip(a, b))


def test_query_equals_brute_force_on_the_table(spark):
    from conftest import SF
    from parley.llm.queries import QUERIES

    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = sorted((r.doc_id, int(r.fingerprint, 16), r.component_id) for r in QUERIES["op10_simhash_dedup"](spark, SF).collect())
    assert got == sorted((d, f % 2**64, c) for d, f, c in plain_groups(rows))


def test_links_are_a_forest(spark):
    points = spark.createDataFrame([(i,) for i in range(512)], "fp long")
    from parley.llm.common import Scratch

    links = near_links(points, Scratch(spark, "t"), 3)
    assert links.count() < 2 * 512
