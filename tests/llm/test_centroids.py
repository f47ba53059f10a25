"""Centroid clustering: the tree against a full comparison, all rounds against plain integers."""

import hashlib
import math
import random
from collections import defaultdict

import numpy as np
import pytest

from parley.llm.centroids import VantageTree, centroid_clusters, exact


@pytest.mark.parametrize("k,d,spread", [(1, 3, 5), (4, 2, 2), (40, 64, 300), (40, 2, 3), (300, 8, 20), (25, 6, 1 << 26)])
def test_tree_finds_the_nearest_of_smallest_number(k, d, spread):
    rng = np.random.default_rng(k + d)
    centroids = rng.integers(-spread, spread + 1, (k, d))
    centroids[k // 2 :: 3] = centroids[0]
    x = np.concatenate([rng.integers(-spread, spread + 1, (2000, d)), centroids])
    who, squared = VantageTree(centroids).nearest(x)
    full = exact(x, centroids)
    assert (squared == full.min(axis=1)).all() and (who == full.argmin(axis=1)).all()


def test_tree_leaves_far_centroids_out(monkeypatch):
    """In few dimensions most centroids are never compared."""
    from parley.llm import centroids as module

    rng = np.random.default_rng(2)
    points = rng.integers(-10_000, 10_000, (200, 2))
    tree, asked = VantageTree(points), []
    monkeypatch.setattr(module, "exact", lambda x, y: asked.append(len(x) * len(y)) or exact(x, y))
    tree.nearest(points.copy())
    assert sum(asked) < 0.4 * 200 * 200


def plain(rows, clusters, rounds=5, d=64):
    kept = []
    for i, e in rows:
        if e is not None and len(e) == d and all(x is not None and math.isfinite(x) for x in e):
            kept.append((i, tuple(math.floor(256 * x) for x in e)))
    key = lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1])
    centroids = [v for _, v in sorted(kept, key=key)[:clusters]]
    for step in range(rounds + 1):
        near = [min((sum((a - b) ** 2 for a, b in zip(v, c)), k) for k, c in enumerate(centroids)) for _, v in kept]
        if step == rounds:
            break
        own = defaultdict(list)
        for (_, v), (_, k) in zip(kept, near):
            own[k].append(v)
        centroids = [tuple(sum(x) // len(own[k]) for x in zip(*own[k])) if k in own else c for k, c in enumerate(centroids)]
    per = defaultdict(int)
    for dist, k in near:
        per[k] += dist
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted([(i, k, dist, per[k], sum(per.values()), digest[k]) for (i, _), (dist, k) in zip(kept, near)], key=str)


def test_clusters_equal_plain_integers(spark):
    rng = random.Random(3)
    rows = [(i, [rng.gauss(i % 6, 1.5) for _ in range(64)]) for i in range(150)]
    rows += [(200 + i, rows[i % 3][1]) for i in range(60)]
    v = rows[0][1]
    rows += [(None, v), (None, [0.0] * 64), (5, v), (5, rows[1][1]), (300, None), (301, []), (302, v[:63]), (303, [*v, 1.0])]
    rows += [(304, [*v[:63], None]), (305, [*v[:63], float("nan")]), (306, [*v[:63], float("-inf")]), (307, [-0.001] * 64)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, cluster int").repartition(6)
    got = centroid_clusters(df, clusters=12)
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain(rows, 12)


def test_few_vectors_and_none(spark):
    schema = "vec_id long, embedding array<float>"
    rows = [(1, [0.5] * 64), (2, [0.5] * 64), (3, [-1.0] * 64)]
    got = centroid_clusters(spark.createDataFrame(rows, schema)).collect()
    assert sorted((tuple(r) for r in got), key=str) == plain(rows, 40)
    assert centroid_clusters(spark.createDataFrame([], schema)).count() == 0
    assert centroid_clusters(spark.createDataFrame([(1, None), (2, [1e30] * 64)], schema)).count() == 0


def test_query_equals_plain_integers_on_the_table(spark):
    from conftest import SF
    from parley.llm.queries import QUERIES

    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    assert sorted((tuple(r) for r in QUERIES["op13_centroid_clusters"](spark, SF).collect()), key=str) == plain(rows, 40)
