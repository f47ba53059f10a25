"""Near vectors: against brute force, and the odd inputs."""

import numpy as np

from parley.llm import embeddings
from parley.llm.embeddings import embedding_groups, similar, unit_rows


def plain(rows, threshold):
    def good(v):
        return v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)

    links = {i: set() for i in range(len(rows))}
    for i, (_, a, x) in enumerate(rows):
        for j, (_, b, y) in enumerate(rows):
            if i == j or a is None or a != b or not good(x) or not good(y) or len(x) != len(y):
                continue
            x1, y1 = np.array(x, float), np.array(y, float)
            x1, y1 = x1 / np.abs(x1).max(), y1 / np.abs(y1).max()
            if x1 @ y1 / np.sqrt(x1 @ x1) / np.sqrt(y1 @ y1) >= threshold:
                links[i].add(j)
    out = []
    for i, (own, _, _) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        least = min((rows[j][0] for j in seen if rows[j][0] is not None), default=None)
        out.append((own, len(links[i]), least, own == least))
    return sorted(out, key=str)


def test_groups_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "TILE", 16)
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(12, 24))
    rows = [(i, int(i % 3), (centres[rng.integers(12)] + rng.normal(size=24) * 0.25).tolist()) for i in range(300)]
    v = rows[0][2]
    rows += [(400, None, v), (401, 0, None), (402, 0, [0.0] * 24), (403, 0, [float("nan")] * 24), (404, 0, [None] * 24)]
    rows += [(405, 0, []), (406, 0, [1.0, 2.0]), (407, 0, [2.0, 4.0]), (408, 0, [float("inf")] + v[1:]), (None, 0, v)]
    rows += [(409, 0, [x * 1e-300 for x in v]), (410, 0, [x * 1e300 for x in v]), (0, 0, v)]
    df = spark.createDataFrame([(*r, 9) for r in rows], "vec_id long, label int, embedding array<double>, tile int")
    got = sorted((tuple(r) for r in embedding_groups(df).collect()), key=str)
    assert got == plain(rows, 0.93)
    assert sum(r[1] for r in got) > 100


def test_empty_table(spark):
    df = spark.createDataFrame([], "vec_id long, label int, embedding array<float>")
    assert embedding_groups(df).count() == 0


def test_early_stop_keeps_all_pairs():
    rng = np.random.default_rng(5)
    x = unit_rows(rng.normal(size=(60, 40)) * np.linspace(3, 0.1, 40))
    for t in (0.3, 0.8, 0.95):
        a, b = similar(x, x, t)
        assert set(zip(a, b)) == set(zip(*np.nonzero(x @ x.T >= t)))


def test_every_row_of_a_repeated_id_is_compared(spark):
    rows = [(2, 0, [1.0, 0.0]), (2, None, [5.0, 1.0]), (1, 0, [1.0, 0.0]), (3, 0, [1.0, 0.01]), (2, 0, [0.0, 1.0])]
    rows += [(None, 0, [0.0, 2.0]), (2, 0, [1.0, 0.0]), (None, 1, [1.0, 1.0]), (None, 1, [1.0, 1.0])]
    got = embedding_groups(spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>").repartition(4))
    got = sorted((tuple(r) for r in got.collect()), key=str)
    assert got == plain(rows, 0.93)
    assert (1, 3, 1, True) in got and (2, 0, 2, True) in got and (2, 1, 2, True) in got and (None, 1, None, True) in got
