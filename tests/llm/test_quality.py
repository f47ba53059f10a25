"""Quality grades: the fit against its own likelihood, held-out accuracy, and the odd inputs."""

import numpy as np
from pyspark.sql import functions as F

from parley.llm import quality
from parley.llm.common import documents
from parley.llm.quality import BUCKETS, OrdinalModel, features, fit, fit_documents, ratings_of, selected, vector, with_grades


def test_vector_counts_shares_of_words():
    at, value = vector(b"Bad, bad bad", {})
    n = 3 + quality.EXTRA
    got = dict(zip(at.tolist(), value.tolist()))
    first, second = features(b"Bad,"), features(b"bad")
    assert first[0] == second[0] and first[1] == second[1] and first[2] != second[2]
    assert np.isclose(got[first[0]], 3 * quality.SCALE / n) and np.isclose(got[quality.REPEAT], quality.SCALE / n)
    assert len(vector(b" \n", {})[0]) == 0


def test_fit_orders_grades_and_cuts(monkeypatch):
    monkeypatch.setattr(quality, "MIN_TEXTS", 1)
    rng = np.random.default_rng(1)
    grades = rng.integers(0, 4, 400)
    vectors = [(np.array([3, 5], np.int32), np.array([g + rng.normal() * 0.2, 1.0], np.float32)) for g in grades]
    model = fit(vectors, grades, 3)
    assert (np.diff(model.cuts) > 0).all()
    score = np.array([v @ model.weights[a] for a, v in vectors])
    expected = model.tails(score).sum(axis=1)
    assert (np.round(expected) == grades).mean() > 0.9


def test_scores_equal_the_vectors_product(spark):
    rng = np.random.default_rng(2)
    model = OrdinalModel(rng.normal(size=BUCKETS) * 0.1, np.array([-1.0, 0.5]))
    texts = [None, "", " \n\t", "one", "two two two", "ÉTÉ!! A1 ***", "word " * 20000 + "end"]
    df = spark.createDataFrame([(i, t, 1.0, "x") for i, t in enumerate(texts)] + [(0, "one", None, None)] * 2, "doc_id long, text string, tails double, at string")
    rows = with_grades(df, model).collect()
    assert len(rows) == len(texts) + 2
    for r in rows:
        at, value = vector((r.text or "").encode(), {})
        tails = model.tails(np.array([model.weights[at] @ value]))[0] * (len(at) > 0)
        assert np.allclose(r.tails, tails, atol=1e-5) and np.isclose(r.expected_grade, sum(r.tails))
    assert with_grades(df.where("false"), model).count() == 0


def test_without_labels_all_documents_stay(spark):
    docs = spark.createDataFrame([(1, "a"), (None, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(7, 1, 0), (None, 1, 1), (1, None, None)], "doc_id long, quality int, toxic int")
    model = fit_documents(docs, ratings_of(labels), 2)
    assert model is None
    assert with_grades(docs, model).where(selected()).count() == 2


def test_grades_of_labels(spark):
    rows = [(1, 0, 1), (2, 1, 1), (3, 1, 0), (4, 1, None), (5, None, 1), (6, None, None)]
    labels = spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
    assert {r.doc_id: r.grade for r in ratings_of(labels).collect()} == {1: 0, 2: 1, 3: 2, 4: 2, 5: 1}


def test_held_out_accuracy(spark):
    """Fitted on some labels of the middle table, judged on the others."""
    sf = "/root/testdata/sf0.1"
    docs, ratings = documents(spark, sf), ratings_of(documents(spark, sf, "labels"))
    rows = 2600
    model = fit_documents(docs, ratings, 2, rows)
    used = quality.training_rows(docs, ratings, rows).select("doc_id")
    held = docs.join(ratings, "doc_id").join(used, "doc_id", "left_anti")
    got = with_grades(held, model).groupBy("grade").agg(F.avg(selected().cast("int")).alias("kept"), F.avg("expected_grade").alias("mean"))
    got = {r.grade: r for r in got.collect()}
    assert got[0].kept < 0.12 and got[2].kept > 0.99
    assert got[0].mean < got[1].mean < got[2].mean


def test_an_id_of_many_rows_has_one_text_in_the_fit(spark):
    rows = [(1, f"text {i}") for i in range(500)] + [(2, "b"), (3, "c"), (3, None), (4, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    ratings = spark.createDataFrame([(1, 2), (1, 0), (2, 1), (3, 2), (4, 2), (9, 1)], "doc_id long, grade int")
    got = {r.doc_id: r for r in quality.training_rows(docs, ratings).collect()}
    assert got.keys() == {1, 2, 3} and got[1].grade == 0 and got[3].text == "c"
    import hashlib

    assert got[1].text == min((t for i, t in rows if i == 1), key=lambda t: hashlib.md5(t.encode()).hexdigest())


def likelihood(vectors, grades, weights, cuts, decay):
    total = 0.0
    for (at, value), g in zip(vectors, grades):
        score = sum(weights[a] * v for a, v in zip(at.tolist(), value.tolist()))
        tail = [1.0, *(1 / (1 + np.exp(-(score - c))) for c in cuts), 0.0]
        total += np.log(tail[g] - tail[g + 1])
    return total / len(grades) - decay / 2 * (weights**2).sum()


def test_fit_reaches_the_top_of_the_likelihood(monkeypatch):
    """No numeric step in any weight or cut raises the penalised likelihood of the fitted model."""
    monkeypatch.setattr(quality, "MIN_TEXTS", 1)
    monkeypatch.setattr(quality, "DECAY", 0.01)
    monkeypatch.setattr(quality, "EPOCHS", 4000)
    rng = np.random.default_rng(8)
    grades = rng.integers(0, 3, 60)
    vectors = [(np.array([2, 7, 11], np.int32), np.array([g + rng.normal(), rng.normal(), 1.0], np.float32)) for g in grades]
    model = fit(vectors, grades, 2)
    best = likelihood(vectors, grades, model.weights, model.cuts, 0.01)
    for at, step in [(a, s) for a in ("w2", "w7", "w11", "c0", "c1") for s in (-0.05, 0.05)]:
        weights, cuts = model.weights.copy(), model.cuts.copy()
        (weights if at[0] == "w" else cuts)[int(at[1:])] += step
        assert likelihood(vectors, grades, weights, cuts, 0.01) < best + 1e-6


def test_query_equals_plain_scores_on_the_table(spark):
    from conftest import SF
    from parley.llm.queries import QUERIES, TOP_GRADE

    docs = documents(spark, SF).select("doc_id", "text")
    model = fit_documents(docs, ratings_of(documents(spark, SF, "labels")), TOP_GRADE)
    got = {r.doc_id: r for r in QUERIES["op7_quality_grades"](spark, SF).collect()}
    rows = docs.collect()
    assert len(got) == len(rows) == docs.count()
    for r in rows:
        at, value = vector((r.text or "").encode(), {})
        score = float(model.weights[at] @ value)
        tails = [1 / (1 + np.exp(-(score - c))) if len(at) else 0.0 for c in model.cuts]
        own = got[r.doc_id]
        assert np.allclose([own.p_at_least_1, own.p_at_least_2], tails, atol=1e-5)
        assert np.isclose(own.expected_grade, sum(tails), atol=1e-5)
        assert own.kept == (own.p_at_least_1 >= 0.5)
