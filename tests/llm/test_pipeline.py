"""The pipeline's rows, stage by stage, against plain code; the guard in the entry point."""

import numpy as np
from test_packing import checked
from test_simhash import plain_groups

import corpus_pipeline
from conftest import SF
from parley.llm import quality
from parley.llm.common import documents
from parley.llm.queries import TOP_GRADE


def rows_of(df):
    return {r.doc_id: r for r in df.collect()}


def test_stages_in_order(spark):
    docs = documents(spark, SF)
    model = quality.fit_documents(docs, quality.ratings_of(documents(spark, SF, "labels")), TOP_GRADE)
    good = corpus_pipeline.quality_classifier(spark, docs, SF).cache()
    assert good.columns == docs.columns
    expected = set()
    for r in docs.collect():
        at, value = quality.vector(r.text.encode(), {})
        if len(at) and model.tails(np.array([model.weights[at] @ value]))[0, 0] >= 0.5:
            expected.add(r.doc_id)
    kept = rows_of(good)
    assert kept.keys() == expected and 0 < len(expected) < docs.count()

    single = corpus_pipeline.simhash_dedup(spark, good, SF).cache()
    assert single.columns == docs.columns
    groups = plain_groups([(i, r.text) for i, r in kept.items()])
    assert sorted(rows_of(single)) == sorted({c for _, _, c in groups}) and len(rows_of(single)) == single.count()

    mended = corpus_pipeline.pii_surrogates(spark, single, SF).cache()
    assert mended.columns == docs.columns and [t for _, t in mended.dtypes] == [t for _, t in docs.dtypes]
    texts = {i: r.text for i, r in rows_of(mended).items()}
    assert texts.keys() == rows_of(single).keys()
    assert not any("@" in t and ".example.com" in t or "555-" in t and "+1 (" in t and t == kept[i].text for i, t in texts.items())
    assert any(t != kept[i].text for i, t in texts.items())
    assert all(r.n_chars == len(r.text) for r in mended.collect())

    last = corpus_pipeline.best_fit_packing(spark, mended, SF)
    checked(last.collect(), texts)
    whole = corpus_pipeline.run(spark, SF)
    columns = ["doc_id", "piece", "length", "ids"]
    assert sorted(map(str, whole.select(columns).collect())) == sorted(map(str, last.select(columns).collect()))


def test_empty_documents(spark, tmp_path):
    for table in ("documents", "labels"):
        documents(spark, SF, table).where("false").coalesce(1).write.parquet(f"{tmp_path}/{table}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_entry_has_the_queries():
    import __spark_entry__ as entry

    names = entry.queries()
    assert {n.split("_")[0] for n in names if n.startswith("op")} == {f"op{i}" for i in range(1, 14)}
    assert "pipeline" in names and [s[0] for s in corpus_pipeline.STAGES] == [
        "quality_classifier", "simhash_dedup", "pii_surrogates", "best_fit_packing",
    ]


def test_stages_take_nulls_repeated_rows_and_clashing_names(spark):
    """Columns that operators use inside, nulls everywhere, and rows that repeat."""
    docs = documents(spark, SF)
    names = "doc_id long, text string, lang string, source string, n_chars long, digest string, fp long, component int, kept int, ids int, piece int, tails string, __id int"
    plain = "A long and sound sentence about the river and the old town, seen by many people on that day."
    rows = [(1, None), (2, ""), (None, plain), (3, plain), (3, plain), (4, "mail a.b@mail7.example.com now " + plain), (5, "\t \n")]
    odd = spark.createDataFrame([(i, t, None, None, None, "d", 1, 2, 3, 4, 5, "t", 6) for i, t in rows], names)
    model = quality.fit_documents(docs, quality.ratings_of(documents(spark, SF, "labels")), TOP_GRADE)
    graded = {(r.doc_id, r.text): r.tails for r in quality.with_grades(odd.select("doc_id", "text"), model).collect()}
    good = corpus_pipeline.quality_classifier(spark, odd, SF)
    # Null, empty and blank texts have no chance of a grade above poor, so they go.
    expected = [r for r in rows if graded[r][0] >= 0.5]
    assert good.columns == odd.columns and sorted(map(str, [(r.doc_id, r.text) for r in good.collect()])) == sorted(map(str, expected))
    assert not any((t or "").strip() == "" for _, t in expected)

    single = corpus_pipeline.simhash_dedup(spark, odd, SF)
    assert single.columns == odd.columns
    kept = [(r.doc_id, r.text) for r in single.collect()]
    groups = {c for _, _, c in plain_groups([(n, t) for n, (_, t) in enumerate(rows)])}
    assert len(kept) == len(groups) and (3, plain) in kept and (1, None) in kept
    mended = corpus_pipeline.pii_surrogates(spark, odd, SF)
    assert mended.columns == odd.columns and mended.count() == len(rows)
    by_id = [(r.doc_id, r.text) for r in mended.collect()]
    assert (1, None) in by_id and (2, "") in by_id and by_id.count((3, plain)) == 2
    assert not any("a.b@mail7" in (t or "") for _, t in by_id)
    pieces = corpus_pipeline.best_fit_packing(spark, odd, SF).collect()
    assert len(pieces) == len(rows) and sorted(r.length for r in pieces if r.doc_id in (1, 2, 5)) == [1, 1, 1]
