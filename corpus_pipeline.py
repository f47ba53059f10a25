"""The training-data pipeline: quality, near copies, personal data, packing.

Each stage is one operator of ``parley.llm`` and gets all rows its predecessor
kept. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import public_tokenizers  # noqa: E402
from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from parley.llm import quality  # noqa: E402
from parley.llm.common import Scratch, documents  # noqa: E402
from parley.llm.packing import pack_documents  # noqa: E402
from parley.llm.pii import replace_pii  # noqa: E402
from parley.llm.queries import SURROGATE_KEY, TOP_GRADE  # noqa: E402
from parley.llm.simhash import first_of_group  # noqa: E402


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose probability of a grade above poor is below one half go, and with them null, empty and blank texts."""
    ratings = quality.ratings_of(documents(spark, sf_dir, "labels"))
    graded = quality.with_grades(docs, quality.fit_documents(docs, ratings, TOP_GRADE))
    return graded.where(quality.selected()).select(*docs.columns)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: the one with the smallest id."""
    return first_of_group(docs)


def pii_surrogates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and secrets in the texts give way to surrogates; ``n_chars`` follows the new text."""
    mended = replace_pii(docs, SURROGATE_KEY)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        mended = mended.withColumn("n_chars", F.coalesce(F.length("text").cast(kind), "n_chars"))
    return mended


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per piece of a document with its token ids, its sequence and its place there.

    Of the columns of ``docs`` doc_id, lang and source go along; others end here.
    """
    kept = docs.select("doc_id", "text", "lang", "source")
    return pack_documents(kept, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("simhash_dedup", simhash_dedup),
    ("pii_surrogates", pii_surrogates),
    ("best_fit_packing", best_fit_packing),
]
# Fingerprints, surrogates, the trained model and the tokenizer are beyond SQL; tests/llm/test_pipeline.py checks the rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies all stages to ``documents``; what a stage returns is written before the next one reads it."""
    scratch = Scratch(spark, "pipeline")
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = scratch.write(docs)
    return docs
