"""One query per operator, over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parley.llm import bpe, fingerprints, licenses, quality
from parley.llm.centroids import centroid_clusters
from parley.llm.common import documents, utf8_length
from parley.llm.embeddings import embedding_groups
from parley.llm.exact import exact_groups
from parley.llm.packing import pack_documents
from parley.llm.pii import replace_pii
from parley.llm.ranked_search import ranked_documents
from parley.llm.simhash import simhash_groups
from parley.llm.token_counts import with_token_counts
from parley.llm.urls import judge_urls

TOKEN_LIMIT = 4096
TOP_GRADE = 2
# For the test tables; a real run passes a secret of its own.
SURROGATE_KEY = "test tables"


def op1_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_groups(documents(spark, sf_dir, "embeddings"))


def op2_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    encoded = bpe.with_ids(documents(spark, sf_dir).select("doc_id", "text"), path).drop("text")
    return bpe.with_text(encoded, path).select(
        "doc_id",
        bpe.n_ids("ids").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text", utf8_length("text").alias("n_bytes"))
    counted = with_token_counts(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"))


def op4_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return replace_pii(docs, SURROGATE_KEY, count="n_replaced")


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    digest = {"ids_crc32": F.crc32("ids")}
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), carried=digest).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(documents(spark, sf_dir, "pages"))


def op7_quality_grades(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    model = quality.fit_documents(docs, quality.ratings_of(documents(spark, sf_dir, "labels")), TOP_GRADE)
    graded = quality.with_grades(docs, model)
    tails = [F.element_at("tails", k).alias(f"p_at_least_{k}") for k in range(1, TOP_GRADE + 1)]
    return graded.select("doc_id", "expected_grade", *tails, quality.selected().alias("kept"))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    scanned = licenses.with_licenses(documents(spark, sf_dir).select("doc_id", "text"))
    found = [c.alias(n) for n, c in licenses.label_columns().items()]
    return scanned.select("doc_id", "n_words", *found, "license_spans")


def op9_syncmer_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.neighbours(documents(spark, sf_dir)).select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        F.lower(F.hex("fingerprint")).alias("fingerprint"),
        F.lower(F.hex("edited_fingerprint")).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
    )


def op10_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(documents(spark, sf_dir)).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_groups(documents(spark, sf_dir), columns=["doc_id"])
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_documents(documents(spark, sf_dir), documents(spark, sf_dir, "benchmark"))


def op13_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroid_clusters(documents(spark, sf_dir, "embeddings"))


QUERIES = {name: f for name, f in list(globals().items()) if name.startswith("op")}
