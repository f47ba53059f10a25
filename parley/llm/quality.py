"""Quality grades by ordinal regression: one weight per hashed text feature, ordered thresholds."""

from __future__ import annotations

import operator
import re
from dataclasses import dataclass

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parley.llm.common import Memo, utf8, with_python_columns

# Labelled documents the model is fitted on, at most; the rest of the labels can test it.
TRAIN_ROWS = 6000
BUCKETS = 1 << 18
EPOCHS, RATE, DECAY, MIN_TEXTS = 300, 0.05, 3e-4, 8
# Features are shares of a text's words, scaled; a few words more are counted, so that short texts say less.
SCALE, EXTRA = 50.0, 8
REPEAT = 0
SHAPE = bytes(
    65 if 65 <= b <= 90 else 97 if 97 <= b <= 122 else 48 if 48 <= b <= 57 else 117 if b >= 128 else b for b in range(256)
)
RUNS = re.compile(rb"(.)\1+", re.S)
EDGES = bytes(b for b in range(33, 127) if not chr(b).isalnum())


def features(word: bytes) -> tuple[int, int, int]:
    """Buckets of a word: itself in lower case without punctuation at its ends, its first five bytes, its shape."""
    bare = word.lower().strip(EDGES)
    shape = RUNS.sub(rb"\1", word.translate(SHAPE))
    keys = (b"w" + bare, b"p" + bare[:5], b"s" + shape)
    return tuple(1 + xxhash.xxh32_intdigest(k) % (BUCKETS - 1) for k in keys)


def vector(text: bytes, known: dict) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a text and their weights; words equal to the one before them count in a bucket of their own."""
    words = text.split()
    if not words:
        return np.empty(0, np.int32), np.empty(0, np.float32)
    for w in set(words).difference(known):
        known[w] = features(w)
    flat = np.array([b for w in words for b in known[w]], np.int32)
    again = sum(map(operator.eq, words, words[1:]))
    at, n = np.unique(np.r_[flat, np.full(again, REPEAT, np.int32)], return_counts=True)
    return at.astype(np.int32), (n * SCALE / (len(words) + EXTRA)).astype(np.float32)


@dataclass
class OrdinalModel:
    """P(grade >= k) = 1 / (1 + exp(cuts[k - 1] - weights . x)), with rising cuts."""

    weights: np.ndarray
    cuts: np.ndarray

    def tails(self, score: np.ndarray) -> np.ndarray:
        return sigmoid(score[:, None] - self.cuts[None, :])


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(x / 2))


def fit(vectors: list[tuple[np.ndarray, np.ndarray]], grades: np.ndarray, top: int) -> OrdinalModel:
    """Maximum likelihood of the grades 0 to ``top`` by gradient steps on all rows.

    The cuts are a first one and positive steps, so that they stay in order.
    """
    # What few texts hold says more about these texts than about their grade.
    held = np.zeros(BUCKETS, np.int64)
    for buckets, _ in vectors:
        held[buckets] += 1
    known = held >= MIN_TEXTS
    seen = np.flatnonzero(known)
    place = (np.cumsum(known) - 1).astype(np.int32)
    kept = [known[buckets] for buckets, _ in vectors]
    at = np.concatenate([place[b[k]] for (b, _), k in zip(vectors, kept)])
    value = np.concatenate([v[k] for (_, v), k in zip(vectors, kept)])
    n = len(vectors)
    row = np.repeat(np.arange(n, dtype=np.int32), [np.count_nonzero(k) for k in kept])
    params = np.zeros(len(seen) + top)
    params[-top] = -1.0
    moment, square = np.zeros_like(params), np.zeros_like(params)
    for step in range(1, EPOCHS + 1):
        w, first, steps = params[: len(seen)], params[-top], np.exp(params[len(params) - top + 1 :])
        cuts = first + np.r_[0.0, np.cumsum(steps)]
        score = np.bincount(row, weights=value * w[at], minlength=n)
        # Cumulative probabilities with the ends 1 (below grade 0) and 0 (above the top).
        p = np.c_[np.ones(n), sigmoid(score[:, None] - cuts), np.zeros(n)]
        mine = np.maximum(p[np.arange(n), grades] - p[np.arange(n), grades + 1], 1e-12)
        slope = p * (1 - p)
        by_score = (slope[np.arange(n), grades] - slope[np.arange(n), grades + 1]) / mine
        by_cut = np.zeros((n, top + 2))
        by_cut[np.arange(n), grades] -= slope[np.arange(n), grades] / mine
        by_cut[np.arange(n), grades + 1] += slope[np.arange(n), grades + 1] / mine
        cut_gradient = by_cut[:, 1:-1].sum(axis=0) / n
        gradient = np.r_[
            np.bincount(at, weights=value * by_score[row], minlength=len(seen)) / n - DECAY * w,
            cut_gradient.sum(),
            [cut_gradient[k:].sum() * steps[k - 1] for k in range(1, top)],
        ]
        moment = 0.9 * moment + 0.1 * gradient
        square = 0.999 * square + 0.001 * gradient**2
        params = params + RATE * (moment / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    weights = np.zeros(BUCKETS)
    weights[seen] = params[: len(seen)]
    return OrdinalModel(weights, params[-top] + np.r_[0.0, np.cumsum(np.exp(params[len(params) - top + 1 :]))])


def training_rows(docs: DataFrame, ratings: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """(doc_id, text, grade) of at most ``rows`` rated documents, chosen by the hash of their ids.

    An id that is rated several times has its lowest grade, and one that
    several documents bear stands for the text of the smallest MD5 among them.
    The ids joined with the documents are bounded by ``rows``.
    """
    rated = ratings.where("doc_id is not null and grade is not null").groupBy("doc_id").agg(F.min("grade").alias("grade"))
    chosen = rated.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").where("text is not null")
    return texts.groupBy("doc_id").agg(F.min("grade").alias("grade"), F.min_by("text", F.md5("text")).alias("text"))


def fit_documents(docs: DataFrame, ratings: DataFrame, top: int, rows: int = TRAIN_ROWS) -> OrdinalModel | None:
    """The model for the grades in ``ratings`` (doc_id, grade 0 to ``top``); None without rated documents."""
    sample = training_rows(docs, ratings, rows)
    fields = [T.StructField("at", T.BinaryType()), T.StructField("value", T.BinaryType())]

    def make():
        def run(texts):
            known: dict = {}
            found = [vector(t, known) for t in texts]
            return [[a.tobytes() for a, _ in found], [v.tobytes() for _, v in found]]

        return run

    # At most ``rows``, one for each id; sorted, so that the sums of the fit do not depend on the order of tasks.
    found = with_python_columns(sample, utf8(F.col("text")), fields, make).select("doc_id", "grade", "at", "value").collect()
    found = sorted(found, key=lambda r: r["doc_id"])
    if not found:
        return None
    vectors = [(np.frombuffer(r["at"], np.int32), np.frombuffer(r["value"], np.float32)) for r in found]
    return fit(vectors, np.array([r["grade"] for r in found]), top)


def with_grades(docs: DataFrame, model: OrdinalModel | None, text: str = "text", top: int = 2) -> DataFrame:
    """``docs`` with expected_grade and tails, the probabilities of at least grade 1, 2 and so on, for whole texts.

    Null and empty texts and those of white space have the expected grade 0
    and tails 0. Without a model both columns are null. Rows and further columns stay; columns
    of these names are replaced.
    """
    fields = [T.StructField("expected_grade", T.DoubleType()), T.StructField("tails", T.ArrayType(T.DoubleType()))]
    if model is None:
        return docs.withColumns({f.name: F.lit(None).cast(f.dataType) for f in fields})
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        own = sent.value
        weights = own.weights

        def of_words(words):
            at = np.array([features(w) for w in words], np.int64).reshape(-1, 3)
            return weights[at].sum(axis=1).tolist()

        memo = Memo(of_words)

        def run(texts):
            parts = [t.split() for t in texts]
            table = memo.over(parts)
            sums = np.array([sum(map(table.__getitem__, p)) for p in parts])
            again = np.array([sum(map(operator.eq, p, p[1:])) for p in parts])
            sizes = np.array([len(p) for p in parts])
            score = (sums + weights[REPEAT] * again) * SCALE / (sizes + EXTRA)
            tails = own.tails(score) * (sizes > 0)[:, None]
            return [tails.sum(axis=1).tolist(), tails.tolist()]

        return run

    return with_python_columns(docs, utf8(F.col(text)), fields, make)


def ratings_of(labels: DataFrame) -> DataFrame:
    """Grades from two marks: 0 poor, 1 sound but toxic, 2 sound. Rows without a quality mark have none."""
    grade = F.when(F.col("quality") == 0, 0).when(F.col("toxic") == 1, 1).when(F.col("quality") == 1, 2)
    return labels.select("doc_id", grade.alias("grade")).where("grade is not null")


def selected(tails: str = "tails", grade: int = 1, least: float = 0.5):
    """True where the probability of at least ``grade`` reaches ``least``; documents without tails stay."""
    return F.coalesce(F.element_at(F.col(tails), grade) >= least, F.lit(True))
