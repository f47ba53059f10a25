"""Centroid clustering on integers, with a vantage-point tree over the centroids in every round."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.llm.common import Scratch

DIMENSIONS = 64
CLUSTERS = 40
ROUNDS = 5
SEED = 2
SCALE = 256
# Largest component (as integer) whose squared distances fit 64 bits: 64 * (2 * 2^27)^2 = 2^62.
LARGEST = 1 << 27
# Centroids in a leaf of the tree.
LEAF = 4
# Bounds are distances in floating point; this much is allowed for their rounding.
SLACK = 1e-9


def exact(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Squared distances of the rows of ``x`` to the rows of ``y``, in 64-bit integers."""
    difference = x[:, None, :] - y[None, :, :]
    return np.einsum("ijk,ijk->ij", difference, difference)


class VantageTree:
    """Centroids by their distances to vantage centroids.

    A node is a vantage centroid with two children, or a leaf of a few
    centroids. A child knows the least and largest distance of its members to
    its parent's vantage centroid.
    """

    def __init__(self, centroids: np.ndarray):
        self.centroids = centroids
        self.vantage: list[int] = []
        self.members: list[np.ndarray | None] = []
        self.children: list[list[tuple[int, float, float]]] = []
        self._grow(np.arange(len(centroids)))

    def _grow(self, members: np.ndarray) -> int:
        node = len(self.vantage)
        self.vantage.append(-1)
        self.members.append(members)
        self.children.append([])
        if len(members) <= LEAF:
            return node
        apart = np.sqrt(exact(self.centroids[members], self.centroids[members]).astype(np.float64))
        # The centroid whose distances differ most parts the others best.
        chosen = int(apart.std(axis=1).argmax())
        others = np.delete(members, chosen)
        away = np.delete(apart[chosen], chosen)
        order = np.argsort(away, kind="stable")
        self.vantage[node], self.members[node] = int(members[chosen]), None
        for half in np.array_split(order, 2):
            # In order of their numbers, so that the first of equal distances in a leaf is the smallest number.
            child = self._grow(np.sort(others[half]))
            self.children[node].append((child, float(away[half].min()), float(away[half].max())))
        return node

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number and squared distance of the nearest centroid of each row; of equals the smallest number.

        Each row opens the node with its least bound next and ends when that
        exceeds its best distance; a bound equal to it is still opened, as a
        centroid there may tie. All rows take their steps together.
        """
        step = max(64, (1 << 20) // max(1, len(self.vantage)))
        parts = [self._nearest(x[i : i + step]) for i in range(0, len(x), step)]
        if not parts:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        return tuple(np.concatenate(p) for p in zip(*parts))

    def _nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        best = np.full(len(x), np.iinfo(np.int64).max)
        who = np.full(len(x), len(self.centroids))
        low = np.full((len(x), len(self.vantage)), np.inf)
        low[:, 0] = 0
        rows = np.arange(len(x))
        while len(rows):
            open_ = low[rows]
            node = open_.argmin(axis=1)
            bound = open_[np.arange(len(rows)), node]
            going = np.isfinite(bound) & (bound <= np.sqrt(best[rows].astype(np.float64)) * (1 + SLACK) + SLACK)
            rows, node, bound = rows[going], node[going], bound[going]
            low[rows, node] = np.inf
            order = np.argsort(node, kind="stable")
            kinds, starts = np.unique(node[order], return_index=True)
            for n, some in zip(kinds.tolist(), np.split(order, starts[1:])):
                own = rows[some]
                inner = self.members[n] is None
                members = np.array([self.vantage[n]]) if inner else self.members[n]
                squared = exact(x[own], self.centroids[members])
                at = squared.argmin(axis=1)
                found, number = squared[np.arange(len(own)), at], members[at]
                better = (found < best[own]) | ((found == best[own]) & (number < who[own]))
                best[own[better]], who[own[better]] = found[better], number[better]
                if inner:
                    away = np.sqrt(squared[:, 0].astype(np.float64))
                    for child, least, most in self.children[n]:
                        low[own, child] = np.maximum(bound[some], np.maximum(away - most, least - away))
        return who, best


def usable(column: Column, dimensions: int) -> Column:
    """True for arrays of ``dimensions`` components, none null or non-finite, all within the range of exact integers."""
    limit = float(LARGEST // SCALE)
    inside = F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) <= F.lit(limit)))
    return F.coalesce((F.size(column) == dimensions) & inside, F.lit(False))


def _matrix(column: pa.Array, dimensions: int) -> np.ndarray:
    return column.flatten().to_numpy().astype(np.int64).reshape(-1, dimensions)


def start_centroids(vectors: DataFrame, clusters: int, seed: int) -> np.ndarray:
    """The vectors with the smallest SHA-256 of seed and id, in that order; equal ids go by their components."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("null"))), 256)
    keyed = vectors.select(F.col("vec_id").isNull().alias("last"), key.alias("key"), "v")
    # Keys only, to find the bound; then the few vectors within it.
    least = keyed.select("last", "key").orderBy("last", "key").limit(clusters).collect()
    if not least:
        return np.empty((0, 0), np.int64)
    last = least[-1]
    within = keyed.where((F.col("last") < F.lit(last["last"])) | ((F.col("last") == F.lit(last["last"])) & (F.col("key") <= last["key"])))
    rows = within.orderBy("last", "key", "v").limit(clusters).collect()
    return np.array([r["v"] for r in rows], np.int64)


def assigned(vectors: DataFrame, tree: VantageTree, dimensions: int) -> DataFrame:
    """(vec_id, cluster, distance) of each row of ``vectors`` (vec_id, v)."""
    sent = vectors.sparkSession.sparkContext.broadcast(tree)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            who, squared = sent.value.nearest(_matrix(batch.column(1), dimensions))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(who.astype(np.int32)), pa.array(squared)], names=["vec_id", "cluster", "distance"]
            )

    return vectors.select("vec_id", "v").mapInArrow(run, "vec_id long, cluster int, distance long")


def moved(vectors: DataFrame, tree: VantageTree, dimensions: int) -> np.ndarray:
    """The centroids after one round: floor(sum / count) of their vectors; those without any stay.

    A task passes on one row per centroid; at most that many rows reach the driver.
    """
    sent = vectors.sparkSession.sparkContext.broadcast(tree)
    k = len(tree.centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((k, dimensions), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            x = _matrix(batch.column(0), dimensions)
            if not len(x):
                continue
            who, _ = sent.value.nearest(x)
            order = np.argsort(who, kind="stable")
            kinds, starts = np.unique(who[order], return_index=True)
            sums[kinds] += np.add.reduceat(x[order], starts, axis=0)
            counts += np.bincount(who, minlength=k)
        used = np.flatnonzero(counts)
        values = pa.FixedSizeListArray.from_arrays(pa.array(sums[used].ravel()), dimensions).cast(pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays(
            [pa.array(used.astype(np.int32)), pa.array(counts[used]), values], names=["cluster", "n", "sums"]
        )

    parts = vectors.select("v").mapInArrow(run, "cluster int, n long, sums array<long>")
    total = [F.sum(F.element_at("sums", i + 1)).alias(f"s{i}") for i in range(dimensions)]
    out = tree.centroids.copy()
    for r in parts.groupBy("cluster").agg(F.sum("n").alias("n"), *total).collect():
        out[r["cluster"]] = np.array([r[f"s{i}"] for i in range(dimensions)], np.int64) // r["n"]
    return out


def centroid_clusters(
    table: DataFrame,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    seed: int = SEED,
    dimensions: int = DIMENSIONS,
) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256): one row per usable vector.

    Vectors that are null, of another length, or hold a null or non-finite
    component are left out, as are those with a component beyond
    ``LARGEST / SCALE``, whose squared distances 64 bits could not hold. Every row
    counts, whether its id is null or repeats; rows without an id come last in
    the choice of first centroids. Fewer vectors than ``clusters`` give as many
    centroids as vectors. An empty table gives an empty result; further columns
    are not read.

    The integers are written once; each round reads them and passes on one row
    of sums per centroid and task.
    """
    spark = table.sparkSession
    scratch = Scratch(spark, "centroids")
    rows = table.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("e"))
    whole = F.transform("e", lambda x: F.floor(x * SCALE).cast("long")).alias("v")
    vectors = scratch.write(rows.where(usable(F.col("e"), dimensions)).select("vec_id", whole))
    centroids = start_centroids(vectors, clusters, seed)
    columns = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    if not len(centroids):
        return spark.createDataFrame([], columns)
    for _ in range(rounds):
        centroids = moved(vectors, VantageTree(centroids), dimensions)
    placed = scratch.write(assigned(vectors, VantageTree(centroids), dimensions))
    # One row per centroid.
    sums = {r["cluster"]: r["d"] for r in placed.groupBy("cluster").agg(F.sum("distance").alias("d")).collect()}
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    facts = spark.createDataFrame(
        [(c, d, sum(sums.values()), digests[c]) for c, d in sums.items()],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string",
    )
    return placed.join(F.broadcast(facts), "cluster").select(*[c.split()[0] for c in columns.split(", ")])
