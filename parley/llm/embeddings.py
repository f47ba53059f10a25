"""Near-duplicate vectors: tiles compared along their principal axes, with early stops."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.llm.common import Scratch
from parley.llm.components import connected_components
from parley.llm.local_forest import join_labels

THRESHOLD = 0.93
# Vectors the axes are fitted on. Any axes give the same links; good ones stop earlier.
AXES_SAMPLE = 8192
# Vectors in a tile, about; a task holds two tiles.
TILE = 2048
# The leading axis runs from -1 to 1 in so many cells, from which tiles are made.
GRID = 4096
# Slack for rounding wherever a bound is compared.
SLACK = 1e-9


def usable(column) -> object:
    """True for vectors that can be compared: not empty, no null, NaN or infinite component, not all zero."""
    finite = F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return F.coalesce(finite & F.exists(column, lambda x: x != 0), F.lit(False))


def principal_axes(vectors: DataFrame) -> dict[int, np.ndarray]:
    """Orthogonal axes for the commonest length of ``vectors`` (row, v), by falling spread, from about ``AXES_SAMPLE``.

    The sample is cut by the hash of the row numbers, which are unique, so it is bounded before it leaves the tasks.
    """
    total = vectors.count()
    part = F.pmod(F.xxhash64("row"), F.lit(1 << 30)) < F.lit(int((1 << 30) * min(1.0, AXES_SAMPLE / max(1, total))))
    rows = vectors.where(part).select("v").collect()
    by_length: dict[int, list] = {}
    for r in rows:
        by_length.setdefault(len(r["v"]), []).append(r["v"])
    if not by_length:
        return {}
    length, sample = max(by_length.items(), key=lambda x: len(x[1]))
    unit = unit_rows(np.array(sample, np.float64))
    return {length: np.linalg.eigh(unit.T @ unit)[1][:, ::-1].copy()}


def unit_rows(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; scaled by their largest part first, so that no square over- or underflows."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def similar(x: np.ndarray, y: np.ndarray, threshold: float, start: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (row of x, row of y) whose cosine reaches the threshold; rows are unit vectors.

    Leading axes are summed first. What the others can still add is at most
    the product of the rests' lengths; pairs that cannot reach the threshold
    with it are left. Once few pairs remain, only these are carried on.
    """
    d = x.shape[1]
    cut = min(start, d)
    part = x[:, :cut] @ y[:, :cut].T
    while True:
        rest = np.outer(_lengths(x[:, cut:]), _lengths(y[:, cut:]))
        alive = part + rest >= threshold - SLACK
        if cut == d:
            return np.nonzero(part >= threshold)
        n = np.count_nonzero(alive)
        if n == 0:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        if n < 0.02 * alive.size:
            break
        new = min(d, cut * 2)
        part += x[:, cut:new] @ y[:, cut:new].T
        cut = new
    a, b = np.nonzero(alive)
    got = part[a, b]
    while cut < d:
        new = min(d, cut * 2)
        got = got + np.einsum("ij,ij->i", x[a, cut:new], y[b, cut:new])
        keep = got + _lengths(x[:, new:])[a] * _lengths(y[:, new:])[b] >= threshold - (SLACK if new < d else 0)
        a, b, got, cut = a[keep], b[keep], got[keep], new
    return a, b


def _lengths(x: np.ndarray) -> np.ndarray:
    return np.sqrt((x * x).sum(axis=1))


def vector_links(vectors: DataFrame, scratch: Scratch, threshold: float) -> DataFrame:
    """(row, n, to): a vector's links in one pair of tiles, and a member of its group there.

    ``vectors`` is a written table of row, label and v, an array of doubles.
    Links between vectors are counted, never listed.
    """
    spark = vectors.sparkSession
    axes = principal_axes(vectors)

    def turn(batches):
        for pdf in batches:
            if not len(pdf):
                continue
            out = []
            for size, rows in pdf.groupby(pdf["v"].map(len)):
                unit = unit_rows(np.stack(rows["v"].to_numpy()).astype(np.float64))
                turned = unit @ axes[size] if size in axes else unit
                out.append(
                    pd.DataFrame(
                        {
                            "row": rows["row"],
                            "label": rows["label"],
                            "size": size,
                            "lead": turned[:, 0],
                            "cell": np.clip(((turned[:, 0] + 1) * GRID / 2).astype(np.int64), 0, GRID - 1),
                            "unit": [r.tobytes() for r in turned],
                        }
                    )
                )
            yield pd.concat(out)

    label = vectors.schema["label"].dataType.simpleString()
    turned = scratch.write(
        vectors.mapInPandas(turn, f"row long, label {label}, size int, lead double, cell int, unit binary")
    )
    group = ["label", "size"]
    cells = turned.groupBy(*group, "cell").agg(F.count("*").alias("n"))
    # At most GRID rows for each label.
    before = F.expr("coalesce(sum(n) over (partition by label, size order by cell rows between unbounded preceding and 1 preceding), 0)")
    cells = cells.withColumn("before", before).select(
        *group,
        "cell",
        F.floor(F.col("before") / TILE).cast("int").alias("base"),
        F.greatest(F.lit(1), F.ceil(F.col("n") / TILE)).cast("int").alias("parts"),
    )
    placed = scratch.write(
        turned.join(cells, [*group, "cell"]).select(
            *group, "row", "lead", "unit", (F.col("base") + F.pmod(F.xxhash64("row"), "parts")).cast("int").alias("tile")
        )
    )
    scratch.drop(turned)
    tiles = placed.groupBy(*group, "tile").agg(F.min("lead").alias("lo"), F.max("lead").alias("hi"))
    tiles = scratch.write(tiles)
    other = tiles.select(*group, F.col("tile").alias("tile2"), F.col("lo").alias("lo2"), F.col("hi").alias("hi2"))
    # Unit vectors of cosine t are sqrt(2 - 2t) apart, so along the leading axis at most that.
    apart = math.sqrt(max(0.0, 2 - 2 * threshold)) + SLACK
    pairs = tiles.join(other, group).where(
        (F.col("tile") <= F.col("tile2")) & (F.col("lo2") - F.col("hi") <= apart) & (F.col("lo") - F.col("hi2") <= apart)
    )
    pairs = pairs.select(*group, "tile", "tile2")
    sides = pairs.select(*group, "tile", "tile2", F.explode(F.array_distinct(F.array("tile", "tile2"))).alias("own"))
    members = sides.join(placed.withColumnRenamed("tile", "own"), [*group, "own"])

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        own, second = pdf["own"].to_numpy(), pdf["tile2"].iat[0]
        rows = np.stack([np.frombuffer(x) for x in pdf["unit"]])
        ids = pdf["row"].to_numpy()
        labels, links = np.arange(len(ids)), np.zeros(len(ids), np.int64)
        one = np.nonzero(own == pdf["tile"].iat[0])[0]
        two = np.nonzero(own == second)[0]
        for s in range(0, len(one), 1024):
            some = one[s : s + 1024]
            a, b = similar(rows[some], rows[two], threshold)
            a, b = some[a], two[b]
            if pdf["tile"].iat[0] == second:
                a, b = a[a < b], b[a < b]
            links += np.bincount(a, minlength=len(ids)) + np.bincount(b, minlength=len(ids))
            join_labels(labels, a, b)
        hit = links > 0
        return pd.DataFrame({"row": ids[hit], "n": links[hit], "to": ids[labels[hit]]})

    return members.groupBy(*group, "tile", "tile2").applyInPandas(compare, "row long, n long, to long")


def embedding_groups(
    table: DataFrame,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    label: str = "label",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """(vec_id, n_links, component_id, kept): one row per row of ``table``.

    Vectors of equal label, not null, and equal length are linked when their
    cosine in double precision reaches ``threshold``. Vectors that are null,
    empty or zero, or hold null or non-finite components, link with nothing
    and are groups of their own. Every row is a vector of its own, whether its
    id is null or repeats; ``component_id`` is the smallest id of the group's
    rows and null only where none has an id. An empty table gives an empty
    result; further columns are not read.
    """
    scratch = Scratch(table.sparkSession, "embeddings")
    rows = scratch.write(
        table.select(
            F.monotonically_increasing_id().alias("row"),
            F.col(vec_id).cast("long").alias("vec_id"),
            F.col(label).alias("label"),
            F.col(embedding).cast("array<double>").alias("v"),
        )
    )
    fit = rows.where(F.col("label").isNotNull() & usable(F.col("v"))).drop("vec_id")
    found = scratch.write(vector_links(fit, scratch, threshold))
    linked = scratch.write(connected_components(found.select(F.col("row").alias("a"), F.col("to").alias("b")), scratch))
    counts = found.groupBy("row").agg(F.sum("n").alias("n_links"))
    ids = rows.select("row", "vec_id")
    linked = linked.withColumnRenamed("node", "row")
    # Groups meet in minima, which combine before they move; rows without links take no part.
    smallest = linked.join(ids, "row").groupBy("component").agg(F.min("vec_id").alias("least"))
    groups = linked.join(smallest, "component").select("row", "least", F.lit(True).alias("in_group"))
    return (
        ids.join(groups, "row", "left")
        .join(counts, "row", "left")
        .select(
            "vec_id",
            F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
            F.when(F.col("in_group"), F.col("least")).otherwise(F.col("vec_id")).alias("component_id"),
        )
        .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
    )
