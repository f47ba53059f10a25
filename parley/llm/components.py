"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.llm.common import Scratch


def connected_components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, component) for each node of ``edges`` (a, b); the component is its smallest node.

    Loops, repeated edges and edges with a null end add nothing. Each round
    joins every node to the smallest node it sees; groups meet only in
    minima, which combine before they move, and in joins that adaptive
    execution can split. Rounds grow with the logarithm of the longest path.
    Edges are written to the shared folder after each round, and the round
    before is removed.
    """
    links = scratch.write(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .where("u is not null and v is not null and u != v")
        .distinct()
    )
    state = _state(links)
    while state[0]:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), F.least("u", "m").alias("m"))
        large = both.join(least, both.u == least.k).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        roots = least.select("u", F.col("m").alias("v"))
        rest = large.join(least.withColumnRenamed("u", "k"), F.col("u") == F.col("k")).where("v != m")
        small = rest.select(F.col("v").alias("u"), F.col("m").alias("v"))
        after = scratch.write(roots.unionByName(small).distinct())
        before, state = state, _state(after)
        scratch.drop(links)
        links = after
        if state == before:
            break
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )


def _state(links: DataFrame) -> tuple:
    """Equal for equal sets of edges."""
    hashed = F.xxhash64("u", "v").cast("decimal(38,0)")
    return tuple(links.agg(F.count("*"), F.sum(hashed)).first())
