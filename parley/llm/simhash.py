"""SimHash near-duplicates: vantage-point trees over 64-bit fingerprints."""

from __future__ import annotations

from itertools import islice, repeat

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parley.llm.common import Scratch, utf8, with_python_columns
from parley.llm.components import connected_components
from parley.llm.local_forest import join_labels

SHINGLE_WORDS = 3
MAX_DISTANCE = 3
# Fingerprints the tree is fitted on; all are routed through it.
TREE_SAMPLE = 16_384
# Leaves of the tree are not cut below about this many of all fingerprints. Each cut sends those near its
# boundary to both sides, which costs more than comparing them within a task until leaves are this large.
LEAF = 16_384
# Fingerprints that one task compares: residents of a leaf, and those that come to them.
RESIDENTS, VISITORS = 16_384, 65_536
BLOCK = 1 << 16
CELLS = 1 << 21


def fingerprint(text: bytes) -> int:
    """64 majority bits over the text's shingles, as a signed long; zero for a text without words.

    Words are runs of bytes other than ASCII white space, A-Z lower-cased. A
    text of fewer words than a shingle is one shingle. Repeated shingles count
    as often as they stand; a bit that half of them set is 0.
    """
    words = text.lower().split()
    if not words:
        return 0
    if len(words) < SHINGLE_WORDS:
        return int(np.uint64(xxhash.xxh64_intdigest(b" ".join(words), 42)).astype(np.int64))
    shingles = map(b" ".join, zip(*(islice(words, i, None) for i in range(SHINGLE_WORDS))))
    total = len(words) - SHINGLE_WORDS + 1
    hashes = map(xxhash.xxh64_intdigest, shingles, repeat(42))
    ones = np.zeros(64, np.int64)
    for start in range(0, total, BLOCK):
        part = np.fromiter(islice(hashes, BLOCK), np.uint64, min(BLOCK, total - start))
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > total, bitorder="little").view(np.int64)[0])


def with_fingerprints(docs: DataFrame, text: str = "text", out: str = "fp") -> DataFrame:
    """``docs`` with a long column of fingerprints; null texts count as empty."""
    return with_python_columns(
        docs,
        utf8(F.col(text)),
        [T.StructField(out, T.LongType())],
        lambda: lambda texts: [[fingerprint(t) for t in texts]],
    )


# -- the tree ------------------------------------------------------------------


def _distances(points: np.ndarray, vantage: np.uint64) -> np.ndarray:
    return np.bitwise_count(points ^ vantage).astype(np.int16)


def fit_tree(sample: np.ndarray, leaf: int, reach: int) -> list[tuple]:
    """Nodes (vantage, radius, inner child, outer child); a negative child -k-1 is leaf k.

    Of a few vantage points and all radii the one is taken that leaves the
    fewest comparisons, counting points near the boundary on both sides. A
    part that no radius makes cheaper stays whole.
    """
    nodes: list[tuple] = []
    leaves = 0

    def grow(points: np.ndarray) -> int:
        nonlocal leaves
        best = None
        if len(points) > leaf:
            whole = len(points) ** 2 / 2
            for vantage in points[:: max(1, len(points) // 12)][:12]:
                count = np.bincount(_distances(points, vantage), minlength=65 + reach)
                inner = np.cumsum(count)
                for radius in range(64):
                    n = inner[radius]
                    outer = len(points) - n
                    if n < leaf / 4 or outer < leaf / 4:
                        continue
                    near = n - (inner[radius - reach] if radius >= reach else 0)
                    cost = n * n / 2 + outer * outer / 2 + near * outer
                    if cost < 0.95 * whole and (best is None or cost < best[0]):
                        best = (cost, vantage, radius)
        if best is None:
            leaves += 1
            return -leaves
        _, vantage, radius = best
        nodes.append(None)
        at = len(nodes) - 1
        inside = _distances(points, vantage) <= radius
        nodes[at] = (vantage, radius, grow(points[inside]), grow(points[~inside]))
        return at

    grow(sample)
    return nodes


def route(nodes: list[tuple], points: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(index of the point, leaf, at home). A point is at home in one leaf and visits all others that may hold a partner.

    Partners differ by at most ``reach``, so by the triangle inequality their
    distances from a vantage point do, too. Where two partners part, only the
    inner one visits the outer side.
    """
    if not nodes:
        return np.arange(len(points)), np.zeros(len(points), np.int32), np.ones(len(points), bool)
    found = []
    stack = [(0, np.arange(len(points)), np.ones(len(points), bool))]
    while stack:
        node, index, home = stack.pop()
        if node < 0:
            found.append((index, np.full(len(index), -node - 1, np.int32), home))
            continue
        vantage, radius, inner, outer = nodes[node]
        d = _distances(points[index], vantage)
        go = np.where(home, d <= radius, d - reach <= radius)
        if go.any():
            stack.append((inner, index[go], home[go]))
        go = d + reach > radius
        if go.any():
            stack.append((outer, index[go], home[go] & (d[go] > radius)))
    return tuple(np.concatenate(x) for x in zip(*found))


def link_labels(residents: np.ndarray, visitors: np.ndarray, among: bool, reach: int) -> np.ndarray:
    """For each of residents and visitors the smallest index it is linked with, directly or through others here.

    Residents are sorted by their distances from two vantage points; only
    cells whose distances differ by at most ``reach`` are compared.
    """
    everyone = np.concatenate([residents, visitors])
    labels = np.arange(len(everyone))
    if not len(residents):
        return labels
    first = residents[0]
    d1 = _distances(everyone, first)
    second = everyone[np.argmin(np.abs(d1 - 32))]
    key = d1.astype(np.int64) * 128 + _distances(everyone, second)
    order = np.argsort(key[: len(residents)], kind="stable")
    sorted_key, sorted_points = key[: len(residents)][order], residents[order]
    asking = np.arange(0 if among else len(residents), len(everyone))
    asking = asking[np.argsort(key[asking], kind="stable")]
    cells, starts = np.unique(key[asking], return_index=True)
    for cell, lo, hi in zip(cells, starts, [*starts[1:], len(asking)]):
        for ring in range(-reach, reach + 1):
            at = cell + ring * 128
            left, right = np.searchsorted(sorted_key, [at - reach, at + reach + 1])
            if left == right:
                continue
            step = max(1, CELLS // (right - left))
            for s in range(lo, hi, step):
                who = asking[s : min(hi, s + step)]
                for t in range(left, right, CELLS):
                    to = slice(t, min(right, t + CELLS))
                    near = np.bitwise_count(everyone[who][:, None] ^ sorted_points[to][None, :]) <= reach
                    a, b = np.nonzero(near)
                    join_labels(labels, who[a], order[to][b])
    return labels


# -- the distributed search ----------------------------------------------------


def near_links(points: DataFrame, scratch: Scratch, reach: int = MAX_DISTANCE) -> DataFrame:
    """Links (a, b) that join all of ``points`` (fp, distinct) as their pairs within ``reach`` bits do.

    Every pair is compared or excluded by a triangle bound; of the pairs found
    in one task only a spanning forest is returned, so that a dense group
    gives no more rows than it has members. The tree is fitted on a bounded
    sample. A leaf with many residents, such as a large group of near copies,
    is cut into blocks that meet pairwise in different tasks.
    """
    spark = points.sparkSession
    total = points.count()
    rows = points.orderBy(F.xxhash64("fp"), "fp").limit(TREE_SAMPLE).collect()
    sample = np.array([r["fp"] for r in rows], np.int64).view(np.uint64)
    nodes = fit_tree(sample, max(24, int(len(sample) * LEAF / max(1, total))), reach)

    def send(batches):
        for pdf in batches:
            index, leaf, home = route(nodes, pdf["fp"].to_numpy(np.int64).view(np.uint64), reach)
            yield pd.DataFrame({"fp": pdf["fp"].to_numpy()[index], "leaf": leaf, "home": home})

    routed = scratch.write(points.select("fp").mapInPandas(send, "fp long, leaf int, home boolean"))
    sizes = routed.groupBy("leaf").agg(
        F.count_if("home").alias("residents"), F.count_if(~F.col("home")).alias("visitors")
    )
    blocks = F.greatest(F.lit(1), F.ceil(F.col("residents") / RESIDENTS)).cast("int")
    come = F.col("visitors") + F.when(F.col("blocks") > 1, F.col("residents")).otherwise(0)
    sizes = sizes.withColumn("blocks", blocks).withColumn(
        "parts", F.greatest(F.lit(1), F.ceil(come / VISITORS)).cast("int")
    )
    # One row per leaf of a tree whose size the sample bounds.
    sizes = spark.createDataFrame(sizes.select("leaf", "blocks", "parts").collect(), "leaf int, blocks int, parts int")
    h = F.xxhash64("fp")
    dealt = routed.join(F.broadcast(sizes), "leaf").withColumns(
        {"block": F.when(F.col("home"), F.pmod(h, "blocks").cast("int")), "part": F.pmod(h, F.lit(7919)) % F.col("parts")}
    )
    dealt = dealt.withColumn("part", F.col("part").cast("int"))
    at_home = dealt.where("home").select(
        "leaf", "block", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(True).alias("home"), "fp"
    )
    first = F.when(F.col("home"), F.col("block") + 1).otherwise(0)
    coming = dealt.where("not home or block + 1 < blocks").select(
        "leaf", F.explode(F.sequence(first, F.col("blocks") - 1)).alias("block"), "part", F.lit(False).alias("home"), "fp"
    )

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        home = pdf["home"].to_numpy()
        points = pdf["fp"].to_numpy(np.int64)
        residents, visitors = np.sort(points[home]), np.sort(points[~home])
        labels = link_labels(residents.view(np.uint64), visitors.view(np.uint64), bool(pdf["part"].iat[0] == 0), reach)
        everyone = np.concatenate([residents, visitors])
        linked = np.nonzero(labels != np.arange(len(labels)))[0]
        return pd.DataFrame({"a": everyone[linked], "b": everyone[labels[linked]]})

    return at_home.unionByName(coming).groupBy("leaf", "block", "part").applyInPandas(compare, "a long, b long")


def simhash_groups(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", reach: int = MAX_DISTANCE
) -> DataFrame:
    """(doc_id, digest, fp, component, component_id) for each row of ``docs``.

    Documents whose fingerprints differ in at most ``reach`` bits are linked;
    ``component_id`` is the smallest id reachable, ``component`` the smallest
    fingerprint, ``digest`` the MD5 of the text. Equal fingerprints are one
    point of the search, so large groups of copies add nothing to it. Rows
    repeat as they do in ``docs``; a null id is never the smallest unless a
    group has no other. Empty and null texts have fingerprint zero and are
    linked like any other. An empty table gives an empty result; further
    columns are not read.
    """
    scratch = Scratch(docs.sparkSession, "simhash")
    body = utf8(F.col(text))
    given = docs.select(F.col(doc_id).alias("doc_id"), F.md5(body).alias("digest"), F.col(text).alias("text"))
    marked = scratch.write(with_fingerprints(given, "text").drop("text"))
    points = scratch.write(marked.groupBy("fp").agg(F.min("doc_id").alias("first")))
    linked = scratch.write(connected_components(near_links(points.select("fp"), scratch, reach), scratch))
    member = points.join(linked, points.fp == linked.node, "left").select(
        "fp", "first", F.coalesce("component", "fp").alias("component")
    )
    smallest = member.groupBy("component").agg(F.min("first").alias("component_id"))
    groups = member.join(smallest, "component").select("fp", "component", "component_id")
    return marked.join(groups, "fp").select("doc_id", "digest", "fp", "component", "component_id")


def first_of_group(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of ``docs`` for each group of near copies: one with the smallest id.

    Where several rows of a group have that id, the one whose text has the
    smallest MD5 stays; where they repeat with the same text, any of them.
    """
    ours = simhash_groups(docs, doc_id, text).where("doc_id <=> component_id")
    ours = ours.groupBy("component", "digest").agg(F.count("*").alias("n"), F.min("doc_id").alias("id"))
    stays = ours.groupBy("component").agg(F.min(F.struct("digest", "id", "n")).alias("s"))
    # Names that no column of ``docs`` has.
    mark = "_" * (1 + max(map(len, docs.columns)))
    own, known, many = mark + "id", mark + "digest", mark + "n"
    stays = stays.select(F.col("s.id").alias(own), F.col("s.digest").alias(known), F.col("s.n").alias(many))
    digest = F.md5(utf8(docs[text]))
    rows = docs.join(stays, (digest == F.col(known)) & docs[doc_id].eqNullSafe(F.col(own)))
    single = rows.where(F.col(many) == 1).select(*[docs[c] for c in docs.columns])
    several = rows.where(F.col(many) > 1).dropDuplicates([own, known]).select(*[docs[c] for c in docs.columns])
    return single.unionByName(several)
