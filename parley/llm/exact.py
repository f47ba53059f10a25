"""Exact duplicates: local, salted and global combining of equal texts, in DataFrame functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.llm.common import Scratch

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Tasks that may share the rows of one text; at most 64, as a set of salts is the bits of a long.
SALTS = 32


def normalised(text: Column) -> Column:
    """``text`` with A-Z lower-cased and nothing else changed; null is the empty text.

    In a text of single bytes only, ``lower`` does the same and is faster.
    """
    whole = F.coalesce(text, F.lit(""))
    return F.when(F.octet_length(whole) == F.char_length(whole), F.lower(whole)).otherwise(F.translate(whole, UPPER, LOWER))


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def text_totals(rows: DataFrame, salts: int = SALTS) -> DataFrame:
    """(digest, texts, keep_id, group_size) from ``rows`` (doc_id, digest, body).

    Rows are combined inside each task first, since all rows of a task share a
    salt; its winners meet by digest, salt and body, and the winners of the
    salts by digest and body. The body is a grouping key every time, so only
    identical texts are ever combined. A frequent text thus reaches a task once
    for each task that read it, dealt over ``salts`` tasks. ``texts`` counts the
    different bodies of a digest; the other columns speak of all of them together.
    """
    salt = F.pmod(F.spark_partition_id(), F.lit(salts)).alias("salt")
    salted = rows.groupBy("digest", salt, "body").agg(F.max("doc_id").alias("top"), F.count("*").alias("n"))
    whole = salted.repartition("digest").groupBy("digest", "body").agg(F.max("top").alias("top"), F.sum("n").alias("n"))
    return whole.groupBy("digest").agg(
        F.count("*").alias("texts"), F.max("top").alias("keep_id"), F.sum("n").alias("group_size")
    )


def _decide(keys: DataFrame, totals: DataFrame, by: list[str], salts: int) -> DataFrame:
    """``keys`` (own, doc_id, row, *by) with its group's keep_id and group_size, and kept, true for one row.

    A group's totals are repeated for the salts its rows have, so never more
    often than it has rows, and a frequent group meets them in several tasks.
    """
    salt = F.pmod(F.col("row"), F.lit(salts)).cast("int")
    keys = keys.withColumn("salt", salt)
    heads = keys.groupBy(*by).agg(
        F.max(F.struct("doc_id", (-F.col("row")).alias("minus"))).alias("head"),
        F.bit_or(F.expr("shiftleft(1L, salt)")).alias("used"),
    )
    groups = heads.join(totals, by).select(
        *by,
        "keep_id",
        "group_size",
        (-F.col("head.minus")).alias("head"),
        F.explode(F.expr(f"filter(sequence(0, {salts - 1}), s -> getbit(used, s) = 1)")).alias("salt"),
    )
    return keys.join(groups, [*by, "salt"]).select(
        "own", "keep_id", "group_size", (F.col("row") == F.col("head")).alias("kept"), "digest"
    )


def exact_groups(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    columns: list[str] | None = None,
    digest: Callable[[Column], Column] = sha256,
    salts: int = SALTS,
) -> DataFrame:
    """Each row's ``columns`` (all but the text unless given) with keep_id, group_size, kept and digest.

    Texts are equal when identical after lower-casing A-Z; a null text counts
    as empty, and empty texts are equal. The row with the largest ``doc_id`` of
    equal texts stays: ``keep_id`` is its id and exactly one row has ``kept``, also
    where rows repeat or have no id. Null ids come before all others, so
    ``keep_id`` is null only where no row of the group has an id. An empty table
    gives an empty result. Columns with the names of the added ones are replaced.

    Ids and digests are written once; texts go through ``text_totals``. Where
    that finds one text for a digest, as always with SHA-256, the digest stands
    for the text from then on; rows of other digests are decided by their texts.
    """
    scratch = Scratch(docs.sparkSession, "exact")
    added = ("keep_id", "group_size", "kept", "digest")
    own = [c for c in (columns if columns is not None else [c for c in docs.columns if c != text]) if c not in added]
    kept = F.struct(*[F.col(c) for c in own]) if own else F.lit(None)
    rows = docs.select(kept.alias("own"), F.col(doc_id).alias("doc_id"), normalised(F.col(text)).alias("body"))
    rows = rows.withColumn("digest", digest(F.col("body")))
    number = F.monotonically_increasing_id().alias("row")
    keys = scratch.write(rows.select("own", "doc_id", "digest", number))
    totals = scratch.write(text_totals(rows.select("doc_id", "digest", "body"), salts))
    decided = _decide(keys, totals.where("texts = 1").drop("texts"), ["digest"], salts)
    shared = totals.where("texts > 1").select("digest")
    if shared.limit(1).count():
        # Different texts of one digest: only these rows are told apart by their whole texts.
        doubtful = scratch.write(rows.join(shared, "digest", "left_semi").select("own", "doc_id", "digest", "body", number))
        salt = F.pmod(F.col("row"), F.lit(salts))
        parts = doubtful.groupBy("digest", salt.alias("salt"), "body").agg(F.max("doc_id").alias("top"), F.count("*").alias("n"))
        by_text = parts.groupBy("digest", "body").agg(F.max("top").alias("keep_id"), F.sum("n").alias("group_size"))
        decided = decided.unionByName(_decide(doubtful, by_text, ["digest", "body"], salts))
    return decided.select(*(["own.*"] if own else []), *added)


def first_of_equal(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    whole = docs.select(F.struct("*").alias("__row"), F.col(text).alias("__text"), F.col(doc_id).alias("__id"))
    return exact_groups(whole, "__text", "__id", ["__row"]).where("kept").select("__row.*")
