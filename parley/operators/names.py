"""Masking names of one list that all rows share, at a cost that does not grow with the list."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.functions.text import NAME_TOKEN, WIDE, WORD, java, longest_first
from parley.session import cut_lineage

# Bounds of a list that becomes part of the expression; a longer one is joined.
INLINE_NAMES, INLINE_BYTES = 50_000, 2 << 20
_WORDS = java(f"[{WORD}]+")


def word_runs(text: Column, longest: int) -> Column:
    """The different runs of 1 to ``longest`` words of ``text``, each joined by blanks."""
    words = F.regexp_extract_all(text, F.lit(_WORDS), F.lit(0))

    def runs(w: Column, n: int) -> Column:
        if n == 1:
            return w
        starts = F.when(F.size(w) >= n, F.sequence(F.lit(1), F.size(w) - n + 1)).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.concat_ws(" ", *[F.element_at(w, i + k) for k in range(n)]))

    # The lambda binds the words, which every length needs.
    return F.get(F.transform(F.array(words), lambda w: F.array_distinct(F.concat(*[runs(w, n) for n in range(1, longest + 1)]))), F.lit(0))


def replace_found(text: Column, found: Column) -> Column:
    """``text`` with each of its names replaced where it stands as whole words, the longest of those that begin at a place."""
    pattern = F.concat(F.lit(f"(?<![{WORD}{WIDE}])(?:"), F.array_join(longest_first(found), "|"), F.lit(f")(?![{WORD}])"))
    return F.when(F.size(found) > 0, F.regexp_replace(text, pattern, F.lit(NAME_TOKEN))).otherwise(text)


def clean_list(names: DataFrame, name: str = "name") -> DataFrame:
    """Distinct usable entries: words of letters, digits and underscores with single blanks between them."""
    usable = F.rlike(F.col(name), F.lit(f"^[{WORD}]+( [{WORD}]+)*$"))
    return names.filter(usable).select(F.col(name).alias("name")).distinct()


def mask_listed(df: DataFrame, columns: list[str], names: DataFrame, key: str, name: str = "name", inline: int = INLINE_NAMES) -> DataFrame:
    """``df`` with the names of the shared list ``names`` masked in ``columns``.

    Names are matched as whole words, upper and lower case apart; of several that
    begin at one place the longest counts, and the search goes on behind it. Other
    entries than words with single blanks between them are left out. Each text's
    runs of words are looked up in the list by hash, so one scan serves any number
    of names: as part of the expression while the list is counted and measured to
    be small, else in a join of runs with names, whose hits are brought back by ``key``,
    which names a row. NULL stays NULL; an empty list changes nothing.
    """
    listed = cut_lineage(clean_list(names, name))
    blanks = F.length("name") - F.length(F.replace("name", F.lit(" "), F.lit("")))
    n, size, longest = listed.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("name")), F.lit(0)), F.max(blanks + 1)).first()
    if not n:
        return df
    if n <= inline and size <= INLINE_BYTES:
        # Counted and measured just now. Words have no quotes or backslashes, so they stand in SQL as they are.
        quoted = ",".join(f"'{r['name']}'" for r in listed.collect())

        out = df
        for i, c in enumerate(columns):
            runs, found = f"__runs{i}", f"__found{i}"
            out = out.withColumn(runs, word_runs(F.col(c), longest))
            out = out.withColumn(found, F.expr(f"filter({runs}, run -> run in ({quoted}))"))
            out = out.withColumn(c, replace_found(F.col(c), F.col(found)))
        return out.select(*df.columns)
    hits = None
    for i, c in enumerate(columns):
        runs = df.select(F.col(key).alias("__key"), F.explode(word_runs(F.col(c), longest)).alias("name"))
        met = runs.join(listed, "name").groupBy("__key").agg(F.collect_set("name").alias(f"__found{i}"))
        hits = met if hits is None else hits.join(met, "__key", "full_outer")
    joined = df.join(hits, F.col(key) == F.col("__key"), "left")
    none = F.array().cast("array<string>")
    out = {c: replace_found(F.col(c), F.coalesce(F.col(f"__found{i}"), none)) for i, c in enumerate(columns)}
    return joined.withColumns(out).select(*df.columns)
