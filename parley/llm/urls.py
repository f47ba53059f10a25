"""URL rules, carried over to aliases by redirects and canonical links."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.llm.common import Scratch
from parley.llm.components import connected_components

RULES = [
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
]
# Both engines that check these patterns read them alike.
HAS_LINK = r"(?i)canonical|http-equiv"
TAG = r"(?i)<(?:link|meta)\b[^>]*>"
CANONICAL = r"(?i)^<link\b.*\brel\s*=\s*[\"']?[^\"'>]*\bcanonical\b"
HREF = r"(?i)\bhref\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))"
REFRESH = r"(?i)^<meta\b.*\bhttp-equiv\s*=\s*[\"']?refresh\b"
REFRESH_URL = r"(?i)\burl\s*=\s*[\"']?([^\"'>\s]+)"
ABSOLUTE = r"^[A-Za-z][A-Za-z0-9+.-]*://"
SCHEME = r"^[A-Za-z][A-Za-z0-9+.-]*:"
HOST_PATH = r"^([^/?#]*)([^?#]*)(\??[^#]*)"


def with_address(df: DataFrame, url: str) -> DataFrame:
    """``df`` with host, path and address of a column of urls.

    The host, A-Z lower-cased, is what follows the first ``://`` up to ``/``,
    ``?`` or ``#``, the path what follows up to ``?`` or ``#``; both are empty for a
    null url or one without ``://``. The address is what aliases share whatever
    their scheme and fragment: host, path and query; null where there is no ``://``.
    """
    start = F.instr(url, "://")
    rest = F.when(start > 0, F.substring(F.col(url), start + 3, F.length(url)))
    # Step by step: an expression used several times is worked out once.
    parts = df.withColumn("__rest", rest).withColumns(
        {f"__{i}": F.coalesce(F.regexp_extract("__rest", HOST_PATH, i), F.lit("")) for i in (1, 2, 3)}
    )
    parts = parts.withColumn("host", F.translate("__1", string.ascii_uppercase, string.ascii_lowercase))
    query = F.when(F.col("__3") == "?", "").otherwise(F.col("__3"))
    address = F.concat("host", F.when(F.col("__2") == "", "/").otherwise(F.col("__2")), query)
    parts = parts.withColumns({"path": F.col("__2"), "address": F.when(F.col("__rest").isNotNull(), address)})
    return parts.drop("__rest", "__1", "__2", "__3")


def best_rule(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """The longest rule (action, rule) that fits, null if none does.

    A rule is a host and a path from its first ``/`` on. It fits that host and
    all its subdomains, where the path starts with the rule's. Of equally long
    rules the first in the alphabet wins, an allowing one before a blocking one.
    """
    ordered = sorted(set(rules), key=lambda r: (-len(r[1]), r[1], r[0]))
    out = F.lit(None).cast("struct<action:string,rule:string>")
    for action, rule in reversed(ordered):
        own, slash, rest = rule.partition("/")
        fits = ((host == own) | F.endswith(host, F.lit(f".{own}"))) & F.startswith(path, F.lit(slash + rest))
        out = F.when(fits, F.struct(F.lit(action).alias("action"), F.lit(rule).alias("rule"))).otherwise(out)
    return out


def page_links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(a, b): addresses of pages and of what their canonical links and refreshes name, null where that is no address.

    Relative references are resolved against the page's address; references
    with another scheme than a web address's are left out.
    """
    tags = pages.where(F.col(html).rlike(HAS_LINK) & F.col(url).isNotNull()).select(
        F.col(url).alias("url"), F.explode(F.regexp_extract_all(F.col(html), F.lit(TAG), F.lit(0))).alias("tag")
    )
    href = F.concat(*[F.regexp_extract("tag", HREF, i) for i in (1, 2, 3)])
    named = F.when(F.col("tag").rlike(CANONICAL), href).when(
        F.col("tag").rlike(REFRESH), F.regexp_extract("tag", REFRESH_URL, 1)
    )
    found = tags.select("url", F.replace(F.trim(named), F.lit("&amp;"), F.lit("&")).alias("to")).where("to != ''")
    found = with_address(found, "url").withColumnRenamed("address", "a").withColumn("base", F.concat(F.lit("x://"), "host"))
    # A page without a path is at the root.
    folder = F.regexp_replace(F.when(F.col("path") == "", "/").otherwise(F.col("path")), "[^/]*$", "")
    target = (
        F.when(F.col("to").rlike(ABSOLUTE), F.col("to"))
        .when(F.startswith("to", F.lit("//")), F.concat(F.lit("x:"), "to"))
        .when(F.startswith("to", F.lit("/")), F.concat("base", "to"))
        .when(F.startswith("to", F.lit("?")), F.concat("base", "path", "to"))
        .when(F.startswith("to", F.lit("#")) | F.col("to").rlike(SCHEME), None)
        .otherwise(F.concat(F.col("base"), folder, F.col("to")))
    )
    found = with_address(found.select("a", target.alias("target")), "target").withColumnRenamed("address", "b")
    return found.select("a", "b")


def judge_urls(
    pages: DataFrame,
    rules: list[tuple[str, str]] = RULES,
    links: DataFrame | None = None,
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
) -> DataFrame:
    """(page_id, host, path, rule, verdict) for each row of ``pages``.

    A page's own rule decides, so an explicit allow is never overruled. A page
    without one is blocked if it is an alias of a blocked address: if a chain
    of canonical links, refreshes and ``links`` (a, b: addresses as
    ``with_address`` gives them, such as a redirect log) joins them, and no
    address of that chain is explicitly allowed. All others are allowed. A null
    url, or one without ``://``, has an empty host and path, no rule and no
    alias. Null html has no links. Rows repeat as they do in ``pages``; further
    columns are not read; an empty table gives an empty result. The rules are a
    list that every task holds; addresses stay distributed.
    """
    scratch = Scratch(pages.sparkSession, "urls")
    # Written first, since a filter on the addresses would be worked out from the pages again.
    edges = scratch.write(page_links(pages, url, html))
    if links is not None:
        edges = edges.unionByName(links.select("a", "b"))
    linked = connected_components(edges, scratch)
    at = with_address(linked.withColumn("at", F.concat(F.lit("x://"), "node")), "at")
    judged = at.withColumn("action", best_rule(F.col("host"), F.col("path"), rules)["action"])
    aliases = judged.groupBy("component").agg(
        F.bool_or(F.col("action").eqNullSafe(F.lit("block"))).alias("blocked"),
        F.bool_or(F.col("action").eqNullSafe(F.lit("allow"))).alias("allowed"),
    )
    blocked = aliases.where("blocked and not allowed").join(linked, "component").select(F.col("node").alias("alias"))
    rows = with_address(pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("__url")), "__url").drop("__url")
    rows = rows.withColumn("best", best_rule(F.col("host"), F.col("path"), rules))
    found = rows.join(blocked, F.col("address") == F.col("alias"), "left")
    verdict = F.coalesce("best.action", F.when(F.col("alias").isNotNull(), "block").otherwise("allow"))
    return found.select("page_id", "host", "path", F.col("best.rule").alias("rule"), verdict.alias("verdict"))
