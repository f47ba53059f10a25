"""Model replies: JSON lines, perhaps fenced, perhaps partly broken."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.functions.jsontext import strict_parse
from parley.functions.text import SPACE, strip

# ---- fixed values: reply syntax --------------------------------------------
FENCE = r"(?i)```[a-z]*\n?"
LINE_BREAK = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\x{2028}\x{2029}]"
BOM = r"\A\x{feff}+"
WARNING_CHARS = 80


def reply_lines(raw: Column) -> Column:
    """Lines of a reply without code fences, as an array."""
    return F.split(strip(F.regexp_replace(raw, FENCE, "")), LINE_BREAK, -1)


def parse_jsonl(replies: DataFrame, raw: str, *keep: str) -> DataFrame:
    """One row per non-blank line: ``*keep, lineno, line, record, ok``.

    ``record`` is the parsed VARIANT; ``ok`` is false for a line that is not JSON.
    """
    line = F.regexp_replace(strip(F.col("_line")), BOM, "")
    return (
        replies.select(*keep, F.posexplode(reply_lines(F.col(raw))).alias("_pos", "_line"))
        .select(*keep, (F.col("_pos") + 1).alias("lineno"), line.alias("line"))
        .filter(F.col("line") != "")
        .withColumn("record", strict_parse(F.col("line")))
        .withColumn("ok", F.col("record").isNotNull())
    )


def line_warnings(lines: DataFrame, *keep: str) -> DataFrame:
    """Dropped lines with number and the opening characters, for the log."""
    return lines.filter(~F.col("ok")).select(
        *keep, "lineno", F.substring("line", 1, WARNING_CHARS).alias("excerpt")
    )


def rejected_lines(lines: DataFrame, *keep: str) -> DataFrame:
    """Dropped lines as they came; with the parsed ones they are the input."""
    return lines.filter(~F.col("ok")).select(*keep, "lineno", "line")


def unparsed_replies(replies: DataFrame, raw: str, key: str) -> DataFrame:
    """Whole replies in which no line parses, kept as they came; a NULL reply is one of them.

    Decided inside each row, so that no reply is shuffled and a reply with very
    many lines meets no grouping.
    """
    lines = F.transform(
        reply_lines(F.col(raw)), lambda x: F.regexp_replace(strip(x), BOM, "")
    )
    parses = F.exists(lines, lambda x: (x != "") & strict_parse(x).isNotNull())
    return replies.filter(~F.coalesce(parses, F.lit(False))).select(key, F.col(raw).alias("raw"))
