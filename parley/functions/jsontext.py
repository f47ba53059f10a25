"""Strict JSON reading on top of Spark's lenient parsers."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


# Closes the array a text is wrapped in, see strict_parse.
END_MARK = "#end-of-text#"
# Both mean strict quotes; the second engine reads texts of any length.
STRICT = {"allowSingleQuotes": "false"}
KEEP_LAST = "spark.sql.variant.allowDuplicateKeys"


def _may_be_json(text: Column) -> Column:
    """False for text that cannot start a JSON value. Prose fails here at once,
    whereas a failed parse costs an exception."""
    return F.rlike(text, F.lit(r'\A[ \t\r\n]*(?:[\[{"0-9-]|true|false|null)'))


def _one_value(text: Column) -> Column:
    """True when the text is one JSON value, for texts of any size.

    Spark's parsers stop after the first value, so ``[1] x`` would pass. Two
    enclosing arrays settle it: an early closing bracket yields the same length
    in both, and so cannot give 1 and 2.
    """
    alone = F.size(F.from_json(F.concat(F.lit("["), text, F.lit("]")), "array<string>", STRICT))
    followed = F.size(F.from_json(F.concat(F.lit("["), text, F.lit(",0]")), "array<string>", STRICT))
    return F.when(_may_be_json(text), (alone == 1) & (followed == 2))


def strict_parse(text: Column) -> Column:
    """VARIANT of a text that is exactly one JSON value, else NULL.

    One parse of the text in an array that ends in a mark: the mark comes second
    only when the text is a single value. A text that holds the mark itself takes
    the longer way. The last of a repeated key counts, as JSON readers commonly
    have it; Spark is told so in the session. A value too long for a VARIANT gives
    NULL, too: callers keep its whole text among their rejects.
    """
    session = SparkSession.getActiveSession()
    if session is not None and session.conf.get(KEEP_LAST, "false") != "true":
        session.conf.set(KEEP_LAST, "true")
    marked = F.try_parse_json(F.concat(F.lit("["), text, F.lit(f',"{END_MARK}"]')))
    # The lambda binds the parsed value, which is looked at twice, so it is parsed once.
    single = F.filter(F.array(marked), lambda v: F.try_variant_get(v, "$[1]", "string") == END_MARK)
    value = F.try_variant_get(F.get(single, F.lit(0)), "$[0]", "variant")
    unsure = F.contains(text, F.lit(END_MARK))
    return F.when(unsure, F.when(_one_value(text), F.try_parse_json(text))).when(_may_be_json(text), value)


def is_json(text: Column) -> Column:
    """True when the whole text is one JSON value, by the same reading for texts of any length."""
    return F.coalesce(_one_value(text), F.lit(False))


def is_object_text(text: Column) -> Column:
    """True for a text that begins like an object; cheaper than a look at the parsed value."""
    return F.coalesce(F.rlike(text, F.lit(r"\A[ \t\r\n]*\{")), F.lit(False))


def is_object(value: Column) -> Column:
    return F.coalesce(F.schema_of_variant(value).startswith("OBJECT"), F.lit(False))


def is_array(value: Column) -> Column:
    return F.coalesce(F.schema_of_variant(value).startswith("ARRAY"), F.lit(False))


def has_field(value: Column, name: str) -> Column:
    """True when the key exists, even with a JSON null."""
    return F.try_variant_get(value, f"$.{name}", "variant").isNotNull()


def field_or(value: Column, name: str, default: Column, as_type: str = "string") -> Column:
    """Default for a missing key; a JSON null stays NULL."""
    return F.when(has_field(value, name), F.try_variant_get(value, f"$.{name}", as_type)).otherwise(default)


def encode(c: Column) -> Column:
    """JSON text that keeps keys with NULL values."""
    return F.to_json(c, {"ignoreNullFields": "false"})
