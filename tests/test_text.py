"""Text scalars against small independent Python versions."""

import re

import pytest
from pyspark.sql import functions as F

from conftest import SF
from parley.functions import text as T

RE_EMAIL = re.compile(r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}\b")
RE_IN = re.compile(r"(?<!\d)(?:\+?91[\s.-]?)?[6-9]\d{9}(?!\d)")
RE_PHONE = re.compile(r"(?<!\d)(?:\+?\d{1,3}[\s.-]?)?(?:\?\(?\d{3}\)?[\s.-]?)?\d{3}[\s.-]?\d{4}(?!\d)")


def py_mask(s):
    for pattern, token in ((RE_EMAIL, "[EMAIL]"), (RE_IN, "[PHONE]"), (RE_PHONE, "[PHONE]")):
        s = pattern.sub(token, s)
    return s


CASES = [
    ("call 555-1234", "call [PHONE]"),
    ("415-555-1234", "[PHONE]"),
    ("(415) 555-1234", "(415) [PHONE]"),
    ("+1 (415) 555-1234", "+1 (415) [PHONE]"),
    ("+1 415 555 1234", "+1 [PHONE]"),
    ("?(415) 555-1234", "[PHONE]"),
    ("14155551234", "14155551234"),
    ("+91 9876543210", "[PHONE]"),
    ("919876543210", "[PHONE]"),
    ("2023-2024", "[PHONE]"),
    ("12345-6789", "[PHONE]"),
    ("$8500000", "$[PHONE]"),
    ("a.b@c.co", "[EMAIL]"),
    ("x@y", "x@y"),
    ("é19@mail5.example.com", "é19@mail5.example.com"),
]
# Characters on which Java and Python differ unless the classes are spelled out.
ODD = [
    "éa@b.com",
    "²a@b.com",
    "٥٥٥-1234 and 555 1234",
    "555 123 4567 555\x1c1234",
    "x_a@b.co_d mail a@b.co, c@d.org!",
    "a@b.com@c.org +++a@b.co",
    "​555-1234",
    "",
    "   ",
]


def column(spark, values, fn):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")
    return [r[1] for r in rows.select("i", fn(F.col("s"))).orderBy("i").collect()]


def test_masking_fixture(spark):
    assert column(spark, [c for c, _ in CASES], T.mask_pii) == [m for _, m in CASES]


def test_masking_equals_python_on_odd_characters(spark):
    values = ODD + [c for c, _ in CASES]
    assert column(spark, values, T.mask_pii) == [py_mask(v) for v in values]


def test_masking_looks_a_whole_character_back(spark):
    # Letters and digits beyond U+FFFF are two units of a Java string.
    wide = ["\U0001d7d71234567", "\U0001d7ce1234567555(", "9\U0001d7d79876543210", "\U0001d4b3x@y.co", "ab\U00020000+x@y.co", "\U0001f600555-1234", "\U0001d7d7_x@y.co"]
    assert column(spark, wide, T.mask_pii) == [py_mask(v) for v in wide]
    corrected = [re.sub(T.PHONE_CORRECTED, "[PHONE]", v) for v in wide[:2]]
    assert column(spark, wide[:2], lambda c: T.mask_phone(c, strict=False)) == corrected


def test_masking_equals_python_on_documents_and_is_idempotent(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("once", T.mask_pii(F.col("text")))
    rows = docs.withColumn("twice", T.mask_pii(F.col("once"))).collect()
    assert any(r["once"] != r["text"] for r in rows)
    for r in rows:
        assert r["once"] == py_mask(r["text"])
        assert r["twice"] == r["once"]


def test_corrected_phone_pattern_and_null(spark):
    assert column(spark, ["(415) 555-1234", None], lambda c: T.mask_pii(c, strict=False)) == ["[PHONE]", None]


@pytest.mark.parametrize("fn", ["normalize", "tokens", "blank", "strip"])
def test_whitespace_equals_python(spark, fn):
    docs = [r[0] for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").collect()]
    values = docs + ODD + ["\x1c\x1d a \x85 b　", "​", "a᠎b", "﻿ a"]
    spark_fn, python = {
        "normalize": (T.normalize_ws, lambda s: re.sub(r"\s+", " ", s).strip()),
        "tokens": (T.token_estimate, lambda s: len(s.split()) * 4 // 3),
        "blank": (T.non_blank, lambda s: bool(s.strip())),
        "strip": (T.strip, lambda s: s.strip()),
    }[fn]
    assert column(spark, values, spark_fn) == [python(v) for v in values]


def test_token_estimate_of_null_is_zero(spark):
    assert column(spark, [None, "a b c"], T.token_estimate) == [0, 4]


def test_names_longest_first(spark):
    rows = spark.createDataFrame(
        [
            ("Ann Lee met Ann", ["Ann", "Ann Lee"]),
            ("a.b and axb", ["a.b"]),
            ("no names", []),
            ("null names", None),
            ("blank  names", [" ", "", None]),
            ("ab bc abc", ["ab", "bc"]),
        ],
        "s string, n array<string>",
    )
    out = [r[0] for r in rows.select(T.mask_names(F.col("s"), F.col("n"))).collect()]
    assert out == ["[NAME] met [NAME]", "[NAME] and axb", "no names", "null names", "blank  names", "[NAME] [NAME] [NAME]c"]


def test_name_recogniser_hook(spark):
    from parley.functions.models import person_names

    def load():
        return lambda text: [w for w in text.split() if w.istitle()]

    df = spark.createDataFrame([("Ann met Bob",), (None,)], "s string")
    found = df.select("s", person_names(load)("s").alias("n"))
    assert [r[0] for r in found.select(T.mask_pii(F.col("s"), F.col("n"))).collect()] == ["[NAME] met [NAME]", None]


def test_tokenizer_hook(spark):
    from parley.functions.chat import chat_format
    from parley.functions.models import chat_tokenize

    def load():
        def encode(messages, add_generation_prompt):
            ids = [len(m["content"]) for m in messages]
            return ids + [1] if add_generation_prompt else ids

        return encode

    df = spark.createDataFrame([("ab", "abc")], "u string, a string")
    out = df.select(chat_tokenize(load)(chat_format(F.col("u"), F.col("a"), "s")).alias("t")).first()[0]
    assert out["full_ids"] == [1, 2, 3] and out["prompt_len"] == 3
