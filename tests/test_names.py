"""Names of a shared list: longest first, whole words, both ways of looking them up."""

import random
import re

import pytest
from pyspark.sql import functions as F

from parley.operators.names import mask_listed, replace_found
from plans import no_python


def plain(text, names):
    if text is None:
        return None
    alternatives = "|".join(map(re.escape, sorted(names, key=lambda n: (-len(n), n))))
    return re.sub(rf"(?<!\w)(?:{alternatives})(?!\w)", "[NAME]", text)


@pytest.mark.parametrize("inline", [50_000, 0])
def test_equals_one_pattern_of_all_names(spark, inline):
    rng = random.Random(3)
    words = ["Ann", "Lee", "Ana", "José", "García", "Li", "li", "x_1", "Anna", "日本", "met", "and"]
    names = ["Ann", "Ann Lee", "Lee", "José García", "García Li Ann", "Li", "x_1", "日本", "Nobody Here"]
    names += [f"Unused{i} Name{i % 7}" for i in range(2000)]
    texts = ["".join(rng.choice(words) + rng.choice([" ", " ", "  ", ", ", "-", "\n", "'s "]) for _ in range(rng.randint(0, 12))) for _ in range(200)]
    texts += [None, "", "Ann", "AnnLee", "Ann Lee Lee", "Ann Leé"]
    df = spark.createDataFrame([(i, t, t, 1) for i, t in enumerate(texts)], "id int, a string, b string, name int").repartition(4)
    listed = spark.createDataFrame([(n,) for n in [*names, "Ann", None, "", " ", "a  b", "O'Neil", "x|y"]], "who string")
    got = mask_listed(df, ["a", "b"], listed, "id", "who", inline)
    assert got.columns == df.columns
    rows = {r.id: r for r in got.collect()}
    for i, t in enumerate(texts):
        # Python's \w takes marks as no letters either.
        assert rows[i].a == rows[i].b == plain(t, names), t
    assert no_python(got._jdf.queryExecution().executedPlan().toString())


def test_a_letter_of_two_units_before_a_name(spark):
    texts = ["\U00020000Ann", "\U0001d7d7Ann \U0001f600Ann", "Ann\U00020000"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, a string")
    listed = spark.createDataFrame([("Ann",)], "name string")
    # The names to look for come with the text, so that only the place decides.
    found = F.array(F.lit("Ann"))
    got = df.select("id", replace_found(F.col("a"), found).alias("a")).orderBy("id").collect()
    assert [r.a for r in got] == [plain(t, ["Ann"]) for t in texts]
    assert mask_listed(df, ["a"], listed, "id").where("id = 1").first().a == plain(texts[1], ["Ann"])


def test_an_empty_list_and_an_empty_table(spark):
    df = spark.createDataFrame([(1, "Ann")], "id int, a string")
    none = spark.createDataFrame([], "name string")
    assert mask_listed(df, ["a"], none, "id").collect() == df.collect()
    some = spark.createDataFrame([("Ann",)], "name string")
    assert mask_listed(df.where("id = 2"), ["a"], some, "id").count() == 0
    assert mask_listed(df, ["a"], some, "id").first().a == "[NAME]"
    long = spark.range(1).select(F.lit(1).alias("id"), F.repeat(F.lit("Ann Lee and "), 20_000).alias("a"))
    assert mask_listed(long, ["a"], some, "id").first().a == "[NAME] Lee and " * 20_000
