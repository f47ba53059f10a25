"""Keys, strict JSON, chat functions."""

import hashlib
import json

from pyspark.sql import functions as F

from parley.functions import chat, jsontext, keys, tokens


def column(spark, values, fn, schema="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, s {schema}")
    return [r[1] for r in rows.select("i", fn(F.col("s"))).orderBy("i").collect()]


def test_batch_number(spark):
    names = ["batch_007.json", "dir/batch_12.json", "batch_x.json", "batch.json", "batch_3_RAW.txt", "batch_99999999999.json", None]
    assert column(spark, names, keys.batch_number) == [7, 12, 0, 0, 3, 99999999999, 0]
    huge = ["batch_9223372036854775808.json", "batch_20240101123000.json", "batch_-3.json"]
    assert column(spark, huge, keys.batch_number) == [None, 20240101123000, -3]


def test_result_request_id(spark):
    given = {
        "inference-outputs/a-1.out": "a-1",
        "inference-outputs/a%2D1.json": "a-1",
        "inference-outputs/a.json.out": "a",
        "inference-outputs/a.out.json": "a.out",
        "inference-outputs/": None,
        "inference-outputs/.out": None,
        "a+b%20c": "a b c",
        "50%/x%zz": "x%zz",
    }
    assert column(spark, list(given), keys.result_request_id) == list(given.values())
    assert column(spark, ["inference-inputs/a.json", "x/a.out"], keys.is_output_key) == [False, True]


def test_request_and_run_ids_are_stable(spark):
    digest = hashlib.md5(b"42:lead").hexdigest()
    assert column(spark, ["lead"], keys.request_id) == [f"lead-{digest[:8]}"]
    run = column(spark, ["2024-02-01 10:20:30"], lambda c: keys.run_id(c.cast("timestamp")))[0]
    assert run.startswith("run_20240201_102030_") and len(run.split("_")[-1]) == 6


def test_strict_json(spark):
    good = ['{"a":1}', "[]", "1", '"x"', "null", " {} ", '{"a":"#end-of-text#"}', '[1,"#end-of-text#"]']
    bad = ["", "  ", "[1] x", "1,2", "1],[2", "1,0],[", "{oops", "{'a':1}", "prose", '1,"#end-of-text#"],[', "01", "nullx"]
    assert column(spark, good + bad, jsontext.is_json) == [True] * len(good) + [False] * len(bad)
    parsed = column(spark, good + bad, lambda c: F.to_json(jsontext.strict_parse(c)))
    assert [json.loads(p) for p in parsed[: len(good)]] == [json.loads(g) for g in good]
    assert parsed[len(good) :] == [None] * len(bad)


def test_missing_differs_from_null(spark):
    def field(c):
        return jsontext.field_or(F.try_parse_json(c), "user", F.lit("missing"))

    assert column(spark, ['{"user":"u"}', '{"user":null}', "{}", "3"], field) == ["u", None, "missing", "missing"]


def test_validate_chat(spark):
    def reason(rows):
        schema = "array<struct<role:string,content:string>>"
        return column(spark, rows, chat.validate_chat, schema)

    def three(u, a):
        return [("system", "s"), ("user", u), ("assistant", a)]

    assert reason(
        [three("u", "a"), three("  ", "a"), three("u", ""), three(None, "a"), three("u", None), three("u", "a")[:2], [], None]
    ) == [
        None,
        "Empty user content after PII clean",
        "Empty assistant content after PII clean",
        "null user content",
        "null assistant content",
        "conversations length=2, expected 3",
        "conversations length=0, expected 3",
        "conversations length=0, expected 3",
    ]


def test_render_template(spark):
    df = spark.createDataFrame([(" hi ", "yo")], "u string, a string")
    rendered = df.select(chat.render_template(chat.chat_format(F.col("u"), F.col("a"), "s"), chat.LLAMA3, "</s>")).first()[0]
    head = "<|start_header_id|>{}<|end_header_id|>\n\n{}<|eot_id|>"
    assert rendered == "<|begin_of_text|>" + head.format("system", "s") + head.format("user", "hi") + head.format("assistant", "yo") + "</s>"


def test_inference_messages(spark):
    got = column(spark, ["text"], lambda c: F.to_json(chat.inference_messages(c, "sys")))[0]
    assert json.loads(got) == [
        {"role": "system", "content": "sys"},
        {"role": "user", "content": "Lead conversation:\ntext"},
    ]


def test_generated_text(spark):
    bodies = ['[{"generated_text":"x"}]', '{"generated_text":"x"}', '{"other":1}', "[]", "not json", '[{"z":1}]', "5", '[{"generated_text":null}]']
    from parley.sources.outputs import parse_output

    got = column(spark, bodies, lambda c: chat.generated_text(parse_output(c)))
    assert got == ["x", "x", '{"other":1}', "", '{"raw_output":"not json"}', "", "", None]


def test_prompt_mask(spark):
    df = spark.createDataFrame([([1, 2, 3, 4], 2), ([1, 2, 3, 4], 9), ([], 0)], "ids array<int>, p int")
    rows = df.select(tokens.prompt_mask(F.col("ids"), F.col("p"), 3).alias("l")).withColumn("n", tokens.supervised_tokens(F.col("l")))
    assert [tuple(r) for r in rows.collect()] == [([-100, -100, 3], 1), ([-100, -100, -100], 0), ([], 0)]
