"""Label and batch audits, record shapes, training arrays."""

import json

from pyspark.sql import functions as F

from parley.operators import arrays, quality, records
from parley.schemas import INTENT_MIX, SCORE_TIERS

GOOD = {
    "intent": "buy",
    "urgency": "hot",
    "budget_range": "unknown",
    "timeline_months": 3,
    "preferred_locality": "x",
    "property_type": "condo",
    "brand_fit": "b1",
    "next_action": "agent_call",
    "score": 90,
    "reasoning": "r",
}


def test_label_audit(spark):
    def broken(**change):
        return json.dumps({**GOOD, **change})

    short = {k: v for k, v in GOOD.items() if k != "reasoning"}
    cases = {
        json.dumps(GOOD): [],
        broken(timeline_months=None): [],
        broken(intent="drop", urgency="N/A"): ["intent", "urgency"],
        broken(score=101): ["score"],
        broken(score="90"): ["score"],
        broken(score=None): ["score"],
        broken(timeline_months=1.5): ["timeline_months"],
        broken(brand_fit="other", next_action="call"): ["brand_fit", "next_action"],
        json.dumps(short): ["missing_key"],
        "{oops": ["json"],
        "[1]": ["json"],
        "": ["json"],
    }
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "i int, assistant string")
    got = [r["violations"] for r in quality.label_audit(df, brands=("b1",)).orderBy("i").collect()]
    assert got == list(cases.values())
    null = spark.createDataFrame([(None,)], "assistant string")
    assert quality.label_audit(null).first()["violations"] == ["json"]


def batch(num):
    """Thirty labels that keep every rule."""
    intents = [i for i, n in INTENT_MIX.items() for _ in range(n)]
    scores = [lo for lo, _ in SCORE_TIERS] * 5
    out = []
    for i, intent in enumerate(intents):
        drop = intent == "drop"
        out.append((num, intent, 2 if drop else scores[i], "N/A" if drop else f"b{i % 6}", "drop" if drop else "agent_call", f"city{i}"))
    return out


def test_batch_audit(spark):
    bad_drop = [(3, i, 50 if i == "drop" else s, b, a, c) for _, i, s, b, a, c in batch(3)]
    same_city = [(4, i, s, b, a, "one") for _, i, s, b, a, c in batch(4)]
    one_brand = [(5, i, s, "N/A" if i == "drop" else "b", a, c) for _, i, s, b, a, c in batch(5)]
    data = batch(1) + batch(2)[:-1] + bad_drop + same_city + one_brand
    df = spark.createDataFrame(data, "batch_num int, intent string, score int, brand_fit string, next_action string, preferred_locality string")
    got = {r["batch_num"]: {k for k, v in r.asDict().items() if v is False} for r in quality.batch_audit(df).collect()}
    assert got == {
        1: set(),
        2: {"size_ok", "intent_mix_ok", "passed"},
        3: {"drops_ok", "passed"},
        4: {"locality_unique_ok", "passed"},
        5: {"brand_limit_ok", "passed"},
    }


def test_accepted_and_rejected_are_the_input(spark):
    df = spark.createDataFrame(
        [("1", 0, 0, "u", "a"), ("2", 0, 1, " ", "a"), ("3", 0, 2, None, "a"), ("4", 0, 3, "u", "")],
        "mongo_id string, batch_num long, record_index long, user string, assistant string",
    )
    checked = records.transform_records(df)
    ok, bad = records.partition_valid(checked)
    assert [r["mongo_id"] for r in ok.collect()] == ["1"] and bad.count() == 3
    store = spark.createDataFrame([("1",)], "source_id string")
    stats = quality.phase_stats(checked, store).first().asDict()
    assert stats == {"published": 4, "transformed": 1, "failed": 3, "dlq": 3, "loaded": 1, "inserted": 0, "skipped": 1}


def test_message_defaults(spark):
    df = spark.createDataFrame([(None, None, None, None, "a")], "doc_id string, batch_num int, record_index int, user string, assistant string")
    row = records.to_messages(df, "raw").first()
    assert row["key"] == "-1:-1"
    assert json.loads(row["value"]) == {"mongo_id": "", "batch_num": -1, "record_index": -1, "user": None, "assistant": "a"}
    values = spark.createDataFrame([('{"mongo_id":"m"}',), ("[1]",), ("x",), ('{"user":null}',)], "value string")
    got = [tuple(r)[1:] for r in records.parse_messages(values).collect()]
    assert got[0] == (True, "m", -1, -1, "", "")
    assert [g[0] for g in got] == [True, False, False, True] and got[3][4] is None


def test_collate_pad(spark):
    df = spark.createDataFrame([(0, [1, 2, 3], 1), (1, [4], 0), (2, [5, 6], 9)], "rank long, full_ids array<int>, prompt_len int")
    got = [tuple(r) for r in arrays.collate_pad(arrays.token_samples(df), pad_id=7).select("rank", "batch_id", "input_ids", "labels", "attention_mask").orderBy("rank").collect()]
    assert got == [
        (0, 0, [1, 2, 3], [-100, 2, 3], [1, 1, 1]),
        (1, 0, [4, 7, 7], [4, -100, -100], [1, 0, 0]),
        (2, 1, [5, 6], [-100, -100], [1, 1]),
    ]


def test_pack_sequences_loses_no_token(spark):
    df = spark.createDataFrame([(i, list(range(i * 100, i * 100 + i % 7))) for i in range(60)], "id int, input_ids array<int>")
    packed = arrays.pack_sequences(df, "id", max_len=5, shards=3).orderBy("shard", "chunk").collect()
    by_shard = {}
    for r in packed:
        by_shard.setdefault(r["shard"], []).append(r["input_ids"])
    for chunks in by_shard.values():
        assert all(len(c) == 5 for c in chunks[:-1]) and 1 <= len(chunks[-1]) <= 5
    flat = [t for chunks in by_shard.values() for c in chunks for t in c]
    assert sorted(flat) == sorted(t for i in range(60) for t in range(i * 100, i * 100 + i % 7))
    for chunks in by_shard.values():
        joined = [t for c in chunks for t in c]
        starts = [t for t in joined if t % 100 == 0]
        for s in starts:
            at, n = joined.index(s), (s // 100) % 7
            assert joined[at : at + n] == list(range(s, s + n))


def test_packing_equals_plain_code_in_one_movement(spark):
    """The same chunks as a plain running sum, whatever the groups; only parts of chunks at group borders move twice."""
    import hashlib

    rows = [(i, list(range(i * 1000, i * 1000 + i % 23))) for i in range(300)] + [(1000, list(range(5000)))]
    df = spark.createDataFrame(rows, "id int, input_ids array<int>").repartition(5)
    expected = {}
    digest = lambda i: hashlib.md5(f"42:{i}".encode()).hexdigest()
    for i, ids in sorted(rows, key=lambda r: (digest(r[0]), r[0])):
        expected.setdefault(int(digest(i)[:8], 16) % 3, []).extend(ids)
    for digits in (1, 3):
        packed = arrays.pack_sequences(df, "id", max_len=50, shards=3, digits=digits)
        got = {}
        for r in packed.orderBy("shard", "chunk").collect():
            got.setdefault(r.shard, []).append(r.input_ids)
        assert {s: [t for c in chunks for t in c] for s, chunks in got.items()} == expected
        assert all(len(c) == 50 for chunks in got.values() for c in chunks[:-1])
    plan = packed._jdf.queryExecution().executedPlan().toString()
    # The input is not read again, and no window of rows covers a whole shard.
    assert "ExistingRDD" not in plan and "LocalTableScan" not in plan
    assert all("digest" not in w for w in plan.split("windowspecdefinition(")[1:] if w.startswith("shard") and "part" not in w.split("digest")[0])


def test_collation_in_order_of_the_key(spark):
    rows = [(i * 7 % 101, list(range(i % 9)), i % 3) for i in range(101)]
    df = spark.createDataFrame(rows, "id long, full_ids array<int>, prompt_len int").repartition(4)
    samples = arrays.token_samples(df)
    ranked = samples.withColumn("rank", F.col("id"))
    want = {tuple(map(str, r)) for r in arrays.collate_pad(ranked, batch_size=4).select("id", "batch_id", "input_ids", "labels", "attention_mask").collect()}
    got = arrays.collate_in_order(samples, "id", batch_size=4).select("id", "batch_id", "input_ids", "labels", "attention_mask")
    assert {tuple(map(str, r)) for r in got.collect()} == want and len(want) == 101


def test_label_audit_tells_null_from_missing(spark):
    def violations(**changes):
        label = GOOD | changes
        return json.dumps({k: v for k, v in label.items() if v != "gone"})

    texts = [violations(), violations(score=None), violations(score="gone"), violations(timeline_months=None), violations(timeline_months="3")]
    texts += [violations(score=85.5), violations(score="85"), violations(other=[1]), "[1]", "null", "5", "{}", None, '{"intent": "buy"} x']
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, assistant string")
    got = {r.id: r.violations for r in quality.label_audit(df).collect()}
    assert [got[i] for i in range(len(texts))] == [
        [], ["score"], ["missing_key"], [], ["timeline_months"], ["score"], ["score"], [], ["json"], ["json"], ["json"], ["missing_key"], ["json"], ["json"],
    ]
