"""Batch files, replies, datasets, outputs, sinks on invented fixtures."""

import json

import pytest
from pyspark.sql import functions as F

from parley.operators import quality
from parley.plans import prepare, upload
from parley.session import exists
from parley.sinks import files as sinks
from parley.sources import batches, datasets, outputs, replies
from parley.sources.store import filter_doc, read_store


@pytest.fixture
def raw_dir(tmp_path):
    d = tmp_path / "raw"
    d.mkdir()
    good = [{"user": f"u{i} call 555-1234", "assistant": "{}"} for i in range(3)]
    (d / "batch_002.json").write_text(json.dumps(good))
    (d / "batch_010.json").write_text(json.dumps([{"assistant": "a é"}, {"user": None, "assistant": "x"}], ensure_ascii=False))
    (d / "batch_003.json").write_text("{oops")
    (d / "batch_004.json").write_text('{"user":"u"}')
    (d / "batch_005.json").write_text("[]")
    (d / "batch_006.json").write_text('[{"user":"u"}] trailing')
    (d / "batch_x.json").write_text('[{"user":"x","assistant":"y"}]')
    (d / "other.json").write_text('[{"user":"no"}]')
    return str(d)


def test_scan_and_bad_files(spark, raw_dir):
    files = batches.scan_files(spark, raw_dir)
    bad = {r["file_name"]: r["state"] for r in batches.bad_files(files).collect()}
    assert bad == {
        "batch_003.json": "bad_json",
        "batch_004.json": "not_array",
        "batch_005.json": "empty",
        "batch_006.json": "bad_json",
    }
    rows = batches.read_batches(spark, raw_dir).orderBy("file_name", "record_index").collect()
    assert [(r["batch_num"], r["record_index"]) for r in rows] == [(2, 0), (2, 1), (2, 2), (10, 0), (10, 1), (0, 0)]


def test_bad_file_fails_on_request(spark, raw_dir):
    with pytest.raises(Exception, match="bad batch file"):
        batches.read_batches(spark, raw_dir, on_bad_file="fail").count()
    with pytest.raises(ValueError):
        batches.read_batches(spark, raw_dir, on_bad_file="ignore")


def test_unified_upload_twice(spark, raw_dir, tmp_path):
    first, second = str(tmp_path / "t1"), str(tmp_path / "t2")
    stats = upload.upload(spark, raw_dir, str(tmp_path / "none"), first).first().asDict()
    assert stats == {"inserted": 6, "updated": 0, "skipped": 0, "failed": 0}
    docs = spark.read.parquet(first).orderBy("global_index").collect()
    assert [d["global_index"] for d in docs] == list(range(6))
    assert [d["source_batch"] for d in docs] == [2, 2, 2, 10, 10, 0]
    assert [d["user"] for d in docs[3:5]] == ["", None]
    again = upload.upload(spark, raw_dir, first, second).first().asDict()
    assert again == {"inserted": 0, "updated": 0, "skipped": 6, "failed": 0}
    dry = upload.upload(spark, raw_dir, first, str(tmp_path / "t3"), dry_run=True).first().asDict()
    assert set(dry.values()) == {0} and not (tmp_path / "t3").exists()


def test_clean_and_prepare(spark, raw_dir, tmp_path):
    interim, out = str(tmp_path / "interim"), str(tmp_path / "out")
    sizes = prepare.clean(spark, raw_dir, interim)
    summary = quality.clean_summary(sizes).first().asDict()
    assert summary == {"batches": 7, "total_scrubbed": 6, "failed_batches": 4}
    assert spark.read.parquet(interim).filter(F.contains("user", F.lit("[PHONE]"))).count() == 3
    prepare.clean(spark, raw_dir, interim)
    assert spark.read.parquet(interim).count() == 6
    splits = prepare.prepare(spark, interim, out)
    assert splits.count() == 6
    counts = {r["split"]: r["count"] for r in spark.read.json(out).groupBy("split").count().collect()}
    assert counts == {"train": 4, "val": 1, "test": 1}
    lines = [r["value"] for r in spark.read.text(out).collect()]
    assert any("a é" in line for line in lines)
    assert any('"content":null' in line for line in lines)
    assert datasets.read_chat_jsonl(spark, out).count() == 6


def test_write_splits_keeps_shuffled_order(spark, tmp_path):
    from parley.operators.ranks import split_assign

    rows = spark.range(500).withColumn("conversations", F.array(F.struct(F.lit("user").alias("role"), F.col("id").cast("string").alias("content"))))
    splits = split_assign(rows, "id")
    sinks.write_splits(splits, str(tmp_path / "s"))
    expected = [str(r["id"]) for r in splits.filter("split = 'train'").orderBy("shuffle_key").collect()]
    got = []
    for part in sorted((tmp_path / "s" / "split=train").glob("part-*")):
        got += [json.loads(line)["conversations"][0]["content"] for line in part.read_text().splitlines()]
    assert got == expected


FENCED = "```json\n{\"user\":\"a\"}\n\n﻿{\"user\":\"b\"}\r\n{broken\n```"


def test_reply_lines(spark):
    df = spark.createDataFrame([(1, FENCED), (2, "no json\nat all"), (3, "")], "batch_num int, raw string")
    lines = replies.parse_jsonl(df, "raw", "batch_num")
    rows = [(r["batch_num"], r["lineno"], r["ok"]) for r in lines.orderBy("batch_num", "lineno").collect()]
    assert rows == [(1, 1, True), (1, 3, True), (1, 4, False), (2, 1, False), (2, 2, False)]
    assert replies.line_warnings(lines, "batch_num").count() == 3
    rejects = replies.unparsed_replies(df, "raw", "batch_num")
    assert sorted(r["batch_num"] for r in rejects.collect()) == [2, 3]


def test_line_numbers_and_verify(spark, tmp_path):
    def chat(*roles):
        return json.dumps({"conversations": [{"role": r, "content": "c"} for r in roles]})

    lines = [
        chat("system", "user", "assistant"),
        "{bad",
        '{"x":1}',
        '{"conversations":5}',
        chat("system", "user"),
        chat("user", "system", "assistant"),
        "",
        "17",
        '{"conversations":[1,2,3]}',
        '{"conversations":null}',
    ]
    (tmp_path / "d.jsonl").write_text("\n".join(lines) + "\n")
    numbered = datasets.numbered_lines(spark, str(tmp_path / "d.jsonl"))
    got = {r["lineno"]: r["reason"] for r in quality.verify_jsonl(numbered).collect()}
    three, roles = "not a list of 3 items", "roles mismatch"
    expected = [None, "invalid json", "missing conversations", three, three, roles, "invalid json", "missing conversations", roles, three]
    assert [got[i + 1] for i in range(len(lines))] == expected
    summary = quality.verify_summary(quality.verify_jsonl(numbered)).first().asDict()
    assert summary == {"inspected": 10, "malformed": 9, "status": "FAILED"}
    assert datasets.hashed_lines(spark, str(tmp_path / "d.jsonl")).count() == 10


def test_csv_and_two_way_split(spark, tmp_path):
    from parley.operators.ranks import split_assign

    (tmp_path / "c.csv").write_text("id,text\n" + "\n".join(f"{i},t{i}" for i in range(20)))
    df = datasets.read_csv_dataset(spark, str(tmp_path / "c.csv"), "id int, text string")
    counts = {r["split"]: r["count"] for r in split_assign(df, "id", cuts=(0.9,), names=("train", "test")).groupBy("split").count().collect()}
    assert counts == {"train": 18, "test": 2}


def test_outputs(spark, tmp_path):
    d = tmp_path / "inference-outputs"
    d.mkdir()
    (d / "a-1.out").write_text('[{"generated_text":"x"}]')
    (d / "b-2.out").write_text("not json")
    skipped = tmp_path / "inference-inputs"
    skipped.mkdir()
    (skipped / "a-1.json").write_text("{}")
    rows = outputs.read_outputs(spark, str(tmp_path)).orderBy("request_id").collect()
    assert [(r["request_id"], r["result"]) for r in rows] == [("a-1", "x"), ("b-2", '{"raw_output":"not json"}')]


def test_store_filter_is_pushed(spark, tmp_path):
    path = str(tmp_path / "store")
    spark.createDataFrame([(1, "pending"), (2, "done"), (3, "pending")], "batch_num int, etl_status string").write.parquet(path)
    assert read_store(spark, path).count() == 2
    assert read_store(spark, path, {}).count() == 3
    some = read_store(spark, path, {"batch_num": {"$gte": 2, "$lt": 4}, "etl_status": "pending"})
    assert [r["batch_num"] for r in some.collect()] == [3]
    plan = read_store(spark, path, {"batch_num": {"$gte": 2}})._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(batch_num,2)" in plan
    assert read_store(spark, path, {"etl_status": {"$exists": False}}).count() == 0
    with pytest.raises(ValueError):
        filter_doc({"a": {"$regex": "x"}})


def test_generation_worklist_and_summary(spark):
    done = spark.createDataFrame([(2,), (2,)], "batch_num long")
    work = prepare.generation_worklist(spark, 1, 4, "batch [1-34]!", done)
    assert [tuple(r) for r in work.orderBy("batch_num").collect()] == [(1, "batch 1!"), (3, "batch 3!"), (4, "batch 4!")]
    per_batch = quality.records_per_batch(prepare.batch_range(work, 1, 3), done.union(spark.createDataFrame([(3,)], "batch_num long")))
    assert quality.generation_summary(per_batch).first().asDict() == {"attempted": 2, "successful_records": 1, "failed_batches": 1}
    assert [r[0] for r in quality.failed_batches(per_batch).collect()] == [1]


def test_line_numbers_over_many_blocks(spark, tmp_path):
    """Files cut into blocks in the midst of lines have the numbers of a whole reading."""
    (tmp_path / "a.txt").write_bytes(b"".join(b"line %d %s\r\n" % (i, b"x" * (i * 37 % 300)) for i in range(500)))
    (tmp_path / "b.txt").write_bytes("\n\nfirst é\n\n".encode() + b"y" * 5000 + b"\nlast")
    (tmp_path / "c.txt").write_bytes(b"")
    (tmp_path / "d.txt").write_bytes(b"\n")
    expected = sorted(map(tuple, datasets.numbered_lines(spark, str(tmp_path)).collect()))
    sizes = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(s) for s in sizes]
    try:
        spark.conf.set(sizes[0], "777")
        spark.conf.set(sizes[1], "1")
        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 50
        got = sorted(map(tuple, datasets.block_numbered_lines(spark, str(tmp_path)).collect()))
    finally:
        for s, b in zip(sizes, before):
            spark.conf.set(s, b)
    assert got == expected and len(got) == 507


def test_clean_keeps_records_it_cannot_read(spark, tmp_path, monkeypatch):
    """Accepted and rejected records together are the input; a second run adds nothing."""
    from parley.sources import batches

    raw, interim = tmp_path / "raw", str(tmp_path / "interim")
    raw.mkdir()
    for n in range(3):
        rows = [{"user": f"u{n}-{i}" + ("huge" if (n, i) in ((0, 1), (2, 3)) else ""), "assistant": "{}"} for i in range(4)]
        (raw / f"batch_{n:03d}.json").write_text(json.dumps(rows))
    prepare.clean(spark, str(raw), f"{tmp_path}/none")
    assert not exists(spark, prepare.rejected(f"{tmp_path}/none"))
    # Stands for a value beyond the limit of the type, which would have to be more than 100 MB.
    monkeypatch.setattr(batches, "_lost", lambda: F.contains("record_text", F.lit("huge")))
    monkeypatch.setattr(prepare, "SURELY_READABLE", 10)
    for _ in range(2):
        sizes = prepare.clean(spark, str(raw), interim)
        assert {r["batch_num"]: r["n_records"] for r in sizes.collect()} == {f"batch_{n:03d}.json": 4 for n in range(3)}
    lost = spark.read.parquet(prepare.rejected(interim)).collect()
    assert {(r.file_name, r.record_index, r.reason) for r in lost} == {("batch_000.json", 1, "too_large"), ("batch_002.json", 3, "too_large")}
    assert all("huge" in r.record_text for r in lost)
    assert spark.read.parquet(interim).count() + len(lost) == 12
