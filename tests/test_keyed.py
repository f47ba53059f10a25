"""Stored tables: only the buckets of a change are read and written, replays and compaction change nothing."""

import os

from pyspark.sql import functions as F

from parley.operators.records import to_messages
from parley.session import file_system, shared_dir
from parley.sources.keyed import KeyedTable, bucket_of
from parley.sources.topics import PROCESSED, RAW
from parley.streaming import etl
from parley.streaming.results import apply_results, arriving_objects, lead_table, stream_lead_results
from plans import executed

ROW = "k long, v string, n int"


def table_of(spark, tmp_path, rows, buckets=100):
    df = spark.createDataFrame(rows, ROW)
    table = KeyedTable.create(spark, f"{tmp_path}/t", df.schema, ["k"], buckets)
    table.write(df, 0)
    return KeyedTable.open(spark, f"{tmp_path}/t")


def content(table, spark, **how):
    return {r.k: (r.v, r.n) for r in table.read(spark, **how).collect()}


def folders(table, version):
    return {d for d in os.listdir(table.folder(version)) if d.startswith("bucket=")}


def test_upsert_writes_and_reads_the_buckets_of_its_keys(spark, tmp_path):
    rows = [(i, f"v{i}", i) for i in range(3000)]
    table = table_of(spark, tmp_path, rows)
    source = spark.createDataFrame([(7, "new", 1), (8, "v8", 8), (5000, "x", 2), (5000, "y", 2), (None, "lost", 0)], ROW)
    assert table.upsert(source, 1, overwrite=True) == {"inserted": 1, "updated": 1, "skipped": 1, "failed": 1}
    assert len(folders(table, 0)) == 100 and len(folders(table, 1)) <= 2
    expected = {i: (v, n) for i, v, n in rows} | {7: ("new", 1), 5000: ("x", 2)}
    assert content(table, spark) == expected
    # A replay finds what the first run found; a repetition as a new version changes nothing.
    assert table.upsert(source, 1, overwrite=True) == {"inserted": 1, "updated": 1, "skipped": 1, "failed": 1}
    assert table.upsert(source, 2, overwrite=True) == {"inserted": 0, "updated": 0, "skipped": 3, "failed": 1}
    assert not folders(table, 2) and content(table, spark) == expected
    assert table.upsert(source.where("k = 7"), 3, overwrite=False)["skipped"] == 1
    other = spark.createDataFrame([(9, "dry", 0)], ROW)
    assert table.upsert(other, 4, overwrite=True, dry_run=True)["updated"] == 1 and 4 not in table.versions(spark)
    near = table.read(spark, [3, 5])
    assert "PartitionFilters: [bucket" in executed(near) and "bucket#" in executed(near)
    assert {r.b for r in near.select(bucket_of(["k"], 100).alias("b")).distinct().collect()} == {3, 5}


def test_compaction_keeps_the_rows(spark, tmp_path):
    table = table_of(spark, tmp_path, [(i, "a", i) for i in range(50)], buckets=5)
    for version in range(1, 5):
        table.replace(spark.createDataFrame([(i, f"r{version}", version) for i in range(version)], ROW), version, "n")
    before = content(table, spark)
    assert before[0] == ("r4", 4) and before[3] == ("r4", 4) and before[40] == ("a", 40)
    done = table.compact(spark, most=2)
    assert done and content(table, spark) == before
    assert table.compact(spark, most=2) == [] and content(table, spark) == before
    # Both the old and the new files at once, as after a crash before the old ones were removed.
    crashed = table_of(spark, tmp_path / "again", [(1, "a", 1), (2, "b", 2)], buckets=2)
    crashed.write(crashed.read(spark), 1)
    assert content(crashed, spark) == {1: ("a", 1), 2: ("b", 2)}


def test_an_unfinished_version_is_not_seen(spark, tmp_path):
    table = table_of(spark, tmp_path, [(1, "a", 1)], buckets=2)
    table.write(spark.createDataFrame([(1, "half", 9)], ROW), 1)
    os.remove(f"{table.folder(1)}/_SUCCESS")
    assert content(table, spark) == {1: ("a", 1)}
    empty = KeyedTable.create(spark, f"{tmp_path}/none", table.schema, ["k"], 4)
    assert empty.read(spark).count() == 0 and empty.versions(spark) == []


def test_a_load_reads_only_its_buckets_of_the_store(spark, tmp_path):
    rows = [(f"m{i}", 1, i, f"user {i}", "{}", "pending") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id string, batch_num long, record_index long, user string, assistant string, etl_status string")
    messages = etl.transform_rows(to_messages(docs, RAW)).filter(F.col("topic") == PROCESSED).select("key", "value", "topic")
    store = f"{tmp_path}/store"
    etl.open_store(spark, store, buckets=50)
    etl.load_batch(messages, "w-0", store, f"{tmp_path}/rejects")
    few = messages.where("key in ('1:3', '1:4')").union(messages.where("key = '1:3'"))
    etl.load_batch(few, "w-1", store, f"{tmp_path}/rejects")
    assert spark.read.parquet(store).count() == 400
    held = etl.present_ids(spark, store, [4, 9], "w-1")
    plan = executed(held)
    assert "PartitionFilters" in plan and "bucket" in plan.split("PartitionFilters")[1].split("]")[0]
    assert "ReadSchema: struct<source_id:string>" in plan
    kept = {r.source_id for r in held.collect()}
    own = spark.read.parquet(store).where(bucket_of(["source_id"], 50).isin([4, 9]))
    assert kept == {r.source_id for r in own.collect()} and 0 < len(kept) < 100
    etl.compact_store(spark, store)
    assert len([d for d in os.listdir(store) if d.startswith("load_id=")]) == 1
    etl.load_batch(messages, "w-2", store, f"{tmp_path}/rejects")
    assert spark.read.parquet(store).count() == etl.read_store(spark, store).count() == 400


LEAD = "_id string, inference_status string, sagemaker_request_id string, inference_result string, inference_raw_output string, inference_completed_at timestamp"


def test_results_are_applied_on_arrival(spark, tmp_path):
    rows = [(f"l{i}", "processing", f"r{i}", None, None, None) for i in range(40)] + [("p", "pending", None, None, None, None)]
    table = lead_table(spark, f"{tmp_path}/leads", spark.createDataFrame(rows, LEAD), buckets=20)
    folder, stats = tmp_path / "inference-outputs", f"{tmp_path}/stats"
    folder.mkdir()
    now = F.lit("2024-02-01 00:00:00").cast("timestamp")

    def arrive(checkpoint="one"):
        stream_lead_results(arriving_objects(spark, str(folder)), table, f"{tmp_path}/{checkpoint}", now, stats).awaitTermination()
        return {r["_id"]: r["inference_result"] for r in table.read(spark).where("inference_status = 'completed'").collect()}

    (folder / "r1.out").write_text('[{"generated_text":"x"}]')
    (folder / "nobody.out").write_text('{"generated_text":"z"}')
    assert arrive() == {"l1": "x"}
    (folder / "r2.json.out").write_text('{"generated_text":"y"}')
    (folder / "a").mkdir()
    (folder / "a" / "r1.out").write_text('{"generated_text":"newer"}')
    assert arrive() == {"l1": "newer", "l2": "y"}
    assert len(folders(table, 2)) <= 2
    # A new stream reads all files again and goes on with new versions.
    assert arrive("two").keys() == {"l1", "l2"} and table.versions(spark)[-1] == 3
    got = {r.version: (r.processed, r.not_found, r.errors) for r in spark.read.parquet(stats).collect()}
    assert got == {1: (1, 1, 0), 2: (2, 0, 0), 3: (3, 1, 0)}
    # A replay of a batch writes its version again.
    outputs = spark.createDataFrame([("k", "r5", "five", "{}")], "key string, request_id string, result string, raw string")
    for _ in range(2):
        apply_results(table, outputs, 4, now)
    assert table.read(spark).count() == 40 and table.read(spark).where("inference_result = 'five'").count() == 1


def test_a_batch_of_results_writes_answered_leads_only_and_leaves_no_scratch(spark, tmp_path):
    rows = [(f"x{i}", "processing", f"x{i}", None, None, None) for i in range(60)] + [("y", "pending", None, None, None, None)]
    table = lead_table(spark, f"{tmp_path}/leads", spark.createDataFrame(rows, LEAD), buckets=8)
    # Good, unreadable, twice, for no lead, and one whose id reads like the stand-in of a lead without a request.
    outputs = [("k1", "x1", "one", "r"), ("k2", "x2", None, "r"), ("k3", "x3", "old", "r"), ("k4", "x3", "new", "r"), ("k5", "zz", "no", "r"), ("k6", None, "no", "r"), ("k7", "no request y", "no", "r")]
    batch = spark.createDataFrame(outputs, "key string, request_id string, result string, raw string")
    fs, scratch = file_system(spark, f"{shared_dir(spark)}/parley")
    before = {s.getPath().getName() for s in fs.listStatus(scratch)} if fs.exists(scratch) else set()
    apply_results(table, batch, 1, F.lit("2024-02-01").cast("timestamp"), f"{tmp_path}/stats")
    written = {r["_id"]: r["inference_result"] for r in table.stored(spark).where("version = 1").collect()}
    assert written == {"x1": "one", "x3": "new"}
    assert spark.read.parquet(f"{tmp_path}/stats").select("processed", "not_found", "errors").first() == (3, 2, 2)
    after = {s.getPath().getName() for s in fs.listStatus(scratch)} if fs.exists(scratch) else set()
    assert not {n for n in after - before if n.startswith("batch")}
