"""One query per operator, each over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parley.functions import text as T
from parley.functions.chat import CHATML, LLAMA3, chat_format, generated_text, render_template, validate_chat
from parley.functions.jsontext import encode
from parley.functions.keys import batch_number, is_output_key, result_request_id
from parley.functions.tokens import supervised_tokens
from parley.operators import arrays, leads, merges, monitoring, names, quality, ranks, records, runs
from parley.plans.etl import EtlLayout, run_etl
from parley.plans.prepare import batch_range, format_and_split, generation_worklist
from parley.queries import tables as t
from parley.session import scratch_path
from parley.sinks import files as sinks
from parley.sources import datasets
from parley.sources import replies as reply_source
from parley.sources.keyed import KeyedTable
from parley.sources.outputs import outputs_of, parse_output
from parley.sources.store import filter_doc, pending
from parley.sources.topics import DEAD_LETTERS, PROCESSED, RAW, FolderTopics
from parley.streaming.etl import open_store, run_extract, stream_load, stream_transform, transform_rows
from parley.streaming.results import lead_table, stream_lead_results

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    """Registers a query under its name; a trailing underscore only avoids an import."""
    QUERIES[fn.__name__.rstrip("_")] = fn
    return fn


def digest(array: Column) -> Column:
    return F.md5(F.array_join(array.cast("array<string>"), " "))


def stamp(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")


def day_stamp() -> Column:
    return F.lit("2024-02-01 00:00:00").cast("timestamp")


# ---- scalars ----------------------------------------------------------------


@query
def mask_pii(spark, sf):
    return t.table(spark, sf, "documents").select("doc_id", T.mask_pii(F.col("text")).alias("masked"))


@query
def mask_names(spark, sf):
    found = F.array_distinct(F.regexp_extract_all("text", F.lit("([A-Z][a-z]{2,})"), F.lit(1)))
    turns = t.table(spark, sf, "conversations")
    return turns.select("conv_id", "turn", T.mask_names(F.col("text"), found).alias("masked"))


def _listed(spark, sf, **how):
    """Every capitalised word of the documents and every pair of words of the benchmark is a name."""
    single = F.explode(F.regexp_extract_all("text", F.lit("[A-Z][a-z]+"), F.lit(0)))
    documents, items = t.table(spark, sf, "documents"), t.table(spark, sf, "benchmark")
    pairs = F.filter(names.word_runs(F.col("text"), 2), lambda run: F.contains(run, F.lit(" ")))
    listed = records.merge_batches(documents.select(single.alias("name")), items.select(F.explode(pairs).alias("name")))
    return names.mask_listed(documents.select("doc_id", "text"), ["text"], listed, "doc_id", **how)


@query
def mask_listed_names(spark, sf):
    return _listed(spark, sf)


@query
def mask_joined_names(spark, sf):
    """The same with the list in a join, as for one too long for an expression."""
    return _listed(spark, sf, inline=0)


@query
def clean_records(spark, sf):
    return records.clean_records(t.raw_records(spark, sf))


@query
def normalize_ws(spark, sf):
    return t.table(spark, sf, "documents").select("doc_id", T.normalize_ws(F.col("text")).alias("normalized"))


@query
def token_estimate(spark, sf):
    return t.table(spark, sf, "documents").select("doc_id", T.token_estimate(F.col("text")).alias("tokens"))


@query
def batch_number_(spark, sf):
    name = (
        F.when(F.col("lang") == "fr", F.lit("batch_x.json"))
        .when(F.col("lang") == "de", F.lit("notes.json"))
        .otherwise(F.format_string("raw/batch_%03d.json", F.col("doc_id")))
    )
    return t.table(spark, sf, "documents").select("doc_id", batch_number(name).alias("batch_num"))


@query
def result_request_id_(spark, sf):
    folder = F.when(F.contains("url", F.lit("/fr/")), F.lit("inference-inputs/")).otherwise(F.lit("inference-outputs/"))
    ending = F.element_at(F.array(*[F.lit(e) for e in (".out", ".json", ".json.out", "")]), (F.col("page_id") % 4 + 1).cast("int"))
    key = F.concat(folder, F.col("url"), F.lit("%20+"), F.col("page_id").cast("string"), ending)
    pages = t.table(spark, sf, "pages").select("page_id", key.alias("key"))
    return pages.filter(is_output_key(F.col("key"))).select("page_id", result_request_id(F.col("key")).alias("request_id"))


# ---- chat records -----------------------------------------------------------


@query
def defaults(spark, sf):
    return records.with_defaults(t.json_records(spark, sf)).select("batch_num", "record_index", "user", "assistant")


@query
def chat_format_(spark, sf):
    chats = t.raw_records(spark, sf).withColumn("conversations", chat_format(F.col("user"), F.col("assistant")))
    return chats.select("mongo_id", encode(F.struct("conversations")).alias("line"))


@query
def render_template_(spark, sf):
    chats = t.raw_records(spark, sf).withColumn("conversations", chat_format(F.col("user"), F.col("assistant")))
    return chats.select(
        "mongo_id",
        render_template(F.col("conversations"), LLAMA3).alias("llama3"),
        render_template(F.col("conversations"), CHATML).alias("chatml"),
    )


@query
def validate_chat_(spark, sf):
    chats = t.raw_records(spark, sf).withColumn("conversations", chat_format(F.col("user"), F.col("assistant")))
    return chats.select("mongo_id", validate_chat(F.col("conversations")).alias("reason"))


@query
def result_text(spark, sf):
    parsed = t.output_files(spark, sf).select("_id", parse_output(F.col("body")).alias("output"))
    return parsed.select("_id", generated_text(F.col("output")).alias("result"))


@query
def parse_reply_lines(spark, sf):
    lines = reply_source.parse_jsonl(t.replies(spark, sf), "raw", "doc_id")
    return lines.select("doc_id", "lineno", "line", "ok")


@query
def parse_reply_warnings(spark, sf):
    return reply_source.line_warnings(reply_source.parse_jsonl(t.replies(spark, sf), "raw", "doc_id"), "doc_id")


@query
def parse_reply_rejects(spark, sf):
    return reply_source.unparsed_replies(t.replies(spark, sf), "raw", "doc_id")


# ---- quality ----------------------------------------------------------------


@query
def verify_jsonl(spark, sf):
    return quality.verify_jsonl(t.chat_lines(spark, sf)).select("kind", "a", "b", "reason")


@query
def verify_summary(spark, sf):
    return quality.verify_summary(quality.verify_jsonl(t.chat_lines(spark, sf)))


@query
def label_audit(spark, sf):
    audited = quality.label_audit(t.labelled(spark, sf))
    return audited.select("batch_num", "record_index", F.array_join("violations", ",").alias("violations"))


@query
def batch_audit(spark, sf):
    labels = t.labelled(spark, sf).select("batch_num", quality.read_label(F.col("assistant")).alias("label"))
    return quality.batch_audit(labels.select("batch_num", "label.*"))


@query
def clean_summary(spark, sf):
    conversations = t.table(spark, sf, "conversations").select(F.col("conv_id").alias("batch_num"))
    replied = t.turn_pairs(spark, sf).filter(F.col("assistant") != "")
    return quality.clean_summary(quality.records_per_batch(conversations, replied))


@query
def failed_batches(spark, sf):
    conversations = t.table(spark, sf, "conversations").select(F.col("conv_id").alias("batch_num"))
    replied = t.turn_pairs(spark, sf).filter(F.col("assistant") != "")
    return quality.failed_batches(quality.records_per_batch(conversations, replied))


@query
def generation_summary(spark, sf):
    documents = t.table(spark, sf, "documents").select(F.col("doc_id").alias("batch_num"))
    found = t.table(spark, sf, "labels").select(F.col("doc_id").alias("batch_num"))
    return quality.generation_summary(quality.records_per_batch(documents, found))


@query
def generation_worklist_(spark, sf):
    last = t.table(spark, sf, "documents").agg(F.max("doc_id")).first()[0]
    done = t.table(spark, sf, "labels").select(F.col("doc_id").alias("batch_num"))
    work = generation_worklist(spark, 0, last + 1, "Generate batch number: [1-34]", done)
    return batch_range(work, 1, last)


# ---- ranks, splits ----------------------------------------------------------


@query
def unified_index(spark, sf):
    return records.with_provenance(records.with_defaults(t.json_records(spark, sf)))


@query
def split_assign(spark, sf):
    cleaned = records.clean_records(t.raw_records(spark, sf))
    return format_and_split(cleaned, "mongo_id").select("mongo_id", "split", encode(F.struct("conversations")).alias("line"))


@query
def split_counts(spark, sf):
    return ranks.split_counts(ranks.split_assign(t.raw_records(spark, sf), "mongo_id"))


@query
def holdout_split(spark, sf):
    orders = t.table(spark, sf, "orders").select("o_orderkey")
    return ranks.split_assign(orders, "o_orderkey", cuts=(0.9,), names=("train", "test")).select("o_orderkey", "split")


@query
def global_rank(spark, sf):
    events = t.table(spark, sf, "events")
    return ranks.global_rank(events, "ts", "event_id").select("event_id", "rank")


@query
def run_meta(spark, sf):
    splits = ranks.split_assign(t.raw_records(spark, sf), "mongo_id")
    return runs.run_meta(splits, F.lit("run_20240201"), "datasets", day_stamp())


# ---- merges -----------------------------------------------------------------


def _replace_sides(spark, sf):
    turns = t.table(spark, sf, "conversations")
    present = turns.select(
        F.col("conv_id").alias("batch_num"),
        F.col("turn").alias("record_index"),
        F.col("text").alias("user"),
        F.lit("").alias("assistant"),
        F.col("role").alias("raw_record"),
        F.lit("done").alias("etl_status"),
    )
    return present, records.to_raw_docs(t.turn_pairs(spark, sf).withColumn("raw_record", F.lit("pair")))


@query
def upsert_raw(spark, sf):
    return merges.upsert_replace(*_replace_sides(spark, sf), ["batch_num", "record_index"], "user")


@query
def upsert_latest(spark, sf):
    """Repeated keys on the source side: the newest event of each user takes the place of the customer's row."""
    present = t.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("user_id"), F.lit(-1).cast("bigint").alias("event_id"), F.lit("customer").alias("event_type")
    )
    events = t.table(spark, sf, "events").select("user_id", "event_id", "event_type")
    return merges.upsert_replace(present, events, ["user_id"], "event_id")


@query
def insert_first(spark, sf):
    """Repeated keys on the source side: the first line of each order, unless the order is stored already."""
    lines = t.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    stored = t.table(spark, sf, "orders").filter("o_orderstatus = 'F'")
    zero = [F.lit(0).cast(lines.schema[c].dataType).alias(c) for c in ("l_linenumber", "l_partkey", "l_suppkey")]
    return merges.insert_if_absent(stored.select(F.col("o_orderkey").alias("l_orderkey"), *zero), lines, "l_orderkey", "l_linenumber")


@query
def batch_number_large(spark, sf):
    """Numbers beyond 32 bits, which keep their value, and beyond 64 bits, which have none."""
    key = F.col("o_orderkey").cast("decimal(38,0)")
    name = F.format_string("raw/batch_%s.json", (key * F.lit(4000000007).cast("decimal(38,0)") * F.when(key % 5 == 0, F.lit(1000000000)).otherwise(F.lit(1)).cast("decimal(38,0)")).cast("string"))
    return t.table(spark, sf, "orders").select("o_orderkey", batch_number(name).alias("batch_num"))


@query
def clean_records_names(spark, sf):
    """Names recognised in each field by itself: capitalised words of five letters before a blank."""
    found = lambda text: F.array_distinct(F.regexp_extract_all(text, F.lit("([A-Z][a-z]{4}) "), F.lit(1)))
    raw = t.raw_records(spark, sf).select("mongo_id", "user", "assistant")
    return records.clean_records(raw, found)


@query
def dispatch(spark, sf):
    """Outcomes of a dispatch, each reported twice, on the leads."""
    waiting = t.leads(spark, sf)
    sent = waiting.filter("inference_status = 'pending'").select(
        "_id",
        F.concat(F.lit("r-"), "_id").alias("request_id"),
        F.concat(F.lit("out/"), "_id").alias("output_location"),
        F.when(F.substring("_id", -1, 1) == "3", F.lit("throttled")).alias("error"),
    )
    extra = ("sagemaker_output_s3", "sagemaker_request_id", "inference_triggered_at", "inference_error", "inference_error_at")
    for c in extra:
        if c not in waiting.columns:
            waiting = waiting.withColumn(c, F.lit(None).cast("timestamp" if c.endswith("_at") else "string"))
    out = leads.apply_dispatch(waiting, records.merge_batches(sent, sent), day_stamp())
    return out.select(
        "_id", "inference_status", "sagemaker_request_id", "sagemaker_output_s3", "inference_error",
        stamp(F.col("inference_triggered_at")).alias("triggered_at"), stamp(F.col("inference_error_at")).alias("error_at"),
    )


@query
def etl_run(spark, sf):
    """Two runs over the same documents: the second finds nothing pending and ends early."""
    root = scratch_path(spark, "etl-run")
    docs = t.raw_docs(spark, sf)
    runs_ = []
    for n in ("1", "2"):
        layout = EtlLayout.folders(f"{root}/{n}", f"{root}/processed", f"{root}/status")
        runs_.append(run_etl(spark, docs, layout).withColumn("run", F.lit(n)))
    return records.merge_batches(*runs_)


@query
def load_insert_absent(spark, sf):
    documents = t.table(spark, sf, "documents").select(F.col("doc_id").alias("source_id"), F.col("source").alias("payload"))
    store = t.table(spark, sf, "labels").select(F.col("doc_id").alias("source_id"), F.lit("stored").alias("payload"))
    return merges.insert_if_absent(store, records.merge_batches(documents, documents), "source_id")


def _upsert_sides(spark, sf):
    graded = F.when(F.col("n_chars") > 1000, F.lit(1)).otherwise(F.lit(0))
    source = t.table(spark, sf, "documents").select("doc_id", graded.alias("quality"), F.lit(0).alias("toxic"))
    return t.table(spark, sf, "labels"), source


@query
def bulk_upsert_stats(spark, sf):
    return merges.bulk_upsert(*_upsert_sides(spark, sf), "doc_id", overwrite=True)[1]


@query
def bulk_upsert_overwrite(spark, sf):
    return merges.bulk_upsert(*_upsert_sides(spark, sf), "doc_id", overwrite=True)[0]


@query
def bulk_upsert_keep(spark, sf):
    return merges.bulk_upsert(*_upsert_sides(spark, sf), "doc_id")[0]


@query
def bulk_upsert_keep_stats(spark, sf):
    return merges.bulk_upsert(*_upsert_sides(spark, sf), "doc_id")[1]


def _stored_labels(spark, sf) -> tuple[KeyedTable, list[dict]]:
    """The labels as a stored table, and the documents' marks merged into it twice."""
    labels, source = _upsert_sides(spark, sf)
    table = KeyedTable.create(spark, scratch_path(spark, "keyed"), labels.schema, ["doc_id"], buckets=16)
    counts = [table.upsert(labels, 1), table.upsert(source, 2, overwrite=True), table.upsert(source, 3, overwrite=True)]
    return table, counts


@query
def stored_upsert(spark, sf):
    table, _ = _stored_labels(spark, sf)
    table.compact(spark, most=1)
    return table.read(spark)


@query
def stored_upsert_stats(spark, sf):
    _, counts = _stored_labels(spark, sf)
    rows = [(run, *[c[a] for a in merges.COUNTS]) for run, c in enumerate(counts)]
    return spark.createDataFrame(rows, "run int, " + ", ".join(f"{a} bigint" for a in merges.COUNTS))


@query
def stored_replace(spark, sf):
    """Turns as stored rows of two key columns; turn pairs take the place of the turns with their key."""
    present, fresh = _replace_sides(spark, sf)
    table = KeyedTable.create(spark, scratch_path(spark, "keyed"), present.schema, ["batch_num", "record_index"], buckets=16)
    table.replace(present, 1, "user")
    table.replace(fresh, 2, "user")
    return table.read(spark)


@query
def stored_status(spark, sf):
    docs = t.table(spark, sf, "documents").select("doc_id", F.lit("in_progress").alias("etl_status"))
    table = KeyedTable.create(spark, scratch_path(spark, "keyed"), docs.schema, ["doc_id"], buckets=16)
    table.write(docs, 1)
    table.set_values(t.table(spark, sf, "labels"), {"etl_status": F.lit("done")}, 2)
    return table.read(spark)


@query
def status_transition(spark, sf):
    docs = t.table(spark, sf, "documents").select("doc_id", F.lit("in_progress").alias("etl_status"))
    return merges.set_status(docs, t.table(spark, sf, "labels"), "done")


@query
def status_log(spark, sf):
    docs = t.table(spark, sf, "customer").select(F.col("c_custkey").alias("doc_id"), F.lit("pending").alias("etl_status"))
    log = t.table(spark, sf, "events").select(
        F.col("user_id").alias("doc_id"), F.col("event_type").alias("status"), F.struct("ts", "event_id").alias("at")
    )
    return merges.apply_status_log(docs, log)


@query
def run_report(spark, sf):
    evaluated = runs.eval_metrics(t.losses(spark, sf), "run_id").select(
        "run_id",
        runs.reported(F.col("avg_loss")).alias("val_loss"),
        runs.reported(F.col("perplexity")).alias("perplexity"),
        "quality_tier",
        F.col("total_tokens").alias("record_count"),
    )

    def run(c: str) -> Column:
        return F.concat(F.lit("run_"), F.col(c).cast("string")).alias("run_id")

    training = t.table(spark, sf, "customer").select(run("c_custkey"), F.col("c_name").alias("model_s3_prefix"))
    registered = t.table(spark, sf, "supplier").select(run("s_suppkey"), F.col("s_name").alias("model_package_arn"))
    deployed = t.table(spark, sf, "nation").select(
        run("n_nationkey"), F.col("n_name").alias("endpoint_name"), F.lit("deployed").alias("status")
    )
    return merges.run_report(evaluated, training, registered, deployed)


# ---- document store and topics ---------------------------------------------


@query
def extract_pending(spark, sf):
    return records.to_messages(pending(t.raw_docs(spark, sf)), RAW)


@query
def filter_doc_(spark, sf):
    spec = {"etl_status": "pending", "batch_num": {"$gte": 5, "$lt": 60}, "record_index": {"$exists": True}}
    return t.raw_docs(spark, sf).filter(filter_doc(spec)).select("doc_id", "batch_num", "record_index", "etl_status")


@query
def etl_transform(spark, sf):
    docs = t.raw_docs(spark, sf)
    return transform_rows(records.to_messages(docs, RAW))


@query
def dead_letters(spark, sf):
    rows = transform_rows(records.to_messages(t.raw_docs(spark, sf), RAW))
    return rows.filter(F.col("topic") == DEAD_LETTERS).select("value")


@query
def etl_stats(spark, sf):
    checked = records.transform_records(t.raw_records(spark, sf))
    store = t.table(spark, sf, "labels").select(F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("source_id"))
    return quality.phase_stats(checked, store)


def _transformed(spark, sf, root: str) -> FolderTopics:
    raw, out = FolderTopics(f"{root}/raw"), FolderTopics(f"{root}/transformed")
    run_extract(t.raw_docs(spark, sf), raw, where=F.lit(True))
    stream_transform(raw.stream(spark, RAW), out, f"{root}/checkpoints/transform").awaitTermination()
    return out


@query
def stream_transform_(spark, sf):
    root = scratch_path(spark, "stream-transform")
    out = _transformed(spark, sf, root)
    return records.merge_batches(out.read(spark, PROCESSED), out.read(spark, DEAD_LETTERS)).select("topic", "key", "value")


@query
def stream_load_(spark, sf):
    root = scratch_path(spark, "stream-load")
    out = _transformed(spark, sf, root)
    store = f"{root}/processed"
    open_store(spark, store, buckets=8)
    # The second stream delivers every message again and must add nothing.
    for delivery in ("first", "again"):
        source = out.stream(spark, PROCESSED)
        stream_load(source, store, f"{root}/checkpoints/{delivery}", f"{root}/rejects").awaitTermination()
    return spark.read.parquet(store).select(
        "source_id", "etl_status", "metadata.batch_num", "metadata.record_index", encode(F.struct("conversations")).alias("line")
    )


# ---- files written and read back ----------------------------------------------


@query
def csv_dataset(spark, sf):
    """Orders through a CSV folder with a header."""
    path = scratch_path(spark, "csv")
    orders = t.table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", F.col("o_custkey").alias("customer"))
    orders.write.csv(path, header=True)
    return datasets.read_csv_dataset(spark, path, orders._jdf.schema().toDDL())


@query
def chat_jsonl(spark, sf):
    """Chat records through a folder of JSON lines."""
    path = scratch_path(spark, "chat")
    chats = t.raw_records(spark, sf).select(chat_format(F.col("user"), F.col("assistant")).alias("conversations"))
    chats.write.json(path)
    return datasets.read_chat_jsonl(spark, path).select(encode(F.struct("conversations")).alias("line"))


@query
def hashed_lines(spark, sf):
    """Page addresses through text files, each line named by its digest."""
    path = scratch_path(spark, "lines")
    t.table(spark, sf, "pages").select("url").write.text(path)
    return datasets.hashed_lines(spark, path).select("line_hash", "line")


@query
def numbered_lines(spark, sf):
    """Lines of one text file for each of eight groups of orders, numbered in their files."""
    path = scratch_path(spark, "numbered")
    orders = t.table(spark, sf, "orders").select((F.col("o_orderkey") % 8).alias("part"), F.col("o_orderkey").alias("key"))
    dealt = orders.repartition(8, "part").sortWithinPartitions("part", "key")
    dealt.select("part", F.col("key").cast("string").alias("line")).write.partitionBy("part").text(path)
    return datasets.block_numbered_lines(spark, path).select(F.col("line").cast("bigint").alias("o_orderkey"), "lineno")


@query
def split_sink(spark, sf):
    """The split folders, written and read back."""
    path = scratch_path(spark, "splits")
    sinks.write_splits(format_and_split(t.raw_records(spark, sf), "mongo_id"), path)
    return datasets.read_chat_jsonl(spark, path).select(
        F.regexp_extract(F.col("_metadata.file_path"), "split=([a-z]+)", 1).alias("split"), encode(F.struct("conversations")).alias("line")
    )


@query
def batch_sink(spark, sf):
    """Batches written in two goes, the second with all of them: each is there once."""
    path = scratch_path(spark, "interim")
    turns = t.table(spark, sf, "conversations").select(F.col("conv_id").alias("batch_num"), F.col("turn").alias("record_index"), "role")
    sinks.write_batches(turns.filter("batch_num % 2 = 0"), path)
    sinks.write_batches(turns, path)
    return spark.read.parquet(path)


# ---- leads and runs ---------------------------------------------------------


@query
def pending_leads(spark, sf):
    return leads.pending_leads(t.leads(spark, sf)).select("_id", "conversation")


@query
def inference_payloads(spark, sf):
    waiting = t.leads(spark, sf).filter(F.col("inference_status") == "pending")
    sent = leads.inference_payloads(waiting)
    return sent.select("_id", "request_id", "payload", encode(F.struct("messages")).alias("messages"))


@query
def result_ingest(spark, sf):
    updated, _ = leads.ingest_results(t.leads(spark, sf), outputs_of(t.output_files(spark, sf)), day_stamp())
    return updated.select(
        "_id", "inference_status", "inference_result", "inference_raw_output", stamp(F.col("inference_completed_at")).alias("completed_at")
    )


@query
def result_arrival(spark, sf):
    """Outputs that arrive in two folders' worth of micro-batches, then all of them again, on stored leads."""
    root = scratch_path(spark, "arrival")
    leads_now, files = t.leads(spark, sf), t.output_files(spark, sf).select("key", "body")
    table = lead_table(spark, f"{root}/leads", leads_now, buckets=16)
    for delivery, part in enumerate((F.length("key") % 2 == 0, F.length("key") % 2 == 1, F.lit(True))):
        files.where(part).write.mode("append").parquet(f"{root}/outputs")
        objects = spark.readStream.schema(files.schema).parquet(f"{root}/outputs")
        # The last delivery comes through a stream of its own, which reads everything.
        checkpoint = f"{root}/checkpoint-{delivery // 2}"
        stream_lead_results(objects, table, checkpoint, day_stamp()).awaitTermination()
    updated = records.merge_batches(leads_now.where("sagemaker_request_id is null"), table.read(spark))
    return updated.select(
        "_id", "inference_status", "inference_result", "inference_raw_output", stamp(F.col("inference_completed_at")).alias("completed_at")
    )


@query
def result_ingest_stats(spark, sf):
    return leads.ingest_results(t.leads(spark, sf), outputs_of(t.output_files(spark, sf)), day_stamp())[1]


@query
def eligible_count(spark, sf):
    return leads.eligible_count(t.leads(spark, sf))


@query
def trigger_gate(spark, sf):
    return leads.trigger_gate(t.leads(spark, sf))


@query
def training_run(spark, sf):
    ledger = runs.training_run(leads.trigger_gate(t.leads(spark, sf), threshold=1), F.lit("run_1"), F.lit("exec-1"), day_stamp())
    return ledger.select("_id", "status", "record_count", "deployed", stamp(F.col("triggered_at")).alias("triggered_at"))


@query
def mark_queued(spark, sf):
    queued = leads.mark_queued(t.leads(spark, sf), F.lit("run_1"), day_stamp())
    return queued.select("_id", "etl_status", "training_run_id", stamp(F.col("queued_at")).alias("queued_at"))


@query
def eval_metrics(spark, sf):
    per_run = runs.eval_metrics(t.losses(spark, sf), "run_id")
    return per_run.withColumn("perplexity", F.round("perplexity", 6))


@query
def quality_gate(spark, sf):
    gated = runs.quality_gate(runs.eval_metrics(t.losses(spark, sf), "run_id"))
    return gated.select("run_id", "passed", "reason")


# ---- training arrays --------------------------------------------------------


@query
def prompt_mask(spark, sf):
    samples = arrays.token_samples(t.token_rows(spark, sf))
    return samples.select(
        "doc_id",
        F.size("input_ids").alias("n"),
        supervised_tokens(F.col("labels")).alias("supervised"),
        F.array_join(F.col("labels").cast("array<string>"), " ").alias("labels"),
    )


@query
def collate_pad(spark, sf):
    samples = arrays.token_samples(t.token_rows(spark, sf))
    padded = arrays.collate_in_order(samples.select("doc_id", "input_ids", "labels"), "doc_id")
    return padded.select(
        "doc_id",
        "batch_id",
        F.size("input_ids").alias("n"),
        digest(F.col("input_ids")).alias("input_ids"),
        digest(F.col("labels")).alias("labels"),
        digest(F.col("attention_mask")).alias("attention_mask"),
    )


@query
def pack_sequences(spark, sf):
    packed = arrays.pack_sequences(t.token_rows(spark, sf), "doc_id", "full_ids")
    return packed.select("shard", "chunk", F.size("input_ids").alias("n"), digest(F.col("input_ids")).alias("input_ids"))


# ---- monitoring -------------------------------------------------------------


@query
def metric_windows(spark, sf):
    windows = monitoring.metric_windows(t.metrics(spark, sf), "ts", "value", "1 hour", by=("event_type",))
    return windows.withColumn("window_start", stamp(F.col("window_start")))


@query
def metric_windows_daily(spark, sf):
    windows = monitoring.metric_windows(t.metrics(spark, sf), "ts", "value", "1 day", ("sum", "count"))
    return windows.withColumn("window_start", stamp(F.col("window_start")))


@query
def alarm_state(spark, sf):
    errors = t.metrics(spark, sf).withColumn("one", F.lit(1))
    series = monitoring.metric_windows(errors, "ts", "one", "15 minutes", ("sum",), by=("event_type",))
    states = monitoring.alarm_state(series, threshold=3, by=("event_type",))
    return states.withColumn("window_start", stamp(F.col("window_start")))


@query
def budget_alert(spark, sf):
    costs = t.metrics(spark, sf).select("ts", (F.col("value") * F.lit(0.001).cast("decimal(4,3)")).alias("cost"))
    alerts = monitoring.budget_alert(costs)
    return alerts.select(F.col("month").cast("string"), F.col("day").cast("string"), "spend_to_date", "alert")
