"""Lead cycle: pick, dispatch, ingest results, tag for training."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.functions.chat import inference_messages
from parley.functions.jsontext import encode
from parley.functions.keys import request_id
from parley.operators.merges import first_per_key
from parley.schemas import (
    DEFAULT_SYSTEM_PROMPT,
    GENERATION_PARAMETERS,
    INFERENCE_COMPLETED,
    INFERENCE_ERROR,
    INFERENCE_PENDING,
    INFERENCE_PROCESSING,
    LEAD_PROCESSED,
    LEAD_QUEUED,
    LEADS_PER_DISPATCH,
    TRIGGER_THRESHOLD,
)
from parley.sources.store import unassigned


def pending_leads(leads: DataFrame, n: int = LEADS_PER_DISPATCH) -> DataFrame:
    """The next leads to dispatch, by id."""
    return leads.filter(F.col("inference_status") == INFERENCE_PENDING).orderBy("_id").limit(n)


def has_conversation(leads: DataFrame) -> DataFrame:
    return leads.filter(F.coalesce(F.col("conversation"), F.lit("")) != "")


def payload(conversation: Column) -> Column:
    """Request body ``{inputs, parameters}`` as JSON text."""
    parameters = F.struct(*[F.lit(v).alias(k) for k, v in GENERATION_PARAMETERS.items()])
    return encode(F.struct(conversation.alias("inputs"), parameters.alias("parameters")))


def inference_payloads(leads: DataFrame, system: str = DEFAULT_SYSTEM_PROMPT, seed: str | int = 42) -> DataFrame:
    """``_id, request_id, payload, messages`` of leads that have a conversation."""
    return has_conversation(leads).select(
        "_id",
        request_id(F.col("_id"), seed).alias("request_id"),
        payload(F.col("conversation")).alias("payload"),
        inference_messages(F.col("conversation"), system).alias("messages"),
    )


def apply_dispatch(leads: DataFrame, sent: DataFrame, at: Column) -> DataFrame:
    """Leads with the outcome of a dispatch.

    ``sent``: ``_id, request_id, output_location, error``; a non-NULL error marks
    the lead as failed, so it can be tried again. A lead listed several times counts
    with its smallest row, a success before a failure.
    """
    tried = sent.withColumn("_failed", F.col("error").isNotNull())
    sent = first_per_key(tried, ["_id"], "_failed").drop("_failed")
    ok = F.col("request_id").isNotNull() & F.col("error").isNull()
    bad = F.col("error").isNotNull()

    def kept(name: str, condition: Column, value: Column) -> Column:
        return F.when(condition, value).otherwise(F.col(name)).alias(name)

    changed = {
        "inference_status": F.when(ok, F.lit(INFERENCE_PROCESSING))
        .when(bad, F.lit(INFERENCE_ERROR))
        .otherwise(F.col("inference_status"))
        .alias("inference_status"),
        "sagemaker_output_s3": kept("sagemaker_output_s3", ok, F.col("output_location")),
        "sagemaker_request_id": kept("sagemaker_request_id", ok, F.col("request_id")),
        "inference_triggered_at": kept("inference_triggered_at", ok, at),
        "inference_error": kept("inference_error", bad, F.col("error")),
        "inference_error_at": kept("inference_error_at", bad, at),
    }
    joined = leads.join(sent, "_id", "left")
    return joined.select(*[changed.get(c, F.col(c)) for c in leads.columns])


def dispatch_summary(picked: DataFrame, sent: DataFrame) -> DataFrame:
    """``status, total_pending, triggered, errors`` of one dispatch."""
    total = picked.agg(F.count(F.lit(1))).scalar()
    return sent.agg(
        F.count_if(F.col("error").isNull()).alias("triggered"), F.count_if(F.col("error").isNotNull()).alias("errors")
    ).select(
        F.when(total == 0, F.lit("no_pending_data")).otherwise(F.lit("completed")).alias("status"),
        total.alias("total_pending"),
        "triggered",
        "errors",
    )


def ingest_results(
    leads: DataFrame, outputs: DataFrame, at: Column, version: str = "key", answered_only: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Leads with their results set, and ``processed, not_found, errors``.

    With ``answered_only`` the first table leaves out the leads that ``outputs`` does not answer.

    ``outputs``: ``key, request_id, result, raw``. Every output counts in the stats.
    Outputs are reduced to one row per request before the join, so a request
    delivered very often does not gather in one task; the last key wins. Outputs
    without a request id or an answer that can be read count as errors and leave their lead as it is.
    """
    bad = F.col("request_id").isNull() | F.col("result").isNull()
    per_request = (
        outputs.filter(~bad)
        .groupBy("request_id")
        .agg(
            F.count(F.lit(1)).alias("_n"),
            F.max_by(F.struct("result", "raw"), F.col(version)).alias("_o"),
        )
    )
    # Leads without a request would all meet in one task under a NULL join key;
    # their own id spreads them, and `found` keeps them from matching.
    wanted = F.coalesce("sagemaker_request_id", F.concat(F.lit("no request "), "_id"))
    found = F.col("_n").isNotNull() & F.col("sagemaker_request_id").isNotNull()

    def kept(name: str, value: Column) -> Column:
        return F.when(found, value).otherwise(F.col(name)).alias(name)

    changed = {
        "inference_status": kept("inference_status", F.lit(INFERENCE_COMPLETED)),
        "inference_result": kept("inference_result", F.col("_o.result")),
        "inference_raw_output": kept("inference_raw_output", F.col("_o.raw")),
        "inference_completed_at": kept("inference_completed_at", at),
    }
    joined = leads.withColumn("request_id", wanted).join(per_request, "request_id", "inner" if answered_only else "left")
    if answered_only:
        joined = joined.where(found)
    updated = joined.select(*[changed.get(c, F.col(c)) for c in leads.columns])

    sent = leads.filter(F.col("sagemaker_request_id").isNotNull())
    known = sent.select(F.col("sagemaker_request_id").alias("request_id")).distinct().withColumn("_known", F.lit(True))
    errors = outputs.agg(F.count_if(bad)).scalar()
    total = F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint")
    hits = F.coalesce(F.sum(F.when(F.col("_known"), F.col("_n"))), F.lit(0)).cast("bigint")
    stats = (
        per_request.select("request_id", "_n")
        .join(known, "request_id", "left")
        .agg(hits.alias("processed"), (total - hits).alias("not_found"))
        .select("processed", "not_found", errors.alias("errors"))
    )
    return updated, stats


def eligible_count(leads: DataFrame, status: str = LEAD_PROCESSED) -> DataFrame:
    return unassigned(leads, status).agg(F.count(F.lit(1)).alias("eligible_records"))


def trigger_gate(leads: DataFrame, threshold: int = TRIGGER_THRESHOLD, status: str = LEAD_PROCESSED) -> DataFrame:
    """``status, reason, eligible_records, threshold`` of the training trigger."""
    enough = F.col("eligible_records") >= threshold
    return eligible_count(leads, status).select(
        F.when(enough, F.lit("triggered")).otherwise(F.lit("skipped")).alias("status"),
        F.when(~enough, F.lit("below_threshold")).alias("reason"),
        "eligible_records",
        F.lit(threshold).cast("bigint").alias("threshold"),
    )


def mark_queued(
    leads: DataFrame, run: Column, at: Column, status: str = LEAD_PROCESSED, when: Column | None = None
) -> DataFrame:
    """Eligible leads tagged with the run; all others unchanged. Needs no shuffle.

    ``when`` may hold back the whole update, such as a gate's scalar subquery.
    """
    eligible = (F.col("etl_status") == status) & F.col("training_run_id").isNull()
    if when is not None:
        eligible = eligible & when

    def tagged(name: str, value: Column) -> Column:
        return F.when(eligible, value).otherwise(F.col(name)).alias(name)

    changed = {
        "etl_status": tagged("etl_status", F.lit(LEAD_QUEUED)),
        "training_run_id": tagged("training_run_id", run),
        "queued_at": tagged("queued_at", at),
    }
    return leads.select(*[changed.get(c, F.col(c)) for c in leads.columns])
