"""Run control: evaluation metrics, quality gate, ledger rows."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.schemas import (
    MAX_LOSS,
    MAX_PERPLEXITY,
    MISSING_METRIC,
    TIER_EXCELLENT_BELOW,
    TIER_GOOD_BELOW,
)


def quality_tier(avg_loss: Column) -> Column:
    return (
        F.when(avg_loss < TIER_EXCELLENT_BELOW, F.lit("excellent"))
        .when(avg_loss < TIER_GOOD_BELOW, F.lit("good"))
        .otherwise(F.lit("needs_improvement"))
    )


def eval_metrics(losses: DataFrame, *by: str) -> DataFrame:
    """Token-weighted loss, perplexity, tokens and tier, over all rows or per run.

    Input: ``loss, tokens`` per batch. A DECIMAL loss is summed exactly. No
    tokens at all give an infinite loss.
    """
    weighted = F.sum(F.col("loss") * F.col("tokens")).cast("double")
    tokens = F.coalesce(F.sum("tokens"), F.lit(0)).cast("bigint")
    totals = losses.groupBy(*by).agg(weighted.alias("_loss"), tokens.alias("total_tokens"))
    average = F.when(F.col("total_tokens") > 0, F.col("_loss") / F.col("total_tokens")).otherwise(F.lit(float("inf")))
    return totals.withColumn("avg_loss", average).select(
        *by,
        "avg_loss",
        F.exp("avg_loss").alias("perplexity"),
        "total_tokens",
        quality_tier(F.col("avg_loss")).alias("quality_tier"),
    )


def reported(metric: Column, digits: int = 4) -> Column:
    """The metric as a DECIMAL of so many digits, rounded by the double's own value.

    A cast rounds its shortest text, which may lie on a tie that the value is below.
    """
    units = F.round(metric * float(10**digits)).cast("decimal(18,0)")
    return (units * F.lit(Decimal(1).scaleb(-digits))).cast(f"decimal(18,{digits})")


def quality_gate(metrics: DataFrame, max_ppl: float = MAX_PERPLEXITY, max_loss: float = MAX_LOSS) -> DataFrame:
    """Adds ``passed`` and ``reason`` (first failed check). ``avg_loss`` is the validation loss."""
    ppl = F.coalesce(F.col("perplexity"), F.lit(MISSING_METRIC))
    loss = F.coalesce(F.col("avg_loss"), F.lit(MISSING_METRIC))
    reason = (
        F.when(ppl > max_ppl, F.lit("perplexity"))
        .when(loss > max_loss, F.lit("val_loss"))
        .when(F.col("quality_tier") == "needs_improvement", F.lit("quality_tier"))
    )
    return metrics.withColumn("reason", reason).withColumn("passed", F.col("reason").isNull())


def run_meta(splits: DataFrame, run: Column, prefix: str, at: Column) -> DataFrame:
    """Run metadata: dataset location and split sizes, one row."""
    return splits.agg(
        F.count_if(F.col("split") == "train").alias("train_count"),
        F.count_if(F.col("split") == "val").alias("val_count"),
    ).select(
        run.alias("run_id"),
        F.concat(F.lit(prefix.rstrip("/") + "/"), run, F.lit("/")).alias("dataset_prefix"),
        "train_count",
        "val_count",
        F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss").alias("created_at"),
    )


def training_run(gate: DataFrame, run: Column, execution_id: Column, at: Column) -> DataFrame:
    """Ledger row of a triggered run; no row when the gate was not met."""
    empty = F.lit(None)
    return gate.filter(F.col("status") == "triggered").select(
        run.alias("_id"),
        F.lit("triggered").alias("status"),
        execution_id.alias("pipeline_execution_id"),
        F.col("eligible_records").alias("record_count"),
        at.cast("timestamp").alias("triggered_at"),
        *[empty.cast("timestamp").alias(c) for c in ("started_at", "completed_at")],
        *[empty.cast("string").alias(c) for c in ("sm_training_job_name", "s3_model_path", "eval_metrics")],
        empty.cast("string").alias("approval_status"),
        F.lit(False).alias("deployed"),
        empty.cast("timestamp").alias("deployed_at"),
        empty.cast("string").alias("endpoint_config_name"),
    )
