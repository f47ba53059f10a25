"""Keyed merges as set-based joins. Every side is reduced to one row per key first."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from parley.schemas import ETL_DONE, ETL_FAILED, ETL_IN_PROGRESS, ETL_PENDING

ETL_ORDER = (ETL_PENDING, ETL_IN_PROGRESS, ETL_FAILED, ETL_DONE)
INSERTED, UPDATED, SKIPPED, FAILED = "inserted", "updated", "skipped", "failed"
COUNTS = (INSERTED, UPDATED, SKIPPED, FAILED)


def latest_per_key(df: DataFrame, keys: list[str], version: str) -> DataFrame:
    """One row per key: the one with the highest version, of equal ones the greatest row.

    Partial aggregation thins out a hot key before the shuffle.
    """
    return _one_per_key(df, keys, lambda row: F.max(F.struct(F.col(version).alias("v"), row.alias("row")))["row"])


def first_per_key(df: DataFrame, keys: list[str], order: str | None = None) -> DataFrame:
    """One row per key: the lowest by ``order``, of equal ones or without an order the smallest row.

    Either way the choice does not depend on partitions or on the order of arrival.
    """
    if order is None:
        return _one_per_key(df, keys, F.min)
    return _one_per_key(df, keys, lambda row: F.min(F.struct(F.col(order).alias("v"), row.alias("row")))["row"])


def _one_per_key(df: DataFrame, keys: list[str], choose) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    chosen = choose(F.struct(*rest))
    return df.groupBy(*keys).agg(chosen.alias("_row")).select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest])


def upsert_replace(target: DataFrame, source: DataFrame, keys: list[str], version: str) -> DataFrame:
    """Target with the latest row of each key of the source put in place of the row with its key."""
    fresh = latest_per_key(source, keys, version).select(*target.columns)
    return target.join(fresh.select(*keys), keys, "left_anti").unionByName(fresh)


def new_rows(target: DataFrame, source: DataFrame, key: str, order: str | None = None) -> DataFrame:
    """Source rows whose key the target lacks, the first of each key."""
    return first_per_key(source.join(target.select(key), key, "left_anti"), [key], order)


def insert_if_absent(target: DataFrame, source: DataFrame, key: str, order: str | None = None) -> DataFrame:
    return target.unionByName(new_rows(target, source, key, order).select(*target.columns))


def plan_upsert(
    target: DataFrame,
    source: DataFrame,
    key: str | list[str],
    overwrite: bool = False,
    version: str | None = None,
    unique: bool = False,
) -> DataFrame:
    """Both rows of each key as ``old`` and ``new``, with the ``action`` to take.

    ``action`` is NULL for a target row the source does not mention. ``unique``
    states that the source has one row per key; otherwise it is reduced to the one
    of the highest ``version``, or to the smallest row, which shares its shuffle with the join.
    """
    keys = [key] if isinstance(key, str) else key
    columns = [c for c in target.columns if c not in keys]
    old = target.select(*keys, F.struct(*columns).alias("old"), F.lit(True).alias("has_old"))
    if unique:
        fresh = source
    else:
        fresh = first_per_key(source, keys) if version is None else latest_per_key(source, keys, version)
    new = fresh.select(*keys, F.struct(*columns).alias("new"), F.lit(True).alias("has_new"))
    changed = ~F.col("old").eqNullSafe(F.col("new"))
    action = (
        F.when(F.col("has_new").isNull(), F.lit(None))
        .when(F.col("has_old").isNull(), F.lit(INSERTED))
        .when(F.lit(overwrite) & changed, F.lit(UPDATED))
        .otherwise(F.lit(SKIPPED))
    )
    return old.join(new, keys, "full_outer").withColumn("action", action)


def bulk_upsert(
    target: DataFrame,
    source: DataFrame,
    key: str,
    overwrite: bool = False,
    dry_run: bool = False,
    version: str | None = None,
    unique: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Merged table and one row of ``inserted, updated, skipped, failed``.

    Without ``overwrite`` present rows are left alone. A dry run writes nothing,
    so it returns the target and counts nothing. A source row without a key fails.
    """
    columns = [c for c in target.columns if c != key]
    valid = source.filter(F.col(key).isNotNull())
    plan = plan_upsert(target, valid, key, overwrite, version, unique)
    take_new = F.col("action").isin(INSERTED, UPDATED)
    row = F.when(take_new, F.col("new")).otherwise(F.col("old"))
    merged = plan.select(key, row.alias("_row")).select(key, *[F.col(f"_row.{c}").alias(c) for c in columns])
    counts = [F.count_if(F.col("action") == a).alias(a) for a in (INSERTED, UPDATED, SKIPPED)]
    failed = source.filter(F.col(key).isNull()).agg(F.count(F.lit(1)).alias("failed"))
    if dry_run:
        zeros = [F.lit(0).cast("bigint").alias(a) for a in (INSERTED, UPDATED, SKIPPED)]
        return target, failed.select(*zeros, "failed")
    return merged, plan.agg(*counts).withColumn("failed", failed.scalar())


def merge_counted(
    target: DataFrame,
    source: DataFrame,
    key: str,
    counts: Observation,
    overwrite: bool = False,
    version: str | None = None,
    unique: bool = False,
) -> DataFrame:
    """The merged table of :func:`bulk_upsert`; writing it fills ``counts`` with the stats, so nothing runs twice.

    Source rows without a key take part as rows of their own, are counted as failed and left out.
    """
    columns = [c for c in target.columns if c != key]
    plan = plan_upsert(target, source.filter(F.col(key).isNotNull()), key, overwrite, version, unique)
    lost = source.filter(F.col(key).isNull()).select(key, F.struct(*columns).alias("new"), F.lit("failed").alias("action"))
    rows = plan.select(key, "old", "new", "action").unionByName(lost, allowMissingColumns=True)
    seen = rows.observe(counts, *[F.count_if(F.col("action") == a).alias(a) for a in COUNTS])
    kept = seen.filter("action is null or action != 'failed'")
    row = F.when(F.col("action").isin(INSERTED, UPDATED), F.col("new")).otherwise(F.col("old"))
    return kept.select(key, row.alias("_row")).select(key, *[F.col(f"_row.{c}").alias(c) for c in columns])


def set_status(docs: DataFrame, ids: DataFrame, status: str, key: str = "doc_id", column: str = "etl_status") -> DataFrame:
    """Documents with the status set on the listed ids."""
    hit = ids.select(key).distinct().withColumn("_hit", F.lit(True))
    new = F.when(F.col("_hit"), F.lit(status)).otherwise(F.col(column))
    return docs.join(hit, key, "left").withColumn(column, new).select(*docs.columns)


def apply_status_log(docs: DataFrame, log: DataFrame, key: str = "doc_id", column: str = "etl_status") -> DataFrame:
    """Documents with the status of the newest log entry ``(key, status, at)``.

    Of entries of one time the one furthest along counts (done, failed, in progress, pending), so that the result
    does not depend on the order of files. Streams append to such a log instead of rewriting the document table.
    """
    rank = F.coalesce(F.array_position(F.array(*[F.lit(s) for s in ETL_ORDER]), F.col("status")), F.lit(0))
    newest = log.groupBy(key).agg(F.max_by("status", F.struct("at", rank.alias("rank"), "status")).alias("_status"))
    return docs.join(newest, key, "left").withColumn(column, F.coalesce("_status", column)).select(*docs.columns)


def skip_done(work: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Work whose key has no output yet. The done side is reduced to distinct keys."""
    return work.join(done.select(key).distinct(), key, "left_anti")


def or_na(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit("n/a"))


def run_report(metrics: DataFrame, training: DataFrame, registration: DataFrame, deployment: DataFrame) -> DataFrame:
    """One row per evaluated run; what a run lacks reads "n/a".

    A run listed several times in a table counts with its smallest row there.
    Run tables carry no broadcast hint: Spark broadcasts them when their measured
    size allows and sorts otherwise.
    """
    parts = [
        training.select("run_id", "model_s3_prefix"),
        registration.select("run_id", "model_package_arn"),
        deployment.select("run_id", "endpoint_name", F.col("status").alias("deployment_status")),
    ]
    parts = [first_per_key(p, ["run_id"]) for p in parts]
    joined = reduce(lambda a, b: a.join(b, "run_id", "left"), parts, first_per_key(metrics, ["run_id"]))
    fields = ("val_loss", "perplexity", "quality_tier", "record_count", "model_s3_prefix", "model_package_arn")
    return joined.select(
        "run_id", *[or_na(F.col(c)).alias(c) for c in (*fields, "endpoint_name", "deployment_status")]
    )
