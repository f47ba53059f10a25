"""Data-quality checks and the summaries of each phase."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.functions.jsontext import strict_parse
from parley.operators.merges import skip_done
from parley.schemas import (
    BATCH_SIZE,
    BRAND_LIMIT,
    CHAT_ROLES,
    DROP_MAX_SCORE,
    INTENT_MIX,
    LABEL,
    LABEL_ACTIONS,
    LABEL_INTENTS,
    LABEL_URGENCIES,
    NO_BRAND,
    SCORE_TIERS,
)

# ---- fixed values: reasons of the line check -------------------------------
BAD_JSON = "invalid json"
NO_CONVERSATIONS = "missing conversations"
NOT_THREE = "not a list of 3 items"
WRONG_ROLES = "roles mismatch"


def line_reason(v: Column) -> Column:
    """First failed check of a parsed chat JSONL line, NULL when it is good.

    A line that is JSON but no object, or a list item that is no object, is
    reported like any other malformed line.
    """
    convs = F.try_variant_get(v, "$.conversations", "variant")
    items = F.try_variant_get(convs, "$", "array<variant>")
    roles = F.transform(items, lambda m: F.try_variant_get(m, "$.role", "string"))
    expected = F.array(*[F.lit(r) for r in CHAT_ROLES])
    return (
        F.when(v.isNull(), F.lit(BAD_JSON))
        .when(convs.isNull(), F.lit(NO_CONVERSATIONS))
        .when(items.isNull() | (F.size(items) != 3), F.lit(NOT_THREE))
        .when(~F.coalesce(roles == expected, F.lit(False)), F.lit(WRONG_ROLES))
    )


def verify_jsonl(lines: DataFrame, line: str = "line") -> DataFrame:
    # Parsed into a column first, as the reason looks at the value several times.
    parsed = lines.withColumn("_v", strict_parse(F.col(line)))
    return parsed.withColumn("reason", line_reason(F.col("_v"))).drop("_v")


def verify_summary(verified: DataFrame) -> DataFrame:
    malformed = F.count_if(F.col("reason").isNotNull())
    return verified.agg(
        F.count(F.lit(1)).alias("inspected"),
        malformed.alias("malformed"),
        F.when(malformed == 0, F.lit("PASSED")).otherwise(F.lit("FAILED")).alias("status"),
    )


def read_label(assistant: Column) -> Column:
    """Label struct of the assistant text; NULL fields where it holds none."""
    return F.from_json(assistant, LABEL)


def label_audit(df: DataFrame, assistant: str = "assistant", brands: tuple[str, ...] = ()) -> DataFrame:
    """Adds ``label`` and ``violations`` (sorted names of broken rules, empty = good).

    A label that is not a JSON object breaks just the rule ``json``. Brand names
    are checked only when given.
    """
    # All fields at once, instead of a search of the parsed value for each of them.
    fields = F.col("_fields")
    names = F.map_keys(fields)

    def outside(name: str, allowed: tuple[str, ...]) -> Column:
        return F.coalesce(~F.col(f"label.{name}").isin(*allowed), F.lit(False))

    def kind(name: str) -> Column:
        """Type of a field's value; VOID for a JSON null, NULL for a missing field."""
        void = F.when(F.array_contains(names, name), F.lit("VOID"))
        return F.coalesce(F.schema_of_variant(F.element_at(fields, name)), void)

    score = F.col("label.score")
    rules = {
        "brand_fit": outside("brand_fit", (*brands, NO_BRAND)) if brands else F.lit(False),
        "intent": outside("intent", LABEL_INTENTS),
        "missing_key": F.size(F.array_except(F.array(*[F.lit(f.name) for f in LABEL.fields]), names)) > 0,
        "next_action": outside("next_action", LABEL_ACTIONS),
        "score": F.coalesce(~score.between(0, 100), F.lit(False)) | F.coalesce(kind("score") != "BIGINT", F.lit(False)),
        "timeline_months": F.coalesce(~kind("timeline_months").isin("BIGINT", "VOID"), F.lit(False)),
        "urgency": outside("urgency", LABEL_URGENCIES),
    }
    broken = F.array_compact(F.array(*[F.when(rule, F.lit(name)) for name, rule in rules.items()]))
    return (
        df.withColumn("_v", strict_parse(F.col(assistant)))
        .withColumn("_fields", F.try_variant_get("_v", "$", "map<string,variant>"))
        .withColumn("label", read_label(F.col(assistant)))
        .withColumn("violations", F.when(fields.isNotNull(), broken).otherwise(F.array(F.lit("json"))))
        .drop("_v", "_fields")
    )


def _all(terms: list[Column]) -> Column:
    every = terms[0]
    for t in terms[1:]:
        every = every & t
    return every


@dataclass(frozen=True)
class BatchRules:
    """What a batch has to keep; score tiers do not overlap."""

    size: int = BATCH_SIZE
    intent_mix: dict[str, int] = field(default_factory=lambda: dict(INTENT_MIX))
    score_tiers: tuple[tuple[int, int], ...] = SCORE_TIERS
    brand_limit: int = BRAND_LIMIT
    drop_max_score: int = DROP_MAX_SCORE


def batch_audit(labels: DataFrame, rules: BatchRules = BatchRules()) -> DataFrame:
    """One row per batch: a boolean per rule, true when the rule is kept.

    Input: ``batch_num, intent, score, brand_fit, next_action, preferred_locality``.
    A label without an intent, such as one that could not be read, counts for the
    size and breaks ``readable_ok``. Counts combine before each shuffle and nothing is collected per batch, so a
    batch may hold any share of the rows.
    """
    good_drop = (
        (F.col("score") <= rules.drop_max_score) & (F.col("next_action") == "drop") & (F.col("brand_fit") == NO_BRAND)
    )
    bad_drop = (F.col("intent") == "drop") & ~F.coalesce(good_drop, F.lit(False))
    tier = F.coalesce(*[F.when(F.col("score").between(lo, hi), F.lit(lo)) for lo, hi in rules.score_tiers])
    unreadable = F.col("intent").isNull()
    brand = F.when(F.col("brand_fit") != NO_BRAND, F.col("brand_fit"))

    # Each row counts once for what the rules tell apart in a batch (a small number of kinds), once for its brand and
    # once for its locality. Only (batch, kind, value, n) moves; the rules' counters are made of the counts afterwards.
    def role(kind: str, value: Column | None = None, **facts: Column) -> Column:
        none = F.lit(None)
        return F.struct(
            F.lit(kind).alias("kind"),
            (none if value is None else value).cast("string").alias("value"),
            facts.get("intent", none).cast("string").alias("intent"),
            facts.get("tier", none).cast("int").alias("tier"),
            facts.get("bad", none).cast("boolean").alias("bad"),
        )

    known = F.when(F.col("intent").isin(*rules.intent_mix), F.col("intent")).when(~unreadable, F.lit(""))
    roles = [role("batch", intent=known, tier=tier, bad=bad_drop), role("brand", brand), role("locality", F.col("preferred_locality"))]
    counted = (
        labels.withColumn("r", F.explode(F.array(*roles)))
        .filter((F.col("r.kind") == "batch") | F.col("r.value").isNotNull())
        .groupBy("batch_num", "r.kind", "r.value", "r.intent", "r.tier", "r.bad")
        .agg(F.count(F.lit(1)).alias("k"))
    )
    whole = F.col("kind") == "batch"

    def total(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(whole & condition, F.col("k"))), F.lit(0))

    def most(kind: str) -> Column:
        return F.coalesce(F.max(F.when(F.col("kind") == kind, F.col("k"))), F.lit(0))

    totals = counted.groupBy("batch_num").agg(
        total(F.lit(True)).alias("n"),
        *[total(F.col("intent") == i).alias(f"intent_{i}") for i in rules.intent_mix],
        *[total(F.col("tier") == lo).alias(f"tier_{lo}") for lo, _ in rules.score_tiers],
        total(F.col("intent").isNull()).alias("unreadable"),
        total(F.col("bad")).alias("bad_drops"),
        most("brand").alias("brand_uses"),
        most("locality").alias("locality_uses"),
    )
    checks = {
        "size_ok": F.col("n") == rules.size,
        "intent_mix_ok": _all([F.col(f"intent_{i}") == n for i, n in rules.intent_mix.items()]),
        "score_tiers_ok": _all([F.col(f"tier_{lo}") > 0 for lo, _ in rules.score_tiers]),
        "brand_limit_ok": F.col("brand_uses") <= rules.brand_limit,
        "locality_unique_ok": F.col("locality_uses") <= 1,
        "drops_ok": F.col("bad_drops") == 0,
        "readable_ok": F.col("unreadable") == 0,
    }
    return totals.select("batch_num", "n", *[c.alias(name) for name, c in checks.items()]).withColumn(
        "passed", _all([F.col(name) for name in checks])
    )


def records_per_batch(work: DataFrame, records: DataFrame) -> DataFrame:
    """``batch_num, n_records`` for every batch of the work list, 0 when it has none."""
    found = records.groupBy("batch_num").agg(F.count(F.lit(1)).alias("n_records"))
    return (
        work.select("batch_num")
        .distinct()
        .join(found, "batch_num", "left")
        .select("batch_num", F.coalesce("n_records", F.lit(0)).alias("n_records"))
    )


def failed_batches(per_batch: DataFrame) -> DataFrame:
    """The failed batches as rows: a list in one row would grow with the data."""
    return per_batch.filter(F.col("n_records") == 0).select("batch_num")


def clean_summary(per_batch: DataFrame) -> DataFrame:
    """Masked records and failed batches (those with no record)."""
    return per_batch.agg(
        F.count(F.lit(1)).alias("batches"),
        F.coalesce(F.sum("n_records"), F.lit(0)).cast("bigint").alias("total_scrubbed"),
        F.count_if(F.col("n_records") == 0).alias("failed_batches"),
    )


def generation_summary(per_batch: DataFrame) -> DataFrame:
    """Attempted batches, records obtained, failed batches."""
    return per_batch.agg(
        F.count(F.lit(1)).alias("attempted"),
        F.coalesce(F.sum("n_records"), F.lit(0)).cast("bigint").alias("successful_records"),
        F.count_if(F.col("n_records") == 0).alias("failed_batches"),
    )


def phase_stats(transformed: DataFrame, store: DataFrame, key: str = "mongo_id") -> DataFrame:
    """One row of stats for a run over validated records and the store before it.

    ``loaded`` counts ``inserted`` plus ``skipped``, the records already there.
    """
    accepted = transformed.filter(F.col("reason").isNull()).select(key)
    present = store.select(F.col("source_id").alias(key)).distinct()
    inserted = skip_done(accepted, present, key).agg(F.count_distinct(F.col(key)))
    ok, bad = F.count_if(F.col("reason").isNull()), F.count_if(F.col("reason").isNotNull())
    return transformed.agg(
        F.count(F.lit(1)).alias("published"), ok.alias("transformed"), bad.alias("failed"), bad.alias("dlq")
    ).select(
        "published",
        "transformed",
        "failed",
        "dlq",
        F.col("transformed").alias("loaded"),
        inserted.scalar().alias("inserted"),
        (F.col("transformed") - inserted.scalar()).alias("skipped"),
    )
