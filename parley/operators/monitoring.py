"""Monitoring series, alarms and budget alerts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parley.operators.ranks import broadcast_if_small
from parley.session import cut_lineage

# Rank error of an approximate percentile is at most 1/PERCENTILE_ACCURACY of a window's rows.
PERCENTILE_ACCURACY = 10_000
ALARM_MINUTES = 15
# Rows of a window and series that one task puts in order.
GROUP_ROWS = 100_000
# Cells in which values within a factor e of each other are counted.
CELLS_PER_E = 1024
# Rows of a cell that are put in order at once; a cell of more rows is cut into even parts first.
CELL_ROWS = 100_000
FINE_CELLS = 4096
# Size of a quantile sketch (k of KLL).
SKETCH_SIZE = 2048


def metric_windows(
    df: DataFrame,
    ts: str,
    value: str,
    width: str,
    stats: tuple[str, ...] = ("sum", "avg", "p50", "p99"),
    by: tuple[str, ...] = (),
    exact: bool = True,
) -> DataFrame:
    """Statistics per time window: any of ``sum``, ``avg``, ``count`` and ``pNN``.

    All of them combine before the shuffle. Percentiles are exact for windows of
    any size: small windows are put in order, and in large ones they are selected
    by counting, see :func:`_selected`. ``exact=False`` keeps a bounded state
    instead and is off by at most 1/10,000 of a window's rows.
    """
    rows = df.select(F.window(ts, width).alias("w"), *by, F.col(value).alias("_value"))
    shares = [int(s[1:]) / 100 for s in stats if s.startswith("p")]
    n, total = F.col("_n"), F.col("_sum").cast("double")
    if exact and shares:
        grouped = _exact(rows, ["w", *by], shares)
    else:
        approx = [
            F.percentile_approx(F.col("_value").cast("double"), p, PERCENTILE_ACCURACY).alias(f"_p{i}") for i, p in enumerate(shares)
        ]
        grouped = rows.groupBy("w", *by).agg(F.count("_value").alias("_n"), F.sum("_value").alias("_sum"), *approx)
    return _named(grouped, F.col("w.start"), by, stats, n, total, lambda i: F.col(f"_p{i}"))


def _named(grouped: DataFrame, start, by, stats, n, total, percentile) -> DataFrame:
    known = {"sum": total, "avg": F.when(n > 0, total / n), "count": n}
    known |= {s: percentile(i) for i, s in enumerate(s for s in stats if s.startswith("p"))}
    return grouped.select(start.alias("window_start"), *by, *[known[s].alias(s) for s in stats])


def _cell(c):
    """A number that never falls as the value rises: the value's logarithm in steps; NaN comes last, as in Spark's order."""
    v = c.cast("double")
    step = F.floor(F.log1p(F.abs(v)) * CELLS_PER_E)
    return F.when(F.isnan(v), F.lit((1 << 63) - 1)).when(v < 0, -step).otherwise(step)


def _match(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on ``keys``, which may be NULL; the left side's keys stay."""
    other = right.select(*[F.col(c).alias(f"_r_{c}") if c in keys else F.col(c) for c in right.columns])
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys])
    return left.join(other, same, how).drop(*[f"_r_{k}" for k in keys])


def _exact(rows: DataFrame, keys: list[str], shares: list[float]) -> DataFrame:
    """``keys, _n, _sum, _p0, _p1 ...`` of each group, large groups apart from the others."""
    sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    large = sizes.filter(F.col("_rows") > GROUP_ROWS).drop("_rows")
    if not large.take(1):
        return _ordered(rows, keys, shares)
    # Few by their size; counted, as there may be many on a very large table.
    large = broadcast_if_small(cut_lineage(large))[0].withColumn("_large", F.lit(True))
    marked = _match(rows, large, keys, "left")
    small = _ordered(marked.filter("_large is null").drop("_large"), keys, shares)
    return small.unionByName(_selected(_match(rows, large, keys).drop("_large"), keys, shares))


def _ordered(rows: DataFrame, keys: list[str], shares: list[float]) -> DataFrame:
    """Percentiles of groups of at most ``GROUP_ROWS`` rows, from their values in order."""
    v = F.col("_value")
    values = rows.groupBy(*keys).agg(F.count(v).alias("_n"), F.sum(v).alias("_sum"), F.array_sort(F.collect_list(v)).alias("_v"))
    place = lambda p: (F.greatest(F.ceil(F.lit(p) * F.col("_n")), F.lit(1)) - 1).cast("int")
    found = [F.get("_v", place(p)).cast("double").alias(f"_p{i}") for i, p in enumerate(shares)]
    return values.select(*keys, "_n", "_sum", *found)


def _selected(rows: DataFrame, keys: list[str], shares: list[float]) -> DataFrame:
    """``keys, _n, _sum, _p0, _p1 ...``: exact percentiles of ``_value`` per group, without ordering a group's values.

    Values are counted in cells of the logarithmic scale, whose number does not
    depend on the rows. The counts tell the cell and the place in it of each
    percentile; the values of these cells alone are then looked at, in a second
    pass over the narrow input. A cell that holds very many rows is cut evenly
    into further cells first. So no task gets more of a large group than of others.
    """
    rows = rows.withColumn("_cell", _cell(F.col("_value")))
    v = F.col("_value")
    counted = rows.groupBy(*keys, "_cell").agg(
        F.count(v).alias("_k"), F.sum(v).alias("_s"), F.min(v).cast("double").alias("_lo"), F.max(v).cast("double").alias("_hi")
    )
    series = Window.partitionBy(*keys)
    held = counted.withColumns(
        {
            "_n": F.sum("_k").over(series),
            "_sum": F.sum("_s").over(series),
            "_upto": F.sum("_k").over(series.orderBy(F.col("_cell").asc_nulls_first())),
        }
    )
    wanted = F.array(
        *[
            F.struct(F.lit(i).alias("cut"), F.greatest(F.ceil(F.lit(p) * F.col("_n")), F.lit(1)).alias("at"))
            for i, p in enumerate(shares)
        ]
    )
    facts = [*keys, "_n", "_sum"]
    cuts = (
        held.withColumn("w_", F.explode(wanted))
        .filter((F.col("w_.at") > F.col("_upto") - F.col("_k")) & (F.col("w_.at") <= F.col("_upto")))
        .select(*facts, "_cell", "_k", "_lo", "_hi", F.col("w_.cut").alias("_cut"), (F.col("w_.at") - F.col("_upto") + F.col("_k")).alias("_at"))
    )
    # Groups of NULL values only have no percentile.
    nothing = held.filter("_n = 0").select(*facts, F.lit(None).cast("int").alias("_cut"), F.lit(None).cast("double").alias("_v"))
    small = _match(rows, cuts.filter(F.col("_k") <= CELL_ROWS), [*keys, "_cell"])
    large = _match(rows, cuts.filter(F.col("_k") > CELL_ROWS), [*keys, "_cell"])
    found = _in_order(small, facts).unionByName(_in_order(_finer(large, facts), facts)).unionByName(nothing)
    picks = [F.max(F.when(F.col("_cut") == i, F.col("_v"))).alias(f"_p{i}") for i in range(len(shares))]
    return found.groupBy(*facts).agg(*picks)


def _in_order(near: DataFrame, facts: list[str]) -> DataFrame:
    """``facts, _cut, _v``: the value at place ``_at`` of each cut among the values of its cell."""
    counted = near.groupBy(*facts, "_cut", "_at", "_value").agg(F.count(F.lit(1)).alias("_k"))
    upto = F.sum("_k").over(Window.partitionBy(*facts, "_cut").orderBy("_value"))
    placed = counted.withColumn("_upto", upto).filter((F.col("_at") > F.col("_upto") - F.col("_k")) & (F.col("_at") <= F.col("_upto")))
    return placed.select(*facts, "_cut", F.col("_value").cast("double").alias("_v"))


def _finer(near: DataFrame, facts: list[str]) -> DataFrame:
    """The rows of ``near`` in the one of ``FINE_CELLS`` even parts of their cell that holds the cut, ``_at`` counted from its start."""
    width = F.col("_hi") - F.col("_lo")
    part = F.floor((F.col("_value").cast("double") - F.col("_lo")) / width * FINE_CELLS)
    near = near.withColumn("_part", F.when((width > 0) & (width < float("inf")), part).otherwise(F.lit(0)))
    counted = near.groupBy(*facts, "_cut", "_at", "_part").agg(F.count(F.lit(1)).alias("_k"))
    upto = F.sum("_k").over(Window.partitionBy(*facts, "_cut").orderBy("_part"))
    below = F.col("_upto") - F.col("_k")
    held = counted.withColumn("_upto", upto).filter((F.col("_at") > below) & (F.col("_at") <= F.col("_upto")))
    part = held.select(*facts, "_cut", "_part", (F.col("_at") - below).alias("_rest"))
    return _match(near, part, [*facts, "_cut", "_part"]).withColumn("_at", F.col("_rest")).drop("_rest", "_part")


def metric_sketches(df: DataFrame, ts: str, value: str, width: str, by: tuple[str, ...] = ()) -> DataFrame:
    """``window_start, *by, n, total, sketch`` per window: counts, sums and quantile sketches, all of which can be merged.

    Works on streams. NULL values are left out of ``n`` and the sketch. A sketch has a fixed size, whatever the rows.
    """
    c = F.col(value)
    sketch = F.kll_sketch_agg_double(c.cast("double"), SKETCH_SIZE)
    sums = [F.count(c).alias("n"), F.sum(c).cast("double").alias("total"), sketch.alias("sketch")]
    return df.groupBy(F.window(ts, width).alias("w"), *by).agg(*sums).select(F.col("w.start").alias("window_start"), *by, "n", "total", "sketch")


def merge_sketches(sketches: DataFrame, width: str, by: tuple[str, ...] = ()) -> DataFrame:
    """Sketched windows put together to wider ones, without the rows they came from."""
    sums = [F.sum("n").alias("n"), F.sum("total").alias("total"), F.kll_merge_agg_double("sketch", SKETCH_SIZE).alias("sketch")]
    return sketches.groupBy(F.window("window_start", width).alias("w"), *by).agg(*sums).select(F.col("w.start").alias("window_start"), *by, "n", "total", "sketch")


def sketched_windows(sketches: DataFrame, stats: tuple[str, ...], by: tuple[str, ...] = ()) -> DataFrame:
    """``metric_windows`` from sketches; a percentile's rank is off by about 0.2 % of a window's rows."""
    shares = [int(s[1:]) / 100 for s in stats if s.startswith("p")]
    # An empty sketch has no quantile.
    percentile = lambda i: F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("sketch", F.lit(shares[i])))
    return _named(sketches, F.col("window_start"), by, stats, F.col("n"), F.col("total"), percentile)


def alarm_state(
    series: DataFrame, threshold: float, periods: int = 2, minutes: int = ALARM_MINUTES, by: tuple[str, ...] = ()
) -> DataFrame:
    """ALARM where a sum reaches the threshold in consecutive periods, else OK.

    Input: ``window_start, sum`` per period. Periods without data do not breach;
    they appear with a NULL sum. A series has one row per period, so its size is
    given by time and not by the number of events.
    """
    step = F.make_dt_interval(mins=F.lit(minutes))
    spine = (
        series.groupBy(*by)
        .agg(F.min("window_start").alias("_first"), F.max("window_start").alias("_last"))
        .select(*by, F.explode(F.sequence("_first", "_last", step)).alias("window_start"))
    )
    w = Window.partitionBy(*by).orderBy("window_start").rowsBetween(-(periods - 1), Window.currentRow)
    breach = F.coalesce(F.col("sum") >= threshold, F.lit(False))
    return (
        spine.join(series, [*by, "window_start"], "left")
        .withColumn("_run", F.count_if(breach).over(w))
        .select(
            *by,
            "window_start",
            "sum",
            F.when(F.col("_run") == periods, F.lit("ALARM")).otherwise(F.lit("OK")).alias("state"),
        )
    )


def budget_alert(costs: DataFrame, ts: str = "ts", cost: str = "cost", limit: float = 50, pct: float = 80) -> DataFrame:
    """Spend to date per day of each month, with an alert above ``pct`` percent of the limit.

    Costs are added up per day first, so the running sum meets at most 31 rows a month.
    """
    daily = costs.groupBy(F.to_date(ts).alias("day")).agg(F.sum(cost).alias("spent"))
    month = F.trunc("day", "month")
    running = Window.partitionBy("month").orderBy("day").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        daily.withColumn("month", month)
        .withColumn("spend_to_date", F.sum("spent").over(running).cast("double"))
        .select("month", "day", "spend_to_date", (F.col("spend_to_date") > limit * pct / 100).alias("alert"))
    )
