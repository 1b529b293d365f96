"""Drift of value distributions between windows and against a baseline, and alarms on them."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import distances
from tidemark.operators.profile import GROUP, Monitor, publish, value_counts

SERIES = ["model_version", "slice_key", "slice_value", "column_name"]
WINDOW = ["window_start", "window_end"]


def distribution(df: DataFrame, monitor: Monitor, columns: Sequence[str] | None = None) -> DataFrame:
    """Share ``p`` of each value per window, model, slice and column; nulls are left out.

    ``next_start`` / ``next_end`` name the following window of the series that exists and
    ``has_previous`` says whether there is an earlier one; both come from the totals, which
    have one row per window and series.
    """
    counts = value_counts(df, monitor, columns or monitor.categorical).filter(F.col("value").isNotNull())
    line = Window.partitionBy(*SERIES).orderBy("window_start")
    totals = counts.groupBy(*GROUP, "column_name").agg(F.sum("n").alias("total"))
    totals = totals.withColumns(
        {
            "next_start": F.lead("window_start").over(line),
            "next_end": F.lead("window_end").over(line),
            "has_previous": F.lag("window_start").over(line).isNotNull(),
        }
    )
    shares = counts.join(totals, [*GROUP, "column_name"])
    return shares.withColumn("p", F.col("n") / F.col("total"))


def _distances(sides: DataFrame, by: Sequence[str]) -> DataFrame:
    """Distances per group from rows ``by.., value, p, q, a, b``, where a value may take two rows."""
    values = sides.groupBy(*by, "value").agg(*[F.sum(c).alias(c) for c in ("p", "q", "a", "b")])
    return values.groupBy(*by).agg(
        distances.total_variation().alias("tv_distance"),
        distances.l_infinity().alias("l_infinity_distance"),
        distances.jensen_shannon().alias("js_distance"),
        distances.chi_squared().alias("chi_squared_statistic"),
        (F.count(F.lit(1)) - 1).alias("degrees"),
    )


def _side(start: str, end: str, current: bool) -> Column:
    """One distribution row as the current or the reference side of the pair at a window."""
    zero, none = F.lit(0.0), F.lit(0).cast("long")
    p, n = F.col("p"), F.col("n")
    return F.struct(
        F.col(start).alias("window_start"),
        F.col(end).alias("window_end"),
        (p if current else zero).alias("p"),
        (zero if current else p).alias("q"),
        (n if current else none).alias("a"),
        (none if current else n).alias("b"),
    )


def _finish(found: DataFrame, kind: str, p_value: bool) -> DataFrame:
    out = found.withColumn("drift_type", F.lit(kind))
    if p_value:
        out = out.withColumn(
            "chi_squared_pvalue",
            distances.chi_squared_p_value(F.col("chi_squared_statistic"), F.col("degrees").cast("double")),
        )
    return publish(out.drop("degrees"))


def consecutive_drift(shares: DataFrame, p_value: bool = False) -> DataFrame:
    """Each window against the previous window that exists; the first window has no row.

    Every value row counts for its own window and, as reference, for the next one. The two
    sides of a pair then meet in one aggregate, without joining the table to itself.
    """
    own, following = _side("window_start", "window_end", True), _side("next_start", "next_end", False)
    sides = F.array_compact(
        F.array(F.when(F.col("has_previous"), own), F.when(F.col("next_start").isNotNull(), following))
    )
    rows = shares.select(*SERIES, "value", F.inline(sides))
    return _finish(_distances(rows, [*SERIES, *WINDOW]), "CONSECUTIVE", p_value)


def baseline_shares(baseline: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Baseline count ``b``, share ``q`` and column totals per column and value."""
    pairs = [F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in columns]
    counts = (
        baseline.select(F.inline(F.array(*pairs)))
        .filter(F.col("value").isNotNull())
        .groupBy("column_name", "value")
        .agg(F.count(F.lit(1)).alias("b"))
    )
    totals = counts.groupBy("column_name").agg(
        F.sum("b").alias("base_total"), F.count(F.lit(1)).alias("base_values")
    )
    return counts.join(totals, "column_name").withColumn("q", F.col("b") / F.col("base_total"))


def baseline_drift(shares: DataFrame, baseline: DataFrame, columns: Sequence[str], p_value: bool = False) -> DataFrame:
    """Each window against the value shares of the baseline table.

    Window values are joined to their own baseline value. What the baseline has beyond a
    window's values enters in closed form from the counts left over, so the baseline is
    never repeated per window. Only the largest share left over needs more: it is the
    highest baseline count of which the window lacks a value, found from how many values
    of each count the window has.
    """
    fixed = baseline_shares(baseline, columns)
    by = [*SERIES, *WINDOW]
    watched = shares.filter(F.col("column_name").isin(list(columns)))
    rows = watched.select(*by, "value", "p", F.col("n").alias("a"))
    rows = rows.join(fixed.select("column_name", "value", "q", "b"), ["column_name", "value"], "left")
    rows = rows.withColumns({"q": F.coalesce("q", F.lit(0.0)), "b": F.coalesce("b", F.lit(0))})

    # Baseline counts per column, highest first, with the number of values that have each.
    levels = fixed.groupBy("column_name", "b").agg(F.count(F.lit(1)).alias("of_level"))
    ranked = levels.withColumn("level", F.row_number().over(Window.partitionBy("column_name").orderBy(F.desc("b"))))
    held = rows.filter(F.col("b") > 0).groupBy(*by, "b").agg(F.count(F.lit(1)).alias("held"))
    whole = held.join(ranked, ["column_name", "b"]).filter(F.col("held") == F.col("of_level"))
    # Levels 1, 2, .. without a gap are complete; the first absent one is the level wanted.
    place = F.row_number().over(Window.partitionBy(*by).orderBy("level"))
    complete = whole.withColumn("place", place).groupBy(*by).agg((F.count_if(F.col("level") == F.col("place")) + 1).alias("gap"))

    sums = rows.groupBy(*by).agg(
        F.sum(F.abs(F.col("p") - F.col("q"))).alias("_l1"),
        F.max(F.abs(F.col("p") - F.col("q"))).alias("_max"),
        F.sum(distances.divergence_half("p") + distances.divergence_half("q")).alias("_js"),
        F.sum(F.pow(F.col("p") - F.col("q"), 2) / (F.col("a") + F.col("b"))).alias("_chi"),
        F.sum("a").alias("_a"),
        F.sum("b").alias("_b"),
        F.count(F.lit(1)).alias("_values"),
        F.count_if(F.col("b") > 0).alias("_shared"),
    )
    totals = fixed.select("column_name", "base_total", "base_values").distinct()
    joined = sums.join(totals, "column_name").join(complete, by, "left")
    joined = joined.withColumn("level", F.coalesce("gap", F.lit(1)))
    joined = joined.join(ranked.select("column_name", "level", F.col("b").alias("_top")), ["column_name", "level"], "left")
    left_over = (F.col("base_total") - F.col("_b")) / F.col("base_total")
    top = F.coalesce(F.col("_top") / F.col("base_total"), F.lit(0.0))
    found = joined.select(
        *by,
        ((F.col("_l1") + left_over) / 2).alias("tv_distance"),
        F.greatest("_max", top).alias("l_infinity_distance"),
        F.sqrt(F.greatest(F.col("_js") + left_over / 2, F.lit(0.0))).alias("js_distance"),
        ((F.col("_chi") + left_over / F.col("base_total")) * F.col("_a") * F.col("base_total")).alias(
            "chi_squared_statistic"
        ),
        (F.col("_values") + F.col("base_values") - F.col("_shared") - 1).alias("degrees"),
    )
    return _finish(found, "BASELINE", p_value)


def performance_series(profile: DataFrame, metric: str, model: str, since: str | None = None) -> DataFrame:
    """Whole-table performance of one model over time."""
    rows = profile.filter(
        (F.col("log_type") == "INPUT")
        & (F.col("column_name") == ":table")
        & F.col("slice_key").isNull()
        & F.col("slice_value").isNull()
        & (F.col("model_version") == model)
    )
    if since is not None:
        rows = rows.filter(F.col("window_start") >= F.lit(since).cast(rows.schema["window_start"].dataType))
    return rows.select(
        F.col("window_start").alias("time"),
        F.col(metric).alias("performance_metric"),
        "expected_loss",
        F.col("model_version").alias("model_id"),
    )


def drift_series(
    drift: DataFrame, metric: str, columns: Sequence[str], model: str, since: str | None = None
) -> DataFrame:
    """Whole-table consecutive drift of the given columns, one column each, per time."""
    rows = drift.filter(
        F.col("column_name").isin(list(columns))
        & F.col("slice_key").isNull()
        & F.col("slice_value").isNull()
        & (F.col("model_version") == model)
        & (F.col("drift_type") == "CONSECUTIVE")
    )
    if since is not None:
        rows = rows.filter(F.col("window_start") >= F.lit(since).cast(rows.schema["window_start"].dataType))
    return (
        rows.groupBy(F.col("window_start").alias("time"), F.col("model_version").alias("model_id"))
        .pivot("column_name", list(columns))
        .agg(F.first(metric))
    )


def all_metrics(performance: DataFrame, drift: DataFrame, drift_columns: Sequence[str]) -> DataFrame:
    """Performance joined with drift by time and model.

    Only times with drift are kept; without any drift rows the performance stands alone,
    with null drift. Both cases are one plan.
    """
    none = drift.agg(F.count(F.lit(1)) == 0).scalar()
    marked = drift.withColumn("_found", F.lit(True))
    kept = performance.join(marked, ["time", "model_id"], "left").filter(F.col("_found").isNotNull() | none)
    return kept.select(*performance.columns, *drift_columns)


@dataclass(frozen=True)
class Limits:
    """Alarm limits: poor metric and high loss together; drift of every watched column together."""

    metric: float = 0.5
    loss: float = 30.0
    drift: float = 0.19


def violations(metrics: DataFrame, drift_columns: Sequence[str], limits: Limits = Limits()) -> DataFrame:
    """One row with the number of windows that break each limit, and the sum."""
    poor = (F.col("performance_metric") < limits.metric) & (F.abs(F.col("expected_loss")) > limits.loss)
    drifted = F.lit(True)
    for name in drift_columns:
        drifted = drifted & F.coalesce(F.col(name) > limits.drift, F.lit(False))
    counted = metrics.agg(
        F.count_if(poor).alias("performance_violations"), F.count_if(drifted).alias("drift_violations")
    )
    return counted.withColumn("all_violations", F.col("performance_violations") + F.col("drift_violations"))
