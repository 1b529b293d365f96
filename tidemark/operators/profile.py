"""Daily sliced profiles of an inference log.

Rows are aggregated once at the finest grain: time window, model and the values
of all slice expressions. Slices and the all-models total are then built from
that small table, so rows are never multiplied by the number of slices.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators import classify
from tidemark.operators.merge import Combine

ALL_MODELS = "*"
GROUP = ["window_start", "window_end", "model_version", "slice_key", "slice_value"]


@dataclass(frozen=True)
class Monitor:
    """What to watch in a log: its columns, time granularity, slices and own metrics.

    ``custom`` maps a metric name to an aggregate SQL template that may use
    ``{{prediction_col}}`` and ``{{label_col}}``.
    """

    time_col: str
    granularity: str = "1 day"
    model_col: str | None = None
    prediction_col: str | None = None
    label_col: str | None = None
    numeric: Sequence[str] = ()
    categorical: Sequence[str] = ()
    slices: Sequence[str] = ()
    custom: Mapping[str, str] = field(default_factory=dict)

    @property
    def grain(self) -> list[str]:
        return ["window_start", "window_end", "_model", *[f"_slice{i}" for i in range(len(self.slices))]]


def with_grain(df: DataFrame, monitor: Monitor) -> DataFrame:
    """Add window bounds, model and slice values; rows without a time are left out."""
    span = F.window(monitor.time_col, monitor.granularity)
    model = F.lit(ALL_MODELS) if monitor.model_col is None else F.col(monitor.model_col).cast("string")
    added = {f"_slice{i}": F.expr(s).cast("string") for i, s in enumerate(monitor.slices)}
    marked = df.withColumns({"_window": span, "_model": model, **added}).withColumns(
        {"window_start": F.col("_window.start"), "window_end": F.col("_window.end")}
    )
    # Stated here so that all plans built on the same grain scan alike and share one exchange.
    return marked.filter(F.col("window_start").isNotNull() & F.col("window_end").isNotNull())


def expand(base: DataFrame, monitor: Monitor) -> DataFrame:
    """Turn grain rows into rows per model (and all models) and per slice (and the whole table).

    The whole table has empty slice key and value here; ``publish`` makes them null.
    """

    def slice_of(key: str, value: Column) -> Column:
        return F.struct(F.lit(key).alias("slice_key"), value.alias("slice_value"))

    slices = [slice_of("", F.lit(""))] + [slice_of(s, F.col(f"_slice{i}")) for i, s in enumerate(monitor.slices)]
    models = [F.lit(ALL_MODELS)] + ([F.col("_model")] if monitor.model_col is not None else [])
    rest = [c for c in base.columns if c not in monitor.grain]
    rows = base.withColumn("model_version", F.explode(F.array(*models)))
    rows = rows.select("window_start", "window_end", "model_version", F.inline(F.array(*slices)), *rest)
    return rows.filter(F.col("slice_value").isNotNull() & F.col("model_version").isNotNull())


def publish(df: DataFrame) -> DataFrame:
    """The markers of the whole table to null; an empty value of a real slice stays."""
    sliced = F.col("slice_key") != ""
    return df.withColumns({c: F.when(sliced, F.col(c)) for c in ("slice_key", "slice_value")})


def window_counts(df: DataFrame, time_col: str, granularity: str = "1 day", by: Sequence[str] = ()) -> DataFrame:
    """Rows per tumbling window."""
    span = F.window(time_col, granularity).alias("window")
    return df.groupBy(span, *by).agg(F.count(F.lit(1)).alias("n"))


def numeric_state(df: DataFrame, monitor: Monitor) -> DataFrame:
    """What a numeric profile is made of, per window, model and slice values; parts of a log add up.

    Rows, and of each column count, sum, squared deviations from the mean, and extremes.
    """

    def value(c: str) -> Column:
        return F.col(c).cast("double")

    return with_grain(df, monitor).groupBy(*monitor.grain).agg(
        F.count(F.lit(1)).alias("_rows"),
        *[
            a
            for i, c in enumerate(monitor.numeric)
            for a in (
                F.count(value(c)).alias(f"_n{i}"),
                F.sum(value(c)).alias(f"_sum{i}"),
                (F.var_pop(value(c)) * F.count(value(c))).alias(f"_dev{i}"),
                F.min(value(c)).alias(f"_min{i}"),
                F.max(value(c)).alias(f"_max{i}"),
            )
        ],
    )


def distinct_state(df: DataFrame, monitor: Monitor) -> DataFrame:
    """Sketches of the distinct values of each numeric column, at the same grain."""
    sketches = [F.hll_sketch_agg(F.col(c).cast("string")).alias(f"_hll{i}") for i, c in enumerate(monitor.numeric)]
    return with_grain(df, monitor).groupBy(*monitor.grain).agg(*sketches)


def added_deviations(i: int) -> Combine:
    """Squared deviations of two parts together: within each, and of their means from the common one."""

    def combine(old, new) -> Column:
        n, m = old(f"_n{i}"), new(f"_n{i}")
        apart = F.pow(old(f"_sum{i}") / n - new(f"_sum{i}") / m, 2) * (n * m) / (n + m)
        return F.when(n == 0, new(f"_dev{i}")).when(m == 0, old(f"_dev{i}")).otherwise(old(f"_dev{i}") + new(f"_dev{i}") + apart)

    return combine


def state_sums(monitor: Monitor) -> dict[str, Combine]:
    """How the columns of two numeric states of one group add up."""

    def plus(c: str) -> Combine:
        return lambda old, new: F.coalesce(old(c) + new(c), old(c), new(c))

    out: dict[str, Combine] = {"_rows": plus("_rows")}
    for i, _ in enumerate(monitor.numeric):
        out |= {f"_n{i}": plus(f"_n{i}"), f"_sum{i}": plus(f"_sum{i}"), f"_dev{i}": added_deviations(i)}
        out[f"_min{i}"] = lambda old, new, c=f"_min{i}": F.least(old(c), new(c))
        out[f"_max{i}"] = lambda old, new, c=f"_max{i}": F.greatest(old(c), new(c))
    return out


def profile_numeric(df: DataFrame, monitor: Monitor) -> DataFrame:
    """Count, nulls, mean, standard deviation (population), min and max per numeric column."""
    return numeric_profile(numeric_state(df, monitor), monitor)


def numeric_profile(state: DataFrame, monitor: Monitor) -> DataFrame:
    """The profile of a numeric state, which may hold a group in several parts.

    Deviations of merged parts are those within the parts plus those of their means from the
    total mean, which a window over the small table brings beside each part; taken as a
    difference of large squares they would lose all digits where the mean is large.
    """
    wide = expand(state, monitor)
    group = Window.partitionBy(*GROUP)

    def mean(i: int, over: Window | None = None) -> Column:
        total, n = F.sum(f"_sum{i}"), F.sum(f"_n{i}")
        return total.over(over) / F.nullif(n.over(over), F.lit(0)) if over is not None else total / F.nullif(n, F.lit(0))

    wide = wide.withColumns({f"_mean{i}": mean(i, group) for i, _ in enumerate(monitor.numeric)})

    def square(i: int) -> Column:
        own = F.col(f"_sum{i}") / F.nullif(F.col(f"_n{i}"), F.lit(0))
        return F.sum(F.col(f"_dev{i}") + F.col(f"_n{i}") * F.pow(own - F.col(f"_mean{i}"), 2))

    merged = wide.groupBy(*GROUP).agg(
        F.sum("_rows").alias("_rows"),
        *[
            a
            for i, _ in enumerate(monitor.numeric)
            for a in (
                F.sum(f"_n{i}").alias(f"_n{i}"),
                mean(i).alias(f"_avg{i}"),
                square(i).alias(f"_sq{i}"),
                F.min(f"_min{i}").alias(f"_min{i}"),
                F.max(f"_max{i}").alias(f"_max{i}"),
            )
        ],
    )

    def stats(i: int, name: str) -> Column:
        n = F.col(f"_n{i}")
        return F.struct(
            F.lit(name).alias("column_name"),
            F.col("_rows").alias("count"),
            (F.col("_rows") - n).alias("num_nulls"),
            (F.lit(100.0) * (F.col("_rows") - n) / F.col("_rows")).alias("percent_null"),
            F.col(f"_avg{i}").alias("avg"),
            F.when(n > 0, F.sqrt(F.col(f"_sq{i}") / F.nullif(n, F.lit(0)))).alias("stddev"),
            F.col(f"_min{i}").alias("min"),
            F.col(f"_max{i}").alias("max"),
        )

    rows = [stats(i, c) for i, c in enumerate(monitor.numeric)]
    return publish(merged.select(*GROUP, F.inline(F.array(*rows))))


def distinct_profile(state: DataFrame, monitor: Monitor) -> DataFrame:
    """Estimated distinct values per numeric column, of sketches that may hold a group in several parts."""
    wide = expand(state, monitor).groupBy(*GROUP)
    merged = wide.agg(*[F.hll_union_agg(f"_hll{i}").alias(f"_hll{i}") for i, _ in enumerate(monitor.numeric)])
    rows = [
        F.struct(F.lit(c).alias("column_name"), F.hll_sketch_estimate(f"_hll{i}").alias("distinct_estimate"))
        for i, c in enumerate(monitor.numeric)
    ]
    return publish(merged.select(*GROUP, F.inline(F.array(*rows))))


def value_state(df: DataFrame, monitor: Monitor, columns: Sequence[str]) -> DataFrame:
    """Rows per window, model, slice values, column and value, nulls included; parts of a log add up."""
    pairs = [F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in columns]
    rows = with_grain(df, monitor).select(*monitor.grain, F.inline(F.array(*pairs)))
    return rows.groupBy(*monitor.grain, "column_name", "value").agg(F.count(F.lit(1)).alias("n"))


def value_counts(df: DataFrame, monitor: Monitor, columns: Sequence[str]) -> DataFrame:
    """Rows per window, model, slice, column and value, nulls included; slice markers internal."""
    return _summed(value_state(df, monitor, columns), monitor)


def _summed(state: DataFrame, monitor: Monitor) -> DataFrame:
    return expand(state, monitor).groupBy(*GROUP, "column_name", "value").agg(F.sum("n").alias("n"))


def profile_categorical(df: DataFrame, monitor: Monitor) -> DataFrame:
    """Count, nulls, distinct values and the most frequent value (smallest on ties) per column."""
    return categorical_profile(value_state(df, monitor, monitor.categorical), monitor)


def categorical_profile(state: DataFrame, monitor: Monitor) -> DataFrame:
    """The categorical profile of counted values, which may hold a group in several parts."""
    counts = _summed(state, monitor)
    n, value = F.col("n"), F.col("value")
    best = F.when(value.isNotNull(), F.struct((-n).alias("m"), value.alias("v")))
    out = counts.groupBy(*GROUP, "column_name").agg(
        F.sum(n).alias("count"),
        F.sum(F.when(value.isNull(), n).otherwise(F.lit(0))).alias("num_nulls"),
        F.count(value).alias("distinct_count"),
        F.min(best).alias("_best"),
    )
    out = out.withColumn("percent_null", F.lit(100.0) * F.col("num_nulls") / F.col("count"))
    return publish(
        out.select(*GROUP, "column_name", "count", "num_nulls", "percent_null", "distinct_count",
                   F.col("_best.v").alias("most_frequent"))
    )


def profile_deltas(profile: DataFrame, metrics: Sequence[str] = ("percent_null", "avg")) -> DataFrame:
    """Change of each metric from the previous window of the same model, slice and column."""
    line = Window.partitionBy("model_version", "slice_key", "slice_value", "column_name").orderBy("window_start")
    deltas = {f"{m}_delta": F.col(m) - F.lag(m).over(line) for m in metrics}
    return profile.withColumns(deltas)


def fill_template(template: str, monitor: Monitor) -> str:
    text = template
    for mark, column in (("prediction_col", monitor.prediction_col), ("label_col", monitor.label_col)):
        if "{{" + mark + "}}" in text and column is None:
            raise ValueError(f"metric template needs {mark}")
        text = text.replace("{{" + mark + "}}", f"`{column}`")
    return text


def custom_metrics(df: DataFrame, monitor: Monitor) -> DataFrame:
    """User-defined aggregates per window, model and slice.

    Such aggregates cannot be merged from a finer grain, so grouping sets do the
    slices; partial aggregation still keeps the shuffle at the size of the result.
    """
    marked = with_grain(df, monitor)
    slices = [f"_slice{i}" for i in range(len(monitor.slices))]
    models = [["_model"], []] if monitor.model_col is not None else [[]]
    sets = [["window_start", "window_end", *m, *s] for m in models for s in [[], *[[x] for x in slices]]]
    metrics = [F.expr(fill_template(t, monitor)).alias(name) for name, t in monitor.custom.items()]
    out = marked.groupingSets([[F.col(c) for c in s] for s in sets], *[F.col(c) for c in monitor.grain]).agg(
        *metrics,
        *[F.grouping(c).alias(f"_g{c}") for c in ["_model", *slices]],
    )
    key, value = F.lit(""), F.lit("")
    for name, text in zip(slices, monitor.slices):
        used = F.col(f"_g{name}") == 0
        key, value = F.when(used, F.lit(text)).otherwise(key), F.when(used, F.col(name)).otherwise(value)
    model = F.when(F.col("_g_model") == 0, F.col("_model")).otherwise(F.lit(ALL_MODELS))
    out = out.select(
        "window_start", "window_end", model.alias("model_version"), key.alias("slice_key"),
        value.alias("slice_value"), *monitor.custom,
    )
    return out.filter(F.col("slice_value").isNotNull() & F.col("model_version").isNotNull())


def quality_by_group(df: DataFrame, monitor: Monitor) -> DataFrame:
    """Classification quality per window, model and slice over labelled rows; slice markers internal."""
    return quality_profile(confusion_state(df, monitor), monitor)


def confusion_state(df: DataFrame, monitor: Monitor) -> DataFrame:
    """Confusion counts per window, model and slice values; parts of a log add up."""
    return classify.confusion_counts(with_grain(df, monitor), monitor.label_col, monitor.prediction_col, by=monitor.grain)


def quality_profile(counts: DataFrame, monitor: Monitor) -> DataFrame:
    """Classification quality of a confusion state, which may hold a group in several parts; slice markers internal."""
    merged = expand(counts, monitor).groupBy(*GROUP, "label", "prediction").agg(F.sum("n").alias("n"))
    return classify.quality_metrics(merged, by=GROUP)


def performance_profile(df: DataFrame, monitor: Monitor) -> DataFrame:
    """Table-level metrics: rows under ``column_name = ':table'`` and ``log_type = 'INPUT'``."""
    out = quality_by_group(df, monitor)
    if monitor.custom:
        out = custom_metrics(df, monitor).join(out, GROUP, "left")
    return publish(out).withColumns({"column_name": F.lit(":table"), "log_type": F.lit("INPUT")})


def inference_table(predictions: DataFrame, labels: DataFrame, keys: Sequence[str], drop: Sequence[str] = ("split",)) -> DataFrame:
    """Predictions with labels where known, without the split.

    Order is a property of how the table is written, so sort within partitions on write
    rather than here.
    """
    return predictions.join(labels, list(keys), "left").drop(*drop)


def baseline_table(
    predictions: DataFrame, labels: DataFrame, keys: Sequence[str], drop: Sequence[str], split: str = "test"
) -> DataFrame:
    """Predictions of the held-out rows, without keys and times: the reference for drift.

    Filtering the labels first makes the left join an inner one, which shuffles less.
    """
    held_out = labels.filter(F.col("split") == split)
    return predictions.join(held_out, list(keys), "inner").drop(*drop)
