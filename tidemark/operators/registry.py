"""Runs, model versions, tags and aliases as append-only tables, and promotion gates on them.

Nothing is updated in place: the newest row wins, so concurrent writers only append.

runs     run_id, experiment, run_name, start_time, metric, value
versions model, version, run_id, description, created
tags     model, version, key, value, set_at
aliases  model, alias, version, assigned_at
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def log_run(
    spark, run_id: str, experiment: str, run_name: str, start_time: dt.datetime, metrics: Mapping[str, float]
) -> DataFrame:
    """Rows to append to ``runs``, one per metric."""
    rows = [(run_id, experiment, run_name, start_time, k, float(v)) for k, v in metrics.items()]
    return spark.createDataFrame(
        rows, "run_id string, experiment string, run_name string, start_time timestamp, metric string, value double"
    )


def log_metrics(metrics: DataFrame, run_id: str, experiment: str, run_name: str, start_time: dt.datetime) -> DataFrame:
    """The same from an evaluation table ``(metric, value)``."""
    return metrics.select(
        F.lit(run_id).alias("run_id"),
        F.lit(experiment).alias("experiment"),
        F.lit(run_name).alias("run_name"),
        F.lit(start_time).alias("start_time"),
        "metric",
        "value",
    )


def best_run(runs: DataFrame, experiment: str, metric: str) -> DataFrame:
    """The run with the largest value of a metric; run id settles ties."""
    rows = runs.filter((F.col("experiment") == experiment) & (F.col("metric") == metric))
    return rows.orderBy(F.desc_nulls_last("value"), "run_id").limit(1)


def latest_run(runs: DataFrame, experiment: str, run_name: str) -> DataFrame:
    """The newest run of a name."""
    rows = runs.filter((F.col("experiment") == experiment) & (F.col("run_name") == run_name))
    newest = rows.select("run_id", "experiment", "run_name", "start_time").distinct()
    return newest.orderBy(F.desc_nulls_last("start_time"), "run_id").limit(1)


def next_versions(versions: DataFrame, new: DataFrame) -> DataFrame:
    """Rows of ``new`` (one per model) with the next free version of their model."""
    top = versions.groupBy("model").agg(F.max("version").alias("_top"))
    joined = new.join(top, "model", "left")
    return joined.withColumn("version", F.coalesce("_top", F.lit(0)) + F.lit(1)).drop("_top")


def _newest(rows: DataFrame, keys: Sequence[str], time: str, value: str) -> DataFrame:
    """The value at the newest time per key, the larger one on ties; null times are older than all others.

    Two aggregates over plain columns, which are hashed; the largest struct of both would sort all rows.
    """
    largest = rows.groupBy(*keys, time).agg(F.max(value).alias(value))
    newest = F.when(F.max(time).isNotNull(), F.max_by(value, time)).otherwise(F.max(value))
    return largest.groupBy(*keys).agg(newest.alias(value))


def resolve_aliases(aliases: DataFrame) -> DataFrame:
    """Version behind each alias: the newest assignment, larger version on ties."""
    return _newest(aliases, ["model", "alias"], "assigned_at", "version")


def assign_alias(spark, model: str, alias: str, version: int, at: dt.datetime) -> DataFrame:
    """Row to append to ``aliases``."""
    return spark.createDataFrame(
        [(model, alias, int(version), at)], "model string, alias string, version long, assigned_at timestamp"
    )


def set_tags(spark, model: str, version: int, values: Mapping[str, object], at: dt.datetime) -> DataFrame:
    """Rows to append to ``tags``; values become text."""
    rows = [(model, int(version), k, str(v), at) for k, v in values.items()]
    return spark.createDataFrame(rows, "model string, version long, key string, value string, set_at timestamp")


def current_tags(tags: DataFrame) -> DataFrame:
    """Latest value per model version and key."""
    newest = tags.groupBy("model", "version", "key").agg(F.max(F.struct("set_at", "value")).alias("_t"))
    return newest.select("model", "version", "key", F.col("_t.value").alias("value"))


def version_metric(versions: DataFrame, runs: DataFrame, metric: str) -> DataFrame:
    """Model versions with a metric of the run behind them, null when it was not logged.

    A run may log a metric again: the newest value counts, the larger one on ties.
    """
    values = _newest(runs.filter(F.col("metric") == metric), ["run_id"], "start_time", "value")
    return versions.join(values.withColumnRenamed("value", "metric_value"), "run_id", "left")


def _gate(name: str, passed, message) -> Column:
    return F.struct(F.lit(name).alias("check"), passed.alias("passed"), message.alias("message"))


def gate_checks(
    versions: DataFrame,
    runs: DataFrame,
    aliases: DataFrame,
    metric: str,
    min_value: float = 0.0,
    min_chars: int = 20,
    champion: str = "Champion",
    accept_if_no_champion: bool = True,
) -> DataFrame:
    """Promotion gates for every model version: ``model, version, check, passed, message``.

    has_description, metric_<name>_passed and champion_challenger_passed. A metric that
    was not logged fails its gates.
    """
    scored = version_metric(versions, runs, metric)
    holder = resolve_aliases(aliases.filter(F.col("alias") == champion)).select("model", "version")
    bar = scored.join(holder, ["model", "version"], "left_semi").select("model", F.col("metric_value").alias("_bar"))
    rows = scored.join(bar, "model", "left")
    size, value, top = F.length(F.coalesce("description", F.lit(""))), F.col("metric_value"), F.col("_bar")

    def number(c) -> Column:
        return F.format_string("%.4f", c)

    enough = size >= min_chars
    text = F.format_string(f"%d characters of description, {min_chars} needed", size)
    missing = F.lit(f"the run behind this version has no value of {metric}")
    against = F.when(value.isNull(), missing)
    alone = F.lit(f"nothing holds the alias {champion}: " + ("passes unopposed" if accept_if_no_champion else "refused"))
    duel = F.concat(F.lit(f"{metric} "), number(value), F.lit(f", {champion} has "), number(top))
    gates = F.array(
        _gate("has_description", enough, text),
        _gate(
            f"metric_{metric}_passed",
            F.coalesce(value >= min_value, F.lit(False)),
            F.when(value.isNull(), missing).otherwise(
                F.concat(F.lit(f"{metric} "), number(value), F.lit(f", at least {min_value} needed"))
            ),
        ),
        _gate(
            "champion_challenger_passed",
            F.coalesce(F.when(value.isNull(), False).when(top.isNull(), accept_if_no_champion).otherwise(value >= top), F.lit(False)),
            against.when(top.isNull(), alone).otherwise(duel),
        ),
    )
    return rows.select("model", "version", F.inline(gates))


def value_gate(values: DataFrame, challenger: str = "Challenger", champion: str = "Champion") -> DataFrame:
    """Gate on business value: rows ``model, alias, value`` to one result per model.

    Without a champion the challenger passes; without a challenger value (no scored rows) it fails.
    """
    wide = values.groupBy("model").pivot("alias", [challenger, champion]).agg(F.first("value"))
    passed = F.when(F.col(challenger).isNull(), False).otherwise(
        F.coalesce(F.col(challenger) >= F.col(champion), F.lit(True))
    )
    return wide.select("model", F.lit("business_metric_passed").alias("check"), passed.alias("passed"))


def gate_summary(gates: DataFrame) -> DataFrame:
    """Overall result per model version, with the approval tag."""
    overall = gates.groupBy("model", "version").agg(
        F.bool_and("passed").alias("all_passed"),
        F.count_if(~F.col("passed")).alias("failed_checks"),
    )
    return overall.withColumn("Approval_Check", F.when(F.col("all_passed"), "Approved").otherwise("Failed"))


def gate_tags(gates: DataFrame, at: dt.datetime) -> DataFrame:
    """Tag rows for the gate results: each check as True/False, and the approval."""
    each = gates.select(
        "model", "version", F.col("check").alias("key"), F.initcap(F.col("passed").cast("string")).alias("value")
    )
    whole = gate_summary(gates).select(
        "model", "version", F.lit("Approval_Check").alias("key"), F.col("Approval_Check").alias("value")
    )
    return each.unionByName(whole).withColumn("set_at", F.lit(at))


def promotions(tags: DataFrame, at: dt.datetime, alias: str = "Champion", tag: str = "Approval_Check") -> DataFrame:
    """Alias rows for the newest approved version of each model.

    The tag must exist and read "approved" in any case.
    """
    approved = current_tags(tags).filter((F.col("key") == tag) & (F.lower("value") == "approved"))
    newest = approved.groupBy("model").agg(F.max("version").alias("version"))
    return newest.select("model", F.lit(alias).alias("alias"), "version", F.lit(at).alias("assigned_at"))


def require_approval(tags: DataFrame, model: str, version: int, tag: str = "Approval_Check") -> None:
    """Raise unless this version carries the approval tag."""
    row = (
        current_tags(tags)
        .filter((F.col("model") == model) & (F.col("version") == version) & (F.col("key") == tag))
        .first()
    )
    if row is None:
        raise ValueError(f"{model} version {version} has no tag {tag!r}")
    if row["value"].lower() != "approved":
        raise ValueError(f"{model} version {version} is not approved")


def checks_table(rows: Sequence[tuple], spark) -> DataFrame:
    """Gate rows from driver-side checks such as ``can_score``."""
    return spark.createDataFrame(rows, "model string, version long, check string, passed boolean, message string")
