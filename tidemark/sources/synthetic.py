"""Synthetic inference logs over the keys of a real table.

Every value is a hash of (seed, column, key, step), so a log can be produced in
parallel, again and in part, and always comes out the same.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GRAIN = 1_000_000
#: Tasks a core that a log is made by: a small file of keys, read by one task, makes many rows.
TASKS = 4


def unit_draw(seed: int, name: str, *by: str) -> Column:
    """Even draw from 0 (included) to 1 (excluded), fixed by seed, name and the ``by`` columns."""
    mixed = F.xxhash64(F.lit(seed), F.lit(name), *[F.col(b) for b in by])
    return F.pmod(mixed, F.lit(GRAIN)) / F.lit(float(GRAIN))


@dataclass(frozen=True)
class Choice:
    """Weighted category; ``nulls`` is the share of missing values."""

    weights: Mapping[str, float]
    nulls: float = 0.0

    def column(self, seed: int, name: str, by: Sequence[str]) -> Column:
        draw, total, reached, out = unit_draw(seed, name, *by), sum(self.weights.values()), 0.0, None
        for value, weight in self.weights.items():
            reached += weight / total
            out = F.when(draw < reached, F.lit(value)) if out is None else out.when(draw < reached, F.lit(value))
        out = out.otherwise(F.lit(list(self.weights)[-1]))
        if self.nulls:
            out = F.when(unit_draw(seed, f"{name}?", *by) >= self.nulls, out)
        return out


@dataclass(frozen=True)
class Steps:
    """Even draw from ``low`` to ``high`` in steps."""

    low: float
    high: float
    step: float
    type: str = "double"

    def column(self, seed: int, name: str, by: Sequence[str]) -> Column:
        cells = int((self.high - self.low) / self.step + 1e-9) + 1
        value = F.lit(self.low) + F.floor(unit_draw(seed, name, *by) * cells) * F.lit(self.step)
        return value.cast(self.type)


# Ranges and weights of the synthetic churn inference log.
YES_NO_EVEN = {"No": 0.5, "Yes": 0.5}
STREAMING = {"No": 0.4, "Yes": 0.4, "No internet service": 0.2}
CHURN_LOG = {
    "gender": Choice({"Female": 0.5, "Male": 0.5}),
    "senior_citizen": Choice({"No": 0.85, "Yes": 0.15}),
    "partner": Choice(YES_NO_EVEN),
    "dependents": Choice({"No": 0.7, "Yes": 0.3}),
    "tenure": Steps(0.0, 72.0, 1.0),
    "phone_service": Choice({"No": 0.9, "Yes": 0.1}),
    "multiple_lines": Choice(YES_NO_EVEN),
    "internet_service": Choice({"Fiber optic": 0.5, "DSL": 0.3, "No": 0.2}),
    "online_security": Choice(YES_NO_EVEN),
    "online_backup": Choice(YES_NO_EVEN),
    "device_protection": Choice(YES_NO_EVEN),
    "tech_support": Choice(YES_NO_EVEN),
    "streaming_tv": Choice(STREAMING),
    "streaming_movies": Choice(STREAMING),
    "contract": Choice({"Month-to-month": 0.5, "One year": 0.25, "Two year": 0.25}),
    "paperless_billing": Choice({"No": 0.6, "Yes": 0.4}),
    "payment_method": Choice(
        {
            "Credit card (automatic)": 0.2,
            "Mailed check": 0.2,
            "Bank transfer (automatic)": 0.2,
            "Electronic check": 0.4,
        }
    ),
    "monthly_charges": Steps(18.0, 118.0, 0.5),
    "total_charges": Steps(0.0, 8684.0, 20.0),
    "num_optional_services": Steps(0.0, 6.0, 1.0),
    "avg_price_increase": Steps(-19.0, 130.0, 20.0, "float"),
    "churn": Choice({"No": 0.2, "Yes": 0.8}, nulls=0.8),
    "prediction": Choice({"No": 0.6, "Yes": 0.4}),
}


def synthetic_log(
    keys: DataFrame,
    key: str,
    columns: Mapping[str, Choice | Steps] = CHURN_LOG,
    start: dt.datetime = dt.datetime(2024, 1, 1),
    days: int = 30,
    seed: int = 42,
    model_name: str = "churn",
    model_version: str = "1",
) -> DataFrame:
    """One row per key and day of the back-fill, at a drawn hour of that day.

    ``customer_id`` follows the template dddd-AAAA.
    """
    spread = keys.select(F.col(key).alias("_key")).repartition(TASKS * keys.sparkSession.sparkContext.defaultParallelism)
    days_of = spread.withColumn("_day", F.explode(F.sequence(F.lit(0), F.lit(days - 1))))
    by = ["_key", "_day"]
    hours = F.col("_day") * 24 + F.floor(unit_draw(seed, "hour", *by) * 24).cast("int")
    moment = F.lit(start).cast("timestamp_ntz") + F.make_dt_interval(hours=hours)
    digits = F.lpad(F.floor(unit_draw(seed, "digits", "_key") * 10_000).cast("string"), 4, "0")
    letters = [F.char(F.floor(unit_draw(seed, f"letter{i}", "_key") * 26).cast("int") + 65) for i in range(4)]
    drawn = [spec.column(seed, name, by).alias(name) for name, spec in columns.items()]
    return days_of.withColumn("_at", moment).select(
        F.concat(digits, F.lit("-"), *letters).alias("customer_id"),
        F.col("_at").alias("transaction_ts"),
        *drawn,
        F.col("_at").alias("inference_timestamp"),
        F.lit(model_name).alias("model_name"),
        F.lit(model_version).alias("model_version"),
    )


def rows_beyond(log: DataFrame, other: DataFrame) -> int:
    """How many rows of ``log`` ``other`` doesn't hold, each as often as it comes; whole rows meet by their SHA-256."""

    def digests(df: DataFrame, times: int) -> DataFrame:
        # Nulls are left out of the text, and every value has its name there, so texts are equal only for equal rows.
        return df.select(F.unhex(F.sha2(F.to_json(F.struct(*df.columns)), 256)).alias("row"), F.lit(times).alias("times"))

    both = digests(log, 1).unionByName(digests(other, -1))
    more = both.groupBy("row").agg(F.sum("times").alias("times")).filter("times > 0")
    return more.agg(F.coalesce(F.sum("times"), F.lit(0))).first()[0]


def without_label(df: DataFrame, label: str) -> DataFrame:
    """Copy for scoring: the label column is dropped."""
    return df.drop(label)
