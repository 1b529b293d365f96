"""The churn use case: column rules, expectations and the three end-to-end jobs."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import (
    AVG_PRICE_INCREASE,
    CleaningRules,
    FeatureFunction,
    add_snapshot,
    clean,
    count_flags,
)
from tidemark.operators import drift, profile, quality, splits
from tidemark.operators.lookup import FeatureLookup, training_set
from tidemark.operators.profile import Monitor
from tidemark.operators.quality import ColumnRule, Expectation
from tidemark.sources.tables import FeatureStore

KEY, TIME, LABEL = "customer_id", "transaction_ts", "churn"

# Columns, codes and limits of the churn tables.
OPTIONAL_SERVICES = [
    "online_security",
    "online_backup",
    "device_protection",
    "tech_support",
    "streaming_tv",
    "streaming_movies",
]
YES_NO = ["Yes", "No"]
CONTRACTS = ["Month-to-month", "One year", "Two year"]

CLEANING = CleaningRules(
    recodes={"senior_citizen": {"1": "Yes", "0": "No"}},
    numbers=["total_charges"],
    fills={"tenure": 0.0, "monthly_charges": 0.0, "total_charges": 0.0},
)

# Names, conditions and actions of the row rules.
BRONZE_EXPECTATIONS = [
    Expectation("customer_id_not_null", "customer_id IS NOT NULL", "drop"),
    Expectation("monthly_charges_non_negative", "monthly_charges >= 0 OR monthly_charges IS NULL"),
    Expectation("total_charges_non_negative", "try_cast(total_charges AS DOUBLE) >= 0 OR try_cast(total_charges AS DOUBLE) IS NULL"),
    Expectation("valid_churn_label", "churn IN ('Yes', 'No') OR churn IS NULL"),
    Expectation("valid_contract_type", "contract IN ('Month-to-month', 'One year', 'Two year') OR contract IS NULL"),
]
FEATURE_EXPECTATIONS = [
    Expectation("customer_id_not_null", "customer_id IS NOT NULL", "drop"),
    Expectation("transaction_ts_not_null", "transaction_ts IS NOT NULL", "drop"),
    Expectation("num_optional_services_range", "num_optional_services BETWEEN 0 AND 6"),
    Expectation("tenure_non_negative", "tenure >= 0 OR tenure IS NULL"),
    Expectation("monthly_charges_non_negative", "monthly_charges >= 0 OR monthly_charges IS NULL"),
]
LABEL_EXPECTATIONS = [
    Expectation("customer_id_not_null", "customer_id IS NOT NULL", "drop"),
    Expectation("transaction_ts_not_null", "transaction_ts IS NOT NULL", "drop"),
    Expectation("valid_split", "split IN ('train', 'test')", "drop"),
    Expectation("label_not_null", "churn IN ('Yes', 'No') OR churn IS NULL"),
]

# Declared schemas of the raw, feature and label tables.
BRONZE_RULES = [
    ColumnRule("customer_id", nullable=False, min_length=1),
    ColumnRule("gender", allowed=["Male", "Female"]),
    ColumnRule("senior_citizen", type=None, allowed=[0, 1, "0", "1", "Yes", "No"]),
    *[ColumnRule(c, allowed=YES_NO) for c in ("partner", "dependents", "phone_service", "paperless_billing", "churn")],
    ColumnRule("tenure", type=None, at_least=0),
    ColumnRule("multiple_lines"),
    ColumnRule("internet_service", allowed=["Fiber optic", "DSL", "No"]),
    *[ColumnRule(c) for c in OPTIONAL_SERVICES],
    ColumnRule("contract", allowed=CONTRACTS),
    ColumnRule("payment_method"),
    ColumnRule("monthly_charges", type=None, at_least=0),
    ColumnRule("total_charges", type=None),
]
FEATURE_RULES = [
    ColumnRule(KEY, nullable=False),
    ColumnRule(TIME, type="timestamp", nullable=False),
    ColumnRule("senior_citizen", allowed=YES_NO),
    *[ColumnRule(c) for c in ("gender", "partner", "dependents", "phone_service", "multiple_lines")],
    *[ColumnRule(c) for c in ("internet_service", *OPTIONAL_SERVICES, "contract", "paperless_billing")],
    ColumnRule("payment_method"),
    *[ColumnRule(c, type="double", at_least=0) for c in ("tenure", "monthly_charges", "total_charges")],
    ColumnRule("num_optional_services", type="double", at_least=0, at_most=6),
]
LABEL_RULES = [
    ColumnRule(KEY, nullable=False),
    ColumnRule(TIME, type="timestamp", nullable=False),
    ColumnRule(LABEL, allowed=YES_NO),
    ColumnRule("split", nullable=False, allowed=["train", "test"]),
]

PRICE_INCREASE = FeatureFunction(
    AVG_PRICE_INCREASE,
    {"monthly_charges_in": "monthly_charges", "tenure_in": "tenure", "total_charges_in": "total_charges"},
    "avg_price_increase",
)


def add_service_count(df: DataFrame) -> DataFrame:
    return df.withColumn("num_optional_services", count_flags(OPTIONAL_SERVICES))


def build_features(raw: DataFrame, at: dt.datetime | None = None, wall_clock: bool = False) -> DataFrame:
    """Service count, cleaning and snapshot time: two projections, batch or streaming."""
    return add_snapshot(clean(add_service_count(raw), CLEANING), at, TIME, wall_clock)


def bronze_validated(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    return quality.expect(raw, BRONZE_EXPECTATIONS)


def silver_features(
    validated: DataFrame, at: dt.datetime | None = None, wall_clock: bool = False
) -> tuple[DataFrame, DataFrame]:
    """(feature table without the label, expectation metrics)."""
    return quality.expect(build_features(validated, at, wall_clock).drop(LABEL), FEATURE_EXPECTATIONS)


def silver_labels(
    features: DataFrame, validated: DataFrame, ratio: float = 0.8, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """(label table, expectation metrics): every feature key, label null where the raw table has none."""
    labels = splits.attach_labels(features, validated, KEY, TIME, LABEL, ratio, seed)
    return quality.expect(labels, LABEL_EXPECTATIONS)


def feature_checks(features: DataFrame) -> list[quality.Check]:
    return [
        quality.no_nulls(KEY),
        quality.no_nulls(TIME),
        quality.unique(KEY, TIME),
        quality.in_range("num_optional_services", 0, 6),
        quality.sql_check("tenure_non_negative", "tenure >= 0"),
    ]


def churn_lookups(features: DataFrame | str) -> list[FeatureLookup | FeatureFunction]:
    """Point-in-time features plus the on-demand price increase."""
    return [FeatureLookup(features, [KEY], time_key=TIME), PRICE_INCREASE]


def churn_training_set(labels: DataFrame, features: DataFrame | str, exclude: Sequence[str] = (KEY, TIME)) -> DataFrame:
    """Latest label per customer with its features at that time."""
    latest = splits.latest_label(labels, [KEY], TIME, LABEL)
    return training_set(latest, churn_lookups(features), LABEL, exclude)


@dataclass(frozen=True)
class FeatureTables:
    features: DataFrame
    labels: DataFrame
    checks: DataFrame


def feature_job(
    raw: DataFrame, at: dt.datetime | None = None, strategy: str = "hash", ratio: float = 0.8, seed: int = 42
) -> FeatureTables:
    """Raw table to feature table, label table and check results."""
    built = build_features(raw.filter(F.col(KEY).isNotNull()), at)
    features, labels = splits.separate_labels(built, [KEY], TIME, LABEL, ratio, seed, strategy)
    checks = [*feature_checks(built), quality.allowed_values(LABEL, YES_NO)]
    return FeatureTables(features, labels, quality.run_checks(built, checks))


def publish_features(
    store: FeatureStore, made: FeatureTables, feature_table: str = "churn_features", label_table: str = "churn_labels"
) -> None:
    """Write both tables with their keys, unless a check on the built features failed."""
    failed = made.checks.filter(~F.col("passed")).collect()
    if failed:
        raise ValueError("feature checks failed: " + "; ".join(f"{r['name']}: {r['message']}" for r in failed))
    for name, rows in ((label_table, made.labels), (feature_table, made.features)):
        store.reset_and_write(name, rows, [KEY, TIME], time_key=TIME, tags={"quality": "silver"})


CHURN_MONITOR = Monitor(
    time_col="inference_timestamp",
    model_col="model_version",
    prediction_col="prediction",
    label_col=LABEL,
    numeric=["monthly_charges", "tenure"],
    categorical=["prediction", LABEL, "contract"],
    slices=["contract", "monthly_charges > 30"],
    custom={
        "expected_loss": "avg(CASE WHEN {{prediction_col}} != {{label_col}} AND {{label_col}} = 'Yes'"
        " THEN -monthly_charges ELSE 0 END)"
    },
)


def monitoring_job(
    log: DataFrame, model: str = profile.ALL_MODELS, monitor: Monitor = CHURN_MONITOR,
    metric: str = "f1_macro", distance: str = "js_distance", limits: drift.Limits = drift.Limits(),
) -> DataFrame:
    """Inference log to the number of violations, in one plan."""
    watched = [monitor.prediction_col, monitor.label_col]
    performance = profile.performance_profile(log, monitor)
    moved = drift.consecutive_drift(drift.distribution(log, monitor, watched))
    joined = drift.all_metrics(
        drift.performance_series(performance, metric, model),
        drift.drift_series(moved, distance, watched, model),
        watched,
    )
    return drift.violations(joined, watched, limits)
