"""Binding of operators to the shared test tables, with the SQL that must give the same rows.

A query is a function of (session, table folder). Inputs that a scenario needs in
another shape are described once, as SQL expressions both engines understand.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under ``name``, with its SQL where SQL can express it."""

    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def select_sql(columns: Sequence[str], source: str) -> str:
    return f"SELECT {', '.join(columns)} FROM {source}"


def sql_bucket(keys: Sequence[str], seed: int | str, buckets: int = 10_000) -> str:
    """The hash bucket of ``tidemark.functions.hashing`` in DuckDB's words."""
    parts = ", ".join(f"CAST({k} AS VARCHAR)" for k in keys)
    return f"(CAST('0x' || substr(md5(concat_ws(':', '{seed}', {parts})), 1, 8) AS BIGINT) % {buckets})"


# The customer table in the shape of the raw churn table.
BRONZE_COLUMNS = [
    "CASE WHEN c_nationkey = 13 THEN NULL ELSE concat('C', CAST(c_custkey AS STRING)) END AS customer_id",
    "CASE WHEN c_nationkey < 12 THEN 'Male' ELSE 'Female' END AS gender",
    "CASE WHEN c_acctbal > 8000 THEN 1 ELSE 0 END AS senior_citizen",
    "CASE WHEN c_mktsegment IN ('BUILDING', 'FURNITURE') THEN 'Yes' ELSE 'No' END AS partner",
    "CASE WHEN c_nationkey > 17 THEN 'Yes' WHEN c_nationkey = 2 THEN NULL ELSE 'No' END AS dependents",
    "CASE WHEN c_mktsegment = 'MACHINERY' THEN NULL ELSE CAST(c_nationkey * 3 AS DOUBLE) END AS tenure",
    "CASE WHEN c_acctbal < -500 THEN 'No' ELSE 'Yes' END AS phone_service",
    "CASE WHEN c_acctbal < -500 THEN 'No phone service' WHEN c_nationkey < 9 THEN 'Yes' ELSE 'No' END"
    " AS multiple_lines",
    "CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN 'No' WHEN c_nationkey < 10 THEN 'DSL' ELSE 'Fiber optic' END"
    " AS internet_service",
    "CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN 'No internet service' WHEN c_acctbal > 1000 THEN 'Yes' ELSE 'No' END"
    " AS online_security",
    "CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN 'No internet service' WHEN c_acctbal > 2500 THEN 'Yes' ELSE 'No' END"
    " AS online_backup",
    "CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN 'No internet service' WHEN c_nationkey > 5 THEN 'Yes' ELSE 'No' END"
    " AS device_protection",
    "CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN 'No internet service' WHEN c_nationkey > 14 THEN 'Yes' ELSE 'No' END"
    " AS tech_support",
    "CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN 'No internet service' WHEN c_acctbal > 7000 THEN 'Yes' ELSE 'No' END"
    " AS streaming_tv",
    "CASE WHEN c_nationkey = 21 THEN NULL WHEN c_acctbal > 4000 THEN 'Yes' ELSE 'No' END AS streaming_movies",
    "CASE WHEN c_nationkey < 8 THEN 'Month-to-month' WHEN c_nationkey < 16 THEN 'One year'"
    " WHEN c_nationkey < 24 THEN 'Two year' ELSE 'Weekly' END AS contract",
    "CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 'Yes' ELSE 'No' END AS paperless_billing",
    "CASE WHEN c_nationkey < 6 THEN 'Mailed check' WHEN c_nationkey < 18 THEN 'Electronic check'"
    " ELSE 'Bank transfer (automatic)' END AS payment_method",
    "CASE WHEN c_nationkey = 7 THEN NULL ELSE c_acctbal / 100 END AS monthly_charges",
    "CASE WHEN c_acctbal < 0 THEN ' ' ELSE CAST(c_acctbal AS STRING) END AS total_charges",
    "CASE WHEN c_nationkey = 3 THEN NULL WHEN c_acctbal < 2000 AND c_mktsegment <> 'BUILDING' THEN 'Yes'"
    " ELSE 'No' END AS churn",
]
BRONZE_SQL = select_sql(BRONZE_COLUMNS, "customer")


def bronze(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "customer").selectExpr(*BRONZE_COLUMNS)


# Events in the shape of an inference log with late and missing labels.
LOG_COLUMNS = [
    "event_id",
    "user_id",
    "ts AS inference_timestamp",
    "CASE WHEN event_type = 'error' THEN NULL ELSE value END AS monthly_charges",
    "CAST(length(props) AS DOUBLE) AS tenure",
    "event_type AS contract",
    "CASE WHEN value > 50 THEN 'Yes' ELSE 'No' END AS prediction",
    "CASE WHEN event_type IN ('purchase', 'signup') THEN 'Yes' WHEN event_type = 'error' THEN NULL ELSE 'No' END"
    " AS churn",
    "CASE WHEN user_id % 2 = 0 THEN '1' ELSE '2' END AS model_version",
]
LOG_SQL = select_sql(LOG_COLUMNS, "events")


def inference_log(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").selectExpr(*LOG_COLUMNS)


# Orders in the shape of the tracking tables: one run and one model version per order.
RUN_COLUMNS = [
    "concat('run-', CAST(o_orderkey AS STRING)) AS run_id",
    "o_orderpriority AS experiment",
    "o_orderstatus AS run_name",
    "o_orderdate AS start_time",
    "'test_f1_score' AS metric",
    "o_totalprice / 500000 AS value",
]
VERSION_COLUMNS = [
    "concat('model-', CAST(o_custkey AS STRING)) AS model",
    "o_orderkey AS version",
    "concat('run-', CAST(o_orderkey AS STRING)) AS run_id",
    "CASE WHEN o_orderstatus = 'P' THEN NULL ELSE concat(o_orderpriority, ' / ', o_orderstatus, ' run') END"
    " AS description",
    "o_orderdate AS created",
]
ALIAS_COLUMNS = [
    "concat('model-', CAST(o_custkey AS STRING)) AS model",
    "CASE WHEN o_orderstatus = 'F' THEN 'Champion' ELSE 'Challenger' END AS alias",
    "o_orderkey AS version",
    "o_orderdate AS assigned_at",
]
TAG_COLUMNS = [
    "concat('model-', CAST(o_custkey AS STRING)) AS model",
    "CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END AS version",
    "o_orderpriority AS key",
    "CAST(o_orderkey AS STRING) AS value",
    "o_orderdate AS set_at",
]


def orders_as(spark: SparkSession, folder: str, columns: Sequence[str]) -> DataFrame:
    return table(spark, folder, "orders").selectExpr(*columns)


def orders_sql(columns: Sequence[str]) -> str:
    return select_sql(columns, "orders")
