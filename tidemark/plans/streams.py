"""Queries that run as streams to completion and return what their sinks hold."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tidemark.operators import score
from tidemark.operators.profile import Monitor
from tidemark.plans import churn
from tidemark.plans.binding import BRONZE_COLUMNS, LOG_COLUMNS, LOG_SQL, query, table
from tidemark.plans.features import _FEATURES, SNAPSHOT, _snapshot
from tidemark.plans.monitoring import _GROUPS, _KEYS, _NUMERIC, _QUALITY, MONITOR, _categorical_sql, _flat, quality_sql
from tidemark.session import scratch_path
from tidemark.sources import tables
from tidemark.streaming import jobs, views


def _stream(spark, folder, name):
    schema = table(spark, folder, name).schema
    return jobs.file_stream(spark, folder, f"{name}.parquet", schema)


@query(
    "stream_upsert",
    """SELECT o_custkey, o_orderdate, o_orderkey, o_totalprice FROM orders
       QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""",
)
def stream_upsert(spark, folder):
    columns = ["o_custkey", "o_orderdate", "o_orderkey", "o_totalprice"]
    orders = _stream(spark, folder, "orders").select(*columns)
    name = f"tidemark_stream_{uuid.uuid4().hex[:12]}"
    tables.create_keyed_table(spark, name, orders.schema, ["o_custkey"])
    jobs.upsert_stream(orders, name, ["o_custkey"], "o_orderdate", scratch_path(spark, "cp")).awaitTermination()
    return spark.table(name)


@query("stream_features", f"SELECT * EXCLUDE (churn) FROM ({_FEATURES})")
def stream_features(spark, folder):
    raw = _stream(spark, folder, "customer").selectExpr(*BRONZE_COLUMNS)
    path = scratch_path(spark, "stream_features")

    def featurise(rows):
        return churn.build_features(rows, _snapshot(), wall_clock=True).drop(churn.LABEL)

    jobs.append_stream(raw, path, scratch_path(spark, "cp"), featurise).awaitTermination()
    return spark.read.parquet(path)


@query(
    "stream_score",
    f"""SELECT event_id, user_id, CASE WHEN value > 50 THEN 'Yes' ELSE 'No' END AS prediction, 'churn' AS model_name,
               '3' AS model_version, TIMESTAMP '{SNAPSHOT}' AS inference_timestamp FROM events""",
)
def stream_score(spark, folder):
    requests = _stream(spark, folder, "events").select("event_id", "user_id", "value")
    path = scratch_path(spark, "stream_score")

    def predict(rows):
        scored = rows.select("event_id", "user_id", F.when(F.col("value") > 50, "Yes").otherwise("No").alias("prediction"))
        at = F.expr(f"TIMESTAMP_NTZ '{SNAPSHOT}'")
        return score.stamp_predictions(scored, "churn", "3", at)

    jobs.append_stream(requests, path, scratch_path(spark, "cp"), predict).awaitTermination()
    return spark.read.parquet(path)


@query(
    "stream_daily",
    f"""WITH l AS (SELECT *, CAST(date_trunc('day', inference_timestamp) AS TIMESTAMP) AS window_start FROM ({LOG_SQL}))
        SELECT window_start, model_version, count(*) AS count, count(monthly_charges) AS monthly_charges_count,
               round(sum(monthly_charges), 6) AS monthly_charges_sum,
               CAST(count_if(churn IS NOT NULL) AS BIGINT) AS labelled,
               CAST(count_if(churn = prediction) AS BIGINT) AS correct
        FROM l GROUP BY window_start, model_version""",
)
def stream_daily(spark, folder):
    """Every day of the log, the newest ones included, which a closing watermark alone would not publish."""
    log = _stream(spark, folder, "events").selectExpr(*LOG_COLUMNS)
    monitor = Monitor(
        "inference_timestamp", model_col="model_version", prediction_col="prediction", label_col="churn",
        numeric=["monthly_charges"],
    )
    daily = jobs.daily_metrics(log, monitor)
    start = F.col("window.start").cast("timestamp_ntz").alias("window_start")
    daily = daily.select(start, *[c for c in daily.columns if c != "window"])
    name, keys = f"tidemark_daily_{uuid.uuid4().hex[:12]}", ["window_start", "model_version"]
    tables.create_keyed_table(spark, name, daily.schema, keys)
    jobs.upsert_aggregates(daily, name, keys, scratch_path(spark, "cp")).awaitTermination()
    return spark.table(name).withColumn("monthly_charges_sum", F.round("monthly_charges_sum", 6))


# Three states of a keyed table: rows come, go, change and come back.
_STATES = [
    ("o_orderkey % 3 <> 0", "o_totalprice"),
    ("o_orderkey % 5 <> 0", "CASE WHEN o_orderkey % 2 = 0 THEN 2 * o_totalprice ELSE o_totalprice END"),
    ("o_orderkey % 7 <> 0", "CASE WHEN o_orderkey % 3 = 0 THEN 3 * o_totalprice ELSE o_totalprice END"),
]


def _order_states(spark, folder):
    orders = table(spark, folder, "orders")
    return [orders.filter(keep).selectExpr("o_orderkey", "o_custkey", f"{price} AS price") for keep, price in _STATES]


@query("view_sync", f"SELECT o_orderkey, o_custkey, {_STATES[2][1]} AS price FROM orders WHERE {_STATES[2][0]}")
def view_sync(spark, folder):
    """A key-value view fed by the changes between three states, the first of them delivered again at the end."""
    states, run = _order_states(spark, folder), uuid.uuid4().hex[:12]
    source, view, log = f"tidemark_source_{run}", f"tidemark_view_{run}", scratch_path(spark, "changes")
    tables.create_keyed_table(spark, source, states[0].schema, ["o_orderkey"], buckets=8, rows=states[0])
    views.create_view(spark, view, source, buckets=8)
    checkpoint = scratch_path(spark, "cp")
    for state in states:
        if state is not states[0]:
            tables.publish_version(spark, source, state)
        views.publish_changes(spark, source, log)
        views.sync_view(views.change_stream(spark, source, log), view, checkpoint).awaitTermination()
    views.apply_changes(spark, view, spark.read.parquet(log).filter(F.col(views.STATE) == 1))
    return views.read_view(spark, view)


@query(
    "view_changes",
    f"""WITH a AS (SELECT o_orderkey, {_STATES[0][1]} AS price FROM orders WHERE {_STATES[0][0]}),
        b AS (SELECT o_orderkey, {_STATES[1][1]} AS price FROM orders WHERE {_STATES[1][0]})
        SELECT CASE WHEN a.o_orderkey IS NULL THEN 'insert' WHEN b.o_orderkey IS NULL THEN 'delete' ELSE 'update' END AS change,
               count(*) AS n, round(sum(coalesce(b.price, a.price)), 2) AS price
        FROM a FULL JOIN b USING (o_orderkey) WHERE a.price IS DISTINCT FROM b.price GROUP BY ALL""",
)
def view_changes(spark, folder):
    """What the log of a table holds of its second state."""
    states, run = _order_states(spark, folder), uuid.uuid4().hex[:12]
    source, log = f"tidemark_source_{run}", scratch_path(spark, "changes")
    tables.create_keyed_table(spark, source, states[0].schema, ["o_orderkey"], rows=states[0])
    views.publish_changes(spark, source, log)
    version = tables.publish_version(spark, source, states[1])
    views.publish_changes(spark, source, log)
    rows = spark.read.parquet(log).filter((F.col(views.STATE) == version) & (F.col(views.CHANGE) != "update_preimage"))
    change = F.regexp_replace(views.CHANGE, "_postimage", "").alias("change")
    return rows.groupBy(change).agg(F.count("*").alias("n"), F.round(F.sum("price"), 2).alias("price"))


@query(
    "merge_buckets",
    """SELECT c_custkey, CASE WHEN c_custkey % 50 = 1 THEN -1.0 ELSE c_acctbal END AS c_acctbal FROM customer
       UNION ALL SELECT -s_suppkey - 1, s_acctbal FROM supplier WHERE s_suppkey % 10 = 0""",
)
def merge_buckets(spark, folder):
    """Two merges into a table of 32 buckets, each of which rewrites only what it touches."""
    customers = table(spark, folder, "customer").select("c_custkey", "c_acctbal")
    suppliers = table(spark, folder, "supplier").filter("s_suppkey % 10 = 0")
    name = f"tidemark_buckets_{uuid.uuid4().hex[:12]}"
    tables.create_keyed_table(spark, name, customers.schema, ["c_custkey"], buckets=32, rows=customers)
    tables.merge_into(spark, name, customers.filter("c_custkey % 50 = 1").withColumn("c_acctbal", F.lit(-1.0)))
    tables.merge_into(spark, name, suppliers.selectExpr("-s_suppkey - 1 AS c_custkey", "s_acctbal AS c_acctbal"))
    return tables.read_current(spark, name).drop(tables.BUCKET)


def _profiled(spark, folder):
    """The whole log as a stream of three batches, profiled as they arrive."""
    log = table(spark, folder, "events").selectExpr(*LOG_COLUMNS)
    path, name = scratch_path(spark, "log"), f"tidemark_profile_{uuid.uuid4().hex[:12]}"
    log.repartition(3, "user_id").write.parquet(path)
    stream = jobs.file_stream(spark, path, "*.parquet", log.schema, files_per_trigger=1)
    views.profile_stream(stream, MONITOR, name, scratch_path(spark, "cp")).awaitTermination()
    return name


@query(
    "stream_profile_numeric",
    f"""WITH {_GROUPS}, {_NUMERIC} SELECT * REPLACE (round(percent_null, 6) AS percent_null, round(avg, 9) AS avg,
        round(stddev, 9) AS stddev) FROM p""",
)
def stream_profile_numeric(spark, folder):
    name = _profiled(spark, folder)
    return _flat(views.profile_so_far(spark, MONITOR, name, "numeric"), "percent_null", "avg", "stddev")


@query(
    "stream_profile_values",
    f"WITH {_GROUPS} " + " UNION ALL ".join(_categorical_sql(c) for c in ("prediction", "churn", "contract")),
)
def stream_profile_values(spark, folder):
    return _flat(views.profile_so_far(spark, MONITOR, _profiled(spark, folder), "values"), "percent_null")


@query("stream_profile_quality", quality_sql(_KEYS, "(SELECT *, churn AS label FROM g)", _GROUPS))
def stream_profile_quality(spark, folder):
    return _flat(views.profile_so_far(spark, MONITOR, _profiled(spark, folder), "confusion"), *_QUALITY)
