"""Queries for sources, sinks and keyed tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tidemark.operators import merge, score, splits
from tidemark.operators.quality import ColumnRule, primary_key_report
from tidemark.plans.binding import LOG_SQL, inference_log, query, sql_bucket, table
from tidemark.session import scratch_path
from tidemark.sources import readers, synthetic, tables
from tidemark.sources.readers import Source


@query("src_dispatch", "SELECT * FROM customer")
def src_dispatch(spark, folder):
    return readers.read_source(spark, Source("files", path=f"{folder}/customer.parquet", format="parquet", options={}))


@query("src_table", "SELECT * FROM orders")
def src_table(spark, folder):
    name = _fresh(spark, "orders")
    tables.write_table(table(spark, folder, "orders"), name)
    return readers.read_source(spark, Source("table", table=name))


@query(
    "src_csv",
    "SELECT c_custkey AS cust_key, c_name AS customer_name, c_acctbal AS acct_bal, c_mktsegment AS mkt_segment"
    " FROM customer",
)
def src_csv(spark, folder):
    path = scratch_path(spark, "customer_csv")
    raw = table(spark, folder, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    names = ["CustKey", "Customer Name", "AcctBal", "Mkt-Segment"]
    raw.toDF(*names).write.option("header", "true").csv(path)
    schema = "`CustKey` long, `Customer Name` string, `AcctBal` double, `Mkt-Segment` string"
    return readers.read_source(spark, Source("csv", path=path, schema=schema))


@query("src_fallback", "SELECT * FROM supplier")
def src_fallback(spark, folder):
    paths = [f"{folder}/not_there.parquet", f"{folder}/supplier.parquet"]
    return readers.read_source(spark, Source("fallback", paths=paths, format="parquet", options={}))


@query(
    "read_filter_select",
    "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 100000",
)
def read_filter_select(spark, folder):
    table(spark, folder, "orders").createOrReplaceTempView("tidemark_orders")
    condition = "o_orderstatus = 'F' AND o_totalprice > 100000"
    return readers.read_table(spark, "tidemark_orders", condition, ["o_orderkey", "o_custkey"])


@query(
    "read_latest_version",
    "SELECT o_orderkey, o_custkey, CASE WHEN o_orderstatus = 'F' THEN o_totalprice * 2 ELSE o_totalprice END"
    " AS o_totalprice FROM orders",
)
def read_latest_version(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    name = _fresh(spark, "versions")
    tables.create_keyed_table(spark, name, orders.drop("o_orderstatus").schema, ["o_orderkey"])
    tables.publish_version(spark, name, orders.drop("o_orderstatus"))
    doubled = F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice") * 2).otherwise(F.col("o_totalprice"))
    tables.publish_version(spark, name, orders.withColumn("o_totalprice", doubled).drop("o_orderstatus"))
    history = spark.read.parquet(tables.properties(spark, name)[tables.BASE])
    return readers.latest_version(history).drop("_version")


@query("synth_inference_log")
def synth_inference_log(spark, folder):
    return synthetic.synthetic_log(table(spark, folder, "customer"), "c_custkey")


@query(
    "synth_log_facts",
    """SELECT 'rows' AS fact, CAST(30 * count(*) AS VARCHAR) AS value FROM customer
       UNION ALL SELECT 'days', '30' UNION ALL SELECT 'rows of the least day', CAST(count(*) AS VARCHAR) FROM customer
       UNION ALL SELECT 'values off their steps or lists', '0' UNION ALL SELECT 'other on a second run', '0'""",
)
def synth_log_facts(spark, folder):
    """What holds for any draw: a row per key and day, values on the stated steps and lists, and the same log again."""
    customers = table(spark, folder, "customer")
    log, again = (synthetic.synthetic_log(c, "c_custkey") for c in (customers, customers.repartition(5)))
    off = F.lit(False)
    for name, spec in synthetic.CHURN_LOG.items():
        if isinstance(spec, synthetic.Choice):
            off = off | ~F.col(name).isin(list(spec.weights))
        else:
            place = (F.col(name).cast("double") - spec.low) / spec.step
            off = off | ~F.col(name).between(spec.low, spec.high) | (F.abs(place - F.round(place)) > 1e-6)
    days = log.groupBy(F.to_date("inference_timestamp").alias("day")).agg(F.count("*").alias("n"), F.count_if(off).alias("off"))
    per_day = days.agg(F.count("*"), F.min("n"), F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("off"), F.lit(0))).first()
    facts = [
        ("rows", per_day[2]),
        ("days", per_day[0]),
        ("rows of the least day", per_day[1]),
        ("values off their steps or lists", per_day[3]),
        ("other on a second run", synthetic.rows_beyond(log, again)),
    ]
    return spark.createDataFrame([(k, str(v)) for k, v in facts], "fact string, value string")


@query("unlabelled_copy", "SELECT * EXCLUDE (event_type) FROM events")
def unlabelled_copy(spark, folder):
    return synthetic.without_label(table(spark, folder, "events"), "event_type")


def _fresh(spark, label: str) -> str:
    """A table name nobody else uses."""
    return f"tidemark_{label}_{uuid.uuid4().hex[:12]}"


@query("write_roundtrip", "SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag FROM lineitem")
def write_roundtrip(spark, folder):
    rows = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag")
    name = _fresh(spark, "lines")
    tables.write_table(rows, name, partition_by=["l_returnflag"], comment="order lines")
    return spark.table(name)


@query("bronze_ingest", "SELECT *, TIMESTAMP '2024-02-01 00:00:00' AS _ingested_at FROM orders")
def bronze_ingest(spark, folder):
    rules = [
        ColumnRule("o_orderkey", type="long", nullable=False),
        ColumnRule("o_orderstatus", allowed=["F", "O", "P"]),
        ColumnRule("o_totalprice", type="double", at_least=0),
    ]
    name = _fresh(spark, "bronze")
    tables.ingest(table(spark, folder, "orders"), name, rules, at=F.expr("TIMESTAMP_NTZ '2024-02-01 00:00:00'"))
    return spark.table(name)


# Target: orders that are not pending. Source: orders above low priority, repriced.
_TARGET = "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus <> 'P'"
_SOURCE = (
    "SELECT o_orderkey, o_custkey, 'X' AS o_orderstatus, o_totalprice + 1000 AS o_totalprice"
    " FROM orders WHERE o_orderpriority <> '5-LOW'"
)


def _upsert_sides(spark, folder):
    orders = table(spark, folder, "orders")
    columns = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"]
    target = orders.filter("o_orderstatus <> 'P'").select(*columns)
    source = orders.filter("o_orderpriority <> '5-LOW'").selectExpr(
        "o_orderkey", "o_custkey", "'X' AS o_orderstatus", "o_totalprice + 1000 AS o_totalprice"
    )
    return target, source


def _upsert_sql(status: str, insert: bool) -> str:
    matched = f"""
        SELECT t.o_orderkey, t.o_custkey,
               CASE WHEN s.o_orderkey IS NOT NULL THEN {status} ELSE t.o_orderstatus END AS o_orderstatus,
               COALESCE(s.o_totalprice, t.o_totalprice) AS o_totalprice
        FROM ({_TARGET}) t LEFT JOIN ({_SOURCE}) s ON t.o_orderkey = s.o_orderkey"""
    new = f"""
        UNION ALL SELECT s.* FROM ({_SOURCE}) s
        WHERE NOT EXISTS (SELECT 1 FROM ({_TARGET}) t WHERE t.o_orderkey = s.o_orderkey)"""
    return matched + (new if insert else "")


@query("upsert_all", _upsert_sql("s.o_orderstatus", True))
def upsert_all(spark, folder):
    target, source = _upsert_sides(spark, folder)
    return merge.merge_frames(target, source, ["o_orderkey"])


@query("upsert_subset", _upsert_sql("t.o_orderstatus", True))
def upsert_subset(spark, folder):
    target, source = _upsert_sides(spark, folder)
    return merge.merge_frames(target, source, ["o_orderkey"], update=["o_totalprice"])


@query("upsert_no_insert", _upsert_sql("s.o_orderstatus", False))
def upsert_no_insert(spark, folder):
    target, source = _upsert_sides(spark, folder)
    return merge.merge_frames(target, source, ["o_orderkey"], insert=False)


@query(
    "late_label_merge",
    "SELECT event_id, user_id, ts, value, CASE WHEN event_type IN ('purchase', 'signup') THEN 'Yes' END AS churn"
    " FROM events",
)
def late_label_merge(spark, folder):
    events = table(spark, folder, "events")
    log = events.selectExpr("event_id", "user_id", "ts", "value", "CAST(NULL AS STRING) AS churn")
    arrived = events.filter("event_type IN ('purchase', 'signup')").selectExpr("user_id", "ts", "'Yes' AS churn")
    return merge.late_labels(log, arrived, ["user_id", "ts"], "churn")


@query(
    "feature_merge",
    """SELECT c_custkey, c_mktsegment, c_acctbal + 1 AS c_acctbal FROM customer WHERE c_acctbal > 0
       UNION ALL SELECT c_custkey, c_mktsegment, c_acctbal FROM customer
       WHERE c_acctbal <= 0 AND c_mktsegment <> 'BUILDING'""",
)
def feature_merge(spark, folder):
    customers = table(spark, folder, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    store, name = tables.FeatureStore(spark, "default"), _fresh(spark, "features")
    store.reset_and_write(name, customers.filter("c_mktsegment <> 'BUILDING'"), ["c_custkey"])
    store.write(name, customers.filter("c_acctbal > 0").withColumn("c_acctbal", F.col("c_acctbal") + 1))
    return store.read(name)


@query(
    "pk_check",
    """WITH d AS (SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL),
       k AS (SELECT CAST(sum(n) AS BIGINT) AS total, count(*) AS keys FROM d),
       z AS (SELECT count_if(l_orderkey IS NULL) AS a, count_if(l_linenumber IS NULL) AS b FROM lineitem)
       SELECT 'l_orderkey_no_nulls' AS name, a = 0 AS passed, CAST(a AS BIGINT) AS violations,
              CASE WHEN a > 0 THEN 'Found ' || a || ' nulls in ''l_orderkey''' ELSE 'No nulls in ''l_orderkey''' END
              AS message FROM z
       UNION ALL
       SELECT 'l_linenumber_no_nulls', b = 0, CAST(b AS BIGINT),
              CASE WHEN b > 0 THEN 'Found ' || b || ' nulls in ''l_linenumber'''
              ELSE 'No nulls in ''l_linenumber''' END FROM z
       UNION ALL
       SELECT 'l_orderkey_l_linenumber_is_unique', total = keys, total - keys,
              'Total: ' || total || ', Distinct: ' || keys FROM k""",
)
def pk_check(spark, folder):
    return primary_key_report(table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "append_predictions",
    f"""SELECT event_id, user_id, monthly_charges, prediction, 'churn' AS model_name, '3' AS model_version,
               TIMESTAMP '2024-02-01 00:00:00' AS inference_timestamp FROM ({LOG_SQL})""",
)
def append_predictions(spark, folder):
    events = inference_log(spark, folder).select("event_id", "user_id", "monthly_charges", "prediction")
    at = F.expr("TIMESTAMP_NTZ '2024-02-01 00:00:00'")
    batch = score.stamp_predictions(splits.split_by_hash(events, ["user_id"]), "churn", "3", at)
    log = batch.filter("prediction = 'Yes'")
    return log.unionByName(score.append_new(log, batch, ["event_id", "model_version", "inference_timestamp"]))


@query(
    "change_feed",
    """WITH o AS (SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus <> 'P'),
       n AS (SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderstatus = 'F' THEN o_totalprice + 1 ELSE o_totalprice
             END AS o_totalprice FROM orders WHERE o_orderpriority <> '5-LOW')
       SELECT n.*, 'insert' AS _change_type FROM n ANTI JOIN o USING (o_orderkey)
       UNION ALL SELECT o.*, 'delete' FROM o ANTI JOIN n USING (o_orderkey)
       UNION ALL SELECT o.*, 'update_preimage' FROM o JOIN n USING (o_orderkey)
         WHERE (o.o_orderstatus, o.o_totalprice) IS DISTINCT FROM (n.o_orderstatus, n.o_totalprice)
       UNION ALL SELECT n.*, 'update_postimage' FROM o JOIN n USING (o_orderkey)
         WHERE (o.o_orderstatus, o.o_totalprice) IS DISTINCT FROM (n.o_orderstatus, n.o_totalprice)""",
)
def change_feed(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    before = orders.filter("o_orderstatus <> 'P'").drop("o_orderpriority")
    price = F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    after = orders.filter("o_orderpriority <> '5-LOW'").withColumn("o_totalprice", price).drop("o_orderpriority")
    return merge.change_feed(before, after, ["o_orderkey"])


@query(
    "latest_per_key",
    """SELECT * FROM orders
       QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""",
)
def latest_per_key(spark, folder):
    return splits.latest_per_key(table(spark, folder, "orders"), ["o_custkey"], "o_orderdate")


@query(
    "union_logs",
    """SELECT event_id, user_id, prediction, monthly_charges, NULL::VARCHAR AS contract FROM ({log})
       WHERE model_version = '1'
       UNION ALL SELECT event_id, user_id, prediction, NULL, contract FROM ({log}) WHERE model_version = '2'""".format(
        log=LOG_SQL
    ),
)
def union_logs(spark, folder):
    log = inference_log(spark, folder)
    offline = log.filter("model_version = '1'").select("event_id", "user_id", "prediction", "monthly_charges")
    online = log.filter("model_version = '2'").select("event_id", "user_id", "prediction", "contract")
    return merge.union_logs(offline, online)


_PREDICTIONS = f"""SELECT user_id, inference_timestamp AS ts, monthly_charges, prediction, model_version
                   FROM ({LOG_SQL})"""
_LABELS = f"""SELECT user_id, inference_timestamp AS ts, churn,
                     CASE WHEN {sql_bucket(["user_id"], 42)} < 8000 THEN 'train' ELSE 'test' END AS split
              FROM ({LOG_SQL}) WHERE churn IS NOT NULL"""


def _predictions_and_labels(spark, folder):
    log = inference_log(spark, folder).withColumnRenamed("inference_timestamp", "ts")
    labels = log.filter("churn IS NOT NULL").select("user_id", "ts", "churn")
    return log.select("user_id", "ts", "monthly_charges", "prediction", "model_version"), splits.split_by_hash(
        labels, ["user_id"]
    )


@query(
    "inference_table",
    f"SELECT p.*, l.churn FROM ({_PREDICTIONS}) p LEFT JOIN ({_LABELS}) l USING (user_id, ts)",
)
def inference_table(spark, folder):
    from tidemark.operators import profile

    predictions, labels = _predictions_and_labels(spark, folder)
    return profile.inference_table(predictions, labels, ["user_id", "ts"])


@query(
    "baseline_table",
    f"""SELECT p.monthly_charges, p.prediction, p.model_version, l.churn
        FROM ({_PREDICTIONS}) p JOIN ({_LABELS}) l USING (user_id, ts) WHERE l.split = 'test'""",
)
def baseline_table(spark, folder):
    from tidemark.operators import profile

    predictions, labels = _predictions_and_labels(spark, folder)
    return profile.baseline_table(predictions, labels, ["user_id", "ts"], drop=["user_id", "ts", "split"])
