"""Queries for column expressions, data quality and splits."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tidemark.functions import columns
from tidemark.operators import quality, splits
from tidemark.plans import churn
from tidemark.plans.binding import BRONZE_SQL, LOG_SQL, bronze, inference_log, query, sql_bucket, table
from tidemark.session import scratch_path
from tidemark.sources import tables

SNAPSHOT = "2024-02-01 00:00:00"


def _snapshot():
    import datetime as dt

    return dt.datetime.fromisoformat(SNAPSHOT)


@query(
    "normalize_columns",
    "SELECT c_custkey AS cust_key, c_name AS customer_name, c_nationkey AS nation_key, c_acctbal AS acct_bal_usd,"
    " c_mktsegment AS mkt_segment FROM customer",
)
def normalize_columns(spark, folder):
    raw = table(spark, folder, "customer").toDF(
        "CustKey", "Customer Name", "Nation-Key", "AcctBal (USD)", "mktSegment_"
    )
    return columns.normalize_columns(raw)


_SERVICES = " + ".join(f"CASE WHEN {c} = 'Yes' THEN 1.0::DOUBLE ELSE 0 END" for c in churn.OPTIONAL_SERVICES)


@query("count_flags", f"SELECT customer_id, {_SERVICES} AS num_optional_services FROM ({BRONZE_SQL})")
def count_flags(spark, folder):
    return churn.add_service_count(bronze(spark, folder)).select("customer_id", "num_optional_services")


@query(
    "recode_map",
    """SELECT l_orderkey, l_linenumber,
              CASE l_returnflag WHEN 'R' THEN 'Returned' WHEN 'A' THEN 'Accepted' END AS state,
              CASE l_linenumber WHEN 1 THEN 'Yes' WHEN 2 THEN 'No' END AS first_line FROM lineitem""",
)
def recode_map(spark, folder):
    return table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        columns.recode("l_returnflag", {"R": "Returned", "A": "Accepted"}).alias("state"),
        columns.recode("l_linenumber", {"1": "Yes", "2": "No"}).alias("first_line"),
    )


@query(
    "parse_numeric",
    """SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 0 ELSE c_acctbal END AS strict_value,
              CASE WHEN c_acctbal < 0 OR c_mktsegment = 'BUILDING' THEN 0 ELSE c_acctbal END AS lenient_value
       FROM customer""",
)
def parse_numeric(spark, folder):
    text = "CASE WHEN c_acctbal < 0 THEN '  ' ELSE concat(' ', CAST(c_acctbal AS STRING)) END"
    raw = table(spark, folder, "customer").selectExpr(
        "c_custkey", f"{text} AS clean", f"CASE WHEN c_mktsegment = 'BUILDING' THEN 'n/a' ELSE {text} END AS dirty"
    )
    return raw.select(
        "c_custkey",
        columns.parse_number("clean").alias("strict_value"),
        columns.parse_number("dirty", strict=False).alias("lenient_value"),
    )


@query(
    "fill_nulls",
    "SELECT event_id, CASE WHEN event_type IN ('error', 'view') THEN 0 ELSE value END AS value FROM events",
)
def fill_nulls(spark, folder):
    holes = "CASE event_type WHEN 'error' THEN NULL WHEN 'view' THEN double('NaN') ELSE value END AS value"
    return columns.fill_missing(table(spark, folder, "events").selectExpr("event_id", holes), {"value": 0.0})


_CLEAN = f"""SELECT * REPLACE (
    CASE senior_citizen WHEN 1 THEN 'Yes' WHEN 0 THEN 'No' END AS senior_citizen,
    COALESCE(tenure, 0) AS tenure, COALESCE(monthly_charges, 0) AS monthly_charges,
    CASE WHEN trim(total_charges) = '' THEN 0 ELSE CAST(total_charges AS DOUBLE) END AS total_charges)
    FROM ({BRONZE_SQL})"""
_FEATURES = f"SELECT *, {_SERVICES} AS num_optional_services, TIMESTAMP '{SNAPSHOT}' AS transaction_ts FROM ({_CLEAN})"


@query("clean_features", _CLEAN)
def clean_features(spark, folder):
    return columns.clean(bronze(spark, folder), churn.CLEANING)


@query("snapshot_ts", f"SELECT *, TIMESTAMP '{SNAPSHOT}' AS snapshot_at FROM customer")
def snapshot_ts(spark, folder):
    return columns.add_snapshot(table(spark, folder, "customer"), _snapshot(), "snapshot_at", wall_clock=True)


@query("build_features", f"SELECT * EXCLUDE (churn) FROM ({_FEATURES})")
def build_features(spark, folder):
    return churn.build_features(bronze(spark, folder), _snapshot(), wall_clock=True).drop(churn.LABEL)


_INCREASE = "CASE WHEN tenure > 0 THEN monthly_charges - total_charges / tenure ELSE 0 END"


@query(
    "feature_function",
    f"""SELECT customer_id, round(CAST(CAST({_INCREASE} AS FLOAT) AS DOUBLE), 4) AS avg_price_increase
        FROM ({_FEATURES})""",
)
def feature_function(spark, folder):
    features = churn.build_features(bronze(spark, folder), _snapshot())
    priced = churn.PRICE_INCREASE.apply(features)
    return priced.select(
        "customer_id", F.round(F.col("avg_price_increase").cast("double"), 4).alias("avg_price_increase")
    )


@query(
    "filter_split",
    f"""SELECT o_orderkey, o_totalprice FROM orders WHERE {sql_bucket(["o_orderkey"], 42)} < 8000""",
)
def filter_split(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    return columns.filter_split(splits.split_by_hash(orders, ["o_orderkey"]), "split = 'train'")


@query("limit_ordered", "SELECT o_orderkey, o_orderdate FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 100")
def limit_ordered(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderdate")
    return columns.ordered_limit(orders, 100, "o_orderdate", "o_orderkey")


@query(
    "num_coerce",
    "SELECT event_id, TRY_CAST(regexp_extract(props, '([0-9]+)', 1) AS DOUBLE) AS k,"
    " CASE WHEN event_type = 'click' THEN NULL ELSE value END AS amount FROM events",
)
def num_coerce(spark, folder):
    raw = table(spark, folder, "events").selectExpr(
        "event_id",
        "regexp_extract(props, '([0-9]+)', 1) AS k_text",
        "CASE WHEN event_type = 'click' THEN 'unknown' ELSE CAST(value AS STRING) END AS amount_text",
    )
    return raw.select(
        "event_id", columns.to_number("k_text").alias("k"), columns.to_number("amount_text").alias("amount")
    )


# --- data quality -----------------------------------------------------------


def _metrics_sql(rules, source: str) -> str:
    rows = [
        f"""SELECT '{r.name}' AS name, '{r.action}' AS action,
            count(*) - count_if(NOT COALESCE({r.expr}, false)) AS passed_records,
            CAST(count_if(NOT COALESCE({r.expr}, false)) AS BIGINT) AS failed_records FROM ({source})"""
        for r in rules
    ]
    return " UNION ALL ".join(rows)


@query("expect_drop", f"SELECT * FROM ({BRONZE_SQL}) WHERE customer_id IS NOT NULL")
def expect_drop(spark, folder):
    return quality.keep_valid(bronze(spark, folder), churn.BRONZE_EXPECTATIONS)


@query("expect_metrics", _metrics_sql(churn.FEATURE_EXPECTATIONS, _FEATURES))
def expect_metrics(spark, folder):
    features = churn.build_features(bronze(spark, folder), _snapshot())
    return quality.expectation_metrics(features, churn.FEATURE_EXPECTATIONS)


_VALIDATED = f"SELECT * FROM ({BRONZE_SQL}) WHERE customer_id IS NOT NULL"


@query("bronze_validated", _metrics_sql(churn.BRONZE_EXPECTATIONS, BRONZE_SQL))
def bronze_validated(spark, folder):
    """The rules' counts, taken while the kept rows are written."""
    path = scratch_path(spark, "validated")
    return quality.write_expected(bronze(spark, folder), churn.BRONZE_EXPECTATIONS, lambda rows: rows.write.parquet(path))


@query("bronze_kept", _VALIDATED)
def bronze_kept(spark, folder):
    """The rows that the same pass wrote."""
    path = scratch_path(spark, "validated")
    quality.write_expected(bronze(spark, folder), churn.BRONZE_EXPECTATIONS, lambda rows: rows.write.parquet(path))
    return spark.read.parquet(path)


@query("silver_features", f"SELECT * EXCLUDE (churn) FROM ({_FEATURES}) WHERE customer_id IS NOT NULL")
def silver_features(spark, folder):
    validated, _ = churn.bronze_validated(bronze(spark, folder))
    return churn.silver_features(validated, _snapshot(), wall_clock=True)[0]


_SPLIT_OF_CUSTOMER = f"CASE WHEN {sql_bucket(['f.customer_id'], 42)} < 8000 THEN 'train' ELSE 'test' END"


@query(
    "feature_tables",
    f"""SELECT f.* EXCLUDE (churn), f.churn AS label, {_SPLIT_OF_CUSTOMER} AS split
        FROM ({_FEATURES}) f WHERE customer_id IS NOT NULL""",
)
def feature_tables(spark, folder):
    """Raw table to stored feature and label tables, read back and joined on their key."""
    made = churn.feature_job(bronze(spark, folder), _snapshot())
    store, mark = tables.FeatureStore(spark, "default"), uuid.uuid4().hex[:12]
    churn.publish_features(store, made, f"tidemark_features_{mark}", f"tidemark_labels_{mark}")
    labels = store.read(f"tidemark_labels_{mark}").withColumnRenamed("churn", "label")
    out = store.read(f"tidemark_features_{mark}").join(labels, ["customer_id", "transaction_ts"])
    return out.withColumn("transaction_ts", F.col("transaction_ts").cast("timestamp_ntz"))


_CHECKS = [
    ("customer_id_no_nulls", "customer_id IS NULL", "nulls in 'customer_id'", "No nulls in 'customer_id'"),
    (
        "contract_allowed_values",
        "contract NOT IN ('Month-to-month', 'One year', 'Two year')",
        "invalid values for 'contract'",
        "All values valid in 'contract'",
    ),
    (
        "monthly_charges_range",
        "monthly_charges < 0 OR monthly_charges > 90",
        "values out of bounds [0, 90] in 'monthly_charges'",
        "All values in range for 'monthly_charges'",
    ),
    (
        "tenure_positive",
        "NOT COALESCE(tenure > 0, false)",
        "rows failing expression: tenure > 0",
        "All rows passed expression: tenure > 0",
    ),
]


def _check_sql(name: str, violation: str, failed: str, passed: str) -> str:
    failed, passed = failed.replace("'", "''"), passed.replace("'", "''")
    return f"""SELECT '{name}' AS name, n = 0 AS passed, n AS violations,
        CASE WHEN n > 0 THEN 'Found ' || n || ' {failed}' ELSE '{passed}' END AS message
        FROM (SELECT CAST(count_if({violation}) AS BIGINT) AS n FROM ({BRONZE_SQL}))"""


@query("dq_checks", " UNION ALL ".join(_check_sql(*c) for c in _CHECKS))
def dq_checks(spark, folder):
    return quality.run_checks(
        bronze(spark, folder),
        [
            quality.no_nulls("customer_id"),
            quality.allowed_values("contract", churn.CONTRACTS),
            quality.in_range("monthly_charges", 0, 90),
            quality.sql_check("tenure_positive", "tenure > 0"),
        ],
    )


@query(
    "dq_unique",
    """WITH a AS (SELECT o_custkey, o_orderdate, count(*) AS n FROM orders GROUP BY ALL),
       b AS (SELECT CAST(sum(n) AS BIGINT) AS total, count(*) AS keys FROM a),
       c AS (SELECT count(*) AS total, count(DISTINCT o_orderkey) AS keys FROM orders)
       SELECT 'o_custkey_o_orderdate_is_unique' AS name, total = keys AS passed, total - keys AS violations,
              'Total: ' || total || ', Distinct: ' || keys AS message FROM b
       UNION ALL SELECT 'o_orderkey_is_unique', total = keys, total - keys,
              'Total: ' || total || ', Distinct: ' || keys FROM c""",
)
def dq_unique(spark, folder):
    checks = [quality.unique("o_custkey", "o_orderdate"), quality.unique("o_orderkey")]
    return quality.run_checks(table(spark, folder, "orders"), checks)


def _schema_sql() -> str:
    rows = []
    for rule in churn.BRONZE_RULES:
        c = rule.name
        found = [("present", "false")]
        if not rule.nullable:
            found.append(("not_null", f"{c} IS NULL"))
        if rule.min_length is not None:
            found.append((f"str_length>={rule.min_length}", f"length({c}) < {rule.min_length}"))
        if rule.allowed is not None:
            texts = ", ".join(f"'{v}'" for v in sorted({str(v) for v in rule.allowed}))
            found.append(("isin", f"CAST({c} AS VARCHAR) NOT IN ({texts})"))
        if rule.at_least is not None:
            found.append((f">={rule.at_least}", f"TRY_CAST({c} AS DOUBLE) < {rule.at_least}"))
        rows += [
            f"SELECT '{c}' AS column_name, '{name}' AS rule, CAST(count_if({test}) AS BIGINT) AS violations FROM b"
            for name, test in found
        ]
    return f"WITH b AS ({BRONZE_SQL}) " + " UNION ALL ".join(rows)


@query("schema_check", _schema_sql())
def schema_check(spark, folder):
    return quality.schema_report(bronze(spark, folder), churn.BRONZE_RULES)


# --- splits and labels ------------------------------------------------------


def _split(bucket: str, edge: int = 8000) -> str:
    return f"CASE WHEN {bucket} < {edge} THEN 'train' ELSE 'test' END"


@query("split_hash", f"SELECT o_orderkey, {_split(sql_bucket(['o_orderkey'], 42))} AS split FROM orders")
def split_hash(spark, folder):
    return splits.split_by_hash(table(spark, folder, "orders").select("o_orderkey"), ["o_orderkey"])


@query("split_rand")
def split_rand(spark, folder):
    return splits.split_at_random(table(spark, folder, "orders").select("o_orderkey"))


@query(
    "split_rand_facts",
    """SELECT 'orders' AS fact, CAST(count(DISTINCT o_orderkey) AS VARCHAR) AS value FROM orders
       UNION ALL SELECT 'rows', CAST(count(*) AS VARCHAR) FROM orders
       UNION ALL SELECT 'neither train nor test', '0' UNION ALL SELECT 'further from four fifths than chance', '0'""",
)
def split_rand_facts(spark, folder):
    """What holds for any draw: every order once, in one of the parts, about four fifths of them for training."""
    rows = split_rand(spark, folder)
    n, keys, train, other = rows.agg(
        F.count("*"), F.countDistinct("o_orderkey"), F.count_if(F.col("split") == "train"),
        F.count_if(~F.col("split").isin("train", "test")),
    ).first()
    far = int(abs(train - 0.8 * n) > 6 * (0.16 * n) ** 0.5)
    facts = [("orders", keys), ("rows", n), ("neither train nor test", other), ("further from four fifths than chance", far)]
    return spark.createDataFrame([(k, str(v)) for k, v in facts], "fact string, value string")


@query(
    "split_time",
    """SELECT o_orderkey, CASE WHEN percent_rank() OVER (ORDER BY o_orderdate NULLS FIRST) <= 0.8
       THEN 'train' ELSE 'test' END AS split FROM orders""",
)
def split_time(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderdate")
    return splits.split_by_time(orders, "o_orderdate", 0.8).select("o_orderkey", "split")


@query(
    "split_label_features",
    f"""SELECT event_id, inference_timestamp, churn, {_split(sql_bucket(["event_id"], 42))} AS split
        FROM ({LOG_SQL})""",
)
def split_label_features(spark, folder):
    log = inference_log(spark, folder)
    return splits.separate_labels(log, ["event_id"], "inference_timestamp", "churn")[1]


@query(
    "silver_labels",
    f"""SELECT f.customer_id, f.transaction_ts, b.churn, {_split(sql_bucket(["f.customer_id"], 42))} AS split
        FROM (SELECT * FROM ({_FEATURES}) WHERE customer_id IS NOT NULL) f
        LEFT JOIN ({_VALIDATED}) b ON f.customer_id = b.customer_id""",
)
def silver_labels(spark, folder):
    validated, _ = churn.bronze_validated(bronze(spark, folder))
    features, _ = churn.silver_features(validated, _snapshot(), wall_clock=True)
    return churn.silver_labels(features, validated)[0]


@query(
    "label_gaps",
    f"""SELECT d.doc_id, d.n_chars, l.quality, {_split(sql_bucket(["d.doc_id"], 42))} AS split
        FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
)
def label_gaps(spark, folder):
    documents, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    return splits.attach_labels(documents, labels, "doc_id", "n_chars", "quality")


@query(
    "latest_label",
    f"""SELECT user_id, inference_timestamp, churn, split FROM (
          SELECT user_id, inference_timestamp, churn, {_split(sql_bucket(["user_id"], 42))} AS split FROM ({LOG_SQL}))
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY inference_timestamp DESC, churn DESC NULLS LAST) = 1""",
)
def latest_label(spark, folder):
    log = splits.split_by_hash(inference_log(spark, folder), ["user_id"])
    return splits.latest_label(log, ["user_id"], "inference_timestamp", "churn")


@query(
    "split_nested",
    f"""SELECT o_orderkey, {_split(sql_bucket(["o_orderkey"], "search-2025"), 9000)} AS part FROM orders
        WHERE {sql_bucket(["o_orderkey"], 42)} < 8000""",
)
def split_nested(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey")
    train = columns.filter_split(splits.split_by_hash(orders, ["o_orderkey"]), "split = 'train'")
    return splits.split_by_hash(train, ["o_orderkey"], 0.9, "search-2025", "part")


@query(
    "split_threeway",
    f"""SELECT o_orderkey, CASE WHEN b < 7000 THEN 'train' WHEN b < 9000 THEN 'validate' ELSE 'test' END AS split
        FROM (SELECT o_orderkey, {sql_bucket(["o_orderkey"], 42)} AS b FROM orders)""",
)
def split_threeway(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey")
    return splits.split_by_weights(orders, ["o_orderkey"], {"train": 0.7, "validate": 0.2, "test": 0.1})


@query(
    "traffic_split",
    f"""SELECT event_id, user_id, CASE WHEN {sql_bucket(["user_id"], "traffic")} < 8000 THEN '1' ELSE '2' END
        AS model_version FROM events""",
)
def traffic_split(spark, folder):
    requests = table(spark, folder, "events").select("event_id", "user_id")
    return splits.route_traffic(requests, ["user_id"], {"1": 80, "2": 20})


@query(
    "split_counts",
    f"""SELECT split, count(*) AS n FROM (SELECT {_split(sql_bucket(["o_orderkey"], 42))} AS split FROM orders)
        GROUP BY split ORDER BY split""",
)
def split_counts(spark, folder):
    orders = splits.split_by_hash(table(spark, folder, "orders"), ["o_orderkey"])
    return orders.groupBy("split").agg(F.count(F.lit(1)).alias("n")).orderBy("split")


@query("split_values", f"SELECT DISTINCT {_split(sql_bucket(['o_orderkey'], 42))} AS split FROM orders")
def split_values(spark, folder):
    return splits.split_by_hash(table(spark, folder, "orders"), ["o_orderkey"]).select("split").distinct()


@query("value_counts", "SELECT l_returnflag, count(*) AS n FROM lineitem GROUP BY 1 ORDER BY n DESC, l_returnflag")
def value_counts(spark, folder):
    counts = table(spark, folder, "lineitem").groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), "l_returnflag")


@query(
    "class_weights",
    """WITH c AS (SELECT event_type, count(*) AS n FROM events GROUP BY 1)
       SELECT event_type, n, round((SELECT sum(n) FROM c)::DOUBLE / ((SELECT count(*) FROM c) * n), 6) AS weight
       FROM c""",
)
def class_weights(spark, folder):
    weights = splits.class_weights(table(spark, folder, "events"), "event_type")
    return weights.withColumn("weight", F.round("weight", 6))
