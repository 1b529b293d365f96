"""Queries for feature lookups and training sets."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidemark.functions.columns import AVG_PRICE_INCREASE, FeatureFunction
from tidemark.operators import lookup
from tidemark.operators.lookup import FeatureLookup
from tidemark.plans.binding import query, table

_CLICKS = "SELECT user_id, ts, value AS click_value, props AS click_props FROM events WHERE event_type = 'click'"
_PURCHASES = "SELECT event_id, user_id, ts, value FROM events WHERE event_type = 'purchase'"


def _purchases(spark, folder):
    return table(spark, folder, "events").filter("event_type = 'purchase'").select("event_id", "user_id", "ts", "value")


def _feature_rows(spark, folder, kind):
    rows = table(spark, folder, "events").filter(F.col("event_type") == kind)
    return rows.selectExpr("user_id", "ts", f"value AS {kind}_value", f"props AS {kind}_props")


@query(
    "asof_lookup",
    f"""SELECT l.*, f.click_value, f.click_props FROM ({_PURCHASES}) l
        ASOF LEFT JOIN ({_CLICKS}) f ON l.user_id = f.user_id AND l.ts >= f.ts""",
)
def asof_lookup(spark, folder):
    clicks = _feature_rows(spark, folder, "click")
    return lookup.asof_join(_purchases(spark, folder), FeatureLookup(clicks, ["user_id"], time_key="ts"))


@query(
    "asof_lookback",
    f"""SELECT l.*, CASE WHEN f.ts >= l.ts - INTERVAL 12 HOUR THEN f.click_value END AS click_value,
               CASE WHEN f.ts >= l.ts - INTERVAL 12 HOUR THEN f.click_props END AS click_props FROM ({_PURCHASES}) l
        ASOF LEFT JOIN ({_CLICKS}) f ON l.user_id = f.user_id AND l.ts >= f.ts""",
)
def asof_lookback(spark, folder):
    clicks = _feature_rows(spark, folder, "click")
    recent = FeatureLookup(clicks, ["user_id"], time_key="ts", lookback=dt.timedelta(hours=12))
    return lookup.asof_join(_purchases(spark, folder), recent)


@query(
    "equi_lookup",
    """SELECT o.o_custkey, o.o_orderkey, o.o_totalprice, c.c_acctbal, c.c_mktsegment
       FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey AND c.c_acctbal > 0""",
)
def equi_lookup(spark, folder):
    customers = table(spark, folder, "customer").filter("c_acctbal > 0")
    features = customers.selectExpr("c_custkey AS o_custkey", "c_acctbal", "c_mktsegment")
    orders = table(spark, folder, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return lookup.key_lookup(orders, FeatureLookup(features, ["o_custkey"]))


@query(
    "lookup_rename",
    """SELECT l.l_orderkey, l.l_linenumber, l.l_suppkey, s.s_acctbal AS supplier_balance, s.s_nationkey AS nation
       FROM lineitem l LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey""",
)
def lookup_rename(spark, folder):
    suppliers = table(spark, folder, "supplier").withColumnRenamed("s_suppkey", "l_suppkey")
    spec = FeatureLookup(
        suppliers, ["l_suppkey"], ["s_acctbal", "s_nationkey"], {"s_acctbal": "supplier_balance", "s_nationkey": "nation"}
    )
    return lookup.key_lookup(table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey"), spec)


_K = "TRY_CAST(regexp_extract(click_props, '([0-9]+)', 1) AS DOUBLE)"
_TRAINING = f"""
    SELECT l.event_id, CASE WHEN l.value > 60 THEN 'Yes' ELSE 'No' END AS label,
           f.click_value, f.clicks_seen, v.view_value, c.c_acctbal AS balance,
           round(CAST(CAST(CASE WHEN f.clicks_seen > 0 THEN f.click_value - v.view_value / f.clicks_seen ELSE 0 END
                 AS FLOAT) AS DOUBLE), 4) AS price_increase
    FROM (SELECT * FROM events WHERE event_type = 'purchase' AND value > 5) l
    ASOF LEFT JOIN (SELECT user_id, ts, value AS click_value,
                           TRY_CAST(regexp_extract(props, '([0-9]+)', 1) AS DOUBLE) AS clicks_seen
                    FROM events WHERE event_type = 'click') f ON l.user_id = f.user_id AND l.ts >= f.ts
    ASOF LEFT JOIN (SELECT user_id, ts, CASE WHEN ts IS NOT NULL THEN value END AS view_value
                    FROM events WHERE event_type = 'view') v ON l.user_id = v.user_id AND l.ts >= v.ts
    LEFT JOIN customer c ON c.c_custkey = l.user_id"""


@query("training_set", _TRAINING)
def training_set(spark, folder):
    """Labels with two point-in-time lookups (one pass), one key lookup and one feature function."""
    events = table(spark, folder, "events")
    label = "CASE WHEN value > 60 THEN 'Yes' WHEN value > 5 THEN 'No' END AS label"
    labels = events.filter("event_type = 'purchase'").selectExpr("event_id", "user_id", "ts", label)
    clicks = events.filter("event_type = 'click'").selectExpr(
        "user_id",
        "ts",
        "value AS click_value",
        "try_cast(regexp_extract(props, '([0-9]+)', 1) AS DOUBLE) AS clicks_seen",
    )
    views = events.filter("event_type = 'view'").selectExpr("user_id", "ts", "value AS view_value")
    balances = table(spark, folder, "customer").selectExpr("c_custkey AS user_id", "c_acctbal")
    increase = FeatureFunction(
        AVG_PRICE_INCREASE,
        {"monthly_charges_in": "click_value", "tenure_in": "clicks_seen", "total_charges_in": "view_value"},
        "price_increase",
    )
    specs = [
        FeatureLookup(clicks, ["user_id"], time_key="ts"),
        FeatureLookup(views, ["user_id"], time_key="ts"),
        FeatureLookup(balances, ["user_id"], rename={"c_acctbal": "balance"}),
        increase,
    ]
    out = lookup.training_set(labels, specs, "label", exclude=["user_id", "ts"])
    return out.withColumn("price_increase", F.round(F.col("price_increase").cast("double"), 4))
