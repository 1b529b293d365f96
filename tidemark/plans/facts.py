"""Operators whose result is a fact of the catalog, a stream or a gate, as rows that SQL can state."""

from __future__ import annotations

import threading
import uuid

from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidemark.operators import quality, score
from tidemark.plans.binding import BRONZE_SQL, bronze, query, table
from tidemark.plans.streams import _stream
from tidemark.session import scratch_path
from tidemark.sources import tables
from tidemark.streaming import jobs


def _fresh(label: str) -> str:
    return f"tidemark_{label}_{uuid.uuid4().hex[:12]}"


def _facts(spark, rows):
    return spark.createDataFrame([(step, str(value)) for step, value in rows], "step string, value string")


_RULES = {
    "valid_customer_id": "customer_id IS NOT NULL",
    "known_contract": "contract IN ('Month-to-month', 'One year', 'Two year')",
    "some_gender": "gender IS NOT NULL",
}


@query(
    "expect_fail",
    f"WITH b AS ({BRONZE_SQL}) "
    + " UNION ALL ".join(
        f"SELECT '{name}' AS step, CASE WHEN count_if({expr}) < count(*) THEN 'True' ELSE 'False' END AS value FROM b"
        for name, expr in _RULES.items()
    ),
)
def expect_fail(spark, folder):
    """Whether each rule, as a fail rule, stops the read of the raw customers."""
    out = []
    for name, expr in _RULES.items():
        try:
            quality.keep_valid(bronze(spark, folder), [quality.Expectation(name, expr, "fail")]).write.format("noop").mode(
                "overwrite"
            ).save()
            out.append((name, False))
        except PySparkException as error:
            if f"expectation failed: {name}" not in str(error):
                raise
            out.append((name, True))
    return _facts(spark, out)


@query(
    "table_properties",
    """SELECT 'facts.rows' AS step, CAST(count(*) AS VARCHAR) AS value FROM nation
       UNION ALL SELECT 'facts.names', CAST(sum(length(n_name)) AS VARCHAR) FROM nation
       UNION ALL SELECT 'comment', 'nations of ' || count(DISTINCT n_regionkey) || ' regions' FROM nation""",
)
def table_properties(spark, folder):
    nations, name = table(spark, folder, "nation"), _fresh("nations")
    facts = nations.agg(F.count("*"), F.sum(F.length("n_name")), F.countDistinct("n_regionkey")).first()
    tables.write_table(nations, name, comment=f"nations of {facts[2]} regions")
    tables.set_properties(spark, name, {"facts.rows": facts[0], "facts.names": facts[1]})
    held = tables.properties(spark, name)
    described = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
    tables.drop_table(spark, name)
    return _facts(spark, [*[(k, held[k]) for k in ("facts.rows", "facts.names")], ("comment", described["Comment"])])


@query(
    "schema_life",
    """SELECT 'waited' AS step, CAST(count(*) AS VARCHAR) AS value FROM supplier
       UNION ALL SELECT 'kept', CAST(count(*) AS VARCHAR) FROM supplier UNION ALL SELECT 'left', 'False'""",
)
def schema_life(spark, folder):
    """A table waited for, kept when its schema is ensured again, gone when the schema is made anew."""
    schema = _fresh("schema")
    tables.ensure_schemas(spark, {schema: "suppliers"})
    tables.write_table(table(spark, folder, "supplier"), f"{schema}.suppliers")
    waited = tables.wait_for_table(spark, f"{schema}.suppliers", timeout=60).count()
    tables.ensure_schemas(spark, {schema: "suppliers"})
    kept = spark.table(f"{schema}.suppliers").count()
    tables.recreate_schema(spark, schema, confirm=True)
    left = spark.catalog.tableExists(f"{schema}.suppliers")
    spark.sql(f"DROP DATABASE {schema} CASCADE")
    return _facts(spark, [("waited", waited), ("kept", kept), ("left", left)])


@query(
    "table_drop_tags",
    """SELECT 'rows after a dry drop' AS step, CAST(count(*) AS VARCHAR) AS value FROM part
       UNION ALL SELECT 'tag', CAST(max(p_size) AS VARCHAR) FROM part UNION ALL SELECT 'skipped', '2'
       UNION ALL SELECT 'exists after the drop', 'False'""",
)
def table_drop_tags(spark, folder):
    parts, name = table(spark, folder, "part"), _fresh("parts")
    store, dry = tables.FeatureStore(spark, "default"), tables.FeatureStore(spark, "default", dry_run=True)
    store.reset_and_write(name, parts, ["p_partkey"])
    store.set_tags(name, {"largest": parts.agg(F.max("p_size")).first()[0]})
    dry.drop(name)
    dry.set_tags(name, {"largest": "none"})
    rows, tag = store.read(name).count(), tables.properties(spark, store.full_name(name))["largest"]
    store.drop(name)
    exists = spark.catalog.tableExists(store.full_name(name))
    facts = [("rows after a dry drop", rows), ("tag", tag), ("skipped", len(dry.skipped))]
    return _facts(spark, [*facts, ("exists after the drop", exists)])


@query(
    "stream_wait",
    """SELECT 'listed' AS step, 'True' AS value UNION ALL SELECT 'left', '0'
       UNION ALL SELECT 'rows', CAST(count(DISTINCT o_custkey) AS VARCHAR) FROM orders""",
)
def stream_wait(spark, folder):
    """A named stream is listed while it runs and waited for; then the table it feeds is."""
    orders = _stream(spark, folder, "orders").select("o_custkey", "o_orderdate")
    name, listed = _fresh("fed"), threading.Event()

    def held(batch):  # the first batch ends when the stream has been seen
        listed.wait(120)
        return batch

    tables.create_keyed_table(spark, name, orders.schema, ["o_custkey"])
    jobs.upsert_stream(orders, name, ["o_custkey"], "o_orderdate", scratch_path(spark, "cp"), name, held)
    seen = name in [q.name for q in jobs.active_streams(spark, "tidemark_fed")]
    listed.set()
    jobs.wait_for_streams(spark, name, timeout=300)
    left, rows = len(jobs.active_streams(spark, name)), tables.wait_for_table(spark, name, timeout=60).count()
    tables.drop_table(spark, name)
    return _facts(spark, [("listed", seen), ("left", left), ("rows", rows)])


@query(
    "gate_can_score",
    """SELECT 'sound' AS step, 'True: ' || count(*) AS value FROM customer
       UNION ALL SELECT 'broken', 'False' FROM (SELECT count(*) FROM customer)""",
)
def gate_can_score(spark, folder):
    customers = table(spark, folder, "customer")
    passed, text = score.can_score(customers, lambda df: df.withColumn("prediction", F.col("c_acctbal") > 0))
    broken, _ = score.can_score(customers, lambda df: df.withColumn("prediction", F.col("no_such_column") > 0))
    return _facts(spark, [("sound", f"{passed}: {''.join(c for c in text if c.isdigit())}"), ("broken", broken)])


@query(
    "append_to_table",
    """SELECT event_id, user_id, CASE WHEN value > 50 THEN 'Yes' ELSE 'No' END AS prediction,
              CASE WHEN event_id % 3 <> 0 THEN NULL ELSE value END AS value FROM events""",
)
def append_to_table(spark, folder):
    """Predictions appended twice to a log table that held a part of them without the value column."""
    events = table(spark, folder, "events")
    made = events.select("event_id", "user_id", F.when(F.col("value") > 50, "Yes").otherwise("No").alias("prediction"), "value")
    name = _fresh("log")
    tables.write_table(made.filter("event_id % 3 <> 0").drop("value"), name)
    for _ in range(2):
        new = score.append_new(spark.table(name), made, ["event_id"])
        tables.write_table(new, name, mode="append")
    return spark.table(name)


@query(
    "table_from_query",
    """SELECT o_orderpriority, count(*) AS orders, round(sum(o_totalprice), 2) AS price FROM orders
       WHERE o_orderstatus <> 'P' GROUP BY o_orderpriority""",
)
def table_from_query(spark, folder):
    table(spark, folder, "orders").createOrReplaceTempView("tidemark_orders")
    name = _fresh("totals")
    text = """SELECT o_orderpriority, count(*) AS orders, round(sum(o_totalprice), 2) AS price FROM tidemark_orders
              WHERE o_orderstatus <> 'P' GROUP BY o_orderpriority"""
    tables.write_table(spark.sql(text), name)
    return spark.table(name)
