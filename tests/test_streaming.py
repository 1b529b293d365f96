import datetime as dt
import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidemark.operators.profile import Monitor
from tidemark.plans import churn
from tidemark.session import scratch_path
from tidemark.sources import tables
from tidemark.streaming import jobs


@pytest.fixture
def parts(spark, tmp_path):
    """Three files, newer rows later, with repeats of keys inside and across files."""
    rows = [(i % 7, dt.datetime(2024, 1, 1) + dt.timedelta(hours=6 * i), float(i), "1") for i in range(60)]
    df = spark.createDataFrame(rows, "k int, ts timestamp, v double, m string")
    folder = str(tmp_path / "in")
    for n in range(3):
        df.filter((F.col("v") >= 20 * n) & (F.col("v") < 20 * (n + 1))).coalesce(1).write.mode("append").parquet(folder)
    return folder, df


def test_upsert_stream_equals_latest_rows_and_survives_redelivery(spark, parts):
    folder, df = parts
    stream = jobs.file_stream(spark, folder, "*.parquet", df.schema, files_per_trigger=1)
    tables.create_keyed_table(spark, "default.stream_up", df.schema, ["k"])
    jobs.upsert_stream(stream, "default.stream_up", ["k"], "ts", scratch_path(spark, "cp")).awaitTermination()
    want = {r["k"]: r["v"] for r in df.groupBy("k").agg(F.max("v").alias("v")).collect()}
    assert {r["k"]: r["v"] for r in spark.table("default.stream_up").collect()} == want
    # The same rows again without the checkpoint: another stream, which changes nothing.
    jobs.upsert_stream(stream, "default.stream_up", ["k"], "ts", scratch_path(spark, "cp")).awaitTermination()
    assert {r["k"]: r["v"] for r in spark.table("default.stream_up").collect()} == want


def test_a_batch_delivered_again_is_skipped(spark, parts):
    folder, df = parts
    stream = jobs.file_stream(spark, folder, "*.parquet", df.schema)
    tables.create_keyed_table(spark, "default.stream_again", df.schema, ["k"])
    checkpoint = scratch_path(spark, "cp")
    query = jobs.upsert_stream(stream, "default.stream_again", ["k"], "ts", checkpoint)
    query.awaitTermination()
    before = tables.current_version(spark, "default.stream_again")
    # As if the table had been written and the commit of the batch lost.
    for mark in ("0", ".0.crc"):
        os.remove(f"{checkpoint.removeprefix('file:')}/commits/{mark}")
    jobs.upsert_stream(stream, "default.stream_again", ["k"], "ts", checkpoint).awaitTermination()
    assert tables.current_version(spark, "default.stream_again") == before


def test_two_streams_into_one_table_keep_all_rows(spark, tmp_path):
    schema = "k int, ts timestamp, v double"
    rows = [(i, dt.datetime(2024, 1, 1), float(i)) for i in range(20)]
    tables.create_keyed_table(spark, "default.stream_two", spark.createDataFrame([], schema).schema, ["k"])
    for part in (rows[:10], rows[10:]):
        folder = str(tmp_path / f"in{part[0][0]}")
        spark.createDataFrame(part, schema).write.parquet(folder)
        stream = jobs.file_stream(spark, folder, "*.parquet", spark.createDataFrame([], schema).schema)
        jobs.upsert_stream(stream, "default.stream_two", ["k"], "ts", scratch_path(spark, "cp")).awaitTermination()
    assert spark.table("default.stream_two").count() == 20


def test_a_null_key_is_refused(spark, tmp_path):
    df = spark.createDataFrame([(None, dt.datetime(2024, 1, 1), 1.0)], "k int, ts timestamp, v double")
    df.write.parquet(str(tmp_path / "in"))
    tables.create_keyed_table(spark, "default.stream_null", df.schema, ["k"])
    stream = jobs.file_stream(spark, str(tmp_path / "in"), "*.parquet", df.schema)
    with pytest.raises(PySparkException, match="without key"):
        jobs.upsert_stream(stream, "default.stream_null", ["k"], "ts", scratch_path(spark, "cp")).awaitTermination()


def test_features_on_a_stream_equal_the_batch(spark, customers, tmp_path):
    folder, out, at = str(tmp_path / "raw"), str(tmp_path / "out"), dt.datetime(2024, 1, 1)
    customers.write.parquet(folder)
    stream = jobs.file_stream(spark, folder, "*.parquet", customers.schema)
    jobs.append_stream(stream, out, scratch_path(spark, "cp"), lambda df: churn.build_features(df, at)).awaitTermination()
    got, want = spark.read.parquet(out), churn.build_features(customers, at)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_daily_metrics_equal_the_batch_on_every_day(spark, parts):
    folder, df = parts
    monitor = Monitor("ts", model_col="m", numeric=["v"])
    stream = jobs.file_stream(spark, folder, "*.parquet", df.schema, files_per_trigger=1)
    daily = jobs.daily_metrics(stream, monitor)
    tables.create_keyed_table(spark, "default.stream_days", daily.schema, ["window", "model_version"])
    keys = ["window", "model_version"]
    jobs.upsert_aggregates(daily, "default.stream_days", keys, scratch_path(spark, "cp")).awaitTermination()
    got = {r["window"]["start"]: (r["count"], r["v_sum"]) for r in spark.table("default.stream_days").collect()}
    want = {
        r["w"]["start"]: (r["n"], r["s"])
        for r in df.groupBy(F.window("ts", "1 day").alias("w")).agg(F.count("*").alias("n"), F.sum("v").alias("s")).collect()
    }
    assert got == want


def test_list_wait_and_stop_streams(spark):
    rate = spark.readStream.format("rate").load()
    query = rate.writeStream.format("noop").queryName("tide_x").start()
    assert [q.name for q in jobs.active_streams(spark, "tide_")] == ["tide_x"]
    with pytest.raises(TimeoutError):
        jobs.wait_for_streams(spark, "tide_", timeout=0.3, poll=0.1)
    assert jobs.stop_streams(spark, "tide_") == 1
    jobs.wait_for_streams(spark, "tide_", timeout=10)
    assert not query.isActive
