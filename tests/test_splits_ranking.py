import datetime as dt
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators import ranking, splits
from tidemark.plans import churn

FEW = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def test_hash_split_ignores_layout(spark):
    df = spark.range(2000).withColumnRenamed("id", "k")
    one = splits.split_by_hash(df.repartition(2), ["k"]).filter("split = 'train'").select("k")
    two = splits.split_by_hash(df.repartition(7), ["k"]).filter("split = 'train'").select("k")
    assert one.exceptAll(two).isEmpty() and two.exceptAll(one).isEmpty()
    assert 0.76 < one.count() / 2000 < 0.84


def test_weighted_and_traffic_split(spark):
    df = spark.range(3000).withColumnRenamed("id", "k")
    parts = splits.split_by_weights(df, ["k"], {"a": 70, "b": 20, "c": 10}).groupBy("split").count()
    got = {r["split"]: r["count"] / 3000 for r in parts.collect()}
    assert abs(got["a"] - 0.7) < 0.04 and abs(got["b"] - 0.2) < 0.04 and abs(got["c"] - 0.1) < 0.04
    routed = splits.route_traffic(df, ["k"], {"1": 80, "2": 20})
    assert set(r[0] for r in routed.select("model_version").distinct().collect()) == {"1", "2"}


@FEW
@given(
    st.lists(st.one_of(st.none(), st.integers(-5, 5), st.integers(-(10**12), 10**12)), min_size=1, max_size=40),
    st.sampled_from([0.0, 0.1, 0.29, 0.5, 0.7, 0.8, 1.0]),
)
def test_time_split_equals_percent_rank(spark, values, ratio):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, t long")
    got = splits.split_by_time(df, "t", ratio, on_constant="keep")
    rank = F.percent_rank().over(Window.orderBy(F.col("t").asc_nulls_first()))
    want = df.withColumn("split", F.when(rank <= ratio, "train").otherwise("test"))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_time_split_has_no_single_partition_window(spark):
    df = spark.range(100).withColumn("t", F.timestamp_seconds("id"))
    plan = splits.split_by_time(df, "t")._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "SinglePartition" not in plan


def test_constant_time_is_refused(spark):
    df = spark.range(3).withColumn("t", F.lit(dt.datetime(2024, 1, 1)))
    with pytest.raises(ValueError, match="one distinct value"):
        splits.split_by_time(df, "t")
    assert splits.split_by_time(df, "t", on_constant="keep").filter("split = 'train'").count() == 3
    with pytest.raises(ValueError, match="strategy"):
        splits.assign_split(df, "other", ["id"], "t")


@FEW
@given(st.lists(st.one_of(st.floats(-1e6, 1e6), st.floats(0, 1e-300), st.integers(0, 3).map(float)), min_size=1, max_size=40))
def test_order_statistics(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    ranks = [0, len(values) // 2, len(values) - 1]
    assert ranking.order_statistics(df, "v", ranks) == [sorted(values)[r] for r in ranks]


def test_median(spark):
    df = spark.createDataFrame([(v,) for v in (5.0, 1.0, None, 3.0, 10.0)], "v double")
    assert ranking.exact_median(df, "v") == 4.0
    assert ranking.exact_median(df.limit(0), "v") is None


@pytest.mark.parametrize("parts", [2, 5, 64])
def test_prefix_sums(spark, parts):
    rng = random.Random(3)
    rows = [(float(x), rng.randint(0, 9)) for x in rng.sample(range(1000), 200)]
    got = ranking.prefix_sums(spark.createDataFrame(rows, "x double, n int"), "x", ["n"], parts)
    total, want = 0, {}
    for x, n in sorted(rows):
        total += n
        want[x] = total
    assert {r["x"]: r["cum_n"] for r in got.collect()} == want


def test_latest_per_key_settles_ties(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("a", 2, "z"), ("b", 1, None)], "k string, t int, v string")
    assert sorted(map(tuple, splits.latest_per_key(df, ["k"], "t").collect())) == [("a", 2, "z"), ("b", 1, None)]


def test_attach_labels_keeps_unlabelled_rows(spark):
    at = dt.datetime(2024, 1, 1)
    features = spark.createDataFrame([("C001", at), ("C002", at)], "customer_id string, transaction_ts timestamp")
    raw = spark.createDataFrame([("C001", "No")], "customer_id string, churn string")
    labels, _ = churn.silver_labels(features, raw)
    rows = {r["customer_id"]: r for r in labels.collect()}
    assert len(rows) == 2 and rows["C002"]["churn"] is None
    assert {r["split"] for r in rows.values()} <= {"train", "test"}


def test_class_weights(spark):
    df = spark.createDataFrame([("No",), ("Yes",), ("Yes",), (None,)], "y string")
    assert {r["y"]: r["weight"] for r in splits.class_weights(df, "y").collect()} == {"No": 1.5, "Yes": 0.75}
    assert splits.with_class_weights(df, "y").filter("weight IS NOT NULL").count() == 3
    many = splits.with_class_weights(spark.range(1500), "id")
    assert many.count() == 1500 and many.select("weight").distinct().collect()[0][0] == 1.0


def test_order_statistics_at_the_edges(spark):
    inf, nan = float("inf"), float("nan")
    values = [inf, -inf, nan, 1e308, -1e308, 0.0, 5e-324, 1.0, 1.0 + 2**-52, inf]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup(None))
    want = sorted(v for v in values if v == v)
    assert ranking.order_statistics(df, "v", list(range(len(want)))) == want
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(None)) - jobs < 400
    assert ranking.exact_median(spark.createDataFrame([(float(i),) for i in range(200)] + [(inf,)], "v double"), "v") == 100.0
    wide = [-(2**63), 2**63 - 1, 0, 5, -7]
    longs = spark.createDataFrame([(v,) for v in wide], "v long")
    assert ranking.order_statistics(longs, "v", [0, 1, 2, 3, 4]) == sorted(wide)


def test_cutoff_with_nan(spark):
    df = spark.createDataFrame([(float(i),) for i in range(9)] + [(float("nan"),)], "t double")
    cutoff, distinct = ranking.percent_rank_cutoff(df, "t", 0.5)
    assert (cutoff, distinct) == (4.0, 2)


def test_newest_row_may_hold_a_map(spark):
    df = spark.createDataFrame([(1, 1, {"a": 1}), (1, 2, {"a": 2}), (2, 1, {"b": 1})], "k int, t int, m map<string,int>")
    got = {r["k"]: r["m"] for r in splits.latest_per_key(df, ["k"], "t").collect()}
    assert got == {1: {"a": 2}, 2: {"b": 1}}
