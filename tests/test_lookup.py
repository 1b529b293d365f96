import bisect
import datetime as dt
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidemark.functions.columns import AVG_PRICE_INCREASE, FeatureFunction
from tidemark.operators import lookup, skew
from tidemark.operators.lookup import FeatureLookup
from tidemark.operators.skew import SkewPolicy

FORCED = SkewPolicy(rows=25)
OFF = SkewPolicy(enabled=False)


def brute_force(labels, features, lookback=None):
    """Latest feature with time <= label time, per key, in plain Python."""
    by_key = {}
    for key, at, value in sorted(features, key=lambda r: (str(r[0]), r[1])):
        by_key.setdefault(key, []).append((at, value))
    out = {}
    for ident, key, at in labels:
        rows = by_key.get(key, []) if key is not None and at is not None else []
        place = bisect.bisect_right([r[0] for r in rows], at) - 1 if rows else -1
        hit = rows[place] if place >= 0 else None
        out[ident] = None if hit is None or (lookback is not None and at - hit[0] > lookback) else hit[1]
    return out


def scenario(seed):
    """Two thirds of the rows on one key, half of its label rows at one instant, null keys and times."""
    rng = random.Random(seed)
    start = dt.datetime(2024, 1, 1)

    def moment():
        return start + dt.timedelta(minutes=rng.randint(0, 60_000))

    labels = []
    for i in range(600):
        key = 7 if i % 3 else rng.choice([1, 2, 3, None])
        at = dt.datetime(2024, 1, 20) if key == 7 and i % 2 else moment()
        labels.append((i, key, None if i % 97 == 0 else at))
    seen, features = set(), []
    for i in range(400):
        row = (7 if i % 3 else rng.choice([1, 2, 3, 4]), moment())
        if row not in seen:
            seen.add(row)
            features.append((*row, float(i)))
    features.append((7, dt.datetime(2024, 1, 20), -1.0))
    return labels, features


@pytest.mark.parametrize("policy", [OFF, FORCED], ids=["plain", "pieces"])
@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
@pytest.mark.parametrize("seed", [1, 2])
def test_asof_against_brute_force(spark, policy, kind, seed):
    labels, features = scenario(seed)
    left = spark.createDataFrame(labels, f"id int, k int, ts {kind}")
    right = spark.createDataFrame(features, f"k long, at {kind}, v double")
    window = dt.timedelta(days=2)
    specs = [
        FeatureLookup(right, ["k"], ["v"], time_key="at", label_time="ts"),
        FeatureLookup(right, ["k"], ["v"], {"v": "recent"}, time_key="at", label_time="ts", lookback=window),
    ]
    out = lookup.asof_join(left, specs, policy)
    assert out.columns == ["id", "k", "ts", "v", "recent"] and out.schema["k"].dataType == left.schema["k"].dataType
    rows = out.collect()
    assert len(rows) == len(labels)
    assert {r["id"]: r["v"] for r in rows} == brute_force(labels, features)
    assert {r["id"]: r["recent"] for r in rows} == brute_force(labels, features, window)


def test_hot_key_is_cut_and_its_heavy_instant_is_salted(spark):
    labels, _ = scenario(1)
    marks = spark.createDataFrame(labels, "id int, k int, ts timestamp").select(
        skew.key_hash(["k"]).alias("_key"), F.unix_micros("ts").alias("_ord")
    )
    hot = skew.hot_keys(marks, FORCED)
    assert hot and all(n > FORCED.rows for n in hot.values())
    pieces = skew.cut_pieces(marks, hot, FORCED)
    assert len(pieces) <= 600 / FORCED.rows + 4 * len(hot)
    assert any(p.salts > 1 for p in pieces)
    for key in hot:
        starts = [p.start for p in pieces if p.key == key]
        assert starts[0] is None and starts[1:] == sorted(set(starts[1:]))


def test_asof_shuffles_once_for_two_lookups(spark):
    labels, features = scenario(1)
    left = spark.createDataFrame(labels, "id int, k int, ts timestamp")
    right = spark.createDataFrame(features, "k int, at timestamp, v double")
    spec = FeatureLookup(right, ["k"], ["v"], time_key="at", label_time="ts")
    other = FeatureLookup(right, ["k"], ["v"], {"v": "w"}, time_key="at", label_time="ts")
    plan = lookup.apply_lookups(left, [spec, other])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


def test_asof_prunes_label_columns_nobody_reads(spark, tmp_path):
    labels, features = scenario(1)
    left = spark.createDataFrame(labels, "id int, k int, ts timestamp").withColumn("wide", F.lit("x"))
    left.write.parquet(str(tmp_path / "left"))
    right = spark.createDataFrame(features, "k int, at timestamp, v double")
    out = lookup.asof_join(
        spark.read.parquet(str(tmp_path / "left")), FeatureLookup(right, ["k"], time_key="at", label_time="ts")
    )
    plan = out.select("id", "v")._jdf.queryExecution().executedPlan().toString()
    assert "wide" not in plan


@pytest.mark.parametrize("policy", [OFF, FORCED], ids=["plain", "salted"])
def test_key_lookup(spark, policy):
    left = spark.createDataFrame([(i, 7 if i % 2 else None if i % 4 else i) for i in range(400)], "id int, k int")
    right = spark.createDataFrame([(7, "hot"), (8, "cold")], "k long, name string")
    out = lookup.key_lookup(left, FeatureLookup(right, ["k"], rename={"name": "label"}), policy=policy)
    rows = {r["id"]: r["label"] for r in out.collect()}
    assert len(rows) == 400 and out.count() == 400
    assert rows == {i: "hot" if i % 2 else "cold" if i == 8 else None for i in range(400)}


def test_key_lookup_refuses_a_repeated_key(spark):
    left = spark.createDataFrame([(1,)], "k int")
    right = spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string")
    with pytest.raises(PySparkException, match="lookup key is not unique: 1"):
        lookup.key_lookup(left, FeatureLookup(right, ["k"])).collect()


def test_training_set(spark):
    at = dt.datetime(2024, 1, 2)
    labels = spark.createDataFrame([("a", at, "Yes"), ("b", at, None), ("c", at, "No")], "k string, ts timestamp, y string")
    features = spark.createDataFrame(
        [("a", at, 50.0, 10.0, 400.0), ("c", at + dt.timedelta(1), 1.0, 1.0, 1.0)],
        "k string, ts timestamp, monthly double, tenure double, total double",
    )
    bound = {"monthly_charges_in": "monthly", "tenure_in": "tenure", "total_charges_in": "total"}
    specs = [FeatureLookup(features, ["k"], time_key="ts"), FeatureFunction(AVG_PRICE_INCREASE, bound, "increase")]
    out = lookup.training_set(labels, specs, "y", exclude=["ts"])
    assert out.columns == ["k", "y", "monthly", "tenure", "total", "increase"]
    assert sorted(map(tuple, out.collect()))[0] == ("a", "Yes", 50.0, 10.0, 400.0, 10.0)
    assert out.count() == 2 and lookup.training_set(labels, specs, "y", exclude_null_labels=False).count() == 3


def test_a_key_far_below_a_thousandth_of_the_rows_is_spread(spark):
    """What is hot is a number of rows, so it doesn't grow with the data."""
    rows = spark.range(60_000).selectExpr("CASE WHEN id < 40 THEN -1 ELSE id END AS k", "timestamp_seconds(id) AS ts", "id AS v")
    marks = rows.select(skew.key_hash(["k"]).alias("_key"), F.unix_micros("ts").alias("_ord"))
    policy = SkewPolicy(rows=10)
    hot = skew.hot_keys(marks, policy)
    assert list(hot.values()) == [40] and 4 <= len(skew.cut_pieces(marks, hot, policy)) <= 5
    labels = spark.createDataFrame([(-1, i) for i in range(0, 60, 3)], "k long, s long").selectExpr("k", "timestamp_seconds(s) AS ts")
    out = lookup.asof_join(labels, FeatureLookup(rows, ["k"], ["v"], time_key="ts"), policy).selectExpr("unix_seconds(ts) s", "v")
    assert {r["s"]: r["v"] for r in out.collect()} == {s: min(s, 39) for s in range(0, 60, 3)}


def test_rows_per_key_are_counted_on_the_labels_alone(spark, monkeypatch):
    """Later lookups don't run the earlier ones again to count rows."""
    left = spark.createDataFrame([(i, i % 3, i % 5) for i in range(30)], "id int, a int, b int")
    one, two = (spark.createDataFrame([(i, i * 10) for i in range(5)], f"{c} int, v{c} int") for c in "ab")
    plans, count = [], skew.hot_keys
    monkeypatch.setattr(skew, "hot_keys", lambda rows, policy: plans.append(rows._jdf.queryExecution().optimizedPlan().toString()) or count(rows, policy))
    out = lookup.apply_lookups(left, [FeatureLookup(one, ["a"]), FeatureLookup(two, ["b"])])
    assert len(plans) == 2 and not any("Join" in p for p in plans)
    assert {r["id"]: (r["va"], r["vb"]) for r in out.collect()} == {i: (i % 3 * 10, i % 5 * 10) for i in range(30)}
