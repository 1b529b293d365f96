import datetime as dt
import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.stat import ChiSquareTest
from pyspark.sql import functions as F

from tidemark.functions import distances
from tidemark.operators import classify, drift, profile
from tidemark.operators.profile import Monitor
from tidemark.plans import churn


def counts_of(spark, pairs):
    return classify.confusion_counts(spark.createDataFrame(pairs, "y string, p string"), "y", "p")


def test_quality_by_hand(spark):
    pairs = [("Yes", "Yes")] * 3 + [("Yes", "No")] + [("No", "No")] * 4 + [("No", "Yes")] * 2 + [(None, "Yes")]
    counts = counts_of(spark, pairs)
    got = classify.quality_metrics(counts).first()
    assert got["n"] == 10 and got["accuracy_score"] == pytest.approx(0.7)
    yes, no = 2 * 3 / (2 * 3 + 2 + 1), 2 * 4 / (2 * 4 + 1 + 2)
    assert got["f1_macro"] == pytest.approx((yes + no) / 2)
    assert got["f1_weighted"] == pytest.approx(0.4 * yes + 0.6 * no)
    binary = classify.binary_metrics(counts, "Yes").first()
    assert (binary["true_positives"], binary["false_positives"], binary["false_negatives"], binary["true_negatives"]) == (3, 2, 1, 4)
    assert binary["f1_score"] == pytest.approx(yes)
    assert classify.business_value(counts).first()["value"] == 3 * 1500 - 2 * 500 + 2000
    assert classify.business_value(counts.limit(0)).first()["value"] is None


def test_a_class_never_predicted_counts_as_zero(spark):
    got = classify.quality_metrics(counts_of(spark, [("a", "b"), ("b", "b")])).first()
    assert got["precision_macro"] == pytest.approx(0.25) and got["recall_macro"] == pytest.approx(0.5)


def test_auc_against_pairs(spark):
    rng = random.Random(5)
    rows = [(rng.choice(["Yes", "No"]), round(rng.random(), 1)) for _ in range(300)]
    points = classify.roc_points(spark.createDataFrame(rows, "y string, s double"), "y", "s", "Yes")
    pos, neg = [s for y, s in rows if y == "Yes"], [s for y, s in rows if y == "No"]
    wins = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))
    assert classify.roc_auc(points).first()["roc_auc"] == pytest.approx(wins)
    top = points.orderBy("threshold").first()
    assert top["tpr"] == 1.0 and top["fpr"] == 1.0


def upper_gamma(shape: float, x: float) -> float:
    """Share of the Gamma(shape, 1) distribution above ``x``."""
    if x <= 0:
        return 1.0
    scale = math.exp(shape * math.log(x) - x - math.lgamma(shape))
    if x < shape + 1:  # power series of the lower part
        term = total = 1.0 / shape
        n = shape
        while abs(term) > abs(total) * 1e-16:
            n += 1
            term *= x / n
            total += term
        return max(0.0, 1.0 - total * scale)
    # continued fraction of the upper part, forward until it no longer changes
    tiny, n = 1e-300, 0
    b = x + 1 - shape
    c, d = 1 / tiny, 1 / b
    total = d
    while True:
        n += 1
        step, b = n * (shape - n), b + 2
        d = 1 / (step * d + b or tiny)
        c = b + step / c or tiny
        total *= c * d
        if abs(c * d - 1) < 1e-15:
            return min(1.0, scale * total)


@pytest.mark.parametrize("x, k, p", [(3.841459, 1, 0.05), (18.307038, 10, 0.05), (2.0, 2, math.exp(-1.0)), (0.0, 3, 1.0)])
def test_p_value(x, k, p):
    assert upper_gamma(k / 2, x / 2) == pytest.approx(p, abs=1e-6)


def test_p_values_of_all_sizes(spark):
    """Against the same tail by a power series and a continued fraction in Python."""
    rows = [(float(x), float(k)) for k in (1, 2, 3, 4, 7, 10, 51, 100, 999, 20_000, 1_000_001) for x in
            (0.0, 1e-9, 0.3, 1.0, 2.9, 3.1, k / 2, 0.97 * k, k + 1.9, k + 2.1, 1.03 * k + 3, 2 * k + 9, 3 * k + 700)]
    rows += [(None, 3.0), (float("nan"), 3.0), (1.0, 0.0)]
    df = spark.createDataFrame(rows, "x double, k double")
    got = df.select("x", "k", distances.chi_squared_p_value(F.col("x"), F.col("k")).alias("p")).collect()
    for r in got[:-3]:
        assert r.p == pytest.approx(upper_gamma(r.k / 2, r.x / 2), rel=1e-7, abs=1e-12), (r.x, r.k)
    assert [r.p for r in got[-3:]] == [None] * 3


MONITOR = Monitor("ts", model_col="m", categorical=["c"], slices=["big"])


def log_of(spark, seed=3, n=400):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        day = rng.choice([1, 2, 4, 7])
        rows.append((dt.datetime(2024, 1, day, rng.randint(0, 23)), rng.choice("12"), rng.choice("aaabbcdef"[: day + 3]), rng.random() < 0.5))
    return rows, spark.createDataFrame(rows, "ts timestamp, m string, c string, big boolean")


def by_hand(cur, ref):
    n, k = sum(cur.values()), sum(ref.values())
    values = set(cur) | set(ref)
    p, q = {v: cur[v] / n for v in values}, {v: ref[v] / k for v in values}

    def kl(a):
        return sum(a[v] * math.log2(a[v] / ((p[v] + q[v]) / 2)) for v in values if a[v] > 0)

    chi = sum(
        (o[v] - e) ** 2 / e for o, t in ((cur, n), (ref, k)) for v in values for e in [t * (cur[v] + ref[v]) / (n + k)]
    )
    return (
        sum(abs(p[v] - q[v]) for v in values) / 2,
        max(abs(p[v] - q[v]) for v in values),
        math.sqrt(max(0.0, kl(p) / 2 + kl(q) / 2)),
        chi,
        len(values) - 1,
    )


def test_consecutive_drift_skips_empty_days(spark):
    rows, df = log_of(spark)
    got = drift.consecutive_drift(drift.distribution(df, MONITOR), p_value=True)
    got = {r["window_start"].day: r for r in got.filter("model_version = '*' AND slice_key IS NULL").collect()}
    days = defaultdict(Counter)
    for ts, _, c, _ in rows:
        days[ts.day][c] += 1
    assert sorted(got) == [2, 4, 7]
    for before, day in ((1, 2), (2, 4), (4, 7)):
        tv, li, js, chi, k = by_hand(days[day], days[before])
        row = got[day]
        assert row["tv_distance"] == pytest.approx(tv) and row["l_infinity_distance"] == pytest.approx(li)
        assert row["js_distance"] == pytest.approx(js) and row["chi_squared_statistic"] == pytest.approx(chi)
        assert row["chi_squared_pvalue"] == pytest.approx(upper_gamma(k / 2, chi / 2))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_baseline_drift_by_hand(spark, seed):
    rng = random.Random(seed)
    rows, df = log_of(spark, seed, 60)
    base = [(rng.choice("bcdefghhh"),) for _ in range(50)]
    got = drift.baseline_drift(drift.distribution(df, MONITOR), spark.createDataFrame(base, "c string"), ["c"], p_value=True)
    checked = 0
    for row in got.collect():
        cur = Counter(
            c for ts, m, c, big in rows
            if ts.day == row["window_start"].day and row["model_version"] in ("*", m)
            and row["slice_value"] in (None, str(big).lower())
        )
        tv, li, js, chi, k = by_hand(cur, Counter(b[0] for b in base))
        assert row["tv_distance"] == pytest.approx(tv) and row["l_infinity_distance"] == pytest.approx(li)
        assert row["js_distance"] == pytest.approx(js) and row["chi_squared_statistic"] == pytest.approx(chi)
        assert row["chi_squared_pvalue"] == pytest.approx(upper_gamma(k / 2, chi / 2), abs=1e-9)
        checked += 1
    assert checked >= 20


def test_equal_distributions_have_no_drift(spark):
    _, df = log_of(spark, 1, 50)
    one_day = df.withColumn("ts", F.lit(dt.datetime(2024, 1, 1)))
    got = drift.baseline_drift(drift.distribution(one_day, MONITOR), one_day, ["c"])
    row = got.filter("model_version = '*' AND slice_key IS NULL").first()
    assert row["tv_distance"] == pytest.approx(0) and row["l_infinity_distance"] == pytest.approx(0)


def test_chi_squared_agrees_with_ml(spark):
    _, df = log_of(spark, 9, 300)
    two = df.filter("day(ts) IN (1, 2)")
    mine = drift.consecutive_drift(drift.distribution(two, MONITOR), p_value=True)
    mine = mine.filter("model_version = '*' AND slice_key IS NULL").first()
    indexed = StringIndexer(inputCol="c", outputCol="ci").fit(two).transform(two).withColumn("y", F.dayofmonth("ts").cast("double"))
    theirs = ChiSquareTest.test(VectorAssembler(inputCols=["ci"], outputCol="f").transform(indexed), "f", "y").first()
    assert mine["chi_squared_statistic"] == pytest.approx(theirs["statistics"][0])
    assert mine["chi_squared_pvalue"] == pytest.approx(theirs["pValues"][0])


def test_profile_does_not_multiply_rows_by_slices(spark):
    _, df = log_of(spark)
    monitor = Monitor("ts", model_col="m", numeric=["n"], slices=["big", "c"])
    plan = profile.profile_numeric(df.withColumn("n", F.rand(1)), monitor)._jdf.queryExecution().executedPlan().toString()
    last_generate, first_aggregate = plan.rindex("Generate"), plan.rindex("HashAggregate")
    assert last_generate < first_aggregate


def test_all_metrics_without_drift_keeps_performance(spark):
    perf = spark.createDataFrame([(1, "1", 0.2, -40.0), (2, "1", 0.9, -40.0)], "time int, model_id string, performance_metric double, expected_loss double")
    none = spark.createDataFrame([], "time int, model_id string, prediction double, churn double")
    some = spark.createDataFrame([(2, "1", 0.5, 0.6)], none.schema)
    assert drift.violations(drift.all_metrics(perf, none, ["prediction", "churn"]), ["prediction", "churn"]).first().asDict() == {
        "performance_violations": 1, "drift_violations": 0, "all_violations": 1}
    assert drift.violations(drift.all_metrics(perf, some, ["prediction", "churn"]), ["prediction", "churn"]).first().asDict() == {
        "performance_violations": 0, "drift_violations": 1, "all_violations": 1}


def test_metric_template(spark):
    text = profile.fill_template("avg({{prediction_col}} = {{label_col}})", churn.CHURN_MONITOR)
    assert text == "avg(`prediction` = `churn`)"
    with pytest.raises(ValueError):
        profile.fill_template("{{label_col}}", Monitor("ts"))


def test_deviation_of_values_with_a_large_mean(spark):
    at = dt.datetime(2024, 1, 1)
    rows = [(at, 1.7e9 + i % 3, "" if i % 2 else "x") for i in range(30)]
    df = spark.createDataFrame(rows, "ts timestamp, v double, s string")
    out = profile.profile_numeric(df, profile.Monitor("ts", slices=["s"], numeric=["v"])).collect()
    whole = [r for r in out if r["slice_key"] is None]
    assert all(abs(r["stddev"] - (2 / 3) ** 0.5) < 1e-6 for r in whole)
    assert {r["slice_value"] for r in out if r["slice_key"] == "s"} == {"", "x"}


def test_p_value_with_very_many_degrees():
    assert abs(upper_gamma(5e6, 5e6) - 0.49994) < 2e-5
    assert abs(upper_gamma(0.5, 0.5) - 0.31731050786) < 1e-10 and abs(upper_gamma(3, 10.0) - 0.00276939571) < 1e-10
