import pytest
from pyspark.errors import PySparkException

from tidemark.operators import quality
from tidemark.operators.quality import ColumnRule, Expectation
from tidemark.plans import churn


@pytest.fixture(scope="module")
def frame(spark):
    rows = [("1", "A", 10.5, 25), ("2", "B", 0.0, 30), ("3", "A", -5.0, 15), ("4", "C", 100.0, 45), (None, "B", None, 120)]
    return spark.createDataFrame(rows, "id string, category string, value double, age int")


def results(df, *checks):
    return {r["name"]: r for r in quality.run_checks(df, list(checks)).collect()}


def test_checks_and_messages(frame):
    got = results(
        frame,
        quality.no_nulls("id"),
        quality.no_nulls("category"),
        quality.allowed_values("category", ["A", "B"]),
        quality.in_range("age", 20, 50),
        quality.sql_check("positive", "value > 0"),
    )
    assert got["id_no_nulls"]["message"] == "Found 1 nulls in 'id'"
    assert got["category_no_nulls"]["passed"] and got["category_no_nulls"]["message"] == "No nulls in 'category'"
    assert got["category_allowed_values"]["message"] == "Found 1 invalid values for 'category'"
    assert got["age_range"]["message"] == "Found 2 values out of bounds [20, 50] in 'age'"
    assert got["positive"]["message"] == "Found 3 rows failing expression: value > 0"
    assert results(frame, quality.sql_check("p", "value > 0", null_ok=True))["p"]["violations"] == 2


def test_unique(spark):
    df = spark.createDataFrame([("1", 1), ("1", 2), ("2", 1)], "id string, n int")
    got = results(df, quality.unique("id"), quality.unique("id", "n"))
    assert got["id_is_unique"]["message"] == "Total: 3, Distinct: 2" and not got["id_is_unique"]["passed"]
    assert got["id_n_is_unique"]["passed"]
    assert results(df.limit(0), quality.unique("id"))["id_is_unique"]["message"] == "Total: 0, Distinct: 0"


def test_a_check_that_does_not_fit_fails_alone(frame):
    ok, rows = quality.validate(frame, [quality.no_nulls("absent"), quality.no_nulls("category")], raise_on_fail=False)
    assert not ok and [r["passed"] for r in rows] == [False, True] and rows[0]["message"].startswith("Exception")


def test_a_check_that_breaks_at_run_time_fails_alone(frame):
    checks = [quality.sql_check("bad", "cast(category as int) > 0"), quality.no_nulls("category")]
    ok, rows = quality.validate(frame, checks, raise_on_fail=False)
    assert [r["passed"] for r in rows] == [False, True]


def test_validate_raises_with_every_failure(frame):
    with pytest.raises(ValueError, match="2 data checks failed") as error:
        quality.validate(frame, [quality.no_nulls("id"), quality.in_range("age", 20, 50)])
    assert "id_no_nulls" in str(error.value) and "age_range" in str(error.value)


def test_row_checks_share_one_aggregate(frame):
    checks = [quality.no_nulls("id"), quality.in_range("age", 0, 1), quality.allowed_values("category", ["A"])]
    plan = quality.run_checks(frame, checks)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def test_expectations(frame):
    rules = [Expectation("id", "id IS NOT NULL", "drop"), Expectation("value", "value >= 0 OR value IS NULL")]
    kept, metrics = quality.expect(frame, rules)
    assert kept.count() == 4
    assert {(r["name"], r["passed_records"], r["failed_records"]) for r in metrics.collect()} == {("id", 4, 1), ("value", 4, 1)}
    with pytest.raises(PySparkException, match="expectation failed: age"):
        quality.keep_valid(frame, [Expectation("age", "age < 100", "fail")]).collect()
    with pytest.raises(ValueError):
        Expectation("x", "true", "ignore")


def test_schema_check(customers, spark):
    quality.check_schema(customers, churn.BRONZE_RULES)
    bad = spark.createDataFrame([("", "x", "-1"), (None, "3", None)], "id string, amount string, fee string")
    rules = [
        ColumnRule("id", nullable=False, min_length=1),
        ColumnRule("amount", type="double"),
        ColumnRule("fee", type="double", at_least=0),
        ColumnRule("gone"),
    ]
    with pytest.raises(ValueError) as error:
        quality.check_schema(bad, rules)
    text = str(error.value)
    for part in ("id not_null: 1", "id str_length>=1: 1", "amount coercible: 1", "fee >=0: 1", "gone present: 1"):
        assert part in text


def test_feature_and_label_schemas_hold_after_the_job(customers):
    import datetime as dt

    made = churn.feature_job(customers, dt.datetime(2024, 1, 1))
    quality.check_schema(made.features, churn.FEATURE_RULES)
    quality.check_schema(made.labels, churn.LABEL_RULES)
    assert all(r["passed"] for r in made.checks.collect())
    assert churn.LABEL not in made.features.columns


def test_primary_key_report(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (None, 2)], "a int, b int")
    assert [r["violations"] for r in quality.primary_key_report(df, ["a", "b"]).collect()] == [1, 0, 1]


RULES = [
    quality.Expectation("known", "v IS NOT NULL", "drop"),
    quality.Expectation("small", "v < 7"),
    quality.Expectation("even", "v % 2 = 0", "drop"),
]


def test_kept_rows_and_counts_in_one_pass(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    spark.range(20).selectExpr("CASE WHEN id % 5 = 0 THEN NULL ELSE id END AS v").repartition(3).write.parquet(source)
    df = spark.read.parquet(source)
    metrics = quality.write_expected(df, RULES, lambda rows: rows.write.parquet(out))
    assert metrics.collect() == quality.expectation_metrics(df, RULES).collect()
    kept = spark.read.parquet(out)
    assert kept.exceptAll(quality.keep_valid(df, RULES)).isEmpty() and kept.count() == quality.keep_valid(df, RULES).count()
    plan = quality.observed(df, RULES, "rules")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "CollectMetrics" in plan


def test_counts_of_a_stream(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    spark.range(20).selectExpr("id AS v").write.parquet(source)
    stream = quality.observed(spark.readStream.schema("v long").parquet(source), RULES, "rules")
    query = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "cp"))
    query = query.trigger(availableNow=True).start()
    query.awaitTermination()
    seen = [p["observedMetrics"]["rules"] for p in query.recentProgress if "rules" in p["observedMetrics"]]
    assert sum(s["_n"] for s in seen) == 20 and sum(s["_v1"] for s in seen) == 13 and spark.read.parquet(out).count() == 10


def test_a_fail_rule_still_stops_an_observed_write(spark, tmp_path):
    rules = [*RULES, quality.Expectation("never", "v < 3", "fail")]
    with pytest.raises(PySparkException, match="expectation failed: never"):
        quality.write_expected(spark.range(9).withColumnRenamed("id", "v"), rules, lambda rows: rows.write.parquet(str(tmp_path / "o")))
