import datetime as dt
import math

import pytest
from pyspark.errors import PySparkException

from tidemark.functions import columns
from tidemark.functions.columns import FeatureFunction, snake_case
from tidemark.plans import churn


@pytest.mark.parametrize(
    "raw, clean",
    [
        ("MonthlyCharges", "monthly_charges"),
        ("StreamingTV", "streaming_tv"),
        ("CustomerID", "customer_id"),
        ("customerID", "customer_id"),
        ("Payment Method", "payment_method"),
        ("already_snake", "already_snake"),
        ("Fee (USD)", "fee_usd"),
        ("a--b__c", "a_b_c"),
        ("streaming_t_v", "streaming_tv"),
    ],
)
def test_snake_case(raw, clean):
    assert snake_case(raw) == clean


def test_column_clash_is_an_error(spark):
    with pytest.raises(ValueError, match="collide"):
        columns.normalize_columns(spark.createDataFrame([(1, 2)], ["FooBar", "foo_bar"]))


def test_build_features_on_the_three_customers(customers):
    rows = {r["customer_id"]: r for r in churn.build_features(customers, dt.datetime(2024, 1, 1)).collect()}
    assert [rows[c]["num_optional_services"] for c in ("C001", "C002", "C003")] == [1.0, 4.0, 0.0]
    assert [rows[c]["senior_citizen"] for c in ("C001", "C002", "C003")] == ["No", "Yes", "No"]
    assert [rows[c]["tenure"] for c in ("C001", "C002", "C003")] == [12.0, 0.0, 5.0]
    assert [rows[c]["monthly_charges"] for c in ("C001", "C002", "C003")] == [29.85, 56.95, 0.0]
    assert [rows[c]["total_charges"] for c in ("C001", "C002", "C003")] == [358.5, 0.0, 42.3]
    assert len({r["transaction_ts"] for r in rows.values()}) == 1


@pytest.mark.parametrize("flags, count", [(["Yes"] * 6, 6.0), (["No"] * 6, 0.0), ([None] * 6, 0.0)])
def test_count_flags(spark, flags, count):
    names = churn.OPTIONAL_SERVICES
    df = spark.createDataFrame([tuple(flags)], ", ".join(f"{n} string" for n in names))
    row = churn.add_service_count(df).first()
    assert row["num_optional_services"] == count and isinstance(row["num_optional_services"], float)


def test_parse_number(spark):
    df = spark.createDataFrame([(" 1.5 ",), ("\t",), (None,), ("junk",)], "x string")
    assert [r[0] for r in df.select(columns.parse_number("x", strict=False)).collect()] == [1.5, 0.0, 0.0, 0.0]
    with pytest.raises(PySparkException, match="not a number in x"):
        df.select(columns.parse_number("x")).collect()


def test_fill_treats_nan_as_missing_and_keeps_types(spark):
    df = spark.createDataFrame([(math.nan, None), (2.0, 3)], "a double, b int")
    out = columns.fill_missing(df, {"a": 0.0, "b": 7})
    assert [tuple(r) for r in out.collect()] == [(0.0, 7), (2.0, 3)] and out.dtypes == df.dtypes


def test_recode_unknown_is_null(spark):
    df = spark.createDataFrame([(1,), (0,), (5,), (None,)], "x int")
    assert [r[0] for r in df.select(columns.recode("x", {"1": "Yes", "0": "No"})).collect()] == ["Yes", "No", None, None]


def test_price_increase_function(spark):
    df = spark.createDataFrame(
        [(50.0, 10.0, 400.0), (50.0, 0.0, 0.0), (50.0, None, 10.0)],
        "monthly_charges double, tenure double, total_charges double",
    )
    out = churn.PRICE_INCREASE.apply(df)
    assert [r["avg_price_increase"] for r in out.collect()] == [10.0, 0.0, 0.0]
    assert dict(out.dtypes)["avg_price_increase"] == "float"


def test_unbound_argument_is_an_error(spark):
    with pytest.raises(ValueError, match="no column bound"):
        FeatureFunction(columns.AVG_PRICE_INCREASE, {}, "x").apply(spark.range(1))


def test_select_except_and_literals(spark):
    df = columns.add_literals(spark.range(1), {"model": "m", "version": 3})
    assert columns.select_except(df, ["id"]).columns == ["model", "version"]
    with pytest.raises(ValueError):
        columns.select_except(df, ["nope"])


def test_snapshot_defaults_to_one_time_for_all_rows(spark):
    assert columns.add_snapshot(spark.range(5)).select("transaction_ts").distinct().count() == 1


def test_cleaning_and_checks_run_without_python_workers(customers):
    from tidemark.operators import quality

    kept, metrics = churn.silver_features(customers)
    report = quality.schema_report(customers, churn.BRONZE_RULES)
    checks = quality.run_checks(kept, churn.feature_checks(kept))
    for df in (kept, metrics, report, checks, churn.PRICE_INCREASE.apply(kept)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "ArrowEvalPython" not in plan and "BatchEvalPython" not in plan


def test_ordered_limit_is_a_top_k(spark):
    plan = columns.ordered_limit(spark.range(1000), 5, "id")._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan
