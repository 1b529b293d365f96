import datetime as dt
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import Observation
from pyspark.sql import functions as F

from tidemark.operators import prep, registry, score, train
from tidemark.operators.lookup import FeatureLookup
from tidemark.operators.prep import PrepSpec


def values(df):
    return [tuple(r) for r in df.collect()]


def test_booleans(spark):
    df = spark.createDataFrame([("Yes",), ("No",), (None,), ("Yes",)], "a string")
    fitted = prep.fit(df, PrepSpec(booleans=["a"]))
    assert fitted.feature_names() == ["a_Yes"] and values(fitted.transform(df)) == [(1.0,), (0.0,), (1.0,), (1.0,)]
    constant = prep.fit(df.filter("a = 'Yes'"), PrepSpec(booleans=["a"]))
    assert constant.feature_names() == []


def test_most_frequent_tie_takes_the_smallest(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,)], "x string")
    assert values(prep.fit(df, PrepSpec(categories=["x"])).transform(df)) == [(0.0, 1.0), (1.0, 0.0), (1.0, 0.0)]


def test_numbers(spark):
    df = spark.createDataFrame([("10",), (None,), ("30",), ("junk",)], "a string")
    assert values(prep.fit(df, PrepSpec(numbers=["a"], scale=False)).transform(df)) == [(10.0,), (20.0,), (30.0,), (20.0,)]
    scaled = [r[0] for r in values(prep.fit(df, PrepSpec(numbers=["a"])).transform(df))]
    assert sum(scaled) == pytest.approx(0) and sum(s * s for s in scaled) / 4 == pytest.approx(1)
    median = prep.fit(df, PrepSpec(numbers=["a"], number_strategy="constant", fill_value=5))
    row = [r[0] for r in values(median.transform(df))]
    assert sum(row) == pytest.approx(0) and sum(s * s for s in row) / 4 == pytest.approx(1)
    flat = spark.createDataFrame([(3.0,), (3.0,)], "a double")
    assert values(prep.fit(flat, PrepSpec(numbers=["a"])).transform(flat)) == [(0.0,), (0.0,)]


@pytest.mark.parametrize("strategy, fill", [("median", 2.5), ("most_frequent", 1.0)])
def test_number_strategies(spark, strategy, fill):
    df = spark.createDataFrame([(1.0,), (1.0,), (4.0,), (9.0,), (None,)], "a double")
    assert prep.fit(df, PrepSpec(numbers=["a"], number_strategy=strategy, scale=False)).numbers["a"][0] == fill


def test_categories_unknown_wide_and_saved(spark):
    df = spark.createDataFrame([("a",), ("b",)], "x string")
    fitted = prep.fit(df, PrepSpec(categories=["x"]))
    again = prep.FittedPrep.from_json(fitted.to_json())
    assert values(again.transform(spark.createDataFrame([("c",), ("b",)], "x string"))) == [(0.0, 0.0), (0.0, 1.0)]
    with pytest.raises(ValueError, match="more than 1 categories"):
        prep.fit(df, PrepSpec(categories=["x"], max_categories=1))
    strict = prep.fit(df, PrepSpec(categories=["x"], handle_unknown="error"))
    with pytest.raises(PySparkException, match="unknown category in x: c"):
        strict.transform(spark.createDataFrame([("c",)], "x string")).collect()


def test_remainder(spark):
    df = spark.createDataFrame([("a", 1, "k")], "x string, n int, other string")
    spec = PrepSpec(categories=["x"], numbers=["n"], scale=False)
    assert prep.fit(df, spec).transform(df).columns == ["n", "x_a"]
    kept = PrepSpec(categories=["x"], numbers=["n"], scale=False, remainder="passthrough")
    assert prep.fit(df, kept).transform(df).columns == ["n", "x_a", "other"]


WIDE = PrepSpec(booleans=["b"], numbers=["n"], categories=["x", "y"])


def wide_rows(spark):
    rows = [("Yes", 1.0, "v1", None), ("No", None, None, "q"), (None, 4.0, "v0", "p"), ("Yes", 2.0, "v1", "p")]
    return spark.createDataFrame(rows, "b string, n double, x string, y string")


@pytest.mark.parametrize("spec", [WIDE, PrepSpec(**{**WIDE.__dict__, "category_strategy": "constant", "drop_first": False})])
def test_a_wide_encoder_gives_the_same_numbers(spark, spec):
    df = wide_rows(spark)
    narrow, wide = prep.fit(df, spec), prep.fit_wide(df, spec)
    new = df.unionByName(spark.createDataFrame([("?", 0.0, "unseen", "q")], df.schema))
    want = [r["features"].toArray().tolist() for r in narrow.assemble(new).collect()]
    got = [r["features"] for r in wide.assemble(new).collect()]
    assert [v.toArray().tolist() for v in got] == want and wide.size() == len(want[0]) == len(narrow.feature_names())
    again = prep.WidePrep.from_json(wide.to_json())
    assert [r["features"] for r in again.assemble(new).collect()] == got
    with pytest.raises(PySparkException, match="unknown category in"):
        prep.fit_wide(df, PrepSpec(categories=["x"], handle_unknown="error")).assemble(new).collect()


def test_a_million_values_stay_off_the_driver(spark, monkeypatch):
    n, collected = 1_000_000, []
    df = spark.range(n).selectExpr("id", "md5(cast(id AS string)) AS x", "cast(id % 3 AS string) AS y")
    collect = type(df).collect
    monkeypatch.setattr(type(df), "collect", lambda self: (lambda rows: collected.append(len(rows)) or rows)(collect(self)))
    wide = prep.fit_wide(df, PrepSpec(categories=["x", "y"]))
    monkeypatch.undo()
    assert wide.sizes == {"x": n, "y": 3} and max(collected) < 100
    row = wide.with_vector(df.filter("id = 17")).first()["features"]
    place = df.filter(F.col("x") < df.filter("id = 17").first()["x"]).count()
    assert row.size == n + 3 and row.indices.tolist() == [place, n + 2] and row.values.tolist() == [1.0, 1.0]
    places = wide.values(spark).filter("column_name = 'x'").agg(F.countDistinct("place"), F.min("place"), F.max("place")).first()
    assert tuple(places) == (n, 0, n - 1)


def test_a_model_on_a_wide_encoder(easy):
    rows = easy.filter("split = 'train'")
    fitted = prep.fit_wide(rows, SPEC)
    model = train.fit_model(rows, SPEC, "y", "Yes", "No", "LogisticRegression", {"C": 1.0}, fitted=fitted)
    scored = model.score(easy.filter("split = 'test'"))
    assert scored.columns == [*easy.columns, "probability", "prediction"]
    assert scored.filter("prediction = y").count() / scored.count() > 0.85


@pytest.fixture(scope="module")
def easy(spark):
    rng = random.Random(1)
    rows = []
    for i in range(400):
        x, kind = rng.random(), rng.choice("ab")
        rows.append((i, x, kind, "Yes" if x + (kind == "a") * 0.2 > 0.6 else "No", "train" if i % 5 else "test"))
    return spark.createDataFrame(rows, "id int, x double, kind string, y string, split string").cache()


SPEC = PrepSpec(numbers=["x"], categories=["kind"])


@pytest.mark.parametrize(
    "family, params",
    [
        ("LogisticRegression", {"C": 1.0, "tol": 1e-4}),
        ("RandomForest", {"n_estimators": 10, "max_depth": 4}),
        ("GradientBoosting", {"n_estimators": 4, "max_depth": 3, "learning_rate": 0.5, "max_bin": 32}),
    ],
)
def test_families_learn_and_repeat(easy, family, params):
    rows = easy.filter("split = 'train'")
    one = train.fit_model(rows, SPEC, "y", "Yes", "No", family, params)
    scored = one.score(easy.filter("split = 'test'"))
    assert scored.columns == [*easy.columns, "probability", "prediction"]
    assert scored.filter("prediction = y").count() / scored.count() > 0.85
    two = train.fit_model(rows, SPEC, "y", "Yes", "No", family, params)
    left, right = (m.score(easy).select("id", "prediction") for m in (one, two))
    assert left.exceptAll(right).isEmpty()
    with pytest.raises(ValueError, match="unknown classifier"):
        train.classifier("Other", {}, 1)


@pytest.mark.parametrize("family, params", [("LogisticRegression", {"C": 1.0}), ("RandomForest", {"n_estimators": 3, "max_depth": 2})])
def test_models_score_in_a_session_that_has_observed(easy, spark, family, params):
    seen = Observation("seen")
    spark.range(3).observe(seen, F.count(F.lit(1)).alias("rows")).collect()
    assert seen.get == {"rows": 3}
    model = train.fit_model(easy, SPEC, "y", "Yes", "No", family, params)
    assert model.score(easy).filter("probability IS NULL").count() == 0
    found = train.search(easy, SPEC, ["id"], "y", "Yes", "No", [{"trial": 0, "family": family, **params}])
    assert found.trials.first()["state"] == "COMPLETE"


def test_training_job(easy, spark):
    space = {"LogisticRegression": train.SEARCH_SPACE["LogisticRegression"]}
    job = train.training_job(easy, SPEC, ["id"], "y", "Yes", "No", trials=2, families=["LogisticRegression"], space=space)
    metrics = {r["metric"]: r["value"] for r in job.metrics.collect()}
    assert metrics["test_f1_score"] > 0.8 and metrics["training_roc_auc"] > 0.9 and metrics["test_example_count"] == 80
    trials = job.trials.collect()
    assert [t["state"] for t in trials] == ["COMPLETE", "COMPLETE"]
    assert train.top_importances(job.model.importances(spark)).isEmpty()


def test_search_records_a_failed_trial(easy):
    bad = {"trial": 0, "family": "RandomForest", "n_estimators": -1, "max_depth": 3}
    good = {"trial": 1, "family": "LogisticRegression", "C": 1.0}
    found = train.search(easy, SPEC, ["id"], "y", "Yes", "No", [bad, good])
    states = {r["trial"]: r["state"] for r in found.trials.collect()}
    assert states[0].startswith("FAIL") and states[1] == "COMPLETE" and found.best == good


def test_trials_are_seeded_and_in_range():
    one, two = train.draw_trials(30, 5), train.draw_trials(30, 5)
    assert one == two and one != train.draw_trials(30, 6)
    for trial in one:
        for name, limit in train.SEARCH_SPACE[trial["family"]].items():
            assert limit.low <= trial[name] <= limit.high


def test_score_batch_looks_features_up(easy, spark):
    model = train.fit_model(easy, SPEC, "y", "Yes", "No", "LogisticRegression", {"C": 1.0})
    keys = easy.select("id").limit(10)
    lookup = FeatureLookup(easy.select("id", "x", "kind"), ["id"])
    scored = score.score_batch(keys, [lookup], model)
    assert scored.count() == 10 and dict(scored.dtypes)["prediction"] == "string"
    assert score.can_score(keys, lambda df: score.score_batch(df, [lookup], model)) == (True, "Scored 10 rows successfully.")
    ok, text = score.can_score(keys, lambda df: score.score_batch(df, [], model))
    assert not ok and text.startswith("Inference failed")


def test_score_with_python_model(spark):
    df = spark.createDataFrame([(1, 2.0), (2, 5.0)], "a int, b double")
    out = score.score_with(df, lambda: lambda rows: rows["b"] * 2, ["b"], "double")
    assert [r["prediction"] for r in out.orderBy("a").collect()] == [4.0, 10.0]
    both = score.score_with(df, lambda: lambda rows: rows["a"] + rows["b"], ["a", "b"], "double")
    assert [r["prediction"] for r in both.orderBy("a").collect()] == [3.0, 7.0]


# --- registry ---------------------------------------------------------------

T0 = dt.datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def store(spark):
    long = "a description of more than twenty characters"
    runs = [("r1", 0.7), ("r2", 0.8), ("r3", 0.6)]
    run_rows = None
    for i, (run, f1) in enumerate(runs):
        part = registry.log_run(spark, run, "exp", "search", T0 + dt.timedelta(hours=i), {"f1": f1, "loss": 1.0})
        run_rows = part if run_rows is None else run_rows.unionByName(part)
    versions = spark.createDataFrame(
        [("m", 1, "r1", long, T0), ("m", 2, "r2", long, T0), ("m", 3, "r3", "short", T0), ("new", 1, "r4", long, T0)],
        "model string, version long, run_id string, description string, created timestamp",
    )
    aliases = registry.assign_alias(spark, "m", "Champion", 3, T0).unionByName(
        registry.assign_alias(spark, "m", "Champion", 1, T0 + dt.timedelta(1))
    )
    return run_rows, versions, aliases


def test_runs_versions_aliases(spark, store):
    runs, versions, aliases = store
    assert registry.best_run(runs, "exp", "f1").first()["run_id"] == "r2"
    assert registry.latest_run(runs, "exp", "search").first()["run_id"] == "r3"
    assert registry.resolve_aliases(aliases).first()["version"] == 1
    new = spark.createDataFrame([("m", "x"), ("fresh", "y")], "model string, description string")
    assert {r["model"]: r["version"] for r in registry.next_versions(versions, new).collect()} == {"m": 4, "fresh": 1}


def test_gates_and_promotion(spark, store):
    runs, versions, aliases = store
    gates = registry.gate_checks(versions, runs, aliases, "f1", min_value=0.65)
    got = {(r["model"], r["version"], r["check"]): (r["passed"], r["message"]) for r in gates.collect()}
    assert got["m", 3, "has_description"][0] is False
    assert got["m", 2, "champion_challenger_passed"] == (True, "f1 0.8000, Champion has 0.7000")
    assert got["m", 3, "champion_challenger_passed"][0] is False
    assert got["new", 1, "metric_f1_passed"] == (False, "the run behind this version has no value of f1")
    assert got["new", 1, "champion_challenger_passed"][0] is False
    tags = registry.gate_tags(gates, T0)
    summary = {(r["model"], r["version"]): r["Approval_Check"] for r in registry.gate_summary(gates).collect()}
    assert summary["m", 2] == "Approved" and summary["m", 3] == "Failed"
    assert [r["version"] for r in registry.promotions(tags, T0).collect()] == [2]
    registry.require_approval(tags, "m", 2)
    with pytest.raises(ValueError, match="not approved"):
        registry.require_approval(tags, "m", 3)
    with pytest.raises(ValueError, match="no tag"):
        registry.require_approval(tags, "m", 9)


def test_no_champion(spark, store):
    runs, versions, aliases = store
    name = "champion_challenger_passed"
    lone = versions.filter("version = 2")
    for flag in (True, False):
        gates = registry.gate_checks(lone, runs, aliases.limit(0), "f1", accept_if_no_champion=flag)
        assert gates.filter(F.col("check") == name).first()["passed"] is flag


def test_tags_latest_wins_and_are_text(spark):
    tags = registry.set_tags(spark, "m", 1, {"ok": True, "n": 3}, T0).unionByName(
        registry.set_tags(spark, "m", 1, {"ok": False}, T0 + dt.timedelta(1))
    )
    assert {r["key"]: r["value"] for r in registry.current_tags(tags).collect()} == {"ok": "False", "n": "3"}


def test_value_gate(spark):
    df = spark.createDataFrame(
        [("a", "Challenger", 5.0), ("a", "Champion", 6.0), ("b", "Challenger", 1.0), ("c", "Champion", 1.0)],
        "model string, alias string, value double",
    )
    assert {r["model"]: r["passed"] for r in registry.value_gate(df).collect()} == {"a": False, "b": True, "c": False}
