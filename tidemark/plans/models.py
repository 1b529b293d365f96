"""Queries for preprocessing, training, scoring and the model registry."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidemark.operators import classify, prep, registry, score, train
from tidemark.plans import churn
from tidemark.plans.binding import (
    ALIAS_COLUMNS,
    BRONZE_SQL,
    RUN_COLUMNS,
    TAG_COLUMNS,
    VERSION_COLUMNS,
    bronze,
    orders_as,
    orders_sql,
    query,
    sql_bucket,
    table,
)
from tidemark.plans.features import _split
from tidemark.session import scratch_path

# --- preprocessing ----------------------------------------------------------


def _dummies_sql(column: str, values, source: str, drop_first: bool) -> list[str]:
    mode = f"(SELECT {column} FROM {source} WHERE {column} IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)"
    kept = values[1:] if drop_first else values
    return [
        f"CAST(COALESCE({column}, {mode}) = '{v}' AS DOUBLE) AS {prep.dummy_name(column, v)}" for v in kept
    ]


def _number_sql(column: str, source: str, scale: bool = True) -> str:
    mean, std = f"(SELECT avg({column}) FROM {source})", f"(SELECT stddev_pop(COALESCE({column}, m)) FROM {source}, (SELECT avg({column}) AS m FROM {source}))"
    filled = f"COALESCE({column}, {mean})"
    return f"round(({filled} - {mean}) / {std}, 6) AS {column}" if scale else f"round({filled}, 6) AS {column}"


_BOOLEANS = {"gender": ["Female", "Male"], "dependents": ["No", "Yes"], "paperless_billing": ["No", "Yes"]}
_CATEGORIES = {
    "contract": ["Month-to-month", "One year", "Two year", "Weekly"],
    "streaming_movies": ["No", "Yes"],
    "payment_method": ["Bank transfer (automatic)", "Electronic check", "Mailed check"],
}
_B = "b"


def _prep_sql(parts) -> str:
    return f"WITH b AS ({BRONZE_SQL}) SELECT customer_id, {', '.join(parts)} FROM b"


def _bool_parts():
    return [d for c, v in _BOOLEANS.items() for d in _dummies_sql(c, v, _B, True)]


def _cat_parts():
    return [d for c, v in _CATEGORIES.items() for d in _dummies_sql(c, v, _B, False)]


def _encode(spark, folder, spec):
    rows = bronze(spark, folder)
    out = prep.fit(rows, spec).transform(rows, keep=["customer_id"])
    return out.withColumns({c: F.round(c, 6) for c in spec.numbers})


@query("prep_boolean", _prep_sql(_bool_parts()))
def prep_boolean(spark, folder):
    return _encode(spark, folder, prep.PrepSpec(booleans=list(_BOOLEANS)))


_NUMBERS = ["monthly_charges", "tenure"]


@query("prep_numeric", _prep_sql([_number_sql(c, _B) for c in _NUMBERS]))
def prep_numeric(spark, folder):
    return _encode(spark, folder, prep.PrepSpec(numbers=_NUMBERS))


@query(
    "prep_median",
    _prep_sql([f"round(COALESCE({c}, (SELECT median({c}) FROM b)), 6) AS {c}" for c in _NUMBERS]),
)
def prep_median(spark, folder):
    return _encode(spark, folder, prep.PrepSpec(numbers=_NUMBERS, number_strategy="median", scale=False))


@query("prep_onehot", _prep_sql(_cat_parts()))
def prep_onehot(spark, folder):
    return _encode(spark, folder, prep.PrepSpec(categories=list(_CATEGORIES)))


@query("prep_all", _prep_sql([*_bool_parts(), *[_number_sql(c, _B) for c in _NUMBERS], *_cat_parts()]))
def prep_all(spark, folder):
    spec = prep.churn_spec(booleans=list(_BOOLEANS), numbers=_NUMBERS, categories=list(_CATEGORIES))
    return _encode(spark, folder, spec)


@query(
    "prep_wide",
    """SELECT c_custkey, dense_rank() OVER (ORDER BY c_name) - 1 AS c_name_index,
              dense_rank() OVER (ORDER BY c_mktsegment) - 1 AS c_mktsegment_index FROM customer""",
)
def prep_wide(spark, folder):
    """A column with a value for each row beside one of a few values, both placed by a table of values."""
    rows = table(spark, folder, "customer").select("c_custkey", "c_name", "c_mktsegment")
    fitted = prep.fit_wide(rows, prep.PrepSpec(categories=["c_name", "c_mktsegment"]))
    return fitted.indexed(rows).drop("c_name", "c_mktsegment")


# --- training ---------------------------------------------------------------

_AT = dt.datetime(2024, 2, 1)


def _tables(spark, folder) -> churn.FeatureTables:
    return churn.feature_job(bronze(spark, folder), _AT)


def _training_rows(spark, folder):
    """The training set as a written table: fitting reads it many times."""
    made = _tables(spark, folder)
    path = scratch_path(spark, "training_set")
    churn.churn_training_set(made.labels, made.features, exclude=[churn.TIME]).write.parquet(path)
    return spark.read.parquet(path)


_CLASSES = ("Yes", "No")
#: What was fitted for a folder in this session: several queries look at the same model.
_FITTED: dict[tuple, object] = {}


def _once(spark, folder, name, make):
    key = (spark.sparkContext.applicationId, folder, name)
    if key not in _FITTED:
        _FITTED[key] = make()
    return _FITTED[key]


def _split_rows(spark, folder):
    """The training set and its two parts."""
    rows = _once(spark, folder, "rows", lambda: _training_rows(spark, folder))
    return rows, *[rows.filter(F.col("split") == s).drop("split") for s in ("train", "test")]


def _boosted(spark, folder):
    """The boosted trees of the fixed parameters."""
    _, rows, _ = _split_rows(spark, folder)
    args = (prep.churn_spec(), churn.LABEL, *_CLASSES, "GradientBoosting", train.GBT_DEFAULTS)
    return _once(spark, folder, "boosted", lambda: train.fit_model(rows, *args))


def _searched(spark, folder):
    """Eight trials over all families and their whole ranges."""
    _, rows, _ = _split_rows(spark, folder)
    args = (prep.churn_spec(), [churn.KEY], churn.LABEL, *_CLASSES, train.draw_trials(8))
    return _once(spark, folder, "search", lambda: train.search(rows, *args))


# A model's numbers depend on what it has learnt. What SQL can state are facts that hold for any: which rows it
# scored, that chances are chances, that the likelier class is predicted, and that its metrics are those of its predictions.
_LEARNT = f"""l AS (SELECT customer_id, {_split(sql_bucket(['customer_id'], 42))} AS split
    FROM ({BRONZE_SQL}) WHERE customer_id IS NOT NULL AND churn IS NOT NULL)"""


def _facts_sql(where="true", head="", measured=True):
    zeros = ["chances outside 0 to 1", "predictions of the lesser chance"] + ["metrics counted otherwise"] * measured
    return f"""SELECT '{head}rows' AS fact, CAST(count(*) AS VARCHAR) AS value FROM l WHERE {where}
        UNION ALL SELECT '{head}keys', CAST(count(DISTINCT customer_id) AS VARCHAR) FROM l WHERE {where}""" + "".join(
        f" UNION ALL SELECT '{head}{z}', '0'" for z in zeros
    )


def _facts(spark, rows):
    return spark.createDataFrame([(fact, str(value)) for fact, value in rows], "fact string, value string")


def _scored_facts(scored, metrics=None, prefix="", head=""):
    """The facts of scored rows, and of their metrics if given."""
    chance = F.col("probability")
    wrong = F.col("prediction") != F.when(chance > 0.5, _CLASSES[0]).otherwise(_CLASSES[1])
    counts = scored.agg(
        F.count(F.lit(1)), F.countDistinct(churn.KEY), F.count_if(~chance.between(0, 1)),
        F.count_if(wrong & (F.abs(chance - 0.5) > 1e-9)),
    ).first()
    names = ["rows", "keys", "chances outside 0 to 1", "predictions of the lesser chance"]
    out = [(head + n, v) for n, v in zip(names, counts)]
    if metrics is not None:
        found = {r["metric"]: r["value"] for r in metrics.collect()}
        cells = {(r[churn.LABEL], r["prediction"]): r["count"] for r in scored.groupBy(churn.LABEL, "prediction").count().collect()}
        hits, yes, no = (cells.get(k, 0) for k in (("Yes", "Yes"), ("Yes", "No"), ("No", "Yes")))
        total = sum(cells.values())
        right = {
            "accuracy_score": (hits + cells.get(("No", "No"), 0)) / total,
            "f1_score": 2 * hits / (2 * hits + yes + no) if hits else 0.0,
            "example_count": total,
        }
        out.append((f"{head}metrics counted otherwise", sum(abs(found[prefix + m] - v) > 1e-9 for m, v in right.items())))
    return out


def _evaluated(scored, prefix):
    return classify.evaluate(scored, churn.LABEL, "prediction", "Yes", prefix, "probability")


@query("train_gbt", f"WITH {_LEARNT} " + _facts_sql("split = 'test'"))
def train_gbt(spark, folder):
    """250 rounds of trees eight levels deep."""
    scored = _boosted(spark, folder).score(_split_rows(spark, folder)[2]).persist()
    return _facts(spark, _scored_facts(scored, _evaluated(scored, "test_"), "test_"))


@query(
    "train_families",
    f"WITH {_LEARNT} " + " UNION ALL ".join(_facts_sql("split = 'test'", f"{f}: ") for f in train.FAMILIES),
)
def train_families(spark, folder):
    """A model of each family, at the first point that the search draws for it."""
    _, rows, held = _split_rows(spark, folder)
    out = []
    for family in train.FAMILIES:
        trial = next(t for t in train.draw_trials(64) if t["family"] == family)
        model = train.fit_best(rows, prep.churn_spec(), churn.LABEL, *_CLASSES, trial)
        scored = model.score(held).persist()
        out += _scored_facts(scored, _evaluated(scored, "test_"), "test_", f"{family}: ")
    return _facts(spark, out)


@query(
    "hpo_trials",
    """SELECT 'trials' AS fact, '8' AS value UNION ALL SELECT 'complete', '8' UNION ALL SELECT 'scores outside 0 to 1', '0'
       UNION ALL SELECT 'parameters out of range', '0' UNION ALL SELECT 'better than the best', '0'""",
)
def hpo_trials(spark, folder):
    found = _searched(spark, folder)
    trials = found.trials.collect()
    out_of_range = sum(
        not limit.low <= t["params"][name] <= limit.high
        for t in trials
        for name, limit in train.SEARCH_SPACE[t["family"]].items()
    )
    best = next(t["value"] for t in trials if t["trial"] == found.best["trial"])
    return _facts(
        spark,
        [
            ("trials", len(trials)),
            ("complete", sum(t["state"] == "COMPLETE" for t in trials)),
            ("scores outside 0 to 1", sum(not 0 <= t["value"] <= 1 for t in trials)),
            ("parameters out of range", out_of_range),
            ("better than the best", sum(t["value"] > best for t in trials)),
        ],
    )


@query("train_best", f"WITH {_LEARNT} " + _facts_sql("split = 'train'", measured=False))
def train_best(spark, folder):
    """The best trial fitted again on the whole training part."""
    _, rows, _ = _split_rows(spark, folder)
    model = train.fit_best(rows, prep.churn_spec(), churn.LABEL, *_CLASSES, _searched(spark, folder).best)
    return _facts(spark, _scored_facts(model.score(rows).persist()))


@query(
    "training_job",
    f"WITH {_LEARNT} "
    + " UNION ALL ".join(_facts_sql(f"split = '{s}'", f"{s}: ") for s in ("train", "test"))
    + " UNION ALL SELECT 'trials', '8' UNION ALL SELECT 'metrics logged', '24'",
)
def training_job(spark, folder):
    rows, *parts = _split_rows(spark, folder)
    job = train.training_job(rows, prep.churn_spec(), [churn.KEY], churn.LABEL, *_CLASSES)
    out = []
    for name, prefix, part in zip(("train", "test"), ("training_", "test_"), parts):
        out += _scored_facts(job.model.score(part).persist(), job.metrics, prefix, f"{name}: ")
    logged = registry.log_metrics(job.metrics, "run-1", "churn", "search", _AT).count()
    return _facts(spark, [*out, ("trials", job.trials.count()), ("metrics logged", logged)])


@query(
    "topk_importance",
    """SELECT 'features' AS fact, '20' AS value UNION ALL SELECT 'below the next', '0'
       UNION ALL SELECT 'negative', '0' UNION ALL SELECT 'total but 0 or 1', '0'""",
)
def topk_importance(spark, folder):
    every = _boosted(spark, folder).importances(spark)
    top = [r["importance"] for r in train.top_importances(every, 20).collect()]
    total = every.agg(F.round(F.sum("importance"), 6)).first()[0]
    below = sum(a < b for a, b in zip(top, top[1:]))
    return _facts(spark, [("features", len(top)), ("below the next", below), ("negative", sum(v < 0 for v in top)), ("total but 0 or 1", int(total not in (0, 1)))])


@query(
    "score_batch",
    f"""WITH l AS (SELECT customer_id FROM ({BRONZE_SQL}) WHERE customer_id IS NOT NULL) {_facts_sql(measured=False)}
        UNION ALL SELECT 'price increases', CAST(count(*) AS VARCHAR) FROM l""",
)
def score_batch(spark, folder):
    """Features looked up for the keys, the function applied, and all of it scored."""
    made = _tables(spark, folder)
    trial = next(t for t in train.draw_trials(64) if t["family"] == "LogisticRegression")
    model = train.fit_best(_split_rows(spark, folder)[1], prep.churn_spec(), churn.LABEL, *_CLASSES, trial)
    scored = score.score_batch(made.labels.select(churn.KEY, churn.TIME), churn.churn_lookups(made.features), model).persist()
    return _facts(spark, [*_scored_facts(scored), ("price increases", scored.filter("avg_price_increase IS NOT NULL").count())])


@query(
    "score_udf",
    """SELECT c_custkey, CASE WHEN c_acctbal / (c_nationkey + 1) > 300 THEN 'Yes' ELSE 'No' END AS prediction
       FROM customer""",
)
def score_udf(spark, folder):
    def load():
        """A plain Python model: the balance per nation step decides."""
        return lambda rows: (rows["c_acctbal"] / (rows["c_nationkey"] + 1) > 300).map({True: "Yes", False: "No"})

    customers = table(spark, folder, "customer")
    scored = score.score_with(customers, load, ["c_acctbal", "c_nationkey"])
    return scored.select("c_custkey", "prediction")


# --- registry ---------------------------------------------------------------

_RUNS, _VERSIONS = orders_sql(RUN_COLUMNS), orders_sql(VERSION_COLUMNS)
_ALIASES, _TAGS = orders_sql(ALIAS_COLUMNS), orders_sql(TAG_COLUMNS)


@query(
    "runs_log",
    f"""WITH m AS (SELECT CASE WHEN churn = 'Yes' THEN 'churned' ELSE 'stayed' END AS kind, monthly_charges AS c
                   FROM ({BRONZE_SQL}))
        SELECT 'run-7' AS run_id, 'churn' AS experiment, 'profile' AS run_name,
               TIMESTAMP '2024-02-01 00:00:00' AS start_time, kind AS metric, round(avg(c), 9) AS value FROM m
        GROUP BY kind""",
)
def runs_log(spark, folder):
    kind = F.when(F.col("churn") == "Yes", "churned").otherwise("stayed").alias("metric")
    metrics = bronze(spark, folder).groupBy(kind).agg(F.round(F.avg("monthly_charges"), 9).alias("value"))
    out = registry.log_metrics(metrics, "run-7", "churn", "profile", _AT)
    return out.withColumn("start_time", F.col("start_time").cast("timestamp_ntz"))


@query(
    "best_run",
    f"""SELECT * FROM ({_RUNS}) WHERE experiment = '1-URGENT' AND metric = 'test_f1_score'
        ORDER BY value DESC NULLS LAST, run_id LIMIT 1""",
)
def best_run(spark, folder):
    return registry.best_run(orders_as(spark, folder, RUN_COLUMNS), "1-URGENT", "test_f1_score")


@query(
    "latest_run",
    f"""SELECT DISTINCT run_id, experiment, run_name, start_time FROM ({_RUNS})
        WHERE experiment = '1-URGENT' AND run_name = 'F' ORDER BY start_time DESC NULLS LAST, run_id LIMIT 1""",
)
def latest_run(spark, folder):
    return registry.latest_run(orders_as(spark, folder, RUN_COLUMNS), "1-URGENT", "F")


_NEW_MODELS = ["concat('model-', CAST(c_custkey AS STRING)) AS model", "c_mktsegment AS description"]


@query(
    "register_version",
    f"""SELECT m.model, m.description, COALESCE(t.top, 0) + 1 AS version
        FROM (SELECT {', '.join(_NEW_MODELS)} FROM customer) m
        LEFT JOIN (SELECT model, max(version) AS top FROM ({_TAGS}) GROUP BY 1) t ON m.model = t.model""",
)
def register_version(spark, folder):
    versions = orders_as(spark, folder, TAG_COLUMNS).select("model", "version")
    new = table(spark, folder, "customer").selectExpr(*_NEW_MODELS)
    return registry.next_versions(versions, new)


_RESOLVED = f"""SELECT model, alias, version FROM ({_ALIASES})
    QUALIFY row_number() OVER (PARTITION BY model, alias ORDER BY assigned_at DESC, version DESC) = 1"""


@query("resolve_alias", _RESOLVED)
def resolve_alias(spark, folder):
    return registry.resolve_aliases(orders_as(spark, folder, ALIAS_COLUMNS))


_CURRENT_TAGS = f"""SELECT model, version, key, value FROM ({_TAGS})
    QUALIFY row_number() OVER (PARTITION BY model, version, key ORDER BY set_at DESC, value DESC) = 1"""


@query("version_tags", _CURRENT_TAGS)
def version_tags(spark, folder):
    return registry.current_tags(orders_as(spark, folder, TAG_COLUMNS))


_GATES = f"""
    r AS ({_RUNS}), v AS ({_VERSIONS}), a AS ({_RESOLVED}),
    s AS (SELECT v.model, v.version, v.description, r.value FROM v LEFT JOIN r ON v.run_id = r.run_id),
    bar AS (SELECT s.model, s.value AS bar FROM s JOIN a ON s.model = a.model AND s.version = a.version
            WHERE a.alias = 'Champion'),
    j AS (SELECT s.*, bar.bar FROM s LEFT JOIN bar ON s.model = bar.model),
    gates AS (
      SELECT model, version, 'has_description' AS "check", length(COALESCE(description, '')) >= 20 AS passed FROM j
      UNION ALL SELECT model, version, 'metric_test_f1_score_passed', COALESCE(value >= 0.3, false) FROM j
      UNION ALL SELECT model, version, 'champion_challenger_passed', bar IS NULL OR value >= bar FROM j)"""


def _gates(spark, folder):
    return registry.gate_checks(
        orders_as(spark, folder, VERSION_COLUMNS),
        orders_as(spark, folder, RUN_COLUMNS),
        orders_as(spark, folder, ALIAS_COLUMNS),
        "test_f1_score",
        min_value=0.3,
    )


@query("gate_checks", f"WITH {_GATES} SELECT * FROM gates")
def gate_checks(spark, folder):
    return _gates(spark, folder).drop("message")


@query(
    "gate_summary",
    f"""WITH {_GATES} SELECT model, version, bool_and(passed) AS all_passed,
        CAST(count_if(NOT passed) AS BIGINT) AS failed_checks,
        CASE WHEN bool_and(passed) THEN 'Approved' ELSE 'Failed' END AS "Approval_Check" FROM gates GROUP BY 1, 2""",
)
def gate_summary(spark, folder):
    return registry.gate_summary(_gates(spark, folder))


@query(
    "promotion",
    f"""WITH {_GATES}, ok AS (SELECT model, version FROM gates GROUP BY 1, 2 HAVING bool_and(passed))
        SELECT model, 'Champion' AS alias, max(version) AS version FROM ok GROUP BY 1""",
)
def promotion(spark, folder):
    tags = registry.gate_tags(_gates(spark, folder), _AT)
    return registry.promotions(tags, _AT).drop("assigned_at")
