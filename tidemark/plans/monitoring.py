"""Queries for profiles, model quality and drift."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import classify, drift, profile
from tidemark.plans import churn
from tidemark.plans.binding import LOG_SQL, inference_log, query, table

MONITOR = churn.CHURN_MONITOR
WATCHED = ["prediction", "churn"]

# The log once per (model or '*') and slice, as the profile tables see it.
_DAY = "date_trunc('day', inference_timestamp)"
_GROUPS = f"""
    log AS (SELECT *, CAST({_DAY} AS TIMESTAMP) AS window_start FROM ({LOG_SQL})),
    by_model AS (SELECT * REPLACE ('*' AS model_version) FROM log UNION ALL SELECT * FROM log),
    g AS (SELECT *, NULL::VARCHAR AS slice_key, NULL::VARCHAR AS slice_value FROM by_model
          UNION ALL SELECT *, 'contract', contract FROM by_model
          UNION ALL SELECT *, 'monthly_charges > 30', CAST(monthly_charges > 30 AS VARCHAR) FROM by_model
            WHERE monthly_charges IS NOT NULL)"""
_KEYS = "window_start, model_version, slice_key, slice_value"


def _flat(df, *rounded):
    """Results without the window end, numbers rounded for comparison.

    Means of amounts get more digits than ratios: with few, a mean of cents often lies
    halfway between two roundings, and the order of summing would decide.
    """
    digits = {c: 9 if c in _MEANS else 6 for c in rounded}
    return df.drop("window_end").withColumns({c: F.round(c, d) for c, d in digits.items()})


_MEANS = {"avg", "stddev", "expected_loss", "value"}


@query(
    "daily_counts",
    "SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS window_start, event_type, count(*) AS n FROM events GROUP BY ALL",
)
def daily_counts(spark, folder):
    counts = profile.window_counts(table(spark, folder, "events"), "ts", by=["event_type"])
    return counts.select(F.col("window.start").alias("window_start"), "event_type", "n")


@query("profile_slices", f"WITH {_GROUPS} SELECT {_KEYS}, count(*) AS n FROM g GROUP BY ALL")
def profile_slices(spark, folder):
    base = profile.with_grain(inference_log(spark, folder), MONITOR).groupBy(*MONITOR.grain)
    rows = profile.expand(base.agg(F.count(F.lit(1)).alias("n")), MONITOR)
    return _flat(profile.publish(rows.groupBy(*profile.GROUP).agg(F.sum("n").alias("n"))))


def _numeric_sql(column: str) -> str:
    return f"""SELECT {_KEYS}, '{column}' AS column_name, count(*) AS count,
        count(*) - count({column}) AS num_nulls,
        100.0::DOUBLE * (count(*) - count({column})) / count(*) AS percent_null,
        avg({column}) AS avg, stddev_pop({column}) AS stddev,
        min({column}) AS min, max({column}) AS max FROM g GROUP BY {_KEYS}"""


_NUMERIC = f"p AS ({_numeric_sql('monthly_charges')} UNION ALL {_numeric_sql('tenure')})"


@query(
    "profile_numeric",
    f"""WITH {_GROUPS}, {_NUMERIC} SELECT * REPLACE (round(percent_null, 6) AS percent_null, round(avg, 9) AS avg,
        round(stddev, 9) AS stddev) FROM p""",
)
def profile_numeric(spark, folder):
    return _flat(profile.profile_numeric(inference_log(spark, folder), MONITOR), "percent_null", "avg", "stddev")


def _categorical_sql(column: str) -> str:
    return f"""SELECT {_KEYS}, '{column}' AS column_name, CAST(sum(n) AS BIGINT) AS count,
        CAST(COALESCE(sum(n) FILTER (v IS NULL), 0) AS BIGINT) AS num_nulls,
        round(100.0::DOUBLE * COALESCE(sum(n) FILTER (v IS NULL), 0) / sum(n), 6) AS percent_null,
        count(v) AS distinct_count,
        list(v ORDER BY n DESC, v)  FILTER (v IS NOT NULL)[1] AS most_frequent
        FROM (SELECT {_KEYS}, {column} AS v, count(*) AS n FROM g GROUP BY ALL) GROUP BY {_KEYS}"""


@query(
    "profile_categorical",
    f"WITH {_GROUPS} " + " UNION ALL ".join(_categorical_sql(c) for c in ("prediction", "churn", "contract")),
)
def profile_categorical(spark, folder):
    return _flat(profile.profile_categorical(inference_log(spark, folder), MONITOR), "percent_null")


@query(
    "profile_delta",
    f"""WITH {_GROUPS}, {_NUMERIC}
        SELECT {_KEYS}, column_name,
          round(percent_null - lag(percent_null) OVER w, 9) AS percent_null_delta,
          round(avg - lag(avg) OVER w, 9) AS avg_delta FROM p
        WINDOW w AS (PARTITION BY model_version, slice_key, slice_value, column_name ORDER BY window_start)""",
)
def profile_delta(spark, folder):
    deltas = profile.profile_deltas(profile.profile_numeric(inference_log(spark, folder), MONITOR))
    return deltas.select(
        "window_start", "model_version", "slice_key", "slice_value", "column_name",
        F.round("percent_null_delta", 9).alias("percent_null_delta"), F.round("avg_delta", 9).alias("avg_delta"),
    )


# --- model quality ----------------------------------------------------------


def quality_sql(by: str, source: str, ctes: str = "") -> str:
    """Quality metrics from rows with ``label`` and ``prediction``, grouped by ``by`` (may be empty)."""
    lead = f"{by}, " if by else ""
    group = f"GROUP BY {by}" if by else ""
    return f"""
    WITH {ctes + ', ' if ctes else ''}
    c AS (SELECT {lead} label, prediction, count(*) AS n FROM {source}
          WHERE label IS NOT NULL AND prediction IS NOT NULL GROUP BY ALL),
    k AS (SELECT {lead} label AS class, n AS support, 0 AS predicted, CASE WHEN label = prediction THEN n ELSE 0 END AS hits
          FROM c UNION ALL SELECT {lead} prediction, 0, n, 0 FROM c),
    s AS (SELECT {lead} class, sum(support)::DOUBLE AS support, sum(predicted)::DOUBLE AS predicted,
                 sum(hits)::DOUBLE AS hits FROM k GROUP BY ALL),
    m AS (SELECT *, CASE WHEN predicted > 0 THEN hits / predicted ELSE 0 END AS p,
                 CASE WHEN support > 0 THEN hits / support ELSE 0 END AS r,
                 CASE WHEN support + predicted > 0 THEN 2 * hits / (support + predicted) ELSE 0 END AS f FROM s)
    SELECT {lead} CAST(sum(support) AS BIGINT) AS n, round(sum(hits) / sum(support), 6) AS accuracy_score,
           round(avg(p), 6) AS precision_macro, round(avg(r), 6) AS recall_macro, round(avg(f), 6) AS f1_macro,
           round(sum(p * support) / sum(support), 6) AS precision_weighted,
           round(sum(r * support) / sum(support), 6) AS recall_weighted,
           round(sum(f * support) / sum(support), 6) AS f1_weighted
    FROM m {group}"""


_QUALITY = [
    "accuracy_score",
    "precision_macro",
    "recall_macro",
    "f1_macro",
    "precision_weighted",
    "recall_weighted",
    "f1_weighted",
]


@query(
    "confusion_matrix",
    """SELECT CAST(quality AS VARCHAR) AS label, CAST(count_if(toxic = 0) AS BIGINT) AS pred_0,
              CAST(count_if(toxic = 1) AS BIGINT) AS pred_1 FROM labels
       WHERE quality IS NOT NULL AND toxic IS NOT NULL GROUP BY 1""",
)
def confusion_matrix(spark, folder):
    counts = classify.confusion_counts(table(spark, folder, "labels"), "quality", "toxic")
    return classify.confusion_matrix(counts, ["0", "1"])


@query("quality_metrics", quality_sql("", f"(SELECT churn AS label, prediction FROM ({LOG_SQL}))"))
def quality_metrics(spark, folder):
    counts = classify.confusion_counts(inference_log(spark, folder), "churn", "prediction")
    return _flat(classify.quality_metrics(counts), *_QUALITY)


@query("quality_by_slice", quality_sql(_KEYS, "(SELECT *, churn AS label FROM g)", _GROUPS))
def quality_by_slice(spark, folder):
    return _flat(profile.publish(profile.quality_by_group(inference_log(spark, folder), MONITOR)), *_QUALITY)


_BINARY = """
    CAST(count_if(churn = 'Yes' AND prediction = 'Yes') AS BIGINT) AS true_positives,
    CAST(count_if(churn <> 'Yes' AND prediction = 'Yes') AS BIGINT) AS false_positives,
    CAST(count_if(churn = 'Yes' AND prediction <> 'Yes') AS BIGINT) AS false_negatives,
    CAST(count_if(churn <> 'Yes' AND prediction <> 'Yes') AS BIGINT) AS true_negatives,
    count(*) AS example_count"""
_RATES = """
    (true_positives + true_negatives)::DOUBLE / example_count AS accuracy_score,
    true_positives::DOUBLE / (true_positives + false_positives) AS precision_score,
    true_positives::DOUBLE / (true_positives + false_negatives) AS recall_score,
    2.0::DOUBLE * true_positives / (2 * true_positives + false_positives + false_negatives) AS f1_score"""


@query(
    "f1_binary",
    f"""SELECT model_version, round(f1_score, 6) AS f1_score FROM (SELECT *, {_RATES} FROM
        (SELECT model_version, {_BINARY} FROM ({LOG_SQL}) WHERE churn IS NOT NULL GROUP BY model_version))""",
)
def f1_binary(spark, folder):
    counts = classify.confusion_counts(inference_log(spark, folder), "churn", "prediction", ["model_version"])
    metrics = classify.binary_metrics(counts, "Yes", ["model_version"])
    return metrics.select("model_version", F.round("f1_score", 6).alias("f1_score"))


# Chance of the positive class, from the number behind the prediction.
_SCORE = "monthly_charges / (monthly_charges + 50)"


@query(
    "eval_long",
    f"""WITH r AS (SELECT *, {_SCORE} AS score FROM ({LOG_SQL}) WHERE churn IS NOT NULL),
        b AS (SELECT *, {_RATES} FROM (SELECT {_BINARY} FROM r)),
        l AS (SELECT -avg(ln(least(greatest(CASE WHEN churn = 'Yes' THEN score ELSE 1 - score END, 1e-15), 1 - 1e-15)))
              AS v FROM r WHERE score IS NOT NULL),
        s AS (SELECT score, count_if(churn = 'Yes')::DOUBLE AS pos, count_if(churn <> 'Yes')::DOUBLE AS neg FROM r
              WHERE score IS NOT NULL GROUP BY 1),
        c AS (SELECT *, sum(neg) OVER (ORDER BY score) - neg AS below FROM s),
        a AS (SELECT sum(pos * (below + neg / 2)) / (sum(pos) * sum(neg)) AS v FROM c),
        d AS (SELECT *, sum(pos) OVER (ORDER BY score DESC) AS tp, sum(neg) OVER (ORDER BY score DESC) AS fp FROM s),
        e AS (SELECT sum(pos * tp / (tp + fp)) / sum(pos) AS v FROM d),
        wide AS (SELECT true_positives::DOUBLE AS true_positives, false_positives::DOUBLE AS false_positives,
                        false_negatives::DOUBLE AS false_negatives, true_negatives::DOUBLE AS true_negatives,
                        example_count::DOUBLE AS example_count, accuracy_score, precision_score, recall_score, f1_score,
                        l.v AS log_loss, a.v AS roc_auc, e.v AS precision_recall_auc FROM b, l, a, e)
        SELECT 'test_' || metric AS metric, round(value, 9) AS value FROM (UNPIVOT wide ON COLUMNS(*) INTO NAME metric VALUE value)""",
)
def eval_long(spark, folder):
    scored = inference_log(spark, folder).withColumn("score", F.expr(_SCORE))
    return _flat(classify.evaluate(scored, "churn", "prediction", "Yes", "test_", "score"), "value")


@query(
    "roc_points",
    f"""WITH r AS (SELECT value AS score, churn FROM (SELECT e.value, l.churn FROM events e
                   JOIN ({LOG_SQL}) l USING (event_id)) WHERE churn IS NOT NULL),
        s AS (SELECT score, count_if(churn = 'Yes') AS pos, count_if(churn <> 'Yes') AS neg FROM r GROUP BY 1),
        c AS (SELECT *, sum(pos) OVER (ORDER BY score DESC) AS tp, sum(neg) OVER (ORDER BY score DESC) AS fp,
                     (SELECT sum(pos) FROM s) AS p, (SELECT sum(neg) FROM s) AS n FROM s)
        SELECT score AS threshold, CAST(tp AS BIGINT) AS true_positives, CAST(fp AS BIGINT) AS false_positives,
               round(tp::DOUBLE / p, 6) AS tpr, round(fp::DOUBLE / n, 6) AS fpr,
               round(tp::DOUBLE / (tp + fp), 6) AS precision FROM c""",
)
def roc_points(spark, folder):
    events = table(spark, folder, "events")
    label = "CASE WHEN event_type IN ('purchase', 'signup') THEN 'Yes' WHEN event_type = 'error' THEN NULL ELSE 'No' END"
    points = classify.roc_points(events.selectExpr(f"{label} AS churn", "value"), "churn", "value", "Yes")
    return _flat(points.drop("pos", "neg", "neg_below"), "tpr", "fpr", "precision")


_LOSS = "avg(CASE WHEN prediction != churn AND churn = 'Yes' THEN -monthly_charges ELSE 0 END)"


@query("expected_loss", f"WITH {_GROUPS} SELECT {_KEYS}, round({_LOSS}, 9) AS expected_loss FROM g GROUP BY {_KEYS}")
def expected_loss(spark, folder):
    return _flat(profile.publish(profile.custom_metrics(inference_log(spark, folder), MONITOR)), "expected_loss")


_PERFORMANCE = f"""
    q AS ({quality_sql(_KEYS, "(SELECT *, churn AS label FROM g)")}),
    e AS (SELECT {_KEYS}, {_LOSS} AS expected_loss FROM g GROUP BY {_KEYS}),
    perf AS (SELECT e.window_start, e.model_version, e.expected_loss, q.f1_macro FROM e LEFT JOIN q
             ON e.window_start = q.window_start AND e.model_version = q.model_version
             AND q.slice_key IS NULL WHERE e.slice_key IS NULL)"""


@query(
    "perf_metrics",
    f"""WITH {_GROUPS}, {_PERFORMANCE}
        SELECT window_start AS time, round(f1_macro, 6) AS performance_metric, round(expected_loss, 9) AS expected_loss,
               model_version AS model_id FROM perf WHERE model_version = '1' ORDER BY time""",
)
def perf_metrics(spark, folder):
    performance = profile.performance_profile(inference_log(spark, folder), MONITOR)
    rows = drift.performance_series(performance, "f1_macro", "1")
    return _flat(rows, "performance_metric", "expected_loss").orderBy("time")


# --- drift ------------------------------------------------------------------


def _distribution_sql(columns) -> str:
    """``d``: value shares per window, model, slice and column."""
    counts = " UNION ALL ".join(
        f"SELECT {_KEYS}, '{c}' AS column_name, {c} AS value, count(*) AS n FROM g WHERE {c} IS NOT NULL"
        f" GROUP BY {_KEYS}, {c}"
        for c in columns
    )
    return f"""d AS (SELECT *, CAST(sum(n) OVER (PARTITION BY {_KEYS}, column_name) AS BIGINT) AS total,
                       n / sum(n) OVER (PARTITION BY {_KEYS}, column_name)::DOUBLE AS p FROM ({counts}))"""


_JS = """sqrt(greatest(sum(CASE WHEN p > 0 THEN p * log2(p / ((p + q) / 2)) ELSE 0 END / 2
                         + CASE WHEN q > 0 THEN q * log2(q / ((p + q) / 2)) ELSE 0 END / 2), 0))"""
_DISTANCES = f"""round(sum(abs(p - q)) / 2, 6) AS tv_distance, round(max(abs(p - q)), 6) AS l_infinity_distance,
    round({_JS}, 6) AS js_distance,
    round(sum((p - q) ** 2 / (a + b)) * sum(a) * sum(b), 4) AS chi_squared_statistic"""
_SERIES = "model_version, slice_key, slice_value, column_name"


def _consecutive_sql() -> str:
    """``pairs``: values of each window next to those of the previous existing window."""
    return f"""
    w AS (SELECT *, lag(window_start) OVER (PARTITION BY {_SERIES} ORDER BY window_start) AS before
          FROM (SELECT DISTINCT window_start, {_SERIES} FROM d)),
    sides AS (
      SELECT d.window_start, d.model_version, d.slice_key, d.slice_value, d.column_name, d.value,
             d.p, 0.0::DOUBLE AS q, d.n AS a, 0 AS b
      FROM d JOIN w ON d.window_start = w.window_start AND d.model_version = w.model_version
        AND d.column_name = w.column_name AND d.slice_key IS NOT DISTINCT FROM w.slice_key
        AND d.slice_value IS NOT DISTINCT FROM w.slice_value WHERE w.before IS NOT NULL
      UNION ALL
      SELECT w.window_start, d.model_version, d.slice_key, d.slice_value, d.column_name, d.value, 0, d.p, 0, d.n
      FROM d JOIN w ON d.window_start = w.before AND d.model_version = w.model_version
        AND d.column_name = w.column_name AND d.slice_key IS NOT DISTINCT FROM w.slice_key
        AND d.slice_value IS NOT DISTINCT FROM w.slice_value),
    pairs AS (SELECT {_KEYS}, column_name, value, sum(p) AS p, sum(q) AS q, sum(a) AS a, sum(b) AS b
              FROM sides GROUP BY ALL)"""


_DIST_COLUMNS = ["prediction", "churn", "contract"]
_ROUND_DRIFT = ["tv_distance", "l_infinity_distance", "js_distance"]


@query(
    "distribution",
    f"""WITH {_GROUPS}, {_distribution_sql(_DIST_COLUMNS)}
        SELECT {_KEYS}, column_name, value, n, total, round(p, 6) AS p FROM d""",
)
def distribution(spark, folder):
    shares = profile.publish(drift.distribution(inference_log(spark, folder), MONITOR))
    return _flat(shares.drop("next_start", "next_end", "has_previous"), "p")


@query(
    "drift_consecutive",
    f"""WITH {_GROUPS}, {_distribution_sql(_DIST_COLUMNS)}, {_consecutive_sql()},
        r AS (SELECT {_KEYS}, column_name, {_DISTANCES} FROM pairs GROUP BY {_KEYS}, column_name)
        SELECT * EXCLUDE (chi_squared_statistic), 'CONSECUTIVE' AS drift_type FROM r""",
)
def drift_consecutive(spark, folder):
    shares = drift.distribution(inference_log(spark, folder), MONITOR)
    return _flat(drift.consecutive_drift(shares).drop("chi_squared_statistic"), *_ROUND_DRIFT)


@query(
    "drift_chi2",
    f"""WITH {_GROUPS}, {_distribution_sql(_DIST_COLUMNS)}, {_consecutive_sql()},
        r AS (SELECT {_KEYS}, column_name, {_DISTANCES} FROM pairs GROUP BY {_KEYS}, column_name)
        SELECT {_KEYS}, column_name, chi_squared_statistic FROM r""",
)
def drift_chi2(spark, folder):
    found = drift.consecutive_drift(drift.distribution(inference_log(spark, folder), MONITOR))
    return found.select(
        "window_start", "model_version", "slice_key", "slice_value", "column_name",
        F.round("chi_squared_statistic", 4).alias("chi_squared_statistic"),
    )


# The tail of the chi-squared distribution as one minus the series of its lower part.
_TAIL = """CASE WHEN x <= 0 THEN 1 ELSE greatest(0, 1 - list_sum(list_transform(
    range(0, CAST(greatest(x - s, 0) * 2 + 12 * sqrt(greatest(x, s)) + 80 AS BIGINT)),
    lambda n: exp((s + n) * ln(x) - x - lgamma(s + n + 1))))) END"""


@query(
    "drift_pvalue",
    f"""WITH {_GROUPS}, {_distribution_sql(_DIST_COLUMNS)}, {_consecutive_sql()},
        r AS (SELECT {_KEYS}, column_name, {_DISTANCES}, count(*) - 1 AS degrees,
                     sum((p - q) ** 2 / (a + b)) * sum(a) * sum(b) AS statistic FROM pairs GROUP BY {_KEYS}, column_name),
        t AS (SELECT * EXCLUDE (statistic, degrees), statistic / 2 AS x, degrees / 2::DOUBLE AS s FROM r)
        SELECT * EXCLUDE (x, s) REPLACE (round(chi_squared_statistic, 4) AS chi_squared_statistic), 'CONSECUTIVE' AS drift_type,
               CASE WHEN s >= 0.5 THEN round({_TAIL}, 6) END AS chi_squared_pvalue FROM t""",
)
def drift_pvalue(spark, folder):
    shares = drift.distribution(inference_log(spark, folder), MONITOR)
    found = _flat(drift.consecutive_drift(shares, p_value=True), "chi_squared_pvalue", *_ROUND_DRIFT)
    return found.withColumn("chi_squared_statistic", F.round("chi_squared_statistic", 4))


_BASELINE = f"SELECT * FROM ({LOG_SQL}) WHERE inference_timestamp < TIMESTAMP '2024-01-08 00:00:00'"


@query(
    "drift_baseline",
    f"""WITH {_GROUPS}, {_distribution_sql(_DIST_COLUMNS)},
        f AS (SELECT *, n / sum(n) OVER (PARTITION BY column_name)::DOUBLE AS p FROM (
              {" UNION ALL ".join(f"SELECT '{c}' AS column_name, {c} AS value, count(*) AS n FROM ({_BASELINE}) WHERE {c} IS NOT NULL GROUP BY ALL" for c in _DIST_COLUMNS)})),
        w AS (SELECT DISTINCT window_start, {_SERIES} FROM d),
        sides AS (SELECT {_KEYS}, column_name, value, p, 0.0::DOUBLE AS q, n AS a, 0 AS b FROM d
                  UNION ALL SELECT w.window_start, w.model_version, w.slice_key, w.slice_value, column_name, f.value,
                  0, f.p, 0, f.n FROM w JOIN f USING (column_name)),
        pairs AS (SELECT {_KEYS}, column_name, value, sum(p) AS p, sum(q) AS q, sum(a) AS a, sum(b) AS b
                  FROM sides GROUP BY ALL)
        SELECT {_KEYS}, column_name, {_DISTANCES}, 'BASELINE' AS drift_type FROM pairs GROUP BY {_KEYS}, column_name""",
)
def drift_baseline(spark, folder):
    log = inference_log(spark, folder)
    baseline = log.filter("inference_timestamp < TIMESTAMP_NTZ '2024-01-08 00:00:00'")
    found = drift.baseline_drift(drift.distribution(log, MONITOR), baseline, _DIST_COLUMNS)
    return _flat(found, *_ROUND_DRIFT).withColumn("chi_squared_statistic", F.round("chi_squared_statistic", 4))


_PIVOT = f"""
    r AS (SELECT {_KEYS}, column_name, {_JS} AS js FROM pairs GROUP BY {_KEYS}, column_name),
    moved AS (SELECT window_start AS time, model_version AS model_id, max(js) FILTER (column_name = 'prediction')
              AS prediction, max(js) FILTER (column_name = 'churn') AS churn FROM r
              WHERE slice_key IS NULL AND model_version = '1' GROUP BY ALL)"""


def _drift_series(spark, folder):
    found = drift.consecutive_drift(drift.distribution(inference_log(spark, folder), MONITOR, WATCHED))
    return drift.drift_series(found, "js_distance", WATCHED, "1")


@query(
    "drift_pivot",
    f"""WITH {_GROUPS}, {_distribution_sql(WATCHED)}, {_consecutive_sql()}, {_PIVOT}
        SELECT time, model_id, round(prediction, 6) AS prediction, round(churn, 6) AS churn FROM moved ORDER BY time""",
)
def drift_pivot(spark, folder):
    return _flat(_drift_series(spark, folder), "prediction", "churn").orderBy("time")


_ALL = f"""{_GROUPS}, {_PERFORMANCE}, {_distribution_sql(WATCHED)}, {_consecutive_sql()}, {_PIVOT},
    metrics AS (SELECT p.window_start AS time, p.model_version AS model_id, p.f1_macro AS performance_metric,
                       p.expected_loss, m.prediction, m.churn FROM perf p
                JOIN moved m ON p.window_start = m.time AND p.model_version = m.model_id)"""


@query(
    "all_metrics",
    f"""WITH {_ALL} SELECT time, model_id, round(performance_metric, 6) AS performance_metric,
        round(expected_loss, 9) AS expected_loss, round(prediction, 6) AS prediction, round(churn, 6) AS churn
        FROM metrics""",
)
def all_metrics(spark, folder):
    performance = profile.performance_profile(inference_log(spark, folder), MONITOR)
    joined = drift.all_metrics(
        drift.performance_series(performance, "f1_macro", "1"), _drift_series(spark, folder), WATCHED
    )
    return _flat(joined, "performance_metric", "expected_loss", "prediction", "churn")


# Limits low enough for the test log to cross some of them.
_LIMITS = drift.Limits(metric=0.5, loss=4.0, drift=0.04)


@query(
    "violations",
    f"""WITH {_ALL}, v AS (
          SELECT CAST(count_if(performance_metric < 0.5 AND abs(expected_loss) > 4) AS BIGINT) AS performance_violations,
                 CAST(count_if(prediction > 0.04 AND churn > 0.04) AS BIGINT) AS drift_violations FROM metrics)
        SELECT *, performance_violations + drift_violations AS all_violations FROM v""",
)
def violations(spark, folder):
    return churn.monitoring_job(inference_log(spark, folder), "1", limits=_LIMITS)


@query(
    "business_value",
    f"""SELECT model_version, CAST(sum(CASE WHEN churn = 'No' AND prediction = 'Yes' THEN -500
          WHEN churn = 'Yes' AND prediction = 'No' THEN 2000 WHEN churn = 'Yes' AND prediction = 'Yes' THEN 1500
          ELSE 0 END) AS DOUBLE) AS value FROM ({LOG_SQL}) WHERE churn IS NOT NULL GROUP BY model_version""",
)
def business_value(spark, folder):
    counts = classify.confusion_counts(inference_log(spark, folder), "churn", "prediction", ["model_version"])
    return classify.business_value(counts, by=["model_version"])
