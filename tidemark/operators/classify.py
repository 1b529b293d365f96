"""Classification quality from confusion counts.

Rows are reduced to (label, prediction, count) first; everything else is
arithmetic on that small table.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.ranking import prefix_sums

# Dollars per customer by (label, prediction). The value of a lost
# customer counts as plus, as in the data it must compare with.
CHURN_VALUES = {
    ("No", "No"): 0.0,
    ("No", "Yes"): -500.0,
    ("Yes", "No"): 2000.0,
    ("Yes", "Yes"): 1500.0,
}


def confusion_counts(df: DataFrame, label: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    """``by.., label, prediction, n`` with both sides as text; rows without either are left out."""
    rows = df.filter(F.col(label).isNotNull() & F.col(prediction).isNotNull())
    return rows.groupBy(
        *by, F.col(label).cast("string").alias("label"), F.col(prediction).cast("string").alias("prediction")
    ).agg(F.count(F.lit(1)).alias("n"))


def confusion_matrix(counts: DataFrame, classes: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """One row per label with one column ``pred_<class>`` each."""
    wide = counts.groupBy(*by, "label").pivot("prediction", list(classes)).agg(F.sum("n"))
    cells = [F.coalesce(F.col(f"`{c}`"), F.lit(0)).alias(f"pred_{c}") for c in classes]
    return wide.select(*by, "label", *cells)


def _ratio(top: Column, bottom: Column) -> Column:
    return F.when(bottom > 0, top / bottom).otherwise(F.lit(0.0))


def per_class_metrics(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Support, precision, recall and F1 per class; classes are those seen on either side."""
    n, zero = F.col("n"), F.lit(0).cast("long")
    hit = F.when(F.col("label") == F.col("prediction"), n).otherwise(zero)

    def share(name: str, support: Column, predicted: Column, hits: Column) -> Column:
        return F.struct(
            F.col(name).alias("class"), support.alias("support"), predicted.alias("predicted"), hits.alias("hits")
        )

    parts = counts.select(
        *by, F.inline(F.array(share("label", n, zero, hit), share("prediction", zero, n, zero)))
    )
    sums = parts.groupBy(*by, "class").agg(*[F.sum(c).alias(c) for c in ("support", "predicted", "hits")])
    hits, support, predicted = F.col("hits"), F.col("support"), F.col("predicted")
    return sums.withColumns(
        {
            "precision": _ratio(hits, predicted),
            "recall": _ratio(hits, support),
            "f1": _ratio(2 * hits, support + predicted),
        }
    )


def quality_metrics(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Accuracy and macro / weighted precision, recall and F1."""
    classes = per_class_metrics(counts, by)
    total = F.sum("support")
    macro = [F.avg(m).alias(f"{m}_macro") for m in ("precision", "recall", "f1")]
    weighted = [
        (F.sum(F.col(m) * F.col("support")) / total).alias(f"{m}_weighted") for m in ("precision", "recall", "f1")
    ]
    return classes.groupBy(*by).agg(
        total.alias("n"), (F.sum("hits") / total).alias("accuracy_score"), *macro, *weighted
    )


def binary_metrics(counts: DataFrame, positive: str, by: Sequence[str] = ()) -> DataFrame:
    """Counts of the four outcomes and accuracy, precision, recall and F1 of the positive class."""
    truth, guess = F.col("label") == F.lit(positive), F.col("prediction") == F.lit(positive)

    def cell(test: Column) -> Column:
        return F.sum(F.when(test, F.col("n")).otherwise(F.lit(0)))

    cells = counts.groupBy(*by).agg(
        cell(truth & guess).alias("true_positives"),
        cell(~truth & guess).alias("false_positives"),
        cell(truth & ~guess).alias("false_negatives"),
        cell(~truth & ~guess).alias("true_negatives"),
        F.sum("n").alias("example_count"),
    )
    tp, fp, fn = F.col("true_positives"), F.col("false_positives"), F.col("false_negatives")
    return cells.withColumns(
        {
            "accuracy_score": (tp + F.col("true_negatives")) / F.col("example_count"),
            "precision_score": _ratio(tp, tp + fp),
            "recall_score": _ratio(tp, tp + fn),
            "f1_score": _ratio(2 * tp, 2 * tp + fp + fn),
        }
    )


def roc_points(df: DataFrame, label: str, score: str, positive: str) -> DataFrame:
    """One row per distinct score as threshold: rates and precision of calling ``score`` and above positive.

    Equal scores are merged first; running totals are taken per score range, so no
    task holds all scores.
    """
    truth = F.col(label).cast("string") == F.lit(positive)
    per_score = (
        df.filter(F.col(label).isNotNull() & F.col(score).isNotNull())
        .groupBy(F.col(score).cast("double").alias("threshold"))
        .agg(F.count_if(truth).alias("pos"), F.count_if(~truth).alias("neg"))
    )
    whole = per_score.agg(F.struct(F.sum("pos").alias("p"), F.sum("neg").alias("n"))).scalar()
    both = prefix_sums(per_score, "threshold", ["pos", "neg"]).withColumn("_whole", whole)
    both = both.withColumns({"_p": F.col("_whole.p"), "_n": F.col("_whole.n")})
    tp = F.col("_p") - F.col("cum_pos") + F.col("pos")
    fp = F.col("_n") - F.col("cum_neg") + F.col("neg")
    return both.select(
        "threshold",
        "pos",
        "neg",
        (F.col("cum_neg") - F.col("neg")).alias("neg_below"),
        tp.alias("true_positives"),
        fp.alias("false_positives"),
        _ratio(tp, F.col("_p")).alias("tpr"),
        _ratio(fp, F.col("_n")).alias("fpr"),
        _ratio(tp, tp + fp).alias("precision"),
    )


def roc_auc(points: DataFrame) -> DataFrame:
    """Area under the ROC curve: chance that a positive scores above a negative, ties half."""
    wins = F.sum(F.col("pos") * (F.col("neg_below") + F.col("neg") * F.lit(0.5)))
    return points.agg((wins / (F.sum("pos") * F.sum("neg"))).alias("roc_auc"))


def average_precision(points: DataFrame) -> DataFrame:
    """Area under the precision-recall curve in steps: precision at each threshold by the recall it adds."""
    return points.agg((F.sum(F.col("pos") * F.col("precision")) / F.sum("pos")).alias("precision_recall_auc"))


def log_loss(df: DataFrame, label: str, score: str, positive: str) -> DataFrame:
    """Mean negative log likelihood of the given probability of the positive class."""
    chance = F.least(F.greatest(F.col(score), F.lit(1e-15)), F.lit(1 - 1e-15))
    truth = F.col(label).cast("string") == F.lit(positive)
    rows = df.filter(F.col(label).isNotNull() & F.col(score).isNotNull())
    return rows.agg((-F.avg(F.when(truth, F.ln(chance)).otherwise(F.ln(1 - chance)))).alias("log_loss"))


def evaluate(
    df: DataFrame, label: str, prediction: str, positive: str, prefix: str = "", score: str | None = None
) -> DataFrame:
    """Long table ``(metric, value)``, names prefixed (``training_``, ``val_``, ``test_``)."""
    wide = binary_metrics(confusion_counts(df, label, prediction), positive)
    out = _long(wide, prefix)
    if score is not None:
        out = out.unionByName(_long(log_loss(df, label, score, positive), prefix))
        points = roc_points(df, label, score, positive)
        out = out.unionByName(_long(roc_auc(points), prefix)).unionByName(_long(average_precision(points), prefix))
    return out


def _long(wide: DataFrame, prefix: str) -> DataFrame:
    rows = [
        F.struct(F.lit(prefix + c).alias("metric"), F.col(c).cast("double").alias("value")) for c in wide.columns
    ]
    return wide.select(F.inline(F.array(*rows)))


def business_value(
    counts: DataFrame, values: Mapping[tuple[str, str], float] = CHURN_VALUES, by: Sequence[str] = ()
) -> DataFrame:
    """Dollar value of the predictions: counts times the value of each (label, prediction) outcome.

    An empty set has no value (null), so a gate on it fails instead of passing.
    """
    worth = None
    for (label, prediction), value in values.items():
        test = (F.col("label") == F.lit(label)) & (F.col("prediction") == F.lit(prediction))
        worth = F.when(test, F.lit(value)) if worth is None else worth.when(test, F.lit(value))
    total = F.sum(F.col("n") * worth.otherwise(F.lit(0.0))).alias("value")
    return counts.groupBy(*by).agg(total) if by else counts.agg(total)
