"""Classifier fitting, random search and refit with pyspark.ml."""

from __future__ import annotations

import math
import random
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import classify, prep, splits
from tidemark.operators.prep import FittedPrep, PrepSpec, WidePrep
from tidemark.session import scratch_path

FAMILIES = ("LogisticRegression", "RandomForest", "GradientBoosting")

# Parameters of the plain boosted-tree model.
GBT_DEFAULTS = {
    "n_estimators": 250,
    "max_depth": 8,
    "learning_rate": 0.0678,
    "max_bin": 229,
    "min_samples_leaf": 66,
    "subsample": 0.6965,
}


@dataclass(frozen=True)
class Range:
    low: float
    high: float
    log: bool = False
    whole: bool = False

    def draw(self, rng: random.Random) -> float:
        if self.log:
            value = math.exp(rng.uniform(math.log(self.low), math.log(self.high)))
        else:
            value = rng.uniform(self.low, self.high)
        return min(max(int(round(value)), int(self.low)), int(self.high)) if self.whole else value


# The search ranges per model family.
SEARCH_SPACE: Mapping[str, Mapping[str, Range]] = {
    "LogisticRegression": {"C": Range(1e-2, 1.0, log=True), "tol": Range(1e-6, 1e-3)},
    "RandomForest": {
        "n_estimators": Range(10, 200, log=True, whole=True),
        "max_depth": Range(3, 10, whole=True),
        "min_samples_leaf": Range(1, 10, whole=True),
    },
    "GradientBoosting": {
        "n_estimators": Range(10, 200, log=True, whole=True),
        "max_depth": Range(3, 10, whole=True),
        "learning_rate": Range(1e-2, 0.9),
        "max_bin": Range(2, 256, whole=True),
    },
}


def classifier(family: str, params: Mapping[str, float], rows: int, seed: int = 2025):
    """The pyspark.ml estimator for a family; ``rows`` turns the inverse penalty C into regParam."""
    columns = {"featuresCol": "features", "labelCol": "label_index", "weightCol": "weight"}
    if family == "LogisticRegression":
        penalty = 1.0 / (params["C"] * max(rows, 1)) if "C" in params else 0.0
        # The penalty is on the weights of the columns as encoded, not on rescaled ones.
        return LogisticRegression(regParam=penalty, tol=params.get("tol", 1e-6), standardization=False, **columns)
    if family == "RandomForest":
        return RandomForestClassifier(
            numTrees=int(params["n_estimators"]),
            maxDepth=int(params["max_depth"]),
            minInstancesPerNode=int(params.get("min_samples_leaf", 1)),
            seed=seed,
            **columns,
        )
    if family == "GradientBoosting":
        return GBTClassifier(
            maxIter=int(params["n_estimators"]),
            maxDepth=int(params["max_depth"]),
            stepSize=params["learning_rate"],
            maxBins=max(2, int(params["max_bin"])),
            minInstancesPerNode=int(params.get("min_samples_leaf", 1)),
            subsamplingRate=params.get("subsample", 1.0),
            seed=seed,
            **columns,
        )
    raise ValueError(f"unknown classifier {family!r}")


@dataclass(frozen=True)
class TrainedModel:
    """Preprocessing and classifier together: rows in, ``probability`` and text ``prediction`` out."""

    prep: FittedPrep | WidePrep
    model: PipelineModel
    classes: tuple[str, str]

    def score(self, df: DataFrame, prediction: str = "prediction", probability: str = "probability") -> DataFrame:
        """All columns of ``df`` plus the positive-class probability and the predicted class."""
        from pyspark.ml.functions import vector_to_array

        taken = {"features", "rawPrediction", "_prob", "_pred"} & set(df.columns)
        if taken:
            raise ValueError(f"reserved columns in the input: {sorted(taken)}")
        scored = self.model.transform(self.prep.with_vector(df))
        negative, positive = self.classes
        return scored.select(
            *df.columns,
            vector_to_array("_prob")[1].alias(probability),
            F.when(F.col("_pred") == 1.0, F.lit(positive)).otherwise(F.lit(negative)).alias(prediction),
        )

    def importances(self, spark) -> DataFrame:
        """Feature name and importance, for tree models."""
        last = self.model
        if isinstance(self.prep, WidePrep):
            raise ValueError("a wide encoder has no list of names; its values are a table")
        names = self.prep.feature_names()
        if not hasattr(last, "featureImportances"):
            return spark.createDataFrame([], "feature string, importance double")
        values = last.featureImportances.toArray().tolist()
        if len(values) != len(names):
            return spark.createDataFrame([], "feature string, importance double")
        return spark.createDataFrame(list(zip(names, values)), "feature string, importance double")


def top_importances(importances: DataFrame, k: int = 20) -> DataFrame:
    return importances.orderBy(F.desc("importance"), "feature").limit(k)


def prepare(df: DataFrame, fitted: FittedPrep | WidePrep, label: str, positive: str, weighted: bool = True) -> DataFrame:
    """Vector, 0/1 label and class weight; balanced weights unless ``weighted`` is off."""
    rows = df.filter(F.col(label).isNotNull())
    index = F.when(F.col(label) == positive, 1.0).otherwise(0.0)
    out = fitted.assemble(rows, keep=[label]).withColumn("label_index", index)
    if weighted:
        return splits.with_class_weights(out, label)
    return out.withColumn("weight", F.lit(1.0))


def _fit(estimator, ready: DataFrame):
    """The fitted model without its training summary, which goes when a model is stored and read back.

    The summaries of logistic regressions and forests hold the session, and tasks get them with the
    model. Once anything in the session has observed a metric, a session can't be sent any more.
    """
    model = estimator.fit(ready)
    if not getattr(model, "hasSummary", False):
        return model
    path = scratch_path(ready.sparkSession, "model")
    model.write().save(path)
    return type(model).load(path)


def fit_model(
    train: DataFrame,
    spec: PrepSpec,
    label: str,
    positive: str,
    negative: str,
    family: str,
    params: Mapping[str, float],
    seed: int = 2025,
    fitted: FittedPrep | WidePrep | None = None,
) -> TrainedModel:
    """Fit preprocessing (unless given) and one classifier with balanced class weights."""
    fitted = fitted or prep.fit(train, spec)
    ready = prepare(train, fitted, label, positive).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        estimator = classifier(family, params, ready.count(), seed)
        estimator = estimator.setProbabilityCol("_prob").setPredictionCol("_pred")
        return TrainedModel(fitted, _fit(estimator, ready), (negative, positive))
    finally:
        ready.unpersist()


def draw_trials(n: int, seed: int = 2025, families: Sequence[str] = FAMILIES, space=SEARCH_SPACE) -> list[dict]:
    """Seeded random points of the search space, in a fixed order."""
    rng = random.Random(seed)
    out = []
    for number in range(n):
        family = rng.choice(list(families))
        out.append({"trial": number, "family": family, **{k: r.draw(rng) for k, r in space[family].items()}})
    return out


@dataclass(frozen=True)
class SearchResult:
    trials: DataFrame
    best: dict | None


def search(
    train: DataFrame,
    spec: PrepSpec,
    keys: Sequence[str],
    label: str,
    positive: str,
    negative: str,
    trials: Sequence[dict],
    holdout: float = 0.1,
    seed: int = 2025,
    parallel: int = 4,
) -> SearchResult:
    """Fit every trial and score its F1 on a held-out part of ``train``.

    Preprocessing is fitted once. Fitting and validation data are encoded once and
    cached; each trial is a set of Spark jobs, started from a few driver threads.
    A failed trial is recorded without a value.
    """
    marked = splits.split_by_hash(train, keys, 1 - holdout, f"search-{seed}", "_part")
    fit_rows, val_rows = marked.filter("_part = 'train'").drop("_part"), marked.filter("_part = 'test'").drop("_part")
    fitted = prep.fit(fit_rows, spec)
    ready = prepare(fit_rows, fitted, label, positive).persist(StorageLevel.MEMORY_AND_DISK)
    held = val_rows.select(*dict.fromkeys([label, *_inputs(spec)])).persist(StorageLevel.MEMORY_AND_DISK)
    rows = ready.count()

    def run(trial: dict) -> tuple:
        params = {k: v for k, v in trial.items() if k not in ("trial", "family")}
        try:
            estimator = classifier(trial["family"], params, rows, seed)
            estimator = estimator.setProbabilityCol("_prob").setPredictionCol("_pred")
            model = TrainedModel(fitted, _fit(estimator, ready), (negative, positive))
            counts = classify.confusion_counts(model.score(held), label, "prediction")
            value, state = float(classify.binary_metrics(counts, positive).first()["f1_score"]), "COMPLETE"
        except Exception as error:  # a trial may fail for its parameters; the search goes on
            value, state = None, f"FAIL: {type(error).__name__}"
        return trial["trial"], trial["family"], {k: float(v) for k, v in params.items()}, value, state

    try:
        with ThreadPoolExecutor(parallel) as pool:
            results = list(pool.map(run, trials))
    finally:
        ready.unpersist()
        held.unpersist()
    table = train.sparkSession.createDataFrame(
        results, "trial int, family string, params map<string,double>, value double, state string"
    )
    done = [r for r in results if r[3] is not None]
    best = max(done, key=lambda r: (r[3], -r[0])) if done else None
    return SearchResult(table, next(t for t in trials if t["trial"] == best[0]) if best else None)


def _inputs(spec: PrepSpec) -> list[str]:
    return [*spec.booleans, *spec.numbers, *spec.categories]


def fit_best(
    train: DataFrame, spec: PrepSpec, label: str, positive: str, negative: str, best: Mapping, seed: int = 2025
) -> TrainedModel:
    """Refit the best trial on the whole training split, class weights included."""
    params = {k: v for k, v in best.items() if k not in ("trial", "family")}
    return fit_model(train, spec, label, positive, negative, best["family"], params, seed)


@dataclass(frozen=True)
class TrainingJob:
    """Everything a full training run produced."""

    model: TrainedModel
    trials: DataFrame
    metrics: DataFrame


def training_job(
    data: DataFrame,
    spec: PrepSpec,
    keys: Sequence[str],
    label: str,
    positive: str,
    negative: str,
    trials: int = 8,
    seed: int = 2025,
    families: Sequence[str] = FAMILIES,
    space=SEARCH_SPACE,
) -> TrainingJob:
    """Search on the train split, refit the best, evaluate on both splits. No rows reach the driver."""
    train = data.filter("split = 'train'").drop("split").persist(StorageLevel.MEMORY_AND_DISK)
    test = data.filter("split = 'test'").drop("split")
    try:
        found = search(train, spec, keys, label, positive, negative, draw_trials(trials, seed, families, space), seed=seed)
        if found.best is None:
            raise RuntimeError("every trial failed")
        model = fit_best(train, spec, label, positive, negative, found.best, seed)
    finally:
        train.unpersist()
    parts = [
        classify.evaluate(model.score(rows), label, "prediction", positive, prefix, "probability")
        for prefix, rows in (("training_", train), ("test_", test))
    ]
    return TrainingJob(model, found.trials, parts[0].unionByName(parts[1]))
