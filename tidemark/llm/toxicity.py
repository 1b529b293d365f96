"""Toxic passages by maximum-scoring segments (operator 10).

A word scores the log of how much likelier it is in toxic text than elsewhere, with
Dirichlet priors from the word counts of the whole corpus; words may be known by their
first letters only, so that inflected forms share a score. Words without evidence score a
little below zero, so segments of positive total are passages that are toxic as a whole.
A linear scan finds all maximal ones. Scores are log likelihood ratios, so in clean text of n
words about K n exp(-s) segments reach a score s; K is fitted.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import column, fold, identified, text_slices, written

WORD = re.compile(r"[^\W\d_]+")
#: The labelled sample is bounded: these many documents, chosen by the hash of their id.
SAMPLE = 100_000
#: Letters at the start of a word that are features besides the whole word.
PREFIXES = (4, 5, 6)
#: Weight of the corpus in the Dirichlet prior, as a share of the words of toxic labelled text.
PRIOR_SHARE = 0.25
#: A feature counts if its log-odds are above LEAST_ODDS even when lowered by LOWER standard errors:
#: many words of topics that happen to have toxic texts are somewhat likelier there, and a text has
#: hundreds of those.
LEAST_ODDS, LOWER, LEAST_COUNT = float(np.log(10.0)), 1.5, 3
#: Terms of the series for the tail of a Poisson law.
SERIES = 40
HELD_OUT = 5


def word_features(word: str) -> list[str]:
    """The whole word and its beginnings, which end in '*'."""
    return [word] + [word[:n] + "*" for n in PREFIXES if len(word) >= n]


def maximal_segments(scores: Iterable[tuple[int, float]], gap: float) -> list[tuple[float, int, int]]:
    """All maximal segments (score, first word, last word) of a text, in one pass.

    ``scores`` are the positions and scores of the words above zero; every other word has
    ``gap`` < 0. A candidate keeps the running total before and after it, and which candidate
    before it began lower. A new one joins that candidate if the total has risen above its
    end, and then tries again; the kept links make the searches linear in all.
    """
    held: list[tuple] = []  # (total before, total after, first, last, earlier candidate that began lower)
    total, place = 0.0, 0
    for i, score in scores:
        total += gap * (i - place)
        place = i + 1
        low, first = total, i
        total += score
        j = len(held) - 1
        while True:
            while j >= 0 and held[j][0] >= low:
                j = held[j][4]
            if j < 0 or held[j][1] >= total:
                break
            low, first = held[j][0], held[j][2]
            del held[j:]
            j = len(held) - 1
        held.append((low, total, first, i, j))
    return [(after - before, first, last) for before, after, first, last, _ in held]


@dataclass
class Model:
    """Scores of features, the score of every other word, and the calibration of passages."""

    scores: dict[str, float] = field(default_factory=dict)
    gap: float = -0.01
    k: float = 1.0
    weights: tuple[float, float] = (-6.0, 1.0)
    base: float = 0.0  # score of a text without any evidence

    def __post_init__(self) -> None:
        self.memory: dict[str, float] = {}

    def word_score(self, word: str) -> float:
        """The best score among a word's features; 0 stands for no evidence."""
        found = self.memory.get(word)
        if found is None:
            if len(self.memory) > 500_000:
                self.memory.clear()
            found = max((self.scores.get(f, 0.0) for f in word_features(word)), default=0.0)
            self.memory[word] = found
        return found

    def segments(self, text: str) -> tuple[int, list[tuple[float, int, int]]]:
        """Number of words, and the maximal segments."""
        words = WORD.findall(text.lower())
        hits = [(i, s) for i, s in enumerate(map(self.word_score, words)) if s > 0]
        return len(words), maximal_segments(hits, self.gap) if hits else []

    def evidence(self, n: int, scores: list[float]) -> tuple[float, int]:
        """How unlikely the best passages are in clean text, and how many passages that is for.

        In clean text of n words the number of segments that reach s follows a Poisson law of
        mean K n exp(-s). The evidence is the largest -log of the chance that r segments reach
        the r-th best score.
        """
        best = np.sort(np.array(scores))[::-1]
        r = np.arange(1, len(best) + 1)
        # By its log: the mean of a long passage's score is too small for a double.
        log_mean = np.log(self.k * max(n, 1)) - best
        mean = np.exp(log_mean)
        # Chance of r or more: the first term, times a series in which mean/(r+1) is below 1 where it matters.
        ratio = mean[:, None] / (r[:, None] + np.arange(1, SERIES + 1))
        series = 1 + np.cumprod(np.minimum(ratio, 1), axis=1).sum(1)
        found = np.where(mean < r, mean - r * log_mean + _log_factorial(r) - np.log(series), 0.0)
        at = int(found.argmax())
        return max(0.0, float(found[at])), at + 1

    def score(self, text: str) -> tuple[float, int]:
        n, segments = self.segments(text)
        if not segments:
            return self.base, 0
        total, passages = self.evidence(n, [s for s, _, _ in segments])
        a, b = self.weights
        return float(1 / (1 + np.exp(-(a + b * np.log1p(total))))), passages


def _log_factorial(r: np.ndarray) -> np.ndarray:
    return np.cumsum(np.log(r))


def _counts(rows: DataFrame) -> DataFrame:
    """Words with their counts in all text, in toxic and in clean labelled text: (word, n, toxic, clean).

    A text counts a word once: texts that repeat a word a hundred times say no more about it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels = batch.column(2).to_pylist()
            at = 0
            for ids, texts in text_slices(batch):
                every, toxic, clean = Counter(), Counter(), Counter()
                for text, label in zip(texts, labels[at : at + len(ids)]):
                    words = set(WORD.findall(text.lower()))
                    every.update(words)
                    if label is not None:
                        (toxic if label else clean).update(words)
                at += len(ids)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(list(every), pa.string()),
                        pa.array(list(every.values()), pa.int64()),
                        pa.array([toxic[w] for w in every], pa.int64()),
                        pa.array([clean[w] for w in every], pa.int64()),
                    ],
                    names=["word", "n", "toxic", "clean"],
                )

    sums = rows.mapInArrow(run, "word string, n long, toxic long, clean long").groupBy("word")
    return sums.agg(*[F.sum(c).alias(c) for c in ("n", "toxic", "clean")])


def _has_shorter(feature: str, scores: dict[str, float]) -> bool:
    """Whether a shorter beginning of the same words is a feature too."""
    stem = feature.rstrip("*")
    size = len(stem) if feature.endswith("*") else len(stem) + 1
    return any(n < size and stem[:n] + "*" in scores for n in PREFIXES if n <= len(stem))


def _weights(total: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Logistic regression on one number, by Newton steps with a little ridge."""
    x = np.stack([np.ones(len(total)), np.log1p(total)], 1)
    w = np.array([-1.0, 1.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (label - p) - 1e-3 * w
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        w = w + np.clip(np.linalg.solve(hessian, gradient), -5, 5)
    return float(w[0]), float(w[1])


def learning_labels(labels: DataFrame, id_col: str, label_col: str, sample: int = SAMPLE) -> DataFrame:
    """At most ``sample`` labelled ids outside the held-out fold, one label for each id (the largest)."""
    rows = labels.select(column(id_col).alias("id"), column(label_col).cast("int").alias("label"))
    rows = rows.filter(F.col("label").isNotNull() & (fold(F.col("id"), HELD_OUT) != 0))
    return rows.groupBy("id").agg(F.max("label").alias("label")).orderBy(F.xxhash64("id"), "id").limit(sample)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    sample: int = SAMPLE,
) -> Model:
    """Learn from labels outside the held-out fold; word counts of the prior are those of all documents.

    Without toxic or without clean labelled text nothing is known: every text then scores the
    share of toxic labels (0 if there are none).
    """
    chosen = written(learning_labels(labels, id_col, label_col, sample), "labels")
    source = identified(docs, id_col, text_col)
    words = written(_counts(source.join(F.broadcast(chosen), "id", "left").select("id", "text", "label")), "words")
    sums = words.agg(*[F.sum(c).alias(c) for c in ("n", "toxic", "clean")]).first()
    known = chosen.agg(F.avg("label").alias("share")).first()["share"] or 0.0
    if not sums["toxic"] or not sums["clean"]:
        return Model(base=float(known))

    # Features of words, counted over the vocabulary.
    starts = [F.when(F.length("word") >= n, F.concat(F.substring("word", 1, n), F.lit("*"))) for n in PREFIXES]
    feature = F.explode(F.array_compact(F.array("word", *starts))).alias("feature")
    features = words.select(feature, "n", "toxic", "clean").groupBy("feature")
    table = features.agg(*[F.sum(c).alias(c) for c in ("n", "toxic", "clean")]).filter(F.col("toxic") >= LEAST_COUNT)
    weight = PRIOR_SHARE * sums["toxic"]
    prior = F.col("n") * F.lit(weight / sums["n"])
    in_toxic, in_clean = F.col("toxic") + prior, F.col("clean") + prior
    odds = F.log(in_toxic / (sums["toxic"] + weight - in_toxic)) - F.log(in_clean / (sums["clean"] + weight - in_clean))
    error = F.sqrt(1 / in_toxic + 1 / in_clean)
    # What passes is bounded by the labelled sample, of which each such feature has some words.
    strong = table.withColumns({"odds": odds, "error": error}).filter(odds - LOWER * error >= LEAST_ODDS).collect()
    scores = {r["feature"]: r["odds"] - r["error"] for r in strong}
    # Shorter beginnings hold the longer ones, so the shortest in the model count each word once.
    whole = [r for r in strong if not _has_shorter(r["feature"], scores)]
    toxic_share = min(0.5, sum(r["toxic"] for r in whole) / sums["toxic"])
    model = Model(scores, gap=float(np.log1p(-toxic_share)) - 1e-3, base=float(known))

    calibration = _sample_segments(source.join(F.broadcast(chosen), "id"), model)
    return _calibrated(model, calibration)


def _sample_segments(rows: DataFrame, model: Model) -> list[tuple[int, int, list[float]]]:
    """(label, words, scores of segments) of the labelled sample: a few numbers a document."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            found = [own.segments(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(2).cast(pa.int64()),
                    pa.array([n for n, _ in found], pa.int64()),
                    pa.array([[s for s, _, _ in segments] for _, segments in found], pa.list_(pa.float64())),
                ],
                names=["label", "n", "scores"],
            )

    found = rows.select("id", "text", "label").mapInArrow(run, "label long, n long, scores array<double>").collect()
    return [(r["label"], r["n"], list(r["scores"])) for r in found]


def _calibrated(model: Model, sample: list[tuple[int, int, list[float]]]) -> Model:
    """Fit K on clean documents, then the weight of the evidence on all of the sample."""
    clean = [(n, max(scores, default=0.0)) for label, n, scores in sample if not label and n]
    # Most likely K of a Gumbel law of known scale: documents over the sum of n exp(-s).
    model.k = len(clean) / max(1e-9, sum(n * np.exp(-s) for n, s in clean)) if clean else 1.0
    totals, labels, silent = [], [], []
    for label, n, scores in sample:
        if scores:
            totals.append(model.evidence(n, scores)[0])
            labels.append(1.0 if label else 0.0)
        else:
            silent.append(1.0 if label else 0.0)
    model.base = float((sum(silent) + 0.5) / (len(silent) + 1)) if silent else 0.0
    if totals:
        model.weights = _weights(np.array(totals), np.array(labels))
    return model


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, held_out, score, predicted, passages (the number of those the evidence is for).

    Every row gets its own score, repeated or not; a null text is empty and scores the share of
    toxic documents among those without evidence; a null id is held out, as nothing was learnt
    from it. An empty table gives no rows; other columns are not read.
    """
    source = identified(docs, id_col, text_col)
    id_type = source.schema["id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            for ids, texts in text_slices(batch):
                found = [own.score(t) for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids, batch.schema.field(0).type),
                        pa.array([s for s, _ in found], pa.float64()),
                        pa.array([p for _, p in found], pa.int64()),
                    ],
                    names=["id", "score", "passages"],
                )

    held = F.coalesce(fold(F.col("id"), HELD_OUT) == 0, F.lit(True))
    return source.mapInArrow(run, f"id {id_type}, score double, passages long").select(
        F.col("id").alias(id_col),
        held.alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "passages",
    )


def drop_toxic(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The documents that the model doesn't call toxic, in all their columns; each row is judged by its own text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("boolean")
    def toxic(texts):
        return texts.map(lambda t: shared.value.score(t)[0] >= 0.5)

    return docs.filter(~toxic(F.coalesce(column(text_col), F.lit(""))))
