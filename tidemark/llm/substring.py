"""Substring dedup over sliding spans of sentences (operator 1).

Every run of consecutive sentences that is long enough is hashed, and the runs of all
documents meet by hash. The first occurrence of a run stays; sentences that any later
occurrence covers are removed. An overlong sentence counts as several, cut at its clause
marks: where a passage begins or ends inside a sentence, its inner clauses still make runs.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import column, unused, written

#: White space after a sentence's end, or a line break.
_BETWEEN = re.compile(r"(?<=[.!?])\s+|\s*\n\s*")
#: White space after a clause mark, and blanks from which on a sentence is cut there.
_CLAUSE, LONG_SENTENCE = re.compile(r"(?<=[,;:])\s+"), 30


@dataclass(frozen=True)
class Span:
    """A run is the shortest one from (or up to) a sentence with at least ``sentences`` and ``words``, or with ``many`` words."""

    sentences: int = 2
    words: int = 15
    many: int = 40


def sentences(text: str) -> list[tuple[int, int]]:
    """Start and end of each sentence, or clause of an overlong one, without the white space around it."""
    out, start = [], len(text) - len(text.lstrip())

    def add(start: int, end: int) -> None:
        if text.count(" ", start, end) >= LONG_SENTENCE:
            for gap in _CLAUSE.finditer(text, start, end):
                out.append((start, gap.start()))
                start = gap.end()
        out.append((start, end))

    for gap in _BETWEEN.finditer(text):
        if gap.start() > start:
            add(start, gap.start())
        start = max(start, gap.end())
    end = len(text.rstrip())
    if end > start:
        add(start, end)
    return out


def runs(words: list[int], span: Span) -> tuple[np.ndarray, np.ndarray]:
    """First and last sentence of every run: one from each start and one up to each end, where the text is long enough."""
    n = len(words)
    total = np.concatenate([[0], np.cumsum(words)])
    places = np.arange(n)

    def reach(total: np.ndarray) -> np.ndarray:
        """The sentence that completes the run from each start; n if none does."""
        enough = np.searchsorted(total, total[:-1] + span.words) - 1
        plain = np.maximum(enough, places + span.sentences - 1)
        return np.minimum(plain, np.searchsorted(total, total[:-1] + span.many) - 1)

    ahead = reach(total)
    behind = n - 1 - reach(total[-1] - total[::-1])[::-1]  # the same, read backwards
    first = np.concatenate([places, behind])
    last = np.concatenate([ahead, places])
    whole = (first >= 0) & (last < n)
    pairs = np.unique(np.stack([first[whole], last[whole]], 1), axis=0)
    return pairs[:, 0], pairs[:, 1]


def text_spans(text: str, span: Span) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, first and last sentence of every run of a text. White space between words doesn't matter."""
    parts = [text[a:b].split() for a, b in sentences(text)]
    first, last = runs([len(p) for p in parts], span)
    # A polynomial over the sentences' hashes, so that any run's hash is a difference of prefixes.
    own = np.array([xxhash.xxh64_intdigest(" ".join(p).encode()) for p in parts], np.uint64)
    found = np.zeros(len(first), np.uint64)
    if len(first):
        with np.errstate(over="ignore"):
            for step in range(int((last - first).max()) + 1):
                inside = first + step <= last
                mixed = found[inside] * np.uint64(0x9E3779B97F4A7C15) + own[first[inside] + step]
                found[inside] = mixed ^ (mixed >> np.uint64(29))
    return found.view(np.int64), first, last


def without(text: str, covered: list[tuple[int, int]]) -> tuple[str, int, int]:
    """The text without the sentences of the given runs; how many they are; how many sentences it had.

    What stays keeps its place and the white space after it; a text that loses its last
    sentences also loses the white space before them.
    """
    found = sentences(text)
    gone = np.zeros(len(found) + 1, np.int64)
    for first, last in covered:
        gone[first] += 1
        gone[last + 1] -= 1
    gone = np.cumsum(gone[:-1]) > 0
    if not gone.any():
        return text, 0, len(found)
    kept, starts = [], [a for a, _ in found] + [len(text)]
    for i in np.flatnonzero(~gone).tolist():
        kept.append(text[starts[i] : starts[i + 1]])
    left = "".join(kept)
    return (left.rstrip() if gone[-1] else left), int(gone.sum()), len(found)


def spans(docs: DataFrame, id_col: str, text_col: str, span: Span = Span()) -> DataFrame:
    """One row per run: hash, id, version (of the text, should an id repeat), first, last."""
    id_type = docs.schema[id_col].dataType.simpleString()
    source = docs.select(column(id_col).alias("id"), column(text_col).alias("text"))
    source = source.filter("id IS NOT NULL AND text IS NOT NULL").withColumn("version", F.xxhash64("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, at = 0, []
            hashes, firsts, lasts = [], [], []
            for i, text in enumerate(batch.column(1)):
                h, a, b = text_spans(text.as_py(), span)
                hashes.append(h)
                firsts.append(a)
                lasts.append(b)
                at.append(np.full(len(h), i))
                rows += len(h)
                if rows > 100_000 or i + 1 == batch.num_rows:
                    where = pa.array(np.concatenate(at))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.concatenate(hashes)),
                            batch.column(0).take(where),
                            batch.column(2).take(where),
                            pa.array(np.concatenate(firsts).astype(np.int32)),
                            pa.array(np.concatenate(lasts).astype(np.int32)),
                        ],
                        names=["hash", "id", "version", "first", "last"],
                    )
                    rows, at, hashes, firsts, lasts = 0, [], [], [], []

    return source.mapInArrow(run, f"hash long, id {id_type}, version long, first int, last int")


def repeated_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", span: Span = Span()) -> DataFrame:
    """One row per text with sentences to remove: id, version, covered (runs of sentences).

    The first occurrence is that of the least id, then the least place. A hash with very many
    occurrences is no hot spot: occurrences are counted, and the first one found, by partial
    aggregates, and the joins have two stored sides, which adaptive execution can split.
    """
    every = written(spans(docs, id_col, text_col, span), "spans")
    counts = every.groupBy("hash").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("hash")
    met = written(every.join(written(counts, "hashes"), "hash", "left_semi"), "repeated")
    place = F.struct("id", "version", "first")
    start = written(met.groupBy("hash").agg(F.min(place).alias("start")), "starts")
    later = met.join(start, "hash").filter(place != F.col("start"))
    # Runs of a text, one list for each text: no longer than the text itself.
    return later.groupBy("id", "version").agg(F.collect_set(F.struct("first", "last")).alias("covered"))


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", span: Span = Span()
) -> tuple[DataFrame, str, str]:
    """The documents with what repeats removed from their text, and two counts: (frame, removed, total).

    All columns stay; the names of the added columns of removed and of all sentences avoid
    theirs. No row is dropped: a text of nothing but repeats becomes empty. A null text stays
    null and a row without an id as it is. Rows that share id and text count as one document;
    rows that share an id only are told apart by their text. Repeats inside a text count too.
    A copy of a text too short for a run stays.
    """
    found = repeated_runs(docs, id_col, text_col, span).select(
        F.col("id").alias("found_id"), F.col("version").alias("found_version"), "covered"
    )
    found = written(found, "covered")
    version = unused(docs, "version")
    keyed = docs.withColumn(version, F.xxhash64(column(text_col)))
    covered, removed, total = (unused(docs, c) for c in ("covered", "removed_sentences", "sentences"))
    found = found.withColumnRenamed("covered", covered)
    match = (keyed[f"`{id_col}`"] == found["found_id"]) & (keyed[version] == found["found_version"])
    joined = keyed.join(found, match, "left")

    @F.pandas_udf("text string, removed long, total long")
    def cut(texts, lists):
        import pandas as pd

        rows = []
        for text, runs_ in zip(texts, lists):
            if text is None:
                rows.append((None, 0, 0))
            elif runs_ is None:
                rows.append((text, 0, len(sentences(text))))
            else:
                rows.append(without(text, [(r["first"], r["last"]) for r in runs_]))
        return pd.DataFrame(rows, columns=["text", "removed", "total"])

    done = unused(docs, "cut")
    out = joined.withColumn(done, cut(column(text_col), F.col(covered)))
    kept = [column(c) if c != text_col else F.col(f"`{done}`.text").alias(text_col) for c in docs.columns]
    counts = [F.col(f"`{done}`.removed").alias(removed), F.col(f"`{done}`.total").alias(total)]
    return out.select(*kept, *counts), removed, total


def drop_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length_col: str = "n_chars", span: Span = Span()
) -> DataFrame:
    """The documents without repeats, in their own columns; a changed text gets its new length."""
    out, removed, _ = remove_repeats(docs, id_col, text_col, span)
    if length_col in docs.columns:
        kind = docs.schema[length_col].dataType
        changed = F.when(F.col(removed) > 0, F.length(column(text_col)).cast(kind))
        out = out.withColumn(length_col, F.coalesce(changed, column(length_col)))
    return out.select(*[column(c) for c in docs.columns])
