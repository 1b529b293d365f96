"""Helpers the operators of this folder share."""

from __future__ import annotations

import ctypes
import os
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import scratch_path

SLICE_CHARS = 4_000_000


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` stored as Parquet in the shared scratch folder and read back: lineage ends here.

    A lost executor then costs a read, not the work before, and values that depend on the
    placement of rows (row numbers, salts) can't change when a task runs again.
    """
    path = scratch_path(df.sparkSession, f"llm-{label}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it.

    For local runs and shared folders; on other clusters it is installed or sent with --py-files.
    """
    home = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if home not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([*paths, home])


def unused(df: DataFrame, name: str) -> str:
    """A column name that ``df`` doesn't have, whatever its extra columns are called."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def column(name: str) -> Column:
    """The column of exactly this name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def identified(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Columns ``id`` and ``text`` (null text: empty) of the documents and nothing else."""
    return docs.select(column(id_col).alias("id"), F.coalesce(column(text_col), F.lit("")).alias("text"))


def fold(id_column: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n; null for a null id."""
    return F.crc32(id_column.cast("string").cast("binary")) % F.lit(n)


def text_slices(batch: pa.RecordBatch, chars: int = SLICE_CHARS) -> Iterator[tuple[list, list[str]]]:
    """Ids and texts of an (id, text) batch in runs of about ``chars`` characters.

    Bounds the memory of vectorised work, whatever the number of rows Arrow puts in a batch;
    a single longer text makes a run of its own.
    """
    ids, texts, held = [], [], 0
    for i, text in zip(batch.column(0), batch.column(1)):
        text = text.as_py() or ""
        if held and held + len(text) > chars:
            yield ids, texts
            ids, texts, held = [], [], 0
        ids.append(i.as_py())
        texts.append(text)
        held += len(text)
    if ids:
        yield ids, texts


def give_back() -> None:
    """Return freed memory to the system.

    Python workers outlive their tasks: what the C library and Arrow keep for later use is missed by whatever runs beside them.
    """
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


_SINGLE_BLANK = re.compile(r"(?<=\S) (?=\S)")
#: Characters of the longest word whose result is remembered, and what an entry takes beside word and result.
LONG_WORD, ENTRY = 64, 200


class Recent:
    """What was computed for the words met lately: two generations of about ``limit`` bytes, the older one dropped when the newer is full.

    Results are bytes or tuples of them. Long words are worked on like others and not remembered.
    """

    def __init__(self, limit: int) -> None:
        self.limit = limit
        self.clear()

    def clear(self) -> None:
        self.now: dict = {}
        self.older: dict = {}
        self.held = 0

    def put(self, words: list[str], results: list) -> None:
        if words and max(map(len, words)) > LONG_WORD:
            brief = [(w, r) for w, r in zip(words, results) if len(w) <= LONG_WORD]
            words, results = [w for w, _ in brief], [r for _, r in brief]
        self.now.update(zip(words, results))
        sizes = map(len, results) if results and isinstance(results[0], bytes) else (len(x) for r in results for x in r)
        self.held += ENTRY * len(words) + sum(map(len, words)) + sum(sizes)

    def results(self, words: list[str], make: Callable[[list[str]], list]) -> list:
        """The results for distinct words; ``make`` computes those not known."""
        if self.held > self.limit:
            self.older, self.now, self.held = self.now, {}, 0
        found = list(map(self.now.get, words))
        new = [i for i, result in enumerate(found) if result is None]
        if self.older and new:
            before = list(map(self.older.get, [words[i] for i in new]))
            again = [(i, r) for i, r in zip(new, before) if r is not None]
            for i, r in again:
                found[i] = r
            self.put([words[i] for i, _ in again], [r for _, r in again])
            new = [i for i, r in zip(new, before) if r is None]
        if new:
            asked = [words[i] for i in new]
            made = make(asked)
            for i, r in zip(new, made, strict=True):
                found[i] = r
            self.put(asked, made)
        return found


def cut_words(texts: list[str]) -> tuple[list[str], list[str], np.ndarray, np.ndarray]:
    """Texts cut at the single blanks between two other characters.

    The first part of each text, the distinct other parts, and for each text which of them
    follow: numbers of parts, and the bounds of the texts in them. For byte-level BPE: a match
    of its split pattern that holds a blank starts with it or lies in a run of white space, so
    no match crosses such a cut, and the parts can be encoded one by one, all but the first
    with the blank before them.
    """
    split = pc.split_pattern(pa.array(texts, pa.string()), " ")
    coded, bounds = split.values.dictionary_encode(), split.offsets.to_numpy().astype(np.int64)
    index, words = coded.indices.to_numpy().astype(np.int64), coded.dictionary.to_numpy(zero_copy_only=False).tolist()
    # Parts that show that their text has other white space beside a blank.
    size = pc.binary_length(coded.dictionary).to_numpy()
    odd = (size == 0) | (size != pc.binary_length(pc.utf8_trim_whitespace(coded.dictionary)).to_numpy())
    odd_texts = np.flatnonzero(np.logical_or.reduceat(odd[index], bounds[:-1])) if texts else ()
    if len(odd_texts):
        numbers, bent = {w: i for i, w in enumerate(words)}, [_SINGLE_BLANK.split(texts[i]) for i in odd_texts.tolist()]
        new = [np.array([numbers.setdefault(w, len(numbers)) for w in parts], np.int64) for parts in bent]
        runs = [index[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
        for i, parts in zip(odd_texts.tolist(), new):
            runs[i] = parts
        words, index = list(numbers), np.concatenate(runs)
        bounds = np.cumsum([0, *map(len, runs)])
    first = bounds[:-1]
    heads = [words[i] for i in index[first].tolist()]
    rest = np.delete(index, first)
    used = np.bincount(rest, minlength=len(words)) > 0
    return heads, [words[i] for i in np.flatnonzero(used).tolist()], (np.cumsum(used) - 1)[rest], bounds - np.arange(len(bounds))


def plain_words(new: list[str]) -> tuple[list[str], list[str], list[str]]:
    """Words of letters only, such words with one mark after them, and all others.

    With the blank before it the first is one match of the split pattern, and the second two.
    """
    letters = [w for w in new if w.isalpha()]
    rest = [w for w in new if not w.isalpha()]
    marked = [w for w in rest if w[-1:] in _MARKS and w[:-1].isalpha()]
    done = set(marked)
    return letters, marked, [w for w in rest if w not in done]


_MARKS = frozenset(".,;:!?")
