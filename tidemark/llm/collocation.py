"""Phrase collocations by Rabin-Karp fingerprints (operator 13).

Every run of one to four words gets a 64-bit fingerprint from prefix polynomials over the
word codes of a batch. Only fingerprints are shuffled, with their counts and the sum of a
second, independent fingerprint. Runs are looked for level by level: a phrase can only be
frequent if its shorter parts are, which a bit filter over the frequent fingerprints of the
level before tells. Its size is bounded; where it is too small for the corpus it lets through
more, and no phrase is lost.

A last pass points each frequent fingerprint to one occurrence, where its phrase is read. The
text must give the fingerprint again. If its second fingerprint times the count isn't the sum
found, the fingerprint stands for several phrases: they are counted again by their text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.bits import Filter, bit_filter
from tidemark.llm.common import column, written

#: Longest phrase in words, least count of a candidate, rows kept of each language, and when a longer phrase covers one.
LONGEST, LEAST, TOP, COVER = 4, 30, 2000, 80
UNKNOWN = "und"
#: Parts of a language whose best phrases are found apart.
PARTS = 64
#: Bytes of text worked on together, and where a longer text is cut (between two pieces).
SLICE = 1 << 20
#: Bits of a second fingerprint, few enough for the sum over any number of occurrences, and of a task's memory of pointers.
CHECK_BITS, POINTED = 22, 18

_U, _ALL = np.uint64, (1 << 64) - 1
_UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: A-Z to a-z, the marks and line ends between pieces to \n, tab to blank. Byte for byte, so offsets stay.
_FOLD = bytes.maketrans(_UPPER + b".,;:!?\x0b\x0c\r\t", _UPPER.lower() + b"\n" * 9 + b" ")


def _odd(rng: np.random.Generator) -> int:
    return int(rng.integers(1 << 63, dtype=np.uint64)) * 2 + 1


class _Polynomial:
    """One family of fingerprints: codes of bytes, and the bases of the polynomials over bytes and over words."""

    def __init__(self, seed: int) -> None:
        rng = np.random.default_rng(seed)
        self.codes = rng.integers(np.iinfo(np.uint64).max, size=256, dtype=np.uint64, endpoint=True)
        self.byte_base, self.word_base = _odd(rng), _odd(rng)
        self.inverse = pow(self.word_base, -1, 1 << 64)


FIRST, SECOND = _Polynomial(1), _Polynomial(2)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(max(n, 1), _U(base))
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    """Spreads a sum over all bits, as the low bits of a polynomial modulo 2^64 depend on the low bits only."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def language_code(lang: str) -> int:
    return xxhash.xxh64_intdigest(lang.encode(), 13)


class Words:
    """The words of several texts, folded by ``fold``, and the fingerprints of their runs."""

    def __init__(self, parts: list[bytes], langs: list[int]) -> None:
        data = np.frombuffer(b"\n".join(parts), np.uint8)
        word = (data != 10) & (data != 32)
        edge = np.flatnonzero(np.diff(word, prepend=False, append=False))
        self.starts, self.ends = edge[::2], edge[1::2]
        self.count = len(self.starts)
        breaks = np.flatnonzero(data == 10)
        self.piece = np.searchsorted(breaks, self.starts)
        sizes = np.array([len(p) + 1 for p in parts], np.int64)
        self.begins = np.cumsum(sizes) - sizes
        self.part = np.searchsorted(self.begins, self.starts, side="right") - 1
        self.langs = np.array(langs, np.uint64)[self.part] if self.count else np.zeros(0, np.uint64)
        lengths = self.ends - self.starts
        first = np.cumsum(lengths) - lengths
        held = data[word]
        place = np.arange(len(held)) - np.repeat(first, lengths)
        self._sums = []
        for family in (FIRST, SECOND):
            if not self.count:
                self._sums.append(np.zeros(1, np.uint64))
                continue
            powers = _powers(family.byte_base, int(lengths.max()))
            codes = _mixed(np.add.reduceat(family.codes[held] * powers[place], first))
            terms = codes * _powers(family.word_base, self.count)
            self._sums.append(np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)]))

    def whole(self, size: int) -> np.ndarray:
        """First words of the runs of this many words that lie inside one piece."""
        if self.count < size:
            return np.zeros(0, np.int64)
        last = size - 1
        return np.flatnonzero(self.piece[: self.count - last] == self.piece[last:])

    def prints(self, at: np.ndarray, size: int, family: _Polynomial = FIRST) -> np.ndarray:
        """Fingerprints of the runs of this many words from these words on, of their language."""
        sums = self._sums[family is SECOND]
        run = sums[at + size] - sums[at]
        shifted = run * _powers(family.inverse, self.count)[at] if len(at) else run
        return _mixed(shifted + self.langs[at] + _U(size * 0x9E3779B97F4A7C15 & _ALL))


def fold(text: bytes) -> bytes:
    return text.translate(_FOLD)


def _parts(text: bytes) -> Iterator[tuple[int, bytes]]:
    """A folded text in parts of about SLICE bytes, cut between pieces, each with its offset."""
    at = 0
    while len(text) - at > SLICE:
        cut = text.rfind(b"\n", at, at + SLICE)
        if cut < 0:
            cut = text.find(b"\n", at + SLICE)
        if cut < 0:
            break
        yield at, text[at:cut]
        at = cut + 1
    yield at, text[at:]


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Words, np.ndarray, np.ndarray, list[bytes]]]:
    """Words of about SLICE bytes of text, with the document and offset of each of their parts."""
    parts, langs, docs, offsets, held = [], [], [], [], 0
    for batch in batches:
        codes: dict[str, int] = {}
        for doc, lang, text in zip(*batch.columns):
            lang, text = lang.as_py(), fold(text.as_py().encode())
            if lang not in codes:
                codes[lang] = language_code(lang)
            for offset, part in _parts(text):
                if held and held + len(part) > SLICE:
                    yield Words(parts, langs), np.array(docs, np.int64), np.array(offsets, np.int64), parts
                    parts, langs, docs, offsets, held = [], [], [], [], 0
                parts.append(part)
                langs.append(codes[lang])
                docs.append(doc.as_py())
                offsets.append(offset)
                held += len(part) + 1
    if parts:
        yield Words(parts, langs), np.array(docs, np.int64), np.array(offsets, np.int64), parts


def _prints(words: Words, at: np.ndarray, size: int, mask: int) -> np.ndarray:
    """First fingerprints. ``mask`` leaves fewer bits of them, but the empty run, met once for each word, keeps its own."""
    return words.prints(at, size) & _U(mask if size else _ALL)


def _checks(words: Words, at: np.ndarray, size: int) -> np.ndarray:
    return (words.prints(at, size, SECOND) >> _U(64 - CHECK_BITS)).astype(np.int64)


def _combined(words: Words, at: np.ndarray, size: int, mask: int) -> pa.RecordBatch:
    """A row per fingerprint of these runs: its count and the sum of its second values."""
    prints = _prints(words, at, size, mask)
    order = np.argsort(prints)
    ranked = prints[order]
    heads = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
    sums = np.add.reduceat(_checks(words, at, size)[order], heads)
    columns = [ranked[heads].view(np.int64), np.diff(np.append(heads, len(ranked))), sums]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["fp", "n", "checks"])


def _runs(words: Words, size: int, known: Filter | None, mask: int) -> np.ndarray:
    """First words of the runs of this size whose parts, shorter by a word, are all in the filter."""
    at = words.whole(size)
    if known is None or not len(at):
        return at
    shorter = np.zeros(words.count + 1, bool)
    inner = words.whole(size - 1)
    shorter[inner] = known.holds(_prints(words, inner, size - 1, mask))
    return at[shorter[at] & shorter[at + 1]]


def _counted(docs: DataFrame, sizes: tuple[int, ...], known: Filter | None, mask: int, least: int) -> DataFrame:
    """The fingerprints of runs of these sizes found at least so often, with n and checks."""
    shared = docs.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for words, *_ in _slices(batches):
            for size in sizes:
                at = _runs(words, max(size, 1), shared.value, mask)
                if len(at):
                    yield _combined(words, at, size, mask)

    counts = docs.mapInArrow(run, "fp long, n long, checks long").groupBy("fp")
    return counts.agg(F.sum("n").alias("n"), F.sum("checks").alias("checks")).filter(F.col("n") >= least)


def _pointers(docs: DataFrame, filters: list[Filter], mask: int) -> DataFrame:
    """For fingerprints that may be in the filters one place each (fp, doc, at, size). The first filter has the empty runs too."""
    shared = docs.sparkSession.sparkContext.broadcast(filters)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # What the task pointed to lately; what it forgets is pointed to again.
        before = np.zeros(1 << POINTED, np.uint64)
        for words, docs, offsets, _ in _slices(batches):
            for size in range(len(shared.value) + 1):
                at = words.whole(max(size, 1))
                prints = _prints(words, at, size, mask)
                slot = (prints >> _U(64 - POINTED)).astype(np.int64)
                new = shared.value[max(size, 1) - 1].holds(prints) & (before[slot] != prints)
                at, prints, slot = at[new], prints[new], slot[new]
                if not len(at):
                    continue
                prints, first = np.unique(prints, return_index=True)
                at = at[first]
                before[slot[first]] = prints
                part = words.part[at]
                where = words.starts[at] - words.begins[part] + offsets[part]
                length = words.ends[at + size - 1] - words.starts[at] if size else np.zeros_like(at)
                columns = [prints.view(np.int64), docs[part], where, length.astype(np.int32)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["fp", "doc", "at", "size"])

    rows = docs.mapInArrow(run, "fp long, doc long, at long, size int").groupBy("fp")
    return rows.agg(F.min("doc").alias("doc"), F.min_by("at", "doc").alias("at"), F.min_by("size", "doc").alias("size"))


def _materialised(docs: DataFrame, prints: DataFrame, mask: int) -> DataFrame:
    """fp, lang, words, phrase and n, read at the pointers; ``several`` if the fingerprint stands for other phrases too.

    The text must give the fingerprint again, so texts whose keys are equal can't be mixed up.
    """
    runs = prints.groupBy("doc").agg(F.collect_list(F.struct("fp", "n", "checks", "at", "size")).alias("runs"))
    runs = written(runs, "pointers")  # a document has no more of them than runs of words
    texts = docs.join(runs.select("doc"), "doc", "left_semi").dropDuplicates(["doc", "lang", "text"])
    found = written(texts, "pointed").join(runs, "doc").select("lang", "text", "runs")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, text, held in zip(*batch.columns):
                lang, text, held = lang.as_py(), fold(text.as_py().encode()), held.as_py()
                # Runs hold no end of line, so each is a part of its own.
                parts = [text[r["at"] : r["at"] + r["size"]] for r in held]
                words = Words(parts, [language_code(lang)] * len(parts))
                sizes = np.bincount(words.part, minlength=len(parts))
                begins = np.cumsum(sizes) - sizes
                prints = np.full(len(parts), _mixed(np.array([language_code(lang)], np.uint64))[0])
                checks = np.zeros(len(parts), np.int64)
                for size in set(sizes.tolist()) - {0}:
                    of = np.flatnonzero(sizes == size)
                    prints[of] = _prints(words, begins[of], size, mask)
                    checks[of] = _checks(words, begins[of], size)
                n, sums = (np.array([r[c] for r in held], np.int64) for c in ("n", "checks"))
                own = np.flatnonzero(prints.view(np.int64) == np.array([r["fp"] for r in held]))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([held[i]["fp"] for i in own], pa.int64()),
                        pa.array([lang] * len(own), pa.string()),
                        pa.array(sizes[own].astype(np.int32)),
                        pa.array([b" ".join(w for w in parts[i].split(b" ") if w).decode() for i in own], pa.string()),
                        pa.array(n[own]),
                        pa.array((n * checks != sums)[own]),
                    ],
                    names=["fp", "lang", "words", "phrase", "n", "several"],
                )

    return found.mapInArrow(run, "fp long, lang string, words int, phrase string, n long, several boolean")


def _recounted(docs: DataFrame, several: DataFrame, count: int, mask: int, least: int) -> DataFrame:
    """The phrases behind fingerprints that stand for several, counted by their text."""
    shared = docs.sparkSession.sparkContext.broadcast(bit_filter(several, count))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column(1).to_pylist()
            rows = pa.array(np.arange(batch.num_rows))
            numbered = pa.RecordBatch.from_arrays([rows, *batch.columns[1:]], names=["row", "lang", "text"])
            for words, keys, _, parts in _slices(iter([numbered])):
                for size in range(1, LONGEST + 1):
                    at = words.whole(size)
                    prints = _prints(words, at, size, mask)
                    hit = shared.value.holds(prints)
                    found: dict[tuple[int, str, str], int] = {}
                    for i, fp in zip(at[hit].tolist(), prints[hit].view(np.int64).tolist()):
                        part = words.part[i]
                        run_of = [
                            parts[part][words.starts[j] - words.begins[part] : words.ends[j] - words.begins[part]]
                            for j in range(i, i + size)
                        ]
                        key = (fp, names[keys[part]], b" ".join(run_of).decode())
                        found[key] = found.get(key, 0) + 1
                    fps, langs, phrases = zip(*found) if found else ((), (), ())
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(fps, pa.int64()),
                            pa.array(langs, pa.string()),
                            pa.array([size] * len(fps), pa.int32()),
                            pa.array(phrases, pa.string()),
                            pa.array(list(found.values()), pa.int64()),
                        ],
                        names=["fp", "lang", "words", "phrase", "n"],
                    )

    rows = docs.mapInArrow(run, "fp long, lang string, words int, phrase string, n long")
    rows = rows.join(several.select("fp").distinct(), "fp", "left_semi")
    return rows.groupBy("lang", "words", "phrase").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)


def frequent_phrases(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST, longest: int = LONGEST,
    print_bits: int = 64,
) -> DataFrame:
    """lang, words, phrase, n of all phrases of up to ``longest`` words found at least ``least`` times in a language.

    A row with no words and the empty phrase gives a language's number of words, if it has as
    many. Null text is empty, null language is ``und``. An empty table gives no rows; other columns are not read.
    """
    if not 1 <= longest <= LONGEST:
        raise ValueError(f"phrases have 1 to {LONGEST} words")
    mask = ((1 << print_bits) - 1) << (64 - print_bits)
    text, lang = F.coalesce(column(text_col), F.lit("")), F.coalesce(column(lang_col), F.lit(UNKNOWN))
    docs = docs.select(F.xxhash64(lang, text).alias("doc"), lang.alias("lang"), text.alias("text"))
    levels, filters = [], [None]
    for size in range(1, longest + 1):
        level = written(_counted(docs, (0, 1) if size == 1 else (size,), filters[-1], mask, least), "prints")
        levels.append(level)
        filters.append(bit_filter(level, level.count()))
    prints = levels[0]
    for level in levels[1:]:
        prints = prints.unionByName(level)
    prints = prints.join(written(_pointers(docs, filters[1:], mask), "places"), "fp")
    phrases = written(_materialised(docs, prints, mask), "phrases")
    several = phrases.filter("several AND words > 0").select("fp").distinct()
    count = several.count()
    sure = phrases.filter("NOT several OR words = 0").select("lang", "words", "phrase", "n")
    if not count:
        return sure
    several = written(several, "several")
    return written(sure.unionByName(_recounted(docs, several, count, mask, least)), "recounted")


def _exact(name: str | Column) -> Column:
    """A long as a decimal, whose products don't overflow."""
    return (F.col(name) if isinstance(name, str) else name).cast("decimal(20,0)")


def collocations(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST, top: int = TOP,
    cover: int = COVER, print_bits: int = 64,
) -> DataFrame:
    """The best ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    A phrase's score is the lowest of floor(2000000 a / (l + r)) over its cuts into two parts
    of counts l and r. Phrases inside a longer one that makes up ``cover`` per cent of their
    count are left out. Ties go by count, then by the bytes of the phrase.
    """
    known = written(frequent_phrases(docs, text_col, lang_col, least, print_bits=print_bits), "frequent")
    words = F.split("phrase", " ")
    candidates = known.filter("words > 1").select("lang", "words", "phrase", F.col("n").alias("a"))

    # Both parts of each cut; they are frequent too, and their counts are looked up as rows.
    def joined(first: Column, size: Column) -> Column:
        return F.concat_ws(" ", F.slice(words, first, size))

    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    k, one = F.col("k"), F.lit(1)
    sides = F.array(
        F.struct(F.lit("l").alias("side"), joined(one, k).alias("part")),
        F.struct(F.lit("r").alias("side"), joined(k + 1, F.col("words") - k).alias("part")),
    )
    parts = cuts.withColumn("s", F.explode(sides)).select("lang", "phrase", "a", "k", "s.side", "s.part")
    counts = known.select("lang", F.col("phrase").alias("part"), "n")
    scored = (
        written(parts, "parts")
        .join(counts, ["lang", "part"])
        .groupBy("lang", "phrase", "a", "k")
        .agg(F.max(F.when(F.col("side") == "l", F.col("n"))).alias("l"), F.max(F.when(F.col("side") == "r", F.col("n"))).alias("r"))
        .withColumn("score", F.expr("(2000000 * cast(a AS decimal(20,0))) div (cast(l AS decimal(20,0)) + cast(r AS decimal(20,0)))"))
        .groupBy("lang", "phrase", "a")
        .agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    )
    # The largest count of a longer candidate around each phrase.
    spans = F.expr(
        "flatten(transform(sequence(2, words - 1), m -> transform(sequence(1, words - m + 1), i -> "
        "concat_ws(' ', slice(split(phrase, ' '), i, m)))))"
    )
    around = (
        candidates.filter("words > 2")
        .select("lang", F.explode(spans).alias("phrase"), "a")
        .groupBy("lang", "phrase")
        .agg(F.max("a").alias("longer"))
    )
    covered = _exact("longer") * 100 >= _exact("a") * cover
    kept = scored.join(around, ["lang", "phrase"], "left").filter(~F.coalesce(covered, F.lit(False)))
    kept = kept.select("lang", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), F.col("cut.score").alias("score"))
    # The best of each part of a language first, so that no task sorts more than TOP rows of each part.
    best = [F.desc("score"), F.desc("a"), "phrase"]
    part = F.pmod(F.xxhash64("phrase"), F.lit(PARTS))
    ranked = kept.withColumn("rank", F.row_number().over(Window.partitionBy("lang", part).orderBy(*best))).filter(F.col("rank") <= top)
    ranked = ranked.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best))).filter(F.col("rank") <= top)
    totals = known.filter("words = 0").select("lang", F.col("n").alias("total"))
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", F.col("total").alias("n"), "score"
    )
