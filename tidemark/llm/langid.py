"""Language identification by bit-sliced Bloom filters over byte n-grams (operator 4).

One filter per language, all of the same size and hashes, are stored side by side: a row of
the table holds one bit of every filter. The rows that an n-gram hashes to, joined by AND,
are a mask of all languages that contain it. A text's masks are counted per language, the
counts are corrected for the filters' false positives, and the best share decides.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import column, fold, identified, text_slices, written

#: Bytes of an n-gram.
GRAM = 4
#: A language contains an n-gram that makes up this share of its n-grams, so at most 1/LEAST_SHARE of them,
#: unless another language has it over 1/LEAST_RATIO times as often: foreign passages bring those in.
LEAST_SHARE, LEAST_RATIO = 1e-5, 0.05
#: Rows of the table, a power of two, and the odd factors of the hashes.
ROWS = 1 << 20
FACTORS = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D)
#: How fast a lead in the share of n-grams becomes certainty, and how many n-grams count as much evidence.
SHARPNESS, ENOUGH = 0.25, 200
HELD_OUT = 5
UNKNOWN = "und"


def _folded() -> bytes:
    """Letters in lower case and bytes of other scripts as they are; all else is a blank."""
    table = bytearray(b" " * 256)
    for b in range(256):
        if b >= 128 or chr(b).isalpha():
            table[b] = ord(chr(b).lower()) if b < 128 else b
    return bytes(table)


_FOLDED = _folded()


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of all texts in one array, and where each text's begin (one more for the end).

    A text is set in blanks, so that one letter already makes an n-gram.
    """
    parts = [b" " + t.encode().translate(_FOLDED) + b"  " for t in texts]
    sizes = np.array([len(p) for p in parts])
    raw = np.frombuffer(b"".join(parts), np.uint8).astype(np.uint32)
    if len(raw) < GRAM:
        return np.empty(0, np.uint32), np.zeros(len(texts) + 1, np.int64)
    code = raw[: len(raw) - GRAM + 1].copy()
    for i in range(1, GRAM):
        code <<= np.uint32(8)
        code |= raw[i : len(raw) - GRAM + 1 + i]
    ends = np.cumsum(sizes)
    inside = np.ones(len(code), bool)
    for i in range(1, GRAM):  # n-grams that reach into the next text
        crossing = ends[:-1] - i
        inside[crossing[crossing < len(inside)]] = False
    starts = np.concatenate([[0], np.cumsum(sizes - GRAM + 1)])
    return code[inside], starts


def _slots(code: np.ndarray, rows: int) -> Iterator[np.ndarray]:
    shift = np.uint32(32 - (rows.bit_length() - 1))
    for factor in FACTORS:
        yield ((code ^ (code >> np.uint32(15))) * np.uint32(factor)) >> shift


@dataclass
class Filters:
    """The languages, the table (rows by words of 64 languages), and each filter's false positive rate."""

    languages: list[str]
    table: np.ndarray
    wrong: np.ndarray

    @classmethod
    def build(cls, members: dict[str, np.ndarray], rows: int = ROWS) -> Filters:
        languages = sorted(members)
        table = np.zeros((rows, max(1, -(-len(languages) // 64))), np.uint64)
        wrong = np.zeros(len(languages))
        for i, language in enumerate(languages):
            bit = np.uint64(1) << np.uint64(i % 64)
            for slot in _slots(members[language].astype(np.uint32), rows):
                table[slot, i // 64] |= bit
            wrong[i] = ((table[:, i // 64] & bit) > 0).mean() ** len(FACTORS)
        return cls(languages, table, np.minimum(wrong, 0.999))

    def shares(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Number of n-grams of each text, and the corrected share of them that each language contains."""
        code, starts = grams(texts)
        sizes = np.diff(starts)
        masks = None
        for slot in _slots(code, len(self.table)):
            found = self.table[slot]
            masks = found if masks is None else masks & found
        hits = np.zeros((len(texts), len(self.languages)))
        for i in range(len(self.languages)):
            bit = (masks[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1)
            total = np.concatenate([[0], np.cumsum(bit, dtype=np.int64)])
            hits[:, i] = total[starts[1:]] - total[starts[:-1]]
        share = hits / np.maximum(sizes, 1)[:, None]
        return sizes, np.clip((share - self.wrong) / (1 - self.wrong), 0, 1)

    def decide(self, texts: list[str]) -> tuple[list[str], list[float]]:
        """Language and score of each text; texts without a letter are unknown."""
        if not self.languages:
            return [UNKNOWN] * len(texts), [0.0] * len(texts)
        sizes, shares = self.shares(texts)
        lead = shares - shares.max(1, keepdims=True)
        weight = np.exp(SHARPNESS * np.minimum(sizes, ENOUGH)[:, None] * lead)
        best = shares.argmax(1)
        scores = (1 / weight.sum(1)) * shares.max(1)
        named = [self.languages[b] if any(map(str.isalpha, t)) else UNKNOWN for b, t in zip(best, texts)]
        return named, [float(s) if n != UNKNOWN else 0.0 for s, n in zip(scores, named)]


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Filters:
    """Learn from all texts with a language outside the held-out fold.

    Counts are added up per task before they are shuffled, so a language with most of the rows
    is no hot spot; what reaches the driver is at most 1/LEAST_SHARE n-grams a language.
    """
    rows = docs.select(
        column(id_col).alias("id"), column(text_col).alias("text"), column(lang_col).cast("string").alias("lang")
    ).filter((fold(F.col("id"), HELD_OUT) != 0) & F.col("text").isNotNull() & F.col("lang").isNotNull())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            languages = batch.column(2).to_pylist()
            at = 0
            for ids, texts in text_slices(batch):
                own = np.array(languages[at : at + len(ids)], object)
                at += len(ids)
                for language in set(own.tolist()):
                    code, _ = grams([t for t, o in zip(texts, own) if o == language])
                    code, n = np.unique(code, return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([language] * len(code), pa.string()), pa.array(code.astype(np.int64)), pa.array(n)],
                        names=["lang", "gram", "n"],
                    )

    counts = rows.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    counts = written(counts, "grams")
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    share = counts.join(F.broadcast(totals), "lang").withColumn("share", F.col("n") / F.col("total"))
    most = F.max("share").over(Window.partitionBy("gram"))
    kept = share.withColumn("most", most).filter(
        (F.col("share") >= LEAST_SHARE) & (F.col("share") >= LEAST_RATIO * F.col("most"))
    )
    found = kept.select("lang", "gram").toPandas()
    return Filters.build({lang: g["gram"].to_numpy() for lang, g in found.groupby("lang")})


def identify(docs: DataFrame, filters: Filters, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, held_out, lang_pred, score.

    A null text, one without a letter, and every text if nothing was learnt are ``und`` with
    score 0; of equal shares the language first in the alphabet wins. Repeated rows get a row
    each; a null id is held out, as nothing was learnt from it. An empty table gives no rows;
    other columns are not read.
    """
    source = identified(docs, id_col, text_col)
    id_type = source.schema["id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(filters)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            for ids, texts in text_slices(batch, 1_000_000):
                named, scores = own.decide(texts)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids, batch.schema.field(0).type),
                        pa.array(named, pa.string()),
                        pa.array(scores, pa.float64()),
                    ],
                    names=["id", "lang_pred", "score"],
                )

    held = F.coalesce(fold(F.col("id"), HELD_OUT) == 0, F.lit(True))
    return source.mapInArrow(run, f"id {id_type}, lang_pred string, score double").select(
        F.col("id").alias(id_col), held.alias("held_out"), "lang_pred", "score"
    )
