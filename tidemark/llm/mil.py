"""Text quality by attention-based multiple-instance learning (operator 2).

A document is a bag of passages. Each passage is encoded from what its bytes look like; a
gated attention weighs the passages, and the weighted mean of their encodings is scored.
Encoder, attention and classifier are learnt together from labels of whole documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import column, fold, identified, text_slices, written

#: Bytes of a passage.
PASSAGE = 320
#: Learning takes at most SAMPLE documents, chosen by the hash of their id, and of each at most BAG passages,
#: evenly spaced. Scoring takes all passages of all documents.
SAMPLE, BAG = 6_000, 24
ENCODED, ATTENTION = 24, 16
EPOCHS, BATCH, RATE, DECAY = 40, 128, 0.01, 1e-4
FOLDS, HELD_OUT = 3, 1

#: Kinds of bytes, in the order in which a byte is asked for them.
KINDS = ("upper", "lower", "digit", "blank", "line", "stop", "comma", "shout", "bar", "sign", "mark", "other")


def _kind_table() -> np.ndarray:
    table = np.full(256, KINDS.index("other"), np.int64)  # bytes of letters outside ASCII, too
    for b in range(128):
        c = chr(b)
        if c.isupper():
            kind = "upper"
        elif c.islower():
            kind = "lower"
        elif c.isdigit():
            kind = "digit"
        elif c in "\n\r":
            kind = "line"
        elif c.isspace():
            kind = "blank"
        elif c == ".":
            kind = "stop"
        elif c in ",;:":
            kind = "comma"
        elif c in "!?":
            kind = "shout"
        elif c in "|_=~":
            kind = "bar"
        elif c in "#$%&*@^<>{}[]\\/+":
            kind = "sign"
        else:
            kind = "mark"
        table[b] = KINDS.index(kind)
    return table


_KIND = _kind_table()
_N = len(KINDS)
#: Counts of neighbouring kinds, and of words: length, variety, equal to one of the two before, length of the text.
FEATURES = _N * _N + 4


def passages(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Features of all passages (a row each), and the number of passages of each text (one for an empty one)."""
    raw = [t.encode() for t in texts]
    sizes = np.array([len(r) for r in raw], np.int64)
    bags = np.maximum(1, -(-sizes // PASSAGE))
    total = int(bags.sum())
    out = np.zeros((total, FEATURES), np.float32)
    line = np.frombuffer(b"".join(raw), np.uint8)
    text_of_byte = np.repeat(np.arange(len(texts)), sizes)
    before = np.concatenate([[0], np.cumsum(sizes)])[:-1]
    first = np.concatenate([[0], np.cumsum(bags)])[:-1]
    passage = first[text_of_byte] + (np.arange(len(line)) - before[text_of_byte]) // PASSAGE
    length = np.bincount(passage, minlength=total).astype(np.float32)
    kind = _KIND[line]
    if len(line) > 1:
        same = passage[1:] == passage[:-1]
        cell = (passage[:-1] * _N + kind[:-1]) * _N + kind[1:]
        pairs = np.bincount(cell[same], minlength=total * _N * _N).reshape(total, _N * _N)
        # Square roots, so that rare pairs show beside those of plain letters.
        out[:, : _N * _N] = np.sqrt(pairs / np.maximum(length, 1)[:, None])
    white = (kind == KINDS.index("blank")) | (kind == KINDS.index("line"))
    if len(line) and not white.all():
        new_text = np.zeros(len(line), bool)
        new_text[before[sizes > 0]] = True
        begins = np.flatnonzero(~white & (np.concatenate([[True], white[:-1]]) | new_text))
        word = np.cumsum(np.bincount(begins, minlength=len(line))) - 1
        letters = ~white
        place = np.arange(len(line)) - begins[np.maximum(word, 0)]
        with np.errstate(over="ignore"):
            power = (np.arange(1, 65, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
            mixed = (line.astype(np.uint64) + np.uint64(1)) * power[place % 64]
            mixed[~letters] = 0
            code = np.add.reduceat(mixed, begins)
        own = passage[begins]
        words = np.bincount(own, minlength=total)
        again = np.zeros(len(begins), bool)
        for back in (1, 2):
            again[back:] |= (code[back:] == code[:-back]) & (own[back:] == own[:-back])
        many = np.maximum(words, 1)
        out[:, -4] = np.log1p(np.bincount(passage[letters], minlength=total) / many)
        pair = np.unique(np.stack([own.astype(np.uint64), code], 1), axis=0)
        out[:, -3] = np.bincount(pair[:, 0].astype(np.int64), minlength=total) / many
        out[:, -2] = np.bincount(own[again], minlength=total) / many
    out[:, -1] = np.log1p(np.repeat(sizes, bags)) / 10
    return out, bags


@dataclass
class Network:
    """Weights; features are shifted and scaled before the encoder."""

    shift: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray]

    def score(self, texts: list[str]) -> np.ndarray:
        x, bags = passages(texts)
        w = self.weights
        h = np.tanh((x - self.shift) / self.scale @ w["encode"] + w["bias"])
        s = (np.tanh(h @ w["tanh"]) / (1 + np.exp(-(h @ w["gate"])))) @ w["attend"]
        starts = np.concatenate([[0], np.cumsum(bags)])[:-1]
        s = np.exp(s - np.repeat(np.maximum.reduceat(s, starts), bags))
        a = s / np.repeat(np.add.reduceat(s, starts), bags)
        z = np.add.reduceat(h * a[:, None], starts, axis=0)
        return 1 / (1 + np.exp(-(z @ w["out"] + w["offset"][0])))


def _gradients(w: dict, x: np.ndarray, real: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
    """Gradients of the mean log loss over padded bags (documents, passages, features)."""
    h = np.tanh(x @ w["encode"] + w["bias"])
    t, g = np.tanh(h @ w["tanh"]), 1 / (1 + np.exp(-(h @ w["gate"])))
    s = np.where(real, (t * g) @ w["attend"], -1e9)
    a = np.exp(s - s.max(1, keepdims=True))
    a /= a.sum(1, keepdims=True)
    z = np.einsum("bk,bkh->bh", a, h)
    p = 1 / (1 + np.exp(-(z @ w["out"] + w["offset"][0])))
    d = (p - y) / len(y)
    dz = d[:, None] * w["out"]
    da = np.einsum("bh,bkh->bk", dz, h)
    ds = a * (da - (a * da).sum(1, keepdims=True))
    de = ds[..., None] * w["attend"]
    dt, dg = de * g * (1 - t * t), de * t * g * (1 - g)
    dh = a[..., None] * dz[:, None, :] + dt @ w["tanh"].T + dg @ w["gate"].T
    dh *= 1 - h * h

    def summed(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return left.reshape(-1, left.shape[-1]).T @ right.reshape(-1, right.shape[-1])

    return {
        "encode": summed(x, dh),
        "bias": dh.sum((0, 1)),
        "tanh": summed(h, dt),
        "gate": summed(h, dg),
        "attend": np.einsum("bkh,bk->h", t * g, ds),
        "out": z.T @ d,
        "offset": np.array([d.sum()]),
    }


def train(bags: list[np.ndarray], labels: np.ndarray, seed: int = 7) -> Network:
    """Fit the network to bags of passage features by Adam."""
    rng = np.random.default_rng(seed)
    every = np.concatenate(bags)
    shift, scale = every.mean(0), every.std(0) + 0.02
    share = float(np.clip(labels.mean(), 0.01, 0.99))
    weights = {
        "encode": rng.normal(0, 1 / np.sqrt(FEATURES), (FEATURES, ENCODED)),
        "bias": np.zeros(ENCODED),
        "tanh": rng.normal(0, 1 / np.sqrt(ENCODED), (ENCODED, ATTENTION)),
        "gate": rng.normal(0, 1 / np.sqrt(ENCODED), (ENCODED, ATTENTION)),
        "attend": rng.normal(0, 1 / np.sqrt(ATTENTION), ATTENTION),
        "out": np.zeros(ENCODED),
        "offset": np.array([np.log(share / (1 - share))]),
    }
    if labels.min() == labels.max():
        return Network(shift, scale, weights)
    scaled = [((b - shift) / scale).astype(np.float32) for b in bags]
    mean = {k: np.zeros_like(v) for k, v in weights.items()}
    square = {k: np.zeros_like(v) for k, v in weights.items()}
    step = 0
    for epoch in range(EPOCHS):
        rate = RATE * 0.5 * (1 + np.cos(np.pi * epoch / EPOCHS))
        order = rng.permutation(len(scaled))
        for at in range(0, len(order), BATCH):
            rows = order[at : at + BATCH]
            widest = max(len(scaled[i]) for i in rows)
            x = np.zeros((len(rows), widest, FEATURES), np.float32)
            real = np.zeros((len(rows), widest), bool)
            for j, i in enumerate(rows):
                x[j, : len(scaled[i])] = scaled[i]
                real[j, : len(scaled[i])] = True
            step += 1
            for k, g in _gradients(weights, x, real, labels[rows]).items():
                g = g + DECAY * weights[k]
                mean[k] = 0.9 * mean[k] + 0.1 * g
                square[k] = 0.999 * square[k] + 0.001 * g * g
                weights[k] = weights[k] - rate * (mean[k] / (1 - 0.9**step)) / (
                    np.sqrt(square[k] / (1 - 0.999**step)) + 1e-8
                )
    return Network(shift, scale, weights)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    sample: int = SAMPLE,
    bag: int = BAG,
) -> Network:
    """Learn from at most ``sample`` labelled documents outside the held-out fold.

    Without labels every text scores a half; if all labels are equal, nearly that label.
    """
    rows = labels.select(column(id_col).alias("id"), column(label_col).cast("int").alias("label"))
    rows = rows.filter(F.col("label").isNotNull() & (fold(F.col("id"), FOLDS) != HELD_OUT))
    chosen = rows.groupBy("id").agg(F.max("label").alias("label")).orderBy(F.xxhash64("id"), "id").limit(sample)
    chosen = written(chosen, "labels")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, label in zip(batch.column(1), batch.column(2)):
                x, _ = passages([text.as_py()])
                x = x[np.unique(np.linspace(0, len(x) - 1, min(bag, len(x))).astype(int))]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([label.as_py()], pa.int32()),
                        pa.array([x.astype(np.float16).tobytes()], pa.binary()),
                    ],
                    names=["label", "x"],
                )

    found = identified(docs, id_col, text_col).join(F.broadcast(chosen), "id").select("id", "text", "label")
    # At most sample * bag * FEATURES half floats.
    got = found.mapInArrow(encode, "label int, x binary").collect()
    if not got:
        return train([np.zeros((1, FEATURES), np.float32)] * 2, np.array([0.0, 1.0]))
    got.sort(key=lambda r: (bytes(r["x"]), r["label"]))  # the same model, whatever the order of the rows
    bags = [np.frombuffer(bytes(r["x"]), np.float16).reshape(-1, FEATURES).astype(np.float32) for r in got]
    return train(bags, np.array([float(r["label"] > 0) for r in got]))


def score(docs: DataFrame, network: Network, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, held_out, score, predicted.

    A null or empty text is one passage without content and scores like any other. Repeated
    rows get a row each; a null id is held out, as nothing was learnt from it. An empty table
    gives no rows; other columns are not read.
    """
    source = identified(docs, id_col, text_col)
    id_type = source.schema["id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(network)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            for ids, texts in text_slices(batch, 500_000):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, batch.schema.field(0).type), pa.array(own.score(texts), pa.float64())],
                    names=["id", "score"],
                )

    held = F.coalesce(fold(F.col("id"), FOLDS) == HELD_OUT, F.lit(True))
    return source.mapInArrow(run, f"id {id_type}, score double").select(
        F.col("id").alias(id_col), held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
