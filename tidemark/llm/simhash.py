"""SimHash near-duplicates through a Gray-order hierarchical index (operator 7).

Distinct fingerprints are sorted by Gray rank, in which neighbours differ in few bits. The
index groups them into nodes; a node holds the bits that all below it share and that no node
above it holds. A search goes down level by level, adds up the differences found so far, and
drops a whole group as soon as they exceed the limit.

Across tasks the bits are cut into blocks. Fingerprints that differ in at most ``differ``
bits agree in all but ``differ`` of them, so every link is found where fingerprints with the
same other blocks meet; with four blocks those are 32 equal bits, of which even a crowd of
near copies shares only a part.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import column, identified, text_slices, written
from tidemark.llm.components import components

SHINGLE, SEED, DIFFER = 3, 42, 2
#: Of 16 bits each.
BLOCKS = 4
#: Children of a node of the index.
FAN = 8
#: Fingerprints indexed together, and searches in flight; they bound memory, not results.
CHUNK, SEARCHES = 200_000, 20_000

_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def fingerprint(text: str, size: int = SHINGLE, seed: int = SEED) -> int:
    """64-bit SimHash of the word shingles of a text, repeats included; A-Z count as a-z.

    A text of fewer words is one shingle; a text without words has fingerprint 0. A bit is
    set if it is set in over half of the shingles' XXH64 hashes.
    """
    words = _WORD.findall(text.encode().translate(_LOWER))
    if not words:
        return 0
    if len(words) <= size:
        return xxhash.xxh64_intdigest(b" ".join(words), seed)
    shingles = map(b" ".join, zip(*[words[i:] for i in range(size)]))
    digest = xxhash.xxh64_digest
    count = len(words) - size + 1
    raw = b"".join([digest(s, seed) for s in shingles])  # big-endian
    ones = np.zeros(64, np.int64)
    for at in range(0, len(raw), 8 * 4096):
        bits = np.unpackbits(np.frombuffer(raw, np.uint8, offset=at, count=min(8 * 4096, len(raw) - at)))
        ones += bits.reshape(-1, 64).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > count).tobytes(), "big")


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Position of each 64-bit word in the reflected Gray order."""
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


class GrayIndex:
    """Hierarchical index over distinct fingerprints, given in any order."""

    def __init__(self, codes: np.ndarray, fan: int = FAN) -> None:
        self.codes = codes[np.argsort(gray_rank(codes), kind="stable")]
        self.fan = fan
        ones, zeros = self.codes, ~self.codes  # bits that are 1 (0) in all below
        shared = []
        while True:
            shared.append((ones | zeros, ones))
            if len(ones) <= 1:
                break
            starts = np.arange(0, len(ones), fan)
            ones, zeros = np.bitwise_and.reduceat(ones, starts), np.bitwise_and.reduceat(zeros, starts)
        # From the root down: the shared bits that the parent doesn't hold already, and their values.
        self.levels = []
        above = np.zeros(1, np.uint64)
        for mask, value in reversed(shared):
            own = mask if not self.levels else mask & ~above[np.arange(len(mask)) // fan]
            self.levels.append((own, value & own))
            above = mask

    def links(self, differ: int, must: np.uint64) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (i < j) of places in ``codes`` at most ``differ`` bits apart and equal in the bits ``must``."""
        for first in range(0, len(self.codes), SEARCHES):
            places = np.arange(first, min(first + SEARCHES, len(self.codes)))
            query = places
            node = np.zeros(len(places), np.int64)
            spent = np.zeros(len(places), np.uint8)
            for depth, (mask, value) in enumerate(self.levels):
                if depth:
                    children = (node[:, None] * self.fan + np.arange(self.fan)).ravel()
                    query, spent = np.repeat(query, self.fan), np.repeat(spent, self.fan)
                    real = children < len(mask)
                    node, query, spent = children[real], query[real], spent[real]
                found = (self.codes[query] ^ value[node]) & mask[node]
                spent = spent + np.bitwise_count(found)
                live = (spent <= differ) & ((found & must) == 0)
                query, node, spent = query[live], node[live], spent[live]
            once = query < node
            yield query[once], node[once]


def _local_roots(n: int, links: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The least place that each place is linked to, directly or not."""
    root = np.arange(n)
    for a, b in links:
        while len(a):
            ra, rb = root[a], root[b]
            apart = ra != rb
            if not apart.any():
                break
            a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
            np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
            while True:
                deeper = root[root]
                if (deeper == root).all():
                    break
                root = deeper
    return root


def _kept_blocks(differ: int) -> list[tuple[int, ...]]:
    """The blocks that two linked fingerprints share, in one of these choices at least."""
    return list(combinations(range(BLOCKS), BLOCKS - differ))


def _bits(blocks: tuple[int, ...]) -> int:
    return sum(0xFFFF << (16 * b) for b in blocks)


def _moved(codes: np.ndarray, order: list[int]) -> np.ndarray:
    """Words with their 16-bit blocks in another order, the first block lowest."""
    return np.ascontiguousarray(codes.astype("<u8").view("<u2").reshape(-1, BLOCKS)[:, order]).view("<u8").ravel()


def key_links(codes: np.ndarray, keep: tuple[int, ...], differ: int) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints tied to the first of their group, for links that are equal in the blocks ``keep``.

    Those blocks become the highest bits, so that the Gray order brings equal keys together.
    """
    _, group, size = np.unique(codes & np.uint64(_bits(keep)), return_inverse=True, return_counts=True)
    codes = codes[size[group] > 1]  # a fingerprint alone with its key has no link here
    if not len(codes):
        return codes, codes
    order = [b for b in range(BLOCKS) if b not in keep] + list(keep)
    index = GrayIndex(_moved(codes, order))
    must = np.uint64(_bits(tuple(range(BLOCKS - len(keep), BLOCKS))))
    root = _local_roots(len(codes), index.links(differ, must))
    tied = np.flatnonzero(root != np.arange(len(codes)))
    back = _moved(index.codes, np.argsort(order).tolist())
    return back[tied], back[root[tied]]


def fingerprint_links(fingerprints: DataFrame, differ: int = DIFFER) -> DataFrame:
    """Edges (a, b) among the distinct longs of column ``fp``, at most ``differ`` bits apart.

    Not all pairs: where fingerprints meet, each is tied to the least of its connected group,
    so a group of n gives fewer than n edges a key, and no link between groups is lost.
    """
    if not 0 < differ < BLOCKS:
        raise ValueError(f"differ must be 1 to {BLOCKS - 1}")
    choices = _kept_blocks(differ)
    masks = [int(np.uint64(_bits(keep)).astype(np.int64)) for keep in choices]
    keys = [F.struct(F.lit(i).alias("kind"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for i, m in enumerate(masks)]
    spread = fingerprints.select("fp", F.explode(F.array(*keys)).alias("k")).select("k.kind", "k.key", "fp")
    met = spread.repartition("kind", "key").sortWithinPartitions("kind", "key")

    def solve(kind: np.ndarray, codes: np.ndarray) -> pa.RecordBatch:
        found = [key_links(codes[kind == k], choices[k], differ) for k in np.unique(kind)]
        a, b = (np.concatenate(x).astype(np.uint64).view(np.int64) for x in zip(*found))
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for batch in batches:
            columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            held.append((columns[0], columns[1], columns[2].view(np.uint64)))
            if sum(len(h[0]) for h in held) < CHUNK:
                continue
            kind, key, codes = (np.concatenate(x) for x in zip(*held))
            # Groups are whole up to the last key, which may go on in the next batch.
            last = np.flatnonzero((kind != kind[-1]) | (key != key[-1]))
            cut = int(last[-1]) + 1 if len(last) else 0
            if cut:
                yield solve(kind[:cut], codes[:cut])
            held = [(kind[cut:], key[cut:], codes[cut:])]
        if held:
            kind, _, codes = (np.concatenate(x) for x in zip(*held))
            yield solve(kind, codes)

    return met.mapInArrow(run, "a long, b long").distinct()


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", differ: int = DIFFER) -> DataFrame:
    """One row per document: id, fp (the fingerprint as a long), component (the least id it is linked to).

    Fingerprints at most ``differ`` bits apart are linked, texts without words (null ones too)
    like any other. Repeated rows get a row each. A null id gets its component, but is no
    component's name unless all its ids are null. An empty table gives no rows; other columns
    are not read.
    """
    source = identified(docs, id_col, text_col)
    id_type = source.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, texts in text_slices(batch):
                codes = np.array([fingerprint(t) for t in texts], np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, batch.schema.field(0).type), pa.array(codes)], names=["id", "fp"]
                )

    rows = written(source.mapInArrow(run, f"id {id_type}, fp long"), "fingerprints")
    least = written(rows.groupBy("fp").agg(F.min("id").alias("least")), "distinct")
    linked = components(fingerprint_links(least.select("fp"), differ))
    # Only linked fingerprints need their component's least id looked up; the others have their own.
    roots = linked.select("root").distinct().select(F.col("root").alias("node"), "root")
    members = written(linked.unionByName(roots), "members").withColumnRenamed("node", "fp")
    ids = written(members.join(least, "fp").groupBy("root").agg(F.min("least").alias("component")), "roots")
    named = written(members.join(ids, "root").select("fp", "component"), "named")
    # Stored sides, so that adaptive execution can split a fingerprint with very many documents.
    table = written(
        least.join(named, "fp", "left").select("fp", F.coalesce("component", "least").alias("component")), "table"
    )
    return rows.join(table, "fp").select("id", "fp", "component")


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents without near copies, in all their columns: of each group the one with the least id stays.

    Rows without an id stay, as no group can be named after them.
    """
    groups = near_groups(docs, id_col, text_col)
    gone = groups.filter(F.col("id") != F.col("component")).select(F.col("id").alias("gone_id")).distinct()
    return docs.join(gone, column(id_col) == gone["gone_id"], "left_anti")
