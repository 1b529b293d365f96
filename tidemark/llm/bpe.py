"""Byte-level BPE encoding and decoding (operator 5).

Each match of the split pattern is merged on its own. A segment tree over its byte
positions holds the rank of the pair that starts at each live position; the root names the
leftmost pair of lowest rank. A merge changes two leaves and clears one, each by a walk to
the root, so a piece of n bytes takes O(n log n), however long it is.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tidemark.llm.common import Recent, cut_words, identified, text_slices

NONE = 1 << 62
#: Children of a node of the tree.
FAN = 32
#: Bytes of a generation of a task's memory of words, and of matches of the split pattern.
REMEMBERED = 32 << 20
#: Characters encoded together.
SLICE = 1_000_000


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: lines of a base64 token and its rank."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


def merge_piece(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one piece: merge the leftmost pair of lowest rank until no pair has a rank.

    A leaf of the tree is ``rank << shift | position``, so the least leaf is the leftmost of
    the lowest rank, and its low bits are its position. Nodes cover FAN nodes of the level
    below; the top level has at most FAN, so short pieces are a single level.
    """
    if piece in ranks:
        return [ranks[piece]]
    n = len(piece)
    shift = n.bit_length()
    low = (1 << shift) - 1
    end = list(range(1, n + 1))  # where the part that starts here ends
    back = list(range(-1, n))  # start of the part that ends here
    get = ranks.get
    found = [get(piece[i : i + 2]) for i in range(n - 1)]
    leaves = [NONE if rank is None else rank << shift | i for i, rank in enumerate(found)]
    leaves.append(NONE)
    levels = [leaves]
    while len(levels[-1]) > FAN:
        below = levels[-1]
        levels.append([min(below[i : i + FAN]) for i in range(0, len(below), FAN)])
    top, upper = levels[-1], levels[1:]

    def climb(i: int) -> None:
        below = leaves
        for level in upper:
            i //= FAN
            least = min(below[i * FAN : i * FAN + FAN])
            if level[i] == least:
                return
            level[i] = least
            below = level

    while (least := min(top)) < NONE:
        i = least & low
        j = end[i]
        stop = end[i] = end[j]
        leaves[j] = leaves[i] = NONE
        if stop < n:
            back[stop] = i
            rank = get(piece[i : end[stop]])
            if rank is not None:
                leaves[i] = rank << shift | i
        if i:
            before = back[i]
            rank = get(piece[before:stop])
            leaves[before] = NONE if rank is None else rank << shift | before
        if upper:
            climb(j)
            climb(i)
            if i:
                climb(before)
    ids, i = [], 0
    while i < n:
        ids.append(ranks[piece[i : end[i]]])
        i = end[i]
    return ids


class Pairs:
    """The rank of every pair of tokens that makes a token, for whole arrays of pairs."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.byte_id = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        splits = [
            (ranks[token[:i]] << 32 | ranks[token[i:]], rank)
            for token, rank in ranks.items()
            for i in range(1, len(token))
            if token[:i] in ranks and token[i:] in ranks
        ]
        table = np.array(sorted(splits), np.int64).reshape(-1, 2)
        self.keys, self.found = table[:, 0].copy(), table[:, 1].copy()

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks, NONE where the pair makes no token or a side is missing (negative)."""
        key = left << 32 | right
        if not len(self.keys):
            return np.full(key.shape, NONE)
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[at] == key) & (left >= 0) & (right >= 0), self.found[at], NONE)


def merge_short(pieces: list[bytes], pairs: Pairs) -> list[list[int]]:
    """``merge_piece`` of pieces of at most FAN bytes, all at once.

    The tree of such a piece is one node, a row of leaves here. Every round merges the
    leftmost lowest pair of each row that has one left.
    """
    if not pieces:
        return []
    lengths = np.array([len(p) for p in pieces])
    m, width = len(pieces), int(lengths.max())
    text = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), np.uint8).reshape(m, width)
    columns = np.arange(width)
    token = np.full((m, width + 1), -1, np.int64)
    token[:, :width] = np.where(columns < lengths[:, None], pairs.byte_id[text], -1)
    after = np.broadcast_to(np.minimum(columns + 1, width), (m, width)).copy()
    before = np.broadcast_to(np.arange(-1, width), (m, width + 1)).copy()
    rank = pairs(token[:, :-1], token[:, 1:])
    rows = np.arange(m)
    while len(rows):
        i = rank[rows].argmin(1)
        least = rank[rows, i]
        more = least < NONE
        rows, i, least = rows[more], i[more], least[more]
        j = after[rows, i]
        k = after[rows, j]
        token[rows, i] = least
        token[rows, j] = -1
        after[rows, i] = k
        before[rows, k] = i
        rank[rows, j] = NONE
        rank[rows, i] = pairs(least, token[rows, k])
        p = before[rows, i]
        some = p >= 0
        rank[rows[some], p[some]] = pairs(token[rows[some], p[some]], least[some])
    live = token >= 0
    flat, ends = token[live].tolist(), np.cumsum(live.sum(1)).tolist()
    return [flat[a:b] for a, b in zip([0, *ends[:-1]], ends)]


class Codec:
    """Encoder and decoder for one rank file and split pattern."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        self.ranks = ranks
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.pattern = regex.compile(pattern)
        self.pairs = Pairs(ranks)
        # The ids as text and what they decode to, of matches of the pattern and of words with the blank before them.
        self.pieces, self.words = Recent(REMEMBERED), Recent(REMEMBERED)

    def merge(self, pieces: list[str]) -> list[list[int]]:
        raw = [p.encode() for p in pieces]
        short = [i for i, p in enumerate(raw) if len(p) <= FAN and p not in self.ranks]
        out = dict(zip(short, merge_short([raw[i] for i in short], self.pairs)))
        return [out[i] if i in out else merge_piece(p, self.ranks) for i, p in enumerate(raw)]

    def encode(self, text: str) -> list[int]:
        return [i for piece in self.pattern.findall(text) for i in merge_piece(piece.encode(), self.ranks)]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join([self.bytes_of[i] for i in ids])

    def _known(self, found: list[list[str]]) -> list[tuple[bytes, bytes]]:
        """Of lists of matches: the ids as text, a blank after each, and what they decode to."""
        pieces = list(set().union(*found))
        known = dict(zip(pieces, self.pieces.results(pieces, self._shown)))
        out = []
        for f in found:
            parts = [known[p] for p in f]
            out.append((b"".join([ids for ids, _ in parts]), b"".join([back for _, back in parts])))
        return out

    def _shown(self, pieces: list[str]) -> list[tuple[bytes, bytes]]:
        return [(b"".join([b"%d " % i for i in ids]), self.decode(ids)) for ids in self.merge(pieces)]

    def _learn(self, new: list[str]) -> list[tuple[bytes, bytes]]:
        """Encode and decode words, each with the blank before it."""
        return self._known([self.pattern.findall(" " + w) for w in new])

    def digests(self, texts: list[str]) -> tuple[list[int], list[str], list[str]]:
        """Of each text: number of ids, SHA-256 of the ids as text, SHA-256 of the decoded bytes."""
        heads, words, rest, bounds = cut_words(texts)
        known = self.words.results(words, self._learn)
        ids, backs = [k[0] for k in known], [k[1] for k in known]
        counts, hashes, decoded = [], [], []
        first = self._known([self.pattern.findall(h) for h in heads])
        rest, bounds = rest.tolist(), bounds.tolist()
        for (head, back), a, b in zip(first, bounds[:-1], bounds[1:]):
            own = rest[a:b]
            line = b"".join([head, *map(ids.__getitem__, own)])
            counts.append(line.count(b" "))
            hashes.append(hashlib.sha256(line[:-1]).hexdigest())
            decoded.append(hashlib.sha256(b"".join([back, *map(backs.__getitem__, own)])).hexdigest())
        return counts, hashes, decoded

    def forget(self) -> None:
        """Free the memory of words."""
        self.words.clear()
        self.pieces.clear()


_CODECS: dict[tuple[str, str], Codec] = {}


def codec(path: str, pattern: str) -> Codec:
    """One codec per Python worker; what it remembers of words ends with the task."""
    if (path, pattern) not in _CODECS:
        _CODECS[path, pattern] = Codec(read_ranks(path), pattern)
    return _CODECS[path, pattern]


def token_digests(
    docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: its id, n_tokens, ids_sha256 and decoded_sha256.

    No shuffle. A null text is empty and has no ids; repeated rows and null ids give a row
    each; an empty table gives none. Columns other than id and text are not read.
    """
    source = identified(docs, id_col, text_col)
    id_type = source.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for batch in batches:
            for ids, texts in text_slices(batch, SLICE):
                counts, hashes, decoded = own.digests(texts)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids, batch.schema.field(0).type),
                        pa.array(counts, pa.int64()),
                        pa.array(hashes, pa.string()),
                        pa.array(decoded, pa.string()),
                    ],
                    names=["id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )
        own.forget()

    out = source.mapInArrow(run, f"id {id_type}, n_tokens long, ids_sha256 string, decoded_sha256 string")
    return out.withColumnRenamed("id", id_col)
