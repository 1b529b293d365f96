"""Order-preserving packing of documents into windows (operator 3).

Documents follow each other in the order of their ids, as one line of tokens. Windows are
consecutive stretches of it; a dynamic programme chooses their ends among document ends,
sentence ends and, inside overlong sentences, every few tokens, so that padding plus
penalties for cutting a document is least. The best start for an end is the least
``cost[i] + position[i]`` of the last ``capacity`` tokens, which a monotone queue keeps.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Recent, cut_words, give_back, identified, plain_words, text_slices

#: Bytes of a generation of a task's memory of words.
REMEMBERED = 48 << 20
#: Characters encoded together.
SLICE = 4_000_000


@dataclass(frozen=True)
class Plan:
    """Costs are in tokens of padding."""

    capacity: int = 1024
    #: Cutting a document at the end of a sentence.
    sentence_cut: float = 12.0
    #: Cutting a sentence.
    inner_cut: float = 48.0
    #: Each window, so that short windows which need no padding aren't free.
    window: float = 8.0
    #: Sentences longer than this may be cut every ``inner_step`` tokens.
    long_sentence: int = 192
    inner_step: int = 32
    #: Windows of a power of two of tokens aren't padded, from this one on.
    least_power: int = 128
    #: Tokens planned together: more cost memory; where a block's plan ends, windows may end elsewhere than in a longer one.
    block: int = 1_000_000


def best_ends(positions: np.ndarray, penalties: np.ndarray, plan: Plan) -> list[int]:
    """Indices into ``positions`` of the window ends of least total cost.

    ``positions`` rise from 0 in steps of at most ``capacity``; the last is the end of the line.
    """
    powers = [1 << k for k in range(plan.capacity.bit_length()) if plan.least_power <= 1 << k < plan.capacity]
    exact: dict[int, list[int]] = {}  # end -> starts a power of two before it
    for power in powers:
        at = np.searchsorted(positions, positions - power)
        hit = np.flatnonzero(positions[np.minimum(at, len(positions) - 1)] == positions - power)
        for j, i in zip(hit.tolist(), at[hit].tolist()):
            exact.setdefault(j, []).append(i)
    # Starts that are near enough for each end, and the parts of its cost that don't depend on the start.
    lowest = np.searchsorted(positions, positions - plan.capacity).tolist()
    place, extra = positions.tolist(), (penalties + plan.window).tolist()
    last = len(place) - 1
    cost, start = [0.0] * (last + 1), [0] * (last + 1)
    values, indices, head = [0.0], [0], 0  # the monotone queue: costs + positions and indices, both rising
    capacity = plan.capacity
    for j in range(1, last + 1):
        p, low = place[j], lowest[j]
        while indices[head] < low:
            head += 1
        i = indices[head]
        best = values[head] + capacity - p
        if j in exact:
            for k in exact[j]:
                if cost[k] < best:
                    best, i = cost[k], k
        best += extra[j]
        cost[j], start[j] = best, i
        value = best + p
        while len(values) > head and values[-1] > value:
            values.pop()
            indices.pop()
        values.append(value)
        indices.append(j)
    ends, j = [], len(place) - 1
    while j:
        ends.append(j)
        j = start[j]
    return ends[::-1]


def byte_letters() -> dict[int, str]:
    """The letter a byte-level vocabulary writes for each byte: printable ones are themselves, others follow U+0100."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


class TokenLine:
    """Token ids of a text and where its sentences end.

    Matches of the split pattern are encoded once, many in one call, already split and written
    in the vocabulary's letters, so that the library only has to merge.
    """

    def __init__(self, path: str, pattern: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import CharDelimiterSplit

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.tokenizer.pre_tokenizer = CharDelimiterSplit("\0")
        self.pattern = regex.compile(pattern)
        letters = byte_letters()
        self.shown = np.array([ord(letters[b]) for b in range(255)] + [0], "<u2")
        self.words = Recent(REMEMBERED)  # ids of a blank and the word, 4 bytes each
        self.pieces = Recent(REMEMBERED // 4)  # ids of a match of the pattern
        vocabulary = self.tokenizer.get_vocab()
        shown = [""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            shown[i] = token
        self.size = np.array([len(t) for t in shown], np.int64)
        blank, line = letters[32], letters[10]
        self.breaks = np.array([t[-1:] == line for t in shown])
        self.closes = np.array([t[-1:] in (".", "!", "?") for t in shown])
        self.opens = np.array([t[:1] in (blank, line) for t in shown])

    def _merged(self, pieces: list[str]) -> list[bytes]:
        """Ids of matches of the pattern, none of them empty."""
        if not pieces:
            return []
        # No byte of a text is 255, so it can part the matches. Tokens end with their match, so lengths tell whose they are.
        raw = np.frombuffer(b"\xff".join([p.encode() for p in pieces] + [b""]), np.uint8)
        line = self.shown[raw[:-1]].tobytes().decode("utf-16-le")
        ids = np.array(self.tokenizer.encode_batch_fast([line], add_special_tokens=False)[0].ids, "<u4")
        past = np.flatnonzero(raw == 255)
        ends = 4 * (np.searchsorted(np.cumsum(self.size[ids]), past - np.arange(len(pieces))) + 1)
        found, ends = ids.tobytes(), ends.tolist()
        return [found[a:b] for a, b in zip([0, *ends[:-1]], ends)]

    def _known(self, found: list[list[str]]) -> list[bytes]:
        """Ids of lists of matches."""
        pieces = list(set().union(*found))
        ids = dict(zip(pieces, self.pieces.results(pieces, self._merged)))
        return [b"".join(map(ids.__getitem__, f)) for f in found]

    def _learn(self, new: list[str]) -> list[bytes]:
        """Ids of words, each with the blank before it."""
        letters, marked, others = plain_words(new)
        own = self.words
        bases = list({w[:-1] for w in marked}.difference(letters, own.now))
        plain = letters + bases
        known = dict(zip(plain, self._merged([" " + w for w in plain])))
        own.put(bases, [known[w] for w in bases])
        marks = {w[-1] for w in marked}
        ends = dict(zip(marks, self._known([[m] for m in marks])))
        known.update([(w, (known.get(w[:-1]) or own.now[w[:-1]]) + ends[w[-1]]) for w in marked])
        known.update(zip(others, self._known([self.pattern.findall(" " + w) for w in others])))
        return [known[w] for w in new]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of the texts as the tokenizer gives them, each text followed by id 0."""
        if not texts:
            return []
        heads, words, rest, bounds = cut_words(texts)
        # What a text is put together from: its head, its words and the closing id.
        parts = [bytes(4), *self._known([self.pattern.findall(h) for h in heads]), *self.words.results(words, self._learn)]
        flat = np.frombuffer(b"".join(parts), "<u4")
        size = np.array([len(p) >> 2 for p in parts], np.int64)
        begin = np.cumsum(size) - size
        texts_at, n = bounds[:-1], len(texts)
        order = np.zeros(len(rest) + 2 * n, np.int64)  # part numbers in the order of the line, 0 the closing id
        heads_at = texts_at + 2 * np.arange(n)
        order[heads_at] = 1 + np.arange(n)
        words_at = np.arange(len(rest)) + 1 + 2 * np.repeat(np.arange(n), np.diff(bounds))
        order[words_at] = rest + 1 + n
        taken = size[order]
        ends = np.cumsum(taken)
        line = flat[np.arange(ends[-1]) + np.repeat(begin[order] - (ends - taken), taken)]
        return np.split(line, ends[np.append(heads_at[1:], len(order)) - 1][:-1])

    def forget(self) -> None:
        """Free the memory of words."""
        self.words.clear()
        self.pieces.clear()

    def cuts(self, found: list[np.ndarray], plan: Plan) -> list[tuple[np.ndarray, np.ndarray]]:
        """Of each document: positions inside it where it may be cut, and what each costs."""
        line = np.concatenate(found)
        bounds = np.cumsum([0] + [len(ids) for ids in found])
        before = line[:-1]
        end = np.zeros(len(line) + 1, bool)
        end[1:-1] = self.breaks[before] | (self.closes[before] & self.opens[line[1:]])
        # A document's closing id is no sentence of its own, and its end no cut inside it.
        end[bounds], end[bounds[1:] - 1] = False, False
        ends = np.flatnonzero(end)
        end[bounds] = True
        fixed = np.flatnonzero(end)
        gaps = np.diff(fixed)
        long = np.flatnonzero(gaps > plan.long_sentence)
        inner = [np.arange(a + plan.inner_step, a + g, plan.inner_step) for a, g in zip(fixed[long], gaps[long])]
        extra = np.concatenate(inner) if inner else np.empty(0, np.int64)
        places = np.concatenate([ends, extra])
        costs = np.concatenate([np.full(len(ends), plan.sentence_cut), np.full(len(extra), plan.inner_cut)])
        order = np.argsort(places, kind="stable")
        places, costs = places[order], costs[order]
        at = np.searchsorted(places, bounds)
        return [(places[a:b] - base, costs[a:b]) for a, b, base in zip(at[:-1], at[1:], bounds[:-1])]


@dataclass
class _Part:
    """What is left to pack of a document."""

    id: object
    ids: np.ndarray
    start: int  # ids of the document before these
    total: int
    places: np.ndarray  # cuts, from the start of ``ids``
    costs: np.ndarray


class Packer:
    """Packs a stream of documents; the windows of a block are planned together."""

    def __init__(self, plan: Plan, first_sequence: int) -> None:
        self.plan, self.sequence = plan, first_sequence
        self.parts: list[_Part] = []
        self.held = 0

    def add(self, part: _Part) -> Iterator[tuple]:
        self.parts.append(part)
        self.held += len(part.ids)
        if self.held >= self.plan.block:
            yield from self.flush(False)

    def flush(self, last: bool) -> Iterator[tuple]:
        """Rows of the finished windows. The last window stays open unless the line ends here."""
        if not self.parts:
            return
        bounds = np.cumsum([0] + [len(p.ids) for p in self.parts])
        places = [np.array([0])]
        costs = [np.zeros(1)]
        for part, base in zip(self.parts, bounds[:-1].tolist()):
            places += [part.places + base, [base + len(part.ids)]]
            costs += [part.costs, [0.0]]
        positions, penalties = np.concatenate(places), np.concatenate(costs)
        ends = positions[best_ends(positions, penalties, self.plan)].tolist()
        if not last:
            ends = ends[:-1]
        begin, at = 0, 0
        for end in ends:
            offset = 0
            while begin < end:
                part, base = self.parts[at], int(bounds[at])
                stop = min(end, int(bounds[at + 1]))
                ids = part.ids[begin - base : stop - base]
                yield (part.id, part.start + begin - base, len(ids), zlib.crc32(ids), part.total, self.sequence, offset)
                offset += len(ids)
                begin = stop
                if stop == bounds[at + 1]:
                    at += 1
            self.sequence += 1
        rest = self.parts[at:]
        if rest and begin > bounds[at]:
            part, done = rest[0], begin - int(bounds[at])
            left = part.places > done
            rest[0] = _Part(
                part.id, part.ids[done:], part.start + done, part.total, part.places[left] - done, part.costs[left]
            )
        self.parts, self.held = rest, sum(len(p.ids) for p in rest)


_LINES: dict[tuple[str, str], TokenLine] = {}


def token_line(path: str, pattern: str) -> TokenLine:
    """One per Python worker; what it remembers of words ends with the task."""
    if (path, pattern) not in _LINES:
        _LINES[path, pattern] = TokenLine(path, pattern)
    return _LINES[path, pattern]


COLUMNS = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def pack(
    docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", plan: Plan = Plan()
) -> DataFrame:
    """One row per piece: the document's id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    ``path`` is a byte-level BPE tokenizer file and ``pattern`` its split pattern. Every document is its ids (null text: none) and a closing id 0, so even an empty text has
    a piece. Documents follow in the order of their ids, null ids first, repeated ids by the
    hash of their text. Partitions are ranges of ids and are packed each on its own, so only
    the last window of each is short for that reason. Sequence ids are unique, rising with the
    order of the documents, with gaps between partitions. An empty table gives no rows; other
    columns are not read.
    """
    source = identified(docs, id_col, text_col)
    id_type = source.schema["id"].dataType.simpleString()
    order = ["id", F.xxhash64("text")]
    line = source.repartitionByRange(*order).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = token_line(path, pattern)
        packer = Packer(plan, TaskContext.get().partitionId() << 32)
        kind = None

        def table(rows: list[tuple]) -> pa.RecordBatch:
            names = ["id", *[c.split()[0] for c in COLUMNS.split(", ")]]
            values = list(zip(*rows))
            kinds = [kind] + [pa.int64()] * (len(names) - 1)
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds)], names=names)

        for batch in batches:
            kind = batch.schema.field(0).type
            for ids, texts in text_slices(batch, SLICE):
                rows = []
                encoded = tokens.encode(texts)
                for i, found, cuts in zip(ids, encoded, tokens.cuts(encoded, plan)):
                    rows += packer.add(_Part(i, found, 0, len(found), *cuts))
                if rows:
                    yield table(rows)
                del encoded
                give_back()
        if rows := list(packer.flush(True)):
            yield table(rows)
        tokens.forget()
        give_back()

    return line.mapInArrow(run, f"id {id_type}, {COLUMNS}").withColumnRenamed("id", id_col)
