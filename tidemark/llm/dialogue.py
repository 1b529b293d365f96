"""Conversation structure repair by a generalised LR parser (operator 12).

The roles of a conversation should follow the grammar

    Conversation -> nothing | Turns | s Turns          Turns -> u a | Turns u a

of the initials of system, user and assistant. The parser reads the rows in order and keeps
all ways to read them at once in a graph-structured stack. A row is kept, given another
role or deleted, and a turn may be inserted before or after it; equal stack tops are merged
by their least (cost, audit), where the audit is the edits' initials.

Rows are sorted across tasks by conversation and turn and parsed in blocks. A block that may
have begun or go on elsewhere is parsed from every stack it can start with; joining those
ways block by block gives the least one of the whole conversation, so that one conversation
may be longer than any task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import column, written

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
ROLES = {"u": "user", "a": "assistant"}
#: Rows and characters of a block; they bound memory, not results.
BLOCK, CHARS = 512, 1_000_000
#: Leading characters of a text by which rows are dealt to tasks; ties beyond are sorted in the task.
PREFIX = 64

#: The LR automaton of the grammar: state after a symbol, symbols a finished rule takes off, state after Turns.
SHIFT = {0: {"s": 2, "u": 3}, 1: {"u": 5}, 2: {"u": 3}, 3: {"a": 4}, 4: {}, 5: {"a": 6}, 6: {}, 7: {"u": 5}}
REDUCE = {4: 2, 6: 3}
GOTO = {0: 1, 2: 7}
FINAL = frozenset([0, 1, 7])

#: A stack is its top state and the stack below; stacks share what lies below.
Stack = tuple
START: Stack = (0, None)
#: Top state -> stack below -> least (cost, audit) of all ways there.
Tops = dict[int, dict]
_SPACE = " \t\n\x0b\x0c\r"
_LEGAL = frozenset(["su", "ua", "au"])


def _pushed(state: int, below: Stack | None, symbol: str) -> Stack | None:
    """The stack after one more symbol, with finished rules reduced."""
    to = SHIFT[state].get(symbol)
    if to is None:
        return None
    stack = (to, (state, below))
    while stack[0] in REDUCE:
        for _ in range(REDUCE[stack[0]]):
            stack = stack[1]
        stack = (GOTO[stack[0]], stack)
    return stack


def _reachable() -> list[Stack]:
    """All stacks between two symbols; they are few, as Turns is reduced whenever it grows."""
    found = [START]
    for stack in found:
        for symbol in "sua":
            after = _pushed(*stack, symbol)
            if after is not None and after not in found:
                found.append(after)
    return found


STACKS = _reachable()
_NUMBER = {stack: i for i, stack in enumerate(STACKS)}
#: (top, below, symbol) -> the stack after the symbol, of all that can be met.
_AFTER = {(*stack, symbol): _pushed(*stack, symbol) for stack in STACKS for symbol in "sua"}


def _merge(tops: Tops, stack: Stack, way: tuple[int, str]) -> bool:
    links = tops.setdefault(stack[0], {})
    held = links.get(stack[1])
    if held is None or way < held:
        links[stack[1]] = way
        return True
    return False


def _push(tops: Tops, into: Tops, symbol: str, cost: int, letter: str) -> bool:
    changed = False
    for state, links in list(tops.items()):
        if symbol in SHIFT[state]:
            for below, (spent, audit) in list(links.items()):
                changed |= _merge(into, _AFTER[state, below, symbol], (spent + cost, audit + letter))
    return changed


def _insert(tops: Tops) -> Tops:
    """Also the stacks after inserted turns."""
    while _push(tops, tops, "u", INSERT, "I") | _push(tops, tops, "a", INSERT, "I"):
        pass
    return tops


def _step(tops: Tops, initial: str, deletions: int, alive: bool, truncated: bool) -> Tops:
    """The stacks after a row that may stay (``alive``) and that many rows that must go."""
    if alive:
        fault = TRUNCATED if truncated else 0
        after: Tops = {}
        for state, links in tops.items():
            after[state] = {below: (cost + DELETE, audit + "D") for below, (cost, audit) in links.items()}
        if initial in ("s", "u", "a"):
            _push(tops, after, initial, KEEP + fault, "K")
        for role in ROLES:
            if role != initial:
                _push(tops, after, role, REROLE + fault, "R")
        tops = after
    if deletions:
        gone = "D" * deletions
        tops = {
            state: {below: (cost + DELETE * deletions, audit + gone) for below, (cost, audit) in links.items()}
            for state, links in tops.items()
        }
    return _insert(tops)


class Block:
    """Consecutive rows of one conversation: what is counted in them, and what may become of them."""

    def __init__(self) -> None:
        self.rows = self.blank = self.duplicate = self.truncated = self.illegal = self.turns = self.chars = 0
        self.first = self.last = None
        self.low = self.high = None
        self.steps: list[tuple[str, int, bool, bool]] = []
        self.items: list[tuple[str, str, int]] = []

    def add(self, turn, role: str, text: str, times: int, fresh: bool) -> None:
        """``times`` equal rows; ``fresh`` if none of them was met before in the conversation."""
        initial, body = role[:1] or " ", text.rstrip(_SPACE)
        alive = bool(body) and fresh
        truncated = alive and body[-1] not in ".!?"
        if not body:
            self.blank += times
        else:
            self.duplicate += times - alive
            self.truncated += truncated
        self.illegal += times - 1 + (self.last is not None and self.last + initial not in _LEGAL)
        if turn is not None:
            self.turns += turn != self.high
            self.low = turn if self.low is None else self.low
            self.high = turn
        self.first = self.first or initial
        self.last = initial
        self.rows += times
        self.chars += len(text)
        self.steps.append((initial, times - alive, alive, truncated))
        self.items.append((role, text, times))

    def ways(self, start: Stack) -> dict[Stack, tuple[int, str]]:
        """The least (cost, audit) to each stack after the block."""
        tops = _insert({start[0]: {start[1]: (0, "")}})
        for step in self.steps:
            tops = _step(tops, *step)
        return {(state, below): way for state, links in tops.items() for below, way in links.items()}


def least_final(ways: dict[Stack, tuple[int, str]]) -> tuple[Stack, tuple[int, str]]:
    return min(((s, w) for s, w in ways.items() if s[0] in FINAL), key=lambda x: x[1])


def repaired_rows(items: list[tuple[str, str, int]], audit: str, start: Stack) -> list[dict]:
    """Role and text of each turn that the audit leaves of the rows or inserts, from this stack on."""
    out, stack = [], start

    def put(symbol: str, role: str, text: str) -> None:
        nonlocal stack
        stack = _AFTER[*stack, symbol]
        out.append({"role": role, "text": text})

    def due() -> str:
        return next(s for s in SHIFT[stack[0]] if s != "s")

    edits = iter(audit)
    for role, text, times in items:
        while times:
            edit = next(edits)
            if edit == "I":
                put(due(), ROLES[due()], "")
                continue
            if edit == "K":
                put(role[:1], role, text)
            elif edit == "R":
                put(due(), ROLES[due()], text)
            times -= 1
    for _ in edits:
        put(due(), ROLES[due()], "")
    return out


_COUNTS = ["blank", "duplicate", "truncated", "illegal"]
_FACTS = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def _facts(block, cost: int, audit: str) -> dict:
    gaps = 0 if block.low is None else block.high - block.low + 1 - block.turns
    return {"gaps": gaps, **{c: getattr(block, c) for c in _COUNTS}, "cost": cost, "audit": audit}


def _batches(rows: Iterator[dict], schema: pa.Schema, chars: int = 4 * CHARS) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row, weight in rows:
        held.append(row)
        size += weight + 200
        if size > chars:
            yield pa.RecordBatch.from_pylist(held, schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


_ITEM = pa.struct([("role", pa.string()), ("text", pa.string())])
_RAW = pa.struct([("role", pa.string()), ("text", pa.string()), ("times", pa.int64())])
_WAY = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())])
_FACT = pa.struct([(n, pa.string() if n == "audit" else pa.int64()) for n in ["gaps", *_COUNTS, "cost", "audit"]])
_PLACE = [("part", pa.int32()), ("seq", pa.int32())]


def _ordered(source: DataFrame) -> DataFrame:
    """Distinct rows with how often they occur and whether they are the first of their role and text, in order."""
    same = source.groupBy("conv", "turn", "role", "text").agg(F.count(F.lit(1)).alias("times"))
    same = written(same.withColumn("digest", F.unhex(F.sha2(F.col("text").cast("binary"), 256))), "turns")
    # Minima are taken before the shuffle, and the join's keys are unique on both sides: no key is hot.
    first = same.groupBy("conv", "role", "digest").agg(
        F.max(F.col("turn").isNull()).alias("unplaced"), F.min("turn").alias("turn")
    )
    first = first.select(
        *[F.col(c).alias(f"_{c}") for c in ("conv", "role", "digest")],
        F.when(~F.col("unplaced"), F.col("turn")).alias("_turn"),
        F.lit(True).alias("fresh"),
    )
    on = (
        same["conv"].eqNullSafe(first["_conv"])
        & (same["role"] == first["_role"])
        & (same["digest"] == first["_digest"])
        & same["turn"].eqNullSafe(first["_turn"])
    )
    marked = same.join(first, on, "left").select(
        "conv", "turn", "role", "text", "times", F.coalesce("fresh", F.lit(False)).alias("fresh")
    )
    dealt = marked.repartitionByRange("conv", "turn", "role", F.substring("text", 1, PREFIX))
    return dealt.sortWithinPartitions("conv", "turn", "role", "text")


def _parsed(ordered: DataFrame, block: int) -> DataFrame:
    """A row per block: finished (``whole``) where the conversation lies inside the block, else with all its ways."""
    conv_type, turn_type = (ordered.schema[c].dataType.simpleString() for c in ("conv", "turn"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()

        def done(conv, seq: int, b: Block, whole: bool) -> tuple[dict, int]:
            row = {"conv": conv, "part": part, "seq": seq, "whole": whole}
            if whole:
                _, (cost, audit) = least_final(b.ways(START))
                row |= {"facts": _facts(b, cost, audit), "repaired": repaired_rows(b.items, audit, START)}
            else:
                row |= {c: getattr(b, c) for c in ("first", "last", "low", "high", "turns", *_COUNTS)}
                row["raw"] = [{"role": r, "text": t, "times": n} for r, t, n in b.items]
                row["ways"] = [
                    {"start": i, "end": _NUMBER[end], "cost": cost, "audit": audit}
                    for i, start in enumerate(STACKS)
                    for end, (cost, audit) in b.ways(start).items()
                ]
            return row, b.chars

        def blocks(batches) -> Iterator[tuple[dict, int]]:
            conv = held = None
            seq, begins = 0, False  # begins: the conversation is known to begin with this block
            for batch in batches:
                for c, turn, role, text, times, fresh in zip(*(x.to_pylist() for x in batch.columns)):
                    if held is not None and c != conv:
                        yield done(conv, seq, held, begins)
                        held, seq, begins = None, seq + 1, True
                    elif held is not None and (len(held.steps) >= block or held.chars > CHARS):
                        yield done(conv, seq, held, False)
                        held, seq, begins = None, seq + 1, False
                    if held is None:
                        held = Block()
                    conv = c
                    held.add(turn, role, text, times, fresh)
            if held is not None:
                yield done(conv, seq, held, False)

        first = next(batches, None)
        if first is None:
            return
        kind, turn = first.schema.field(0).type, first.schema.field(1).type
        schema = pa.schema(
            [("conv", kind), *_PLACE, ("whole", pa.bool_()), ("facts", _FACT), ("repaired", pa.list_(_ITEM))]
            + [("raw", pa.list_(_RAW)), ("ways", pa.list_(_WAY)), ("first", pa.string()), ("last", pa.string())]
            + [("low", turn), ("high", turn)]
            + [(c, pa.int64()) for c in ("turns", *_COUNTS)]
        )
        yield from _batches(blocks(chain([first], batches)), schema)

    shape = (
        f"conv {conv_type}, part int, seq int, whole boolean, facts struct<{_FACTS}>, "
        "repaired array<struct<role string, text string>>, raw array<struct<role string, text string, times long>>, "
        "ways array<struct<start int, `end` int, cost long, audit string>>, first string, last string, "
        f"low {turn_type}, high {turn_type}, turns long, " + ", ".join(f"{c} long" for c in _COUNTS)
    )
    return ordered.mapInArrow(run, shape)


class _Chain:
    """The blocks of a conversation met so far, with the least way to each stack."""

    def __init__(self) -> None:
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.low = self.high = self.last = None
        #: Stack number -> (cost, audits so far, starts so far), as linked lists with the newest first.
        self.ways = {0: (0, "", None)}
        self.places: list[tuple[int, int]] = []

    def add(self, row: dict) -> None:
        for c in _COUNTS:
            setattr(self, c, getattr(self, c) + row[c])
        self.illegal += self.last is not None and self.last + row["first"] not in _LEGAL
        self.last = row["last"]
        self.turns += row["turns"] - (row["low"] is not None and row["low"] == self.high)
        self.low = row["low"] if self.low is None else self.low
        self.high = row["high"] if row["high"] is not None else self.high
        ways: dict = {}
        for w in row["ways"]:
            if w["start"] in self.ways:
                spent, audit, trail = self.ways[w["start"]]
                way = (spent + w["cost"], audit + w["audit"])
                if w["end"] not in ways or way < ways[w["end"]][:2]:
                    ways[w["end"]] = (*way, (trail, w["start"], w["audit"]))
        self.ways = ways
        self.places.append((row["part"], row["seq"]))

    def finish(self, conv) -> Iterator[tuple[dict, int]]:
        cost, audit, trail = min((w for s, w in self.ways.items() if STACKS[s][0] in FINAL), key=lambda w: w[:2])
        facts = _facts(self, cost, audit)
        for part, seq in reversed(self.places):
            trail, start, own = trail
            row = {"conv": conv, "part": part, "seq": seq, "start": start, "audit": own, "facts": facts}
            yield row, len(own)
            facts = None


def _joined(opened: DataFrame) -> DataFrame:
    """For each block its start and audit in the least way of its conversation; the facts stand with the last one."""
    conv_type = opened.schema["conv"].dataType.simpleString()
    rows = opened.drop("raw", "repaired", "facts", "whole")
    names = rows.columns
    rows = rows.repartition("conv").sortWithinPartitions("conv", "part", "seq")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next(batches, None)
        if first is None:
            return
        schema = pa.schema(
            [("conv", first.schema.field(0).type), *_PLACE, ("start", pa.int32()), ("audit", pa.string()), ("facts", _FACT)]
        )

        def plans() -> Iterator[tuple[dict, int]]:
            conv = met = None
            for batch in chain([first], batches):
                for i in range(batch.num_rows):
                    row = {n: batch.column(k)[i].as_py() for k, n in enumerate(names)}
                    if met is not None and row["conv"] != conv:
                        yield from met.finish(conv)
                        met = None
                    met = met or _Chain()
                    conv = row["conv"]
                    met.add(row)
            if met is not None:
                yield from met.finish(conv)

        yield from _batches(plans(), schema)

    shape = f"conv {conv_type}, part int, seq int, start int, audit string, facts struct<{_FACTS}>"
    return rows.mapInArrow(run, shape)


def _rendered(opened: DataFrame, plan: DataFrame) -> DataFrame:
    """The repaired turns of blocks whose place in the least way is known."""
    conv_type = opened.schema["conv"].dataType.simpleString()
    chosen = plan.select("part", "seq", "start", "audit")  # each task numbers its blocks
    rows = opened.select("conv", "part", "seq", "raw").join(chosen, ["part", "seq"])
    rows = rows.select("conv", "part", "seq", "raw", "start", "audit")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            schema = pa.schema([("conv", batch.schema.field(0).type), *_PLACE, ("repaired", pa.list_(_ITEM))])

            def turns(batch=batch) -> Iterator[tuple[dict, int]]:
                for conv, part, seq, raw, start, audit in zip(*batch.columns):
                    items = [(r["role"], r["text"], r["times"]) for r in raw.as_py()]
                    out = repaired_rows(items, audit.as_py(), STACKS[start.as_py()])
                    row = {"conv": conv.as_py(), "part": part.as_py(), "seq": seq.as_py(), "repaired": out}
                    yield row, sum(len(t["text"]) for t in out)

            yield from _batches(turns(), schema)

    return rows.mapInArrow(run, f"conv {conv_type}, part int, seq int, repaired array<struct<role string, text string>>")


def repair(
    conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
    text_col: str = "text", block: int = BLOCK,
) -> tuple[DataFrame, DataFrame]:
    """What is wrong with each conversation with its cheapest repair, and the repaired conversations.

    Rows are taken by turn (nulls first), then role and text. A null role or text is one space.
    First table: conv, gaps, blank, duplicate, truncated, illegal, cost, audit. Second table:
    conv, part, seq, whole, repaired (array of role and text); a long conversation has several
    rows, in the order of part and seq, and those with ``whole`` have only one. A role whose
    first letter is none of s, u, a can't be kept, nor one without any. Equal rows of one turn
    count as copies of the first. A null conversation is one like any other. An empty table
    gives no rows; other columns are not read.
    """
    blank = F.lit(" ")
    source = conversations.select(
        column(conv_col).alias("conv"),
        column(turn_col).alias("turn"),
        F.coalesce(column(role_col), blank).alias("role"),
        F.coalesce(column(text_col), blank).alias("text"),
    )
    blocks = written(_parsed(_ordered(source), block), "blocks")
    opened = blocks.filter(~F.col("whole"))
    plan = written(_joined(opened), "plan")
    done = blocks.filter("whole")
    facts = done.select("conv", "facts.*").unionByName(plan.filter("facts IS NOT NULL").select("conv", "facts.*"))
    turns = done.select("conv", "part", "seq", "whole", "repaired").unionByName(
        _rendered(opened, plan).withColumn("whole", F.lit(False)).select("conv", "part", "seq", "whole", "repaired")
    )
    return facts, turns


def digests(turns: DataFrame) -> DataFrame:
    """conv and sha256 (hex) of the repaired turns as lines ``role:text``, of ``repair``'s second table.

    Conversations of several blocks are hashed row after row, as a hash can't be split.
    """
    conv_type = turns.schema["conv"].dataType.simpleString()
    line = F.transform("repaired", lambda t: F.concat(t["role"], F.lit(":"), t["text"]))
    short = turns.filter("whole").select("conv", F.sha2(F.concat_ws("\n", line).cast("binary"), 256).alias("sha256"))
    text = F.when(F.size("repaired") > 0, F.concat_ws("\n", line))
    long = turns.filter("NOT whole").select("conv", "part", "seq", text.cast("binary").alias("bytes"))
    long = long.repartition("conv").sortWithinPartitions("conv", "part", "seq")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind, conv, state, begun = None, None, None, False
        for batch in batches:
            kind = batch.schema.field(0).type
            ended: list[tuple] = []
            for c, piece in zip(batch.column(0).to_pylist(), batch.column(3)):
                if state is not None and c != conv:
                    ended.append((conv, state.hexdigest()))
                    state = None
                if state is None:
                    conv, state, begun = c, hashlib.sha256(), False
                if piece.is_valid:
                    state.update(b"\n" * begun)
                    state.update(piece.as_buffer())
                    begun = True
            yield _pairs(ended, kind)
        if state is not None:
            yield _pairs([(conv, state.hexdigest())], kind)

    return short.unionByName(long.mapInArrow(run, f"conv {conv_type}, sha256 string"))


def _pairs(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], kind), pa.array([r[1] for r in rows], pa.string())], names=["conv", "sha256"]
    )
