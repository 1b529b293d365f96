"""Conversation repair against a search over all edits."""

import hashlib
import heapq
import itertools
import random
import re
import zlib
from collections import defaultdict

import pytest

import __spark_entry__ as entry
from tidemark.llm import dialogue

GRAMMAR = re.compile("(s?(ua)+)?")
SPACE = " \t\n\x0b\x0c\r"
TYPES = "conv_id long, turn long, role string, text string"


def brute_faults(rows):
    """Fault of each row (blank, duplicate, truncated or none) in their order."""
    seen, out = set(), []
    for role, text in rows:
        body = text.rstrip(SPACE)
        if not body:
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        else:
            out.append("" if body[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def brute_repair(rows):
    """Least (cost, audit) by a uniform-cost search over audits, and the repaired rows."""
    faults = brute_faults(rows)
    after = {"": "su", "s": "u", "u": "a", "a": "u"}  # the role initials that may follow
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, at, last, out = heapq.heappop(heap)
        if (at, last) in done:
            continue
        done.add((at, last))
        if at == len(rows) and last in ("", "a"):
            return cost, audit, list(out)
        steps = [(5, "I", at, s, "") for s in after[last] if s != "s"]
        if at < len(rows):
            role, text = rows[at]
            steps.append((2, "D", at + 1, None, None))
            if faults[at] in ("", "truncated"):
                extra = 5 * (faults[at] == "truncated")
                if role[:1] in after[last] and role:
                    steps.append((extra, "K", at + 1, role[0], text))
                steps += [(1 + extra, "R", at + 1, s, text) for s in after[last] if s != "s"]
        for price, letter, to, symbol, text in steps:
            if symbol is None:
                heapq.heappush(heap, (cost + price, audit + letter, to, last, out))
            else:
                role = rows[at][0] if letter == "K" else {"u": "user", "a": "assistant"}[symbol]
                heapq.heappush(heap, (cost + price, audit + letter, to, symbol, (*out, (role, text))))


def brute(rows):
    """One conversation's result from (turn, role, text) in any order."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    turns = [r[0] for r in rows if r[0] is not None]
    pairs = [(r[1], r[2]) for r in rows]
    faults = brute_faults(pairs)
    initials = [(r[:1] or " ") for r, _ in pairs]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    cost, audit, out = brute_repair(pairs)
    assert GRAMMAR.fullmatch("".join(r[0] for r, _ in out))
    digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest()
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    return (gaps, *[faults.count(f) for f in ("blank", "duplicate", "truncated")], illegal, cost, audit, digest)


def test_search_is_the_least_of_all_edits():
    """The search itself against every audit of short conversations."""
    rng = random.Random(3)
    for _ in range(60):
        rows = [(rng.choice(["system", "user", "assistant", "tool"]), rng.choice(["a.", "b.", "c", "d.", " "])) for _ in range(rng.randrange(4))]
        faults, best = brute_faults(rows), None
        gaps = ["", "u", "a", "ua", "au"]
        for inserted in itertools.product(gaps, repeat=len(rows) + 1):
            if sum(map(len, inserted)) > 2:
                continue
            for edits in itertools.product("DKua", repeat=len(rows)):
                roles, audit, cost = inserted[0], "I" * len(inserted[0]), 5 * len(inserted[0])
                for (role, _), fault, edit, more in zip(rows, faults, edits, inserted[1:]):
                    if edit == "D":
                        cost += 2
                    elif fault in ("blank", "duplicate"):
                        break
                    else:
                        cost += (edit != "K") + 5 * (fault == "truncated")
                        roles += role[0] if edit == "K" else edit
                    audit += edit if edit in "DK" else "R"
                    roles, audit, cost = roles + more, audit + "I" * len(more), cost + 5 * len(more)
                else:
                    if GRAMMAR.fullmatch(roles) and (best is None or (cost, audit) < best):
                        best = (cost, audit)
        assert brute_repair(rows)[:2] == best


def conversation(rng, size):
    return [
        (
            rng.choice([t, t, t, None, rng.randrange(size)]),
            rng.choice(["user", "assistant"][t % 2 :] + ["system", "user", "assistant", "tool", "", "User", "agent"]),
            rng.choice(["Yes.", "No!", "", " \n", "cut", f"t{t}.", f"t{t}.", "why? "]),
        )
        for t in range(size)
    ]


def test_parser_is_the_search():
    rng = random.Random(4)
    for _ in range(300):
        rows = conversation(rng, rng.randrange(12))
        block, seen = dialogue.Block(), set()
        for turn, role, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])):
            block.add(turn, role, text, 1, (role, text) not in seen)
            seen.add((role, text))
        _, (cost, audit) = dialogue.least_final(block.ways(dialogue.START))
        want = brute([*rows]) if rows else (0, 0, 0, 0, 0, 0, "", None)
        assert (cost, audit) == want[5:7]
        assert [(r["role"], r["text"]) for r in dialogue.repaired_rows(block.items, audit, dialogue.START)] == brute_repair(
            [(r, t) for r, t, _ in block.items]
        )[2]


def collected(facts, turns):
    hashed = {r.conv: r.sha256 for r in dialogue.digests(turns).collect()}
    return {r.conv: (*tuple(r)[1:], hashed[r.conv]) for r in facts.collect()}


@pytest.mark.parametrize("block", [1, 3, 512])
def test_repair(spark, block):
    rng = random.Random(5)
    groups = {c: conversation(rng, rng.randrange(1, 9)) for c in range(60)}
    groups[None] = conversation(rng, 6)
    groups[7] = conversation(rng, 300)  # most of all rows, over many blocks and tasks
    groups[8] = [(t, "user" if t % 2 == 0 else "assistant", f"Turn {t}.") for t in range(90)]
    groups[9] = [(1, "user", "Same.")] * 150 + [(2, "assistant", "Well.")]
    rows = [(c, *r) for c, many in groups.items() for r in many]
    rng.shuffle(rows)
    got = collected(*dialogue.repair(spark.createDataFrame(rows, TYPES).repartition(5), block=block))
    assert got == {c: brute(many) for c, many in groups.items()}


def test_odd_rows(spark):
    rows = [(1, None, None, None), (1, 3, "user", None), (2, None, "user", "Hi."), (2, None, "assistant", "Ho."), (None, 1, "", "x.")]
    df = spark.createDataFrame(rows, TYPES).selectExpr("*", "1 AS conv", "2 AS part", "'x' AS fresh", "map('a', 1) AS times")
    got = collected(*dialogue.repair(df))
    want = defaultdict(list)
    for c, turn, role, text in rows:
        want[c].append((turn, " " if role is None else role, " " if text is None else text))
    assert got == {c: brute(r) for c, r in want.items()}
    facts, turns = dialogue.repair(df.filter("false"))
    assert facts.collect() == [] and dialogue.digests(turns).collect() == []


def damaged(rows):
    out = []
    for c, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        fault = zlib.crc32(f"{' ' if c is None else c}:{' ' if turn is None else turn}".encode()) % 20
        if fault == 1:
            text = ""
        elif fault == 2:
            text = re.sub("[.!?]", "", text)
        elif fault == 4:
            role = "user"
        out += [(c, turn, role, text)] * {0: 0, 3: 2}.get(fault, 1)
    return out


def test_query_is_brute_force(spark, tmp_path):
    rows = list(map(tuple, spark.read.parquet("/root/testdata/sf0.01/conversations.parquet").collect()))
    dropped = next(c for c in range(10**6, 2 * 10**6) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    rows += [(dropped, 0, "user", "Gone."), (None, 1, "user", "Hm."), (None, None, None, None), (3 * 10**6, None, "user", "?")]
    spark.createDataFrame(rows, TYPES).write.parquet(str(tmp_path / "conversations.parquet"))
    got = entry.queries()["op12_conversation_repair"](spark, str(tmp_path)).collect()
    groups = {c: [] for c, *_ in rows}
    for c, *row in damaged(rows):
        groups[c].append(tuple(row))
    empty = hashlib.sha256(b"").hexdigest()
    want = {c: brute(r) if r else (0, 0, 0, 0, 0, 0, "", empty) for c, r in groups.items()}
    assert len(got) == len(want) and {r.conv_id: tuple(r)[1:] for r in got} == want
