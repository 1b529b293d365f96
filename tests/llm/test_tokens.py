"""Byte-level BPE and packing against the tokenizer libraries."""

import hashlib
import random
import subprocess
import sys
import time
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from tokenizers import Tokenizer

from tidemark.llm import bpe, packing
from tidemark.llm.common import cut_words

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
PATTERN = public_tokenizers.PATTERN
ALPHABET = [
    "a", "b", " ", "  ", "\n", "\t", " \n", "é", "ß", "1", "²", "'s", "'ll", ".", " ", " ", "中", "😀", "\x1c",
    "\x85", "<|endoftext|>", "the", " he", "\r", "\0", "Ġ", "longerword", "ing",
]


@pytest.fixture(scope="module")
def codec():
    return bpe.codec(RANKS, PATTERN)


@pytest.fixture(scope="module")
def oracle(codec):
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=codec.ranks, special_tokens={})


@pytest.fixture(scope="module")
def tokenizer():
    found = Tokenizer.from_file(VOCABULARY)
    found.encode_special_tokens = True
    return found


def random_texts(n, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choice(ALPHABET) for _ in range(rng.randrange(15))) for _ in range(n)]


def digests(ids, text):
    line = " ".join(map(str, ids)).encode()
    return len(ids), hashlib.sha256(line).hexdigest(), hashlib.sha256(text.encode()).hexdigest()


def test_encode_and_decode(codec, oracle):
    for text in random_texts(3000) + ["ab" * 20_000, "x" * 1000, "é" * 333]:
        ids = codec.encode(text)
        assert ids == oracle.encode_ordinary(text)
        assert codec.decode(ids) == text.encode()


def test_short_pieces_merge_like_long_ones(codec):
    rng = random.Random(5)
    pieces = [bytes(rng.choice(b"aeinrst the\xc3\xa9") for _ in range(rng.randrange(2, bpe.FAN + 1))) for _ in range(2000)]
    assert bpe.merge_short(pieces, codec.pairs) == [
        bpe.merge_piece(p, {k: v for k, v in codec.ranks.items() if k != p} if p in codec.ranks else codec.ranks)
        if p not in codec.ranks
        else bpe.merge_short([p], codec.pairs)[0]
        for p in pieces
    ]


def test_digests_with_a_small_memory(oracle, codec):
    own = bpe.Codec(codec.ranks, PATTERN)
    own.words.limit = own.pieces.limit = 1_000
    texts = random_texts(600, 7) + ["", "word"]
    for at in range(0, len(texts), 11):
        part = texts[at : at + 11]
        assert list(zip(*own.digests(part))) == [digests(oracle.encode_ordinary(t), t) for t in part]


def test_memory_is_bounded(codec):
    """Texts without blanks, first parts and long words are not remembered, and two generations are all there is."""
    rng = random.Random(4)
    chinese = ["".join(chr(0x4E00 + rng.randrange(5000)) for _ in range(2000)) for _ in range(20)]
    long = [f"a {'x' * 3000}{i} {'漢' * 500}{i}" for i in range(20)]
    line, own = packing.TokenLine(VOCABULARY, PATTERN), bpe.Codec(codec.ranks, PATTERN)
    for memory, work in ((line, line.encode), (own, own.digests)):
        work(chinese + long)
        assert all(len(w) <= 64 for m in (memory.words, memory.pieces) for w in [*m.now, *m.older])
        assert memory.words.held + memory.pieces.held < 50_000
        memory.words.limit = 100_000
        for i in range(30):
            work([" ".join(f"w{rng.random()}" for _ in range(200))])
            assert memory.words.held < 200_000
        assert memory.words.older
        memory.forget()
        assert not (memory.words.now or memory.words.older or memory.pieces.now or memory.pieces.held)


def test_token_digests(spark, odd_docs, no_docs, oracle):
    rows = [(r.doc_id, r.text or "") for r in odd_docs.collect()]
    got = bpe.token_digests(odd_docs, RANKS, PATTERN).collect()
    want = [(i, *digests(oracle.encode_ordinary(t), t)) for i, t in rows]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    assert bpe.token_digests(no_docs, RANKS, PATTERN).collect() == []


# ---- packing


def brute_cost(positions, penalties, plan):
    cost = [0.0]
    for j in range(1, len(positions)):
        best = float("inf")
        for i in range(j):
            size = positions[j] - positions[i]
            if size > plan.capacity:
                continue
            power = size & (size - 1) == 0 and size >= plan.least_power
            best = min(best, cost[i] + (0 if power else plan.capacity - size))
        cost.append(best + penalties[j] + plan.window)
    return cost[-1]


def test_window_ends_are_best():
    rng = np.random.default_rng(3)
    plan = packing.Plan(capacity=32, least_power=4, window=2.0)
    for _ in range(200):
        positions = np.concatenate([[0], np.cumsum(rng.integers(1, 14, rng.integers(1, 60)))])
        penalties = rng.choice([0.0, 5.0, 20.0], len(positions))
        ends = packing.best_ends(positions, penalties, plan)
        assert ends[-1] == len(positions) - 1
        total, start = 0.0, 0
        for j in ends:
            size = int(positions[j] - positions[start])
            power = size & (size - 1) == 0 and size >= plan.least_power
            assert 0 < size <= plan.capacity
            total += (0 if power else plan.capacity - size) + penalties[j] + plan.window
            start = j
        assert total == pytest.approx(brute_cost(positions.tolist(), penalties.tolist(), plan))


def check_pieces(rows, texts, tokenizer, capacity=1024):
    """``rows`` as of ``pack`` in tuples; ``texts`` by id."""
    ids = {i: np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 0], "<u4") for i, t in texts.items()}
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for i, start, length, crc, total, sequence, offset in rows:
        assert length > 0 and total == len(ids[i])
        assert crc == zlib.crc32(ids[i][start : start + length].tobytes())
        by_doc[i].append((start, length))
        by_sequence[sequence].append((offset, length))
    assert set(by_doc) == set(texts)
    for i, pieces in by_doc.items():
        assert sum(n for _, n in pieces) == len(ids[i])
        assert [a for a, _ in sorted(pieces)] == np.cumsum([0] + [n for _, n in sorted(pieces)])[:-1].tolist()
    for pieces in by_sequence.values():
        pieces.sort()
        assert [a for a, _ in pieces] == np.cumsum([0] + [n for _, n in pieces])[:-1].tolist()
        assert sum(n for _, n in pieces) <= capacity
    return [sum(n for _, n in pieces) for pieces in by_sequence.values()]


def test_encode_like_the_library(tokenizer):
    line = packing.TokenLine(VOCABULARY, PATTERN)
    line.words.limit = line.pieces.limit = 1_000
    texts = random_texts(1500, 3) + ["", "a b", "end. Next!\nThird? Yes", "x" * 3000]
    for at in range(0, len(texts), 13):
        part = texts[at : at + 13]
        got = line.encode(part)
        assert [g.tolist() for g in got] == [tokenizer.encode(t, add_special_tokens=False).ids + [0] for t in part]
        for (places, costs), ids in zip(line.cuts(got, packing.Plan()), got):
            assert len(places) == len(costs) and all(0 < p < len(ids) for p in places)
            assert (np.diff(places) > 0).all()


def test_every_sentence_end_is_a_choice():
    line = packing.TokenLine(VOCABULARY, PATTERN)
    texts = ["One. Two and a half! Three?\nFour. Five", " ".join(["Go on."] * 400), "No end", ""] + ["So. It is."] * 3
    found = line.encode(texts)
    for ids, (places, costs) in zip(found, line.cuts(found, packing.Plan())):
        shown = [line.tokenizer.id_to_token(i) for i in ids[:-1].tolist()]
        want = [
            k
            for k in range(1, len(shown))
            if shown[k - 1][-1] == "Ċ" or (shown[k - 1][-1] in ".!?" and shown[k][0] in "ĠĊ")
        ]
        assert places.tolist() == want and (costs == packing.Plan().sentence_cut).all()


def test_pack(spark, tokenizer):
    rng = random.Random(8)
    texts = {}
    for i in range(300):
        words = [rng.choice(["alpha", "beta", "gamma.", "delta", "epsilon!", "zeta\n"]) for _ in range(rng.randrange(900))]
        texts[i] = " ".join(words) if rng.random() < 0.9 else "".join(words).replace(".", "").replace("!", "")
    texts[300], texts[301], texts[302] = None, "", "x" * 20_000
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(9)
    for plan in (packing.Plan(), packing.Plan(block=3_000)):
        rows = [tuple(r) for r in packing.pack(df, VOCABULARY, PATTERN, plan=plan).collect()]
        sizes = check_pieces(rows, texts, tokenizer)
        padding = sum(0 if n & (n - 1) == 0 else 1024 - n for n in sizes)
        assert padding < 0.06 * sum(sizes)
        order = [r[0] for r in sorted(rows, key=lambda r: (r[5], r[6]))]
        assert order == sorted(order)  # documents keep their order


def test_pack_odd_documents(odd_docs, no_docs, tokenizer):
    rows = packing.pack(odd_docs, VOCABULARY, PATTERN).collect()
    total = sum(len(tokenizer.encode(r.text or "", add_special_tokens=False).ids) + 1 for r in odd_docs.collect())
    assert sum(r.length for r in rows) == total
    assert packing.pack(no_docs, VOCABULARY, PATTERN).collect() == []


def test_words_are_listed_at_once():
    """Listing the distinct words of a slice costs less than a Python object of Arrow's for each of them."""
    rng = random.Random(6)
    texts = [" ".join(f"w{rng.getrandbits(40)}" for _ in range(500)) for _ in range(200)]
    heads, words, rest, bounds = cut_words(texts)
    assert [" ".join([h, *[words[i] for i in rest[a:b]]]) for h, a, b in zip(heads, bounds, bounds[1:])] == texts

    def seconds(work):
        times = []
        for _ in range(3):
            began = time.process_time()
            work()
            times.append(time.process_time() - began)
        return min(times)

    distinct = pa.array([w for t in texts for w in t.split(" ")])
    assert seconds(lambda: cut_words(texts)) < seconds(distinct.to_pylist)


def test_memory_is_given_back():
    """What a slice took leaves the worker; in a process of its own, as the figures depend on all that ran before."""
    script = f"""
import random, re
from tidemark.llm import packing
held = lambda: sum(map(int, re.findall(r"Pss_Anon:\\s+(\\d+)", open("/proc/self/smaps_rollup").read()))) >> 10
rng = random.Random(1)
line = packing.TokenLine({VOCABULARY!r}, {PATTERN!r})
texts = [" ".join(f"{{rng.choice(['some', 'more'])}}{{rng.getrandbits(17)}}" for _ in range(500)) for _ in range(600)]
del line.encode(texts)[:]
line.forget()
before = held()
packing.give_back()
print(before, held())
"""
    done = subprocess.run([sys.executable, "-c", script], capture_output=True, text=True, check=True)
    before, after = map(int, done.stdout.split()[-2:])
    assert after < before - 20
