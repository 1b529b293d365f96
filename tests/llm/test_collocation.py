"""Phrase collocations against counting by text."""

import random
import re
from collections import Counter

import numpy as np
import pytest

import check_oracle
from tidemark.llm import bits
from tidemark.llm import collocation as co

LOWER = {i: i + 32 for i in range(65, 91)}


def brute_runs(text):
    """All runs of one to four words of a text."""
    out = Counter()
    for piece in re.split("[.,;:!?\x0a-\x0d]", text.translate(LOWER)):
        words = re.findall("[^ \t]+", piece)
        for size in range(1, 5):
            out.update(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    return out


def brute(rows, least, top, cover):
    """Rows (lang, text) -> the ranked phrases."""
    counts = {}
    for lang, text in rows:
        counts.setdefault("und" if lang is None else lang, Counter()).update(brute_runs(text or ""))
    out = []
    for lang, f in counts.items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        candidates = {p: c for p, c in f.items() if len(p) > 1 and c >= least}
        found = []
        for p, a in candidates.items():
            inside = any(
                100 * c >= cover * a
                for q, c in candidates.items()
                if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))
            )
            if not inside:
                score, _, l, r = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
                found.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, n, -score))
    return sorted(out)


def texts(rng, n):
    vocabulary = [f"w{i}" for i in range(12)] + ["É", "ß漢", "A", "New", "YORK", "x y"]
    ends = [" ", " ", " ", "  ", "\t", ". ", ", ", "\n", "\x0b", "!? "]
    out = []
    for _ in range(n):
        words = []
        for _ in range(rng.randrange(40)):
            words.append("New York City" if rng.random() < 0.1 else vocabulary[min(rng.randrange(18), rng.randrange(18))])
            words.append(rng.choice(ends))
        out.append((rng.choice(["en", "en", "en", "de", None, "und"]), "".join(words)))
    return out


@pytest.mark.parametrize("width", [64, 9, 6])  # few bits: most fingerprints stand for several phrases
@pytest.mark.parametrize("slice_bytes", [1 << 20, 40])
def test_collocations(spark, monkeypatch, width, slice_bytes):
    monkeypatch.setattr(co, "SLICE", slice_bytes)
    rng = random.Random(width)
    rows = texts(rng, 150) + [("en", "New York City now. " * 60)] * 70 + [("de", None), (None, ""), ("fr", " ,. ")]
    df = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    got = co.collocations(df, least=12, top=25, cover=80, print_bits=width).collect()
    assert sorted(map(tuple, got)) == brute(rows, 12, 25, 80)


def test_odd_documents(spark, odd_docs, no_docs):
    rows = [(r.lang, r.text) for r in odd_docs.collect()]
    assert sorted(map(tuple, co.collocations(odd_docs, least=2).collect())) == brute(rows, 2, 2000, 80)
    assert co.collocations(no_docs).collect() == []


def test_full_filter_loses_nothing(spark, monkeypatch):
    monkeypatch.setattr(bits, "MOST", 6)
    rows = texts(random.Random(1), 120)
    got = co.collocations(spark.createDataFrame(rows, "lang string, text string"), least=5).collect()
    assert sorted(map(tuple, got)) == brute(rows, 5, 2000, 80)


def test_prints_are_those_of_the_words():
    data = [co.fold(t.encode()) for t in ("One two, one  TWO\tthree", "one two three", "")]
    words = co.Words(data, [7, 7, 8])
    at = words.whole(2)
    runs = [data[0][words.starts[i] : words.ends[i + 1]] if words.ends[i + 1] <= len(data[0]) else None for i in at]
    assert runs[:2] == [b"one two", b"one  two"]
    prints = words.prints(at, 2)
    assert prints[0] == prints[1] == prints[3] and prints[2] == prints[4] and prints[0] != prints[2]
    assert len(np.unique(words.prints(at, 2, co.SECOND))) == 2
    assert co.Words([data[1]], [9]).prints(np.array([0]), 2)[0] != prints[0]  # another language


def test_scores_beyond_64_bits(spark):
    big = 3 * 10**18
    known = [("en", 0, "", 4 * big // 4), ("en", 1, "a", big), ("en", 1, "b", big), ("en", 2, "a b", big)]
    df = spark.createDataFrame(known, "lang string, words int, phrase string, n long")
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(co, "frequent_phrases", lambda *a, **k: df)
        row = co.collocations(df).first()
    assert (row.score, row.a) == (1_000_000, big)


def test_sql(spark):
    folder = "/root/testdata/sf0.001"
    assert check_oracle.compare(spark, check_oracle.connect(folder), folder, "op13_phrase_collocations") == ""
