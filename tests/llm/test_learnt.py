"""Toxicity, language and quality: exact parts against brute force, learnt ones by held-out accuracy."""

import random
import zlib

import numpy as np
import pytest

from tidemark.llm import langid, mil, toxicity

CLEAN = "garden river window paper yellow morning letter music market winter silver road little often under".split()
BAD = "vile rotten filthy".split()


def held_out(i, n, rest):
    return zlib.crc32(str(i).encode()) % n == rest


# ---- toxicity


def brute_segments(values):
    best = None
    for i in range(len(values)):
        total = 0.0
        for j in range(i, len(values)):
            total += values[j]
            if total > 1e-12 and (best is None or total > best[0] + 1e-9):
                best = (total, i, j)
    if best is None:
        return []
    _, i, j = best
    return brute_segments(values[:i]) + [best] + [(s, a + j + 1, b + j + 1) for s, a, b in brute_segments(values[j + 1 :])]


def test_maximal_segments():
    rng = random.Random(3)
    for _ in range(1500):
        gap = -rng.random()
        values = [rng.random() * 2 if rng.random() < 0.3 else gap for _ in range(rng.randrange(25))]
        got = toxicity.maximal_segments([(i, v) for i, v in enumerate(values) if v > 0], gap)
        want = brute_segments(values)
        assert [g[1:] for g in got] == [w[1:] for w in want]
        assert np.allclose([g[0] for g in got], [w[0] for w in want])


def test_maximal_segments_in_linear_time():
    n = 400_000  # ever lower starts: each candidate stays on its own
    got = toxicity.maximal_segments([(4 * i, 1.0) for i in range(n)], -1.0)
    assert len(got) == n


@pytest.fixture(scope="module")
def toxic_corpus(spark):
    rng = random.Random(6)
    docs, labels = [], []
    for i in range(1200):
        words = [rng.choice(CLEAN) + str(rng.randrange(40)) for _ in range(rng.randrange(20, 200))]
        toxic = i % 6 == 0
        if toxic:
            for _ in range(3):
                words[rng.randrange(len(words))] = rng.choice(BAD) + rng.choice(["", "er", "est"])
        docs.append((i, " ".join(words)))
        if i % 3 == 0:
            labels.append((i, int(toxic)))
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_toxicity(toxic_corpus, odd_docs, no_docs):
    docs, labels = toxic_corpus
    model = toxicity.fit(docs, labels)
    got = toxicity.score(docs, model).collect()
    assert len(got) == 1200
    for r in got:
        assert r.held_out == held_out(r.doc_id, 5, 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    fresh = [r for r in got if r.held_out]
    assert np.mean([r.predicted == (r.doc_id % 6 == 0) for r in fresh]) > 0.97
    assert toxicity.score(odd_docs, model).count() == odd_docs.count()
    assert toxicity.score(no_docs, model).collect() == []
    kept = toxicity.drop_toxic(docs, model).select("doc_id").collect()
    assert {r.doc_id for r in kept} == {r.doc_id for r in got if not r.predicted}
    left = toxicity.drop_toxic(odd_docs, model)
    assert left.columns == odd_docs.columns and left.count() == odd_docs.count()


def test_toxicity_of_long_passages(spark):
    """A passage whose score passes what exp can hold is evidence like others; it made all weights and scores NaN."""
    assert np.isfinite(toxicity.Model(k=0.01).evidence(4000, [5000.0, 800.0, 3.0])[0])
    rng = random.Random(8)
    docs = []
    for i in range(300):
        words = [rng.choice(CLEAN) + str(rng.randrange(40)) for _ in range(rng.randrange(20, 100))]
        if i % 6 == 0:
            words[5:5] = [rng.choice(BAD) for _ in range(1500 if i == 6 else 3)]
        docs.append((i, " ".join(words)))
    labels = spark.createDataFrame([(i, int(i % 6 == 0)) for i in range(300)], "doc_id long, toxic int")
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    model = toxicity.fit(docs, labels)
    assert np.isfinite(model.weights).all()
    got = [r for r in toxicity.score(docs, model).collect() if r.held_out]
    toxic = [r.score for r in got if r.doc_id % 6 == 0]
    assert toxic and min(toxic) > max(r.score for r in got if r.doc_id % 6)


def test_toxicity_without_labels(toxic_corpus, no_docs):
    docs, labels = toxic_corpus
    for few in (labels.filter("false"), labels.filter("toxic = 0"), labels.selectExpr("doc_id", "CAST(NULL AS INT) AS toxic")):
        assert {r.predicted for r in toxicity.score(docs, toxicity.fit(docs, few)).collect()} == {0}
    assert toxicity.score(no_docs, toxicity.fit(no_docs, labels)).collect() == []


def test_labels_of_the_held_out_fold_are_not_used(spark, toxic_corpus):
    docs, labels = toxic_corpus
    turned = labels.selectExpr("doc_id", "IF(crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 5 = 0, 1 - toxic, toxic) AS toxic")
    one, two = toxicity.fit(docs, labels), toxicity.fit(docs, turned)
    assert (one.scores, one.weights, one.k) == (two.scores, two.weights, two.k)


# ---- language

SYLLABLES = {"aa": "ka ro mi te lu sha".split(), "bb": "zwe ikt oor van het gij".split(), "cc": "él ño çu aî où ré".split()}


@pytest.fixture(scope="module")
def language_corpus(spark):
    rng = random.Random(12)
    rows = []
    for i in range(900):
        lang = rng.choice(["aa", "aa", "bb", "cc"])
        words = ["".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randrange(1, 5))) for _ in range(rng.randrange(3, 90))]
        rows.append((i, " ".join(words), lang if i % 10 else None))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string"), {i: words for i, words, _ in rows}


def test_languages(language_corpus, odd_docs, no_docs):
    docs, texts = language_corpus
    filters = langid.fit(docs)
    assert filters.languages == ["aa", "bb", "cc"]
    truth = {r.doc_id: r.lang for r in docs.collect()}
    got = langid.identify(docs, filters).collect()
    for r in got:
        assert r.held_out == held_out(r.doc_id, 5, 0) and 0 <= r.score <= 1
    known = [r for r in got if truth[r.doc_id]]
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in known if r.held_out]) > 0.98
    odd = {(r.doc_id, r.lang_pred == "und", r.score > 0) for r in langid.identify(odd_docs, filters).collect()}
    assert {(3, True, False), (4, True, False), (6, True, False), (7, True, False)} <= odd
    assert (9, False, False) in odd or (9, False, True) in odd
    assert langid.identify(no_docs, filters).collect() == []
    nothing = langid.fit(docs.filter("lang = 'xx'"))
    assert {r.lang_pred for r in langid.identify(docs, nothing).collect()} == {"und"}


def test_filters_against_sets():
    rng = np.random.default_rng(1)
    members = {f"l{i:02}": np.unique(rng.integers(0, 2**32, 3000, dtype=np.uint32)) for i in range(70)}
    filters = langid.Filters.build(members, rows=1 << 15)
    assert filters.table.shape == (1 << 15, 2)
    for i, language in enumerate(filters.languages):
        masks = None
        for slot in langid._slots(members[language], 1 << 15):
            found = filters.table[slot, i // 64]
            masks = found if masks is None else masks & found
        assert ((masks >> np.uint64(i % 64)) & np.uint64(1)).all()  # no false negatives
    strange = rng.integers(0, 2**32, 20_000, dtype=np.uint32)
    hits = None
    for slot in langid._slots(strange, 1 << 15):
        found = filters.table[slot, 0] & np.uint64(1)
        hits = found if hits is None else hits & found
    assert abs(hits.mean() - filters.wrong[0]) < 0.01


def test_grams():
    texts = ["Ab", "", "é", "x1y"]
    code, starts = langid.grams(texts)
    for i, text in enumerate(texts):
        raw = (" " + "".join(c if c.isalpha() else " " for c in text.lower()) + "  ").encode()
        want = [int.from_bytes(raw[j : j + 4], "big") for j in range(len(raw) - 3)]
        assert code[starts[i] : starts[i + 1]].tolist() == want


# ---- quality


def test_gradients():
    rng = np.random.default_rng(0)
    bags = [rng.random((n, mil.FEATURES)).astype(np.float32) for n in (1, 3, 5, 2)]
    y = np.array([1.0, 0.0, 1.0, 0.0])
    network = mil.train(bags, np.ones(4))
    weights = {k: rng.normal(0, 0.3, v.shape) for k, v in network.weights.items()}
    x, real = np.zeros((4, 5, mil.FEATURES)), np.zeros((4, 5), bool)
    for i, b in enumerate(bags):
        x[i, : len(b)], real[i, : len(b)] = b, True

    def loss(w):
        h = np.tanh(x @ w["encode"] + w["bias"])
        s = np.where(real, (np.tanh(h @ w["tanh"]) / (1 + np.exp(-h @ w["gate"]))) @ w["attend"], -1e9)
        a = np.exp(s - s.max(1, keepdims=True))
        z = np.einsum("bk,bkh->bh", a / a.sum(1, keepdims=True), h)
        p = 1 / (1 + np.exp(-(z @ w["out"] + w["offset"][0])))
        return -np.mean(y * np.log(p) + (1 - y) * np.log(1 - p))

    found = mil._gradients(weights, x, real, y)
    for name, value in weights.items():
        for _ in range(4):
            at = tuple(rng.integers(0, s) for s in value.shape)
            moved = {k: v.copy() for k, v in weights.items()}
            moved[name][at] += 1e-5
            up = loss(moved)
            moved[name][at] -= 2e-5
            assert found[name][at] == pytest.approx((up - loss(moved)) / 2e-5, abs=1e-6)


def test_passages():
    texts = ["", "a b a b c", "x" * 1000, "One two.\n", " ", "é" * 500]
    rows, bags = mil.passages(texts)
    assert bags.tolist() == [1, 1, 4, 1, 1, 4] and rows.shape == (12, mil.FEATURES)
    at = 0
    for text, n in zip(texts, bags):  # a text's features don't depend on its neighbours
        assert np.array_equal(rows[at : at + n], mil.passages([text])[0])
        at += n


@pytest.fixture(scope="module")
def quality_corpus(spark):
    rng = random.Random(21)
    docs, labels = [], []
    for i in range(900):
        words = [rng.choice(CLEAN) for _ in range(rng.randrange(8, 300))]
        good = i % 4 != 0
        if not good:
            style = rng.randrange(3)
            words = [[w.upper() + "!!", w + rng.choice(["***", "%%%"]), words[k // 9]][style] for k, w in enumerate(words)]
        docs.append((i, " ".join(words) + "."))
        if i % 2 == 0 or i % 5 == 0:
            labels.append((i, int(good)))
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int")


def test_quality(quality_corpus, odd_docs, no_docs):
    docs, labels = quality_corpus
    network = mil.fit(docs, labels)
    got = mil.score(docs, network).collect()
    for r in got:
        assert r.held_out == held_out(r.doc_id, 3, 1) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    fresh = [r for r in got if r.held_out]
    assert np.mean([r.predicted == (r.doc_id % 4 != 0) for r in fresh]) > 0.95
    again = {r.doc_id: r.score for r in mil.score(docs, mil.fit(docs.repartition(5), labels)).collect()}
    assert all(abs(again[r.doc_id] - r.score) < 1e-9 for r in got)
    assert mil.score(odd_docs, network).count() == odd_docs.count()
    assert mil.score(no_docs, network).collect() == []
    nothing = mil.fit(docs, labels.filter("false"))
    assert {0 <= r.score <= 1 for r in mil.score(docs, nothing).collect()} == {True}
