"""Exact, near and substring dedup against brute force."""

import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import exact, jaccard, simhash, substring
from tidemark.llm.bits import parted
from tidemark.llm.components import components


def prose(rng, words, vocabulary=400):
    out, line = [], []
    for _ in range(words):
        line.append(f"w{rng.randrange(vocabulary)}x")
        if rng.random() < 0.12:
            out.append(" ".join(line).capitalize() + ".")
            line = []
    return " ".join(out + ([" ".join(line)] if line else []))


# ---- exact


def brute_copies(rows):
    groups = defaultdict(list)
    for i, text in rows:
        groups[text or ""].append(i)
    out = []
    for text, ids in groups.items():
        named = [i for i in ids if i is not None]
        keep = max(named) if named else None
        used = False
        for i in ids:
            kept = i == keep and not used
            used |= kept
            out.append((i, keep, len(ids), kept, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("counters", [2, 1024])
def test_copy_groups(spark, counters):
    rng = random.Random(1)
    texts = [f"text {min(rng.randrange(60), rng.randrange(60))}" for _ in range(400)]
    texts += ["hot"] * 300  # a third and more of all rows
    rows = [(i, t) for i, t in enumerate(texts)] + [(5, texts[5]), (699, "hot"), (None, "hot"), (None, None), (800, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    got = exact.copy_groups(df, counters=counters).collect()
    assert sorted(((r.id, r.keep_id, r.group_size, r.kept, r.digest.hex()) for r in got), key=str) == brute_copies(rows)


def test_copies_of_odd_documents(odd_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    got = exact.copy_groups(odd_docs).collect()
    assert sorted(((r.id, r.keep_id, r.group_size, r.kept, r.digest.hex()) for r in got), key=str) == brute_copies(rows)
    assert exact.copy_groups(no_docs).collect() == []
    left = exact.drop_copies(odd_docs)
    assert left.columns == odd_docs.columns
    assert sorted(r.text or "" for r in left.collect()) == sorted({t or "" for _, t in rows})
    assert exact.drop_copies(no_docs).count() == 0


def test_repeated_winner_stays_once(spark):
    df = spark.createDataFrame([(3, "a", 1), (3, "a", 1), (2, "a", 0), (4, "b", 0)], "doc_id long, text string, kept int")
    assert sorted(map(tuple, exact.drop_copies(df).collect())) == [(3, "a", 1), (4, "b", 0)]


def test_misra_gries_never_misses_a_heavy_key():
    rng = np.random.default_rng(2)
    keys = rng.zipf(1.3, 20_000) % 5_000
    for counters in (4, 32, 256):
        found = exact.misra_gries(iter(np.array_split(keys, 13)), counters)
        assert len(found) <= counters
        values, counts = np.unique(keys, return_counts=True)
        for value, count in zip(values.tolist(), counts.tolist()):
            assert count - len(keys) / (counters + 1) <= found.get(value, 0) <= count


# ---- simhash


def brute_fingerprint(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in re.split("[\x20\x09-\x0d]+", text) if w]
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(codes, differ):
    parent = list(range(len(codes)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(codes)):
        for j in np.flatnonzero(np.bitwise_count(codes ^ codes[i]) <= differ).tolist():
            a, b = find(i), find(j)
            parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(codes))]


def near_copies(seed=4):
    rng = random.Random(seed)
    texts = []
    for _ in range(25):
        base = prose(rng, rng.randrange(300, 900)).split(" ")
        for _ in range(rng.randrange(1, 6)):
            words = list(base)
            for _ in range(rng.randrange(0, 3)):
                words[rng.randrange(len(words))] = "changed"
            texts.append(" ".join(words))
    return texts + ["", None, "One", "one", "Two words", "  two\twords "]


def test_fingerprint():
    for text in [*near_copies()[:20], "", "A", "A b", "a B c", "Ä ä É", "x\x0by z", "a " * 9000]:
        assert simhash.fingerprint(text) == brute_fingerprint(text)


@pytest.mark.parametrize("differ", [1, 2, 3])
def test_index_finds_every_link(differ):
    rng = np.random.default_rng(differ)
    base = rng.integers(0, 2**64, 120, dtype=np.uint64)
    flips = [base]
    for _ in range(8):
        noisy = base.copy()
        for _ in range(int(rng.integers(1, 4))):
            noisy ^= np.uint64(1) << rng.integers(0, 64, len(base)).astype(np.uint64)
        flips.append(noisy)
    crowd = np.uint64(12345) ^ (np.uint64(1) << np.arange(64, dtype=np.uint64))
    codes = np.unique(np.concatenate([*flips, crowd]))
    index = simhash.GrayIndex(codes)
    got = {(a, b) for x, y in index.links(differ, np.uint64(0)) for a, b in zip(x.tolist(), y.tolist())}
    apart = np.bitwise_count(index.codes[:, None] ^ index.codes[None, :])
    want = {(a, b) for a, b in zip(*(x.tolist() for x in np.nonzero(apart <= differ))) if a < b}
    assert got == want
    groups = brute_groups(codes, differ)
    parent = {c: c for c in codes.tolist()}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for keep in simhash._kept_blocks(differ):
        for a, b in zip(*(x.tolist() for x in simhash.key_links(codes, keep, differ))):
            parent[find(a)] = find(b)
    for i, j in zip(range(len(codes)), groups):
        assert find(int(codes[i])) == find(int(codes[j]))
    assert len({find(c) for c in codes.tolist()}) == len(set(groups))


@pytest.mark.parametrize("chunk", [7, 200_000])
def test_near_groups(spark, chunk, monkeypatch):
    monkeypatch.setattr(simhash, "CHUNK", chunk)
    texts = near_copies()
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    codes = np.array([brute_fingerprint(t) for t in texts], np.uint64)
    want = brute_groups(codes, 2)
    assert len(set(want)) < len(set(codes.tolist()))  # some links are between different fingerprints
    got = {r.id: (r.fp % 2**64, r.component) for r in simhash.near_groups(df).collect()}
    assert got == {i: (int(c), w) for i, (c, w) in enumerate(zip(codes, want))}
    assert sorted(r.doc_id for r in simhash.drop_near_copies(df).collect()) == sorted(set(want))


def test_near_groups_of_odd_documents(odd_docs, no_docs):
    got = simhash.near_groups(odd_docs).collect()
    assert len(got) == odd_docs.count()
    assert {r.component for r in got if r.fp == 0} == {3}  # no words: null, empty and blank texts
    assert simhash.near_groups(no_docs).collect() == []
    left = simhash.drop_near_copies(odd_docs)
    assert left.columns == odd_docs.columns
    assert {r.doc_id for r in left.collect()} >= {1, 3, 5, None}
    assert simhash.drop_near_copies(no_docs).count() == 0


def test_components(spark):
    rng = random.Random(9)
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, rng.randrange(200, 400)) for _ in range(300)]  # a path and a hub
    edges += [(rng.randrange(1000, 1100), rng.randrange(1000, 1100)) for _ in range(60)] + [(5, 5)]
    parent = {n: n for e in edges for n in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {n: find(n) for n in parent if find(n) != n}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


# ---- substring


def brute_removed(rows, span):
    """Sentences that stay, per row, by comparing the words of all runs."""
    seen, out = set(), {}
    runs = []
    for i, text in rows:
        parts = [text[a:b].split() for a, b in substring.sentences(text)]
        n = len(parts)
        found = set()
        for start in range(n):
            for step, place in ((1, start), (-1, start)):
                got, words, at = 0, 0, place
                while 0 <= at < n:
                    got, words = got + 1, words + len(parts[at])
                    if (got >= span.sentences and words >= span.words) or words >= span.many:
                        found.add((min(place, at), max(place, at)))
                        break
                    at += step
        runs += [(tuple(map(tuple, parts[a : b + 1])), i, a, b) for a, b in found]
        out[i] = [True] * n
    for key, i, a, b in sorted(runs, key=lambda r: r[1:]):
        if key in seen:
            out[i][a : b + 1] = [False] * (b - a + 1)
        seen.add(key)
    return out


def test_substring_dedup(spark):
    rng = random.Random(11)
    passages = [prose(rng, 70) for _ in range(5)]
    rows = []
    for i in range(60):
        parts = [prose(rng, rng.randrange(5, 200)) for _ in range(rng.randrange(1, 4))]
        if rng.random() < 0.6:
            parts.insert(rng.randrange(len(parts) + 1), rng.choice(passages))
        rows.append((i, ("\n" if rng.random() < 0.5 else " ").join(parts)))
    rows += [(60, rows[3][1]), (61, "Short copy."), (62, "Short copy."), (63, "a b c. " * 60)]
    span = substring.Span()
    want = brute_removed(rows, span)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    out, removed, total = substring.remove_repeats(df)
    got = {r["doc_id"]: r for r in out.collect()}
    for i, text in rows:
        kept = [text[a:b] for (a, b), stay in zip(substring.sentences(text), want[i]) if stay]
        assert got[i]["text"].split() == " ".join(kept).split(), i  # what is left of an overlong sentence may be one sentence
        assert (got[i][removed], got[i][total]) == (want[i].count(False), len(want[i]))
        if all(want[i]):
            assert got[i]["text"] == text
    assert sum(v.count(False) for v in want.values()) > 100
    for passage in passages:  # long passages are left once at most
        assert sum(passage in r["text"] for r in got.values()) <= 1


def test_passages_that_begin_and_end_inside_sentences(spark):
    """Passages of some 55 words in sentences of 11, whose first and last sentence run into what is around them."""
    rng = random.Random(21)

    def line(n):
        return " ".join(f"u{rng.randrange(10**6)}" for _ in range(n))

    rows, passages = [], []
    for k in range(30):
        passage = ". ".join(line(11) for _ in range(5)) if k % 2 else ", ".join(line(8) for _ in range(7))
        passages.append(passage)
        for side in range(2):
            rows.append((2 * k + side, f"{line(40)}. {line(3 + 4 * side)} {passage} {line(5 - side)}. {line(30)}."))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    left = {r.doc_id: r.text for r in substring.drop_repeats(df).collect()}
    for k, passage in enumerate(passages):
        assert passage in left[2 * k] == rows[2 * k][1]  # the first occurrence stays
        words, rest = passage.replace(",", "").replace(".", "").split(), left[2 * k + 1]
        assert sum(w in rest for w in words) <= 25 and rest.startswith(rows[2 * k + 1][1][:100])


def test_substring_of_odd_documents(odd_docs, no_docs):
    left = substring.drop_repeats(odd_docs)
    assert left.columns == odd_docs.columns
    before, after = (sorted(map(str, df.collect())) for df in (odd_docs, left))
    assert before == after  # no run is long enough, or it occurs once
    assert substring.drop_repeats(no_docs).count() == 0


def test_texts_under_one_id_are_told_apart(spark):
    rng = random.Random(2)
    a, b = prose(rng, 90), prose(rng, 90)
    rows = [(1, a, 1), (1, b, 1), (2, b + "\n" + prose(rng, 60), 0), (2, "Other text.", 0), (3, a, 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_chars long")
    got = sorted(map(tuple, substring.drop_repeats(df).collect()))
    assert (1, a, 1) in got and (1, b, 1) in got and (2, "Other text.", 0) in got and (3, "", 0) in got
    changed = next(r for r in got if r[0] == 2 and r[1] != "Other text.")
    assert b not in changed[1] and changed[2] == len(changed[1])


def test_sentences():
    for text in ["", " ", "a", " a. b! c?\n\nd ", "x.y z.  w", "\n\n.", "a\r\nb"]:
        found = substring.sentences(text)
        assert "".join(text[a:b] for a, b in found).split() == text.split() or "".join(
            "".join(text[a:b].split()) for a, b in found
        ) == "".join(text.split())
        assert all(text[a:b] == text[a:b].strip() and a < b for a, b in found)


# ---- near copies by whole shingle sets


def brute_shingles(text):
    words = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def brute_kept(rows):
    """Of (id, text) in order: those without a near copy before them that stays."""
    kept = []
    for i, text in rows:
        found = brute_shingles(text)
        if not any(5 * len(found & k) >= 4 * len(found | k) for _, k in kept):
            kept.append((i, found))
    return [i for i, _ in kept]


def edited_copies(seed=5):
    """Texts with up to a tenth of the words changed, each from the base or from the copy before it, and a common line."""
    rng = random.Random(seed)
    texts = []
    for _ in range(25):
        words = prose(rng, rng.randrange(20, 400)).split(" ")
        for _ in range(rng.randrange(1, 8)):
            changed = list(words)
            for _ in range(rng.randrange(0, 2 + len(words) // 30)):
                changed[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
            texts.append(" ".join(changed) + " and this line is in very many of the texts" * rng.randrange(2))
            words = changed if rng.random() < 0.5 else words
    rng.shuffle(texts)
    return texts + ["", None, "One", "one", "a b c d e", "A b\tc d e", *texts[:3]]


@pytest.mark.parametrize("rounds, share, whole", [(2, 1, 200_000), (0, 16, 200_000), (1, 4, 1)])
def test_near_copies_by_shingles(spark, rounds, share, whole, monkeypatch):
    monkeypatch.setattr(jaccard, "ROUNDS", rounds)
    monkeypatch.setattr(jaccard, "SHARE", share)
    monkeypatch.setattr(jaccard, "WHOLE", whole)
    rows = list(enumerate(edited_copies()))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    want = brute_kept(rows)
    assert sorted(r.doc_id for r in jaccard.drop_near_copies(df).collect()) == want
    fingerprints = simhash.drop_near_copies(df)
    assert len(want) < fingerprints.count() and len(want) > 25  # two bits are too few for such copies


def test_a_long_chain_of_versions(spark, monkeypatch):
    """Each version edited from the last: the rounds grow with the logarithm of the chain, and so do the tables."""
    words, rows = prose(random.Random(9), 200).split(" "), []
    for i in range(60):
        words = [*words[: 3 * i], f"edit{i}", *words[3 * i + 1 :]]
        rows.append((i, " ".join(words)))
    tables, store = [], jaccard.written
    monkeypatch.setattr(jaccard, "written", lambda df, label: tables.append(label) or store(df, label))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert sorted(r.doc_id for r in jaccard.drop_near_copies(df).collect()) == brute_kept(rows)
    assert len(tables) < 50


def test_a_line_in_many_texts_makes_no_pairs(spark, monkeypatch):
    """Texts that share half of their words and no copies: a line like that is common in the sample, so none meet by it."""
    rng = random.Random(8)
    line = " ".join(f"licence{k}" for k in range(60))
    rows = [(i, line + " " + " ".join(f"own{rng.randrange(10**9)}" for _ in range(60))) for i in range(400)]
    seen, store = [], jaccard.written

    def count(df, label):
        out = store(df, label)
        if label in ("pairs", "met"):
            seen.append(out.count())
        return out

    monkeypatch.setattr(jaccard, "written", count)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert jaccard.drop_near_copies(df).count() == len(rows)
    assert sum(seen) < 10 * len(rows)


def test_groups_find_close_copies(spark):
    """What the SimHash index alone brings together: the closest of the pairs alike by whole sets."""
    rows = [(i, t) for i, t in enumerate(edited_copies()) if t]
    df = spark.createDataFrame(rows, "id long, text string").withColumn("version", F.xxhash64("text"))
    grouped = jaccard._grouped(jaccard._first(df)).collect()
    group = {r.node.id: r.key for r in grouped}
    sets = [(i, brute_shingles(t)) for i, t in rows]
    prints = {r.node.id: jaccard.fingerprint(jaccard.shingles(r.text)) for r in df.selectExpr("*", "struct(id) node").collect()}
    alike = [(i, j) for i, a in sets for j, b in sets if i < j and 5 * len(a & b) >= 4 * len(a | b)]
    close = [(i, j) for i, j in alike if ((prints[i] ^ prints[j]) & (2**64 - 1)).bit_count() <= jaccard.DIFFER]
    assert 0 < len(close) < len(alike)  # copies further apart are left to the shingles
    assert all(i in group and group[i] == group[j] for i, j in close)


def test_groups_settle_what_is_not_searched_again(spark, monkeypatch):
    """A copy in the SimHash group of a text that stays goes by that alone: without the groups the shingles have more left to do."""
    rows = list(enumerate(edited_copies()))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    searched, found, store, grouped = [], [], jaccard.written, jaccard._grouped

    def count(df, label):
        out = store(df, label)
        if label == "rest" and not found:
            found.append({r.node.id for r in out.select("node").distinct().collect()})
        return out

    monkeypatch.setattr(jaccard, "written", count)
    for groups in (grouped, lambda own: grouped(own).limit(0)):
        monkeypatch.setattr(jaccard, "_grouped", groups)
        assert sorted(r.doc_id for r in jaccard.drop_near_copies(df).collect()) == brute_kept(rows)
        searched.append(found.pop())
    settled = searched[1] - searched[0]
    assert settled and searched[0] < searched[1] and not settled & set(brute_kept(rows))


def test_a_crowd_of_texts_makes_few_pairs(spark, monkeypatch):
    """Edited copies of one text, most of them too far apart: tasks part them by their sketches, whatever the blocks."""
    rng = random.Random(13)
    base, rows = prose(rng, 200).split(" "), []
    for i in range(240):
        words = list(base)
        for k in rng.sample(range(200), rng.choice([1, 4, 4, 4])):
            words[k] = f"new{rng.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    seen, store = [], jaccard.written
    monkeypatch.setattr(jaccard, "written", lambda df, label: (label == "pairs" and seen.append(df.count())) or store(df, label))
    monkeypatch.setattr(jaccard, "FEW", 8)
    monkeypatch.setattr(jaccard, "HELD", 100)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    for block in (1024, 32):
        monkeypatch.setattr(jaccard, "BLOCK", block)
        monkeypatch.setattr(jaccard, "ROUNDS", 0)
        seen.clear()
        assert sorted(r.doc_id for r in jaccard.drop_near_copies(df).collect()) == brute_kept(rows)
        assert sum(seen) < 240 * 239 / 2 / 2


def test_pairs_of_a_crowd_are_told_once_and_families_settled_first(spark, monkeypatch):
    """Copies that share most of their shingles meet at each of them; they give a pair once, and few pairs for a family."""
    rng = random.Random(17)
    bases, rows = [prose(rng, 200).split(" ") for _ in range(3)], []
    for i in range(150):
        words = list(bases[i % 3])
        words[rng.randrange(200)] = f"new{rng.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    seen, crowded = [], jaccard._crowded

    def counted(*args, **more):
        found = crowded(*args, **more)
        seen.append((found.count(), found.distinct().count()))
        return found

    monkeypatch.setattr(jaccard, "FEW", 8)
    monkeypatch.setattr(jaccard, "ROUNDS", 0)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    source = df.selectExpr("doc_id AS id", "text", "xxhash64(text) AS version")
    own = jaccard._first(source)
    sketches = own.filter("at = 0").select("node", "sketch")
    for block in (1024, 16):
        monkeypatch.setattr(jaccard, "BLOCK", block)
        monkeypatch.setattr(jaccard, "_crowded", crowded)
        crowd = jaccard._met(own).drop("fp", "sketch").withColumn("parts", F.lit(-(-50 // block)))
        pairs = crowded(crowd, sketches)
        assert pairs.count() == pairs.distinct().count() == 3 * 50 * 49 / 2
        monkeypatch.setattr(jaccard, "_crowded", counted)
        seen.clear()
        out, left = jaccard._paired(jaccard._met(own), sketches, source)
        assert out.count() == 147 and left.count() == 0
        assert [n for n, _ in seen][1:] == [0] and seen[0][1] <= 147 * -(-50 // block) * 2
    assert sorted(r.doc_id for r in jaccard.drop_near_copies(df).collect()) == brute_kept(rows) == [0, 1, 2]


def test_sketches_never_part_like_sets():
    rng = np.random.default_rng(3)
    for n in (1, 30, 200, 1500, 6000):
        for part in (0.0, 0.05, 0.12, 0.3):
            a = np.unique(rng.integers(-(2**63), 2**63 - 1, n))
            b = np.unique(np.concatenate([a[int(part * n) :], rng.integers(-(2**63), 2**63 - 1, int(part * n * 1.1))]))
            apart, sizes = len(np.setxor1d(a, b)), np.array([len(a), len(b)])
            alike = 9 * (sizes.sum() - apart) >= 8 * sizes.sum()
            maybe = jaccard._may_be_alike(
                sizes, np.zeros(2, np.int64), [jaccard.sketch(a), jaccard.sketch(b)], np.array([0]), np.array([1])
            )
            assert maybe[0] or not alike


def test_drop_copies_shuffles_few_texts(spark):
    """Texts without a copy need no shuffle: both joins of the stages read only rows that may match."""
    rows = [(i, f"text number {i} " * 40) for i in range(400)] + [(1000 + i, f"text number {i} " * 40) for i in range(5)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    kept = exact.drop_copies(df)
    assert sorted(r.doc_id for r in kept.collect()) == [i for i in range(5, 400)] + [1000 + i for i in range(5)]
    found, _ = parted(df, F.xxhash64("text"), df.filter("doc_id >= 1000").select(F.xxhash64("text").alias("fp")))
    assert {r.doc_id for r in found.collect()} >= {*range(5), *range(1000, 1005)} and found.count() < 40


def test_near_copies_of_odd_documents(odd_docs, no_docs):
    left = jaccard.drop_near_copies(odd_docs)
    assert left.columns == odd_docs.columns
    kept = sorted((r.doc_id or 0, r.text or "") for r in left.collect())
    # Of an id with two texts both stay; repeated rows stay or go together.
    assert [i for i, _ in kept] == [0, 0, 1, 1, 3, 5, 7, 8, 8, 9]
    assert jaccard.drop_near_copies(no_docs).count() == 0


def test_pipeline_drops_edited_copies(spark):
    base = prose(random.Random(6), 300).split(" ")
    copy = [*base[:150], "changed", *base[151:]]
    for k in range(20, 280, 60):
        copy[k] = f"other{k}"
    rows = [(1, " ".join(base)), (2, " ".join(copy))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    stage = dict(corpus_pipeline.STAGES)["simhash_near_dedup"]
    assert [r.doc_id for r in stage(spark, df, "").collect()] == [1]
