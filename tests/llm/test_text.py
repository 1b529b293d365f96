"""HTML extraction and I-Match fingerprints."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
import regex
import xxhash
from pyspark.sql import functions as F

from tidemark.llm import html_text, imatch

ARTICLE = """<!DOCTYPE html><html><head><title>T</title><script>if (a<b) { "</p>" }</script><style>p {}</style></head><body>
<header><h1>Site name</h1><a href="/">home</a></header><nav><ul><li><a href=1>One</a></li><li><a href=2>Two</a></ul></nav>
<div class="cookie-notice">We use cookies, and this long notice asks you to accept all of them, please do that now.</div>
<div id=main><article><h2>Title &amp; more</h2><p>First   paragraph with <a href=x>a&nbsp;link</a> and<br>enough of text.
<p>Second <b>one</b>, longer, has several words, commas and so on; it is the largest block here &lt;surely&gt;.</p>
<aside>Related: x</aside><ul><li>item one<li>item two</ul><form><input><button>Send</button></form></article>
<div class="comments"><p>Reader: what an article, I have read all of it, and must say much about my life, at length.</p></div>
</div><aside>Side</aside><footer>&copy; 2020 A footer with many words in it, as footers often have them</footer></body></html>"""


def test_main_text():
    assert html_text.main_text(ARTICLE).split("\n") == [
        "Title & more",
        "First paragraph with a link and enough of text.",
        "Second one, longer, has several words, commas and so on; it is the largest block here <surely>.",
        "item one",
        "item two",
    ]


@pytest.mark.parametrize(
    ("source", "text"),
    [
        ("", ""),
        ("plain text only", "plain text only"),
        ("<p>a<p>b<div>c</div>", "a\nb\nc"),
        ("<nav>menu</nav>", ""),
        ("<body><!-- open comment", ""),
        ("<article><p>cut off &am", "cut off &am"),
        ("<article><p>one</p><script>never ends", "one"),
        ("<p>x &#233;&eacute;&#x1F600; y</p></div></p>", "x éé😀 y"),
        ("<div hidden>no</div><div><p>yes, this is it</p></div>", "yes, this is it"),
        ("<div>" * 5000 + "deep" + "</div>" * 5000, "deep"),
        ("<" * 2000, "<" * 2000),
        ("<article><p>a &<b>lt;</b> b &am<i>p;</i></p></article>", "a &lt; b &amp;"),
        ("<p>&lt;p&gt; is &amp;lt; here</p>", "<p> is &lt; here"),
    ],
)
def test_odd_pages(source, text):
    assert html_text.main_text(source) == text


@pytest.mark.parametrize("name", ["related-work", "search-strategy", "share-price", "alert_levels", "hidden-costs"])
@pytest.mark.parametrize("tag", ["p", "h2", "blockquote"])
def test_marks_on_paragraphs_of_an_article(name, tag):
    text = "A paragraph of the article, about work that is related to it."
    page = f"<body><article><p>First of all, some words.</p><{tag} class='big {name}'>{text}</{tag}><p>Last words.</p></article></body>"
    assert text in html_text.main_text(page)
    for whole in ("ad", "x advertisement", "newsletter"):
        assert text not in html_text.main_text(page.replace(f"big {name}", whole))
    outside = f"<body><article><p>{text}</p></article><div class='{name}'><p>More of that elsewhere on the site.</p></div></body>"
    assert html_text.main_text(outside) == text
    box = f"<body><article><p>{text}</p><div class='{name}'><p>In a box beside it.</p></div></article></body>"
    assert html_text.main_text(box) == text


def brute_density(node, page):
    """Characters, tags, link characters, link tags and density of a node and all below, by recursion over the definition."""
    kids = [c for c in node.children if not isinstance(c, str) and not c.skip]
    below = [brute_density(k, page) for k in kids]
    chars = sum(len(re.sub(r"\s", "", c)) for c in node.children if isinstance(c, str)) + sum(b[0] for b in below)
    tags = sum(b[1] + (k.tag not in html_text.INLINE) for b, k in zip(below, kids))
    links = (chars, tags + 1) if node.tag == "a" else (sum(b[2] for b in below), sum(b[3] for b in below))
    density = 0.0
    if chars:
        share = page[0] / max(1, page[1])
        base = math.log(chars / max(1, chars - links[0]) * max(1, links[0]) + share * chars + math.e)
        ratio = max(1.0, chars / max(1, links[0]) * max(1, tags) / max(1, links[1]))
        density = chars / max(1, tags) * math.log(ratio + 1) / math.log(base + 1)
    assert (node.chars, node.tags, node.link_chars, node.link_tags) == (chars, tags, *links)
    assert node.density == pytest.approx(density)
    own = sum(len(re.sub(r"\s", "", c)) for c in node.children if isinstance(c, str))
    assert node.total == pytest.approx(sum(b[4] for b in below) + (own / chars * max(1, tags) * density if own else 0))
    return chars, tags, *links, density


def test_densities_by_recursion():
    rng = random.Random(3)

    def some(depth):
        if depth == 0 or rng.random() < 0.3:
            return " ".join("w" * rng.randrange(1, 9) for _ in range(rng.randrange(6))) + " &amp; "
        tag = rng.choice(["div", "div", "p", "a", "b", "section", "nav"])
        return f"<{tag}>" + "".join(some(depth - 1) for _ in range(rng.randrange(5))) + f"</{tag}>"

    for _ in range(200):
        root = html_text.parse("<body>" + "".join(some(5) for _ in range(4)) + "</body>")
        html_text.measure(root)
        brute_density(root, (root.link_chars, root.chars))
        nodes = [n for n in html_text._order(root) if n.chars]
        chosen = html_text.main_nodes(root)
        body = next((n for n in html_text._order(root) if n.tag == "body"), root)
        best = max((n.total for n in html_text._order(body)), default=0.0)
        assert not nodes or any(n.total == best or _above(n, best) for n in chosen)


def _above(node, best):
    return any(n.total == best for n in html_text._order(node))


def test_long_page_is_whole():
    paragraphs = [f"Paragraph {i} with some words, and more." for i in range(20_000)]
    source = "<body><nav>x</nav><article>" + "".join(f"<p>{p}</p>" for p in paragraphs) + "</article></body>"
    assert html_text.main_text(source) == "\n".join(paragraphs)


def test_extract(spark):
    rows = [(1, "u", ARTICLE, 1), (2, None, None, 2), (None, "v", "<p>x", 3), (1, "u", ARTICLE, 1), (4, "w", "", 4)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    got = html_text.extract(df).collect()
    want = [(i, u, html_text.main_text(h or "")) for i, u, h, _ in rows]
    assert sorted(map(str, map(tuple, got))) == sorted(str((i, u, t, len(t))) for i, u, t in want)
    assert html_text.extract(df.filter("false")).collect() == []


# ---- I-Match


def topic(i, words=120):
    return " ".join(f"t{(i * 7919 + k * k * 31 + k) % 997}" for k in range(words)) + f" own{i}."


def edited_by_hand(rows):
    rows = sorted(rows)
    out = {}
    for (i, text), (_, after) in zip(rows, rows[1:] + rows[:1]):
        k = len(text) // 4
        out[i] = text[: len(text) - k] + after[:k]
    return out


def test_edited_fingerprints(spark):
    rows = [(i * 3 - 50, topic(i)) for i in range(150)] + [(1000, topic(3)), (1001, topic(3)), (1002, "é😀" * 9), (1003, "ab")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    got = {r.doc_id: r for r in imatch.edited_fingerprints(df).collect()}
    assert len(got) == len(rows)
    want = edited_by_hand(rows)
    prints = {}
    for i, text in rows:
        r = got[i]
        assert r.n_chars == len(text)
        assert r.edited_sha256 == hashlib.sha256(want[i].encode()).hexdigest()
        assert prints.setdefault(text, r.fingerprint) == r.fingerprint
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    assert got[1000].near_next == 1.0
    plain = [got[i] for i, _ in rows[:150]]
    assert sum(r.near_edited > r.near_next for r in plain) > 0.9 * len(plain)


def test_no_python_in_the_plan(spark):
    df = spark.createDataFrame([(i, topic(i)) for i in range(5)], "doc_id long, text string")
    plan = imatch.edited_fingerprints(df)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_odd_documents(odd_docs, no_docs):
    got = imatch.edited_fingerprints(odd_docs).collect()
    rows = [(r.doc_id, len(r.text or "")) for r in odd_docs.collect()]
    assert sorted(map(str, ((r.doc_id, r.n_chars) for r in got))) == sorted(map(str, rows))
    same = {(r.doc_id, r.n_chars): r.fingerprint for r in got}
    assert same[1, 9] == same[2, 9] == same[None, 9] and same[3, 0] == same[4, 0]
    assert imatch.edited_fingerprints(no_docs).collect() == []


def test_single_document(spark):
    row = imatch.edited_fingerprints(spark.createDataFrame([(1, "abcdefgh")], "doc_id long, text string")).collect()[0]
    assert row.edited_sha256 == hashlib.sha256(b"abcdefab").hexdigest() and row.near_next == 1.0


# ---- I-Match by hand


def signed(n):
    return n - (1 << 64) if n >> 63 else n


def spark_hash(*values):
    """Spark's xxhash64 of strings, longs and (as 4 bytes) the seed of the subsets, each with the hash before as its seed."""
    h = 42
    for v in values:
        data = v.encode() if isinstance(v, str) else v.to_bytes(4 if v == imatch.SEED else 8, "little", signed=True)
        h = xxhash.xxh64_intdigest(data, h)
    return signed(h)


def hand_terms(text):
    return {w for w in regex.split("[^\\p{L}\\p{N}]+", text.lower()) if w}


def hand_print(text, lexicon):
    """(level, low, high) of a text, or its hash."""
    terms = {spark_hash(w) for w in hand_terms(text)}
    terms = sorted(terms & lexicon or terms)
    if not terms:
        return spark_hash(text)
    level = max(0, math.floor(math.log2(len(terms) / imatch.PER_SUBSET)))

    def subsets(k):
        out = []
        for i in range(imatch.SUBSETS):
            own = [t for t in terms if (spark_hash(t, imatch.SEED) >> 20) & ((1 << k) - 1) == i]
            out.append(spark_hash(*[v for t in own for v in (i, t)]) & 0xFFFF if own else -1)  # numbers of subsets go along
        return out

    return level, subsets(level), subsets(level + 1)


def hand_likeness(a, b, equal):
    if equal:
        return 1.0
    if isinstance(a, int) or isinstance(b, int) or abs(a[0] - b[0]) > 1:
        return 0.0
    level = max(a[0], b[0])
    pairs = [(x, y) for x, y in zip(*(p[1] if p[0] == level else p[2] for p in (a, b))) if x >= 0 or y >= 0]
    return sum(x == y for x, y in pairs) / len(pairs) if pairs else 0.0


def hand_shown(p):
    if isinstance(p, int):
        return "x" + f"{p & (1 << 64) - 1:x}"
    return "/".join([str(p[0]), *["".join("----" if h < 0 else f"{h:04x}" for h in part) for part in p[1:]]])


def test_fingerprints_by_hand(spark):
    rng = random.Random(9)
    vocabulary = [f"wort{k}é" for k in range(60)] + [f"rare{k}" for k in range(400)]
    texts = [" ".join(rng.choice(vocabulary[: rng.choice([20, 60, 460])]) for _ in range(rng.randrange(60))) for _ in range(70)]
    texts += [texts[3]] * 60 + ["", "?!", "only these words here"]  # one text nearly half of the rows
    rows = list(enumerate(texts)) + [(5, texts[5])] * 40  # and one row again and again
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    distinct = set(texts)
    counts = Counter(w for t in distinct for w in hand_terms(t))
    low, high = len(distinct) * imatch.LEAST_SHARE, max(1.0, len(distinct) * imatch.MOST_SHARE)
    lexicon = {spark_hash(w) for w, n in counts.items() if low <= n <= high}
    want, edited = {}, edited_by_hand(list(enumerate(texts)))
    for i, text in enumerate(texts):
        after = texts[(i + 1) % len(texts)]
        own, new, following = (hand_print(t, lexicon) for t in (text, edited[i], after))
        want[i] = (hand_shown(own), hand_shown(new), hand_likeness(own, new, text == edited[i]), hand_likeness(own, following, text == after))
    got = imatch.edited_fingerprints(df).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.fingerprint, r.edited_fingerprint, r.near_edited, r.near_next) == want[r.doc_id], r.doc_id


def test_repeated_rows_leave_fingerprints_as_they_are(spark):
    texts = [topic(i) for i in range(40)]
    once = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    twice = once.unionByName(once).unionByName(spark.createDataFrame([(1000 + i, texts[0]) for i in range(60)], once.schema))
    prints = [{r.doc_id: r.fingerprint for r in imatch.edited_fingerprints(df).collect()} for df in (once, twice)]
    assert all(prints[1][i] == prints[0][i] for i in prints[0]) and prints[1][1000] == prints[0][0]
    copies = [r for r in imatch.edited_fingerprints(twice).collect() if r.doc_id >= 1000]
    assert all(r.near_edited > 0.2 for r in copies)  # nor do copies lose the likeness to their edited texts


def test_imatch_reads_few_texts_twice(spark, monkeypatch):
    """All texts are joined with their next one's start once; again only those without a term of the lexicon and the ones after them."""
    rng, rows = np.random.default_rng(17), []
    for i in range(600):
        words = [f"word{k}" for k in rng.integers(0, 300, 60)]
        rows.append((i, " ".join(words) if i % 200 else f"alone{i} single{i} other{i}"))
    joined, edited = [], imatch._edited
    monkeypatch.setattr(imatch, "_edited", lambda keyed, order: joined.append(keyed.count()) or edited(keyed, order))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: r for r in imatch.edited_fingerprints(df).collect()}
    assert len(got) == 600 and joined[0] == 600 and 3 <= joined[1] < 60
    assert all(got[i].fingerprint[0] != "x" and got[i].n_chars == len(text) for i, text in rows)


def test_imatch_filter_holds_all_its_keys(spark):
    keys = [0, 1, -1, 2**63 - 1, -(2**63), *range(10**12, 10**12 + 200)]
    df = spark.createDataFrame([(k,) for k in keys], "key long").select(F.xxhash64("key").alias("key"))
    held = imatch._holds(df)
    assert df.filter(held(F.col("key"))).count() == len(keys)
    assert spark.range(10_000).filter(held(F.xxhash64("id", F.lit(1)))).count() < 2_000
