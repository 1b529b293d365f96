"""I-Match document fingerprints in DataFrame operations only (operator 9).

The lexicon holds the terms whose inverse document frequency lies in a band. It is cut at
random into 2^k subsets by the bits of a term's hash, finer for texts with more terms, so
that about ``PER_SUBSET`` of a text's terms fall into each. A text's fingerprint holds, for
the first ``SUBSETS`` of them, a hash of its sorted distinct terms in that subset, for its
own k and for k+1. Fingerprints of texts of similar size share a k; their likeness is the
share of subsets with equal hashes.

Frequencies count distinct texts, so copies of one text don't push its terms out of the band.
A text without a term of the lexicon is fingerprinted by all its terms.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import column, identified, written

#: Shares of the documents that a term of the lexicon is found in, at least and at most. The lexicon
#: then has at most (mean number of distinct terms of a document) / LEAST_SHARE terms, however many documents.
LEAST_SHARE, MOST_SHARE = 1 / 500, 0.25
SUBSETS, PER_SUBSET = 24, 0.8
#: Bits kept of a subset's hash.
HASH_BITS = 16
SEED = 20_261
#: Bits of a filter: as many times the number of keys in it, but no more than 2 to the largest.
FACTOR, MOST = 16, 24

_NOT_TERM = "[^\\p{L}\\p{N}]+"


def _terms(text: Column) -> Column:
    return F.split(F.lower(text), _NOT_TERM)


def _holds(keys: DataFrame) -> Callable[[Column], Column]:
    """Whether a long may be in the column ``key``: a filter of bounded size, which every task gets as an array of words."""
    size = min(max(6, (FACTOR * max(keys.count(), 1) - 1).bit_length()), MOST)
    at = lambda key: F.shiftrightunsigned(key, 64 - size)
    word = lambda key: F.shiftrightunsigned(at(key), 6)
    place = lambda key: at(key).bitwiseAND(63).cast("int")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), place(F.col("key")))
    words = keys.select(word(F.col("key")).alias("id"), bit.alias("bit")).groupBy("id").agg(F.bit_or("bit").alias("bits"))
    every = keys.sparkSession.range(1 << (size - 6)).join(words, "id", "left")
    line = F.array_sort(F.collect_list(F.struct("id", F.coalesce("bits", F.lit(0).cast("long")).alias("bits"))))
    bits = written(every.agg(line.alias("line")).select(F.col("line.bits").alias("bits")), "bits")
    return lambda key: F.call_function("shiftright", F.get(bits.scalar(), word(key).cast("int")), place(key)).bitwiseAND(1) == 1


def _once(keyed: DataFrame) -> tuple[DataFrame, int]:
    """One row of each distinct text (columns i, h, text), and their number.

    Only the narrow keys are shuffled to find the first document of each text; rows of the
    others are left out by an anti join, and a first one that has several rows is brought back
    once. A bit filter keeps the other texts out of the joins.
    """
    docs = keyed.groupBy("i", "h").agg(F.count(F.lit(1)).alias("rows"))
    first = docs.groupBy("h").agg(F.min("i").alias("first"))
    spare = docs.join(first, "h").filter((F.col("i") != F.col("first")) | (F.col("rows") > 1))
    spare = written(spare.select("i", "h", (F.col("i") == F.col("first")).alias("own")), "spare")
    documents = first.count()
    texts = keyed.select("i", "h", "text")
    key = F.xxhash64("i", "h")
    maybe = _holds(spare.select(key.alias("key")))(key)
    some = texts.filter(maybe)
    again = some.join(spare.filter("own").select("i", "h"), ["i", "h"], "left_semi").dropDuplicates(["i", "h"])
    rest = some.join(spare.select("i", "h"), ["i", "h"], "left_anti")
    return texts.filter(~maybe).unionByName(rest).unionByName(again), documents


def lexicon(keyed: DataFrame) -> DataFrame:
    """Hashes (column ``term``) of the terms in the band, from all distinct texts of (i, h, text), stored."""
    texts, documents = _once(keyed)
    terms = texts.select(F.explode(F.array_distinct(_terms(F.col("text")))).alias("word")).filter("word != ''")
    counts = terms.select(F.xxhash64("word").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    band = F.col("n").between(documents * LEAST_SHARE, max(1.0, documents * MOST_SHARE))
    return written(counts.filter(band).select("term"), "lexicon")


def _subset_hashes(terms: Column, level: Column) -> Column:
    """For each of the first SUBSETS subsets of 2^level, a hash of the sorted terms in it; -1 where there are none."""
    mask = F.call_function("shiftleft", F.lit(1).cast("long"), level) - 1
    subset = lambda t: F.shiftright(F.xxhash64(t, F.lit(SEED)), 20).bitwiseAND(mask)
    first = F.filter(F.transform(terms, lambda t: F.struct(subset(t).alias("s"), t.alias("t"))), lambda x: x["s"] < SUBSETS)

    def hashed(own: Column) -> Column:
        return F.when(F.size(own) > 0, F.xxhash64(own).bitwiseAND((1 << HASH_BITS) - 1)).otherwise(F.lit(-1)).cast("int")

    def listed(some: Column) -> Column:
        each = F.transform(F.array(*[F.lit(i) for i in range(SUBSETS)]), lambda i: F.filter(some, lambda x: x["s"] == i))
        return F.transform(each, hashed)

    # As the only item of an array the terms of these subsets are found once, not again for each subset.
    return F.transform(F.array(first), listed)[0]


def _level(terms: Column) -> Column:
    return F.greatest(F.lit(0), F.floor(F.log2(F.size(terms) / PER_SUBSET))).cast("int")


def _by_all_terms(text: Column) -> Column:
    """The fingerprint (a struct) of a text by all its terms; null if it has none."""
    words = F.filter(F.array_distinct(_terms(text)), lambda w: w != "")
    # As the only item of an array the terms are found once.
    made = F.transform(
        F.array(F.sort_array(F.transform(words, lambda w: F.xxhash64(w)))),
        lambda t: F.struct(
            _level(t).alias("level"), _subset_hashes(t, _level(t)).alias("low"), _subset_hashes(t, _level(t) + 1).alias("high")
        ),
    )
    return F.when(F.size(words) > 0, made[0])


def fingerprints(texts: DataFrame, keys: list[str], terms: DataFrame) -> DataFrame:
    """The keys, ``text_h`` and ``sha256`` of the text, ``level`` and ``low`` and ``high`` (subset hashes at the level and one above).

    ``texts`` has the keys and ``text``; without a term of the lexicon the last three are null. If it is partitioned
    by the keys already, nothing is shuffled. A list is gathered per text, no longer than the text.
    """
    # The empty word is no term; it stands first once, whatever the text, and carries what is known of the text.
    none = F.xxhash64(F.lit(""))
    known = F.struct(F.xxhash64("text").alias("text_h"), F.sha2("text", 256).alias("sha256")).alias("known")
    words = texts.select(*keys, "text", known)
    words = words.select(*keys, "known", F.explode(F.array_union(F.array(F.lit("")), _terms(F.col("text")))).alias("word"))
    rows = words.select(*keys, F.xxhash64("word").alias("term"), F.when(F.col("word") == "", F.col("known")).alias("known"))
    wanted = terms.unionByName(terms.sparkSession.range(1).select(none.alias("term")))
    own = F.sort_array(F.collect_set(F.when(F.col("term") != none, F.col("term")))).alias("terms")
    sets = rows.join(F.broadcast(wanted), "term").groupBy(*keys).agg(F.max("known").alias("known"), own)
    sets = sets.withColumn("level", F.when(F.size("terms") > 0, _level(F.col("terms"))))
    hashes = lambda level: F.when(F.col("level").isNotNull(), _subset_hashes(F.col("terms"), level))
    return sets.select(
        *keys, "known.text_h", "known.sha256", "level", hashes(F.col("level")).alias("low"), hashes(F.col("level") + 1).alias("high")
    )


def shown(level: Column, low: Column, high: Column, text_hash: Column) -> Column:
    """A fingerprint as text: the level and the subset hashes; of a text without terms the hash of the text."""
    digits = HASH_BITS // 4
    one = lambda h: F.when(h < 0, F.lit("-" * digits)).otherwise(F.lpad(F.lower(F.hex(h)), digits, "0"))
    listed = F.concat_ws("", F.transform(low, one)), F.concat_ws("", F.transform(high, one))
    return F.when(level.isNull(), F.concat(F.lit("x"), F.lower(F.hex(text_hash)))).otherwise(
        F.concat_ws("/", level.cast("string"), *listed)
    )


def likeness(a: str, b: str) -> Column:
    """Share of equal subset hashes of the fingerprints in the structs ``a`` and ``b``, of those that aren't empty in both.

    Texts without terms are alike if they are equal; fingerprints without a common level are not.
    """
    get = lambda s, f: F.col(f"{s}.{f}")
    level = F.greatest(get(a, "level"), get(b, "level"))
    at = lambda s: F.when(get(s, "level") == level, get(s, "low")).otherwise(get(s, "high"))
    pairs = F.arrays_zip(at(a).alias("p"), at(b).alias("q"))
    some = F.filter(pairs, lambda x: (x["p"] >= 0) | (x["q"] >= 0))
    same = F.filter(some, lambda x: x["p"] == x["q"])
    share = F.when(F.size(some) > 0, F.size(same) / F.size(some)).otherwise(F.lit(0.0))
    neither = get(a, "level").isNull() & get(b, "level").isNull()
    close = F.abs(get(a, "level") - get(b, "level")) <= 1
    equal = get(a, "h") == get(b, "h")
    return (
        F.when(equal, F.lit(1.0))
        .when(neither | get(a, "level").isNull() | get(b, "level").isNull(), F.lit(0.0))
        .when(close, share)
        .otherwise(F.lit(0.0))
    )


def _order(keyed: DataFrame) -> DataFrame:
    """Every distinct document with the one after it: i, h, n, next_i, next_h. Stored.

    Ids are range partitioned; inside a partition the next row is the next document, and the
    last takes the first of the next partition, from a table of one row a partition.
    """
    own = keyed.groupBy("i", "h").agg(F.min("id").alias("id"), F.min(F.length("text")).alias("n"))
    place = ["id", "i", "h"]
    ranged = written(own.repartitionByRange(*place).withColumn("part", F.spark_partition_id()), "order")
    after = F.lead(F.struct("i", "h")).over(Window.partitionBy("part").orderBy(*place))
    first = F.min_by(F.struct("i", "h"), F.struct(*place)).alias("first")
    parts = ranged.groupBy("part").agg(first)
    line = Window.orderBy("part")  # over one row a partition
    follow = F.coalesce(F.lead("first").over(line), F.first("first").over(line.rowsBetween(Window.unboundedPreceding, 0)))
    parts = parts.select("part", follow.alias("follow"))
    both = ranged.withColumn("after", after).join(F.broadcast(parts), "part")
    both = both.withColumn("after", F.coalesce("after", "follow"))
    return written(both.select("i", "h", "n", F.col("after.i").alias("next_i"), F.col("after.h").alias("next_h")), "next")


def _edited(keyed: DataFrame, order: DataFrame) -> DataFrame:
    """Columns i, h, text and edited of the documents in ``order``, whose texts and next texts are among ``keyed``."""
    texts = keyed.select("i", "h", "text").dropDuplicates(["i", "h"])
    quarter = F.floor(F.col("n") / 4).cast("int")
    # What a document takes from the next one is cut where that one's text is.
    wanted = order.filter(quarter > 0).select(F.col("next_i").alias("i"), F.col("next_h").alias("h"), F.col("i").alias("to_i"), F.col("h").alias("to_h"), quarter.alias("take"))
    starts = texts.join(wanted, ["i", "h"]).select("to_i", "to_h", F.substring("text", F.lit(1), F.col("take")).alias("start"))
    starts = starts.withColumnsRenamed({"to_i": "i", "to_h": "h"})
    n = F.length("text")
    edited = F.concat(F.substring("text", F.lit(1), n - F.floor(n / 4).cast("int")), F.coalesce("start", F.lit("")))
    return texts.join(starts, ["i", "h"], "left").select("i", "h", "text", edited.alias("edited"))


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every document and of its text with the last quarter replaced by the next one's start.

    Columns: id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.
    The next document has the next larger id, after the last one comes the first; documents
    that share an id follow in the order of hashes of their texts, and rows that repeat id and
    text are one document with a row each. A null id comes first, a null text is empty, a
    single document is its own next one. An empty table gives no rows; other columns are not
    read.
    """
    source = identified(docs, id_col, text_col)
    keyed = source.select("id", "text", F.xxhash64("id").alias("i"), F.xxhash64("text").alias("h"))
    order = _order(keyed)
    terms = lexicon(keyed)

    sides = F.explode(
        F.array(F.struct(F.lit(0).alias("side"), "text"), F.struct(F.lit(1).alias("side"), F.col("edited").alias("text")))
    )
    # A text and its edited one are rows of their own; the partitioning by document lasts up to the sets of terms.
    # All that is told of a text is told here, so the texts are shuffled once.
    pieces = _edited(keyed, order).select("i", "h", sides.alias("s")).select("i", "h", "s.side", "s.text")
    print_of = F.struct("level", "low", "high")
    told = fingerprints(pieces, ["i", "h", "side"], terms).withColumn("print", print_of)
    both = [F.max(F.when(F.col("side") == side, F.col("print"))).alias(name) for side, name in enumerate(("own", "new"))]
    edit = F.max(F.when(F.col("side") == 1, F.struct("text_h", "sha256"))).alias("edit")
    prints = written(told.groupBy("i", "h").agg(*both, edit), "prints")
    # Only of texts without a term of the lexicon all terms are taken; only theirs and those after them are read again.
    bare = written(prints.filter("own.level IS NULL OR new.level IS NULL").select("i", "h"), "bare")
    theirs = written(order.join(bare, ["i", "h"]), "theirs")
    key = F.xxhash64("i", "h")
    needed = theirs.select(key.alias("key")).unionByName(theirs.select(F.xxhash64("next_i", "next_h").alias("key")))
    again = _edited(keyed.filter(_holds(needed)(key)), theirs).join(bare, ["i", "h"], "left_semi")
    every = [_by_all_terms(F.col(text)).alias(name) for text, name in (("text", "own_every"), ("edited", "new_every"))]
    every = written(again.select("i", "h", *every), "every")
    found = prints.join(every, ["i", "h"], "left")
    either = lambda name: F.when(F.col(f"{name}.level").isNull(), F.col(f"{name}_every")).otherwise(F.col(name)).alias(name)
    found = written(found.select("i", "h", either("own"), either("new"), "edit"), "found")
    after = found.select(F.col("i").alias("next_i"), F.col("h").alias("next_h"), F.col("own").alias("next"))
    facts = found.join(order, ["i", "h"]).join(after, ["next_i", "next_h"], "left")

    def struct(name: str, text_hash: str) -> Column:
        return F.struct(*[F.col(f"{name}.{c}").alias(c) for c in ("level", "low", "high")], F.col(text_hash).alias("h"))

    facts = facts.withColumns({"a": struct("own", "h"), "b": struct("new", "edit.text_h"), "c": struct("next", "next_h")})
    results = facts.select(
        "i",
        "h",
        F.col("n").cast("long").alias("n_chars"),
        F.col("edit.sha256").alias("edited_sha256"),
        shown(F.col("a.level"), F.col("a.low"), F.col("a.high"), F.col("a.h")).alias("fingerprint"),
        shown(F.col("b.level"), F.col("b.low"), F.col("b.high"), F.col("b.h")).alias("edited_fingerprint"),
        likeness("a", "b").alias("near_edited"),
        likeness("a", "c").alias("near_next"),
    )
    rows = keyed.select(F.col("id").alias(id_col), "i", "h")
    return rows.join(written(results, "results"), ["i", "h"]).drop("i", "h")
