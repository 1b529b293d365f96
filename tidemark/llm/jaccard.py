"""Near copies by SimHash groups and exact likeness of shingle sets, for the pipeline.

Two texts are near copies if the Jaccard index of their sets of word shingles is at least
``ALIKE``. SimHash fingerprints of those sets, linked by the Gray-order index of operator 7,
bring the closest together: each is compared with the first of its group that is sure to stay,
and the copies found are settled; they aren't searched for again. As pairs of that likeness
may lie too many bits apart, the rest meets otherwise, without loss: all sets are sorted in
one order, rare shingles first; then two sets so much alike share one of their first n / 5 + 1
shingles. Every pair found is verified by its whole sets. Of shingles that many texts have, tasks
first compare sketches of the sets, which tell how many shingles two sets differ in at least,
and a pair that shares many of them is told once, after families of copies are settled by their least text.

The order is only a matter of speed. It comes from bit filters of the shingles that a share
of the texts has several times, so lines common to many texts come last at any size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.bits import Filter, bit_filter, parted
from tidemark.llm.common import column, identified, text_slices, unused, written
from tidemark.llm.components import components
from tidemark.llm.simhash import _LOWER, _WORD, fingerprint_links

SHINGLE, SEED = 5, 42
#: Numerator and denominator of the least Jaccard index, in whole numbers so that the limit itself is exact.
ALIKE = (4, 5)
#: One in so many texts is looked at for common shingles, and the counts there that make one more common.
SHARE, COMMON = 16, (2, 8, 64)
#: Bits in which the fingerprints of a group may differ.
DIFFER = 3
#: Rounds in which nodes without lesser neighbours are settled all at once, and pairs of a component that a task then takes whole.
TOGETHER, WHOLE = 2, 200_000
#: Rounds in which texts are compared with the least of each shingle, before pairs are made.
ROUNDS = 2
#: Texts of a shingle whose pairs are made by a join; of more, tasks compare blocks of so many with each other.
FEW, BLOCK = 64, 1024
#: Shingles of many texts, the first of each text, by which a pair is known to have met at one before.
LEADING = 16
#: Bits of a sketch for a shingle, and of a sketch at most, as a power of two.
SPREAD, WIDEST = 4, 12
#: Texts held together in a task, and pairs or words of sketches compared at once; they bound memory, not results.
HELD, AT_ONCE = 20_000, 1 << 20
#: Characters worked on together in a task.
SLICE = 1_000_000


def shingles(text: str, size: int = SHINGLE) -> np.ndarray:
    """Hashes of the distinct word shingles of a text, rising; A-Z count as a-z. A text of fewer words is one shingle."""
    words = _WORD.findall(text.encode().translate(_LOWER))
    if len(words) <= size:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), SEED)], np.uint64).view(np.int64)
    digest = xxhash.xxh64_digest
    raw = b"".join([digest(b" ".join(s), SEED) for s in zip(*[words[i:] for i in range(size)])])
    return np.unique(np.frombuffer(raw, ">i8").astype(np.int64))


def fingerprint(keys: np.ndarray) -> int:
    """SimHash of a shingle set."""
    bits = np.unpackbits(keys.view(np.uint64).astype(">u8").view(np.uint8)).reshape(-1, 64)
    return int(np.packbits(2 * bits.sum(0, dtype=np.int64) > len(keys)).view(">i8")[0])


def sketch(keys: np.ndarray) -> bytes:
    """The parity of the number of shingles at each of some bits. Sets differ in as many shingles at least as sketches in bits."""
    size = min(max(6, (SPREAD * len(keys) - 1).bit_length()), WIDEST)
    at = (keys.view(np.uint64) & np.uint64((1 << size) - 1)).astype(np.int64)
    return np.packbits(np.bincount(at, minlength=1 << size).astype(np.uint8) & 1, bitorder="little").tobytes()


def _common(source: DataFrame) -> list[Filter]:
    """Filters of ever more common shingles, from SHARE of the texts; bounded in size."""
    sample = source.filter(F.pmod(F.xxhash64("text"), F.lit(SHARE)) == 0).select("text").distinct()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text in batch.column(0):
                yield pa.RecordBatch.from_arrays([pa.array(shingles(text.as_py()))], names=["fp"])

    counts = sample.mapInArrow(run, "fp long").groupBy("fp").count().filter(F.col("count") >= COMMON[0])
    counts = written(counts, "common")
    sizes = counts.agg(*[F.count_if(F.col("count") >= n) for n in COMMON]).first()
    return [bit_filter(counts.filter(F.col("count") >= n), size) for n, size in zip(COMMON, sizes)]


def _first(source: DataFrame) -> DataFrame:
    """Columns node (id and text version), n (the size of its set), at and key: the first shingles of each text, rare ones before.

    With the first one stand the text's fingerprint and its sketch.
    """
    common = source.sparkSession.sparkContext.broadcast(_common(source))
    id_type = source.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = 0
            for ids, texts in text_slices(batch, SLICE):
                sizes, firsts, prints, sketches = [], [], [], []
                for text in texts:
                    keys = shingles(text)
                    sizes.append(len(keys))
                    prints.append(fingerprint(keys))
                    sketches.append(sketch(keys))
                    weight = sum(f.holds(keys.view(np.uint64)).astype(np.int8) for f in common.value)
                    keys = keys[np.argsort(weight, kind="stable")]
                    firsts.append(keys[: len(keys) * (ALIKE[1] - ALIKE[0]) // ALIKE[1] + 1])
                taken = [len(f) for f in firsts]
                rows = np.repeat(np.arange(done, done + len(ids)), taken)
                done += len(ids)
                at = np.concatenate([np.arange(t, dtype=np.int32) for t in taken])
                columns = [
                    batch.column(0).take(pa.array(rows)),
                    batch.column(2).take(pa.array(rows)),
                    pa.array(np.repeat(np.array(sizes, np.int32), taken)),
                    pa.array(at),
                    pa.array(np.concatenate(firsts)),
                    pa.array(np.repeat(np.array(prints, np.int64), taken), mask=at > 0),
                    pa.array([s for t, own in zip(taken, sketches) for s in [own, *[None] * (t - 1)]], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "version", "n", "at", "key", "fp", "sketch"])

    found = source.mapInArrow(run, f"id {id_type}, version long, n int, at int, key long, fp long, sketch binary")
    return written(found.select(F.struct("id", "version").alias("node"), "n", "at", "key", "fp", "sketch"), "first")


def _grouped(own: DataFrame) -> DataFrame:
    """Columns key, node, n and at: texts whose fingerprints are linked share a key, and may be alike as far as ``at`` tells."""
    texts = own.filter("at = 0").select("node", "n", "fp")
    linked = components(fingerprint_links(texts.select("fp").distinct(), DIFFER))
    roots = linked.select("root").distinct()
    named = written(linked.unionByName(roots.select(F.col("root").alias("node"), "root")), "groups")
    alone = texts.groupBy("fp").agg(F.count(F.lit(1)).alias("size")).filter("size > 1").select("fp")
    alone = alone.join(named.select(F.col("node").alias("fp")), "fp", "left_anti").select("fp", F.col("fp").alias("root"))
    groups = written(named.withColumnRenamed("node", "fp").unionByName(alone), "groups")
    return texts.join(groups, "fp").select(F.xxhash64("root").alias("key"), "node", "n", F.lit(0).alias("at"))


def _met(own: DataFrame) -> DataFrame:
    """The rows whose shingle several texts have among their first ones.

    A bit filter of those shingles keeps most of the others out of the shuffle.
    """
    often = written(own.groupBy("key").agg(F.count(F.lit(1)).alias("size")).filter("size > 1").select("key"), "often")
    known = own.sparkSession.sparkContext.broadcast(bit_filter(often.withColumnRenamed("key", "fp"), often.count()))
    rows = own.drop("fp", "sketch")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(batch.schema.get_field_index("key")).to_numpy().view(np.uint64)
            yield batch.filter(pa.array(known.value.holds(keys)))

    return written(rows.mapInArrow(run, rows.schema).join(often, "key"), "meeting")


def _can_be_alike(n: Column, at: Column, m: Column, there: Column) -> Column:
    """Whether sets of n and m shingles may be alike, if their first common shingle is at these places."""
    up, down = ALIKE
    size = F.least(n, m) * down >= F.greatest(n, m) * up
    return size & (F.least(n - at, m - there) * (up + down) >= (n + m) * up)


def _verified(pairs: DataFrame, source: DataFrame) -> DataFrame:
    """Those of the distinct pairs (a, b) whose whole sets are alike. Texts travel, being smaller than their sets."""
    up, down = ALIKE
    pairs = written(pairs, "pairs")
    ends = written(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "ends").select("node.*")
    named = F.xxhash64("id", "version")
    texts, _ = parted(source, named, ends.select(named.alias("fp")))
    texts = texts.join(ends, ["id", "version"], "left_semi").dropDuplicates(["id", "version"])
    texts = written(texts.select(F.struct("id", "version").alias("node"), "text"), "needed")
    one = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    other = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    rows = pairs.join(one, "a").join(other, "b").select("a", "b", "text_a", "text_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            alike, held, first = [], None, None
            for a, b in zip(batch.column(2), batch.column(3)):
                a, b = a.as_py(), shingles(b.as_py())
                if a != held:
                    held, first = a, shingles(a)
                both = len(np.intersect1d(first, b, assume_unique=True))
                alike.append(both * (up + down) >= (len(first) + len(b)) * up)
            yield batch.select([0, 1]).filter(pa.array(alike, pa.bool_()))

    return written(rows.mapInArrow(run, pairs.select("a", "b").schema), "alike")


def _may_be_alike(n: np.ndarray, at: np.ndarray, sketches: list[bytes], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which of the pairs of places a and b may be alike, by sizes, places of their shingle, and sketches."""
    up, down = ALIKE
    size = np.minimum(n[a], n[b]) * down >= np.maximum(n[a], n[b]) * up
    size &= np.minimum(n[a] - at[a], n[b] - at[b]) * (up + down) >= (n[a] + n[b]) * up
    left = np.flatnonzero(size)
    width = np.array([len(s) // 8 for s in sketches])
    both = np.minimum(width[a[left]], width[b[left]])
    for w in np.unique(both).tolist():
        pairs = left[both == w]
        used, place = np.unique(np.concatenate([a[pairs], b[pairs]]), return_inverse=True)
        # A wider sketch folds to a narrower one.
        bits = [np.bitwise_xor.reduce(np.frombuffer(sketches[i], np.uint64).reshape(-1, w), 0) for i in used.tolist()]
        bits, one, other = np.stack(bits), place[: len(pairs)], place[len(pairs) :]
        step = max(1, AT_ONCE // w)
        for i in range(0, len(pairs), step):
            some = pairs[i : i + step]
            apart = np.bitwise_count(bits[one[i : i + step]] ^ bits[other[i : i + step]]).sum(1, dtype=np.int64)
            size[some] = apart * (up + down) <= (n[a[some]] + n[b[some]]) * (down - up)
    return size


def _met_before(leading: np.ndarray, before: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which of the pairs of places a and b share a leading shingle, of those ``before`` the one they meet at here."""
    out = np.zeros(len(a), bool)
    step = max(1, AT_ONCE // LEADING**2)
    for i in range(0, len(a), step):
        one, other = a[i : i + step], b[i : i + step]
        same = leading[one][:, :, None] == leading[other][:, None, :]
        out[i : i + step] = (same & before[one][:, :, None] & before[other][:, None, :]).any((1, 2))
    return out


def _crowded(rows: DataFrame, sketches: DataFrame, least: bool = False) -> DataFrame:
    """Pairs (a < b) that may be alike, of rows (key, parts, node, n, at) whose key many have; ``least``: only the least a of each b.

    A key's texts are dealt to ``parts`` blocks, and a task compares two of them; what it gives are pairs that no sketch tells apart.
    A pair of many such keys is given at the first one: there all that is compared here holds, if it does at a later one. Texts carry
    but their LEADING first keys, so a pair that shares none of these is given more than once. The least are those of a task, which
    sees a text once for each key and block, so they grow with the rows.
    """
    id_type = rows.select("node.id").schema["id"].dataType.simpleString()
    first = F.slice(F.sort_array(F.collect_set(F.struct("at", "key"))), 1, LEADING)
    leading = rows.groupBy("node").agg(first.alias("first")).select("node", F.col("first.key").alias("leading"))
    sketches = sketches.join(leading, "node")
    own = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int").alias("own")
    dealt = rows.select("key", "node", "n", "at", own, F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other"))
    dealt = dealt.select("key", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), "node", "n", "at", "own")
    dealt = dealt.join(sketches, "node")
    dealt = dealt.select("key", "x", "y", "own", "n", "at", "sketch", "leading", "node.id", "node.version")
    met = dealt.repartition("key", "x", "y").sortWithinPartitions("key", "x", "y", "id", "version")

    def pairs(held: pa.Table) -> Iterator[pa.RecordBatch]:
        key, x, y, own, n, at = (held.column(i).to_numpy().astype(np.int64) for i in range(6))
        sketches, nodes = held.column(6).to_pylist(), held.select([8, 9]).combine_chunks()
        lists = held.column(7).combine_chunks()
        taken = lists.value_lengths().to_numpy().astype(np.int64)
        before = np.arange(LEADING) < taken[:, None]
        leading = np.zeros(before.shape, np.int64)
        leading[before] = lists.flatten().to_numpy()
        before &= np.cumsum(leading == key[:, None], 1) == 0
        new = np.append(True, (key[1:] != key[:-1]) | (x[1:] != x[:-1]) | (y[1:] != y[:-1]))
        starts = np.flatnonzero(new)
        end = np.append(starts, len(key))[np.cumsum(new)]
        partners = end - np.arange(len(key)) - 1  # the rows after it in its group
        total = np.cumsum(partners)
        led = np.zeros(len(key), bool)
        first = 0
        while first < len(key):
            done = int(total[first - 1]) if first else 0
            last = max(first + 1, int(np.searchsorted(total, done + AT_ONCE, "right")))
            count = partners[first:last]
            a = np.repeat(np.arange(first, last), count)
            b = a + 1 + np.arange(len(a)) - np.repeat(np.cumsum(count) - count, count)
            apart = (x[a] == y[a]) | (own[a] != own[b])  # two blocks: within one of them another task compares
            a, b = a[apart], b[apart]
            alike = _may_be_alike(n, at, sketches, a, b)
            a, b = a[alike], b[alike]
            if least:  # pairs come in the order of a
                b, at_first = np.unique(b, return_index=True)
                a, b = a[at_first][~led[b]], b[~led[b]]
                led[b] = True
            new = ~_met_before(leading, before, a, b)
            columns = [c.take(pa.array(i[new])).combine_chunks() for i in (a, b) for c in nodes.columns]
            yield pa.RecordBatch.from_arrays(columns, names=["a", "a_version", "b", "b_version"])
            first = last

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) < HELD:
                continue
            # Groups are whole up to the last one, which may go on in the next batch.
            whole = pa.Table.from_batches(held)
            marks = [whole.column(i).to_numpy() for i in range(3)]
            before = np.flatnonzero(np.logical_or.reduce([m != m[-1] for m in marks]))
            cut = int(before[-1]) + 1 if len(before) else 0
            if cut:
                yield from pairs(whole.slice(0, cut))
            held = whole.slice(cut).to_batches()
        if held := [b for b in held if b.num_rows]:
            yield from pairs(pa.Table.from_batches(held))

    found = met.mapInArrow(run, f"a {id_type}, a_version long, b {id_type}, b_version long")
    ends = [F.struct(F.col(c).alias("id"), F.col(f"{c}_version").alias("version")).alias(c) for c in ("a", "b")]
    return found.select(*ends).filter("a < b")


def _settled(pairs: DataFrame, rounds: int) -> tuple[DataFrame | None, DataFrame]:
    """The nodes that go, and the pairs not decided after so many rounds (None: as many as it takes)."""
    gone = None
    while (rounds is None or rounds > 0) and not pairs.isEmpty():
        # Without a lesser neighbour left a node stays, and all its neighbours go.
        heads = written(pairs.select("a").distinct().join(pairs.select(F.col("b").alias("a")), "a", "left_anti"), "heads")
        out = written(pairs.join(heads, "a", "left_semi").select(F.col("b").alias("node")).distinct(), "out")
        gone = out if gone is None else gone.unionByName(out)
        for end in ("a", "b"):
            pairs = pairs.join(out.withColumnRenamed("node", end), end, "left_anti")
        pairs = written(pairs, "left")
        rounds = None if rounds is None else rounds - 1
    return gone, pairs


def _decided(pairs: DataFrame) -> DataFrame:
    """The nodes that go, of pairs (root, a, b) whose components are small enough for a task."""
    rows = pairs.repartition("root").sortWithinPartitions("root")
    kind = pairs.select("a.id").schema["id"].dataType.simpleString()

    def gone(edges: list[tuple]) -> list[tuple]:
        below: dict[tuple, list[tuple]] = {}
        for a, b in edges:
            below.setdefault(b, []).append(a)
        out: set[tuple] = set()
        for node in sorted(below):
            if any(a not in out for a in below[node]):
                out.add(node)
        return list(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        root, edges, type_of = None, [], None

        def table(rows: list[tuple]) -> pa.RecordBatch:
            ids, versions = zip(*rows) if rows else ((), ())
            return pa.RecordBatch.from_arrays([pa.array(ids, type_of), pa.array(versions, pa.int64())], names=["id", "version"])

        for batch in batches:
            type_of = batch.column(1).type.field("id").type
            for r, a, b in zip(*(c.to_pylist() for c in batch.columns)):
                r = (r["id"], r["version"])
                if edges and r != root:
                    yield table(gone(edges))
                    edges = []
                root = r
                edges.append(((a["id"], a["version"]), (b["id"], b["version"])))
        if edges:
            yield table(gone(edges))

    found = rows.select("root", "a", "b").mapInArrow(run, f"id {kind}, version long")
    return found.select(F.struct("id", "version").alias("node"))


def _later(pairs: DataFrame) -> DataFrame:
    """The nodes that have a lesser neighbour which stays, of pairs (a < b).

    Some rounds settle most of them. What is left are chains, which may take a round for every
    two links; they are cut into components, in rounds that grow with the logarithm, and a
    task decides a component at once. Components too large for that go on in rounds.
    """
    none = pairs.select(F.col("b").alias("node")).limit(0)
    gone, left = _settled(pairs, TOGETHER)
    gone = none if gone is None else gone
    if left.isEmpty():
        return gone
    linked = components(left)
    roots = written(linked.unionByName(linked.select(F.col("root").alias("node"), "root").distinct()), "chains")
    placed = written(left.join(roots.withColumnRenamed("node", "a"), "a"), "placed")
    large = placed.groupBy("root").agg(F.count(F.lit(1)).alias("size")).filter(F.col("size") > WHOLE).select("root")
    large = written(large, "large")
    gone = gone.unionByName(written(_decided(placed.join(large, "root", "left_anti")), "decided"))
    more, _ = _settled(placed.join(large, "root", "left_semi").select("a", "b"), None)
    return gone if more is None else gone.unionByName(more)


def _beside(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pairs (a, b, maybe) of texts and the least text of each of their shingles, and the texts (node) with a lesser one."""
    # One row per shingle: the least text that has it.
    lead = F.min(F.struct(F.col("node").alias("a"), F.col("n").alias("m"), F.col("at").alias("there"))).alias("lead")
    leads = written(rows.groupBy("key").agg(lead).select("key", "lead.*"), "leads")
    maybe = _can_be_alike(F.col("n"), F.col("at"), F.col("m"), F.col("there")).alias("maybe")
    met = written(rows.join(leads, "key").filter("node != a").select("a", F.col("node").alias("b"), maybe), "met")
    return met, written(met.select(F.col("b").alias("node")).distinct(), "below")


def _led(grouped: DataFrame, below: DataFrame) -> DataFrame:
    """Pairs (a, b) of a SimHash group's least text that meets no lesser one, so it stays, and each text after it."""
    sure = grouped.join(below, "node", "left_anti")
    leads = sure.groupBy("key").agg(F.min(F.struct(F.col("node").alias("a"), F.col("n").alias("m"))).alias("lead"))
    leads = written(leads.select("key", "lead.*", F.lit(0).alias("there")), "leads")
    maybe = _can_be_alike(F.col("n"), F.col("at"), F.col("m"), F.col("there"))
    return grouped.join(leads, "key").filter("a < node").filter(maybe).select("a", F.col("node").alias("b")).distinct()


def _paired(rows: DataFrame, sketches: DataFrame, source: DataFrame) -> tuple[DataFrame | None, DataFrame]:
    """Texts (node) that go, and the pairs (a < b) of the other rows that share a shingle and may be alike.

    In a crowd each text meets the least one first that it may be like. If that one has no lesser one itself, it stays, and
    the texts like it go: of a family of near copies that leaves no pairs, where all of them would grow with its square.
    """
    many = rows.groupBy("key").agg(F.count(F.lit(1)).alias("size")).filter(F.col("size") > FEW)
    many = written(many.select("key", F.ceil(F.col("size") / BLOCK).cast("int").alias("parts")), "many")
    few = written(rows.join(many, "key", "left_anti"), "few")
    a = few.select("key", F.col("node").alias("a"), F.col("n").alias("m"), F.col("at").alias("there"))
    pairs = few.withColumnRenamed("node", "b").join(a, "key").filter("a < b")
    pairs = pairs.filter(_can_be_alike(F.col("n"), F.col("at"), F.col("m"), F.col("there"))).select("a", "b").distinct()
    if many.isEmpty():
        return None, pairs

    pairs = written(pairs, "apart")
    crowd = written(rows.join(many, "key"), "crowd")
    sketches = written(sketches.dropDuplicates(["node"]).join(crowd.select("node").distinct(), "node"), "sketches")
    led = written(_crowded(crowd, sketches, least=True), "led")
    below = led.select("b").unionByName(pairs.select("b")).distinct().withColumnRenamed("b", "a")
    out = _verified(led.join(below, "a", "left_anti").distinct(), source).select(F.col("b").alias("node")).distinct()
    out = written(out, "out")
    for end in ("a", "b"):
        pairs = pairs.join(out.withColumnRenamed("node", end), end, "left_anti")
    return out, pairs.unionByName(_crowded(crowd.join(out, "node", "left_anti"), sketches)).distinct()


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The nodes (id, version: the hash of the text) to drop, so that in the order of ids each text stays unless one
    that stays before it is a near copy of it. Null texts are empty ones; rows without an id are not looked at. An
    empty table gives no rows; other columns are not read.
    """
    source = identified(docs, id_col, text_col).filter("id IS NOT NULL").withColumn("version", F.xxhash64("text"))
    own = _first(source)
    rows = _met(own)
    met, below = _beside(rows)
    # SimHash groups come first: what is settled by them goes from the search by shingles.
    gone = written(_verified(_led(_grouped(own), below), source).select(F.col("b").alias("node")).distinct(), "out")
    rows = written(rows.join(gone, "node", "left_anti"), "rest")
    met = met.join(gone.withColumnRenamed("node", "b"), "b", "left_anti")

    for step in range(ROUNDS):
        if rows.isEmpty():
            break
        if step:
            met, below = _beside(rows)
        # The least text of all its shingles stays, and everything that can be like it has met it.
        pairs = met.filter("maybe").select("a", "b").distinct().join(below.withColumnRenamed("node", "a"), "a", "left_anti")
        out = written(_verified(pairs, source).select(F.col("b").alias("node")).distinct(), "out")
        gone = gone.unionByName(out)
        rows = written(rows.join(below, "node", "left_semi").join(out, "node", "left_anti"), "rest")

    out, pairs = _paired(rows, own.filter("at = 0").select("node", "sketch"), source)
    gone = gone if out is None else gone.unionByName(out)
    later = _later(_verified(pairs, source))
    return gone.unionByName(later).select("node.*")


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents without near copies, in all their columns. Rows without an id stay."""
    gone_id, gone_version = unused(docs, "gone_id"), unused(docs, "gone_version")
    gone = near_copies(docs, id_col, text_col).distinct().toDF(gone_id, gone_version)
    gone = written(gone, "gone")
    version = F.xxhash64(F.coalesce(column(text_col), F.lit("")))
    # Most documents can't be among them, and aren't shuffled.
    maybe, stay = parted(docs, F.xxhash64(column(id_col), version), gone.select(F.xxhash64(gone_id, gone_version).alias("fp")))
    return stay.unionByName(maybe.join(gone, (column(id_col) == gone[gone_id]) & (version == gone[gone_version]), "left_anti"))
