"""Exact dedup with a heavy-hitter split (operator 8).

Misra-Gries summaries find the digests that a large share of the rows may have. Those few
are counted exactly and broadcast, so their rows are decided where they are read. Every
other digest has a bounded share of the rows and goes through an ordinary shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.bits import parted
from tidemark.llm.common import column, identified, unused, written

#: Counters of a summary. No digest with more than 2/COUNTERS of the rows is shuffled by key.
COUNTERS = 1024


def _cut(counts: dict[int, int], keep: int) -> dict[int, int]:
    """Subtract the (keep+1)-th largest count from all and drop what is used up."""
    if len(counts) <= keep:
        return counts
    values = np.fromiter(counts.values(), np.int64, len(counts))
    floor = int(np.partition(values, len(values) - keep - 1)[len(values) - keep - 1])
    return {k: n - floor for k, n in counts.items() if n > floor}


def misra_gries(keys: Iterator[np.ndarray], counters: int) -> dict[int, int]:
    """Summary of a stream of keys: at most ``counters`` keys, each count low by at most n/(counters+1)."""
    counts: dict[int, int] = {}
    for block in keys:
        for k, n in zip(*(x.tolist() for x in np.unique(block, return_counts=True))):
            counts[k] = counts.get(k, 0) + n
        counts = _cut(counts, counters)
    return counts


def heavy_keys(rows: DataFrame, key: str, counters: int = COUNTERS) -> DataFrame:
    """At most ``counters`` values of the long column ``key``, among them all with over 2/counters of the rows.

    Summaries of partitions are merged by adding; the sum is low by at most rows/counters, and
    the counts add up to no more than the rows, so the largest ``counters`` sums hold all of them.
    """

    def summary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = misra_gries((b.column(0).to_numpy(zero_copy_only=False) for b in batches), counters)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(found), pa.int64()), pa.array(list(found.values()), pa.int64())], names=["k", "n"]
        )

    sums = rows.select(F.col(key).alias("k")).mapInArrow(summary, "k long, n long").groupBy("k").agg(F.sum("n").alias("n"))
    return sums.orderBy(F.desc("n"), "k").limit(counters).select(F.col("k").alias(key))


def copy_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", counters: int = COUNTERS
) -> DataFrame:
    """One row per document: id, digest, keep_id, group_size, kept.

    Texts are equal when their SHA-256 digests are; null counts as empty. Of equal texts the
    row with the largest id stays; of rows that also repeat that id, exactly one; a null id
    stays only if its whole group has none. An empty table gives no rows; extra columns are
    not read, so their names don't matter.
    """
    digest = F.unhex(F.sha2(F.col("text").cast("binary"), 256))
    # The row number separates repeated rows. It is stored, so it can't change when a task runs again.
    rows = written(
        identified(docs, id_col, text_col).select(
            "id",
            digest.alias("digest"),
            F.xxhash64(digest).alias("key"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "digests",
    )
    last = F.max(F.struct("id", "row"))
    size = F.count(F.lit(1))
    heavy = heavy_keys(rows, "key", counters)
    winners = written(
        rows.join(F.broadcast(heavy), "key", "left_semi").groupBy("digest").agg(last.alias("last"), size.alias("size")),
        "winners",
    )  # at most one row for each counter, barring collisions of 64-bit hashes
    marked = rows.join(F.broadcast(winners), "digest", "left")
    window = Window.partitionBy("digest")
    rest = marked.filter(F.col("size").isNull()).withColumns({"last": last.over(window), "size": size.over(window)})
    return (
        marked.filter(F.col("size").isNotNull())
        .unionByName(rest)
        .select(
            "id",
            "digest",
            F.col("last.id").alias("keep_id"),
            F.col("size").alias("group_size"),
            (F.col("row") == F.col("last.row")).alias("kept"),
        )
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents without copies, in all their columns.

    As ``copy_groups``. Rows that repeat the id and text of the row that stays are one
    document: one of them stays, whichever it is if they differ in other columns.
    """
    groups = copy_groups(docs, id_col, text_col)
    fate = groups.groupBy("digest", "id").agg(F.max("kept").alias("kept"), F.count(F.lit(1)).alias("times"))
    digest, times = unused(docs, "digest"), unused(docs, "times")
    fate = written(
        fate.filter(~F.col("kept") | (F.col("times") > 1)).select(
            F.col("digest").alias("fate_digest"), F.col("id").alias("fate_id"), F.col("kept").alias("fate_kept")
        ),
        "fate",
    )
    keyed = docs.withColumn(digest, F.unhex(F.sha2(F.coalesce(column(text_col), F.lit("")).cast("binary"), 256)))
    # Texts that no fate can be about, most of them, aren't shuffled.
    keyed, alone = parted(keyed, F.xxhash64(column(digest)), fate.select(F.xxhash64("fate_digest").alias("fp")))
    same = (keyed[digest] == fate["fate_digest"]) & keyed[f"`{id_col}`"].eqNullSafe(fate["fate_id"])
    joined = keyed.join(fate, same, "left").withColumn(times, F.col("fate_kept")).drop(*fate.columns)
    once = joined.filter(column(times).isNull()).drop(times)
    repeated = joined.filter(column(times)).dropDuplicates([id_col, digest]).drop(times)
    return alone.unionByName(once).unionByName(repeated).select(*[column(c) for c in docs.columns])
