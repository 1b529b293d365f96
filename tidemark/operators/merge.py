"""Keyed table changes as plain DataFrame plans: upsert, change feed, log union."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators import skew
from tidemark.operators.skew import SkewPolicy


#: A column's value from the target's and the source's values, each by name.
Combine = Callable[[Callable[[str], Column], Callable[[str], Column]], Column]


def merge_frames(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update: Sequence[str] | None = None,
    insert: bool = True,
    policy: SkewPolicy = SkewPolicy(),
    newer: str | None = None,
    combine: Mapping[str, Combine] | None = None,
) -> DataFrame:
    """The target after ``MERGE``: matched rows updated, unmatched source rows inserted.

    ``update=None`` updates every column the two sides share. Columns only the source
    has are ignored; inserted rows have null in columns only the target has. Two source
    rows for one target row raise, as ``MERGE`` does. Null keys match nothing. With ``newer``
    a matched row is only updated if the source has more in that column (or the target
    nothing), so changes may come twice or late. ``combine`` makes a column's new value from
    both rows, given as functions from a column's name to its value.

    Written as a left join plus an anti join rather than a full outer join: when the
    source is small, adaptive execution broadcasts it and the target is never shuffled.
    """
    keys = list(keys)
    shared = [c for c in target.columns if c in source.columns and c not in keys]
    changed = shared if update is None else list(update)
    absent = [c for c in [*keys, *changed] if c not in source.columns]
    if absent:
        raise ValueError(f"source has no columns {absent}")

    fresh = source.select(*keys, *shared)
    values = [F.col(c).alias(f"_new_{c}") for c in changed]
    per_key = fresh.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.first(F.struct(F.lit(1), *values)).alias("_s"))
    joined = skew.left_join(target, per_key, keys, policy)
    stop = F.raise_error(F.lit("merge: several source rows match one target row")).cast("boolean")
    hit = F.when(F.col("_n") > 1, stop).otherwise(F.col("_n").isNotNull())
    if newer is not None:
        hit = hit & (F.col(newer).isNull() | (F.col(f"_s.`_new_{newer}`") > F.col(newer)))

    def updated(c: str) -> Column:
        value = F.col(f"_s.`_new_{c}`")
        if combine and c in combine:
            value = combine[c](F.col, lambda name: F.col(f"_s.`_new_{name}`"))
        return F.when(hit, value.cast(target.schema[c].dataType)).otherwise(F.col(c)).alias(c)

    merged = joined.select(
        *[
            updated(c)
            if c in changed
            else F.col(c)
            for c in target.columns
        ]
    )
    if not insert:
        return merged
    # Reduce the target to the keys the source mentions before the anti join.
    known = target.select(*keys).join(source.select(*keys), keys, "left_semi")
    new = fresh.join(known, keys, "left_anti")
    return merged.unionByName(
        new.select(
            *[
                F.col(c).cast(target.schema[c].dataType).alias(c)
                if c in new.columns
                else F.lit(None).cast(target.schema[c].dataType).alias(c)
                for c in target.columns
            ]
        )
    )


def late_labels(log: DataFrame, labels: DataFrame, keys: Sequence[str], label: str) -> DataFrame:
    """Fill labels that arrived later into the inference log; nothing is inserted."""
    return merge_frames(log, labels, keys, update=[label], insert=False)


def change_feed(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Row changes between two states of a keyed table, as ``_change_type`` rows.

    insert, delete, update_preimage and update_postimage. Values compare null-safe. A key
    that occurs twice on a side raises, so the join never builds pairs; the check groups by the
    join's own key. A null key matches nothing.
    """
    keys, columns = list(keys), before.columns
    rest = [c for c in columns if c not in keys]

    def packed(df: DataFrame, name: str) -> DataFrame:
        one = df.groupBy(*keys).agg(
            F.count(F.lit(1)).alias("_n"), F.first(F.struct(F.lit(1).alias("_on"), *rest)).alias("_r")
        )
        text = F.concat(F.lit("change feed key is not unique: "), F.concat_ws(",", *[F.col(k).cast("string") for k in keys]))
        twice = F.raise_error(text).cast(one.schema["_r"].dataType)
        return one.select(*keys, F.when(F.col("_n") > 1, twice).otherwise(F.col("_r")).alias(name))

    both = packed(before, "_old").join(packed(after.select(*columns), "_new"), keys, "full_outer")
    gone, came = F.col("_new").isNull(), F.col("_old").isNull()

    def change(kind: str, side: str):
        return F.struct(F.lit(kind).alias("kind"), F.col(side).alias("row"))

    changes = (
        F.when(came, F.array(change("insert", "_new")))
        .when(gone, F.array(change("delete", "_old")))
        .when(
            ~F.col("_old").eqNullSafe(F.col("_new")),
            F.array(change("update_preimage", "_old"), change("update_postimage", "_new")),
        )
    )
    rows = both.select(*keys, F.explode(changes).alias("_c"))
    return rows.select(
        *[F.col(c) if c in keys else F.col(f"_c.row.`{c}`").alias(c) for c in columns],
        F.col("_c.kind").alias("_change_type"),
    )


def union_logs(*logs: DataFrame) -> DataFrame:
    """Offline and online logs together; columns one of them lacks become null."""
    out = logs[0]
    for log in logs[1:]:
        out = out.unionByName(log, allowMissingColumns=True)
    return out
