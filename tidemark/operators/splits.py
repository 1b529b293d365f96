"""Train/test assignment, label separation and latest labels."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.hashing import BUCKETS, hash_bucket
from tidemark.functions.ordering import order_value
from tidemark.operators.ranking import percent_rank_cutoff


def split_by_hash(
    df: DataFrame, keys: Sequence[str], ratio: float = 0.8, seed: int | str = 42, name: str = "split"
) -> DataFrame:
    """``train``/``test`` by key hash: a key keeps its side in every run and every layout."""
    side = F.when(hash_bucket(keys, seed) < F.lit(ratio * BUCKETS), "train").otherwise("test")
    return df.withColumn(name, side)


def split_by_weights(
    df: DataFrame, keys: Sequence[str], weights: Mapping[str, float], seed: int | str = 42, name: str = "split"
) -> DataFrame:
    """Several named parts; weights are relative and taken in the given order."""
    total = float(sum(weights.values()))
    bucket, reached, side = hash_bucket(keys, seed), 0.0, None
    *heads, tail = weights.items()
    for part, weight in heads:
        reached += weight
        edge = round(reached / total * BUCKETS, 6)
        side = F.when(bucket < edge, part) if side is None else side.when(bucket < edge, part)
    return df.withColumn(name, F.lit(tail[0]) if side is None else side.otherwise(tail[0]))


def split_at_random(df: DataFrame, ratio: float = 0.8, seed: int = 42, name: str = "split") -> DataFrame:
    """Row-wise random split. Not stable when the input is laid out differently; prefer the hash."""
    return df.withColumn(name, F.when(F.rand(seed) < ratio, "train").otherwise("test"))


def split_by_time(
    df: DataFrame, time_col: str, ratio: float = 0.8, name: str = "split", on_constant: str = "error"
) -> DataFrame:
    """Out-of-time split: train where ``percent_rank`` over time is within ``ratio``.

    The cutoff is found by counting, so no window over all rows is needed and the
    result is one projection. A time column with a single value puts every row into
    train; that raises unless ``on_constant='keep'``.
    """
    cutoff, distinct = percent_rank_cutoff(df, time_col, ratio)
    if distinct == 1 and on_constant == "error":
        raise ValueError(f"{time_col} has one distinct value: every row would be train; split by hash instead")
    early = F.col(time_col).isNull()
    if cutoff is not None:
        early = early | (order_value(time_col, df.schema[time_col].dataType) <= F.lit(cutoff))
    return df.withColumn(name, F.when(early, "train").otherwise("test"))


def assign_split(
    df: DataFrame, strategy: str, keys: Sequence[str], time_col: str, ratio: float = 0.8, seed: int = 42
) -> DataFrame:
    """Split by ``hash``, ``random`` or ``time``."""
    if strategy == "hash":
        return split_by_hash(df, keys, ratio, seed)
    if strategy == "random":
        return split_at_random(df, ratio, seed)
    if strategy == "time":
        return split_by_time(df, time_col, ratio)
    raise ValueError(f"unknown split strategy {strategy!r}")


def separate_labels(
    df: DataFrame,
    keys: Sequence[str],
    time_col: str,
    label: str,
    ratio: float = 0.8,
    seed: int = 42,
    strategy: str = "hash",
) -> tuple[DataFrame, DataFrame]:
    """(features without the label, label table with keys, time, label and split)."""
    labels = assign_split(df.select(*keys, time_col, label), strategy, keys, time_col, ratio, seed)
    return df.drop(label), labels


def attach_labels(
    features: DataFrame, source: DataFrame, key: str, time_col: str, label: str, ratio: float = 0.8, seed: int = 42
) -> DataFrame:
    """Label table for feature keys: label looked up by key, null where the source has none."""
    joined = features.select(key, time_col).join(source.select(key, label), key, "left")
    return split_by_hash(joined, [key], ratio, seed)


def latest_per_key(df: DataFrame, keys: Sequence[str], time_col: str) -> DataFrame:
    """The newest row per key; equal times are settled by the other orderable columns, largest first.

    An aggregate, not a window: rows are reduced before the shuffle, so a key with
    very many rows sends at most one row per input partition.
    """
    rest = [c for c in df.columns if c not in keys and c != time_col]
    plain = [c for c in rest if "map<" not in df.schema[c].dataType.simpleString()]
    if plain == rest:
        newest = F.max(F.struct(time_col, *rest))
    else:  # maps can't be compared, but the row that the others choose has them
        newest = F.max_by(F.struct(time_col, *rest), F.struct(time_col, *plain))
    newest = df.groupBy(*keys).agg(newest.alias("_r"))
    return newest.select(*[F.col(c) if c in keys else F.col(f"_r.`{c}`").alias(c) for c in df.columns])


def latest_label(df: DataFrame, keys: Sequence[str], time_col: str, label: str, split: str = "split") -> DataFrame:
    """Latest label and split per entity."""
    return latest_per_key(df.select(*keys, time_col, label, split), keys, time_col)


def route_traffic(
    df: DataFrame, request_keys: Sequence[str], shares: Mapping[str, float], seed: int | str = "traffic"
) -> DataFrame:
    """Model version per request by key hash, so one requester always meets one version."""
    return split_by_weights(df, request_keys, shares, seed, "model_version")


def class_weights(df: DataFrame, label: str, weight: str = "weight") -> DataFrame:
    """Balanced weight per class: rows / (classes x rows of the class)."""
    counts = df.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    share = counts.agg(F.sum("n") / F.count(F.lit(1))).scalar()
    return counts.select(label, "n", (share / F.col("n")).alias(weight))


def with_class_weights(df: DataFrame, label: str, weight: str = "weight") -> DataFrame:
    """Rows with the weight of their class, for ``weightCol``; any number of classes.

    The weights are one row a class. Adaptive execution broadcasts them while they are small,
    as classes are; otherwise it is an ordinary join.
    """
    return df.join(class_weights(df, label, weight).drop("n"), label, "left")
