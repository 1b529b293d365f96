"""Feature lookups: point-in-time joins, key joins and training-set assembly."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import FeatureFunction
from tidemark.functions.ordering import order_value
from tidemark.operators import skew
from tidemark.operators.skew import SkewPolicy

NO_TIME_SALTS = 1_024


@dataclass(frozen=True)
class FeatureLookup:
    """Which columns of a feature table to attach, and by which keys.

    With ``time_key`` the lookup is point-in-time: equality on ``keys`` and the
    latest feature row not after the label row. ``time_key`` must not be among
    ``keys``; ``label_time`` names the time column on the label side when it differs.
    """

    table: DataFrame | str
    keys: Sequence[str]
    features: Sequence[str] | None = None
    rename: Mapping[str, str] = field(default_factory=dict)
    time_key: str | None = None
    label_time: str | None = None
    lookback: dt.timedelta | None = None

    def frame(self, spark) -> DataFrame:
        return spark.table(self.table) if isinstance(self.table, str) else self.table

    def feature_names(self, table: DataFrame) -> list[str]:
        if self.features is not None:
            return list(self.features)
        skip = {*self.keys, self.time_key}
        return [c for c in table.columns if c not in skip]

    def output_columns(self, table: DataFrame) -> list[Column]:
        return [F.col(c).alias(self.rename.get(c, c)) for c in self.feature_names(table)]

    def output_names(self, table: DataFrame) -> list[str]:
        return [self.rename.get(c, c) for c in self.feature_names(table)]


def key_lookup(
    left: DataFrame, lookup: FeatureLookup, check_unique: bool = True, policy: SkewPolicy = SkewPolicy(),
    counted: DataFrame | None = None,
) -> DataFrame:
    """Left join on the full key.

    A key that occurs twice on the feature side would multiply rows, so it raises when
    such rows are read. The check groups by the join key: it shares the join's shuffle and
    pre-aggregates before it. Hot keys on the left are spread; ``counted`` as in ``skew.left_join``.
    """
    table = lookup.frame(left.sparkSession)
    columns, names, keys = lookup.output_columns(table), lookup.output_names(table), list(lookup.keys)
    if not check_unique:
        # Two plain inputs: the adaptive skew join can split a hot key by itself.
        return left.join(table.select(*keys, *columns), keys, "left")
    grouped = (
        table.filter(_all_set(keys))
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_n"), F.first(F.struct(F.lit(1).alias("_on"), *columns)).alias("_f"))
    )
    text = F.concat(F.lit("lookup key is not unique: "), F.concat_ws(",", *[F.col(k).cast("string") for k in keys]))
    one = F.when(F.col("_n") > 1, F.raise_error(text).cast("boolean")).otherwise(F.lit(True))
    joined = skew.left_join(left, grouped.filter(one).drop("_n"), keys, policy, counted)
    return joined.select(*[F.col(c) for c in left.columns], *[F.col(f"_f.`{n}`").alias(n) for n in names])


def asof_join(
    left: DataFrame, lookups: Sequence[FeatureLookup] | FeatureLookup, policy: SkewPolicy = SkewPolicy(),
    counted: DataFrame | None = None,
) -> DataFrame:
    """Attach, for each row of ``left``, the latest feature row with time <= its own.

    All rows of both sides are laid on one time line per key, and a running
    ``last`` carries features forward onto the label rows: one shuffle, however
    many lookups share the keys, and no pairs of rows are ever built. Features
    come before labels at equal times; of several feature rows at one key and time the one with
    the largest hash of its values counts, so the result is repeatable. Label rows without a match, with a null
    key or with a null time are kept with null features.

    A key with more rows than a piece should have (``policy.rows``) is cut into pieces along time.
    The last feature row before each piece goes along with the piece, so each
    piece is complete on its own. A null key is a key like any other here: no feature row
    has it, and it is cut when it is hot.
    """
    lookups = [lookups] if isinstance(lookups, FeatureLookup) else list(lookups)
    on = list(lookups[0].keys)
    time = lookups[0].label_time or lookups[0].time_key
    time_type = left.schema[time].dataType
    tables = [lk.frame(left.sparkSession) for lk in lookups]
    keys = [f"_k{i}" for i in range(len(on))]
    # Both sides hash their keys, so they must carry them in one type.
    key_types = skew.common_types(on, left, *tables)
    key_columns = [F.col(c).cast(t).alias(k) for c, k, t in zip(on, keys, key_types)]

    # Label columns stay flat, so the optimizer can prune the ones nobody reads.
    payload = {c: f"_l{i}" for i, c in enumerate(left.columns) if c not in on and c != time}
    rows = left.select(
        *key_columns, F.col(time).alias("_time"), F.lit(0).cast("long").alias("_tie"),
        *[F.col(c).alias(p) for c, p in payload.items()],
    )
    sides = [
        t.select(
            *key_columns,
            F.col(lk.time_key).cast(time_type).alias("_time"),
            _value_hash(lk, t).alias("_tie"),
            F.struct(F.col(lk.time_key).cast(time_type).alias("_at"), *lk.output_columns(t)).alias(f"_f{i}"),
        ).filter(_all_set([*keys, "_time"]))
        for i, (lk, t) in enumerate(zip(lookups, tables))
    ]
    labels = rows
    if counted is not None:  # the same keys and times under a cheaper plan
        labels = counted.select(*key_columns, F.col(time).alias("_time"))
    pieces = _find_pieces(labels, sides, keys, time_type, policy) if policy.enabled else []
    line = _time_line(rows, sides, keys, time_type, pieces)

    carried = Window.partitionBy(*keys, "_piece", "_salt").orderBy("_time", "_side", "_tie")
    carried = carried.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    filled = line.withColumns(
        {f"_f{i}": F.last(f"_f{i}", ignorenulls=True).over(carried) for i in range(len(sides))}
    ).filter(F.col("_side") == 1)

    back = {**payload, **dict(zip(on, keys)), time: "_time"}
    out = [F.col(back[f.name]).cast(f.dataType).alias(f.name) for f in left.schema.fields]
    for i, (lk, table) in enumerate(zip(lookups, tables)):
        found = F.lit(True)
        if lk.lookback is not None:
            found = F.col(f"_f{i}._at") >= F.col("_time") - F.lit(lk.lookback)
        out += [F.when(found, F.col(f"_f{i}.`{n}`")).alias(n) for n in lk.output_names(table)]
    return filled.select(*out)


def _value_hash(lookup: FeatureLookup, table: DataFrame) -> Column:
    """Hash of the feature values that have one (maps and the like have none)."""
    plain = [c for c in lookup.feature_names(table) if isinstance(table.schema[c].dataType, T.AtomicType)]
    return F.xxhash64(*[F.col(c) for c in plain]) if plain else F.lit(0).cast("long")


def _all_set(columns: Sequence[str]) -> Column:
    test = F.lit(True)
    for name in columns:
        test = test & F.col(name).isNotNull()
    return test


def _find_pieces(rows, sides, keys, time_type, policy) -> list[skew.Piece]:
    """Pieces of the hot keys over both sides together; empty when no key is hot."""
    both = rows.select(*keys, "_time")
    for side in sides:
        both = both.unionByName(side.select(*keys, "_time"))
    marks = both.select(skew.key_hash(keys).alias("_key"), order_value("_time", time_type).alias("_ord"))
    hot = skew.hot_keys(marks, policy)
    return skew.cut_pieces(marks, hot, policy) if hot else []


def _time_line(rows, sides, keys, time_type, pieces) -> DataFrame:
    """Label rows, feature rows and, for hot keys, the feature rows carried into each piece."""
    shared = [*keys, "_time", "_tie", "_piece", "_salt", "_side"]

    def union(parts: list[DataFrame]) -> DataFrame:
        out = parts[0]
        for part in parts[1:]:
            out = out.unionByName(part, allowMissingColumns=True)
        return out

    if not pieces:
        flat = {"_piece": F.lit(0), "_salt": F.lit(0)}
        labels = rows.withColumns({**flat, "_side": F.lit(1)})
        return union([labels] + [s.withColumns({**flat, "_side": F.lit(0)}) for s in sides])

    order = order_value("_time", time_type)
    order_type = rows.select(order.alias("_ord")).schema["_ord"].dataType

    def placed(df: DataFrame) -> DataFrame:
        return skew.place(df, pieces, order, order_type, keys)

    # Rows without a time match nothing, so any salt is right for them.
    salts = F.when(F.col("_ord").isNull(), F.lit(NO_TIME_SALTS)).otherwise(F.coalesce("_copies", F.lit(1)))
    salt = F.when(salts > 1, F.pmod(skew.row_hash(rows), salts).cast("int")).otherwise(F.lit(0))
    labels = placed(rows).withColumns({"_salt": salt, "_side": F.lit(1)}).select(*rows.columns, *shared[-3:])
    parts = [labels]
    for i, side in enumerate(sides):
        at = placed(side).withColumns({"_salt": F.lit(0), "_side": F.lit(0)})
        parts.append(at.select(*shared, f"_f{i}"))
        parts.append(_carry(at, f"_f{i}", keys, pieces).select(*shared, f"_f{i}"))
    return union(parts)


def _carry(placed: DataFrame, feature: str, keys: Sequence[str], pieces: list[skew.Piece]) -> DataFrame:
    """For every piece of a hot key the last feature row before it.

    Salted pieces are single instants: they get the last feature row up to and
    including the instant, once per salt. The row count is bounded by the piece
    table, whose size does not depend on the data.
    """
    spark = placed.sparkSession
    grid = spark.createDataFrame([(p.key, p.index, p.salts) for p in pieces], "_key long, _piece int, _salts int")
    last = (
        placed.filter(F.col("_copies").isNotNull())
        .groupBy(*keys, "_key", "_piece")
        .agg(F.max_by(F.struct("_time", "_tie", feature), F.struct("_time", "_tie")).alias("_last"))
        .groupBy(*keys, "_key")
        .agg(F.map_from_entries(F.collect_list(F.struct("_piece", "_last"))).alias("_by_piece"))
    )
    slots = last.join(F.broadcast(grid), "_key").withColumn("_last", F.col("_by_piece")[F.col("_piece")])
    line = Window.partitionBy(*keys).orderBy("_piece")
    before = F.last("_last", ignorenulls=True).over(line.rowsBetween(Window.unboundedPreceding, -1))
    upto = F.last("_last", ignorenulls=True).over(line.rowsBetween(Window.unboundedPreceding, 0))
    got = F.when(F.col("_salts") > 1, upto).otherwise(before)
    return (
        slots.withColumn("_got", got)
        .filter(F.col("_got").isNotNull())
        .select(
            *keys,
            "_piece",
            F.explode(F.sequence(F.lit(0), F.col("_salts") - 1)).alias("_salt"),
            F.lit(0).alias("_side"),
            F.col("_got._time").alias("_time"),
            F.col("_got._tie").alias("_tie"),
            F.col(f"_got.{feature}").alias(feature),
        )
    )


def apply_lookups(
    left: DataFrame, specs: Sequence[FeatureLookup | FeatureFunction], policy: SkewPolicy = SkewPolicy()
) -> DataFrame:
    """Apply lookups and functions in order; later ones may read earlier results.

    Neighbouring point-in-time lookups on the same keys run as one pass. Lookups keep the rows,
    so rows per key are counted on ``left`` itself where it has the keys, not on the lookups before.
    """
    out, batch = left, []

    def counted(columns: Sequence[str]) -> DataFrame | None:
        return left if set(columns) <= set(left.columns) else None

    def same_line(a: FeatureLookup, b: FeatureLookup) -> bool:
        return list(a.keys) == list(b.keys) and (a.label_time or a.time_key) == (b.label_time or b.time_key)

    def flush(df: DataFrame) -> DataFrame:
        if batch:
            first = batch[0]
            done = asof_join(df, batch, policy, counted([*first.keys, first.label_time or first.time_key]))
        else:
            done = df
        batch.clear()
        return done

    for spec in specs:
        timed = isinstance(spec, FeatureLookup) and spec.time_key is not None
        if batch and not (timed and same_line(batch[0], spec)):
            out = flush(out)
        if timed:
            batch.append(spec)
        elif isinstance(spec, FeatureLookup):
            out = key_lookup(out, spec, policy=policy, counted=counted(spec.keys))
        else:
            out = spec.apply(out)
    return flush(out)


def training_set(
    labels: DataFrame,
    specs: Sequence[FeatureLookup | FeatureFunction],
    label: str | None,
    exclude: Sequence[str] = (),
    exclude_null_labels: bool = True,
    policy: SkewPolicy = SkewPolicy(),
) -> DataFrame:
    """Labels with looked-up and computed features, ready for fitting.

    Null labels go first, before any shuffle. ``label=None`` is for scoring.
    """
    if label is not None and exclude_null_labels:
        labels = labels.filter(F.col(label).isNotNull())
    return apply_lookups(labels, specs, policy).drop(*exclude)
