"""Exact ranks without sorting everything in one place."""

from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F

from tidemark.functions.ordering import order_value

HISTOGRAM_CELLS = 8_192
RANGE_ROWS = 500_000


def order_statistics(df: DataFrame, name: str, ranks: list[int]) -> list[int | float]:
    """Values at 0-based ``ranks`` of the sorted non-null values of column ``name``.

    Each step counts rows in equal-width cells between known bounds and narrows
    the bounds to the cell that holds the rank, until that cell holds one single
    value. A step is one map-side aggregate of one column; at most
    HISTOGRAM_CELLS counters reach the driver, and rows never leave the executors.
    """
    values = df.select(order_value(name, df.schema[name].dataType).alias("v")).filter("v IS NOT NULL AND NOT isnan(v)")
    bounds = _bounds(values)
    return [_value_at(values, bounds, rank) for rank in ranks]


def _bounds(values: DataFrame) -> Row:
    """Of the non-null ``v``: rows below and among the finite values, least and largest finite one, infinite and NaN rows."""
    number = F.col("v").cast("double")
    finite = ~F.isnan(number) & (F.abs(number) != F.lit(math.inf))
    return values.agg(
        F.count_if(number == F.lit(-math.inf)).alias("low"),
        F.count_if(finite).alias("finite"),
        F.count_if(number == F.lit(math.inf)).alias("high"),
        F.count_if(F.isnan(number)).alias("nan"),
        F.min(F.when(finite, F.col("v"))).alias("lo"),
        F.max(F.when(finite, F.col("v"))).alias("hi"),
    ).first()


def _value_at(values: DataFrame, bounds: Row, rank: int) -> int | float:
    """Value at a rank, in Spark's order: NaN is the largest. Infinite bounds never enter the search."""
    if rank < bounds["low"]:
        return -math.inf
    rank -= bounds["low"]
    if rank < bounds["finite"]:
        return _select(values, bounds["lo"], bounds["hi"], rank)
    rank -= bounds["finite"]
    if rank < bounds["high"]:
        return math.inf
    if rank - bounds["high"] < bounds["nan"]:
        return math.nan
    raise ValueError("rank is beyond the number of rows")


def _select(values: DataFrame, lo, hi, rank: int):
    """Value at ``rank`` among those between the finite ``lo`` and ``hi``."""
    while lo != hi:
        if isinstance(lo, int):
            step = max(1, math.ceil((hi - lo + 1) / HISTOGRAM_CELLS))
            # A long's whole range doesn't fit a long.
            cell = F.expr(f"(CAST(v AS DECIMAL(20, 0)) - CAST('{lo}' AS DECIMAL(20, 0))) div {step}")
        else:
            width = hi / HISTOGRAM_CELLS - lo / HISTOGRAM_CELLS
            if width > 0:
                place = F.floor(F.col("v") / F.lit(width) - F.lit(lo / width))
                cell = F.least(F.greatest(place, F.lit(0)), F.lit(HISTOGRAM_CELLS - 1))
            else:
                cell = F.when(F.col("v") == F.lit(lo), F.lit(0)).otherwise(F.lit(1))
        cells = (
            values.filter(F.col("v").between(lo, hi))
            .groupBy(cell.alias("cell"))
            .agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
            .orderBy("cell")
            .collect()
        )
        if len(cells) == 1 and (cells[0]["lo"], cells[0]["hi"]) == (lo, hi):
            # Neighbouring doubles that one cell can't tell apart.
            split = F.when(F.col("v") == F.lit(lo), F.lit(0)).otherwise(F.lit(1))
            cells = (
                values.filter(F.col("v").between(lo, hi))
                .groupBy(split.alias("cell"))
                .agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
                .orderBy("cell")
                .collect()
            )
        for row in cells:
            if rank < row["n"]:
                lo, hi = row["lo"], row["hi"]
                break
            rank -= row["n"]
        else:
            raise ValueError("rank is beyond the number of rows")
    return lo


def percent_rank_cutoff(df: DataFrame, name: str, ratio: float) -> tuple[int | float | None, int]:
    """Largest value whose ``percent_rank`` over ascending ``name`` is within ``ratio``.

    Nulls rank first, as in ``ORDER BY name ASC NULLS FIRST``. Returns the cutoff on
    the order value (None when only nulls are within the ratio) and the number of
    distinct non-null values, counted up to 2.
    """
    mark = order_value(name, df.schema[name].dataType)
    facts = df.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col(name).isNull()).alias("nulls"),
        F.min(mark).alias("lo"),
        F.max(mark).alias("hi"),
    ).first()
    n, nulls, lo, hi = facts["n"], facts["nulls"], facts["lo"], facts["hi"]
    distinct = 0 if lo is None else (1 if lo == hi else 2)
    if distinct == 0:
        return None, distinct
    if n == 1:
        return hi, distinct
    # Largest number of earlier rows that still counts; compare as a quotient, as percent_rank does.
    last = n - 1
    before = math.floor(ratio * last)
    while before < last and (before + 1) / last <= ratio:
        before += 1
    while before >= 0 and before / last > ratio:
        before -= 1
    if before < nulls:
        return None, distinct
    values = df.select(mark.alias("v")).filter("v IS NOT NULL")
    return _value_at(values, _bounds(values), before - nulls), distinct


def exact_median(df: DataFrame, name: str) -> float | None:
    """Median of a number column; mean of the two middle values for an even count."""
    n = df.agg(F.count(F.when(~F.isnan(F.col(name).cast("double")), F.col(name)))).first()[0]
    if n == 0:
        return None
    middle = [n // 2] if n % 2 else [n // 2 - 1, n // 2]
    found = order_statistics(df, name, middle)
    return float(sum(found) / len(found))


def prefix_sums(df: DataFrame, order: str, sums: list[str], parts: int | None = None) -> DataFrame:
    """Running totals over distinct values of ``order``, ascending, without a global window.

    ``order`` is a number, unique per row (group by it first). Rows are cut into ``parts``
    ranges of equal row count (by default one for every RANGE_ROWS rows); each range sums on its
    own and starts from the total of the ranges before it. Adds ``cum_<name>`` columns, the
    row's own value included.
    """
    parts = parts or max(16, math.ceil(df.count() / RANGE_ROWS))
    steps = [i / parts for i in range(1, parts)]
    cuts = df.agg(F.percentile_approx(F.col(order).cast("double"), steps, 10 * parts)).first()[0] or []
    edges = [-math.inf, *sorted(set(cuts)), math.inf]
    if len(edges) < 3:
        edges.insert(1, 0.0)
    ranged = df.withColumn("_value", F.col(order).cast("double"))
    ranged = Bucketizer(splits=edges, inputCol="_value", outputCol="_part").transform(ranged).drop("_value")
    totals = ranged.groupBy("_part").agg(*[F.sum(c).alias(f"_t_{c}") for c in sums])
    # One row a range, so one task is enough for this window.
    ahead = Window.partitionBy(F.lit(0)).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_part", *[F.coalesce(F.sum(f"_t_{c}").over(ahead), F.lit(0)).alias(f"_o_{c}") for c in sums])
    inside = Window.partitionBy("_part").orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = ranged.join(offsets, "_part")
    out = out.withColumns({f"cum_{c}": F.col(f"_o_{c}") + F.sum(c).over(inside) for c in sums})
    return out.drop("_part", *[f"_o_{c}" for c in sums])
