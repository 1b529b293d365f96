"""Finding hot keys and cutting their time line into pieces.

A window or a group runs as one task per key, and adaptive execution cannot
split it. When one key holds more rows than a task should have, that task decides
the run time of the job. Here such keys are found by counting rows per key, and
their rows get cut points at equal row counts, so that (key, piece) is a unit
of work of a stated size, whatever the size of the data.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SKETCH_ACCURACY = 10_000
GRID_CELLS = 65_536


@dataclass(frozen=True)
class SkewPolicy:
    """A key with more than ``rows`` rows is cut into pieces of about that many.

    No more than one key in ``rows`` rows can be hot, and the cut table has a row for about
    every ``rows`` rows of hot keys: 12 bytes for each 5 million rows of the default.
    """

    rows: int = 5_000_000
    enabled: bool = True


def key_hash(keys: Sequence[str], types: Sequence[T.DataType] = ()) -> Column:
    """Hash of the key columns, cast to ``types`` first: equal keys of other types hash apart."""
    columns = [F.col(k).cast(t) for k, t in zip(keys, types)] if types else [F.col(k) for k in keys]
    return F.xxhash64(*columns)


def common_types(keys: Sequence[str], *frames: DataFrame) -> list[T.DataType]:
    """The types Spark would compare the key columns of the frames in."""
    merged = frames[0].select(*keys)
    for frame in frames[1:]:
        merged = merged.unionByName(frame.select(*keys))
    return [merged.schema[k].dataType for k in keys]


def row_hash(df: DataFrame) -> Column:
    """Hash of a row, over the columns that have one (maps and the like have none).

    Taken from the values, not from the position of the row, so that a task that runs
    again after a lost executor places its rows as before.
    """
    return F.xxhash64(*[F.col(f"`{f.name}`") for f in df.schema.fields if isinstance(f.dataType, T.AtomicType)])


@dataclass(frozen=True)
class Piece:
    """Rows of one hot key from ``start`` to the next start; None = from the beginning.

    ``salts`` > 1 marks a piece that is one single instant too heavy for one task.
    """

    key: int
    index: int
    start: int | float | None
    salts: int


def hot_keys(rows: DataFrame, policy: SkewPolicy) -> dict[int, int]:
    """Values of column ``_key`` with more rows than a piece should have, and their row counts.

    Rows are counted before the shuffle, so a hot key sends one row per task; only hot keys reach the driver.
    """
    counts = rows.groupBy("_key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > policy.rows)
    return {row["_key"]: row["n"] for row in counts.collect()}


def cut_pieces(rows: DataFrame, hot: dict[int, int], policy: SkewPolicy) -> list[Piece]:
    """Pieces of equal row count for each hot key, from columns ``_key`` and ``_ord``."""
    wanted = {k: max(2, math.ceil(n / policy.rows)) for k, n in hot.items()}
    grid = max(wanted.values())
    steps = [i / grid for i in range(1, grid)]
    marks = rows.filter(F.col("_key").isin(list(hot)) & F.col("_ord").isNotNull())
    cuts = marks.groupBy("_key").agg(F.percentile_approx("_ord", steps, max(SKETCH_ACCURACY, 10 * grid)).alias("cuts")).collect()
    found = {row["_key"]: row["cuts"] for row in cuts}
    return [piece for key in hot for piece in _pieces_of(key, found.get(key, []), wanted[key])]


def _pieces_of(key: int, cuts: list, wanted: int) -> list[Piece]:
    """Pieces from the cut points; a value cut more than once becomes its own salted piece."""
    stride = max(1, len(cuts) // wanted)
    chosen = cuts[stride - 1 :: stride]
    pieces = [Piece(key, 0, None, 1)]
    for value in sorted(set(chosen)):
        times = chosen.count(value)
        pieces.append(Piece(key, len(pieces), value, times if times > 1 else 1))
        if times > 1:
            after = value + 1 if isinstance(value, int) else math.nextafter(value, math.inf)
            if after not in chosen:
                pieces.append(Piece(key, len(pieces), after, 1))
    return pieces


def _spans(pieces: list[Piece], whole: bool) -> list[tuple[Piece, int | float, int | float]]:
    """Pieces with their first and last order value, both inside."""
    low, high = (-(2**63), 2**63 - 1) if whole else (-math.inf, math.inf)
    out = []
    for piece, after in zip(pieces, [*pieces[1:], None]):
        last = high
        if after is not None and after.key == piece.key:
            last = after.start - 1 if whole else math.nextafter(after.start, -math.inf)
        out.append((piece, low if piece.start is None else piece.start, last))
    return out


def place(df: DataFrame, pieces: list[Piece], order: Column, order_type: T.DataType, keys: Sequence[str]) -> DataFrame:
    """Add ``_ord``, ``_piece`` (0 for keys that are not hot) and ``_copies`` (null for those).

    The time line is laid over a grid of cells, and a piece is listed under each cell it
    touches. A row then meets only the pieces of its own cell, in a broadcast join whose
    table is bounded by the number of pieces and GRID_CELLS.
    """
    whole = isinstance(order_type, T.IntegralType)
    starts = [p.start for p in pieces if p.start is not None] or [0]
    low, high = min(starts), max(starts)
    cells = max(64, min(4_096, GRID_CELLS // len({p.key for p in pieces})))
    width = ((high - low) // cells + 1) if whole else ((high - low) / cells or 1.0)

    def cell_of(value) -> int:
        return 0 if value <= low else cells - 1 if value >= high else min(cells - 1, int((value - low) // width))

    rows = [
        (p.key, cell, first, last, p.index, p.salts)
        for p, first, last in _spans(pieces, whole)
        for cell in range(cell_of(first), cell_of(last) + 1)
    ]
    kind = "long" if whole else "double"
    table = df.sparkSession.createDataFrame(
        rows, f"_key long, _cell int, _first {kind}, _last {kind}, _place int, _copies int"
    )
    at = F.least(F.greatest(F.col("_ord"), F.lit(low)), F.lit(high)) - F.lit(low)
    cell = F.least(F.floor(at / F.lit(width)).cast("int"), F.lit(cells - 1))
    marked = df.withColumns({"_key": key_hash(keys), "_ord": order}).withColumn("_cell", cell)
    inside = F.col("_ord").between(F.col("_first"), F.col("_last"))
    on = (marked["_key"] == table["_key"]) & (marked["_cell"] == table["_cell"]) & inside
    joined = marked.join(F.broadcast(table), on, "left")
    return joined.select(
        *[marked[c] for c in [*df.columns, "_key", "_ord"]],
        F.coalesce("_place", F.lit(0)).alias("_piece"),
        "_copies",
    )


def left_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], policy: SkewPolicy = SkewPolicy(), counted: DataFrame | None = None
) -> DataFrame:
    """Left join to a side that is unique per key, safe for hot keys on the left.

    Adaptive execution cannot split a join whose side was just aggregated. Here the rows of
    a hot key (a null key counts as one) are spread over salts and its single right row is
    copied to each salt: one copy for every ``policy.rows`` rows. ``counted`` may name a frame with
    the same keys whose plan is cheaper than that of ``left``.
    """
    keys = list(keys)
    if not policy.enabled:
        return left.join(right, keys, "left")
    types = common_types(keys, left, right)
    hot = hot_keys((left if counted is None else counted).select(key_hash(keys, types).alias("_key")), policy)
    if not hot:
        return left.join(right, keys, "left")
    rows = [(k, max(2, math.ceil(n / policy.rows))) for k, n in hot.items()]
    salts = F.broadcast(left.sparkSession.createDataFrame(rows, "_key long, _salts int"))

    def marked(df: DataFrame) -> DataFrame:
        return df.withColumn("_key", key_hash(keys, types)).join(salts, "_key", "left")

    spread = F.coalesce(F.pmod(row_hash(left), F.col("_salts")).cast("int"), F.lit(0))
    copies = F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_salts") - 1, F.lit(0))))
    salted = marked(left).withColumn("_salt", spread).drop("_key", "_salts")
    copied = marked(right).withColumn("_salt", copies).drop("_key", "_salts")
    return salted.join(copied, [*keys, "_salt"], "left").drop("_salt")
