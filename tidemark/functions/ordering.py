"""Mapping of time and number columns to plain ordered values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def order_value(name: str, dtype: T.DataType) -> Column:
    """Long or double with the same order as column ``name``.

    Wall-clock timestamps go through interval parts, not through the session
    time zone, because zone gaps would break the order.
    """
    col = F.col(name)
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(col)
    if isinstance(dtype, T.TimestampNTZType):
        span = col - F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'")

        def part(unit: str) -> Column:
            return F.extract(F.lit(unit), span)

        seconds = part("DAY") * F.lit(86_400).cast("long") + part("HOUR") * 3_600 + part("MINUTE") * 60
        return seconds.cast("long") * 1_000_000 + (part("SECOND") * 1_000_000).cast("long")
    if isinstance(dtype, T.DateType):
        return F.unix_date(col).cast("long")
    if isinstance(dtype, T.IntegralType):
        return col.cast("long")
    if isinstance(dtype, T.NumericType):
        return col.cast("double")
    raise TypeError(f"column {name} of type {dtype.simpleString()} has no order value")
