"""Cleaning and feature expressions. All are native columns: no Python worker runs."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Names the snake-case rule gets wrong for the customer data set.
KNOWN_RENAMES = {
    "streaming_t_v": "streaming_tv",
    "customer_i_d": "customer_id",
}

BLANKS = " \t\n\r\x0b\x0c"


def snake_case(name: str, renames: Mapping[str, str] = KNOWN_RENAMES) -> str:
    """``Payment Method`` -> ``payment_method``, ``StreamingTV`` -> ``streaming_tv``."""
    spaced = re.sub(r"([a-z0-9])([A-Z])", r"\1_\2", name).lower()
    words = re.split(r"[ _-]+", spaced.replace("(", "").replace(")", ""))
    joined = "_".join(w for w in words if w)
    return renames.get(joined, joined)


def normalize_columns(df: DataFrame, renames: Mapping[str, str] = KNOWN_RENAMES) -> DataFrame:
    """Snake-case every column in one projection; two columns with one name are an error."""
    names = [snake_case(c, renames) for c in df.columns]
    clashes = sorted({n for n in names if names.count(n) > 1})
    if clashes:
        raise ValueError(f"columns collide after renaming: {clashes}")
    return df.toDF(*names)


def count_flags(columns: Sequence[str], value: str = "Yes") -> Column:
    """How many of ``columns`` equal ``value``, as double; null counts as no."""
    total = F.lit(0.0)
    for name in columns:
        total = total + F.coalesce((F.col(name) == F.lit(value)).cast("double"), F.lit(0.0))
    return total


def recode(name: str, mapping: Mapping[str, str]) -> Column:
    """Replace values by ``mapping`` on their text form; anything else becomes null."""
    text = F.col(name).cast("string")
    out = F.lit(None).cast("string")
    for old, new in mapping.items():
        out = F.when(text == F.lit(old), F.lit(new)).otherwise(out)
    return out


def parse_number(name: str, strict: bool = True, blank: float = 0.0) -> Column:
    """Text to double. Blank or null gives ``blank``.

    Text that is no number raises in strict mode and gives ``blank`` otherwise.
    """
    text = F.btrim(F.col(name).cast("string"), F.lit(BLANKS))
    number = text.try_cast("double")
    if strict:
        problem = F.concat(F.lit(f"not a number in {name}: "), text)
        number = F.coalesce(number, F.raise_error(problem).cast("double"))
    else:
        number = F.coalesce(number, F.lit(blank))
    return F.when(F.coalesce(text, F.lit("")) == "", F.lit(blank)).otherwise(number)


def to_number(name: str) -> Column:
    """Double, or null for anything that is not a number."""
    return F.btrim(F.col(name).cast("string"), F.lit(BLANKS)).try_cast("double")


def filled(column: Column, dtype: T.DataType, value: object) -> Column:
    """``column`` with null (and NaN for floats) replaced by ``value``."""
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        column = F.when(F.isnan(column), F.lit(None)).otherwise(column)
    return F.coalesce(column, F.lit(value).cast(dtype))


def fill_missing(df: DataFrame, constants: Mapping[str, object]) -> DataFrame:
    """Null and NaN replaced per column, types kept."""
    return df.withColumns(
        {name: filled(F.col(name), df.schema[name].dataType, value) for name, value in constants.items()}
    )


@dataclass(frozen=True)
class CleaningRules:
    """What ``clean`` does: recodes, then text parsing, then null filling."""

    recodes: Mapping[str, Mapping[str, str]]
    numbers: Sequence[str] = ()
    fills: Mapping[str, object] = None
    strict: bool = True


def clean(df: DataFrame, rules: CleaningRules) -> DataFrame:
    """The whole cleaning step as one projection."""
    fills = rules.fills or {}
    out = []
    for field in df.schema.fields:
        column, dtype = F.col(field.name), field.dataType
        if field.name in rules.recodes:
            column, dtype = recode(field.name, rules.recodes[field.name]), T.StringType()
        if field.name in rules.numbers:
            column, dtype = parse_number(field.name, rules.strict), T.DoubleType()
        if field.name in fills:
            column = filled(column, dtype, fills[field.name])
        out.append(column.alias(field.name))
    return df.select(*out)


def snapshot_column(at: dt.datetime | None = None, wall_clock: bool = False) -> Column:
    """One timestamp for the whole snapshot; ``at`` makes runs repeatable."""
    column = F.lit(at if at is not None else dt.datetime.now(dt.timezone.utc))
    return column.cast("timestamp_ntz" if wall_clock else "timestamp")


def add_snapshot(
    df: DataFrame, at: dt.datetime | None = None, name: str = "transaction_ts", wall_clock: bool = False
) -> DataFrame:
    return df.withColumn(name, snapshot_column(at, wall_clock))


def add_literals(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Constant columns such as model name, version and inference time."""
    return df.withColumns({name: v if isinstance(v, Column) else F.lit(v) for name, v in values.items()})


def select_except(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """``SELECT * EXCEPT``: unlike ``drop``, a name that is absent is an error."""
    names = list(names)
    absent = [n for n in names if n not in df.columns]
    if absent:
        raise ValueError(f"no such columns: {absent}")
    return df.drop(*names)


def filter_split(df: DataFrame, predicate: str, split_col: str = "split") -> DataFrame:
    """Rows of one split, without the split column."""
    return df.filter(predicate).drop(split_col)


def ordered_limit(df: DataFrame, n: int, *order: str) -> DataFrame:
    """First ``n`` rows in key order (a top-k, so no full sort)."""
    return df.orderBy(*order).limit(n)


@dataclass(frozen=True)
class SqlFunction:
    """A named scalar SQL function. Spark inlines its body into the calling plan."""

    name: str
    params: Sequence[tuple[str, str]]
    returns: str
    body: str

    def register(self, spark: SparkSession, temporary: bool = True) -> None:
        args = ", ".join(f"{n} {t}" for n, t in self.params)
        kind = "CREATE OR REPLACE TEMPORARY FUNCTION" if temporary else "CREATE OR REPLACE FUNCTION"
        spark.sql(f"{kind} {self.name}({args}) RETURNS {self.returns} RETURN {self.body}")


# Price paid above the average of the tenure so far; 0 without tenure.
AVG_PRICE_INCREASE = SqlFunction(
    name="avg_price_increase",
    params=(("monthly_charges_in", "DOUBLE"), ("tenure_in", "DOUBLE"), ("total_charges_in", "DOUBLE")),
    returns="FLOAT",
    body="CASE WHEN tenure_in > 0 THEN monthly_charges_in - total_charges_in / tenure_in ELSE 0 END",
)


@dataclass(frozen=True)
class FeatureFunction:
    """A function bound to columns: ``bindings`` maps each argument to a column."""

    function: SqlFunction
    bindings: Mapping[str, str]
    output: str

    def apply(self, df: DataFrame) -> DataFrame:
        unbound = [n for n, _ in self.function.params if n not in self.bindings]
        if unbound:
            raise ValueError(f"{self.function.name}: no column bound to {unbound}")
        self.function.register(df.sparkSession)
        args = [F.col(self.bindings[n]).cast(t) for n, t in self.function.params]
        return df.withColumn(self.output, F.call_function(self.function.name, *args))
