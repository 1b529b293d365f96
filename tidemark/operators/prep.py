"""Imputing, scaling and one-hot encoding, fitted by aggregates and applied as expressions.

``fit`` runs one aggregate for all numeric columns and one value count for all
category columns. What it learns is small (a few numbers and the category lists),
so it lives on the driver and can be saved as JSON. ``transform`` is a projection.
"""

from __future__ import annotations

import json
import re
from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass, field

from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import to_number
from tidemark.operators.ranking import exact_median
from tidemark.session import scratch_path

# The column groups of the customer churn table.
CHURN_BOOLEANS = ["gender", "phone_service", "dependents", "senior_citizen", "paperless_billing", "partner"]
CHURN_NUMBERS = ["monthly_charges", "total_charges", "avg_price_increase", "tenure", "num_optional_services"]
CHURN_CATEGORIES = [
    "contract",
    "device_protection",
    "internet_service",
    "multiple_lines",
    "online_backup",
    "online_security",
    "payment_method",
    "streaming_movies",
    "streaming_tv",
    "tech_support",
]


@dataclass(frozen=True)
class PrepSpec:
    """Column groups and options.

    Number strategies: mean, median, constant, most_frequent. Category strategies:
    most_frequent, constant. ``remainder`` says what happens to other columns: drop
    or passthrough. ``handle_unknown``: ignore gives all zeros, error raises.
    ``max_categories`` can guard against encoding an id column: exceeding it raises. There is no limit
    unless one is given.
    """

    booleans: Sequence[str] = ()
    numbers: Sequence[str] = ()
    categories: Sequence[str] = ()
    boolean_strategy: str = "most_frequent"
    drop_first: bool = True
    number_strategy: str = "mean"
    scale: bool = True
    category_strategy: str = "most_frequent"
    handle_unknown: str = "ignore"
    fill_value: object = None
    remainder: str = "drop"
    max_categories: int | None = None


def churn_spec(**overrides: object) -> PrepSpec:
    """The churn column groups; any group or option can be replaced."""
    groups = {"booleans": CHURN_BOOLEANS, "numbers": CHURN_NUMBERS, "categories": CHURN_CATEGORIES}
    return PrepSpec(**{**groups, **overrides})


@dataclass(frozen=True)
class FittedPrep:
    """Learned parameters: number column -> (fill, mean, scale), category column -> (fill, values)."""

    spec: PrepSpec
    numbers: Mapping[str, tuple[float, float, float]] = field(default_factory=dict)
    categories: Mapping[str, tuple[str | None, list[str]]] = field(default_factory=dict)

    def dummy_values(self, column: str) -> list[str]:
        values = self.categories[column][1]
        return values[1:] if column in self.spec.booleans and self.spec.drop_first else values

    def feature_names(self) -> list[str]:
        names = [dummy_name(c, v) for c in self.spec.booleans for v in self.dummy_values(c)]
        names += list(self.spec.numbers)
        return names + [dummy_name(c, v) for c in self.spec.categories for v in self.dummy_values(c)]

    def columns(self) -> list[Column]:
        out = [d for c in self.spec.booleans for d in self._dummies(c)]
        for name in self.spec.numbers:
            fill, mean, scale = self.numbers[name]
            number = _finite(name)
            out.append(((F.coalesce(number, F.lit(fill)) - F.lit(mean)) / F.lit(scale)).alias(name))
        return out + [d for c in self.spec.categories for d in self._dummies(c)]

    def _dummies(self, name: str) -> list[Column]:
        fill, values = self.categories[name]
        text = F.coalesce(F.col(name).cast("string"), F.lit(fill))
        if self.spec.handle_unknown == "error":
            message = F.concat(F.lit(f"unknown category in {name}: "), text)
            text = F.when(text.isin(values), text).otherwise(F.raise_error(message).cast("string"))
        return [
            F.coalesce((text == F.lit(v)).cast("double"), F.lit(0.0)).alias(dummy_name(name, v))
            for v in self.dummy_values(name)
        ]

    def transform(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """Encoded columns after ``keep`` (and, with passthrough, all columns outside the groups)."""
        spec = self.spec
        grouped = {*spec.booleans, *spec.numbers, *spec.categories}
        rest = [c for c in df.columns if c not in grouped and c not in keep] if spec.remainder == "passthrough" else []
        return df.select(*keep, *self.columns(), *rest)

    def assemble(self, df: DataFrame, keep: Sequence[str] = (), output: str = "features") -> DataFrame:
        """``keep`` plus one vector column in the order of ``feature_names``."""
        wide = df.select(*keep, *self.columns())
        vector = VectorAssembler(inputCols=self.feature_names(), outputCol=output)
        return vector.transform(wide).select(*keep, output)

    def with_vector(self, df: DataFrame, output: str = "features") -> DataFrame:
        """All columns of ``df`` and the vector."""
        wide = df.select("*", *[c.alias(f"_x{i}") for i, c in enumerate(self.columns())])
        names = [f"_x{i}" for i in range(len(self.feature_names()))]
        return VectorAssembler(inputCols=names, outputCol=output).transform(wide).drop(*names)

    def to_json(self) -> str:
        return json.dumps({"spec": asdict(self.spec), "numbers": self.numbers, "categories": self.categories})

    @staticmethod
    def from_json(text: str) -> FittedPrep:
        state = json.loads(text)
        return FittedPrep(PrepSpec(**state["spec"]), state["numbers"], state["categories"])


def dummy_name(column: str, value: str) -> str:
    """Column name for one category; characters other than letters and digits become ``_``."""
    return f"{column}_{re.sub(r'[^0-9A-Za-z]+', '_', value)}"


def _finite(name: str) -> Column:
    number = to_number(name)
    return F.when(~F.isnan(number), number)


def fit(df: DataFrame, spec: PrepSpec) -> FittedPrep:
    fitted = FittedPrep(spec, _fit_numbers(df, spec), _fit_categories(df, spec))
    names = fitted.feature_names()
    clashes = sorted({n for n in names if names.count(n) > 1})
    if clashes:
        raise ValueError(f"encoded columns collide: {clashes}")
    return fitted


def _fit_numbers(df: DataFrame, spec: PrepSpec) -> dict[str, tuple[float, float, float]]:
    if not spec.numbers:
        return {}
    facts = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[
            a
            for i, c in enumerate(spec.numbers)
            for a in (
                F.count(_finite(c)).alias(f"n{i}"),
                F.avg(_finite(c)).alias(f"mean{i}"),
                F.var_pop(_finite(c)).alias(f"var{i}"),
            )
        ],
    ).first()
    out = {}
    for i, name in enumerate(spec.numbers):
        rows, n = facts["rows"], facts[f"n{i}"]
        mean, var = facts[f"mean{i}"] or 0.0, facts[f"var{i}"] or 0.0
        fill = _number_fill(df, name, mean, spec)
        if not spec.scale or rows == 0:
            out[name] = (fill, 0.0, 1.0)
            continue
        # Mean and population variance of the column after filling, in closed form.
        after = (n * mean + (rows - n) * fill) / rows
        spread = (n * (var + (mean - after) ** 2) + (rows - n) * (fill - after) ** 2) / rows
        out[name] = (fill, after, spread**0.5 or 1.0)
    return out


def _number_fill(df: DataFrame, name: str, mean: float, spec: PrepSpec) -> float:
    if spec.number_strategy == "mean":
        return mean
    if spec.number_strategy == "constant":
        return float(spec.fill_value or 0.0)
    numbers = df.select(_finite(name).alias("v"))
    if spec.number_strategy == "median":
        found = exact_median(numbers, "v")
    elif spec.number_strategy == "most_frequent":
        counts = numbers.filter("v IS NOT NULL").groupBy("v").agg(F.count(F.lit(1)).alias("n"))
        found = counts.agg(F.min(F.struct(-F.col("n"), "v"))["v"]).first()[0]
    else:
        raise ValueError(f"unknown strategy {spec.number_strategy!r}")
    return 0.0 if found is None else float(found)


def _fit_categories(df: DataFrame, spec: PrepSpec) -> dict[str, tuple[str | None, list[str]]]:
    names = [*spec.booleans, *spec.categories]
    if not names:
        return {}
    pairs = [F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in names]
    counts = (
        df.select(F.inline(F.array(*pairs)))
        .filter(F.col("value").isNotNull())
        .groupBy("column_name", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    # The values are parameters of the fitted encoder, one output column each. Where a limit is set, one row
    # more per column shows that a column is too wide; the rank filter is applied before the shuffle
    # (window group limit), so such a column never sends all its values.
    if spec.max_categories is not None:
        place = F.row_number().over(Window.partitionBy("column_name").orderBy(F.desc("n"), "value"))
        counts = counts.withColumn("place", place).filter(F.col("place") <= spec.max_categories + 1).drop("place")
    rows = counts.collect()
    out: dict[str, tuple[str | None, list[str]]] = {}
    for name in names:
        found = sorted((-r["n"], r["value"]) for r in rows if r["column_name"] == name)
        if spec.max_categories is not None and len(found) > spec.max_categories:
            raise ValueError(f"{name} has more than {spec.max_categories} categories")
        strategy = spec.boolean_strategy if name in spec.booleans else spec.category_strategy
        if strategy == "constant":
            fill = str(spec.fill_value if spec.fill_value is not None else "missing_value")
        elif strategy == "most_frequent":
            fill = found[0][1] if found else None
        else:
            raise ValueError(f"unknown strategy {strategy!r}")
        values = {v for _, v in found}
        out[name] = (fill, sorted(values | {fill} if strategy == "constant" else values))
    return out


# --- wide categories ----------------------------------------------------------


@dataclass(frozen=True)
class WidePrep:
    """An encoder for columns of any number of values, into one sparse vector.

    The values and their places are a written table (``column_name, value, place``), joined to
    the rows; only their number per column and the fill are on the driver. The vector has the
    order of ``FittedPrep``: booleans, numbers, categories, the values of a column in order.
    """

    spec: PrepSpec
    dictionary: str
    sizes: Mapping[str, int]
    fills: Mapping[str, str | None]
    numbers: Mapping[str, tuple[float, float, float]] = field(default_factory=dict)

    def _first(self, name: str) -> int:
        """Values at the front of a column that have no place in the vector."""
        return int(name in self.spec.booleans and self.spec.drop_first)

    def size(self) -> int:
        """Length of the vector."""
        return len(self.spec.numbers) + sum(max(0, n - self._first(c)) for c, n in self.sizes.items())

    def values(self, spark) -> DataFrame:
        return spark.read.parquet(self.dictionary)

    def indexed(self, df: DataFrame, suffix: str = "_index") -> DataFrame:
        """All columns of ``df`` and the place of the value of each category column; null for a value that is not known.

        One join per column: a small dictionary is broadcast by adaptive execution, and where
        it is not, a value that most rows have is split, as the dictionary is a stored table.
        """
        known = self.values(df.sparkSession)
        for name in [*self.spec.booleans, *self.spec.categories]:
            own = known.filter(F.col("column_name") == name)
            own = own.select(F.col("value").alias("_value"), F.col("place").alias(name + suffix))
            text = F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(self.fills[name]))
            df = df.withColumn("_text", text).join(own, F.col("_text") == F.col("_value"), "left").drop("_text", "_value")
            if self.spec.handle_unknown == "error":
                message = F.concat(F.lit(f"unknown category in {name}: "), text)
                place = F.when(F.col(name + suffix).isNull() & text.isNotNull(), F.raise_error(message).cast("long"))
                df = df.withColumn(name + suffix, place.otherwise(F.col(name + suffix)))
        return df

    def with_vector(self, df: DataFrame, output: str = "features") -> DataFrame:
        """All columns of ``df`` and the sparse vector."""
        coded = [c for c in [*self.spec.booleans, *self.spec.categories] if self.sizes[c] > self._first(c)]
        rows = self.indexed(df, "_place")
        for c in coded:  # a place beyond the last one is no value: all zeros
            place = F.col(c + "_place") - self._first(c)
            rows = rows.withColumn(f"_i_{c}", F.when(place >= 0, place).otherwise(self.sizes[c] - self._first(c)).cast("double"))
        for c in self.spec.numbers:
            fill, mean, scale = self.numbers[c]
            rows = rows.withColumn(f"_n_{c}", (F.coalesce(_finite(c), F.lit(fill)) - F.lit(mean)) / F.lit(scale))
        if coded:
            last = df.sparkSession.createDataFrame([[float(self.sizes[c] - self._first(c) - 1) for c in coded]], [f"_i_{c}" for c in coded])
            encoder = OneHotEncoder(inputCols=[f"_i_{c}" for c in coded], outputCols=[f"_v_{c}" for c in coded], handleInvalid="keep")
            rows = encoder.fit(last).transform(rows)
        parts = [f"_v_{c}" for c in self.spec.booleans if c in coded] + [f"_n_{c}" for c in self.spec.numbers]
        parts += [f"_v_{c}" for c in self.spec.categories if c in coded]
        return VectorAssembler(inputCols=parts, outputCol=output).transform(rows).select(*df.columns, output)

    def assemble(self, df: DataFrame, keep: Sequence[str] = (), output: str = "features") -> DataFrame:
        return self.with_vector(df, output).select(*keep, output)

    def to_json(self) -> str:
        return json.dumps({**asdict(self), "spec": asdict(self.spec)})

    @staticmethod
    def from_json(text: str) -> WidePrep:
        state = json.loads(text)
        return WidePrep(**{**state, "spec": PrepSpec(**state["spec"])})


def fit_wide(df: DataFrame, spec: PrepSpec, path: str | None = None) -> WidePrep:
    """Fit an encoder whose values stay in a table, at ``path`` or in the scratch folder.

    Places come from sorting the distinct values over all tasks: what reaches the driver is the
    number of values per column and task, never a value beyond the fill of each column.
    """
    spark, names = df.sparkSession, [*spec.booleans, *spec.categories]
    path = path or scratch_path(spark, "dictionary")
    if spec.remainder == "passthrough" or spec.max_categories is not None:
        raise ValueError("wide encoders have neither a remainder nor a limit")
    pairs = [F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").cast("string").alias("value")) for c in names]
    counts = (
        df.select(F.inline(F.array(*pairs))).filter("value IS NOT NULL").groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))
        if names
        else spark.createDataFrame([], "column_name string, value string, n long")
    )
    fills: dict[str, str | None] = dict.fromkeys(names)
    for kind, columns in ((spec.boolean_strategy, spec.booleans), (spec.category_strategy, spec.categories)):
        if kind not in ("most_frequent", "constant"):
            raise ValueError(f"unknown strategy {kind!r}")
        if kind == "constant":
            fills |= dict.fromkeys(columns, str(spec.fill_value if spec.fill_value is not None else "missing_value"))
    stored = scratch_path(spark, "values")
    counts.write.parquet(stored)
    counts = spark.read.schema(counts.schema).parquet(stored)
    frequent = [c for c in names if fills[c] is None]
    for row in counts.filter(F.col("column_name").isin(frequent)).groupBy("column_name").agg(
        F.min(F.struct(-F.col("n"), "value"))["value"].alias("value")
    ).collect():
        fills[row["column_name"]] = row["value"]
    constant = [(c, v) for c, v in fills.items() if c not in frequent]
    values = counts.select("column_name", "value")
    if constant:
        values = values.unionByName(spark.createDataFrame(constant, values.schema)).distinct()
    # The order of the whole table, and of a row in its task; a task's rows follow those of the tasks before it.
    ordered = values.repartitionByRange("column_name", "value").sortWithinPartitions("column_name", "value")
    numbered = scratch_path(spark, "numbered")
    ordered.withColumn("row", F.monotonically_increasing_id()).write.parquet(numbered)
    rows = spark.read.schema("column_name string, value string, row long").parquet(numbered)
    part = F.shiftright("row", 33)
    sizes: dict[str, int] = dict.fromkeys(names, 0)
    starts = []
    tasks = rows.groupBy("column_name", part.alias("part")).agg(F.count(F.lit(1)).alias("n"), F.min("row").alias("first"))
    for r in tasks.orderBy("column_name", "part").collect():  # a row per column and task
        starts.append((r["column_name"], r["part"], sizes[r["column_name"]] - r["first"]))
        sizes[r["column_name"]] += r["n"]
    shift = spark.createDataFrame(starts, "column_name string, part long, shift long")
    placed = rows.withColumn("part", part.cast("long")).join(F.broadcast(shift), ["column_name", "part"])
    placed.select("column_name", "value", (F.col("row") + F.col("shift")).alias("place")).write.parquet(path)
    return WidePrep(spec, path, sizes, fills, _fit_numbers(df, spec))
