"""Row expectations, table checks and declared-schema checks.

Every row-level rule becomes one conditional count, and all of them run in a
single aggregate over the table.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

RESULT_SCHEMA = "name string, passed boolean, violations long, message string"


def violated(expr: str, null_ok: bool = False) -> Column:
    """True where ``expr`` does not hold. A null result is a violation unless ``null_ok``."""
    return ~F.coalesce(F.expr(expr).cast("boolean"), F.lit(null_ok))


# --- expectations -----------------------------------------------------------


@dataclass(frozen=True)
class Expectation:
    """A named row rule. ``action``: warn keeps the row, drop removes it, fail stops the job."""

    name: str
    expr: str
    action: str = "warn"

    def __post_init__(self):
        if self.action not in ("warn", "drop", "fail"):
            raise ValueError(f"unknown action {self.action!r}")


def keep_valid(df: DataFrame, expectations: Sequence[Expectation]) -> DataFrame:
    """Rows that meet every drop rule; rows that break a fail rule raise when they are read."""
    out = df
    for rule in expectations:
        if rule.action == "drop":
            out = out.filter(~violated(rule.expr))
    for rule in expectations:
        if rule.action == "fail":
            stop = F.raise_error(F.lit(f"expectation failed: {rule.name}")).cast("boolean")
            out = out.filter(F.when(violated(rule.expr), stop).otherwise(F.lit(True)))
    return out


def _counts(expectations: Sequence[Expectation]) -> list[Column]:
    """All rows, and the violations of each rule."""
    failed = [F.count_if(violated(rule.expr)).alias(f"_v{i}") for i, rule in enumerate(expectations)]
    return [F.count(F.lit(1)).alias("_n"), *failed]


def expectation_metrics(df: DataFrame, expectations: Sequence[Expectation]) -> DataFrame:
    """One row per rule: name, action, passed and failed records, from one pass over ``df``."""
    counted = df.agg(*_counts(expectations))
    rows = [
        F.struct(
            F.lit(rule.name).alias("name"),
            F.lit(rule.action).alias("action"),
            (F.col("_n") - F.col(f"_v{i}")).alias("passed_records"),
            F.col(f"_v{i}").alias("failed_records"),
        )
        for i, rule in enumerate(expectations)
    ]
    return counted.select(F.inline(F.array(*rows)))


METRICS_SCHEMA = "name string, action string, passed_records long, failed_records long"


def observed(df: DataFrame, expectations: Sequence[Expectation], observation: Observation | str) -> DataFrame:
    """The kept rows, counted as they pass: whatever reads them also counts all incoming rows and every rule's violations.

    With an ``Observation`` its ``get`` has the counts after the action; with a name they stand
    in the progress of a stream. The optimizer may not move filters below the counts.
    """
    return keep_valid(df.observe(observation, *_counts(expectations)), expectations)


def observed_metrics(spark: SparkSession, found: Mapping[str, int], expectations: Sequence[Expectation]) -> DataFrame:
    """The rows of ``expectation_metrics`` from observed counts."""
    rows = [(r.name, r.action, found["_n"] - found[f"_v{i}"], found[f"_v{i}"]) for i, r in enumerate(expectations)]
    return spark.createDataFrame(rows, METRICS_SCHEMA)


def write_expected(
    df: DataFrame, expectations: Sequence[Expectation], write: Callable[[DataFrame], None]
) -> DataFrame:
    """Write the kept rows by ``write`` and return the metrics, in one pass over ``df``."""
    seen = Observation()
    write(observed(df, expectations, seen))
    return observed_metrics(df.sparkSession, seen.get, expectations)


def expect(df: DataFrame, expectations: Sequence[Expectation]) -> tuple[DataFrame, DataFrame]:
    """(kept rows, metrics over all incoming rows)."""
    return keep_valid(df, expectations), expectation_metrics(df, expectations)


# --- table checks -----------------------------------------------------------


@dataclass(frozen=True)
class Check:
    """A table check: either a row rule to count (``violation``) or composite uniqueness (``unique``)."""

    name: str
    violation: Column | None = None
    unique: Sequence[str] = ()
    failed_text: str = ""
    passed_text: str = ""

    def message(self, count: Column) -> Column:
        before, _, after = self.failed_text.partition("{n}")
        failed = F.concat(F.lit(before), count.cast("string"), F.lit(after))
        return F.when(count > 0, failed).otherwise(F.lit(self.passed_text))


# The names and messages of the checks below, which callers compare with.


def no_nulls(column: str) -> Check:
    return Check(
        f"{column}_no_nulls",
        F.col(column).isNull(),
        failed_text=f"Found {{n}} nulls in '{column}'",
        passed_text=f"No nulls in '{column}'",
    )


def allowed_values(column: str, values: Sequence[object]) -> Check:
    """Nulls pass."""
    return Check(
        f"{column}_allowed_values",
        F.coalesce(~F.col(column).isin(list(values)), F.lit(False)),
        failed_text=f"Found {{n}} invalid values for '{column}'",
        passed_text=f"All values valid in '{column}'",
    )


def in_range(column: str, low: float, high: float) -> Check:
    """Both ends count as inside; nulls pass."""
    return Check(
        f"{column}_range",
        F.coalesce(~F.col(column).between(low, high), F.lit(False)),
        failed_text=f"Found {{n}} values out of bounds [{low}, {high}] in '{column}'",
        passed_text=f"All values in range for '{column}'",
    )


def sql_check(name: str, expr: str, null_ok: bool = False) -> Check:
    """A condition every row must meet; a null result fails unless ``null_ok``."""
    return Check(
        name,
        violated(expr, null_ok),
        failed_text=f"Found {{n}} rows failing expression: {expr}",
        passed_text=f"All rows passed expression: {expr}",
    )


def unique(*columns: str) -> Check:
    """No two rows share the column values; null is one value."""
    return Check(f"{'_'.join(columns)}_is_unique", unique=columns)


def uniqueness(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: total rows and distinct keys. Pre-aggregated, one shuffle of the distinct keys."""
    per_key = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("total"), F.count(F.lit(1)).alias("distinct_keys"))


def _row_results(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    counted = df.agg(*[F.count_if(c.violation).alias(f"_v{i}") for i, c in enumerate(checks)])
    rows = [
        F.struct(
            F.lit(c.name).alias("name"),
            (F.col(f"_v{i}") == 0).alias("passed"),
            F.col(f"_v{i}").alias("violations"),
            c.message(F.col(f"_v{i}")).alias("message"),
        )
        for i, c in enumerate(checks)
    ]
    return counted.select(F.inline(F.array(*rows)))


def _unique_result(df: DataFrame, check: Check) -> DataFrame:
    extra = F.col("total") - F.col("distinct_keys")
    text = F.format_string("Total: %d, Distinct: %d", "total", "distinct_keys")
    return uniqueness(df, check.unique).select(
        F.lit(check.name).alias("name"), (extra == 0).alias("passed"), extra.alias("violations"), text.alias("message")
    )


def _analysis_error(df: DataFrame, check: Check) -> str | None:
    """Message when the check does not fit the table (an absent column, a bad expression)."""
    try:
        df.select(*check.unique) if check.unique else df.select(check.violation)
    except PySparkException as error:
        return f"Exception: {str(error).splitlines()[0]}"
    return None


def run_checks(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """One row per check: name, passed, violations, message.

    Row rules share one aggregate; each uniqueness check adds one grouped count.
    A check that does not fit the table is a failed check, not an error.
    """
    errors = {c.name: _analysis_error(df, c) for c in checks}
    sound = [c for c in checks if errors[c.name] is None]
    parts = []
    if any(not c.unique for c in sound):
        parts.append(_row_results(df, [c for c in sound if not c.unique]))
    parts += [_unique_result(df, c) for c in sound if c.unique]
    broken = [(name, False, None, text) for name, text in errors.items() if text is not None]
    if broken or not parts:
        parts.append(df.sparkSession.createDataFrame(broken, RESULT_SCHEMA))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def validate(df: DataFrame, checks: Sequence[Check], raise_on_fail: bool = True) -> tuple[bool, list]:
    """Run the checks now. Returns (all passed, result rows); raises with every failed check listed.

    If a rule breaks at run time, the checks are repeated one by one so that only the broken one fails.
    """
    try:
        results = run_checks(df, checks).collect()
    except PySparkException:
        results = []
        for check in checks:
            try:
                results += run_checks(df, [check]).collect()
            except PySparkException as error:
                text = f"Exception: {str(error).splitlines()[0]}"
                results += df.sparkSession.createDataFrame([(check.name, False, None, text)], RESULT_SCHEMA).collect()
    order = {c.name: i for i, c in enumerate(checks)}
    results = sorted(results, key=lambda r: order[r["name"]])
    failed = [r for r in results if not r["passed"]]
    if failed and raise_on_fail:
        lines = "\n".join(f"- {r['name']}: {r['message']}" for r in failed)
        raise ValueError(f"{len(failed)} data checks failed:\n{lines}")
    return not failed, results


def primary_key_report(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """What a primary key demands: no null in any key column, and unique together."""
    return run_checks(df, [*[no_nulls(k) for k in keys], unique(*keys)])


# --- declared schema --------------------------------------------------------


@dataclass(frozen=True)
class ColumnRule:
    """Declared type and limits of a column. Types are coerced before the limits are tested."""

    name: str
    type: str | None = "string"
    nullable: bool = True
    min_length: int | None = None
    allowed: Sequence[object] | None = None
    at_least: float | None = None
    at_most: float | None = None

    def violations(self) -> list[tuple[str, Column]]:
        raw = F.col(self.name)
        value = raw if self.type is None else raw.try_cast(self.type)
        found = [("coercible", raw.isNotNull() & value.isNull())] if self.type not in (None, "string") else []
        if not self.nullable:
            found.append(("not_null", raw.isNull()))
        if self.min_length is not None:
            found.append((f"str_length>={self.min_length}", F.length(value.cast("string")) < self.min_length))
        if self.allowed is not None:
            texts = sorted({str(v) for v in self.allowed})
            found.append(("isin", ~value.cast("string").isin(texts)))
        number = raw.try_cast("double")
        if self.at_least is not None:
            found.append((f">={self.at_least}", number < self.at_least))
        if self.at_most is not None:
            found.append((f"<={self.at_most}", number > self.at_most))
        return [(rule, F.coalesce(test, F.lit(False))) for rule, test in found]


def schema_report(df: DataFrame, rules: Sequence[ColumnRule]) -> DataFrame:
    """Violations per (column, rule) over the whole table in one pass; extra columns are allowed."""
    present = {f.name for f in df.schema.fields}
    tests, fixed = [], []
    for rule in rules:
        if rule.name in present:
            tests += [(rule.name, text, test) for text, test in rule.violations()]
        fixed.append((rule.name, "present", 0 if rule.name in present else 1))
    counted = df.agg(F.lit(1).alias("_one"), *[F.count_if(t).alias(f"_v{i}") for i, (_, _, t) in enumerate(tests)])
    rows = [
        F.struct(F.lit(c).alias("column_name"), F.lit(r).alias("rule"), F.col(f"_v{i}").alias("violations"))
        for i, (c, r, _) in enumerate(tests)
    ]
    rows += [
        F.struct(F.lit(c).alias("column_name"), F.lit(r).alias("rule"), F.lit(n).cast("long").alias("violations"))
        for c, r, n in fixed
    ]
    return counted.select(F.inline(F.array(*rows)))


def check_schema(df: DataFrame, rules: Sequence[ColumnRule]) -> None:
    """Raise with all schema failures together."""
    failed = schema_report(df, rules).filter("violations > 0").orderBy("column_name", "rule").collect()
    if failed:
        lines = "\n".join(f"- {r['column_name']} {r['rule']}: {r['violations']} rows" for r in failed)
        raise ValueError(f"schema check failed:\n{lines}")
