"""Table, CSV and path readers behind one dispatcher."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark.functions.columns import normalize_columns


@dataclass(frozen=True)
class Source:
    """Where raw rows come from.

    ``kind``: ``table`` (catalog name in ``table``), ``csv`` (``path``), ``files``
    (``path`` with ``format``) or ``fallback`` (first readable of ``paths``).
    """

    kind: str
    table: str = ""
    path: str = ""
    paths: Sequence[str] = ()
    format: str = "csv"
    schema: T.StructType | str | None = None
    options: Mapping[str, str] = field(default_factory=lambda: {"header": "true", "inferSchema": "true"})
    normalize: bool = True


def read_source(spark: SparkSession, source: Source) -> DataFrame:
    """Read any source; column names are snake-cased unless switched off."""
    readers = {"table": _read_table, "csv": _read_csv, "files": _read_files, "fallback": _read_first}
    if source.kind not in readers:
        raise ValueError(f"unknown source kind {source.kind!r}; known: {sorted(readers)}")
    df = readers[source.kind](spark, source)
    return normalize_columns(df) if source.normalize else df


def _read_table(spark: SparkSession, source: Source) -> DataFrame:
    if not source.table:
        raise ValueError("source kind 'table' needs a table name")
    return spark.table(source.table)


def _load(spark: SparkSession, source: Source, path: str, fmt: str) -> DataFrame:
    reader = spark.read.format(fmt).options(**source.options)
    if source.schema is not None:
        # A declared schema saves the inference pass over the data.
        reader = reader.schema(source.schema).option("inferSchema", "false")
    return reader.load(path)


def _read_csv(spark: SparkSession, source: Source) -> DataFrame:
    if not source.path:
        raise ValueError("source kind 'csv' needs a path")
    return _load(spark, source, source.path, "csv")


def _read_files(spark: SparkSession, source: Source) -> DataFrame:
    if not source.path:
        raise ValueError("source kind 'files' needs a path")
    return _load(spark, source, source.path, source.format)


def _read_first(spark: SparkSession, source: Source) -> DataFrame:
    """The first location that exists and can be read, in the given order."""
    problems = []
    for path in source.paths:
        try:
            return _load(spark, source, path, source.format)
        except PySparkException as error:
            problems.append(f"{path}: {str(error).splitlines()[0]}")
    raise RuntimeError("no readable location:\n" + "\n".join(problems))


def read_table(
    spark: SparkSession, name: str, filters: str | None = None, columns: Sequence[str] | None = None
) -> DataFrame:
    """Catalog table, filtered, then projected; the filter may use columns that are not kept."""
    return select_filtered(spark.table(name), filters, columns)


def select_filtered(df: DataFrame, filters: str | None = None, columns: Sequence[str] | None = None) -> DataFrame:
    if filters:
        df = df.filter(filters)
    return df.select(*columns) if columns else df


def latest_version(df: DataFrame, version: str = "_version") -> DataFrame:
    """Rows of the highest version in a versioned table."""
    from pyspark.sql import functions as F

    top = df.agg(F.max(version).alias(version))
    return df.join(F.broadcast(top), version, "left_semi")
