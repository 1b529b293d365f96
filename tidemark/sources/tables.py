"""Catalog tables: writes, keyed merges, versions, properties and schemas.

Plain file tables cannot be merged in place. Here each state of a keyed table is a
``_version=N`` folder beside the schema's tables, and one ``ALTER TABLE .. SET LOCATION``
makes a finished folder the current one: readers see the old state or the new one, and a
crash at any moment leaves one of them. A number is taken once, whether its write was
finished or not. The newest states stay readable.

A table may be divided into buckets by a hash of its key (column ``_bucket``, a partition).
Then a state's folder holds only the buckets that it changed, and the others stay where they
are: each partition of the table has a location of its own.

Two writers can't both follow the same state. Before the switch a writer leaves the mark
``_after-N`` with the number of its own state; only one can, and the other plans its merge
again on what the first one wrote. A mark whose writer ended before the switch is followed
by whoever comes next. Tables of a format with row-level changes are merged by it.
"""

from __future__ import annotations

import json
import re
import time
import uuid
from collections.abc import Callable, Mapping, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import quality
from tidemark.operators.merge import Combine, merge_frames

KEYS, TIME, BASE, BUCKETS = "tidemark.keys", "tidemark.time", "tidemark.base", "tidemark.buckets"
#: Column with the bucket of a row, in tables that have buckets.
BUCKET = "_bucket"
#: States of a keyed table that are kept, the current one included.
RETAINED = 5
#: Times a merge is planned again because another writer was first, and seconds after which an unfinished mark is void.
ATTEMPTS, VOID_AFTER = 100, 60.0


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


# --- plain writes -----------------------------------------------------------


def write_table(
    df: DataFrame,
    name: str,
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    options: Mapping[str, str] | None = None,
    comment: str | None = None,
    fmt: str = "parquet",
) -> None:
    """Write a catalog table.

    An append may bring new columns, which the table gets (older rows read null), and may lack
    others, which are null in its rows. File formats have no such option, so the catalog entry
    is widened first; with Delta the format does it.
    """
    spark = df.sparkSession
    if mode == "append" and spark.catalog.tableExists(name):
        if fmt == "delta":
            options = {"mergeSchema": "true", **(options or {})}
        else:
            df = _fitted(df, name)
    out = df.write.format(fmt).mode(mode).options(**(options or {}))
    (out.partitionBy(*partition_by) if partition_by else out).saveAsTable(name)
    if comment:
        set_comment(spark, name, comment)


def _fitted(df: DataFrame, name: str) -> DataFrame:
    """``df`` in the columns of the table, after the table got those it lacks."""
    spark = df.sparkSession
    held = {c.lower() for c in spark.table(name).columns}
    new = [f for f in df.schema.fields if f.name.lower() not in held]
    if new:
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({_columns(T.StructType(new))})")
        spark.catalog.refreshTable(name)
    given = {c.lower(): c for c in df.columns}
    return df.select(
        *[
            F.col(f"`{given[f.name.lower()]}`").alias(f.name)
            if f.name.lower() in given
            else F.lit(None).cast(f.dataType).alias(f.name)
            for f in spark.table(name).schema.fields
        ]
    )


def ingest(
    df: DataFrame,
    name: str,
    rules: Sequence[quality.ColumnRule] = (),
    mode: str = "overwrite",
    at=None,
    fmt: str = "parquet",
) -> None:
    """Raw table write: optional schema check over all rows, ingestion stamp, write."""
    if rules:
        quality.check_schema(df, rules)
    write_table(stamp_ingestion(df, at), name, mode, fmt=fmt)


def stamp_ingestion(df: DataFrame, at=None, name: str = "_ingested_at") -> DataFrame:
    """Ingestion time; the running clock unless ``at`` is given."""
    return df.withColumn(name, F.current_timestamp() if at is None else F.lit(at))


# --- properties -------------------------------------------------------------


def properties(spark: SparkSession, name: str) -> dict[str, str]:
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}


def set_properties(spark: SparkSession, name: str, values: Mapping[str, object]) -> None:
    """Tags and table properties."""
    if values:
        pairs = ", ".join(f"{_text(k)} = {_text(str(v))}" for k, v in values.items())
        spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({pairs})")


def set_comment(spark: SparkSession, name: str, comment: str) -> None:
    spark.sql(f"COMMENT ON TABLE {name} IS {_text(comment)}")


def drop_table(spark: SparkSession, name: str) -> None:
    """Drop a table if it exists; of a keyed table all states go too."""
    base = properties(spark, name).get(BASE) if spark.catalog.tableExists(name) else None
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    if base:
        files, path = _folder(spark, base)
        files.delete(path, True)


# --- schemas ----------------------------------------------------------------


def ensure_schemas(spark: SparkSession, schemas: Mapping[str, str]) -> None:
    """Create the schemas that are absent; names map to comments."""
    for name, comment in schemas.items():
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} COMMENT {_text(comment)}")


def recreate_schema(spark: SparkSession, name: str, confirm: bool = False, comment: str = "") -> None:
    """Drop a schema with all its tables and create it again. Needs ``confirm=True``."""
    if not confirm:
        raise ValueError(f"refusing to drop schema {name} without confirm=True")
    if spark.catalog.databaseExists(name):
        for table in spark.catalog.listTables(name):
            if not table.isTemporary and table.tableType != "VIEW":
                drop_table(spark, f"{name}.{table.name}")
    spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")
    ensure_schemas(spark, {name: comment})


def wait_for_table(spark: SparkSession, name: str, timeout: float = 120.0, poll: float = 1.0) -> DataFrame:
    """The table once it exists and has a row; raises when the time is up."""
    end = time.monotonic() + timeout
    while True:
        if spark.catalog.tableExists(name):
            spark.catalog.refreshTable(name)
            df = spark.table(name)
            if not df.isEmpty():
                return df
        if time.monotonic() >= end:
            raise TimeoutError(f"table {name} is absent or empty after {timeout:g} s")
        time.sleep(poll)


# --- keyed tables -----------------------------------------------------------


def check_primary_key(df: DataFrame, keys: Sequence[str]) -> None:
    """Raise unless the keys are never null and unique together."""
    quality.validate(df, [*[quality.no_nulls(k) for k in keys], quality.unique(*keys)])


def create_keyed_table(
    spark: SparkSession,
    name: str,
    schema,
    keys: Sequence[str],
    time_key: str | None = None,
    comment: str = "",
    tags: Mapping[str, str] | None = None,
    base: str | None = None,
    buckets: int = 0,
    rows: DataFrame | None = None,
    raise_on_drop_error: bool = True,
) -> None:
    """Create a keyed table, empty or with ``rows``; an existing table of that name is dropped.

    The states are written before the old table goes, so rows that can't be written leave it
    as it was. With ``buckets`` a merge rewrites only the buckets it touches.
    """
    absent = [k for k in [*keys, *([time_key] if time_key else [])] if k not in schema.fieldNames()]
    if absent:
        raise ValueError(f"key columns not in the schema: {absent}")
    if buckets and BUCKET in schema.fieldNames():
        raise ValueError(f"a table with buckets can't have a column {BUCKET} of its own")
    base = base or _base(spark, name)
    spark.createDataFrame([], schema).write.parquet(f"{base}/_version=0")
    version, places = 0, {}
    if rows is not None:
        version = 1
        places = _write_state(spark, base, 1, rows, keys, schema, buckets, keys)
    if buckets:
        files, _ = _folder(spark, base)
        _put(spark, files, f"{base}/_map-0", "{}")
        if rows is not None:
            _put(spark, files, f"{base}/_map-1", json.dumps(places))
    try:
        drop_table(spark, name)
    except PySparkException:
        if raise_on_drop_error:
            raise
    columns = _columns(schema) + (f", `{BUCKET}` INT" if buckets else "")
    parted = f" PARTITIONED BY (`{BUCKET}`)" if buckets else ""
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet{parted} LOCATION {_text(f'{base}/_version={version}')}")
    facts = {KEYS: ",".join(keys), BASE: base, BUCKETS: buckets, **({TIME: time_key} if time_key else {})}
    set_properties(spark, name, {**facts, **(tags or {})})
    if buckets:
        _place_buckets(spark, name, base, {}, places)
    if comment:
        set_comment(spark, name, comment)


def _columns(schema) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def table_keys(spark: SparkSession, name: str) -> list[str]:
    return properties(spark, name).get(KEYS, "").split(",")


def table_buckets(spark: SparkSession, name: str) -> int:
    """Number of buckets of a keyed table; 0 if it has none."""
    return int(properties(spark, name).get(BUCKETS, 0))


def _base(spark: SparkSession, name: str) -> str:
    """A new folder for the states of a table, in its schema's own location."""
    *schema, table = name.split(".")
    home = spark.catalog.getDatabase(".".join(schema) or spark.catalog.currentDatabase()).locationUri
    return f"{home.rstrip('/')}/{table}__states_{uuid.uuid4().hex[:12]}"


# Files of a table beside its states. Spark's readers pass over names that begin with an underscore and have no "=".


def _folder(spark: SparkSession, place: str) -> tuple[object, object]:
    """The file system of a place, and the place as its path."""
    path = spark._jvm.org.apache.hadoop.fs.Path(place)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def _put(spark: SparkSession, files, place: str, text: str) -> bool:
    """Create a small file; False if it is there already. Of several writers only one succeeds."""
    try:
        out = files.create(spark._jvm.org.apache.hadoop.fs.Path(place), False)
    except Py4JJavaError as error:
        if "AlreadyExists" in error.java_exception.getClass().getName():
            return False
        raise
    out.write(bytearray(text.encode()))
    out.close()
    return True


def _get(spark: SparkSession, files, place: str) -> str | None:
    """The text of a small file; None if there is none, or if its writer ended before it was written."""
    path = spark._jvm.org.apache.hadoop.fs.Path(place)
    if not files.exists(path):
        return None
    stream = files.open(path)
    text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    stream.close()
    if not text and time.time() - files.getFileStatus(path).getModificationTime() / 1000 > VOID_AFTER:
        files.delete(path, False)
    return text or None


def _states(spark: SparkSession, base: str) -> tuple[object, dict[int, object]]:
    """The file system, and the folders of all states by number, finished or not."""
    files, path = _folder(spark, base)
    found = {}
    for status in files.listStatus(path):
        if match := re.fullmatch(r"_version=(\d+)", status.getPath().getName()):
            found[int(match[1])] = status.getPath()
    return files, found


def current_version(spark: SparkSession, name: str) -> int:
    """Number of the state that the table's location points to."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name = 'Location'").collect()
    return int(rows[0]["data_type"].rstrip("/").rpartition("_version=")[2])


def _bucket_map(spark: SparkSession, files, base: str, version: int) -> dict[str, int]:
    """The state that each bucket of a state lies in."""
    return json.loads(_get(spark, files, f"{base}/_map-{version}") or "{}")


def _place_buckets(spark: SparkSession, name: str, base: str, before: dict[str, int], after: dict[str, int]) -> None:
    """Point the partitions of a table to the buckets of a state; doing it again changes nothing."""
    for bucket, version in after.items():
        if before.get(bucket) != version:
            place = _text(f"{base}/_version={version}/{BUCKET}={bucket}")
            if bucket not in before:
                spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS PARTITION ({BUCKET}={bucket}) LOCATION {place}")
            spark.sql(f"ALTER TABLE {name} PARTITION ({BUCKET}={bucket}) SET LOCATION {place}")
    for bucket in before.keys() - after.keys():
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({BUCKET}={bucket})")


def bucket_of(keys: Sequence[str], schema, buckets: int):
    """The bucket of a row, by its keys in the types of the table."""
    return F.pmod(F.xxhash64(*[F.col(f"`{k}`").cast(schema[k].dataType) for k in keys]), F.lit(buckets)).cast("int")


def _write_state(
    spark: SparkSession, base: str, version: int, df: DataFrame, keys: Sequence[str], schema, buckets: int,
    sort_by: Sequence[str] = (),
) -> dict[str, int]:
    """Write the files of a state into its folder; the buckets written, if the table has any."""
    location = f"{base}/_version={version}"
    if not buckets:
        out = df.sortWithinPartitions(*sort_by) if sort_by else df
        out.write.mode("append").parquet(location)
        return {}
    # Rebalancing keeps a bucket together while it fits a task, and splits it beyond.
    rows = df.withColumn(BUCKET, bucket_of(keys, schema, buckets)).hint("rebalance", BUCKET)
    rows.sortWithinPartitions(BUCKET, *sort_by).write.mode("append").partitionBy(BUCKET).parquet(location)
    files, path = _folder(spark, location)
    names = [s.getPath().getName() for s in files.listStatus(path)]
    return {n.partition("=")[2]: version for n in names if n.startswith(f"{BUCKET}=")}


class WriteConflict(RuntimeError):
    """Another writer followed the state that a change was planned on."""


def _claim(spark: SparkSession, files, base: str, least: int) -> int:
    """A state number that nobody else has."""
    _, states = _states(spark, base)
    version = max([*states, least]) + 1
    while not _put(spark, files, f"{base}/_version={version}/.claim", "claimed"):
        version += 1
    return version


def _switch(spark: SparkSession, name: str, base: str, files, version: int) -> None:
    """Make a finished state the current one, and then those that already follow it."""
    while True:
        if table_buckets(spark, name):
            before = _bucket_map(spark, files, base, current_version(spark, name))
            _place_buckets(spark, name, base, before, _bucket_map(spark, files, base, version))
        spark.sql(f"ALTER TABLE {name} SET LOCATION {_text(f'{base}/_version={version}')}")
        spark.catalog.refreshTable(name)
        after = _get(spark, files, f"{base}/_after-{version}")
        if after is None:
            return
        version = int(after)


def _settled(spark: SparkSession, name: str, base: str, files) -> int:
    """The current state, after a switch that its writer didn't come to."""
    version = current_version(spark, name)
    after = _get(spark, files, f"{base}/_after-{version}")
    if after is not None:
        _switch(spark, name, base, files, int(after))
        version = current_version(spark, name)
    return version


def publish_version(
    spark: SparkSession, name: str, df: DataFrame, sort_by: Sequence[str] = (), after: int | None = None,
    touched: Sequence[int] | None = None,
) -> int:
    """Write ``df`` as a new state of a keyed table and make it current.

    ``after`` is the state that ``df`` was planned on: if another one is current by now, this
    raises ``WriteConflict`` and changes nothing. Without it the new state follows whatever is
    current. ``touched`` names the buckets that ``df`` has the rows of; all others stay. The
    folder is new, so ``df`` may read any state, and what a crashed write left is never written
    over. Of the states before the new one the newest RETAINED - 1 finished ones stay.
    """
    facts = properties(spark, name)
    base, buckets, keys = facts[BASE], int(facts.get(BUCKETS, 0)), facts[KEYS].split(",")
    files, _ = _folder(spark, base)
    held = _settled(spark, name, base, files) if after is None else after
    version = _claim(spark, files, base, held)
    schema = T.StructType([f for f in spark.table(name).schema.fields if f.name != BUCKET or not buckets])
    written = _write_state(spark, base, version, df, keys, schema, buckets, sort_by)
    while True:
        if buckets:
            kept = _bucket_map(spark, files, base, held) if touched is not None else {}
            kept = {b: v for b, v in kept.items() if int(b) not in set(touched or ())}
            _, path = _folder(spark, f"{base}/_map-{version}")
            files.delete(path, False)
            _put(spark, files, f"{base}/_map-{version}", json.dumps(kept | written))
        mark = f"{base}/_after-{held}"
        if current_version(spark, name) == held and _put(spark, files, mark, str(version)):
            break
        if after is not None:
            files.delete(_folder(spark, f"{base}/_version={version}")[1], True)
            raise WriteConflict(f"{name} is no longer at state {after}")
        held = _settled(spark, name, base, files)
    try:
        _switch(spark, name, base, files, version)
    except BaseException:
        if current_version(spark, name) == held and not buckets:
            files.delete(_folder(spark, mark)[1], False)  # nothing was switched, so the state is not to be followed
        raise
    _retain(spark, base, files, version, buckets)
    return version


def _retain(spark: SparkSession, base: str, files, version: int, buckets: int) -> None:
    """Delete what only states older than the retained ones need. Unfinished states don't count."""
    _, states = _states(spark, base)

    def finished(v: int) -> bool:
        return files.exists(_folder(spark, f"{base}/_version={v}/_SUCCESS")[1])

    kept = [v for v in sorted(states, reverse=True) if v <= version and finished(v)][:RETAINED]
    if not kept:
        return
    used = {(int(b), v) for k in kept for b, v in _bucket_map(spark, files, base, k).items()} if buckets else set()
    for old in (v for v in states if v < min(kept)):
        lies = {int(s.getPath().getName().partition("=")[2]): s.getPath()
                for s in files.listStatus(states[old]) if s.getPath().getName().startswith(f"{BUCKET}=")}
        needed = [b for b in lies if (b, old) in used]
        for bucket, path in lies.items():
            if bucket not in needed:
                files.delete(path, True)
        if not needed:
            files.delete(states[old], True)
        for name in (f"_after-{old}", f"_map-{old}"):
            files.delete(_folder(spark, f"{base}/{name}")[1], False)


def read_current(spark: SparkSession, name: str) -> DataFrame:
    """A table as it is now. A session keeps the files of a table it has read, and streams change tables in sessions of their own."""
    spark.catalog.refreshTable(name)
    return spark.table(name)


def read_version(spark: SparkSession, name: str, version: int | None = None) -> DataFrame:
    """One retained state of a keyed table; the current one by default."""
    version = current_version(spark, name) if version is None else version
    facts, schema = properties(spark, name), spark.table(name).schema
    base = facts[BASE]
    if not int(facts.get(BUCKETS, 0)):
        return spark.read.schema(schema).parquet(f"{base}/_version={version}")
    return _read_buckets(spark, base, schema, _bucket_map(spark, _folder(spark, base)[0], base, version))


def _read_buckets(spark: SparkSession, base: str, schema, places: Mapping[str, int]) -> DataFrame:
    paths = [f"{base}/_version={v}/{BUCKET}={b}" for b, v in places.items()]
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.option("basePath", base).schema(schema).parquet(*paths).select(*[F.col(f"`{c}`") for c in schema.names])


def merge_into(
    spark: SparkSession,
    name: str,
    source: DataFrame,
    keys: Sequence[str] | None = None,
    update: Sequence[str] | None = None,
    insert: bool = True,
    newer: str | None = None,
    combine: Mapping[str, Combine] | None = None,
) -> None:
    """Upsert ``source`` into an existing table. Arguments as those of ``merge_frames``.

    If another writer changes the table meanwhile, the merge is planned again on its state, so
    both changes stay. With buckets, and merged by the table's own key, only the buckets of the
    source's keys are read and written.
    """
    if not spark.catalog.tableExists(name):
        raise ValueError(f"table {name} does not exist")
    if _provider(spark, name) not in ("parquet", "orc", "csv", "json"):
        if combine:
            raise ValueError("columns are combined in plain file tables only")
        _merge_rows(spark, name, source, list(keys or table_keys(spark, name)), update, insert, newer)
        return
    facts = properties(spark, name)
    own = facts.get(KEYS, "").split(",")
    keys = list(keys or own)
    schema = T.StructType([f for f in spark.table(name).schema.fields if f.name != BUCKET or not int(facts.get(BUCKETS, 0))])
    buckets = int(facts.get(BUCKETS, 0)) if keys == own else 0
    touched = None
    if buckets:
        found = source.select(bucket_of(keys, schema, buckets).alias("b")).distinct().collect()  # no more than the buckets
        touched = sorted(r["b"] for r in found)

    def plan(version: int) -> DataFrame:
        if touched is None:
            target = read_version(spark, name, version)
        else:
            base = facts[BASE]
            places = _bucket_map(spark, _folder(spark, base)[0], base, version)
            places = {str(b): places[str(b)] for b in touched if str(b) in places}
            target = _read_buckets(spark, base, spark.table(name).schema, places)
        target = target.select(*[F.col(f"`{c}`") for c in schema.names])
        return merge_frames(target, source, keys, update, insert, newer=newer, combine=combine)

    change_state(spark, name, plan, sort_by=keys, touched=touched)


def change_state(
    spark: SparkSession, name: str, plan: Callable[[int], DataFrame], sort_by: Sequence[str] = (),
    touched: Sequence[int] | None = None,
) -> int:
    """Publish what ``plan`` makes of the current state, and again from the start whenever another writer was first."""
    base = properties(spark, name)[BASE]
    files, _ = _folder(spark, base)
    for _ in range(ATTEMPTS):
        version = _settled(spark, name, base, files)
        try:
            return publish_version(spark, name, plan(version), sort_by, version, touched)
        except WriteConflict:
            time.sleep(0.05)
    raise WriteConflict(f"{name} was changed by others {ATTEMPTS} times in a row")


def _provider(spark: SparkSession, name: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name = 'Provider'").collect()
    return rows[0]["data_type"].lower() if rows else ""


def _merge_rows(
    spark: SparkSession, name: str, source: DataFrame, keys: Sequence[str], update: Sequence[str] | None, insert: bool,
    newer: str | None = None,
) -> None:
    """The merge of a table whose format changes rows itself. Columns and keys as in ``merge_frames``."""
    columns = [c for c in spark.table(name).columns if c in source.columns]
    changed = list(update) if update is not None else [c for c in columns if c not in keys]
    on = " AND ".join(f"{name}.`{k}` = _source.`{k}`" for k in keys)

    def given(names: Sequence[str]) -> dict:
        return {f"`{c}`": F.col(f"_source.`{c}`") for c in names}

    change = source.alias("_source").mergeInto(name, F.expr(on))
    later = F.expr(f"{name}.`{newer}` IS NULL OR _source.`{newer}` > {name}.`{newer}`") if newer else None
    change = change.whenMatched(later).update(given(changed)) if changed else change
    (change.whenNotMatched().insert(given(columns)) if insert else change).merge()


class FeatureStore:
    """Keyed tables of one schema by short name. ``dry_run`` makes every change a no-op."""

    def __init__(self, spark: SparkSession, schema: str, catalog: str | None = None, dry_run: bool = False):
        self.spark, self.schema, self.catalog, self.dry_run = spark, schema, catalog, dry_run
        self.skipped: list[str] = []

    def full_name(self, table: str) -> str:
        return ".".join(p for p in (self.catalog, self.schema, table) if p)

    def _skip(self, action: str, table: str) -> bool:
        if self.dry_run:
            self.skipped.append(f"{action} {self.full_name(table)}")
        return self.dry_run

    def create_or_replace(
        self, table: str, df: DataFrame, keys: Sequence[str], time_key: str | None = None,
        comment: str = "", tags: Mapping[str, str] | None = None, raise_on_drop_error: bool = True, buckets: int = 0,
    ) -> None:
        """An empty keyed table in place of any earlier one.

        With ``raise_on_drop_error=False`` an earlier table that can't be dropped is only
        replaced in the catalog if the catalog lets it be created.
        """
        if not self._skip("create", table):
            create_keyed_table(
                self.spark, self.full_name(table), df.schema, keys, time_key, comment, tags,
                buckets=buckets, raise_on_drop_error=raise_on_drop_error,
            )

    def write(self, table: str, df: DataFrame, mode: str = "merge") -> None:
        """Merge by the declared key, which is checked on the incoming rows first."""
        if mode != "merge":
            raise ValueError(f"feature tables are merged, not written with mode {mode!r}; recreate to reset")
        if not self._skip("write", table):
            check_primary_key(df, table_keys(self.spark, self.full_name(table)))
            merge_into(self.spark, self.full_name(table), df)

    def reset_and_write(self, table: str, df: DataFrame, keys: Sequence[str], **options) -> None:
        """Replace the table by ``df``: a plain write, as there is nothing to merge with.

        The keys are checked and the rows written before the earlier table goes.
        """
        skipped = self._skip("create", table)
        if not self._skip("write", table) and not skipped:
            check_primary_key(df, keys)
            create_keyed_table(self.spark, self.full_name(table), df.schema, keys, rows=df, **options)

    def read(self, table: str) -> DataFrame:
        return read_current(self.spark, self.full_name(table))

    def drop(self, table: str) -> None:
        if not self._skip("drop", table):
            drop_table(self.spark, self.full_name(table))

    def set_tags(self, table: str, tags: Mapping[str, str]) -> None:
        if not self._skip("tag", table):
            set_properties(self.spark, self.full_name(table), tags)

    def describe(self, table: str, comment: str) -> None:
        if not self._skip("comment", table):
            set_comment(self.spark, self.full_name(table), comment)

    def lookup(self, table: str, features: Sequence[str] | None = None, rename: Mapping[str, str] | None = None,
               label_time: str | None = None, **options):
        """Lookup on the declared key; point-in-time when the table has a time key."""
        from tidemark.operators.lookup import FeatureLookup

        facts = properties(self.spark, self.full_name(table))
        time_key = facts.get(TIME)
        keys = [k for k in facts[KEYS].split(",") if k != time_key]
        return FeatureLookup(
            self.full_name(table), keys, features, rename or {}, time_key=time_key, label_time=label_time, **options
        )
