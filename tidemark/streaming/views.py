"""Key-value views that follow a keyed table, and profiles that follow a log.

A view is a keyed table of its own, for reads by key: it holds the newest row of each key, the
state it comes from, and for a deleted key a tombstone, so that an older change which arrives
late can't bring it back. Changes of the source are written to a folder, a state at a time;
every view reads it as a stream at its own position, which its checkpoint keeps. A change has
the number of its state, and a view takes it only if that is newer than what it holds, so
changes may be delivered twice.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators import profile
from tidemark.operators.merge import change_feed
from tidemark.operators.profile import Monitor
from tidemark.operators.splits import latest_per_key
from tidemark.sources import tables

CHANGE, STATE, DELETED = "_change_type", "_commit_version", "_deleted"


# --- changes of a table -------------------------------------------------------


def changes_of(spark: SparkSession, table: str, version: int, before: int | None) -> DataFrame:
    """The row changes that made a state out of the one before it; of None: all its rows are inserted."""
    keys = tables.table_keys(spark, table)
    after = tables.read_version(spark, table, version).drop(tables.BUCKET)
    earlier = after.limit(0) if before is None else tables.read_version(spark, table, before).drop(tables.BUCKET)
    return change_feed(earlier, after, keys)


def _written(spark: SparkSession, folder: str) -> list[int]:
    """States whose changes are in the folder, complete ones only."""
    files, path = tables._folder(spark, folder)
    if not files.exists(path):
        return []
    names = [s.getPath().getName() for s in files.listStatus(path)]
    found = [int(n.partition("=")[2]) for n in names if n.startswith(f"{STATE}=")]
    return sorted(v for v in found if files.exists(tables._folder(spark, f"{folder}/{STATE}={v}/_SUCCESS")[1]))


def publish_changes(spark: SparkSession, table: str, folder: str) -> list[int]:
    """Write the changes of all states since the last one in the folder; returns the states written.

    Every state has a folder of its own, which is written again if an earlier try ended
    undone. The last state written must still be retained, else the changes since are lost and
    this raises; ``resync`` brings the views up to date then.
    """
    done = _written(spark, folder)
    last = done[-1] if done else None
    base = tables.properties(spark, table)[tables.BASE]
    files, states = tables._states(spark, base)
    now = tables.current_version(spark, table)
    kept = sorted(v for v in states if v <= now and files.exists(tables._folder(spark, f"{base}/_version={v}/_SUCCESS")[1]))
    if last is not None and last not in kept:
        raise ValueError(f"state {last} of {table} is no longer retained; resync the views")
    new = [v for v in kept if last is None or v > last] if last is not None else [now]
    for version in new:
        changes_of(spark, table, version, last).write.mode("overwrite").parquet(f"{folder}/{STATE}={version}")
        last = version
    return new


def change_stream(spark: SparkSession, table: str, folder: str, files_per_trigger: int | None = None) -> DataFrame:
    """The changes in a folder as a stream, with the number of their state."""
    schema = T.StructType([f for f in spark.table(table).schema.fields if f.name != tables.BUCKET])
    schema = schema.add(CHANGE, "string").add(STATE, "long")
    reader = spark.readStream.schema(schema)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", str(files_per_trigger))
    return reader.parquet(folder)


# --- views ----------------------------------------------------------------------


def create_view(spark: SparkSession, name: str, table: str, columns: Sequence[str] | None = None, buckets: int = 0) -> None:
    """An empty view of a keyed table, by its key; of all columns or the given ones beside the key."""
    keys = tables.table_keys(spark, table)
    kept = [f for f in spark.table(table).schema.fields if f.name != tables.BUCKET]
    kept = [f for f in kept if columns is None or f.name in columns or f.name in keys]
    schema = T.StructType(kept).add(STATE, "long").add(DELETED, "boolean")
    tables.create_keyed_table(spark, name, schema, keys, buckets=buckets)


def apply_changes(spark: SparkSession, view: str, changes: DataFrame) -> None:
    """Take the changes that are newer than what the view has of their keys; in any order, and more than once."""
    keys = tables.table_keys(spark, view)
    kept = [c for c in spark.table(view).columns if c not in (tables.BUCKET, STATE, DELETED)]
    rows = changes.filter(F.col(CHANGE) != "update_preimage")
    rows = rows.select(*[F.col(f"`{c}`") for c in kept], STATE, (F.col(CHANGE) == "delete").alias(DELETED))
    tables.merge_into(spark, view, latest_per_key(rows, keys, STATE), keys, newer=STATE)


def sync_view(
    changes: DataFrame, view: str, checkpoint: str, every: str | None = None, name: str | None = None
) -> StreamingQuery:
    """Keep a view up to date with a stream of changes: until all are in, or for ever with ``every`` as the interval."""

    def take(batch: DataFrame, number: int) -> None:
        apply_changes(batch.sparkSession, view, batch.persist())  # read more than once
        batch.unpersist()

    writer = changes.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return (writer.queryName(name) if name else writer).start()


def read_view(spark: SparkSession, view: str) -> DataFrame:
    """The rows of a view, as of its source."""
    return tables.read_current(spark, view).filter(~F.col(DELETED)).drop(tables.BUCKET, STATE, DELETED)


def resync(spark: SparkSession, table: str, view: str) -> None:
    """Bring a view to the current state of its table by comparing the two."""
    version, held = tables.current_version(spark, table), read_view(spark, view)
    rows = tables.read_version(spark, table, version).select(*[F.col(f"`{c}`") for c in held.columns])
    changes = change_feed(held, rows, tables.table_keys(spark, view))
    apply_changes(spark, view, changes.withColumn(STATE, F.lit(version).cast("long")))


def forget_deleted(spark: SparkSession, view: str, before: int) -> None:
    """Drop the tombstones of keys deleted before a state, once no change older than it can arrive."""

    def plan(version: int) -> DataFrame:
        rows = tables.read_version(spark, view, version).drop(tables.BUCKET)
        return rows.filter(~F.col(DELETED) | (F.col(STATE) >= before))

    tables.change_state(spark, view, plan, sort_by=tables.table_keys(spark, view))


# --- profiles of an arriving log --------------------------------------------------

_BATCH, _STREAM, _GROUP = "_batch", "_stream", "_group"
_KINDS = ("numeric", "distinct", "values", "confusion")


def _states_of(df: DataFrame, monitor: Monitor) -> dict[str, tuple[DataFrame, list[str]]]:
    """The states that profiles of the log are made of, with the columns beside the grain that tell their rows apart."""
    out: dict[str, tuple[DataFrame, list[str]]] = {}
    if monitor.numeric:
        out["numeric"] = profile.numeric_state(df, monitor), []
        out["distinct"] = profile.distinct_state(df, monitor), []
    if monitor.categorical:
        out["values"] = profile.value_state(df, monitor, monitor.categorical), ["column_name", "value"]
    if monitor.label_col is not None and monitor.prediction_col is not None:
        out["confusion"] = profile.confusion_state(df, monitor), ["label", "prediction"]
    return out


def _sums(kind: str, monitor: Monitor) -> dict:
    if kind == "numeric":
        return profile.state_sums(monitor)
    if kind == "distinct":
        return {
            c: lambda old, new, c=c: F.coalesce(F.hll_union(old(c), new(c)), old(c), new(c))
            for c in (f"_hll{i}" for i, _ in enumerate(monitor.numeric))
        }
    return {"n": lambda old, new: old("n") + new("n")}


def _keyed(state: DataFrame, monitor: Monitor, apart: Sequence[str], stream: str, batch: int) -> DataFrame:
    """A state with a key that is never null: the window's start, the rest of the group as text, and the stream."""
    group = F.to_json(F.struct(*[F.col(c) for c in [*monitor.grain[2:], *apart]]))
    marks = {_GROUP: group, _STREAM: F.lit(stream), _BATCH: F.lit(batch).cast("long")}
    return state.withColumns(marks)


def profile_stream(
    stream: DataFrame, monitor: Monitor, name: str, checkpoint: str, buckets: int = 0, every: str | None = None
) -> StreamingQuery:
    """Keep the whole profile of an arriving log: numeric, categorical and quality, of all days and slices.

    Each batch is reduced to partial states, which are added to those in the tables
    ``name_numeric``, ``name_distinct``, ``name_values`` and ``name_confusion``; no row is kept,
    and no day ever closes. A group holds the last batch added to it, so a batch that is
    delivered again after a failure changes nothing.
    """

    def add(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        own = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        # Read once for each state, and by all cores: a batch may be one file that one task reads.
        batch = batch.repartition(spark.sparkContext.defaultParallelism).persist()
        for kind, (state, apart) in _states_of(batch, monitor).items():
            rows, table = _keyed(state, monitor, apart, own, number), f"{name}_{kind}"
            keys = ["window_start", _GROUP, _STREAM]
            if not spark.catalog.tableExists(table):
                tables.create_keyed_table(spark, table, rows.schema, keys, buckets=buckets)
            sums = _sums(kind, monitor)
            tables.merge_into(spark, table, rows, keys, [*sums, _BATCH], newer=_BATCH, combine=sums)
        batch.unpersist()

    writer = stream.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


_MADE: dict[str, Callable[[DataFrame, Monitor], DataFrame]] = {
    "numeric": profile.numeric_profile,
    "distinct": profile.distinct_profile,
    "values": profile.categorical_profile,
    "confusion": lambda state, monitor: profile.publish(profile.quality_profile(state, monitor)),
}


def profile_so_far(spark: SparkSession, monitor: Monitor, name: str, kind: str) -> DataFrame:
    """The profile of the rows that have arrived: ``numeric``, ``distinct``, ``values`` or ``confusion``."""
    if kind not in _KINDS:
        raise ValueError(f"kind must be one of {_KINDS}")
    return _MADE[kind](tables.read_current(spark, f"{name}_{kind}").drop(_GROUP, _STREAM, _BATCH, tables.BUCKET), monitor)


def drop_profile(spark: SparkSession, name: str) -> None:
    """Drop the tables of a streaming profile."""
    for kind in _KINDS:
        tables.drop_table(spark, f"{name}_{kind}")
