"""Structured Streaming forms of the batch operators.

Feature expressions are stateless, so a streaming frame goes through the same
functions as a batch one. What is here is the part that differs: sinks that can be
repeated safely, and windows that close.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.profile import Monitor
from tidemark.operators.splits import latest_per_key
from tidemark.sources import tables

LAST_BATCH = "tidemark.batch"


def _stream_id(spark: SparkSession) -> str:
    """The running query's id. It is kept in the checkpoint, so a restarted stream is the same and any other is not."""
    return spark.sparkContext.getLocalProperty("sql.streaming.queryId")


def _once(spark: SparkSession, table: str, number: int, change: Callable[[], None]) -> None:
    """Make a change for a batch unless the table bears the stamp of that batch of that stream, or a later one."""
    stamp = f"{LAST_BATCH}.{_stream_id(spark)}"
    if int(tables.properties(spark, table).get(stamp, -1)) < number:
        change()
        tables.set_properties(spark, table, {stamp: number})


def upsert_stream(
    stream: DataFrame, table: str, keys: Sequence[str], time_col: str, checkpoint: str, name: str | None = None,
    transform: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> StreamingQuery:
    """Merge a stream into a keyed table, newest row per key first within each batch.

    The batch number is stored with the table under the id of the stream's checkpoint: a batch
    that is delivered again after a failure is recognised and skipped, and streams don't
    disturb each other. Rows older than the table's own are left out, so even a stream that
    starts again without its checkpoint ends in the same state. A null key raises: it matches
    nothing, so it would be inserted again with every delivery.
    """

    def merge(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession

        def change() -> None:
            newest = latest_per_key(transform(batch), keys, time_col)
            for key in keys:
                missing = F.raise_error(F.lit(f"stream row without key {key}")).cast(newest.schema[key].dataType)
                newest = newest.withColumn(key, F.coalesce(F.col(key), missing))
            held = spark.table(table).select(*keys, F.col(time_col).alias("_held"))
            newer = newest.join(held, list(keys), "left").filter(
                F.col("_held").isNull() | (F.col(time_col) >= F.col("_held"))
            )
            tables.merge_into(spark, table, newer.drop("_held"), keys)

        _once(spark, table, number, change)

    writer = stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    return (writer.queryName(name) if name else writer).start()


def upsert_aggregates(stream: DataFrame, table: str, keys: Sequence[str], checkpoint: str) -> StreamingQuery:
    """Keep a keyed table equal to a streaming aggregate, open groups included.

    Every batch brings the changed groups with their whole new values, which replace the old ones.
    """

    def merge(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        _once(spark, table, number, lambda: tables.merge_into(spark, table, batch, keys))

    writer = stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    return writer.outputMode("update").trigger(availableNow=True).start()


def append_stream(
    stream: DataFrame, path: str, checkpoint: str, transform: Callable[[DataFrame], DataFrame] = lambda df: df
) -> StreamingQuery:
    """Transform (featurise, score) and append to files; the file sink writes each row once."""
    return (
        transform(stream)
        .writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .outputMode("append")
        .start()
    )


def daily_metrics(stream: DataFrame, monitor: Monitor, late: str = "1 day") -> DataFrame:
    """Rows, label matches and sums per window and model of an arriving log.

    Rows later than the watermark are dropped. A watermark needs an instant, so
    wall-clock times are read in the session time zone.
    """
    events = stream.withColumn("_at", F.col(monitor.time_col).cast("timestamp")).withWatermark("_at", late)
    by = [F.window("_at", monitor.granularity).alias("window")]
    if monitor.model_col is not None:
        by.append(F.col(monitor.model_col).cast("string").alias("model_version"))
    metrics = [F.count(F.lit(1)).alias("count")]
    metrics += [F.count(c).alias(f"{c}_count") for c in monitor.numeric]
    metrics += [F.sum(F.col(c).cast("double")).alias(f"{c}_sum") for c in monitor.numeric]
    if monitor.label_col is not None and monitor.prediction_col is not None:
        labelled = F.col(monitor.label_col).isNotNull() & F.col(monitor.prediction_col).isNotNull()
        hit = F.col(monitor.label_col) == F.col(monitor.prediction_col)
        metrics += [F.count_if(labelled).alias("labelled"), F.count_if(labelled & hit).alias("correct")]
    return events.groupBy(*by).agg(*metrics)


def file_stream(spark: SparkSession, folder: str, name: str, schema, files_per_trigger: int | None = None) -> DataFrame:
    """Stream of the parquet files called ``name`` (a glob) in ``folder``."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", name)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", str(files_per_trigger))
    return reader.parquet(folder)


def active_streams(spark: SparkSession, prefix: str = "") -> list[StreamingQuery]:
    return [q for q in spark.streams.active if (q.name or "").startswith(prefix)]


def stop_streams(spark: SparkSession, prefix: str = "") -> int:
    """Stop all active streams whose name has the prefix; returns how many."""
    queries = active_streams(spark, prefix)
    for query in queries:
        query.stop()
    return len(queries)


def wait_for_streams(spark: SparkSession, prefix: str = "", timeout: float = 120.0, poll: float = 0.2) -> None:
    """Wait until no active stream has the prefix; raises when the time is up."""
    end = time.monotonic() + timeout
    while active_streams(spark, prefix):
        if time.monotonic() >= end:
            raise TimeoutError(f"streams still active after {timeout:g} s")
        time.sleep(poll)
