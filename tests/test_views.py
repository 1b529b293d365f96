"""Views that follow a table by its changes, and profiles that add up over batches."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import profile
from tidemark.operators.profile import Monitor
from tidemark.session import scratch_path
from tidemark.sources import tables
from tidemark.streaming import jobs, views

STATES = [
    {1: "a", 2: "b", 3: "c", 4: "d"},
    {1: "a", 2: "B", 4: "d", 5: "e"},  # 3 goes, 5 comes
    {2: "B", 3: "again", 4: "D", 5: "e", 6: None},  # 1 goes, 3 comes back
]


def frame(spark, state):
    return spark.createDataFrame(list(state.items()), "k int, v string")


def rows(df):
    return {r["k"]: r["v"] for r in df.collect()}


@pytest.mark.parametrize("buckets", [0, 4])
def test_a_view_follows_its_table(spark, buckets):
    table, view, log = f"default.src_{buckets}", f"default.view_{buckets}", scratch_path(spark, "log")
    tables.create_keyed_table(spark, table, frame(spark, STATES[0]).schema, ["k"], buckets=buckets, rows=frame(spark, STATES[0]))
    views.create_view(spark, view, table, buckets=buckets)
    checkpoint, batches = scratch_path(spark, "cp"), []
    for state in STATES:
        if state is not STATES[0]:
            tables.publish_version(spark, table, frame(spark, state))
        assert len(views.publish_changes(spark, table, log)) == 1 and views.publish_changes(spark, table, log) == []
        views.sync_view(views.change_stream(spark, table, log), view, checkpoint).awaitTermination()
        assert rows(views.read_view(spark, view)) == state
        batches.append(tables.current_version(spark, table))
    # Each batch again, the newest first, from a consumer that lost its position.
    held = tables.read_current(spark, view).count()
    for version in reversed(batches):
        changes = spark.read.parquet(log).filter(F.col(views.STATE) == version)
        views.apply_changes(spark, view, changes)
        assert rows(views.read_view(spark, view)) == STATES[2] and tables.read_current(spark, view).count() == held
    assert {r["k"] for r in tables.read_current(spark, view).filter(views.DELETED).collect()} == {1}


def test_late_changes_dont_bring_deleted_keys_back(spark):
    tables.create_keyed_table(spark, "default.late_src", frame(spark, STATES[0]).schema, ["k"], rows=frame(spark, STATES[0]))
    views.create_view(spark, "default.late_view", "default.late_src")
    steps = [views.changes_of(spark, "default.late_src", 1, None).withColumn(views.STATE, F.lit(1).cast("long"))]
    for state in STATES[1:]:
        version = tables.publish_version(spark, "default.late_src", frame(spark, state))
        changes = views.changes_of(spark, "default.late_src", version, version - 1)
        steps.append(changes.withColumn(views.STATE, F.lit(version).cast("long")))
    for step in (steps[2], steps[0], steps[1], steps[0]):
        views.apply_changes(spark, "default.late_view", step)
    assert rows(views.read_view(spark, "default.late_view")) == STATES[2]
    views.forget_deleted(spark, "default.late_view", 99)
    assert spark.table("default.late_view").count() == len(STATES[2])


def test_changes_of_several_states_at_once_and_lost_ones(spark):
    log = scratch_path(spark, "log")
    tables.create_keyed_table(spark, "default.lost_src", frame(spark, STATES[0]).schema, ["k"], rows=frame(spark, STATES[0]))
    views.create_view(spark, "default.lost_view", "default.lost_src", columns=["v"])
    views.publish_changes(spark, "default.lost_src", log)
    for state in STATES[1:]:
        tables.publish_version(spark, "default.lost_src", frame(spark, state))
    assert views.publish_changes(spark, "default.lost_src", log) == [2, 3]
    views.sync_view(views.change_stream(spark, "default.lost_src", log), "default.lost_view", scratch_path(spark, "cp")).awaitTermination()
    assert rows(views.read_view(spark, "default.lost_view")) == STATES[2]
    for i in range(tables.RETAINED + 1):
        tables.publish_version(spark, "default.lost_src", frame(spark, STATES[0] | {9: str(i)}))
    with pytest.raises(ValueError, match="no longer retained"):
        views.publish_changes(spark, "default.lost_src", log)
    views.resync(spark, "default.lost_src", "default.lost_view")
    assert rows(views.read_view(spark, "default.lost_view")) == STATES[0] | {9: str(tables.RETAINED)}


def test_a_view_can_run_on(spark):
    log = scratch_path(spark, "log")
    tables.create_keyed_table(spark, "default.on_src", frame(spark, STATES[0]).schema, ["k"], rows=frame(spark, STATES[0]))
    views.create_view(spark, "default.on_view", "default.on_src")
    views.publish_changes(spark, "default.on_src", log)
    query = views.sync_view(views.change_stream(spark, "default.on_src", log), "default.on_view", scratch_path(spark, "cp"), every="0 seconds")
    query.processAllAvailable()
    assert query.isActive and rows(views.read_view(spark, "default.on_view")) == STATES[0]
    tables.publish_version(spark, "default.on_src", frame(spark, STATES[1]))
    views.publish_changes(spark, "default.on_src", log)
    query.processAllAvailable()
    query.stop()
    assert rows(views.read_view(spark, "default.on_view")) == STATES[1]


MONITOR = Monitor(
    "ts", model_col="m", prediction_col="p", label_col="y", numeric=["v", "w"], categorical=["c", "p"], slices=["c", "v > 5"],
)
TYPES = "ts timestamp, m string, p string, y string, v double, w double, c string"


def log_rows(rng, n):
    def some(*values):
        return rng.choice(values)

    start = dt.datetime(2024, 1, 1)
    return [
        (start + dt.timedelta(hours=rng.randrange(96)), some("1", "2", None), some("Yes", "No", None), some("Yes", "No", None),
         some(None, 1e9 + rng.random(), rng.random() * 10), some(None, 1.0, 2.0), some("x", "y", "", None))
        for _ in range(n)
    ]


def close(a, b):
    if isinstance(a, float) and isinstance(b, float):
        return a == pytest.approx(b, rel=1e-9, abs=1e-6)
    return a == b


def same(got, want):
    def ordered(df):
        return sorted((tuple(r) for r in df.select(sorted(df.columns)).collect()), key=str)

    got, want = ordered(got), ordered(want)
    # Sort by the exact columns, as sums of doubles may differ in their last digits.
    key = lambda row: str([x for x in row if not isinstance(x, float)])
    pairs = list(zip(sorted(got, key=key), sorted(want, key=key)))
    return len(got) == len(want) and all(all(map(close, a, b)) for a, b in pairs)


@pytest.mark.parametrize("buckets", [0, 4])
def test_a_streaming_profile_equals_the_batch_after_every_batch(spark, tmp_path, buckets):
    rng, folder, name, checkpoint = random.Random(1), str(tmp_path / "in"), f"default.daily_{buckets}", scratch_path(spark, "cp")
    seen = []
    for _ in range(3):
        part = log_rows(rng, 80)
        seen += part
        spark.createDataFrame(part, TYPES).coalesce(1).write.mode("append").parquet(folder)
        stream = jobs.file_stream(spark, folder, "*.parquet", spark.createDataFrame([], TYPES).schema)
        views.profile_stream(stream, MONITOR, name, checkpoint, buckets).awaitTermination()
        log = spark.createDataFrame(seen, TYPES)
        assert same(views.profile_so_far(spark, MONITOR, name, "numeric"), profile.profile_numeric(log, MONITOR))
        assert same(views.profile_so_far(spark, MONITOR, name, "values"), profile.profile_categorical(log, MONITOR))
        assert same(
            views.profile_so_far(spark, MONITOR, name, "confusion"), profile.publish(profile.quality_by_group(log, MONITOR))
        )
        exact = profile.distinct_profile(profile.distinct_state(log, MONITOR), MONITOR)
        assert same(views.profile_so_far(spark, MONITOR, name, "distinct"), exact)
    views.drop_profile(spark, name)
    assert not spark.catalog.tableExists(f"{name}_numeric")


def test_a_batch_of_a_profile_delivered_again(spark, tmp_path, monkeypatch):
    """The second table can't be written at first: the batch comes again, and the first table isn't added to twice."""
    folder, name, checkpoint = str(tmp_path / "in"), "default.again", scratch_path(spark, "cp")
    log = spark.createDataFrame(log_rows(random.Random(2), 60), TYPES)
    log.coalesce(1).write.parquet(folder)
    log = spark.read.parquet(folder)
    merge = tables.merge_into

    def stop(spark, table, *args, **kwargs):
        if table.endswith("_values"):
            raise RuntimeError("stopped")
        return merge(spark, table, *args, **kwargs)

    monkeypatch.setattr(tables, "merge_into", stop)
    stream = jobs.file_stream(spark, folder, "*.parquet", log.schema)
    with pytest.raises(Exception, match="stopped"):
        views.profile_stream(stream, MONITOR, name, checkpoint).awaitTermination()
    monkeypatch.undo()
    views.profile_stream(stream, MONITOR, name, checkpoint).awaitTermination()
    assert same(views.profile_so_far(spark, MONITOR, name, "numeric"), profile.profile_numeric(log, MONITOR))
    assert same(views.profile_so_far(spark, MONITOR, name, "values"), profile.profile_categorical(log, MONITOR))


def test_a_batch_of_one_file_is_profiled_by_all_cores(spark, tmp_path, monkeypatch):
    folder, name, parts = str(tmp_path / "in"), "default.spread", []
    log = spark.createDataFrame(log_rows(random.Random(4), 60), TYPES)
    log.coalesce(1).write.parquet(folder)
    states = views._states_of

    def seen(df, monitor):
        parts.append(df.rdd.getNumPartitions())
        return states(df, monitor)

    monkeypatch.setattr(views, "_states_of", seen)
    stream = jobs.file_stream(spark, folder, "*.parquet", log.schema)
    views.profile_stream(stream, MONITOR, name, scratch_path(spark, "cp")).awaitTermination()
    assert parts == [spark.sparkContext.defaultParallelism] and parts[0] > 1
    assert same(views.profile_so_far(spark, MONITOR, name, "values"), profile.profile_categorical(log, MONITOR))
    views.drop_profile(spark, name)


def test_numeric_profiles_scan_once(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame(log_rows(random.Random(3), 50), TYPES).write.parquet(path)
    plan = profile.profile_numeric(spark.read.parquet(path), MONITOR)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange hashpartitioning") == 2
