import datetime as dt
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidemark.operators import merge, score
from tidemark.operators.quality import ColumnRule
from tidemark.operators.skew import SkewPolicy
from tidemark.session import scratch_path
from tidemark.sources import readers, synthetic, tables
from tidemark.sources.readers import Source
from tidemark.sources.tables import FeatureStore

SALTED = SkewPolicy(rows=3)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture
def sides(spark):
    target = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0), (None, "n", 0.0)], "k int, s string, v double")
    source = spark.createDataFrame([(2, "B", 20), (3, "C", 30), (None, "N", 9)], "k int, s string, v int")
    return target, source


@pytest.mark.parametrize("policy", [SkewPolicy(), SALTED], ids=["plain", "salted"])
def test_merge(sides, policy):
    target, source = sides
    both = merge.merge_frames(target, source, ["k"], policy=policy)
    assert rows(both) == sorted([(1, "a", 1.0), (2, "B", 20.0), (3, "C", 30.0), (None, "n", 0.0), (None, "N", 9.0)], key=str)
    assert both.schema == target.schema or both.dtypes == target.dtypes
    subset = merge.merge_frames(target, source, ["k"], update=["v"], insert=False, policy=policy)
    assert rows(subset) == sorted([(1, "a", 1.0), (2, "b", 20.0), (None, "n", 0.0)], key=str)


def test_merge_updates_with_null_and_refuses_two_matches(spark, sides):
    target, _ = sides
    gone = spark.createDataFrame([(1, None, None)], "k int, s string, v double")
    assert (1, None, None) in rows(merge.merge_frames(target, gone, ["k"]))
    twice = spark.createDataFrame([(1, "x", 1.0), (1, "y", 2.0)], "k int, s string, v double")
    with pytest.raises(PySparkException, match="several source rows"):
        merge.merge_frames(target, twice, ["k"]).collect()
    new = spark.createDataFrame([(9, "x", 1.0), (9, "y", 2.0)], "k int, s string, v double")
    assert merge.merge_frames(target, new, ["k"]).count() == 5
    with pytest.raises(ValueError, match="no columns"):
        merge.merge_frames(target, new.drop("s"), ["k"], update=["s"])


def test_change_feed_rebuilds_the_new_state(spark):
    old = spark.createDataFrame([(1, "a"), (2, None), (3, "c")], "k int, v string")
    new = spark.createDataFrame([(2, None), (3, "d"), (4, "e")], "k int, v string")
    feed = merge.change_feed(old, new, ["k"])
    assert rows(feed) == sorted(
        [(1, "a", "delete"), (3, "c", "update_preimage"), (3, "d", "update_postimage"), (4, "e", "insert")], key=str
    )


def test_change_feed_refuses_repeated_keys(spark):
    one = spark.createDataFrame([(1, "a")], "k int, v string")
    for old, new in ((one.union(one), one), (one, one.union(one))):
        with pytest.raises(PySparkException, match="not unique"):
            merge.change_feed(old, new, ["k"]).collect()


def test_union_logs_fills_absent_columns(spark):
    offline = spark.createDataFrame([(0,)], "k int")
    got = merge.union_logs(offline, offline.withColumn("x", F.lit(1)))
    assert rows(got) == [(0, 1), (0, None)]


def test_append_new_is_repeatable(spark):
    log = spark.createDataFrame([(1, "1")], "k int, model_version string")
    batch = spark.createDataFrame([(1, "1"), (2, "1")], "k int, model_version string")
    once = log.unionByName(score.append_new(log, batch, ["k", "model_version"]))
    assert rows(once) == [(1, "1"), (2, "1")]
    assert score.append_new(once, batch, ["k", "model_version"]).isEmpty()


# --- tables -----------------------------------------------------------------


def test_keyed_table_life(spark):
    store = FeatureStore(spark, "default")
    at = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([("a", at, 1.0), ("b", at, 2.0)], "k string, ts timestamp, v double")
    store.reset_and_write("life", df, ["k", "ts"], time_key="ts", comment="it's a test", tags={"team": "x"})
    store.write("life", df.filter("k = 'b'").withColumn("v", F.lit(9.0)).unionByName(df.limit(1).withColumn("k", F.lit("c"))))
    assert rows(store.read("life").select("k", "v")) == [("a", 1.0), ("b", 9.0), ("c", 1.0)]
    assert rows(tables.read_version(spark, "default.life", 1).select("k", "v")) == [("a", 1.0), ("b", 2.0)]
    assert tables.properties(spark, "default.life")["team"] == "x"
    lookup = store.lookup("life", label_time="seen")
    assert list(lookup.keys) == ["k"] and lookup.time_key == "ts"
    history = spark.read.parquet(tables.properties(spark, "default.life")[tables.BASE])
    assert readers.latest_version(history).count() == 3
    with pytest.raises(ValueError, match="merged"):
        store.write("life", df, mode="overwrite")
    with pytest.raises(ValueError, match="data checks failed"):
        store.write("life", df.unionByName(df))
    store.set_tags("life", {"tier": "gold"})
    store.describe("life", "new 'words'")
    store.drop("life")
    assert not spark.catalog.tableExists("default.life")


def test_a_crashed_write_leaves_the_old_state(spark):
    df = spark.createDataFrame([(1, 1.0)], "k int, v double")
    FeatureStore(spark, "default").reset_and_write("crash", df, ["k"])
    broken = df.withColumn("v", F.raise_error(F.lit("boom")).cast("double"))
    with pytest.raises(PySparkException):
        tables.publish_version(spark, "default.crash", broken)
    assert rows(spark.table("default.crash")) == [(1, 1.0)]
    tables.publish_version(spark, "default.crash", df.withColumn("v", F.lit(2.0)))
    assert rows(spark.table("default.crash")) == [(1, 2.0)]


@pytest.mark.parametrize("step", ["before", "after"])
def test_a_crash_around_the_switch_loses_nothing(spark, step, monkeypatch):
    """Stop before or after the location is set, then merge again."""
    name = f"default.crash_{step}"
    df = spark.createDataFrame([(i, 1.0) for i in range(10)], "k int, v double")
    FeatureStore(spark, "default").reset_and_write(f"crash_{step}", df, ["k"])
    run = type(spark).sql

    def crash(self, text, *args, **kwargs):
        if "SET LOCATION" in text:
            if step == "after":
                run(self, text, *args, **kwargs)
            raise RuntimeError("stopped")
        return run(self, text, *args, **kwargs)

    monkeypatch.setattr(type(spark), "sql", crash)
    with pytest.raises(RuntimeError, match="stopped"):
        tables.merge_into(spark, name, df.filter("k = 1").withColumn("v", F.lit(2.0)))
    monkeypatch.undo()
    spark.catalog.refreshTable(name)
    assert spark.table(name).count() == 10
    for value in (3.0, 4.0):
        tables.merge_into(spark, name, df.filter("k = 2").withColumn("v", F.lit(value)))
    want = {i: 1.0 for i in range(10)} | {2: 4.0} | ({1: 2.0} if step == "after" else {})
    assert dict(rows(spark.table(name))) == want


def test_old_states_go_and_tables_live_in_their_schema(spark):
    df = spark.createDataFrame([(1, 0.0)], "k int, v double")
    FeatureStore(spark, "default").reset_and_write("kept", df, ["k"])
    for i in range(7):
        tables.publish_version(spark, "default.kept", df.withColumn("v", F.lit(float(i))))
    base = tables.properties(spark, "default.kept")[tables.BASE]
    assert base.startswith(spark.catalog.getDatabase("default").locationUri)
    _, states = tables._states(spark, base)
    assert len(states) == tables.RETAINED and tables.current_version(spark, "default.kept") == max(states)
    assert rows(spark.table("default.kept")) == [(1, 6.0)]


def test_late_labels_into_a_table(spark):
    log = spark.createDataFrame([(1, None, "a"), (2, "No", "b")], "k int, churn string, x string")
    FeatureStore(spark, "default").reset_and_write("late", log, ["k"])
    labels = spark.createDataFrame([(1, "Yes"), (9, "No")], "k int, churn string")
    tables.merge_into(spark, "default.late", labels, update=["churn"], insert=False)
    assert rows(spark.table("default.late")) == [(1, "Yes", "a"), (2, "No", "b")]


def test_dry_run_changes_nothing(spark):
    store = FeatureStore(spark, "default", dry_run=True)
    store.reset_and_write("ghost", spark.range(1), ["id"])
    store.set_tags("ghost", {"a": "b"})
    store.drop("ghost")
    assert not spark.catalog.tableExists("default.ghost") and len(store.skipped) == 4


def test_merge_into_needs_a_table(spark):
    with pytest.raises(ValueError, match="does not exist"):
        tables.merge_into(spark, "default.nothing", spark.range(1), ["id"])
    with pytest.raises(ValueError, match="key columns"):
        tables.create_keyed_table(spark, "default.bad", spark.range(1).schema, ["nope"])


def test_write_modes_partitions_and_comment(spark):
    df = spark.createDataFrame([(1, "x"), (2, "y")], "a int, p string")
    tables.write_table(df, "default.modes", partition_by=["p"], comment="it's here")
    tables.write_table(df, "default.modes", mode="append", partition_by=["p"])
    assert spark.table("default.modes").count() == 4
    tables.write_table(df, "default.modes", mode="ignore", partition_by=["p"])
    assert spark.table("default.modes").count() == 4
    with pytest.raises(PySparkException):
        tables.write_table(df, "default.modes", mode="error")
    described = {r["col_name"]: r["data_type"] for r in spark.sql("DESCRIBE TABLE EXTENDED default.modes").collect()}
    assert described["Comment"] == "it's here"
    tables.drop_table(spark, "default.modes")


def test_append_may_bring_and_lack_columns(spark):
    tables.write_table(spark.createDataFrame([(1, "x")], "a int, b string"), "default.grows")
    tables.write_table(spark.createDataFrame([(2.5, 2)], "c double, a int"), "default.grows", mode="append")
    assert rows(spark.table("default.grows").select("a", "b", "c")) == [(1, "x", None), (2, None, 2.5)]


def test_ingest_checks_and_stamps(spark):
    df = spark.createDataFrame([(1, "x")], "a int, b string")
    tables.ingest(df, "default.raw", [ColumnRule("a", type="int", nullable=False)])
    assert "_ingested_at" in spark.table("default.raw").columns
    with pytest.raises(ValueError, match="schema check failed"):
        tables.ingest(df, "default.raw", [ColumnRule("b", allowed=["y"])])


def test_schemas_and_waiting(spark):
    tables.ensure_schemas(spark, {"lake_a": "bronze", "lake_b": "it's silver"})
    tables.ensure_schemas(spark, {"lake_a": "bronze"})
    assert spark.catalog.databaseExists("lake_a") and spark.catalog.databaseExists("lake_b")
    with pytest.raises(ValueError, match="confirm"):
        tables.recreate_schema(spark, "lake_a")
    tables.write_table(spark.range(1), "lake_a.t")
    assert tables.wait_for_table(spark, "lake_a.t", timeout=5).count() == 1
    tables.recreate_schema(spark, "lake_a", confirm=True)
    assert not spark.catalog.tableExists("lake_a.t")
    with pytest.raises(TimeoutError):
        tables.wait_for_table(spark, "lake_a.t", timeout=0.2, poll=0.1)


# --- sources ----------------------------------------------------------------


def test_sources(spark, tmp_path):
    path = str(tmp_path / "raw.csv")
    with open(path, "w") as out:
        out.write("customerID,MonthlyCharges,TotalCharges\n7590-VHVEG,29.85, \n")
    df = readers.read_source(spark, Source("csv", path=path))
    assert df.columns == ["customer_id", "monthly_charges", "total_charges"]
    assert readers.read_source(spark, Source("csv", path=path, normalize=False)).columns[0] == "customerID"
    first = readers.read_source(spark, Source("fallback", paths=[str(tmp_path / "no.csv"), path]))
    assert first.first()["customer_id"] == "7590-VHVEG"
    with pytest.raises(RuntimeError, match="no readable location"):
        readers.read_source(spark, Source("fallback", paths=[str(tmp_path / "no.csv")]))
    for bad in (Source("csv"), Source("table"), Source("files"), Source("ftp")):
        with pytest.raises(ValueError):
            readers.read_source(spark, bad)


def test_filter_may_use_columns_that_are_not_kept(spark):
    spark.createDataFrame([(1, 5), (2, 7)], "a int, b int").createOrReplaceTempView("pairs")
    assert rows(readers.read_table(spark, "pairs", "b > 5", ["a"])) == [(2,)]


def test_filter_reaches_the_scan(spark, tmp_path):
    spark.createDataFrame([(1, 5, "x")], "a int, b int, c string").write.parquet(str(tmp_path / "t"))
    df = readers.select_filtered(spark.read.parquet(str(tmp_path / "t")), "b > 5", ["a"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(b,5)" in plan and "ReadSchema: struct<a:int,b:int>" in plan


def test_synthetic_log(spark):
    keys = spark.range(200).withColumnRenamed("id", "k")
    log = synthetic.synthetic_log(keys, "k").cache()
    assert log.count() == 200 * 30
    again = synthetic.synthetic_log(keys.repartition(7), "k")
    assert log.exceptAll(again).isEmpty()
    facts = log.selectExpr(
        "avg(int(churn is null))", "avg(int(senior_citizen = 'Yes'))", "min(tenure)", "max(tenure)", "max(monthly_charges)",
        "avg(int(customer_id rlike '^[0-9]{4}-[A-Z]{4}$'))", "count(distinct date(inference_timestamp))",
    ).first()
    assert abs(facts[0] - 0.8) < 0.03 and abs(facts[1] - 0.15) < 0.03
    assert facts[2] == 0 and facts[3] == 72 and facts[4] <= 118 and facts[5] == 1.0 and facts[6] == 30
    assert "churn" not in synthetic.without_label(log, "churn").columns
    log.unpersist()


def test_a_synthetic_log_of_few_keys_is_made_by_many_tasks(spark):
    log = synthetic.synthetic_log(spark.range(0, 400, 1, 1).withColumnRenamed("id", "k"), "k")
    assert log.select(F.spark_partition_id()).distinct().count() >= 4


def test_rows_beyond(spark):
    schema = "a string, b double, t timestamp_ntz"
    at = dt.datetime(2024, 1, 1)
    log = spark.createDataFrame([("x", 1.0, at), ("x", 1.0, at), (None, 2.0, at), ("y", None, None)], schema)
    other = spark.createDataFrame([("x", 1.0, at), (None, 2.0, at), ("z", 1.0, at)], schema)
    assert synthetic.rows_beyond(log, other) == log.exceptAll(other).count() == 2
    assert synthetic.rows_beyond(log, log) == 0 and synthetic.rows_beyond(log.limit(0), other) == 0


def test_scratch_folder_comes_from_the_session(spark):
    assert scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


# --- several writers, buckets -------------------------------------------------


def at_switch(monkeypatch, spark, action):
    """Run ``action`` once, right before the next change of a location."""
    run, left = type(spark).sql, [action]

    def sql(self, text, *args, **kwargs):
        if "SET LOCATION" in text and left:
            left.pop()()
        return run(self, text, *args, **kwargs)

    monkeypatch.setattr(type(spark), "sql", sql)


@pytest.mark.parametrize("buckets", [0, 8])
def test_interleaved_merges_keep_both_changes(spark, monkeypatch, buckets):
    """The second merge starts and ends between the first one's write and its switch."""
    name = f"default.both_{buckets}"
    df = spark.createDataFrame([(i, float(i)) for i in range(50)], "k int, v double")
    FeatureStore(spark, "default").reset_and_write(f"both_{buckets}", df, ["k"], buckets=buckets)
    second = spark.createDataFrame([(200, 2.0), (3, -3.0)], "k int, v double")
    at_switch(monkeypatch, spark, lambda: tables.merge_into(spark, name, second))
    tables.merge_into(spark, name, spark.createDataFrame([(100, 1.0), (4, -4.0)], "k int, v double"))
    monkeypatch.undo()
    want = {i: float(i) for i in range(50)} | {3: -3.0, 4: -4.0, 100: 1.0, 200: 2.0}
    assert dict(rows(spark.table(name).select("k", "v"))) == want
    assert dict(rows(tables.read_version(spark, name).select("k", "v"))) == want


@pytest.mark.parametrize("buckets", [0, 8])
def test_a_merge_planned_on_an_older_state_is_planned_again(spark, buckets):
    name = f"default.stale_{buckets}"
    df = spark.createDataFrame([(i, float(i)) for i in range(5)], "k int, v double")
    FeatureStore(spark, "default").reset_and_write(f"stale_{buckets}", df, ["k"], buckets=buckets)
    seen = tables.current_version(spark, name)
    tables.merge_into(spark, name, df.limit(1).withColumn("k", F.lit(200)))
    with pytest.raises(tables.WriteConflict):
        tables.publish_version(spark, name, df, after=seen)
    plans = []

    def plan(version):
        plans.append(version)
        if len(plans) == 1:  # another writer is first
            tables.merge_into(spark, name, df.limit(1).withColumn("k", F.lit(300)))
        return tables.read_version(spark, name, version).select("k", "v").withColumn("v", F.col("v") + 1)

    tables.change_state(spark, name, plan)
    assert len(plans) == 2 and plans[1] > plans[0]
    found = dict(rows(spark.table(name).select("k", "v")))
    assert sorted(found) == [0, 1, 2, 3, 4, 200, 300] and found[4] == 5.0


def test_merges_from_several_threads(spark):
    df = spark.createDataFrame([(i, 0.0) for i in range(4)], "k int, v double")
    FeatureStore(spark, "default").reset_and_write("threads", df, ["k"])
    changes = [spark.createDataFrame([(10 + i, 1.0), (i % 4, float(i))], "k int, v double") for i in range(6)]
    with ThreadPoolExecutor(3) as pool:
        list(pool.map(lambda c: tables.merge_into(spark, "default.threads", c), changes))
    found = dict(rows(spark.table("default.threads")))
    assert sorted(found) == [0, 1, 2, 3, *range(10, 16)] and found[3] == 3.0 and found[2] == 2.0


def test_a_state_whose_writer_died_before_the_switch_is_followed(spark, monkeypatch):
    """A mark without a switch, as a killed process leaves it."""
    df = spark.createDataFrame([(1, 1.0)], "k int, v double")
    FeatureStore(spark, "default").reset_and_write("dead", df, ["k"])
    monkeypatch.setattr(tables, "_switch", lambda *a: None)
    tables.merge_into(spark, "default.dead", df.withColumn("v", F.lit(2.0)))
    monkeypatch.undo()
    assert rows(spark.table("default.dead")) == [(1, 1.0)]
    tables.merge_into(spark, "default.dead", df.withColumn("k", F.lit(5)))
    assert dict(rows(spark.table("default.dead"))) == {1: 2.0, 5: 1.0}
    base = tables.properties(spark, "default.dead")[tables.BASE]
    files, path = tables._folder(spark, f"{base}/_after-{tables.current_version(spark, 'default.dead')}")
    files.create(path, False).close()  # and a mark whose writer died before it wrote the number
    monkeypatch.setattr(tables, "VOID_AFTER", -1.0)
    tables.merge_into(spark, "default.dead", df.withColumn("k", F.lit(6)))
    assert sorted(dict(rows(spark.table("default.dead")))) == [1, 5, 6]


def test_a_refused_reset_leaves_the_table(spark):
    df = spark.createDataFrame([(i, 1.0) for i in range(10)], "k int, v double")
    store = FeatureStore(spark, "default")
    store.reset_and_write("refused", df, ["k"])
    with pytest.raises(ValueError, match="data checks failed"):
        store.reset_and_write("refused", df.unionByName(df), ["k"])
    with pytest.raises(PySparkException):
        store.reset_and_write("refused", df.withColumn("v", F.raise_error(F.lit("boom")).cast("double")), ["k"])
    assert store.read("refused").count() == 10
    store.reset_and_write("refused", store.read("refused").filter("k > 6"), ["k"])  # from the table itself
    assert store.read("refused").count() == 3


def test_dropped_tables_leave_no_folders(spark):
    df = spark.createDataFrame([(1, 1.0)], "k int, v double")
    store = FeatureStore(spark, "default")
    store.reset_and_write("gone", df, ["k"])
    first = tables.properties(spark, "default.gone")[tables.BASE]
    store.reset_and_write("gone", df, ["k"])
    second = tables.properties(spark, "default.gone")[tables.BASE]
    files, path = tables._folder(spark, second)
    assert not files.exists(tables._folder(spark, first)[1]) and files.exists(path)
    store.drop("gone")
    assert not files.exists(path)
    tables.ensure_schemas(spark, {"lake_c": ""})
    FeatureStore(spark, "lake_c").reset_and_write("t", df, ["k"])
    third = tables.properties(spark, "lake_c.t")[tables.BASE]
    tables.recreate_schema(spark, "lake_c", confirm=True)
    assert not files.exists(tables._folder(spark, third)[1])


def test_unfinished_states_dont_push_finished_ones_out(spark):
    df = spark.createDataFrame([(1, 1.0)], "k int, v double")
    FeatureStore(spark, "default").reset_and_write("torn", df, ["k"])
    broken = df.withColumn("v", F.raise_error(F.lit("boom")).cast("double"))
    for _ in range(tables.RETAINED + 2):
        with pytest.raises(PySparkException):
            tables.publish_version(spark, "default.torn", broken)
    tables.publish_version(spark, "default.torn", df.withColumn("v", F.lit(2.0)))
    assert rows(tables.read_version(spark, "default.torn", 1)) == [(1, 1.0)]


def test_a_merge_writes_only_the_buckets_it_touches(spark):
    df = spark.range(2000).selectExpr("id AS k", "CAST(id AS double) AS v", "'x' AS c")
    FeatureStore(spark, "default").reset_and_write("parted", df, ["k"], buckets=100)
    change = spark.createDataFrame([(i * 37, -1.0) for i in range(9)] + [(9999, -2.0)], "k int, v double")
    tables.merge_into(spark, "default.parted", change)
    base, version = tables.properties(spark, "default.parted")[tables.BASE], tables.current_version(spark, "default.parted")
    files, path = tables._folder(spark, f"{base}/_version={version}")
    written = [s.getPath().getName() for s in files.listStatus(path) if "_bucket=" in s.getPath().getName()]
    assert 0 < len(written) <= 10
    want = {i: float(i) for i in range(2000)} | {i * 37: -1.0 for i in range(9)} | {9999: -2.0}
    got = spark.table("default.parted")
    assert {r["k"]: r["v"] for r in got.collect()} == want and got.filter("k = 9999").first()["c"] is None
    assert got.filter("_bucket = 5").count() == sum(1 for r in got.collect() if r["_bucket"] == 5)
    # Only those buckets are read, too.
    assert len(set(written)) == len({f.split("_bucket=")[1].split("/")[0] for f in got.inputFiles() if f"_version={version}/" in f})


def test_retention_of_a_table_with_buckets(spark):
    df = spark.range(200).selectExpr("id AS k", "0 AS v")
    FeatureStore(spark, "default").reset_and_write("aged", df, ["k"], buckets=16)
    want = dict.fromkeys(range(200), 0)
    for i in range(1, 9):
        tables.merge_into(spark, "default.aged", spark.createDataFrame([(i, i), (50, i)], "k long, v int"))
        want |= {i: i, 50: i}
        assert {r["k"]: r["v"] for r in spark.table("default.aged").collect()} == want
    now = tables.current_version(spark, "default.aged")
    for back in range(tables.RETAINED):
        state = {r["k"]: r["v"] for r in tables.read_version(spark, "default.aged", now - back).collect()}
        assert state == dict.fromkeys(range(200), 0) | {i: i for i in range(1, 9 - back)} | {50: 8 - back}
    base = tables.properties(spark, "default.aged")[tables.BASE]
    files, path = tables._folder(spark, base)
    found = {s.getPath().getName() for s in files.listStatus(path)}
    assert "_version=0" not in found and f"_map-{now - tables.RETAINED}" not in found
    first = [s.getPath().getName() for s in files.listStatus(tables._folder(spark, f"{base}/_version=1")[1])]
    assert len([n for n in first if "_bucket" in n]) < 16  # the buckets that were rewritten since are gone


@pytest.mark.parametrize("stop", [0, 1, 2])
def test_a_crash_between_buckets_and_the_same_merge_again(spark, monkeypatch, stop):
    df = spark.range(40).selectExpr("id AS k", "0 AS v")
    name = f"default.midway_{stop}"
    FeatureStore(spark, "default").reset_and_write(f"midway_{stop}", df, ["k"], buckets=8)
    change = spark.createDataFrame([(i, 1) for i in range(0, 60, 4)], "k long, v int")
    run, seen = type(spark).sql, []

    def crash(self, text, *args, **kwargs):
        if "SET LOCATION" in text:
            seen.append(text)
            if len(seen) > stop:
                raise RuntimeError("stopped")
        return run(self, text, *args, **kwargs)

    monkeypatch.setattr(type(spark), "sql", crash)
    with pytest.raises(RuntimeError, match="stopped"):
        tables.merge_into(spark, name, change)
    monkeypatch.undo()
    tables.merge_into(spark, name, change)
    want = dict.fromkeys(range(40), 0) | dict.fromkeys(range(0, 60, 4), 1)
    assert {r["k"]: r["v"] for r in spark.table(name).collect()} == want


def test_a_table_with_buckets_like_any_other(spark):
    df = spark.createDataFrame([(1, None, "a"), (2, "No", "b")], "k int, churn string, x string")
    FeatureStore(spark, "default").reset_and_write("like", df, ["k"], buckets=4)
    labels = spark.createDataFrame([(1, "Yes"), (9, "No")], "k long, churn string")
    tables.merge_into(spark, "default.like", labels, update=["churn"], insert=False)
    assert rows(spark.table("default.like").drop("_bucket")) == [(1, "Yes", "a"), (2, "No", "b")]
    other = spark.createDataFrame([("b", "Never")], "x string, churn string")
    tables.merge_into(spark, "default.like", other, keys=["x"], update=["churn"], insert=False)  # not by the own key
    assert rows(spark.table("default.like").drop("_bucket")) == [(1, "Yes", "a"), (2, "Never", "b")]
    tables.publish_version(spark, "default.like", df.filter("k = 2"))  # a whole state leaves no other bucket
    assert rows(spark.table("default.like").drop("_bucket")) == [(2, "No", "b")]
    with pytest.raises(ValueError, match="_bucket"):
        tables.create_keyed_table(spark, "default.bad", df.withColumn("_bucket", F.lit(1)).schema, ["k"], buckets=2)


def test_other_formats_merge_by_themselves(spark):
    """Without such a format here, the statement reaches the analyzer, which knows none of the catalog's tables to have it."""
    df = spark.createDataFrame([(1, 1.0)], "k int, v double")
    tables.write_table(df, "default.plain")
    with pytest.raises(PySparkException, match="(?i)merge"):
        tables._merge_rows(spark, "default.plain", df, ["k"], None, True)
