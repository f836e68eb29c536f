"""Failures between steps, scope at any size, and other rules about rows that must not be lost or doubled."""

import time

import pytest
from pyspark.sql import functions as F

from tablewright.operators import changes, keys
from tablewright.plans import jobs
from tablewright.plans import metadata as md
from tablewright.session import scratch_path, unique_table_name
from tablewright.sinks import store
from tablewright.sinks.versioned import TableError, VersionedTable, write_to_location
from tablewright.streaming import run_available


def _new(spark, df, parts=(), **kw):
    return VersionedTable.create(spark, unique_table_name("safe"), df, root=scratch_path(spark, "safe"), partition_by=parts, **kw)


@pytest.mark.parametrize("gone", [256, 257])
def test_emptying_many_partitions_stays_in_place(spark, gone):
    rows = spark.range(300).select("id", F.col("id").alias("p"))
    t = _new(spark, rows.repartition(4), ["p"], rebalance_writes=False)
    t0 = time.time()
    t.delete(f"id < {gone}", scope="partitions")
    assert time.time() - t0 < 60 and t.version == 0
    assert sorted(r.id for r in t.read().collect()) == list(range(gone, 300))
    assert len([n for n in store.names(spark, t.location()) if n.startswith("p=")]) == 300 - gone


def test_timestamp_partitions_in_another_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        rows = spark.sql("SELECT id, timestamp_seconds(1700000000 + id * 3600) AS ts FROM range(1, 4)")
        t = _new(spark, rows, ["ts"])
        t.delete("id = 2", scope="partitions")
        assert sorted(r.id for r in t.read().collect()) == [1, 3] and t.version == 0
        t.write_static_partition(rows.limit(0).drop("ts"), {"ts": rows.filter("id = 3").select(F.col("ts").cast("string")).first()[0]})
        assert [r.id for r in t.read().collect()] == [1]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_odd_partition_values(spark):
    rows = spark.createDataFrame([(1, "a b"), (2, "x=1/y%20"), (3, None), (4, "é[{*?"), (5, "")], "id int, p string")
    t = _new(spark, rows, ["p"])
    t.update("id IN (1, 2, 3, 4)", {"id": "id + 10"}, scope="partitions")
    assert sorted(r.id for r in t.read().collect()) == [5, 11, 12, 13, 14]
    t.delete("id > 10", scope="partitions")
    assert [r.id for r in t.read().collect()] == [5] and t.version == 0


@pytest.mark.parametrize("parts", [[], ["p"]])
def test_driver_lost_after_the_commit_statement(spark, parts, monkeypatch):
    t = _new(spark, spark.range(100).select("id", (F.col("id") % 3).alias("p")), parts)
    monkeypatch.setattr(VersionedTable, "_set_props", lambda self, props: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        t.delete("id < 5")
    monkeypatch.undo()
    again = VersionedTable(spark, t.name)
    assert again.version == 1 and again.read().count() == 95
    again.delete("id < 10")
    assert again.version == 2 and again.read().count() == 90 and again.read(0).count() == 100 and again.read(1).count() == 95


@pytest.mark.parametrize("parts", [[], ["p"]])
def test_driver_lost_before_the_commit_statement(spark, parts, monkeypatch):
    t = _new(spark, spark.range(100).select("id", (F.col("id") % 3).alias("p")), parts)
    real = store.write_text
    monkeypatch.setattr(store, "write_text", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        t.delete("id < 5")
    monkeypatch.setattr(store, "write_text", real)
    assert t.version == 0 and t.read().count() == 100
    t.delete("id < 10")
    assert t.version == 1 and t.read().count() == 90


def test_root_with_a_table_is_opened_not_overwritten(spark):
    rows = spark.range(10).select("id", (F.col("id") % 2).alias("p"))
    t = _new(spark, rows, ["p"])
    t.delete("id = 0")
    root = t.root
    spark.sql(f"DROP TABLE {t.name}")  # the next session has no catalog entry
    with pytest.raises(TableError):
        VersionedTable.create(spark, t.name, rows, root=root, partition_by=["p"])
    back = VersionedTable.open(spark, t.name, root)
    assert back.version == 1 and back.read().count() == 9 and back.read(0).count() == 10 and back.partition_columns == ["p"]
    with pytest.raises(TableError):
        VersionedTable.open(spark, unique_table_name("none"), scratch_path(spark, "none"))


def test_user_properties_survive_and_versions_can_be_dropped(spark):
    t = _new(spark, spark.range(10).select("id", (F.col("id") % 2).alias("p")), ["p"])
    spark.sql(f"ALTER TABLE {t.name} SET TBLPROPERTIES ('owner.note' = 'mine')")
    t.overwrite(t.read().filter("id > 3"))
    t.delete("id = 9")
    assert t.properties()["owner.note"] == "mine"
    t.drop_versions(before=2)
    assert t.read().count() == 5 and t.version == 2
    with pytest.raises(TableError):
        t.read(0)
    assert sum(n.startswith("version-") for n in store.names(spark, t.root)) == 1
    assert not [n for n in store.names(spark, t.root) if n.startswith("_scratch")]


def test_writers_do_not_share_the_overwrite_mode(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    t = _new(spark, orders, ["o_orderstatus"])
    for mode in ("STATIC", "DYNAMIC"):  # whatever another writer sets meanwhile
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", mode)
        t.overwrite_partitions(orders.filter("o_orderstatus = 'P'"))
        t.delete("o_orderkey < 0", scope="partitions")
        assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == mode
    spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert t.read().count() == orders.count()


def test_bucketed_partitions_are_replaced_alone(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    t = _new(spark, orders, ["o_orderstatus"], bucket_by=(4, ["o_orderkey"]))
    t.overwrite_partitions(orders.filter("o_orderstatus = 'P'"))
    t.append(orders.filter("o_orderstatus = 'P'"))
    t.merge(orders.filter("o_orderstatus = 'F'").withColumn("o_totalprice", F.lit(0.0)), None, keys=["o_orderkey"], scope="partitions")
    n = orders.filter("o_orderstatus = 'P'").count()
    assert t.read().count() == orders.count() + n and t.version == 0
    assert t.read().filter("o_orderstatus = 'F' AND o_totalprice <> 0").count() == 0


# ------------------------------------------------------------- loads
def _load(spark, sf_dir, name, details, *ops):
    db, tdb = unique_table_name("meta"), unique_table_name("dw")
    md.create_metadata_tables(spark, db, scratch_path(spark, "meta"))
    md.add_mount(spark, db, tdb, sf_dir, scratch_path(spark, "tgt"))
    md.add_entity(spark, db, "e1", tdb, name, details)
    for i, op in enumerate(ops):
        md.log_operation(spark, db, f"op-{i}", "e1", None, op)
    return db, f"`{tdb}`.{name}"


def test_a_load_is_not_repeated_when_its_stats_fail(spark, sf_dir, monkeypatch):
    db, name = _load(spark, sf_dir, "nations", {"format": "parquet", "mode": "append"}, {"path": "/nation.parquet"}, {"path": "/nation.parquet"})
    jobs.load_from_metadata(spark, db, "op-0", conform=False)
    monkeypatch.setattr(md, "store_stats", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        jobs.load_from_metadata(spark, db, "op-1", conform=False, max_attempts=2)
    assert spark.table(name).count() == 50


def test_replace_where_on_an_unpartitioned_target(spark, sf_dir):
    db, name = _load(spark, sf_dir, "nations", {"format": "parquet"}, {"path": "/nation.parquet"},
                     {"path": "/nation.parquet", "replaceWhere": "n_regionkey >= 0"}, {"path": "/nation.parquet", "replaceWhere": "n_regionkey = 1"})
    assert jobs.load_from_metadata(spark, db, "op-0", conform=False).operation == "CREATE"
    assert jobs.load_from_metadata(spark, db, "op-1", conform=False).operation == "REPLACE WHERE"
    with pytest.raises(Exception, match="replaceWhere"):
        jobs.load_from_metadata(spark, db, "op-2", conform=False)  # rows outside the condition
    assert spark.table(name).count() == 25


def test_unknown_mode_and_mounts_are_errors(spark, sf_dir):
    db, name = _load(spark, sf_dir, "nations", {"format": "parquet", "mode": "appned"}, {"path": "/nation.parquet"})
    with pytest.raises(ValueError):
        jobs.load_from_metadata(spark, db, "op-0", conform=False)
    tdb = name.split("`")[1]
    md.add_mount(spark, db, tdb, sf_dir, "/other")
    with pytest.raises(LookupError):
        md.resolve_load(spark, db, "op-0")
    md.add_entity(spark, db, "e2", "unmounted", "x", {})
    md.log_operation(spark, db, "op-9", "e2", None, {"path": "/nation.parquet"})
    with pytest.raises(LookupError):
        md.resolve_load(spark, db, "op-9")


def test_write_to_location(spark):
    path = scratch_path(spark, "plain")
    write_to_location(spark.range(3), path, "append")
    write_to_location(spark.range(3), path, "APPEND")
    assert spark.read.parquet(path).count() == 6
    write_to_location(spark.range(2), path, "overwrite")
    assert spark.read.parquet(path).count() == 2
    with pytest.raises(ValueError):
        write_to_location(spark.range(2), path, "appned")


# ------------------------------------------------------------- streams
@pytest.mark.parametrize("mode, kw", [("append", {}), ("merge", {"merge_keys": ["n_nationkey"]})])
def test_replayed_batch_has_no_second_effect(spark, sf_dir, monkeypatch, mode, kw):
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet")
    landing, ckpt = scratch_path(spark, "landing"), scratch_path(spark, "ckpt")
    t = _new(spark, nation.limit(0))
    nation.write.parquet(landing)

    def run():
        run_available(spark.readStream.schema(nation.schema).parquet(landing), t.name, f"s_{t.name}", mode=mode, checkpoint=ckpt, **kw)

    real, calls = VersionedTable._set_props, []

    def lost(self, props):
        if any("stream" in k for k in props) and not calls:
            calls.append(1)
            raise RuntimeError("lost between write and record")
        return real(self, props)

    monkeypatch.setattr(VersionedTable, "_set_props", lost)
    with pytest.raises(Exception):
        run()
    run()
    assert calls and t.read().count() == 25
    assert not [n for n in store.names(spark, t.root) if n.startswith("_append")]
    t.overwrite(t.read())
    run()  # the record outlives a new version
    assert t.read().count() == 25


def test_append_once_finishes_a_half_moved_batch(spark, monkeypatch):
    t = _new(spark, spark.range(0).select("id", F.lit(0).alias("p")), ["p"])
    rows = spark.range(40).repartition(4).select("id", (F.col("id") % 4).cast("int").alias("p"))
    real, moved = store.move_new, []

    def lost(*a):
        if len(moved) == 2:
            raise OSError("lost")
        moved.append(a)
        return real(*a)

    monkeypatch.setattr(store, "move_new", lost)
    with pytest.raises(OSError):
        t.append_once(rows, "b1")
    monkeypatch.setattr(store, "move_new", real)
    t.append_once(rows, "b1")
    assert sorted(r.id for r in t.read().collect()) == list(range(40))


# ------------------------------------------------------------- merges
def test_scoped_merge_without_inserts(spark):
    rows = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], "id int, p string, v int")
    upd = spark.createDataFrame([(2, "b", 20), (3, "c", 30)], "id int, p string, v int")
    for aligned in (False, True):
        t = _new(spark, rows, ["p"])
        done = t.merge(upd, None, keys=["id"], scope="partitions", insert=False, aligned=aligned)
        assert sorted((r.id, r.v) for r in t.read().collect()) == [(1, 1), (2, 20)]
        assert done.metrics["num_updated_rows"] == "1" and "num_inserted_rows" not in done.metrics


def test_guard_looks_at_the_whole_condition(spark):
    rows = spark.createDataFrame([(1, 1)], "id int, v int")
    upd = spark.createDataFrame([(1, 5, True), (1, 6, False)], "id int, v int, live boolean")
    on = "target.id = updates.id AND updates.live"
    assert changes.merge(rows, upd, on, keys=["id"], insert=False).collect()[0].v == 5
    with pytest.raises(changes.MergeConflict):
        changes.merge(rows, upd, "target.id = updates.id", keys=["id"], insert=False)
    with pytest.raises(changes.MergeConflict):
        changes.merge(rows, upd, "target.id = updates.id", insert=False)


def test_pairs_of_all_rows_need_the_callers_word(spark):
    a, b = spark.range(3), spark.range(3)
    with pytest.raises(ValueError, match="nested_loop"):
        keys.theta_join(a, b, ["id < id"])
    with pytest.raises(ValueError, match="nested_loop"):
        changes.merge(a, b, "target.id < updates.id", check_unique=False)
    assert changes.merge(a, b.filter("id = 2"), "target.id < updates.id", update_when="false", nested_loop=True).count() == 3
    t = _new(spark, a)
    with pytest.raises(ValueError):
        t.merge(b, "target.id < updates.id")


def test_names_in_any_case(spark):
    t = _new(spark, spark.createDataFrame([(1, "a")], "id int, p string"), ["p"])
    t.append(spark.createDataFrame([("b", 2)], "P string, ID int"))
    t.update("ID = 1", {"P": "'c'"}, scope="partitions")
    t.delete_then_write(spark.createDataFrame([(9, "b")], "id int, p string"), ["P"])
    assert sorted((r.id, r.p) for r in t.read().collect()) == [(1, "c"), (9, "b")] and t.last_operation == "DELETE THEN WRITE"


def test_null_keys_match_null_keys(spark):
    rows = spark.createDataFrame([(1, None, "a"), (2, 5, "a"), (3, None, "b")], "id int, k int, p string")
    new = spark.createDataFrame([(7, None, "a")], "id int, k int, p string")
    for scope in ("table", "partitions"):
        t = _new(spark, rows, ["p"])
        t.delete_then_write(new, ["k"], scope=scope)
        assert sorted(r.id for r in t.read().collect()) == [2, 7]
    t = _new(spark, rows, ["p"])
    t.delete_then_write(new.withColumn("p", F.lit(None).cast("string")), ["p"])
    assert sorted(r.id for r in t.read().collect()) == [1, 2, 3, 7]


def test_rewrite_reads_only_touched_partitions(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    t = _new(spark, orders, ["o_orderstatus"])
    touched, path = t._stored(t._per_dir(t.read(), F.col("o_orderstatus") == "P"))
    rows = t._rows_in(t.read(), touched.filter("gone > 0"))
    assert rows.count() == orders.filter("o_orderstatus = 'P'").count()
    assert "dynamicpruningexpression" in rows._jdf.queryExecution().executedPlan().toString()
    store.delete(spark, path)


def test_null_partitions_are_rewritten(spark):
    rows = spark.createDataFrame([(1, None, 1), (2, "a", None), (3, None, None), (4, "a", 1)], "id int, p string, q int")
    t = _new(spark, rows, ["p", "q"])
    t.update("id IN (1, 2, 3)", {"id": "id + 10"}, scope="partitions")
    t.merge(rows.filter("id = 4").withColumn("q", F.lit(None).cast("int")), None, keys=["id"], scope="partitions")
    assert sorted((r.id, r.p, r.q) for r in t.read().collect()) == [(4, "a", None), (11, None, 1), (12, "a", None), (13, None, None)]
    t.delete("id = 13", scope="partitions")
    assert sorted(r.id for r in t.read().collect()) == [4, 11, 12] and t.version == 0
