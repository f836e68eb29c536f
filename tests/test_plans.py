"""Plan-shape checks: the properties the operators rely on at scale."""

import contextlib
import io


from tablewright.operators import changes, columns, keys, runlog
from tablewright.sinks.versioned import _clustered


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def test_conform_prunes_columns_at_scan(spark, sf_dir):
    c = spark.read.parquet(f"{sf_dir}/customer.parquet")
    target = spark.createDataFrame([], "c_custkey bigint, name string").schema
    out = columns.sync_with_table(c, target, rename="name=c_name").processed.filter("c_custkey > 10")
    p = _plan(out)
    assert "ReadSchema: struct<c_custkey:bigint,c_name:string>" in p
    assert "PushedFilters: [IsNotNull(c_custkey), GreaterThan(c_custkey,10)]" in p


def test_equi_merge_has_no_nested_loop_or_cartesian(spark, sf_dir):
    c = spark.read.parquet(f"{sf_dir}/customer.parquet")
    m = changes.merge(c, c.filter("c_acctbal < 0"), "target.c_custkey = updates.c_custkey", check_unique=False)
    p = _plan(m)
    assert "NestedLoop" not in p and "Cartesian" not in p
    assert "LeftOuter" in p and "LeftAnti" in p


def test_anti_side_reads_only_target_keys(spark, sf_dir):
    c = spark.read.parquet(f"{sf_dir}/customer.parquet")
    m = changes.merge(c, c.filter("c_acctbal < 0"), "target.c_custkey = updates.c_custkey", check_unique=False)
    assert "ReadSchema: struct<c_custkey:bigint>" in _plan(m)


def test_latest_per_key_aggregates_before_shuffle(spark, sf_dir):
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    p = _plan(runlog.latest_per_key(e, ["user_id"], ["ts", "event_id"]))
    assert "partial_max_by" in p and "Window" not in p


def test_prune_and_distinct_pre_aggregate(spark, sf_dir):
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    p = _plan(keys.prune_target(o, o.filter("o_totalprice > 1000"), ["o_orderstatus"]))
    assert "LeftSemi" in p and p.count("HashAggregate") >= 2  # partial + final before the semi join
    p = _plan(runlog.distinct_partitions(o, ["o_orderstatus"]))
    assert p.count("HashAggregate") == 2


def test_partitioned_write_is_rebalanced(spark, sf_dir):
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    assert "REBALANCE_PARTITIONS_BY_COL" in _plan(_clustered(o, ["o_orderstatus"]))
    assert "Exchange" not in _plan(_clustered(o, []))


def test_hashing_stays_in_codegen(spark, sf_dir):
    from tablewright.functions import hashing

    c = spark.read.parquet(f"{sf_dir}/customer.parquet")
    p = _plan(hashing.hash_columns(c, "h", 256, "c_custkey", "c_name"))
    assert "*(1) Project" in p and "PythonUDF" not in p and "BatchEvalPython" not in p


def test_keyed_merge_finds_inserts_against_distinct_keys(spark, sf_dir):
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    m = changes.merge(o, o.filter("o_totalprice > 1000"), None, keys=["o_custkey"], check_unique=False)
    p = _plan(m)
    assert "LeftAnti" in p and "HashAggregate(keys=[__tw_t0" in p


def test_theta_join_on_a_dimension_broadcasts_it(spark, sf_dir):
    c = spark.read.parquet(f"{sf_dir}/customer.parquet")
    n = spark.read.parquet(f"{sf_dir}/nation.parquet")
    p = _plan(keys.theta_join(c, n, ["c_nationkey >= n_nationkey"], nested_loop=True))
    assert "BroadcastNestedLoopJoin" in p and "CartesianProduct" not in p
    assert "BroadcastExchange" in p and "nation.parquet" in p.split("BroadcastExchange", 1)[1]
