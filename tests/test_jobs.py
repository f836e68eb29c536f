import pytest
from pyspark.sql import functions as F

from tablewright.operators.runlog import distinct_partitions, latest_per_key, stats_rows
from tablewright.plans import jobs
from tablewright.plans import metadata as md
from tablewright.session import scratch_path, unique_table_name


def test_metadata_ddl_has_four_tables(spark):
    stmts = md.metadata_ddl("m", "/base")
    assert len(stmts) == 5 and all("USING parquet" in s for s in stmts[1:])


def test_latest_per_key_ties_and_maps(spark):
    df = spark.createDataFrame(
        [(1, "a", 1, 1, {"x": "1"}), (1, "b", 2, 1, {"x": "2"}), (1, "c", 2, 2, {}), (2, "d", 0, 0, None)],
        "id int, status string, t int, seq int, m map<string,string>",
    )
    got = {r.id: (r.status, r.m) for r in latest_per_key(df, ["id"], ["t", "seq"]).collect()}
    assert got == {1: ("c", {}), 2: ("d", None)}


def test_stats_rows(spark):
    rows = stats_rows(spark, "r1", {"b": 2, "a": None}).collect()
    assert [(r.stat_id, r.stat_name, r.stat_value) for r in rows] == [("r1", "a", None), ("r1", "b", "2")]


def test_distinct_partitions(spark, sf_dir):
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    assert distinct_partitions(o, ["o_orderstatus"]).count() == 3


def test_failed_load_logs_error(spark, sf_dir):
    db = unique_table_name("meta")
    md.create_metadata_tables(spark, db, scratch_path(spark, "meta"))
    md.add_mount(spark, db, "dwx", sf_dir, scratch_path(spark, "tgt"))
    md.add_entity(spark, db, "e1", "dwx", "missing_target", {"format": "parquet"})  # conform needs a target table
    md.log_operation(spark, db, "op-9", "e1", None, {"path": "/orders.parquet"})
    with pytest.raises(Exception):
        jobs.load_from_metadata(spark, db, "op-9")
    cur = md.operations_current(spark, db).filter("op_id = 'op-9'").first()
    assert cur.status == md.ERROR and "conforming needs" in cur.exception_details and cur.end_tm is not None


def test_resolve_needs_exactly_one(spark):
    db = unique_table_name("meta")
    md.create_metadata_tables(spark, db, scratch_path(spark, "meta"))
    with pytest.raises(LookupError):
        md.resolve_load(spark, db, "nope")


def test_column_selector_load(spark, sf_dir):
    db = unique_table_name("meta")
    md.create_metadata_tables(spark, db, scratch_path(spark, "meta"))
    tdb = unique_table_name("dw")
    md.add_mount(spark, db, tdb, sf_dir, scratch_path(spark, "tgt"))
    md.add_entity(spark, db, "e1", tdb, "nation_sel", {"format": "parquet", "targetCols": "name,key", "colMapping": "2,1"})
    md.log_operation(spark, db, "op-1", "e1", None, {"path": "/nation.parquet"})
    res = jobs.load_from_metadata(spark, db, "op-1")
    assert res.metrics["num_output_rows"] == "25"
    out = spark.table(f"`{tdb}`.nation_sel")
    assert out.columns == ["name", "key"] and out.count() == 25
    stats = {r.stat_name: r.stat_value for r in spark.table(f"`{db}`.`{md.STATS}`").collect()}
    assert stats["num_output_rows"] == "25" and stats["operation"] == "CREATE"
    # a second run of the same load overwrites (unpartitioned) and makes version 1
    md.log_operation(spark, db, "op-2", "e1", None, {"path": "/nation.parquet"})
    assert jobs.load_from_metadata(spark, db, "op-2").version == 1
    assert out.count() == 25


def test_chain_order(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/region.parquet")
    out = jobs.chain(df, [lambda d: d.filter("r_regionkey > 1"), lambda d: d.withColumn("x", F.lit(1))])
    assert out.count() == 3 and "x" in out.columns


def test_retries_logged(spark, sf_dir):
    db = unique_table_name("meta")
    md.create_metadata_tables(spark, db, scratch_path(spark, "meta"))
    md.add_mount(spark, db, "dwy", sf_dir, scratch_path(spark, "tgt"))
    md.add_entity(spark, db, "e1", "dwy", "missing_target", {"format": "parquet"})
    md.log_operation(spark, db, "op-r", "e1", None, {"path": "/orders.parquet"})
    with pytest.raises(Exception):
        jobs.load_from_metadata(spark, db, "op-r", max_attempts=6)
    errors = spark.table(f"`{db}`.`{md.OPERATIONS}`").filter("status = 'Error'").collect()
    assert sorted(r.details["retry_count"] for r in errors) == ["0", "1", "2", "3", "4", "5"]


def test_external_format_spec(spark):
    req = md.LoadRequest("op", "e", "db", "t", {"format": "jdbc", "sfTableName": "T1", "option.url": "jdbc:x"},
                         {"sfQuery": " select 1 "}, "", "")
    spec = jobs.spec_from_request(spark, req, conform=False)
    assert spec.source_format == "jdbc" and spec.external_query == " select 1 " and spec.external_table == "T1"
    assert spec.reader_options == {"url": "jdbc:x"}
    req2 = md.LoadRequest("op", "e", "db", "t", {"format": "snowflake"}, {"path": "/x"}, "/m", "")
    assert jobs.spec_from_request(spark, req2, conform=False).source_format == "parquet"


def test_resolve_rows_single_and_batch(spark, sf_dir):
    o = spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        F.col("o_orderkey").cast("string").alias("op_id"), F.col("o_custkey").cast("string").alias("entity_id"),
        F.create_map(F.lit("p"), F.col("o_orderpriority")).alias("details"))
    c = spark.read.parquet(f"{sf_dir}/customer.parquet").select(F.col("c_custkey").cast("string").alias("id"))
    one = md.resolve_rows(o, c, "42").collect()
    assert len(one) == 1 and one[0].op_id == "42" and "op_details" in one[0].asDict()
    assert md.resolve_rows(o, c).count() == o.join(c, o.entity_id == c.id).count()


def test_entities_current_follows_log(spark, sf_dir):
    db = unique_table_name("meta")
    md.create_metadata_tables(spark, db, scratch_path(spark, "meta"))
    md.add_entity(spark, db, "e1", "x", "t1", {})
    md.add_entity(spark, db, "e2", "x", "t2", {})
    md.log_operation(spark, db, "op-1", "e1", md.STARTED)
    md.log_operation(spark, db, "op-1", "e1", md.FINISHED)
    got = {r.id: r.latest_status for r in md.entities_current(spark, db).collect()}
    assert got == {"e1": md.FINISHED, "e2": None}


def test_metadata_merge_load(spark, sf_dir):
    db = unique_table_name("meta")
    md.create_metadata_tables(spark, db, scratch_path(spark, "meta"))
    tdb = unique_table_name("dw")
    md.add_mount(spark, db, tdb, sf_dir, scratch_path(spark, "tgt"))
    details = {"format": "parquet", "partition_column": "n_regionkey", "mode": "merge", "merge_keys": "n_nationkey"}
    md.add_entity(spark, db, "e1", tdb, "nations", details)
    md.log_operation(spark, db, "op-1", "e1", None, {"path": "/nation.parquet"})
    jobs.load_from_metadata(spark, db, "op-1", conform=False)  # creates the table
    md.log_operation(spark, db, "op-2", "e1", None, {"path": "/nation.parquet"})
    res = jobs.load_from_metadata(spark, db, "op-2", conform=False)  # merges the same rows again
    assert res.operation == "MERGE PARTITIONS"
    assert spark.table(f"`{tdb}`.nations").count() == 25
