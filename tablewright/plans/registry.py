"""Registered queries: one per operator of the inventory, each with an
independent DuckDB SQL oracle over the same parquet tables.

Every query reads the driver tables in full (or data Spark derives from them)
and, for sinks, writes real tables under the session's shared work folder and
returns the content read back.  Row subsets below are always chosen by column
values that scale with the data (segment, status, priority), never by ids.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType

from tablewright.functions import hashing, timefmt
from tablewright.operators import columns, keys, runlog
from tablewright.plans import jobs
from tablewright.plans import metadata as md
from tablewright.session import scratch_path, unique_table_name
from tablewright.sinks.versioned import VersionedTable, create_like
from tablewright.sources import files
from tablewright.sources.csv_layout import csv_schema as build_csv_schema

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ----------------------------------------------------------------- sources
def q_scan_parquet(spark, d):
    return files.read_parquet(spark, f"{d}/orders.parquet").select("o_orderkey", "o_custkey", "o_totalprice")


def q_scan_json(spark, d):
    path = scratch_path(spark, "scan_json")
    table(spark, d, "customer").write.json(path)
    return files.read_json(spark, path).select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")


def q_scan_orc(spark, d):
    path = scratch_path(spark, "scan_orc")
    table(spark, d, "part").write.orc(path)
    return files.read_orc(spark, path)


def _customer_csv(spark, d, delimiter: str) -> str:
    path = scratch_path(spark, "customer_csv")
    table(spark, d, "customer").write.option("delimiter", delimiter).csv(path)
    return path


def q_scan_csv_schema(spark, d):
    path = _customer_csv(spark, d, ";")
    schema = table(spark, d, "customer").schema
    return files.read_csv(spark, path, {"delimiter": ";"}, schema)


def q_scan_csv_plain(spark, d):
    return files.read_csv(spark, _customer_csv(spark, d, ","))


def q_csv_header_types(spark, d):
    path = _customer_csv(spark, d, ";")
    cust = table(spark, d, "customer")
    # target table spelled in upper case; "segment" is not in it → string
    target = cust.select(*[F.col(c).alias(c.upper()) for c in cust.columns if c != "c_mktsegment"]).schema
    header = "c_custkey|c_name|c_nationkey|c_acctbal|segment".split("|")
    return files.read_csv(spark, path, {"delimiter": ";"}, build_csv_schema(header, target))


# -------------------------------------------------------- column processors
def q_column_selector(spark, d):
    return columns.select_by_position(table(spark, d, "customer"), "cust_id, segment, balance", "1,5,4")


SYNC_ADD = "src='tpch'|balance_cents=CAST(round(c_acctbal * 100) AS BIGINT)|comment=null|nation_parsed=c_nationkey|C_NAME=upper(c_name)"
SYNC_RENAME = "customer_name=c_name|nation=nation_parsed|C_MKTSEGMENT=c_mktsegment"
SYNC_DROP = "c_nationkey|C_PHONE"


def _sync_target(spark):
    return spark.createDataFrame(
        [],
        "c_custkey bigint, customer_name string, nation int, c_acctbal string, c_mktsegment string, "
        "src string, balance_cents bigint, comment string",
    ).schema


def q_sync_add(spark, d):
    return columns.add_columns(table(spark, d, "customer"), SYNC_ADD, _sync_target(spark))


def q_sync_rename(spark, d):
    added = columns.add_columns(table(spark, d, "customer"), SYNC_ADD, _sync_target(spark))
    return columns.rename_columns(added, SYNC_RENAME)


def q_sync_drop(spark, d):
    added = columns.add_columns(table(spark, d, "customer"), SYNC_ADD, _sync_target(spark))
    return columns.drop_columns(columns.rename_columns(added, SYNC_RENAME), SYNC_DROP)


def q_sync_conform(spark, d):
    return columns.sync_with_table(table(spark, d, "customer"), _sync_target(spark), SYNC_ADD, SYNC_RENAME, SYNC_DROP).processed


def _orders_with_bad_dates(spark, d):
    o = table(spark, d, "orders")
    early = o.filter(F.col("o_orderpriority") == "1-URGENT").withColumn("o_orderdate", F.lit("1980-06-15 00:00:00").cast("timestamp_ntz"))
    late = o.filter(F.col("o_orderpriority") == "5-LOW").withColumn("o_orderdate", F.lit("2999-01-01 00:00:00").cast("timestamp_ntz"))
    unknown = o.filter(F.col("o_orderpriority") == "3-MEDIUM").withColumn("o_orderdate", F.lit(None).cast("timestamp_ntz"))
    return o.unionByName(early).unionByName(late).unionByName(unknown)


def q_year_sanity(spark, d):
    return timefmt.filter_year_range(_orders_with_bad_dates(spark, d), ["o_orderdate"])


def q_select_matching(spark, d):
    return columns.select_matching(table(spark, d, "part"), [("size", False), ("price", False), ("p_partkey", True), ("p_nam", True)])


# --------------------------------------------------------------- functions
def _customer_with_nulls(spark, d):
    c = table(spark, d, "customer")
    return c.withColumn("c_mktsegment", F.expr("nullif(c_mktsegment, 'BUILDING')"))


def q_hash_concat(spark, d):
    c = _customer_with_nulls(spark, d)
    return hashing.hash_columns(c, "row_hash", 256, "c_custkey", "c_name", "c_mktsegment", "c_acctbal").select("c_custkey", "row_hash")


def q_hash_each(spark, d):
    c = _customer_with_nulls(spark, d)
    return hashing.hash_each(c, 0, "c_name", "c_mktsegment").select("c_custkey", "c_name_hash", "c_mktsegment_hash")


def q_hash_text(spark, d):
    return table(spark, d, "customer").select("c_custkey", hashing.sha256_text("c_name").alias("name_sha256"))


def q_hash_bucket(spark, d):
    c = _customer_with_nulls(spark, d)
    return c.select("c_custkey", hashing.hash_bucket("c_custkey", "c_mktsegment").alias("bucket"))


def q_hash_bits(spark, d):
    c = table(spark, d, "customer")
    return c.select(
        "c_custkey",
        *[hashing.sha2_of(["c_custkey", "c_name"], bits).alias(f"sha{bits}") for bits in (224, 256, 384, 512)],
    )


def q_hash_bits_default(spark, d):
    """Bit length 0 means 256: both columns must equal SHA-256."""
    c = table(spark, d, "customer")
    return c.select("c_custkey", *[hashing.sha2_of(["c_custkey", "c_name"], bits).alias(f"sha{bits}") for bits in (0, 256)])


def q_epoch_text(spark, d):
    e = table(spark, d, "events")
    return e.select("event_id", timefmt.epoch_millis_text(timefmt.epoch_millis("ts")).alias("ts_text"))


# ------------------------------------------------------------ key handling
def _ops_and_entities(spark, d):
    ops = table(spark, d, "orders").select(
        F.col("o_orderkey").cast("string").alias("op_id"),
        F.col("o_custkey").cast("string").alias("entity_id"),
        F.create_map(F.lit("priority"), F.col("o_orderpriority")).alias("details"),
    )
    ents = table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("id"), F.col("c_name").alias("name"))
    return ops, ents


def q_resolve_load(spark, d):
    ops, ents = _ops_and_entities(spark, d)
    r = md.resolve_rows(ops, ents)
    return r.select("id", "name", "op_id", "entity_id", F.col("op_details")["priority"].alias("priority"))


def q_theta_join(spark, d):
    j = keys.theta_join(table(spark, d, "customer"), table(spark, d, "nation"), ["c_nationkey >= n_nationkey"], nested_loop=True)
    return j.select("target.c_custkey", "updates.n_nationkey")


def q_equi_join_extra(spark, d):
    j = keys.theta_join(
        table(spark, d, "orders"),
        table(spark, d, "customer"),
        ["o_custkey = c_custkey"],
        "updates.c_acctbal > 0 AND target.o_orderpriority = '1-URGENT'",
    )
    return j.select("target.o_orderkey", "updates.c_custkey", "updates.c_acctbal")


def _merge_inputs(spark, d):
    """Target: customers outside AUTOMOBILE.  Updates: AUTOMOBILE (new keys)
    and BUILDING (existing keys) with the balance raised by one."""
    c = table(spark, d, "customer")
    target = c.filter(F.col("c_mktsegment") != "AUTOMOBILE")
    updates = c.filter(F.col("c_mktsegment").isin("AUTOMOBILE", "BUILDING")).withColumn("c_acctbal", F.col("c_acctbal") + 1)
    return target, updates


def _scd2_current(spark, d):
    target, _ = _merge_inputs(spark, d)
    return target.select(
        "c_custkey", "c_name", "c_acctbal", "c_mktsegment",
        F.lit(True).alias("is_current"),
        F.lit("2024-01-01").cast(DateType()).alias("valid_from"),
        F.lit(None).cast(DateType()).alias("valid_to"),
    )


def _scd2_updates(spark, d):
    _, updates = _merge_inputs(spark, d)
    return updates.select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")


def q_merge_key_rows(spark, d):
    current = _scd2_current(spark, d)
    updates = _scd2_updates(spark, d)
    changed = updates.alias("u").join(
        current.alias("c"),
        (F.col("u.c_custkey") == F.col("c.c_custkey")) & F.col("c.is_current") & (F.col("u.c_acctbal") != F.col("c.c_acctbal")),
        "left_semi",
    )
    return keys.merge_key_rows(updates, changed, ["c_custkey"])


def q_scd2_merge(spark, d):
    t = VersionedTable.create(spark, unique_table_name("scd2"), _scd2_current(spark, d), root=scratch_path(spark, "scd2"))
    t.scd2(_scd2_updates(spark, d), key="c_custkey", compare=["c_name", "c_acctbal", "c_mktsegment"],
           load_date=F.lit("2024-02-01").cast(DateType()))
    return t.read()


def q_prune_target(spark, d):
    o = table(spark, d, "orders")
    upd = o.filter((F.col("o_orderstatus") == "F") & F.col("o_orderpriority").isin("1-URGENT", "5-LOW"))
    return keys.prune_target(o, upd, ["o_orderstatus", "o_orderpriority"])


# ------------------------------------------------------------- table changes
def _customer_table(spark, d, label):
    target, updates = _merge_inputs(spark, d)
    t = VersionedTable.create(spark, unique_table_name(label), target, root=scratch_path(spark, label))
    return t, updates


def q_merge_upsert(spark, d):
    t, updates = _customer_table(spark, d, "merge_upsert")
    t.merge(updates, None, keys=["c_custkey"])  # match on the key; inserts against distinct target keys
    return t.read()


def q_merge_bucketed(spark, d):
    """Upsert into a target stored in buckets of the merge key: the joins read
    the target without shuffling it."""
    target, updates = _merge_inputs(spark, d)
    t = VersionedTable.create(spark, unique_table_name("merge_bucketed"), target, root=scratch_path(spark, "merge_bucketed"),
                              bucket_by=(8, ["c_custkey"]))
    t.merge(updates, None, keys=["c_custkey"])
    return t.read()


def q_merge_delete(spark, d):
    t, updates = _customer_table(spark, d, "merge_delete")
    t.merge(updates, "target.c_custkey = updates.c_custkey", delete_when="updates.c_acctbal < 0", keys=["c_custkey"])
    return t.read()


def q_merge_exprs(spark, d):
    t, updates = _customer_table(spark, d, "merge_exprs")
    t.merge(
        updates,
        "target.c_custkey = updates.c_custkey",
        update_set={"c_acctbal": "target.c_acctbal + updates.c_acctbal", "c_name": "concat(updates.c_name, '*')"},
        insert_values={"c_custkey": "updates.c_custkey", "c_name": "updates.c_name", "c_acctbal": "updates.c_acctbal"},
        keys=["c_custkey"],
    )
    return t.read()


def _orders_partition_updates(spark, d):
    """Urgent 'P' orders re-priced, plus low-priority 'P' orders under new
    (negative) keys, which are inserts."""
    o = table(spark, d, "orders")
    repriced = o.filter("o_orderstatus = 'P' AND o_orderpriority = '1-URGENT'").withColumn("o_totalprice", F.col("o_totalprice") + 1)
    new = o.filter("o_orderstatus = 'P' AND o_orderpriority = '5-LOW'").withColumn("o_orderkey", -F.col("o_orderkey") - 1)
    return repriced.unionByName(new)


def q_merge_partitions(spark, d):
    t = _orders_table(spark, d, "merge_parts", ["o_orderstatus"])
    # keys never change status here, so the aligned form reads only the partitions in the updates
    t.merge(_orders_partition_updates(spark, d), "target.o_orderkey = updates.o_orderkey", scope="partitions", aligned=True,
            keys=["o_orderkey"])
    return t.read()


def q_merge_delete_partitions(spark, d):
    """All 'P' orders matched and deleted (the partition empties), urgent 'F'
    orders re-priced, low-priority 'O' orders inserted under new keys."""
    o = table(spark, d, "orders")
    upd = (
        o.filter("o_orderstatus = 'P'")
        .unionByName(o.filter("o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'").withColumn("o_totalprice", F.col("o_totalprice") + 1))
        .unionByName(o.filter("o_orderstatus = 'O' AND o_orderpriority = '5-LOW'").withColumn("o_orderkey", -F.col("o_orderkey") - 1))
    )
    t = _orders_table(spark, d, "merge_delete_parts", ["o_orderstatus"])
    t.merge(upd, "target.o_orderkey = updates.o_orderkey", delete_when="updates.o_orderstatus = 'P'", scope="partitions", keys=["o_orderkey"])
    return t.read()


def q_update_partitions(spark, d):
    t = _orders_table(spark, d, "update_parts", ["o_orderstatus"])
    t.update("o_orderstatus = 'F' AND o_orderpriority = '2-HIGH'", {"o_totalprice": "o_totalprice - 1"}, scope="partitions")
    return t.read()


def _orders_null_priority(spark, d):
    return table(spark, d, "orders").withColumn("o_orderpriority", F.expr("nullif(o_orderpriority, '3-MEDIUM')"))


def q_update_where(spark, d):
    t = VersionedTable.create(spark, unique_table_name("update"), _orders_null_priority(spark, d), root=scratch_path(spark, "update"))
    t.update("o_orderpriority IN ('1-URGENT', '2-HIGH')",
             {"o_orderpriority": "'0-TOP'", "o_orderstatus": "o_orderpriority", "o_totalprice": "o_totalprice * 2"})
    return t.read()


def q_delete_where(spark, d):
    t = VersionedTable.create(spark, unique_table_name("delete"), _orders_null_priority(spark, d), root=scratch_path(spark, "delete"))
    t.delete("o_orderpriority = '5-LOW'")
    return t.read()


# -------------------------------------------------------------------- sinks
def _orders_table(spark, d, label, partition_by=(), where=None):
    o = table(spark, d, "orders")
    first = o.filter(where) if where is not None else o
    return VersionedTable.create(spark, unique_table_name(label), first, root=scratch_path(spark, label), partition_by=partition_by)


def q_write_append(spark, d):
    t = _orders_table(spark, d, "append", where="o_orderstatus = 'F'")
    t.append(table(spark, d, "orders").filter("o_orderstatus <> 'F'"))
    return t.read()


def q_write_append_part(spark, d):
    t = _orders_table(spark, d, "append_part", ["o_orderstatus"], where="o_orderstatus = 'F'")
    t.append(table(spark, d, "orders").filter("o_orderstatus <> 'F'"))
    return t.read()


def q_write_create(spark, d):
    name = unique_table_name("create")
    o = table(spark, d, "orders")
    VersionedTable.create(spark, name, o, root=scratch_path(spark, "create"), partition_by=["o_orderstatus"])
    t = VersionedTable.create(spark, name, o.limit(0), partition_by=["o_orderstatus"], if_exists="ignore")
    return t.read()


def q_write_overwrite(spark, d):
    t = _orders_table(spark, d, "overwrite")
    t.overwrite(table(spark, d, "orders").filter("o_orderpriority = '1-URGENT'"))
    return t.read()


def q_write_replace_where(spark, d):
    t = _orders_table(spark, d, "replace_where", ["o_orderstatus"])
    new = table(spark, d, "orders").filter("o_orderpriority = '1-URGENT'").withColumn("o_totalprice", F.col("o_totalprice") * 2)
    t.replace_where(new, "o_orderpriority = '1-URGENT'")
    return t.read()


def q_replace_where_partitions(spark, d):
    """Reload statuses F and P with only the re-priced urgent P orders: P is
    rewritten in place, F is emptied, O is not touched."""
    t = _orders_table(spark, d, "replace_parts", ["o_orderstatus"])
    new = table(spark, d, "orders").filter("o_orderstatus = 'P' AND o_orderpriority = '1-URGENT'")
    t.replace_where(new.withColumn("o_totalprice", F.col("o_totalprice") * 2), "o_orderstatus IN ('F', 'P')", scope="partitions")
    return t.read()


def q_delete_partitions(spark, d):
    t = _orders_table(spark, d, "delete_parts", ["o_orderstatus"])
    t.delete("o_orderstatus = 'F' OR (o_orderstatus = 'O' AND o_orderpriority = '5-LOW')", scope="partitions")
    return t.read()


def q_write_static_partition(spark, d):
    t = _orders_table(spark, d, "static_part", ["o_orderstatus"])
    new = table(spark, d, "orders").filter("o_orderstatus = 'O' AND o_orderpriority = '1-URGENT'")
    t.write_static_partition(new, {"o_orderstatus": "P"})
    return t.read()


def q_write_dynamic_partition(spark, d):
    t = _orders_table(spark, d, "dynamic_part", ["o_orderstatus"])
    new = table(spark, d, "orders").filter("o_orderstatus = 'P' AND o_orderpriority = '1-URGENT'")
    t.overwrite_partitions(new.withColumn("o_totalprice", F.col("o_totalprice") + 0.5))
    return t.read()


def _events_by_day(spark, d):
    return table(spark, d, "events").withColumn("event_day", F.to_date("ts"))


def q_delete_then_write(spark, d):
    label = "delete_then_write"
    t = VersionedTable.create(spark, unique_table_name(label), _events_by_day(spark, d), root=scratch_path(spark, label), partition_by=["event_day"])
    reload = _events_by_day(spark, d).filter("event_type = 'purchase' AND event_day BETWEEN DATE '2024-01-05' AND DATE '2024-01-07'")
    t.delete_then_write(reload.withColumn("value", F.col("value") * 2), ["event_day"])
    return t.read()


def q_delete_then_write_rows(spark, d):
    label = "delete_then_write_rows"
    t = VersionedTable.create(spark, unique_table_name(label), table(spark, d, "events"), root=scratch_path(spark, label))
    reload = table(spark, d, "events").filter("event_type = 'purchase'").withColumn("value", F.col("value") * 2)
    t.delete_then_write(reload, ["user_id"])
    return t.read()


def q_delete_then_write_scoped(spark, d):
    """Reload all purchases by user into events partitioned by day, rewriting
    only the day partitions that hold a replaced or a new row."""
    label = "delete_then_write_scoped"
    t = VersionedTable.create(spark, unique_table_name(label), _events_by_day(spark, d), root=scratch_path(spark, label), partition_by=["event_day"])
    reload = _events_by_day(spark, d).filter("event_type = 'purchase'").withColumn("value", F.col("value") * 2)
    t.delete_then_write(reload, ["user_id"], scope="partitions")
    return t.read()


def q_time_travel(spark, d):
    t = _orders_table(spark, d, "time_travel")
    t.update("o_orderpriority = '1-URGENT'", {"o_totalprice": "o_totalprice + 1"})
    return t.read(0).withColumn("version", F.lit(0)).unionByName(t.read(1).withColumn("version", F.lit(1)))


def q_create_like(spark, d):
    part = table(spark, d, "part")
    t = create_like(spark, unique_table_name("create_like"), part, cluster_first=["p_type", "P_BRAND"],
                    partition_by=["p_size"], root=scratch_path(spark, "create_like"))
    t.append(part)
    return t.read()


# ------------------------------------------------------ aggregation, run logs
def q_distinct_partitions(spark, d):
    return runlog.distinct_partitions(table(spark, d, "orders"), ["o_orderstatus", "o_orderpriority"])


def q_write_stats(spark, d):
    db = unique_table_name("meta")
    md.create_metadata_tables(spark, db, scratch_path(spark, "meta"))
    t = VersionedTable.create(spark, unique_table_name("stats"), table(spark, d, "lineitem"), root=scratch_path(spark, "stats"))
    md.store_stats(spark, db, "run-1", t.last_metrics)
    return spark.table(f"`{db}`.`{md.STATS}`").select("stat_id", "stat_name", "stat_value")


def q_latest_status(spark, d):
    log = table(spark, d, "events").select("user_id", F.col("event_type").alias("status"), "ts", "event_id")
    return runlog.latest_per_key(log, ["user_id"], ["ts", "event_id"])


# ---------------------------------------------------------------- load jobs
def _metadata(spark, source_mount: str):
    db = unique_table_name("meta")
    base = scratch_path(spark, "meta")
    md.create_metadata_tables(spark, db, base)
    target_db = unique_table_name("dw")
    md.add_mount(spark, db, target_db, source_mount, scratch_path(spark, "target"))
    return db, target_db


def q_metadata_tables(spark, d):
    db, target_db = _metadata(spark, d)
    md.add_entity(spark, db, "e1", target_db, "orders_copy", {"format": "parquet", "partition_column": "o_orderstatus"})
    md.log_operation(spark, db, "op-1", "e1", None, {"path": "/orders.parquet"})
    jobs.load_from_metadata(spark, db, "op-1", conform=False)
    stats = spark.table(f"`{db}`.`{md.STATS}`").filter("stat_name = 'num_output_rows'").select("stat_id", "stat_value")
    current = md.operations_current(spark, db).select("op_id", "entity_id", "status")
    entity = md.entities_current(spark, db).select(F.col("id").alias("entity_key"), F.col("latest_status").alias("entity_status"))
    return (
        current.join(stats, current["op_id"] == stats["stat_id"])
        .join(entity, current["entity_id"] == entity["entity_key"])
        .select("op_id", "status", F.col("stat_value").alias("num_output_rows"), "entity_status")
    )


def q_load_job(spark, d):
    src = scratch_path(spark, "src")
    table(spark, d, "orders").write.option("delimiter", ";").csv(f"{src}/orders_csv")
    db, target_db = _metadata(spark, src)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{target_db}` LOCATION '{scratch_path(spark, 'dw')}'")
    target = spark.createDataFrame(
        [], "o_orderkey bigint, o_custkey bigint, o_totalprice double, o_orderdate timestamp_ntz, "
            "o_orderpriority string, load_src string, o_orderstatus string")
    VersionedTable.create(spark, f"{target_db}.orders_fact", target, root=scratch_path(spark, "orders_fact"), partition_by=["o_orderstatus"])
    md.add_entity(spark, db, "e1", target_db, "orders_fact", {
        "format": "csv", "delimiter": ";", "partition_column": "O_ORDERSTATUS",
        "headerCols": "o_orderkey|o_custkey|o_orderstatus|o_totalprice|o_orderdate|o_orderpriority",
        "add_columns": "load_src='csv'",
    })
    md.log_operation(spark, db, "op-1", "e1", None, {"path": "/orders_csv"})
    jobs.load_from_metadata(spark, db, "op-1")
    return spark.table(f"`{target_db}`.orders_fact")


def q_load_job_raw(spark, d):
    db, target_db = _metadata(spark, d)
    md.add_entity(spark, db, "e1", target_db, "orders_raw", {"format": "parquet", "partition_column": "o_orderstatus"})
    md.log_operation(spark, db, "op-1", "e1", None, {"path": "/orders.parquet"})
    jobs.load_from_metadata(spark, db, "op-1", conform=False)
    return spark.table(f"`{target_db}`.orders_raw")


def q_transform_chain(spark, d):
    spec = jobs.LoadSpec(
        source_format="parquet",
        source_path=f"{d}/customer.parquet",
        target_table=unique_table_name("chain"),
        target_root=scratch_path(spark, "chain"),
        steps=[
            lambda df: columns.select_by_position(df, "cust_id,segment,balance", "1,5,4"),
            lambda df: hashing.hash_columns(df, "key_hash", 256, "cust_id", "segment"),
        ],
        partition_by=["segment"],
    )
    jobs.run_spec(spark, spec)
    return spark.table(spec.target_table)


QUERIES: dict[str, Query] = {
    "scan_parquet": q_scan_parquet,
    "scan_json": q_scan_json,
    "scan_orc": q_scan_orc,
    "scan_csv_schema": q_scan_csv_schema,
    "scan_csv_plain": q_scan_csv_plain,
    "csv_header_types": q_csv_header_types,
    "column_selector": q_column_selector,
    "sync_add": q_sync_add,
    "sync_rename": q_sync_rename,
    "sync_drop": q_sync_drop,
    "sync_conform": q_sync_conform,
    "year_sanity": q_year_sanity,
    "select_matching": q_select_matching,
    "hash_concat": q_hash_concat,
    "hash_each": q_hash_each,
    "hash_text": q_hash_text,
    "hash_bucket": q_hash_bucket,
    "hash_bits": q_hash_bits,
    "hash_bits_default": q_hash_bits_default,
    "epoch_text": q_epoch_text,
    "resolve_load": q_resolve_load,
    "theta_join": q_theta_join,
    "equi_join_extra": q_equi_join_extra,
    "merge_key_rows": q_merge_key_rows,
    "scd2_merge": q_scd2_merge,
    "prune_target": q_prune_target,
    "merge_upsert": q_merge_upsert,
    "merge_bucketed": q_merge_bucketed,
    "merge_delete": q_merge_delete,
    "merge_exprs": q_merge_exprs,
    "merge_partitions": q_merge_partitions,
    "merge_delete_partitions": q_merge_delete_partitions,
    "update_where": q_update_where,
    "update_partitions": q_update_partitions,
    "delete_where": q_delete_where,
    "write_append": q_write_append,
    "write_append_part": q_write_append_part,
    "write_create": q_write_create,
    "write_overwrite": q_write_overwrite,
    "write_replace_where": q_write_replace_where,
    "replace_where_partitions": q_replace_where_partitions,
    "delete_partitions": q_delete_partitions,
    "write_static_partition": q_write_static_partition,
    "write_dynamic_partition": q_write_dynamic_partition,
    "delete_then_write": q_delete_then_write,
    "delete_then_write_rows": q_delete_then_write_rows,
    "delete_then_write_scoped": q_delete_then_write_scoped,
    "time_travel": q_time_travel,
    "create_like": q_create_like,
    "distinct_partitions": q_distinct_partitions,
    "write_stats": q_write_stats,
    "latest_status": q_latest_status,
    "metadata_tables": q_metadata_tables,
    "load_job": q_load_job,
    "load_job_raw": q_load_job_raw,
    "transform_chain": q_transform_chain,
}


# ---------------------------------------------------------------- streaming
def q_stream_upsert(spark, d):
    """Two drops land in a folder; each run of the stream merges the new files."""
    from tablewright.streaming import run_available

    events = table(spark, d, "events")
    landing = scratch_path(spark, "landing")
    name = unique_table_name("stream")
    t = VersionedTable.create(spark, name, events.limit(0), root=scratch_path(spark, "stream_table"))
    stream_name = f"s_{name}"
    checkpoint = scratch_path(spark, "stream_ckpt")

    def run():
        src = spark.readStream.schema(events.schema).parquet(landing)
        run_available(src, name, stream_name, mode="merge", merge_condition="target.event_id = updates.event_id",
                      merge_keys=["event_id"], checkpoint=checkpoint)

    events.write.mode("append").parquet(landing)
    run()
    corrections = events.filter("event_type = 'purchase'").withColumn("value", F.col("value") * 2)
    corrections.write.mode("append").parquet(landing)
    run()
    return t.read()


QUERIES["stream_upsert"] = q_stream_upsert


def q_stream_upsert_partitions(spark, d):
    """The same stream into a table partitioned by event type, matched on the key
    alone: each batch rewrites only the partitions it reaches."""
    from tablewright.streaming import run_available

    events = table(spark, d, "events")
    landing = scratch_path(spark, "landing")
    name = unique_table_name("stream_parts")
    t = VersionedTable.create(spark, name, events.limit(0), root=scratch_path(spark, "stream_parts"), partition_by=["event_type"])
    checkpoint = scratch_path(spark, "stream_ckpt")

    def run():
        src = spark.readStream.schema(events.schema).parquet(landing)
        run_available(src, name, f"s_{name}", mode="merge", merge_keys=["event_id"], checkpoint=checkpoint)

    events.write.mode("append").parquet(landing)
    run()
    # corrected purchases become refunds, so their rows move to another partition
    corrections = events.filter("event_type = 'purchase'").withColumn("event_type", F.lit("refund"))
    corrections.write.mode("append").parquet(landing)
    run()
    return t.read().select(*events.columns)


QUERIES["stream_upsert_partitions"] = q_stream_upsert_partitions


# ------------------------------------------------- more table and load changes
def q_delete_partitions_timestamp(spark, d):
    """Partitions by hour (a timestamp): whole hours go, others lose their errors."""
    events = table(spark, d, "events").withColumn("event_hour", F.date_trunc("hour", "ts"))
    t = VersionedTable.create(spark, unique_table_name("by_hour"), events, root=scratch_path(spark, "by_hour"),
                              partition_by=["event_hour"])
    t.delete("hour(event_hour) = 3 OR (event_type = 'error' AND hour(event_hour) = 5)", scope="partitions")
    return t.read().select(*events.columns)


def q_merge_extra_condition(spark, d):
    """Two updates for each key, of which the condition lets one match: no conflict."""
    target, updates = _merge_inputs(spark, d)
    t = VersionedTable.create(spark, unique_table_name("merge_extra"), target, root=scratch_path(spark, "merge_extra"))
    both = updates.withColumn("live", F.lit(True)).unionByName(
        updates.withColumn("live", F.lit(False)).withColumn("c_acctbal", F.lit(0.0)))
    t.merge(both, "target.c_custkey = updates.c_custkey AND updates.live", keys=["c_custkey"], insert=False)
    return t.read()


def q_scd2_partitions(spark, d):
    """SCD2 in place on a table partitioned by segment."""
    current = _scd2_current(spark, d)
    t = VersionedTable.create(spark, unique_table_name("scd2_parts"), current, root=scratch_path(spark, "scd2_parts"),
                              partition_by=["c_mktsegment"])
    t.scd2(_scd2_updates(spark, d), key="c_custkey", compare=["c_name", "c_acctbal", "c_mktsegment"],
           load_date=F.lit("2024-02-01").cast(DateType()), scope="partitions")
    return t.read().select(*current.columns)


def q_merge_stats(spark, d):
    """Rows inserted, updated and deleted by the same merge in either scope."""
    target, updates = _merge_inputs(spark, d)
    rows = []
    for scope in ("table", "partitions"):
        t = VersionedTable.create(spark, unique_table_name("merge_stats"), target, root=scratch_path(spark, "merge_stats"),
                                  partition_by=["c_mktsegment"])
        done = t.merge(updates, None, keys=["c_custkey"], delete_when="updates.c_acctbal < 0", scope=scope)
        wanted = {k: v for k, v in done.metrics.items() if k != "num_output_rows"}
        rows.append(runlog.stats_rows(spark, scope, wanted).drop("updated_at"))
    return rows[0].unionByName(rows[1])


def q_load_job_replace_where(spark, d):
    """A metadata load with replaceWhere on an unpartitioned target replaces those rows only."""
    src = scratch_path(spark, "src")
    nation = table(spark, d, "nation")
    nation.write.parquet(f"{src}/all")
    nation.filter("n_regionkey = 1").withColumn("n_name", F.lower("n_name")).write.parquet(f"{src}/one")
    db, target_db = _metadata(spark, src)
    md.add_entity(spark, db, "e1", target_db, "nation_reload", {"format": "parquet"})
    md.log_operation(spark, db, "op-1", "e1", None, {"path": "/all"})
    jobs.load_from_metadata(spark, db, "op-1", conform=False)
    md.log_operation(spark, db, "op-2", "e1", None, {"path": "/one", "replaceWhere": "n_regionkey = 1"})
    jobs.load_from_metadata(spark, db, "op-2", conform=False)
    return spark.table(f"`{target_db}`.nation_reload")


QUERIES |= {
    "delete_partitions_timestamp": q_delete_partitions_timestamp,
    "merge_extra_condition": q_merge_extra_condition,
    "scd2_partitions": q_scd2_partitions,
    "merge_stats": q_merge_stats,
    "load_job_replace_where": q_load_job_replace_where,
}
