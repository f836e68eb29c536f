"""Registered queries of nested conforming, history stitching, range joins, rejects and one-pass JSON,
each with its DuckDB SQL beside it."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablewright.operators import colstats, columns, history, keyfilter, ranges, rejects
from tablewright.operators.logsnap import LatestLog
from tablewright.session import scratch_path, unique_table_name
from tablewright.sinks.versioned import VersionedTable
from tablewright.sources.json_once import CORRUPT, UNKNOWN, read_json_once


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ------------------------------------------------------------------ nested types
NESTED_TARGET = (
    "event_id bigint, payload struct<detail: struct<extra: string, k: int>, KIND: string>, "
    "parts array<struct<who: string, amount: double>>, by_type map<string, struct<at: timestamp_ntz, value: float>>"
)


def q_sync_nested(spark, d):
    """Events as nested rows whose fields stand in another order, with missing and further ones, conformed by name."""
    e = table(spark, d, "events")
    nested = e.select(
        F.col("event_id").cast("string").alias("EVENT_ID"),
        F.struct(F.col("event_type").alias("kind"), F.col("ts").alias("unused"), F.from_json("props", "k string").alias("detail")).alias("payload"),
        F.array(F.struct(F.col("value").cast("string").alias("amount"), F.col("user_id").alias("WHO"))).alias("parts"),
        F.create_map("event_type", F.struct("value", F.col("ts").alias("at"))).alias("by_type"))
    out = columns.sync_with_table(nested, spark.createDataFrame([], NESTED_TARGET).schema).processed
    first = F.col("parts")[0]
    of_type = F.map_values("by_type")[0]
    return out.select("event_id", F.col("payload.detail.extra").alias("extra"), F.col("payload.detail.k").alias("k"), F.col("payload.KIND").alias("kind"),
                      first["who"].alias("who"), first["amount"].alias("amount"), of_type["at"].alias("at"), of_type["value"].cast("double").alias("value"))


SYNC_NESTED = (
    "SELECT event_id, CAST(NULL AS VARCHAR) AS extra, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, event_type AS kind, "
    "CAST(user_id AS VARCHAR) AS who, value AS amount, ts AS at, CAST(CAST(value AS FLOAT) AS DOUBLE) AS value FROM events"
)


# ------------------------------------------------------------------ history
_EARLY = "o_orderpriority <> '1-URGENT' AND o_orderstatus <> 'P'"
_GONE = "o_orderstatus = 'P' AND o_orderpriority = '5-LOW'"
_COMPARE = ["o_orderstatus", "o_orderpriority"]


def _order_history(spark, d):
    """History of each customer's last order state, from part of the orders; the others are its changes, many per key and many late."""
    o = table(spark, d, "orders").drop("o_totalprice")
    shape = o.select("o_custkey", *_COMPARE, F.lit(True).alias("is_current"), F.col("o_orderdate").alias("valid_from"),
                     F.lit(None).cast(o.schema["o_orderdate"].dataType).alias("valid_to"))
    early = history.stitch_history(shape.limit(0), o.where(_EARLY), ["o_custkey"], _COMPARE, effective="o_orderdate", sequence="o_orderkey")
    return early, o.where(f"NOT ({_EARLY})")


def q_scd2_changes_per_key(spark, d):
    early, changes = _order_history(spark, d)
    t = VersionedTable.create(spark, unique_table_name("scd2_stitched"), early, root=scratch_path(spark, "scd2_stitched"))
    t.overwrite(history.stitch_history(t.read(), changes, ["o_custkey"], _COMPARE, effective="o_orderdate", sequence="o_orderkey", delete_when=_GONE))
    return t.read()


def q_scd4_apply(spark, d):
    """A change set applied twice to a current and a history table."""
    early, changes = _order_history(spark, d)
    path = scratch_path(spark, "change_set")
    changes.write.parquet(path)
    stored = spark.read.parquet(path)
    made = VersionedTable.create(spark, unique_table_name("scd4_all"), early, root=scratch_path(spark, "scd4_all")).read()
    now = VersionedTable.create(spark, unique_table_name("scd4_current"), made.where("is_current").drop("is_current", "valid_to"),
                                root=scratch_path(spark, "scd4_current"))
    past = VersionedTable.create(spark, unique_table_name("scd4_history"), made.where("NOT is_current").drop("is_current"),
                                 root=scratch_path(spark, "scd4_history"))
    for _ in range(2):
        done = history.apply_change_set(now.read(), past.read(), stored, ["o_custkey"], _COMPARE, effective="o_orderdate",
                                        sequence="o_orderkey", delete_when=_GONE)
        before = past.version  # both results read the versions before
        past.overwrite(done.history)
        done = history.apply_change_set(now.read(), past.read(version=before), stored, ["o_custkey"], _COMPARE, effective="o_orderdate",
                                        sequence="o_orderkey", delete_when=_GONE)
        now.overwrite(done.current)
    return now.read().select(F.lit("current").alias("part"), "*", F.lit(None).cast(past.read().schema["valid_to"].dataType).alias("valid_to")).unionByName(
        past.read().select(F.lit("history").alias("part"), "*"))


_STITCH = (
    "WITH a AS (SELECT o_custkey AS k, o_orderdate AS moment, arg_max(o_orderstatus, o_orderkey) AS s, arg_max(o_orderpriority, o_orderkey) AS p "
    f"FROM orders WHERE {_EARLY} GROUP BY ALL), "
    "h1 AS (SELECT *, lag(s) OVER w AS ps, lag(p) OVER w AS pp, row_number() OVER w AS rn FROM a WINDOW w AS (PARTITION BY k ORDER BY moment)), "
    "h AS (SELECT k, moment, s, p FROM h1 WHERE rn = 1 OR s IS DISTINCT FROM ps OR p IS DISTINCT FROM pp), "
    f"c AS (SELECT o_custkey AS k, o_orderdate AS moment, arg_max(o_orderstatus, o_orderkey) AS s, arg_max(o_orderpriority, o_orderkey) AS p, "
    f"arg_max({_GONE}, o_orderkey) AS gone FROM orders WHERE NOT ({_EARLY}) GROUP BY ALL), "
    "e AS (SELECT *, false AS gone FROM h WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.k = h.k AND c.moment = h.moment) UNION ALL SELECT * FROM c), "
    "e1 AS (SELECT *, lag(s) OVER w AS ps, lag(p) OVER w AS pp, lag(gone) OVER w AS pg, row_number() OVER w AS rn FROM e "
    "WINDOW w AS (PARTITION BY k ORDER BY moment)), "
    "e2 AS (SELECT * FROM e1 WHERE CASE WHEN rn = 1 THEN NOT gone ELSE NOT (pg = gone AND (gone OR (s = ps AND p = pp))) END), "
    "v AS (SELECT *, lead(moment) OVER (PARTITION BY k ORDER BY moment) AS ends FROM e2) "
)
SCD2_CHANGES_PER_KEY = _STITCH + (
    "SELECT k AS o_custkey, s AS o_orderstatus, p AS o_orderpriority, ends IS NULL AS is_current, moment AS valid_from, ends AS valid_to FROM v WHERE NOT gone"
)
SCD4_APPLY = _STITCH + (
    "SELECT CASE WHEN ends IS NULL THEN 'current' ELSE 'history' END AS part, k AS o_custkey, s AS o_orderstatus, p AS o_orderpriority, "
    "moment AS valid_from, ends AS valid_to FROM v WHERE NOT gone"
)


# ------------------------------------------------------------------ range join
def q_range_join(spark, d):
    """Events that fall into an order's handling time (its date moved to the events' years, longer for dearer orders)."""
    o = table(spark, d, "orders")
    spans = o.select("o_orderkey", F.expr("o_orderdate + INTERVAL '28' YEAR").alias("opened"), F.expr(
        "o_orderdate + INTERVAL '28' YEAR + make_dt_interval(0, 0, cast(floor(o_totalprice / 1000) AS int))").alias("closed"))
    events = table(spark, d, "events").select("event_id", "event_type", "ts")
    hits = ranges.point_in_interval_join(events, spans, "ts", "opened", "closed")
    return hits.select("i.o_orderkey", "p.event_id", "p.event_type")


RANGE_JOIN = (
    "WITH s AS (SELECT o_orderkey, o_orderdate + INTERVAL 28 YEAR AS opened, "
    "o_orderdate + INTERVAL 28 YEAR + to_minutes(CAST(floor(o_totalprice / 1000) AS BIGINT)) AS closed FROM orders) "
    "SELECT o_orderkey, event_id, event_type FROM events JOIN s ON ts >= opened AND ts <= closed"
)


# ------------------------------------------------------------------ rejects
def q_load_with_rejects(spark, d):
    """A CSV load with malformed balances, missing nations and lines of too many fields; accepted and rejected rows."""
    c = table(spark, d, "customer")
    bad = (F.col("c_mktsegment") == "MACHINERY") & (F.col("c_nationkey") < 5)
    name = F.when(F.col("c_nationkey") == 3, F.concat("c_name", F.lit(";x"))).otherwise(F.col("c_name"))
    line = F.concat_ws(";", "c_custkey", name, F.when(F.col("c_nationkey") == 7, F.lit("")).otherwise(F.col("c_nationkey").cast("string")),
                       F.when(bad, F.lit("n/a")).otherwise(F.col("c_acctbal").cast("string")), "c_mktsegment")
    path = scratch_path(spark, "csv_rejects")
    c.select(line).write.text(path)
    done = rejects.load_csv_with_rejects(spark, path, c.schema, options={"sep": ";"}, required=["c_nationkey"])
    why = F.array_join(F.transform(rejects.REASONS, lambda r: F.concat_ws(":", r["column"], r["reason"])), ",")
    return done.accepted.select("c_custkey", "c_name", "c_acctbal", F.lit("").alias("reasons"), F.lit(None).cast("string").alias("reject_row")).unionByName(
        done.rejected.select(F.lit(None).cast("bigint").alias("c_custkey"), F.lit(None).cast("string").alias("c_name"),
                             F.lit(None).cast("double").alias("c_acctbal"), why.alias("reasons"), rejects.ROW))


LOAD_WITH_REJECTS = (
    "WITH x AS (SELECT *, c_mktsegment = 'MACHINERY' AND c_nationkey < 5 AS bad, CASE WHEN c_mktsegment = 'MACHINERY' AND c_nationkey < 5 THEN 'n/a' "
    "ELSE CAST(c_acctbal AS VARCHAR) END AS bal FROM customer) "
    "SELECT c_custkey, c_name, c_acctbal, '' AS reasons, NULL AS reject_row FROM x WHERE NOT bad AND c_nationkey NOT IN (3, 7) "
    "UNION ALL SELECT NULL, NULL, NULL, 'unreadable', concat_ws(';', c_custkey, c_name || ';x', c_nationkey, bal, c_mktsegment) FROM x WHERE c_nationkey = 3 "
    "UNION ALL SELECT NULL, NULL, NULL, CASE WHEN c_nationkey = 7 THEN 'c_nationkey:null' ELSE 'c_acctbal:cast' END, "
    "'{\"c_custkey\":\"' || c_custkey || '\",\"c_name\":\"' || c_name || '\",\"c_nationkey\":' || "
    "CASE WHEN c_nationkey = 7 THEN 'null' ELSE '\"' || c_nationkey || '\"' END || ',\"c_acctbal\":\"' || bal || '\",\"c_mktsegment\":\"' || c_mktsegment || '\"}' "
    "FROM x WHERE c_nationkey = 7 OR (bad AND c_nationkey <> 3)"
)


# ------------------------------------------------------------------ JSON in one pass
def q_load_json_once(spark, d):
    """Events as JSON lines with a field that the target lacks and lines that are no JSON."""
    e = table(spark, d, "events")
    text = F.to_json(F.struct("event_id", "user_id", "event_type", "value", "ts", F.col("props").alias("more")),
                     {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"})
    path = scratch_path(spark, "json_once")
    e.select(F.when((F.col("event_type") == "signup") & (F.col("value") < 5), F.concat(F.lit("#"), text)).otherwise(text)).write.text(path)
    target = spark.createDataFrame([], "value double, event_id bigint, user_id int, ts timestamp_ntz, event_type string, absent date").schema
    out = read_json_once(spark, path, target)
    return out.select("event_id", "user_id", "event_type", "value", "ts", F.col(UNKNOWN)["more"].alias("more"), F.size(UNKNOWN).alias("n_unknown"),
                      F.regexp_extract(CORRUPT, '^#\\{"event_id":([0-9]+)', 1).cast("bigint").alias("corrupt_id"))


LOAD_JSON_ONCE = (
    "SELECT event_id, CAST(user_id AS INTEGER) AS user_id, event_type, value, ts, props AS more, 1 AS n_unknown, NULL::BIGINT AS corrupt_id "
    "FROM events WHERE NOT (event_type = 'signup' AND value < 5) "
    "UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, NULL, NULL, event_id FROM events WHERE event_type = 'signup' AND value < 5"
)

# ------------------------------------------------------------------ key filter
def q_prune_by_key_filter(spark, d):
    """Upsert of orders: only rows that the updates' key filter lets through are joined."""
    o = table(spark, d, "orders")
    urgent = o.where("o_orderpriority = '1-URGENT' AND o_orderstatus = 'F'").withColumn("o_totalprice", F.col("o_totalprice") + 1)
    fresh = urgent.withColumn("o_orderkey", -1 - F.col("o_orderkey"))
    t = VersionedTable.create(spark, unique_table_name("key_filter"), o, root=scratch_path(spark, "key_filter"))
    t.overwrite(keyfilter.merge_with_key_filter(t.read(), urgent.unionByName(fresh), ["o_orderkey"], delete_when="updates.o_totalprice < 50000"))
    return t.read()


PRUNE_BY_KEY_FILTER = (
    "WITH u AS (SELECT * REPLACE (o_totalprice + 1 AS o_totalprice) FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'F') "
    "SELECT * FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM u) UNION ALL SELECT * FROM u WHERE o_totalprice >= 50000 "
    "UNION ALL SELECT * REPLACE (-1 - o_orderkey AS o_orderkey) FROM u"
)


# ------------------------------------------------------------------ column statistics
def q_column_stats(spark, d):
    """Statistics of a table written in three loads, gathered by the writes and merged; distinct counts held to an exact recount."""
    li = table(spark, d, "lineitem").withColumn("l_linestatus", F.expr("nullif(l_linestatus, 'F')"))
    t, stats = None, None
    for flag in ("A", "N", "R"):
        def write(part):
            nonlocal t
            if t is None:
                t = VersionedTable.create(spark, unique_table_name("column_stats"), part, root=scratch_path(spark, "column_stats"))
            else:
                t.append(part)
        one = colstats.write_with_stats(li.where(F.col("l_returnflag") == flag), write, f"load-{flag}")
        stats = one if stats is None else stats.unionByName(one)
    path = scratch_path(spark, "column_stats_rows")
    stats.write.parquet(path)
    merged = colstats.merge_stats(spark.read.parquet(path), li.schema)
    exact = t.read().agg(*[(F.count_distinct(F.col(c)) + F.max(F.col(c).isNull().cast("int"))).alias(c) for c in li.columns])
    recount = exact.unpivot([], li.columns, "column_name", "exact")
    near = F.abs(F.col("n_distinct") - F.col("exact")) <= F.greatest(F.lit(1.0), 0.08 * F.col("exact"))  # five standard errors
    return merged.join(recount, "column_name").select("column_name", "n_rows", "n_nulls", "min_value", "max_value", near.alias("distinct_near"))


_LINEITEM = ("l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax l_returnflag l_linestatus l_shipdate").split()
COLUMN_STATS = "WITH l AS (SELECT * REPLACE (nullif(l_linestatus, 'F') AS l_linestatus) FROM lineitem) " + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) AS n_rows, count(*) - count({c}) AS n_nulls, CAST(min({c}) AS VARCHAR) AS min_value, "
    f"CAST(max({c}) AS VARCHAR) AS max_value, true AS distinct_near FROM l" for c in _LINEITEM)


def q_latest_from_snapshot(spark, d):
    """Newest event of each user while the log grows: a snapshot after each of two drops, and the drops after it."""
    events = spark.read.parquet(f"{d}/events.parquet").select("user_id", F.col("event_type").alias("status"), "ts", "event_id")
    log = LatestLog(spark, scratch_path(spark, "log"), scratch_path(spark, "log-snapshots"), events.schema, ["user_id"], ["ts", "event_id"])
    drop = F.pmod(F.xxhash64("event_id"), F.lit(3))  # rows of any time in any drop, so late ones too
    for i in range(3):
        events.where(drop == i).write.mode("append").parquet(log.log)
        if i < 2:
            log.take(grace=0)
    return log.current()


LATEST_FROM_SNAPSHOT = (
    "SELECT user_id, status, ts, event_id FROM (SELECT user_id, event_type AS status, ts, event_id, "
    "row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM events) WHERE n = 1")

QUERIES = {
    "latest_from_snapshot": q_latest_from_snapshot,
    "prune_by_key_filter": q_prune_by_key_filter,
    "column_stats": q_column_stats,
    "sync_nested": q_sync_nested,
    "scd2_changes_per_key": q_scd2_changes_per_key,
    "scd4_apply": q_scd4_apply,
    "range_join": q_range_join,
    "load_with_rejects": q_load_with_rejects,
    "load_json_once": q_load_json_once,
}
ORACLES = {
    "latest_from_snapshot": LATEST_FROM_SNAPSHOT,
    "prune_by_key_filter": PRUNE_BY_KEY_FILTER,
    "column_stats": COLUMN_STATS,
    "sync_nested": SYNC_NESTED,
    "scd2_changes_per_key": SCD2_CHANGES_PER_KEY,
    "scd4_apply": SCD4_APPLY,
    "range_join": RANGE_JOIN,
    "load_with_rejects": LOAD_WITH_REJECTS,
    "load_json_once": LOAD_JSON_ONCE,
}
