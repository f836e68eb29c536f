"""DuckDB SQL oracles for the registered queries (same column names).

Queries without an entry (murmur3 buckets, SHA-224/384/512) have no DuckDB
equivalent and are checked by row count plus golden unit tests.
"""

_T = "(SELECT * FROM customer WHERE c_mktsegment <> 'AUTOMOBILE')"
_U = ("(SELECT c_custkey, c_name, c_nationkey, c_acctbal + 1 AS c_acctbal, c_mktsegment FROM customer "
      "WHERE c_mktsegment IN ('AUTOMOBILE', 'BUILDING'))")
_O_NULL = ("(SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, "
           "nullif(o_orderpriority, '3-MEDIUM') AS o_orderpriority FROM orders)")
_ADD = ("'tpch' AS src, CAST(round(c_acctbal * 100) AS BIGINT) AS balance_cents, CAST(NULL AS VARCHAR) AS comment")
_SCD_CUR = "(SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer WHERE c_mktsegment <> 'AUTOMOBILE')"
_SCD_UPD = ("(SELECT c_custkey, c_name, c_acctbal + 1 AS c_acctbal, c_mktsegment FROM customer "
            "WHERE c_mktsegment IN ('AUTOMOBILE', 'BUILDING'))")
_EVENTS_DAY = "(SELECT *, CAST(ts AS DATE) AS event_day FROM events)"
_RELOAD = "event_type = 'purchase' AND event_day BETWEEN DATE '2024-01-05' AND DATE '2024-01-07'"

ORACLES: dict[str, str] = {
    "scan_parquet": "SELECT o_orderkey, o_custkey, o_totalprice FROM orders",
    "scan_json": ("SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_acctbal, c_mktsegment "
                  "FROM customer"),
    "scan_orc": "SELECT * FROM part",
    "scan_csv_schema": "SELECT * FROM customer",
    "scan_csv_plain": ("SELECT CAST(c_custkey AS VARCHAR) AS _c0, c_name AS _c1, CAST(c_nationkey AS VARCHAR) AS _c2, "
                       "CAST(c_acctbal AS VARCHAR) AS _c3, c_mktsegment AS _c4 FROM customer"),
    "csv_header_types": "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment AS segment FROM customer",
    "column_selector": "SELECT c_custkey AS cust_id, c_mktsegment AS segment, c_acctbal AS balance FROM customer",
    "sync_add": f"SELECT *, {_ADD}, c_nationkey AS nation_parsed FROM customer",
    "sync_rename": (f"SELECT c_custkey, c_nationkey, c_acctbal, c_mktsegment AS \"C_MKTSEGMENT\", {_ADD}, "
                    "c_name AS customer_name, c_nationkey AS nation FROM customer"),
    "sync_drop": (f"SELECT c_custkey, c_acctbal, c_mktsegment AS \"C_MKTSEGMENT\", {_ADD}, "
                  "c_name AS customer_name, c_nationkey AS nation FROM customer"),
    "sync_conform": ("SELECT c_custkey, c_name AS customer_name, c_nationkey AS nation, "
                     f"CAST(c_acctbal AS VARCHAR) AS c_acctbal, c_mktsegment, {_ADD} FROM customer"),
    "year_sanity": (
        "SELECT * FROM ("
        " SELECT * FROM orders"
        " UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, TIMESTAMP '1980-06-15 00:00:00', o_orderpriority"
        "  FROM orders WHERE o_orderpriority = '1-URGENT'"
        " UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, TIMESTAMP '2999-01-01 00:00:00', o_orderpriority"
        "  FROM orders WHERE o_orderpriority = '5-LOW'"
        " UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(NULL AS TIMESTAMP), o_orderpriority"
        "  FROM orders WHERE o_orderpriority = '3-MEDIUM'"
        ") u WHERE year(o_orderdate) BETWEEN 1990 AND year(current_date)"
    ),
    "select_matching": "SELECT p_size, p_retailprice, p_partkey FROM part",
    "hash_concat": (
        "SELECT c_custkey, sha256(coalesce(CAST(c_custkey AS VARCHAR), 'n/a') || coalesce(c_name, 'n/a') || "
        "coalesce(nullif(c_mktsegment, 'BUILDING'), 'n/a') || coalesce(CAST(c_acctbal AS VARCHAR), 'n/a')) AS row_hash "
        "FROM customer"
    ),
    "hash_each": (
        "SELECT c_custkey, sha256(coalesce(c_name, 'n/a')) AS c_name_hash, "
        "sha256(coalesce(nullif(c_mktsegment, 'BUILDING'), 'n/a')) AS c_mktsegment_hash FROM customer"
    ),
    "hash_text": "SELECT c_custkey, sha256(c_name) AS name_sha256 FROM customer",
    "hash_bits_default": (
        "SELECT c_custkey, sha256(CAST(c_custkey AS VARCHAR) || c_name) AS sha0, "
        "sha256(CAST(c_custkey AS VARCHAR) || c_name) AS sha256 FROM customer"
    ),
    "epoch_text": ("SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') || '+0' || strftime(ts, '%g') AS ts_text "
                   "FROM events"),
    "resolve_load": (
        "SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name, CAST(o_orderkey AS VARCHAR) AS op_id, "
        "CAST(o_custkey AS VARCHAR) AS entity_id, o_orderpriority AS priority "
        "FROM customer JOIN orders ON CAST(c_custkey AS VARCHAR) = CAST(o_custkey AS VARCHAR)"
    ),
    "theta_join": "SELECT c_custkey, n_nationkey FROM customer JOIN nation ON c_nationkey >= n_nationkey",
    "equi_join_extra": (
        "SELECT o_orderkey, c_custkey, c_acctbal FROM orders JOIN customer "
        "ON o_custkey = c_custkey AND c_acctbal > 0 AND o_orderpriority = '1-URGENT'"
    ),
    "merge_key_rows": (
        f"WITH cur AS {_SCD_CUR}, upd AS {_SCD_UPD} "
        "SELECT c_custkey AS mergekey0, c_custkey, c_name, c_acctbal, c_mktsegment FROM upd "
        "UNION ALL SELECT NULL, u.c_custkey, u.c_name, u.c_acctbal, u.c_mktsegment FROM upd u "
        "WHERE EXISTS (SELECT 1 FROM cur c WHERE c.c_custkey = u.c_custkey AND u.c_acctbal <> c.c_acctbal)"
    ),
    "scd2_merge": (
        f"WITH cur AS {_SCD_CUR}, upd AS {_SCD_UPD}, "
        "chg AS (SELECT u.* FROM upd u JOIN cur c ON u.c_custkey = c.c_custkey "
        "        WHERE u.c_name IS DISTINCT FROM c.c_name OR u.c_acctbal IS DISTINCT FROM c.c_acctbal "
        "           OR u.c_mktsegment IS DISTINCT FROM c.c_mktsegment) "
        "SELECT c.c_custkey, c.c_name, c.c_acctbal, c.c_mktsegment, "
        "       c.c_custkey NOT IN (SELECT c_custkey FROM chg) AS is_current, DATE '2024-01-01' AS valid_from, "
        "       CASE WHEN c.c_custkey IN (SELECT c_custkey FROM chg) THEN DATE '2024-02-01' END AS valid_to FROM cur c "
        "UNION ALL SELECT c_custkey, c_name, c_acctbal, c_mktsegment, true, DATE '2024-02-01', NULL FROM chg "
        "UNION ALL SELECT c_custkey, c_name, c_acctbal, c_mktsegment, true, DATE '2024-02-01', NULL FROM upd "
        "  WHERE c_custkey NOT IN (SELECT c_custkey FROM cur)"
    ),
    "prune_target": (
        "SELECT * FROM orders WHERE "
        "o_orderstatus IN (SELECT o_orderstatus FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority IN ('1-URGENT', '5-LOW')) "
        "AND o_orderpriority IN (SELECT o_orderpriority FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority IN ('1-URGENT', '5-LOW'))"
    ),
    "merge_upsert": (
        f"WITH t AS {_T}, u AS {_U} "
        "SELECT * FROM t WHERE c_custkey NOT IN (SELECT c_custkey FROM u) UNION ALL SELECT * FROM u"
    ),
    "merge_bucketed": (
        f"WITH t AS {_T}, u AS {_U} "
        "SELECT * FROM t WHERE c_custkey NOT IN (SELECT c_custkey FROM u) UNION ALL SELECT * FROM u"
    ),
    "merge_delete": (
        f"WITH t AS {_T}, u AS {_U} "
        "SELECT * FROM t WHERE c_custkey NOT IN (SELECT c_custkey FROM u) "
        "UNION ALL SELECT * FROM u WHERE NOT (c_custkey IN (SELECT c_custkey FROM t) AND c_acctbal < 0)"
    ),
    "merge_exprs": (
        f"WITH t AS {_T}, u AS {_U} "
        "SELECT * FROM t WHERE c_custkey NOT IN (SELECT c_custkey FROM u) "
        "UNION ALL SELECT t.c_custkey, u.c_name || '*', t.c_nationkey, t.c_acctbal + u.c_acctbal, t.c_mktsegment "
        "  FROM t JOIN u ON t.c_custkey = u.c_custkey "
        "UNION ALL SELECT c_custkey, c_name, NULL, c_acctbal, NULL FROM u WHERE c_custkey NOT IN (SELECT c_custkey FROM t)"
    ),
    "merge_partitions": (
        "SELECT o_orderkey, o_custkey, o_orderstatus, "
        "CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '1-URGENT' THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice, "
        "o_orderdate, o_orderpriority FROM orders "
        "UNION ALL SELECT -o_orderkey - 1, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority "
        "FROM orders WHERE o_orderstatus = 'P' AND o_orderpriority = '5-LOW'"
    ),
    "merge_delete_partitions": (
        "SELECT o_orderkey, o_custkey, o_orderstatus, "
        "CASE WHEN o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice, "
        "o_orderdate, o_orderpriority FROM orders WHERE o_orderstatus <> 'P' "
        "UNION ALL SELECT -o_orderkey - 1, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority "
        "FROM orders WHERE o_orderstatus = 'O' AND o_orderpriority = '5-LOW'"
    ),
    "update_partitions": (
        "SELECT o_orderkey, o_custkey, o_orderstatus, "
        "CASE WHEN o_orderstatus = 'F' AND o_orderpriority = '2-HIGH' THEN o_totalprice - 1 ELSE o_totalprice END AS o_totalprice, "
        "o_orderdate, o_orderpriority FROM orders"
    ),
    "update_where": (
        "SELECT o_orderkey, o_custkey, "
        "CASE WHEN coalesce(o_orderpriority IN ('1-URGENT', '2-HIGH'), false) THEN o_orderpriority ELSE o_orderstatus END AS o_orderstatus, "
        "CASE WHEN coalesce(o_orderpriority IN ('1-URGENT', '2-HIGH'), false) THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice, "
        "o_orderdate, "
        "CASE WHEN coalesce(o_orderpriority IN ('1-URGENT', '2-HIGH'), false) THEN '0-TOP' ELSE o_orderpriority END AS o_orderpriority "
        f"FROM {_O_NULL} o"
    ),
    "delete_where": f"SELECT * FROM {_O_NULL} o WHERE NOT coalesce(o_orderpriority = '5-LOW', false)",
    "write_append": "SELECT * FROM orders",
    "write_append_part": "SELECT * FROM orders",
    "write_create": "SELECT * FROM orders",
    "write_overwrite": "SELECT * FROM orders WHERE o_orderpriority = '1-URGENT'",
    "write_replace_where": (
        "SELECT * FROM orders WHERE o_orderpriority <> '1-URGENT' "
        "UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice * 2, o_orderdate, o_orderpriority "
        "FROM orders WHERE o_orderpriority = '1-URGENT'"
    ),
    "replace_where_partitions": (
        "SELECT * FROM orders WHERE o_orderstatus = 'O' "
        "UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice * 2, o_orderdate, o_orderpriority "
        "FROM orders WHERE o_orderstatus = 'P' AND o_orderpriority = '1-URGENT'"
    ),
    "delete_partitions": (
        "SELECT * FROM orders WHERE NOT (o_orderstatus = 'F' OR (o_orderstatus = 'O' AND o_orderpriority = '5-LOW'))"
    ),
    "write_static_partition": (
        "SELECT * FROM orders WHERE o_orderstatus <> 'P' "
        "UNION ALL SELECT o_orderkey, o_custkey, 'P', o_totalprice, o_orderdate, o_orderpriority "
        "FROM orders WHERE o_orderstatus = 'O' AND o_orderpriority = '1-URGENT'"
    ),
    "write_dynamic_partition": (
        "SELECT * FROM orders WHERE o_orderstatus <> 'P' "
        "UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice + 0.5, o_orderdate, o_orderpriority "
        "FROM orders WHERE o_orderstatus = 'P' AND o_orderpriority = '1-URGENT'"
    ),
    "delete_then_write": (
        f"WITH e AS {_EVENTS_DAY} "
        f"SELECT * FROM e WHERE event_day NOT IN (SELECT event_day FROM e WHERE {_RELOAD}) "
        "UNION ALL SELECT event_id, ts, user_id, event_type, value * 2, props, event_day "
        f"FROM e WHERE {_RELOAD}"
    ),
    "delete_then_write_rows": (
        "SELECT * FROM events WHERE user_id NOT IN (SELECT user_id FROM events WHERE event_type = 'purchase') "
        "UNION ALL SELECT event_id, ts, user_id, event_type, value * 2, props FROM events WHERE event_type = 'purchase'"
    ),
    "delete_then_write_scoped": (
        f"WITH e AS {_EVENTS_DAY} "
        "SELECT * FROM e WHERE user_id NOT IN (SELECT user_id FROM events WHERE event_type = 'purchase') "
        "UNION ALL SELECT event_id, ts, user_id, event_type, value * 2, props, event_day FROM e WHERE event_type = 'purchase'"
    ),
    "time_travel": (
        "SELECT *, 0 AS version FROM orders "
        "UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus, "
        "CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice + 1 ELSE o_totalprice END, "
        "o_orderdate, o_orderpriority, 1 FROM orders"
    ),
    "create_like": "SELECT * FROM part",
    "distinct_partitions": "SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders",
    "write_stats": ("SELECT 'run-1' AS stat_id, 'num_output_rows' AS stat_name, CAST(count(*) AS VARCHAR) AS stat_value "
                    "FROM lineitem"),
    "latest_status": (
        "SELECT user_id, event_type AS status, ts, event_id FROM ("
        " SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events"
        ") WHERE rn = 1"
    ),
    "metadata_tables": ("SELECT 'op-1' AS op_id, 'Finished' AS status, CAST(count(*) AS VARCHAR) AS num_output_rows, "
                        "'Finished' AS entity_status FROM orders"),
    "load_job": ("SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate, o_orderpriority, 'csv' AS load_src, o_orderstatus "
                 "FROM orders"),
    "load_job_raw": "SELECT * FROM orders",
    "transform_chain": (
        "SELECT c_custkey AS cust_id, c_mktsegment AS segment, c_acctbal AS balance, "
        "sha256(CAST(c_custkey AS VARCHAR) || c_mktsegment) AS key_hash FROM customer"
    ),
}

ORACLES["stream_upsert_partitions"] = (
    "SELECT event_id, ts, user_id, CASE WHEN event_type = 'purchase' THEN 'refund' ELSE event_type END AS event_type, value, props "
    "FROM events"
)
ORACLES["delete_partitions_timestamp"] = (
    "SELECT *, date_trunc('hour', ts) AS event_hour FROM events "
    "WHERE NOT (hour(ts) = 3 OR (event_type = 'error' AND hour(ts) = 5))"
)
ORACLES["merge_extra_condition"] = (
    f"WITH t AS {_T}, u AS {_U} "
    "SELECT * FROM t WHERE c_custkey NOT IN (SELECT c_custkey FROM u) "
    "UNION ALL SELECT * FROM u WHERE c_custkey IN (SELECT c_custkey FROM t)"
)
ORACLES["scd2_partitions"] = ORACLES["scd2_merge"]
ORACLES["merge_stats"] = (
    f"WITH t AS {_T}, u AS {_U}, m AS (SELECT c_acctbal < 0 AS gone, c_custkey IN (SELECT c_custkey FROM t) AS old FROM u), "
    "c AS (SELECT 'num_inserted_rows' AS stat_name, count(*) FILTER (WHERE NOT old) AS n FROM m "
    "UNION ALL SELECT 'num_updated_rows', count(*) FILTER (WHERE old AND NOT gone) FROM m "
    "UNION ALL SELECT 'num_deleted_rows', count(*) FILTER (WHERE old AND gone) FROM m) "
    "SELECT s.stat_id, c.stat_name, CAST(c.n AS VARCHAR) AS stat_value FROM c, (VALUES ('table'), ('partitions')) s(stat_id)"
)
ORACLES["load_job_replace_where"] = (
    "SELECT n_nationkey, CASE WHEN n_regionkey = 1 THEN lower(n_name) ELSE n_name END AS n_name, n_regionkey FROM nation"
)
ORACLES["stream_upsert"] = (
    "SELECT event_id, ts, user_id, event_type, "
    "CASE WHEN event_type = 'purchase' THEN value * 2 ELSE value END AS value, props FROM events"
)


# ---------------------------------------------------------------------------
# Spark's hash() (Murmur3 x86_32, seed 42, tail bytes mixed one by one) written
# in DuckDB SQL, so the bucket query gets a real oracle.  Bytes are taken as
# code points, which is exact for the ASCII text hashed here.  The constants
# are the published Murmur3 ones.
def _rotl(x: str, r: int) -> str:
    return f"((({x}) << {r}) | (({x}) >> {32 - r})) & 4294967295"


def _mul32(x: str, c: int) -> str:
    return f"((({x})::UHUGEINT * {c}) % 4294967296)::UBIGINT"


def _mix(h: str, k: str) -> str:
    k1 = _mul32(_rotl(_mul32(k, 0xCC9E2D51), 15), 0x1B873593)
    return f"(({_rotl(f'xor(({h}), ({k1}))', 13)}) * 5 + {0xE6546B64}) % 4294967296"


def _spark_hash_sql(text_sql: str, source: str, key: str) -> str:
    word = "(unicode(s[4*i+1]) | (unicode(s[4*i+2]) << 8) | (unicode(s[4*i+3]) << 16) | (unicode(s[4*i+4]) << 24))::UBIGINT"
    words = f"list_transform(range(0, length(s) // 4), lambda i: {word})"
    tail = "list_transform(range(4 * (length(s) // 4), length(s)), lambda i: unicode(s[i+1])::UBIGINT)"
    return (
        f"WITH t AS (SELECT {key}, {text_sql} AS s FROM {source}), "
        f"b AS (SELECT {key}, s, list_reduce(list_concat([42::UBIGINT], {words}), lambda h, k: {_mix('h', 'k')}) AS h FROM t), "
        f"c AS (SELECT {key}, xor(list_reduce(list_concat([h], {tail}), lambda h, k: {_mix('h', 'k')}), length(s)::UBIGINT) AS h FROM b), "
        f"d AS (SELECT {key}, {_mul32('xor(h, h >> 16)', 0x85EBCA6B)} AS h FROM c), "
        f"e AS (SELECT {key}, {_mul32('xor(h, h >> 13)', 0xC2B2AE35)} AS h FROM d), "
        f"f AS (SELECT {key}, xor(h, h >> 16)::BIGINT AS h FROM e) "
        f"SELECT {key}, CASE WHEN h >= 2147483648 THEN h - 4294967296 ELSE h END AS h FROM f"
    )


ORACLES["hash_bucket"] = (
    "SELECT c_custkey, abs(h) % 500 AS bucket FROM ("
    + _spark_hash_sql("CAST(c_custkey AS VARCHAR) || coalesce(nullif(c_mktsegment, 'BUILDING'), 'n/a')", "customer", "c_custkey")
    + ")"
)
