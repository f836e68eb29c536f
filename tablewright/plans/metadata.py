"""Metadata tables that drive loads, and the run log kept in them.

Four parquet tables in one database:

* ``mount_details``            – database name → source and target root paths;
* ``entity``                   – one row per target table, ``details`` map of load options;
* ``entity_operation_details`` – one row per load request and status change
                                 (append-only; latest row per ``op_id`` wins);
* ``entity_operation_stats``   – metrics of each write.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, StringType, StructField, StructType, TimestampType

from tablewright.operators.logsnap import LatestLog
from tablewright.operators.runlog import latest_per_key, stats_rows

# Fixed values that must equal the reference behaviour: table names and columns.
MOUNTS = "mount_details"
ENTITY = "entity"
OPERATIONS = "entity_operation_details"
STATS = "entity_operation_stats"

_SNAPSHOTS = "_snapshots"  # ends the name of a folder beside the log's

_DDL = {
    MOUNTS: "dbName STRING, source_mount STRING, target_mount STRING",
    ENTITY: (
        "id STRING, db_name STRING, name STRING, entity_type STRING, insert_dt TIMESTAMP, latest_status STRING, "
        "update_date STRING, updated_at TIMESTAMP, details MAP<STRING, STRING>"
    ),
    OPERATIONS: (
        "op_id STRING, entity_id STRING, start_tm TIMESTAMP, end_tm TIMESTAMP, status STRING, "
        "exception_details STRING, updated_at TIMESTAMP, details MAP<STRING, STRING>"
    ),
    STATS: "stat_id STRING, stat_name STRING, stat_value STRING, updated_at TIMESTAMP",
}

# Status names of a run (Started → Finished | Error).
STARTED, FINISHED, ERROR = "Started", "Finished", "Error"

OPERATION_SCHEMA = StructType(
    [
        StructField("op_id", StringType()),
        StructField("entity_id", StringType()),
        StructField("start_tm", TimestampType()),
        StructField("end_tm", TimestampType()),
        StructField("status", StringType()),
        StructField("exception_details", StringType()),
        StructField("updated_at", TimestampType()),
        StructField("details", MapType(StringType(), StringType())),
    ]
)


def metadata_ddl(db: str, base_path: str) -> list[str]:
    """The statements creating the database and its four tables."""
    stmts = [f"CREATE DATABASE IF NOT EXISTS `{db}` LOCATION '{base_path}/{db}'"]
    for table, cols in _DDL.items():
        stmts.append(f"CREATE TABLE IF NOT EXISTS `{db}`.`{table}` ({cols}) USING parquet LOCATION '{base_path}/{db}/{table}'")
    return stmts


def create_metadata_tables(spark: SparkSession, db: str, base_path: str) -> None:
    for stmt in metadata_ddl(db, base_path):
        spark.sql(stmt)


def _t(db: str, table: str) -> str:
    return f"`{db}`.`{table}`"


def add_mount(spark: SparkSession, db: str, db_name: str, source_mount: str, target_mount: str) -> None:
    spark.createDataFrame([(db_name, source_mount, target_mount)], "dbName string, source_mount string, target_mount string") \
        .write.insertInto(_t(db, MOUNTS))


def add_entity(spark: SparkSession, db: str, entity_id: str, db_name: str, name: str, details: Mapping[str, str],
               entity_type: str = "table") -> None:
    df = spark.createDataFrame(
        [(entity_id, db_name, name, entity_type, None, None, None, None, dict(details))],
        "id string, db_name string, name string, entity_type string, insert_dt timestamp, latest_status string, "
        "update_date string, updated_at timestamp, details map<string,string>",
    ).withColumn("insert_dt", F.current_timestamp()).withColumn("updated_at", F.current_timestamp())
    df.write.insertInto(_t(db, ENTITY))


def log_operation(spark: SparkSession, db: str, op_id: str, entity_id: str, status: str,
                  details: Mapping[str, str] | None = None, exception: str | None = None) -> None:
    """A4: append one status row; the newest row per ``op_id`` is the current state."""
    now = F.current_timestamp()
    df = spark.createDataFrame([(op_id, entity_id, None, None, status, exception, None, dict(details or {}))], OPERATION_SCHEMA)
    df = df.withColumn("updated_at", now)
    if status == STARTED:
        df = df.withColumn("start_tm", now)
    if status in (FINISHED, ERROR):
        df = df.withColumn("end_tm", now)
    df.write.insertInto(_t(db, OPERATIONS))


def _operation_log(spark: SparkSession, db: str) -> LatestLog:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {_t(db, OPERATIONS)}").collect()  # catalog metadata
    log = [r["data_type"] for r in rows if r["col_name"] == "Location"][-1].rstrip("/")
    return LatestLog(spark, log, f"{log}{_SNAPSHOTS}", OPERATION_SCHEMA, ["op_id"], ["updated_at", _status_rank()])


def operations_current(spark: SparkSession, db: str) -> DataFrame:
    """Latest row per ``op_id`` of the append-only operation log: from the newest snapshot and
    the files after it, or from the whole log while none was taken."""
    return _operation_log(spark, db).current()


def snapshot_operations(spark: SparkSession, db: str, grace: float = 3600.0) -> str:
    """A4: store the latest row per ``op_id``, so that :func:`operations_current` reads only that and
    files from ``grace`` seconds before the log's newest file on.  The log itself stays as it is."""
    return _operation_log(spark, db).take(grace)


def _status_rank():
    """Tie-break for rows logged within the same timestamp: request < Started < end state."""
    return F.when(F.col("status") == STARTED, 1).when(F.col("status").isNull(), 0).otherwise(2)


def entities_current(spark: SparkSession, db: str) -> DataFrame:
    """Entities with ``latest_status`` / ``updated_at`` from their newest
    operation row (the log is append-only, so the entity row is not rewritten)."""
    ops = spark.table(_t(db, OPERATIONS)).filter(F.col("status").isNotNull()).select("entity_id", "status", "updated_at")
    newest = latest_per_key(ops.withColumn("__tw_rank", _status_rank()), ["entity_id"], ["updated_at", "__tw_rank"])
    ents = spark.table(_t(db, ENTITY)).drop("latest_status", "updated_at")
    return ents.join(newest, ents["id"] == newest["entity_id"], "left").select(
        *[ents[c] for c in ents.columns], newest["status"].alias("latest_status"), newest["updated_at"].alias("updated_at")
    )


def store_stats(spark: SparkSession, db: str, run_id: str, metrics: Mapping[str, object]) -> None:
    """A3: append the metrics of one write to the stats table."""
    stats_rows(spark, run_id, metrics).write.insertInto(_t(db, STATS))


@dataclass
class LoadRequest:
    """J1 result: the entity and operation rows of one load, as plain values."""

    op_id: str
    entity_id: str
    db_name: str
    name: str
    details: dict[str, str]
    op_details: dict[str, str]
    source_mount: str
    target_mount: str


def resolve_rows(operations: DataFrame, entities: DataFrame, op_id: str | None = None) -> DataFrame:
    """J1 as a plan: operations (their ``details`` renamed ``op_details``)
    joined with their entity on ``id = entity_id``; one operation when
    ``op_id`` is given, every operation (batch resolution) when it is None."""
    ops = operations if op_id is None else operations.filter(F.col("op_id") == F.lit(op_id))
    ops = ops.withColumnRenamed("details", "op_details")
    return entities.join(ops, entities["id"] == ops["entity_id"], "inner")


def resolve_load(spark: SparkSession, db: str, op_id: str) -> LoadRequest:
    """Exactly one entity × operation row for ``op_id``, plus its mounts."""
    rows = resolve_rows(operations_current(spark, db), spark.table(_t(db, ENTITY)), op_id).take(2)
    if len(rows) != 1:
        raise LookupError(f"operation {op_id!r} resolves to {len(rows)} entity rows, expected 1")
    r: Row = rows[0]
    mounts = (spark.table(_t(db, MOUNTS)).filter(F.col("dbName") == F.lit(r["db_name"]))
              .select("source_mount", "target_mount").distinct().take(2))
    if len(mounts) != 1 or not mounts[0]["target_mount"]:
        raise LookupError(f"database {r['db_name']!r} has {len(mounts)} mounts with a target, expected 1")
    src, tgt = mounts[0]["source_mount"], mounts[0]["target_mount"]
    return LoadRequest(
        op_id=r["op_id"],
        entity_id=r["entity_id"],
        db_name=r["db_name"],
        name=r["name"],
        details=dict(r["details"] or {}),
        op_details=dict(r["op_details"] or {}),
        source_mount=src or "",
        target_mount=tgt or "",
    )
