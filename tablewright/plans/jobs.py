"""Load jobs (L1, L1a, L2): read → reshape → write, described by a LoadSpec.

``run_spec`` runs on the driver and only composes lazy DataFrames; the single
Spark job per load is the write itself (plus the small metadata reads).
``load_from_metadata`` fills a LoadSpec from the metadata tables (J1) and
logs every status change and the write's metrics.
"""

from __future__ import annotations

import traceback
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tablewright.operators.columns import select_by_position, sync_with_table
from tablewright.plans import metadata as md
from tablewright.sinks.versioned import TableError, VersionedTable, WriteResult, write_mode
from tablewright.sources.csv_layout import csv_read_plan
from tablewright.sources.files import FORMATS, read_files
from tablewright.sources.json_once import read_json_once
from tablewright.sources.jdbc import read_external

# Fixed values that must equal the reference behaviour: detail keys of an
# external (table-or-query) source.
EXTERNAL_QUERY_KEYS = ("sfQuery", "query")
EXTERNAL_TABLE_KEYS = ("sfTableName", "dbtable")

Step = Callable[[DataFrame], DataFrame]


@dataclass
class LoadSpec:
    """What one load does.  ``steps`` run left to right with ``DataFrame.transform``."""

    source_format: str
    source_path: str
    target_table: str
    target_root: str | None = None
    reader_options: dict[str, str] = field(default_factory=dict)
    reader_schema: StructType | None = None
    steps: list[Step] = field(default_factory=list)
    partition_by: list[str] = field(default_factory=list)
    mode: str | None = None
    replace_where: str | None = None
    merge_condition: str | None = None
    merge_keys: list[str] = field(default_factory=list)
    external_table: str | None = None
    external_query: str | None = None
    one_pass_json: bool = False  # take the columns of ``reader_schema`` from each JSON line, without inferring


def chain(df: DataFrame, steps: Sequence[Step]) -> DataFrame:
    """L2: apply the steps in order (each one a lazy DataFrame → DataFrame)."""
    return reduce(lambda d, f: d.transform(f), steps, df)


def read_source(spark: SparkSession, spec: LoadSpec) -> DataFrame:
    """File formats read ``source_path``; any other format name is a connector
    given ``reader_options`` and a table or query (S8)."""
    if spec.source_format == "json" and spec.one_pass_json and spec.reader_schema is not None:
        return read_json_once(spark, spec.source_path, spec.reader_schema, keep_unknown=False, keep_corrupt=False)
    if spec.source_format in FORMATS or spec.external_table is None and spec.external_query is None:
        return read_files(spark, spec.source_format, spec.source_path, spec.reader_options, spec.reader_schema)
    return read_external(spark, spec.source_format, spec.reader_options, spec.external_table, spec.external_query)


def write_target(spark: SparkSession, spec: LoadSpec, df: DataFrame) -> WriteResult:
    """Writer: create when absent; else replaceWhere, merge, append, partition
    overwrite (partitioned) or full overwrite (unpartitioned).

    A target root left by a session without a persistent catalog is opened,
    never overwritten."""
    write_mode(spec.mode)  # an unknown mode fails before anything is read
    if not spark.catalog.tableExists(spec.target_table) and spec.target_root and VersionedTable.exists_at(spark, spec.target_root):
        VersionedTable.open(spark, spec.target_table, spec.target_root)
    if not spark.catalog.tableExists(spec.target_table):
        table = VersionedTable.create(spark, spec.target_table, df, root=spec.target_root, partition_by=spec.partition_by)
        return WriteResult(table.name, 0, "CREATE", table.last_metrics)
    table = VersionedTable(spark, spec.target_table)
    mode = write_mode(spec.mode)
    if mode == "replacewhere" and not spec.replace_where:
        raise TableError("mode replaceWhere needs a replaceWhere condition")
    if spec.replace_where:
        # a partitioned target reloads only the partitions the condition touches
        return table.replace_where(df, spec.replace_where, scope="partitions" if table.partition_columns else "table")
    if mode == "merge":
        if not spec.merge_condition and not spec.merge_keys:
            raise TableError("mode merge needs a merge condition or merge keys")
        scope = "partitions" if table.partition_columns else "table"
        return table.merge(df, spec.merge_condition, keys=spec.merge_keys or None, scope=scope)
    if mode == "append":
        return table.append(df)
    if table.partition_columns:
        return table.overwrite_partitions(df)
    return table.overwrite(df)


def run_spec(spark: SparkSession, spec: LoadSpec) -> WriteResult:
    """L2: one builder-style load without metadata."""
    return write_target(spark, spec, chain(read_source(spark, spec), spec.steps))


def spec_from_request(spark: SparkSession, req: md.LoadRequest, conform: bool = True) -> LoadSpec:
    """Turn a resolved metadata row into a LoadSpec.

    Processor choice: ``targetCols`` + ``colMapping`` → positional select;
    otherwise (when ``conform``) add / rename / drop then conform to the
    existing target table.  With ``conform=False`` the reader feeds the writer
    directly, except that a CSV load still maps columns by position.
    """
    d, od = req.details, req.op_details
    target = f"`{req.db_name}`.`{req.name}`"
    exists = spark.catalog.tableExists(f"{req.db_name}.{req.name}")
    target_schema = spark.table(target).schema if exists else None
    fmt = (d.get("format") or "parquet").lower()
    options: dict[str, str] = {}
    schema = None
    ext_table = ext_query = None
    declared = {k[len("option."):]: v for k, v in {**d, **od}.items() if k.startswith("option.")}
    one_pass = False
    if fmt in ("json", "orc", "parquet"):
        options = declared
        if d.get("schema"):
            schema = StructType.fromDDL(d["schema"])
        elif fmt == "json" and conform and target_schema is not None and not declared and not any(
                d.get(k) for k in ("add_columns", "rename_columns", "drop_columns", "targetCols")):
            schema, one_pass = target_schema, True  # only the target's columns are wanted, under their own names
    elif fmt == "csv":
        options, schema = csv_read_plan(spark, d, od, target_schema, req.source_mount)
    elif fmt not in FORMATS:
        merged = {**d, **od}
        ext_query = next((merged[k] for k in EXTERNAL_QUERY_KEYS if merged.get(k)), None)
        ext_table = next((merged[k] for k in EXTERNAL_TABLE_KEYS if merged.get(k)), None)
        if ext_query or ext_table:
            options = declared
        else:
            fmt = "parquet"  # unknown format without a table or query: default reader
    steps: list[Step] = []
    if d.get("targetCols") and d.get("colMapping"):
        if conform or fmt == "csv":
            steps.append(lambda df: select_by_position(df, d["targetCols"], d["colMapping"]))
    elif conform:
        if target_schema is None:
            raise TableError(f"conforming needs the existing table {req.db_name}.{req.name}")
        steps.append(lambda df: sync_with_table(df, target_schema, d.get("add_columns"), d.get("rename_columns"), d.get("drop_columns")).processed)
    parts = [p.strip().lower() for p in d.get("partition_column", "").split("|") if p.strip()]
    return LoadSpec(
        source_format=fmt,
        source_path=req.source_mount + od.get("path", ""),
        target_table=f"{req.db_name}.{req.name}",
        target_root=f"{req.target_mount}/data/{req.db_name}/{req.name}",
        reader_options=options,
        reader_schema=schema,
        steps=steps,
        partition_by=parts,
        mode=d.get("mode"),
        replace_where=od.get("replaceWhere"),
        merge_keys=[k.strip() for k in d.get("merge_keys", "").split("|") if k.strip()],
        merge_condition=d.get("merge_condition"),
        external_table=ext_table,
        external_query=ext_query,
        one_pass_json=one_pass,
    )


def load_from_metadata(spark: SparkSession, metadata_db: str, op_id: str, conform: bool = True,
                       max_attempts: int = 1) -> WriteResult:
    """L1: resolve ``op_id`` (J1), log Started, load, log Finished, store stats.

    A failed attempt is logged as Error with its stack trace and the attempt
    count as ``retry_count`` in the operation details; the load is tried up to
    ``max_attempts`` times, then the last error is raised.  Only the load
    itself is tried again: once its write has committed, a failure to log or
    to store the metrics is raised and never repeats the write.
    """
    req = md.resolve_load(spark, metadata_db, op_id)
    for attempt in range(max(1, max_attempts)):
        details = {**req.op_details, "retry_count": str(attempt)}
        md.log_operation(spark, metadata_db, op_id, req.entity_id, md.STARTED, details)
        try:
            spark.sql(f"CREATE DATABASE IF NOT EXISTS `{req.db_name}` LOCATION '{req.target_mount}/data/{req.db_name}'")
            result = run_spec(spark, spec_from_request(spark, req, conform))
            break
        except Exception as e:
            md.log_operation(spark, metadata_db, op_id, req.entity_id, md.ERROR, details, "".join(traceback.format_exception(e)))
            if attempt + 1 >= max_attempts:
                raise
    md.log_operation(spark, metadata_db, op_id, req.entity_id, md.FINISHED, details)
    md.store_stats(spark, metadata_db, op_id, {**result.metrics, "operation": result.operation, "version": result.version})
    return result
