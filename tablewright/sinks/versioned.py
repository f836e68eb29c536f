"""Versioned parquet catalog tables and their write modes.

A table is a catalog table whose LOCATION is one directory
``<root>/version-<n>-<id>``; the directory's name carries the version, and a
manifest in it lists the directories of all earlier versions.

* Rewriting changes (overwrite, replaceWhere, merge, update, delete, SCD2)
  compute the new content as one DataFrame from the current version, write it
  to a fresh directory that no other attempt shares, write its manifest, and
  then move LOCATION: one catalog statement is the commit.  Whatever fails
  before it, the table stays as it was; whatever fails after it only loses
  informational properties.  Older versions are never modified, so time travel
  reads the directory of that version.
* Appends, partition overwrites and partition-scoped changes work in place on
  the current version and rewrite only the partitions they touch.  They start
  no new version.  Replacing partitions is Spark's dynamic overwrite: deleting
  and renaming directories at job commit is not atomic, and a driver lost in
  that step can leave some of the touched partitions missing.

Partitions are found by listing the version directory, not registered in the
catalog, so a commit never lists or repairs partitions, and a partition is
always addressed by the directory string that Spark itself wrote.

Single writer per table is assumed: there is no transaction log.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tablewright.operators import changes
from tablewright.operators.columns import with_literals
from tablewright.operators.keys import prune_target
from tablewright.session import work_root
from tablewright.sinks import store

PROP_ROOT = "tablewright.root"
PROP_OPERATION = "tablewright.operation"
PROP_METRICS = "tablewright.metrics"
PROP_PARTITIONS = "tablewright.partition_columns"
PROP_BUCKETS = "tablewright.bucket_by"
PROP_REBALANCE = "tablewright.rebalance_writes"
VERSION_DIR = "version-{}-{}"
MANIFEST = "_tablewright.json"

DIR = "__tw_dir"  # helper column of located rows: their partition directory


class TableError(RuntimeError):
    pass


@dataclass
class WriteResult:
    table: str
    version: int
    operation: str
    metrics: dict[str, str] = field(default_factory=dict)


def _sql_str(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _ident(name: str) -> str:
    return ".".join(f"`{p}`" for p in name.split("."))


def _ddl_columns(schema: StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def _ordered(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Columns ``names`` of ``df``, found in any case, named as given."""
    return df.select(*[F.col(f"`{n}`").alias(n) for n in names])


def _expr(e: str | Column) -> Column:
    return F.expr(e) if isinstance(e, str) else e


def _true(cond: str | Column) -> Column:
    return F.coalesce(_expr(cond), F.lit(False))


def _clustered(df: DataFrame, parts: Sequence[str]) -> DataFrame:
    """Cluster rows by partition value before a partitioned write.

    The ``rebalance`` hint adds one shuffle on the partition columns; AQE then
    splits a partition value that is too large (a hot value holding a third of
    the rows is written by many tasks) and merges small ones, so each output
    partition gets a few right-sized files instead of one file per task.
    """
    return df.hint("rebalance", *parts) if parts else df


def _observation(df: DataFrame, name: str, **metrics: Column) -> tuple[DataFrame, Observation]:
    obs = Observation(f"tablewright_{name}_{uuid.uuid4().hex[:8]}")
    return df.observe(obs, *[c.alias(k) for k, c in metrics.items()]), obs


def _observed(*observations: Observation) -> dict[str, str]:
    """Row counts gathered by the write job.  A count whose plan was pruned away as
    empty is left out: nothing may be concluded from its absence."""
    out: dict[str, str] = {}
    for obs in observations:
        try:
            out |= {k: str(v or 0) for k, v in obs.get.items()}
        except Exception:  # the observed plan did not run
            continue
    return out


def _write_version(name: str, df: DataFrame, location: str, parts: Sequence[str],
                   bucket_by: tuple[int, list[str]] | None, rebalance: bool = True) -> dict[str, str]:
    """Write one fresh version directory; returns the write's row metrics."""
    observed, obs = _observation(df, "write", num_output_rows=F.count(F.lit(1)))
    if bucket_by is None:
        writer = (_clustered(observed, parts) if rebalance else observed).write.mode("errorifexists")
        writer.partitionBy(*parts).parquet(location)
    else:
        _write_bucketed(name, observed, location, parts, bucket_by, "static")
    return _observed(obs)


def _write_bucketed(name: str, df: DataFrame, location: str, parts: Sequence[str], bucket_by: tuple[int, list[str]],
                    overwrite: str) -> None:
    """Bucketed writes need a catalog table: a throwaway external one, dropped
    right after; its files stay where the version lives."""
    n, cols = bucket_by
    db = name.rsplit(".", 1)[0] + "." if "." in name else ""
    staging = f"{db}__tw_stage_{uuid.uuid4().hex[:12]}"
    (df.write.mode("overwrite").option("partitionOverwriteMode", overwrite).partitionBy(*parts).bucketBy(n, *cols).sortBy(*cols)
     .option("path", location).saveAsTable(staging))
    df.sparkSession.sql(f"DROP TABLE IF EXISTS {_ident(staging)}")


class VersionedTable:
    """Handle on a versioned parquet table registered in the session catalog."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.name = name
        self._fixed: dict | None = None  # layout and schema fixed at creation, so cached per handle
        self._schema: StructType | None = None
        if not spark.catalog.tableExists(name):
            raise TableError(f"table {name} does not exist")

    # ------------------------------------------------------------------ create
    @classmethod
    def create(
        cls,
        spark: SparkSession,
        name: str,
        df: DataFrame,
        root: str | None = None,
        partition_by: Sequence[str] = (),
        if_exists: str = "error",
        bucket_by: tuple[int, Sequence[str]] | None = None,
        rebalance_writes: bool = True,
    ) -> "VersionedTable":
        """Create the table from ``df`` as version 0.

        ``if_exists``: ``error`` or ``ignore`` (keep the existing table).
        A ``root`` that holds a table already is refused: use :meth:`open`.
        ``bucket_by=(n, columns)`` stores every version in ``n`` buckets of
        those columns: joins and aggregations on them (a merge on its key, the
        distinct keys of its insert check) then read the table without a
        shuffle.  ``rebalance_writes`` (partitioned tables) adds one shuffle per
        write that clusters rows by partition value: a few right-sized files
        per partition and hot values split by AQE.  Turn it off for
        low-cardinality partitions, where each task writing one file per value
        is already fine.
        """
        if spark.catalog.tableExists(name):
            if if_exists == "ignore":
                return cls(spark, name)
            raise TableError(f"table {name} already exists")
        root = root or cls.default_root(spark, name)
        if cls.exists_at(spark, root):
            raise TableError(f"{root} holds a table already; open it instead")
        by_lower = {c.lower(): c for c in df.columns}
        missing = [p for p in partition_by if p.lower() not in by_lower]
        if missing:
            raise TableError(f"partition columns {missing} are not in the data")
        parts = [by_lower[p.lower()] for p in partition_by]
        ordered = _ordered(df, [c for c in df.columns if c not in parts] + parts)
        bucket = None
        if bucket_by is not None:
            bucket = (int(bucket_by[0]), [by_lower[c.lower()] for c in bucket_by[1]])
            ordered = ordered.repartition(bucket[0], *[F.col(f"`{c}`") for c in bucket[1]])
        directory = cls._fresh_dir(0)
        metrics = _write_version(name, ordered, f"{root}/{directory}", parts, bucket, rebalance_writes)
        manifest = {"version": 0, "history": [directory], "schema": ordered.schema.jsonValue(), "partitions": parts,
                    "buckets": list(bucket) if bucket else None, "rebalance": rebalance_writes, "operation": "CREATE",
                    "metrics": metrics, "marks": {}}
        store.write_text(spark, f"{root}/{directory}/{MANIFEST}", json.dumps(manifest))
        cls._register(spark, name, root, manifest)
        return cls(spark, name)

    @classmethod
    def open(cls, spark: SparkSession, name: str, root: str) -> "VersionedTable":
        """Register the table stored under ``root`` as ``name``, at its newest complete version.

        For tables of an earlier session without a persistent catalog, or of
        another application.  A directory without a manifest (a write that
        failed) is not a version.
        """
        newest = None
        for d in store.names(spark, root):
            text = store.read_text(spark, f"{root}/{d}/{MANIFEST}") if d.startswith("version-") else None
            if text is not None:
                found = json.loads(text)
                if newest is None or found["version"] > newest["version"]:
                    newest = found
        if newest is None:
            raise TableError(f"{root} holds no table")
        cls._register(spark, name, root, newest)
        return cls(spark, name)

    @staticmethod
    def exists_at(spark: SparkSession, root: str) -> bool:
        return any(store.read_text(spark, f"{root}/{d}/{MANIFEST}") is not None
                   for d in store.names(spark, root) if d.startswith("version-"))

    @staticmethod
    def default_root(spark: SparkSession, name: str) -> str:
        return f"{work_root(spark)}/tables/{name.replace('.', '/')}"

    @staticmethod
    def _fresh_dir(version: int) -> str:
        return VERSION_DIR.format(version, uuid.uuid4().hex[:12])

    @staticmethod
    def _register(spark: SparkSession, name: str, root: str, manifest: Mapping) -> None:
        parts, bucket = manifest["partitions"], manifest["buckets"]
        props = {
            PROP_ROOT: root,
            PROP_OPERATION: manifest["operation"],
            PROP_METRICS: json.dumps(manifest["metrics"], sort_keys=True),
            PROP_PARTITIONS: json.dumps(parts),
            PROP_BUCKETS: json.dumps(bucket),
            PROP_REBALANCE: "true" if manifest["rebalance"] else "false",
        }
        prop_sql = ", ".join(f"{_sql_str(k)}={_sql_str(v)}" for k, v in props.items())
        part_sql = f"PARTITIONED BY ({', '.join(f'`{p}`' for p in parts)})" if parts else ""
        bucket_sql = ""
        if bucket:
            cols = ", ".join(f"`{c}`" for c in bucket[1])
            bucket_sql = f"CLUSTERED BY ({cols}) SORTED BY ({cols}) INTO {bucket[0]} BUCKETS"
        if "." not in name:
            name = f"{spark.catalog.currentDatabase()}.{name}"
        # a session of its own: partitions are listed from the directory, whatever the caller's settings
        side = spark.newSession()
        side.conf.set("spark.sql.hive.manageFilesourcePartitions", "false")
        schema = StructType.fromJson(manifest["schema"])
        side.sql(
            f"CREATE TABLE {_ident(name)} ({_ddl_columns(schema)}) USING parquet {part_sql} {bucket_sql} "
            f"LOCATION {_sql_str(root + '/' + manifest['history'][-1])} TBLPROPERTIES ({prop_sql})"
        )

    # ---------------------------------------------------------------- metadata
    def properties(self) -> dict[str, str]:
        rows = self.spark.sql(f"SHOW TBLPROPERTIES {_ident(self.name)}").collect()  # catalog metadata, a few rows
        return {r["key"]: r["value"] for r in rows}

    def _current_dir(self) -> str:
        """Name of the directory LOCATION points at: the one source of the current version."""
        rows = self.spark.sql(f"DESCRIBE TABLE EXTENDED {_ident(self.name)}").collect()  # catalog metadata
        return [r["data_type"] for r in rows if r["col_name"] == "Location"][-1].rstrip("/").rsplit("/", 1)[-1]

    def _manifest(self) -> dict:
        text = store.read_text(self.spark, f"{self.root}/{self._current_dir()}/{MANIFEST}")
        if text is None:
            raise TableError(f"{self.name} is no versioned table")
        return json.loads(text)

    def _layout(self) -> dict:
        if self._fixed is None:
            props = self.properties()
            self._fixed = {"root": props[PROP_ROOT], "parts": json.loads(props[PROP_PARTITIONS]),
                           "buckets": json.loads(props.get(PROP_BUCKETS, "null") or "null"),
                           "rebalance": props.get(PROP_REBALANCE, "true") == "true"}
        return self._fixed

    @property
    def version(self) -> int:
        return int(self._current_dir().split("-")[1])

    @property
    def root(self) -> str:
        return self._layout()["root"]

    @property
    def schema(self) -> StructType:
        if self._schema is None:
            self._schema = self.spark.table(self.name).schema
        return self._schema

    @property
    def partition_columns(self) -> list[str]:
        return list(self._layout()["parts"])

    @property
    def bucket_by(self) -> tuple[int, list[str]] | None:
        stored = self._layout()["buckets"]
        return (int(stored[0]), list(stored[1])) if stored else None

    @property
    def last_metrics(self) -> dict[str, str]:
        return json.loads(self.properties().get(PROP_METRICS, "{}"))

    @property
    def last_operation(self) -> str:
        return self.properties().get(PROP_OPERATION, "")

    def location(self, version: int | None = None) -> str:
        if version is None:
            return f"{self.root}/{self._current_dir()}"
        history = self._manifest()["history"]
        if not 0 <= version < len(history):
            raise TableError(f"{self.name} has versions 0..{len(history) - 1}, not {version}")
        if history[version] is None:
            raise TableError(f"version {version} of {self.name} was dropped")
        return f"{self.root}/{history[version]}"

    # -------------------------------------------------------------------- read
    def read(self, version: int | None = None) -> DataFrame:
        """Current content, or S11 time travel to ``version`` (read by path with
        the stored schema so partition values keep their declared types)."""
        if version is None:
            # listed anew: another session (e.g. a stream's foreachBatch) may have written it
            if self.bucket_by:
                self.spark.catalog.refreshTable(self.name)
                return self.spark.table(self.name)
        path = self.location(version)
        return self.spark.read.schema(self.schema).option("basePath", path).parquet(path)

    def drop_versions(self, before: int) -> None:
        """Delete the files of versions below ``before`` (never the current one); they can't be read any more."""
        manifest = self._manifest()
        for v in range(min(before, manifest["version"])):
            if manifest["history"][v] is not None:
                store.delete(self.spark, f"{self.root}/{manifest['history'][v]}")
                manifest["history"][v] = None
        store.write_text(self.spark, f"{self.location()}/{MANIFEST}", json.dumps(manifest))

    # -------------------------------------------------------- version rewrites
    def _commit(self, content: DataFrame, operation: str, *observations: Observation,
                marks: Mapping[str, str] | None = None) -> WriteResult:
        """Write ``content`` as the next version and point the catalog at it."""
        before = self._manifest()
        nxt = before["version"] + 1
        directory = self._fresh_dir(nxt)
        data = _ordered(content, self.schema.names)
        bucket = self.bucket_by
        if bucket:
            data = data.repartition(bucket[0], *[F.col(f"`{c}`") for c in bucket[1]])
        metrics = _write_version(self.name, data, f"{self.root}/{directory}", self.partition_columns, bucket,
                                 self._layout()["rebalance"])
        metrics |= _observed(*observations)
        manifest = before | {"version": nxt, "history": [*before["history"], directory], "operation": operation,
                             "metrics": metrics, "marks": before["marks"] | dict(marks or {})}
        store.write_text(self.spark, f"{self.root}/{directory}/{MANIFEST}", json.dumps(manifest))
        self.spark.sql(f"ALTER TABLE {_ident(self.name)} SET LOCATION {_sql_str(self.root + '/' + directory)}")  # the commit
        return self._noted(operation, metrics)

    def _noted(self, operation: str, metrics: Mapping[str, str]) -> WriteResult:
        """Store what the last write did; informational, no decision rests on it."""
        self._set_props({PROP_OPERATION: operation, PROP_METRICS: json.dumps(dict(metrics), sort_keys=True)})
        self.spark.catalog.refreshTable(self.name)
        return WriteResult(self.name, self.version, operation, dict(metrics))

    def _set_props(self, props: Mapping[str, str]) -> None:
        prop_sql = ", ".join(f"{_sql_str(k)}={_sql_str(v)}" for k, v in props.items())
        self.spark.sql(f"ALTER TABLE {_ident(self.name)} SET TBLPROPERTIES ({prop_sql})")

    def mark(self, name: str) -> str | None:
        """A mark committed together with a version (see ``marks`` of :meth:`merge`)."""
        return self._manifest()["marks"].get(name)

    def _conformed(self, df: DataFrame) -> DataFrame:
        """Columns of the table, found in any case."""
        have = {c.lower() for c in df.columns}
        missing = [c for c in self.schema.names if c.lower() not in have]
        if missing:
            raise TableError(f"rows for {self.name} lack columns {missing}")
        return _ordered(df, self.schema.names)

    def _stored(self, df: DataFrame) -> tuple[DataFrame, str]:
        """``df`` computed once into the table's shared folder; the caller deletes it after the write.

        Sub-plans of a change then read the same rows even when the source is
        not deterministic, and lost executors restart from stored files.
        """
        path = f"{self.root}/_scratch-{uuid.uuid4().hex[:12]}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path), path

    def overwrite(self, df: DataFrame) -> WriteResult:
        """Replace the whole content (new version)."""
        return self._commit(self._conformed(df), "OVERWRITE")

    def compact(self) -> WriteResult:
        """Rewrite the current content as a new version with few, large files.

        In-place appends add files to the current version; reading them back
        packs small files into splits of ``spark.sql.files.maxPartitionBytes``
        and the write rebalances (or re-buckets) them, so the new version has
        about one file per split instead of one per append task.
        """
        return self._commit(self.read(), "COMPACT")

    def replace_where(self, df: DataFrame, condition: str | Column, scope: str = "table") -> WriteResult:
        """Replace exactly the rows satisfying ``condition``.

        Old rows where the condition is true are removed (NULL keeps them); every
        new row must satisfy the condition, checked inside the write job itself.
        ``scope="table"`` writes a new version; ``scope="partitions"`` rewrites
        in place only the partitions holding a removed row or a new row.
        """
        holds = _true(condition)
        checked = self._conformed(df).filter(
            F.when(holds, F.lit(True)).otherwise(F.raise_error(F.lit(f"row outside replaceWhere condition of {self.name}")))
        )
        if self._scoped(scope):
            new, scratch = self._stored(checked)
            try:
                rows = self.read()
                return self._rewrite(rows, self._per_dir(rows, holds), new, lambda r: r.filter(~holds), "REPLACE WHERE PARTITIONS")
            finally:
                store.delete(self.spark, scratch)
        return self._commit(self.read().filter(~holds).unionByName(checked), "REPLACE WHERE")

    def merge(self, updates: DataFrame, condition: str | Column | None, scope: str = "table", materialize: bool = True,
              aligned: bool = False, insert: bool = True, among: str | Column | None = None, operation: str = "MERGE",
              marks: Mapping[str, str] | None = None, **kwargs) -> WriteResult:
        """Merge ``updates`` (see :func:`tablewright.operators.changes.merge`).

        ``scope="table"`` (default) writes the merged content as a new version.
        ``scope="partitions"`` (partitioned tables) gives the same rows but
        rewrites in place only the partitions that change: the new values of
        matched rows and the inserts are computed once and stored; then the
        rows of the touched partitions that the updates leave alone (the same
        join again, pruned to these partitions) and the new rows replace them.
        Rows may move between partitions.  The clauses must be deterministic.

        ``aligned=True`` (with ``scope="partitions"``) is for callers whose keys
        never change partition: matches are limited to the same partition and
        the target is pruned to the partition values present in the updates
        (J5), so untouched partitions are not even read.  It refuses to update
        a partition column.

        ``among`` limits the merge to the target rows where it is true; all
        others stay as they are and match nothing.  ``materialize`` stores the
        updates once first.  ``marks`` are committed together with the new
        version (table scope).  The metrics count rows inserted, updated and
        deleted, whatever the scope.
        """
        scratch = []
        if materialize:
            updates, path = self._stored(updates)
            scratch.append(path)
        try:
            if self._scoped(scope):
                return self._merge_partitions(updates, condition, aligned, insert, among, operation + " PARTITIONS", scratch, **kwargs)
            target = self.read()
            marked, inserted = changes.merge_parts(target if among is None else target.filter(_true(among)), updates, condition,
                                                   **kwargs)
            marked, seen = _observation(marked, "merge", num_updated_rows=F.sum(F.col(changes.UPDATED).cast("long")),
                                        num_deleted_rows=F.sum(F.col(changes.DELETED).cast("long")))
            content, observations = marked.filter(~F.col(changes.DELETED)).drop(changes.DELETED, changes.UPDATED), [seen]
            if insert:
                inserted, new = _observation(inserted, "insert", num_inserted_rows=F.count(F.lit(1)))
                content, observations = content.unionByName(inserted), [seen, new]
            if among is not None:
                content = content.unionByName(target.filter(~_true(among)))
            return self._commit(content, operation, *observations, marks=marks)
        finally:
            for path in scratch:
                store.delete(self.spark, path)

    def _merge_partitions(self, updates: DataFrame, condition: str | Column | None, aligned: bool, insert: bool,
                          among: str | Column | None, operation: str, scratch: list[str], **kwargs) -> WriteResult:
        parts, names = self.partition_columns, self.schema.names
        rows = self.read()
        target = self._located(rows)
        if among is not None:
            target = target.filter(_true(among))
        if aligned:
            if {p.lower() for p in parts} & {k.lower() for k in kwargs.get("update_set") or {}}:
                raise TableError("an aligned merge cannot update partition columns; use aligned=False")
            target = prune_target(target, updates, parts)
            if condition is None:
                kwargs["keys"] = list(kwargs.get("keys") or []) + [p for p in parts if p not in (kwargs.get("keys") or [])]
            else:
                condition = _expr(condition)
                for p in parts:
                    condition = condition & (F.col(f"target.`{p}`") == F.col(f"updates.`{p}`"))
        marked, inserted = changes.merge_parts(target, updates, condition, places=[DIR], **kwargs)
        hits, path = self._stored(marked.filter(F.col(changes.DELETED) | F.col(changes.UPDATED)))
        scratch.append(path)
        new_rows = _ordered(hits.filter(F.col(changes.UPDATED)), names)
        counts = hits.agg(F.sum(F.col(changes.UPDATED).cast("long")), F.sum(F.col(changes.DELETED).cast("long"))).first()
        metrics = {"num_updated_rows": str(counts[0] or 0), "num_deleted_rows": str(counts[1] or 0)}
        if insert:
            inserted, path = self._stored(inserted)
            scratch.append(path)
            metrics["num_inserted_rows"] = str(inserted.count())
            new_rows = new_rows.unionByName(inserted)
        gone = hits.groupBy(DIR).agg(F.count(F.lit(1)).alias("gone")).withColumnRenamed(DIR, "__tw_at")
        every = self._located(rows).groupBy(DIR, *[f"`{p}`" for p in parts]).agg(F.count(F.lit(1)).alias("total"))
        per_dir = every.join(gone, every[DIR] == gone["__tw_at"], "left").drop("__tw_at").fillna(0, ["gone"])
        again = dict(kwargs, check_unique=False)

        def unchanged(old: DataFrame) -> DataFrame:
            merged = old if among is None else old.filter(_true(among))
            left = changes.merge_parts(merged, updates, condition, **again).marked
            left = left.filter(~(F.col(changes.DELETED) | F.col(changes.UPDATED))).drop(changes.DELETED, changes.UPDATED)
            return left if among is None else left.unionByName(old.filter(~_true(among)))

        return self._rewrite(rows, per_dir, new_rows, unchanged, operation, metrics)

    def update(self, condition: str | Column, set_values: Mapping[str, str | Column], scope: str = "table") -> WriteResult:
        """M2.  ``scope="partitions"`` rewrites in place only the partitions
        holding an updated row or receiving one (an update may set a
        partition column); otherwise a new version."""
        if self._scoped(scope):
            cond, rows = _true(condition), self.read()
            per_dir, counted = self._stored(self._per_dir(rows, cond))
            new, scratch = self._stored(changes.update_rows(self._rows_in(rows, per_dir.filter("gone > 0")).filter(cond), cond, set_values))
            try:
                return self._rewrite(rows, per_dir, new, lambda r: r.filter(~cond), "UPDATE PARTITIONS")
            finally:
                for path in (scratch, counted):
                    store.delete(self.spark, path)
        return self._commit(changes.update_rows(self.read(), condition, set_values), "UPDATE")

    def _scoped(self, scope: str) -> bool:
        if scope not in ("table", "partitions"):
            raise TableError(f"scope must be 'table' or 'partitions', not {scope!r}")
        if scope == "table":
            return False
        if not self.partition_columns:
            raise TableError(f"{self.name} is not partitioned; scope='partitions' needs partitions")
        return True

    def delete(self, condition: str | Column, scope: str = "table") -> WriteResult:
        """M3.  ``scope="partitions"`` rewrites in place only the partitions
        holding a deleted row and removes those where every row goes."""
        if self._scoped(scope):
            cond, rows = _true(condition), self.read()
            return self._rewrite(rows, self._per_dir(rows, cond), None, lambda r: r.filter(~cond), "DELETE PARTITIONS")
        return self._commit(changes.delete_rows(self.read(), condition), "DELETE")

    # ------------------------------------------------- partition-scoped rewrites
    def _located(self, rows: DataFrame) -> DataFrame:
        """``rows``, the table as :meth:`read` gives it (its files are listed once for a change), with their partition directory."""
        return rows.select("*", F.regexp_replace("_metadata.file_path", "/[^/]*$", "").alias(DIR))

    def _rows_in(self, rows: DataFrame, partitions: DataFrame) -> DataFrame:
        """Those of ``rows`` in the partitions whose values ``partitions`` holds.

        A semi-join on the partition columns: while the list is small enough to
        be broadcast, Spark's dynamic partition pruning reads these partitions
        only (the list needs a comparison as its filter for that).  NULL values,
        which an equality can't match, are looked up apart.
        """
        parts = self.partition_columns
        at = partitions.select(*[F.col(f"`{p}`").alias(f"__tw_p{i}") for i, p in enumerate(parts)])
        equal = same = F.lit(True)
        null = F.lit(False)
        for i, p in enumerate(parts):
            equal = equal & (F.col(f"`{p}`") == F.col(f"__tw_p{i}"))
            same = same & F.col(f"`{p}`").eqNullSafe(F.col(f"__tw_p{i}"))
            null = null | F.col(f"`{p}`").isNull()
        return rows.join(at, equal, "left_semi").unionByName(rows.filter(null).join(at, same, "left_semi"))

    def _per_dir(self, rows: DataFrame, removed: Column) -> DataFrame:
        """Per partition: directory, partition values, rows in ``total`` and rows ``gone``.

        One narrow pass (the condition's columns), aggregated before the shuffle.
        """
        return self._located(rows).groupBy(DIR, *[f"`{p}`" for p in self.partition_columns]).agg(
            F.count(F.lit(1)).alias("total"), F.sum(removed.cast("long")).alias("gone"))

    def _rewrite(self, rows: DataFrame, per_dir: DataFrame, new_rows: DataFrame | None, keep: Callable[[DataFrame], DataFrame], operation: str,
                 metrics: Mapping[str, str] | None = None) -> WriteResult:
        """Replace the partitions that lose or receive rows: rows that ``keep`` leaves of them, plus ``new_rows``.

        The touched partitions are stored as a small table, joined with the
        target, and replaced by Spark's dynamic overwrite.  A partition that
        ends without rows is not written by any task; only the directories of
        these go to the driver, which deletes them.
        """
        parts, names = self.partition_columns, self.schema.names
        if new_rows is None:
            counted = per_dir.withColumn("arriving", F.lit(0).cast("long"))
        else:
            arriving = new_rows.groupBy(*[F.col(f"`{p}`").alias(f"__tw_p{i}") for i, p in enumerate(parts)]).agg(
                F.count(F.lit(1)).alias("arriving"))
            same = F.lit(True)
            for i, p in enumerate(parts):
                same = same & F.col(f"`{p}`").eqNullSafe(F.col(f"__tw_p{i}"))
            counted = per_dir.join(arriving, same, "left").fillna(0, ["arriving"])
        is_touched = "gone > 0 OR arriving > 0"
        touched, scratch = self._stored(counted.filter(is_touched).select(DIR, *[f"`{p}`" for p in parts], "total", "gone", "arriving"))
        try:
            content = _ordered(keep(self._rows_in(rows, touched.filter(is_touched))), names)
            content = content if new_rows is None else content.unionByName(_ordered(new_rows, names))
            written = self._write_in_place(content, overwrite=True)
            for r in touched.filter("arriving = 0 AND gone = total").select(DIR).collect():
                store.delete(self.spark, unquote(r[DIR]))
        finally:
            store.delete(self.spark, scratch)
        return self._noted(operation, written | dict(metrics or {}))

    def scd2(self, updates: DataFrame, key: str, compare: Sequence[str], load_date: str | Column,
             materialize: bool = True, scope: str = "table", current_flag: str = "is_current", **kwargs) -> WriteResult:
        """M4: close changed current rows and add new current rows (see
        :func:`tablewright.operators.changes.scd2_changes`).

        Only current rows are joined; closed history passes through
        (``scope="table"``) or, in partitions without a changed row, is not
        even rewritten (``scope="partitions"``)."""
        scratch = []
        if materialize:
            updates, path = self._stored(updates)
            scratch.append(path)
        try:
            stage = changes.scd2_stage(self.read(), updates, key, compare, current_flag=current_flag, load_date=load_date, **kwargs)
            staged, path = self._stored(stage.staged)
            scratch.append(path)
            return self.merge(staged, stage.condition, scope=scope, materialize=False, among=F.col(f"`{current_flag}`"),
                              operation="MERGE SCD2", **stage.clauses)
        finally:
            for path in scratch:
                store.delete(self.spark, path)

    # ------------------------------------------------------- in-place writes
    def _write_in_place(self, df: DataFrame, overwrite: bool) -> dict[str, str]:
        """Add files to the current version, or replace the partitions present in ``df``.

        Written by path, with the overwrite mode as an option of this one
        write, so writers never change each other's session settings.
        """
        data, obs = _observation(self._conformed(df), "write", num_output_rows=F.count(F.lit(1)))
        parts, location, bucket = self.partition_columns, self.location(), self.bucket_by
        if self._layout()["rebalance"]:
            data = _clustered(data, parts)
        if bucket and overwrite:
            _write_bucketed(self.name, data, location, parts, bucket, "dynamic")
        elif bucket:
            data.write.insertInto(self.name, overwrite=False)
        else:
            mode = "overwrite" if overwrite else "append"
            data.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(*parts).parquet(location)
        return _observed(obs)

    def append(self, df: DataFrame) -> WriteResult:
        """Append rows (partitioned or not) to the current version."""
        return self._noted("APPEND", self._write_in_place(df, overwrite=False))

    def append_once(self, df: DataFrame, token: str) -> WriteResult:
        """Append ``df`` exactly once per ``token``, however often the call is repeated after failures.

        The rows are first written to a staging folder named by the token; a
        complete staging folder is never written again.  Its files then move
        into the table under their own unique names, and a file that an
        earlier attempt moved is kept.  Use a token once: the caller records
        that a token is done, as the stream sink does.
        """
        if self.bucket_by:
            raise TableError("append_once does not support bucketed tables")
        staged = f"{self.root}/_append-{token}"
        if "_SUCCESS" not in store.names(self.spark, staged):
            data = self._conformed(df)
            if self._layout()["rebalance"]:
                data = _clustered(data, self.partition_columns)
            (data.write.mode("overwrite").option("partitionOverwriteMode", "static")
             .option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true").partitionBy(*self.partition_columns).parquet(staged))
        location = self.location()
        for name in store.files_below(self.spark, staged):
            store.move_new(self.spark, f"{staged}/{name}", f"{location}/{name}")
        return self._noted("APPEND", {})

    def finish_append(self, token: str) -> None:
        """Delete what is left of the token's staging folder, once its append is recorded as done."""
        store.delete(self.spark, f"{self.root}/_append-{token}")

    def overwrite_partitions(self, df: DataFrame) -> WriteResult:
        """Replace exactly the partitions present in ``df`` (dynamic overwrite).

        No distinct values are collected: Spark's dynamic partition overwrite
        rewrites the partitions the job writes.  Empty input changes nothing.
        """
        if not self.partition_columns:
            raise TableError(f"{self.name} is not partitioned")
        return self._noted("OVERWRITE PARTITIONS", self._write_in_place(df, overwrite=True))

    def write_static_partition(self, df: DataFrame, values: Mapping[str, object]) -> WriteResult:
        """W4 + P8: set the partition columns to literals and replace that partition; no rows leave it empty."""
        parts = self.partition_columns
        if sorted(values) != sorted(parts):
            raise TableError(f"static partition needs values for exactly {parts}")
        rows = self._conformed(with_literals(df, dict(values)))
        if rows.isEmpty():
            here = F.lit(True)
            typed = {f.name: f.dataType for f in self.schema.fields}
            for p in parts:
                here = here & F.col(f"`{p}`").eqNullSafe(F.lit(values[p]).cast(typed[p]))
            for r in self._located(self.read()).filter(here).select(DIR).distinct().collect():  # one partition
                store.delete(self.spark, unquote(r[DIR]))
            return self._noted("OVERWRITE STATIC PARTITION", {"num_output_rows": "0"})
        return self._noted("OVERWRITE STATIC PARTITION", self._write_in_place(rows, overwrite=True))

    def delete_then_write(self, df: DataFrame, keys: Sequence[str], scope: str = "table") -> WriteResult:
        """Drop every old row whose ``keys`` tuple occurs in ``df``, then add ``df``.

        Keys that are exactly the partition columns make this a dynamic
        partition overwrite in place.  Other keys mark old rows by a semi-join
        with the distinct incoming keys: with ``scope="partitions"`` only the
        partitions holding a marked or a new row are rewritten in place,
        otherwise a new version is written.  In every case a NULL key matches
        NULL keys.
        """
        keys = list(keys)
        if keys and sorted(k.lower() for k in keys) == sorted(p.lower() for p in self.partition_columns):
            return self._noted("DELETE THEN WRITE", self._write_in_place(df, overwrite=True))
        scratch = None
        scoped = self._scoped(scope)
        if scoped:
            df, scratch = self._stored(self._conformed(df))
        incoming = df.select(*[F.col(f"`{k}`").alias(f"__tw_k{i}") for i, k in enumerate(keys)]).distinct()
        same = F.lit(True)
        for i, k in enumerate(keys):
            same = same & F.col(f"`{k}`").eqNullSafe(F.col(f"__tw_k{i}"))
        if scoped:
            try:
                located = self._located(self.read())
                marked = located.join(incoming, same, "left_semi").groupBy(F.col(DIR).alias("__tw_at")).agg(
                    F.count(F.lit(1)).alias("gone"))
                every = located.groupBy(DIR, *[f"`{p}`" for p in self.partition_columns]).agg(F.count(F.lit(1)).alias("total"))
                per_dir = every.join(marked, every[DIR] == marked["__tw_at"], "left").drop("__tw_at").fillna(0, ["gone"])
                return self._rewrite(located.drop(DIR), per_dir, df, lambda r: r.join(incoming, same, "left_anti"), "DELETE THEN WRITE PARTITIONS")
            finally:
                store.delete(self.spark, scratch)
        kept = self.read().join(incoming, same, "left_anti")
        return self._commit(kept.unionByName(self._conformed(df)), "DELETE THEN WRITE")


def create_like(
    spark: SparkSession,
    name: str,
    source: DataFrame,
    cluster_first: Sequence[str] = (),
    partition_by: Sequence[str] = (),
    root: str | None = None,
) -> VersionedTable:
    """W12 + S12 + P9: an empty table with the source's schema, cluster columns
    first, names lower-cased, optionally partitioned."""
    from tablewright.operators.columns import columns_first

    shaped = columns_first(source.limit(0), cluster_first, lower=True)
    return VersionedTable.create(spark, name, shaped, root=root, partition_by=[p.lower() for p in partition_by])


def write_to_location(df: DataFrame, location: str, mode: str, partition_by: Sequence[str] = ()) -> None:
    """W1 / W2 on a plain location: append to, or replace, the parquet files under ``location``.

    No catalog entry and no versions: an overwrite replaces the files.
    """
    df.write.mode({"append": "append", "overwrite": "overwrite"}[write_mode(mode)]).option(
        "partitionOverwriteMode", "static").partitionBy(*partition_by).parquet(location)


def write_mode(mode: str | None) -> str:
    """Mode option in any case → ``append``, ``overwrite`` (also none), ``merge`` or ``replacewhere``; anything else is an error."""
    m = (mode or "overwrite").strip().lower()
    if m not in ("append", "overwrite", "merge", "replacewhere"):
        raise ValueError(f"unknown write mode {mode!r}")
    return m
