"""Latest row per key of an append-only log, from a snapshot and the files after it (A4).

A snapshot is a folder of Parquet files with the newest row of every key, and
a cut: a file modification time.  Files of the log from the cut on are its
tail.  The current rows are the newest ones of snapshot and tail, so neither
reading them nor taking the next snapshot opens the log's older files: Spark
leaves them out when it lists the folder.

A row may stand in both: taking the newest is the same however often a row is
seen, so a cut that is too early costs time only.  It is set ``grace`` seconds
before the newest file that the snapshot holds, and a job that needs longer to
commit a file to the log than that is the one thing that a snapshot can miss.
The values of ``order_by`` play no part in it: rows that arrive late count.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tablewright.operators.runlog import latest_per_key
from tablewright.sinks import store

CUT = "_cut"  # written last: a folder without it is a snapshot that failed


@dataclass(frozen=True)
class LatestLog:
    """Where a log and its snapshots lie, and what newest means.

    ``keys`` may be null and match each other; ``order_by`` is compared column
    by column, null smallest; of rows equal in both one is kept.  A log
    without files has no rows.
    """

    spark: SparkSession
    log: str
    snapshots: str
    schema: StructType
    keys: Sequence[str]
    order_by: Sequence

    def current(self) -> DataFrame:
        """Newest row per key, from the newest snapshot and the files after it."""
        return self._newest(self._last())

    def take(self, grace: float = 3600.0, keep: int = 2) -> str:
        """Write the next snapshot; returns its folder.

        Of older snapshots ``keep - 1`` stay for readers that hold their
        plan; 2 at least.  Two calls at a time both give a valid one.
        """
        if keep < 2:
            raise ValueError("keep at least two snapshots: a reader may hold the one before")
        done = self._complete()
        last = self._last(done)
        # listed before the rows are read: a file that comes between is in the snapshot and in the tail
        seen = self._newest_file()
        if seen is None:
            cut = last["cut"] if last else None
        else:
            cut = max(seen - int(grace * 1_000_000), last["cut"] or 0 if last else 0)
        number = int(done[-1].split("-")[1]) + 1 if done else 1
        folder = f"{self.snapshots}/snapshot-{number:09d}-{uuid.uuid4().hex[:12]}"
        self._newest(last).write.parquet(folder)
        store.write_text(self.spark, f"{folder}/{CUT}", json.dumps({"cut": cut}))
        for name in done[:len(done) + 1 - keep]:
            store.delete(self.spark, f"{self.snapshots}/{name}")
        return folder

    # ---------------------------------------------------------------- inside
    def _complete(self) -> list[str]:
        """Names of complete snapshots, oldest first."""
        return [n for n in store.names(self.spark, self.snapshots)
                if n.startswith("snapshot-") and store.read_text(self.spark, f"{self.snapshots}/{n}/{CUT}") is not None]

    def _last(self, done: list[str] | None = None) -> dict | None:
        done = self._complete() if done is None else done
        if not done:
            return None
        folder = f"{self.snapshots}/{done[-1]}"
        return {"folder": folder, **json.loads(store.read_text(self.spark, f"{folder}/{CUT}"))}

    def _newest_file(self) -> int | None:
        """Modification time of the log's newest file in microseconds; contents are not read."""
        if not store.names(self.spark, self.log):
            return None
        files = self.spark.read.format("binaryFile").option("recursiveFileLookup", True).load(self.log)
        return files.agg(F.unix_micros(F.max("modificationTime"))).first()[0]

    def _newest(self, last: dict | None) -> DataFrame:
        reader = self.spark.read.schema(self.schema)
        has_log = bool(store.names(self.spark, self.log))
        rows = reader.parquet(self.log) if has_log else self.spark.createDataFrame([], self.schema)
        if last is not None:
            if has_log and last["cut"] is not None:
                rows = rows.where(F.col("_metadata.file_modification_time") >= F.timestamp_micros(F.lit(last["cut"])))
            rows = rows.unionByName(reader.parquet(last["folder"]))
        return latest_per_key(rows, self.keys, self.order_by)
