"""Batch sinks on a stream: every micro-batch goes through a table write mode.

The reference has no streaming operators; the column processors and hashes
are plain column expressions and already work on a streaming frame.  What a
stream needs in addition is a sink, so ``stream_into_table`` runs one of the
versioned table's write modes per micro-batch through ``foreachBatch``.

Each batch's effect happens once, also when the driver is lost between the
write and the record of it and the batch is replayed:

* ``merge`` on an unpartitioned table commits the batch id in the manifest of
  the new version, in the same step; a replay is skipped.
* ``merge`` in partitions and ``overwrite_partitions`` give the same rows when
  they are repeated.  The batch id is recorded after the write.
* ``append`` stages the batch under a name made of stream and batch id; a
  replay moves what is left of the same staged files (see
  :meth:`VersionedTable.append_once`).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tablewright.session import work_root
from tablewright.sinks.versioned import VersionedTable

MODES = ("append", "overwrite_partitions", "merge")
PROP_BATCH = "tablewright.stream.{}.batch"


def _committed_batch(table: VersionedTable, stream: str) -> int:
    """Newest batch known to be done: committed with a version, or recorded after a write."""
    name = PROP_BATCH.format(stream)
    return max(int(table.mark(name) or -1), int(table.properties().get(name, "-1")))


def stream_into_table(
    stream_df: DataFrame,
    table_name: str,
    stream_name: str,
    *,
    mode: str = "append",
    merge_condition: str | None = None,
    merge_keys: Sequence[str] | None = None,
    merge_scope: str | None = None,
    merge_aligned: bool = False,
    checkpoint: str | None = None,
    available_now: bool = True,
) -> StreamingQuery:
    """Start a stream that writes each micro-batch into an existing table.

    ``mode``: ``append``, ``overwrite_partitions`` (dynamic) or ``merge``
    (upsert on the equality of ``merge_keys``, or on ``merge_condition`` with
    ``merge_keys`` for the duplicate guard).  ``merge_scope`` defaults to
    ``partitions`` on a partitioned table, so a batch rewrites only what it
    reaches, and to ``table`` otherwise: an unpartitioned target is rewritten
    by every batch; drop old versions with ``VersionedTable.drop_versions``.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    if mode == "merge" and not merge_condition and not merge_keys:
        raise ValueError("merge mode needs merge_keys or merge_condition")
    spark = stream_df.sparkSession
    VersionedTable(spark, table_name)  # fail early when the table is missing
    checkpoint = checkpoint or f"{work_root(spark)}/streams/{stream_name}"

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        table = VersionedTable(batch.sparkSession, table_name)
        if batch_id <= _committed_batch(table, stream_name):
            return  # replay of a batch whose write already committed
        done = {PROP_BATCH.format(stream_name): str(batch_id)}
        token = f"{stream_name}-{batch_id}"
        if mode == "append":
            table.append_once(batch, token)
        elif mode == "overwrite_partitions":
            table.overwrite_partitions(batch)
        else:
            scope = merge_scope or ("partitions" if table.partition_columns else "table")
            table.merge(batch, merge_condition, scope=scope, aligned=merge_aligned, marks=done if scope == "table" else None,
                        keys=list(merge_keys) if merge_keys else None)
        table._set_props(done)
        if mode == "append":
            table.finish_append(token)

    writer = stream_df.writeStream.queryName(stream_name).option("checkpointLocation", checkpoint).foreachBatch(write_batch)
    writer = writer.trigger(availableNow=True) if available_now else writer
    return writer.start()


def run_available(stream_df: DataFrame, table_name: str, stream_name: str, **kwargs) -> None:
    """Process everything available now, then stop (batch-style incremental load)."""
    q = stream_into_table(stream_df, table_name, stream_name, available_now=True, **kwargs)
    q.awaitTermination()
    exc = q.exception()
    if exc is not None:
        raise exc
