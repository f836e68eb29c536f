"""tablewright: batch table-loading operators expressed as Spark DataFrame plans.

Sub-packages:

* ``sources``   – file, catalog and JDBC readers, CSV schema resolution.
* ``operators`` – column processors, join-key builders, merge / update / delete, run logs.
* ``functions`` – column functions (SHA-2 and bucket hashing, epoch text).
* ``sinks``     – versioned parquet catalog tables and their write modes.
* ``plans``     – metadata tables and the load jobs that chain the pieces.
* ``streaming`` – running the batch sinks once per micro-batch.

The names most callers need are re-exported here.
"""

from tablewright.operators.changes import MergeConflict, delete_rows, merge, scd2_changes, update_rows
from tablewright.operators.columns import conform, select_by_position, sync_with_table
from tablewright.plans.jobs import LoadSpec, load_from_metadata, run_spec
from tablewright.sinks.versioned import TableError, VersionedTable, create_like

__version__ = "0.1.0"

__all__ = [
    "LoadSpec",
    "MergeConflict",
    "TableError",
    "VersionedTable",
    "conform",
    "create_like",
    "delete_rows",
    "load_from_metadata",
    "merge",
    "run_spec",
    "scd2_changes",
    "select_by_position",
    "sync_with_table",
    "update_rows",
]
