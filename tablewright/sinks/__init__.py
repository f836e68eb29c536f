from tablewright.sinks.versioned import TableError, VersionedTable, WriteResult, create_like, write_mode, write_to_location

__all__ = ["TableError", "VersionedTable", "WriteResult", "create_like", "write_mode", "write_to_location"]
