from tablewright.operators.columns import (
    Conformed,
    ProcessorError,
    add_columns,
    columns_first,
    conform,
    drop_columns,
    has_column,
    identify_columns,
    rename_columns,
    select_by_position,
    select_matching,
    sync_with_table,
    with_literals,
)

__all__ = [
    "Conformed",
    "ProcessorError",
    "add_columns",
    "columns_first",
    "conform",
    "drop_columns",
    "has_column",
    "identify_columns",
    "rename_columns",
    "select_by_position",
    "select_matching",
    "sync_with_table",
    "with_literals",
]
