from tablewright.sources.csv_layout import csv_read_plan, csv_schema, header_from_file
from tablewright.sources.files import (
    SourceUnavailable,
    read_avro,
    read_csv,
    read_files,
    read_json,
    read_orc,
    read_parquet,
    read_range,
    read_table,
    schema_of,
)
from tablewright.sources.jdbc import jdbc_options, read_external, read_jdbc

__all__ = [
    "SourceUnavailable",
    "csv_read_plan",
    "csv_schema",
    "header_from_file",
    "jdbc_options",
    "read_avro",
    "read_csv",
    "read_external",
    "read_files",
    "read_jdbc",
    "read_json",
    "read_orc",
    "read_parquet",
    "read_range",
    "read_table",
    "schema_of",
]
