"""CSV schema resolution for loads into an existing table.

Header names come from the file's own header, a separate header file, or a
``|``-separated list; each name takes the type of the same-named target
column (case-insensitive), string when the target has none.  The result is a
``StructType``, not a DDL string, so header names with spaces work.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import SparkSession
from pyspark.sql.types import StringType, StructField, StructType

# Fixed values that must equal the reference behaviour:
#   default delimiter: ","; header list separator: "|"
DEFAULT_DELIMITER = ","
HEADER_SEPARATOR = "|"


def csv_schema(header: Sequence[str], target: StructType | None) -> StructType:
    types = {f.name.lower(): f.dataType for f in (target.fields if target is not None else [])}
    return StructType([StructField(h, types.get(h.lower(), StringType()), True) for h in header])


def header_from_file(spark: SparkSession, path: str, delimiter: str = DEFAULT_DELIMITER) -> list[str]:
    """First row of a header file (one small row to the driver)."""
    rows = spark.read.option("delimiter", delimiter).csv(path).take(1)
    if not rows:
        raise ValueError(f"header file {path} is empty")
    return [str(v).strip() for v in rows[0]]


def csv_read_plan(
    spark: SparkSession,
    details: Mapping[str, str],
    op_details: Mapping[str, str],
    target: StructType | None,
    source_root: str = "",
) -> tuple[dict[str, str], StructType | None]:
    """Reader options and schema for a CSV load.

    * ``header=true``: the file's header names the columns, all strings.
    * otherwise names from ``headerPath`` (first row, read with the load's own
      delimiter) or ``headerCols``, typed from the target table.
    """
    delimiter = details.get("delimiter", DEFAULT_DELIMITER)
    if str(details.get("header", "")).lower() == "true":
        return {"delimiter": delimiter, "header": "true"}, None
    if op_details.get("headerPath"):
        names = header_from_file(spark, source_root + op_details["headerPath"], delimiter)
    elif details.get("headerCols"):
        names = [h.strip() for h in details["headerCols"].split(HEADER_SEPARATOR)]
    else:
        raise ValueError("a CSV load without header=true needs headerPath or headerCols")
    return {"delimiter": delimiter}, csv_schema(names, target)
