"""JDBC and external table-or-query readers.

``read_jdbc`` exposes Spark's partitioned JDBC read (``partitionColumn``,
``lowerBound``, ``upperBound``, ``numPartitions``) so a large table is read by
many tasks; a row cap is a parameter, off by default.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def jdbc_options(
    url: str,
    table: str | None = None,
    query: str | None = None,
    *,
    partition_column: str | None = None,
    lower_bound: int | None = None,
    upper_bound: int | None = None,
    num_partitions: int | None = None,
    fetch_size: int | None = None,
    extra: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Options for ``format("jdbc")``; a trimmed ``query`` wins over ``table``."""
    opts = {"url": url, **dict(extra or {})}
    q = (query or "").strip()
    if q:
        opts["query"] = q
    elif table:
        opts["dbtable"] = table
    else:
        raise ValueError("jdbc read needs a table or a query")
    if partition_column:
        if q:
            raise ValueError("partitionColumn works with dbtable, not with query")
        if None in (lower_bound, upper_bound, num_partitions):
            raise ValueError("partitionColumn needs lower_bound, upper_bound and num_partitions")
        opts.update(
            partitionColumn=partition_column,
            lowerBound=str(lower_bound),
            upperBound=str(upper_bound),
            numPartitions=str(num_partitions),
        )
    if fetch_size:
        opts["fetchsize"] = str(fetch_size)
    return opts


def read_jdbc(spark: SparkSession, url: str, table: str | None = None, *, max_rows: int | None = None, **kw) -> DataFrame:
    """S7 (+A2): a JDBC table or query, optionally capped at ``max_rows``."""
    df = spark.read.format("jdbc").options(**jdbc_options(url, table, **kw)).load()
    return df.limit(max_rows) if max_rows is not None else df


def read_external(
    spark: SparkSession,
    fmt: str,
    options: Mapping[str, str],
    table: str | None = None,
    query: str | None = None,
) -> DataFrame:
    """A connector that takes ``query`` or ``dbtable``.

    A trimmed ``query`` wins; else ``table``; neither → an empty frame.
    """
    q = (query or "").strip()
    reader = spark.read.format(fmt).options(**dict(options))
    if q:
        return reader.option("query", q).load()
    if table:
        return reader.option("dbtable", table).load()
    return spark.createDataFrame([], StructType([]))
