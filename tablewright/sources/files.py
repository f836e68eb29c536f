"""File and catalog readers.

These are the plain ``spark.read`` calls; keeping them behind one dispatcher
lets a load job pick a reader from a format name.  The returned frames are
lazy, so Catalyst pushes the later filters and projections into the scan.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

# Fixed values that must equal the reference behaviour:
#   format names a load job understands: parquet, csv, orc, json, avro, jdbc
#   and the external-query reader; an unknown name falls back to parquet
FORMATS = ("parquet", "csv", "orc", "json", "avro")
DEFAULT_FORMAT = "parquet"


class SourceUnavailable(RuntimeError):
    """The data source needs a connector that is not on the classpath."""


def read_parquet(spark: SparkSession, path: str | list[str], schema: StructType | None = None,
                 options: Mapping[str, str] | None = None) -> DataFrame:
    """S1."""
    reader = spark.read.options(**dict(options or {}))
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(*([path] if isinstance(path, str) else path))


def read_json(spark: SparkSession, path: str, schema: StructType | None = None, options: Mapping[str, str] | None = None) -> DataFrame:
    """Schema inferred unless given (inferred columns come in name order)."""
    reader = spark.read.options(**dict(options or {}))
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)


def read_orc(spark: SparkSession, path: str, schema: StructType | None = None, options: Mapping[str, str] | None = None) -> DataFrame:
    """S3."""
    reader = spark.read.options(**dict(options or {}))
    if schema is not None:
        reader = reader.schema(schema)
    return reader.orc(path)


def read_avro(spark: SparkSession, path: str) -> DataFrame:
    """Needs the external spark-avro module; a clear error when it is absent."""
    try:
        return spark.read.format("avro").load(path)
    except Exception as e:  # AnalysisException: failed to find data source
        if "avro" in str(e).lower() and ("find" in str(e).lower() or "not found" in str(e).lower()):
            raise SourceUnavailable("reading avro needs the spark-avro package on the classpath") from e
        raise


def read_csv(
    spark: SparkSession,
    path: str,
    options: Mapping[str, str] | None = None,
    schema: StructType | None = None,
) -> DataFrame:
    """No options → all-string ``_c0..``; options; options plus a schema."""
    reader = spark.read.options(**dict(options or {}))
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """S9."""
    return spark.table(name)


def schema_of(df: DataFrame) -> StructType:
    """The schema without reading rows (``limit 0`` plan)."""
    return df.limit(0).schema


def read_range(spark: SparkSession, start: int, end: int) -> DataFrame:
    """S13."""
    return spark.range(start, end)


def read_files(
    spark: SparkSession,
    fmt: str | None,
    path: str,
    options: Mapping[str, str] | None = None,
    schema: StructType | None = None,
) -> DataFrame:
    """Pick a file reader by format name; unknown or missing → parquet."""
    f = (fmt or DEFAULT_FORMAT).lower()
    if f == "csv":
        return read_csv(spark, path, options, schema)
    if f == "orc":
        return read_orc(spark, path, schema, options)
    if f == "json":
        return read_json(spark, path, schema, options)
    if f == "avro":
        return read_avro(spark, path)
    return read_parquet(spark, path, schema, options)
