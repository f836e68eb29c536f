"""Reject channel of a load: rows that a reader or a cast would damage go to a table of their own.

Conforming turns a malformed cell into NULL, and a CSV line with too many or
too few fields is cut or filled up.  Here the same projection that conforms a
row also names what would be lost; rows are written once, marked, and read back
as accepted and rejected ones, so the source is read once and accepted +
rejected = read.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tablewright.operators.columns import ProcessorError
from tablewright.operators.nested import conform_value, lost_in_conform
from tablewright.session import scratch_path

REASONS = "reject_reasons"
ROW = "reject_row"
CORRUPT = "__tw_corrupt"
# what a reason says
CAST, UNREADABLE, MISSING = "cast", "unreadable", "null"


class Sifted(NamedTuple):
    """``accepted`` has the target's columns; ``rejected`` has ``reject_reasons`` (array of column and reason)
    and ``reject_row`` (the row as JSON, or the source's own line when it could not be read); ``counts``
    holds ``read``, ``accepted``, ``rejected`` and a count per column with a reason."""

    accepted: DataFrame
    rejected: DataFrame
    counts: dict[str, int]


def reject_reasons(df: DataFrame, target_schema: StructType, required: Sequence[str] = (), corrupt: str | None = None) -> Column:
    """Array of ``column, reason``: cells that a cast makes NULL, NULLs in ``required`` columns, an unreadable line."""
    have = {f.name.lower(): f for f in df.schema.fields}
    needed = {c.lower() for c in required}
    found = []
    for f in target_schema.fields:
        source = have.get(f.name.lower())
        if source is None:
            raise ProcessorError(f"input lacks target column {f.name!r}")
        value = F.col(f"`{source.name}`")
        found.append((lost_in_conform(value, source.dataType, f.dataType), f.name, CAST))
        if f.name.lower() in needed:
            found.append((value.isNull(), f.name, MISSING))
    kinds = [F.when(test, F.struct(F.lit(name).alias("column"), F.lit(reason).alias("reason"))) for test, name, reason in found]
    by_cell = F.array_compact(F.array(*kinds))
    if corrupt is None:
        return by_cell
    line = F.array(F.struct(F.lit(None).cast("string").alias("column"), F.lit(UNREADABLE).alias("reason")))
    return F.when(F.col(f"`{corrupt}`").isNotNull(), line).otherwise(by_cell)


def sift(df: DataFrame, target_schema: StructType, required: Sequence[str] = (), corrupt: str | None = None) -> Sifted:
    """Part the rows of ``df`` into those that conform to ``target_schema`` without loss and the others.

    One job writes all rows, marked, under the shared work folder; both parts
    are read from there, and the counts are observed by that job.  ``corrupt``
    names a column that holds the source's line where the reader could not
    split it.  Rows may repeat; an empty input gives two empty parts.
    """
    spark = df.sparkSession
    have = {f.name.lower(): f for f in df.schema.fields}
    raw = [c for c in df.columns if c != corrupt]
    row = F.to_json(F.struct(*[F.col(f"`{c}`") for c in raw]), {"ignoreNullFields": "false"}) if raw else F.lit("{}")
    if corrupt is not None:
        row = F.coalesce(F.col(f"`{corrupt}`"), row)
    reasons = reject_reasons(df, target_schema, required, corrupt)
    conformed = F.struct(*[
        conform_value(F.col(f"`{have[f.name.lower()].name}`"), have[f.name.lower()].dataType, f.dataType).alias(f.name) for f in target_schema.fields])
    marked = df.select(reasons.alias(REASONS), row.alias("row"), conformed.alias("conformed")).select(
        (F.size(REASONS) == 0).alias("ok"), REASONS, F.when(F.size(REASONS) > 0, F.col("row")).alias(ROW),
        F.when(F.size(REASONS) == 0, F.col("conformed")).alias("conformed"))
    seen = Observation(f"sift-{id(marked)}")

    def cells(name: str) -> Column:
        return F.count_if(F.exists(REASONS, lambda r: r["column"] == name)).alias(f"column {name}")

    per_column = [cells(f.name) for f in target_schema.fields]
    path = scratch_path(spark, "sift")
    marked.observe(seen, F.count(F.lit(1)).alias("read"), F.count_if("ok").alias("accepted"), F.count_if(~F.col("ok")).alias("rejected"),
                   F.count_if(F.exists(REASONS, lambda r: r["reason"] == UNREADABLE)).alias("unreadable"), *per_column).write.parquet(path)
    stored = spark.read.schema(marked.schema).parquet(path)
    counts = {k: int(v or 0) for k, v in seen.get.items()}
    return Sifted(stored.where("ok").select(*[F.col("conformed").getField(f.name).alias(f.name) for f in target_schema.fields]),
                  stored.where("NOT ok").select(REASONS, ROW), counts)


def read_csv_for_sifting(spark: SparkSession, path: str, names: Sequence[str], options: Mapping[str, str] | None = None) -> DataFrame:
    """A CSV source as text columns ``names`` and ``CORRUPT``: the whole line where it has another number of fields."""
    schema = StructType([StructField(n, StringType()) for n in names] + [StructField(CORRUPT, StringType())])
    given = {k: v for k, v in dict(options or {}).items() if k.lower() not in {"mode", "columnnameofcorruptrecord"}}
    return spark.read.options(**given, mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT).schema(schema).csv(path)


def load_csv_with_rejects(spark: SparkSession, path: str, target_schema: StructType, names: Sequence[str] | None = None,
                          options: Mapping[str, str] | None = None, required: Sequence[str] = ()) -> Sifted:
    """S5 + P5 with rejects: the CSV at ``path`` with columns ``names`` (default: the target's), conformed and sifted."""
    names = list(names or target_schema.names)
    return sift(read_csv_for_sifting(spark, path, names, options), target_schema, required, CORRUPT)

