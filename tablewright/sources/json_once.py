"""JSON lines read in one pass, without inferring a schema.

``spark.read.json`` without a schema reads the whole input twice.  Here each
line is parsed once into a VARIANT; the target's columns are taken from it by
name and type, a line that is no JSON object is kept as text, and fields that
the target lacks are kept in a map.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, NullType, StringType, StructType, TimestampNTZType, TimestampType

UNKNOWN = "unknown_fields"
CORRUPT = "corrupt_line"


def _path(name: str) -> str:
    if re.fullmatch(r"[A-Za-z_][A-Za-z0-9_]*", name):
        return f"$.{name}"
    if '"' in name or "\\" in name:
        raise ValueError(f"field name {name!r} can't be addressed in a JSON path")
    return f'$["{name}"]'


def _field(variant: Column, name: str, kind: DataType) -> Column:
    if isinstance(kind, NullType):
        kind = StringType()
    if isinstance(kind, (TimestampType, TimestampNTZType)):
        # a variant holds a JSON string as text: its cast is that of a string
        return F.try_variant_get(variant, _path(name), "string").try_cast(kind)
    return F.try_variant_get(variant, _path(name), kind.simpleString())


def read_json_once(spark: SparkSession, path: str, schema: StructType, *, keep_unknown: bool = True, keep_corrupt: bool = True) -> DataFrame:
    """The JSON lines at ``path`` as the columns of ``schema``, then ``unknown_fields`` and ``corrupt_line``.

    A field that is absent, null or can't become its type is null.  Names are
    matched as written.  ``unknown_fields`` maps each further field to its JSON
    text (null without any); ``corrupt_line`` is the line when it is no JSON
    object (null otherwise), its columns are null.  Blank lines are no rows.
    One scan; nothing is read to find a schema.
    """
    lines = spark.read.text(path).where(F.trim("value") != "")
    parsed = lines.select("value", F.try_parse_json("value").alias("v"))
    whole = F.startswith(F.ltrim("value"), F.lit("{")) & F.col("v").isNotNull()
    parsed = parsed.select("value", F.when(whole, F.col("v")).alias("v"))
    out = [_field(F.col("v"), f.name, f.dataType).alias(f.name) for f in schema.fields]
    if keep_unknown:
        known = F.array(*[F.lit(f.name) for f in schema.fields]).cast("array<string>")
        others = F.array_except(F.json_object_keys(F.when(F.col("v").isNotNull(), F.col("value"))), known)
        held = F.map_filter(F.from_json("value", "map<string,string>"), lambda k, _: ~F.array_contains(known, k))
        out.append(F.when(F.size(others) > 0, held).alias(UNKNOWN))
    if keep_corrupt:
        out.append(F.when(F.col("v").isNull(), F.col("value")).alias(CORRUPT))
    return parsed.select(*out)
