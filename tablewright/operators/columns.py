"""Column processors (P1-P12): positional selection, add / rename / drop,
conforming a frame to a target table's schema.

Every processor returns a new DataFrame built from ``select`` / ``withColumn``
projections, so Catalyst collapses them into one projection over the scan and
column pruning still reaches the reader.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType, StructType

from tablewright.operators.nested import conform_value, holds_struct

# Fixed values that must equal the reference behaviour:
#   list separator of colMapping / targetCols: ","
#   entry separator of add / rename / drop specs: "|", pair separator "="
#   literal meaning SQL NULL in an add spec: "null"
#   marker removed from an added name before its type lookup: "_parsed"
LIST_SEPARATOR = ","
ENTRY_SEPARATOR = "|"
PAIR_SEPARATOR = "="
NULL_LITERAL = "null"
PARSED_MARKER = "_parsed"


class ProcessorError(ValueError):
    """A processor option is missing or malformed."""


class Conformed(NamedTuple):
    """Dual output of a processor: the conformed frame and the frame before it."""

    processed: DataFrame
    raw: DataFrame


def _split(spec: str | Sequence[str], sep: str) -> list[str]:
    if isinstance(spec, str):
        return [s.strip() for s in spec.split(sep)]
    return [str(s).strip() for s in spec]


def parse_pairs(spec: str | Sequence[tuple[str, str]], option: str) -> list[tuple[str, str]]:
    """``"a=x|b=y"`` → ``[("a", "x"), ("b", "y")]``; anything but two parts is an error."""
    if not isinstance(spec, str):
        pairs = [tuple(p) for p in spec]
    else:
        pairs = [tuple(entry.split(PAIR_SEPARATOR)) for entry in spec.split(ENTRY_SEPARATOR)]
    for p in pairs:
        if len(p) != 2:
            raise ProcessorError(f"properly configure {option}: {PAIR_SEPARATOR.join(p)!r} is not name{PAIR_SEPARATOR}value")
    return [(a, b) for a, b in pairs]


def has_column(df: DataFrame, name: str) -> bool:
    """True if ``name`` resolves against ``df`` (nested paths included)."""
    try:
        df.select(F.col(name)).schema  # analysis only, no job
        return True
    except Exception:
        return False


def _lower_names(schema: StructType) -> dict[str, DataType]:
    return {f.name.lower(): f.dataType for f in schema.fields}


def select_by_position(df: DataFrame, target_cols: str | Sequence[str], positions: str | Sequence[int | str]) -> DataFrame:
    """Pick input columns by 1-based position and name them after the target.

    The two lists are zipped, so the shorter one decides the width; output
    order is the target order.
    """
    names = _split(target_cols, LIST_SEPARATOR)
    try:
        idx = [int(p) for p in _split(positions, LIST_SEPARATOR)]
    except ValueError as e:
        raise ProcessorError(f"colMapping must hold integers: {positions!r}") from e
    cols = df.columns
    out = []
    for name, i in zip(names, idx):
        if not 1 <= i <= len(cols):
            raise ProcessorError(f"colMapping position {i} outside 1..{len(cols)}")
        out.append(F.col(f"`{cols[i - 1]}`").alias(name))
    return df.select(*out)


def add_columns(df: DataFrame, spec: str | Sequence[tuple[str, str]], target_schema: StructType | None = None) -> DataFrame:
    """Add ``name=expr`` columns, left to right, cast to the target's types.

    * a name that already exists (any case) is skipped;
    * ``null`` means a NULL literal, anything else is a SQL expression that
      may use columns added by earlier entries;
    * the new name is lower-cased; its type is the same-named target column's
      type, with ``_parsed`` removed from the name before the lookup, or
      string when the target has no such column.
    """
    types = _lower_names(target_schema) if target_schema is not None else {}
    for name, value in parse_pairs(spec, "add_columns"):
        if name.lower() in {c.lower() for c in df.columns}:
            continue
        lookup = name.replace(PARSED_MARKER, "").lower()
        dtype = types.get(lookup, StringType())
        col = F.lit(None) if value.strip() == NULL_LITERAL else F.expr(value)
        if holds_struct(dtype):  # by field name: the walk needs the expression's own type
            col = conform_value(col, df.select(col.alias("c")).schema["c"].dataType, dtype)
        df = df.withColumn(name.lower(), col.try_cast(dtype))
    return df


def rename_columns(df: DataFrame, spec: str | Sequence[tuple[str, str]]) -> DataFrame:
    """``new=oldOrExpr`` → column ``new`` from ``expr(old)``, then ``old`` dropped.

    When the right side is an expression the drop does nothing.  A rename
    that only changes case (or keeps the name) is done with
    ``withColumnRenamed`` so the column is not dropped by its own rename.
    """
    for new, old in parse_pairs(spec, "rename_columns"):
        new, old = new.strip(), old.strip()
        if new.lower() == old.lower() and old in df.columns:
            df = df.withColumnRenamed(old, new)
        else:
            df = df.withColumn(new, F.expr(old)).drop(old)
    return df


def drop_columns(df: DataFrame, spec: str | Iterable[str]) -> DataFrame:
    """Drop the listed names (lower-cased); absent names are ignored."""
    names = _split(spec, ENTRY_SEPARATOR) if isinstance(spec, str) else [str(s) for s in spec]
    return df.drop(*[n.lower() for n in names if n])


def conform(df: DataFrame, target_schema: StructType) -> DataFrame:
    """P5: every target column, cast to its type, in target order.

    Extra input columns are dropped; a missing one fails analysis.  Casts use
    ``try_cast`` so malformed text becomes NULL instead of failing the job.
    Nested types are conformed field by field, by name (see
    :func:`~tablewright.operators.nested.conform_value`).
    """
    present = {f.name.lower(): f.dataType for f in df.schema.fields}  # names resolve case-insensitively (Spark's default)
    missing = [f.name for f in target_schema.fields if f.name.lower() not in present]
    if missing:
        raise ProcessorError(f"input lacks target columns {missing}")
    return df.select(*[conform_value(F.col(f"`{f.name}`"), present[f.name.lower()], f.dataType).alias(f.name) for f in target_schema.fields])


def sync_with_table(
    df: DataFrame,
    target_schema: StructType,
    add: str | None = None,
    rename: str | None = None,
    drop: str | None = None,
) -> Conformed:
    """P2 → P3 → P4 → P5, returning both the conformed and the pre-select frame."""
    if add:
        df = add_columns(df, add, target_schema)
    if rename:
        df = rename_columns(df, rename)
    if drop:
        df = drop_columns(df, drop)
    return Conformed(conform(df, target_schema), df)


def with_literals(df: DataFrame, values: dict[str, object]) -> DataFrame:
    """Set each key column to a literal value, replacing an existing column."""
    return df.withColumns({k: F.lit(v) for k, v in values.items()})


def columns_first(df: DataFrame, first: Sequence[str], lower: bool = True) -> DataFrame:
    """The given columns first, then the rest; names lower-cased when asked."""
    norm = (lambda s: s.lower()) if lower else (lambda s: s)
    lead = [norm(c) for c in first]
    rest = [c for c in df.columns if norm(c) not in lead]
    return df.select(*[F.col(f"`{c}`").alias(norm(c)) for c in lead + rest])


def identify_columns(columns: Sequence[str], wanted: Sequence[tuple[str, bool]]) -> list[str]:
    """P10: for each ``(text, exact)``: exact → the name if present; otherwise
    every column whose name contains the text.  Order follows ``wanted``;
    repeats are kept."""
    out: list[str] = []
    for text, exact in wanted:
        if exact:
            if text in columns:
                out.append(text)
        else:
            out.extend(c for c in columns if text in c)
    return out


def select_matching(df: DataFrame, wanted: Sequence[tuple[str, bool]]) -> DataFrame:
    return df.select(*[F.col(f"`{c}`") for c in identify_columns(df.columns, wanted)])

