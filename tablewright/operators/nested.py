"""Conforming values to a target type, nested types by field name.

A cast of a struct goes by position in Spark, so ``{b: 1, a: 2}`` cast to
``(a, b)`` swaps the values.  Here a recursive walk over both types rebuilds
structs, structs in arrays and structs in map keys or values field by field,
names compared without case; a type that holds no struct is cast whole.  All of
it is one projection.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType


class NestedMismatch(ValueError):
    """A nested value can't take the target's type."""


def holds_struct(kind: DataType) -> bool:
    if isinstance(kind, StructType):
        return True
    if isinstance(kind, ArrayType):
        return holds_struct(kind.elementType)
    if isinstance(kind, MapType):
        return holds_struct(kind.keyType) or holds_struct(kind.valueType)
    return False


def _fields(have: StructType) -> dict:
    own: dict = {}
    for f in have.fields:
        if f.name.lower() in own:
            raise NestedMismatch(f"fields {own[f.name.lower()].name!r} and {f.name!r} differ in case only")
        own[f.name.lower()] = f
    return own


def conform_value(value: Column, have: DataType, want: DataType) -> Column:
    """``value`` of type ``have`` as type ``want``.

    Struct fields are matched by name without case: extra ones go, missing ones
    are null, order is the target's.  A null struct, array or map stays null.
    Other types are cast with ``try_cast``: malformed values become null.
    """
    if not holds_struct(want):
        return value.try_cast(want)
    if isinstance(want, StructType) and isinstance(have, StructType):
        own = _fields(have)
        parts = []
        for f in want.fields:
            source = own.get(f.name.lower())
            part = F.lit(None).cast(f.dataType) if source is None else conform_value(value.getField(source.name), source.dataType, f.dataType)
            parts.append(part.alias(f.name))
        return F.when(value.isNotNull(), F.struct(*parts))
    if isinstance(want, ArrayType) and isinstance(have, ArrayType):
        return F.transform(value, lambda x: conform_value(x, have.elementType, want.elementType))
    if isinstance(want, MapType) and isinstance(have, MapType):
        out = value
        if have.keyType != want.keyType:
            out = F.transform_keys(out, lambda k, _: conform_value(k, have.keyType, want.keyType))
        return F.transform_values(out, lambda _, v: conform_value(v, have.valueType, want.valueType))
    if have.typeName() == "void":
        return value.cast(want)
    raise NestedMismatch(f"{have.simpleString()} can't become {want.simpleString()}")


def lost_in_conform(value: Column, have: DataType, want: DataType) -> Column:
    """True where a part of ``value`` that the target takes is not null and becomes null by its cast."""
    if isinstance(want, StructType) and isinstance(have, StructType):
        own = _fields(have)
        out = F.lit(False)
        for f in want.fields:
            source = own.get(f.name.lower())
            if source is not None:
                out = out | lost_in_conform(value.getField(source.name), source.dataType, f.dataType)
        return value.isNotNull() & out
    if isinstance(want, ArrayType) and isinstance(have, ArrayType):
        return F.coalesce(F.exists(value, lambda x: lost_in_conform(x, have.elementType, want.elementType)), F.lit(False))
    if isinstance(want, MapType) and isinstance(have, MapType):
        return F.coalesce(F.exists(F.map_values(value), lambda x: lost_in_conform(x, have.valueType, want.valueType)), F.lit(False))
    if have == want or have.typeName() == "void":
        return F.lit(False)
    return value.isNotNull() & value.try_cast(want).isNull()
