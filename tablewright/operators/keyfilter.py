"""A fixed-size filter of update keys that prunes a merge target before its shuffle.

The filter is a bitmap of key hashes, kept as rows ``(word, bits)`` of 64 bits:
at most ``bits / 64`` rows whatever the number of updates, so it can be
broadcast.  Target rows whose bit is unset match no update for certain; they go
to the result as they are and take no part in the merge's joins.  A set bit may
be another key's: such rows are merged as usual, so the result never depends
on the filter.  Filters of several loads are merged by OR.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tablewright.operators import changes
from tablewright.operators.keys import parse_join_keys

BITS = 1 << 24  # 262,144 rows of 16 bytes at most


def _bit(keys: Sequence[Column], bits: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(bits).cast("long"))


def key_filter(updates: DataFrame, target: DataFrame, keys: Sequence[str], bits: int = BITS) -> DataFrame:
    """``word, bits``: the keys of ``updates``, hashed as values of the target's types.

    Keys with a null match nothing and are left out.  A key that is text on one
    side only is an error: its equality is not that of the texts.
    """
    if bits < 64 or bits % 64:
        raise ValueError("bits must be a multiple of 64")
    columns = []
    for kp in parse_join_keys(keys):
        if kp.op != "=":
            raise ValueError("a key filter needs equality keys")
        want, have = target.schema[kp.target].dataType, updates.schema[kp.updates].dataType
        if isinstance(want, StringType) != isinstance(have, StringType):
            raise ValueError(f"key {kp.target!r} is text on one side only")
        columns.append(F.col(f"`{kp.updates}`").try_cast(want))
    there = columns[0].isNotNull()
    for c in columns[1:]:
        there = there & c.isNotNull()
    return _filled(updates.where(there).select(_bit(columns, bits).alias("bit")).select(
        F.expr("bit div 64").alias("word"), F.expr("shiftleft(1L, cast(bit % 64 AS int))").alias("bits")))


def _filled(rows: DataFrame) -> DataFrame:
    return rows.groupBy("word").agg(F.bit_or("bits").alias("bits"))


def merge_filters(*filters: DataFrame) -> DataFrame:
    """The filter of all keys of ``filters`` (of one size)."""
    out = filters[0]
    for f in filters[1:]:
        out = out.unionByName(f)
    return _filled(out)


def _looked_up(target: DataFrame, found: DataFrame, keys: Sequence[str], bits: int) -> tuple[DataFrame, Column]:
    columns = [F.col(f"`{kp.target}`") for kp in parse_join_keys(keys)]
    marked = target.withColumn("__tw_bit", _bit(columns, bits))
    held = found.select(F.col("word").alias("__tw_word"), F.col("bits").alias("__tw_bits"))
    # at most bits / 64 rows
    joined = marked.join(F.broadcast(held), F.expr("__tw_bit div 64") == F.col("__tw_word"), "left")
    return joined, F.coalesce(F.expr("bit_get(__tw_bits, cast(__tw_bit % 64 AS int)) = 1"), F.lit(False))


def prune_by_key_filter(target: DataFrame, found: DataFrame, keys: Sequence[str], bits: int = BITS) -> DataFrame:
    """Rows of ``target`` whose key may be among the updates (false positives only); no shuffle."""
    joined, hit = _looked_up(target, found, keys, bits)
    return joined.where(hit).select(*[F.col(f"`{c}`") for c in target.columns])


def beyond_key_filter(target: DataFrame, found: DataFrame, keys: Sequence[str], bits: int = BITS) -> DataFrame:
    """The other rows of ``target``: those that match no update for certain, null keys among them unless their bit is set."""
    joined, hit = _looked_up(target, found, keys, bits)
    return joined.where(~hit).select(*[F.col(f"`{c}`") for c in target.columns])


def merge_with_key_filter(target: DataFrame, updates: DataFrame, keys: Sequence[str], *, bits: int = BITS, **clauses) -> DataFrame:
    """M1 on equality ``keys``, with only those target rows in its joins that the updates' key filter lets through.

    ``clauses`` are those of :func:`tablewright.operators.changes.merge`.  The
    result is that of the plain merge.  ``target`` is read twice, narrow passes
    without a shuffle; worth it where the updates reach a small part of it.
    """
    found = key_filter(updates, target, keys, bits)
    merged = changes.merge(prune_by_key_filter(target, found, keys, bits), updates, None, keys=keys, **clauses)
    return merged.unionByName(beyond_key_filter(target, found, keys, bits))
