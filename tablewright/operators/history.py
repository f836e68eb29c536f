"""History of slowly-changing dimensions by interval stitching (M4).

:func:`stitch_history` takes any number of changes of a key in one load, late
ones too.  History rows and changes become events on each key's time line; of
events at one moment the last counts, an event that changes nothing goes, and
each one that is left is valid until the next.  So a key has at most one
current row and its rows never overlap, whatever the load holds.

A key with more than a thousandth of all events (and many) is cut into slices of its time
line at quantiles, so no task holds a hot key whole.  Windows run within
slices; what an event needs of the slices before or after it (one state, one
moment) comes from a table of one row per slice.  Rows of keys without a change
pass through unread by any window.

:func:`apply_change_set` is the type 4 form: a current and a history table that
take the same change set, with the same result however often it is applied.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, NumericType, TimestampNTZType, TimestampType

HOT_SHARE = 1000  # a key with more than 1/HOT_SHARE of all events and HOT_ROWS is sliced; there are fewer such keys than HOT_SHARE
HOT_ROWS = 100_000
SLICES = 256


def _same(left: str, right: str, names: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"{left}.{n}").eqNullSafe(F.col(f"{right}.{n}")) for n in names])


def _key_names(keys: Sequence[str]) -> list[str]:
    return [f"__tw_k{i}" for i in range(len(keys))]


def _hot_keys(spots: DataFrame, names: list[str], hot_share: int, hot_rows: int) -> DataFrame | None:
    """Keys with more than ``hot_rows`` events and a share above ``1/hot_share``; None without any.  Reads key columns only."""
    counts = spots.groupBy(*names).agg(F.count(F.lit(1)).alias("n"))
    least = F.greatest(counts.agg(F.sum("n") / hot_share).scalar(), F.lit(float(hot_rows)))
    rows = counts.where(F.col("n") > least).select(*names).collect()  # fewer than hot_share keys, whatever the input
    return counts.sparkSession.createDataFrame(rows, counts.select(*names).schema) if rows else None


def _sliced(events: DataFrame, names: list[str], hot: DataFrame, slices: int) -> DataFrame:
    """``events`` with ``__tw_slice``: 0, or for hot keys the number of their cut points up to the event."""
    kind = events.schema["__tw_at"].dataType
    at = F.col("__tw_at") if isinstance(kind, NumericType) else F.col("__tw_at").cast("timestamp")
    fractions = [i / slices for i in range(1, slices)]
    cuts = events.alias("e").join(F.broadcast(hot.alias("h")), _same("e", "h", names), "left_semi").groupBy(*names).agg(
        F.percentile_approx(at, fractions, 10 * slices).alias("__tw_cuts"))
    marked = events.alias("e").join(F.broadcast(cuts.alias("c")), _same("e", "c", names), "left")  # fewer than hot_share rows
    number = F.size(F.filter("c.__tw_cuts", lambda c: c <= at))
    return marked.select("e.*", F.when(F.col("c.__tw_cuts").isNull(), F.lit(0)).otherwise(number).alias("__tw_slice"))


def _stitched(events: DataFrame, names: list[str], compare: Sequence[str], hot: DataFrame | None, slices: int) -> DataFrame:
    """Versions ``keys, __tw_state, __tw_at, __tw_next`` from events ``keys, __tw_at, __tw_rank, __tw_state``.

    A null state ends the version before it.  Without hot keys each key is one slice.
    """
    one = events.groupBy(*names, "__tw_at").agg(
        F.max_by(F.struct(F.col("__tw_state").alias("s")), "__tw_rank").getField("s").alias("__tw_state"))
    seen = F.struct(F.col("__tw_state").isNotNull().alias("there"), *[F.col("__tw_state").getField(c).alias(f"v{i}") for i, c in enumerate(compare)])
    cut = (one if hot is None else _sliced(one, names, hot, slices)).withColumn("__tw_seen", seen)
    slice_of = names if hot is None else [*names, "__tw_slice"]
    within = Window.partitionBy(*slice_of).orderBy("__tw_at")
    across = Window.partitionBy(*names).orderBy("__tw_slice")

    # the state before each event: the row before, or the last state of the slices before
    previous = F.lag("__tw_seen").over(within)
    if hot is not None:
        last = cut.groupBy(*slice_of).agg(F.max_by("__tw_seen", "__tw_at").alias("last"))
        before = last.select(*slice_of, F.lag("last").over(across).alias("__tw_before")).where("__tw_before IS NOT NULL")
        cut = cut.alias("e").join(before.alias("b"), _same("e", "b", slice_of), "left").select("e.*", "b.__tw_before")
        previous = F.coalesce(previous, F.col("__tw_before"))
    nothing = F.when(previous.isNull(), ~F.col("__tw_seen.there")).otherwise(previous.eqNullSafe(F.col("__tw_seen")))
    kept = cut.withColumn("__tw_same", nothing).where(~F.col("__tw_same")).drop("__tw_before")

    # valid until the next event that is left: the row after, or the first moment of the slices after
    until = F.lead("__tw_at").over(within)
    if hot is not None:
        first = kept.groupBy(*slice_of).agg(F.min("__tw_at").alias("first"))
        after = first.select(*slice_of, F.lead("first").over(across).alias("__tw_after")).where("__tw_after IS NOT NULL")
        kept = kept.alias("e").join(after.alias("a"), _same("e", "a", slice_of), "left").select("e.*", "a.__tw_after")
        until = F.coalesce(until, F.col("__tw_after"))
    return kept.withColumn("__tw_next", until).where("__tw_state IS NOT NULL")


def stitch_history(
    history: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    compare: Sequence[str],
    *,
    effective: str,
    sequence: str | None = None,
    delete_when: str | Column | None = None,
    current_flag: str = "is_current",
    valid_from: str = "valid_from",
    valid_to: str = "valid_to",
    hot_share: int = HOT_SHARE,
    hot_rows: int = HOT_ROWS,
    slices: int = SLICES,
) -> DataFrame:
    """M4 for any number of changes per key: the new content of ``history``, with its columns.

    ``changes`` holds ``keys``, the other columns of ``history`` (missing ones
    become null) and ``effective``, the moment from which a change holds (of
    the type of ``valid_from``: number, date or timestamp; null is an error).
    Of changes of a key at one moment the largest ``sequence`` counts (without
    it, the largest row in column order), and it replaces a version that starts
    then.  A change equal to the version before it in all ``compare`` columns
    (null equals null) is no change.  A late change cuts the version it falls
    into.  ``delete_when`` (over the changes) ends the key's version without
    starting one.  Gaps in a history stay gaps; a version of a changed key that
    ends when it starts holds at no moment and goes.  Repeated rows change nothing;
    null keys are one key; without changes ``history`` is returned as it is.
    """
    names = _key_names(keys)
    rest = [c for c in history.columns if c not in {*keys, current_flag, valid_from, valid_to}]
    unknown = [c for c in compare if c not in rest]
    if unknown:
        raise ValueError(f"compare columns {unknown} are no attributes of the history")
    kind = history.schema[valid_from].dataType
    if not isinstance(kind, (NumericType, DateType, TimestampType, TimestampNTZType)):
        raise ValueError(f"{valid_from} must be a number, date or timestamp, not {kind.simpleString()}")
    key_of = [F.col(f"`{k}`").cast(history.schema[k].dataType).alias(n) for k, n in zip(keys, names)]

    def state(df: DataFrame) -> Column:
        own = set(df.columns)
        return F.struct(*[(F.col(f"`{c}`") if c in own else F.lit(None)).cast(history.schema[c].dataType).alias(c) for c in rest])

    at = F.col(f"`{effective}`").cast(kind)
    gone = F.lit(False) if delete_when is None else F.coalesce(F.expr(delete_when) if isinstance(delete_when, str) else delete_when, F.lit(False))
    order = F.col(f"`{sequence}`") if sequence else F.struct(*[F.col(f"`{c}`") for c in changes.columns if c in rest])
    told = changes.select(
        *key_of, F.when(at.isNull(), F.raise_error(F.lit(f"a change has no {effective}")).cast(kind)).otherwise(at).alias("__tw_at"),
        F.lit(2).alias("__tw_class"), order.alias("__tw_order"), F.when(~gone, state(changes)).alias("__tw_state"))
    # of several changes at one moment the last one, by a partial aggregate
    told = told.groupBy(*names, "__tw_at").agg(F.max_by(F.struct("__tw_class", F.col("__tw_state").alias("s")), F.struct("__tw_order")).alias("x")).select(
        *names, "__tw_at", F.col("x.__tw_class").alias("__tw_rank"), F.col("x.s").alias("__tw_state"))

    touched = told.select(*names).distinct()
    own = history.select("*", *key_of)
    mine = own.alias("h").join(touched.alias("t"), _same("h", "t", names), "left_semi")
    other = own.alias("h").join(touched.alias("t"), _same("h", "t", names), "left_anti").drop(*names)
    mine = mine.where(F.col(f"`{valid_to}`").isNull() | (F.col(f"`{valid_from}`") < F.col(f"`{valid_to}`").cast(kind)))
    starts = mine.select(*names, F.col(f"`{valid_from}`").alias("__tw_at"), F.lit(1).alias("__tw_rank"), state(history).alias("__tw_state"))
    # an end that no start follows at once is a gap, or the key's end; a start at the same moment outranks it
    ends = mine.where(F.col(f"`{valid_to}`").isNotNull()).select(
        *names, F.col(f"`{valid_to}`").cast(kind).alias("__tw_at"), F.lit(0).alias("__tw_rank"), F.lit(None).cast(starts.schema["__tw_state"].dataType).alias("__tw_state"))
    hot = _hot_keys(changes.select(*key_of).unionAll(mine.select(*names)), names, hot_share, hot_rows)
    made = _stitched(starts.unionByName(ends).unionByName(told), names, compare, hot, slices)
    values = {k: F.col(n) for k, n in zip(keys, names)} | {c: F.col("__tw_state").getField(c) for c in rest} | {
        current_flag: F.col("__tw_next").isNull(), valid_from: F.col("__tw_at"), valid_to: F.col("__tw_next")}
    return other.unionByName(made.select(*[values[c].cast(history.schema[c].dataType).alias(c) for c in history.columns]))


class Dimension4(NamedTuple):
    """Content of the two tables of a type 4 dimension."""

    current: DataFrame
    history: DataFrame


def apply_change_set(
    current: DataFrame,
    history: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    compare: Sequence[str],
    *,
    effective: str,
    sequence: str | None = None,
    delete_when: str | Column | None = None,
    valid_from: str = "valid_from",
    valid_to: str = "valid_to",
    hot_share: int = HOT_SHARE,
    hot_rows: int = HOT_ROWS,
    slices: int = SLICES,
) -> Dimension4:
    """M4 as type 4: ``current`` has a key's newest row with ``valid_from``, ``history`` its closed rows with both ends.

    Both are stitched with ``changes`` as one time line, then parted again, so
    they agree with each other, a key is current once, and the same change set
    applied to both results changes nothing.  The change set should be stored
    before: both results read it.  Rules for ties, late rows, nulls and
    deletions are those of :func:`stitch_history`.
    """
    both = history.select(*history.columns, F.lit(False).alias("__tw_current")).unionByName(
        current.select(*[c for c in history.columns if c != valid_to], F.lit(None).cast(history.schema[valid_to].dataType).alias(valid_to),
                       F.lit(True).alias("__tw_current")))
    done = stitch_history(both, changes, keys, compare, effective=effective, sequence=sequence, delete_when=delete_when,
                          current_flag="__tw_current", valid_from=valid_from, valid_to=valid_to, hot_share=hot_share, hot_rows=hot_rows, slices=slices)
    return Dimension4(done.where(F.col("__tw_current")).select(*current.columns), done.where(~F.col("__tw_current")).select(*history.columns))
