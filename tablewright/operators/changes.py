"""Row changes on a table's content (M1-M4): merge, update, delete, SCD2.

Each function maps the current content to the new content as one DataFrame
expression; :mod:`tablewright.sinks.versioned` writes that as a new version.

Merge plan (``target`` ⟕ ``updates`` plus ``updates`` ▷ ``target``):

* matched / unchanged target rows come from a LEFT OUTER join of the target
  with the updates.  With an equality in the condition Spark plans a hash or
  sort-merge join and broadcasts the updates only when their size estimate is
  under ``spark.sql.autoBroadcastJoinThreshold`` (AQE re-checks at runtime);
* inserts come from a LEFT ANTI join of the updates with the target, which
  reads only the target's key columns (column pruning).

A full outer join would shuffle every target column; this form shuffles the
full target at most once and lets a small update set go to a broadcast join.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.operators.keys import TARGET, UPDATES, inner_join_condition, merge_key_rows, parse_join_keys, update_key_columns

_HIT = "__tw_matched"


class MergeConflict(RuntimeError):
    """More than one update row matches the same target row."""


def _expr(e: str | Column) -> Column:
    return F.expr(e) if isinstance(e, str) else e


def _when_true(cond: str | Column | None) -> Column:
    """NULL counts as false: a row with an unknown condition is left alone."""
    if cond is None:
        return F.lit(False)
    return F.coalesce(_expr(cond), F.lit(False))


def nested_loops(df: DataFrame) -> int:
    """Joins in the physical plan of ``df`` that compare all pairs of rows (nothing runs)."""
    plan = df._jdf.queryExecution().sparkPlan().toString()
    return plan.count("NestedLoopJoin") + plan.count("CartesianProduct")


def _need_equality(target: DataFrame, updates: DataFrame, cond: Column) -> None:
    """Refuse a match without any equality: it compares all pairs, and its outer
    and anti joins broadcast the updates whole, whatever their size."""
    t, u = target.alias(TARGET), updates.alias(UPDATES)
    if nested_loops(t.join(u, cond, "left")) > nested_loops(target) + nested_loops(updates):
        raise ValueError("the merge condition has no equality, so it would compare all pairs of rows; add an equality, or "
                         "pass nested_loop=True when the updates are known to be small")


def _ensure_unique_matches(target: DataFrame, updates: DataFrame, cond: Column, keys: Sequence[str] | None) -> None:
    """Raise :class:`MergeConflict` when two updates match one target row.

    With equality ``keys`` only updates whose key is repeated (pre-aggregated)
    can conflict; without such, the target is not read.  For those the full
    condition decides: each is numbered, target rows are told apart by place
    or, in a frame without files, by a row number, and a target row that two
    updates match is a conflict.  Without keys all updates are looked at.
    """
    some = updates
    if keys and all(kp.op == "=" for kp in parse_join_keys(keys)):
        columns = update_key_columns(keys)
        names = [f"__tw_k{i}" for i in range(len(columns))]
        repeated = updates.groupBy(*[c.alias(n) for c, n in zip(columns, names)]).count().filter("count > 1").select(*names)
        if repeated.isEmpty():
            return  # no repeated key in the updates: the target need not be read
        on = None
        for c, n in zip(columns, names):
            on = c == F.col(n) if on is None else on & (c == F.col(n))
        some = updates.join(repeated, on, "left_semi")
    numbered = target.withColumn("__tw_row_id", F.monotonically_increasing_id())
    hits = numbered.alias(TARGET).join(some.alias(UPDATES), cond).groupBy(F.col(f"{TARGET}.__tw_row_id")).count().filter("count > 1")
    if not hits.isEmpty():
        raise MergeConflict("several update rows match the same target row; make the updates unique per key")


DELETED = "__tw_deleted"
UPDATED = "__tw_updated"


class MergeParts(NamedTuple):
    """A merge before its last step.

    ``marked`` has one row per target row: target columns with the update
    applied, boolean ``DELETED`` / ``UPDATED`` flags and the ``places``
    columns as they were; ``inserted`` holds the rows of unmatched updates.
    """

    marked: DataFrame
    inserted: DataFrame


def _named(sets: Mapping[str, str | Column], fields: Sequence, what: str) -> dict[str, str | Column]:
    """``sets`` with the target's own spelling of each column name."""
    own = {f.name.lower(): f.name for f in fields}
    unknown = sorted(k for k in sets if k.lower() not in own)
    if unknown:
        raise ValueError(f"{what} sets unknown columns {unknown}")
    return {own[k.lower()]: v for k, v in sets.items()}


def merge_parts(
    target: DataFrame,
    updates: DataFrame,
    condition: str | Column | None,
    *,
    delete_when: str | Column | None = None,
    update_when: str | Column | None = None,
    update_set: Mapping[str, str | Column] | None = None,
    insert_values: Mapping[str, str | Column] | None = None,
    keys: Sequence[str] | None = None,
    check_unique: bool = True,
    places: Sequence[str] = (),
    nested_loop: bool = False,
) -> MergeParts:
    """The two joins of :func:`merge`, with deleted / updated rows flagged.

    ``places`` names columns of ``target`` that say where a row is stored and
    are no columns of the table.
    """
    equi_keys = bool(keys) and all(kp.op == "=" for kp in parse_join_keys(keys))
    if condition is None:
        if not equi_keys:
            raise ValueError("a merge without a condition needs equality keys")
        cond = inner_join_condition(keys)
    else:
        cond = _expr(condition)
        if not nested_loop:
            _need_equality(target, updates, cond)
    if check_unique:
        _ensure_unique_matches(target, updates, cond, keys)

    t = target.alias(TARGET)
    u = updates.withColumn(_HIT, F.lit(True)).alias(UPDATES)
    fields = [f for f in target.schema.fields if f.name not in places]
    upd_cols = {c.lower() for c in updates.columns}

    missing = [f.name for f in fields if f.name.lower() not in upd_cols]
    for sets, what in ((update_set, "update-all"), (insert_values, "insert-all")):
        if sets is None and missing:
            raise ValueError(f"{what} needs update columns {missing}")
    every = {f.name: F.col(f"{UPDATES}.`{f.name}`") for f in fields}
    update_set = every if update_set is None else _named(update_set, fields, "merge")
    insert_values = every if insert_values is None else _named(insert_values, fields, "merge")

    joined = t.join(u, cond, "left")
    matched = F.col(f"{UPDATES}.{_HIT}").isNotNull()
    deleted = matched & _when_true(delete_when)
    updating = matched & ~deleted & (F.lit(True) if update_when is None else _when_true(update_when))
    marked = joined.select(
        *[
            (
                F.when(updating, _expr(update_set[f.name]).cast(f.dataType)).otherwise(F.col(f"{TARGET}.`{f.name}`"))
                if f.name in update_set
                else F.col(f"{TARGET}.`{f.name}`")
            ).alias(f.name)
            for f in fields
        ],
        deleted.alias(DELETED),
        updating.alias(UPDATED),
        *[F.col(f"{TARGET}.`{c}`") for c in places],
    )
    if condition is None:
        # Only the target's distinct keys are needed to find inserts; the
        # distinct is pre-aggregated map-side, so a key holding a third of
        # the target arrives as a handful of rows instead of one huge task.
        pairs = parse_join_keys(keys)
        known = target.select(*[F.col(f"`{kp.target}`").alias(f"__tw_t{i}") for i, kp in enumerate(pairs)]).distinct()
        on = None
        for i, kp in enumerate(pairs):
            term = F.col(f"{UPDATES}.`{kp.updates}`") == F.col(f"__tw_t{i}")
            on = term if on is None else on & term
        misses = u.join(known, on, "left_anti")
    else:
        # The rest of the condition decides too, so whole rows are compared; the
        # updates are the left side, whose hot keys AQE splits, and of the
        # target only the columns of the condition are read.
        misses = u.join(t, cond, "left_anti")
    inserted = misses.select(
        *[
            (_expr(insert_values[f.name]) if f.name in insert_values else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in fields
        ]
    )
    return MergeParts(marked, inserted)


def merge(
    target: DataFrame,
    updates: DataFrame,
    condition: str | Column | None,
    *,
    delete_when: str | Column | None = None,
    update_when: str | Column | None = None,
    update_set: Mapping[str, str | Column] | None = None,
    insert_values: Mapping[str, str | Column] | None = None,
    insert: bool = True,
    keys: Sequence[str] | None = None,
    check_unique: bool = True,
    nested_loop: bool = False,
) -> DataFrame:
    """M1: new content of ``target`` after merging ``updates``.

    Clause order: matched AND ``delete_when`` → delete; matched AND
    ``update_when`` (default true) → ``update_set`` (default: every target
    column from the same-named update column); not matched → insert
    ``insert_values`` (default: every target column by name; columns missing
    from the map become NULL).  Expressions see ``target.`` and ``updates.``.
    NULL conditions count as false.  Output has the target's schema.

    With ``condition=None`` the match is the equality of ``keys`` (J2 syntax,
    ``=`` only) and inserts are found against the target's distinct keys.
    A condition without any equality compares all pairs of rows and is refused
    unless ``nested_loop=True``: the caller then vouches for small updates.
    """
    marked, inserted = merge_parts(
        target, updates, condition, delete_when=delete_when, update_when=update_when, update_set=update_set,
        insert_values=insert_values, keys=keys, check_unique=check_unique, nested_loop=nested_loop,
    )
    kept = marked.filter(~F.col(DELETED)).drop(DELETED, UPDATED)
    return kept.unionByName(inserted) if insert else kept


def update_rows(df: DataFrame, condition: str | Column, set_values: Mapping[str, str | Column]) -> DataFrame:
    """M2: set columns where the condition is true; all sets read the old values.

    One projection; a NULL condition leaves the row unchanged.
    """
    cond = _when_true(condition)
    types = {f.name: f.dataType for f in df.schema.fields}
    set_values = _named(set_values, df.schema.fields, "update")
    return df.select(
        *[
            (F.when(cond, _expr(set_values[c]).cast(types[c])).otherwise(F.col(f"`{c}`")) if c in set_values else F.col(f"`{c}`")).alias(c)
            for c in df.columns
        ]
    )


def delete_rows(df: DataFrame, condition: str | Column) -> DataFrame:
    """M3: remove rows where the condition is true; NULL keeps the row."""
    return df.filter(~_when_true(condition))


class Scd2Stage(NamedTuple):
    """Staged update rows (J3) and the merge that applies them to the current rows."""

    staged: DataFrame
    condition: Column
    clauses: dict


def scd2_stage(
    history: DataFrame,
    updates: DataFrame,
    key: str,
    compare: Sequence[str],
    *,
    current_flag: str = "is_current",
    valid_from: str = "valid_from",
    valid_to: str = "valid_to",
    load_date: str | Column,
) -> Scd2Stage:
    """M4 up to its merge: every update keyed by its merge key, plus the changed ones without key (they insert)."""
    repeated = updates.groupBy(F.col(f"`{key}`")).count().where((F.col("count") > 1) & F.col(f"`{key}`").isNotNull())
    if not repeated.isEmpty():
        raise MergeConflict(f"several updates of one {key} in a load; stitch_history takes them with the moment each holds from")
    load = _expr(load_date)
    differs = None
    for c in compare:
        term = ~F.col(f"{UPDATES}.`{c}`").eqNullSafe(F.col(f"{TARGET}.`{c}`"))
        differs = term if differs is None else differs | term
    current = history.filter(_when_true(F.col(f"`{current_flag}`")))
    same_key = F.col(f"{UPDATES}.`{key}`") == F.col(f"{TARGET}.`{key}`")
    changed = updates.alias(UPDATES).join(current.alias(TARGET), same_key & differs, "left_semi")
    insert_values: dict[str, Column] = {c: F.col(f"{UPDATES}.`{c}`") for c in updates.columns}
    insert_values |= {current_flag: F.lit(True), valid_from: load, valid_to: F.lit(None)}
    return Scd2Stage(
        merge_key_rows(updates, changed, [key]),
        F.col(f"{TARGET}.`{key}`") == F.col(f"{UPDATES}.mergekey0"),
        {"update_when": differs, "update_set": {current_flag: F.lit(False), valid_to: load}, "insert_values": insert_values,
         "keys": [f"{key} = mergekey0"]},
    )


def scd2_changes(current: DataFrame, updates: DataFrame, key: str, compare: Sequence[str], *, current_flag: str = "is_current",
                 **kwargs) -> DataFrame:
    """M4: slowly-changing dimension, type 2, as J3 staging + :func:`merge`.

    ``current`` holds history rows (``key``, attributes, ``current_flag``,
    ``valid_from``, ``valid_to``); ``updates`` holds ``key`` and attributes.
    A key whose current row differs in any ``compare`` column gets that row
    closed (flag false, ``valid_to`` = load date) and a new current row; a new
    key gets a current row; unchanged keys are left as they are.  Only current
    rows are joined.  One load holds one update of a key; for several changes,
    or late ones, see :func:`tablewright.operators.history.stitch_history`.
    """
    stage = scd2_stage(current, updates, key, compare, current_flag=current_flag, **kwargs)
    is_current = _when_true(F.col(f"`{current_flag}`"))
    return merge(current.filter(is_current), stage.staged, stage.condition, **stage.clauses).unionByName(current.filter(~is_current))
