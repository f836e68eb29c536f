"""Join-key handling (J2-J5): condition builders for ``target`` / ``updates``
joins, the SCD2 merge-key staging and partition pruning of a merge target.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values that must equal the reference behaviour:
#   alias of the changed table: "target"; alias of the incoming rows: "updates"
#   comparison operators allowed in a key: <  <=  =  >=  >  !=
#   staged merge-key column names: mergekey0, mergekey1, ...
TARGET = "target"
UPDATES = "updates"
OPERATORS = ("<", "<=", "=", ">=", ">", "!=")
MERGE_KEY_PREFIX = "mergekey"


@dataclass(frozen=True)
class KeyPair:
    target: str
    op: str
    updates: str


def parse_join_keys(keys: Sequence[str]) -> list[KeyPair]:
    """``"id"`` → ``id = id``; ``"a op b"`` → target ``a`` op updates ``b``."""
    out = []
    for k in keys:
        parts = k.split()
        if len(parts) == 1:
            out.append(KeyPair(parts[0], "=", parts[0]))
        elif len(parts) == 3 and parts[1] in OPERATORS:
            out.append(KeyPair(parts[0], parts[1], parts[2]))
        else:
            raise ValueError(f"join key {k!r} must be 'col' or 'col OP col' with OP in {OPERATORS}")
    if not out:
        raise ValueError("at least one join key is needed")
    return out


def _compare(left: Column, op: str, right: Column) -> Column:
    if op == "<":
        return left < right
    if op == "<=":
        return left <= right
    if op == "=":
        return left == right
    if op == ">=":
        return left >= right
    if op == ">":
        return left > right
    return left != right


def inner_join_condition(
    keys: Sequence[str], extra: str | Column | None = None, left: str = TARGET, right: str = UPDATES
) -> Column:
    """AND of ``left.a OP right.b`` for every key, plus an extra condition.

    Equality terms let Spark plan a hash or sort-merge join; a condition with
    only range terms can only run as a nested-loop join, so keep one equality
    in it for large inputs.
    """
    cond = None
    for kp in parse_join_keys(keys):
        term = _compare(F.col(f"{left}.`{kp.target}`"), kp.op, F.col(f"{right}.`{kp.updates}`"))
        cond = term if cond is None else cond & term
    if extra is not None:
        cond = cond & (F.expr(extra) if isinstance(extra, str) else extra)
    return cond


def theta_join(target: DataFrame, updates: DataFrame, keys: Sequence[str], extra: str | Column | None = None,
               how: str = "inner", nested_loop: bool = False) -> DataFrame:
    """Join ``target`` and ``updates`` (aliased) on :func:`inner_join_condition`.

    Keys without any equality compare all pairs of rows.  That needs
    ``nested_loop=True``, by which the caller says that one side is small (a
    dimension table); no size is guessed here.
    """
    if not nested_loop and all(kp.op != "=" for kp in parse_join_keys(keys)):
        raise ValueError("a join without an equality key compares all pairs of rows; pass nested_loop=True when one side is small")
    return target.alias(TARGET).join(updates.alias(UPDATES), inner_join_condition(keys, extra), how)


@dataclass(frozen=True)
class MergeKeySelects:
    """J3 output: the two staging select-lists and the merge condition."""

    unmatched_select: list[str]
    keyed_select: list[str]
    condition: str


def merge_key_selects(keys: Sequence[str], extra: str | None = None) -> MergeKeySelects:
    """``NULL AS mergekey{i}, *`` / ``<updates key> AS mergekey{i}, *`` and
    ``target.<key> = updates.mergekey{i} AND ... [AND extra]``.

    Operators inside ``keys`` are ignored here: merge keys always compare with ``=``.
    """
    pairs = parse_join_keys(keys)
    unmatched = [f"NULL AS {MERGE_KEY_PREFIX}{i}" for i, _ in enumerate(pairs)]
    keyed = [f"`{kp.updates}` AS {MERGE_KEY_PREFIX}{i}" for i, kp in enumerate(pairs)]
    terms = [f"{TARGET}.`{kp.target}` = {UPDATES}.{MERGE_KEY_PREFIX}{i}" for i, kp in enumerate(pairs)]
    if extra:
        terms.append(extra)
    return MergeKeySelects(unmatched + ["*"], keyed + ["*"], " AND ".join(terms))


def merge_key_rows(updates: DataFrame, changed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Stage SCD2 rows: every update keyed by its merge key (matches the
    current target row and closes it) plus ``changed`` rows with NULL keys
    (match nothing, so they insert the new current row)."""
    pairs = parse_join_keys(keys)
    keyed = updates.select(*[F.col(f"`{kp.updates}`").alias(f"{MERGE_KEY_PREFIX}{i}") for i, kp in enumerate(pairs)], "*")
    key_types = {f.name: f.dataType for f in keyed.schema.fields}
    unmatched = changed.select(
        *[F.lit(None).cast(key_types[f"{MERGE_KEY_PREFIX}{i}"]).alias(f"{MERGE_KEY_PREFIX}{i}") for i, _ in enumerate(pairs)],
        *[F.col(f"`{c}`") for c in updates.columns],
    )
    return keyed.unionByName(unmatched)


def update_key_columns(keys: Sequence[str]) -> list[Column]:
    """The updates-side columns of the keys."""
    return [F.col(f"`{kp.updates}`") for kp in parse_join_keys(keys)]


def prune_target(target: DataFrame, updates: DataFrame, partition_keys: Sequence[str]) -> DataFrame:
    """Keep target rows whose value of every key occurs among the updates.

    Each key is matched on its own (``k1 IN (...) AND k2 IN (...)``) through a
    ``left_semi`` join against the distinct update values, which Spark
    pre-aggregates map-side and, for a partitioned target, turns into dynamic
    partition pruning.  NULL values match nothing.  Nothing is collected.
    """
    out = target
    for k in partition_keys:
        values = updates.select(F.col(f"`{k}`").alias("__tw_key")).distinct()
        out = out.join(values, F.col(f"`{k}`") == F.col("__tw_key"), "left_semi")
    return out
