import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tablewright.operators import changes as M

SCHEMA = "k int, v int, s string"


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_merge_upsert_and_delete_order(spark):
    t = spark.createDataFrame([(1, 10, "a"), (2, 20, "b"), (3, 30, "c")], SCHEMA)
    u = spark.createDataFrame([(2, -1, "B"), (3, 33, "C"), (4, 40, "D")], SCHEMA)
    out = M.merge(t, u, "target.k = updates.k", delete_when="updates.v < 0", keys=["k"])
    assert _rows(out) == [(1, 10, "a"), (3, 33, "C"), (4, 40, "D")]


def test_merge_update_when_and_exprs(spark):
    t = spark.createDataFrame([(1, 10, "a"), (2, 20, "b")], SCHEMA)
    u = spark.createDataFrame([(1, 5, "x"), (2, 50, "y"), (9, 90, "z")], SCHEMA)
    out = M.merge(
        t, u, "target.k = updates.k",
        update_when="updates.v > target.v",
        update_set={"v": "target.v + updates.v"},
        insert_values={"k": "updates.k", "s": "upper(updates.s)"},
        keys=["k"],
    )
    assert _rows(out) == [(1, 10, "a"), (2, 70, "b"), (9, None, "Z")]


def test_merge_null_key_inserts(spark):
    t = spark.createDataFrame([(1, 10, "a")], SCHEMA)
    u = spark.createDataFrame([(None, 5, "n"), (1, 11, "a2")], SCHEMA)
    got = M.merge(t, u, "target.k = updates.k", keys=["k"]).collect()
    assert sorted((r.k is None, r.v) for r in got) == [(False, 11), (True, 5)]


def test_merge_duplicate_updates_raise(spark):
    t = spark.createDataFrame([(1, 10, "a")], SCHEMA)
    u = spark.createDataFrame([(1, 1, "x"), (1, 2, "y")], SCHEMA)
    with pytest.raises(M.MergeConflict):
        M.merge(t, u, "target.k = updates.k", keys=["k"])
    with pytest.raises(M.MergeConflict):
        M.merge(t, u, "target.k = updates.k")  # no keys: grouped by target row


def test_merge_duplicates_not_matching_target_are_inserted(spark):
    t = spark.createDataFrame([(1, 10, "a")], SCHEMA)
    u = spark.createDataFrame([(5, 1, "x"), (5, 2, "y")], SCHEMA)
    assert len(M.merge(t, u, "target.k = updates.k", keys=["k"]).collect()) == 3


def test_merge_unknown_column(spark):
    t = spark.createDataFrame([(1, 10, "a")], SCHEMA)
    with pytest.raises(ValueError):
        M.merge(t, t, "target.k = updates.k", update_set={"nope": "1"}, check_unique=False)


def test_update_reads_old_values_and_null_condition(spark):
    df = spark.createDataFrame([(1, 10, "a"), (2, None, "b")], SCHEMA)
    out = M.update_rows(df, "v > 5", {"v": "v + 1", "s": "CAST(v AS STRING)"})
    assert _rows(out) == sorted([(1, 11, "10"), (2, None, "b")], key=str)


def test_delete_null_condition_keeps(spark):
    df = spark.createDataFrame([(1, 10, "a"), (2, None, "b"), (3, 1, "c")], SCHEMA)
    assert [r.k for r in M.delete_rows(df, "v > 5").orderBy("k").collect()] == [2, 3]


def test_scd2_changes(spark):
    cur = spark.createDataFrame(
        [(1, "a", True, "2024-01-01", None), (1, "old", False, "2023-01-01", "2024-01-01"), (2, "b", True, "2024-01-01", None)],
        "k int, attr string, is_current boolean, valid_from string, valid_to string",
    )
    upd = spark.createDataFrame([(1, "a2"), (2, "b"), (3, "c")], "k int, attr string")
    out = M.scd2_changes(cur, upd, "k", ["attr"], load_date=F.lit("2024-02-01"))
    got = sorted((r.k, r.attr, r.is_current, r.valid_from, r.valid_to) for r in out.collect())
    assert got == [
        (1, "a", False, "2024-01-01", "2024-02-01"),
        (1, "a2", True, "2024-02-01", None),
        (1, "old", False, "2023-01-01", "2024-01-01"),
        (2, "b", True, "2024-01-01", None),
        (3, "c", True, "2024-02-01", None),
    ]


keyed_rows = st.dictionaries(st.integers(0, 12), st.integers(-5, 5), max_size=10)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(target=keyed_rows, updates=keyed_rows)
def test_merge_matches_dict_model(spark, target, updates):
    """Property: merge == dict model (delete matched rows whose new value < 0)."""
    t = spark.createDataFrame([(k, v, "t") for k, v in target.items()], SCHEMA)
    u = spark.createDataFrame([(k, v, "u") for k, v in updates.items()], SCHEMA)
    model = {k: (v, "t") for k, v in target.items()}
    for k, v in updates.items():
        if k in model and v < 0:
            del model[k]
        else:
            model[k] = (v, "u")
    got = M.merge(t, u, "target.k = updates.k", delete_when="updates.v < 0", keys=["k"])
    assert _rows(got) == sorted((k, v, s) for k, (v, s) in model.items())


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=keyed_rows)
def test_update_then_delete_keeps_untouched(spark, rows):
    df = spark.createDataFrame([(k, v, "x") for k, v in rows.items()], SCHEMA)
    out = M.delete_rows(M.update_rows(df, "v > 0", {"s": "'pos'"}), "v > 3")
    untouched = {(k, v, "x") for k, v in rows.items() if v <= 0}
    assert untouched <= set(_rows(out))


def test_merge_on_keys_equals_condition(spark):
    t = spark.createDataFrame([(1, 10, "a"), (1, 11, "hot"), (2, 20, "b")], SCHEMA)
    u = spark.createDataFrame([(2, 21, "B"), (3, 30, "C"), (None, 0, "n")], SCHEMA)
    by_cond = M.merge(t, u, "target.k = updates.k", keys=["k"])
    by_keys = M.merge(t, u, None, keys=["k"])
    assert sorted(map(str, by_cond.collect())) == sorted(map(str, by_keys.collect()))
    assert len(by_keys.collect()) == 5
    with pytest.raises(ValueError):
        M.merge(t, u, None, keys=["k >= k"])
    with pytest.raises(ValueError):
        M.merge(t, u, None)
