import pytest

from tablewright.operators import keys as K


def test_parse_join_keys():
    assert K.parse_join_keys(["id", "a != b"]) == [K.KeyPair("id", "=", "id"), K.KeyPair("a", "!=", "b")]
    for bad in (["a ~ b"], ["a b"], []):
        with pytest.raises(ValueError):
            K.parse_join_keys(bad)


def test_inner_join_condition_all_operators(spark):
    t = spark.createDataFrame([(1,), (2,), (3,)], "x int")
    u = spark.createDataFrame([(2,)], "y int")
    for op, expect in (("<", [1]), ("<=", [1, 2]), ("=", [2]), (">=", [2, 3]), (">", [3]), ("!=", [1, 3])):
        got = sorted(r[0] for r in K.theta_join(t, u, [f"x {op} y"], nested_loop=True).select("target.x").collect())
        assert got == expect, op


def test_extra_condition(spark):
    t = spark.createDataFrame([(1, "a"), (1, "b")], "id int, v string")
    u = spark.createDataFrame([(1,)], "id int")
    out = K.theta_join(t, u, ["id"], "target.v = 'b'")
    assert [r.v for r in out.select("target.v").collect()] == ["b"]


def test_merge_key_selects_text():
    m = K.merge_key_selects(["id", "a >= b"], "target.cur = true")
    assert m.unmatched_select == ["NULL AS mergekey0", "NULL AS mergekey1", "*"]
    assert m.keyed_select == ["`id` AS mergekey0", "`b` AS mergekey1", "*"]
    assert m.condition == "target.`id` = updates.mergekey0 AND target.`a` = updates.mergekey1 AND target.cur = true"


def test_merge_key_selects_usable(spark):
    u = spark.createDataFrame([(1, "x")], "id int, v string")
    m = K.merge_key_selects(["id"])
    staged = u.selectExpr(*m.unmatched_select).unionByName(u.selectExpr(*m.keyed_select))
    assert sorted((r.mergekey0, r.id) for r in staged.collect() if r.mergekey0 is not None) == [(1, 1)]


def test_update_key_columns(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert df.select(*K.update_key_columns(["x = a", "b"])).columns == ["a", "b"]


def test_prune_target_per_key_and_nulls(spark):
    target = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a"), (3, None)], "p int, q string")
    upd = spark.createDataFrame([(1, "b"), (2, None), (None, "a")], "p int, q string")
    # every key on its own: p in (1, 2) and q in ('b', 'a'); NULLs match nothing
    got = sorted(tuple(r) for r in K.prune_target(target, upd, ["p", "q"]).collect())
    assert got == [(1, "a"), (1, "b"), (2, "a")]
