"""Nested conforming, history stitching, range joins, rejects and one-pass JSON."""

import itertools
import os
import random
import re
import subprocess
import sys
from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tablewright.operators import changes as M
from tablewright.operators import columns as C
from tablewright.operators import history as H
from tablewright.operators import nested, ranges, rejects
from tablewright.operators.columns import ProcessorError
from tablewright.session import scratch_path
from tablewright.sources.json_once import read_json_once

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


# ------------------------------------------------------------------ nested types
def schema_of(spark, ddl):
    return spark.createDataFrame([], ddl).schema


def test_struct_fields_go_by_name(spark):
    df = spark.sql("SELECT named_struct('b', 1, 'a', 2, 'more', 3) AS s, CAST(NULL AS struct<b:int,a:int>) AS empty")
    out = C.conform(df, schema_of(spark, "s struct<a: string, B: bigint, absent: date>, empty struct<a: int, b: int>")).first()
    assert out.s.asDict() == {"a": "2", "B": 1, "absent": None} and out.empty is None


def test_structs_in_arrays_and_maps_go_by_name(spark):
    df = spark.sql(
        "SELECT array(named_struct('y', '1', 'x', array(named_struct('q', 1, 'p', 'no'))), NULL) AS xs, "
        "map(1, named_struct('v', 2, 'u', 'k')) AS m, map(named_struct('b', 1, 'a', 2), 'z') AS keyed, CAST(NULL AS array<struct<y:int>>) AS none")
    out = C.conform(df, schema_of(
        spark, "xs array<struct<x: array<struct<p: int, q: string>>, y: int>>, m map<bigint, struct<u: string, v: double>>, "
               "keyed map<struct<a: int, b: int>, string>, none array<struct<y: string>>")).first()
    assert out.xs[0].x[0].asDict() == {"p": None, "q": "1"} and out.xs[0].y == 1 and out.xs[1] is None
    assert out.m[1].asDict() == {"u": "k", "v": 2.0} and out.none is None
    assert {(k.a, k.b): v for k, v in out.keyed.items()} == {(2, 1): "z"}


def test_nested_mismatch_and_ambiguity(spark):
    with pytest.raises(nested.NestedMismatch):
        C.conform(spark.sql("SELECT 'x' AS s"), schema_of(spark, "s struct<a: int>"))
    one = spark.createDataFrame([((1, 2),)], "s struct<a: int, b: int>").select(F.struct(F.col("s.a").alias("a"), F.col("s.b").alias("A")).alias("s"))
    with pytest.raises(nested.NestedMismatch):
        C.conform(one, schema_of(spark, "s struct<a: int>"))
    added = C.add_columns(spark.range(1), "s=named_struct('b', 1, 'a', 2)", schema_of(spark, "s struct<a: int, b: int>")).first()
    assert added.s.asDict() == {"a": 2, "b": 1}


# ------------------------------------------------------------------ history
HISTORY = "k int, attr string, note string, is_current boolean, valid_from int, valid_to int"


def brute_history(rows, told):
    """Time line of each key by hand; ``told``: (k, attr, note, at, seq, gone)."""
    touched = {t[0] for t in told}
    out = [r for r in rows if r[0] not in touched]
    for k in touched:
        line = {}
        own = [r for r in rows if r[0] == k and (r[5] is None or r[4] < r[5])]
        for r in own:
            if r[5] is not None:
                line.setdefault(r[5], None)
        for r in own:
            line[r[4]] = (r[1], r[2])
        for t in sorted((t for t in told if t[0] == k), key=lambda t: t[4]):
            line[t[3]] = None if t[5] else (t[1], t[2])
        kept, last = [], None
        for at in sorted(line):
            state = line[at]
            if (state is None and last is None) or (state is not None and last is not None and state[0] == last[0]):
                continue
            kept.append((at, state))
            last = state
        for i, (at, state) in enumerate(kept):
            if state is not None:
                end = kept[i + 1][0] if i + 1 < len(kept) else None
                out.append((k, *state, end is None, at, end))
    return sorted(out, key=str)


def made_history(rng, keys, moments):
    rows = []
    for k in keys:
        at = sorted(rng.sample(range(moments), rng.randrange(0, 5)))
        for i, a in enumerate(at):
            follows = i + 1 < len(at)
            end = at[i + 1] if follows else None
            if rng.random() < .3:  # a gap, or an ended key
                end = rng.randrange(a + 1, (at[i + 1] if follows else moments + 3) + 1)
            rows.append((k, rng.choice(["x", "y", None]), f"h{a}", end is None, a, end))
    return rows


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.integers(0, 10**6), st.booleans())
def test_stitching_matches_time_lines(spark, seed, sliced):
    rng = random.Random(seed)
    rows = made_history(rng, [1, 2, 3, None], 12)
    told = [(rng.choice([1, 1, 1, 2, 4, None]), rng.choice(["x", "y", None]), f"c{s}", rng.randrange(0, 14), s, rng.random() < .15) for s in range(rng.randrange(0, 40))]
    changes = spark.createDataFrame(told, "k int, attr string, note string, at int, seq int, gone boolean")
    cut = {"hot_share": 20, "hot_rows": 0, "slices": 4} if sliced else {}
    out = H.stitch_history(spark.createDataFrame(rows, HISTORY), changes, ["k"], ["attr"], effective="at", sequence="seq", delete_when="gone", **cut)
    got = sorted((tuple(r) for r in out.collect()), key=str)
    assert got == brute_history(rows, told)
    touched = {t[0] for t in told}
    for k in touched:  # one current row at most, no overlaps
        own = sorted((r for r in got if r[0] == k), key=lambda r: r[4])
        assert sum(r[3] for r in own) <= 1
        assert all(a[5] is not None and a[5] <= b[4] for a, b in zip(own, own[1:]))


def test_several_updates_of_a_new_key(spark):
    history = spark.createDataFrame([(9, "z", "n", True, 1, None)], HISTORY)
    twice = spark.createDataFrame([(1, "a", 5), (1, "b", 7), (1, "b", 9), (1, "b", 9)], "k int, attr string, at int")
    out = H.stitch_history(history, twice, ["k"], ["attr"], effective="at")
    assert sorted(map(tuple, out.collect())) == [(1, "a", None, False, 5, 7), (1, "b", None, True, 7, None), (9, "z", "n", True, 1, None)]
    assert H.stitch_history(history, twice.limit(0), ["k"], ["attr"], effective="at").collect() == history.collect()
    with pytest.raises(M.MergeConflict, match="stitch_history"):
        M.scd2_changes(history, twice.drop("at").withColumn("note", F.lit("")), "k", ["attr"], load_date=F.lit(3))
    with pytest.raises(ValueError):
        H.stitch_history(history, twice, ["k"], ["nothing"], effective="at")
    with pytest.raises(Exception, match="has no at"):
        H.stitch_history(history, twice.withColumn("at", F.lit(None).cast("int")), ["k"], ["attr"], effective="at").collect()


def test_change_set_applied_again_changes_nothing(spark):
    rng = random.Random(3)
    rows = made_history(rng, range(8), 12)
    told = [(rng.randrange(10), rng.choice("xy"), f"c{s}", rng.randrange(14), s, rng.random() < .1) for s in range(40)]
    changes = spark.createDataFrame(told, "k int, attr string, note string, at int, seq int, gone boolean")
    whole = spark.createDataFrame(rows, HISTORY)
    current, past = whole.where("is_current").drop("is_current", "valid_to"), whole.where("NOT is_current").drop("is_current")
    apply = lambda c, h: H.apply_change_set(c, h, changes, ["k"], ["attr"], effective="at", sequence="seq", delete_when="gone")
    once = apply(current, past)
    c, h = ([tuple(r) for r in df.collect()] for df in once)
    want = brute_history(rows, told)
    assert sorted(c, key=str) == sorted([(r[0], r[1], r[2], r[4]) for r in want if r[3]], key=str)
    assert sorted(h, key=str) == sorted([(r[0], r[1], r[2], r[4], r[5]) for r in want if not r[3]], key=str)
    again = apply(spark.createDataFrame(c, once.current.schema), spark.createDataFrame(h, once.history.schema))
    assert sorted(map(tuple, again.current.collect()), key=str) == sorted(c, key=str)
    assert sorted(map(tuple, again.history.collect()), key=str) == sorted(h, key=str)


# ------------------------------------------------------------------ range joins
def test_range_join_matches_all_pairs(spark, monkeypatch):
    rng = random.Random(6)
    points = [(n, rng.choice([0, 0, 1]), rng.choice([7, 7, rng.randrange(200), None])) for n in range(400)]
    spans = [(n, rng.choice([0, 1, None]), a, a + rng.choice([-1, 0, 3, 300])) for n in range(120) for a in [rng.choice([rng.randrange(200), 7])]]
    spans += [(900, 0, None, 4), (901, 0, -50, 1000), (902, 1, 3, None)]
    p, s = spark.createDataFrame(points, "n int, k int, at int"), spark.createDataFrame(spans, "n int, k int, a int, z int")

    def pairs(keyed, left_open, right_closed):
        return sorted((x[0], y[0]) for x in points for y in spans if None not in (x[2], y[2], y[3]) and (not keyed or x[1] == y[1])
                      and (y[2] < x[2] if left_open else y[2] <= x[2]) and (x[2] <= y[3] if right_closed else x[2] < y[3]) and y[2] <= y[3])

    for rows in (10**6, 5):  # without and with bins cut again
        monkeypatch.setattr(ranges, "PART_ROWS", rows)
        for keyed, left_open, right_closed in ((False, False, True), (True, True, False)):
            out = ranges.point_in_interval_join(p, s, "at", "a", "z", ["k"] if keyed else [], open_start=left_open, closed_end=right_closed, groups=4)
            assert sorted((r.p.n, r.i.n) for r in out.collect()) == pairs(keyed, left_open, right_closed)
            assert M.nested_loops(out) == 0
    assert ranges.point_in_interval_join(p.limit(0), s, "at", "a", "z").collect() == []
    assert ranges.point_in_interval_join(p, s.limit(0), "at", "a", "z").collect() == []
    with pytest.raises(ValueError):
        ranges.point_in_interval_join(p.withColumn("at", F.lit("x")), s, "at", "a", "z")


def test_range_join_compares_few_pairs_that_do_not_match(spark, monkeypatch):
    rng = random.Random(9)
    inf = float("inf")
    points = [(n, rng.choice([rng.random(), rng.random() ** 6]) * 1000) for n in range(2000)] + [(-1, inf), (-2, -inf), (-3, -0.0), (-4, 0.0)]
    spans = [(n, a, a + rng.choice([0.1, 0.5, 2.0])) for n in range(2000) for a in [rng.random() * 1000]]
    spans += [(-1, -inf, 3.0), (-2, 990.0, inf), (-3, -inf, inf), (-4, 0.0, 0.5), (-5, -0.0, 0.0), (-6, 100.0, 900.0), (-7, 2000.0, 3000.0), (-8, -9.0, -8.0)]
    want = sorted((x[0], y[0]) for x in points for y in spans if y[1] <= x[1] <= y[2])
    p, s = spark.createDataFrame(points, "n int, at double"), spark.createDataFrame(spans, "n int, a double, z double")
    asked = []
    cells = ranges._cells
    monkeypatch.setattr(ranges, "_cells", lambda sizes, *rest: (asked.append(sizes), cells(sizes, *rest))[1])
    monkeypatch.setattr(ranges, "LEAF_ROWS", 16)
    for rows, most in ((10**6, 1 << 24), (100, 200)):  # without and with nodes cut by rows and pairs
        monkeypatch.setattr(ranges, "PART_ROWS", rows)
        monkeypatch.setattr(ranges, "PART_PAIRS", most)
        out = ranges.point_in_interval_join(p, s, "at", "a", "z", groups=8)
        assert sorted((r.p.n, r.i.n) for r in out.collect()) == want
        assert sum(a * b for _, a, b in asked[-1]) <= len(want) + 16 * len(spans)  # 64 bins alone: more than 30 a span
        plan = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        assert plan.count("SortMergeJoin") == 1  # pairs are made cell by cell, not where a side is read


def test_range_join_cuts_cells_of_many_pairs(monkeypatch):
    monkeypatch.setattr(ranges, "PART_PAIRS", 100)
    made = ranges._cells([(0, 50, 40), (1, 5, 4), (2, 3, 200), (20, 7, 7)], 4, 2, 4)
    share = max(100, (2000 + 20 + 600 + 49) / ranges.SHARES)
    first = 0
    for (node, a, b), (same, start, x, y) in zip([(0, 50, 40), (1, 5, 4), (2, 3, 200), (20, 7, 7)], made):
        assert (same, start) == (node, first) and a * b / (x * y) <= share
        first += x * y
    assert made[1][2:] == (1, 1) and made[3][2:] == (1, 1)


def test_range_join_makes_the_pairs_of_a_large_node_block_by_block(spark, monkeypatch):
    rng = random.Random(12)
    points = [(n, n % 2, rng.random() * 100) for n in range(200)]
    spans = [(n, n % 3, a, a + w) for n in range(300) for a, w in [rng.choice([(-1.0, 200.0), (30.0, 40.0), (rng.random() * 100, 3.0)])]] + [(-1, 0, -2.0, 300.0)] * 90
    p, s = spark.createDataFrame(points, "n int, k int, at double"), spark.createDataFrame(spans, "n int, k int, a double, z double")
    monkeypatch.setattr(ranges, "BLOCK", 16)
    for most in (20_000, 2_000):  # nodes whole, and cut as well
        monkeypatch.setattr(ranges, "PART_PAIRS", most)
        for keys in ([], ["k"]):
            out = ranges.point_in_interval_join(p, s, "at", "a", "z", keys, groups=4)
            got = [(r.p.n, r.i.n) for r in out.collect()]
            assert sorted(got) == sorted((x[0], y[0]) for x in points for y in spans if y[2] <= x[2] <= y[3] and (not keys or x[1] == y[1]))
            if not keys and most == 20_000:
                assert max(len(list(run)) for _, run in itertools.groupby(got, lambda pair: pair[0])) <= 2 * 16
                met = [len({i for _, i in got[k:k + 128]}) for k in range(0, len(got) - 128, 128)]
                assert sum(met) / len(met) <= 48  # point by point: 76
            plan = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
            assert len(re.findall(r"(?<!Broadcast)Exchange (?=hash|shuffle|range|Round|Single)", plan)) == 2  # points are not copied for the blocks before a shuffle


def test_overlap_join_matches_all_pairs(spark):
    rng = random.Random(8)
    made = lambda n: [(i, a, a + rng.choice([-2, 0, 1, 9, 80])) for i in range(n) for a in [rng.randrange(100)]]
    left, right = made(90), made(70)
    out = ranges.overlap_join(spark.createDataFrame(left, "n int, a int, z int"), spark.createDataFrame(right, "n int, b int, y int"), ("a", "z"), ("b", "y"), groups=4)
    want = sorted((x[0], y[0]) for x in left for y in right if x[1] <= x[2] and y[1] <= y[2] and x[1] <= y[2] and y[1] <= x[2])
    assert sorted((r.l.n, r.r.n) for r in out.collect()) == want


# ------------------------------------------------------------------ rejects
def test_rejects_of_csv_lines(spark):
    path = scratch_path(spark, "rejects")
    lines = ["1;a;2.5", "2;b;x", "3;c;1;4", "4;d", "5;;", "x;e;1", "6;f;7", "6;f;7"]
    spark.createDataFrame([(x,) for x in lines], "value string").write.text(path)
    target = schema_of(spark, "id int, name string, amount double")
    done = rejects.load_csv_with_rejects(spark, path, target, options={"sep": ";"}, required=["name"])
    assert sorted(map(tuple, done.accepted.collect())) == [(1, "a", 2.5), (6, "f", 7.0), (6, "f", 7.0)]
    got = {(r.reject_row, tuple((x.column, x.reason) for x in r.reject_reasons)) for r in done.rejected.collect()}
    assert got == {
        ('{"id":"2","name":"b","amount":"x"}', (("amount", "cast"),)), ("3;c;1;4", ((None, "unreadable"),)), ("4;d", ((None, "unreadable"),)),
        ('{"id":"5","name":null,"amount":null}', (("name", "null"),)), ('{"id":"x","name":"e","amount":"1"}', (("id", "cast"),))}
    assert done.counts["read"] == 8 and done.counts["accepted"] == 3 and done.counts["rejected"] == 5
    assert done.counts["unreadable"] == 2 and done.counts["column amount"] == 1 and done.counts["column id"] == 1
    assert done.accepted.schema == target


def test_rejects_look_into_nested_cells(spark):
    df = spark.sql("SELECT * FROM VALUES (1, named_struct('a', 'x'), array('1', 'q')), (2, named_struct('a', '3'), array('1', NULL)), "
                   "(3, NULL, NULL) AS t(id, s, xs)")
    done = rejects.sift(df, schema_of(spark, "id int, s struct<a: int, more: string>, xs array<int>"))
    assert sorted(r.id for r in done.accepted.collect()) == [2, 3]
    assert [[(x.column, x.reason) for x in r.reject_reasons] for r in done.rejected.collect()] == [[("s", "cast"), ("xs", "cast")]]
    empty = rejects.sift(df.limit(0), schema_of(spark, "id int"))
    assert empty.accepted.collect() == [] and empty.rejected.collect() == [] and empty.counts["read"] == 0
    with pytest.raises(ProcessorError):
        rejects.sift(df, schema_of(spark, "absent int"))


# ------------------------------------------------------------------ JSON in one pass
def test_json_read_once(spark):
    path = scratch_path(spark, "json_once")
    lines = ['{"a": 1, "b": {"y": "t", "x": 2.5, "z": 0}, "odd name": true, "new": [1, {"p": null}]}', '{"a": "x", "b": null}', "{broken", "[1]", "",
             '{"A": 7, "at": "2024-01-02T03:04:05", "xs": [1, "2", "u"]}', "  {\"a\": 2}  "]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    schema = schema_of(spark, "b struct<x: double, y: string>, a int, `odd name` boolean, at timestamp_ntz, xs array<string>, gone date")
    df = read_json_once(spark, path, schema)
    rows = df.collect()
    assert df.columns == [*schema.names, "unknown_fields", "corrupt_line"] and len(rows) == 6
    assert rows[0].b.asDict() == {"x": 2.5, "y": "t"} and rows[0].a == 1 and rows[0]["odd name"] is True
    assert rows[0].unknown_fields == {"new": '[1,{"p":null}]'} and rows[0].corrupt_line is None
    assert rows[1].a is None and rows[1].b is None and rows[1].unknown_fields is None
    assert [r.corrupt_line for r in rows] == [None, None, "{broken", "[1]", None, None] and rows[3].a is None
    assert rows[4].at == datetime(2024, 1, 2, 3, 4, 5) and rows[4].unknown_fields == {"A": "7"} and rows[4].xs == ["1", "2", "u"]
    assert rows[5].a == 2
    assert df._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


# ------------------------------------------------------------------ entry module
def test_entry_without_a_package_of_the_operators():
    code = ("import sys; sys.modules['public_tokenizers'] = None; sys.path.insert(0, %r); import __spark_entry__ as e; "
            "q = e.queries(); assert 'load_job' in q and 'sync_nested' in q and 'pipeline' not in q; print(len(q))" % ROOT)
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
    assert int(done.stdout) >= 63
