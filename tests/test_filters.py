"""Key filters of merges, column statistics of writes, and declared schemas of JSON and ORC loads."""

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tablewright.operators import changes, colstats, keyfilter
from tablewright.plans import jobs
from tablewright.plans import metadata as md
from tablewright.session import scratch_path, unique_table_name

KEYS = st.one_of(st.none(), st.integers(-5, 40))


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(KEYS, max_size=30), st.lists(KEYS, max_size=12, unique=True), st.sampled_from([64, 1 << 12]))
def test_filtered_merge_equals_plain_merge(spark, target, updates, bits):
    t = spark.createDataFrame([(k, f"t{i}") for i, k in enumerate(target)], "k int, v string")
    u = spark.createDataFrame([(k, f"u{k}") for k in updates], "k long, v string")  # another integer type
    clauses = {"keys": ["k"], "delete_when": "updates.k % 3 = 0"}
    plain = changes.merge(t, u.withColumn("k", F.col("k").cast("int")), None, **clauses)
    got = keyfilter.merge_with_key_filter(t, u, bits=bits, **clauses)
    assert sorted(map(str, got.collect())) == sorted(map(str, plain.collect()))
    found = keyfilter.key_filter(u, t, ["k"], bits)
    through = [r.k for r in keyfilter.prune_by_key_filter(t, found, ["k"], bits).collect()]
    assert sorted(k for k in target if k in updates and k is not None) == sorted(k for k in through if k in updates and k is not None)
    assert len(through) + keyfilter.beyond_key_filter(t, found, ["k"], bits).count() == len(target)


def test_filters_merge_and_refuse(spark):
    t = spark.range(1000).select(F.col("id").alias("k"))
    a, b = t.where("k < 100"), t.where("k BETWEEN 500 AND 510")
    both = keyfilter.merge_filters(keyfilter.key_filter(a, t, ["k"]), keyfilter.key_filter(b, t, ["k"]))
    through = keyfilter.prune_by_key_filter(t, both, ["k"])
    assert through.count() == 111  # no false positives among so few in so many bits
    plan = through._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") <= 3 and "SortMergeJoin" not in plan  # those of the filter, none of the target
    with pytest.raises(ValueError):
        keyfilter.key_filter(t.withColumn("k", F.col("k").cast("string")), t, ["k"])
    with pytest.raises(ValueError):
        keyfilter.key_filter(a, t, ["k < k"])
    with pytest.raises(ValueError):
        keyfilter.key_filter(a, t, ["k"], bits=100)


def test_statistics_merge_across_writes(spark):
    rng = random.Random(5)
    rows = [(i, rng.choice([None, rng.randrange(300)]), rng.choice([None, float("nan"), rng.random()]), f"v{rng.randrange(40)}", [i]) for i in range(900)]
    schema = "id long, n int, x double, s string, xs array<long>"
    df = spark.createDataFrame(rows, schema)
    parts = [df.where("id < 300"), df.where("id BETWEEN 300 AND 899"), df.limit(0)]
    kept = [colstats.write_with_stats(p, lambda d, i=i: d.write.parquet(scratch_path(spark, f"stats{i}")), f"w{i}") for i, p in enumerate(parts)]
    every = kept[0].unionByName(kept[1]).unionByName(kept[2])
    got = {r.column_name: r for r in colstats.merge_stats(every, df.schema).collect()}
    assert {r.n_rows for r in got.values()} == {900}
    assert got["n"].n_nulls == sum(r[1] is None for r in rows) and got["xs"].n_nulls == 0 and got["xs"].min_value is None
    assert int(got["n"].max_value) == max(r[1] for r in rows if r[1] is not None) and got["x"].max_value == "NaN"
    assert got["id"].min_value == "0" and got["id"].max_value == "899" and abs(got["id"].n_distinct - 900) < 72 and abs(got["s"].n_distinct - 40) <= 3
    # the order of merging changes nothing
    again = {r.column_name: r for r in colstats.merge_stats(kept[2].unionByName(kept[1]).unionByName(kept[0]), df.schema).collect()}
    assert {c: r[:5] for c, r in got.items()} == {c: r[:5] for c, r in again.items()}


def test_json_and_orc_loads_with_schema_and_options(spark):
    db, tdb, src = unique_table_name("meta"), unique_table_name("dw"), scratch_path(spark, "src")
    md.create_metadata_tables(spark, db, scratch_path(spark, "meta"))
    md.add_mount(spark, db, tdb, src, scratch_path(spark, "tgt"))
    lines = ['{"id": 1, "s": {"b": 2, "a": 1}, "more": 5}', '{"id": "x"}', "# not json"]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(f"{src}/json")
    md.add_entity(spark, db, "e1", tdb, "typed", {"format": "json", "schema": "id int, s struct<a: int, b: int>", "option.mode": "DROPMALFORMED"})
    md.log_operation(spark, db, "op-1", "e1", None, {"path": "/json"})
    jobs.load_from_metadata(spark, db, "op-1", conform=False)
    rows = spark.table(f"`{tdb}`.typed").collect()
    assert (1, (1, 2)) in [(r.id, tuple(r.s)) for r in rows if r.s] and len(rows) < 3
    # conforming to an existing target reads its columns in one pass
    request = md.resolve_load(spark, db, "op-1")
    request.details.pop("schema"), request.details.pop("option.mode")
    spec = jobs.spec_from_request(spark, request)
    assert spec.reader_schema is not None and spec.one_pass_json
    read = jobs.read_source(spark, spec)
    assert [tuple(r) for r in read.orderBy(F.col("id").desc_nulls_last()).limit(1).collect()] == [(1, (1, 2))]
    spark.range(3).write.orc(f"{src}/orc")
    md.add_entity(spark, db, "e2", tdb, "from_orc", {"format": "orc", "schema": "id bigint, absent string"})
    md.log_operation(spark, db, "op-2", "e2", None, {"path": "/orc"})
    jobs.load_from_metadata(spark, db, "op-2", conform=False)
    assert sorted(map(tuple, spark.table(f"`{tdb}`.from_orc").collect())) == [(0, None), (1, None), (2, None)]
