"""The reference demo's table maintenance sequence, end to end, plus a
property: partition-scoped changes equal whole-table changes."""

from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tablewright.session import scratch_path, unique_table_name
from tablewright.sinks.versioned import VersionedTable


def _ids(df):
    return sorted(r.id for r in df.collect())


def test_demo_sequence(spark):
    """write 0..4 → merge 0..19 → overwrite 5..9 → +100 on evens → delete evens → read version 0."""
    t = VersionedTable.create(spark, unique_table_name("demo"), spark.range(0, 5), root=scratch_path(spark, "demo"))
    assert _ids(t.read()) == [0, 1, 2, 3, 4]
    t.merge(spark.range(0, 20), "target.id = updates.id", update_set={"id": "updates.id"}, insert_values={"id": "updates.id"})
    assert _ids(t.read()) == list(range(20))
    t.overwrite(spark.range(5, 10))
    assert _ids(t.read()) == [5, 6, 7, 8, 9]
    t.update("id % 2 = 0", {"id": "id + 100"})
    assert _ids(t.read()) == [5, 7, 9, 106, 108]
    t.delete("id % 2 = 0")
    assert _ids(t.read()) == [5, 7, 9]
    assert _ids(t.read(0)) == [0, 1, 2, 3, 4] and t.version == 4


rows = st.lists(st.tuples(st.integers(0, 9), st.sampled_from(["a", "b", "c", None]), st.integers(-3, 3)), max_size=12,
                unique_by=lambda r: r[0])


@settings(max_examples=6, deadline=None, phases=[Phase.explicit, Phase.reuse, Phase.generate],
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(old=rows, new=rows, cut=st.integers(-3, 3))
def test_scoped_changes_equal_table_changes(spark, old, new, cut):
    schema = "id int, p string, v int"
    old_df = spark.createDataFrame(old, schema)
    new_df = spark.createDataFrame(new, schema)
    results = []
    for scope in ("table", "partitions"):
        t = VersionedTable.create(spark, unique_table_name("prop"), old_df, root=scratch_path(spark, "prop"), partition_by=["p"])
        t.merge(new_df, "target.id = updates.id", keys=["id"], delete_when=f"updates.v < {cut}", scope=scope)
        t.delete(f"v > {cut + 2}", scope=scope)
        fresh = new_df.filter(F.col("v") >= F.lit(cut)).withColumn("id", F.col("id") + 100)
        t.replace_where(fresh, f"v >= {cut}", scope=scope)
        results.append(sorted(map(str, t.read().select("id", "p", "v").collect())))
    assert results[0] == results[1]


@settings(max_examples=5, deadline=None, phases=[Phase.explicit, Phase.reuse, Phase.generate],
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(old=rows, cut=st.integers(-3, 3), dest=st.sampled_from(["a", "b", "d"]))
def test_scoped_update_equals_table_update(spark, old, cut, dest):
    old_df = spark.createDataFrame(old, "id int, p string, v int")
    results = []
    for scope in ("table", "partitions"):
        t = VersionedTable.create(spark, unique_table_name("propu"), old_df, root=scratch_path(spark, "propu"), partition_by=["p"])
        t.update(f"v > {cut}", {"v": "v * 2"}, scope=scope)
        t.update(f"v < {cut}", {"p": f"'{dest}'"}, scope=scope)  # moves rows between partitions
        results.append(sorted(map(str, t.read().select("id", "p", "v").collect())))
    assert results[0] == results[1]


@settings(max_examples=5, deadline=None, phases=[Phase.explicit, Phase.reuse, Phase.generate],
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(old=rows, new=rows)
def test_scoped_delete_then_write_equals_table(spark, old, new):
    schema = "id int, p string, v int"
    old_df, new_df = spark.createDataFrame(old, schema), spark.createDataFrame(new, schema)
    results = []
    for scope in ("table", "partitions"):
        t = VersionedTable.create(spark, unique_table_name("propd"), old_df, root=scratch_path(spark, "propd"), partition_by=["p"])
        t.delete_then_write(new_df, ["id"], scope=scope)
        results.append(sorted(map(str, t.read().select("id", "p", "v").collect())))
    assert results[0] == results[1]
