import pytest
from pyspark.sql import functions as F

from tablewright.session import scratch_path, unique_table_name
from tablewright.sinks.versioned import VersionedTable
from tablewright.streaming import run_available, stream_into_table


def test_stream_append_once_per_file(spark, sf_dir):
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet")
    landing, ckpt = scratch_path(spark, "landing"), scratch_path(spark, "ckpt")
    name = unique_table_name("s_append")
    t = VersionedTable.create(spark, name, nation.limit(0), root=scratch_path(spark, "s_append"))

    def run():
        src = spark.readStream.schema(nation.schema).option("maxFilesPerTrigger", 1).parquet(landing)
        run_available(src, name, "s1", mode="append", checkpoint=ckpt)

    nation.repartition(3).write.parquet(landing)
    run()
    assert t.read().count() == 25
    run()  # nothing new: no duplicates
    assert t.read().count() == 25
    nation.filter("n_regionkey = 0").write.mode("append").parquet(landing)
    run()
    assert t.read().count() == 25 + nation.filter("n_regionkey = 0").count()
    assert int(t.properties()["tablewright.stream.s1.batch"]) >= 3


def test_stream_partition_overwrite(spark, sf_dir):
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    landing = scratch_path(spark, "landing")
    name = unique_table_name("s_parts")
    t = VersionedTable.create(spark, name, o, root=scratch_path(spark, "s_parts"), partition_by=["o_orderstatus"])
    o.filter("o_orderstatus = 'P'").withColumn("o_totalprice", F.lit(1.0)).write.parquet(landing)
    run_available(spark.readStream.schema(o.schema).parquet(landing), name, "s2", mode="overwrite_partitions",
                  checkpoint=scratch_path(spark, "ckpt"))
    got = t.read().groupBy("o_orderstatus").agg(F.max("o_totalprice").alias("m")).collect()
    assert {r.o_orderstatus: r.m == 1.0 for r in got} == {"F": False, "O": False, "P": True}


def test_stream_mode_validation(spark, sf_dir):
    empty = scratch_path(spark, "empty")
    spark.createDataFrame([], "a int").write.parquet(empty)
    src = spark.readStream.schema("a int").parquet(empty)
    with pytest.raises(ValueError):
        stream_into_table(src, "whatever", "s3", mode="upsert")
    with pytest.raises(ValueError):
        stream_into_table(src, "whatever", "s3", mode="merge")
