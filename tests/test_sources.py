import pytest

from tablewright.sources import csv_layout as S
from tablewright.sources import files, jdbc
from tablewright.session import scratch_path


def test_avro_clear_error(spark, sf_dir):
    with pytest.raises(files.SourceUnavailable):
        files.read_avro(spark, f"{sf_dir}/nation.parquet")


def test_csv_schema_types_case_insensitive_and_spaces(spark):
    target = spark.createDataFrame([], "ID bigint, Amount double").schema
    s = S.csv_schema(["id", "amount", "first name"], target)
    assert [(f.name, f.dataType.simpleString()) for f in s.fields] == [("id", "bigint"), ("amount", "double"), ("first name", "string")]


def test_csv_read_plan_modes(spark, sf_dir):
    target = spark.read.parquet(f"{sf_dir}/nation.parquet").schema
    opts, schema = S.csv_read_plan(spark, {"header": "true", "delimiter": ";"}, {}, target)
    assert opts == {"delimiter": ";", "header": "true"} and schema is None
    opts, schema = S.csv_read_plan(spark, {"headerCols": "n_nationkey|n_name"}, {}, target)
    assert opts == {"delimiter": ","} and schema.names == ["n_nationkey", "n_name"]
    hdr = scratch_path(spark, "hdr")
    spark.createDataFrame([("n_nationkey", "n_name", "n_regionkey")]).coalesce(1).write.option("delimiter", ";").csv(hdr)
    opts, schema = S.csv_read_plan(spark, {"delimiter": ";"}, {"headerPath": hdr}, target)
    assert schema.names == ["n_nationkey", "n_name", "n_regionkey"]
    assert schema["n_nationkey"].dataType.simpleString() == "int"
    with pytest.raises(ValueError):
        S.csv_read_plan(spark, {}, {}, target)


def test_csv_round_trip_with_schema(spark, sf_dir):
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet")
    path = scratch_path(spark, "csv")
    nation.write.option("delimiter", ";").csv(path)
    got = files.read_csv(spark, path, {"delimiter": ";"}, nation.schema)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, nation.collect()))
    plain = files.read_csv(spark, path)
    assert plain.columns == ["_c0"]  # default delimiter is ','


def test_read_files_dispatch_defaults_to_parquet(spark, sf_dir):
    assert files.read_files(spark, None, f"{sf_dir}/region.parquet").count() == 5
    assert files.read_files(spark, "unknown", f"{sf_dir}/region.parquet").count() == 5


def test_jdbc_options():
    o = jdbc.jdbc_options("jdbc:x", "t", "  select 1  ")
    assert o["query"] == "select 1" and "dbtable" not in o
    o = jdbc.jdbc_options("jdbc:x", "t", partition_column="id", lower_bound=0, upper_bound=100, num_partitions=4, fetch_size=1000)
    assert o["dbtable"] == "t" and o["numPartitions"] == "4" and o["fetchsize"] == "1000"
    with pytest.raises(ValueError):
        jdbc.jdbc_options("jdbc:x")
    with pytest.raises(ValueError):
        jdbc.jdbc_options("jdbc:x", "t", partition_column="id")


def test_read_external_neither_is_empty(spark):
    df = jdbc.read_external(spark, "jdbc", {"url": "jdbc:none"})
    assert df.count() == 0 and df.columns == []


def test_schema_of_runs_no_rows(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/part.parquet")
    assert files.schema_of(df) == df.schema


def test_header_file_with_control_char_delimiter(spark, sf_dir):
    target = spark.read.parquet(f"{sf_dir}/nation.parquet").schema
    hdr = scratch_path(spark, "hdr1")
    spark.createDataFrame([("n_nationkey", "n_name")]).coalesce(1).write.option("delimiter", "\u0001").csv(hdr)
    _, schema = S.csv_read_plan(spark, {"delimiter": "\u0001"}, {"headerPath": hdr}, target)
    assert schema.names == ["n_nationkey", "n_name"]
    _, schema = S.csv_read_plan(spark, {}, {"headerPath": hdr}, target)  # read with ',' the line is one name
    assert len(schema.names) == 1
