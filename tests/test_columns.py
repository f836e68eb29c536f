import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType

from tablewright.operators import columns as C
from tablewright.functions.timefmt import filter_year_range


@pytest.fixture()
def people(spark):
    return spark.createDataFrame([(1, "ann", "3.5", None), (2, "bob", "x", "b")], "id bigint, name string, score string, tag string")


def test_select_by_position_zips_and_orders(people):
    out = C.select_by_position(people, "who, key", "2,1,3")
    assert out.columns == ["who", "key"]
    assert [tuple(r) for r in out.orderBy("key").collect()] == [("ann", 1), ("bob", 2)]


@pytest.mark.parametrize("mapping", ["0", "5", "a,1"])
def test_select_by_position_errors(people, mapping):
    with pytest.raises(C.ProcessorError):
        C.select_by_position(people, "a", mapping)


def test_add_columns_rules(spark, people):
    target = spark.createDataFrame([], "id bigint, level int, note string, NAME string").schema
    out = C.add_columns(people, "level_parsed=1 + 1|Name=upper(name)|note=null|extra=concat(name, '!')|x2=level_parsed * 2", target)
    assert out.columns == ["id", "name", "score", "tag", "level_parsed", "note", "extra", "x2"]
    types = {f.name: f.dataType for f in out.schema.fields}
    assert types["level_parsed"] == IntegerType()  # type of `level`, marker removed
    assert types["note"] == StringType()
    assert types["x2"] == StringType()  # not in target → string
    row = out.filter("id = 1").first()
    assert row["name"] == "ann" and row["note"] is None and row["extra"] == "ann!" and row["x2"] == "4"


def test_add_columns_malformed(people):
    with pytest.raises(C.ProcessorError):
        C.add_columns(people, "a=b=c")


def test_rename_case_only_keeps_column(people):
    out = C.rename_columns(people, "NAME=name")
    assert "NAME" in out.columns and out.count() == 2
    assert out.select("NAME").orderBy("NAME").first()[0] == "ann"


def test_rename_expression_and_same_name(people):
    out = C.rename_columns(people, "full=concat(name, '-', id)|id=id")
    assert "full" in out.columns and "id" in out.columns and "name" in out.columns
    assert out.filter("id = 2").first()["full"] == "bob-2"


def test_drop_lowercases_and_ignores_absent(people):
    assert C.drop_columns(people, "TAG|nothing").columns == ["id", "name", "score"]


def test_conform_casts_and_orders(spark, people):
    target = spark.createDataFrame([], "score double, id int, name string").schema
    out = C.conform(people, target)
    assert out.columns == ["score", "id", "name"]
    vals = {r["id"]: r["score"] for r in out.collect()}
    assert vals == {1: 3.5, 2: None}  # malformed text → NULL, no job failure


def test_conform_missing_column(spark, people):
    target = spark.createDataFrame([], "id bigint, missing string").schema
    with pytest.raises(C.ProcessorError):
        C.conform(people, target)


def test_sync_dual_output(spark, people):
    target = spark.createDataFrame([], "id bigint, label string").schema
    res = C.sync_with_table(people, target, add="label=upper(name)", drop="score")
    assert res.processed.columns == ["id", "label"]
    assert "tag" in res.raw.columns and "score" not in res.raw.columns


def test_with_literals_overrides(people):
    out = C.with_literals(people, {"tag": "z", "dt": "2024"})
    assert {r["tag"] for r in out.collect()} == {"z"} and "dt" in out.columns


def test_columns_first(people):
    assert C.columns_first(people, ["TAG", "score"]).columns == ["tag", "score", "id", "name"]


def test_identify_columns_substring_and_repeats():
    cols = ["p_size", "p_retailprice", "p_partkey", "size2"]
    assert C.identify_columns(cols, [("size", False), ("p_partkey", True), ("nope", True), ("p_size", False)]) == [
        "p_size", "size2", "p_partkey", "p_size"]


def test_has_column(people):
    assert C.has_column(people, "name") and not C.has_column(people, "nope")


def test_year_filter_drops_null_and_out_of_range(spark):
    df = spark.createDataFrame(
        [(1, "1989-12-31 23:00:00"), (2, "1990-01-01 00:00:00"), (3, None), (4, "2999-01-01 00:00:00")],
        "id int, t string",
    ).withColumn("t", F.col("t").cast("timestamp"))
    assert sorted(r.id for r in filter_year_range(df, ["t"]).collect()) == [2]
