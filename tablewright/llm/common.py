"""Helpers shared by the operators: word pattern, work tables, input columns."""

from __future__ import annotations

import gc
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.session import scratch_path
from tablewright.sinks import store

# ASCII white space splits words everywhere in this package.
SPACE = r"[\x20\x09-\x0D]+"


def words_of(text: Column) -> Column:
    """Array of the words of ``text``; null text has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def parquet_table(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` under the shared work folder and read it back: cuts the lineage and
    lets the following jobs start from stored rows after an executor is lost.

    The shuffle files behind the write are of no more use.  Spark deletes them
    once the driver has collected the plan that made them, so ask for that."""
    spark: SparkSession = df.sparkSession
    path = scratch_path(spark, f"llm-{label}")
    df.write.parquet(path)
    gc.collect()
    spark._jvm.System.gc()
    return spark.read.schema(df.schema).parquet(path)


def drop_tables(*steps: DataFrame) -> None:
    """Delete the files of step tables (:func:`parquet_table`) that no frame reads any more: what
    was made from them is stored.  An empty table without files is left."""
    for step in steps:
        for file in step.inputFiles()[:1]:
            folder = unquote(file).rsplit("/", 1)[0]
            if not folder.rsplit("/", 1)[1].startswith("llm-"):
                raise ValueError(f"{folder} is no step table")
            store.delete(step.sparkSession, folder)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row: inside ``body`` it is a lambda
    variable, so nested lambdas can index it without computing it again, also after the
    optimizer has moved the expression into a filter."""
    return F.get(F.transform(F.array(value), body), F.lit(0))
