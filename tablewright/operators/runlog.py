"""Distinct partitions, write statistics and latest-status logs (A1, A3, A4)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

STATS_SCHEMA = StructType(
    [
        StructField("stat_id", StringType(), True),
        StructField("stat_name", StringType(), True),
        StructField("stat_value", StringType(), True),
    ]
)


def distinct_partitions(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A1: every distinct tuple of the partition keys (map-side pre-aggregated)."""
    return df.select(*[F.col(f"`{k}`") for k in keys]).distinct()


def stats_rows(spark: SparkSession, run_id: str, metrics: Mapping[str, object]) -> DataFrame:
    """A3: one ``(stat_id, stat_name, stat_value, updated_at)`` row per metric.

    The metrics map of one write holds a handful of entries, so it is turned
    into a frame on the driver; the numbers in it were gathered by the write
    job itself (``DataFrame.observe``), not by a second pass.
    """
    rows = [(run_id, str(k), None if v is None else str(v)) for k, v in sorted(metrics.items())]
    return spark.createDataFrame(rows, STATS_SCHEMA).withColumn("updated_at", F.current_timestamp())


def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column]) -> DataFrame:
    """A4: the newest row per key, newest = largest ``order_by`` tuple (NULL is smallest).

    A hash aggregate finds each key's largest value of the first order column
    (fixed-width, one row per key and map task before the shuffle) and the
    rows that have it stay.  Of the few rows left ``max_by`` keeps the one with
    the largest tuple, so the payload is never sorted as a whole, and a key
    with a third of the log costs no more than any other.  The log is read
    twice, however many order columns there are.  The payload may hold MAP
    columns.
    """
    order_cols = [F.col(f"`{c}`") if isinstance(c, str) else c for c in order_by]
    names = [f"__tw_o{i}" for i in range(len(order_cols))]
    payload = [c for c in df.columns if c not in keys]
    rows = df.select("*", *[c.alias(n) for c, n in zip(order_cols, names)])
    best = rows.groupBy(*[F.col(f"`{k}`").alias(f"__tw_k{i}") for i, k in enumerate(keys)]).agg(F.max(names[0]).alias("__tw_max"))
    same = F.col(names[0]).eqNullSafe(F.col("__tw_max"))
    for i, k in enumerate(keys):
        same = same & F.col(f"`{k}`").eqNullSafe(F.col(f"__tw_k{i}"))
    rows = rows.join(best, same, "left_semi")
    row = F.struct(*[F.col(f"`{c}`") for c in payload])
    agg = rows.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(F.max_by(row, F.struct(*names)).alias("__tw_latest"))
    return agg.select(*[F.col(f"`{k}`") for k in keys], *[F.col(f"__tw_latest.`{c}`").alias(c) for c in payload])
