"""Centroid clustering with geometric drift tightening.

Every vector carries its cluster, an upper bound on the distance to its
centroid and one lower bound on the distance to all others.  When centroids
move, the upper bound grows by its centroid's drift.  The lower bound needs to
shrink only by what a point inside the cluster's sphere (old centroid, largest
upper bound) can lose on another centroid that moves from ``c`` to ``c'``.
That is plane geometry: ``|x-c| - |x-c'|`` is constant on hyperbolas with foci
``c`` and ``c'``, and each lies inside its asymptotes, so with ``M`` halfway
between the foci the loss is below ``drift * cos(angle at M between x and the
move)``.  The least angle of a sphere around ``M``'s neighbour is that of its
tangent line.  A sphere on the far side loses nothing.

A vector whose upper bound stays below its lower bound keeps its cluster; the
others are ambiguous: their own distance is taken anew, and if that does not
settle it all centroids are scanned, in whole numbers, so ties are exact.

Each round is one pass without a shuffle: it reads the vectors with their
state, and writes them with the new state and, as rows of the same table, each
task's sums by cluster.  Those (clusters x components) are added up by Spark;
the driver holds the centroids and the ``clusters**2`` losses.  A lost executor
repeats tasks of one round from its stored input; the table before is deleted
once the next one is written.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DoubleType, IntegerType, LongType, StructField, StructType

from tablewright.session import scratch_path
from tablewright.sinks import store

SLACK = 1e-9  # relative widening of bounds, well above the error of float arithmetic
LIMIT = 1 << 26  # squared distances of larger components need not fit in a long


class Clusters(NamedTuple):
    """``vectors``: vec_id, cluster, distance (squared); the last centroids; vectors scanned against all centroids by pass."""

    vectors: DataFrame
    centroids: np.ndarray
    inertia: list[int]
    scanned: list[int]


def tight_losses(old: np.ndarray, new: np.ndarray, radius: np.ndarray) -> np.ndarray:
    """``[i]``: the most by which the lower bound of a vector in cluster ``i`` can shrink.

    ``radius`` bounds the distance of the cluster's vectors to its old centroid.
    """
    old, new = old.astype(float), new.astype(float)
    k = len(old)
    loss = np.zeros(k)
    for j in range(k):
        move = new[j] - old[j]
        drift = float(np.sqrt(move @ move))
        if drift == 0.0:
            continue
        middle = (old[j] + new[j]) / 2
        for i in range(k):
            if i == j:
                continue
            to = old[i] - middle
            far = float(np.sqrt(to @ to))
            if far <= radius[i]:
                cosine = 1.0  # the sphere holds M: any direction is possible
            else:
                between = np.arccos(np.clip((to @ move) / (far * drift), -1.0, 1.0))
                cosine = np.cos(max(0.0, between - np.arcsin(radius[i] / far)))
            loss[i] = max(loss[i], drift * max(0.0, cosine) * (1 + SLACK) + drift * SLACK)
    return loss


def squared_distances(vectors: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances, vectors x centroids."""
    out = np.empty((len(vectors), len(centroids)), np.int64)
    for j, c in enumerate(centroids):
        gap = vectors - c
        out[:, j] = np.einsum("ij,ij->i", gap, gap)
    return out


def _scan(vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nearest centroid (ties: smaller number), upper and lower bound, from exact distances."""
    d = squared_distances(vectors, centroids)
    near = d.argmin(axis=1)
    rows = np.arange(len(d))
    upper = np.sqrt(d[rows, near].astype(float)) * (1 + SLACK)
    d[rows, near] = np.iinfo(np.int64).max
    lower = np.sqrt(d.min(axis=1).astype(float)) * (1 - SLACK) if len(centroids) > 1 else np.full(len(d), np.inf)
    return near, upper, lower


def reassign(vectors: np.ndarray, centroids: np.ndarray, cluster: np.ndarray, upper: np.ndarray, lower: np.ndarray) -> int:
    """Set ``cluster, upper, lower`` in place to those for ``centroids``; the number of vectors scanned."""
    open_ = np.flatnonzero(upper >= lower)
    if len(open_):
        gap = vectors[open_] - centroids[cluster[open_]]
        upper[open_] = np.sqrt(np.einsum("ij,ij->i", gap, gap).astype(float)) * (1 + SLACK)
        open_ = open_[upper[open_] >= lower[open_]]
        cluster[open_], upper[open_], lower[open_] = _scan(vectors[open_], centroids)
    return len(open_)


def _whole(values: np.ndarray, scale: int) -> np.ndarray:
    scaled = np.floor(values.astype(np.float64) * scale)
    if len(scaled) and np.abs(scaled).max() >= LIMIT:
        raise ValueError(f"a component times {scale} reaches {LIMIT}; squared distances would not be exact in a long")
    return scaled.astype(np.int32)


def _state_schema(id_type) -> StructType:
    numbers = [("cluster", IntegerType()), ("upper", DoubleType()), ("lower", DoubleType()), ("distance", LongType()), ("n", LongType()),
               ("sums", ArrayType(LongType())), ("scanned", LongType()), ("inertia", LongType())]
    return StructType([StructField(n, t) for n, t in [("vec_id", id_type), ("v", BinaryType()), *numbers]])


def _pass(schema: StructType, dim: int, centroids: np.ndarray, drift: np.ndarray | None, loss: np.ndarray | None, scale: int, last: bool):
    """One round over Arrow batches: vectors with new bounds, then the task's sums by cluster.

    Without ``drift`` the batches hold raw vectors, which are scanned.
    """
    k = len(centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, scanned, inertia = np.zeros(k, np.int64), 0, np.zeros(k, np.int64)
        sums, radius = np.zeros((k, dim), np.int64), np.zeros(k)
        kind = None
        for batch in batches:
            ids, rows = batch.column("vec_id"), batch.num_rows
            kind = ids.type
            if not rows:
                continue
            if drift is None:
                vectors = _whole(batch.column("embedding").flatten().to_numpy(zero_copy_only=False).reshape(rows, dim), scale)
                whole = vectors.astype(np.int64)
                cluster, upper, lower = _scan(whole, centroids)
                scanned += rows
            else:
                flat = np.frombuffer(batch.column("v").buffers()[2], "<i4")
                begin = int(np.frombuffer(batch.column("v").buffers()[1], np.int32)[batch.column("v").offset]) // 4
                vectors = flat[begin:begin + rows * dim].reshape(rows, dim)
                whole = vectors.astype(np.int64)
                cluster = batch.column("cluster").to_numpy().astype(np.int64)
                upper = batch.column("upper").to_numpy() + drift[cluster]
                lower = batch.column("lower").to_numpy() - loss[cluster]
                scanned += reassign(whole, centroids, cluster, upper, lower)
            distance = None
            if last:
                gap = whole - centroids[cluster]
                distance = np.einsum("ij,ij->i", gap, gap)
                np.add.at(inertia, cluster, distance)
            n += np.bincount(cluster, minlength=k)
            np.maximum.at(radius, cluster, upper)
            for c in range(k):
                sums[c] += whole[cluster == c].sum(axis=0)
            raw = pa.py_buffer(np.ascontiguousarray(vectors, "<i4"))
            places = pa.py_buffer(np.arange(rows + 1, dtype=np.int32) * (4 * dim))
            none = {"n": pa.nulls(rows, pa.int64()), "sums": pa.nulls(rows, pa.list_(pa.int64()))}
            yield pa.RecordBatch.from_arrays(
                [ids, pa.nulls(rows, pa.binary()) if last else pa.Array.from_buffers(pa.binary(), rows, [None, places, raw]),
                 pa.array(cluster, pa.int32()), pa.array(upper), pa.array(lower),
                 pa.nulls(rows, pa.int64()) if distance is None else pa.array(distance),
                 none["n"], none["sums"], none["n"], none["n"]], names=schema.names)
        used = np.flatnonzero(n)
        if len(used):
            m = len(used)
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(m, kind), pa.nulls(m, pa.binary()), pa.array(used, pa.int32()), pa.array(radius[used]), pa.nulls(m, pa.float64()),
                 pa.nulls(m, pa.int64()), pa.array(n[used]), pa.array(sums[used].tolist(), pa.list_(pa.int64())),
                 pa.array([scanned] + [0] * (m - 1), pa.int64()), pa.array(inertia[used])], names=schema.names)
    return run


def _totals(state: DataFrame, k: int, dim: int):
    """Sums by cluster of all tasks, added by Spark: ``clusters x components`` numbers reach the driver."""
    n, radius, scanned, inertia = [0] * k, np.zeros(k), 0, [0] * k
    sums = np.zeros((k, dim), object)
    parts = state.where("n is not null").select("cluster", "upper", F.posexplode(
        F.concat("sums", F.array("n", "scanned", "inertia"))).alias("p", "x"))
    for c, p, total, far in parts.groupBy("cluster", "p").agg(F.sum(F.col("x").cast("decimal(38,0)")), F.max("upper")).collect():
        if p < dim:
            sums[c, p] = int(total)
        elif p == dim:
            n[c], radius[c] = int(total), far
        elif p == dim + 1:
            scanned += int(total)
        else:
            inertia[c] = int(total)
    return n, radius, scanned, inertia, sums


def kept_vectors(df: DataFrame, dim: int, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Rows with exactly ``dim`` components, none null or non-finite."""
    v = F.col("embedding")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return df.select(F.col(f"`{id_col}`").alias("vec_id"), F.col(f"`{vector_col}`").alias("embedding")).where(
        (F.size(v) == dim) & F.coalesce(finite, F.lit(False)))


def cluster_vectors(df: DataFrame, *, clusters: int = 8, rounds: int = 10, dim: int = 64, scale: int = 1024, salt: str = "3",
                    id_col: str = "vec_id", vector_col: str = "embedding") -> Clusters:
    """Cluster the kept vectors of ``df`` by ``rounds`` rounds and a last assignment.

    Components become ``floor(scale * x)``.  Centroids start as the ``clusters``
    vectors with the smallest sha256 of ``<salt>:<id>`` (a null id counts as
    empty text; repeated ids tie by their components).  A round assigns every
    vector to its nearest centroid (ties: smaller number) and moves each
    centroid with vectors to the floor of their mean; others stay.  With fewer
    vectors there are fewer centroids; without any the result is empty.
    Repeated rows count each; null, short, long and non-finite vectors are left
    out; other columns are not read.  A component whose scaled value reaches
    ``LIMIT`` is an error.
    """
    spark = df.sparkSession
    vectors = kept_vectors(df, dim, id_col, vector_col)
    ranked = vectors.withColumn("h", F.sha2(F.concat(F.lit(f"{salt}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256))
    first = ranked.orderBy("h", "embedding").limit(clusters).collect()  # as many rows as there are clusters
    schema = _state_schema(vectors.schema["vec_id"].dataType)
    if not first:
        return Clusters(spark.createDataFrame([], schema).select("vec_id", "cluster", "distance"), np.zeros((0, dim), np.int64), [], [])
    centroids = np.stack([_whole(np.array(r.embedding, np.float64), scale) for r in first]).astype(np.int64)
    k = len(centroids)

    source, before, drift, loss, scanned = vectors, None, None, None, []
    for turn in range(rounds + 1):
        path = scratch_path(spark, "llm-centroids")
        source.mapInArrow(_pass(schema, dim, centroids, drift, loss, scale, turn == rounds), schema).write.parquet(path)
        if before:
            store.delete(spark, before)
        before = path
        state = spark.read.schema(schema).parquet(path)
        n, radius, looked, inertia, sums = _totals(state, k, dim)
        scanned.append(int(looked))
        if turn == rounds:
            break
        moved = centroids.copy()
        for c in range(k):
            if n[c]:
                moved[c] = [int(s) // int(n[c]) for s in sums[c]]
        gap = (moved - centroids).astype(float)
        drift = np.sqrt(np.einsum("ij,ij->i", gap, gap)) * (1 + SLACK)
        loss = tight_losses(centroids, moved, radius)
        centroids = moved
        source = state.where("n is null").select("vec_id", "v", "cluster", "upper", "lower")
    return Clusters(state.where("n is null").select("vec_id", "cluster", "distance"), centroids, [int(i) for i in inertia], scanned)


def clustered(result: Clusters) -> DataFrame:
    """One row per vector with the inertia of its cluster and of all, and the digest of its centroid."""
    spark = result.vectors.sparkSession
    total = sum(result.inertia)
    digests = [hashlib.sha256(",".join(str(int(x)) for x in c).encode()).hexdigest() for c in result.centroids]
    by_cluster = spark.createDataFrame([(c, i, total, d) for c, (i, d) in enumerate(zip(result.inertia, digests))],
                                       "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return result.vectors.join(F.broadcast(by_cluster), "cluster").select(  # as many rows as there are clusters
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def oracle(clusters: int = 8, rounds: int = 10, dim: int = 64, scale: int = 1024, salt: str = "3") -> str:
    """DuckDB SQL of :func:`clustered`: every round written out."""
    nearest = ("SELECT vec_id, v, d[1] AS distance, d[2] AS cluster FROM (SELECT v.vec_id, v.k, any_value(v.v) AS v, "
               "min([list_sum(list_transform(list_zip(v.v, c.c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT, c.j]) AS d "
               "FROM kept v, {c} c GROUP BY v.vec_id, v.k)")
    steps = [
        f"kept AS MATERIALIZED (SELECT row_number() OVER () AS k, vec_id, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT) AS v "
        f"FROM embeddings WHERE len(embedding) = {dim} AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x))))",
        f"c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h) - 1 AS j, v AS c FROM (SELECT v, sha256('{salt}:' || vec_id::VARCHAR) AS h "
        f"FROM kept ORDER BY h LIMIT {clusters}))",
    ]
    for t in range(rounds):
        steps.append(f"a{t} AS MATERIALIZED ({nearest.format(c=f'c{t}')})")
        steps.append(
            f"s{t} AS MATERIALIZED (SELECT cluster, p, sum(v[p])::BIGINT AS s, count(*) AS n FROM a{t}, range(1, {dim + 1}) r(p) GROUP BY ALL)")
        steps.append(
            f"m{t} AS MATERIALIZED (SELECT cluster, list((s - ((s % n) + n) % n) // n ORDER BY p) AS c FROM s{t} GROUP BY cluster)")
        steps.append(f"c{t + 1} AS MATERIALIZED (SELECT j, coalesce(m.c, c.c) AS c FROM c{t} c LEFT JOIN m{t} m ON m.cluster = c.j)")
    steps.append(f"z AS MATERIALIZED ({nearest.format(c=f'c{rounds}')})")
    return ("WITH " + ",\n".join(steps) + "\nSELECT vec_id, cluster::INTEGER AS cluster, distance, "
            "(sum(distance) OVER (PARTITION BY cluster))::BIGINT AS cluster_inertia, (sum(distance) OVER ())::BIGINT AS inertia, "
            f"sha256(array_to_string(c, ',')) AS centroid_sha256 FROM z JOIN c{rounds} ON j = cluster")
