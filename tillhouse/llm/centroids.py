"""Operator 13: centroid clustering with a LAESA pivot table.

Each vector's distances to a few fixed pivots are computed once and stored with
it.  In every round a centroid's distances to the same pivots bound its distance
to a vector from below: |d(v, p) - d(c, p)| <= d(v, c) for each pivot p.  The
centroid with the least bound is measured first, exactly; of the others only
those whose bound does not exceed that distance are measured, also exactly, in
integers.  Bounds are widened by more than their rounding error, so they never
drop a nearest centroid or one that ties with it.

Spark deals the rows: the table of integer vectors and pivot distances is written
to the shared folder once, each round is one pass over it that sums the
components of each cluster inside the tasks, and a partially aggregated sum of
(cluster, component) rows follows.  Only centroids come to the driver: ``k`` times
the number of components integers, whatever the input.

Defined results: rows whose vector is null, of another length, or has a null or
non-finite component are left out; repeated rows and repeated ids count as rows;
null ids are the last to be first centroids; equal hashes are ordered by the
vector; with fewer rows than ``k`` there are fewer centroids; an empty table gives
an empty one; other columns are not returned, so none can clash.  Components of
2**26 and more after scaling would overflow a 64-bit distance: such a vector is an
error, not a wrong result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillhouse.llm.common import store

LIMIT = 1 << 26
SLACK = 1e-9          # relative; pivot distances are square roots of exact integers


def squared(points: np.ndarray, centre: np.ndarray) -> np.ndarray:
    """Exact squared distances of integer rows to one integer point."""
    d = points - centre
    return np.einsum("ij,ij->i", d, d)


def nearest(points: np.ndarray, table: np.ndarray, centres: np.ndarray, centre_table: np.ndarray):
    """Nearest centre of each row (ties: the smaller number), its squared
    distance, and how many exact distances were measured.

    ``table`` and ``centre_table`` hold distances to the pivots."""
    n, k = len(points), len(centres)
    bound = np.zeros((n, k))
    for p in range(table.shape[1]):
        np.maximum(bound, np.abs(table[:, p:p + 1] - centre_table[None, :, p]), out=bound)
    bound -= SLACK * (1 + table.max(axis=1, initial=0)[:, None] + centre_table.max(initial=0))
    first = bound.argmin(axis=1)
    d = points - centres[first]
    best, at, measured = np.einsum("ij,ij->i", d, d), first.copy(), n
    for c in range(k):
        left = np.flatnonzero((first != c) & (bound[:, c] <= np.sqrt(best)))
        if len(left):
            measured += len(left)
            far = squared(points[left], centres[c])
            closer = (far < best[left]) | ((far == best[left]) & (c < at[left]))
            best[left[closer]], at[left[closer]] = far[closer], c
    return at, best, measured


def _points(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy().reshape(-1, dims).astype(np.int64)


def _distances(points: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.stack([squared(points, p) for p in pivots], axis=1).astype(np.float64)) if len(pivots) \
        else np.zeros((len(points), 0))


def integer_vectors(df: DataFrame, key: str, vector: str, dims: int, scale: int) -> DataFrame:
    """(key, point array<int>): floor(scale * x) of the kept vectors."""
    x = F.col("x")
    ok = (F.size(x) == dims) & F.forall(x, lambda v: F.coalesce(~F.isnan(v) & (F.abs(v) < float("inf")), F.lit(False)))
    point = F.transform(x, lambda v: F.floor(v * F.lit(float(scale))))
    big = F.exists(point, lambda v: (v >= LIMIT) | (v < -LIMIT))
    return (df.select(F.col(f"`{key}`").cast("long").alias("key"), F.col(f"`{vector}`").cast("array<double>").alias("x"))
              .where(F.col("x").isNotNull() & ok)
              .select("key", F.when(big, F.raise_error(F.lit("vector components of 2**26 and more have no exact 64-bit distance")))
              .otherwise(point).cast("array<int>").alias("point")))


def pivot_table(points: DataFrame, pivots: np.ndarray, dims: int) -> DataFrame:
    """``points`` with ``far``: each vector's distances to the pivots."""
    schema = T.StructType([*points.schema.fields, T.StructField("far", T.ArrayType(T.DoubleType()))])

    def work(batches):
        for batch in batches:
            if batch.num_rows:
                far = _distances(_points(batch.column(1), dims), pivots)
                ends = np.arange(len(far) + 1, dtype=np.int32) * len(pivots)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.ListArray.from_arrays(ends, far.ravel())], names=schema.names)

    return points.mapInArrow(work, schema)


def _assigned(table: DataFrame, centres: np.ndarray, pivots: np.ndarray, schema: T.StructType, emit) -> DataFrame:
    """One pass over the stored table with the centres of a round."""
    dims, own = centres.shape[1], _distances(centres, pivots)

    def work(batches):
        for batch in batches:
            if batch.num_rows:
                points = _points(batch.column(1), dims)
                far = batch.column(2).flatten().to_numpy().reshape(len(points), -1)
                yield from emit(batch, points, *nearest(points, far, centres, own)[:2])

    return table.select("key", "point", "far").mapInArrow(work, schema)


def move(table: DataFrame, centres: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """The centres of the next round: exact floors of the means."""
    k, dims = centres.shape
    schema = T.StructType([T.StructField("cluster", T.IntegerType()), T.StructField("n", T.LongType()),
                           T.StructField("total", T.ArrayType(T.LongType()))])

    def emit(batch, points, at, _):
        for c in np.unique(at):
            mine = points[at == c]
            yield pa.RecordBatch.from_arrays([pa.array([c], pa.int32()), pa.array([len(mine)], pa.int64()),
                                              pa.array([mine.sum(axis=0)], pa.list_(pa.int64()))], names=schema.names)

    parts = _assigned(table, centres, pivots, schema, emit)
    sums = (parts.select("cluster", "n", F.posexplode("total").alias("dim", "total"))
                 .groupBy("cluster", "dim").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"),
                                                F.sum(F.col("n").cast("decimal(38,0)")).alias("n")))
    out = centres.copy()
    for r in sums.collect():                                   # k * dims rows
        out[r["cluster"], r["dim"]] = int(r["total"]) // int(r["n"])
    return out


def first_centres(points: DataFrame, k: int, seed: str) -> np.ndarray:
    """The ``k`` kept vectors whose ids hash lowest, in that order."""
    order = F.sha2(F.concat(F.lit(seed), F.col("key").cast("string")), 256)
    rows = points.orderBy(order.asc_nulls_last(), "point").limit(k).collect()
    return np.array([r["point"] for r in rows], np.int64)


def cluster(df: DataFrame, key: str = "vec_id", vector: str = "embedding", dims: int = 64, k: int = 16, rounds: int = 3,
            scale: int = 64, pivots: int = 8, seed: str = "1:") -> DataFrame:
    """One row per kept vector: ``key``, cluster, distance (squared),
    cluster_inertia, inertia and centroid_sha256."""
    spark = df.sparkSession
    own = T.StructType([T.StructField(key, T.LongType()), T.StructField("cluster", T.IntegerType()),
                        T.StructField("distance", T.LongType())])
    last = T.StructType([*own.fields, T.StructField("cluster_inertia", T.LongType()), T.StructField("inertia", T.LongType()),
                         T.StructField("centroid_sha256", T.StringType())])
    points = integer_vectors(df, key, vector, dims, scale)
    centres = first_centres(points, k, seed)
    if not len(centres):
        return spark.createDataFrame([], last)
    fixed = centres[:pivots].copy()
    table = store(pivot_table(points, fixed, dims), "pivots")
    for _ in range(rounds):
        centres = move(table, centres, fixed)

    def emit(batch, points, at, best):
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(at.astype(np.int32)), pa.array(best)], names=own.names)

    done = store(_assigned(table, centres, fixed, own, emit), "clusters")
    sums = {r["cluster"]: int(r["d"]) for r in done.groupBy("cluster").agg(F.sum("distance").alias("d")).collect()}  # k rows
    shas = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres.tolist()]
    pick = lambda values: F.element_at(F.array(*[F.lit(v) for v in values]), F.col("cluster") + 1)
    return done.select(f"`{key}`", "cluster", "distance", pick([sums.get(c, 0) for c in range(len(shas))]).cast("long").alias("cluster_inertia"),
                       F.lit(sum(sums.values())).cast("long").alias("inertia"), pick(shas).alias("centroid_sha256"))
