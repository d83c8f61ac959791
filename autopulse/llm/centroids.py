"""Centroid clustering in exact integers, with a LAESA pivot table to skip centroids.

Components become integers (``floor(scale * x)``), centroids stay integers, so every distance and
every sum is exact and a round gives the same centroids however the rows are dealt.

The pivot table holds each vector with its distances to fixed pivots; it is written once.  Pivots are
means that a bounded sample (``SAMPLE`` vectors, those with the smallest hashes) gives after the same
rounds from the same start, far-apart ones if there are more than wanted; where vectors do form
clusters, each centroid ends near a pivot and the bounds are tight.  A poor sample costs exact
distances, never results.  By the triangle inequality the difference between a vector's and a centroid's distance to a pivot
bounds their own distance from below.  In each round a vector's exact distance to the centroid of
least bound is taken first; centroids whose bound exceeds it are skipped, the others get their exact
distance.  A round sends one row per centroid and component and task to the shuffle and brings one
row per centroid and component to the driver; the broadcast is the centroids alone.

Defined cases: null vectors and vectors of another length or with a null, NaN or infinite component
are left out; ties go to the smaller cluster number; repeated rows count each; of repeated
identifiers the start vectors are taken in the order of their components; fewer vectors than
clusters give fewer clusters; a cluster that loses all its vectors keeps its centroid; an empty
table gives an empty result; components beyond ``LIMIT`` after scaling raise an error, as exact
distances would leave 64 bits; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from autopulse.llm.common import map_batches, materialise

DIMENSIONS = 64
CLUSTERS = 40
ROUNDS = 5
SCALE = 256
SEED = "2"
PIVOTS = 8
SAMPLE = 2048
LIMIT = 1 << 25
ROWS = 4096
LARGEST = np.iinfo(np.int64).max


def integer_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                    dimensions: int = DIMENSIONS, scale: int = SCALE) -> DataFrame:
    """``vec_id, v`` of the usable rows, components scaled and rounded down."""
    x = F.col(vector_col)

    def finite(c):
        c = c.cast("double")
        return F.coalesce(~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(False))
    return (vectors.select(F.col(id_col).alias("vec_id"), x.alias("x"))
            .where((F.size("x") == dimensions) & F.forall("x", finite))
            .select("vec_id", F.transform("x", lambda c: F.floor(c.cast("double") * scale)).alias("v")))


def first_vectors(rows: DataFrame, most: int, seed: str = SEED) -> np.ndarray:
    """The vectors whose identifiers have the smallest hashes, in hash order (a bounded top-n)."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))).cast("binary"), 256)
    picked = rows.select(key.alias("key"), "v").orderBy("key", "v").limit(most).collect()
    return np.array([r["v"] for r in picked], np.int64)


def choose_pivots(sample: np.ndarray, clusters: int = CLUSTERS, rounds: int = ROUNDS, n: int = PIVOTS) -> np.ndarray:
    """The sample's own centroids after the rounds; of more than ``n`` those far apart."""
    means = sample[:clusters]
    for _ in range(rounds):
        cluster = np.array([((means - v) ** 2).sum(1).argmin() for v in sample])
        means = np.array([sample[cluster == c].sum(0) // max(1, (cluster == c).sum()) if (cluster == c).any() else means[c]
                          for c in range(len(means))])
    picked, nearest_ = [0], ((means - means[0]) ** 2).sum(1)
    while len(picked) < min(n, len(means)):
        picked.append(int(nearest_.argmax()))  # the farthest from those before
        nearest_ = np.minimum(nearest_, ((means - means[picked[-1]]) ** 2).sum(1))
    return means[picked]


def pivot_distances(v: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.stack([((v - p) ** 2).sum(1) for p in pivots], axis=1).astype(np.float64))


def pivot_table(rows: DataFrame, pivots: np.ndarray) -> DataFrame:
    """``vec_id, v, d``: each vector with its distances to the pivots."""
    kind = rows.schema["vec_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in small(batches):
            v = matrix(part.column("v"), np.int64)
            if np.abs(v).max(initial=0) > LIMIT:
                raise ValueError(f"a scaled vector component lies beyond {LIMIT}")
            yield pa.RecordBatch.from_arrays([part.column("vec_id"), lists(v.astype(np.int32)), lists(pivot_distances(v, pivots))],
                                             names=["vec_id", "v", "d"])

    return map_batches(rows, run, f"vec_id {kind}, v array<int>, d array<double>")


def small(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo in range(0, batch.num_rows, ROWS):
            yield batch.slice(lo, ROWS)


def matrix(column: pa.Array, kind) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(len(column), -1)


def lists(values: np.ndarray) -> pa.Array:
    ends = np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values.ravel()))


def nearest(v: np.ndarray, d: np.ndarray, centroids: np.ndarray, d_centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Cluster and exact squared distance of each vector, and how many exact distances that took."""
    low = np.zeros((len(v), len(centroids)))
    for j in range(d.shape[1]):
        np.maximum(low, np.abs(d[:, j, None] - d_centroids[None, :, j]), out=low)
    # a margin far above the rounding of roots, so that no centroid is skipped by it
    low = np.maximum(low - 1e-9 * (d.max(axis=1) + d_centroids.max() + 1)[:, None], 0)
    first = low.argmin(axis=1)
    exact = np.full(low.shape, LARGEST, np.int64)
    every = np.arange(len(v))
    exact[every, first] = ((v - centroids[first]) ** 2).sum(1)
    open_ = low <= np.sqrt(exact[every, first].astype(np.float64))[:, None] * (1 + 1e-9)
    open_[every, first] = False
    for c in range(len(centroids)):
        at = np.flatnonzero(open_[:, c])
        if len(at):
            exact[at, c] = ((v[at] - centroids[c]) ** 2).sum(1)
    cluster = exact.argmin(axis=1)  # the first of equal distances
    return cluster, exact[every, cluster], len(v) + int(open_.sum())


def round_sums(table: DataFrame, centroids: np.ndarray, pivots: np.ndarray) -> DataFrame:
    """``cluster, part, total``: component sums of each cluster's vectors; part -1 is their count."""
    d_centroids = pivot_distances(centroids, pivots)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(centroids), centroids.shape[1] + 1), np.int64)
        for part in small(batches):
            v = matrix(part.column("v"), np.int64)
            cluster, _, _ = nearest(v, matrix(part.column("d"), np.float64), centroids, d_centroids)
            total[:, 0] += np.bincount(cluster, minlength=len(total))
            for c in np.unique(cluster):
                total[c, 1:] += v[cluster == c].sum(axis=0)
        c, part_ = np.nonzero(np.repeat(total[:, :1] > 0, total.shape[1], axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int32)), pa.array(part_.astype(np.int32) - 1), pa.array(total[c, part_])],
                                         names=["cluster", "part", "total"])

    sums = map_batches(table, run, "cluster int, part int, total long")
    return sums.groupBy("cluster", "part").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))


def moved(centroids: np.ndarray, sums: DataFrame) -> np.ndarray:
    """The next centroids: exact floors of the means; clusters without vectors stay."""
    total = {(r["cluster"], r["part"]): int(r["total"]) for r in sums.collect()}  # clusters x components rows
    out = centroids.copy()
    for c in range(len(out)):
        if (c, -1) in total:
            out[c] = [total[c, j] // total[c, -1] for j in range(out.shape[1])]
    return out


def assign(table: DataFrame, centroids: np.ndarray, pivots: np.ndarray) -> DataFrame:
    """``vec_id, cluster, distance`` of every vector of the pivot table."""
    d_centroids = pivot_distances(centroids, pivots)
    kind = table.schema["vec_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in small(batches):
            cluster, distance, _ = nearest(matrix(part.column("v"), np.int64), matrix(part.column("d"), np.float64),
                                           centroids, d_centroids)
            yield pa.RecordBatch.from_arrays([part.column("vec_id"), pa.array(cluster.astype(np.int32)), pa.array(distance)],
                                             names=["vec_id", "cluster", "distance"])

    return map_batches(table, run, f"vec_id {kind}, cluster int, distance long")


def cluster_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", clusters: int = CLUSTERS,
                    rounds: int = ROUNDS, dimensions: int = DIMENSIONS, scale: int = SCALE, seed: str = SEED,
                    n_pivots: int = PIVOTS) -> tuple[DataFrame, np.ndarray]:
    """Assignments (``vec_id, cluster, distance``) after ``rounds`` rounds, and the final centroids."""
    rows = integer_vectors(vectors, id_col, vector_col, dimensions, scale)
    sample = first_vectors(rows, max(clusters, SAMPLE), seed)
    if len(sample) and np.abs(sample).max() > LIMIT:
        raise ValueError(f"a scaled vector component lies beyond {LIMIT}")
    centroids = sample[:clusters]
    kind = rows.schema["vec_id"].dataType.simpleString()
    if not len(centroids):
        return vectors.sparkSession.createDataFrame([], f"vec_id {kind}, cluster int, distance long"), centroids
    pivots = choose_pivots(sample, clusters, rounds, n_pivots)
    table = materialise(pivot_table(rows, pivots), "pivot-table")
    for _ in range(rounds):
        centroids = moved(centroids, round_sums(table, centroids, pivots))
    return assign(table, centroids, pivots), centroids


def centroid_clusters(vectors: DataFrame, **options) -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256`` of every usable vector."""
    spark = vectors.sparkSession
    assigned, centroids = cluster_vectors(vectors, **options)
    assigned = materialise(assigned, "clusters")
    totals = {r["cluster"]: int(r["n"]) for r in assigned.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("n")).collect()}  # one row per cluster
    rows = [(c, totals[c], sum(totals.values()), hashlib.sha256(",".join(map(str, row)).encode()).hexdigest())
            for c, row in enumerate(centroids.tolist()) if c in totals]
    per_cluster = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(per_cluster), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
