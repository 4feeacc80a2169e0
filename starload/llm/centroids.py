"""Centroid clustering whose nearest-centroid search is the threshold algorithm.

For every dimension the centroids' values form a sorted list. A vector walks
each list outward from its own value, one step in all dimensions at a time,
always to the nearer side. A centroid met for the first time is resolved by
random access to its exact squared distance. A centroid not met yet is in
every dimension at least as far as that dimension's frontier, so once the sum
of the squared frontier distances is strictly greater than the best exact
distance no unmet centroid can be nearer, nor as near: the walk stops.

All numbers are integers. A round is one scan: tasks assign their vectors and
give the sums of their clusters; the sums are added up per cluster and
dimension, and only the centroids (``clusters`` x dimensions numbers) pass
through the driver between rounds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starload.llm.common import gives_back, slices, staged

DIMENSIONS, SCALE = 64, 256
CLUSTERS, ROUNDS, SEED = 40, 5, 2
#: Greatest whole component: squared distances of 64 dimensions stay below 2^62.
GREATEST = 1 << 27
BLOCK = 2048


def whole_vectors(vectors: DataFrame, dimensions: int = DIMENSIONS, scale: int = SCALE) -> DataFrame:
    """(vec_id, x): floor(scale * component) of the vectors that have exactly
    ``dimensions`` components, none null or non-finite."""
    v = vectors.select(F.col("vec_id").cast("long").alias("vec_id"),
                       F.transform("embedding", lambda e: e.cast("double")).alias("v"))
    finite = F.forall("v", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf"))))
    v = v.filter(F.coalesce((F.size("v") == dimensions) & finite, F.lit(False)))
    big = F.concat(F.lit("a component is beyond +-"), F.lit(GREATEST), F.lit(f" / {scale}"))

    def whole(e):
        y = F.floor(e * F.lit(float(scale)))
        return F.when(F.abs(e) > F.lit(GREATEST / scale), F.raise_error(big).cast("long")).otherwise(y.cast("long"))
    return v.select("vec_id", F.transform("v", whole).alias("x"))


def nearest(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each row of ``x`` the number of the nearest centroid (ties: the
    smaller number), its squared distance, and the steps walked."""
    n, d = x.shape
    k = len(centroids)
    order = np.argsort(centroids, axis=0, kind="stable").T  # per dimension: centroid numbers by value
    lists = np.take_along_axis(centroids, order.T, axis=0).T
    far = np.int64(1) << 40  # beyond either end of a list
    padded = np.hstack([np.full((d, 1), -far), lists, np.full((d, 1), far)])
    right = np.empty((n, d), np.int64)
    for j in range(d):
        right[:, j] = np.searchsorted(lists[j], x[:, j]) + 1
    left = right - 1
    best, where = np.full(n, np.iinfo(np.int64).max), np.full(n, k, np.int64)
    steps = np.zeros(n, np.int64)
    met = np.zeros((n, k), bool)
    rows, dims = np.arange(n), np.arange(d)[None, :]
    while len(rows):
        steps[rows] += 1
        values, lo, hi = x[rows], left[rows], right[rows]
        to_left, to_right = values - padded[dims, lo], padded[dims, hi] - values
        go_right = to_right < to_left
        frontier = np.where(go_right, to_right, to_left)
        seen = order[dims, np.where(go_right, hi, lo) - 1]
        left[rows], right[rows] = lo - ~go_right, hi + go_right
        now = np.zeros((len(rows), k), bool)
        np.put_along_axis(now, seen, True, axis=1)
        new = now & ~met[rows]
        met[rows] |= now
        a, c = np.nonzero(new)
        for s in range(0, len(a), 1 << 15):
            i, j = rows[a[s:s + (1 << 15)]], c[s:s + (1 << 15)]
            gap = x[i] - centroids[j]
            exact = np.einsum("ij,ij->i", gap, gap)
            by = np.lexsort((j, exact, i))
            i, j, exact = i[by], j[by], exact[by]
            first = np.flatnonzero(np.r_[True, i[1:] != i[:-1]])
            i, j, exact = i[first], j[first], exact[first]
            better = (exact < best[i]) | ((exact == best[i]) & (j < where[i]))
            best[i[better]], where[i[better]] = exact[better], j[better]
        open_ = ~met[rows].all(axis=1) & ((frontier * frontier).sum(axis=1) <= best[rows])
        rows = rows[open_]
    return where, best, steps


def _blocks(batches: Iterator[pa.RecordBatch], d: int) -> Iterator[tuple[pa.Array, np.ndarray]]:
    for batch in batches:
        for part in slices(batch, BLOCK * d * 8):
            yield part.column("vec_id"), np.asarray(part.column("x").flatten(), np.int64).reshape(-1, d)


def _round(vectors: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The next centroids: every non-empty cluster's floor of the mean."""
    k, d = centroids.shape
    schema = pa.schema([("cluster", pa.int32()), ("dim", pa.int32()), ("total", pa.int64()), ("n", pa.int64())])

    @gives_back
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((k, d), np.int64), np.zeros(k, np.int64)
        for _, x in _blocks(batches, d):
            cluster = nearest(x, centroids)[0]
            np.add.at(total, cluster, x)
            n += np.bincount(cluster, minlength=k)
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([
            pa.array(np.repeat(at, d), pa.int32()), pa.array(np.tile(np.arange(d), len(at)), pa.int32()),
            pa.array(total[at].ravel()), pa.array(np.repeat(n[at], d))], schema=schema)

    parts = vectors.mapInArrow(sums, "cluster int, dim int, total long, n long")
    wide = "decimal(38,0)"
    added = parts.groupBy("cluster", "dim").agg(F.sum(F.col("total").cast(wide)).alias("total"), F.sum("n").alias("n"))
    moved = centroids.copy()
    for r in added.collect():  # clusters x dimensions rows
        moved[r.cluster, r.dim] = int(r.total) // r.n
    return moved


def _assigned(vectors: DataFrame, centroids: np.ndarray) -> DataFrame:
    d = centroids.shape[1]
    schema = pa.schema([("vec_id", pa.int64()), ("cluster", pa.int32()), ("distance", pa.int64())])

    @gives_back
    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, x in _blocks(batches, d):
            cluster, distance, _ = nearest(x, centroids)
            yield pa.RecordBatch.from_arrays([ids, pa.array(cluster, pa.int32()), pa.array(distance)], schema=schema)

    return vectors.mapInArrow(assign, "vec_id long, cluster int, distance long")


def cluster_vectors(vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED,
                    dimensions: int = DIMENSIONS, scale: int = SCALE) -> DataFrame:
    """``rounds`` rounds of assignment and re-centring over ``vectors`` (vec_id,
    embedding), then one more assignment; other columns are ignored.

    One row per kept vector: vec_id, cluster, distance (squared), cluster_inertia
    and inertia (distances summed over the cluster and over all), and
    centroid_sha256 of the cluster's final components. Vectors with another
    number of components, or with null or non-finite ones, are left out. The
    first centroids are the vectors with the smallest sha256 of
    ``<seed>:<vec_id>``; rows that repeat a vec_id follow each other by their
    components, a null vec_id comes last, and fewer vectors than ``clusters``
    make fewer clusters. Equal centroids stay apart; vectors go to the smaller
    number. An empty cluster keeps its centroid. A component beyond 2^27 /
    ``scale`` fails the job, as distances would not fit a long. No vectors: no rows.
    """
    spark = vectors.sparkSession
    x = staged(whole_vectors(vectors, dimensions, scale), "whole_vectors")
    drawn = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    start = x.select(drawn.alias("h"), "x").orderBy(F.col("h").asc_nulls_last(), "x").limit(clusters).collect()
    centroids = np.array([r.x for r in start], np.int64).reshape(len(start), dimensions)
    result = ("vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    if not len(start):
        return spark.createDataFrame([], result)
    for _ in range(rounds):
        centroids = _round(x, centroids)
    rows = staged(_assigned(x, centroids), "clusters")
    sums = {r.cluster: r.s for r in rows.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}  # one row a cluster
    whole = sum(sums.values())
    names = spark.createDataFrame([(c, ",".join(map(str, centroids[c])), int(s), int(whole)) for c, s in sums.items()],
                                  "cluster int, components string, cluster_inertia long, inertia long")
    named = names.withColumn("centroid_sha256", F.sha2("components", 256)).drop("components")
    return rows.join(F.broadcast(named), "cluster").select(  # at most ``clusters`` rows
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
