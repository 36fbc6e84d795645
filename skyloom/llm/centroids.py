"""Centroid clustering on exact integers, with the nearest centroid found by the threshold algorithm.

For each dimension the centroids' values are sorted. From a vector's own value the list is walked outward, one centroid at
a time in every dimension; a centroid met for the first time gets its exact distance. A centroid that no list has met yet is at least as
far in each dimension as that list's frontier, so the walk stops when the sum of the squared frontier distances strictly
exceeds the best exact distance: only then can no unmet centroid be nearer, or as near with a smaller number.

Rounds read one written table of integers; a task adds up its vectors by cluster, so a round shuffles and gives the driver k * dims
sums for each task, however many vectors there are and however they're spread. The centroids (k * dims integers) go to the tasks.

Null, short, long and non-finite vectors are left out; wide ones (see vectors.py) keep their row with null results. Vectors with equal ids
are rows of their own, ordered by their components where they compete for the start; a null id counts as the text "null" there. Fewer vectors than k give as many
centroids; an empty table gives an empty one; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyloom.llm import vectors as V
from skyloom.llm.common import given_back, written

CLUSTERS, ROUNDS, SALT = 40, 5, 2
FAR = np.iinfo(np.int64).max


class Lists:
    """The centroids' values by dimension, sorted, with the centroid of each."""

    def __init__(self, centroids: np.ndarray) -> None:
        self.centroids = centroids
        self.order = np.argsort(centroids, axis=0, kind="stable")
        self.value = np.take_along_axis(centroids, self.order, axis=0)

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """The nearest centroid of each vector, its squared distance, and how many exact distances were computed."""
        (n, dims), k = x.shape, len(self.centroids)
        across = np.arange(dims)
        right = np.stack([np.searchsorted(self.value[:, j], x[:, j]) for j in across], axis=1) if n else np.zeros((0, dims), np.int64)
        left = right - 1
        met, distance = np.zeros((n, k), bool), np.full((n, k), FAR)
        live = np.arange(n)
        while len(live):
            own, lo, hi = x[live], left[live], right[live]
            below = np.where(lo >= 0, own - self.value[np.maximum(lo, 0), across], FAR)
            above = np.where(hi < k, self.value[np.minimum(hi, k - 1), across] - own, FAR)
            down = below <= above
            fresh = np.zeros((len(live), k), bool)
            fresh[np.arange(len(live))[:, None], self.order[np.where(down, lo, hi), across]] = True
            fresh &= ~met[live]
            row, centroid = np.nonzero(fresh)
            distance[live[row], centroid] = ((own[row] - self.centroids[centroid]) ** 2).sum(axis=1)
            met[live[row], centroid] = True
            left[live] -= down
            right[live] += ~down
            frontier = (np.minimum(below, above) ** 2).sum(axis=1)
            live = live[(frontier <= distance[live].min(axis=1)) & ~met[live].all(axis=1)]
        return distance.argmin(axis=1), distance.min(axis=1) if n else np.zeros(0, np.int64), int(met.sum())


def _sums(centroids: np.ndarray) -> Callable:
    lists = Lists(centroids)

    @given_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k, dims = centroids.shape
        count, sums = np.zeros(k, np.int64), np.zeros((k, dims), np.int64)
        for _, _, x in V.portions(batches, dims):
            cluster = lists.nearest(x)[0]
            count += np.bincount(cluster, minlength=k)
            np.add.at(sums, cluster, x)
        used = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(count[used]), pa.array(list(sums[used]), pa.list_(pa.int64()))], names=["cluster", "n", "sums"])

    return run


def moved(rows: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round: floors of their vectors' means; empty ones stay."""
    parts = rows.select("vec_id", "ints").mapInArrow(_sums(centroids), "cluster int, n long, sums array<long>")
    added = parts.select("cluster", "n", F.posexplode("sums").alias("at", "s")).groupBy("cluster", "at").agg(V.total("n").alias("n"), V.total("s").alias("s"))
    out = centroids.copy()
    for r in added.collect():  # k * dims rows at most
        out[r["cluster"], r["at"]] = int(r["s"]) // int(r["n"])
    return out


def start(rows: DataFrame, k: int, salt: int, dims: int) -> np.ndarray:
    """The vectors with the k smallest hashes of their ids."""
    mark = F.sha2(F.concat(F.lit(f"{salt}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("null"))), 256)
    first = V.narrow(rows).select(mark.alias("mark"), "ints").orderBy("mark", "ints").limit(k).collect()
    return V.unpacked(pa.array([r["ints"] for r in sorted(first, key=lambda r: (r["mark"], bytes(r["ints"])))], pa.binary()), dims)


def fitted(rows: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, salt: int = SALT, dims: int = V.DIMS) -> np.ndarray:
    """The centroids of kept vectors after so many rounds."""
    centroids = start(rows, k, salt, dims)
    for _ in range(rounds if len(centroids) else 0):
        centroids = moved(V.narrow(rows), centroids)
    return centroids


def _assigned(centroids: np.ndarray) -> Callable:
    lists = Lists(centroids)

    @given_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, fits, x in V.portions(batches, centroids.shape[1]):
            cluster, distance = np.full(part.num_rows, -1, np.int32), np.full(part.num_rows, -1)
            if len(fits):
                cluster[fits], distance[fits], _ = lists.nearest(x)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(cluster, mask=cluster < 0), pa.array(distance, mask=cluster < 0)], names=["vec_id", "cluster", "distance"])

    return run


def assigned(rows: DataFrame, centroids: np.ndarray) -> DataFrame:
    """vec_id, cluster, distance (squared) of every kept vector."""
    return rows.select("vec_id", "ints").mapInArrow(_assigned(centroids), "vec_id long, cluster int, distance long")


def clustered(embeddings: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, salt: int = SALT, dims: int = V.DIMS) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of every kept vector."""
    spark = embeddings.sparkSession
    rows = V.kept(embeddings, dims)
    centroids = fitted(rows, k, rounds, salt, dims)
    every = written(assigned(rows, centroids.reshape(-1, dims)))
    sums = {r["cluster"]: int(r["s"]) for r in every.where("cluster is not null").groupBy("cluster").agg(V.total("distance").alias("s")).collect()}  # k rows at most
    fits = lambda s: s if s < 1 << 63 else None
    whole = fits(sum(sums.values()))
    digest = lambda c: hashlib.sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest()
    named = spark.createDataFrame([(c, fits(s), whole, digest(c)) for c, s in sums.items()], "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return every.join(F.broadcast(named), "cluster", "left").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
