"""Centroid clustering of integer vectors; the nearest centroid is found by the threshold algorithm.

Every dimension has the centroids sorted by their value there. A vector starts at its own value in each list and walks
outward, nearer neighbour first; a centroid that is met for the first time gets its exact distance. The gaps to the next
unread entry of each list, squared and summed, bound the distance of every centroid not met yet. A vector stops as soon as
that sum strictly exceeds its best distance, so that ties are still met and the smaller number wins.

All arithmetic is in integers, so results do not depend on how rows are dealt out. A round sends ``k`` rows of counts and
sums per task into one aggregation; centroids (``k`` times ``dims`` numbers) are all that the driver holds.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage
from .common import Batches, map_arrow

LARGEST = 1 << 27  # components lie below this, so that a squared distance fits into 64 bits
LISTS = 8  # sorted lists that a vector reads an entry of before it looks whether it can stop


def integers(vectors: DataFrame, id_col: str, vector_col: str, dims: int, scale: int) -> DataFrame:
    """``vec_id, v``: floor(scale * component) of the vectors that take part."""
    v = F.col(f"`{vector_col}`").cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    scaled = F.transform(v, lambda x: F.floor(x * F.lit(float(scale))))
    wide = F.exists("v", lambda x: F.abs(x) >= LARGEST)
    message = F.lit(f"a component is beyond {LARGEST / scale:g}: distances would not fit into 64 bits")
    return (vectors.filter((F.size(v) == dims) & ~bad).select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), scaled.alias("v"))
            .select("vec_id", F.when(wide, F.raise_error(message).cast("array<int>")).otherwise(F.col("v").cast("array<int>")).alias("v")))


def nearest(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Number and squared distance of each row's nearest centroid, and how many exact distances that took."""
    k, dims = centroids.shape
    ids = np.argsort(centroids, axis=0, kind="stable").T
    far = np.int64(2 * LARGEST)
    # the lists with a far entry at either end: an exhausted side is never the nearer one
    lists = np.pad(np.sort(centroids, axis=0).T, ((0, 0), (1, 1)))
    who, best, asked = np.full(len(x), k), np.full(len(x), np.iinfo(np.int64).max), 0
    live, met = np.arange(len(x)), np.zeros((len(x), k), bool)
    high = np.stack([np.searchsorted(lists[d, 1:-1], x[:, d]) for d in range(dims)], 1) + 1 if dims else np.zeros((len(x), 0), int)
    low = high - 1
    every = np.arange(dims)[None, :]

    def gaps(y: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return (np.where(low > 0, y - lists[every, low], far), np.where(high <= k, lists[every, high] - y, far))

    y = x
    while len(live):
        for lo in range(0, dims, LISTS):
            part = slice(lo, lo + LISTS)
            left, right = gaps(y, low, high)
            down = (left <= right)[:, part]
            entry = np.where(down, low[:, part], high[:, part]) - 1
            fresh = np.zeros_like(met)
            np.put_along_axis(fresh, ids[every[:, part], entry], True, 1)
            low[:, part] -= down
            high[:, part] += ~down
            fresh &= ~met
            met |= fresh
            for c in np.flatnonzero(fresh.any(0)):
                rows = np.flatnonzero(fresh[:, c])
                asked += len(rows)
                distance = ((y[rows] - centroids[c]) ** 2).sum(1)
                at = live[rows]
                nearer = (distance < best[at]) | ((distance == best[at]) & (c < who[at]))
                best[at[nearer]], who[at[nearer]] = distance[nearer], c
            frontier = (np.minimum(*gaps(y, low, high)) ** 2).sum(1)
            going = ~met.all(1) & (frontier <= best[live])
            if not going.all():
                live, met, y, low, high = live[going], met[going], y[going], low[going], high[going]
            if not len(live):
                break
    return who, best, asked


def _matrix(b: pa.RecordBatch, dims: int) -> np.ndarray:
    return b.column("v").flatten().to_numpy().astype(np.int64).reshape(-1, dims)


def _sums(rows: DataFrame, centroids: np.ndarray) -> dict[int, list[int]]:
    """Number of vectors and componentwise sums of each cluster that has any."""
    k, dims = centroids.shape

    def run(batches: Batches) -> Batches:
        n, sums = np.zeros(k, np.int64), np.zeros((k, dims), np.int64)
        for b in batches:
            if not b.num_rows:
                continue
            x = _matrix(b, dims)
            who, _, _ = nearest(x, centroids)
            n += np.bincount(who, minlength=k)
            for c in np.unique(who):
                sums[c] += x[who == c].sum(0)
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(some, pa.int32()), pa.array(list(np.column_stack([n, sums])[some]), pa.list_(pa.int64()))],
            names=["cluster", "values"])

    parts = map_arrow(rows.select("v"), run, "cluster int, values array<long>")
    total = parts.select("cluster", F.posexplode("values").alias("place", "value")).groupBy("cluster", "place").agg(
        F.sum(F.col("value").cast("decimal(28,0)")).alias("value"))
    out: dict[int, list[int]] = {}
    for r in total.collect():  # k rows of dims + 1 numbers
        out.setdefault(r.cluster, [0] * (dims + 1))[r.place] = int(r.value)
    return out


def first_centroids(rows: DataFrame, k: int, seed: int) -> np.ndarray:
    """The vectors whose ids have the smallest hashes: ``k`` rows, or all if there are fewer; equal hashes go by vector.

    Rows without an id are no candidates.
    """
    mark = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    got = rows.filter("vec_id is not null").select(mark.alias("mark"), "v").orderBy("mark", "v").limit(k).collect()
    return np.array([r.v for r in got], np.int64)


def move(centroids: np.ndarray, sums: dict[int, list[int]]) -> np.ndarray:
    """The floor of each cluster's mean; an empty cluster's centroid stays."""
    out = centroids.copy()
    for c, (n, *total) in sums.items():
        out[c] = [s // n for s in total]
    return out


def cluster(vectors: DataFrame, *, k: int = 8, rounds: int = 10, dims: int = 64, scale: int = 1024, seed: int = 3,
            id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256`` of every vector that takes part.

    Vectors that are null, of another length, or hold null or non-finite components take no part. Ids may be null or repeat;
    every row counts. With fewer rows than ``k`` there are as many centroids as rows with an id; without any, and on an
    empty table, the result is empty. Components of 131,072 and more (at scale 1024) fail the job. Rounds end early when no
    centroid moves. Extra columns are left behind. ``k`` is a parameter: its ``k`` result rows are broadcast.
    """
    spark = vectors.sparkSession
    rows = stage(integers(vectors, id_col, vector_col, dims, scale), "vectors")
    centroids = first_centroids(rows, k, seed)
    result = "vec_id long, cluster int, distance long"
    if not len(centroids):
        return spark.createDataFrame([], result + ", cluster_inertia long, inertia long, centroid_sha256 string")
    for _ in range(rounds):
        moved = move(centroids, _sums(rows, centroids))
        if (moved == centroids).all():
            break
        centroids = moved

    def run(batches: Batches) -> Batches:
        for b in batches:
            if b.num_rows:
                who, distance, _ = nearest(_matrix(b, dims), centroids)
                yield pa.RecordBatch.from_arrays([b.column("vec_id"), pa.array(who, pa.int32()), pa.array(distance, pa.int64())],
                                                 names=["vec_id", "cluster", "distance"])

    assigned = stage(map_arrow(rows, run, result), "assigned")
    inertia = {r["cluster"]: int(r["s"]) for r in assigned.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(28,0)")).alias("s")).collect()}
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    known = spark.createDataFrame([(c, s, sum(inertia.values()), sha[c]) for c, s in inertia.items()],
                                  "c int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(known), F.col("cluster") == F.col("c")).drop("c")
