"""Approximate nearest neighbours by balanced posting lists.

Fitting, on a bounded sample: unit vectors are split top down into clusters of about equal size, and a graph of near
centroids is laid over them. Both have a fixed size bound and travel to the tasks.

Indexing, over every row: a vector searches the graph for its nearest centroids and goes to the nearest one and, when it
lies near a boundary, to others whose distance is within a ratio of the nearest. A list is dealt out in sub-lists of
bounded size, so a popular list, or a third of all rows being the same vector, is many tasks' work.

Searching: a query finds its nearest centroids in the same graph, keeps the lists within a distance ratio, and asks all
their sub-lists; the best of each are merged by query. Scores are cosines in double precision on the given vectors.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage
from .common import Batches, bounded_sample, map_arrow

MAX_SAMPLE = 20_000  # vectors that the centroids are fitted on
LIST_SIZE = 80  # sampled vectors of a list, about
DEGREE = 24  # neighbours of a centroid in the graph
SUB_LIST = 2000  # rows of a sub-list, about


@dataclass
class Index:
    """Unit centroids (at most ``2 * MAX_SAMPLE / LIST_SIZE``, see ``fit``), their neighbours, entry points."""

    centroids: np.ndarray
    near: np.ndarray
    entries: np.ndarray


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _split(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 8) -> np.ndarray:
    """Labels of k clusters of about equal size: k-means whose distance grows with a cluster's load."""
    centres = x[rng.choice(len(x), k, replace=False)]
    label = np.zeros(len(x), int)
    room = -(-len(x) * 5 // (4 * k))
    for _ in range(rounds):
        near = x @ centres.T
        order = np.argsort(-(near.max(1)))
        load, label = np.zeros(k, int), np.full(len(x), -1)
        rank = np.argsort(-near, axis=1)
        for i in order:
            for c in rank[i]:
                if load[c] < room:
                    label[i], load[c] = c, load[c] + 1
                    break
        for c in range(k):
            if load[c]:
                centres[c] = x[label == c].mean(0)
        centres /= np.maximum(np.linalg.norm(centres, axis=1, keepdims=True), 1e-12)
    return label


def fit_index(sample: np.ndarray, *, list_size: int = LIST_SIZE, degree: int = DEGREE, seed: int = 7) -> Index:
    """Hierarchical balanced clustering of unit vectors and the centroid graph. One vector gives one centroid."""
    rng = np.random.default_rng(seed)
    leaves, todo = [], [np.arange(len(sample))]
    while todo:
        at = todo.pop()
        if len(at) <= list_size:
            leaves.append(sample[at].mean(0))
            continue
        label = _split(sample[at], min(8, -(-len(at) // list_size)), rng)
        parts = [at[label == c] for c in range(label.max() + 1)]
        todo += [p for p in parts if 0 < len(p) < len(at)]
    c = np.stack(leaves)
    c = (c / np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)).astype(np.float32)
    m = len(c)
    near = np.argsort(-(c @ c.T), axis=1, kind="stable")[:, :min(degree, m)]
    # a few far links keep the graph in one piece
    far = rng.integers(0, m, (m, 4))
    entries = rng.choice(m, min(m, 8), replace=False)
    return Index(c, np.concatenate([near, far], 1).astype(np.int32), entries.astype(np.int32))


def graph_search(index: Index, x: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``width`` nearest centroids that a best-first walk over the graph finds, for each row of unit vectors.

    All rows walk together: in each round every row opens its best unopened centroid among the ``width`` best so far;
    the walk ends when no row has one.
    """
    n, m = len(x), len(index.centroids)
    width = min(width, m)
    known = np.zeros((n, m), bool)
    opened = np.zeros((n, m), bool)
    sim = np.full((n, m), -2.0, np.float32)
    sim[:, index.entries] = x @ index.centroids[index.entries].T
    known[:, index.entries] = True
    live = np.arange(n)
    while len(live):
        rows = sim[live]
        bar = -np.partition(-rows, width - 1, axis=1)[:, width - 1]
        open_sim = np.where(opened[live], -3.0, rows)
        best = open_sim.argmax(1)
        go = (open_sim[np.arange(len(live)), best] >= bar) & (open_sim[np.arange(len(live)), best] > -2)
        live, best = live[go], best[go]
        if not len(live):
            break
        opened[live, best] = True
        near = index.near[best]
        new = ~known[live[:, None], near]
        r, c = np.nonzero(new)
        who, what = live[r], near[r, c]
        known[who, what] = True
        sim[who, what] = np.einsum("ij,ij->i", x[who], index.centroids[what])
    order = np.argsort(-sim, axis=1, kind="stable")[:, :width]
    return order, np.take_along_axis(sim, order, 1)


def _within(sim: np.ndarray, ratio: float, most: int) -> np.ndarray:
    """Which of the sorted centroids lie within ``ratio`` times the nearest distance (and were reached), ``most`` at most."""
    d = np.sqrt(np.maximum(2 - 2 * sim, 0))
    ok = (d <= ratio * d[:, :1] + 1e-9) & (sim > -2)
    ok[:, most:] = False
    ok[:, 0] = True
    return ok


def _matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False)).reshape(len(column), -1)


def _lists(shared, width: int, ratio: float, most: int):
    def run(batches: Batches) -> Batches:
        index = shared.value
        for b in batches:
            for lo in range(0, b.num_rows, 500):
                part = b.slice(lo, 500)
                x = _unit(_matrix(part.column("vector")).astype(np.float64)).astype(np.float32)
                found, sim = graph_search(index, x, width)
                rows, cols = np.nonzero(_within(sim, ratio, most))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found[rows, cols].astype(np.int32)), part.column("vec_id").take(pa.array(rows)),
                     part.column("vector").take(pa.array(rows))], names=["list", "vec_id", "vector"])

    return run


def cosines(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Cosine of each pair of rows in double precision; equal rows give equal values wherever they stand."""
    dot = np.einsum("ij,ij->i", q, x)
    return dot / (np.sqrt(np.einsum("ij,ij->i", q, q)) * np.sqrt(np.einsum("ij,ij->i", x, x)))


def _best(queries: np.ndarray, q_ids: np.ndarray, x: np.ndarray, ids: np.ndarray, k: int) -> Iterator[tuple]:
    """The k nearest rows of a sub-list for each query, itself left out, ties to smaller ids.

    Equal vectors count once with their k + 1 smallest ids, which is all that a result can hold of them. Rows within
    rounding of the k-th value are scored exactly before they are cut.
    """
    kinds, inverse = np.unique(x, axis=0, return_inverse=True)
    order = np.lexsort((ids, inverse.ravel()))
    members = np.split(ids[order], np.flatnonzero(np.diff(inverse.ravel()[order])) + 1)
    rough = _unit(queries) @ _unit(kinds).T
    take = min(k + 1, len(kinds))
    for i, row in enumerate(rough):
        bar = -np.partition(-row, take - 1)[take - 1]
        near = np.flatnonzero(row >= bar - 1e-9)
        exact = cosines(np.broadcast_to(queries[i], (len(near), queries.shape[1])), kinds[near])
        pool = [(-s, int(m)) for s, j in zip(exact.tolist(), near) for m in members[j][:k + 1] if m != q_ids[i]]
        for s, m in heapq.nsmallest(k, pool):
            yield int(q_ids[i]), m, -s


def _scan(k: int):
    def run(batches: Batches) -> Batches:
        key, rows = None, []

        def close() -> Iterator[pa.RecordBatch]:
            if not rows:
                return
            t = pa.Table.from_batches(rows)
            asks = t.column("asks").to_numpy()
            ids, x = t.column("vec_id").to_numpy(), _matrix(t.column("vector").combine_chunks()).astype(np.float64)
            if asks.any() and not asks.all():
                out = list(_best(x[asks], ids[asks], x[~asks], ids[~asks], k))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (
                        pa.int64(), pa.int64(), pa.float64()))], names=["query_id", "vec_id", "score"])

        for b in batches:
            keys = list(zip(b.column("list").to_pylist(), b.column("sub").to_pylist()))
            lo = 0
            while lo < len(keys):
                hi = lo
                while hi < len(keys) and keys[hi] == keys[lo]:
                    hi += 1
                if keys[lo] != key:
                    yield from close()
                    key, rows = keys[lo], []
                rows.append(b.slice(lo, hi - lo))
                lo = hi
        yield from close()

    return run


def usable(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``vec_id, vector`` of rows that take part: an id, and a vector with finite components that is not zero."""
    v = F.col(f"`{vector_col}`").cast("array<double>")
    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), v.alias("vector"))
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return rows.filter(F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & (F.size("vector") > 0)).filter(
        ~bad & F.exists("vector", lambda x: x != 0))


def search(vectors: DataFrame, queries: DataFrame, *, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding",
           copies: int = 4, copy_ratio: float = 1.12, lists: int = 48, list_ratio: float = 1.35,
           max_sample: int = MAX_SAMPLE, list_size: int = LIST_SIZE, sub_list: int = SUB_LIST) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each query row its k nearest other rows among the lists it asks.

    Null, zero and non-finite vectors take no part, on either side. Ties go to the smaller id; rows of one id count as
    one. Vectors of one table have one length. An empty table gives an empty result.
    """
    rows, asked = usable(vectors, id_col, vector_col), usable(queries, id_col, vector_col)
    spark = vectors.sparkSession
    sample = bounded_sample(rows, "vec_id", max_sample).toArrow()
    if not len(sample):
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    sample = sample.sort_by("vec_id")
    index = fit_index(_unit(_matrix(sample.column("vector").combine_chunks())), list_size=list_size)
    shared = spark.sparkContext.broadcast(index)
    schema = "list int, vec_id long, vector array<double>"
    posted = stage(map_arrow(rows, _lists(shared, 16, copy_ratio, copies), schema), "postings")
    asks = stage(map_arrow(asked, _lists(shared, 2 * lists, list_ratio, lists), schema), "asks")
    sizes = posted.groupBy("list").agg(F.ceil(F.count("*") / sub_list).cast("int").alias("subs"))
    stored = posted.join(sizes, "list").select(
        "list", F.pmod(F.xxhash64("vec_id"), F.col("subs")).cast("int").alias("sub"), F.lit(False).alias("asks"), "vec_id", "vector")
    # a list's queries meet each of its sub-lists; they are dealt out too, so no task gets all the queries of a popular one
    asking = asks.join(sizes, "list").select(
        "list", F.explode(F.sequence(F.lit(0), F.col("subs") - 1)).alias("sub"), F.lit(True).alias("asks"), "vec_id", "vector")
    meet = stored.union(asking).repartition("list", "sub").sortWithinPartitions("list", "sub")
    near = map_arrow(meet, _scan(k), "query_id long, vec_id long, score double")
    top = near.groupBy("query_id").agg(F.sort_array(F.collect_set(
        F.struct((-F.col("score")).alias("s"), "vec_id"))).alias("found"))
    return top.select("query_id", F.posexplode(F.slice("found", 1, k)).alias("i", "x")).select(
        "query_id", (F.col("i") + 1).cast("int").alias("rank"), "x.vec_id", (-F.col("x.s")).alias("score"))
