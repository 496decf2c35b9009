"""The prefix trie of conversations, by shards of the sorted paths and a skeleton of their splitters.

A conversation is a path: one 16-byte mark (hash of role and text) per turn, so that byte order puts the members of every
node next to each other, those that end there first and in the order of their ids.

1. Splitters (path, conv_id) are quantiles of a bounded sample, weighted by turns. Their paths form the skeleton, a small
   trie that every task gets. Rows are dealt by splitter and sorted, so a shard is a stretch of the sorted paths. Equal
   paths are split by id.
2. A shard is read once, with a stack of open nodes. A node that is not in the skeleton lies whole in one shard and is
   finished there. Of the skeleton's nodes a shard gives partial counts, and in parts the ids that end there.
3. Partial counts are reduced by Spark and added up along the skeleton. Ids that end at a skeleton node are hashed part by
   part in their order; SHA-256 is sequential, so that is one task per node, which holds one part at a time.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import stage
from .common import Batches, map_arrow

MARK = 16  # bytes of a turn's mark
SHARD = 100_000  # turns of a shard, about
SAMPLE = 64  # sampled paths per shard
SPLITTER_TURNS = 1024  # a longer splitter is cut: conversations that agree in so many turns share a shard
PART = 1 << 16  # ids in one part of a node's ends
OUT = 4096  # rows of a batch
LEAST_ID = -(1 << 63)

_NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
_WALKED = "kind int, node int, shard int, part int, bytes long, ids string, " + _NODE
_NAMES = [c.split()[0] for c in _WALKED.split(", ")]
_TYPES = [pa.int32()] * 4 + [pa.int64(), pa.string()] + [pa.int64()] * 7 + [pa.string()]


def rebuilt_paths(turns: DataFrame) -> DataFrame:
    """``conv_id, path, sizes``: the marks and the texts' UTF-8 bytes of each rebuilt conversation."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    mark = F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text))
    own = (turns.filter("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), F.struct(
        F.col("turn").alias("turn"), mark.alias("mark"), F.octet_length(text).alias("size")).alias("t"))
        .groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
        .select("conv_id", F.col("t.mark").alias("marks"), F.col("t.size").alias("sizes")))
    own = stage(own, "conversations")
    # a head gives its first eight turns to the four conversations after it
    heads = own.filter("conv_id % 5 = 0").select(F.col("conv_id").alias("head"), F.slice("marks", 1, 8).alias("first_marks"),
                                                 F.slice("sizes", 1, 8).alias("first_sizes"))
    joined = own.join(heads, F.col("conv_id") - F.col("conv_id") % 5 == F.col("head"), "left")
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9).cast("int")

    def spliced(name: str):
        first = F.coalesce(F.slice(f"first_{name}", 1, h), F.slice(name, 1, 0))
        return F.concat(first, F.slice(name, h + 1, F.greatest(F.size(name) - h, F.lit(0))))

    return joined.select("conv_id", F.unhex(F.array_join(spliced("marks"), "")).alias("path"), spliced("sizes").alias("sizes"))


class Skeleton:
    """The trie of the splitters' paths. Node 0 is the root."""

    def __init__(self, paths: list[bytes]):
        self.children: list[dict[bytes, int]] = [{}]
        self.parent, self.depth = [-1], [0]
        for path in paths:
            at = 0
            for lo in range(0, len(path), MARK):
                mark = path[lo:lo + MARK]
                if mark not in self.children[at]:
                    self.children[at][mark] = len(self.parent)
                    self.children.append({})
                    self.parent.append(at)
                    self.depth.append(self.depth[at] + 1)
                at = self.children[at][mark]


def splitters(paths: DataFrame, shards: int, rows: int) -> list[tuple[bytes, int]]:
    """At most ``shards - 1`` places (path, conv_id) that cut the sorted paths into stretches of about as many turns."""
    wanted, cells = SAMPLE * shards, 1 << 20
    some = paths if rows <= wanted else paths.filter(
        F.pmod(F.xxhash64("conv_id", F.lit(29)), F.lit(cells)) < max(1, cells * wanted // rows))
    cut = SPLITTER_TURNS * MARK
    sample = some.select(F.substring("path", 1, cut).alias("path"), F.when(F.length("path") <= cut, F.col("conv_id")).otherwise(
        F.lit(LEAST_ID)).alias("conv_id"), (1 + F.size("sizes")).alias("turns")).collect()
    sample.sort(key=lambda r: (bytes(r.path), r.conv_id))
    total, run, out = sum(r.turns for r in sample), 0, []
    for r in sample:
        if run * shards >= (len(out) + 1) * total:
            out.append((bytes(r.path), r.conv_id))
        run += r.turns
    return sorted(set(out))


class _Open:
    """A node whose members are being read."""

    __slots__ = ("skeleton", "depth", "size", "low", "n", "children", "leaves", "saved", "ends", "ids", "part", "below")

    def __init__(self, skeleton: int, depth: int, size: int):
        self.skeleton, self.depth, self.size = skeleton, depth, size
        self.low, self.n, self.children, self.leaves, self.saved = None, 0, 0, 0, 0
        self.ends, self.ids, self.part, self.below = hashlib.sha256(), [], 0, []


def walk(rows: Iterator[tuple[int, bytes, list[int]]], shard: int, children: list[dict[bytes, int]]) -> Iterator[tuple]:
    """Rows of ``_WALKED`` for one shard of sorted (conv_id, path, sizes).

    Kind 0 is a finished node (``node`` is its parent in the skeleton, if its parent is there), kind 1 a partial count of a
    skeleton node, kind 2 a part of the ids that end at one.
    """
    stack, path = [_Open(0, 0, 0)], b""

    def ids_of(at: _Open) -> tuple:
        row = (2, at.skeleton, shard, at.part, None, ",".join(map(str, at.ids))) + (None,) * 8
        at.ids, at.part = [], at.part + 1
        return row

    def close() -> Iterator[tuple]:
        at = stack.pop()
        if at.skeleton >= 0:
            if at.ids:
                yield ids_of(at)
            if at.n:
                yield (1, at.skeleton, None, None, at.size, None, at.low, at.depth, None, at.n, at.children, at.leaves, at.saved, None)
            elif at.depth:  # none of its own, but its deeper skeleton nodes have members here
                yield (1, at.skeleton, None, None, at.size, None, None, at.depth, None, 0, 0, 0, 0, None)
            return
        for depth, low, n, kids, leaves, saved, sha in at.below:
            yield (0, None, None, None, None, None, low, depth, at.low, n, kids, leaves, saved, sha)
        leaves, saved = at.leaves or 1, at.saved + (at.n - 1) * at.size
        sha, over = at.ends.hexdigest(), stack[-1]
        over.n, over.children, over.leaves, over.saved = over.n + at.n, over.children + 1, over.leaves + leaves, over.saved + saved
        over.low = at.low if over.low is None else min(over.low, at.low)
        if over.skeleton >= 0:
            yield (0, over.skeleton, None, None, None, None, at.low, at.depth, None, at.n, at.children, leaves, saved, sha)
        else:
            over.below.append((at.depth, at.low, at.n, at.children, leaves, saved, sha))

    for conv_id, new, sizes in rows:
        if new != path:
            turns, same = min(len(new), len(path)), 0
            while same < turns and new[same:same + MARK] == path[same:same + MARK]:
                same += MARK
            while len(stack) > same // MARK + 1:
                yield from close()
            for depth in range(same // MARK, len(new) // MARK):
                over = stack[-1].skeleton
                inside = children[over].get(new[depth * MARK:(depth + 1) * MARK], -1) if over >= 0 else -1
                stack.append(_Open(inside, depth + 1, sizes[depth]))
            path = new
        at = stack[-1]
        at.low = conv_id if at.low is None else min(at.low, conv_id)
        if at.skeleton >= 0:
            at.ids.append(conv_id)
            if len(at.ids) == PART:
                yield ids_of(at)
        else:
            at.ends.update(f",{conv_id}".encode() if at.n else str(conv_id).encode())
        at.n += 1
    while stack:
        yield from close()


def _walk_shards(paths: DataFrame, cuts: list[tuple[bytes, int]], shards: int, skeleton: Skeleton) -> DataFrame:
    shared = paths.sparkSession.sparkContext.broadcast((cuts, skeleton.children))

    def deal(batches: Batches) -> Batches:
        cuts, _ = shared.value
        for b in batches:
            keys = zip(b.column("path").to_pylist(), b.column("conv_id").to_pylist())
            to = pa.array([bisect_right(cuts, k) for k in keys], pa.int32())
            yield pa.RecordBatch.from_arrays([to, *b.columns], names=["shard", *b.schema.names])

    def run(batches: Batches) -> Batches:
        def rows() -> Iterator[tuple[int, bytes, list[int]]]:
            for b in batches:
                for r in zip(*(b.column(c).to_pylist() for c in ("shard", "conv_id", "path", "sizes"))):
                    at[0] = r[0]
                    yield r[1:]

        at, out = [0], []
        source = rows()
        first = next(source, None)
        if first is None:
            return
        for row in walk(_again(first, source), at[0], shared.value[1]):
            out.append(row)
            if len(out) >= OUT:
                yield _batch(out)
                out = []
        yield _batch(out)

    dealt = map_arrow(paths, deal, "shard int, conv_id long, path binary, sizes array<int>")
    return map_arrow(dealt.repartitionById(shards, "shard").sortWithinPartitions("path", "conv_id"), run, _WALKED)


def _again(first, rest: Iterator) -> Iterator:
    yield first
    yield from rest


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [()] * len(_TYPES)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _TYPES)], names=_NAMES)


def _hash_ends(parts: DataFrame) -> DataFrame:
    """``node, sha`` of the ids that end at skeleton nodes, read part by part in order."""

    def run(batches: Batches) -> Batches:
        node, sha = None, None
        for b in batches:
            for at, ids in zip(b.column("node").to_pylist(), b.column("ids").to_pylist()):
                if at != node:
                    if node is not None:
                        yield one(node, sha)
                    node, sha = at, hashlib.sha256(ids.encode())
                else:
                    sha.update(b"," + ids.encode())
        if node is not None:
            yield one(node, sha)

    def one(node: int, sha) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([node], pa.int32()), pa.array([sha.hexdigest()])], names=["node", "sha"])

    ordered = parts.select("node", "shard", "part", "ids").repartition("node").sortWithinPartitions("node", "shard", "part")
    return map_arrow(ordered, run, "node int, sha string")


def _skeleton_nodes(spark: SparkSession, walked: DataFrame, skeleton: Skeleton) -> DataFrame:
    """``node`` and the columns of ``_NODE`` for each skeleton node with members."""
    partial = walked.filter("kind = 1").groupBy("node").agg(
        F.sum("n_convs").alias("n"), F.min("conv_id").alias("low"), F.sum("n_children").alias("children"),
        F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved"), F.max("bytes").alias("size")).collect()
    nodes = len(skeleton.parent)
    n, low, children, leaves, saved, size = [0] * nodes, [None] * nodes, [0] * nodes, [0] * nodes, [0] * nodes, [0] * nodes
    for r in partial:
        n[r.node], low[r.node], children[r.node], leaves[r.node], saved[r.node], size[r.node] = r[1:]
    for i in reversed(range(nodes)):  # a child's number is larger than its parent's
        if not n[i]:
            continue
        leaves[i] = leaves[i] or 1
        saved[i] += (n[i] - 1) * size[i]
        up = skeleton.parent[i]
        if up >= 0:
            n[up], children[up], leaves[up], saved[up] = n[up] + n[i], children[up] + 1, leaves[up] + leaves[i], saved[up] + saved[i]
            low[up] = low[i] if low[up] is None else min(low[up], low[i])
    rows = [(i, low[i], skeleton.depth[i], low[skeleton.parent[i]] if i else None, n[i], children[i], leaves[i], saved[i])
            for i in range(nodes) if n[i]]
    frame = spark.createDataFrame(rows, "node int, " + _NODE.rsplit(", ", 1)[0])
    ends = _hash_ends(walked.filter("kind = 2")).withColumnRenamed("node", "at")
    none = hashlib.sha256(b"").hexdigest()
    return frame.join(ends, F.col("node") == F.col("at"), "left").select(
        *frame.columns, F.coalesce("sha", F.lit(none)).alias("ends_sha256"))


def trie(turns: DataFrame, *, shard: int = SHARD, least_shards: int | None = None) -> DataFrame:
    """One row per distinct sequence of first turns of the rebuilt conversations (see ``_NODE``), the root included.

    Turns are ordered by ``turn``, null first, equal ones by their mark. Null role or text is empty. Rows without a conv_id
    belong to no conversation and are left out, as are other columns. Repeated rows are turns of their own. Without
    conversations there is no root, and the result is empty. A conversation is one record of 20 bytes a turn.

    What the driver and every task hold is the skeleton: at most ``SPLITTER_TURNS`` nodes for each of the shards.
    """
    spark = turns.sparkSession
    paths = stage(rebuilt_paths(turns), "paths")
    rows, size = paths.agg(F.count("*"), F.sum(F.size("sizes") + 1)).first()
    if not rows:
        return spark.createDataFrame([], _NODE)
    shards = max(least_shards or int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // shard))
    cuts = splitters(paths, shards, rows)
    skeleton = Skeleton([p for p, _ in cuts])
    walked = stage(_walk_shards(paths, cuts, shards, skeleton), "nodes")
    top = stage(_skeleton_nodes(spark, walked, skeleton), "skeleton")
    columns = [c.split()[0] for c in _NODE.split(", ")]
    done = walked.filter("kind = 0 and node is null").select(*columns)
    over = F.broadcast(top.select(F.col("node").alias("at"), F.col("conv_id").alias("up")))
    under = walked.filter("kind = 0 and node is not null").join(over, F.col("node") == F.col("at")).select(
        *(F.col("up").alias(c) if c == "parent_conv_id" else F.col(c) for c in columns))
    return done.union(under).union(top.select(*columns))
