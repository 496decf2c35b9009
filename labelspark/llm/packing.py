"""Best-fit packing of documents into sequences by a grouping genetic algorithm on islands.

Documents are tokenised and cut in a narrow stage; pieces that fill a sequence are done. The others are dealt by hash
into blocks of bounded size, and each block is packed on several islands:

* an individual is a set of bins; crossover injects well-filled bins of one parent whole into the other, whose bins
  that hold an injected piece are broken up, and best-fits the displaced pieces, largest first;
* an island is a row of a table, a generation step a narrow stage; between steps the best individual of each island
  moves to the next island of its block.

Bins of the best individual that are well filled are final. The pieces of the others meet those of other blocks in a
next, much smaller level, until one block is left.
"""

from __future__ import annotations

import random
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage
from .common import Batches, map_arrow, narrow, tokenizer_path
from .tokens import encoder

CAPACITY = 2048
BLOCK = 6000  # pieces of a block, about
ISLANDS, POPULATION, EPOCHS, CROSSOVERS = 3, 3, 2, 5
OPEN = 16  # a bin with more free places than that is packed again in the next level

Bins = list[list[int]]


class _Room:
    """Bins by free places, with the best fit found by one step on a bit mask."""

    def __init__(self, capacity: int):
        self.by_free: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.mask = 0

    def add(self, bin_no: int, free: int) -> None:
        self.by_free[free].append(bin_no)
        self.mask |= 1 << free

    def take(self, size: int) -> tuple[int, int] | None:
        """A bin with the fewest free places that still holds ``size``, with that number of places."""
        fits = self.mask >> size
        if not fits:
            return None
        free = size + (fits & -fits).bit_length() - 1
        bin_no = self.by_free[free].pop()
        if not self.by_free[free]:
            self.mask &= ~(1 << free)
        return bin_no, free


def best_fit(bins: Bins, pieces: list[int], sizes: list[int], capacity: int) -> Bins:
    """Put the pieces, in the order given, into the fullest bin that holds them, or into a new one."""
    room = _Room(capacity)
    for i, b in enumerate(bins):
        room.add(i, capacity - sum(sizes[p] for p in b))
    for p in pieces:
        got = room.take(sizes[p])
        if got is None:
            bins.append([p])
            room.add(len(bins) - 1, capacity - sizes[p])
        else:
            bins[got[0]].append(p)
            room.add(got[0], got[1] - sizes[p])
    return bins


def fitness(bins: Bins, sizes: list[int], capacity: int) -> tuple[int, float]:
    """Fewer bins first; of as many bins, the more unequally filled set, which leaves larger gaps to use."""
    return -len(bins), sum((sum(sizes[p] for p in b) / capacity) ** 2 for b in bins)


def crossover(a: Bins, b: Bins, sizes: list[int], capacity: int, rng: random.Random) -> Bins:
    """Well-filled bins of ``b``, whole, in place of the bins of ``a`` that share a piece with them."""
    given = [x for x in b if sum(sizes[p] for p in x) >= 0.98 * capacity and rng.random() < 0.5]
    inside = {p for x in given for p in x}
    kept = [x[:] for x in a if inside.isdisjoint(x)]
    displaced = [p for x in a if not inside.isdisjoint(x) for p in x if p not in inside]
    # some of the emptier bins are broken up too: their pieces look for better places
    loads = [sum(sizes[p] for p in x) for x in kept]
    loose = {i for i, load in enumerate(loads) if load < 0.98 * capacity and rng.random() < 0.5}
    displaced += [p for i in loose for p in kept[i]]
    bins = [x for i, x in enumerate(kept) if i not in loose] + [x[:] for x in given]
    displaced.sort(key=lambda p: -sizes[p])
    return best_fit(bins, displaced, sizes, capacity)


def first_population(sizes: list[int], capacity: int, n: int, rng: random.Random, plain: bool = True) -> list[Bins]:
    """Best fit of the pieces from large to small (on one island only), and of nearly that order."""
    out = []
    for i in range(n):
        noise = 0.0 if plain and i == 0 else 0.05 * capacity * (i + 1)
        keys = [s + noise * rng.random() for s in sizes]
        out.append(best_fit([], sorted(range(len(sizes)), key=lambda p: -keys[p]), sizes, capacity))
        if len(out[-1]) <= -(-sum(sizes) // capacity):
            break
    return out


def evolve(population: list[Bins], sizes: list[int], capacity: int, crossovers: int, rng: random.Random) -> list[Bins]:
    """Crossovers of random parents; a child takes the place of the worst. Stops at the lower bound of bins."""
    least = -(-sum(sizes) // capacity)
    ranked = sorted(population, key=lambda x: fitness(x, sizes, capacity), reverse=True)
    for _ in range(crossovers):
        if len(ranked[0]) <= least or len(ranked) < 2:
            break
        a, b = rng.sample(ranked, 2)
        ranked[-1] = min(ranked[-1], crossover(a, b, sizes, capacity, rng), key=lambda x: -fitness(x, sizes, capacity)[0])
        ranked.sort(key=lambda x: fitness(x, sizes, capacity), reverse=True)
    return ranked


def _to_bytes(bins: Bins, n: int) -> bytes:
    of = np.empty(n, np.int32)
    for i, b in enumerate(bins):
        of[b] = i
    return of.tobytes()


def _to_bins(raw: bytes) -> Bins:
    of = np.frombuffer(raw, np.int32)
    order = np.argsort(of, kind="stable")
    cuts = np.flatnonzero(np.diff(of[order])) + 1
    return [x.tolist() for x in np.split(order, cuts)] if len(of) else []


_ISLAND = "block long, island int, population array<binary>, elite binary, bins int, spread double"


def _step(rows: DataFrame, capacity: int, epoch: int) -> DataFrame:
    """One epoch of every island (block, island, sizes, population, guest)."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            for r in batch.to_pylist():
                rng = random.Random(f"{r['block']}.{r['island']}.{epoch}")
                sizes = r["sizes"]
                if r["population"] is None:
                    population = first_population(sizes, capacity, POPULATION, rng, r["island"] == 0)
                else:
                    population = [_to_bins(x) for x in r["population"]]
                    population[-1:] = [population[-1], _to_bins(r["guest"])]
                ranked = evolve(population, sizes, capacity, CROSSOVERS, rng)[:POPULATION]
                n, (bins, spread) = len(sizes), fitness(ranked[0], sizes, capacity)
                out = [_to_bytes(x, n) for x in ranked]
                yield pa.RecordBatch.from_pydict({
                    "block": pa.array([r["block"]], pa.int64()), "island": pa.array([r["island"]], pa.int32()),
                    "population": pa.array([out], pa.list_(pa.binary())), "elite": pa.array([out[0]], pa.binary()),
                    "bins": pa.array([-bins], pa.int32()), "spread": pa.array([spread])})

    return map_arrow(rows, run, _ISLAND)


def _pack_blocks(blocks: DataFrame, capacity: int, n_blocks: int) -> DataFrame:
    """The best individual of each block (block, sizes, uids) after all epochs."""
    islands = blocks.select("block", "sizes", F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1))).alias("island"))
    tasks = max(1, n_blocks * ISLANDS)
    state = None
    for epoch in range(EPOCHS):
        if state is None:
            rows = islands.select("block", "island", "sizes", F.lit(None).cast("array<binary>").alias("population"),
                                  F.lit(None).cast("binary").alias("guest"))
        else:
            moved = state.select("block", F.pmod(F.col("island") + 1, F.lit(ISLANDS)).cast("int").alias("island"),
                                 F.col("elite").alias("guest"))
            rows = islands.join(state.select("block", "island", "population"), ["block", "island"]).join(
                moved, ["block", "island"]).select("block", "island", "sizes", "population", "guest")
        state = stage(_step(rows.repartition(min(tasks, 4096), "block", "island"), capacity, epoch), "islands")
    best = state.groupBy("block").agg(F.min(F.struct("bins", -F.col("spread"), "island", "elite")).alias("b"))
    return blocks.join(best.select("block", "b.elite"), "block")


def _emit(packed: DataFrame, capacity: int, level: int, last: bool) -> DataFrame:
    """``uid, sequence_id, offset`` of each piece; a null sequence for pieces that go to the next level."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            for r in batch.to_pylist():
                sizes, uids = np.array(r["sizes"]), np.array(r["uids"])
                ids, offsets = np.full(len(sizes), -1), np.zeros(len(sizes), np.int64)
                for i, b in enumerate(_to_bins(r["elite"])):
                    ends = np.cumsum(sizes[b])
                    if last or capacity - ends[-1] <= OPEN:
                        ids[b] = (level << 56) + (r["block"] << 20) + i
                        offsets[b] = ends - sizes[b]
                yield pa.RecordBatch.from_pydict({
                    "uid": pa.array(uids, pa.int64()), "length": pa.array(sizes, pa.int64()),
                    "sequence_id": pa.array(ids, pa.int64(), mask=ids < 0), "offset": pa.array(offsets, pa.int64())})

    return map_arrow(packed, run, "uid long, length long, sequence_id long, offset long")


def pack(pieces: DataFrame, *, capacity: int = CAPACITY, block: int = BLOCK) -> DataFrame:
    """``uid, sequence_id, offset`` for every row of ``uid, length`` (unique ids, 1 <= length <= capacity).

    Pieces of full length get a sequence of their own, with a negative number. An empty table gives an empty result.
    """
    full = pieces.filter(F.col("length") == capacity).select(
        "uid", (-1 - F.col("uid")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    done, rest, level = full, pieces.filter(F.col("length") < capacity).select("uid", "length"), 0
    n = rest.count()
    while n:
        n_blocks = -(-n // block)
        item = F.struct((-F.col("length")).alias("l"), "uid")
        blocks = stage(rest.groupBy(F.pmod(F.xxhash64("uid", F.lit(level)), F.lit(n_blocks)).alias("block")).agg(
            F.sort_array(F.collect_list(item)).alias("items")).select(
            "block", F.transform("items", lambda x: -x["l"]).alias("sizes"), F.col("items.uid").alias("uids")), "blocks")
        last = n_blocks == 1 or level == 6
        placed = stage(_emit(_pack_blocks(blocks, capacity, n_blocks), capacity, level, last), "placed")
        done = done.union(placed.filter("sequence_id is not null").select("uid", "sequence_id", "offset"))
        rest = placed.filter("sequence_id is null").select("uid", "length")
        n, level = (0 if last else rest.count()), level + 1
    return done


def cut_documents(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = "byte_bpe_50k.json",
                  capacity: int = CAPACITY, end_id: int = 0, with_ids: bool = False) -> DataFrame:
    """``uid, doc_id, piece, start, length, ids_crc32`` and, on demand, the ids of every piece, in a narrow stage.

    A document is its ids and ``end_id``. Longer ones than ``capacity`` are cut from the back, so that only the first
    piece may be shorter. Null and empty texts are the end id alone. ``uid`` numbers the rows of this run, so ids may be
    null or repeat; the result must be written once before it is used twice.
    """
    fields = [("uid", pa.int64()), ("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()),
              ("length", pa.int64()), ("ids_crc32", pa.int64())] + [("ids", pa.binary())] * with_ids
    end = int(end_id).to_bytes(4, "little")

    def rows(b: pa.RecordBatch, first: int) -> Iterator[tuple]:
        encode = encoder(tokenizer_path(vocabulary)).encode_batch
        for doc_id, raw in zip(b.column("doc_id").to_pylist(), encode(b.column("text").to_pylist())):
            raw += end
            n = len(raw) // 4
            start, stop, piece = 0, n % capacity or min(n, capacity), 0
            while start < n:
                ids = raw[4 * start:4 * stop]
                yield (first, doc_id, piece, start, stop - start, zlib.crc32(ids)) + (ids,) * with_ids
                first, start, stop, piece = first + 1, stop, stop + capacity, piece + 1

    def run(batches: Batches) -> Batches:
        uid = TaskContext.get().partitionId() << 36
        for b in batches:
            out = list(rows(b, uid))
            uid += len(out)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*out), fields)],
                                                 names=[f for f, _ in fields])

    texts = narrow(docs, id_col, text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    return map_arrow(texts, run, "uid long, doc_id long, piece int, start long, length long, ids_crc32 long"
                     + ", ids binary" * with_ids)


def pack_documents(docs: DataFrame, *, with_ids: bool = False, **options) -> DataFrame:
    """Every piece of every document with its sequence and its place there (see ``cut_documents`` and ``pack``)."""
    pieces = stage(cut_documents(docs, with_ids=with_ids, **options), "pieces")
    placed = pack(pieces.select("uid", "length"), capacity=options.get("capacity", CAPACITY))
    return pieces.join(placed, "uid").drop("uid")
