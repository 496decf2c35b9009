"""Joins and choices on intervals: points in intervals, overlaps resolved longest first, coverage by sweeps."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import stage
from .ordered import running

NARROWEST, STEP = 64, 4  # bin width of the finest level; each level is that much wider than the one before
HOT = 50_000  # points of one bin that meet its intervals in one task
CELL = 1 << 16  # characters in which overlaps are resolved together


def _level(length: Column) -> Column:
    """The finest level whose bins are at least as wide as an interval, so that it lies in two bins at most."""
    return F.greatest(F.lit(0), F.ceil(F.log2(F.greatest(length, F.lit(1)) / NARROWEST) / F.log2(F.lit(float(STEP))))).cast("int")


def _bin(at: Column, level: Column) -> Column:
    return F.floor(at / (F.lit(NARROWEST) * F.pow(F.lit(float(STEP)), level))).cast("long")


def first_parts(intervals: DataFrame, keys: list[str], value: str) -> DataFrame:
    """The part [start, stop) of each interval whose points no smaller interval (start, stop, value) of its keys holds.

    The smaller ones hold all places between an interval's start and their largest stop, so one sweep that carries this stop
    gives the parts. They do not overlap, and intervals without such a part fall out.
    """
    spans = intervals.select(*keys, "start", "stop", value).where("start < stop")
    reach = running(spans, ["start", "stop", value], {"_reach": ("max", F.col("stop"))}, within=keys, exclusive=True)
    return reach.select(*keys, F.greatest("start", "_reach").alias("start"), "stop", value).where("start < stop")


def value_at(points: DataFrame, intervals: DataFrame, keys: list[str], point: str, value: str, default: str,
             hot: int = HOT) -> DataFrame:
    """``points`` with ``value`` of the first interval [start, stop) of its keys that holds the point, else ``default``.

    First is the smallest (start, stop, value). Intervals of every length take part: each lies in one or two bins of its own
    level, and a point looks at one bin of every level that occurs. Of intervals that overlap only the parts where they are
    first take part, so a bin holds few and a point meets one at most, however many cover it. The points of a crowded bin are
    dealt to several copies of its few intervals. NULL keys, points and bounds hold nothing; every point keeps its row.
    """
    spans = stage(first_parts(intervals, keys, value).withColumn("_level", _level(F.col("stop") - F.col("start"))), "parts")
    levels = sorted(r[0] for r in spans.select("_level").distinct().collect())  # a few: lengths' logarithms
    ends = F.array(_bin(F.col("start"), F.col("_level")), _bin(F.col("stop") - 1, F.col("_level")))
    spans = spans.withColumn("_bin", F.explode(F.array_distinct(ends)))
    if not levels:
        return points.withColumn(value, F.lit(default))
    rows = stage(points.withColumn("_row", F.monotonically_increasing_id()), "points")
    look = rows.select(*keys, point, "_row", F.explode(F.array(*[F.lit(x) for x in levels])).alias("_level")).withColumn(
        "_bin", _bin(F.col(point), F.col("_level")))
    cell = [*keys, "_level", "_bin"]
    crowded = look.groupBy(*cell).agg(F.ceil(F.count("*") / hot).cast("int").alias("_parts")).where("_parts > 1")
    spans = spans.join(crowded, cell, "left").withColumn(
        "_part", F.explode(F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1))).drop("_parts")
    look = look.join(crowded, cell, "left").withColumn(
        "_part", F.pmod(F.xxhash64("_row"), F.coalesce("_parts", F.lit(1))).cast("int")).drop("_parts")
    holds = look.join(spans, [*cell, "_part"]).where((F.col("start") <= F.col(point)) & (F.col(point) < F.col("stop")))
    return rows.join(holds.select("_row", value), "_row", "left").drop("_row").withColumn(value, F.coalesce(value, F.lit(default)))


# --- overlaps ----------------------------------------------------------------------------

UNKNOWN, OUT, CHOSEN = 0, 1, 2


def _decide(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """Adds ``_state`` to rows sorted by (_group, rank): what a cell alone can tell of each span.

    A span that meets a chosen one is out. One that reaches over the cell's border, or meets a better one that is not
    decided, stays unknown. Any other is chosen.
    """
    group, taken, doubtful = None, bytearray(), bytearray()
    for b in batches:
        states = []
        for g, lo, start, stop in zip(*(b.column(c).to_pylist() for c in ("_group", "_lo", "start", "_stop"))):
            if g != group:
                group, taken, doubtful = g, bytearray(width), bytearray(width)
            i, j = max(start - lo, 0), min(stop - lo, width)
            if taken.find(1, i, j) >= 0:
                states.append(OUT)
            elif start < lo or stop > lo + width or doubtful.find(1, i, j) >= 0:
                doubtful[i:j] = b"\1" * (j - i)
                states.append(UNKNOWN)
            else:
                taken[i:j] = b"\1" * (j - i)
                states.append(CHOSEN)
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(states, pa.int32())], names=[*b.schema.names, "_state"])


def longest_first(matches: DataFrame, key: str = "text_id", cell: int = CELL) -> DataFrame:
    """The spans [start, end] that are chosen when longer ones go first and no two may overlap, per text.

    Of equal length the one that ends first goes first, then the smaller other columns. Each round cuts the texts into cells
    of ``cell`` characters, with copies of the spans that reach over a border in each cell they touch. A cell decides what
    does not depend on its neighbours; the next round looks at the rest with borders in other places, later with wider
    cells. So no stretch of touching spans is ever one group. Spans without start or end are left out.
    """
    names = [c for c in matches.columns if c != key]
    left = stage(matches.where("start <= end").withColumn("_row", F.monotonically_increasing_id()).withColumn(
        "_stop", F.col("end").cast("long") + 1), "spans")
    done, turn = None, 0
    while True:
        shift = cell // 2 if turn % 2 else 0
        at = lambda c: F.floor((F.col(c) + shift) / cell)
        copies = left.withColumn("_cell", F.explode(F.sequence(at("start"), F.floor((F.col("_stop") - 1 + shift) / cell)))).withColumn(
            "_lo", F.col("_cell") * cell - shift).withColumn("_group", F.concat_ws("/", F.col("_cell").cast("string"), F.col(key).cast("string")))
        rank = [F.col("start") - F.col("_stop"), F.col("end"), *[F.col(n) for n in names], F.col("_row")]
        dealt = copies.repartition("_group").sortWithinPartitions("_group", *rank)
        schema = T.StructType([*dealt.schema.fields, T.StructField("_state", T.IntegerType())])
        told = stage(dealt.mapInArrow(lambda bs, w=cell: _decide(bs, w), schema), "decided")
        within = (F.col("start") >= F.col("_lo")) & (F.col("_stop") <= F.col("_lo") + cell)
        chosen = told.where(within & (F.col("_state") == CHOSEN)).select(*matches.columns)
        done = chosen if done is None else done.unionByName(chosen)
        out = told.where(F.col("_state") == OUT).select("_row").distinct()
        # a span is seen once in the cell that holds its start
        owner = (F.col("start") >= F.col("_lo")) & (F.col("start") < F.col("_lo") + cell)
        left = stage(told.where(owner & (F.col("_state") == UNKNOWN)).select(*left.columns).join(out, "_row", "left_anti")
                     .select(*left.columns), "spans")
        if left.isEmpty():
            return done
        turn += 1
        cell = cell * 2 if turn % 2 == 0 else cell


# --- coverage ----------------------------------------------------------------------------


def contained(spans: DataFrame, holders: DataFrame, key: str, name: str) -> DataFrame:
    """``spans`` (key, start, stop, ...) with ``name``: one of ``holders`` (key, start, stop) contains it.

    A sweep: starts of both are put in order, and the largest stop of the holders that have begun is carried along.
    """
    others = [c for c in spans.columns if c not in (key, "start", "stop")]
    begun = holders.select(key, "start", "stop", F.lit(0).alias("_kind"))
    points = stage(begun.unionByName(spans.withColumn("_kind", F.lit(1)), allowMissingColumns=True), "points")
    reach = running(points, ["start", "_kind", "stop", *others], {"_reach": ("max", F.when(F.col("_kind") == 0, F.col("stop")))},
                    within=[key])
    return reach.where("_kind = 1").select(*spans.columns, F.coalesce(F.col("_reach") >= F.col("stop"), F.lit(False)).alias(name))


def uncovered(spans: DataFrame, covers: DataFrame, key: str, width: int = 4096) -> DataFrame:
    """The parts [start, stop) of each of ``spans`` that none of ``covers`` covers, with the other columns of the span.

    A sweep over the covers gives the gaps between them; a gap meets the spans that it overlaps in cells of ``width``
    characters, each pair in the one cell where the overlap begins.
    """
    others = [c for c in spans.columns if c not in (key, "start", "stop")]
    far = 1 << 40
    ends = spans.select(key).distinct().select(key, F.lit(far).alias("start"), F.lit(far + 1).alias("stop"))
    rows = stage(covers.select(key, F.col("start").cast("long"), F.col("stop").cast("long")).distinct().unionByName(ends), "covers")
    reach = running(rows, ["start", "stop"], {"_reach": ("max", F.col("stop"))}, within=[key], exclusive=True)
    gaps = reach.select(key, F.coalesce("_reach", F.lit(0)).alias("g_start"), F.col("start").alias("g_stop")).where("g_start < g_stop")
    # gaps that begin inside a span are found in the cell where they begin: no gap is unfolded
    at = lambda c: F.floor(F.col(c) / width)
    cells = spans.withColumn("_cell", F.explode(F.sequence(at("start"), F.floor((F.greatest(F.col("stop"), F.col("start") + 1) - 1) / width))))
    starts = gaps.withColumn("_cell", at("g_start"))
    inside = cells.join(starts, [key, "_cell"]).where("g_start > start and g_start < stop")
    # the gap that holds a span's own start: the last one that begins at or before it
    points = stage(gaps.select(key, F.col("g_start").alias("start"), F.col("g_stop"), F.lit(0).alias("_kind")).unionByName(
        spans.withColumn("_kind", F.lit(1)), allowMissingColumns=True), "starts")
    carried = running(points, ["start", "_kind", "stop", *others], {"_open": ("max", F.when(F.col("_kind") == 0, F.col("g_stop")))}, within=[key])
    first = carried.where("_kind = 1 and _open > start and start < stop").select(
        key, *others, "start", F.least("stop", "_open").alias("stop"))
    rest = inside.select(key, *others, F.col("g_start").alias("start"), F.least("stop", "g_stop").alias("stop"))
    return first.unionByName(rest)
