"""Ordered computations without a single-task global sort.

Ranks, row numbers and running totals are computed inside range blocks that hold a
similar number of rows each; what earlier blocks contribute is added from one small
row per block. A hot key is cut by the range boundaries like any other stretch of rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import stage
from .joins import null_safe_join

UNFOLD = 1_000  # copies of one row that stay together
FOLDED = "_folded"  # rows that a folded row stands for
_ROW_BITS = 33  # monotonically_increasing_id keeps the row number in its low 33 bits


def ordered_blocks(df: DataFrame, keys: list[str], descending: bool = False) -> DataFrame:
    """Range-partition and sort by ``keys``; adds ``_block`` and ``_pos`` (from 0).

    The result is a written table, so block numbers cannot change on a retry.
    """
    order = [F.col(k).desc() if descending else F.col(k).asc() for k in keys]
    return stage(_with_place(df.repartitionByRange(*order).sortWithinPartitions(*order)), "blocks")


def _with_place(df: DataFrame) -> DataFrame:
    """``_block``, the number of the partition, and ``_pos``, the place in it from 0."""
    return df.withColumn("_block", F.spark_partition_id()).withColumn(
        "_pos", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << _ROW_BITS) - 1)))


def _number_blocks(blocks: DataFrame, name: str, start: int) -> DataFrame:
    """``name``: the place in the block plus the rows of all blocks before it, one small row per block."""
    per_block = blocks.groupBy("_block").agg(F.count(F.lit(1)).alias("n"))
    carried = _carry(per_block, [], {"n": "sum"})
    return blocks.join(F.broadcast(carried), "_block", "left").withColumn(
        name, F.col("_pos") + F.coalesce(F.col("_c_n"), F.lit(0)) + F.lit(start))


def _carry(per_block: DataFrame, keys: list[str], names: dict[str, str]) -> DataFrame:
    """What the blocks before this one add, per key; only for keys that span blocks.

    Rows kept: at most one per block boundary, so the result is as small as the block count.
    """
    before = (
        Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    )
    fold = {"sum": F.sum, "max": F.max}
    carried = per_block.select(
        *keys, "_block", *[fold[how](n).over(before).alias(f"_c_{n}") for n, how in names.items()],
        F.count(F.lit(1)).over(before).alias("_earlier"),
    )
    return carried.where("_earlier > 0").drop("_earlier")


def running(
    df: DataFrame,
    order: list[str],
    columns: dict[str, tuple[str, Column]],
    within: list[str] | None = None,
    descending: bool = False,
    exclusive: bool = False,
) -> DataFrame:
    """Running ``sum`` or ``max`` up to and including each row (without it if ``exclusive``).

    ``columns`` maps an output name to (``"sum"`` | ``"max"``, expression). ``within`` restarts
    the totals per key. ``order`` should be unique within a key: ties share no single value.
    """
    within = within or []
    fold = {"sum": F.sum, "max": F.max}
    valued = df.select("*", *[e.alias(n) for n, (_, e) in columns.items()])
    blocks = ordered_blocks(valued, within + order, descending)
    per_block = blocks.groupBy(*within, "_block").agg(
        *[fold[how](n).alias(n) for n, (how, _) in columns.items()]
    )
    carried = _carry(per_block, within, {n: how for n, (how, _) in columns.items()})
    upto = (
        Window.partitionBy("_block", *within)
        .orderBy("_pos")
        .rowsBetween(Window.unboundedPreceding, -1 if exclusive else Window.currentRow)
    )
    local = blocks.withColumns(
        {n: fold[how](n).over(upto) for n, (how, _) in columns.items()}
    )
    joined = null_safe_join(local, F.broadcast(carried), ["_block", *within], "left")
    totals = {}
    for name, (how, _) in columns.items():
        earlier = F.col(f"_c_{name}")
        totals[name] = (
            F.coalesce(F.col(name) + earlier, F.col(name), earlier) if how == "sum"
            else F.greatest(F.col(name), earlier)
        )
    return joined.withColumns(totals).select(*df.columns, *columns)


def number_rows(
    df: DataFrame, keys: list[str], name: str, start: int = 1, descending: bool = False
) -> DataFrame:
    """Dense row numbers in the order of ``keys`` over the whole table."""
    blocks = ordered_blocks(df, keys, descending)
    return _number_blocks(blocks, name, start).select(*df.columns, name)


def with_surrogate_id(
    df: DataFrame, keys: list[str], name: str, start: int = 1, copies: str | None = None, folded: bool = False
) -> DataFrame:
    """A generated integer key, the same for the same table (the auto-increment of a sink).

    Equal rows are counted first, so a row repeated any number of times is one record in the grouping and a few in the
    range shuffle: it travels as pieces of at most ``UNFOLD`` copies, which the block boundaries may part. Copies appear
    in the sorted block, where the file keeps runs of equal values; a row's place there plus the sizes of the blocks
    before it is its key. No second shuffle. ``copies`` names a column with the counts when the rows come counted
    already (each row once); without copies, or with a null count, a row has no key.

    ``folded`` leaves the copies folded: a piece holds its first key and how many follow it (``FOLDED``), for
    :func:`unfold`. What decides by a row's other values decides for the whole piece, so tables stay as small as the pieces.
    """
    columns = [c for c in df.columns if c != copies]
    counted = (
        df.withColumnRenamed(copies, "_copies") if copies
        else df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_copies"))
    )
    order = keys + [c for c in columns if c not in keys]
    pieces = counted.where("_copies > 0").select(
        *columns, "_copies",
        F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_copies"), F.lit(UNFOLD).cast("bigint"))).alias("_from"))
    pieces = pieces.withColumn("_take", F.least(F.lit(UNFOLD).cast("bigint"), F.col("_copies") - F.col("_from") + 1))
    if folded:
        before = running(pieces, [*order, "_from"], {"_before": ("sum", F.col("_take"))}, exclusive=True)
        return before.select((F.coalesce("_before", F.lit(0)) + F.lit(start)).alias(name), *columns, F.col("_take").alias(FOLDED))
    placed = [F.col(c).asc() for c in [*order, "_from"]]
    unfolded = (
        pieces.repartitionByRange(*placed).sortWithinPartitions(*placed)
        .select(*columns, F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_take"))).alias("_copy")).drop("_copy")
    )
    blocks = stage(_with_place(unfolded), "numbered")
    return _number_blocks(blocks, name, start).select(name, *columns)


def unfold(df: DataFrame, name: str) -> DataFrame:
    """Every row of a folded table, with its own key; a table that is not folded stays as it is.

    Folded rows are dealt to the tasks first: those with many copies often lie side by side, and one task would make them all.
    """
    if FOLDED not in df.columns:
        return df
    keys = F.explode(F.sequence(F.col(name), F.col(name) + F.col(FOLDED) - 1)).alias(name)
    others = [c for c in df.columns if c not in (name, FOLDED)]
    return df.repartition(name).select(keys, *others).select(*[c for c in df.columns if c != FOLDED])


def n_folded(df: DataFrame) -> Column:
    """The aggregate that counts rows, those of a folded table unfolded."""
    return F.coalesce(F.sum(FOLDED), F.lit(0)) if FOLDED in df.columns else F.count(F.lit(1))
