"""Helpers that several of the operators share."""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: the blanks that separate words, [\x20\x09-\x0D].
BLANKS = " \t\n\x0b\f\r"
BLANK_CLASS = r"[\x20\x09-\x0D]"

Batches = Iterator[pa.RecordBatch]


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def word_array(text: Column) -> Column:
    """The words of a text, split on the six ASCII blanks; an empty array for a text without words."""
    return let(F.btrim(text, F.lit(BLANKS)),
               lambda t: F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, BLANK_CLASS + "+")))


def narrow(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, text`` of a table, a null text as an empty one; every other column is left behind."""
    return df.select(F.col(f"`{id_col}`").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))


def map_arrow(df: DataFrame, fn: Callable[[Batches], Batches], schema: str) -> DataFrame:
    """``mapInArrow`` whose result a pushed-down filter or a second consumer cannot split into two runs."""
    return df.mapInArrow(fn, schema)


def bounded_sample(df: DataFrame, key: str, bound: int, seed: int = 17) -> DataFrame:
    """About ``bound`` rows at most, chosen by a hash of the key; all of them when there are fewer.

    Only for fitting a model. The row count comes from one aggregation; the choice is a plain filter, so nothing is
    gathered and the same key is chosen wherever it lies.
    """
    n = df.count()
    if n <= bound:
        return df
    cells = 1 << 20
    return df.filter(F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(cells)) < int(cells * bound / n))


@lru_cache(maxsize=4)
def bpe_ranks(path: str) -> dict[bytes, int]:
    """Byte strings with their ranks, read from a ``.tiktoken`` file on this machine."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def tokenizer_path(name: str) -> str:
    """Where the public vocabulary file lies on the machine that asks."""
    import public_tokenizers

    return public_tokenizers.path(name)


class Memo(dict):
    """Results of ``make`` by its argument, emptied when ``bound`` of them are held and when a partition ends."""

    def __init__(self, make: Callable, bound: int):
        super().__init__()
        self.make, self.bound = make, bound

    def __missing__(self, key):
        if len(self) >= self.bound:
            self.clear()
        value = self[key] = self.make(key)
        return value


def forgetting(fn: Callable[[Batches], Batches], forget: Callable[[], None]) -> Callable[[Batches], Batches]:
    """``fn``, after which what the worker remembers is let go: a reused worker has other stages to run.

    ``forget`` is a function of a module, so that it reaches the worker's own memory.
    """

    def run(batches: Batches) -> Batches:
        try:
            yield from fn(batches)
        finally:
            forget()

    return run


def most_frequent(df: DataFrame, count: str, bound: int) -> DataFrame:
    """About the ``bound`` rows with the largest counts. ``df`` is read twice.

    The cut is found on a histogram with 16 steps for each doubling of the count, so no task sorts rows; of the step
    at the cut a share is taken by hash.
    """
    step = F.floor(16 * F.log2(F.col(count)))
    hist = sorted(((r[0], r[1]) for r in df.groupBy(step.alias("step")).count().collect()), reverse=True)
    left = bound
    for at, n in hist:
        if n > left:
            share = F.pmod(F.xxhash64(*df.columns), F.lit(1 << 20)) < int((left << 20) / n)
            return df.filter((step > at) | ((step == at) & share))
        left -= n
    return df
