"""A term dictionary as a table of hashed terms, built by Spark tasks and opened by the tasks that scan texts.

The driver never sees a term. Tasks hash every term and write it to the shared folder; a Python worker reads that table once,
as compact Arrow columns, and scans any number of texts with it.

A term is anchored by its first 16, 8, 4, 2 or 1 characters, the largest of these that it has. A text is scanned in blocks:
sums of its characters times powers of an odd base give the hash of any stretch by one subtraction. At every place the hash
of each anchor length is looked up; the terms of an anchor that is found there are compared by the hash of their whole
length, and what agrees at last by its characters. So the cost of a text depends on its length and its hits, not on the
number of terms.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path

ANCHORS = (16, 8, 4, 2, 1)
BLOCK = 1 << 18  # places of a text that are looked at together
_BASE = 0x9E3779B97F4A7C15
_MIX = np.uint64(0xD6E8FEB86659FD93)
_HASHED = "anchor_size int, anchor long, whole long, size int"


@dataclass(frozen=True)
class Dictionary:
    """Where a written dictionary lies, and the columns that its terms carry besides ``text_id`` and ``text``."""

    path: str
    carry: tuple[str, ...] = ()


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64) + np.uint64(1)


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, modulo 2^64."""
    out = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        steps = np.full(n, base, np.uint64)
        steps[0] = 1
        out.append(np.cumprod(steps, dtype=np.uint64))
    return out[0], out[1]


def _powers_for(n: int) -> tuple[np.ndarray, np.ndarray]:
    return _powers(1 << max(10, (n - 1).bit_length()))


def _sums(codes: np.ndarray) -> np.ndarray:
    power, _ = _powers_for(len(codes) + 1)
    out = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(codes * power[:len(codes)], out=out[1:])
    return out


def _hash_terms(batches):
    for b in batches:
        sizes, anchors, wholes = [], [], []
        for text in b.column("text").to_pylist():
            size = next(a for a in ANCHORS if a <= len(text))
            sums = _sums(_codes(text))
            sizes.append(size)
            anchors.append(sums[size])
            wholes.append(sums[-1])
        columns = [pa.array(sizes, pa.int32()), pa.array(np.array(anchors, np.uint64).view(np.int64)),
                   pa.array(np.array(wholes, np.uint64).view(np.int64)),
                   pa.array([len(t) for t in b.column("text").to_pylist()], pa.int32())]
        yield pa.RecordBatch.from_arrays([*b.columns, *columns],
                                         names=[*b.schema.names, "anchor_size", "anchor", "whole", "size"])


def write_dictionary(terms: DataFrame, carry: tuple[str, ...] = (), shards: int | None = None) -> Dictionary:
    """Hash and write the terms (text, text_id and the ``carry`` columns), each text once and none of them empty."""
    rows = terms.select("text", "text_id", *carry)
    if shards:
        rows = rows.repartition(shards, "text")
    path = scratch_path(terms.sparkSession, "dictionary")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    rows.mapInArrow(_hash_terms, f"{schema}, {_HASHED}").write.parquet(path)
    return Dictionary(path, tuple(carry))


def _read(path: str) -> pa.Table:
    """The table, read by a Python worker from the shared folder."""
    import pyarrow.parquet as pq
    from pyarrow import fs

    path = re.sub(r"^file:/+", "/", path)
    where, path = (fs.LocalFileSystem(), path) if "://" not in path else fs.FileSystem.from_uri(path)
    return pq.read_table(path, filesystem=where).combine_chunks()


class _Anchors:
    """The terms of one anchor length, sorted by anchor, behind a table that tells most places apart at once."""

    def __init__(self, size: int, rows: np.ndarray, anchor: np.ndarray, whole: np.ndarray, length: np.ndarray):
        order = np.argsort(anchor, kind="stable")
        self.size, self.rows, self.anchor, self.whole, self.length = size, rows[order], anchor[order], whole[order], length[order]
        bits = max(12, (32 * len(rows)).bit_length())
        self.shift = np.uint64(64 - min(bits, 26))
        self.some = np.zeros(1 << (64 - int(self.shift)), bool)
        self.some[(self.anchor * _MIX) >> self.shift] = True

    def find(self, sums: np.ndarray, inverse: np.ndarray, places: int) -> tuple[np.ndarray, np.ndarray]:
        """(place, term row) of what agrees in the hash of the whole term."""
        m = min(places, len(sums) - self.size)
        if m <= 0:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        here = (sums[self.size:self.size + m] - sums[:m]) * inverse[:m]
        at = np.flatnonzero(self.some[(here * _MIX) >> self.shift])
        lo, hi = np.searchsorted(self.anchor, here[at], "left"), np.searchsorted(self.anchor, here[at], "right")
        many = hi - lo
        place = np.repeat(at, many)
        term = np.repeat(lo - np.concatenate([[0], np.cumsum(many)[:-1]]) if len(many) else lo, many) + np.arange(len(place))
        fits = place + self.length[term] < len(sums)
        place, term = place[fits], term[fits]
        same = (sums[place + self.length[term]] - sums[place]) * inverse[place] == self.whole[term]
        return place[same], self.rows[term[same]]


class Matcher:
    """An opened dictionary."""

    def __init__(self, table: pa.Table):
        self.table = table
        column = lambda c: table.column(c).to_numpy()
        kind, anchor, whole = column("anchor_size"), column("anchor").view(np.uint64), column("whole").view(np.uint64)
        self.length = column("size").astype(np.int64)
        self.longest = int(self.length.max(initial=1))
        self.kinds = [_Anchors(a, r, anchor[r], whole[r], self.length[r]) for a in ANCHORS if len(r := np.flatnonzero(kind == a))]

    def find(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text number, start, term row) of all hits, by text and end, longer terms first."""
        joined = "".join(texts)
        codes, ends = _codes(joined), np.cumsum([len(t) for t in texts])
        places, terms = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for lo in range(0, len(codes) if self.kinds else 0, BLOCK):
            sums = _sums(codes[lo:lo + BLOCK + self.longest - 1])
            _, inverse = _powers_for(len(sums))
            for kind in self.kinds:
                place, term = kind.find(sums, inverse, BLOCK)
                places.append(place + lo)
                terms.append(term)
        place, term = np.concatenate(places), np.concatenate(terms)
        text = np.searchsorted(ends, place, "right")
        stop = place + self.length[term]
        inside = stop <= ends[text] if len(text) else np.empty(0, bool)
        place, term, text, stop = place[inside], term[inside], text[inside], stop[inside]
        names = self.table.column("text").take(pa.array(term)).to_pylist()
        same = np.fromiter((joined[a:b] == n for a, b, n in zip(place.tolist(), stop.tolist(), names)), bool, len(place))
        place, term, text, stop = place[same], term[same], text[same], stop[same]
        order = np.lexsort((place, stop, text))
        firsts = ends - np.array([len(t) for t in texts], np.int64) if len(texts) else np.empty(0, np.int64)
        return text[order], (place - firsts[text])[order], term[order]


@lru_cache(maxsize=2)
def opened(path: str) -> Matcher:
    """The matcher of a dictionary, once per Python worker."""
    return Matcher(_read(path))


def groups(texts: list[str | None]) -> list[tuple[int, list[str]]]:
    """(number of the first, texts): runs of texts of about one block together; a null text is an empty one."""
    out, first, held = [], 0, 0
    for i, t in enumerate(texts):
        held += len(t or "")
        if held >= BLOCK or i + 1 == len(texts):
            out.append((first, [x or "" for x in texts[first:i + 1]]))
            first, held = i + 1, 0
    return out


def preferred_terms(vocab: DataFrame, preferred: DataFrame) -> DataFrame:
    """The vocabulary with the preferred term (pt_code, pt_name) of each code, and ``code_name``, one name of the code.

    Joined to the terms before texts are scanned, so that hits, of which one code may have a third, need no join.
    """
    one = preferred.groupBy(F.col("llt_code").alias("text_id")).agg(F.max(F.struct("pt_code", "pt_name")).alias("_p"))
    names = vocab.groupBy("text_id").agg(F.max("text").alias("code_name"))
    return vocab.select("text_id", "text").join(names, "text_id", "left").join(one, "text_id", "left").select(
        "text_id", "text", F.col("_p.pt_code").alias("pt_code"), F.col("_p.pt_name").alias("pt_name"), "code_name")
