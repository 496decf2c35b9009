"""Token counts of whole texts, with overlap resynchronisation for huge ones.

A text up to a chunk's length is encoded as it is. A longer one is cut into overlapping chunks, which Spark deals out
one by one. Each chunk reports its token count and, inside its overlaps, the places where a word of the pre-tokenizer
begins and how many tokens lie before it. A place that two neighbours share is a splice:

* the pre-tokenizer reads from left to right and decides on a word by its characters and the one after them, so a word
  edge that the left chunk found well before its end is an edge of the whole text;
* from an edge on, both the whole text and the right chunk read the same characters, so their tokens agree.

The count is the sum over chunks, less what lies behind the splice in the left and before it in the right chunk.
Documents with an overlap without a common place go another round with longer chunks and overlaps, at last as a whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage
from .common import Batches, map_arrow, narrow, tokenizer_path
from .tokens import encoder, library

CHUNK, OVERLAP = 1 << 15, 1 << 10  # characters; stride is the difference
GUARD = 64  # characters before a chunk's end where edges are not trusted: longer than any special string
WIDEN = 8

_PART = "row long, chunk int, tokens long, pair int, side string, place long, before long"


def _short(batches: Batches, vocabulary: str) -> Batches:
    encode = encoder(tokenizer_path(vocabulary)).encode_batch
    for b in batches:
        texts = b.column("text").to_pylist()
        yield pa.RecordBatch.from_arrays(
            [b.column("doc_id"), pa.array([len(t.encode("utf-8", "surrogatepass")) for t in texts], pa.int64()),
             pa.array([len(x) // 4 for x in encode(texts)], pa.int64())], names=["doc_id", "n_bytes", "n_tokens"])


def _chunks(texts: DataFrame, size: int, overlap: int) -> DataFrame:
    """``row, chunk, start, last, text``: overlapping chunks of each text, the last one as long as it comes out."""
    stride = size - overlap

    def run(batches: Batches) -> Batches:
        for b in batches:
            for row, text in zip(b.column("row").to_pylist(), b.column("text").to_pylist()):
                starts = range(0, max(1, len(text) - overlap), stride)
                for lo in range(0, len(starts), 256):
                    part = starts[lo:lo + 256]
                    yield pa.RecordBatch.from_pydict({
                        "row": pa.array([row] * len(part), pa.int64()),
                        "chunk": pa.array([s // stride for s in part], pa.int32()),
                        "start": pa.array(part, pa.int64()),
                        "last": pa.array([s == starts[-1] for s in part]),
                        "text": pa.array([text[s:s + size] for s in part])})

    return map_arrow(texts, run, "row long, chunk int, start long, last boolean, text string")


def edges(encoding, length: int) -> list[tuple[int, int]]:
    """(character, tokens before it) where a word begins, from an encoding with offsets."""
    out, before = [], None
    for i, (word, (at, _)) in enumerate(zip(encoding.word_ids, encoding.offsets)):
        if word != before or word is None:
            out.append((at, i))
        before = word
    return out


def _encode(chunks: DataFrame, overlap: int, vocabulary: str) -> DataFrame:
    """Per chunk its tokens (chunk set), per edge in an overlap its place (pair, side, place, before set)."""

    def rows(b: pa.RecordBatch, tokenizer) -> Iterator[tuple]:
        cols = [b.column(c).to_pylist() for c in ("row", "chunk", "start", "last", "text")]
        for lo in range(0, b.num_rows, 32):
            part = [c[lo:lo + 32] for c in cols]
            for row, chunk, start, last, text, e in zip(*part, tokenizer.encode_batch(part[4], add_special_tokens=False)):
                yield row, chunk, len(e.ids), None, None, None, None
                if last and not chunk:
                    continue
                found = edges(e, len(text))
                tail = len(text) - overlap
                ends = [at for at, _ in found[1:]] + [len(text)]
                for (at, before), end in zip(found, ends):
                    if chunk and at < overlap:
                        yield row, None, None, chunk, "right", start + at, before
                    if not last and at >= tail and end <= len(text) - GUARD:
                        yield row, None, None, chunk + 1, "left", start + at, len(e.ids) - before

    def run(batches: Batches) -> Batches:
        tokenizer = library(tokenizer_path(vocabulary))
        types = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.string(), pa.int64(), pa.int64()]
        for b in batches:
            out = list(rows(b, tokenizer))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)],
                                                 names=["row", "chunk", "tokens", "pair", "side", "place", "before"])

    return map_arrow(chunks, run, _PART)


def _splice(parts: DataFrame) -> DataFrame:
    """``row, n_tokens``, null where two neighbours share no place."""
    whole = parts.filter("chunk is not null").groupBy("row").agg(
        F.sum("tokens").alias("tokens"), (F.count("*") - 1).alias("pairs"))
    shared = parts.filter("pair is not null").groupBy("row", "pair", "place").agg(
        F.count_if(F.col("side") == "left").alias("l"), F.count_if(F.col("side") == "right").alias("r"),
        F.sum("before").alias("extra")).filter("l = 1 and r = 1")
    cut = shared.groupBy("row", "pair").agg(F.min(F.struct("place", "extra"))["extra"].alias("extra"))
    spliced = cut.groupBy("row").agg(F.sum("extra").alias("extra"), F.count("*").alias("found"))
    return whole.join(spliced, "row", "left").select(
        "row", F.when(F.coalesce("found", F.lit(0)) == F.col("pairs"), F.col("tokens") - F.coalesce("extra", F.lit(0)))
        .alias("n_tokens"))


def count_long(texts: DataFrame, *, vocabulary: str = "byte_bpe_50k.json", size: int = CHUNK, overlap: int = OVERLAP
               ) -> DataFrame:
    """``row, n_tokens`` of texts (row, text) of any length, by chunks. Rows are unique."""
    done, left = None, texts
    while True:
        chunks = _chunks(left, size, overlap)
        # a chunk is the unit of work: the parts of one huge text go to many tasks
        parts = stage(_encode(chunks.repartition("row", "chunk"), overlap, vocabulary), "chunks")
        counts = stage(_splice(parts), "splices")
        good = counts.filter("n_tokens is not null")
        done = good if done is None else done.union(good)
        open_rows = counts.filter("n_tokens is null").select("row")
        if open_rows.isEmpty():
            return done
        left, size, overlap = left.join(open_rows, "row", "left_semi"), size * WIDEN, overlap * WIDEN


def count_tokens(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = "byte_bpe_50k.json",
                 limit: int = 1024, size: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for every row.

    Null and empty texts have no tokens. Ids may be null or repeat: a document is known by ``row``, its place in the
    input, which is written before it is used. Special strings inside texts count as the library's default has it.
    """
    if overlap <= 2 * GUARD or size <= 2 * overlap:
        raise ValueError("need overlap > 128 characters and size > 2 x overlap")
    texts = narrow(docs, id_col, text_col)
    short = texts.filter(F.length("text") <= size).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    counted = map_arrow(short, lambda batches: _short(batches, vocabulary), "doc_id long, n_bytes long, n_tokens long")
    huge = stage(texts.filter(F.length("text") > size).select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text"), "huge")
    if not huge.isEmpty():
        long = count_long(huge.select("row", "text"), vocabulary=vocabulary, size=size, overlap=overlap)
        sizes = huge.select("row", "doc_id", F.octet_length("text").cast("long").alias("n_bytes"))
        counted = counted.union(sizes.join(long, "row").select("doc_id", "n_bytes", "n_tokens"))
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
