"""Byte-level BPE encoding and decoding by corpus-level merge replay.

1. The words of all texts are counted, by task and then by Spark. The most frequent ones, a bounded table, are dealt
   into blocks; in each block an inverted index from token pair to word positions replays the merges.
2. The encoded words travel to the tasks that encode the texts. Words beyond the bound are replayed in the same way,
   over the distinct words of a batch; so every word is exact, and the bound is only a matter of speed.

A replay looks at each merge once, in rank order, for all words at once: the index gives the places where the pair
stands, the two tokens become one, and only the pairs with its two neighbours are entered anew.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from array import array
from collections import Counter
from functools import lru_cache
from itertools import chain

import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage
from .common import Batches, bpe_ranks, map_arrow, most_frequent, narrow, tokenizer_path
from .tokens import SPLIT, is_older, older_split

MAX_WORDS = 1 << 19  # words in the table that every task gets: some 20 MB at most
MAX_WORD_BYTES = 64  # longer words are replayed where they occur
SLICE = 4_000_000  # bytes of text whose words a task holds at once
KEPT = 300_000  # words that a task remembers beyond the table


@lru_cache(maxsize=2)
def merges(path: str) -> tuple[dict[bytes, int], dict[int, bytes]]:
    ranks = bpe_ranks(path)
    return ranks, {v: k for k, v in ranks.items()}


def replay(words: list[bytes], ranks: dict[bytes, int]) -> list[list[int]]:
    """Token ids of every word, all merges applied in rank order over all words at once.

    Tokens stand in one flat list with links to their neighbours; ``places`` is the index from a pair of tokens to the
    positions of its left token. A merge takes the positions of its pair from left to right, so that overlapping pairs
    such as those of ``aaa`` merge in the order of the text, and a position whose pair has changed is passed over.
    """
    token: list[int] = []
    left: list[int] = []
    right: list[int] = []
    single = [ranks[bytes([i])] for i in range(256)]
    text = {r: b for b, r in ranks.items()}
    places: dict[tuple[int, int], list[int]] = {}
    starts = []
    for w in words:
        at = len(token)
        starts.append(at)
        n = len(w)
        token.extend([single[c] for c in w])
        left.extend(range(at - 1, at + n - 1))
        right.extend(range(at + 1, at + n + 1))
        if n:
            left[at], right[at + n - 1] = -1, -1
        for i in range(at, at + n - 1):
            places.setdefault((token[i], token[i + 1]), []).append(i)
    queue = []
    for pair in places:
        rank = ranks.get(text[pair[0]] + text[pair[1]])
        if rank is not None:
            queue.append((rank, pair))
    heapq.heapify(queue)
    while queue:
        new, pair = heapq.heappop(queue)
        a, b = pair
        touched: dict[tuple[int, int], list[int]] = {}
        for i in sorted(places.pop(pair, ())):
            j = right[i]
            if token[i] != a or j < 0 or token[j] != b:
                continue
            k, h = right[j], left[i]
            token[i], token[j], right[i] = new, -1, k
            if k >= 0:
                left[k] = i
                touched.setdefault((new, token[k]), []).append(i)
            if h >= 0:
                touched.setdefault((token[h], new), []).append(h)
        for fresh, where in touched.items():
            known = places.get(fresh)
            if known is not None:
                known.extend(where)
                continue
            places[fresh] = where
            rank = ranks.get(text[fresh[0]] + text[fresh[1]])
            if rank is not None:
                heapq.heappush(queue, (rank, fresh))
    out = []
    for at, w in zip(starts, words):
        ids, i = [], at if w else -1
        while i >= 0:
            ids.append(token[i])
            i = right[i]
        out.append(ids)
    return out


# Letters and digits newer than Unicode 16, the version that the reference tokenizer library splits by;
# there they count as symbols.
LATER = (
    "558 58b-58c 88f c5c cdc 208f 209d-209f a7ce-a7cf a7d2 a7d4 a7dd a7e2 a7f1 ab6c-ab6d 107bb-107bf "
    "10940-10959 10ec5-10ec7 10ed9-10eee 11b0a 11db0-11ddb 11de0-11de9 11df1 1246f 12475-1247f "
    "12550-12686 16ea0-16eb8 16ebb-16ed3 16ff2-16ff3 16ff4-16ff6 187f8-187ff 18cd6-18cda 18d09-18d20 "
    "18d80-18df2 18e00-19191 191a0-191d2 1b123-1b128 1b168 1d6a6 1df1f-1df24 1df2b-1df81 1df90-1df96 "
    "1dfcd-1dfff 1e6c0-1e6de 1e6e0-1e6e2 1e6e4-1e6e5 1e6e7-1e6ed 1e6f0-1e6f4 1e6fe-1e6ff 2b73a-2b73f "
    "2b81e 2cea2-2cead 323b0-33479 3d000-3fc3f "
)
_LATER = re.compile("[" + "".join("-".join(chr(int(x, 16)) for x in part.split("-")) for part in LATER.split()) + "]")


def splitter(pattern: str):
    """The function that splits a text into the matches of a pattern."""
    own = regex.compile(pattern).findall
    older = older_split().findall if pattern == SPLIT else None

    def split(text: str) -> list[str]:
        if older and is_older(text):
            return older(text)
        if not _LATER.search(text):
            return own(text)
        out, at = [], 0
        for part in own(_LATER.sub("!", text)):
            out.append(text[at:at + len(part)])
            at += len(part)
        return out

    return split


def _pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def _count(batches: Batches, pattern: str) -> Batches:
    """Words of a task's texts with how often they occur; the tally is emptied before it grows large."""
    findall, tally = splitter(pattern), Counter()

    def out() -> pa.RecordBatch:
        words = [w.encode("utf-8", "surrogatepass") for w in tally]
        return pa.RecordBatch.from_arrays([pa.array(words, pa.binary()), pa.array(list(tally.values()), pa.int64())],
                                          names=["word", "seen"])

    for b in batches:
        for text in b.column(0).to_pylist():
            tally.update(findall(text))
        if len(tally) > KEPT:
            yield out()
            tally.clear()
    if tally:
        yield out()


def encoded_words(texts: DataFrame, vocabulary: str, pattern: str, max_words: int = MAX_WORDS) -> dict[str, bytes]:
    """The ids (unsigned 32-bit) of the most frequent words of the corpus, about ``max_words`` of them:
    the cut lies on a histogram of the counts, so no task sorts words."""
    counts = map_arrow(texts.select("text"), lambda bs: _count(bs, pattern), "word binary, seen long")
    counted = (counts.filter(F.octet_length("word") <= MAX_WORD_BYTES).groupBy("word").agg(F.sum("seen").alias("seen"))
               .filter("seen > 1"))
    top = most_frequent(stage(counted, "words"), "seen", max_words)
    blocks = top.select("word").repartition(16, F.xxhash64("word"))

    def run(batches: Batches) -> Batches:
        ranks, _ = merges(tokenizer_path(vocabulary))
        words = [w for b in batches for w in b.column(0).to_pylist()]
        ids = [array("I", x).tobytes() for x in replay(words, ranks)]
        yield pa.RecordBatch.from_arrays([pa.array(words, pa.binary()), pa.array(ids, pa.binary())], names=["word", "ids"])

    got = map_arrow(blocks, run, "word binary, ids binary").toArrow()
    return {w.decode("utf-8", "surrogatepass"): i for w, i in zip(got.column("word").to_pylist(), got.column("ids").to_pylist())}


def slices(batches: Batches) -> Batches:
    """The rows in batches of at most ``SLICE`` bytes of text, or of one row: the words of a batch are all in memory."""
    for b in batches:
        sizes = pc.fill_null(pc.binary_length(b.column("text")), 0).to_pylist()
        at = held = 0
        for i, n in enumerate(sizes):
            if i > at and held + n > SLICE:
                yield b.slice(at, i - at)
                at, held = i, 0
            held += n
        if at < len(sizes):
            yield b.slice(at)


class Coder:
    """Encodes texts with the shared table and, for other words, by replay over the words of a batch."""

    def __init__(self, vocabulary: str, pattern: str, table: dict[str, bytes]):
        self.ranks, self.text = merges(tokenizer_path(vocabulary))
        self.findall, self.table, self.own = splitter(pattern), table, {}

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        if len(self.own) > KEPT:
            self.own.clear()
        table, own, out, held = self.table, self.own, [], []
        for text in texts:
            words = self.findall(text)
            known = list(map(table.get, words))
            if None not in known:
                out.append(b"".join(known))
                continue
            # only words beyond the table are kept until the batch is replayed
            held.append((len(out), known, {i: words[i] for i, ids in enumerate(known) if ids is None}))
            out.append(b"")
        missing = [w for w in set(chain.from_iterable(beyond.values() for _, _, beyond in held)) if w not in own]
        for w, ids in zip(missing, replay([w.encode("utf-8", "surrogatepass") for w in missing], self.ranks)):
            own[w] = array("I", ids).tobytes()
        for at, known, beyond in held:
            for i, w in beyond.items():
                known[i] = own[w]
            out[at] = b"".join(known)
        return out

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.text.__getitem__, array("I", ids)))


def encode(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = "byte_bpe_50k.tiktoken",
           pattern: str | None = None, digests: bool = False) -> DataFrame:
    """``doc_id, ids`` (unsigned 32-bit, little-endian) of every row, or with ``digests`` what the ids and the text
    decoded from them hash to.

    A null text is an empty one, without ids. Ids of documents may be null or repeat; rows are encoded one by one.
    """
    pattern = pattern or _pattern()
    texts = narrow(docs, id_col, text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    shared = texts.sparkSession.sparkContext.broadcast(encoded_words(texts, vocabulary, pattern))

    def run(batches: Batches) -> Batches:
        coder = Coder(vocabulary, pattern, shared.value)
        names = {x: str(x) for x in coder.text} if digests else {}
        for b in slices(batches):
            ids = coder.encode_batch(b.column("text").to_pylist())
            if not digests:
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(ids, pa.binary())], names=["doc_id", "ids"])
                continue
            n, codes, plain = [], [], []
            for raw in ids:
                a = array("I", raw)
                n.append(len(a))
                codes.append(hashlib.sha256(" ".join(map(names.__getitem__, a)).encode()).hexdigest())
                plain.append(hashlib.sha256(coder.decode(raw)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(n, pa.int64()), pa.array(codes, pa.string()), pa.array(plain, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return map_arrow(texts, run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" if digests
                     else "doc_id long, ids binary")


def decode(encoded: DataFrame, *, vocabulary: str = "byte_bpe_50k.tiktoken") -> DataFrame:
    """``doc_id, bytes`` from ``doc_id, ids``. Null ids give null; an id outside the vocabulary fails the job."""

    def run(batches: Batches) -> Batches:
        _, text = merges(tokenizer_path(vocabulary))
        for b in batches:
            out = [None if raw is None else b"".join(map(text.__getitem__, array("I", raw))) for raw in b.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(out, pa.binary())], names=["doc_id", "bytes"])

    return map_arrow(encoded.select("doc_id", "ids"), run, "doc_id long, bytes binary")
