"""BPE encoding with a queue of merge ranks over a linked list of symbols; decoding by joining vocabulary strings.

A word of the pre-tokenizer starts as its bytes' symbols, linked to their neighbours. A queue holds (rank, place) of every
pair that a merge knows. The lowest rank goes first, of equal ranks the leftmost place; a place whose symbols have changed
since is stale and is skipped. A merge writes the new symbol in the left place, unlinks the right one and queues the two
pairs with its neighbours.

Encoding is one narrow stage. A task remembers words that it has encoded, up to a number of bytes.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe_replay import splitter
from .common import Batches, map_arrow, narrow, tokenizer_path
from .tokens import SPLIT

KEPT_BYTES = 48 << 20  # of words that a task remembers
PIECE = 1 << 20  # characters of a text that are split into words at a time
_PLACE = (1 << 32) - 1
_EDGE = re.compile(r"(?<=[!-~]) ")  # a blank after a printable ASCII character: words never reach over its left side


def byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary: itself if it is printable Latin-1, else the
    next free one from 256 on."""
    printable = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    spare = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(spare)) for b in range(256)]


class Vocabulary:
    """Symbols, merges and added strings of a ``.json`` file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        ids, letters = spec["model"]["vocab"], byte_letters()
        plain = {x: bytes([b]) for b, x in enumerate(letters)}
        self.text = {i: b"".join(plain[x] for x in s) for s, i in ids.items() if all(x in plain for x in s)}
        self.byte_ids = [ids[x] for x in letters]
        self.size = max(ids.values()) + 1
        self.rank, self.pair, self.made = {}, [], []
        for r, (a, b) in enumerate(m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]):
            pair = ids[a] * self.size + ids[b]
            self.rank.setdefault(pair, r)
            self.pair.append(pair)
            self.made.append(ids[a + b])
        self.added = {t["content"]: t["id"] for t in spec.get("added_tokens") or ()}
        self.text |= {i: s.encode() for s, i in self.added.items()}
        longest_first = sorted(self.added, key=lambda s: -len(s))
        self.added_pattern = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if longest_first else None

    def encode_word(self, word: bytes) -> list[int]:
        """The symbols that are left when no pair of neighbours can merge."""
        symbols = [self.byte_ids[b] for b in word]
        n, size, rank = len(symbols), self.size, self.rank
        queue = [r << 32 | i for i in range(n - 1) if (r := rank.get(symbols[i] * size + symbols[i + 1])) is not None]
        if not queue:
            return symbols
        heapify(queue)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while queue:
            entry = heappop(queue)
            r, i = entry >> 32, entry & _PLACE
            j = after[i]
            if symbols[i] < 0 or j == n or symbols[i] * size + symbols[j] != self.pair[r]:
                continue  # stale
            new = symbols[i] = self.made[r]
            symbols[j] = -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (r := rank.get(new * size + symbols[k])) is not None:
                    heappush(queue, r << 32 | i)
            h = before[i]
            if h >= 0 and (r := rank.get(symbols[h] * size + new)) is not None:
                heappush(queue, r << 32 | h)
        return [s for s in symbols if s >= 0]


@lru_cache(maxsize=2)
def vocabulary_of(path: str) -> Vocabulary:
    return Vocabulary(path)


class Words(dict):
    """Ids of words, as little-endian unsigned 32-bit bytes, encoded when they are first asked for."""

    def __init__(self, vocabulary: Vocabulary, bound: int = KEPT_BYTES):
        super().__init__()
        self.vocabulary, self.bound, self.used = vocabulary, bound, 0

    def __missing__(self, word: str) -> bytes:
        ids = array("I", self.vocabulary.encode_word(word.encode("utf-8", "surrogatepass"))).tobytes()
        self.used += 4 * len(word) + len(ids) + 200
        self[word] = ids
        return ids

    def rest(self) -> None:
        if self.used > self.bound:
            self.clear()
            self.used = 0


def pieces(text: str) -> Iterator[str]:
    """A long text in parts that end where a word does, so that its words need not be held all at once."""
    at = 0
    while len(text) - at > PIECE:
        edge = _EDGE.search(text, at + PIECE)
        if not edge:
            break
        yield text[at:edge.start()]
        at = edge.start()
    yield text[at:] if at else text


class Coder:
    def __init__(self, vocabulary: Vocabulary, bound: int = KEPT_BYTES):
        self.vocabulary, self.words, self.split = vocabulary, Words(vocabulary, bound), splitter(SPLIT)

    def encode(self, text: str) -> bytes:
        added, pattern = self.vocabulary.added, self.vocabulary.added_pattern
        out, get, split = [], self.words.__getitem__, self.split
        for part in pattern.split(text) if pattern else (text,):
            if part in added:
                out.append(array("I", [added[part]]).tobytes())
                continue
            for piece in pieces(part):
                out.append(b"".join(map(get, split(piece))))
                self.words.rest()
        return b"".join(out)

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.vocabulary.text.__getitem__, array("I", ids)))


def encode(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = "byte_bpe_50k.json",
           digests: bool = False) -> DataFrame:
    """``doc_id, ids`` (unsigned 32-bit, little-endian) of every row, or with ``digests`` the number of ids and what the
    ids and the text decoded from them hash to.

    Added strings inside texts become their own ids, as the vocabulary's library does by default. A null text is an empty
    one, without ids. Ids of documents may be null or repeat: rows are encoded one by one. An empty table gives an empty
    result; other columns are left behind.
    """

    def run(batches: Batches) -> Batches:
        coder = Coder(vocabulary_of(tokenizer_path(vocabulary)))
        for b in batches:
            ids = [coder.encode(t) for t in b.column("text").to_pylist()]
            if not digests:
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(ids, pa.binary())], names=["doc_id", "ids"])
                continue
            sha = [[hashlib.sha256(x).hexdigest() for x in (i, coder.decode(i).decode("utf-8", "replace").encode())] for i in ids]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array([len(i) // 4 for i in ids], pa.int64()),
                 pa.array([x for x, _ in sha], pa.string()), pa.array([x for _, x in sha], pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    texts = narrow(docs, id_col, text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    return map_arrow(texts, run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" if digests
                     else "doc_id long, ids binary")


def decode(encoded: DataFrame, *, vocabulary: str = "byte_bpe_50k.json") -> DataFrame:
    """``doc_id, text`` from ``doc_id, ids``: the vocabulary's strings one after another.

    Null ids give a null text. Bytes that are no UTF-8, as after a cut inside a character, become replacement characters.
    An id outside the vocabulary fails the job.
    """

    def run(batches: Batches) -> Batches:
        coder = Coder(vocabulary_of(tokenizer_path(vocabulary)))
        for b in batches:
            texts = [None if i is None else coder.decode(i).decode("utf-8", "replace") for i in b.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return map_arrow(encoded.select("doc_id", "ids"), run, "doc_id long, text string")
