"""Token ids of whole texts as the ``tokenizers`` library gives them for a byte-level BPE file."""

from __future__ import annotations

import os
import re
from array import array
from functools import cache

import regex

# Fixed value: the split that the vocabulary's byte-level pre-tokenizer makes.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# From this character on, the library's tables of letters and digits and ours may be of different Unicode versions.
NEWER = 0x530
_NEWER = re.compile(f"[{chr(NEWER)}-\U0010ffff]")
LONG_BLANK = 10_000  # characters of a run of blanks that only the library splits: the other backs up over the run on a stack
_LONG_BLANK = re.compile(r"\s{%d}" % LONG_BLANK)


def _ranges(kind: str) -> str:
    """The characters below ``NEWER`` of a regex class, as ranges for a character class of ``re``."""
    of, out = regex.compile(kind), []
    for c in range(NEWER):
        if of.match(chr(c)):
            if out and out[-1][1] == c - 1:
                out[-1][1] = c
            else:
                out.append([c, c])
    return "".join(f"\\u{a:04x}-\\u{b:04x}" for a, b in out)


@cache
def older_split() -> re.Pattern:
    """``SPLIT`` for texts below ``NEWER``, with its classes spelt out: ``re`` reads it twice as fast."""
    text = SPLIT.replace(r"[^\s\p{L}\p{N}]", "[^{s}{l}{n}]").replace(r"(?!\S)", "(?![^{s}])")
    text = text.replace(r"\s", "[{s}]").replace(r"\p{L}", "[{l}]").replace(r"\p{N}", "[{n}]")
    return re.compile(text.format(s=_ranges(r"\s"), l=_ranges(r"\p{L}"), n=_ranges(r"\p{N}")))


def is_older(text: str) -> bool:
    return text.isascii() or not _NEWER.search(text)


def library(path: str):
    """The tokenizer of a ``.json`` file, on one thread: Spark spreads the work."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    os.environ.setdefault("RAYON_NUM_THREADS", "1")
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def _by_ranks(path: str):
    """A function from a text to its ids by ``tiktoken``, which reads whole texts several times as fast.

    It takes ids for ranks, so it serves vocabularies whose merges come in the order of the ids they make; for others there
    is none.
    """
    import tiktoken

    from .bpe_queue import Vocabulary

    v = Vocabulary(path)
    if any(a >= b for a, b in zip(v.made, v.made[1:])):
        return None
    ranks = {text: i for i, text in v.text.items() if i not in v.added.values()}
    return tiktoken.Encoding("words", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


class Encoder:
    """Ids of whole texts, as little-endian unsigned 32-bit bytes.

    Texts that hold a special string, characters on whose class two Unicode versions may differ, or a run of blanks that
    is too long for the other library's split go to ``tokenizers``; all others are merged by ranks. Nothing is remembered
    from text to text.
    """

    def __init__(self, path: str):
        self.tokenizer = library(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.merge = _by_ranks(path)

    def plain(self, text: str) -> bool:
        return (self.merge is not None and is_older(text) and not any(s in text for s in self.special)
                and not (len(text) >= LONG_BLANK and _LONG_BLANK.search(text)))

    def encode(self, text: str | None) -> bytes:
        """The ids of a text; a null text has none."""
        if not text:
            return b""
        ids = self.merge(text) if self.plain(text) else self.tokenizer.encode(text, add_special_tokens=False).ids
        return array("I", ids).tobytes()

    def encode_batch(self, texts: list[str | None]) -> list[bytes]:
        return [self.encode(t) for t in texts]


@cache
def encoder(path: str) -> Encoder:
    """The encoder of a file, kept for the life of the Python worker."""
    return Encoder(path)
