"""Vocabulary matching on texts and the word context of each match.

The scan itself runs in an Arrow UDF that receives the text column only and returns small
hit records (see ``dictionary``). Texts stay in the JVM: they are split into words once per text and every
context is cut out of that array, so its cost does not depend on the length of the text.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import words
from ..session import stage
from .dictionary import Dictionary, groups, opened, preferred_terms, write_dictionary
from .intervals import contained, longest_first, uncovered
from .ordered import number_rows


def term_dictionary(vocab: DataFrame, lower: bool = False, carry: tuple[str, ...] = ()) -> DataFrame:
    """One code per term text (the greatest one) with that code's ``carry`` columns, empty terms dropped."""
    text = F.lower("text") if lower else F.col("text")
    best = F.max(F.struct("text_id", *carry))
    return (
        vocab.select("text_id", text.alias("text"), *carry)
        .where("text is not null and text != ''")
        .groupBy("text").agg(best.alias("_t")).select("text", "_t.*")
    )


def open_dictionary(
    vocab: DataFrame, case: bool = True, carry: tuple[str, ...] = (), shards: int | None = None,
) -> Dictionary:
    """Write a vocabulary once, for any number of ``find_terms`` over tables or batches of a stream."""
    return write_dictionary(term_dictionary(vocab, lower=not case, carry=carry), carry, shards)


# --- the scan (runs in Python workers) ---------------------------------------------------


def _word_bounds(text: str) -> tuple[list[int], list[int]]:
    import re

    spans = [m.span() for m in re.finditer(r"\S+", text)]
    return [s for s, _ in spans], [e for _, e in spans]


def _window(text: str, starts: list[int], ends: list[int], start: int, stop: int):
    """How many whole words precede the hit, the cut word before it, and the same after it."""
    whole = bisect_right(ends, start)
    head = text[starts[whole]:start] if whole < len(starts) and starts[whole] < start else ""
    nxt = bisect_left(starts, stop)
    tail = text[stop:ends[nxt - 1]] if nxt and ends[nxt - 1] > stop else ""
    return whole, head, nxt, tail


_SPAN = "term_id string, term string, start int, end int"
_WINDOW = "n_before int, head string, n_after int, tail string"


def _scanner(dictionary: Dictionary, windows: bool):
    """An Arrow UDF text -> hits. What stands around a hit is read off only where something derives from it."""
    carry = dictionary.carry
    fields = [_SPAN, *([_WINDOW] if windows else []), *(f"`{c}` string" for c in carry)]

    @F.arrow_udf(f"array<struct<{', '.join(fields)}>>")
    def scan(texts):
        import numpy as np
        import pyarrow as pa

        matcher, parts = opened(dictionary.path), []
        for first, group in groups(texts.to_pylist()):
            text, start, term = matcher.find(group)
            stop = start + matcher.length[term]
            terms = matcher.table.take(pa.array(term))
            own = {"term_id": terms.column("text_id"), "term": terms.column("text"),
                   "start": pa.array(start, pa.int32()), "end": pa.array(stop - 1, pa.int32())}
            if windows:
                bounds, around = {}, []
                for t, a, b in zip(text.tolist(), start.tolist(), stop.tolist()):
                    if t not in bounds:
                        bounds = {t: _word_bounds(group[t])}
                    around.append(_window(group[t], *bounds[t], a, b))
                kinds = (pa.int32(), pa.string(), pa.int32(), pa.string())
                for name, kind, values in zip(("n_before", "head", "n_after", "tail"), kinds, zip(*around) if around else [()] * 4):
                    own[name] = pa.array(values, kind)
            own |= {c: terms.column(c).cast(pa.string()) for c in carry}
            flat = [v.combine_chunks() if isinstance(v, pa.ChunkedArray) else v for v in own.values()]
            values = pa.StructArray.from_arrays(flat, names=list(own))
            counts = np.bincount(text, minlength=len(group))
            offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
            parts.append(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values))
        return pa.concat_arrays(parts)

    # keeps the optimiser from running the scan a second time inside a pushed-down filter
    return scan.asNondeterministic()


Derive = Callable[[Column, Column], Column]


def find_terms(
    texts: DataFrame, vocab: DataFrame | Dictionary, case: bool = True, normalize: bool = False,
    derive: dict[str, Derive] | None = None, keep_text: bool = False,
    carry: tuple[str, ...] = (), shards: int | None = None,
) -> DataFrame:
    """Every occurrence of every term, inside words and overlapping ones too.

    ``texts`` needs a ``text`` column; its other columns are kept. ``normalize`` squeezes white
    space and lower-cases the text first (then matching ignores case). Adds ``term_id``,
    ``term``, ``start`` and ``end`` (both from 0, end inclusive), the string columns that the vocabulary's
    codes ``carry``, and the ``derive`` columns, made from the hit record and the text's word array.

    The vocabulary is written as a dictionary first; one that ``open_dictionary`` has written, with the same
    case, is used as it is. The texts are read once, by a narrow operation without a shuffle, whatever the number
    of terms. Derived columns are made in the stage of the scan, so neither the text nor its words ever reach a
    join or a shuffle with the hits. Null and empty texts have no hits.
    """
    ignore_case = normalize or not case
    known = vocab if isinstance(vocab, Dictionary) else open_dictionary(vocab, not ignore_case, carry, shards)
    if normalize:
        texts = texts.withColumn("text", F.lower(F.array_join(words("text"), " ")))
    elif ignore_case:
        texts = texts.withColumn("text", F.lower("text"))
    others = [c for c in texts.columns if keep_text or c != "text"]
    base = ["term_id", "term", "start", "end", *known.carry]

    scanned = texts.where(F.col("text").isNotNull()).withColumn("_hits", _scanner(known, bool(derive))(F.col("text")))
    # words are split before the explode: once per text, not once per hit
    held = ["_words"] if derive else []
    if derive:
        scanned = scanned.withColumn("_words", words("text"))
    out = scanned.select(*others, *held, F.explode("_hits").alias("_h"))
    made = [fn(F.col("_h"), F.col("_words")).alias(n) for n, fn in (derive or {}).items()]
    return out.select(*others, *[F.col("_h")[c].alias(c) for c in base], *made)


match_terms = find_terms


def match_preferred(texts: DataFrame, vocab: DataFrame, preferred: DataFrame, **how) -> DataFrame:
    """Matches with their preferred term (pt_code, pt_name); a term without a parent is its own.

    The preferred term travels in the dictionary: a term with a third of all hits meets no join.
    """
    hits = find_terms(texts, preferred_terms(vocab, preferred), carry=("pt_code", "pt_name"), **how)
    return hits.withColumns({"pt_code": F.coalesce("pt_code", "term_id"), "pt_name": F.coalesce("pt_name", "term")})


# --- contexts ----------------------------------------------------------------------------


def _pick(arr: Column, first: Column, n: Column) -> Column:
    """n elements from position ``first`` (from 0) on."""
    return F.when(n > 0, F.slice(arr, first + 1, n)).otherwise(F.array().cast("array<string>"))


def _last(arr: Column, upto: Column, n: Column) -> Column:
    """The n array elements that end at position ``upto``."""
    size = F.least(n, upto)
    return _pick(arr, upto - size, size)


def window_before(h: Column, w: Column, n: Column) -> Column:
    """The n words before a hit; a cut word counts as one."""
    cut = h["head"] != ""
    whole = _last(w, h["n_before"], n - cut.cast("int"))
    return F.when(cut & (n > 0), F.array_append(whole, h["head"])).otherwise(whole)


def window_after(h: Column, w: Column, n: Column) -> Column:
    """The n words after a hit."""
    cut = h["tail"] != ""
    room = F.least(n - cut.cast("int"), F.size(w) - h["n_after"])
    whole = _pick(w, h["n_after"], room)
    return F.when(cut & (n > 0), F.array_prepend(whole, h["tail"])).otherwise(whole)


def context_sizes(term: Column, nwords: int, prop_before: float) -> tuple[Column, Column]:
    """Words to take before and after, at least one each; fractions are cut off."""
    room = F.lit(nwords) - F.lit(2) * F.size(words(term))
    before = (F.lit(float(prop_before)) * room).cast("int")
    after = (F.lit(1 - float(prop_before)) * room).cast("int")
    return F.greatest(before, F.lit(1)), F.greatest(after, F.lit(1))


def _context(term: Column, before: Column, after: Column) -> Column:
    return F.array_join(F.concat(F.array(term), before, F.array(F.lit("EVENT")), after), " ")


def context(nwords: int = 125, prop_before: float = 0.125) -> Derive:
    """Context string of a hit: term, words before, EVENT, words after."""
    def make(h: Column, w: Column) -> Column:
        n_before, n_after = context_sizes(h["term"], nwords, prop_before)
        return _context(h["term"], window_before(h, w, n_before), window_after(h, w, n_after))

    return make


def words_around(text: Column, start: Column, stop: Column, n_before: Column, n_after: Column):
    """Word lists around the span [start, stop) of a text without a prepared word array.

    A stretch of text next to the span is split first; the whole side only where that stretch
    turns out too short (very long words), so the result is exact either way.
    """
    def reach(n: Column) -> Column:
        return n * 16 + 64

    near = reach(n_before)
    left = words(F.substring(text, F.greatest(start - near, F.lit(0)) + 1, F.least(near, start)))
    # one word more than needed: the first one may have been cut
    left = F.when((start <= near) | (F.size(left) > n_before), left).otherwise(
        words(F.substring(text, F.lit(1), start))
    )
    near = reach(n_after)
    right = words(F.substring(text, stop + 1, near))
    right = F.when(F.size(right) > n_after, right).otherwise(
        words(F.substring(text, stop + 1, F.length(text)))
    )
    return _last(left, F.size(left), n_before), F.slice(right, F.lit(1), n_after)


def with_context(matches: DataFrame, nwords: int = 125, prop_before: float = 0.125) -> DataFrame:
    """Context string for any table of (text, term, start, end)."""
    n_before, n_after = context_sizes(F.col("term"), nwords, prop_before)
    before, after = words_around(
        F.col("text"), F.col("start"), F.col("end") + 1, n_before, n_after
    )
    return matches.withColumn("context", _context(F.col("term"), before, after))


def match_contexts(
    texts: DataFrame, vocab: DataFrame, nwords: int = 125, prop_before: float = 0.125, **how
) -> DataFrame:
    """Match and build contexts in one pass over the texts."""
    return find_terms(texts, vocab, derive={"context": context(nwords, prop_before)}, **how)


def number_matches(matches: DataFrame, name: str = "match_id") -> DataFrame:
    """Match numbers from 0 in the order of text, end and start."""
    return number_rows(stage(matches, "matches"), ["text_id", "end", "start"], name, start=0)


# --- training examples -------------------------------------------------------------------

# The example styles 0-15 as
# (replace the term, nonsense word, term in front, source in front, share of words before, random words).
EXAMPLE_STYLES = {
    0: (True, False, True, False, 0.5, False),
    1: (False, False, True, False, 0.5, False),
    2: (True, False, False, False, 0.5, False),
    3: (False, False, False, False, 0.5, False),
    4: (True, True, False, False, 0.5, False),
    5: (False, False, False, False, 0.5, True),
    6: (True, False, True, False, 1.0, False),
    7: (True, False, True, False, 0.0, False),
    8: (True, False, True, False, 0.125, False),
    9: (True, False, True, False, 0.25, False),
    10: (True, False, True, False, 0.75, False),
    11: (True, False, True, False, 0.875, False),
    12: (True, False, True, True, 0.5, False),
    13: (True, False, True, True, 0.25, False),
    14: (True, False, True, True, 0.125, False),
    15: (True, False, True, True, 0.0, False),
}
NONSENSE = "YIHFKEHDK"


# Strides for walking a word list; primes above any usual number of words.
STRIDES = [1000003, 1000033, 1000037, 1000039, 1000081, 1000099, 1000117, 1000121]


def random_words(word_array: Column, n: int, key: Column, seed: int = 222) -> Column:
    """n different words of a text in a seeded shuffled order (all of them for a shorter text).

    A stride that shares no factor with the number of words visits every position once, so n
    words cost n steps whatever the length of the text.
    """
    size = F.size(word_array)
    strides = F.array(*[F.lit(p) for p in STRIDES])
    pick = F.get(strides, F.pmod(F.xxhash64(key, F.lit(seed + 1)), F.lit(len(STRIDES))).cast("int"))
    stride = F.when(size % pick == 0, F.lit(1)).otherwise(pick).cast("bigint")
    first = F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(1 << 31))
    steps = F.sequence(F.lit(1), F.least(size, F.lit(n)))
    place = lambda i: ((first + i.cast("bigint") * stride) % size).cast("int")
    return F.when(size > 0, F.transform(steps, lambda i: F.get(word_array, place(i)))).otherwise(
        F.array().cast("array<string>")
    )


def example(method: int, nwords: int, source: str = "exact", key: str = "text_id") -> Derive:
    """Example string of a hit in one of the 16 styles."""
    if method not in EXAMPLE_STYLES:
        raise ValueError(f"Unknown method {method}. Expected 0-15.")
    replace, nonsense, term_first, source_first, prop, shuffled = EXAMPLE_STYLES[method]

    def make(h: Column, w: Column) -> Column:
        term = h["term"]
        if shuffled:
            ident = F.concat_ws("|", F.col(key), h["start"], h["term_id"])
            return F.array_join(random_words(w, nwords, ident), " ")
        if nwords == 3:
            return term
        n_before, n_after = context_sizes(term, nwords, prop)
        pieces = []
        if term_first:
            pieces.append(F.array(term))
        if source_first:
            pieces.append(F.array(F.lit("exact" if source == "exact" else "split")))
        if prop > 0:
            pieces.append(window_before(h, w, n_before))
        pieces.append(F.array(F.lit(NONSENSE) if nonsense else F.lit("EVENT") if replace else term))
        if prop < 1:
            pieces.append(window_after(h, w, n_after))
        return F.array_join(F.concat(*pieces), " ")

    return make


def match_examples(
    texts: DataFrame, vocab: DataFrame, method: int, nwords: int, name: str = "string",
    source: str = "exact", key: str = "text_id", **how,
) -> DataFrame:
    """Matches with their example string."""
    return find_terms(texts, vocab, derive={name: example(method, nwords, source, key)}, **how)


# --- spans -------------------------------------------------------------------------------


def resolve_overlaps(matches: DataFrame, key: str = "text_id") -> DataFrame:
    """Longest-first choice of matches that do not overlap, per text (see ``intervals.longest_first``)."""
    return longest_first(matches, key)


def find_all(texts: DataFrame, phrase: str) -> DataFrame:
    """All non-overlapping occurrences of one phrase, ignoring case, left to right."""
    n = len(phrase)
    pieces = F.split(F.lower("text"), F.regexp_replace(F.lit(phrase.lower()), r"([^\w\s])", r"\\$1"))
    ends = F.aggregate(
        F.slice("_p", 1, F.size("_p") - 1), F.array().cast("array<int>"),
        lambda acc, p: F.array_append(
            acc, F.coalesce(F.try_element_at(acc, F.lit(-1)) + n, F.lit(0)) + F.length(p)
        ),
    )
    others = [c for c in texts.columns if c != "text"]
    found = texts.withColumn("_p", pieces).where(F.size("_p") > 1).select(
        *others, "text", F.explode(ends).alias("start")
    )
    return found.select(
        *others, "start", (F.col("start") + n).alias("end"),
        F.substring(F.col("text"), F.col("start") + 1, F.lit(n)).alias("term_text"),
    )


def span_coverage(matches: DataFrame, annotations: DataFrame, key: str = "text_id") -> DataFrame:
    """Regions to show for a text: matches, and what free-text annotations add to them.

    A match is ``annotated`` when one annotation contains it. The parts of a free-text
    annotation (``source`` text_select) no match covers become ``freetext`` regions. Both are sweeps over
    the sorted ends of the spans, so a text or a span of any length is cut like any other stretch of rows.
    """
    m = stage(matches.select(
        key, F.col("start").cast("long"), (F.col("end") + 1).cast("long").alias("stop"), F.col("term_id").alias("code"), "term",
    ).distinct(), "matches")
    a = stage(annotations.select(
        key, F.col("start").cast("long"), F.col("end").cast("long").alias("stop"), "term_text", "source",
    ).distinct(), "annotations")
    vocab = contained(m, a, key, "annotated").select(
        key, "start", F.col("stop").alias("end"), F.lit("vocab").alias("type"), "annotated", "code", "term")
    free = a.where("source = 'text_select'").select(key, "start", "stop", "term_text")
    freetext = uncovered(free, m, key).select(
        key, "start", F.col("stop").alias("end"), F.lit("freetext").alias("type"), F.lit(True).alias("annotated"),
        F.lit("").alias("code"), F.col("term_text").alias("term"))
    return vocab.unionByName(freetext)
