"""License scans by diagonal voting.

Every rolling three-word hash of every text is joined to the places where the license templates have it. A hit votes
for a diagonal, place in the text less place in the template; neighbouring diagonals, which a few inserted or lost
words drift between, are merged into one candidate, and every window that holds enough of its hits is compared
with the template, word by word. Fixed phrases are counted besides, exactly, in a narrow stage.
"""

from __future__ import annotations

from math import ceil

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import stage
from .common import Batches, map_arrow, narrow
from .jaccard_join import _FACTORS, _inside, id_filter

GRAM = 3
DRIFT = 4  # diagonals this far apart belong to one span
VOTES = 0.4  # share of a template's hashes that a candidate and its window need
ALIKE = 0.8  # share of a template's words that a verified window has, in order

# Phrases that always count, with their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Openings and notices of public licenses, as lower-case words.
TEMPLATES = (
    ("mit", "released under the mit license"),
    ("mit", "licensed under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
            "documentation files the software to deal in the software without restriction"),
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("apache-2.0", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that "
            "the following conditions are met"),
    ("bsd", "released under the bsd license"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
            "public license as published by the free software foundation"),
    ("gpl", "licensed under the gnu general public license"),
    ("lgpl", "licensed under the gnu lesser general public license"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("cc-by", "licensed under cc by 4 0"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is "
            "hereby granted provided that the above copyright notice and this permission notice appear in all copies"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
)

# A-Z to a-z; every other ASCII character that is neither digit nor letter to a blank.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_FOLD).split() if text else []


def gram_hashes(words: list[bytes]) -> np.ndarray:
    """Hash of the ``GRAM`` words from each place on."""
    if len(words) < GRAM:
        return np.empty(0, np.int64)
    w = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = len(w) - GRAM + 1
    h = w[:n] * _FACTORS[0]
    for k in range(1, GRAM):
        h += w[k:k + n] * _FACTORS[k]
    return (h ^ (h >> np.uint64(31))).view(np.int64)


def phrase_places(words: list[bytes], phrases: dict[str, str] = PHRASES) -> list[tuple[int, str]]:
    """(place, label) of every stand of a phrase."""
    out = []
    present = set(words)
    for phrase, label in phrases.items():
        p = phrase.encode().split()
        if present.issuperset(p):
            at = -1
            while True:
                try:
                    at = words.index(p[0], at + 1)
                except ValueError:
                    break
                if words[at:at + len(p)] == p:
                    out.append((at, label))
    return out


def _base(batches: Batches) -> Batches:
    for b in batches:
        rows = []
        for text in b.column("text").to_pylist():
            words = words_of(text)
            places = phrase_places(words)
            at = [p for p, _ in places]
            rows.append((len(words), len(at), min(at, default=None), max(at, default=None), sorted({x for _, x in places})))
        n, k, lo, hi, labels = zip(*rows) if rows else ((),) * 5
        yield pa.RecordBatch.from_arrays(
            [b.column("doc_id"), b.column("key"), *(pa.array(x, pa.int64()) for x in (n, k, lo, hi)),
             pa.array(labels, pa.list_(pa.string()))],
            names=["doc_id", "key", "n_words", "n_base", "first_word", "last_word", "base"])


def _grams(batches: Batches) -> Batches:
    for b in batches:
        keys = b.column("key").to_numpy()
        for lo in range(0, b.num_rows, 200):
            hashes = [gram_hashes(words_of(t)) for t in b.column("text").slice(lo, 200).to_pylist()]
            sizes = [len(h) for h in hashes]
            if sum(sizes):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(keys[lo:lo + 200], sizes)), pa.array(np.concatenate(hashes)),
                     pa.array(np.concatenate([np.arange(n, dtype=np.int32) for n in sizes]))], names=["key", "gram", "place"])


def template_grams(spark: SparkSession, templates=TEMPLATES) -> DataFrame:
    """``gram, template, at``: a few hundred rows, fixed by the templates."""
    rows = [(int(h), t, at) for t, (_, text) in enumerate(templates)
            for at, h in enumerate(gram_hashes(text.encode().split()).tolist())]
    return spark.createDataFrame(rows, "gram long, template int, at int")


def needed(n_words: int) -> int:
    """Votes that a candidate of a template of so many words needs."""
    return ceil(max(1.0, VOTES * (n_words - GRAM + 1)))


def candidates(texts: DataFrame, templates=TEMPLATES) -> DataFrame:
    """``key, template, places``: the places of the hits of merged diagonals that have enough votes."""
    spark = texts.sparkSession
    grams = map_arrow(texts.select("key", "text"), _grams, "key long, gram long, place int")
    hits = grams.join(F.broadcast(template_grams(spark, templates)), "gram")
    # a set: equal rows have one key, and their votes count once
    lines = hits.groupBy("key", "template", (F.col("place") - F.col("at")).alias("diagonal")).agg(
        F.collect_set("place").alias("places"))
    w = Window.partitionBy("key", "template").orderBy("diagonal")
    runs = lines.withColumn("new", (F.col("diagonal") - F.lag("diagonal").over(w) > DRIFT).cast("int")).withColumn(
        "run", F.sum(F.coalesce("new", F.lit(0))).over(w))
    need = F.element_at(F.array(*(F.lit(needed(len(t.split()))) for _, t in templates)), F.col("template") + 1)
    # the hits of one text are no more than its words and the places of a hash in the templates
    return runs.groupBy("key", "template", "run").agg(F.array_distinct(F.flatten(F.collect_list("places"))).alias("places")).filter(
        F.size("places") >= need).select("key", "template", "places")


def alike_windows(have: list[bytes], places: list[int], template: list[bytes], votes: int) -> list[tuple[float, int, int]]:
    """(likeness, start, stop) of every window of the text that holds ``votes`` of the hits and is alike enough.

    Likeness is the longest common subsequence of window and template over the longer one's words, so a window that is
    alike enough is no longer than the template over ``ALIKE``, and none is better than one that starts and stops with words
    of the template. The subsequence grows word by word on a bit mask whose zeros are the template's words in it.
    """
    bits: dict[bytes, int] = {}
    for i, w in enumerate(template):
        bits[w] = bits.get(w, 0) | 1 << i
    n, full, places = len(template), (1 << len(template)) - 1, sorted(places)
    longest = int(n / ALIKE + 1e-9)
    out, first = [], 0
    for start in range(max(places[0] + GRAM - longest, 0), min(places[-1] + 1, len(have))):
        while places[first] < start:
            first += 1
        if first + votes > len(places):
            break
        holds = places[first + votes - 1] + GRAM
        if holds - start > longest or have[start] not in bits:
            continue
        row = full
        for stop, w in enumerate(have[start:start + longest], start + 1):
            if m := bits.get(w):
                both = row & m
                row = ((row + both) | (row - both)) & full
                if stop >= holds and (a := (n - row.bit_count()) / max(n, stop - start)) >= ALIKE:
                    out.append((a, start, stop))
    return out


def best_of(have: list[bytes], spans: list, words: list[list[bytes]], names: list[str]) -> list[tuple[str, float]]:
    """(label, likeness) of the windows that are alike enough and that no better one that counts overlaps."""
    scored = {(a, lo, hi, names[s["template"]]) for s in spans for a, lo, hi in alike_windows(
        have, s["places"], words[s["template"]], needed(len(words[s["template"]])))}
    out, taken = [], {}
    for a, lo, hi, name in sorted(scored, key=lambda x: -x[0]):
        if all(taken.get(k, a) <= a for k in range(lo, hi)):
            out.append((name, a))
            for k in range(lo, hi):
                taken.setdefault(k, a)
    return out


def verified(texts: DataFrame, spans: DataFrame, templates=TEMPLATES) -> DataFrame:
    """``key, labels, score``: the labels of verified spans and how alike the best one is."""
    wanted = texts.sparkSession.sparkContext.broadcast(id_filter(spans.select(F.col("key").alias("doc_id"))))

    def pick(batches: Batches) -> Batches:
        for b in batches:
            keep = _inside(wanted.value, b.column("key").to_numpy())
            if keep.any():
                yield b.filter(pa.array(keep))

    def compare(batches: Batches) -> Batches:
        words = [t.encode().split() for _, t in templates]
        for b in batches:
            keys, labels, scores = [], [], []
            for key, text, spans in zip(*(b.column(c).to_pylist() for c in ("key", "text", "spans"))):
                have = words_of(text)
                if got := best_of(have, spans, words, [name for name, _ in templates]):
                    keys.append(key)
                    labels.append(sorted({x for x, _ in got}))
                    scores.append(max(x for _, x in got))
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(labels, pa.list_(pa.string())),
                                              pa.array(scores, pa.float64())], names=["key", "found", "alike"])

    by_text = spans.groupBy("key").agg(F.collect_list(F.struct("template", "places")).alias("spans"))
    some = map_arrow(texts.select("key", "text"), pick, "key long, text string").dropDuplicates(["key"])
    return map_arrow(some.join(by_text, "key").select("key", "text", "spans"), compare,
                     "key long, found array<string>, alike double")


def scan(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", templates=TEMPLATES) -> DataFrame:
    """``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score`` of every row.

    ``score`` is how alike the best verified span and its template are, 1 where only fixed phrases stand, else 0. A null
    text is an empty one. Ids may be null or repeat: a row is known by a hash of its id and text, and equal rows have
    equal results.
    """
    texts = narrow(docs, id_col, text_col).select(F.col("doc_id").cast("long").alias("doc_id"), "text",
                                                  F.xxhash64("doc_id", "text").alias("key"))
    spans = stage(candidates(texts, templates), "spans")
    found = stage(verified(texts, spans, templates), "verified")
    base = map_arrow(texts, _base, "doc_id long, key long, n_words long, n_base long, first_word long, last_word long, "
                     "base array<string>")
    none = F.array().cast("array<string>")
    return base.join(found, "key", "left").select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base", ",").alias("base_labels"),
        F.array_join(F.sort_array(F.array_union("base", F.coalesce("found", none))), ",").alias("labels"),
        F.coalesce("alike", F.when(F.size("base") > 0, 1.0).otherwise(0.0)).alias("score"))
