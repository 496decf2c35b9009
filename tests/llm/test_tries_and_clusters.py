"""Centroid clustering, the prefix trie and queue BPE against plain versions and the library."""

import hashlib
import random
import zlib
from array import array
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from test_tokens_and_chat import odd_texts
from tokenizers import Tokenizer

from labelspark.llm import bpe_queue, prefix_trie
from labelspark.llm.centroid_clustering import cluster, nearest

JSON = public_tokenizers.path("byte_bpe_50k.json")


# --- centroid clustering

def plain_clusters(rows, k=8, rounds=10, dims=64):
    kept = [(i, [int(np.floor(1024 * float(x))) for x in v]) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and np.isfinite(x) for x in v)]
    mark = lambda r: (hashlib.sha256(f"3:{r[0]}".encode()).hexdigest(), r[1])
    cent = [v for _, v in sorted((r for r in kept if r[0] is not None), key=mark)[:k]]
    if not cent:
        return Counter()
    far = lambda v, c: sum((a - b) ** 2 for a, b in zip(v, c))
    who = lambda v: min((far(v, c), j) for j, c in enumerate(cent))
    for _ in range(rounds):
        groups = defaultdict(list)
        for _, v in kept:
            groups[who(v)[1]].append(v)
        cent = [[sum(x) // len(groups[j]) for x in zip(*groups[j])] if groups[j] else c for j, c in enumerate(cent)]
    got = [(i, *who(v)) for i, v in kept]
    of = Counter()
    for _, d, j in got:
        of[j] += d
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cent]
    return Counter((i, j, d, of[j], sum(of.values()), sha[j]) for i, d, j in got)


def test_clusters_are_the_plain_ones(spark, sf_dir):
    given = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    inf, nan = float("inf"), float("nan")
    odd = [(-1, None), (-2, []), (-3, [0.0] * 63), (-4, [0.0] * 63 + [None]), (-5, [nan] * 64), (-6, [inf] + [0.0] * 63),
           (-7, [0.0] * 64), (-7, [0.0] * 64), (-7, [-0.25] * 64), (None, [0.5] * 64), (-8, [1.0] * 65)]
    both = given.union(spark.createDataFrame(odd, given.schema)).withColumn("cluster", F.lit("own")).withColumn("v", F.lit(1))
    got = Counter(tuple(r) for r in cluster(both).collect())
    assert got == plain_clusters(both.select("vec_id", "embedding").collect())
    few = both.filter("vec_id in (-7, -1)")
    assert Counter(tuple(r) for r in cluster(few).collect()) == plain_clusters(few.select("vec_id", "embedding").collect())
    assert cluster(both.filter("vec_id = -1")).columns == cluster(both).columns and cluster(both.filter("vec_id = -1")).isEmpty()


def test_too_wide_vectors_fail(spark):
    rows = spark.createDataFrame([(1, [2.0 ** 20] * 64)], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="64 bits"):
        cluster(rows).collect()


def test_threshold_algorithm_stops_early_and_keeps_ties():
    rng = np.random.default_rng(1)
    cent = rng.integers(-3000, 3000, (40, 64))
    x = np.concatenate([cent[rng.integers(0, 40, 500)] + rng.integers(-200, 200, (500, 64)), rng.integers(-9, 9, (50, 64))])
    who, best, asked = nearest(x, cent)
    want = ((x[:, None] - cent[None]) ** 2).sum(2)
    assert (best == want.min(1)).all() and (who == want.argmin(1)).all()
    assert asked < 0.9 * want.size
    near = cent[:1] + np.eye(1, 64, dtype=int)
    assert nearest(near, cent[:1])[2] == 1
    small = rng.integers(-1, 2, (300, 3))
    cent = rng.integers(-1, 2, (9, 3))  # many equal distances, and equal centroids
    who, _, _ = nearest(small, cent)
    assert (who == ((small[:, None] - cent[None]) ** 2).sum(2).argmin(1)).all()


# --- prefix trie

def plain_trie(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            mark = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            own[c].append((turn is not None, turn or 0, mark, role, text))
    own = {c: [t[3:] for t in sorted(ts)] for c, ts in own.items()}
    members = defaultdict(list)
    for c, ts in own.items():
        h, g = zlib.crc32(str(c).encode()) % 9, int(c - np.fmod(c, 5))
        path = tuple(own.get(g, [])[:h] + ts[h:])
        for d in range(len(path) + 1):
            members[path[:d]].append((c, len(path) == d))
    kids = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not kids[p]
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1].encode()) if p else 0
    low = {p: min(c for c, _ in m) for p, m in members.items()}
    sha = lambda m: hashlib.sha256(",".join(str(c) for c, e in sorted(m) if e).encode()).hexdigest()
    return Counter((low[p], len(p), low[p[:-1]] if p else None, len(m), kids[p], leaves[p], saved[p], sha(m))
                   for p, m in members.items())


SCHEMA = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("shards", [1, 3, 50])
def test_trie_is_the_plain_one(spark, sf_dir, shards, monkeypatch):
    monkeypatch.setattr(prefix_trie, "PART", 7)
    monkeypatch.setattr(prefix_trie, "SPLITTER_TURNS", 20)
    rng = random.Random(shards)
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    for c in range(1000, 1100):  # one hot conversation, one hot first turn
        rows += [(c, t, "user", f"copy {t}") for t in range(12)]
        rows += [(c + 500, t, rng.choice("ab"), rng.choice("xy")) for t in range(rng.randint(1, 12))]
    rows += [(-7, None, None, None), (-7, 0, "user", "é"), (-7, 0, "user", "é"), (-5, 0, "u", ""), (-6, 3, "u", None), (None, 0, "u", "lost"),
             (777001, 0, "u", "goes"), (777003, None, "", "")]
    rows += [(c, t, "long", "same") for c in (888000, 888005, 888010) for t in range(70)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("path", F.lit("own")).withColumn("node", F.lit(1)).repartition(5)
    got = Counter(tuple(r) for r in prefix_trie.trie(df, least_shards=shards).collect())
    assert got == plain_trie(rows)


def test_trie_of_nothing(spark):
    assert prefix_trie.trie(spark.createDataFrame([], SCHEMA)).isEmpty()
    assert prefix_trie.trie(spark.createDataFrame([(None, 1, "a", "b")], SCHEMA)).isEmpty()
    one = prefix_trie.trie(spark.createDataFrame([(5, 1, "a", "bcd")], SCHEMA)).collect()
    assert Counter(tuple(r) for r in one) == plain_trie([(5, 1, "a", "bcd")])


# --- BPE by a queue

@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(JSON)


def test_queue_is_the_library(spark, odd, docs, library, monkeypatch):
    monkeypatch.setattr(bpe_queue, "PIECE", 40)
    texts = odd_texts() + ["abc " * 9000, "x" * 20_000, "<|endoftext|>" * 3, " <|endoftext|> a<|endoftext|>", "퟿ \U0003d000a 1\U00012550"]
    more = spark.createDataFrame([(-i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    every = odd.select("doc_id", "text").union(more).union(docs.select("doc_id", "text"))
    got = Counter(tuple(r) for r in bpe_queue.encode(every, digests=True).collect())
    want = Counter()
    for i, t in every.collect():
        ids = library.encode(t or "", add_special_tokens=False).ids
        plain = library.decode(ids, skip_special_tokens=False)
        want[i, len(ids), hashlib.sha256(array("I", ids).tobytes()).hexdigest(), hashlib.sha256(plain.encode()).hexdigest()] += 1
    assert got == want
    back = Counter(tuple(r) for r in bpe_queue.decode(bpe_queue.encode(odd)).collect())
    assert back == Counter((i, t or "") for i, t in odd.select("doc_id", "text").collect())
    cut = spark.createDataFrame([(1, array("I", library.encode("é", add_special_tokens=False).ids).tobytes()[:4]), (2, None)], "doc_id long, ids binary")
    assert {r.doc_id: r.text for r in bpe_queue.decode(cut).collect()}[2] is None
    assert bpe_queue.encode(odd.filter("false"), digests=True).isEmpty()


def test_words_are_forgotten(library):
    coder = bpe_queue.Coder(bpe_queue.vocabulary_of(JSON), bound=1000)
    for t in odd_texts(50):
        assert coder.encode(t) == array("I", library.encode(t, add_special_tokens=False).ids).tobytes()
        assert len(coder.words) < 60
