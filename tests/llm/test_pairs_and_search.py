"""The Jaccard join and the nearest-neighbour search against brute force."""

import random

import numpy as np
import pytest

from labelspark.llm import ann_search, jaccard_join
from labelspark.llm.components import components
from labelspark.llm.jaccard_join import divide_skip, jaccard_classes, required, search_block, shingle_set


def classes_of(texts):
    """{id: (shingles, smallest id reached)} by comparing every pair."""
    sets = {}
    for i, t in texts:
        w = (t or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
        w = [x for x in "".join(" " if c in "\t\n\x0b\f\r" else c for c in w).split(" ") if x]
        sets[i] = {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    head = {i: i for i in sets}

    def find(i):
        while head[i] != i:
            i = head[i]
        return i

    ids = sorted(sets)
    for x, a in enumerate(ids):
        for b in ids[x + 1:]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                p, q = sorted((find(a), find(b)))
                head[q] = p
    return {i: (len(sets[i]), find(i)) for i in ids}


def planted(seed, n_groups, size):
    """Groups of near copies at all distances about the bound, exact copies, and a passage that all share."""
    rng = random.Random(seed)
    passage = " ".join(rng.choice("abcdefghij") * 3 + str(rng.randint(0, 9)) for _ in range(60))
    out = []
    for g in range(n_groups):
        words = [f"w{rng.randint(0, 10**6)}" for _ in range(rng.choice([3, 6, 40, 150]))]
        for _ in range(size):
            copy = words[:]
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 5])):
                copy[rng.randrange(len(copy))] = f"x{rng.randint(0, 10**6)}"
            out.append(" ".join(copy) + (" " + passage if g % 3 == 0 else ""))
    rng.shuffle(out)
    return list(enumerate(out))


@pytest.mark.parametrize("seed,groups,size", [(1, 60, 5), (2, 3, 80)])
def test_classes_against_all_pairs(spark, seed, groups, size):
    texts = planted(seed, groups, size)
    df = spark.createDataFrame(texts, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_classes(df).collect()}
    assert got == classes_of(texts)


def test_classes_on_odd_rows(odd, no_docs):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_classes(odd).collect()}
    assert got[1] == (0, 1) and got[2] == (0, 2) and got[3] == (0, 3)
    assert got[4] == (1, 4) and got[5] == (3, 5) and got[6] == (3, 5) and None not in got
    assert jaccard_classes(no_docs).collect() == []


def test_divide_skip_is_complete():
    rng = np.random.default_rng(4)
    base = np.unique(rng.integers(0, 2**62, 300).astype(np.uint64))
    members = []
    for _ in range(200):
        keep = base[rng.random(len(base)) < rng.uniform(0.7, 1)]
        extra = rng.integers(0, 2**62, rng.integers(0, 60)).astype(np.uint64)
        members.append(np.unique(np.concatenate([keep, extra])))
    want = [i for i, m in enumerate(members) if len(np.intersect1d(base, m)) >= required(len(base), len(m))]
    assert 0 < len(want) < len(members)
    assert sorted(divide_skip(base, members)) == want
    one = shingle_set("a b")
    assert divide_skip(one, [one, shingle_set("b a")]) == [0]


def test_a_block_finds_the_links_between_classes():
    rng = np.random.default_rng(5)
    base = np.unique(rng.integers(0, 2**62, 60).astype(np.uint64))
    rows = []
    for i in range(150):
        kept = base[rng.random(len(base)) < rng.uniform(0.75, 1)]
        rows.append((i, i % 40, np.unique(np.concatenate([kept, rng.integers(0, 2**62, rng.integers(0, 15)).astype(np.uint64)]))))
    linked = [(a, b) for a, _, s in rows for b, _, t in rows
              if a != b and len(np.intersect1d(s, t)) >= required(len(s), len(t))]

    def joined(links):
        head = {c: c for c in range(40)}

        def find(c):
            return c if head[c] == c else find(head[c])

        for a, b in links:
            head[find(a % 40)] = find(b % 40)
        return {frozenset(c for c in head if find(c) == r) for r in map(find, head)}

    got = search_block(rows, rows, False)
    assert set(got) <= set(linked) and joined(got) == joined(linked) and 1 < len(joined(got)) < 40
    assert len(got) < 40, "no pair of classes is linked twice"
    asked = search_block(rows[:1], rows[1:], True)
    assert sorted(asked) == sorted((a, b) for a, b in linked if a == 0)


def test_a_crowded_list_pairs_blocks_and_not_members(spark, monkeypatch):
    """Copies of one template that hardly link with each other: a row for each pair of them would be 88,000 rows."""
    rng = random.Random(6)
    words = [f"t{i}" for i in range(150)]
    texts = []
    for i in range(600):
        copy = words[:]
        for at in rng.sample(range(5, 145), 6 if i % 2 else 3):
            copy[at] = f"x{rng.randint(0, 10**7)}"
        texts.append((i, " ".join(copy)))
    counts = []
    kept = jaccard_join.stage

    def counted(df, name="stage"):
        out = kept(df, name)
        counts.append((out.count(), name))
        return out

    monkeypatch.setattr(jaccard_join, "stage", counted)
    df = spark.createDataFrame(texts, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_classes(df).collect()}
    assert got == classes_of(texts)
    assert max(n for n, name in counts if name in ("pairs", "blocks")) < 12_000, counts


def test_sketches_rule_out_no_link_and_keep_sets_from_travelling(spark):
    from labelspark.llm.jaccard_join import possible, sketch

    rng = np.random.default_rng(8)
    pick = lambda n: rng.integers(0, 2**62, n).astype(np.uint64) << np.uint64(2)
    rows = []
    for i, n in enumerate([0, 1, 2, 9, 230, 256, 257, 290, 512, 600] * 20):
        base = np.random.default_rng(n).integers(0, 2**62, n).astype(np.uint64) << np.uint64(2)
        rows.append((i, i % 7, np.unique(np.concatenate([base[rng.random(n) < 1 - (i % 11) / 30], pick(int(n * (i % 5) / 40))]))))
    small = [(a, c, sketch(s)) for a, c, s in rows]
    for paired in (True, False):
        for q, (a, c, s) in enumerate(rows):
            others = [m for m in rows if m[0] != a]
            found = {b for _, b in search_block([(a, c, s)], others, paired)}
            asks, asked = possible([small[q]], [small[m[0]] for m in others], paired)
            kept = {m[0] for m, k in zip(others, asked) if k}
            assert found <= kept and asks[0] == bool(kept)
    far = [(i, i, sketch(np.unique(pick(400 + i)))) for i in range(60)]
    assert not possible(far[:30], far[30:], True)[1].any()

    texts = [(i, " ".join(f"w{i // 2 * 100 + k}" for k in range(60 + i % 2))) for i in range(40)]  # each is like one other
    block = [(1, 0, 2, 0, i, i, i < 39 and i % 4 < 3) for i in range(40)]
    rows_of = spark.createDataFrame(block, "home_a long, part_a int, home_b long, part_b int, doc_id long, class long, asks boolean")
    left = jaccard_join._narrowed(rows_of, spark.createDataFrame(texts, "doc_id long, text string"))
    assert sorted((r.doc_id, r.asks) for r in left.collect()) == sorted((i, i % 4 == 2) for i in range(40) if i % 4 > 1 and i != 39 and i != 38) + [(38, True), (39, False)]


def test_components_of_a_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101)], "a long, b long")
    got = {r.id: r.component for r in components(links).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}


def nearest(ids, x, queries, k=5):
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    out = {}
    for i in queries:
        s = unit @ unit[ids == i][0]
        s[ids == i] = -9
        out[i] = [int(ids[j]) for j in np.lexsort((ids, -np.round(s, 12)))[:k] if ids[j] != i]
    return out


def test_recall_and_scores(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    pdf = df.select("vec_id", "embedding").toPandas()
    ids, x = pdf["vec_id"].to_numpy(), np.array(pdf["embedding"].tolist(), float)
    asked = [int(i) for i in ids if i % 20 == 0]
    got = {}
    for r in ann_search.search(df, df.filter("vec_id % 20 = 0"), sub_list=300).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    want = nearest(ids, x, asked)
    assert sum(len(set(want[q]) & {v for _, v, _ in got[q]}) for q in asked) >= 0.9 * 5 * len(asked)
    at = {int(i): v for i, v in zip(ids, x)}
    for q in asked:
        rows = sorted(got[q])
        assert [r for r, _, _ in rows] == [1, 2, 3, 4, 5]
        for _, v, s in rows:
            assert abs(s - at[q] @ at[v] / np.linalg.norm(at[q]) / np.linalg.norm(at[v])) < 1e-12


def test_search_ties_and_bad_vectors(spark):
    rows = [(i, [1.0, 0.0]) for i in range(30)] + [(50, [0.0, 1.0]), (51, None), (52, [0.0, 0.0]), (53, [float("nan"), 1.0]),
                                                    (54, [1.0, None]), (None, [1.0, 0.0]), (55, [2.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = {}
    for r in ann_search.search(df, df, sub_list=4, list_size=5).collect():
        got.setdefault(r.query_id, {})[r["rank"]] = r.vec_id
    assert [got[9][k] for k in range(1, 6)] == [0, 1, 2, 3, 4] and [got[2][k] for k in range(1, 6)] == [0, 1, 3, 4, 5]
    assert not {51, 52, 53, 54} & set(got) and None not in got
    assert ann_search.search(df.limit(0), df).collect() == []
    two = df.filter("vec_id in (1, 50)")
    assert sorted((r.query_id, r.vec_id) for r in ann_search.search(two, two, lists=5, list_ratio=9.0).collect()) == [(1, 50), (50, 1)]


def test_template_makes_no_pairs(spark):
    """Documents that share most of their shingles but do not link never meet as pairs."""
    from labelspark.llm import jaccard_join

    shared = " ".join(f"t{i}" for i in range(72))
    docs = spark.createDataFrame([(i, shared + " " + " ".join(f"own{i}x{k}" for k in range(12))) for i in range(300)], "doc_id long, text string")
    seen = []
    keep = jaccard_join._led

    def counted(lists, sizes):
        out = keep(lists, sizes)
        seen.append(out.count())
        return out

    jaccard_join._led = counted
    try:
        got = jaccard_join.jaccard_classes(docs).collect()
    finally:
        jaccard_join._led = keep
    assert all(r.component_id == r.doc_id for r in got) and seen == [0]


def test_sets_travel_only_where_sketches_allow_a_link(spark, monkeypatch):
    rng = random.Random(7)
    rows = []
    for i in range(40):  # pairs alike at about 0.6, so that guides propose them and none links
        words = [f"w{i}x{rng.random()}" for _ in range(400)]
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(words[:300] + [f"v{rng.random()}" for _ in range(100)]))]
    sent, asked = [], []
    search, able = jaccard_join._search, jaccard_join._able
    monkeypatch.setattr(jaccard_join, "_search", lambda r, t: (sent.append(r.count()), search(r, t))[1])
    monkeypatch.setattr(jaccard_join, "_able", lambda p, s: (asked.append(p.count()), able(p, s))[1])
    got = jaccard_join.jaccard_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert all(r.doc_id == r.component_id for r in got) and len(got) == 80
    assert sum(asked) > 0 and sum(sent) == 0
