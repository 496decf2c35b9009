"""Matching, contexts, examples and spans: fixed expectations and brute force."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from helpers import rows
from labelspark.operators import match as M

TERMS = [("1", "foo"), ("2", "bar"), ("3", "baz"), ("4", "zab")]


@pytest.fixture(scope="module")
def vocab(spark):
    return spark.createDataFrame(TERMS, "text_id string, text string")


@pytest.mark.parametrize("text, expected", [
    ("baz", [("3", 0, 2)]),
    ("bar baz", [("2", 0, 2), ("3", 4, 6)]),
    ("foo bar baz", [("1", 0, 2), ("2", 4, 6), ("3", 8, 10)]),
    ("foobazab", [("1", 0, 2), ("3", 3, 5), ("4", 5, 7)]),
    ("", []), ("nothing", []),
])
def test_positions(spark, vocab, text, expected):
    texts = spark.createDataFrame([("t", text)], "text_id string, text string")
    assert rows(M.match_terms(texts, vocab), "term_id", "start", "end") == expected


@pytest.mark.parametrize("text, term, start, end, nwords, prop, expected", [
    ("foo bar baz", "bar", 4, 6, 1, 0.5, "bar foo EVENT baz"),
    ("foo bar baz", "bar", 4, 6, 1, 0.15, "bar foo EVENT baz"),
    ("foo bar baz", "baz", 8, 10, 1, 0.5, "baz bar EVENT"),
    ("a b bar c d", "bar", 4, 6, 6, 0.5, "bar a b EVENT c d"),
    ("a b c bar d e f", "bar", 6, 8, 6, 0.5, "bar b c EVENT d e"),
    ("a b c bar d e f", "bar", 6, 8, 6, 0.75, "bar a b c EVENT d"),
])
def test_context_golden(spark, vocab, text, term, start, end, nwords, prop, expected):
    df = spark.createDataFrame([(text, term, start, end)], "text string, term string, start int, end int")
    assert M.with_context(df, nwords, prop).first()["context"] == expected
    texts = spark.createDataFrame([("t", text)], "text_id string, text string")
    found = M.match_contexts(texts, vocab, nwords, prop).where((F.col("term") == term) & (F.col("start") == start))
    assert found.first()["context"] == expected


def test_end_to_end_numbers(spark, vocab):
    texts = spark.createDataFrame([
        ("1", "qux mux lux foo abc def ghi"), ("2", "qux mux lux foobarbaz abc def ghi")], "text_id string, text string")
    got = rows(M.number_matches(M.match_contexts(texts, vocab, 1, 0.5)), "match_id", "text_id", "context")
    assert got == [
        (0, "1", "foo lux EVENT abc"), (1, "2", "foo lux EVENT barbaz"),
        (2, "2", "bar foo EVENT baz"), (3, "2", "baz foobar EVENT abc")]


def naive_context(text, term, start, nwords, prop):
    n = len(term.split())
    nb = max(int(prop * (nwords - 2 * n)), 1)
    na = max(int((1 - prop) * (nwords - 2 * n)), 1)
    return " ".join([term] + text[:start].split()[-nb:] + ["EVENT"] + text[start + len(term):].split()[:na])


@settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(alphabet="ab é　\n\x1cz", max_size=40), min_size=1, max_size=6),
       st.lists(st.text(alphabet="ab é", min_size=1, max_size=4), min_size=1, max_size=5, unique=True))
def test_automaton_equals_naive_search(spark, texts, terms):
    """Overlapping hits, hits inside words, Unicode blanks; contexts too."""
    tdf = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "text_id string, text string")
    vdf = spark.createDataFrame([(t, t) for t in terms], "text_id string, text string")
    want = sorted(
        (str(i), w, p, naive_context(t, w, p, 6, 0.5))
        for i, t in enumerate(texts) for w in terms for p in range(len(t)) if t.startswith(w, p))
    assert rows(M.match_contexts(tdf, vdf, 6, 0.5), "text_id", "term", "start", "context") == want
    hits = M.find_terms(tdf, vdf, keep_text=True, shards=3)
    assert rows(M.with_context(hits, 6, 0.5), "text_id", "term", "start", "context") == want


def plain_hits(text, terms):
    """(start, term) of every occurrence, by looking up every stretch of a known length."""
    lengths = {len(t) for t in terms}
    return sorted((i, text[i:i + n]) for i in range(len(text)) for n in lengths if i + n <= len(text) and text[i:i + n] in terms)


@settings(max_examples=60, deadline=None)
@given(st.sets(st.text("ab\U0001f600 é", min_size=1, max_size=20), max_size=30), st.lists(st.text("ab\U0001f600 é", max_size=60), max_size=6))
def test_dictionary_is_exact(terms, texts):
    import pyarrow as pa

    from labelspark.operators import dictionary as D

    terms = sorted(terms)
    names = ["text", "text_id"]
    rows = pa.RecordBatch.from_arrays([pa.array(terms, pa.string()), pa.array(terms, pa.string())], names=names)
    table = pa.Table.from_batches(list(D._hash_terms([rows])))
    block, D.BLOCK = D.BLOCK, 7
    try:
        matcher, got = D.Matcher(table), []
        for first, group in D.groups(texts):
            text, start, term = matcher.find(group)
            got += [(first + t, s, terms[k]) for t, s, k in zip(text.tolist(), start.tolist(), term.tolist())]
    finally:
        D.BLOCK = block
    assert sorted(got) == sorted((i, s, t) for i, x in enumerate(texts) for s, t in plain_hits(x, set(terms)))
    ends = [(i, s + len(t), s) for i, s, t in got]
    assert ends == sorted(ends)


def test_many_terms_one_scan(spark, sf_dir):
    """100,000 terms and more, found in one reading of the texts; no term passes through the driver."""
    from labelspark.operators import match

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").limit(60)
    words = sorted({w for r in docs.collect() for w in (r.text or "").split()})
    terms = sorted({f"{a} {b}" for a in words[:400] for b in words[:260]} | set(words))
    assert len(terms) > 100_000
    vocab = spark.createDataFrame([(str(i), t) for i, t in enumerate(terms)], "text_id string, text string").repartition(4)
    known = match.open_dictionary(vocab, shards=3)
    found = match.find_terms(docs, known)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Join" not in plan
    want = sorted((r.doc_id, s, t) for r in docs.collect() for s, t in plain_hits(r.text or "", set(terms)))
    assert sorted(tuple(r) for r in found.select("doc_id", "start", "term").collect()) == want and len(want) > 1000


def test_preferred_terms_travel_with_hits(spark):
    vocab = spark.createDataFrame([("1", "foo"), ("2", "bar"), ("2", "barn")], "text_id string, text string")
    preferred = spark.createDataFrame([("1", "9", "Foo disease"), ("1", "8", "Other")], "llt_code string, pt_code string, pt_name string")
    texts = spark.createDataFrame([("t", "Foo bar"), ("n", None), ("e", "")], "text_id string, text string")
    got = rows(M.match_preferred(texts, vocab, preferred, case=False), "term", "pt_code", "pt_name")
    assert got == [("bar", "2", "bar"), ("foo", "9", "Foo disease")]


def test_one_code_per_term(spark):
    vocab = spark.createDataFrame([("1", "foo"), ("2", "foo"), ("3", "Foo")], "text_id string, text string")
    texts = spark.createDataFrame([("t", "a Foo foo")], "text_id string, text string")
    assert rows(M.match_terms(texts, vocab), "term_id", "start") == [("2", 6), ("3", 2)]
    assert rows(M.match_terms(texts, vocab, case=False), "term_id", "start") == [("3", 2), ("3", 6)]


EXAMPLE = "the patient reported severe headache and nausea after treatment"


@pytest.mark.parametrize("method, check", [
    (0, lambda s: s.startswith("headache") and "EVENT" in s),
    (3, lambda s: "EVENT" not in s and "headache" in s),
    (4, lambda s: "YIHFKEHDK" in s and "EVENT" not in s),
    (6, lambda s: s.endswith("EVENT") and "severe" in s),
    (7, lambda s: s.startswith("headache EVENT and nausea") and "severe" not in s),
    (14, lambda s: s.startswith("headache exact ") and "EVENT" in s),
])
def test_example_styles(spark, method, check):
    texts = spark.createDataFrame([("t", EXAMPLE)], "text_id string, text string")
    vocab = spark.createDataFrame([("1", "headache")], "text_id string, text string")
    assert check(M.match_examples(texts, vocab, method, 20).first()["string"])
    assert M.match_examples(texts, vocab, 0, 3).first()["string"] == "headache"


def test_random_words_are_a_sample_of_positions(spark):
    texts = spark.createDataFrame([("t", EXAMPLE)], "text_id string, text string")
    vocab = spark.createDataFrame([("1", "headache")], "text_id string, text string")
    five = M.match_examples(texts, vocab, 5, 5).first()["string"].split()
    assert len(five) == 5 and len(set(five)) == 5 and set(five) <= set(EXAMPLE.split())
    assert sorted(M.match_examples(texts, vocab, 5, 99).first()["string"].split()) == sorted(EXAMPLE.split())
    with pytest.raises(ValueError):
        M.example(16, 20)


def greedy(spans):
    kept = []
    for s in sorted(spans, key=lambda m: (-(m[1] - m[0]), m[1])):
        if all(s[1] < k[0] or k[1] < s[0] for k in kept):
            kept.append(s)
    return sorted(kept)


@settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.sets(st.tuples(st.integers(0, 1), st.integers(0, 60), st.integers(1, 9)), min_size=1, max_size=40))
def test_resolve_overlaps(spark, raw):
    spans = [(str(k), f"{a}-{n}", a, a + n - 1) for k, a, n in raw]
    df = spark.createDataFrame(spans, "text_id string, term string, start int, end int")
    got = rows(M.resolve_overlaps(df), "text_id", "start", "end")
    want = sorted((k, a, b) for k in ("0", "1") for a, b in greedy([(s[2], s[3]) for s in spans if s[0] == k]))
    assert got == want


def test_resolve_one_long_stretch(spark, monkeypatch):
    """Spans that all touch: borders lie inside the stretch, and decisions pass over them."""
    from labelspark.operators.intervals import longest_first

    df = spark.range(20_000).select(F.lit("t").alias("text_id"), F.lit("x").alias("term"), F.col("id").cast("int").alias("start"),
                                    (F.col("id") + 2 + F.when(F.col("id") % 97 == 0, 3).otherwise(0)).cast("int").alias("end"))
    want = greedy([(r.start, r.end) for r in df.collect()])
    for cell in (256, 1 << 16):
        assert rows(longest_first(df, cell=cell), "start", "end") == want
    long = spark.createDataFrame([("t", "w", 0, 5000), ("t", "a", 10, 20), ("t", "b", 4990, 5010), ("u", "a", 1, 2)],
                                 "text_id string, term string, start int, end int")
    assert rows(longest_first(long, cell=64), "text_id", "start") == [("t", 0), ("u", 1)]
    assert longest_first(long.where("false")).isEmpty()


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(0, 1), st.integers(0, 900), st.integers(0, 700)), max_size=25),
       st.lists(st.tuples(st.sampled_from([0, 1, None]), st.integers(0, 1700)), min_size=1, max_size=25))
def test_value_at(spark, spans, points):
    from labelspark.operators.intervals import value_at

    intervals = spark.createDataFrame([(k, a, a + n, f"v{i % 5}") for i, (k, a, n) in enumerate(spans)], "k int, start int, stop int, v string")
    df = spark.createDataFrame([(i, k, p) for i, (k, p) in enumerate(points)], "i int, k int, p int")
    want = []
    for i, (k, p) in enumerate(points):
        holds = [(a, a + n, f"v{j % 5}") for j, (x, a, n) in enumerate(spans) if x == k and a <= p < a + n]
        want.append((i, min(holds)[2] if holds else "human"))
    assert rows(value_at(df, intervals, ["k"], "p", "v", "human", hot=3), "i", "v") == sorted(want)


@settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(0, 1), st.integers(0, 150), st.integers(1, 30)), min_size=1, max_size=20),
       st.lists(st.tuples(st.integers(0, 1), st.integers(0, 150), st.integers(0, 60)), min_size=1, max_size=12))
def test_coverage_by_sweeps(spark, covers, spans):
    from labelspark.operators.intervals import contained, uncovered

    a = spark.createDataFrame([(k, s, s + n, str(i)) for i, (k, s, n) in enumerate(spans)], "k int, start long, stop long, name string")
    b = spark.createDataFrame([(k, s, s + n) for k, s, n in covers], "k int, start long, stop long")
    want = []
    for i, (k, s, n) in enumerate(spans):
        free = [p for p in range(s, s + n) if not any(x == k and c <= p < c + m for x, c, m in covers)]
        runs = [p for p in free if p - 1 not in free]
        want += [(str(i), p, next(q for q in range(p, s + n + 1) if q not in free)) for p in runs]
    assert rows(uncovered(a, b, "k", width=16), "name", "start", "stop") == sorted(want)
    holds = sorted((str(i), any(x == k and c <= s and s + n <= c + m for x, c, m in covers)) for i, (k, s, n) in enumerate(spans))
    assert rows(contained(a, b, "k", "in"), "name", "in") == holds


def test_find_all(spark):
    df = spark.createDataFrame([("t", "Aa aAa (x) aa")], "k string, text string")
    assert rows(M.find_all(df, "AA"), "start", "end", "term_text") == [(0, 2, "Aa"), (3, 5, "aA"), (11, 13, "aa")]
    assert rows(M.find_all(df, "(X)"), "start", "term_text") == [(7, "(x)")]


def test_span_coverage(spark):
    m = spark.createDataFrame([("t", "1", "abc", 10, 12), ("t", "2", "de", 20, 21), ("t", "3", "far", 900, 902)],
                              "text_id string, term_id string, term string, start int, end int")
    a = spark.createDataFrame([
        ("t", 10, 13, "abc", "vocab"), ("t", 5, 25, "long one", "text_select"), ("t", 40, 44, "free", "text_select")],
        "text_id string, start int, end int, term_text string, source string")
    got = rows(M.span_coverage(m, a), "type", "start", "end", "annotated")
    assert got == [
        ("freetext", 5, 10, True), ("freetext", 13, 20, True), ("freetext", 22, 25, True), ("freetext", 40, 44, True),
        ("vocab", 10, 13, True), ("vocab", 20, 22, True), ("vocab", 900, 903, False)]
