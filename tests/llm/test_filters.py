"""Quality rules, quality classifier, URL filter and license scan against plain versions."""

import re
from collections import Counter

import numpy as np
import pytest

from labelspark.llm import license_scan, quality_classifier, quality_rules, url_filter

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def base_statistics(text):
    words = WORD.findall(text or "")
    n = len(words)
    seen = Counter(tuple(words[k:k + 8]) for k in range(n - 7))
    inside = set()
    for k in range(n - 7):
        if seen[tuple(words[k:k + 8])] > 1:
            inside.update(range(k, k + 8))
    lines, dup = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in lines
            lines.add(line)
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return n, sum(map(len, words)), symbols, dup, len(inside), n < 20 or 100 * len(inside) > 30 * n


@pytest.mark.parametrize("source", ["docs", "odd"])
def test_rule_statistics(request, source, no_labels):
    docs = request.getfixturevalue(source)
    rules = quality_rules.fit(docs, no_labels)
    assert rules.rules == []
    got = sorted((tuple(r) for r in quality_rules.judge(docs, rules).collect()), key=repr)
    want = []
    for doc_id, text in docs.select("doc_id", "text").collect():
        s = base_statistics(text)
        want.append((doc_id, *s, None, not s[-1]))
    assert got == sorted(want, key=repr)


def test_rules_learn_and_keep(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rules = quality_rules.fit(docs, labels, min_covered=3)
    assert rules.rules and "reject" in str(rules.rules[0])
    judged = quality_rules.judge(docs, rules)
    known = judged.join(labels, "doc_id").groupBy("quality", "kept").count().collect()
    n = {(r["quality"], r["kept"]): r["count"] for r in known}
    assert n[1, True] > 20 * n.get((0, True), 0)
    left = quality_rules.keep(docs, rules)
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.collect()) == sorted(r.doc_id for r in judged.filter("kept").collect())


def test_rules_on_nothing(no_docs, no_labels):
    assert quality_rules.judge(no_docs, quality_rules.fit(no_docs, no_labels)).collect() == []


def test_label_model_finds_accuracies():
    rng = np.random.default_rng(0)
    truth = rng.random(20000) < 0.8
    right = [0.95, 0.8, 0.7]
    votes = np.stack([np.where(rng.random(20000) < 0.6, np.where((rng.random(20000) < p) == truth, 1, -1), 0) for p in right], 1)
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    model = quality_classifier.fit_label_model(patterns.astype(float), counts.astype(float), strength=0.001)
    assert np.argmax(model.accuracy) == 0
    p = model.posterior(votes.astype(float)) > 0.5
    assert (p == truth).mean() > 0.85


def test_classifier_on_held_out_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    scorers = quality_classifier.fit(docs, labels.filter("doc_id % 3 <> 0"))
    got = quality_classifier.judge(docs, scorers).join(labels.filter("doc_id % 3 = 0"), "doc_id").select(
        "quality", "toxic", "kept").collect()
    clean = [r.kept for r in got if r.quality == 1 and r.toxic == 0]
    junk = [r.kept for r in got if r.quality == 0]
    assert np.mean(clean) > 0.95 and np.mean(junk) < 0.3


def test_classifier_on_odd_rows(odd, no_docs, no_labels, labels):
    scorers = quality_classifier.fit(odd, no_labels)
    got = quality_classifier.judge(odd, scorers).collect()
    assert len(got) == odd.count() and all(r.kept is not None for r in got)
    left = quality_classifier.keep(odd, scorers)
    assert left.columns == odd.columns and left.count() == sum(r.kept for r in got)
    nothing = quality_classifier.fit(no_docs, labels)
    assert quality_classifier.judge(no_docs, nothing).collect() == []
    assert all(r.kept for r in quality_classifier.judge(odd, nothing).collect())


def by_rules(url, rules=url_filter.RULES):
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    host = re.split(r"[/?#]", rest)[0]
    path = re.split(r"[?#]", rest[len(host):])[0]
    host, best = host.translate(LOW), None
    for verdict, h, p in rules:
        if (host == h or host.endswith("." + h)) and path.startswith(p) and (best is None or len(h + p) > len(best[0])):
            best = (h + p, verdict)
    return host, path, *(best or (None, None))


def test_url_rules(spark, sf_dir):
    odd = spark.createDataFrame([(1, None), (2, "abc"), (3, "http://"), (4, "HTTP://A.COM"), (4, "HTTP://A.COM"),
                                 (5, "x://www.EXAMPLE.com/en/1?q#/z"), (6, "x://example.com/en"), (7, "ftp://é.Net/es/ü://x"),
                                 (8, "://q.net?/fr/"), (None, "http://notcom/a")], "page_id long, url string")
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url").union(odd)
    got = url_filter.judge(pages).collect()
    want = Counter((i, *by_rules(u)) for i, u in pages.collect())
    assert Counter((r.page_id, r.host, r.path, r.rule, r.verdict if r.rule else None) for r in got) == want
    assert {r.verdict for r in got} == {"allow", "block"}


def test_url_model_against_plain_witten_bell(spark):
    urls = [(i, f"{'good' if i % 2 else 'bads'}{i % 7}.example/{i}", i % 2 == 0) for i in range(60)]
    decided = spark.createDataFrame(urls, "id long, text string, blocked boolean")
    model = url_filter.fit(decided, order=2)
    counts = {}
    for r in model.counts.collect():
        counts.setdefault((r.blocked, r.context), {})[r.c] = r.n
    asked = spark.createDataFrame([(1, "good3.example/x"), (2, "bads9.example/q"), (3, "zz")], "id long, text string")

    def p(kind, context, c):
        lower = p(kind, context[1:], c) if context else 1 / url_filter.ALPHABET
        seen = counts.get((kind, context))
        return lower if not seen else (seen.get(c, 0) + len(seen) * lower) / (sum(seen.values()) + len(seen))

    for r in url_filter.score(asked, model).collect():
        text = "\x02\x02" + {1: "good3.example/x", 2: "bads9.example/q", 3: "zz"}[r.id] + "\x02"
        ratio = [np.log(p(True, text[i - 2:i], text[i])) - np.log(p(False, text[i - 2:i], text[i])) for i in range(2, len(text))]
        assert abs(r.score - np.mean(ratio)) < 1e-6
    scores = {r.id: r.score for r in url_filter.score(asked, model).collect()}
    assert scores[2] > scores[1]


def test_urls_without_training_text(spark):
    pages = spark.createDataFrame([(1, "http://a.org/x")], "page_id long, url string")
    assert [r.verdict for r in url_filter.judge(pages).collect()] == ["allow"]
    assert url_filter.judge(pages.limit(0)).collect() == []


def test_url_model_sees_whole_urls(spark):
    rows = [(i, f"http://www.example.com/en/{i % 9}?page={i}") for i in range(200)]
    rows += [(i, f"http://example.com/en/{i % 9}?casino=win{i}#spin") for i in range(200, 400)]
    rows += [(1001, "http://q.org/p?page=7"), (1002, "http://q.org/p?casino=win7#spin"), (1003, "q.org/p?casino=win7#spin"),
             (1004, "q.org/p?page=7"), (1005, ""), (1006, None)]
    got = {r.page_id: r for r in url_filter.judge(spark.createDataFrame(rows, "page_id long, url string")).collect()}
    assert got[1002].score > got[1001].score and got[1003].score > got[1004].score
    assert all((got[i].host, got[i].path, got[i].rule) == ("q.org", "/p", None) for i in (1001, 1002))
    assert all((got[i].host, got[i].path, got[i].rule) == ("", "", None) for i in range(1003, 1007))
    assert all(got[i].score is not None for i in range(1001, 1005)) and got[1005].score is got[1006].score is None
    assert got[1005].verdict == got[1006].verdict == "allow"


def test_url_model_counts_every_row(spark, monkeypatch):
    pages = [(i, f"http://{'www.' if i % 2 else ''}example.com/en/{i % 20}?v={i % 40}", 1 + i % 3) for i in range(40)]
    given, fit = [], url_filter.fit
    monkeypatch.setattr(url_filter, "fit", lambda decided, **k: given.append(fit(decided, **k)) or given[-1])
    url_filter.judge(spark.createDataFrame([(i, u) for i, u, n in pages for _ in range(n)], "page_id long, url string")).collect()
    repeated = spark.createDataFrame([(i, u, i % 2 == 0) for i, u, n in pages for _ in range(n)], "id long, text string, blocked boolean")
    plain = fit(repeated)
    assert sorted(map(tuple, given[0].counts.collect())) == sorted(map(tuple, plain.counts.collect()))
    assert given[0].cut == plain.cut < np.inf


@pytest.mark.parametrize("source", ["docs", "odd"])
def test_license_phrases(request, source):
    docs = request.getfixturevalue(source)
    want = Counter()
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    for doc_id, text in docs.select("doc_id", "text").collect():
        w = word.findall((text or "").translate(LOW))
        at = [(k, label) for p, label in license_scan.PHRASES.items() for k in range(len(w))
              if w[k:k + len(p.split())] == p.split()]
        places = [k for k, _ in at]
        want[doc_id, len(w), len(at), min(places, default=None), max(places, default=None), ",".join(sorted({x for _, x in at}))] += 1
    got = license_scan.scan(docs).collect()
    assert Counter((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got) == want
    assert all(set(r.base_labels.split(",")) <= set(r.labels.split(",")) and 0 <= r.score <= 1 for r in got if r.base_labels)


def test_license_spans(spark, no_docs):
    mit = license_scan.TEMPLATES[2][1]
    drifted = "x y z " + mit.replace("free of charge", "free of any charge") + " tail"
    texts = [(1, "intro words " + mit.upper() + " more"), (2, drifted), (3, "permission is hereby granted to nobody"),
             (4, "Licensed under the GNU General Public License, version 3."), (5, f"{mit} and then {mit}"), (6, "cc by only")]
    got = {r.doc_id: (r.labels, r.score) for r in license_scan.scan(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    assert got[1] == ("mit", 1.0) and got[5][0] == "mit"
    assert got[2][0] == "mit" and 0.9 < got[2][1] < 1
    assert got[3] == ("", 0.0)
    assert got[4][0] == "gpl" and got[6] == ("cc-by", 1.0)
    assert license_scan.scan(no_docs).collect() == []


def test_license_windows(spark):
    notice = "licensed under the Apache License, Version 2.0"
    texts = [(1, f"docs licensed under the MIT, {notice}"), (2, f"licensed under the {notice} licensed under the"),
             (3, "licensed beneath the GNU Lesser General Public License"),  # its first whole gram is the third
             (4, "; ".join([notice] * 9)), (5, f"{notice}; {license_scan.TEMPLATES[8][1]}; under the {license_scan.TEMPLATES[9][1]}"),
             (6, "licensed under the one licensed under the other licensed under the third"), (7, notice), (7, notice)]
    got = license_scan.scan(spark.createDataFrame(texts, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.labels, round(r.score, 3)) for r in got) == [
        (1, "apache-2.0,mit", 1.0), (2, "apache-2.0", 1.0), (3, "gpl,lgpl", 0.875), (4, "apache-2.0", 1.0),
        (5, "apache-2.0,gpl,lgpl", 1.0), (6, "", 0.0), (7, "apache-2.0", 1.0), (7, "apache-2.0", 1.0)]


def test_license_windows_against_every_window():
    def common(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            old = row[:]
            for k, y in enumerate(b):
                row[k + 1] = old[k] + 1 if x == y else max(row[k], old[k + 1])
        return row[-1]

    rng, seen = np.random.default_rng(3), 0
    for _ in range(60):
        template = [b"%d" % x for x in rng.integers(0, 12, rng.integers(5, 14))]
        have = [b"%d" % x for x in rng.integers(0, 12, 25)]
        for at in rng.integers(0, 20, 2):  # the template with a word lost and one changed, over other words
            have[at:at + len(template) - 2] = template[:2] + template[3:]
            have[at + 4] = b"x"
        hits = {p for p in range(len(have) - 2) for k in range(len(template) - 2) if have[p:p + 3] == template[k:k + 3]}
        need = license_scan.needed(len(template))
        if not hits:
            continue
        want = {(lo, hi): a for lo in range(len(have)) for hi in range(lo + 3, len(have) + 1)
                if sum(lo <= p <= hi - 3 for p in hits) >= need and have[lo] in template and have[hi - 1] in template
                and (a := common(have[lo:hi], template) / max(hi - lo, len(template))) >= license_scan.ALIKE}
        assert {(lo, hi): a for a, lo, hi in license_scan.alike_windows(have, list(hits), template, need)} == want
        seen += len(want)
    assert seen
