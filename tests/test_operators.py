"""Functions, ordered computations, NULL rules, names, extraction, evaluation, readers."""

import json
import random

import pytest
from pyspark.sql import functions as F

from helpers import rows
from labelspark import functions as fn
from labelspark.operators import evidence as E
from labelspark.operators import extract as X
from labelspark.operators import names as N
from labelspark.operators import relational as R
from labelspark.operators.ordered import number_rows, running, with_surrogate_id
from labelspark.operators.ontology import ingredient_paths, usable_paths
from labelspark.plans import evaluation as EV
from labelspark.plans import reference_set as RS
from labelspark.sources import readers


def one(spark, value, expr):
    return spark.createDataFrame([(value,)], "v string").select(expr.alias("r")).first()["r"]


@pytest.mark.parametrize("title, name", [
    ("These highlights do not include all the information needed to use ASPIRIN tablets, USP safely and effectively.", "ASPIRIN"),
    ("HIGHLIGHTS OF PRESCRIBING INFORMATION to use Zed extended-release capsules safely", "Zed"),
    ("See full prescribing information for ACME oral solution.\nMore", "ACME"),
    ("Plain Title\nsecond line", "Plain Title"), ("x" * 100, "x" * 80), ("", ""),
])
def test_drug_name(spark, title, name):
    assert one(spark, title, fn.drug_name("v")) == name


def test_slug(spark):
    assert one(spark, "Acme Pain/Relief (10 mg)", fn.slug("v")) == "acme_painrelief_10_mg"
    assert one(spark, "(/)", fn.slug("v")).startswith("medicine_")
    for text in ("日本語の薬" * 40, "a" * 300, "é" * 150):
        got = one(spark, text, fn.slug("v"))
        assert len(got.encode()) <= 220 and len(got.encode()) > 212 and got[-9] == "_"


@pytest.mark.parametrize("value, code", [("10019211.0", "10019211"), ("7", "7"), ("", None), ("NaN", None), (None, None), ("x", None)])
def test_id_string(spark, value, code):
    assert one(spark, value, fn.id_string("v")) == code


def test_running_and_numbers(spark):
    rng = random.Random(3)
    data = [(rng.choice("aaaab"), i, rng.randint(0, 9)) for i in range(500)]  # one key holds most rows
    df = spark.createDataFrame(data, "k string, i int, v int").repartition(4)
    got = {(r["k"], r["i"]): r["t"] for r in running(df, ["i"], {"t": ("sum", F.col("v"))}, within=["k"]).collect()}
    total = {}
    for k, i, v in data:
        total[k] = total.get(k, 0) + v
        assert got[(k, i)] == total[k]
    numbered = rows(number_rows(df, ["k", "i"], "no"), "k", "i", "no")
    assert [r[2] for r in numbered] == list(range(1, 501))
    before = {(r["k"], r["i"]): r["m"] for r in running(
        df, ["i"], {"m": ("max", F.col("v"))}, within=["k"], exclusive=True).collect()}
    best = {}
    for k, i, v in data:
        assert before[(k, i)] == best.get(k)
        best[k] = max(best.get(k, v), v)


def test_surrogate_ids_cover_copies(spark):
    df = spark.createDataFrame([("b",)] * 300 + [("a",), ("c",)], "k string")
    ids = rows(with_surrogate_id(df, ["k"], "id"), "id", "k")
    assert [i for i, _ in ids] == list(range(1, 303))
    assert ids[0][1] == "a" and ids[-1][1] == "c"


def test_null_rules(spark):
    left = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    with_null = spark.createDataFrame([(1,), (None,)], "k int")
    plain, empty = spark.createDataFrame([(1,)], "k int"), spark.createDataFrame([], "k int")
    for right in (with_null, plain, empty):
        left.createOrReplaceTempView("l")
        right.createOrReplaceTempView("r")
        want = spark.sql("select k from l where k not in (select k from r)")
        key = lambda df: sorted((r["k"] for r in df.collect()), key=str)
        assert key(R.not_in(left, "k", right, "k")) == key(want)
        kept = R.keep_after_not_in(left, "k", right, "k")
        gone = key(want)
        assert key(kept) == sorted((k for k in (1, 2, None) if k not in gone), key=str)
    scores = spark.createDataFrame([(3.258,), (3.2581,), (None,), (1.0,)], "pred1 double")
    assert R.score_above(scores, 3.258).count() == 2


def test_source_filter_rules(spark):
    ok = spark.createDataFrame([("d", "is_event", "s", "exact"), ("d", "not_event", "s", "deepcadrme")],
                               "drug string, class string, string string, source_method string")
    assert [R.by_source(ok, s).count() for s in ("all", "exact", "deepcadrme")] == [2, 1, 1]
    with pytest.raises(ValueError, match="missing required columns"):
        R.by_source(ok.drop("drug"))
    assert R.by_source(ok.drop("source_method"), "exact").count() == 2
    with pytest.raises(ValueError):
        R.by_source(ok.drop("source_method"), "all")


def test_paths_stay_inside_their_classes(spark):
    nodes = spark.createDataFrame([
        (1, "Branded Drug", "B"), (2, "Clinical Drug Comp", "C"), (3, "Ingredient", "I1"), (4, "Ingredient", "I2"),
        (5, "Dose Form", "F")], "concept_id long, concept_class_id string, concept_code string").withColumn("vocabulary_id", F.lit("RxNorm"))
    edges = spark.createDataFrame([(1, 2), (2, 3), (1, 5), (5, 4), (2, 5)], "concept_id_1 long, concept_id_2 long")
    mapped = spark.createDataFrame([("B",), ("I2",), ("zz",)], "rxnorm_product_id string")
    paths = [["SBD", "SCDC", "IN"], ["IN"], ["SBD", "DF"], ["DF", "IN"]]
    assert usable_paths(paths) == [["IN"], ["SBD", "SCDC", "IN"]]
    assert rows(ingredient_paths(mapped, nodes, edges, paths), "product_id", "ingredient_id") == [("B", "I1"), ("I2", "I2")]


def test_name_tiers(spark):
    names = spark.createDataFrame([
        ("1", ["ASPIRIN"]), ("2", [None, "Acid, Folic Tablets"]), ("3", ["paracetamoll"]), ("4", ["zzz"]), ("5", ["nothing", "aspirin"])],
        "code string, terms array<string>")
    known = spark.createDataFrame([("aspirin", "10"), ("Aspirin", "11"), ("folic acid", "20"), ("paracetamol", "30")], "term string, concept_code string")
    assert rows(N.match_names(names, known).na.fill("-")) == [
        ("1", "11", "exact"), ("2", "20", "normalized"), ("3", "30", "approximate"), ("4", "-", "-"), ("5", "11", "exact")]


def test_similar_names_equal_brute_force(spark):
    rng = random.Random(5)
    words = ["".join(rng.choice("abc") for _ in range(rng.randint(1, 7))) for _ in range(120)]
    df = spark.createDataFrame([(w,) for w in words], "name string")

    def grams(s):
        p = f"  {s} "
        return {p[i:i + 3] for i in range(len(p) - 2)}

    for t in (0.4, 0.75):
        want = sorted((a, b) for a in set(words[:60]) for b in set(words[60:])
                      if len(grams(a) & grams(b)) / len(grams(a) | grams(b)) >= t)
        got = rows(N.similar_names(df.limit(60), df.subtract(df.limit(60)).union(
            df.where(F.col("name").isin(words[60:]))), t), "name", "other")
        assert got == want


def test_paragraphs_and_flags(spark):
    text = "One.\n\nSeen in rats.\n5.2 A class effect\n \n\nEnd"
    df = spark.createDataFrame([("k", text)], "k string, text string")
    paras = rows(E.paragraphs(df), "start", "stop", "paragraph")
    assert "".join(p for _, _, p in paras) == text
    assert [text[a:b] == p for a, b, p in paras] == [True] * 4
    events = [["t", "p", "1", "l", "2", str(text.index("rats")), "4"], ["t", "p", "1", "l", "2", str(text.index("class")), "5"],
              ["t", "p", "1", "l", "2", None, "5"], ["t", "p", "1", "l", "2", "9999", "5", "animal"]]
    rec = spark.createDataFrame([("k", text, events)], "label_id string, section_text string, adverse_events array<array<string>>")
    flagged = E.flatten_events(E.add_evidence_flag(rec), ["label_id"])
    assert [r["flag2"] for r in flagged.orderBy("event_no").collect()] == ["animal", "drug_class", "human", "human"]


def test_reference_set_from_files(spark, tmp_path):
    ev = lambda pt, llt, *f: ["headache", "Headache", pt, "Headache", llt, "0", "8", *f]
    train = [
        {"label_id": "drugx", "section_name": "adverse reactions", "section_text": "Headache and  fever reported",
         "adverse_events": [ev(100.0, None), ev(None, 7.0, "animal")]},
        {"label_id": "drugx", "section_name": "boxed warnings", "section_text": "none", "adverse_events": []}]
    (tmp_path / "train.json").write_text(json.dumps(train))
    df = readers.read_annotations(spark, str(tmp_path / "train.json")).withColumn("tac", F.lit("train"))
    assert RS.annotation_records(df, "AR").count() == 1 and RS.annotation_records(df, "ARBW").count() == 2
    assert RS.annotation_records(df, "AR").first()["codes"] == ["100", "7"]
    assert RS.annotation_records(df, "AR", ("unmapped",)).first()["codes"] == ["100"]
    assert RS.annotation_records(df, "AR", (), ("animal",)).first()["codes"] == ["100"]
    vocab = spark.createDataFrame([("100", "headache"), ("200", "fever")], "text_id string, text string")
    none = spark.createDataFrame([], "llt_code string, pt_code string, pt_name string")
    got = rows(RS.build_reference_set(df, vocab, none, 14, 20, "AR"), "drug", "found_term", "class", "string")
    assert got == [("DRUGX", "fever", "not_event", "fever exact headache and EVENT reported"),
                   ("DRUGX", "headache", "is_event", "headache exact EVENT and fever reported")]


def test_splits(spark):
    df = spark.createDataFrame([(f"D{i:03d}", c, "train" if i < 10 else "test") for i in range(20) for c in "ab"],
                               "drug string, class string, tac string")
    sizes = lambda s: {r["split"]: r["n"] for r in s.groupBy("split").agg(F.countDistinct("drug").alias("n")).collect()}
    assert sizes(EV.split(df)) == {"train": 16, "val": 2, "test": 2}
    assert rows(EV.split(df)) == rows(EV.split(df)) and EV.split(df).count() == 40
    assert EV.split(df).select("drug", "split").distinct().count() == 20
    assert sizes(EV.split(df, "TAC")) == {"train": 9, "val": 1, "test": 10}
    with pytest.raises(ValueError):
        EV.split(df.drop("tac"), "TAC")


def test_html_and_xml(spark):
    html = ("<p>a</p><details><summary id='UNDESIRABLE_EFFECTS'>H</summary><div class='sectionWrapper'><div>x &lt; y</div><br>z</div></details>"
            "<h2 class='contents-title' id='par-11'>S</h2><ul><li>one<li>two</ul><h2 class='contents-title'>N</h2><p>end"
            "<table><tr><th>A</th><th>B</th></tr><tr></tr><tr><td>1</td></tr></table>")
    df = spark.createDataFrame([(1, html), (2, "<p>none</p>")], "k int, html string")
    assert rows(X.section_by_id(df), "k", "text") == [(1, "x < y z"), (2, "")]
    assert rows(X.section_between(df), "k", "text") == [(1, "one two"), (2, "")]
    assert [tuple(r["cells"]) for r in X.html_tables(df, "k").orderBy("row_no").collect()] == [("A", "B"), ("1", "")]
    xml = ('<document xmlns="urn:x"><id root="L"/><setId root="S"/><versionNumber value="3"/>'
           '<section><code code="34084-4"/><text>one</text></section><section><code code="34084-4"/><text> two </text></section></document>')
    row = X.spl_sections(spark.createDataFrame([(xml,)], "xml string")).first()
    assert (row["set_id"], row["label_id"], row["spl_version"], row["title"], row["AR"], row["BW"]) == ("S", "L", "3", "UNDEFINED", "one two", "")


def test_file_readers(spark, tmp_path):
    (tmp_path / "20200101_set-a.json").write_text(json.dumps(
        {"set_id": "set-a", "label_id": "l", "spl_version": "1", "title": "T", "sections": {"AR": "x"}}, indent=1))
    df = readers.read_label_json(spark, str(tmp_path))
    assert df.select("set_id", "AR", "BW").first() == ("set-a", "x", None)
    raw = spark.read.option("wholetext", True).text(str(tmp_path))
    assert readers.with_path_fields(raw.select("value", "_metadata")).select("file_date", "file_set_id").first() == ("20200101", "set-a")
    side = tmp_path / "uk"
    side.mkdir()
    for name, text in (("a", " body \n"), ("b", " \n")):
        (side / f"{name}.side_effects.txt").write_text(text)
        (side / f"{name}.download").write_text(json.dumps({"name": name, "code": name.upper(), "page_url": "u"}))
    got = readers.read_text_with_meta(spark, f"{side}/*.txt", f"{side}/*.download")
    assert rows(got, "name", "code", "text") == [("a", "A", "body")]
