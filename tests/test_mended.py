"""Rows that the registered tables do not hold: NULL groups, NULL scores, Unicode blanks, NUL, late sections, bad XML."""

import pytest
from pyspark.sql import functions as F

from helpers import rows


def test_paragraphs_with_unicode_blanks_and_nul(spark):
    from labelspark.operators.evidence import paragraphs

    texts = ["a\n\u00a0\nb", "x\n\u00a04.8 Effects", "one\x00two\n\nthree\x00", "no break", ""]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    got = {}
    for r in paragraphs(df).orderBy("id", "paragraph_no").collect():
        got.setdefault(r.id, []).append((r.start, r.stop, r.paragraph))
    assert [p for _, _, p in got[0]] == ["a", "\n\u00a0\nb"]
    assert [p for _, _, p in got[1]] == ["x", "\n\u00a04.8 Effects"]
    assert [p for _, _, p in got[2]] == ["one\x00two", "\n\nthree\x00"]
    for i, parts in got.items():
        assert all(texts[i][a:b] == p for a, b, p in parts) and "".join(p for _, _, p in parts) == texts[i]


PHRASES = {
    "drug_class": ["class\u00a0effect", "Class of drug", "drug class", "class-related", "drugs in this class",
                   "other drugs in the same class", "class of ACE inhibitor", "agents of this type"],
    "animal": ["in animal studies", "nonclinical toxicology", "carcinogenesis", "Mutagenesis", "reproductive toxicology",
               "teratogenic effects", "animal data", "in rats", "embryo-lethality", "prenatal and postnatal"],
    "human": ["in patients", "classes of effect", "in ratsbane"],
}


def test_all_evidence_phrases(spark):
    from labelspark.operators.evidence import classify_evidence

    df = spark.createDataFrame([(k, p) for k, ps in PHRASES.items() for p in ps], "kind string, text string")
    assert df.where(classify_evidence("text") != F.col("kind")).collect() == []


def test_drug_name_branches(spark):
    from labelspark.functions import drug_name

    titles = ["to use\u00a0ASPIRIN tablets safely", "prescribing information for Beta oral.", "HIGHLIGHTS OF PRESCRIBING INFORMATION Gamma",
              "These highlights of all\nrest", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(titles)], "id int, title string")
    got = [r[0] for r in df.orderBy("id").select(drug_name("title")).collect()]
    assert got[:3] == ["ASPIRIN", "Beta", "Gamma"] and got[4] == ""


def test_null_groups_stay(spark):
    from labelspark.operators.aggregates import share_in_group, text_length_stats
    from labelspark.operators.extract import pad_rows
    from labelspark.plans.evaluation import metrics_by

    df = spark.createDataFrame([("a", 1, "x"), (None, 2, "x"), (None, 3, "y")], "g string, v int, k string")
    assert share_in_group(df, "g", "v", "k").count() == 3
    texts = df.select("g", F.lit("two words").alias("section_text"))
    assert rows(text_length_stats(texts, ["g"]).where("g is null"), "mean_words") == [(2.0,)]
    cells = spark.createDataFrame([(None, ["a"]), (None, ["b", "c"]), (1, ["d"])], "t int, cells array<string>")
    assert sorted(len(r.cells) for r in pad_rows(cells, ["t"]).collect()) == [1, 2, 2]
    scored = spark.createDataFrame([("AR", 1, 5.0), ("AR", 0, 1.0), (None, 1, 4.0), (None, 0, 5.0)], "s string, label int, score double")
    assert metrics_by(scored, "s", 3.0).count() == 2


def test_running_total_of_a_null_key_spans_blocks(spark):
    from labelspark.operators.ordered import running

    df = spark.range(400).select(F.when(F.col("id") % 2 == 0, "k").alias("key"), "id", F.lit(1).alias("one"))
    got = running(df.repartition(7), ["id"], {"total": ("sum", F.col("one"))}, within=["key"])
    assert got.groupBy("key").agg(F.max("total").alias("t"), F.count("*").alias("n")).where("t <> n").count() == 0


def test_unscored_rows_are_no_threshold(spark):
    from labelspark.plans.evaluation import best_threshold, pr_curve

    df = spark.createDataFrame([(1, 5.0), (0, 1.0), (0, None), (1, None)], "label int, score double")
    assert sorted(r.threshold for r in pr_curve(df, "label", "score").collect()) == [1.0, 5.0]
    assert best_threshold(df, "label", "score").first().max_f1_precision == 1.0


def test_null_split_key_fails(spark):
    from labelspark.plans.evaluation import split_by_key

    df = spark.createDataFrame([("a", 1), (None, 2)], "drug string, v int")
    with pytest.raises(Exception, match="split key drug is NULL"):
        split_by_key(df, "drug").collect()


def test_bad_xml_is_rejected_and_the_rest_goes_on(spark):
    from labelspark.operators.extract import spl_rejected, spl_sections

    good = '<document><setId root="s"/><id root="l"/><title>T</title></document>'
    df = spark.createDataFrame([(good,), ("<document><open>",), (None,)], "xml string")
    assert [r.title for r in spl_sections(df).collect()] == ["T"]
    assert [r.xml for r in spl_rejected(df).collect()] == ["<document><open>"]


def test_sections_of_one_delivery_all_count(spark):
    from labelspark.streaming.ingest import first_delivery

    cols = "source string, product_id string, version string, section string, delivery bigint"
    batch = spark.createDataFrame([("US", "1", "1", "AR", 1), ("US", "1", "1", "WP", 1), ("US", "1", "1", "AR", 2),
                                   ("US", "2", "1", "BW", 7), ("US", "2", "1", "AR", 8), ("UK", None, "1", "AR", None)], cols)
    done = batch.select("source", "product_id", "version", "delivery").where("delivery = 7")
    got = rows(first_delivery(batch, done.limit(0)).fillna("-", ["product_id"]), "product_id", "section", "delivery")
    assert got == [("-", "AR", None), ("1", "AR", 1), ("1", "WP", 1), ("2", "BW", 7)]
    later = spark.createDataFrame([("US", "2", "1", "WP", 7), ("US", "2", "1", "AR", 3)], cols)
    assert rows(first_delivery(later, done), "section") == [("WP",)]


def test_copies_unfold_in_chunks(spark):
    from labelspark.operators.ordered import UNFOLD, with_surrogate_id

    df = spark.createDataFrame([("a", 2 * UNFOLD + 5), ("b", 1), ("c", UNFOLD)], "k string, n bigint")
    got = with_surrogate_id(df, ["k"], "id", copies="n")
    s = got.agg(F.min("id"), F.max("id"), F.countDistinct("id")).first()
    assert tuple(s) == (1, 3 * UNFOLD + 6, 3 * UNFOLD + 6)
    assert got.where("k = 'b'").first().id == 2 * UNFOLD + 6


def test_joins_grow_with_the_longest_path(spark, sf_dir, monkeypatch):
    from labelspark.operators import ontology

    staged = []
    stage = ontology.stage
    monkeypatch.setattr(ontology, "stage", lambda df, name: (staged.append(name), stage(df, name))[1])
    nodes = spark.createDataFrame(
        [(1, "d", "RxNorm", "Clinical Drug", "p1"), (2, "c", "RxNorm", "Clinical Drug Comp", "c1"), (3, "i", "RxNorm", "Ingredient", "i1")],
        "concept_id bigint, concept_name string, vocabulary_id string, concept_class_id string, concept_code string")
    edges = spark.createDataFrame([(1, 2), (2, 3), (1, 3)], "concept_id_1 bigint, concept_id_2 bigint")
    mapped = spark.createDataFrame([("p1",)], "rxnorm_product_id string")
    paths = [["SCD", "SCDC", "IN"], ["SCD", "IN"], ["SCD", "SCDC", "PIN", "IN"], ["SCD", "PIN", "IN"]]
    got = rows(ontology.ingredient_paths(mapped, nodes, edges, paths))
    assert got == [("p1", "i1")]
    assert staged.count("frontier") == 4


def test_scratch_needs_a_shared_folder_on_a_cluster(spark, monkeypatch):
    from labelspark import session

    class Context:
        master, applicationId = "spark://host:7077", "other"

    class Conf:
        def get(self, key, default=None):
            return default

    class Fake:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.scratch_dir(Fake())
    assert session.scratch_dir(spark)


def test_a_hot_row_is_numbered_in_several_blocks(spark, monkeypatch):
    from labelspark.operators import ordered

    staged = []
    stage = ordered.stage
    monkeypatch.setattr(ordered, "stage", lambda df, name: staged.append(stage(df, name)) or staged[-1])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        n = 40 * ordered.UNFOLD
        df = spark.createDataFrame([("hot", n), ("zero", 0), ("none", None), ("last", 1)], "k string, n bigint")
        got = ordered.with_surrogate_id(df, ["k"], "id", copies="n")
        assert tuple(got.agg(F.count("id"), F.min("id"), F.max("id"), F.countDistinct("id")).first()) == (n + 1, 1, n + 1, n + 1)
        assert got.where("k = 'last'").first().id == n + 1
        assert len(staged) == 1 and staged[0].where("k = 'hot'").select("_block").distinct().count() > 1
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_repair_reports_null_keys_and_repeated_parents(spark):
    from labelspark.plans.integrity import repair_steps
    from labelspark.schemas import RELEASE_SCHEMAS, Release

    values = {
        "product_label": [(1, "US", "n", "1", None), (1, "US", "n", "1", None), (2, "US", "n", "2", None), (None, "US", "n", "3", None)],
        "product_to_rxnorm": [(1, "p"), (1, None), (None, "p"), (2, "q"), (9, "p")],
        "product_adverse_effect": [(1, 1, "AR", 7, "PMB", 0.1, 0.2), (2, 2, "AR", 7, "PMB", 0.1, 0.2), (None, 3, "AR", 7, "PMB", 0.1, 0.2),
                                   (1, 4, "AR", None, "PMB", 0.1, 0.2), (1, 5, "AR", 8, "PMB", 0.1, 0.2)],
        "vocab_rxnorm_product": [("p", "n", "t"), ("p", "n", "t"), (None, "n", "t"), ("q", "n", "t")],
        "vocab_rxnorm_ingredient": [("i", "n", "t")],
        "vocab_rxnorm_ingredient_to_product": [("p", "i")] if RELEASE_SCHEMAS["vocab_rxnorm_ingredient_to_product"].fieldNames()[0] == "product_id" else [("i", "p")],
        "vocab_meddra_adverse_effect": [(7, "n", "PT"), (7, "n", "PT"), (None, "n", "PT")],
    }
    order = {"product_adverse_effect": ["product_label_id", "effect_id", "label_section", "effect_meddra_id", "match_method", "pred0", "pred1"],
             "product_label": ["label_id", "source", "source_product_name", "source_product_id", "source_label_url"],
             "product_to_rxnorm": ["label_id", "rxnorm_product_id"]}
    tables = {}
    for name, data in values.items():
        schema = RELEASE_SCHEMAS[name]
        names = order.get(name, schema.fieldNames())
        tables[name] = spark.createDataFrame([tuple(dict(zip(names, r))[c] for c in schema.fieldNames()) for r in data], schema)
    kept, audits = repair_steps(Release(**tables))
    assert rows(kept.product_label, "label_id") == [(1,), (1,)]
    assert rows(kept.product_to_rxnorm.fillna("-"), "label_id", "rxnorm_product_id") == [(1, "-"), (1, "p")]
    assert rows(kept.product_adverse_effect, "effect_id") == [(1,)]
    assert sorted(r[0] for r in audits["product_adverse_effect_deficient"].select("effect_id").collect()) == [3, 4, 5]
    assert rows(audits["orphan_product_adverse_effect"], "effect_id") == [(2,)]
    assert audits["product_to_rxnorm_deficient"].count() == 3
    assert sorted(str(r[0]) for r in audits["orphan_product_to_rxnorm"].select("label_id").collect()) == ["2", "None"]


def test_label_files_reject_what_is_no_object(spark, tmp_path):
    from labelspark.sources.readers import read_label_files, read_text_with_meta
    from labelspark.sources.writers import write_files

    files = [("20240101_a.json", '{\n  "set_id": "a",\n  "sections": {"AR": "x\\ny"}\n}'), ("b.json", '{"set_id": "b"'),
             ("20240102_c.json", '{"set_id": "c", "new": 1}')]
    write_files(spark.createDataFrame(files, "name string, value string"), str(tmp_path / "l"), "name", "value")
    good, bad = read_label_files(spark, str(tmp_path / "l"))
    assert rows(good, "file_date", "file_set_id", "set_id", "AR") == [("20240101", "a", "a", "x\ny"), ("20240102", "c", "c", None)]
    assert rows(bad, "file_name", "content") == [("b.json", '{"set_id": "b"')]
    texts = spark.createDataFrame([("d.txt", " one\n\ntwo "), ("e.txt", " \n"), ("f.txt", None)], "name string, value string")
    metas = spark.createDataFrame([("d.json", '{"code":\n "D"}'), ("e.json", '{"code": "E"}'), ("f.json", '{"code": "F"}')], "name string, value string")
    write_files(texts, str(tmp_path / "t"), "name", "value")
    write_files(metas, str(tmp_path / "m"), "name", "value")
    assert rows(read_text_with_meta(spark, str(tmp_path / "t"), str(tmp_path / "m")), "code", "text") == [("D", "one\n\ntwo")]


def test_interval_table_rounds_halves_as_its_sql(spark, tmp_path):
    duckdb = pytest.importorskip("duckdb")
    import __spark_entry__ as entry

    orders = [(k, 1, 100.5 + k / 2) for k in range(8)]
    lines = [(20 * k, 1, 101.5 + k, 1.0, "ANR"[k % 3]) for k in range(4)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_totalprice double").coalesce(1).write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame(lines, "l_orderkey long, l_suppkey long, l_extendedprice double, l_quantity double, l_returnflag string") \
        .coalesce(1).write.parquet(f"{tmp_path}/lineitem.parquet")
    con = duckdb.connect()
    for t in ("orders", "lineitem"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet/*.parquet'")
    want = con.execute(entry.oracle_sql()["j25_interval_table"]).fetchall()
    assert rows(entry.queries()["j25_interval_table"](spark, str(tmp_path)), "o_orderkey", "kind") == sorted(want)


def test_a_term_that_overlaps_itself_is_found_at_every_place(spark):
    from labelspark.operators.match import match_terms

    texts = spark.createDataFrame([("t", "hathath aHATHATHATH")], "text_id string, text string")
    vocab = spark.createDataFrame([("1", "hath")], "text_id string, text string")
    assert rows(match_terms(texts, vocab), "start") == [(0,), (3,)]
    assert rows(match_terms(texts, vocab, case=False), "start") == [(0,), (3,), (9,), (12,), (15,)]


def test_few_pages_of_a_batch_are_python_strings_at_once():
    import tracemalloc

    import pyarrow as pa

    from labelspark.operators import extract as X

    pages = pa.array([None, ""] + [chr(97 + i % 26) * 20_000 for i in range(1998)], pa.string())
    tracemalloc.start()
    got = X._parsed(pages, lambda h: h[1:])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 8_000_000  # 80 MB with all pages and texts of the batch
    assert got.slice(0, 3).to_pylist() == ["", "", "a" * 19_999] and len(got) == 2000
    assert X._parsed(pages.slice(0, 0), str).to_pylist() == []


def test_label_and_mapping_queries_do_not_number_effects(spark, monkeypatch):
    import __spark_entry__ as entry
    from labelspark.plans import build as B

    numbered, keep = [], B.with_surrogate_id

    def counted(df, keys, name, *args, **how):
        numbered.append(name)
        return keep(df, keys, name, *args, **how)

    monkeypatch.setattr(B, "with_surrogate_id", counted)
    data = "/root/testdata/sf0.001"
    for query in ("b3_assemble_labels", "b3_assemble_map", "b5_ingredient_map"):
        assert not entry.queries()[query](spark, data).isEmpty()
    assert numbered == ["label_id"] * 3
    assert not entry.queries()["b3_assemble_effects"](spark, data).isEmpty()
    assert numbered[3:] == ["label_id", "effect_id"]


def test_tables_of_pages_are_parsed_once(spark):
    from labelspark.operators import extract as X

    pages = spark.createDataFrame([("p", "<table><tr><td>a</td><td>b</td></tr><tr><td>c</td></tr></table>")], "k string, html string")
    got = X.html_tables(pages, "k")
    assert "MapInPandas" not in got._jdf.queryExecution().toString()  # it was there twice
    assert [tuple(r.cells) for r in got.orderBy("row_no").collect()] == [("a", "b"), ("c", "")]


def test_folded_keys_are_the_unfolded_ones(spark):
    from labelspark.operators.ordered import FOLDED, UNFOLD, n_folded, unfold, with_surrogate_id

    df = spark.createDataFrame([("b", 1), ("a", UNFOLD + 3), ("c", 0), (None, 2), ("d", 4)], "k string, n bigint")
    folded = with_surrogate_id(df, ["k"], "id", copies="n", folded=True)
    assert sorted(rows(folded, "id", "k", FOLDED)) == [
        (1, None, 2), (3, "a", UNFOLD), (UNFOLD + 3, "a", 3), (UNFOLD + 6, "b", 1), (UNFOLD + 7, "d", 4)]
    assert sorted(rows(unfold(folded, "id"), "id", "k")) == sorted(rows(with_surrogate_id(df, ["k"], "id", copies="n"), "id", "k"))
    assert folded.agg(n_folded(folded)).first()[0] == UNFOLD + 10
    assert unfold(df, "id") is df and df.agg(n_folded(df)).first()[0] == 5


def test_release_keeps_effects_folded_until_export(spark, tmp_path):
    from labelspark.checks.build import _regions
    from labelspark.operators.ordered import FOLDED, n_folded
    from labelspark.plans import build as B
    from labelspark.plans import validation as V
    from labelspark.testbed import PATHS, Testbed

    t = Testbed(spark, "/root/testdata/sf0.001")
    inputs = dict(regions=_regions(t), atoms=t.atoms(), nodes=t.nodes(), edges=t.edges(), paths=PATHS)
    built = B.build_release(**inputs)
    effects = built.product_adverse_effect
    n = effects.agg(n_folded(effects)).first()[0]
    assert effects.count() < n / 3  # every row was written once per copy in each step
    B.release(str(tmp_path), **inputs)
    kept = spark.read.option("header", True).csv(f"{tmp_path}/csv/product_adverse_effect")
    assert FOLDED not in kept.columns and (kept.count(), kept.select("effect_id").distinct().count()) == (n, n)
    bare = built.with_tables(product_label=built.product_label.limit(0))
    assert f"({n} " in V.check_2b(bare).first().result  # counts rows, not folded ones


def _odd_release(spark):
    """Labels of other and of no source, a NULL ingredient, over 64 ingredients, repeated rows, shared names, unknown keys."""
    from labelspark.schemas import RELEASE_SCHEMAS, Release

    sources = {1: "US", 2: "UK", 3: "EU", 4: "JP", 5: "CA", 6: None, 7: "AU", 8: "US"}
    links = [(f"p{i % 9}", f"i{i}") for i in range(150)] + [("p1", None), ("p8", "i3"), ("p9", None), ("x", "i1")]
    values = {
        "product_label": [(k, s, "n", str(k), None) for k, s in sources.items()] + [(9, "US", "n", "9", None)],
        "product_to_rxnorm": [(k, f"p{(k * j) % 9}") for k in sources for j in (1, 2)] + [(9, "p9"), (77, "p1"), (1, "x")],
        "product_adverse_effect": [(k, k * 10 + e, "AR", e, "PMB", 0.1, 5.0) for k in [*sources, 77, 9] for e in (k % 3, k % 4 + 2, 7)],
        "vocab_rxnorm_product": [(f"p{i}", "n", "t") for i in range(10)],
        "vocab_rxnorm_ingredient": [(f"i{i}", f"name{i % 100}", "t") for i in range(149)],
        "vocab_rxnorm_ingredient_to_product": links,
        "vocab_meddra_adverse_effect": [(e, f"effect{e // 2}", "PT") for e in range(7)],
    }
    values = {n: v + v[:1] if n in ("product_to_rxnorm", "product_adverse_effect") else v for n, v in values.items()}
    return values, Release(**{n: spark.createDataFrame(v, RELEASE_SCHEMAS[n]) for n, v in values.items()})


def test_pairs_counted_as_bits(spark):
    from collections import defaultdict

    from labelspark.operators.aggregates import source_combinations
    from labelspark.plans import analytics as Q

    v, rel = _odd_release(spark)
    products, source = {p[0] for p in v["vocab_rxnorm_product"]}, {r[0]: r[1] for r in v["product_label"]}
    name, effect = {r[0]: r[1] for r in v["vocab_rxnorm_ingredient"]}, {r[0]: r[1] for r in v["vocab_meddra_adverse_effect"]}
    by_effect, by_name, seen = defaultdict(set), defaultdict(set), defaultdict(set)
    for label, product in v["product_to_rxnorm"]:
        for p, i in v["vocab_rxnorm_ingredient_to_product"]:
            for row in v["product_adverse_effect"] if p == product and label in source else ():
                if row[0] == label:
                    if i in name and row[3] in effect:
                        by_effect[effect[row[3]]].add(i)
                        by_name[name[i]].add(row[3])
                    if p in products:
                        seen[i, row[3]].add(source[label])
    effects = Q.top_effects_by_ingredients(rel, 99)
    assert dict(rows(effects)) == {k: len(x) for k, x in by_effect.items()}
    assert dict(rows(Q.top_ingredients_by_effects(rel, 999))) == {k: len(x) for k, x in by_name.items()}
    known = ("US", "UK", "EU", "JP")
    want = {(*k, len(x - {None}), *[int(s in x) if x - {None} else None for s in known]) for k, x in seen.items()}
    got = [tuple(r) for r in Q.source_intersection(rel).select("ingredient_id", "effect_meddra_id", "num_sources", *known).collect()]
    assert len(got) == len(want) and set(got) == want
    combos = {}
    for c in source_combinations():
        pairs = [k for k, x in seen.items() if set(c) <= x]
        if pairs:
            combos["-".join(c)] = (len(pairs), len({i for i, _ in pairs} - {None}), len({e for _, e in pairs}))
    assert {r[0]: r[1:] for r in rows(Q.combination_counts(rel), "source_combo", "num_ades", "num_ingredients", "num_effects")} == combos
    for df in (effects, Q.top_ingredients_by_effects(rel)):  # pairs of ingredient and effect were rows of a distinct
        assert "bit_or" in df._jdf.queryExecution().optimizedPlan().toString()


def test_labels_are_not_listed_with_all_their_ingredients(spark):
    from labelspark.plans import analytics as Q

    v, rel = _odd_release(spark)
    share = Q.share_with_ingredients(rel)
    assert share.first()[:2] == (8, 9)  # label 9 has one product, whose only ingredient is NULL
    of = {r[0] for r in v["product_adverse_effect"] if r[3] == 2} & {r[0] for r in v["product_label"]}
    products = {p for k, p in v["product_to_rxnorm"] if k in of}
    want = {i for p, i in v["vocab_rxnorm_ingredient_to_product"] if p in products} & {r[0] for r in v["vocab_rxnorm_ingredient"]}
    only2 = rel.with_tables(vocab_meddra_adverse_effect=rel.vocab_meddra_adverse_effect.where("meddra_id = 2"))
    found = Q.ingredients_for_effect(only2, "effect1")
    assert {r[0] for r in rows(found, "rxnorm_id")} == want
    for df in (share, found):  # a join of labels with ingredients had one row for each
        assert "LeftSemi" in df._jdf.queryExecution().optimizedPlan().toString() and \
            "Join Inner" not in df._jdf.queryExecution().optimizedPlan().toString()


def test_text_files_are_dealt_to_tasks_and_read_whole(spark, tmp_path):
    import gzip

    from labelspark.sources.readers import read_text_with_meta
    from labelspark.sources.writers import write_files

    texts = [(f"t{i}.txt", f"m{i}.json", f"  Über {i}\r\n\x00zwei\n", f'{{"name": "n{i}", "code": "c{i}"}}') for i in range(30)]
    df = spark.createDataFrame(texts, "t string, m string, text string, meta string").coalesce(1)
    df = df.withColumn("m", F.replace("t", F.lit(".txt"), F.lit(".json")))
    spark.sparkContext.setJobGroup("files", "files")
    write_files(df, f"{tmp_path}/text", "t", "text")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    write_files(df, f"{tmp_path}/meta", "m", "meta")
    status = spark.sparkContext.statusTracker()
    stages = [status.getStageInfo(s) for j in status.getJobIdsForGroup("files") for s in status.getJobInfo(j).stageIds]
    assert max(s.numTasks for s in stages if s) > 1  # one task wrote all files of a table in one partition
    with gzip.open(f"{tmp_path}/text/t0.txt.gz", "wb") as f:
        f.write("packed".encode())
    (tmp_path / "text" / "t1.txt").write_bytes(b"")
    (tmp_path / "text" / "t2.txt").write_bytes(b" \n ")
    got = sorted(tuple(r) for r in read_text_with_meta(spark, f"{tmp_path}/text", f"{tmp_path}/meta").select("code", "text").collect())
    assert got == sorted([("c0", "packed")] + [(f"c{i}", f"Über {i}\r\n\x00zwei") for i in range(30) if i not in (1, 2)])
    plan = read_text_with_meta(spark, f"{tmp_path}/text", f"{tmp_path}/meta")._jdf.queryExecution().toString()
    assert "binaryFile" in plan


def test_a_point_meets_one_interval_however_many_cover_it(spark):
    from labelspark.operators.intervals import first_parts

    spans = [(1, i, 5000 + i // 2, f"v{i % 7}") for i in range(300)] + [(1, 0, 9000, "w"), (2, 5, 9, "b"), (2, 5, 7, "a"), (2, 5, 7, "a"), (2, 4, 4, "c")]
    got = rows(first_parts(spark.createDataFrame(spans, "k int, start int, stop int, v string"), ["k"], "v"), "k", "start", "stop", "v")
    want = {p: min((s, e, v) for k, s, e, v in spans if k == 1 and s <= p < e)[2] for p in range(9000)}
    assert {p: v for k, s, e, v in got if k == 1 for p in range(s, e)} == want
    assert sum(e - s for k, s, e, _ in got if k == 1) == 9000 and len(got) == 4
    assert [r for r in got if r[0] == 2] == [(2, 5, 7, "a"), (2, 7, 9, "b")]


def test_small_pages_share_one_reader_class(monkeypatch):
    import builtins

    from labelspark.operators import extract as X

    made, build = [], builtins.__build_class__
    monkeypatch.setattr(builtins, "__build_class__", lambda *a, **k: (made.append(a[1]), build(*a, **k))[1])
    page = "<script>no</script><table><tr><td id='x'>a &amp;<br>b</td><th>c</th></tr></table>"
    assert [X._tables_of(page) for _ in range(3)] == [[(0, 0, ["a & b", "c"])]] * 3 and X._text_of(page) == "a & b c"
    assert made == []


def test_many_small_files_are_read_in_few_tasks(spark, tmp_path, monkeypatch):
    from labelspark.sources import readers as R

    for kind in ("text", "meta"):
        (tmp_path / kind).mkdir()
    for i in range(150):
        (tmp_path / "text" / f"d{i}.txt").write_text(f" text {i}\n")
        (tmp_path / "meta" / f"d{i}.json").write_text('{"name": "n%d",\n "code": "c%d"}' % (i, i))
    seen, join = [], R.join_text_with_meta
    monkeypatch.setattr(R, "join_text_with_meta", lambda a, b: (seen.extend([a, b]), join(a, b))[1])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4m")
    try:
        got = rows(R.read_text_with_meta(spark, str(tmp_path / "text"), str(tmp_path / "meta")), "name", "code", "text")
        most = 4 * spark.sparkContext.defaultParallelism
        assert most < 150 and all(df.rdd.getNumPartitions() <= most for df in seen) and len(seen) == 2
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == sorted((f"n{i}", f"c{i}", f"text {i}") for i in range(150))


def test_a_missing_page_has_no_text_and_an_empty_one_an_empty_text(spark):
    from labelspark.operators import extract as X

    pages = spark.createDataFrame([(1, None), (2, ""), (3, "<p>a</p>")], "k int, html string")
    assert rows(X.html_text(pages).where("text is null or true"), "k", "text") == [(1, None), (2, ""), (3, "a")]
    for text in (X.section_by_id, X.section_between):
        assert rows(text(pages), "k", "text") == [(1, None), (2, ""), (3, "")]
