"""Projections, filters, joins, set operations and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import functions as fn
from ..operators import aggregates as A
from ..operators import ontology as O
from ..operators import relational as R
from ..plans import labels as L
from .common import WS, query, rounded, sql_words

# --- scans and projections ------------------------------------------------------------------


@query("p01_vocab_filter_en", "SELECT * FROM atoms WHERE LAT = 'ENG' AND SAB = 'MDR' AND TTY IN ('PT', 'LLT')")
def _(t):
    return R.vocab_filter(t.atoms(), "ENG", "MDR").select("CUI", "LAT", "SAB", "TTY", "CODE", "STR", "SUPPRESS")


@query("p01_vocab_filter_ja", "SELECT CUI, CODE, STR FROM atoms WHERE LAT = 'JPN' AND SAB = 'MDRJPN' AND TTY IN ('PT', 'LLT')")
def _(t):
    return R.vocab_filter(t.atoms(), "JPN", "MDRJPN").select("CUI", "CODE", "STR")


@query("p02_distinct_terms", "SELECT DISTINCT CODE AS text_id, STR AS text FROM atoms WHERE LAT = 'ENG' AND SAB = 'MDR' AND TTY IN ('PT', 'LLT')")
def _(t):
    return R.distinct_terms(R.vocab_filter(t.atoms(), "ENG", "MDR"))


UNPIVOTED = """
    SELECT concat(set_id, '.', label_id, '.', spl_version, '.', section, '.US') AS text_id, text FROM (
        UNPIVOT (SELECT set_id, label_id, spl_version, AR, BW, WP FROM us_labels) ON AR, BW, WP INTO NAME section VALUE text)
    WHERE text IS NOT NULL AND strlen(text) > 0"""


def _region(r: str) -> str:
    return f"SELECT concat(code, '.AR.{r.upper()}') AS text_id, text FROM {r}_labels WHERE text IS NOT NULL AND strlen(text) > 0"


@query("p03_unpivot_sections", UNPIVOTED)
def _(t):
    return R.unpivot_sections(t.us_labels())


@query("p04_region_texts", _region("uk"))
def _(t):
    return R.region_texts(t.region_labels("UK"), "UK")


@query("p05_split_text_id_us", """
    SELECT text_id, split_part(text_id, '.', 1) AS setid, split_part(text_id, '.', 3) AS spl_version,
           split_part(text_id, '.', 4) AS label_section, term_id, round(pred0, 6) AS pred0, round(pred1, 6) AS pred1
    FROM scores WHERE ends_with(text_id, 'US')""")
def _(t):
    return rounded(R.split_text_id(t.scores(), "US"), "pred0", "pred1")


@query("p05_split_text_id_uk", """
    SELECT split_part(text_id, '.', 1) AS source_product_id, 'NA' AS label_section, term_id FROM scores WHERE ends_with(text_id, 'UK')""")
def _(t):
    return R.split_text_id(t.scores(), "UK").select("source_product_id", "label_section", "term_id")


@query("p06_unnest", "SELECT set_id, AR, OV FROM us_labels")
def _(t):
    packed = t.us_labels().select("set_id", F.struct("AR", "OV").alias("sections"))
    return R.unnest(packed, "sections")


@query("p07_drop_cols", "SELECT l_orderkey, l_partkey FROM lineitem")
def _(t):
    df = t.table("lineitem")
    return R.drop_cols(df, [c for c in df.columns if c not in ("l_orderkey", "l_partkey")])


@query("p08_where_present", "SELECT set_id FROM us_labels WHERE AR IS NOT NULL AND AR <> '' AND BW IS NOT NULL AND BW <> ''")
def _(t):
    return R.where_present(t.us_labels(), ["AR", "BW"]).select("set_id")


@query("p09_valid_id", "SELECT drug, pt_id, llt_id FROM annotated_events WHERE llt_id IS NOT NULL AND lower(trim(llt_id)) NOT IN ('', 'nan')")
def _(t):
    return R.where_valid_id(t.annotated_events(), "llt_id").select("drug", "pt_id", "llt_id")


@query("p10_score_above", "SELECT effect_id, round(pred1, 6) AS pred1 FROM all_effects WHERE pred1 IS NULL OR pred1 > 3.258")
def _(t):
    return rounded(R.score_above(t.effects(), 3.258).select("effect_id", "pred1"), "pred1")


@query("p11_score_above_by_section", """
    SELECT effect_id, label_section FROM all_effects WHERE pred1 IS NULL
        OR pred1 > CASE label_section WHEN 'AR' THEN 2.6926 WHEN 'BW' THEN 4.8713 WHEN 'WP' THEN 3.5878 END""")
def _(t):
    return R.score_above_by_section(
        t.effects(), {"AR": 2.6926, "BW": 4.8713, "WP": 3.5878}
    ).select("effect_id", "label_section")


@query("p12_sections_in", "SELECT effect_id, label_section FROM all_effects WHERE label_section IN ('AR', 'BW')")
def _(t):
    return R.sections_in(t.effects(), "ARBW", "label_section").select("effect_id", "label_section")


@query("p13_by_source", "SELECT drug, flag2 AS source_method FROM annotated_events WHERE flag2 = 'exact' OR (flag2 = 'human' AND pt_id IS NOT NULL)")
def _(t):
    refset = t.annotated_events().select(
        "drug", F.when((F.col("flag2") == "human") & F.col("pt_id").isNotNull(), "exact").otherwise("deepcadrme").alias("source_method"),
        F.lit("is_event").alias("class"), F.lit("").alias("string"))
    return R.by_source(refset, "exact").select("drug", F.lit("human").alias("source_method"))


FLAG1 = """
    SELECT *, CASE WHEN pt_id IS NULL THEN 'unmapped' WHEN count(*) OVER (PARTITION BY drug, section, pt_id) > 1 THEN 'duplicate'
              ELSE 'clean' END AS flag1 FROM annotated_events"""


@query("p14_exclude_flags", f"""
    SELECT drug, section, pt_id, flag1, flag2 FROM ({FLAG1}) WHERE flag1 NOT IN ('duplicate', 'unmapped') AND flag2 NOT IN ('drug_class', 'animal')""")
def _(t):
    events = A.flag1(t.annotated_events(), ["drug", "section"])
    return R.exclude_flags(events, ("duplicate", "unmapped"), ("drug_class", "animal")).select(
        "drug", "section", "pt_id", "flag1", "flag2")


@query("p15_min_length", "SELECT text_id, text AS term FROM vocabulary WHERE length(text) >= 8")
def _(t):
    return R.min_length(t.vocabulary().withColumnRenamed("text", "term"), 8)


AVAILABLE = f"""
    SELECT set_id, list_filter([CASE WHEN regexp_matches(coalesce(AR, ''), '[^{WS[1:-1]}]') THEN 'AR' END,
        CASE WHEN regexp_matches(coalesce(BW, ''), '[^{WS[1:-1]}]') THEN 'BW' END, CASE WHEN regexp_matches(coalesce(WP, ''), '[^{WS[1:-1]}]') THEN 'WP' END,
        CASE WHEN regexp_matches(coalesce(SP, ''), '[^{WS[1:-1]}]') THEN 'SP' END, CASE WHEN regexp_matches(coalesce(OV, ''), '[^{WS[1:-1]}]') THEN 'OV' END], lambda x: x IS NOT NULL) AS avail,
        array_to_string({sql_words('title')}, ' ') AS title FROM us_labels"""


@query("p16_available_sections", "SELECT set_id, array_to_string(avail, ',') AS sections_available FROM available", available=AVAILABLE)
def _(t):
    return L.with_available_sections(t.us_labels()).select(
        "set_id", F.array_join("sections_available", ",").alias("sections_available"))


@query("p17_having_sections", """
    SELECT set_id, array_to_string([x for x in avail if x in ('BW', 'WP')], ',') AS sections_available
    FROM available WHERE list_has_any(avail, ['BW', 'WP'])""", available=AVAILABLE)
def _(t):
    return L.having_sections(L.label_index(t.us_labels()), ["BW", "WP"]).select(
        "set_id", F.array_join("sections_available", ",").alias("sections_available"))


@query("p18_search_labels", "SELECT set_id, title FROM available WHERE contains(lower(title), 'src1 tab') OR contains(lower(title), 'safely. de')", available=AVAILABLE)
def _(t):
    index = L.label_index(t.us_labels())
    return L.search_labels(index, "SRC1 tab").unionByName(
        L.search_labels(index, "safely. DE")).dropDuplicates(["set_id"]).select("set_id", "title")


@query("s01_parquet_scan", "SELECT doc_id, lang, source, n_chars FROM documents")
def _(t):
    return t.table("documents").drop("text")


@query("s02_pruned_scan", "SELECT l_orderkey, round(l_extendedprice, 6) AS l_extendedprice FROM lineitem")
def _(t):
    from ..sources.readers import read_cols

    return rounded(read_cols(t.spark, f"{t.dir}/lineitem.parquet", ["l_orderkey", "l_extendedprice"]), "l_extendedprice")


@query("s12_label_manifest", """
    SELECT p_name AS name, 'EMEA/' || p_partkey AS code, 'https://medicines.example/' || p_partkey AS page_url
    FROM part WHERE p_partkey % 3 <> 0""")
def _(t):
    from ..sources.readers import label_manifest

    k = F.col("p_partkey").cast("string")
    return label_manifest(t.table("part").select(
        F.when(F.col("p_partkey") % 3 == 0, "Veterinary").otherwise("Human").alias("Category"),
        F.col("p_name").alias("Name of medicine"), F.concat(F.lit("EMEA/"), k).alias("EMA product number"),
        F.concat(F.lit("https://medicines.example/"), k).alias("Medicine URL"), "p_size"))


@query("s16_append_rows", """
    SELECT label_id, source, source_product_name, source_product_id, source_label_url FROM product_label WHERE source = 'US'
    UNION ALL SELECT (SELECT max(label_id) FROM product_label WHERE source = 'US')
              + row_number() OVER (ORDER BY source, source_product_id, source_product_name), source, source_product_name, source_product_id, NULL
    FROM product_label WHERE source IN ('UK', 'EU')""")
def _(t):
    have = t.labels().where("source = 'US'")
    new = t.labels().where("source in ('UK', 'EU')").select("source", "source_product_name", "source_product_id")
    return R.append_rows(have, new, "label_id", ["source", "source_product_id", "source_product_name"])


# --- joins ----------------------------------------------------------------------------------


@query("j01_us_join", """
    SELECT setid, spl_version, label_section, term_id, rxcui, title AS source_product_name, setid || '.' || spl_version AS source_product_id
    FROM (SELECT split_part(text_id, '.', 1) AS setid, split_part(text_id, '.', 3) AS spl_version,
                 split_part(text_id, '.', 4) AS label_section, term_id FROM scores WHERE ends_with(text_id, 'US'))
    JOIN us_map USING (setid, spl_version) JOIN us_meta USING (setid, spl_version) WHERE title <> 'NOT A DRUG LABEL'""")
def _(t):
    scores = R.split_text_id(t.scores(), "US").drop("text_id", "pred0", "pred1")
    return R.us_join(scores, t.us_map(), t.us_meta())


@query("j02_region_join", """
    SELECT s.source_product_id, s.term_id, m.name, c.rxcui
    FROM (SELECT split_part(text_id, '.', 1) AS source_product_id, term_id FROM scores WHERE ends_with(text_id, 'UK')) s
    JOIN uk_meta m ON m.code = s.source_product_id JOIN uk_codes c ON c.code = s.source_product_id""")
def _(t):
    scores = R.split_text_id(t.scores(), "UK").select("source_product_id", "term_id")
    meta = t.order_labels("UK").select(F.col("code").alias("source_product_id"), "name")
    ids = t.order_codes("UK").withColumnRenamed("code", "source_product_id")
    return R.region_join(scores, meta, ids)


HOP = """SELECT a.concept_code AS from_code, a.concept_name AS from_name, b.concept_code AS to_code, b.concept_name AS to_name
    FROM nodes a JOIN edges e ON a.concept_id = e.concept_id_1 JOIN nodes b ON e.concept_id_2 = b.concept_id
    WHERE b.vocabulary_id IN ('RxNorm', 'RxNorm Extension') AND e.relationship_id = 'Maps to'"""


@query("j03_one_hop", HOP)
def _(t):
    return O.one_hop(t.nodes(), t.edges(), "Maps to", O.DRUG_VOCABULARIES)


@query("j04_preferred_map", "SELECT * FROM preferred")
def _(t):
    return O.preferred_map(t.nodes(), t.edges())


BILINGUAL = """SELECT e.CODE AS code, e.TTY AS tty, e.STR AS eng_str, j.STR AS jpn_str
    FROM (SELECT * FROM atoms WHERE LAT = 'ENG' AND SAB = 'MDR' AND TTY IN ('PT', 'LLT')) e
    JOIN (SELECT * FROM atoms WHERE LAT = 'JPN' AND SAB = 'MDRJPN' AND TTY IN ('PT', 'LLT')) j USING (CODE)"""


@query("j05_bilingual_map", BILINGUAL)
def _(t):
    return O.bilingual_map(R.vocab_filter(t.atoms(), "ENG", "MDR"), R.vocab_filter(t.atoms(), "JPN", "MDRJPN"))


@query("j06_join_keys", "SELECT o_orderkey, o_custkey, c_custkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey")
def _(t):
    return R.join_keys(t.table("orders").select("o_orderkey", "o_custkey"),
                       t.table("customer").select("c_custkey", "c_name"), "o_custkey", "c_custkey")


@query("j07_left_default", """
    SELECT rxnorm_product_id, label_id, coalesce(rxnorm_name, 'Unknown') AS rxnorm_name, coalesce(rxnorm_term_type, 'Unknown') AS rxnorm_term_type
    FROM d_p2r LEFT JOIN d_product ON rxnorm_product_id = rxnorm_id""")
def _(t):
    d = t.damaged()
    return R.left_default(d.product_to_rxnorm, d.vocab_rxnorm_product, "rxnorm_product_id", "rxnorm_id", "Unknown")


@query("j08_left_on_filtered", """
    SELECT product_id, ingredient_id, rxnorm_name, rxnorm_term_type
    FROM vocab_rxnorm_ingredient_to_product LEFT JOIN vocab_rxnorm_product ON product_id = rxnorm_id AND rxnorm_term_type = 'ECONOMY'""")
def _(t):
    return R.left_on_filtered(t.ingredient_links(), t.products(), "product_id", "rxnorm_id",
                              F.col("rxnorm_term_type") == "ECONOMY")


@query("j09_left_first_of", """
    SELECT i.meddra_id, coalesce(a.n, b.n, 'Unknown') AS meddra_name FROM (SELECT DISTINCT effect_meddra_id AS meddra_id FROM all_effects) i
    LEFT JOIN (SELECT meddra_id, min(meddra_name) AS n FROM vocab_meddra_adverse_effect WHERE meddra_id % 3 = 0 GROUP BY 1) a USING (meddra_id)
    LEFT JOIN (SELECT CAST(concept_code AS BIGINT) AS meddra_id, min(concept_name) AS n FROM nodes
               WHERE vocabulary_id = 'MedDRA' AND CAST(concept_code AS BIGINT) % 5 <> 0 GROUP BY 1) b USING (meddra_id)""")
def _(t):
    from ..plans.build import left_first_of

    ids = t.effects().select(F.col("effect_meddra_id").alias("meddra_id")).distinct()
    second = t.nodes().where("vocabulary_id = 'MedDRA'").select(
        F.col("concept_code").cast("bigint").alias("meddra_id"), F.col("concept_name").alias("meddra_name"))
    return left_first_of(ids, t.effect_vocab().where("meddra_id % 3 = 0"), second.where("meddra_id % 5 <> 0"),
                         "meddra_id", ["meddra_name"])


@query("j10_orphans", "SELECT p.* FROM d_p2r p LEFT JOIN d_label l ON p.label_id = l.label_id WHERE l.label_id IS NULL")
def _(t):
    d = t.damaged()
    return R.orphans(d.product_to_rxnorm, d.product_label, "label_id")


@query("j11_anti", "SELECT label_id FROM d_label ANTI JOIN d_p2r USING (label_id)")
def _(t):
    d = t.damaged()
    return R.anti(d.product_label, d.product_to_rxnorm, "label_id").select("label_id")


@query("j13_semi", "SELECT effect_id FROM d_effect WHERE effect_meddra_id IN (SELECT meddra_id FROM d_meddra)")
def _(t):
    d = t.damaged()
    return R.semi(d.product_adverse_effect, d.vocab_meddra_adverse_effect, "effect_meddra_id", "meddra_id").select("effect_id")


@query("j14_keep_parents", """
    SELECT p.label_id, p.source FROM d_label p JOIN (SELECT DISTINCT label_id FROM d_p2r JOIN d_i2p ON rxnorm_product_id = product_id) USING (label_id)""")
def _(t):
    d = t.damaged()
    keys = d.product_to_rxnorm.join(
        d.vocab_rxnorm_ingredient_to_product.withColumnRenamed("product_id", "rxnorm_product_id"), "rxnorm_product_id")
    return R.keep_parents(d.product_label, keys, "label_id").select("label_id", "source")


@query("j15_delete_using", """
    SELECT * FROM d_p2r p WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_quantity > 40 AND l_orderkey = p.label_id
        AND CAST(l_partkey AS VARCHAR) = p.rxnorm_product_id)""")
def _(t):
    victims = t.table("lineitem").where("l_quantity > 40").select(
        F.col("l_orderkey").alias("label_id"), F.col("l_partkey").cast("string").alias("rxnorm_product_id"))
    return R.delete_using(t.product_map(), victims, ["label_id", "rxnorm_product_id"])


@query("j16_keep_if_both", """
    SELECT * FROM d_i2p WHERE product_id IN (SELECT rxnorm_id FROM d_product) AND ingredient_id IN (SELECT rxnorm_id FROM d_ingredient)""")
def _(t):
    d = t.damaged()
    return R.keep_if_both(d.vocab_rxnorm_ingredient_to_product, ("product_id", d.vocab_rxnorm_product, "rxnorm_id"),
                          ("ingredient_id", d.vocab_rxnorm_ingredient, "rxnorm_id"))


@query("j17_cross_scalar", "SELECT a.n AS n_labels, b.n AS n_effects FROM (SELECT count(*) AS n FROM product_label) a, (SELECT count(*) AS n FROM all_effects) b")
def _(t):
    effects = t.effects().agg(F.count(F.lit(1)).alias("n"))
    return t.labels().agg(F.count(F.lit(1)).alias("n_labels")).select("n_labels", effects.scalar().alias("n_effects"))


@query("j18_group_total", """
    SELECT source, label_id, (SELECT count(*) FROM product_label x WHERE x.source = p.source) AS n_in_source FROM product_label p""")
def _(t):
    return A.with_group_count(t.labels().select("source", "label_id"), ["source"], "n_in_source")


@query("j19_scalar_report", """
    SELECT (SELECT count(*) FROM product_label) AS labels, (SELECT count(DISTINCT label_id) FROM product_to_rxnorm) AS mapped,
           (SELECT count(DISTINCT effect_meddra_id) FROM all_effects) AS effects""")
def _(t):
    one = lambda df, e: df.agg(e.alias("v")).scalar()
    return t.labels().agg(F.count(F.lit(1)).alias("labels")).select(
        "labels", one(t.product_map(), F.countDistinct("label_id")).alias("mapped"),
        one(t.effects(), F.countDistinct("effect_meddra_id")).alias("effects"))


@query("j25_point_in_interval", """
    SELECT o_orderkey, CASE WHEN d < 100 THEN 'early' WHEN d BETWEEN 100 AND 899 THEN 'middle' ELSE 'human' END AS kind
    FROM (SELECT o_orderkey, o_orderkey % 1000 AS d FROM orders)""")
def _(t):
    from ..operators.evidence import point_in_interval

    spans = F.array(*[
        F.struct(F.lit(a).alias("start"), F.lit(b).alias("stop"), F.lit(k).alias("kind"))
        for a, b, k in ((0, 100, "early"), (100, 900, "middle"))])
    return t.table("orders").select(
        "o_orderkey", point_in_interval(F.col("o_orderkey") % 1000, spans, "kind", "human").alias("kind"))


@query("j25_interval_table", """
    SELECT o_orderkey, coalesce(min({'a': start, 'b': stop, 'kind': kind}).kind, 'human') AS kind FROM (
        SELECT o_orderkey, o_custkey % 50 AS k, CAST(o_totalprice AS BIGINT) % 20000 AS at FROM orders) p
    LEFT JOIN (SELECT l_suppkey % 50 AS k, CAST(l_extendedprice AS BIGINT) % 20000 AS start,
                      CAST(l_extendedprice AS BIGINT) % 20000 + CAST(l_quantity * l_quantity AS BIGINT) AS stop,
                      l_returnflag AS kind FROM lineitem WHERE l_orderkey % 20 = 0) i
    ON p.k = i.k AND i.start <= p.at AND p.at < i.stop GROUP BY o_orderkey""")
def _(t):
    from ..operators.intervals import value_at

    # halves go to the even number, as SQL casts a double
    points = t.table("orders").select("o_orderkey", (F.col("o_custkey") % 50).alias("k"), (F.rint("o_totalprice").cast("long") % 20000).alias("at"))
    start = F.rint("l_extendedprice").cast("long") % 20000
    spans = t.table("lineitem").where("l_orderkey % 20 = 0").select(
        (F.col("l_suppkey") % 50).alias("k"), start.alias("start"),
        (start + F.rint(F.col("l_quantity") * F.col("l_quantity")).cast("long")).alias("stop"), F.col("l_returnflag").alias("kind"))
    return value_at(points, spans, ["k"], "at", "kind", "human").select("o_orderkey", "kind")


@query("j26_in_keys", "SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')")
def _(t):
    keys = t.table("orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("l_orderkey"))
    return R.in_keys(t.table("lineitem").select("l_orderkey", "l_linenumber"), keys, "l_orderkey")


@query("j27_attach_scores", "SELECT effect_id AS match_id, label_section, n, round(pred0, 6) AS pred0, round(pred1, 6) AS pred1 FROM "
       "(SELECT effect_id, min(label_section) AS label_section, count(*) AS n FROM all_effects GROUP BY 1) JOIN "
       "(SELECT effect_id, min(pred0) AS pred0, min(pred1) AS pred1 FROM all_effects GROUP BY 1) USING (effect_id)")
def _(t):
    e = t.effects().withColumnRenamed("effect_id", "match_id")
    left = e.groupBy("match_id").agg(F.min("label_section").alias("label_section"), F.count(F.lit(1)).alias("n"))
    right = e.groupBy("match_id").agg(F.min("pred0").alias("pred0"), F.min("pred1").alias("pred1"))
    return rounded(R.attach_scores(left, right), "pred0", "pred1")


NDC = """
    SELECT replace(kegg_id, 'dr:', '') AS kegg_id, b.concept_code AS rxnorm_code
    FROM (SELECT kegg_id, replace(replace(ndc_id, 'ndc:', ''), '-', '') AS n FROM kegg) k
    JOIN nodes a ON CASE WHEN length(n) = 8 THEN '0' || n ELSE n END = a.concept_code AND a.vocabulary_id = 'NDC'
    JOIN edges e ON a.concept_id = e.concept_id_1 AND e.relationship_id = 'Maps to'
    JOIN nodes b ON e.concept_id_2 = b.concept_id AND b.vocabulary_id IN ('RxNorm', 'RxNorm Extension')"""


@query("j28_ndc_to_drug", NDC)
def _(t):
    return O.ndc_to_drug(t.kegg(), t.nodes(), t.edges())


# --- set operations -------------------------------------------------------------------------

TEXTS = f"{UNPIVOTED} UNION {_region('uk')} UNION {_region('eu')}"


@query("u01_union_texts", TEXTS)
def _(t):
    return R.union_texts(R.unpivot_sections(t.us_labels()), R.region_texts(t.region_labels("UK"), "UK"),
                         R.region_texts(t.region_labels("EU"), "EU"))


PRIORITY = """SELECT CODE AS id, STR AS name, 1 AS source_priority FROM atoms WHERE SAB = 'RXNORM'
    UNION ALL SELECT concept_code, concept_name, 2 FROM nodes WHERE vocabulary_id IN ('RxNorm', 'RxNorm Extension')"""


@query("u02_union_priority", PRIORITY)
def _(t):
    a = t.atoms().where("SAB = 'RXNORM'").select(F.col("CODE").alias("id"), F.col("STR").alias("name"))
    b = t.nodes().where(F.col("vocabulary_id").isin(*O.DRUG_VOCABULARIES)).select(
        F.col("concept_code").alias("id"), F.col("concept_name").alias("name"))
    return R.union_priority(a, b)


@query("u03_union_names", f"""
    SELECT from_name AS term, to_code AS concept_code FROM ({HOP})
    UNION SELECT concept_name, concept_code FROM nodes WHERE vocabulary_id IN ('RxNorm', 'RxNorm Extension')""")
def _(t):
    mapped = O.one_hop(t.nodes(), t.edges(), "Maps to", O.DRUG_VOCABULARIES).select(
        F.col("from_name").alias("term"), F.col("to_code").alias("concept_code"))
    own = t.nodes().where(F.col("vocabulary_id").isin(*O.DRUG_VOCABULARIES)).select(
        F.col("concept_name").alias("term"), "concept_code")
    return R.union_names(mapped, own)


FLAGS = """SELECT l_suppkey AS ingredient_id, effect_meddra_id, max(CAST(source = 'US' AS INT)) AS US, max(CAST(source = 'UK' AS INT)) AS UK,
    max(CAST(source = 'EU' AS INT)) AS EU, max(CAST(source = 'JP' AS INT)) AS JP
    FROM (SELECT effect_meddra_id // 10 AS l_suppkey, effect_meddra_id, product_label_id FROM all_effects) JOIN product_label ON product_label_id = label_id GROUP BY 1, 2"""


@query("u04_combination_counts", " UNION ALL ".join(
    f"SELECT '{'-'.join(c)}' AS source_combo, count(*) AS num_ades, count(DISTINCT ingredient_id) AS num_ingredients, "
    f"count(DISTINCT effect_meddra_id) AS num_effects FROM sup_flags WHERE {' AND '.join(f'{s} = 1' for s in c)}"
    for c in A.source_combinations()), sup_flags=FLAGS)
def _(t):
    rel = t.effects().select(
        F.floor(F.col("effect_meddra_id") / 10).alias("ingredient_id"), "effect_meddra_id",
        F.col("product_label_id").alias("label_id")).join(t.labels().select("label_id", "source"), "label_id")
    return A.combination_counts(A.source_flags(rel, ["ingredient_id", "effect_meddra_id"]))


@query("u05_effects_in_all", " INTERSECT ".join(
    f"SELECT effect_meddra_id FROM all_effects JOIN product_label ON product_label_id = label_id WHERE source = '{s}'" for s in ("US", "UK", "JP")))
def _(t):
    rel = t.effects().select("effect_meddra_id", F.col("product_label_id").alias("label_id")).join(
        t.labels().select("label_id", "source"), "label_id")
    return A.effects_in_all(rel, ["US", "UK", "JP"])


# --- functions, each over a whole table -----------------------------------------------------


@query("f01_lower", "SELECT doc_id, lower(text) AS v FROM documents")
def _(t):
    return t.documents().select("doc_id", F.lower("text").alias("v"))


@query("f02_concat_skip_null", "SELECT set_id, concat(BW, '|', WP, '|', PR, OV) AS v FROM us_labels")
def _(t):
    return t.us_labels().select("set_id", fn.concat_skip_null("BW", F.lit("|"), "WP", F.lit("|"), "PR", "OV").alias("v"))


@query("f03_split_suffix_length", """
    SELECT text_id, split_part(text_id, '.', 4) AS section, ends_with(text_id, 'US') AS is_us, strlen(text_id) AS n_bytes FROM scores""")
def _(t):
    return t.scores().select("text_id", fn.part("text_id", ".", 4).alias("section"),
                             fn.has_suffix("text_id", "US").alias("is_us"), F.octet_length("text_id").alias("n_bytes"))


@query("f04_strip_tokens", "SELECT replace(kegg_id, 'dr:', '') AS kegg_id, replace(replace(ndc_id, 'ndc:', ''), '-', '') AS ndc_id FROM kegg")
def _(t):
    return t.kegg().select(fn.strip_tokens("kegg_id", "dr:").alias("kegg_id"), fn.strip_tokens("ndc_id", "ndc:", "-").alias("ndc_id"))


@query("f05_case_coalesce_trim", """
    SELECT o_orderkey, coalesce(CASE WHEN o_totalprice > 200000 THEN trim('  ' || o_orderpriority || ' ') END, 'none') AS v FROM orders""")
def _(t):
    return t.table("orders").select("o_orderkey", F.coalesce(F.when(
        F.col("o_totalprice") > 200000, F.trim(F.concat(F.lit("  "), "o_orderpriority", F.lit(" ")))), F.lit("none")).alias("v"))


@query("f06_casts", """
    SELECT CUI, try_cast(CODE AS BIGINT) AS code, try_cast(CODE AS DOUBLE) AS code_d, CAST(LAT = 'ENG' AS INT) AS is_en FROM atoms""")
def _(t):
    return t.atoms().select("CUI", fn.to_int("CODE").alias("code"), fn.to_double("CODE").alias("code_d"),
                            (F.col("LAT") == "ENG").cast("int").alias("is_en"))


@query("f07_squeeze", f"SELECT doc_id, trim(regexp_replace(text, '{WS}+', ' ', 'g')) AS v FROM documents")
def _(t):
    return t.documents().select("doc_id", fn.squeeze("text").alias("v"))


@query("f08_counts", f"SELECT doc_id, len({sql_words('text')}) AS n_words, length(text) AS n_chars FROM documents")
def _(t):
    return t.documents().select("doc_id", fn.n_words("text").cast("bigint").alias("n_words"), fn.n_chars("text").cast("bigint").alias("n_chars"))


@query("f09_regex", r"""
    SELECT doc_id, regexp_matches(text, '(?i)\bthe\s+of|\band\s+the\b') AS found,
           regexp_extract(text, '([A-Z][a-z]+)\.', 1) AS word, regexp_replace(text, '[aeiou]', '', 'g') AS bare FROM documents""")
def _(t):
    return t.documents().select(
        "doc_id", fn.matches_any("text", [r"\bthe\s+of", r"\band\s+the\b"]).alias("found"),
        F.regexp_extract("text", r"([A-Z][a-z]+)\.", 1).alias("word"), F.regexp_replace("text", "[aeiou]", "").alias("bare"))


@query("f10_drug_name", "SELECT set_id, upper(substr(OV, 1, 0)) || regexp_extract(title, 'to use (.+?) tablets safely', 1) AS drug_name FROM us_labels")
def _(t):
    return t.us_labels().select("set_id", fn.drug_name("title").alias("drug_name"))


@query("f11_slug", r"""
    SELECT doc_id, CASE WHEN strlen(c) > 220 THEN substr(c, 1, list_max(list_filter(range(52, 212), lambda n: strlen(substr(c, 1, n)) <= 211)))
               || '_' || substr(md5(raw), 1, 8) WHEN c = '' THEN 'medicine_' || substr(md5(raw), 1, 12) ELSE c END AS slug
    FROM (SELECT doc_id, raw, regexp_replace(replace(lower(raw), ' ', '_'), '[^\p{L}\p{N}_\-]', '', 'g') AS c
          FROM (SELECT doc_id, CASE WHEN doc_id % 7 = 1 THEN lang WHEN doc_id % 7 = 2 THEN '?!' || source ELSE text END AS raw FROM documents))""")
def _(t):
    return t.documents().select("doc_id", fn.slug(
        F.when(F.col("doc_id") % 7 == 1, F.col("lang")).when(F.col("doc_id") % 7 == 2, F.concat(F.lit("?!"), "source"))
        .otherwise(F.col("text"))).alias("slug"))


@query("f12_array_terms", """
    SELECT set_id, array_to_string(list_slice(list_filter([BW, SP, PR, OV], lambda x: x IS NOT NULL), 1, 2), '|') AS v FROM us_labels""")
def _(t):
    return t.us_labels().select("set_id", F.array_join(F.slice(fn.non_null_terms("BW", "SP", "PR", "OV"), 1, 2), "|").alias("v"))


@query("f13_id_string", """
    SELECT drug, CAST(CAST(try_cast(pt_id AS DOUBLE) AS BIGINT) AS VARCHAR) AS pt,
           CASE WHEN llt_id NOT IN ('', 'NaN') THEN CAST(CAST(try_cast(llt_id AS DOUBLE) AS BIGINT) AS VARCHAR) END AS llt FROM annotated_events""")
def _(t):
    return t.annotated_events().select("drug", fn.id_string("pt_id").alias("pt"), fn.id_string("llt_id").alias("llt"))


@query("f14_url", "SELECT 'https://labels.example/?id=' || c_name || '&seg=' || c_mktsegment AS v FROM customer")
def _(t):
    return t.table("customer").select(fn.url("https://labels.example/?id=", F.col("c_name"), "&seg=", F.col("c_mktsegment")).alias("v"))


@query("f15_class_and_relu", """
    SELECT effect_id, CASE WHEN pred1 - 4 > pred0 * 10 THEN 1 ELSE 0 END AS cls, round(greatest(pred1 - 4, 0), 6) AS clamped
    FROM all_effects WHERE pred1 IS NOT NULL""")
def _(t):
    e = t.effects().where("pred1 is not null").select(
        "effect_id", (F.col("pred0") * 10).alias("a"), (F.col("pred1") - 4).alias("b"))
    return rounded(e.select("effect_id", fn.predicted_class("a", "b").alias("cls"), fn.relu("b").alias("clamped")), "clamped")
