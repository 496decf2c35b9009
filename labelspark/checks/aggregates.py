"""Aggregations, windows, ordering and paging."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import n_words
from ..operators import aggregates as A
from ..operators.extract import pad_rows
from ..operators.ordered import number_rows, with_surrogate_id
from ..plans import labels as L
from ..plans.evaluation import pr_curve
from ..session import stage
from .common import longs, query, rounded, sql_words
from .relational import AVAILABLE, FLAG1


@query("a01_count_by", "SELECT l_returnflag, count(*) AS n FROM lineitem GROUP BY 1")
def _(t):
    return A.count_by(t.table("lineitem"), "l_returnflag")


@query("a02_count_distinct_by", "SELECT effect_meddra_id, count(DISTINCT product_label_id) AS n FROM all_effects GROUP BY 1")
def _(t):
    return A.count_distinct_by(t.effects(), "effect_meddra_id", "product_label_id")


@query("a03_multi_distinct", """
    SELECT count(*) AS n_rows, count(DISTINCT product_label_id) AS n_product_label_id, count(DISTINCT effect_meddra_id) AS n_effect_meddra_id,
           count(DISTINCT label_section) AS n_label_section FROM all_effects""")
def _(t):
    return A.multi_distinct(t.effects(), ["product_label_id", "effect_meddra_id", "label_section"])


@query("a04_source_flags", """
    SELECT source_product_name, count(DISTINCT source) AS num_sources, max(CAST(source = 'US' AS INT)) AS US,
           max(CAST(source = 'UK' AS INT)) AS UK, max(CAST(source = 'EU' AS INT)) AS EU, max(CAST(source = 'JP' AS INT)) AS JP
    FROM product_label GROUP BY 1""")
def _(t):
    return A.source_flags(t.labels(), ["source_product_name"])


@query("a05_having_distinct", """
    SELECT product_label_id FROM all_effects GROUP BY 1 HAVING count(DISTINCT label_section) = 2""")
def _(t):
    return A.having_distinct(t.effects(), ["product_label_id"], "label_section", 2)


@query("a06_count_stats", """
    SELECT round(avg(c), 6) AS avg_items, min(c) AS min_items, max(c) AS max_items, count(*) AS total_products FROM (
        SELECT o_orderkey, count(l_orderkey) AS c FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey AND l_quantity > 30 GROUP BY 1)""")
def _(t):
    return rounded(A.count_stats(t.table("orders"), t.table("lineitem").where("l_quantity > 30"), "o_orderkey", "l_orderkey", "items"), "avg_items")


@query("a07_ratio", "SELECT l_suppkey, round(count(*) FILTER (l_returnflag = 'A') / count(*), 6) AS share FROM lineitem GROUP BY 1")
def _(t):
    from ..functions import ratio

    g = t.table("lineitem").groupBy("l_suppkey").agg(
        F.count_if(F.col("l_returnflag") == "A").alias("a"), F.count(F.lit(1)).alias("n"))
    return rounded(g.select("l_suppkey", ratio("a", "n").alias("share")), "share")


@query("a08_distinct_rows", "SELECT DISTINCT l_partkey, l_returnflag FROM lineitem")
def _(t):
    return A.distinct_rows(t.table("lineitem"), ["l_partkey", "l_returnflag"])


@query("a09_code_sets", """
    SELECT drug, section, string_agg(DISTINCT code, ',' ORDER BY code) AS codes FROM (
        SELECT drug, section, CAST(CAST(CAST(pt_id AS DOUBLE) AS BIGINT) AS VARCHAR) AS code FROM annotated_events WHERE pt_id IS NOT NULL
        UNION ALL SELECT drug, section, CAST(CAST(CAST(llt_id AS DOUBLE) AS BIGINT) AS VARCHAR) FROM annotated_events WHERE llt_id NOT IN ('', 'NaN'))
    GROUP BY 1, 2""")
def _(t):
    sets = A.code_sets(t.annotated_events(), ["drug", "section"], ["pt_id", "llt_id"])
    return sets.withColumn("codes", F.array_join("codes", ","))


PROFILE = f"""
    SELECT __KEY__, count(*) AS records, CAST(sum(CAST(n_events > 0 AS INT)) AS BIGINT) AS records_with_events,
           CAST(sum(n_events) AS BIGINT) AS total_events, CAST(sum(n_mapped) AS BIGINT) AS mapped_events,
           round(avg(n_words), 6) AS avg_words, round(sum(n_events) / count(*), 6) AS events_per_record,
           round(coalesce(100 * sum(n_mapped) / nullif(sum(n_events), 0), 0), 6) AS mapped_pct
    FROM (SELECT *, (SELECT count(*) FROM annotation_events e WHERE e.doc_id = r.doc_id AND pt IS NOT NULL) AS n_mapped,
                 len({sql_words('section_text')}) AS n_words FROM annotation_records r) GROUP BY __KEY__"""


@query("a10_profile_by_section", PROFILE.replace("__KEY__", "section_name"))
def _(t):
    return rounded(longs(A.profile_by_section(t.annotation_files()), "total_events", "mapped_events"),
                   "avg_words", "events_per_record", "mapped_pct")


@query("a11_length_stats", f"""
    SELECT lang, round(avg(w), 6) AS mean_words, quantile_cont(w, 0.5) AS median_words, quantile_cont(w, 0.25) AS p25_words,
           quantile_cont(w, 0.75) AS p75_words, min(w) AS min_words, max(w) AS max_words,
           round(avg(c), 6) AS mean_chars, quantile_cont(c, 0.5) AS median_chars, quantile_cont(c, 0.25) AS p25_chars,
           quantile_cont(c, 0.75) AS p75_chars, min(c) AS min_chars, max(c) AS max_chars
    FROM (SELECT lang, len({sql_words('text')}) AS w, length(text) AS c FROM documents) GROUP BY lang""")
def _(t):
    return rounded(A.text_length_stats(t.documents(), ["lang"], "text"), "mean_words", "mean_chars")


@query("a12_profile_all", f"""
    SELECT coalesce(dataset, 'TOTAL') AS dataset, count(*) AS records, CAST(sum(n_events) AS BIGINT) AS events,
           round(sum(n_events) / count(*), 6) AS events_per_record, round(avg(n_words), 6) AS avg_words,
           round(coalesce(100 * sum(n_mapped) / nullif(sum(n_events), 0), 0), 6) AS mapped_pct
    FROM (SELECT *, (SELECT count(*) FROM annotation_events e WHERE e.doc_id = r.doc_id AND pt IS NOT NULL) AS n_mapped,
                 len({sql_words('section_text')}) AS n_words FROM annotation_records r) GROUP BY ROLLUP (dataset)""")
def _(t):
    return rounded(longs(A.profile_all(t.annotation_files()), "events"), "events_per_record", "avg_words", "mapped_pct")


@query("a13_class_balance", """
    SELECT drug, section, count(*) FILTER (flag2 = 'human') AS n_pos, count(*) FILTER (flag2 <> 'human') AS n_neg
    FROM annotated_events GROUP BY GROUPING SETS ((drug, section), ())""")
def _(t):
    refset = t.annotated_events().withColumn("class", F.when(F.col("flag2") == "human", "is_event").otherwise("not_event"))
    return A.class_balance(refset)


@query("a14_flag_distribution", """
    SELECT flag2, count(*) AS n, round(100 * count(*) / (SELECT count(*) FROM annotated_events), 6) AS pct FROM annotated_events GROUP BY flag2""")
def _(t):
    return rounded(A.flag_distribution(t.annotated_events()), "pct")


def tool_documents(t):
    """Annotation-tool documents: one per order, its lines as annotations of their section."""
    line = t.table("lineitem").select(
        F.col("l_orderkey").alias("k"),
        F.when(F.col("l_returnflag") == "A", "AR").when(F.col("l_returnflag") == "N", "WP").otherwise("BW").alias("section"),
        F.struct(F.col("l_linenumber").cast("string").alias("id"), (F.col("l_suppkey") % 40 * 10 + 1).cast("string").alias("pt_code"),
                 F.when(F.col("l_quantity") > 25, (F.col("l_partkey") % 40 * 10 + 2).cast("string")).alias("term_code"),
                 F.col("l_quantity").cast("bigint").alias("start")).alias("a"))
    per_section = line.groupBy("k", "section").agg(F.sort_array(F.collect_list("a")).alias("anns"))
    maps = per_section.groupBy("k").agg(F.map_from_entries(F.collect_list(F.struct("section", "anns"))).alias("sections"))
    return maps.select(
        F.concat(F.lit("ann"), (F.col("k") % 3).cast("string")).alias("annotator"),
        F.concat(F.lit("set"), (F.floor(F.col("k") / 3)).cast("string")).alias("label_id"),
        F.concat(F.lit("Label "), F.col("k").cast("string")).alias("label_title"),
        F.when(F.col("k") % 2 == 0, "complete").otherwise("in_progress").alias("status"),
        F.lpad(F.col("k").cast("string"), 9, "0").alias("updated_at"), "sections", "k")


@query("a15_annotation_counts", """
    SELECT 'ann' || (l_orderkey % 3) AS annotator, 'set' || (l_orderkey // 3) AS label_id, 'Label ' || l_orderkey AS label_title,
           CASE WHEN l_orderkey % 2 = 0 THEN 'complete' ELSE 'in_progress' END AS status,
           lpad(CAST(l_orderkey AS VARCHAR), 9, '0') AS updated_at, count(*) AS annotation_count FROM lineitem GROUP BY l_orderkey""")
def _(t):
    return longs(A.annotation_counts(tool_documents(t)), "annotation_count")


@query("a15_label_status", """
    SELECT label_id, string_agg(annotator || '=' || status, ',' ORDER BY annotator) AS statuses FROM (
        SELECT DISTINCT 'set' || (l_orderkey // 3) AS label_id, 'ann' || (l_orderkey % 3) AS annotator,
               CASE WHEN l_orderkey % 2 = 0 THEN 'complete' ELSE 'in_progress' END AS status FROM lineitem) GROUP BY label_id""")
def _(t):
    s = A.label_status(tool_documents(t))
    return s.select("label_id", F.array_join(F.transform(
        F.map_entries("statuses"), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ",").alias("statuses"))


@query("a16_row_counts", " UNION ALL ".join(
    f"SELECT '{n}' AS table_name, count(*) AS n_rows, count(*) > 0 AS ok FROM {n}" for n in ("orders", "lineitem", "documents", "pages")))
def _(t):
    return A.row_counts({n: t.table(n) for n in ("orders", "lineitem", "documents", "pages")})


# --- windows --------------------------------------------------------------------------------


@query("w01_first_by_priority", """
    SELECT id, name FROM (SELECT id, name, row_number() OVER (PARTITION BY id ORDER BY source_priority, name) AS rn FROM (
        SELECT CODE AS id, STR AS name, 1 AS source_priority FROM atoms WHERE SAB = 'RXNORM'
        UNION ALL SELECT concept_code, concept_name, 2 FROM nodes WHERE vocabulary_id IN ('RxNorm', 'RxNorm Extension'))) WHERE rn = 1""")
def _(t):
    from ..operators.ontology import DRUG_VOCABULARIES
    from ..operators.relational import union_priority

    a = t.atoms().where("SAB = 'RXNORM'").select(F.col("CODE").alias("id"), F.col("STR").alias("name"))
    b = t.nodes().where(F.col("vocabulary_id").isin(*DRUG_VOCABULARIES)).select(
        F.col("concept_code").alias("id"), F.col("concept_name").alias("name"))
    return A.first_by_priority(union_priority(a, b), "id", "source_priority", ["name"])


@query("w02_flag1", f"SELECT drug, section, pt_id, flag1 FROM ({FLAG1})")
def _(t):
    return A.flag1(t.annotated_events(), ["drug", "section"]).select("drug", "section", "pt_id", "flag1")


@query("w03_number_rows", """
    SELECT o_orderkey, row_number() OVER (ORDER BY o_orderpriority, o_orderkey) - 1 AS no FROM orders""")
def _(t):
    return number_rows(t.table("orders").select("o_orderkey", "o_orderpriority"), ["o_orderpriority", "o_orderkey"], "no", start=0).select("o_orderkey", "no")


@query("w04_surrogate_id", """
    SELECT row_number() OVER (ORDER BY l_partkey, l_suppkey, l_returnflag) AS id, l_partkey, l_suppkey, l_returnflag FROM lineitem""")
def _(t):
    return with_surrogate_id(t.table("lineitem").select("l_partkey", "l_suppkey", "l_returnflag"), ["l_partkey", "l_suppkey"], "id")


@query("w05_pr_curve", """
    SELECT score AS threshold, pos, neg, tp, fp, round(tp / (tp + fp), 6) AS precision, round(tp / p, 6) AS recall,
           round(CASE WHEN tp = 0 THEN 0 ELSE 2 * tp / (tp + fp + p) END, 6) AS f1
    FROM (SELECT score, pos, neg, CAST(sum(pos) OVER w AS BIGINT) AS tp, CAST(sum(neg) OVER w AS BIGINT) AS fp, (SELECT sum(label) FROM scored_classes) AS p
          FROM (SELECT score, CAST(sum(label) AS BIGINT) AS pos, CAST(sum(1 - label) AS BIGINT) AS neg FROM scored_classes GROUP BY score)
          WINDOW w AS (ORDER BY score DESC ROWS UNBOUNDED PRECEDING))""")
def _(t):
    return rounded(pr_curve(t.scored_classes(), "label", "score"), "precision", "recall", "f1")


@query("w06_share_in_group", """
    SELECT source, label_section, n, total, round(n / total, 6) AS fraction FROM (
        SELECT source, label_section, count(DISTINCT label_id) AS n FROM all_effects JOIN product_label ON label_id = product_label_id GROUP BY 1, 2)
    JOIN (SELECT source, count(DISTINCT label_id) AS total FROM all_effects JOIN product_label ON label_id = product_label_id GROUP BY 1) USING (source)""")
def _(t):
    rel = t.effects().select(F.col("product_label_id").alias("label_id"), "label_section").join(t.labels().select("label_id", "source"), "label_id")
    return rounded(A.share_in_group(rel, "source", "label_id", "label_section"), "fraction")


@query("w07_pad_rows", """
    SELECT l_orderkey AS doc, l_linenumber AS row_no, n_cells, max(n_cells) OVER (PARTITION BY l_orderkey) AS n_padded FROM (
        SELECT l_orderkey, l_linenumber, CAST(l_quantity AS INT) % 6 + 1 AS n_cells FROM lineitem)""")
def _(t):
    cells = t.table("lineitem").select(
        F.col("l_orderkey").alias("doc"), F.col("l_linenumber").alias("row_no"),
        (F.col("l_quantity").cast("int") % 6 + 1).alias("n_cells")).withColumn("cells", F.array_repeat(F.lit("c"), F.col("n_cells")))
    return pad_rows(cells, ["doc"]).select("doc", "row_no", "n_cells", F.size("cells").alias("n_padded"))


# --- ordering and paging --------------------------------------------------------------------


@query("o01_top_k", "SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY 1 ORDER BY n DESC, l_partkey LIMIT 15")
def _(t):
    return A.top_k(A.count_by(t.table("lineitem"), "l_partkey"), "n", 15, "l_partkey")


@query("o02_top_rows", """
    SELECT effect_id, round(pred1, 6) AS pred1, effect_meddra_id FROM all_effects
    ORDER BY all_effects.pred1 DESC NULLS LAST, effect_id, effect_meddra_id LIMIT 20""")
def _(t):
    rows = t.effects().select("effect_id", "pred1", "effect_meddra_id")
    return rounded(A.top_rows(rows, "pred1", 20, ["effect_id", "effect_meddra_id"]), "pred1")


@query("o03_page", """
    SELECT c_custkey, c_name, (SELECT count(*) FROM customer) AS total, CAST(ceil((SELECT count(*) FROM customer) / 40) AS BIGINT) AS pages
    FROM customer ORDER BY c_name LIMIT 40 OFFSET 80""")
def _(t):
    return A.page(t.table("customer").select("c_custkey", "c_name"), ["c_name"], 3, 40)


@query("o04_seeded_order", """
    SELECT o_orderkey, lead(o_orderkey) OVER w AS follows, row_number() OVER w AS place FROM orders
    WINDOW w AS (ORDER BY md5('42:' || o_orderkey), o_orderkey)""")
def _(t):
    """The rows as the operator puts them, with their place and the next one's key."""
    ordered = stage(A.seeded_order(t.table("orders").select("o_orderkey"), "o_orderkey", 42).withColumn(
        "at", F.monotonically_increasing_id()), "seeded")
    placed = number_rows(ordered, ["at"], "place")
    after = placed.select(F.col("o_orderkey").alias("follows"), (F.col("place") - 1).alias("before"))
    return placed.join(after, placed["place"] == after["before"], "left").select("o_orderkey", "follows", "place")


@query("o05_search_vocab", """
    SELECT text AS term, v.text_id AS code, p.pt_code, p.pt_name FROM (
        SELECT 'Term ' || effect_meddra_id AS text, CAST(effect_meddra_id AS VARCHAR) AS text_id
        FROM (SELECT DISTINCT effect_meddra_id FROM all_effects) WHERE contains(lower('Term ' || effect_meddra_id), 'm 1') ORDER BY text, text_id LIMIT 50) v
    LEFT JOIN (SELECT llt_code, max(pt_code) AS pt_code, max(pt_name) AS pt_name FROM preferred GROUP BY 1) p ON p.llt_code = v.text_id""")
def _(t):
    from ..operators.ontology import preferred_map

    vocab = t.nodes().where("vocabulary_id = 'MedDRA'").select(F.col("concept_code").alias("text_id"), F.col("concept_name").alias("text"))
    return L.search_vocab(vocab, preferred_map(t.nodes(), t.edges()), "M 1", 50)


@query("q19_list_labels", """
    SELECT set_id, title, array_to_string([x for x in avail if x in ('BW', 'WP')], ',') AS sections_available,
           count(*) OVER () AS total, CAST(ceil(count(*) OVER () / 20) AS BIGINT) AS pages
    FROM available WHERE list_has_any(avail, ['BW', 'WP']) AND contains(lower(title), 'src1')
    ORDER BY lower(title), set_id LIMIT 20 OFFSET 0""", available=AVAILABLE)
def _(t):
    return L.list_labels(t.us_labels(), ["BW", "WP"], "SRC1", 1, 20).select(
        "set_id", "title", F.array_join("sections_available", ",").alias("sections_available"), "total", "pages")


@query("q19_list_labels_seeded", """
    SELECT set_id, title, array_to_string([x for x in avail if x in ('AR', 'BW', 'WP')], ',') AS sections_available,
           count(*) OVER () AS total, CAST(ceil(count(*) OVER () / 50) AS BIGINT) AS pages
    FROM available WHERE list_has_any(avail, ['AR', 'BW', 'WP']) ORDER BY md5('42:' || set_id), set_id LIMIT 50""", available=AVAILABLE)
def _(t):
    return L.list_labels(t.us_labels(), ["AR", "BW", "WP"], "", 1, 50).select(
        "set_id", "title", F.array_join("sections_available", ",").alias("sections_available"), "total", "pages")
