"""Analytical queries and integrity checks."""

from __future__ import annotations

from functools import reduce

from ..plans import analytics as Q
from ..plans import validation as V
from ..operators import aggregates as A
from ..operators.relational import not_in
from ..plans.integrity import apply_threshold, repair, repair_steps
from pyspark.sql import functions as F

from ..schemas import RELEASE_SCHEMAS

from .common import query, rounded

EFFECT = "Supplier#000000003-1"
INGREDIENT = "widget-8"

JOINED = """product_label JOIN product_to_rxnorm USING (label_id)
    JOIN vocab_rxnorm_ingredient_to_product ON rxnorm_product_id = product_id
    JOIN vocab_rxnorm_ingredient i ON ingredient_id = rxnorm_id
    JOIN product_adverse_effect ON label_id = product_label_id
    JOIN vocab_meddra_adverse_effect ON effect_meddra_id = meddra_id"""
LABELLED = """product_label JOIN product_adverse_effect ON label_id = product_label_id
    JOIN vocab_meddra_adverse_effect ON effect_meddra_id = meddra_id"""
SOURCED = """product_label l JOIN product_to_rxnorm lp USING (label_id)
    JOIN vocab_rxnorm_product p ON lp.rxnorm_product_id = p.rxnorm_id
    JOIN vocab_rxnorm_ingredient_to_product pi ON p.rxnorm_id = pi.product_id
    JOIN product_adverse_effect a ON l.label_id = a.product_label_id"""


@query("q01_ingredients_for_effect", f"SELECT DISTINCT i.* FROM {JOINED} WHERE meddra_name = '{EFFECT}'")
def _(t):
    return Q.ingredients_for_effect(t.release(), EFFECT)


@query("q02_effect_fraction", f"""
    SELECT round(a.n / b.n, 6) AS fraction FROM
    (SELECT count(DISTINCT label_id) AS n FROM {LABELLED} WHERE source = 'US' AND meddra_name = '{EFFECT}') a,
    (SELECT count(DISTINCT label_id) AS n FROM {LABELLED} WHERE source = 'US') b""")
def _(t):
    return rounded(Q.effect_fraction(t.release(), EFFECT, "US"), "fraction")


@query("q03_top_effects_by_ingredients", f"""
    SELECT meddra_name, count(DISTINCT ingredient_id) AS n_ingredients FROM {JOINED}
    GROUP BY meddra_name ORDER BY n_ingredients DESC, meddra_name LIMIT 10""")
def _(t):
    return Q.top_effects_by_ingredients(t.release(), 10)


@query("q04_top_effects_in_source", f"""
    SELECT meddra_name, count(DISTINCT label_id) AS n_products FROM {LABELLED} WHERE source = 'UK'
    GROUP BY meddra_name ORDER BY n_products DESC, meddra_name LIMIT 10""")
def _(t):
    return Q.top_effects_in_source(t.release(), "UK", 10)


@query("q05_top_ingredients_by_effects", f"""
    SELECT i.rxnorm_name, count(DISTINCT meddra_id) AS n_adverse_effects FROM {JOINED}
    GROUP BY i.rxnorm_name ORDER BY n_adverse_effects DESC, i.rxnorm_name LIMIT 10""")
def _(t):
    return Q.top_ingredients_by_effects(t.release(), 10)


@query("q06_products_with_ingredient", f"""
    SELECT DISTINCT source_product_name, source_label_url
    FROM product_label JOIN product_to_rxnorm USING (label_id)
    JOIN vocab_rxnorm_ingredient_to_product ON rxnorm_product_id = product_id
    JOIN vocab_rxnorm_ingredient i ON ingredient_id = rxnorm_id WHERE i.rxnorm_name = '{INGREDIENT}'""")
def _(t):
    return Q.products_with_ingredient(t.release(), INGREDIENT)


@query("q07_prevalence_by_source", f"""
    SELECT pl.source, count(DISTINCT label_id) AS products_with_effect,
           (SELECT count(DISTINCT label_id) FROM product_label x WHERE x.source = pl.source) AS total_products,
           round(count(DISTINCT label_id) / (SELECT count(DISTINCT label_id) FROM product_label x WHERE x.source = pl.source), 6) AS fraction
    FROM product_label pl JOIN product_adverse_effect ON label_id = product_label_id
    JOIN vocab_meddra_adverse_effect ON effect_meddra_id = meddra_id
    WHERE meddra_name = '{EFFECT}' AND pl.source IN ('US', 'UK') GROUP BY pl.source""")
def _(t):
    return rounded(Q.prevalence_by_source(t.release(), EFFECT), "fraction")


@query("q08_top_effects_in_section", f"""
    SELECT meddra_name, count(DISTINCT label_id) AS occurrence_count FROM {LABELLED} WHERE label_section = 'WP'
    GROUP BY meddra_name ORDER BY occurrence_count DESC, meddra_name LIMIT 15""")
def _(t):
    return Q.top_effects_in_section(t.release(), "WP", 15)


@query("q09_best_products_for_effect", f"""
    SELECT source_product_name, round(pred1, 6) AS confidence_score, source_label_url FROM {LABELLED}
    WHERE meddra_name = '{EFFECT}'
    ORDER BY pred1 DESC NULLS LAST, source_product_name, source_label_url NULLS FIRST LIMIT 20""")
def _(t):
    return rounded(Q.best_products_for_effect(t.release(), EFFECT, 20), "confidence_score")


INTERSECTION = f"""
    SELECT pi.ingredient_id, a.effect_meddra_id, count(DISTINCT source) AS num_sources,
           max(CAST(source = 'US' AS INT)) AS US, max(CAST(source = 'UK' AS INT)) AS UK,
           max(CAST(source = 'EU' AS INT)) AS EU, max(CAST(source = 'JP' AS INT)) AS JP
    FROM {SOURCED} GROUP BY pi.ingredient_id, a.effect_meddra_id"""


@query("q10_source_intersection", INTERSECTION)
def _(t):
    return Q.source_intersection(t.release())


@query("q11_combination_counts", " UNION ALL ".join(
    f"SELECT '{'-'.join(c)}' AS source_combo, count(*) AS num_ades, count(DISTINCT ingredient_id) AS num_ingredients, "
    f"count(DISTINCT effect_meddra_id) AS num_effects FROM flags WHERE {' AND '.join(f'{s} = 1' for s in c)}"
    for c in A.source_combinations()), flags=INTERSECTION)
def _(t):
    return Q.combination_counts(t.release())


@query("q12_high_confidence", f"""
    SELECT pi.ingredient_id, a.effect_meddra_id FROM {SOURCED}
    GROUP BY 1, 2 HAVING count(DISTINCT source) = 4""")
def _(t):
    return Q.high_confidence(t.release())


PER_LABEL = """SELECT pl.label_id, count(DISTINCT vi2p.ingredient_id) AS ingredient_count FROM product_label pl
    LEFT JOIN product_to_rxnorm p2r ON pl.label_id = p2r.label_id
    LEFT JOIN vocab_rxnorm_ingredient_to_product vi2p ON p2r.rxnorm_product_id = vi2p.product_id GROUP BY pl.label_id"""


@query("q13_share_with_ingredients", f"""
    SELECT count(*) FILTER (ingredient_count > 0) AS products_with_ingredients,
           (SELECT count(*) FROM product_label) AS total_products,
           round(count(*) FILTER (ingredient_count > 0) / (SELECT count(*) FROM product_label), 6) AS fraction_products_with_ingredients
    FROM ({PER_LABEL})""")
def _(t):
    return rounded(Q.share_with_ingredients(t.release()), "fraction_products_with_ingredients")


@query("q14_products_by_source", "SELECT source, count(*) AS product_count FROM product_label GROUP BY source")
def _(t):
    return Q.products_by_source(t.release())


@query("q15_ingredient_count_stats", f"""
    SELECT round(avg(ingredient_count), 6) AS avg_ingredients, min(ingredient_count) AS min_ingredients,
           max(ingredient_count) AS max_ingredients, count(*) AS total_products FROM ({PER_LABEL})""")
def _(t):
    return rounded(Q.ingredient_count_stats(t.release()), "avg_ingredients")


@query("q16_effect_count_stats", """
    SELECT round(avg(c), 6) AS avg_effects, min(c) AS min_effects, max(c) AS max_effects, count(*) AS total_products FROM (
        SELECT pl.label_id, count(effect_id) AS c FROM product_label pl
        LEFT JOIN product_adverse_effect ON pl.label_id = product_label_id GROUP BY pl.label_id)""")
def _(t):
    return rounded(Q.effect_count_stats(t.release()), "avg_effects")


@query("q17_share_mapped", """
    SELECT count(DISTINCT label_id) AS product_labels_with_rxnorm_mapping,
           (SELECT count(*) FROM product_label) AS total_product_labels,
           round(100 * count(DISTINCT label_id) / (SELECT count(*) FROM product_label), 6) AS percent_with_rxnorm_mapping
    FROM product_to_rxnorm""")
def _(t):
    return rounded(Q.share_mapped(t.release()), "percent_with_rxnorm_mapping")


@query("q18_share_effects_in_vocab", """
    SELECT m AS mapped_adverse_effects, n AS total_adverse_events, round(100 * m / n, 6) AS percent_with_meddra_condition_mapping
    FROM (SELECT count(*) AS m FROM d_effect JOIN d_meddra ON effect_meddra_id = meddra_id), (SELECT count(*) AS n FROM d_effect)""")
def _(t):
    return rounded(Q.share_effects_in_vocab(t.damaged()), "percent_with_meddra_condition_mapping")


# --- integrity checks, on the damaged release so that they find something ---------------------

def _bad(n: str, test: str, what: str) -> str:
    return f"""SELECT '{test}' AS test, CASE WHEN n = 0 THEN 'PASS' ELSE 'FAIL (' || n || ' {what})' END AS result
    FROM (SELECT count(*) AS n FROM {n})"""


CHECK_SQL = {
    "1a": _bad("d_p2r LEFT JOIN d_product ON rxnorm_product_id = rxnorm_id WHERE rxnorm_id IS NULL",
               "1a: mapped products are in the product vocabulary", "missing vocab_rxnorm_product entries"),
    "1b": _bad("d_effect LEFT JOIN d_meddra ON effect_meddra_id = meddra_id WHERE meddra_id IS NULL",
               "1b: effects are in the effect vocabulary", "missing vocab_meddra_adverse_effect entries"),
    "2a": _bad("d_p2r p LEFT JOIN d_label l ON p.label_id = l.label_id WHERE l.label_id IS NULL",
               "2a: mapping rows reference a label", "orphaned product_label references in product_to_rxnorm"),
    "2b": _bad("d_effect LEFT JOIN d_label ON product_label_id = label_id WHERE label_id IS NULL",
               "2b: effect rows reference a label", "orphaned product_label references in product_adverse_effect"),
    "3a": _bad("d_i2p LEFT JOIN d_ingredient ON ingredient_id = rxnorm_id WHERE rxnorm_id IS NULL",
               "3a: ingredients are in the ingredient vocabulary", "missing vocab_rxnorm_ingredient entries"),
    "3b": _bad("""(SELECT pl.label_id FROM d_label pl LEFT JOIN d_p2r p ON pl.label_id = p.label_id
               LEFT JOIN d_i2p v ON p.rxnorm_product_id = v.product_id GROUP BY pl.label_id HAVING count(v.ingredient_id) = 0)""",
               "3b: every label has an ingredient", "product_label entries missing an ingredient mapping"),
    "4a": _bad("d_product LEFT JOIN d_p2r ON rxnorm_id = rxnorm_product_id WHERE label_id IS NULL",
               "4a: product vocabulary is used", "vocab_rxnorm_product entries not linked"),
    "4b": _bad("d_ingredient LEFT JOIN d_i2p ON rxnorm_id = ingredient_id WHERE product_id IS NULL",
               "4b: ingredient vocabulary is used", "vocab_rxnorm_ingredient entries not linked"),
    "4c": _bad("d_meddra LEFT JOIN d_effect ON meddra_id = effect_meddra_id WHERE effect_id IS NULL",
               "4c: effect vocabulary is used", "vocab_meddra_adverse_effect entries not linked"),
    "5a": _bad("d_label WHERE source IS NULL OR source_product_name IS NULL OR source_product_id IS NULL",
               "5a: required label fields are set", "product_label rows with missing required fields"),
    "5b": _bad("d_product WHERE rxnorm_name IS NULL OR rxnorm_term_type IS NULL",
               "5b: required product fields are set", "vocab_rxnorm_product rows with missing required fields"),
}

for _id, _check in V.CHECKS.items():
    query(f"v_{_id}_check", CHECK_SQL[_id])(lambda t, c=_check: c(t.damaged()))


@query("v_all_checks", " UNION ALL ".join(CHECK_SQL.values()))
def _(t):
    return V.check_all(t.damaged())


# --- repair and cut-off ---------------------------------------------------------------------

REPAIR = {
    "r_p2r": """SELECT p.* FROM d_p2r p WHERE rxnorm_product_id IN (SELECT rxnorm_id FROM d_product)
                AND label_id IN (SELECT label_id FROM d_label)""",
    "r_effect1": """SELECT * FROM d_effect WHERE effect_meddra_id IN (SELECT meddra_id FROM d_meddra)
                AND product_label_id IN (SELECT label_id FROM d_label)""",
    "r_label": """SELECT * FROM d_label WHERE label_id IN (SELECT label_id FROM r_p2r JOIN d_i2p ON rxnorm_product_id = product_id)""",
    "r_p2r2": "SELECT * FROM r_p2r WHERE label_id IN (SELECT label_id FROM r_label)",
    "r_effect": "SELECT * FROM r_effect1 WHERE product_label_id IN (SELECT label_id FROM r_label)",
    "r_product": "SELECT * FROM d_product WHERE rxnorm_id IN (SELECT rxnorm_product_id FROM r_p2r2)",
    "r_meddra": "SELECT * FROM d_meddra WHERE meddra_id IN (SELECT effect_meddra_id FROM r_effect)",
}


def _counts(tables: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS n_rows, count(*) > 0 AS ok FROM {src}" for name, src in tables.items()
    )


REPAIRED = {
    "product_label": "r_label", "product_adverse_effect": "r_effect", "product_to_rxnorm": "r_p2r2",
    "vocab_rxnorm_product": "r_product", "vocab_rxnorm_ingredient": "d_ingredient",
    "vocab_rxnorm_ingredient_to_product": "d_i2p", "vocab_meddra_adverse_effect": "r_meddra",
}


@query("b7_repair", _counts(REPAIRED), **REPAIR)
def _(t):
    return A.row_counts(repair(t.damaged()).tables())


@query("b7_repaired_effects", "SELECT product_label_id, effect_id, label_section, effect_meddra_id, match_method, "
       "round(pred0, 6) AS pred0, round(pred1, 6) AS pred1 FROM r_effect", **REPAIR)
def _(t):
    return rounded(repair(t.damaged()).product_adverse_effect, "pred0", "pred1")


@query("s17_repair_audit", """
    SELECT 'product_to_rxnorm_deficient' AS rule, count(*) AS n FROM d_p2r
        WHERE rxnorm_product_id NOT IN (SELECT rxnorm_id FROM d_product) OR label_id NOT IN (SELECT label_id FROM d_label)
    UNION ALL SELECT 'product_adverse_effect_deficient', count(*) FROM d_effect
        WHERE effect_meddra_id NOT IN (SELECT meddra_id FROM d_meddra) OR product_label_id NOT IN (SELECT label_id FROM d_label)
    UNION ALL SELECT 'product_label_missing_ingredient', count(*) FROM d_label WHERE label_id NOT IN (SELECT label_id FROM r_label)
    UNION ALL SELECT 'orphan_product_to_rxnorm', count(*) FROM r_p2r WHERE label_id NOT IN (SELECT label_id FROM r_label)
    UNION ALL SELECT 'orphan_product_adverse_effect', count(*) FROM r_effect1 WHERE product_label_id NOT IN (SELECT label_id FROM r_label)
    UNION ALL SELECT 'orphan_vocab_rxnorm_product', count(*) FROM d_product WHERE rxnorm_id NOT IN (SELECT rxnorm_id FROM r_product)
    UNION ALL SELECT 'orphan_vocab_meddra_adverse_effect', count(*) FROM d_meddra WHERE meddra_id NOT IN (SELECT meddra_id FROM r_meddra)""",
       **REPAIR)
def _(t):
    from ..session import scratch_path
    from ..sources.writers import write_audit

    _, audits = repair_steps(t.damaged())
    out = scratch_path(t.spark, "audit")
    for rule, rows in audits.items():
        write_audit(rows, out, rule)
    parts = [
        t.spark.read.parquet(f"{out}/{rule}").agg(F.count(F.lit(1)).alias("n")).select(F.lit(rule).alias("rule"), "n")
        for rule in audits
    ]
    result = parts[0]
    for p in parts[1:]:
        result = result.unionByName(p)
    return result


CUT = {
    **REPAIR,
    "c_effect": "SELECT * FROM r_effect WHERE pred1 IS NULL OR pred1 > 3.258",
    "c_label": "SELECT * FROM r_label WHERE label_id IN (SELECT product_label_id FROM c_effect)",
    "c_p2r": "SELECT * FROM r_p2r2 WHERE label_id IN (SELECT label_id FROM c_label)",
    "c_meddra": "SELECT * FROM r_meddra WHERE meddra_id IN (SELECT effect_meddra_id FROM c_effect)",
    "c_product": "SELECT * FROM r_product WHERE rxnorm_id IN (SELECT rxnorm_product_id FROM c_p2r)",
    "c_i2p": """SELECT * FROM d_i2p WHERE product_id IN (SELECT rxnorm_id FROM c_product)
                AND ingredient_id IN (SELECT rxnorm_id FROM d_ingredient)""",
    "c_ingredient": "SELECT * FROM d_ingredient WHERE rxnorm_id IN (SELECT ingredient_id FROM c_i2p)",
}


@query("b8_apply_threshold", _counts({
    "product_label": "c_label", "product_adverse_effect": "c_effect", "product_to_rxnorm": "c_p2r",
    "vocab_rxnorm_product": "c_product", "vocab_rxnorm_ingredient": "c_ingredient",
    "vocab_rxnorm_ingredient_to_product": "c_i2p", "vocab_meddra_adverse_effect": "c_meddra"}), **CUT)
def _(t):
    return A.row_counts(apply_threshold(repair(t.damaged())).tables())


def _rows_sql(tables: dict[str, str]) -> str:
    """Every row of every table with all its columns, as text under the table's name."""
    one = lambda c: f"coalesce(CAST({f'CAST(round({c} * 1000000) AS BIGINT)' if c in SCORES else c} AS VARCHAR), '-')"
    return " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, {' || chr(10) || '.join(map(one, COLUMNS_OF.get(name) or RELEASE_SCHEMAS[name].fieldNames()))} AS content FROM {src}"
        for name, src in tables.items())


def _rows(tables: dict):
    one = lambda c: F.coalesce((F.round(F.col(c) * 1000000).cast("bigint") if c in SCORES else F.col(c)).cast("string"), F.lit("-"))
    return reduce(lambda a, b: a.unionByName(b), [
        df.select(F.lit(n).alias("table_name"), F.concat_ws("\n", *map(one, COLUMNS_OF.get(n) or RELEASE_SCHEMAS[n].fieldNames())).alias("content"))
        for n, df in tables.items()])


SCORES = ("pred0", "pred1")
AUDITS = {
    "product_to_rxnorm_deficient": """d_p2r WHERE rxnorm_product_id NOT IN (SELECT rxnorm_id FROM d_product)
        OR label_id NOT IN (SELECT label_id FROM d_label)""",
    "product_adverse_effect_deficient": """d_effect WHERE effect_meddra_id NOT IN (SELECT meddra_id FROM d_meddra)
        OR product_label_id NOT IN (SELECT label_id FROM d_label)""",
    "product_label_missing_ingredient": "d_label WHERE label_id NOT IN (SELECT label_id FROM r_label)",
    "orphan_product_to_rxnorm": "r_p2r WHERE label_id NOT IN (SELECT label_id FROM r_label)",
    "orphan_product_adverse_effect": "r_effect1 WHERE product_label_id NOT IN (SELECT label_id FROM r_label)",
    "orphan_vocab_rxnorm_product": "d_product WHERE rxnorm_id NOT IN (SELECT rxnorm_id FROM r_product)",
    "orphan_vocab_meddra_adverse_effect": "d_meddra WHERE meddra_id NOT IN (SELECT meddra_id FROM r_meddra)",
}
COLUMNS_OF = {
    "product_label_missing_ingredient": ["label_id"],
    **{rule: RELEASE_SCHEMAS[table].fieldNames() for rule, table in {
        "product_to_rxnorm_deficient": "product_to_rxnorm", "product_adverse_effect_deficient": "product_adverse_effect",
        "orphan_product_to_rxnorm": "product_to_rxnorm", "orphan_product_adverse_effect": "product_adverse_effect",
        "orphan_vocab_rxnorm_product": "vocab_rxnorm_product",
        "orphan_vocab_meddra_adverse_effect": "vocab_meddra_adverse_effect"}.items()},
}
CUT_TABLES = {
    "product_label": "c_label", "product_adverse_effect": "c_effect", "product_to_rxnorm": "c_p2r",
    "vocab_rxnorm_product": "c_product", "vocab_rxnorm_ingredient": "c_ingredient",
    "vocab_rxnorm_ingredient_to_product": "c_i2p", "vocab_meddra_adverse_effect": "c_meddra"}


@query("b7_repaired_rows", _rows_sql(REPAIRED), **REPAIR)
def _(t):
    return _rows(repair(t.damaged()).tables())


@query("b8_cut_rows", _rows_sql(CUT_TABLES), **CUT)
def _(t):
    return _rows(apply_threshold(repair(t.damaged())).tables())


@query("s17_audit_rows", _rows_sql(AUDITS), **REPAIR)
def _(t):
    return _rows(repair_steps(t.damaged())[1])


@query("b8_kept_labels", "SELECT label_id, source FROM c_label", **CUT)
def _(t):
    return apply_threshold(repair(t.damaged())).product_label.select("label_id", "source")


@query("j12_not_in_with_null", """
    SELECT count(*) AS n FROM product_label WHERE label_id NOT IN (
        SELECT CASE WHEN l_orderkey % 5 <> 0 THEN l_orderkey END FROM lineitem)""")
def _(t):
    keys = t.table("lineitem").select(F.when(F.col("l_orderkey") % 5 != 0, F.col("l_orderkey")).alias("k"))
    return not_in(t.labels(), "label_id", keys, "k").agg(F.count(F.lit(1)).alias("n"))


@query("j12_not_in", """
    SELECT label_id FROM product_label WHERE label_id NOT IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 10)""")
def _(t):
    keys = t.table("lineitem").where("l_quantity > 10").select(F.col("l_orderkey").alias("k"))
    return not_in(t.labels(), "label_id", keys, "k").select("label_id")
