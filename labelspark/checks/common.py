"""Registration of queries with their SQL twins, and the shared SQL derivations."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..testbed import Testbed

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# White space as Python and Spark split on it; the default class is ASCII only.
WS = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def sql_words(expr: str) -> str:
    return f"[w for w in string_split_regex({expr}, '{WS}+') if w <> '']"


CTES: dict[str, str] = {
    # --- published model
    "product_label": """
        SELECT o_orderkey AS label_id,
               CASE o_orderkey % 4 WHEN 0 THEN 'US' WHEN 1 THEN 'UK' WHEN 2 THEN 'EU' ELSE 'JP' END AS source,
               o_orderpriority AS source_product_name,
               CAST(o_orderkey AS VARCHAR) AS source_product_id,
               CASE WHEN o_orderkey % 10 <> 0 THEN 'https://labels.example/' || o_orderkey END AS source_label_url
        FROM orders""",
    "all_effects": """
        SELECT l_orderkey AS product_label_id, l_orderkey * 10 + l_linenumber AS effect_id,
               CASE l_returnflag WHEN 'A' THEN 'AR' WHEN 'N' THEN 'WP' ELSE 'BW' END AS label_section,
               l_suppkey * 10 + CAST(l_quantity AS INT) % 10 AS effect_meddra_id,
               CASE WHEN l_orderkey % 4 = 3 THEN 'SM' ELSE 'PMB' END AS match_method,
               l_discount AS pred0,
               CASE WHEN l_orderkey % 4 <> 3 THEN l_extendedprice / 10000 END AS pred1
        FROM lineitem""",
    "product_adverse_effect": "SELECT * FROM all_effects WHERE pred1 IS NULL OR pred1 > 3.258",
    "product_to_rxnorm": """
        SELECT DISTINCT l_orderkey AS label_id, CAST(l_partkey AS VARCHAR) AS rxnorm_product_id FROM lineitem""",
    "vocab_rxnorm_product": """
        SELECT CAST(p_partkey AS VARCHAR) AS rxnorm_id, p_name AS rxnorm_name, p_type AS rxnorm_term_type FROM part""",
    "vocab_rxnorm_ingredient_to_product": """
        SELECT DISTINCT CAST(p_partkey AS VARCHAR) AS product_id, w || '-' || p_size AS ingredient_id
        FROM (SELECT p_partkey, p_size, unnest(string_split(p_name, ' ')) AS w FROM part)""",
    "vocab_rxnorm_ingredient": """
        SELECT DISTINCT ingredient_id AS rxnorm_id, ingredient_id AS rxnorm_name,
               split_part(ingredient_id, '-', 1) AS rxnorm_term_type
        FROM vocab_rxnorm_ingredient_to_product""",
    "vocab_meddra_adverse_effect": """
        SELECT meddra_id, s_name || '-' || (meddra_id % 10) AS meddra_name,
               CASE WHEN meddra_id % 2 = 0 THEN 'PT' ELSE 'LLT' END AS meddra_term_type
        FROM (SELECT DISTINCT effect_meddra_id AS meddra_id FROM all_effects)
        JOIN supplier ON s_suppkey = meddra_id // 10""",
    # --- the release with damaged parents
    "d_label": "SELECT * FROM product_label WHERE label_id % 17 <> 0",
    "d_effect": "SELECT * FROM all_effects",
    "d_p2r": "SELECT * FROM product_to_rxnorm",
    "d_product": "SELECT * FROM vocab_rxnorm_product WHERE CAST(rxnorm_id AS BIGINT) % 13 <> 0",
    "d_meddra": "SELECT * FROM vocab_meddra_adverse_effect WHERE meddra_id % 19 <> 0",
    "d_i2p": "SELECT * FROM vocab_rxnorm_ingredient_to_product WHERE CAST(product_id AS BIGINT) % 3 <> 0",
    "d_ingredient": "SELECT * FROM vocab_rxnorm_ingredient WHERE NOT ends_with(rxnorm_id, '-7')",
    # --- texts and vocabulary
    "texts": "SELECT CAST(doc_id AS VARCHAR) AS text_id, text FROM documents",
    "vocab_words": f"SELECT item_id, {sql_words('text')} AS w FROM benchmark",
    "vocabulary": """
        SELECT text_id, text FROM (
            SELECT CAST(item_id * 10 + 1 AS VARCHAR) AS text_id, array_to_string(w[1:2], ' ') AS text FROM vocab_words WHERE len(w) >= 3
            UNION ALL SELECT CAST(item_id * 10 + 2 AS VARCHAR), array_to_string(w[1:3], ' ') FROM vocab_words WHERE len(w) >= 3
            UNION ALL SELECT CAST(item_id * 10 + 3 AS VARCHAR), array_to_string(w[2:3], ' ') FROM vocab_words WHERE len(w) >= 3
            UNION ALL SELECT CAST(item_id * 10 + 4 AS VARCHAR), w[3] FROM vocab_words WHERE len(w) >= 3
        ) WHERE length(text) >= 4""",
    "dictionary": "SELECT text AS term, max(text_id) AS term_id FROM vocabulary GROUP BY text",
    "dictionary_lower": "SELECT lower(text) AS term, max(text_id) AS term_id FROM vocabulary GROUP BY lower(text)",
    "us_labels": """
        SELECT 'set' || doc_id AS set_id, 'lab' || doc_id AS label_id, CAST(doc_id % 5 AS VARCHAR) AS spl_version,
               'These highlights do not include all the information needed to use ' || upper(substr(source, 1, 5))
                   || ' tablets safely. ' || lang AS title,
               text AS AR,
               CASE WHEN doc_id % 3 = 0 THEN text WHEN doc_id % 3 = 1 THEN '' END AS BW,
               CASE WHEN doc_id % 8 = 0 THEN reverse(text) END AS WP,
               '' AS WA, CAST(NULL AS VARCHAR) AS PR, CASE WHEN doc_id % 12 = 0 THEN ' ' END AS SP, lang AS OV
        FROM documents""",
    **{
        f"{r.lower()}_labels": f"""
        SELECT source || ' ' || lang AS name, '{r}' || doc_id AS code,
               CASE WHEN doc_id % 11 <> 0 THEN 'D' || (doc_id % 100) END AS kegg_id,
               'https://labels.example/' || doc_id AS page_url,
               CASE WHEN doc_id % 7 <> 0 THEN text ELSE '' END AS text
        FROM documents""" for r in ("UK", "EU", "JP")
    },
    "scores": """
        SELECT * FROM (SELECT CASE l_orderkey % 4
                 WHEN 0 THEN 'set' || l_orderkey || '.lab' || l_orderkey || '.' || (l_orderkey % 5) || '.'
                     || CASE l_returnflag WHEN 'A' THEN 'AR' WHEN 'N' THEN 'WP' ELSE 'BW' END || '.US'
                 WHEN 1 THEN 'UK' || l_orderkey || '.AR.UK'
                 WHEN 2 THEN 'EU' || l_orderkey || '.AR.EU' END AS text_id,
               CAST(l_suppkey * 10 + CAST(l_quantity AS INT) % 10 AS VARCHAR) AS term_id,
               l_discount AS pred0, l_extendedprice / 10000 AS pred1
        FROM lineitem) WHERE text_id IS NOT NULL""",
    "jp_matches": """
        SELECT 'JP' || l_orderkey || '.AR.JP' AS text_id,
               CAST(l_suppkey * 10 + CAST(l_quantity AS INT) % 10 AS VARCHAR) AS term_id
        FROM lineitem WHERE l_orderkey % 4 = 3""",
    "us_map": """
        SELECT 'set' || o_orderkey AS setid, CAST(o_orderkey % 5 AS VARCHAR) AS spl_version,
               unnest(['C' || o_custkey, 'S' || (o_custkey % 10)]) AS rxcui
        FROM orders WHERE o_orderkey % 4 = 0""",
    "us_meta": """
        SELECT 'set' || o_orderkey AS setid, CAST(o_orderkey % 5 AS VARCHAR) AS spl_version,
               CASE WHEN o_orderkey % 40 = 0 THEN 'NOT A DRUG LABEL' WHEN o_orderkey % 36 = 0 THEN NULL
                    ELSE o_orderpriority END AS title
        FROM orders WHERE o_orderkey % 4 = 0""",
    **{
        f"{r.lower()}_meta": f"""
        SELECT o_orderpriority AS name, '{r}' || o_orderkey AS code,
               CASE WHEN o_orderkey % 11 <> 0 THEN 'D' || o_custkey END AS kegg_id,
               CASE WHEN o_orderkey % 10 <> 0 THEN 'https://labels.example/' || o_orderkey END AS page_url
        FROM orders WHERE o_orderkey % 4 = {i}""" for r, i in (("UK", 1), ("EU", 2), ("JP", 3))
    },
    **{
        f"{r.lower()}_codes": f"""
        SELECT '{r}' || o_orderkey AS code,
               CASE WHEN o_orderkey % 9 = 0 THEN NULL WHEN o_orderkey % 7 = 0 THEN '' ELSE 'C' || o_custkey END AS rxcui
        FROM orders WHERE o_orderkey % 4 = {i}""" for r, i in (("UK", 1), ("EU", 2))
    },
    # --- ontology
    "nodes": """
        SELECT concept_id, concept_name, vocabulary_id, concept_class_id, concept_code,
               CASE WHEN k % 17 = 0 THEN 'D' END AS invalid_reason
        FROM (
            SELECT c_custkey AS k, c_custkey * 10 + 1 AS concept_id, c_name AS concept_name, 'RxNorm' AS vocabulary_id,
                   'Branded Drug' AS concept_class_id, 'C' || c_custkey AS concept_code FROM customer
            UNION ALL SELECT n_nationkey, n_nationkey * 10 + 2, n_name, 'RxNorm', 'Clinical Drug Comp', 'N' || n_nationkey FROM nation
            UNION ALL SELECT r_regionkey, r_regionkey * 10 + 3, r_name, 'RxNorm', 'Ingredient', 'R' || r_regionkey FROM region
            UNION ALL SELECT s_suppkey, s_suppkey * 10 + 4, s_name, 'RxNorm Extension', 'Clinical Drug', 'S' || s_suppkey FROM supplier
            UNION ALL SELECT p_partkey, p_partkey * 10 + 5, p_name, 'NDC', '9-digit NDC', lpad(CAST(p_partkey AS VARCHAR), 9, '0') FROM part
            UNION ALL SELECT DISTINCT effect_meddra_id, effect_meddra_id * 10 + 6, 'Term ' || effect_meddra_id, 'MedDRA',
                   CASE WHEN effect_meddra_id % 2 = 0 THEN 'PT' ELSE 'LLT' END, CAST(effect_meddra_id AS VARCHAR) FROM all_effects
        )""",
    "edges": """
        SELECT concept_id_1, concept_id_2, relationship_id, CASE WHEN concept_id_1 % 23 = 0 THEN 'D' END AS invalid_reason
        FROM (
            SELECT c_custkey * 10 + 1 AS concept_id_1, c_nationkey * 10 + 2 AS concept_id_2, 'Consists of' AS relationship_id FROM customer
            UNION ALL SELECT s_suppkey * 10 + 4, s_nationkey * 10 + 2, 'Consists of' FROM supplier
            UNION ALL SELECT n_nationkey * 10 + 2, n_regionkey * 10 + 3, 'Has ingredient' FROM nation
            UNION ALL SELECT DISTINCT l_partkey * 10 + 5, l_suppkey * 10 + 4, 'Maps to' FROM lineitem
            UNION ALL SELECT DISTINCT effect_meddra_id * 10 + 6, (effect_meddra_id - 1) * 10 + 6, 'Is a'
                      FROM all_effects WHERE effect_meddra_id % 2 = 1
        )""",
    "kegg": """
        SELECT 'dr:D' || p_partkey AS kegg_id,
               CASE WHEN p_partkey % 3 = 0 THEN 'ndc:' || substr(lpad(CAST(p_partkey AS VARCHAR), 9, '0'), 1, 5) || '-'
                        || substr(lpad(CAST(p_partkey AS VARCHAR), 9, '0'), 6, 4)
                    ELSE 'ndc:' || substr(lpad(CAST(p_partkey AS VARCHAR), 8, '0'), 1, 4) || '-'
                        || substr(lpad(CAST(p_partkey AS VARCHAR), 8, '0'), 5, 4) END AS ndc_id
        FROM part""",
    "atoms": """
        SELECT 'C' || lpad(CAST(c_custkey AS VARCHAR), 7, '0') AS CUI,
               CASE WHEN c_custkey % 3 = 0 THEN 'JPN' ELSE 'ENG' END AS LAT,
               CASE WHEN c_custkey % 3 = 0 THEN 'MDRJPN' WHEN c_custkey % 5 = 0 THEN 'RXNORM' ELSE 'MDR' END AS SAB,
               CASE WHEN c_custkey % 4 = 0 THEN 'PT' WHEN c_custkey % 4 = 3 THEN 'OL' ELSE 'LLT' END AS TTY,
               CASE WHEN c_custkey % 5 = 0 AND c_custkey % 3 <> 0 THEN 'C' || c_custkey
                    ELSE CAST(c_custkey // 6 * 3 AS VARCHAR) END AS CODE,
               c_mktsegment || ' "' || (c_custkey % 50) || '"' AS STR, 'N' AS SUPPRESS
        FROM customer""",
    "name_terms": """
        SELECT 'L' || p_partkey AS code, rank, term FROM (
            SELECT p_partkey, p_size, 0 AS slot, CASE WHEN p_partkey % 4 <> 0 THEN upper(p_name) END AS term FROM part
            UNION ALL SELECT p_partkey, p_size, 1, CASE WHEN p_partkey % 4 = 0 THEN 'TABLETS, ' || p_name || ' ' || p_brand END FROM part
            UNION ALL SELECT p_partkey, p_size, 2, CASE WHEN p_partkey % 5 = 0 THEN p_name || ' ' || p_brand END FROM part
        ), LATERAL (SELECT slot AS rank) WHERE term IS NOT NULL""",
    "name_dictionary": """
        SELECT CASE WHEN p_partkey % 3 = 0 THEN p_brand || ' ' || p_name ELSE p_name || ' ' || p_brand END AS term,
               CAST(p_partkey AS VARCHAR) AS concept_code FROM part
        UNION ALL SELECT p_name, 'N' || p_size FROM part WHERE p_partkey % 7 = 0""",
    # --- annotations
    "annotated_events": """
        SELECT 'drug' || (l_orderkey // 8) AS drug,
               CASE l_orderkey % 3 WHEN 0 THEN 'AR' WHEN 1 THEN 'BW' ELSE 'WP' END AS section,
               CASE WHEN l_orderkey % 5 = 0 THEN 'test' ELSE 'train' END AS tac,
               CASE WHEN CAST(l_quantity AS INT) % 7 <> 0 THEN (l_suppkey % 50) || '.0' END AS pt_id,
               CASE WHEN CAST(l_quantity AS INT) % 5 = 0 THEN '' WHEN CAST(l_quantity AS INT) % 5 = 1 THEN 'NaN'
                    ELSE CAST(l_suppkey AS VARCHAR) END AS llt_id,
               CASE WHEN CAST(l_quantity AS INT) % 11 = 0 THEN 'animal' WHEN CAST(l_quantity AS INT) % 11 = 1 THEN 'drug_class'
                    ELSE 'human' END AS flag2
        FROM lineitem""",
    "evidence_texts": r"""
        SELECT doc_id, lang,
               CASE WHEN doc_id % 7 = 0 THEN 'Seen in animal studies only.' || chr(10) || chr(10) ELSE '' END
               || replace(text, chr(10), chr(10) || chr(10))
               || CASE WHEN doc_id % 5 = 0 THEN chr(10) || chr(10) || 'A Class  Effect is likely.' ELSE '' END AS section_text
        FROM documents""",
    "annotation_events": """
        SELECT doc_id, i,
               CASE WHEN i % 5 <> 0 THEN CAST((doc_id + i % 3) % 40 * 10 + 1 AS VARCHAR) END AS pt,
               CAST((doc_id + i) % 40 * 10 + 2 AS VARCHAR) AS llt,
               CASE WHEN i <> 4 THEN i * 60 ELSE 0 END AS start
        FROM documents, LATERAL (SELECT unnest(range(1, CAST(doc_id % 6 AS INT) + 1)) AS i)""",
    "annotation_records": """
        SELECT doc_id, 'drug' || doc_id AS label_id,
               CASE doc_id % 3 WHEN 0 THEN 'Adverse Reactions' WHEN 1 THEN 'boxed warnings' ELSE 'warnings and precautions' END AS section_name,
               CASE doc_id % 3 WHEN 0 THEN 'AR' WHEN 1 THEN 'BW' ELSE 'WP' END AS section,
               section_text, doc_id % 6 AS n_events, 'set-' || lang AS dataset,
               CASE WHEN doc_id % 5 = 0 THEN 'test' ELSE 'train' END AS tac
        FROM evidence_texts""",
    "scored_classes": """
        SELECT 'drug' || (l_orderkey % 500) AS drug,
               CASE l_returnflag WHEN 'A' THEN 'AR' WHEN 'N' THEN 'WP' ELSE 'BW' END AS section,
               CASE WHEN l_extendedprice + l_suppkey * 500 % 50000 > 65000 THEN 1 ELSE 0 END AS label,
               CAST(floor(l_extendedprice / 100) AS DOUBLE) AS score
        FROM lineitem""",
    # --- matches: overlapping occurrences are the splits of the text at the term
    "pairs": "SELECT text_id, text, term_id, term FROM texts JOIN dictionary ON contains(text, term)",
    "pieces": """
        SELECT text_id, text, term_id, term, unnest(string_split(text, term)) AS piece,
               unnest(range(len(string_split(text, term)))) AS no, len(string_split(text, term)) AS n
        FROM pairs""",
    "matches": """
        SELECT text_id, text, term_id, term, CAST(start AS BIGINT) AS start, CAST(start + length(term) - 1 AS BIGINT) AS stop
        FROM (SELECT *, sum(length(piece)) OVER (PARTITION BY text_id, term ORDER BY no) + no * length(term) AS start FROM pieces)
        WHERE no < n - 1""",
    "matches_words": f"""
        SELECT *, {sql_words('substr(text, 1, start)')} AS bw, {sql_words('substr(text, stop + 2)')} AS aw,
               len({sql_words('term')}) AS tw
        FROM matches""",
    "texts_lower": f"""
        SELECT CAST(doc_id AS VARCHAR) AS text_id, lower(array_to_string({sql_words('text')}, ' ')) AS text FROM documents""",
    "pairs_lower": "SELECT text_id, text, term_id, term FROM texts_lower JOIN dictionary_lower ON contains(text, term)",
    "pieces_lower": """
        SELECT text_id, text, term_id, term, unnest(string_split(text, term)) AS piece,
               unnest(range(len(string_split(text, term)))) AS no, len(string_split(text, term)) AS n
        FROM pairs_lower""",
    "matches_lower": """
        SELECT text_id, text, term_id, term, CAST(start AS BIGINT) AS start, CAST(start + length(term) - 1 AS BIGINT) AS stop
        FROM (SELECT *, sum(length(piece)) OVER (PARTITION BY text_id, term ORDER BY no) + no * length(term) AS start FROM pieces_lower)
        WHERE no < n - 1""",
    "preferred": """
        SELECT l.concept_code AS llt_code, p.concept_code AS pt_code, p.concept_name AS pt_name
        FROM nodes l JOIN edges e ON l.concept_id = e.concept_id_1 JOIN nodes p ON e.concept_id_2 = p.concept_id
        WHERE l.vocabulary_id = 'MedDRA' AND p.vocabulary_id = 'MedDRA' AND l.invalid_reason IS NULL AND p.invalid_reason IS NULL
          AND l.concept_class_id = 'LLT' AND p.concept_class_id = 'PT' AND e.relationship_id = 'Is a' AND e.invalid_reason IS NULL""",
}


def with_ctes(body: str, extra: dict[str, str] | None = None) -> str:
    """The body preceded by the shared derivations it uses, in dependency order."""
    known = {**CTES, **(extra or {})}
    ordered: list[str] = []

    def need(sql: str, own: str = "") -> None:
        for name in known:
            if name != own and name not in ordered and re.search(rf"\b{name}\b", sql):
                need(known[name], name)
                if name not in ordered:
                    ordered.append(name)

    need(body)
    if not ordered:
        return body
    text = ",\n".join(f"{n} AS MATERIALIZED ({known[n]})" for n in ordered)
    return f"WITH {text}\n{body}"


def query(name: str, sql: str | None = None, **extra: str):
    """Register a query over the testbed, with its SQL twin where SQL can say it."""
    def register(fn: Callable[[Testbed], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: fn(Testbed(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = with_ctes(sql, extra)
        return fn

    return register


def rounded(df: DataFrame, *cols: str, digits: int = 6) -> DataFrame:
    """Doubles rounded for comparison."""
    return df.withColumns({c: F.round(F.col(c).cast("double"), digits) for c in cols})


def longs(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("bigint") for c in cols})
