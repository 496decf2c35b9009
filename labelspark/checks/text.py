"""Matching, contexts, examples, spans, paragraphs and reference sets."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import evidence as E
from ..operators import match as M
from ..operators.ontology import preferred_map, to_preferred
from ..plans import labels as L
from ..plans import reference_set as RS
from .aggregates import tool_documents
from .common import WS, longs, query, sql_words


def _positions(df):
    return longs(df.select("text_id", "term_id", "term", "start", F.col("end").alias("stop")), "start", "stop")


@query("t01_match_terms", "SELECT text_id, term_id, term, start, stop FROM matches")
def _(t):
    return _positions(M.match_terms(t.texts(), t.vocabulary()))


@query("t01_match_terms_many_parts", "SELECT text_id, term_id, term, start, stop FROM matches")
def _(t):
    return _positions(M.match_terms(t.texts(), t.vocabulary(), shards=7))


@query("t02_match_normalized", "SELECT text_id, term_id, term, start, stop FROM matches_lower")
def _(t):
    return _positions(M.match_terms(t.texts(), t.vocabulary(), normalize=True))


@query("t02_match_conversations", """
    SELECT text_id, term_id, term FROM (SELECT conv_id || '.' || turn AS text_id, lower(text) AS text FROM conversations)
    JOIN dictionary_lower ON contains(text, term)""")
def _(t):
    texts = t.table("conversations").select(F.concat_ws(".", "conv_id", "turn").alias("text_id"), "text")
    return M.match_terms(texts, t.vocabulary(), case=False).select("text_id", "term_id", "term").distinct()


def context_sql(nwords: int, prop: float) -> str:
    return f"""
    SELECT text_id, term_id, start, array_to_string(list_concat(list_concat(list_concat([term],
               list_slice(bw, greatest(len(bw) - nb + 1, 1), len(bw))), ['EVENT']), list_slice(aw, 1, na)), ' ') AS context
    FROM (SELECT *, greatest(CAST(trunc({prop} * ({nwords} - 2 * tw)) AS BIGINT), 1) AS nb,
                 greatest(CAST(trunc((1 - {prop}) * ({nwords} - 2 * tw)) AS BIGINT), 1) AS na FROM matches_words)"""


@query("t03_context", context_sql(125, 0.125))
def _(t):
    return longs(M.match_contexts(t.texts(), t.vocabulary()).select("text_id", "term_id", "start", "context"), "start")


@query("t03_context_any_table", context_sql(10, 0.5))
def _(t):
    hits = M.find_terms(t.texts(), t.vocabulary(), keep_text=True)
    return longs(M.with_context(hits, 10, 0.5).select("text_id", "term_id", "start", "context"), "start")


EXAMPLE_METHODS = [m for m in M.EXAMPLE_STYLES if m != 5]


def _example_sql(method: int, nwords: int = 20) -> str:
    replace, nonsense, term_first, source_first, prop, _ = M.EXAMPLE_STYLES[method]
    nb = f"greatest(CAST(trunc(({nwords} - 2 * tw) * {prop}) AS BIGINT), 1)"
    na = f"greatest(CAST(trunc(({nwords} - 2 * tw) * {1 - prop}) AS BIGINT), 1)"
    event = "'YIHFKEHDK'" if nonsense else "'EVENT'" if replace else "term"
    lists = []
    if term_first:
        lists.append("[term]")
    if source_first:
        lists.append("['exact']")
    if prop > 0:
        lists.append(f"list_slice(bw, greatest(len(bw) - {nb} + 1, 1), len(bw))")
    lists.append(f"[{event}]")
    if prop < 1:
        lists.append(f"list_slice(aw, 1, {na})")
    expr = lists[0]
    for more in lists[1:]:
        expr = f"list_concat({expr}, {more})"
    return (f"SELECT {method} AS method, text_id, count(*) AS n, md5(string_agg(s, '|' ORDER BY s)) AS digest "
            f"FROM (SELECT text_id, array_to_string({expr}, ' ') AS s FROM matches_words) GROUP BY text_id")


@query("t04_examples", " UNION ALL ".join(_example_sql(m) for m in EXAMPLE_METHODS))
def _(t):
    styles = {f"m{m}": M.example(m, 20) for m in EXAMPLE_METHODS}
    hits = M.find_terms(t.texts(), t.vocabulary(), derive=styles)
    long = hits.select("text_id", F.explode(F.array(*[
        F.struct(F.lit(m).alias("method"), F.col(f"m{m}").alias("s")) for m in EXAMPLE_METHODS])).alias("e")).select("text_id", "e.*")
    return long.groupBy("method", "text_id").agg(
        F.count(F.lit(1)).alias("n"), F.md5(F.array_join(F.sort_array(F.collect_list("s")), "|").cast("binary")).alias("digest"))


@query("t05_random_words", "SELECT text_id, term_id, start, least(20, len(w)) AS n_words FROM matches JOIN "
       f"(SELECT CAST(doc_id AS VARCHAR) AS text_id, {sql_words('text')} AS w FROM documents) USING (text_id)")
def _(t):
    ex = M.match_examples(t.texts(), t.vocabulary(), 5, 20)
    return longs(ex.select("text_id", "term_id", "start", F.size(F.split("string", " ")).alias("n_words")), "start", "n_words")


@query("t06_to_preferred", """
    SELECT text_id, term_id, start, coalesce(pt_code, term_id) AS pt_code, coalesce(pt_name, term) AS pt_name
    FROM matches LEFT JOIN preferred ON llt_code = term_id""")
def _(t):
    m = M.match_preferred(t.texts(), t.vocabulary(), preferred_map(t.nodes(), t.edges()))
    return longs(m.select("text_id", "term_id", "start", "pt_code", "pt_name"), "start")


@query("t06_to_preferred_any_table", """
    SELECT text_id, term_id, count(*) AS n, coalesce(pt_code, term_id) AS pt_code
    FROM matches LEFT JOIN preferred ON llt_code = term_id GROUP BY ALL""")
def _(t):
    m = M.match_terms(t.texts(), t.vocabulary())
    return to_preferred(m, preferred_map(t.nodes(), t.edges())).groupBy("text_id", "term_id", "pt_code").agg(F.count("*").alias("n"))


@query("t07_label_matches", """
    SELECT text_id, term_id, start, CASE WHEN EXISTS (
        SELECT 1 FROM annotation_events e WHERE e.doc_id = CAST(text_id AS BIGINT) AND (e.pt IN (term_id, pt_code) OR e.llt IN (term_id, pt_code)))
        THEN 'is_event' ELSE 'not_event' END AS class
    FROM (SELECT text_id, term_id, start, coalesce(pt_code, term_id) AS pt_code FROM matches LEFT JOIN preferred ON llt_code = term_id)""")
def _(t):
    gold = t.annotation_files().select(
        F.replace("label_id", F.lit("drug"), F.lit("")).alias("text_id"), RS.annotated_codes(F.col("adverse_events")).alias("codes"))
    texts = t.texts().join(gold, "text_id")
    m = M.match_preferred(texts, t.vocabulary(), preferred_map(t.nodes(), t.edges()))
    return longs(RS.label_matches(m).select("text_id", "term_id", "start", "class"), "start")


# matches that ignore case, found by splitting; of a term that overlaps itself, every other one (none here does)
CI_MATCHES = {
    "ci_pieces": """
        SELECT text_id, term_id, term, unnest(string_split(text, term)) AS piece,
               unnest(range(len(string_split(text, term)))) AS no, len(string_split(text, term)) AS n
        FROM (SELECT text_id, lower(text) AS text FROM texts) JOIN dictionary_lower ON contains(text, term)""",
    "ci_parts": """
        SELECT text_id, term_id, term, CAST(start AS BIGINT) AS start, CAST(start + length(term) AS BIGINT) AS stop
        FROM (SELECT *, sum(length(piece)) OVER (PARTITION BY text_id, term ORDER BY no) + no * length(term) AS start FROM ci_pieces)
        WHERE no < n - 1""",
}


@query("t08_resolve_overlaps", """
    SELECT text_id, m.term_id AS term_id, m.term AS term, m.start AS start, m.stop AS stop FROM (
        SELECT text_id, unnest(list_reduce(list([{'start': start, 'stop': stop, 'term_id': term_id, 'term': term}]
            ORDER BY stop - start DESC, stop, term_id, term), lambda kept, x: CASE WHEN len(list_filter(kept, lambda k:
                k.start < x[1].stop AND x[1].start < k.stop)) > 0 THEN kept ELSE list_concat(kept, x) END)) AS m
        FROM ci_parts GROUP BY text_id)""", **CI_MATCHES)
def _(t):
    m = M.resolve_overlaps(M.match_terms(t.texts(), t.vocabulary(), case=False))
    return longs(m.select("text_id", "term_id", "term", "start", (F.col("end") + 1).alias("stop")), "start", "stop")


@query("t09_find_all", """
    SELECT doc_id, CAST(sum(length(piece)) OVER (PARTITION BY doc_id ORDER BY no) + no * 3 AS BIGINT) AS start, no + 1 AS nth FROM (
        SELECT doc_id, unnest(string_split(lower(text), 'the')) AS piece, unnest(range(len(string_split(lower(text), 'the')))) AS no,
               len(string_split(lower(text), 'the')) AS n FROM documents) WHERE no < n - 1""")
def _(t):
    from pyspark.sql.window import Window

    found = M.find_all(t.documents().select("doc_id", "text"), "The")
    nth = F.row_number().over(Window.partitionBy("doc_id").orderBy("start"))
    return longs(found.select("doc_id", "start", nth.alias("nth")), "start", "nth")


PARAGRAPHS = rf"""
    SELECT doc_id, no, CAST(sum(length(p)) OVER (PARTITION BY doc_id ORDER BY no) AS BIGINT) - length(p) AS start, p AS paragraph FROM (
        SELECT doc_id, no, CASE WHEN no = 0 THEN pieces[1] ELSE seps[no] || pieces[no + 1] END AS p FROM (
            SELECT doc_id, pieces, seps, unnest(range(len(pieces))) AS no FROM (
                SELECT doc_id, string_split_regex(section_text, '\n{WS}*\n') AS pieces,
                       regexp_extract_all(section_text, '\n{WS}*\n') AS seps FROM evidence_texts)))"""
EVIDENCE = r"""CASE WHEN regexp_matches(paragraph, '(?i)\bclass\s+effect\b') THEN 'drug_class'
    WHEN regexp_matches(paragraph, '(?i)\bin\s+animal\s+(?:studies|experiments|models|toxicology|reproductive)') THEN 'animal' ELSE 'human' END"""


@query("t10_paragraphs", "SELECT doc_id, no AS paragraph_no, start, start + length(paragraph) AS stop, paragraph FROM paras", paras=PARAGRAPHS)
def _(t):
    texts = t.documents().select("doc_id", t.evidence_text().alias("text"))
    return longs(E.paragraphs(texts), "paragraph_no", "start", "stop")


@query("t11_classify_evidence", f"SELECT doc_id, no AS paragraph_no, {EVIDENCE} AS flag2 FROM paras", paras=PARAGRAPHS)
def _(t):
    texts = t.documents().select("doc_id", t.evidence_text().alias("text"))
    return longs(E.paragraphs(texts).select("doc_id", "paragraph_no", E.classify_evidence("paragraph").alias("flag2")), "paragraph_no")


@query("t12_evidence_flag", f"""
    SELECT 'drug' || e.doc_id AS label_id, i - 1 AS event_no, coalesce({EVIDENCE}, 'human') AS flag2
    FROM annotation_events e LEFT JOIN paras p ON e.doc_id = p.doc_id AND e.start >= p.start AND e.start < p.start + length(p.paragraph)""", paras=PARAGRAPHS)
def _(t):
    flagged = E.add_evidence_flag(t.annotation_files())
    return longs(E.flatten_events(flagged, ["label_id"]).select("label_id", "event_no", "flag2"), "event_no")


@query("j25_events_in_paragraphs", f"""
    SELECT 'drug' || e.doc_id AS label_id, i - 1 AS event_no, coalesce({EVIDENCE}, 'human') AS flag2
    FROM annotation_events e LEFT JOIN paras p ON e.doc_id = p.doc_id AND e.start >= p.start AND e.start < p.start + length(p.paragraph)""", paras=PARAGRAPHS)
def _(t):
    from ..operators.intervals import value_at

    records = t.annotation_files()
    spans = E.paragraphs(records.select("label_id", F.coalesce("section_text", F.lit("")).alias("text")))
    spans = spans.withColumn("flag2", E.classify_evidence("paragraph"))
    events = E.flatten_events(records, ["label_id"]).drop("flag2").withColumn("at", F.coalesce(F.col("start").cast("double").cast("int"), F.lit(0)))
    got = value_at(events.select("label_id", "event_no", "at"), spans, ["label_id"], "at", "flag2", "human")
    return longs(got.select("label_id", "event_no", "flag2"), "event_no")


EV_MATCHES = {
    "ev_texts": f"""SELECT doc_id, section, tac, lower(array_to_string({sql_words('section_text')}, ' ')) AS text FROM annotation_records""",
    "ev_pieces": """
        SELECT doc_id, section, tac, text, term_id, term, unnest(string_split(text, term)) AS piece,
               unnest(range(len(string_split(text, term)))) AS no, len(string_split(text, term)) AS n
        FROM ev_texts JOIN dictionary_lower ON contains(text, term)""",
    "ev_matches": f"""
        SELECT *, {sql_words('substr(text, 1, start)')} AS bw, {sql_words('substr(text, start + length(term) + 1)')} AS aw, len({sql_words('term')}) AS tw
        FROM (SELECT *, CAST(sum(length(piece)) OVER (PARTITION BY doc_id, term ORDER BY no) + no * length(term) AS BIGINT) AS start FROM ev_pieces) WHERE no < n - 1""",
}


@query("t13_reference_set", """
    SELECT section, upper('drug' || doc_id) AS drug, tac, term_id AS meddra_id, pt_code AS pt_meddra_id, 'exact' AS source_method,
           CASE WHEN EXISTS (SELECT 1 FROM annotation_events e WHERE e.doc_id = m.doc_id AND (e.pt IN (term_id, pt_code) OR e.llt IN (term_id, pt_code)))
                THEN 'is_event' ELSE 'not_event' END AS class, pt_name AS pt_meddra_term, term AS found_term,
           array_to_string(list_concat(list_concat(list_concat([term, 'exact'],
               list_slice(bw, greatest(len(bw) - greatest(CAST(trunc((30 - 2 * tw) * 0.125) AS BIGINT), 1) + 1, 1), len(bw))), ['EVENT']),
               list_slice(aw, 1, greatest(CAST(trunc((30 - 2 * tw) * 0.875) AS BIGINT), 1))), ' ') AS string
    FROM (SELECT ev.*, coalesce(p.pt_code, term_id) AS pt_code, coalesce(p.pt_name, n.name) AS pt_name
          FROM ev_matches ev LEFT JOIN preferred p ON llt_code = term_id
          LEFT JOIN (SELECT text_id, max(text) AS name FROM vocabulary GROUP BY 1) n ON n.text_id = term_id) m""", **EV_MATCHES)
def _(t):
    return RS.build_reference_set(
        t.annotation_files(), t.vocabulary(), preferred_map(t.nodes(), t.edges()), 14, 30, "ALL")


@query("t14_reference_set_tool", """
    SELECT m.section, upper('set' || m.doc_id) AS drug, 'test' AS tac, m.term_id AS meddra_id, count(*) AS n,
           count(*) FILTER (EXISTS (SELECT 1 FROM tool_codes c WHERE c.k = t.k AND c.section = m.section AND c.code IN (m.term_id, m.pt_code))) AS n_event
    FROM (SELECT w.*, coalesce(p.pt_code, term_id) AS pt_code FROM us_hits w LEFT JOIN preferred p ON llt_code = term_id) m
    JOIN (SELECT DISTINCT l_orderkey AS k, l_orderkey // 3 AS doc_id, CASE l_returnflag WHEN 'A' THEN 'AR' WHEN 'N' THEN 'WP' ELSE 'BW' END AS section FROM lineitem) t
      ON t.doc_id = m.doc_id AND t.section = m.section
    GROUP BY ALL""",
       us_sections=f"""SELECT CAST(substr(set_id, 4) AS BIGINT) AS doc_id, section, lower(array_to_string({sql_words('text')}, ' ')) AS text FROM (
            UNPIVOT (SELECT set_id, AR, BW, WP FROM us_labels) ON AR, BW, WP INTO NAME section VALUE text) WHERE trim(text) <> ''""",
       us_hits="""SELECT doc_id, section, term_id, term FROM (
            SELECT doc_id, section, term_id, term, unnest(range(len(string_split(text, term)) - 1)) AS no FROM us_sections JOIN dictionary_lower ON contains(text, term))""",
       tool_codes="""SELECT l_orderkey AS k, CASE l_returnflag WHEN 'A' THEN 'AR' WHEN 'N' THEN 'WP' ELSE 'BW' END AS section,
            unnest([CAST(l_suppkey % 40 * 10 + 1 AS VARCHAR), CASE WHEN l_quantity > 25 THEN CAST(l_partkey % 40 * 10 + 2 AS VARCHAR) END]) AS code FROM lineitem""")
def _(t):
    ref = RS.build_reference_set_tool(
        tool_documents(t), t.us_labels(), t.vocabulary(), preferred_map(t.nodes(), t.edges()), 14, 30, "ALL")
    return ref.groupBy("section", "drug", "tac", "meddra_id").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("class") == "is_event").alias("n_event"))


@query("t15_span_coverage", """
    SELECT text_id, start, stop AS "end", 'vocab' AS type, EXISTS (
        SELECT 1 FROM spans a WHERE a.text_id = m.text_id AND a.start <= m.start AND a.stop >= m.stop) AS annotated, term_id AS code, term
    FROM (SELECT DISTINCT * FROM ci_parts) m
    UNION ALL
    -- places of a free span that no match covers, in runs
    SELECT text_id, min(place) AS start, max(place) + 1 AS "end", 'freetext', true, '', 'free' FROM (
        SELECT *, place - row_number() OVER (PARTITION BY text_id, start ORDER BY place) AS run FROM (
            SELECT s.text_id, s.start, p.place FROM spans s, LATERAL (SELECT unnest(range(s.start, s.stop)) AS place) p
            WHERE s.source = 'text_select' AND (s.text_id, p.place) NOT IN (
                SELECT (text_id, place) FROM (SELECT text_id, unnest(range(start, stop)) AS place FROM ci_parts)))) GROUP BY text_id, start, run""",
       spans="""SELECT CAST(doc_id AS VARCHAR) AS text_id, start, start + 60 AS stop, CASE WHEN doc_id % 2 = 0 THEN 'text_select' ELSE 'vocab' END AS source
            FROM (SELECT doc_id, unnest(range(0, greatest(length(text), 1), 150)) AS start FROM documents)""", **CI_MATCHES)
def _(t):
    m = M.match_terms(t.texts(), t.vocabulary(), case=False)
    doc = F.col("doc_id")
    anns = t.documents().select(
        doc.cast("string").alias("text_id"), F.explode(F.sequence(F.lit(0), F.length("text") - 1, F.lit(150))).alias("start"),
        F.when(doc % 2 == 0, "text_select").otherwise("vocab").alias("source"),
    ).select("text_id", "start", (F.col("start") + 60).alias("end"), F.lit("free").alias("term_text"), "source")
    return M.span_coverage(m, anns)


@query("t01_match_all_phrases", """
    SELECT text_id, term_id, term, i - 1 AS start FROM (SELECT *, unnest(range(1, length(text) - 7)) AS i FROM texts) p
    JOIN phrases t ON substr(p.text, p.i, 8) = t.head AND substr(p.text, p.i, length(t.term)) = t.term""",
       phrases=f"""SELECT text AS term, left(text, 8) AS head, max(text_id) AS term_id FROM (
            SELECT item_id || '.' || n || '.' || i AS text_id, array_to_string(w[i:i + n - 1], ' ') AS text FROM (
                SELECT item_id, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM (
                    SELECT item_id, {sql_words('text')} AS w, unnest([2, 3, 4, 5]) AS n FROM benchmark)))
            WHERE length(text) >= 8 GROUP BY text""")
def _(t):
    return longs(M.match_terms(t.texts(), t.phrases()).select("text_id", "term_id", "term", "start"), "start")


@query("q20_label_detail", """
    SELECT set_id, section, m.term_id AS term_id, m.term AS term, m.start AS start, m.stop AS stop,
           coalesce(pt_code, m.term_id) AS pt_code, coalesce(pt_name, m.term) AS pt_name FROM (
        SELECT set_id, section, unnest(list_reduce(list([{'start': start, 'stop': stop, 'term_id': term_id, 'term': term}]
            ORDER BY stop - start DESC, stop, term_id, term), lambda kept, x: CASE WHEN len(list_filter(kept, lambda k:
                k.start < x[1].stop AND x[1].start < k.stop)) > 0 THEN kept ELSE list_concat(kept, x) END)) AS m
        FROM detail_spans WHERE length(term) >= 4 GROUP BY set_id, section)
    LEFT JOIN preferred ON llt_code = m.term_id""",
       detail_pieces="""SELECT set_id, section, term_id, term, unnest(string_split(text, term)) AS piece,
               unnest(range(len(string_split(text, term)))) AS no, len(string_split(text, term)) AS n
            FROM (SELECT set_id, section, lower(text) AS text FROM (
                UNPIVOT (SELECT set_id, AR, BW, WP FROM us_labels) ON AR, BW, WP INTO NAME section VALUE text) WHERE trim(text) <> '')
            JOIN dictionary_lower ON contains(text, term)""",
       detail_spans="""SELECT set_id, section, term_id, term, CAST(start AS BIGINT) AS start, CAST(start + length(term) AS BIGINT) AS stop
            FROM (SELECT *, sum(length(piece)) OVER (PARTITION BY set_id, section, term ORDER BY no) + no * length(term) AS start
                  FROM detail_pieces) WHERE no < n - 1""")
def _(t):
    got = L.label_detail(t.us_labels(), t.vocabulary(), preferred_map(t.nodes(), t.edges()), ["AR", "BW", "WP"])
    return longs(got.select("set_id", "section", "term_id", "term", "start", (F.col("end") + 1).alias("stop"), "pt_code", "pt_name"), "start", "stop")
