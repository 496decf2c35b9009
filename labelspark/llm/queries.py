"""The registered query of each operator: its production parameters over the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_quality_rules")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import quality_rules as q

    docs = table(spark, sf_dir, "documents")
    return q.judge(docs, q.fit(docs, table(spark, sf_dir, "labels")))


@query("op6_quality_classifier")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import quality_classifier as q

    docs = table(spark, sf_dir, "documents")
    return q.judge(docs, q.fit(docs, table(spark, sf_dir, "labels")))


@query("op8_jaccard_join", """
    WITH RECURSIVE words AS (
        SELECT doc_id, list_filter(string_split_regex(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
    sets AS (
        SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
            ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s
        FROM words),
    heads AS (SELECT min(doc_id) AS doc_id, s FROM (SELECT doc_id, list_sort(s) AS s FROM sets) WHERE len(s) > 0 GROUP BY s),
    items AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM heads),
    links AS (
        SELECT a.doc_id AS a, b.doc_id AS b FROM items a JOIN items b ON a.g = b.g AND a.doc_id <> b.doc_id
        WHERE 5 * least(a.n, b.n) >= 4 * greatest(a.n, b.n)
        GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 180 * count(*) >= 80 * (a.n + b.n)),
    reach AS (SELECT doc_id AS id, doc_id AS c FROM heads UNION SELECT b, c FROM reach JOIN links ON a = id),
    classes AS (SELECT id, min(c) AS c FROM reach GROUP BY id)
    SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, coalesce(c.c, s.doc_id) AS component_id
    FROM sets s LEFT JOIN heads h ON h.s = list_sort(s.s) LEFT JOIN classes c ON c.id = h.doc_id""")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .jaccard_join import jaccard_classes

    return jaccard_classes(table(spark, sf_dir, "documents"))


@query("op5_packing")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import pack_documents

    return pack_documents(table(spark, sf_dir, "documents"))


@query("op2_token_counts")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .token_counts import count_tokens

    return count_tokens(table(spark, sf_dir, "documents"))


@query("op9_bpe_replay")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .bpe_replay import encode

    return encode(table(spark, sf_dir, "documents"), digests=True)


@query("op10_url_filter")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .url_filter import judge

    return judge(table(spark, sf_dir, "pages"))


@query("op7_license_scan")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .license_scan import scan

    return scan(table(spark, sf_dir, "documents"))


@query("op4_chat_format", r"""
    WITH rows AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
    escaped AS (
        SELECT *, length(replace(replace(replace(text, '\', '\s'), '###', '\h'), '</turn>', '\t')) AS n,
               length(replace(replace(replace(replace(role, '\', '\s'), '###', '\h'), '</turn>', '\t'), chr(10), '\n')) AS r
        FROM rows)
    SELECT conv_id, count(*) AS n_turns,
           sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
           CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
           sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
           CAST(sum(4 + r + 1 + n + 8) AS BIGINT) AS formatted_chars
    FROM escaped GROUP BY conv_id""")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import chat_format as c

    own = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("\\### Assistant: </turn> ok").alias("text"))
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(own)
    records = rows.select("conv_id", "turn", F.to_variant_object(F.struct("role", "text")).alias("record"))
    return c.digests(c.format_records(records, order_col="turn"))


@query("op3_ann_search")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .ann_search import search

    vectors = table(spark, sf_dir, "embeddings")
    return search(vectors, vectors.filter("vec_id % 50 = 0"))


def _nearest_sql(centroids: str, columns: str) -> str:
    """Every kept vector with its nearest centroid; all products are whole numbers that a double holds."""
    return f"""SELECT k.*, {columns} FROM (
        SELECT k.row, k.vec_id, k.v, min({{'d': CAST(list_inner_product(k.v, k.v) - 2 * list_inner_product(k.v, c.v)
            + list_inner_product(c.v, c.v) AS BIGINT), 'c': c.c}}) AS best
        FROM kept k CROSS JOIN {centroids} c GROUP BY k.row, k.vec_id, k.v) k"""


def _clustering_sql(rounds: int = 10) -> str:
    steps = ["""kept AS MATERIALIZED (
        SELECT row_number() OVER () AS row, vec_id,
               list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v
        FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: isfinite(CAST(x AS DOUBLE)))) = 64)""",
             """c0 AS MATERIALIZED (
        SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id), v) - 1 AS c, v FROM kept
        WHERE vec_id IS NOT NULL ORDER BY sha256('3:' || vec_id), v LIMIT 8)"""]
    for i in range(rounds):
        steps.append(f"a{i} AS MATERIALIZED ({_nearest_sql(f'c{i}', 'best.c AS c')})")
        steps.append(f"""m{i} AS MATERIALIZED (
        SELECT c, list(floor_mean ORDER BY place) AS v FROM (
            SELECT c, place, CAST((s - ((s % n) + n) % n) // n AS DOUBLE) AS floor_mean FROM (
                SELECT c, place, CAST(sum(CAST(x AS BIGINT)) AS HUGEINT) AS s, count(*) AS n FROM (
                    SELECT c, unnest(v) AS x, unnest(range(1, 65)) AS place FROM a{i}) GROUP BY c, place)) GROUP BY c)""")
        steps.append(f"c{i + 1} AS MATERIALIZED (SELECT o.c, coalesce(m.v, o.v) AS v FROM c{i} o LEFT JOIN m{i} m ON m.c = o.c)")
    return f"""WITH {', '.join(steps)},
        last AS ({_nearest_sql(f'c{rounds}', 'best.c AS c, best.d AS d')}),
        shas AS (SELECT c, sha256(array_to_string(list_transform(v, lambda x: CAST(CAST(x AS BIGINT) AS VARCHAR)), ',')) AS sha FROM c{rounds})
        SELECT vec_id, CAST(last.c AS INTEGER) AS "cluster", d AS distance,
               CAST(sum(d) OVER (PARTITION BY last.c) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia,
               sha AS centroid_sha256
        FROM last JOIN shas ON shas.c = last.c"""


@query("op11_centroid_clustering", _clustering_sql())
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .centroid_clustering import cluster

    return cluster(table(spark, sf_dir, "embeddings"))


@query("op12_prefix_trie", """
    WITH turns AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
    own AS (
        SELECT conv_id, list({'role': role, 'text': text} ORDER BY turn NULLS FIRST, md5(strlen(role) || ':' || role || text)) AS t,
               -- CRC-32 of the decimal id: each byte, then eight shifts
               xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), flatten(list_transform(
                   string_split(CAST(conv_id AS VARCHAR), ''), lambda x: [CAST(ord(x) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
                   lambda crc, x: CASE WHEN x >= 0 THEN xor(crc, x) WHEN crc % 2 = 1 THEN xor(crc >> 1, 3988292384)
                       ELSE crc >> 1 END)) % 9 AS h
        FROM turns GROUP BY conv_id),
    rebuilt AS (
        SELECT c.conv_id, list_concat(coalesce(b.t[1:c.h], []), c.t[c.h + 1:]) AS p
        FROM own c LEFT JOIN own b ON b.conv_id = c.conv_id - c.conv_id % 5),
    steps AS (SELECT conv_id, p, unnest(range(0, len(p) + 1)) AS d FROM rebuilt),
    keyed AS (SELECT *, sha256(CAST(to_json(p[1:d]) AS VARCHAR)) AS k FROM steps),
    nodes AS MATERIALIZED (
        SELECT d, k, min(conv_id) AS conv_id, count(*) AS n, first(p[1:d]) AS p,
               sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (len(p) = d), '')) AS ends
        FROM keyed GROUP BY d, k),
    over AS MATERIALIZED (SELECT *, CASE WHEN d > 0 THEN sha256(CAST(to_json(p[1:d - 1]) AS VARCHAR)) END AS up FROM nodes),
    kids AS MATERIALIZED (SELECT up, count(*) AS n FROM over GROUP BY up),
    under AS (
        SELECT n.k, n.d, CASE WHEN c.up IS NULL THEN 1 ELSE 0 END AS leaf,
               CASE WHEN n.d = 0 THEN 0 ELSE (n.n - 1) * strlen(n.p[n.d].text) END AS saved, n.p, unnest(range(0, n.d + 1)) AS top
        FROM over n LEFT JOIN kids c ON c.up = n.k),
    sums AS (
        SELECT sha256(CAST(to_json(p[1:top]) AS VARCHAR)) AS k, sum(leaf) AS leaves, sum(saved) AS saved FROM under GROUP BY 1)
    SELECT n.conv_id, CAST(n.d AS BIGINT) AS depth, u.conv_id AS parent_conv_id, n.n AS n_convs, coalesce(c.n, 0) AS n_children,
           CAST(s.leaves AS BIGINT) AS n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, n.ends AS ends_sha256
    FROM over n JOIN sums s ON s.k = n.k LEFT JOIN nodes u ON u.k = n.up LEFT JOIN kids c ON c.up = n.k""")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .prefix_trie import trie

    return trie(table(spark, sf_dir, "conversations"))


@query("op13_bpe_queue")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .bpe_queue import encode

    return encode(table(spark, sf_dir, "documents"), digests=True)
