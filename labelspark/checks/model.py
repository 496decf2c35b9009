"""Scoring, splits, thresholds, metrics and incremental processing."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.match import match_contexts, open_dictionary
from ..operators.ontology import preferred_map
from ..plans import evaluation as E
from ..plans import reference_set as RS
from ..plans import scoring as SC
from ..session import scratch_path, stage
from ..streaming.ingest import new_only, stream_labels
from .common import longs, query, rounded


def make_counting_scorer():
    """A stand-in model: text length and the number of 'the'."""
    def scorer(texts: list[str]) -> list[tuple[float, float]]:
        return [(float(len(x)), float(x.count("the"))) for x in texts]

    return scorer


@query("m1_score", """
    SELECT doc_id, CAST(length(text) AS DOUBLE) AS pred0, CAST(len(string_split(text, 'the')) - 1 AS DOUBLE) AS pred1 FROM documents""")
def _(t):
    docs = t.documents().select("doc_id", F.col("text").alias("context"))
    return SC.score(docs, make_counting_scorer).drop("context")


@query("m1_score_matches", """
    SELECT text_id, term_id, start, CAST(length(context) AS DOUBLE) AS pred0, CAST(len(string_split(context, 'the')) - 1 AS DOUBLE) AS pred1
    FROM (SELECT text_id, term_id, start, array_to_string(list_concat(list_concat(list_concat([term],
        list_slice(bw, greatest(len(bw) - 4, 1), len(bw))), ['EVENT']), list_slice(aw, 1, 5)), ' ') AS context FROM matches_words WHERE tw = 1
    UNION ALL SELECT text_id, term_id, start, array_to_string(list_concat(list_concat(list_concat([term],
        list_slice(bw, greatest(len(bw) - 3, 1), len(bw))), ['EVENT']), list_slice(aw, 1, 4)), ' ') FROM matches_words WHERE tw = 2
    UNION ALL SELECT text_id, term_id, start, array_to_string(list_concat(list_concat(list_concat([term],
        list_slice(bw, greatest(len(bw) - 2, 1), len(bw))), ['EVENT']), list_slice(aw, 1, 3)), ' ') FROM matches_words WHERE tw = 3)""")
def _(t):
    hits = match_contexts(t.texts(), t.vocabulary(), 12, 0.5)
    return longs(SC.score(hits, make_counting_scorer).select("text_id", "term_id", "start", "pred0", "pred1"), "start")


def _refset(t):
    return RS.build_reference_set(t.annotation_files(), t.vocabulary(), preferred_map(t.nodes(), t.edges()), 14, 20, "ALL")


@query("m2_fit_and_score")
def _(t):
    return SC.with_prediction(SC.cross_scored(stage(_refset(t), "refset"), "drug", 3, n_features=1 << 12, max_iter=5))


@query("m9_run_grid")
def _(t):
    ref = stage(E.split_by_key(stage(_refset(t), "refset"), "drug"), "split")
    return SC.run_grid(ref, [{"n_features": 1 << 10, "max_iter": 3}, {"n_features": 1 << 12, "max_iter": 5}])


@query("m3_split_by_key", """
    SELECT drug, section, count(*) AS n, split FROM scored_classes JOIN (
        SELECT drug, CASE WHEN no < CAST(trunc(0.8 * total) AS BIGINT) THEN 'train' WHEN no < CAST(trunc(0.9 * total) AS BIGINT) THEN 'val' ELSE 'test' END AS split
        FROM (SELECT drug, row_number() OVER (ORDER BY md5('222:' || drug), drug) - 1 AS no, count(*) OVER () AS total
              FROM (SELECT DISTINCT drug FROM scored_classes))) USING (drug) GROUP BY ALL""")
def _(t):
    return E.split_by_key(t.scored_classes(), "drug").groupBy("drug", "section", "split").agg(F.count(F.lit(1)).alias("n"))


@query("m4_split_tac", """
    SELECT drug, tac, count(*) AS n, split FROM annotated_events JOIN (
        SELECT drug, CASE WHEN no < CAST(trunc(0.9 * total) AS BIGINT) THEN 'train' ELSE 'val' END AS split
        FROM (SELECT drug, row_number() OVER (ORDER BY drug) - 1 AS no, count(*) OVER () AS total
              FROM (SELECT DISTINCT drug FROM annotated_events WHERE tac = 'train'))
        UNION ALL SELECT DISTINCT drug, 'test' FROM annotated_events WHERE tac = 'test') USING (drug) GROUP BY ALL""")
def _(t):
    return E.split_tac(t.annotated_events()).groupBy("drug", "tac", "split").agg(F.count(F.lit(1)).alias("n"))


CURVE = {
    "curve": """
    SELECT score, pos, neg, tp, fp, tp / (tp + fp) AS pr, tp / p AS rc, CASE WHEN tp = 0 THEN 0 ELSE 2 * tp / (tp + fp + p) END AS f1
    FROM (SELECT score, pos, neg, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, (SELECT sum(label) FROM scored_classes) AS p
          FROM (SELECT score, sum(label) AS pos, sum(1 - label) AS neg FROM scored_classes GROUP BY score)
          WINDOW w AS (ORDER BY score DESC ROWS UNBOUNDED PRECEDING))""",
    "area": """SELECT sum((rc - coalesce(prev_rc, 0)) * (pr + coalesce(prev_pr, 1)) / 2) AS auc FROM (
        SELECT *, lag(rc) OVER (ORDER BY score DESC) AS prev_rc, lag(pr) OVER (ORDER BY score DESC) AS prev_pr FROM curve)""",
}


@query("m5_best_threshold", """
    SELECT score AS max_f1_threshold, round(f1, 6) AS max_f1, round(pr, 6) AS max_f1_precision, round(rc, 6) AS max_f1_recall,
           (SELECT round(auc, 6) FROM area) AS pr_auc FROM curve ORDER BY curve.f1 DESC, score LIMIT 1""", **CURVE)
def _(t):
    best = E.best_threshold(t.scored_classes(), "label", "score")
    return rounded(best, "max_f1", "max_f1_precision", "max_f1_recall", "pr_auc")


@query("m5_metrics_at_threshold", """
    SELECT CAST(500.3 AS DOUBLE) AS max_f1_threshold, round(f1, 6) AS max_f1, round(pr, 6) AS max_f1_precision, round(rc, 6) AS max_f1_recall,
           (SELECT round(auc, 6) FROM area) AS pr_auc FROM curve ORDER BY abs(score - 500.3), score LIMIT 1""", **CURVE)
def _(t):
    best = E.best_threshold(t.scored_classes(), "label", "score", at=500.3)
    return rounded(best, "max_f1", "max_f1_precision", "max_f1_recall", "pr_auc")


@query("m6_metrics_by", """
    SELECT section, round(CASE WHEN tp = 0 THEN 0 ELSE 2 * tp / (2 * tp + fp + fn) END, 6) AS f1, round(tp / (tp + fp), 6) AS precision,
           round(tp / (tp + fn), 6) AS recall, round(auroc, 6) AS auroc, n
    FROM (SELECT section, count(*) AS n, count(*) FILTER (label = 1 AND score > 600) AS tp, count(*) FILTER (label = 0 AND score > 600) AS fp,
                 count(*) FILTER (label = 1 AND score <= 600) AS fn FROM scored_classes GROUP BY section)
    JOIN (SELECT section, (sum(rk) FILTER (label = 1) - count(*) FILTER (label = 1) * (count(*) FILTER (label = 1) + 1) / 2)
                 / (count(*) FILTER (label = 1) * count(*) FILTER (label = 0)) AS auroc
          FROM (SELECT section, label, rank() OVER (PARTITION BY section ORDER BY score) + (count(*) OVER (PARTITION BY section, score) - 1) / 2 AS rk
                FROM scored_classes) GROUP BY section) USING (section)""")
def _(t):
    return rounded(E.metrics_by(t.scored_classes(), "section", 600.0), "f1", "precision", "recall", "auroc")


@query("m7_set_metrics", """
    SELECT tp, fp, fn, round(tp / (tp + fp), 6) AS precision, round(tp / (tp + fn), 6) AS recall, round(2 * tp / (2 * tp + fp + fn), 6) AS f1 FROM (
        SELECT count(*) FILTER (p AND g) AS tp, count(*) FILTER (p AND NOT g) AS fp, count(*) FILTER (g AND NOT p) AS fn FROM (
            SELECT drug, section, bool_or(score > 600) AS p, bool_or(label = 1) AS g FROM scored_classes GROUP BY 1, 2))""")
def _(t):
    s = t.scored_classes()
    return rounded(E.set_metrics(s.where("score > 600"), s.where("label = 1"), ["drug", "section"]), "precision", "recall", "f1")


# --- incremental ----------------------------------------------------------------------------


def _arrivals(t, delivery=1, text="text", section="AR"):
    doc = F.col("doc_id")
    return t.documents().select(
        F.when(doc % 2 == 0, "US").otherwise("UK").alias("source"), doc.cast("string").alias("product_id"),
        (doc % 3).cast("string").alias("version"), F.lit(section).alias("section"), F.expr(text).alias("text"),
        F.lit(delivery).cast("bigint").alias("delivery"))


@query("i1_new_only", """
    SELECT doc_id FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND l.quality = d.doc_id % 3)""")
def _(t):
    done = t.table("labels").select(
        F.when(F.col("doc_id") % 2 == 0, "US").otherwise("UK").alias("source"),
        F.col("doc_id").cast("string").alias("product_id"), F.col("quality").cast("string").alias("version"))
    return new_only(_arrivals(t), done).select(F.col("product_id").cast("bigint").alias("doc_id"))


@query("i2_stream_labels", """
    SELECT CASE WHEN CAST(text_id AS BIGINT) % 2 = 0 THEN 'US' ELSE 'UK' END AS source, text_id AS product_id, section, term_id, start
    FROM matches, (VALUES ('AR'), ('WP')) AS s(section) WHERE section = 'AR' OR CAST(text_id AS BIGINT) % 4 < 2""")
def _(t):
    inbox, sink, ckpt = (scratch_path(t.spark, n) for n in ("inbox", "sink", "ckpt"))
    vocab = open_dictionary(t.vocabulary())  # once for the stream, not once a batch

    def process(batch):
        return match_contexts(batch, vocab)

    early = "product_id % 4 < 2"
    # some labels come early, some of them twice in one batch; a batch later their other section and, for all labels, a
    # second delivery, which only counts where there was no first one
    batches = [
        [_arrivals(t).where(early), _arrivals(t, 2, "'changed '").where("product_id % 4 = 0")],
        [_arrivals(t, section="WP").where(early),
         _arrivals(t, 2, "CASE WHEN doc_id % 4 < 2 THEN 'changed ' ELSE text END")],
    ]
    for deliveries in batches:
        for rows in deliveries:
            rows.write.mode("append").parquet(inbox)
        stream_labels(t.spark, inbox, sink, ckpt, process).awaitTermination()
    rows = t.spark.read.parquet(f"{sink}/rows")
    return longs(rows.select("source", "product_id", "section", "term_id", "start"), "start")
