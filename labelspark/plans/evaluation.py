"""Splits by drug, precision-recall, thresholds and set-level metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import ratio, shuffle_key
from ..operators.joins import null_safe_join
from ..operators.ordered import number_rows, running

PARTS = ["train", "val", "test"]


def _cut(keys: DataFrame, order: list[str], bounds: list[float], names: list[str]) -> DataFrame:
    """Part of each key by its place in the order."""
    total = keys.agg(F.count(F.lit(1)).alias("n")).scalar()
    placed = number_rows(keys, order, "_no", start=0)
    part = F.lit(names[-1])
    for bound, name in reversed(list(zip(bounds, names))):
        part = F.when(F.col("_no") < (F.lit(bound) * total).cast("bigint"), name).otherwise(part)
    return placed.withColumn("split", part)


def _present(key: str) -> Column:
    missing = F.raise_error(F.lit(f"split key {key} is NULL")).cast("string")
    return F.when(F.col(key).isNull(), missing).otherwise(F.col(key)).alias(key)


def split_by_key(
    df: DataFrame, key: str, seed: int = 222, shares: tuple[float, ...] = (0.8, 0.1, 0.1)
) -> DataFrame:
    """Rows with ``split`` train, val or test; a key lies in one part only. A NULL key fails the job."""
    keys = df.select(_present(key)).distinct().withColumn("_h", shuffle_key(key, seed))
    bounds = [shares[0], round(shares[0] + shares[1], 10)]
    parts = _cut(keys, ["_h", key], bounds, PARTS).select(key, "split")
    return df.join(parts, key)


def split_folds(df: DataFrame, key: str, folds: int, seed: int = 222) -> DataFrame:
    """Rows with ``fold``, 0 to ``folds`` - 1; the rows of a key lie in one fold. A NULL key fails the job."""
    keys = df.select(_present(key)).distinct().withColumn("_h", shuffle_key(key, seed))
    parts = _cut(keys, ["_h", key], [(i + 1) / folds for i in range(folds - 1)], list(range(folds)))
    return df.join(parts.select(key, F.col("split").alias("fold")), key)


def split_tac(df: DataFrame, key: str = "drug") -> DataFrame:
    """Given train keys cut 90/10 in sorted order, given test keys as test."""
    if "tac" not in df.columns:
        raise ValueError("'tac' column not found in reference data for TAC split.")
    train = df.where("tac = 'train'").select(key).distinct()
    parts = _cut(train, [key], [0.9], ["train", "val"]).select(key, "split")
    test = df.where("tac = 'test'").select(key, F.lit("test").alias("split")).distinct()
    return df.join(parts.unionByName(test), key)


def split(df: DataFrame, method: str = "24", seed: int = 222, key: str = "drug") -> DataFrame:
    if method == "TAC":
        return split_tac(df, key)
    if method == "24":
        return split_by_key(df, key, seed)
    raise ValueError(f"Unknown split method: {method}")


def _by_score(df: DataFrame, label: str, score: str, by: list[str]) -> DataFrame:
    """Positives and negatives per distinct score, with their running totals from the top; unscored rows take no part."""
    counts = df.where(F.col(score).isNotNull()).groupBy(*by, F.col(score).alias("threshold")).agg(
        F.sum(F.col(label).cast("bigint")).alias("pos"),
        F.sum(1 - F.col(label).cast("bigint")).alias("neg"),
    )
    # by descending score: negate, so that one ascending order serves the keys as well
    ordered = counts.withColumn("_desc", -F.col("threshold"))
    return running(
        ordered, ["_desc"], {"tp": ("sum", F.col("pos")), "fp": ("sum", F.col("neg"))}, within=by
    ).drop("_desc")


def _f1(p: Column, r: Column) -> Column:
    return F.when(p + r == 0, F.lit(0.0)).otherwise(2 * p * r / (p + r))


def pr_curve(df: DataFrame, label: str, score: str, by: list[str] | None = None) -> DataFrame:
    """Precision, recall and F1 at every distinct score used as threshold (score >= t)."""
    by = by or []
    points = _by_score(df, label, score, by)
    totals = points.groupBy(*by).agg(F.sum("pos").alias("_p"))
    if by:
        points = null_safe_join(points, totals, by)
        positives = F.col("_p")
    else:
        positives = totals.scalar()
    out = points.withColumn("_all", positives).withColumns({
        "precision": F.col("tp") / (F.col("tp") + F.col("fp")),
        "recall": F.when(F.col("_all") > 0, F.col("tp") / F.col("_all")).otherwise(1.0),
    })
    return out.withColumn("f1", _f1(F.col("precision"), F.col("recall"))).select(
        *by, "threshold", "pos", "neg", "tp", "fp", "precision", "recall", "f1"
    )


def pr_auc(curve: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Trapezoid area below the curve; a point's upper neighbour follows from its own counts."""
    by = by or []
    tp0, fp0 = F.col("tp") - F.col("pos"), F.col("fp") - F.col("neg")
    earlier = F.when(tp0 + fp0 == 0, 1.0).otherwise(F.try_divide(tp0.cast("double"), tp0 + fp0))
    gained = F.when(F.col("tp") > 0, F.col("recall") * F.col("pos") / F.col("tp")).otherwise(0.0)
    return curve.groupBy(*by).agg(F.sum(gained * (F.col("precision") + earlier) / 2).alias("pr_auc"))


def best_threshold(
    df: DataFrame, label: str, score: str, at: float | None = None
) -> DataFrame:
    """The threshold with the best F1 (the lowest one on a tie), or the metrics at a given one.

    A given threshold is read at the nearest distinct score.
    """
    curve = pr_curve(df, label, score)
    picked = F.struct("f1", "threshold", "precision", "recall")
    if at is None:
        best = curve.agg(F.max_by(picked, F.struct("f1", -F.col("threshold"))).alias("_b"))
        threshold = F.col("_b.threshold")
    else:
        gap = F.abs(F.col("threshold") - at)
        best = curve.agg(F.min_by(picked, F.struct(gap, "threshold")).alias("_b"))
        threshold = F.lit(float(at))
    area = pr_auc(curve)
    return best.select(
        threshold.alias("max_f1_threshold"), F.col("_b.f1").alias("max_f1"),
        F.col("_b.precision").alias("max_f1_precision"), F.col("_b.recall").alias("max_f1_recall"),
        area.scalar().alias("pr_auc"),
    )


def best_thresholds(df: DataFrame, label: str, score: str, by: str) -> DataFrame:
    """``best_threshold`` of each group, all groups from one curve table."""
    curve = pr_curve(df, label, score, [by])
    picked = F.struct("f1", "threshold", "precision", "recall")
    best = curve.groupBy(by).agg(F.max_by(picked, F.struct("f1", -F.col("threshold"))).alias("_b"))
    return null_safe_join(best, pr_auc(curve, [by]), [by]).select(
        by, F.col("_b.threshold").alias("max_f1_threshold"), F.col("_b.f1").alias("max_f1"),
        F.col("_b.precision").alias("max_f1_precision"), F.col("_b.recall").alias("max_f1_recall"), "pr_auc")


def metrics_by(df: DataFrame, key: str, threshold: float, label: str = "label", score: str = "score") -> DataFrame:
    """F1, precision, recall, AUROC and row count per key (NULL is one), over scored rows."""
    df = df.where(F.col(score).isNotNull())
    above = F.col(score) > threshold
    event = F.col(label) == 1
    counts = df.groupBy(key).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(above & event).alias("tp"), F.count_if(above & ~event).alias("fp"),
        F.count_if(~above & event).alias("fn"),
    )
    points = _by_score(df, label, score, [key])
    # each positive beats the negatives below it and ties with half of its own score's
    area = points.groupBy(key).agg(
        F.sum("pos").alias("_p"), F.sum("neg").alias("_n"),
        F.sum(F.col("pos") * (F.col("fp") - F.col("neg") / 2)).alias("_above"),
    ).select(
        key, (1 - F.try_divide(F.col("_above"), (F.col("_p") * F.col("_n")).cast("double"))).alias("auroc")
    )
    p, r = ratio("tp", F.col("tp") + F.col("fp")), ratio("tp", F.col("tp") + F.col("fn"))
    return null_safe_join(counts, area, [key], "left").select(
        key, _f1(F.coalesce(p, F.lit(0.0)), F.coalesce(r, F.lit(0.0))).alias("f1"),
        F.coalesce(p, F.lit(0.0)).alias("precision"), F.coalesce(r, F.lit(0.0)).alias("recall"),
        "auroc", "n",
    )


def set_metrics(pred: DataFrame, gold: DataFrame, keys: list[str]) -> DataFrame:
    """Precision, recall and F1 of a predicted set against a gold set."""
    p = pred.select(*keys).distinct().withColumn("_p", F.lit(1))
    g = gold.select(*keys).distinct().withColumn("_g", F.lit(1))
    both = p.join(g, keys, "full_outer").agg(
        F.count_if(F.col("_p").isNotNull() & F.col("_g").isNotNull()).alias("tp"),
        F.count_if(F.col("_g").isNull()).alias("fp"), F.count_if(F.col("_p").isNull()).alias("fn"),
    )
    prec = F.coalesce(ratio("tp", F.col("tp") + F.col("fp")), F.lit(0.0))
    rec = F.coalesce(ratio("tp", F.col("tp") + F.col("fn")), F.lit(0.0))
    return both.select("tp", "fp", "fn", prec.alias("precision"), rec.alias("recall"), _f1(prec, rec).alias("f1"))
