"""Cross-fitted scores, the parameter grid and seeded orders against plain versions."""

import hashlib

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from labelspark.functions import shuffle_key
from labelspark.operators.aggregates import seeded_order
from labelspark.plans import evaluation as EV
from labelspark.plans import scoring as SC


@pytest.fixture(scope="module")
def refset(spark):
    rows = [(f"d{i % 7}", f"{'pain severe' if i % 3 else 'rash mild'} w{i % 11} {'x' * (i % 5 + 1)}",
             "is_event" if (i % 3 > 0) != (i % 10 == 0) else "not_event") for i in range(140)]
    return spark.createDataFrame(rows + rows[:3], "drug string, string string, class string").cache()


def test_no_row_is_scored_by_a_model_that_saw_its_key(refset):
    params = {"n_features": 64, "max_iter": 5}
    got = SC.cross_scored(refset, "drug", 3, **params)
    folds = {(r.drug, r.fold) for r in got.select("drug", "fold").distinct().collect()}
    assert len(folds) == 7 and sorted(f for _, f in folds) == [0, 0, 1, 1, 2, 2, 2]
    assert got.count() == refset.count()
    for fold in range(3):
        inside = [d for d, f in folds if f == fold]
        model = SC.fit_classifier(refset.where(~F.col("drug").isin(inside)), **params)
        plain = SC.score_with_model(refset.where(F.col("drug").isin(inside)), model, text="string")
        want = sorted((r.drug, r.string, r.pred0, r.pred1) for r in plain.collect())
        have = sorted((r.drug, r.string, r.pred0, r.pred1) for r in got.where(F.col("fold") == fold).collect())
        assert [h[:2] for h in have] == [w[:2] for w in want]
        assert all(h[2:] == pytest.approx(w[2:], abs=1e-6) for h, w in zip(have, want))


def test_folds_of_few_and_null_keys(spark, refset):
    two = SC.cross_scored(refset.where("drug in ('d1', 'd2')"), "drug", 3, n_features=16, max_iter=2)
    assert two.select("drug", "fold").distinct().count() == 2
    with pytest.raises(PySparkException):
        EV.split_folds(spark.createDataFrame([(None, 1)], "drug string, x int"), "drug", 2).collect()


def test_grid_is_what_single_runs_give(refset):
    split = refset.withColumn("split", F.when(F.col("drug").isin("d1", "d4"), "val").when(F.col("drug") == "d5", "test").otherwise("train"))
    grid = [{"n_features": 16, "max_iter": 2}, {"n_features": 64, "max_iter": 5}, {"n_features": 16, "reg": 0.5}]
    got = SC.run_grid(split, grid).collect()
    assert sorted(r.run for r in got) == [0, 1, 2] and [r.max_f1 for r in got] == sorted((r.max_f1 for r in got), reverse=True)
    for r in got:
        model = SC.fit_classifier(split.where("split = 'train'"), **grid[r.run])
        val = SC.score_with_model(SC.with_label(split.where("split = 'val'")), model, text="string")
        want = EV.best_threshold(val, "label", "pred1").first()
        assert r.params == ", ".join(f"{k}={v}" for k, v in sorted(grid[r.run].items()))
        for name in ("max_f1", "max_f1_precision", "max_f1_recall", "pr_auc", "max_f1_threshold"):
            assert r[name] == pytest.approx(want[name], abs=1e-6)


def test_seeded_order(spark):
    keys = [5, 3, 3, 12, None, 7]
    got = [r.k for r in seeded_order(spark.createDataFrame([(k,) for k in keys], "k int"), "k", 9).collect()]
    assert got == [None] + sorted((k for k in keys if k is not None), key=lambda k: (hashlib.md5(f"9:{k}".encode()).hexdigest(), k))
    assert spark.range(1).select(shuffle_key("id", 1)).first()[0] == hashlib.md5(b"1:0").hexdigest()


def test_scoring_matches_holds_no_words_of_their_texts(spark):
    """A scorer that runs as an expression is moved below the contexts: each hit then waits with its text's word array."""
    from labelspark.operators.match import match_contexts
    from labelspark.plans.scoring import score

    texts = spark.createDataFrame([("t", "a foo b foo c"), ("u", None), ("v", "")], "text_id string, text string")
    vocab = spark.createDataFrame([("1", "foo")], "text_id string, text string")
    scored = score(match_contexts(texts, vocab, 4, 0.5), lambda: lambda xs: [(float(len(x)), 1.0) for x in xs], batch=1)
    assert [(r.start, r.context, r.pred0, r.pred1) for r in scored.orderBy("start").collect()] == [
        (2, "foo a EVENT b", 13.0, 1.0), (8, "foo b EVENT c", 13.0, 1.0)]
    plan = scored.select("text_id", "start", "pred0")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1  # the scan
