"""Scores for match contexts: a pluggable batch scorer and a classifier trained on Spark."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from ..functions import predicted_class, relu
from ..session import stage
from .evaluation import best_thresholds, split_folds

Scorer = Callable[[list[str]], list[tuple[float, float]]]


def score(
    matches: DataFrame, make_scorer: Callable[[], Scorer], text: str = "context", batch: int = 1000
) -> DataFrame:
    """Matches with pred0 and pred1 from a scorer that is loaded once per Python worker.

    Scores are added to the row they belong to, in the partitions the matches already have.
    """
    at = matches.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = make_scorer()
        for b in batches:
            values = b.column(at).to_pylist()
            out = [p for i in range(0, len(values), batch) for p in scorer(values[i:i + batch])]
            pred0, pred1 = zip(*out) if out else ((), ())
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(pred0, pa.float64()), pa.array(pred1, pa.float64())],
                                             names=[*b.schema.names, "pred0", "pred1"])

    # a map over whole rows and no expression: one is moved below the columns made for it, and then every hit waits on
    # disk with all words of its text. Nor does a later score cut-off run the model again
    schema = StructType([*matches.schema.fields, StructField("pred0", DoubleType()), StructField("pred1", DoubleType())])
    return matches.mapInArrow(run, schema)


N_FEATURES, REG, MAX_ITER = 1 << 18, 0.01, 20


def features(n_features: int = N_FEATURES):
    """Tokens -> hashed counts -> inverse document frequency."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import IDF, HashingTF, RegexTokenizer

    return Pipeline(stages=[
        RegexTokenizer(inputCol="string", outputCol="_tokens", pattern=r"\s+"),
        HashingTF(inputCol="_tokens", outputCol="_tf", numFeatures=n_features),
        IDF(inputCol="_tf", outputCol="_features"),
    ])


def classifier(n_features: int = N_FEATURES, reg: float = REG, max_iter: int = MAX_ITER):
    """``features`` -> logistic regression."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression

    return Pipeline(stages=[
        *features(n_features).getStages(),
        LogisticRegression(featuresCol="_features", labelCol="label", regParam=reg, maxIter=max_iter),
    ])


def with_label(refset: DataFrame) -> DataFrame:
    return refset.withColumn("label", (F.col("class") == "is_event").cast("double"))


def fit_classifier(refset: DataFrame, **params):
    """A model of ``class`` from ``string``."""
    return classifier(**params).fit(with_label(refset).select("string", "label"))


def score_with_model(matches: DataFrame, model, text: str = "context") -> DataFrame:
    """pred0 and pred1 of a fitted model; negative raw scores are clamped to 0."""
    from pyspark.ml.functions import vector_to_array

    given = matches if text == "string" else matches.withColumn("string", F.col(text))
    raw = vector_to_array("rawPrediction")
    scored = model.transform(given).select(
        *matches.columns, relu(raw[0]).alias("pred0"), relu(raw[1]).alias("pred1")
    )
    return scored


def with_prediction(scored: DataFrame) -> DataFrame:
    return scored.withColumn("prediction", predicted_class("pred0", "pred1"))


def cross_scored(refset: DataFrame, key: str = "drug", folds: int = 3, **params) -> DataFrame:
    """Rows with ``fold``, pred0 and pred1: each row is scored by a model that saw no row of its key.

    Keys are dealt to folds of equal numbers of keys. At least two keys are needed; a NULL key fails the job.
    """
    dealt = stage(split_folds(refset, key, folds), "folds")
    parts = []
    for fold in [r[0] for r in dealt.select("fold").distinct().orderBy("fold").collect()]:
        model = fit_classifier(dealt.where(F.col("fold") != fold), **params)
        parts.append(score_with_model(dealt.where(F.col("fold") == fold), model, text="string"))
    return reduce(DataFrame.unionByName, parts, dealt.limit(0).selectExpr("*", "0D AS pred0", "0D AS pred1"))


def run_grid(refset: DataFrame, grid: list[dict]) -> DataFrame:
    """One row of validation metrics per parameter set, best first.

    ``refset`` carries ``split``; all runs are fitted and compared on the same parts. Features are computed and written
    once for each number of features, and the metrics of all runs come from one curve table.
    """
    from pyspark.ml.classification import LogisticRegression

    data = with_label(refset.where("split in ('train', 'val')")).select("split", "string", "label")
    lr = LogisticRegression(featuresCol="_features", labelCol="label")
    sizes = [p.get("n_features", N_FEATURES) for p in grid]
    scored = []
    for n in sorted(set(sizes)):
        ready = stage(features(n).fit(data.where("split = 'train'")).transform(data).select("split", "label", "_features"), "features")
        runs = [i for i, size in enumerate(sizes) if size == n]
        maps = [{lr.regParam: grid[i].get("reg", REG), lr.maxIter: grid[i].get("max_iter", MAX_ITER)} for i in runs]
        for i, model in zip(runs, lr.fit(ready.where("split = 'train'"), maps)):
            val = score_with_model(ready.where("split = 'val'"), model, text="string")
            scored.append(val.select(F.lit(i).alias("run"), "label", "pred1"))
    names = F.create_map(*(F.lit(x) for i, p in enumerate(grid) for x in (i, ", ".join(f"{k}={v}" for k, v in sorted(p.items())))))
    best = best_thresholds(stage(reduce(DataFrame.unionByName, scored), "runs"), "label", "pred1", "run")
    return best.select("run", names[F.col("run")].alias("params"), *best.columns[1:]).orderBy(F.desc("max_f1"), "run")
