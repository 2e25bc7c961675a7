"""Classifiers of labelled tickets: fitted on weighted words, chosen over folds, stored and scored.

A pipeline counts words into a fixed number of places, weighs them and fits one of Spark's
classifiers; its memory depends on the number of places, not on the vocabulary. Bagging and
sums follow the order of rows, so rows are dealt and sorted by their key before a fit: the
same rows give the same model, however they were stored.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import IDF, HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from guichet.operators.evaluation import share_of_key
from guichet.operators.terms import words_in_order

KINDS = {
    "logistic_regression": (LogisticRegression, {"maxIter": 50, "regParam": 0.01}),
    "decision_tree": (DecisionTreeClassifier, {"maxDepth": 5, "seed": 7}),
    "random_forest": (RandomForestClassifier, {"maxDepth": 5, "numTrees": 20, "featureSubsetStrategy": "sqrt", "seed": 7}),
}


def labelled_words(rows: DataFrame, key: str, text: str, label: str, *, folds: int = 3, salt: str = "") -> DataFrame:
    """(key, words, label, fold) of the rows with a key and a label of 0 or 1; the fold depends on the key alone. Null text has no words."""
    if folds < 2:
        raise ValueError("at least two folds")
    known = rows.filter(F.col(key).isNotNull() & F.col(label).isin(0, 1))
    fold = (share_of_key(F.col(key), f"{salt}fold") % folds).cast("int")
    return known.select(F.col(key).alias("key"), words_in_order(F.col(text)).alias("words"), F.col(label).cast("double").alias("label"), fold.alias("fold"))


def _dealt(rows: DataFrame, parts: int) -> DataFrame:
    return rows.repartition(parts, "key").sortWithinPartitions("key")


def _pipeline(kind: str, places: int, params: Mapping[str, object]) -> Pipeline:
    if kind not in KINDS:
        raise ValueError(f"one of {', '.join(KINDS)}, not {kind}")
    made, defaults = KINDS[kind]
    counted = HashingTF(inputCol="words", outputCol="counts", numFeatures=places)
    classifier = made(featuresCol="features", labelCol="label", **(defaults | dict(params)))
    return Pipeline(stages=[counted, IDF(inputCol="counts", outputCol="features"), classifier])


def train(rows: DataFrame, kind: str, *, places: int = 1 << 12, parts: int = 64, **params: object) -> PipelineModel:
    """A fitted pipeline of ``kind`` over rows as labelled_words makes them. At least one row has to be there.

    Fitting reads its rows many times. What it reads are counts, dealt, sorted and kept (on disk where
    memory is short) until the fit is done; words are counted once, before they are dealt.
    """
    counted, weighing, classifier = _pipeline(kind, places, params).getStages()
    dealt = _dealt(counted.transform(rows).drop("words"), parts).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        weighed = weighing.fit(dealt)
        fitted = classifier.fit(weighed.transform(dealt))
    finally:
        dealt.unpersist()
    return PipelineModel([counted, weighed, fitted])


def search(rows: DataFrame, kind: str, grid: Mapping[str, Sequence[object]], *, places: int = 1 << 12, parts: int = 64, parallelism: int = 1) -> CrossValidatorModel:
    """Every combination of ``grid`` over the folds of ``rows``, by F1; the best one is fitted on all rows. ``parallelism`` fits run at a time."""
    pipeline, builder = _pipeline(kind, places, {}), ParamGridBuilder()
    for name, values in grid.items():
        builder = builder.addGrid(pipeline.getStages()[-1].getParam(name), list(values))
    folds = rows.agg(F.max("fold")).first()[0] + 1
    evaluator = MulticlassClassificationEvaluator(labelCol="label", metricName="f1")
    return CrossValidator(estimator=pipeline, estimatorParamMaps=builder.build(), evaluator=evaluator, numFolds=folds, foldCol="fold", parallelism=parallelism).fit(_dealt(rows, parts))


def search_table(found: CrossValidatorModel) -> DataFrame:
    """(params, mean_f1, spread_f1, chosen): one row per combination; chosen is the first of the best."""
    from pyspark.sql import SparkSession

    best = max(found.avgMetrics)
    rows = []
    for i, (params, mean) in enumerate(zip(found.getEstimatorParamMaps(), found.avgMetrics, strict=True)):
        rows.append((", ".join(sorted(f"{p.name}={v}" for p, v in params.items())), float(mean), float(found.stdMetrics[i]), i == found.avgMetrics.index(best)))
    return SparkSession.getActiveSession().createDataFrame(rows, "params string, mean_f1 double, spread_f1 double, chosen boolean")


def scores(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """(key, score, predicted): the probability of label 1, and the label."""
    done = model.transform(rows.select("key", "words"))
    return done.select("key", vector_to_array("probability")[1].alias("score"), F.col("prediction").cast("int").alias("predicted"))


def save(model: PipelineModel, path: str) -> None:
    """Store a model; one that is there stays (a new version goes to a new path)."""
    model.write().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)
