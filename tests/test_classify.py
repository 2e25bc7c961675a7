import random

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from guichet.functions.pseudonym import pseudonym
from guichet.operators import classify, lifecycle

KINDS = list(classify.KINDS)


def tickets(n=160, seed=1):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        label = r.random() < 0.4
        words = [r.choice(["login", "screen", "printer", "cable"]) for _ in range(4)] + (["refund"] if label and r.random() < 0.9 else ["hello"])
        rows.append((i, " ".join(words), int(label)))
    return rows


@pytest.fixture(scope="module")
def rows(spark):
    odd = [(None, "refund", 1), (900, None, 0), (901, "", None), (902, "hello", 7)]
    return spark.createDataFrame(tickets() + odd, "id long, text string, label int")


@pytest.fixture(scope="module")
def known(rows):
    return classify.labelled_words(rows, "id", "text", "label")


def features(model, known):
    done = known
    for stage in model.stages[:-1]:
        done = stage.transform(done)
    got = done.orderBy("key").select(vector_to_array("features").alias("x"), "label").collect()
    return np.array([r["x"] for r in got]), np.array([r["label"] for r in got])


def test_rows_and_folds(known):
    got = known.collect()
    assert {r["key"] for r in got} == {*range(160), 900} and {r["fold"] for r in got} == {0, 1, 2}
    assert {r["key"]: r["fold"] for r in known.repartition(5).collect()} == {r["key"]: r["fold"] for r in got}


@pytest.mark.parametrize("kind", KINDS)
def test_the_same_rows_give_the_same_model(known, kind):
    a, b = (classify.scores(classify.train(x, kind, places=64, parts=4), known).orderBy("key").collect() for x in (known.repartition(1), known.repartition(7)))
    assert a == b
    labels = {r["key"]: r["label"] for r in known.collect()}
    assert np.mean([labels[r["key"]] == r["predicted"] for r in a]) > 0.85


def test_regression_has_no_gradient_left(known):
    model = classify.train(known, "logistic_regression", places=64, parts=4, regParam=0.0, maxIter=300, tol=1e-12, standardization=False, elasticNetParam=0.0)
    x, y = features(model, known)
    fit = model.stages[-1]
    p = 1 / (1 + np.exp(-(x @ fit.coefficients.toArray() + fit.intercept)))
    assert np.abs(np.append(x.T @ (p - y), (p - y).sum()) / len(y)).max() < 1e-3


def test_first_split_of_a_tree_is_the_best_one(known):
    model = classify.train(known, "decision_tree", places=64, parts=4, maxDepth=1)
    x, y = features(model, known)

    def impurity(part):
        return 2 * part.mean() * (1 - part.mean()) if len(part) else 0.0

    def gain(column, at):
        left, right = y[column <= at], y[column > at]
        return impurity(y) - (len(left) * impurity(left) + len(right) * impurity(right)) / len(y)

    best = max((gain(x[:, f], (a + b) / 2), f) for f in range(x.shape[1]) for v in [np.unique(x[:, f])] for a, b in zip(v, v[1:], strict=False))
    root = model.stages[-1]._call_java("rootNode")
    assert root.split().featureIndex() == best[1] and abs(root.gain() - best[0]) < 1e-9


def test_search_covers_the_grid_and_takes_the_best(known):
    found = classify.search(known, "logistic_regression", {"regParam": [0.01, 100.0]}, places=64, parts=4)
    table = {r["params"]: r for r in classify.search_table(found).collect()}
    assert table.keys() == {"regParam=0.01", "regParam=100.0"}
    assert table["regParam=0.01"]["chosen"] and not table["regParam=100.0"]["chosen"]
    assert table["regParam=0.01"]["mean_f1"] > table["regParam=100.0"]["mean_f1"]
    assert found.bestModel.stages[-1].getRegParam() == 0.01


@pytest.mark.parametrize("kind", KINDS)
def test_stored_models_score_alike_and_are_logged(known, tmp_path, kind):
    model = classify.train(known, kind, places=64, parts=4)
    classify.save(model, f"{tmp_path}/v1")
    again = classify.scores(classify.load(f"{tmp_path}/v1"), known)
    assert again.orderBy("key").collect() == classify.scores(model, known).orderBy("key").collect()
    lifecycle.log_predictions(again, f"{tmp_path}/log", b"secret", f"{kind}-v1", key="key")
    log = known.sparkSession.read.parquet(f"{tmp_path}/log")
    assert log.columns == ["ticket_pseudonym", "score", "model_version", "logged_at"] and log.filter(F.col("model_version") == f"{kind}-v1").count() == 161
    assert log.join(known.select(pseudonym(F.col("key").cast("string"), b"secret").alias("ticket_pseudonym")), "ticket_pseudonym").count() == 161
    with pytest.raises(Exception, match="exist"):
        classify.save(model, f"{tmp_path}/v1")


def test_unknown_kinds_and_single_folds_are_refused(rows, known):
    with pytest.raises(ValueError, match="one of"):
        classify.train(known, "oracle")
    with pytest.raises(ValueError, match="two folds"):
        classify.labelled_words(rows, "id", "text", "label", folds=1)


@pytest.mark.parametrize("kind", KINDS)
def test_a_fit_reads_words_once_and_keeps_nothing(spark, known, kind):
    seen, kept = spark.sparkContext.accumulator(0), spark._jsc.sc().getPersistentRDDs().size()

    def read(words):
        seen.add(1)
        return words

    classify.train(known.withColumn("words", F.udf(read, "array<string>")("words")), kind, places=64, parts=4)
    assert seen.value == known.count()
    assert spark._jsc.sc().getPersistentRDDs().size() == kept
