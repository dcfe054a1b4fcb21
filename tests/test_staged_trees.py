"""Boosted trees round by round, fold averages and stacking against single fits."""

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from quarry.operators import ml, staged_trees


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(0)
    rows = [(i, i % 3, float(np.sin(a) + 0.3 * b + 0.2 * rng.normal()), [float(a), float(b)]) for i, (a, b) in enumerate(zip(rng.uniform(-3, 3, 500), rng.integers(0, 4, 500)))]
    return spark.createDataFrame(rows, "id long, fold int, y double, x array<double>").withColumn("features", array_to_vector("x")).cache()


def _fit(df):
    return GBTRegressor(labelCol="y", maxIter=6, maxDepth=3, stepSize=0.4, seed=1).fit(df)


def test_staged_scores_are_those_of_the_model_cut_there(table):
    m = _fit(table)
    trees = staged_trees.tree_arrays(m)
    rows = m.transform(table).select("x", "prediction").collect()
    s = staged_trees.staged_scores(trees, np.array([r["x"] for r in rows]))
    assert np.allclose(s[:, -1], [r["prediction"] for r in rows])
    errors = m.evaluateEachIteration(table, "absolute")
    got = staged_trees.staged_errors(table.withColumn("fold", F.lit(7)), "fold", "y", "features", {7: trees}).orderBy("round").collect()
    assert [r["round"] for r in got] == list(range(1, 7)) and np.allclose([r["error"] for r in got], errors)


def naive_best(errors, patience):
    best, at = float("inf"), None
    for i, e in enumerate(errors, 1):
        if e < best:
            best, at = e, i
        elif i - at >= patience:
            return at, best, i
    return at, best, len(errors)


def test_best_rounds_by_patience(spark):
    rng = np.random.default_rng(2)
    curves = {f: np.round(np.cumsum(rng.normal(-0.1, 1, 40)), 1).tolist() for f in range(30)} | {99: [3.0, 3.0, 3.0], 98: [1.0]}
    df = spark.createDataFrame([(f, i + 1, e) for f, es in curves.items() for i, e in enumerate(es)], "fold int, round int, error double")
    got = {r["fold"]: (r["best_round"], r["error"], r["stopped_at"]) for r in staged_trees.best_rounds(df, 4).collect()}
    assert got == {f: naive_best(es, 4) for f, es in curves.items()}


def test_fold_average_is_the_mean_of_models_cut_at_their_best(table):
    test = table.where("id % 7 = 0").drop("fold", "y")
    rows, report = staged_trees.fold_average(table, test, "fold", "y", _fit, patience=2, unscale=np.exp)
    rep = {r["fold"]: r for r in report.collect()}
    want = np.zeros(test.count())
    x = np.array([r["x"] for r in test.orderBy("id").collect()])
    for f in range(3):
        trees = staged_trees.tree_arrays(_fit(table.where(F.col("fold") != f)))
        held = table.where(F.col("fold") == f).collect()
        s = staged_trees.staged_scores(trees, np.array([r["x"] for r in held]))
        at, err, stop = naive_best(np.abs(np.exp(s) - np.exp([[r["y"]] for r in held])).mean(0).tolist(), 2)
        assert (rep[f]["best_round"], rep[f]["stopped_at"]) == (at, stop) and abs(rep[f]["error"] - err) < 1e-9
        want += np.exp(staged_trees.staged_scores(trees, x)[:, at - 1]) / 3
    assert np.allclose([r["prediction"] for r in rows.orderBy("id").collect()], want)
    assert abs(rep[0]["mean_error"] - np.mean([r["error"] for r in rep.values()])) < 1e-12 and rep[0]["mean_best_round"] == int(np.mean([r["best_round"] for r in rep.values()]))


def test_stack_returns_train_and_test_rows(table):
    df = table.withColumn("label", (F.col("y") > 0.4).cast("double")).withColumnRenamed("id", "key")
    train, test = df.where("key % 5 <> 0"), df.where("key % 5 = 0").drop("fold", "label")
    bases = {"lr": LogisticRegression(regParam=0.1), "rf": RandomForestClassifier(numTrees=5, maxDepth=3, seed=2)}
    rows, ginis = ml.stack(train, "label", "key", "fold", bases, test=test)
    got = {(r["part"], r["key"]): r for r in rows.collect()}
    assert len(got) == df.count() and sum(k[0] == "test" for k in got) == test.count()
    models = [LogisticRegression(regParam=0.1, labelCol="label").fit(train.where(F.col("fold") != f)) for f in range(3)]
    mean = test.select("key", "features")
    for f, m in enumerate(models):
        mean = m.transform(mean).select(*mean.columns, ml.vector_to_array("probability")[1].alias(f"p{f}"))
    for r in mean.collect():
        assert abs(got["test", r["key"]]["lr"] - (r["p0"] + r["p1"] + r["p2"]) / 3) < 1e-9 and got["test", r["key"]]["label"] is None
    held = {r["key"]: r for r in models[1].transform(train.where("fold = 1")).select("key", ml.vector_to_array("probability")[1].alias("p")).collect()}
    assert all(abs(got["train", k]["lr"] - r["p"]) < 1e-9 for k, r in held.items())
    level = rows.where("part = 'train'").select("label", array_to_vector(F.array("lr", "rf")).alias("z"))
    final = LogisticRegression(labelCol="label", featuresCol="z", tol=1e-10).fit(level)
    k = next(iter(got))
    eta = final.intercept + float(np.dot(final.coefficients, [got[k]["lr"], got[k]["rf"]]))
    assert abs(got[k]["p_stack"] - 1 / (1 + np.exp(-eta))) < 1e-4
    g = [r["gini"] for r in ginis.collect()]
    assert len(g) == 10 and all(0 < x <= 1 for x in g)
