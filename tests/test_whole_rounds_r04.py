"""Boosted fits of the folds go to the reference's rounds, and stop by patience only."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

import __spark_entry__ as E
from quarry.operators import ml, staged_trees
from tests.conftest import SF_SMALL


class Asked(Exception):
    pass


@pytest.mark.parametrize("name", ["ml_fold_average", "ml_fold_report", "pipe_claims"])
def test_queries_ask_for_all_rounds(spark, monkeypatch, name):
    asked, fits = [], []

    def fold_average(train, test, fold, label, fit, features="features", patience=50, unscale=None, ceiling=None):
        asked.append((patience, ceiling))
        fit(train, 77)
        raise Asked
    monkeypatch.setattr(staged_trees, "fold_average", fold_average)
    monkeypatch.setattr(ml.GBTRegressor, "fit", lambda self, df: fits.append((self.getMaxIter(), self.getMaxDepth(), self.getStepSize(), self.getSubsamplingRate())))
    with pytest.raises(Asked):
        E.queries()[name](spark, SF_SMALL)
    assert asked == [(50, 2000)] and fits == [(77, 8, 0.03, 0.9)]


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(0)
    rows = [(i, i % 3, float(np.sin(a) + 0.3 * b + 0.4 * rng.normal()), [float(a), float(b)]) for i, (a, b) in enumerate(zip(rng.uniform(-3, 3, 300), rng.integers(0, 4, 300)))]
    return spark.createDataFrame(rows, "id long, fold int, y double, x array<double>").withColumn("features", array_to_vector("x")).coalesce(1).cache()


def _fit(df, rounds):
    return GBTRegressor(labelCol="y", maxIter=rounds, maxDepth=2, stepSize=0.1, seed=1).fit(df)


@pytest.mark.parametrize("ceiling", [24, 5])
def test_growing_fits_are_one_fit_to_the_ceiling(table, ceiling):
    test = table.where("id % 7 = 0").drop("fold", "y")
    asked = []

    def fit(df, rounds):
        asked.append(rounds)
        return _fit(df, rounds)
    rows, report = staged_trees.fold_average(table, test, "fold", "y", fit, patience=3, ceiling=ceiling)
    whole, known = staged_trees.fold_average(table, test, "fold", "y", lambda df: _fit(df, ceiling), patience=3)
    got, want = ({r["fold"]: r for r in x.collect()} for x in (report, known))
    for f in range(3):
        assert [got[f][c] for c in ("best_round", "stopped_at", "mean_best_round")] == [want[f][c] for c in ("best_round", "stopped_at", "mean_best_round")]
        assert got[f]["error"] == pytest.approx(want[f]["error"], rel=1e-12)
    mine, theirs = ([r["prediction"] for r in x.orderBy("id").collect()] for x in (rows, whole))
    assert np.allclose(mine, theirs, rtol=1e-12)
    assert asked[:3] == [min(ceiling, 6)] * 3 and set(asked[3:]) == ({12, 24} if ceiling == 24 else set())  # patience was not out after 6 rounds


def test_pieces_of_rows_have_the_errors_of_all(table, monkeypatch):
    trees = {7: staged_trees.tree_arrays(_fit(table, 6))}
    of = lambda: [r["error"] for r in staged_trees.staged_errors(table.withColumn("fold", F.lit(7)), "fold", "y", "features", trees, np.exp).orderBy("round").collect()]
    test = table.select("id", "features")
    predicted = lambda: [r["fold_predictions"] for r in staged_trees.predict_folds(test, "features", trees, {7: 5}, np.exp).orderBy("id").collect()]
    whole = of(), predicted()
    monkeypatch.setattr(staged_trees, "PIECE", 50)
    assert np.allclose(of(), whole[0], rtol=1e-12) and predicted() == whole[1] and len(whole[0]) == 6
