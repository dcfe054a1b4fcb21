"""Many logistic models at once against separate fits."""

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import functions as F

from quarry.operators import logistic


def _rows(spark, n=600, seed=0):
    rng = np.random.default_rng(seed)
    x = np.c_[rng.normal(size=n), 50 + 9 * rng.normal(size=n), rng.integers(0, 2, n), np.full(n, 3.0)]
    seg = rng.integers(0, 4, n)
    y = (rng.random(n) < 1 / (1 + np.exp(-(x[:, 0] * (seg - 1) + 0.08 * (x[:, 1] - 50) + 0.5 * x[:, 2])))).astype(float)
    rows = [(i, None if s == 3 else f"s{s}", float(t), i % 5, v.tolist()) for i, (s, t, v) in enumerate(zip(seg, y, x))]
    return spark.createDataFrame(rows, "id long, seg string, y double, fold int, x array<double>").withColumn("v", array_to_vector("x")).cache()


@pytest.mark.parametrize("reg,l1", [(0.0, 0.0), (0.05, 0.0), (0.03, 1.0), (0.02, 0.4)])
def test_segments_are_as_if_fitted_alone(spark, reg, l1):
    df = _rows(spark)
    got = {r["seg"]: r for r in logistic.segmented(df, "seg", "y", "x", reg, l1).collect()}
    assert set(got) == {None, "s0", "s1", "s2"}
    for s, r in got.items():
        part = df.where(F.col("seg").eqNullSafe(F.lit(s)))
        m = LogisticRegression(labelCol="y", featuresCol="v", regParam=reg, elasticNetParam=l1, tol=1e-10, maxIter=500).fit(part)
        assert r["n"] == part.count()
        assert np.allclose(r["coefficients"], m.coefficients.toArray(), atol=2e-4), (s, r["coefficients"], m.coefficients)
        assert abs(r["intercept"] - m.intercept) < 1e-2
    p = logistic.predict(df, logistic.segmented(df, "seg", "y", "x", reg, l1), "seg", "x")
    assert p.where("p1 is null").count() == 0 and p.count() == df.count()


def test_ten_thousand_segments(spark):
    n = 10_000
    df = spark.range(n * 12).select((F.col("id") % n).alias("seg"), F.sin(F.col("id") * 12.9898).alias("a"), F.cos(F.col("id") * 78.233).alias("b"))
    df = df.withColumn("y", (F.col("a") + F.sin(F.col("seg")) * F.col("b") + 0.7 * F.sin(F.col("a") * 9999) > 0).cast("double")).withColumn("x", F.array("a", "b"))
    got = logistic.segmented(df, "seg", "y", "x", 0.1).cache()
    assert got.count() == n and got.where("n = 12").count() == n
    for s in (0, 777, 9999):
        part = df.where(F.col("seg") == s).withColumn("v", array_to_vector("x"))
        r = got.where(F.col("seg") == s).first()
        if part.select("y").distinct().count() == 1:
            assert r["coefficients"] == [0.0, 0.0] and abs(r["intercept"]) == float("inf")
            continue
        m = LogisticRegression(labelCol="y", featuresCol="v", regParam=0.1, tol=1e-10).fit(part)
        assert np.allclose(r["coefficients"], m.coefficients.toArray(), atol=1e-4)


def test_grid_is_that_of_separate_fits(spark):
    df = _rows(spark)
    penalties = [(0.0, 0.0), (0.01, 0.0), (0.5, 0.0), (0.02, 1.0), (0.3, 1.0)]
    g = logistic.grid(df, "fold", "y", "x", penalties)
    for f in (-1, 0, 3):
        for i, (reg, l1) in enumerate(penalties):
            part = df.where(F.col("fold") != f)
            m = LogisticRegression(labelCol="y", featuresCol="v", regParam=reg, elasticNetParam=l1, tol=1e-10, maxIter=500).fit(part)
            assert np.allclose(g["coefficients"][f, i], m.coefficients.toArray(), atol=2e-4), (f, i)
            if f >= 0:
                held = m.transform(df.where(F.col("fold") == f))
                assert g["correct"][f, i] == held.where("prediction = y").count()
    assert g["scans"] < 30


def test_best_penalty_is_that_of_cross_validation(spark):
    df = _rows(spark, seed=3)
    regs = [0.001, 0.05, 1.0]
    lr = LogisticRegression(labelCol="y", featuresCol="v", tol=1e-9)
    cv = CrossValidator(estimator=lr, estimatorParamMaps=ParamGridBuilder().addGrid(lr.regParam, regs).build(), numFolds=5, foldCol="fold",
                        evaluator=MulticlassClassificationEvaluator(labelCol="y", metricName="accuracy")).fit(df)
    table = {r["reg"]: r for r in logistic.grid_table(df, "fold", "y", "x", [(r, 0.0) for r in regs]).collect()}
    assert np.allclose([table[r]["accuracy"] for r in regs], cv.avgMetrics)
    assert [r for r in regs if table[r]["best"]] == [max(regs, key=lambda r: (table[r]["accuracy"], r))]


def test_odd_rows(spark):
    df = _rows(spark).drop("v")
    odd = spark.createDataFrame([(1, "s0", None, 0, [1.0, 2.0, 3.0, 3.0]), (2, "s0", 1.0, 0, [1.0, None, 3.0, 3.0]), (3, "s1", 1.0, 1, None), (4, "s1", 0.0, 1, [float("nan"), 1.0, 1.0, 3.0]), (5, "lone", 1.0, 2, [1.0, 2.0, 3.0, 4.0])],
                                "id long, seg string, y double, fold int, x array<double>")
    a = {r["seg"]: r for r in logistic.segmented(df, "seg", "y", "x", 0.1).collect()}
    b = {r["seg"]: r for r in logistic.segmented(df.unionByName(odd), "seg", "y", "x", 0.1).collect()}
    assert b["lone"]["coefficients"] == [0.0] * 4 and b["lone"]["intercept"] == float("inf")
    assert all(a[s]["n"] == b[s]["n"] and np.allclose(a[s]["coefficients"], b[s]["coefficients"], atol=1e-6) for s in a)
    p = logistic.predict(odd, logistic.segmented(df.unionByName(odd), "seg", "y", "x", 0.1), "seg", "x")
    assert {r["id"]: r["p1"] is None for r in p.collect()} == {1: False, 2: True, 3: True, 4: True, 5: False}
    assert logistic.segmented(df.limit(0), "seg", "y", "x").collect() == []
    assert logistic.grid_table(df.limit(0), "fold", "y", "x", [(0.1, 0.0)]).collect() == []
