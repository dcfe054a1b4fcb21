"""Models on ``pyspark.ml``: every fit is a distributed Spark job; only
model parameters come back to the driver."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd


from pyspark import StorageLevel
from pyspark.ml.classification import (GBTClassifier, LinearSVC, LogisticRegression, MultilayerPerceptronClassifier,
                                       NaiveBayes, OneVsRest, RandomForestClassifier)
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.session import cut_lineage, staged

from quarry.functions.numeric import fair_grad, fair_hess
from quarry.operators.sequence import null_safe_join


class EmptyTraining(ValueError):
    pass


def require_rows(train: DataFrame, what: str = "training table") -> DataFrame:
    """Raise a clear error before a fit on an empty table (Spark ML fails deep inside)."""
    if train.isEmpty():
        raise EmptyTraining(f"{what} is empty")
    return train


def assemble(df: DataFrame, cols: Sequence[str], out: str = "features") -> DataFrame:
    """Numeric columns and/or numeric array columns -> one dense vector column (null -> NaN),
    built as one concatenated double array in a projection."""
    parts = []
    for c in cols:
        if df.schema[c].dataType.simpleString().startswith("array"):
            parts.append(F.transform(F.col(c), lambda x: F.coalesce(x.cast("double"), F.lit(float("nan")))))
        else:
            parts.append(F.array(F.coalesce(F.col(c).cast("double"), F.lit(float("nan")))))
    return df.withColumn(out, array_to_vector(F.concat(*parts)))


def class_weights(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    """Balanced weight n / (k * n_c) per row's class, from one grouped count."""
    counts = df.groupBy(label).agg(F.count("*").alias("__nc"))
    tot = counts.agg(F.sum("__nc"), F.count("*")).first()
    n, k = tot[0] or 0, tot[1] or 1
    return null_safe_join(df, counts, [label]).withColumn(out, F.lit(float(n)) / (F.lit(float(k)) * F.col("__nc"))).drop("__nc")


def boost_regressor(train: DataFrame, label: str, features: str = "features", rounds: int = 2000, depth: int = 8,
                    rate: float = 0.03, subsample: float = 0.9, feature_share: str = "0.9",
                    validation: str | None = None, seed: int = 0):
    """Gradient-boosted trees; with a validation indicator column, boosting stops once the
    validation error stops improving."""
    require_rows(train)
    gbt = GBTRegressor(labelCol=label, featuresCol=features, maxIter=rounds, maxDepth=depth, stepSize=rate,
                       subsamplingRate=subsample, featureSubsetStrategy=feature_share, seed=seed)
    if validation:
        gbt = gbt.setValidationIndicatorCol(validation)
    return gbt.fit(train)


def boost_custom(train: DataFrame, label: str, features: str = "features", rounds: int = 20, depth: int = 4,
                 rate: float = 0.1, grad: Callable[[Column], Column] = fair_grad,
                 hess: Callable[[Column], Column] = fair_hess, checkpoint_every: int = 5, key: str | None = None):
    """Newton boosting on a user objective: each round fits a weighted regression tree to
    -g/h with weights h (g, h = gradient and hessian at the current prediction) and adds it
    with shrinkage. Returns (trees, base, scored training table). Lineage is cut every few
    rounds, while rounds follow, with a reliable checkpoint; what a fit reads several times is kept on
    the executors' disks while it runs."""
    require_rows(train)
    base = train.agg(F.avg(label)).first()[0] or 0.0
    cur = train.withColumn("__pred", F.lit(float(base)))
    trees = []
    for r in range(rounds):
        x = F.col("__pred") - F.col(label)
        step = cur.withColumn("__g", grad(x)).withColumn("__h", hess(x))
        step = step.withColumn("__t", -F.col("__g") / F.col("__h"))
        step = step.select(features, "__t", "__h").persist(StorageLevel.DISK_ONLY)
        tree = DecisionTreeRegressor(featuresCol=features, labelCol="__t", weightCol="__h", maxDepth=depth).fit(step)
        step.unpersist()
        trees.append(tree)
        cur = tree.setPredictionCol("__tp").transform(cur).withColumn("__pred", F.col("__pred") + rate * F.col("__tp")).drop("__tp")
        if checkpoint_every and (r + 1) % checkpoint_every == 0 and r + 1 < rounds:
            cur = cut_lineage(cur)
    return trees, base, cur


def predict_custom(trees, base: float, df: DataFrame, rate: float = 0.1) -> DataFrame:
    cur = df.withColumn("prediction", F.lit(float(base)))
    for tree in trees:
        cur = tree.setPredictionCol("__tp").transform(cur).withColumn("prediction", F.col("prediction") + rate * F.col("__tp")).drop("__tp")
    return cur


def boost_classifier(train: DataFrame, label: str, features: str = "features", rounds: int = 50, depth: int = 4,
                     rate: float = 0.1, subsample: float = 0.8, seed: int = 0):
    require_rows(train)
    return GBTClassifier(labelCol=label, featuresCol=features, maxIter=rounds, maxDepth=depth, stepSize=rate,
                         subsamplingRate=subsample, seed=seed).fit(train)


def multiclass_boost(train: DataFrame, label: str, features: str = "features", rounds: int = 20, depth: int = 4):
    """One-vs-rest boosted trees: a score per class (rawPrediction), enough to rank classes."""
    require_rows(train)
    return OneVsRest(classifier=GBTClassifier(maxIter=rounds, maxDepth=depth), labelCol=label, featuresCol=features).fit(train)


def forest(train: DataFrame, label: str, features: str = "features", trees: int = 50, depth: int = 8,
           per_split: str = "sqrt", weight: str | None = None, seed: int = 0):
    require_rows(train)
    rf = RandomForestClassifier(labelCol=label, featuresCol=features, numTrees=trees, maxDepth=depth,
                                featureSubsetStrategy=per_split, seed=seed)
    if weight:
        rf = rf.setWeightCol(weight)
    return rf.fit(train)


def logistic(train: DataFrame, label: str, features: str = "features", reg: float = 0.0, l1: float = 0.0):
    require_rows(train)
    return LogisticRegression(labelCol=label, featuresCol=features, regParam=reg, elasticNetParam=l1).fit(train)


def coefficient_table(model, names: Sequence[str], spark) -> DataFrame:
    """(feature, coef, abs) of a fitted linear model, sorted by |coef| descending."""
    coef = model.coefficients.toArray().tolist()
    df = spark.createDataFrame([(n, float(c)) for n, c in zip(names, coef)], "feature string, coef double")
    return df.withColumn("abs", F.abs("coef")).orderBy(F.desc("abs"), "feature")


def linear_svc(train: DataFrame, label: str, features: str = "features", reg: float = 0.0, weight: str | None = None):
    require_rows(train)
    svc = LinearSVC(labelCol=label, featuresCol=features, regParam=reg)
    if weight:
        svc = svc.setWeightCol(weight)
    return svc.fit(train)


def random_fourier(df: DataFrame, features: str, dims: int, gamma: float, seed: int = 0, out: str = "rff") -> DataFrame:
    """Random Fourier features (Rahimi & Recht, 2007) for the RBF kernel exp(-gamma |x - y|^2):
    z(x) = sqrt(2 / D) cos(W x + b), W ~ N(0, 2 gamma), b ~ U(0, 2 pi). W and b (D x d numbers)
    are drawn on the driver from the seed and applied per Arrow batch."""
    d = len(df.select(features).first()[0])
    rng = np.random.default_rng(seed)
    w = rng.normal(0.0, np.sqrt(2 * gamma), size=(dims, d))
    b = rng.uniform(0, 2 * np.pi, size=dims)
    bc = df.sparkSession.sparkContext.broadcast((w, b))

    @F.pandas_udf("array<double>")
    def rff(v: pd.Series) -> pd.Series:
        ww, bb = bc.value
        x = np.stack(v.to_numpy()) if len(v) else np.zeros((0, d))
        z = np.sqrt(2.0 / dims) * np.cos(x @ ww.T + bb)
        return pd.Series(list(z))

    return df.withColumn(out, array_to_vector(rff(vector_to_array(features))))


def rbf_svc(train: DataFrame, label: str, features: str = "features", dims: int = 256, gamma: float = 0.1,
            balanced: bool = True, seed: int = 0):
    """Kernel SVC re-aimed: linear SVC on random Fourier features, balanced class weights, and
    a Platt scaling (logistic fit on the margin) for probabilities. Returns a transform fn."""
    z = random_fourier(train, features, dims, gamma, seed)
    if balanced:
        z = class_weights(z, label, "__w")
    svc = linear_svc(z, label, "rff", weight="__w" if balanced else None)
    margin = svc.transform(z).withColumn("__m", array_to_vector(F.array(vector_to_array("rawPrediction")[1])))
    platt = LogisticRegression(labelCol=label, featuresCol="__m").fit(margin.drop("prediction", "rawPrediction"))

    def apply(df: DataFrame) -> DataFrame:
        s = svc.transform(random_fourier(df, features, dims, gamma, seed))
        s = s.withColumn("__m", array_to_vector(F.array(vector_to_array("rawPrediction")[1])))
        return platt.transform(s.drop("prediction", "rawPrediction")).withColumn("p1", vector_to_array("probability")[1])

    return apply


def naive_bayes(train: DataFrame, label: str, features: str = "features"):
    require_rows(train)
    return NaiveBayes(labelCol=label, featuresCol=features, modelType="gaussian").fit(train)


def mlp(train: DataFrame, label: str, n_in: int, n_classes: int, hidden: Sequence[int] = (64,),
        features: str = "features", iters: int = 100, seed: int = 0):
    require_rows(train)
    return MultilayerPerceptronClassifier(labelCol=label, featuresCol=features, layers=[n_in, *hidden, n_classes],
                                          maxIter=iters, seed=seed).fit(train)


def grid_cv(estimator, grid, evaluator, train: DataFrame, fold_col: str | None = None, folds: int = 3,
            parallelism: int = 4, seed: int = 0) -> DataFrame:
    """Grid search with k-fold CV; (params, mean, low, high) with low/high = mean -/+ 2 sd."""
    cv = CrossValidator(estimator=estimator, estimatorParamMaps=grid, evaluator=evaluator, numFolds=folds,
                        parallelism=parallelism, seed=seed)
    if fold_col:
        cv = cv.setFoldCol(fold_col)
    model = cv.fit(train)
    rows = []
    for pm, mu, sd in zip(grid, model.avgMetrics, model.stdMetrics):
        rows.append((", ".join(f"{p.name}={v}" for p, v in pm.items()), float(mu), float(mu - 2 * sd), float(mu + 2 * sd)))
    return train.sparkSession.createDataFrame(rows, "params string, mean double, low double, high double"), model


def compare(models: dict, train: DataFrame, valid: DataFrame, label: str, features: str = "features") -> DataFrame:
    """Fit each estimator; (model, train_accuracy, valid_accuracy)."""
    ev = MulticlassClassificationEvaluator(labelCol=label, metricName="accuracy")
    rows = []
    for name, est in models.items():
        m = est.setLabelCol(label).setFeaturesCol(features).fit(train)
        rows.append((name, float(ev.evaluate(m.transform(train))), float(ev.evaluate(m.transform(valid)))))
    return train.sparkSession.createDataFrame(rows, "model string, train_accuracy double, valid_accuracy double")


def fold_scores(train: DataFrame, label: str, key: str, fold: str, bases: dict, features: str = "features",
                test: DataFrame | None = None) -> DataFrame:
    """One long table (part, key, model, fold, p) of P(y = 1): for each fold and base model fitted without
    it, the scores of its rows (``train``) and of all test rows (``test``). Written to the shared folder."""
    folds = [r[0] for r in train.select(fold).distinct().collect() if r[0] is not None]
    out = None
    for name, est in bases.items():
        for f in sorted(folds):
            model = est.copy().setLabelCol(label).setFeaturesCol(features).fit(require_rows(train.filter(F.col(fold) != f)))
            parts = [("train", train.filter(F.col(fold) == f))] + ([("test", test)] if test is not None else [])
            for part, rows in parts:
                s = model.transform(rows).select(F.lit(part).alias("part"), F.col(key).alias("key"), F.lit(name).alias("model"), F.lit(f).alias("fold"),
                                                 vector_to_array("probability")[1].alias("p"))
                out = s if out is None else out.unionByName(s)
    return staged(out, "fold-scores")


def assemble_scores(scores: DataFrame, models: Sequence[str]) -> DataFrame:
    """(part, key, one column a model): a training row has its out-of-fold score, a test row the mean
    over the folds. One pass over the long table."""
    return scores.groupBy("part", "key").agg(*[F.avg(F.when(F.col("model") == m, F.col("p"))).alias(m) for m in models])


def stack(train: DataFrame, label: str, key: str, fold: str, bases: dict, features: str = "features",
          test: DataFrame | None = None, score_folds: int = 10, seed: str = "0") -> tuple[DataFrame, DataFrame]:
    """Stacking: out-of-fold P(y=1) of each base model become the features of a logistic model, which
    is also fitted without each of ``score_folds`` stratified folds (all at once, see ``logistic.grid``)
    and scored on it by the normalised Gini. Returns the rows (part, key, label, base scores, p_stack)
    of training and test table, the test rows scored from their averaged base scores, and the table
    (fold, gini). A fold with one class has no Gini."""
    from quarry.operators import logistic
    from quarry.operators.windows import fold_stratified, gini_normalized

    names = list(bases)
    wide = staged(assemble_scores(fold_scores(train, label, key, fold, bases, features, test), names), "stack-level")
    z = F.array(*[F.col(n) for n in names])
    level = train.select(F.col(key).alias("key"), F.col(label).cast("double").alias(label)).join(wide.where("part = 'train'").drop("part"), "key").withColumn("z", z)
    level = staged(fold_stratified(level, label, "key", score_folds, seed, "__f"), "stack-train")
    g = logistic.grid(level, "__f", label, "z", [(0.0, 0.0)])
    last = lambda f: logistic.probability(F.col("z"), g["coefficients"][f, 0], g["intercept"][f, 0])
    own = None
    for f in range(len(g["n"])):
        own = F.when(F.col("__f") == f, last(f)) if own is None else own.when(F.col("__f") == f, last(f))
    scored = level.select(F.col("__f").alias("fold"), F.col(label).cast("long").alias("y"), own.alias("p"), (-F.col(label)).alias("tie"))
    ginis = gini_normalized(scored, "y", "p", "tie", ["fold"]).select("fold", F.col("gini_norm").alias("gini"))
    rows = level.select(F.lit("train").alias("part"), "key", label, *names, last(-1).alias("p_stack"))
    if test is not None:
        rows = rows.unionByName(wide.where("part = 'test'").withColumn("z", z).select("part", "key", F.lit(None).cast("double").alias(label), *names, last(-1).alias("p_stack")))
    return rows, ginis


def segmented(df: DataFrame, segment: str, fit_predict: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Same pipeline per segment value (few segments), results recombined by union."""
    segs = [r[0] for r in df.select(segment).distinct().orderBy(segment).collect()]
    out = None
    for s in segs:
        part = fit_predict(df.filter(F.col(segment).eqNullSafe(s)))
        out = part if out is None else out.unionByName(part)
    return out


class GiniEvaluator(BinaryClassificationEvaluator):
    """A user metric given to model selection: normalised Gini of P(y = 1). Of rows with equal
    scores the negatives are walked first, so the score does not depend on the order of rows."""

    def _evaluate(self, dataset):  # noqa: D401
        from quarry.operators.windows import gini_normalized
        lab = self.getLabelCol()
        d = dataset.select(F.col(lab).cast("long").alias("y"), vector_to_array(self.getRawPredictionCol())[1].alias("p"),
                           (-F.col(lab)).alias("__tie"))
        r = gini_normalized(d, "y", "p", "__tie").first()
        return float(r["gini_norm"] or 0.0)

    def isLargerBetter(self):
        return True




def adaboost(train: DataFrame, label: str, features: str = "features", rounds: int = 10, depth: int = 1,
             checkpoint_every: int = 5):
    """Binary AdaBoost (discrete, SAMME with two classes) as a loop of weighted decision trees:
    each round fits a tree with the current row weights, alpha = ln((1 - err) / err), and
    multiplies the weights of misclassified rows by exp(alpha). Returns [(tree, alpha)]."""
    from pyspark.ml.classification import DecisionTreeClassifier

    require_rows(train)
    cur = train.withColumn("__w", F.lit(1.0))
    models = []
    for r in range(rounds):
        tree = DecisionTreeClassifier(labelCol=label, featuresCol=features, weightCol="__w", maxDepth=depth).fit(cur)
        scored = tree.setPredictionCol("__p").setRawPredictionCol("__raw").setProbabilityCol("__prob").transform(cur)
        miss = (F.col("__p") != F.col(label)).cast("double")
        tot = scored.agg(F.sum(F.col("__w") * miss).alias("e"), F.sum("__w").alias("w")).first()
        err = (tot["e"] or 0.0) / (tot["w"] or 1.0)
        if err <= 0 or err >= 0.5:
            models.append((tree, 1.0 if err <= 0 else 0.0))
            break
        alpha = float(np.log((1 - err) / err))
        models.append((tree, alpha))
        cur = scored.withColumn("__w", F.col("__w") * F.exp(F.lit(alpha) * miss)).drop("__p", "__raw", "__prob")
        if checkpoint_every and (r + 1) % checkpoint_every == 0:
            cur = cut_lineage(cur)
    return models


def adaboost_predict(models, df: DataFrame, out: str = "prediction") -> DataFrame:
    """Sign of the alpha-weighted vote of the trees (classes 0/1)."""
    cur = df.withColumn("__score", F.lit(0.0))
    for i, (tree, alpha) in enumerate(models):
        cur = (tree.setPredictionCol("__p").setRawPredictionCol("__raw").setProbabilityCol("__prob").transform(cur)
               .withColumn("__score", F.col("__score") + F.lit(alpha) * (2 * F.col("__p") - 1)).drop("__p", "__raw", "__prob"))
    return cur.withColumn(out, (F.col("__score") > 0).cast("double")).drop("__score")
