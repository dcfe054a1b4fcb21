"""Boosted trees round by round: errors after every round in one scan, the best round by patience,
fold averages with their scores.

A fitted ensemble is read back as arrays of nodes (bounded by rounds and depth) and its trees
are walked in tasks, a piece of rows a level at a time; the running sum over trees is the score after
each round. A scan sends one row of sums a fold and task, and models of all folds are walked in it.

A fit whose rounds stop by patience needs no more rounds than that: ``fold_average`` fits to twice the
patience and, while it has not run out, again to twice as many rounds, up to the ceiling.

Defined cases: of equal errors the earliest round is the best; a fold without rows has no error; a
null or NaN label or a null vector takes no part in errors; NaN features go right, as in ``pyspark.ml``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence
from multiprocessing.pool import ThreadPool

import numpy as np
import pandas as pd
from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.session import stage_path

# rows of a partition of the training table: the most, and the fewest for which it is spread over the cores
PART_ROWS, SPREAD_ROWS = 1_000_000, 20_000
# scores (rows x rounds) held at once in a task
PIECE = 1_000_000
ERRORS = "fold int, round int, error double"
# below this many rows a core, a fit leaves cores idle between its jobs: the folds are fitted side by side
SIDE_BY_SIDE = 250_000


def tree_arrays(model) -> list[dict]:
    """Node arrays of each tree of a fitted ensemble, with its weight: ``feature`` (-1 at a leaf),
    ``threshold``, ``left``, ``right``, ``value``. Continuous splits only."""
    spark = SparkSession.active()
    path = stage_path(spark, f"trees-{uuid.uuid4().hex[:12]}")
    model.write().save(path)
    n = F.col("nodeData")
    nodes = spark.read.parquet(f"{path}/data").select("treeID", n["id"].alias("id"), n["prediction"].alias("value"), n["leftChild"].alias("left"), n["rightChild"].alias("right"),
                                                      n["split"]["featureIndex"].alias("feature"), n["split"]["numCategories"].alias("categories"),
                                                      F.coalesce(F.get(n["split"]["leftCategoriesOrThreshold"], F.lit(0)), F.lit(0.0)).alias("threshold"))
    nodes = nodes.toPandas().sort_values(["treeID", "id"])
    if (nodes["categories"] > 0).any():
        raise ValueError("a tree splits by categories")
    nodes["feature"] = nodes["feature"].where(nodes["left"] >= 0, -1)
    trees = [dict(weight=float(w)) for w in model.treeWeights]
    for t, mine in nodes.groupby("treeID"):
        trees[t].update({c: mine[c].to_numpy() for c in ("feature", "left", "right", "threshold", "value")})
    return trees


def staged_scores(trees: Sequence[dict], x: np.ndarray) -> np.ndarray:
    """Scores after each round: rows x rounds."""
    out = np.empty((len(x), len(trees)))
    for t, tree in enumerate(trees):
        at = np.zeros(len(x), int)
        while (inner := np.flatnonzero(tree["feature"][at] >= 0)).size:
            k = at[inner]
            low = x[inner, tree["feature"][k]] <= tree["threshold"][k]
            at[inner] = np.where(low, tree["left"][k], tree["right"][k])
        out[:, t] = tree["weight"] * tree["value"][at]
    return np.cumsum(out, 1)


def _pieces(n: int, trees: Sequence[dict]) -> Iterator[slice]:
    """Slices of ``n`` rows whose scores are at most about ``PIECE`` numbers."""
    step = max(1, PIECE // max(1, len(trees)))
    return (slice(i, i + step) for i in range(0, n, step))


def staged_errors(df: DataFrame, fold: str, label: str, features: str, trees: dict, unscale: Callable | None = None) -> DataFrame:
    """``fold``, ``round`` (from 1), ``error``: mean absolute error after every round, of the rows of each fold
    under the trees of ``trees[fold]``; ``unscale`` is applied to scores and labels before."""
    scale = unscale or (lambda v: v)
    rows = df.where(F.col(label).isNotNull() & ~F.isnan(F.col(label).cast("double")) & F.col(features).isNotNull())
    rows = rows.select(F.col(fold).cast("int").alias("fold"), F.col(label).cast("double").alias("y"), vector_to_array(features).alias("x")).where(F.col("fold").isin(list(trees)))

    def part(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict = {}
        for b in batches:
            for f, r in b.groupby("fold"):
                x, y, t = np.stack(r["x"].to_numpy()), scale(r["y"].to_numpy()), trees[int(f)]
                e = sum(np.abs(scale(staged_scores(t, x[p])) - y[p, None]).sum(0) for p in _pieces(len(r), t))
                n, was = total.get(int(f), (0, 0))
                total[int(f)] = n + len(r), was + e
        rows = [(f, i + 1, float(v), n) for f, (n, e) in total.items() for i, v in enumerate(e)]
        yield pd.DataFrame(rows, columns=["fold", "round", "e", "n"])
    sums = rows.mapInPandas(part, "fold int, round int, e double, n long")
    return sums.groupBy("fold", "round").agg((F.sum("e") / F.sum("n")).alias("error"))


def best_rounds(errors: DataFrame, patience: int, fold: str = "fold", rnd: str = "round", error: str = "error") -> DataFrame:
    """``fold``, ``best_round``, ``error``, ``stopped_at``: training stops once ``patience`` rounds have passed
    without a lower error; the best round is the one of the lowest error until then."""
    upto = Window.partitionBy(fold).orderBy(rnd)
    seen = errors.withColumn("__low", F.min(error).over(upto.rowsBetween(Window.unboundedPreceding, -1)))
    seen = seen.withColumn("__at", F.max(F.when(F.col("__low").isNull() | (F.col(error) < F.col("__low")), F.col(rnd))).over(upto))
    seen = seen.withColumn("__stop", F.min(F.when(F.col(rnd) - F.col("__at") >= patience, F.col(rnd))).over(Window.partitionBy(fold)))
    kept = seen.where(F.col("__stop").isNull() | (F.col(rnd) <= F.col("__stop")))
    return kept.groupBy(fold).agg(F.max("__at").alias("best_round"), F.min(error).alias("error"), F.max(rnd).alias("stopped_at"))


def fold_report(best: DataFrame) -> DataFrame:
    """The rows of ``best_rounds`` with the mean error and the mean best round (whole) over the folds."""
    every = Window.partitionBy(F.lit(0))  # one row a fold
    return best.withColumn("mean_error", F.avg("error").over(every)).withColumn("mean_best_round", F.floor(F.avg("best_round").over(every)).cast("int"))


def average_folds(predictions: DataFrame, key: str, fold: str, value: str) -> DataFrame:
    """``key``, the mean of ``value`` over the folds, and their number."""
    return predictions.groupBy(key).agg(F.avg(value).alias("prediction"), F.count(F.col(fold)).alias("folds"))


def predict_folds(df: DataFrame, features: str, trees: dict, rounds: dict, unscale: Callable | None = None, out: str = "prediction") -> DataFrame:
    """``df`` with ``fold_predictions`` (in the order of the folds) at each fold's best round, and their mean, in one scan."""
    scale = unscale or (lambda v: v)
    kept = {f: trees[f][:rounds[f]] for f in sorted(rounds)}

    @F.pandas_udf("array<double>")
    def score(v: pd.Series) -> pd.Series:
        if not len(v) or not kept:
            return pd.Series([[]] * len(v), dtype=object)
        x = np.stack(v.to_numpy())
        last = [np.concatenate([staged_scores(t, x[p])[:, -1] for p in _pieces(len(x), t)]) for t in kept.values()]
        return pd.Series(list(np.column_stack([scale(s) for s in last])))
    scored = df.withColumn("fold_predictions", score(vector_to_array(features)))
    return scored.withColumn(out, F.try_divide(F.aggregate("fold_predictions", F.lit(0.0), lambda a, x: a + x), F.size("fold_predictions").cast("double")))


def fold_average(train: DataFrame, test: DataFrame, fold: str, label: str, fit: Callable[..., object], features: str = "features",
                 patience: int = 50, unscale: Callable | None = None, ceiling: int | None = None) -> tuple[DataFrame, DataFrame]:
    """One ensemble a fold, fitted without it, cut at the best round on the fold by ``patience``. ``train`` is
    evaluated once. Returns the test rows with their averaged prediction, and a report row a fold.

    Without ``ceiling``, ``fit(rows)`` fits to its own ceiling of rounds. With it, ``fit(rows, rounds)`` is asked for
    2 ``patience`` rounds, and again for twice as many while patience has not run out and ``ceiling`` is not reached.
    Its first rounds must not depend on how many follow; then trees, errors and best rounds are those of a fit to
    ``ceiling``, whose rounds after the stop count for nothing."""
    # read by every fit several times: kept on the executors' disks, spread over the cores
    train = train.persist(StorageLevel.DISK_ONLY)
    counts = train.groupBy(F.col(fold).cast("int").alias("fold")).count().collect()
    total, cores = sum(r["count"] for r in counts), train.sparkSession.sparkContext.defaultParallelism
    parts = max(min(cores, total // SPREAD_ROWS), -(-total // PART_ROWS))
    if train.rdd.getNumPartitions() < parts:
        lies, train = train, train.repartition(parts).persist(StorageLevel.DISK_ONLY)
        train.count()
        lies.unpersist()
    pending = sorted(r["fold"] for r in counts if r["fold"] is not None)
    rounds = None if ceiling is None else min(ceiling, 2 * max(patience, 1))
    trees, errors = {}, []
    with ThreadPool(max(1, len(pending)) if total <= SIDE_BY_SIDE * cores else 1) as pool:
        while pending:
            args = () if rounds is None else (rounds,)
            one = inheritable_thread_target(train.sparkSession)(lambda f: fit(train.where(F.col(fold) != f), *args))
            trees |= {f: tree_arrays(m) for f, m in zip(pending, pool.map(one, pending))}
            new = staged_errors(train, fold, label, features, {f: trees[f] for f in pending}, unscale).collect()
            going = set()
            if rounds is not None and rounds < ceiling:
                best = best_rounds(train.sparkSession.createDataFrame(new, ERRORS), patience).collect()
                going = {r["fold"] for r in best if r["stopped_at"] - r["best_round"] < patience}
                rounds = min(ceiling, 2 * rounds)
            errors += [r for r in new if r["fold"] not in going]
            pending = [f for f in pending if f in going]
    train.unpersist()
    known = train.sparkSession.createDataFrame(errors, ERRORS)
    report = fold_report(best_rounds(known, patience))
    rows = report.collect()  # one a fold
    if not rows:
        raise ValueError("no fold has rows to judge its rounds by")
    known = train.sparkSession.createDataFrame([tuple(r) for r in rows], report.schema)
    return predict_folds(test, features, trees, {r["fold"]: r["best_round"] for r in rows}, unscale), known
