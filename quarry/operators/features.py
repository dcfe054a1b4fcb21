"""Feature transformers: fit = one aggregate pass that brings a few statistics
to the driver; transform = column expressions (or a model) applied on the executors."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.session import cut_lineage

from quarry.operators import aggs, joins


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ------------------------------------------------------------------ Box-Cox

def _boxcox_expr(x: Column, lam: float) -> Column:
    if abs(lam) < 1e-12:
        return F.ln(x)
    return (F.pow(x, F.lit(lam)) - 1.0) / F.lit(lam)


def _merged(n, mean, m2):
    """Counts, means and sums of squares about the mean of parts (rows), of all of them together."""
    total = n.sum(0)
    with np.errstate(all="ignore"):
        middle = np.where(n > 0, n * mean, 0).sum(0) / np.maximum(total, 1)
        return total, middle, np.where(n > 0, m2 + n * (mean - middle) ** 2, 0).sum(0)


def boxcox_logliks(df: DataFrame, grids: dict[str, Sequence[float]], shift: float = 0.0) -> DataFrame:
    """(column, lambda, llf) for the grid of every column, all in one pass:
    llf = (lambda - 1) * sum(ln x) - n / 2 * ln(var_pop(y_lambda)). Where the power leaves the range of
    doubles (or a column has one value) there is no llf.

    A task sums its rows in batches and sends one row a column (its count, the sum of logarithms and the
    moments of each lambda), which meet in a group a column."""
    cols = {f"c{i}": (c, np.array(list(lambdas), float)) for i, (c, lambdas) in enumerate(grids.items())}
    moments = "n long, logs long, s double, lo double, hi double, m array<long>, mean array<double>, m2 array<double>"

    def sums(x: np.ndarray, lambdas: np.ndarray) -> tuple:
        positive = bool((x > 0).all())
        with np.errstate(all="ignore"):
            ln = np.log(x if positive else x[~(x <= 0)])  # the logarithm of the others is null
            m, mean, m2 = (np.zeros(len(lambdas)) for _ in range(3))
            for i, lam in enumerate(lambdas):
                y = ln if abs(lam) < 1e-12 else ((np.exp(lam * ln) if positive else np.power(x, lam)) - 1.0) / lam
                if len(y):
                    m[i], mean[i] = len(y), y.mean()
                    m2[i] = ((y - mean[i]) ** 2).sum()
            return len(x), len(ln), float(ln.sum()), float(x.min()), float(x.max()), m, mean, m2

    def part(batches):
        kept: dict = {}
        for b in batches:
            for k, (_, lambdas) in cols.items():
                x = b[k].to_numpy(float)[~b[f"{k}_null"].to_numpy(bool)]
                if len(x):
                    one = sums(x, lambdas)
                    n, logs, s, lo, hi, *rest = kept[k] if k in kept else (0, 0, 0.0, np.inf, -np.inf, *[np.zeros(len(lambdas))] * 3)
                    kept[k] = (n + one[0], logs + one[1], s + one[2], min(lo, one[3]), max(hi, one[4]), *_merged(*[np.stack(p) for p in zip(rest, one[5:])]))
        rows = [(k, n, logs, s, lo, hi, m.astype(int).tolist(), mean.tolist(), m2.tolist()) for k, (n, logs, s, lo, hi, m, mean, m2) in kept.items()]
        yield pd.DataFrame(rows, columns=["key", "n", "logs", "s", "lo", "hi", "m", "mean", "m2"])

    def together(g: pd.DataFrame) -> pd.DataFrame:
        m, mean, m2 = _merged(*[np.stack(g[c].to_numpy()).astype(float) for c in ("m", "mean", "m2")])
        key = g["key"].iloc[0]
        n, s = int(g["n"].sum()), float(g["s"].sum(skipna=False)) if g["logs"].sum() else np.nan
        with np.errstate(all="ignore"):
            v = m2 / m if g["lo"].min() < g["hi"].max() else np.zeros(len(m))  # of equal values none, not what rounding leaves
            llf = np.where((v > 0) & (v < np.inf), (cols[key][1] - 1.0) * s - n / 2.0 * np.log(v), np.nan)
        return pd.DataFrame({"key": [key], "llf": [[float(f) if 0 < w < np.inf and not np.isnan(f) else None for f, w in zip(llf, v)]]})

    values = df.select(*[e for k, (c, _) in cols.items() for e in ((_c(c) + F.lit(shift)).cast("double").alias(k), _c(c).isNull().alias(f"{k}_null"))])
    found = values.mapInPandas(part, f"key string, {moments}").groupBy("key").applyInPandas(together, "key string, llf array<double>")
    grid = df.sparkSession.createDataFrame([(k, c, [float(v) for v in lambdas]) for k, (c, lambdas) in cols.items()], "key string, column string, lambdas array<double>")
    cells = F.transform("lambdas", lambda v, i: F.struct(v.alias("lambda"), F.get("llf", i).alias("llf")))
    return F.broadcast(grid).join(found, "key", "left").select("column", F.explode(cells).alias("r")).select("column", "r.*")


def boxcox_loglik(df: DataFrame, col: str, lambdas: Sequence[float], shift: float = 0.0) -> DataFrame:
    """(lambda, llf) for every lambda of one column's grid."""
    return boxcox_logliks(df, {col: lambdas}, shift).select("lambda", "llf")


@dataclass
class BoxCox:
    """Maximum-likelihood Box-Cox per column, found on grids over a bracket: a bracket whose best value
    is at an end moves there and doubles, any other shrinks around its best value, ``rounds`` times."""

    lambdas: dict[str, float] = field(default_factory=dict)
    shift: float = 0.0

    @classmethod
    def fit(cls, df: DataFrame, cols: Sequence[str], shift: float = 1.0, lo: float = -3.0, hi: float = 3.0,
            steps: int = 24, rounds: int = 4, moves: int = 8) -> "BoxCox":
        """One aggregate over the table a round, for all columns; at most ``rounds + moves`` rounds. A column
        without two different values is left as it is."""
        at = {c: (lo, hi, rounds, moves) for c in cols}
        out: dict[str, float] = {}
        while at:
            grids = {c: [a + (b - a) * i / steps for i in range(steps + 1)] for c, (a, b, _, _) in at.items()}
            found: dict[str, list] = {}
            for r in boxcox_logliks(df, grids, shift).where("llf is not null").collect():  # steps + 1 a column
                found.setdefault(r["column"], []).append((-r["llf"], r["lambda"]))
            for c, (a, b, left, free) in list(at.items()):
                if c not in found:
                    del at[c]
                    continue
                best = out[c] = min(found[c])[1]
                if best in (grids[c][0], grids[c][-1]) and free:
                    at[c] = (best - (b - a), best + (b - a), left, free - 1)
                elif left > 1:
                    width = (b - a) / steps
                    at[c] = (best - width, best + width, left - 1, free)
                else:
                    del at[c]
        return cls(out, shift)

    def transform(self, df: DataFrame) -> DataFrame:
        return df.select(*[_boxcox_expr(F.col(c) + F.lit(self.shift), self.lambdas[c]).alias(c)
                           if c in self.lambdas else F.col(c) for c in df.columns])


# ------------------------------------------------------------------ scalers

@dataclass
class Stats:
    values: dict[str, tuple]

    @staticmethod
    def of(df: DataFrame, cols: Sequence[str], fns) -> dict[str, tuple]:
        row = df.agg(*[fn(c).alias(f"{c}__{i}") for c in cols for i, fn in enumerate(fns)]).first()
        return {c: tuple(row[f"{c}__{i}"] for i in range(len(fns))) for c in cols}


@dataclass
class MinMaxScaler:
    """(x - min) / (max - min), then optionally sqrt or ln(. + offset)."""

    ranges: dict[str, tuple]
    post: str | None = None
    offset: float = 0.1

    @classmethod
    def fit(cls, df: DataFrame, cols: Sequence[str], post: str | None = None, offset: float = 0.1) -> "MinMaxScaler":
        return cls(Stats.of(df, cols, [F.min, F.max]), post, offset)

    def expr(self, c: str) -> Column:
        lo, hi = self.ranges[c]
        span = (hi - lo) if hi is not None and lo is not None and hi != lo else 1.0
        s = (F.col(c) - F.lit(lo)) / F.lit(span)
        if self.post == "sqrt":
            return F.sqrt(s)
        if self.post == "log":
            return F.ln(s + F.lit(self.offset))
        return s

    def transform(self, df: DataFrame) -> DataFrame:
        return df.select(*[self.expr(c).alias(c) if c in self.ranges else F.col(c) for c in df.columns])


@dataclass
class Standardizer:
    """Zero mean, unit population standard deviation (sd 0 -> divide by 1)."""

    moments: dict[str, tuple]

    @classmethod
    def fit(cls, df: DataFrame, cols: Sequence[str]) -> "Standardizer":
        return cls(Stats.of(df, cols, [F.avg, F.stddev_pop]))

    def transform(self, df: DataFrame) -> DataFrame:
        def e(c):
            mu, sd = self.moments[c]
            return (F.col(c) - F.lit(mu)) / F.lit(sd if sd else 1.0)
        return df.select(*[e(c).alias(c) if c in self.moments else F.col(c) for c in df.columns])


@dataclass
class MaxScaler:
    maxima: dict[str, tuple]

    @classmethod
    def fit(cls, df: DataFrame, cols: Sequence[str]) -> "MaxScaler":
        return cls(Stats.of(df, cols, [F.max]))

    def transform(self, df: DataFrame) -> DataFrame:
        return df.select(*[F.try_divide(F.col(c), F.lit(self.maxima[c][0])).alias(c) if c in self.maxima else F.col(c)
                           for c in df.columns])


# ------------------------------------------------------------------ one-hot

@dataclass
class OneHot:
    """0/1 column ``{col}_{value}`` per value seen at fit time (sorted); null or unseen -> all 0.

    The vocabulary (distinct values per column) is the only thing brought to the driver.
    """

    vocab: dict[str, list]
    drop_source: bool = True
    sep: str = "_"

    @classmethod
    def fit(cls, df: DataFrame, cols: Sequence[str], drop_source: bool = True, sep: str = "_") -> "OneHot":
        long = df.select(*[F.col(c).cast("string").alias(c) for c in cols]).unpivot([], list(cols), "c", "v")
        values = long.filter(F.col("v").isNotNull()).distinct()
        n = values.count()
        if n > MAX_ONEHOT_COLUMNS:
            raise ValueError(f"{n} distinct values: use sparse_onehot for high-cardinality columns")
        rows = values.collect()
        vocab: dict[str, list] = {c: [] for c in cols}
        for r in rows:
            vocab[r["c"]].append(r["v"])
        return cls({c: sorted(v) for c, v in vocab.items()}, drop_source, sep)

    def transform(self, df: DataFrame) -> DataFrame:
        keep = [F.col(c) for c in df.columns if not (self.drop_source and c in self.vocab)]
        new = []
        for c, values in self.vocab.items():
            for v in values:
                new.append(F.coalesce((F.col(c).cast("string") == F.lit(v)).cast("int"), F.lit(0)).alias(f"{c}{self.sep}{v}"))
        return df.select(*keep, *new)


# dense 0/1 columns are made up to this many values; beyond it use ``sparse_onehot``
MAX_ONEHOT_COLUMNS = 10_000


def sparse_onehot(df: DataFrame, cols: Sequence[str], fit_on: DataFrame | None = None, suffix: str = "_vec") -> DataFrame:
    """High-cardinality one-hot: value -> index by frequency (``StringIndexer``, unseen and
    null -> the extra slot), then a sparse 0/1 vector per column (``OneHotEncoder``). The
    vocabulary stays in the fitted model, not in the table's width."""
    from pyspark.ml.feature import OneHotEncoder, StringIndexer

    src = fit_on if fit_on is not None else df
    idx_cols = [f"__i_{c}" for c in cols]
    si = StringIndexer(inputCols=list(cols), outputCols=idx_cols, handleInvalid="keep",
                       stringOrderType="frequencyDesc").fit(src)
    # the indexer already maps null and unseen values to its extra index
    enc = OneHotEncoder(inputCols=idx_cols, outputCols=[f"{c}{suffix}" for c in cols], handleInvalid="error",
                        dropLast=False).fit(si.transform(src))
    return enc.transform(si.transform(df)).drop(*idx_cols)


# ------------------------------------------------------------------ imputation

def fill_mode(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Null -> most common value of the column (ties -> smallest), all columns from one pass."""
    long = df.select(*[F.col(c).cast("string").alias(c) for c in cols]).unpivot([], list(cols), "column", "value")
    modes = {r["column"]: r["mode"] for r in aggs.mode(long, "value", "column").collect()}
    types = dict((f.name, f.dataType) for f in df.schema.fields)
    return df.select(*[F.coalesce(F.col(c), F.lit(modes.get(c)).cast(types[c])).alias(c) if c in cols else F.col(c)
                       for c in df.columns])


def fill_const(df: DataFrame, values: dict) -> DataFrame:
    return df.fillna(values)


def fill_group_median(df: DataFrame, group: str, col: str) -> DataFrame:
    return joins.fill_by_group_stat(df, group, col, "median", "median_of_groups")


def fill_random(df: DataFrame, col: str, key: str, seed: int = 0) -> DataFrame:
    """Null -> integer drawn in [mean - sd, mean + sd) (sample sd). The draw u in [0, 1) is the
    first 8 hex digits of md5(seed || key) over 16^8, so it repeats under any partitioning and
    in any engine with md5."""
    mu, sd = df.agg(F.avg(col), F.stddev_samp(col)).first()
    if mu is None:
        return df
    sd = sd or 0.0
    lo, hi = mu - sd, mu + sd
    h = F.substring(F.md5(F.concat(F.lit(str(seed)), F.col(key).cast("string"))), 1, 8)
    u = F.conv(h, 16, 10).cast("double") / F.lit(float(16 ** 8))
    draw = F.floor(F.lit(lo) + u * F.lit(hi - lo))
    return df.withColumn(col, F.coalesce(F.col(col), draw.cast(df.schema[col].dataType)))


def fill_tree(df: DataFrame, target: str, features: Sequence[str], max_depth: int = 5, seed: int = 0) -> DataFrame:
    """Null in ``target`` -> prediction of a regression tree fitted on the rows where it is known."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import DecisionTreeRegressor

    va = VectorAssembler(inputCols=list(features), outputCol="__f", handleInvalid="keep")
    known = va.transform(df.filter(F.col(target).isNotNull()))
    model = DecisionTreeRegressor(featuresCol="__f", labelCol=target, maxDepth=max_depth, seed=seed).fit(known)
    pred = model.setPredictionCol("__p").transform(va.transform(df))
    return pred.withColumn(target, F.coalesce(F.col(target), F.col("__p").cast(df.schema[target].dataType))).drop("__f", "__p")


def fill_chained(df: DataFrame, cols: Sequence[str], rounds: int = 6, checkpoint: bool = True) -> DataFrame:
    """Chained-equation imputation: start from column means, then ``rounds`` times refit a
    linear regression of each incomplete column on all others (rows where it was observed)
    and refill its missing cells. Lineage is cut each round with a reliable checkpoint."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression

    cols = list(cols)
    missing = {c: f"__m_{c}" for c in cols}
    cur = df.select("*", *[F.col(c).isNull().alias(m) for c, m in missing.items()])
    means = Stats.of(df, cols, [F.avg])
    cur = cur.select(*[F.coalesce(F.col(c), F.lit(means[c][0])).alias(c) if c in cols else F.col(c) for c in cur.columns])
    todo = [c for c in cols if means[c][0] is not None]
    if todo:
        n_missing = cur.agg(*[F.sum(F.col(missing[c]).cast("long")).alias(c) for c in todo]).first().asDict()
        todo = [c for c in todo if n_missing[c]]
    if not todo:
        return cur.drop(*missing.values())
    for _ in range(rounds):
        for c in todo:
            others = [o for o in cols if o != c]
            va = VectorAssembler(inputCols=others, outputCol="__f")
            train = va.transform(cur.filter(~F.col(missing[c])))
            model = LinearRegression(featuresCol="__f", labelCol=c, regParam=0.0).fit(train)
            pred = model.setPredictionCol("__p").transform(va.transform(cur))
            cur = pred.withColumn(c, F.when(F.col(missing[c]), F.col("__p")).otherwise(F.col(c))).drop("__f", "__p")
        if checkpoint:
            cur = cut_lineage(cur)
    return cur.drop(*missing.values())

