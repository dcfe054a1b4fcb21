"""Aggregations. All statistics of many columns are batched into one ``agg``."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.operators.sequence import null_safe_join, running_sum


def _stack(df: DataFrame, cols: Sequence[str], keep: Sequence[str] = (), name: str = "column",
           value: str = "value", cast: str | None = "string") -> DataFrame:
    """Columns to (column, value) rows; ``keep`` columns are carried along."""
    ids = [F.col(k) for k in keep]
    vals = [F.col(c).cast(cast) if cast else F.col(c) for c in cols]
    return df.select(*ids, *[v.alias(c) for v, c in zip(vals, cols)]).unpivot(
        list(keep), list(cols), name, value)


def median(df: DataFrame, group: str | Sequence[str] | None, col: str, out: str = "median") -> DataFrame:
    """Exact median (mean of the two middle values for an even count) per group, nulls
    skipped.

    Values are counted first (so equal values and a group holding a large share of the rows are
    partial sums); a sliced running sum of the counts then finds the values that cover the middle
    positions. Nothing buffers a group in one task, as the built-in ``median`` would do. A null
    group is a group.
    """
    keys = [group] if isinstance(group, str) else list(group or [])
    vals = df.select(*keys, F.col(col).alias("__x")).filter(F.col("__x").isNotNull())
    if not keys:
        vals = vals.withColumn("__all", F.lit(0))
    k = keys or ["__all"]
    counts = vals.groupBy(*k, "__x").agg(F.count("*").alias("__c"))
    upto = running_sum(counts, ["__x"], "__c", "__upto", key=k)
    n = vals.groupBy(*k).agg(F.count("*").alias("__n"))
    mid = null_safe_join(upto, n, k).filter((F.col("__upto") > F.floor((F.col("__n") - 1) / 2))
                                            & (F.col("__upto") - F.col("__c") <= F.ceil((F.col("__n") - 1) / 2)))
    if keys:
        return mid.groupBy(*k).agg(F.avg("__x").alias(out))
    # a global aggregate: one row, null for empty input
    return mid.agg(F.avg("__x").alias(out))


def quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """``column``, ``p``, ``value``: exact quantiles of many numeric columns, interpolated linearly between
    the two nearest ranks, nulls and NaN skipped. One scan counts the values of all columns; a sliced
    running sum of the counts (per column) finds the values that cover the ranks."""
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("__x")) for c in cols])).alias("r")).select("r.*")
    counts = long.filter(F.col("__x").isNotNull() & ~F.isnan("__x")).groupBy("column", "__x").agg(F.count("*").alias("__c"))
    upto = running_sum(counts, ["__x"], "__c", "__upto", key=["column"])
    n = counts.groupBy("column").agg(F.sum("__c").alias("__n"))
    at = upto.join(F.broadcast(n), "column")  # one row a column
    place = F.explode(F.array(*[F.lit(float(p)) for p in probs]))
    at = at.select("*", place.alias("p")).withColumn("__r", F.col("p") * (F.col("__n") - 1))
    holds = lambda r: (F.col("__upto") > r) & (F.col("__upto") - F.col("__c") <= r)
    at = at.filter(holds(F.floor("__r")) | holds(F.ceil("__r")))
    ends = at.groupBy("column", "p").agg(F.max(F.when(holds(F.floor("__r")), F.col("__x"))).alias("lo"), F.max(F.when(holds(F.ceil("__r")), F.col("__x"))).alias("hi"), F.max("__r").alias("__r"))
    return ends.select("column", "p", (F.col("lo") + (F.col("hi") - F.col("lo")) * (F.col("__r") - F.floor("__r"))).alias("value"))


def mean_median(df: DataFrame, col: str) -> DataFrame:
    m = median(df, None, col).first()[0]
    return df.agg(F.avg(col).alias("mean"), F.lit(m).cast("double").alias("median"))


def group_target_mean(df: DataFrame, target: str, cols: Sequence[str]) -> DataFrame:
    """Mean of ``target`` for each value of each column, in one grouped pass."""
    long = _stack(df, cols, keep=[target])
    return long.groupBy("column", "value").agg(F.avg(target).alias("mean_target"), F.count("*").alias("n"))


def group_median(df: DataFrame, group: str | Sequence[str], col: str) -> DataFrame:
    return median(df, group, col)


def group_sum_having(df: DataFrame, group: str | Sequence[str], col: str, min_exclusive=0) -> DataFrame:
    return df.groupBy(group).agg(F.sum(col).alias("total")).filter(F.col("total") > F.lit(min_exclusive))


def value_counts(df: DataFrame, col: str) -> DataFrame:
    return df.groupBy(col).count().orderBy(F.desc("count"), F.col(col))


def frequent(df: DataFrame, col: str, cut: float = 1.0) -> DataFrame:
    """Categories whose count exceeds ``cut`` times the mean count per category."""
    counts = df.groupBy(col).count()
    mean_count = counts.agg(F.avg("count")).first()[0]
    if mean_count is None:
        return counts.limit(0)
    return counts.filter(F.col("count") > F.lit(cut * mean_count))


def mode(df: DataFrame, col: str, group: str | Sequence[str] | None = None) -> DataFrame:
    """Most common non-null value (per group); ties -> smallest value."""
    keys = [group] if isinstance(group, str) else list(group or [])
    counts = df.filter(F.col(col).isNotNull()).groupBy(*keys, col).count()
    return counts.groupBy(*keys).agg(
        F.min_by(F.col(col), F.struct(-F.col("count"), F.col(col))).alias("mode"),
        F.max("count").alias("count"))


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).distinct()


def distinct_count(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.agg(*[F.count_distinct(c).alias(c) for c in cols])


def null_report(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """(column, nulls, percent) for every column, from one aggregate pass."""
    cols = list(cols or df.columns)
    one = df.agg(F.count("*").alias("__n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    long = one.unpivot(["__n"], cols, "column", "nulls")
    return long.select("column", "nulls", F.when(F.col("__n") > 0, F.col("nulls") * 100.0 / F.col("__n")).alias("percent"))


def skewness_of(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, skew): population skewness of every column, nulls skipped, one pass."""
    one = df.agg(*[F.skewness(c).alias(c) for c in cols])
    return one.unpivot([], list(cols), "column", "skew")


def skewed_columns(df: DataFrame, cols: Sequence[str], threshold: float = 0.25) -> DataFrame:
    return skewness_of(df, cols).filter(F.col("skew") > F.lit(threshold))


def moments(df: DataFrame, group: Sequence[str], col: str) -> DataFrame:
    """Population variance, sd, skewness and excess kurtosis per group."""
    return df.groupBy(*group).agg(
        F.var_pop(col).alias("variance"), F.stddev_pop(col).alias("sd"),
        F.skewness(col).alias("skew"), F.kurtosis(col).alias("kurtosis"), F.count("*").alias("n"))


def correlation(a, b):
    """Pearson correlation of two columns over the rows that have both, as an aggregate; 0 where it is
    undefined (a constant column, NaN). Spark's own ``corr`` raises on constant columns in ANSI mode."""
    x, y = F.when(b.isNotNull(), a), F.when(a.isNotNull(), b)
    r = F.try_divide(F.covar_pop(a, b), F.sqrt(F.var_pop(x)) * F.sqrt(F.var_pop(y)))
    return F.coalesce(F.nanvl(r, F.lit(0.0)), F.lit(0.0))


def corr_matrix(df: DataFrame, cols: Sequence[str], group: Sequence[str] = ()) -> DataFrame:
    """Pearson correlation of every ordered pair of columns (per group) as long rows
    (a, b, corr); NaN/undefined -> 0, diagonal included. One aggregate for all pairs."""
    cols = list(cols)
    aggs = []
    for i, a in enumerate(cols):
        for j, b in enumerate(cols):
            if j < i:
                continue
            aggs.append(correlation(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"{i}|{j}"))
    wide = df.groupBy(*group).agg(*aggs)
    names = [f"{i}|{j}" for i in range(len(cols)) for j in range(len(cols)) if j >= i]
    long = wide.unpivot(list(group), names, "__pair", "corr")
    parts = F.split("__pair", r"\|")
    cmap = F.array(*[F.lit(c) for c in cols])
    ia, ib = parts[0].cast("int"), parts[1].cast("int")
    upper = long.select(*group, F.element_at(cmap, ia + 1).alias("a"), F.element_at(cmap, ib + 1).alias("b"), "corr")
    lower = long.filter(ia != ib).select(*group, F.element_at(cmap, ib + 1).alias("a"), F.element_at(cmap, ia + 1).alias("b"), "corr")
    return upper.unionByName(lower)


def corr_eigenvalues(corr_long: DataFrame, group: Sequence[str]) -> DataFrame:
    """Eigenvalues (real part, ascending) of each group's correlation matrix given as long
    (a, b, corr) rows. The matrix is channels x channels, so each group is small; the groups
    are spread over tasks by ``applyInPandas``."""
    group = list(group)
    schema = T.StructType([corr_long.schema[g] for g in group] + [
        T.StructField("rank", T.IntegerType()), T.StructField("eigenvalue", T.DoubleType())])

    def eig(pdf: pd.DataFrame) -> pd.DataFrame:
        names = sorted(set(pdf["a"]) | set(pdf["b"]))
        pos = {n: i for i, n in enumerate(names)}
        m = np.zeros((len(names), len(names)))
        m[pdf["a"].map(pos).to_numpy(), pdf["b"].map(pos).to_numpy()] = pdf["corr"].to_numpy()
        w = np.sort(np.real(np.linalg.eigvals(m)))
        out = pd.DataFrame({"rank": np.arange(len(w), dtype="int32"), "eigenvalue": w})
        for g in group:
            out.insert(0, g, pdf[g].iloc[0])
        return out[[*group, "rank", "eigenvalue"]]

    return corr_long.groupBy(*group).applyInPandas(eig, schema)


def argmin(df: DataFrame, group: Sequence[str], label: str, err: str) -> DataFrame:
    """Per group: the label with least error (ties -> smallest label) and the error."""
    return df.groupBy(*group).agg(F.min_by(F.col(label), F.struct(F.col(err), F.col(label))).alias("best"),
                                  F.min(err).alias("error"))


def vector_mean(df: DataFrame, group: Sequence[str], vec: str, out: str = "mean_vec") -> DataFrame:
    """Element-wise mean of array vectors per group (one row per group and position first,
    so no group's vectors are ever held together)."""
    long = df.select(*group, F.posexplode(vec).alias("__pos", "__x"))
    per = long.groupBy(*group, "__pos").agg(F.avg("__x").alias("__m"))
    return per.groupBy(*group).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("__pos", "__m"))), lambda s: s["__m"]).alias(out))


def median_of_medians(df: DataFrame, group: str, col: str) -> DataFrame:
    return median(group_median(df, group, col), None, "median", "median_of_medians")


def minmax(df: DataFrame, cols: Sequence[str], group: Sequence[str] = ()) -> DataFrame:
    aggs = []
    for c in cols:
        aggs += [F.min(c).alias(f"min_{c}"), F.max(c).alias(f"max_{c}")]
    return df.groupBy(*group).agg(*aggs)


def histogram(df: DataFrame, col: str, bins: int = 80) -> DataFrame:
    """Counts in ``bins`` equal-width bins between min and max (top edge in the last bin);
    every bin is listed, empty ones with 0."""
    lo, hi = df.agg(F.min(col), F.max(col)).first()
    spark = df.sparkSession
    idx = spark.range(bins).select(F.col("id").cast("int").alias("bin"))
    if lo is None:
        return idx.select("bin", F.lit(None).cast("double").alias("lo"), F.lit(None).cast("double").alias("hi"),
                          F.lit(0).cast("long").alias("count"))
    width = (hi - lo) / bins if hi > lo else 1.0
    b = F.least(F.floor((F.col(col) - F.lit(lo)) / F.lit(width)), F.lit(bins - 1)).cast("int")
    counts = df.filter(F.col(col).isNotNull()).groupBy(b.alias("bin")).count()
    return (F.broadcast(idx).join(counts, "bin", "left")
            .select("bin", (F.lit(lo) + F.col("bin") * F.lit(width)).alias("lo"),
                    (F.lit(lo) + (F.col("bin") + 1) * F.lit(width)).alias("hi"),
                    F.coalesce(F.col("count"), F.lit(0)).cast("long").alias("count")))


def sse(a, b) -> Column:
    """Sum of squared element differences of two arrays."""
    ca = F.col(a) if isinstance(a, str) else a
    cb = F.col(b) if isinstance(b, str) else b
    return F.aggregate(F.zip_with(ca, cb, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, v: s + v)


def positive_count(df: DataFrame, pred: str) -> DataFrame:
    return df.agg(F.count_if(F.col(pred) == 1).alias("positives"), F.count("*").alias("total"))


def positive_keys(df: DataFrame, key: str, pred: str) -> DataFrame:
    return df.filter(F.col(pred) == 1).select(key)


def crosstab(df: DataFrame, a: str, b: str, normalize: str | None = None) -> DataFrame:
    """Counts by (a, b) as long rows; ``normalize`` = 'all' | 'index' adds the share."""
    counts = df.groupBy(a, b).count()
    if normalize is None:
        return counts
    if normalize == "all":
        tot = counts.agg(F.sum("count")).first()[0] or 0
        return counts.withColumn("share", F.col("count") / F.lit(tot))
    per = counts.groupBy(a).agg(F.sum("count").alias("__tot"))
    return null_safe_join(counts, per, [a]).withColumn("share", F.col("count") / F.col("__tot")).drop("__tot")


def group_size_where_null(df: DataFrame, key: str, null_col: str) -> DataFrame:
    """Rows per key among rows null in ``null_col``, and the largest such count."""
    per = df.filter(F.col(null_col).isNull()).groupBy(key).count()
    return per.agg(F.count("*").alias("keys"), F.max("count").alias("max_count"))
