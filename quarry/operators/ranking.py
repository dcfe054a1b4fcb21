"""Sorts, top-k, sampling and splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.numeric import top_k_indices


def sort(df: DataFrame, cols: Sequence, ascending: bool | Sequence[bool] = True) -> DataFrame:
    return df.orderBy(*cols, ascending=ascending)


def top_values(df: DataFrame, col: str, n: int = 10, min_count: int | None = None) -> DataFrame:
    """The n most frequent non-null values (ties by value), optionally only those seen at least
    ``min_count`` times. A bounded table of at most n rows."""
    counts = df.filter(F.col(col).isNotNull()).groupBy(col).count()
    if min_count is not None:
        counts = counts.filter(F.col("count") >= min_count)
    return counts.orderBy(F.desc("count"), F.col(col)).limit(n)


def keep_top_n(df: DataFrame, col: str, n: int = 10, other: str = "Rare", min_count: int | None = None,
               out: str | None = None) -> DataFrame:
    """Values among the n most frequent stay; all others, null included, become ``other``."""
    out = out or col
    top = top_values(df, col, n, min_count).select(F.col(col).alias("__top"))
    j = df.join(F.broadcast(top), F.col(col) == F.col("__top"), "left")  # at most n rows
    return j.withColumn(out, F.when(F.col("__top").isNotNull(), F.col(col).cast("string")).otherwise(F.lit(other))).drop("__top")


def top_k_names(scores, names: Sequence[str], k: int = 8, sep: str = " ") -> Column:
    """Names of the k highest scores of an array column, best first, joined by ``sep``;
    ties -> lower index first."""
    arr = F.array(*[F.lit(n) for n in names])
    idx = top_k_indices(scores, k)
    return F.array_join(F.transform(idx, lambda i: F.element_at(arr, i + 1)), sep)


def best(df: DataFrame, key: str, value: str, group: Sequence[str] = ()) -> DataFrame:
    """The key with the largest value (ties -> largest key) and that value."""
    return df.groupBy(*group).agg(F.max_by(F.col(key), F.struct(F.col(value), F.col(key))).alias(key),
                                  F.max(value).alias(value))


def hash_order(key: str, seed: str = "0") -> Column:
    return F.md5(F.concat(F.lit(seed), F.col(key).cast("string")))


def sample_random(df: DataFrame, key: str, n: int, seed: str = "0") -> DataFrame:
    """n rows in a repeatable shuffled order (md5 of seed and key)."""
    return df.orderBy(hash_order(key, seed), F.col(key)).limit(n)


def split_flag(key: str, frac: float, seed: str = "0") -> Column:
    """True for about ``frac`` of the keys: the first 8 hex digits of md5(seed || key) fall
    below frac * 16^8. Stable under repartitioning and reproducible in any SQL engine."""
    cut = format(int(round(frac * 16 ** 8)), "08x")
    return F.substring(hash_order(key, seed), 1, 8) < F.lit(cut)


def split(df: DataFrame, key: str, frac: float, seed: str = "0") -> tuple[DataFrame, DataFrame]:
    """(train, test): test is about ``frac`` of the keys."""
    f = split_flag(key, frac, seed)
    return df.filter(~f), df.filter(f)
