"""Set operations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stack_by_name(first: DataFrame, second: DataFrame, flag: str = "is_train") -> DataFrame:
    """Stack two tables by column name; columns missing on one side are null; ``flag`` marks
    rows of the first table."""
    return first.withColumn(flag, F.lit(True)).unionByName(second.withColumn(flag, F.lit(False)),
                                                           allowMissingColumns=True)


def mask_uncommon(df: DataFrame, flag: str, cols: Sequence[str]) -> DataFrame:
    """For each column whose value set differs between flagged and unflagged rows, values not
    present in both become null. The value sets of all columns come from one grouped pass."""
    long = df.select(flag, *[F.col(c).cast("string").alias(c) for c in cols]).unpivot([flag], list(cols), "__col", "__val")
    per = long.filter(F.col("__val").isNotNull()).groupBy("__col", "__val").agg(
        F.max(F.col(flag).cast("int")).alias("__a"), F.max((~F.col(flag)).cast("int")).alias("__b"))
    per = per.withColumn("__both", (F.col("__a") == 1) & (F.col("__b") == 1))
    differ = per.groupBy("__col").agg(F.bool_or(~F.col("__both")).alias("__differs"))
    keep = per.join(differ, "__col").filter(F.col("__both") | ~F.col("__differs")).select("__col", "__val")
    out = df
    for c in cols:
        k = keep.filter(F.col("__col") == c).select(F.col("__val").alias(f"__k_{c}"))
        out = out.join(k, F.col(c).cast("string") == F.col(f"__k_{c}"), "left")
        out = out.withColumn(c, F.when(F.col(f"__k_{c}").isNotNull(), F.col(c))).drop(f"__k_{c}")
    return out


def latest_per_key(df: DataFrame, key: Sequence[str], batch: str) -> DataFrame:
    """Merge keyed results: for each key the row of the latest ``batch`` wins. A grouped
    ``max_by`` (partial aggregation before the shuffle), so a hot key costs no single task."""
    others = [c for c in df.columns if c not in set(key)]
    packed = F.struct(*[F.col(c) for c in others])
    agg = df.groupBy(*key).agg(F.max_by(packed, F.col(batch)).alias("__row"))
    return agg.select(*key, *[F.col("__row")[c].alias(c) for c in others])


def side_by_side(left: DataFrame, right: DataFrame, on: str | Sequence[str], how: str = "inner") -> DataFrame:
    """Attach column blocks of two keyed tables."""
    return left.join(right, on=on, how=how)
