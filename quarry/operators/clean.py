"""Projections, filters, predicates and row updates."""

from __future__ import annotations

import itertools
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions import text as tx
from quarry.operators.sequence import row_index

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def drop_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.drop(*cols)


def columns_matching(df: DataFrame, contains: str | None = None, prefix: str | None = None,
                     suffix: str | None = None) -> list[str]:
    """Names of the columns whose name contains / starts with / ends with the given text."""
    out = []
    for c in df.columns:
        if contains is not None and contains not in c:
            continue
        if prefix is not None and not c.startswith(prefix):
            continue
        if suffix is not None and not c.endswith(suffix):
            continue
        out.append(c)
    return out


def select_matching(df: DataFrame, keep: bool = True, **match) -> DataFrame:
    cols = columns_matching(df, **match)
    return df.select(*cols) if keep else df.drop(*cols)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC)]


def select_numeric(df: DataFrame) -> DataFrame:
    return df.select(*numeric_columns(df))


def null_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """One row: the number of nulls of every column, computed in one pass."""
    cols = list(cols or df.columns)
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])


def drop_nullable_columns(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Drop every column holding at least one null (one aggregate pass, one row to the driver)."""
    counts = null_counts(df, cols).first().asDict()
    return df.drop(*[c for c, n in counts.items() if n])


def reorder(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(*cols)


def product(*cols) -> Column:
    """Product of columns; a null factor gives null."""
    out = None
    for c in cols:
        x = F.col(c) if isinstance(c, str) else c
        out = x if out is None else out * x
    return out


def total(*cols) -> Column:
    out = None
    for c in cols:
        x = F.col(c) if isinstance(c, str) else c
        out = x if out is None else out + x
    return out


def pair_codes(df: DataFrame, cols: Sequence[str], encode: Callable[[Column], Column] | None = tx.base26,
               sep: str = "_") -> DataFrame:
    """For each 2-combination of ``cols``: concatenate the two values (null propagates) and
    encode; the new column is named ``a_b``. The combinations are formed on the driver from
    column names only; the values are computed in one projection."""
    new = []
    for a, b in itertools.combinations(cols, 2):
        v = F.concat(F.col(a), F.col(b))
        new.append((encode(v) if encode else v).alias(f"{a}{sep}{b}"))
    return df.select("*", *new)


def compare(c, op: str, value, keep_null_on_ne: bool = True) -> Column:
    """Predicate ``c op value``. With pandas semantics ``!=`` keeps null rows."""
    x = F.col(c) if isinstance(c, str) else c
    v = F.lit(value)
    if op in ("==", "="):
        return x == v
    if op == "!=":
        return ~x.eqNullSafe(v) if keep_null_on_ne else x != v
    return {"<": x < v, "<=": x <= v, ">": x > v, ">=": x >= v}[op]


def keep_null(df: DataFrame, col: str, null: bool = True) -> DataFrame:
    return df.filter(F.col(col).isNull() if null else F.col(col).isNotNull())


def keep_in(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    return df.filter(F.col(col).isin(list(values)))


def drop_null_rows(df: DataFrame, col: str) -> DataFrame:
    """Rows that are not null in ``col``; the dropped count is ``null_counts(df, [col])``."""
    return df.dropna(subset=[col])


def flag_nan_rows(df: DataFrame, vector_col: str, flag: str = "has_nan") -> DataFrame:
    """Mark rows whose vector holds a NaN or null; ``drop_nan_rows`` keeps the others."""
    return df.withColumn(flag, F.coalesce(F.exists(F.col(vector_col), lambda x: F.isnan(x) | x.isNull()),
                                          F.lit(True)))


def drop_nan_rows(df: DataFrame, vector_col: str) -> DataFrame:
    return flag_nan_rows(df, vector_col, "__nan").filter(~F.col("__nan")).drop("__nan")


def set_where(df: DataFrame, col: str, cond: Column, value) -> DataFrame:
    v = value if isinstance(value, Column) else F.lit(value)
    return df.withColumn(col, F.when(cond, v).otherwise(F.col(col)))


def zero_rows_where(df: DataFrame, cond: Column, cols: Sequence[str] | None = None,
                    value=0) -> DataFrame:
    """Set every listed column (default all) of matching rows to ``value`` cast to the column's type."""
    cols = set(cols or df.columns)
    types = dict((f.name, f.dataType) for f in df.schema.fields)
    return df.select(*[F.when(cond, F.lit(value).cast(types[c])).otherwise(F.col(c)).alias(c)
                       if c in cols else F.col(c) for c in df.columns])


def replace_sentinel(df: DataFrame, sentinel=-1, cols: Sequence[str] | None = None) -> DataFrame:
    """``sentinel`` -> null in every numeric column (or the listed ones)."""
    cols = set(cols or numeric_columns(df))
    return df.select(*[F.when(F.col(c) == F.lit(sentinel), None).otherwise(F.col(c)).alias(c)
                       if c in cols else F.col(c) for c in df.columns])


def flag(c, value: str, strip: bool = True) -> Column:
    """Boolean ``c == value`` after optional trimming; null -> false."""
    x = F.col(c) if isinstance(c, str) else c
    x = F.trim(x) if strip else x
    return F.coalesce(x == F.lit(value), F.lit(False))


def truthy(c) -> Column:
    """Number -> bool; null counts as true."""
    x = F.col(c) if isinstance(c, str) else c
    return F.coalesce(x != 0, F.lit(True))


def to_number(c, dtype: str = "double") -> Column:
    """Lenient cast: bad input -> null."""
    x = F.col(c) if isinstance(c, str) else c
    return x.try_cast(dtype)


def split_rows(df: DataFrame, flag_col: str = "is_train") -> tuple[DataFrame, DataFrame]:
    return df.filter(F.col(flag_col)), df.filter(~F.col(flag_col))


def holdout_tail(df: DataFrame, order: list, frac: float = 0.25, name: str = "is_holdout") -> DataFrame:
    """Flag the trailing ``frac`` of rows in ``order`` (leading int(n*(1-frac)) rows are train).

    The row position comes from a range-partitioned scan, never a one-partition window.
    """
    n = df.count()
    cut = int(n * (1 - frac))
    return row_index(df, order, "__pos").withColumn(name, F.col("__pos") >= F.lit(cut)).drop("__pos")


class DataNotClean(ValueError):
    pass


def check_clean(df: DataFrame) -> DataFrame:
    """Gate before training: every column numeric and no nulls; otherwise raise with a summary."""
    bad_types = [c for c in df.columns if c not in numeric_columns(df)]
    counts = null_counts(df).first().asDict()
    nulls = {c: n for c, n in counts.items() if n}
    if bad_types or nulls:
        raise DataNotClean(f"non-numeric columns: {bad_types}; null counts: {nulls}")
    return df


def profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """(column, type, rows, columns, count, mean, sd, min, q25, q50, q75, max) of every numeric column: the
    shape and types of the table, and what pandas ``describe`` gives (sd is the sample deviation,
    quartiles are exact and interpolated). One aggregate pass and one pass that counts values."""
    from quarry.operators.aggs import quantiles

    cols = list(cols or numeric_columns(df))
    types = dict(df.dtypes)
    aggs = [F.count("*").alias("__rows")]
    for c in cols:
        x = F.col(c).cast("double")
        aggs.append(F.struct(F.lit(c).alias("column"), F.lit(types[c]).alias("type"), F.count(x).alias("count"), F.avg(x).alias("mean"),
                             F.stddev_samp(x).alias("sd"), F.min(x).alias("min"), F.max(x).alias("max")).alias(c))
    one = df.agg(*aggs).select("__rows", F.explode(F.array(*[F.col(c) for c in cols])).alias("s"))
    q = quantiles(df, cols, [0.25, 0.5, 0.75]).groupBy("column").agg(*[F.max(F.when(F.col("p") == p, F.col("value"))).alias(f"q{round(p * 100)}") for p in (0.25, 0.5, 0.75)])
    found = one.select("s.*", F.col("__rows").alias("rows"), F.lit(len(df.columns)).alias("columns")).join(q, "column", "left")
    return found.select("column", "type", "rows", "columns", "count", "mean", "sd", "min", "q25", "q50", "q75", "max")
