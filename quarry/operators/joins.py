"""Joins, lookups, membership tests and the as-of snapshot.

Broadcast hints are given only to sides whose size is bounded by a parameter (n sampled keys,
a top-n table, one row per range slice). Every other join is left to Catalyst and AQE, which
broadcast at plan or run time when the measured size is under
``spark.sql.autoBroadcastJoinThreshold`` and otherwise shuffle, splitting skewed partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.operators.sequence import Scan, ordered_scan, row_index

# largest key list that is broadcast as a hint; above it the join shuffles
BROADCAST_ROWS = 200_000


def keep_categories(df: DataFrame, kept: DataFrame, on: str | Sequence[str], drop: Sequence[str] = ("count",)) -> DataFrame:
    """Inner join to the kept categories; helper columns of the category table are dropped."""
    return df.join(kept, on=on, how="inner").drop(*[c for c in drop if c in kept.columns])


def sample_keys(df: DataFrame, key: str, n: int, seed: str = "0") -> DataFrame:
    """n distinct keys in a repeatable pseudo-random order: smallest md5(seed || key)."""
    keys = df.select(key).distinct()
    return keys.orderBy(F.md5(F.concat(F.lit(seed), F.col(key).cast("string"))), F.col(key)).limit(n)


def keep_sampled_keys(df: DataFrame, key: str, n: int, seed: str = "0") -> DataFrame:
    """All rows of n sampled distinct keys."""
    keys = sample_keys(df, key, n, seed)
    if n <= BROADCAST_ROWS:
        keys = F.broadcast(keys)
    return df.join(keys, on=key, how="left_semi")


def keep_allowed(df: DataFrame, allow: DataFrame, on: str | Sequence[str], cond: Column | None = None) -> DataFrame:
    """Rows whose key is in the allow list (optionally the allow rows that satisfy ``cond``)."""
    if cond is not None:
        allow = allow.filter(cond)
    return df.join(allow, on=on, how="left_semi")


def drop_known(df: DataFrame, known: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows whose key is not in ``known`` (anti join)."""
    return df.join(known, on=on, how="left_anti")


def exists_flag(df: DataFrame, keys: DataFrame, on: str, name: str = "flag") -> DataFrame:
    """0/1 column: is the row's key in ``keys``."""
    k = keys.select(F.col(on)).distinct().withColumn("__hit", F.lit(1))
    return df.join(k, on=on, how="left").withColumn(name, F.coalesce(F.col("__hit"), F.lit(0))).drop("__hit")


def lookup(df: DataFrame, dim: DataFrame, on: str | Sequence[str], how: str = "left") -> DataFrame:
    """Attach dimension columns by key."""
    return df.join(dim, on=on, how=how)


def index_dimension(dim: DataFrame, code: str, index: str = "idx") -> DataFrame:
    """Code -> dense 0-based index in code order (a code table is small by nature)."""
    return row_index(dim.select(code).distinct(), [code], index)


def map_codes(df: DataFrame, mapping: DataFrame, col: str, out: str | None = None,
              missing_value: str = "-99", strict: bool = True) -> DataFrame:
    """Value -> code through a (column, value, code) mapping table.

    Blank or 'NA' values use the mapping row whose value is ``missing_value``. A value with no
    mapping row fails the job when ``strict`` (raised on the executor, no extra pass), else
    gives null.
    """
    out = out or f"{col}_code"
    m = mapping.filter(F.col("column") == F.lit(col)).select(F.col("value").alias("__val"), F.col("code").alias("__code"))
    t = F.trim(F.col(col).cast("string"))
    v = F.when(t.isNull() | (t == "") | (t == "NA"), F.lit(missing_value)).otherwise(t)
    j = df.withColumn("__val", v).join(m, on="__val", how="left")
    code = F.col("__code")
    if strict:
        code = F.when(code.isNull(), F.raise_error(F.concat(F.lit(f"no code for {col}="), F.col("__val")))).otherwise(code)
    return j.withColumn(out, code).drop("__val", "__code")


def left_default(df: DataFrame, other: DataFrame, on: str, col: str, default: Column) -> DataFrame:
    """Left lookup; a missing match gets ``default``."""
    return df.join(other.select(on, col), on=on, how="left").withColumn(col, F.coalesce(F.col(col), default))


def restore_dropped(keys: DataFrame, preds: DataFrame, on: str, col: str, default=0) -> DataFrame:
    """Put predictions back on the full key list; keys without one get ``default``."""
    return keys.join(preds.select(on, col), on=on, how="left").withColumn(col, F.coalesce(F.col(col), F.lit(default)))


def full_coalesce(left: DataFrame, right: DataFrame, on: str, cols: Sequence[str]) -> DataFrame:
    """Full outer join; for each column the left value wins, the right fills its nulls."""
    l_ = left.select(on, *[F.col(c).alias(f"__l_{c}") for c in cols])
    r_ = right.select(on, *[F.col(c).alias(f"__r_{c}") for c in cols])
    j = l_.join(r_, on=on, how="full")
    return j.select(on, *[F.coalesce(F.col(f"__l_{c}"), F.col(f"__r_{c}")).alias(c) for c in cols])


def fill_by_group_stat(df: DataFrame, group: str, col: str, stat: str = "median",
                       fallback: str = "median_of_groups") -> DataFrame:
    """Null in ``col`` -> the statistic of the row's group; a group with no value -> the median
    of the group statistics (or the global statistic)."""
    from quarry.operators.aggs import median
    if stat == "median":
        stats = median(df, group, col, "__g")
    else:
        stats = df.groupBy(group).agg(F.avg(col).alias("__g"))
    if fallback == "median_of_groups":
        fbv = median(stats, None, "__g", "__fb").first()["__fb"]
    elif stat == "median":
        fbv = median(df, None, col, "__fb").first()["__fb"]
    else:
        fbv = df.agg(F.avg(col)).first()[0]
    # fbv: one statistic on the driver
    j = df.join(stats, on=group, how="left")
    return j.withColumn(col, F.coalesce(F.col(col), F.col("__g"), F.lit(fbv))).drop("__g")


def asof_snapshot(left: DataFrame, right: DataFrame, key: str, left_ts: str, right_ts: str,
                  value_col: str, out: str | None = None, inclusive: bool = False,
                  slice_rows: int | None = None) -> DataFrame:
    """For each left row, ``value_col`` of the latest right row of the same key with
    ``right_ts < left_ts`` (``<=`` when ``inclusive``); null when there is none.

    Both sides are stacked and scanned per key in time order; a key holding a large share of
    the rows is cut into time slices handled by separate tasks, the carried value crossing
    slice boundaries through a per-(key, slice) summary (see ``sequence.ordered_scan``). Right rows sort before
    left rows at equal time when ``inclusive``, after them otherwise. Among right rows with the
    same time the later one by ``__rid``, in its own type's order, wins (input order is not meaningful; pass a tie column
    in ``right`` named ``__rid`` to control it, default the value itself).
    """
    out = out or value_col
    lcols = left.columns
    l_ = left.select(*[F.col(c) for c in lcols], F.col(key).alias("__k"), F.col(left_ts).alias("__t"),
                     F.lit(1 if inclusive else 0).alias("__side"), F.lit(None).alias("__rid"),
                     F.lit(None).alias("__v").cast(right.schema[value_col].dataType), F.lit(True).alias("__isleft"))
    tie = F.col("__rid") if "__rid" in right.columns else F.col(value_col)
    r_ = right.select(F.col(key).alias("__k"), F.col(right_ts).alias("__t"),
                      F.lit(0 if inclusive else 1).alias("__side"), tie.alias("__rid"),
                      F.col(value_col).alias("__v"), F.lit(False).alias("__isleft"))
    # a null key equals nothing: such left rows get null without taking part, such right rows go
    stacked = l_.filter(F.col("__k").isNotNull()).unionByName(r_.filter(F.col("__k").isNotNull()), allowMissingColumns=True)
    scanned = ordered_scan(stacked, ["__k"], ["__t", "__side", "__rid"],
                           [Scan("__snap", "last", F.col("__v"), current=False)], slice_rows=slice_rows)
    keyless = left.filter(F.col(key).isNull()).select(*lcols, F.lit(None).cast(right.schema[value_col].dataType).alias(out))
    return scanned.filter(F.col("__isleft")).select(*lcols, F.col("__snap").alias(out)).unionByName(keyless)


def match_on_grid(items: DataFrame, library: DataFrame, item_key: str, ref_key: str, grid: str, value: str,
                  out: str = "sse") -> DataFrame:
    """Sum of squared differences of every item against every library entry over a shared
    grid: an equi-join on the grid index, then a sum per (item, ref).

    Both sides are long tables (key, grid, value). Each item point meets one point per
    library entry, so the work is items x library size: meant for a reference library (a
    few pure spectra, one mean vector per class). The library is broadcast only when its row
    count is under ``BROADCAST_ROWS``; otherwise both sides shuffle on the grid index.
    """
    lib = library.select(F.col(ref_key), F.col(grid), F.col(value).alias("__ly"))
    if lib.count() <= BROADCAST_ROWS:
        lib = F.broadcast(lib)
    j = items.select(F.col(item_key), F.col(grid), F.col(value).alias("__iy")).join(lib, grid)
    d = F.col("__iy") - F.col("__ly")
    return j.groupBy(item_key, ref_key).agg(F.sum(d * d).alias(out))
