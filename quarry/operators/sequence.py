"""Ordered scans that stay distributed when one key holds a large share of the rows.

A plain ``Window.partitionBy(key).orderBy(ts)`` sends every row of a key to one task. Where a
key has more than ``slice_rows`` rows, the table is cut by ranges of the whole (key, order) tuple
into slices of about ``slice_rows`` rows (``repartitionByRange``; the slice numbers are written
with the rows to the shared checkpoint folder, so a lost executor cannot renumber them). Each
(key, slice) is scanned with an ordinary window; what a slice needs from the earlier slices of its
key (a running total, the last non-null value) comes from a summary of the keys that lie in more
than one slice, about one row a slice. Where no key is that large a slice would hold whole keys,
and one plain window per key does the same.

Ranges compare like the windows do, whatever the types: null first, NaN last, text by all its
bytes. Null keys are a key. Only rows that are equal in key and all order columns stay together.
The driver gets two numbers, the rows of the largest key and of the table.

With no key the whole table is one "key": a global row index or running sum without a
one-partition window.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.session import staged

# rows of one key scanned by one task before the key is split into slices
SLICE_ROWS = 1_000_000


@dataclass(frozen=True)
class Scan:
    """One scan output column.

    kind: ``sum`` (running sum of ``expr``) or ``last`` (last non-null ``expr``).
    current: include the current row (``True``) or only rows strictly before it.
    """

    out: str
    kind: str
    expr: Column
    current: bool = True


def null_safe_join(df: DataFrame, stats: DataFrame, keys: list[str], how: str = "inner", small: bool = False) -> DataFrame:
    """``df`` with the other columns of ``stats``, matched on ``keys``; null keys match each other.
    ``small``: the caller has bounded ``stats``, broadcast it."""
    other = stats.withColumnsRenamed({k: f"__on_{i}" for i, k in enumerate(keys)})
    on = [F.col(f"`{k}`").eqNullSafe(F.col(f"__on_{i}")) for i, k in enumerate(keys)]
    return df.join(F.broadcast(other) if small else other, on, how).drop(*[f"__on_{i}" for i in range(len(keys))])


def _slices(df: DataFrame, key: list[str], order: list[Column], slice_rows: int) -> DataFrame | None:
    """Add ``__slice``, the range of the (key, order) tuple that a row lies in, or return None when
    no key has more than ``slice_rows`` rows (then one window per key is enough)."""
    per_key = df.groupBy(*key).agg(F.count("*").alias("__n"))
    most, total = per_key.agg(F.max("__n"), F.sum("__n")).first()
    if not most or most <= slice_rows:
        return None
    ranged = df.repartitionByRange(max(2, -(-total // slice_rows)), *[F.col(k) for k in key], *order)
    return staged(ranged.withColumn("__slice", F.spark_partition_id()), "scan")


def ordered_scan(df: DataFrame, key: list[str], order: list, scans: list[Scan], descending: bool = False,
                 slice_rows: int | None = None) -> DataFrame:
    """Add running sums / carried last values along ``order`` within each ``key`` (or globally).

    ``order``: column names (or Columns for the window) ascending, all reversed when
    ``descending``. They must order the rows of one key totally (add a unique tie-break
    column) for a deterministic result. ``slice_rows``: rows of one key handled by one task.
    """
    slice_rows = slice_rows or SLICE_ROWS
    names = [o for o in order]
    cols = [F.col(o) if isinstance(o, str) else o for o in names]
    wcols = [c.desc() if descending else c.asc() for c in cols]
    base = df
    for i, s in enumerate(scans):
        base = base.withColumn(f"__v{i}", s.expr)
    sliced = _slices(base, key, wcols, slice_rows)
    key_cols = [F.col(k) for k in key]

    if sliced is None:
        # no hot key: one window per key holds every row of the key in one task safely
        w = Window.partitionBy(*key_cols).orderBy(*wcols)
        out = base
        for i, s in enumerate(scans):
            frame = w.rowsBetween(Window.unboundedPreceding, 0 if s.current else -1)
            v = F.col(f"__v{i}")
            if s.kind == "sum":
                out = out.withColumn(s.out, F.coalesce(F.sum(v).over(frame), F.lit(0)))
            elif s.kind == "last":
                out = out.withColumn(s.out, F.last(v, ignorenulls=True).over(frame))
            else:
                raise ValueError(f"unknown scan kind {s.kind}")
        return out.drop(*[f"__v{i}" for i in range(len(scans))])

    w_in = Window.partitionBy(*key_cols, F.col("__slice")).orderBy(*wcols)
    summary_aggs = []
    for i, s in enumerate(scans):
        frame = w_in.rowsBetween(Window.unboundedPreceding, 0 if s.current else -1)
        v = F.col(f"__v{i}")
        if s.kind == "sum":
            sliced = sliced.withColumn(f"__l{i}", F.sum(v).over(frame))
            summary_aggs.append(F.sum(v).alias(f"__t{i}"))
        elif s.kind == "last":
            sliced = sliced.withColumn(f"__l{i}", F.last(v, ignorenulls=True).over(frame))
            pick = F.min_by if descending else F.max_by
            summary_aggs.append(pick(v, F.when(v.isNotNull(), F.struct(*cols))).alias(f"__t{i}"))
        else:
            raise ValueError(f"unknown scan kind {s.kind}")

    # what a slice hands on to the later slices of its key, for the keys that lie in several: at
    # most the first and the last key of a slice, so about rows / slice_rows rows, broadcast below
    summary = sliced.groupBy(*key_cols, F.col("__slice")).agg(*summary_aggs)
    if key:
        summary = summary.withColumn("__spans", F.count("*").over(Window.partitionBy(*key_cols))).filter(F.col("__spans") > 1)
    w_sl = Window.partitionBy(*key_cols).orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    carry_cols = []
    for i, s in enumerate(scans):
        if s.kind == "sum":
            carry_cols.append(F.sum(f"__t{i}").over(w_sl).alias(f"__c{i}"))
        else:
            carry_cols.append(F.last(f"__t{i}", ignorenulls=True).over(w_sl).alias(f"__c{i}"))
    carry = summary.select(*key_cols, F.col("__slice"), *carry_cols)

    out = null_safe_join(sliced, carry, [*key, "__slice"], "left", small=True)
    for i, s in enumerate(scans):
        loc, car = F.col(f"__l{i}"), F.col(f"__c{i}")
        if s.kind == "sum":
            # an empty frame (first row, current excluded) has a null local sum
            val = F.coalesce(loc, F.lit(0)) + F.coalesce(car, F.lit(0))
        else:
            val = F.coalesce(loc, car)
        out = out.withColumn(s.out, val)
    drop = ["__slice"] + [f"__{p}{i}" for i in range(len(scans)) for p in "vltc"]
    return out.drop(*drop)


def row_index(df: DataFrame, order: list, name: str = "row_idx", key: list[str] | None = None,
              descending: bool = False, slice_rows: int | None = None) -> DataFrame:
    """0-based position of each row in ``order`` (within ``key`` when given)."""
    return ordered_scan(df, key or [], order, [Scan(name, "sum", F.lit(1).cast("long"), current=False)],
                        descending, slice_rows)


def running_sum(df: DataFrame, order: list, col: str | Column, name: str, key: list[str] | None = None,
                current: bool = True, descending: bool = False, slice_rows: int | None = None) -> DataFrame:
    expr = F.col(col) if isinstance(col, str) else col
    return ordered_scan(df, key or [], order, [Scan(name, "sum", expr, current)], descending, slice_rows)


def previous_row(df: DataFrame, key: list[str], order: list, cols: list[str], prefix: str = "prev_",
                 slice_rows: int | None = None) -> DataFrame:
    """Values of ``cols`` on the previous row of the same key (null for the first row)."""
    packed = F.struct(*[F.col(c).alias(c) for c in cols])
    out = ordered_scan(df, key, order, [Scan("__prev", "last", packed, current=False)], slice_rows=slice_rows)
    for c in cols:
        out = out.withColumn(prefix + c, F.col("__prev").getField(c))
    return out.drop("__prev")
