"""Window and ordered-row operators.

Per-key scans over unbounded history use ``sequence.ordered_scan`` (range slices, so a hot
key is not one task). Bounded per-key limits (first / last n) use ``row_number() <= n``, which
Spark plans with a partial group limit before the shuffle. Windows inside an epoch are bounded
by the epoch length and use plain ``Window``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions.numeric import left_pad
from quarry.operators.sequence import Scan, null_safe_join, ordered_scan, previous_row, row_index


def _cols(order):
    return [F.col(o) if isinstance(o, str) else o for o in order]


def diff_new(df: DataFrame, key: Sequence[str], order: Sequence, cols: Sequence[str],
             suffix: str = "_new") -> DataFrame:
    """For each flag column: max(value - previous value of the same key, 0); the first row of
    a key gives 0 (the previous value is taken as equal)."""
    prev = previous_row(df, list(key), list(order), list(cols), prefix="__p_")
    out = prev
    for c in cols:
        d = F.col(c) - F.col(f"__p_{c}")
        out = out.withColumn(c + suffix, F.coalesce(F.greatest(d, F.lit(0)), F.lit(0)))
    return out.drop(*[f"__p_{c}" for c in cols])


def first_last_n(df: DataFrame, key: Sequence[str], order: Sequence, n: int = 5, last: bool = False,
                 rank_col: str | None = None) -> DataFrame:
    """The first (or last) n rows of each key in ``order``."""
    o = _cols(order)
    if last:
        o = [c.desc() for c in o]
    w = Window.partitionBy(*key).orderBy(*o)
    rn = rank_col or "__rn"
    out = df.withColumn(rn, F.row_number().over(w)).filter(F.col(rn) <= n)
    return out if rank_col else out.drop(rn)


def lag_vector(df: DataFrame, key: Sequence[str], order: Sequence[str], vec: str, n: int, width: int,
               last: bool = False, out: str = "lags") -> DataFrame:
    """Per key: the ``vec`` arrays of its first (or last) n rows in time order, flattened and
    left-padded with zeros to n * width values."""
    rows = first_last_n(df, key, order, n, last)
    packed = rows.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct(*[F.col(o) for o in order], F.col(vec).alias("__v")))).alias("__rows"))
    flat = F.flatten(F.transform(F.col("__rows"), lambda r: r["__v"]))
    return packed.select(*key, left_pad(flat, n * width, 0).alias(out))


def cumsum(df: DataFrame, order: Sequence, col: str, out: str, key: Sequence[str] = ()) -> DataFrame:
    """Running sum along ``order`` (within ``key`` if given), no one-partition window."""
    return ordered_scan(df, list(key), list(order), [Scan(out, "sum", F.col(col), True)])


def gini(df: DataFrame, y: str, p: str, tie: str, group: Sequence[str] = ()) -> DataFrame:
    """1 - 2 * S / (pos * neg), S = sum over positives of the negatives ranked above them.

    Rows are walked from the highest ``p`` (ties: higher ``tie`` first). The walk is a
    sliced running count (``sequence.ordered_scan``), so no single task sorts all rows. One row per group;
    null when a group has only one class.
    """
    neg = (F.lit(1) - F.col(y)).cast("long")
    walk = ordered_scan(df.select(*group, y, p, tie), list(group), [p, tie],
                        [Scan("__neg_above", "sum", neg, current=False)], descending=True)
    agg = walk.groupBy(*group).agg(F.sum(F.col(y) * F.col("__neg_above")).alias("__s"),
                                   F.sum(y).alias("__pos"), F.count("*").alias("__n"))
    den = F.col("__pos") * (F.col("__n") - F.col("__pos"))
    return agg.select(*group, F.when(den > 0, F.lit(1.0) - F.lit(2.0) * F.col("__s") / den).alias("gini"))


def gini_normalized(df: DataFrame, y: str, p: str, tie: str, group: Sequence[str] = ()) -> DataFrame:
    """gini(y, p) / gini(y, y)."""
    keys = list(group) or ["__all"]
    if not group:
        df = df.withColumn("__all", F.lit(0))
    g = gini(df, y, p, tie, keys)
    gy = gini(df.withColumn("__yy", F.col(y).cast("double")), y, "__yy", tie, keys).withColumnRenamed("gini", "__gy")
    j = g.join(gy, on=keys, how="inner")
    return j.select(*group, F.when(F.col("__gy") != 0, F.col("gini") / F.col("__gy")).alias("gini_norm"),
                    F.col("gini"))


def epochs_by_time(df: DataFrame, ts: str, length: str = "60 seconds", out: str = "epoch") -> DataFrame:
    """Tumbling epochs by time: ``epoch`` = window start."""
    return df.withColumn(out, F.window(F.col(ts), length).start)


def epochs_by_position(df: DataFrame, key: Sequence[str], order: Sequence, size: int, out: str = "epoch",
                       full_only: bool = True) -> DataFrame:
    """Non-overlapping epochs of ``size`` consecutive samples per key; the incomplete tail is
    dropped when ``full_only``. Also gives the sample position ``seq`` inside the epoch."""
    pos = row_index(df, list(order), "__pos", key=list(key))
    pos = pos.withColumn(out, F.floor(F.col("__pos") / size).cast("long")).withColumn("seq", (F.col("__pos") % size).cast("long"))
    if full_only:
        n = df.groupBy(*key).agg(F.count("*").alias("__n"))
        pos = null_safe_join(pos, n, list(key)).filter(F.col(out) < F.floor(F.col("__n") / size)).drop("__n")
    return pos.drop("__pos")


def hjorth(df: DataFrame, group: Sequence[str], order: Sequence, col: str,
           mobility_scope: str = "channel") -> DataFrame:
    """Hjorth activity, mobility and complexity per group (a channel's epoch).

    mobility = sd(diff) / sd(x); complexity = sd(diff of diff) / sd(diff) / mobility,
    population sd. ``mobility_scope='global'`` takes sd(diff) over all groups that share the
    leading group columns except the last (the channel), as the source's axis-less std does.
    """
    w = Window.partitionBy(*group).orderBy(*_cols(order))
    d1 = df.withColumn("__d1", F.col(col) - F.lag(col).over(w))
    d2 = d1.withColumn("__d2", F.col("__d1") - F.lag("__d1").over(w))
    agg = d2.groupBy(*group).agg(F.var_pop(col).alias("activity"), F.stddev_pop(col).alias("__sx"),
                                 F.stddev_pop("__d1").alias("__s1"), F.stddev_pop("__d2").alias("__s2"))
    if mobility_scope == "global":
        outer = list(group)[:-1]
        if not outer:
            d2, agg, outer = d2.withColumn("__all", F.lit(0)), agg.withColumn("__all", F.lit(0)), ["__all"]
        g = d2.groupBy(*outer).agg(F.stddev_pop("__d1").alias("__s1g"))
        agg = agg.join(g, on=outer, how="left")
        mob = F.try_divide(F.col("__s1g"), F.col("__sx"))
    else:
        mob = F.try_divide(F.col("__s1"), F.col("__sx"))
    agg = agg.withColumn("mobility", mob)
    agg = agg.withColumn("complexity", F.try_divide(F.try_divide(F.col("__s2"), F.col("__s1")), F.col("mobility")))
    return agg.select(*group, "activity", "mobility", "complexity")


def skip_head(df: DataFrame, key: Sequence[str], order: Sequence, n: int) -> DataFrame:
    """Drop the first n rows of every key."""
    return row_index(df, list(order), "__pos", key=list(key)).filter(F.col("__pos") >= n).drop("__pos")


def slice_spacing(df: DataFrame, key: Sequence[str], z: str, fallback: str | None = None,
                  out: str = "spacing", index: str | None = None, few: int = 0) -> DataFrame:
    """Per key: |z of first slice - z of second slice| in z order (fallback column when z gives
    null); attached to every row of the key. ``index``: a column of places from 0 in z order that the
    rows have already, so that they are not ordered again (without ``fallback`` only, which orders equal z).
    Spacings of at most ``few`` keys are broadcast."""
    if index is not None and fallback is None:
        two = df.where(F.col(index) < 2).withColumn("__rn", F.col(index) + 1)
    else:
        two = first_last_n(df, key, [z] + ([fallback] if fallback else []), 2, rank_col="__rn")
    cols = [F.max(F.when(F.col("__rn") == i, F.col(z))).alias(f"__z{i}") for i in (1, 2)]
    if fallback:
        cols += [F.max(F.when(F.col("__rn") == i, F.col(fallback))).alias(f"__f{i}") for i in (1, 2)]
    per = two.groupBy(*key).agg(*cols)
    sp = F.abs(F.col("__z1") - F.col("__z2"))
    if fallback:
        sp = F.coalesce(sp, F.abs(F.col("__f1") - F.col("__f2")))
    per = per.select(*key, sp.alias(out))
    if index is not None and fallback is None and few and per.limit(few + 1).count() <= few:
        per = F.broadcast(per)
    return df.join(per, on=list(key), how="left")


def block_profile(df: DataFrame, group: Sequence[str], t: str, col: str, blocks: int = 100) -> DataFrame:
    """Spread over channels per time step (population sd), cut in ``blocks`` equal blocks,
    mean over blocks at each offset. ``t`` is the 0-based sample index."""
    spread = df.groupBy(*group, t).agg(F.stddev_pop(col).alias("__sd"))
    n = spread.groupBy(*group).agg(F.max(t).alias("__tmax"))
    j = spread.join(n, on=list(group))
    block_len = F.floor((F.col("__tmax") + 1) / blocks)
    j = j.filter(F.col(t) < block_len * blocks).withColumn("offset", (F.col(t) % block_len).cast("long"))
    return j.groupBy(*group, "offset").agg(F.avg("__sd").alias("mean_spread"))


def fold_contiguous(df: DataFrame, order: Sequence, k: int, out: str = "fold", key: Sequence[str] = ()) -> DataFrame:
    """k contiguous folds in ``order`` (within ``key``); the first n mod k folds get one row more."""
    pos = row_index(df, list(order), "__pos", key=list(key))
    if key:
        n = df.groupBy(*key).agg(F.count("*").alias("__n"))
        pos = null_safe_join(pos, n, list(key))
    else:
        pos = pos.withColumn("__n", F.lit(df.count()))
    q = F.floor(F.col("__n") / k)
    r = F.col("__n") % k
    edge = r * (q + 1)
    fold = F.when(F.col("__pos") < edge, F.floor(F.col("__pos") / (q + 1))).otherwise(
        r + F.floor((F.col("__pos") - edge) / q))
    return pos.withColumn(out, fold.cast("int")).drop("__pos", "__n")


def hash_order(key: str, seed: str) -> Column:
    """A repeatable shuffled order: md5 of seed and key (same in any SQL engine with md5)."""
    return F.md5(F.concat(F.lit(seed), F.col(key).cast("string")))


def fold_stratified(df: DataFrame, label: str, key: str, k: int, seed: str = "0", out: str = "fold") -> DataFrame:
    """k folds with class shares kept: rows of each class in shuffled order (md5 of seed and
    key) cut in k contiguous folds."""
    return fold_contiguous(df.withColumn("__h", hash_order(key, seed)), ["__h", key], k, out, key=[label]).drop("__h")


def batches(df: DataFrame, order: Sequence, size: int = 32, out: str = "batch") -> DataFrame:
    """Numbered batches of ``size`` rows in ``order``."""
    return row_index(df, list(order), "__pos").withColumn(out, F.floor(F.col("__pos") / size).cast("long")).drop("__pos")
