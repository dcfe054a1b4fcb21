"""Numeric, date and array column functions."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------- numbers

def log_shift(c, shift: float = 200.0) -> Column:
    return F.ln(_c(c) + F.lit(shift))


def exp_unshift(c, shift: float = 200.0) -> Column:
    return F.exp(_c(c)) - F.lit(shift)


def power_clip(c, a: float, b: float, p: float = 0.25) -> Column:
    """(max(x - a, 0) / b) ** p"""
    return F.pow(F.greatest(_c(c) - F.lit(a), F.lit(0.0)) / F.lit(b), F.lit(p))


def round_exact(c, digits: int) -> Column:
    """Round a double to ``digits`` places as Python's ``round`` does: the exact binary value is
    rounded, half-even only on exact ties.

    ``bround`` decides on the shortest decimal text of the double, which differs when that text
    ends in 5 but the binary value lies just below or above it. Those cases are settled by an
    exact integer comparison of x = m * 2^e with the decimal midpoint, in decimal(38, 0).
    """
    x = _c(c).cast("double")
    ax = F.abs(x)
    scaled = ax.cast("decimal(38,18)") * F.lit(10 ** digits)
    fl = F.floor(scaled)
    text_tie = (scaled - fl) == F.lit(0.5)
    e = (F.floor(F.log2(ax)) - 54).cast("int")
    m = (ax / F.pow(F.lit(2.0), e)).cast("long").cast("decimal(38,0)")
    lhs = m * F.lit(2 * 10 ** digits).cast("decimal(38,0)")
    # 2^(-e) exactly as a product of two longs (a double -> decimal cast would go through
    # the double's shortest text and drop digits)
    a = F.least(-e, F.lit(62))
    p2 = (F.pow(F.lit(2.0), a).cast("long").cast("decimal(38,0)")
          * F.pow(F.lit(2.0), -e - a).cast("long").cast("decimal(38,0)")).cast("decimal(38,0)")
    rhs = ((fl * 2 + 1).cast("decimal(38,0)") * p2).cast("decimal(38,0)")
    sign = F.signum(x)
    up = sign * (fl + 1).cast("double") / F.lit(10.0 ** digits)
    down = sign * fl.cast("double") / F.lit(10.0 ** digits)
    return (F.when(x.isNull() | F.isnan(x), x)
            .when(text_tie & (lhs > rhs), up)
            .when(text_tie & (lhs < rhs), down)
            .otherwise(F.bround(x, digits)))


def clip_scale(c, lo: float, hi: float, default: float, digits: int = 4) -> Column:
    """Missing -> default, clip to [lo, hi], scale to [0, 1], round (``round_exact``) to ``digits``."""
    x = F.coalesce(_c(c).cast("double"), F.lit(float(default)))
    x = F.least(F.greatest(x, F.lit(float(lo))), F.lit(float(hi)))
    return round_exact((x - F.lit(float(lo))) / F.lit(float(hi - lo)), digits)


def case_map(c, mapping: dict, default=None) -> Column:
    """Code -> label by a ``when`` chain; unmatched gives ``default``."""
    x = _c(c)
    out = None
    for k, v in mapping.items():
        out = F.when(x == F.lit(k), F.lit(v)) if out is None else out.when(x == F.lit(k), F.lit(v))
    return out.otherwise(F.lit(default)) if default is not None else out


def bin_right(c, edges: Sequence[float], labels: Sequence[str], outside: str | None = None) -> Column:
    """Right-closed bins: label i when edges[i] < x <= edges[i+1]; outside (and null) ->
    ``outside``."""
    if len(labels) != len(edges) - 1:
        raise ValueError("need len(edges) - 1 labels")
    x = _c(c)
    out = None
    for lo, hi, lab in zip(edges[:-1], edges[1:], labels):
        cond = (x > F.lit(lo)) & (x <= F.lit(hi))
        out = F.when(cond, F.lit(lab)) if out is None else out.when(cond, F.lit(lab))
    return out.otherwise(F.lit(outside))


def bin_left(c, thresholds: Sequence[float], labels: Sequence) -> Column:
    """x < t1 -> labels[0], x < t2 -> labels[1], ...; everything else, null and NaN included,
    -> the last label."""
    if len(labels) != len(thresholds) + 1:
        raise ValueError("need len(thresholds) + 1 labels")
    x = _c(c)
    ok = x.isNotNull() & ~F.isnan(x.cast("double"))
    out = None
    for t, lab in zip(thresholds, labels[:-1]):
        cond = ok & (x < F.lit(t))
        out = F.when(cond, F.lit(lab)) if out is None else out.when(cond, F.lit(lab))
    return out.otherwise(F.lit(labels[-1]))


def linear_int16(c, slope, intercept) -> Column:
    """16-bit unit conversion: v * slope truncated toward zero (skipped when slope is 1), plus
    the intercept truncated to an integer; the result is kept in the 16-bit range (saturating
    where 16-bit arithmetic would wrap)."""
    sl = F.lit(float(slope)) if isinstance(slope, (int, float)) else _c(slope).cast("double")
    inter = F.lit(float(intercept)) if isinstance(intercept, (int, float)) else _c(intercept).cast("double")
    v = _c(c).cast("double")
    prod = v * sl
    scaled = F.when(sl == 1.0, v).otherwise(F.when(prod < 0, F.ceil(prod)).otherwise(F.floor(prod)))
    scaled = F.least(F.greatest(scaled, F.lit(-32768.0)), F.lit(32767.0))
    it = F.when(inter < 0, F.ceil(inter)).otherwise(F.floor(inter))
    return F.least(F.greatest(scaled + it, F.lit(-32768.0)), F.lit(32767.0)).cast("short")


def linear_int16_array(arr, slope, intercept, sentinel: int | None = -2000) -> Column:
    """Element-wise unit conversion of a pixel array: ``sentinel`` -> 0 first, then
    :func:`linear_int16` with the row's slope and intercept. A lambda is interpreted once an element,
    so a batch of arrays is converted at once here, null and NaN as ``linear_int16`` has them."""
    s = _c(slope) if not isinstance(slope, (int, float)) else F.lit(float(slope))
    i = _c(intercept) if not isinstance(intercept, (int, float)) else F.lit(float(intercept))
    low, high = -32768.0, 32767.0

    def numbers(a):
        return a.is_null().to_numpy(zero_copy_only=False), a.cast("double").fill_null(0.0).to_numpy(zero_copy_only=False)

    def clipped(x, null):
        # of numbers: NaN is the greatest, and least and greatest pass over a null
        return np.where(null, low, np.where(np.isnan(x), high, np.clip(x, low, high)))

    def whole(x):
        return np.where(np.isnan(x), 0.0, np.trunc(x))

    @F.arrow_udf("array<short>")
    def convert(px: pa.Array, sl: pa.Array, inter: pa.Array) -> pa.Array:
        sizes = pc.list_value_length(px).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        (no_v, v), (no_s, k), (no_i, b) = numbers(px.flatten()), numbers(sl), numbers(inter)
        if sentinel is not None:
            v = np.where(v == sentinel, 0.0, v)
        with np.errstate(all="ignore"):
            row = np.repeat(np.arange(len(sizes)), sizes)
            scaled = clipped(np.where(k[row] == 1.0, v, whole(v * k[row])), no_v | no_s[row])
            out = clipped(scaled + whole(b)[row], no_i[row]).astype(np.int16)
        at = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
        return pa.ListArray.from_arrays(at, pa.array(out), mask=px.is_null())
    return convert(_c(arr), s.cast("double"), i.cast("double"))


def fair_grad(x, c: float = 0.7) -> Column:
    """Gradient of the fair loss at residual x = pred - y."""
    return F.lit(c) * _c(x) / (F.abs(_c(x)) + F.lit(c))


def fair_hess(x, c: float = 0.7) -> Column:
    d = F.abs(_c(x)) + F.lit(c)
    return F.lit(c * c) / (d * d)


# ---------------------------------------------------------------- dates

def parse_date(c, fmt: str = "yyyy-MM-dd") -> Column:
    return F.to_date(_c(c), fmt)


def month_of(c) -> Column:
    return F.month(_c(c))


def is_month(c, month_start: str) -> Column:
    """True when the date falls in the month starting at ``month_start`` ('yyyy-MM-01')."""
    return F.date_trunc("month", _c(c)) == F.to_timestamp(F.lit(month_start))


def micros_since(c, origin: str = "1970-01-01 00:00:00") -> Column:
    """Microseconds from a wall-clock origin to a local (NTZ) timestamp, independent of the
    session time zone."""
    x = _c(c)
    return F.timestamp_diff("MICROSECOND", F.to_timestamp_ntz(F.lit(origin)), x.cast("timestamp_ntz"))


def format_ts(c, pattern: str = "yyyy-MM-dd-HH-mm") -> Column:
    return F.date_format(_c(c), pattern)


# ---------------------------------------------------------------- arrays

def max_diff(a, b) -> Column:
    """Element-wise max(a - b, 0)."""
    return F.zip_with(_c(a), _c(b), lambda x, y: F.greatest(x - y, F.lit(0)))


def onehot(idx, n: int) -> Column:
    """Index -> 0/1 array of length n (null index -> all zeros)."""
    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)),
                       lambda i: F.coalesce((i == _c(idx)).cast("int"), F.lit(0)))


def parse_flags(cols: Sequence[str]) -> Column:
    """Text flags -> array of 0/1 ints; '' / 'NA' / bad text -> 0."""
    return F.array(*[F.coalesce(F.trim(_c(c).cast("string")).try_cast("double").cast("int"), F.lit(0))
                     for c in cols])


def left_pad(a, length: int, value=0) -> Column:
    """Pad an array on the left with ``value`` up to ``length`` elements."""
    arr = _c(a)
    pad = F.array_repeat(F.lit(value), F.greatest(F.lit(length) - F.size(arr), F.lit(0)))
    return F.concat(pad, arr)


def row_standardize(df, col: str, out: str):
    """Per row: subtract the vector's mean and divide by its population sd (sd 0 -> 1).

    Mean and sd are projected as columns first, so each is computed once per row rather than
    once per element inside the lambda.
    """
    arr = F.transform(_c(col), lambda x: x.cast("double"))
    step = df.withColumn("__a", arr).withColumn("__mu", F.aggregate("__a", F.lit(0.0), lambda s, x: s + x) / F.size("__a"))
    step = step.withColumn("__sd", F.sqrt(F.aggregate("__a", F.lit(0.0), lambda s, x: s + (x - F.col("__mu")) * (x - F.col("__mu")))
                                          / F.size("__a")))
    sd = F.when(F.col("__sd") == 0, F.lit(1.0)).otherwise(F.col("__sd"))
    return step.withColumn(out, F.transform("__a", lambda x: (x - F.col("__mu")) / sd)).drop("__a", "__mu", "__sd")


def argmax(a) -> Column:
    """0-based index of the largest element (first one on ties)."""
    return F.array_position(_c(a), F.array_max(_c(a))) - 1


def top_k_indices(a, k: int) -> Column:
    """0-based indices of the k largest elements, best first; ties by lower index."""
    pairs = F.transform(_c(a), lambda x, i: F.struct(x.alias("v"), (-i).alias("ni")))
    ordered = F.reverse(F.array_sort(pairs))
    return F.transform(F.slice(ordered, 1, k), lambda s: -s["ni"])


def has_nan(a) -> Column:
    return F.exists(_c(a), lambda x: F.isnan(x) | x.isNull())
