"""Spectra: clean, baseline, normalise, regrid, match against a library.

Data model: a long table (label, x, y) per spectrum point. Per-label work is grouped by label;
the library match joins on a shared grid index.
"""

from __future__ import annotations


import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions.text import split_pair
from quarry.operators import joins
from quarry.operators.sequence import Scan, null_safe_join, ordered_scan, row_index

# library spectra that one task holds against the main spectra of its block
LIBRARY_BLOCK = 256


def parse_lines(df: DataFrame, key: str, line: str, pos: str) -> DataFrame:
    """Text lines "x y" -> (key, pos, x, y); a header or any non-numeric line is dropped."""
    x, y = split_pair(line)
    return df.select(key, pos, x.alias("x"), y.alias("y")).filter(F.col("x").isNotNull() & F.col("y").isNotNull())


def start_at_peak(df: DataFrame, label: str, x: str, y: str, a: float, b: float) -> DataFrame:
    """Keep points from the maximum of y between the points nearest to x = a and x = b."""
    near_a = F.min_by(F.col(x), F.struct(F.abs(F.col(x) - F.lit(a)), F.col(x)))
    near_b = F.min_by(F.col(x), F.struct(F.abs(F.col(x) - F.lit(b)), F.col(x)))
    ends = df.groupBy(label).agg(near_a.alias("__xa"), near_b.alias("__xb"))
    j = df.join(ends, label)
    inside = j.filter((F.col(x) >= F.col("__xa")) & (F.col(x) < F.col("__xb")))
    peak = inside.groupBy(label).agg(F.max_by(F.col(x), F.struct(F.col(y), -F.col(x))).alias("__xp"))
    return df.join(peak, label).filter(F.col(x) >= F.col("__xp")).drop("__xp")


def skip_head(df: DataFrame, label: str, x: str, n: int) -> DataFrame:
    """Drop the first n points of every spectrum (in x order)."""
    return row_index(df, [x], "__pos", key=[label]).filter(F.col("__pos") >= n).drop("__pos")


def polyfit(df: DataFrame, label: str, x: str, y: str, degree: int = 3) -> DataFrame:
    """Least-squares polynomial per label: (label, coef array low -> high degree, x0, x1).

    x is scaled to [-1, 1] per label (x0, x1 = min, max) for conditioning. The power sums of
    every label come from one grouped aggregate; the (degree + 1)^2 normal equations are solved
    for a batch of labels at once, where their sums lie. A null label is a label; one without
    finite sums has NaN coefficients.
    """
    rng = df.groupBy(label).agg(F.min(x).alias("__x0"), F.max(x).alias("__x1"))
    span = F.when(F.col("__x1") > F.col("__x0"), F.col("__x1") - F.col("__x0")).otherwise(F.lit(1.0))
    s = null_safe_join(df, rng, [label]).withColumn("__u", (F.col(x) - F.col("__x0")) / span * 2 - 1)
    powers, n = 2 * degree + 1, degree + 1
    sums = s.groupBy(label).agg(F.max("__x0").cast("double").alias("x0"), F.max("__x1").cast("double").alias("x1"), F.array(
        *[F.sum(F.pow("__u", F.lit(float(k)))) for k in range(powers)], *[F.sum(F.col(y) * F.pow("__u", F.lit(float(k)))) for k in range(n)]).alias("__sums"))

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def solve(v: pd.Series) -> pd.Series:
        m = np.array([np.asarray(r, dtype=float) for r in v]).reshape(-1, powers + n)
        ok = np.isfinite(m).all(1)
        out = np.full((len(m), n), np.nan)
        place = np.add.outer(np.arange(n), np.arange(n))
        out[ok] = (np.linalg.pinv(m[ok][:, place]) @ m[ok][:, powers:, None])[:, :, 0]
        return pd.Series(list(out))
    return sums.select(label, solve("__sums").alias("coef"), "x0", "x1")


def subtract_baseline(df: DataFrame, label: str, x: str, y: str, degree: int = 3, out: str | None = None) -> DataFrame:
    """y minus its per-label least-squares polynomial in x."""
    out = out or y
    fit = polyfit(df, label, x, y, degree)
    span = F.when(F.col("x1") > F.col("x0"), F.col("x1") - F.col("x0")).otherwise(F.lit(1.0))
    u = (F.col(x) - F.col("x0")) / span * 2 - 1
    poly = F.aggregate(F.reverse(F.col("coef")), F.lit(0.0), lambda acc, c: acc * u + c)
    return null_safe_join(df, fit, [label]).withColumn(out, F.col(y) - poly).drop("coef", "x0", "x1")


def normalize(df: DataFrame, label: str, y: str, out: str | None = None) -> DataFrame:
    """Per label: y -> (y - min) / (max - min)."""
    out = out or y
    r = df.groupBy(label).agg(F.min(y).alias("__lo"), F.max(y).alias("__hi"))
    d = F.col("__hi") - F.col("__lo")
    return null_safe_join(df, r, [label]).withColumn(out, F.when(d != 0, (F.col(y) - F.col("__lo")) / d)).drop("__lo", "__hi")


def regrid(df: DataFrame, label: str, x: str, y: str, points: int = 3000) -> DataFrame:
    """Linear interpolation of each spectrum onto ``points`` evenly spaced x between its min and
    max: (label, i, x, y).

    Each segment [x_k, x_k+1) between consecutive points (found with a sliced scan, no per-label
    window) emits the grid indices that fall in it; the last point closes the grid. Output size
    is exactly ``points`` per label, never segments x grid. A label with one place x has that x and
    its y at every grid index.
    """
    ends = df.groupBy(label).agg(F.min(x).alias("__lo"), F.max(x).alias("__hi"))
    nxt = ordered_scan(df.select(label, x, y), [label], [x],
                       [Scan("__next", "last", F.struct(F.col(x).alias("x"), F.col(y).alias("y")), current=False)],
                       descending=True)
    seg = nxt.join(ends, label).withColumn("__step", (F.col("__hi") - F.col("__lo")) / F.lit(points - 1))
    nx, ny = F.col("__next.x"), F.col("__next.y")
    step = F.col("__step")
    first = F.greatest(F.floor(F.try_divide(F.col(x) - F.col("__lo"), step)) - 1, F.lit(0)).cast("int")
    last = F.least(F.coalesce(F.ceil(F.try_divide(nx - F.col("__lo"), step)) + 1, F.lit(points - 1)), F.lit(points - 1)).cast("int")
    cand = seg.withColumn("i", F.explode(F.sequence(first, F.greatest(first, last))))
    g = F.col("__lo") + F.col("i") * step
    g = F.when(F.col("i") == points - 1, F.col("__hi")).otherwise(g)
    inside = (g >= F.col(x)) & (nx.isNull() | (g < nx))
    cand = cand.withColumn("__g", g).filter(inside & (nx.isNotNull() | (F.col("i") == points - 1) | (F.col("__lo") == F.col("__hi"))))
    val = F.when(nx.isNull(), F.col(y)).otherwise(F.col(y) + F.try_divide((F.col("__g") - F.col(x)) * (ny - F.col(y)), nx - F.col(x)))
    return cand.select(label, F.col("i").cast("int").alias("i"), F.col("__g").alias(x), val.alias(y))


def identify(test: DataFrame, library: DataFrame, key: str = "label", ref: str = "ref", i: str = "i", y: str = "y",
             pure_threshold: float = 0.3) -> DataFrame:
    """For each test spectrum: squared error to every library spectrum on the common grid, the
    best match, its error and whether it is a mixture (error >= threshold)."""
    err = joins.match_on_grid(test.select(key, i, y), library.select(ref, i, y), key, ref, i, y, "sse")
    best = err.groupBy(key).agg(F.min_by(F.col(ref), F.struct("sse", ref)).alias("best"), F.min("sse").alias("error"))
    return best.withColumn("is_mixture", F.col("error") >= F.lit(pure_threshold))


def residual(test: DataFrame, library: DataFrame, matches: DataFrame, key: str = "label", ref: str = "ref",
             i: str = "i", y: str = "y") -> DataFrame:
    """Residual curve test - best library spectrum: (key, i, residual)."""
    t = test.select(key, i, y).join(matches.select(key, F.col("best").alias(ref)), key)
    lib = library.select(ref, i, F.col(y).alias("__ly"))
    return t.join(lib, [ref, i]).select(key, i, (F.col(y) - F.col("__ly")).alias("residual"))


def residual_curves(test: DataFrame, library: DataFrame, key: str = "label", ref: str = "ref", i: str = "i",
                    y: str = "y") -> DataFrame:
    """Residual curves test - library of every test spectrum against every library spectrum, over the
    places of the grid that both have: (key, ref, i, residual). A null value has a null residual. One row a
    point and pair by definition; the library is broadcast under ``joins.BROADCAST_ROWS`` rows only."""
    lib = library.select(ref, i, F.col(y).alias("__ly"))
    if lib.count() <= joins.BROADCAST_ROWS:
        lib = F.broadcast(lib)
    return test.select(key, i, y).join(lib, i).select(key, ref, i, (F.col(y) - F.col("__ly")).alias("residual"))


def identify_second(test: DataFrame, library: DataFrame, key: str = "label", ref: str = "ref", i: str = "i",
                    y: str = "y", pure_threshold: float = 0.3) -> DataFrame:
    """Secondary component of mixtures: the residual of the best match, normalised to [0, 1],
    matched against the library again. (key, best, error, second, second_error)."""
    m = identify(test, library, key, ref, i, y, pure_threshold)
    mix = m.filter("is_mixture")
    r = normalize(residual(test, library, mix, key, ref, i, y), key, "residual", "y2")
    m2 = identify(r.select(key, i, F.col("y2").alias(y)).na.drop(), library, key, ref, i, y, pure_threshold)
    return mix.join(m2.select(key, F.col("best").alias("second"), F.col("error").alias("second_error")), key, "left")


def convolve_same(mains: DataFrame, library: DataFrame, main: str = "main", ref: str = "ref", i: str = "i", y: str = "y") -> DataFrame:
    """'same'-mode convolution of every main spectrum with every library spectrum, divided by its
    maximum where that is not 0: (main, ref, k, conv). A spectrum is one row with its values in the
    order of ``i``, a pair of spectra one row of the join; the sums over i + j = k are taken in it."""
    def curves(df: DataFrame, key: str, name: str) -> DataFrame:
        points = F.array_sort(F.collect_list(F.struct(F.col(i).alias("i"), F.col(y).cast("double").alias("y"))))
        return df.groupBy(F.col(key).alias(key)).agg(F.transform(points, lambda p: p["y"]).alias(name))

    # the library lies in blocks of bounded size; a main spectrum goes to each of them
    lib = curves(library, ref, "__b")
    blocks = -(-max(1, lib.count()) // LIBRARY_BLOCK)
    lib = lib.withColumn("__block", F.pmod(F.xxhash64(ref), F.lit(blocks)).cast("int"))
    own = curves(mains, main, "__a").withColumn("__block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    pairs = own.join(lib, "__block")
    a, b, m, n = F.col("__a"), F.col("__b"), F.size("__a"), F.size("__b")

    def at(k):
        f = k + F.floor((F.least(m, n) - 1) / 2).cast("int")  # place in the full convolution
        lo, hi = F.greatest(F.lit(0), f - n + 1), F.least(f, m - 1)
        terms = F.zip_with(F.slice(a, lo + 1, hi - lo + 1), F.reverse(F.slice(b, f - hi + 1, hi - lo + 1)), lambda p, q: p * q)
        return F.aggregate(terms, F.lit(0.0), lambda s, t: s + t)

    conv = pairs.select(main, ref, F.transform(F.sequence(F.lit(0), F.greatest(m, n) - 1), at).alias("__c"))
    conv = conv.select(main, ref, F.array_max("__c").alias("__m"), F.posexplode("__c").alias("k", "__v"))
    return conv.select(main, ref, "k", F.when(F.col("__m") != 0, F.col("__v") / F.col("__m")).otherwise(F.col("__v")).alias("conv"))


def fft_normalized(df: DataFrame, label: str, i: str, y: str, n_fft: int, bins: int | None = None,
                   negate: bool = False) -> DataFrame:
    """|DFT| of each spectrum (optionally of -y) divided by its maximum: (label, k, amp)."""
    from quarry.operators.signal import spectrum_dft
    src = df.select(label, i, (-F.col(y) if negate else F.col(y)).alias("__y"))
    spec = spectrum_dft(src, [label], i, "__y", n_fft, bins, norm_keys=[label])
    mx = spec.groupBy(label).agg(F.max("mag").alias("__m"))
    return spec.join(mx, label).select(label, "k", F.when(F.col("__m") > 0, F.col("mag") / F.col("__m")).alias("amp"))


def preprocess(df: DataFrame, label: str, x: str, y: str, start: int = 400, degree: int = 3,
               points: int = 3000) -> DataFrame:
    """Skip the first ``start`` points, subtract the cubic baseline, normalise to [0, 1] and
    regrid to ``points`` values: (label, i, x, y)."""
    s = skip_head(df, label, x, start)
    s = subtract_baseline(s, label, x, y, degree)
    s = normalize(s, label, y)
    return regrid(s, label, x, y, points)


