"""Multi-channel series features per epoch.

Data model: a long table (series, channel, epoch, seq, value); ``seq`` is the 0-based sample
position inside the epoch and ``n`` samples make an epoch. Every feature is computed per
(series, channel, epoch) or per (series, epoch): groups bounded by the epoch length, spread
over tasks by the grouping keys.

Frequencies are true frequencies: bin k of an ``n_fft``-point transform at sampling rate ``fs``
is k * fs / n_fft Hz.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.operators.aggs import correlation

# fixed values: band levels in Hz, the spectral-edge top frequency and power share
BAND_LEVELS_HZ = [0.1, 4, 8, 12, 30, 70, 180]
EDGE_TOP_HZ = 40.0
EDGE_SHARE = 0.5


def spectrum_dft(df: DataFrame, keys: Sequence[str], seq: str, value: str, n_fft: int, bins: int | None = None,
                 norm_keys: Sequence[str] | None = None) -> DataFrame:
    """|DFT| at bins 0..bins-1 of each group's samples zero-padded to ``n_fft`` points; DC set
    to 0; ``power`` = magnitude divided by the total magnitude over ``norm_keys`` (default:
    the group keys minus the last, i.e. all channels of a series' epoch).

    Each sample row is expanded to its ``bins`` terms (an exploded index range, bounded by the
    parameter): the work is samples x bins, suited to the small-k case; ``spectrum_fft`` is
    the full-length variant.
    """
    bins = bins or n_fft
    ang = F.lit(2 * math.pi) * F.col("k") * F.col(seq) / F.lit(float(n_fft))
    j = df.select(*keys, seq, value, F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("k"))
    per = j.groupBy(*keys, "k").agg(F.sum(F.col(value) * F.cos(ang)).alias("re"),
                                   F.sum(-F.col(value) * F.sin(ang)).alias("im"))
    mag = F.when(F.col("k") == 0, F.lit(0.0)).otherwise(F.sqrt(F.col("re") ** 2 + F.col("im") ** 2))
    spec = per.select(*keys, "k", mag.alias("mag"))
    nk = list(norm_keys) if norm_keys is not None else list(keys)[:-1]
    tot = spec.groupBy(*nk).agg(F.sum("mag").alias("__tot")) if nk else None
    if tot is not None:
        spec = spec.join(tot, on=nk)
    else:
        spec = spec.withColumn("__tot", F.lit(spec.agg(F.sum("mag")).first()[0]))
    return spec.withColumn("power", F.when(F.col("__tot") > 0, F.col("mag") / F.col("__tot"))).drop("__tot")


def _magnitudes(df: DataFrame, keys: Sequence[str], seq: str, value: str, n_fft: int) -> DataFrame:
    """A row a group: its keys and ``mag``, the array of its ``n_fft`` values of |FFT| (DC set to 0).
    Spark packs the samples of a group (an epoch of one channel, bounded by the epoch length) into
    arrays in their order; a task transforms a whole batch of groups at once."""
    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def fft(seqs: pd.Series, values: pd.Series) -> pd.Series:
        if not len(seqs):
            return pd.Series([], dtype=object)
        x = np.zeros((len(seqs), n_fft))
        # a sample past the period meets the same angles as the one n_fft before it
        row = np.repeat(np.arange(len(seqs)), seqs.map(len))
        np.add.at(x, (row, np.concatenate(seqs.to_list()).astype(int) % n_fft), np.concatenate(values.to_list()).astype(float))
        m = np.abs(np.fft.fft(x, axis=1))
        m[:, 0] = 0.0
        return pd.Series(list(m))

    sample = F.struct(F.col(seq).alias("s"), F.coalesce(F.col(value).cast("double"), F.lit(float("nan"))).alias("v"))
    packed = df.groupBy(*keys).agg(F.array_sort(F.collect_list(sample)).alias("__a"))
    return packed.select(*keys, fft(F.col("__a.s"), F.col("__a.v")).alias("mag"))


def spectrum_fft(df: DataFrame, keys: Sequence[str], seq: str, value: str, n_fft: int) -> DataFrame:
    """Full |FFT| (DC set to 0) of each group with numpy, a batch of groups at once; groups are
    epochs of one channel, so their size is bounded by the epoch length."""
    return _magnitudes(df, keys, seq, value, n_fft).select(*keys, F.posexplode("mag").alias("k", "mag"))


def band_of(k_col, fs: float, n_fft: int, levels: Sequence[float] = BAND_LEVELS_HZ):
    """Band index of bin k by its true frequency: j when levels[j] <= f < levels[j+1]."""
    f = F.col(k_col) * F.lit(fs / n_fft)
    out = None
    for j in range(len(levels) - 1):
        cond = (f >= F.lit(float(levels[j]))) & (f < F.lit(float(levels[j + 1])))
        out = F.when(cond, F.lit(j)) if out is None else out.when(cond, F.lit(j))
    return out


def band_power(spec: DataFrame, keys: Sequence[str], fs: float, n_fft: int,
               levels: Sequence[float] = BAND_LEVELS_HZ, col: str = "power") -> DataFrame:
    """2 * sum of the normalised spectrum inside each band (bands with no bin are 0)."""
    b = spec.withColumn("band", band_of("k", fs, n_fft, levels)).filter(F.col("band").isNotNull())
    per = b.groupBy(*keys, "band").agg((2 * F.sum(col)).alias("band_power"))
    return per


def band_power_by_index(spec: DataFrame, keys: Sequence[str], bands: Sequence[tuple[int, int]], col: str = "power") -> DataFrame:
    """2 * sum of the spectrum over bin index ranges [lo, hi) (dyadic bands)."""
    out = None
    for j, (lo, hi) in enumerate(bands):
        cond = (F.col("k") >= lo) & (F.col("k") < hi)
        out = F.when(cond, F.lit(j)) if out is None else out.when(cond, F.lit(j))
    b = spec.withColumn("band", out).filter(F.col("band").isNotNull())
    return b.groupBy(*keys, "band").agg((2 * F.sum(col)).alias("band_power"))


def dyadic_bands(n: int) -> list[tuple[int, int]]:
    """Octaves of an n-point spectrum, lowest first: each band ends, exclusively, at n over a power
    of two and starts one bin above half its end."""
    ends = [n >> shift for shift in range(1, n.bit_length()) if n >> shift > 1]
    return [((end >> 1) + 1, end) for end in reversed(ends)]


def band_entropy(bp: DataFrame, keys: Sequence[str], col: str = "band_power") -> DataFrame:
    """-sum p ln p over the bands of each group; p = 0 contributes 0."""
    p = F.col(col)
    return bp.groupBy(*keys).agg((-F.sum(F.when(p > 0, p * F.ln(p)).otherwise(F.lit(0.0)))).alias("entropy"))


def edge_frequency(spec: DataFrame, keys: Sequence[str], fs: float, n_fft: int, top_hz: float = EDGE_TOP_HZ,
                   share: float = EDGE_SHARE, col: str = "power") -> DataFrame:
    """Spectral edge: the lowest frequency at which the cumulative power of bins up to
    ``top_hz`` reaches ``share`` of their total. Both sums are over a group's bins only,
    bounded windows; a null key is a group."""
    f = F.col("k") * F.lit(fs / n_fft)
    w = Window.partitionBy(*keys)
    running = w.orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    s = spec.filter(f <= F.lit(top_hz)).withColumn("__cum", F.sum(col).over(running)).withColumn("__tot", F.sum(col).over(w))
    return s.filter(F.col("__cum") >= F.lit(share) * F.col("__tot")).groupBy(*keys).agg((F.min("k") * F.lit(fs / n_fft)).alias("edge_hz"))


def band_ratio(spec: DataFrame, keys: Sequence[str], col: str = "mag") -> DataFrame:
    """Power per bin and its share of the group's total; a null key is a group."""
    return spec.withColumn("share", F.try_divide(F.col(col), F.sum(col).over(Window.partitionBy(*keys))))


#: Channels of one recording are known and few; a column with more values is not a channel.
MOST_CHANNELS = 1024


def channel_list(df: DataFrame, channel: str) -> list:
    """The channels a table has, sorted: the fixed order of every feature vector."""
    found = [r[0] for r in df.select(channel).where(F.col(channel).isNotNull()).distinct().limit(MOST_CHANNELS + 1).collect()]
    if len(found) > MOST_CHANNELS:
        raise ValueError(f"{channel} has more than {MOST_CHANNELS} values")
    return sorted(found)


def channel_correlations(df: DataFrame, group: Sequence[str], row: str, channel: str, value: str, channels: Sequence) -> DataFrame:
    """Pearson correlation of every two channels (by their places i <= j in ``channels``) over the
    rows of a group that have both; undefined is 0, also on the diagonal.

    Values of one row meet in an array of at most ``len(channels)`` entries and leave as pairs,
    which are summed to co-moments per (group, i, j) before anything is moved."""
    place = F.array_position(F.array(*[F.lit(c) for c in channels]), F.col(channel)) - 1
    at = df.where(F.col(channel).isNotNull() & F.col(value).isNotNull()).select(*group, row, place.cast("int").alias("i"), F.col(value).cast("double").alias("x")).where("i >= 0")
    rows = at.groupBy(*group, row).agg(F.collect_list(F.struct("i", "x")).alias("__a"))
    first = rows.select(*group, "__a", F.explode("__a").alias("p"))
    pairs = first.select(*group, "p", F.explode(F.filter("__a", lambda q: q["i"] >= F.col("p.i"))).alias("q"))
    return pairs.groupBy(*group, F.col("p.i").alias("i"), F.col("q.i").alias("j")).agg(correlation(F.col("p.x"), F.col("q.x")).alias("corr"))


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def _eigenvalues(flat: pd.Series) -> pd.Series:
    """Ascending eigenvalues of symmetric matrices given row by row, a batch at once."""
    if not len(flat):
        return pd.Series([], dtype=object)
    m = np.stack(flat.to_numpy())
    n = math.isqrt(m.shape[1])
    return pd.Series(list(np.linalg.eigvalsh(m.reshape(-1, n, n))))


def correlation_eigenvalues(corr: DataFrame, group: Sequence[str], n: int, out: str = "eigenvalues") -> DataFrame:
    """``out``: n ascending eigenvalues of every group's matrix; channels it lacks are rows of zeros."""
    known = corr.groupBy(*group).agg(F.map_from_entries(F.collect_list(F.struct(F.col("i") * n + F.col("j"), "corr"))).alias("__m"))
    cell = lambda k: F.coalesce(F.try_element_at("__m", (F.least(F.floor(k / n), k % n) * n + F.greatest(F.floor(k / n), k % n)).cast("int")), F.lit(0.0))
    return known.select(*group, _eigenvalues(F.transform(F.sequence(F.lit(0), F.lit(n * n - 1)), cell)).alias(out))


def corr_eigen_per_group(df: DataFrame, group: Sequence[str], channel: str, seq: str, value: str,
                         out_prefix: str = "eig", channels: Sequence | None = None) -> DataFrame:
    """Per group (a series' epoch): eigenvalues of the Pearson matrix between the channels, one
    row an eigenvalue by rank. Correlations are grouped sums; only matrices reach numpy."""
    channels = channel_list(df, channel) if channels is None else list(channels)
    one = df.repartition(*group)  # serves every grouping below
    eig = correlation_eigenvalues(channel_correlations(one, list(group), seq, channel, value, channels), list(group), len(channels))
    return eig.select(*group, F.posexplode("eigenvalues").alias("rank", out_prefix))


#: Values of a vector per channel, in the order of the vector; ``edge_hz`` stands once, after the first.
CHANNEL_VALUES = ["entropy", "corr_eig", "band_eig", "dyadic_entropy", "dyadic_eig", "activity", "mobility", "complexity", "skew", "kurt"]


def _normalised(samples: DataFrame, keys: Sequence[str], seq: str, value: str, n_fft: int) -> DataFrame:
    """Spectrum of every channel, ``power`` as a share of its epoch's sum over channels and bins."""
    spec = _magnitudes(samples, keys, seq, value, n_fft)
    own = F.aggregate("mag", F.lit(0.0), lambda a, m: a + m)
    total = spec.withColumn("__tot", F.sum(own).over(Window.partitionBy(*keys[:-1])))
    return total.select(*keys, "__tot", F.posexplode("mag").alias("k", "mag")).withColumn("power", F.try_divide(F.col("mag"), F.col("__tot"))).drop("__tot")


def channel_features(samples: DataFrame, keys: Sequence[str], seq: str, value: str, fs: float, n_fft: int,
                     levels: Sequence[float] = BAND_LEVELS_HZ) -> DataFrame:
    """Per (..., channel): entropy over the bands and over the dyadic bands, Hjorth activity, mobility
    and complexity, skewness and kurtosis. ``keys`` end with the channel. The parts are rows of
    one union, put together by one grouping: null keys are keys."""
    from quarry.operators.windows import hjorth

    keys = list(keys)
    spec = _normalised(samples, keys, seq, value, n_fft)
    parts = [band_entropy(band_power(spec, keys, fs, n_fft, levels), keys),
             band_entropy(band_power_by_index(spec, keys, dyadic_bands(n_fft)), keys).withColumnRenamed("entropy", "dyadic_entropy"),
             hjorth(samples, keys, [seq], value), samples.groupBy(*keys).agg(F.skewness(value).alias("skew"), F.kurtosis(value).alias("kurt"))]
    names = ["entropy", "dyadic_entropy", "activity", "mobility", "complexity", "skew", "kurt"]
    rows = None
    for p in parts:
        p = p.select(*keys, *[(F.col(c) if c in p.columns else F.lit(None)).cast("double").alias(c) for c in names])
        rows = p if rows is None else rows.unionByName(p)
    return rows.groupBy(*keys).agg(*[F.max(c).alias(c) for c in names])


def epoch_edge(samples: DataFrame, keys: Sequence[str], seq: str, value: str, fs: float, n_fft: int) -> DataFrame:
    """Spectral edge of an epoch: over the power of all its channels."""
    spec = _normalised(samples, keys, seq, value, n_fft).groupBy(*keys[:-1], "k").agg(F.sum("power").alias("power"))
    return edge_frequency(spec, keys[:-1], fs, n_fft)


def eigen_blocks(samples: DataFrame, keys: Sequence[str], seq: str, value: str, fs: float, n_fft: int, channels: Sequence,
                 levels: Sequence[float] = BAND_LEVELS_HZ) -> DataFrame:
    """Per epoch and ``block`` the eigenvalues of the correlations between channels: ``time`` over the
    samples, ``band`` over the power of the frequency bands, ``dyadic`` over that of the dyadic bands."""
    keys = list(keys)
    spec = _normalised(samples, keys, seq, value, n_fft)
    blocks = {"time": samples.select(*keys, F.col(seq).cast("long").alias("row"), F.col(value).cast("double").alias("x"))}
    for name, power in (("band", band_power(spec, keys, fs, n_fft, levels)), ("dyadic", band_power_by_index(spec, keys, dyadic_bands(n_fft)))):
        blocks[name] = power.select(*keys, F.col("band").cast("long").alias("row"), F.col("band_power").alias("x"))
    rows = None
    for name, b in blocks.items():
        b = b.withColumn("block", F.lit(name))
        rows = b if rows is None else rows.unionByName(b)
    group = [*keys[:-1], "block"]
    return correlation_eigenvalues(channel_correlations(rows, group, "row", keys[-1], "x", channels), group, len(channels))


def features(samples: DataFrame, series: str, channel: str, epoch: str, seq: str, value: str, fs: float,
             n_fft: int, levels: Sequence[float] = BAND_LEVELS_HZ, channels: Sequence | None = None,
             missing: float = float("nan")) -> DataFrame:
    """One vector of ``10 * channels + 1`` values per (series, epoch), the same places on every row:
    band entropies, the epoch's spectral edge, eigenvalues of the channel correlations over samples
    and over bands, dyadic entropies, eigenvalues over dyadic bands, Hjorth activity, mobility and
    complexity, skewness, kurtosis. ``channels`` is the fitted list (of a training table, say), by
    default that of ``samples``; what a channel lacks is ``missing``.

    The samples are dealt once by (series, epoch); every grouping and window after it is by these
    keys and more, so nothing is shuffled again."""
    keys = [series, epoch, channel]
    channels = channel_list(samples, channel) if channels is None else list(channels)
    samples = samples.where(F.col(channel).isin(channels)).select(*keys, seq, value).repartition(series, epoch)
    place = F.array_position(F.array(*[F.lit(c) for c in channels]), F.col(channel)) - 1
    per = channel_features(samples, keys, seq, value, fs, n_fft, levels)
    names = [c for c in CHANNEL_VALUES if not c.endswith("_eig")]
    long = per.select(series, epoch, F.explode(F.array(*[F.struct(F.concat(F.lit(c + ":"), place).alias("name"), F.col(c).alias("x")) for c in names])).alias("v"))
    edge = epoch_edge(samples, keys, seq, value, fs, n_fft).select(series, epoch, F.struct(F.lit("edge_hz:0").alias("name"), F.col("edge_hz").cast("double").alias("x")).alias("v"))
    eig = eigen_blocks(samples, keys, seq, value, fs, n_fft, channels, levels).select(series, epoch, "block", F.posexplode("eigenvalues").alias("i", "x"))
    block = F.when(F.col("block") == "time", "corr_eig:").otherwise(F.concat("block", F.lit("_eig:")))
    long = long.unionByName(edge).unionByName(eig.select(series, epoch, F.struct(F.concat(block, F.col("i")).alias("name"), "x").alias("v")))
    known = long.groupBy(series, epoch).agg(F.map_from_entries(F.collect_list("v")).alias("__m"))
    order = [f"{c}:{i}" for c in CHANNEL_VALUES for i in range(len(channels))]
    order.insert(len(channels), "edge_hz:0")
    return known.select(series, epoch, F.transform(F.array(*[F.lit(n) for n in order]), lambda n: F.coalesce(F.try_element_at("__m", n), F.lit(missing))).alias("features"))
