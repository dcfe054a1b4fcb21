"""Feature vectors of series against numpy, epoch by epoch."""

import math

import numpy as np

from quarry.operators import signal

FS, N = 64.0, 16


def _table(spark):
    rng = np.random.default_rng(1)
    rows = []
    for epoch, channels in ((0, "abc"), (1, "ab"), (2, "abc"), (None, "ac")):
        for c in channels:
            x = np.full(N, 2.5) if (epoch, c) == (2, "b") else rng.normal(size=N) + (c == "c") * np.arange(N)
            rows += [("s", c, epoch, i, float(v)) for i, v in enumerate(x)]
    return rows, spark.createDataFrame(rows, "series string, ch string, epoch long, seq long, v double")


def _corr_eig(m):
    """m: rows x channels; undefined is 0."""
    with np.errstate(all="ignore"):
        c = np.nan_to_num(np.atleast_2d(np.corrcoef(m, rowvar=False)))
    c[np.var(m, axis=0) == 0] = 0
    c[:, np.var(m, axis=0) == 0] = 0
    return np.sort(np.linalg.eigvalsh(c))


def _entropy(p):
    return -sum(x * math.log(x) for x in p if x > 0)


def _expected(rows, epoch, channels):
    have = {c: np.array([v for s, cc, e, i, v in rows if cc == c and e == epoch]) for c in channels}
    have = {c: x for c, x in have.items() if len(x)}
    mag = {c: np.abs(np.fft.fft(x)) for c, x in have.items()}
    for m in mag.values():
        m[0] = 0
    total = sum(m.sum() for m in mag.values())
    power = {c: m / total for c, m in mag.items()}
    hz = np.arange(N) * FS / N
    bands = [(hz >= lo) & (hz < hi) for lo, hi in zip(signal.BAND_LEVELS_HZ, signal.BAND_LEVELS_HZ[1:])]
    bands = [b for b in bands if b.any()]
    octaves = [np.isin(np.arange(N), range(lo, hi)) for lo, hi in signal.dyadic_bands(N) if hi > lo]
    bp = {c: np.array([2 * p[b].sum() for b in bands]) for c, p in power.items()}
    dp = {c: np.array([2 * p[b].sum() for b in octaves]) for c, p in power.items()}

    def eig(m):
        w = _corr_eig(np.column_stack([m[c] for c in have])) if len(have) > 1 else np.array([float(np.var(next(iter(m.values()))) > 0)])
        return np.sort(np.r_[np.zeros(len(channels) - len(w)), w])
    low = sum(p[hz <= 40] for p in power.values())
    edge = hz[np.flatnonzero(np.cumsum(low) >= 0.5 * low.sum() - 1e-12)[0]]
    out = {"edge_hz": edge, "corr_eig": eig(have), "band_eig": eig(bp), "dyadic_eig": eig(dp)}
    for i, c in enumerate(channels):
        if c in have:
            x = have[c]
            d1, d2 = np.diff(x), np.diff(np.diff(x))
            z = x - x.mean()
            v = x.var()
            out[c] = [_entropy(bp[c]), _entropy(dp[c]), v] + ([d1.std() / x.std(), d2.std() / d1.std() / (d1.std() / x.std()), (z ** 3).mean() / v ** 1.5, (z ** 4).mean() / v ** 2 - 3] if v > 0 else [None] * 4)
    return out


def test_vectors_are_those_of_numpy(spark):
    rows, df = _table(spark)
    channels = ["a", "b", "c"]
    got = {r["epoch"]: r["features"] for r in signal.features(df, "series", "ch", "epoch", "seq", "v", FS, N).collect()}
    assert set(got) == {0, 1, 2, None} and {len(v) for v in got.values()} == {31}
    for epoch, v in got.items():
        want = _expected(rows, epoch, channels)
        parts = {"entropy": v[0:3], "dyadic_entropy": v[10:13], "activity": v[16:19], "mobility": v[19:22], "complexity": v[22:25], "skew": v[25:28], "kurt": v[28:31]}
        assert abs(v[3] - want["edge_hz"]) < 1e-9
        for name, at in (("corr_eig", 4), ("band_eig", 7), ("dyadic_eig", 13)):
            assert np.allclose(v[at:at + 3], want[name], atol=1e-6), (epoch, name)
        for i, c in enumerate(channels):
            for name, x in zip(("entropy", "dyadic_entropy", "activity", "mobility", "complexity", "skew", "kurt"), want.get(c, [])):
                assert math.isnan(parts[name][i]) if x is None else abs(parts[name][i] - x) < 1e-6, (epoch, c, name)
            if c not in want:
                assert all(math.isnan(p[i]) for p in parts.values())


def test_channels_of_a_training_table_fix_the_places(spark):
    _, df = _table(spark)
    got = signal.features(df, "series", "ch", "epoch", "seq", "v", FS, N, channels=["a", "c", "x"], missing=0.0).collect()
    assert {len(r["features"]) for r in got} == {31}
    assert all(r["features"][2] == 0.0 and not any(map(math.isnan, r["features"][:3])) for r in got)


def test_null_series_and_an_empty_table(spark):
    rows, _ = _table(spark)
    df = spark.createDataFrame([(None, *r[1:]) for r in rows], "series string, ch string, epoch long, seq long, v double")
    assert signal.features(df, "series", "ch", "epoch", "seq", "v", FS, N).count() == 4
    assert signal.features(df.limit(0), "series", "ch", "epoch", "seq", "v", FS, N, channels=["a"]).collect() == []
    spec = signal.spectrum_fft(df, ["series", "ch"], "seq", "v", N)
    assert signal.band_ratio(spec, ["series", "ch"]).count() == spec.count()
