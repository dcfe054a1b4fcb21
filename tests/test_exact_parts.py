"""Long base-26 numbers, wide Box-Cox brackets, quantiles, regridding: against Python and numpy."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.functions.text import base26, base26_text
from quarry.operators import aggs, clean, features, voxels


def number(s):
    n = 0
    for ch in s:
        n = n * 26 + ord(ch) - 64
    return n


def test_base26_of_any_length_is_exact(spark):
    r = random.Random(1)
    texts = ["A", "Z", "AB", "", "Brand#12", "#", "##A", "@@@", "@A", "Z" * 27, "Z" * 28, "A" + "@" * 40] + ["".join(r.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ") for _ in range(n)) for n in (30, 100, 100, 300)] \
        + ["".join(r.choice("#1@AZaz") for _ in range(r.randint(1, 60))) for _ in range(100)]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(texts)] + [(len(texts), None)], "id long, s string")
    got = {r["id"]: (r["n"], r["w"]) for r in df.select("id", base26_text("s").alias("n"), base26_text("s", none_word=True).alias("w")).collect()}
    for i, s in enumerate(texts):
        assert got[i][0] == str(number(s)), s
    assert got[len(texts)] == (None, "279069")
    short = df.where(F.length("s") <= 20).select(base26("s").cast("string").alias("a"), base26_text("s").alias("b")).collect()
    assert all(r["a"] == r["b"] for r in short)


def test_boxcox_finds_an_optimum_outside_the_bracket(spark):
    rng = np.random.default_rng(0)
    x = (1 + 5 * np.clip(rng.normal(6000, 900, 4000), 100, None)) ** 0.2  # its fifth power is normal
    y = np.exp(rng.normal(0, 1, 4000)) ** 0.5
    df = spark.createDataFrame([(float(a), float(b), 3.0, None if i % 3 else float(a)) for i, (a, b) in enumerate(zip(x, y))], "a double, b double, c double, d double")
    bc = features.BoxCox.fit(df, ["a", "b", "c", "d"], shift=0.0)
    assert 4.0 < bc.lambdas["a"] < 6.0 and 4.0 < bc.lambdas["d"] < 6.0 and abs(bc.lambdas["b"]) < 0.2 and "c" not in bc.lambdas

    def llf(v, lam):
        z = np.log(v) if lam == 0 else (v ** lam - 1) / lam
        return (lam - 1) * np.log(v).sum() - len(v) / 2 * np.log(z.var())
    near = [llf(x, bc.lambdas["a"] + e) for e in np.linspace(-0.5, 0.5, 41)]
    assert llf(x, bc.lambdas["a"]) >= max(near) - 1e-3
    assert features.BoxCox.fit(df.limit(0), ["a"]).lambdas == {}


def test_boxcox_takes_one_job_a_round_for_all_columns(spark, monkeypatch):
    calls = []
    plain = features.boxcox_logliks
    monkeypatch.setattr(features, "boxcox_logliks", lambda df, grids, shift: calls.append(sorted(grids)) or plain(df, grids, shift))
    df = spark.range(1, 300).select(*[F.pow(F.col("id").cast("double"), F.lit(p)).alias(f"c{i}") for i, p in enumerate((0.5, 0.7, 1.0))])
    features.BoxCox.fit(df, ["c0", "c1", "c2"], shift=0.0, rounds=3)
    assert calls == [["c0", "c1", "c2"]] * 3


@pytest.mark.parametrize("n", [1, 2, 7, 200])
def test_quantiles_are_those_of_numpy(spark, n):
    rng = np.random.default_rng(n)
    a, b = rng.integers(0, 5, n).astype(float), rng.normal(size=n)
    rows = [(float(x), float(y), None) for x, y in zip(a, b)] + [(None, float("nan"), None)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 1.0]
    got = {(r["column"], r["p"]): r["value"] for r in aggs.quantiles(df, ["a", "b", "c"], probs).collect()}
    assert set(got) == {(c, p) for c in "ab" for p in probs}
    for c, x in (("a", a), ("b", b)):
        assert np.allclose([got[c, p] for p in probs], np.quantile(x, probs))
    p = {r["column"]: r for r in clean.profile(df, ["a", "c"]).collect()}
    assert p["a"]["rows"] == n + 1 and p["a"]["columns"] == 3 and p["a"]["type"] == "double" and p["c"]["q50"] is None and p["c"]["count"] == 0


def nearest(volume, spacing, new):
    """The definition, cell by cell."""
    shape = [max(1, round(n * s / w)) for n, s, w in zip(volume.shape, spacing, new)]
    at = [[int(np.floor(t * (n - 1) / (m - 1) + 0.5)) if m > 1 else 0 for t in range(m)] for n, m in zip(volume.shape, shape)]
    return volume[np.ix_(*at)]


@pytest.mark.parametrize("shape,spacing,new", [((7, 4, 6), (2.0, 1.0, 0.5), (1.0, 1.0, 1.0)), ((9, 3, 3), (1.0, 1.0, 1.0), (4.0, 0.5, 2.0)), ((1, 2, 5), (5.0, 1.0, 1.0), (1.0, 3.0, 0.7)), ((12, 1, 1), (1.0, 1.0, 1.0), (0.37, 1.0, 1.0))])
def test_regrid_is_the_nearest_cell(spark, shape, spacing, new):
    v = np.random.default_rng(0).integers(-1000, 1000, shape)
    rows = [(p, z, v[z].ravel().tolist()) for p in ("x", None) for z in range(shape[0])]
    df = spark.createDataFrame(rows, "p string, z long, px array<int>")
    out = voxels.regrid(df, "p", "z", "px", shape[2], spacing, new)
    want = nearest(v, spacing, new)
    for p in ("x", None):
        got = {r["t_z"]: r for r in out.where(F.col("p").eqNullSafe(F.lit(p))).collect()}
        assert sorted(got) == list(range(want.shape[0]))
        assert all(np.array_equal(np.array(r["v"]).reshape(r["rows"], r["cols"]), want[z]) for z, r in got.items())
        assert abs(got[0]["spacing_y"] - spacing[1] * shape[1] / want.shape[1]) < 1e-12
    long = voxels.cells(out, ["p"])
    assert long.count() == 2 * want.size and long.where("p = 'x' and t_z = 0 and t_y = 0 and t_x = 0").first()["v"] == want[0, 0, 0]
