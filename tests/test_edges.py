"""Edge inputs: lags before the labelled row, null keys, ties, single points, flat series."""

import math
import statistics

from pyspark.sql import functions as F

from quarry.operators import aggs, evaluate, features, joins, ml, neighbors, signal, spectra, windows
from quarry.plans.next_product import next_product_rows


def test_lags_hold_only_earlier_orders(spark):
    rows = [(i, 1, f"2000-01-{i:02d}", 100.0, f"{i % 5 + 1}-X", "FOP"[i % 3]) for i in range(1, 9)]
    df = spark.createDataFrame(rows, "o_orderkey long, o_custkey long, o_orderdate string, o_totalprice double, o_orderpriority string, o_orderstatus string")
    got = {r["o_orderkey"]: r["lags"] for r in next_product_rows(df).collect()}
    flags = {k: [int(s == x) for x in "FOP"] + [0] * 5 for k, _, _, _, _, s in rows}
    for k, lags in got.items():
        before = [flags[j] for j in range(max(1, k - 5), k)]
        assert lags == [0] * (40 - 8 * len(before)) + [x for f in before for x in f]


def test_asof_null_keys_and_native_ties(spark):
    left = spark.createDataFrame([(1, "a", 5), (2, None, 5)], "id long, k string, t long")
    right = spark.createDataFrame([("a", 3, 9.0), ("a", 3, 10.0), (None, 3, 7.0)], "k string, t long, v double")
    got = {r["id"]: r["v"] for r in joins.asof_snapshot(left, right, "k", "t", "t", "v").collect()}
    assert got == {1: 10.0, 2: None}


def test_regrid_of_one_point(spark):
    df = spark.createDataFrame([("p", 2.0, 7.0), ("q", 0.0, 0.0), ("q", 1.0, 1.0)], "label string, x double, y double")
    got = [(r["label"], r["i"], r["x"], r["y"]) for r in spectra.regrid(df, "label", "x", "y", 3).collect()]
    assert sorted(got) == [("p", 0, 2.0, 7.0), ("p", 1, 2.0, 7.0), ("p", 2, 2.0, 7.0), ("q", 0, 0.0, 0.0), ("q", 1, 0.5, 0.5), ("q", 2, 1.0, 1.0)]


def test_flat_series_and_zero_maxima(spark):
    df = spark.createDataFrame([(1, i, 3.0) for i in range(6)], "ch long, seq long, v double")
    assert windows.hjorth(df, ["ch"], ["seq"], "v").first()["mobility"] is None
    y = spark.createDataFrame([(0, 1), (0, 0)], "y int, p int")
    assert evaluate.recall(y, "y", "p").first()["recall"] is None
    z = spark.createDataFrame([(0.0,), (0.0,)], "x double")
    assert [r["x"] for r in features.MaxScaler.fit(z, ["x"]).transform(z).collect()] == [None, None]
    flat = df.select(F.lit(1).alias("s"), "ch", F.lit(0).alias("e"), "seq", F.lit(0.0).alias("v"))
    assert signal.features(flat, "s", "ch", "e", "seq", "v", 64.0, 8).count() == 1


def test_spectrum_wraps_samples_past_the_period(spark):
    df = spark.createDataFrame([(1, i, float(i * i % 7)) for i in range(12)], "g long, seq long, v double")
    got = {r["k"]: r["mag"] for r in signal.spectrum_fft(df, ["g"], "seq", "v", 8).collect()}
    want = {r["k"]: r["mag"] for r in signal.spectrum_dft(df, ["g"], "seq", "v", 8, 8, norm_keys=["g"]).collect()}
    assert all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_dyadic_bands():
    assert signal.dyadic_bands(64) == [(2, 2), (3, 4), (5, 8), (9, 16), (17, 32)] and signal.dyadic_bands(3) == []


def test_knn_in_blocks(spark):
    p = spark.createDataFrame([(i, [float(i % 10), float(i // 10)]) for i in range(100)] + [(100, None)], "pid long, v array<double>")
    q = p.withColumnRenamed("pid", "qid").filter("qid < 20")
    got = neighbors.knn(q, p, 4, "qid", "pid", "v", block_rows=7, query_rows=3).collect()
    for i in range(20):
        want = sorted((math.dist((i % 10, i // 10), (j % 10, j // 10)), j) for j in range(100))[:4]
        assert [(r["dist"], r["pid"]) for r in sorted(got, key=lambda r: r["rank"]) if r["qid"] == i] == want
    assert neighbors.knn(q.limit(0), p, 4, "qid", "pid", "v").count() == 0 and neighbors.knn(q, p.limit(0), 4, "qid", "pid", "v").count() == 0


def test_null_groups_are_kept(spark):
    df = spark.createDataFrame([(i, None if i < 4 else "a", float(i)) for i in range(9)], "id long, g string, x double")
    assert {r["g"]: r["median"] for r in aggs.median(df, "g", "x").collect()} == {None: 1.5, "a": 6.0}
    assert windows.fold_stratified(df, "g", "id", 2).count() == 9
    assert windows.epochs_by_position(df, ["g"], ["id"], 2).count() == 8
    assert ml.class_weights(df, "g").count() == 9
    assert {r["g"] for r in aggs.crosstab(df, "g", "id", "index").collect()} == {None, "a"}


def test_median_of_repeated_values(spark):
    for v in ([1, 1, 1, 5], [1, 2, 2, 3], [4], [1, 9], [7, 7]):
        df = spark.createDataFrame([(float(x),) for x in v], "x double")
        assert aggs.median(df, None, "x").first()[0] == statistics.median(v)


def test_convolution_of_every_main_with_every_entry(spark):
    """Several mains, odd, even and unequal lengths, as numpy's 'same' mode."""
    import numpy as np
    r = np.random.default_rng(4)
    curves = {k: r.random(n) for k, n in enumerate((5, 8, 8, 1, 13))}
    df = spark.createDataFrame([(k, 3 + i, float(v)) for k, c in curves.items() for i, v in enumerate(c)], "ref int, i int, y double").repartition(3)
    mains = df.where("ref in (1, 2, 4)").withColumnRenamed("ref", "main")
    got = {(x["main"], x["ref"], x["k"]): x["conv"] for x in spectra.convolve_same(mains, df, "main", "ref", "i", "y").collect()}
    want = {(a, b, k): v for a in (1, 2, 4) for b in curves for c in [np.convolve(curves[a], curves[b], mode="same")] for k, v in enumerate(c / c.max())}
    assert set(got) == set(want) and all(abs(got[x] - want[x]) < 1e-12 for x in want)
