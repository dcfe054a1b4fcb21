"""Hand-made unit tables (FIXTURES part 3)."""

from pyspark.sql import functions as F

from quarry.functions import numeric as nm
from quarry.functions import text as tx
from quarry.operators import aggs, joins, ranking, windows


def test_base26(spark):
    df = spark.createDataFrame([("A",), ("Z",), ("AB",), (None,)], "s string")
    got = [r[0] for r in df.select(tx.base26("s")).collect()]
    assert [None if g is None else int(g) for g in got] == [1, 26, 28, None]
    assert int(df.filter(F.col("s").isNull()).select(tx.base26("s", none_word=True)).first()[0]) == 279069


def test_bins_on_edges(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (1.5,), (2.0,), (3.0,), (None,)], "x double")
    right = [r[0] for r in df.select(nm.bin_right("x", [0, 1, 2], ["a", "b"], outside="nan")).collect()]
    assert right == ["nan", "a", "b", "b", "nan", "nan"]
    df2 = spark.createDataFrame([(0.9,), (1.0,), (3.9,), (4.0,), (None,), (float("nan"),)], "x double")
    left = [r[0] for r in df2.select(nm.bin_left("x", [1, 4], ["lo", "mid", "hi"])).collect()]
    assert left == ["lo", "mid", "mid", "hi", "hi", "hi"]


def test_lag_vector_padding_and_order(spark):
    rows = []
    for cust, n in [(1, 0), (2, 1), (3, 5), (4, 7)]:
        for i in range(n):
            rows.append((cust, 100 - i, [cust, i]))  # dates descend with i: input order is not time order
    df = spark.createDataFrame(rows or [(0, 0, [0, 0])], "c long, d long, v array<int>")
    out = {r["c"]: r["lags"] for r in windows.lag_vector(df, ["c"], ["d"], "v", 5, 2, last=True).collect()}
    assert 1 not in out
    assert out[2] == [0] * 8 + [2, 0]
    assert out[3] == [3, 4, 3, 3, 3, 2, 3, 1, 3, 0]
    assert out[4] == [4, 4, 4, 3, 4, 2, 4, 1, 4, 0]


def test_asof_snapshot_cases(spark):
    left = spark.createDataFrame([(1, 10), (2, 10), (3, 10), (4, 10)], "k long, t long")
    right = spark.createDataFrame([(2, 5, 1.0), (3, 3, 1.0), (3, 7, 2.0), (4, 12, 9.0)], "k long, t long, v double")
    got = {r["k"]: r["v"] for r in joins.asof_snapshot(left, right, "k", "t", "t", "v").collect()}
    assert got == {1: None, 2: 1.0, 3: 2.0, 4: None}


def test_gini_edge_cases(spark):
    perfect = spark.createDataFrame([(i, 1 if i >= 5 else 0, float(i)) for i in range(10)], "id long, y long, p double")
    assert abs(windows.gini(perfect, "y", "p", "id").first()["gini"] - 1.0) < 1e-12
    rev = perfect.withColumn("p", -F.col("p"))
    assert abs(windows.gini(rev, "y", "p", "id").first()["gini"] + 1.0) < 1e-12
    one = perfect.withColumn("y", F.lit(1).cast("long"))
    assert windows.gini(one, "y", "p", "id").first()["gini"] is None


def test_folds_sizes(spark):
    df = spark.createDataFrame([(i,) for i in range(10)], "id long")
    sizes = sorted((r["fold"], r["count"]) for r in windows.fold_contiguous(df, ["id"], 3).groupBy("fold").count().collect())
    assert sizes == [(0, 4), (1, 3), (2, 3)]


def test_links_and_word_count(spark):
    pages = spark.createDataFrame([
        ('<a href="http://a.org/x">x</a> <a href="https://b.org">b</a> <a href="/rel">r</a>',),
        ("<a href='single' title=\"t\">",),
        ('no links here "',),
    ], "html string")
    got = [r[0] for r in pages.select(tx.links("html", must_contain="http:")).collect()]
    assert got == [["http://a.org/x"], [], []]
    got_any = [r[0] for r in pages.select(tx.links("html", must_contain=None)).collect()]
    assert got_any[0] == ["http://a.org/x", "https://b.org", "/rel"]
    assert got_any[1] == ["t"]  # the first double-quoted value after href=
    txt = spark.createDataFrame([("aa aaa AA",), ("aaa",), ("",)], "t string")
    assert [r[0] for r in txt.select(tx.count_word("t", "aa")).collect()] == [3, 1, 0]


def test_mode_and_top_ties(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), ("c",), (None,)], "v string")
    assert aggs.mode(df, "v").first()["mode"] == "a"
    kept = {r["v"] for r in ranking.keep_top_n(df, "v", 2).collect()}
    assert kept == {"a", "b", "Rare"}


def test_round_exact_matches_python(spark):
    vals = [0.31475, 0.10825, 0.125, 2.675, -0.31475, 1.0005]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = [r[0] for r in df.select(nm.round_exact("x", 4)).collect()]
    assert got == [round(v, 4) for v in vals]


def test_median_skew_safe(spark):
    df = spark.createDataFrame([(0 if i < 40 else i, float(i)) for i in range(60)], "g long, x double")
    got = {r["g"]: r["median"] for r in aggs.median(df, "g", "x").collect()}
    assert got[0] == 19.5 and got[45] == 45.0


def test_sparse_onehot(spark):
    from quarry.operators.features import sparse_onehot
    df = spark.createDataFrame([("a",), ("b",), ("a",), (None,)], "c string")
    out = sparse_onehot(df, ["c"]).collect()
    sizes = {r["c_vec"].size for r in out}
    assert sizes == {3}  # a, b and the slot for null / unseen
    assert out[0]["c_vec"][0] == 1.0  # most frequent value first


def test_residual_curves_of_every_pair(spark):
    from quarry.operators import spectra
    test = spark.createDataFrame([("a", 0, 1.0), ("a", 1, None), ("b", 0, 3.0), ("b", 5, 9.0)], "label string, i int, y double")
    lib = spark.createDataFrame([("p", 0, 0.5), ("p", 1, 1.0), ("q", 0, 4.0)], "ref string, i int, y double")
    want = {("a", "p", 0, 0.5), ("a", "p", 1, None), ("a", "q", 0, -3.0), ("b", "p", 0, 2.5), ("b", "q", 0, -1.0)}
    assert {tuple(r) for r in spectra.residual_curves(test, lib).collect()} == want
    assert spectra.residual_curves(test.limit(0), lib).count() == 0
