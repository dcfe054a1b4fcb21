"""Steps that must stay cheap a row on large tables, with the results of their plain forms."""

import numpy as np
import pytest

from quarry.functions.text import base26_text
from quarry.operators import features, ml, signal, staged_trees, voxels, web, windows


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_spectra_are_not_a_python_call_a_group(spark):
    rows = [(g, i, float((i * 7 + (g or 0)) % 5)) for g in (1, 2, None) for i in range(8)] + [(1, 9, 2.0), (2, 3, None)]
    df = spark.createDataFrame(rows, "g long, s long, v double")
    out = signal.spectrum_fft(df, ["g"], "s", "v", 8)
    assert "FlatMapGroupsInPandas" not in _plan(out)
    got = {(r["g"], r["k"]): r["mag"] for r in out.collect()}
    for g in (1, None):
        x = np.array([float((i * 7 + (g or 0)) % 5) for i in range(8)])
        x[1] += 2.0 if g == 1 else 0.0
        want = np.abs(np.fft.fft(x))
        assert got[g, 0] == 0.0
        assert np.allclose([got[g, k] for k in range(1, 8)], want[1:], atol=1e-12)
    assert got[2, 0] == 0.0 and got[2, 1] is None


def test_base26_text_is_not_a_fold_over_limbs(spark):
    df = spark.createDataFrame([("AB" * 2000,), ("",), (None,), ("None",), ("!!",)], "s string")
    out = df.select("s", base26_text("s").alias("n"), base26_text("s", none_word=True).alias("w"))
    assert "aggregate(" not in _plan(out)
    got = {r["s"]: (r["n"], r["w"]) for r in out.collect()}
    long = 0
    for ch in "AB" * 2000:
        long = long * 26 + ord(ch) - 64
    tens, rest = [], long  # str() of a number this long is refused
    while rest:
        rest, part = divmod(rest, 10 ** 18)
        tens.append(str(part).zfill(18))
    assert got["AB" * 2000][0] == "".join(reversed(tens)).lstrip("0")
    assert got[""] == ("0", "0") and got["!!"][0] == str(-31 * 27)
    assert got[None] == (None, got["None"][0])


def test_boxcox_sums_are_not_one_wide_aggregate(spark):
    xs = [0.5, 1.0, 2.5, 8.0, 100.0, 3.0]
    df = spark.createDataFrame([(x, 7.0) for x in xs] + [(None, 7.0)], "a double, b double").repartition(3)
    grid = [-1.0, 0.0, 0.5, 2.0, 400.0]
    out = features.boxcox_logliks(df, {"a": grid, "b": grid}, 1.0)
    assert "var_pop" not in _plan(out)
    got = {(r["column"], r["lambda"]): r["llf"] for r in out.collect()}
    assert len(got) == 10 and all(got["b", g] is None for g in grid[:4]) and got["a", 400.0] is None
    x = np.array(xs) + 1
    for lam in grid[:4]:
        y = np.log(x) if lam == 0 else (x ** lam - 1) / lam
        assert got["a", lam] == pytest.approx((lam - 1) * np.log(x).sum() - len(x) / 2 * np.log(y.var()), rel=1e-9)


def test_boxcox_without_positive_values_has_no_likelihood(spark):
    df = spark.createDataFrame([(-3.0,), (-5.0,), (float("nan"),)], "a double").where("a < 0")
    assert all(r["llf"] is None for r in features.boxcox_logliks(df, {"a": [0.0, 2.0]}, 1.0).collect())


def test_training_rows_of_folds_are_evaluated_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(len(b))
            yield b
    rows = spark.createDataFrame([(i, float(i % 7), float(i % 3), i % 3) for i in range(300)], "k long, y double, a double, fold int")
    counted = ml.assemble(rows.mapInPandas(count, rows.schema), ["a"])
    fit = lambda d: ml.boost_regressor(d, "y", rounds=2, depth=2, rate=0.3)
    out, report = staged_trees.fold_average(counted, ml.assemble(rows, ["a"]), "fold", "y", fit, patience=1)
    assert seen.value == 300 and report.count() == 3 and out.count() == 300


def test_spacing_is_taken_from_the_places(spark):
    df = spark.createDataFrame([(p, float(z), z) for p in (1, 2) for z in (5, 9, 30 * p)] + [(3, 1.0, 1)], "p long, z double, t int")
    out = voxels.order_slices(df, "p", "z", ["t"])
    assert _plan(out).count("row_number") == 0
    plain = windows.slice_spacing(df, ["p"], "z")
    spacing = lambda d: sorted((r["p"], r["spacing"]) for r in d.select("p", "spacing").distinct().collect() if r["p"] < 3)
    assert spacing(out) == spacing(plain) == [(1, 4.0), (2, 4.0)]
    assert [r["spacing"] for r in out.where("p = 3").collect()] == [None]


def test_edges_are_not_made_distinct_for_a_walk(spark, monkeypatch):
    edge = spark.createDataFrame([("a", "b"), ("a", "b"), ("a", "c"), ("b", "d"), ("d", "a"), ("c", "d"), (None, "d"), ("d", None)], "src string, dst string")
    counts = spark.createDataFrame([("a", 1), ("b", 3), ("c", 2), ("d", 9)], "url string, count long")
    written = []
    monkeypatch.setattr(web, "staged", lambda df, name: (written.append((name, _plan(df))), df)[1])
    for few in (200_000, 0):
        monkeypatch.setattr(web, "FEW_NODES", few)
        layers = sorted((r["node"], r["layer"], r["count"]) for r in web.expand_above_mean(edge, counts, "a", 3).collect())
        assert layers == [("a", 0, 1), ("b", 1, 3), ("c", 1, 2), ("d", 2, 9)]
        best = sorted((r["node"], r["round"], r["count"]) for r in web.best_first(edge, counts, "a", 3).collect())
        assert best == [("a", 0, 1), ("b", 1, 3), ("c", 1, 2), ("d", 2, 9)]
    assert written and all("HashAggregate(keys=[__s" not in p or "node" not in p.split("HashAggregate(keys=[__s")[1].split("]")[0] for _, p in written)


class _Task:
    """Stands for a table: keeps the function of its tasks, to be called in this process."""

    def mapInArrow(self, run, schema):
        self.run = run
        return self


def test_counting_ngrams_holds_few_bytes_a_token():
    import tracemalloc

    import pyarrow as pa

    from quarry.llm import ngram

    rng = np.random.default_rng(0)
    texts = [" ".join(f"w{x}" for x in rng.zipf(1.3, 2000) % 50_000).encode() for _ in range(200)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.binary())], ["text"])
    none = np.empty(0, np.uint64)
    model = {"path": "", "buckets": 8, "order": 3, "base": np.zeros(8, np.uint64), "distinct": 7, "hot": {2: none, 3: none}, "present": {1: frozenset()}}
    for task, most in ((ngram.surveyed(_Task(), 3, 8), 60), (ngram.counted(_Task(), model), 80)):
        tracemalloc.start()
        rows = sum(b.num_rows for b in task.run(iter([batch])))
        peak = tracemalloc.get_traced_memory()[1] / (200 * 2001)
        tracemalloc.stop()
        assert rows and peak < most


def test_repeats_move_no_texts(spark):
    from quarry.llm import repeats

    passage = " ".join(f"p{i}" for i in range(30))
    df = spark.createDataFrame([(1, passage + " a b"), (2, "x y " + passage), (3, None), (None, "one two"), (4, passage + " a b")], "doc_id long, text string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        out = repeats.deduplicated(df)
        plan = _plan(out)
        got = {r["doc_id"]: (r["repeats"]["n_removed"], r["repeats"]["kept"]) for r in out.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "Join" not in plan and "Exchange" not in plan
    assert got == {1: (0, passage + " a b"), 2: (30, "x y"), 3: (0, ""), None: (0, "one two"), 4: (32, "")}


def test_knn_sends_vectors_not_blocks(spark):
    from quarry.operators import neighbors

    rng = np.random.default_rng(1)
    v = rng.normal(size=(60, 4))
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)] + [(60, None)], "id long, v array<double>")
    out = neighbors.knn(df.where("id < 20").withColumnRenamed("id", "qid"), df.where("id >= 20").withColumnRenamed("id", "pid"), 3, "qid", "pid", "v", block_rows=16, query_rows=5)
    assert "collect_list" not in _plan(out)
    got = {(r["qid"], r["rank"]): r["pid"] for r in out.collect()}
    for i in range(20):
        d = ((v[20:] - v[i]) ** 2).sum(axis=1)
        assert [got[i, r] for r in (1, 2, 3)] == (20 + np.argsort(d, kind="stable")[:3]).tolist()
    assert len(got) == 60


def test_segments_are_dealt_once_and_large_ones_in_rounds(spark, monkeypatch):
    from quarry.operators import logistic

    rng = np.random.default_rng(2)
    rows = [(None if s == 2 else int(s), float(t), [float(a), float(b), 3.0]) for s, t, a, b in zip(rng.integers(0, 40, 900) % 12 % 7, rng.integers(0, 2, 900), rng.normal(size=900), rng.normal(size=900))]
    df = spark.createDataFrame(rows, "seg long, y double, x array<double>").repartition(3)
    names, write = [], logistic.staged
    monkeypatch.setattr(logistic, "staged", lambda df, name: names.append(name) or write(df, name))
    once = {r["seg"]: r for r in logistic.segmented(df, "seg", "y", "x", 0.1).collect()}
    assert len(names) == 2 and len(once) == 7 and sum(r["n"] for r in once.values()) == 900
    monkeypatch.setattr(logistic, "LOCAL_ROWS", 140)
    mixed = {r["seg"]: r for r in logistic.segmented(df, "seg", "y", "x", 0.1).collect()}
    assert "logistic-state" in names and set(mixed) == set(once)
    for s, r in once.items():
        assert r["n"] == mixed[s]["n"] and np.allclose(r["coefficients"], mixed[s]["coefficients"], atol=1e-7) and abs(r["intercept"] - mixed[s]["intercept"]) < 1e-7


def test_grid_evaluates_its_rows_once(spark):
    from pyspark.sql import functions as F
    from quarry.operators import logistic

    seen = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def noted(a):
        seen.add(1)
        return a

    rng = np.random.default_rng(3)
    rows = [(i % 3, float(t), float(a)) for i, (t, a) in enumerate(zip(rng.integers(0, 2, 300), rng.normal(size=300)))]
    df = spark.createDataFrame(rows, "fold int, y double, a double").withColumn("x", F.array(noted.asNondeterministic()("a")))
    assert logistic.grid(df, "fold", "y", "x", [(0.1, 0.0)])["scans"] > 4
    assert 300 <= seen.value <= 600
