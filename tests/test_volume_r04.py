"""Steps of the volume pipeline: units of whole batches, one ordering, slices to targets without a search."""

import math

import pytest
from pyspark.sql import functions as F

from quarry.functions.numeric import linear_int16, linear_int16_array
from quarry.operators import voxels


def _plan(df):
    return df._jdf.queryExecution().toString()


@pytest.mark.parametrize("kind", ["short", "double"])
@pytest.mark.parametrize("sentinel", [-2000, None])
def test_units_of_a_batch_are_those_of_each_element(spark, kind, sentinel):
    nan, inf = float("nan"), float("inf")
    extra = [0.5, -7.9, nan, inf, -inf] if kind == "double" else []
    px = [[1.0, -2000.0, None, 32767.0, -32768.0, 7.0, *extra], [], None, [None], [-2000.0, 3.0]]
    numbers = [None, nan, 1.0, 1.5, -2.25, 0.0, 1e9, inf, -inf]
    rows = [(i, p, s, c) for i, (p, s, c) in enumerate((p, s, c) for p in px for s in numbers for c in [*numbers, -1024.0])]
    df = spark.createDataFrame(rows, "id int, p array<double>, s double, c double").withColumn("p", F.col("p").cast(f"array<{kind}>"))

    def one(v):
        return linear_int16(F.when(v == F.lit(sentinel), F.lit(0)).otherwise(v) if sentinel is not None else v, F.col("s"), F.col("c"))
    got = df.select("id", linear_int16_array("p", "s", "c", sentinel).alias("a"), F.transform("p", one).alias("b"))
    assert got.schema["a"].dataType.simpleString() == "array<smallint>"
    assert [r for r in got.collect() if r["a"] != r["b"]] == []
    assert linear_int16_array is not None and "lambdafunction" not in _plan(df.select(linear_int16_array("p", "s", "c")))


def test_places_are_ordered_once_for_the_spacing(spark):
    df = spark.createDataFrame([(p, float(z), z) for p in (1, 2, None) for z in (5, 9, 30)] + [(3, 1.0, 1)], "p long, z double, t int")
    out = voxels.order_slices(df, "p", "z", ["t"])
    assert "Window" not in _plan(out)  # read from what was written
    assert sorted((r["p"] or 0, r["t"], r["slice_idx"], r["spacing"] or 0.0) for r in out.collect()) == sorted(
        [(p, t, i, 4.0 if p else 0.0) for p in (1, 2, 0) for i, t in enumerate((5, 9, 30))] + [(3, 1, 0, 0.0)])


@pytest.mark.parametrize("few", [200_000, 0])
def test_slices_go_to_the_targets_that_take_them(spark, monkeypatch, few):
    monkeypatch.setattr(voxels, "FEW_PATIENTS", few)
    shapes = [(n, m) for n in (1, 2, 3, 7, 50) for m in (1, 2, 3, 5, 13, 49, 50, 51, 150)]
    rows = [(p, z, n / m, [z]) for p, (n, m) in enumerate(shapes) for z in range(n)]
    df = spark.createDataFrame(rows, "p long, z long, s double, px array<int>")
    out = voxels.regrid(df, "p", "z", "px", 1, ("s", 1.0, 1.0), (n_m := 1.0, 1.0, 1.0))
    got = {}
    for r in out.collect():
        got.setdefault(r["p"], []).append((r["t_z"], r["v"][0]))
    for p, (n, m) in enumerate(shapes):
        new = max(1, round(n * (n / m) / n_m))
        assert sorted(got[p]) == [(t, math.floor(t * (n - 1) / (new - 1) + 0.5) if new > 1 else 0) for t in range(new)]
    plan = _plan(out)  # no search over the targets, and nothing of them in the join
    assert "filter(sequence(" not in plan and all("CEIL" not in x.upper() for x in plan.split("\n") if "Join" in x)
