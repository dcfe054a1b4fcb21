"""Voxel volumes: slice order and spacing, unit conversion, histogram, regrid.

Data model: slices (patient, slice_id, z, slope, intercept, pixels array<short>) or voxels
long (patient, z, y, x, v). Work is keyed by patient and slice; no volume is ever collected
whole into one row or task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.numeric import linear_int16_array
from quarry.operators.sequence import null_safe_join, row_index
from quarry.operators.windows import slice_spacing
from quarry.session import staged


# patients whose shapes or spacings are broadcast, a row each
FEW_PATIENTS = 200_000


def order_slices(slices: DataFrame, patient: str, z: str, ties: Sequence[str], fallback: str | None = None,
                 keep: Sequence[str] | None = None) -> DataFrame:
    """Slice index in z order per patient (a sliced scan; ``ties`` must make the order total),
    and the patient's slice spacing: |z of first - z of second|, or of the fallback location
    when z gives none. Without ``fallback`` the index is written once and the spacing read from it.
    ``keep``: the columns wanted besides patient, index and spacing."""
    idx = row_index(slices, [z, *ties], "slice_idx", key=[patient])
    if keep is not None:
        idx = idx.select(*dict.fromkeys([patient, "slice_idx", z, *([fallback] if fallback else []), *keep]))
    if fallback is None:
        idx = staged(idx, "slices")
    out = slice_spacing(idx, [patient], z, fallback=fallback, out="spacing", index="slice_idx", few=FEW_PATIENTS)
    return out if keep is None else out.select(*dict.fromkeys([patient, "slice_idx", "spacing", *keep]))


def to_units(slices: DataFrame, pixels: str, slope: str, intercept: str, out: str | None = None,
             sentinel: int | None = -2000) -> DataFrame:
    """Outside-of-scan sentinel -> 0, then slope * v (truncated) + intercept, kept in 16 bits."""
    return slices.withColumn(out or pixels, linear_int16_array(pixels, F.col(slope), F.col(intercept), sentinel))


def to_long(slices: DataFrame, keys: Sequence[str], pixels: str, width: int) -> DataFrame:
    """Slice rows of ``width`` x rows pixels -> voxels (keys..., y, x, v)."""
    e = slices.select(*keys, F.posexplode(pixels).alias("__p", "v"))
    return e.select(*keys, (F.col("__p") / width).cast("int").alias("y"), (F.col("__p") % width).cast("int").alias("x"), "v")


def histogram(voxels: DataFrame, v: str, bins: int = 80) -> DataFrame:
    from quarry.operators.aggs import histogram as h
    return h(voxels, v, bins)


def _source(t, new, old):
    """Source index of target ``t``: the nearest of ``old`` cells spread over ``new`` ones."""
    return F.when(new > 1, F.floor(t * (old - 1) / (new - 1) + 0.5)).otherwise(F.lit(0)).cast("int")


def _near_target(z, new, old):
    """About the first of ``new`` targets whose source is ``z`` or after it (``new``: none is), by the inverse of ``_source``."""
    at = F.ceil((z - 0.5) * (new - 1) / F.greatest(old - 1, F.lit(1)))
    return F.when(old > 1, F.least(F.greatest(at, F.lit(0)), new)).when(z > 0, new).otherwise(F.lit(0)).cast("int")


def _first_target(near, z, new, old):
    """The first of those targets: sources rise with the target, so it is ``near`` or beside it; ``_source`` decides."""
    takes = lambda t: (t >= 0) & (t < new) & (_source(t, new, old) >= z)
    return F.least(near + 1 - takes(near).cast("int") - takes(near - 1).cast("int"), new).cast("int")


def regrid(slices: DataFrame, patient: str, index: str, pixels: str, width, spacing: Sequence, new_spacing: Sequence[float],
           value: str = "v") -> DataFrame:
    """Resample each patient's volume to ``new_spacing`` (z, y, x): new shape = round(shape * spacing / new)
    (half-even, as NumPy rounds), actual new spacing = spacing * shape / new shape; every target cell
    takes the value of its nearest source cell (source index = round(t * (old - 1) / (new - 1)), order-0 zoom).

    ``slices`` are rows (patient, ``index``, ``pixels`` of ``width`` columns); ``spacing`` are numbers or columns,
    of which a patient's largest counts. The index maps of the axes are separate: a slice goes to the target
    slices that take it (none or several, found from its own index), and the pixels are gathered inside its
    array. Only the shapes (a row a patient) are joined; no voxel is shuffled, a null patient is a patient.
    Returns rows (patient, t_z, ``value`` array of the target slice, new shape and spacing of y and x)."""
    sz, sy, sx = (F.lit(float(s)) if isinstance(s, (int, float)) else F.col(s) for s in spacing)
    width = F.lit(width) if isinstance(width, int) else F.col(width)
    shapes = slices.groupBy(patient).agg((F.max(index) + 1).alias("__nz"), F.max(F.floor(F.size(pixels) / width)).alias("__ny"), F.max(width).alias("__nx"),
                                         F.max(sz).alias("__sz"), F.max(sy).alias("__sy"), F.max(sx).alias("__sx"))
    for a, ns in zip("zyx", new_spacing):
        shapes = shapes.withColumn(f"__m{a}", F.greatest(F.bround(F.col(f"__n{a}") * F.col(f"__s{a}") / F.lit(float(ns))), F.lit(1.0)).cast("int"))
        shapes = shapes.withColumn(f"spacing_{a}", F.col(f"__s{a}") * F.col(f"__n{a}") / F.col(f"__m{a}"))
    few = shapes.limit(FEW_PATIENTS + 1).count() <= FEW_PATIENTS
    rows = null_safe_join(slices.select(patient, F.col(index).cast("int").alias("__z"), F.col(pixels).alias("__p")), shapes, [patient], small=few)
    z, m, n = F.col("__z"), F.col("__mz"), F.col("__nz")
    # the targets that take slice z, each step a column of its own: written into one another they are evaluated many times
    rows = rows.withColumns({"__t0": _near_target(z, m, n), "__t1": _near_target(z + 1, m, n)})
    rows = rows.withColumns({"__t0": _first_target(F.col("__t0"), z, m, n), "__t1": _first_target(F.col("__t1"), z + 1, m, n) - 1})
    # outer, as Spark would infer a filter of the targets and push all that they are made of into the join
    targets = F.explode_outer(F.when(F.col("__t0") <= F.col("__t1"), F.sequence("__t0", "__t1")))
    my, mx, ny, nx = (F.col(f"__{c}") for c in ("my", "mx", "ny", "nx"))
    gathered = F.transform(F.sequence(F.lit(0), my * mx - 1), lambda k: F.get("__p", _source((k / mx).cast("int"), my, ny) * nx + _source(k % mx, mx, nx)))
    whole = (my == ny) & (mx == nx) & (F.size("__p") == my * mx)  # every cell is its own source
    gathered = F.when(whole, F.col("__p")).otherwise(gathered)
    out = rows.select(patient, targets.alias("t_z"), "__p", "__my", "__mx", "__ny", "__nx", "spacing_z", "spacing_y", "spacing_x").where(F.col("t_z").isNotNull())
    return out.select(patient, "t_z", gathered.alias(value), my.alias("rows"), mx.alias("cols"), "spacing_z", "spacing_y", "spacing_x")


def cells(grid: DataFrame, keys: Sequence[str], value: str = "v") -> DataFrame:
    """Rows of ``regrid`` as cells (keys..., t_z, t_y, t_x, value, spacings), each slice where it lies."""
    e = grid.select(*keys, "t_z", "cols", "spacing_z", "spacing_y", "spacing_x", F.posexplode(value).alias("__k", value))
    return e.select(*keys, "t_z", (F.col("__k") / F.col("cols")).cast("int").alias("t_y"), (F.col("__k") % F.col("cols")).cast("int").alias("t_x"), value, "spacing_z", "spacing_y", "spacing_x")
