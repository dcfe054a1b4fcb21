"""Series, spectra and volume pipelines (SURVEY 2.12b pipe_series_train, pipe_spectrum,
pipe_spectra_match, pipe_volume)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.numeric import row_standardize
from quarry.operators import clean, joins, signal, spectra, voxels, windows
from quarry.session import staged


def series_train(samples: DataFrame, allow: DataFrame, series: str, channel: str, order: list, value: str,
                 epoch_size: int, fs: float, allow_cond=None) -> DataFrame:
    """Allow list -> epochs -> feature vector per (series, epoch) -> rows with NaN dropped ->
    each vector standardised. Returns (series, epoch, features)."""
    s = joins.keep_allowed(samples, allow, series, allow_cond)
    ep = windows.epochs_by_position(s, [series, channel], order, epoch_size)
    feats = signal.features(ep, series, channel, "epoch", "seq", value, fs, epoch_size)
    kept = clean.drop_nan_rows(feats, "features")
    return row_standardize(kept, "features", "features")


def spectrum(points: DataFrame, label: str, x: str, y: str, start: int, points_out: int, degree: int = 3) -> DataFrame:
    return spectra.preprocess(points, label, x, y, start, degree, points_out)


def spectra_match(test: DataFrame, library: DataFrame, label: str, x: str, y: str, start: int, points_out: int,
                  pure_threshold: float = 0.3) -> DataFrame:
    """Preprocess library and test spectra onto their grids, match every test spectrum; for
    mixtures also the secondary component. (label, best, error, is_mixture, second, second_error)."""
    lib = spectrum(library, label, x, y, start, points_out).withColumnRenamed(label, "ref")
    tst = spectrum(test, label, x, y, start, points_out)
    first = spectra.identify(tst, lib, label, "ref", "i", y, pure_threshold)
    second = spectra.identify_second(tst, lib, label, "ref", "i", y, pure_threshold)
    return first.join(second.select(label, "second", "second_error"), label, "left")


def volume(slices: DataFrame, patient: str, z: str, ties: list, pixels: str, slope: str, intercept: str, width: int,
           new_spacing: tuple[float, float, float], pixel_spacing: tuple[float, float] = (1.0, 1.0)) -> tuple[DataFrame, DataFrame]:
    """Order slices and find their spacing, convert to units, histogram of all voxels, regrid
    to ``new_spacing`` (z, y, x). Returns (histogram, regridded slices, a row each)."""
    s = voxels.to_units(slices, pixels, slope, intercept, out="hu").select(*dict.fromkeys([patient, z, *ties, "hu"]))
    s = staged(voxels.order_slices(s, patient, z, ties, keep=["hu"]), "volume")  # read four times below
    hist = voxels.histogram(s.select(F.explode("hu").alias("v")).select(F.col("v").cast("double").alias("v")), "v", 80)
    return hist, voxels.regrid(s, patient, "slice_idx", "hu", width, ("spacing", *pixel_spacing), list(new_spacing))
