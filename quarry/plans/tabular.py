"""Tabular model pipelines (SURVEY 2.12b pipe_skew_repair, pipe_policy_features,
pipe_person_features, pipe_claims)."""

from __future__ import annotations

import itertools
from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions import numeric as nm
from quarry.functions import text as tx
from quarry.operators import aggs, clean, features, joins, ml, sets, staged_trees, windows
from quarry.session import staged
from quarry.sources import io


def skew_repair(train: DataFrame, test: DataFrame, cols: Sequence[str], threshold: float = 0.25,
                rounds: int = 3) -> tuple[DataFrame, dict]:
    """Stack train and test, find columns skewed on train (> threshold), Box-Cox them (+1)
    with the likelihood over train and test together. Returns (stacked table, lambdas)."""
    both = sets.stack_by_name(train, test, "is_train")
    skewed = [r["column"] for r in aggs.skewed_columns(train, cols, threshold).collect()]
    if not skewed:
        return both, {}
    bc = features.BoxCox.fit(both, skewed, shift=1.0, rounds=rounds)
    return bc.transform(both), bc.lambdas


def policy_features(df: DataFrame, drop: Sequence[str], product_cols: Sequence[str], sentinel=-1,
                    cat_cols: Sequence[str] = (), train_flag: str | None = None) -> DataFrame:
    """Sentinel -> null first, then product feature, drop columns, one-hot with the
    vocabulary fitted on the training rows (prefixed names)."""
    d = clean.replace_sentinel(df, sentinel)
    d = d.withColumn("mult", clean.product(*product_cols)).drop(*drop)
    if cat_cols:
        fit_on = d.filter(F.col(train_flag)) if train_flag else d
        d = features.OneHot.fit(fit_on, list(cat_cols)).transform(d)
    return d


def person_features(people: DataFrame, flagged: DataFrame, key: str, name: str, segment: str, number: str) -> DataFrame:
    """Name length band, title and head of the name, family key (head + last 3 characters of
    the segment), membership flag, one-hot segment, chained fill of the numeric column."""
    p = people.select(key, name, segment, number,
                      nm.bin_left(tx.char_length(name), [13, 29], [0, 1, 2]).alias("name_band"),
                      tx.before_mark(name, "#").alias("head"),
                      tx.concat_null(tx.before_mark(name, "#"), tx.suffix(segment, 3)).alias("family"))
    p = joins.exists_flag(p, flagged, key, "flag")
    p = features.OneHot.fit(p, [segment]).transform(p)
    return features.fill_chained(p, [number, "name_band", "flag"], rounds=2)


def claims(train: DataFrame, test: DataFrame, key: str, target: str, num_cols: Sequence[str], cat_cols: Sequence[str],
           folds: int = 3, rounds: int = 2000, patience: int = 50, depth: int = 8, rate: float = 0.03, shift: float = 200.0,
           sqrt_cols: Sequence[str] = (), log_cols: Sequence[str] = (), power_cols: dict[str, tuple[float, float]] | None = None,
           out_base: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Skew repair -> categories outside both sets masked -> min-max scaling with a square root
    (``sqrt_cols``) or a logarithm (``log_cols``), clipped fourth roots (``power_cols``: column to
    (a, b)) -> pairs encoded base-26 -> categories base-26 (a missing value encodes as the word 'None') ->
    standardise -> one boosted model a contiguous fold on ln(target + shift), cut at its best round by
    ``patience`` -> fold-averaged test predictions back on the target scale, and an optional CSV named by the
    mean error. Returns the predictions and the report (a row a fold)."""
    both, _ = skew_repair(train, test.withColumn(target, F.lit(None).cast("double")), num_cols)
    both = sets.mask_uncommon(both, "is_train", cat_cols)
    for cols, post in ((list(sqrt_cols), "sqrt"), (list(log_cols), "log")):
        if cols:
            both = features.MinMaxScaler.fit(both, cols, post=post).transform(both)
    both = both.withColumns({c: nm.power_clip(c, a, b) for c, (a, b) in (power_cols or {}).items()}) if power_cols else both
    both = clean.pair_codes(both, list(cat_cols), encode=lambda c: tx.base26_text(c, none_word=True))
    both = both.select(*[tx.base26_text(c, none_word=True).cast("double").alias(c) if c in cat_cols else F.col(c) for c in both.columns])
    pair = [f"{a}_{b}" for a, b in itertools.combinations(list(cat_cols), 2)]
    both = both.withColumns({c: F.col(c).cast("double") for c in pair})
    feats = list(num_cols) + list(cat_cols) + pair
    both = staged(both, "claims")  # the fits below read it many times
    both = features.Standardizer.fit(both, list(num_cols)).transform(both)
    both = ml.assemble(both.withColumn("y", nm.log_shift(target, shift)), feats)
    tr = windows.fold_contiguous(both.filter("is_train").select(key, "y", "features"), [key], folds)
    te = both.filter(~F.col("is_train"))
    fit = lambda d, most: ml.boost_regressor(d, "y", rounds=most, depth=depth, rate=rate)
    pred, report = staged_trees.fold_average(tr, te, "fold", "y", fit, patience=patience, unscale=lambda v: np.exp(v) - shift, ceiling=rounds)
    pred = pred.select(key, F.col("prediction").alias(target))
    if out_base:
        io.write_csv(pred, io.named_sink_path(out_base, report.first()["mean_error"]))
    return pred, report
