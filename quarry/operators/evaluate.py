"""Evaluation metrics as aggregates over (label, prediction) tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.operators.windows import gini_normalized


def mae(df: DataFrame, y: str, p: str, inverse=None) -> DataFrame:
    """Mean absolute error, optionally after an inverse transform applied to both columns."""
    f = inverse or (lambda c: c)
    return df.agg(F.avg(F.abs(f(F.col(y)) - f(F.col(p)))).alias("mae"))


def class_report(df: DataFrame, y: str, p: str) -> DataFrame:
    """Per class: precision, recall, F1 and support, from one grouped count of (label, pred)."""
    pairs = df.groupBy(F.col(y).alias("__y"), F.col(p).alias("__p")).count()
    tp = pairs.filter(F.col("__y") == F.col("__p")).select(F.col("__y").alias("cls"), F.col("count").alias("tp"))
    sup = pairs.groupBy(F.col("__y").alias("cls")).agg(F.sum("count").alias("support"))
    pred = pairs.groupBy(F.col("__p").alias("cls")).agg(F.sum("count").alias("predicted"))
    j = sup.join(pred, "cls", "full").join(tp, "cls", "left").fillna(0, ["tp", "support", "predicted"])
    prec = F.when(F.col("predicted") > 0, F.col("tp") / F.col("predicted")).otherwise(F.lit(0.0))
    rec = F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(F.lit(0.0))
    f1 = F.when(prec + rec > 0, 2 * prec * rec / (prec + rec)).otherwise(F.lit(0.0))
    return j.select("cls", prec.alias("precision"), rec.alias("recall"), f1.alias("f1"), F.col("support").cast("long").alias("support"))


def accuracy_logloss(df: DataFrame, y: str, p: str, prob: str | None = None, eps: float = 1e-15) -> DataFrame:
    """Accuracy of hard predictions and, given P(y = 1), binary log loss (clipped)."""
    aggs = [F.avg((F.col(y) == F.col(p)).cast("double")).alias("accuracy")]
    if prob:
        q = F.least(F.greatest(F.col(prob), F.lit(eps)), F.lit(1 - eps))
        aggs.append(F.avg(-(F.col(y) * F.ln(q) + (1 - F.col(y)) * F.ln(1 - q))).alias("logloss"))
    return df.agg(*aggs)


def recall(df: DataFrame, y: str, p: str, positive=1) -> DataFrame:
    """Found share of the positives; null when there is none."""
    found = F.sum(((F.col(y) == positive) & (F.col(p) == positive)).cast("long"))
    return df.agg(F.try_divide(found, F.sum((F.col(y) == positive).cast("long"))).alias("recall"))


def average_precision_at_k(actual: Column, predicted: Column, k: int = 7) -> Column:
    """AP@k of one row: ranked predictions against a set of actual items (duplicates counted
    once), divided by min(|actual|, k); empty actual -> 0."""
    top = F.slice(predicted, 1, k)
    hits = F.transform(top, lambda x, i: F.when(F.array_contains(actual, x) & ~F.array_contains(F.slice(top, 1, i), x),
                                                 F.lit(1.0)).otherwise(F.lit(0.0)))
    cum = F.transform(hits, lambda h, i: F.aggregate(F.slice(hits, 1, i + 1), F.lit(0.0), lambda a, b: a + b))
    prec_at = F.zip_with(hits, cum, lambda h, c: h * c)
    ranked = F.transform(prec_at, lambda v, i: v / (i + 1))
    s = F.aggregate(ranked, F.lit(0.0), lambda a, b: a + b)
    den = F.least(F.size(actual), F.lit(k))
    return F.when(den > 0, s / den).otherwise(F.lit(0.0))


def map_at_k(df: DataFrame, actual: str, predicted: str, k: int = 7) -> DataFrame:
    return df.agg(F.avg(average_precision_at_k(F.col(actual), F.col(predicted), k)).alias(f"map_at_{k}"))


def gini_score(df: DataFrame, y: str, p: str, tie: str) -> DataFrame:
    """Normalised Gini of scores ``p`` (hard labels work the same way, with many ties)."""
    return gini_normalized(df, y, p, tie)
