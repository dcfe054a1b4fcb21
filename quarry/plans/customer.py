"""Customer-month cleaning and encoding (SURVEY 2.12b pipe_customer_clean, pipe_customer_encode,
pipe_read_clean, pipe_sample_store)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions import numeric as nm
from quarry.operators import clean, features, joins, ranking
from quarry.sources import io

# fixed values: status codes -> labels, balance bands
STATUS_LABELS = {"F": "Y", "O": "ex"}
BAL_EDGES = [-1e9, 0, 2500, 5000, 1e9]
BAL_LABELS = ["none", "low", "mid", "high"]


def customer_clean(rows: DataFrame, years: Sequence[int], drop_bad_rows: bool = True) -> DataFrame:
    """One pass over joined customer-order rows: keep the listed years, month and last-month
    flag, urgency flag, status label, balance with negatives as missing filled by the nation
    median (median of medians when a nation has none), balance band; rows with a tiny total
    are dropped when ``drop_bad_rows``."""
    spans = [(F.col("o_orderdate") >= f"{y:04d}-01-01") & (F.col("o_orderdate") < f"{y + 1:04d}-01-01") for y in years]
    r = rows.filter(reduce(lambda a, b: a | b, spans))
    last = r.agg(F.max("o_orderdate")).first()[0]
    month_start = f"{last.year:04d}-{last.month:02d}-01" if last else "1900-01-01"
    r = r.select("o_orderkey", "c_custkey", "c_nationkey", "o_totalprice", "o_orderpriority", "o_orderstatus",
                 nm.month_of("o_orderdate").alias("month"),
                 F.coalesce(nm.is_month("o_orderdate", month_start), F.lit(False)).alias("is_last"),
                 clean.flag("o_orderpriority", "1-URGENT").alias("is_urgent"),
                 nm.case_map("o_orderstatus", STATUS_LABELS, default="N").alias("status"),
                 F.when(F.col("c_acctbal") < 0, None).otherwise(F.col("c_acctbal")).alias("bal"))
    if drop_bad_rows:
        r = r.filter(F.col("o_totalprice") >= 1000)
    r = joins.fill_by_group_stat(r, "c_nationkey", "bal", "median")
    r = r.withColumn("band", nm.bin_right("bal", BAL_EDGES, BAL_LABELS))
    return r.select("o_orderkey", "c_custkey", "month", "is_last", "is_urgent", "status", "bal", "band")


def customer_encode(rows: DataFrame, col: str, top: int = 10) -> DataFrame:
    """Mode fill, keep the ``top`` most frequent values (others 'Rare'), then 0/1 columns."""
    filled = features.fill_mode(rows, [col])
    kept = ranking.keep_top_n(filled, col, top)
    return features.OneHot.fit(kept, [col]).transform(kept)


def read_clean_store(spark, csv_path: str, name: str, years: Sequence[int], orders: DataFrame) -> DataFrame:
    """Customer CSV (all text, 'NA' tokens) -> typed columns -> join orders -> clean -> named
    store, read back."""
    raw = io.read_csv(spark, csv_path)
    typed = io.retype(io.null_tokens(raw), {"c_custkey": "bigint", "c_nationkey": "int", "c_acctbal": "double"})
    rows = orders.join(typed.withColumnRenamed("c_custkey", "o_custkey"), "o_custkey").withColumnRenamed("o_custkey", "c_custkey")
    io.write_store(customer_clean(rows, years), name)
    return io.read_store(spark, name)


def sample_store(df: DataFrame, name: str, key: str, n: int | None, seed: str = "0") -> DataFrame:
    """Store a table by name, load it, keep all rows of n sampled keys (all rows when n is None)."""
    io.write_store(df, name)
    back = io.read_store(df.sparkSession, name)
    return back if n is None else joins.keep_sampled_keys(back, key, n, seed)
