"""Flagship: next-product rows over the whole orders table."""

from pyspark.sql import functions as F

from quarry.catalog.registry import query, t
from quarry.catalog.sqlfrag import py_round
from quarry.plans.next_product import next_product_rows, rank_next_products

FLAGS_SQL = """[CASE WHEN o_orderstatus='F' THEN 1 ELSE 0 END, CASE WHEN o_orderstatus='O' THEN 1 ELSE 0 END,
 CASE WHEN o_orderstatus='P' THEN 1 ELSE 0 END, CASE WHEN o_orderpriority='1-URGENT' THEN 1 ELSE 0 END,
 CASE WHEN o_orderpriority='2-HIGH' THEN 1 ELSE 0 END, CASE WHEN o_orderpriority='3-MEDIUM' THEN 1 ELSE 0 END,
 CASE WHEN o_orderpriority='4-NOT SPECIFIED' THEN 1 ELSE 0 END, CASE WHEN o_orderpriority='5-LOW' THEN 1 ELSE 0 END]"""


def lags_text(c):
    return F.array_join(F.transform(F.col(c), lambda x: x.cast("string")), ",")


@query("pipe_next_product", f"""
WITH f AS (SELECT o_orderkey, o_custkey, o_orderdate, o_totalprice, o_orderpriority, {FLAGS_SQL} AS flags FROM orders),
p AS (SELECT *, coalesce(lag(flags) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey), [0,0,0,0,0,0,0,0]) AS prev FROM f),
e AS (SELECT o_custkey, o_orderkey, o_totalprice, o_orderpriority, i - 1 AS label
      FROM p, range(1, 9) r(i) WHERE flags[i] - prev[i] > 0),
lv AS (SELECT o_orderkey, coalesce(flatten(list(flags) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey
       ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING)), []) AS l FROM f),
codes AS (SELECT o_orderpriority, CAST(row_number() OVER (ORDER BY o_orderpriority) - 1 AS INTEGER) AS code
          FROM (SELECT DISTINCT o_orderpriority FROM orders WHERE o_orderpriority IS NOT NULL))
SELECT e.o_custkey, e.o_orderkey, CAST(e.label AS INTEGER) AS label,
  ['st_F','st_O','st_P','pr_1','pr_2','pr_3','pr_4','pr_5'][e.label + 1] AS label_name,
  {py_round("(least(greatest(coalesce(e.o_totalprice, 150000.0), 0.0), 600000.0) - 0.0) / 600000.0", 6)} AS price_scaled,
  codes.code AS priority_code,
  array_to_string(list_concat([0 FOR z IN range(40 - len(lv.l))], lv.l), ',') AS lags
FROM e LEFT JOIN codes ON e.o_orderpriority = codes.o_orderpriority LEFT JOIN lv ON e.o_orderkey = lv.o_orderkey
""")
def pipe_next_product(spark, d):
    rows = next_product_rows(t(spark, d, "orders"))
    return rows.withColumn("lags", lags_text("lags"))


@query("pipe_next_product_rank")
def pipe_next_product_rank(spark, d):
    """Rows-only: next-product rows of orders up to 1999 train a forest; every customer's
    state at its latest order is scored; the 8 most probable flags, best first."""
    o = t(spark, d, "orders")
    return rank_next_products(o.filter(F.col("o_orderdate") < "2000-01-01"), o, k=8)
