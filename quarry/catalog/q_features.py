"""Feature transformers over the test tables."""

from pyspark.sql import functions as F

from quarry.catalog.present import stable_round
from quarry.catalog.registry import query, t
from quarry.catalog.sqlfrag import stable_round as sround
from quarry.operators import features as fe

GRID = [-2.0 + 0.5 * i for i in range(9)]


@query("fe_boxcox_loglik", f"""WITH g AS (SELECT unnest({GRID}) AS lam), x AS (SELECT l_extendedprice + 1.0 AS x FROM lineitem),
s AS (SELECT count(*) AS n, sum(ln(x)) AS sl FROM x),
v AS (SELECT lam, var_pop(CASE WHEN lam = 0 THEN ln(x) ELSE (pow(x, lam) - 1) / lam END) AS v FROM g, x GROUP BY lam)
SELECT CAST(lam AS DOUBLE) AS lambda, {sround("(lam - 1) * sl - n / 2.0 * ln(v)", 3)} AS llf FROM v, s""")
def fe_boxcox_loglik(spark, d):
    ll = fe.boxcox_loglik(t(spark, d, "lineitem"), "l_extendedprice", GRID, shift=1.0)
    return ll.select("lambda", stable_round("llf", 3).alias("llf"))


@query("fe_boxcox", f"""WITH g AS (SELECT unnest({GRID}) AS lam), x AS (SELECT l_extendedprice + 1.0 AS x FROM lineitem),
s AS (SELECT count(*) AS n, sum(ln(x)) AS sl FROM x),
v AS (SELECT lam, var_pop(CASE WHEN lam = 0 THEN ln(x) ELSE (pow(x, lam) - 1) / lam END) AS v FROM g, x GROUP BY lam),
best AS (SELECT lam FROM (SELECT lam, (lam - 1) * sl - n / 2.0 * ln(v) AS llf FROM v, s) ORDER BY llf DESC, lam LIMIT 1)
SELECT l_orderkey, l_linenumber, {sround("CASE WHEN best.lam = 0 THEN ln(l_extendedprice + 1.0) ELSE (pow(l_extendedprice + 1.0, best.lam) - 1) / best.lam END", 6)} AS l_extendedprice
FROM lineitem, best""")
def fe_boxcox(spark, d):
    li = t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    bc = fe.BoxCox.fit(li, ["l_extendedprice"], shift=1.0, lo=-2.0, hi=2.0, steps=8, rounds=1)
    out = bc.transform(li)
    return out.select("l_orderkey", "l_linenumber", stable_round("l_extendedprice", 6).alias("l_extendedprice"))


@query("fe_minmax_sqrt", f"""SELECT l_orderkey, l_linenumber,
  {sround("sqrt((l_extendedprice - (SELECT min(l_extendedprice) FROM lineitem)) / ((SELECT max(l_extendedprice) FROM lineitem) - (SELECT min(l_extendedprice) FROM lineitem)))", 6)} AS l_extendedprice
FROM lineitem""")
def fe_minmax_sqrt(spark, d):
    li = t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    out = fe.MinMaxScaler.fit(li, ["l_extendedprice"], post="sqrt").transform(li)
    return out.select("l_orderkey", "l_linenumber", stable_round("l_extendedprice", 6).alias("l_extendedprice"))


@query("fe_minmax_log", f"""SELECT l_orderkey, l_linenumber,
  {sround("ln((l_discount - (SELECT min(l_discount) FROM lineitem)) / ((SELECT max(l_discount) FROM lineitem) - (SELECT min(l_discount) FROM lineitem)) + 0.1)", 6)} AS l_discount
FROM lineitem""")
def fe_minmax_log(spark, d):
    li = t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_discount")
    out = fe.MinMaxScaler.fit(li, ["l_discount"], post="log", offset=0.1).transform(li)
    return out.select("l_orderkey", "l_linenumber", stable_round("l_discount", 6).alias("l_discount"))


@query("fe_standardize", f"""SELECT l_orderkey, l_linenumber,
  {sround("(l_quantity - (SELECT avg(l_quantity) FROM lineitem)) / (SELECT stddev_pop(l_quantity) FROM lineitem)", 6)} AS l_quantity,
  {sround("(l_tax - (SELECT avg(l_tax) FROM lineitem)) / (SELECT stddev_pop(l_tax) FROM lineitem)", 6)} AS l_tax
FROM lineitem""")
def fe_standardize(spark, d):
    li = t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_tax")
    out = fe.Standardizer.fit(li, ["l_quantity", "l_tax"]).transform(li)
    return out.select("l_orderkey", "l_linenumber", stable_round("l_quantity", 6).alias("l_quantity"),
                      stable_round("l_tax", 6).alias("l_tax"))


@query("fe_maxscale", f"""SELECT p_partkey, {sround("p_size / (SELECT max(p_size) FROM part)", 6)} AS p_size,
  {sround("p_retailprice / (SELECT max(p_retailprice) FROM part)", 6)} AS p_retailprice FROM part""")
def fe_maxscale(spark, d):
    p = t(spark, d, "part").select("p_partkey", "p_size", "p_retailprice")
    out = fe.MaxScaler.fit(p, ["p_size", "p_retailprice"]).transform(p)
    return out.select("p_partkey", stable_round("p_size", 6).alias("p_size"), stable_round("p_retailprice", 6).alias("p_retailprice"))


_ST = ["F", "O", "P"]
_PR = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@query("fe_onehot_frame", "SELECT o_orderkey, " + ", ".join(
    [f"CAST(coalesce(o_orderstatus = '{v}', false) AS INTEGER) AS \"o_orderstatus_{v}\"" for v in _ST]
    + [f"CAST(coalesce(o_orderpriority = '{v}', false) AS INTEGER) AS \"o_orderpriority_{v}\"" for v in _PR]) + " FROM orders")
def fe_onehot_frame(spark, d):
    o = t(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    return fe.OneHot.fit(o, ["o_orderstatus", "o_orderpriority"]).transform(o)


@query("fe_onehot_split", "SELECT o_orderkey, " + ", ".join(
    [f"CAST(coalesce(CAST(year(o_orderdate) AS VARCHAR) = '{y}', false) AS INTEGER) AS \"yr_{y}\"" for y in range(1995, 1999)])
    + " FROM orders")
def fe_onehot_split(spark, d):
    o = t(spark, d, "orders").select("o_orderkey", F.year("o_orderdate").cast("string").alias("yr"))
    train = o.filter(F.col("yr") < "1999")
    return fe.OneHot.fit(train, ["yr"]).transform(o)


@query("fe_fill_mode", """WITH j AS (SELECT d.doc_id, l.quality, l.toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),
mq AS (SELECT quality FROM j WHERE quality IS NOT NULL GROUP BY quality ORDER BY count(*) DESC, CAST(quality AS VARCHAR) LIMIT 1),
mt AS (SELECT toxic FROM j WHERE toxic IS NOT NULL GROUP BY toxic ORDER BY count(*) DESC, CAST(toxic AS VARCHAR) LIMIT 1)
SELECT doc_id, coalesce(j.quality, (SELECT quality FROM mq)) AS quality, coalesce(j.toxic, (SELECT toxic FROM mt)) AS toxic FROM j""")
def fe_fill_mode(spark, d):
    j = t(spark, d, "documents").select("doc_id").join(t(spark, d, "labels"), "doc_id", "left")
    return fe.fill_mode(j, ["quality", "toxic"])


@query("fe_fill_const", """SELECT d.doc_id, coalesce(l.quality, -1) AS quality, coalesce(l.toxic, 0) AS toxic
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def fe_fill_const(spark, d):
    j = t(spark, d, "documents").select("doc_id").join(t(spark, d, "labels"), "doc_id", "left")
    return fe.fill_const(j, {"quality": -1, "toxic": 0})


@query("fe_fill_group_median", """WITH p AS (SELECT p_partkey, p_brand, CASE WHEN p_size < 5 THEN NULL ELSE p_retailprice END AS price FROM part),
g AS (SELECT p_brand, median(price) AS m FROM p GROUP BY p_brand)
SELECT p.p_partkey, round(coalesce(p.price, g.m, (SELECT median(m) FROM g)), 4) AS price FROM p LEFT JOIN g ON p.p_brand = g.p_brand""")
def fe_fill_group_median(spark, d):
    p = t(spark, d, "part").select("p_partkey", "p_brand",
                                   F.when(F.col("p_size") < 5, None).otherwise(F.col("p_retailprice")).alias("price"))
    out = fe.fill_group_median(p, "p_brand", "price")
    return out.select("p_partkey", F.round("price", 4).alias("price"))


@query("fe_fill_random", """WITH p AS (SELECT p_partkey, CASE WHEN p_size < 5 THEN NULL ELSE p_retailprice END AS price FROM part),
s AS (SELECT avg(price) - stddev_samp(price) AS lo, avg(price) + stddev_samp(price) AS hi FROM p)
SELECT p_partkey, coalesce(price, CAST(floor(s.lo + (CAST(('0x' || substr(md5('3' || CAST(p_partkey AS VARCHAR)), 1, 8)) AS BIGINT) / 4294967296.0)
  * (s.hi - s.lo)) AS DOUBLE)) AS price FROM p, s""")
def fe_fill_random(spark, d):
    """Missing retail prices drawn in [mean - sd, mean + sd) from md5 of the key."""
    p = t(spark, d, "part").select("p_partkey", F.when(F.col("p_size") < 5, None).otherwise(F.col("p_retailprice")).alias("price"))
    return fe.fill_random(p, "price", "p_partkey", seed=3)


@query("fe_fill_tree")
def fe_fill_tree(spark, d):
    """Rows-only: missing retail prices predicted by a regression tree on size and key."""
    p = t(spark, d, "part").select("p_partkey", "p_size",
                                   F.when(F.col("p_size") < 5, None).otherwise(F.col("p_retailprice")).alias("price"))
    return fe.fill_tree(p, "price", ["p_size", "p_partkey"])


@query("fe_fill_chained")
def fe_fill_chained(spark, d):
    """Rows-only: chained-equation imputation of two incomplete lineitem columns, 6 rounds."""
    li = t(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_extendedprice",
        F.when(F.col("l_tax") == 0, None).otherwise(F.col("l_discount")).alias("l_discount"),
        F.when(F.col("l_linenumber") == 1, None).otherwise(F.col("l_quantity")).alias("l_quantity"))
    return fe.fill_chained(li, ["l_extendedprice", "l_discount", "l_quantity"], rounds=6)
