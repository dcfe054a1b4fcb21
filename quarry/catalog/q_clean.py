"""Projections, filters, predicates and row updates over the test tables."""

import datetime as dt

from pyspark.sql import functions as F

from quarry.catalog.registry import query, t
from quarry.operators import clean, sets


@query("prj_drop", "SELECT * EXCLUDE (l_tax, l_discount, l_shipdate) FROM lineitem")
def prj_drop(spark, d):
    return clean.drop_columns(t(spark, d, "lineitem"), ["l_tax", "l_discount", "l_shipdate"])


@query("prj_by_name", "SELECT l_orderkey, l_partkey, l_suppkey, l_extendedprice FROM lineitem")
def prj_by_name(spark, d):
    li = t(spark, d, "lineitem")
    cols = clean.columns_matching(li, suffix="key") + clean.columns_matching(li, contains="price")
    return li.select(*cols)


@query("prj_by_type", "SELECT p_partkey, p_size, p_retailprice FROM part")
def prj_by_type(spark, d):
    return clean.select_numeric(t(spark, d, "part"))


@query("prj_drop_nullable", """SELECT d.doc_id, d.lang, d.source, d.n_chars
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def prj_drop_nullable(spark, d):
    j = t(spark, d, "documents").select("doc_id", "lang", "source", "n_chars").join(
        t(spark, d, "labels"), "doc_id", "left")
    return clean.drop_nullable_columns(j)


@query("prj_reorder", "SELECT r_name, r_regionkey FROM region")
def prj_reorder(spark, d):
    return clean.reorder(t(spark, d, "region"), ["r_name", "r_regionkey"])


@query("prj_arith", """SELECT l_orderkey, l_linenumber, round(l_quantity * l_extendedprice * l_discount, 4) AS mult,
  round(l_extendedprice + l_tax + l_discount, 4) AS total FROM lineitem""")
def prj_arith(spark, d):
    li = t(spark, d, "lineitem")
    return li.select("l_orderkey", "l_linenumber",
                     F.round(clean.product("l_quantity", "l_extendedprice", "l_discount"), 4).alias("mult"),
                     F.round(clean.total("l_extendedprice", "l_tax", "l_discount"), 4).alias("total"))


def _b26(c):
    return f"CAST(list_reduce(list_transform(string_split({c}, ''), lambda x: CAST(ascii(x) - 64 AS HUGEINT)), lambda a, x: a * 26 + x) AS DECIMAL(38,0))"


@query("prj_pairs", f"""SELECT p_partkey, {_b26('p_brand || p_type')} AS p_brand_p_type,
  {_b26('p_brand || p_container')} AS p_brand_p_container, {_b26('p_type || p_container')} AS p_type_p_container
FROM (SELECT p_partkey, p_brand, p_type, upper(replace(p_name, ' ', '')) AS p_container FROM part)""")
def prj_pairs(spark, d):
    p = t(spark, d, "part").select("p_partkey", "p_brand", "p_type",
                                   F.upper(F.replace("p_name", F.lit(" "), F.lit(""))).alias("p_container"))
    out = clean.pair_codes(p, ["p_brand", "p_type", "p_container"])
    return out.drop("p_brand", "p_type", "p_container")


@query("flt_compare", """SELECT o_orderkey FROM orders
WHERE o_orderstatus IS DISTINCT FROM 'F' AND o_totalprice > 100000 AND o_orderpriority = '1-URGENT'""")
def flt_compare(spark, d):
    o = t(spark, d, "orders")
    cond = (clean.compare("o_orderstatus", "!=", "F") & clean.compare("o_totalprice", ">", 100000)
            & clean.compare("o_orderpriority", "==", "1-URGENT"))
    return o.filter(cond).select("o_orderkey")


@query("flt_null", """SELECT d.doc_id FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
WHERE l.quality IS NULL""")
def flt_null(spark, d):
    """Documents without a label: more than half of them."""
    j = t(spark, d, "documents").select("doc_id").join(t(spark, d, "labels").select("doc_id", "quality"), "doc_id", "left")
    return clean.keep_null(j, "quality").select("doc_id")


@query("flt_null_not", """SELECT d.doc_id, l.quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
WHERE l.quality IS NOT NULL""")
def flt_null_not(spark, d):
    j = t(spark, d, "documents").select("doc_id").join(t(spark, d, "labels").select("doc_id", "quality"), "doc_id", "left")
    return clean.keep_null(j, "quality", null=False)


FOUR_DAYS = ["1995-03-01", "1996-07-04", "1998-12-24", "2000-02-29"]


@query("flt_in", """SELECT o_orderkey, o_orderdate FROM orders
WHERE CAST(o_orderdate AS DATE) IN (DATE '1995-03-01', DATE '1996-07-04', DATE '1998-12-24', DATE '2000-02-29')""")
def flt_in(spark, d):
    days = [(F.col("o_orderdate") >= x) & (F.col("o_orderdate") < str(dt.date.fromisoformat(x) + dt.timedelta(1))) for x in FOUR_DAYS]
    # half-open ranges of the stored column reach the scan; the exact test follows
    o = t(spark, d, "orders").filter(days[0] | days[1] | days[2] | days[3]).withColumn("__d", F.to_date("o_orderdate"))
    return clean.keep_in(o, "__d", [dt.date.fromisoformat(x) for x in FOUR_DAYS]).select("o_orderkey", "o_orderdate")


@query("flt_drop_null_col", """SELECT c.c_custkey, o.doc_id AS o_orderkey FROM customer c LEFT JOIN labels o ON c.c_custkey = o.doc_id
WHERE o.doc_id IS NOT NULL""")
def flt_drop_null_col(spark, d):
    j = t(spark, d, "customer").select("c_custkey").join(
        t(spark, d, "labels").select(F.col("doc_id").alias("c_custkey"), F.col("doc_id").alias("o_orderkey")), "c_custkey", "left")
    return clean.drop_null_rows(j, "o_orderkey")


@query("flt_drop_nan_rows", """SELECT event_id, has_nan FROM (
  SELECT event_id, list_bool_or(list_transform([CASE WHEN value < 10 THEN 'NaN'::DOUBLE ELSE value END, value * 2], lambda x: isnan(x) OR x IS NULL)) AS has_nan
  FROM events)""")
def flt_drop_nan_rows(spark, d):
    e = t(spark, d, "events")
    vec = F.array(F.when(F.col("value") < 10, F.lit(float("nan"))).otherwise(F.col("value")), F.col("value") * 2)
    return clean.flag_nan_rows(e.select("event_id", vec.alias("vec")), "vec", "has_nan").select("event_id", "has_nan")


@query("flt_drop_nan_rows_kept", """SELECT event_id FROM events WHERE NOT (value < 10)""")
def flt_drop_nan_rows_kept(spark, d):
    e = t(spark, d, "events")
    vec = F.array(F.when(F.col("value") < 10, F.lit(float("nan"))).otherwise(F.col("value")), F.col("value") * 2)
    return clean.drop_nan_rows(e.select("event_id", vec.alias("vec")), "vec").select("event_id")


@query("upd_where", """SELECT o_orderkey, CASE WHEN o_totalprice < 50000 THEN '0-NONE' ELSE o_orderpriority END AS o_orderpriority
FROM orders""")
def upd_where(spark, d):
    o = t(spark, d, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    return clean.set_where(o, "o_orderpriority", F.col("o_totalprice") < 50000, "0-NONE").select("o_orderkey", "o_orderpriority")


@query("upd_row_where", """SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 0 ELSE c_nationkey END AS c_nationkey,
  CASE WHEN c_acctbal < 0 THEN 0.0 ELSE c_acctbal END AS c_acctbal, c_mktsegment FROM customer""")
def upd_row_where(spark, d):
    c = t(spark, d, "customer").select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    return clean.zero_rows_where(c, F.col("c_acctbal") < 0, ["c_nationkey", "c_acctbal"])


@query("upd_replace", """SELECT nullif(l_orderkey, 0) AS l_orderkey, nullif(l_linenumber, 0) AS l_linenumber,
  nullif(l_quantity, 0) AS l_quantity, nullif(l_discount, 0) AS l_discount, nullif(l_tax, 0) AS l_tax, l_returnflag
FROM lineitem""")
def upd_replace(spark, d):
    li = t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax", "l_returnflag")
    return clean.replace_sentinel(li, 0)


@query("prj_flag", """SELECT l_orderkey, l_linenumber, coalesce(trim(l_returnflag) = 'R', false) AS is_r FROM lineitem""")
def prj_flag(spark, d):
    return t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", clean.flag("l_returnflag", "R").alias("is_r"))


@query("prj_truthy", """SELECT d.doc_id, coalesce(l.quality <> 0, true) AS good
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def prj_truthy(spark, d):
    j = t(spark, d, "documents").select("doc_id").join(t(spark, d, "labels"), "doc_id", "left")
    return j.select("doc_id", clean.truthy("quality").alias("good"))


@query("prj_cast_lenient", """SELECT event_id, TRY_CAST(substr(props, 7, length(props) - 7) AS INTEGER) AS k,
  TRY_CAST(props AS DOUBLE) AS whole FROM events""")
def prj_cast_lenient(spark, d):
    e = t(spark, d, "events")
    inner = F.substr(F.col("props"), F.lit(7), F.length("props") - 7)
    return e.select("event_id", clean.to_number(inner, "int").alias("k"), clean.to_number("props", "double").alias("whole"))


@query("prj_cast", """SELECT p_partkey, CAST(p_size AS DOUBLE) AS size_d, CAST(p_size AS VARCHAR) AS size_s,
  CAST(p_retailprice AS VARCHAR) AS price_s, p_size > 20 AS big FROM part""")
def prj_cast(spark, d):
    p = t(spark, d, "part")
    return p.select("p_partkey", F.col("p_size").cast("double").alias("size_d"), F.col("p_size").cast("string").alias("size_s"),
                    F.col("p_retailprice").cast("string").alias("price_s"), (F.col("p_size") > 20).cast("boolean").alias("big"))


@query("prj_split_rows", """SELECT 'train' AS side, c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer
UNION ALL SELECT 'test', s_suppkey, s_name, s_nationkey, s_acctbal, CAST(NULL AS VARCHAR) FROM supplier""")
def prj_split_rows(spark, d):
    c = t(spark, d, "customer")
    s = t(spark, d, "supplier").select(F.col("s_suppkey").alias("c_custkey"), F.col("s_name").alias("c_name"),
                                       F.col("s_nationkey").alias("c_nationkey"), F.col("s_acctbal").alias("c_acctbal"))
    both = sets.stack_by_name(c, s, "is_train")
    train, test = clean.split_rows(both, "is_train")
    return train.withColumn("side", F.lit("train")).unionByName(test.withColumn("side", F.lit("test"))).drop("is_train")


@query("prj_holdout_tail", """SELECT o_orderkey,
  (row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1) >= CAST(floor(count(*) OVER () * 0.75) AS BIGINT) AS is_holdout
FROM orders""")
def prj_holdout_tail(spark, d):
    o = t(spark, d, "orders").select("o_orderkey", "o_orderdate")
    return clean.holdout_tail(o, ["o_orderdate", "o_orderkey"], 0.25).select("o_orderkey", "is_holdout")


@query("chk_clean", "SELECT p_partkey, p_size, p_retailprice FROM part")
def chk_clean(spark, d):
    return clean.check_clean(clean.select_numeric(t(spark, d, "part")))


def _profile_sql(c):
    quartiles = ", ".join(f"round(quantile_cont({c}, {p / 100}), 4) AS q{p}" for p in (25, 50, 75))
    return f"""SELECT '{c}' AS "column", 'double' AS type, count(*) AS rows, (SELECT CAST(count(*) AS INTEGER) FROM (DESCRIBE lineitem)) AS columns, count({c}) AS count,
  round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS sd, min({c}) AS min, {quartiles}, max({c}) AS max FROM lineitem"""


@query("prj_profile", " UNION ALL ".join(_profile_sql(c) for c in ("l_quantity", "l_extendedprice", "l_discount")))
def prj_profile(spark, d):
    li = t(spark, d, "lineitem")
    p = clean.profile(li, ["l_quantity", "l_extendedprice", "l_discount"])
    return p.select("column", "type", "rows", "columns", "count", *[F.round(c, 4).alias(c) for c in ("mean", "sd")], "min", *[F.round(c, 4).alias(c) for c in ("q25", "q50", "q75")], "max")
