"""Scalar functions over the test tables."""

import datetime as dt

from pyspark.sql import functions as F

from quarry.catalog.registry import query, t
from quarry.catalog.sqlfrag import py_round
from quarry.functions import numeric as nm
from quarry.functions import text as tx
from quarry.plans.next_product import order_flags
from quarry.operators.sequence import previous_row


def _ints_text(c):
    return F.array_join(F.transform(c, lambda x: x.cast("string")), ",")


@query("str_first", "SELECT p_partkey, substr(p_name, 1, 1) AS first_char FROM part")
def str_first(spark, d):
    return t(spark, d, "part").select("p_partkey", tx.first_char("p_name").alias("first_char"))


@query("str_length", "SELECT doc_id, CAST(length(text) AS BIGINT) AS n_len FROM documents")
def str_length(spark, d):
    return t(spark, d, "documents").select("doc_id", tx.char_length("text").cast("long").alias("n_len"))


@query("str_part", """SELECT doc_id,
  CASE WHEN strpos(text, ',') > 0 THEN trim(split_part(split_part(text, ',', 2), '.', 1)) END AS title,
  split_part(text, ', ', 1) AS head
FROM documents""")
def str_part(spark, d):
    return t(spark, d, "documents").select("doc_id", tx.between_marks("text", ",", ".").alias("title"),
                                           tx.before_mark("text", ", ").alias("head"))


@query("str_whitelist", """SELECT p_partkey, CASE WHEN p_type IN ('ECONOMY', 'SMALL') THEN p_type ELSE 'Rare' END AS kind
FROM part""")
def str_whitelist(spark, d):
    return t(spark, d, "part").select("p_partkey", tx.whitelist("p_type", ["ECONOMY", "SMALL"]).alias("kind"))


@query("str_suffix", "SELECT c_custkey, right(c_name, 3) AS tail FROM customer")
def str_suffix(spark, d):
    return t(spark, d, "customer").select("c_custkey", tx.suffix("c_name", 3).alias("tail"))


@query("str_concat", "SELECT p_partkey, p_brand || p_type AS brand_type FROM part")
def str_concat(spark, d):
    return t(spark, d, "part").select("p_partkey", tx.concat_null("p_brand", "p_type").alias("brand_type"))


@query("str_lower_count", """SELECT doc_id,
  CAST((length(lower(text)) - length(replace(lower(text), 'the', ''))) // 3 AS BIGINT) AS n_word
FROM documents""")
def str_lower_count(spark, d):
    return t(spark, d, "documents").select("doc_id", tx.count_word("text", "the").alias("n_word"))


@query("str_links", """SELECT page_id, CAST(pos - 1 AS BIGINT) AS pos, link FROM (
  SELECT page_id, unnest(l) AS link, unnest(generate_series(1, len(l))) AS pos
  FROM (SELECT page_id, list_filter(regexp_extract_all(lower(html), 'href=[^"]*"([^"]*)"', 1), lambda x: strpos(x, '/') > 0) AS l FROM pages))""")
def str_links(spark, d):
    p = t(spark, d, "pages").select("page_id", tx.links("html", must_contain="/").alias("l"))
    return p.select("page_id", F.posexplode("l").alias("pos", "link")).withColumn("pos", F.col("pos").cast("long"))


BASE26_SQL = "CAST(list_reduce(list_transform(string_split({c}, ''), lambda x: CAST(ascii(x) - 64 AS HUGEINT)), lambda a, x: a * 26 + x) AS DECIMAL(38,0))"


@query("str_base26", f"SELECT r_regionkey, {BASE26_SQL.format(c='r_name')} AS code FROM region")
def str_base26(spark, d):
    return t(spark, d, "region").select("r_regionkey", tx.base26("r_name").alias("code"))


_LONG_LETTERS = "regexp_replace(upper(p_name || p_type || p_brand), '[^A-Z]', '', 'g')"


@query("str_base26_long", f"""WITH p AS (SELECT p_partkey, {_LONG_LETTERS} || {_LONG_LETTERS} || {_LONG_LETTERS} || {_LONG_LETTERS} AS s FROM part),
-- the remainder by a prime, which any exact number must have; sums stay small
r AS (SELECT p_partkey, length(s) AS letters, list_reduce(list_prepend(0::BIGINT, list_transform(string_split(s, ''), lambda x: CAST(ascii(x) - 64 AS BIGINT))), lambda a, x: (a * 26 + x) % 999983) AS remainder FROM p)
SELECT p_partkey, letters, remainder FROM r""")
def str_base26_long(spark, d):
    """Numbers of texts far beyond 27 letters, compared by their remainder by a prime (taken from the decimal text)."""
    s = F.regexp_replace(F.upper(F.concat("p_name", "p_type", "p_brand")), "[^A-Z]", "")
    p = t(spark, d, "part").select("p_partkey", F.repeat(s, 4).alias("s"))
    digits = F.filter(F.split(tx.base26_text("s"), ""), lambda x: x != "")
    rest = F.aggregate(digits, F.lit(0).cast("bigint"), lambda a, x: (a * 10 + x.cast("bigint")) % 999983)
    return p.select("p_partkey", F.length("s").cast("long").alias("letters"), rest.alias("remainder"))


@query("str_join", """SELECT p_brand, array_to_string(list_sort(list_distinct(list(p_type))), ' ') AS types
FROM part GROUP BY p_brand""")
def str_join(spark, d):
    p = t(spark, d, "part").groupBy("p_brand").agg(F.array_sort(F.collect_set("p_type")).alias("l"))
    return p.select("p_brand", tx.join_names("l", " ").alias("types"))


@query("str_strip_na", """SELECT c_custkey,
  coalesce(CASE WHEN trim(c_mktsegment) IN ('', 'NA') THEN NULL ELSE trim(c_mktsegment) END, 'unknown') AS segment
FROM customer""")
def str_strip_na(spark, d):
    return t(spark, d, "customer").select("c_custkey", tx.strip_na("c_mktsegment", "unknown").alias("segment"))


@query("str_split_pair", """SELECT o_orderkey, x, y FROM (
  SELECT o_orderkey, TRY_CAST(string_split_regex(trim(line), '\\s+')[1] AS DOUBLE) AS x,
         TRY_CAST(string_split_regex(trim(line), '\\s+')[2] AS DOUBLE) AS y
  FROM (SELECT o_orderkey, ' ' || CAST(o_orderkey AS VARCHAR) || '   '
          || CASE WHEN o_orderstatus = 'F' THEN 'NA' ELSE CAST(o_totalprice AS VARCHAR) END AS line FROM orders))
WHERE x IS NOT NULL AND y IS NOT NULL""")
def str_split_pair(spark, d):
    """Text lines "key price" -> two numbers; lines whose price is 'NA' (status F) are dropped."""
    o = t(spark, d, "orders")
    second = F.when(F.col("o_orderstatus") == "F", F.lit("NA")).otherwise(F.col("o_totalprice").cast("string"))
    line = F.concat(F.lit(" "), F.col("o_orderkey").cast("string"), F.lit("   "), second)
    x, y = tx.split_pair(line)
    return o.select("o_orderkey", x.alias("x"), y.alias("y")).filter(F.col("x").isNotNull() & F.col("y").isNotNull())


@query("str_digit_test", """SELECT o_orderkey, substr(CAST(o_orderdate AS VARCHAR), 4, 1) AS year_digit,
  CASE WHEN substr(CAST(o_orderdate AS VARCHAR), 4, 1) = '5' THEN 'first' ELSE 'last' END AS pick FROM orders""")
def str_digit_test(spark, d):
    o = t(spark, d, "orders")
    dig = tx.char_at(F.col("o_orderdate").cast("string"), 4)
    return o.select("o_orderkey", dig.alias("year_digit"),
                    F.when(dig == "5", "first").otherwise("last").alias("pick"))


@query("dat_parse", "SELECT o_orderkey, CAST(substr(CAST(o_orderdate AS VARCHAR), 1, 10) AS DATE) AS d FROM orders")
def dat_parse(spark, d):
    o = t(spark, d, "orders")
    return o.select("o_orderkey", nm.parse_date(F.substring(F.col("o_orderdate").cast("string"), 1, 10)).alias("d"))


@query("dat_month", """SELECT o_orderkey, CAST(month(o_orderdate) AS BIGINT) AS m,
  CAST(month(o_orderdate) AS VARCHAR) AS m_text FROM orders""")
def dat_month(spark, d):
    o = t(spark, d, "orders")
    m = nm.month_of("o_orderdate")
    return o.select("o_orderkey", m.cast("long").alias("m"), m.cast("string").alias("m_text"))


@query("dat_is_last", """SELECT o_orderkey,
  date_trunc('month', o_orderdate) = (SELECT date_trunc('month', max(o_orderdate)) FROM orders) AS is_last
FROM orders""")
def dat_is_last(spark, d):
    o = t(spark, d, "orders")
    last = o.agg(F.max("o_orderdate")).first()[0]  # one statistic
    start = dt.datetime(last.year, last.month, 1).strftime("%Y-%m-%d") if last else "1900-01-01"
    return o.select("o_orderkey", F.coalesce(nm.is_month("o_orderdate", start), F.lit(False)).alias("is_last"))


@query("dat_format", "SELECT event_id, strftime(ts, '%Y-%m-%d-%H-%M') AS stamp FROM events")
def dat_format(spark, d):
    return t(spark, d, "events").select("event_id", nm.format_ts("ts").alias("stamp"))


@query("num_log_shift", """SELECT o_orderkey, round(ln(o_totalprice + 200), 6) AS y,
  round(exp(ln(o_totalprice + 200)) - 200, 4) AS back FROM orders""")
def num_log_shift(spark, d):
    o = t(spark, d, "orders")
    y = nm.log_shift("o_totalprice", 200.0)
    return o.select("o_orderkey", F.round(y, 6).alias("y"), F.round(nm.exp_unshift(y, 200.0), 4).alias("back"))


@query("num_power_clip", """SELECT l_orderkey, l_linenumber, round(pow(greatest(l_discount - 0.01, 0) / 0.05, 0.25), 6) AS v
FROM lineitem""")
def num_power_clip(spark, d):
    li = t(spark, d, "lineitem")
    return li.select("l_orderkey", "l_linenumber", F.round(nm.power_clip("l_discount", 0.01, 0.05), 6).alias("v"))


@query("num_clip_scale", f"""SELECT c_custkey,
  {py_round("(least(greatest(coalesce(c_acctbal, 0.0), -1000.0), 10000.0) + 1000.0) / 11000.0", 4)} AS bal
FROM customer""")
def num_clip_scale(spark, d):
    return t(spark, d, "customer").select("c_custkey", nm.clip_scale("c_acctbal", -1000.0, 10000.0, 0.0, 4).alias("bal"))


@query("num_case", """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'Y' WHEN o_orderstatus = 'O' THEN 'ex' ELSE 'N' END AS status,
  CASE WHEN substr(o_orderpriority, 1, 1) = '1' THEN 1 ELSE 0 END AS primary_flag FROM orders""")
def num_case(spark, d):
    o = t(spark, d, "orders")
    st = F.when(F.col("o_orderstatus") == "F", "Y").when(F.col("o_orderstatus") == "O", "ex").otherwise("N")
    prim = nm.case_map(tx.first_char("o_orderpriority"), {"1": 1}, default=0)
    return o.select("o_orderkey", st.alias("status"), prim.alias("primary_flag"))


@query("num_bin_right", """SELECT c_custkey, CASE WHEN c_acctbal > -1000 AND c_acctbal <= 0 THEN 'neg'
  WHEN c_acctbal > 0 AND c_acctbal <= 2500 THEN 'low' WHEN c_acctbal > 2500 AND c_acctbal <= 5000 THEN 'mid'
  WHEN c_acctbal > 5000 AND c_acctbal <= 10000 THEN 'high' END AS band FROM customer""")
def num_bin_right(spark, d):
    c = t(spark, d, "customer")
    return c.select("c_custkey", nm.bin_right("c_acctbal", [-1000, 0, 2500, 5000, 10000],
                                              ["neg", "low", "mid", "high"]).alias("band"))


@query("num_bin_left", """SELECT p_partkey, CASE WHEN p_size < 10 THEN 'small' WHEN p_size < 30 THEN 'medium' ELSE 'large' END AS size_band
FROM part""")
def num_bin_left(spark, d):
    return t(spark, d, "part").select("p_partkey", nm.bin_left("p_size", [10, 30], ["small", "medium", "large"]).alias("size_band"))


@query("num_linear_int16", """SELECT l_orderkey, l_linenumber,
  CAST(least(greatest(least(greatest(trunc(1.5 * (l_quantity * 1000)), -32768), 32767) - 1024, -32768), 32767) AS SMALLINT) AS hu
FROM lineitem""")
def num_linear_int16(spark, d):
    li = t(spark, d, "lineitem")
    return li.select("l_orderkey", "l_linenumber", nm.linear_int16(F.col("l_quantity") * 1000, 1.5, -1024).alias("hu"))


@query("num_fair_loss", """SELECT l_orderkey, l_linenumber,
  round(0.7 * (l_extendedprice / 1000 - l_quantity) / (abs(l_extendedprice / 1000 - l_quantity) + 0.7), 6) AS grad,
  round(0.49 / ((abs(l_extendedprice / 1000 - l_quantity) + 0.7) * (abs(l_extendedprice / 1000 - l_quantity) + 0.7)), 6) AS hess
FROM lineitem""")
def num_fair_loss(spark, d):
    li = t(spark, d, "lineitem")
    x = F.col("l_extendedprice") / 1000 - F.col("l_quantity")
    return li.select("l_orderkey", "l_linenumber", F.round(nm.fair_grad(x), 6).alias("grad"),
                     F.round(nm.fair_hess(x), 6).alias("hess"))


FLAGS_SQL = """[CASE WHEN o_orderstatus='F' THEN 1 ELSE 0 END, CASE WHEN o_orderstatus='O' THEN 1 ELSE 0 END,
 CASE WHEN o_orderstatus='P' THEN 1 ELSE 0 END, CASE WHEN o_orderpriority='1-URGENT' THEN 1 ELSE 0 END,
 CASE WHEN o_orderpriority='2-HIGH' THEN 1 ELSE 0 END, CASE WHEN o_orderpriority='3-MEDIUM' THEN 1 ELSE 0 END,
 CASE WHEN o_orderpriority='4-NOT SPECIFIED' THEN 1 ELSE 0 END, CASE WHEN o_orderpriority='5-LOW' THEN 1 ELSE 0 END]"""

PREV_SQL = f"""WITH f AS (SELECT o_orderkey, o_custkey, o_orderdate, {FLAGS_SQL} AS flags FROM orders),
p AS (SELECT *, coalesce(lag(flags) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey), [0,0,0,0,0,0,0,0]) AS prev FROM f)"""


def _flags_with_prev(spark, d):
    f = order_flags(t(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus", "o_orderpriority"))
    p = previous_row(f, ["o_custkey"], ["o_orderdate", "o_orderkey"], ["flags"], prefix="prev_")
    return p.withColumn("prev_flags", F.coalesce(F.col("prev_flags"), F.array_repeat(F.lit(0), 8)))


@query("arr_max_diff", PREV_SQL + """
SELECT o_orderkey, array_to_string(list_transform(list_zip(flags, prev), lambda z: greatest(z[1] - z[2], 0)), ',') AS new FROM p""")
def arr_max_diff(spark, d):
    p = _flags_with_prev(spark, d)
    return p.select("o_orderkey", _ints_text(nm.max_diff("flags", "prev_flags")).alias("new"))


@query("arr_explode_positive", PREV_SQL + """
SELECT o_orderkey, CAST(i - 1 AS INTEGER) AS label FROM p, range(1, 9) r(i) WHERE flags[i] - prev[i] > 0""")
def arr_explode_positive(spark, d):
    p = _flags_with_prev(spark, d).withColumn("new", nm.max_diff("flags", "prev_flags"))
    return (p.select("o_orderkey", F.posexplode("new").alias("label", "v")).filter(F.col("v") > 0)
            .select("o_orderkey", F.col("label").cast("int").alias("label")))


@query("arr_onehot", """SELECT vec_id, array_to_string(list_transform(range(0, 10), lambda i: CASE WHEN i = label THEN 1 ELSE 0 END), ',') AS onehot
FROM embeddings""")
def arr_onehot(spark, d):
    e = t(spark, d, "embeddings")
    return e.select("vec_id", _ints_text(nm.onehot("label", 10)).alias("onehot"))


@query("arr_concat", """SELECT vec_id, CAST(pos - 1 AS INTEGER) AS pos, v FROM (
  SELECT vec_id, unnest(a) AS v, unnest(generate_series(1, len(a))) AS pos
  FROM (SELECT vec_id, list_concat(list_transform(embedding, lambda x: CAST(x AS DOUBLE)), [CAST(label AS DOUBLE)]) AS a FROM embeddings))""")
def arr_concat(spark, d):
    e = t(spark, d, "embeddings")
    a = F.concat(F.transform("embedding", lambda x: x.cast("double")), F.array(F.col("label").cast("double")))
    return e.select("vec_id", F.posexplode(a).alias("pos", "v")).withColumn("pos", F.col("pos").cast("int"))


@query("arr_parse_flags", """SELECT l_orderkey, l_linenumber, array_to_string([
  coalesce(CAST(TRY_CAST(trim(CAST(l_linenumber AS VARCHAR)) AS DOUBLE) AS INTEGER), 0),
  coalesce(CAST(TRY_CAST(trim(l_returnflag) AS DOUBLE) AS INTEGER), 0),
  coalesce(CAST(TRY_CAST(trim(CAST(CAST(l_tax * 100 AS BIGINT) % 2 AS VARCHAR)) AS DOUBLE) AS INTEGER), 0)], ',') AS flags
FROM lineitem""")
def arr_parse_flags(spark, d):
    li = t(spark, d, "lineitem").withColumn("__tax_odd", ((F.col("l_tax") * 100).cast("long") % 2).cast("string"))
    return li.select("l_orderkey", "l_linenumber",
                     _ints_text(nm.parse_flags(["l_linenumber", "l_returnflag", "__tax_odd"])).alias("flags"))


@query("arr_row_standardize", """WITH s AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS a FROM embeddings),
m AS (SELECT vec_id, a, list_sum(a) / len(a) AS mu FROM s),
v AS (SELECT vec_id, a, mu, sqrt(list_sum(list_transform(a, lambda x: (x - mu) * (x - mu))) / len(a)) AS sd FROM m)
SELECT vec_id, CAST(pos - 1 AS INTEGER) AS pos, round(z, 6) AS z FROM (
  SELECT vec_id, unnest(list_transform(a, lambda x: (x - mu) / CASE WHEN sd = 0 THEN 1 ELSE sd END)) AS z,
         unnest(generate_series(1, len(a))) AS pos FROM v)""")
def arr_row_standardize(spark, d):
    e = nm.row_standardize(t(spark, d, "embeddings"), "embedding", "z")
    # posexplode_outer: the inner form makes the optimizer re-evaluate the whole computed
    # array in an inferred size filter
    return (e.select("vec_id", F.posexplode_outer("z").alias("pos", "z")).filter(F.col("pos").isNotNull())
            .select("vec_id", F.col("pos").cast("int").alias("pos"), F.round("z", 6).alias("z")))
