"""Aggregations over the test tables."""

from pyspark.sql import functions as F

from quarry.catalog.registry import query, t
from quarry.catalog.present import stable_round
from quarry.catalog.sqlfrag import stable_round as sql_stable_round
from quarry.functions import numeric as nm
from quarry.functions import text as tx
from quarry.operators import aggs, joins


@query("agg_mean_median", "SELECT round(avg(o_totalprice), 4) AS mean, round(median(o_totalprice), 4) AS median FROM orders")
def agg_mean_median(spark, d):
    r = aggs.mean_median(t(spark, d, "orders"), "o_totalprice")
    return r.select(F.round("mean", 4).alias("mean"), F.round("median", 4).alias("median"))


@query("agg_group_mean", """SELECT 'l_returnflag' AS "column", l_returnflag AS value, round(avg(l_discount), 6) AS mean_target, count(*) AS n
FROM lineitem GROUP BY l_returnflag
UNION ALL SELECT 'l_linestatus', l_linestatus, round(avg(l_discount), 6), count(*) FROM lineitem GROUP BY l_linestatus""")
def agg_group_mean(spark, d):
    r = aggs.group_target_mean(t(spark, d, "lineitem"), "l_discount", ["l_returnflag", "l_linestatus"])
    return r.select("column", "value", F.round("mean_target", 6).alias("mean_target"), "n")


@query("agg_group_median", "SELECT c_nationkey, round(median(c_acctbal), 4) AS median FROM customer GROUP BY c_nationkey")
def agg_group_median(spark, d):
    r = aggs.group_median(t(spark, d, "customer"), "c_nationkey", "c_acctbal")
    return r.select("c_nationkey", F.round("median", 4).alias("median"))


@query("agg_group_sum_having", """SELECT d.source, CAST(sum(l.quality) AS BIGINT) AS total FROM documents d JOIN labels l ON d.doc_id = l.doc_id
GROUP BY d.source HAVING sum(l.quality) > 0""")
def agg_group_sum_having(spark, d):
    j = t(spark, d, "documents").select("doc_id", "source").join(t(spark, d, "labels"), "doc_id")
    return aggs.group_sum_having(j, "source", "quality", 0)


@query("agg_value_counts", "SELECT o_orderpriority, count(*) AS count FROM orders GROUP BY o_orderpriority")
def agg_value_counts(spark, d):
    return aggs.value_counts(t(spark, d, "orders"), "o_orderpriority")


@query("agg_frequent", """WITH c AS (SELECT user_id, count(*) AS count FROM events GROUP BY user_id)
SELECT user_id, count FROM c WHERE count > 1.0 * (SELECT avg(count) FROM c)""")
def agg_frequent(spark, d):
    return aggs.frequent(t(spark, d, "events"), "user_id", 1.0)


@query("agg_mode", """WITH c AS (SELECT p_brand, p_type, count(*) AS n FROM part GROUP BY p_brand, p_type)
SELECT p_brand, arg_min(p_type, (-n, p_type)) AS mode, max(n) AS count FROM c GROUP BY p_brand""")
def agg_mode(spark, d):
    return aggs.mode(t(spark, d, "part"), "p_type", "p_brand")


@query("agg_distinct", "SELECT count(DISTINCT p_type) AS p_type, count(DISTINCT p_brand) AS p_brand FROM part")
def agg_distinct(spark, d):
    return aggs.distinct_count(t(spark, d, "part"), ["p_type", "p_brand"])


@query("agg_distinct_values", "SELECT DISTINCT p_type FROM part")
def agg_distinct_values(spark, d):
    return aggs.distinct_values(t(spark, d, "part"), "p_type")


@query("agg_null_count", """WITH j AS (SELECT d.doc_id, d.lang, l.quality, l.toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)
SELECT 'doc_id' AS "column", count(*) FILTER (WHERE doc_id IS NULL) AS nulls, round(100.0 * count(*) FILTER (WHERE doc_id IS NULL) / count(*), 4) AS percent FROM j
UNION ALL SELECT 'lang', count(*) FILTER (WHERE lang IS NULL), round(100.0 * count(*) FILTER (WHERE lang IS NULL) / count(*), 4) FROM j
UNION ALL SELECT 'quality', count(*) FILTER (WHERE quality IS NULL), round(100.0 * count(*) FILTER (WHERE quality IS NULL) / count(*), 4) FROM j
UNION ALL SELECT 'toxic', count(*) FILTER (WHERE toxic IS NULL), round(100.0 * count(*) FILTER (WHERE toxic IS NULL) / count(*), 4) FROM j""")
def agg_null_count(spark, d):
    j = t(spark, d, "documents").select("doc_id", "lang").join(t(spark, d, "labels"), "doc_id", "left")
    r = aggs.null_report(j, ["doc_id", "lang", "quality", "toxic"])
    return r.select("column", "nulls", F.round("percent", 4).alias("percent"))


def _pop_skew_sql(c):
    return (f"SELECT '{c}' AS \"column\", round(avg(power({c} - m, 3)) / power(avg(power({c} - m, 2)), 1.5), 6) AS skew "
            f"FROM li, (SELECT avg({c}) AS m FROM li)")


SKEW_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "cubed", "squared"]


@query("agg_skew_select", "WITH li AS (SELECT *, power(l_quantity, 3) AS cubed, power(l_extendedprice, 2) AS squared FROM lineitem) SELECT * FROM (" + " UNION ALL ".join(_pop_skew_sql(c) for c in SKEW_COLS) + ") WHERE skew > 0.25")
def agg_skew_select(spark, d):
    li = t(spark, d, "lineitem").withColumns({"cubed": F.pow("l_quantity", F.lit(3.0)), "squared": F.pow("l_extendedprice", F.lit(2.0))})
    r = aggs.skewed_columns(li, SKEW_COLS, 0.25)
    return r.select("column", F.round("skew", 6).alias("skew"))


@query("agg_moments", f"""WITH e AS (SELECT user_id, CAST(ts AS DATE) AS day, value FROM events),
m AS (SELECT user_id, day, avg(value) AS mu FROM e GROUP BY user_id, day)
SELECT user_id, day, {sql_stable_round("variance", 3)} AS variance, {sql_stable_round("sd", 3)} AS sd,
  {sql_stable_round("skew", 4)} AS skew, {sql_stable_round("kurtosis", 4)} AS kurtosis, n FROM (
SELECT e.user_id, e.day, var_pop(value) AS variance, stddev_pop(value) AS sd,
  CASE WHEN var_pop(value) = 0 THEN NULL ELSE avg(power(value - mu, 3)) / power(var_pop(value), 1.5) END AS skew,
  CASE WHEN var_pop(value) = 0 THEN NULL ELSE avg(power(value - mu, 4)) / power(var_pop(value), 2) - 3 END AS kurtosis,
  count(*) AS n
FROM e JOIN m ON e.user_id = m.user_id AND e.day = m.day GROUP BY e.user_id, e.day)""")
def agg_moments(spark, d):
    e = t(spark, d, "events").withColumn("day", F.to_date("ts"))
    r = aggs.moments(e, ["user_id", "day"], "value")
    return r.select("user_id", "day", *[stable_round(c, 3 if c in ("variance", "sd") else 4).alias(c)
                                        for c in ["variance", "sd", "skew", "kurtosis"]], "n")


CORR_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _corr_sql():
    parts = []
    for a in CORR_COLS:
        for b in CORR_COLS:
            parts.append(f"SELECT l_returnflag, '{a}' AS a, '{b}' AS b, round(coalesce(CASE WHEN isnan(corr({a}, {b})) THEN 0 ELSE corr({a}, {b}) END, 0), 6) AS corr FROM lineitem GROUP BY l_returnflag")
    return " UNION ALL ".join(parts)


@query("agg_corr_matrix", _corr_sql())
def agg_corr_matrix(spark, d):
    r = aggs.corr_matrix(t(spark, d, "lineitem"), CORR_COLS, ["l_returnflag"])
    return r.select("l_returnflag", "a", "b", F.round("corr", 6).alias("corr"))


@query("agg_corr_eigen")
def agg_corr_eigen(spark, d):
    """Eigenvalues of each return flag's 4 x 4 correlation matrix (rows-only check)."""
    c = aggs.corr_matrix(t(spark, d, "lineitem"), CORR_COLS, ["l_returnflag"])
    return aggs.corr_eigenvalues(c, ["l_returnflag"])


LIB_SQL = """lib AS (SELECT label AS ref, i, avg(CAST(embedding[i] AS DOUBLE)) AS y FROM embeddings, range(1, 65) r(i) GROUP BY label, i),
tst AS (SELECT vec_id, i, CAST(embedding[i] AS DOUBLE) AS y FROM embeddings, range(1, 65) r(i)),
err AS (SELECT tst.vec_id, lib.ref, sum((tst.y - lib.y) * (tst.y - lib.y)) AS sse FROM tst JOIN lib ON tst.i = lib.i GROUP BY tst.vec_id, lib.ref)"""


def _errors(spark, d):
    e = t(spark, d, "embeddings")
    lib = aggs.vector_mean(e, ["label"], "embedding", "v").select(F.col("label").alias("ref"), F.posexplode("v").alias("i", "y"))
    tst = e.select("vec_id", F.posexplode("embedding").alias("i", "y")).withColumn("y", F.col("y").cast("double"))
    return joins.match_on_grid(tst, lib, "vec_id", "ref", "i", "y")


@query("agg_argmin", f"""WITH {LIB_SQL}
SELECT vec_id, arg_min(ref, (sse, ref)) AS best, round(min(sse), 4) AS error FROM err GROUP BY vec_id""")
def agg_argmin(spark, d):
    r = aggs.argmin(_errors(spark, d), ["vec_id"], "ref", "sse")
    return r.select("vec_id", "best", F.round("error", 4).alias("error"))


@query("agg_vector_mean", """SELECT label, CAST(i - 1 AS INTEGER) AS pos, round(avg(CAST(embedding[i] AS DOUBLE)), 6) AS mean
FROM embeddings, range(1, 65) r(i) GROUP BY label, i""")
def agg_vector_mean(spark, d):
    r = aggs.vector_mean(t(spark, d, "embeddings"), ["label"], "embedding", "v")
    return (r.select("label", F.posexplode_outer("v").alias("pos", "mean")).filter(F.col("pos").isNotNull())
            .select("label", F.col("pos").cast("int").alias("pos"), F.round("mean", 6).alias("mean")))


@query("agg_vector_argmax", """SELECT e.vec_id, CAST(list_position(embedding, list_max(embedding)) - 1 AS INTEGER) AS idx, n.n_name
FROM embeddings e LEFT JOIN nation n ON n.n_nationkey = list_position(embedding, list_max(embedding)) - 1""")
def agg_vector_argmax(spark, d):
    e = t(spark, d, "embeddings").select("vec_id", nm.argmax("embedding").cast("int").alias("idx"))
    names = t(spark, d, "nation").select(F.col("n_nationkey").alias("idx"), "n_name")
    return joins.lookup(e, names, "idx")


@query("agg_median_of_medians", """SELECT round(median(m), 4) AS median_of_medians FROM (
  SELECT c_nationkey, median(c_acctbal) AS m FROM customer GROUP BY c_nationkey)""")
def agg_median_of_medians(spark, d):
    r = aggs.median_of_medians(t(spark, d, "customer"), "c_nationkey", "c_acctbal")
    return r.select(F.round("median_of_medians", 4).alias("median_of_medians"))


@query("agg_minmax", "SELECT user_id, min(value) AS min_value, max(value) AS max_value FROM events GROUP BY user_id")
def agg_minmax(spark, d):
    return aggs.minmax(t(spark, d, "events"), ["value"], ["user_id"])


@query("agg_histogram", f"""WITH s AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi, (max(o_totalprice) - min(o_totalprice)) / 80 AS w FROM orders),
b AS (SELECT CAST(least(floor((o_totalprice - s.lo) / s.w), 79) AS INTEGER) AS bin, count(*) AS n FROM orders, s GROUP BY 1)
SELECT CAST(r.i AS INTEGER) AS bin, {sql_stable_round("s.lo + r.i * s.w", 3)} AS lo, {sql_stable_round("s.lo + (r.i + 1) * s.w", 3)} AS hi, coalesce(b.n, 0) AS count
FROM range(0, 80) r(i) CROSS JOIN s LEFT JOIN b ON b.bin = r.i""")
def agg_histogram(spark, d):
    h = aggs.histogram(t(spark, d, "orders"), "o_totalprice", 80)
    return h.select("bin", stable_round("lo", 3).alias("lo"), stable_round("hi", 3).alias("hi"), "count")


@query("agg_sse", """WITH lib AS (SELECT label, list(m ORDER BY i) AS mv FROM (
  SELECT label, i, avg(CAST(embedding[i] AS DOUBLE)) AS m FROM embeddings, range(1, 65) r(i) GROUP BY label, i) GROUP BY label)
SELECT e.vec_id, round(list_sum(list_transform(list_zip(e.embedding, lib.mv), lambda z: (CAST(z[1] AS DOUBLE) - z[2]) * (CAST(z[1] AS DOUBLE) - z[2]))), 4) AS sse
FROM embeddings e JOIN lib ON e.label = lib.label""")
def agg_sse(spark, d):
    e = t(spark, d, "embeddings")
    lib = aggs.vector_mean(e, ["label"], "embedding", "mv")
    j = e.join(lib, "label")
    return j.select("vec_id", F.round(aggs.sse(F.transform("embedding", lambda x: x.cast("double")), F.col("mv")), 4).alias("sse"))


@query("agg_positive_count", "SELECT count(*) FILTER (WHERE quality = 1) AS positives, count(*) AS total FROM labels")
def agg_positive_count(spark, d):
    return aggs.positive_count(t(spark, d, "labels"), "quality")


@query("agg_positive_keys", "SELECT doc_id FROM labels WHERE toxic = 1")
def agg_positive_keys(spark, d):
    return aggs.positive_keys(t(spark, d, "labels"), "doc_id", "toxic")


@query("agg_crosstab", """SELECT o_orderstatus, o_orderpriority, count(*) AS count,
  round(count(*) / sum(count(*)) OVER (PARTITION BY o_orderstatus), 6) AS share FROM orders GROUP BY o_orderstatus, o_orderpriority""")
def agg_crosstab(spark, d):
    r = aggs.crosstab(t(spark, d, "orders"), "o_orderstatus", "o_orderpriority", normalize="index")
    return r.withColumn("share", F.round("share", 6))


@query("agg_family", """SELECT split_part(c_name, '#', 1) || right(c_mktsegment, 3) AS family,
  CAST(sum(CASE WHEN c_acctbal > 5000 THEN 1 ELSE 0 END) AS BIGINT) AS total FROM customer GROUP BY 1
HAVING sum(CASE WHEN c_acctbal > 5000 THEN 1 ELSE 0 END) > 0""")
def agg_family(spark, d):
    c = t(spark, d, "customer")
    c = c.select(tx.concat_null(tx.before_mark("c_name", "#"), tx.suffix("c_mktsegment", 3)).alias("family"),
                 (F.col("c_acctbal") > 5000).cast("long").alias("rich"))
    return aggs.group_sum_having(c, "family", "rich", 0)


@query("agg_group_size", """WITH j AS (SELECT o.o_custkey FROM orders o LEFT JOIN labels l ON o.o_orderkey = l.doc_id WHERE l.doc_id IS NULL),
g AS (SELECT o_custkey, count(*) AS n FROM j GROUP BY o_custkey)
SELECT count(*) AS keys, max(n) AS max_count FROM g""")
def agg_group_size(spark, d):
    j = t(spark, d, "orders").select("o_custkey", F.col("o_orderkey").alias("doc_id")).join(
        t(spark, d, "labels").select("doc_id", F.col("doc_id").alias("hit")), "doc_id", "left")
    return aggs.group_size_where_null(j, "o_custkey", "hit")
