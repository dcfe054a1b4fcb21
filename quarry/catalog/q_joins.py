"""Joins and lookups over the test tables."""

from pyspark.sql import functions as F

from quarry.catalog.registry import query, t
from quarry.operators import aggs, joins
from quarry.operators.sequence import row_index
from quarry.plans.next_product import order_flags, priority_codes


@query("join_inner", """WITH li AS (SELECT l.l_orderkey, l.l_linenumber, p.p_brand FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey),
c AS (SELECT p_brand, count(*) AS n FROM li GROUP BY p_brand),
kept AS (SELECT p_brand FROM c WHERE n > (SELECT avg(n) FROM c))
SELECT li.l_orderkey, li.l_linenumber, li.p_brand FROM li JOIN kept ON li.p_brand = kept.p_brand""")
def join_inner(spark, d):
    li = t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_partkey").alias("p_partkey"))
    li = li.join(t(spark, d, "part").select("p_partkey", "p_brand"), "p_partkey").drop("p_partkey")
    kept = aggs.frequent(li, "p_brand", 1.0)
    return joins.keep_categories(li, kept, "p_brand")


@query("join_semi_sample", """WITH k AS (SELECT o_custkey FROM (SELECT DISTINCT o_custkey FROM orders)
  ORDER BY md5('7' || CAST(o_custkey AS VARCHAR)), o_custkey LIMIT 100)
SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT o_custkey FROM k)""")
def join_semi_sample(spark, d):
    o = t(spark, d, "orders").select("o_orderkey", "o_custkey")
    return joins.keep_sampled_keys(o, "o_custkey", 100, seed="7")


@query("join_semi_list", """SELECT doc_id, lang FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)""")
def join_semi_list(spark, d):
    docs = t(spark, d, "documents").select("doc_id", "lang")
    return joins.keep_allowed(docs, t(spark, d, "labels"), "doc_id", F.col("quality") == 1)


@query("join_anti", """SELECT c_custkey FROM customer WHERE c_custkey NOT IN (
  SELECT o_custkey FROM orders WHERE o_totalprice > 450000)""")
def join_anti(spark, d):
    big = t(spark, d, "orders").filter(F.col("o_totalprice") > 450000).select(F.col("o_custkey").alias("c_custkey"))
    return joins.drop_known(t(spark, d, "customer").select("c_custkey"), big, "c_custkey")


@query("join_exists_flag", """SELECT c_custkey, CASE WHEN c_custkey IN (SELECT o_custkey FROM orders
  WHERE o_orderpriority = '1-URGENT' AND o_totalprice > 400000) THEN 1 ELSE 0 END AS urgent_big FROM customer""")
def join_exists_flag(spark, d):
    keys = (t(spark, d, "orders").filter((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_totalprice") > 400000))
            .select(F.col("o_custkey").alias("c_custkey")))
    return joins.exists_flag(t(spark, d, "customer").select("c_custkey"), keys, "c_custkey", "urgent_big")


@query("join_lookup", """WITH idx AS (SELECT r_name, row_number() OVER (ORDER BY r_name) - 1 AS r_idx FROM (SELECT DISTINCT r_name FROM region))
SELECT n.n_nationkey, r.r_name, CAST(idx.r_idx AS BIGINT) AS r_idx, back.r_name AS r_name_back
FROM nation n LEFT JOIN region r ON n.n_regionkey = r.r_regionkey LEFT JOIN idx ON r.r_name = idx.r_name
LEFT JOIN idx back ON idx.r_idx = back.r_idx""")
def join_lookup(spark, d):
    n = t(spark, d, "nation").select("n_nationkey", F.col("n_regionkey").alias("r_regionkey"))
    r = t(spark, d, "region")
    idx = joins.index_dimension(r, "r_name", "r_idx")
    x = joins.lookup(joins.lookup(n, r, "r_regionkey"), idx, "r_name")
    back = idx.select(F.col("r_idx"), F.col("r_name").alias("r_name_back"))
    return joins.lookup(x, back, "r_idx").select("n_nationkey", "r_name", "r_idx", "r_name_back")


@query("join_mapping", """WITH codes AS (SELECT o_orderpriority, CAST(row_number() OVER (ORDER BY o_orderpriority) - 1 AS INTEGER) AS code
  FROM (SELECT DISTINCT o_orderpriority FROM orders WHERE o_orderpriority IS NOT NULL))
SELECT o.o_orderkey, codes.code AS priority_code FROM orders o LEFT JOIN codes ON o.o_orderpriority = codes.o_orderpriority""")
def join_mapping(spark, d):
    o = t(spark, d, "orders")
    return joins.map_codes(o.select("o_orderkey", "o_orderpriority"), priority_codes(o), "o_orderpriority",
                           out="priority_code").select("o_orderkey", "priority_code")


@query("join_fk_index", """WITH pos AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS order_pos FROM orders)
SELECT l.l_orderkey, l.l_linenumber, CAST(pos.order_pos AS BIGINT) AS order_pos FROM lineitem l JOIN pos ON l.l_orderkey = pos.o_orderkey""")
def join_fk_index(spark, d):
    pos = row_index(t(spark, d, "orders").select("o_orderkey"), ["o_orderkey"], "order_pos")
    li = t(spark, d, "lineitem").select("l_orderkey", "l_linenumber")
    return li.join(pos.withColumnRenamed("o_orderkey", "l_orderkey"), "l_orderkey")


FLAGS_SQL = """[CASE WHEN o_orderstatus='F' THEN 1 ELSE 0 END, CASE WHEN o_orderstatus='O' THEN 1 ELSE 0 END,
 CASE WHEN o_orderstatus='P' THEN 1 ELSE 0 END, CASE WHEN o_orderpriority='1-URGENT' THEN 1 ELSE 0 END,
 CASE WHEN o_orderpriority='2-HIGH' THEN 1 ELSE 0 END, CASE WHEN o_orderpriority='3-MEDIUM' THEN 1 ELSE 0 END,
 CASE WHEN o_orderpriority='4-NOT SPECIFIED' THEN 1 ELSE 0 END, CASE WHEN o_orderpriority='5-LOW' THEN 1 ELSE 0 END]"""


@query("join_left_default", f"""WITH f AS (SELECT o_custkey, o_orderdate, o_orderkey, {FLAGS_SQL} AS flags FROM orders
  WHERE o_orderpriority = '1-URGENT' AND o_totalprice > 300000),
latest AS (SELECT o_custkey, arg_max(flags, (o_orderdate, o_orderkey)) AS flags FROM f GROUP BY o_custkey)
SELECT c.c_custkey, array_to_string(coalesce(latest.flags, [0,0,0,0,0,0,0,0]), ',') AS flags
FROM customer c LEFT JOIN latest ON c.c_custkey = latest.o_custkey""")
def join_left_default(spark, d):
    o = t(spark, d, "orders").filter((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_totalprice") > 300000))
    f = order_flags(o)
    latest = f.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.max_by("flags", F.struct("o_orderdate", "o_orderkey")).alias("flags"))
    out = joins.left_default(t(spark, d, "customer").select("c_custkey"), latest, "c_custkey", "flags",
                             F.array_repeat(F.lit(0), 8))
    return out.select("c_custkey", F.array_join(F.transform("flags", lambda x: x.cast("string")), ",").alias("flags"))


@query("join_restore_dropped", """SELECT d.doc_id, coalesce(l.quality, 0) AS pred FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def join_restore_dropped(spark, d):
    preds = t(spark, d, "labels").select("doc_id", F.col("quality").alias("pred"))
    return joins.restore_dropped(t(spark, d, "documents").select("doc_id"), preds, "doc_id", "pred", 0)


@query("join_asof_snapshot", """WITH c AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'click'),
v AS (SELECT user_id, ts, value FROM events WHERE event_type = 'view')
SELECT c.event_id, c.user_id, c.ts, v.value AS last_view FROM c ASOF LEFT JOIN v ON c.user_id = v.user_id AND c.ts > v.ts""")
def join_asof_snapshot(spark, d):
    e = t(spark, d, "events")
    clicks = e.filter(F.col("event_type") == "click").select("event_id", "user_id", "ts")
    views = e.filter(F.col("event_type") == "view").select("user_id", "ts", "value")
    return joins.asof_snapshot(clicks, views, "user_id", "ts", "ts", "value", out="last_view")


@query("join_asof_snapshot_inclusive", """WITH c AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'click'),
v AS (SELECT user_id, ts, value FROM events WHERE event_type IN ('view', 'click'))
SELECT c.event_id, c.user_id, v.value AS last_seen FROM c ASOF LEFT JOIN v ON c.user_id = v.user_id AND c.ts >= v.ts""")
def join_asof_snapshot_inclusive(spark, d):
    e = t(spark, d, "events")
    clicks = e.filter(F.col("event_type") == "click").select("event_id", "user_id", "ts")
    seen = e.filter(F.col("event_type").isin("view", "click")).select("user_id", "ts", "value")
    return joins.asof_snapshot(clicks, seen, "user_id", "ts", "ts", "value", out="last_seen", inclusive=True).drop("ts")


@query("join_group_stat", """WITH c AS (SELECT c_custkey, c_nationkey, CASE WHEN c_acctbal < 0 THEN NULL ELSE c_acctbal END AS bal FROM customer),
g AS (SELECT c_nationkey, median(bal) AS m FROM c GROUP BY c_nationkey)
SELECT c.c_custkey, round(coalesce(c.bal, g.m, (SELECT median(m) FROM g)), 4) AS bal FROM c LEFT JOIN g ON c.c_nationkey = g.c_nationkey""")
def join_group_stat(spark, d):
    c = t(spark, d, "customer").select("c_custkey", "c_nationkey",
                                       F.when(F.col("c_acctbal") < 0, None).otherwise(F.col("c_acctbal")).alias("bal"))
    out = joins.fill_by_group_stat(c, "c_nationkey", "bal", "median")
    return out.select("c_custkey", F.round("bal", 4).alias("bal"))


@query("join_position", """SELECT o_orderkey, o_custkey, o_totalprice > 200000 AS pred FROM orders""")
def join_position(spark, d):
    o = t(spark, d, "orders")
    preds = o.select("o_orderkey", (F.col("o_totalprice") > 200000).alias("pred"))
    return o.select("o_orderkey", "o_custkey").join(preds, "o_orderkey")


LIB_SQL = """lib AS (SELECT label AS ref, i, avg(CAST(embedding[i] AS DOUBLE)) AS y FROM embeddings, range(1, 65) r(i) GROUP BY label, i),
tst AS (SELECT vec_id, i, CAST(embedding[i] AS DOUBLE) AS y FROM embeddings, range(1, 65) r(i)),
err AS (SELECT tst.vec_id, lib.ref, sum((tst.y - lib.y) * (tst.y - lib.y)) AS sse FROM tst JOIN lib ON tst.i = lib.i GROUP BY tst.vec_id, lib.ref)"""


def _library(spark, d):
    """Library: one mean vector per label, long (ref, i, y); test items long (vec_id, i, y)."""
    e = t(spark, d, "embeddings")
    lib = aggs.vector_mean(e, ["label"], "embedding", "v").select(F.col("label").alias("ref"), F.posexplode("v").alias("i", "y"))
    tst = e.select("vec_id", F.posexplode("embedding").alias("i", "y")).withColumn("y", F.col("y").cast("double"))
    return lib, tst


@query("join_cross_match", f"""WITH {LIB_SQL}
SELECT vec_id, ref, round(sse, 4) AS sse FROM err""")
def join_cross_match(spark, d):
    lib, tst = _library(spark, d)
    err = joins.match_on_grid(tst, lib, "vec_id", "ref", "i", "y")
    return err.select("vec_id", "ref", F.round("sse", 4).alias("sse"))


@query("join_full_coalesce", """SELECT coalesce(c.k, s.k) AS k, coalesce(c.seg, s.seg) AS seg FROM
  (SELECT c_custkey AS k, c_mktsegment AS seg FROM customer WHERE c_acctbal > 0) c
  FULL OUTER JOIN (SELECT s_suppkey AS k, s_name AS seg FROM supplier) s ON c.k = s.k""")
def join_full_coalesce(spark, d):
    c = t(spark, d, "customer").filter(F.col("c_acctbal") > 0).select(F.col("c_custkey").alias("k"), F.col("c_mktsegment").alias("seg"))
    s = t(spark, d, "supplier").select(F.col("s_suppkey").alias("k"), F.col("s_name").alias("seg"))
    return joins.full_coalesce(c, s, "k", ["seg"])

