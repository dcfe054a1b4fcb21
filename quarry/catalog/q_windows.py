"""Window, ordered-row, ranking, sampling and set operators."""

from pyspark.sql import functions as F

from quarry.functions.numeric import micros_since

from quarry.catalog.present import stable_round
from quarry.catalog.registry import query, t
from quarry.catalog.sqlfrag import stable_round as sround
from quarry.operators import ranking, sets, windows
from quarry.plans.next_product import FLAG_NAMES, order_flags

EVENT_TYPES_SQL = "CASE WHEN event_type = '{0}' THEN 1 ELSE 0 END"


def _event_flags(spark, d):
    e = t(spark, d, "events")
    return e.select("event_id", "user_id", "ts", "value",
                    *[(F.col("event_type") == k).cast("int").alias(f"is_{k}") for k in ("click", "view", "error")])


@query("win_diff_new", f"""WITH e AS (SELECT event_id, user_id, ts, {EVENT_TYPES_SQL.format('click')} AS is_click,
  {EVENT_TYPES_SQL.format('view')} AS is_view, {EVENT_TYPES_SQL.format('error')} AS is_error FROM events)
SELECT event_id,
  coalesce(greatest(is_click - lag(is_click) OVER w, 0), 0) AS is_click_new,
  coalesce(greatest(is_view - lag(is_view) OVER w, 0), 0) AS is_view_new,
  coalesce(greatest(is_error - lag(is_error) OVER w, 0), 0) AS is_error_new
FROM e WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""")
def win_diff_new(spark, d):
    e = _event_flags(spark, d)
    out = windows.diff_new(e, ["user_id"], ["ts", "event_id"], ["is_click", "is_view", "is_error"])
    return out.select("event_id", "is_click_new", "is_view_new", "is_error_new")


@query("win_first_last_n", """SELECT o_orderkey, o_custkey, CAST(rn AS INTEGER) AS rn FROM (
  SELECT o_orderkey, o_custkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders)
WHERE rn <= 5""")
def win_first_last_n(spark, d):
    o = t(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return windows.first_last_n(o, ["o_custkey"], ["o_orderdate", "o_orderkey"], 5, rank_col="rn").select("o_orderkey", "o_custkey", "rn")


FLAGS_SQL = """[CASE WHEN o_orderstatus='F' THEN 1 ELSE 0 END, CASE WHEN o_orderstatus='O' THEN 1 ELSE 0 END,
 CASE WHEN o_orderstatus='P' THEN 1 ELSE 0 END, CASE WHEN o_orderpriority='1-URGENT' THEN 1 ELSE 0 END,
 CASE WHEN o_orderpriority='2-HIGH' THEN 1 ELSE 0 END, CASE WHEN o_orderpriority='3-MEDIUM' THEN 1 ELSE 0 END,
 CASE WHEN o_orderpriority='4-NOT SPECIFIED' THEN 1 ELSE 0 END, CASE WHEN o_orderpriority='5-LOW' THEN 1 ELSE 0 END]"""


@query("win_lag_vector", f"""WITH f AS (SELECT o_custkey, o_orderdate, o_orderkey, {FLAGS_SQL} AS flags,
  row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders),
lv AS (SELECT o_custkey, flatten(list(flags ORDER BY o_orderdate, o_orderkey)) AS l FROM f WHERE rn <= 5 GROUP BY o_custkey)
SELECT o_custkey, repeat('0,', 40 - len(l)) || array_to_string(l, ',') AS lags FROM lv""")
def win_lag_vector(spark, d):
    f = order_flags(t(spark, d, "orders"))
    lv = windows.lag_vector(f, ["o_custkey"], ["o_orderdate", "o_orderkey"], "flags", 5, len(FLAG_NAMES), last=False)
    return lv.select("o_custkey", F.array_join(F.transform("lags", lambda x: x.cast("string")), ",").alias("lags"))


@query("win_cumsum", f"""SELECT event_id, {sround("sum(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)", 4)} AS running
FROM events""")
def win_cumsum(spark, d):
    e = t(spark, d, "events").select("event_id", "user_id", "ts", "value")
    out = windows.cumsum(e, ["ts", "event_id"], "value", "running", key=["user_id"])
    return out.select("event_id", stable_round("running", 4).alias("running"))


@query("win_cumsum_global", f"""SELECT o_orderkey, {sround("sum(o_totalprice) OVER (ORDER BY o_orderdate, o_orderkey ROWS UNBOUNDED PRECEDING)", 2)} AS running
FROM orders""")
def win_cumsum_global(spark, d):
    o = t(spark, d, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    out = windows.cumsum(o, ["o_orderdate", "o_orderkey"], "o_totalprice", "running")
    return out.select("o_orderkey", stable_round("running", 2).alias("running"))


GINI_SQL = """WITH j AS (SELECT d.doc_id, CAST(l.quality AS BIGINT) AS y, CAST(d.n_chars AS DOUBLE) AS p FROM documents d JOIN labels l ON d.doc_id = l.doc_id),
w AS (SELECT y, coalesce(sum(1 - y) OVER (ORDER BY p DESC, doc_id DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS neg_above FROM j),
g AS (SELECT 1 - 2.0 * sum(y * neg_above) / (sum(y) * (count(*) - sum(y))) AS gini FROM w),
wy AS (SELECT y, coalesce(sum(1 - y) OVER (ORDER BY y DESC, doc_id DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS neg_above FROM j),
gy AS (SELECT 1 - 2.0 * sum(y * neg_above) / (sum(y) * (count(*) - sum(y))) AS gini FROM wy)"""


def _gini_input(spark, d):
    j = t(spark, d, "documents").select("doc_id", "n_chars").join(t(spark, d, "labels").select("doc_id", "quality"), "doc_id")
    return j.select("doc_id", F.col("quality").cast("long").alias("y"), F.col("n_chars").cast("double").alias("p"))


@query("win_gini", GINI_SQL + "\nSELECT round(gini, 6) AS gini FROM g")
def win_gini(spark, d):
    g = windows.gini(_gini_input(spark, d).withColumn("__all", F.lit(0)), "y", "p", "doc_id", ["__all"])
    return g.select(F.round("gini", 6).alias("gini"))


@query("win_gini_norm", GINI_SQL + "\nSELECT round(g.gini / gy.gini, 6) AS gini_norm, round(g.gini, 6) AS gini FROM g, gy")
def win_gini_norm(spark, d):
    g = windows.gini_normalized(_gini_input(spark, d), "y", "p", "doc_id")
    return g.select(F.round("gini_norm", 6).alias("gini_norm"), F.round("gini", 6).alias("gini"))


@query("win_gini_by_group", """WITH j AS (SELECT d.lang, d.doc_id, CAST(l.toxic AS BIGINT) AS y, CAST(d.n_chars AS DOUBLE) AS p FROM documents d JOIN labels l ON d.doc_id = l.doc_id),
w AS (SELECT lang, y, coalesce(sum(1 - y) OVER (PARTITION BY lang ORDER BY p DESC, doc_id DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS neg_above FROM j)
SELECT lang, round(CASE WHEN sum(y) * (count(*) - sum(y)) > 0 THEN 1 - 2.0 * sum(y * neg_above) / (sum(y) * (count(*) - sum(y))) END, 6) AS gini
FROM w GROUP BY lang""")
def win_gini_by_group(spark, d):
    j = t(spark, d, "documents").select("doc_id", "lang", "n_chars").join(t(spark, d, "labels").select("doc_id", "toxic"), "doc_id")
    j = j.select("lang", "doc_id", F.col("toxic").cast("long").alias("y"), F.col("n_chars").cast("double").alias("p"))
    return windows.gini(j, "y", "p", "doc_id", ["lang"]).select("lang", F.round("gini", 6).alias("gini"))


EPOCH_SQL = """WITH r AS (SELECT event_id, user_id, ts, value, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS pos,
  count(*) OVER (PARTITION BY user_id) AS n FROM events),
ep AS (SELECT event_id, user_id, ts, value, CAST(pos // 10 AS BIGINT) AS epoch, CAST(pos % 10 AS BIGINT) AS seq FROM r WHERE pos // 10 < n // 10)"""


@query("win_epoch", EPOCH_SQL + "\nSELECT event_id, epoch, seq FROM ep")
def win_epoch(spark, d):
    e = t(spark, d, "events").select("event_id", "user_id", "ts", "value")
    return windows.epochs_by_position(e, ["user_id"], ["ts", "event_id"], 10).select("event_id", "epoch", "seq")


@query("win_epoch_time", """SELECT time_bucket(INTERVAL '1 day', ts) AS epoch, user_id, count(*) AS n FROM events GROUP BY 1, 2""")
def win_epoch_time(spark, d):
    e = windows.epochs_by_time(t(spark, d, "events"), "ts", "1 day")
    return e.groupBy(F.col("epoch").cast("timestamp_ntz").alias("epoch"), "user_id").agg(F.count("*").alias("n"))


@query("win_hjorth", EPOCH_SQL + f""",
d1 AS (SELECT *, value - lag(value) OVER (PARTITION BY user_id, epoch ORDER BY seq) AS d1 FROM ep),
d2 AS (SELECT *, d1 - lag(d1) OVER (PARTITION BY user_id, epoch ORDER BY seq) AS d2 FROM d1),
a AS (SELECT user_id, epoch, var_pop(value) AS activity, stddev_pop(value) AS sx, stddev_pop(d1) AS s1, stddev_pop(d2) AS s2 FROM d2 GROUP BY user_id, epoch)
SELECT user_id, epoch, {sround("activity", 3)} AS activity, {sround("s1 / sx", 6)} AS mobility, {sround("s2 / s1 / (s1 / sx)", 6)} AS complexity FROM a""")
def win_hjorth(spark, d):
    e = t(spark, d, "events").select("event_id", "user_id", "ts", "value")
    ep = windows.epochs_by_position(e, ["user_id"], ["ts", "event_id"], 10)
    h = windows.hjorth(ep, ["user_id", "epoch"], ["seq"], "value")
    return h.select("user_id", "epoch", stable_round("activity", 3).alias("activity"),
                    stable_round("mobility", 6).alias("mobility"), stable_round("complexity", 6).alias("complexity"))


@query("win_skip_head", """SELECT event_id FROM (SELECT event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events)
WHERE rn > 5""")
def win_skip_head(spark, d):
    e = t(spark, d, "events").select("event_id", "user_id", "ts")
    return windows.skip_head(e, ["user_id"], ["ts", "event_id"], 5).select("event_id")


@query("win_slice_spacing", """WITH r AS (SELECT l_orderkey, l_quantity, l_linenumber,
  row_number() OVER (PARTITION BY l_orderkey ORDER BY l_quantity, l_linenumber) AS rn FROM lineitem),
s AS (SELECT l_orderkey, coalesce(abs(max(CASE WHEN rn = 1 THEN l_quantity END) - max(CASE WHEN rn = 2 THEN l_quantity END)),
  abs(max(CASE WHEN rn = 1 THEN l_linenumber END) - max(CASE WHEN rn = 2 THEN l_linenumber END))) AS spacing FROM r GROUP BY l_orderkey)
SELECT l.l_orderkey, l.l_linenumber, s.spacing FROM lineitem l LEFT JOIN s ON l.l_orderkey = s.l_orderkey""")
def win_slice_spacing(spark, d):
    li = t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    out = windows.slice_spacing(li, ["l_orderkey"], "l_quantity", fallback="l_linenumber")
    return out.select("l_orderkey", "l_linenumber", F.col("spacing").cast("double").alias("spacing"))


@query("win_block_mean", f"""WITH s AS (SELECT event_type, CAST(floor(epoch(ts - TIMESTAMP '2024-01-01') / 3600) AS BIGINT) AS t,
  stddev_pop(value) AS sd FROM events GROUP BY 1, 2),
m AS (SELECT event_type, max(t) AS tmax FROM s GROUP BY 1),
b AS (SELECT s.event_type, s.t, s.sd, CAST(floor((m.tmax + 1) / 10) AS BIGINT) AS bl FROM s JOIN m ON s.event_type = m.event_type)
SELECT event_type, CAST(t % bl AS BIGINT) AS "offset", {sround("avg(sd)", 4)} AS mean_spread FROM b WHERE t < bl * 10 GROUP BY 1, 2""")
def win_block_mean(spark, d):
    e = t(spark, d, "events")
    e = e.withColumn("t", F.floor(micros_since("ts", "2024-01-01 00:00:00") / 3_600_000_000).cast("long"))
    r = windows.block_profile(e, ["event_type"], "t", "value", 10)
    return r.select("event_type", "offset", stable_round("mean_spread", 4).alias("mean_spread"))


@query("win_fold_contiguous", "SELECT o_orderkey, CAST(ntile(3) OVER (ORDER BY o_orderkey) - 1 AS INTEGER) AS fold FROM orders")
def win_fold_contiguous(spark, d):
    return windows.fold_contiguous(t(spark, d, "orders").select("o_orderkey"), ["o_orderkey"], 3).select("o_orderkey", "fold")


@query("win_fold_stratified", """SELECT doc_id, quality, CAST(ntile(10) OVER (PARTITION BY quality ORDER BY md5('3' || CAST(doc_id AS VARCHAR)), doc_id) - 1 AS INTEGER) AS fold
FROM labels""")
def win_fold_stratified(spark, d):
    lab = t(spark, d, "labels").select("doc_id", "quality")
    return windows.fold_stratified(lab, "quality", "doc_id", 10, seed="3")


@query("win_batch", """SELECT l_orderkey, l_linenumber, CAST((row_number() OVER (ORDER BY l_orderkey, l_linenumber) - 1) // 32 AS BIGINT) AS batch FROM lineitem""")
def win_batch(spark, d):
    li = t(spark, d, "lineitem").select("l_orderkey", "l_linenumber")
    return windows.batches(li, ["l_orderkey", "l_linenumber"], 32)


# ------------------------------------------------------------------ 2.6 ranking and sampling

@query("top_sort", "SELECT c_custkey, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey")
def top_sort(spark, d):
    return ranking.sort(t(spark, d, "customer").select("c_custkey", "c_acctbal"), [F.desc("c_acctbal"), F.asc("c_custkey")])


@query("top_keep_n", """WITH top AS (SELECT p_name FROM part WHERE p_name IS NOT NULL GROUP BY p_name ORDER BY count(*) DESC, p_name LIMIT 10)
SELECT p.p_partkey, CASE WHEN top.p_name IS NOT NULL THEN p.p_name ELSE 'Rare' END AS p_name FROM part p LEFT JOIN top ON p.p_name = top.p_name""")
def top_keep_n(spark, d):
    p = t(spark, d, "part").select("p_partkey", "p_name")
    return ranking.keep_top_n(p, "p_name", 10)


@query("top_k_per_row", """SELECT vec_id, array_to_string(list_transform(list_slice(list_reverse_sort(
  list_transform(embedding, lambda x, i: {'v': x, 'ni': -i})), 1, 8), lambda s: 'f' || CAST(-s.ni - 1 AS VARCHAR)), ' ') AS top8 FROM embeddings""")
def top_k_per_row(spark, d):
    e = t(spark, d, "embeddings")
    names = [f"f{i}" for i in range(64)]
    return e.select("vec_id", ranking.top_k_names("embedding", names, 8).alias("top8"))


@query("top_best", """WITH c AS (SELECT url, CAST((length(lower(html)) - length(replace(lower(html), 'the', ''))) // 3 AS BIGINT) AS n FROM pages)
SELECT url, n FROM c ORDER BY n DESC, url DESC LIMIT 1""")
def top_best(spark, d):
    from quarry.functions.text import count_word
    p = t(spark, d, "pages").select("url", count_word("html", "the").alias("n"))
    return ranking.best(p, "url", "n")


@query("smp_random", """SELECT o_orderkey FROM orders ORDER BY md5('11' || CAST(o_orderkey AS VARCHAR)), o_orderkey LIMIT 50""")
def smp_random(spark, d):
    return ranking.sample_random(t(spark, d, "orders").select("o_orderkey"), "o_orderkey", 50, seed="11")


@query("smp_split", """SELECT o_orderkey, substr(md5('5' || CAST(o_orderkey AS VARCHAR)), 1, 8) < '33333333' AS is_test FROM orders""")
def smp_split(spark, d):
    o = t(spark, d, "orders").select("o_orderkey")
    return o.select("o_orderkey", ranking.split_flag("o_orderkey", 0.2, seed="5").alias("is_test"))


# ------------------------------------------------------------------ 2.7 set operations

@query("set_union_name", """SELECT c_custkey AS k, c_name AS name, c_acctbal AS bal, c_mktsegment AS segment, true AS is_train FROM customer
UNION ALL SELECT s_suppkey, s_name, s_acctbal, NULL, false FROM supplier""")
def set_union_name(spark, d):
    c = t(spark, d, "customer").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name"),
                                       F.col("c_acctbal").alias("bal"), F.col("c_mktsegment").alias("segment"))
    s = t(spark, d, "supplier").select(F.col("s_suppkey").alias("k"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("bal"))
    return sets.stack_by_name(c, s, "is_train")


@query("set_intersect_mask", """WITH o AS (SELECT o_orderkey, year(o_orderdate) < 1999 AS is_train, o_orderstatus, o_orderpriority,
  CAST(year(o_orderdate) AS VARCHAR) AS yr FROM orders),
v AS (SELECT 'o_orderstatus' AS c, o_orderstatus AS v, is_train FROM o UNION ALL SELECT 'o_orderpriority', o_orderpriority, is_train FROM o
  UNION ALL SELECT 'yr', yr, is_train FROM o),
p AS (SELECT c, v, bool_or(is_train) AND bool_or(NOT is_train) AS in_both FROM v WHERE v IS NOT NULL GROUP BY c, v),
dif AS (SELECT c, bool_or(NOT in_both) AS differs FROM p GROUP BY c),
k AS (SELECT p.c, p.v FROM p JOIN dif ON p.c = dif.c WHERE p.in_both OR NOT dif.differs)
SELECT o_orderkey, is_train,
  CASE WHEN o_orderstatus IN (SELECT v FROM k WHERE c = 'o_orderstatus') THEN o_orderstatus END AS o_orderstatus,
  CASE WHEN o_orderpriority IN (SELECT v FROM k WHERE c = 'o_orderpriority') THEN o_orderpriority END AS o_orderpriority,
  CASE WHEN yr IN (SELECT v FROM k WHERE c = 'yr') THEN yr END AS yr FROM o""")
def set_intersect_mask(spark, d):
    o = t(spark, d, "orders").select("o_orderkey", (F.year("o_orderdate") < 1999).alias("is_train"), "o_orderstatus",
                                     "o_orderpriority", F.year("o_orderdate").cast("string").alias("yr"))
    return sets.mask_uncommon(o, "is_train", ["o_orderstatus", "o_orderpriority", "yr"])


@query("set_update", """SELECT user_id, arg_max(event_id, (ts, event_id)) AS event_id, arg_max(value, (ts, event_id)) AS value
FROM events GROUP BY user_id""")
def set_update(spark, d):
    e = t(spark, d, "events").select("user_id", "event_id", "value", F.struct("ts", "event_id").alias("batch"))
    return sets.latest_per_key(e, ["user_id"], "batch").drop("batch")


@query("set_hconcat", """SELECT d.doc_id, d.lang, d.n_chars, l.quality, l.toxic FROM documents d JOIN labels l ON d.doc_id = l.doc_id""")
def set_hconcat(spark, d):
    a = t(spark, d, "documents").select("doc_id", "lang", "n_chars")
    return sets.side_by_side(a, t(spark, d, "labels"), "doc_id")
