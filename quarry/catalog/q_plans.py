"""Composite pipelines over the test tables."""

from pyspark.sql import functions as F

from quarry.functions.numeric import micros_since

from quarry.catalog.registry import query, t, tag as _tag
from quarry.catalog import q_series
from quarry.plans import customer, series, tabular
from quarry.sources import io

YEARS = [1995, 1996, 2000, 2001]


def _rows(spark, d):
    o = t(spark, d, "orders")
    c = t(spark, d, "customer").withColumnRenamed("c_custkey", "o_custkey")
    return o.join(c, "o_custkey").withColumnRenamed("o_custkey", "c_custkey")


CLEAN_SQL = """WITH r AS (SELECT o.o_orderkey, c.c_custkey, c.c_nationkey, o.o_totalprice, o.o_orderpriority, o.o_orderstatus, o.o_orderdate,
  CASE WHEN c.c_acctbal < 0 THEN NULL ELSE c.c_acctbal END AS bal
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey WHERE year(o.o_orderdate) IN (1995, 1996, 2000, 2001)),
lm AS (SELECT date_trunc('month', max(o_orderdate)) AS m FROM r),
k AS (SELECT * FROM r WHERE o_totalprice >= 1000),
g AS (SELECT c_nationkey, median(bal) AS gm FROM k GROUP BY c_nationkey),
f AS (SELECT k.*, coalesce(k.bal, g.gm, (SELECT median(gm) FROM g)) AS fb FROM k LEFT JOIN g ON k.c_nationkey = g.c_nationkey)
SELECT o_orderkey, c_custkey, CAST(month(o_orderdate) AS INTEGER) AS month, date_trunc('month', o_orderdate) = (SELECT m FROM lm) AS is_last,
  coalesce(trim(o_orderpriority) = '1-URGENT', false) AS is_urgent,
  CASE WHEN o_orderstatus = 'F' THEN 'Y' WHEN o_orderstatus = 'O' THEN 'ex' ELSE 'N' END AS status, round(fb, 4) AS bal,
  CASE WHEN fb > -1e9 AND fb <= 0 THEN 'none' WHEN fb > 0 AND fb <= 2500 THEN 'low' WHEN fb > 2500 AND fb <= 5000 THEN 'mid'
       WHEN fb > 5000 AND fb <= 1e9 THEN 'high' END AS band FROM f"""


@query("pipe_customer_clean", CLEAN_SQL)
def pipe_customer_clean(spark, d):
    out = customer.customer_clean(_rows(spark, d), YEARS)
    return out.withColumn("bal", F.round("bal", 4))


@query("pipe_customer_encode", """WITH c AS (SELECT c_custkey, c_mktsegment FROM customer),
m AS (SELECT c_mktsegment FROM c WHERE c_mktsegment IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, c_mktsegment LIMIT 1),
f AS (SELECT c_custkey, coalesce(c_mktsegment, (SELECT c_mktsegment FROM m)) AS seg FROM c),
top AS (SELECT seg FROM f GROUP BY 1 ORDER BY count(*) DESC, seg LIMIT 3),
k AS (SELECT c_custkey, CASE WHEN seg IN (SELECT seg FROM top) THEN seg ELSE 'Rare' END AS seg FROM f),
v AS (SELECT DISTINCT seg AS val FROM k)
SELECT k.c_custkey, 'c_mktsegment_' || v.val AS "column", CAST(k.seg = v.val AS INTEGER) AS flag FROM k, v""")
def pipe_customer_encode(spark, d):
    """Mode fill, top 3 segments kept (others 'Rare'), one-hot columns; returned long
    (key, column, flag) so the comparison does not depend on the vocabulary."""
    c = t(spark, d, "customer").select("c_custkey", "c_mktsegment")
    wide = customer.customer_encode(c, "c_mktsegment", top=3)
    cols = [x for x in wide.columns if x.startswith("c_mktsegment_")]
    if not cols:  # empty input: no vocabulary
        return wide.select("c_custkey", F.lit(None).cast("string").alias("column"), F.lit(None).cast("int").alias("flag")).limit(0)
    return wide.unpivot(["c_custkey"], cols, "column", "flag")


@query("pipe_read_clean", CLEAN_SQL)
def pipe_read_clean(spark, d):
    c = t(spark, d, "customer")
    c = c.select("c_custkey", "c_name", "c_nationkey", F.when(F.col("c_acctbal") < 0, F.lit("NA"))
                 .otherwise(F.col("c_acctbal").cast("string")).alias("c_acctbal"), "c_mktsegment")
    path = io.write_csv(c, io.store_path(spark, f"catalog/read_clean_csv/{_tag(d)}"))
    out = customer.read_clean_store(spark, path, f"catalog/read_clean/{_tag(d)}", YEARS, t(spark, d, "orders"))
    return out.withColumn("bal", F.round("bal", 4))


@query("pipe_sample_store", """WITH k AS (SELECT o_custkey FROM (SELECT DISTINCT o_custkey FROM orders)
  ORDER BY md5('3' || CAST(o_custkey AS VARCHAR)), o_custkey LIMIT 50)
SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_custkey IN (SELECT o_custkey FROM k)""")
def pipe_sample_store(spark, d):
    o = t(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return customer.sample_store(o, f"catalog/sample_store/{_tag(d)}", "o_custkey", 50, seed="3")


@query("pipe_skew_repair")
def pipe_skew_repair(spark, d):
    """Rows-only: skewed lineitem columns (on train rows) Box-Cox transformed over train + test."""
    li = t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_returnflag")
    out, _ = tabular.skew_repair(li.filter(F.col("l_returnflag") != "R"), li.filter(F.col("l_returnflag") == "R"),
                                 ["l_quantity", "l_extendedprice", "l_discount"], threshold=0.0, rounds=2)
    return out


@query("pipe_policy_features", """WITH li AS (SELECT nullif(l_orderkey, 0) AS l_orderkey, nullif(l_linenumber, 0) AS l_linenumber, nullif(l_quantity, 0) AS l_quantity, nullif(l_discount, 0) AS l_discount,
  l_returnflag, l_linestatus, l_returnflag <> 'R' AS is_train FROM lineitem),
v AS (SELECT DISTINCT l_linestatus AS val FROM li WHERE is_train AND l_linestatus IS NOT NULL)
SELECT l_orderkey, l_linenumber, l_quantity, l_discount, l_returnflag, is_train, round(l_quantity * l_discount, 6) AS mult,
  'l_linestatus_' || v.val AS "column", CAST(coalesce(l_linestatus = v.val, false) AS INTEGER) AS flag FROM li, v""")
def pipe_policy_features(spark, d):
    """Sentinel 0 -> null, product feature, dropped columns, one-hot with the training-row
    vocabulary; the 0/1 columns are returned long (row, column, flag)."""
    li = t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax", "l_returnflag",
                                        "l_linestatus", (F.col("l_returnflag") != "R").alias("is_train"))
    wide = tabular.policy_features(li, ["l_tax"], ["l_quantity", "l_discount"], 0, ["l_linestatus"], "is_train")
    cols = [c for c in wide.columns if c.startswith("l_linestatus_")]
    keep = ["l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_returnflag", "is_train"]
    wide = wide.withColumn("mult", F.round("mult", 6))
    if not cols:  # empty training rows: no vocabulary
        return wide.select(*keep, "mult", F.lit(None).cast("string").alias("column"), F.lit(None).cast("int").alias("flag")).limit(0)
    return wide.unpivot(keep + ["mult"], cols, "column", "flag")


@query("pipe_person_features")
def pipe_person_features(spark, d):
    """Rows-only: name bands, family key, urgent-order flag, segment one-hot, chained fill."""
    c = t(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment",
                                       F.when(F.col("c_acctbal") < 0, None).otherwise(F.col("c_acctbal")).alias("c_acctbal"))
    urgent = t(spark, d, "orders").filter(F.col("o_orderpriority") == "1-URGENT").select(F.col("o_custkey").alias("c_custkey"))
    return tabular.person_features(c, urgent, "c_custkey", "c_name", "c_mktsegment", "c_acctbal")


@query("pipe_claims")
def pipe_claims(spark, d):
    """Rows-only: the claims pipeline on lineitem (target l_extendedprice, test = open lines), with the rounds,
    patience, depth and rate of the operator, which are the reference's."""
    li = t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax", "l_extendedprice",
                                        "l_returnflag", "l_linestatus")
    li = li.withColumn("key", F.concat_ws("-", "l_orderkey", "l_linenumber")).drop("l_orderkey", "l_linenumber")
    train, test = li.filter(F.col("l_linestatus") == "F"), li.filter(F.col("l_linestatus") == "O").drop("l_extendedprice")
    pred, _ = tabular.claims(train, test, "key", "l_extendedprice", ["l_quantity", "l_discount", "l_tax"],
                             ["l_returnflag", "l_linestatus"], folds=3,
                             sqrt_cols=["l_quantity"], log_cols=["l_discount"], power_cols={"l_tax": (0.01, 0.07)})
    return pred


@query("pipe_spectrum")
def pipe_spectrum(spark, d):
    """Rows-only: per user spectrum: skip 5 points, cubic baseline, normalise, regrid to 50."""
    from quarry.catalog.q_series import _spec_points
    return series.spectrum(_spec_points(spark, d).drop("event_id"), "label", "x", "y", 5, 50)


@query("pipe_series_train")
def pipe_series_train(spark, d):
    """Rows-only: allow-listed users' event series -> per-epoch feature vectors, NaN rows
    dropped, vectors standardised."""
    e = t(spark, d, "events").select("event_id", "user_id", "event_type", "ts", "value")
    allow = t(spark, d, "events").groupBy("user_id").agg(F.count("*").alias("n"))
    return series.series_train(e, allow, "user_id", "event_type", ["ts", "event_id"], "value", 8, 64.0,
                               allow_cond=F.col("n") >= 40)


@query("pipe_spectra_match")
def pipe_spectra_match(spark, d):
    """Rows-only: preprocess a library (one spectrum per event type) and test spectra (per
    user), match, secondary component of mixtures."""
    from quarry.catalog.q_series import _spec_points
    pts = _spec_points(spark, d).drop("event_id")
    ev = t(spark, d, "events")
    x = micros_since("ts", "2024-01-01 00:00:00") / 1e6
    lib = ev.select(F.xxhash64("event_type").alias("label"), x.alias("x"), F.col("value").alias("y"))
    return series.spectra_match(pts, lib, "label", "x", "y", 5, 50, pure_threshold=5.0)


_VOLUME_SQL = "WITH " + q_series.SLICES_SQL + f""",
o AS (SELECT *, CAST(row_number() OVER (PARTITION BY patient ORDER BY z, l_linenumber, l_partkey, l_extendedprice) - 1 AS INTEGER) AS zi FROM sl),
sp AS (SELECT patient, abs(max(CASE WHEN zi = 0 THEN z END) - max(CASE WHEN zi = 1 THEN z END)) AS spacing, max(zi) + 1 AS nz FROM o GROUP BY patient),
hu AS (SELECT patient, zi, list_transform(pixels, lambda v: {q_series.HU_SQL}) AS hu FROM o),
v AS (SELECT CAST(unnest(hu) AS DOUBLE) AS v FROM hu), lim AS (SELECT min(v) AS lo, max(v) AS hi, (max(v) - min(v)) / 80 AS w FROM v),
b AS (SELECT CAST(least(floor((v.v - lim.lo) / lim.w), 79) AS INTEGER) AS bin, count(*) AS n FROM v, lim GROUP BY 1),
m AS (SELECT patient, nz, spacing, CAST(greatest(round_even(nz * spacing / 200.0, 0), 1) AS INTEGER) AS mz FROM sp),
c AS (SELECT m.*, tz, CAST(CASE WHEN mz > 1 THEN floor(tz * (nz - 1) / (mz - 1) + 0.5) ELSE 0 END AS INTEGER) AS zi FROM m, unnest(range(0, mz)) a(tz))
SELECT 'histogram' AS part, NULL::BIGINT AS patient, CAST(r.i AS INTEGER) AS at, array_to_string([coalesce(b.n, 0)], ',') AS cells, NULL::DOUBLE AS spacing FROM range(0, 80) r(i) LEFT JOIN b ON b.bin = r.i
UNION ALL SELECT 'grid', c.patient, CAST(tz AS INTEGER), array_to_string(hu, ','), round(spacing * nz / mz, 6) FROM c JOIN hu ON c.patient = hu.patient AND c.zi = hu.zi"""


@query("pipe_volume", _VOLUME_SQL)
def pipe_volume(spark, d):
    """Slices ordered with spacing, units, histogram, regrid: the bins of the histogram and the slices of the grid."""
    from quarry.catalog.q_series import TIES, _slices
    hist, grid = series.volume(_slices(spark, d), "patient", "z", TIES, "pixels", "slope", "intercept", 2, (200.0, 1.0, 1.0))
    bins = hist.select(F.lit("histogram").alias("part"), F.lit(None).cast("long").alias("patient"), F.col("bin").alias("at"), F.col("count").cast("string").alias("cells"), F.lit(None).cast("double").alias("spacing"))
    text = F.array_join(F.col("v").cast("array<string>"), ",")
    return bins.unionByName(grid.select(F.lit("grid").alias("part"), "patient", F.col("t_z").alias("at"), text.alias("cells"), F.round("spacing_z", 6).alias("spacing")))
