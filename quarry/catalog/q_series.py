"""Series, spectra, voxel and web operators over the test tables.

Stand-in inputs (schemas only; the operators do all the work):
  signal  events as multi-channel series: series = user_id, channel = event_type, samples in
          time order cut in epochs of 8, sampling rate 64 per second.
  spectra events as spectra: label = user_id, x = seconds since 2024-01-01, y = value;
          embeddings as regridded spectra (vec_id, i, y) and a library of per-label means.
  voxels  lineitem rows as slices: patient = supplier, z = order key, four pixels per slice.
  web     pages (url, html); a bipartite supplier/part graph from lineitem for layered walks.
"""

from pyspark.sql import functions as F

from quarry.functions.numeric import micros_since

from quarry.catalog.present import stable_round
from quarry.catalog.registry import query, t
from quarry.catalog.sqlfrag import stable_round as sr
from quarry.operators import aggs, signal, spectra, voxels, web, windows
from quarry.session import staged

N, FS = 8, 64.0
SAMPLES_SQL = """WITH s AS (SELECT user_id, event_type, CAST(pos // 8 AS BIGINT) AS epoch, CAST(pos % 8 AS BIGINT) AS seq, value FROM (
  SELECT user_id, event_type, value, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) - 1 AS pos,
         count(*) OVER (PARTITION BY user_id, event_type) AS n FROM events) WHERE pos // 8 < n // 8)"""
SPEC_SQL = SAMPLES_SQL + """,
d AS (SELECT user_id, event_type, epoch, k, sum(value * cos(2 * pi() * k * seq / 8.0)) AS re, sum(-value * sin(2 * pi() * k * seq / 8.0)) AS im
      FROM s, range(0, 8) r(k) GROUP BY ALL),
m AS (SELECT user_id, event_type, epoch, CAST(k AS INTEGER) AS k, CASE WHEN k = 0 THEN 0.0 ELSE sqrt(re * re + im * im) END AS mag FROM d),
tt AS (SELECT user_id, epoch, sum(mag) AS tot FROM m GROUP BY ALL),
sp AS (SELECT m.*, CASE WHEN tot > 0 THEN mag / tot END AS power FROM m JOIN tt USING (user_id, epoch))"""
BAND_SQL = "CASE " + " ".join(
    f"WHEN k * {FS / N} >= {lo} AND k * {FS / N} < {hi} THEN {j}" for j, (lo, hi) in
    enumerate(zip(signal.BAND_LEVELS_HZ[:-1], signal.BAND_LEVELS_HZ[1:]))) + " END"
KEYS = ["user_id", "event_type", "epoch"]


def _samples(spark, d):
    e = t(spark, d, "events").select("event_id", "user_id", "event_type", "ts", "value")
    return windows.epochs_by_position(e, ["user_id", "event_type"], ["ts", "event_id"], N)


def _spectrum(spark, d):
    return signal.spectrum_dft(_samples(spark, d), KEYS, "seq", "value", N, N, norm_keys=["user_id", "epoch"])


@query("sig_spectrum", SPEC_SQL + f"\nSELECT user_id, event_type, epoch, k, {sr('mag', 6)} AS mag, {sr('power', 6)} AS power FROM sp")
def sig_spectrum(spark, d):
    s = _spectrum(spark, d)
    return s.select(*KEYS, F.col("k").cast("int").alias("k"), stable_round("mag", 6).alias("mag"), stable_round("power", 6).alias("power"))


@query("sig_band_power", SPEC_SQL + f""",
b AS (SELECT user_id, event_type, epoch, {BAND_SQL} AS band, power FROM sp)
SELECT user_id, event_type, epoch, band, {sr('2 * sum(power)', 6)} AS band_power FROM b WHERE band IS NOT NULL GROUP BY ALL""")
def sig_band_power(spark, d):
    bp = signal.band_power(_spectrum(spark, d), KEYS, FS, N)
    return bp.select(*KEYS, "band", stable_round("band_power", 6).alias("band_power"))


@query("sig_band_entropy", SPEC_SQL + f""",
b AS (SELECT user_id, event_type, epoch, {BAND_SQL} AS band, power FROM sp),
bp AS (SELECT user_id, event_type, epoch, band, 2 * sum(power) AS p FROM b WHERE band IS NOT NULL GROUP BY ALL)
SELECT user_id, event_type, epoch, {sr('-sum(CASE WHEN p > 0 THEN p * ln(p) ELSE 0 END)', 6)} AS entropy FROM bp GROUP BY ALL""")
def sig_band_entropy(spark, d):
    e = signal.band_entropy(signal.band_power(_spectrum(spark, d), KEYS, FS, N), KEYS)
    return e.select(*KEYS, stable_round("entropy", 6).alias("entropy"))


@query("sig_edge_freq", SPEC_SQL + f""",
c AS (SELECT user_id, event_type, epoch, k, sum(power) OVER (PARTITION BY user_id, event_type, epoch ORDER BY k) AS cum,
      sum(power) OVER (PARTITION BY user_id, event_type, epoch) AS tot FROM sp WHERE k * {FS / N} <= 40)
SELECT user_id, event_type, epoch, min(k) * {FS / N} AS edge_hz FROM c WHERE cum >= 0.5 * tot GROUP BY ALL""")
def sig_edge_freq(spark, d):
    return signal.edge_frequency(_spectrum(spark, d), KEYS, FS, N)


DYADIC = signal.dyadic_bands(N)


@query("sig_dyadic", SPEC_SQL + """,
b AS (SELECT user_id, event_type, epoch, CASE """ + " ".join(f"WHEN k >= {lo} AND k < {hi} THEN {j}" for j, (lo, hi) in enumerate(DYADIC)) + f""" END AS band, power FROM sp),
bp AS (SELECT user_id, event_type, epoch, band, 2 * sum(power) AS p FROM b WHERE band IS NOT NULL GROUP BY ALL)
SELECT user_id, event_type, epoch, {sr('-sum(CASE WHEN p > 0 THEN p * ln(p) ELSE 0 END)', 6)} AS entropy FROM bp GROUP BY ALL""")
def sig_dyadic(spark, d):
    bp = signal.band_power_by_index(_spectrum(spark, d), KEYS, DYADIC)
    return signal.band_entropy(bp, KEYS).select(*KEYS, stable_round("entropy", 6).alias("entropy"))


@query("sig_band_ratio", SPEC_SQL + f""",
g AS (SELECT user_id, event_type, epoch, sum(mag) AS tot FROM sp GROUP BY ALL)
SELECT sp.user_id, sp.event_type, sp.epoch, sp.k, {sr('mag / tot', 6)} AS share FROM sp JOIN g USING (user_id, event_type, epoch)""")
def sig_band_ratio(spark, d):
    r = signal.band_ratio(_spectrum(spark, d), KEYS, "mag")
    return r.select(*KEYS, F.col("k").cast("int").alias("k"), stable_round("share", 6).alias("share"))


@query("sig_features")
def sig_features(spark, d):
    """Rows-only (its parts have oracles below): one vector of 10 x channels + 1 values per (user, epoch)."""
    s = _samples(spark, d)
    return signal.features(s, "user_id", "event_type", "epoch", "seq", "value", FS, N)


_ENTROPY = "-sum(CASE WHEN p > 0 THEN p * ln(p) ELSE 0 END)"
BANDS_SQL = SPEC_SQL + f""",
bd AS (SELECT user_id, event_type, epoch, band, 2 * sum(power) AS p FROM (SELECT *, {BAND_SQL} AS band FROM sp) WHERE band IS NOT NULL GROUP BY ALL),
dy AS (SELECT user_id, event_type, epoch, band, 2 * sum(power) AS p FROM (SELECT *, CASE """ + " ".join(
    f"WHEN k >= {lo} AND k < {hi} THEN {j}" for j, (lo, hi) in enumerate(DYADIC)) + """ END AS band FROM sp) WHERE band IS NOT NULL GROUP BY ALL)"""


@query("sig_feature_parts", BANDS_SQL + f""",
e1 AS (SELECT user_id, event_type, epoch, {_ENTROPY} AS entropy FROM bd GROUP BY ALL),
e2 AS (SELECT user_id, event_type, epoch, {_ENTROPY} AS dyadic_entropy FROM dy GROUP BY ALL),
ek AS (SELECT user_id, epoch, k, sum(power) AS power FROM sp WHERE k * {FS / N} <= 40 GROUP BY ALL),
ec AS (SELECT user_id, epoch, k, sum(power) OVER (PARTITION BY user_id, epoch ORDER BY k) AS cum, sum(power) OVER (PARTITION BY user_id, epoch) AS tot FROM ek),
eg AS (SELECT user_id, epoch, min(k) * {FS / N} AS edge_hz FROM ec WHERE cum >= 0.5 * tot GROUP BY ALL),
d1 AS (SELECT *, value - lag(value) OVER (PARTITION BY user_id, event_type, epoch ORDER BY seq) AS d1 FROM s),
d2 AS (SELECT *, d1 - lag(d1) OVER (PARTITION BY user_id, event_type, epoch ORDER BY seq) AS d2, avg(value) OVER (PARTITION BY user_id, event_type, epoch) AS mu FROM d1),
h AS (SELECT user_id, event_type, epoch, var_pop(value) AS activity, stddev_pop(d1) AS s1, stddev_pop(d2) AS s2, avg(power(value - mu, 3)) AS m3, avg(power(value - mu, 4)) AS m4 FROM d2 GROUP BY ALL)
SELECT user_id, event_type, epoch, {sr('entropy', 6)} AS entropy, edge_hz, {sr('dyadic_entropy', 6)} AS dyadic_entropy, {sr('activity', 3)} AS activity,
  {sr('s1 / sqrt(nullif(activity, 0))', 6)} AS mobility, {sr('s2 / nullif(s1, 0) / (s1 / sqrt(nullif(activity, 0)))', 6)} AS complexity,
  {sr('m3 / power(nullif(activity, 0), 1.5)', 4)} AS skew, {sr('m4 / power(nullif(activity, 0), 2) - 3', 4)} AS kurt
FROM h LEFT JOIN e1 USING (user_id, event_type, epoch) LEFT JOIN e2 USING (user_id, event_type, epoch) LEFT JOIN eg USING (user_id, epoch)""")
def sig_feature_parts(spark, d):
    s = _samples(spark, d).repartition("user_id", "epoch")
    keys = ["user_id", "epoch", "event_type"]
    per = signal.channel_features(s, keys, "seq", "value", FS, N)
    edge = signal.epoch_edge(s, keys, "seq", "value", FS, N)
    digits = {"activity": 3, "skew": 4, "kurt": 4}
    return per.join(edge, ["user_id", "epoch"], "left").select(*KEYS, "edge_hz", *[stable_round(c, digits.get(c, 6)).alias(c) for c in (
        "entropy", "dyadic_entropy", "activity", "mobility", "complexity", "skew", "kurt")])


@query("sig_eigen_blocks", BANDS_SQL + f""",
x AS (SELECT 'time' AS block, user_id, epoch, event_type, seq AS row, value AS x FROM s
      UNION ALL SELECT 'band', user_id, epoch, event_type, band, p FROM bd UNION ALL SELECT 'dyadic', user_id, epoch, event_type, band, p FROM dy),
c AS (SELECT a.block, a.user_id, a.epoch, a.event_type AS i, b.event_type AS j,
        CASE WHEN var_pop(a.x) > 0 AND var_pop(b.x) > 0 THEN covar_pop(a.x, b.x) / sqrt(var_pop(a.x) * var_pop(b.x)) ELSE 0 END AS r
      FROM x a JOIN x b ON a.block = b.block AND a.user_id = b.user_id AND a.epoch = b.epoch AND a.row = b.row GROUP BY ALL)
SELECT block, user_id, epoch, {sr('sum(CASE WHEN i = j THEN r ELSE 0 END)', 4)} AS trace, {sr('sum(r * r)', 4)} AS squares FROM c GROUP BY ALL""")
def sig_eigen_blocks(spark, d):
    """Sums of the eigenvalues and of their squares: the trace and the squared entries of each matrix."""
    s = _samples(spark, d)
    e = signal.eigen_blocks(s.repartition("user_id", "epoch"), ["user_id", "epoch", "event_type"], "seq", "value", FS, N, signal.channel_list(s, "event_type"))
    total = lambda f: F.aggregate("eigenvalues", F.lit(0.0), lambda a, x: a + f(x))
    return e.select("block", "user_id", "epoch", stable_round(total(lambda x: x), 4).alias("trace"), stable_round(total(lambda x: x * x), 4).alias("squares"))


@query("sig_corr_eigen", SAMPLES_SQL + f""",
c AS (SELECT a.user_id, a.epoch, a.event_type AS i, b.event_type AS j,
        CASE WHEN var_pop(a.value) > 0 AND var_pop(b.value) > 0 THEN covar_pop(a.value, b.value) / sqrt(var_pop(a.value) * var_pop(b.value)) ELSE 0 END AS r
      FROM s a JOIN s b ON a.user_id = b.user_id AND a.epoch = b.epoch AND a.seq = b.seq GROUP BY ALL)
SELECT user_id, epoch, (SELECT count(DISTINCT event_type) FROM s) AS n, {sr('sum(CASE WHEN i = j THEN r ELSE 0 END)', 4)} AS trace, {sr('sum(r * r)', 4)} AS squares FROM c GROUP BY ALL""")
def sig_corr_eigen(spark, d):
    """Eigenvalues of each (user, epoch) channel correlation matrix, compared by number, sum and squares."""
    e = signal.corr_eigen_per_group(_samples(spark, d), ["user_id", "epoch"], "event_type", "seq", "value")
    return e.groupBy("user_id", "epoch").agg(F.count("*").alias("n"), stable_round(F.sum("eig"), 4).alias("trace"), stable_round(F.sum(F.col("eig") * F.col("eig")), 4).alias("squares"))


# ------------------------------------------------------------------ spectra

X_SQL = "((epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01')) / 1e6)"


def _spec_points(spark, d):
    e = t(spark, d, "events")
    x = micros_since("ts", "2024-01-01 00:00:00") / 1e6
    return e.select(F.col("user_id").alias("label"), "event_id", x.alias("x"), F.col("value").alias("y"))


@query("spe_header_drop", f"""SELECT user_id AS label, event_id, x, y FROM (
  SELECT user_id, event_id, TRY_CAST(string_split_regex(trim(line), '\\s+')[1] AS DOUBLE) AS x, TRY_CAST(string_split_regex(trim(line), '\\s+')[2] AS DOUBLE) AS y
  FROM (SELECT user_id, event_id, CAST({X_SQL} AS VARCHAR) || ' ' || CASE WHEN event_type = 'error' THEN 'n/a' ELSE CAST(value AS VARCHAR) END AS line FROM events))
WHERE x IS NOT NULL AND y IS NOT NULL""")
def spe_header_drop(spark, d):
    e = t(spark, d, "events")
    x = micros_since("ts", "2024-01-01 00:00:00") / 1e6
    line = F.concat(x.cast("string"), F.lit(" "), F.when(F.col("event_type") == "error", "n/a").otherwise(F.col("value").cast("string")))
    return spectra.parse_lines(e.select(F.col("user_id").alias("label"), "event_id", line.alias("line")), "label", "line", "event_id")


A, B = 5 * 86400.0, 15 * 86400.0


@query("spe_start_peak", f"""WITH p AS (SELECT user_id AS label, event_id, {X_SQL} AS x, value AS y FROM events),
e AS (SELECT label, arg_min(x, (abs(x - {A}), x)) AS xa, arg_min(x, (abs(x - {B}), x)) AS xb FROM p GROUP BY label),
pk AS (SELECT p.label, arg_max(p.x, (p.y, -p.x)) AS xp FROM p JOIN e ON p.label = e.label WHERE p.x >= e.xa AND p.x < e.xb GROUP BY p.label)
SELECT p.label, p.event_id FROM p JOIN pk ON p.label = pk.label WHERE p.x >= pk.xp""")
def spe_start_peak(spark, d):
    return spectra.start_at_peak(_spec_points(spark, d), "label", "x", "y", A, B).select("label", "event_id")


@query("spe_skip_head", """SELECT user_id AS label, event_id FROM (SELECT user_id, event_id,
  row_number() OVER (PARTITION BY user_id ORDER BY ts) AS rn FROM events) WHERE rn > 5""")
def spe_skip_head(spark, d):
    return spectra.skip_head(_spec_points(spark, d), "label", "x", 5).select("label", "event_id")


@query("spe_baseline", f"""WITH p AS (SELECT user_id AS label, event_id, {X_SQL} AS x, value AS y FROM events),
f AS (SELECT label, regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM p GROUP BY label)
SELECT p.label, p.event_id, {sr('p.y - (f.a + f.b * p.x)', 4)} AS y FROM p JOIN f ON p.label = f.label""")
def spe_baseline(spark, d):
    out = spectra.subtract_baseline(_spec_points(spark, d), "label", "x", "y", degree=1)
    return out.select("label", "event_id", stable_round("y", 4).alias("y"))


@query("spe_baseline_cubic")
def spe_baseline_cubic(spark, d):
    """Rows-only: cubic baseline subtracted per spectrum."""
    return spectra.subtract_baseline(_spec_points(spark, d), "label", "x", "y", degree=3)


@query("spe_normalize", f"""WITH p AS (SELECT user_id AS label, event_id, value AS y FROM events),
r AS (SELECT label, min(y) AS lo, max(y) AS hi FROM p GROUP BY label)
SELECT p.label, p.event_id, {sr('CASE WHEN hi <> lo THEN (y - lo) / (hi - lo) END', 6)} AS y FROM p JOIN r ON p.label = r.label""")
def spe_normalize(spark, d):
    out = spectra.normalize(_spec_points(spark, d), "label", "y")
    return out.select("label", "event_id", stable_round("y", 6).alias("y"))


PTS = 50


@query("spe_regrid", f"""WITH p AS (SELECT user_id AS label, {X_SQL} AS x, value AS y FROM events),
seg AS (SELECT label, x, y, lead(x) OVER (PARTITION BY label ORDER BY x) AS nx, lead(y) OVER (PARTITION BY label ORDER BY x) AS ny FROM p),
e AS (SELECT label, min(x) AS lo, max(x) AS hi FROM p GROUP BY label),
g AS (SELECT label, CAST(i AS INTEGER) AS i, CASE WHEN i = {PTS - 1} THEN hi ELSE lo + i * ((hi - lo) / {PTS - 1}) END AS gx FROM e, range(0, {PTS}) r(i))
SELECT g.label, g.i, {sr('g.gx', 4)} AS x, {sr('CASE WHEN seg.nx IS NULL THEN seg.y ELSE seg.y + (g.gx - seg.x) * (seg.ny - seg.y) / (seg.nx - seg.x) END', 4)} AS y
FROM g ASOF JOIN seg ON g.label = seg.label AND g.gx >= seg.x""")
def spe_regrid(spark, d):
    p = _spec_points(spark, d).select("label", "x", "y")
    out = spectra.regrid(p, "label", "x", "y", PTS)
    return out.select("label", "i", stable_round("x", 4).alias("x"), stable_round("y", 4).alias("y"))


LIB_SQL = """lib AS (SELECT label AS ref, i, avg(CAST(embedding[i] AS DOUBLE)) AS y FROM embeddings, range(1, 65) r(i) GROUP BY label, i),
tst AS (SELECT vec_id, i, CAST(embedding[i] AS DOUBLE) AS y FROM embeddings, range(1, 65) r(i)),
err AS (SELECT tst.vec_id, lib.ref, sum((tst.y - lib.y) * (tst.y - lib.y)) AS sse FROM tst JOIN lib ON tst.i = lib.i GROUP BY tst.vec_id, lib.ref),
best AS (SELECT vec_id, arg_min(ref, (sse, ref)) AS best, min(sse) AS error FROM err GROUP BY vec_id)"""
TH = 0.95


def _lib(spark, d):
    e = t(spark, d, "embeddings")
    lib = aggs.vector_mean(e, ["label"], "embedding", "v").select(F.col("label").alias("ref"), F.posexplode("v").alias("i", "y"))
    tst = e.select(F.col("vec_id").alias("label"), F.posexplode("embedding").alias("i", "y")).withColumn("y", F.col("y").cast("double"))
    return lib, tst


@query("spe_identify", f"""WITH {LIB_SQL}
SELECT vec_id AS label, best, {sr('error', 4)} AS error, error >= {TH} AS is_mixture FROM best""")
def spe_identify(spark, d):
    lib, tst = _lib(spark, d)
    m = spectra.identify(tst, lib, "label", "ref", "i", "y", TH)
    return m.select("label", "best", stable_round("error", 4).alias("error"), "is_mixture")


@query("spe_residuals", f"""WITH {LIB_SQL}
SELECT tst.vec_id AS label, lib.ref, CAST(tst.i - 1 AS INTEGER) AS i, {sr('tst.y - lib.y', 5)} AS residual, lib.ref = best.best AS is_best
FROM tst JOIN lib ON tst.i = lib.i JOIN best ON best.vec_id = tst.vec_id""")
def spe_residuals(spark, d):
    """Residual curves of every spectrum against every library entry, that of the best match marked."""
    lib, tst = _lib(spark, d)
    best = spectra.identify(tst, lib, "label", "ref", "i", "y", TH).select("label", "best")
    r = spectra.residual_curves(tst, lib, "label", "ref", "i", "y").join(best, "label")
    return r.select("label", "ref", "i", stable_round("residual", 5).alias("residual"), (F.col("ref") == F.col("best")).alias("is_best"))


@query("spe_second", f"""WITH {LIB_SQL},
mix AS (SELECT * FROM best WHERE error >= {TH}),
r AS (SELECT tst.vec_id, tst.i, tst.y - lib.y AS r FROM tst JOIN mix ON tst.vec_id = mix.vec_id JOIN lib ON lib.ref = mix.best AND lib.i = tst.i),
rn AS (SELECT vec_id, i, (r - min(r) OVER (PARTITION BY vec_id)) / (max(r) OVER (PARTITION BY vec_id) - min(r) OVER (PARTITION BY vec_id)) AS y FROM r),
e2 AS (SELECT rn.vec_id, lib.ref, sum((rn.y - lib.y) * (rn.y - lib.y)) AS sse FROM rn JOIN lib ON rn.i = lib.i GROUP BY rn.vec_id, lib.ref),
b2 AS (SELECT vec_id, arg_min(ref, (sse, ref)) AS second, min(sse) AS second_error FROM e2 GROUP BY vec_id)
SELECT mix.vec_id AS label, mix.best, {sr('mix.error', 4)} AS error, b2.second, {sr('b2.second_error', 4)} AS second_error
FROM mix LEFT JOIN b2 ON mix.vec_id = b2.vec_id""")
def spe_second(spark, d):
    lib, tst = _lib(spark, d)
    m = spectra.identify_second(tst, lib, "label", "ref", "i", "y", TH)
    return m.select("label", "best", stable_round("error", 4).alias("error"), "second", stable_round("second_error", 4).alias("second_error"))


_CONVOLVE_SQL = f"""WITH {LIB_SQL},
mains AS (SELECT DISTINCT best AS main FROM best WHERE error >= {TH}),
main AS (SELECT mains.main, lib.i, lib.y FROM mains JOIN lib ON lib.ref = mains.main),
c AS (SELECT main.main, lib.ref, main.i + lib.i - 2 - 31 AS k, sum(main.y * lib.y) AS v FROM main, lib GROUP BY ALL),
cs AS (SELECT main, ref, k, v FROM c WHERE k >= 0 AND k < 64)
SELECT main, ref, CAST(k AS INTEGER) AS k, {sr('v / max(v) OVER (PARTITION BY main, ref)', 6)} AS conv FROM cs"""


@query("spe_convolve", _CONVOLVE_SQL)
def spe_convolve(spark, d):
    """The main component of every mixture with every library entry."""
    lib, tst = _lib(spark, d)
    mains = spectra.identify(tst, lib, "label", "ref", "i", "y", TH).filter("is_mixture").select(F.col("best").alias("main")).distinct()
    c = spectra.convolve_same(mains.join(lib.withColumnRenamed("ref", "main"), "main"), lib, "main", "ref", "i", "y")
    return c.select("main", "ref", "k", stable_round("conv", 6).alias("conv"))


@query("spe_convolve_mains", _CONVOLVE_SQL)
def spe_convolve_mains(spark, d):
    """The same under its earlier name."""
    return spe_convolve(spark, d)


@query("spe_fft", f"""WITH d AS (SELECT vec_id, k, sum(CAST(embedding[i + 1] AS DOUBLE) * cos(2 * pi() * k * i / 64.0)) AS re,
  sum(-CAST(embedding[i + 1] AS DOUBLE) * sin(2 * pi() * k * i / 64.0)) AS im FROM embeddings, range(0, 64) r(i), range(0, 64) q(k) GROUP BY ALL),
m AS (SELECT vec_id, k, CASE WHEN k = 0 THEN 0.0 ELSE sqrt(re * re + im * im) END AS mag FROM d)
SELECT vec_id AS label, CAST(k AS INTEGER) AS k, {sr('mag / max(mag) OVER (PARTITION BY vec_id)', 6)} AS amp FROM m""")
def spe_fft(spark, d):
    _, tst = _lib(spark, d)
    f = spectra.fft_normalized(tst, "label", "i", "y", 64)
    return f.select("label", F.col("k").cast("int").alias("k"), stable_round("amp", 6).alias("amp"))


# ------------------------------------------------------------------ voxels

TIES = ["l_linenumber", "l_partkey", "l_extendedprice"]
SLICES_SQL = """sl AS (SELECT l_suppkey AS patient, l_orderkey, l_linenumber, l_partkey, l_extendedprice, CAST(l_orderkey AS DOUBLE) AS z, CAST(l_linenumber AS DOUBLE) AS loc,
  1.0 + l_discount * 10 AS slope, -1024.0 + l_tax * 100 AS intercept,
  [CASE WHEN l_returnflag = 'R' THEN -2000 ELSE CAST(trunc(l_quantity * 40) AS INTEGER) END, CAST(trunc(l_extendedprice / 100) AS INTEGER) % 3000,
   CAST(l_partkey % 2000 AS INTEGER), CAST(l_linenumber * 300 AS INTEGER)] AS pixels FROM lineitem)"""


def _slices(spark, d):
    li = t(spark, d, "lineitem")
    pix = F.array(F.when(F.col("l_returnflag") == "R", F.lit(-2000)).otherwise((F.col("l_quantity") * 40).cast("int")),
                  (F.col("l_extendedprice") / 100).cast("int") % 3000, (F.col("l_partkey") % 2000).cast("int"),
                  (F.col("l_linenumber") * 300).cast("int")).cast("array<short>")
    return li.select(F.col("l_suppkey").alias("patient"), "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice",
                     F.col("l_orderkey").cast("double").alias("z"),
                     F.col("l_linenumber").cast("double").alias("loc"), (1.0 + F.col("l_discount") * 10).alias("slope"),
                     (-1024.0 + F.col("l_tax") * 100).alias("intercept"), pix.alias("pixels"))


HU_SQL = ("CAST(least(greatest(least(greatest(CASE WHEN slope = 1 THEN CASE WHEN v = -2000 THEN 0 ELSE v END "
          "ELSE trunc(slope * CASE WHEN v = -2000 THEN 0 ELSE v END) END, -32768), 32767) + trunc(intercept), -32768), 32767) AS SMALLINT)")


@query("vox_units", "WITH " + SLICES_SQL + f"""
SELECT patient, l_orderkey, l_linenumber, array_to_string(list_transform(pixels, lambda v: {HU_SQL}), ',') AS hu FROM sl""")
def vox_units(spark, d):
    s = voxels.to_units(_slices(spark, d), "pixels", "slope", "intercept", out="hu")
    return s.select("patient", "l_orderkey", "l_linenumber", F.array_join(F.transform("hu", lambda v: v.cast("string")), ",").alias("hu"))


@query("vox_stack", "WITH " + SLICES_SQL + """,
o AS (SELECT patient, l_orderkey, l_linenumber, z, loc, row_number() OVER (PARTITION BY patient ORDER BY z, l_linenumber, l_partkey, l_extendedprice) AS rn FROM sl),
sp AS (SELECT patient, coalesce(abs(max(CASE WHEN rn = 1 THEN z END) - max(CASE WHEN rn = 2 THEN z END)),
  abs(max(CASE WHEN rn = 1 THEN loc END) - max(CASE WHEN rn = 2 THEN loc END))) AS spacing FROM o GROUP BY patient)
SELECT o.patient, o.l_orderkey, o.l_linenumber, CAST(o.rn - 1 AS BIGINT) AS slice_idx, sp.spacing FROM o JOIN sp ON o.patient = sp.patient""")
def vox_stack(spark, d):
    s = voxels.order_slices(_slices(spark, d), "patient", "z", TIES, fallback="loc")
    return s.select("patient", "l_orderkey", "l_linenumber", "slice_idx", "spacing")


@query("vox_histogram", "WITH " + SLICES_SQL + f""",
v AS (SELECT CAST(unnest(list_transform(pixels, lambda v: {HU_SQL})) AS DOUBLE) AS hu FROM sl),
s AS (SELECT min(hu) AS lo, max(hu) AS hi, (max(hu) - min(hu)) / 80 AS w FROM v),
b AS (SELECT CAST(least(floor((hu - s.lo) / s.w), 79) AS INTEGER) AS bin, count(*) AS n FROM v, s GROUP BY 1)
SELECT CAST(r.i AS INTEGER) AS bin, coalesce(b.n, 0) AS count FROM range(0, 80) r(i) LEFT JOIN b ON b.bin = r.i""")
def vox_histogram(spark, d):
    s = voxels.to_units(_slices(spark, d), "pixels", "slope", "intercept", out="hu")
    v = s.select(F.explode("hu").alias("hu")).select(F.col("hu").cast("double").alias("hu"))
    return voxels.histogram(v, "hu", 80).select("bin", "count")


@query("vox_regrid", "WITH " + SLICES_SQL + """,
o AS (SELECT patient, pixels, CAST(row_number() OVER (PARTITION BY patient ORDER BY z, l_linenumber, l_partkey, l_extendedprice) - 1 AS INTEGER) AS z_idx FROM sl),
vx AS (SELECT patient, z_idx AS zi, CAST(x - 1 AS INTEGER) AS xi, CAST(pixels[x] AS INTEGER) AS v FROM o, range(1, 5) r(x)),
sh AS (SELECT patient, max(zi) + 1 AS nz, max(xi) + 1 AS nx FROM vx GROUP BY patient),
m AS (SELECT patient, nz, nx, CAST(greatest(round_even(nz * 1.0 / 2.0, 0), 1) AS INTEGER) AS mz, CAST(greatest(round_even(nx * 0.5 / 1.0, 0), 1) AS INTEGER) AS mx FROM sh),
c AS (SELECT patient, tz, tx, CAST(CASE WHEN mz > 1 THEN floor(tz * (nz - 1) / (mz - 1) + 0.5) ELSE 0 END AS INTEGER) AS zi,
  CAST(CASE WHEN mx > 1 THEN floor(tx * (nx - 1) / (mx - 1) + 0.5) ELSE 0 END AS INTEGER) AS xi,
  1.0 * nz / mz AS spacing_zi, 0.5 * nx / mx AS spacing_xi
  FROM m, unnest(range(0, mz)) a(tz), unnest(range(0, mx)) b(tx))
SELECT c.patient, CAST(c.tz AS INTEGER) AS t_zi, CAST(c.tx AS INTEGER) AS t_xi, vx.v, c.spacing_zi, c.spacing_xi
FROM c LEFT JOIN vx ON c.patient = vx.patient AND c.zi = vx.zi AND c.xi = vx.xi""")
def vox_regrid(spark, d):
    s = voxels.order_slices(_slices(spark, d), "patient", "z", TIES).withColumn("pixels", F.col("pixels").cast("array<int>"))
    out = voxels.cells(voxels.regrid(s, "patient", "slice_idx", "pixels", 4, (1.0, 1.0, 0.5), (2.0, 1.0, 1.0)), ["patient"])
    return out.select("patient", F.col("t_z").alias("t_zi"), F.col("t_x").alias("t_xi"), "v", F.col("spacing_z").alias("spacing_zi"), F.col("spacing_x").alias("spacing_xi"))


# ------------------------------------------------------------------ web

@query("web_word_count", """SELECT url, CAST((length(lower(html)) - length(replace(lower(html), 'the', ''))) // 3 AS BIGINT) AS count FROM pages""")
def web_word_count(spark, d):
    return web.word_count(t(spark, d, "pages"), "the")


@query("web_edges", """SELECT src, CAST(pos - 1 AS INTEGER) AS pos,
  CASE WHEN starts_with(dst, '/') AND host <> '' THEN host || dst ELSE dst END AS dst FROM (
  SELECT url AS src, regexp_extract(url, '^(https?://[^/?#]+)', 1) AS host, unnest(l) AS dst, unnest(generate_series(1, len(l))) AS pos
  FROM (SELECT url, list_filter(regexp_extract_all(lower(html), 'href=[^"]*"([^"]*)"', 1), lambda x: strpos(x, '/') > 0) AS l FROM pages))""")
def web_edges(spark, d):
    e = web.edges(t(spark, d, "pages"), must_contain="/", resolve=True)
    return e.select("src", F.col("pos").cast("int").alias("pos"), "dst")


GRAPH_SQL = """e AS (SELECT DISTINCT 's' || CAST(l_suppkey AS VARCHAR) AS src, 'p' || CAST(l_partkey AS VARCHAR) AS dst FROM lineitem
  UNION SELECT DISTINCT 'p' || CAST(l_partkey AS VARCHAR), 's' || CAST(l_suppkey AS VARCHAR) FROM lineitem)"""


def _graph(spark, d):
    li = t(spark, d, "lineitem")
    s = F.concat(F.lit("s"), F.col("l_suppkey").cast("string"))
    p = F.concat(F.lit("p"), F.col("l_partkey").cast("string"))
    return li.select(s.alias("src"), p.alias("dst")).unionByName(li.select(p.alias("src"), s.alias("dst"))).distinct()


@query("web_layers", "WITH RECURSIVE " + GRAPH_SQL + """,
r(node, layer) AS (SELECT 's0', 0 UNION SELECT e.dst, r.layer + 1 FROM r JOIN e ON e.src = r.node WHERE r.layer < 3)
SELECT node, CAST(min(layer) AS INTEGER) AS layer FROM r GROUP BY node""")
def web_layers(spark, d):
    return web.layers(_graph(spark, d), "s0", 3)


@query("web_layer_counts", "WITH RECURSIVE " + GRAPH_SQL + """,
r(node, layer) AS (SELECT 's0', 0 UNION SELECT e.dst, r.layer + 1 FROM r JOIN e ON e.src = r.node WHERE r.layer < 3),
m AS (SELECT node, min(layer) AS layer FROM r GROUP BY node)
SELECT CAST(layer AS INTEGER) AS layer, count(*) AS pages FROM m GROUP BY layer""")
def web_layer_counts(spark, d):
    return web.layer_counts(web.layers(_graph(spark, d), "s0", 3))


ROUNDS = 4
#: Orders and parts as pages, their lines as links both ways, their mean quantity as the count.
WALK_SQL = """l AS (SELECT 'o' || l_orderkey AS o, 'p' || l_partkey AS p, l_quantity AS q FROM lineitem),
e AS (SELECT DISTINCT o AS src, p AS dst FROM l UNION SELECT DISTINCT p, o FROM l),
c AS (SELECT node, CAST(floor(avg(q) * 100) AS BIGINT) AS count FROM (SELECT o AS node, q FROM l UNION ALL SELECT p, q FROM l) GROUP BY node),
st AS (SELECT node, count FROM c ORDER BY count, node LIMIT 1)"""


def _walk(spark, d):
    l = t(spark, d, "lineitem").select(F.concat(F.lit("o"), "l_orderkey").alias("o"), F.concat(F.lit("p"), "l_partkey").alias("p"), F.col("l_quantity").alias("q"))  # noqa: E741
    edge = l.select(F.col("o").alias("src"), F.col("p").alias("dst")).unionByName(l.select(F.col("p").alias("src"), F.col("o").alias("dst")))
    both = l.select(F.col("o").alias("url"), "q").unionByName(l.select(F.col("p").alias("url"), "q"))
    counts = staged(both.groupBy("url").agg(F.floor(F.avg("q") * 100).cast("long").alias("count")), "walk-counts")
    start = counts.orderBy("count", "url").first()
    return edge, counts, start


def _best_first_sql():
    parts = [f"WITH {WALK_SQL},\nr0 AS MATERIALIZED (SELECT node, count, 0 AS round FROM st), x0 AS MATERIALIZED (SELECT node FROM st WHERE false)"]
    for i in range(1, ROUNDS + 1):
        parts.append(f"""t{i} AS MATERIALIZED (SELECT node FROM r{i - 1} WHERE node NOT IN (SELECT node FROM x{i - 1}) ORDER BY count DESC NULLS LAST, node DESC LIMIT 1),
x{i} AS MATERIALIZED (SELECT node FROM x{i - 1} UNION SELECT node FROM t{i}),
n{i} AS MATERIALIZED (SELECT DISTINCT c.node, c.count, {i} AS round FROM e JOIN t{i} ON e.src = t{i}.node JOIN c ON c.node = e.dst WHERE c.count >= (SELECT max(count) FROM r{i - 1})),
r{i} AS MATERIALIZED (SELECT * FROM n{i} UNION ALL SELECT * FROM r{i - 1} WHERE node NOT IN (SELECT node FROM n{i}))""")
    return ",\n".join(parts) + f"\nSELECT node, count, CAST(round AS INTEGER) AS round FROM r{ROUNDS}"


@query("web_best_first", _best_first_sql())
def web_best_first(spark, d):
    """Best-first expansion from the page of the lowest count, 4 rounds."""
    edge, counts, start = _walk(spark, d)
    if start is None:
        return counts.select(F.col("url").alias("node"), "count", F.lit(0).alias("round"))
    return web.best_first(edge, counts, start["url"], ROUNDS).select("node", "count", "round")


def _threshold_sql():
    parts = [f"WITH {WALK_SQL},\nr0 AS MATERIALIZED (SELECT node, count, 0 AS layer FROM st)"]
    for i in range(1, ROUNDS + 1):
        parts.append(f"""r{i} AS MATERIALIZED (SELECT * FROM r{i - 1} UNION ALL
  SELECT DISTINCT c.node, c.count, {i} FROM r{i - 1} f JOIN e ON e.src = f.node JOIN c ON c.node = e.dst
  WHERE f.layer = {i - 1} AND c.node NOT IN (SELECT node FROM r{i - 1}) AND c.count > (SELECT avg(count) FROM r{i - 1}))""")
    return ",\n".join(parts) + f"\nSELECT node, CAST(layer AS INTEGER) AS layer, count FROM r{ROUNDS}"


@query("web_threshold", _threshold_sql())
def web_threshold(spark, d):
    """Layered expansion from the page of the lowest count, keeping pages above the running mean."""
    edge, counts, start = _walk(spark, d)
    if start is None:
        return counts.select(F.col("url").alias("node"), F.lit(0).alias("layer"), "count")
    return web.expand_above_mean(edge, counts, start["url"], ROUNDS).select("node", "layer", "count")


@query("web_errors", """WITH e AS (SELECT DISTINCT unnest(list_filter(regexp_extract_all(lower(html), 'href=[^"]*"([^"]*)"', 1), lambda x: strpos(x, '/') > 0)) AS node FROM pages),
st AS (SELECT CASE WHEN html IS NULL OR length(html) = 0 THEN 'empty' ELSE 'ok' END AS reason FROM pages
  UNION ALL SELECT 'missing' FROM e WHERE node NOT IN (SELECT url FROM pages))
SELECT reason, count(*) AS count FROM st GROUP BY reason""")
def web_errors(spark, d):
    p = t(spark, d, "pages")
    return web.errors(p, web.edges(p, must_contain="/"))
