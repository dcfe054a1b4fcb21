"""Exact top-k search by inner product over norm buckets.

Vectors become integers floor(256 x). They are grouped by length into norm buckets, longest first,
and each bucket is cut into blocks of at most ``BLOCK_ROWS`` vectors, sorted by length. Queries
form blocks too. Each query first meets the longest block, which gives a lower bound of its k-th
score. A bucket whose longest vector cannot reach the bound of any query of a block is not paired
with it. Within a pair the bound divided by both lengths is the local cosine threshold: where it is
high the largest coordinate of the query prunes (a vector at that cosine must have that coordinate
within an interval), where it is low the prefix of vectors that are long enough does. What is left
is verified by the product itself, in float64 where all sums stay below 2**53 and in integers else.

The queries are a stated set (every id divisible by 50) met in blocks by all rows; no row pairs are
made, only up to k results a query and pair of blocks, and a pruned pair is one that provably
holds no result. A bucket of equal lengths is cut into many blocks, so no task grows with it.

Defined cases: vectors that are null or hold a null, NaN or infinite component take no part, neither
as queries nor as candidates; shorter vectors count as filled up with zeros; a query's own row is the
row with its id (of rows with one id, all); repeated candidate rows of another id are each a result;
products beyond 64 bits are not supported;
ties go to the smaller id; fewer candidates than k give fewer rows; no rows give none; other columns
are not looked at. Sums beyond 64 bits are not supported.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import materialize

K = 5
SCALE = 256
BUCKETS = 32
BLOCK_ROWS = 2048
QUERY_ROWS = 1024
EXACT = float(1 << 53)
#: Above this local cosine threshold the coordinate test is tried, else length alone.
COORDINATE_FROM = 0.6

BLOCK = "ids binary, vecs binary, n int, dim int, longest double"


def usable(vec: Column) -> Column:
    ok = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vec.isNotNull() & ok


def integers(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, v): usable vectors as integer arrays. A row without an id takes no part: no result could name it."""
    v = F.transform(F.col(vec_col), lambda x: x.cast("double"))
    return df.where(usable(v) & F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.transform(v, lambda x: F.floor(F.lit(float(SCALE)) * x)).alias("v"))


def _block(pdf: pd.DataFrame) -> pd.DataFrame:
    """One row holding the group's vectors, longest first, as int64 bytes."""
    ids = pdf["id"].to_numpy(np.int64)
    dim = max((len(v) for v in pdf["v"]), default=0)
    m = np.zeros((len(ids), dim), np.int64)
    for r, v in enumerate(pdf["v"]):
        m[r, :len(v)] = v
    norm = np.sqrt((m.astype(np.float64) ** 2).sum(1))
    order = np.lexsort((ids, -norm))
    return pd.DataFrame({"ids": [ids[order].tobytes()], "vecs": [m[order].tobytes()], "n": [len(ids)], "dim": [dim], "longest": [float(norm.max(initial=0.0))]})


def _read(ids: bytes, vecs: bytes, n: int, dim: int) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(ids, np.int64), np.frombuffer(vecs, np.int64).reshape(n, dim)


def products(q: np.ndarray, p: np.ndarray) -> np.ndarray:
    d = min(q.shape[1], p.shape[1])
    q, p = q[:, :d], p[:, :d]
    most = float(np.abs(q).max(initial=0)) * float(np.abs(p).max(initial=0)) * max(d, 1)
    if most < EXACT:
        return (q.astype(np.float64) @ p.astype(np.float64).T).astype(np.int64)
    return q @ p.T


def best(qids: np.ndarray, q: np.ndarray, ids: np.ndarray, p: np.ndarray, bound: np.ndarray, k: int) -> tuple[list, list, list]:
    """Up to k results a query among the block's vectors (longest first), all at or above the
    query's bound (-inf: none)."""
    qn = np.sqrt((q.astype(np.float64) ** 2).sum(1))
    pn = np.sqrt((p.astype(np.float64) ** 2).sum(1))
    with np.errstate(divide="ignore", invalid="ignore"):
        need = np.where((bound > 0) & (qn > 0), bound / qn, 0.0) * (1 - 1e-9)
        local = np.where((bound > 0) & (pn[:1].max(initial=0) > 0), need / pn[:1].max(initial=0), 0.0)
    reach = np.searchsorted(-pn, -need, side="right")
    out_q, out_v, out_s = [], [], []
    # Queries that length alone prunes share one product over the longest prefix any of them needs.
    live = (need <= pn[:1].max(initial=0)) | (bound <= 0)
    coordinate = live & (local > COORDINATE_FROM)
    plain = np.flatnonzero(live & ~coordinate)
    if len(plain):
        upto = int(reach[plain].max())
        scores = products(q[plain], p[:upto])
        for i, row in zip(plain, scores):
            _keep(qids[i], ids[:upto], row, bound[i], k, out_q, out_v, out_s)
    for i in np.flatnonzero(coordinate):
        upto = int(reach[i])
        f = int(np.abs(q[i]).argmax())
        if f < p.shape[1]:
            # cos <= c x + sqrt(1 - c^2) sqrt(1 - x^2) for unit vectors with coordinates c and x
            at = need[i] / pn[:upto]
            c, x = q[i, f] / qn[i], p[:upto, f] / pn[:upto]
            most = c * x + np.sqrt(max(0.0, 1 - c * c)) * np.sqrt(np.maximum(0.0, 1 - x * x))
            hit = np.flatnonzero(most >= at - 1e-9)
        else:
            hit = np.arange(upto)
        _keep(qids[i], ids[hit], products(q[i:i + 1], p[hit])[0], bound[i], k, out_q, out_v, out_s)
    return out_q, out_v, out_s


def _keep(qid, ids: np.ndarray, scores: np.ndarray, bound: float, k: int, out_q: list, out_v: list, out_s: list) -> None:
    ok = (ids != qid) & (scores >= bound)
    ids, scores = ids[ok], scores[ok]
    if len(ids) > k:
        kth = np.partition(scores, len(scores) - k)[len(scores) - k]
        ids, scores = ids[scores >= kth], scores[scores >= kth]
    order = np.lexsort((ids, -scores))[:k]
    out_q += [int(qid)] * len(order)
    out_v += ids[order].tolist()
    out_s += scores[order].tolist()


def search(queries: DataFrame, points: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", k: int = K,
           buckets: int = BUCKETS, block_rows: int = BLOCK_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` rows of ``points`` with the largest integer
    products for each row of ``queries``, leaving out the query's own."""
    spark = points.sparkSession
    ints = integers(points, id_col, vec_col)
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x)
    normed = materialize(ints.withColumn("sq", square), "topk-points")
    cuts = normed.select(F.percentile_approx("sq", [i / buckets for i in range(1, buckets)], 10_000)).first()[0] or []
    cuts = sorted(set(cuts), reverse=True)
    # Bucket 0 holds the longest vectors; the number of cuts above a length is its bucket.
    bucket = F.aggregate(F.array(*[F.lit(c) for c in cuts]), F.lit(0), lambda a, c: a + (c > F.col("sq")).cast("int")) if cuts else F.lit(0)
    bucketed = normed.withColumn("bucket", bucket)
    sizes = {r["bucket"]: r["n"] for r in bucketed.groupBy("bucket").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    pieces = {b: max(1, -(-n // block_rows)) for b, n in sizes.items()}
    first, at = {}, 0
    for b in sorted(pieces):
        first[b], at = at, at + pieces[b]
    of = lambda d: F.element_at(F.create_map(*[F.lit(x) for kv in d.items() for x in kv]), F.col("bucket"))
    block = of(first) + F.pmod(F.xxhash64("id", F.lit(3)), of(pieces)).cast("int")
    blocks = materialize(bucketed.select(block.alias("block"), "bucket", "id", "v").groupBy("block", "bucket").applyInPandas(
        lambda key, pdf: _block(pdf).assign(block=int(key[0]), bucket=int(key[1])), f"block int, bucket int, {BLOCK}"), "topk-blocks")
    longest = {r["bucket"]: r["m"] for r in blocks.groupBy("bucket").agg(F.max("longest").alias("m")).collect()}

    q = integers(queries, id_col, vec_col)
    n_q = q.count()
    q_blocks = q.withColumn("qb", F.pmod(F.xxhash64("id", F.lit(5)), F.lit(max(1, -(-n_q // query_rows)))).cast("int")).groupBy("qb").applyInPandas(
        lambda key, pdf: _block(pdf).assign(qb=int(key[0])), f"qb int, {BLOCK}")
    found = "query_id long, vec_id long, score long"
    seed_block = blocks.agg(F.min("block").alias("b"))
    seeds = blocks.join(F.broadcast(seed_block), F.col("block") == F.col("b")).select(*[F.col(c).alias(f"p_{c}") for c in ("ids", "vecs", "n", "dim", "block")])

    def seeded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for r in pdf.itertuples():
                qids, qv = _read(r.ids, r.vecs, r.n, r.dim)
                ids, p = _read(r.p_ids, r.p_vecs, r.p_n, r.p_dim)
                a, b, s = best(qids, qv, ids, p, np.full(len(qids), -np.inf), k)
                tops: dict = {}
                for x, y in zip(a, s):
                    tops.setdefault(x, []).append(y)
                bound = np.array([min(tops[x]) if len(tops.get(x, ())) == k else -np.inf for x in qids.tolist()], np.float64)
                qn = np.sqrt((qv.astype(np.float64) ** 2).sum(1))
                need = np.where((bound > 0) & (qn > 0), bound / np.where(qn > 0, qn, 1.0), 0.0)
                rows.append((r.qb, r.ids, r.vecs, r.n, r.dim, float(need.min(initial=np.inf)) * (1 - 1e-9), bound.tobytes(),
                             np.array(a, np.int64).tobytes(), np.array(b, np.int64).tobytes(), np.array(s, np.int64).tobytes(), r.p_block))
            yield pd.DataFrame(rows, columns=["qb", "ids", "vecs", "n", "dim", "need", "bound", "a", "b", "s", "seed"])

    # The seed block is one row of at most block_rows vectors: a broadcast of bounded size.
    with_seed = q_blocks.withColumn("one", F.lit(1)).join(F.broadcast(seeds.withColumn("one", F.lit(1))), "one")
    started = materialize(with_seed.drop("one").mapInPandas(seeded, "qb int, ids binary, vecs binary, n int, dim int, need double, bound binary, a binary, b binary, s binary, seed int"), "topk-queries")

    spans = F.array(*[F.struct(F.lit(float(longest.get(b, 0.0))).alias("m"), F.lit(first[b]).alias("lo"), F.lit(first[b] + pieces[b] - 1).alias("hi")) for b in sorted(pieces)])
    reach = F.flatten(F.transform(F.filter(spans, lambda x: x["m"] >= F.col("need")), lambda x: F.sequence(x["lo"], x["hi"])))
    pairs = started.select("qb", "seed", F.explode(reach).alias("block")).where("block <> seed")
    left = started.select("qb", *[F.col(c).alias(f"q_{c}") for c in ("ids", "vecs", "n", "dim", "bound")])
    paired = pairs.join(blocks.select("block", "ids", "vecs", "n", "dim"), "block").join(left, "qb")

    def scored(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for r in pdf.itertuples():
                qids, qv = _read(r.q_ids, r.q_vecs, r.q_n, r.q_dim)
                ids, p = _read(r.ids, r.vecs, r.n, r.dim)
                a, b, s = best(qids, qv, ids, p, np.frombuffer(r.q_bound, np.float64), k)
                yield pd.DataFrame({"query_id": a, "vec_id": b, "score": s}, dtype=np.int64)

    def unpacked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for r in pdf.itertuples():
                yield pd.DataFrame({"query_id": np.frombuffer(r.a, np.int64), "vec_id": np.frombuffer(r.b, np.int64), "score": np.frombuffer(r.s, np.int64)})

    results = started.select("a", "b", "s").mapInPandas(unpacked, found).unionByName(paired.mapInPandas(scored, found))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return results.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
