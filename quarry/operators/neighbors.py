"""Exact k nearest neighbours by blocks, and the votes of the neighbours."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def sq_dist(a, b) -> Column:
    """Squared Euclidean distance of two double arrays, summed left to right."""
    ca = F.col(a) if isinstance(a, str) else a
    cb = F.col(b) if isinstance(b, str) else b
    return F.aggregate(F.zip_with(ca, cb, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, v: s + v)


def _as_double(c: str) -> Column:
    return F.transform(F.col(c), lambda x: x.cast("double"))


def knn(queries: DataFrame, points: DataFrame, k: int, qid: str, pid: str, vec: str, block_rows: int = 2048,
        query_rows: int = 16384) -> DataFrame:
    """(qid, rank, pid, dist): the k nearest points of every query, rank 1 = nearest, ties -> smaller pid.

    Exact: points are dealt by hash into blocks of about ``block_rows``, queries into parts of about
    ``query_rows``, and every part meets every block in rows of one vector each: a task reads the points of
    a block first, then its queries one after the other, so it holds one block and one batch of rows. Only
    the k best of a query and block leave it. The arithmetic is |queries| x |points|, with no row for a
    pair. Null vectors take no part.
    """
    def dealt(df: DataFrame, key: str, rows: int, salt: int) -> tuple[DataFrame, Column, int]:
        ok = df.filter(F.col(vec).isNotNull())
        n = max(1, -(-ok.count() // rows))
        v = F.col(vec) if df.schema[vec].dataType.simpleString() in ("array<float>", "array<double>") else _as_double(vec)
        return ok.select(F.col(key).alias("key"), v.alias("v")), F.pmod(F.xxhash64("key", F.lit(salt)), F.lit(n)), n

    pts, p_block, n = dealt(points, pid, block_rows, 1)
    qs, q_part, m = dealt(queries, qid, query_rows, 2)
    types = {n: df.schema[c].dataType.simpleString() for n, df, c in (("qid", queries, qid), ("pid", points, pid))}
    each = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    pts = pts.select(p_block.alias("block"), each(m).alias("part"), F.lit(False).alias("asks"), F.lit(None).cast(types["qid"]).alias("qid"), F.col("key").alias("pid"), "v")
    qs = qs.select(each(n).alias("block"), q_part.alias("part"), F.lit(True).alias("asks"), F.col("key").alias("qid"), F.lit(None).cast(types["pid"]).alias("pid"), "v")

    def vectors(v) -> np.ndarray:
        sizes = pc.list_value_length(v).to_numpy()
        if (sizes != sizes[0]).any():
            raise ValueError("vectors differ in length")
        return v.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(v), -1)

    def nearest(batches):
        of, ids, p = None, [], []  # the group whose points are held, their ids in order, the points
        for b in batches:
            group = np.column_stack([b.column(0).to_numpy(), b.column(1).to_numpy(), b.column(2).to_numpy(zero_copy_only=False)])
            at = np.flatnonzero(np.r_[True, (group[1:] != group[:-1]).any(axis=1)]) if len(group) else []
            for lo, hi in zip(at, np.append(at[1:], len(group))):
                mine, v = tuple(group[lo, :2]), vectors(b.column(5).slice(lo, hi - lo))
                if not group[lo, 2]:
                    if mine != of:
                        of, ids, p = mine, [], []
                    ids.append(b.column(4).slice(lo, hi - lo))
                    p.append(v)
                    continue
                if mine != of:  # no points in this block
                    continue
                if len(p) > 1:
                    ids, p = [pa.concat_arrays(ids)], [np.concatenate(p)]
                whole, near, d = p[0], [], []
                for q in v:
                    to = np.sqrt(((whole - q) ** 2).sum(axis=1))
                    some = np.flatnonzero(to <= np.partition(to, k - 1)[k - 1]) if len(to) > k else np.arange(len(to))
                    some = some[np.argsort(to[some], kind="stable")][:k]
                    near.append(some)
                    d.append(to[some])
                asked = np.repeat(np.arange(lo, hi), [len(x) for x in near])
                yield pa.RecordBatch.from_arrays([b.column(3).take(pa.array(asked)), ids[0].take(pa.array(np.concatenate(near))), pa.array(np.concatenate(d), from_pandas=False)], ["qid", "pid", "dist"])

    rows = pts.unionByName(qs).repartition(n * m, "block", "part").sortWithinPartitions("block", "part", "asks", "pid")
    best = rows.mapInArrow(nearest, f"qid {types['qid']}, pid {types['pid']}, dist double")
    rank = F.row_number().over(Window.partitionBy("qid").orderBy("dist", "pid"))
    return best.withColumn("rank", rank).filter(F.col("rank") <= k).select(
        F.col("qid").alias(qid), F.col("rank").cast("int").alias("rank"), F.col("pid").alias(pid), "dist")


def knn_vote(neighbors: DataFrame, labels: DataFrame, qid: str, pid: str, label: str) -> DataFrame:
    """Distance-weighted class vote (weight 1 / d); neighbours at distance 0 outvote all others.
    (qid, pred, score); ties -> smallest label."""
    j = neighbors.join(labels.select(pid, label), pid)
    has_zero = j.groupBy(qid).agg(F.max((F.col("dist") == 0).cast("int")).alias("__z"))
    j = j.join(has_zero, qid)
    wgt = F.when(F.col("__z") == 1, (F.col("dist") == 0).cast("double")).otherwise(1.0 / F.col("dist"))
    per = j.groupBy(qid, label).agg(F.sum(wgt).alias("score"))
    return per.groupBy(qid).agg(F.max_by(F.col(label), F.struct(F.col("score"), -F.col(label))).alias("pred"),
                                F.max("score").alias("score"))
