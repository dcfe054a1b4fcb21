"""Many binary logistic models in a few scans: one a segment, or one a (fold, penalty).

All models take Newton steps together. A round is one pass over the table that sums, for each model,
the loss, its gradient and its second derivatives; the steps are small solves of (features + 1)
equations. The objective is that of ``pyspark.ml``: mean log loss + reg * ((1 - l1) / 2 * sum (sd_j b_j)^2
+ l1 * sum |sd_j b_j|), sd_j the deviation of feature j in the model's own rows, the intercept free; a
feature that is constant there has coefficient 0. A step that raises a model's objective is halved.

* ``segmented``: the rows are dealt by segment once, and a task takes all steps of its segments, those of a
  batch of rows together. For segments of over ``LOCAL_ROWS`` rows, few by their size, sums are grouped by
  segment in Spark in rounds (partial sums before the shuffle, so a segment with a third of the rows is no
  single task). Rounds do not grow with the number of segments; nothing of a segment but the names of the
  large ones is sent around.
* ``grid``: folds x penalties, also without a fold left out. The rows are written once, in parts of
  ``TASK_ROWS``, and a task takes ``CHUNK`` of them at a time against all models. A partition sends one row of sums a fold;
  models and their sums (bounded by the parameters) come to the driver.

Defined cases: rows with a null label or a null or NaN feature take no part in fits, and get no
probability; a null segment is a segment; a segment with one class has coefficients 0 and an infinite
intercept, so it always predicts this class; an empty table gives no models.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.session import staged

ROUNDS = 60
TOL = 1e-8
LOCAL_ROWS = 50_000
TASK_ROWS = 20_000
CHUNK = 512


# ---- steps of many models at once

def _penalised(beta: np.ndarray, sd: np.ndarray, reg: np.ndarray, l1: np.ndarray) -> np.ndarray:
    b = np.abs(beta[:, :-1] * sd)
    return reg * ((1 - l1) / 2 * (b * b).sum(1) + l1 * b.sum(1))


def _shrunk(h: np.ndarray, g: np.ndarray, beta: np.ndarray, weight: np.ndarray, sweeps: int = 200) -> np.ndarray:
    """Steps that minimise the quadratic models plus ``weight`` . |beta + step|, by coordinates."""
    step, grad = np.zeros_like(beta), g.copy()
    for _ in range(sweeps):
        most = 0.0
        for j in range(beta.shape[1]):
            a, b = h[:, j, j], beta[:, j] + step[:, j]
            z = b - grad[:, j] / a
            new = np.sign(z) * np.maximum(np.abs(z) - weight[:, j] / a, 0) if j < beta.shape[1] - 1 else z
            move = new - b
            step[:, j] += move
            grad += h[:, :, j] * move[:, None]
            most = max(most, float(np.abs(move).max(initial=0)))
        if most < 1e-12:
            break
    return step


def advance(beta, prev, before, done, loss, g, h, sd, reg, l1):
    """One round for all models: mean ``loss``, ``g`` (models x p) and ``h`` (models x p x p) at
    ``beta``, the intercept last. Returns the next ``beta, prev, before, done``."""
    m, p = beta.shape
    now = loss + _penalised(beta, sd, reg, l1)
    worse = ~done & (now > before + 1e-12 * np.maximum(1, np.abs(before)))
    flat = np.c_[sd > 0, np.ones((m, 1), bool)]
    g, h = np.where(flat, g, 0), np.where(flat[:, :, None] & flat[:, None, :], h, 0)
    scale = np.c_[sd, np.zeros((m, 1))]
    g = g + (reg * (1 - l1))[:, None] * scale ** 2 * beta
    h = h + (np.where(flat, (reg * (1 - l1))[:, None] * scale ** 2 + 1e-10, 1.0))[:, :, None] * np.eye(p)
    step = np.zeros_like(beta)
    smooth = (reg * l1) == 0
    if smooth.any():
        step[smooth] = -np.linalg.solve(h[smooth], g[smooth][:, :, None])[:, :, 0]
    if (~smooth).any():
        k = ~smooth
        step[k] = _shrunk(h[k], g[k], beta[k], (reg * l1)[k][:, None] * scale[k])
    step = np.where(flat, step, 0)
    size = np.abs(step * np.where(scale > 0, scale, 1)).max(1, initial=0)
    nxt = np.where(done[:, None], beta, np.where(worse[:, None], (beta + prev) / 2, beta + step))
    stuck = worse & (np.abs(beta - prev).max(1, initial=0) < TOL)
    return nxt, np.where((done | worse)[:, None], prev, beta), np.where(done | worse, before, now), done | stuck | (~worse & (size < TOL))


def _scale(df: DataFrame, features: str, d: int) -> tuple[np.ndarray, np.ndarray]:
    """Mean and deviation of each feature, to which all sums are taken (the models do not depend on them)."""
    r = df.agg(*[f(F.col(features)[j]).alias(f"{n}{j}") for j in range(d) for n, f in (("m", F.avg), ("s", F.stddev_pop))]).first()
    mean = np.array([r[f"m{j}"] or 0.0 for j in range(d)])
    sd = np.array([r[f"s{j}"] or 0.0 for j in range(d)])
    return mean, np.where(sd > 0, sd, 1.0)


def _usable(df: DataFrame, label: str, features: str) -> DataFrame:
    return df.where(F.col(label).isNotNull() & F.col(features).isNotNull() & ~F.exists(features, lambda x: x.isNull() | F.isnan(x)))


def _width(df: DataFrame, features: str) -> int:
    r = df.select(F.size(features).alias("d")).first()
    return r["d"] if r else 0


def _original(beta: np.ndarray, mean: np.ndarray, sd: np.ndarray) -> np.ndarray:
    """Coefficients for the features as they are."""
    b = beta[:, :-1] / sd
    with np.errstate(invalid="ignore"):
        return np.c_[b, beta[:, -1] - (b * mean).sum(1)]


# ---- a model for every segment

def segmented(df: DataFrame, segment: str, label: str, features: str, reg: float = 0.0, l1: float = 0.0, rounds: int = ROUNDS) -> DataFrame:
    """``segment``, ``n``, ``coefficients`` (in the features' order) and ``intercept`` of one model a segment,
    each as if fitted alone. ``features`` is an array column of doubles, ``label`` 0 or 1."""
    rows = _usable(df.select(segment, F.col(label).cast("double").alias("y"), F.col(features).cast("array<double>").alias("x")), "y", "x")
    d = _width(rows, "x")
    if not d:
        return rows.groupBy(segment).agg(F.count("*").alias("n")).select(segment, "n", F.array().cast("array<double>").alias("coefficients"), F.lit(None).cast("double").alias("intercept"))
    mean, scale = _scale(rows, "x", d)
    z = [(F.col("x")[j] - float(mean[j])) / float(scale[j]) for j in range(d)]
    rows = rows.select(segment, "y", *[c.alias(f"z{j}") for j, c in enumerate(z)])
    counts = rows.groupBy(F.col(segment).alias("__large")).agg(F.count("*").alias("__n")).where(F.col("__n") > LOCAL_ROWS).select("__large")
    large = staged(counts, "logistic-large")
    back = [F.col("beta")[j] / float(scale[j]) for j in range(d)]
    shift = sum((back[j] * float(mean[j]) for j in range(d)), F.lit(0.0))
    table = [F.col("__seg").alias(segment), "n", F.array(*back).alias("coefficients"), (F.col("beta")[d] - shift).alias("intercept")]
    if large.isEmpty():
        return staged(_in_tasks(rows, segment, d, reg, l1, rounds).select(*table), "logistic-models")
    is_large = F.col(segment).eqNullSafe(F.col("__large"))
    small = staged(_in_tasks(rows.join(F.broadcast(large), is_large, "left_anti"), segment, d, reg, l1, rounds).select(*table), "logistic-models")
    rows = rows.join(F.broadcast(large), is_large, "left_semi")
    own = rows.groupBy(segment).agg(F.count("*").alias("n"), F.sum("y").alias("pos"), F.array(*[F.coalesce(F.stddev(f"z{j}"), F.lit(0.0)) for j in range(d)]).alias("sd"))
    zero = F.array(*[F.lit(0.0)] * (d + 1))
    one_class = (F.col("pos") <= 0) | (F.col("pos") >= F.col("n"))
    ends = F.array(*[F.lit(0.0)] * d, F.when(F.col("pos") > 0, F.lit(float("inf"))).otherwise(F.lit(float("-inf"))))
    state = staged(own.select(F.col(segment).alias("__seg"), "n", "sd", F.when(one_class, ends).otherwise(zero).alias("beta"), zero.alias("prev"),
                              F.lit(float("inf")).alias("before"), one_class.alias("done")), "logistic-state")
    zs = [F.col(f"z{j}") for j in range(d)] + [F.lit(1.0)]
    p = F.lit(1.0) / (1 + F.exp(-F.col("eta")))
    sums = [F.sum(F.greatest("eta", F.lit(0.0)) + F.log1p(F.exp(-F.abs("eta"))) - F.col("y") * F.col("eta")).alias("loss")]
    sums += [F.sum((F.col("p") - F.col("y")) * zs[i]).alias(f"g{i}") for i in range(d + 1)]
    pairs = [(i, j) for i in range(d + 1) for j in range(i, d + 1)]
    sums += [F.sum(F.col("p") * (1 - F.col("p")) * zs[i] * zs[j]).alias(f"h{i}_{j}") for i, j in pairs]

    def step(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if not len(b):
                continue
            n, get = b["n"].to_numpy(float), lambda c: np.stack(b[c].to_numpy())  # noqa: B023
            h = np.empty((len(b), d + 1, d + 1))
            for i, j in pairs:
                h[:, i, j] = h[:, j, i] = b[f"h{i}_{j}"].to_numpy() / n
            g = np.column_stack([b[f"g{i}"].to_numpy() / n for i in range(d + 1)])
            k = np.full(len(b), 1.0)
            beta, prev, before, done = advance(get("beta"), get("prev"), b["before"].to_numpy(), b["done"].to_numpy(bool), b["loss"].to_numpy() / n, g, h, get("sd"), reg * k, l1 * k)
            yield pd.DataFrame({"__seg": b["__seg"], "n": b["n"], "sd": b["sd"], "beta": list(beta), "prev": list(prev), "before": before, "done": done})
    for _ in range(rounds):
        if state.where("not done").isEmpty():
            break
        live = state.where("not done")
        met = rows.join(live.select("__seg", "beta"), F.col(segment).eqNullSafe(F.col("__seg")))
        eta = sum((F.col("beta")[j] * zs[j] for j in range(d)), F.col("beta")[d])
        found = met.withColumn("eta", eta).withColumn("p", p).groupBy(F.col("__seg").alias("__of")).agg(*sums)
        moved = live.join(found, F.col("__seg").eqNullSafe(F.col("__of"))).drop("__of").mapInPandas(step, state.schema)
        state = staged(moved.unionByName(state.where("done")), "logistic-state")
    return state.select(*table).unionByName(small)


def _in_tasks(rows: DataFrame, segment: str, d: int, reg: float, l1: float, rounds: int) -> DataFrame:
    """(__seg, n, beta) of the segments of ``rows`` (segment, y, z0 ...), each of at most ``LOCAL_ROWS`` rows:
    dealt by segment once, all rounds where the rows are."""
    pairs = [(i, j) for i in range(d + 1) for j in range(i, d + 1)]

    def fitted(y: np.ndarray, z: np.ndarray, head: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of rows and parameters of the segments that start at ``head``."""
        n = np.diff(head, append=len(y))
        add = lambda x, at: np.add.reduceat(x, at, axis=0)
        off = z - np.repeat(z[head], n, axis=0)  # of a constant exactly 0
        off -= np.repeat(add(off, head) / n[:, None], n, axis=0)
        sd = np.sqrt(add(off * off, head) / np.maximum(n - 1, 1)[:, None])
        pos, x = add(y, head), np.c_[z, np.ones(len(y))]
        beta, done = np.zeros((len(n), d + 1)), (pos <= 0) | (pos >= n)
        beta[done, d] = np.where(pos[done] > 0, np.inf, -np.inf)
        prev, before, live, size = np.zeros_like(beta), np.full(len(n), np.inf), np.flatnonzero(~done), n
        keep = np.repeat(~done, n)
        x, y = x[keep], y[keep]
        for _ in range(rounds):
            if not len(live):
                break
            m = size[live]
            at = np.cumsum(m) - m
            eta = (x * np.repeat(beta[live], m, axis=0)).sum(1)
            with np.errstate(over="ignore"):
                p = 1 / (1 + np.exp(-eta))
            loss = add(np.maximum(eta, 0) + np.log1p(np.exp(-np.abs(eta))) - y * eta, at) / m
            g = add((p - y)[:, None] * x, at) / m[:, None]
            h, w = np.empty((len(live), d + 1, d + 1)), p * (1 - p)
            for i, j in pairs:
                h[:, i, j] = h[:, j, i] = add(w * x[:, i] * x[:, j], at) / m
            one = np.ones(len(live))
            beta[live], prev[live], before[live], now = advance(beta[live], prev[live], before[live], np.zeros(len(live), bool), loss, g, h, sd[live], reg * one, l1 * one)
            keep = np.repeat(~now, m)
            x, y, live = x[keep], y[keep], live[~now]
        return n, beta

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []  # the rows of the last segment, which may go on

        def out(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
            t = pa.Table.from_batches(parts).combine_chunks()
            get = lambda c: t.column(c).to_numpy()
            head = np.flatnonzero(get("at") == 1)
            n, beta = fitted(get("y"), np.column_stack([get(f"z{j}") for j in range(d)]), head)
            params = pa.ListArray.from_arrays(pa.array(np.arange(len(n) + 1, dtype=np.int32) * (d + 1)), pa.array(beta.ravel()))
            return pa.RecordBatch.from_arrays([pa.concat_arrays(t.column("__seg").take(pa.array(head)).chunks), pa.array(n.astype(np.int64)), params], ["__seg", "n", "beta"])

        for b in batches:
            heads = np.flatnonzero(b.column("at").to_numpy() == 1)
            if len(heads) and (cut := int(heads[-1])) + sum(x.num_rows for x in held):
                yield out([*held, b.slice(0, cut)])
                held = [b.slice(cut)]
            elif b.num_rows:
                held.append(b)
        if held:
            yield out(held)

    at = F.row_number().over(Window.partitionBy(segment).orderBy(F.lit(1)))
    kind = rows.schema[segment].dataType.simpleString()
    return rows.select(F.col(segment).alias("__seg"), "y", *[f"z{j}" for j in range(d)], at.alias("at")).mapInArrow(run, f"__seg {kind}, n long, beta array<double>")


def predict(df: DataFrame, models: DataFrame, segment: str, features: str, out: str = "p1") -> DataFrame:
    """``df`` with the probability that its segment's model gives; null without a model or features."""
    m = models.select(F.col(segment).alias("__seg"), F.col("coefficients").alias("__c"), F.col("intercept").alias("__b"))
    j = df.join(m, F.col(segment).eqNullSafe(F.col("__seg")), "left")
    eta = F.aggregate(F.zip_with("__c", F.col(features).cast("array<double>"), lambda a, x: a * x), F.col("__b"), lambda a, x: a + x)
    p = F.when(eta.isNotNull() & ~F.isnan(eta), F.lit(1.0) / (1 + F.exp(-eta)))
    return j.withColumn(out, p).drop("__seg", "__c", "__b")


# ---- a model for every fold and penalty

def grid(df: DataFrame, fold: str, label: str, features: str, penalties: Sequence[tuple[float, float]], rounds: int = ROUNDS) -> dict:
    """Models of all (fold left out, (reg, l1)) and, with fold -1, of all rows, advanced together.

    ``fold`` holds 0 to k - 1. Returned: ``coefficients`` and ``intercept`` by (fold, place of the penalty),
    held-out ``correct``, ``loss`` and ``n`` by fold and penalty, and the ``scans`` that were needed."""
    rows = _usable(df.select(F.col(fold).cast("int").alias("fold"), F.col(label).cast("double").alias("y"), F.col(features).cast("array<double>").alias("x")), "y", "x").where("fold is not null")
    rows = staged(rows, "logistic-rows")
    if (parts := -(-rows.count() // TASK_ROWS)) > 1:
        rows = staged(rows.repartition(parts), "logistic-rows")
    d = _width(rows, "x")
    if not d:
        return {"coefficients": {}, "intercept": {}, "correct": np.empty((0, 0)), "loss": np.empty((0, 0)), "n": np.empty(0), "scans": 1}
    mean, scale = _scale(rows, "x", d)
    k = 1 + rows.agg(F.max("fold")).first()[0]
    folds = np.repeat(np.arange(-1, k), len(penalties))
    reg, l1 = (np.tile(np.array([q[i] for q in penalties], float), k + 1) for i in (0, 1))
    pairs = [(i, j) for i in range(d + 1) for j in range(i, d + 1)]

    def scan(work, width: int) -> dict[int, np.ndarray]:
        """Sums of ``work(fold of the rows, x with a column of ones, y)``, a list a fold of the models."""
        def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total: dict = {}
            for b in batches:
                fold_, y = b.column(0).to_numpy(), b.column(1).to_numpy()
                x = np.c_[(b.column(2).flatten().to_numpy().reshape(len(y), d) - mean) / scale, np.ones(len(y))]
                for f in np.unique(fold_):
                    of = np.flatnonzero(fold_ == f)
                    for c in range(0, len(of), CHUNK):
                        some = of[c:c + CHUNK]
                        for key, s in work(int(f), x[some], y[some]):
                            total[key] = total.get(key, 0) + s
            if total:
                yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([t.ravel() for t in total.values()], pa.list_(pa.float64()))], ["key", "sums"])

        def added(g: pd.DataFrame) -> pd.DataFrame:
            return pd.DataFrame({"key": g["key"].iloc[:1], "sums": [np.sum([np.asarray(s) for s in g["sums"]], 0).tolist()]})
        found = rows.mapInArrow(part, "key int, sums array<double>").groupBy("key").applyInPandas(added, "key int, sums array<double>").collect()
        return {r["key"]: np.array(r["sums"]).reshape(-1, width) for r in found}

    moments = scan(lambda f, x, y: [(f, np.r_[len(x), y.sum(), x[:, :-1].sum(0), (x[:, :-1] ** 2).sum(0)][None])], 2 + 2 * d)
    of = np.zeros((k, 2 + 2 * d))
    for f, s in moments.items():
        of[f] = s[0]
    mine = np.array([of[np.arange(k) != f].sum(0) for f in folds])
    n = mine[:, 0]
    var = (mine[:, 2 + d:] - mine[:, 2:2 + d] ** 2 / np.maximum(n, 1)[:, None]) / np.maximum(n - 1, 1)[:, None]
    sd = np.sqrt(np.where(var > 1e-12, var, 0))
    beta = np.zeros((len(folds), d + 1))
    done = (mine[:, 1] <= 0) | (mine[:, 1] >= n)
    beta[done, d] = np.where(mine[done, 1] > 0, np.inf, -np.inf)
    prev, before, scans = np.zeros_like(beta), np.full(len(folds), np.inf), 2
    while not done.all() and scans < rounds + 2:
        live = np.flatnonzero(~done)
        b, of_model = beta[live], folds[live]

        def work(f, x, y, b=b, of_model=of_model):
            some = of_model != f
            if not some.any():
                return
            eta = x @ b[some].T
            e = np.exp(-np.abs(eta))
            q = 1 / (1 + e)
            # the logarithm of the product of CHUNK factors from 1 to 2 is the sum of theirs
            loss = np.maximum(eta, 0).sum(0) + np.log(np.multiply.reduce(1 + e, axis=0)) - y @ eta
            g = (np.where(eta >= 0, q, e * q) - y[:, None]).T @ x
            h = (e * q * q).T @ np.column_stack([x[:, i] * x[:, j] for i, j in pairs])
            out = np.zeros((len(b), 1 + d + 1 + len(pairs)))
            out[some] = np.column_stack([loss, g, h])
            yield 0, out
        s = scan(work, 1 + d + 1 + len(pairs))[0] / n[live][:, None]
        h = np.empty((len(live), d + 1, d + 1))
        for c, (i, j) in enumerate(pairs):
            h[:, i, j] = h[:, j, i] = s[:, d + 2 + c]
        beta[live], prev[live], before[live], done[live] = advance(b, prev[live], before[live], done[live], s[:, 0], s[:, 1:d + 2], h, sd[live], reg[live], l1[live])
        scans += 1

    def judge(f, x, y):
        some = folds == f
        with np.errstate(over="ignore", invalid="ignore", divide="ignore"):
            eta = np.clip(x[:, :-1] @ beta[some][:, :-1].T + beta[some][:, -1], -1e3, 1e3)
        loss = np.maximum(eta, 0) + np.log1p(np.exp(-np.abs(eta))) - y[:, None] * eta
        yield f, np.column_stack([((eta > 0) == (y[:, None] > 0.5)).sum(0), loss.sum(0)]).astype(float)
    held = scan(judge, 2)
    correct, loss = (np.array([held[f][:, c] if f in held else np.zeros(len(penalties)) for f in range(k)]) for c in (0, 1))
    out = _original(beta, mean, scale)
    at = [(int(f), i % len(penalties)) for i, f in enumerate(folds)]
    return {"coefficients": {a: out[i, :-1] for i, a in enumerate(at)}, "intercept": {a: float(out[i, -1]) for i, a in enumerate(at)},
            "correct": correct, "loss": loss, "n": of[:, 0], "scans": scans + 1}


def grid_table(df: DataFrame, fold: str, label: str, features: str, penalties: Sequence[tuple[float, float]], rounds: int = ROUNDS) -> DataFrame:
    """A row a penalty: mean and deviation over the folds of the held-out accuracy, mean log loss, the
    coefficients over all rows, the scans for all models, and ``best``: the highest mean accuracy, of
    equal ones the strongest penalty."""
    g = grid(df, fold, label, features, penalties, rounds)
    schema = "reg double, l1 double, accuracy double, accuracy_sd double, log_loss double, coefficients array<double>, intercept double, scans int, best boolean"
    if not g["coefficients"]:
        return df.sparkSession.createDataFrame([], schema)
    have = g["n"] > 0
    acc, loss = g["correct"][have] / g["n"][have][:, None], g["loss"][have] / g["n"][have][:, None]
    top = max(range(len(penalties)), key=lambda i: (acc[:, i].mean(), penalties[i][0]))
    rows = [(float(r), float(a), float(acc[:, i].mean()), float(acc[:, i].std()), float(loss[:, i].mean()), g["coefficients"][-1, i].tolist(), g["intercept"][-1, i], g["scans"], i == top)
            for i, (r, a) in enumerate(penalties)]
    return df.sparkSession.createDataFrame(rows, schema)


def probability(features: Column, coefficients: Sequence[float], intercept: float) -> Column:
    eta = F.aggregate(F.zip_with(features.cast("array<double>"), F.array(*[F.lit(float(c)) for c in coefficients]), lambda x, c: x * c), F.lit(float(intercept)), lambda a, x: a + x)
    return F.lit(1.0) / (1 + F.exp(-eta))
