"""Spelling variants: words one edit apart, found by k-d trees over letter-count vectors.

A word is a point of letter counts (a-z and U+00C0 to U+00FF). One replaced letter takes one count
down and another one up, one inserted letter takes one count up: an L1 distance of two or one. For
each pair of lengths (L, L) and (L, L + 1) the words of the first are looked up in the tree over the
second; a box is entered only if the word's counts lie at most one letter below and, for equal
lengths, one above it. What stands in a box that is left is verified letter by letter.

Scale: documents are counted where they are read and summed by word. The upper planes of the trees
are fitted on a sample of ``SAMPLE`` words taken by hash; they only deal words out and change no
result. Every leaf is one group of about ``LEAF`` words (a leaf of more, that is of many anagrams, is
dealt to several groups), to which the words near its box are copied; in a group the tree goes on to
boxes of ``BOX`` words, with tight bounds around each. No group's pairs are made: a word meets the
boxes that its edits reach. The driver gets the sample, one count a length and one a leaf.

Defined cases: a null text has no words; a null doc_id counts as the empty string where runs lose a
letter; equal rows count as often as they stand there; an empty table gives no rows; ties between
near words go to the first in code-point order; other columns are not looked at. The number of
rows is that of the distinct words.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import materialize

MIN_LETTERS = 6
MIN_COUNT = 5
TIMES = 5
SAMPLE = 50_000
LEAF = 8192
SAMPLE_A_LEAF = 16
BOX = 16
KEYS_AT_ONCE = 300_000
SLICE_BYTES = 4 << 20
PAIRS_AT_ONCE = 1 << 20
#: Dimensions of a vector: a to z, then U+00C0 to U+00FF.
DIMS = 26 + 64
RUN = re.compile(r"[A-Za-zÀ-ÿ]+")


# ---- words and counts

def _runs(text: str) -> list[str]:
    """Runs of letters with only A-Z lower-cased."""
    return RUN.findall(text.encode().lower().decode())


def dropped(doc_id, run: str, every: int) -> str:
    """The run, without one letter where its hash with the document's id is divisible by ``every``."""
    h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
    return run if h % every else run[:(k := h % len(run))] + run[k + 1:]


def word_counts(docs: DataFrame, doc_id: Column, text: Column, drop_every: int | None = 199, min_letters: int = MIN_LETTERS, min_count: int = MIN_COUNT) -> DataFrame:
    """``word``, ``n``: the words of at least ``min_letters`` letters and ``min_count`` occurrences."""
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()

        def out() -> pa.RecordBatch:
            b = pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], names=["word", "n"])
            total.clear()
            return b
        for batch in batches:
            for at, body in zip(batch.column(0), batch.column(1)):  # one text at a time in Python
                at, runs = at.as_py(), Counter(_runs(body.as_py() or ""))
                if drop_every is None:
                    total.update({w: n for w, n in runs.items() if len(w) >= min_letters})
                else:
                    head = zlib.crc32(f"{'' if at is None else at}:".encode())
                    for w, n in runs.items():
                        if len(w) >= min_letters:
                            if zlib.crc32(w.encode(), head) % drop_every == 0:
                                w = dropped(at, w, drop_every)
                                if len(w) < min_letters:
                                    continue
                            total[w] += n
                if len(total) >= KEYS_AT_ONCE:
                    yield out()
        yield out()
    counts = docs.select(doc_id.alias("d"), text.alias("t")).mapInArrow(counted, "word string, n long")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


# ---- vectors, planes and boxes

def letters(words: np.ndarray, length: int) -> np.ndarray:
    """Code points of words of one length, a row a word."""
    return np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(len(words), length).astype(np.uint8)


def vectors(codes: np.ndarray) -> np.ndarray:
    """Letter counts of rows of code points."""
    dim = np.where(codes >= 0xC0, codes.astype(np.int64) - 0xC0 + 26, codes.astype(np.int64) - 0x61)
    at = np.arange(len(codes))[:, None] * DIMS + dim
    return np.bincount(at.ravel(), minlength=len(codes) * DIMS).reshape(-1, DIMS).astype(np.int16)


def plane(v: np.ndarray) -> tuple[int, int] | None:
    """Dimension and count that cut the vectors most evenly: at most this count, or more."""
    best, most = None, 0
    for t in range(int(v.max(initial=0))):
        low = (v <= t).sum(0)
        even = np.minimum(low, len(v) - low)
        if (d := int(even.argmax())) is not None and even[d] > most:
            best, most = (d, t), even[d]
    return best


def fit(v: np.ndarray, stands_for: float) -> list:
    """Planes over a sample of vectors, each standing for so many words: ``[dim, count, low, high]``
    nodes in a list, children by their place; a leaf is ``[-1, number, 0, 0]``, numbered in order."""
    nodes: list = []
    leaves = 0

    def grow(some: np.ndarray) -> int:
        nonlocal leaves
        me = len(nodes)
        nodes.append([-1, leaves, 0, 0])
        cut = plane(some) if len(some) * stands_for > LEAF and len(some) >= 2 * SAMPLE_A_LEAF else None
        if cut is None:
            leaves += 1
            return me
        low = some[:, cut[0]] <= cut[1]
        a = grow(some[low])
        nodes[me] = [cut[0], cut[1], a, grow(some[~low])]
        return me
    grow(v)
    return nodes


def reach(nodes: list, v: np.ndarray, up: int, down: int) -> Iterator[tuple[int, np.ndarray]]:
    """Leaves whose box lies within ``up`` counts above and ``down`` counts below a vector, each with
    the vectors that reach it. (0, 0) gives every vector its own leaf."""
    lo, hi = np.zeros(DIMS, int), np.full(DIMS, 1 << 14)

    def walk(k: int, rows: np.ndarray, above: np.ndarray, below: np.ndarray) -> Iterator:
        d, t, a, b = nodes[k]
        if d < 0:
            yield t, rows
            return
        x = v[rows, d].astype(int)
        was = hi[d]
        more = below + np.maximum(x - t, 0) - np.maximum(x - was, 0)
        ok = more <= down
        if ok.any():
            hi[d] = t
            yield from walk(a, rows[ok], above[ok], more[ok])
            hi[d] = was
        was = lo[d]
        more = above + np.maximum(t + 1 - x, 0) - np.maximum(was - x, 0)
        ok = more <= up
        if ok.any():
            lo[d] = t + 1
            yield from walk(b, rows[ok], more[ok], below[ok])
            lo[d] = was
    zero = np.zeros(len(v), int)
    yield from walk(0, np.arange(len(v)), zero, zero)


def boxed(v: np.ndarray, q: np.ndarray, up: int, down: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Boxes of about ``BOX`` points, each with the queries that reach it: the tree goes on below the
    planes, pruned at every cut, and at its ends by the tight bounds of the points."""
    if not len(v) or not len(q):
        return
    used = np.flatnonzero(v.any(0) | q.any(0))  # fewer dimensions and small counts: the same distances
    small = np.int8 if max(v.max(), q.max()) < 60 else np.int16
    v, q = v[:, used].astype(small), q[:, used].astype(small)
    columns = np.ascontiguousarray(q.T)
    lo, hi = np.zeros(len(used), small), np.full(len(used), np.iinfo(small).max // 2, small)

    def walk(points: np.ndarray, rows: np.ndarray, above: np.ndarray, below: np.ndarray) -> Iterator:
        cut = plane(v[points]) if len(points) > BOX else None
        if cut is None:
            x = q[rows]
            ok = (np.maximum(v[points].min(0) - x, 0).sum(1) <= up) & (np.maximum(x - v[points].max(0), 0).sum(1) <= down)
            if ok.any():
                yield points, rows[ok]
            return
        d, t = cut
        x, low = columns[d][rows], v[points, d] <= t
        more, was = below + np.maximum(x - t, 0) - np.maximum(x - hi[d], 0), hi[d]
        ok = more <= down
        if ok.any():
            hi[d] = t
            yield from walk(points[low], rows[ok], above[ok], more[ok])
            hi[d] = was
        more, was = above + np.maximum(t + 1 - x, 0) - np.maximum(lo[d] - x, 0), lo[d]
        ok = more <= up
        if ok.any():
            lo[d] = t + 1
            yield from walk(points[~low], rows[ok], more[ok], below[ok])
            lo[d] = was
    zero = np.zeros(len(q), small)
    yield from walk(np.arange(len(v)), np.arange(len(q)), zero, zero)


def _replaced(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a != b).sum(1) == 1


def _inserted(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Rows where ``b`` is ``a`` with one letter more: what agrees from both ends covers ``a``."""
    front = np.cumprod(a == b[:, :-1], 1).sum(1)
    back = np.cumprod((a == b[:, 1:])[:, ::-1], 1).sum(1)
    return front + back >= a.shape[1]


def near_pairs(points: np.ndarray, queries: np.ndarray, length: int, shorter: bool, same: bool = False) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (query row, point row) one edit apart. ``points`` have ``length`` letters, ``queries``
    as many or, if ``shorter``, one less; ``same``: both are the same words, each pair once."""
    if not len(points) or not len(queries):
        return
    p, q = letters(points, length), letters(queries, length - shorter)
    true = _inserted if shorter else _replaced
    for at, rows in boxed(vectors(p), vectors(q), 1, 0 if shorter else 1):
        step = max(1, PAIRS_AT_ONCE // len(at))
        for lo in range(0, len(rows), step):
            i, j = np.repeat(rows[lo:lo + step], len(at)), np.tile(at, len(rows[lo:lo + step]))
            if same:
                i, j = i[i < j], j[i < j]
            ok = true(q[i], p[j])
            if ok.any():
                yield i[ok], j[ok]


# ---- the same in Spark

def near_words(words: DataFrame) -> DataFrame:
    """``word``, ``near``, ``near_n``: both directions of every pair one edit apart."""
    spark = words.sparkSession
    sizes = {r["k"]: r["c"] for r in words.groupBy(F.length("word").alias("k")).agg(F.count("*").alias("c")).collect()}
    some = words.select("word").orderBy(F.xxhash64("word")).limit(SAMPLE).collect()
    by_length: dict[int, list[str]] = {}
    for r in some:
        by_length.setdefault(len(r["word"]), []).append(r["word"])
    trees = {k: fit(vectors(letters(by_length[k], k)), n / len(by_length[k])) if k in by_length else [[-1, 0, 0, 0]] for k, n in sizes.items()}
    trees = spark.sparkContext.broadcast(trees)  # at most SAMPLE / SAMPLE_A_LEAF leaves and one a length

    def leaves_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in batches:
            for k, g in df.groupby(df["word"].str.len()):
                v = vectors(letters(g["word"].to_numpy(), k))
                leaf = np.zeros(len(g), int)
                for t, rows in reach(trees.value[k], v, 0, 0):
                    leaf[rows] = t
                yield pd.DataFrame({"word": g["word"].to_numpy(), "n": g["n"].to_numpy(), "tree": k, "leaf": leaf})
    homes = materialize(words.select("word", "n").mapInPandas(leaves_of, "word string, n long, tree int, leaf int"), "spelling-homes")
    full = homes.groupBy("tree", "leaf").agg(F.count("*").alias("c")).where(F.col("c") > 2 * LEAF).collect()
    parts = {(r["tree"], r["leaf"]): -(-r["c"] // LEAF) for r in full}

    def dealt(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def rows(g, tree, leaf, part, kind):
            return pd.DataFrame({"tree": tree, "leaf": leaf, "part": part, "kind": kind, "word": g["word"].to_numpy(), "n": g["n"].to_numpy()})
        for df in batches:
            for k, g in df.groupby("tree"):
                g = g.reset_index(drop=True)
                v, home = vectors(letters(g["word"].to_numpy(), k)), g["leaf"].to_numpy()
                n_parts = np.array([parts.get((k, t), 1) for t in home.tolist()])
                own = np.array([zlib.crc32(w.encode()) for w in g["word"]]) % n_parts
                yield rows(g, k, home, own, 0)
                for p in range(1, int(n_parts.max())):  # a word of a leaf in parts also meets the later parts
                    if (later := np.flatnonzero((own < p) & (p < n_parts))).size:
                        yield rows(g.iloc[later], k, home[later], p, 1)
                for t, at in reach(trees.value[k], v, 1, 1):
                    if (at := at[home[at] < t]).size:
                        for p in range(parts.get((k, t), 1)):
                            yield rows(g.iloc[at], k, t, p, 1)
                if k + 1 in trees.value:
                    for t, at in reach(trees.value[k + 1], v, 1, 0):
                        for p in range(parts.get((k + 1, t), 1)):
                            yield rows(g.iloc[at], k + 1, t, p, 2)

    def paired(g: pd.DataFrame) -> pd.DataFrame:
        k = int(g["tree"].iloc[0])
        w, n, kind = g["word"].to_numpy(), g["n"].to_numpy(), g["kind"].to_numpy()
        home = np.flatnonzero(kind == 0)
        found = [(home[i], home[j]) for i, j in near_pairs(w[home], w[home], k, False, same=True)]
        for value, shorter in ((1, False), (2, True)):
            other = np.flatnonzero(kind == value)
            found += [(other[i], home[j]) for i, j in near_pairs(w[home], w[other], k, shorter)]
        a, b = (np.concatenate([f[x] for f in found]) if found else np.empty(0, int) for x in (0, 1))
        return pd.DataFrame({"word": np.r_[w[a], w[b]], "near": np.r_[w[b], w[a]], "near_n": np.r_[n[b], n[a]]})
    groups = homes.mapInPandas(dealt, "tree int, leaf int, part int, kind int, word string, n long").groupBy("tree", "leaf", "part")
    return groups.applyInPandas(paired, "word string, near string, near_n long")


def variants(words: DataFrame, times: int = TIMES) -> DataFrame:
    """``word``, ``n``, ``n_near``, ``form``, ``form_n`` and ``root`` of counted words: the form is the
    near word of largest count where that is at least ``times`` the word's own, the root is what
    following the forms ends at."""
    pairs = near_words(words)
    best = pairs.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("m"), "near")).alias("b"))
    known = materialize(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        *[F.when(-F.col("b.m") >= times * F.col("n"), x).alias(c) for x, c in ((F.col("b.near"), "form"), (-F.col("b.m"), "form_n"))]), "spelling-forms")
    return known.join(roots(known.where("form is not null").select("word", "form"), times), "word", "left").withColumn("root", F.coalesce("root", "word"))


def roots(links: DataFrame, times: int) -> DataFrame:
    """``word``, ``root`` for every word with a form. Counts grow ``times`` a step, so no chain has
    more steps than a 64-bit count has such factors; every round doubles the steps gone."""
    links, steps, limit = links.select("word", F.col("form").alias("root")), 1, 1 + int(63 / np.log2(times))
    while steps < limit:
        step = links.select(F.col("word").alias("root"), F.col("root").alias("then"))
        gone = materialize(links.join(step, "root", "left").select("word", F.coalesce("then", "root").alias("root"), F.col("then").isNotNull().alias("moved")), "spelling-roots")
        links, steps = gone.select("word", "root"), 2 * steps
        if gone.where("moved").isEmpty():
            break
    return links


def grouped(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", drop_every: int | None = None, min_letters: int = MIN_LETTERS, min_count: int = MIN_COUNT, times: int = TIMES) -> DataFrame:
    """Words of the documents with their near words' number, form and root. ``drop_every`` makes
    misspellings to be found: a run loses a letter where its hash is divisible by this number."""
    words = materialize(word_counts(docs, F.col(doc_id), F.col(text), drop_every, min_letters, min_count), "spelling-words")
    return variants(words, times)
