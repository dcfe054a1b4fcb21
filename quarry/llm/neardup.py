"""Near-duplicate classes by ProbMinHash over 5-word shingles weighted by their counts.

Signature (ProbMinHash): every distinct shingle of a text is a Poisson process whose rate is its
count; the process is seeded by the shingle's hash, each arrival falls on one of ``REGISTERS``
registers, and a register keeps the shingle that arrives first. A shingle stops as soon as its next
arrival is later than the latest register, so long texts draw about one arrival a shingle. Two texts
agree in a register with the probability Jaccard similarity of their weighted shingles.

Banding: registers in 24 bands of 4. Texts at similarity 0.8 share no band with odds of 3e-6.
Equal texts are one vertex from the start. Within a band's bucket the smallest member is compared
with all others by the exact similarity of the whole shingle lists, and classes are joined, so a
large group of copies costs about one comparison a member. Buckets that still hold several classes
are finished exactly: their lists meet in blocks of at most ``BLOCK`` texts, two blocks a task. The
parts P and Q of the weights of two texts that lie in common shingles come from one matrix product,
bound the similarity by 1 / (1/P + 1/Q - 1), and pairs of different classes that pass the bound are
compared. A task returns the links that join classes, never its pairs.

Classes are connected components by smallest label with pointer jumping, over Spark joins.

Scale: texts are read twice (signatures; shingle lists of texts that share a bucket). A row a band
and text is shuffled (24 longs), and hot buckets are only min-aggregated and joined. A bucket
of n texts makes (n / ``BLOCK``) squared tasks' worth of products and no row for a pair.

Defined cases: null and blank texts are alone in their class; texts of one to four words have one
shingle, all their words; texts with equal words are one class whatever their spacing; rows that
share an id belong to one class; a row without an id takes no part (class_id null) and is kept; an
empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from fractions import Fraction
from itertools import groupby

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import fresh, materialize
from quarry.llm.hashing import mix64, sequence_hashes, word_hashes

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 24, 4
REGISTERS = BANDS * ROWS
BLOCK = 256
COLUMNS = 4096
NEAR = 1e-9
_STEP = np.uint64(0x9E3779B97F4A7C15)


def shingles(text: bytes | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes, sorted, and their counts."""
    w = word_hashes(text)
    if not len(w):
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    return np.unique(sequence_hashes(w, min(SHINGLE, len(w))), return_counts=True)


def signature(h: np.ndarray, weight: np.ndarray, registers: int = REGISTERS) -> np.ndarray:
    """The shingle that arrives first at each register. Arrivals are drawn up to a time by which all
    registers have one nearly always; where one has none, without that limit."""
    for limit in (registers * (np.log(registers) + 4) / float(weight.sum()), np.inf):
        first, who = _arrivals(h, weight, registers, limit)
        if first.max() <= limit:
            break
    return who


def _arrivals(h: np.ndarray, weight: np.ndarray, registers: int, limit: float) -> tuple[np.ndarray, np.ndarray]:
    first, who = np.full(registers, np.inf), np.zeros(registers, np.uint64)
    state, rate, t = h, weight.astype(np.float64), np.zeros(len(h))
    with np.errstate(over="ignore"):
        while len(state):
            state = state + _STEP
            draw = mix64(state)
            t = t - np.log(((draw >> np.uint64(11)).astype(np.float64) + 1.0) * 2.0**-53) / rate
            live = np.flatnonzero(t <= min(limit, first.max()))
            state, rate, t, draw, h = state[live], rate[live], t[live], draw[live], h[live]
            reg = (mix64(draw ^ _STEP) % np.uint64(registers)).astype(np.int64)
            sooner = np.flatnonzero((t < first[reg]) | ((t == first[reg]) & (h < who[reg])))
            sooner = sooner[np.lexsort((~h[sooner], -t[sooner]))]  # the soonest is written last
            first[reg[sooner]], who[reg[sooner]] = t[sooner], h[sooner]
    return first, who


def band_keys(sig: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        key = np.arange(1, BANDS + 1, dtype=np.uint64) * _STEP
        for r in range(ROWS):
            key = mix64(key * _STEP + sig[r::ROWS])
    return key.view(np.int64)


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Probability Jaccard of two weighted sets, each as sorted keys and counts: the sum over
    common keys i of 1 / sum over all keys j of max(a_j / a_i, b_j / b_i)."""
    (ka, wa), (kb, wb) = a, b
    common, ia, ib = np.intersect1d(ka, kb, assume_unique=True, return_indices=True)
    if not len(common):
        return 0.0
    x, y = wa[ia].astype(np.float64), wb[ib].astype(np.float64)
    only_a, only_b = float(wa.sum()) - x.sum(), float(wb.sum()) - y.sum()
    ratio = y / x
    order = np.argsort(ratio, kind="stable")
    r, x, y = ratio[order], x[order], y[order]
    upto_x, from_y = np.cumsum(x), np.cumsum(y[::-1])[::-1]
    # keys whose ratio is at most r_i count by a, the others by b
    at = np.searchsorted(r, r, side="right")
    above = np.append(from_y, 0.0)[at]
    total = (upto_x[at - 1] + only_a) / x + (above + only_b) / y
    return float((1.0 / total).sum())


def exact_similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> Fraction:
    """``similarity`` as a fraction; common keys with the same counts are one term."""
    (ka, wa), (kb, wb) = a, b
    _, ia, ib = np.intersect1d(ka, kb, assume_unique=True, return_indices=True)
    x, y = wa[ia].astype(np.int64), wb[ib].astype(np.int64)
    left, above = int(wa.sum()) - int(x.sum()), int(wb.sum())  # by a: only there or of a ratio up to this one; by b: the others
    kinds, many = np.unique(np.stack([x, y]), axis=1, return_counts=True)
    terms = sorted((Fraction(q, p), p, q, m) for p, q, m in zip(*kinds.tolist(), many.tolist()))
    total = Fraction(0)
    for _, same in groupby(terms, key=lambda t: t[0]):
        same = list(same)
        left, above = left + sum(p * m for _, p, _, m in same), above - sum(q * m for _, _, q, m in same)
        total += sum(m / (Fraction(left, p) + Fraction(above, q)) for _, p, q, m in same)
    return total


def reaches(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], threshold: float) -> bool:
    """Whether the similarity is the threshold (the decimal number as written) or more: sums in
    floating point decide but for those within ``NEAR`` of it, which are taken as fractions."""
    s = similarity(a, b)
    return s >= threshold if abs(s - threshold) > NEAR else exact_similarity(a, b) >= Fraction(repr(float(threshold)))


def signed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, digest, bands) of the texts that have words."""
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("text")).where("id is not null")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, digests, bands = [], [], []
            for i, text in zip(b.column(0).to_pylist(), b.column(1)):
                h, n = shingles(text.as_py())
                if len(h):
                    ids.append(i)
                    digests.append(hashlib.md5(b" ".join(text.as_py().split())).hexdigest())
                    bands.append(band_keys(signature(h, n)))
            flat = np.concatenate(bands) if bands else np.empty(0, np.int64)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(bands) + 1, dtype=np.int32) * BANDS), pa.array(flat))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(digests, pa.string()), lists], ["id", "digest", "bands"])

    return src.mapInArrow(run, "id long, digest string, bands array<long>")


def shingled(docs: DataFrame, ids: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(v, keys, counts): shingle lists of the documents whose id is in ``ids`` (v), as bytes."""
    src = docs.select(F.col(id_col).cast("long").alias("v"), F.col(text_col).cast("binary").alias("text")).join(ids, "v", "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, counts = [], []
            for text in b.column(1):
                h, n = shingles(text.as_py())
                keys.append(h.tobytes())
                counts.append(b"" if (n == 1).all() else n.astype(np.uint32).tobytes())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(keys, pa.binary()), pa.array(counts, pa.binary())], ["v", "keys", "counts"])

    return src.mapInArrow(run, "v long, keys binary, counts binary").dropDuplicates(["v"])


def _weighted(keys: bytes, counts: bytes) -> tuple[np.ndarray, np.ndarray]:
    k = np.frombuffer(keys, np.uint64)
    return k, np.frombuffer(counts, np.uint32) if counts else np.ones(len(k), np.uint32)


def verified(pairs: DataFrame, lists: DataFrame, threshold: float) -> DataFrame:
    """(a, b) with the exact similarity at or above the threshold."""
    one = lists.select(F.col("v").alias("a"), F.col("keys").alias("ka"), F.col("counts").alias("ca"))
    two = lists.select(F.col("v").alias("b"), F.col("keys").alias("kb"), F.col("counts").alias("cb"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in batches:
            c = t.to_pydict()
            ok = [reaches(_weighted(x, p), _weighted(y, q), threshold) for x, p, y, q in zip(c["ka"], c["ca"], c["kb"], c["cb"])]
            yield pa.RecordBatch.from_arrays([t.column(t.schema.get_field_index(n)).filter(pa.array(ok, pa.bool_())) for n in ("a", "b")], ["a", "b"])

    # the member's list first: its side is as even as the texts are; the pivot's side is joined last
    return pairs.join(two, "b").join(one, "a").select("a", "b", "ka", "ca", "kb", "cb").mapInArrow(run, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """(v, c): for each vertex of the edges (a, b) the smallest vertex connected with it."""
    both = materialize(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "dup-edges")
    label = materialize(both.groupBy(F.col("a").alias("v")).agg(F.min("b").alias("m")).select("v", F.least("v", "m").alias("c")), "dup-label")
    while True:
        near = both.join(label, F.col("b") == F.col("v")).groupBy("a").agg(F.min("c").alias("m"))
        hooked = label.join(near, F.col("v") == F.col("a")).select("v", "c", F.least("c", "m").alias("n"))
        up = label.select(F.col("v").alias("n"), F.col("c").alias("nc"))
        step = materialize(hooked.join(up, "n").select("v", "c", F.least("n", "nc").alias("n")), "dup-label")
        label = step.select("v", F.col("n").alias("c"))
        if step.where("n < c").isEmpty():
            return label


def joining(lists: list[tuple[np.ndarray, np.ndarray]], group: list[int], threshold: float) -> list[tuple[int, int]]:
    """Pairs of places in ``lists`` at or above the threshold that connect the groups as far as any
    such pairs do: each returned pair joins two groups that were apart until then."""
    of, who = np.unique(np.concatenate([k for k, _ in lists]), return_inverse=True)
    row = np.repeat(np.arange(len(lists)), [len(k) for k, _ in lists])
    part = np.concatenate([w / w.sum() for _, w in lists])
    shared = np.bincount(who, minlength=len(of)) > 1
    column = np.cumsum(shared) - 1
    keep = shared[who]
    row, col, part = row[keep], column[who[keep]], part[keep]
    order = np.argsort(col, kind="stable")
    row, col, part = row[order], col[order], part[order]
    common = np.zeros((len(lists), len(lists)))
    for lo in range(0, int(shared.sum()), COLUMNS):
        x, y = np.searchsorted(col, [lo, lo + COLUMNS])
        weight, there = (np.zeros((len(lists), COLUMNS), np.float32) for _ in range(2))
        weight[row[x:y], col[x:y] - lo], there[row[x:y], col[x:y] - lo] = part[x:y], 1
        common += weight @ there.T
    with np.errstate(divide="ignore"):
        bound = 1 / (1 / common + 1 / common.T - 1)
    names = np.array(group)
    a, b = np.nonzero(np.triu((bound >= threshold - 1e-4) & (names[:, None] != names), 1))
    parent = {g: g for g in group}

    def root(g: int) -> int:
        while parent[g] != g:
            parent[g] = g = parent[parent[g]]
        return g

    out = []
    for i, j in zip(a.tolist(), b.tolist()):
        p, q = root(group[i]), root(group[j])
        if p != q and reaches(lists[i], lists[j], threshold):
            parent[q] = p
            out.append((i, j))
    return out


def finished(members: DataFrame, lists: DataFrame, threshold: float) -> DataFrame:
    """(a, b): links that join the classes of every bucket of (key, v, c) wherever texts of it do."""
    blocks = members.groupBy("key").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("nb"))
    mine = F.pmod(F.xxhash64("v"), F.col("nb")).cast("int")
    dealt = members.join(blocks, "key").withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
    dealt = dealt.select("key", F.least("mine", "other").alias("x"), F.greatest("mine", "other").alias("y"), "v", "c")

    def link(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("v")
        if pdf["c"].nunique() < 2:
            return pd.DataFrame({"a": [], "b": []}, dtype=np.int64)
        v = pdf["v"].tolist()
        got = joining([_weighted(k, w) for k, w in zip(pdf["keys"], pdf["counts"])], pdf["c"].tolist(), threshold)
        return pd.DataFrame({"a": [v[i] for i, _ in got], "b": [v[j] for _, j in got]}, dtype=np.int64)

    return dealt.join(lists, "v").groupBy("key", "x", "y").applyInPandas(link, "a long, b long").distinct()


def still_open(members: DataFrame, label: DataFrame) -> DataFrame:
    """(key, v, c): members of the buckets that hold several classes."""
    named = members.select("key", "v").join(label, "v", "left").select("key", "v", F.coalesce("c", "v").alias("c"))
    several = named.groupBy("key").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo < hi").select("key")
    return named.join(several, "key")


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(id, class_id) of every distinct id with words: class_id is the smallest id of the class."""
    sig = materialize(signed(docs, id_col, text_col), "dup-signatures")
    texts = materialize(sig.groupBy("digest").agg(F.min("id").alias("v"), F.min("bands").alias("bands")), "dup-texts")
    shared = sig.groupBy("id").agg(F.min("digest").alias("lo"), F.max("digest").alias("hi")).where("lo <> hi")  # ids with several texts
    linked = sig.join(shared, "id").join(texts, "digest").select(F.least("id", "v").alias("a"), F.greatest("id", "v").alias("b")).where("a <> b")
    rows = texts.select("v", F.explode("bands").alias("key"))
    pivots = rows.groupBy("key").agg(F.min("v").alias("a"), F.max("v").alias("z")).where("a < z").select("key", "a")
    members = materialize(rows.join(pivots, "key"), "dup-members")
    lists = materialize(shingled(docs, members.select("v").distinct(), id_col, text_col), "dup-lists")
    edges = materialize(linked.union(verified(members.where("v <> a").select("a", F.col("v").alias("b")).distinct(), lists, threshold)), "dup-links")
    label = components(edges)
    more = materialize(finished(still_open(members, label), lists, threshold), "dup-links")
    if not more.isEmpty():
        label = components(edges.union(more))
    ids = sig.select("id", "digest").distinct().join(texts.select("digest", "v"), "digest").groupBy("id").agg(F.min("v").alias("v"))
    return ids.join(label, "v", "left").select("id", F.coalesce("c", "v").alias("class_id"))


def clustered(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row a row of ``docs``: its id and class_id."""
    found = classes(docs, id_col, text_col, threshold)
    ids = docs.select(F.col(id_col).cast("long").alias("id"))
    return ids.join(found, "id", "left").select(F.col("id").alias(id_col), F.coalesce("class_id", "id").alias("class_id"))


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with one document of each class, the one with the smallest id; of rows that share
    an id one stays. Rows without an id or without words stay."""
    found = materialize(classes(docs, id_col, text_col, threshold), "dup-classes")
    i, gone, many = fresh(docs, "_id", "_gone", "_many")
    twice = docs.groupBy(F.col(id_col).cast("long").alias(i)).agg(F.count("*").alias(many)).where(F.col(many) > 1)
    verdict = found.select(F.col("id").alias(i), (F.col("id") != F.col("class_id")).alias(gone)).join(twice, i, "left")
    kept = docs.join(verdict, F.col(id_col).cast("long") == F.col(i), "left").where(~F.coalesce(F.col(gone), F.lit(False)))
    names = [f"`{c}`" for c in docs.columns]
    single = kept.where(F.col(many).isNull()).select(*names)
    repeated = verdict.where(F.col(many).isNotNull())
    if repeated.isEmpty():
        return single
    return single.unionByName(kept.where(F.col(many).isNotNull()).select(*names).dropDuplicates([id_col]))
