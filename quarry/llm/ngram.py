"""Interpolated modified Kneser-Ney model of any order from 2: counted in Spark, stored as sorted hash
arrays that workers memory-map, and used to score whole texts.

    p(w | u v) = (c(u v w) - D(c(u v w))) / c(u v .) + g(u v) p(w | v)
    p(w)       = (t(w) - D(t(w))) / t(.) + g / (V + 1)

u is a word, v none or more. c counts n-grams at the highest order; below it, it is the number of
distinct words before the n-gram, or the plain count where that starts with the begin mark, which
nothing stands before. A text starts after one begin mark, so its first words have shorter contexts,
and closes with an end token. t(w) is the number of distinct words before w, D the three discounts
of modified Kneser-Ney from the counts of counts of a level, g what the discounts free, and V the
distinct training tokens; an unknown word has the share of one more word, and a context that was
never seen leaves all to the next lower order.

A first pass counts the words, which are then numbered: a bucket of word hashes writes its sorted
array, and a word's number is its place there after the words of the buckets before. From then on
n-grams are rows of numbers. Counting goes level by level, from the highest order down. A task sorts
and sums its n-grams and sends them by hash of their contexts in packed arrays: each array's words
once, as gaps of sorted numbers, its columns by bytes, compressed. Contexts that are frequent (at most
``HOT`` a level, found by the first pass) are dealt by the last word too, so no context's n-grams meet
in one task, and their sums are added up apart, by Spark. A bucket's task writes its arrays sorted by
hash; the n-grams without their first words go on, summed, to the next level, whose input is written
first and dropped once that level is written in turn. Buckets follow the size of the table.

A sorted array of n-gram hashes keeps the first bits as an index of starts, about 8 to 16 hashes
each, and 32 bits of each hash after those. Sums have a byte a row, for the 255 most frequent rows of
the file; other rows stand apart with their places.

Scoring: a task hashes a slice of its texts, looks its words up once and searches, for each level, its
n-grams and contexts bucket by bucket in the mapped arrays, so a slice walks through each file once.
The driver gets the sizes of the word buckets, counts of counts and the sums of the hot contexts.

Defined cases: a null or blank text is its end token alone; no training texts make every token
unknown with V = 0 (score and base_score 0); discounts without counts of counts are half a count;
repeated rows count as often as they occur; an empty table gives no rows; a file of the model that is
not there any more is an error; other columns are not looked at. Words are compared by 64-bit hashes, n-grams
by bucket, index and 32 bits more: one that the texts do not hold is taken for another at odds of about 4e-9.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import dropped, materialized
from quarry.llm.files import map_array, write_array
from quarry.llm.hashing import mix64, word_hashes

BEGIN = np.uint64(xxhash.xxh64_intdigest(b"begin of text", 1))
FINAL = np.uint64(xxhash.xxh64_intdigest(b""))
HOT = 2000
HOT_SHARE = 5000
SLICE = 1 << 20
PART = 1 << 17
BUCKET_TEXT_BYTES = 32 << 20
MIN_BUCKETS = 24
_P, _Q = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)

#: Arrays that a worker keeps mapped.
OPEN_ARRAYS = 64

_maps: dict = {}


def tokens(text: bytes | None) -> np.ndarray:
    """Word hashes with A-Z in lower case, then the end token."""
    return np.append(word_hashes(text.lower() if text else text), FINAL)


def slices(texts: Iterator[bytes | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Tokens of many texts in one array and the number of each text's tokens, in slices."""
    parts, sizes, n = [], [], 0
    for t in texts:
        h = tokens(t)
        parts.append(h)
        sizes.append(len(h))
        n += len(h)
        if n >= SLICE:
            whole = [(np.concatenate(parts), np.array(sizes))]
            parts, sizes, n = [], [], 0
            yield whole.pop()  # nothing of it is held here
    if parts:
        yield np.concatenate(parts), np.array(sizes)


def padded(second: np.ndarray, sizes: np.ndarray, mark: int) -> tuple[np.ndarray, np.ndarray]:
    """The tokens with a begin mark before each text, and how many places after its mark each is."""
    at = np.cumsum(sizes) - sizes
    depth = np.arange(len(second) + len(sizes), dtype=np.int32)
    depth -= np.repeat((at + np.arange(len(sizes))).astype(np.int32), sizes + 1)
    return np.insert(second, at, mark), depth


def context_hash(words: list[np.ndarray]) -> np.ndarray:
    """Hash of each row of the columns; a longer row's follows from that of its beginning."""
    with np.errstate(over="ignore"):
        h = mix64(words[0] * _P)
    for w in words[1:]:
        h = gram_hash(h, w)
    return h


def gram_hash(context: np.ndarray, last: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix64(context + last * _Q)


def bucket_of(first: np.ndarray, second: np.ndarray, hot: np.ndarray, buckets: int) -> np.ndarray:
    salt = np.where(within(hot, first), mix64(second), np.uint64(0))
    with np.errstate(over="ignore"):
        return (mix64(first * _Q + salt) % np.uint64(buckets)).astype(np.int64)


def in_parts(f, *cols: np.ndarray) -> np.ndarray:
    """``f`` of the columns, taken ``PART`` rows at a time, so that what it makes on the way stays small."""
    return np.concatenate([f(*[c[i:i + PART] for c in cols]) for i in range(0, max(1, len(cols[0])), PART)])


def word_bucket(word: np.ndarray, buckets: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (mix64(word + _P) % np.uint64(buckets)).astype(np.int64)


def within(ordered: np.ndarray, x: np.ndarray) -> np.ndarray:
    return find(ordered, x) >= 0


def find(ordered: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Place of each x in a sorted array, or -1."""
    if not len(ordered):
        return np.full(len(x), -1)
    at = np.minimum(np.searchsorted(ordered, x), len(ordered) - 1)
    return np.where(ordered[at] == x, at, -1)


def runs(*keys: np.ndarray) -> np.ndarray:
    """Starts of runs of equal rows in sorted columns."""
    if not len(keys[0]):
        return np.empty(0, np.int64)
    new = np.zeros(len(keys[0]), bool)
    new[0] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new)


def summed(cols: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct rows of columns of whole numbers, in order, and how often each occurs."""
    bits = [int(c.max()).bit_length() for c in cols]
    if sum(bits) > 63:
        by = np.lexsort(cols[::-1])
        at = runs(*[c[by] for c in cols])
        return [c[by[at]] for c in cols], np.diff(np.append(at, len(by)))
    key = np.zeros(len(cols[0]), np.int64)
    for c, b in zip(cols, bits):
        key <<= b
        key |= c
    key.sort()
    at = runs(key)
    n, key = np.diff(at, append=len(key)), key[at]
    out = []
    for b in bits[::-1]:
        out.append((key & (1 << b) - 1).astype(np.int32 if b < 32 else np.int64))
        key >>= b
    return out[::-1], n


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays of whole numbers from 0, each in as many bytes as its largest needs, all first bytes
    before all second ones, compressed."""
    out = []
    for a in arrays:
        top = int(a.max()) if len(a) else 0
        size = next(s for s in (1, 2, 4, 8) if top < 1 << 8 * s)
        out += [np.array([size, len(a)], np.int64).tobytes(), a.astype(f"<u{size}").view(np.uint8).reshape(len(a), size).T.tobytes()]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(out))


def unpack(raw: bytes) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(raw)
    at, out = 0, []
    while at < len(raw):
        size, n = np.frombuffer(raw, np.int64, 2, at).tolist()
        at += 16
        a = np.frombuffer(raw, np.uint8, n * size, at).reshape(size, n)
        at += n * size
        out.append(np.ascontiguousarray(a.T).view(f"<u{size}").reshape(n))
    return out


def gaps(a: np.ndarray) -> np.ndarray:
    return np.diff(a, prepend=a.dtype.type(0))


def batches_of(batches: Iterator[pa.RecordBatch], order: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Tokens and sizes of the texts in the first column, in larger pieces than for scoring: more is
    summed before it is sent."""
    held, size = [], 0
    for piece in slices(t.as_py() for b in batches for t in b.column(0)):
        held.append(piece)
        size += len(piece[0])
        if size * order >= 8 * SLICE:
            whole = [tuple(map(np.concatenate, zip(*held)))]
            held, size, piece = [], 0, None
            yield whole.pop()  # nothing of it is held here
    if held:
        whole = [tuple(map(np.concatenate, zip(*held)))]
        held = piece = None
        yield whole.pop()


def numbered(tokens_: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct tokens in order, and for each token which one it is."""
    by = np.argsort(tokens_, kind="stable")
    words = tokens_[by]
    start = runs(words)
    of = np.empty(len(by), np.int32)
    of[by] = np.repeat(np.arange(len(start), dtype=np.int32), np.diff(start, append=len(by)))
    return words[start], of


def grams(p: np.ndarray, end: np.ndarray, k: int) -> list[np.ndarray]:
    """The ``k`` words up to each of the places ``end``."""
    return [p[end - (k - 1 - i)] for i in range(k)]


def surveyed(texts: DataFrame, order: int, buckets: int) -> DataFrame:
    """(level, bucket, raw, n): at level 1 the sorted word hashes of each task's texts and their uses, by
    bucket; from level 2 the words of contexts that make up a good part of some piece, with their uses."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tokens_, sizes in batches_of(batches, order):
            words, ids = numbered(tokens_)
            del tokens_
            n = np.bincount(ids)
            bucket = word_bucket(words, buckets)
            by = np.argsort(bucket, kind="stable")
            rows, at = [], runs(bucket[by])
            for x, y in zip(at, np.append(at[1:], len(by))):
                rows.append((1, int(bucket[by[x]]), pack(words[by[x:y]], n[by[x:y]]), None))
            p, depth = padded(ids, sizes, len(words))
            del ids
            words = np.append(words, BEGIN)
            for k in range(2, order + 1):
                cols, n = summed(grams(p, np.flatnonzero(depth >= k - 2), k - 1))
                top = np.flatnonzero(n > max(20, len(p) // HOT_SHARE))
                w = np.column_stack([words[c[top]] for c in cols])
                rows += [(k, None, r.tobytes(), int(x)) for r, x in zip(w, n[top])]
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), (pa.int32(), pa.int32(), pa.binary(), pa.int64()))], ["level", "bucket", "raw", "n"])

    return texts.mapInArrow(run, "level int, bucket int, raw binary, n long")


def frequent(rows: DataFrame, model: dict) -> dict[int, np.ndarray]:
    """For each level the sorted hashes of its most frequent contexts, at most ``HOT``. They only decide
    how n-grams are dealt."""
    rows, hot = rows.where("level > 1").groupBy("level", "raw").agg(F.sum("n").alias("n")), {}
    for k in range(2, model["order"] + 1):
        top = rows.where(F.col("level") == k).orderBy(F.desc("n"), "raw").limit(HOT).collect()
        w = np.frombuffer(b"".join(r["raw"] for r in top), np.uint64)
        hot[k] = np.sort(context_hash(list(known(model, w)[0].reshape(-1, k - 1).T)))
    hot[2] = np.unique(np.append(hot[2], context_hash([np.array([model["distinct"]], np.uint64)])))
    return hot


def dealt(level: int, words: np.ndarray, cols: list[np.ndarray], model: dict) -> list[tuple]:
    """(level, bucket, raw) of the n-grams whose words are ``words`` (ascending numbers) at the columns, summed."""
    if not len(cols[0]):
        return []
    cols, n = summed(cols)
    buckets = model["buckets"]
    small = np.uint16 if buckets <= 1 << 16 else np.int64

    def bucket_at(*part: np.ndarray) -> np.ndarray:
        w = [words[c] for c in part]
        if level == 1:
            return (np.searchsorted(model["base"], w[0], "right") - 1).astype(small)
        return bucket_of(context_hash(w[:-1]), w[-1], model["hot"][level], buckets).astype(small)

    bucket = in_parts(bucket_at, *cols)
    by = np.argsort(bucket, kind="stable")
    bucket, n = bucket[by], n[by]
    for i in range(level):
        cols[i] = cols[i][by]
    del by
    at, out = runs(bucket), []
    for x, y in zip(at, np.append(at[1:], len(bucket))):
        mine = [c[x:y] for c in cols]
        if len(words) < 8 * level * (y - x):
            seen = np.zeros(len(words), bool)
            for c in mine:
                seen[c] = True
            own, place = words[seen], np.cumsum(seen) - 1
            mine = [place[c] for c in mine]
        else:
            own, mine = np.unique(np.concatenate(mine), return_inverse=True)
            own, mine = words[own], np.split(mine, level)
        out.append((level, int(bucket[x]), pack(gaps(own), gaps(mine[0]), *mine[1:], n[x:y])))
    return out


def counted(texts: DataFrame, model: dict) -> DataFrame:
    """(level, bucket, raw): n-grams of each task's texts, summed; at the levels below, those that
    start with the begin mark."""
    order = model["order"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tokens_, sizes in batches_of(batches, order):
            words, ids = numbered(tokens_)
            del tokens_
            words = known(model, words)[0]
            by = np.argsort(words)
            rank = np.empty(len(by), np.int32)
            rank[by] = np.arange(len(by))
            p, depth = padded(rank[ids], sizes, len(words))
            words, rows = np.append(words[by], np.uint64(model["distinct"])), []
            del ids, by, rank
            for k in range(2, order + 1):
                rows += dealt(k, words, grams(p, np.flatnonzero(depth >= k - 1 if k == order else depth == k - 1), k), model)
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), (pa.int32(), pa.int32(), pa.binary()))], ["level", "bucket", "raw"])

    return texts.mapInArrow(run, "level int, bucket int, raw binary")


def joined(raws: list[bytes], level: int) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """Words, columns and counts of several packed rows."""
    parts = [unpack(r) for r in raws]
    words, back = np.unique(np.concatenate([np.cumsum(p[0], dtype=np.uint64) for p in parts]), return_inverse=True)
    back, ends = back.astype(np.uint32), np.cumsum([len(p[0]) for p in parts])
    cols = [np.concatenate([back[e - len(p[0]):e][p[1 + i] if i else np.cumsum(p[1], dtype=np.int64)] for p, e in zip(parts, ends)]) for i in range(level)]
    return words, cols, np.concatenate([p[-1] for p in parts]).astype(np.int64)


def write_keys(path: str, name: str, h: np.ndarray) -> None:
    """Sorted hashes: the number of index bits, the start of each index value, 32 bits of each hash."""
    bits = min(max(1, len(h).bit_length() - 4), 31)
    start = np.searchsorted(h >> np.uint64(64 - bits), np.arange((1 << bits) + 1, dtype=np.uint64))
    rest = h << np.uint64(bits) >> np.uint64(32)
    write_array(path, f"{name}.npy", np.concatenate([[bits], start, rest]).astype(np.uint32))


def key_places(keys: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Place of each hash in an array of ``write_keys``, or -1."""
    bits = int(keys[0])
    start, rest = keys[1:(1 << bits) + 2], keys[(1 << bits) + 2:]
    if not len(rest):
        return np.full(len(x), -1)
    at = (x >> np.uint64(64 - bits)).astype(np.int64)
    low = (x << np.uint64(bits) >> np.uint64(32)).astype(np.uint32)
    lo, end = start[at].astype(np.int64), start[at + 1].astype(np.int64)
    hi = end
    for _ in range(int((hi - lo).max(initial=0)).bit_length()):
        mid = (lo + hi) >> 1
        less = (rest[np.minimum(mid, len(rest) - 1)] < low) & (lo < hi)
        lo, hi = np.where(less, mid + 1, lo), np.where(less, hi, mid)
    return np.where((lo < end) & (rest[np.minimum(lo, len(rest) - 1)] == low), lo, -1)


def write_rows(path: str, name: str, a: np.ndarray) -> None:
    """Rows of up to four columns in a byte each: which of the 255 most frequent rows it is. These stand
    first in a file of their own; other rows follow there with their places."""
    key = np.zeros(len(a), np.int64)
    for c in a.T:
        key = key << 15 | np.minimum(c, (1 << 15) - 1)
    key[(a >= (1 << 15) - 1).any(axis=1)] = -1
    kinds, n = np.unique(key, return_counts=True)
    top = np.sort(kinds[np.argsort(np.where(kinds < 0, 0, -n), kind="stable")[:255]])
    top = top[top >= 0]
    at = find(top, key)
    large, table = np.flatnonzero(at < 0), np.zeros((255, a.shape[1] + 1), np.int64)
    for i in range(a.shape[1]):
        table[:len(top), -1 - i] = top >> 15 * i & (1 << 15) - 1
    write_array(path, f"{name}.npy", np.where(at < 0, 255, at).astype(np.uint8))
    write_array(path, f"{name}-large.npy", np.concatenate([table, np.column_stack([large, a[large]])]))


def counts_of_counts(n: np.ndarray) -> np.ndarray:
    return np.array([(n == k).sum() for k in (1, 2, 3, 4)], np.int64)


def discounts(of: np.ndarray) -> np.ndarray:
    """Modified Kneser-Ney discounts of counts 0, 1, 2 and 3 or more."""
    n1, n2, n3, n4 = (float(x) for x in of)
    if not n1 or not n2:
        return np.array([0.0, 0.5, 0.5, 0.5])
    y = n1 / (n1 + 2 * n2)
    d = [0.0, 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 1.5]
    return np.array([min(max(x, 0.0), float(k)) for k, x in enumerate(d)])


def train(docs: DataFrame, path: str, text_col: str = "text", buckets: int | None = None, order: int = 2) -> dict:
    """Count the texts of ``docs``, write the arrays of the model of this order under ``path`` and return its
    totals: number and distinct number of tokens, counts of counts, and the sums of the hot contexts."""
    if order < 2:
        raise ValueError(f"order {order} is below 2")
    texts = docs.select(F.col(text_col).cast("binary").alias("text"))
    if buckets is None:
        size = docs.select(F.sum(F.octet_length(text_col))).first()[0] or 0
        buckets = max(MIN_BUCKETS, -(-int(size) * (order - 1) // BUCKET_TEXT_BYTES))
    columns = ["level", "bucket", "raw", "context", "a", "b", "c", "d"]
    schema = "level int, bucket int, raw binary, context long, a long, b long, c long, d long"

    def words_of(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        parts = [unpack(r) for r in pdf["raw"]]
        words, back = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
        uses = np.zeros(len(words), np.int64)
        np.add.at(uses, back, np.concatenate([p[1] for p in parts]).astype(np.int64))
        write_array(path, f"word-hash-{key[0]}.npy", words)
        write_rows(path, f"word-uses-{key[0]}", uses[:, None])
        return pd.DataFrame([[int(key[0]), len(words), int(uses.sum())]], columns=["bucket", "n", "uses"])

    rows, at = materialized(surveyed(texts, order, buckets), "ngram-words")
    found = rows.where("level = 1").groupBy("bucket").applyInPandas(words_of, "bucket int, n long, uses long").collect()  # one a bucket
    n = np.zeros(buckets, np.int64)
    n[[r["bucket"] for r in found]] = [r["n"] for r in found]
    model = {"path": path, "buckets": buckets, "order": order, "base": (np.cumsum(n) - n).astype(np.uint64), "distinct": int(n.sum()),
             "tokens": sum(r["uses"] for r in found), "hot": {}, "hot_contexts": {}, "hot_sums": {}, "kinds": {}, "present": {1: frozenset(np.flatnonzero(n).tolist())}}
    model["hot"] = frequent(rows, model)
    dropped(rows, at)
    counting = dict(model)

    def merging(k: int):
        def merge(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
            level, b = int(key[0]), int(key[1])
            if level < k:  # waits for its own level
                return pdf.assign(context=None, a=None, b=None, c=None, d=None)[columns]
            words, cols, n = joined(list(pdf["raw"]), k)
            context = in_parts(lambda *c: context_hash([words[x] for x in c]), *cols[:-1])
            h = in_parts(lambda x, c: gram_hash(x, words[c]), context, cols[-1])
            by = np.argsort(h)
            h = h[by]
            at = runs(h)
            n, one = np.add.reduceat(n[by], at), by[at]
            write_keys(path, f"gram{k}-hash-{b}", h[at])
            del by, h, at
            write_rows(path, f"gram{k}-sums-{b}", n[:, None])
            of = counts_of_counts(n)
            out = [(k, b, None, None, *of.tolist())]
            cols, context = [c[one] for c in cols[1:]], context[one]
            del one
            by = np.argsort(context)
            at = runs(context[by])
            m = n[by]
            sums = np.stack([np.add.reduceat(x, at) for x in (m, *((m == j).astype(np.int64) for j in (1, 2)), (m >= 3).astype(np.int64))], axis=1)
            context = context[by][at]
            is_hot = within(counting["hot"][k], context)
            write_keys(path, f"first{k}-hash-{b}", context[~is_hot])
            write_rows(path, f"first{k}-sums-{b}", sums[~is_hot])
            out += [(k, None, None, int(x), *y) for x, y in zip(context[is_hot].view(np.int64), sums[is_hot].tolist())]
            out += [(*r, None, None, None, None, None) for r in dealt(k - 1, words, cols, counting)]
            return pd.DataFrame(out, columns=columns, dtype=object).astype({x: "Int64" for x in columns if x != "raw"})
        return merge

    def types_of(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        b = int(key[0])
        words, (at,), n = joined(list(pdf["raw"]), 1)
        types = np.zeros(int((*counting["base"], counting["distinct"])[b + 1] - counting["base"][b]), np.int64)
        np.add.at(types, (words[at] - counting["base"][b]).astype(np.int64), n)
        write_rows(path, f"word-types-{b}", types[:, None])
        return pd.DataFrame([[int(x) for x in (types.sum(), (types == 1).sum(), (types == 2).sum(), (types >= 3).sum(), *counts_of_counts(types))]], columns=[f"s{i}" for i in range(8)])

    rows, at = counted(texts, counting), None
    for k in range(order, 1, -1):
        before = (rows, at)
        rows, at = materialized(rows.groupBy("level", "bucket").applyInPandas(merging(k), schema), f"ngram-{k}")
        dropped(*before)
        small = rows.where("raw is null").groupBy("context").agg(*[F.sum(x).alias(x) for x in "abcd"]).collect()
        kinds = [r for r in small if r["context"] is None]
        model["present"][k] = frozenset(r["bucket"] for r in rows.where("raw is null and context is null").select("bucket").collect())  # one a bucket
        small = sorted((r for r in small if r["context"] is not None), key=lambda r: r["context"] % 2**64)
        model["kinds"][k] = np.array(kinds[0][1:] if kinds else [0] * 4, np.int64)
        model["hot_contexts"][k] = np.array([r["context"] for r in small], np.int64).view(np.uint64)
        model["hot_sums"][k] = np.array([r[1:] for r in small], np.int64).reshape(-1, 4)
        rows = rows.where("raw is not null").select("level", "bucket", "raw")
    sums = rows.groupBy("bucket").applyInPandas(types_of, ", ".join(f"s{i} long" for i in range(8)))
    sums = np.array([x or 0 for x in sums.agg(*[F.sum(f"s{i}") for i in range(8)]).first()], np.int64)
    dropped(rows, at)
    return model | {"types": int(sums[0]), "type_kinds": sums[1:4], "word_kinds": sums[4:]}


def _mapped(path: str, name: str) -> np.ndarray:
    """The array, mapped; the ``OPEN_ARRAYS`` used last stay open (a file descriptor each). A file that
    the model lists and that is not there raises."""
    key = (path, name)
    if key in _maps:
        _maps[key] = _maps.pop(key)
    else:
        while len(_maps) >= OPEN_ARRAYS:
            _maps.pop(next(iter(_maps)))
        _maps[key] = map_array(path, name)
    return _maps[key]


def _by_bucket(present: frozenset, bucket: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each bucket that holds something, and the places that ask for it."""
    order = np.argsort(bucket.astype(np.uint16) if bucket.max(initial=0) < 1 << 16 else bucket, kind="stable")
    at = runs(bucket[order])
    for lo, hi in zip(at, np.append(at[1:], len(order))):
        if (b := int(bucket[order[lo]])) in present:
            yield b, order[lo:hi]


def _rows_at(model: dict, name: str, place: np.ndarray) -> np.ndarray:
    """Rows of a file of ``write_rows``."""
    code, large = (_mapped(model["path"], f"{name}{x}.npy") for x in ("", "-large"))
    at = np.asarray(code[place], np.int64)
    wide = at == 255
    at[wide] = 255 + np.searchsorted(large[255:, 0], place[wide])
    return large[at, 1:]


def known(model: dict, words: np.ndarray, *sums: str) -> list[np.ndarray]:
    """Number of each word hash, that of the begin mark after all others and that of an unknown word
    after it; then the named sums of the words, 0 for the last two."""
    number = np.where(words == BEGIN, model["distinct"], model["distinct"] + 1).astype(np.uint64)
    out = [number, *(np.zeros(len(words), np.int64) for _ in sums)]
    for b, of in _by_bucket(model["present"][1], word_bucket(words, model["buckets"])):
        place = find(_mapped(model["path"], f"word-hash-{b}.npy"), words[of])
        of, place = of[place >= 0], place[place >= 0]
        number[of] = model["base"][b] + place.astype(np.uint64)
        for name, to in zip(sums, out[1:]):
            to[of] = _rows_at(model, f"word-{name}-{b}", place)[:, 0]
    return out


def looked_up(model: dict, kind: str, level: int, x: np.ndarray, bucket: np.ndarray, width: int) -> np.ndarray:
    """Rows of the sums for the keys ``x``, zeros where a key is absent."""
    out = np.zeros((len(x), width), np.int64)
    for b, of in _by_bucket(model["present"][level], bucket):
        place = key_places(_mapped(model["path"], f"{kind}{level}-hash-{b}.npy"), x[of])
        hit = place >= 0
        if hit.any():
            out[of[hit]] = _rows_at(model, f"{kind}{level}-sums-{b}", place[hit])
    return out


def token_scores(model: dict, second: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each token: its training count, log10 of the add-half unigram and of the model."""
    buckets, word_d = model["buckets"], discounts(model["word_kinds"])
    word, back = np.unique(second, return_inverse=True)
    number, uses, types = known(model, word, "uses", "types")
    v = model["distinct"]
    base = np.log10((uses + 0.5) / (model["tokens"] + 0.5 * (v + 1)))
    total = max(model["types"], 1)
    free = float(model["type_kinds"] @ word_d[1:]) / total if model["types"] else 1.0
    p = (np.maximum(types - word_d[np.minimum(types, 3)], 0.0) / total + free / (v + 1))[back]
    ids, depth = padded(back, sizes, len(word))
    word = np.append(number, np.uint64(v))
    seq = word[ids]
    place = np.cumsum(depth > 0) - 1
    for k in range(2, model["order"] + 1):
        end = np.flatnonzero(depth >= k - 1)
        d, at = discounts(model["kinds"][k]), place[end]
        context = context_hash([seq[end - k + 1 + i] for i in range(k - 1)])
        ctx, ctx_back = (context_hash([word]), ids[end - 1]) if k == 2 else (context, slice(None))
        sums = looked_up(model, "first", k, ctx, bucket_of(ctx, ctx, np.empty(0, np.uint64), buckets), 4)
        hot = find(model["hot_contexts"][k], ctx)
        sums[hot >= 0] = model["hot_sums"][k][hot[hot >= 0]]
        follow = np.maximum(sums[:, 0], 1)
        gamma = np.where(sums[:, 0] > 0, sums[:, 1:] @ d[1:] / follow, 1.0)
        n = looked_up(model, "gram", k, gram_hash(context, seq[end]), bucket_of(context, seq[end], model["hot"][k], buckets), 1)[:, 0]
        p[at] = np.maximum(n - d[np.minimum(n, 3)], 0.0) / follow[ctx_back] + gamma[ctx_back] * p[at]
    return uses[back], base[back], np.log10(p)


def score(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, n_known, base_score, score) for each row of ``docs``."""
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"))
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            done, cols = 0, [np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0), np.empty(0)]
            for second, sizes in slices(t.as_py() for t in b.column(1)):
                uses, base, own = token_scores(model, second, sizes)
                at = np.cumsum(sizes) - sizes
                new = [sizes, np.add.reduceat((uses > 0).astype(np.int64), at), np.add.reduceat(base, at), np.add.reduceat(own, at)]
                cols = [np.concatenate(x) for x in zip(cols, new)]
                done += len(sizes)
            yield pa.RecordBatch.from_arrays([b.column(0), *map(pa.array, cols)], ["id", "n_tokens", "n_known", "base_score", "score"])

    return src.mapInArrow(run, f"id {id_type}, n_tokens long, n_known long, base_score double, score double").withColumnRenamed("id", id_col)


def held_out(doc_id: Column) -> Column:
    """Whether the crc32 of the id as text leaves 1 by 5; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 1


def perplexity(scored: DataFrame) -> DataFrame:
    """``scored`` with the perplexity of each text under the model."""
    return scored.withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))


