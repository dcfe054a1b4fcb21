"""Packing, near-duplicates, token files, top-k, URL lists and n-gram scores against brute force."""

import heapq
import math
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction
from itertools import combinations

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quarry.llm import hashing, neardup, ngram, packing, tokenfile, topk, urls
from tests.conftest import SF_SMALL
from tests.llm.fixtures import awkward, prose

W = re.compile(r"[^\x20\x09-\x0D]+")
TOKENS = public_tokenizers.path("byte_bpe_50k.json")


# ---- packing

def naive_pack(items, capacity):
    """Best fit by looking at every bin."""
    bins = []
    for n, s, c in items:
        fits = [(left, i) for i, (left, ss, cc) in enumerate(bins) if left >= n and s not in ss and (c is None or c not in cc)]
        if fits:
            i = min(fits)[1]
        else:
            bins.append((capacity, set(), set()))
            i = len(bins) - 1
        left, ss, cc = bins[i]
        bins[i] = (left - n, ss | {s}, cc | {c})
        yield i


def test_pack_group_is_best_fit():
    r = np.random.default_rng(3)
    items = sorted(((int(n), int(s), None if c < 2 else int(c)) for n, s, c in zip(r.integers(1, 99, 300), r.integers(0, 12, 300), r.integers(0, 40, 300))), key=lambda x: -x[0])
    got = [b for _, b, *_ in packing.pack_group(*map(list, zip(*items)), capacity=100)]
    assert got == list(naive_pack(items, 100))


def test_pack_keeps_every_word_and_no_conflict(spark):
    df = awkward(spark)
    out = packing.pack(df, capacity=50, group_rows=5, with_text=True).collect()
    bins = defaultdict(list)
    for r in out:
        if r["bin"] is not None:
            bins[r["bin"]].append(r)
        else:
            assert r["n_words"] == 0
    for b in bins.values():
        assert sum(r["n_words"] for r in b) <= 50 and sorted(r["slot"] for r in b) == list(range(len(b)))
        assert len({r["source"] for r in b}) == len(b)
    assert Counter(w for r in out for w in r["text"].split(" ") if w) == Counter(w for r in df.collect() for w in W.findall(r["text"] or ""))
    for r in out:
        assert len([w for w in r["text"].split(" ") if w]) == r["n_words"]
    assert packing.pack(df.limit(0)).count() == 0


def test_clusters_do_not_share_a_bin(spark):
    df = spark.createDataFrame([(i, prose(i % 3, 10), f"s{i}") for i in range(30)], "doc_id long, text string, source string")
    out = packing.pack(df, capacity=1000, group_rows=1000).collect()
    per = defaultdict(list)
    for r in out:
        per[r["bin"]].append(r["doc_id"] % 3)
    assert len(per) == 10 and all(len(set(v)) == len(v) for v in per.values())


# ---- near-duplicates

def shingle_counts(text):
    w = (text or "").encode().split()
    return Counter(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()


def slow_similarity(a, b):
    keys = set(a) | set(b)
    return sum(1 / sum(max(a[j] / a[i], b[j] / b[i]) for j in keys) for i in set(a) & set(b))


def test_similarity_by_definition():
    r = np.random.default_rng(5)
    for _ in range(40):
        a, b = ({int(k): int(c) for k, c in zip(r.choice(30, 12, False), r.integers(1, 6, 12))} for _ in range(2))
        as_lists = lambda x: (np.array(sorted(x), np.uint64), np.array([x[k] for k in sorted(x)]))
        assert abs(neardup.similarity(as_lists(a), as_lists(b)) - slow_similarity(Counter(a), Counter(b))) < 1e-12


def test_signature_estimates_similarity():
    r = np.random.default_rng(7)
    a = {int(k): int(c) for k, c in zip(range(400), r.integers(1, 5, 400))}
    b = {int(k): int(c) for k, c in zip(range(80, 480), [a.get(k, 2) for k in range(80, 480)])}
    lists = [(hashing.mix64(np.array(list(x), np.uint64)), np.array(list(x.values()))) for x in (a, b)]
    sig = [neardup.signature(*x, registers=4096) for x in lists]
    assert abs((sig[0] == sig[1]).mean() - slow_similarity(Counter(a), Counter(b))) < 0.04


def brute_classes(docs):
    sh = {d: shingle_counts(t) for d, t in docs}
    parent = {d: d for d in sh}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    by = defaultdict(set)
    for d, c in sh.items():
        for k in c:
            by[k].add(d)
    as_lists = lambda c: (np.array(sorted(abs(hash(k)) for k in c), np.uint64), np.array([n for _, n in sorted((abs(hash(k)), n) for k, n in c.items())]))
    arrays = {d: as_lists(c) for d, c in sh.items()}
    for x, y in {p for s in by.values() for p in combinations(sorted(s), 2)}:
        if neardup.similarity(arrays[x], arrays[y]) >= 0.8:
            a, b = sorted((root(x), root(y)))
            parent[b] = a
    return {d: root(d) for d in sh}


def test_classes_against_all_pairs(spark):
    df = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    got = {r["doc_id"]: r["class_id"] for r in neardup.clustered(df).collect()}
    assert got == brute_classes([(r["doc_id"], r["text"]) for r in df.collect()])
    assert len(set(got.values())) < len(got)


def test_classes_of_a_chain_and_a_large_group(spark):
    """A chain of drifting copies is one class though its ends differ; so is a hot group."""
    base = prose(50, 300).split()
    chain = []
    for i in range(12):
        base = base[:i * 20] + [f"new{i}"] + base[i * 20 + 1:]
        chain.append((100 + i, " ".join(base)))
    other = prose(51, 200).split()
    group = [(1000 + i, " ".join(other[:i % 190] + [f"v{i}"] + other[i % 190 + 1:])) for i in range(150)]
    docs = chain + group + [(i, prose(60 + i, 80)) for i in range(20)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r["doc_id"]: r["class_id"] for r in neardup.clustered(df).collect()}
    assert got == brute_classes(docs)
    assert len({got[d] for d, _ in chain}) == 1 and len({got[d] for d, _ in group}) == 1


def fraction_similarity(a, b):
    keys = set(a) | set(b)
    return sum(1 / sum(max(Fraction(a[j], a[i]), Fraction(b[j], b[i])) for j in keys) for i in set(a) & set(b))


def test_threshold_is_exact():
    """Pairs at 0.8 by construction reach it, those one shingle below do not, whatever the counts."""
    as_lists = lambda c: (np.array(sorted(c), np.uint64), np.array([c[k] for k in sorted(c)], np.uint32))
    for k in range(1, 401):
        a, b = Counter(range(5 * k)), Counter(range(4 * k))
        assert neardup.reaches(as_lists(a), as_lists(b), 0.8)
        assert not neardup.reaches(as_lists(a), as_lists(Counter(range(4 * k - 1))), 0.8)
    r = np.random.default_rng(9)
    for _ in range(60):
        a, b = (Counter({int(i): int(c) for i, c in zip(r.choice(14, 11, False), r.integers(1, 4, 11))}) for _ in range(2))
        want = fraction_similarity(a, b)
        assert neardup.exact_similarity(as_lists(a), as_lists(b)) == want
        assert neardup.reaches(as_lists(a), as_lists(b), 0.5) == (want >= Fraction(1, 2))


def test_pair_at_the_threshold_is_one_class(spark):
    """80 of 100 shingles in common: a text of 104 words and its first 84 words."""
    w = prose(90, 104).split()
    docs = [(1, " ".join(w)), (2, " ".join(w[:84])), (3, " ".join(w[:83]))]
    sh = {d: shingle_counts(t) for d, t in docs}
    assert fraction_similarity(sh[1], sh[2]) == Fraction(4, 5) and fraction_similarity(sh[1], sh[3]) < Fraction(4, 5)
    for pair in (docs[:2], docs[::2]):
        df = spark.createDataFrame(pair, "doc_id long, text string")
        assert len({r["class_id"] for r in neardup.clustered(df).collect()}) == (1 if pair[1][0] == 2 else 2)


def test_near_duplicates_awkward_rows(spark):
    df = awkward(spark)
    got = neardup.clustered(df)
    assert got.count() == df.count() and got.columns == ["doc_id", "class_id"]
    by = {r["doc_id"]: r["class_id"] for r in got.collect()}
    assert by[2] == 1 and by[9] == 8 and by[14] == 13 and by[3] == 3 and by[4] == 4 and by[5] == 5 and by[None] is None
    kept = neardup.deduplicate(df)
    assert kept.columns == df.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=lambda x: (x is None, x)) == sorted([-15, 1, 3, 4, 5, 6, 7, 8, 10, 11, 12, 13]) + [None]
    twice = neardup.deduplicate(df.unionByName(df)).where("doc_id in (1, 7)")
    assert twice.count() == 2
    assert neardup.deduplicate(df.limit(0)).count() == 0


# ---- token files

def huffman_cost(counts):
    heap = [c for c in counts if c]
    heapq.heapify(heap)
    cost = 0
    while len(heap) > 1:
        x = heapq.heappop(heap) + heapq.heappop(heap)
        cost += x
        heapq.heappush(heap, x)
    return cost


def test_code_lengths_are_optimal_and_limited():
    r = np.random.default_rng(1)
    counts = r.integers(0, 1000, 300)
    n = tokenfile.code_lengths(counts, 16).astype(int)
    assert (n[counts == 0] == 0).all() and int((n * counts).sum()) == huffman_cost(counts.tolist())
    assert sum(2.0 ** -k for k in n if k) == 1.0
    fib = [1, 1]
    while len(fib) < 30:
        fib.append(fib[-1] + fib[-2])
    short = tokenfile.code_lengths(np.array(fib), 8).astype(int)
    assert short.max() == 8 and sum(2.0 ** -k for k in short) <= 1.0
    assert tokenfile.code_lengths(np.array([0, 5])).tolist() == [0, 1] and tokenfile.code_lengths(np.zeros(3, int)).tolist() == [0, 0, 0]


def test_limited_lengths_against_all_choices():
    counts, best = np.array([1, 1, 2, 3, 5, 9, 40]), math.inf
    def tries(k, left):  # noqa: E306
        if k == 0:
            yield ()
            return
        for n in range(1, 5):
            if 2 ** (4 - n) <= left:
                for rest in tries(k - 1, left - 2 ** (4 - n)):
                    yield (n, *rest)
    for t in tries(len(counts), 16):
        best = min(best, int((np.array(t) * counts).sum()))
    assert int((tokenfile.code_lengths(counts, 4) * counts).sum()) == best


def test_bits_round_trip():
    r = np.random.default_rng(2)
    ids = (r.exponential(40, 20000) ** 1.4).astype(np.int64)
    n = tokenfile.code_lengths(np.bincount(ids))
    starts = np.sort(r.choice(20000, 50, False))
    starts[0] = 0
    data, offsets, pos = tokenfile.pack_bits(ids, starts, n, tokenfile.canonical(n))
    counts = np.diff(np.r_[starts, 20000])
    assert (tokenfile.unpack_bits(data, offsets[:-1] * 8, counts, n) == ids).all()
    assert (pos[starts] == offsets[:-1] * 8).all()


def test_pieces_encode_as_whole_texts(spark):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(TOKENS)
    texts = ["", " ", "a", "a b", " a b ", "a  b", "a \n b", "it's 12 o'clock, isn't it?", "x y z w", "don't<|endoftext|> do it", "a\tb c\r\nd e", "é ü 漢字 😀 ok", "a \x1c b",
             *(r["text"] for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("text").collect())]
    texts += ["up!! c$$$ x#*% q;, a. b.. c! a, a", "ǅ. ɐ, é. ñ, ß; ×. x² ½. 日本. á. b́", "don't. it's, a,b c,d. _a, 1. 2,"]
    for t, got in zip(texts, tokenfile.encode_texts(TOKENS, pa.array(texts))):
        assert got.tolist() == tok.encode(t, add_special_tokens=False).ids


@pytest.mark.parametrize("file_bytes", [1 << 30, 20000])
def test_token_files_round_trip(spark, tmp_path, file_bytes):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(TOKENS)
    df = awkward(spark)
    totals = tokenfile.write(df, str(tmp_path / f"t{file_bytes}"), TOKENS, file_text_bytes=file_bytes)
    got = [(r["doc_id"], r["start"], r["n_tokens"], zlib.crc32(bytes(r["ids"]))) for r in tokenfile.read(totals, str(tmp_path / f"t{file_bytes}")).collect()]
    want = []
    for r in df.collect():
        ids = np.array(tok.encode(r["text"] or "", add_special_tokens=False).ids + [2], "<u4")
        want.append((r["doc_id"], len(ids), zlib.crc32(ids.tobytes())))
    assert Counter((a, c, d) for a, _, c, d in got) == Counter(want)
    got.sort(key=lambda x: x[1])
    assert [g[1] for g in got] == np.cumsum([0, *(g[2] for g in got)])[:-1].tolist()
    ids = [g[0] for g in got]
    assert ids == sorted((i for i in ids if i is not None)) + [None]


def test_token_files_of_an_empty_table(spark, tmp_path):
    totals = tokenfile.write(awkward(spark).limit(0), str(tmp_path / "e"), TOKENS)
    assert tokenfile.read(totals, str(tmp_path / "e")).count() == 0


# ---- top-k

def brute_topk(q, p, k):
    fit = lambda v: v is not None and all(x is not None and math.isfinite(x) for x in v)
    ints = lambda v: [math.floor(256 * float(x)) for x in v]
    pts = [(i, ints(v)) for i, v in p if fit(v)]
    out = []
    for i, v in q:
        if fit(v):
            s = sorted((-sum(a * b for a, b in zip(ints(v), w)), j) for j, w in pts if j != i)[:k]
            out += [(i, r + 1, j, -x) for r, (x, j) in enumerate(s)]
    return sorted(out)


@pytest.mark.parametrize("spread,positive", [(0.0, False), (2.0, False), (2.0, True), (0.5, True)])
def test_topk_against_brute_force(spark, spread, positive):
    r = np.random.default_rng(11)
    p = r.normal(size=(700, 12)) * np.exp(r.normal(size=(700, 1)) * spread)
    p = np.abs(p) if positive else p
    p[r.choice(700, 60)] = p[5]  # ties
    if positive:
        p[:, 3] *= 6  # one leading coordinate, so that the coordinate test prunes
    data = [(i, [float(x) for x in v]) for i, v in enumerate(p)]
    data += [(700, None), (750, [1.0, None] * 6), (800, [float("nan")] * 12), (850, [float("inf")] * 12), (900, []), (950, [0.0] * 12), (1000, [1.0, 2.0])]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    q = df.where("vec_id % 50 = 0")
    got = sorted(tuple(x) for x in topk.search(q, df, buckets=8, block_rows=64, query_rows=4).collect())
    assert got == brute_topk([d for d in data if d[0] % 50 == 0], data, 5)


def test_topk_few_rows_and_large_values(spark):
    df = spark.createDataFrame([(0, [1e6, -3e6]), (1, [2.5e6, 1e6]), (50, [-1e6, 1.0])], "vec_id long, embedding array<double>").withColumn("id", F.lit("x")).withColumn("score", F.lit(1))
    got = sorted(tuple(x) for x in topk.search(df.where("vec_id % 50 = 0"), df).collect())
    assert got == brute_topk([(0, [1e6, -3e6]), (50, [-1e6, 1.0])], [(0, [1e6, -3e6]), (1, [2.5e6, 1e6]), (50, [-1e6, 1.0])], 5)
    assert topk.search(df.limit(0), df.limit(0)).count() == 0


# ---- URL lists

def test_url_list_as_of(spark):
    e = spark.createDataFrame([
        ("bad.com", "spam", "2024-01-10", "add"), ("bad.com", "spam", "2024-03-01", "remove"), ("bad.com", "spam", "2024-06-01", "add"),
        ("x.org/ads", "ads", "2024-01-01", "add"), ("tie.net", "t", "2024-01-01", "add"), ("tie.net", "t", "2024-01-01", "remove"),
        ("bad.com", "spam", "2024-01-10", "add"), (None, "n", "2024-01-01", "add"), ("bad.com", "more", "2024-02-01", "add")], "entry string, category string, at string, action string").withColumn("at", F.to_date("at"))
    c = spark.createDataFrame([
        (1, "https://www.BAD.com/a", "2024-01-09"), (2, "https://www.bad.com./a?q=1", "2024-01-10"), (3, "http://u@bad.com:80", "2024-02-15"), (4, "http://bad.com", "2024-03-01"),
        (5, "http://notbad.com", "2024-02-15"), (6, "http://x.org/ads/1", "2024-02-01"), (7, "http://x.org/adsense", "2024-02-01"), (8, "http://tie.net", "2024-02-01"),
        (9, None, "2024-02-01"), (10, "nonsense", "2024-02-01"), (11, "http://bad.com", None), (2, "https://www.bad.com./a?q=1", "2024-01-10"), (12, "http://x.org", "2024-02-01")], "page_id long, url string, at string")
    c = c.withColumn("fetched_at", F.to_date("at")).withColumn("entry", F.lit("clash")).withColumn("spans", F.lit(0)).withColumn("u", F.lit(1)).withColumn("verdict_", F.lit(1))
    out = urls.judge(c, e)
    got = {r["page_id"]: r["verdict"] for r in out.collect()}
    assert out.count() == 13 and set(c.columns) < set(out.columns)
    assert {k for k, v in got.items() if v["blocked"]} == {2, 3, 4, 6}
    assert got[3]["n_matches"] == 2 and got[3]["category"] == "more" and got[4]["category"] == "more" and got[6]["entry"] == "x.org/ads"
    assert urls.judge(c, e.limit(0)).where("verdict.blocked").count() == 0 and urls.judge(c.limit(0), e).count() == 0


# ---- n-gram model

def brute_kn(train, texts):
    toks = lambda t: [w.lower() for w in (t or "").encode().split()] + [None]
    pairs, uni = Counter(), Counter()
    for t in train:
        w = toks(t)
        uni.update(w)
        pairs.update(zip(["<s>", *w[:-1]], w))
    types = Counter(w for _, w in pairs)
    n, v = sum(uni.values()), len(uni)
    d2, d1 = (ngram.discounts(np.array([sum(c == k for c in x.values()) for k in (1, 2, 3, 4)])) for x in (pairs, types))
    cut = lambda c, d: max(c - d[min(c, 3)], 0)
    follow = defaultdict(list)
    for (a, _), c in pairs.items():
        follow[a].append(c)
    total = sum(types.values())
    free = sum(d1[min(c, 3)] for c in types.values()) / total if total else 1.0

    def p1(w):
        return (cut(types[w], d1) / total if total else 0) + free / (v + 1)

    def p2(a, w):
        if a not in follow:
            return p1(w)
        s = sum(follow[a])
        return cut(pairs[a, w], d2) / s + sum(d2[min(c, 3)] for c in follow[a]) / s * p1(w)
    out = []
    for t in texts:
        w = toks(t)
        out.append((len(w), sum(uni[x] > 0 for x in w), sum(math.log10((uni[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w),
                    sum(math.log10(p2(a, x)) for a, x in zip(["<s>", *w[:-1]], w))))
    return n, v, out, p2, uni, follow


def test_model_against_brute_force(spark, tmp_path):
    df = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    docs = [(r["doc_id"], r["text"]) for r in df.collect()]
    inside = [t for d, t in docs if zlib.crc32(str(d).encode()) % 5 != 1]
    n, v, want, p2, uni, follow = brute_kn(inside, [t for _, t in docs])
    model = ngram.train(df.where(~ngram.held_out(F.col("doc_id"))), str(tmp_path / "m"))
    assert (model["tokens"], model["distinct"]) == (n, v)
    got = {r["doc_id"]: r for r in ngram.score(df, model).collect()}
    for (d, _), (k, known, base, own) in zip(docs, want):
        r = got[d]
        assert (r["n_tokens"], r["n_known"]) == (k, known) and abs(r["base_score"] - base) < 1e-6 * abs(base) and abs(r["score"] - own) < 1e-6 * abs(own)
    for a in ["<s>", next(iter(w for w in uni if w is not None))]:
        assert abs(sum(p2(a, w) for w in uni) + p2(a, b"no such word") - 1) < 1e-9
    out = [r for d, r in got.items() if zlib.crc32(str(d).encode()) % 5 == 1]
    assert sum(r["score"] for r in out) > sum(r["base_score"] for r in out)


def test_model_hot_words_and_buckets_do_not_matter(spark, tmp_path, monkeypatch):
    df = awkward(spark)
    a = ngram.score(df, ngram.train(df, str(tmp_path / "a"), buckets=3)).orderBy("doc_id").collect()
    monkeypatch.setattr(ngram, "HOT", 1)
    b = ngram.score(df.repartition(4), ngram.train(df.repartition(4), str(tmp_path / "b"), buckets=17)).orderBy("doc_id").collect()
    assert [r["doc_id"] for r in a] == [r["doc_id"] for r in b]
    assert all(abs(x["score"] - y["score"]) < 1e-9 * max(1, abs(x["score"])) for x, y in zip(a, b))
    _, _, want, *_ = brute_kn([r["text"] for r in df.collect()], [r["text"] for r in df.orderBy("doc_id").collect()])
    assert all(abs(x["score"] - w[3]) < 1e-6 * max(1, abs(w[3])) for x, w in zip(a, want))


def test_model_of_no_texts(spark, tmp_path):
    df = awkward(spark)
    model = ngram.train(df.limit(0), str(tmp_path / "n"))
    assert all(r["score"] == 0 and r["base_score"] == 0 and r["n_known"] == 0 for r in ngram.score(df, model).collect())
    assert ngram.score(df.limit(0), model).count() == 0


def brute_order(train, texts, order):
    """Scores by the definition, with the counts of every level in dictionaries."""
    toks = lambda t: ["<s>", *[w.lower() for w in (t or "").encode().split()], None]
    grams = {k: Counter() for k in range(1, order + 1)}
    for t in train:
        w = toks(t)
        for j in range(order - 1, len(w)):
            grams[order][tuple(w[j - order + 1:j + 1])] += 1
        for k in range(2, order):
            if len(w) >= k:
                grams[k][tuple(w[:k])] += 1
    for k in range(order, 1, -1):
        grams[k - 1].update(g[1:] for g in grams[k])
    v = len({x for t in train for x in toks(t)[1:]})
    d = {k: ngram.discounts(np.array([sum(c == j for c in g.values()) for j in (1, 2, 3, 4)])) for k, g in grams.items()}
    follow = defaultdict(list)
    for g in grams.values():
        for x, c in g.items():
            follow[x[:-1]].append(c)

    sums = {ctx: (sum(mine), sum(d[len(ctx) + 1][min(x, 3)] for x in mine)) for ctx, mine in follow.items()}

    def p(ctx, w):
        k, (total, free) = len(ctx) + 1, sums.get(ctx, (0, 0))
        lower = p(ctx[1:], w) if ctx else 1 / (v + 1)
        if not total:
            return lower
        c = grams[k][(*ctx, w)]
        return (max(c - d[k][min(c, 3)], 0) + free * lower) / total
    out = []
    for t in texts:
        w = toks(t)
        out.append(sum(math.log10(p(tuple(w[max(0, j - order + 1):j]), w[j])) for j in range(1, len(w))))
    return out


@pytest.mark.parametrize("order", [2, 3, 4])
def test_model_of_an_order_against_brute_force(spark, tmp_path, monkeypatch, order):
    df = awkward(spark).unionByName(awkward(spark).where("doc_id in (7, 13)").withColumn("text", F.expr("substring(text, 5, 900)")))
    monkeypatch.setattr(ngram, "HOT_SHARE", 200000)
    model = ngram.train(df.where("doc_id is null or doc_id <> 14").repartition(3), str(tmp_path / "m"), buckets=5, order=order)
    train = [r["text"] for r in df.collect() if r["doc_id"] != 14]
    docs = sorted(ngram.score(df.withColumn("doc_id", F.struct("doc_id", "text")), model).collect(), key=lambda r: str(r["doc_id"]))
    want = brute_order(train, [r["doc_id"]["text"] for r in docs], order)
    assert all(abs(r["score"] - w) < 1e-6 * max(1, abs(w)) for r, w in zip(docs, want))
    empty = ngram.train(df.limit(0), str(tmp_path / "n"), order=order)
    assert all(r["score"] == 0 for r in ngram.score(df, empty).collect())


def test_registered_model_sees_two_words_of_context(spark, monkeypatch):
    """The query's scores differ where only the word before the last one does."""
    from quarry.llm import queries
    rows = [(i, " ".join(["a b c"] * 20 + ["d b e"] * 20)) for i in range(40)] + [(1000, "a b c"), (1001, "a b e")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(queries, "table", lambda *_: df)
    by = {r["doc_id"]: r["score"] for r in queries.op10_ngram(spark, "").collect()}
    assert by[1000] > by[1001] + 1
