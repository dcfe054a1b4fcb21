"""Spelling variants, source audits and chunked byte-pair encoding against brute force."""

import json
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quarry.llm import audit, chunkbpe, spelling
from tests.conftest import SF_SMALL
from tests.llm.fixtures import awkward, prose, rows

WORDS = public_tokenizers.path("word_bpe_49k.json")


# ---- spelling

def one_edit(a: str, b: str) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute_variants(counts: dict, times: int) -> set:
    near = {w: [x for x in counts if x != w and one_edit(w, x)] for w in counts}
    form = {}
    for w, xs in near.items():
        best = min(xs, key=lambda x: (-counts[x], x.encode()), default=None)
        form[w] = best if best is not None and counts[best] >= times * counts[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])
    return {(w, n, len(near[w]), form[w], counts.get(form[w]), root(w)) for w, n in counts.items()}


def variant_rows(df) -> set:
    return {(r["word"], r["n"], r["n_near"], r["form"], r["form_n"], r["root"]) for r in df.collect()}


def some_words(seed: int, n: int, letters: str = "abcdé÷") -> dict:
    r = random.Random(seed)
    base = ["".join(r.choice(letters) for _ in range(r.randint(6, 9))) for _ in range(n)]
    out = {}
    for w in base:
        out[w] = r.choice([5, 7, 30, 200, 5000])
        for _ in range(2):
            i = r.randrange(len(w))
            x = r.choice([w[:i] + w[i + 1:], w[:i] + r.choice(letters) + w[i + 1:], w[:i] + r.choice(letters) + w[i:], w[:i] + w[i:][::-1]])
            out.setdefault(x, r.choice([5, 6, 30, 150]))
    return out


def test_near_words_are_all_and_only_one_edit_apart():
    words = [w for w in some_words(1, 400) if len(w) in (7, 8)]
    by = {k: np.array([w for w in words if len(w) == k], object) for k in (7, 8)}
    same = {frozenset((by[8][i], by[8][j])) for a, b in spelling.near_pairs(by[8], by[8], 8, False, same=True) for i, j in zip(a, b)}
    assert same == {frozenset((a, b)) for a in by[8] for b in by[8] if one_edit(a, b)}
    more = [(by[7][i], by[8][j]) for a, b in spelling.near_pairs(by[8], by[7], 8, True) for i, j in zip(a, b)]
    assert len(more) == len(set(more)) and set(more) == {(a, b) for a in by[7] for b in by[8] if one_edit(a, b)}


@pytest.mark.parametrize("leaf,box", [(8192, 16), (12, 2)])
def test_variants_are_the_brute_force_ones(spark, monkeypatch, leaf, box):
    monkeypatch.setattr(spelling, "LEAF", leaf)  # small leaves: planes in Spark, words near several boxes
    monkeypatch.setattr(spelling, "BOX", box)
    monkeypatch.setattr(spelling, "SAMPLE_A_LEAF", 2)
    counts = some_words(2, 250)
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert variant_rows(spelling.variants(df, 5)) == brute_variants(counts, 5)


def test_anagrams_lie_in_one_leaf_and_are_dealt_to_several_groups(spark, monkeypatch):
    monkeypatch.setattr(spelling, "LEAF", 20)
    r = random.Random(5)
    words = {"".join(r.sample("abcdefgh", 8)): 9 for _ in range(300)}
    words |= {w[:3] + "z" + w[4:]: 50 for w in list(words)[:60]} | {w[:3] + "z" + w[3:]: 6 for w in list(words)[:40]}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    assert variant_rows(spelling.variants(df, 5)) == brute_variants(words, 5)


def test_a_chain_of_forms_ends_at_its_root(spark):
    chain = {"aaaaaa" + "b" * i: 5 * 5 ** (12 - i) for i in range(12)}
    got = spelling.variants(spark.createDataFrame(list(chain.items()), "word string, n long"), 5)
    assert {r["root"] for r in got.collect()} == {"aaaaaa"}


def test_spelling_of_awkward_documents(spark):
    df = awkward(spark).withColumn("text", F.concat_ws(" ", "text", F.lit("Sprachen SPRACHEN ÄRGERLICH ärgerlich sprache naïveté")))
    df = df.unionByName(df.where("doc_id is null")).withColumn("word", F.lit("x"))
    counts: Counter = Counter()
    for r in df.collect():
        for w in re.findall("[A-Za-zÀ-ÿ]+", "" if r["text"] is None else r["text"]):
            w = re.sub("[A-Z]", lambda m: m[0].lower(), w)
            h = zlib.crc32(f"{'' if r['doc_id'] is None else r['doc_id']}:{w}".encode())
            counts[w[:h % len(w)] + w[h % len(w) + 1:] if h % 3 == 0 else w] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 2}
    got = spelling.grouped(df, drop_every=3, min_count=2, times=2)
    assert variant_rows(got) == brute_variants(counts, 2) and len(counts) > 10
    assert spelling.grouped(df.limit(0)).collect() == []
    assert spelling.grouped(df.withColumn("text", F.lit(None).cast("string"))).collect() == []


# ---- audit

def brute_audit(docs: list, min_docs: int, top: int) -> set:
    docs = [(a or "", b or "", [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", c or "")]) for a, b, c in docs]
    out = set()
    for lang in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == lang]
        df = Counter(t for d in mine for t in set(d[2]))
        kept = {t for t, n in df.items() if n >= min_docs}
        count = {s: Counter(t for d in mine if d[1] == s for t in d[2] if t in kept) for s in {d[1] for d in mine}}
        whole = sum(count.values(), Counter())

        def p(c, t):
            return 1 + 10 ** 9 * (c[t] + 5) // (sum(c.values()) + 5 * len(kept))
        for s, c in count.items():
            pair = sorted(((sum(abs(p(c, t) - p(d, t)) for t in kept), o) for o, d in count.items() if o != s), key=lambda x: (-x[0], x[1].encode()))
            term = sorted(((p(c, t) - p(whole, t), t) for t in kept if c[t] and p(c, t) > p(whole, t)), key=lambda x: (-x[0], x[1].encode()))[:top]
            out |= {(lang, s, part, o, v, i + 1) for part, xs in (("pair", pair), ("term", term)) for i, (v, o) in enumerate(xs)}
    return out


def audit_rows(df) -> set:
    got = [(r["lang"], r["source"], r["part"], r["item"], r["value"], r["rank"]) for r in df.collect()]
    assert len(got) == len(set(got))
    return set(got)


def test_skyband_keeps_what_fewer_than_k_dominate():
    r = np.random.default_rng(4)
    n, m = r.integers(0, 12, 1500), r.integers(0, 12, 1500)
    t = np.array([f"t{x}" for x in r.permutation(1500)], object)
    dominated = [sum((n >= n[i]) & (m <= m[i]) & np.array([x < t[i] for x in t])) for i in range(0, 1500, 7)]
    for k in (1, 5, 50):
        kept = set(ids := audit.skyband(n, m, t, k).tolist())
        assert len(kept) == len(ids)
        assert [i in kept for i in range(0, 1500, 7)] == [d < k for d in dominated]


@pytest.mark.parametrize("cells,merged", [(1 << 21, 32), (40, 1)])
def test_audit_is_the_brute_force_one(spark, monkeypatch, cells, merged):
    monkeypatch.setattr(audit, "CELLS", cells)  # many buckets a language
    monkeypatch.setattr(audit, "MERGED", merged)
    monkeypatch.setattr(audit, "KEYS_AT_ONCE", 500 if merged == 1 else 300_000)
    r = random.Random(3)
    vocab = ["".join(r.choice("abcÄß漢") for _ in range(r.randint(1, 3))) for _ in range(120)]
    docs = [(r.choice(["en", "en", "de", None]), r.choice(["a", "b", "ç", None, ""]), " ".join(r.choices(vocab, k=r.randint(0, 60)) + [r.choice(["X1y", "Z_z"])])) for _ in range(150)]
    docs += [("fr", "one", "rare words only"), ("fr", "two", None), ("en", "empty", ""), ("it", "x", None)]
    df = spark.createDataFrame(docs, "lang string, source string, text string").repartition(5)
    got = audit_rows(audit.audit(df, min_docs=8, top=6))
    assert got == brute_audit(docs, 8, 6) and sum(x[2] == "term" for x in got) > 40


def test_audit_of_awkward_documents(spark):
    df = awkward(spark).withColumn("item", F.lit(1)).withColumn("value", F.lit(2)).withColumn("rank", F.lit(3)).withColumn("term", F.lit("t"))
    docs = [(r["lang"], r["source"], r["text"]) for r in df.collect()]
    assert audit_rows(audit.audit(df, min_docs=2)) == brute_audit(docs, 2, 50)
    assert audit.audit(df.limit(0)).collect() == []


def test_shares_pass_64_bits(spark):
    n, total, v = 9_000_000_000_000, 9_500_000_000_000, 77
    df = spark.createDataFrame([(n, total, v), (0, 0, 0)], "n long, total long, v long").select(audit.share(F.col("n"), F.col("total"), F.col("v")).alias("p"))
    assert [r["p"] for r in df.collect()] == [1 + 10 ** 9 * (n + 5) // (total + 5 * v), None]


# ---- byte-pair encoding

@pytest.fixture(scope="module")
def tok():
    return Tokenizer.from_file(WORDS)


def check_bpe(df, tok, path=WORDS):
    got = chunkbpe.encoded(df, path).collect()
    for r in got:
        e = tok.encode(r["text"] or "", add_special_tokens=False)
        assert r["bpe"]["ids"] == e.ids and r["bpe"]["decoded"] == tok.decode(e.ids, skip_special_tokens=False), (r["doc_id"], (r["text"] or "")[:80])
    return got


def repeats(n: int = 40) -> list:
    """Texts that share passages at odd places: mid-word, next to marks, without any space, in one text twice."""
    r = random.Random(11)
    shared = [prose(100 + i, 400) for i in range(4)] + ["".join(r.choice("abcdef") for _ in range(4000)), "ab" * 3000, "ß漢é'sdon't" * 300, "x y z " * 400, "é ́a" * 500]
    out = []
    for i in range(n):
        parts = [s[r.randrange(5):] for s in r.sample(shared, 3)]
        out.append(r.choice(["", "Don'T ", "a", "<|endoftext|>", "é́"]).join([prose(i, 30), *parts, "<|startoftext|> end"]))
    return out


def test_ids_are_those_of_the_library(spark, tok):
    df = spark.createDataFrame(list(enumerate(repeats())), "doc_id long, text string").repartition(3)
    check_bpe(df, tok)


def test_bpe_of_awkward_documents(spark, tok):
    df = awkward(spark).withColumn("bpe", F.lit("extra")).withColumn("key", F.lit(1))
    got = chunkbpe.encoded(df, WORDS)
    assert got.columns == [*df.columns, "bpe_"] and got.count() == df.count()
    check_bpe(df.drop("bpe"), tok)
    assert chunkbpe.encoded(df.limit(0), WORDS).collect() == []
    big = spark.createDataFrame([(2 ** 53 + 1, "a"), (None, "b"), (2 ** 53 + 3, None)], "doc_id long, text string")
    assert rows(chunkbpe.encoded(big, WORDS), "doc_id") == rows(big, "doc_id")


def test_shared_chunks_are_found_whatever_stands_before_them():
    passage = prose(1, 2000).encode()
    cut = []
    for head in (b"", b"zz zz ", prose(2, 77).encode()):
        data = head + passage
        (places,) = chunkbpe.cuts(np.frombuffer(data, np.uint8), [0], [len(data)])
        assert places[-1] == len(data) and all(b - a >= chunkbpe.MIN_CHUNK for a, b in zip([0, *places], places[:-1]))
        cut.append({p - len(head) for p in places})
    assert len(cut[0]) > 5 and len(cut[0] & cut[1] & cut[2]) >= len(cut[0]) - 2


def test_chunks_that_occur_again_are_encoded_once_and_used(spark, tok, monkeypatch):
    monkeypatch.setattr(chunkbpe, "FILE_KEYS", 2)  # many files
    texts = [f"{prose(i, 10)} {prose(100, 1500)} {prose(50 + i, 10)}" for i in range(8)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    index = chunkbpe.shared_chunks(df, "text", WORDS)
    assert len(index["names"]) > 3
    enc, todo = chunkbpe.Encoder(WORDS), []
    plain = enc.encode

    def counted(some):
        todo.extend(some)
        return plain(some)
    enc.encode = counted
    ids = chunkbpe.encode_slice(enc, {**index, "set": set(index["names"])}, [t.encode() for t in texts])
    assert [np.frombuffer(i, np.uint32).tolist() for i in ids] == [tok.encode(t, add_special_tokens=False).ids for t in texts]
    assert sum(map(len, todo)) < sum(map(len, texts)) / 4


def test_a_missing_file_of_ids_is_an_error(spark):
    df = spark.createDataFrame([(i, prose(1, 500)) for i in range(3)], "doc_id long, text string")
    index = chunkbpe.shared_chunks(df, "text", WORDS)
    index["folder"] += "-absent"
    with pytest.raises(FileNotFoundError):
        chunkbpe.encode_slice(chunkbpe.Encoder(WORDS), {**index, "set": set(index["names"])}, [prose(1, 500).encode()])


def test_another_tokenizer_encodes_whole_texts(spark, tmp_path):
    path = public_tokenizers.path("byte_bpe_50k.json")
    with open(path, encoding="utf-8") as f:
        assert not chunkbpe.drops_space(json.load(f))
    df = spark.createDataFrame([(1, "one  two\n three"), (2, prose(1, 300)), (3, prose(1, 300)), (4, None)], "doc_id long, text string")
    check_bpe(df, Tokenizer.from_file(path), path)


def test_words_tokenizer_is_known_to_drop_space():
    with open(WORDS, encoding="utf-8") as f:
        config = json.load(f)
    assert chunkbpe.drops_space(config)
    assert not chunkbpe.drops_space({**config, "normalizer": {"type": "Strip"}})
    assert not chunkbpe.drops_space({**config, "added_tokens": [{**config["added_tokens"][0], "rstrip": True}]})


def test_random_texts(spark, tok):
    r = random.Random(9)
    marks = ["'", "'s", "'S", "'LL", "''", "!'s", " ", "\n", "\t", "\r\n", "\x0b", "\x1c", "\x85", " ", "<|endoftext|>", "<|", "é", "İ", "ΑΣ ", "ﬁ", "½", "٣", "😀", "Ж", "x", "Yz", "1", "23", "×", "ª", "́", "Å", "ÿ", "_", "\x7f"]
    texts = ["".join(r.choices(marks, k=r.randint(1, 40))) for _ in range(1500)]
    enc = chunkbpe.Encoder(WORDS)
    for t, i in zip(texts, enc.encode(texts)):
        assert np.frombuffer(i, np.uint32).tolist() == tok.encode(t, add_special_tokens=False).ids, repr(t)


def test_queries_run_whole(spark):
    from quarry.llm.queries import QUERIES
    n = spark.read.parquet(f"{SF_SMALL}/documents.parquet").count()
    assert QUERIES["op13_bpe"](spark, SF_SMALL).count() == n
