"""Quality rules, mixing, shards and repeated passages: awkward rows and brute force."""

import hashlib
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from quarry.llm import mixing, quality, repeats, sharding
from tests.conftest import SF_SMALL
from tests.llm.fixtures import SCHEMA, awkward, prose, rows

W = re.compile(r"[^\x20\x09-\x0D]+")


def test_quality_base_figures_by_hand(spark):
    df = awkward(spark)
    out = quality.judged(df, as_col="judged")
    assert out.count() == df.count()
    for r in out.collect():
        w = W.findall(r["text"] or "")
        wins = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
        cov = {i + j for i in range(len(w) - 4) if wins[tuple(w[i:i + 5])] > 1 for j in range(5)}
        lines = [x for x in (r["text"] or "").split("\n") if W.search(x)]
        g = r["judged"]
        assert (g["n_words"], g["word_chars"], g["n_repeat_words"], g["n_dup_lines"]) == (len(w), sum(map(len, w)), len(cov), len(lines) - len(set(lines)))
        assert g["n_symbols"] == len(re.findall(r"[#*$%&|<>]", r["text"] or ""))
        assert g["base_failed"] == (len(w) < 10 or 100 * len(cov) > 20 * len(w))
        assert not (g["base_failed"] and g["kept"])


def test_quality_lines_are_removed(spark):
    good = prose(20, 40)
    df = spark.createDataFrame([(1, good + "\nHome | News | About | Help\nAll rights reserved.\n" + prose(21, 20), None, "s", 0),
                                (2, "A | b | c | d | e | f | g | h | i | j | k\n" + prose(22, 8), None, "s", 0), (3, good, "x", None, 0)], SCHEMA)
    out = {r["doc_id"]: r for r in quality.clean(df).collect()}
    assert set(out) == {1, 3}
    assert out[1]["text"] == good + "\n" + prose(21, 20) and out[1]["n_chars"] == len(out[1]["text"])
    assert out[3]["text"] == good
    assert quality.clean(df.limit(0)).count() == 0


def fill(sizes, weights, share, cap):
    """Round by round: deal the excess of sources above their cap to the others by weight."""
    total, stopped = share * sum(sizes), set()
    while True:
        left = total - sum(cap * sizes[i] for i in stopped)
        open_ = [i for i in range(len(sizes)) if i not in stopped]
        w = sum(weights[i] for i in open_)
        t = [cap * s if i in stopped else left * weights[i] / w for i, s in enumerate(sizes)]
        over = {i for i in open_ if t[i] >= cap * sizes[i]}
        if not over:
            return t
        stopped |= over
        if len(stopped) == len(sizes):
            return [cap * s for s in sizes]


def test_mix_targets_and_taken(spark):
    df = awkward(spark)
    m = mixing.mixed(df, as_col="got")
    assert m.count() == df.count() and set(m.columns) == {*df.columns, "got"}
    got = m.select("source", "got.*", "doc_id").collect()
    sizes: dict = {}
    for r in df.collect():
        sizes[r["source"]] = sizes.get(r["source"], 0) + len(W.findall(r["text"] or ""))
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    want = fill([sizes[s] for s in names], [(5, 2, 1)[i % 3] for i in range(len(names))], 1.5, 2.0)
    for s, t in zip(names, want):
        mine = [r for r in got if r["source"] == s]
        assert all(abs(r["target"] - t) < 1e-6 * max(t, 1) and r["source_size"] == sizes[s] for r in mine)
        assert all(0 <= r["taken"] <= 2 * r["size"] for r in mine)
        assert abs(sum(r["taken"] for r in mine) - t) <= max(r["size"] for r in mine)
    again = mixing.mixed(df.repartition(5), as_col="got").select("doc_id", "got.*")
    assert rows(again, "doc_id", "size", "taken") == rows(m.select("doc_id", "got.*"), "doc_id", "size", "taken")
    assert mixing.mix(df).count() == sum(r["copies"] for r in got)
    assert mixing.mix(df.limit(0)).count() == 0


def test_mix_refines_to_single_hashes(spark):
    """With many rows in a first-level bucket the finer levels decide; sums stay within one row."""
    df = spark.range(40000).select(F.col("id").alias("doc_id"), F.expr("repeat('a ', cast(id % 7 + 1 as int))").alias("text"),
                                   F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), (F.col("id") % 5).cast("string"))).alias("source"))
    per = mixing.mixed(df).groupBy("source").agg(F.sum("mix.taken").alias("taken"), F.max("mix.target").alias("target")).collect()
    assert all(abs(r["taken"] - r["target"]) <= 7 for r in per)


def test_shards(spark, tmp_path):
    df = awkward(spark)
    out = sharding.shard(df, str(tmp_path / "a"), shards=5, bucket_bytes=3000)
    (place,) = [c for c in out.columns if c not in df.columns]
    got = out.collect()
    assert Counter((r["doc_id"], r["text"]) for r in got) == Counter((r["doc_id"], r["text"]) for r in df.collect())
    slots: dict = {}
    for r in got:
        slots.setdefault(r[place]["shard"], []).append(r[place]["slot"])
    assert all(sorted(v) == list(range(len(v))) for v in slots.values()) and set(slots) <= set(range(5))
    again = sharding.shard(df.repartition(3), str(tmp_path / "b"), shards=5, bucket_bytes=3000).collect()
    key = lambda r: (r["doc_id"] is None, r["doc_id"], r["text"] or "", r[place])
    assert sorted(map(key, got)) == sorted(map(key, again))
    assert sharding.shard(df.limit(0), str(tmp_path / "c"), shards=5).count() == 0


def test_a_further_shard_takes_only_into_itself(spark):
    moved = spark.range(5000).select(sharding.shard_of(F.col("id"), 24).alias("a"), sharding.shard_of(F.col("id"), 25).alias("b"))
    assert moved.where("a <> b and b <> 24").count() == 0
    n = moved.where("a <> b").count()
    assert 100 < n < 320
    per = [r["count"] for r in moved.groupBy("a").count().collect()]
    assert len(per) == 24 and max(per) < 2 * min(per)


def test_shard_digests(spark):
    df = awkward(spark).select("text", sharding.record_size(F.col("text")).alias("s"), F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("c"))
    assert all((r["s"], r["c"]) == (len((r["text"] or "").encode()) + 8, zlib.crc32((r["text"] or "").encode())) for r in df.collect())


def brute_repeats(docs):
    """(words, kept words) by doc_id from the definition."""
    ws = {d: W.findall(t or "") for d, t in docs}
    first: dict = {}
    for d in sorted(ws):
        for i in range(len(ws[d]) - 19):
            first.setdefault(tuple(ws[d][i:i + 20]), (d, i))
    out = {}
    for d, w in ws.items():
        gone = {i + j for i in range(len(w) - 19) if first[tuple(w[i:i + 20])] != (d, i) for j in range(20)}
        out[d] = (len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone))
    return out


@pytest.mark.parametrize("parts", [1, 7])
def test_repeats_against_brute_force(spark, parts):
    p, q, r = prose(30, 60), prose(31, 45), prose(32, 19)
    docs = [(1, prose(40, 30) + " " + p), (2, p), (3, p), (4, q + " " + prose(41, 10) + " " + q + " " + q), (5, r + " x"), (6, r + " y"),
            (7, prose(42, 25) + "\n" + " ".join(p.split()[10:35]) + " " + prose(43, 5)), (8, " ".join(["la"] * 100)), (9, " ".join(["la"] * 70)),
            (-1, p + " " + q), (10, " ".join(p.split()[:40]) + " " + " ".join(q.split()[5:])), (11, None), (12, ""), (13, prose(44, 20)), (14, prose(44, 20))]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(parts)
    got = {x["doc_id"]: tuple(x["repeats"]) for x in repeats.deduplicated(df).collect()}
    assert got == brute_repeats(docs)


def test_repeats_awkward_rows(spark):
    df = awkward(spark)
    out = repeats.deduplicated(df, as_col="found")
    assert out.count() == df.count()
    want = brute_repeats([(r["doc_id"] if r["doc_id"] is not None else 1 << 62, r["text"]) for r in df.collect()])
    for r in out.collect():
        assert tuple(r["found"]) == want[r["doc_id"] if r["doc_id"] is not None else 1 << 62]
    kept = repeats.remove(df)
    assert kept.columns == df.columns and 2 not in {r["doc_id"] for r in kept.collect()} and kept.where("doc_id = 3 or doc_id = 4").count() == 2
    assert repeats.remove(df.limit(0)).count() == 0


def test_repeats_on_the_small_documents(spark):
    df = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    want = brute_repeats([(r["doc_id"], r["text"]) for r in df.collect()])
    got = {x["doc_id"]: tuple(x["repeats"]) for x in repeats.deduplicated(df).collect()}
    assert {k: hashlib.sha256(v[2].encode()).hexdigest() for k, v in got.items()} == {k: hashlib.sha256(v[2].encode()).hexdigest() for k, v in want.items()}
    assert {k: v[:2] for k, v in got.items()} == {k: v[:2] for k, v in want.items()}


@pytest.mark.parametrize("parts", [1, 5])
def test_repeats_rows_without_or_with_shared_ids(spark, parts):
    """Each row is judged on its own: null ids last, rows of one id apart."""
    p, q, clean = prose(70, 60), prose(71, 40), [prose(72 + i, 200) for i in range(6)]
    docs = [(1, p), (None, prose(80, 440) + " " + p), (None, prose(81, 30)), (None, ""), (None, None), (None, clean[0]), (None, clean[1]),
            (5, clean[2] + " " + p), (5, clean[3]), (5, "five words and no more"), (7, q), (None, q), (None, clean[4]), (None, clean[4]), (9, clean[5]), (9, clean[5])]
    df = spark.createDataFrame([(*d, k) for k, d in enumerate(docs)], "doc_id long, text string, k int").repartition(parts)
    got = {r["k"]: tuple(r["repeats"]) for r in repeats.deduplicated(df).collect()}
    assert len(got) == len(docs)
    for k, (_, text) in enumerate(docs):
        w = W.findall(text or "")
        gone = {1: 60, 7: 60, 11: 40}.get(k, 0)
        if k < 12:
            assert got[k] == (len(w), gone, " ".join(w[:len(w) - gone])), k
    assert sorted(got[k][1] for k in (12, 13)) == [0, 200] and sorted(got[k][1] for k in (14, 15)) == [0, 200]
    kept = repeats.remove(df)
    assert kept.columns == df.columns and kept.count() == len(docs) - 3
