"""Ids that pandas would round, rows without ids, lost files, few file descriptors, odd list entries."""

import os
import random
import resource
import time

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from quarry.llm import ngram, packing, quality, repeats, sharding, tokenfile, topk, urls
from tests.llm.fixtures import prose

TOKENS = public_tokenizers.path("byte_bpe_50k.json")


def test_packing_keeps_large_ids_beside_a_null_one(spark):
    ids = [2 ** 53 + 1, 2 ** 53 + 3, None, -5, 2 ** 63 - 1]
    df = spark.createDataFrame([(i, prose(k, 10), "s") for k, i in enumerate(ids)], "doc_id long, text string, source string")
    out = packing.pack(df, group_rows=100)
    assert dict(out.dtypes)["doc_id"] == "bigint"
    assert sorted((r["doc_id"] for r in out.collect()), key=lambda x: (x is None, x)) == sorted((i for i in ids), key=lambda x: (x is None, x))
    texts = df.withColumn("doc_id", F.concat(F.lit("id"), F.col("doc_id").cast("string")))
    assert {r["doc_id"] for r in packing.pack(texts).collect()} == {r["doc_id"] for r in texts.collect()}


def test_vectors_without_an_id_take_no_part(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0]), (1, [1.0, 1.0]), (None, [9.0, 9.0]), (50, [0.5, 0.5])], "vec_id long, embedding array<double>")
    got = {(r["query_id"], r["vec_id"]) for r in topk.search(df.where("vec_id % 50 = 0 or vec_id is null"), df).collect()}
    assert got == {(0, 1), (0, 50), (50, 0), (50, 1)}


def test_a_lost_token_file_is_an_error(spark, tmp_path):
    df = spark.createDataFrame([(i, prose(i, 200)) for i in range(60)], "doc_id long, text string")
    path = str(tmp_path / "lost")
    totals = tokenfile.write(df, path, TOKENS, file_text_bytes=8000)
    names = sorted(f for f in os.listdir(path) if f.endswith(".chuf"))
    assert len(names) > 3 and tokenfile.read(totals, path).count() == 60
    os.rename(os.path.join(path, names[2]), str(tmp_path / "elsewhere"))
    with pytest.raises(FileNotFoundError, match="1 of the files"):
        tokenfile.read(totals, path)


def test_a_lost_model_file_is_an_error_and_an_empty_bucket_is_not(spark, tmp_path):
    df = spark.createDataFrame([(i, prose(i, 40)) for i in range(12)], "doc_id long, text string")
    model = ngram.train(df, str(tmp_path / "m"), buckets=512, order=3)
    assert 0 < len(model["present"][3]) < 512 and 0 < len(model["present"][1]) < 512
    assert ngram.score(df, model).count() == 12
    ngram._maps.clear()
    with pytest.raises(Exception, match="No such file|FileNotFound"):
        ngram.score(df, {**model, "path": str(tmp_path / "absent")}).collect()


def test_scoring_needs_few_descriptors(spark, tmp_path):
    df = spark.createDataFrame([(i, prose(i, 300)) for i in range(20)], "doc_id long, text string")
    model = ngram.train(df, str(tmp_path / "m"), buckets=300, order=3)
    words = [[t for t in r["text"].split()] for r in df.collect()]
    soft, hard = resource.getrlimit(resource.RLIMIT_NOFILE)
    ngram._maps.clear()
    before = len(os.listdir("/proc/self/fd"))
    resource.setrlimit(resource.RLIMIT_NOFILE, (min(hard, before + ngram.OPEN_ARRAYS + 40), hard))
    try:
        for second, sizes in ngram.slices(" ".join(w).encode() for w in words):
            ngram.token_scores(model, second, sizes)
        assert len(ngram._maps) <= ngram.OPEN_ARRAYS
    finally:
        resource.setrlimit(resource.RLIMIT_NOFILE, (soft, hard))
        ngram._maps.clear()


def test_list_entries_are_read_as_hosts_are(spark):
    c = spark.createDataFrame([(1, "http://www.Example.COM/a/b", "2024-02-01"), (2, "http://other.org/Dir/x", "2024-02-01"), (3, "http://other.org/dir/x", "2024-02-01")], "page_id long, url string, fetched_at string")
    for entry, hit in (("Example.COM", {1}), ("example.com.", {1}), ("EXAMPLE.com/", {1}), ("Other.ORG./Dir/", {2}), ("other.org//Dir", {2}), ("/", set()), ("", set()), (".", set())):
        e = spark.createDataFrame([(entry, "x", "2024-01-01", "add")], "entry string, category string, at string, action string")
        got = urls.judge(c, e)
        assert {r["page_id"] for r in got.where("verdict.blocked").collect()} == hit, entry


def test_pieces_alike_are_placed_as_by_a_whole_search():
    """The search that goes on where the one before ended gives the bins of one that starts anew."""
    class Anew(packing.Bins):
        def place(self, size, source, cluster):
            self.last = None
            return super().place(size, source, cluster)

    rnd = random.Random(5)
    for _ in range(200):
        few = [(rnd.choice([3, 5, 8, 9, 20, 21]), 1 << rnd.randrange(3), rnd.choice([0, 1, 2, 4])) for _ in range(rnd.randrange(1, 8))]
        pieces = [p for p in (rnd.choice(few) for _ in range(60)) for _ in range(rnd.randrange(1, 4))]
        if rnd.random() < 0.5:
            pieces.sort(key=lambda p: -p[0])
        one, other = packing.Bins(40), Anew(40)
        assert [one.place(*p) for p in pieces] == [other.place(*p) for p in pieces]
        assert one.order == other.order


def test_many_equal_rows_pack_in_one_walk():
    begun = time.process_time()
    out = list(packing.pack_group([30] * 20_000 + [7] * 20_000, ["s"] * 20_000 + ["t"] * 20_000, ["c"] * 20_000 + ["d"] * 20_000, 2048))
    assert time.process_time() - begun < 2
    assert len(out) == 40_000 and len({x[1] for x in out}) == 20_000


def test_places_in_many_files_and_a_lost_one(spark, tmp_path, monkeypatch):
    """Repeats do not depend on how the places are cut into files; a lost file is an error."""
    p, q = prose(90, 40), prose(91, 33)
    docs = [(k * 7 - 30, f"{prose(100 + k, 12)} {p if k % 2 else q} {prose(200 + k, 9)}") for k in range(24)] + [(9000, prose(300, 50)), (9001, None)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    whole = sorted(tuple(r) for r in repeats.deduplicated(df).select("doc_id", "repeats.*").collect())
    assert sum(r[2] for r in whole) == 11 * 40 + 11 * 33
    monkeypatch.setattr(repeats, "FILE_PLACES", 20)
    assert sorted(tuple(r) for r in repeats.deduplicated(df).select("doc_id", "repeats.*").collect()) == whole
    places = spark.createDataFrame([(k * 3, [k, k + 1]) for k in range(30)], "id long, at array<int>")
    folder = str(tmp_path / "places")
    lows = repeats.places_written(places, folder)
    assert len(lows) > 3 and {i: a.tolist() for i, a in repeats.places_of(folder, lows, np.array([87, -5, 0, 1, 45])).items()} == {0: [29, 30], 2: [0, 1], 4: [15, 16]}
    os.rename(os.path.join(folder, f"{lows[1]}.npy"), str(tmp_path / "elsewhere"))
    repeats._file.cache_clear()
    with pytest.raises(FileNotFoundError):
        repeats.places_of(folder, lows, np.array([int(lows[1])]))


def test_many_equal_rows_do_not_share_a_group_or_bucket(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sharding, "EQUAL_ROWS", 50)
    text = prose(1, 30)
    rows = [(7, text, "a")] * 900 + [(None, None, None)] * 300 + [(i, prose(i, 30), "b") for i in range(100, 400)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = packing.pack(df, group_rows=100)
    assert got.count() == len(rows)
    of = [r["n"] for r in got.where("doc_id = 7").groupBy(F.shiftright("bin", 32)).agg(F.count("*").alias("n")).collect()]
    assert sum(of) == 900 and len(of) > 8 and max(of) < 200
    back = sharding.shard(df, str(tmp_path / "s"), shards=3, bucket_bytes=1500).select("doc_id", "text", "place.*").collect()
    assert sorted((r["doc_id"] or -1) for r in back) == sorted((r[0] or -1) for r in rows)
    for s in range(3):
        slots = sorted(r["slot"] for r in back if r["shard"] == s)
        assert slots == list(range(len(slots)))
    assert len({r["shard"] for r in back if r["doc_id"] == 7}) == 1


def test_rules_are_evaluated_once_in_clean(spark):
    df = spark.createDataFrame([(1, "a " * 20, 40)], "doc_id long, text string, n_chars int")
    plan = quality.clean(df)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("all rights reserved") == 1 and plan.count("xxhash64") == 1
