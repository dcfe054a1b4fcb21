"""The registered queries of the subpackage: each applies one operator to its whole table.

Stand-ins: the tables hold no fetch times and no URL list, so op8 gives each page a day from its
page_id and makes a list log from the hosts and paths of the pages themselves.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import audit, chunkbpe, mixing, neardup, ngram, packing, quality, repeats, sharding, spelling, tokenfile, topk, urls
from quarry.llm.oracles import OP3, OP6, OP7, OP8, OP9, OP11, OP12
from quarry.session import stage_path
from quarry.sources.tables import table


def op1_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bins of 2048 words for all documents; equal texts are a cluster."""
    return packing.pack(table(spark, sf_dir, "documents"))


def op2_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class of near-duplicates (five words, similarity 0.8) of every document."""
    return neardup.clustered(table(spark, sf_dir, "documents"))


def op3_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources mixed by weights 5, 2, 1 to 150 % of all words."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    m = mixing.mixed(docs, keep_text=False)
    return m.select("doc_id", "mix.size", "mix.source_size", "mix.target", "mix.taken")


def op4_tokenfile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every text written as Huffman files and read back."""
    import public_tokenizers
    path = stage_path(spark, f"llm-chuf-{_run()}")
    totals = tokenfile.write(table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    back = tokenfile.read(totals, path)
    return back.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op5_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents written into 24 shards and read back; law: key."""
    docs = table(spark, sf_dir, "documents")
    out = sharding.shard(docs, stage_path(spark, f"llm-shards-{_run()}"))
    return out.select("doc_id", sharding.record_size(F.col("text")).alias("size"), F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
                      F.lit("key").alias("law"), "place.shard", "place.slot", sharding.shard_of(F.col("doc_id"), sharding.SHARDS + 1).alias("grown_shard"))


def op6_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five largest integer products for every row whose id is divisible by 50."""
    points = table(spark, sf_dir, "embeddings")
    return topk.search(points.where("vec_id % 50 = 0"), points)


def op7_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words in 20-word windows that start earlier too are removed from every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    r = repeats.deduplicated(docs)
    return r.select("doc_id", "repeats.n_words", "repeats.n_removed", F.sha2(F.col("repeats.kept").cast("binary"), 256).alias("kept_sha256"))


def op8_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page judged by the list entries active on its day."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    captures = pages.withColumn("fetched_at", F.date_add(F.lit("2023-01-01").cast("date"), (F.col("page_id") * 37 % 730).cast("int")))
    seen = pages.select(urls.host(F.col("url")).alias("host"), F.split(F.regexp_extract("url", urls.PATH, 1), "/")[1].alias("dir"), "page_id").where("host <> ''")
    day = lambda n: F.date_add(F.lit("2023-01-01").cast("date"), n.cast("int"))
    hosts = seen.groupBy(F.col("host").alias("entry")).agg(F.min("page_id").alias("k")).where("k % 3 = 0")
    dirs = seen.where("dir <> ''").groupBy(F.concat("host", F.lit("/"), "dir").alias("entry")).agg(F.min("page_id").alias("k")).where("k % 5 = 1")
    named = hosts.withColumn("category", F.lit("host")).unionByName(dirs.withColumn("category", F.lit("path")))
    turns = F.explode(F.array(*[F.struct(F.lit(a).alias("action"), day(F.col("k") * 11 % 300 + add).alias("at")) for a, add in (("add", 0), ("remove", 200), ("add", 320))]))
    events = named.select("entry", "category", turns.alias("e")).select("entry", "category", "e.at", "e.action")
    v = urls.judge(captures, events)
    return v.select("page_id", "url", "fetched_at", "verdict.blocked", "verdict.n_matches", "verdict.entry", "verdict.category", "verdict.since")


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base figures and verdict of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    r = quality.judged(docs)
    return r.select("doc_id", *[f"rules.{c}" for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")])


def op10_ngram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document scored by the trigram model of the documents that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = ngram.train(docs.where(~ngram.held_out(F.col("doc_id"))), stage_path(spark, f"llm-ngram-{_run()}"), order=3)
    s = ngram.score(docs, model)
    return s.select("doc_id", ngram.held_out(F.col("doc_id")).alias("held_out"), "n_tokens", "n_known", F.lit(model["tokens"]).cast("long").alias("train_tokens"), "base_score", "score")


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents with the form and root they are variants of."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return spelling.grouped(docs, drop_every=199).select("word", "form", "root", "n", "n_near", "form_n")


def op12_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distances between the sources of each language, and the terms above the language's share."""
    return audit.audit(table(spark, sf_dir, "documents").select("lang", "source", "text"))


def op13_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every text and what they decode to, as digests."""
    import public_tokenizers
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    b = chunkbpe.encoded(docs, public_tokenizers.path("word_bpe_49k.json")).select("doc_id", "bpe")
    ids = F.array_join(F.col("bpe.ids").cast("array<string>"), " ")
    return b.select("doc_id", F.size("bpe.ids").cast("long").alias("n_tokens"), F.sha2(ids.cast("binary"), 256).alias("ids_sha256"), F.sha2(F.col("bpe.decoded").cast("binary"), 256).alias("decoded_sha256"))


def _run() -> str:
    import uuid
    return uuid.uuid4().hex[:12]


QUERIES = {f.__name__: f for f in (op1_pack, op2_neardup, op3_mix, op4_tokenfile, op5_shard, op6_topk, op7_repeats, op8_urls, op9_quality, op10_ngram, op11_spelling, op12_audit, op13_bpe)}
ORACLES = {"op3_mix": OP3, "op6_topk": OP6, "op7_repeats": OP7, "op8_urls": OP8, "op9_quality": OP9, "op11_spelling": OP11, "op12_audit": OP12}
