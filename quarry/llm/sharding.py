"""Sharding by a two-pass external shuffle, with DataFrame operations only.

Pass one scatters the records: the shard is the one with the largest seeded hash of (id, shard),
so the id and the number of shards decide, and a further shard takes records only into itself;
within the shard a second seeded hash of the whole record deals buckets small enough for memory.
Pass two reads one bucket a task, orders it by hash, Fisher-Yates shuffles it (Spark's ``shuffle``
with a seed and the bucket's number) and writes it behind the buckets before it in its shard.

Scale: the texts are shuffled once; the number of buckets follows the bytes of the table, and equal
texts scatter by id, so a large group of copies spreads over all buckets. Law: ``key``.

Defined cases: a null text has no bytes (size 8, crc32 0); a null id is an id like any other;
records that are equal in id and text share a bucket, in any order, unless there are more than ``EQUAL_ROWS``,
which are spread over the buckets of their shard; empty tables give no rows;
other columns, whatever their names, are carried along.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import fresh, spread_key

SHARDS = 24
HEADER_BYTES = 8
BUCKET_BYTES = 16 << 20
#: Rows equal in id and text that may share a bucket.
EQUAL_ROWS = 1024
SEED = 20_240_607


def shard_of(doc_id: Column, shards: int, seed: int = SEED) -> Column:
    """Highest seeded hash wins: adding a shard moves only the records that it wins."""
    drawn = F.array(*[F.struct(F.xxhash64(doc_id, F.lit(seed), F.lit(i)).alias("h"), F.lit(i).alias("s")) for i in range(shards)])
    return F.array_max(drawn)["s"]


def record_size(text: Column) -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + HEADER_BYTES).cast("long")


def shard(docs: DataFrame, path: str, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text",
          seed: int = SEED, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Write ``docs`` to ``path/shard=<n>/`` and return the table read from there: all columns of
    ``docs``, and shard and slot (position in the shard, from 0) as a struct column ``place``."""
    spark = docs.sparkSession
    place, rec, bucket, rows = fresh(docs, "place", "_rec", "_bucket", "_rows")
    s = shard_of(F.col(id_col), shards, seed)
    total = docs.select(F.sum(record_size(F.col(text_col)))).first()[0] or 0
    per_shard = max(1, -(-int(total) // (bucket_bytes * shards)))
    spread, key, _ = spread_key(docs, F.xxhash64(F.col(id_col), F.col(text_col), F.lit(seed + 1)), EQUAL_ROWS)
    sub = F.pmod(F.col(key), F.lit(per_shard)).cast("int")
    scattered = spread.select(F.struct(*[f"`{c}`" for c in docs.columns]).alias(rec), (s * per_shard + sub).alias(bucket))
    order = F.xxhash64(F.col(f"{rec}.`{id_col}`"), F.col(f"{rec}.`{text_col}`"), F.lit(seed + 2))
    entry = F.struct(order.alias("h"), F.col(rec).alias("rec"))
    dealt = scattered.select(bucket, entry.alias(rec)).repartitionById(shards * per_shard, F.col(bucket))
    packed = dealt.groupBy(bucket).agg(F.sort_array(F.collect_list(rec)).alias(rows))
    mixed = packed.select(bucket, F.posexplode(F.shuffle(rows, seed)).alias("pos", "e"))
    counts = spread.select((s * per_shard + sub).alias("b")).groupBy("b").agg(F.count("*").alias("n"))
    before = Window.partitionBy(F.floor(F.col("b") / per_shard)).orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("b", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    placed = mixed.join(F.broadcast(starts) if shards * per_shard <= 100_000 else starts, F.col(bucket) == F.col("b"))
    out = placed.select(F.col("e.rec").alias("rec"), F.floor(F.col(bucket) / per_shard).cast("int").alias("shard"), (F.col("first") + F.col("pos")).alias("slot"))
    out.write.partitionBy("shard").parquet(path)
    back = spark.read.schema(out.schema).parquet(path)
    return back.select("rec.*", F.struct("shard", "slot").alias(place))
