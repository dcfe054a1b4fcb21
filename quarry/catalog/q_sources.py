"""Sources and sinks: each query writes the input table in the format under test
into the shared stage folder, reads it back through the library, and returns the result."""

import datetime as dt

from pyspark.sql import functions as F

from quarry.catalog.registry import query, t, tag as _tag
from quarry.sources import io


def _stage(spark, d, name):
    return io.store_path(spark, f"catalog/{name}/{_tag(d)}")


@query("src_csv", "SELECT * FROM nation")
def src_csv(spark, d):
    path = io.write_csv(t(spark, d, "nation"), _stage(spark, d, "nation_csv"))
    return io.read_csv(spark, path, "n_nationkey int, n_name string, n_regionkey int")


@query("src_csv_key", "SELECT p_partkey, p_name, p_retailprice FROM part")
def src_csv_key(spark, d):
    path = io.write_csv(t(spark, d, "part"), _stage(spark, d, "part_csv"))
    p = io.read_csv(spark, path, "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double")
    return p.select("p_partkey", "p_name", "p_retailprice")


@query("src_csv_encoding", """SELECT doc_id, md5(regexp_replace(text, '[^\\x{00}-\\x{FF}]', '?', 'g')) AS text_md5 FROM documents""")
def src_csv_encoding(spark, d):
    docs = t(spark, d, "documents").select("doc_id", "text")
    path = io.write_csv(docs, _stage(spark, d, "docs_latin1"), encoding="ISO-8859-1")
    back = io.read_csv(spark, path, "doc_id long, text string", encoding="ISO-8859-1", multi_line=True)
    return back.select("doc_id", F.md5("text").alias("text_md5"))


CUST_TYPES = {"c_custkey": "bigint", "c_nationkey": "int", "c_acctbal": "double"}


@query("src_csv_dtypes", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def src_csv_dtypes(spark, d):
    path = io.write_csv(t(spark, d, "customer"), _stage(spark, d, "customer_csv"))
    raw = io.read_csv(spark, path)  # all text
    return io.retype(raw, CUST_TYPES)


@query("src_csv_nulltoken", "SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN NULL ELSE c_acctbal END AS c_acctbal FROM customer")
def src_csv_nulltoken(spark, d):
    c = t(spark, d, "customer").select("c_custkey", F.when(F.col("c_acctbal") < 0, F.lit("         NA"))
                                       .otherwise(F.col("c_acctbal").cast("string")).alias("c_acctbal"))
    path = io.write_csv(c, _stage(spark, d, "customer_na"))
    raw = io.read_csv(spark, path, "c_custkey long, c_acctbal string")
    return io.retype(io.null_tokens(raw, ["c_acctbal"]), {"c_acctbal": "double"})


@query("src_csv_limit", "SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderkey LIMIT 100")
def src_csv_limit(spark, d):
    path = io.write_csv(t(spark, d, "orders"), _stage(spark, d, "orders_csv"))
    o = io.read_csv(spark, path, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
                    "o_orderdate timestamp_ntz, o_orderpriority string", timestamp_format="yyyy-MM-dd HH:mm:ss")
    return io.first_rows(o, 100, ["o_orderkey"]).select("o_orderkey", "o_custkey")


@query("src_csv_columns", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem")
def src_csv_columns(spark, d):
    path = io.write_csv(t(spark, d, "lineitem"), _stage(spark, d, "lineitem_csv"))
    li = io.read_csv(spark, path, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
                     "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
                     "l_shipdate timestamp_ntz", timestamp_format="yyyy-MM-dd HH:mm:ss")
    return li.select("l_orderkey", "l_linenumber", "l_quantity")


@query("src_csv_strings", """SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderstatus, CAST(o_totalprice AS VARCHAR) AS o_totalprice,
  strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate FROM orders""")
def src_csv_strings(spark, d):
    o = t(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    path = io.write_csv(o, _stage(spark, d, "orders_str"))
    return io.read_csv(spark, path)


@query("src_chunks", "SELECT l_orderkey, l_linenumber, l_extendedprice * (1 - l_discount) AS net FROM lineitem")
def src_chunks(spark, d):
    def fn(df):
        return df.select("l_orderkey", "l_linenumber", (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("net"))
    return io.transform_in_chunks(t(spark, d, "lineitem"), fn, f"catalog/chunks/{_tag(d)}")


@query("src_dir")
def src_dir(spark, d):
    """Rows-only: the files of a written tree listed by suffix, with the partition read from the path."""
    path = io.write_store(t(spark, d, "nation"), f"catalog/nation_tree/{_tag(d)}", partition_by=["n_regionkey"])
    files = io.list_files(spark, path, ".parquet")
    return files.select(F.regexp_extract("path", r"n_regionkey=(\d+)", 1).cast("int").alias("n_regionkey"), "length")


@query("src_path_label", r"""SELECT page_id, regexp_replace(regexp_extract(regexp_replace(url, '[?#].*$', ''), '([^/]*)$', 1), '\.[^.]*$', '') AS name,
  substr(regexp_extract(regexp_replace(url, '[?#].*$', ''), '([^/]*)$', 1), -5, 1) AS cls FROM pages""")
def src_path_label(spark, d):
    p = t(spark, d, "pages")
    full = io.base_name("url", strip_suffix=False)
    return p.select("page_id", io.base_name("url").alias("name"), io.char_class(full).alias("cls"))


@query("src_nested_docs", "SELECT conv_id, CAST(turn AS INTEGER) AS item_pos, role, text FROM conversations")
def src_nested_docs(spark, d):
    c = t(spark, d, "conversations")
    # the stand-in file: one document per conversation holding its turns (turn = position)
    docs = c.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("items"))
    path = io.write_store(docs, f"catalog/nested/{_tag(d)}")
    back = spark.read.parquet(path)
    e = io.explode_items(back, "conv_id", "items")
    return e.select("conv_id", F.col("turn").cast("int").alias("item_pos"), "role", "text")


@query("src_store", "SELECT * FROM supplier")
def src_store(spark, d):
    io.write_store(t(spark, d, "supplier"), f"catalog/store/supplier/{_tag(d)}")
    return io.read_store(spark, f"catalog/store/supplier/{_tag(d)}")


@query("src_feature_cache", """SELECT vec_id, label, round(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE))), 4) AS sq
FROM embeddings""")
def src_feature_cache(spark, d):
    e = t(spark, d, "embeddings").select("vec_id", "label", F.transform("embedding", lambda x: x.cast("double")).alias("v"))
    cached = io.cache_features(e, f"catalog/features/{_tag(d)}")
    return cached.select("vec_id", "label", F.round(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x), 4).alias("sq"))


@query("sink_csv", "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def sink_csv(spark, d):
    o = t(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    path = io.write_csv(o, _stage(spark, d, "sink_csv"))
    return io.read_csv(spark, path, "o_orderkey long, o_orderstatus string, o_totalprice double")


@query("sink_csv_gzip", "SELECT o_orderkey, o_orderpriority FROM orders")
def sink_csv_gzip(spark, d):
    o = t(spark, d, "orders").select("o_orderkey", "o_orderpriority")
    path = io.write_csv(o, _stage(spark, d, "sink_gz"), gzip=True)
    return io.read_csv(spark, path, "o_orderkey long, o_orderpriority string")


@query("sink_named", """SELECT o_orderkey, o_totalprice,
  'submission_' || printf('%.6f', (SELECT avg(o_totalprice) FROM orders) / 1e5) || '_2024-01-01-12-30' AS file FROM orders""")
def sink_named(spark, d):
    """A CSV written under a name holding the rounded score and a minute stamp, read back."""
    o = t(spark, d, "orders").select("o_orderkey", "o_totalprice")
    score = o.agg(F.avg("o_totalprice")).first()[0] or 0.0
    base = io.store_path(spark, f"catalog/named/{_tag(d)}")
    path = io.write_csv(o, io.named_sink_path(base, score / 1e5, dt.datetime(2024, 1, 1, 12, 30)))
    return io.read_csv(spark, path, "o_orderkey long, o_totalprice double").withColumn("file", F.lit(path.rsplit("/", 1)[-1]))


