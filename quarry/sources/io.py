"""Sources and sinks: CSV with schemas, encodings and null tokens, named Parquet
stores, file listings, labels from paths, nested documents, feature caches, CSV sinks.

Scans take an explicit schema (inference only for exploration); column selection and filters
applied afterwards reach the file scan. Stage tables go to a folder under the shared
``spark.checkpoint.dir`` named by the caller.
"""

from __future__ import annotations

import datetime as dt
import os
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.session import stage_path


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None, header: bool = True,
             encoding: str | None = None, null_token: str | None = None, sep: str = ",",
             timestamp_format: str | None = None, multi_line: bool = False) -> DataFrame:
    """CSV scan. ``schema`` None reads every column as text (no inference pass);
    ``multi_line`` for quoted fields holding line breaks."""
    r = spark.read.option("header", header).option("sep", sep).option("mode", "PERMISSIVE")
    if multi_line:
        r = r.option("multiLine", True)
    if encoding:
        r = r.option("encoding", encoding)
    if null_token is not None:
        r = r.option("nullValue", null_token)
    if timestamp_format:
        r = r.option("timestampNTZFormat", timestamp_format).option("timestampFormat", timestamp_format)
    if schema is not None:
        r = r.schema(schema)
    return r.csv(path)


def null_tokens(df: DataFrame, cols: Sequence[str] | None = None, tokens: Sequence[str] = ("", "NA")) -> DataFrame:
    """Text cells that are a missing-value token after trimming become null."""
    cols = set(cols or [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)])
    return df.select(*[F.when(F.trim(F.col(c)).isin(list(tokens)), None).otherwise(F.col(c)).alias(c) if c in cols else F.col(c)
                       for c in df.columns])


def retype(df: DataFrame, types: dict[str, str], lenient: bool = True) -> DataFrame:
    """Per-column type overrides; lenient casts turn bad text into null."""
    return df.select(*[(F.col(c).try_cast(types[c]) if lenient else F.col(c).cast(types[c])).alias(c) if c in types else F.col(c)
                       for c in df.columns])


def first_rows(df: DataFrame, n: int, order: Sequence) -> DataFrame:
    """The first n rows in an explicit order (a bounded top-n, not file order)."""
    return df.orderBy(*order).limit(n)


def write_csv(df: DataFrame, path: str, gzip: bool = False, encoding: str | None = None, null_token: str | None = None,
              timestamp_format: str = "yyyy-MM-dd HH:mm:ss") -> str:
    w = (df.write.mode("overwrite").option("header", True).option("timestampNTZFormat", timestamp_format)
         .option("timestampFormat", timestamp_format))
    if gzip:
        w = w.option("compression", "gzip")
    if encoding:
        w = w.option("encoding", encoding)
    if null_token is not None:
        w = w.option("nullValue", null_token)
    w.csv(path)
    return path


def store_path(spark: SparkSession, name: str) -> str:
    return stage_path(spark, name)


def write_store(df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> str:
    """Write a named Parquet table into the shared stage folder; returns its path."""
    path = store_path(df.sparkSession, name)
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def read_store(spark: SparkSession, name: str) -> DataFrame:
    return spark.read.parquet(store_path(spark, name))


def transform_in_chunks(df: DataFrame, fn, name: str, max_partition_bytes: str | None = None) -> DataFrame:
    """One partitioned scan -> transform -> Parquet stage, read back. Spark's input splits play
    the role of chunks (``spark.sql.files.maxPartitionBytes`` sets their size); statistics
    inside ``fn`` are table-wide, not per chunk."""
    spark = df.sparkSession
    if max_partition_bytes:
        spark.conf.set("spark.sql.files.maxPartitionBytes", max_partition_bytes)
    write_store(fn(df), name)
    return read_store(spark, name)


def list_files(spark: SparkSession, root: str, suffix: str) -> DataFrame:
    """(path, length) of every file under ``root`` ending in ``suffix``, recursively, sorted by
    path. Only file metadata is read (the content column is never selected)."""
    df = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", f"*{suffix}")
          .load(root))
    return df.select("path", "length").orderBy("path")


def base_name(path: Column | str, strip_suffix: bool = True) -> Column:
    """File base name of a path or URL (query and fragment removed, suffix optional)."""
    p = F.col(path) if isinstance(path, str) else path
    p = F.regexp_replace(p, r"[?#].*$", "")
    name = F.regexp_extract(p, r"([^/]*)$", 1)
    return F.regexp_replace(name, r"\.[^.]*$", "") if strip_suffix else name


def char_class(name: Column | str, pos_from_end: int = 5) -> Column:
    """One character of a file name counted from its end (``name[-5]``), e.g. a class digit."""
    c = F.col(name) if isinstance(name, str) else name
    return F.substring(c, -pos_from_end, 1)


def explode_items(docs: DataFrame, key: str, items: str, with_position: bool = True) -> DataFrame:
    """Nested documents -> one row per embedded item (struct fields become columns)."""
    if with_position:
        e = docs.select(key, F.posexplode(items).alias("item_pos", "__it"))
        return e.select(key, "item_pos", "__it.*")
    return docs.select(key, F.explode(items).alias("__it")).select(key, "__it.*")


def cache_features(df: DataFrame, name: str) -> DataFrame:
    """Persist computed features as a Parquet stage and continue from the stored copy (a lineage
    cut that survives executor loss)."""
    write_store(df, name)
    return read_store(df.sparkSession, name)


def named_sink_path(base: str, score: float, stamp: dt.datetime | None = None, prefix: str = "submission") -> str:
    """Output name holding the score rounded to 6 places and a minute time stamp."""
    stamp = stamp or dt.datetime.now(dt.timezone.utc)
    return os.path.join(base, f"{prefix}_{score:.6f}_{stamp.strftime('%Y-%m-%d-%H-%M')}")
