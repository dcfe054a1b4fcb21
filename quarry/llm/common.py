"""Helpers shared by the operators: words of a text, local names inside expressions, stage tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.session import stage_path

#: What separates words: space and the five control characters from tab to carriage return.
SPACES = r"[\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    """Words of a text in order, as an array; null and blank texts have none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACES), lambda w: w != "")


def n_words(text: Column) -> Column:
    return F.size(F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACES), "")).cast("long")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over ``value``, which is computed once however often ``body`` names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into a fresh folder under the shared checkpoint folder and read it
    back: later steps start from files that every executor can read, whichever executor is lost."""
    return materialized(df, name)[0]


def materialized(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``materialize`` and the folder, for a caller that gives it to ``dropped`` after use."""
    path = stage_path(df.sparkSession, f"llm-{name}-{uuid.uuid4().hex[:12]}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def spread_key(docs: DataFrame, key: Column, limit: int) -> tuple[DataFrame, str, int]:
    """``docs`` with the hash ``key`` as a column, its name, and the number of rows. Where more than
    ``limit`` rows have one key, as repeated rows do, each gets a key of its own from it and from its
    place in the table; these places are written first, so that no rerun sees others."""
    k, n, again, at = fresh(docs, "_key", "_n", "_again", "_at")
    counts = docs.select(key.alias(k)).groupBy(k).agg(F.count("*").alias(n))
    rows, most = counts.agg(F.sum(n), F.max(n)).first()
    if (most or 0) <= limit:
        return docs.withColumn(k, key), k, rows or 0
    hot = counts.where(F.col(n) > limit).select(F.col(k).alias(again))
    hot = F.broadcast(hot) if rows // limit <= 100_000 or hot.count() <= 100_000 else hot
    df = docs.withColumn(k, key).withColumn(at, F.monotonically_increasing_id()).join(hot, F.col(k) == F.col(again), "left")
    df = df.withColumn(k, F.when(F.col(again).isNotNull(), F.xxhash64(k, at)).otherwise(F.col(k))).drop(again, at)
    return materialize(df, "spread"), k, rows


def dropped(df: DataFrame, path: str | None) -> None:
    """Delete the folder of a stage whose successor is written whole, so nothing reads it again."""
    if path is not None:
        at = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(at, True)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """``names``, each lengthened by underscores until no column of ``df`` has it."""
    have, out = {c.lower() for c in df.columns}, []
    for n in names:
        while n.lower() in have:
            n += "_"
        have.add(n.lower())
        out.append(n)
    return out
