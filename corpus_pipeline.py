"""The corpus pipeline: quality rules, near-duplicates, repeated passages, source mixing, packing.

``STAGES`` are applied in order, each to the written rows of the one before it. All but the last
return the columns of ``documents``; the last returns the packed pieces with their text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quarry.llm import mixing, neardup, packing, quality, repeats
from quarry.llm.common import materialize
from quarry.sources.tables import table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules, without their failing lines."""
    return quality.clean(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates."""
    return neardup.deduplicate(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words of passages that stand in an earlier document too."""
    return repeats.remove(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the target weights of the sources take it."""
    return mixing.mix(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bins of 2048 words, one row a piece, with its words."""
    return packing.pack(docs, with_text=True)


STAGES = [("quality_rules", quality_rules), ("near_duplicates", near_duplicates), ("repeated_passages", repeated_passages),
          ("source_mix", source_mix), ("packing", packed)]

#: Near-duplicate classes come from hash signatures and exact checks, and bins from a greedy search:
#: neither is SQL; the stages are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
