"""Mixing sources to target weights by hash thresholds, with DataFrame operations only.

Every document has a fixed hash of its id. A source whose target is below its size takes the
documents with the smallest hashes; a target of f whole passes and a rest takes every document f
times and those below the threshold once more, so the documents of a smaller budget are always
among those of a larger one. The threshold comes from sums of words by source and hash bucket: the
first bucket whose running sum reaches the budget is the boundary; only it is cut into finer
buckets, until it holds a single hash. Documents are then kept by comparing their hash; nothing is
sorted, and a source that holds a third of all rows is only a third of partial sums.

Scale: per level one pass over the narrow (source, size, hash) table, pre-summed before the
shuffle; a source has at most 2**LEVEL_BITS buckets a level. Tables of sources hold one row a source.

Defined cases: null and blank texts have size 0 and take 0; a null source is a source of its own,
after all others; rows with equal ids share a hash and are taken or left together; the boundary
document is taken when that comes nearer to the target than leaving it; an empty table gives no
rows; other columns, whatever their names, pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import fresh, materialize, n_words

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MAX_REPEATS = 2.0
LEVEL_BITS = 12
HASH_BITS = 60


def doc_hash(doc_id: Column) -> Column:
    """60 bits of the md5 of the id as text."""
    digest = F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))
    return F.conv(F.substring(digest, 1, HASH_BITS // 4), 16, 10).cast("long")


def targets(by_source: DataFrame, weights: tuple[float, ...], share: float, cap: float) -> DataFrame:
    """(source, source_size, target): ``share`` of all words dealt by weight; a source stops at
    ``cap`` times its size and the excess goes to the others by weight, until none is above.

    Filling in the order of cap by weight gives the same end as resharing round by round. The
    windows run over one row a source.
    """
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ranked = by_source.withColumn("i", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.col("i") % len(weights) + 1).cast("int"))
    ranked = ranked.withColumn("w", w).withColumn("most", F.col("source_size") * F.lit(float(cap)))
    order = Window.orderBy(F.col("most") / F.col("w"), "i")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    left = (F.sum("source_size").over(everything) * F.lit(float(share)) - F.coalesce(F.sum("most").over(before), F.lit(0.0)))
    weight_left = F.sum("w").over(order.rowsBetween(0, Window.unboundedFollowing))
    level = ranked.withColumn("level", left / weight_left)
    open_level = F.min(F.when(F.col("most") > F.col("level") * F.col("w"), F.struct(F.col("most") / F.col("w"), F.col("i"), F.col("level")))).over(everything)["level"]
    return level.withColumn("open", open_level).select(
        "source", "source_size", F.when(F.col("open").isNull(), F.col("most")).otherwise(F.least(F.col("most"), F.col("open") * F.col("w"))).alias("target"))


def thresholds(sized: DataFrame, plan: DataFrame) -> DataFrame:
    """(source, source_size, target, passes, max_hash): take every document ``passes`` times and
    those with a hash up to ``max_hash`` once more. ``sized`` has source, size and h."""
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    state = materialize(plan.withColumn("passes", passes).select(
        "source", "source_size", "target", "passes", (F.col("target") - F.col("passes") * F.col("source_size")).alias("rest"),
        F.lit(0).cast("long").alias("cell"), F.lit(0.0).alias("before")), "mix-plan")
    keep = ["source", "source_size", "target", "passes", "rest"]
    found = None
    for shift in range(HASH_BITS - LEVEL_BITS, -1, -LEVEL_BITS):
        s = state.alias("s")
        inside = sized.alias("d").join(s, F.col("d.source").eqNullSafe(F.col("s.source")) & (F.shiftright("d.h", shift + LEVEL_BITS) == F.col("s.cell")) & (F.col("s.rest") > 0))
        sums = inside.groupBy("s.source", F.shiftright("d.h", shift).alias("sub")).agg(F.sum("d.size").alias("cell_size"), F.min("d.h").alias("lo"), F.max("d.h").alias("hi"))
        running = sums.withColumn("upto", F.sum("cell_size").over(Window.partitionBy("source").orderBy("sub").rowsBetween(Window.unboundedPreceding, 0)))
        c = running.alias("c")
        reached = c.join(s, F.col("c.source").eqNullSafe(F.col("s.source"))).where(F.col("s.before") + F.col("c.upto") >= F.col("s.rest"))
        first = reached.groupBy(*[F.col(f"s.{k}") for k in keep]).agg(F.min(F.struct(
            F.col("c.sub"), (F.col("s.before") + F.col("c.upto") - F.col("c.cell_size")).alias("before"), "c.cell_size", "c.lo", "c.hi")).alias("m"))
        level = materialize(first.select(*keep, F.col("m.sub").alias("cell"), "m.before", "m.cell_size", "m.lo", "m.hi"), "mix-level")
        done = (F.col("lo") == F.col("hi")) | F.lit(shift == 0)
        ends = level.where(done).select("source", F.when(F.col("rest") - F.col("before") >= F.col("cell_size") / 2, F.col("hi")).otherwise(F.col("lo") - 1).alias("max_hash"))
        found = ends if found is None else found.unionByName(ends)
        state = level.where(~done).select(*keep, "cell", "before")
        if state.isEmpty():
            break
    p, f = plan.withColumn("passes", passes).alias("p"), found.alias("f")
    return p.join(f, F.col("p.source").eqNullSafe(F.col("f.source")), "left").select("p.*", F.coalesce(F.col("f.max_hash"), F.lit(-1)).alias("max_hash"))


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[float, ...] = WEIGHTS,
          share: float = SHARE, cap: float = MAX_REPEATS, as_col: str = "mix", keep_text: bool = True) -> DataFrame:
    """``docs`` (without the text, if ``keep_text`` is off) and one struct column: size,
    source_size, target, copies (how often the mix takes the document) and taken (its words)."""
    (x,) = fresh(docs, "_mix")
    rest = [c for c in docs.columns if keep_text or c != text_col]
    mine = F.struct(F.col(source_col).alias("source"), n_words(F.col(text_col)).alias("size"), doc_hash(F.col(id_col)).alias("h")).alias(x)
    narrow = materialize(docs.select(mine) if keep_text else docs.select(*[f"`{c}`" for c in rest], mine), "mix-sizes")
    sized = narrow.select(f"{x}.*")
    by_source = materialize(sized.groupBy("source").agg(F.sum("size").alias("source_size")), "mix-sources")
    limits = materialize(thresholds(sized, targets(by_source, weights, share, cap)), "mix-limits").select(F.struct("*").alias(f"{x}l"))
    all_docs = docs.withColumn(x, mine) if keep_text else narrow
    joined = all_docs.join(limits, F.col(f"{x}.source").eqNullSafe(F.col(f"{x}l.source")))
    copies = F.col(f"{x}l.passes") + (F.col(f"{x}.h") <= F.col(f"{x}l.max_hash")).cast("long")
    return joined.select(*[f"`{c}`" for c in rest], F.struct(
        F.col(f"{x}.size").alias("size"), F.col(f"{x}l.source_size").alias("source_size"), F.col(f"{x}l.target").alias("target"),
        copies.alias("copies"), (copies * F.col(f"{x}.size")).alias("taken")).alias(as_col))


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mixed table itself: each document as often as the mix takes it."""
    (m,) = fresh(docs, "_take")
    every = F.explode(F.array_repeat(F.lit(0), F.col(f"{m}.copies").cast("int")))
    return mixed(docs, as_col=m, **options).withColumn(m, every).drop(m)
