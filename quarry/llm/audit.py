"""Source divergence audit: how each source's term shares differ from its language's and other sources'.

Terms are counted per (lang, source); a language keeps the terms of enough of its documents. A share
is ``1 + floor(10^9 (count + 5) / (N + 5 V))``, in whole numbers throughout.

Terms above the language's share: dominance skyband. A term's excess grows with its count in the
group and falls with its count in the language, whatever N and V are, and ties go to the earlier
term. So a term that ``k`` others match or beat in all three (higher group count, lower language
count, earlier in UTF-8) cannot be among the first k. Each partition keeps the terms dominated by
fewer than k others, skybands of some partitions are merged into one, and what is left is ranked.

Distances between sources: the terms of a language lie in buckets of a bounded number of (term,
source) cells; a bucket is one matrix, from which the sums of absolute differences of all pairs of
sources come row by row; the sums of the buckets are added up. No row is made for a pair and term.

Scale: texts are counted where they are read, so a term costs at most one row a task and group;
one shuffle by (lang, term) gives counts by source and by language. After that only kept terms are
moved. One row holds the sources of a term or of a language, as the result has their pairs anyway.

Defined cases: null text, lang and source are empty strings; a group without kept terms has all its
shares from count 0; a language without kept terms has distances 0; equal rows count as often as
they stand there; an empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import materialize

MIN_DOCS = 30
TOP = 50
SCALE = 1_000_000_000
ADDED = 5
KEYS_AT_ONCE = 300_000
CELLS = 1 << 21
BLOCK = 512
MERGED = 32
#: Letters of ASCII and whatever lies above it; on UTF-8 bytes this is the same, character by character.
TERM = re.compile(rb"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def counts(docs: DataFrame, lang: Column, source: Column, text: Column) -> DataFrame:
    """``lang``, ``term``, ``source``, ``n`` occurrences and ``docs`` documents, several rows a key."""
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict = defaultdict(Counter)
        within: dict = defaultdict(Counter)

        def out() -> Iterator[pa.RecordBatch]:
            for (a, b), c in seen.items():
                terms = list(c)
                yield pa.RecordBatch.from_arrays([pa.array([a] * len(c), pa.string()), pa.array(terms, pa.binary()).cast(pa.string()), pa.array([b] * len(c), pa.string()),
                                                  pa.array(list(c.values()), pa.int64()), pa.array(list(map(within[a, b].__getitem__, terms)), pa.int64())], names=["lang", "term", "source", "n", "docs"])
            seen.clear()
            within.clear()
        held = 0
        for batch in batches:
            for key, body in zip(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()), batch.column(2)):
                found = TERM.findall((body.as_py() or "").encode().lower())
                total = seen[key]
                held -= len(total)
                total.update(found)
                within[key].update(set(found))
                held += len(total)
                if held >= KEYS_AT_ONCE:
                    yield from out()
                    held = 0
        yield from out()
    named = docs.select(F.coalesce(lang, F.lit("")).alias("lang"), F.coalesce(source, F.lit("")).alias("source"), text.alias("text"))
    return named.mapInArrow(counted, "lang string, term string, source string, n long, docs long")


def kept_terms(docs: DataFrame, lang: Column, source: Column, text: Column, min_docs: int) -> DataFrame:
    """``lang``, ``term``, ``lang_n`` and ``cells`` (source, n) of the terms a language keeps."""
    rows = counts(docs, lang, source, text).repartition("lang", "term")  # serves both groupings
    cells = rows.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    terms = cells.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs"), F.collect_list(F.struct("source", "n")).alias("cells"))
    return terms.where(F.col("docs") >= min_docs).drop("docs")


def share(count: Column, total: Column, terms: Column) -> Column:
    """The share in whole numbers; decimals, as the product can pass 64 bits."""
    wide = lambda c: c.cast("decimal(27,0)")
    return F.when(terms > 0, 1 + F.call_function("div", F.lit(SCALE).cast("decimal(10,0)") * wide(count + ADDED), wide(total) + ADDED * terms))


# ---- skybands

def skyband(n: np.ndarray, lang_n: np.ndarray, term: np.ndarray, k: int) -> np.ndarray:
    """Rows dominated by fewer than k others. In the order of (n falling, lang_n, term) all that
    dominate a row stand before it, and of these at least k are themselves in the band if k are."""
    place = np.empty(len(term), np.int64)
    place[np.argsort(term, kind="stable")] = np.arange(len(term))
    order = np.lexsort((place, lang_n, -n))
    a, b = lang_n[order], place[order]
    kept_a, kept_b, out = np.empty(0, a.dtype), np.empty(0, b.dtype), []
    for lo in range(0, len(order), BLOCK):
        x, y = a[lo:lo + BLOCK], b[lo:lo + BLOCK]
        above = ((kept_a[None] <= x[:, None]) & (kept_b[None] < y[:, None])).sum(1)
        above += np.tril((x[None] <= x[:, None]) & (y[None] < y[:, None]), -1).sum(1)
        ok = above < k
        kept_a, kept_b = np.r_[kept_a, x[ok]], np.r_[kept_b, y[ok]]
        out.append(order[lo:lo + BLOCK][ok])
    return np.concatenate(out) if out else order


BAND = "lang string, source string, term string, n long, lang_n long"


def _bands(k: int):
    def kept(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Skyband of each group in this partition, batch after batch."""
        have: dict = {}
        for df in batches:
            for key, g in df.groupby(["lang", "source"], sort=False):
                g = pd.concat([have[key], g]) if key in have else g
                have[key] = g.iloc[skyband(g["n"].to_numpy(), g["lang_n"].to_numpy(), g["term"].to_numpy().astype(object), k)]
            if sum(map(len, have.values())) >= KEYS_AT_ONCE:
                yield from have.values()
                have.clear()
        yield from have.values()
    return kept


def candidates(terms: DataFrame, k: int) -> DataFrame:
    """Terms of each group that k others do not dominate, first by partition, then by ``MERGED`` of them."""
    cells = terms.select("lang", "term", "lang_n", F.explode("cells").alias("c")).select("lang", "c.source", "term", "c.n", "lang_n")
    bands = cells.mapInPandas(_bands(k), BAND).withColumn("part", F.floor(F.spark_partition_id() / MERGED))
    return bands.repartition("lang", "source", "part").drop("part").mapInPandas(_bands(k), BAND)


# ---- distances

def distances(terms: DataFrame, groups: DataFrame) -> DataFrame:
    """``lang``, ``source``, ``item``, ``value``: the summed differences of every two sources of a
    language. ``groups`` has every (lang, source) with its N, the language's V and the number of sources."""
    buckets = F.greatest(F.lit(1), F.ceil(F.col("terms") * F.col("sources") / CELLS)).cast("int")
    sides = groups.withColumn("zero", F.coalesce(share(F.lit(0), F.col("total"), F.col("terms")), F.lit(0)))
    cells = terms.select("lang", "term", F.explode("cells").alias("c")).select("lang", "term", "c.source", "c.n").join(groups, ["lang", "source"])
    left = cells.select("lang", F.pmod(F.xxhash64("term"), buckets).cast("int").alias("bucket"), "term", "source", share(F.col("n"), F.col("total"), F.col("terms")).alias("p"))
    right = sides.select("lang", F.explode(F.sequence(F.lit(0), buckets - 1)).alias("bucket"), "source", "zero")

    def summed(cells: pd.DataFrame, sides: pd.DataFrame) -> pd.DataFrame:
        sides = sides.sort_values("source", ignore_index=True)
        code, terms = pd.factorize(cells["term"])
        p = np.tile(sides["zero"].to_numpy(np.int64), (len(terms), 1))
        p[code, pd.Index(sides["source"]).get_indexer(cells["source"])] = cells["p"].to_numpy(np.int64)
        names = sides["source"].to_numpy()
        rows = []
        for i, name in enumerate(names):
            value = np.abs(p - p[:, [i]]).sum(0)
            other = np.arange(len(names)) != i
            rows.append(pd.DataFrame({"lang": sides["lang"].iloc[0], "source": name, "item": names[other], "value": value[other]}))
        return pd.concat(rows)
    sums = left.groupBy("lang", "bucket").cogroup(right.groupBy("lang", "bucket")).applyInPandas(summed, "lang string, source string, item string, value long")
    return sums.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def audit(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text", min_docs: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """``lang``, ``source``, ``part``, ``item``, ``value``, ``rank``: for each group, the other sources of
    its language by distance (``pair``) and the ``top`` terms above the language's share (``term``)."""
    names = [F.coalesce(F.col(c), F.lit("")).alias(a) for c, a in ((lang, "lang"), (source, "source"))]
    terms = materialize(kept_terms(docs, F.col(lang), F.col(source), F.col(text), min_docs), "audit-terms")
    totals = terms.select("lang", F.explode("cells").alias("c")).groupBy("lang", F.col("c.source").alias("source")).agg(F.sum("c.n").alias("total"))
    by_lang = terms.groupBy("lang").agg(F.sum("lang_n").alias("lang_total"), F.count("*").alias("terms"))
    found = docs.select(*names).distinct()
    groups = found.join(totals, ["lang", "source"], "left").join(by_lang, "lang", "left").join(found.groupBy("lang").agg(F.count("*").alias("sources")), "lang")
    groups = materialize(groups.fillna(0, ["total", "lang_total", "terms"]), "audit-groups")
    first = lambda c: Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), c)
    pair = distances(terms, groups).withColumn("rank", F.row_number().over(first("item")))
    excess = share(F.col("n"), F.col("total"), F.col("terms")) - share(F.col("lang_n"), F.col("lang_total"), F.col("terms"))
    term = candidates(terms, top).join(groups, ["lang", "source"]).select("lang", "source", F.col("term").alias("item"), excess.alias("value")).where("value > 0")
    term = term.withColumn("rank", F.row_number().over(first("item"))).where(F.col("rank") <= top)
    parts = [d.select("lang", "source", F.lit(p).alias("part"), "item", F.col("value").cast("long").alias("value"), "rank") for p, d in (("pair", pair), ("term", term))]
    return parts[0].unionByName(parts[1])
