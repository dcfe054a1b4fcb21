"""Conflict-constrained best-fit packing of documents into bins of a fixed number of words.

Documents longer than a bin are cut: whole bins of their own, and a rest that is packed with the
others. A bin takes at most one piece of a source and one of a duplicate cluster; it carries both
sets as bitmaps. Bins are ordered by what is left in them, and for each piece, longest first, the
search starts at the tightest bin that is large enough and goes on to its successors until one is
compatible; if there is none, a new bin is opened. Equal rows follow each other, and the search of the
next goes on where that of the one before ended, so many of them are placed in one walk.

Scale: documents are dealt by a hash of the record into groups of about ``GROUP_ROWS``; each group
is packed in one task on its own, so neither a hot source nor a large cluster meets in one task,
and a bin never spans groups; rows equal in id and text are spread too, where there are more than a group of them. The cost of cutting into groups is at most a few part-filled bins a group.

Defined cases: a text without words gets one row with no bin (bin null, n_words 0); a null source
is a source of its own; a null cluster conflicts with nothing; ties in size go by id and hash;
repeated rows are packed each; an empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import fresh, n_words, spread_key

CAPACITY = 2048
GROUP_ROWS = 4096

TO_SPACE = {i: " " for i in range(9, 14)}
PLACED = "bin long, slot int, piece int, start long, n_words long"


class Bins:
    """Open bins of one group, ordered by residual words; bitmaps of sources and clusters."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.order: list[tuple[int, int]] = []
        self.sources: list[int] = []
        self.clusters: list[int] = []
        self.count: list[int] = []
        self.last: tuple[int, int, int] | None = None
        self.ended = 0

    def open(self) -> int:
        self.sources.append(0)
        self.clusters.append(0)
        self.count.append(0)
        return len(self.count) - 1

    def place(self, size: int, source: int, cluster: int) -> tuple[int, int]:
        """Bin and slot of a piece; ``source`` and ``cluster`` are single bits (0: none)."""
        order, sources, clusters = self.order, self.sources, self.clusters
        at, left = -1, self.capacity
        # bins that refused a piece refuse the next one that is like it: its search goes on where that one ended
        begin = self.ended if self.last == (size, source, cluster) else bisect_left(order, (size, -1))
        self.last, self.ended = (size, source, cluster), len(order)
        for k in range(begin, len(order)):
            b = order[k][1]
            if not (sources[b] & source or clusters[b] & cluster):
                left, at = order.pop(k)
                self.ended = k
                break
        if at < 0:
            at = self.open()
        sources[at] |= source
        clusters[at] |= cluster
        if left > size:
            insort(order, (left - size, at))
            self.ended += 1  # it has less left than before, so it stands among those already asked, or is new and conflicts
        self.count[at] += 1
        return at, self.count[at] - 1


def pack_group(sizes, sources, clusters, capacity: int) -> Iterator[tuple[int, int | None, int | None, int, int, int]]:
    """(row, bin, slot, piece, start, words) for every piece of the rows, given longest first by
    rest; bins count from 0 within the group."""
    source_bits = [1 << v for v in _codes(sources)]
    cluster_bits = [0 if v is None else 1 << v for v in _codes(clusters, none_is_value=False)]
    bins, rests = Bins(capacity), []
    for r, n in enumerate(sizes):
        if n == 0:
            yield r, None, None, 0, 0, 0
            continue
        whole = n // capacity
        for p in range(whole):
            yield r, bins.open(), 0, p, p * capacity, capacity
        if n % capacity:
            rests.append((n % capacity, r, whole))
    rests.sort(key=lambda x: (-x[0], x[1]))
    for n, r, p in rests:
        b, slot = bins.place(n, source_bits[r], cluster_bits[r])
        yield r, b, slot, p, p * capacity, n


def _codes(values, none_is_value: bool = True) -> list:
    """Values as small integers in order of appearance."""
    seen: dict = {}
    return [None if v is None and not none_is_value else seen.setdefault(v, len(seen)) for v in values]


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", cluster_col: str | None = None,
         capacity: int = CAPACITY, group_rows: int = GROUP_ROWS, with_text: bool = False) -> DataFrame:
    """One row a piece: id, source, bin, slot, piece, start and n_words; with ``with_text`` also the
    piece's words joined by spaces. Without ``cluster_col`` equal texts form a cluster."""
    cluster = F.col(cluster_col).cast("string") if cluster_col else F.md5(F.col(text_col).cast("binary"))
    (group,) = fresh(docs, "_group")
    id_type = docs.schema[id_col].dataType.simpleString()
    whole_ids = id_type in ("tinyint", "smallint", "int", "bigint")  # pandas would make floats of them beside a null
    spread, key, rows = spread_key(docs, F.xxhash64(F.col(id_col), F.col(text_col)), group_rows)
    groups = max(1, -(-rows // group_rows))
    salt = F.pmod(F.col(key), F.lit(groups))
    flat = spread.select(salt.alias(group), (F.col(id_col).cast("string") if whole_ids else F.col(id_col)).alias("id"), F.col(source_col).cast("string").alias("source"), cluster.alias("cluster"),
                       n_words(F.col(text_col)).alias("size"), *([F.col(text_col).alias("text")] if with_text else []))
    schema = f"id {'string' if whole_ids else id_type}, source string, {PLACED}" + (", text string" if with_text else "")

    def packed(key, pdf: pd.DataFrame) -> pd.DataFrame:
        if whole_ids:
            pdf["number"] = pd.array([None if pd.isna(v) else int(v) for v in pdf["id"]], dtype="Int64")
        pdf = pdf.sort_values(["size", "number" if whole_ids else "id", "cluster", "source"], ascending=[False, True, True, True], kind="stable", na_position="last").reset_index(drop=True)
        none = lambda s: [None if pd.isna(v) else v for v in s]
        base = int(key[0]) << 32
        out = [(r, None if b is None else base + b, slot, p, start, n) for r, b, slot, p, start, n in
               pack_group(pdf["size"].tolist(), none(pdf["source"]), none(pdf["cluster"]), capacity)]
        at = [x[0] for x in out]
        got = pd.DataFrame({"id": pdf["id"].iloc[at].reset_index(drop=True), "source": pdf["source"].iloc[at].reset_index(drop=True),
                            "bin": pd.array([x[1] for x in out], dtype="Int64"), "slot": pd.array([x[2] for x in out], dtype="Int32"),
                            "piece": [x[3] for x in out], "start": [x[4] for x in out], "n_words": [x[5] for x in out]})
        if with_text:
            last, parts, text = -1, [], []
            for r, _, _, _, start, n in out:
                if r != last:
                    last, parts = r, split_words(pdf["text"].iloc[r])
                text.append(" ".join(parts[start:start + n]))
            got["text"] = text
        return got

    out = flat.groupBy(group).applyInPandas(packed, schema).withColumn("id", F.col("id").cast(id_type))
    return out.withColumnsRenamed({"id": id_col, "source": source_col})


def split_words(text: str | None) -> list[str]:
    """Words of a text, by the six separators that the library's ``words`` uses."""
    return [w for w in (text or "").translate(TO_SPACE).split(" ") if w]
