"""Substring dedup by seed and extend: words in long passages that occurred before are removed.

Seeds: every 20-word window has an anchor, the 6-word sequence of smallest hash in it, which depends
on the window's words only, so equal windows have equal anchors at equal places. Winnowed anchors
(about one in eight words) are grouped over all documents; those that occur once are done with.

Extension: around an anchor that occurs again, the windows it stands for reach up to 14 words to
both sides. Each of them is compared with the windows that share the anchor, by the hash of its 20
words; all but the earliest occurrence (smaller doc_id, then earlier start) are repeats.
Neighbouring repeats join into maximal ones, and their words are removed. Windows are judged on the
input, not on what is left.

Scale: a task sends each anchor and each window once, however often it met it, so the rows of a
passage that stands in a third of all documents are as many as there are tasks; grouping is a sort
within partitions that is read as a stream, so no group is held in memory. Later copies of a whole
text lose all their words by the group of their digest, and do not take part any further. Texts are
not moved to find windows or to cut them: the places of the anchors that came again, and then the cuts,
are written by ranges of ids and looked up by the tasks that scan the texts, one search a document,
whatever the order of the ids.

Defined cases: null and blank texts and texts under 20 words lose nothing; every row is a document
of its own; null ids come after all others, and rows that share an id (or have none) come in the
order of a hash of their text, equal texts as they stand in the table, so of equal rows the first
keeps its words; an empty table gives no rows; other columns pass through. Sequences are compared
by 64-bit hashes; a file of places that is not there any more is an error.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import fresh, let, materialize, words
from quarry.llm.files import map_array, write_array
from quarry.llm.hashing import mix64, sequence_hashes, word_hashes
from quarry.session import stage_path

WINDOW = 20
ANCHOR = 6
LAST_ID = (1 << 63) - 1
END = (1 << 31) - 1
FILE_PLACES = 4 << 20
_OCCURRENCE = "settled boolean, key long, id long, pos int"


def anchor_of_windows(h: np.ndarray, window: int = WINDOW, anchor: int = ANCHOR) -> np.ndarray:
    """For each window start the place of its anchor: the leftmost smallest sequence hash in it."""
    g = sequence_hashes(h, anchor)
    per = window - anchor + 1
    if len(g) < per:
        return np.empty(0, np.int64)
    return np.lib.stride_tricks.sliding_window_view(g, per).argmin(axis=1) + np.arange(len(g) - per + 1)


def _occurrences(key: np.ndarray, ident: np.ndarray, pos: np.ndarray, first_too: bool) -> pa.RecordBatch:
    """One open row for each key of the task, its earliest occurrence; the others are settled
    here as repeats (with ``first_too`` also the earliest of a key that came again)."""
    order = np.lexsort((pos, ident, key))
    key, ident, pos = key[order], ident[order], pos[order]
    head = np.r_[True, key[1:] != key[:-1]] if len(key) else np.empty(0, bool)
    start = np.flatnonzero(head)[np.cumsum(head) - 1] if len(key) else np.empty(0, np.int64)
    later = (ident != ident[start]) | (pos != pos[start])
    settled = later
    if first_too:
        again = np.zeros(len(key), bool)
        again[start[later]] = True
        settled = later | again
    spread = mix64(ident[settled].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + pos[settled].astype(np.uint64))
    return pa.RecordBatch.from_arrays([
        pa.array(np.r_[np.zeros(int(head.sum()), bool), np.ones(int(settled.sum()), bool)]),
        pa.array(np.r_[key[head], spread].view(np.int64)), pa.array(np.r_[ident[head], ident[settled]]),
        pa.array(np.r_[pos[head], pos[settled]].astype(np.int32))], ["settled", "key", "id", "pos"])


def anchors(texts: DataFrame) -> DataFrame:
    """Anchor occurrences of (id, text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, ids, places = [np.empty(0, np.uint64)], [np.empty(0, np.int64)], [np.empty(0, np.int64)]
            for i, text in zip(b.column(0).to_pylist(), b.column(1)):
                h = word_hashes(text.as_py())
                p = anchor_of_windows(h)  # ascending
                if len(p):
                    p = p[np.r_[True, p[1:] != p[:-1]]]
                    keys.append(sequence_hashes(h, ANCHOR, p))
                    ids.append(np.full(len(p), i, np.int64))
                    places.append(p)
            yield _occurrences(np.concatenate(keys), np.concatenate(ids), np.concatenate(places), True)

    return texts.mapInArrow(run, _OCCURRENCE)


def places_written(places: DataFrame, folder: str) -> np.ndarray:
    """Write the places (id, at) into files by ranges of ids, each one array: number of rows, ids in order,
    ends of their places, places. Returns the lowest id of each file, ascending; it names the file."""
    total = places.select(F.sum(F.size("at") + 2)).first()[0] or 0

    def save(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, sizes, values = [], [], []
        for b in batches:
            ids.append(b.column(0).to_numpy())
            sizes.append(pc.list_value_length(b.column(1)).to_numpy())
            values.append(b.column(1).flatten().to_numpy())
        ids = np.concatenate([np.empty(0, np.int64), *ids])
        if len(ids):
            write_array(folder, f"{ids[0]}.npy", np.concatenate([[len(ids)], ids, np.cumsum(np.concatenate(sizes)), *values]).astype(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(ids[:1])], ["low"])

    ranges = places.select("id", "at").repartitionByRange(max(1, -(-int(total) // FILE_PLACES)), "id").sortWithinPartitions("id")
    return np.sort(np.array([r["low"] for r in ranges.mapInArrow(save, "low long").collect()], np.int64))


@lru_cache(16)
def _file(folder: str, low: int) -> np.ndarray:
    return map_array(folder, f"{low}.npy")


def places_of(folder: str, lows: np.ndarray, ids: np.ndarray) -> dict[int, np.ndarray]:
    """The places of those rows of ``ids`` that have some, by row. Files are mapped; only those that hold
    ids of the range are opened, and a row takes one binary search."""
    out, file = {}, np.searchsorted(lows, ids, side="right") - 1
    for f in np.unique(file[file >= 0]).tolist():
        a, rows = _file(folder, int(lows[f])), np.flatnonzero(file == f)
        n = int(a[0])
        keys, ends = a[1:n + 1], a[n + 1:2 * n + 1]
        k = np.minimum(np.searchsorted(keys, ids[rows]), n - 1)
        hit = keys[k] == ids[rows]
        for i, j in zip(rows[hit].tolist(), k[hit].tolist()):
            out[i] = a[2 * n + 1 + (int(ends[j - 1]) if j else 0):2 * n + 1 + int(ends[j])]
    return out


def cuts_of(folder: str, lows: np.ndarray) -> Callable[[Column], Column]:
    """The cuts of each id from files of ``places_written`` that hold their starts and ends in turn, null
    without any. Not deterministic for the optimizer, so that it is looked up once a row."""
    @F.arrow_udf("array<struct<s:int,e:int>>")
    def cuts(ids: pa.Array) -> pa.Array:
        found = places_of(folder, lows, ids.to_numpy())
        sizes = np.zeros(len(ids), np.int64)
        sizes[list(found)] = [len(a) // 2 for a in found.values()]
        rows = np.concatenate([np.empty(0, np.int64), *(found[i] for i in sorted(found))]).reshape(-1, 2).astype(np.int32)
        structs = pa.StructArray.from_arrays([pa.array(rows[:, 0]), pa.array(rows[:, 1])], ["s", "e"])
        ends = np.r_[0, np.cumsum(sizes)].astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(ends, mask=np.r_[sizes == 0, False]), structs)

    return cuts.asNondeterministic()


def windows(texts: DataFrame, folder: str, lows: np.ndarray) -> DataFrame:
    """Occurrences of the windows whose anchors came again, from (id, text) and the files of places."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, ids, starts = [np.empty(0, np.uint64)], [np.empty(0, np.int64)], [np.empty(0, np.int64)]
            ident = b.column(0).to_numpy()
            for i, at in places_of(folder, lows, ident).items():
                h = word_hashes(b.column(1)[i].as_py())
                again = np.zeros(len(h), bool)
                again[at] = True
                p = np.flatnonzero(again[anchor_of_windows(h)])
                keys.append(sequence_hashes(h, WINDOW, p))
                ids.append(np.full(len(p), ident[i], np.int64))
                starts.append(p)
            yield _occurrences(np.concatenate(keys), np.concatenate(ids), np.concatenate(starts), False)

    return texts.mapInArrow(run, _OCCURRENCE)


def grouped(occurrences: DataFrame, repeats: Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray]) -> DataFrame:
    """(id, pos) of settled rows and of the open rows that ``repeats`` picks from whole runs of
    equal keys. Partitions are sorted by key and read as a stream; a run is as long as there are
    tasks at most, and only the run at the end of a batch waits for the next."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.empty(0, np.int64)] * 3

        def out(cols: list[np.ndarray]) -> pa.RecordBatch:
            pick = repeats(*cols)
            return pa.RecordBatch.from_arrays([pa.array(cols[1][pick]), pa.array(cols[2][pick].astype(np.int32))], ["id", "pos"])

        for b in batches:
            done = b.column(0).to_numpy(zero_copy_only=False)
            ident, pos = b.column(2).to_numpy(), b.column(3).to_numpy()
            yield pa.RecordBatch.from_arrays([pa.array(ident[done]), pa.array(pos[done])], ["id", "pos"])
            cols = [np.concatenate([x, y[~done]]) for x, y in zip(held, (b.column(1).to_numpy(), ident, pos))]
            cut = int(np.searchsorted(cols[0], cols[0][-1])) if len(cols[0]) else 0
            yield out([c[:cut] for c in cols])
            held = [c[cut:] for c in cols]
        yield out(held)

    return occurrences.repartition("key").sortWithinPartitions("key", "id", "pos").mapInArrow(run, "id long, pos int")


def _met_again(key: np.ndarray, ident: np.ndarray, pos: np.ndarray) -> np.ndarray:
    same = key[1:] == key[:-1]
    return np.r_[False, same] | np.r_[same, False] if len(key) else np.empty(0, bool)


def _after_first(key: np.ndarray, ident: np.ndarray, pos: np.ndarray) -> np.ndarray:
    if not len(key):
        return np.empty(0, bool)
    head = np.r_[True, key[1:] != key[:-1]]
    start = np.flatnonzero(head)[np.cumsum(head) - 1]
    return (ident != ident[start]) | (pos != pos[start])


def _merged(starts: np.ndarray) -> list[dict]:
    """Maximal runs of words covered by windows at the starts."""
    s = np.unique(starts).astype(np.int64)
    gap = np.flatnonzero(s[1:] > s[:-1] + WINDOW) + 1
    return [{"s": int(a), "e": int(b) + WINDOW} for a, b in zip(s[np.r_[0, gap]], s[np.r_[gap - 1, len(s) - 1]])]


def identified(docs: DataFrame, id_col: str, text_col: str, as_col: str) -> DataFrame:
    """``docs`` with a number of its own for each row, in the order of the ids, null last. Where no two
    rows share an id that is the id; else the rows are sorted by id, text and place, and written."""
    ident = F.coalesce(F.col(id_col).cast("long"), F.lit(LAST_ID))
    if docs.groupBy(ident.alias(as_col)).count().where("count > 1").isEmpty():
        return docs.withColumn(as_col, ident)
    (place,) = fresh(docs, "_place")
    order = [F.col(id_col).cast("long").asc_nulls_last(), F.xxhash64(F.col(text_col)), F.col(place)]
    rows = docs.withColumn(place, F.monotonically_increasing_id()).orderBy(*order)
    return materialize(rows.withColumn(as_col, F.monotonically_increasing_id()).drop(place), "rep-rows")


def repeated(docs: DataFrame, ident_col: str, text_col: str = "text") -> DataFrame:
    """(id, cuts): for each row with repeats, by its number, the word ranges to remove, in order."""
    ident = F.col(ident_col)
    texts = docs.select(ident.alias("id"), F.col(text_col).cast("binary").alias("text"))
    digest = let(words(F.col(text_col)), lambda w: F.when(F.size(w) >= WINDOW, F.md5(F.array_join(w, " ").cast("binary"))))
    digests = docs.select(ident.alias("id"), digest.alias("digest")).where("digest is not null")
    first = digests.groupBy("digest").agg(F.min("id").alias("first"), F.max("id").alias("last")).where("first < last")
    copies = materialize(digests.join(first, "digest").where("id > first").select("id").distinct(), "rep-copies")
    places = grouped(anchors(texts), _met_again).join(copies, "id", "left_anti").groupBy("id").agg(F.collect_set("pos").alias("at"))
    folder = stage_path(docs.sparkSession, f"llm-rep-places-{uuid.uuid4().hex[:12]}")
    lows = places_written(materialize(places, "rep-anchors"), folder)
    found = grouped(windows(texts, folder, lows), _after_first).groupBy("id").agg(F.collect_list("pos").alias("pos"))
    cuts = "id long, cuts array<struct<s:int,e:int>>"

    def merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"id": pdf["id"], "cuts": [_merged(np.asarray(p)) for p in pdf["pos"]]})

    whole = copies.select("id", F.array(F.struct(F.lit(0).alias("s"), F.lit(END).alias("e"))).alias("cuts"))
    return materialize(found.mapInPandas(merge, cuts).unionByName(whole), "rep-cuts")


def cut_words(w: Column, cuts: Column) -> Column:
    """The words outside the ranges, in order."""
    def kept(c: Column) -> Column:
        lo = lambda k: F.when(k == 0, 0).otherwise(F.least(F.get(c, k - 1)["e"], F.size(w)))
        hi = lambda k: F.when(k == F.size(c), F.size(w)).otherwise(F.get(c, k)["s"])
        return F.flatten(F.transform(F.sequence(F.lit(0), F.size(c)), lambda k: F.slice(w, lo(k) + 1, F.greatest(F.lit(0), hi(k) - lo(k)))))
    return F.when(cuts.isNull() | (F.size(cuts) == 0), w).otherwise(let(cuts, kept))


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", as_col: str = "repeats") -> DataFrame:
    """``docs`` with one struct column: n_words, n_removed and the kept words joined by a space."""
    own, cuts, out = fresh(docs, "_own", "_cuts", as_col)
    numbered = identified(docs, id_col, text_col, own)
    ends = F.flatten(F.transform("cuts", lambda c: F.array(c["s"], c["e"])))
    folder = stage_path(docs.sparkSession, f"llm-rep-cuts-{uuid.uuid4().hex[:12]}")
    lows = places_written(repeated(numbered, own, text_col).select("id", ends.alias("at")), folder)
    df = numbered.withColumn(cuts, cuts_of(folder, lows)(F.col(own)))
    both = let(words(F.col(text_col)), lambda w: let(cut_words(w, F.col(cuts)), lambda k: F.struct(
        F.size(w).cast("long").alias("n_words"), (F.size(w) - F.size(k)).cast("long").alias("n_removed"), F.array_join(k, " ").alias("kept"))))
    return df.withColumn(out, both).drop(own, cuts)


def remove(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the repeated words. Texts that lose none stay as they are; a document that
    loses all its words goes."""
    (r,) = fresh(docs, "_rep")
    df = deduplicated(docs, id_col, text_col, r).where((F.col(f"{r}.n_removed") == 0) | (F.col(f"{r}.n_removed") < F.col(f"{r}.n_words")))
    lost = F.col(f"{r}.n_removed") > 0
    df = df.withColumn(text_col, F.when(lost, F.col(f"{r}.kept")).otherwise(F.col(text_col)))
    if "n_chars" in docs.columns:
        df = df.withColumn("n_chars", F.when(lost, F.char_length(text_col)).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return df.select(*[f"`{c}`" for c in docs.columns])
