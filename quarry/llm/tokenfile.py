"""Token ids as canonical Huffman files: length-limited codes from global counts, independent blocks.

The ids of every document are coded with one canonical code of at most 16 bits, made from the
counts over all documents. A document starts at a byte; within it every ``BLOCK`` ids a checkpoint
holds the bit offset, so blocks are decoded independently, all blocks of a file in lockstep through
one table of 2**16 entries.

File: ``CHUF0001``; counts of documents, ids, checkpoints and symbols (u64 each); code lengths (u8
a symbol); per document id (i64, with a flag byte for null), number of ids and byte offset (u64);
checkpoints (u32 bit offsets from the document's start); the coded bytes.

Scale: texts are encoded once and kept as id arrays; ids are coded before they are moved, and only
the coded documents are shuffled, by ranges of doc_id, one range a file. What reaches the driver
is bounded by the vocabulary (counts) and the number of files (totals).

Defined cases: a null text is an empty one (only the end id); rows with equal doc_id follow each
other, ties by the crc of their ids; a null doc_id comes after all others; an empty table writes no
file and gives no rows; a file that was written and is not there any more is an error when reading;
other columns are not looked at.
"""

from __future__ import annotations

import gc
import os
import re
import struct
import zlib
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import materialize
from quarry.llm.files import write_bytes

END_ID = 2
MAX_BITS = 16
BLOCK = 1024
FILE_TEXT_BYTES = 32 << 20
CACHE_PIECES = 800_000
PIECES_AT_ONCE = 4000
PIECES_A_ROW = 50
SPACE_MARK = "\u0120"  # how byte-level vocabularies write a space
SLICE_CHARS = 4 << 20
SLICE_IDS = 1 << 20
MAGIC = b"CHUF0001"
#: A text with a piece that is empty, touches other white space or holds the special token is
#: encoded whole; others are cut before each space, where the vocabulary's pattern cuts too.
SPECIAL = "<|endoftext|>"
#: Stands for the ids of a piece whose text is encoded whole; no list of ids has one byte.
ODD = b"\0"
NAMES = ["part", "doc_id", "ids", "counts"]
#: Latin letters, then marks: the vocabulary's pattern always cuts between them.
MARKS = ".,;:!?$#*%&"
MARKED = re.compile(r"([A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u024F]+)([.,;:!?$#*%&]+)").fullmatch

_state: dict = {}


def _tokenizer(path: str):
    """The tokenizer, which of its tokens start with a space, and the pieces known so far, behind a
    space and at the start of a text."""
    if _state.get("path") != path:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks are the parallel unit
        from tokenizers import Tokenizer
        tok = Tokenizer.from_file(path)
        spaced = np.array([(tok.id_to_token(i) or "").startswith(SPACE_MARK) for i in range(tok.get_vocab_size())])
        _state.update(path=path, tok=tok, spaced=spaced, seen={}, first={})
    return _state["tok"], _state["spaced"], _state["seen"], _state["first"]


def encode_texts(path: str, texts: pa.StringArray) -> list[np.ndarray]:
    """Ids of each text."""
    flat, sizes = encode_flat(path, texts)
    return np.split(flat, np.cumsum(sizes)[:-1]) if len(sizes) else []


@contextmanager
def no_cycle_search() -> Iterator[None]:
    """No searches for cyclic garbage in the block: it makes hundreds of thousands of small objects, without cycles."""
    on = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if on:
            gc.enable()


@no_cycle_search()
def encode_flat(path: str, texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts one after the other, and the number of each text's ids. The distinct words
    behind a lone space are encoded once, many at a time, and remembered (a bounded number of them), and
    so are the words that texts begin with; this is exact, as the vocabulary's pattern cuts before such a
    space, so a word's ids start at the only token of it that starts with a space. The pattern also
    cuts marks off the letters before them, so those are encoded apart and joined."""
    tok, spaced, seen, first = _tokenizer(path)
    if len(seen) + len(first) > CACHE_PIECES:
        seen.clear()
        first.clear()
    pieces = pc.split_pattern(texts, " ")
    coded = pieces.flatten().dictionary_encode()
    code, names = coded.indices.to_numpy(), coded.dictionary.to_numpy(zero_copy_only=False).tolist()
    size = pc.list_value_length(pieces).to_numpy()
    at = np.cumsum(size) - size
    later = np.ones(len(code), bool)
    later[at] = False
    used = np.zeros(len(names), bool)
    used[code[later]] = True
    known = list(map(seen.get, names))
    missing = [i for i in np.flatnonzero(used).tolist() if known[i] is None]
    new = [names[i] for i in missing]
    seen.update((p, ODD) for p in new if p.strip() != p or not p or SPECIAL in p)
    marked = {p: m.groups() for p in new if p[-1:] in MARKS and (m := MARKED(p))}
    apart = [p for p in new if p not in seen and p not in marked]
    apart += {h for h, _ in marked.values()}.difference(seen, apart)
    for lo in range(0, len(apart), PIECES_AT_ONCE):
        some = apart[lo:lo + PIECES_AT_ONCE]
        rows = tok.encode_batch_fast([" " + " ".join(some[i:i + PIECES_A_ROW]) for i in range(0, len(some), PIECES_A_ROW)], add_special_tokens=False)
        ids = np.array([i for r in rows for i in r.ids], np.uint32)
        cut = np.append(np.flatnonzero(spaced[ids]), len(ids)) * 4
        raw = ids.tobytes()
        seen.update(zip(some, map(raw.__getitem__, map(slice, cut[:-1].tolist(), cut[1:].tolist()))))
    marks = {m: np.array(tok.encode(m, add_special_tokens=False).ids, np.uint32).tobytes() for m in {m for _, m in marked.values()}}
    seen.update((p, seen[h] + marks[m]) for p, (h, m) in marked.items())
    for i, p in zip(missing, new):
        known[i] = seen[p]
    is_odd = np.fromiter((k is ODD for k in known), bool, len(known))
    known = [b"" if k is None or k is ODD else k for k in known]  # a text's first piece is looked at below
    heads = [names[i] for i in code[at].tolist()]
    whole = np.logical_or.reduceat(is_odd[code] & later, at) | np.array([h.strip() != h or not h or SPECIAL in h for h in heads], bool) if len(at) else np.empty(0, bool)
    unknown = list({h for h, w in zip(heads, whole.tolist()) if not w and h not in first})
    first.update(zip(unknown, (np.array(e.ids, np.uint32).tobytes() for e in tok.encode_batch_fast(unknown, add_special_tokens=False))))
    begun = [first[h] if not w else b"" for h, w in zip(heads, whole.tolist())]
    odd = np.flatnonzero(whole).tolist()
    for i, e in zip(odd, tok.encode_batch_fast([texts[i].as_py() for i in odd], add_special_tokens=False)):
        begun[i] = np.array(e.ids, np.uint32).tobytes()
    known += begun  # the names, then for each text what it begins with: its first word, or all of it
    flat = np.frombuffer(b"".join(known), np.uint32)
    of_name = np.fromiter(map(len, known), np.int64, len(known)) // 4
    code = code.astype(np.int64)
    code[at] = len(names) + np.arange(len(at))
    n = of_name[code]
    n[later & np.repeat(whole, size)] = 0
    begins = np.cumsum(n) - n
    taken = flat[np.repeat((np.cumsum(of_name) - of_name)[code] - begins, n) + np.arange(int(n.sum()))]
    return taken, np.add.reduceat(n, at) if len(at) else np.empty(0, np.int64)


def code_lengths(counts: np.ndarray, limit: int = MAX_BITS) -> np.ndarray:
    """Optimal code lengths of at most ``limit`` bits for the symbols with a count (package-merge):
    each round pairs the cheapest items of the list into packages and merges them with the symbols;
    a symbol's length is the number of rounds in which it is among the items needed."""
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.uint8)
    n = len(used)
    if n == 1:
        lengths[used] = 1
    if n < 2:
        return lengths
    if n > 1 << limit:
        raise ValueError(f"{n} symbols do not fit codes of {limit} bits")
    order = used[np.argsort(counts[used], kind="stable")]
    leaf = counts[order].astype(np.float64)
    rounds, items = [], leaf
    rounds.append(np.ones(n, bool))
    for _ in range(limit - 1):
        packs = items[: len(items) // 2 * 2].reshape(-1, 2).sum(1)
        both = np.concatenate([leaf, packs])
        at = np.argsort(both, kind="stable")
        rounds.append(at < n)
        items = both[at]
    need, depth = 2 * n - 2, np.zeros(n, np.int64)
    for is_leaf in reversed(rounds):
        leaves = int(is_leaf[:need].sum())
        depth[:leaves] += 1
        need = 2 * (min(need, len(is_leaf)) - leaves)
    lengths[order] = depth
    return lengths


def canonical(lengths: np.ndarray) -> np.ndarray:
    """Codes by length, then symbol: each is the one before plus one, widened where length grows."""
    codes = np.zeros(len(lengths), np.uint32)
    code, last = 0, 0
    for s in np.lexsort((np.arange(len(lengths)), lengths)):
        n = int(lengths[s])
        if n:
            code = (code << (n - last)) if last else 0
            codes[s], last = code, n
            code += 1
    return codes


def pack_bits(ids: np.ndarray, starts: np.ndarray, lengths: np.ndarray, codes: np.ndarray) -> tuple[bytes, np.ndarray, np.ndarray]:
    """Coded bytes of the documents that begin at ``starts`` in ``ids``, the byte offset of each
    (and of the end) and the bit position of every id."""
    n = lengths[ids].astype(np.int64)
    ends = np.cumsum(n)
    upto = np.r_[0, ends]
    bounds = np.r_[starts, len(ids)]
    doc_bytes = (np.diff(upto[bounds]) + 7) // 8
    offsets = np.r_[0, np.cumsum(doc_bytes)]
    shift = np.repeat(offsets[:-1] * 8 - upto[starts], np.diff(bounds))
    pos = ends - n + shift
    word, off = pos >> 5, pos & 31
    value = codes[ids].astype(np.uint64) << (64 - n - off).astype(np.uint64)
    size = int(offsets[-1] + 3) // 4 + 2
    high = np.bincount(word, (value >> np.uint64(32)).astype(np.float64), size)
    low = np.bincount(word + 1, (value & np.uint64(0xFFFFFFFF)).astype(np.float64), size)
    return (high + low).astype(np.uint64).astype(">u4").tobytes()[: int(offsets[-1])], offsets, pos


def unpack_bits(data: bytes, bit_starts: np.ndarray, counts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Ids of independent blocks, one after the other; all blocks advance in lockstep."""
    codes = canonical(lengths)
    symbol, width = np.zeros(1 << MAX_BITS, np.uint32), np.zeros(1 << MAX_BITS, np.int64)
    for s in np.flatnonzero(lengths):
        n = int(lengths[s])
        lo = int(codes[s]) << (MAX_BITS - n)
        symbol[lo:lo + (1 << (MAX_BITS - n))] = s
        width[lo:lo + (1 << (MAX_BITS - n))] = n
    buf = np.frombuffer(data + b"\0\0\0", np.uint8).astype(np.uint32)
    order = np.argsort(-counts, kind="stable")
    pos, to = bit_starts[order].copy(), (np.cumsum(counts) - counts)[order]
    out = np.empty(int(counts.sum()), np.uint32)
    live = np.searchsorted(-counts[order], -np.arange(int(counts.max(initial=0))), side="left")
    for k in range(int(counts.max(initial=0))):
        p = pos[: live[k]]
        b = p >> 3
        v = ((buf[b] << 16 | buf[b + 1] << 8 | buf[b + 2]) >> (8 - (p & 7)).astype(np.uint32)) & 0xFFFF
        out[to[: live[k]] + k] = symbol[v]
        p += width[v]
    return out


def spans(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of rows of about ``most`` in all, one row at least."""
    part = (np.cumsum(sizes) - sizes) // most
    at = np.flatnonzero(np.r_[True, part[1:] != part[:-1]]) if len(part) else np.empty(0, np.int64)
    yield from zip(at.tolist(), [*at[1:].tolist(), len(sizes)])


def binaries(data: np.ndarray, ends: np.ndarray) -> pa.BinaryArray:
    """The values that end at the byte offsets ``ends`` of ``data``, without a copy a value."""
    return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(np.r_[0, ends].astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))])


def tokenized(docs: DataFrame, tokenizer: str, bounds: list[int], id_col: str, text_col: str) -> DataFrame:
    """(part, doc_id, ids, counts): the file a document goes to, and its ids with the end id, as bytes;
    one more row a task, without a part, has the task's ids and their counts."""
    edges = np.array(bounds, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1, np.int64)
        for b in batches:
            for lo, hi in spans(pc.fill_null(pc.utf8_length(b.column(1)), 0).to_numpy(), SLICE_CHARS):
                out, ids = one(b.slice(lo, hi - lo))
                got = np.bincount(ids, minlength=len(total))
                got[: len(total)] += total
                total = got
                yield out
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int32()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()), pa.array([np.stack([used, total[used]]).astype("<i8").tobytes()], pa.binary())], NAMES)

    def one(b: pa.RecordBatch) -> tuple[pa.RecordBatch, np.ndarray]:
        ids, sizes = encode_flat(tokenizer, pc.fill_null(b.column(1), ""))
        ends = np.cumsum(sizes)
        ids = np.insert(ids, ends, END_ID).astype("<u4")
        ends += np.arange(1, len(ends) + 1)
        key = b.column(0).fill_null((1 << 63) - 1).to_numpy()
        lo, hi = np.searchsorted(edges, key, side="left"), np.searchsorted(edges, key, side="right")
        part = lo.copy()
        for i in np.flatnonzero(hi > lo).tolist():  # an id that fills whole ranges may go to any of them: ties have no order
            part[i] += zlib.crc32(ids[ends[i] - sizes[i] - 1:ends[i]]) % int(hi[i] - lo[i] + 1)
        if not len(ids) or ids.max() < 1 << 16:
            raw = binaries(ids.astype("<u2"), ends * 2)
        else:
            raw = pa.array([r.astype("<u2").tobytes() if r.max() < 1 << 16 else b"\0" + r.tobytes() for r in np.split(ids, ends[:-1])], pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), b.column(0), raw, pa.nulls(len(ends), pa.binary())], NAMES), ids

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, "part int, doc_id long, ids binary, counts binary")


def _ids(raw: bytes) -> np.ndarray:
    """Two bytes an id, or, of odd length, a zero byte and four bytes an id."""
    return np.frombuffer(raw, "<u4", offset=1).astype(np.int64) if len(raw) % 2 else np.frombuffer(raw, "<u2").astype(np.int64)


def _flat_ids(raws: pa.BinaryArray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all rows one after the other, and the number of each row's."""
    n_bytes = pc.binary_length(raws).to_numpy(zero_copy_only=False).astype(np.int64)
    if (n_bytes % 2).any():
        rows = [_ids(r.as_py()) for r in raws]
        return np.concatenate(rows), np.array([len(r) for r in rows])
    return np.frombuffer(b"".join(raws.to_pylist()), "<u2").astype(np.int64), n_bytes // 2


def write(docs: DataFrame, path: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", file_text_bytes: int = FILE_TEXT_BYTES) -> DataFrame:
    """Write the files under ``path``; returns (part, n_docs, n_tokens), one row a file."""
    size = docs.select(F.sum(F.octet_length(text_col)).alias("b"), F.count("*").alias("n")).first()
    files = max(1, -(-int((size["b"] or 0) + 16 * size["n"]) // file_text_bytes))
    cuts = docs.select(F.percentile_approx(F.col(id_col).cast("long"), [i / files for i in range(1, files)], 10_000)).first()[0] if files > 1 else []
    stage = materialize(tokenized(docs, tokenizer, sorted(cuts or []), id_col, text_col), "tokens")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for raw in b.column(0):
                used, n = np.frombuffer(raw.as_py(), "<i8").reshape(2, -1)
                yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(n)], ["id", "n"])

    counted = stage.where("counts is not null").select("counts").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(max((r["id"] for r in counted), default=0) + 1, np.int64)
    for r in counted:
        counts[r["id"]] = r["n"]
    lengths = code_lengths(counts)
    codes = canonical(lengths)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi in spans(pc.binary_length(b.column(2)).to_numpy() // 2, SLICE_IDS):
                yield coded(b.slice(lo, hi - lo))

    def coded(b: pa.RecordBatch) -> pa.RecordBatch:
        ids, n = _flat_ids(b.column(2))
        starts = np.cumsum(n) - n
        data, offsets, pos = pack_bits(ids, starts, lengths, codes)
        blocks = -(-n // BLOCK)
        doc = np.repeat(np.arange(len(n)), blocks)
        at = starts[doc] + (np.arange(len(doc)) - np.repeat(np.cumsum(blocks) - blocks, blocks)) * BLOCK
        marks = (pos[at] - offsets[doc] * 8).astype("<u4")
        return pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(n), binaries(marks, np.cumsum(blocks) * 4), binaries(np.frombuffer(data, np.uint8), offsets[1:])],
                                          ["part", "doc_id", "n", "marks", "coded"])

    def save(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, null, n, marks, coded, part = [], [], [], [], [], None
        for b in batches:
            c = b.to_pydict()
            part = c["part"][0] if c["part"] else part
            ids += [i or 0 for i in c["doc_id"]]
            null += [i is None for i in c["doc_id"]]
            n += c["n"]
            marks += c["marks"]
            coded += c["coded"]
        if part is None:
            return
        at = np.cumsum([0, *map(len, coded)])[:-1]
        body = b"".join([MAGIC, struct.pack("<4Q", len(ids), sum(n), sum(map(len, marks)) // 4, len(lengths)), lengths.tobytes(),
                         np.array(ids, "<i8").tobytes(), np.array(null, np.uint8).tobytes(), np.array(n, "<u8").tobytes(), np.array(at, "<u8").tobytes(), *marks, *coded])
        write_bytes(path, f"part-{part:06d}.chuf", body)
        yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([len(ids)], pa.int64()), pa.array([sum(n)], pa.int64())], ["part", "n_docs", "n_tokens"])

    bits = stage.where("part is not null").select("part", "doc_id", "ids").mapInArrow(code, "part int, doc_id long, n long, marks binary, coded binary")
    placed = bits.repartitionById(files, F.col("part")).sortWithinPartitions(F.col("doc_id").asc_nulls_last(), F.crc32("coded"))
    return materialize(placed.mapInArrow(save, "part int, n_docs long, n_tokens long"), "token-files")


def read(totals: DataFrame, path: str) -> DataFrame:
    """One row a document from the files: doc_id, start, n_tokens, ids (little-endian u32 bytes)."""
    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, raw in zip(b.column(0).to_pylist(), b.column(1)):
                yield from decode_file(int(re.search(r"part-(\d+)\.chuf", name)[1]), raw.as_py())

    spark = totals.sparkSession
    schema = "part int, doc_id long, at long, n_tokens long, ids binary"
    if totals.isEmpty():
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids binary")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.chuf").load(path).select("path", "content")
    there = {int(re.search(r"part-(\d+)\.chuf", r["path"])[1]) for r in files.select("path").collect()}  # one row a file
    missing = sorted(r["part"] for r in totals.select("part").collect() if r["part"] not in there)
    if missing:
        raise FileNotFoundError(f"{path}: {len(missing)} of the files written are missing, the first is part {missing[0]}")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row a file
    starts = totals.select("part", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("base"))
    docs = files.mapInArrow(load, schema)
    return docs.join(F.broadcast(starts), "part").select("doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids")


def decode_file(part: int, raw: bytes) -> Iterator[pa.RecordBatch]:
    if raw[:8] != MAGIC:
        raise ValueError("not a token file")
    docs, total, n_marks, symbols = struct.unpack_from("<4Q", raw, 8)
    at = 40

    def take(kind: str, count: int) -> np.ndarray:
        nonlocal at
        a = np.frombuffer(raw, kind, count, at)
        at += a.nbytes
        return a

    lengths, ids, null = take("u1", symbols), take("<i8", docs), take("u1", docs).astype(bool)
    n, offset, marks = take("<u8", docs).astype(np.int64), take("<u8", docs).astype(np.int64), take("<u4", n_marks).astype(np.int64)
    blocks = -(-n // BLOCK)
    doc = np.repeat(np.arange(docs), blocks)
    k = np.arange(len(doc)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    out = unpack_bits(raw[at:], marks + offset[doc] * 8, np.minimum(BLOCK, n[doc] - k * BLOCK), lengths).astype("<u4")
    first = np.cumsum(n) - n
    for lo in range(0, docs, 4096):
        hi = min(docs, lo + 4096)
        yield pa.RecordBatch.from_arrays([
            pa.array(np.full(hi - lo, part, np.int32)), pa.array(ids[lo:hi], mask=null[lo:hi]), pa.array(first[lo:hi]), pa.array(n[lo:hi]),
            binaries(out[first[lo]:first[hi - 1] + n[hi - 1]], (first + n - first[lo])[lo:hi] * 4)], ["part", "doc_id", "at", "n_tokens", "ids"])
