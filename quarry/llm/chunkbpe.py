"""BPE encoding and decoding with content-defined chunk reuse.

A rolling hash of ``WINDOW`` bytes cuts every text into chunks of about ``2 ** CUT_BITS`` bytes, so
equal passages are cut alike wherever they stand. Chunks that occur more than once in the corpus
are encoded once; their ids are looked up wherever they stand, and only the rest of a document is
encoded with it. A chunk may begin or end inside a word: at each of its ends the piece up to the
nearest white space is encoded again; only where the chunk's ids begin (or end) with just these ids
are they cut off there, else the next white space is tried. The pieces cut off are encoded again
together with what they join, so all ids are those of the whole text.

This is exact where the tokenizer drops white space before it applies merges, as nothing then
reaches across a space; ``drops_space`` reads this from the tokenizer's file. With another tokenizer
every text is encoded whole by the library.

Scale: three scans, none of which moves texts: hashes of chunks are counted (8 bytes a chunk), the
chunks that occur again are moved once and encoded, and the documents are encoded where they are read.
Hash arrays and ids lie in the shared folder in files of about ``FILE_KEYS`` chunks by hash range,
sorted; a worker maps one file at a time for the sorted hashes of some megabytes of text. Hashes have
64 bits, and other 64 bits are compared before a chunk's ids are used. The driver gets one row a file.

Defined cases: a null text is an empty one and has no ids; equal rows each have their ids; an empty
table gives no rows; special tokens in a text are tokens, as in the library; all columns are kept.
"""

from __future__ import annotations

import json
import os
import re
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.common import fresh, materialize
from quarry.llm.files import map_array, write_array
from quarry.session import stage_path

WINDOW = 16
CUT_BITS = 9
MIN_CHUNK = 128
FILE_KEYS = 1 << 20
SLICE_BYTES = 4 << 20
CACHE_PIECES = 400_000
PIECES_AT_ONCE = 20_000
KEYS_AT_ONCE = 1_000_000
SPACE = b" \t\n\r"
#: Characters whose words the tokenizer's pattern cuts as ``PIECES`` does: printable ASCII and Latin letters that composing leaves alone.
ODD = re.compile(r"[^\x20-\x7E\t\n\rÀ-ÖØ-öø-ÿ]")
PIECES = re.compile(r"'(?:[sStTmMdD]|[rR][eE]|[vV][eE]|[lL][lL])|[A-Za-zÀ-ÖØ-öø-ÿ]+|[0-9]|[!-/:-@\[-`{-~]+")
#: Fixed value: the split pattern of the tokenizer for which ``PIECES`` holds.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

_state: dict = {}


# ---- the tokenizer

def drops_space(config: dict) -> bool:
    """White space is dropped before merges, and no step before that looks across it."""
    norm = config.get("normalizer") or {}
    steps = norm.get("normalizers", [norm] if norm else [])
    plain = all(s["type"] in ("NFC", "Lowercase") or s["type"] == "Replace" and s["pattern"] == {"Regex": r"\s+"} and s["content"] == " " for s in steps)
    pre = config.get("pre_tokenizer") or {}
    cuts = pre.get("pretokenizers", [pre] if pre else [])
    split = len(cuts) == 2 and cuts[0]["type"] == "Split" and cuts[0]["pattern"] == {"Regex": SPLIT} and cuts[0]["behavior"] == "Removed" and cuts[0]["invert"] \
        and cuts[1]["type"] == "ByteLevel" and not cuts[1]["add_prefix_space"] and not cuts[1]["use_regex"]
    added = all(not (t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] or re.search(r"\s", t["content"])) for t in config.get("added_tokens", []))
    return plain and split and added and not config.get("post_processor") and not config["model"].get("dropout")


class Encoder:
    """Ids of texts; pieces between white space are encoded once a worker and remembered."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks are the parallel unit
        from tokenizers import Tokenizer
        with open(path, encoding="utf-8") as f:
            config = json.load(f)
        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        self.by_word = drops_space(config)
        self.special = [t["content"] for t in config.get("added_tokens", [])]
        self.names = None if self.tok.decoder is not None else pa.array([self.tok.id_to_token(i) or "" for i in range(self.tok.get_vocab_size())])
        self.seen: dict[str, bytes] = {}

    def pieces(self, text: str) -> list[str]:
        """What the ids of a text are the ids of, one after another."""
        if not ODD.search(text) and not any(s in text for s in self.special):
            return PIECES.findall(text)
        out: list[str] = []
        for word in re.split(r"[ \t\n\r]+", text):
            if ODD.search(word) or any(s in word for s in self.special):
                out.append(word)
            else:
                out += PIECES.findall(word)
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as bytes of unsigned 32-bit integers."""
        if not self.by_word:
            return [np.array(e.ids, np.uint32).tobytes() for e in self.tok.encode_batch(texts, add_special_tokens=False)]
        if len(self.seen) > CACHE_PIECES:
            self.seen.clear()
        seen, split = self.seen, list(map(self.pieces, texts))
        new = list({p for ps in split for p in ps if p not in seen})
        for lo in range(0, len(new), PIECES_AT_ONCE):
            some = new[lo:lo + PIECES_AT_ONCE]
            seen.update((p, np.array(e.ids, np.uint32).tobytes()) for p, e in zip(some, self.tok.encode_batch(some, add_special_tokens=False)))
        return [b"".join(map(seen.__getitem__, ps)) for ps in split]

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> pa.Array:
        """Texts of lists of ids, special tokens included. Without a decoder the library joins the
        tokens by a space; with one, it is asked."""
        if self.names is None:
            return pa.array(self.tok.decode_batch([ids[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:])], skip_special_tokens=False), pa.string())
        return pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), self.names.take(pa.array(ids))), " ")


def encoder(path: str) -> Encoder:
    if _state.get("path") != path:
        _state.update(path=path, enc=Encoder(path))
    return _state["enc"]


# ---- chunks

def _mix() -> np.ndarray:
    """A fixed number for each byte, from a seeded generator."""
    return np.random.default_rng(20).integers(0, 1 << 32, 256, np.uint32)


MIX = _mix()


def cuts(data: np.ndarray, starts: list[int], ends: list[int]) -> list[list[int]]:
    """For each text ``data[a:b]`` the places where chunks end, its own end included. A cut depends
    on the ``WINDOW`` bytes before it, stands before a character and at least ``MIN_CHUNK`` after the last."""
    h = MIX[data]
    factor, step = 0x9E3779B1, 1
    while step < WINDOW:  # sums over 2, 4, 8, ... bytes
        power = pow(factor, step, 1 << 32)
        h[step:] = h[step:] + h[:-step] * np.uint32(power)
        step *= 2
    at = np.flatnonzero(h >> np.uint32(32 - CUT_BITS) == 0) + 1
    at = at[at < len(data)]
    at = at[(data[at] & 0xC0) != 0x80].tolist()
    out = []
    for a, b in zip(starts, ends):
        mine, k = [], bisect_left(at, a + MIN_CHUNK)
        while k < len(at) and at[k] < b:
            mine.append(at[k])
            k = bisect_left(at, at[k] + MIN_CHUNK, k)
        out.append(mine + [b] if b > a else mine)
    return out


def sliced(texts: pa.Array) -> Iterator[tuple[int, list[bytes]]]:
    """Texts as bytes, about ``SLICE_BYTES`` at a time, with the place of the first."""
    size = np.append(0, np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)))
    lo = 0
    while lo < len(texts):
        hi = max(lo + 1, int(np.searchsorted(size, size[lo] + SLICE_BYTES, "right")) - 1)
        yield lo, [t or b"" for t in texts.slice(lo, hi - lo).cast(pa.binary()).to_pylist()]
        lo = hi


def chunked(texts: list[bytes]) -> tuple[bytes, list[int], list[list[int]], np.ndarray]:
    """All bytes, where each text starts, its cuts, and per chunk two hashes of 64 bits."""
    data = b"".join(texts)
    ends = np.cumsum([len(t) for t in texts]).tolist()
    starts = [0, *ends[:-1]]
    places = cuts(np.frombuffer(data, np.uint8), starts, ends) if data else [[] for _ in texts]
    digests = b"".join(xxhash.xxh3_128_digest(data[a:b]) for s, cs in zip(starts, places) for a, b in zip([s, *cs], cs))
    return data, starts, places, np.frombuffer(digests, ">u8").astype(np.uint64).reshape(-1, 2)


# ---- chunks that occur again

def _file_of(keys: np.ndarray, bits: int) -> np.ndarray:
    return (keys >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)


def _files(df: DataFrame, folder: str, columns: dict[str, str], size: int) -> dict:
    """``df`` with ``key`` and ``columns`` written as sorted arrays, a set of files a range of hashes.
    Returned: the number of bits that name a range and the ranges that have files; a listed file
    that is missing raises where it is read."""
    bits = max(0, (max(size, 1) - 1).bit_length() - FILE_KEYS.bit_length() + 1)
    name = F.shiftrightunsigned("key", 64 - bits).cast("int") if bits else F.lit(0)

    def put(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        keys = group["key"].to_numpy().view(np.uint64)
        order, n = np.argsort(keys), int(group["name"][0].as_py())
        write_array(folder, f"{n}.key.npy", keys[order])
        if "ids" in columns:
            ids = [group["ids"][i].as_py() for i in order.tolist()]
            write_array(folder, f"{n}.check.npy", group["check"].to_numpy().view(np.uint64)[order])
            write_array(folder, f"{n}.end.npy", np.cumsum([len(i) // 4 for i in ids]).astype(np.int64))
            write_array(folder, f"{n}.ids.npy", np.frombuffer(b"".join(ids), np.uint32))
        return pa.table({"name": pa.array([n], pa.int32())})
    done = df.withColumn("name", name).groupBy("name").applyInArrow(put, "name int").collect()
    return {"folder": folder, "bits": bits, "names": sorted(r["name"] for r in done)}


def _look(index: dict, keys: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """Sorted distinct keys in the files, one file after another: which are there, where, and in which."""
    part = _file_of(keys, index["bits"])
    for n in np.unique(part).tolist():
        if n in index["set"]:
            mine, have = np.flatnonzero(part == n), map_array(index["folder"], f"{n}.key.npy")
            at = np.searchsorted(have, keys[mine])
            at[at == len(have)] = 0
            ok = have[at] == keys[mine]
            yield mine[ok], at[ok], n


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, texts in sliced(batch.column(0)):
            keys, n = np.unique(chunked(texts)[3][:, 0], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(n.astype(np.int64))], names=["key", "n"])


def shared_chunks(docs: DataFrame, text: str, tokenizer: str) -> dict:
    """Index of the ids of all chunks that occur more than once, each encoded once."""
    spark = docs.sparkSession
    texts = docs.select(F.col(text).alias("text"))
    again = texts.mapInArrow(_counted, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).where("n > 1").select("key")
    again = materialize(again, "chunk-keys")
    size = again.count()
    keys = _files(again, stage_path(spark, f"llm-chunk-key-files-{os.urandom(6).hex()}"), {}, size)

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Chunks that occur again, each once a task (as far as it remembers)."""
        index, sent = {**keys, "set": set(keys["names"])}, np.empty(0, np.uint64)
        for batch in batches:
            for _, some in sliced(batch.column(0)):
                data, starts, places, hashes = chunked(some)
                found, where = np.unique(hashes[:, 0], return_index=True)
                hit = np.sort(np.concatenate([m for m, _, _ in _look(index, found)] or [np.empty(0, np.int64)]))
                hit = hit[~np.isin(found[hit], sent)]
                sent = np.union1d(sent, found[hit]) if len(sent) < KEYS_AT_ONCE else found[hit]
                a = np.array([x for s, cs in zip(starts, places) for x in [s, *cs][:len(cs)]], np.int64)
                b = np.array([x for cs in places for x in cs], np.int64)
                rows = where[hit]
                yield pa.RecordBatch.from_arrays([pa.array(found[hit].view(np.int64)), pa.array(hashes[rows, 1].view(np.int64)), pa.array([data[x:y] for x, y in zip(a[rows].tolist(), b[rows].tolist())], pa.binary())], names=["key", "check", "chunk"])
    chunks = texts.mapInArrow(first, "key long, check long, chunk binary").groupBy("key").agg(F.min(F.struct("check", "chunk")).alias("c"))

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = encoder(tokenizer).encode([c.decode() for c in batch.column(2).to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(ids, pa.binary())], names=["key", "check", "ids"])
    ids = chunks.select("key", "c.check", "c.chunk").mapInArrow(encoded, "key long, check long, ids binary")
    return _files(ids, stage_path(spark, f"llm-chunk-id-files-{os.urandom(6).hex()}"), {"ids": "binary"}, size)


# ---- documents

def _first_space(data: bytes, a: int, b: int) -> int:
    return min((x for x in (data.find(s, a, b) for s in (b" ", b"\n", b"\t", b"\r")) if x >= 0), default=-1)


def _last_space(data: bytes, a: int, b: int) -> int:
    return max(data.rfind(s, a, b) for s in (b" ", b"\n", b"\t", b"\r"))


def _trimmed(enc: Encoder, data: bytes, a: int, b: int, ids: bytes, start: int, end: int) -> tuple[int, int, bytes] | None:
    """The part of the chunk ``data[a:b]`` in the text ``data[start:end]`` whose ids hold whatever
    stands around it, and its ids; None where no white space bounds one. The ids of the pieces cut off
    must be those that the chunk's own ids begin and end with, else more is cut off."""
    lo, hi, left = a, b, ids
    if a > start and data[a - 1] not in SPACE:
        lo = _first_space(data, a, b)
        while lo >= 0:
            head = enc.encode([data[a:lo].decode()])[0]
            if left.startswith(head):
                left = left[len(head):]
                break
            lo = _first_space(data, lo + 1, b)
        if lo < 0:
            return None
    if b < end and data[b] not in SPACE:
        hi = _last_space(data, lo, b)
        while hi >= 0:
            tail = enc.encode([data[hi:b].decode()])[0]
            if left.endswith(tail):
                left = left[:len(left) - len(tail)]
                break
            hi = _last_space(data, lo, hi)
        if hi < 0:
            return None
    return lo, hi, left


def encode_slice(enc: Encoder, index: dict | None, texts: list[bytes]) -> list[bytes]:
    """Ids of each text, of the chunks in the index by lookup."""
    if index is None or not index["names"]:
        return enc.encode([t.decode() for t in texts])
    data, starts, places, hashes = chunked(texts)
    keys, of = np.unique(hashes[:, 0], return_inverse=True)
    known: dict[int, tuple[int, bytes]] = {}
    for mine, at, n in _look(index, keys):
        check, end, ids = (map_array(index["folder"], f"{n}.{x}.npy") for x in ("check", "end", "ids"))
        upto, begin, checks = end[at].tolist(), np.where(at > 0, end[at - 1], 0).tolist(), check[at].tolist()
        known.update((m, (c, ids[x:y].tobytes())) for m, c, x, y in zip(mine.tolist(), checks, begin, upto))
    of, second = of.tolist(), hashes[:, 1].tolist()
    parts: list[list] = []  # per text: ids, or the place in ``todo`` of what is encoded here
    todo: list[str] = []
    k = 0
    for (a, cs), text in zip(zip(starts, places), texts):
        mine, start, end, open_at = [], a, a + len(text), a
        for b in cs:
            hit = known.get(of[k])
            if hit and hit[0] == second[k] and (kept := _trimmed(enc, data, a, b, hit[1], start, end)):
                if kept[0] > open_at:
                    mine.append(len(todo))
                    todo.append(data[open_at:kept[0]].decode())
                mine.append(kept[2])
                open_at = kept[1]
            a, k = b, k + 1
        if open_at < end:
            mine.append(len(todo))
            todo.append(data[open_at:end].decode())
        parts.append(mine)
    done = enc.encode(todo)
    return [b"".join(done[p] if isinstance(p, int) else p for p in mine) for mine in parts]


def encoded(docs: DataFrame, tokenizer: str, text: str = "text") -> DataFrame:
    """All columns and ``bpe``: ``ids`` and what they decode to (``decoded``)."""
    (name,) = fresh(docs, "bpe")
    (body,) = fresh(docs, "bpe_text")
    from tokenizers import Tokenizer
    Tokenizer.from_file(tokenizer)  # a missing or broken file is an error here, not in every task
    with open(tokenizer, encoding="utf-8") as f:
        by_word = drops_space(json.load(f))
    index = shared_chunks(docs, text, tokenizer) if by_word else None
    kept = [f for f in docs.schema.fields]
    schema = T.StructType([*kept, T.StructField(name, T.StructType([T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.StringType())]))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, look = encoder(tokenizer), index and {**index, "set": set(index["names"])}
        for batch in batches:
            for lo, some in sliced(batch.column(batch.num_columns - 1)):
                ids = encode_slice(enc, look, some)
                offsets = np.append(0, np.cumsum([len(i) // 4 for i in ids])).astype(np.int32)
                flat = np.frombuffer(b"".join(ids), np.uint32).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))
                both = pa.StructArray.from_arrays([lists, enc.decode(flat, offsets)], ["ids", "decoded"])
                yield pa.RecordBatch.from_arrays([*(batch.column(i).slice(lo, len(some)) for i in range(batch.num_columns - 1)), both], names=[f.name for f in schema.fields])
    return docs.select("*", F.col(text).alias(body)).mapInArrow(run, schema)
