"""Removal of word sequences that an earlier document has: fixed-block anchors.

A window of ``window`` words holds a whole block of ``(window + 1) // 2`` words that starts at a
multiple of that size in any document it occurs in. So the blocks at those places are the index,
every rolling block of every document probes it, and a hit is extended to the windows around
it; windows that an earlier document also has merge to the maximal repeats.

The documents are dealt by content into chunks of about ``chunk_bytes`` of text, and hashes into
buckets of about ``bucket_windows``; both numbers grow with the corpus, neither size does.

1. A chunk sends every distinct rolling block hash once to its bucket (31 bits beside the
   bucket's number, with one bit for index blocks). A hash that came twice and is in the index is
   a hit, and goes back to the chunks that sent it.
2. A chunk extends its hits to all windows around them and sends each distinct window's 96-bit
   hash once, with its smallest document. The bucket answers one bit: has another chunk a smaller one.
3. A chunk applies the answers to its documents.

Chunks combine before each shuffle, so a passage that a third of all documents share is sent
once a chunk and not once a document, and no pairs are built. What a task holds is one chunk or
one bucket. Chunks and buckets follow from contents, so recomputed tasks send the same. The first
hash may collide (that only adds windows to step 2); the second decides, at 96 bits and the bucket.

Defined results: NULL, empty and blank texts have no words; a text shorter than a window keeps
all its words; documents of equal id don't remove from one another; a document with a NULL id
neither removes nor loses words; repeated rows each get their row; an empty table gives no rows.
Windows are judged on the input, not on what is left. Ids must be whole numbers.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from .common import Scratch, free_name, table, texts

WINDOW = 13
CHUNK_BYTES = 8 << 20
BUCKET_WINDOWS = 4_000_000
_WORDS_KEPT = 1 << 20
_LOW = np.uint64(0xFFFFFFFF)
_PACKED = "chunk int, id long, key long, copies long, packed binary"
_MESSAGE = "bucket int, chunk int, data binary"
_ANSWER = "chunk int, bucket int, kind int, data binary"
_FOUND = "id long, key long, copies long, n_words long, spans array<struct<first:int,last:int>>, kept string"
_HITS, _BITS = 0, 1


class WordHashes(dict):
    """64-bit hashes of words, kept from one text to the next."""

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(self) < _WORDS_KEPT:
            self[word] = value
        return value


_HASHES = WordHashes()


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def multipliers(n: int, seed: int) -> np.ndarray:
    """Odd 64-bit factors, one for each word of a window."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed)) | np.uint64(1)


def pack_array(values: np.ndarray) -> bytes:
    """Bytes of an integer array, plane by plane, compressed."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(-1, values.dtype.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def unpack_array(data: bytes, dtype) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(raw.reshape(size, -1).T).reshape(-1).view(dtype)


def bucket_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)


class Chunk:
    """The documents of one chunk, repeated rows once, as one array of word hashes."""

    def __init__(self, rows: pa.Table, window: int, buckets: int):
        self.window, self.block, self.buckets = window, (window + 1) // 2, buckets
        copies: dict[tuple, int] = {}
        packed = {}
        for i, key, n, data in zip(*(rows.column(c).to_pylist() for c in ("id", "key", "copies", "packed")), strict=True):
            copies[i, key] = copies.get((i, key), 0) + n
            packed[i, key] = data
        # NULL ids last; the order itself only has to be the same each time.
        self.keys = sorted(copies, key=lambda k: (k[0] is None, k))
        self.copies = [copies[k] for k in self.keys]
        unzip = zstandard.ZstdDecompressor().decompress
        self.words = [unzip(packed[k]).split() for k in self.keys]
        self.lengths = np.fromiter(map(len, self.words), np.int64, len(self.words))
        self.ends = np.cumsum(self.lengths)
        self.starts = self.ends - self.lengths
        total = int(self.lengths.sum())
        self.hashes = np.fromiter(map(_HASHES.__getitem__, chain.from_iterable(self.words)), np.uint64, total)
        takes_part = np.array([k[0] is not None for k in self.keys], bool) & (self.lengths >= window)
        self.ids = np.array([k[0] or 0 for k in self.keys], np.int64)
        left = np.repeat(np.where(takes_part, self.ends, 0), self.lengths) - np.arange(total)
        self.has_block, self.has_window = left >= self.block, left >= window

    def blocks(self) -> tuple[np.ndarray, np.ndarray]:
        """Places of all rolling blocks and their entries: bucket, 31 bits of hash, and 1 for an index block."""
        at = np.flatnonzero(self.has_block)
        factors = multipliers(self.block, 7)
        total = np.zeros(len(at), np.uint64)
        for j in range(self.block):
            total += self.hashes[at + j] * factors[j]
        v = mix(total)
        indexed = (at - np.repeat(self.starts, self.lengths)[at]) % self.block == 0
        entry = bucket_of(v, self.buckets) << np.uint64(32) | (v & (_LOW - np.uint64(1))) | indexed.astype(np.uint64)
        return at, entry

    def candidates(self, hits: dict[int, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Windows around hits: their places, for each its number among the distinct ones, and of
        the distinct ones, ordered by bucket and hash: bucket, 64 and 32 bits of hash (one row each)."""
        at, entry = self.blocks()
        known, counts = np.unique(entry, return_counts=True)
        one = np.uint64(1)
        group = np.flatnonzero(np.diff(known >> one, prepend=np.uint64((1 << 64) - 1)) != 0) if len(known) else known.astype(np.int64)
        if len(group):  # met twice inside the chunk, once as an index block
            own = (known >> one)[group]
            twice = (np.add.reduceat(counts, group) > 1) & (np.maximum.reduceat(known & one, group) == one)
            met = [own[twice]]
        else:
            met = []
        met += [np.uint64(b) << np.uint64(31) | h.astype(np.uint64) for b, h in hits.items()]
        met = np.unique(np.concatenate(met)) if met else np.zeros(0, np.uint64)
        hit = np.zeros(len(self.hashes) + self.block, bool)
        hit[at] = np.isin(entry >> one, met)
        around = self.has_window.copy()
        near = hit[: len(around)].copy()
        for j in range(1, self.window - self.block + 1):
            near |= hit[j : j + len(around)]
        places = np.flatnonzero(around & near)
        f1, f2 = multipliers(self.window, 11), multipliers(self.window, 13)
        a, b = np.zeros(len(places), np.uint64), np.zeros(len(places), np.uint64)
        for j in range(self.window):
            word = self.hashes[places + j]
            a += word * f1[j]
            b += (word ^ (word >> np.uint64(29))) * f2[j]
        a, b = mix(a), mix(b)
        bucket, b = bucket_of(b, self.buckets), b & _LOW
        order = np.lexsort((b, a, bucket))
        rows = np.stack([bucket[order], a[order], b[order]])
        new = np.ones(len(order), bool)
        new[1:] = (rows[:, 1:] != rows[:, :-1]).any(0)
        number = np.empty(len(order), np.int64)
        number[order] = np.cumsum(new) - 1
        return places, number, *rows[:, new]

    def smallest(self, places: np.ndarray, number: np.ndarray, distinct: int) -> tuple[np.ndarray, np.ndarray]:
        """Id of each window's document, and the smallest id of each distinct window."""
        ids = self.ids[np.searchsorted(self.ends, places, "right")]
        low = np.full(distinct, np.iinfo(np.int64).max)
        np.minimum.at(low, number, ids)
        return ids, low


def _by_bucket(bucket: np.ndarray) -> Iterator[tuple[int, int, int]]:
    cut = np.flatnonzero(np.diff(bucket)) + 1
    for lo, hi in zip([0, *cut.tolist()], [*cut.tolist(), len(bucket)], strict=True):
        if hi > lo:
            yield int(bucket[lo]), lo, hi


def _hits_of(answers: pa.Table) -> dict[int, np.ndarray]:
    rows = answers.to_pylist()
    return {r["bucket"]: unpack_array(r["data"], np.uint32) for r in rows if r["kind"] == _HITS}


def _table(schema: pa.Schema, columns: list) -> pa.Table:
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


_MESSAGE_ARROW = pa.schema([("bucket", pa.int32()), ("chunk", pa.int32()), ("data", pa.binary())])
_ANSWER_ARROW = pa.schema([("chunk", pa.int32()), ("bucket", pa.int32()), ("kind", pa.int32()), ("data", pa.binary())])
_SPANS = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))
_FOUND_ARROW = pa.schema([("id", pa.int64()), ("key", pa.int64()), ("copies", pa.int64()), ("n_words", pa.int64()), ("spans", _SPANS), ("kept", pa.string())])


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compressed texts; rows that repeat inside the batch become one with a count."""
    zip_ = zstandard.ZstdCompressor(level=1).compress
    for batch in batches:
        found: dict[tuple, list] = {}
        chunk, ids, keys = (batch.column(i).to_pylist() for i in range(3))
        for c, i, key, text in zip(chunk, ids, keys, texts(batch.column(3)), strict=True):
            row = found.setdefault((c, i, key), [0, text])
            row[0] += 1
        columns = [*map(list, zip(*found, strict=True))] if found else [[], [], []]
        arrays = [pa.array(x, t) for x, t in zip(columns, (pa.int32(), pa.int64(), pa.int64()), strict=True)]
        arrays += [pa.array([n for n, _ in found.values()], pa.int64()), pa.array([zip_(t) for _, t in found.values()], pa.binary())]
        yield pa.RecordBatch.from_arrays(arrays, names=["chunk", "id", "key", "copies", "packed"])


def _send_blocks(window: int, buckets: int):
    def send(rows: pa.Table) -> pa.Table:
        chunk = rows.column("chunk")[0].as_py()
        entry = np.unique(Chunk(rows, window, buckets).blocks()[1])
        out = []
        for bucket, lo, hi in _by_bucket(entry >> np.uint64(32)):
            part = (entry[lo:hi] & _LOW).astype(np.uint32)
            out.append((bucket, chunk, pack_array(np.diff(part, prepend=np.uint32(0)))))
        return _table(_MESSAGE_ARROW, list(zip(*out, strict=True)) or [[], [], []])

    return send


def _meet_blocks(rows: pa.Table) -> pa.Table:
    """One bucket: hashes that came at least twice, once as an index block."""
    bucket = rows.column("bucket")[0].as_py()
    chunks = rows.column("chunk").to_pylist()
    parts = [np.cumsum(unpack_array(d, np.uint32), dtype=np.uint32) for d in rows.column("data").to_pylist()]
    every = np.sort(np.concatenate(parts))
    group = np.flatnonzero(np.concatenate([[True], (every[1:] >> 1) != (every[:-1] >> 1)]))
    counts = np.diff(np.append(group, len(every)))
    met = (every[group] >> 1)[(counts > 1) & (np.maximum.reduceat(every & 1, group) == 1)]
    out = []
    for chunk, part in zip(chunks, parts, strict=True):
        mine = np.intersect1d(np.unique(part >> 1), met, assume_unique=True)
        if len(mine):
            out.append((chunk, bucket, _HITS, pack_array(mine.astype(np.uint32))))
    return _table(_ANSWER_ARROW, list(zip(*out, strict=True)) or [[], [], [], []])


def _send_windows(window: int, buckets: int):
    def send(rows: pa.Table, answers: pa.Table) -> pa.Table:
        out = []
        if rows.num_rows:
            number = rows.column("chunk")[0].as_py()
            chunk = Chunk(rows, window, buckets)
            places, which, bucket, a, b = chunk.candidates(_hits_of(answers))
            low = chunk.smallest(places, which, len(bucket))[1]
            for k, lo, hi in _by_bucket(bucket):
                parts = [pack_array(a[lo:hi]), pack_array(b[lo:hi].astype(np.uint32)), pack_array(low[lo:hi])]
                sizes = np.array([len(p) for p in parts], np.int64).tobytes()
                out.append((k, number, sizes + b"".join(parts)))
        return _table(_MESSAGE_ARROW, list(zip(*out, strict=True)) or [[], [], []])

    return send


def _first_windows(rows: pa.Table) -> pa.Table:
    """One bucket: for each window of each chunk, whether another chunk has it in a smaller document."""
    bucket = rows.column("bucket")[0].as_py()
    parts = []
    for data in rows.column("data").to_pylist():
        n = np.frombuffer(data[:24], np.int64).cumsum() + 24
        parts.append((unpack_array(data[24 : n[0]], np.uint64), unpack_array(data[n[0] : n[1]], np.uint32), unpack_array(data[n[1] : n[2]], np.int64)))
    a, b, low = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.lexsort((low, b, a))
    new = np.ones(len(order), bool)
    new[1:] = (a[order][1:] != a[order][:-1]) | (b[order][1:] != b[order][:-1])
    first = low[order][np.flatnonzero(new)][np.cumsum(new) - 1]
    earlier = np.empty(len(order), bool)
    earlier[order] = first < low[order]
    out, lo = [], 0
    for chunk, (x, _, _) in zip(rows.column("chunk").to_pylist(), parts, strict=True):
        bits = earlier[lo : lo + len(x)]
        lo += len(x)
        if bits.any():
            out.append((chunk, bucket, _BITS, np.packbits(bits).tobytes()))
    return _table(_ANSWER_ARROW, list(zip(*out, strict=True)) or [[], [], [], []])


def _finish(window: int, buckets: int):
    def finish(rows: pa.Table, answers: pa.Table) -> pa.Table:
        if not rows.num_rows:
            return _FOUND_ARROW.empty_table()
        chunk = Chunk(rows, window, buckets)
        places, which, bucket, _, _ = chunk.candidates(_hits_of(answers))
        ids, low = chunk.smallest(places, which, len(bucket))
        bits = {r["bucket"]: r["data"] for r in answers.to_pylist() if r["kind"] == _BITS}
        earlier = np.zeros(len(bucket), bool)
        for k, lo, hi in _by_bucket(bucket):
            if k in bits:
                earlier[lo:hi] = np.unpackbits(np.frombuffer(bits[k], np.uint8), count=hi - lo)
        gone = places[earlier[which] | (ids > low[which])]
        change = np.zeros(len(chunk.hashes) + 1, np.int64)
        np.add.at(change, gone, 1)
        np.add.at(change, gone + window, -1)
        removed = np.cumsum(change[:-1]) > 0
        spans, kept = [], []
        for words, lo, hi in zip(chunk.words, chunk.starts.tolist(), chunk.ends.tolist(), strict=True):
            mask = removed[lo:hi]
            if not mask.any():
                spans.append([])
                kept.append(b" ".join(words))
                continue
            step = np.diff(np.concatenate([[0], mask.view(np.int8), [0]]))
            spans.append([{"first": x, "last": y - 1} for x, y in zip(np.flatnonzero(step == 1).tolist(), np.flatnonzero(step == -1).tolist(), strict=True)])
            kept.append(b" ".join([words[i] for i in np.flatnonzero(~mask).tolist()]))
        columns = [[k[0] for k in chunk.keys], [k[1] for k in chunk.keys], chunk.copies, chunk.lengths, spans]
        arrays = [pa.array(c, f.type) for c, f in zip(columns, _FOUND_ARROW, strict=False)]
        return pa.Table.from_arrays([*arrays, pa.array(kept, pa.binary()).cast(pa.string())], schema=_FOUND_ARROW)

    return finish


def find_repeats(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", chunk_bytes: int = CHUNK_BYTES, bucket_windows: int = BUCKET_WINDOWS) -> DataFrame:
    """One row for each distinct (id, text): id, key (XXH64 of the text), copies (how many rows), n_words,
    spans (removed word ranges, both ends included, disjoint and ordered) and kept (the other words, joined by one space)."""
    if not isinstance(docs.schema[id_col].dataType, IntegralType):
        raise ValueError("ids must be whole numbers")
    scratch = Scratch(docs.sparkSession, "repeats")
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text.alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    chunks = size // chunk_bytes + 1
    buckets = size // 6 // bucket_windows + 1
    rows = rows.withColumn("key", F.xxhash64("text"))
    dealt = rows.select(F.pmod(F.xxhash64("id", "key"), F.lit(chunks)).cast("int").alias("chunk"), "id", "key", "text")
    packed = dealt.mapInArrow(_pack, _PACKED)
    blocks = packed.groupBy("chunk").applyInArrow(_send_blocks(window, buckets), _MESSAGE)
    hits = scratch.keep(blocks.groupBy("bucket").applyInArrow(_meet_blocks, _ANSWER))
    windows = packed.groupBy("chunk").cogroup(hits.groupBy("chunk")).applyInArrow(_send_windows(window, buckets), _MESSAGE)
    bits = scratch.keep(windows.groupBy("bucket").applyInArrow(_first_windows, _ANSWER))
    answers = hits.unionByName(bits)
    return packed.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(_finish(window, buckets), _FOUND)


def remove_repeats(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", **sizes: int) -> DataFrame:
    """``docs`` with the repeats cut out of the text; texts that lose nothing stay as they are."""
    key, kept, own = (free_name(docs, x) for x in ("key", "kept", "own_id"))
    cut = find_repeats(docs, window, id_col, text_col, **sizes).where(F.size("spans") > 0)
    cut = cut.select(F.col("id").alias(own), F.col("key").alias(key), F.col("kept").alias(kept))
    same = (docs[id_col].cast("long") == cut[own]) & (F.xxhash64(docs[text_col]) == cut[key])
    return docs.join(cut, same, "left").withColumn(text_col, F.coalesce(F.col(kept), F.col(text_col))).select(*docs.columns)


def op13_substring_dedup(spark, sf_dir: str) -> DataFrame:
    """Words of every document that a 13-word sequence of an earlier document covers."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"] + 1)
    found = find_repeats(docs).withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    return found.select(
        F.col("id").alias("doc_id"),
        "n_words",
        removed.alias("n_removed"),
        F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"),
    )
