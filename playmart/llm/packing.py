"""Bounded-space online packing of token sequences.

Every task keeps at most ``windows`` open windows. A document (its ids, then the end
id) first fills whole windows of its own; the rest goes best-fit into the open window
it leaves fullest. When none fits and no window can be opened, the fullest is filled
up with a cut and emitted, or emitted as it is when its gap is within ``tolerance``.
What the tasks leave open is merged by groups of ``merge`` tasks in the same way, and
the one window a group leaves unfilled is cut into sequences of a power of two, which
need no padding. Memory per task is bounded by the open windows, not by the input.

Defined results: a NULL or empty text is the end id alone; NULL ids and repeated
rows are packed row by row; an empty table packs to nothing. Only the id and text
columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, slices, table

END_ID = 1
_SPECIAL = "<|endoftext|>"  # the only special token of the vocabulary


def vocabulary_pieces(json_path: str) -> dict[bytes, int]:
    """Bytes and id of each piece of a byte-level vocabulary file, special tokens left out."""
    import json

    with open(json_path, encoding="utf-8") as f:
        vocab = json.load(f)["model"]["vocab"]
    # Byte-level vocabularies write each byte as one printable character.
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    byte_of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(plain))}
    return {bytes(byte_of[c] for c in piece): i for piece, i in vocab.items() if piece != _SPECIAL}


@lru_cache(maxsize=2)
def _encoder(json_path: str):
    """The vocabulary file's encoder. tiktoken runs the same merges several times
    faster; a text with a special token's string is left to ``tokenizers``."""
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    ranks = vocabulary_pieces(json_path)
    fast = tiktoken.Encoding("byte-bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    exact = Tokenizer.from_file(json_path)

    def encode(text: str) -> np.ndarray:
        ids = exact.encode(text, add_special_tokens=False).ids if _SPECIAL in text else fast.encode_ordinary(text)
        ids.append(END_ID)
        return np.array(ids, np.uint32)

    return encode


class Piece:
    __slots__ = ("doc", "start", "total", "ids")

    def __init__(self, doc, start: int, total: int, ids: np.ndarray):
        self.doc, self.start, self.total, self.ids = doc, start, total, ids

    def split(self, n: int) -> tuple[Piece, Piece]:
        return Piece(self.doc, self.start, self.total, self.ids[:n]), Piece(self.doc, self.start + n, self.total, self.ids[n:])


class Packer:
    """Open windows of one task; ``emit(pieces)`` takes each finished sequence."""

    def __init__(self, size: int, windows: int, tolerance: int, emit):
        self.size, self.windows, self.tolerance, self.emit = size, windows, tolerance, emit
        self.open: list[list[Piece]] = []
        self.fill: list[int] = []

    def add(self, piece: Piece) -> None:
        while len(piece.ids) >= self.size:
            whole, piece = piece.split(self.size)
            self.emit([whole])
        while n := len(piece.ids):
            fits = [f for f in self.fill if f + n <= self.size]
            if fits:
                self._put(self.fill.index(max(fits)), piece)
                return
            if len(self.open) < self.windows:
                self.open.append([Piece(piece.doc, piece.start, piece.total, piece.ids.copy())])
                self.fill.append(n)
                return
            i = self.fill.index(max(self.fill))
            gap = self.size - self.fill[i]
            if gap <= self.tolerance:
                self._close(i)
            else:
                head, piece = piece.split(gap)
                self._put(i, head)

    def _put(self, i: int, piece: Piece) -> None:
        self.open[i].append(Piece(piece.doc, piece.start, piece.total, piece.ids.copy()))
        self.fill[i] += len(piece.ids)
        if self.fill[i] == self.size:
            self._close(i)

    def _close(self, i: int) -> None:
        self.emit(self.open.pop(i))
        self.fill.pop(i)

    def finish(self) -> None:
        """Pours the emptiest windows into the fullest; the last one becomes powers of two."""
        while len(self.open) > 1:
            source = self.fill.index(min(self.fill))
            self.fill.pop(source)
            for piece in self.open.pop(source):
                while len(piece.ids):
                    i = self.fill.index(max(self.fill)) if self.fill else -1
                    if i < 0:
                        self.open.append([])
                        self.fill.append(0)
                        i = 0
                    head, piece = piece.split(min(self.size - self.fill[i], len(piece.ids)))
                    self._put(i, head)
        rest = self.open.pop() if self.open else []
        left = self.fill.pop() if self.fill else 0
        while left:
            part, room = [], 1 << (left.bit_length() - 1)
            left -= room
            while room:
                piece = rest.pop(0)
                if len(piece.ids) > room:
                    piece, tail = piece.split(room)
                    rest.insert(0, tail)
                part.append(piece)
                room -= len(piece.ids)
            self.emit(part)


class _Rows:
    """Pieces of finished sequences, as Arrow batches."""

    def __init__(self, schema: pa.Schema, first_id: int):
        self.schema, self.next_id, self.rows = schema, first_id, []

    def emit(self, pieces: list[Piece], final: bool = True) -> None:
        offset = 0
        for p in pieces:
            self.rows.append((p.doc, p.start, len(p.ids), p.total, self.next_id, offset, p.ids.astype("<u4").tobytes(), final))
            offset += len(p.ids)
        self.next_id += 1

    def batch(self) -> pa.RecordBatch:
        cols = list(zip(*self.rows, strict=True)) if self.rows else [[] for _ in self.schema]
        self.rows = []
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, self.schema, strict=True)], schema=self.schema)


def _arrow_schema(id_type: pa.DataType) -> pa.Schema:
    longs = [(c, pa.int64()) for c in ("start", "length", "doc_tokens", "sequence_id", "offset")]
    return pa.schema([("doc_id", id_type), *longs, ("ids", pa.binary()), ("final", pa.bool_())])


def pack_documents(
    docs: DataFrame,
    vocabulary: str,
    size: int = 2048,
    windows: int = 32,
    tolerance: int = 16,
    merge: int = 16,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Pieces (doc_id, start, length, doc_tokens, sequence_id, offset, ids) of all sequences.

    ``ids`` holds the piece's ids as little-endian unsigned 32-bit numbers.
    """
    scratch = Scratch(docs.sparkSession, "packing")
    schema = f"doc_id {docs.schema[id_col].dataType.simpleString()}, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary, final boolean"

    def online(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, out = _encoder(vocabulary), None
        for b in batches:
            if out is None:
                out = _Rows(_arrow_schema(b.schema.field(0).type), TaskContext.get().partitionId() << 33)
                packer = Packer(size, windows, tolerance, out.emit)
            column = [t or "" for t in b.column(1).to_pylist()]
            keys = b.column(0).to_pylist()
            for lo, hi in slices(column, 4 << 20):
                for i in range(lo, hi):
                    ids = encode(column[i])
                    packer.add(Piece(keys[i], 0, len(ids), ids))
                yield out.batch()
        if out is not None:
            for pieces in packer.open:
                out.emit(pieces, final=False)
            yield out.batch()

    def leftovers(group: pa.Table) -> pa.Table:
        group = group.sort_by([("sequence_id", "ascending"), ("offset", "ascending")])
        pid = group.column("sequence_id")[0].as_py() >> 33
        out = _Rows(_arrow_schema(group.schema.field("doc_id").type), (1 << 62) + (pid // merge << 33))
        packer = Packer(size, windows, tolerance, out.emit)
        pieces = [Piece(r["doc_id"], r["start"], r["doc_tokens"], np.frombuffer(r["ids"], "<u4")) for r in group.to_pylist()]
        for p in sorted(pieces, key=lambda p: -len(p.ids)):
            packer.add(p)
        packer.finish()
        return pa.Table.from_batches([out.batch()])

    packed = scratch.keep(docs.select(F.col(id_col), F.col(text_col)).mapInArrow(online, schema))
    group = F.shiftright("sequence_id", 33 + (merge.bit_length() - 1))
    merged = packed.where(~F.col("final")).groupBy(group).applyInArrow(leftovers, schema)
    return packed.where("final").unionAll(merged).drop("final")


def byte_bpe_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op10_packing(spark, sf_dir: str) -> DataFrame:
    """All documents in sequences of 2048 tokens."""
    pieces = pack_documents(table(spark, sf_dir, "documents"), byte_bpe_path())
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
