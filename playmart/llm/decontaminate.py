"""Benchmark decontamination.

The normalised word windows of the benchmark (``n`` consecutive words; an item of
fewer words is one window) form a hash set that is broadcast in blocks of at most
``max_rows`` windows, so its size is bounded whatever the benchmark's size: a larger
benchmark takes further passes over the documents, whose hits are added up row by row.
A task scans the windows of each document: runs of words that all occur in the block
are candidates, and a candidate counts only if its exact words are in the set.

Defined results: NULL and empty texts have no words and no hits; benchmark items
without words never hit; items with a NULL id mark words but are not listed; repeated
item ids count once; repeated documents are scanned row by row; an empty benchmark
hits nothing. Every input column is returned, whatever its name.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, alnum_words, free_name, table, texts

_WORD = re.compile(rb"[^ ]+")
RESULT = "n_words long, hits array<struct<first:int,last:int>>, items array<string>"


def benchmark_windows(benchmark: DataFrame, n: int, item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Distinct (window, item) rows of the benchmark."""

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            grams, items = [], []
            for item, text in zip(b.column(0).to_pylist(), texts(b.column(1)), strict=True):
                w = alnum_words(text)
                for i in range(max(1, len(w) - n + 1) if w else 0):
                    grams.append(b" ".join(w[i : i + n]))
                    items.append(item)
            yield pa.RecordBatch.from_arrays([pa.array(grams, pa.binary()), pa.array(items, pa.string())], names=["gram", "item"])

    cols = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(text_col).alias("text"))
    return cols.mapInArrow(windows, "gram binary, item string").distinct()


class WindowSet:
    """One block of benchmark windows."""

    def __init__(self, rows):
        self.by_length: dict[int, dict[bytes, list]] = {}
        self.vocabulary: set[bytes] = set()
        for gram, item in rows:
            words = gram.split(b" ")
            self.vocabulary.update(words)
            self.by_length.setdefault(len(words), {}).setdefault(gram, []).append(item)

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set]:
        """Merged [first, last] word ranges inside any window, and the items with one."""
        hits, items = [], set()
        if not words or not self.by_length:
            return hits, items
        known = np.zeros(len(words) + 2, np.int8)
        known[1:-1] = list(map(self.vocabulary.__contains__, words))
        step = np.diff(known)
        starts, ends = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
        for size, grams in self.by_length.items():
            long = ends - starts >= size
            for lo, hi in zip(starts[long].tolist(), ends[long].tolist(), strict=True):
                for i in range(lo, hi - size + 1):
                    found = grams.get(b" ".join(words[i : i + size]))
                    if found:
                        hits.append((i, i + size - 1))
                        items.update(found)
        return merge_ranges(hits), items


def merge_ranges(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for lo, hi in sorted(ranges):
        if out and lo <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(out[-1][1], hi))
        else:
            out.append((lo, hi))
    return out


def _scan(block):
    """UDF of one pass: text and the hits of earlier passes -> all hits so far."""

    @F.arrow_udf(RESULT)
    def scan(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        index = block.value
        for column, before in batches:
            out = []
            for text, old in zip(texts(column), before.to_pylist(), strict=True):
                words = alnum_words(text)
                hits, items = index.scan(words)
                if old:
                    hits = merge_ranges(hits + [(h["first"], h["last"]) for h in old["hits"]])
                    items.update(old["items"])
                out.append({"n_words": len(words), "hits": [{"first": a, "last": b} for a, b in hits], "items": sorted(x for x in items if x is not None)})
            yield pa.array(out, RESULT_ARROW)

    return scan.asNondeterministic()  # keeps the optimizer from copying the scan into filters


RESULT_ARROW = pa.struct(
    [
        ("n_words", pa.int64()),
        ("hits", pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))),
        ("items", pa.list_(pa.string())),
    ]
)


def scan_benchmark(docs: DataFrame, benchmark: DataFrame, out: str, n: int = 10, text_col: str = "text", max_rows: int = 400_000) -> DataFrame:
    """``docs`` with the struct column ``out``: n_words, hits (word ranges, both ends
    included, disjoint and ordered) and items (sorted distinct ids)."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "decontaminate")
    grams = scratch.keep(benchmark_windows(benchmark, n))
    blocks = max(1, -(-grams.count() // max_rows))
    # A hash splits the windows into blocks of about max_rows; each block is bounded and broadcast alone.
    block_of = F.pmod(F.xxhash64("gram", "item"), F.lit(blocks))
    for i in range(blocks):
        rows = grams.where(block_of == i).collect()
        scan = _scan(spark.sparkContext.broadcast(WindowSet((bytes(r["gram"]), r["item"]) for r in rows)))
        before = F.col(out) if i else F.lit(None).cast(f"struct<{RESULT}>")
        docs = docs.withColumn(out, scan(F.col(text_col), before))
        if i + 1 < blocks:
            docs = scratch.keep(docs)
    return docs


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, n: int = 10, text_col: str = "text", max_rows: int = 400_000) -> DataFrame:
    """Documents without any benchmark window, all columns unchanged."""
    found = free_name(docs, "found")
    scanned = scan_benchmark(docs, benchmark, found, n, text_col, max_rows)
    return scanned.where(F.size(F.col(found)["hits"]) == 0).drop(found)


def remove_spans(docs: DataFrame, benchmark: DataFrame, n: int = 10, text_col: str = "text", max_rows: int = 400_000) -> DataFrame:
    """All documents, with the text from the first to the last word of each hit range cut out."""
    found = free_name(docs, "found")

    @F.arrow_udf("string")
    def cut(column: pa.Array, hits: pa.Array) -> pa.Array:
        out = []
        for value, ranges in zip(column.cast(pa.binary()).to_pylist(), hits.to_pylist(), strict=True):
            if not ranges:
                out.append(value)
                continue
            from .common import ALNUM_TABLE

            at = [m.span() for m in _WORD.finditer(value.translate(ALNUM_TABLE))]
            kept, end = [], 0
            for r in ranges:
                kept.append(value[end : at[r["first"]][0]])
                end = at[r["last"]][1]
            out.append(b"".join([*kept, value[end:]]))
        return pa.array(out, pa.binary()).cast(pa.string())

    scanned = scan_benchmark(docs, benchmark, found, n, text_col, max_rows)
    return scanned.withColumn(text_col, cut(F.col(text_col), F.col(found)["hits"])).drop(found)


def op3_decontaminate(spark, sf_dir: str) -> DataFrame:
    """Benchmark hits of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    r = F.col("found")
    n_hit = F.aggregate(r["hits"], F.lit(0).cast("long"), lambda a, h: a + h["last"] - h["first"] + 1)
    return scan_benchmark(docs, table(spark, sf_dir, "benchmark"), "found").select(
        "doc_id",
        r["n_words"].alias("n_words"),
        n_hit.alias("n_hit"),
        F.size(r["items"]).cast("long").alias("n_items"),
        F.sha2(F.array_join(r["items"], ",").cast("binary"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )
