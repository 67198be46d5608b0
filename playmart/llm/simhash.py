"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Every distinct fingerprint emits all variants within half the radius and the
variants are shuffled. Two fingerprints at most ``radius`` bits apart share a
variant, and fingerprints that share one are at most ``radius`` bits apart, so
linking each member of a variant's group to the group's smallest member finds
every component without listing pairs. The links are deduplicated and their
distance is verified. A group holds distinct fingerprints around one variant, so
its size is bounded by the ball (65 for radius 2), however many copies a text has.

Defined results: NULL and empty texts have fingerprint 0 and link like others; a
text of fewer words than a shingle has one shingle; NULL ids are components' members
without being their smallest id (NULL if a component has no other); repeated rows
each get their own row.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, free_name, space_words, table, texts
from .components import connected_components

SEED = 42
VARIANTS_PER_TASK = 4_000_000
_CHUNK = 1 << 16


def simhash(words: list[bytes], shingle: int) -> int:
    """64-bit fingerprint (signed) of the XXH64 hashes of all word shingles."""
    if not words:
        return 0
    joined, n = b" ".join(words), max(1, len(words) - shingle + 1)
    if n == 1:
        parts = [joined]
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        parts = [joined[s:e] for s, e in zip([0, *ends[: n - 1].tolist()], (ends[shingle - 1 :] - 1).tolist(), strict=True)]
    ones = np.zeros(64, np.int64)
    for i in range(0, n, _CHUNK):
        digests = b"".join([xxhash.xxh64_digest(p, SEED) for p in parts[i : i + _CHUNK]])
        ones += np.unpackbits(np.frombuffer(digests, np.uint8)).reshape(-1, 64).sum(axis=0, dtype=np.uint32)
    return int(np.packbits(ones * 2 > n).view(">i8")[0])


def fingerprint_udf(shingle: int):
    @F.arrow_udf("long")
    def fingerprint(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            yield pa.array([simhash(space_words(t), shingle) for t in texts(column)], pa.int64())

    return fingerprint


def _masks(weight: int) -> list[tuple[int, int]]:
    out = []
    for w in range(weight + 1):
        for bits in combinations(range(64), w):
            m = sum(1 << b for b in bits)
            out.append((m - (1 << 64) if m >> 63 else m, w))
    return out


def ball_links(fingerprints: DataFrame, radius: int, col: str = "fp") -> DataFrame:
    """Verified links (a, b) that connect all distinct fingerprints within ``radius`` bits.

    For an odd radius one end comes from the smaller ball and one from the larger.
    """
    small = radius // 2
    ball = _masks(radius - small)
    masks = F.array(*[F.struct(F.lit(m).cast("long").alias("m"), F.lit(w <= small).alias("near")) for m, w in ball])
    # Every fingerprint becomes a whole ball, so the tasks that emit are sized by the variants.
    tasks = max(1, fingerprints.count() * len(ball) // VARIANTS_PER_TASK)
    out = fingerprints.repartition(tasks, col).select(F.col(col).alias("a"), F.inline(masks)).select(F.col("a").bitwiseXOR(F.col("m")).alias("variant"), "a", "near")
    centre = F.min(F.when(F.col("near"), F.col("a"))).over(Window.partitionBy("variant"))
    pairs = out.select("a", centre.alias("b")).where("a != b").distinct()
    return pairs.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius)


def components(nodes: DataFrame, radius: int, scratch: Scratch) -> DataFrame:
    """nodes: (fp, low), fp distinct -> (fp, low, root); root names the component of a fingerprint."""
    roots = connected_components(ball_links(nodes.select("fp"), radius), "a", "b", scratch)
    # Fingerprints without a link are their own component.
    return nodes.join(roots, nodes["fp"] == roots["node"], "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, radius: int = 2, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document row: id_col, fp (long) and component_id (the component's smallest id)."""
    scratch = Scratch(docs.sparkSession, "simhash")
    fps = scratch.keep(docs.select(F.col(id_col), fingerprint_udf(shingle)(F.col(text_col)).alias("fp")))
    nodes = scratch.keep(fps.groupBy("fp").agg(F.min(id_col).alias("low")))
    member = components(nodes, radius, scratch)
    lows = member.groupBy("root").agg(F.min("low").alias("component_id"))
    return fps.join(member.join(lows, "root").select("fp", "component_id"), "fp").select(id_col, "fp", "component_id")


def keep_one(docs: DataFrame, radius: int = 2, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The document with the smallest id of each component (NULL ids come last), all columns unchanged.

    Of rows that repeat that document's id and fingerprint, the first by content stays.
    """
    scratch = Scratch(docs.sparkSession, "keep-one")
    fp, low, n = free_name(docs, "fp"), free_name(docs, "low"), free_name(docs, "n")
    marked = scratch.keep(docs.withColumn(fp, fingerprint_udf(shingle)(F.col(text_col))))
    nodes = scratch.keep(marked.groupBy(F.col(fp).alias("fp")).agg(F.min(id_col).alias("low")))
    first = F.min_by(F.struct("fp", "low"), F.struct(F.col("low").isNull(), "low", "fp")).alias("k")
    keepers = components(nodes, radius, scratch).groupBy("root").agg(first).select(F.col("k.fp").alias(fp), F.col("k.low").alias(low))
    same = marked[id_col].eqNullSafe(keepers[low]) & (marked[fp] == keepers[fp])
    kept = marked.join(keepers, same).groupBy(keepers[fp], keepers[low]).agg(F.count(F.lit(1)).alias(n))
    kept = scratch.keep(kept)

    def rows(which):
        k = kept.where(which)
        return marked.join(k, marked[id_col].eqNullSafe(k[low]) & (marked[fp] == k[fp]), "left_semi")

    repeated = rows(F.col(n) > 1).groupBy(fp, id_col).agg(F.min(F.struct(*[F.col(c) for c in docs.columns])).alias(low))
    return rows(F.col(n) == 1).drop(fp).unionAll(repeated.select(*[F.col(low)[c].alias(c) for c in docs.columns]))


def op5_simhash(spark, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document (3-word shingles, 2 bits)."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = near_duplicates(docs, radius=2, shingle=3)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
