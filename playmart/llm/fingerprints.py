"""Document fingerprints: bottom-k sketches of word-shingle hashes.

DataFrame functions only. The sketch of a text is the sorted array of its ``k`` smallest
distinct 64-bit shingle hashes (five words; a shorter text is one shingle). Sketches of
parts merge into the sketch of the whole; two sketches estimate resemblance and containment,
and one estimates the number of distinct shingles.

Defined results: a NULL, empty or blank text has the empty sketch; two empty sketches are
alike (1), an empty and another one aren't (0); repeated rows are sketched row by row.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import table

SHINGLE, K = 5, 128
_SPACE = r"[\x20\x09-\x0D]+"
_TWO_64 = float(2**64)


def word_hashes(text: Column) -> Column:
    """Hashes of the words (runs without ASCII white space) of a text."""
    words = F.split(F.coalesce(text, F.lit("")), _SPACE)
    return F.transform(F.filter(words, lambda w: w != ""), lambda w: F.xxhash64(w))


def shingle_hashes(hashes: Column, size: int = SHINGLE) -> Column:
    """Hashes of all shingles; ``hashes`` must be a column, not an expression, as each shingle reads it."""
    n = F.size(hashes)
    many = F.transform(F.sequence(F.lit(0), n - size), lambda i: F.xxhash64(*[F.get(hashes, i + j) for j in range(size)]))
    none = F.array().cast("array<bigint>")
    return F.when(n == 0, none).when(n <= size, F.array(F.xxhash64(hashes))).otherwise(many)


def bottom_k(hashes: Column, k: int = K) -> Column:
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, k)


def with_sketch(df: DataFrame, text: Column, out: str, size: int = SHINGLE, k: int = K) -> DataFrame:
    """``df`` with the sketch of ``text`` in the column ``out``."""
    # explode of a one-element array keeps the word hashes as a computed column: an inlined
    # expression would be evaluated again for every shingle.
    name = f"__{out}_words"
    hashed = df.select("*", F.explode(F.array(word_hashes(text))).alias(name))
    return hashed.withColumn(out, bottom_k(shingle_hashes(F.col(name), size), k)).drop(name)


def merge(a: Column, b: Column, k: int = K) -> Column:
    """Sketch of the union of two parts."""
    return bottom_k(F.concat(a, b), k)


def merge_parts(df: DataFrame, key: str, sketch: str, k: int = K) -> DataFrame:
    """(key, sketch): the merged sketch of all rows of a key.

    The rows' hashes are ranked per key; every task passes on at most ``k`` rows a key, so a hot
    key's group is never gathered.
    """
    hashes = df.select(F.col(key), F.explode(sketch).alias("__h")).distinct()
    lowest = hashes.withColumn("__n", F.row_number().over(Window.partitionBy(key).orderBy("__h"))).where(F.col("__n") <= k)
    merged = lowest.groupBy(key).agg(F.sort_array(F.collect_list("__h")).alias(sketch))
    none = F.array().cast("array<bigint>")
    empty = df.select(key).distinct().join(merged, df[key].eqNullSafe(merged[key]), "left_anti").select(key, none.alias(sketch))
    return merged.unionAll(empty)


def _scaled(h: Column) -> Column:
    """A hash as a fraction of its range."""
    return (h.cast("double") + 2.0**63) / _TWO_64


def distinct_shingles(sketch: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles; exact below ``k``."""
    n = F.size(sketch)
    return F.when(n < k, n.cast("double")).otherwise((k - 1) / _scaled(F.element_at(sketch, -1)))


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of the union's distinct shingles that both texts have."""
    union = merge(a, b, k)
    both = F.size(F.array_intersect(F.array_intersect(union, a), b))
    return F.when(F.size(union) == 0, F.lit(1.0)).otherwise(both / F.size(union))


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of the first text's distinct shingles that the second has."""
    union = merge(a, b, k)
    both = resemblance(a, b, k) * distinct_shingles(union, k)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), both / distinct_shingles(a, k)))


def encode(sketch: Column) -> Column:
    """The sketch as text: 16 hex digits a hash."""
    return F.lower(F.array_join(F.transform(sketch, lambda h: F.lpad(F.hex(h), 16, "0")), ""))


def _range_of(value: Column, cuts: list) -> Column:
    """How many of the ascending ``cuts`` are at least ``value`` (range 0 has the largest values);
    NULL comes after all. Two levels keep it to about 2 * sqrt(cuts) comparisons a row."""
    if not cuts:
        return F.when(value.isNull(), F.lit(1)).otherwise(F.lit(0))
    width = math.isqrt(len(cuts)) + 1
    chunks = [cuts[i : i + width] for i in range(0, len(cuts), width)]
    lits = lambda xs: F.array(*[F.lit(x) for x in xs])
    chunk = F.size(F.filter(lits([c[-1] for c in chunks]), lambda c: c < value))  # chunks wholly below
    inside = F.size(F.filter(F.get(F.array(*[lits(c) for c in chunks]), chunk), lambda c: c >= value))
    later = F.get(lits([len(cuts) - i - len(c) for i, c in zip(range(0, len(cuts), width), chunks)]), chunk)
    at = F.when(chunk >= len(chunks), F.lit(0)).otherwise(inside + later)
    return F.when(value.isNull(), F.lit(len(cuts) + 1)).otherwise(at).cast("int")


def with_next(docs: DataFrame, out: str, id_col: str = "doc_id", text_col: str = "text", rows_per_range: int = 1500, max_ranges: int = 20_000) -> DataFrame:
    """(id, text, out): the text of the next row by descending id (NULL ids last, equal ids
    by text; after the last row: the first), in a column named ``out``.

    Rows are dealt to id ranges whose cut points are literals, so a range is a pure function
    of the row. The head of each range is copied into the range before it, where it follows
    the last row; one small table of range heads (ids only) is all that crosses ranges.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    n = rows.select("id").count()
    ranges = min(max_ranges, max(1, n // rows_per_range))
    shares = [i / ranges for i in range(1, ranges)]
    cuts = rows.agg(F.percentile_approx("id", shares, 10 * ranges)).first()[0] if shares else []
    cuts = sorted(set(cuts or []))
    ranged = rows.withColumn("at", _range_of(F.col("id"), cuts))
    # A row per range that has rows, at most max_ranges + 1: its head and the range before it.
    heads, by_range = ranged.groupBy("at").agg(F.max("id").alias("head")), Window.orderBy("at")
    before = F.coalesce(F.lag("at").over(by_range), F.max("at").over(Window.partitionBy()))
    heads = heads.select("head", before.alias("to"))
    copies = rows.join(F.broadcast(heads), F.col("id").eqNullSafe(F.col("head"))).select("id", "text", F.col("to").alias("at"), F.lit(True).alias("copy"))
    both = ranged.select("id", "text", "at", F.lit(False).alias("copy")).unionAll(copies)
    order = Window.partitionBy("at").orderBy("copy", F.col("id").desc_nulls_last(), F.col("text").asc_nulls_first())
    return both.select("id", "text", "copy", F.lead("text").over(order).alias(out)).where(~F.col("copy")).drop("copy")


def op7_fingerprints(spark, sf_dir: str) -> DataFrame:
    """Sketches of every document, of its edited text and of the next document, and their likeness."""
    docs = with_next(table(spark, sf_dir, "documents"), "next").select(
        F.col("id").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), F.coalesce("next", F.lit("")).alias("next")
    )
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - half), F.substring("next", F.lit(1), half))
    rows = docs.select("doc_id", n.cast("long").alias("n_chars"), "text", "next", edited.alias("edited"))
    for text, out in (("text", "a"), ("edited", "b"), ("next", "c")):
        rows = with_sketch(rows, F.col(text), out)
    return rows.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        encode(F.col("a")).alias("fingerprint"),
        encode(F.col("b")).alias("edited_fingerprint"),
        resemblance(F.col("a"), F.col("b")).alias("near_edited"),
        resemblance(F.col("a"), F.col("c")).alias("near_next"),
        distinct_shingles(F.col("a")).alias("n_shingles"),
    )
