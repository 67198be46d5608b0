import hashlib
import random

import pytest
from pyspark.sql import functions as F

from playmart.llm import fingerprints as P
from playmart.llm.common import table

from .helpers import SF, doc, edge_rows, frame, words


def next_of(rows):
    """(id, text, next text) by descending id, NULLs last, equal ids by text (NULL first)."""
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] is not None, r[1] or ""))
    return [(i, t, order[(k + 1) % len(order)][1]) for k, (i, t) in enumerate(order)]


def test_query_edits_every_document(spark):
    rows = [tuple(r) for r in table(spark, SF, "documents").select("doc_id", "text").collect()]
    want = {}
    for i, t, after in next_of(rows):
        half = len(t) // 2
        want[i] = (len(t), t[: len(t) - half] + after[:half])
    got = P.op7_fingerprints(spark, SF).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.n_chars, r.edited_sha256) == (want[r.doc_id][0], hashlib.sha256(want[r.doc_id][1].encode()).hexdigest())
    by_text = {}
    for i, t in rows:
        by_text.setdefault(t, set()).add(next(r.fingerprint for r in got if r.doc_id == i))
    assert all(len(f) == 1 for f in by_text.values())


@pytest.mark.parametrize("rows_per_range", [1, 3, 1500])
def test_next_document_over_ranges(spark, rows_per_range):
    rows = [*edge_rows(), *[doc(1000 + 37 * k, f"text {k}") for k in range(60)]]
    got = P.with_next(frame(spark, rows, clash=True), "after", rows_per_range=rows_per_range).collect()
    key = lambda t: [(v is None, str(v)) for v in t]
    assert sorted(map(tuple, got), key=key) == sorted(next_of([r[:2] for r in rows]), key=key)
    one = P.with_next(frame(spark, [doc(5, "alone")]), "after").collect()
    assert [tuple(r) for r in one] == [(5, "alone", "alone")]
    assert P.with_next(frame(spark, []), "after").count() == 0


def test_estimates_against_exact_sets(spark):
    rnd, rows = random.Random(1), []
    for k in range(30):
        a = words(rnd.randint(100, 1500), k, 3000)
        b = a[: rnd.randint(0, len(a))] + words(rnd.randint(0, 900), k + 100, 3000)
        rows.append((k, " ".join(a), " ".join(b)))
    rows += [(50, "", ""), (51, "one two", "one two"), (52, "", "x"), (53, "a b c d e", "a b c d f")]
    df = spark.createDataFrame(rows, "k int, a string, b string")
    df = P.with_sketch(P.with_sketch(df, F.col("a"), "x"), F.col("b"), "y")
    a, b = F.col("x"), F.col("y")
    got = df.select("k", P.resemblance(a, b), P.containment(a, b), P.distinct_shingles(a)).collect()

    def shingles(t):
        w = t.split()
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    sets = {k: (shingles(x), shingles(y)) for k, x, y in rows}
    errors = []
    for k, r, c, n in map(tuple, got):
        x, y = sets[k]
        exact = len(x & y) / len(x | y) if x | y else 1.0
        errors.append(abs(r - exact))
        assert abs(r - exact) < 0.2 and abs(n - len(x)) <= (0 if len(x) < P.K else 0.4 * len(x))
        assert abs(c - (len(x & y) / len(x) if x else 1.0)) < 0.3
    assert sum(errors) / len(errors) < 0.05


def test_merged_parts_equal_the_whole(spark):
    parts = [(k % 3 if k % 7 else None, " ".join(words(60 + k, k))) for k in range(40)] + [(9, ""), (9, None)]
    df = P.with_sketch(spark.createDataFrame(parts, "g int, t string"), F.col("t"), "s")
    merged = {r.g: r.s for r in P.merge_parts(df, "g", "s").collect()}
    for g in {g for g, _ in parts}:
        sketches = [r.s for r in df.where(F.col("g").eqNullSafe(F.lit(g))).collect()]
        assert merged[g] == sorted(set(h for s in sketches for h in s))[: P.K]
    two = df.where("g = 1").limit(2).agg(F.collect_list("s").alias("l")).select(P.merge(F.col("l")[0], F.col("l")[1]).alias("m"), "l").first()
    assert two.m == sorted(set(two.l[0]) | set(two.l[1]))[: P.K]
