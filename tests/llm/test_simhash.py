import random

import pytest
import xxhash
from pyspark.sql import functions as F

from playmart.llm import simhash as S
from playmart.llm.common import Scratch, table
from playmart.llm.components import connected_components

from .helpers import SF, doc, edge_rows, frame, plain, space_words, words


def fingerprint(text, k=3):
    w = space_words(text)
    if not w:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(w[i : i + k]).encode(), 42) for i in range(max(1, len(w) - k + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(items, near):
    """Smallest label of each node's component; None comes last."""
    root = list(range(len(items)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(items)):
        for j in range(i):
            if near(items[i], items[j]):
                root[find(i)] = find(j)
    return [find(i) for i in range(len(items))]


def brute(rows, radius=2):
    fps = [fingerprint(t) for _, t in rows]
    of = classes(fps, lambda a, b: (a ^ b).bit_count() <= radius)
    low = {}
    for (i, _), c in zip(rows, of):
        if i is not None:
            low[c] = min(low.get(c, i), i)
    return sorted(((i, f"{f:016x}", low.get(c)) for (i, _), f, c in zip(rows, fps, of)), key=lambda t: [(v is None, str(v)) for v in t])


def test_query_equals_brute_force(spark):
    rows = [tuple(r) for r in table(spark, SF, "documents").select("doc_id", "text").collect()]
    assert plain(S.op5_simhash(spark, SF)) == brute(rows)


def test_edges(spark):
    rows = edge_rows()
    found = S.near_duplicates(frame(spark, rows, clash=True))
    got = plain(found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")), "component_id"))
    assert got == brute([r[:2] for r in rows])


@pytest.mark.parametrize("radius", [0, 1, 2, 3])
def test_ball_links_connect_like_all_pairs(spark, radius):
    rnd = random.Random(radius)
    fps = set()
    for _ in range(12):  # chains and clusters around random centres
        f = rnd.getrandbits(64)
        for _ in range(8):
            fps.add(f)
            for b in rnd.sample(range(64), rnd.randint(0, 3)):
                f ^= 1 << b
    fps = sorted(f - (1 << 64) if f >> 63 else f for f in fps)
    near = lambda a, b: ((a ^ b) & (1 << 64) - 1).bit_count() <= radius
    links = [tuple(r) for r in S.ball_links(spark.createDataFrame([(f,) for f in fps], "fp long"), radius).collect()]
    assert all(near(a, b) for a, b in links)
    got = classes(fps, lambda a, b: (a, b) in links or (b, a) in links)
    want = classes(fps, near)
    assert len(set(zip(got, want))) == len(set(got)) == len(set(want))


def test_components_of_paths_stars_and_nothing(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(7, k) for k in range(8, 30)] + [(1, 1), (None, 5), (5, None), (40, 41), (41, 40)]
    df = spark.createDataFrame(links, "a long, b long")
    got = dict(map(tuple, connected_components(df, "a", "b", Scratch(spark, "t")).collect()))
    want = {i: 100 for i in range(101, 161)} | {k: 7 for k in range(8, 30)} | {41: 40}
    assert got == want
    assert connected_components(df.where("a < 0"), "a", "b", Scratch(spark, "t")).count() == 0


def test_keep_one(spark):
    copy = " ".join(words(80, 4))
    rows = [*edge_rows(), *[doc(100 + k, copy) for k in range(40)], doc(99, copy), doc(99, copy)]
    docs = frame(spark, rows, clash=True)
    kept = S.keep_one(docs)
    assert kept.columns == docs.columns
    fps = [fingerprint(r[1]) for r in rows]
    of = classes(fps, lambda a, b: (a ^ b).bit_count() <= 2)
    ids = {}
    for r, c in zip(rows, of):
        ids.setdefault(c, []).append(r[0])
    class_of = dict(zip(fps, of))
    got = [(class_of[fingerprint(r.text)], r.doc_id) for r in kept.select("doc_id", "text").collect()]
    # One row of each class: the one with the class's smallest id (NULL if it has no other).
    want = [(c, min((x for x in i if x is not None), default=None)) for c, i in ids.items()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_empty_table(spark):
    assert S.near_duplicates(frame(spark, [])).count() == 0
    assert S.keep_one(frame(spark, [])).count() == 0
