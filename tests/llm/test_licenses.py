import math

import pytest

from playmart.llm import licenses as L
from playmart.llm.common import table

from .helpers import SF, alnum_words, doc, edge_rows, frame, plain, words


def brute(rows, threshold=0.85, block=64):
    out = []
    for i, text in rows:
        w, starts, base, labels, best = alnum_words(text), [], set(), set(), 0.0
        for phrase, label in L.PHRASES.items():
            p = phrase.split()
            at = [k for k in range(len(w)) if w[k : k + len(p)] == p]
            starts += at
            base |= {label} if at else set()
        for s in range(0, max(1, len(w) - block // 2), block // 2):
            part = set(w[s : s + block])
            for label, template in L.TEMPLATES:
                t = set(template.split())
                if len(t & part) >= math.ceil(threshold * len(t) - 1e-9):
                    labels.add(label)
                    best = max(best, len(t & part) / len(t))
        score = 1.0 if starts else best
        first, last = (min(starts), max(starts)) if starts else (None, None)
        out.append((i, len(w), len(starts), first, last, ",".join(sorted(base)), ",".join(sorted(base | labels)), score))
    return sorted(out, key=lambda t: [(v is None, str(v)) for v in t])


def scan(docs):
    from pyspark.sql import functions as F

    return L.scan_licenses(docs).withColumns({c: F.array_join(c, ",") for c in ("base_labels", "labels")})


def test_query_equals_brute_force(spark):
    rows = [tuple(r) for r in table(spark, SF, "documents").select("doc_id", "text").collect()]
    got = plain(L.op6_licenses(spark, SF))
    assert got == brute(rows) and any(r[2] for r in got) and any(r[6] != r[5] for r in got)


def test_edges(spark):
    mit = dict((k, t) for k, t in L.TEMPLATES if k == "mit")["mit"]
    rows = [
        *edge_rows(), doc(30, "CC BY cc-by CC BY"), doc(31, "all rights reserved"), doc(32, "General Public License! general public  license x"),
        doc(33, " ".join(words(31, 5)) + " " + mit + " " + " ".join(words(90, 6))), doc(34, " ".join(words(50, 7)) + " " + " ".join(mit.split()[3:])),
        doc(35, " ".join(reversed(mit.split()))), doc(36, "cc" + " by" * 3), doc(37, "Apache License Version 2 0 Licensed under the"),
        *[doc(40 + k, " ".join([*words(k, 8), "permission", *mit.split()])) for k in range(25, 40)],
    ]
    assert plain(scan(frame(spark, rows, clash=True))) == brute([r[:2] for r in rows])


def test_empty_table_and_no_template_words(spark):
    assert scan(frame(spark, [])).count() == 0
    assert plain(scan(frame(spark, [doc(1, "zzz yyy")]))) == [(1, 2, 0, None, None, "", "", 0.0)]


def test_long_templates_are_found_at_every_offset(spark):
    """The block follows the longest template; one that is too short for it is refused."""
    long = " ".join(f"term{k}" for k in range(90))
    middle = " ".join(f"part{k}" for k in range(50))
    templates = [("long", long), ("middle", middle)]
    fill = lambda n: " ".join(f"w{k % 7}" for k in range(n))
    rows = [doc(2 * k, f"{fill(k)} {long} {fill(40)}") for k in range(0, 200, 9)] + [doc(2 * k + 1, f"{fill(k)} {middle} {fill(40)}") for k in range(0, 200, 9)]
    got = {r.doc_id: (r.labels, r.score) for r in L.scan_licenses(frame(spark, rows), templates, phrases={"no such phrase": "x", "nor this one": "y"}).collect()}
    assert got == {i: (["long"], 1.0) if i % 2 == 0 else (["middle"], 1.0) for i in got} and len(got) == len(rows)
    with pytest.raises(ValueError):
        L.scan_licenses(frame(spark, rows), templates, block=64)
