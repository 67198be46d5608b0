import hashlib

import pytest

from playmart.llm import decontaminate as D
from playmart.llm.common import table

from .helpers import SF, alnum_words, doc, edge_rows, frame, plain, words


def brute(docs, items, n=10):
    windows = {}
    for item, text in items:
        w = alnum_words(text)
        for i in range(max(1, len(w) - n + 1) if w else 0):
            windows.setdefault(tuple(w[i : i + n]), set()).add(item)
    out = []
    for i, text in docs:
        w, hit, found = alnum_words(text), set(), set()
        for size in {len(x) for x in windows}:
            for k in range(len(w) - size + 1):
                if got := windows.get(tuple(w[k : k + size])):
                    hit.update(range(k, k + size))
                    found |= got
        found = sorted(str(x) for x in found if x is not None)
        out.append((i, len(w), len(hit), len(found), hashlib.sha256(",".join(found).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=lambda t: [(v is None, str(v)) for v in t])


def test_query_equals_brute_force(spark):
    docs = [tuple(r) for r in table(spark, SF, "documents").select("doc_id", "text").collect()]
    items = [tuple(r) for r in table(spark, SF, "benchmark").select("item_id", "text").collect()]
    got = plain(D.op3_decontaminate(spark, SF))
    assert got == brute(docs, items) and any(r[-1] for r in got)


@pytest.mark.parametrize("max_rows", [400_000, 3])
def test_edges_and_blocks_of_windows(spark, max_rows):
    passage = " ".join(words(25, 9))
    items = [(1, passage), (2, "Rare, SHORT item!"), (3, ""), (4, None), (None, "unnamed item"), (1, passage), (5, "東京 wörds")]
    rows = [*edge_rows(), doc(20, "x " + passage.upper() + " y"), doc(21, passage[:90]), doc(22, "a rare short item rare short item, unnamed item"), doc(23, "no 東京 wörds")]
    docs, bench = frame(spark, rows, clash=True), spark.createDataFrame(items, "item_id long, text string")
    found = D.scan_benchmark(docs, bench, "result", max_rows=max_rows).collect()
    got = []
    for r in found:
        hit = sum(h["last"] - h["first"] + 1 for h in r["result"]["hits"])
        items_of = r["result"]["items"]
        got.append((r["doc_id"], r["result"]["n_words"], hit, len(items_of), hashlib.sha256(",".join(items_of).encode()).hexdigest(), hit > 0))
    assert sorted(got, key=lambda t: [(v is None, str(v)) for v in t]) == brute([r[:2] for r in rows], items)


def test_drop_and_cut_keep_the_rest(spark):
    passage = " ".join(words(25, 9))
    rows = [*edge_rows(), doc(20, f"before, {passage.title()}! after")]
    docs = frame(spark, rows, clash=True)
    bench = spark.createDataFrame([(1, passage)], "item_id long, text string")
    kept = D.drop_contaminated(docs, bench)
    assert kept.columns == docs.columns and plain(kept) == plain(docs.where("doc_id is null or doc_id <> 20"))
    cut = D.remove_spans(docs, bench)
    assert cut.columns == docs.columns and cut.where("doc_id = 20").first().text == "before, ! after"
    assert plain(cut.where("doc_id is null or doc_id <> 20")) == plain(docs.where("doc_id is null or doc_id <> 20"))


def test_empty_tables(spark):
    docs, bench = frame(spark, edge_rows()), spark.createDataFrame([], "item_id long, text string")
    assert plain(D.drop_contaminated(docs, bench)) == plain(docs)
    assert D.drop_contaminated(frame(spark, []), spark.createDataFrame([(1, "x")], "item_id long, text string")).count() == 0
