import zlib

import numpy as np

from playmart.llm import language_id as L
from playmart.llm.common import table

from .helpers import doc, edge_rows, frame


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    truth = {r.doc_id: r.lang for r in table(spark, sf, "documents").select("doc_id", "lang").collect()}
    rows = L.op2_language_id(spark, sf).collect()
    assert len(rows) == len(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def test_prediction_ignores_lang_source_and_id(spark):
    rows = [doc(k, ("der die und nicht " if k % 2 else "the and of that ") * (3 + k % 9), "de" if k % 2 else "en", f"s{k}") for k in range(60)]
    a = L.identify_languages(frame(spark, rows), "r")
    held = [i for i in range(60) if zlib.crc32(str(i).encode()) % 5 == 0]
    swapped = [doc(i, t, "xx" if i in held else lang, "other") for i, t, lang, _, _ in rows]
    b = L.identify_languages(frame(spark, swapped), "r")
    pick = lambda df: {r.doc_id: tuple(r.r) for r in df.collect()}
    assert pick(a) == pick(b) and {v[0] for v in pick(a).values()} == {"de", "en"}


def test_edges(spark):
    rows = [*edge_rows(), doc(70, "12345 !!!"), doc(71, "Я"), *[doc(100 + k, "der die das und", "de") for k in range(9)]]
    got = {r.doc_id: tuple(r.r) for r in L.identify_languages(frame(spark, rows, clash=True), "r").collect()}
    for i in (1, 2, 3, 70):
        assert got[i] == ("und", 0.0)
    assert got[71][0] in ("de", "en") and got[7][0] == "en"
    one = L.identify_languages(frame(spark, [doc(k, "some text", "en") for k in range(9)]), "r").collect()
    assert {tuple(r.r) for r in one} == {("en", 1.0)}
    nothing = L.identify_languages(frame(spark, [doc(1, "some text", None)]), "r").collect()
    assert [tuple(r.r) for r in nothing] == [("und", 0.0)]
    assert L.identify_languages(frame(spark, []), "r").count() == 0


def test_pair_tables_equal_the_plain_convolution():
    net = L.ByteConvNet(["a", "b"])
    net.prepare()
    x = np.random.default_rng(1).integers(0, 256, (3, L.LENGTH)).astype(np.uint8)
    assert np.allclose(net.responses(x), net._train_responses(x), atol=1e-5)


def test_every_window_counts():
    """A long text changes its language in the last windows only."""
    rows = [("en", "the and of that with "), ("de", "der und nicht das ist ")] * 30
    net = L.fit([(lang, (t * 12)[k % 7 :]) for k, (lang, t) in enumerate(rows)])
    long = (b"the and of that with " * 400) + (b"der und nicht das ist " * 900)
    assert net.predict([long])[0] == ["de"] and net.predict([long[:8000]])[0] == ["en"]
