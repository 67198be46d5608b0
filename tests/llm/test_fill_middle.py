import hashlib
import re

import numpy as np
from pyspark.sql import functions as F

from playmart.llm import fill_middle as M
from playmart.llm.common import table

from .helpers import SF, doc, edge_rows, frame, plain


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def by_definition(i, text):
    text = text or ""
    tokens = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    n = len(tokens)
    digest = hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[k : k + 8], 16) for k in (0, 8, 16, 24))
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = ("".join(x) for x in (tokens[:a], tokens[a:b], tokens[b:]))
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return (i, n, "plain", None, None, sha(text), sha(text))
    out = f"<S>{s}<P>{p}<M>{m}" if h4 % 100 < 20 else f"<P>{p}<S>{s}<M>{m}"
    return (i, n, "spm" if h4 % 100 < 20 else "psm", len(p), len(m), sha(out), sha(text))


def in_order(rows):
    return sorted(rows, key=lambda t: [(v is None, str(v)) for v in t])


def test_query_by_definition(spark):
    rows = [tuple(r) for r in table(spark, SF, "documents").select("doc_id", "text").collect()]
    got = plain(M.op12_fill_middle(spark, SF))
    assert got == in_order(by_definition(*r) for r in rows)
    assert {r[2] for r in got} == {"plain", "psm", "spm"}


def test_edges(spark):
    odd = ["<", "a<P>b", "<M>", "<S", "<<S >", "P><S", "é東京 €uro\u0000x", "a" * 5000, "\U0001f600" * 9, "x\ny", " ", "S>M>P>"]
    rows = edge_rows() + [doc(100 + k, odd[k % len(odd)]) for k in range(120)] + [doc(-5, "negative id here")]
    docs = frame(spark, rows, clash=True).repartition(2)
    done = M.fill_in_middle(docs, "fim_result")
    assert done.columns == [*docs.columns, "fim_result"]
    back = done.withColumn("again", M.restore("fim_result.output", "fim_result.form"))
    got = [
        (r.doc_id, r.fim_result.n, r.fim_result.form, r.fim_result.prefix_chars, r.fim_result.middle_chars, sha(r.fim_result.output), sha(r.again))
        for r in back.collect()
    ]
    assert in_order(got) == in_order(by_definition(*r[:2]) for r in rows)


def test_small_blocks_move_the_same_bytes(monkeypatch):
    """Blocks of any length move the same bytes."""
    import pyarrow as pa

    texts = ["", "ab cd", "é東京<", "", "x" * 50, "<P>", "one two three"] * 3
    rnd = np.random.default_rng(3)
    for block in (1 << 20, 5, 1):
        monkeypatch.setattr(M, "BLOCK", block)
        data, at = M.flat(pa.array(texts, pa.string()))
        form = np.array([0 if not t or "<P>" in t else 1 + k % 2 for k, t in enumerate(texts)])
        cut = np.sort(np.stack([at[:-1] + (rnd.random(len(texts)) * (np.diff(at) + 1)).astype(int) for _ in range(2)], 1), 1)
        out, out_at = M.scatter(data, at, form, cut[:, 0], cut[:, 1])
        for i, t in enumerate(texts):
            raw = t.encode()
            a, b = cut[i] - at[i]
            p, m, s = raw[:a], raw[a:b], raw[b:]
            want = [raw, b"<P>" + p + b"<S>" + s + b"<M>" + m, b"<S>" + s + b"<P>" + p + b"<M>" + m][form[i]]
            assert out[out_at[i] : out_at[i + 1]].tobytes() == want
        back, back_at = M.gather(out, out_at, form)
        assert back.tobytes() == data.tobytes() and (back_at == at).all()


def test_shares_of_the_forms_and_empty_table(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("some words to cut here").alias("text"))
    counts = {r["form"]: r["count"] for r in M.fill_in_middle(docs).groupBy("fim.form").count().collect()}
    assert 300 < counts["plain"] < 500 and 580 < counts["spm"] < 860
    assert M.fill_in_middle(docs, plain_percent=0, spm_percent=100).where("fim.form != 'spm'").count() == 0
    assert M.fill_in_middle(frame(spark, [])).count() == 0
