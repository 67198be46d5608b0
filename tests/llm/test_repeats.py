import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from playmart.llm import repeats as R
from playmart.llm.common import table

from .helpers import SF, doc, edge_rows, frame, plain, words


def brute(rows, window=13):
    """(id, text) rows -> (id, n_words, removed places, kept text)."""
    split = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows]
    first = {}
    for i, w in split:
        for k in range(len(w) - window + 1 if i is not None else 0):
            g = tuple(w[k : k + window])
            first[g] = min(i, first.get(g, i))
    out = []
    for i, w in split:
        gone = set()
        for k in range(len(w) - window + 1 if i is not None else 0):
            if first[tuple(w[k : k + window])] < i:
                gone.update(range(k, k + window))
        out.append((i, len(w), gone, " ".join(x for k, x in enumerate(w) if k not in gone)))
    return out


def in_order(rows):
    return sorted(rows, key=lambda t: [(v is None, str(v)) for v in t])


def digest(rows):
    return in_order((i, n, len(gone), hashlib.sha256(kept.encode()).hexdigest()) for i, n, gone, kept in rows)


def test_query_by_definition(spark):
    rows = [tuple(r) for r in table(spark, SF, "documents").select("doc_id", "text").collect()]
    got = plain(R.op13_substring_dedup(spark, SF))
    assert got == digest(brute(rows)) and sum(r[2] > 0 for r in got) > 5


def planted_rows():
    rnd = random.Random(5)
    passage, frequent = words(60, 11), words(13, 12)
    rows = edge_rows()
    for k in range(120):
        w = words(rnd.randrange(10, 90), 100 + k)
        if k % 3 == 0:
            at = rnd.randrange(len(w))
            w[at:at] = passage[rnd.randrange(20) : 40 + rnd.randrange(20)]
        if k % 2 == 0:
            w += frequent[: rnd.choice([7, 12, 13])] + words(2, k)
        if k % 10 == 9:
            w += w[:20] + ["again"] * 30
        rows.append(doc(rnd.choice([k + 20, 300 - k]), " ".join(w)))
    rows += [rows[-1]] * 3 + [(None, " ".join(passage), None, None, None)] * 2 + [doc(-7, " ".join(passage)), doc(500, "  ".join(passage) + "\n")]
    return rows


def spans_of(gone):
    out = []
    for k in sorted(gone):
        if out and k == out[-1][1] + 1:
            out[-1] = (out[-1][0], k)
        else:
            out.append((k, k))
    return out


@pytest.mark.parametrize("sizes", [{}, {"chunk_bytes": 3000, "bucket_windows": 500}])
@pytest.mark.parametrize("window", [13, 4])
def test_edges_in_one_and_many_chunks(spark, sizes, window):
    rows = planted_rows()
    docs = frame(spark, rows, clash=True).repartition(3)
    found = R.find_repeats(docs, window, **sizes).withColumn("again", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    got = [(r.id, r.n_words, [tuple(s) for s in r.spans], r.kept) for r in found.collect()]
    assert in_order(got) == in_order((i, n, spans_of(gone), kept) for i, n, gone, kept in brute([r[:2] for r in rows], window))


def test_remove_keeps_columns_and_other_texts(spark):
    rows = planted_rows()
    docs = frame(spark, rows, clash=True)
    cut = R.remove_repeats(docs, chunk_bytes=5000)
    assert cut.columns == docs.columns
    want = [(i, kept if gone else text) for (i, _, gone, kept), (_, text, *_) in zip(brute([r[:2] for r in rows]), rows)]
    assert in_order(tuple(r) for r in cut.select("doc_id", "text").collect()) == in_order(want)


def test_what_a_chunk_sends_does_not_grow_with_copies(spark):
    """A passage of all documents is sent once a chunk."""
    text = " ".join(words(200, 1))
    docs = [pack(i, text) for i in range(50)]
    one, many = (R._send_blocks(13, 1)(rows(docs[:n])) for n in (1, 50))
    assert len(many.column("data")[0].as_py()) == len(one.column("data")[0].as_py())


def pack(i, text):
    import zstandard

    return {"chunk": 0, "id": i, "key": i, "copies": 1, "packed": zstandard.ZstdCompressor().compress(text.encode())}


def rows(dicts):
    import pyarrow as pa

    return pa.Table.from_pylist(dicts, pa.schema([("chunk", pa.int32()), ("id", pa.int64()), ("key", pa.int64()), ("copies", pa.int64()), ("packed", pa.binary())]))


def test_array_codec():
    for dtype in (np.uint32, np.uint64, np.int64):
        for n in (0, 1, 1000):
            x = np.random.default_rng(n).integers(0, 2**31, n).astype(dtype)
            assert np.array_equal(R.unpack_array(R.pack_array(x), dtype), x)


def test_empty_table_and_text_ids(spark):
    assert R.find_repeats(frame(spark, [])).count() == 0
    assert R.remove_repeats(frame(spark, [])).count() == 0
    with pytest.raises(ValueError):
        R.find_repeats(spark.createDataFrame([("a", "b")], "doc_id string, text string"))
