import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from playmart.llm import packing as P
from playmart.llm.common import table

from .helpers import SF, doc, edge_rows, frame


def check(pieces, rows, size=2048):
    """Exact round trip; returns the sequence lengths."""
    tokenizer = Tokenizer.from_file(P.byte_bpe_path())
    want = sorted(tokenizer.encode(t or "", add_special_tokens=False).ids + [1] for _, t in rows)
    pieces = [r.asDict() for r in pieces]
    by_doc, ends = {}, {}
    # Equal ids may repeat, so documents are rebuilt by following their pieces greedily.
    for p in sorted(pieces, key=lambda p: (str(p["doc_id"]), p["doc_tokens"], p["start"])):
        ids = np.frombuffer(p["ids"], "<u4").tolist()
        assert len(ids) == p["length"] > 0
        key = (p["doc_id"], p["doc_tokens"])
        open_docs = by_doc.setdefault(key, [])
        for d in open_docs:
            if len(d) == p["start"]:
                d += ids
                break
        else:
            assert p["start"] == 0
            open_docs.append(ids)
        ends.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    assert sorted(d for ds in by_doc.values() for d in ds) == want
    lengths = []
    for spans in ends.values():
        at = 0
        for offset, n in sorted(spans):
            assert offset == at
            at += n
        assert at <= size
        lengths.append(at)
    return lengths


def test_query_is_a_round_trip_with_little_padding(spark):
    rows = [tuple(r) for r in table(spark, SF, "documents").select("doc_id", "text").collect()]
    pieces = P.pack_documents(table(spark, SF, "documents"), P.byte_bpe_path()).collect()
    lengths = check(pieces, rows)
    padding = sum(0 if n & (n - 1) == 0 else 2048 - n for n in lengths)
    assert padding < 0.02 * sum(lengths)
    digest = {(r.doc_id, r.start): r for r in P.op10_packing(spark, SF).collect()}
    for p in pieces:
        r = digest[p.doc_id, p.start]
        if r.length == p.length:
            assert r.ids_crc32 == zlib.crc32(p.ids) and r.doc_tokens == p.doc_tokens
    assert {r: sum(x.length for x in digest.values() if x.doc_id == r) for r in (0, 1)} == {
        r: sum(p.length for p in pieces if p.doc_id == r) for r in (0, 1)
    }


@pytest.mark.parametrize("partitions", [1, 9, 40])
def test_edges_over_partitions(spark, partitions):
    rows = [*edge_rows(), doc(50, "says <|endoftext|> inside"), *[doc(100 + k, "word " * (k % 70)) for k in range(300)]]
    docs = frame(spark, rows, clash=True).repartition(partitions)
    lengths = check(P.pack_documents(docs, P.byte_bpe_path(), size=256, windows=4, merge=4).collect(), [r[:2] for r in rows], 256)
    padding = sum(0 if n & (n - 1) == 0 else 256 - n for n in lengths)
    assert padding < 0.1 * sum(lengths)


def test_open_windows_are_bounded():
    packer = P.Packer(64, 3, 4, lambda pieces: None)
    for k in range(500):
        packer.add(P.Piece(k, 0, 20 + k % 30, np.zeros(20 + k % 30, np.uint32)))
        assert len(packer.open) <= 3 and all(f == sum(len(p.ids) for p in w) < 64 for f, w in zip(packer.fill, packer.open))


def test_empty_table(spark):
    assert P.pack_documents(frame(spark, []), P.byte_bpe_path()).count() == 0
