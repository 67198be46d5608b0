import random

from playmart.llm import token_counts as T
from playmart.llm.common import table
from playmart.llm.packing import byte_bpe_path, vocabulary_pieces

from .helpers import SF, doc, edge_rows, frame


def greedy(pieces, word):
    """Longest match first, by definition; -1 if a place has no piece."""
    at = n = 0
    longest = max(map(len, pieces), default=0)
    while at < len(word):
        size = next((k for k in range(min(longest, len(word) - at), 0, -1) if word[at : at + k] in pieces), 0)
        if not size:
            return -1
        at, n = at + size, n + 1
    return n


def test_automaton_equals_greedy_on_random_vocabularies():
    rnd = random.Random(2)
    for _ in range(300):
        pieces = {bytes(rnd.choices(b"abc", k=rnd.randint(1, 6))) for _ in range(rnd.randint(0, 12))}
        automaton = T.LongestMatch(pieces)
        for _ in range(40):
            word = bytes(rnd.choices(b"abcd" if rnd.random() < 0.1 else b"abc", k=rnd.randint(0, 15)))
            assert automaton.count(word) == greedy(pieces, word), (pieces, word)


def test_query_equals_greedy(spark):
    pieces, memo, want = set(vocabulary_pieces(byte_bpe_path())), {}, {}
    for i, text in table(spark, SF, "documents").select("doc_id", "text").collect():
        counts = []
        for w in text.encode().split():
            if w not in memo:
                memo[w] = greedy(pieces, b" " + w)
            counts.append(memo[w])
        want[i] = (len(counts), sum(counts), 0, max(counts, default=0))
    assert {r.doc_id: tuple(r)[1:] for r in T.op8_token_counts(spark, SF).collect()} == want


def test_edges_and_unknown_words(spark):
    docs = frame(spark, [*edge_rows(), doc(60, "x" * 200_000)], clash=True)
    rows = T.count_tokens(docs, byte_bpe_path()).collect()
    assert len(rows) == docs.count()
    got = {r.doc_id: tuple(r.counts) for r in rows}
    assert got[1] == got[2] == got[3] == (0, 0, 0, 0) and got[60][0] == 1 and got[60][1] > 1000
    counts = T.Counts(T.LongestMatch([b" a", b"b", b" "]), b" ")
    assert counts.of(b"ab abb zz abz a") == (5, 2 + 3 + 1 + 1 + 1, 2, 3)
    assert T.count_tokens(frame(spark, []), byte_bpe_path()).count() == 0
