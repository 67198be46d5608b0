"""Greedy word-piece token counts by a linear longest-match automaton.

The vocabulary is a trie with failure links. When no edge continues a match, the link of
the node leads to the node that holds what is left once the longest pieces of the node's
string are taken off, and a precomputed count says how many pieces that were. One pass
over a word's bytes adds these counts up; no piece is ever built and no byte is read twice.

A word is matched with ``prefix`` (a blank for byte-level vocabularies) in front. A word that
the vocabulary can't spell is one unknown token.

Defined results: NULL, empty and blank texts have no words and no tokens; repeated rows are
counted row by row; an empty table gives no rows. All columns are kept.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import table, texts
from .packing import byte_bpe_path, vocabulary_pieces

_CACHE = 400_000


class LongestMatch:
    """Trie nodes are numbers, 0 is the root; ``fail`` is -1 where nothing can be taken off."""

    def __init__(self, pieces: Iterable[bytes]):
        self.edges: dict[int, int] = {}  # node << 8 | byte -> node
        piece_at, parent, byte_of, depth = {0: False}, [0], [0], [0]
        for piece in pieces:
            node = 0
            for b in piece:
                key = node << 8 | b
                if key not in self.edges:
                    self.edges[key] = len(parent)
                    parent.append(node)
                    byte_of.append(b)
                    depth.append(depth[node] + 1)
                node = self.edges[key]
            if node:
                piece_at[node] = True
        n = len(parent)
        self.fail, self.popped = [-1] * n, [0] * n
        for v in sorted(range(1, n), key=depth.__getitem__):
            if piece_at.get(v):
                self.fail[v], self.popped[v] = 0, 1
                continue
            z, count = self.fail[parent[v]], self.popped[parent[v]]
            while z >= 0 and (z << 8 | byte_of[v]) not in self.edges:
                count += self.popped[z]
                z = self.fail[z]
            if z >= 0:
                self.fail[v], self.popped[v] = self.edges[z << 8 | byte_of[v]], count

    def count(self, word: bytes) -> int:
        """Number of greedy longest-match pieces, or -1 for a word that can't be spelled."""
        edges, fail, popped = self.edges, self.fail, self.popped
        node = total = 0
        for b in word:
            while (step := edges.get(node << 8 | b)) is None:
                total += popped[node]
                node = fail[node]
                if node < 0:
                    return -1
            node = step
        while node:
            total += popped[node]
            node = fail[node]
            if node < 0:
                return -1
        return total


@lru_cache(maxsize=2)
def _automaton(vocabulary: str) -> LongestMatch:
    return LongestMatch(vocabulary_pieces(vocabulary))


class Counts:
    """Counts of texts, with the counts of recent words kept."""

    def __init__(self, automaton: LongestMatch, prefix: bytes):
        self.automaton, self.prefix, self.known = automaton, prefix, {}

    def of(self, text: bytes) -> tuple[int, int, int, int]:
        words = text.split()
        n_tokens = n_unknown = longest = 0
        if len(self.known) > _CACHE:
            self.known.clear()
        for word, times in Counter(words).items():
            n = self.known.get(word)
            if n is None:
                n = self.known[word] = self.automaton.count(self.prefix + word)
            if n < 0:
                n, n_unknown = 1, n_unknown + times
            n_tokens += n * times
            longest = max(longest, n)
        return len(words), n_tokens, n_unknown, longest


def count_tokens(docs: DataFrame, vocabulary: str, out: str = "counts", prefix: bytes = b" ", text_col: str = "text") -> DataFrame:
    """``docs`` with the struct column ``out``: n_words, n_tokens, n_unknown (words) and
    max_word_tokens. Words are runs without ASCII white space; case is kept."""

    @F.arrow_udf("struct<n_words:long,n_tokens:long,n_unknown:long,max_word_tokens:long>")
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        counts = Counts(_automaton(vocabulary), prefix)
        for column in batches:
            rows = [counts.of(t) for t in texts(column)]
            cols = zip(*rows, strict=True) if rows else [[]] * 4
            yield pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["n_words", "n_tokens", "n_unknown", "max_word_tokens"])

    return docs.withColumn(out, count(F.col(text_col)))


def op8_token_counts(spark, sf_dir: str) -> DataFrame:
    """Greedy word-piece counts of every document with the byte-level vocabulary."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return count_tokens(docs, byte_bpe_path()).select("doc_id", "counts.*")
