"""Periodic runs of words, found by multi-scale minimizers.

A run is a maximal stretch of words with smallest period q that is at least 2q words long. The
texts of a batch are one array of word numbers, with a separator of its own after each text.

* Periods below ``DIRECT`` are too short for windows: each such lag is scanned directly.
* The scale Q finds the periods Q <= q < 2Q. A window of Q words inside a run stands again q
  words later, so both select the same minimizer (smallest hash of Q/4 words, leftmost) at the
  same place: minimizers with equal words at a distance in [Q, 2Q) are the seeds. Places of one
  hash at gaps of at most Q/8 lie in a stretch of a shorter period and form one cluster;
  within a cluster nothing is seeded (its period is found on a smaller scale), and between two
  clusters each lag is tried once instead of each pair, so a repetitive text has no more seeds
  than a small multiple of its words a scale.
* A seed is extended both ways to its longest match by binary search over prefix hashes; what
  is long enough is compared word by word. Of equal stretches the smallest period stays.

Work is done text by text inside a task and nothing is shuffled. Memory follows the batch's
slice of ``SLICE`` bytes, or the longest text.

Defined results: NULL, empty and blank texts have no words and no runs; a repeated row
gets its result again; an empty table gives no rows. All columns are kept, whatever their names.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from itertools import chain, count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .common import slices, table, texts

DIRECT = 16
SLICE = 4 << 20
RESULT = "struct<n_words:long,runs:array<struct<start:long,length:long,period:long>>,collapsed:string>"
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_BASE = np.uint64(0x9E3779B97F4A7C15)
_NONE = np.zeros((0, 3), np.int64)


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finalizer: equal in, equal out, otherwise like random numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def streaks(equal: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """First places and lengths of the stretches of at least ``least`` true values."""
    at = np.flatnonzero(equal)
    if not len(at):
        return at, at
    cut = np.flatnonzero(np.diff(at) > 1) + 1
    first = at[np.concatenate([[0], cut])]
    size = np.diff(np.concatenate([[0], cut, [len(at)]]))
    keep = size >= least
    return first[keep], size[keep]


def direct_scan(seq: np.ndarray, lag: int, min_length: int) -> np.ndarray:
    if len(seq) <= lag:
        return _NONE
    first, size = streaks(seq[lag:] == seq[:-lag], max(lag, min_length - lag))
    return np.stack([first, size + lag, np.full(len(first), lag)], 1)


class Matcher:
    """Prefix hashes of a word sequence, for windows and longest matches."""

    def __init__(self, seq: np.ndarray):
        self.seq = seq
        n = len(seq)
        self.power = powers(int(_BASE), n + 1)
        self.inverse = powers(pow(int(_BASE), -1, 1 << 64), n + 1)
        word = mix(seq.astype(np.int64).view(np.uint64) + _BASE)
        self.prefix = np.concatenate([np.zeros(1, np.uint64), np.cumsum(word * self.power[:n], dtype=np.uint64)])

    def windows(self, k: int) -> np.ndarray:
        """Hash of the k words from each place on."""
        return mix((self.prefix[k:] - self.prefix[:-k]) * self.inverse[: len(self.prefix) - k])

    def same(self, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Do ``size`` words from a on equal those from b on (a < b)?"""
        return (self.prefix[a + size] - self.prefix[a]) * self.power[b - a] == self.prefix[b + size] - self.prefix[b]

    def stretch(self, x: np.ndarray, lag: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First place and size of the longest match of the sequence with itself ``lag`` later around x."""
        left, right = np.zeros(len(x), np.int64), np.zeros(len(x), np.int64)
        for grown, most in ((right, len(self.seq) - x - lag), (left, x)):
            step = 1 << max(0, int(most.max(initial=1))).bit_length()
            while step:
                more = grown + step
                fits = np.flatnonzero(more <= most)
                a = x[fits] - more[fits] if grown is left else x[fits]
                grown[fits] += np.where(self.same(a, a + lag[fits], more[fits]), step, 0)
                step >>= 1
        return x - left, left + right


def window_minima(keys: np.ndarray, width: int) -> np.ndarray:
    """Smallest key of each ``width`` consecutive ones, each run of one minimum once."""
    m, size = keys, 1
    while 2 * size <= width:
        m, size = np.minimum(m[:-size], m[size:]), 2 * size
    if size < width:
        m = np.minimum(m[: len(m) - (width - size)], m[width - size :])
    return m[np.concatenate([[True], m[1:] != m[:-1]])]


def seeds(match: Matcher, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, lag) of the minimizers that stand again ``scale`` to 2 * scale - 1 words later."""
    k = scale // 4
    n = len(match.seq)
    none = np.zeros(0, np.int64), np.zeros(0, np.int64)
    if n < 2 * scale:
        return none
    hashes = match.windows(k)
    bits = np.uint64(n.bit_length())
    places = np.arange(len(hashes), dtype=np.uint64)
    minima = window_minima((hashes >> bits) << bits | places, scale - k + 1)
    x = (minima & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    h = hashes[x]
    order = np.lexsort((x, h))
    h, x = h[order], x[order]
    twice = h[1:] == h[:-1]
    some = np.concatenate([twice, [False]]) | np.concatenate([[False], twice])
    h, x = h[some], x[some]
    if not len(x):
        return none
    gap = np.diff(x)
    joined = (h[1:] == h[:-1]) & (gap <= k // 2)
    begin = np.flatnonzero(np.concatenate([[True], ~joined]))
    end = np.concatenate([begin[1:], [len(x)]]) - 1
    first, last, h = x[begin], x[end], h[begin]
    # The greatest common divisor of a cluster's gaps, 0 for a single place.
    step = np.gcd.reduceat(np.concatenate([[0], np.where(joined, gap, 0)]), begin)
    out_x, out_lag = [], []
    a = np.arange(len(first) - 1)
    ahead = 1
    while len(a := a[a + ahead < len(first)]):
        b = a + ahead
        near = (h[a] == h[b]) & (first[b] - last[a] < 2 * scale)
        a = a[near]
        b = a + ahead
        g = np.gcd(step[a], step[b])
        low, high = first[b] - last[a], last[b] - first[a]
        g = np.where(g == 0, 1 << 40, g)
        z0 = np.maximum(0, -((low - scale) // g))
        z1 = (np.minimum(high, 2 * scale - 1) - low) // g
        n_lags = np.maximum(0, z1 - z0 + 1)
        pair = np.repeat(np.arange(len(a)), n_lags)
        z = np.arange(len(pair)) - np.repeat(np.cumsum(n_lags) - n_lags, n_lags) + z0[pair]
        lag = low[pair] + z * g[pair]
        out_lag.append(lag)
        out_x.append(np.maximum(first[a][pair], first[b][pair] - lag))
        ahead += 1
    return (np.concatenate(out_x), np.concatenate(out_lag)) if out_x else none


def scale_scan(seq: np.ndarray, scale: int) -> np.ndarray:
    match = Matcher(seq)
    x, lag = seeds(match, scale)
    if not len(x):
        return _NONE
    start, size = match.stretch(x, lag)
    found = np.unique(np.stack([start, size + lag, lag], 1)[size >= lag], axis=0)
    for i, (s, length, q) in enumerate(found.tolist()):
        if not np.array_equal(seq[s : s + length - q], seq[s + q : s + length]):  # two hashes met: compare the words
            first, same = streaks(seq[s : s + length - q] == seq[s + q : s + length], q)
            found[i] = (s + first[0], same[0] + q, q) if len(first) else (s, 0, q)
    return found


def find_runs(seq: np.ndarray, lengths: np.ndarray, min_length: int) -> tuple[np.ndarray, np.ndarray]:
    """All runs of many texts. ``seq``: their word numbers (from 0) one after the other.

    Returns rows (start, length, period), ordered by text, start and period, and the bounds of each text's rows.
    """
    found = []

    def select(least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The texts of at least so many words, each followed by a word of its own; their numbers and starts."""
        which = np.flatnonzero(lengths >= max(1, least))
        size = lengths[which]
        starts = np.concatenate([[0], np.cumsum(size + 1)])
        out = np.empty(int(starts[-1]), np.int32)
        out[starts[1:] - 1] = -1 - np.arange(len(which))
        words = np.ones(len(out), bool)
        words[starts[1:] - 1] = False
        out[words] = seq[np.repeat(lengths >= max(1, least), lengths)]
        return which, starts, out

    def add(rows: np.ndarray, which: np.ndarray, starts: np.ndarray) -> None:
        text = np.searchsorted(starts, rows[:, 0], "right") - 1
        found.append(np.column_stack([which[text], rows[:, 0] - starts[text], rows[:, 1:]]))

    which, starts, part = select(min_length)
    for lag in range(1, DIRECT):
        add(direct_scan(part, lag, min_length), which, starts)
    scale, longest = DIRECT, int(lengths.max(initial=0))
    while 2 * scale <= longest:
        which, starts, part = select(2 * scale)
        add(scale_scan(part, scale), which, starts)
        scale *= 2
    runs = np.concatenate(found)
    runs = runs[runs[:, 2] >= min_length]
    runs = runs[np.lexsort((runs[:, 3], runs[:, 2], runs[:, 1], runs[:, 0]))]
    if len(runs):
        runs = runs[np.concatenate([[True], (runs[1:, :3] != runs[:-1, :3]).any(1)])]
        runs = runs[np.lexsort((runs[:, 3], runs[:, 1], runs[:, 0]))]
    return runs[:, 1:], np.searchsorted(runs[:, 0], np.arange(len(lengths) + 1))


def runs_of(words: list[list[bytes]], min_length: int) -> list[np.ndarray]:
    numbers = defaultdict(count().__next__)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    seq = np.fromiter(map(numbers.__getitem__, chain.from_iterable(words)), np.int32, int(lengths.sum()))
    rows, at = find_runs(seq, lengths, min_length)
    return [rows[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]


def collapse(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words outside of every run's repetitions."""
    if not len(runs):
        return b" ".join(words)
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    return b" ".join([words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()])


def periodic_runs(docs: DataFrame, out: str = "periodic", text_col: str = "text", min_length: int = 12) -> DataFrame:
    """``docs`` with the struct column ``out``: n_words, runs (by start, then period) and the text
    collapsed to the first period of each run, words joined by one space."""

    @F.arrow_udf(RESULT)
    def scan(column: pa.Array) -> pa.Array:
        items = texts(column)
        sizes, flat, ends, kept = [], [], [0], []
        for lo, hi in slices(items, SLICE):
            words = [t.split() for t in items[lo:hi]]
            for w, runs in zip(words, runs_of(words, min_length), strict=True):
                sizes.append(len(w))
                flat.append(runs)
                ends.append(ends[-1] + len(runs))
                kept.append(collapse(w, runs))
        rows = np.concatenate(flat) if flat else _NONE
        values = pa.StructArray.from_arrays([pa.array(rows[:, i]) for i in range(3)], fields=list(_RUN))
        found = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)
        return pa.StructArray.from_arrays([pa.array(sizes, pa.int64()), found, pa.array(kept, pa.binary()).cast(pa.string())], names=["n_words", "runs", "collapsed"])

    return docs.withColumn(out, scan(F.col(text_col)))


def plant(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The contract's repetition in one of ten documents."""
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    n, g = len(words), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [*words[:a], *(words[a : a + p] * (1 + (n - a) // p))[: n - a]]


@F.arrow_udf(StringType())
def planted_text(column: pa.Array, ids: pa.Array) -> pa.Array:
    planted = [b" ".join(plant(t.split(), i)) for t, i in zip(texts(column), ids.to_pylist(), strict=True)]
    return pa.array(planted, pa.binary()).cast(pa.string())


def op11_periodic_runs(spark, sf_dir: str) -> DataFrame:
    """Runs of every document with the contract's repetitions planted."""
    docs = table(spark, sf_dir, "documents").select("doc_id", planted_text("text", "doc_id").alias("text"))
    runs = F.col("periodic.runs")
    lines = F.transform(runs, lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")))
    lines = F.when(F.size(runs) > 0, F.concat(F.array_join(lines, "\n"), F.lit("\n"))).otherwise("")
    best = F.array_max(F.transform(runs, lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    found = periodic_runs(docs).select("doc_id", F.size(runs).cast("long").alias("n_runs"), best.alias("best"), lines.alias("lines"), "periodic.collapsed")
    length, period = F.col("best.length"), -F.col("best.period")
    return found.select(
        "doc_id",
        "n_runs",
        (-F.col("best.start")).alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.floor(F.lit(1000) * length / period).cast("long").alias("exponent_milli"),
        F.sha2(F.col("lines").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
