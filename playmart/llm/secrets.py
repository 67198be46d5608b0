"""Secret scan: fixed patterns, and a randomness test battery for what they miss.

Every run of at least ``MIN_RUN`` key characters is a candidate. Its encoding is inferred
from its characters (hex, one-case letters with digits, base64, letters of one case) and three kinds of tests measure
how well it agrees with uniformly random characters of that alphabet: chi-squared uniformity of
character classes, of common and rare letters and of value bins, runs tests about the middle of
the alphabet and of character classes, and serial tests (lag-one correlation, pairs of letters
that words are made of). Fisher's method joins them; the joint p-value is near 0 for ordinary
text and uniform for random keys. A run below ``GATE`` isn't random and is out.

For the rest a second p-value says how often an ordinary string would look so little like one. For
each style of ordinary string (hex of ASCII text, counters; words with numbers; identifiers,
slugs, paths) a fixed table holds how much more often a character follows another than in a random string. The sum
of these log ratios over a string is about normal, with a mean and a variance that grow with its length, so its
lower tail reaches far below any sample's size; the p-value is the largest of the styles. It depends on
the string alone. A Benjamini-Hochberg cut per encoding and length bin keeps the expected share of ordinary
strings among the flagged ones below ``fdr``: a key of 32 characters has p-values around 1e-10, so it
stays flagged among a million ordinary strings. The histogram behind
the cuts has at most ``len(ENCODINGS) * LENGTH_BINS * P_BINS`` rows.

Defined results: NULL and empty texts have no spans; a corpus repeated any number of times has the same cuts;
runs of digits only are numbers, not secrets; repeated rows are scanned one by one; an empty
table gives no rows. All columns of the documents are kept.
"""

from __future__ import annotations

import math
import random
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, free_name, table

# The base patterns and the order of their kinds.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "random")
_KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

MIN_RUN = 20
RUN = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
LENGTH_BINS, P_BINS = 12, 64
ENCODINGS = ("hex", "base36", "base64", "letters")
GATE = 0.005
STYLE_SIZE, STYLE_WINDOWS = 1 << 17, 2_000

_VALUES = np.full(128, -1)
for _i, _c in enumerate("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"):
    _VALUES[ord(_c)] = _i
_VALUES[ord("-")], _VALUES[ord("_")] = 62, 63
_HEX_VALUES = np.full(128, -1)
_BASE36_VALUES = np.full(128, -1)
_LETTER_VALUES = np.full(128, -1)
for _i in range(26):
    _LETTER_VALUES[65 + _i] = _LETTER_VALUES[97 + _i] = _i
for _i, _c in enumerate("0123456789abcdefghijklmnopqrstuvwxyz"):
    for _d in (_c, _c.upper()):
        _BASE36_VALUES[ord(_d)] = _i
        if _i < 16:
            _HEX_VALUES[ord(_d)] = _i
# 0: the letters that make two thirds of ordinary text, 1: the rarest, 2: others, digits and signs.
_COMMON = np.full(128, 2)
for _k, _letters in enumerate(("etaoinsr", "jkqvwxyz")):
    for _c in _letters + _letters.upper():
        _COMMON[ord(_c)] = _k
# Neighbours that are frequent in words, in either case.
_PAIRS = "th he in er an re nd at on nt ha es st en ed to it ou ea hi is or ti as te et ng of al de se le sa si ar ve ra ld ur li ri ic el ch ro io ne us la ta me".split()
_PAIR = np.zeros((128, 128))
for _a, _b in _PAIRS:
    for _c in (_a, _a.upper()):
        for _d in (_b, _b.upper()):
            _PAIR[ord(_c), ord(_d)] = 1
_ONE_CASE = re.compile(r"[a-z]+|[A-Z][a-z]*|[A-Z]+")
_ALPHABETS = {"hex": (_HEX_VALUES, 16), "base36": (_BASE36_VALUES, 36), "base64": (_VALUES, 64), "letters": (_LETTER_VALUES, 26)}
_HEX_ONLY = re.compile(r"[0-9a-f]+|[0-9A-F]+")
_BASE36 = re.compile(r"[0-9a-z]+|[0-9A-Z]+")


def length_bin(n: int) -> int:
    """Bins that double every third step: 20-24, 25-31, 32-39, ..."""
    return min(LENGTH_BINS - 1, int(3 * math.log2(n / MIN_RUN)))


_erfc = np.frompyfunc(math.erfc, 1, 1)


def _two_sided(z: np.ndarray) -> np.ndarray:
    return _erfc(np.abs(z) / math.sqrt(2)).astype(float)


def _chi2_z(x: np.ndarray, df: np.ndarray | int) -> np.ndarray:
    """Wilson-Hilferty."""
    k = 2 / (9 * np.asarray(df, float))
    return (np.cbrt(x / np.asarray(df, float)) - (1 - k)) / np.sqrt(k)


def _chi2_sf(x: np.ndarray, df: np.ndarray | int) -> np.ndarray:
    return 0.5 * _erfc(_chi2_z(x, df) / math.sqrt(2)).astype(float)


def _poisson_sf(count: np.ndarray, mean: np.ndarray) -> np.ndarray:
    """Upper tail with half of the count's own share, as a lower tail of chi-squared."""
    return 0.5 * _erfc(-_chi2_z(2 * mean, 2 * count + 1) / math.sqrt(2)).astype(float)


def _characters(runs: list[str], encoding: str):
    """All characters of the runs, their values, and the runs' lengths, first places and owners."""
    if encoding == "base64":
        runs = [r.rstrip("=").replace("=", "-") or "A" for r in runs]
    values, size = _ALPHABETS[encoding]
    n = np.fromiter(map(len, runs), np.int64, len(runs))
    codes = np.frombuffer("".join(runs).encode("ascii"), np.uint8)
    return codes, values[codes], n.astype(float), np.cumsum(n) - n, np.repeat(np.arange(len(runs)), n), size


def battery(runs: list[str], encoding: str) -> np.ndarray:
    """Joint p-value of each run under uniformly random characters of ``encoding``
    (one of ENCODINGS)."""
    if not runs:
        return np.zeros(0)
    codes, x, n, first, owner, size = _characters(runs, encoding)
    x = x.astype(float)
    total = lambda v: np.bincount(owner, v, len(runs))

    def uniformity(cell: np.ndarray, shares: np.ndarray) -> np.ndarray:
        seen = np.bincount(owner * len(shares) + cell, minlength=len(runs) * len(shares)).reshape(-1, len(shares))
        expected = n[:, None] * shares
        return _chi2_sf(((seen - expected) ** 2 / expected).sum(axis=1), len(shares) - 1)

    def stays(cell: np.ndarray, shares: np.ndarray) -> np.ndarray:
        """Two neighbours are of one class as often as if drawn one by one (the variance is exact)."""
        same = np.zeros(len(x))
        same[1:] = cell[1:] == cell[:-1]
        same[first] = 0
        q, t = (shares**2).sum(), (shares**3).sum()
        variance = (n - 1) * q * (1 - q) + 2 * (n - 2) * (t - q * q)
        return _two_sided((total(same) - (n - 1) * q) / np.sqrt(np.maximum(variance, 1e-9)))

    tests = []
    if encoding != "hex":
        # Upper, lower, digits and signs; or digits, letters.
        if encoding != "letters":
            cell, shares = (np.minimum(x // 26, 2), np.array([26, 26, 12]) / 64) if encoding == "base64" else (x >= 10, np.array([10, 26]) / 36)
            tests += [uniformity(cell.astype(int), shares), stays(cell, shares)]
        pair = np.zeros(len(x))
        pair[1:] = _PAIR[codes[:-1], codes[1:]]
        pair[first] = 0
        cases = 2 if encoding == "base64" else 1
        tests.append(_poisson_sf(total(pair), (n - 1) * len(_PAIRS) * cases**2 / size**2))
        tests.append(uniformity(_COMMON[codes], np.array([8 * cases, 8 * cases, size - 16 * cases]) / size))
    tests.append(uniformity((x * 4 // size).astype(int), np.full(4, 0.25)))
    fine = uniformity((x * 8 // size).astype(int), np.bincount(np.arange(size) * 8 // size) / size)
    tests.append(np.where(n >= 40, fine, tests[-1]))
    high = x * 2 >= size
    n1 = total(high)
    n0 = n - n1
    change = np.zeros(len(x))
    change[1:] = high[1:] != high[:-1]
    change[first] = 0
    with np.errstate(divide="ignore", invalid="ignore"):
        mean = 2 * n1 * n0 / n + 1
        var = (mean - 1) * (mean - 2) / (n - 1)
        tests.append(np.where((n1 > 0) & (n0 > 0), _two_sided(np.nan_to_num((total(change) + 1 - mean) / np.sqrt(var))), 0))
        d = x - (total(x) / n)[owner]
        lag = np.zeros(len(x))
        lag[1:] = d[1:] * d[:-1]
        lag[first] = 0
        square = total(d * d)
        tests.append(np.where(square > 0, _two_sided((total(lag) / square + 1 / n) * np.sqrt(n)), 0))
    # Fisher: the upper tail of chi-squared with an even number of degrees of freedom is a finite sum.
    half = -sum(np.log(np.maximum(p, 1e-30)) for p in tests)
    term, tail = np.ones(len(runs)), np.ones(len(runs))
    for i in range(1, len(tests)):
        term = term * half / i
        tail = tail + term
    return np.minimum(1.0, np.exp(-half) * tail)


def p_bin(p: np.ndarray) -> np.ndarray:
    """0 is the smallest p-value; every bin is a quarter of a power of ten, and ``bin_top`` its upper end."""
    return np.maximum(0, P_BINS - 1 - (-4 * np.log10(np.maximum(p, 1e-30))).astype(int))


def bin_top(b: np.ndarray) -> np.ndarray:
    return 10.0 ** (-(P_BINS - 1 - b) / 4)


_PLAIN = """the of and to in is that for it as was with be by on not he this are or his from at which but have an had they
you were their one all we can her has there been if more when will would who so no out up into than them only some could time
these two may then do first any my now such like our over me even most made after also did many before must through years where
much your way well down should because each just those people how too little state good very make world still own see men work
long get here between both life being under never day same another know while last might us great old year off come since go
against came right used take three user name file path index value config server client request response data list table key
string number type error message report image page version test build update delete create account service order item local
""".split()


def _styles(encoding: str, rnd: random.Random) -> tuple:
    """Makers of strings that have the alphabet of ``encoding`` but are not random."""
    pick = lambda n: [rnd.choice(_PLAIN) for _ in range(n)]
    number = lambda: str(rnd.choice((rnd.randrange(10), rnd.randrange(100), rnd.randrange(1990, 2030), rnd.randrange(10_000))))
    styles = {
        "hex": (
            lambda: " ".join(pick(20)).encode().hex(),
            lambda: "".join(f"{rnd.randrange(1 << 14):08x}" for _ in range(12)),
            lambda: "".join(rnd.choice(("dead", "beef", "cafe", "face", "fade", "babe", "feed", "added", "decade", "facade", number())) for _ in range(25)),
        ),
        "base36": (
            lambda: "".join(w + (number() if rnd.random() < 0.3 else "") for w in pick(20)),
            lambda: "".join([*pick(4), number(), *pick(4), number()]),
        ),
        "base64": (
            lambda: "".join(w.capitalize() + (number() if rnd.random() < 0.2 else "") for w in pick(20)),
            lambda: "_".join([*pick(18), number()]) + "_",
            lambda: "-".join([*pick(9), number(), *pick(9)]).title() + "-",
            lambda: "/".join(rnd.choice((w, w.capitalize(), w.upper(), number())) for w in pick(20)) + "/",
            lambda: "_".join([*pick(18), number()]).upper() + "_",
        ),
        "letters": (lambda: "".join(pick(20)),),
    }[encoding]

    def mixed() -> str:
        """Pieces of all styles in one string."""
        text = rnd.choice(styles)()
        at = rnd.randrange(len(text))
        return text[at : at + rnd.randrange(4, 24)]

    return (*styles, mixed)


@lru_cache
def ordinary_models(encoding: str) -> list[tuple[np.ndarray, float, float]]:
    """Per style: log ratio of each pair of neighbours against a random string (a tenth of the pairs
    may be anything, so no pair counts for more than -log 10), its mean a pair and its variance a pair."""
    rnd, (_, size), out = random.Random(f"ordinary {encoding}"), _ALPHABETS[encoding], []
    for make in _styles(encoding, rnd):
        text = ""
        while len(text) < STYLE_SIZE:
            text += "".join(make() for _ in range(50))
        x = _characters([text], encoding)[1]
        pairs = np.bincount(x[:-1] * size + x[1:], minlength=size * size).reshape(size, size) + 0.01
        ratio = np.log(0.9 * size * pairs / pairs.sum(axis=1, keepdims=True) + 0.1)
        sums = np.concatenate([[0], np.cumsum(ratio[x[:-1], x[1:]])])
        mean, variance = sums[-1] / (len(x) - 1), 0.0
        for n in (20, 40, 80, 160):  # neighbours depend on one another: the largest variance a pair of any length
            at = np.array([rnd.randrange(len(x) - n) for _ in range(STYLE_WINDOWS)])
            variance = max(variance, ((sums[at + n - 1] - sums[at] - (n - 1) * mean) ** 2).mean() / (n - 1))
        out.append((ratio, float(mean), float(variance)))
    return out


def ordinary_p(runs: list[str], encoding: str) -> np.ndarray:
    """How often an ordinary string of the same length would look as little like one; the largest of its styles."""
    if not runs:
        return np.zeros(0)
    _, x, n, first, owner, _ = _characters(runs, encoding)
    best = np.zeros(len(runs))
    for ratio, mean, variance in ordinary_models(encoding):
        step = np.zeros(len(x))
        step[1:] = ratio[x[:-1], x[1:]]
        step[first] = 0
        z = (np.bincount(owner, step, len(runs)) - (n - 1) * mean) / np.sqrt((n - 1) * variance)
        best = np.maximum(best, 0.5 * _erfc(-z / math.sqrt(2)).astype(float))
    return best


def run_p(runs: list[str], encoding: str) -> np.ndarray:
    """p-value of each run as an ordinary string; 1 where the battery says that it isn't random."""
    return np.where(battery(runs, encoding) < GATE, 1.0, ordinary_p(runs, encoding))


def _infer(run: str) -> str | None:
    if run.isdigit() or not run.strip("+/_=-"):
        return None
    if _ONE_CASE.fullmatch(run):
        return "letters"
    if _HEX_ONLY.fullmatch(run):
        return "hex"
    return "base36" if _BASE36.fullmatch(run) else "base64"


_SPAN = "struct<kind:int,first:int,last:int>"
FOUND = f"base array<{_SPAN}>, runs array<struct<first:int,last:int,bin:int,p:int>>"
_SPAN_ARROW = pa.struct([("kind", pa.int32()), ("first", pa.int32()), ("last", pa.int32())])
_FOUND_ARROW = pa.struct(
    [
        ("base", pa.list_(_SPAN_ARROW)),
        ("runs", pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32()), ("bin", pa.int32()), ("p", pa.int32())]))),
    ]
)


def base_spans(text: str, runs: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the fixed patterns; access keys and hex lie within runs."""
    out = []
    lower = text.lower()
    if any(k in lower for k in _KEYWORDS):
        out += [(0, *m.span()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    for lo, hi in runs:
        out += [(1, *m.span()) for m in ACCESS.finditer(text, lo, hi)]
        out += [(2, *m.span()) for m in HEX.finditer(text, lo, hi)]
    return sorted(out, key=lambda s: (s[1], s[0]))


def scan_batch(documents: list[str | None]) -> list[dict]:
    out, pending = [], {encoding: [] for encoding in ENCODINGS}
    for text in documents:
        runs = [m.span() for m in RUN.finditer(text)] if text else []
        found = {"base": [dict(zip(("kind", "first", "last"), s, strict=True)) for s in base_spans(text, runs)] if text else [], "runs": []}
        for lo, hi in runs:
            run = text[lo:hi]
            if encoding := _infer(run):
                pending[encoding].append((found, run, lo, hi))
        out.append(found)
    for k, (encoding, items) in enumerate(pending.items()):
        p = p_bin(run_p([run for _, run, _, _ in items], encoding))
        for (found, run, lo, hi), b in zip(items, p.tolist(), strict=True):
            found["runs"].append({"first": lo, "last": hi, "bin": k * LENGTH_BINS + length_bin(len(run)), "p": b})
    return out


def _scan(column: Column) -> Column:
    @F.arrow_udf(f"struct<{FOUND}>")
    def scan(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            parts = [pa.array(scan_batch(column[i : i + 1000].to_pylist()), _FOUND_ARROW) for i in range(0, len(column), 1000)]
            yield pa.concat_arrays(parts) if parts else pa.array([], _FOUND_ARROW)

    return scan(column)


def cuts(runs: dict[int, int], fdr: float) -> list[int]:
    """Per length bin the largest flagged p bin, or -1. ``runs`` counts (length bin * P_BINS + p bin)."""
    out, top = [], bin_top(np.arange(P_BINS))
    for i in range(LENGTH_BINS):
        found = np.array([runs.get(i * P_BINS + j, 0) for j in range(P_BINS)])
        hits = np.cumsum(found)
        good = np.flatnonzero((top * found.sum() <= fdr * hits) & (hits > 0))
        out.append(int(good[-1]) if len(good) else -1)
    return out


def scan_secrets(docs: DataFrame, out: str, fdr: float = 0.01, text_col: str = "text") -> DataFrame:
    """``docs`` with the array column ``out`` of spans (kind, first, last): kind is an index of
    KINDS, positions are code points, the end is excluded, ordered by start and kind."""
    scratch = Scratch(docs.sparkSession, "secrets")
    found = free_name(docs, "found")
    scanned = scratch.keep(docs.withColumn(found, _scan(F.col(text_col))))
    f = F.col(found)
    codes = F.explode(F.transform(f["runs"], lambda r: r["bin"] * P_BINS + r["p"]))
    counts = dict(scanned.select(codes.alias("c")).groupBy("c").count().collect())
    limit, per = [], LENGTH_BINS * P_BINS
    for k in range(len(ENCODINGS)):
        limit += cuts({c - k * per: n for c, n in counts.items() if c // per == k}, fdr)
    limits = F.array(*[F.lit(x) for x in limit])
    flagged = F.transform(
        F.filter(f["runs"], lambda r: r["p"] <= F.get(limits, r["bin"])),
        lambda r: F.struct(F.lit(KINDS.index("random")).alias("kind"), r["first"].alias("first"), r["last"].alias("last")),
    )
    spans = F.transform(
        F.array_sort(F.transform(F.concat(f["base"], flagged), lambda s: F.struct(s["first"], s["kind"], s["last"]))),
        lambda s: F.struct(s["kind"].alias("kind"), s["first"].alias("first"), s["last"].alias("last")),
    )
    return scanned.withColumn(out, spans).drop(found)


def redact(docs: DataFrame, mark: str = "[REDACTED]", fdr: float = 0.01, text_col: str = "text", length_col: str | None = "n_chars") -> DataFrame:
    """All documents, each secret span replaced by ``mark``; ``length_col``, if the documents
    have it, is the new length of a changed text."""

    @F.arrow_udf("string")
    def cut(column: pa.Array, spans: pa.Array) -> pa.Array:
        out = []
        for text, found in zip(column.to_pylist(), spans.to_pylist(), strict=True):
            if found:
                parts, end = [], 0
                for s in found:
                    if s["first"] >= end:
                        parts += [text[end : s["first"]], mark]
                    end = max(end, s["last"])
                text = "".join([*parts, text[end:]])
            out.append(text)
        return pa.array(out, pa.string())

    spans = free_name(docs, "spans")
    found = scan_secrets(docs, spans, fdr, text_col).withColumn(text_col, cut(F.col(text_col), F.col(spans)))
    if length_col in docs.columns:
        changed = F.when(F.size(spans) > 0, F.length(text_col).cast(docs.schema[length_col].dataType)).otherwise(F.col(length_col))
        found = found.withColumn(length_col, changed)
    return found.select(*docs.columns)


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["first"], s["last"])), ",")


def op4_secrets(spark, sf_dir: str) -> DataFrame:
    """Secret spans of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    s = F.col("found")
    n = lambda kind: F.size(F.filter(s, lambda x: x["kind"] == KINDS.index(kind))).cast("long").alias(f"n_{kind}")
    base = F.filter(s, lambda x: x["kind"] < KINDS.index("random"))
    return scan_secrets(docs, "found").select(
        "doc_id",
        n("assign"),
        n("access"),
        n("hex"),
        F.sha2(_joined(base).cast("binary"), 256).alias("base_sha256"),
        _joined(s).alias("spans"),
        n("random"),
    )
