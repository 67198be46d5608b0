"""Fill-in-middle transformation by displacement scatter.

A text is cut into tokens (runs of ASCII letters, or one other code point), two cuts give
prefix, middle and suffix, and these are put out in another order between the marks
``<P>``, ``<S>`` and ``<M>``. All texts of an Arrow batch are handled as one array of bytes:
the cuts are read off the batch's token starts, each piece has one displacement, a difference
array holds where the displacement changes, its cumulative sum is every byte's shift, and one
scatter puts all bytes in their place. The way back finds the marks, builds the displacements
of the restored bytes in the same way, and gathers them. Both go through the batch in blocks
of ``BLOCK`` bytes, so apart from the texts themselves memory doesn't grow with a text's length.

Defined results: a NULL text is empty; empty texts and texts that hold a mark are ``plain``
(put out unchanged, no piece lengths); a NULL id draws its cuts as the empty id; a cut may be at
either end, so pieces may be empty; repeated rows give the same output; empty tables give no
rows. Every input column is kept, whatever its name. Texts are cut between code points only.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .common import table

# Fixed values of the contract.
MARKS = (b"<P>", b"<S>", b"<M>")
PLAIN, PSM, SPM = "plain", "psm", "spm"
BLOCK = 1 << 20
RESULT = "struct<n:long,form:string,prefix_chars:long,middle_chars:long,output:string>"


def draws(doc_id, seed: int = 1) -> tuple[int, int, int, int]:
    """Four 32-bit draws from the id."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return tuple(int.from_bytes(digest[i : i + 4], "big") for i in range(0, 16, 4))


def choose_form(h3: int, h4: int, plain_percent: int = 10, spm_percent: int = 20) -> str:
    if h3 % 100 >= 100 - plain_percent:
        return PLAIN
    return SPM if h4 % 100 < spm_percent else PSM


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column and the n + 1 places where its texts start and end; NULL is empty."""
    column = column.fill_null("")
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[at[0] : at[-1]] if len(at) else whole[:0], at - at[0] if len(at) else np.zeros(1, np.int64)


def to_column(data: np.ndarray, at: np.ndarray) -> pa.Array:
    out = pa.Array.from_buffers(pa.large_string(), len(at) - 1, [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(data)])
    return out.cast(pa.string())


def token_starts(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every byte: does a token start here, does a code point start here."""
    letter = ((data | 0x20) - np.uint8(97)) < 26
    point = (data & 0xC0) != 0x80
    start = point.copy()
    start[1:] &= ~(letter[1:] & letter[:-1])
    start[at[:-1][at[:-1] < at[1:]]] = True  # two texts never share a token
    return start, point


def per_text(mask: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many set places each text has."""
    out = np.zeros(len(at) - 1, np.int64)
    some = np.flatnonzero(at[1:] > at[:-1])
    if len(some):
        out[some] = np.add.reduceat(mask, at[some], dtype=np.int64)
    return out


def nth_set(mask: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """Place of the set bits with these ascending ranks (from 0)."""
    out, seen, lo = np.empty(len(ranks), np.int64), 0, 0
    for b in range(0, len(mask), BLOCK):
        part = mask[b : b + BLOCK]
        n = int(np.count_nonzero(part))
        hi = int(np.searchsorted(ranks, seen + n, "left"))
        if hi > lo:
            out[lo:hi] = b + np.flatnonzero(part)[ranks[lo:hi] - seen]
        seen, lo = seen + n, hi
    return out


def shifts(at: np.ndarray, moved: np.ndarray, total: int):
    """Blocks (lo, hi, shift of every place in it) of a displacement ``moved[i]`` that holds from
    ``at[i]`` (ascending) on: the cumulative sum of a difference array."""
    step = np.diff(moved, prepend=0)
    carry = 0
    for lo in range(0, total, BLOCK):
        hi = min(total, lo + BLOCK)
        a, b = np.searchsorted(at, [lo, hi], "left")
        change = np.zeros(hi - lo, np.int64)
        np.add.at(change, at[a:b] - lo, step[a:b])
        change[0] += carry
        shift = np.cumsum(change, out=change)
        carry = int(shift[-1])
        yield lo, hi, shift


def piece_starts(form: np.ndarray, prefix: np.ndarray, middle: np.ndarray, suffix: np.ndarray) -> np.ndarray:
    """Where prefix, middle and suffix begin in a text's output, one row a text (form: 0 plain, 1 psm, 2 spm)."""
    psm = np.stack([np.full_like(prefix, 3), 9 + prefix + suffix, 6 + prefix], 1)
    spm = np.stack([6 + suffix, 9 + prefix + suffix, np.full_like(prefix, 3)], 1)
    plain = np.stack([np.zeros_like(prefix), prefix, prefix + middle], 1)
    return np.where(form[:, None] == 1, psm, np.where(form[:, None] == 2, spm, plain))


def scatter(data: np.ndarray, at: np.ndarray, form: np.ndarray, cut1: np.ndarray, cut2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Outputs of all texts; cut1 <= cut2 are places in ``data``."""
    starts, ends = at[:-1], at[1:]
    out_at = np.concatenate([[0], np.cumsum(ends - starts + np.where(form > 0, 9, 0))])
    begin = out_at[:-1, None] + piece_starts(form, cut1 - starts, cut2 - cut1, ends - cut2)
    source = np.stack([starts, cut1, cut2], 1)
    out = np.empty(int(out_at[-1]), np.uint8)
    for lo, hi, shift in shifts(source.ravel(), (begin - source).ravel(), len(data)):
        shift += np.arange(lo, hi)
        out[shift] = data[lo:hi]
    marked = np.flatnonzero(form > 0)
    for mark, col in zip(MARKS, (0, 2, 1), strict=True):  # each mark stands right before its piece
        places = begin[marked, col] - 3
        for k, byte in enumerate(mark):
            out[places + k] = byte
    return out, out_at


def gather(data: np.ndarray, at: np.ndarray, form: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts back from their outputs: found marks give each restored byte its displacement."""
    length = at[1:] - at[:-1]
    size = np.where(form > 0, length - 9, length)
    back_at = np.concatenate([[0], np.cumsum(size)])
    prefix, middle = size.copy(), np.zeros(len(size), np.int64)
    for i in np.flatnonzero(form > 0).tolist():
        text = data[at[i] : at[i + 1]].tobytes()
        if form[i] == 1:
            s = text.index(MARKS[1])
            m = text.index(MARKS[2], s)
            prefix[i] = s - 3
        else:
            p = text.index(MARKS[0])
            m = text.index(MARKS[2], p)
            prefix[i] = m - p - 3
        middle[i] = length[i] - m - 3
    begin = at[:-1, None] + piece_starts(form, prefix, middle, size - prefix - middle)
    target = back_at[:-1, None] + np.stack([np.zeros_like(prefix), prefix, prefix + middle], 1)
    out = np.empty(int(back_at[-1]), np.uint8)
    for lo, hi, shift in shifts(target.ravel(), (begin - target).ravel(), len(out)):
        shift += np.arange(lo, hi)
        out[lo:hi] = data[shift]
    return out, back_at


def _forms(names: list) -> np.ndarray:
    code = {PSM: 1, SPM: 2}
    return np.array([code.get(x, 0) for x in names], np.int64)


def fill_in_middle(docs: DataFrame, out: str = "fim", id_col: str = "doc_id", text_col: str = "text", seed: int = 1, plain_percent: int = 10, spm_percent: int = 20) -> DataFrame:
    """``docs`` with the struct column ``out``: n (tokens), form, prefix_chars and middle_chars
    (code points, NULL if plain) and the output text."""

    @F.arrow_udf(RESULT)
    def transform(column: pa.Array, ids: pa.Array) -> pa.Array:
        data, at = flat(column)
        start, point = token_starts(data, at)
        n = per_text(start, at)
        before = np.concatenate([[0], np.cumsum(n)])[:-1]
        names, first, second = [], np.zeros(len(n), np.int64), np.zeros(len(n), np.int64)
        for i, doc_id in enumerate(ids.to_pylist()):
            h1, h2, h3, h4 = draws(doc_id, seed)
            text = data[at[i] : at[i + 1]].tobytes()
            form = PLAIN if not text or any(m in text for m in MARKS) else choose_form(h3, h4, plain_percent, spm_percent)
            names.append(form)
            first[i], second[i] = sorted((h1 % (int(n[i]) + 1), h2 % (int(n[i]) + 1)))
        form = _forms(names)
        cuts = []
        for c in (first, second):
            inside = c < n  # else the cut is the text's end
            place = at[1:].copy()
            place[inside] = nth_set(start, (before + c)[inside])
            cuts.append(place)
        cut1, cut2 = cuts
        outputs = to_column(*scatter(data, at, form, cut1, cut2))
        bounds = np.stack([at[:-1], cut1, cut2], 1).ravel()
        points = per_text(point, np.append(bounds, at[-1])).reshape(-1, 3)
        plain = form == 0
        return pa.StructArray.from_arrays(
            [pa.array(n), pa.array(names, pa.string()), pa.array(points[:, 0], mask=plain), pa.array(points[:, 1], mask=plain), outputs],
            names=["n", "form", "prefix_chars", "middle_chars", "output"],
        )

    return docs.withColumn(out, transform(F.col(text_col), F.col(id_col).cast("string")))


@F.arrow_udf(StringType())
def restore(outputs: pa.Array, forms: pa.Array) -> pa.Array:
    """The original text of an output and its form (NULL form: plain)."""
    data, at = flat(outputs)
    return to_column(*gather(data, at, _forms(forms.to_pylist())))


def op12_fill_middle(spark, sf_dir: str) -> DataFrame:
    """Fill-in-middle output of every document, and the text rebuilt from it."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    done = fill_in_middle(docs).withColumn("restored", restore("fim.output", "fim.form"))
    return done.select(
        "doc_id",
        "fim.n",
        "fim.form",
        "fim.prefix_chars",
        "fim.middle_chars",
        F.sha2(F.col("fim.output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(F.col("restored").cast("binary"), 256).alias("restored_sha256"),
    )
