"""Language identification by a byte convolutional network, trained in numpy.

Filters of widths 2, 3 and 4 run over the bytes (A-Z lower-cased) of a window of
``LENGTH`` bytes; each filter's largest response in the window passes a rectifier into a
softmax over the languages. A text is cut into consecutive windows, all of them are scored
in batches, and their probabilities are averaged, weighted by the bytes they hold.

The network is fitted on at most ``max_docs`` labelled documents a language (those with the
smallest hash of their id) and ``max_windows`` evenly spaced windows of each, so the fit and
the broadcast weights are bounded; every document is classified over its whole text.

Defined results: a NULL text, or one without a letter, is ``und`` with score 0; without a
labelled document every text is ``und`` with score 0; documents with a NULL language are
not learned; one learned language is always predicted with score 1. All columns are kept.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_sample, fold, slices, table, texts

LENGTH, FILTERS, WIDTHS = 192, 12, (2, 3, 4)
_OFFSETS = sum(WIDTHS)
_LOWER = bytes(range(256)).lower()
_ASCII_LETTER = re.compile(rb"[A-Za-z]")
_LETTER = re.compile(r"[^\W\d_]")
UNDETERMINED = "und"


def has_letter(text: bytes) -> bool:
    return bool(_ASCII_LETTER.search(text) or _LETTER.search(text.decode("utf-8", "replace")))


def windows(text: bytes) -> np.ndarray:
    """Consecutive windows of LENGTH bytes, the last one filled with blanks."""
    data = np.frombuffer(text.translate(_LOWER), np.uint8)
    n = max(1, -(-len(data) // LENGTH))
    out = np.full(n * LENGTH, 0x20, np.uint8)
    out[: len(data)] = data
    return out.reshape(n, LENGTH)


class ByteConvNet:
    """Multi-width filters -> max pooling -> rectifier -> softmax."""

    def __init__(self, classes: list[str], seed: int = 7):
        rng = np.random.default_rng(seed)
        self.classes = classes
        # conv[o] is the weight of each byte value at one offset of one width.
        self.conv = rng.normal(0, 0.3, (_OFFSETS, 256, FILTERS)).astype(np.float32)
        self.bias = np.zeros(len(WIDTHS) * FILTERS, np.float32)
        self.out = rng.normal(0, 0.1, (len(WIDTHS) * FILTERS, len(classes))).astype(np.float32)
        self.out_bias = np.zeros(len(classes), np.float32)

    def params(self) -> list[np.ndarray]:
        return [self.conv, self.bias, self.out, self.out_bias]

    def prepare(self) -> None:
        """Responses to byte pairs, so a window needs two look-ups a position instead of nine.

        Offsets (0, 1) of every width, and offsets (2, 3) of the widths that reach there."""
        c = dict(zip([(w, o) for w in WIDTHS for o in range(w)], self.conv, strict=True))
        pair = lambda w: c[w, 0][:, None] + c[w, 1][None, :]
        self.head = np.concatenate([pair(w) for w in WIDTHS], axis=2).reshape(65536, -1)
        tail = [np.broadcast_to(c[3, 2][:, None], (256, 256, FILTERS)), c[4, 2][:, None] + c[4, 3][None, :]]
        self.tail = np.concatenate(tail, axis=2).reshape(65536, -1)

    def responses(self, x: np.ndarray) -> np.ndarray:
        """(window, position, filter) of windows (n, LENGTH); every width sees the same positions."""
        pairs = (x[:, :-1].astype(np.int32) << 8) | x[:, 1:]
        r = np.take(self.head, pairs[:, :-2], axis=0)
        r[:, :, FILTERS:] += np.take(self.tail, pairs[:, 2:], axis=0)
        return r

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        parts = [np.zeros((0, len(self.classes)))]
        for i in range(0, len(x), 256):
            pooled = np.maximum(self.responses(x[i : i + 256]).max(axis=1) + self.bias, 0)
            parts.append(_softmax(pooled @ self.out + self.out_bias))
        return np.concatenate(parts)

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int = 6, batch: int = 64, rate: float = 3e-3, seed: int = 11) -> None:
        """Adam on the cross-entropy; only a filter's best position gets its gradient."""
        rng = np.random.default_rng(seed)
        state = [(np.zeros_like(p), np.zeros_like(p)) for p in self.params()]
        places = [(w, o) for w in WIDTHS for o in range(w)]
        step, updates = 0, max(300, epochs * -(-len(x) // batch))
        order = np.zeros(0, np.int64)
        for step in range(1, updates + 1):
            if len(order) < min(batch, len(x)):
                order = rng.permutation(len(x))
            pick, order = order[:batch], order[batch:]
            r = self._train_responses(x[pick])
            best = r.argmax(axis=1)
            rows = np.arange(len(pick))[:, None]
            pooled = r[rows, best, np.arange(r.shape[2])[None, :]] + self.bias
            active = np.maximum(pooled, 0)
            p = _softmax(active @ self.out + self.out_bias)
            p[np.arange(len(pick)), y[pick]] -= 1
            p /= len(pick)
            back = (p @ self.out.T) * (pooled > 0)
            conv = np.zeros_like(self.conv)
            for k, (w, o) in enumerate(places):
                f = WIDTHS.index(w) * FILTERS + np.arange(FILTERS)
                byte = x[pick][rows, best[:, f] + o]
                np.add.at(conv[k], (byte, np.arange(FILTERS)[None, :]), back[:, f])
            grads = [conv, back.sum(axis=0), active.T @ p, p.sum(axis=0)]
            for param, grad, (m, v) in zip(self.params(), grads, state, strict=True):
                m += 0.1 * (grad - m)
                v += 0.001 * (grad * grad - v)
                param -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        self.prepare()

    def _train_responses(self, x: np.ndarray) -> np.ndarray:
        positions = LENGTH - max(WIDTHS) + 1
        parts, k = [], 0
        for w in WIDTHS:
            parts.append(sum(self.conv[k + o][x[:, o : o + positions]] for o in range(w)))
            k += w
        return np.concatenate(parts, axis=2)

    def predict(self, documents: list[bytes | None]) -> tuple[list[str], np.ndarray]:
        """Language and score of each text."""
        names, scores = [UNDETERMINED] * len(documents), np.zeros(len(documents))
        known = [i for i, t in enumerate(documents) if self.classes and t and has_letter(t)]
        for lo, hi in slices([documents[i] for i in known], 1 << 20):
            cut = [windows(documents[i]) for i in known[lo:hi]]
            p = self.probabilities(np.concatenate(cut))
            sizes = np.array([len(c) for c in cut])
            weight = np.full(len(p), float(LENGTH))
            weight[np.cumsum(sizes) - 1] = [(len(documents[i]) - 1) % LENGTH + 1 for i in known[lo:hi]]
            total = np.add.reduceat(p * weight[:, None], np.cumsum(sizes) - sizes, axis=0)
            total /= total.sum(axis=1, keepdims=True)
            for i, row in zip(known[lo:hi], total, strict=True):
                names[i], scores[i] = self.classes[int(row.argmax())], min(1.0, float(row.max()))
        return names, scores


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def training_windows(docs: DataFrame, max_docs: int, max_windows: int, folds: int, held_out: int, id_col: str, text_col: str, lang_col: str) -> list:
    """(language, window text) rows: ``max_windows`` evenly spaced parts of ``max_docs`` documents a language."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    rows = rows.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (F.coalesce(fold("id", folds), F.lit(-1)) != held_out))
    kept = bounded_sample(rows.select("id", "lang", F.xxhash64("text").alias("h")), "lang", max_docs, ["id", "h"])
    # At most max_docs rows a language: bounded by the parameter, so broadcast.
    same = F.broadcast(kept.select(F.col("id").alias("k"), F.col("lang").alias("l"), "h", "__rank"))
    match = F.col("id").eqNullSafe(F.col("k")) & (F.col("lang") == F.col("l")) & (F.xxhash64("text") == F.col("h"))
    part = lambda i: F.substring("text", F.floor(i * F.length("text") / max_windows).cast("int") + 1, F.lit(LENGTH))
    cut = rows.join(same, match).select("lang", "__rank", F.transform(F.sequence(F.lit(0), F.lit(max_windows - 1)), part).alias("parts"))
    found = sorted((r["lang"], r["__rank"], tuple(r["parts"])) for r in cut.distinct().collect())
    return [(lang, p) for lang, _, parts in found for p in dict.fromkeys(parts) if p.strip()]


def fit(rows: list[tuple[str, str]]) -> ByteConvNet:
    classes = sorted({lang for lang, _ in rows})
    net = ByteConvNet(classes)
    if len(classes) > 1:
        x = np.concatenate([windows(p.encode()[:LENGTH]) for _, p in rows])
        net.fit(x, np.array([classes.index(lang) for lang, _ in rows]))
    else:
        net.prepare()
    return net


def identify_languages(
    docs: DataFrame,
    out: str = "language",
    max_docs: int = 400,
    max_windows: int = 8,
    folds: int = 5,
    held_out: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
) -> DataFrame:
    """``docs`` with the struct column ``out``: lang and score (0 to 1). Ids whose crc32 modulo
    ``folds`` is ``held_out`` are never learned."""
    net = fit(training_windows(docs, max_docs, max_windows, folds, held_out, id_col, text_col, lang_col))
    net.head = net.tail = None  # built again from the filters by each worker
    shared = docs.sparkSession.sparkContext.broadcast(net)

    @F.arrow_udf("struct<lang:string,score:double>")
    def identify(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        net = shared.value
        if net.head is None:
            net.prepare()
        for column in batches:
            names, scores = net.predict(texts(column))
            yield pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=["lang", "score"])

    return docs.withColumn(out, identify(F.col(text_col)))


def op2_language_id(spark, sf_dir: str) -> DataFrame:
    """Language of every document, learned from four folds."""
    found = identify_languages(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"), "found")
    held_out = F.coalesce(fold("doc_id", 5) == 0, F.lit(False)).alias("held_out")
    return found.select("doc_id", held_out, F.col("found.lang").alias("lang_pred"), F.col("found.score").alias("score"))
