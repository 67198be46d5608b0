"""Toxicity by class-conditional Kneser-Ney models.

Two models of the bytes of a word, given up to ``ORDER - 1`` bytes before them in the
word, are learned from labelled texts: one from toxic, one from ordinary documents.
The highest order has counts per class; every lower order is the Kneser-Ney
continuation count shared by both, so an expression that one class never showed falls
back to the same probability in both and says little either way. The two
log-likelihoods of a window of ``WINDOW`` words are divided by its length (a word that
recurs in the window counts once in it); a document is described by its highest window
difference, by the mean difference of its distinct words and by that of the ``TOP`` words among
them with the highest differences, which don't shrink with the text around them. A logistic fit on
labelled documents that the counts didn't use turns these into a score.

The fit uses at most ``max_rows`` labelled documents of each class (those with the
smallest hash of their id), so the model that is broadcast is bounded; the logistic fit
weights them by the labelled documents of the class each stands for, so the cap doesn't
move the threshold. Scoring reads every document whole.

Defined results: NULL, empty and blank texts score like a text without evidence; without
a labelled document of both classes every score is 0 (or 1 if all are toxic); labels that
are NULL, and labels without a document, are ignored; a document with several labels is
toxic if one says so. All columns of the documents are kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_sample, fold, free_name, slices, alnum_words, table, texts

ORDER = 8  # bytes: a context and its byte are one 64-bit key
WINDOW, STRIDE, TOP = 8, 4, 3
_CACHE = 300_000
_END = 0x20


def word_grams(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit keys of the ORDER-byte windows that end at each byte (and at the end) of
    each word, padded with zero bytes in front, and the word each belongs to."""
    pad = bytes(ORDER - 1)
    flat = np.frombuffer(pad + b"".join([w + b"\x20" + pad for w in words]), np.uint8).astype(np.uint64)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
    keys = np.zeros(len(flat) - ORDER + 1, np.uint64)
    for i in range(ORDER):
        keys = (keys << np.uint64(8)) | flat[i : i + len(keys)]
    owner = np.repeat(np.arange(len(words)), sizes)
    first = np.cumsum(sizes + ORDER - 1) - sizes - (ORDER - 1)
    at = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(first, sizes)
    return keys[at], owner


def _find(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray, missing: float) -> np.ndarray:
    if not len(keys):
        return np.full(len(wanted), missing)
    i = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[i] == wanted, values[i], missing)


def class_discount(count: np.ndarray) -> np.ndarray:
    """What is taken off a count of the highest order: all of a single one, so that what one
    document alone has is left to the shared backoff, and less of what recurs."""
    return np.select([count <= 1, count <= 2], [count, 1.25], 1.5)


class KneserNey:
    """The log-likelihood ratio of the two class models, as two sorted tables."""

    def __init__(self, counts: list[tuple[np.ndarray, np.ndarray]], discount: float = 0.75):
        """counts: for the ordinary and the toxic class, distinct grams and their counts."""
        grams = np.unique(np.concatenate([g for g, _ in counts]))
        shared = self._shared(grams, discount)
        self.grams, self.contexts = grams, np.unique(grams >> np.uint64(8))
        at = np.searchsorted(self.contexts, grams >> np.uint64(8))
        seen, unseen = [], []
        for g, c in counts:
            own = np.zeros(len(grams))
            own[np.searchsorted(grams, g)] = c
            cut = class_discount(own)
            total, off = np.bincount(at, own, len(self.contexts)), np.bincount(at, cut, len(self.contexts))
            with np.errstate(divide="ignore", invalid="ignore"):
                back = np.where(total > 0, off / total, 1.0)
                p = np.where(total[at] > 0, (own - cut) / total[at], 0) + back[at] * shared
            seen.append(np.log(p))
            unseen.append(np.log(back))
        self.gram_ratio, self.context_ratio = seen[1] - seen[0], unseen[1] - unseen[0]

    @staticmethod
    def _shared(grams: np.ndarray, discount: float) -> np.ndarray:
        """Interpolated continuation probability of each gram's byte after its shorter contexts."""
        p = np.full(len(grams), 1 / 256)
        for size in range(1, ORDER):
            mask = np.uint64((1 << 8 * size) - 1)
            longer = np.unique(grams & np.uint64((1 << 8 * (size + 1)) - 1))
            keys, kinds = np.unique(longer & mask, return_counts=True)  # distinct bytes before each gram
            context = keys >> np.uint64(8)
            names, at = np.unique(context, return_inverse=True)
            total, types = np.bincount(at, kinds), np.bincount(at)
            i = np.searchsorted(keys, grams & mask)
            j = at[i]
            p = np.maximum(kinds[i] - discount, 0) / total[j] + discount * types[j] / total[j] * p
        return p

    def words(self, words: list[bytes]) -> np.ndarray:
        """Log-likelihood ratio of each word."""
        if not words:
            return np.zeros(0)
        keys, owner = word_grams(words)
        back = _find(self.contexts, self.context_ratio, keys >> np.uint64(8), 0.0)
        i = np.minimum(np.searchsorted(self.grams, keys), len(self.grams) - 1)
        ratio = np.where(self.grams[i] == keys, self.gram_ratio[i], back)
        return np.bincount(owner, ratio, len(words))


class ToxicityModel:
    def __init__(self, ratios: KneserNey | None, weights: np.ndarray | None, constant: float = 0.0):
        self.ratios, self.weights, self.constant = ratios, weights, constant
        self.cache: dict[bytes, int] = {}  # word -> place of its ratio in values
        self.values = np.zeros(0)

    def __getstate__(self):
        return self.__dict__ | {"cache": {}, "values": np.zeros(0)}

    def features(self, documents: list[bytes]) -> np.ndarray:
        """Highest window mean, overall mean and mean of the top words' length-normalised ratios, per document."""
        words = [alnum_words(t) for t in documents]
        new = list(set(chain.from_iterable(words)) - self.cache.keys())
        if len(self.cache) + len(new) > _CACHE:
            self.cache.clear()
            new = list(set(chain.from_iterable(words)))
        first = len(self.cache)
        self.values = np.concatenate([self.values[:first], self.ratios.words(new)])
        self.cache.update(zip(new, range(first, first + len(new)), strict=True))
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        codes = np.fromiter(map(self.cache.__getitem__, chain.from_iterable(words)), np.int64, int(sizes.sum()))
        # The place where the document has the same word before, or -1.
        owner = np.repeat(np.arange(len(words)), sizes)
        keys = owner * len(self.values) + codes
        order = np.argsort(keys, kind="stable")
        again = keys[order[1:]] == keys[order[:-1]]
        before = np.full(len(codes), -1)
        before[order[1:][again]] = order[:-1][again]
        values, new = self.values[codes], before < 0
        ends = np.cumsum(sizes)
        starts = ends - sizes
        # Over the whole text each distinct word counts once, in the sum and in its length.
        mean = np.bincount(owner[new], values[new], len(words)) / np.maximum(np.bincount(owner[new], minlength=len(words)), WINDOW)
        # Windows start every STRIDE words; the last one ends with the text.
        n = np.maximum(1, -(-np.maximum(sizes - WINDOW, 0) // STRIDE) + 1)
        doc = np.repeat(np.arange(len(words)), n)
        k = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        lo = starts[doc] + np.maximum(0, np.minimum(k * STRIDE, sizes[doc] - WINDOW))
        total = np.zeros(len(lo))
        for k in range(WINDOW if len(codes) else 0):
            at = np.minimum(lo + k, len(codes) - 1)
            total += np.where((lo + k < ends[doc]) & (before[at] < lo), values[at], 0)
        best = np.maximum.reduceat(total / WINDOW, np.cumsum(n) - n) if len(words) else np.zeros(0)
        # The TOP distinct words that speak most for toxicity, zero where a text has fewer.
        place = np.flatnonzero(new)
        place = place[np.lexsort((-values[place], owner[place]))]
        rank = np.arange(len(place)) - np.searchsorted(owner[place], owner[place])
        place = place[(rank < TOP) & (values[place] > 0)]
        top = np.bincount(owner[place], values[place], len(words)) / TOP
        return np.column_stack([best, mean, top])

    def score(self, documents: list[bytes]) -> np.ndarray:
        if self.ratios is None:
            return np.full(len(documents), self.constant)
        out = [np.zeros(0)]
        for lo, hi in slices(documents, 2 << 20):
            z = np.column_stack([self.features(documents[lo:hi]), np.ones(hi - lo)]) @ self.weights
            out.append(1 / (1 + np.exp(-np.clip(z, -50, 50))))
        return np.concatenate(out)


def _counts(documents: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Grams of the documents' words. A word counts once for each different word before it: copies
    of a document, or a line it repeats, are no further evidence."""
    pairs: set[bytes] = set()
    for t in documents:
        words = alnum_words(t)
        pairs.update(map(b" ".join, zip([b"", *words], words)))
    words, grams, counts = [p.rpartition(b" ")[2] for p in pairs], np.zeros(0, np.uint64), np.zeros(0)
    for lo in range(0, len(words), 100_000):
        g, c = np.unique(word_grams(words[lo : lo + 100_000])[0], return_counts=True)
        grams, at = np.unique(np.concatenate([grams, g]), return_inverse=True)
        counts = np.bincount(at, np.concatenate([counts, c]), len(grams))
    return grams, counts


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Newton steps for a ridge logistic regression of weighted rows with an intercept."""
    x = np.column_stack([x, np.ones(len(x))])
    w, penalty = np.zeros(x.shape[1]), ridge * np.diag([1.0] * (x.shape[1] - 1) + [1e-3])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -50, 50)))
        step = np.linalg.solve(x.T @ (x * (weight * p * (1 - p))[:, None]) + penalty, x.T @ (weight * (y - p)) - penalty @ w)
        w += np.clip(step, -5, 5)
    return w


def fit(rows: list[tuple[bytes, int]], sizes: dict[int, int] | None = None) -> ToxicityModel:
    """A model from (text, label) rows in a fixed order; counts and weights use different thirds in turn,
    copies of a text being in one third. ``sizes``: the labelled documents of each class, of which the rows are a sample."""
    labels = np.array([y for _, y in rows], np.int64)
    if not len(rows) or labels.min() == labels.max():
        return ToxicityModel(None, None, float(labels.max()) if len(rows) else 0.0)
    documents = [t for t, _ in rows]

    def ratios(keep) -> KneserNey:
        return KneserNey([_counts([t for t, y, k in zip(documents, labels, keep, strict=True) if k and y == label]) for label in (0, 1)])

    part = np.zeros(len(rows), np.int64)
    for label in (0, 1):
        distinct: dict[bytes, int] = {}
        for i in np.flatnonzero(labels == label).tolist():
            part[i] = distinct.setdefault(documents[i], len(distinct)) % 3
    x = np.zeros((len(rows), 3))
    for k in range(3):
        out = part == k
        if out.any() and len(set(labels[~out])) == 2:
            model = ToxicityModel(ratios(~out), None)
            held = [documents[i] for i in np.flatnonzero(out)]
            x[out] = np.concatenate([model.features(held[lo:hi]) for lo, hi in slices(held, 2 << 20)])
    kept = np.bincount(labels, minlength=2)
    share = np.array([sizes[0], sizes[1]], float) if sizes else kept.astype(float)
    weight = (share / share.sum() * kept.sum() / kept)[labels]  # 1 where nothing is left out
    return ToxicityModel(ratios(np.ones(len(rows), bool)), _logistic(x, labels, weight))


def training_rows(docs: DataFrame, labels: DataFrame, max_rows: int, id_col: str, text_col: str, folds: int, held_out: int) -> tuple[list, dict[int, int]]:
    """At most ``max_rows`` labelled texts of each class, in the order of a hash of the id, and each class's documents."""
    marked = labels.where(F.col("toxic").isin(0, 1)).groupBy(F.col("doc_id").alias("_id")).agg(F.max("toxic").alias("_y"))
    marked = marked.where(fold("_id", folds) != held_out)
    texts_of = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_t"))
    # Labelled documents that exist are ranked on ids alone; the texts are joined to the few that are kept.
    known = marked.join(texts_of.select("_id").distinct(), "_id", "left_semi")
    kept = bounded_sample(known, "_y", max_rows, ["_id"])
    # At most max_rows rows a class: bounded by the parameter, so broadcast.
    chosen = texts_of.join(F.broadcast(kept), "_id").groupBy("_id", "_y", "__rank").agg(F.min("_t").alias("_t"))
    rows = [((r["_t"] or "").encode(), r["_y"], r["__rank"]) for r in chosen.collect()]
    sizes = {r["_y"]: r["count"] for r in known.groupBy("_y").count().collect()}
    return [(t, y) for t, y, _ in sorted(rows, key=lambda r: r[1:])], sizes


def score_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    out: str = "score",
    max_rows: int = 1500,
    folds: int = 5,
    held_out: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``docs`` with the double column ``out`` (0 to 1). Labels of ids whose crc32 modulo
    ``folds`` is ``held_out`` are never learned."""
    model = fit(*training_rows(docs, labels, max_rows, id_col, text_col, folds, held_out))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            yield pa.array(shared.value.score(texts(column)), pa.float64())

    return docs.withColumn(out, score.asNondeterministic()(F.col(text_col)))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, **options) -> DataFrame:
    """The documents that score below ``threshold``, all columns unchanged."""
    score = free_name(docs, "score")
    return score_toxicity(docs, labels, score, **options).where(F.col(score) < threshold).drop(score)


def op9_toxicity(spark, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from four folds of the labels."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score_toxicity(docs, table(spark, sf_dir, "labels"))
    held_out = F.coalesce(fold("doc_id", 5) == 0, F.lit(False)).alias("held_out")
    return scored.select("doc_id", held_out, "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
