"""Gated recurrent language model, scored over whole documents.

The corpus gives the counts of all tokens (words, and an end per document) of the training
documents. Its ``head`` most frequent words are the model's own; every other word belongs to
one of ``tails`` classes by its last bytes. The output softmax is factored: first over the
classes (``classes`` of head words, binned by frequency, and the tail classes), then over the
members, by a second softmax in a head class and by the add-one count share in a tail class.
So the model is a distribution over all known words and one unknown word a tail class.

The network is trained by truncated backpropagation in numpy, in ``rounds`` rounds. In a
round every task trains a copy on its own documents of the round, and the copies are
averaged, weighted by tokens, in groups of ``_GROUP`` at a time until one is left (a copy is bounded by the
number of parameters); what is trained on grows with the corpus. The optimizer's moments are averaged with
the parameters, so a round goes on where the last one ended. ``share`` is the part of
the training documents that all rounds see together (1 trains on every document once).

The score mixes the network with the add-one unigram share, which alone is the better model of a small corpus. Both
give a tail word its count share, so the mixture is again one distribution. The weight is the one that
predicts the documents of the last round best, each window before it is learned from.

Scoring runs many documents side by side and carries each one's state across windows up to
its end, however long it is. Words more frequent than the broadcast table's cut (at most
``max_table`` words) have their counts at hand; the rest, rare by construction, meet
their counts in a join on the word, which no hot key can skew.

Defined results: NULL, empty and blank texts are the end token alone; NULL ids are trained
on and not held out; repeated rows are scored row by row; without a training document
both scores are 0, as is the contract's base; only the id and text columns are read.
"""

from __future__ import annotations

import heapq
import math
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import cached_property
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, fold, slices, table, texts


class Size(NamedTuple):
    classes: int
    members: int
    tails: int
    hidden: int

    @property
    def head(self) -> int:
        return self.classes * self.members


NETWORK = Size(32, 64, 32, 32)  # of documents' scores
SMALL = Size(16, 64, 16, 24)  # of a vocabulary or model made without a size
CLASSES, MEMBERS, TAILS, HIDDEN = SMALL
HEAD = SMALL.head
END = b""  # no word is empty
# Weights of the network that the mixture chooses from.
WEIGHTS = np.arange(17) / 16
_ROWS = 2048  # of logits at a time
_GROUP = 16


def tail_class(word: bytes, tails: int = TAILS) -> int:
    return zlib.crc32(word[-2:]) % tails


# ---------------------------------------------------------------- corpus counts


def split_words(column: list[bytes]) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts one after another, and how many each text has."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pa.array(column, pa.binary()).view(pa.string())))
    words, offsets = lists.flatten(), lists.offsets.to_numpy()
    real = pc.not_equal(pc.binary_length(words), 0)  # white space at an end of a text leaves an empty piece
    before = np.concatenate([[0], np.cumsum(real.to_numpy(zero_copy_only=False))])
    return words.filter(real).view(pa.binary()), np.diff(before[offsets])


def token_counts(training: DataFrame, tails: int = TAILS) -> DataFrame:
    """(word, tail, c) of all tokens; tasks add up before the shuffle, a slice of texts at a time."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            column = texts(b.column(0))
            for lo, hi in slices(column, 24 << 20):
                found = pc.value_counts(split_words(column[lo:hi])[0])
                yield pa.RecordBatch.from_arrays([found.field(0), found.field(1)], names=["word", "c"])
                yield pa.RecordBatch.from_arrays([pa.array([END], pa.binary()), pa.array([hi - lo], pa.int64())], names=["word", "c"])

    counts = training.select("text").mapInArrow(count, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))
    # As ``tail_class`` does.
    tail = F.pmod(F.crc32(F.substring("word", -2, 2)), F.lit(tails)).cast("int")
    return counts.select("word", tail.alias("tail"), "c")


class Vocabulary:
    """Model ids and log10(c + 1) of the table's words, and the shares of the tail classes."""

    def __init__(self, words: list[bytes], counts: list[int], tails: dict[int, tuple[int, int]], n_tokens: int, n_types: int, size: Size = SMALL):
        self.size, head_size = size, size.head
        order = sorted(range(len(words)), key=lambda i: (-counts[i], words[i]))
        if END in words:  # the end is always a head word
            end = words.index(END)
            place = order.index(end)
            if place >= head_size:
                order.insert(head_size - 1, order.pop(place))
        head = order[:head_size]
        self.words = pa.array([words[i] for i in order], pa.binary())
        self.log_c1 = np.log10(np.array([counts[i] for i in order], float) + 1)
        self.ids = np.array([k if k < head_size else head_size + tail_class(words[i], size.tails) for k, i in enumerate(order)], np.int32)
        self.n_tokens, self.n_types, self.weight = n_tokens, n_types, 1.0
        total, kinds = np.zeros(size.tails), np.zeros(size.tails)
        for t, (c, k) in tails.items():
            total[t], kinds[t] = c, k
        for i in head:
            total[tail_class(words[i], size.tails)] -= counts[i]
            kinds[tail_class(words[i], size.tails)] -= 1
        self.tail_tokens = total
        self.log_tail = np.log10(total + kinds + 1)  # add-one mass of a tail class with its unknown word
        self.head_counts = np.array([counts[i] for i in head] + [0] * (head_size - len(head)), float)
        # Of a head word, or of a tail class by (c + 1): what the network's probability is multiplied by, and the unigram share.
        mass = n_tokens + n_types + size.tails
        self.scale = np.concatenate([np.ones(head_size), 10.0**-self.log_tail])
        self.unigram = np.concatenate([self.head_counts + 1, np.ones(size.tails)]) / mass

    @cached_property
    def index(self) -> dict[bytes, int]:
        return {w: k for k, w in enumerate(self.words.to_pylist())}

    @cached_property
    def end(self) -> int:
        return pc.index_in(pa.scalar(END, pa.binary()), value_set=self.words).as_py()


# ---------------------------------------------------------------- the network


class GruModel:
    """Parameters: input gates by token, recurrent weights, and the two output layers."""

    NAMES = ("gates", "recurrent", "gate_bias", "classes", "class_bias", "members", "member_bias")

    def __init__(self, vocabulary: Vocabulary, seed: int = 5):
        rng, self.size = np.random.default_rng(seed), vocabulary.size
        n_classes, n_members, n_tails, n_hidden = self.size
        init = lambda *shape: rng.normal(0, 0.1, shape).astype(np.float32)
        self.gates, self.recurrent = init(self.size.head + n_tails, 3 * n_hidden), init(n_hidden, 3 * n_hidden)
        self.gate_bias = np.zeros(3 * n_hidden, np.float32)
        self.classes, self.members = init(n_hidden, n_classes + n_tails), init(n_classes, n_hidden, n_members)
        # Untrained, the model is the unigram distribution.
        members = vocabulary.head_counts.reshape(n_classes, n_members)
        mass = np.concatenate([members.sum(axis=1), vocabulary.tail_tokens])
        self.class_bias = np.log(mass + 0.5).astype(np.float32)
        self.class_bias -= self.class_bias.max()
        self.member_bias = (np.log(members + 0.01) - np.log(members.sum(axis=1, keepdims=True) + 1)).astype(np.float32)

    def params(self) -> list[np.ndarray]:
        return [getattr(self, n) for n in self.NAMES]

    def flat(self) -> np.ndarray:
        return np.concatenate([p.ravel() for p in self.params()])

    def load(self, flat: np.ndarray) -> None:
        at = 0
        for n in self.NAMES:
            p = getattr(self, n)
            setattr(self, n, flat[at : at + p.size].reshape(p.shape).astype(np.float32))
            at += p.size

    def room_of_step(self, lanes: int, steps: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Work arrays of ``step``: the recurrent input, both gates, the candidate state."""
        hidden, kind, lead = self.size.hidden, self.recurrent.dtype, () if steps is None else (steps,)
        return np.empty((*lead, lanes, 3 * hidden), kind), np.empty((*lead, 2, lanes, hidden), kind), np.empty((*lead, lanes, hidden), kind)

    def step(self, h: np.ndarray, a: np.ndarray, room: tuple | None = None) -> tuple[np.ndarray, tuple]:
        """Next state of lanes with states ``h``; ``a`` is the gates' input of the tokens they read."""
        lanes, hidden = h.shape
        u, zr, n = room or self.room_of_step(lanes)
        np.matmul(h, self.recurrent, out=u)
        # Each gate's numbers lie together from here on.
        a, by_gate = a.reshape(lanes, 3, hidden).transpose(1, 0, 2), u.reshape(lanes, 3, hidden).transpose(1, 0, 2)
        _sigmoid(np.add(a[:2], by_gate[:2], out=zr))
        np.multiply(zr[1], by_gate[2], out=n)
        n += a[2]
        n *= 2
        _sigmoid(n)  # tanh(x) = 2 * sigmoid(2 * x) - 1
        n *= 2
        n -= 1
        new = h - n
        new *= zr[0]
        new += n
        return new, (u, zr, n)

    def inputs(self) -> np.ndarray:
        return self.gates + self.gate_bias

    def _class_of(self, ids: np.ndarray) -> np.ndarray:
        return np.where(ids < self.size.head, ids // self.size.members, ids - self.size.head + self.size.classes)

    def log_probs(self, h: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """log10 of the class probability, times the member's within a head class."""
        return np.log10(self.probs(h, ids))

    def probs(self, h: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Probability of the class, times the member's within a head class."""
        cls, n_members = self._class_of(ids), self.size.members
        log, total = np.empty(len(ids)), np.empty(len(ids))
        z, bias = np.empty((_ROWS, max(self.classes.shape[1], n_members)), h.dtype), _shifted(self.classes, self.class_bias)
        for lo in range(0, len(ids), _ROWS):
            hi = min(len(ids), lo + _ROWS)
            log[lo:hi], total[lo:hi] = _softmax_at(h[lo:hi], self.classes, bias, cls[lo:hi], z)
        rows, spans = _groups(np.flatnonzero(ids < self.size.head), cls)
        if len(rows):
            own, member, bias = h.take(rows, axis=0), ids[rows] % n_members, _shifted(self.members, self.member_bias)
            logs, totals = np.empty(len(rows)), np.empty(len(rows))
            for c, first, last in spans:
                for lo in range(first, last, _ROWS):
                    hi = min(last, lo + _ROWS)
                    logs[lo:hi], totals[lo:hi] = _softmax_at(own[lo:hi], self.members[c], bias[c], member[lo:hi], z)
            log[rows] += logs
            total[rows] *= totals
        return np.exp(log) / total

    @np.errstate(over="ignore")
    def gradients(self, h0: np.ndarray, tokens: np.ndarray, keep: np.ndarray) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
        """State after a window (steps, lanes), the mean gradient, truncated at its start, and the
        probability that each token had (of its class, times the member's within a head class).

        ``keep`` is 0 where a document begins."""
        (steps, lanes), hidden, n_members = tokens.shape, self.size.hidden, self.size.members
        if getattr(self, "room", None) is None or self.room.shape != (steps, lanes):
            self.room = _Room(self, steps, lanes)
        room, ids, inputs = self.room, tokens.ravel(), self.inputs()
        inputs.take(ids, axis=0, out=room.a.reshape(len(ids), -1), mode="clip")
        begins, h = (~keep.all(axis=1)).tolist(), h0
        for t in range(steps):
            if begins[t]:
                np.multiply(h, keep[t][:, None], out=room.seen[t])
            else:
                room.seen[t] = h
            h, _ = self.step(room.seen[t], room.a[t], (room.u[t], room.zr[t], room.n[t]))
        flat = room.seen.reshape(len(ids), hidden)
        across = np.ascontiguousarray(flat.T)
        scale, cls = self.recurrent.dtype.type(1 / len(ids)), self._class_of(ids)

        bias = _shifted(self.classes, self.class_bias)
        had, p = _softmax_errors(lambda z: np.add(np.matmul(flat, self.classes, out=z), bias, out=z), cls, scale, room.p)
        classes, class_bias, back = across @ p, room.ones @ p, np.matmul(p, self.classes.T, out=room.back.reshape(len(ids), hidden))
        members, member_bias = np.zeros_like(self.members), np.zeros_like(self.member_bias)
        rows, spans = _groups(np.flatnonzero(ids < self.size.head), cls)
        if len(rows):
            own, shifted = flat.take(rows, axis=0), _shifted(self.members, self.member_bias)

            def logits(z: np.ndarray) -> np.ndarray:
                for c, lo, hi in spans:
                    np.matmul(own[lo:hi], self.members[c], out=z[lo:hi])
                    z[lo:hi] += shifted[c]
                return z

            probs, p = _softmax_errors(logits, ids[rows] % n_members, scale, room.q[: len(rows)])
            had[rows] *= probs
            across_own = np.ascontiguousarray(own.T)
            for c, lo, hi in spans:
                np.matmul(across_own[:, lo:hi], p[lo:hi], out=members[c])
                np.matmul(room.ones[: hi - lo], p[lo:hi], out=member_bias[c])
                np.matmul(p[lo:hi], self.members[c].T, out=own[lo:hi])
            back[rows] += own

        # Gradients of the inputs of a token, in this order: candidate, update gate, reset gate, and the
        # candidate's recurrent input.
        wide, recurrent = room.wide, np.ascontiguousarray(self.recurrent.T)
        dh, x, y = np.zeros_like(room.seen[0]), np.empty_like(room.seen[0]), np.empty_like(room.seen[0])
        for t in reversed(range(steps)):
            (z, r), n, un, to = room.zr[t], room.n[t], room.u[t, :, 2 * hidden :], wide[t]
            np.subtract(1, z, out=x)
            np.subtract(room.seen[t], n, out=y)
            y *= dh
            y *= z
            np.multiply(y, x, out=to[:, hidden : 2 * hidden])
            x *= dh
            np.multiply(n, n, out=y)
            np.subtract(1, y, out=y)
            x *= y
            to[:, :hidden] = x
            np.multiply(x, r, out=y)
            to[:, 3 * hidden :] = y
            y *= un
            np.subtract(1, r, out=x)
            np.multiply(y, x, out=to[:, 2 * hidden : 3 * hidden])
            np.matmul(to[:, hidden:], recurrent, out=x)
            dh *= z
            dh += x
            dh += room.back[t]
            if begins[t]:
                dh *= keep[t][:, None]
        wide = wide.reshape(len(ids), 4 * hidden)
        places = np.r_[hidden : 3 * hidden, :hidden]  # of update gate, reset gate and candidate
        order = _order(ids, self.size.head + self.size.tails)
        found, sums = _run_sums(wide.take(order, axis=0), ids[order])
        gates = np.zeros_like(self.gates)
        gates[found] = sums[:, places]
        return h, [gates, across @ wide[:, hidden:], (room.ones @ wide)[places], classes, class_bias, members, member_bias], had


class _Room:
    """Work arrays of one window's gradients."""

    def __init__(self, model: GruModel, steps: int, lanes: int):
        self.shape, hidden, kind = (steps, lanes), model.size.hidden, model.recurrent.dtype
        self.u, self.zr, self.n = model.room_of_step(lanes, steps)
        self.a, self.wide = (np.empty((steps, lanes, k * hidden), kind) for k in (3, 4))
        self.seen, self.back = np.empty((2, steps, lanes, hidden), kind)
        self.p, self.q = (np.empty((steps * lanes, k), kind) for k in (model.classes.shape[1], model.size.members))
        self.ones = np.ones(steps * lanes, kind)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    """1 / (1 + exp(-x)), in place."""
    np.negative(x, out=x)
    np.exp(x, out=x)  # where it overflows, 1 / (1 + inf) is 0
    x += 1
    return np.reciprocal(x, out=x)


def _shifted(w: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``b`` less the largest value that h @ w + b can take, states being within -1 and 1: exp can't overflow then."""
    return b - (b + np.abs(w).sum(axis=-2)).max(axis=-1, keepdims=True)


def _softmax_at(h: np.ndarray, w: np.ndarray, b: np.ndarray, at: np.ndarray, z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numerator's natural log, and denominator, of each row's softmax at one column, in the work array ``z``; ``b`` is shifted."""
    z = z.reshape(-1)[: len(h) * w.shape[1]].reshape(len(h), -1)
    np.matmul(h, w, out=z)
    z += b
    chosen = z[np.arange(len(z)), at]
    np.exp(z, out=z)
    total = z @ np.ones(z.shape[1], z.dtype)
    if total.min() < 1e-30:  # far below the bound: shift by each row's maximum
        z = h @ w + b
        top = z.max(axis=1)
        return chosen - top, np.exp(z - top[:, None]).sum(axis=1)
    return chosen, total


def _softmax_errors(logits, at: np.ndarray, scale: float, z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each row's softmax at one column, and ``scale`` times the softmax, less one at that column, of ``logits(z)`` (at most 0)."""
    np.exp(logits(z), out=z)
    ones = np.ones(z.shape[1], z.dtype)
    total = z @ ones
    if total.min() < 1e-30:  # far below the bound: shift by each row's maximum
        logits(z)
        z -= z.max(axis=1, keepdims=True)
        total = np.exp(z, out=z) @ ones
    cells = np.arange(0, z.size, z.shape[1]) + at
    had = z.reshape(-1)[cells] / total
    z *= (scale / total)[:, None]
    z.reshape(-1)[cells] -= scale
    return had, z


def _order(values: np.ndarray, top: int) -> np.ndarray:
    """Stable order of values from 0 to below ``top``; short integers are sorted by their digits."""
    return np.argsort(values.astype(np.uint16) if top <= 1 << 16 else values, kind="stable")


def _groups(rows: np.ndarray, cls: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """The given rows in the order of their class, and (class, from, to) of each class's run."""
    own = cls[rows]
    order = _order(own, int(own.max(initial=0)) + 1)
    own = own[order]
    starts = np.flatnonzero(np.diff(own, prepend=-1)).tolist()
    return rows[order], [(int(own[lo]), lo, hi) for lo, hi in zip(starts, [*starts, len(rows)][1:], strict=True)]


def _run_sums(rows: np.ndarray, keys: np.ndarray, few: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys of sorted ``keys`` and the sum of the rows of each: long runs one by one, short ones row after row, side by side."""
    starts = np.flatnonzero(np.diff(keys, prepend=-1))
    sizes = np.diff(starts, append=len(keys))
    order = np.argsort(-sizes, kind="stable")
    starts, sizes = starts[order], sizes[order]
    sums, n_long = rows[starts], int((sizes > few).sum())
    ones = np.ones(int(sizes[0]), rows.dtype)
    for i, (lo, n) in enumerate(zip(starts[:n_long].tolist(), sizes[:n_long].tolist(), strict=True)):
        np.matmul(ones[:n], rows[lo : lo + n], out=sums[i])
    for k in range(1, few):
        n = int((sizes > k).sum())
        sums[n_long:n] += rows[starts[n_long:n] + k]
    return keys[starts], sums


class Lanes:
    """Documents side by side: dealt to lanes of like length (the longest document first), lanes ordered by length.

    ``tokens``, ``keep`` (0 where a document begins) and ``doc`` are flat, step after step;
    ``bounds[t] : bounds[t + 1]`` are the lanes that go on at step t, always the first ones.
    """

    def __init__(self, documents: list[np.ndarray], n_lanes: int):
        heap = [(0, i) for i in range(min(n_lanes, len(documents)))]
        dealt: list[list[int]] = [[] for _ in heap]
        for i in sorted(range(len(documents)), key=lambda i: -len(documents[i])):
            size, lane = heapq.heappop(heap)
            dealt[lane].append(i)
            heapq.heappush(heap, (size + len(documents[i]), lane))
        sizes = {lane: size for size, lane in heap}
        order = sorted(sizes, key=lambda lane: -sizes[lane])
        ends = np.array([sizes[lane] for lane in order])
        active = np.searchsorted(-ends, -np.arange(ends.max() if len(ends) else 0), side="left")
        self.bounds = np.concatenate([[0], np.cumsum(active)])
        n = int(self.bounds[-1])
        self.tokens, self.keep, self.doc = np.zeros(n, np.int32), np.ones(n, np.float32), np.zeros(n, np.int32)
        for k, lane in enumerate(order):
            at = self.bounds[: ends[k]] + k
            step = 0
            for i in dealt[lane]:
                place = at[step : step + len(documents[i])]
                self.tokens[place], self.doc[place], self.keep[place[0]] = documents[i], i, 0
                step += len(documents[i])


class Trainer:
    """Adam over windows of ``steps`` tokens of ``lanes`` streams side by side.

    The documents follow one another in one stream that is cut into lanes of equal length; the
    state is carried from window to window and is zero where a document or a lane begins.
    """

    def __init__(self, model: GruModel, rate: float = 5e-3, lanes: int = 256, steps: int = 16, vocabulary: Vocabulary | None = None):
        self.model, self.rate, self.lanes, self.window, self.updates, self.n_tokens = model, rate, lanes, steps, 0, 0
        self.moments = [(np.zeros_like(p), np.zeros_like(p)) for p in model.params()]
        # Natural log-likelihood of what was read, by weight of the network in the mixture.
        self.vocabulary, self.mixtures = vocabulary, np.zeros(len(WEIGHTS))

    def state(self) -> np.ndarray:
        """Parameters, moments and number of updates as one vector."""
        parts = [self.model.flat(), *[np.concatenate([m[k].ravel() for m in self.moments]) for k in (0, 1)], [self.updates]]
        return np.concatenate(parts).astype(np.float32)

    def resume(self, state: np.ndarray) -> None:
        n = (len(state) - 1) // 3
        self.model.load(state[:n])
        self.updates, at = round(float(state[-1])), n
        for k in (0, 1):
            for p, m in zip(self.model.params(), self.moments, strict=True):
                m[k][...] = state[at : at + p.size].reshape(p.shape)
                at += p.size

    def learn(self, documents: list[np.ndarray]) -> None:
        if not documents:
            return
        ids = np.concatenate(documents)
        keep = np.ones(len(ids), np.float32)
        keep[np.cumsum([0, *map(len, documents[:-1])])] = 0
        lanes = max(1, min(self.lanes, len(ids) // self.window))
        steps = len(ids) // lanes
        # What doesn't divide evenly makes one more, shorter window of single steps.
        cut = lanes * steps
        grid, marks = ids[:cut].reshape(lanes, steps).T, keep[:cut].reshape(lanes, steps).T
        self._windows(grid, marks)
        if cut < len(ids):
            self._windows(ids[cut:, None], keep[cut:, None])
        self.n_tokens += len(ids)

    def _windows(self, tokens: np.ndarray, keep: np.ndarray) -> None:
        h = np.zeros((tokens.shape[1], self.model.size.hidden), np.float32)
        for at in range(0, len(tokens), self.window):
            part = tokens[at : at + self.window]
            h, grads, had = self.model.gradients(h, part, keep[at : at + self.window])
            if self.vocabulary is not None:
                net, other = had * self.vocabulary.scale[part.ravel()], self.vocabulary.unigram[part.ravel()]
                more = net - other
                self.mixtures += [_log_sum(other + w * more) for w in WEIGHTS]
            self.updates += 1
            norm = math.sqrt(sum(float(np.vdot(g, g)) for g in grads))
            clip = min(1.0, 1.0 / (norm + 1e-9))
            fast, slow = 1 - 0.9**self.updates, 1 - 0.99**self.updates
            for p, g, (m, v) in zip(self.model.params(), grads, self.moments, strict=True):
                g *= clip
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                p -= (self.rate / fast) * m / (np.sqrt(v / slow) + 1e-6)


def _log_sum(x: np.ndarray) -> float:
    """Sum of the natural logs of probabilities, of four at a time: their product is far from a double's least."""
    cut = len(x) // 4 * 4
    four = x[:cut].reshape(4, -1)
    return float(np.log(four[0] * four[1] * four[2] * four[3]).sum() + np.log(x[cut:]).sum())


def encode_all(column: list[bytes], vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
    """Model ids of the texts' tokens one after another, their places in the table (-1: beyond it),
    how many each text has, and the words beyond the table in their order."""
    words, n_words = split_words(column)
    found = pc.index_in(words, value_set=vocabulary.words)
    beyond = words.filter(found.is_null()).to_pylist() if found.null_count else []
    n = n_words + 1
    at = np.full(int(n.sum()), vocabulary.end, np.int32)
    own = np.ones(len(at), bool)
    own[np.cumsum(n) - 1] = False
    at[own] = found.fill_null(-1).to_numpy()
    ids = vocabulary.ids[at]
    if beyond:
        ids[at < 0] = [vocabulary.size.head + tail_class(w, vocabulary.size.tails) for w in beyond]
    return ids, at, n, beyond


def encode(text: bytes, vocabulary: Vocabulary) -> np.ndarray:
    """Model ids of a text's tokens."""
    return encode_all([text], vocabulary)[0]


_COPY = "p binary, n long, mixtures array<double>"


def _mean(copies: pa.Table) -> pa.Table:
    """One copy for a group of them: the mean by tokens, the sums of the rest."""
    n = copies.column("n").to_pylist()
    total = np.zeros(len(copies.column("p")[0].as_py()) // 4)
    for p, k in zip(copies.column("p"), n, strict=True):
        total += np.frombuffer(p.as_py(), np.float32) * (k / sum(n))
    mixtures = np.sum(copies.column("mixtures").to_pylist(), axis=0)
    return pa.table({"p": pa.array([total.astype(np.float32).tobytes()], pa.binary()), "n": [sum(n)], "mixtures": pa.array([mixtures], pa.list_(pa.float64()))})


def average_round(training: DataFrame, model: GruModel, state: np.ndarray | None, vocabulary, scratch: Scratch) -> tuple[np.ndarray, np.ndarray] | None:
    """Token-weighted mean of what the tasks learn, starting from ``model`` and the optimizer's
    ``state``, and the log-likelihoods of the mixtures."""
    spark = training.sparkSession
    start = spark.sparkContext.broadcast((model, state))

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, state = start.value
        own = GruModel.__new__(GruModel)
        own.size = first.size
        for name, p in zip(GruModel.NAMES, first.params(), strict=True):
            setattr(own, name, p.copy())
        trainer = Trainer(own, vocabulary=vocabulary.value)
        if state is not None:
            trainer.resume(state)
        for b in batches:
            column = texts(b.column(0))
            for lo, hi in slices(column, 24 << 20):
                ids, _, n, _ = encode_all(column[lo:hi], vocabulary.value)
                documents = np.split(ids, np.cumsum(n)[:-1])
                for first, last in slices(column[lo:hi], 2 << 20):
                    trainer.learn(documents[first:last])
        if trainer.n_tokens:
            cols = [pa.array([trainer.state().tobytes()], pa.binary()), pa.array([trainer.n_tokens], pa.int64()), pa.array([trainer.mixtures], pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(cols, names=["p", "n", "mixtures"])

    copies = scratch.keep(training.select("text").mapInArrow(learn, _COPY))
    left = copies.count()
    while left > 1:
        group = F.pmod(F.xxhash64("p"), F.lit(-(-left // _GROUP)))
        copies = scratch.keep(copies.groupBy(group.alias("g")).applyInArrow(_mean, _COPY))
        left = copies.count()
    row = copies.first()
    return row and (np.frombuffer(bytes(row["p"]), np.float32), np.array(row["mixtures"]))


# ---------------------------------------------------------------- scoring


@np.errstate(over="ignore")
def score_batch(column: list[bytes], model: GruModel, vocabulary: Vocabulary, n_lanes: int = 512, window: int = 32) -> list[tuple]:
    """Per text: tokens, table tokens, their sum of log10(c + 1), log10 of the model's probability less
    the log10(c + 1) of words beyond the table, and these words, counted."""
    ids, at, n, beyond = encode_all(column, vocabulary)
    inside, starts = at >= 0, np.cumsum(n) - n
    logs = np.where(inside, vocabulary.log_c1[at], 0.0)
    base, table_tokens = np.add.reduceat(logs, starts), np.add.reduceat(inside, starts, dtype=np.int64)
    # The members of tail classes have their count share; beyond the table the join adds log10(c + 1).
    score = np.add.reduceat(np.where(ids >= vocabulary.size.head, logs, 0.0), starts)
    rest: list[Counter] = [Counter() for _ in column]
    for i, word in zip(np.repeat(np.arange(len(column)), n)[~inside].tolist(), beyond, strict=True):
        rest[i][word] += 1
    lanes, inputs = Lanes(np.split(ids, starts[1:]), n_lanes), model.inputs()
    hidden, most = model.size.hidden, int(lanes.bounds[1])
    h, a = np.zeros((most, hidden), np.float32), np.empty((most, 3 * hidden), np.float32)
    room, states = model.room_of_step(most), np.empty((most * window, hidden), np.float32)
    for first in range(0, len(lanes.bounds) - 1, window):
        bounds = lanes.bounds[first : first + window + 1].tolist()
        for lo, hi in zip(bounds, bounds[1:]):
            k, seen = hi - lo, states[lo - bounds[0] : hi - bounds[0]]
            np.multiply(h[:k], lanes.keep[lo:hi, None], out=seen)
            inputs.take(lanes.tokens[lo:hi], axis=0, out=a[:k], mode="clip")
            h, _ = model.step(seen, a[:k], room if k == most else None)
        ids = lanes.tokens[bounds[0] : bounds[-1]]
        net, other = model.probs(states[: len(ids)], ids) * vocabulary.scale[ids], vocabulary.unigram[ids]
        score += np.bincount(lanes.doc[bounds[0] : bounds[-1]], np.log10(other + vocabulary.weight * (net - other)), len(column))
    return list(zip(n.tolist(), table_tokens.tolist(), base.tolist(), score.tolist(), (list(r.items()) for r in rest), strict=True))


def fit(training: DataFrame, scratch: Scratch, counts: DataFrame, rounds: int, share: float, max_table: int, size: Size):
    """(vocabulary, model, cut): words with a count of at least ``cut`` are in the vocabulary's table."""
    spark = training.sparkSession
    log_bin = F.floor(F.log2("c") * 8).cast("int")
    bins = counts.groupBy(log_bin.alias("b")).agg(F.count(F.lit(1)).alias("n"), F.min("c").alias("c")).collect()  # under 512 rows
    cut, kept = 1 << 62, 0
    for r in sorted(bins, key=lambda r: -r["b"]):
        kept += r["n"]
        if kept > max_table:
            break
        cut = r["c"]
    words = counts.where((F.col("c") >= cut) | (F.col("word") == F.lit(END))).select("word", "c").toPandas()
    tails = counts.groupBy("tail").agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("n")).collect()
    n_types = sum(r["n"] for r in tails)
    vocabulary = Vocabulary(
        [bytes(w) for w in words["word"]], words["c"].tolist(), {r["tail"]: (r["c"], r["n"]) for r in tails}, sum(r["c"] for r in tails), n_types, size
    )
    shared, model = spark.sparkContext.broadcast(vocabulary), GruModel(vocabulary)
    parts = max(rounds, round(rounds / share))
    part = F.pmod(F.xxhash64("id", "text"), F.lit(parts))
    state = None
    for k in range(rounds):
        learned = average_round(training.where(part == k), model, state, shared, scratch)
        if learned:
            state, mixtures = learned
            model.load(state[: len(model.flat())])
            vocabulary.weight = float(WEIGHTS[int(np.argmax(mixtures))])
    return vocabulary, model, cut


def score_documents(
    docs: DataFrame,
    folds: int = 7,
    held_out: int = 2,
    rounds: int = 3,
    share: float = 1.0,
    max_table: int = 200_000,
    size: Size = NETWORK,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """A row per document row: id_col, held_out, n_tokens, n_known, train_tokens, base_score and score (log10)."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "language-model")
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    out_of_fold = F.coalesce(fold("id", folds) == held_out, F.lit(False))
    training = rows.where(~out_of_fold)
    counts = scratch.keep(token_counts(training, size.tails))
    vocabulary, model, cut = fit(training, scratch, counts, rounds, share, max_table, size)
    n_tokens, n_types = vocabulary.n_tokens, vocabulary.n_types
    if not n_tokens:
        zero, none = F.lit(0.0), F.lit(0).cast("long")
        words = F.filter(F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")
        n = (F.size(words) + 1).cast("long").alias("n_tokens")
        return rows.select(F.col("id").alias(id_col), out_of_fold.alias("held_out"), n, none.alias("n_known"), none.alias("train_tokens"), zero.alias("base_score"), zero.alias("score"))
    shared = spark.sparkContext.broadcast((vocabulary, model))
    id_type = docs.schema[id_col].dataType.simpleString()
    schema = f"row long, id {id_type}, n_tokens long, n_table long, base double, model double, rest array<struct<word:binary,n:long>>"
    rest_type = pa.list_(pa.struct([("word", pa.binary()), ("n", pa.int64())]))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, model = shared.value
        at = TaskContext.get().partitionId() << 33
        for b in batches:
            column = texts(b.column(1))
            for lo, hi in slices(column, 24 << 20):
                n, n_table, base, total, rest = zip(*score_batch(column[lo:hi], model, vocabulary), strict=True)
                rest = pa.array(rest, rest_type)
                numbers = [pa.array(c, t) for c, t in ((n, pa.int64()), (n_table, pa.int64()), (base, pa.float64()), (total, pa.float64()))]
                cols = [pa.array(range(at, at + hi - lo), pa.int64()), b.column(0)[lo:hi], *numbers, rest]
                at += hi - lo
                yield pa.RecordBatch.from_arrays(cols, names=["row", "id", "n_tokens", "n_table", "base", "model", "rest"])

    scored = scratch.keep(rows.mapInArrow(score, schema))
    rare = scored.select("row", F.inline("rest")).join(counts.where(F.col("c") < cut).select("word", "c"), "word")
    rare = rare.groupBy("row").agg(F.sum("n").alias("known"), F.sum(F.col("n") * F.log10(F.col("c") + 1)).alias("log_c1"))
    log_c1, known = F.coalesce("log_c1", F.lit(0.0)), F.coalesce("known", F.lit(0))
    return scored.drop("rest").join(rare, "row", "left").select(
        F.col("id").alias(id_col),
        out_of_fold.alias("held_out"),
        "n_tokens",
        (F.col("n_table") + known).alias("n_known"),
        F.lit(n_tokens).cast("long").alias("train_tokens"),
        (F.col("base") + log_c1 - F.col("n_tokens") * math.log10(n_tokens + n_types + 1)).alias("base_score"),
        (F.col("model") + log_c1).alias("score"),
    )


def op1_language_model(spark, sf_dir: str) -> DataFrame:
    """Log-likelihood of every document."""
    return score_documents(table(spark, sf_dir, "documents"))
