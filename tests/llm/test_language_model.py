import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from playmart.llm import language_model as L
from playmart.llm.common import Scratch, table

from .helpers import SF, doc, edge_rows, frame, space_words


def tokens(text):
    return [w.encode() for w in space_words(text)] + [L.END]


def base(rows):
    """The contract's base, by definition."""
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    counts = Counter(t for i, text in rows if not held(i) for t in tokens(text))
    n, v = sum(counts.values()), len(counts)
    out = []
    for i, text in rows:
        ts = tokens(text)
        score = sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in ts)
        out.append((i, held(i), len(ts), sum(t in counts for t in ts), n, score))
    return sorted(out, key=lambda t: [(x is None, str(x)) for x in t[:4]])


def test_query_has_the_base_and_beats_it(spark):
    rows = [tuple(r) for r in table(spark, SF, "documents").select("doc_id", "text").collect()]
    got = sorted((tuple(r) for r in L.op1_language_model(spark, SF).collect()), key=lambda t: [(x is None, str(x)) for x in t[:4]])
    want = base(rows)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert all(abs(g[5] - w[5]) < 1e-6 * max(1, abs(w[5])) for g, w in zip(got, want))
    assert sum(g[6] for g in got if g[1]) > sum(g[5] for g in got if g[1])


def test_edges_and_words_beyond_the_table(spark):
    rows = [*edge_rows(), *[doc(200 + k, f"alpha beta word{k} word{k % 7}") for k in range(80)]]
    got = L.score_documents(frame(spark, rows, clash=True), max_table=20, share=1.0).collect()
    want = base([r[:2] for r in rows])
    got = sorted((tuple(r) for r in got), key=lambda t: [(x is None, str(x)) for x in t[:4]])
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert all(abs(g[5] - w[5]) < 1e-6 * max(1, abs(w[5])) for g, w in zip(got, want))
    assert all(np.isfinite(g[6]) and g[6] < 0 for g in got)


def test_no_training_document_and_empty_table(spark):
    held = [i for i in range(60) if zlib.crc32(str(i).encode()) % 7 == 2][:2]
    got = L.score_documents(frame(spark, [doc(held[0], "A b"), doc(held[1], None)])).collect()
    assert sorted(tuple(r) for r in got) == sorted([(held[0], True, 3, 0, 0, 0.0, 0.0), (held[1], True, 1, 0, 0, 0.0, 0.0)])
    assert L.score_documents(frame(spark, [])).count() == 0


def small_model(texts):
    counts = Counter(t for x in texts for t in tokens(x))
    tails = {}
    for w, c in counts.items():
        t = tails.setdefault(L.tail_class(w), [0, 0])
        t[0], t[1] = t[0] + c, t[1] + 1
    v = L.Vocabulary(list(counts), list(counts.values()), {k: tuple(x) for k, x in tails.items()}, sum(counts.values()), len(counts))
    return v, L.GruModel(v), counts


@pytest.mark.parametrize("weight", [1.0, 0.25])
def test_scores_are_step_by_step_log_probabilities_and_sum_to_one(weight):
    """Against plain loops; every state's distribution over words and unknown words adds up to 1, and so does the unigram share."""
    texts = [" ".join(f"w{(k * j) % (1500 + k)}" for j in range(40 + 9 * k)) for k in range(30)] + ["", "w1"]
    v, m, counts = small_model(texts)
    L.Trainer(m, lanes=4).learn([L.encode(t.encode(), v) for t in texts])
    members = [w for w, k in v.index.items() if v.ids[k] < L.HEAD]
    tail_words = [w for w, k in v.index.items() if v.ids[k] >= L.HEAD]
    assert tail_words
    v.weight, mass = weight, sum(counts.values()) + len(counts) + L.TAILS
    assert abs(sum(counts[w] + 1 for w in counts) + L.TAILS - mass) < 1e-9
    got = L.score_batch([t.encode() for t in texts], m, v, n_lanes=5, window=7)
    sig = lambda x: 1 / (1 + np.exp(-x))
    h_n = L.HIDDEN
    for text, (n, n_table, _, score, rest) in zip(texts, got):
        ts, h, total = tokens(text), np.zeros(h_n), 0.0
        assert (n, n_table, rest) == (len(ts), len(ts), [])
        for step, t in enumerate(ts):
            z = h @ m.classes + m.class_bias
            cls = np.exp(z - z.max())
            cls /= cls.sum()

            def prob(w):
                k = v.ids[v.index[w]]
                if k >= L.HEAD:
                    return cls[k - L.HEAD + L.CLASSES] * (counts[w] + 1) / 10 ** v.log_tail[k - L.HEAD]
                c, y = k // L.MEMBERS, h @ m.members[k // L.MEMBERS] + m.member_bias[k // L.MEMBERS]
                e = np.exp(y - y.max())
                return cls[c] * e[k % L.MEMBERS] / e.sum()

            if step in (0, 5):
                known = sum(prob(w) for w in members + tail_words)
                unknown = sum(cls[L.CLASSES + c] / 10 ** v.log_tail[c] for c in range(L.TAILS))
                spare = 0.0  # places of a head class that no word has
                for c in range(L.CLASSES):
                    y = h @ m.members[c] + m.member_bias[c]
                    e = np.exp(y - y.max())
                    spare += cls[c] * e[[j for j in range(L.MEMBERS) if c * L.MEMBERS + j >= len(members)]].sum() / e.sum()
                assert abs(known + unknown + spare - 1) < 1e-5
            total += math.log10(weight * prob(t) + (1 - weight) * (counts[t] + 1) / mass)
            a, u = m.gates[v.ids[v.index[t]]] + m.gate_bias, h @ m.recurrent
            zg, r = sig(a[:h_n] + u[:h_n]), sig(a[h_n : 2 * h_n] + u[h_n : 2 * h_n])
            cand = np.tanh(a[2 * h_n :] + r * u[2 * h_n :])
            h = cand + zg * (h - cand)
        assert abs(score - total) < 1e-3 * max(1, abs(total))


def test_gradient_equals_finite_differences():
    texts = ["a b c a b d e", "b b a c", "e d c b a a a b"]
    v, m, _ = small_model(texts)
    for n in m.NAMES:
        setattr(m, n, getattr(m, n).astype(np.float64))
    m.gates = m.gates * 3
    ids = np.concatenate([L.encode(t.encode(), v) for t in texts])
    keep = np.ones(len(ids))
    keep[[0, 8, 13]] = 0
    steps = len(ids) // 2
    grid, marks = ids[: 2 * steps].reshape(2, steps).T, keep[: 2 * steps].reshape(2, steps).T

    def loss():
        h, out, x = np.zeros((2, L.HIDDEN)), 0.0, m.inputs()
        for t in range(steps):
            h = h * marks[t][:, None]
            out -= m.log_probs(h, grid[t]).sum() * math.log(10)
            h, _ = m.step(h, x[grid[t]])
        return out / grid.size

    _, grads, had = m.gradients(np.zeros((2, L.HIDDEN)), grid, marks)
    assert abs(-np.log(had).mean() - loss()) < 1e-6  # what a window had before it is learned from
    rng = np.random.default_rng(0)
    for name, g in zip(m.NAMES, grads):
        p = getattr(m, name)
        at = [tuple(i) for i in np.argwhere(np.abs(g) > 1e-4)]
        for i in [at[k] for k in rng.permutation(len(at))[:6]]:
            kept, eps = p[i], 1e-4
            p[i] = kept + eps
            up = loss()
            p[i] = kept - eps
            down = loss()
            p[i] = kept
            assert abs((up - down) / (2 * eps) - g[i]) < 2e-3 * max(0.01, abs(g[i])), (name, i)


def test_training_lowers_the_loss_and_averages_copies(spark):
    texts = [f"start {'left right ' * (3 + k % 5)}stop w{k % 50}" for k in range(300)]
    v, m, _ = small_model(texts)
    before = sum(r[3] for r in L.score_batch([t.encode() for t in texts], m, v))
    training = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "id long, text string").repartition(4)
    shared = spark.sparkContext.broadcast(v)
    state, found = None, []
    for _ in range(3):
        state, mixtures = L.average_round(training, m, state, shared, Scratch(spark, "t"))
        m.load(state[: len(m.flat())])
        found.append(mixtures.max())
    assert found[0] < found[1] < found[2] and state[-1] > 3  # the optimizer goes on where it stopped
    after = sum(r[3] for r in L.score_batch([t.encode() for t in texts], m, v))
    assert after > before
    trainer, ids = L.Trainer(m, lanes=16), [L.encode(t.encode(), v) for t in texts]
    for _ in range(12):
        trainer.learn(ids)
    assert sum(r[3] for r in L.score_batch([t.encode() for t in texts], m, v)) > 0.5 * before
    assert L.average_round(training.where(F.lit(False)), m, None, shared, Scratch(spark, "t")) is None


def test_mean_of_copies(monkeypatch):
    import pyarrow as pa

    copies = [(np.full(3, k, np.float32), k + 1, [float(k), 1.0]) for k in range(3)]
    table = pa.table({"p": pa.array([p.tobytes() for p, _, _ in copies]), "n": [n for _, n, _ in copies], "mixtures": [m for *_, m in copies]})
    (row,) = L._mean(table).to_pylist()
    assert np.allclose(np.frombuffer(row["p"], np.float32), (0 * 1 + 1 * 2 + 2 * 3) / 6) and (row["n"], row["mixtures"]) == (6, [3.0, 3.0])


def test_training_goes_on_from_a_state():
    """Two halves with the state between them are one training."""
    texts = [f"left right w{k % 20} stop" for k in range(60)]
    v, one, _ = small_model(texts)
    ids = [L.encode(t.encode(), v) for t in texts]
    whole = L.Trainer(one, lanes=4)
    whole.learn(ids[:30])
    state = whole.state()
    whole.learn(ids[30:])
    _, two, _ = small_model(texts)
    half = L.Trainer(two, lanes=4)
    half.resume(state)
    half.learn(ids[30:])
    assert half.updates == whole.updates and np.allclose(one.flat(), two.flat(), atol=1e-5)


def test_documents_are_scored_by_the_whole_network(spark, monkeypatch):
    """2048 head words in 32 classes, 32 tail classes and 32 hidden units; a word of rank 2000 has its own output."""
    made, fit = [], L.fit
    monkeypatch.setattr(L, "fit", lambda *a: made.append(fit(*a)) or made[-1])
    rows = [doc(k, " ".join(f"w{j}" for j in range(k, 2600, 40) for _ in range(1 + (j < 2100)))) for k in range(40)]
    rows += [doc(100 + k, " ".join(f"w{j}" for j in range(2100))) for k in range(7)]
    got = L.score_documents(frame(spark, rows)).collect()
    vocabulary, model, _ = made[0]
    assert len(got) == len(rows) and all(np.isfinite(r.score) and r.score < 0 for r in got)
    assert model.gates.shape == (2048 + 32, 96) and model.recurrent.shape == (32, 96)
    assert model.classes.shape == (32, 64) and model.members.shape == (32, 32, 64)
    assert sorted(vocabulary.ids[vocabulary.ids < 2048].tolist()) == list(range(2048))
    beyond = vocabulary.ids[vocabulary.ids >= 2048]
    assert len(beyond) and beyond.max() < 2048 + 32 and len(set(beyond.tolist())) > 16


def test_every_training_document_trains_the_network_once(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(L, "average_round", lambda training, *_: seen.extend(r.id for r in training.select("id").collect()))
    L.score_documents(frame(spark, [doc(k, f"a text {k}") for k in range(200)])).count()
    assert sorted(seen) == [k for k in range(200) if zlib.crc32(str(k).encode()) % 7 != 2]


ODD = ["", " ", "\t\n\x0b\x0c\r ", " Ab aB\tÄb ", "a\x1cb\x85c\u00a0d\u2003e", "x" * 300 + " y", "one", " two  three\n", "É é İ", "one one"]


def test_words_of_a_slice_are_split_counted_and_looked_up_at_once(spark):
    v, _, counts = small_model([" ".join(f"w{k}" for k in range(1200) for _ in range(2)), "one a y"])
    column = [t.encode() for t in ODD]
    words, n = L.split_words(column)
    assert words.to_pylist() == [w for t in ODD for w in tokens(t)[:-1]] and n.tolist() == [len(tokens(t)) - 1 for t in ODD]
    ids, at, n, beyond = L.encode_all(column, v)
    want = [[v.ids[v.index[w]] if w in counts else L.HEAD + L.tail_class(w) for w in tokens(t)] for t in ODD]
    assert ids.tolist() == sum(want, []) and n.tolist() == [len(w) for w in want]
    assert at.tolist() == [v.index.get(w, -1) for t in ODD for w in tokens(t)]
    assert beyond == [w for t in ODD for w in tokens(t) if w not in counts]
    found = L.token_counts(spark.createDataFrame([(t,) for t in [*ODD, None]], "text string").repartition(3), 32).collect()
    want = Counter(w for t in [*ODD, ""] for w in tokens(t))
    assert sorted((bytes(r.word), r.tail, r.c) for r in found) == sorted((w, L.tail_class(w, 32), c) for w, c in want.items())


@pytest.mark.parametrize("top", [1, 3, 40, 5000])
def test_sums_of_runs_of_equal_tokens(top):
    rng = np.random.default_rng(top)
    keys = np.sort(np.minimum(rng.zipf(1.3, 700), top))
    rows = rng.normal(size=(700, 6))
    found, sums = L._run_sums(rows, keys)
    assert sorted(found.tolist()) == sorted(set(keys.tolist()))
    for k, got in zip(found, sums):
        assert np.allclose(got, rows[keys == k].sum(axis=0))


def test_logits_far_below_their_bound():
    """Where every numerator underflows the row's maximum is taken off."""
    h, w, b = np.float32([[-1, -1], [1, 1]]), np.full((2, 3), 60, np.float32), np.float32([0, 1, 2])
    exact = np.exp([0.0, 1.0, 2.0]) / np.exp([0.0, 1.0, 2.0]).sum()
    bias = L._shifted(w, b)
    log, total = L._softmax_at(h, w, bias, np.array([1, 2]), np.empty((2, 3), np.float32))
    assert np.allclose(np.exp(log) / total, exact[[1, 2]], rtol=1e-3)
    had, p = L._softmax_errors(lambda z: np.add(np.matmul(h, w, out=z), bias, out=z), np.array([1, 2]), 0.5, np.empty((2, 3), np.float32))
    assert np.allclose(had, exact[[1, 2]], rtol=1e-3) and np.allclose(p, 0.5 * (exact - np.eye(3)[[1, 2]]), atol=1e-4)
