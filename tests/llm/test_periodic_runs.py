import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from playmart.llm import periodic_runs as R
from playmart.llm.common import table

from .helpers import SF, doc, edge_rows, frame, plain, words


def brute_runs(w, min_length):
    """By definition: every lag's maximal stretches; of equal stretches the smallest period."""
    n, best = len(w), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            if j - i >= q and j - i + q >= min_length:
                best.setdefault((i, j - i + q), q)
            i = j
    return sorted((s, length, q) for (s, length), q in best.items())


def fast_brute_runs(w, min_length):
    codes = {}
    seq = np.array([codes.setdefault(x, len(codes)) for x in w])
    best = {}
    for q in range(1, len(w) // 2 + 1):
        equal = np.concatenate([[0], seq[q:] == seq[:-q], [0]]).astype(np.int8)
        step = np.diff(equal)
        for a, b in zip(np.flatnonzero(step == 1).tolist(), np.flatnonzero(step == -1).tolist()):
            if b - a >= q and b - a + q >= min_length:
                best.setdefault((a, b - a + q), q)
    return sorted((s, length, q) for (s, length), q in best.items())


def some_sequences(seed):
    rnd = random.Random(seed)
    out = []
    for _ in range(40):  # few different words: runs inside runs on every scale
        out.append([rnd.randrange(rnd.choice([1, 2, 3])) for _ in range(rnd.randrange(200))])
    for _ in range(40):  # planted repetitions, next to and inside each other
        w = []
        while len(w) < 300:
            block = [rnd.randrange(rnd.choice([2, 5, 1000])) for _ in range(rnd.choice([1, 2, 7, 15, 16, 17, 31, 32, 33, 60, 90]))]
            block = block * rnd.choice([1, 2, 3])
            w += (block * rnd.choice([1, 2, 3, 5]))[: rnd.randrange(1, 400)]
            w += [rnd.randrange(1000) for _ in range(rnd.choice([0, 0, 1, 5]))]
        out.append(w)
    a, b = [0] * 50, [1] * 50
    out += [a + b + a + b, (a + [2]) * 4, ([0, 1, 2] * 33 + [0]) * 2, [0, 1, 2] * 90, ([0] * 99 + [1]) * 2, [5] + ([0] * 99 + [1]) * 2 + [5]]
    fib = ["0", "01"]
    while len(fib[-1]) < 900:
        fib.append(fib[-1] + fib[-2])
    tm = [bin(i).count("1") % 2 for i in range(2048)]
    out += [list(map(int, fib[-1])), tm, tm[:700] * 2 + tm[:300], [0, 1, 2] * 33 + [0] + [0, 1, 2] * 40 + [0, 1]]
    return out


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("min_length", [2, 12, 40])
def test_runs_equal_brute_force(seed, min_length):
    seqs = some_sequences(seed)
    flat = np.array([x for w in seqs for x in w], np.int32)
    rows, at = R.find_runs(flat, np.array([len(w) for w in seqs]), min_length)
    for i, w in enumerate(seqs):
        assert [tuple(r) for r in rows[at[i] : at[i + 1]].tolist()] == fast_brute_runs(w, min_length), (seed, i)


def test_the_two_plain_forms_agree():
    for w in some_sequences(9)[:50]:
        assert brute_runs(w, 12) == fast_brute_runs(w, 12)


def test_seeds_of_repetitive_texts_stay_few():
    for w in ([0] * 20_000, [0, 1] * 10_000, ([0] * 500 + [1] * 500) * 20, ([0] * 99 + [1]) * 200):
        seq = np.array([*w, -1], np.int32)
        match = R.Matcher(seq)
        for scale in (16, 64, 512, 4096):
            assert len(R.seeds(match, scale)[0]) <= 16 * len(w)


def contract_row(i, text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(w)
    if i is not None and n and (h := zlib.crc32(str(i).encode())) % 10 == 0:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[k] if k < a else w[a + (k - a) % p] for k in range(n)]
    runs = fast_brute_runs(w, 12)
    drop = {k for s, length, q in runs for k in range(s + q, s + length)}
    kept = " ".join(x for k, x in enumerate(w) if k not in drop)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
    digest = hashlib.sha256("".join(f"{s},{length},{q}\n" for s, length, q in sorted(runs, key=lambda r: (r[0], r[2]))).encode()).hexdigest()
    return (i, len(runs), *best, best[1] and 1000 * best[1] // best[2], digest, hashlib.sha256(kept.encode()).hexdigest())


def in_order(rows):
    return sorted(rows, key=lambda t: [(v is None, str(v)) for v in t])


def test_query_by_definition(spark):
    rows = [tuple(r) for r in table(spark, SF, "documents").select("doc_id", "text").collect()]
    got = plain(R.op11_periodic_runs(spark, SF))
    assert got == in_order(contract_row(*r) for r in rows)
    assert sum(r[1] > 0 for r in got) > 15


def test_edges(spark):
    line = " ".join(words(40, 3))
    odd = ["a " * 11, "a " * 12, "Ab aB " * 6, "x y z " * 400, f"{line} " * 50, f"start {line}\n{line}\t{line} end", "é 東京 " * 7, "w " * 5000, " ".join(words(9000, 4)[:3000] * 3)]
    rows = edge_rows() + [doc(50 + k, t) for k, t in enumerate(odd)]
    docs = frame(spark, rows, clash=True).repartition(2)
    found = R.periodic_runs(docs, "result")
    assert found.columns == [*docs.columns, "result"]
    got = [(r.doc_id, r.text, r.result.n_words, [tuple(x) for x in r.result.runs], r.result.collapsed) for r in found.collect()]
    want = []
    for i, text, *_ in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        runs = sorted(fast_brute_runs(w, 12), key=lambda r: (r[0], r[2]))
        drop = {k for s, length, q in runs for k in range(s + q, s + length)}
        want.append((i, text, len(w), runs, " ".join(x for k, x in enumerate(w) if k not in drop)))
    assert in_order(got) == in_order(want)
    assert R.periodic_runs(frame(spark, [])).count() == 0
