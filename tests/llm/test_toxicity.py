import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from playmart.llm import toxicity as T

from .helpers import doc, edge_rows, frame, plain, words

LABELS = "doc_id long, quality int, toxic int"
BAD = ["idiot", "moron", "scum", "lowei", "veju"]


def planted(n=400, seed=0):
    """Documents, a fifth of them with insults (also as stems of unseen words)."""
    rnd, rows, labels = random.Random(seed), [], []
    for k in range(n):
        w, toxic = words(rnd.randint(5, 300), k), k % 5 == 0
        for _ in range(rnd.randint(2, 4) if toxic else 0):
            bad = rnd.choice(BAD)
            w.insert(rnd.randrange(len(w)), bad + "".join(words(1, rnd.randint(0, 9999))) if bad in ("lowei", "veju") else bad)
        rows.append(doc(k, " ".join(w)))
        labels.append((k, 1, int(toxic)))
    return rows, labels


def test_planted_documents_are_found_and_clean_ones_left(spark):
    rows, labels = planted()
    docs = frame(spark, rows, clash=True)
    scored = T.score_toxicity(docs, spark.createDataFrame(labels, LABELS), "result")
    truth = {i: y for i, _, y in labels}
    held = [(truth[r.doc_id], r.result) for r in scored.collect() if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert len({y for y, _ in held}) == 2
    assert sum(s >= 0.5 for y, s in held if y) >= 0.9 * sum(y for y, _ in held)
    assert sum(s >= 0.5 for y, s in held if not y) <= 0.03 * sum(1 - y for y, _ in held)
    kept = T.drop_toxic(docs, spark.createDataFrame(labels, LABELS))
    assert kept.columns == docs.columns and 0.75 * len(rows) < kept.count() < 0.85 * len(rows)


def test_held_out_labels_are_never_learned(spark):
    rows, labels = planted(200)
    held = [i for i, _, _ in labels if zlib.crc32(str(i).encode()) % 5 == 0]
    flipped = [(i, q, 1 - y if i in held else y) for i, q, y in labels]
    docs = frame(spark, rows)
    pick = lambda ls: plain(T.score_toxicity(docs, spark.createDataFrame(ls, LABELS), "r").select("doc_id", "r"))
    assert pick(labels) == pick(flipped)


def test_edges(spark):
    rows, labels = planted(200)
    rows = [*[(None if r[0] is None else 10_000 + r[0], *r[1:]) for r in edge_rows()], *rows]
    labels = [*labels, (None, 1, 1), (3, None, None), (9_999, 0, 1), (4, 0, 0), (4, 0, 0)]
    docs = frame(spark, rows, clash=True)
    got = T.score_toxicity(docs, spark.createDataFrame(labels, LABELS), "result").collect()
    assert len(got) == len(rows) and all(0 <= r.result <= 1 for r in got)
    assert len({r.result for r in got if r.text in (None, "", " \t\n")}) == 1
    assert T.score_toxicity(frame(spark, []), spark.createDataFrame(labels, LABELS)).count() == 0


@pytest.mark.parametrize("toxic, score", [(None, 0.0), (0, 0.0), (1, 1.0)])
def test_one_class_or_no_labels(spark, toxic, score):
    docs = frame(spark, [doc(k, "some words") for k in range(9)])
    labels = spark.createDataFrame([(k, 1, toxic) for k in range(9)], LABELS)
    assert {r.score for r in T.score_toxicity(docs, labels).collect()} == {score}


def test_ratio_equals_the_two_models():
    """The tables hold log P_toxic - log P_ordinary of interpolated Kneser-Ney models that share their backoff."""
    texts = [["ab", "abc", "abd", "ab"], ["ab", "xyz", "abz", "bad", "badly"]]
    counts = []
    for ws in texts:
        g = T.word_grams([w.encode() for w in ws])[0]
        counts.append(np.unique(g, return_counts=True))
    model, d = T.KneserNey([(g, c.astype(float)) for g, c in counts]), 0.75
    every = set(counts[0][0].tolist()) | set(counts[1][0].tolist())

    def shared(context, byte, size):  # context: bytes as a tuple, longest first
        if size == 0:
            return 1 / 256
        tails = {g & ((1 << 8 * (size + 1)) - 1) for g in every}
        kinds = {}
        for t in tails:
            kinds.setdefault((t >> 8) & ((1 << 8 * (size - 1)) - 1), {}).setdefault(t & 255, set()).add(t >> 8 * size)
        own = kinds.get(context & ((1 << 8 * (size - 1)) - 1), {})
        total = sum(map(len, own.values()))
        lower = shared(context, byte, size - 1)
        return lower if not total else max(len(own.get(byte, ())) - d, 0) / total + d * len(own) / total * lower

    def prob(which, gram):
        table = dict(zip(counts[which][0].tolist(), counts[which][1].tolist()))
        of = {g: c for g, c in table.items() if g >> 8 == gram >> 8}
        back = shared(gram >> 8, gram & 255, T.ORDER - 1)
        total, off = sum(of.values()), {g: 1 if c == 1 else 1.25 if c == 2 else 1.5 for g, c in of.items()}
        return back if not total else (of.get(gram, 0) - off.get(gram, 0)) / total + sum(off.values()) / total * back

    for word in ("ab", "abz", "badly", "abq", "new", ""):
        grams = T.word_grams([word.encode()])[0].tolist()
        want = sum(np.log(prob(1, g)) - np.log(prob(0, g)) for g in grams)
        assert abs(model.words([word.encode()])[0] - want) < 1e-9


def test_copies_and_repeats_are_no_further_evidence():
    once = T._counts([b"one two three two"])
    assert all(np.array_equal(a, b) for a, b in zip(once, T._counts([b"one two three two"] * 9)))
    grams = dict(zip(*T._counts([b"a bad b bad a bad"])))
    end = T.word_grams([b"bad"])[0].tolist()[-1]
    assert grams[end] == 2  # after "a" and after "b"


def test_windows_cover_the_whole_text():
    model = T.fit([(" ".join(words(40, k) + (["idiot"] if k % 2 else [])).encode(), k % 2) for k in range(120)])
    long = words(5000, 1)
    clean = model.features([" ".join(long).encode()])[0]
    late = model.features([" ".join([*long, "idiot"]).encode()])[0]
    assert late[0] > clean[0] and late[2] > clean[2] + 0.1  # in the last window, and among the top words


def test_late_dense_passage_and_repeated_line_count_in_full():
    model = T.fit([(" ".join(words(40, k) + (random.Random(k).sample(BAD, 5) if k % 2 else [])).encode(), k % 2) for k in range(240)])
    passage = [*BAD, *words(1, 3), "idiot", "moron"]
    clean = words(20_000, 1)
    spread = list(clean)
    for k, bad in enumerate(BAD):  # each word occurs early, alone among clean ones
        spread.insert(500 * (k + 1), bad)
    score = lambda ws: model.features([" ".join(ws).encode()])[0]
    late, alone = score([*spread, *passage]), score([*words(8, 5), *passage])
    assert late[0] > score(spread)[0] + 0.1 and late[0] >= 0.95 * score(passage)[0]
    assert alone[0] > score(clean)[0]
    line = [*words(6, 4), "idiot", "scum"]
    assert np.allclose(score(line * 1000)[1], score(line)[1]) and score(line)[1] > 0
    best = max(score(line[k:] + line[:k])[0] for k in range(8))
    assert score(line * 1000)[0] <= best + 1e-9 and score(line * 1000)[0] >= score(line)[0] - 1e-9
    # Texts side by side don't touch one another.
    both = model.features([b"", " ".join(passage).encode(), b"", " ".join(line).encode()])
    assert np.allclose(both[[1, 3]], [score(passage), score(line)]) and not both[[0, 2]].any()


def test_the_cap_does_not_move_the_threshold(spark):
    """A labelled corpus without clear borders, 12 times over and past the cap, gives the same predictions."""
    rnd, rows, labels = random.Random(4), [], []
    for k in range(500):
        toxic = k % 8 == 0
        said = rnd.random() < (0.7 if toxic else 0.1)  # the same words in both classes
        rows.append(doc(k, " ".join(words(rnd.randint(8, 40), k) + ([rnd.choice(BAD)] if said else []))))
        labels.append((k, 1, int(toxic)))
    copies = [(j * 1000 + r[0], *r[1:]) for j in range(12) for r in rows]
    marks = [(j * 1000 + i, q, y) for j in range(12) for i, q, y in labels]

    def scores(rows, labels):
        scored = T.score_toxicity(frame(spark, rows), spark.createDataFrame(labels, LABELS), max_rows=500)
        return {r.doc_id: r.score for r in scored.where("doc_id < 500").collect()}

    one, many = scores(rows, labels), scores(copies, marks)
    flips = sum((one[i] >= 0.5) != (many[i] >= 0.5) for i in one)
    assert flips <= 10
    assert abs(np.mean(list(one.values())) - np.mean(list(many.values()))) < 0.05


def test_expressions_made_of_ordinary_syllables(spark):
    """Toxic words are new combinations of syllables that all texts have; held-out documents are still told apart, long ones too."""
    rnd = random.Random(21)
    syllables = ["ach", "lich", "keit", "er", "ver", "zu", "ge", "en", "ung", "heit", "ein", "sch", "be", "au", "un", "st"]
    usual = lambda: "".join(rnd.choices(syllables, k=rnd.choice([1, 2, 2, 3, 4])))
    bad = lambda: "achlich" + "".join(rnd.choices(syllables, k=rnd.choice([1, 1, 2])))
    rows, labels = [], []
    for i in range(900):
        toxic = i % 6 == 0
        w = [usual() for _ in range(rnd.choice([60, 150, 400]))]
        w = [x for x in w if not x.startswith("achlich") or rnd.random() < 0.1]
        for _ in range(max(4, len(w) // 25) if toxic else 0):
            w.insert(rnd.randrange(len(w)), bad())
        rows.append(doc(i, " ".join(w)))
        labels.append((i, int(toxic)))
    labels = spark.createDataFrame(labels, "doc_id long, toxic int")
    held = [i for i in range(900) if zlib.crc32(str(i).encode()) % 5 == 0]
    got = {r.doc_id: r.score >= 0.5 for r in T.score_toxicity(frame(spark, rows), labels).where(F.col("doc_id").isin(held)).collect()}
    bad_ones, fine = [got[i] for i in held if i % 6 == 0], [got[i] for i in held if i % 6]
    assert sum(bad_ones) >= 0.85 * len(bad_ones) and sum(fine) <= 0.02 * len(fine)
