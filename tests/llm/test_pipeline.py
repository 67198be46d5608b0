import random

import corpus_pipeline as C
import __spark_entry__ as E
from playmart.llm import secrets

from .helpers import doc, edge_rows, frame, plain, words
from .test_decontaminate import brute as brute_hits
from .test_packing import check
from .test_secrets import base
from .test_simhash import classes, fingerprint


def write(spark, path, rows, labels, bench, clash=False):
    frame(spark, rows, clash).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")


def corpus():
    rnd, rows, labels = random.Random(4), [], []
    for k in range(300):
        w = words(rnd.randint(20, 120), k + 50, 5000)
        if k % 6 == 0:
            for _ in range(3):
                w.insert(rnd.randrange(len(w)), rnd.choice(["idiot", "moron", "scum"]))
        rows.append(doc(1000 + k, " ".join(w)))
        labels.append((1000 + k, 1, int(k % 6 == 0)))
    passage = " ".join(words(30, 7, 5000))
    rows += [doc(2000 + k, rows[k + 1][1]) for k in range(20)]  # exact copies
    rows += [doc(3000 + k, f"{' '.join(words(60, k + 900, 5000))} {passage} {' '.join(words(20, k + 950, 5000))}") for k in range(5)]
    rows += [doc(4000 + k, f"{' '.join(words(60, k + 800, 5000))} password=abc{k}defgh ok") for k in range(5)]
    return [*edge_rows(), *rows], labels, [(1, passage), (2, "tiny item")]


def test_stages_one_by_one_and_run(spark, tmpdir_path):
    rows, labels, bench = corpus()
    write(spark, tmpdir_path, rows, labels, bench, clash=True)
    docs = spark.read.parquet(f"{tmpdir_path}/documents.parquet")
    columns, seen = docs.columns, {}
    for k, (name, stage) in enumerate(C.STAGES):
        before, docs = docs, stage(spark, docs, tmpdir_path)
        docs.write.parquet(f"{tmpdir_path}/stage-{k}")
        docs = spark.read.parquet(f"{tmpdir_path}/stage-{k}")
        seen[name] = (before, docs)
        if k < 4:
            assert docs.columns == columns
    # Toxicity: clean documents stay, toxic ones go.
    before, after = seen["toxicity"]
    left = {r.doc_id for r in after.select("doc_id").collect()}
    toxic = {i for i, _, y in labels if y}
    assert len(toxic & left) <= 3 and {i for i, _, y in labels if not y} - left == set()
    # SimHash: one row of each class, the one with the smallest id.
    before, after = seen["simhash_near_dedup"]
    items = [tuple(r) for r in before.select("doc_id", "text").collect()]
    of, low = classes([fingerprint(t) for _, t in items], lambda a, b: (a ^ b).bit_count() <= 2), {}
    for (i, _), c in zip(items, of):
        low.setdefault(c, []).append(i)
    want = sorted((min((x for x in i if x is not None), default=None) for i in low.values()), key=str)
    assert sorted((r.doc_id for r in after.select("doc_id").collect()), key=str) == want
    # Decontamination: exactly the documents without a hit.
    before, after = seen["benchmark_decontamination"]
    hits = brute_hits([tuple(r) for r in before.select("doc_id", "text").collect()], bench)
    assert sorted((i for i, *_, bad in hits if not bad), key=str) == sorted((r.doc_id for r in after.select("doc_id").collect()), key=str)
    # Secrets: every base span is gone, other texts are unchanged.
    before, after = seen["secret_scan"]
    assert before.count() == after.count()
    new = {r.doc_id: r.text for r in after.collect()}
    for i, text in before.select("doc_id", "text").collect():
        assert not base(new[i]) if base(text) else new[i] == text or "[REDACTED]" in new[i]
    # Packing: an exact round trip of what is left.
    before, after = seen["packing"]
    check(after.collect(), [tuple(r) for r in before.select("doc_id", "text").collect()])
    total = lambda df: sorted((str(r.doc_id), r.start, r.length) for r in df.collect())
    assert sum(r[2] for r in total(C.run(spark, tmpdir_path))) == sum(r[2] for r in total(after))


def test_empty_tables(spark, tmpdir_path):
    write(spark, tmpdir_path, [], [], [])
    assert C.run(spark, tmpdir_path).count() == 0


def test_registered():
    names = E.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))
    assert len(C.STAGES) == 5 and secrets.KINDS[:3] == ("assign", "access", "hex") and plain
