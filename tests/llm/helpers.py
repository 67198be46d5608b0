"""Small tables and plain restatements for the training-data operators."""

import random
import re

SF = "/root/testdata/sf0.001"
DOC_DDL = "doc_id long, text string, lang string, source string, n_chars long"
# Extra columns whose names clash with ones the operators use inside or return.
CLASH = ["id", "fp", "root", "low", "score", "found", "row", "n", "word", "variant", "spans", "__found", "__fp", "key", "rank", "ids"]


def lower_ascii(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def space_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", lower_ascii(text))


def alnum_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower_ascii(text))


def doc(i, text, lang="en", source="s"):
    return (i, text, lang, source, None if text is None else len(text))


def words(n, seed=0, vocab=400):
    rnd = random.Random(seed)
    syllables = ["th", "er", "on", "an", "re", "he", "in", "ed", "nd", "ha", "at", "en"]
    pool = ["".join(random.Random(k).choices(syllables, k=1 + k % 3)) for k in range(vocab)]
    return [rnd.choice(pool) for _ in range(n)]


def edge_rows():
    """NULLs in every column, empty and blank texts, a very long one, copies, ties and repeated rows."""
    base = " ".join(words(60, 1))
    rows = [
        doc(1, None), doc(2, ""), doc(3, " \t\n"), doc(4, base), doc(5, base), doc(6, base + " tail"),
        doc(7, " ".join(words(30_000, 2))), doc(8, "short"), doc(8, "short"), doc(9, "Ünïcode wörds €uro 東京"),
        (None, "no id at all here", None, None, None), (None, None, None, None, None),
        (10, "null language", None, None, None), doc(11, "a b"), doc(12, "A B"),
    ]
    return rows


def frame(spark, rows, clash=False):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, DOC_DDL)
    return df.withColumns({c: F.lit(f"extra {c}") for c in CLASH}) if clash else df


def plain(df):
    """Sorted rows, NULLs last."""
    return sorted((tuple(r) for r in df.collect()), key=lambda t: [(v is None, str(v)) for v in t])
