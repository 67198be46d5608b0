"""License scan: base phrases, and an exact set-similarity join with license templates.

DataFrame functions only. A text's words are joined with single blanks once and written to
the shared folder. Base phrases are found by splitting that string. For the similarity
join, texts are cut into overlapping blocks of ``block`` words (an occurrence of up to
block/2 + 1 words lies whole in one of them); a template is found in a block if the block
has at least ``threshold`` of the template's distinct words. The join is exact:

* words are ordered by their count in the whole corpus, rarest first;
* prefix filter: a qualifying pair shares one of the template's first ``size - need + 1``
  words, which is also among the block's first ``own size - need + 1`` words (only words of
  some template matter for an overlap, so a block is reduced to these);
* length filter: the block has at least ``need`` such words;
* positional filter: at the first shared word, what follows on either side still allows ``need``;
* the overlap of every remaining pair is counted.

The templates are a parameter of the query, so their index is broadcast; it must not
exceed ``max_index`` rows.

Defined results: NULL and empty texts have no words, places or labels and score 0;
repeated rows and NULL ids are scanned row by row; an empty table gives no rows; only the id
and text columns are read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER, NON_ALNUM, UPPER, Scratch, table

# The base phrases and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Statements by which public licenses are commonly named or granted.
TEMPLATES = (
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("apache-2.0", "you may not use this file except in compliance with the license"),
    ("mit", "released under the mit license"),
    ("mit", "licensed under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0"),
)


def normalised(text: Column) -> Column:
    """Alphanumeric words (A-Z lower-cased), joined with single blanks."""
    return F.trim(F.regexp_replace(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), NON_ALNUM, " "))


def n_words(norm: Column) -> Column:
    return F.when(norm == "", F.lit(0)).otherwise(F.octet_length(norm) - F.octet_length(F.replace(norm, F.lit(" "), F.lit(""))) + 1).cast("long")


def phrase_columns(norm: Column, phrases: dict[str, str]) -> dict[str, Column]:
    """n_base, first_word, last_word and base_labels (array) of the places of ``phrases``."""
    # With two blanks between words every word has its own on both sides, so adjacent places don't overlap.
    wide = F.concat(F.lit(" "), F.replace(norm, F.lit(" "), F.lit("  ")), F.lit(" "))
    blanks = lambda part: F.octet_length(part) - F.octet_length(F.replace(part, F.lit(" "), F.lit("")))
    counts, firsts, lasts, labels = [], [], [], []
    for phrase, label in phrases.items():
        needle = " " + phrase.replace(" ", "  ") + " "
        has = F.contains(wide, F.lit(needle))
        parts = F.split(wide, needle)
        counts.append(F.when(has, F.size(parts) - 1).otherwise(0))
        firsts.append(F.when(has, blanks(F.element_at(parts, 1)) / 2))
        lasts.append(F.when(has, n_words(norm) - blanks(F.element_at(parts, -1)) / 2 - len(phrase.split())))
        labels.append(F.when(has, F.lit(label)))
    return {
        "n_base": sum(counts[1:], counts[0]).cast("long"),
        "first_word": F.least(*firsts).cast("long"),
        "last_word": F.greatest(*lasts).cast("long"),
        "base_labels": F.array_sort(F.array_distinct(F.array_compact(F.array(*labels)))),
    }


def template_index(texts: DataFrame, templates, threshold: float) -> tuple[list[str], DataFrame]:
    """Template words ordered by their corpus count, and a row per template and prefix word.

    ``texts`` has the column norm. The count reads the whole corpus, but only template words
    leave the tasks, as one sum a word.
    """
    sets = [(label, set(text.split())) for label, text in templates]
    vocabulary = sorted(set().union(*[s for _, s in sets]))
    word = texts.select(F.explode(F.split("norm", " ")).alias("word")).where(F.col("word").isin(vocabulary))
    count = dict(word.groupBy("word").count().collect())  # at most one row a template word
    order = sorted(vocabulary, key=lambda w: (count.get(w, 0), w))
    rank = {w: i for i, w in enumerate(order)}
    rows = []
    for k, (label, words) in enumerate(sets):
        ordered = sorted(words, key=rank.get)
        need = math.ceil(threshold * len(ordered) - 1e-9)
        words_lit = F.array(*[F.lit(w) for w in ordered])
        for i, w in enumerate(ordered[: len(ordered) - need + 1]):
            cells = {"word": w, "template": k, "label": label, "i": i, "size": len(ordered), "need": need}
            rows.append(F.struct(*[F.lit(v).alias(c) for c, v in cells.items()], words_lit.alias("words")))
    return order, texts.sparkSession.range(1).select(F.inline(F.array(*rows)))


def similar_blocks(texts: DataFrame, templates=TEMPLATES, threshold: float = 0.85, block: int | None = None, max_index: int = 100_000) -> DataFrame:
    """(rid, start, label, containment) of every block that meets a template; ``texts`` has rid and norm.

    Blocks start every half block. ``block`` (default: twice the longest template's words, 64 at least)
    must be twice the longest template, so a template's words always lie within one block."""
    longest = max((len(text.split()) for _, text in templates), default=0)
    block = max(64, 2 * longest) if block is None else block
    if block < 2 * longest:
        raise ValueError(f"a template of {longest} words needs blocks of {2 * longest} words")
    order, index = template_index(texts, templates, threshold)
    if index.count() > max_index:
        raise ValueError(f"the templates have more than {max_index} prefix words")
    prefix = sorted({r["word"] for r in index.select("word").collect()})
    words = texts.select("rid", F.split("norm", " ").alias("words"))
    words = words.where(F.arrays_overlap("words", F.array(*[F.lit(w) for w in prefix])))
    last = F.greatest(F.size("words") - block // 2, F.lit(1))
    blocks = words.select("rid", "words", F.explode(F.sequence(F.lit(0), last - 1, F.lit(block // 2))).alias("start"))
    own = F.array_intersect(F.array(*[F.lit(w) for w in order]), F.slice("words", F.col("start") + 1, block))
    tokens = blocks.select("rid", "start", own.alias("own")).select("rid", "start", "own", F.posexplode("own").alias("j", "word"))
    left = F.size("own") - F.col("j")
    pairs = tokens.join(F.broadcast(index), "word").where(
        (F.size("own") >= F.col("need")) & (left >= F.col("need")) & (F.least(left, F.col("size") - F.col("i")) >= F.col("need"))
    )
    shared = F.size(F.array_intersect("own", "words"))
    found = pairs.select("rid", "start", "template", "label", (shared / F.col("size")).alias("containment"), (shared >= F.col("need")).alias("ok"))
    return found.where("ok").groupBy("rid", "start", "template", "label").agg(F.max("containment").alias("containment")).drop("template")


def scan_licenses(
    docs: DataFrame,
    templates=TEMPLATES,
    phrases: dict[str, str] = PHRASES,
    threshold: float = 0.85,
    block: int | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """A row per document row: id_col, n_words, n_base, first_word, last_word, base_labels and
    labels (sorted arrays) and score (1 with a base phrase, else the best containment)."""
    scratch = Scratch(docs.sparkSession, "licenses")
    texts = scratch.keep(docs.select(F.monotonically_increasing_id().alias("rid"), F.col(id_col), normalised(F.col(text_col)).alias("norm")))
    found = similar_blocks(texts.select("rid", "norm"), templates, threshold, block)
    found = found.groupBy("rid").agg(F.collect_set("label").alias("own_labels"), F.max("containment").alias("best"))
    norm = F.col("norm")
    base = texts.select("rid", id_col, n_words(norm).alias("n_words"), *[c.alias(k) for k, c in phrase_columns(norm, phrases).items()])
    none = F.array().cast("array<string>")
    labels = F.array_sort(F.array_union("base_labels", F.coalesce("own_labels", none))).alias("labels")
    score = F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce("best", F.lit(0.0))).alias("score")
    return base.join(found, "rid", "left").select(id_col, "n_words", "n_base", "first_word", "last_word", "base_labels", labels, score)


def op6_licenses(spark, sf_dir: str) -> DataFrame:
    """License phrases and templates in every document."""
    found = scan_licenses(table(spark, sf_dir, "documents"))
    return found.withColumns({c: F.array_join(c, ",") for c in ("base_labels", "labels")})
