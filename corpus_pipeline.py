"""Corpus pipeline: toxicity, SimHash near-duplicates, benchmark decontamination, secrets, packing.

Every stage reads what its predecessor wrote. The first four return the columns of documents:
toxic documents, all but one document of each near-duplicate group, and documents with a
benchmark passage go; secrets are replaced by a mark. The last returns the packed pieces.

A NULL or empty text is an ordinary document: it isn't toxic without evidence, all empty
texts are copies of one another, it has no passage and no secret, and it packs to the end id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from playmart.llm import decontaminate, packing, secrets, simhash, toxicity
from playmart.llm.common import Scratch, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs, radius=2, shingle=3)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"), n=10)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, packing.byte_bpe_path())


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_copies),
    ("benchmark_decontamination", drop_benchmark),
    ("secret_scan", redact_secrets),
    ("packing", pack),
]

# Fitted weights and a tokenizer's merges are beyond SQL; the tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of documents after all stages; each stage's result is a written table."""
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = scratch.keep(stage(spark, docs, sf_dir))
    return docs
