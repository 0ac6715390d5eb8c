"""The corpus pipeline: raw documents to packed token sequences.

    toxicity -> quality rules -> MinHash near-dedup -> secret scans -> packing

Each stage takes (spark, docs, sf_dir), works on all documents that its
predecessor kept, and is written to the shared folder and read again by the
next one. The first three drop documents, the fourth replaces secrets in the
texts, the last gives the packed pieces (op10's columns).

A stage keeps the documents' columns and order of columns, gives no rows for
no documents, and treats nulls and repeated rows as its operator says (null
texts have no words: the quality rules reject them).
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from depotlens.llm import minhash, packing, quality, secret_scan, toxicity
from depotlens.llm.common import table, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the kernel machine does not call toxic."""
    return toxicity.reject(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the likelihood-ratio threshold."""
    return quality.keep_documents(docs, table(spark, sf_dir, "labels"))


def keep_one_copy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document (the smallest doc_id) of each group of near copies, by
    shingles of five words at a similarity of 0.8."""
    return minhash.keep_one(docs)


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets replaced in the texts, n_chars as of the new text."""
    clean = secret_scan.redact(docs)
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 4096 tokens."""
    return packing.pack_documents(docs, TOKENIZER)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("quality", keep_good),
    ("near_dedup", keep_one_copy),
    ("secrets", hide_secrets),
    ("packing", pack),
]

#: toxicity, near-dedup and packing are not SQL: the tests hold each stage against its operator's brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
