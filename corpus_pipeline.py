"""Cleaning a corpus of documents in stages, each written before the next reads it.

Every stage calls one operator on all that its predecessor kept. The first four
return the columns of ``documents``; the last returns packed pieces. ``ORACLE_SQL``
is None, since a trained model and fingerprints have no SQL form; the tests hold
the result against a plain version.

Null and empty texts, repeated rows and ties are treated as each operator says. A
table without rows passes through. A column beyond those of ``documents`` ends at
the first stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwatch.llm import decontaminate, packing, quality, secrets, simhash
from shelfwatch.runtime import Scratch

DOCUMENT = ["doc_id", "text", "lang", "source", "n_chars"]


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality model accepts; it learns from the labelled ones."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality.fit(docs, labels)
    return quality.score(docs.select(*DOCUMENT), model).filter("predicted = 1").select(*DOCUMENT)


def keep_distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id."""
    return simhash.keep_one(docs.select(*DOCUMENT))


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.remove_documents(docs.select(*DOCUMENT), benchmark)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by a mark; ``n_chars`` changes as far as the text does."""
    before = docs.select(*DOCUMENT, F.char_length("text").alias("length"))
    clean = secrets.redact(before, secrets.fit(docs))
    change = F.coalesce(F.char_length("text") - F.col("length"), F.lit(0))
    return clean.withColumn("n_chars", F.col("n_chars") + change).select(*DOCUMENT)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces and their places in sequences of 2048 tokens."""
    table = packing.pieces(docs.select("doc_id", "text"), public_tokenizers.path("word_bpe_49k.json"))
    return packing.pack(table).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )


STAGES = [
    ("quality", keep_good),
    ("near_duplicates", keep_distinct),
    ("decontamination", drop_benchmark),
    ("secrets", redact_secrets),
    ("packing", pack),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read by the next."""
    job = Scratch(spark, "pipeline")
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        after = job.write(stage(spark, docs, sf_dir), name)
        if before is not None:
            job.drop(before)
        docs = before = after
    return docs
