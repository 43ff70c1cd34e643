"""The dealt operators over the given tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwatch.llm import (
    conversations,
    decontaminate,
    embedding_join,
    licenses,
    packing,
    pieces,
    quality,
    secrets,
    simhash,
    toxicity,
    warc,
    whitening,
)
from shelfwatch.llm.token_counts import count_tokens
from shelfwatch.runtime import Scratch


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _fold(key: str, folds: int) -> Column:
    """crc32 of the id as text, modulo *folds*; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit(""))) % folds


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document; fold 0 of 5 is held out of training."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    labels = _table(spark, sf_dir, "labels").filter(_fold("doc_id", 5) != 0)
    net = toxicity.fit(docs, labels)
    return toxicity.score(docs, net).select(
        "doc_id",
        (_fold("doc_id", 5) == 0).alias("held_out"),
        "score",
        "predicted",
        "threshold",
        "flagged",
    )


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document, as a second delivery: the texts of the English ones are in the cache by then."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    cache = Scratch(spark, "token-cache").path("counts")
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    count_tokens(docs.filter("lang = 'en'"), tokenizer, cache)  # what it stores is all that is used
    return count_tokens(docs.drop("lang"), tokenizer, cache)


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secrets.scan(docs, secrets.fit(docs))
    return found.select("doc_id", *[c.alias(n) for n, c in secrets.digest().items()])


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of benchmark items in every document."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find(docs, _table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        decontaminate.items_digest().alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document; fold 2 of 4 is held out of training."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = _table(spark, sf_dir, "labels").filter(_fold("doc_id", 4) != 2)
    model = quality.fit(docs, labels)
    return quality.score(docs, model).select(
        "doc_id", (_fold("doc_id", 4) == 2).alias("held_out"), "score", "predicted"
    )


def op6_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and groups of vectors with a cosine of at least 0.9."""
    rows = _table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return embedding_join.join(rows).select("vec_id", "n_links", "component_id", "kept")


def document_path() -> Column:
    """A path for a document: source, language, and a folder of 500 ids (every seventh is above it)."""
    folder = F.floor(F.col("doc_id") / 500).cast("string")
    return F.concat_ws(
        "/", "source", "lang", F.when(F.col("doc_id") % 7 != 0, folder), F.col("doc_id").cast("string")
    )


def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The license of every document: its own, or that of the nearest license file above it."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", document_path().alias("path"), "text")
    return licenses.scan(docs)


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written as WARC records, read back and assembled."""
    job = Scratch(spark, "warc")
    path = job.path("archive")
    warc.write(_table(spark, sf_dir, "pages").select("page_id", "url", "html"), path)
    captures = warc.assemble(warc.read(spark, path, with_payload=False))
    rows = job.write(
        captures.select(
            "record_id",
            F.col("metadata.fields")["page-id"].cast("bigint").alias("page_id"),
            F.col("capture.payload_bytes").alias("payload_bytes"),
            F.col("capture.payload_digest").alias("payload_digest"),
            F.col("capture.type").alias("record_type"),
            F.col("capture.refers_to").alias("source"),
        ),
        "captures",
    )
    responses = rows.filter("record_type = 'response'").select(
        F.col("record_id").alias("source"), F.col("page_id").alias("refers_to")
    )
    return rows.join(responses, "source", "left").select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents whose fingerprints of 3-word shingles differ in at most 3 bits."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return simhash.group(simhash.add_fingerprints(docs)).select(
        "doc_id", simhash.hex_print().alias("fingerprint"), "component_id"
    )


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 2048 tokens."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    table = packing.pieces(docs, public_tokenizers.path("word_bpe_49k.json"))
    return packing.pack(table).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )


def damaged(rows: DataFrame) -> DataFrame:
    """Conversations with a fifth of their rows dropped, emptied, cut, repeated or given to the user."""

    def shown(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn")).cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(shown("text"), "[.!?]", "")).otherwise(shown("text"))
    return rows.filter(kind != 0).select(
        "conv_id",
        "turn",
        F.when(kind == 4, "user").otherwise(shown("role")).alias("role"),
        text.alias("text"),
        F.explode(F.when(kind == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"),
    )


def op11_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults of every damaged conversation and the cheapest repair."""
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    found = conversations.repair(damaged(rows)).withColumnRenamed("conv_id", "found")
    ids = rows.select("conv_id").distinct()
    zero, nothing = F.lit(0).cast("bigint"), F.lit("")
    return ids.join(found, F.col("conv_id").eqNullSafe(F.col("found")), "left").select(
        "conv_id",
        *[F.coalesce(c, zero).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        F.coalesce("audit", nothing).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
    )


def op12_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SentencePiece ids of every document, and the text they decode to."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = public_tokenizers.path("piece_bpe_32k.model")
    rows = pieces.encode(docs, model, stored=True, decoded="decoded")
    listed = F.concat_ws(",", F.col("ids").cast("array<string>"))
    return rows.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(listed.cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector on the eight leading components; a deviation beyond a long is null there only."""
    rows = _table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    exact = F.col("deviation")
    return whitening.whiten(rows).select(
        "vec_id",
        "component",
        "n",
        exact.try_cast("bigint").alias("deviation"),
        "whitened",
        "explained",
        "identity_error",
        exact.alias("deviation_exact"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_token_counts": op2_token_counts,
    "op3_secrets": op3_secrets,
    "op4_decontamination": op4_decontamination,
    "op5_quality": op5_quality,
    "op6_embeddings": op6_embeddings,
    "op7_licenses": op7_licenses,
    "op8_warc": op8_warc,
    "op9_simhash": op9_simhash,
    "op10_packing": op10_packing,
    "op11_conversations": op11_conversations,
    "op12_pieces": op12_pieces,
    "op13_whitening": op13_whitening,
}
