"""Token counts through a digest cache.

A text's digest, after the normal form that cannot change its count (null becomes
empty), is joined to the counts stored under the digest of the tokenizer. The
distinct digests of a call are compared with the stored ones, without the texts;
only texts whose digest is missing are then encoded, each once, and their counts
are appended to the cache. A row finds its count by its digest. A call reads the
cache's narrow rows and writes in proportion to its own documents.

The cache is a Parquet folder that outlives a run: ``<cache>/tokenizer=<digest>``,
one row a text. There is one writer at a time; a run that dies leaves the cache
as it was or complete, since a write becomes visible at its commit, and rows that
two writers both added are folded when read.

Null and empty texts count 0 tokens and 0 bytes. Texts are encoded whole.
Repeated rows and copies get the count of the first. Result columns replace input
columns of the same name; the others pass through.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwatch.llm.tokens import Counter, loaded, tokenizer_digest
from shelfwatch.runtime import Scratch

#: Characters encoded at once.
RUN_CHARS = 1 << 19

CACHE_SCHEMA = "digest binary, n_tokens bigint"


class CountCache:
    """The stored counts of one tokenizer."""

    def __init__(self, spark: SparkSession, root: str, version: str):
        self.spark = spark
        self.path = f"{root.rstrip('/')}/tokenizer={version}"

    def rows(self) -> DataFrame | None:
        """What is stored, or None before the first write."""
        target = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        if not target.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(target):
            return None
        return self.spark.read.schema(CACHE_SCHEMA).parquet(self.path)

    def append(self, rows: DataFrame) -> None:
        rows.write.mode("append").parquet(self.path)


def _counted(texts: DataFrame, path: str) -> DataFrame:
    """Counts of (digest, body) rows."""

    def run(batches):
        counter = loaded(Counter, path)
        for b in batches:
            bodies, counts, part, size = b.column("body").to_pylist(), [], [], 0
            for body in bodies:
                part.append(body)
                size += len(body)
                if size >= RUN_CHARS:
                    counts += counter.count(part)
                    part, size = [], 0
            if part:
                counts += counter.count(part)
            yield pa.RecordBatch.from_arrays(
                [b.column("digest"), pa.array(counts, pa.int64())], ["digest", "n_tokens"]
            )

    return texts.select("digest", "body").mapInArrow(run, CACHE_SCHEMA)


def count_tokens(
    docs: DataFrame, tokenizer: str, cache: str, text: str = "text", limit: int = 512
) -> DataFrame:
    """Add ``n_bytes``, ``n_tokens`` and ``over_limit`` to each row; the text goes.

    *tokenizer* is the path of a tokenizer's file, the same on every machine;
    *cache* a folder every executor reaches.
    """
    spark = docs.sparkSession
    job = Scratch(spark, "token-counts")
    store = CountCache(spark, cache, tokenizer_digest(tokenizer))
    added = ["n_bytes", "n_tokens", "over_limit"]
    body = F.coalesce(text, F.lit(""))
    digest = F.unhex(F.sha2(body.cast("binary"), 256))

    texts, counts, misses = docs.select(digest.alias("digest"), body.alias("body")), None, None
    known = store.rows()
    if known is not None:
        wanted = job.write(docs.select(digest.alias("digest")).distinct(), "wanted")
        # Only counts of these digests are folded and kept for the rows below.
        stored = known.join(wanted, "digest", "left_semi").groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))
        counts = job.write(stored, "stored")
        misses = job.write(wanted.join(counts, "digest", "left_anti"), "misses")
        job.drop(wanted)
    # Copies fold before the shuffle; each distinct text goes to one task. A few misses are
    # broadcast below the fold, so that known texts stay where they are; many are joined
    # to the folded texts by the same shuffle.
    texts = texts.groupBy("digest").agg(F.min("body").alias("body"))
    if misses is not None:
        texts = texts.join(misses, "digest", "left_semi")
    fresh = job.write(_counted(texts, tokenizer), "fresh")
    store.append(fresh)
    counts = fresh if counts is None else counts.unionByName(fresh)

    rest = [c for c in docs.columns if c != text and c not in added]
    rows = docs.select(
        *rest, F.octet_length(body).cast("bigint").alias("n_bytes"), digest.alias("__digest")
    )
    return (
        rows.join(counts.withColumnRenamed("digest", "__digest"), "__digest")
        .select(*rest, "n_bytes", "n_tokens")
        .withColumn("over_limit", F.col("n_tokens") > limit)
    )
