"""Token counts through a digest cache (operator 3).

Content and tokenizer version are reduced to digests. Stored counts are joined
by both; only distinct contents without a stored count are encoded, and their
counts are appended to the cache. Equal texts are brought together before the
texts are shuffled (one row per digest leaves each task), so a text that a
third of the rows share is encoded once and shuffled once per task.

Normalisation: null becomes the empty text, nothing else, because the counts
must be those of the text as it stands. The version digest covers the
tokenizer file and the library's version.

Cases: null and empty texts count 0 tokens; repeated rows each get their row;
an empty table gives an empty result; columns of the input named like an
output column are replaced. The cache has one writer at a time; a job that
fails leaves it as it was (Spark commits the appended files at the end).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadbook.llm.tokens import encoder

CACHE = "version string, digest binary, n_tokens long"


def tokenizer_version(path: str) -> str:
    """Digest of the tokenizer file and the library that reads it."""
    import tokenizers

    with open(path, "rb") as f:
        return hashlib.sha256(f.read() + b"\0" + tokenizers.__version__.encode()).hexdigest()


def _count(path: str, version: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(path)
        for b in batches:
            counts = [e.count(t.as_py()) for t in b.column("__text")]
            yield pa.RecordBatch.from_arrays(
                [pa.array([version] * len(counts), pa.string()), b.column("__digest"), pa.array(counts, pa.int64())],
                ["version", "digest", "n_tokens"])
    return run


def count_tokens(docs: DataFrame, tokenizer: str, cache: str, text: str = "text", limit: int = 512) -> DataFrame:
    """``docs`` with n_bytes, n_tokens and over_limit (n_tokens > ``limit``).

    ``cache`` is a folder in shared storage; it is made when absent and grows
    by the counts that it lacked.
    """
    spark, version = docs.sparkSession, tokenizer_version(tokenizer)
    spark.createDataFrame([], CACHE).write.mode("append").parquet(cache)
    stored = spark.read.schema(CACHE).parquet(cache).where(F.col("version") == version)
    content = F.coalesce(F.col(text), F.lit(""))
    keyed = docs.withColumns({"__digest": F.unhex(F.sha2(content, 256)), "n_bytes": F.octet_length(content).cast("long")})
    distinct = keyed.groupBy("__digest").agg(F.first(content).alias("__text"))
    missing = distinct.join(stored, F.col("__digest") == F.col("digest"), "left_anti")
    missing.mapInArrow(_count(tokenizer, version), CACHE).write.mode("append").parquet(cache)
    counts = spark.read.schema(CACHE).parquet(cache).where(F.col("version") == version)
    counts = counts.select(F.col("digest").alias("__known"), F.col("n_tokens").alias("__n"))
    out = keyed.drop("n_tokens", "over_limit").join(counts, F.col("__digest") == F.col("__known"), "left")
    return out.withColumns({"n_tokens": F.col("__n"), "over_limit": F.col("__n") > limit}).drop("__digest", "__known", "__n")
