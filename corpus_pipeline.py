"""The corpus pipeline: documents in, packed training sequences out.

STAGES holds (name, function); each function takes (spark, docs, sf_dir) and
returns a DataFrame that is written and read again as the next one's docs.

1. language   texts without a letter (or null) go, and no others; a missing
              label is filled in with the prediction ("und" where no label
              could be learned from)
2. near_dup   of each class of near copies (five words, 0.8 or more) the
              document with the smallest id stays
3. secrets    secrets in the texts are masked; n_chars follows the text
4. mix        documents are repeated or left out so that their sources reach
              the target weights
5. pack       token ids of the documents are packed into sequences of 4096

Each stage works on what its predecessor kept. Columns of the input that a
stage doesn't name pass through it, whatever their names and case; an empty
table passes every stage.

Nulls and repeats: a null text goes at the first stage. Rows that share an id
are judged by their texts, and rows without an id are copies only of equal
texts. Rows that agree in id, source and text are mixed as one unit, with the
same number of copies each; a null source is a source of its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadbook.llm import language_id, mixing, near_dup, packing, secret_scan
from roadbook.llm.common import importable, table, written
from roadbook.llm.tokens import tokenizer_path


def set_aside(docs: DataFrame, *names: str) -> DataFrame:
    """``docs`` with columns whose names an operator needs renamed (see ``given_back``)."""
    return docs.withColumnsRenamed({c: f"__own_{c}" for c in docs.columns if c.lower() in names})


def given_back(out: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` from ``out``, under their own names."""
    return out.select(*[F.col(f"`__own_{c}`").alias(c) if f"__own_{c}" in out.columns else F.col(f"`{c}`") for c in docs.columns])


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    importable(spark)
    found = language_id.identify(set_aside(docs, "lang_pred", "score"), language_id.train(docs))
    # a score above 0 says that a text has letters, where there is a model; a text without a known language stays
    lettered = (F.col("score") > 0) | F.col("text").rlike(r"\p{L}")
    found = found.where(lettered).withColumn("lang", F.coalesce("lang", "lang_pred"))
    return given_back(found, docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    importable(spark)
    return near_dup.one_of_each(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(set_aside(docs, "spans"))
    text = secret_scan.redacted(F.col("text"), F.col("spans"))
    n_chars = F.when(F.size("spans") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    masked = found.withColumn("text", text)
    return given_back(masked.withColumn("n_chars", n_chars), docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    importable(spark)
    out = packing.pack(packing.pieces(docs, tokenizer_path("word_bpe_49k.json")), with_ids=False)
    return out.select("doc_id", "start", F.col("length").cast("long").alias("length"), F.col("crc").alias("ids_crc32"),
                      "doc_tokens", "sequence_id", "offset")


STAGES = [("language", language), ("near_dup", near_duplicates), ("secrets", secrets), ("mix", mix), ("pack", pack)]

#: Language models, signatures and tokenizers have no SQL form; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir)
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
