"""Registered queries of the training-data operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadbook.llm import (hard_negatives, language_id, merkle_manifest, mixing, near_dup, oracle, packing, quality_model, quality_rules, secret_scan,
                          suffix_dedup, token_counts, token_files, vector_search)
from roadbook.llm.common import scratch, table
from roadbook.llm.tokens import tokenizer_path

#: Fixed: ids of word_bpe_49k.json.
VOCABULARY = 49_408

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLE[name] = sql
        return f
    return add


@query("op1_mixing")
def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mix all documents to the weights 5, 2, 1 of their sources, up to 3 copies each."""
    units = mixing.copies(table(spark, sf_dir))
    each = units.withColumn("row", F.explode(F.sequence(F.lit(1).cast("long"), "rows")))
    return each.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "source", "copies")


def held_out() -> Column:
    """Documents that the language model doesn't learn from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


@query("op2_language_id")
def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every text, learned from the labelled texts that aren't held out."""
    docs = table(spark, sf_dir).withColumn("held_out", held_out())
    model = language_id.train(docs.where(~F.col("held_out")))
    return language_id.identify(docs, model, ["doc_id", "held_out"])


@query("op3_token_counts")
def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of every text, through a cache that starts empty: equal texts are encoded once."""
    docs = table(spark, sf_dir).select("doc_id", "text")
    out = token_counts.count_tokens(docs, tokenizer_path("byte_bpe_50k.json"), scratch(spark, "token-cache"))
    return out.select("doc_id", "n_bytes", "n_tokens", "over_limit")


@query("op4_vector_search")
def op4_vector_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of every 20th vector among all others."""
    return vector_search.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


@query("op5_token_files")
def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write all texts as token-ID files and read them back."""
    tokens = token_files.tokenized(table(spark, sf_dir), tokenizer_path("word_bpe_49k.json"), VOCABULARY)
    folder = scratch(spark, "token-files")
    token_files.write_token_files(tokens, folder, VOCABULARY)
    return token_files.read_digests(spark, folder)


@query("op6_secret_scan")
def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of secrets in every text."""
    found = secret_scan.scan(table(spark, sf_dir), ["doc_id"])
    base = F.filter("spans", lambda s: s["place"] < 3)

    def number(place: int):
        return F.size(F.filter("spans", lambda s: s["place"] == place)).cast("long")

    return found.select("doc_id", number(0).alias("n_assign"), number(1).alias("n_access"), number(2).alias("n_hex"),
                        F.sha2(secret_scan.listed(base), 256).alias("base_sha256"), secret_scan.listed(F.col("spans")).alias("spans"))


@query("op7_quality_model")
def op7_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every text; a source is a host, and its texts of one language are a path."""
    docs = table(spark, sf_dir)
    return quality_model.classify(docs, table(spark, sf_dir, "labels"), F.col("source"), F.col("lang"))


@query("op8_near_dup")
def op8_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class of every document: five-word shingles, similarity 0.8 or more."""
    found = near_dup.classes(table(spark, sf_dir))
    return found.select(F.col("doc").alias("doc_id"), "class_id", (F.col("doc") == F.col("class_id")).alias("kept"))


@query("op9_packing")
def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pack all texts into sequences of 4096 ids."""
    cut = packing.pieces(table(spark, sf_dir), tokenizer_path("word_bpe_49k.json"))
    out = packing.pack(cut, with_ids=False)
    return out.select("doc_id", "start", F.col("length").cast("long").alias("length"), F.col("crc").alias("ids_crc32"),
                      "doc_tokens", "sequence_id", "offset")


@query("op10_quality_rules")
def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base rules and a decision list learned from the quality labels, for every text."""
    stats = quality_rules.statistics(table(spark, sf_dir).select("doc_id", "text"))
    rules = quality_rules.learn(stats, table(spark, sf_dir, "labels"))
    out = quality_rules.judged(stats, rules)
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule")


def manifest_leaves(docs: DataFrame) -> DataFrame:
    """Leaves of documents; where 5 divides the crc32 of a doc_id, the text's A-Z are lower-cased behind the manifest's back."""
    def leaf(text: Column) -> Column:
        return merkle_manifest.digest(F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), text)

    folded = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    return docs.select(F.col("source").alias("group"), F.col("doc_id").alias("id"), leaf(F.col("text")).alias("leaf"),
                       F.when(hit, leaf(folded)).alias("tampered"))


@query("op11_merkle_manifest", oracle.MERKLE_MANIFEST)
def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Proof of every document against the root of the whole table, with one document in five tampered with."""
    out = merkle_manifest.manifest(manifest_leaves(table(spark, sf_dir)))
    return out.select(F.col("id").alias("doc_id"), F.col("group").alias("source"), *merkle_manifest.RETURNED)


@query("op12_hard_negatives", oracle.HARD_NEGATIVES)
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every 100th vector; every 7th vector has another label than the table says."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label=label)


@query("op13_suffix_dedup", oracle.SUFFIX_DEDUP)
def op13_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text without the 50-byte strings that a document with a smaller id has."""
    return suffix_dedup.dedup(table(spark, sf_dir))
