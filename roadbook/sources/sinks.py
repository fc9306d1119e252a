"""Sinks (K1-K5): Parquet/CSV stage outputs, JSON reports, text summaries, catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None, mode: str = "overwrite",
                  only_partitions: bool = False) -> None:
    """K1: stage output as Parquet (partitioned by year for the big tables).

    A partitioned write goes through a ``REBALANCE`` on the partition
    columns: adaptive execution then splits a skewed year (a year with a
    third of the rows gets many writer tasks) and merges small ones, so the
    output has few, evenly sized files per year instead of one file per task
    and year. ``only_partitions`` replaces the partitions that ``df`` has rows
    of and leaves the others as they are.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    w = df.write.mode(mode)
    if only_partitions:
        w = w.option("partitionOverwriteMode", "dynamic")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K2: final dataset also as CSV with a header line."""
    df.write.mode(mode).option("header", True).csv(path)


def write_json_report(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K3: a report DataFrame (a few rows) as JSON lines in one file."""
    df.coalesce(1).write.mode(mode).json(path)


def write_text_summary(issues: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K4: schema issues as readable lines 'CATEGORY: issue (n): columns'."""
    line = F.concat_ws("", F.col("category"), F.lit(": "), F.col("issue"), F.lit(" ("),
                       F.col("n_columns").cast("string"), F.lit("): "), F.col("columns"))
    issues.select(line.alias("value")).coalesce(1).write.mode(mode).text(path)


def dataset_catalog(spark: SparkSession, outputs: dict[str, str]) -> DataFrame:
    """K5: per written dataset, size in MB, records and fields.

    Each dataset is one aggregate job over its own files (records and the
    sum of distinct file sizes come from the scan's file metadata).
    """
    rows = None
    for name, path in outputs.items():
        df = spark.read.parquet(path)
        files = df.select(F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_size").alias("s"))
        per_file = files.groupBy("f").agg(F.count(F.lit(1)).alias("n"), F.max("s").alias("s"))
        row = per_file.agg(F.lit(name).alias("dataset"), F.round(F.sum("s") / (1024 * 1024), 2).alias("size_mb"), F.sum("s").cast("bigint").alias("size_bytes"),
                           F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("records"),
                           F.lit(len(df.columns)).alias("fields"))
        rows = row if rows is None else rows.unionByName(row)
    return rows


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Read a stage output (fails if absent); schema merging stays off."""
    return spark.read.option("mergeSchema", "false").parquet(path)
