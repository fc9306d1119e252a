"""Helpers of the training-data operators."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadbook.session import checkpoint_dir

#: Fixed: a word is a run of characters other than the six ASCII white-space ones.
WORD = r"[^\x20\x09-\x0D]+"


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder name under the cluster's shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str, compression: str = "zstd") -> DataFrame:
    """``df`` written as Parquet in the shared folder and read back: lineage ends here, lost executors cost nothing."""
    path = scratch(df.sparkSession, name)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def importable(spark: SparkSession) -> None:
    """Let Python workers find this package where it lies (on a cluster, ship it with --py-files)."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(":"):
        env["PYTHONPATH"] = ":".join(filter(None, [root, env.get("PYTHONPATH")]))


def table(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def least_hashed(rows: DataFrame, most: int, *key: Column | str) -> DataFrame:
    """The ``most`` rows with the least hash of the first part of their key, ties by the key.

    All tasks together send about ``most`` rows to the merge, not ``most`` each: beyond 2 * ``most`` rows the share of
    hashes that can be among them is cut first, with a tenth to spare.
    """
    number = rows.count()
    h = F.xxhash64(key[0])
    if number > 2 * most:
        few = rows.where(h <= F.lit(int(2 ** 64 * 1.1 * most / number) - 2 ** 63))
        if few.count() >= most:
            rows = few
    return rows.orderBy(h, *key).limit(most)


def n_words(text: Column) -> Column:
    """Number of words; null counts as no word."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def unit(*key: Column) -> Column:
    """A reproducible number in [0, 1) from a key."""
    return F.pmod(F.xxhash64(*key), F.lit(1 << 52)) / F.lit(float(1 << 52))
