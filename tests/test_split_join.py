"""Joins that split hot keys by their number of rows."""

import random

from pyspark.sql import functions as F

from roadbook.operators.joins import fanout_left_join, split_inner_join


def rows(df):
    return sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=str)


def test_split_join_equals_a_left_join(spark):
    rng = random.Random(8)
    left = spark.createDataFrame([(rng.choice([None, "hot", "a", "b", "c", "z"]), i % 4, f"l{i}") for i in range(60)], "k string, y int, own string")
    right = spark.createDataFrame([(rng.choice(["hot"] * 6 + ["a", "b", None]), i % 3, rng.choice([None, 1.5, 2.0]), rng.choice([None, "r", "s"]))
                                   for i in range(400)], "k string, y int, x double, other string")
    for keys in (["k"], ["k", "y"]):
        r = right if len(keys) == 2 else right.drop("y")
        want = rows(left.join(r, keys, "left").select(*left.columns, "x", "other"))
        for split_rows in (1, 7, 100, 10_000):
            assert rows(fanout_left_join(left, r, keys, split_rows=split_rows)) == want, (keys, split_rows)
    assert split_inner_join(left.drop("y"), right.limit(0), "k", 5).count() == split_inner_join(left.limit(0), right.drop("y"), "k", 5).count() == 0


def test_a_third_of_equal_rows_is_spread(spark):
    """One key holds a third of all rows and they are all equal: no task returns over twice the mean."""
    n = 240_000
    right = spark.range(n).select(F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"),
                                  F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("v"))
    left = right.select("k").distinct().withColumn("own", F.lit(1))
    joined = split_inner_join(left, right, "k", 500)
    hot = joined.filter("k = -1").groupBy(F.spark_partition_id().alias("task")).count().collect()
    assert sum(r["count"] for r in hot) == n // 3
    assert len(hot) >= 6 and max(r["count"] for r in hot) <= 2 * (n // 3) / 8
    assert joined.count() == n
