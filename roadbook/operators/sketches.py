"""Profiles that add up (P1-P5 over stored shards).

One row per (shard, column) holds figures that can be merged: row, null and
type counts, the range, a HyperLogLog sketch of the values and a sketch of the
most frequent ones. A new shard is profiled by reading that shard alone; the
profile of a shard, of a column over all years, or of any set of shards is an
aggregate of these small rows.

Cases: NULL values count as missing and enter no sketch; a column that a
shard's inventory lists but that has no row yields a row of zeros, so the
inventory can be read back from the sketches; an empty table gives no row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadbook.constants import TOP_VALUES_MAX_DISTINCT, TOP_VALUES_N
from roadbook.operators.profile import _dtype_exprs, _evidence, listed, unpivot_text

#: HyperLogLog registers (2^12): a relative standard error of about 1.6 %; a few hundred values are counted exactly.
LG_K = 12
#: Values that a sketch of the most frequent ones tracks; counts are exact while a column has fewer than 75 values.
TRACKED = 100

COUNTS = ["rows", "null_count", "_n_int", "_n_num", "_n_padded"]


def shard_sketches(df: DataFrame, year_col: str = "shard_year", inventory: DataFrame | None = None) -> DataFrame:
    """(year, column, counts, range, ``distinct_sketch``, ``top_sketch``): one pass, combined before the shuffle."""
    long = listed(unpivot_text(df, [year_col]), inventory, year_col)
    value = F.col("value")
    out = long.groupBy(year_col, "column").agg(
        *_evidence(value), F.hll_sketch_agg(value, F.lit(LG_K)).alias("distinct_sketch"),
        F.expr(f"approx_top_k_accumulate(value, {TRACKED}) FILTER (WHERE value IS NOT NULL)").alias("top_sketch"))
    if inventory is not None:
        out = inventory.select(year_col, "column").distinct().join(out, [year_col, "column"], "left").fillna(0, COUNTS)
    return out


def merged(sketches: DataFrame, by: list[str]) -> DataFrame:
    """The sketches of each group of shards as one row, for example ``by=["column"]`` for all years."""
    return sketches.groupBy(*by).agg(
        *[F.sum(c).alias(c) for c in COUNTS], F.min("_min").alias("_min"), F.max("_max").alias("_max"),
        F.hll_union_agg("distinct_sketch").alias("distinct_sketch"), F.expr("approx_top_k_combine(top_sketch)").alias("top_sketch"))


def figures(sketches: DataFrame) -> DataFrame:
    """P1, P2, P4, P5 of each row of sketches; ``distinct_exact`` marks the distinct counts that aren't estimates."""
    keys = [c for c in sketches.columns if c in ("shard_year", "column")]
    dtype, logical = _dtype_exprs(*[F.col(c) for c in COUNTS])
    distinct = F.coalesce(F.hll_sketch_estimate("distinct_sketch"), F.lit(0))
    return sketches.select(
        *keys, "rows", "null_count", F.round(F.col("null_count").cast("double") * 100.0 / F.nullif("rows", F.lit(0)), 4).alias("null_pct"),
        distinct.alias("distinct_count"), (distinct < TOP_VALUES_MAX_DISTINCT).alias("distinct_exact"),
        dtype.alias("dtype"), logical.alias("logical_type"),
        F.when(dtype != "object", F.col("_min")).alias("min"), F.when(dtype != "object", F.col("_max")).alias("max"))


def top_values(sketches: DataFrame, max_distinct: int = TOP_VALUES_MAX_DISTINCT, n: int = TOP_VALUES_N) -> DataFrame:
    """P3 of each row of sketches: the ``n`` most frequent values of columns with fewer than ``max_distinct`` ones.

    Such a column has fewer values than a sketch tracks, so the counts are
    exact. Ties go to the smaller value; a window holds fewer than
    ``max_distinct`` rows.
    """
    if max_distinct > TRACKED // 2:
        raise ValueError(f"sketches track {TRACKED} values: counts are exact for max_distinct up to {TRACKED // 2}")
    keys = [c for c in sketches.columns if c in ("shard_year", "column")]
    small = sketches.filter(F.hll_sketch_estimate("distinct_sketch") < max_distinct)
    found = small.select(*keys, F.expr(f"inline(approx_top_k_estimate(top_sketch, {max_distinct}))"))
    ranked = found.toDF(*keys, "value", "n").filter(F.col("value").isNotNull())
    w = Window.partitionBy(*keys).orderBy(F.desc("n"), F.asc("value"))
    return ranked.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)
