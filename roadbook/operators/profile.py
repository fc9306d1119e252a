"""Shard profiling and schema comparison.

Input is the text of many yearly shards in one DataFrame (all columns as
strings, the way a CSV reader without inference returns them) plus an
inventory of which (shard, column) pairs exist. Everything is computed from
one unpivot and one shuffle keyed by (shard, column, value), after rows are
dealt evenly: hot values collapse in the map-side partial aggregate, and
per-column figures are a second, tiny aggregation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from roadbook.constants import TOP_VALUES_MAX_DISTINCT, TOP_VALUES_N
from roadbook.functions.numeric import INT_RE, NUMBER_RE, PADDED_RE, to_number
from roadbook.operators.joins import join_small


def dealt(df: DataFrame) -> DataFrame:
    """The rows dealt to the session's number of shuffle partitions, whatever their files' splits.

    One task reads a Parquet row group, so a table of a single one gives all that follows to one task.
    The number is fixed: adaptive execution would merge partitions by their compressed bytes.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(parts, *[F.col(f"`{c}`") for c in df.columns])


def unpivot_text(df: DataFrame, id_cols: list[str], value_cols: list[str] | None = None) -> DataFrame:
    """(ids..., column, value) with every value as text."""
    cols = [c for c in (value_cols or df.columns) if c not in id_cols]
    entries = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("value")) for c in cols])
    return df.select(*id_cols, F.inline(entries))


def listed(long: DataFrame, inventory: DataFrame | None, year_col: str = "shard_year") -> DataFrame:
    """The unpivoted rows whose (year, column) an inventory has; all of them without one.

    An inventory is one row per shard and column, whatever table it comes from,
    so every task gets it: a shuffle would deal all values by these few keys.
    """
    if inventory is None:
        return long
    return join_small(long, F.broadcast(inventory.select(year_col, "column").distinct()), [year_col, "column"], "left_semi")


def value_counts(df: DataFrame, year_col: str = "shard_year", inventory: DataFrame | None = None) -> DataFrame:
    """(year, column, value, n) over all shards; NULL values are one group.

    With an inventory, only (year, column) pairs present in that shard count.
    Values are counted in each task before they are shuffled, and a task holds
    all its distinct ones; so rows are dealt to the session's number of shuffle
    partitions first, as a split of a Parquet file can hold millions of keys.
    """
    long = listed(unpivot_text(dealt(df), [year_col]), inventory, year_col)
    return long.groupBy(year_col, "column", "value").agg(F.count(F.lit(1)).alias("n"))


def _evidence(value, n=None) -> list:
    """Aggregates that decide a type and the range; ``n``: rows of each value, if they are counted already."""
    is_int = value.rlike(INT_RE) & value.try_cast("bigint").isNotNull()
    is_num = value.rlike(NUMBER_RE) & value.try_cast("double").isNotNull()

    def rows(cond):
        return F.count_if(cond) if n is None else F.sum(F.when(cond, n).otherwise(0))

    return [(F.count(F.lit(1)) if n is None else F.sum(n)).alias("rows"), rows(value.isNull()).alias("null_count"),
            rows(is_int).alias("_n_int"), rows(is_num).alias("_n_num"), rows(value.rlike(PADDED_RE)).alias("_n_padded"),
            F.min(to_number(value)).alias("_min"), F.max(to_number(value)).alias("_max")]


def _figures(year_col: str, distinct=None) -> list:
    """Columns of ``column_stats`` from ``_evidence``."""
    dtype, logical = _dtype_exprs(F.col("rows"), F.col("null_count"), F.col("_n_int"), F.col("_n_num"), F.col("_n_padded"))
    numeric = dtype != "object"
    return [F.col(year_col), F.col("column"), F.col("rows"), F.col("null_count"),
            F.round(F.col("null_count").cast("double") * 100.0 / F.col("rows"), 4).alias("null_pct"),
            *([] if distinct is None else distinct), dtype.alias("dtype"), logical.alias("logical_type"),
            F.when(numeric, F.col("_min")).alias("min"), F.when(numeric, F.col("_max")).alias("max")]


def _dtype_exprs(rows, nulls, n_int, n_num, n_padded):
    nn = rows - nulls
    dtype = (F.when(nn == 0, F.lit("float64"))
             .when((n_int == nn) & (nulls == 0), F.lit("int64"))
             .when(n_num == nn, F.lit("float64"))
             .otherwise(F.lit("object")))
    logical = (F.when(nn == 0, F.lit("null")).when(n_padded > 0, F.lit("string")).when(n_int == nn, F.lit("long"))
               .when(n_num == nn, F.lit("double")).otherwise(F.lit("string")))
    return dtype, logical


def type_evidence(df: DataFrame, year_col: str = "shard_year", inventory: DataFrame | None = None) -> DataFrame:
    """Figures per (year, column) without value-level grouping.

    The aggregate is keyed by (year, column) only, so it is fully combined
    map-side: the shuffle carries one small row per task and column, however
    many distinct values the data has. This is what nulls, ranges and type
    resolution need; only distinct counts and top values count values.
    """
    long = listed(unpivot_text(df, [year_col]), inventory, year_col)
    return long.groupBy(year_col, "column").agg(*_evidence(F.col("value"))).select(*_figures(year_col))


def column_stats(vc: DataFrame, year_col: str = "shard_year") -> DataFrame:
    """P1, P2, P4, P5 per (year, column) from the value counts.

    ``dtype`` follows the CSV reader's inference: all values integer text and
    no missing value -> int64; all values numeric -> float64 (an integer
    column with gaps, or an all-missing column, is float64); else object.
    ``logical_type`` ignores missing values: long, double, string or null;
    codes with leading zeros are strings.
    """
    v = F.col("value")
    stats = vc.groupBy(year_col, "column").agg(*_evidence(v, F.col("n")), F.count(v).alias("distinct_count"))
    return stats.select(*_figures(year_col, [F.col("distinct_count")]))


def top_values(vc: DataFrame, stats: DataFrame, year_col: str = "shard_year",
               max_distinct: int = TOP_VALUES_MAX_DISTINCT, n: int = TOP_VALUES_N) -> DataFrame:
    """For columns with fewer than ``max_distinct`` values, the ``n`` most frequent.

    Ties go to the smaller value. The window partitions are bounded by
    ``max_distinct`` rows because low-cardinality columns are selected first.
    """
    small = stats.filter(F.col("distinct_count") < max_distinct).select(year_col, "column")
    # at most one row per shard and column: sent to every task, it also keeps other columns out of the count
    cand = join_small(vc.filter(F.col("value").isNotNull()), F.broadcast(small), [year_col, "column"], "left_semi")
    w = Window.partitionBy(year_col, "column").orderBy(F.desc("n"), F.asc("value"))
    return cand.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)


def inventory_types(inventory: DataFrame, stats: DataFrame, year_col: str = "shard_year") -> DataFrame:
    """(year, column, dtype, logical_type) for every column present in a shard."""
    return inventory.join(stats.select(year_col, "column", "dtype", "logical_type"), [year_col, "column"], "left")


def schema_matrix(inv: DataFrame, year_col: str = "shard_year") -> DataFrame:
    """Per column, the years it is present in (comma list) and how many."""
    return inv.groupBy("column").agg(
        F.array_join(F.array_sort(F.collect_set(F.col(year_col).cast("string"))), ",").alias("years_present"),
        F.count_distinct(year_col).alias("n_years"))


def schema_dtype_changes(inv_types: DataFrame, year_col: str = "shard_year") -> DataFrame:
    """Columns whose dtype differs between years, with 'year:dtype' pairs in year order."""
    pairs = F.array_sort(F.collect_list(F.struct(F.col(year_col), F.col("dtype"))))
    return (inv_types.groupBy("column")
            .agg(F.count_distinct("dtype").alias("n_dtypes"), pairs.alias("_p"))
            .filter(F.col("n_dtypes") > 1)
            .select("column", "n_dtypes",
                    F.array_join(F.transform("_p", lambda p: F.concat(p[year_col].cast("string"), F.lit(":"), p["dtype"])),
                                 ",").alias("dtypes_by_year")))



def schema_added(inv: DataFrame, year_col: str = "shard_year") -> DataFrame:
    """Columns first seen after the earliest shard year, with that first year."""
    first_all = inv.select(F.min(year_col)).scalar()
    return (inv.groupBy("column").agg(F.min(year_col).alias("first_year"))
            .filter(F.col("first_year") != first_all))


def schema_removed(inv: DataFrame, year_col: str = "shard_year") -> DataFrame:
    """Columns last seen before the latest shard year, with that last year."""
    last_all = inv.select(F.max(year_col)).scalar()
    return (inv.groupBy("column").agg(F.max(year_col).alias("last_year"))
            .filter(F.col("last_year") != last_all))


def schema_issues(inv_types: DataFrame, category: str, year_col: str = "shard_year") -> DataFrame:
    """P10: one row per (category, issue) with the sorted affected columns."""
    parts = [
        schema_dtype_changes(inv_types, year_col).select(F.lit("dtype_changes").alias("issue"), "column"),
        schema_added(inv_types, year_col).select(F.lit("added_columns").alias("issue"), "column"),
        schema_removed(inv_types, year_col).select(F.lit("removed_columns").alias("issue"), "column"),
    ]
    u = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return u.groupBy("issue").agg(
        F.array_join(F.array_sort(F.collect_list("column")), ",").alias("columns"),
        F.count(F.lit(1)).alias("n_columns"),
    ).select(F.lit(category).alias("category"), "issue", "columns", "n_columns")


def missing_summary(df: DataFrame, exclude: list[str] | None = None) -> DataFrame:
    """Columns with missing values and their counts (one aggregate pass)."""
    cols = [c for c in df.columns if c not in (exclude or [])]
    row = df.agg(F.count(F.lit(1)).alias("_rows"),
                 *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"_m{i}") for i, c in enumerate(cols)])
    entries = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"_m{i}").alias("missing")) for i, c in enumerate(cols)])
    return row.select("_rows", F.inline(entries)).filter(F.col("missing") > 0).select(
        "column", "missing", F.col("_rows").alias("rows"))


def profile_shards(df: DataFrame, year_col: str = "shard_year", inventory: DataFrame | None = None,
                   exact_distinct: bool = True, candidate_margin: int = 10) -> tuple[DataFrame, DataFrame]:
    """P1-P5 in one call: (per (year, column) stats, top values).

    ``exact_distinct=True`` counts every distinct (shard, column, value)
    exactly (one value-level shuffle). ``exact_distinct=False`` is the
    at-scale mode: null counts, types and ranges come from an aggregate keyed
    by (shard, column) only (combined map-side), distinct counts from
    HyperLogLog, and only columns whose estimate is below
    ``candidate_margin`` x the top-values threshold are counted value by value
    — so their distinct counts and top values stay exact, while
    high-cardinality columns (keys, free text) never shuffle their values.
    ``distinct_exact`` says which distinct counts are exact in that mode.
    """
    if exact_distinct:
        vc = value_counts(df, year_col, inventory)
        stats = column_stats(vc, year_col)
        return stats, top_values(vc, stats, year_col)
    long = listed(unpivot_text(df, [year_col]), inventory, year_col)
    v = F.col("value")
    base = long.groupBy(year_col, "column").agg(*_evidence(v), F.approx_count_distinct(v).alias("approx_distinct"))
    cand = base.filter(F.col("approx_distinct") < TOP_VALUES_MAX_DISTINCT * candidate_margin).select(year_col, "column")
    small_long = join_small(long, F.broadcast(cand), [year_col, "column"], "left_semi")
    vc = small_long.groupBy(year_col, "column", "value").agg(F.count(F.lit(1)).alias("n"))
    exact_small = vc.filter(F.col("value").isNotNull()).groupBy(year_col, "column").agg(
        F.count(F.lit(1)).alias("_exact_distinct"))
    stats = base.join(exact_small, [year_col, "column"], "left")
    distinct = [F.coalesce(F.col("_exact_distinct"), F.col("approx_distinct")).alias("distinct_count"),
                F.col("_exact_distinct").isNotNull().alias("distinct_exact")]
    stats = stats.select(*_figures(year_col, distinct))
    return stats, top_values(vc, stats, year_col)
