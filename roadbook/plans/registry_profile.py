"""Registered queries for profiling (P), harmonization (H) and F1-F4."""

from __future__ import annotations

from pyspark.sql import functions as F

from roadbook.operators import date_types as DT
from roadbook.operators import harmonize as H
from roadbook.operators import profile as P
from roadbook.operators import sketches as K
from roadbook.plans import fixtures as fx
from roadbook.plans import oracle as O
from roadbook.plans.registry import register
from roadbook.session import materialize

Y = "shard_year"
SHARD_COLS = fx.SHARD_COLUMNS

O.cte("shard_text", """
SELECT CAST(year(o_orderdate) AS INTEGER) AS shard_year,
       CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderstatus,
       CASE WHEN year(o_orderdate) IN (1997, 1998) THEN format('{:,.2f}', o_totalprice)
            ELSE CAST(o_totalprice AS VARCHAR) END AS o_totalprice,
       strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') AS o_orderdate,
       CASE WHEN year(o_orderdate) > 1996 THEN o_orderpriority END AS o_orderpriority,
       lpad(CAST(o_orderkey % 10000 AS VARCHAR), 4, '0') AS o_code,
       CAST(o_orderkey % 100 AS VARCHAR) || CASE WHEN o_orderkey % 2 = 0 THEN 'D' ELSE 'F' END AS o_suffix,
       CAST(9007199254740993 + o_orderkey AS VARCHAR) AS o_big,
       CASE WHEN year(o_orderdate) <= 1997 THEN o_orderstatus END AS o_old
FROM orders
""")
O.cte("shard_inv", "SELECT y.shard_year, c.name AS \"column\" FROM (SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS shard_year FROM orders) y, "
      "(VALUES " + ", ".join(f"('{c}')" for c in SHARD_COLS) + ") c(name) "
      "WHERE NOT (c.name = 'o_orderpriority' AND y.shard_year <= 1996) AND NOT (c.name = 'o_old' AND y.shard_year > 1997)")
O.cte("shard_long", """
SELECT shard_year, "column", value FROM shard_text UNPIVOT INCLUDE NULLS (value FOR "column" IN (""" + ", ".join(SHARD_COLS) + """))
WHERE (shard_year, "column") IN (SELECT (shard_year, "column") FROM shard_inv)
""")
O.cte("shard_vc", 'SELECT shard_year, "column", value, COUNT(*) AS n FROM shard_long GROUP BY ALL')
O.cte("shard_stats0", """
SELECT shard_year, "column", CAST(SUM(n) AS BIGINT) AS rows,
       CAST(SUM(CASE WHEN value IS NULL THEN n ELSE 0 END) AS BIGINT) AS null_count, COUNT(value) AS distinct_count,
       CAST(SUM(CASE WHEN regexp_full_match(value, '[+-]?[0-9]+') AND TRY_CAST(value AS BIGINT) IS NOT NULL THEN n ELSE 0 END) AS BIGINT) AS _n_int,
       CAST(SUM(CASE WHEN regexp_full_match(value, '[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?') THEN n ELSE 0 END) AS BIGINT) AS _n_num,
       CAST(SUM(CASE WHEN regexp_full_match(value, '[+-]?0[0-9]+') THEN n ELSE 0 END) AS BIGINT) AS _n_padded,
       MIN(TRY_CAST(value AS DOUBLE)) AS _min, MAX(TRY_CAST(value AS DOUBLE)) AS _max
FROM shard_vc GROUP BY ALL
""")
O.cte("shard_stats", """
SELECT shard_year, "column", rows, null_count, round(CAST(null_count AS DOUBLE) * 100.0 / rows, 4) AS null_pct, distinct_count,
       CASE WHEN rows - null_count = 0 THEN 'float64' WHEN _n_int = rows - null_count AND null_count = 0 THEN 'int64'
            WHEN _n_num = rows - null_count THEN 'float64' ELSE 'object' END AS dtype,
       CASE WHEN rows - null_count = 0 THEN 'null' WHEN _n_padded > 0 THEN 'string' WHEN _n_int = rows - null_count THEN 'long'
            WHEN _n_num = rows - null_count THEN 'double' ELSE 'string' END AS logical_type,
       _min, _max
FROM shard_stats0
""")
O.cte("shard_types", """
SELECT i.shard_year, i."column", s.dtype, s.logical_type FROM shard_inv i
LEFT JOIN shard_stats s ON i.shard_year = s.shard_year AND i."column" = s."column"
""")
PROFILE = ["shard_text", "shard_inv", "shard_long", "shard_vc", "shard_stats0", "shard_stats"]


def _figures(spark, sf):
    """Nulls, ranges and types: no value is shuffled."""
    return P.type_evidence(fx.shard_text(spark, sf), Y, fx.shard_inventory(spark, sf))


def _value_counts(spark, sf):
    """Written once, because distinct counts and top values both read it."""
    return materialize(P.value_counts(fx.shard_text(spark, sf), Y, fx.shard_inventory(spark, sf)), "value-counts")


@register("profile_nulls", O.with_(PROFILE, 'SELECT shard_year, "column", rows, null_count, null_pct FROM shard_stats'))
def q_profile_nulls(spark, sf):
    return _figures(spark, sf).select(Y, "column", "rows", "null_count", "null_pct")


@register("profile_distinct", O.with_(PROFILE, 'SELECT shard_year, "column", distinct_count FROM shard_stats'))
def q_profile_distinct(spark, sf):
    vc = P.value_counts(fx.shard_text(spark, sf), Y, fx.shard_inventory(spark, sf))
    return P.column_stats(vc, Y).select(Y, "column", "distinct_count")


ORACLE_TOP = O.with_(PROFILE, """
SELECT shard_year, "column", value, n, CAST(rank AS INTEGER) AS rank FROM (
  SELECT v.*, row_number() OVER (PARTITION BY v.shard_year, v."column" ORDER BY v.n DESC, v.value ASC) AS rank
  FROM shard_vc v JOIN shard_stats s ON v.shard_year = s.shard_year AND v."column" = s."column"
  WHERE s.distinct_count < 20 AND v.value IS NOT NULL) WHERE rank <= 10""")


@register("profile_top_values", ORACLE_TOP)
def q_profile_top_values(spark, sf):
    # both readers of the value counts share one exchange
    vc = P.value_counts(fx.shard_text(spark, sf), Y, fx.shard_inventory(spark, sf))
    return P.top_values(vc, P.column_stats(vc, Y), Y)


@register("profile_top_values_at_scale", ORACLE_TOP)
def q_profile_top_values_at_scale(spark, sf):
    text, inv = fx.shard_text(spark, sf), fx.shard_inventory(spark, sf)
    return P.profile_shards(text, Y, inv, exact_distinct=False)[1]


@register("profile_min_max", O.with_(PROFILE, """
SELECT shard_year, "column", CASE WHEN dtype <> 'object' THEN _min END AS min, CASE WHEN dtype <> 'object' THEN _max END AS max
FROM shard_stats"""))
def q_profile_min_max(spark, sf):
    return _figures(spark, sf).select(Y, "column", "min", "max")


@register("profile_dtype", O.with_(PROFILE, 'SELECT shard_year, "column", dtype, logical_type FROM shard_stats'))
def q_profile_dtype(spark, sf):
    return _figures(spark, sf).select(Y, "column", "dtype", "logical_type")


@register("shard_year", """
SELECT o_orderkey, 'ORDERS_PHILADELPHIA_' || CAST(year(o_orderdate) AS VARCHAR) || '.csv' AS file_name,
       CAST(CASE WHEN year(o_orderdate) BETWEEN 1993 AND 1997 THEN year(o_orderdate) END AS INTEGER) AS year FROM orders""")
def q_shard_year(spark, sf):
    """The year is parsed from a file name; years that aren't configured give none."""
    from roadbook.sources.shards import year_from_name
    o = fx.table(spark, sf, "orders")
    name = F.concat(F.lit("ORDERS_PHILADELPHIA_"), F.year("o_orderdate").cast("string"), F.lit(".csv"))
    return o.select("o_orderkey", name.alias("file_name")).withColumn("year", year_from_name("file_name", 1993, 1997))


@register("schema_matrix", O.with_(["shard_inv"], """
SELECT "column", string_agg(CAST(shard_year AS VARCHAR), ',' ORDER BY CAST(shard_year AS VARCHAR)) AS years_present,
       COUNT(DISTINCT shard_year) AS n_years FROM shard_inv GROUP BY 1"""))
def q_schema_matrix(spark, sf):
    return P.schema_matrix(fx.shard_inventory(spark, sf), Y)


def _inv_types(spark, sf):
    return P.inventory_types(fx.shard_inventory(spark, sf), _figures(spark, sf), Y)


O.cte("dtype_changes", """
SELECT "column", COUNT(DISTINCT dtype) AS n_dtypes,
       string_agg(CAST(shard_year AS VARCHAR) || ':' || dtype, ',' ORDER BY shard_year, dtype) AS dtypes_by_year
FROM shard_types GROUP BY 1 HAVING COUNT(DISTINCT dtype) > 1
""")


@register("schema_dtype_changes", O.with_(PROFILE + ["shard_types", "dtype_changes"], "SELECT * FROM dtype_changes"))
def q_schema_dtype_changes(spark, sf):
    return P.schema_dtype_changes(_inv_types(spark, sf), Y)


O.cte("added", """
SELECT "column", MIN(shard_year) AS first_year FROM shard_inv GROUP BY 1
HAVING MIN(shard_year) <> (SELECT MIN(shard_year) FROM shard_inv)
""")
O.cte("removed", """
SELECT "column", MAX(shard_year) AS last_year FROM shard_inv GROUP BY 1
HAVING MAX(shard_year) <> (SELECT MAX(shard_year) FROM shard_inv)
""")


@register("schema_added", O.with_(["shard_inv", "added"], "SELECT * FROM added"))
def q_schema_added(spark, sf):
    return P.schema_added(fx.shard_inventory(spark, sf), Y)


@register("schema_removed", O.with_(["shard_inv", "removed"], "SELECT * FROM removed"))
def q_schema_removed(spark, sf):
    return P.schema_removed(fx.shard_inventory(spark, sf), Y)


@register("schema_issues", O.with_(PROFILE + ["shard_types", "dtype_changes", "added", "removed"], """
SELECT 'ORDERS' AS category, issue, string_agg("column", ',' ORDER BY "column") AS columns, COUNT(*) AS n_columns FROM (
  SELECT 'dtype_changes' AS issue, "column" FROM dtype_changes
  UNION ALL SELECT 'added_columns', "column" FROM added
  UNION ALL SELECT 'removed_columns', "column" FROM removed) GROUP BY issue"""))
def q_schema_issues(spark, sf):
    return P.schema_issues(_inv_types(spark, sf), "ORDERS", Y)


@register("missing_summary", O.with_(["crash"], """
SELECT name AS "column", missing, (SELECT COUNT(*) FROM crash) AS rows
FROM (UNPIVOT (SELECT COUNT(*) - COUNT(COLUMNS(*)) FROM crash) ON COLUMNS(*) INTO NAME name VALUE missing) WHERE missing > 0"""))
def q_missing_summary(spark, sf):
    return P.missing_summary(fx.crash(spark, sf))

# ------------------------------------------------------------- harmonization


O.cte("targets", """
SELECT "column", CASE WHEN len(lt) = 0 THEN 'string' WHEN len(lt) = 1 THEN lt[1]
                      WHEN len(lt) = 2 AND list_contains(lt, 'long') AND list_contains(lt, 'double') THEN 'double'
                      ELSE 'string' END AS target_type
FROM (SELECT "column", list_distinct(list(logical_type) FILTER (WHERE logical_type <> 'null')) AS lt FROM shard_types GROUP BY 1)
""")
O.cte("targets_strict", """
SELECT "column", CASE WHEN COUNT(DISTINCT dtype) > 1 THEN 'string' WHEN bool_or(dtype = 'int64') THEN 'long'
                      WHEN bool_or(dtype = 'float64') THEN 'double' ELSE 'string' END AS target_type
FROM shard_types GROUP BY 1
""")


@register("harmonize_type_conflict", O.with_(PROFILE + ["shard_types", "targets"], "SELECT * FROM targets"))
def q_harmonize_type_conflict(spark, sf):
    return H.target_types(_inv_types(spark, sf))


@register("harmonize_type_conflict_strict", O.with_(PROFILE + ["shard_types", "targets_strict"], "SELECT * FROM targets_strict"))
def q_harmonize_type_conflict_strict(spark, sf):
    return H.target_types(_inv_types(spark, sf), pandas_dtypes=True)


HARMONIZED = """
SELECT shard_year AS DATA_YEAR,
       CAST(o_big AS BIGINT) AS o_big, o_code, o_custkey_t AS o_custkey, o_old, o_orderdate, o_orderkey_t AS o_orderkey, o_orderpriority,
       o_orderstatus, o_suffix, o_totalprice
FROM (SELECT *, CASE WHEN regexp_full_match(o_custkey, '[+-]?[0-9]+') THEN TRY_CAST(o_custkey AS BIGINT) END AS o_custkey_t,
                CASE WHEN regexp_full_match(o_orderkey, '[+-]?[0-9]+') THEN TRY_CAST(o_orderkey AS BIGINT) END AS o_orderkey_t
      FROM shard_text)"""


@register("harmonize_all_years", O.with_(["shard_text"], HARMONIZED))
def q_harmonize_all_years(spark, sf):
    h = H.harmonize_text_shards(fx.shard_text(spark, sf), fx.shard_inventory(spark, sf), Y)
    return h.drop("PROCESSING_DATE")


DATED = ["crn", "happened", "reported", "closed", "amount"]
O.cte("dated_text", """
SELECT CAST(year(d) AS INTEGER) AS shard_year, CAST(o_orderkey AS VARCHAR) AS crn,
       CASE WHEN o_orderkey % 17 = 0 THEN NULL WHEN o_orderkey % 19 = 0 THEN ''
            WHEN year(d) % 4 = 0 THEN strftime(d, '%Y-%m-%d') WHEN year(d) % 4 = 1 THEN strftime(d, '%m/%d/%Y')
            WHEN year(d) % 4 = 2 THEN strftime(d, '%d.%m.%Y') ELSE strftime(d, '%Y%m%d') END AS happened,
       CASE WHEN year(d) = 1995 THEN ' ' WHEN year(d) % 2 = 0 THEN strftime(d + 1, '%d/%m/%Y')
            ELSE strftime(d + 1, '%Y-%m-%d') || ' 08:30:00' END AS reported,
       CASE WHEN o_orderkey % 200 = 0 THEN CAST(year(d) AS VARCHAR) || '-02-30' ELSE strftime(d + 2, '%Y-%m-%d') END AS closed,
       CAST(o_orderkey % 5000 AS VARCHAR) AS amount
FROM (SELECT *, CAST(o_orderdate AS DATE) AS d FROM orders)
""")
O.cte("dated_long", f"""
SELECT shard_year, "column", trim(value) AS value FROM dated_text UNPIVOT INCLUDE NULLS (value FOR "column" IN ({", ".join(DATED)}))
""")


def _dated_inventory(spark, sf):
    years = fx.table(spark, sf, "orders").select(F.year("o_orderdate").alias(Y)).distinct()
    return years.select(Y, F.explode(F.array(*[F.lit(c) for c in DATED])).alias("column"))


# strptime reads one-digit days, months and shorter years too, so texts are held to their shape first
_SHAPES = [("yyyy-MM-dd", "[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}( .*)?", "%Y-%m-%d"), ("yyyy/MM/dd", "[0-9]{4}/[0-9]{1,2}/[0-9]{1,2}( .*)?", "%Y/%m/%d"),
           ("MM/dd/yyyy", "[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}( .*)?", "%m/%d/%Y"), ("dd/MM/yyyy", "[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}( .*)?", "%d/%m/%Y"),
           ("MM-dd-yyyy", "[0-9]{1,2}-[0-9]{1,2}-[0-9]{4}( .*)?", "%m-%d-%Y"), ("dd.MM.yyyy", "[0-9]{1,2}[.][0-9]{1,2}[.][0-9]{4}( .*)?", "%d.%m.%Y"),
           ("yyyyMMdd", "(19|20)[0-9]{6}", "%Y%m%d")]


@register("profile_date_formats", O.with_(["dated_text", "dated_long"], " UNION ALL ".join(f"""
SELECT shard_year, "column", '{name}' AS format, COUNT(*) FILTER (WHERE value <> '') AS filled,
       COUNT(*) FILTER (WHERE regexp_full_match(value, '{shape}') AND try_strptime(split_part(value, ' ', 1), '{parse}') IS NOT NULL) AS fits
FROM dated_long GROUP BY 1, 2""" for name, shape, parse in _SHAPES)))
def q_profile_date_formats(spark, sf):
    """P5 on request: how many values of each shard and column are dates in each format."""
    return DT.date_evidence(fx.dated_text(spark, sf), Y, _dated_inventory(spark, sf))


@register("harmonize_dates", O.with_(["dated_text"], """
SELECT shard_year AS DATA_YEAR, CAST(amount AS BIGINT) AS amount, closed, CAST(crn AS BIGINT) AS crn,
       CAST(CASE shard_year % 4 WHEN 0 THEN try_strptime(happened, '%Y-%m-%d') WHEN 1 THEN try_strptime(happened, '%m/%d/%Y')
            WHEN 2 THEN try_strptime(happened, '%d.%m.%Y') ELSE try_strptime(happened, '%Y%m%d') END AS DATE) AS happened,
       CAST(CASE WHEN shard_year = 1995 THEN NULL WHEN shard_year % 2 = 0 THEN strptime(reported, '%d/%m/%Y')
                 ELSE strptime(reported, '%Y-%m-%d %H:%M:%S') END AS DATE) AS reported
FROM dated_text"""))
def q_harmonize_dates(spark, sf):
    """H2, H3 and H5 with dates: the format differs by shard; a column with a value that is no date stays text."""
    return DT.harmonize_with_dates(fx.dated_text(spark, sf), _dated_inventory(spark, sf), Y).drop("PROCESSING_DATE")


LATE = 1996       # the year whose shard gets late rows after the first run
O.cte("shard_late", f"SELECT * FROM shard_text UNION ALL SELECT * REPLACE ('late' AS o_orderstatus) FROM shard_text WHERE shard_year = {LATE}")


@register("harmonize_changed_years", O.with_(["shard_text", "shard_late"], f"""
SELECT *, CASE WHEN DATA_YEAR = {LATE} THEN 'run-2' ELSE 'run-1' END AS PROCESSING_DATE
FROM ({HARMONIZED.replace("FROM shard_text)", "FROM shard_late)")})"""))
def q_harmonize_changed_years(spark, sf):
    """Three runs over landed shards: all years, late rows of one year, nothing new."""
    from roadbook.plans.registry_datasets import _scratch
    from roadbook.sources import increments as I
    root, years = _landed_shards(spark, sf)
    out = _scratch(spark, "harmonized")
    I.harmonize_changed(spark, root, "ORDERS", out, years, processing_date="run-1")
    columns = [c for c in SHARD_COLS if c != "o_orderpriority"]         # of that year, as landed
    late = fx.shard_text(spark, sf).filter(F.col(Y) == LATE).withColumn("o_orderstatus", F.lit("late")).select(*columns)
    late.write.mode("append").option("header", True).option("escape", '"').csv(f"{root}/ORDERS_{LATE}.csv")
    for day in ("run-2", "run-3"):
        I.harmonize_changed(spark, root, "ORDERS", out, years, processing_date=day)
    return I.read_harmonized(spark, out)


def _all_years(spark, sf):
    """One row of sketches per column from stored rows per shard and column."""
    stored = materialize(K.shard_sketches(fx.shard_text(spark, sf), Y, fx.shard_inventory(spark, sf)), "sketches", partition_by=[Y])
    return K.merged(stored, ["column"])


O.cte("column_vc", 'SELECT "column", value, CAST(SUM(n) AS BIGINT) AS n FROM shard_vc GROUP BY ALL')
O.cte("column_stats0", O.CTES["shard_stats0"].replace("shard_year, ", "").replace("shard_vc", "column_vc"))
O.cte("column_stats", O.CTES["shard_stats"].replace("shard_year, ", "").replace("shard_stats0", "column_stats0"))
ALL_YEARS = PROFILE[:4] + ["column_vc", "column_stats0", "column_stats"]


@register("profile_all_years", O.with_(ALL_YEARS, """
SELECT "column", rows, null_count, null_pct, CASE WHEN distinct_count < 20 THEN distinct_count END AS few_values, dtype, logical_type,
       CASE WHEN dtype <> 'object' THEN _min END AS min, CASE WHEN dtype <> 'object' THEN _max END AS max FROM column_stats"""))
def q_profile_all_years(spark, sf):
    few = F.when(F.col("distinct_exact"), F.col("distinct_count")).alias("few_values")
    return K.figures(_all_years(spark, sf)).select("column", "rows", "null_count", "null_pct", few, "dtype", "logical_type", "min", "max")


@register("profile_top_values_all_years", O.with_(ALL_YEARS, """
SELECT "column", value, n, CAST(rank AS INTEGER) AS rank FROM (
  SELECT v.*, row_number() OVER (PARTITION BY v."column" ORDER BY v.n DESC, v.value ASC) AS rank
  FROM column_vc v JOIN column_stats s ON v."column" = s."column"
  WHERE s.distinct_count < 20 AND v.value IS NOT NULL) WHERE rank <= 10"""))
def q_profile_top_values_all_years(spark, sf):
    return K.top_values(_all_years(spark, sf))


@register("add_lineage", O.with_(["crash"], "SELECT CRN, 2024 AS DATA_YEAR, '2024-05-06T07:08:09' AS PROCESSING_DATE FROM crash"))
def q_add_lineage(spark, sf):
    return H.add_lineage(fx.crash(spark, sf).select("CRN"), year=2024, processing_date="2024-05-06T07:08:09")


def _typed_parts(spark, sf):
    o = fx.table(spark, sf, "orders")
    y = F.year("o_orderdate")
    early = o.filter(y <= 1996).drop("o_orderpriority")
    late = o.filter(y > 1996).withColumn(
        "o_totalprice", F.when(y.isin(1997, 1998), F.format_number("o_totalprice", 2))
        .otherwise(F.col("o_totalprice").cast("string")))
    return early, late


@register("harmonize_union", """
SELECT o_custkey, o_orderdate, o_orderkey, o_orderpriority, o_orderstatus, o_totalprice FROM (
  SELECT o_custkey, o_orderdate, o_orderkey, NULL::VARCHAR AS o_orderpriority, o_orderstatus,
         CAST(o_totalprice AS VARCHAR) AS o_totalprice FROM orders WHERE year(o_orderdate) <= 1996
  UNION ALL
  SELECT o_custkey, o_orderdate, o_orderkey, o_orderpriority, o_orderstatus,
         CASE WHEN year(o_orderdate) IN (1997, 1998) THEN format('{:,.2f}', o_totalprice) ELSE CAST(o_totalprice AS VARCHAR) END
  FROM orders WHERE year(o_orderdate) > 1996)""")
def q_harmonize_union(spark, sf):
    early, late = _typed_parts(spark, sf)
    return H.harmonize_union(early, late)


@register("master_schema", O.with_(PROFILE + ["shard_types"], """
SELECT "column", dtype FROM shard_types WHERE shard_year = (SELECT MAX(shard_year) FROM shard_types)"""))
def q_master_schema(spark, sf):
    return H.master_schema(_inv_types(spark, sf), Y)


LONG = "CASE WHEN regexp_full_match({0}, '[+-]?[0-9]+') THEN TRY_CAST({0} AS BIGINT) END AS {0}"


@register("cast_to_master", O.with_(["shard_text"], "SELECT shard_year, " + ", ".join(LONG.format(c) for c in ("o_orderkey", "o_custkey", "o_code", "o_big")) + """,
       o_orderstatus, CASE WHEN isnan(TRY_CAST(o_totalprice AS DOUBLE)) THEN NULL ELSE TRY_CAST(o_totalprice AS DOUBLE) END AS o_totalprice,
       o_orderdate, o_orderpriority, o_suffix, o_old
FROM shard_text"""))
def q_cast_to_master(spark, sf):
    text = fx.shard_text(spark, sf)
    master = {r["column"]: r["dtype"] for r in H.master_schema(_inv_types(spark, sf), Y).collect()}
    return H.cast_to_master(text, master)


@register("standardize_helmet", O.with_(["cycle"], """
SELECT CRN, CASE WHEN upper(trim(HELMET_IND)) IN ('Y', 'N', 'U') THEN upper(trim(HELMET_IND)) ELSE 'U' END AS HELMET_IND FROM cycle"""))
def q_standardize_helmet(spark, sf):
    return H.standardize_helmet(fx.cycle(spark, sf)).select("CRN", "HELMET_IND")


@register("standardize_helmet_invalid", O.with_(["cycle"], """
SELECT COUNT(*) FILTER (WHERE upper(trim(HELMET_IND)) IS NOT NULL AND upper(trim(HELMET_IND)) <> ''
                        AND upper(trim(HELMET_IND)) NOT IN ('Y', 'N', 'U')) AS invalid_helmet FROM cycle"""))
def q_standardize_helmet_invalid(spark, sf):
    return H.helmet_invalid_count(fx.cycle(spark, sf))


@register("rename_columns", O.with_(["crash"], """
SELECT * EXCLUDE (DEC_LATITUDE, DEC_LONGITUDE), DEC_LATITUDE AS DEC_LAT, DEC_LONGITUDE AS DEC_LONG FROM crash"""))
def q_rename_columns(spark, sf):
    return H.rename_columns(fx.crash(spark, sf), {"DEC_LATITUDE": "DEC_LAT", "DEC_LONGITUDE": "DEC_LONG"})


@register("rename_columns_coalesce", O.with_(["crash"], """
SELECT * EXCLUDE (DAY_OF_WEEK), coalesce(DAY_OF_WEEK, CAST(HOUR_OF_DAY % 7 + 1 AS INTEGER)) AS DAY_OF_WEEK FROM crash"""))
def q_rename_columns_coalesce(spark, sf):
    c = fx.crash(spark, sf).withColumn("DAY_OF_WEEK_OLD", (F.col("HOUR_OF_DAY") % 7 + 1).cast("int"))
    return H.rename_columns(c, {"DAY_OF_WEEK_OLD": "DAY_OF_WEEK"})


@register("sorted_column_order", O.with_(["crash"], "SELECT * FROM crash"))
def q_sorted_column_order(spark, sf):
    return H.sorted_columns(fx.crash(spark, sf))

# ---------------------------------------------------------------- sources


@register("scan_parquet", "SELECT * FROM orders")
def q_scan_parquet(spark, sf):
    from roadbook.sources.sinks import read_parquet
    return read_parquet(spark, f"{sf.rstrip('/')}/orders.parquet")





@register("union_observations", O.with_(["wx_daily", "wx_long"], "SELECT * FROM wx_long"))
def q_union_observations(spark, sf):
    from roadbook.sources.observations import union_observations
    long = fx.weather_long(spark, sf)
    # one frame per half of the calendar, with unlike columns, as two downloads leave them
    first = long.filter(F.month("date") <= 6)
    return union_observations([first, long.filter(F.month("date") > 6).drop("obs_id")]).select("date", "datatype", "value")


@register("shard_completeness", """
WITH expected AS (
  SELECT y.year, c.category FROM (SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS year FROM orders
                                  UNION SELECT DISTINCT CAST(year(ts) AS INTEGER) FROM events) y,
       (VALUES ('CRASH'), ('CYCLE'), ('PERSON')) c(category)),
observed AS (
  SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS year, 'CRASH' AS category FROM orders
  UNION SELECT DISTINCT CAST(year(l_shipdate) AS INTEGER), 'PERSON' FROM lineitem
  UNION SELECT DISTINCT CAST(year(l_shipdate) AS INTEGER), 'CYCLE' FROM lineitem
        WHERE l_linenumber = 1 AND l_quantity < 10 AND l_returnflag = 'N' AND l_linestatus = 'F')
SELECT e.year, e.category FROM expected e ANTI JOIN observed o ON e.year = o.year AND e.category = o.category""")
def q_shard_completeness(spark, sf):
    from roadbook.sources.shards import missing_categories
    o = fx.table(spark, sf, "orders").select(F.year("o_orderdate").alias("year"), F.lit("CRASH").alias("category"))
    li = fx.table(spark, sf, "lineitem")
    p = li.select(F.year("l_shipdate").alias("year"), F.lit("PERSON").alias("category"))
    c = li.filter((F.col("l_linenumber") == 1) & (F.col("l_quantity") < 10) & (F.col("l_returnflag") == "N")
                  & (F.col("l_linestatus") == "F")).select(F.year("l_shipdate").alias("year"), F.lit("CYCLE").alias("category"))
    observed = o.unionByName(p).unionByName(c)
    # every year some source reports data for is expected to have all categories
    years = o.select("year").unionByName(fx.table(spark, sf, "events").select(F.year("ts").alias("year"))).distinct()
    return missing_categories(observed, years, ["CRASH", "CYCLE", "PERSON"])


@register("sink_text_summary", O.with_(PROFILE + ["shard_types", "dtype_changes", "added", "removed"], """
SELECT 'ORDERS: ' || issue || ' (' || CAST(COUNT(*) AS VARCHAR) || '): ' || string_agg("column", ',' ORDER BY "column") AS value
FROM (SELECT 'dtype_changes' AS issue, "column" FROM dtype_changes
      UNION ALL SELECT 'added_columns', "column" FROM added
      UNION ALL SELECT 'removed_columns', "column" FROM removed) GROUP BY issue"""))
def q_sink_text_summary(spark, sf):
    import os
    import uuid

    from roadbook.session import checkpoint_dir
    from roadbook.sources import sinks
    issues = P.schema_issues(_inv_types(spark, sf), "ORDERS", Y)
    path = os.path.join(checkpoint_dir(spark), f"sink-text-{uuid.uuid4().hex[:12]}")
    sinks.write_text_summary(issues, path)
    return spark.read.text(path)


def _landed_shards(spark, sf):
    """Write the ORDERS text shards as CSV folders under the checkpoint folder; return (root, years)."""
    import os
    import uuid

    from roadbook.session import checkpoint_dir
    from roadbook.sources import shards as S
    root = os.path.join(checkpoint_dir(spark), f"landed-{uuid.uuid4().hex[:12]}")
    inv = fx.shard_inventory(spark, sf)
    S.write_text_shards(fx.shard_text(spark, sf), inv, root, "ORDERS")
    years = sorted(r[0] for r in inv.select(Y).distinct().collect())
    return root, years


@register("shard_discovery", O.with_(["shard_text"], """
SELECT DISTINCT 'ORDERS_' || CAST(shard_year AS VARCHAR) || '.csv' AS file_name, shard_year AS year FROM shard_text"""))
def q_shard_discovery(spark, sf):
    from roadbook.sources import shards as S
    root, years = _landed_shards(spark, sf)
    found = S.shard_discovery(S.list_files(spark, root, "*.csv"), "ORDERS", min(years), max(years))
    return found.select("file_name", "year").distinct()


@register("scan_category_csv", O.with_(["shard_text"], "SELECT * FROM shard_text"))
def q_scan_category_csv(spark, sf):
    from roadbook.sources import shards as S
    root, years = _landed_shards(spark, sf)
    matched = S.match_shards(S.list_files(spark, root, "*.csv"), ["ORDERS"], years)
    text, _ = S.read_text_shards(spark, matched)
    return text.select(Y, *[c for c in fx.SHARD_COLUMNS])


@register("scan_sample", O.with_(["shard_text"], """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY shard_year ORDER BY CAST(o_orderkey AS BIGINT)) AS rn FROM shard_text)
WHERE rn <= 100"""))
def q_scan_sample(spark, sf):
    """First 100 rows of each landed yearly shard (file order = order key order in these tables)."""
    from roadbook.sources import shards as S
    root, years = _landed_shards(spark, sf)
    matched = S.match_shards(S.list_files(spark, root, "*.csv"), ["ORDERS"], years)
    sample = S.scan_sample(spark, [r["path"] for r in matched.select("path").collect()], n=100)
    return sample.select(S.year_from_name(F.col("_file"), min(years), max(years)).alias(Y), *fx.SHARD_COLUMNS)


def _zipped_orders(spark, sf):
    """(path, content): ZIP archives of a bounded number of orders each, all with one member name per year."""
    def archive(pdf):
        import io
        import zipfile

        import pandas as pd
        year, chunk = pdf["year"].iloc[0], pdf["chunk"].iloc[0]
        data = io.BytesIO()
        with zipfile.ZipFile(data, "w", zipfile.ZIP_DEFLATED) as z:
            z.writestr(f"ORDERS_{year}.csv", pdf[["o_orderkey", "o_custkey", "note"]].to_csv(index=False))
        return pd.DataFrame([[f"orders_{year}_{chunk}.zip", data.getvalue()]], columns=["path", "content"])

    o = fx.table(spark, sf, "orders")
    rows = o.select(F.year("o_orderdate").alias("year"), F.floor(F.col("o_orderkey") / 50_000).alias("chunk"), "o_orderkey", "o_custkey",
                    F.concat(F.lit('a "quoted"\nnote, '), F.col("o_orderstatus")).alias("note"))
    return rows.groupBy("year", "chunk").applyInPandas(archive, "path string, content binary")


@register("unzip_shards", """
SELECT 'orders_' || CAST(year(o_orderdate) AS VARCHAR) || '_' || CAST(o_orderkey // 50000 AS VARCHAR) || '.zip' AS archive,
       'ORDERS_' || CAST(year(o_orderdate) AS VARCHAR) || '.csv' AS member, CAST(o_orderkey AS VARCHAR) AS o_orderkey,
       CAST(o_custkey AS VARCHAR) AS o_custkey, 'a "quoted"' || chr(10) || 'note, ' || o_orderstatus AS note FROM orders""")
def q_unzip_shards(spark, sf):
    from roadbook.sources.archives import expand_content, member_frames
    rows, _, _ = member_frames(expand_content(_zipped_orders(spark, sf)))
    return rows.select("archive", "member", "o_orderkey", "o_custkey", "note")


def _landed_archives(spark, sf):
    """The folder of archives written by the executors, each with a damaged second member where 3 divides the year."""
    from roadbook.plans.registry_datasets import _scratch
    folder = _scratch(spark, "archives")

    def land(batches):
        import io
        import zipfile

        import pandas as pd

        from roadbook.sources.stores import located
        for pdf in batches:
            for name, content in zip(pdf["path"], pdf["content"], strict=True):
                year = int(name.split("_")[1])
                data = io.BytesIO(content)
                with zipfile.ZipFile(data, "a") as z:
                    z.writestr(f"NOTES_{year}.csv", "note\nfirst\nsecond\n")
                raw = bytearray(data.getvalue())
                if year % 3 == 0:
                    raw[raw.index(b"second")] ^= 1
                system, own = located(folder)
                system.create_dir(own)
                with system.open_output_stream(f"{own}/{name}") as f:
                    f.write(bytes(raw))
            yield pd.DataFrame({"path": pdf["path"]})

    _zipped_orders(spark, sf).mapInPandas(land, "path string").count()
    return folder


@register("unzip_members", """
SELECT 'orders_' || CAST(year AS VARCHAR) || '_' || CAST(chunk AS VARCHAR) || '.zip' AS archive, member,
       CASE WHEN member LIKE 'NOTES%' AND year % 3 = 0 THEN 0 ELSE n END AS records, member LIKE 'NOTES%' AND year % 3 = 0 AS bad
FROM (SELECT year, chunk, 'ORDERS_' || CAST(year AS VARCHAR) || '.csv' AS member, n FROM (
        SELECT year(o_orderdate) AS year, o_orderkey // 50000 AS chunk, COUNT(*) AS n FROM orders GROUP BY ALL)
      UNION ALL SELECT DISTINCT year(o_orderdate), o_orderkey // 50000, 'NOTES_' || CAST(year(o_orderdate) AS VARCHAR) || '.csv', 2 FROM orders)""")
def q_unzip_members(spark, sf):
    """S8 over landed archives, a task per member: records and faults of each member."""
    from roadbook.sources.archives import expand_archives, member_frames
    lines = materialize(expand_archives(spark, _landed_archives(spark, sf)), "archive-lines")
    rows, _, errors = member_frames(lines, materialize_lines=False)
    name = F.element_at(F.split("archive", "/"), -1).alias("archive")
    good = rows.groupBy(name, "member").agg(F.count("*").alias("records")).withColumn("bad", F.lit(False))
    return good.unionByName(errors.select(name, "member", F.lit(0).cast("long").alias("records"), F.lit(True).alias("bad")))
