"""Quality checks (Q1-Q12): row flags plus one-pass check counters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadbook.constants import BOUNDS, COORD_DECIMALS, HELMET_UNKNOWN, HELMET_VALID, MISCODED_COUNTY
from roadbook.functions.coords import decimal_places
from roadbook.functions.numeric import is_true, not_equal_or_missing

QC_LAT, QC_LON = "DEC_LAT", "DEC_LONG"


def _pct(n, total):
    return F.when(total > 0, n.cast("double") * 100.0 / total)


def missing_coords_expr(lat=QC_LAT, lon=QC_LON):
    return F.col(lat).isNull() | F.col(lon).isNull()


def out_of_bounds_expr(lat=QC_LAT, lon=QC_LON, bounds=BOUNDS):
    la, lo = F.col(lat), F.col(lon)
    oob = (la < bounds["lat_min"]) | (la > bounds["lat_max"]) | (lo < bounds["lon_min"]) | (lo > bounds["lon_max"])
    return ~missing_coords_expr(lat, lon) & is_true(oob)


def qc_missing_coords(df: DataFrame, lat: str = QC_LAT, lon: str = QC_LON) -> DataFrame:
    """Q1: count and percent of rows missing either coordinate."""
    n = F.count_if(missing_coords_expr(lat, lon))
    total = F.count(F.lit(1))
    return df.agg(total.alias("total_records"), n.alias("missing_coordinates"),
                  F.round(_pct(n, total), 2).alias("missing_pct"))


def qc_geo_valid(df: DataFrame, lat: str = QC_LAT, lon: str = QC_LON, bounds: dict = BOUNDS) -> DataFrame:
    """Q2: ``geo_valid`` = both coordinates present and inside the box (inclusive)."""
    return df.withColumn("geo_valid", ~missing_coords_expr(lat, lon) & ~out_of_bounds_expr(lat, lon, bounds))


def qc_geo_bounds_report(df: DataFrame, lat: str = QC_LAT, lon: str = QC_LON, bounds: dict = BOUNDS) -> DataFrame:
    """Q2 counters: out-of-bounds count and percent, valid and invalid rows."""
    total = F.count(F.lit(1))
    oob = F.count_if(out_of_bounds_expr(lat, lon, bounds))
    valid = F.count_if(~missing_coords_expr(lat, lon) & ~out_of_bounds_expr(lat, lon, bounds))
    return df.agg(total.alias("total_records"), oob.alias("out_of_bounds"),
                  F.round(_pct(oob, total), 2).alias("out_of_bounds_pct"),
                  valid.alias("valid_records"), (total - valid).alias("invalid_records"))


def qc_county_distribution(df: DataFrame, county: str = "COUNTY") -> DataFrame:
    """Q3: records per county code, NULL excluded."""
    return (df.filter(F.col(county).isNotNull())
            .groupBy(F.col(county).cast("string").alias("county")).agg(F.count(F.lit(1)).alias("n")))


def all_one_code(df: DataFrame, county: str = "COUNTY", code: int = MISCODED_COUNTY):
    """Scalar subquery: the only non-null county value in the table is ``code``."""
    v = F.col(county).cast("string")
    return df.select((F.count_distinct(v) == 1) & is_true(F.min(v).try_cast("double") == float(code))).scalar()


def qc_county_miscoded(df: DataFrame, county: str = "COUNTY", code: int = MISCODED_COUNTY) -> DataFrame:
    """Q4: ``county_miscoded`` is true on every row when the table's only county is ``code``.

    A whole-table fact, computed once as a scalar subquery (no join, no
    collect); the column is always present (false otherwise).
    """
    if county not in df.columns:
        return df.withColumn("county_miscoded", F.lit(False))
    return df.withColumn("county_miscoded", F.coalesce(all_one_code(df, county, code), F.lit(False)))


def qc_precision(df: DataFrame, lat: str = QC_LAT, lon: str = QC_LON) -> DataFrame:
    """Q5: range of decimal places of each coordinate's text form."""
    lp, op = decimal_places(lat), decimal_places(lon)
    return df.agg(F.min(lp).alias("lat_min_decimals"), F.max(lp).alias("lat_max_decimals"),
                  F.min(op).alias("lon_min_decimals"), F.max(op).alias("lon_max_decimals"))


def qc_round_coords(df: DataFrame, lat: str = QC_LAT, lon: str = QC_LON, decimals: int = COORD_DECIMALS) -> DataFrame:
    """Q6: ``<col>_standardized`` = coordinate rounded to 6 places."""
    return df.withColumns({f"{lat}_standardized": F.round(lat, decimals), f"{lon}_standardized": F.round(lon, decimals)})


def qc_parse_dates(df: DataFrame, date_col: str = "CRASH_DATE", year_col: str = "CRASH_YEAR") -> DataFrame:
    """Q7-Q8: ``<date>_parsed`` (NULL when unparseable), ``<year>_from_date`` and
    ``<year>_mismatch`` (a missing side counts as a mismatch)."""
    parsed = F.try_to_date(F.col(date_col).cast("string"))
    out = df.withColumn(f"{date_col}_parsed", parsed)
    if year_col in df.columns:
        y = F.year(F.col(f"{date_col}_parsed"))
        out = out.withColumns({f"{year_col}_from_date": y,
                               f"{year_col}_mismatch": not_equal_or_missing(F.col(year_col), y)})
    return out


def qc_date_report(df: DataFrame, date_col: str = "CRASH_DATE", year_col: str = "CRASH_YEAR") -> DataFrame:
    """Q7-Q8 counters: parse failures (NULL included) and year mismatches."""
    parsed = F.try_to_date(F.col(date_col).cast("string"))
    aggs = [F.count(F.lit(1)).alias("total_records"), F.count_if(parsed.isNull()).alias("parse_failures")]
    if year_col in df.columns:
        aggs.append(F.count_if(not_equal_or_missing(F.col(year_col), F.year(parsed))).alias("year_mismatches"))
    return df.agg(*aggs)


def helmet_invalid_expr(col: str = "PC_HLMT_IND"):
    c = F.col(col)
    return c.isNotNull() & ~c.isin(*HELMET_VALID, "")


def qc_helmet_values(df: DataFrame, col: str = "PC_HLMT_IND") -> DataFrame:
    """Q9: value counts including NULL."""
    return df.groupBy(F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("n"))


def qc_helmet_invalid(df: DataFrame, col: str = "PC_HLMT_IND") -> DataFrame:
    """Q9: number of invalid rows and of distinct unexpected values (one row)."""
    return qc_helmet_unexpected(df, col).agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("invalid_count"),
        F.count(F.lit(1)).alias("unexpected_values"))


def qc_helmet_unexpected(df: DataFrame, col: str = "PC_HLMT_IND") -> DataFrame:
    """Q9: the unexpected values themselves, one row each with its count.

    Kept as rows (grouped and counted in parallel) rather than gathered into
    one list, so any number of distinct bad codes stays distributed.
    """
    return (df.filter(helmet_invalid_expr(col)).groupBy(F.col(col).alias("value"))
            .agg(F.count(F.lit(1)).alias("n")))


def qc_helmet_blank(df: DataFrame, col: str = "PC_HLMT_IND") -> DataFrame:
    """Q10: '' and NULL become 'U'; other invalid values are kept."""
    return df.withColumn(col, F.coalesce(F.nullif(F.col(col), F.lit("")), F.lit(HELMET_UNKNOWN)))


def qc_run_all(df: DataFrame, category: str, lat: str = QC_LAT, lon: str = QC_LON, county: str = "COUNTY",
               date_col: str = "CRASH_DATE", year_col: str = "CRASH_YEAR", helmet: str = "PC_HLMT_IND") -> DataFrame:
    """Q11: every row flag of the five checks, in order, as one plan."""
    out = df
    if lat in df.columns and lon in df.columns:
        out = qc_geo_valid(out, lat, lon)
    if county in df.columns:
        out = qc_county_miscoded(out, county)
    if lat in df.columns and lon in df.columns:
        out = qc_round_coords(out, lat, lon)
    if date_col in df.columns:
        out = qc_parse_dates(out, date_col, year_col)
    if category == "CYCLE" and helmet in df.columns:
        out = qc_helmet_blank(out, helmet)
    return out


def qc_checks(df: DataFrame, category: str, lat: str = QC_LAT, lon: str = QC_LON, county: str = "COUNTY",
              date_col: str = "CRASH_DATE", year_col: str = "CRASH_YEAR", helmet: str = "PC_HLMT_IND") -> DataFrame:
    """Q11 counters: (check, issue, count, pct) rows with count > 0, from one aggregate pass.

    Checks whose columns are missing are not performed (so not reported).
    """
    total = F.count(F.lit(1))
    items: list[tuple[str, str, object]] = []
    if lat in df.columns and lon in df.columns:
        items.append(("geographic_bounds", "missing_coordinates", F.count_if(missing_coords_expr(lat, lon))))
        items.append(("geographic_bounds", "out_of_bounds", F.count_if(out_of_bounds_expr(lat, lon))))
    if county in df.columns:
        v = F.col(county).cast("string")
        miscoded = (F.count_distinct(v) == 1) & is_true(F.min(v).try_cast("double") == float(MISCODED_COUNTY))
        items.append(("county_coding", "york_county_miscoding", F.when(miscoded, F.count(v)).otherwise(0)))
    if date_col in df.columns:
        parsed = F.try_to_date(F.col(date_col).cast("string"))
        items.append(("date_consistency", "parse_failure", F.count_if(parsed.isNull())))
        if year_col in df.columns:
            items.append(("date_consistency", "year_mismatch",
                          F.count_if(not_equal_or_missing(F.col(year_col), F.year(parsed)))))
    if category == "CYCLE" and helmet in df.columns:
        items.append(("categorical_consistency", "invalid_helmet_values", F.count_if(helmet_invalid_expr(helmet))))
    if not items:
        return df.sparkSession.createDataFrame([], "check string, issue string, count bigint, pct double")
    row = df.agg(total.alias("_total"), *[c.cast("bigint").alias(f"_c{i}") for i, (_, _, c) in enumerate(items)])
    entries = F.array(*[F.struct(F.lit(ch).alias("check"), F.lit(iss).alias("issue"), F.col(f"_c{i}").alias("count"))
                        for i, (ch, iss, _) in enumerate(items)])
    return (row.select("_total", F.inline(entries))
            .filter(F.col("count") > 0)
            .select("check", "issue", "count", F.round(_pct(F.col("count"), F.col("_total")), 2).alias("pct")))


def performed_checks(df: DataFrame, category: str, lat: str = QC_LAT, lon: str = QC_LON, county: str = "COUNTY",
                     date_col: str = "CRASH_DATE") -> list[str]:
    """Checks that run on this schema (the categorical check always counts)."""
    out = []
    has_coords = lat in df.columns and lon in df.columns
    if has_coords:
        out.append("geographic_bounds")
    if county in df.columns:
        out.append("county_coding")
    if has_coords:
        out.append("coordinate_precision")
    if date_col in df.columns:
        out.append("date_consistency")
    out.append("categorical_consistency")
    return out


def qc_report(checks: DataFrame, performed: list[str]) -> DataFrame:
    """Q12: total checks, checks with issues, total issues."""
    return checks.agg(F.lit(len(performed)).cast("bigint").alias("total_checks"),
                      F.count_distinct("check").alias("checks_with_issues"),
                      F.count(F.lit(1)).alias("total_issues"))
