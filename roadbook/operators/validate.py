"""Validation analytics over a final dataset.

Counts are per row by default (the full dataset has one row per crash and
road segment); ``per="crash"`` counts distinct crash numbers instead.

Every report section is a list of aggregates plus expressions over their
results, so a single section is one ``agg`` and the whole report (V10) is
also one ``agg``: one pass over the dataset however many sections it has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadbook.constants import METHOD_EXACT, METHOD_FALLBACK, METHOD_MID_ONLY, METHOD_WEEKDAY

METHODS = (METHOD_EXACT, METHOD_WEEKDAY, METHOD_FALLBACK, METHOD_MID_ONLY)


def _per(df: DataFrame, per: str, key: str = "CRN", cols: list[str] | None = None) -> DataFrame:
    """Rows as they are, or one row per crash (distinct on key + the needed columns)."""
    if per == "row":
        return df
    if per == "crash":
        return df.select(key, *(cols or [])).dropDuplicates([key])
    raise ValueError(per)


def _pct(n, total):
    return F.round(F.when(total > 0, n.cast("double") * 100.0 / total), 2)


Section = tuple[list[Column], list[Column]]   # (aggregates, final expressions over them)


def _a(p: str, name: str) -> Column:
    return F.col(f"{p}{name}")


def date_methods_section(p: str = "") -> Section:
    m = F.col("date_approximation_method")
    aggs = [F.count(F.lit(1)).alias(f"{p}total_records")] + [F.count_if(m == x).alias(f"{p}{x}") for x in METHODS]
    fin = [_a(p, "total_records").alias("total_records")]
    for x in METHODS:
        fin += [_a(p, x).alias(x), _pct(_a(p, x), _a(p, "total_records")).alias(f"{x}_pct")]
    return aggs, fin


def temporal_section(p: str = "", date_col: str = "crash_date") -> Section:
    dt = F.col(date_col)
    # years and days of month are small domains: a set per task is cheaper than
    # count_distinct, which would expand every row once per distinct aggregate
    aggs = [F.min(F.year(dt)).alias(f"{p}first_year"), F.max(F.year(dt)).alias(f"{p}last_year"),
            F.size(F.collect_set(F.year(dt))).cast("bigint").alias(f"{p}total_years"), F.count(dt).alias(f"{p}dated"),
            F.count(F.lit(1)).alias(f"{p}total_records"), F.count_if(F.dayofmonth(dt) == 1).alias(f"{p}day_1_crashes"),
            F.size(F.collect_set(F.dayofmonth(dt))).cast("bigint").alias(f"{p}days_with_crashes")]
    # the mean of the yearly counts is dated rows / distinct years, so no second level is needed
    fin = [_a(p, "first_year").alias("first_year"), _a(p, "last_year").alias("last_year"),
           _a(p, "total_years").alias("total_years"),
           F.round(F.when(_a(p, "total_years") > 0, _a(p, "dated") / _a(p, "total_years")), 1).alias("crashes_per_year_avg"),
           _a(p, "total_records").alias("total_records"), _a(p, "day_1_crashes").alias("day_1_crashes"),
           _pct(_a(p, "day_1_crashes"), _a(p, "total_records")).alias("day_1_percentage"),
           _a(p, "days_with_crashes").alias("days_with_crashes")]
    return aggs, fin


def geo_section(p: str = "", lat: str = "DEC_LATITUDE", lon: str = "DEC_LONGITUDE") -> Section:
    both = F.col(lat).isNotNull() & F.col(lon).isNotNull()
    aggs = [F.count(F.lit(1)).alias(f"{p}total"), F.count_if(both).alias(f"{p}with"),
            F.min(F.when(both, F.col(lat))).alias(f"{p}lat_min"), F.max(F.when(both, F.col(lat))).alias(f"{p}lat_max"),
            F.min(F.when(both, F.col(lon))).alias(f"{p}lon_min"), F.max(F.when(both, F.col(lon))).alias(f"{p}lon_max")]
    fin = [_a(p, "with").alias("total_with_coords"), _pct(_a(p, "with"), _a(p, "total")).alias("percent_with_coords")]
    fin += [_a(p, c).alias(c) for c in ("lat_min", "lat_max", "lon_min", "lon_max")]
    return aggs, fin


def weather_section(p: str = "", first: str = "temp_max_c", temp: str = "temp_max_c",
                    precip: str = "precipitation_mm") -> Section:
    aggs = [F.count(F.lit(1)).alias(f"{p}total"), F.count(first).alias(f"{p}with"),
            F.min(temp).alias(f"{p}tmin"), F.max(temp).alias(f"{p}tmax"),
            F.count_if(F.col(precip) > 0).alias(f"{p}wet"), F.count(precip).alias(f"{p}precip_n")]
    fin = [_a(p, "with").alias("crashes_with_weather"), _pct(_a(p, "with"), _a(p, "total")).alias("percent_with_weather"),
           _a(p, "tmin").alias("temp_min"), _a(p, "tmax").alias("temp_max"),
           _a(p, "wet").alias("crashes_with_precipitation"),
           _pct(_a(p, "wet"), _a(p, "precip_n")).alias("percent_with_precipitation")]
    return aggs, fin


def completeness_overall_section(columns: list[str], p: str = "") -> Section:
    aggs = [F.count(F.lit(1)).alias(f"{p}_total")] + [F.count(F.col(f"`{c}`")).alias(f"{p}_n{i}") for i, c in enumerate(columns)]
    total = _a(p, "_total")
    pcts = [_pct(_a(p, f"_n{i}"), total) for i in range(len(columns))]
    nn = sum((_a(p, f"_n{i}") for i in range(len(columns))), F.lit(0).cast("bigint"))
    fin = [total.alias("total_records"), F.lit(len(columns)).cast("bigint").alias("total_fields"),
           _pct(nn, total * len(columns)).alias("overall_completeness_pct"),
           sum((F.when(x == 100.0, 1).otherwise(0) for x in pcts), F.lit(0)).cast("bigint").alias("fields_with_100pct_completeness"),
           sum((F.when(x < 90.0, 1).otherwise(0) for x in pcts), F.lit(0)).cast("bigint").alias("fields_below_90pct_completeness")]
    return aggs, fin


def _run(df: DataFrame, section: Section) -> DataFrame:
    aggs, fin = section
    return df.agg(*aggs).select(*fin)


def val_date_methods(df: DataFrame, per: str = "row") -> DataFrame:
    """V1: count and percent (2 dp) per date approximation method."""
    return _run(_per(df, per, cols=["date_approximation_method"]), date_methods_section())


def val_temporal(df: DataFrame, date_col: str = "crash_date", per: str = "row") -> DataFrame:
    """V2-V4: year range, years, mean crashes per year (1 dp), day-1 count/percent, days used."""
    return _run(_per(df, per, cols=[date_col]), temporal_section(date_col=date_col))


def val_day_histogram(df: DataFrame, date_col: str = "crash_date", per: str = "row") -> DataFrame:
    """V4: crashes per day of month (NULL dates excluded)."""
    d = _per(df, per, cols=[date_col])
    return (d.filter(F.col(date_col).isNotNull())
            .groupBy(F.dayofmonth(date_col).alias("day")).agg(F.count(F.lit(1)).alias("n")))


def val_top_days(df: DataFrame, date_col: str = "crash_date", per: str = "row", parity: bool = True) -> DataFrame:
    """V5: five days of the month.

    ``parity=True`` reproduces the historical report: the first five days by
    day number. ``parity=False`` gives the five most common days.
    """
    h = val_day_histogram(df, date_col, per)
    order = [F.asc("day")] if parity else [F.desc("n"), F.asc("day")]
    return h.orderBy(*order).limit(5)


def val_geo_coverage(df: DataFrame, lat: str = "DEC_LATITUDE", lon: str = "DEC_LONGITUDE", per: str = "row") -> DataFrame:
    """V6: rows with both coordinates, percent, and coordinate ranges."""
    return _run(_per(df, per, cols=[lat, lon]), geo_section(lat=lat, lon=lon))


def val_weather_coverage(df: DataFrame, per: str = "row", first: str = "temp_max_c",
                         temp: str = "temp_max_c", precip: str = "precipitation_mm") -> DataFrame:
    """V7: rows with weather, percent, temperature range, rows with precipitation > 0.

    The precipitation percent is among rows that have a precipitation value.
    """
    return _run(_per(df, per, cols=list(dict.fromkeys([first, temp, precip]))),
                weather_section(first=first, temp=temp, precip=precip))


def val_completeness(df: DataFrame) -> DataFrame:
    """V8: non-null count and percent (2 dp) per column, from one aggregate pass."""
    cols = df.columns
    row = df.agg(F.count(F.lit(1)).alias("_total"), *[F.count(F.col(f"`{c}`")).alias(f"_n{i}") for i, c in enumerate(cols)])
    entries = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"_n{i}").alias("non_null")) for i, c in enumerate(cols)])
    return row.select("_total", F.inline(entries)).select(
        "column", "non_null", _pct(F.col("non_null"), F.col("_total")).alias("completeness_pct"))


def val_completeness_overall(df: DataFrame) -> DataFrame:
    """V9: overall completeness, fields at 100 %, fields below 90 % (on the rounded percents)."""
    return _run(df, completeness_overall_section(df.columns))


def val_report(df: DataFrame, per: str = "row", date_col: str = "crash_date", metadata: dict[str, str] | None = None,
               catalog: DataFrame | None = None) -> DataFrame:
    """All report sections as (section, metric, value) text rows.

    The sections of V1, V2-V4, V6, V7 and V9 are one pass over ``df``. The five
    most common days of the month come from a count per day, which reads
    nothing but the date. ``per="crash"`` counts each crash once. ``metadata`` (stated
    facts such as the coordinate system) and ``catalog`` (the output files,
    see ``dataset_catalog``) are added as sections; the fields are always
    listed.
    """
    base = _per(df, per, cols=[c for c in df.columns if c != "CRN"])
    sections = {
        "date_approximation": date_methods_section("s1_"),
        "temporal_distribution": temporal_section("s2_"),
        "geographic_coverage": geo_section("s3_"),
        "weather_integration": weather_section("s4_"),
        "data_quality": completeness_overall_section(base.columns, "s5_"),
    }
    row = base.agg(*[a for aggs, _ in sections.values() for a in aggs])
    days = base.filter(F.col(date_col).isNotNull()).groupBy(F.dayofmonth(date_col).alias("day")).agg(F.count(F.lit(1)).alias("n"))
    top = days.orderBy(F.desc("n"), "day").limit(5).select(
        F.lit("most_common_days").alias("section"), F.concat(F.lit("day_"), F.col("day").cast("string")).alias("metric"), F.col("n").cast("string").alias("value"))
    wide = row.select(*[e.alias(f"{name}.{i}") for name, (_, fin) in sections.items() for i, e in enumerate(fin)])
    names = {name: row.select(*fin).columns for name, (_, fin) in sections.items()}
    entries = [F.struct(F.lit(name).alias("section"), F.lit(metric).alias("metric"),
                        F.col(f"`{name}.{i}`").cast("string").alias("value"))
               for name, metrics in names.items() for i, metric in enumerate(metrics)]
    stated = [("fields", c, t) for c, t in base.dtypes] + [("metadata", k, v) for k, v in (metadata or {}).items()]
    facts = [F.struct(F.lit(a).alias("section"), F.lit(b).alias("metric"), F.lit(c).alias("value")) for a, b, c in stated]
    out = wide.select(F.inline(F.array(*entries, *facts))).unionByName(top)
    if catalog is not None:
        sizes = F.concat_ws(" ", F.col("records").cast("string"), F.lit("records,"), F.col("fields").cast("string"), F.lit("fields"))
        out = out.unionByName(catalog.select(F.lit("output_files").alias("section"), F.col("dataset").alias("metric"), sizes.alias("value")))
    return out
