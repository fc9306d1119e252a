"""Analysis datasets: cyclist, pedestrian and full integrated."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadbook.constants import CYCLIST_TYPES, PEDESTRIAN_TYPE
from roadbook.functions.numeric import to_number
from roadbook.operators.joins import join_suffixed


def filter_cyclists(person: DataFrame, col: str = "PERSON_TYPE", types=tuple(CYCLIST_TYPES)) -> DataFrame:
    """person rows of cyclist types."""
    return person.filter(F.col(col).isin(list(types)))


def filter_pedestrians(person: DataFrame, col: str = "PERSON_TYPE", value: str = PEDESTRIAN_TYPE) -> DataFrame:
    """person rows of the pedestrian type."""
    return person.filter(F.col(col) == value)


def ped_count_column(columns: list[str]) -> str | None:
    """First column whose upper-case name contains both PED and COUNT."""
    for c in columns:
        u = c.upper()
        if "PED" in u and "COUNT" in u:
            return c
    return None


def filter_ped_count(crash: DataFrame) -> DataFrame:
    """crashes with a positive pedestrian count; all crashes if no such column."""
    c = ped_count_column(crash.columns)
    return crash if c is None else crash.filter(to_number(c) > 0)


def vehicle_summary(vehicle: DataFrame, cols=("VEH_TYPE", "VEH_ROLE_CD"), key: str = "CRN") -> DataFrame:
    """Per crash, the distinct non-null values of each column joined with ', '.

    Values are sorted (the source kept first-seen order, which has no stable
    meaning in a distributed plan); a crash whose values are all NULL gets
    ''. NULL keys are dropped. ``collect_set`` de-duplicates in the map-side
    partial aggregate, so a crash with a huge number of vehicle rows ships
    only its distinct values through the shuffle.
    """
    v = vehicle.filter(F.col(key).isNotNull())
    return v.groupBy(key).agg(*[
        F.array_join(F.array_sort(F.collect_set(F.col(c).cast("string"))), ", ").alias(c) for c in cols])


def cyclist_dataset(crash_weather: DataFrame, cycle: DataFrame | None, person: DataFrame | None = None,
                    vehicle: DataFrame | None = None, key: str = "CRN", split_rows: int | None = None) -> DataFrame | None:
    """Crashes with a cycle record, their cyclist persons and a vehicle summary.

    Returns None when the CYCLE table is missing. ``split_rows``: see
    :func:`roadbook.operators.joins.split_inner_join`.
    """
    if cycle is None:
        return None
    out = join_suffixed(crash_weather, cycle, key, "inner", "_cycle")                       # J1
    if person is not None and "PERSON_TYPE" in person.columns:
        out = join_suffixed(out, filter_cyclists(person), key, "left", "_person", split_rows=split_rows)           # J2
    if vehicle is not None:
        out = join_suffixed(out, vehicle_summary(vehicle, ("VEH_TYPE", "VEH_ROLE_CD"), key), key,
                            "left", "_veh", fanout_safe=False)                                # J3, J4
    return out


def pedestrian_dataset(crash_weather: DataFrame, person: DataFrame | None = None,
                       vehicle: DataFrame | None = None, key: str = "CRN", split_rows: int | None = None) -> DataFrame:
    """Pedestrian crashes, their pedestrian persons and vehicle types."""
    out = filter_ped_count(crash_weather)                                                    # F7
    if person is not None and "PERSON_TYPE" in person.columns:
        out = join_suffixed(out, filter_pedestrians(person), key, "left", "_person", split_rows=split_rows)       # J5
    if vehicle is not None:
        out = join_suffixed(out, vehicle_summary(vehicle, ("VEH_TYPE",), key), key, "left", "_veh",
                            fanout_safe=False)
    return out


def full_integrated(crash_weather: DataFrame, roadway: DataFrame | None = None, key: str = "CRN",
                    split_rows: int | None = None) -> DataFrame:
    """D3: weather-integrated crashes with their roadway rows (1:N fan-out kept).

    PERSON and VEHICLE stay separate tables (see :func:`reference_tables`).
    """
    if roadway is None:
        return crash_weather
    return join_suffixed(crash_weather, roadway, key, "left", "_roadway", split_rows=split_rows)        # J6


def reference_tables(person: DataFrame | None, vehicle: DataFrame | None) -> dict[str, DataFrame]:
    """PERSON and VEHICLE passed through as final tables."""
    return {k: v for k, v in (("person", person), ("vehicle", vehicle)) if v is not None}


def join_on_crn_and_year(left: DataFrame, right: DataFrame, how: str = "left", suffix: str = "_r",
                         key: str = "CRN", year: str = "DATA_YEAR", split_rows: int | None = None) -> DataFrame:
    """The documented guard, joining on crash number *and* data year."""
    return join_suffixed(left, right, [key, year], how, suffix, split_rows=split_rows)


def crash_level(df: DataFrame, key: str = "CRN", counts: dict[str, str] | None = None,
                flags: list[str] | None = None) -> DataFrame:
    """Reduce a 1:N category to one row per crash (used by X15).

    ``counts`` maps output name -> column counted (non-null); ``flags`` are
    columns reduced with ``max``. The partial aggregate runs before the
    shuffle, so hot crashes cost one row per map task.
    """
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    aggs += [F.count(c).alias(n) for n, c in (counts or {}).items()]
    aggs += [F.max(c).alias(c) for c in (flags or [])]
    return df.filter(F.col(key).isNotNull()).groupBy(key).agg(*aggs)


def join_remaining_categories(crash: DataFrame, tables: dict[str, DataFrame], key: str = "CRN",
                              one_to_one: tuple[str, ...] = ("FLAG",)) -> DataFrame:
    """Attach other categories at crash level.

    A category with one row per crash (``one_to_one``) comes with all its
    columns. The others are reduced to one row per crash: ``<name>_rows``, and
    per column its least value as ``<COLUMN>_min`` and the number of distinct
    values as ``<COLUMN>_distinct``. Names that clash get the lower-case
    category as suffix; the row count of a crash without rows is 0.
    """
    out = crash
    for name, t in tables.items():
        low, rows = name.lower(), f"{name.lower()}_rows"
        t = t.filter(F.col(key).isNotNull())
        if name in one_to_one:
            lvl = t.withColumn(rows, F.lit(1).cast("bigint"))
        else:
            cols = [c for c in t.columns if c != key]
            lvl = t.groupBy(key).agg(F.count(F.lit(1)).alias(rows), *[a for c in cols for a in (
                F.min(c).alias(f"{c}_min"), F.size(F.collect_set(c)).cast("bigint").alias(f"{c}_distinct"))])
        out = join_suffixed(out, lvl, key, "left", f"_{low}", fanout_safe=False)
        out = out.withColumn(rows, F.coalesce(F.col(rows), F.lit(0).cast("bigint")))
    return out


def dataset_run_summary(datasets: dict[str, DataFrame | None]) -> DataFrame:
    """Per dataset, success/skipped/failed with row and column counts (a small DataFrame).

    A missing dataset is ``skipped``; an empty one too. Each count is a Spark
    job over that dataset; only the per-dataset summary rows are built here.
    """
    out = []
    spark = next((d.sparkSession for d in datasets.values() if d is not None), None)
    for name, df in datasets.items():
        if df is None:
            out.append((name, "skipped", 0, 0))
            continue
        try:
            n = df.count()
            out.append((name, "success" if n > 0 else "skipped", n, len(df.columns)))
        except Exception as e:  # noqa: BLE001 - a failing dataset is reported, not raised
            out.append((name, f"failed: {type(e).__name__}: {' '.join(str(e).split())[:300]}", 0, 0))
    if spark is None:
        from pyspark.sql import SparkSession
        spark = SparkSession.getActiveSession()
    return spark.createDataFrame(out, "dataset string, status string, rows long, columns int")
