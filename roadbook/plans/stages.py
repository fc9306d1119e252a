"""Stage compositions: each returns one lazy plan from file scan to result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from roadbook.operators.dates import reconstruct_dates
from roadbook.operators.geo import geo_pipeline
from roadbook.operators.weather import add_weather_features, join_weather, weather_daily
from roadbook.plans import fixtures as fx


def weather_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily wide weather (W1-W2) from the long observations."""
    return weather_daily(fx.weather_long(spark, sf_dir), order_col="obs_id", scale=10.0)


def integrate_weather(crash: DataFrame, weather: DataFrame, date_mode: str = "table") -> DataFrame:
    """Dates (T1-T5), weather join (W4) and derived features."""
    dated = reconstruct_dates(crash, mode=date_mode)
    return add_weather_features(join_weather(dated, weather))


def crash_geographic(spark: SparkSession, sf_dir: str, drop_outside: bool = True) -> DataFrame:
    """G9 on the CRASH table."""
    return geo_pipeline(fx.crash(spark, sf_dir), drop_outside=drop_outside)


def crash_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Geographic stage then weather stage: the weather-integrated CRASH table."""
    return integrate_weather(crash_geographic(spark, sf_dir), weather_table(spark, sf_dir))


def cyclist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D1 from the fixtures."""
    from roadbook.operators.datasets import cyclist_dataset
    return cyclist_dataset(crash_weather(spark, sf_dir), fx.cycle(spark, sf_dir), fx.person(spark, sf_dir),
                           fx.vehicle(spark, sf_dir))


def pedestrian(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D2 from the fixtures."""
    from roadbook.operators.datasets import pedestrian_dataset
    return pedestrian_dataset(crash_weather(spark, sf_dir), fx.person(spark, sf_dir), fx.vehicle(spark, sf_dir))


def full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D3 from the fixtures."""
    from roadbook.operators.datasets import full_integrated
    return full_integrated(crash_weather(spark, sf_dir), fx.roadway(spark, sf_dir))
