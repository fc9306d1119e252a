import datetime as dt

from roadbook.operators.dates import date_stats, reconstruct_dates
from roadbook.operators.weather import add_weather_features, join_weather, pivot_long, weather_daily


def test_precip_bins_right_closed(spark):
    vals = [0.1, 0.11, 2.5, 2.51, 10.0, 10.1, None]
    df = spark.createDataFrame([(v,) for v in vals], "precipitation_mm double")
    got = [r.precip_category for r in add_weather_features(df).collect()]
    assert got == ["none", "light", "light", "moderate", "moderate", "heavy", None]


def test_temperature_bins_and_extremes(spark):
    vals = [0.0, 0.01, 10.0, 10.01, 20.0, 20.01, 30.0, 30.01, -5.0, -5.1, 35.0, 35.1, None]
    df = spark.createDataFrame([(v,) for v in vals], "temp_avg_c double")
    out = add_weather_features(df).collect()
    assert [r.temp_category for r in out] == ["cold", "cool", "cool", "mild", "mild", "warm", "warm", "hot",
                                              "cold", "cold", "hot", "hot", None]
    assert [r.extreme_temp for r in out] == [0, 0, 0, 0, 0, 0, 0, 0, 0, 1, 0, 1, 0]


def test_adverse_flag_missing_is_zero(spark):
    df = spark.createDataFrame([(2.5, 15.0, 0.0), (2.6, None, None), (None, 15.1, None), (None, None, 0.1),
                                (None, None, None)], "precipitation_mm double, wind_speed_max_ms double, snowfall_mm double")
    assert [r.adverse_weather for r in add_weather_features(df).collect()] == [0, 1, 1, 1, 0]


def test_table_level_exact_day_switch(spark):
    df = spark.createDataFrame([(2023, 7, 4, 9), (2023, 7, 4, None)], "CRASH_YEAR int, CRASH_MONTH int, DAY_OF_WEEK int, CRASH_DAY int")
    out = reconstruct_dates(df).collect()
    assert [r.date_approximation_method for r in out] == ["exact_day", "exact_day"]
    assert [r.crash_date for r in out] == [dt.date(2023, 7, 9), None]
    row = reconstruct_dates(df, mode="row").collect()
    assert [r.date_approximation_method for r in row] == ["exact_day", "weekday_reconstructed"]
    assert row[1].crash_date == dt.date(2023, 7, 5)


def test_weekday_fallbacks(spark):
    df = spark.createDataFrame([(2023, 7, "4"), (2023, 7, None), (2023, 7, "3.0"), (2023, 13, "4"), (2023, 7, "nan")],
                               "CRASH_YEAR int, CRASH_MONTH int, DAY_OF_WEEK string")
    out = reconstruct_dates(df).collect()
    assert [r.date_approximation_method for r in out] == ["weekday_reconstructed"] + ["mid_month_fallback"] * 4
    assert [r.crash_date for r in out] == [dt.date(2023, 7, 5), dt.date(2023, 7, 15), dt.date(2023, 7, 15), None,
                                           dt.date(2023, 7, 15)]
    assert [r.CRASH_DAY for r in out] == [None, 15, 15, 15, 15]


def test_mid_month_only_without_columns(spark):
    df = spark.createDataFrame([(2023, 2)], "CRASH_YEAR int, CRASH_MONTH int")
    r = reconstruct_dates(df).first()
    assert (r.crash_date, r.date_approximation_method, r.CRASH_DAY) == (dt.date(2023, 2, 15), "mid_month_only", 15)
    s = date_stats(reconstruct_dates(df)).first()
    assert s.mid_month_only == 1 and s.crashes_with_dates == 1


def test_pivot_keeps_first_non_null_by_order(spark):
    rows = [("2023-01-01", "TMAX", None, 1), ("2023-01-01", "TMAX", 50.0, 2), ("2023-01-01", "TMAX", 70.0, 3),
            ("2023-01-01", "PRCP", 1.0, 4)]
    df = spark.createDataFrame(rows, "date string, datatype string, value double, o long")
    w = pivot_long(df, order_col="o").first()
    assert w.TMAX == 50.0 and w.PRCP == 1.0 and w.TAVG is None
    d = weather_daily(df, order_col="o", scale=10.0).first()
    assert d.temp_max_c == 5.0 and d.precipitation_mm == 1.0


def test_weather_join_keeps_all_crashes_and_suffixes(spark):
    crash = spark.createDataFrame([(1, dt.date(2023, 1, 1), 5.0), (2, dt.date(2023, 1, 2), 6.0), (3, None, 7.0)],
                                  "id int, crash_date date, temp_max_c double")
    wx = spark.createDataFrame([(dt.date(2023, 1, 1), 1.0)], "date date, temp_max_c double")
    out = {r.id: r for r in join_weather(crash, wx).collect()}
    assert len(out) == 3
    assert out[1].temp_max_c == 5.0 and out[1].temp_max_c_weather == 1.0
    assert out[2].temp_max_c_weather is None


def test_validation_on_undated_rows(spark):
    from roadbook.operators import validate as V
    df = spark.createDataFrame([("1", None, "mid_month_fallback")], "CRN string, crash_date date, date_approximation_method string")
    r = V.val_temporal(df).first()
    assert r.total_years == 0 and r.crashes_per_year_avg is None and r.days_with_crashes == 0
