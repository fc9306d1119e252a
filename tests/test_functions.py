import datetime as dt

from pyspark.sql import functions as F

from roadbook.functions import decimal_places, first_weekday_in_month, point_in_polygon, safe_date, to_number


def test_to_number_maps_nan_and_junk_to_null(spark):
    df = spark.createDataFrame([("1.5",), ("nan",), ("NaN",), ("abc",), (None,), ("",)], "v string")
    got = [r[0] for r in df.select(to_number("v")).collect()]
    assert got == [1.5, None, None, None, None, None]


def test_safe_date_invalid_parts_are_null(spark):
    df = spark.createDataFrame([(2023, 13, 1), (2023, 2, 30), (2023, 7, 1), (None, 1, 1)], "y int, m int, d int")
    got = [r[0] for r in df.select(safe_date("y", "m", "d")).collect()]
    assert got == [None, None, dt.date(2023, 7, 1), None]


def test_first_weekday_worked_example(spark):
    # Wednesday (code 4) in July 2023 -> 2023-07-05
    df = spark.createDataFrame([(2023, 7, 4)], "y int, m int, w int")
    assert df.select(first_weekday_in_month("y", "m", "w")).first()[0] == dt.date(2023, 7, 5)


def test_first_weekday_matches_python_rule_all_codes(spark):
    rows = [(y, m, w) for y in (2005, 2016, 2024) for m in range(1, 13) for w in range(1, 10)]
    df = spark.createDataFrame(rows, "y int, m int, w int")
    got = {(r.y, r.m, r.w): r.d for r in df.select("y", "m", "w", first_weekday_in_month("y", "m", "w").alias("d")).collect()}
    for (y, m, w), d in got.items():
        first = dt.date(y, m, 1)
        target = (w - 2) % 7          # 1 = Sunday ... 7 = Saturday -> Python weekday
        assert d == first + dt.timedelta(days=(target - first.weekday()) % 7)


def test_decimal_places(spark):
    df = spark.createDataFrame([(39.0,), (39.123456,), (None,)], "v double")
    assert [r[0] for r in df.select(decimal_places("v")).collect()] == [1, 6, None]


def test_point_in_polygon_square_with_boundary(spark):
    sq = [(0.0, 0.0), (0.0, 1.0), (1.0, 1.0), (1.0, 0.0), (0.0, 0.0)]
    df = spark.createDataFrame([(0.5, 0.5), (1.5, 0.5), (0.0, 0.5), (1.0, 1.0), (None, 0.5)], "x double, y double")
    got = [r[0] for r in df.select(point_in_polygon("x", "y", sq)).collect()]
    assert got == [True, False, True, True, None]
    got_open = [r[0] for r in df.select(point_in_polygon("x", "y", sq, include_boundary=False)).collect()]
    assert got_open[0] is True and got_open[1] is False


def test_point_in_polygon_concave(spark):
    # an L shape: the notch (1.5, 1.5) is outside
    poly = [(0, 0), (0, 2), (1, 2), (1, 1), (2, 1), (2, 0), (0, 0)]
    df = spark.createDataFrame([(0.5, 1.5), (1.5, 1.5), (1.5, 0.5)], "x double, y double")
    assert [r[0] for r in df.select(point_in_polygon("x", "y", poly)).collect()] == [True, False, True]
    assert df.select(F.lit(1)).count() == 3


def test_numbers_are_not_java_literals_or_padded_codes(spark):
    from roadbook.functions.numeric import to_long, to_number
    from roadbook.operators import profile as P
    values = ["12D", "5F", "0x1p3", "1e5", "Infinity", " 7 ", "nan", "9007199254740993", "0123", "1.5", "", None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    got = df.select("i", to_number("v").alias("d"), to_long("v").alias("n")).orderBy("i").collect()
    assert [r.d for r in got] == [None, None, None, 1e5, float("inf"), 7.0, None, 9007199254740992.0, 123.0, 1.5, None, None]
    assert [r.n for r in got] == [None, None, None, 100000, None, 7, None, 9007199254740993, 123, 1, None, None]
    shards = spark.createDataFrame([(2020, "12D", "0123", "3"), (2020, "5F", "4567", "4")], "shard_year int, a string, b string, c string")
    kinds = {r.column: (r.dtype, r.logical_type) for r in P.type_evidence(shards).collect()}
    assert kinds == {"a": ("object", "string"), "b": ("int64", "string"), "c": ("int64", "long")}
    counted = {r.column: (r.dtype, r.logical_type) for r in P.column_stats(P.value_counts(shards)).collect()}
    assert counted == kinds
