"""Property tests: Spark operators against pandas restatements of the same rules."""

import math

import numpy as np
import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st

from roadbook.operators import datasets as D
from roadbook.operators import geo as G
from roadbook.operators.weather import add_weather_features

EDGES = [0.1, 2.5, 10.0, 0.0, 20.0, 30.0, -5.0, 35.0, 15.0]
num = st.one_of(st.none(), st.sampled_from(EDGES), st.floats(-40, 60, allow_nan=False).map(lambda x: round(x, 3)))


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(num, num, num, num), min_size=1, max_size=25))
def test_weather_features_match_pandas_cut(spark, rows):
    df = spark.createDataFrame(rows, "precipitation_mm double, temp_avg_c double, wind_speed_max_ms double, snowfall_mm double")
    got = add_weather_features(df).toPandas()
    p = pd.DataFrame(rows, columns=["precipitation_mm", "temp_avg_c", "wind_speed_max_ms", "snowfall_mm"], dtype="float64")
    pc = pd.cut(p["precipitation_mm"], [-np.inf, 0.1, 2.5, 10, np.inf], labels=["none", "light", "moderate", "heavy"])
    tc = pd.cut(p["temp_avg_c"], [-np.inf, 0, 10, 20, 30, np.inf], labels=["cold", "cool", "mild", "warm", "hot"])
    adverse = ((p["precipitation_mm"] > 2.5) | (p["wind_speed_max_ms"] > 15) | (p["snowfall_mm"] > 0)).astype(int)
    extreme = ((p["temp_avg_c"] < -5) | (p["temp_avg_c"] > 35)).astype(int)
    assert list(got["precip_category"]) == [None if pd.isna(x) else str(x) for x in pc]
    assert list(got["temp_category"]) == [None if pd.isna(x) else str(x) for x in tc]
    assert list(got["adverse_weather"]) == list(adverse) and list(got["extreme_temp"]) == list(extreme)


#: Hand-made points with the flag and the outcome that the rules for coordinates, rounding and the box name for them.
POINTS = [
    # latitude, longitude, flag, kept, latitude and longitude afterwards
    (39.95, -75.16, None, True, 39.95, -75.16),
    (39.9512345678, -75.1612345678, None, True, 39.951235, -75.161235),
    (39.867, -75.28, None, True, 39.867, -75.28),                       # corners belong to the box
    (40.138, -74.956, None, True, 40.138, -74.956),
    (39.8669996, -75.1, None, True, 39.867, -75.1),                     # inside once rounded
    (39.866999, -75.1, "OUTSIDE_PHILLY", False, None, None),
    (40.2, -75.1, "OUTSIDE_PHILLY", False, None, None),
    (39.95, -75.3, "OUTSIDE_PHILLY", False, None, None),
    (0.0, 0.0, "OUTSIDE_PHILLY", False, None, None),
    (95.0, -75.1, "OUTSIDE_PHILLY", False, None, None),
    (39.95, None, "OUTSIDE_PHILLY", False, None, None),
    (None, -75.1, "INVALID", True, None, -75.1),                        # a missing latitude is kept
    (None, None, "INVALID", True, None, None),
    (float("nan"), -75.1, "INVALID", True, None, -75.1),
]


def test_geo_stage_by_hand(spark):
    df = spark.createDataFrame([(str(i), p[0], p[1]) for i, p in enumerate(POINTS)], "CRN string, DEC_LATITUDE double, DEC_LONGITUDE double")
    got = {int(r.CRN): r for r in G.geo_pipeline(df).collect()}
    assert sorted(got) == [i for i, p in enumerate(POINTS) if p[3]]
    for i, r in got.items():
        _, _, flag, _, lat, lon = POINTS[i]
        assert r.COORD_QUALITY_FLAG == flag, POINTS[i]
        for a, b in ((r.DEC_LATITUDE, lat), (r.DEC_LONGITUDE, lon)):
            assert (a is None) == (b is None) and (b is None or math.isclose(a, b, rel_tol=0, abs_tol=1e-9)), POINTS[i]


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["1", "2", "3", None]), st.one_of(st.none(), st.sampled_from("ABC"))),
                min_size=1, max_size=30))
def test_vehicle_summary_matches_pandas_groupby(spark, rows):
    df = spark.createDataFrame(rows, "CRN string, VEH_TYPE string")
    got = {r.CRN: r.VEH_TYPE for r in D.vehicle_summary(df, ("VEH_TYPE",)).collect()}
    p = pd.DataFrame(rows, columns=["CRN", "VEH_TYPE"])
    want = p.groupby("CRN")["VEH_TYPE"].agg(lambda x: ", ".join(sorted(x.dropna().astype(str).unique()))).to_dict()
    assert got == want
