from roadbook.operators import geo as G
from roadbook.operators import quality as Q

ROWS = [
    ("a", "39.867", "-75.28", 51),      # exactly on the lower bounds: kept
    ("b", "40.138", "-74.956", "51"),   # exactly on the upper bounds
    ("c", "0", "0", 67),                # (0,0): invalid, then outside, dropped
    ("d", "39.9", None, 51),            # latitude without longitude: outside, dropped
    ("e", None, "-75.1", None),         # longitude without latitude: kept, invalid
    ("f", "nan", "-75.1", 51),          # NaN latitude counts as missing
    ("g", "39.1234565", "-75.1", 51),   # outside box after rounding
]


def _df(spark):
    return spark.createDataFrame(ROWS, "CRN string, DEC_LATITUDE string, DEC_LONGITUDE string, COUNTY string")


def test_geo_pipeline_filter_and_flags(spark):
    out = {r.CRN: r for r in G.geo_pipeline(_df(spark)).collect()}
    assert sorted(out) == ["a", "b", "e", "f"]
    assert out["a"].COORD_QUALITY_FLAG is None and out["e"].COORD_QUALITY_FLAG == "INVALID"
    assert out["f"].DEC_LATITUDE is None
    assert out["b"].COUNTY_QUALITY_FLAG is None            # text '51' is the home county
    assert out["e"].COUNTY_QUALITY_FLAG == "NON_PHILLY_COUNTY"


def test_flag_only_mode_and_stats_conservation(spark):
    flagged = {r.CRN: r.COORD_QUALITY_FLAG for r in G.geo_pipeline(_df(spark), drop_outside=False).collect()}
    assert flagged["c"] == "OUTSIDE_PHILLY" and flagged["d"] == "OUTSIDE_PHILLY" and flagged["g"] == "OUTSIDE_PHILLY"
    s = G.geo_stats(_df(spark)).first()
    assert s.total_records == 7 and s.final_records == 4
    assert s.final_records == s.total_records - s.outside_bounds


def test_round_half_case(spark):
    df = spark.createDataFrame([("x", 39.1234565, -75.0)], "CRN string, DEC_LATITUDE double, DEC_LONGITUDE double")
    assert G.round_coords(df).first().DEC_LATITUDE == 39.123457


def _county(spark, vals):
    return spark.createDataFrame([(v,) for v in vals], "COUNTY string")


def test_county_miscoded_whole_table(spark):
    assert all(r.county_miscoded for r in Q.qc_county_miscoded(_county(spark, ["67", "67"])).collect())
    assert all(r.county_miscoded for r in Q.qc_county_miscoded(_county(spark, ["67", None])).collect())
    assert not any(r.county_miscoded for r in Q.qc_county_miscoded(_county(spark, ["67", "51"])).collect())


def test_helmet_checks(spark):
    df = spark.createDataFrame([("Y",), ("",), (None,), ("x",), (" y ",)], "PC_HLMT_IND string")
    inv = Q.qc_helmet_invalid(df).first()
    assert inv.invalid_count == 2 and inv.unexpected_values == 2
    assert sorted(r.value for r in Q.qc_helmet_unexpected(df).collect()) == [" y ", "x"]
    assert [r[0] for r in Q.qc_helmet_blank(df).collect()] == ["Y", "U", "U", "x", " y "]


def test_qc_report_counts_performed_checks(spark):
    df = spark.createDataFrame([(None, -75.0, "67", "2020-01-01", 2021)],
                               "DEC_LAT double, DEC_LONG double, COUNTY string, CRASH_DATE string, CRASH_YEAR int")
    checks = Q.qc_checks(df, "CRASH")
    issues = {(r.check, r.issue) for r in checks.collect()}
    assert ("geographic_bounds", "missing_coordinates") in issues
    assert ("county_coding", "york_county_miscoding") in issues
    assert ("date_consistency", "year_mismatch") in issues
    rep = Q.qc_report(checks, Q.performed_checks(df, "CRASH")).first()
    assert rep.total_checks == 5 and rep.checks_with_issues == 3 and rep.total_issues == 3
