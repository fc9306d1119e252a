from pyspark.sql import functions as F

from roadbook.operators import harmonize as H
from roadbook.operators import profile as P


def _shards(spark):
    rows = [(2020, "1", "1.5", "x"), (2020, "2", "2.5", None), (2021, "3", None, "y"), (2021, "1.0", "abc", "z")]
    df = spark.createDataFrame(rows, "shard_year int, a string, b string, c string")
    inv = spark.createDataFrame([(2020, "a"), (2020, "b"), (2020, "c"), (2021, "a"), (2021, "b")], "shard_year int, column string")
    return df, inv


def test_dtype_inference_pandas_rules(spark):
    df, inv = _shards(spark)
    st = {(r.shard_year, r.column): r for r in P.column_stats(P.value_counts(df, "shard_year", inv)).collect()}
    assert st[(2020, "a")].dtype == "int64" and st[(2021, "a")].dtype == "float64"
    assert st[(2020, "b")].dtype == "float64" and st[(2021, "b")].dtype == "object"
    assert (2021, "c") not in st                     # absent from the 2021 shard
    assert st[(2021, "b")].min is None and st[(2020, "b")].max == 2.5


def test_target_types_and_harmonized_union(spark):
    df, inv = _shards(spark)
    stats = P.column_stats(P.value_counts(df, "shard_year", inv))
    types = {r.column: r.target_type for r in H.target_types(P.inventory_types(inv, stats)).collect()}
    assert types == {"a": "double", "b": "string", "c": "string"}
    strict = {r.column: r.target_type for r in H.target_types(P.inventory_types(inv, stats), pandas_dtypes=True).collect()}
    assert strict["a"] == "string"
    h = H.harmonize_text_shards(df, inv, processing_date="run-1")
    assert h.columns == ["DATA_YEAR", "a", "b", "c", "PROCESSING_DATE"]
    assert dict(h.dtypes)["a"] == "double"
    assert sorted(r.b for r in h.collect() if r.b is not None) == ["1.5", "2.5", "abc"]


def test_harmonize_union_type_conflict_keeps_null(spark):
    d1 = spark.createDataFrame([(1, None)], "x int, y string")
    d2 = spark.createDataFrame([("1.0", 2.0)], "x string, z double")
    u = H.harmonize_union(d1, d2)
    assert u.columns == ["x", "y", "z"] and dict(u.dtypes)["x"] == "string"
    rows = sorted(map(tuple, u.collect()), key=str)
    assert rows == [("1", None, None), ("1.0", None, 2.0)]


def test_schema_comparison(spark):
    inv = spark.createDataFrame([(2020, "a"), (2021, "a"), (2021, "new"), (2020, "old")], "shard_year int, column string")
    assert [r.column for r in P.schema_added(inv).collect()] == ["new"]
    assert [r.column for r in P.schema_removed(inv).collect()] == ["old"]
    m = {r.column: r.years_present for r in P.schema_matrix(inv).collect()}
    assert m["a"] == "2020,2021"


def test_helmet_standardization_and_rename(spark):
    df = spark.createDataFrame([(" y ",), ("",), (None,), ("Q",), ("N",)], "HELMET_IND string")
    assert [r[0] for r in H.standardize_helmet(df).collect()] == ["Y", "U", "U", "U", "N"]
    both = spark.createDataFrame([(None, 5), (3, 4)], "new int, old int")
    assert [r.new for r in H.rename_columns(both, {"old": "new"}).collect()] == [5, 3]


def test_top_values_only_low_cardinality(spark):
    rows = [(2020, str(i), "k" if i % 2 else "j") for i in range(30)]
    df = spark.createDataFrame(rows, "shard_year int, id string, kind string")
    vc = P.value_counts(df)
    top = P.top_values(vc, P.column_stats(vc)).collect()
    assert {r.column for r in top} == {"kind"}
    assert [(r.value, r.n, r.rank) for r in sorted(top, key=lambda r: r.rank)] == [("j", 15, 1), ("k", 15, 2)]
    assert df.select(F.lit(1)).count() == 30


def test_type_evidence_agrees_with_value_level_stats(spark):
    df, inv = _shards(spark)
    a = {(r.shard_year, r.column): (r.dtype, r.logical_type) for r in P.type_evidence(df, "shard_year", inv).collect()}
    b = {(r.shard_year, r.column): (r.dtype, r.logical_type)
         for r in P.column_stats(P.value_counts(df, "shard_year", inv)).collect()}
    assert a == b


def test_rename_detection_matches_brute_force(spark):
    import itertools
    from roadbook.operators.analyses import rename_detection
    names = {"HELMET_IND": (2005, 2012), "HELMET_USED": (2013, 2024), "PC_HLMT_IND": (2005, 2024), "AB": (2005, 2010),
             "ABC": (2011, 2024), "X": (2005, 2006), "YZ": (2007, 2024), "DEC_LAT": (2005, 2022), "DEC_LATITUDE": (2023, 2024),
             "LANE_CNT": (2005, 2009), "LANE_COUNT": (2010, 2024)}
    rows = [(y, c) for c, (a, b) in names.items() for y in (a, b)]
    inv = spark.createDataFrame(rows, "shard_year int, column string")
    got = {(r.old_column, r.new_column) for r in rename_detection(inv).collect()}

    def lev(a, b):
        d = list(range(len(b) + 1))
        for i, ca in enumerate(a, 1):
            prev, d[0] = d[0], i
            for j, cb in enumerate(b, 1):
                prev, d[j] = d[j], min(d[j] + 1, d[j - 1] + 1, prev + (ca != cb))
        return d[-1]
    want = {(a, b) for a, b in itertools.permutations(names, 2)
            if names[a][1] < names[b][0] and lev(a.upper(), b.upper()) <= 2}
    assert got == want and ("LANE_CNT", "LANE_COUNT") in got and ("X", "YZ") in got


def test_exact_quantiles_refinement_matches_sorting(spark):
    import math
    import random
    from roadbook.operators.analyses import exact_quantiles
    random.seed(7)
    vals = [random.choice([random.random() * 100, 5.0, 50.0]) for _ in range(5000)]   # heavy ties
    rows = [("a", v) for v in vals] + [("b", float(i % 37)) for i in range(1200)]
    df = spark.createDataFrame(rows, "g string, v double")
    # tiny max_collect forces several refinement rounds, including tie resolution
    got = {(r.g, r.p): r.value for r in exact_quantiles(df, "g", "v", [0.1, 0.25, 0.5, 0.75, 0.99],
                                                          buckets=10, accuracy=100, max_collect=50).collect()}
    for g, xs in (("a", sorted(vals)), ("b", sorted(float(i % 37) for i in range(1200)))):
        for p in (0.1, 0.25, 0.5, 0.75, 0.99):
            assert got[(g, p)] == xs[max(1, math.ceil(p * len(xs))) - 1], (g, p)


def test_profile_scale_mode_keeps_small_columns_exact(spark):
    rows = [(2020, str(i), "k" if i % 3 else "j", None if i % 5 == 0 else str(i % 7)) for i in range(3000)]
    df = spark.createDataFrame(rows, "shard_year int, id string, kind string, code string")
    s1, t1 = P.profile_shards(df)
    s2, t2 = P.profile_shards(df, exact_distinct=False)
    a = {r.column: r for r in s1.collect()}
    b = {r.column: r for r in s2.collect()}
    for c in ("kind", "code"):
        assert a[c].distinct_count == b[c].distinct_count and a[c].null_count == b[c].null_count
        assert a[c].dtype == b[c].dtype
    assert abs(b["id"].distinct_count - 3000) < 300
    key = lambda r: (r.column, r.value, r.n, r.rank)
    assert sorted(map(key, t1.collect())) == sorted(map(key, t2.collect()))


def test_all_null_shard_column_does_not_vote(spark):
    rows = [(2020, "1"), (2020, "2"), (2021, None), (2021, None)]
    df = spark.createDataFrame(rows, "shard_year int, a string")
    inv = spark.createDataFrame([(2020, "a"), (2021, "a")], "shard_year int, column string")
    ev = P.type_evidence(df, "shard_year", inv)
    assert {r.shard_year: r.logical_type for r in ev.collect()} == {2020: "long", 2021: "null"}
    assert {r.column: r.target_type for r in H.target_types(P.inventory_types(inv, ev)).collect()} == {"a": "long"}
    # the strict rule sees int64 vs float64 (an all-missing column reads as float64) and gives string
    assert {r.column: r.target_type for r in H.target_types(P.inventory_types(inv, ev), pandas_dtypes=True).collect()} == {"a": "string"}


def test_cast_to_master_types_and_bad_values(spark):
    import datetime as dt
    df = spark.createDataFrame([("1", "2.5", "2023-07-01 10:00:00", "x"), ("nan", "abc", "not a time", None)],
                               "a string, b string, c string, d string")
    out = H.cast_to_master(df, {"a": "int64", "b": "float64", "c": "datetime64[ns]", "d": "object", "missing": "int64"})
    assert dict(out.dtypes) == {"a": "bigint", "b": "double", "c": "timestamp", "d": "string"}
    rows = out.collect()
    assert (rows[0].a, rows[0].b, rows[0].c, rows[0].d) == (1, 2.5, dt.datetime(2023, 7, 1, 10, 0), "x")
    assert (rows[1].a, rows[1].b, rows[1].c) == (None, None, None)


def test_harmonize_all_widens_numeric_when_asked(spark):
    d1 = spark.createDataFrame([(1,)], "x int")
    d2 = spark.createDataFrame([(2.5,)], "x double")
    d3 = spark.createDataFrame([("t",)], "y string")
    strict = H.harmonize_all([d1, d2, d3])
    wide = H.harmonize_all([d1, d2, d3], widen_numeric=True)
    assert dict(strict.dtypes) == {"x": "string", "y": "string"}
    assert dict(wide.dtypes) == {"x": "double", "y": "string"}
    assert sorted((r.x if r.x is not None else -1.0) for r in wide.collect()) == [-1.0, 1.0, 2.5]
