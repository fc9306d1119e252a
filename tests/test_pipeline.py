import json
import os

from roadbook.plans.pipeline import run_all
from tests.conftest import SF_SMALL


def test_run_all_writes_outputs_and_reports(spark, tmpdir_path):
    out = run_all(spark, SF_SMALL, tmpdir_path)
    assert {"cyclist_focused", "pedestrian_focused", "full_integrated", "person", "vehicle"} <= set(out)
    cat_dir = os.path.join(tmpdir_path, "metadata", "catalog")
    lines = [json.loads(x) for f in os.listdir(cat_dir) if f.endswith(".json") for x in open(os.path.join(cat_dir, f))]
    by_name = {r["dataset"]: r for r in lines}
    assert by_name["full_integrated"]["records"] >= by_name["pedestrian_focused"]["records"]
    assert by_name["person"]["records"] == out["person"].count()
    geo = out["geographic_stats"].first()
    wx = out["weather_stats"].first()
    assert wx.total_crashes == geo.final_records


def test_profile_and_harmonize_from_csv(spark, tmpdir_path):
    from roadbook.plans.pipeline import profile_and_harmonize
    from tests.test_sources_streaming import _write_shards
    _write_shards(spark, tmpdir_path)
    out = profile_and_harmonize(spark, tmpdir_path, "CRASH", range(1994, 2002))
    assert [r.year for r in out["missing"].collect()] == [1994]
    issues = {r.issue: r.columns for r in out["schema_issues"].collect()}
    assert issues["added_columns"] == "o_orderpriority" and issues["dtype_changes"] == "o_totalprice"
    h = out["harmonized"]
    assert dict(h.dtypes)["o_orderkey"] == "bigint" and dict(h.dtypes)["o_totalprice"] == "string"
    sampled = profile_and_harmonize(spark, tmpdir_path, "CRASH", range(1995, 2002), sample_rows=10)
    assert sampled["column_stats"].agg({"rows": "max"}).first()[0] == 10


def test_profile_and_harmonize_scale_mode_agrees_on_small_columns(spark, tmpdir_path):
    from roadbook.plans.pipeline import profile_and_harmonize
    from tests.test_sources_streaming import _write_shards
    _write_shards(spark, tmpdir_path)
    exact = profile_and_harmonize(spark, tmpdir_path, "CRASH", range(1995, 2002))
    approx = profile_and_harmonize(spark, tmpdir_path, "CRASH", range(1995, 2002), exact_distinct=False)
    key = lambda r: (r.shard_year, r.column, r.value, r.n, r.rank)
    assert sorted(map(key, exact["top_values"].collect())) == sorted(map(key, approx["top_values"].collect()))
    small = ["o_orderstatus", "o_orderpriority"]
    a = {(r.shard_year, r.column): (r.distinct_count, r.null_count, r.dtype)
         for r in exact["column_stats"].filter(exact["column_stats"].column.isin(small)).collect()}
    b = {(r.shard_year, r.column): (r.distinct_count, r.null_count, r.dtype)
         for r in approx["column_stats"].filter(approx["column_stats"].column.isin(small)).collect()}
    assert a == b and a


def test_updated_years_equal_a_full_run(spark, tmpdir_path):
    from roadbook.plans.pipeline import profile_and_harmonize, profile_and_update
    from tests.test_sources_streaming import _write_shards
    landed, kept, years = os.path.join(tmpdir_path, "landed"), os.path.join(tmpdir_path, "kept"), range(1994, 2002)
    os.mkdir(landed)
    _write_shards(spark, landed)

    def compare(states):
        out = profile_and_update(spark, landed, "CRASH", kept, years, processing_date="x")
        assert {r.shard_year: r.state for r in out["changes"].collect()} == states
        full = profile_and_harmonize(spark, landed, "CRASH", years)
        assert set(out) - set(full) == {"changes"}
        for name in ("files", "missing", "quarantine", "schema_matrix", "schema_issues", "top_values"):
            cols = sorted(full[name].columns)
            assert sorted(map(str, out[name].select(*cols).collect())) == sorted(map(str, full[name].select(*cols).collect())), name
        exact = ["shard_year", "column", "rows", "null_count", "null_pct", "dtype", "logical_type", "min", "max"]
        assert sorted(map(str, out["column_stats"].select(*exact).collect())) == sorted(map(str, full["column_stats"].select(*exact).collect()))
        a, b = out["harmonized"].drop("PROCESSING_DATE"), full["harmonized"].drop("PROCESSING_DATE")
        assert dict(a.dtypes) == dict(b.dtypes)
        assert sorted(map(str, a.collect())) == sorted(map(str, b.select(*a.columns).collect()))

    found = sorted(r.year for r in profile_and_harmonize(spark, landed, "CRASH", years)["files"].collect())
    compare(dict.fromkeys(found, "new"))
    compare(dict.fromkeys(found, "same"))
    late = sorted(f for f in os.listdir(landed) if str(found[1]) in f and f.endswith(".csv"))[0]
    with open(os.path.join(landed, late)) as f:
        lines = f.read().splitlines()
    with open(os.path.join(landed, late), "a") as f:
        f.write(lines[1] + "\n")
    compare({y: "changed" if y == found[1] else "same" for y in found})
