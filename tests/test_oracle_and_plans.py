"""Registered queries vs their DuckDB oracle (small scale), invariants and plan checks."""

import duckdb
import pytest

import __spark_entry__ as entry
from roadbook.plans import stages
from tests.conftest import SF_SMALL

TABLES = ["orders", "lineitem", "events"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def _norm(v):
    if isinstance(v, float):
        return round(v, 9)
    return v


KEYS = ["weather_pipeline", "geo_stats", "cyclist_focused", "pedestrian_focused", "full_integrated", "vehicle_summary",
        "profile_dtype", "harmonize_all_years", "qc_checks", "val_completeness", "numeric_outliers", "rename_detection", "harmonize_changed_years",
        "profile_all_years", "profile_top_values_all_years",
        "schema_issues", "weekday_multi_weather", "date_rowwise"]


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    df = entry.queries()[key](spark, SF_SMALL)
    rel = con.sql(entry.oracle_sql()[key])
    assert sorted(df.columns) == sorted(rel.columns)
    s_idx = sorted(range(len(df.columns)), key=lambda i: df.columns[i])
    d_idx = sorted(range(len(rel.columns)), key=lambda i: rel.columns[i])
    s = sorted((tuple(_norm(r[i]) for i in s_idx) for r in df.collect()), key=str)
    d = sorted((tuple(_norm(r[i]) for i in d_idx) for r in rel.fetchall()), key=str)
    assert s == d


def test_every_query_has_an_oracle_or_is_listed():
    from roadbook.plans import registry
    assert set(registry.QUERIES) == set(registry.ORACLE)
    assert set(entry.oracle_sql()) <= set(entry.queries())


#: Queries that land files or resolve types from data before their plan can be built.
PLANS_WITH_JOBS = {"scan_category_csv", "scan_sample", "shard_discovery", "scan_observations_json", "sink_parquet", "sink_csv", "sink_json_report",
                   "sink_text_summary", "dataset_catalog", "dataset_run_summary", "harmonize_all_years", "harmonize_type_conflict",
                   "harmonize_type_conflict_strict", "cast_to_master", "numeric_outliers", "schema_removed",
                   # these run or store over several years first
                   "harmonize_changed_years", "harmonize_dates", "profile_all_years", "profile_top_values_all_years", "val_completeness_footers",
                   # these land archives or pages, and gather their members' headers
                   "unzip_shards", "unzip_members", "observation_page_report", "observation_missing_pages", "observation_torn_pages"}


def test_building_a_plan_starts_no_job(spark):
    from roadbook.plans import registry
    started = {}
    for name, build in registry.QUERIES.items():
        spark.sparkContext.setJobGroup(f"plan-{name}", name)
        build(spark, SF_SMALL)
        tracker, jobs = spark.sparkContext.statusTracker(), []
        for j in tracker.getJobIdsForGroup(f"plan-{name}"):
            stages_of = [tracker.getStageInfo(i) for i in tracker.getJobInfo(j).stageIds]
            if not all(x and x.name.startswith("parquet at") for x in stages_of):     # those read a schema from a footer
                jobs += [x.name for x in stages_of if x]
        if jobs:
            started[name] = jobs
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert set(started) <= PLANS_WITH_JOBS, started


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert set(df.columns) == {"precip_category", "temp_category", "crashes", "adverse", "extreme"}
    assert df.count() > 0


def test_invariants(spark):
    from roadbook.operators.geo import geo_stats
    from roadbook.operators.weather import match_stats
    from roadbook.plans import fixtures as fx
    g = geo_stats(fx.crash(spark, SF_SMALL)).first()
    cg = stages.crash_geographic(spark, SF_SMALL)
    assert cg.count() == g.final_records == g.total_records - g.outside_bounds
    from roadbook.operators.dates import reconstruct_dates
    m = match_stats(reconstruct_dates(cg), stages.weather_table(spark, SF_SMALL)).first()
    assert m.crashes_matched + m.crashes_unmatched == m.total_crashes == cg.count()
    assert m.weather_row_matched >= m.crashes_matched
    full = stages.full(spark, SF_SMALL)
    assert full.select("CRN").distinct().count() == cg.count()     # left joins never lose crashes
    from pyspark.sql import functions as F
    wk = reconstruct_dates(cg).filter(F.col("date_approximation_method") == "weekday_reconstructed")
    assert wk.filter((F.dayofmonth("crash_date") > 7) | (F.dayofweek("crash_date") != F.col("DAY_OF_WEEK"))).count() == 0


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_weather_join_is_broadcast_and_no_python_udf(spark):
    df = stages.crash_weather(spark, SF_SMALL)
    plan = _plan(df)
    assert "BroadcastHashJoin" in plan
    for key in ["cyclist_focused", "pedestrian_focused", "full_integrated", "profile_top_values", "harmonize_all_years"]:
        p = _plan(entry.queries()[key](spark, SF_SMALL))
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p and "MapInPandas" not in p


def test_filters_reach_the_scan(spark):
    from roadbook.operators.datasets import filter_cyclists
    from roadbook.plans import fixtures as fx
    p = _plan(filter_cyclists(fx.person(spark, SF_SMALL)).select("CRN"))
    assert "PushedFilters" in p or "DataFilters" in p
