"""Value counts and types of large shards: no shuffle by (shard, column) alone, no task with a whole file's values."""

import pytest

from roadbook.operators import profile as P

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture()
def no_threshold(spark):
    """Tables as large as the planner takes them for when it can't know better."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_top_values_shuffle_no_values_by_column(spark, no_threshold):
    from roadbook.plans import registry, registry_profile  # noqa: F401
    p = plan(registry.QUERIES["profile_top_values"](spark, SF_SMALL))
    assert "SortMergeJoin" not in p and "BroadcastHashJoin" in p
    # columns with many values are counted once, for the distinct counts; the other count keeps the small ones before its shuffle
    rows = [(2001, f"k{i}", "ab"[i % 2]) for i in range(300)] + [(2002, None, None), (2002, "x", "b")]
    vc = P.value_counts(spark.createDataFrame(rows, "shard_year int, many string, few string"))
    got = P.top_values(vc, P.column_stats(vc))
    assert sorted((r.shard_year, r.column, r.value, r.n, r["rank"]) for r in got.collect()) == [
        (2001, "few", "a", 150, 1), (2001, "few", "b", 150, 2), (2002, "few", "b", 1, 1), (2002, "many", "x", 1, 1)]


def test_distinct_counts_deal_rows_before_values(spark, no_threshold):
    from roadbook.plans import registry, registry_profile  # noqa: F401
    p = plan(registry.QUERIES["profile_distinct"](spark, SF_SMALL))
    assert "SortMergeJoin" not in p
    # below the unpivot: rows by all their columns, to a number of partitions that adaptive execution keeps
    assert "REPARTITION_BY_NUM" in p[p.index("Generate"):]
    rows = [(2001, "x", None)] * 400 + [(2001, f"k{i}", " ") for i in range(500)]
    stats = P.column_stats(P.value_counts(spark.createDataFrame(rows, "shard_year int, `a.b` string, c string")))
    assert {(r.column, r.rows, r.null_count, r.distinct_count) for r in stats.collect()} == {("a.b", 900, 0, 501), ("c", 900, 400, 1)}
