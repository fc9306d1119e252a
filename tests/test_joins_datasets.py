from hypothesis import given, settings
from hypothesis import strategies as st

from roadbook.operators import datasets as D
from roadbook.operators.joins import fanout_left_join, join_suffixed


def test_null_keys_never_match_and_left_rows_survive(spark):
    left = spark.createDataFrame([("1", "a"), (None, "b"), ("2", "c")], "CRN string, x string")
    right = spark.createDataFrame([("1", 10), (None, 20), ("1", 11)], "CRN string, y int")
    out = sorted((r.x, r.y if r.y is not None else -1) for r in fanout_left_join(left, right, "CRN").collect())
    assert out == [("a", 10), ("a", 11), ("b", -1), ("c", -1)]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.one_of(st.none(), st.sampled_from("abc")), max_size=8),
       st.lists(st.one_of(st.none(), st.sampled_from("abcd")), max_size=12))
def test_fanout_left_join_equals_plain_left_join(spark, lkeys, rkeys):
    left = spark.createDataFrame([(k, i) for i, k in enumerate(lkeys)], "k string, li int")
    right = spark.createDataFrame([(k, i) for i, k in enumerate(rkeys)], "k string, ri int")
    a = sorted(map(tuple, fanout_left_join(left, right, "k").select("k", "li", "ri").collect()), key=str)
    b = sorted(map(tuple, left.join(right, "k", "left").select("k", "li", "ri").collect()), key=str)
    assert a == b


def test_suffix_on_clash(spark):
    left = spark.createDataFrame([("1", 5)], "CRN string, COUNTY int")
    right = spark.createDataFrame([("1", 7)], "CRN string, COUNTY int")
    r = join_suffixed(left, right, "CRN", "left", "_roadway").first()
    assert r.COUNTY == 5 and r.COUNTY_roadway == 7


def test_vehicle_summary_sorted_distinct_and_empty(spark):
    v = spark.createDataFrame([("1", "B", "2"), ("1", "A", "2"), ("1", "B", None), ("2", None, None), (None, "Z", "9")],
                              "CRN string, VEH_TYPE string, VEH_ROLE_CD string")
    out = {r.CRN: r for r in D.vehicle_summary(v).collect()}
    assert set(out) == {"1", "2"}
    assert out["1"].VEH_TYPE == "A, B" and out["1"].VEH_ROLE_CD == "2"
    assert out["2"].VEH_TYPE == "" and out["2"].VEH_ROLE_CD == ""


def test_crash_without_vehicles_keeps_row(spark):
    cw = spark.createDataFrame([("1", 1), ("2", 0)], "CRN string, PED_COUNT int")
    person = spark.createDataFrame([("1", "PEDESTRIAN")], "CRN string, PERSON_TYPE string")
    vehicle = spark.createDataFrame([("3", "A", "1")], "CRN string, VEH_TYPE string, VEH_ROLE_CD string")
    ped = D.pedestrian_dataset(cw, person, vehicle).collect()
    assert len(ped) == 1 and ped[0].PERSON_TYPE == "PEDESTRIAN" and ped[0].VEH_TYPE is None


def test_ped_count_column_detection(spark):
    assert D.ped_count_column(["CRN", "ped_count_total"]) == "ped_count_total"
    assert D.ped_count_column(["CRN"]) is None
    df = spark.createDataFrame([("1", "2"), ("2", "0"), ("3", "x")], "CRN string, PED_COUNT string")
    assert [r.CRN for r in D.filter_ped_count(df).collect()] == ["1"]


def test_cyclist_dataset_none_without_cycle(spark):
    cw = spark.createDataFrame([("1",)], "CRN string")
    assert D.cyclist_dataset(cw, None) is None
    summary = {r.dataset: r for r in D.dataset_run_summary({"cyclist": None, "crash": cw}).collect()}
    assert summary["cyclist"].status == "skipped" and summary["crash"].rows == 1


@settings(max_examples=12, deadline=None)
@given(st.lists(st.one_of(st.none(), st.sampled_from("abc")), max_size=8),
       st.lists(st.one_of(st.none(), st.sampled_from("abcd")), max_size=30))
def test_any_keys_equal_plain_left_join(spark, lkeys, rkeys):
    left = spark.createDataFrame([(k, i) for i, k in enumerate(lkeys)], "k string, li int")
    right = spark.createDataFrame([(k, i) for i, k in enumerate(rkeys)], "k string, ri int")
    got = fanout_left_join(left, right, "k")
    a = sorted(map(tuple, got.select("k", "li", "ri").collect()), key=str)
    b = sorted(map(tuple, left.join(right, "k", "left").select("k", "li", "ri").collect()), key=str)
    assert a == b


def test_join_small_starts_no_job_and_follows_the_threshold(spark):
    from roadbook.operators.joins import join_small
    big = spark.range(0, 100).withColumnRenamed("id", "k")
    small = spark.range(0, 50).withColumnRenamed("id", "k")
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan(join_small(big, small, "k", "inner"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" not in plan(join_small(big, small, "k", "inner"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_hot_right_key_of_a_left_join_is_split(spark):
    """A third of the right rows have one key: its partition is split, and the left side is shuffled once."""
    from pyspark.sql import functions as F
    left = spark.range(0, 5000).select(F.when(F.col("id") % 50 == 0, F.lit(None)).otherwise(F.col("id").cast("string")).alias("k"), F.col("id").alias("li"))
    right = spark.range(0, 30000, 1, 8).select(F.when(F.col("id") % 3 == 0, F.lit("7")).otherwise((F.col("id") % 4000).cast("string")).alias("k"),
                                               F.xxhash64("id").alias("ri"))
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
                "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
                "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    prev = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        out = fanout_left_join(left, right, "k").withColumn("p", F.spark_partition_id())
        where = [r["p"] for r in out.collect()]
        n, sizes = len(where), [where.count(p) for p in set(where)]
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in prev.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert n == left.join(right, "k", "left").count() == sum(sizes)
    assert "skew=true" in plan and "ReusedExchange" in plan
    assert max(sizes) < 0.2 * n        # the hot key alone holds a third


def test_left_side_null_key_skew_is_split_by_aqe(spark):
    from pyspark.sql import functions as F
    left = spark.range(0, 30000).select(F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise((F.col("id") % 5000).cast("string")).alias("k"),
                                        F.col("id").alias("li"))
    right = spark.range(0, 20000).select((F.col("id") % 5000).cast("string").alias("k"), F.col("id").alias("ri"))
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
                "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
                "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    prev = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        out = fanout_left_join(left, right, "k", right_unique=True)   # plain left join path
        n = len(out.collect())                                          # runs this plan, so it becomes final
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in prev.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert n == left.join(right, "k", "left").count()
    assert "skew=true" in plan


def test_inner_join_hot_right_key_is_split_by_aqe(spark):
    from pyspark.sql import functions as F

    from roadbook.operators.joins import join_suffixed
    left = spark.range(0, 5000).select(F.col("id").cast("string").alias("CRN"), F.col("id").alias("li"))
    right = spark.range(0, 30000).select(F.when(F.col("id") % 3 == 0, F.lit("7")).otherwise((F.col("id") % 5000).cast("string")).alias("CRN"),
                                         F.col("id").alias("ri"))
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
                "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
                "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    prev = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        out = join_suffixed(left, right, "CRN", "inner", "_cycle")      # J1's join
        n = len(out.collect())
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in prev.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert n == 30000
    assert "skew=true" in plan


def test_vehicle_summary_combines_map_side(spark):
    from pyspark.sql import functions as F
    v = spark.range(0, 20000).select(F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.col("id").cast("string")).alias("CRN"),
                                     (F.col("id") % 4).cast("string").alias("VEH_TYPE"), F.lit("1").alias("VEH_ROLE_CD"))
    out = D.vehicle_summary(v)
    rows = {r.CRN: r for r in out.collect()}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_collect_set" in plan                     # combined before the exchange
    assert rows["HOT"].VEH_TYPE == "0, 1, 2, 3"
