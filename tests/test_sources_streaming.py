import io
import os
import zipfile

from pyspark.sql import functions as F

from roadbook.plans import fixtures as fx
from roadbook.plans import stages
from roadbook.sources import archives, observations, shards, sinks
from roadbook.streaming import crash_stream
from tests.conftest import SF_SMALL


def _write_shards(spark, root):
    """Yearly CSV shards derived from orders, with a drifting column set."""
    o = fx.shard_text(spark, SF_SMALL)
    for y in [r[0] for r in o.select("shard_year").distinct().collect()]:
        part = o.filter(F.col("shard_year") == y).drop("shard_year")
        if y <= 1996:
            part = part.drop("o_orderpriority")
        if y > 1997:
            part = part.drop("o_old")
        name = f"CRASH_PHILADELPHIA_{y}.csv" if y % 2 else f"CRASH_{y}.csv"
        tmp = os.path.join(root, "stage", str(y))
        part.coalesce(1).write.option("header", True).csv(tmp)
        src = [f for f in os.listdir(tmp) if f.endswith(".csv")][0]
        os.rename(os.path.join(tmp, src), os.path.join(root, name))
    return o


def test_csv_shards_roundtrip(spark, tmpdir_path):
    o = _write_shards(spark, tmpdir_path)
    files = shards.list_files(spark, tmpdir_path, "*.csv")
    found = shards.shard_discovery(files, "CRASH", 1990, 2030).collect()
    assert len(found) == 7 and sorted(r.year for r in found) == list(range(1995, 2002))
    matched = shards.match_shards(files, ["CRASH"], range(1995, 2002))
    assert matched.count() == 7
    missing = shards.missing_shards(files, ["CRASH", "PERSON"], range(1995, 2002))
    assert {r.category for r in missing.collect()} == {"PERSON"}
    text, inv = shards.read_text_shards(spark, matched)
    assert text.count() == o.count()
    assert inv.filter((F.col("column") == "o_orderpriority") & (F.col("shard_year") <= 1996)).count() == 0
    assert shards.shard_completeness(files, 1997, ["CRASH", "CYCLE"]).collect()[0].category == "CYCLE"
    sample = shards.scan_sample(spark, [r.path for r in matched.collect()], n=3)
    assert sample.count() == 21


def test_year_from_name(spark):
    df = spark.createDataFrame([("CRASH_2019.csv",), ("X_2005_2010.csv",), ("none.csv",)], "n string")
    assert [r[0] for r in df.select(shards.year_from_name("n")).collect()] == [2019, 2005, None]


def test_zip_archives(spark, tmpdir_path):
    good = io.BytesIO()
    with zipfile.ZipFile(good, "w") as z:
        z.writestr("CRASH_2020.csv", "CRN,COUNTY\n1,51\n2,67\n")
        z.writestr("PERSON_2020.csv", "CRN,PERSON_TYPE\n1,PEDESTRIAN\n")
    with open(os.path.join(tmpdir_path, "archive_2020.zip"), "wb") as f:
        f.write(good.getvalue())
    with open(os.path.join(tmpdir_path, "archive_2021.zip"), "wb") as f:
        f.write(b"not a zip")
    lines = archives.expand_archives(spark, tmpdir_path)
    assert lines.filter(F.col("error").isNotNull()).count() == 1
    rows, inv, errors = archives.member_frames(lines)
    assert errors.count() == 1
    crash = rows.filter(F.col("member") == "CRASH_2020.csv").select("CRN", "COUNTY", "shard_year").collect()
    assert sorted(map(tuple, crash)) == [("1", "51", 2020), ("2", "67", 2020)]
    assert inv.count() == 4


def test_damaged_and_equally_named_members(spark):
    """Two archives with one member name and unlike headers; a checksum that differs; a line break inside quotes."""
    def zipped(members):
        data = io.BytesIO()
        with zipfile.ZipFile(data, "w") as z:
            for name, text in members:
                z.writestr(name, text)
        return data.getvalue()

    bad = bytearray(zipped([("CRASH_2020.csv", "CRN,A\n" + "1,xyz\n" * 200), ("PERSON_2020.csv", "CRN\n9\n")]))
    bad[60] ^= 1                                   # inside the first member's stored data
    content = [("a.zip", zipped([("CRASH_2020.csv", 'CRN,A\n1,"x\ny, ""z"""\n')])), ("b.zip", zipped([("CRASH_2020.csv", "A,CRN\n7,2\n")])), ("c.zip", bytes(bad))]
    lines = archives.expand_content(spark.createDataFrame([(p, bytearray(c)) for p, c in content], "path string, content binary"))
    rows, inv, errors = archives.member_frames(lines)
    got = sorted((r.archive, r.member, r.CRN, r.A) for r in rows.collect())
    assert got == [("a.zip", "CRASH_2020.csv", "1", 'x\ny, "z"'), ("b.zip", "CRASH_2020.csv", "2", "7"), ("c.zip", "PERSON_2020.csv", "9", None)]
    assert [(r.archive, r.member) for r in errors.collect()] == [("c.zip", "CRASH_2020.csv")]
    assert inv.count() == 5


def test_shards_are_read_without_loss(spark, tmpdir_path):
    """Spaces, percent signs, plus signs and letters outside ASCII in paths; quoted line breaks; part files; files left out."""
    def put(path, text):
        os.makedirs(os.path.dirname(os.path.join(tmpdir_path, path)), exist_ok=True)
        with open(os.path.join(tmpdir_path, path), "w", encoding="utf-8") as f:
            f.write(text)

    put("with space/CRASH_2010.csv", 'a,b\n1,"x\ny"\n2,"q ""z"""\n')
    put("pct%20x/CRASH_2011.csv", "a,b\n1,2\n2,3\n")
    put("ü+é/CRASH_2012.csv", "a\n1\n2\n")
    put("br[1]{x}/CRASH_2013.csv", "a\n1\n2\n")
    put("f/CRASH_2014.csv/part-0.csv", "a,b\n" + "1,1\n" * 3)
    put("f/CRASH_2014.csv/part-1.csv", "a,b\n" + "".join(f"{i},7\n" for i in range(50)))
    for name in ("CRASH_2031.csv", "CRASHX2015.csv", "other.csv"):
        put(name, "a\n1\n")
    files = shards.list_files(spark, tmpdir_path, "*.csv")
    matched = shards.match_shards(files, ["CRASH"], range(2005, 2025))
    text, _ = shards.read_text_shards(spark, matched)
    rows = text.collect()
    assert {y: sum(r.shard_year == y for r in rows) for y in range(2010, 2015)} == {2010: 2, 2011: 2, 2012: 2, 2013: 2, 2014: 53}
    assert sorted(r.b for r in rows if r.shard_year == 2010) == ['q "z"', "x\ny"]
    left_out = {r.file_name: r.reason for r in shards.quarantine(files, ["CRASH"], range(2005, 2025)).collect()}
    assert left_out == {"CRASH_2031.csv": "year not configured", "CRASHX2015.csv": "name matches no pattern", "other.csv": "no known category"}
    sample = shards.scan_sample(spark, [r.path for r in matched.collect()], n=10)
    taken = [r.a for r in sample.collect() if r["_file"] == "CRASH_2014.csv"]
    assert sorted(taken) == sorted(["1"] * 3 + [str(i) for i in range(7)])
    from roadbook.plans.pipeline import profile_and_harmonize
    out = profile_and_harmonize(spark, tmpdir_path, "CRASH", range(2005, 2025), sample_rows=10)
    assert {(r.shard_year, r.rows) for r in out["column_stats"].collect() if r.column == "a"} == {(2010, 2), (2011, 2), (2012, 2), (2013, 2), (2014, 10)}
    assert out["quarantine"].count() == 3


def test_a_row_of_an_unlisted_file_fails(spark, tmpdir_path):
    import pytest
    with open(os.path.join(tmpdir_path, "CRASH_2010.csv"), "w") as f:
        f.write("a\n1\n")
    matched = shards.match_shards(shards.list_files(spark, tmpdir_path, "*.csv"), ["CRASH"], [2010])
    text, _ = shards.read_text_shards(spark, matched.withColumn("path", F.regexp_replace("path", "^file:/", "file:///")))
    with pytest.raises(Exception, match="not in the list of shards"):
        text.collect()


def test_checkpoint_folder_is_required_on_a_cluster(spark):
    from types import SimpleNamespace

    import pytest

    from roadbook.session import checkpoint_dir
    cluster = SimpleNamespace(conf=SimpleNamespace(get=lambda k, d=None: None),
                              sparkContext=SimpleNamespace(getCheckpointDir=lambda: None, master="local-cluster[2,1,1024]"))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_dir(cluster)


def test_observation_pages(spark, tmpdir_path):
    page = ('{"metadata": {"resultset": {"offset": 1, "count": 3, "limit": 1000}}, "results": ['
            '{"date": "2023-01-01T00:00:00", "datatype": "TMAX", "station": "S", "attributes": ",,W,", "value": 56},'
            '{"date": "2023-01-01T00:00:00", "datatype": "PRCP", "station": "S", "attributes": ",,W,", "value": 3.0}]}')
    with open(os.path.join(tmpdir_path, "page1.json"), "w") as f:
        f.write(page)
    long = observations.read_observation_pages(spark, tmpdir_path)
    assert long.count() == 2
    from roadbook.operators.weather import weather_daily
    w = weather_daily(long, order_col="obs_index").first()
    assert w.temp_max_c == 5.6 and w.precipitation_mm == 3.0


def test_sinks_and_catalog(spark, tmpdir_path):
    cw = stages.crash_weather(spark, SF_SMALL)
    p = os.path.join(tmpdir_path, "cw")
    sinks.write_parquet(cw, p, partition_by=["CRASH_YEAR"])
    sinks.write_csv(cw.limit(5), os.path.join(tmpdir_path, "cw_csv"))
    cat = sinks.dataset_catalog(spark, {"crash_weather": p}).first()
    assert cat.records == cw.count() and cat.fields == len(cw.columns) and cat.size_mb > 0
    sinks.write_json_report(cat and spark.createDataFrame([cat]), os.path.join(tmpdir_path, "report"))


def test_stream_matches_batch(spark, tmpdir_path):
    crash = fx.crash(spark, SF_SMALL)
    src = os.path.join(tmpdir_path, "in")
    crash.repartition(3).write.parquet(src)
    weather = stages.weather_table(spark, SF_SMALL)
    stream = crash_stream.crash_weather_stream(spark, src, crash.schema, weather, max_files_per_trigger=1)
    out = os.path.join(tmpdir_path, "out")
    q = crash_stream.start(stream, out, name="t")
    q.awaitTermination(120)
    got = spark.read.parquet(out)
    want = stages.crash_weather(spark, SF_SMALL)
    assert got.count() == want.count()
    assert got.select(sorted(want.columns)).exceptAll(want.select(sorted(want.columns))).count() == 0


def test_text_summary_and_cluster_conf(spark, tmpdir_path):
    from roadbook.session import cluster_conf
    issues = spark.createDataFrame([("CRASH", "dtype_changes", "A,B", 2)], "category string, issue string, columns string, n_columns long")
    p = os.path.join(tmpdir_path, "summary")
    sinks.write_text_summary(issues, p)
    text = "".join(open(os.path.join(p, f)).read() for f in os.listdir(p) if f.startswith("part-"))
    assert text.strip() == "CRASH: dtype_changes (2): A,B"
    conf = cluster_conf(total_input_bytes=100 * 1024 ** 4, executors=1000)
    assert 8000 <= int(conf["spark.sql.shuffle.partitions"]) <= 65536
    assert conf["spark.sql.adaptive.skewJoin.enabled"] == "true"


def test_csv_shards_harmonize_like_the_text_fixture(spark, tmpdir_path):
    from roadbook.operators.harmonize import harmonize_text_shards
    from roadbook.operators.profile import column_stats, value_counts
    _write_shards(spark, tmpdir_path)
    files = shards.list_files(spark, tmpdir_path, "*.csv")
    matched = shards.match_shards(files, ["CRASH"], range(1995, 2002))
    text, inv = shards.read_text_shards(spark, matched)
    from_files = harmonize_text_shards(text, inv, processing_date="t").drop("PROCESSING_DATE")
    fixture = harmonize_text_shards(fx.shard_text(spark, SF_SMALL), fx.shard_inventory(spark, SF_SMALL),
                                    processing_date="t").drop("PROCESSING_DATE")
    assert from_files.dtypes == fixture.dtypes
    assert from_files.exceptAll(fixture).count() == 0 and fixture.exceptAll(from_files).count() == 0
    a = column_stats(value_counts(text, "shard_year", inv)).drop("null_pct")
    b = column_stats(value_counts(fx.shard_text(spark, SF_SMALL), "shard_year", fx.shard_inventory(spark, SF_SMALL))).drop("null_pct")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_completeness_matches_names_case_insensitively(spark):
    files = spark.createDataFrame([("/x/crash_2020.csv", "crash_2020.csv", 1), ("/x/Person_2020.CSV", "Person_2020.CSV", 1),
                                   ("/x/TRAILVEH_2020.csv", "TRAILVEH_2020.csv", 1)], "path string, file_name string, length long")
    missing = {r.category for r in shards.shard_completeness(files, 2020).collect()}
    assert missing == {"COMMVEH", "CYCLE", "FLAG", "ROADWAY", "VEHICLE"}


def test_stream_from_csv_text_matches_batch(spark, tmpdir_path):
    from pyspark.sql.types import StringType, StructField, StructType
    crash = fx.crash(spark, SF_SMALL)
    src = os.path.join(tmpdir_path, "csv_in")
    crash.repartition(2).write.option("header", True).csv(src)
    schema = StructType([StructField(c, StringType()) for c in crash.columns])
    weather = stages.weather_table(spark, SF_SMALL)
    out = os.path.join(tmpdir_path, "csv_out")
    q = crash_stream.start(crash_stream.crash_weather_stream(spark, src, schema, weather, fmt="csv"), out, name="csv")
    q.awaitTermination(120)
    got = spark.read.parquet(out).select("CRN", "crash_date", "date_approximation_method", "precip_category",
                                         "COORD_QUALITY_FLAG", "DEC_LATITUDE")
    want = stages.crash_weather(spark, SF_SMALL).select(*got.columns)
    assert got.count() == want.count()
    assert got.exceptAll(want).count() == 0


def test_partitioned_write_is_rebalanced(spark, tmpdir_path):
    from pyspark.sql import functions as F
    df = spark.range(0, 20000).select((F.when(F.col("id") % 3 == 0, 2020).otherwise(F.col("id") % 7 + 2000)).alias("y"),
                                      F.col("id"))
    p = os.path.join(tmpdir_path, "by_year")
    sinks.write_parquet(df, p, partition_by=["y"])
    back = spark.read.parquet(p)
    assert back.count() == 20000 and back.filter(F.col("y") == 2020).count() == df.filter(F.col("y") == 2020).count()
    plan = df.hint("rebalance", "y")._jdf.queryExecution().executedPlan().toString()
    assert "REBALANCE" in plan.upper()
