"""Date formats of text columns against plain Python."""

import re
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from roadbook.operators import date_types as DT

PARSE = {"yyyy-MM-dd": "%Y-%m-%d", "yyyy/MM/dd": "%Y/%m/%d", "MM/dd/yyyy": "%m/%d/%Y", "dd/MM/yyyy": "%d/%m/%Y", "MM-dd-yyyy": "%m-%d-%Y",
         "dd.MM.yyyy": "%d.%m.%Y", "yyyyMMdd": "%Y%m%d"}
TEXTS = ["2011-03-04", " 2011-3-4 ", "2011-02-30", "2012-02-29", "2011-02-29", "03/25/2011", "25/03/2011", "03/04/2011", "12.01.1999", "31.04.1999",
         "2011/12/31", "13-01-2011", "01-13-2011", "20110304", "20111304", "21110304", "18991231", "201103041", "2011-03-04 08:30:00", "2011-03-04T08:30:00Z",
         "03/25/2011 08:30 PM", "", " ", None, "0000-01-01", "2011-00-10", "11-03-04", "x2011-03-04", "2011-03-04x", "9" * 5000, "2011-03-04\n"]


def plainly(text, name):
    t = (text or "").strip()
    if name != "yyyyMMdd":
        t = re.sub(r"[T ]\d{1,2}:\d{2}(:\d{2})?( [AP]M)?Z?$", "", t)
    elif not re.fullmatch(r"(19|20)\d{6}", t):
        return None
    if name != "yyyyMMdd" and not re.search(r"(^\d{4}\D)|(\D\d{4}$)", t):
        return None
    try:
        return datetime.strptime(t, PARSE[name]).date()
    except ValueError:
        return None


@pytest.mark.parametrize("name", list(DT.FORMATS))
def test_single_values(spark, name):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "i int, t string")
    got = {r.i: r.d for r in df.select("i", DT.date_in("t", name).alias("d")).collect()}
    assert got == {i: plainly(t, name) for i, t in enumerate(TEXTS)}


def shards(spark):
    rows = [(2001, "2001-05-01", "01/02/2001", "20010101", "5", None, "2001-01-01"), (2001, "2001-05-31", "03/04/2001", "20010131", "6", None, None),
            (2002, "05/31/2002", "25/03/2002", "20020228", "7", " ", "soon"), (2002, "", "01/02/2002", "20021231", "x", None, "2002-01-01"),
            (2003, None, None, "20030101", "8", "01/02/2003", "2003-02-30")]
    df = spark.createDataFrame(rows, "shard_year int, a string, b string, c string, n string, late string, `mixed.up` string")
    inv = df.select("shard_year").distinct().select("shard_year", F.explode(F.array(*[F.lit(c) for c in df.columns[1:]])).alias("column"))
    return df, inv


def test_formats_by_shard(spark):
    df, inv = shards(spark)
    evidence = DT.date_evidence(df, inventory=inv)
    assert evidence.count() == 3 * 6 * len(DT.FORMATS)
    formats = DT.date_formats(evidence)
    got = {(r.shard_year, r.column): (r.format, r.fits, r.filled, r.ambiguous) for r in formats.collect()}
    assert got == {(2001, "a"): ("yyyy-MM-dd", 2, 2, False), (2002, "a"): ("MM/dd/yyyy", 1, 1, False),
                   # 2001 alone could be either; 2002 says day first
                   (2001, "b"): ("dd/MM/yyyy", 2, 2, False), (2002, "b"): ("dd/MM/yyyy", 2, 2, False),
                   (2001, "c"): ("yyyyMMdd", 2, 2, False), (2002, "c"): ("yyyyMMdd", 2, 2, False), (2003, "c"): ("yyyyMMdd", 1, 1, False),
                   (2003, "late"): ("MM/dd/yyyy", 1, 1, True), (2001, "mixed.up"): ("yyyy-MM-dd", 1, 1, False)}
    assert {r.column for r in DT.date_columns(evidence, formats).collect()} == {"a", "b", "c", "late"}
    half = DT.date_formats(evidence, share=0.5)
    assert (2002, "mixed.up") in {(r.shard_year, r.column) for r in half.collect()}


def test_harmonized_types_and_values(spark):
    df, inv = shards(spark)
    out = DT.harmonize_with_dates(df, inv, processing_date="x")
    assert dict(out.dtypes) == {"DATA_YEAR": "int", "a": "date", "b": "date", "c": "date", "late": "date", "mixed.up": "string", "n": "string",
                                "PROCESSING_DATE": "string"}
    got = sorted((r.DATA_YEAR, str(r.a), str(r.b), str(r.c), str(r.late)) for r in out.collect())
    assert got == [(2001, "2001-05-01", "2001-02-01", "2001-01-01", "None"), (2001, "2001-05-31", "2001-04-03", "2001-01-31", "None"),
                   (2002, "2002-05-31", "2002-03-25", "2002-02-28", "None"), (2002, "None", "2002-02-01", "2002-12-31", "None"),
                   (2003, "None", "None", "2003-01-01", "2003-01-02")]


def test_no_rows_and_no_dates(spark):
    df, inv = shards(spark)
    none = DT.harmonize_with_dates(df.limit(0), inv.limit(0))
    assert none.count() == 0 and set(none.columns) == {*df.columns[1:], "DATA_YEAR", "PROCESSING_DATE"}
    numbers = df.select("shard_year", "n")
    assert dict(DT.harmonize_with_dates(numbers, inv.where("column = 'n'")).dtypes)["n"] == "string"
    assert DT.cast_dates(spark.createDataFrame([(1, "2001-01-01")], "shard_year int, d string"), {"d": {2: "yyyy-MM-dd"}}).first().d is None
    assert isinstance(DT.cast_dates(spark.createDataFrame([(2, "2001-01-01")], "shard_year int, d string"), {"d": {2: "yyyy-MM-dd"}}).first().d, date)


@pytest.mark.parametrize("name", list(DT.FORMATS))
def test_a_pattern_runs_twice_per_value(spark, name):
    """Once to see whether a text fits, once for its parts; each part's uses ran it again before."""
    p = spark.range(1).select(F.col("id").cast("string").alias("t")).select(DT.date_in("t", name).alias("d"))
    text = p._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("RLIKE") + text.count("regexp_") == 2


def test_casts_run_two_patterns_per_format(spark):
    df = spark.range(1).select(F.col("id").cast("int").alias("shard_year"), F.col("id").cast("string").alias("d"))
    p = DT.cast_dates(df, {"d": {1: "yyyy-MM-dd", 2: "MM/dd/yyyy", 3: "dd.MM.yyyy"}})._jdf.queryExecution().optimizedPlan().toString()
    assert p.count("RLIKE") + p.count("regexp_") == 6


def test_text_of_one_row_group_is_made_by_many_tasks(spark, tmp_path):
    """A Parquet row group is read by one task, and all work on its texts was that task's too."""
    from roadbook.plans import fixtures as fx

    spark.range(4000).selectExpr("id o_orderkey", "timestamp_seconds(700000000 + id * 50000) o_orderdate").coalesce(1).write.parquet(
        str(tmp_path / "orders.parquet"))
    df = fx.dated_text(spark, str(tmp_path))
    tasks = df.groupBy(F.spark_partition_id().alias("task")).count().collect()
    assert len(tasks) == int(spark.conf.get("spark.sql.shuffle.partitions")) > 1
    assert max(r["count"] for r in tasks) < 2 * 4000 / len(tasks) and df.select("crn").distinct().count() == 4000


@pytest.mark.parametrize("name", list(DT.FORMATS))
def test_no_date_is_kept_from_its_pattern(spark, name):
    more = [f"{s}{t}{s}" for t in TEXTS if t for s in ("\t", " \n", "\x0b", "\f\r", "    ")] + ["1-2-2011", "01-2-2011", "2011-1-2", "1/2/2011", "1.2.2011 1:02"]
    df = spark.createDataFrame([(t,) for t in TEXTS + more], "t string")
    kept = df.where(F.col("t").rlike(DT.FORMATS[name][0]) & ~F.coalesce(DT._may_hold(F.col("t"), name), F.lit(False)))
    assert kept.collect() == []


@pytest.mark.parametrize("name", list(DT.FORMATS))
def test_months_above_12_are_not_cast(spark, name):
    """Their cast builds and drops an exception for each value; half the days of the other order were such."""
    year, month, day = name.replace("yyyy", "2011"), "MM", "dd"
    texts = [(year.replace(month, m).replace(day, d),) for m, d in (("13", "01"), ("00", "01"), ("01", "32"), ("01", "00"), ("12", "31"), ("01", "01"))]
    fit = [r.t for r in spark.createDataFrame(texts, "t string").where(F.col("t").rlike(DT.FORMATS[name][0])).collect()]
    assert sorted(fit) == sorted(t for t, in texts[4:])
