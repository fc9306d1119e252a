"""Profiles that add up, and harmonized years kept up to date."""

import os
import random
import shutil

import pytest
from pyspark.sql import functions as F

from roadbook.operators import harmonize as H
from roadbook.operators import profile as P
from roadbook.operators import sketches as K
from roadbook.sources import increments as I
from roadbook.sources import shards as S
from roadbook.sources import sinks

FIGURES = ["rows", "null_count", "null_pct", "dtype", "logical_type", "min", "max"]


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=str)


@pytest.fixture(scope="module")
def text(spark):
    rng = random.Random(3)
    data = [(2000 + i % 3, str(rng.randrange(5000)), rng.choice(["a", "b", "c", None]), "07" if i % 50 == 0 else str(i % 9), None, f"{rng.random():.3f}")
            for i in range(9000)]
    return spark.createDataFrame(data, "shard_year int, key string, code string, padded string, nothing string, part string")


def test_sketches_equal_the_exact_profile(spark, text, tmpdir_path):
    path = os.path.join(tmpdir_path, "s")
    sinks.write_parquet(K.shard_sketches(text), path, ["shard_year"])
    stored = spark.read.parquet(path)
    vc = P.value_counts(text)
    exact = P.column_stats(vc)
    assert rows(K.figures(stored), "shard_year", "column", *FIGURES) == rows(exact, "shard_year", "column", *FIGURES)
    both = K.figures(stored).join(exact.select("shard_year", "column", F.col("distinct_count").alias("true")), ["shard_year", "column"])
    for r in both.collect():
        assert abs(r.distinct_count - r.true) <= 0.07 * r.true and (not r.distinct_exact or r.distinct_count == r.true)
    top = ["shard_year", "column", "value", "n", "rank"]
    assert rows(K.top_values(stored), *top) == rows(P.top_values(vc, exact), *top)


def test_merged_sketches_equal_a_profile_of_all_years(spark, text):
    one = text.withColumn("shard_year", F.lit(0))
    vc = P.value_counts(one)
    exact, got = P.column_stats(vc), K.merged(K.shard_sketches(text), ["column"])
    assert rows(K.figures(got), "column", *FIGURES) == rows(exact, "column", *FIGURES)
    assert rows(K.top_values(got), "column", "value", "n", "rank") == rows(P.top_values(vc, exact), "column", "value", "n", "rank")
    true = {r.column: r.distinct_count for r in exact.collect()}
    for r in K.figures(got).collect():
        assert abs(r.distinct_count - true[r.column]) <= 0.07 * true[r.column]
    with pytest.raises(ValueError):
        K.top_values(got, max_distinct=90)


def test_sketches_of_nothing(spark):
    none = spark.createDataFrame([], "shard_year int, a string")
    assert K.shard_sketches(none).count() == 0 and K.figures(K.merged(K.shard_sketches(none), ["column"])).count() == 0
    listed = spark.createDataFrame([(2001, "a")], "shard_year int, column string")
    r = K.figures(K.shard_sketches(none, inventory=listed)).first()
    assert (r.rows, r.null_count, r.distinct_count, r.null_pct, r.logical_type) == (0, 0, 0, None, "null")
    assert K.top_values(K.shard_sketches(none, inventory=listed)).count() == 0


def land(root, year, header, lines):
    with open(os.path.join(root, f"CRASH_{year}.csv"), "w") as f:
        f.write("\n".join([header, *lines]) + "\n")


def data_files(out):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(f"{out}/data") for f in names if f.endswith(".parquet")}


def run(spark, root, out, day):
    return I.harmonize_changed(spark, root, "CRASH", out, range(2001, 2007), processing_date=day)


def same_as_full(spark, root, out):
    text, inventory = S.read_text_shards(spark, S.match_shards(S.list_files(spark, root, "*.csv"), ["CRASH"], range(2001, 2007)))
    full, got = H.harmonize_text_shards(text, inventory).drop("PROCESSING_DATE"), I.read_harmonized(spark, out).drop("PROCESSING_DATE")
    assert got.dtypes == full.dtypes
    assert rows(got, *[f"`{c}`" for c in got.columns]) == rows(full, *[f"`{c}`" for c in full.columns])


@pytest.fixture()
def landed(spark, tmpdir_path):
    root, out = os.path.join(tmpdir_path, "in"), os.path.join(tmpdir_path, "out")
    os.makedirs(root)
    land(root, 2001, "CRN,HOUR,OLD", ["1,5,x", "2,,y"])
    land(root, 2002, "CRN,HOUR", ["3,7", "4,8"])
    land(root, 2003, "CRN,HOUR,SPEED", ["5,9,30"])
    assert run(spark, root, out, "d1") == {2001: "new", 2002: "new", 2003: "new"}
    same_as_full(spark, root, out)
    return root, out


def test_one_changed_year_rewrites_one_partition(spark, landed):
    root, out = landed
    before = data_files(out)
    assert run(spark, root, out, "d2") == {2001: "same", 2002: "same", 2003: "same"} and data_files(out) == before
    land(root, 2002, "CRN,HOUR", ["3,7", "4,11", "6,1"])
    assert run(spark, root, out, "d3") == {2001: "same", 2002: "changed", 2003: "same"}
    kept = {f for f in data_files(out).items() if "=2002" not in f[0]}
    assert kept == {f for f in before.items() if "=2002" not in f[0]}
    same_as_full(spark, root, out)
    dates = I.read_harmonized(spark, out).groupBy("DATA_YEAR").agg(F.collect_set("PROCESSING_DATE").alias("d"))
    assert {r.DATA_YEAR: r.d for r in dates.collect()} == {2001: ["d1"], 2002: ["d3"], 2003: ["d1"]}
    assert rows(K.figures(I.read_sketches(spark, out)).filter("column = 'CRN'"), "shard_year", "rows") == [(2001, 2), (2002, 3), (2003, 1)]


def test_types_columns_and_years_that_come_and_go(spark, landed):
    root, out = landed
    land(root, 2004, "CRN,HOUR,SPEED,NEW", ["7,1,31.5,q"])          # SPEED turns from long to double; only 2003 has it
    assert run(spark, root, out, "d2") == {2001: "same", 2002: "same", 2003: "retyped", 2004: "new"}
    same_as_full(spark, root, out)
    shutil.move(os.path.join(root, "CRASH_2004.csv"), os.path.join(root, "later.txt"))
    assert run(spark, root, out, "d3")[2003] == "retyped"
    assert I.read_harmonized(spark, out).columns == ["DATA_YEAR", "CRN", "HOUR", "OLD", "SPEED", "PROCESSING_DATE"]
    same_as_full(spark, root, out)
    land(root, 2004, "CRN,OLD,NEW", ["8,5,1"])                      # NEW is back as a number
    land(root, 2002, "CRN,HOUR", [])                                # a header without rows
    assert run(spark, root, out, "d4") == {2001: "same", 2002: "changed", 2003: "same", 2004: "new"}
    same_as_full(spark, root, out)
    land(root, 2003, "CRN,HOUR,SPEED", ["abc,9,30"])                # CRN turns into text everywhere
    assert set(run(spark, root, out, "d5").values()) == {"changed", "retyped"}
    same_as_full(spark, root, out)
    for y in range(2001, 2005):
        shutil.move(os.path.join(root, f"CRASH_{y}.csv"), os.path.join(root, f"gone-{y}.txt"))
    assert set(run(spark, root, out, "d6").values()) == {"gone"}
    assert I.read_harmonized(spark, out).count() == 0 and run(spark, root, out, "d7") == {}


@pytest.mark.parametrize("failing", ["data", "sketches"])
def test_a_run_that_fails_is_done_again(spark, landed, monkeypatch, failing):
    root, out = landed
    old = rows(I.read_harmonized(spark, out), "DATA_YEAR", "CRN", "HOUR", "OLD", "SPEED", "PROCESSING_DATE")
    land(root, 2002, "CRN,HOUR", ["9,9"])
    land(root, 2004, "CRN,SPEED", ["10,fast"])                      # SPEED turns into text
    real = sinks.write_parquet

    def write(df, path, *args, **kwargs):
        if os.path.basename(path) == failing:
            raise RuntimeError("lost")
        real(df, path, *args, **kwargs)

    monkeypatch.setattr(I.sinks, "write_parquet", write)
    with pytest.raises(RuntimeError, match="lost"):
        run(spark, root, out, "d2")
    monkeypatch.undo()
    if failing == "data":
        assert rows(I.read_harmonized(spark, out), "DATA_YEAR", "CRN", "HOUR", "OLD", "SPEED", "PROCESSING_DATE") == old
    again = run(spark, root, out, "d3")
    assert again[2001] == "same" and again[2002] == "changed"
    same_as_full(spark, root, out)
    assert set(run(spark, root, out, "d4").values()) == {"same"}
