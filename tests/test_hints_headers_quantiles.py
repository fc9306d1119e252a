"""Rename hints by place and content, headers of many shards, quantiles of columns."""

import gzip
import math
import os
import random

import pytest
from pyspark.sql import functions as F

from roadbook.operators import analyses as X
from roadbook.sources import shards


def inventory(spark, by_year):
    return spark.createDataFrame([(y, c, i) for y, cols in by_year.items() for i, c in enumerate(cols)], "shard_year int, column string, ordinal int")


def hints(df):
    return {(r.old_column, r.new_column): r for r in df.collect()}


def test_renames_by_place(spark):
    inv = inventory(spark, {2021: ["CRN", "DEC_LAT", "DEC_LONG", "COUNTY", "SEV", "HOUR", "OLD"], 2022: ["CRN", "DEC_LAT", "DEC_LONG", "COUNTY", "SEV", "HOUR", "OLD"],
                            2023: ["CRN", "DEC_LATITUDE", "DEC_LONGITUDE", "COUNTY", "INJURY", "HOUR", "HOURS_2", "EXTRA"]})
    got = hints(X.rename_hints(inv))
    assert set(got) == {("DEC_LAT", "DEC_LATITUDE"), ("DEC_LONG", "DEC_LONGITUDE"), ("SEV", "INJURY")}
    assert got["DEC_LAT", "DEC_LATITUDE"].distance == 5 and got["DEC_LAT", "DEC_LATITUDE"].same_place
    assert got["SEV", "INJURY"].same_neighbours and got["SEV", "INJURY"].similarity is None
    assert X.rename_hints(inv.filter("shard_year < 2023")).count() == 0 and X.rename_hints(inv.limit(0)).count() == 0


def test_renames_by_content(spark):
    """Codes move to a column of another name at another place; the estimate lies near the exact similarity."""
    rng = random.Random(5)
    values = {"A_CODE": {f"v{k}" for k in range(300)}, "WHOLLY_OTHER": {f"v{k}" for k in range(40, 320)}, "NOISE": {f"n{k}" for k in range(200)},
              "FRESH": {f"f{k}" for k in range(150)}, "KEY": {f"k{k}" for k in range(500)}, "BLANK": {None}}
    years = {"A_CODE": 2020, "NOISE": 2020, "WHOLLY_OTHER": 2021, "FRESH": 2021, "BLANK": 2021}
    rows = [(c, v) for c, vs in values.items() for v in vs for _ in range(rng.randint(1, 3))]
    long = spark.createDataFrame(rows, "column string, value string")
    inv = inventory(spark, {2020: ["KEY", "A_CODE", "NOISE"], 2021: ["KEY", "X1", "FRESH", "X2", "BLANK", "WHOLLY_OTHER"]}).filter(~F.col("column").startswith("X"))
    assert set(years) < set(values)
    got = hints(X.rename_hints(inv, X.value_signatures(long)))
    exact = len(values["A_CODE"] & values["WHOLLY_OTHER"]) / len(values["A_CODE"] | values["WHOLLY_OTHER"])
    assert set(got) == {("A_CODE", "WHOLLY_OTHER")}
    assert abs(got["A_CODE", "WHOLLY_OTHER"].similarity - exact) < 0.2 and exact > 0.8


def test_headers_of_many_shards_in_one_job(spark, tmpdir_path):
    for k in range(60):
        text = f"﻿CRN,A{k % 3},CRN\n{k},x,y\n" if k % 2 else f'CRN,"B, {k % 2}"\r\n{k},z\r\n'
        name = f"CRASH_{2000 + k % 25}_{k}.csv"
        with (gzip.open(f"{tmpdir_path}/{name}.gz", "wt", encoding="utf-8", newline="") if k == 9 else open(f"{tmpdir_path}/{name}", "w", encoding="utf-8", newline="")) as f:
            f.write(text)
    open(f"{tmpdir_path}/EMPTY_2003.csv", "w").close()
    paths = [os.path.join(tmpdir_path, n) for n in os.listdir(tmpdir_path)]
    spark.sparkContext.setJobGroup("headers", "headers")
    lines = shards.header_lines(spark, paths)
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("headers")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(lines) == 61 and len(jobs) <= 2, jobs
    assert shards._names(lines[os.path.join(tmpdir_path, "EMPTY_2003.csv")]) == []
    assert shards._names(lines[f"{tmpdir_path}/CRASH_2001_1.csv"]) == ["CRN0", "A1", "CRN2"]
    assert shards._names(lines[f"{tmpdir_path}/CRASH_2009_9.csv.gz"]) == ["CRN0", "A0", "CRN2"]
    inv = shards.header_inventory(spark, shards.shard_discovery(shards.list_files(spark, tmpdir_path), "CRASH_2002", start=2000))
    assert {tuple(r) for r in inv.collect()} == {(2002, "B, 0", 1), (2002, "CRN", 0), (2002, "CRN0", 0), (2002, "A0", 1), (2002, "CRN2", 2)}
    assert shards.header_lines(spark, []) == {}


def test_headers_in_a_store_that_tasks_cannot_open(spark, tmpdir_path):
    with open(f"{tmpdir_path}/CRASH_2001.csv", "w") as f:
        f.write("CRN,A\n1,2\n")
    spark.sparkContext._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.hdr.link./in", f"file://{tmpdir_path}")
    path = "viewfs://hdr/in/CRASH_2001.csv"
    assert shards.header_lines(spark, [path]) == {path: "CRN,A"}


@pytest.mark.parametrize("options", [{}, {"k": 200, "margin": 0.02}, {"max_collect": 5}, {"k": 8, "margin": 0.0001}])
def test_column_quantiles(spark, options):
    rng = random.Random(11)
    rows = [(rng.random() * 100, float(rng.choice([1, 2, 2, 3])), 5.0, None, float(k) if k % 3 else float("nan"), k % 1000) for k in range(6000)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, e double, f int")
    probs = [0.0, 0.25, 0.5, 0.75, 1.0]
    got = {(r.field, r.p): r.value for r in X.column_quantiles(df, list("abcdef"), probs, **options).collect()}
    want = {}
    for i, c in enumerate("abcdef"):
        xs = sorted(float(r[i]) for r in rows if r[i] is not None and not math.isnan(r[i]))
        want |= {(c, p): xs[max(1, math.ceil(p * len(xs))) - 1] for p in probs if xs}
    assert got == want
    assert X.numeric_outliers(df.limit(0), ["a", "b"]).count() == 0
