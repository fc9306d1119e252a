"""Figures from Parquet footers equal those of a scan."""

import os

import pyarrow as pa
import pyarrow.parquet as pq

from roadbook.operators.validate import val_completeness
from roadbook.sources import footers, sinks


def rows(df):
    return sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=str)


def test_completeness_equals_a_scan(spark, tmpdir_path):
    data = [(i, None if i % 3 == 0 else f"v {i}", None, [i] if i % 2 else None, ("a", None) if i % 5 else None, None if i % 4 == 0 else "p q" if i % 4 == 1 else "x:y")
            for i in range(200)]
    df = spark.createDataFrame(data, "id long, text string, nothing double, list array<long>, pair struct<a string, b string>, part string")
    for name, by in (("flat", None), ("by part", ["part"])):
        path = os.path.join(tmpdir_path, name)
        sinks.write_parquet(df, path, by)
        written = spark.read.parquet(path)
        assert rows(footers.completeness(spark, path)) == rows(val_completeness(written))
        assert rows(footers.catalog(spark, {name: path})) == rows(sinks.dataset_catalog(spark, {name: path}))


def test_only_what_footers_lack_is_scanned(spark, tmpdir_path, monkeypatch):
    table = pa.table({"a": [1, None, 3], "b": ["x", None, None], "dotted.name": [None, None, 1]})
    pq.write_table(table, os.path.join(tmpdir_path, "full.parquet"))
    pq.write_table(table, os.path.join(tmpdir_path, "lacking.parquet"), write_statistics=["a", "dotted.name"])
    pq.write_table(table.select(["a", "b"]).slice(0, 1), os.path.join(tmpdir_path, "older.parquet"))
    want = rows(val_completeness(spark.read.schema("a long, b string, `dotted.name` long").parquet(tmpdir_path)))
    counted = []
    real = footers.F.count
    monkeypatch.setattr(footers.F, "count", lambda c: counted.append(str(c)) or real(c))
    got = rows(footers.completeness(spark, os.path.join(tmpdir_path, "*.parquet")))
    assert [r for r in got if r[0] != "dotted.name"] == [r for r in want if r[0] != "dotted.name"]
    assert not any("`a`" in c for c in counted) and len(counted) <= 3


def test_datasets_without_rows(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "empty")
    spark.createDataFrame([], "a long, b string").write.parquet(path)
    assert rows(footers.completeness(spark, path)) == rows(val_completeness(spark.read.parquet(path)))
    assert [r[2:] for r in rows(footers.catalog(spark, {"e": path}))] and footers.catalog(spark, {"e": path}).first().records == 0
