"""Completeness and catalog of written datasets from Parquet footers (V8, K5).

Row counts, null counts and file sizes stand in the footer of each file, so
they need no data page: tasks open the files of a dataset and read their
footers. Columns whose null counts some footer lacks (nested ones, or files of
writers that leave statistics out) are counted by a scan of these columns only.

Cases: a column that a file lacks is NULL in all its rows; partition columns
stand in the paths (``__HIVE_DEFAULT_PARTITION__`` is NULL); where tasks can't
open the store, the whole dataset is scanned instead; a dataset without rows
has 0 for every count and a NULL percentage.
"""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadbook.operators.validate import _pct

FOOTER = "path string, bytes long, rows long, column string, non_null long"
NO_PARTITION = "__HIVE_DEFAULT_PARTITION__"         # fixed value: how Spark writes a NULL partition value


def _null_counts(meta, schema) -> dict[str, int | None]:
    """Nulls of each top-level column of a file; None where the footer doesn't say."""
    nulls: dict[str, int | None] = dict.fromkeys(schema.names)
    for i in range(meta.num_columns):
        leaf = meta.schema.column(i)
        if leaf.path not in nulls or leaf.max_repetition_level or leaf.max_definition_level > 1:
            continue            # inside a nested column
        groups = [meta.row_group(g) for g in range(meta.num_row_groups)]
        stats = [g.column(i).statistics for g in groups if g.num_rows]
        if all(s is not None and s.has_null_count for s in stats):
            nulls[leaf.path] = sum(s.null_count for s in stats)
    return nulls


def _read_footers(batches):
    """Rows of ``FOOTER`` per file: one with a null column for the file itself, one per column in it."""
    import pandas as pd
    import pyarrow as pa
    import pyarrow.parquet as pq

    from roadbook.sources.stores import located

    for pdf in batches:
        rows = []
        for path in pdf["path"]:
            try:
                system, own = located(path)
            except (pa.ArrowInvalid, OSError, ImportError):
                rows.append((path, None, None, None, None))
                continue
            with system.open_input_file(own) as f:
                bytes_, file = f.size(), pq.ParquetFile(f)
                meta, n = file.metadata, file.metadata.num_rows
                rows.append((path, bytes_, n, None, None))
                counts = _null_counts(meta, file.schema_arrow)
                rows += [(path, bytes_, n, column, None if nulls is None else n - nulls) for column, nulls in counts.items()]
                parts = [p.split("=", 1) for p in path.split("/")[:-1] if "=" in p]
                rows += [(path, bytes_, n, unquote(k), 0 if v == NO_PARTITION else n) for k, v in parts if unquote(k) not in counts]
        yield pd.DataFrame({c: pd.Series([r[i] for r in rows], dtype=t) for i, (c, t) in enumerate(
            [("path", object), ("bytes", "Int64"), ("rows", "Int64"), ("column", object), ("non_null", "Int64")])})


def footers(df: DataFrame) -> DataFrame:
    """Footer figures of the files that a plain read of a dataset (``spark.read.parquet``) covers."""
    spark = df.sparkSession
    files = [(unquote(p),) for p in sorted(df.inputFiles())]          # file names are metadata
    tasks = max(1, min(len(files), 8 * spark.sparkContext.defaultParallelism))
    return spark.createDataFrame(files, "path string").repartition(tasks).mapInPandas(_read_footers, FOOTER)


def completeness(spark: SparkSession, path: str) -> DataFrame:
    """V8 of a written dataset: (column, non_null, completeness_pct), from footers as far as they say."""
    df = spark.read.parquet(path)
    found = footers(df).groupBy("column").agg(
        F.sum("non_null").alias("non_null"), F.count_if(F.col("non_null").isNull()).alias("unknown"), F.sum("rows").alias("rows"),
        F.count_if(F.col("rows").isNull()).alias("unread"))
    by_column = {r["column"]: r for r in found.collect()}               # one row per column
    own = by_column.pop(None, None)
    lacking = [c for c in df.columns if c in by_column and by_column[c]["unknown"]]
    if own is not None and own["unread"]:
        lacking, total = df.columns, None
    else:
        total = own["rows"] if own is not None else 0
    scanned = {}
    if lacking:
        row = df.agg(F.count(F.lit(1)), *[F.count(F.col(f"`{c}`")) for c in lacking]).first()
        total, scanned = row[0], dict(zip(lacking, row[1:], strict=True))
    rows = [(c, scanned[c] if c in scanned else by_column[c]["non_null"] if c in by_column else 0) for c in df.columns]
    out = spark.createDataFrame(rows, "column string, non_null long")
    return out.withColumn("completeness_pct", _pct(F.col("non_null"), F.lit(total).cast("long")))


def catalog(spark: SparkSession, outputs: dict[str, str]) -> DataFrame:
    """K5 from footers: per dataset its size, records and fields, as ``sinks.dataset_catalog`` gives them by a scan."""
    out = None
    for name, path in outputs.items():
        df = spark.read.parquet(path)
        files = footers(df).filter(F.col("column").isNull())
        unread = F.when(F.col("rows").isNull(), F.raise_error(F.concat(F.lit("tasks can't open "), F.col("path"))).cast("long"))
        size = F.coalesce(F.sum("bytes"), F.lit(0))
        row = files.agg(F.lit(name).alias("dataset"), F.round(size / (1024 * 1024), 2).alias("size_mb"), size.alias("size_bytes"),
                        F.coalesce(F.sum(F.coalesce("rows", unread)), F.lit(0)).alias("records"), F.lit(len(df.columns)).alias("fields"))
        out = row if out is None else out.unionByName(row)
    return out
