"""Harmonized years kept up to date (H1-H3, K1): only years whose files changed are read and written.

A folder holds three Parquet tables, each partitioned by year:

* ``data``      the harmonized rows
* ``sketches``  mergeable profile figures per (year, column), which decide the
                target types without reading the other years again
* ``manifest``  per year the number, size and fingerprint of its input files

After each run ``data`` equals a full harmonization of the files that are
there: new and changed years are replaced, years whose files are gone go, and
where that changes the type of a column the other years that have this column
are written again. Each year is written with the columns it has; a column that
only other years have reads as NULL.

Lost runs: writes replace whole year partitions when their job commits, so a
run that fails before leaves the old rows. Before ``data`` is touched, the
years of the run are marked as open in ``manifest``; they are closed last, so
a run that failed at any point is done again by the next one. One run at a time
may work on a folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

from roadbook.operators.harmonize import cast_text_shards, target_types
from roadbook.operators.sketches import figures, shard_sketches
from roadbook.session import materialize
from roadbook.sources import shards as S
from roadbook.sources import sinks

Y, YEAR_OUT = "shard_year", "DATA_YEAR"
MANIFEST = "shard_year int, files long, bytes long, fingerprint long"


def _hadoop(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _exists(spark: SparkSession, path: str) -> bool:
    fs, p = _hadoop(spark, path)
    return fs.exists(p)


def _delete(spark: SparkSession, path: str) -> None:
    fs, p = _hadoop(spark, path)
    fs.delete(p, True)


def fingerprints(files: DataFrame, matched: DataFrame) -> DataFrame:
    """Per year of matched shard files: their number, bytes and a fingerprint of paths, sizes and times."""
    known = matched.select(F.col("year").cast("int").alias(Y), "path").join(files.select("path", "length", "modified"), "path")
    return known.groupBy(Y).agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"),
                                F.bit_xor(F.xxhash64("path", "length", "modified")).alias("fingerprint"))


def changes(now: DataFrame, before: DataFrame) -> DataFrame:
    """(year, state) with state new, changed, same or gone; a year that a failed run left open is changed."""
    figs = ["files", "bytes", "fingerprint"]
    a, b = now.select(Y, F.struct(*figs).alias("_now")), before.select(Y, F.struct(*figs).alias("_before"))
    state = (F.when(F.col("_before").isNull(), "new").when(F.col("_now").isNull(), "gone")
             .when(F.col("_now").eqNullSafe(F.col("_before")), "same").otherwise("changed"))
    return a.join(b, Y, "full").select(Y, state.alias("state"))


def _stored(spark: SparkSession, path: str, schema) -> DataFrame:
    """A table of the folder, empty where no run has written it yet."""
    return spark.read.schema(schema).parquet(path) if _exists(spark, path) else spark.createDataFrame([], schema)


def _decided(sketches: DataFrame, pandas_dtypes: bool) -> dict[str, str]:
    types = target_types(figures(sketches), pandas_dtypes)
    return {r["column"]: r["target_type"] for r in types.collect()}      # one row per column


def _sketches(spark: SparkSession, out: str) -> DataFrame:
    """Stored figures per (year, column), each with the type that the year's rows were written with."""
    empty = shard_sketches(spark.createDataFrame([], f"{Y} int, c string")).withColumn("target_type", F.lit("string"))
    return _stored(spark, f"{out}/sketches", empty.schema)


def harmonize_changed(spark: SparkSession, root: str, category: str, out: str, years=None, pandas_dtypes: bool = False,
                      processing_date: str | None = None, multi_line: bool = True) -> dict[int, str]:
    """Bring the folder ``out`` up to date with the shards of ``category`` under ``root``.

    Returns what happened to each year: new, changed, retyped (written again
    because the type of one of its columns changed), same or gone.
    """
    files = S.list_files(spark, root, "*.csv")
    matched = S.match_shards(files, [category], years)
    # the files are fingerprinted before they are read: what changes in between is read again by the next run
    now = materialize(fingerprints(files, matched), "fingerprints")
    states = {r[Y]: r["state"] for r in changes(now, _stored(spark, f"{out}/manifest", MANIFEST)).collect()}   # one row per year
    todo = sorted(y for y, s in states.items() if s in ("new", "changed"))
    gone = sorted(y for y, s in states.items() if s == "gone")
    if not todo and not gone:
        return states
    old = _sketches(spark, out)
    kept = old.filter(~F.col(Y).isin(todo + gone))

    def read(wanted):
        """(text, sketches) of these years; each shard is parsed once."""
        text, inventory = S.read_text_shards(spark, matched.filter(F.col("year").isin(wanted)), Y, multi_line=multi_line)
        if text.columns == [Y]:
            return text, old.drop("target_type").limit(0)
        text = materialize(text, f"{category.lower()}-text")
        return text, materialize(shard_sketches(text, Y, inventory), "sketches")

    text, fresh = read(todo)
    types = _decided(kept.drop("target_type").unionByName(fresh), pandas_dtypes)
    decided = spark.createDataFrame(list(types.items()), "column string, target_type string")
    other = kept.join(decided.withColumnRenamed("target_type", "_now"), "column").filter(F.col("_now") != F.col("target_type"))
    if retyped := sorted(r[Y] for r in other.select(Y).distinct().collect()):
        states |= dict.fromkeys(retyped, "retyped")
        todo = sorted(todo + retyped)
        text, fresh = read(todo)

    opened = spark.createDataFrame([(y, None, None, None) for y in todo + gone], MANIFEST)
    sinks.write_parquet(opened, f"{out}/manifest", [Y], only_partitions=True)
    listed: dict[int, list[str]] = {}
    for r in fresh.select(Y, "column").sort(Y, "column").collect():          # the headers
        listed.setdefault(r[Y], []).append(r["column"])
    alike: dict[tuple[str, ...], list[int]] = {}
    for y, cols in listed.items():
        alike.setdefault(tuple(cols), []).append(y)
    for cols, those in alike.items():           # a year is written with its own columns: one job per header
        own = text.filter(F.col(Y).isin(those)).select(Y, *[F.col(f"`{c}`") for c in cols])
        sinks.write_parquet(cast_text_shards(own, types, Y, processing_date, YEAR_OUT), f"{out}/data", [YEAR_OUT], only_partitions=True)
    filled = {r[Y] for r in fresh.filter("rows > 0").select(Y).distinct().collect()}
    for y in [y for y in todo if y not in filled] + gone:
        _delete(spark, f"{out}/data/{YEAR_OUT}={y}")
    for y in [y for y in todo if y not in listed] + gone:
        _delete(spark, f"{out}/sketches/{Y}={y}")
    sinks.write_parquet(fresh.join(decided, "column"), f"{out}/sketches", [Y], only_partitions=True)
    sinks.write_parquet(now.filter(F.col(Y).isin(todo)), f"{out}/manifest", [Y], only_partitions=True)
    for y in gone:
        _delete(spark, f"{out}/manifest/{Y}={y}")
    return states


def read_harmonized(spark: SparkSession, out: str) -> DataFrame:
    """The harmonized rows of all years: ``DATA_YEAR``, the columns in order, ``PROCESSING_DATE`` of each year's last write."""
    written = _sketches(spark, out).groupBy("column").agg(F.collect_set("target_type").alias("types"))
    types = {r["column"]: r["types"] for r in written.collect()}            # one row per column
    if mixed := sorted(c for c, ts in types.items() if len(ts) > 1):
        raise RuntimeError(f"a run on {out} failed while it changed the types of {mixed}: run it again")
    spark_type = {"long": LongType(), "double": DoubleType(), "string": StringType()}
    columns = [StructField(c, spark_type[types[c][0]]) for c in sorted(types)]
    schema = StructType([StructField(YEAR_OUT, IntegerType()), *columns, StructField("PROCESSING_DATE", StringType())])
    return _stored(spark, f"{out}/data", schema).select(*[F.col(f"`{c}`") for c in schema.names])


def read_sketches(spark: SparkSession, out: str) -> DataFrame:
    """The stored profile figures of all years (see ``operators.sketches``)."""
    return _sketches(spark, out)
