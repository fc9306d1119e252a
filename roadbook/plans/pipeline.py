"""The whole curation run as Spark jobs: geo -> weather -> datasets -> report.

Stage outputs that several later plans read are written once (Parquet in
the session's checkpoint folder or the given output folder) and read back,
which cuts lineage and survives executor loss; everything else stays one
lazy plan per output.
"""

from __future__ import annotations

import os
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadbook.operators import datasets as D
from roadbook.operators import validate as V
from roadbook.operators.geo import geo_stats
from roadbook.operators.weather import match_stats
from roadbook.plans import fixtures as fx
from roadbook.plans import stages
from roadbook.session import materialize
from roadbook.sources import sinks


def run_all(spark: SparkSession, sf_dir: str, out_dir: str | None = None, landed: str | None = None, category: str = "CRASH",
            years=None, kept: str | None = None) -> dict[str, DataFrame]:
    """Run stages 3-5 on the fixture tables; returns the final DataFrames (and writes them, as Parquet and CSV, when ``out_dir``).

    ``landed`` is a folder of yearly CSV shards of ``category``: stages 2-3
    (profile, harmonize) then run over it as well. ``kept`` is a folder that holds
    the harmonized years between runs: only new and changed shards are read then.
    """
    weather = materialize(stages.weather_table(spark, sf_dir), "weather_daily")
    geo = stages.crash_geographic(spark, sf_dir)
    crash_weather = materialize(stages.integrate_weather(geo, weather), "crash_weather", partition_by=["CRASH_YEAR"])
    person, vehicle = fx.person(spark, sf_dir), fx.vehicle(spark, sf_dir)
    outputs = {
        "cyclist_focused": D.cyclist_dataset(crash_weather, fx.cycle(spark, sf_dir), person, vehicle),
        "pedestrian_focused": D.pedestrian_dataset(crash_weather, person, vehicle),
        "full_integrated": D.full_integrated(crash_weather, fx.roadway(spark, sf_dir)),
        **{k: v for k, v in D.reference_tables(person, vehicle).items()},
    }
    if landed:
        curated = profile_and_update(spark, landed, category, kept, years) if kept else profile_and_harmonize(spark, landed, category, years)
        outputs[category.lower()] = curated["harmonized"]
    reports = {
        "geographic_stats": geo_stats(fx.crash(spark, sf_dir)),
        "weather_stats": match_stats(crash_weather, weather),
    }
    if out_dir:
        paths = {name: os.path.join(out_dir, name) for name in outputs}
        # independent outputs are separate Spark jobs; submitting them together
        # lets their tasks share the cluster instead of running one after another
        def write(kv):
            name, df = kv
            by_year = ["CRASH_YEAR"] if "CRASH_YEAR" in df.columns else None
            sinks.write_parquet(df, paths[name], partition_by=by_year)
            sinks.write_csv(spark.read.parquet(paths[name]), os.path.join(out_dir, "csv", name))

        with ThreadPoolExecutor(max_workers=len(outputs)) as pool:
            list(pool.map(write, outputs.items()))
        full = spark.read.parquet(paths["full_integrated"])
        reports["validation_report"] = V.val_report(full)
        reports["catalog"] = sinks.dataset_catalog(spark, paths)
        with ThreadPoolExecutor(max_workers=len(reports)) as pool:
            list(pool.map(lambda kv: sinks.write_json_report(kv[1], os.path.join(out_dir, "metadata", kv[0])),
                          reports.items()))
    return {**outputs, **reports}


def profile_and_harmonize(spark: SparkSession, root: str, category: str, years, sample_rows: int | None = None,
                          exact_distinct: bool = True, pandas_dtypes: bool = False) -> dict[str, DataFrame]:
    """Stages 2-3 from landed CSV shards of one category.

    Lists and matches the yearly files (S1, S3, S4), reports missing shards and
    files left out (``quarantine``),
    reads the shards as text once into a columnar copy, profiles them (P1-P5; on the first
    ``sample_rows`` rows of each file when given, S2), compares schemas
    across years (P6-P10) and returns the harmonized table (H1-H3, F3-F4).
    """
    from roadbook.operators import profile as P
    from roadbook.operators.harmonize import harmonize_text_shards
    from roadbook.sources import shards as S

    files = S.list_files(spark, root, "*.csv")
    matched = S.match_shards(files, [category], years)
    text, inventory = S.read_text_shards(spark, matched)
    # CSV is parsed once: profiling, type resolution and the typed cast all
    # read this columnar copy (written under the checkpoint folder by year)
    text = materialize(text, f"{category.lower()}-text", partition_by=["shard_year"])
    profiled = text
    if sample_rows is not None:
        shards = matched.select("path", "file_name", "year").collect()          # one row per shard file
        paths, year_of = [r["path"] for r in shards], {r["file_name"]: r["year"] for r in shards}
        sample = S.scan_sample(spark, paths, sample_rows)
        ymap = F.create_map(*[x for k, y in year_of.items() for x in (F.lit(k), F.lit(y))])
        profiled = sample.select(ymap[F.col("_file")].alias("shard_year"), *[c for c in sample.columns if c != "_file"])
    stats, top = P.profile_shards(profiled, "shard_year", inventory, exact_distinct=exact_distinct)
    inv_types = P.inventory_types(inventory, stats)
    return {
        "files": matched,
        "missing": S.missing_shards(files, [category], years),
        "quarantine": S.quarantine(files, [category], years),
        "column_stats": stats,
        "top_values": top,
        "schema_matrix": P.schema_matrix(inventory),
        "schema_issues": P.schema_issues(inv_types, category),
        "harmonized": harmonize_text_shards(text, inventory, pandas_dtypes=pandas_dtypes),
    }


def profile_and_update(spark: SparkSession, root: str, category: str, kept: str, years=None, pandas_dtypes: bool = False,
                       processing_date: str | None = None) -> dict[str, DataFrame]:
    """Stages 2-3 on what changed since the last run on ``kept``; the same tables as ``profile_and_harmonize``, and ``changes``.

    Shards of new and changed years are read, the others' rows and profile
    figures come from ``kept``. Distinct counts of 20 and more are estimates
    (``distinct_exact`` says which); nulls, types, ranges and top values are exact.
    ``changes`` has a row per year: new, changed, retyped, same or gone.
    """
    from roadbook.operators import profile as P
    from roadbook.operators import sketches as K
    from roadbook.sources import increments as I
    from roadbook.sources import shards as S

    states = I.harmonize_changed(spark, root, category, kept, years, pandas_dtypes, processing_date)
    files = S.list_files(spark, root, "*.csv")
    sketches = I.read_sketches(spark, kept).drop("target_type")
    stats = K.figures(sketches)
    inventory = sketches.select("shard_year", "column")
    return {
        "files": S.match_shards(files, [category], years),
        "missing": S.missing_shards(files, [category], years),
        "quarantine": S.quarantine(files, [category], years),
        "column_stats": stats,
        "top_values": K.top_values(sketches),
        "schema_matrix": P.schema_matrix(inventory),
        "schema_issues": P.schema_issues(P.inventory_types(inventory, stats), category),
        "harmonized": I.read_harmonized(spark, kept),
        "changes": spark.createDataFrame(sorted(states.items()), "shard_year int, state string"),
    }
