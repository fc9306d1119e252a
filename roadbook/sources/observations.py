"""Weather observation pages (S6-S7): landed JSON API pages -> long rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

OBS_SCHEMA = ("metadata struct<resultset: struct<offset: long, count: long, `limit`: long>>, "
              "results array<struct<date: string, datatype: string, station: string, attributes: string, value: double>>")


def observation_pages(spark: SparkSession, paths, multi_line: bool = True, request: Column | None = None) -> DataFrame:
    """One row per landed page: request, page, offset, total, limit, results, short, fault, raw.

    A request is what the API was asked for (by default the year in the file's
    path); its pages follow one another by ``offset``, ``limit`` rows each,
    until ``total`` rows are there. A page is ``short`` if it has another number
    of results than its offset and total ask for. ``fault`` says why a page
    can't be used at all, ``raw`` is its text then:

    - ``not JSON``: torn, or of other types than a page has
    - ``no results``: JSON without a list of results, such as an error message

    An empty file holds no page at all: ``missing_pages`` finds it by its offset.
    """
    path = F.col("_metadata.file_path")
    request = F.regexp_extract(path, r"(\d{4})[^/]*(?:/[^/]*)?$", 1).cast("int") if request is None else request
    pages = (spark.read.schema(f"{OBS_SCHEMA}, _raw string").option("multiLine", multi_line).option("mode", "PERMISSIVE")
             .option("columnNameOfCorruptRecord", "_raw").json(paths))
    said = F.col("metadata.resultset")
    due = F.least(said["limit"], said["count"] - said["offset"] + 1)
    fault = F.when(F.col("_raw").isNotNull(), "not JSON").when(F.col("results").isNull(), "no results")
    return pages.select(request.alias("request"), F.col("_metadata.file_name").alias("page"), said["offset"].alias("offset"),
                        said["count"].alias("total"), said["limit"].alias("limit"), "results",
                        (fault.isNull() & F.coalesce(F.size("results") != due, F.lit(False))).alias("short"), fault.alias("fault"),
                        F.when(fault.isNotNull(), F.coalesce("_raw", F.to_json(F.struct("metadata", "results")))).alias("raw"))


def torn_pages(pages: DataFrame) -> DataFrame:
    """The quarantine: pages that can't be used, with the reason and their text."""
    return pages.filter(F.col("fault").isNotNull()).select("request", "page", "offset", "fault", "raw")


def missing_pages(pages: DataFrame) -> DataFrame:
    """(request, offset, due): pages that a request should have and no whole page holds, with the rows due on them.

    What a request should have is what any of its readable pages says.
    """
    asked = pages.groupBy("request").agg(F.max("total").alias("total"), F.max("limit").alias("limit")).filter("total > 0 AND limit > 0")
    due = asked.withColumn("offset", F.explode(F.expr("sequence(1L, total, `limit`)")))
    have = pages.filter(F.col("fault").isNull() & ~F.col("short")).select("request", "offset").distinct()
    return due.join(have, ["request", "offset"], "left_anti").select(
        "request", "offset", F.least(F.col("limit"), F.col("total") - F.col("offset") + 1).alias("due"))


def page_report(pages: DataFrame) -> DataFrame:
    """Per request the rows it should have and has, its usable, short, unusable, missing and repeated pages, and whether it is complete.

    A page that was fetched twice counts once.
    """
    usable = pages.filter(F.col("fault").isNull()).groupBy("request", "offset").agg(
        F.count("*").alias("copies"), F.max(F.size("results")).alias("rows"), F.min("short").alias("short"))
    found = usable.groupBy("request").agg(F.count("*").alias("pages"), F.sum("rows").alias("rows"), F.count_if("short").alias("short"),
                                          F.sum(F.col("copies") - 1).alias("repeated"))
    asked = pages.groupBy("request").agg(F.max("total").alias("total"), F.count_if(F.col("fault").isNotNull()).alias("torn"))
    missing = missing_pages(pages).groupBy("request").agg(F.count("*").alias("missing"))
    out = asked.join(found, "request", "left").join(missing, "request", "left")
    none = F.lit(0).cast("long")
    return out.select("request", "total", *[F.coalesce(c, none).alias(c) for c in ("rows", "pages", "short", "torn", "missing", "repeated")],
                      F.coalesce(F.col("rows") == F.col("total"), F.col("total") == 0, F.lit(False)).alias("complete"))


def read_observation_pages(spark: SparkSession, paths, multi_line: bool = True, on_fault: str = "error") -> DataFrame:
    """Every ``results`` entry of every page (one multi-file read), as long rows.

    ``multi_line=True`` reads one (pretty-printed) page per file, as an API
    client lands them; ``False`` reads JSON Lines, one page per line.
    Returns (date, datatype, station, value, page, obs_index); ``obs_index``
    keeps the ingest order for first-value semantics in the pivot. A page that
    can't be used (see :func:`observation_pages`) fails the job;
    ``on_fault="skip"`` leaves it out, to be listed by :func:`torn_pages`.
    """
    pages = observation_pages(spark, paths, multi_line)
    if on_fault == "skip":
        pages = pages.filter(F.col("fault").isNull())
    else:
        said = F.raise_error(F.concat(F.lit("observation page "), F.col("page"), F.lit(": "), F.col("fault")))
        pages = pages.withColumn("results", F.when(F.col("fault").isNotNull(), said.cast(pages.schema["results"].dataType)).otherwise(F.col("results")))
    # the outer variant looks at every page, so that one without results fails too
    rows = pages.select("page", F.posexplode_outer("results").alias("obs_index", "r")).filter(F.col("r").isNotNull())
    return rows.select(F.to_date(F.substring("r.date", 1, 10)).alias("date"), "r.datatype", "r.station", "r.value",
                       "page", "obs_index")


def ingest_order(long_df: DataFrame) -> DataFrame:
    """A deterministic ingest order over pages: (page name, position in page)."""
    return long_df.withColumn("obs_order", F.struct("page", "obs_index"))


def union_observations(frames: list[DataFrame]) -> DataFrame:
    """All yearly observation frames as one (by column name)."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def write_observation_pages(long_df: DataFrame, path: str) -> None:
    """Land (date, datatype, value) rows as monthly pages ``{"metadata", "results": [...]}`` (JSON Lines).

    A page holds one month of daily observations (at most 31 days x the
    datatypes of the station), so its size is bounded by the calendar, not by
    the data volume.
    """
    entry = F.struct(F.concat(F.date_format("date", "yyyy-MM-dd"), F.lit("T00:00:00")).alias("date"),
                     F.col("datatype"), F.lit("STATION").alias("station"), F.lit(",,,").alias("attributes"),
                     F.col("value").cast("double").alias("value"))
    pages = long_df.groupBy(F.year("date").alias("_y"), F.month("date").alias("_m")).agg(
        F.collect_list(entry).alias("results"))
    meta = F.struct(F.struct(F.lit(1).cast("long").alias("offset"), F.size("results").cast("long").alias("count"),
                             F.lit(1000).cast("long").alias("limit")).alias("resultset"))
    pages.select(meta.alias("metadata"), "results").write.mode("overwrite").json(path)


def request_pages(long_df: DataFrame, limit: int = 1000) -> DataFrame:
    """(request, offset, value): (date, datatype, value) rows as JSON pages of ``limit`` results, one request per year.

    The windows hold one year of one station's daily observations, a number
    that the calendar bounds.
    """
    year = Window.partitionBy("request")
    rows = long_df.withColumn("request", F.year("date")).withColumns(
        {"at": F.row_number().over(year.orderBy("date", "datatype")), "total": F.count(F.lit(1)).over(year)})
    entry = F.struct("at", F.concat(F.date_format("date", "yyyy-MM-dd"), F.lit("T00:00:00")).alias("date"), "datatype",
                     F.lit("STATION").alias("station"), F.lit(",,,").alias("attributes"), F.col("value").cast("double").alias("value"))
    offset = F.expr(f"(at - 1) div {limit}") * limit + 1
    pages = rows.groupBy("request", offset.alias("offset"), "total").agg(F.array_sort(F.collect_list(entry)).alias("entries"))
    results = F.transform("entries", lambda e: e.dropFields("at"))
    meta = F.struct(F.struct(F.col("offset"), F.col("total").alias("count"), F.lit(limit).alias("limit")).alias("resultset"))
    return pages.select("request", "offset", F.to_json(F.struct(meta.alias("metadata"), results.alias("results"))).alias("value"))
