"""Crash-domain tables projected from the driver's TPC-H-style tables.

There is no crash data here, so every category is a deterministic projection
of ``orders`` / ``lineitem`` (see FIXTURES.md). The projections are plain
DataFrame expressions: their size grows with the input tables, and all
filters and column choices reach the Parquet scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadbook.operators.profile import dealt


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _lat(k: Column) -> Column:
    return (F.when(k % 31 == 0, F.lit(None).cast("double"))
            .when(k % 997 == 1, F.lit(0.0))
            .otherwise(F.lit(39.80) + (k % 4000).cast("double") / F.lit(10000.0)))


def _lon(k: Column, cust: Column) -> Column:
    return (F.when(k % 31 == 0, F.lit(None).cast("double"))
            .when(k % 997 == 1, F.lit(0.0))
            .otherwise(F.lit(-75.32) + (cust % 450).cast("double") / F.lit(1000.0)))


def crash(spark: SparkSession, sf_dir: str, with_day: bool = False) -> DataFrame:
    """CRASH: one row per order.

    ``with_day`` adds a CRASH_DAY that is present on most rows but not all
    (the exact-day case of date reconstruction), in the same projection.
    """
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    d = F.to_date("o_orderdate")
    date_text = (F.when(k % 101 == 0, F.lit(None).cast("string"))
                 .when(k % 103 == 0, F.lit("unknown"))
                 .when(k % 211 == 0, F.date_format(F.add_months(d, 12), "yyyy-MM-dd"))
                 .otherwise(F.date_format(d, "yyyy-MM-dd")))
    return o.select(
        k.cast("string").alias("CRN"),
        F.year(d).alias("CRASH_YEAR"),
        F.month(d).alias("CRASH_MONTH"),
        F.when(k % 53 == 0, F.lit(None).cast("int")).otherwise(F.dayofweek(d)).alias("DAY_OF_WEEK"),
        (k % 24).cast("int").alias("HOUR_OF_DAY"),
        F.lit(67).alias("COUNTY"),
        F.when(F.col("o_orderpriority").startswith("1"), 1).otherwise(0).alias("PED_COUNT"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("MAX_SEVERITY_LEVEL"),
        _lat(k).alias("DEC_LATITUDE"),
        _lon(k, F.col("o_custkey")).alias("DEC_LONGITUDE"),
        date_text.alias("CRASH_DATE_TEXT"),
        *([F.when(k % 7 != 0, F.dayofmonth(d)).alias("CRASH_DAY")] if with_day else []),
    )


def _person_type(flag: Column) -> Column:
    return (F.when(flag == "A", F.lit("PEDESTRIAN")).when(flag == "N", F.lit("BICYCLIST"))
            .when(flag == "R", F.lit("DRIVER")))


def person(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PERSON: one row per line item."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_orderkey").cast("string").alias("CRN"),
        _person_type(F.col("l_returnflag")).alias("PERSON_TYPE"),
        F.col("l_linenumber").alias("PERSON_NUM"),
        (F.col("l_suppkey") % 9).cast("int").alias("INJ_SEVERITY"),
    )


def vehicle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """VEHICLE: one row per line item."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_orderkey").cast("string").alias("CRN"),
        F.col("l_returnflag").alias("VEH_TYPE"),
        F.col("l_linenumber").cast("string").alias("VEH_ROLE_CD"),
        F.col("l_linestatus").alias("VEH_STATUS"),
    )


def roadway(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ROADWAY: one row per line item (intentional 1:N fan-out per crash)."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_orderkey").cast("string").alias("CRN"),
        F.col("l_linenumber").alias("LANE_COUNT"),
        F.col("l_suppkey").cast("string").alias("ROUTE"),
        ((F.col("l_suppkey") % 67) + 1).cast("int").alias("COUNTY"),
    )


def helmet_code(flag: Column, status: Column, partkey: Column) -> Column:
    """Helmet indicator with valid, blank, NULL, lower-case/padded and invalid codes."""
    return (F.when((flag == "A") & (status == "F"), F.lit("Y"))
            .when((flag == "N") & (status == "F"), F.lit("N"))
            .when((flag == "R") & (status == "F"), F.lit("U"))
            .when((flag == "A") & (status == "O"), F.lit(""))
            .when((flag == "N") & (status == "O"), F.lit(None).cast("string"))
            .when(partkey % 2 == 0, F.lit(" y "))
            .otherwise(F.lit("X")))


def cycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CYCLE: first line items with small quantities."""
    li = table(spark, sf_dir, "lineitem").filter((F.col("l_linenumber") == 1) & (F.col("l_quantity") < 10))
    h = helmet_code(F.col("l_returnflag"), F.col("l_linestatus"), F.col("l_partkey"))
    return li.select(
        F.col("l_orderkey").cast("string").alias("CRN"),
        h.alias("PC_HLMT_IND"),
        h.alias("HELMET_IND"),
        F.col("l_quantity").cast("int").alias("BIKE_UNITS"),
    )


def weather_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily station observations in long form (date, datatype, value, obs_id).

    Temperatures are in tenths of a degree as the raw station feed reports
    them; the average temperature is withheld for 1995-1996 so that "has a
    weather row" and "has an average temperature" differ.
    """
    li = table(spark, sf_dir, "lineitem")
    daily = li.groupBy(F.to_date("l_shipdate").alias("date")).agg(
        F.sum("l_linenumber").alias("s_ln"),
        F.sum("l_quantity").cast("bigint").alias("s_qty"),
        F.count(F.lit(1)).alias("n"),
        F.sum("l_partkey").alias("s_pk"),
    )
    base = (F.col("s_qty") % 56) - 12
    withheld = F.year("date").isin(1995, 1996)
    obs = F.array(
        F.struct(F.lit("PRCP").alias("datatype"), ((F.col("s_ln") % 29).cast("double") / F.lit(2.0)).alias("value")),
        F.struct(F.lit("TAVG").alias("datatype"),
                 F.when(withheld, F.lit(None).cast("double")).otherwise((base * 10).cast("double")).alias("value")),
        F.struct(F.lit("TMAX").alias("datatype"), ((base + 4) * 10).cast("double").alias("value")),
        F.struct(F.lit("TMIN").alias("datatype"), ((base - 4) * 10).cast("double").alias("value")),
        F.struct(F.lit("WSF2").alias("datatype"), (F.col("n") % 23).cast("double").alias("value")),
        F.struct(F.lit("SNOW").alias("datatype"),
                 F.when(F.col("s_pk") % 17 == 0, F.lit(5.0)).otherwise(F.lit(0.0)).alias("value")),
    )
    return (daily.select("date", F.posexplode(obs).alias("pos", "o"))
            .filter(F.col("o.value").isNotNull())
            .select("date", F.col("o.datatype").alias("datatype"), F.col("o.value").alias("value"),
                    (F.unix_date("date").cast("bigint") * 8 + F.col("pos")).alias("obs_id")))


SHARD_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority", "o_code", "o_suffix",
                 "o_big", "o_old"]


def shard_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Yearly ORDERS shards as CSV text would hold them (all strings) in one frame.

    Shards up to 1996 lack ``o_orderpriority`` (NULL in every row and absent
    from the inventory); 1997-1998 carry ``o_totalprice`` as formatted text
    with thousands separators; later years are complete. ``o_code`` has
    leading zeros, ``o_suffix`` looks like a Java number literal, ``o_big``
    exceeds what a double holds exactly, ``o_old`` ends in 1997. ``shard_year``
    says which shard a row belongs to.
    """
    o = table(spark, sf_dir, "orders")
    year = F.year("o_orderdate")
    price_text = F.when(year.isin(1997, 1998), F.format_number("o_totalprice", 2)).otherwise(
        F.col("o_totalprice").cast("string"))
    return o.select(
        year.alias("shard_year"),
        F.col("o_orderkey").cast("string").alias("o_orderkey"),
        F.col("o_custkey").cast("string").alias("o_custkey"),
        F.col("o_orderstatus"),
        price_text.alias("o_totalprice"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate"),
        F.when(year > 1996, F.col("o_orderpriority")).alias("o_orderpriority"),
        F.lpad((F.col("o_orderkey") % 10000).cast("string"), 4, "0").alias("o_code"),
        F.concat((F.col("o_orderkey") % 100).cast("string"), F.when(F.col("o_orderkey") % 2 == 0, "D").otherwise("F")).alias("o_suffix"),
        (F.lit(9007199254740993) + F.col("o_orderkey")).cast("string").alias("o_big"),
        F.when(year <= 1997, F.col("o_orderstatus")).alias("o_old"),
    )


#: How a shard of ``dated_text`` writes ``happened``, by its year modulo 4.
DATE_STYLES = ["yyyy-MM-dd", "MM/dd/yyyy", "dd.MM.yyyy", "yyyyMMdd"]


def dated_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Yearly ORDERS shards as text with date columns in several formats.

    ``happened`` changes its format from year to year; ``reported`` is day first in
    even years and blank in 1995; ``closed`` holds 30 February in one of 200 rows;
    ``amount`` is a number, ``crn`` a key. The two columns they are made of are dealt
    to all tasks before they become text.
    """
    k, d = F.col("o_orderkey"), F.to_date("o_orderdate")
    year = F.year(d)
    happened = F.coalesce(*[F.when(year % 4 == i, F.date_format(d, f)) for i, f in enumerate(DATE_STYLES)])
    return dealt(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")).select(
        year.alias("shard_year"), k.cast("string").alias("crn"),
        F.when(k % 17 == 0, F.lit(None)).when(k % 19 == 0, "").otherwise(happened).alias("happened"),
        F.when(year == 1995, F.lit(" ")).when(year % 2 == 0, F.date_format(F.date_add(d, 1), "dd/MM/yyyy"))
        .otherwise(F.concat(F.date_format(F.date_add(d, 1), "yyyy-MM-dd"), F.lit(" 08:30:00"))).alias("reported"),
        F.when(k % 200 == 0, F.concat(year.cast("string"), F.lit("-02-30"))).otherwise(F.date_format(F.date_add(d, 2), "yyyy-MM-dd")).alias("closed"),
        (k % 5000).cast("string").alias("amount"))


def shard_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(shard_year, column) presence for the ORDERS shards, derived from the data's years."""
    years = table(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("shard_year")).distinct()
    cols = F.array(*[F.lit(c) for c in SHARD_COLUMNS])
    inv = years.select("shard_year", F.explode(cols).alias("column"))
    return inv.filter(~((F.col("column") == "o_orderpriority") & (F.col("shard_year") <= 1996))
                      & ~((F.col("column") == "o_old") & (F.col("shard_year") > 1997)))


def patrol_areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One concave polygon per supplier, (area_id, rings): a square with a notch cut into its upper side."""
    k = F.col("s_suppkey")
    x, y = F.lit(-75.30) + (k * 37 % 350).cast("double") / F.lit(1000.0), F.lit(39.85) + (k * 53 % 300).cast("double") / F.lit(1000.0)
    side = F.lit(0.008) + (k % 7).cast("double") * F.lit(0.004)
    corners = [F.struct((x + F.lit(u) * side).alias("lon"), (y + F.lit(v) * side).alias("lat"))
               for u, v in ((0.0, 0.0), (1.0, 0.125), (0.875, 1.0), (0.5, 0.25), (0.125, 1.0))]
    return table(spark, sf_dir, "supplier").select(k.alias("area_id"), F.array(F.array(*corners)).alias("rings"))


def events_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as long (date, event_type, value, event_id) rows for the generic pivot."""
    e = table(spark, sf_dir, "events")
    return e.select(F.to_date("ts").alias("date"), "event_type", "value", "event_id")
