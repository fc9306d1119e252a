"""Date columns in text shards: evidence per format, one format per shard and column, exact casts (P5, H2, H5).

Dates are looked for on request only; the usual type lattice leaves them text.
A format is a pattern plus the places of year, month and day. Each value
counts for every format that gives it a calendar date, so ``03/04/2011`` is
evidence for month first and for day first, ``03/25/2011`` for the former alone.
A shard's column takes the format with the most evidence; where several have
the same, the one that the column's other shards speak for, then the first in
the order of ``FORMATS`` (the result says so in ``ambiguous``).

Cases: null and blank values are no evidence; a column without any other value
in a shard has no format there and doesn't vote; text around the date (spaces,
a time of day) is allowed; 30 February is no date; two-digit years aren't read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadbook.operators.joins import join_small
from roadbook.operators.profile import inventory_types, listed, type_evidence, unpivot_text

_TIME = r"(?:[T ]\d{1,2}:\d{2}(?::\d{2}(?:\.\d+)?)?(?: ?[AaPp][Mm])?(?:Z|[+-]\d{2}:?\d{2})?)?"
# no month above 12 and no day above 31: the cast of such a date builds an exception for each value
_Y, _M, _D = r"((?!0000)\d{4})", r"(1[0-2]|0?[1-9])", r"(3[01]|[12]\d|0?[1-9])"
#: name: (pattern, places of year, month and day among its groups), in order of preference.
FORMATS = {
    "yyyy-MM-dd": (rf"^\s*{_Y}-{_M}-{_D}{_TIME}\s*$", (1, 2, 3)),
    "yyyy/MM/dd": (rf"^\s*{_Y}/{_M}/{_D}{_TIME}\s*$", (1, 2, 3)),
    "MM/dd/yyyy": (rf"^\s*{_M}/{_D}/{_Y}{_TIME}\s*$", (3, 1, 2)),
    "dd/MM/yyyy": (rf"^\s*{_D}/{_M}/{_Y}{_TIME}\s*$", (3, 2, 1)),
    "MM-dd-yyyy": (rf"^\s*{_M}-{_D}-{_Y}{_TIME}\s*$", (3, 1, 2)),
    "dd.MM.yyyy": (rf"^\s*{_D}\.{_M}\.{_Y}{_TIME}\s*$", (3, 2, 1)),
    "yyyyMMdd": (r"^\s*((?:19|20)\d{2})(1[0-2]|0[1-9])(3[01]|[12]\d|0[1-9])\s*$", (1, 2, 3)),
}


def _may_hold(v: Column, name: str) -> Column:
    """True for every text that holds a date in the format; a search by bytes that spares most others the pattern."""
    if mark := name.strip("yMd")[:1]:
        at = F.instr(F.ltrim(v, F.lit(" \t\n\x0b\f\r")), mark)      # what \s takes
        return at == 5 if name.startswith("y") else at.isin(2, 3)
    return (F.length(v) >= len(name)) & ~(v.contains("-") | v.contains("/") | v.contains("."))


def date_in(value: str | Column, name: str) -> Column:
    """The date that a text holds in the format ``name``; null if it holds none."""
    v = F.col(value) if isinstance(value, str) else value
    pattern, places = FORMATS[name]
    # the parts in one go, as year-month-day: extracted one by one, each of their uses would run the pattern again
    return F.when(_may_hold(v, name) & v.rlike(pattern), F.regexp_replace(v, pattern, "-".join(f"${k}" for k in places)).try_cast("date"))


def date_evidence(df: DataFrame, year_col: str = "shard_year", inventory: DataFrame | None = None) -> DataFrame:
    """(year, column, format, filled, fits): filled values and those that are a date in the format, one row per format.

    One aggregate keyed by (year, column), combined before its shuffle.
    """
    long = listed(unpivot_text(df, [year_col]), inventory, year_col)
    v = F.col("value")
    counts = long.groupBy(year_col, "column").agg(
        F.count_if(F.trim(v) != "").alias("filled"), *[F.count_if(date_in(v, f).isNotNull()).alias(f"_{i}") for i, f in enumerate(FORMATS)])
    each = F.array(*[F.struct(F.lit(f).alias("format"), F.col(f"_{i}").alias("fits")) for i, f in enumerate(FORMATS)])
    return counts.select(year_col, "column", "filled", F.inline(each)).select(year_col, "column", "format", "filled", "fits")


def date_formats(evidence: DataFrame, year_col: str = "shard_year", share: float = 1.0) -> DataFrame:
    """(year, column, format, fits, filled, ambiguous) for each shard whose filled values are dates to at least ``share``.

    Windows hold one row per shard and format of one column.
    """
    fit = evidence.where((F.col("filled") > 0) & (F.col("fits") >= F.lit(share) * F.col("filled")))
    place = F.array_position(F.array(*[F.lit(f) for f in FORMATS]), F.col("format"))
    # rows of a format in all shards where no other format fits as well
    alone = (F.count(F.lit(1)).over(Window.partitionBy(year_col, "column", "fits")) == 1) & (
        F.col("fits") == F.max("fits").over(Window.partitionBy(year_col, "column")))
    fit = fit.withColumn("_alone", alone).withColumn(
        "_others", F.sum(F.when(F.col("_alone"), F.col("fits")).otherwise(0)).over(Window.partitionBy("column", "format")))
    best = Window.partitionBy(year_col, "column").orderBy(F.desc("fits"), F.desc("_others"), place)
    ranked = fit.withColumn("_rank", F.row_number().over(best))
    tied = F.lead("fits").over(best) == F.col("fits")
    same = F.lead("_others").over(best) == F.col("_others")
    ranked = ranked.withColumn("ambiguous", F.coalesce(tied & same, F.lit(False)))
    return ranked.where("_rank = 1").select(year_col, "column", "format", "fits", "filled", "ambiguous")


def date_columns(evidence: DataFrame, formats: DataFrame, year_col: str = "shard_year") -> DataFrame:
    """(column): those that are dates in every shard that has a value of them."""
    voting = evidence.where("filled > 0").select(year_col, "column").distinct()
    found = formats.select(year_col, "column", F.lit(1).alias("_date"))
    return (voting.join(found, [year_col, "column"], "left").groupBy("column")
            .agg((F.count(F.lit(1)) == F.count("_date")).alias("_all")).where("_all").select("column"))


def cast_dates(df: DataFrame, formats: dict[str, dict[int, str]], year_col: str = "shard_year") -> DataFrame:
    """The named text columns as dates: {column: {shard year: format}}; what isn't a date in its shard's format is null."""
    def cast(c: str, by_year: dict[int, str]) -> Column:
        out = F.lit(None).cast("date")
        for f in FORMATS:
            if years := sorted(y for y, g in by_year.items() if g == f):
                out = F.when(F.col(year_col).isin(years), date_in(F.col(f"`{c}`"), f)).otherwise(out)
        return out

    return df.withColumns({c: cast(c, by_year) for c, by_year in formats.items()})


def harmonize_with_dates(df: DataFrame, inventory: DataFrame, year_col: str = "shard_year", share: float = 1.0,
                         processing_date: str | None = None, year_out: str = "DATA_YEAR") -> DataFrame:
    """H3 with dates in the lattice: columns that are dates in every shard become dates, all others as usual.

    Shards may write a column in different formats. With ``share`` below 1, values
    that aren't dates in a date column become null. Dates go before numbers
    (``yyyyMMdd`` is a whole number too). Types and formats are gathered on the
    driver: one row per column, and one per shard and date column.
    """
    from roadbook.operators.harmonize import cast_text_shards, target_types

    evidence = date_evidence(df, year_col, inventory)
    found = date_formats(evidence, year_col, share)
    found = join_small(found, date_columns(evidence, found, year_col), "column", "left_semi")
    formats: dict[str, dict[int, str]] = {}
    for r in found.select(year_col, "column", "format").collect():
        formats.setdefault(r["column"], {})[r[year_col]] = r["format"]
    text = df.drop(*formats) if formats else df
    types = target_types(inventory_types(inventory, type_evidence(text, year_col, inventory), year_col))
    decided = {r["column"]: r["target_type"] for r in types.collect() if r["column"] not in formats}
    dated = cast_dates(df, formats, year_col)
    return cast_text_shards(dated, {**decided, **dict.fromkeys(formats, "date")}, year_col, processing_date, year_out)
