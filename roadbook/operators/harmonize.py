"""Schema harmonization across yearly shards.

The target type of every column is decided once over all shards from the
profile's per-shard inference, then each column is cast once and the shards
form one plan. The decision is metadata (one small row per column), so it is
gathered on the driver; the data itself never is.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DoubleType, LongType, StringType

from roadbook.constants import HELMET_UNKNOWN, HELMET_VALID
from roadbook.functions.numeric import INT_RE, to_long, to_number
from roadbook.operators.profile import inventory_types, type_evidence


def target_types(inv_types: DataFrame, pandas_dtypes: bool = False) -> DataFrame:
    """H2: one target type per column across all shards where it is present.

    Default: missing-only shards do not vote; long and double widen to
    double; any other disagreement gives string, and so does a column of codes
    with leading zeros. ``pandas_dtypes=True`` is
    the strict rule: any difference in the inferred dtype gives string.
    """
    if pandas_dtypes:
        dt = F.collect_set("dtype")
        target = (F.when(F.size(dt) > 1, F.lit("string"))
                  .when(F.array_contains(dt, "int64"), F.lit("long"))
                  .when(F.array_contains(dt, "float64"), F.lit("double")).otherwise(F.lit("string")))
    else:
        lt = F.array_remove(F.collect_set("logical_type"), "null")
        target = (F.when(F.size(lt) == 0, F.lit("string"))
                  .when(F.size(lt) == 1, F.element_at(lt, 1))
                  .when((F.size(lt) == 2) & F.array_contains(lt, "long") & F.array_contains(lt, "double"), F.lit("double"))
                  .otherwise(F.lit("string")))
    return inv_types.groupBy("column").agg(target.alias("target_type"))


def _cast_text(c: str, t: str):
    col = F.col(f"`{c}`")
    if t == "long":
        return F.when(col.rlike(INT_RE), col.try_cast("bigint")).alias(c)
    if t == "double":
        return to_number(col).alias(c)
    return col.cast("date" if t == "date" else "string").alias(c)


def harmonize_text_shards(df: DataFrame, inventory: DataFrame, year_col: str = "shard_year",
                          pandas_dtypes: bool = False, processing_date: str | None = None,
                          year_out: str = "DATA_YEAR") -> DataFrame:
    """H3 (with H2, F3, F4) over text shards: typed, unioned, sorted columns.

    Returns one plan over all shards; ``processing_date`` defaults to one
    timestamp fixed for the run (pass one to make reruns compare equal).
    """
    evidence = type_evidence(df, year_col, inventory)
    types = target_types(inventory_types(inventory, evidence, year_col), pandas_dtypes)
    decided = {r["column"]: r["target_type"] for r in types.collect()}   # one row per column
    return cast_text_shards(df, decided, year_col, processing_date, year_out)


def cast_text_shards(df: DataFrame, decided: dict[str, str], year_col: str = "shard_year",
                     processing_date: str | None = None, year_out: str = "DATA_YEAR") -> DataFrame:
    """Text shards cast to types that are decided already (columns without one stay text), with lineage, sorted."""
    cols = sorted(c for c in df.columns if c != year_col)
    out = df.select(F.col(year_col).cast("int").alias(year_out),
                    *[_cast_text(c, decided.get(c, "string")) for c in cols])
    return add_lineage(out, processing_date=processing_date, year_col=year_out)


_SPARK = {"long": LongType(), "double": DoubleType(), "string": StringType()}


def harmonize_union(df1: DataFrame, df2: DataFrame) -> DataFrame:
    """H1: union on the superset of columns; a type clash makes both sides string.

    Missing columns become NULL; NULL stays NULL when cast to string.
    """
    return harmonize_all([df1, df2])


def harmonize_all(frames: list[DataFrame], widen_numeric: bool = False) -> DataFrame:
    """H3 over typed frames: the target type per column is decided over all frames at once.

    A column whose types differ between frames becomes string in every frame
    (``widen_numeric`` lets long/int/double meet at double instead); missing
    columns are NULL; columns come out sorted (F4).
    """
    types: dict[str, set[str]] = {}
    for f in frames:
        for fld in f.schema.fields:
            types.setdefault(fld.name, set()).add(fld.dataType.simpleString())
    target: dict[str, DataType | None] = {}
    for c, ts in types.items():
        if len(ts) == 1:
            target[c] = None
        elif widen_numeric and ts <= {"int", "bigint", "double", "float", "smallint", "tinyint"}:
            target[c] = DoubleType()
        else:
            target[c] = StringType()
    cols = sorted(types)
    out = None
    for f in frames:
        sel = []
        for c in cols:
            if c in f.columns:
                sel.append(F.col(f"`{c}`").cast(target[c]).alias(c) if target[c] is not None else F.col(f"`{c}`"))
            else:
                dt = target[c] or next(fr.schema[c].dataType for fr in frames if c in fr.columns)
                sel.append(F.lit(None).cast(dt).alias(c))
        part = f.select(*sel)
        out = part if out is None else out.unionByName(part)
    return out


def master_schema(inv_types: DataFrame, year_col: str = "shard_year") -> DataFrame:
    """H4: the latest shard's (column, dtype) list is the target schema."""
    latest = inv_types.select(F.max(year_col)).scalar()
    return inv_types.filter(F.col(year_col) == latest).select("column", "dtype")


def cast_to_master(df: DataFrame, master: dict[str, str]) -> DataFrame:
    """H5: cast to the master dtypes; values that do not fit become NULL."""
    exprs = {}
    for c, t in master.items():
        if c not in df.columns:
            continue
        col = F.col(f"`{c}`")
        if t.startswith("int"):
            exprs[c] = to_long(col)
        elif t.startswith("float"):
            exprs[c] = to_number(col)
        elif t.startswith("datetime"):
            exprs[c] = F.try_to_timestamp(col.cast("string"))
        else:
            exprs[c] = col.cast("string")
    return df.withColumns(exprs)


def standardize_helmet(df: DataFrame, col: str = "HELMET_IND") -> DataFrame:
    """H6: upper-case and trim; blank, missing or unknown codes become 'U'."""
    if col not in df.columns:
        return df
    v = F.upper(F.trim(F.col(col)))
    return df.withColumn(col, F.when(v.isin(*HELMET_VALID), v).otherwise(F.lit(HELMET_UNKNOWN)))


def helmet_invalid_count(df: DataFrame, col: str = "HELMET_IND") -> DataFrame:
    """H6 counter: values that standardization turns into 'U' although not blank/NULL."""
    v = F.upper(F.trim(F.col(col)))
    return df.agg(F.count_if(v.isNotNull() & (v != "") & ~v.isin(*HELMET_VALID)).alias("invalid_helmet"))


def rename_columns(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """old -> new renames; where both exist, the new column is filled from the old."""
    out = df
    for old, new in mapping.items():
        if old not in out.columns:
            continue
        if new in out.columns:
            out = out.withColumn(new, F.coalesce(F.col(new), F.col(old).cast(out.schema[new].dataType))).drop(old)
        else:
            out = out.withColumnRenamed(old, new)
    return out


def add_lineage(df: DataFrame, year: int | None = None, processing_date: str | None = None,
                year_col: str = "DATA_YEAR") -> DataFrame:
    """``DATA_YEAR`` (when given) and one ``PROCESSING_DATE`` literal for the run."""
    pd_text = processing_date or datetime.now(timezone.utc).replace(tzinfo=None).isoformat()
    out = df if year is None else df.withColumn(year_col, F.lit(int(year)))
    return out.withColumn("PROCESSING_DATE", F.lit(pd_text))


def sorted_columns(df: DataFrame) -> DataFrame:
    """columns in alphabetical order."""
    return df.select(*[F.col(f"`{c}`") for c in sorted(df.columns)])
