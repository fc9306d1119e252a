"""Join helpers: name-clash suffixes and skew-safe fan-out joins."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _keys(on) -> list[str]:
    return [on] if isinstance(on, str) else list(on)


def suffix_clashes(left_columns: list[str], right: DataFrame, on, suffix: str) -> DataFrame:
    """Rename right-side columns that clash with the left (keys excluded).

    The left keeps its names, the right gets ``suffix``; this is the naming a
    pandas merge with ``suffixes=('', suffix)`` produces.
    """
    keys = set(_keys(on))
    left = set(left_columns)
    clash = {c: c + suffix for c in right.columns if c in left and c not in keys}
    return right.withColumnsRenamed(clash) if clash else right


def join_small(big: DataFrame, small: DataFrame, on, how: str = "left") -> DataFrame:
    """Join against a side that is expected to be small.

    The planner chooses: a written table or a literal list has a known size,
    and a side that ends in a shuffle (an aggregate) has its exact size when
    adaptive execution plans the join, which broadcasts it below
    ``spark.sql.autoBroadcastJoinThreshold`` and sort-merges it above. Nothing
    runs while the plan is built, and the side is computed once.
    """
    return big.join(small, on=_keys(on), how=how)


def split_inner_join(left: DataFrame, right: DataFrame, on, split_rows: int) -> DataFrame:
    """Inner join that splits keys by their number of right rows, not by bytes.

    Adaptive execution finds skew by compressed size, and equal rows compress
    to nearly nothing. Here keys with more than ``split_rows`` right rows are
    dealt to ceil(rows / ``split_rows``) parts, each joined with a copy of the
    key's left rows; L left rows times R right rows cost L * R / ``split_rows``
    copies. Equal rows travel as one row and a number of copies, at most
    ``split_rows`` in a chunk, and are repeated after the join. Parts follow from
    row content and chunk number, so a task that is run again deals alike. All
    other rows are joined as usual.

    Rows are grouped by all columns: -0.0 comes back as 0.0, and columns of map
    type aren't supported. NULL keys match nothing.
    """
    keys, spark = _keys(on), left.sparkSession
    n = right.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > split_rows)
    hot = n.select(*keys, F.ceil(F.col("__n") / split_rows).cast("int").alias("__parts"))
    usual = left.join(join_small(right, hot.select(*keys), keys, "left_anti"), keys)
    columns = [F.col(f"`{c}`") for c in right.columns]
    packed = join_small(right, hot, keys, "inner").groupBy(*columns, "__parts").agg(F.count(F.lit(1)).alias("__n"))
    first = F.explode(F.sequence(F.lit(0).cast("long"), F.col("__n") - 1, F.lit(split_rows).cast("long")))
    chunks = packed.withColumn("__first", first)
    part = F.pmod(F.pmod(F.xxhash64(*columns), F.col("__parts")) + F.floor(F.col("__first") / split_rows), F.col("__parts")).cast("int")
    copies = F.least(F.lit(split_rows), F.col("__n") - F.col("__first")).cast("int")
    # a fixed number of partitions: adaptive execution would merge them, as it measures bytes here too
    dealt = (chunks.select(*columns, part.alias("__part"), copies.alias("__copies"))
             .repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), *keys, "__part"))
    copied = join_small(left, hot, keys, "inner").withColumn("__part", F.explode(F.sequence(F.lit(0), F.col("__parts") - 1))).drop("__parts")
    repeated = copied.join(dealt, [*keys, "__part"]).withColumn("__copy", F.explode(F.array_repeat(F.lit(True), F.col("__copies"))))
    return usual.unionByName(repeated.drop("__part", "__copies", "__copy"))


def fanout_left_join(left: DataFrame, right: DataFrame, on, right_unique: bool = False, split_rows: int | None = None) -> DataFrame:
    """LEFT JOIN that stays balanced when one key holds a huge share of either side.

    Adaptive execution splits a skewed partition on both sides of an inner
    join, but only on the preserved side of a left join. So a left join whose
    right side may hold many rows per key is the union of

    * the inner join,
    * the left rows whose key the right side lacks: an anti-join against the
      right's distinct keys, which are combined before they are shuffled,
    * the left rows with a NULL key, which match nothing and aren't shuffled.

    Both joins read the left side through the same exchange. There are no
    salts and no thresholds. Adaptive execution measures compressed bytes;
    ``split_rows`` splits hot keys by their number of rows instead
    (:func:`split_inner_join`), at the price of one more read of the right side.
    ``right_unique`` marks a right side with one row per key; there a plain
    left join is enough.
    """
    keys = _keys(on)
    extra = [c for c in right.columns if c not in keys]
    if right_unique:
        return left.join(right, keys, "left").select(*left.columns, *extra)
    known = reduce(lambda a, b: a & b, [F.col(f"`{k}`").isNotNull() for k in keys])
    own, r = left.filter(known), right.filter(known)
    columns = [F.col(f"`{c}`") for c in left.columns]
    nothing = [F.lit(None).cast(right.schema[c].dataType).alias(c) for c in extra]
    inner = own.join(r, keys, "inner") if split_rows is None else split_inner_join(own, r, keys, split_rows)
    matched = inner.select(*columns, *[F.col(f"`{c}`") for c in extra])
    lonely = own.join(r.select(*keys).distinct(), keys, "left_anti").select(*columns, *nothing)
    unkeyed = left.filter(~known).select(*columns, *nothing)
    return matched.unionByName(lonely).unionByName(unkeyed)


def join_suffixed(left: DataFrame, right: DataFrame, on, how: str, suffix: str, fanout_safe: bool = True,
                  split_rows: int | None = None) -> DataFrame:
    """Equi-join with right-side name clashes suffixed.

    Left joins go through :func:`fanout_left_join` (``fanout_safe=False``
    marks a right side with one row per key, which cannot be skewed,
    ``split_rows`` splits keys by their number of rows); inner
    joins are plain (AQE splits skew on both sides of those).
    """
    right = suffix_clashes(left.columns, right, on, suffix)
    if how == "left":
        return fanout_left_join(left, right, on, right_unique=not fanout_safe, split_rows=split_rows)
    return left.join(right, on=_keys(on), how=how)
