"""Analyses the documentation describes (X1-X15), as ordinary Spark queries."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadbook.constants import PEDESTRIAN_TYPE
from roadbook.functions.coords import decimal_places
from roadbook.operators.harmonize import standardize_helmet
from roadbook.operators.joins import join_small

#: Numbers of a MinHash signature: a similarity of 0.5 shares none with probability 2 ** -64, and is estimated within 0.06 (one sigma).
SIGNATURE = 64


def monthly_summary(cw: DataFrame, year: str = "CRASH_YEAR", month: str = "CRASH_MONTH") -> DataFrame:
    """Crashes per (year, month) with adverse-weather share and mean temperature."""
    return cw.groupBy(year, month).agg(
        F.count(F.lit(1)).alias("crashes"),
        F.sum("adverse_weather").cast("bigint").alias("adverse_crashes"),
        F.round(F.avg("temp_avg_c"), 2).alias("avg_temp_c"),
        F.round(F.avg("precipitation_mm"), 2).alias("avg_precip_mm"))


def area_aggregate(df: DataFrame, cell_deg: float = 0.01, lat: str = "DEC_LATITUDE", lon: str = "DEC_LONGITUDE",
                   severity: str = "MAX_SEVERITY_LEVEL") -> DataFrame:
    """Crash count and worst severity per grid cell instead of raw points."""
    pts = df.filter(F.col(lat).isNotNull() & F.col(lon).isNotNull())
    return pts.groupBy(F.floor(F.col(lat) / F.lit(cell_deg)).alias("cell_lat"),
                       F.floor(F.col(lon) / F.lit(cell_deg)).alias("cell_lon")).agg(
        F.count(F.lit(1)).alias("crashes"), F.max(severity).alias("max_severity"))


def deletion_variants(col: str, k: int) -> "F.Column":
    """All strings obtained by deleting at most ``k`` characters (k <= 2), as an array.

    Two strings within ``k`` edits always share such a variant (symmetric
    deletion), so an equi-join on variants finds every near pair without
    comparing all pairs.
    """
    s = F.upper(F.col(col))
    n = F.length(s)
    out = F.array(s)
    if k >= 1:
        one = F.transform(F.sequence(F.lit(1), n), lambda i: F.concat(F.substring(s, 1, i - 1), F.substring(s, i + 1, 10_000)))
        out = F.concat(out, one)
    if k >= 2:
        two = F.flatten(F.transform(F.sequence(F.lit(1), n), lambda i: F.transform(
            F.sequence(i + 1, F.greatest(n, i + 1)),
            lambda j: F.concat(F.substring(s, 1, i - 1), F.substring(s, i + 1, j - i - 1), F.substring(s, j + 1, 10_000)))))
        out = F.concat(out, two)
    if k > 2:
        raise ValueError("deletion neighbourhoods are built for k <= 2")
    return F.array_distinct(out)


def rename_detection(inventory: DataFrame, year_col: str = "shard_year", max_distance: int = 2) -> DataFrame:
    """Candidate renames — an old column whose last year precedes a new column's first year,
    with names within ``max_distance`` edits (case-insensitive).

    Candidates come from an equi-join on deletion variants (exact for edit
    distance, no all-pairs product); ``levenshtein`` confirms each one.
    """
    spans = inventory.groupBy("column").agg(F.min(year_col).alias("first_year"), F.max(year_col).alias("last_year"))
    var = spans.select("column", "first_year", "last_year",
                       F.explode(deletion_variants("column", max_distance)).alias("_v"))
    a = var.select(F.col("column").alias("old_column"), F.col("last_year").alias("old_last"), "_v")
    b = var.select(F.col("column").alias("new_column"), F.col("first_year").alias("new_first"), "_v")
    cand = (a.join(b, "_v").filter((F.col("old_column") != F.col("new_column")) & (F.col("old_last") < F.col("new_first")))
            .select("old_column", "old_last", "new_column", "new_first").distinct())
    dist = F.levenshtein(F.upper(F.col("old_column")), F.upper(F.col("new_column")))
    return (cand.withColumn("distance", dist).filter(F.col("distance") <= max_distance)
            .select("old_column", "new_column", "old_last", "new_first", "distance"))


def value_signatures(long: DataFrame, column: str = "column", value: str = "value", size: int = SIGNATURE) -> DataFrame:
    """(column, values): MinHash signature of each column's set of values; combined before the shuffle, ``size`` numbers a column."""
    v = F.col(value)
    some = long.filter(v.isNotNull())
    return some.groupBy(column).agg(F.array(*[F.min(F.xxhash64(v, F.lit(j))) for j in range(size)]).alias("values"))


def rename_hints(inventory: DataFrame, signatures: DataFrame | None = None, year_col: str = "shard_year", max_distance: int = 2,
                 least_similar: float = 0.5) -> DataFrame:
    """Candidate renames by place, name and content — an old column whose last year precedes a new column's first year.

    ``inventory`` has (year, column, ordinal). A pair is a candidate if, in the
    old column's last year and the new one's first, both stand at the same
    place (``same_place``) and one name starts with the other, or both stand
    between the same neighbours (``same_neighbours``); if the names are within
    ``max_distance`` edits (``distance``); or if their value sets agree: with
    ``signatures`` (see :func:`value_signatures`) ``similarity`` estimates the
    Jaccard similarity, and ``least_similar`` is asked of it. Every candidate
    comes from an equi-join on the place, the neighbours, a deletion variant
    or an equal signature number.
    """
    by_place = Window.partitionBy(year_col).orderBy("ordinal")      # the columns of one year's shard
    placed = inventory.select(year_col, "column", "ordinal", F.lag("column", 1, "").over(by_place).alias("prev"),
                              F.lead("column", 1, "").over(by_place).alias("next"))
    at = F.struct(year_col, "ordinal", "prev", "next")
    spans = placed.groupBy("column").agg(F.max(at).alias("last"), F.min(at).alias("first"))
    old = spans.select(F.col("column").alias("old_column"), F.col("last").alias("o"))
    new = spans.select(F.col("column").alias("new_column"), F.col("first").alias("n"))
    pairs = [(F.col("o.ordinal"), F.col("n.ordinal")), (F.struct("o.prev", "o.next"), F.struct("n.prev", "n.next"))]
    found = [old.withColumn("_k", a).join(new.withColumn("_k", b), "_k").drop("_k") for a, b in pairs]
    found.append(old.withColumn("_k", F.explode(deletion_variants("old_column", max_distance))).join(
        new.withColumn("_k", F.explode(deletion_variants("new_column", max_distance))), "_k").drop("_k"))
    if signatures is not None:
        sig_o, sig_n = (signatures.select(F.col("column").alias(f"{side}_column"), F.posexplode("values").alias("_j", "_v")) for side in ("old", "new"))
        met = sig_o.join(sig_n, ["_j", "_v"]).select("old_column", "new_column").distinct()
        found.append(met.join(old, "old_column").join(new, "new_column").select(*found[0].columns))
    cand = found[0]
    for f in found[1:]:
        cand = cand.unionByName(f)
    cand = cand.distinct().filter((F.col("old_column") != F.col("new_column")) & (F.col(f"o.{year_col}") < F.col(f"n.{year_col}")))
    a, b = F.upper("old_column"), F.upper("new_column")
    cand = cand.withColumns({
        "distance": F.levenshtein(a, b), "same_place": F.col("o.ordinal") == F.col("n.ordinal"),
        "same_neighbours": (F.col("o.prev") == F.col("n.prev")) & (F.col("o.next") == F.col("n.next"))})
    cand = cand.withColumn("_begins", F.startswith(a, b) | F.startswith(b, a))
    similar = F.lit(None).cast("double")
    if signatures is not None:
        own = signatures.select("column", F.col("values"))
        cand = cand.join(own.select(F.col("column").alias("old_column"), F.col("values").alias("_ov")), "old_column", "left").join(
            own.select(F.col("column").alias("new_column"), F.col("values").alias("_nv")), "new_column", "left")
        similar = F.size(F.filter(F.zip_with("_ov", "_nv", lambda x, y: x == y), lambda x: x)) / F.size("_ov")
        similar = F.when(F.col("_ov").isNotNull() & F.col("_nv").isNotNull(), similar)
    cand = cand.withColumn("similarity", similar)
    kept = ((F.col("same_place") & F.col("_begins")) | F.col("same_neighbours") | (F.col("distance") <= max_distance)
            | F.coalesce(F.col("similarity") >= least_similar, F.lit(False)))
    return cand.filter(kept).select("old_column", "new_column", F.col(f"o.{year_col}").alias("old_last"), F.col(f"n.{year_col}").alias("new_first"),
                                    "distance", "same_place", "same_neighbours", "similarity")


def low_precision_flag(df: DataFrame, lat: str = "DEC_LATITUDE", lon: str = "DEC_LONGITUDE",
                       min_decimals: int = 4) -> DataFrame:
    """``low_precision`` when either coordinate has fewer than ``min_decimals`` decimals."""
    lp, op = decimal_places(lat), decimal_places(lon)
    return df.withColumn("low_precision", F.coalesce((lp < min_decimals) | (op < min_decimals), F.lit(False)))


def duplicate_keys(df: DataFrame, key: str = "CRN") -> DataFrame:
    """Keys that occur more than once, with their counts."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def orphans(child: DataFrame, parent: DataFrame, key: str = "CRN") -> DataFrame:
    """Child rows whose key has no parent row (NULL keys included)."""
    return child.join(parent.select(key).distinct(), key, "left_anti")


def exact_quantiles(df: DataFrame, group: str, value: str, probs: list[float], buckets: int = 100,
                    accuracy: int = 1_000, max_collect: int = 100_000, max_rounds: int = 16) -> DataFrame:
    """Exact discrete quantiles per group: the ceil(p*n)-th smallest value (NULL/NaN ignored).

    Bracket refinement, one pass over the data per round:

    * the first pass counts each group and sketches it at ``buckets`` evenly
      spaced ranks (``percentile_approx``; with ``accuracy >= buckets`` its
      rank error is below one bucket, so a one-bucket margin around the
      target keeps it inside the bracket);
    * later passes count exactly, per bracket, the values below it and the
      tie blocks on its two bounds, and sketch the values strictly inside;
      a target rank inside a bound's tie block is answered by that bound;
    * once the sketch bounds a bracket's interior by ``max_collect`` values,
      the next pass sorts just those values in one task and picks the exact
      element; otherwise the bracket shrinks about ``buckets / 3`` times.

    Targets that share a bracket share its aggregation. Memory per task is
    bounded by the sketch and ``max_collect``; only one small row per bracket
    and target reaches the driver. Returns (group, p, value).
    """
    if accuracy < buckets:
        raise ValueError("accuracy must be at least buckets")
    spark = df.sparkSession
    data = df.select(F.col(group).cast("string").alias("_g"), F.col(value).cast("double").alias("_v"))
    data = data.filter(F.col("_v").isNotNull() & ~F.isnan("_v"))
    pcts = [i / buckets for i in range(buckets + 1)]

    def narrow(st: dict, ki: int, m: int, q: list) -> None:
        j_lo = max(0, math.floor((ki - 1) * buckets / m) - 1)
        j_hi = min(buckets, math.ceil(ki * buckets / m) + 1)
        st["lo"], st["hi"] = q[j_lo], q[j_hi]
        st["collect"] = (j_hi - j_lo) * m / buckets + 2 * m / accuracy <= max_collect

    state: dict[int, dict] = {}
    first = data.groupBy("_g").agg(F.count(F.lit(1)).alias("n"), F.percentile_approx("_v", pcts, accuracy).alias("q"))
    for r in first.collect():                                   # one row per group
        for p in probs:
            st = {"g": r["_g"], "p": float(p), "k": max(1, math.ceil(p * r["n"])), "lo": None, "hi": None,
                  "collect": r["n"] <= max_collect, "value": None}
            if not st["collect"]:
                narrow(st, st["k"], r["n"], r["q"])
            state[len(state)] = st
    v, lo, hi = F.col("_v"), F.col("lo"), F.col("hi")
    for _ in range(max_rounds):
        open_ = {t: st for t, st in state.items() if st["value"] is None}
        if not open_:
            break
        keys = sorted({(st["g"], st["lo"], st["hi"], st["collect"]) for st in open_.values()}, key=str)
        bid = {k: i for i, k in enumerate(keys)}
        brackets = spark.createDataFrame([(i, *k) for k, i in bid.items()],
                                         "bid int, _g string, lo double, hi double, collect boolean")
        tgt = spark.createDataFrame([(t, bid[(st["g"], st["lo"], st["hi"], st["collect"])], st["k"])
                                     for t, st in open_.items()], "tid int, bid int, k long")
        inside = (lo.isNull() | (v > lo)) & (hi.isNull() | (v < hi))
        agg = data.join(F.broadcast(brackets), "_g").groupBy("bid", "collect").agg(
            F.count_if(lo.isNotNull() & (v < lo)).alias("below"),
            F.count_if(v == lo).alias("eq_lo"),
            F.count_if(v == hi).alias("eq_hi"),
            F.count_if(inside).alias("m"),
            F.percentile_approx(F.when(inside & ~F.col("collect"), v), pcts, accuracy).alias("q"),
            F.sort_array(F.collect_list(F.when(inside & F.col("collect"), v))).alias("_vals"))
        rank = F.col("k") - F.col("below") - F.col("eq_lo")
        res = agg.join(F.broadcast(tgt), "bid").select(
            "tid", "below", "eq_lo", "eq_hi", "m", "q",
            F.when(F.col("collect") & (rank >= 1) & (rank <= F.size("_vals")),
                   F.element_at("_vals", rank.cast("int"))).alias("picked"))
        for r in res.collect():                                 # one row per open target
            st = state[r["tid"]]
            kk = st["k"] - r["below"]                           # rank within [lo, hi]
            eq_lo = r["eq_lo"] if st["lo"] is not None else 0
            eq_hi = r["eq_hi"] if st["hi"] is not None and st["hi"] != st["lo"] else 0
            m = r["m"]
            if not 1 <= kk <= eq_lo + m + eq_hi:
                raise RuntimeError("quantile bracket lost its target")
            if kk <= eq_lo:
                st["value"] = st["lo"]
            elif kk > eq_lo + m:
                st["value"] = st["hi"]
            elif st["collect"]:
                st["value"] = r["picked"]
            elif m <= max_collect:
                st["collect"] = True
            else:
                narrow(st, kk - eq_lo, m, r["q"])
    if any(st["value"] is None for st in state.values()):
        raise RuntimeError("quantile refinement did not converge; raise max_rounds")
    return spark.createDataFrame([(st["g"], st["p"], st["value"]) for st in state.values()],
                                 f"{group} string, p double, value double")


def _number(c: str) -> Column:
    """A column's values as doubles; NaN is no value."""
    v = F.col(f"`{c}`").cast("double")
    return F.when(~F.isnan(v), v)


def column_quantiles(df: DataFrame, cols: list[str], probs: list[float], k: int = 8_000, margin: float = 0.002,
                     max_collect: int = 100_000) -> DataFrame:
    """Exact discrete quantiles of columns, (field, p, value), in two passes over the rows as they are.

    The first pass sketches each column (KLL, mergeable, a few kilobytes per
    task and column) and brackets each target by the quantiles ``margin`` below
    and above it; with ``k`` = 8,000 the sketch is off by a quarter of that at
    99 % confidence. The second pass counts exactly what lies below a bracket
    and on its bounds, and collects the values strictly inside, 2 * ``margin``
    of the column. A column with more than ``max_collect`` of them, or whose
    target isn't in its bracket, goes to :func:`exact_quantiles`, whose memory
    is bounded at any size.
    """
    spark = df.sparkSession
    firsts = [a for i, c in enumerate(cols) for a in (F.count(_number(c)).alias(f"n{i}"), F.kll_sketch_agg_double(_number(c), k).alias(f"s{i}"))]
    ends = [F.when(F.col(f"n{i}") > 0, F.kll_sketch_get_quantile_double(f"s{i}", F.lit(q))).alias(f"{side}{i}_{j}")
            for i in range(len(cols)) for j, p in enumerate(probs)
            for side, q in (("lo", max(0.0, p - margin)), ("hi", min(1.0, p + margin)))]
    known = df.agg(*firsts).select(*[f"n{i}" for i in range(len(cols))], *ends).first()
    found, late, counted = [], [], []
    for i, c in enumerate(cols):
        if known[f"n{i}"] and 2 * margin * known[f"n{i}"] > max_collect:
            late.append(c)
        elif known[f"n{i}"]:
            for j in range(len(probs)):
                v, lo, hi = _number(c), F.lit(known[f"lo{i}_{j}"]), F.lit(known[f"hi{i}_{j}"])
                counted += [F.count_if(v < lo).alias(f"below{i}_{j}"), F.count_if(v == lo).alias(f"lo{i}_{j}"), F.count_if(v == hi).alias(f"hi{i}_{j}"),
                            F.sort_array(F.collect_list(F.when((v > lo) & (v < hi), v))).alias(f"in{i}_{j}")]
    exact = df.agg(*counted).first() if counted else None
    for i, c in enumerate(cols):
        if not known[f"n{i}"] or c in late:
            continue
        for j, p in enumerate(probs):
            lo, hi = known[f"lo{i}_{j}"], known[f"hi{i}_{j}"]
            at = max(1, math.ceil(p * known[f"n{i}"])) - exact[f"below{i}_{j}"]      # rank from the bracket's lower bound on
            values = exact[f"in{i}_{j}"]
            on_lo, inside, on_hi = exact[f"lo{i}_{j}"], len(values), 0 if lo == hi else exact[f"hi{i}_{j}"]
            if 1 <= at <= on_lo:
                found.append((c, float(p), lo))
            elif on_lo < at <= on_lo + inside:
                found.append((c, float(p), values[at - on_lo - 1]))
            elif on_lo + inside < at <= on_lo + inside + on_hi:
                found.append((c, float(p), hi))
            elif c not in late:
                late.append(c)
    found = [r for r in found if r[0] not in late]
    out = spark.createDataFrame(found, "field string, p double, value double")
    if late:
        entries = F.array(*[F.struct(F.lit(c).alias("field"), _number(c).alias("value")) for c in late])
        out = out.unionByName(exact_quantiles(df.select(F.inline(entries)), "field", "value", probs, max_collect=max_collect))
    return out


def numeric_outliers(df: DataFrame, cols: list[str], k: float = 1.5, exact: bool = True,
                     accuracy: int = 10_000) -> DataFrame:
    """Per numeric field, quartiles, IQR fences and the number of values outside them.

    ``exact=True`` uses :func:`column_quantiles` (the ceil(p*n)-th smallest
    value, two passes); ``exact=False`` uses one ``percentile_approx`` pass
    (mergeable sketch, rank error at most ``rows / accuracy``). The outliers
    are counted in one more pass that leaves the columns side by side.
    """
    if exact:
        marks = column_quantiles(df, cols, [0.25, 0.75]).collect()      # two rows per column
        q = {c: tuple(next(r["value"] for r in marks if (r["field"], r["p"]) == (c, p)) for p in (0.25, 0.75)) for c in {r["field"] for r in marks}}
    else:
        row = df.agg(*[F.percentile_approx(_number(c), [0.25, 0.75], accuracy).alias(f"q{i}") for i, c in enumerate(cols)]).first()
        q = {c: tuple(row[f"q{i}"]) for i, c in enumerate(cols) if row[f"q{i}"]}
    fences = {c: (q1, q3, q3 - q1, q1 - k * (q3 - q1), q3 + k * (q3 - q1)) for c, (q1, q3) in sorted(q.items())}
    if not fences:
        return df.sparkSession.createDataFrame([], "field string, q1 double, q3 double, iqr double, lower double, upper double, n_outliers long, n_values long")
    counted = df.agg(*[x for i, (c, f) in enumerate(fences.items()) for x in (
        F.count_if((_number(c) < f[3]) | (_number(c) > f[4])).alias(f"o{i}"), F.count(_number(c)).alias(f"n{i}"))])
    names = ("field", "q1", "q3", "iqr", "lower", "upper")
    rows = [F.struct(*[F.lit(x).alias(n) for n, x in zip(names, (c, *f), strict=True)], F.col(f"o{i}").alias("n_outliers"), F.col(f"n{i}").alias("n_values"))
            for i, (c, f) in enumerate(fences.items())]
    return counted.select(F.inline(F.array(*rows)))


def weekday_multi_weather(cw_dates: DataFrame, weather_by_wd: DataFrame, year: str = "CRASH_YEAR",
                          month: str = "CRASH_MONTH", dow: str = "DAY_OF_WEEK") -> DataFrame:
    """Attach weather averaged over every day of the crash's (year, month, weekday)."""
    w = weather_by_wd.withColumnsRenamed({"wx_year": year, "wx_month": month, "wx_weekday": dow})
    w = w.withColumnsRenamed({c: f"{c}_wdavg" for c in w.columns if c not in (year, month, dow)})
    return join_small(cw_dates, w, [year, month, dow], "left")


def adverse_vs_clear(cw: DataFrame, month: str = "CRASH_MONTH") -> DataFrame:
    """Crashes by month and adverse-weather flag."""
    return cw.groupBy(month, "adverse_weather").agg(F.count(F.lit(1)).alias("crashes"))


def helmet_by_severity(cyclist: DataFrame, severity: str = "MAX_SEVERITY_LEVEL", helmet: str = "HELMET_IND") -> DataFrame:
    """Cyclist rows by severity (rows) and standardized helmet use (columns Y/N/U)."""
    s = standardize_helmet(cyclist, helmet)
    return s.groupBy(severity).pivot(helmet, ["Y", "N", "U"]).agg(F.count(F.lit(1)))


def by_month(df: DataFrame, month: str = "CRASH_MONTH", key: str = "CRN") -> DataFrame:
    """X11: distinct crashes per month."""
    return df.groupBy(month).agg(F.count_distinct(key).alias("crashes"))


def by_hour(df: DataFrame, hour: str = "HOUR_OF_DAY", key: str = "CRN") -> DataFrame:
    """X11: distinct crashes per hour of day."""
    return df.groupBy(hour).agg(F.count_distinct(key).alias("crashes"))


def person_type_gap(crash: DataFrame, person: DataFrame, key: str = "CRN", ped_col: str = "PED_COUNT",
                    person_type: str = "PERSON_TYPE", value: str = PEDESTRIAN_TYPE) -> DataFrame:
    """Crashes that report pedestrians but have no pedestrian person row."""
    peds = person.filter(F.col(person_type) == value).select(key).distinct()
    return crash.filter(F.col(ped_col).cast("double") > 0).join(peds, key, "left_anti")
