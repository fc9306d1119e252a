"""Secrets in texts, by fixed forms and a randomness test battery (operator 6).

Everything is a DataFrame expression. Three kinds have a fixed form (assign,
access, hex; see ``FORMS``). The kind ``random`` comes from tests on every run
of MIN_LENGTH or more characters of an encoded value that holds a digit and a
letter and no base span:

- The encoding is inferred: the smallest of hex, base32, base36, base62 and
  base64 that holds the run (padding aside).
- A run takes part if ordinary writing, whose letters are uneven, hardly makes
  it: the number of equal pairs of characters is compared with its mean and
  variance under English letter frequencies, and its p-value, which needs
  length to be small, must be at most WRITING_LEVEL.
- Battery, against a uniform draw from the run's alphabet: chi-squared of the
  letters' counts (Wilson-Hilferty), runs above and below the alphabet's
  middle, serial correlation at lag 1. The least p-value, times three
  (Bonferroni), is the run's.
- False-discovery control (Benjamini-Hochberg) over the runs' p-values, by
  length class (powers of two), as the power of the tests grows with length: a
  run found not to be a uniform draw is dropped, and of the runs dropped at most
  FALSE_DISCOVERIES are expected to be random. The others are secrets. The
  control works on a histogram of p-values, whose size doesn't depend on the
  data; a bin counts with its upper edge.

Positions are code points, ends exclusive. A run of matches is placed by
adding up the lengths of what lies between them.

Cases: null and empty texts have no span; texts of any length are scanned
whole; repeated rows get the same spans; an empty table gives an empty result;
columns of the input named like an output column are replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadbook.llm.common import written

#: Fixed: kind, pattern, group whose length counts (0: the match), its least length, a cheap text that each match holds.
FORMS = (
    ("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6,
     ("password", "passwd", "secret", "token", "apikey", "api_key")),
    ("access", r"AKIA[A-Z0-9]+", 0, 20, ("AKIA",)),
    ("hex", r"[0-9a-f]{24,}", 0, 24, ()),
)
KINDS = ("assign", "access", "hex", "random")

MIN_LENGTH = 20
RUN = rf"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{{{MIN_LENGTH},}}+={{0,2}}"
#: Fixed: sums of the squared and cubed letter frequencies of English; of hex digits in ordinary writing, double those of a uniform draw.
WRITING = {"letters": (0.0667, 0.0054), "hex": (0.125, 0.0172)}
ALPHABETS = {
    "hex": "0123456789abcdef",
    "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "base36": "0123456789abcdefghijklmnopqrstuvwxyz",
    "base62": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789",
    "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
}
WRITING_LEVEL, FALSE_DISCOVERIES, BIN, BINS = 0.001, 0.01, 0.1, 400

SPAN = "struct<start:bigint,place:int,end:bigint,kind:string>"


def _running(steps: Column) -> Column:
    """Running sums of an array, in blocks of about the square root of its size."""
    width = F.greatest(F.lit(1), F.ceil(F.sqrt(F.size(steps)))).cast("int")
    starts = F.sequence(F.lit(0), F.greatest(F.lit(0), (F.size(steps) - 1) / width).cast("int"))

    def total(items: Column) -> Column:
        return F.aggregate(items, F.lit(0).cast("bigint"), lambda a, x: a + x)

    sums = F.transform(starts, lambda b: total(F.slice(steps, b * width + 1, width)))
    held = F.array(F.struct(sums.alias("sums"), width.alias("width")))
    return F.flatten(F.transform(held, lambda h: F.transform(steps, lambda _, i: total(
        F.concat(F.slice(h["sums"], F.lit(1), (i / h["width"]).cast("int")),
                 F.slice(steps, (i / h["width"]).cast("int") * h["width"] + 1, i % h["width"] + 1))))))


def _spans(text: Column, found: Column, pattern: str, place: int, kind: str) -> Column:
    """Spans of all matches, in order."""
    between = F.split(text, pattern)
    steps = F.transform(found, lambda m, i: (F.length(between[i]) + F.when(i > 0, F.length(found[i - 1])).otherwise(0)).cast("bigint"))
    ends = F.array(_running(steps))
    return F.flatten(F.transform(ends, lambda at: F.transform(found, lambda m, i: F.struct(
        at[i].alias("start"), F.lit(place).alias("place"), (at[i] + F.length(m)).alias("end"), F.lit(kind).alias("kind")))))


def normal_tail(z: Column) -> Column:
    """P(Z > z): Abramowitz and Stegun 26.2.17 (error below 1e-7) up to 5, then the asymptotic density bound."""
    x = F.abs(z)
    t = F.lit(1.0) / (1 + F.lit(0.2316419) * x)
    poly = t * (F.lit(0.319381530) + t * (F.lit(-0.356563782) + t * (F.lit(1.781477937) + t * (F.lit(-1.821255978) + t * F.lit(1.330274429)))))
    tail = F.exp(-x * x / 2) * F.lit(0.3989422804014327) * poly
    return F.when(z >= 0, tail).otherwise(1 - tail)


def _judged(run: Column, start: Column) -> Column:
    """start, end, class (of the length), battery (its least p-value times three), bin (of it), writing (p-value against writing)."""
    body = F.regexp_replace(run, "=+$", "")
    encoding = (F.when(body.rlike("^(?:[0-9a-f]+|[0-9A-F]+)$"), "hex").when(body.rlike("^[A-Z2-7]+$"), "base32")
                .when(body.rlike("^[0-9a-z]+$"), "base36").when(body.rlike("^[0-9A-Za-z]+$"), "base62").otherwise("base64"))

    def one(column: str, x: Column) -> Column:
        return x.alias(column)

    def step(held: Column, f) -> Column:
        """f(x) for the single value of ``held``: a local name in an expression."""
        return F.transform(held, f)

    letters = step(F.array(F.struct(one("body", body), one("encoding", encoding))), lambda x: F.struct(
        one("v", F.transform(F.split(F.when(x["encoding"] == "hex", F.lower(x["body"])).otherwise(F.translate(x["body"], "-_", "+/")), ""),
                             lambda c: F.coalesce(*[F.when(x["encoding"] == k, F.call_function("instr", F.lit(a), c)) for k, a in ALPHABETS.items()]) - 1)),
        one("size", F.coalesce(*[F.when(x["encoding"] == k, F.lit(float(len(a)))) for k, a in ALPHABETS.items()])),
        one("s2", F.when(x["encoding"] == "hex", WRITING["hex"][0]).otherwise(WRITING["letters"][0])),
        one("s3", F.when(x["encoding"] == "hex", WRITING["hex"][1]).otherwise(WRITING["letters"][1])),
        one("n", F.length(x["body"]).cast("double"))))

    def add(items: Column) -> Column:
        return F.aggregate(items, F.lit(0.0), lambda a, y: a + y.cast("double"))

    sums = step(letters, lambda x: F.struct(
        one("n", x["n"]), one("size", x["size"]), one("s2", x["s2"]), one("s3", x["s3"]),
        one("equal", add(F.transform(F.array_distinct(x["v"]), lambda d: F.size(F.filter(x["v"], lambda y: y == d)) * (F.size(F.filter(x["v"], lambda y: y == d)) - 1)))),
        one("high", add(F.transform(x["v"], lambda y: (y >= x["size"] / 2).cast("double")))),
        one("turns", add(F.transform(x["v"], lambda y, i: ((i > 0) & ((y >= x["size"] / 2) != (x["v"][F.greatest(i - 1, F.lit(0))] >= x["size"] / 2))).cast("double")))),
        one("mean", add(x["v"]) / x["n"]), one("v", x["v"])))
    stats = step(sums, lambda x: F.struct(
        one("n", x["n"]), one("equal", x["equal"]), one("s2", x["s2"]), one("s3", x["s3"]),
        one("chi", x["size"] / x["n"] * (x["equal"] + x["n"]) - x["n"]), one("free", x["size"] - 1),
        one("two", 2 * x["high"] * (x["n"] - x["high"])), one("runs", x["turns"] + 1),
        one("serial", add(F.transform(x["v"], lambda y, i: F.when(i > 0, (y - x["mean"]) * (x["v"][F.greatest(i - 1, F.lit(0))] - x["mean"])).otherwise(0.0)))
            / F.greatest(F.lit(1e-9), add(F.transform(x["v"], lambda y: (y - x["mean"]) * (y - x["mean"])))))))
    tests = step(stats, lambda x: F.struct(
        one("n", x["n"]),
        one("p_chi", normal_tail((F.pow(x["chi"] / x["free"], F.lit(1 / 3)) - (1 - 2 / (9 * x["free"]))) / F.sqrt(2 / (9 * x["free"])))),
        one("p_runs", 2 * normal_tail(F.abs(x["runs"] - 1 - x["two"] / x["n"]) / F.sqrt(F.greatest(F.lit(1e-9), x["two"] * (x["two"] - x["n"]) / (x["n"] * x["n"] * (x["n"] - 1)))))),
        one("p_serial", 2 * normal_tail(F.abs(x["serial"] + 1 / x["n"]) * F.sqrt(x["n"]))),
        one("p_writing", normal_tail((x["n"] * (x["n"] - 1) * x["s2"] - x["equal"]) / F.sqrt(
            4 * x["n"] * (x["n"] - 1) * (x["n"] - 2) * (x["s3"] - x["s2"] * x["s2"]) + 2 * x["n"] * (x["n"] - 1) * (x["s2"] - x["s2"] * x["s2"]))))))
    combined = step(tests, lambda x: F.struct(
        one("n", x["n"]), one("writing", x["p_writing"]), one("battery", F.least(F.lit(1.0), 3 * F.least(x["p_chi"], x["p_runs"], x["p_serial"])))))
    return step(combined, lambda x: F.struct(
        start.alias("start"), (start + F.length(run)).alias("end"), F.floor(F.log2(x["n"])).cast("int").alias("class"),
        F.least(F.lit(BINS), F.floor(-F.log(F.greatest(x["battery"], F.lit(1e-300))) / BIN)).cast("int").alias("bin"),
        x["battery"].alias("battery"), x["writing"].alias("writing")))[0]


def scanned(docs: DataFrame, keep: Sequence[str], text: str = "text") -> DataFrame:
    """``keep`` columns with __base (spans) and __runs (judged candidate runs); written once."""
    content = F.coalesce(F.col(text), F.lit(""))
    out = docs.withColumn("__text", content).withColumn("__low", F.lower("__text"))
    none = F.array().cast("array<string>")
    bases = []
    for place, (kind, pattern, group, least, holds) in enumerate(FORMS):
        within = F.col("__low") if pattern.startswith("(?i)") else F.col("__text")
        may = F.lit(True)
        if holds:
            may = F.lit(False)
            for h in holds:
                may = may | F.contains(within, F.lit(h))
        out = out.withColumn(f"__m{place}", F.when(may, F.regexp_extract_all("__text", F.lit(pattern), F.lit(0))).otherwise(none))
        spans = _spans(F.col("__text"), F.col(f"__m{place}"), pattern, place, kind)
        sizes = F.transform(F.regexp_extract_all("__text", F.lit(pattern), F.lit(group)) if group else F.col(f"__m{place}"), F.length)
        kept = F.transform(F.filter(F.arrays_zip(spans.alias("s"), sizes.alias("n")), lambda x: x["n"] >= least), lambda x: x["s"])
        bases.append(F.when(F.size(f"__m{place}") > 0, kept).otherwise(F.array().cast(f"array<{SPAN}>")))
    out = out.withColumn("__base", F.array_sort(F.concat(*bases)))
    out = out.withColumn("__m9", F.regexp_extract_all("__text", F.lit(RUN), F.lit(0)))
    runs = F.filter(F.arrays_zip(_spans(F.col("__text"), F.col("__m9"), RUN, 3, "random").alias("s"), F.col("__m9").alias("run")),
                    lambda x: x["run"].rlike("[0-9]") & x["run"].rlike("[A-Za-z]")
                    & ~F.exists(F.col("__base"), lambda b: (b["start"] < x["s"]["end"]) & (x["s"]["start"] < b["end"])))
    judged = F.transform(runs, lambda x: _judged(x["run"], x["s"]["start"]))
    empty = F.array().cast("array<struct<start:bigint,end:bigint,class:int,bin:int,battery:double,writing:double>>")
    out = out.withColumn("__runs", F.when(F.size("__m9") > 0, judged).otherwise(empty))
    return written(out.select(*[F.col(f"`{c}`") for c in keep], "__base", "__runs"), "secret-scan")


def thresholds(found: DataFrame) -> dict[int, int]:
    """Least bin of runs that are found not to be uniform draws, by length class (at most one entry per power of two)."""
    bins = found.select(F.explode("__runs").alias("r")).where(F.col("r.writing") <= WRITING_LEVEL).groupBy("r.class", "r.bin").agg(F.count("*").alias("n"))
    tail = Window.partitionBy("class").orderBy(F.desc("bin"))     # at most BINS + 1 rows a class
    bins = bins.withColumns({"so_far": F.sum("n").over(tail), "all": F.sum("n").over(Window.partitionBy("class"))})
    hit = bins.where(F.exp(-F.col("bin") * BIN) <= FALSE_DISCOVERIES * F.col("so_far") / F.col("all"))
    return {r["class"]: r["bin"] for r in hit.groupBy("class").agg(F.min("bin").alias("bin")).collect()}


def scan(docs: DataFrame, keep: Sequence[str] | None = None, text: str = "text") -> DataFrame:
    """``keep`` columns (all) with ``spans``: array of (start, place of the kind in KINDS, end, kind), by start, then kind."""
    found = scanned(docs, docs.columns if keep is None else keep, text)
    least = thresholds(found)

    def dropped(r: Column) -> Column:
        hit = F.lit(False)
        for length_class, at in sorted(least.items()):
            hit = hit | ((r["class"] == length_class) & (r["bin"] >= at))
        return hit

    chosen = F.transform(F.filter("__runs", lambda r: (r["writing"] <= WRITING_LEVEL) & ~dropped(r)), lambda r: F.struct(
        r["start"].alias("start"), F.lit(3).alias("place"), r["end"].alias("end"), F.lit("random").alias("kind")))
    return found.withColumn("spans", F.array_sort(F.concat("__base", chosen))).drop("__base", "__runs")


def listed(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def redacted(text: Column, spans: Column, mark: str = "[secret]") -> Column:
    """The text with each span, or group of overlapping spans, replaced by ``mark``."""
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<string>").alias("parts"))

    def step(acc: Column, s: Column) -> Column:
        gap = F.array(F.call_function("substring", text, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int")), F.lit(mark))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"),
                        F.when(s["start"] >= acc["at"], F.concat(acc["parts"], gap)).otherwise(acc["parts"]).alias("parts"))

    joined = F.aggregate(spans, start, step, lambda acc: F.concat(F.concat_ws("", acc["parts"]), F.call_function("substring", text, (acc["at"] + 1).cast("int"))))
    return F.when(F.size(spans) > 0, joined).otherwise(text)
