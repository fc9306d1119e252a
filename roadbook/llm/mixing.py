"""Mixing sources to target weights by pivotal dependent rounding (operator 1).

Every source has a target, the words that the mix takes from it; a document of
a source is due target / source size copies. The whole part is given to all,
the fraction is rounded so that the words taken stay at the target:

- Two documents with open fractions are paired and words are moved from one to
  the other until one of them is due a whole copy or none. Which way they move
  is drawn so that each fraction keeps its expectation; the words due by the
  pair don't change.
- Pairs are folded one after the other inside a chunk of CHUNK documents, and
  each chunk leaves at most one open document. The open ones form the next
  level's chunks, until each source has one left: a reduction tree of
  logarithmic depth whose tasks hold one chunk.
- The last open document of a source is rounded to the nearer side, which
  leaves at most half of its words as a gap. The gap is closed by documents no
  larger than it that change sides: MANY times a random set whose expected
  words are the gap, then ONE by one whichever fits best.

Everything is a DataFrame expression. Chunks and draws come from hashes of the
documents, so reruns and retried tasks agree; a source of any size is dealt
into as many chunks as it needs. Figures of a source meet its units by
broadcast up to SENT_SOURCES sources; beyond, adaptive execution splits the
join of a source that holds most of the units.

Targets: sources, by code point with null last, have the weights in turn and
share 100 % of all sizes; a target stops at ``cap`` times its source's size and
the excess is reshared by weight until none is above.

Cases: null and empty texts have size 0 and get copies at their fraction; rows
that agree in id, source and text form one unit and get the same number of
copies; null ids and sources are ordinary values; a source of size 0 has the
target 0; an empty table gives an empty result; columns of the input named
like an output column are replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadbook.llm.common import n_words, unit, written

WEIGHTS, CAP, CHUNK, MANY, ONE = (5, 2, 1), 3, 64, 3, 3
#: Sources whose few figures each are sent to every task instead of dealing all units by source.
SENT_SOURCES = 100_000


def targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, cap: float = CAP) -> DataFrame:
    """``sizes`` (source, source_size) with target: one row per source, so its windows are small.

    A source stops at its cap when cap / weight lies below the level that the
    others share. Sources are taken by that ratio; the level is what the mix
    has left, per weight left, at the first source that stays under its cap.
    """
    turn = (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights) + 1
    listed = sizes.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn.cast("int")))
    listed = listed.withColumn("most", F.col("source_size") * F.lit(float(cap)))
    order = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("most").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    share = F.sum("weight").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    listed = listed.withColumns({"level": left / share, "turn": F.row_number().over(order)})
    fits = F.when(F.col("level") * F.col("weight") <= F.col("most"), F.struct("turn", "level"))
    under = F.min(fits).over(everything)["level"]
    listed = listed.withColumn("level", under)
    target = F.least(F.coalesce(F.col("level") * F.col("weight"), F.col("most")), F.col("most"))
    return listed.select("source", "source_size", target.alias("target"))


def _fold(items: Column, seed: int, level: int) -> Column:
    """Pivotal rounding along an array of (id, size, due): struct(open, done).

    ``open`` is the document still open, ``done`` the rounded ones with due 0.0 or 1.0.
    """
    shape = "struct<open:struct<unit:bigint,size:bigint,due:double>,done:array<struct<unit:bigint,size:bigint,due:double>>>"
    start = F.struct(F.lit(None).cast("struct<unit:bigint,size:bigint,due:double>").alias("open"),
                     F.array().cast("array<struct<unit:bigint,size:bigint,due:double>>").alias("done")).cast(shape)

    def doc(x: Column, due: Column) -> Column:
        return F.struct(x["unit"].alias("unit"), x["size"].alias("size"), due.cast("double").alias("due"))

    def step(acc: Column, b: Column) -> Column:
        a = acc["open"]
        # words that can move from b to a, and from a to b
        up = F.least((1 - a["due"]) * a["size"], b["due"] * b["size"])
        down = F.least(a["due"] * a["size"], (1 - b["due"]) * b["size"])
        rises = unit(a["unit"], b["unit"], F.lit(seed), F.lit(level)) * (up + down) < down
        a_due = F.when(rises, F.when((1 - a["due"]) * a["size"] <= b["due"] * b["size"], 1.0).otherwise(a["due"] + up / a["size"])) \
            .otherwise(F.when(a["due"] * a["size"] <= (1 - b["due"]) * b["size"], 0.0).otherwise(a["due"] - down / a["size"]))
        b_due = F.when(rises, F.when(b["due"] * b["size"] <= (1 - a["due"]) * a["size"], 0.0).otherwise(b["due"] - up / b["size"])) \
            .otherwise(F.when((1 - b["due"]) * b["size"] <= a["due"] * a["size"], 1.0).otherwise(b["due"] + down / b["size"]))
        # the dues are needed more than once: held in a one-element array that transform() reads
        pair = F.array(F.struct(a_due.alias("a"), b_due.alias("b")))
        nobody = F.lit(None).cast("struct<unit:bigint,size:bigint,due:double>")
        after = F.transform(pair, lambda p: F.struct(
            F.when((p["a"] > 0) & (p["a"] < 1), doc(a, p["a"])).when((p["b"] > 0) & (p["b"] < 1), doc(b, p["b"])).otherwise(nobody).alias("open"),
            F.concat(acc["done"],
                     F.when((p["a"] <= 0) | (p["a"] >= 1), F.array(doc(a, p["a"]))).otherwise(F.array().cast("array<struct<unit:bigint,size:bigint,due:double>>")),
                     F.when((p["b"] <= 0) | (p["b"] >= 1), F.array(doc(b, p["b"]))).otherwise(F.array().cast("array<struct<unit:bigint,size:bigint,due:double>>"))).alias("done")).cast(shape))
        first = F.struct(doc(b, b["due"]).alias("open"), acc["done"].alias("done")).cast(shape)
        return F.when(a.isNull(), first).otherwise(after[0])

    return F.aggregate(items, start, step)


def copies(docs: DataFrame, weights: Sequence[float] = WEIGHTS, cap: float = CAP, seed: int = 0,
           doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """One row per unit: doc_id, source, content (hash of the text), rows, size, source_size, target, copies.

    ``rows`` rows of the input agree in the first three; each of them is taken ``copies`` times.
    """
    light = docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"),
                        F.xxhash64(F.col(text)).alias("content"), n_words(F.col(text)).alias("size"))
    units = light.groupBy("doc_id", "source", "content", "size").agg(F.count("*").alias("rows"))
    units = units.withColumn("unit", F.xxhash64("doc_id", "source", "content", "size"))
    units = written(units, "mix-units")
    due = targets(units.groupBy("source").agg(F.sum(F.col("size") * F.col("rows")).alias("source_size")), weights, cap)
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    whole = F.least(F.floor(ratio + F.lit(1e-12)), F.lit(int(cap))).cast("long")
    due = due.withColumns({"whole": whole, "due": F.greatest(ratio - whole, F.lit(0.0))})
    due = written(due.withColumn("due", F.when(F.col("whole") >= cap, 0.0).otherwise(F.col("due"))), "mix-targets")
    # one row per source, found again by a hash because null is a source too
    own = due.withColumn("place", F.xxhash64("source")).withColumnRenamed("source", "of")
    few = due.count() <= SENT_SOURCES

    def of_source(figures: DataFrame) -> DataFrame:
        return F.broadcast(figures) if few else figures

    dealt = units.withColumn("place", F.xxhash64("source")).join(of_source(own), "place").where(F.col("source").eqNullSafe(F.col("of"))).drop("of")
    mass = F.col("size") * F.col("rows")
    dealt = written(dealt, "mix-due")
    opened = dealt.where((F.col("due") > 0) & (mass > 0)).select("place", "unit", mass.alias("size"), "due")

    rounded, level = [], 0
    while True:
        crowd = opened.groupBy("place").agg(F.count("*").alias("n"))
        chunks = opened.join(of_source(crowd), "place").withColumn("chunk", F.pmod(F.xxhash64("unit", F.lit(seed), F.lit(level)), F.ceil(F.col("n") / CHUNK)))
        folded = chunks.groupBy("place", "chunk").agg(F.array_sort(F.collect_list(F.struct("unit", "size", "due"))).alias("items"))
        folded = written(folded.select("place", _fold(F.col("items"), seed, level).alias("f")), "mix-level")
        rounded.append(folded.select("place", F.explode("f.done").alias("d")).select("place", "d.*"))
        opened = folded.where(F.col("f.open").isNotNull()).select("place", "f.open.*")
        level += 1
        if opened.groupBy("place").count().where("count > 1").isEmpty():
            break
    # the last open document of each source goes to the nearer side
    rounded.append(opened.select("place", "unit", "size", F.when(F.col("due") >= 0.5, 1.0).otherwise(0.0).alias("due")))
    fate = rounded[0]
    for r in rounded[1:]:
        fate = fate.unionByName(r)
    fate = written(fate.select("place", "unit", "size", F.col("due").cast("int").alias("extra")), "mix-fate")

    # documents may change sides where that brings the source nearer to its target: first a random
    # set whose expected words are the gap, then the one that fits best
    wanted = own.select("place", (F.col("target") - F.col("whole") * F.col("source_size")).alias("wanted"))
    for turn in range(MANY + ONE):
        got = fate.groupBy("place").agg(F.sum(F.col("size") * F.col("extra")).alias("got"))
        gap = got.join(wanted, "place").select("place", (F.col("wanted") - F.col("got")).alias("gap"))
        able = fate.join(of_source(gap), "place").where(((F.col("gap") > 0) & (F.col("extra") == 0)) | ((F.col("gap") < 0) & (F.col("extra") == 1)))
        other = 1 - F.col("extra")
        if turn < MANY:
            able = able.where(F.col("size") <= F.abs("gap"))
            share = able.groupBy("place").agg((F.abs(F.first("gap")) / F.sum("size")).alias("share"))
            turned = (F.col("size") <= F.abs("gap")) & (F.signum("gap") == F.signum(0.5 - F.col("extra"))) \
                & (unit(F.col("unit"), F.lit(seed), F.lit(turn), F.lit("close")) < F.col("share"))
            fate = fate.join(of_source(gap), "place").join(of_source(share), "place", "left").select(
                "place", "unit", "size", F.when(F.coalesce(turned, F.lit(False)), other).otherwise(F.col("extra")).alias("extra"))
        else:
            off = F.abs(F.abs("gap") - F.col("size"))
            change = able.where(off < F.abs("gap")).groupBy("place").agg(F.min_by("unit", F.struct(off, F.col("unit"))).alias("flip"))
            fate = fate.join(of_source(change), "place", "left").select(
                "place", "unit", "size", F.when(F.col("unit") == F.col("flip"), other).otherwise(F.col("extra")).alias("extra"))
        fate = written(fate, "mix-fate")
    settled = fate.drop("size")
    nothing = (F.col("size") == 0) & (unit(F.col("unit"), F.lit(seed)) < F.col("due"))
    out = dealt.join(settled, ["place", "unit"], "left")
    return out.select("doc_id", "source", "content", "rows", "size", "source_size", "target",
                      (F.col("whole") + F.coalesce(F.col("extra"), nothing.cast("int"))).cast("int").alias("copies"))


def mix(docs: DataFrame, weights: Sequence[float] = WEIGHTS, cap: float = CAP, seed: int = 0,
        doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """``docs`` with each row repeated as often as the mix takes it."""
    taken = copies(docs, weights, cap, seed, doc_id, text, source).where("copies > 0").select(
        F.col("doc_id").alias("__doc"), F.col("source").alias("__source"), F.col("content").alias("__content"), F.col("copies").alias("__copies"))
    keyed = docs.withColumn("__key", F.xxhash64(F.col(doc_id), F.col(source), F.xxhash64(F.col(text))))
    taken = taken.withColumn("__key", F.xxhash64("__doc", "__source", "__content")).select("__key", "__copies").dropDuplicates(["__key"])
    return keyed.join(taken, "__key").withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies")))).select(*[F.col(f"`{c}`") for c in docs.columns])
