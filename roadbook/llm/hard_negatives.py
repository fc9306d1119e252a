"""Hard negatives by residue-number-system matrix products (operator 12).

Components are whole numbers, so an inner product is one too. Every block of
anchors is multiplied with every block of rows modulo a few small primes: the
components' residues, taken between -(p - 1) / 2 and (p - 1) / 2, are so small
that a float32 matrix product of SLICE dimensions is exact. The residues of a
score then give the score itself by Chinese remaindering; there are as many
primes as the largest component asks for.

Two passes, each over the cells that it needs: rows are dealt by a hash of
their label, so the first pass multiplies anchors with the rows of their own
bucket only and keeps the best of the same label (the positives); the second
pass multiplies all anchors with all rows and keeps, for each positive, the
best of the other labels between ``low`` / 100 of the positive's score and that score. A cell
holds at most BLOCK rows and ANCHORS anchors and returns a few rows per anchor;
window functions pick the best over all cells. A label that a third of the
rows carry is dealt over many blocks. Only counts per bucket of labels (BUCKETS
rows) and the largest component reach the driver.

Cases: rows with a null id, a null label, a null vector, or a null or
non-finite component take no part, nor do vectors of another length than the
most frequent one (the shorter, if equally frequent); zero vectors do take
part. Rows that agree in id, label and vector count once; other rows with one
id are rows each, but an anchor is never paired with its own id. Ties go to the
smaller id. Scores beyond 2 ** 48 raise an error. An empty table gives an empty
result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadbook.llm.common import written

BLOCK, ANCHORS, BUCKETS, SLICE = 32_768, 8_192, 256, 1_024
#: Components are whole multiples of 1 / SCALE.
SCALE = 256
#: Scores of one step of a cell: anchors x rows.
STEP = 4_000_000
#: No score: below all.
NONE = -(1 << 62)


def primes(dimensions: int, bound: int) -> list[int]:
    """Largest primes whose residues' products sum up exactly in float32, enough of them for scores up to ``bound``."""
    most = int(2 * np.sqrt((1 << 24) / max(1, min(dimensions, SLICE)))) - 1
    out, product = [], 1
    for p in range(most, 2, -1):
        if all(p % q for q in range(2, int(p ** 0.5) + 1)):
            out.append(p)
            product *= p
            if product > 2 * bound + 1:
                return out
    raise ValueError(f"scores up to {bound} need more primes than there are below {most}")


def residues(whole: np.ndarray, p: int) -> np.ndarray:
    """Residues of whole numbers (as doubles) nearest to 0, in float32."""
    r = np.fmod(whole, p)
    r -= p * (r > p // 2)
    r += p * (r < -(p // 2))
    return r.astype(np.float32)


def product(a: list[np.ndarray], b: list[np.ndarray], moduli: list[int]) -> np.ndarray:
    """Exact signed scores (rows of a x rows of b) from residues per prime, by mixed radix digits."""
    score, weight, digits = None, 1, []
    for n, p in enumerate(moduli):
        r = 0
        for at in range(0, a[n].shape[1], SLICE):
            r = r + (a[n][:, at:at + SLICE] @ b[n][:, at:at + SLICE].T).astype(np.int64)
        if not n:
            digit = np.mod(r, p)
            score = digit
        else:
            # what the digits so far make of the score, taken from its residue and divided by their weight
            so_far, w = 0, 1
            for d, q in zip(digits, moduli, strict=False):
                so_far = so_far + d * (w % p)
                w *= q
            digit = np.mod((r - so_far) * pow(weight, -1, p), p)
            score = score + digit * weight
        digits.append(digit)
        weight *= p
    return np.where(score > weight // 2, score - weight, score)


def _best(scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k largest of a row of scores, largest first, ties by place."""
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        over = np.flatnonzero(scores > least)
        found = np.concatenate([over, np.flatnonzero(scores == least)[:k - len(over)]])
    else:
        found = np.arange(len(scores))
    found = found[scores[found] > NONE]
    return found[np.lexsort((found, -scores[found]))]


def _matrix(column: pd.Series, scale: float) -> np.ndarray:
    return np.floor(scale * np.array([np.asarray(x, np.float64) for x in column]))


def _scored(anchors: pd.DataFrame, rows: pd.DataFrame, scale: float, moduli: list[int]) -> Iterator[tuple[pd.DataFrame, np.ndarray]]:
    """Anchors in steps, each with its scores against all rows."""
    x = _matrix(rows["vector"], scale)
    b = [residues(x, p) for p in moduli]
    step = max(1, STEP // len(rows))
    for at in range(0, len(anchors), step):
        some = anchors.iloc[at:at + step]
        y = _matrix(some["vector"], scale)
        yield some, product([residues(y, p) for p in moduli], b, moduli)


def _positives(k: int, scale: float, moduli: list[int]):
    def run(anchors: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(anchors) and len(rows):
            rows = rows.sort_values(["id", "row"])
            ids, labels, numbers = (rows[c].to_numpy() for c in ("id", "label", "row"))
            for some, scores in _scored(anchors, rows, scale, moduli):
                for a, i, label, s in zip(some["row"], some["id"], some["label"], scores, strict=True):
                    s = np.where((labels == label) & (ids != i), s, NONE)
                    out += [(a, ids[e], numbers[e], s[e]) for e in _best(s, k)]
        return pd.DataFrame(out, columns=["anchor", "positive_id", "positive", "score"]).astype("int64")
    return run


def _negatives(k: int, low: int, scale: float, moduli: list[int]):
    def run(anchors: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(anchors) and len(rows):
            rows = rows.sort_values(["id", "row"])
            ids, labels, numbers = (rows[c].to_numpy() for c in ("id", "label", "row"))
            for some, scores in _scored(anchors, rows, scale, moduli):
                for a, label, wanted, s in zip(some["row"], some["label"], some["wanted"], scores, strict=True):
                    wanted = np.asarray(wanted, np.int64)       # the positives' scores, best first
                    fits = (s <= wanted.max()) & (100 * s >= low * wanted.min()) & (labels != label)
                    at = np.flatnonzero(fits)
                    at = at[np.argsort(-s[at], kind="stable")]
                    down = -s[at]
                    for rank, score in enumerate(wanted, 1):
                        first = np.searchsorted(down, -score)
                        near = at[first:first + k]
                        out += [(a, rank, ids[e], numbers[e], s[e]) for e in near if 100 * s[e] >= low * score]
        return pd.DataFrame(out, columns=["anchor", "positive_rank", "negative_id", "negative", "score"]).astype("int64")
    return run


def mine(vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 5, low: int = 80, scale: float = SCALE,
         vec_id: str = "vec_id", label: str | Column = "label", vector: str = "embedding") -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of each anchor's best positives.

    A row's components are ``floor(scale * x)``. A negative has another label and a score between ``low`` / 100 of the
    positive's and the positive's; the best ``negatives`` of them are returned, ``rank`` from 1.
    """
    spark = vectors.sparkSession
    out_schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    wide = F.transform(vector, lambda x: x.cast("double"))
    bad = F.exists(wide, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    own = vectors.select(F.col(vec_id).cast("long").alias("id"), (F.col(label) if isinstance(label, str) else label).cast("long").alias("label"),
                         wide.alias("vector"), F.coalesce(is_anchor, F.lit(False)).alias("asks"), bad.alias("bad"))
    own = own.where("id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL AND NOT bad").drop("bad")
    sizes = own.groupBy(F.size("vector").alias("d")).agg(
        F.count("*").alias("n"), F.max(F.array_max(F.transform("vector", lambda x: F.abs(x)))).alias("most")).orderBy(F.desc("n"), "d").first()
    if sizes is None:
        return spark.createDataFrame([], out_schema)
    largest = int(np.floor(scale * (sizes["most"] or 0.0))) + 1
    bound = max(1, sizes["d"] * largest * largest)
    if bound >= 1 << 48:     # the product of the primes, below 2 * bound * 2 ** 13, fits in a long
        raise ValueError(f"components up to {largest} make scores beyond 2 ** 48")
    moduli = primes(sizes["d"], bound)

    own = own.where(F.size("vector") == sizes["d"]).dropDuplicates(["id", "label", "vector"])
    own = own.withColumn("bucket", F.pmod(F.xxhash64("label"), F.lit(BUCKETS))).withColumn("row", F.monotonically_increasing_id())
    own = written(own, "negatives-rows")
    found = own.groupBy("bucket").agg(F.count("*").alias("n"), F.count_if("asks").alias("a")).orderBy("bucket").collect()     # BUCKETS rows
    shares, blocks = [], 0
    for r in found:
        parts = -(-r["n"] // BLOCK)
        shares.append((r["bucket"], parts, -(-r["a"] // ANCHORS), blocks))
        blocks += parts
    asked = max(1, -(-sum(r["a"] for r in found) // ANCHORS))
    share = F.broadcast(spark.createDataFrame(shares, "bucket long, parts long, asking long, before long"))

    def upto(n: Column) -> Column:
        return F.sequence(F.lit(0).cast("long"), n - 1)

    rows = own.join(share, "bucket").withColumn("part", F.pmod(F.xxhash64("row"), F.col("parts")))
    # columns of their own: cogrouped sides of one table must not share them
    anchors = own.join(share, "bucket").where("asks").select(*[F.col(c).alias(c) for c in (*own.columns, "parts", "asking")])
    # first pass: a bucket's anchors with its rows
    first_rows = rows.where("asking > 0").select("bucket", "part", F.explode(upto(F.col("asking"))).alias("from"), "id", "label", "row", "vector")
    first_asks = anchors.select("bucket", F.explode(upto(F.col("parts"))).alias("part"),
                                F.pmod(F.xxhash64("row"), F.col("asking")).alias("from"), "id", "label", "row", "vector")
    key = ["bucket", "part", "from"]
    near = first_asks.groupBy(*key).cogroup(first_rows.groupBy(*key)).applyInPandas(
        _positives(positives, scale, moduli), "anchor long, positive_id long, positive long, score long")
    best = F.row_number().over(Window.partitionBy("anchor").orderBy(F.desc("score"), "positive_id", "positive"))
    near = written(near.withColumn("positive_rank", best).where(F.col("positive_rank") <= positives).drop("positive"), "negatives-positives")

    # second pass: all anchors, with their positives' scores, and all rows
    wanted = near.groupBy("anchor").agg(F.transform(F.array_sort(F.collect_list(F.struct("positive_rank", "score"))),
                                                    lambda x: x["score"]).alias("wanted"))
    asks = anchors.join(wanted, anchors["row"] == wanted["anchor"]).select("id", "label", "row", "vector", "wanted")
    asks = asks.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long")))).withColumn(
        "from", F.pmod(F.xxhash64("row"), F.lit(asked)))
    dealt = rows.select((F.col("before") + F.col("part")).alias("block"), "id", "label", "row", "vector").withColumn(
        "from", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(asked - 1).cast("long"))))
    key = ["block", "from"]
    far = asks.groupBy(*key).cogroup(dealt.groupBy(*key)).applyInPandas(
        _negatives(negatives, low, scale, moduli), "anchor long, positive_rank int, negative_id long, negative long, score long")
    rank = F.row_number().over(Window.partitionBy("anchor", "positive_rank").orderBy(F.desc("score"), "negative_id", "negative"))
    far = far.withColumn("rank", rank).where(F.col("rank") <= negatives)
    far = far.select("anchor", "positive_rank", "rank", "negative_id", F.col("score").alias("negative_score"))
    pairs = near.select("anchor", "positive_rank", "positive_id", F.col("score").alias("positive_score"))
    out = far.join(pairs, ["anchor", "positive_rank"]).join(own.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id")), "anchor")
    return out.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
