"""Approximate nearest neighbours by an inverted multi-index (operator 4).

The two halves of the vectors are quantised by two codebooks of K centroids
each, fitted on a bounded sample (MAX_FIT rows with the least hash of their
id). Every row is indexed under its pair of centroids, its cell. A query ranks
the cells by summed distance with a heap (the smallest sum of the two halves'
distances comes first, then its neighbours in both rankings) until the cells
that it has taken hold enough entries, and reranks those entries by their
inner product in double precision. Distance is the negative inner product of a
half with a centroid, so cells are ranked by what the search asks for.

How many entries are enough is measured, not guessed: for MAX_TRIED queries the
true neighbours are found against all entries, and ``enough`` is the number
that a query must look at to hold ``recall`` of them. Vectors with structure
need few; vectors without any need about half of all.

Entries and queries meet by the first half's centroid, each query with the
list of its cells there, in tasks of bounded size: entries are dealt into
blocks of BLOCK, queries into blocks of BLOCK, and each pair of blocks is a
task. Rows with equal vectors are one entry with its smallest ids, as many as
an answer can name, so a vector that a third of the rows share costs no more
than one.

Cases: vectors that are null, zero or hold null or non-finite components take
no part, neither as query nor as entry; vectors of another length than the
most frequent one take no part; rows with one id and several vectors count by
each vector; null ids take no part; ties go to the smaller id; an empty table
gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadbook.llm.common import least_hashed, written

MAX_FIT, MAX_TRIED, ROUNDS, BLOCK = 20_000, 200, 8, 4096
#: Share of the true neighbours that the tried queries must find; all queries then come near it.
RECALL = 0.94


def usable(vector: Column) -> Column:
    """Whether a vector takes part."""
    wide = F.transform(vector, lambda x: x.cast("double"))
    bad = F.exists(wide, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.exists(wide, lambda x: x != 0)


def fitted(sample: np.ndarray, k: int, seed: int) -> np.ndarray:
    """Centroids by Lloyd's rounds from a spread-out start."""
    rng = np.random.default_rng(seed)
    k = min(k, len(np.unique(sample, axis=0)))
    centres = [sample[rng.integers(len(sample))]]
    far = ((sample - centres[0]) ** 2).sum(axis=1)
    while len(centres) < k:
        at = rng.choice(len(sample), p=far / far.sum())
        centres.append(sample[at])
        far = np.minimum(far, ((sample - sample[at]) ** 2).sum(axis=1))
    c = np.array(centres)
    for _ in range(ROUNDS):
        near = nearest(sample, c)
        size = np.bincount(near, minlength=k)
        total = np.zeros_like(c)
        np.add.at(total, near, sample)
        c = np.where(size[:, None] > 0, total / np.maximum(size, 1)[:, None], c)
    return c


def nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.argmin((centres ** 2).sum(axis=1) - 2 * x @ centres.T, axis=1)


def traversal(first: np.ndarray, second: np.ndarray) -> Iterator[tuple[int, int]]:
    """Pairs (i, j) by first[i] + second[j], least first."""
    a, b = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
    heap, seen = [(first[a[0]] + second[b[0]], 0, 0)], {(0, 0)}
    while heap:
        _, i, j = heapq.heappop(heap)
        yield int(a[i]), int(b[j])
        for x, y in ((i + 1, j), (i, j + 1)):
            if x < len(a) and y < len(b) and (x, y) not in seen:
                seen.add((x, y))
                heapq.heappush(heap, (first[a[x]] + second[b[y]], x, y))


class Index:
    """Codebooks of both halves and the number of entries of each cell (K x K)."""

    def __init__(self, first: np.ndarray, second: np.ndarray):
        self.first, self.second = first, second
        self.half = first.shape[1]
        self.sizes = np.zeros((len(first), len(second)), np.int64)

    def cells(self, x: np.ndarray) -> np.ndarray:
        return nearest(x[:, :self.half], self.first) * len(self.second) + nearest(x[:, self.half:], self.second)

    def order(self, query: np.ndarray) -> Iterator[tuple[int, int]]:
        """Cells that hold entries, nearest first, each with the number of entries up to and with it."""
        have = 0
        for i, j in traversal(-self.first @ query[:self.half], -self.second @ query[self.half:]):
            if self.sizes[i, j]:
                have += int(self.sizes[i, j])
                yield i * len(self.second) + j, have

    def visited(self, query: np.ndarray, enough: int) -> np.ndarray:
        """K x K booleans: the cells that a query visits until they hold ``enough`` entries."""
        taken = np.zeros(self.sizes.size, bool)
        for cell, have in self.order(query):
            taken[cell] = True
            if have >= enough:
                break
        return taken.reshape(self.sizes.shape)


def _matrix(column) -> np.ndarray:
    """Rows of an Arrow or pandas list column as doubles."""
    if isinstance(column, pa.Array):
        flat = np.asarray(column.flatten(), np.float64)
        return flat.reshape(len(column), -1) if len(column) else np.empty((0, 1))
    return np.array([np.asarray(x, np.float64) for x in column])


def _celled(index: Index):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if len(b):
                cell = index.cells(_matrix(b.column("vector")))
                yield pa.RecordBatch.from_arrays(
                    [*b.columns, pa.array(cell // len(index.second), pa.int32()), pa.array(cell % len(index.second), pa.int32())],
                    [*b.schema.names, "first", "second"])
    return run


def _tried(queries: np.ndarray, ids: list[int], k: int, width: int):
    """The k best entries of a batch for each of a few queries, with their cells."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not len(b):
                continue
            score = queries @ _matrix(b.column("vector")).T
            cell = np.asarray(b.column("first")).astype(np.int64) * width + np.asarray(b.column("second"))
            alone = [x[0] if len(x) == 1 else None for x in b.column("ids").to_pylist()]
            rows = []
            for q, row in enumerate(score):
                for e in np.argsort(-row, kind="stable")[:k + 1]:
                    if alone[e] != ids[q]:
                        rows.append((q, float(row[e]), int(cell[e])))
            cols = list(zip(*rows, strict=True)) or [()] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int32(), pa.float64(), pa.int64()), strict=True)], ["q", "score", "cell"])
    return run


def enough_for(recall: float, index: Index, entries: DataFrame, queries: DataFrame, k: int) -> int:
    """Entries that a query must look at so that the tried queries hold ``recall`` of their true neighbours."""
    few = queries.orderBy(F.xxhash64("query_id"), "query_id").limit(MAX_TRIED).toPandas()
    if not len(few):
        return 1
    x = _matrix(few["vector"])
    found = entries.mapInArrow(_tried(x, few["query_id"].tolist(), k, len(index.second)), "q int, score double, cell long")
    best = found.groupBy("q").agg(F.slice(F.reverse(F.array_sort(F.collect_list(F.struct("score", "cell")))), 1, k).alias("best"))
    needed: list[int] = []
    for row in best.collect():      # MAX_TRIED rows of k cells
        upto = dict(index.order(x[row["q"]]))
        needed += [upto[b["cell"]] for b in row["best"]]
    return int(np.quantile(needed, recall, method="higher")) if needed else 1


def _routed(index: Index, enough: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = np.maximum(1, -(-index.sizes.sum(axis=1) // BLOCK))
        for b in batches:
            for at in range(0, len(b), 64):
                s = b.slice(at, 64)
                rows, firsts, parts, cells = [], [], [], []
                for k, q in enumerate(_matrix(s.column("vector"))):
                    taken = index.visited(q, enough)
                    for i in np.flatnonzero(taken.any(axis=1)):
                        for part in range(blocks[i]):
                            rows.append(k)
                            firsts.append(i)
                            parts.append(part)
                            cells.append(np.packbits(taken[i]).tobytes())
                t = s.take(pa.array(rows, pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [*t.columns, pa.array(firsts, pa.int32()), pa.array(parts, pa.int64()), pa.array(cells, pa.binary())],
                    [*t.schema.names, "first", "part", "cells"])
    return run


def _reranked(k: int):
    def run(queries: pd.DataFrame, entries: pd.DataFrame) -> pd.DataFrame:
        """The k best visited entries of one block for each query of one block."""
        out = []
        if len(queries) and len(entries):
            x, second, ids = _matrix(entries["vector"]), entries["second"].to_numpy(), entries["ids"].to_numpy()
            keep = min(k + 1, len(x))
            for at in range(0, len(queries), 256):
                part = queries.iloc[at:at + 256]
                taken = np.unpackbits(np.stack([np.frombuffer(c, np.uint8) for c in part["cells"]]), axis=1)
                score = np.where(taken[:, second] > 0, _matrix(part["vector"]) @ x.T, -np.inf)
                # the k + 1 best entries and what ties with the last hold the k best ids other than the query's own
                least = np.partition(score, len(x) - keep, axis=1)[:, len(x) - keep]
                for q, row, low in zip(part["query_id"], score, least, strict=True):
                    found = [(-row[e], i) for e in np.flatnonzero((row >= low) & (row > -np.inf)) for i in ids[e] if i != q]
                    out += [(q, i, -s) for s, i in heapq.nsmallest(k, found)]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"]).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})
    return run


def search(vectors: DataFrame, is_query: Column, k: int = 20, centroids: int = 32, recall: float = RECALL,
           vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k nearest rows by inner product, its own row left out."""
    spark = vectors.sparkSession
    own = vectors.select(F.col(vec_id).cast("long").alias("id"), F.col(vector).alias("vector"), is_query.alias("asks"))
    own = own.where(F.col("id").isNotNull() & usable(F.col("vector")))
    kind = dict(own.dtypes)["vector"]
    sizes = own.groupBy(F.size("vector").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "d").first()
    if sizes is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    own = own.where(F.size("vector") == sizes["d"])
    sample = least_hashed(own.select("vector", "id"), MAX_FIT, "id").select("vector").toPandas()
    x = _matrix(sample["vector"])
    half = max(1, x.shape[1] // 2)
    index = Index(fitted(x[:, :half], centroids, 1), fitted(x[:, half:], centroids, 2) if x.shape[1] > half else np.zeros((1, 0)))

    # equal vectors are one entry with its k + 1 smallest ids
    grouped = own.groupBy("vector").agg(F.min("id").alias("least"), F.count("*").alias("n"))
    single = grouped.where("n = 1").select("vector", F.array("least").alias("ids"))
    many = own.join(grouped.where("n > 1").select("vector"), "vector").select("vector", "id").distinct()
    order = Window.partitionBy("vector").orderBy("id")
    many = many.withColumn("at", F.row_number().over(order)).where(F.col("at") <= k + 1)
    entries = single.unionByName(many.groupBy("vector").agg(F.array_sort(F.collect_list("id")).alias("ids")))
    entries = written(entries.mapInArrow(_celled(index), f"vector {kind}, ids array<bigint>, first int, second int"), "index")
    for r in entries.groupBy("first", "second").agg(F.count("*").alias("n")).collect():    # one row per cell
        index.sizes[r["first"], r["second"]] = r["n"]
    queries = own.where("asks").select(F.col("id").alias("query_id"), "vector")
    # never fewer than k entries besides the query's own
    enough = max(k + 1, enough_for(recall, index, entries, queries, k))

    asked = -(-queries.count() // BLOCK)
    blocks = [(i, int(-(-n // BLOCK))) for i, n in enumerate(index.sizes.sum(axis=1)) if n]
    placed = entries.join(F.broadcast(spark.createDataFrame(blocks, "first int, parts long")), "first")    # K rows
    placed = placed.withColumn("part", F.pmod(F.xxhash64("vector"), F.col("parts"))).drop("parts")
    placed = placed.withColumn("asked", F.explode(F.sequence(F.lit(0), F.lit(max(0, asked - 1))).cast("array<bigint>")))
    routed = queries.mapInArrow(_routed(index, enough), f"query_id long, vector {kind}, first int, part long, cells binary")
    routed = routed.withColumn("asked", F.pmod(F.xxhash64("query_id"), F.lit(max(1, asked))))
    met = routed.groupBy("first", "part", "asked").cogroup(placed.groupBy("first", "part", "asked")).applyInPandas(
        _reranked(k), "query_id long, vec_id long, score double")
    # at most k rows of a query and block come together here; an id with several vectors counts by its best
    best = met.groupBy("query_id", "vec_id").agg(F.max("score").alias("score")).withColumn(
        "rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")))
    return best.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
