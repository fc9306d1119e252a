"""Packing documents into fixed-length sequences (operator 9).

Shortest-pack-first over the length histogram: documents are tokenized and cut
into pieces of at most ``size`` ids; the histogram of piece lengths (at most
``size`` rows, however many documents there are) is all that the driver sees.
It places the lengths longest first, each into the open packs that are
shortest, and updates counts of packing patterns instead of single packs. The
patterns are then joined back to the pieces by each piece's rank among those
of its length.

Ranks are taken in salted groups: a length that many pieces share is dealt
into buckets of about ``BUCKET`` pieces, each bucket is numbered by itself, and
the buckets' sizes are summed before it.

Cases: null and empty texts hold only the end id; repeated rows are packed
each for itself; null doc_ids are kept; an empty table gives an empty result;
further columns of the input are ignored.
"""

from __future__ import annotations

import heapq
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadbook.llm.common import written
from roadbook.llm.tokens import encoder

SIZE, BUCKET = 4096, 10_000

PIECES = "doc_id long, start long, length int, doc_tokens long, ids binary"


# ---- patterns --------------------------------------------------------------

def patterns(counts: dict[int, int], size: int = SIZE) -> list[tuple[int, list[tuple[int, int]]]]:
    """Shortest-pack-first: (number of packs, [(length, pieces of it in a pack), ...]) from {length: pieces}."""
    open_packs: dict[int, list[list]] = {}    # space left -> [packs, pattern]
    spaces: list[int] = []                    # heap of -space; may hold spaces that are used up
    full: list[list] = []

    def put(space: int, packs: int, pattern: tuple) -> None:
        if space == 0:
            full.append([packs, pattern])
            return
        if space not in open_packs:
            open_packs[space] = []
            heapq.heappush(spaces, -space)
        same = next((x for x in open_packs[space] if x[1] == pattern), None)
        if same:
            same[0] += packs
        else:
            open_packs[space].append([packs, pattern])

    def more(pattern: tuple, length: int, k: int) -> tuple:
        if pattern and pattern[-1][0] == length:
            return (*pattern[:-1], (length, pattern[-1][1] + k))
        return (*pattern, (length, k))

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            while spaces and not open_packs.get(-spaces[0]):
                open_packs.pop(-heapq.heappop(spaces), None)
            space = -spaces[0] if spaces else 0
            if space < length:
                k = size // length        # nothing open has room: fresh packs, filled with this length
                packs, rest = divmod(left, k)
                if packs:
                    put(size - k * length, packs, ((length, k),))
                if rest:
                    put(size - rest * length, 1, ((length, rest),))
                left = 0
                continue
            packs, pattern = open_packs[space].pop()
            used = min(packs, left)
            if used < packs:
                open_packs[space].append([packs - used, pattern])
            put(space - length, used, more(pattern, length, 1))
            left -= used
    return [(n, list(p)) for n, p in [*full, *(x for s in sorted(open_packs) for x in open_packs[s])]]


class Places:
    """Sequence and offset by (length, rank), from patterns; sequences are numbered from 0."""

    def __init__(self, found: list[tuple[int, list[tuple[int, int]]]]):
        rows, ranks, sequence = [], {}, 0
        for packs, pattern in found:
            offset = 0
            for length, k in pattern:
                low = ranks.get(length, 0)
                rows.append((length << 42 | low, packs, sequence, offset, length))
                ranks[length] = low + packs * k
                offset += length * k
            sequence += packs
        rows.sort()
        self.sequences = sequence
        self.low, self.packs, self.first, self.offset, self.length = np.array(rows, np.int64).reshape(-1, 5).T.copy()

    def of(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = (length.astype(np.int64) << 42) + rank
        at = np.searchsorted(self.low, key, side="right") - 1
        within = key - self.low[at]
        return self.first[at] + within % self.packs[at], self.offset[at] + self.length[at] * (within // self.packs[at])


# ---- pieces ----------------------------------------------------------------

def _cut(path: str, end_id: int | None, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(path)
        end = b"" if end_id is None else struct.pack("<I", end_id)
        for b in batches:
            for at in range(0, len(b), 256):
                s = b.slice(at, 256)
                rows: list[tuple] = []
                for doc, text in zip(s.column("doc_id").to_pylist(), s.column("text"), strict=True):
                    ids = e.encode(text.as_py()) + end
                    n = len(ids) // 4
                    rows += [(doc, k, min(size, n - k), n, ids[4 * k:4 * (k + size)]) for k in range(0, n, size)]
                cols = list(zip(*rows, strict=True)) or [()] * 5
                kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)],
                                                 ["doc_id", "start", "length", "doc_tokens", "ids"])
    return run


def pieces(docs: DataFrame, tokenizer: str, end_id: int | None = 2, size: int = SIZE,
           doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Ids (little-endian unsigned 32-bit) of each whole text and its end id, cut at multiples of ``size``; written once."""
    light = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    # the row number, written once, deals equal pieces apart
    return written(light.mapInArrow(_cut(tokenizer, end_id, size), PIECES).withColumn("row", F.monotonically_increasing_id()), "pieces")


def ranked(cut: DataFrame, counts: dict[int, int]) -> DataFrame:
    """``cut`` with rank: 0, 1, ... among the pieces of a length."""
    spark = cut.sparkSession
    if not counts:
        return cut.withColumn("rank", F.lit(0).cast("long"))
    dealt = spark.createDataFrame([(n, -(-c // BUCKET)) for n, c in counts.items()], "length int, buckets long")   # at most ``size`` rows
    own = cut.join(F.broadcast(dealt), "length").withColumn(
        "bucket", F.pmod(F.xxhash64("row"), F.col("buckets"))).drop("buckets")
    sizes = own.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    inside = Window.partitionBy("length", "bucket").orderBy("row")
    numbered = own.withColumn("within", F.row_number().over(inside) - 1)
    return numbered.join(sizes, ["length", "bucket"]).withColumn("rank", F.col("within") + F.col("before")).drop("bucket", "within", "before")


def histogram(cut: DataFrame) -> dict[int, int]:
    """{length: pieces}; at most one entry per length up to the sequence size."""
    return {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}


def pack(cut: DataFrame, size: int = SIZE, with_ids: bool = True) -> DataFrame:
    """Pieces with crc (crc32 of their ids), sequence_id and offset in it; ids too, if asked for."""
    light = cut.withColumn("crc", F.crc32("ids"))
    light = light if with_ids else light.drop("ids")
    counts = histogram(cut)
    found = Places(patterns(counts, size))

    @F.pandas_udf("sequence_id long, offset long")
    def place(length, rank):
        import pandas as pd

        sequence, offset = found.of(length.to_numpy(), rank.to_numpy())
        return pd.DataFrame({"sequence_id": sequence, "offset": offset})

    out = ranked(light, counts).withColumn("__place", place("length", "rank"))
    return out.select("*", "__place.sequence_id", "__place.offset").drop("__place", "rank", "row")
