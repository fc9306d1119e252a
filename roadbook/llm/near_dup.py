"""Near-duplicate documents by ProbMinHash (operator 8).

A text is the weighted set of its shingles of five words; a shingle that
occurs k times weighs 1 + ln k. Each shingle is a Poisson process whose rate is
its weight: its arrivals fall on random registers, and a register keeps the
shingle that arrived first. Two texts agree in a register with the probability
Jaccard similarity of their weights. Arrivals are drawn only up to the time by
which all registers are filled (early termination).

Links are defined by the plain shingle sets, so a text with repeated shingles
has a second signature in which each shingle weighs 1. Bands of ROWS registers
of both bring texts together; whole signatures are compared by the second. Where
no shingle repeats the two are one. Every link that is reported is verified by
the exact Jaccard similarity of the two shingle sets. Inside a bucket no list of
all pairs is made:

1. Exact copies stand for one text.
2. In each bucket the text with most bucket mates is the pivot. All others are
   verified against it, after a comparison of whole signatures.
3. A text that its pivot doesn't account for is compared with the other
   members of the bucket, in tiles of two blocks of about BLOCK members; a tile
   returns a forest of its links, not all of them.

Classes are the connected components of the links, found by large-star and
small-star steps whose edges are written after each round.

Cases: texts without a word (null, empty) are classes of their own; a text of
one to four words is one shingle; ties take the smallest id; rows with one
id give one row, with the smallest of their texts' classes; rows with a null id get no class and no row; an empty table gives an empty
result; further columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadbook.llm.common import written

SHINGLE, SIMILAR = 5, 0.8
#: 28 bands of 5 registers miss a pair of similarity 0.8 with probability 1.5e-5.
BANDS, ROWS = 28, 5
REGISTERS = BANDS * ROWS
#: Signatures of two texts of similarity 0.8 agree in fewer than this share of 140 registers with probability 1e-5.
AGREE = 0.65
#: Members of a bucket in one tile's block, on average.
BLOCK = 512
#: Entries of the worker's word hashes.
MEMO = 400_000


def mixed(x: np.ndarray) -> np.ndarray:
    """A well-spread 64-bit hash of 64-bit numbers (two rounds of shift and multiply)."""
    x = x ^ (x >> np.uint64(32))
    for _ in range(2):
        x *= np.uint64(0xD6E8FEB86659FD93)
        x ^= x >> np.uint64(32)
    return x


def odd(n: int) -> np.ndarray:
    """n fixed odd multipliers."""
    return mixed(np.arange(1, n + 1, dtype=np.uint64)) | np.uint64(1)


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= MEMO:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h


_WORDS = _Words()


def shingles(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """64-bit hashes of a text's shingles, in order; bytes.split() cuts at the six ASCII white-space characters."""
    words = text.encode().split() if text else []
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(_WORDS.__getitem__, words), np.uint64, len(words))
    size = min(size, len(h))
    n = len(h) - size + 1
    out = np.full(n, size, np.uint64)
    for k, by in enumerate(odd(size)):
        out += h[k:n + k] * by
    return mixed(out)


def signature(distinct: np.ndarray, counts: np.ndarray, registers: int = REGISTERS) -> np.ndarray:
    """The shingle that reaches each register first."""
    weight = 1.0 + np.log(counts)
    expected = registers * (math.log(registers) + 3)     # arrivals that fill all registers but once in twenty
    until = expected / weight.sum()
    while True:
        best = np.full(registers, np.inf)
        winner = np.empty(registers, np.uint64)
        shingle, w, at = distinct, weight, np.zeros(len(distinct))
        drawn = 0
        while len(shingle):
            # about as many arrivals at once as are expected before the end
            k = max(1, int(1.3 * (until - at.mean()) * w.sum() / len(shingle))) + 2 * (drawn > 0)
            r = mixed(shingle[:, None] + mixed(np.arange(drawn + 1, drawn + 1 + k, dtype=np.uint64)))
            drawn += k
            gap = np.log(((r >> np.uint64(22)) + np.uint64(1)).astype(np.float64) * (0.5 / (1 << 41)))
            time = at[:, None] - np.cumsum(gap, axis=1) / w[:, None]
            early = time <= until
            t = time[early]
            place = ((r[early] & np.uint64((1 << 22) - 1)) * np.uint64(registers) >> np.uint64(22)).astype(np.int64)
            whose = np.broadcast_to(shingle[:, None], time.shape)[early]
            np.minimum.at(best, place, t)
            first = t == best[place]
            winner[place[first]] = whose[first]
            going = early[:, -1]
            shingle, w, at = shingle[going], w[going], time[going, -1]
        if np.isfinite(best).all():
            return winner
        until *= 2


def band_keys(sig: np.ndarray) -> np.ndarray:
    return mixed((sig.reshape(BANDS, ROWS) * odd(ROWS)).sum(axis=1, dtype=np.uint64) + odd(BANDS))


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for at in range(0, len(b), 512):
            s = b.slice(at, 512)
            keys, sigs = [], []
            for t in s.column("text"):
                found = shingles(t.as_py())
                if not len(found):
                    keys.append(None)
                    sigs.append(None)
                    continue
                distinct, counts = np.unique(found, return_counts=True)
                sig = plain = signature(distinct, counts)
                if len(distinct) < len(found):
                    plain = signature(distinct, np.ones(len(distinct)))
                keys.append(np.union1d(band_keys(sig), band_keys(plain)).view(np.int64))
                sigs.append(mixed(plain).astype(np.uint32).tobytes())
            yield pa.RecordBatch.from_arrays(
                [s.column("doc"), s.column("same"), pa.array(keys, pa.list_(pa.int64())), pa.array(sigs, pa.binary())],
                ["doc", "same", "keys", "sig"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for at in range(0, len(b), 512):
            s = b.slice(at, 512)
            found = [np.unique(shingles(t.as_py())).tobytes() for t in s.column("text")]
            yield pa.RecordBatch.from_arrays([s.column("same"), pa.array(found, pa.binary())], ["same", "shingles"])


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def _tile(similar: float):
    def run(members: pd.DataFrame) -> pd.DataFrame:
        """Links of one tile that its pivot doesn't account for, as a forest."""
        members = members.drop_duplicates("same").reset_index(drop=True)
        n, met, block = len(members), members["met"].to_numpy(), members["block"].to_numpy()
        one_block = members["low"].iloc[0] == members["high"].iloc[0]
        sets = [np.frombuffer(x, np.uint64) for x in members["shingles"]]
        size = np.array([len(x) for x in sets])
        start = np.concatenate([[0], np.cumsum(size)[:-1]])
        known, which = np.unique(np.concatenate(sets), return_inverse=True)
        mark = np.zeros(len(known), np.int32)
        root = np.arange(n)
        if met.any():
            root[met] = np.flatnonzero(met)[0]     # they are joined through the pivot
        links = []
        for i in np.flatnonzero(~met):
            mine = which[start[i]:start[i] + size[i]]
            mark[mine] = 1
            both = np.add.reduceat(mark[which], start)
            mark[mine] = 0
            # a pair of two blocks belongs to the tile of both, a pair of one block to the block's own
            linked = (both >= similar * (size[i] + size - both)) & (root != root[i])
            linked &= one_block | (block != block[i])
            for k in np.flatnonzero(linked):
                if root[k] != root[i]:
                    links.append((members["same"].iat[i], members["same"].iat[k]))
                    root[root == root[k]] = root[i]
        return pd.DataFrame(links, columns=["a", "b"])
    return run


def components(edges: DataFrame) -> DataFrame:
    """(id, root) of every id in ``edges`` (a, b): root is the smallest id that it is connected with."""
    def mark(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    now = written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct(), "edges")
    seen = mark(now)
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        small = small.select("a", F.col("m").alias("b")).unionByName(small.where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b")))
        now = written(small.distinct(), "edges")
        if (new := mark(now)) == seen:
            break
        seen = new
    # now every id points at its root, and roots have no edge of their own
    return now.select(F.col("a").alias("id"), F.col("b").alias("root"))


def text_classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", similar: float = SIMILAR) -> DataFrame:
    """(doc, same, class_id, first) of every id and text: ``same`` is the text's digest, class_id the smallest id of its
    class and ``first`` the digest of that id's text (the smallest, if that id has several in the class)."""
    light = docs.select(F.col(doc_id).cast("long").alias("doc"), F.col(text).alias("text")).where("doc is not null")
    digest = F.unhex(F.md5(F.coalesce("text", F.lit(""))))
    signed = written(light.withColumn("same", digest).mapInArrow(_sign, "doc long, same binary, keys array<bigint>, sig binary"), "signatures")
    worded = signed.where("keys is not null")

    # equal texts stand for one, the text of their smallest id
    stands = written(worded.groupBy("same").agg(F.min("doc").alias("stand")), "stands")
    texts = signed.join(stands.withColumnRenamed("stand", "doc"), ["same", "doc"], "left_semi")

    banded = texts.select("same", F.explode("keys").alias("bucket")).distinct()
    held = banded.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    members = written(banded.join(held, "bucket"), "members")
    mates = members.groupBy("same").agg(F.sum("n").alias("mates"))
    pivots = members.join(mates, "same").groupBy("bucket").agg(F.max_by("same", F.struct("mates", "same")).alias("pivot"))
    own = written(members.join(pivots, "bucket"), "pivots")

    # whole plain signatures leave few pairs to verify
    sig = texts.select("same", "sig")
    pairs = own.where("pivot != same").select("pivot", "same").distinct()
    both = pairs.join(sig, "same").join(sig.select(F.col("same").alias("pivot"), F.col("sig").alias("pivot_sig")), "pivot")

    @F.pandas_udf("double")
    def agreement(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([float((np.frombuffer(x, np.uint32) == np.frombuffer(y, np.uint32)).mean()) for x, y in zip(a, b, strict=True)], dtype="float64")

    near = written(both.where(agreement("sig", "pivot_sig") >= AGREE).select("pivot", "same"), "near")

    # shingle sets of the texts that take part in a comparison
    asked = near.select("same").union(near.select("pivot")).union(own.where("n > 2").select("same")).distinct().join(stands, "same")
    found = light.join(asked, light["doc"] == asked["stand"]).where(digest == F.col("same"))
    sets = written(found.select("same", "text").mapInArrow(_sets, "same binary, shingles binary"), "shingle-sets")

    @F.pandas_udf("double")
    def exact(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([jaccard(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)) for x, y in zip(a, b, strict=True)], dtype="float64")

    compared = near.join(sets, "same").join(sets.select(F.col("same").alias("pivot"), F.col("shingles").alias("pivot_shingles")), "pivot")
    direct = written(compared.where(exact("shingles", "pivot_shingles") >= similar).select("pivot", "same"), "links")

    # members that their pivot doesn't account for, against the others of the bucket
    rest = own.where("n > 2").join(direct.withColumn("hit", F.lit(True)).distinct(), ["pivot", "same"], "left")
    rest = written(rest.select("bucket", "n", "same", (F.col("hit").isNotNull() | (F.col("pivot") == F.col("same"))).alias("met")), "rest")
    open_buckets = rest.where("not met").select("bucket").distinct()
    blocks = F.ceil(F.col("n") / F.lit(BLOCK))
    tiled = rest.join(open_buckets, "bucket").withColumn("block", F.pmod(F.xxhash64("same"), blocks))
    tiled = tiled.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
    tiled = tiled.withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")})
    tiled = tiled.select("bucket", "low", "high", "block", "same", "met").join(sets, "same")
    more = tiled.groupBy("bucket", "low", "high").applyInPandas(_tile(similar), "a binary, b binary")

    links = direct.select(F.col("pivot").alias("a"), F.col("same").alias("b")).unionByName(more)
    roots = components(links)
    roots = written(roots.unionByName(roots.select(F.col("root").alias("id"), "root")).distinct().join(stands, F.col("id") == F.col("same")), "roots")
    least = roots.groupBy("root").agg(F.min(F.struct("stand", "same")).alias("least"))
    joined = roots.join(least, "root").select("same", F.col("least.stand").alias("class_id"), F.col("least.same").alias("first"))
    known = worded.select("doc", "same").distinct().join(stands, "same").join(joined, "same", "left")
    known = known.select("doc", "same", F.coalesce("class_id", "stand").alias("class_id"), F.coalesce("first", "same").alias("first"))
    alone = signed.where("keys is null").select("doc", "same", F.col("doc").alias("class_id"), F.col("same").alias("first")).distinct()
    return known.unionByName(alone)


def classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", similar: float = SIMILAR) -> DataFrame:
    """(doc, class_id): the smallest id of the document's class; an id with several texts has the smallest of their classes."""
    return text_classes(docs, doc_id, text, similar).groupBy("doc").agg(F.min("class_id").alias("class_id"))


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", similar: float = SIMILAR) -> DataFrame:
    """``docs`` reduced to one row per class: the text of the class's smallest id.

    Rows that share an id are judged by their texts. Rows without an id are copies only of equal texts: one of them
    stays, unless a row with an id has the text.
    """
    own = docs.withColumn("__same", F.unhex(F.md5(F.coalesce(F.col(text), F.lit("")))))
    found = written(text_classes(docs, doc_id, text, similar), "text-classes")
    first = found.where("doc = class_id AND same = first").select(F.col("doc").alias("__doc"), F.col("same").alias("__same"))
    kept = own.join(first, (F.col(doc_id).cast("long") == F.col("__doc")) & (own["__same"] == first["__same"]), "left_semi")
    kept = kept.dropDuplicates([doc_id, "__same"])
    nameless = own.where(F.col(doc_id).isNull()).join(found.select(F.col("same").alias("__same")).distinct(), "__same", "left_anti")
    return kept.drop("__same").unionByName(nameless.dropDuplicates(["__same"]).drop("__same"))
