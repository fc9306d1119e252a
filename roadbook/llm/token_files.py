"""Token-ID files compressed by a static range asymmetric numeral system (operator 5).

A folder holds ``table`` (id, freq: one frequency table for all blocks, its
frequencies summing to 2^SCALE) and ``blocks``. A block is one row with

    part, block     place: parts follow doc_id, blocks count from 0 in a part
    first, n_tokens ids of the part before the block, ids in it
    doc_ids, doc_ords, doc_pos, doc_lens
                    the documents in it: id, ordinal in the part, ids of the
                    document before this block, ids of it in this block
    payload         the ids, coded

and a payload is, little-endian,

    magic 'rNS1', n_tokens, lanes, steps between checkpoints, checkpoints,
    words, crc32 of the ids, crc32 of all that follows     (u32 each)
    lane states at the first step                           (u64 x lanes)
    per checkpoint: place in the words (u64), lane states   (u64 x lanes)
    words                                                   (u32)

Token i is coded in lane i mod lanes at step i div lanes; all lanes of a step
are coded at once by numpy. Blocks are independent and a checkpoint lets a
reader start inside one. Blocks hold BLOCK ids, so memory is bounded however
long a document is; a document may run over several blocks. Parquet is the
container, so Spark's own commit protocol protects a write from lost tasks and
any file system that Spark can write to will do.

Cases: null and empty texts hold only the end id; null doc_ids sort first;
rows that share a doc_id follow one another, ordered by a hash of their ids; an empty
table gives no block; further columns of the input are ignored.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from roadbook.llm.common import written
from roadbook.llm.tokens import encoder

SCALE, BLOCK, LANES, CHECK = 20, 1 << 17, 1024, 64
_LOW, _ONE = np.uint64(1 << 31), np.uint64(1)
_HEAD = struct.Struct("<4s7I")
MAGIC = b"rNS1"

BLOCKS = ("part int, block int, first long, n_tokens int, doc_ids array<bigint>, doc_ords array<bigint>, "
          "doc_pos array<bigint>, doc_lens array<bigint>, payload binary")
FRAGMENTS = "part int, ord long, doc_id long, at long, pos long, n long, crc long, whole boolean"


# ---- frequencies -----------------------------------------------------------

def quantised(counts: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """Frequencies summing to 2^scale, at least 1 for each id that occurs."""
    total = int(counts.sum())
    if not total:
        return np.zeros(len(counts), np.uint32)
    seen = counts > 0
    if int(seen.sum()) > 1 << scale:
        raise ValueError("more distinct ids than the table's scale holds")
    freq = np.where(seen, np.maximum(1, (counts.astype(np.float64) * (1 << scale) / total).astype(np.int64)), 0)
    over = int(freq.sum()) - (1 << scale)
    for i in np.argsort(-freq, kind="stable"):   # the most frequent ids absorb the rounding
        if over <= 0:
            freq[i] -= over
            break
        cut = min(over, int(freq[i]) - 1)
        freq[i] -= cut
        over -= cut
        if not over:
            break
    return freq.astype(np.uint32)


class Coder:
    """Codes and decodes blocks of ids with one frequency table."""

    def __init__(self, freq: np.ndarray, scale: int = SCALE):
        self.scale = np.uint64(scale)
        self.mask = np.uint64((1 << scale) - 1)
        self.freq = freq.astype(np.uint64)
        self.start = np.concatenate([[0], np.cumsum(freq.astype(np.uint64))[:-1]]).astype(np.uint64)
        self.limit = self.freq << np.uint64(63 - scale)
        kind = np.uint16 if len(freq) <= 1 << 16 else np.uint32
        self.slots = np.repeat(np.arange(len(freq), dtype=kind), freq.astype(np.int64))

    def encode(self, ids: np.ndarray, lanes: int = LANES, every: int = CHECK) -> bytes:
        n = len(ids)
        while lanes > 1 and lanes * 32 > n:
            lanes //= 2              # a short block has few lanes, so that their states stay small beside it
        steps = -(-n // lanes)
        limits, freqs, starts = self.limit[ids], self.freq[ids], self.start[ids]
        state = np.full(lanes, _LOW, np.uint64)
        words: list[np.ndarray] = []
        marks: list[tuple[int, np.ndarray]] = []
        done = 0
        for step in range(steps - 1, -1, -1):
            at = slice(step * lanes, min(n, (step + 1) * lanes))
            f = freqs[at]
            x = state[:len(f)]
            full = np.flatnonzero(x >= limits[at])
            out = x[full].astype(np.uint32)
            x[full] >>= np.uint64(32)
            q = x // f
            # x // f * 2^scale + x % f + start
            x += q * ((_ONE << self.scale) - f) + starts[at]
            words.append(out)
            done += len(out)
            if step and step % every == 0:
                marks.append((done, state.copy()))
        body = state.astype("<u8").tobytes()
        for emitted, states in reversed(marks):
            body += struct.pack("<Q", done - emitted) + states.astype("<u8").tobytes()
        body += b"".join(w.astype("<u4").tobytes() for w in reversed(words))
        return _HEAD.pack(MAGIC, n, lanes, every, len(marks), done, zlib.crc32(ids.astype("<u4").tobytes()),
                          zlib.crc32(body)) + body

    def decode(self, payload: bytes, checkpoint: int = 0, stop: int | None = None) -> np.ndarray:
        """Ids from a checkpoint (0: the block's start) up to checkpoint ``stop`` (None: its end)."""
        magic, n, lanes, every, marks, n_words, crc_ids, crc_body = _HEAD.unpack_from(payload)
        if magic != MAGIC or zlib.crc32(payload[_HEAD.size:]) != crc_body:
            raise ValueError("damaged block: the payload's checksum differs")
        at, size = _HEAD.size, 8 * lanes
        place = 0
        if checkpoint:
            at += size + (checkpoint - 1) * (size + 8)
            place = struct.unpack_from("<Q", payload, at)[0]
            at += 8
        state = np.frombuffer(payload, "<u8", lanes, at).astype(np.uint64)
        words = np.frombuffer(payload, "<u4", n_words, _HEAD.size + size + marks * (size + 8)).astype(np.uint64)
        first = checkpoint * every
        last = -(-n // lanes) if stop is None else min(stop * every, -(-n // lanes))
        out = np.empty(max(0, min(n, last * lanes) - first * lanes), np.uint32)
        for step in range(first, last):
            k = min(lanes, n - step * lanes)
            x = state[:k]
            slot = x & self.mask
            got = self.slots[slot]
            x = self.freq[got] * (x >> self.scale) + slot - self.start[got]
            low = np.flatnonzero(x < _LOW)
            x[low] = (x[low] << np.uint64(32)) | words[place:place + len(low)]
            place += len(low)
            state[:k] = x
            out[(step - first) * lanes:(step - first) * lanes + k] = got
        if not checkpoint and stop is None and zlib.crc32(out.astype("<u4").tobytes()) != crc_ids:
            raise ValueError("damaged block: the ids' checksum differs")
        return out

    def some(self, payload: bytes, at: int, n: int) -> np.ndarray:
        """``n`` ids from place ``at``, decoded from the checkpoint before them to the one after."""
        _, _, lanes, every, *_ = _HEAD.unpack_from(payload)
        run = lanes * every          # ids from one checkpoint to the next
        if not n:
            return np.empty(0, np.uint32)
        return self.decode(payload, at // run, -(-(at + n) // run))[at - at // run * run:][:n]


# ---- writing ---------------------------------------------------------------

def _tokenize(path: str, end_id: int | None, kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(path)
        end = b"" if end_id is None else struct.pack("<I", end_id)

        def ids(text: str | None) -> bytes:
            return np.frombuffer(e.encode(text) + end, "<u4").astype(kind).tobytes()

        for b in batches:
            # in slices, so that the ids of few documents are held at once
            for at in range(0, len(b), 256):
                s = b.slice(at, 256)
                yield pa.RecordBatch.from_arrays(
                    [s.column("doc_id"), pa.array([ids(t.as_py()) for t in s.column("text")], pa.binary())],
                    ["doc_id", "ids"])
    return run


def width(vocabulary: int) -> str:
    """numpy's name of the narrowest little-endian type that holds the ids of a vocabulary."""
    return "<u2" if vocabulary <= 1 << 16 else "<u4"


def tokenized(docs: DataFrame, tokenizer: str, vocabulary: int, end_id: int | None = 2, doc_id: str = "doc_id",
              text: str = "text") -> DataFrame:
    """(doc_id, ids): ids of each whole text, with ``end_id`` after it, as bytes of ``width(vocabulary)``; written once."""
    light = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return written(light.mapInArrow(_tokenize(tokenizer, end_id, width(vocabulary)), "doc_id long, ids binary"), "token-ids")


def _frequencies(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(size, np.int64)
        for b in batches:
            # the values of a batch's binary column lie one after the other
            column = b.column("ids")
            offsets = np.frombuffer(column.buffers()[1], "<i4", len(column) + 1, 4 * column.offset)
            ids = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0]:offsets[-1]] if len(column) else np.empty(0, np.uint8)
            ids = ids.view(width(size))
            for at in range(0, len(ids), 1 << 20):
                counts += np.bincount(ids[at:at + (1 << 20)], minlength=size)
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(counts[seen], pa.int64())], ["id", "n"])
    return run


def frequencies(tokens: DataFrame, size: int) -> np.ndarray:
    """How often each id occurs; the result has ``size`` (the vocabulary's) entries."""
    found = tokens.select("ids").mapInArrow(_frequencies(size), "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    counts = np.zeros(size, np.int64)
    for row in found.collect():   # at most one row per id of the vocabulary
        counts[row["id"]] = row["n"]
    return counts


def _encode(freq: np.ndarray, kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, part = Coder(freq), TaskContext.get().partitionId()
        docs: list[tuple] = []
        held: list[np.ndarray] = []
        have = block = first = ordinal = 0

        def out() -> pa.RecordBatch:
            ids = np.concatenate(held)
            row = {"part": part, "block": block, "first": first, "n_tokens": have, "doc_ids": [d[0] for d in docs],
                   "doc_ords": [d[1] for d in docs], "doc_pos": [d[2] for d in docs], "doc_lens": [d[3] for d in docs],
                   "payload": coder.encode(ids)}
            return pa.RecordBatch.from_pylist([row], pa.schema([
                ("part", pa.int32()), ("block", pa.int32()), ("first", pa.int64()), ("n_tokens", pa.int32()),
                *[(k, pa.list_(pa.int64())) for k in ("doc_ids", "doc_ords", "doc_pos", "doc_lens")], ("payload", pa.binary())]))

        for b in batches:
            for doc, buf in zip(b.column("doc_id").to_pylist(), b.column("ids"), strict=True):
                ids, at = np.frombuffer(buf.as_buffer(), kind), 0
                while True:
                    take = min(BLOCK - have, len(ids) - at)
                    docs.append((doc, ordinal, at, take))
                    held.append(ids[at:at + take])
                    have, at = have + take, at + take
                    if have == BLOCK:
                        yield out()
                        block, first, have, docs, held = block + 1, first + have, 0, [], []
                    if at >= len(ids):
                        break
                ordinal += 1
        if docs:
            yield out()
    return run


def write_token_files(tokens: DataFrame, folder: str, vocabulary: int) -> None:
    """Write (doc_id, ids), as ``tokenized`` gives them, to ``folder`` in ascending doc_id order."""
    spark = tokens.sparkSession
    freq = quantised(frequencies(tokens, vocabulary))
    seen = np.flatnonzero(freq)
    spark.createDataFrame([(int(i), int(freq[i])) for i in seen], "id long, freq long").coalesce(1).write.parquet(f"{folder}/table")
    # a doc_id that many rows share (null, say) is spread over ranges of the second key
    ordered = tokens.withColumn("tie", F.xxhash64("ids")).repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    ordered.drop("tie").mapInArrow(_encode(freq, width(vocabulary)), BLOCKS).write.option("compression", "none").parquet(f"{folder}/blocks")


# ---- reading ---------------------------------------------------------------

def read_table(spark: SparkSession, folder: str) -> np.ndarray:
    rows = spark.read.parquet(f"{folder}/table").collect()   # one row per id of the vocabulary at most
    freq = np.zeros(max((r["id"] for r in rows), default=-1) + 1, np.uint32)
    for r in rows:
        freq[r["id"]] = r["freq"]
    return freq


def _placed(spark: SparkSession, folder: str) -> DataFrame:
    """The blocks with ``base``: the ids of all parts before theirs."""
    blocks = spark.read.schema(BLOCKS).parquet(f"{folder}/blocks")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)   # one row per written file
    parts = blocks.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    parts = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    return blocks.join(F.broadcast(parts), "part")


def _decode(freq: np.ndarray, keep_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(freq)
        for b in batches:
            for row in b.to_pylist():
                ids = coder.decode(row["payload"]).astype("<u4")
                last, at, rows = len(row["doc_ids"]) - 1, 0, []
                for k, (doc, ordinal, pos, n) in enumerate(zip(row["doc_ids"], row["doc_ords"], row["doc_pos"], row["doc_lens"], strict=True)):
                    mine = ids[at:at + n].tobytes()
                    # only a block's last document can run on into the next block
                    rows.append({"part": row["part"], "ord": ordinal, "doc_id": doc, "at": row["base"] + row["first"] + at,
                                 "pos": pos, "n": n, "crc": zlib.crc32(mine), "whole": pos == 0 and (k < last or row["n_tokens"] < BLOCK),
                                 **({"ids": mine} if keep_ids else {})})
                    at += n
                yield pa.RecordBatch.from_pylist(rows, pa.schema([
                    ("part", pa.int32()), ("ord", pa.int64()), ("doc_id", pa.int64()), ("at", pa.int64()), ("pos", pa.int64()),
                    ("n", pa.int64()), ("crc", pa.int64()), ("whole", pa.bool_()), *([("ids", pa.binary())] if keep_ids else [])]))
    return run


def read_fragments(spark: SparkSession, folder: str, keep_ids: bool = True) -> DataFrame:
    """What each block holds of each document: place (at, in the whole stream; pos, in the document), n, crc, ids."""
    schema = FRAGMENTS + (", ids binary" if keep_ids else "")
    return _placed(spark, folder).mapInArrow(_decode(read_table(spark, folder), keep_ids), schema)


def _decode_some(freq: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(freq)
        for b in batches:
            for row in b.to_pylist():
                rows = [{"part": row["part"], "ord": p["ord"], "doc_id": p["doc_id"], "at": row["base"] + row["first"] + p["at"],
                         "pos": p["pos"], "ids": coder.some(row["payload"], p["at"], p["n"]).astype("<u4").tobytes()} for p in row["pieces"]]
                yield pa.RecordBatch.from_pylist(rows, pa.schema([
                    *[(c, pa.int32() if c == "part" else pa.int64()) for c in ("part", "ord", "doc_id", "at", "pos")], ("ids", pa.binary())]))
    return run


def read_documents(spark: SparkSession, folder: str, wanted: DataFrame) -> DataFrame:
    """(doc_id, start, ids): the documents of the files whose doc_id is in ``wanted``, one row per document.

    Payloads of blocks that hold none of them aren't decoded, and of the others only
    from the checkpoint before a document to the one after it. A null doc_id is
    found by a null; rows that share an id are rows of the result.
    """
    blocks = _placed(spark, folder)
    inside = blocks.select("part", "block", F.arrays_zip("doc_ids", "doc_ords", "doc_pos", "doc_lens").alias("d"))
    # where each document begins in its block: lengths before it
    begins = F.expr("aggregate(d, array(0L), (s, x) -> array_append(s, element_at(s, -1) + x.doc_lens))")
    each = inside.select("part", "block", F.inline(F.arrays_zip("d", F.slice(begins, F.lit(1), F.size("d")).alias("begin"))))
    each = each.select("part", "block", F.col("d.doc_ids").alias("doc_id"), F.struct(
        F.col("d.doc_ids").alias("doc_id"), F.col("d.doc_ords").alias("ord"), F.col("d.doc_pos").alias("pos"),
        F.col("begin").alias("at"), F.col("d.doc_lens").alias("n")).alias("piece"))
    ids = wanted.select(F.col(wanted.columns[0]).cast("long").alias("_want")).distinct()
    found = each.join(ids, F.col("doc_id").eqNullSafe(F.col("_want")), "left_semi")
    found = found.groupBy("part", "block").agg(F.collect_list("piece").alias("pieces"))      # at most a block's documents
    pieces = blocks.join(found, ["part", "block"]).select("part", "block", "base", "first", "payload", "pieces")
    read = pieces.mapInArrow(_decode_some(read_table(spark, folder)), "part int, ord long, doc_id long, at long, pos long, ids binary")
    whole = read.groupBy("part", "ord").agg(F.first("doc_id").alias("doc_id"), F.min("at").alias("start"),
                                            F.array_sort(F.collect_list(F.struct("pos", "ids"))).alias("p"))
    joined = F.aggregate("p", F.lit(b""), lambda s, x: F.concat(s, x["ids"]))
    return whole.select("doc_id", "start", joined.alias("ids"))


def _times(a: int, b: int) -> int:
    """Product of two polynomials modulo that of crc32 (highest power in the lowest bit)."""
    out = 0
    for i in range(31, -1, -1):
        if a >> i & 1:
            out ^= b
        b = (b >> 1) ^ (0xEDB88320 if b & 1 else 0)
    return out


def joined_crc(parts: list[tuple[int, int]]) -> int:
    """crc32 of a byte string from (crc32, bytes) of its consecutive parts."""
    crc = 0
    for piece, n in parts:
        power, square = 1 << 31, 1 << 30   # x^0 and x^1
        k = 8 * n
        while k:
            if k & 1:
                power = _times(power, square)
            square = _times(square, square)
            k >>= 1
        crc = _times(crc, power) ^ piece
    return crc


def read_digests(spark: SparkSession, folder: str) -> DataFrame:
    """Per document of the files: doc_id, start, n_tokens, ids_crc32."""
    found = written(read_fragments(spark, folder, keep_ids=False), "token-fragments")
    whole = found.where("whole").select("doc_id", F.col("at").alias("start"), F.col("n").alias("n_tokens"), F.col("crc").alias("ids_crc32"))

    @F.pandas_udf("long")
    def crc(parts):
        return parts.map(lambda x: joined_crc([(p["crc"], 4 * p["n"]) for p in x]))

    # a document over several blocks: as many rows as blocks that it fills
    cut = found.where("not whole").groupBy("part", "ord").agg(
        F.first("doc_id").alias("doc_id"), F.min("at").alias("start"), F.sum("n").alias("n_tokens"),
        F.array_sort(F.collect_list(F.struct("pos", "n", "crc"))).alias("parts"))
    return whole.unionByName(cut.select("doc_id", "start", "n_tokens", crc("parts").alias("ids_crc32")))
