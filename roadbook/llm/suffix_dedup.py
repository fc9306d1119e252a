"""Repeated passages of documents by suffix sorting (operator 13).

A byte goes if it is covered by a string of WIDTH bytes that also starts in a
document with a smaller id. Equal strings must meet to be compared, but not
every string has to travel:

1. Documents are packed into blocks of about BLOCK bytes. Each string of WIDTH
   bytes has a key, the least hash of the K-byte words in it, which depends on
   nothing but the string. Neighbouring strings mostly share their key, so
   about one key in 15 bytes is left. The distinct keys of a block are dealt
   over buckets as sorted 32-bit tags; each bucket tells every block which of
   its keys more than one document has.
2. Strings with such a key are sent, neighbours with one key as one snippet, to
   the key's bucket. There the suffixes of the distinct snippets are sorted in
   two stages: of the suffixes that are wanted (string starts, and what their
   order derives from) those smaller than their successors are sorted directly,
   by eight bytes at a time; a scan over the buckets of first bytes, in order,
   puts every other suffix right where its successor has its place. Common
   prefixes of neighbours then tell which strings are equal, and with the least
   document of each run of equal ones which snippets' strings are repeats.
3. The answers go back to the blocks, which cut the repeats out.

A false tag match costs work, never a result: bytes decide. A key with more
than HOT snippets (a line that a third of all documents share) isn't sorted in
one bucket; its strings are grouped as rows, combined before the shuffle.
Blocks and buckets are bounded by their size, but for a single text longer than
a block; hashes are taken by CHUNK bytes. Nothing but one byte total reaches
the driver.

Cases: a null text is empty; texts shorter than WIDTH lose nothing; documents
with one id aren't compared with each other; a document with a null id loses
nothing and takes nothing from others; equal rows give equal results; an empty
table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadbook.llm.common import written

WIDTH, K = 50, 20
#: Strings per snippet, at most: what a mask has bits for, and what one key can cover.
MOST = WIDTH - K + 1
BLOCK, BUCKET, CHUNK = 8_000_000, 8_000_000, 1 << 18
#: Texts are written once and shuffled twice, so they are worth more compression than the rest.
TEXT_LEVEL = 6
#: Snippets of a key that are sorted in one bucket.
HOT = 20_000


# ---- keys of strings ----

def words(buf: np.ndarray, kind: str) -> np.ndarray:
    """A view of the eight bytes from each place on as one number (``kind`` "<u8" or ">u8"); zeros follow the end."""
    padded = np.concatenate([buf, np.zeros(2 * WIDTH, np.uint8)])
    return np.ndarray(len(buf) + WIDTH, kind, padded, strides=(1,))


def _mixed(h: np.ndarray) -> np.ndarray:
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


def keyed(buf: np.ndarray, valid: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of neighbouring string starts with one key: first start, number of starts (MOST at most), key.

    ``valid`` says where a string may start.
    """
    firsts, counts, keys = [], [], []
    for low in range(0, len(buf), CHUNK):
        high = min(low + CHUNK, len(buf))
        ok = valid[low:high]
        if not ok.any():
            continue
        part = buf[low:min(high + WIDTH, len(buf))]
        w = words(part, "<u8")
        n = high - low + MOST - 1
        h = w[:n] * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
        h += w[8:n + 8]
        h *= np.uint64(0xC2B2AE3D27D4EB4F)
        h ^= h >> np.uint64(31)
        h += w[K - 8:n + K - 8]
        h = _mixed(h)
        # least of MOST neighbours, by doubling
        size = 1
        while size < MOST:
            step = min(size, MOST - size)
            h = np.minimum(h[:len(h) - step], h[step:])
            size += step
        change = np.empty(high - low, bool)
        change[0] = True
        np.not_equal(h[1:], h[:-1], out=change[1:])
        change[1:] |= ~ok[:-1]
        first = np.flatnonzero(change & ok)
        last = np.flatnonzero(ok & np.concatenate([(change | ~ok)[1:], [True]]))
        number, key = last - first + 1, h[first]
        if (number > MOST).any():       # a key that comes back within a string
            times = -(-number // MOST)
            at = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            first, key, number = np.repeat(first, times) + at * MOST, np.repeat(key, times), np.repeat(number, times)
            number = np.minimum(number - at * MOST, MOST)
        firsts.append(first + low)
        counts.append(number)
        keys.append(_mixed(key * np.uint64(0x9FB21C651E98DF25)))
    if not firsts:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64)
    return np.concatenate(firsts), np.concatenate(counts), np.concatenate(keys)


# ---- two-stage suffix sorting ----

def _sorted_directly(w: np.ndarray, places: np.ndarray, depth: int) -> np.ndarray:
    """``places`` by the ``depth`` bytes from them on; ``w`` has the big-endian words of all places."""
    places = places[np.argsort(w[places].astype(np.uint64))]
    tied = np.arange(len(places))
    group = np.zeros(len(places), np.int64)
    for at in range(0, depth, 8):
        if not len(tied):
            break
        word = w[np.minimum(places[tied] + at, len(w) - 1)].astype(np.uint64)
        if at:      # sort within the groups that the words so far leave equal
            rank = np.argsort(word)
            dense = np.empty(len(word), np.int64)
            dense[rank] = np.cumsum(np.concatenate([[0], word[rank][1:] != word[rank][:-1]]))
            order = np.argsort((group << 32) | dense)
            places[tied] = places[tied][order]
            word = word[order]
        new = np.concatenate([[True], (word[1:] != word[:-1]) | (group[1:] != group[:-1])])
        alone = new & np.concatenate([new[1:], [True]])
        group = np.cumsum(new)[~alone]
        tied = tied[~alone]
    return places


def two_stage(s: np.ndarray, wanted: np.ndarray, w: np.ndarray, depth: int = WIDTH) -> np.ndarray:
    """Places marked in ``wanted`` in the order of their suffixes of ``s`` (those equal in ``depth`` bytes in any order)."""
    n = len(s)
    # a suffix is smaller than its successor as the first change of byte from it on says
    change = np.flatnonzero(s[1:] != s[:-1])
    rises = np.zeros(n, bool)
    if len(change):
        runs = np.diff(np.concatenate([[-1], change]))
        rises[:change[-1] + 1] = np.repeat(s[change] < s[change + 1], runs)
    # the order of a suffix that isn't smaller derives from its successor's, so that is wanted too
    at = np.arange(n, dtype=np.int32)
    none = np.int32(-1)
    last_wanted = np.maximum.accumulate(np.where(wanted, at, none))
    last_rise = np.maximum.accumulate(np.where(rises, at, none))
    need = wanted.copy()
    need[1:] |= last_wanted[:-1] > last_rise[:-1]
    del at, last_wanted, last_rise
    falls = need & ~rises
    direct = _sorted_directly(w, np.flatnonzero(need & rises), depth)
    bound = np.searchsorted(s[direct], np.arange(257))
    induced: list[list[np.ndarray]] = [[] for _ in range(256)]
    out = []
    if need[-1] and not rises[-1]:      # the last suffix has no successor: the least of its byte's bucket
        induced[s[-1]].append(np.array([n - 1]))
    for c in range(256):
        todo = np.concatenate(induced[c]) if induced[c] else np.empty(0, np.int64)
        rest = direct[bound[c]:bound[c + 1]]
        while len(todo) or len(rest):
            turn, here = (todo, True) if len(todo) else (rest, False)
            out.append(turn)
            before = turn[turn > 0] - 1
            before = before[falls[before]]
            first = s[before]
            todo = before[first == c] if here else np.empty(0, np.int64)     # scanned in turn, before the direct ones
            rest = rest if here else np.empty(0, np.int64)
            before, first = before[first > c], first[first > c]
            order = np.argsort(first, kind="stable")
            before, first = before[order], first[order]
            cut = np.flatnonzero(first[1:] != first[:-1]) + 1
            for group in np.split(before, cut) if len(before) else ():
                induced[s[group[0]]].append(group)
    order = np.concatenate(out) if out else np.empty(0, np.int64)
    return order[wanted[order]]


def common_prefixes(w: np.ndarray, order: np.ndarray, most: int = WIDTH) -> np.ndarray:
    """Bytes that each suffix of ``order`` shares with the one before it, up to ``most``; 0 for the first."""
    out = np.zeros(len(order), np.int64)
    same = np.arange(1, len(order))
    for at in range(0, most, 8):
        a, b = order[same] + at, order[same - 1] + at
        inside = np.maximum(a, b) < len(w)
        same, a, b = same[inside], a[inside], b[inside]
        apart = (w[a] ^ w[b]).astype(np.uint64)
        out[same] += sum((apart < np.uint64(1) << np.uint64(8 * j)).astype(np.int64) for j in range(8))
        same = same[apart == 0]
    return np.minimum(out, most)


def repeats(snippets: list[bytes], docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each string of distinct snippets the least document that has it; the strings' offsets by snippet.

    ``docs`` has the least document of each snippet.
    """
    size = np.array([len(x) for x in snippets])
    number = size - WIDTH + 1
    # bytes of UTF-8 are below 255, so 0 ends a snippet and nothing else
    s = np.frombuffer(b"\xff".join(snippets) + b"\xff", np.uint8) + np.uint8(1)
    w = words(s, ">u8")
    begin = np.cumsum(size + 1) - size - 1
    offsets = np.concatenate([[0], np.cumsum(number)])
    snippet = np.repeat(np.arange(len(snippets)), number)
    start = begin[snippet] + np.arange(len(snippet)) - offsets[snippet]
    wanted = np.zeros(len(s), bool)
    wanted[start] = True
    order = two_stage(s, wanted, w)
    string = np.empty(len(s), np.int64)
    string[start] = np.arange(len(start))
    of = string[order]
    new = np.flatnonzero(common_prefixes(w, order) < WIDTH)
    least = np.minimum.reduceat(docs[snippet[of]], new)
    out = np.empty(len(start), np.int64)
    out[of] = np.repeat(least, np.diff(np.concatenate([new, [len(of)]])))
    return out, offsets


# ---- blocks ----

def _packed(raw: bytes, level: int = 1) -> bytes:
    """Compressed bytes behind their size."""
    return len(raw).to_bytes(8, "little") + (pa.Codec("zstd", compression_level=level).compress(raw, asbytes=True) if raw else b"")


def _unpacked(blob: bytes | None) -> bytes:
    size = int.from_bytes((blob or b"")[:8], "little")
    return pa.decompress(memoryview(blob)[8:], decompressed_size=size, codec="zstd", asbytes=True) if size else b""


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Rows one at a time: each may be large."""
    for b in batches:
        for at in range(len(b)):
            yield b.slice(at, 1).to_pylist()[0]


def _starts(ids: list, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where documents begin, and where in the block a string may start."""
    begin = np.cumsum(sizes) - sizes
    valid = np.ones(int(sizes.sum()), bool)
    for i, at, size in zip(ids, begin, sizes, strict=True):
        valid[at if i is None else at + max(0, size - WIDTH + 1):at + size] = False
    return begin, valid


class _Block:
    """A block's texts and the runs of strings in them."""

    def __init__(self, ids: list, sizes: np.ndarray, raw: bytes, buckets: int):
        self.ids, self.sizes, self.raw = ids, sizes, raw
        self.buf = np.frombuffer(raw, np.uint8)
        self.begin, valid = _starts(ids, sizes)
        self.first, self.number, key = keyed(self.buf, valid)
        self.doc = np.searchsorted(self.begin, self.first, side="right") - 1
        bucket = key % np.uint64(buckets)
        self.code, self.key = np.unique(bucket << np.uint64(32) | key >> np.uint64(32), return_inverse=True)

    def tags(self, buckets: int) -> list[bytes]:
        """Per bucket the distinct tags, ascending, and for each whether several documents have it, and how often (log 2)."""
        of = np.argsort(self.key, kind="stable")
        at = np.searchsorted(self.key[of], np.arange(len(self.code)))
        doc = np.array([i or 0 for i in self.ids], np.int64)[self.doc[of]]
        shared = (np.minimum.reduceat(doc, at) != np.maximum.reduceat(doc, at)) if len(at) else np.empty(0, bool)
        times = np.log2(np.bincount(self.key, minlength=len(self.code))).astype(np.uint8)
        flags = times | (shared.astype(np.uint8) << 7)
        tag = (self.code & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        cut = np.searchsorted(self.code, np.arange(buckets + 1).astype(np.uint64) << np.uint64(32))
        out = []
        for low, high in zip(cut, cut[1:], strict=False):
            steps = np.diff(tag[low:high], prepend=np.uint32(0))
            out.append(_packed(steps.tobytes() + flags[low:high].tobytes()))
        return out


def _blocks(size: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int | None, bytes]] = []
        have, made = 0, 0

        def block() -> pa.RecordBatch:
            nonlocal made
            held.sort(key=lambda x: (x[0] is None, x[0] or 0))
            ids, sizes = [x[0] for x in held], np.array([len(x[1]) for x in held], np.int64)
            raw = b"".join(x[1] for x in held)
            held.clear()
            number = TaskContext.get().partitionId() << 32 | made
            made += 1
            tags = _Block(ids, sizes, raw, buckets).tags(buckets)
            filled = [k for k, t in enumerate(tags) if len(t) > 8]
            return pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int64()), pa.array([ids], pa.list_(pa.int64())), pa.array([sizes], pa.list_(pa.int64())),
                 pa.array([_packed(raw, TEXT_LEVEL)], pa.binary()), pa.array([[{"bucket": k, "tags": tags[k]} for k in filled]], _TAGS)],
                ["block", "ids", "sizes", "text", "tags"])

        for b in batches:
            for i, text in zip(b.column("doc_id").to_pylist(), b.column("text"), strict=True):
                text = text.as_py() or b""
                if held and have + len(text) > size:
                    yield block()
                    have = 0
                held.append((i, text))
                have += len(text)
        if held:
            yield block()
    return run


_TAGS = pa.list_(pa.struct([("bucket", pa.int32()), ("tags", pa.binary())]))


def _untagged(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(_unpacked(blob), np.uint8)
    n = len(raw) // 5
    return np.cumsum(raw[:4 * n].view(np.uint32), dtype=np.uint32), raw[4 * n:]


def _shared(hot: int):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        """For each block's tags of one bucket: 0 if no other document has it, 1 if one has, 2 if it is a hot one."""
        parts = [_untagged(x) for x in group["tags"]]
        tag = np.concatenate([p[0] for p in parts])
        flags = np.concatenate([p[1] for p in parts])
        order = np.argsort(tag, kind="stable")
        at = np.flatnonzero(np.concatenate([[True], tag[order][1:] != tag[order][:-1]]))
        number = np.diff(np.concatenate([at, [len(tag)]]))
        several = (number > 1) | (np.maximum.reduceat(flags[order], at) >= 128)
        times = np.add.reduceat(np.int64(1) << (flags[order] & 127).astype(np.int64), at)
        code = np.empty(len(tag), np.uint8)
        code[order] = np.repeat(several.astype(np.uint8) + (several & (times > hot)), number)
        ends = np.cumsum([len(p[0]) for p in parts])
        return pd.DataFrame({"block": group["block"].to_numpy(), "bucket": group["bucket"].to_numpy(),
                             "codes": [_packed(code[e - len(p[0]):e].tobytes()) for e, p in zip(ends, parts, strict=True)]})
    return run


_SENT = pa.list_(pa.struct([("bucket", pa.int32()), ("snippets", pa.binary())]))
_HOT = pa.list_(pa.struct([("string", pa.binary()), ("doc", pa.int64()), ("at", pa.int64())]))
_SENT_SCHEMA = ("block long, sent array<struct<bucket: int, snippets: binary>>, hot array<struct<string: binary, doc: long, at: long>>, "
                "ledger binary")


def _sending(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """What blocks send to the buckets: snippets with their least document, and a ledger of the runs that they stand for."""
        for row in _rows(batches):
            block = _Block(row["ids"], np.array(row["sizes"], np.int64), _unpacked(row["text"]), buckets)
            codes = np.concatenate([np.frombuffer(_unpacked(c["codes"]), np.uint8) for c in sorted(row["codes"], key=lambda c: c["bucket"])]
                                   or [np.empty(0, np.uint8)])
            code = codes[block.key]
            raw, ids = block.raw, block.ids
            seen: dict[bytes, int] = {}
            sent: list[tuple[int, int, bytes]] = []      # bucket, document, snippet
            strings: dict[bytes, tuple[int, int]] = {}
            pick = np.flatnonzero(code)
            entry = np.empty(len(pick), np.int64)
            bucket = (block.code >> np.uint64(32)).astype(np.int64)[block.key[pick]]
            for n, (at, number, doc, k, c) in enumerate(zip(
                    block.first[pick].tolist(), block.number[pick].tolist(), block.doc[pick].tolist(), bucket.tolist(),
                    code[pick].tolist(), strict=True)):
                if c == 2:
                    for p in range(at, at + number):
                        strings.setdefault(raw[p:p + WIDTH], (ids[doc], len(strings)))
                    entry[n] = -1
                    continue
                text = raw[at:at + number + WIDTH - 1]
                e = seen.setdefault(text, len(sent))
                if e == len(sent):
                    sent.append((k, ids[doc], text))
                entry[n] = e
            by_bucket: dict[int, list[int]] = {}
            for e, (k, _, _) in enumerate(sent):
                by_bucket.setdefault(k, []).append(e)
            blobs = [{"bucket": k, "snippets": _packed(
                np.array([len(es), *(sent[e][1] for e in es)], np.int64).tobytes()
                + bytes(len(sent[e][2]) - WIDTH + 1 for e in es) + b"".join(sent[e][2] for e in es))} for k, es in sorted(by_bucket.items())]
            # the place of an entry among all entries by bucket, the order of the answers
            place = np.empty(len(sent), np.int64)
            place[[e for _, es in sorted(by_bucket.items()) for e in es]] = np.arange(len(sent))
            where = np.where(entry >= 0, place[entry] if len(sent) else entry, -1)
            ledger = np.concatenate([block.first[pick], block.number[pick], block.doc[pick], where]).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array([row["block"]], pa.int64()), pa.array([blobs], _SENT),
                 pa.array([[{"string": x, "doc": d, "at": n} for x, (d, n) in strings.items()]], _HOT),
                 pa.array([_packed(ledger.tobytes())], pa.binary())],
                ["block", "sent", "hot", "ledger"])
    return run


def _met(group: pd.DataFrame) -> pd.DataFrame:
    """One bucket: a mask per snippet that says which of its strings start in a document with a smaller id."""
    index: dict[bytes, int] = {}
    of, docs, ends = [], [], []
    for blob in group["snippets"]:
        raw = _unpacked(blob)
        n = int(np.frombuffer(raw, np.int64, 1)[0])
        doc = np.frombuffer(raw, np.int64, n, 8)
        at = 8 + 9 * n
        for number in raw[8 + 8 * n:at]:
            end = at + number + WIDTH - 1
            of.append(index.setdefault(raw[at:end], len(index)))
            at = end
        docs.append(doc)
        ends.append(len(of))
    of, doc = np.array(of), np.concatenate(docs)
    least = np.full(len(index), np.iinfo(np.int64).max)
    np.minimum.at(least, of, doc)
    first, offsets = repeats(list(index), least)
    number = np.diff(offsets)[of]
    low = np.cumsum(number) - number
    entry = np.repeat(np.arange(len(of)), number)
    bit = np.arange(len(entry)) - low[entry]
    again = first[offsets[of[entry]] + bit] < doc[entry]
    mask = np.add.reduceat(again.astype(np.uint32) << bit.astype(np.uint32), low).astype(np.uint32)
    return pd.DataFrame({"block": group["block"].to_numpy(), "bucket": group["bucket"].to_numpy(),
                         "masks": [mask[a:b].tobytes() for a, b in zip([0, *ends], ends, strict=False)]})


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of blocks without the repeats that the answers tell of."""
    for row in _rows(batches):
        ids, sizes = row["ids"], np.array(row["sizes"], np.int64)
        raw = _unpacked(row["text"])
        begin = np.cumsum(sizes) - sizes
        first, number, doc, where = np.frombuffer(_unpacked(row["ledger"]), np.int64).reshape(4, -1)
        masks = np.concatenate([np.frombuffer(m["masks"], np.uint32) for m in sorted(row["masks"] or [], key=lambda m: m["bucket"])]
                               or [np.empty(0, np.uint32)])
        of = np.array([0 if i is None else i for i in ids], np.int64)
        plain = where >= 0
        # the first run of an entry in a block has its least document; runs in later documents repeat it whole
        least = np.full(len(masks), np.iinfo(np.int64).max)
        np.minimum.at(least, where[plain], of[doc[plain]])
        at, run = first[plain], where[plain]
        later = of[doc[plain]] > least[run]
        bits = np.where(later, (np.int64(1) << number[plain]) - 1, masks[run].astype(np.int64))
        starts = [at[(bits >> j) & 1 == 1] + j for j in range(MOST)]
        hot = {h["at"]: h["least"] for h in row["answers"] or []}
        seen: dict[bytes, int] = {}
        for p, n, d in zip(first[~plain].tolist(), number[~plain].tolist(), doc[~plain].tolist(), strict=True):
            again = [q for q in range(p, p + n) if hot[seen.setdefault(raw[q:q + WIDTH], len(seen))] < ids[d]]
            starts.append(np.array(again, np.int64))
        start = np.concatenate(starts).astype(np.int64)
        step = np.zeros(len(raw) + 1, np.int8)       # at most WIDTH strings cover a byte
        step[start] += 1
        step[start + WIDTH] -= 1
        gone = np.cumsum(step[:-1], dtype=np.int8) > 0
        buf = np.frombuffer(raw, np.uint8)
        removed, spans, kept = [], [], []
        for i, n in zip(begin.tolist(), sizes.tolist(), strict=True):
            out = gone[i:i + n]
            removed.append(int(out.sum()))
            spans.append(int((out[1:] & ~out[:-1]).sum() + out[0]) if removed[-1] else 0)
            kept.append(hashlib.sha256(buf[i:i + n][~out] if removed[-1] else raw[i:i + n]).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(kept)],
            ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", block: int = BLOCK, bucket: int = BUCKET, hot: int = HOT) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of each document once repeated strings are cut out."""
    own = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text"))
    total = own.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, -(-total // bucket))
    blocks = own.mapInArrow(_blocks(block, buckets), "block long, ids array<long>, sizes array<long>, text binary, "
                            "tags array<struct<bucket: int, tags: binary>>")
    blocks = written(blocks, "passages-blocks")
    tags = blocks.select("block", F.inline("tags"))
    codes = tags.groupBy("bucket").applyInPandas(_shared(hot), "block long, bucket int, codes binary")
    codes = codes.groupBy("block").agg(F.collect_list(F.struct("bucket", "codes")).alias("codes"))
    sent = blocks.drop("tags").join(codes, "block").mapInArrow(_sending(buckets), _SENT_SCHEMA)
    sent = written(sent, "passages-sent")
    met = sent.select("block", F.inline("sent")).groupBy("bucket").applyInPandas(_met, "block long, bucket int, masks binary")
    met = met.groupBy("block").agg(F.collect_list(F.struct("bucket", "masks")).alias("masks"))
    strings = sent.select("block", F.inline("hot"))
    least = strings.groupBy("string").agg(F.min("doc").alias("least"))
    answers = strings.join(least, "string").groupBy("block").agg(F.collect_list(F.struct("at", "least")).alias("answers"))
    whole = blocks.drop("tags").join(sent.select("block", "ledger"), "block", "left").join(met, "block", "left").join(answers, "block", "left")
    return whole.mapInArrow(_cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
