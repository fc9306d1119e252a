"""Repeated passages against a dictionary of all strings."""

import hashlib
import random

import numpy as np
import pytest

from roadbook.llm import queries, suffix_dedup
from roadbook.llm.common import importable

WIDTH = suffix_dedup.WIDTH


def brute(rows):
    least = {}
    for d, text in rows:
        raw = (text or "").encode()
        for at in range(len(raw) - WIDTH + 1):
            if d is not None:
                s = raw[at:at + WIDTH]
                least[s] = min(least.get(s, d), d)
    out = []
    for d, text in rows:
        raw = (text or "").encode()
        gone = [False] * len(raw)
        for at in range(len(raw) - WIDTH + 1):
            if d is not None and least[raw[at:at + WIDTH]] < d:
                gone[at:at + WIDTH] = [True] * WIDTH
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        kept = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        out.append((d, len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def frame(spark, rows):
    importable(spark)
    return spark.createDataFrame([(*r, "x", 1, b"y") for r in rows], "doc_id long, text string, block string, bucket int, ids binary")


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def corpus(seed=1, n=120):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdefgé ß") for _ in range(rng.randint(1, 9))) for _ in range(60)]

    def prose(words):
        return " ".join(rng.choice(vocabulary) for _ in range(words))
    passage, line = prose(40), prose(14)
    rows = []
    for d in range(n):
        text = prose(rng.randint(0, 120))
        if d % 3 == 0:
            text += "\n" + line + "\n" + prose(5)
        if d % 7 == 0:
            cut = rng.randint(0, len(passage) // 2)
            text = prose(10) + passage[cut:cut + rng.randint(45, 200)] + text
        rows.append((d * 3 % 101 + d // 101 * 200, text))
    rows += [(1000 + k, rows[k][1]) for k in range(10)]                                # copies
    rows += [(1100 + k, rows[k][1][:200] + "x" + rows[k][1][200:]) for k in range(10)]      # near copies
    rows += [(2000, None), (2001, ""), (2002, "a" * 49), (2003, "a" * 50), (2004, "a" * 2000), (2005, "b" + "a" * 500 + "b"), (2006, "ab" * 300),
             (2007, "ba" * 100 + "é" * 60), (2008, "\0" * 120), (2009, "x" + "\0" * 60), (2010, passage), (2010, passage), (2010, passage[5:] + line),
             (None, passage), (None, line * 3), (-5, passage[10:90]), (2011, "\n".join([line] * 40)), (2012, "￿\U0010ffff" * 30), (2013, "\U0010ffff" * 30)]
    return rows


@pytest.mark.parametrize("options", [{}, {"block": 3000, "bucket": 4000}, {"block": 3000, "bucket": 4000, "hot": 5}, {"block": 10 ** 9, "hot": 0}])
def test_equals_brute_force(spark, options):
    rows = corpus()
    df = frame(spark, rows).repartition(5)
    assert got(suffix_dedup.dedup(df, **options)) == brute(rows)


def test_chunks(spark, monkeypatch):
    rows = corpus(seed=5, n=40)
    raw = np.frombuffer("".join(t or "" for _, t in rows).encode(), np.uint8)
    valid = np.ones(len(raw), bool)
    valid[-WIDTH + 1:] = False
    want = None
    for chunk in (1 << 18, 1000, 77):
        monkeypatch.setattr(suffix_dedup, "CHUNK", chunk)
        first, number, key = suffix_dedup.keyed(raw, valid)
        at = np.repeat(first, number) + np.concatenate([np.arange(n) for n in number])
        assert (at == np.arange(len(raw) - WIDTH + 1)).all() and number.max() <= suffix_dedup.MOST
        by_string = dict(zip((raw[p:p + WIDTH].tobytes() for p in at), np.repeat(key, number), strict=True))
        assert all(by_string[raw[p:p + WIDTH].tobytes()] == k for p, k in zip(at, np.repeat(key, number), strict=True))
        assert want in (None, by_string)
        want = by_string


@pytest.mark.parametrize("letters", ["ab", "a", "abcdefgh", "aab\0"])
def test_two_stage_order(letters):
    rng = random.Random(letters)
    for n in (1, 2, 5, 60, 400):
        raw = "".join(rng.choice(letters) for _ in range(n)).encode() + b"\xff"
        s = np.frombuffer(raw, np.uint8) + np.uint8(1)
        raw = s.tobytes()
        wanted = np.array([rng.random() < 0.6 for _ in range(len(s))])
        for depth in (8, 48, 400):
            order = suffix_dedup.two_stage(s, wanted, suffix_dedup.words(s, ">u8"), depth)
            assert sorted(order) == np.flatnonzero(wanted).tolist()
            heads = [raw[p:p + depth] for p in order]
            assert heads == sorted(heads)
            near = suffix_dedup.common_prefixes(suffix_dedup.words(s, ">u8"), order)
            for j in range(1, len(order)):
                a, b = raw[order[j - 1]:][:50], raw[order[j]:][:50]
                same = next((k for k, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
                assert near[j] >= same if len(raw) - max(order[j], order[j - 1]) < 50 else near[j] == same


def test_query_and_empty_table(spark, tmpdir_path):
    rows = corpus(seed=2, n=30)
    frame(spark, rows).write.parquet(f"{tmpdir_path}/in/documents.parquet")
    df = queries.QUERIES["op13_suffix_dedup"](spark, f"{tmpdir_path}/in")
    assert df.dtypes == [("doc_id", "bigint"), ("n_bytes", "bigint"), ("n_removed", "bigint"), ("n_spans", "bigint"), ("kept_sha256", "string")]
    assert got(df) == brute(rows)
    assert suffix_dedup.dedup(frame(spark, [])).count() == 0
    assert got(suffix_dedup.dedup(frame(spark, [(1, None), (2, "short")]))) == brute([(1, None), (2, "short")])
