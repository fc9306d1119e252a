"""Near-duplicate classes against brute force."""

import random

import numpy as np

from roadbook.llm import near_dup
from roadbook.llm.common import importable


def shingle_set(text):
    w = (text or "").encode().split()
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(rows, similar=0.8):
    """{id: smallest id of its component}."""
    ids = sorted({i for i, _ in rows if i is not None})
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    sets = [(i, shingle_set(t)) for i, t in rows if i is not None]
    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and len(a & b) >= similar * len(a | b):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def edited(words, n, rng):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


def corpus():
    rng = random.Random(5)
    texts = []
    passage = [f"common{i}" for i in range(30)]
    for b in range(12):
        base = [f"w{rng.randrange(400)}" for _ in range(rng.randrange(40, 300))]
        texts += [" ".join(base)] * 2
        # some copies are within reach of the first text, some only of one another, some of none
        texts += [edited(base, n, rng) for n in (1, 1, 2, 3, 5, 8, 13, 21)]
        texts.append(" ".join(passage + base[: 20 + b]))
    chain = [f"c{i}" for i in range(200)]
    for _ in range(8):
        texts.append(" ".join(chain))
        chain = chain[8:] + [f"c{rng.randrange(10**6)}" for _ in range(8)]
    texts += ["one line again\n" * 40, "one line again\n" * 60, "tiny", "tiny", "two words", "", None, "  \n ", "a b c d e", "a b c d e f"]
    rows = list(enumerate(texts))
    return [*rows, (3, texts[3]), (None, texts[0])]      # a repeated row, a null id


def frame(spark, rows):
    importable(spark)
    return spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, doc int, same string")


def test_classes_equal_brute_force(spark):
    rows = corpus()
    got = near_dup.classes(frame(spark, rows)).collect()
    assert {r.doc: r.class_id for r in got} == brute(rows)
    assert len(got) == len({i for i, _ in rows if i is not None})


def test_repeated_lines(spark):
    """Pairs whose plain similarity is 0.8 or more, though a line stands 30 or 50 times in one of them."""
    rng = random.Random(8)
    texts = []
    for k in range(80):
        n, times = (100, 30) if k % 2 else (60, 50)
        base, line = ([f"{c}{k}x{rng.randrange(10**6)}" for _ in range(m)] for c, m in (("w", n), ("l", 10)))
        texts += [" ".join(base), " ".join(base + line * times)]
    rows = list(enumerate(texts))
    want = brute(rows)
    assert len(set(want.values())) == 80
    assert {r.doc: r.class_id for r in near_dup.classes(frame(spark, rows)).collect()} == want


def test_tiles_find_what_pivots_miss(spark, monkeypatch):
    """Small blocks: the same classes from tiles of two blocks."""
    rows = corpus()
    monkeypatch.setattr(near_dup, "BLOCK", 3)
    assert {r.doc: r.class_id for r in near_dup.classes(frame(spark, rows)).collect()} == brute(rows)


def test_one_of_each(spark):
    rows = corpus()
    docs = frame(spark, rows)
    kept = near_dup.one_of_each(docs)
    want = brute(rows)
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted(i for i, c in want.items() if i == c)
    assert kept.columns == docs.columns


def test_one_of_each_with_repeated_and_null_ids(spark):
    a, b, c, d = (" ".join(f"{x}{k}" for k in range(40)) for x in "abcd")
    near_a = a + " more"
    rows = [(1, a), (1, b), (2, a), (3, near_a), (1, a), (4, "short"), (4, "other"), (4, "short"), (None, a), (None, c), (None, c), (None, "short"),
            (5, d), (5, d + " x"), (6, d), (7, None), (7, ""), (None, None)]
    kept = sorted(((r.doc_id, r.text) for r in near_dup.one_of_each(frame(spark, rows)).collect()), key=str)
    fives = [r for r in kept if r[0] == 5]
    assert len(fives) == 1 and fives[0][1] in (d, d + " x")
    sevens = [r for r in kept if r[0] == 7]
    assert len(sevens) == 1 and not sevens[0][1]
    assert [r for r in kept if r[0] not in (5, 7)] == sorted([(1, a), (1, b), (4, "short"), (4, "other"), (None, c)], key=str)


def test_nothing(spark):
    assert near_dup.classes(frame(spark, [])).count() == 0
    assert near_dup.classes(frame(spark, [(1, None), (2, "")])).where("doc = class_id").count() == 2


def test_signatures_estimate_probability_jaccard():
    """Registers agree as often as the weighted similarity says."""
    rng = np.random.default_rng(1)
    for n in (6, 60, 3000):
        pool = near_dup.mixed(rng.integers(1, 1 << 62, 2 * n).astype(np.uint64))
        a, b = pool[:n], pool[n // 4: n + n // 4]
        ca, cb = (rng.integers(1, 6, n), rng.integers(1, 6, n)) if n < 3000 else (np.ones(n), np.ones(n))
        wa, wb = dict(zip(a, 1 + np.log(ca))), dict(zip(b, 1 + np.log(cb)))
        true = sum(1 / sum(max(wa.get(j, 0) / wa[i], wb.get(j, 0) / wb[i]) for j in {*wa, *wb}) for i in set(wa) & set(wb)) if n < 3000 else 0.6
        same = np.mean([near_dup.signature(near_dup.mixed(a + np.uint64(s)), ca) == near_dup.signature(near_dup.mixed(b + np.uint64(s)), cb) for s in range(40)])
        assert abs(same - true) < 0.04, (n, same, true)
