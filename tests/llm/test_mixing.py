"""Mixing to target weights."""

import random

import pytest

from roadbook.llm import mixing
from roadbook.llm.common import importable


def frame(spark, rows):
    importable(spark)
    return spark.createDataFrame([(*r, 5, "x") for r in rows], "doc_id long, text string, source string, size int, copies string")


def corpus(n=900):
    rng = random.Random(2)
    rows = []
    for i in range(n):
        # one source holds a third of all rows, one is null, one tiny
        source = "big" if i % 3 == 0 else rng.choice(["a", "b", "c", None, "é"]) if i % 100 else "tiny"
        rows.append((i, " ".join(["w"] * int(rng.paretovariate(1.5) * 20)), source))
    return rows


def filled(sizes, weights=(5, 2, 1), cap=3):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode("utf-32-be")))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, open_, left = {}, set(names), sum(sizes.values())
    while open_:
        level = left / sum(w[s] for s in open_)
        over = [s for s in open_ if level * w[s] > cap * sizes[s]]
        if not over:
            return target | {s: level * w[s] for s in open_}
        for s in over:
            target[s] = cap * sizes[s]
            left -= target[s]
            open_.discard(s)
    return target


def test_mix_reaches_targets(spark):
    rows = corpus()
    got = mixing.copies(frame(spark, rows)).collect()
    size = {i: len(t.split()) for i, t, _ in rows}
    sizes, taken = {}, {}
    for i, _, s in rows:
        sizes[s] = sizes.get(s, 0) + size[i]
    want = filled(sizes)
    assert len(got) == len(rows)
    for r in got:
        assert r.size == size[r.doc_id] and r.source_size == sizes[r.source] and 0 <= r.copies <= 3
        assert r.target == pytest.approx(want[r.source], rel=1e-9)
        # whole copies beside the rounded one
        low = int(want[r.source] / sizes[r.source] + 1e-9)
        assert low <= r.copies <= low + 1
        taken[r.source] = taken.get(r.source, 0) + r.copies * r.size
    for s, w in want.items():
        assert abs(taken[s] - w) <= max(0.01 * w, 3), (s, taken[s], w)
    again = mixing.copies(frame(spark, rows[::-1]).repartition(5)).collect()
    assert sorted((r.doc_id, r.copies) for r in again) == sorted((r.doc_id, r.copies) for r in got)


def test_expectation_is_kept(spark):
    """Over many seeds a document is due its fraction (equal sizes: no closing step is needed)."""
    rows = [(i, "w " * 10, "a" if i < 30 else "b" if i < 60 else "c") for i in range(90)]
    times = [0] * 90
    for seed in range(6):
        for r in mixing.copies(frame(spark, rows), seed=seed).collect():
            times[r.doc_id] += r.copies
    # targets 562.5, 225 and 112.5 of 300 words
    for lo, hi, mean in ((0, 30, 1.875), (30, 60, 0.75), (60, 90, 0.375)):
        assert abs(sum(times[lo:hi]) / 180 - mean) < 0.05
        # no document is favoured: each has its whole part or one more, now this, now that
        assert all(6 * int(mean) <= t <= 6 * int(mean) + 6 for t in times[lo:hi]) and len(set(times[lo:hi])) > 2


def test_edges(spark):
    assert mixing.copies(frame(spark, [])).count() == 0
    rows = [(1, None, None), (1, None, None), (2, "", "a"), (None, "a b c", "a"), (None, "a b c", "a"), (3, "x " * 40, "b"), (3, "x " * 40, "b")]
    got = mixing.copies(frame(spark, rows)).collect()
    assert sum(r.rows for r in got) == len(rows) and {r.doc_id for r in got} == {1, 2, 3, None}
    mixed = mixing.mix(frame(spark, rows))
    assert mixed.columns == ["doc_id", "text", "source", "size", "copies"]
    n = {(r.doc_id, r.source): r.copies * r.rows for r in got}
    have = {}
    for r in mixed.collect():
        have[r.doc_id, r.source] = have.get((r.doc_id, r.source), 0) + 1
    assert have == {k: v for k, v in n.items() if v}
