"""Vector search against brute force."""

import numpy as np
from pyspark.sql import functions as F

from roadbook.llm import vector_search
from roadbook.llm.common import importable


def frame(spark, rows):
    importable(spark)
    return spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id long, embedding array<float>, first int, id int")


def brute(rows, k):
    ok = [(i, np.array(v, np.float32).astype(float)) for i, v in rows if v is not None and i is not None and None not in v
          and np.isfinite(np.array(v, float)).all() and any(v)]
    out = {}
    for q, x in ok:
        if q % 20 == 0:
            near = sorted((-float(x @ y), i) for i, y in ok if i != q)
            out[q] = near[:k]
    return out


def test_recall_scores_and_ties(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(1500, 16))
    x[500:1000] = x[7]                       # a third of the rows share one vector
    rows = [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(x)]
    want = brute(rows, 20)
    got = {}
    for r in vector_search.search(frame(spark, rows), F.col("vec_id") % 20 == 0, centroids=8).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert set(got) == set(want)
    hits = 0
    for q, found in got.items():
        assert [r for r, _, _ in found] == list(range(1, 21)) and q not in [v for _, v, _ in found]
        truth = {i: -s for s, i in want[q]}
        hits += len(truth.keys() & {v for _, v, _ in found})
        assert all(abs(s - truth[v]) < 1e-9 for _, v, s in found if v in truth)
        assert [(-s, v) for _, v, s in found] == sorted((-s, v) for _, v, s in found)
        if 500 <= q < 1000:                  # equal vectors: the smallest ids
            assert [v for _, v, _ in found][:20] == [i for _, i in want[q]]
    assert hits / (20 * len(want)) >= 0.9


def test_whole_traversal_is_exact_and_blocks_agree(spark, monkeypatch):
    rng = np.random.default_rng(2)
    rows = [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(rng.normal(size=(300, 6)))]
    want = brute(rows, 5)
    monkeypatch.setattr(vector_search, "BLOCK", 7)
    got = vector_search.search(frame(spark, rows), F.col("vec_id") % 20 == 0, k=5, centroids=4, recall=1.0).collect()
    found = {}
    for r in got:
        found.setdefault(r.query_id, {})[r.rank] = r.vec_id
    # recall 1.0 of the tried queries, which are all of them here
    assert {q: [v[k] for k in sorted(v)] for q, v in found.items()} == {q: [i for _, i in near] for q, near in want.items()}


def test_edges(spark):
    asks = F.col("vec_id") % 20 == 0
    assert vector_search.search(frame(spark, []), asks).count() == 0
    rows = [(0, [1.0, 0.0]), (1, None), (2, [0.0, 0.0]), (3, [1.0, None]), (4, [float("nan"), 1.0]), (5, [float("inf"), 1.0]),
            (6, [0.5, 0.5]), (None, [1.0, 1.0]), (7, [1.0]), (20, [1.0, 0.0]), (20, [1.0, 0.0]), (8, [-1.0, 0.0])]
    got = vector_search.search(frame(spark, rows), asks).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r.rank, r.vec_id, r.score) for r in got] == [
        (0, 1, 20, 1.0), (0, 2, 6, 0.5), (0, 3, 8, -1.0), (20, 1, 0, 1.0), (20, 2, 6, 0.5), (20, 3, 8, -1.0)]
    assert vector_search.search(frame(spark, [(0, [1.0])]), asks).count() == 0


def test_heap_order():
    rng = np.random.default_rng(3)
    a, b = rng.normal(size=5), rng.normal(size=7)
    got = [a[i] + b[j] for i, j in vector_search.traversal(a, b)]
    assert got == sorted(got) and len(got) == 35
