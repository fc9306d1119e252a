"""Hard negatives against plain integer products."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from roadbook.llm import hard_negatives, queries
from roadbook.llm.common import importable

SCHEMA = "vec_id long, embedding array<float>, label int, score long, anchor int, `row` string, bucket int"


def saved(spark, rows, folder):
    importable(spark)
    path = f"{folder}/in"
    spark.createDataFrame([(*r, 1, 2, "x", 3) for r in rows], SCHEMA).write.parquet(f"{path}/embeddings.parquet")
    return path


def brute(rows, k=5):
    ok, lengths = {}, {}
    for i, v, label in rows:
        if i is None or v is None or label is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        label = (label + 1) % 10 if i % 7 == 0 else label
        ok[(i, label, tuple(v))] = (i, label, [math.floor(256 * float(np.float32(x))) for x in v])
        lengths[len(v)] = lengths.get(len(v), 0) + 1
    ok = [x for x in ok.values() if len(x[2]) == max(lengths, key=lambda n: (lengths[n], -n))]
    out = []
    for i, label, v in ok:
        if i % 100:
            continue
        scored = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), j, m) for j, m, w in ok if j != i)
        for s, j, _ in [x for x in scored if x[2] == label][:k]:
            fit = [x for x in scored if x[2] != label and 80 * -s <= 100 * -x[0] <= 100 * -s]
            out += [(i, j, rank, n, -s, -t) for rank, (t, n, _) in enumerate(fit[:k], 1)]
    return sorted(out)


def got(df):
    return sorted(tuple(r) for r in df.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())


def vectors(n, d, seed=3, spread=0.2):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d)) * spread + rng.normal(size=d) * 0.3
    x[n // 3:2 * n // 3] = x[5]                    # a third of the rows share one vector
    return [(int(i), [float(np.float32(c)) for c in v], int(rng.integers(10))) for i, v in enumerate(x)]


def test_query_equals_brute_force(spark, tmpdir_path):
    rows = vectors(900, 12)
    rows += [(10_000, None, 1), (10_100, [0.0] * 12, 1), (10_200, [float("nan")] * 12, 1), (10_300, rows[3][1], None), (None, rows[3][1], 3),
             (10_400, [None] * 12, 2), (10_500, [0.5] * 11, 2), (10_600, [], 2), rows[100], (200, [0.25] * 12, 4),
             (-100, [0.5] * 12, 2), (10_700, [float("inf")] + [0.0] * 11, 1)]
    df = queries.QUERIES["op12_hard_negatives"](spark, saved(spark, rows, tmpdir_path))
    assert dict(df.dtypes)["rank"] == "int" and dict(df.dtypes)["negative_score"] == "bigint"
    want = brute(rows)
    assert got(df) == want and len(want) > 100


def test_small_blocks_and_a_hot_label(spark, tmpdir_path, monkeypatch):
    monkeypatch.setattr(hard_negatives, "BLOCK", 40)
    monkeypatch.setattr(hard_negatives, "ANCHORS", 2)
    monkeypatch.setattr(hard_negatives, "STEP", 100)
    monkeypatch.setattr(hard_negatives, "BUCKETS", 3)
    rows = [(i, v, 1 if i % 2 else label) for i, v, label in vectors(700, 5, seed=8)]
    assert got(queries.QUERIES["op12_hard_negatives"](spark, saved(spark, rows, tmpdir_path))) == brute(rows)


@pytest.mark.parametrize("rows", [[], [(100, [1.0, 2.0], 1)], [(100, [1.0], 1), (101, [1.0], 1)], [(1, [1.0], 1), (3, [1.0], 2)]])
def test_nothing_to_mine(spark, tmpdir_path, rows):
    assert got(queries.QUERIES["op12_hard_negatives"](spark, saved(spark, rows, tmpdir_path))) == []


def test_products_are_exact():
    rng = np.random.default_rng(0)
    for d, most in ((1, 3), (64, 256), (300, 5000), (3000, 2 ** 15), (64, 2 ** 20)):
        a, b = (rng.integers(-most, most + 1, size=(7, d)) for _ in range(2))
        a[0], b[0] = most, -most
        moduli = hard_negatives.primes(d, d * most * most)
        out = hard_negatives.product(*([hard_negatives.residues(x.astype(float), p) for p in moduli] for x in (a, b)), moduli)
        assert (out == a @ b.T).all()


def test_scores_beyond_the_bound_are_refused(spark):
    importable(spark)
    df = spark.createDataFrame([(100, [1e12], 1), (1, [1.0], 1)], "vec_id long, embedding array<double>, label int")
    with pytest.raises(ValueError, match="2 \\*\\* 48"):
        hard_negatives.mine(df, F.col("vec_id") == 100)
