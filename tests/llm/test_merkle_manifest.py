"""Manifests against plain hashing."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from roadbook.llm import merkle_manifest, queries
from roadbook.llm.common import importable


def h(parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(doc_id, source, lang, n_chars, text):
    said = []
    for value in (doc_id, source, lang, n_chars, text):
        said.append("-" if value is None else f"{len(str(value).encode())}:{value}")
    return h(said)


def tree(nodes, fanout=16):
    """All levels, and for each leaf its siblings and its place level by level."""
    paths, place = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for j, at in enumerate(place):
            low = at - at % fanout
            paths[j].append((nodes[low:at], nodes[at + 1:low + fanout]))
            place[j] = at // fanout
        nodes = [h(nodes[at:at + fanout]) for at in range(0, len(nodes), fanout)]
    return nodes[0], paths


def brute(rows, fanout=16):
    """rows: (doc_id, text, lang, source, n_chars)."""
    by = {}
    for d, text, lang, source, n in rows:
        by.setdefault(source, []).append((d, leaf(d, source, lang, n, text), text, lang, n))
    order = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    subtrees = {}
    for s in order:
        by[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        subtrees[s] = tree([r[1] for r in by[s]], fanout)
    root, tops = tree([subtrees[s][0] for s in order], fanout)
    out = []
    for at, s in enumerate(order):
        for (d, lf, text, lang, n), path in zip(by[s], subtrees[s][1], strict=True):
            path = path + tops[at]
            node = lf
            if d is not None and zlib.crc32(str(d).encode()) % 5 == 0 and text is not None:
                low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
                node = leaf(d, s, lang, n, low)
            for left, right in path:
                node = h([*left, node, *right])
            out.append((d, lf, subtrees[s][0], root, h([x for left, right in path for x in [*left, *right]]), node, node == root))
    return out


def rows_of(sizes):
    out, d = [], 0
    for source, n in sizes.items():
        for _ in range(n):
            text = [f"Text {d} É", None, "", "ABC " * 50][d % 4]
            out.append((d * 7, text, None if d % 11 == 0 else "en", source, None if d % 13 == 0 else d))
            d += 1
    return out


def saved(spark, rows, folder):
    importable(spark)
    schema = "doc_id long, text string, lang string, source string, n_chars long, leaf string, i int, G string"
    path = f"{folder}/in"
    spark.createDataFrame([(*r, "x", 1, "y") for r in rows], schema).write.parquet(f"{path}/documents.parquet")
    return path


COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def got(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=str)


def test_query_equals_plain_hashing(spark, tmpdir_path):
    rows = rows_of({None: 3, "": 1, "a": 300, "B": 16, "b": 17, "é": 5, **{f"s{k}": 2 for k in range(30)}})
    rows += [(None, "No id", "en", "a", 1), (None, "No id", "en", "a", 1), (14, "Same id, other text", "en", "a", 5), rows[20]]
    df = queries.QUERIES["op11_merkle_manifest"](spark, saved(spark, rows, tmpdir_path))
    assert dict(df.dtypes)["doc_id"] == "bigint" and dict(df.dtypes)["verified"] == "boolean"
    found = got(df)
    assert found == sorted(brute(rows), key=str)
    assert {r[-1] for r in found} == {True, False}


@pytest.mark.parametrize("fanout,depth", [(2, 1), (3, 1), (2, 3)])
def test_many_rounds_of_exchange(spark, tmpdir_path, fanout, depth):
    """Small blocks: up to seven rounds, with levels whose last subtree is anything from one block to a full one."""
    rows = rows_of({"a": 100, "b": 37, "c": 1, "d": 65, "e": 8, "f": 7})
    docs = spark.read.parquet(saved(spark, rows, tmpdir_path) + "/documents.parquet")
    out = merkle_manifest.manifest(queries.manifest_leaves(docs), depth, fanout)
    assert got(out.withColumnRenamed("id", "doc_id")) == sorted(brute(rows, fanout), key=str)


def test_one_leaf_and_no_leaf(spark, tmpdir_path):
    docs = spark.read.parquet(saved(spark, [(5, "x", None, "a", 1)], tmpdir_path) + "/documents.parquet")
    out = merkle_manifest.manifest(queries.manifest_leaves(docs)).collect()
    assert [r["root"] for r in out] == [leaf(5, "a", None, 1, "x")] and out[0]["proof_sha256"] == h([])
    none = merkle_manifest.manifest(queries.manifest_leaves(docs.where(F.lit(False))))
    assert none.count() == 0 and none.columns == ["id", "group", *merkle_manifest.RETURNED]


def test_a_partial_node_speaks_for_several(spark, monkeypatch):
    """The last subtree's one block answers many blocks, in strides."""
    importable(spark)
    monkeypatch.setattr(merkle_manifest, "STRIDE", 2)
    nodes = [f"{k}" for k in range(17)]
    parts = spark.createDataFrame([("g", k, 17, x) for k, x in enumerate(nodes)], "g string, i long, n long, node string")
    rows = merkle_manifest.butterfly(parts, 4, "butterfly-test").orderBy("i").collect()
    root, paths = tree(nodes, 4)
    assert [r["i"] for r in rows] == list(range(17)) and {r["node"] for r in rows} == {root}
    for r, path in zip(rows, paths, strict=True):
        assert [(s["run"][:s["at"]], s["run"][s["at"] + 1:]) for s in r["path"]] == path
