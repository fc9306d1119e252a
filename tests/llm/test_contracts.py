"""Contract columns of the registered queries against plain Python, on rows with nulls, empty texts, ties and repeats."""

import hashlib
import re
import struct
import zlib

import numpy as np
import pytest

from roadbook.llm import queries
from roadbook.llm.common import importable
from roadbook.llm.tokens import encoder, tokenizer_path

PROSE = {"en": "the quick brown fox jumps over the lazy dog near the river bank and sleeps under old trees",
         "de": "der schnelle braune fuchs springt über den faulen hund am ufer und schläft unter alten bäumen"}
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size int, SCORE string, spans string, kept int"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def rows():
    out = []
    for k in range(60):
        lang = ("en", "de")[k % 2]
        words = PROSE[lang].split()
        text = " ".join(words[(k + j) % len(words)] for j in range(8 + k))
        out.append((k, text, lang if k % 9 else None, None if k % 10 == 0 else f"s{k % 4}"))
    out += [(100, None, "en", "s1"), (101, "", None, "s1"), (102, "12 34 !!", "de", None), (103, "İ, x İ. <|ENDOFTEXT|> b", "en", "s2"),
            (104, "password = abcdefgh and token:\"" + "f" * 40 + "\" AKIA" + "Z9" * 10 + " " + "0a" * 20, "en", "s2"), (105, "line\nline\n \nline\nother", "en", "s3"),
            (106, "a b c d e f g h " * 30, "en", "s3"), (107, "word " * 6000, "de", "s0"), (108, "#*$%& |<> x", None, "s0")]
    out += [out[3], out[3], (3, "another text under the same id", "en", "s3"), (None, "a text without an id", "en", "s1"), (None, None, None, None)]
    return out


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    importable(spark)
    path = str(tmp_path_factory.mktemp("contract") / "in")
    data = [(*r, None if r[1] is None else len(r[1]), 1, "clash", "clash", 0) for r in rows()]
    spark.createDataFrame(data, SCHEMA).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(k, k % 3 != 0, 0) for k in range(40)], "doc_id long, good boolean, toxic int").selectExpr(
        "doc_id", "cast(good as int) as quality", "toxic").write.parquet(f"{path}/labels.parquet")
    return path


def got(spark, name, folder, *columns):
    df = queries.QUERIES[name](spark, folder)
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str), dict(df.dtypes)


def ids(name, text):
    return encoder(tokenizer_path(name)).tokenizer.encode(text or "", add_special_tokens=False).ids


def crc(tokens):
    return zlib.crc32(struct.pack(f"<{len(tokens)}I", *tokens))


def test_op1(spark, folder):
    found, types = got(spark, "op1_mixing", folder, "doc_id", "size", "source_size", "target", "taken", "source")
    assert [types[c] for c in ("size", "source_size", "target", "taken")] == ["bigint", "bigint", "double", "bigint"]
    sizes = {}
    for d, text, _, source in rows():
        sizes[source] = sizes.get(source, 0) + len(WORD.findall(text or ""))
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    target, left, free = {}, float(sum(sizes.values())), set(order)
    while free:
        level = left / sum(weight[s] for s in free)
        over = {s for s in free if level * weight[s] > 3 * sizes[s]}
        if not over:
            target |= {s: level * weight[s] for s in free}
            break
        for s in over:
            target[s] = 3.0 * sizes[s]
            left -= target[s]
        free -= over
    assert sorted(((r[0], r[1], r[5]) for r in found), key=str) == sorted(((d, len(WORD.findall(t or "")), s) for d, t, _, s in rows()), key=str)
    taken = dict.fromkeys(order, 0)
    largest = dict.fromkeys(order, 1)
    for _, size, source_size, goal, took, source in found:
        assert source_size == sizes[source] and abs(goal - target[source]) < 1e-6 and took <= 3 * size and took % max(1, size) == 0
        taken[source] += took
        largest[source] = max(largest[source], size)
    assert all(abs(taken[s] - target[s]) <= largest[s] for s in order)
    assert got(spark, "op1_mixing", folder, "doc_id", "size", "source_size", "target", "taken", "source")[0] == found


def test_op2(spark, folder):
    found, types = got(spark, "op2_language_id", folder, "doc_id", "held_out", "lang_pred", "score")
    assert types["score"] == "double" and len(found) == len(rows())
    texts = {}
    for d, t, lang, _ in rows():
        texts.setdefault(d, []).append((t, lang))
    for d, held, pred, score in found:
        assert held == (d is not None and zlib.crc32(str(d).encode()) % 4 == 2) and 0 <= score <= 1
        assert pred in ("en", "de", "und")
        if d is not None and d < 60 and len(texts[d]) == 1:
            assert pred == ("en", "de")[d % 2]
        if all(t is None or not any(c.isalpha() for c in t) for t, _ in texts[d]):
            assert (pred, score) == ("und", 0.0)


def test_op3(spark, folder):
    found, types = got(spark, "op3_token_counts", folder, "doc_id", "n_bytes", "n_tokens", "over_limit")
    want = [(d, len((t or "").encode()), n := len(ids("byte_bpe_50k.json", t)), n > 512) for d, t, _, _ in rows()]
    assert found == sorted(want, key=str) and types["n_tokens"] == "bigint"


def test_op5(spark, folder):
    found, _ = got(spark, "op5_token_files", folder, "doc_id", "start", "n_tokens", "ids_crc32")
    want = sorted((d, len(x := [*ids("word_bpe_49k.json", t), 2]), crc(x)) for d, t, _, _ in rows() if d is not None)
    assert sorted((d, n, c) for d, _, n, c in found if d is not None) == want and len(found) == len(rows())
    at = min(s for d, s, _, _ in found if d is not None)
    for d, start, n, _ in sorted((r for r in found if r[0] is not None), key=lambda r: r[1]):
        assert start == at
        at += n
    order = [d for d, _, _, _ in sorted((r for r in found if r[0] is not None), key=lambda r: r[1])]
    assert order == sorted(order)


def test_op6(spark, folder):
    found, _ = got(spark, "op6_secret_scan", folder, "doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans")
    forms = (("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I, lambda m: len(m[2]) >= 6),
             ("access", r"AKIA[A-Z0-9]+", 0, lambda m: len(m[0]) >= 20), ("hex", r"[0-9a-f]+", 0, lambda m: len(m[0]) >= 24))
    want = []
    for d, t, _, _ in rows():
        spans = sorted((m.start(), k, m.end(), kind) for k, (kind, p, flags, ok) in enumerate(forms) for m in re.finditer(p, t or "", flags | re.A) if ok(m))
        said = ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in spans)
        want.append((d, *(sum(s[3] == k for s in spans) for k in ("assign", "access", "hex")), hashlib.sha256(said.encode()).hexdigest(), said))
    assert [r[:5] for r in found] == [r[:5] for r in sorted(want, key=str)]
    assert all(set(filter(None, w[5].split(","))) <= set(f[5].split(",")) for f, w in zip(found, sorted(want, key=str), strict=True))
    assert sum(r[1] for r in found) == 2


def test_op9(spark, folder):
    found, _ = got(spark, "op9_packing", folder, "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
    want = []
    for d, t, _, _ in rows():
        x = [*ids("word_bpe_49k.json", t), 2]
        want += [(d, k, len(x[k:k + 4096]), crc(x[k:k + 4096]), len(x)) for k in range(0, len(x), 4096)]
    assert sorted((r[:5] for r in found), key=str) == sorted(want, key=str)
    sequences = {}
    for r in found:
        sequences.setdefault(r[5], []).append((r[6], r[2]))
    for places in sequences.values():
        at = 0
        for offset, n in sorted(places):
            assert offset == at
            at += n
        assert at <= 4096
    assert len(sequences) <= -(-sum(r[2] for r in found) // 4096) + 1


def test_op10(spark, folder):
    columns = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    found, _ = got(spark, "op10_quality_rules", folder, *columns)
    want = []
    for d, t, _, _ in rows():
        words, seen, dup = WORD.findall(t or ""), set(), 0
        for line in (t or "").split("\n"):
            if WORD.search(line):
                dup += line in seen
                seen.add(line)
        windows = [tuple(words[k:k + 8]) for k in range(len(words) - 7)]
        hit = set()
        for k, w in enumerate(windows):
            if windows.count(w) > 1 if len(windows) < 500 else len(set(windows)) < len(windows):
                hit |= set(range(k, k + 8))
        failed = len(words) < 20 or 100 * len(hit) > 30 * len(words)
        want.append((d, len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in t or ""), dup, len(hit), failed))
    assert [r[:7] for r in found] == sorted(want, key=str)
    assert all(isinstance(r[7], bool) and not (r[6] and r[7]) for r in found)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def test_op8(spark, folder):
    """Documents with text and id: same class exactly where links of five-word Jaccard 0.8 or more join them."""
    df = queries.QUERIES["op8_near_dup"](spark, folder)
    assert dict(df.dtypes)["doc_id"] == "bigint" and dict(df.dtypes)["class_id"] == "bigint"
    found = [(r.doc_id, r.class_id) for r in df.collect()]
    single = {d: t for d, t, _, _ in rows() if d is not None and d != 3}          # 3 is shared by unlike texts
    sets = {}
    for d, t in single.items():
        w = words(t)
        s = {tuple(w[i:i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())
        sets[d] = s
    parent = {d: d for d in sets}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                parent[max(root(a), root(b))] = min(root(a), root(b))
    of = dict(found)
    assert set(of) >= set(sets)
    lettered = [d for d in sets if sets[d]]
    for a in lettered:
        for b in lettered:
            assert (of[a] == of[b]) == (root(a) == root(b)), (a, b)


def test_op4(spark, tmp_path):
    rng = np.random.default_rng(11)
    vectors = [rng.normal(size=8).astype(np.float32).tolist() for _ in range(60)]
    data = [(k, v, 1, "clash") for k, v in enumerate(vectors)]
    data += [(60, vectors[3], 1, "x"), (80, vectors[3], 1, "x"), (100, None, 1, "x"), (120, [0.0] * 8, 1, "x"), (140, [float("nan")] * 8, 1, "x"),
             (160, [None] + [1.0] * 7, 1, "x"), (61, [float("inf")] * 8, 1, "x")]
    path = str(tmp_path / "in")
    spark.createDataFrame(data, "vec_id long, embedding array<float>, label int, score string").write.parquet(f"{path}/embeddings.parquet")
    df = queries.QUERIES["op4_vector_search"](spark, path)
    types = dict(df.dtypes)
    assert [types[c] for c in ("query_id", "rank", "vec_id", "score")] == ["bigint", "int", "bigint", "double"]
    ok = {k: np.array(v, np.float32).astype(float) for k, v, _, _ in data if k < 60 or k in (60, 80)}
    by = {}
    for r in df.collect():
        by.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert set(by) == {k for k in ok if k % 20 == 0}
    hit = total = 0
    for q, found in by.items():
        found.sort()
        assert [r for r, _, _ in found] == list(range(1, 21))
        assert [(-s, v) for _, v, s in found] == sorted((-s, v) for _, v, s in found) and q not in {v for _, v, _ in found}
        for _, v, s in found:
            assert abs(s - float(ok[q] @ ok[v])) < 1e-12
        best = [v for _, v in sorted((-float(ok[q] @ y), v) for v, y in ok.items() if v != q)[:20]]
        hit, total = hit + len(set(best) & {v for _, v, _ in found}), total + 20
    assert hit >= 0.9 * total


def test_op7(spark, folder):
    df = queries.QUERIES["op7_quality_model"](spark, folder)
    found = df.collect()
    assert sorted((r.doc_id for r in found), key=str) == sorted((d for d, *_ in rows()), key=str)
    again = {(r.doc_id, i): r for i, r in enumerate(sorted(queries.QUERIES["op7_quality_model"](spark, folder).collect(), key=str))}
    assert [str(r) for r in again.values()] == sorted(str(r) for r in found)
