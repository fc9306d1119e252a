"""The corpus pipeline, stage by stage, against brute force."""

import random
import re
import zlib
from collections import Counter

import numpy as np

import corpus_pipeline
from roadbook.llm import packing
from roadbook.llm.common import scratch, written
from roadbook.llm.tokens import encoder, tokenizer_path
from tests.llm.test_mixing import filled
from tests.llm.test_near_dup import brute, edited
from tests.llm.test_secret_scan import base

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, spans string"


def corpus():
    rng = random.Random(6)
    rows = []

    def add(text, lang="en"):
        rows.append((len(rows), text, lang, rng.choice(["a", "b", "c", None]), None if text is None else len(text), 0.25, "own"))

    for _ in range(40):
        words = [f"{rng.choice(['the', 'and', 'of'])}{rng.randrange(60)}" for _ in range(rng.randrange(20, 200))]
        add(" ".join(words))
        if rng.random() < 0.5:
            add(edited(words, 1, rng))
            add(" ".join(words), None)
    for text in (None, "", "123 456", "...", "password = abcdef1 rest of the text", "key AKIA" + "Q7" * 10 + " and " + "0a" * 20, "un petit mot", "x " * 9000):
        add(text, "fr" if text and "petit" in text else None)
    return [*rows, rows[0]]


def test_stages_and_run(spark):
    rows = corpus()
    folder = scratch(spark, "pipeline-test")
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{folder}/documents.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    names, kept = [n for n, _ in corpus_pipeline.STAGES], {}
    assert names == ["language", "near_dup", "secrets", "mix", "pack"]
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, folder), f"test-{name}")
        kept[name] = docs.collect()
        if name != "pack":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", "score", "spans"]
            assert all(r.score == 0.25 and r.spans == "own" for r in kept[name])

    worded = [r for r in rows if r[1] and re.search(r"[^\W\d_]", r[1])]
    assert sorted(r.doc_id for r in kept["language"]) == sorted(r[0] for r in worded)
    assert all(r.lang in ("en", "fr") for r in kept["language"])

    first = {i for i, c in brute([(r[0], r[1]) for r in worded]).items() if i == c}
    assert sorted(r.doc_id for r in kept["near_dup"]) == sorted(first)

    text = {}
    for i, t, *_ in worded:
        at, parts = 0, []
        for a, _, b, _ in base(t):
            if a >= at:
                parts += [t[at:a], "[secret]"]
            at = max(at, b)
        text[i] = "".join(parts) + t[at:]
    assert {r.doc_id: r.text for r in kept["secrets"]} == {i: text[i] for i in first}
    assert all(r.n_chars == len(r.text) for r in kept["secrets"])

    size = {i: len(text[i].split()) for i in first}
    source = {r[0]: r[3] for r in rows}
    sizes = Counter()
    for i in first:
        sizes[source[i]] += size[i]
    want, copies, taken = filled(sizes), Counter(r.doc_id for r in kept["mix"]), Counter()
    for i, n in copies.items():
        assert n <= 3
        taken[source[i]] += n * size[i]
    # whole documents only: a source may stay half of its largest document away
    most = {s: max(size[i] for i in first if source[i] == s) for s in sizes}
    assert all(abs(taken[s] - w) <= 0.02 * w + most[s] / 2 for s, w in want.items()), (taken, want)
    assert all(r.text == text[r.doc_id] for r in kept["mix"])

    tok = encoder(tokenizer_path("word_bpe_49k.json")).tokenizer
    pieces = Counter()
    for i, n in copies.items():
        ids = np.array([*tok.encode(text[i], add_special_tokens=False).ids, 2], "<u4")
        for k in range(0, len(ids), packing.SIZE):
            part = ids[k:k + packing.SIZE]
            pieces[i, k, len(part), zlib.crc32(part.tobytes()), len(ids)] += n
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in kept["pack"]) == pieces
    ends = {}
    for r in sorted(kept["pack"], key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == ends.get(r.sequence_id, 0)
        ends[r.sequence_id] = r.offset + r.length
    assert max(ends.values()) <= packing.SIZE

    whole = corpus_pipeline.run(spark, folder).collect()
    assert sorted(map(tuple, whole)) == sorted(map(tuple, kept["pack"]))


def test_empty_documents(spark):
    docs = spark.createDataFrame([], SCHEMA)
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, ""), f"test-{name}")
    assert docs.count() == 0


def test_language_keeps_all_lettered_texts(spark):
    """Nothing to learn from, or a label that reads 'und': only texts without a letter go."""
    texts = ["the cat", "un chat", "123 456", "", None, "日本"]
    for labels in ([None] * 6, [None, None, "en", "fr", "en", None], ["und", None, None, None, None, None], ["und", "fr", None, None, None, None]):
        rows = [(i, t, lang, "a", None, 0.25, "own") for i, (t, lang) in enumerate(zip(texts, labels, strict=True))]
        got = corpus_pipeline.language(spark, spark.createDataFrame(rows, SCHEMA), "").collect()
        assert sorted(r.doc_id for r in got) == [0, 1, 5], labels
        assert all(r.lang is not None and r.text == texts[r.doc_id] for r in got)
