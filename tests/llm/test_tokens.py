"""Token ids, counts, files and packing against the tokenizers library."""

import unicodedata
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from roadbook.llm import packing, token_counts, token_files
from roadbook.llm.common import importable, scratch
from roadbook.llm.tokens import encoder, tokenizer_path

ODD = [None, "", " ", "\n", "a  b\n\n c \n d", "<|endoftext|> a<|endoftext|>b", "it's I'll don't 'S", "Ünï É É x y", "ΣΑΣ İstanbul 12 345",
       "  lead", "trail  ", "a \nb", "a\n b", "a\n \nb", "#$% foo<|startoftext|>bar", "_a_ (b) [c]", "x'y''s 's", "a., b.. c!. d", "日本語 тест ß ẞ",
       "é. x", "_. a", "word, Word. WORD", "\x1c\x85 a b", "İ, x", "İ. x", "aİ,\nx", "ß, x. İ", "e\u0301, x", "x\u0301. \u0301, y",
       "a\x1c, b", "\x1f. x", "a" * 5000, "x " * 9000]
#: Letters whose lower case is longer than one character, combining marks, and what may stand around them.
LONG_LOWER = [c for c in map(chr, range(0x110000)) if len(c.lower()) > 1]
MARKS = [c for c in map(chr, range(0x110000)) if unicodedata.category(c) in ("Mn", "Mc", "Me")]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_ids_are_the_librarys(name):
    e = encoder(tokenizer_path(name))
    for text in ODD:
        assert np.frombuffer(e.encode(text), "<u4").tolist() == e.tokenizer.encode(text or "", add_special_tokens=False).ids, text
        assert e.count(text) == len(e.tokenizer.encode(text or "", add_special_tokens=False).ids)


@settings(max_examples=400, deadline=None)
@given(st.text(st.sampled_from(list("aAbÉéßöΣσİıſ.,!'_-<|>$ \n\t\r09½́ \x1c日s")), max_size=40),
       st.sampled_from(["word_bpe_49k.json", "byte_bpe_50k.json"]))
def test_ids_property(text, name):
    e = encoder(tokenizer_path(name))
    assert np.frombuffer(e.encode(text), "<u4").tolist() == e.tokenizer.encode(text, add_special_tokens=False).ids


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["<|endoftext|>", "<|ENDOFTEXT|>", "<|EndOfText|>", "<|STARTOFTEXT|>", "<|startofText|>", "<|", "|>", "END", "of", "a", "B",
                                 " ", "\n", ". ", ", ", "\u03a3", "\u0130", "\u212a"]), max_size=8).map("".join),
       st.sampled_from(["word_bpe_49k.json", "byte_bpe_50k.json"]))
def test_special_strings_in_any_case(text, name):
    e = encoder(tokenizer_path(name))
    for t in (text, f"a {text.swapcase()} b", "a <|ENDOFTEXT|> b"):
        assert np.frombuffer(e.encode(t), "<u4").tolist() == e.tokenizer.encode(t, add_special_tokens=False).ids


@settings(max_examples=600, deadline=None)
@given(st.lists(st.one_of(st.sampled_from(LONG_LOWER), st.sampled_from(MARKS), st.sampled_from(list("aIiß,.!_' \n\x1c\x1f\x85"))), max_size=12).map("".join),
       st.sampled_from(["word_bpe_49k.json", "byte_bpe_50k.json"]))
def test_long_lower_cases_and_marks(text, name):
    e = encoder(tokenizer_path(name))
    for t in (text, f"x{text}, {text}. y"):
        assert np.frombuffer(e.encode(t), "<u4").tolist() == e.tokenizer.encode(t, add_special_tokens=False).ids


def frame(spark, texts):
    importable(spark)
    rows = [(i, t, "clash", 7) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, ids string, n_tokens int")


def test_counts_through_the_cache(spark):
    path, cache = tokenizer_path("byte_bpe_50k.json"), scratch(spark, "cache")
    tok = encoder(path).tokenizer
    texts = ODD[:-2] + ["same"] * 5
    for _ in range(2):      # the second run finds all counts stored
        got = token_counts.count_tokens(frame(spark, texts), path, cache).collect()
        assert len(got) == len(texts) and got[0].ids == "clash"
        for r in got:
            n = len(tok.encode(texts[r.doc_id] or "", add_special_tokens=False).ids)
            assert (r.n_tokens, r.n_bytes, r.over_limit) == (n, len((texts[r.doc_id] or "").encode()), n > 512)
        assert spark.read.parquet(cache).count() == len({t or "" for t in texts})
    assert token_counts.count_tokens(frame(spark, []), path, cache).count() == 0


def test_block_round_trip():
    rng = np.random.default_rng(3)
    ids = (rng.zipf(1.3, 150_000) % 5000).astype("<u2")
    coder = token_files.Coder(token_files.quantised(np.bincount(ids, minlength=6000)))
    for n in (0, 1, 31, 32, 33, 5000, 150_000):
        assert (coder.decode(coder.encode(ids[:n])) == ids[:n]).all()
    block = coder.encode(ids, lanes=256, every=64)
    for k in range(1, 9):        # each checkpoint starts a reader of its own
        assert (coder.decode(block, k, k + 1) == ids[k * 64 * 256:(k + 1) * 64 * 256]).all()
    bad = bytearray(block)
    bad[-3] ^= 1
    with pytest.raises(ValueError, match="checksum"):
        coder.decode(bytes(bad))
    alone = token_files.Coder(token_files.quantised(np.array([0, 9])))
    assert (alone.decode(alone.encode(np.ones(5000, "<u2"))) == 1).all()
    assert token_files.quantised(np.array([10**12, 1, 0, 1])).tolist()[1:] == [1, 0, 1]


def test_crc_of_parts():
    data = bytes(range(256)) * 9
    for cut in (0, 1, 100, len(data)):
        parts = [(zlib.crc32(x), len(x)) for x in (data[:cut], data[cut:])]
        assert token_files.joined_crc(parts) == zlib.crc32(data)


def test_files_round_trip(spark):
    path = tokenizer_path("word_bpe_49k.json")
    tok = encoder(path).tokenizer
    texts = [*ODD, "long text here. " * 60_000]       # the last one runs over several blocks
    tokens = token_files.tokenized(frame(spark, texts), path, 49_408)
    folder = scratch(spark, "files")
    token_files.write_token_files(tokens, folder, 49_408)
    want, start = {}, 0
    for i, t in enumerate(texts):
        ids = np.array([*tok.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        want[i] = (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in token_files.read_digests(spark, folder).collect()} == want
    parts = token_files.read_fragments(spark, folder).orderBy("at").collect()
    assert len(b"".join(r.ids for r in parts)) == 4 * start


def test_some_documents_from_their_checkpoints(spark):
    path = tokenizer_path("word_bpe_49k.json")
    texts = [*ODD, "long text here. " * 60_000, *[f"text {i} of many words " * (i % 50) for i in range(300)]]
    folder = scratch(spark, "files")
    token_files.write_token_files(token_files.tokenized(frame(spark, texts), path, 49_408), folder, 49_408)
    want, start = {}, 0
    for i, t in enumerate(texts):
        ids = np.frombuffer(encoder(path).encode(t) + b"\x02\0\0\0", "<u4")
        want[i] = (start, ids.tobytes())
        start += len(ids)
    asked = [0, len(ODD), len(ODD) + 7, len(texts) - 1, len(texts) + 5, len(ODD), None]
    wanted = spark.createDataFrame([(i,) for i in asked], "k long")
    got = {r.doc_id: (r.start, bytes(r.ids)) for r in token_files.read_documents(spark, folder, wanted).collect()}
    assert got == {i: want[i] for i in set(asked) if i in want}
    everything = {r.doc_id: (r.start, bytes(r.ids)) for r in token_files.read_documents(spark, folder, frame(spark, texts)).collect()}
    assert everything == want
    assert token_files.read_documents(spark, folder, wanted.limit(0)).count() == 0


def test_reading_starts_at_a_checkpoint():
    ids = np.arange(70_000, dtype=np.uint32) % 997
    coder = token_files.Coder(token_files.quantised(np.bincount(ids)))
    payload, calls = coder.encode(ids), []
    real = coder.decode
    coder.decode = lambda p, first=0, stop=None: calls.append((first, stop)) or real(p, first, stop)
    run = token_files.LANES * token_files.CHECK
    for at, n in ((run + 10, 30), (run - 5, 10), (0, 3), (69_990, 10), (5, 0)):
        assert (coder.some(payload, at, n) == ids[at:at + n]).all()
    assert calls == [(1, 2), (0, 2), (0, 1), (1, 2)]


def test_files_of_nothing_and_of_equal_ids(spark):
    path = tokenizer_path("word_bpe_49k.json")
    for texts, ids in (([], []), (["b", "a", "a", None], [None, 4, 4, None])):
        docs = spark.createDataFrame(list(zip(ids, texts, strict=True)), "doc_id long, text string")
        folder = scratch(spark, "files")
        token_files.write_token_files(token_files.tokenized(docs, path, 49_408), folder, 49_408)
        got = token_files.read_digests(spark, folder).orderBy("start").collect()
        assert [r.doc_id for r in got] == sorted(ids, key=lambda x: (x is not None, x))
        assert [r.start for r in got] == np.cumsum([0, *[r.n_tokens for r in got]])[:-1].tolist()


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 40), max_size=20))
def test_patterns_place_everything_once(counts):
    found = packing.patterns(counts, 64)
    placed = {}
    for packs, pattern in found:
        assert sum(n * k for n, k in pattern) <= 64
        for n, k in pattern:
            placed[n] = placed.get(n, 0) + packs * k
    assert placed == counts
    places, seen = packing.Places(found), set()
    for n, c in counts.items():
        seq, off = places.of(np.full(c, n), np.arange(c))
        for s, o in zip(seq, off, strict=True):
            cells = {(s, x) for x in range(o, o + n)}
            assert o + n <= 64 and not cells & seen
            seen |= cells


def test_packing(spark):
    path = tokenizer_path("word_bpe_49k.json")
    tok = encoder(path).tokenizer
    texts = [*ODD, *["repeat me"] * 300, *[f"word {'again ' * (i % 700)}" for i in range(400)]]
    ids = [np.array([*tok.encode(t or "", add_special_tokens=False).ids, 2], "<u4") for t in texts]
    got = packing.pack(packing.pieces(frame(spark, texts), path, size=1024), 1024).toPandas()
    assert got["length"].sum() == sum(map(len, ids))
    for r in got.itertuples():
        mine = ids[r.doc_id][r.start:r.start + r.length].tobytes()
        assert r.ids == mine and r.crc == zlib.crc32(mine) and r.doc_tokens == len(ids[r.doc_id])
    for _, x in got.sort_values("offset").groupby("sequence_id"):
        assert x.offset.tolist() == np.cumsum([0, *x.length])[:-1].tolist() and x.length.sum() <= 1024
    assert 1 - got["length"].sum() / (1024 * got.sequence_id.nunique()) < 0.02
    assert packing.pack(packing.pieces(frame(spark, []), path)).count() == 0
