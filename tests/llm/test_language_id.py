"""Language identification: held-out accuracy, backing off, edges."""

import random

from roadbook.llm import language_id
from roadbook.llm.common import importable

SYLLABLES = {"xx": ["ka", "mo", "ri", "ten"], "yy": ["lou", "vée", "ché", "ain"], "zz": ["schu", "berg", "öl", "ung"]}


def word(lang, rng):
    return "".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randrange(1, 5)))


def corpus(n=300, seed=1):
    rng = random.Random(seed)
    return [(i, " ".join(word(lang, rng) for _ in range(30)), lang) for i in range(n) for lang in [rng.choice("xyz") * 2]]


def frame(spark, rows):
    importable(spark)
    return spark.createDataFrame([(*r, "mine", 0.5) for r in rows], "doc_id long, text string, lang string, word string, n double")


def test_held_out_accuracy(spark):
    model = language_id.train(frame(spark, corpus()))
    other = corpus(120, 2)
    got = language_id.identify(frame(spark, other), model).collect()
    assert [r.lang_pred for r in sorted(got)] == [lang for _, _, lang in other]
    assert all(0 <= r.score <= 1 for r in got) and got[0].word == "mine"


def test_words_first_then_grams(spark):
    rows = [(1, "abcd abcd", "xx"), (2, "wxyz wxyz", "yy")]
    model = language_id.train(frame(spark, rows))
    assert model.predict("abcd", 5.0)[0] == "xx"
    assert model.predict("wxyzzz", 5.0)[0] == "yy"       # unseen: by its n-grams
    assert model.predict("bc", 5.0)[0] == "xx"
    assert model.backed_off("日本") == [] and model.predict("日本", 5.0)[0] == "xx"     # a tie: the first by code point
    small = language_id.train(frame(spark, corpus()), max_words=5, max_grams=50)
    assert len(small.known[0]) <= 5 and all(len(k) <= 50 for k in small.known)
    assert small.predict(corpus(1, 7)[0][1], 5.0)[0] == corpus(1, 7)[0][2]


def test_counts_are_those_of_all_rows(spark, monkeypatch):
    monkeypatch.setattr(language_id, "HELD", 10)         # partial counts leave a task many times
    rows = corpus(40)
    model = language_id.train(frame(spark, rows))
    assert set(model.known[0]) == {w for _, t, _ in rows for w in language_id.words(t)}


def test_edges(spark):
    model = language_id.train(frame(spark, [*corpus(30), (99, None, "xx"), (98, "kamo", None)]))
    rows = [(1, None, "xx"), (2, "", None), (3, "123 -- 4", None), (4, "ka" * 30_000, None), (4, "ka" * 30_000, None)]
    got = sorted(language_id.identify(frame(spark, rows), model, ["doc_id"]).collect())
    assert [(r.lang_pred, r.score) for r in got[:3]] == [("und", 0.0)] * 3
    assert [r.lang_pred for r in got[3:]] == ["xx", "xx"]
    assert language_id.identify(frame(spark, []), model).count() == 0
    empty = language_id.train(frame(spark, []))
    assert empty.predict("words", 5.0) == ("und", 0.0)


def test_no_word_is_cut_by_another_languages_counts(spark):
    """60,000 words that the large language repeats don't displace words that the small one has once."""
    rng = random.Random(4)
    large = " ".join(sorted({"".join(rng.choices("abcdefgh", k=9)) for _ in range(60_000)}))
    rows = [(1, large, "en"), (2, large, "en"), (3, "abcdefgh hgfedcba", "xx")]
    model = language_id.train(frame(spark, rows))
    assert len(model.known[0]) == len(large.split()) + 2 and {"abcdefgh", "hgfedcba"} <= set(model.known[0])
    asked = [(1, "hgfedcba", None), (2, "abcdefgh abcdefgh", None), (3, large[:2000], None)]
    assert [r.lang_pred for r in sorted(language_id.identify(frame(spark, asked), model, ["doc_id"]).collect())] == ["xx", "xx", "en"]


def test_joined_words_score_as_held_ones(spark, monkeypatch):
    """Whatever the tasks hold, all texts get what one text gets by itself."""
    model = language_id.train(frame(spark, corpus(60)))
    rows = [*corpus(40, 3), (90, "kaka unknownword 日本 x½ " * 3, None), (91, "日本", None), (92, "½", None), (93, None, None), (94, "k" * 5000 + " moka", None)]
    want = {i: model.predict(t, 5.0) for i, t, _ in rows}
    for most in (50_000, 7, 0):
        monkeypatch.setattr(language_id, "HEAD", most)
        got = language_id.identify(frame(spark, rows + rows), model, ["doc_id"]).collect()
        assert len(got) == 2 * len(rows)
        for r in got:
            assert r.lang_pred == want[r.doc_id][0] and abs(r.score - want[r.doc_id][1]) < 1e-6, r
