"""Secret spans against Python's regular expressions, and the battery's verdicts."""

import base64
import hashlib
import random
import re
import string

from pyspark.sql import functions as F

from roadbook.llm import secret_scan
from roadbook.llm.common import importable

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def base(text):
    text = text or ""
    spans = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    spans += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    spans += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(spans)


def frame(spark, texts):
    importable(spark)
    return spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, spans string")


def texts():
    rng = random.Random(4)
    hexes = lambda n: "".join(rng.choice("0123456789abcdef") for _ in range(n))
    b64 = [base64.b64encode(rng.randbytes(48)).decode() for _ in range(40)]
    out = [None, "", " ", "token=abc password=abcdefgh", "token=token:abcdefg", "TOKEN: secret=abcdefgh", "api_key='zzzzzz' apikey:1",
           "Token : \"é" + hexes(30), f"é🙂 {hexes(24)}, {hexes(23)} {hexes(64)}", "AKIA" + "A1" * 8 + " AKIAAKIA" + "X" * 11 + "AKIAB" + "X" * 16,
           "password:" + hexes(40), "PASSWD=İK" + "x" * 9, f"token={hexes(5)} " * 700, "secret" * 50 + "=" + "a" * 50, "a" * 5000]
    words = [f"{b} plain words before and after" for b in b64]
    clean = ["the_configuration_of_the_second_server_2024_final_version", "https/www/example/com/docs/2024/some-long-page-name",
             "a1" * 30, "0123456789abcdefghijklmnopqrstuvwxyz", "abcabcabc1" * 12, "1" * 40, "Donaudampfschifffahrtsgesellschaft2"] * 3
    return out, words, clean


def test_spans(spark):
    out, words, clean = texts()
    all_texts = [*out, *words, *clean]
    got = secret_scan.scan(frame(spark, all_texts), ["doc_id", "text"]).withColumn(
        "listed", secret_scan.listed(F.filter("spans", lambda s: s["place"] < 3))).withColumn("masked", secret_scan.redacted(F.col("text"), F.col("spans"))).collect()
    assert len(got) == len(all_texts)
    caught = 0
    for r in got:
        text = all_texts[r.doc_id]
        want = base(text)
        assert r.listed == ",".join(f"{k}:{a}:{b}" for a, _, b, k in want), text
        assert hashlib.sha256(r.listed.encode()).hexdigest()
        spans = [(s.start, s.place, s.end, s.kind) for s in r.spans]
        assert spans == sorted(spans) and set(want) <= set(spans)
        at, parts = 0, []
        for a, _, b, _ in spans:
            if a >= at:
                parts += [text[at:a], "[secret]"]
            at = max(at, b)
        assert r.masked == ("".join(parts) + text[at:] if spans else text)
        drawn = [s for s in spans if s[3] == "random"]
        if len(out) <= r.doc_id < len(out) + len(words):
            caught += drawn == [(0, 3, 64, "random")]
        else:
            assert not drawn, text
    assert caught >= 38     # the battery lets go of one in a thousand, the discovery level of few


def test_no_candidates_and_empty_table(spark):
    assert secret_scan.scan(frame(spark, [])).count() == 0
    got = secret_scan.scan(frame(spark, ["plain", None])).collect()
    assert [len(r.spans) for r in got] == [0, 0] and {r.text for r in got} == {"plain", None}


def test_p_values_are_uniform_for_random_runs(spark):
    """Under a uniform draw the battery's p-values reject about as often as they say."""
    rng = random.Random(9)
    runs = ["".join(rng.choice(string.ascii_letters + string.digits) for _ in range(64)) for _ in range(400)]
    found = secret_scan.scanned(frame(spark, [f"x1 {r}" for r in runs]), ["doc_id"])
    b = [r.battery for row in found.collect() for r in row["__runs"]]
    assert len(b) == 400 and 0.01 < sum(x < 0.15 for x in b) / 400 < 0.2
