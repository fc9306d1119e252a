"""Language of a text by word-first backoff (operator 2).

Training counts words per language over all labelled texts, as Spark groups,
and from them, per length from LONGEST down to 1, character n-grams (of words
with their borders marked). Both are tables that keep every word and n-gram of
every language; ``max_words`` and ``max_grams`` (no bound unless given) keep the
most frequent ones.

A text's words are scored one by one: a known word by its log frequency in each
language, an unseen word by the longest known n-gram at each of its places,
falling back to shorter ones. A language's score is the mean over all words;
``score`` is its share after a softmax with the given sharpness.

Only the HEAD most frequent words go to every task. A text's other words leave
the task as (text, word, times), each distinct one is scored once by joins with
the tables, and its scores are added up per text. Log frequencies are whole
multiples of 1 / SCALE, so sums depend on no order and HEAD changes no result.

Only text is an input of a prediction.

Cases: ``und`` with score 0 where the text is null or has no letter, or where
nothing could be learned; ties go to the first language by code point; words
of any length are read whole; repeated rows get the same result; an empty table
gives an empty result; columns of the input named like an output column, in
any case, are replaced. Rows without a label or text train nothing.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator, Sequence
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadbook.llm.common import written

LONGEST = 4
#: Words held in a task before its partial counts leave it.
HELD = 500_000
#: Words that every task holds; the others are joined.
HEAD = 200_000
#: Fixed: log frequencies are counted in steps of 1 / SCALE.
SCALE = 1 << 30
UNKNOWN = "und"

#: Letters and what else Unicode counts as alphanumeric, without digits.
_WORDS = re.compile(r"[^\W\d_]+").findall


def words(text: str | None) -> list[str]:
    return _WORDS(text.lower()) if text else []


def grams(word: str, n: int) -> list[str]:
    """n-grams of a word with borders; single characters without them."""
    if n == 1:
        return list(word)
    marked = f" {word} "
    return [marked[i:i + n] for i in range(len(marked) - n + 1)]


def _partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Word counts per language, as far as a task has come when it holds HELD words."""
    held: dict[str, Counter] = {}

    def out() -> pa.RecordBatch:
        rows = [(lang, w, n) for lang, c in held.items() for w, n in c.items()]
        cols = list(zip(*rows, strict=True)) or [()] * 3
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.string(), pa.int64()), strict=True)], ["lang", "word", "n"])

    for b in batches:
        for lang, text in zip(b.column("lang").to_pylist(), b.column("text"), strict=True):
            held.setdefault(lang, Counter()).update(words(text.as_py()))
            if sum(map(len, held.values())) > HELD:
                yield out()
                held = {}
    yield out()


def _gram_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """n-gram counts of counted words."""
    for b in batches:
        held: dict[tuple[str, int], dict[str, int]] = {}
        for lang, word, n in zip(*(b.column(c).to_pylist() for c in ("lang", "word", "n")), strict=True):
            for size in range(1, LONGEST + 1):
                of = held.setdefault((lang, size), {})
                for g in grams(word, size):
                    of[g] = of.get(g, 0) + n
        for (lang, size), of in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(of), pa.string()), pa.array([size] * len(of), pa.int32()),
                                              pa.array(list(of), pa.string()), pa.array(list(of.values()), pa.int64())], ["lang", "size", "gram", "n"])


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The LONGEST characters from each place of words with borders, or what is left of them, with their number."""
    for b in batches:
        for at in range(0, len(b), 1024):
            rows = [(word, window, n) for word in b.column("word").slice(at, 1024).to_pylist() for window, n in Counter(_from_each_place(word)).items()]
            cols = list(zip(*rows, strict=True)) or [()] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.string(), pa.int64()), strict=True)], ["word", "window", "times"])


def _from_each_place(word: str) -> list[str]:
    marked = f" {word} "
    return [marked[at:at + LONGEST] for at in range(len(marked))]


def _shares(vector: np.ndarray, total: int, sharpness: float) -> np.ndarray:
    share = np.exp(sharpness * (vector - vector.max()) / SCALE / total)
    return share / share.sum()


class Head:
    """Words that every task holds, kept as Arrow bytes until a worker looks one up."""

    def __init__(self, rows: pa.Table, languages: int):
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, rows.schema) as out:
            out.write_table(rows)
        self.raw, self.languages = sink.getvalue().to_pybytes(), languages

    @cached_property
    def _rows(self) -> pa.Table:
        return pa.ipc.open_stream(self.raw).read_all()

    @cached_property
    def places(self) -> dict[str, int]:
        return {w: i for i, w in enumerate(self._rows.column("word").to_pylist())}

    @cached_property
    def values(self) -> np.ndarray:
        """Values by place and language."""
        flat = self._rows.column("v").combine_chunks().flatten() if len(self._rows) else pa.array([], pa.int64())
        return np.asarray(flat, np.int64).reshape(len(self._rows), self.languages)


class Model:
    """Tables of all words (word, per, n) and n-grams (size, gram, per, n); ``per`` holds counts by language."""

    def __init__(self, langs: list[str], words: DataFrame, grams: DataFrame):
        self.langs, self.words, self.grams = langs, words, grams
        self.rows = [[0.0] * len(langs) for _ in range(LONGEST + 1)]     # per size, 0 for words: what a language's counts are divided by
        each = words.select(F.lit(0).alias("size"), "per").unionByName(grams.select("size", "per"))
        kinds = dict(each.groupBy("size").count().collect())
        for size, lang, n in each.select("size", F.explode("per").alias("lang", "n")).groupBy("size", "lang").agg(F.sum("n")).collect():
            self.rows[size][langs.index(lang)] = float(n)
        # add-half smoothing within a length
        self.rows = [[n + 0.5 * kinds.get(size, 0) for n in row] for size, row in enumerate(self.rows)]

    def values(self, per: Column, size: Column) -> Column:
        """Log frequencies in all languages, as whole numbers."""
        below = F.element_at(F.array(*[F.array(*map(F.lit, row)) for row in self.rows]), (size + 1).cast("int"))
        return F.zip_with(F.array(*map(F.lit, self.langs)), below, lambda lang, d: F.round(
            F.log((F.coalesce(F.try_element_at(per, lang), F.lit(0)) + 0.5) / d) * SCALE).cast("long"))

    def unheard(self) -> list[int]:
        """The value, per language, of a known word that the language lacks."""
        return [round(math.log(0.5 / d) * SCALE) for d in self.rows[0]]

    def head(self, most: int) -> Head:
        """The most frequent words; the driver holds them as Arrow columns only."""
        rows = _most_frequent(self.words, most).select("word", self.values(F.col("per"), F.lit(0)).alias("v")).toArrow()
        return Head(rows, len(self.langs))

    @cached_property
    def _held(self) -> tuple[list[dict], np.ndarray]:
        known = [dict() for _ in range(LONGEST + 1)]    # 0: words, n: n-grams
        values = []
        if self.langs:
            both = self.words.select(F.lit(0).alias("size"), F.col("word").alias("key"), "per").unionByName(self.grams.select("size", F.col("gram").alias("key"), "per"))
            for size, key, v in both.select("size", "key", self.values(F.col("per"), F.col("size"))).toLocalIterator():
                known[size][key] = len(values)
                values.append(v)
        return known, np.array(values, np.int64).reshape(len(values), len(self.langs))

    @property
    def known(self) -> list[dict]:
        """Whole tables on the driver, for single texts (``predict``)."""
        return self._held[0]

    def backed_off(self, word: str) -> list[int]:
        """At each of the word's places, the row of the longest known n-gram that starts there, if any is known."""
        found = []
        for window in _from_each_place(word):
            for n in range(len(window), 0, -1):
                row = self.known[n].get(window[:n])
                if row is not None:
                    found.append(row)
                    break
        return found

    def predict(self, text: str | None, sharpness: float) -> tuple[str, float]:
        """What ``identify`` says, for one text, from tables held on the driver."""
        counts = Counter(words(text))
        if not self.langs or not _lettered(counts):
            return UNKNOWN, 0.0
        known, table = self._held
        vector = np.zeros(len(self.langs), np.int64)
        for w, n in counts.items():
            row = known[0].get(w)
            if row is not None:
                vector += n * table[row]
            elif found := self.backed_off(w):
                # a word counts as often as it stands there, however many n-grams it has
                vector += n * np.floor(table[found].sum(axis=0) / len(found) + 0.5).astype(np.int64)
        best = int(np.argmax(vector))
        return self.langs[best], float(_shares(vector, counts.total(), sharpness)[best])


def _lettered(counts: Counter) -> bool:
    return any(c.isalpha() for w in counts for c in w)


def _most_frequent(counted: DataFrame, most: int) -> DataFrame:
    """Rows with the largest n, at most ``most``; rows that tie with the first one left out are left out too."""
    sizes = counted.groupBy("n").agg(F.count("*").alias("rows"))
    cut = sizes.withColumn("so_far", F.sum("rows").over(Window.orderBy(F.desc("n")))).where(F.col("so_far") <= most).agg(F.min("n")).first()[0]
    return counted.where(F.lit(False) if cut is None else F.col("n") >= cut)


def train(labelled: DataFrame, lang: str = "lang", text: str = "text", max_words: int | None = None, max_grams: int | None = None) -> Model:
    """A model from all rows with a label and a text."""
    rows = labelled.select(F.col(lang).alias("lang"), F.col(text).alias("text")).where("lang is not null and text is not null")
    partial = rows.mapInArrow(_partial, "lang string, word string, n long")
    counted = written(partial.groupBy("lang", "word").agg(F.sum("n").alias("n")), "language-words")
    langs = sorted(r["lang"] for r in counted.select("lang").distinct().collect())    # one row per language
    per = F.map_from_entries(F.collect_list(F.struct("lang", "n"))).alias("per")
    known = written(counted.groupBy("word").agg(per, F.sum("n").alias("n")), "language-vocabulary")
    gram_counts = counted.mapInArrow(_gram_rows, "lang string, size int, gram string, n long").groupBy("lang", "size", "gram").agg(F.sum("n").alias("n"))
    grams = written(gram_counts.groupBy("size", "gram").agg(per, F.sum("n").alias("n")), "language-grams")
    if max_words is not None:
        known = _most_frequent(known, max_words)
    if max_grams is not None:
        first, *more = [_most_frequent(grams.where(F.col("size") == size), max_grams) for size in range(1, LONGEST + 1)]
        for of in more:
            first = first.unionByName(of)
        grams = first
    return Model(langs, known, grams)


def _read(head):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Per text the sums over words that the task holds, and its other words."""
        get, table = head.value.places.get, head.value.values
        for b in batches:
            for at in range(0, len(b), 1024):
                s = b.slice(at, 1024)
                lettered, total, late, sums, late_words, late_times, ends = [], [], [], [], [], [], [0]
                for t in s.column("text"):
                    counts = Counter(words(t.as_py()))
                    rows, times, before = [], [], len(late_words)
                    if _lettered(counts):
                        for w, n in counts.items():
                            row = get(w)
                            if row is None:
                                late_words.append(w)
                                late_times.append(n)
                            else:
                                rows.append(row)
                                times.append(n)
                        lettered.append(True)
                    else:
                        lettered.append(False)
                    total.append(counts.total())
                    late.append(sum(late_times[before:]))
                    sums.append((np.array(times, np.int64) @ table[rows]).tolist() if rows else [0] * table.shape[1])
                    ends.append(len(late_words))
                ends = pa.array(ends, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [s.column("row"), s.column("same"), pa.array(lettered, pa.bool_()), pa.array(total, pa.int64()), pa.array(late, pa.int64()),
                     pa.array(sums, pa.list_(pa.int64())), pa.ListArray.from_arrays(ends, pa.array(late_words, pa.string())),
                     pa.ListArray.from_arrays(ends, pa.array(late_times, pa.int64()))],
                    ["row", "same", "lettered", "total", "late", "sums", "words", "times"])
    return run


def _scores(asked: DataFrame, model: Model) -> DataFrame:
    """(word, by): by (place of a language, value above ``unheard``) for each of the distinct words ``asked``."""
    base = model.unheard()
    looked = written(asked.join(model.words.select("word", "per"), "word", "left"), "language-asked")
    known = looked.where("per is not null").select("word", model.values(F.col("per"), F.lit(0)).alias("v"))

    # the longest known n-gram of each distinct window, then the mean over a word's windows
    windows = written(looked.where("per is null").select("word").mapInArrow(_windows, "word string, window string, times long"), "language-windows")
    starts = windows.select("window").distinct().withColumn("size", F.explode(F.expr("sequence(1, length(window))")))
    found = starts.withColumn("gram", F.expr("left(window, size)")).join(model.grams.select("size", "gram", "per"), ["size", "gram"])
    found = found.groupBy("window").agg(F.max_by("per", "size").alias("per"), F.max("size").alias("size"))
    found = written(found.select("window", model.values(F.col("per"), F.col("size")).alias("v")), "language-backed-off")
    places = range(len(model.langs))
    sums = [F.sum(F.col("v")[i] * F.col("times")).alias(f"v{i}") for i in places]
    of = F.sum(F.when(F.col("v").isNotNull(), F.col("times"))).alias("of")
    unseen = windows.join(found, "window", "left").groupBy("word").agg(*sums, of)
    unseen = unseen.select("word", F.array(*[F.coalesce(F.floor(F.col(f"v{i}") / F.col("of") + 0.5), F.lit(0)).cast("long") for i in places]).alias("v"))
    by = F.transform("v", lambda v, i: F.struct(i.alias("place"), (v - F.array(*map(F.lit, base))[i]).alias("by")))
    return known.unionByName(unseen).select("word", F.filter(by, lambda x: x["by"] != 0).alias("by"))


def identify(docs: DataFrame, model: Model, keep: Sequence[str] | None = None, text: str = "text", sharpness: float = 5.0) -> DataFrame:
    """``keep`` columns (all) of ``docs`` with lang_pred and score."""
    keep = [c for c in (docs.columns if keep is None else keep) if c.lower() not in ("lang_pred", "score")]
    if not model.langs:
        return docs.select(*keep, F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    digest = F.unhex(F.md5(F.coalesce(F.col(text), F.lit(""))))
    head = docs.sparkSession.sparkContext.broadcast(model.head(HEAD))
    texts = docs.select(F.monotonically_increasing_id().alias("row"), digest.alias("same"), F.col(text).alias("text"))
    read = written(texts.mapInArrow(_read(head), "row long, same binary, lettered boolean, total long, late long, sums array<long>, words array<string>, times array<long>"),
                   "language-read")
    head.destroy()      # the texts are read; a retried task of a later job has no use for it

    each = read.select("row", F.explode(F.arrays_zip("words", "times")).alias("w")).select("row", F.col("w.words").alias("word"), F.col("w.times").alias("times"))
    scores = written(_scores(each.select("word").distinct(), model), "language-scores")
    added = each.join(scores, "word").select("row", "times", F.explode("by").alias("x"))
    added = added.groupBy("row", F.col("x.place").alias("place")).agg(F.sum(F.col("times") * F.col("x.by")).alias("by"))
    added = added.groupBy("row").agg(F.map_from_entries(F.collect_list(F.struct("place", "by"))).alias("added"))

    base = F.array(*map(F.lit, model.unheard()))
    vector = F.transform("sums", lambda v, i: v + F.col("late") * base[i] + F.coalesce(F.try_element_at("added", i), F.lit(0)))
    summed = read.select("row", "same", "lettered", "total", "late", "sums").join(added, "row", "left").select("same", "lettered", "total", vector.alias("v"))
    summed = summed.withColumn("best", F.array_max("v"))
    share = 1 / F.aggregate("v", F.lit(0.0), lambda so_far, v: so_far + F.exp((v - F.col("best")) * F.lit(sharpness) / SCALE / F.col("total")))
    first = F.element_at(F.array(*map(F.lit, model.langs)), F.array_position("v", F.col("best")).cast("int"))
    found = summed.select(F.col("same").alias("__same"), F.when(F.col("lettered"), first).otherwise(UNKNOWN).alias("lang_pred"),
                          F.when(F.col("lettered"), share).otherwise(0.0).alias("score"))
    found = written(found.dropDuplicates(["__same"]), "language-found")      # one row per distinct text
    return docs.select(*keep, digest.alias("__same")).join(found, "__same").drop("__same")
