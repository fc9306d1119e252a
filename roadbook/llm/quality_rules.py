"""Quality rules as a learned decision list (operator 10).

Fixed statistics of each text are computed once (``statistics``). From labelled
rows a decision list is learned by sequential covering: while uncovered bad
rows remain, a conjunction of threshold conditions is grown on two thirds of
the rows by FOIL's information gain, pruned on the last third by the value
(p - n) / (p + n), and kept if it is precise enough there; the rows that it
covers leave. The list is ordered and becomes one conditional Spark expression
over the statistics, so judging rows needs no Python.

The list is fitted on at most MAX_LABELLED labelled rows (those with the least
hash of their id; the bound is a parameter). All else covers all rows.

Cases: null and empty texts have statistics 0 and fail the base rules; a table
without labels gives an empty list, which keeps what the base rules keep;
repeated label rows count once per row; texts of any length are read whole;
an empty table gives an empty result; columns of the input named like an output
column are replaced.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadbook.llm.common import least_hashed, written

WINDOW = 8
#: Fixed: least number of words, and the most that may lie in repeated windows, per hundred.
LEAST_WORDS, MOST_REPEATED = 20, 30
MAX_LABELLED, MAX_RULES, MAX_CONDITIONS, LEAST_PRECISION, CUTS = 50_000, 12, 4, 0.8, 32

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Statistics that rules may test, all free of the text's length.
FEATURES = ("symbols_per_word", "dup_line_share", "repeat_share", "chars_per_word", "digit_share", "upper_share",
            "mark_share", "distinct_share", "words_per_line", "log_words")
_SYMBOLS = re.compile(r"[#*$%&|<>]").findall


def repeated(words: list[bytes], size: int = WINDOW) -> int:
    """Words that lie in a window of ``size`` words found twice or more."""
    n = len(words) - size + 1
    if n < 2:
        return 0
    ids: dict[bytes, int] = {}
    which = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, len(words))
    # exact window numbers by doubling: pairs of windows of half the size get a number of their own
    width, names = 1, which
    while width * 2 <= size:
        names = np.unique(names[:-width] * (names.max() + 1) + names[width:], return_inverse=True)[1]
        if names.max() + 1 == len(names):
            return 0                # no window of this width comes twice
        width *= 2
    if width < size:
        rest = size - width
        names = np.unique(names[:n] * (names.max() + 1) + names[rest:rest + n], return_inverse=True)[1]
    again = np.flatnonzero(np.bincount(names)[names] > 1)
    edges = np.zeros(len(words) + 1, np.int64)
    np.add.at(edges, again, 1)
    np.add.at(edges, again + size, -1)
    return int((np.cumsum(edges[:-1]) > 0).sum())


def measured(text: str | None) -> tuple:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, *FEATURES)."""
    text = text or ""
    words = text.encode().split()           # bytes.split() cuts at the six ASCII white-space characters
    n = len(words)
    spaces = sum(map(text.count, " \t\n\r\x0b\x0c"))
    chars = len(text) - spaces
    symbols = len(_SYMBOLS(text))
    lines = Counter(line for line in text.split("\n") if line.strip(" \t\r\x0b\x0c"))
    n_lines = lines.total()
    dup = n_lines - len(lines)
    again = repeated(words)
    digits, upper = (sum(map(text.count, "0123456789")), sum(map(text.count, "ABCDEFGHIJKLMNOPQRSTUVWXYZ")))
    marks = sum(map(text.count, ".,;:!?\"'()[]{}-_/\\@#*$%&|<>+=~^`"))
    per, of = max(n, 1), max(chars, 1)
    return (n, chars, symbols, dup, again, symbols / per, dup / max(n_lines, 1), again / per, chars / per, digits / of, upper / of,
            marks / of, len(set(words)) / per, n / max(n_lines, 1), float(np.log1p(n)))


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        kept = [c for c in b.schema.names if c != "__text"]
        found = [measured(t.as_py()) for t in b.column("__text")]
        cols = list(zip(*found, strict=True)) or [()] * (len(BASE) + len(FEATURES))
        kinds = [pa.int64()] * len(BASE) + [pa.float64()] * len(FEATURES)
        yield pa.RecordBatch.from_arrays([*(b.column(c) for c in kept), *(pa.array(c, t) for c, t in zip(cols, kinds, strict=True))],
                                         [*kept, *BASE, *FEATURES])


def statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without the text, with BASE, FEATURES and base_failed; written once."""
    docs = docs.withColumn("__text", F.col(text))
    kept = docs.drop(text, "__text", *BASE, *FEATURES, "base_failed")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields)
    out = ", ".join([schema, *(f"{c} long" for c in BASE), *(f"{c} double" for c in FEATURES)])
    found = docs.select(*kept.columns, "__text").mapInArrow(_measure, out)
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    return written(found.withColumn("base_failed", failed), "text-statistics")


# ---- learning --------------------------------------------------------------

Condition = tuple[str, str, float]       # feature, "<=" or ">", threshold


def _meets(x: dict[str, np.ndarray], rule: list[Condition], of: np.ndarray) -> np.ndarray:
    for feature, side, cut in rule:
        of = of & ((x[feature] <= cut) if side == "<=" else (x[feature] > cut))
    return of


def _grown(x: dict[str, np.ndarray], bad: np.ndarray, of: np.ndarray) -> list[Condition]:
    rule: list[Condition] = []
    while len(rule) < MAX_CONDITIONS and (of & ~bad).any():
        p0, n0 = int((of & bad).sum()), int((of & ~bad).sum())
        best = (1e-9, None)
        for feature, v in x.items():
            for cut in np.unique(np.quantile(v[of], np.linspace(0, 1, CUTS + 1), method="lower")):
                for side in ("<=", ">"):
                    m = of & ((v <= cut) if side == "<=" else (v > cut))
                    p = int((m & bad).sum())
                    if p and p < p0 + n0:
                        gain = p * (np.log2(p / m.sum()) - np.log2(p0 / (p0 + n0)))
                        if gain > best[0]:
                            best = (gain, (feature, side, float(cut)))
        if best[1] is None:
            break
        rule.append(best[1])
        of = _meets(x, rule[-1:], of)
    return rule


def learned(x: dict[str, np.ndarray], bad: np.ndarray, grow: np.ndarray) -> list[list[Condition]]:
    """Ordered rules for ``bad``; ``grow`` marks the rows that rules grow on, the others prune them."""
    rules: list[list[Condition]] = []
    left = np.ones(len(bad), bool)
    while len(rules) < MAX_RULES and (left & grow & bad).any():
        rule = _grown(x, bad, left & grow)

        def value(r: list[Condition], of: np.ndarray = left & ~grow) -> float:
            m = _meets(x, r, of)
            p = int((m & bad).sum())
            return (2 * p - int(m.sum())) / m.sum() if m.any() else -1.0

        rule = max((rule[:k] for k in range(len(rule), 0, -1)), key=value, default=[])   # ties: the longer one
        # Laplace's precision on the pruning rows, which the rule hasn't been grown on
        m = _meets(x, rule, left & ~grow)
        if not rule or ((m & bad).sum() + 1) / (m.sum() + 2) < LEAST_PRECISION:
            break
        rules.append(rule)
        left &= ~_meets(x, rule, left)
    return rules


def learn(stats: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "quality",
          max_labelled: int = MAX_LABELLED) -> list[list[Condition]]:
    """Rules for label 0 from rows of ``stats`` with a label, at most ``max_labelled`` of them."""
    few = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull()).select(F.col(key).alias("__key"), F.col(label).alias("__label"))
    rows = stats.join(few, F.col(key) == F.col("__key")).select("__key", "__label", *FEATURES)
    rows = least_hashed(rows, max_labelled, "__key", "__label").toPandas()
    third = np.array([zlib.crc32(str(k).encode()) % 3 == 2 for k in rows["__key"]], bool)
    return learned({f: rows[f].to_numpy() for f in FEATURES}, (rows["__label"] == 0).to_numpy(), ~third)


def fired(rules: list[list[Condition]]) -> Column:
    """1-based number of the first rule that holds, or null: one conditional expression."""
    out = F.lit(None).cast("int")
    for k in range(len(rules), 0, -1):
        holds = F.lit(True)
        for feature, side, cut in rules[k - 1]:
            holds = holds & ((F.col(feature) <= cut) if side == "<=" else (F.col(feature) > cut))
        out = F.when(holds, F.lit(k)).otherwise(out)
    return out


def judged(stats: DataFrame, rules: list[list[Condition]]) -> DataFrame:
    """``stats`` with rule (null if none fired) and kept."""
    return stats.withColumn("rule", fired(rules)).withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())
