"""Quality classifier with hierarchical empirical Bayes (operator 7).

1. Evidence of the document: a logistic regression over quantile bins of the
   text's statistics, fitted on at most MAX_LABELLED labelled rows (those with
   the least hash of their id; the bound is a parameter).
2. Sites: every document adds its label, or its classifier's probability where
   it has none, to its host and to its path on the host, as grouped sums over
   all rows. A host's rate is shrunk toward the global rate and a path's rate
   toward its host's, by Beta priors whose strengths are estimated from the
   spread of the rates (method of moments). A sparse site so stays near its
   parent.
3. A document's probability combines the odds of its path, taken without the
   document itself, with its own evidence (the classifier's odds against the
   global odds).

Cases: null and empty texts have the statistics of an empty text; a null host
or path is a site like any other; without labels all probabilities are 0.5 and
all rows are kept; a document labelled more than once has its mean label, null
labels count as none; repeated rows count each; an empty table gives an empty
result; columns of the input named like an output column are replaced.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadbook.llm.common import least_hashed, written
from roadbook.llm.quality_rules import FEATURES, statistics

MAX_LABELLED, BINS, RIDGE, ROUNDS = 50_000, 16, 1.0, 25
#: Probabilities are kept inside this distance from 0 and 1, so that no single source of evidence decides alone.
EDGE = 1e-4


class Classifier:
    """Logistic regression over quantile bins."""

    def __init__(self, cuts: dict[str, np.ndarray], weights: np.ndarray):
        self.cuts, self.weights = cuts, weights

    @staticmethod
    def rows(x: pd.DataFrame, cuts: dict[str, np.ndarray]) -> np.ndarray:
        parts = [np.ones((len(x), 1))]
        for f, c in cuts.items():
            parts.append(np.eye(len(c) + 1)[np.searchsorted(c, x[f].to_numpy(), side="left")])
        return np.hstack(parts)

    @classmethod
    def fit(cls, x: pd.DataFrame, good: np.ndarray) -> Classifier:
        cuts = {f: np.unique(np.quantile(x[f], np.linspace(0, 1, BINS + 1)[1:-1], method="lower")) for f in FEATURES}
        a = cls.rows(x, cuts)
        w = np.zeros(a.shape[1])
        ridge = np.full(len(w), RIDGE)
        ridge[0] = 1e-6
        for _ in range(ROUNDS):      # Newton's rounds
            p = 1 / (1 + np.exp(-a @ w))
            step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + np.diag(ridge), a.T @ (good - p) - ridge * w)
            w += step
            if np.abs(step).max() < 1e-8:
                break
        return cls(cuts, w)

    def predict(self, x: pd.DataFrame) -> np.ndarray:
        return 1 / (1 + np.exp(-self.rows(x, self.cuts) @ self.weights))


def logit(p: Column) -> Column:
    p = F.greatest(F.lit(EDGE), F.least(F.lit(1 - EDGE), p))
    return F.log(p / (1 - p))


def strength(rates: DataFrame, rate: Column, centre: Column, n: Column) -> float:
    """Strength of the Beta prior that explains how far ``rate`` lies from ``centre`` over sites of ``n`` documents."""
    row = rates.agg(F.sum(n).alias("n"), F.sum(n * (rate - centre) * (rate - centre)).alias("spread"),
                    F.sum(centre * (1 - centre)).alias("noise"), F.sum(n * centre * (1 - centre)).alias("level")).first()
    if not row["n"]:
        return 1.0
    between = (row["spread"] - row["noise"]) / row["n"]      # what sampling alone doesn't explain
    level = row["level"] / row["n"]
    return float(min(1e6, max(1.0, level / between - 1))) if between > 0 else 1e6


def classify(docs: DataFrame, labels: DataFrame, host: Column, path: Column, doc_id: str = "doc_id", text: str = "text",
             label: str = "quality", max_labelled: int = MAX_LABELLED) -> DataFrame:
    """doc_id, p_text, host_rate, path_rate, p_quality and kept (p_quality of 0.5 or more), one row per row of ``docs``."""
    light = docs.select(F.col(doc_id).alias("doc_id"), host.cast("string").alias("host"), path.cast("string").alias("path"), F.col(text).alias("text"))
    known = labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull())
    known = known.groupBy(F.col(doc_id).alias("__key")).agg(F.avg(F.col(label).cast("double")).alias("__label"))
    stats = statistics(light).join(known, F.col("doc_id") == F.col("__key"), "left").drop("__key")
    stats = written(stats.select("doc_id", "host", "path", "__label", *FEATURES), "quality-evidence")
    few = least_hashed(stats.where(F.col("__label").isNotNull()), max_labelled, "doc_id").toPandas()
    if few.empty:
        half = [F.lit(0.5).alias(c) for c in ("p_text", "host_rate", "path_rate", "p_quality")]
        return stats.select("doc_id", *half, F.lit(True).alias("kept"))
    model = Classifier.fit(few[list(FEATURES)], few["__label"].to_numpy())

    @F.pandas_udf("double")
    def p_text(*columns: pd.Series) -> pd.Series:
        return pd.Series(model.predict(pd.DataFrame(dict(zip(FEATURES, columns, strict=True)))))

    judged = stats.select("doc_id", "host", "path", "__label", p_text(*FEATURES).alias("p_text"))
    judged = written(judged.withColumn("good", F.coalesce("__label", "p_text")), "quality-text")

    paths = written(judged.groupBy("host", "path").agg(F.sum("good").alias("path_good"), F.count("*").alias("path_n")), "quality-paths")
    hosts = written(paths.groupBy("host").agg(F.sum("path_good").alias("host_good"), F.sum("path_n").alias("host_n")), "quality-hosts")
    total = hosts.agg(F.sum("host_good").alias("good"), F.sum("host_n").alias("n")).first()
    overall = F.lit(min(1 - EDGE, max(EDGE, total["good"] / total["n"])))
    k_host = strength(hosts, F.col("host_good") / F.col("host_n"), overall, F.col("host_n"))
    rated = hosts.withColumn("centre", (F.col("host_good") + k_host * overall) / (F.col("host_n") + k_host))
    both = paths.withColumnRenamed("host", "of").join(rated, F.col("of").eqNullSafe(F.col("host"))).drop("of")
    k_path = strength(both, F.col("path_good") / F.col("path_n"), F.col("centre"), F.col("path_n"))

    sites = both.select(F.col("host").alias("__host"), F.col("path").alias("__path"), "path_good", "path_n", "host_good", "host_n")
    out = judged.join(sites, F.col("host").eqNullSafe(F.col("__host")) & F.col("path").eqNullSafe(F.col("__path")))
    out = out.withColumn("host_rate", (F.col("host_good") - F.col("good") + k_host * overall) / (F.col("host_n") - 1 + k_host))
    out = out.withColumn("path_rate", (F.col("path_good") - F.col("good") + k_path * F.col("host_rate")) / (F.col("path_n") - 1 + k_path))
    odds = logit(F.col("path_rate")) + logit(F.col("p_text")) - logit(overall)
    out = out.withColumn("p_quality", 1 / (1 + F.exp(-odds)))
    return out.select("doc_id", "p_text", "host_rate", "path_rate", "p_quality", (F.col("p_quality") >= 0.5).alias("kept"))
