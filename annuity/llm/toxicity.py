"""Toxicity by class-conditional Kneser-Ney models.

Two character models, of toxic and of ordinary labelled texts, share the
counts they back off to, so an expression that neither class has seen weighs
alike in both. What is compared is the length-normalised log-likelihood ratio of the two, over
the whole text and where it is highest: its mean over the whole text, over the best ``WINDOWS``
characters in a row (of a shorter text: its sum over the window), and the logarithm of the
length, as a longer text has a higher best window by chance. A short window finds one
insult among thousands of words, a longer one an expression of ordinary words, the mean a toxic tone.

A logistic curve over these turns them into a score. It is fitted on the labelled
rows of a quarter of the ids, which the models have not seen (at most ``MAX_CALIBRATION`` rows, the lowest
by a hash); two made-up observations (``PRIOR``) keep it defined when a class has no such rows.

Rows: one per input row. Null, empty and letterless texts measure 0 in all. An
id with several labels counts as toxic if one says so; null labels are left
out. Repeated rows are scored alike. Other columns are ignored or kept, as
said. With no labels at all everything measures 0; an empty table gives
an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annuity.llm import char_lm
from annuity.llm.common import held_out, read_table

FOLDS, FOLD = 5, 0
CALIBRATION = 4
MAX_CALIBRATION = 20_000
WINDOWS = (8, 32)
THRESHOLD = 0.5
# (best windows, mean and log length, toxic) seen besides the calibration rows.
PRIOR = [((0.5, 0.2, 0.0, 5.0), 0), ((3.0, 1.2, 0.5, 5.0), 1)]
# Weights are drawn towards 0 by so much a row: labels hold errors, which four numbers could follow.
RIDGE = 0.02


def labels_of(labels: DataFrame, column: str) -> DataFrame:
    """One (doc_id, label) per labelled id."""
    return (labels.where(F.col(column).isNotNull() & F.col("doc_id").isNotNull())
            .groupBy("doc_id").agg(F.max(column).alias("label")))


def _calibrates(doc_id):
    text = F.concat(F.lit("calibration:"), doc_id.cast("string"))
    return F.crc32(text.cast("binary")) % CALIBRATION == 0


def train(docs: DataFrame, labels: DataFrame) -> char_lm.Model:
    """The two models, over all labelled texts outside the held-out and calibration ids."""
    learn = ~held_out(F.col("doc_id"), FOLDS, FOLD) & ~_calibrates(F.col("doc_id"))
    marked = (labels_of(labels, "toxic").where(learn)
              .select(F.col("doc_id").alias("_id"), F.when(F.col("label") == 1, "toxic").otherwise("ordinary").alias("label")))
    rows = docs.select("doc_id", "text").where(learn & F.col("text").isNotNull())
    # The same join at every size: both sides are dealt by id, texts are not sorted.
    rows = rows.join(marked.hint("shuffle_hash"), F.col("doc_id") == F.col("_id"))
    return char_lm.model(char_lm.counted(rows), shared=True)


def features(model: char_lm.Model, texts) -> np.ndarray:
    """Per text: the best mean of each window, the whole mean, and the logarithm of one more than its characters."""
    best = np.full((len(texts), len(WINDOWS)), -np.inf)
    total, n = np.zeros(len(texts)), np.zeros(len(texts))
    if sorted(model.labels) != ["ordinary", "toxic"]:
        return np.zeros((len(texts), len(WINDOWS) + 2))
    toxic = model.labels.index("toxic")
    for chunk in char_lm.chunks(texts, overlap=max(WINDOWS) - 1):
        p = model.log_probabilities(chunk.grams)
        ratio = np.r_[0.0, np.cumsum(p[:, toxic] - p[:, 1 - toxic], dtype=np.float64)]
        end = np.repeat(chunk.end, np.diff(np.r_[chunk.start, len(chunk.grams)]))
        at = np.arange(len(chunk.grams))
        for k, window in enumerate(WINDOWS):
            # Whole windows; of a text shorter than one, all of it.
            whole = at + window <= end
            whole[chunk.start] = True
            sums = np.where(whole, ratio[np.minimum(at + window, end)] - ratio[at], -np.inf)
            np.maximum.at(best[:, k], chunk.doc, np.maximum.reduceat(sums, chunk.start) / window)
        # What segments of a long text share counts once.
        np.add.at(total, chunk.doc, ratio[chunk.start + chunk.own] - ratio[chunk.start])
        np.add.at(n, chunk.doc, chunk.own)
    out = np.column_stack([best, total / np.maximum(n, 1), np.log1p(n)])
    out[n == 0] = 0.0
    return out


def measured(docs: DataFrame, model: char_lm.Model, name: str) -> DataFrame:
    """``docs`` with the features as an array; every other column stays."""
    return char_lm.applied(docs, model, lambda own, texts: pd.Series(list(features(own, texts))), "array<double>", name)


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = RIDGE) -> np.ndarray:
    """Weights of the columns of ``x`` and the intercept, by Newton's method on standardised columns."""
    ridge *= len(x)
    mean, spread = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-6)
    z = np.column_stack([(x - mean) / spread, np.ones(len(x))])
    w = np.zeros(z.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + ridge * np.eye(len(w)), z.T @ (p - y) + ridge * w)
        step *= min(1.0, 5.0 / max(np.abs(step).max(), 1e-9))
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return np.append(w[:-1] / spread, w[-1] - (w[:-1] * mean / spread).sum())


def calibrate(docs: DataFrame, labels: DataFrame, model: char_lm.Model) -> np.ndarray:
    """Fit the curve on the labelled calibration rows."""
    marked = labels_of(labels, "toxic").select(F.col("doc_id").alias("_id"), "label")
    own = docs.select("doc_id", "text").where(_calibrates(F.col("doc_id")) & ~held_out(F.col("doc_id"), FOLDS, FOLD))
    own = own.join(marked.hint("shuffle_hash"), F.col("doc_id") == F.col("_id")).select("doc_id", "text", "label")
    turn = [F.xxhash64("doc_id", "text"), F.col("doc_id"), F.col("label")]
    seen = measured(own, model, "x").select(*[c.alias(f"_{k}") for k, c in enumerate(turn)], "x", "label")
    rows = seen.orderBy("_0", "_1", "_2").limit(MAX_CALIBRATION).select("x", "label").collect()
    points = [(r["x"], int(r["label"] == 1)) for r in rows] + PRIOR
    x, y = np.array([x for x, _ in points]), np.array([y for _, y in points], float)
    weights = logistic(x, y)
    # Length makes up for chance; it is no mark of toxicity, also where toxic texts are the longer ones.
    return weights if weights[-2] <= 0 else np.insert(logistic(x[:, :-1], y), x.shape[1] - 1, 0.0)


def scored(docs: DataFrame, labels: DataFrame, name: str = "score", measure_name: str = "measure") -> DataFrame:
    """``docs`` with the measure (log-odds of being toxic) and the score; every other column stays."""
    model = train(docs, labels)
    *weights, intercept = calibrate(docs, labels, model).tolist()
    rows = measured(docs, model, measure_name)
    odds = sum((F.lit(w) * F.get(measure_name, F.lit(k)) for k, w in enumerate(weights)), F.lit(intercept))
    return rows.withColumn(measure_name, odds).withColumn(name, 1 / (1 + F.exp(-F.col(measure_name))))


def op8(spark, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = scored(docs, read_table(spark, sf_dir, "labels"))
    return rows.select("doc_id", held_out(F.col("doc_id"), FOLDS, FOLD).alias("held_out"), "score",
                       (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "measure")
