"""Language identification by character models, one per language.

Interpolated Kneser-Ney models (``char_lm``) are counted over every text with
a language outside the held-out ids. A text gets the language of the lowest
cross-entropy per character.

Calibrated rejection: over the training rows that a language gets right, the
mean and spread of the cross-entropy are taken; a text more than
``REJECT`` spreads above its language's mean is marked ``rejected`` (its
language stays the best of the learned ones).

Rows: one per input row. ``und``, score 0 and rejected for null, empty and
letterless texts and where nothing was learned. Null languages teach nothing.
Ties go to the smaller name. Repeated rows are predicted alike; other columns
are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annuity.llm import char_lm
from annuity.llm.common import held_out, read_table, stage

FOLDS, FOLD = 4, 2
UNKNOWN = "und"
REJECT = 6.0
# The score weighs languages by the likelihood of at most so many characters.
SCORED_CHARS = 64


def train(docs: DataFrame) -> char_lm.Model:
    rows = docs.where(~held_out(F.col("doc_id"), FOLDS, FOLD) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    return char_lm.model(char_lm.counted(rows.select(F.col("lang").alias("label"), "text")))


def predict(model: char_lm.Model, texts) -> pd.DataFrame:
    """lang_pred, score and entropy (nats per character) of each text."""
    total, n = np.zeros((len(texts), max(1, len(model.labels)))), np.zeros(len(texts))
    if model.labels:
        for chunk in char_lm.chunks(texts):
            p = model.log_probabilities(chunk.grams)
            # Ends are starts of what lies between segments, which is skipped.
            edges = np.column_stack([chunk.start, chunk.end]).ravel()
            sums = np.add.reduceat(np.vstack([p, np.zeros((1, p.shape[1]), p.dtype)]).astype(np.float64), edges)[::2]
            np.add.at(total, chunk.doc, sums)
            np.add.at(n, chunk.doc, chunk.end - chunk.start)
    entropy = -total / np.maximum(n, 1)[:, None]
    best = entropy.argmin(axis=1)
    at = np.arange(len(texts))
    gap = (entropy - entropy[at, best][:, None]) * np.minimum(n, SCORED_CHARS)[:, None]
    score = 1 / np.exp(-gap).sum(axis=1)
    known = n > 0
    names = np.array([*model.labels, UNKNOWN], object)
    return pd.DataFrame({"lang_pred": names[np.where(known, best, -1)], "score": np.where(known, score, 0.0),
                         "entropy": np.where(known, entropy[at, best], np.nan)})


def identified(docs: DataFrame) -> DataFrame:
    """(doc_id, lang, lang_pred, score, entropy, rejected) of every row."""
    known = char_lm.applied(docs.select("doc_id", "lang", "text"), train(docs), predict, "lang_pred string, score double, entropy double", "p")
    rows = stage(known.select("doc_id", "lang", "p.*"), "languages")
    right = rows.where(~held_out(F.col("doc_id"), FOLDS, FOLD) & (F.col("lang") == F.col("lang_pred"))
                       & ~F.isnan("entropy"))
    # One row per learned language.
    limits = right.groupBy(F.col("lang").alias("_lang")).agg(
        (F.mean("entropy") + REJECT * F.coalesce(F.stddev_pop("entropy"), F.lit(0.0))).alias("_limit"))
    return rows.join(limits, F.col("lang_pred") == F.col("_lang"), "left").select(
        *rows.columns, F.coalesce(F.col("entropy") > F.col("_limit"), F.lit(True)).alias("rejected"))


def op9(docs: DataFrame) -> DataFrame:
    return identified(docs).select("doc_id", held_out(F.col("doc_id"), FOLDS, FOLD).alias("held_out"),
                                   "lang_pred", "score", "rejected")


def op9_table(spark, sf_dir: str) -> DataFrame:
    return op9(read_table(spark, sf_dir, "documents"))
