"""Quality by hashed word n-gram logistic regression.

Features: one- and two-word n-grams over lower-cased words and over word shapes
(runs of upper-case, lower-case and digits each as one mark, other characters
as they are); a two-word n-gram of a word repeated is hashed by its shape and
the repetition. All are hashed into 2^``FEATURE_BITS`` weights; values are
log(1 + count), scaled to length one per text.

Training: follow-the-regularised-leader updates, one text at a time, over at
most ``MAX_TRAIN`` distinct labelled texts outside the held-out ids (of the
``MAX_TRAIN`` ids of lowest hash, the pairs of id and text of lowest hash),
``EPOCHS`` times over. One task streams over their sparse features, so its
memory is bounded by the weights. Scoring: sparse dot products over whole texts.

Rows: one per input row. Null and empty texts have no feature but the bias.
An id with several labels counts as good if one says so; null labels are left
out. Repeated rows are learned from once and scored alike. With no labels all scores are 0.5. An
empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annuity.llm.common import held_out, read_table

FOLDS, FOLD = 5, 0
THRESHOLD = 0.3
FEATURE_BITS = 18
MAX_TRAIN = 6000
EPOCHS = 3
ALPHA, BETA, L1, L2 = 2.0, 1.0, 1e-4, 1e-4
WORDS_AT_ONCE = 1 << 17

_MARKS = bytes(ord("X") if 65 <= b <= 90 else ord("x") if 97 <= b <= 122 or b >= 128 else
               ord("9") if 48 <= b <= 57 else b for b in range(256))
_RUN = re.compile(rb"X{2,}|x{2,}|9{2,}")
_SHORT = {ord("X"): b"XX", ord("x"): b"xx", ord("9"): b"99"}


def _hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(zlib.crc32, words), np.uint32, len(words)).astype(np.uint64)


def _mix(a: np.ndarray, b: np.ndarray, kind: int) -> np.ndarray:
    x = (a * np.uint64(0x9E3779B97F4A7C15) + b + np.uint64(kind)) * np.uint64(0xBF58476D1CE4E5B9)
    return (x >> np.uint64(64 - FEATURE_BITS)).astype(np.int64)


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """(feature numbers, values), the bias first."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.lower().split()
    shapes = _RUN.sub(lambda m: _SHORT[m[0][0]], raw.translate(_MARKS)).split()
    found, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for begin in range(0, len(words), WORDS_AT_ONCE):
        part = slice(begin, begin + WORDS_AT_ONCE + 1)  # one more word, for the n-gram across
        w, s = _hashes(words[part]), _hashes(shapes[part])
        own, zero = slice(0, min(WORDS_AT_ONCE, len(w))), np.uint64(0)
        same = w[1:] == w[:-1]
        ids = np.concatenate([_mix(w[own], zero, 1), _mix(s[own], zero, 2), _mix(s[:-1], s[1:], 3),
                              np.where(same, _mix(s[1:], zero, 4), _mix(w[:-1], w[1:], 5))])
        ids, n = np.unique(ids, return_counts=True)
        if len(found):
            ids, at = np.unique(np.r_[found, ids], return_inverse=True)
            n = np.bincount(at, weights=np.r_[counts, n])
        found, counts = ids, n
    values = np.log1p(counts)
    values /= max(np.sqrt((values ** 2).sum()), 1e-12)
    return np.r_[1 << FEATURE_BITS, found], np.r_[1.0, values]


def follow_leader(examples: Iterator[tuple[np.ndarray, np.ndarray, int]]) -> np.ndarray:
    """Weights after per-coordinate FTRL-proximal updates by each example in turn."""
    z, n = np.zeros((1 << FEATURE_BITS) + 1), np.zeros((1 << FEATURE_BITS) + 1)

    def weights(zi, ni):
        return np.where(np.abs(zi) <= L1, 0.0, -(zi - np.sign(zi) * L1) / ((BETA + np.sqrt(ni)) / ALPHA + L2))

    for ids, x, y in examples:
        zi, ni = z[ids], n[ids]
        w = weights(zi, ni)
        g = (1 / (1 + np.exp(-np.clip(w @ x, -30, 30))) - y) * x
        sigma = (np.sqrt(ni + g * g) - np.sqrt(ni)) / ALPHA
        z[ids], n[ids] = zi + g - sigma * w, ni + g * g
    return weights(z, n).astype(np.float32)


def _featured(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Features of a task's distinct pairs, of which there are at most those chosen."""
    met: set[tuple] = set()
    for pdf in batches:
        # ``at`` stands for the id.
        new = [k not in met and not met.add(k) for k in zip(pdf["at"], pdf["hash"])]
        pdf = pdf[np.array(new, bool)]
        rows = [features(t) for t in pdf["text"]]
        yield pd.DataFrame({"at": pdf["at"], "hash": pdf["hash"], "label": pdf["label"],
                            "ids": [i.astype(np.int32).tobytes() for i, _ in rows],
                            "vals": [v.astype(np.float32).tobytes() for _, v in rows]})


def _trained(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    examples = ((np.frombuffer(i, np.int32), np.frombuffer(v, np.float32).astype(float), int(y == 1))
                for pdf in batches for i, v, y in zip(pdf["ids"], pdf["vals"], pdf["label"]))
    yield pd.DataFrame({"weights": [follow_leader(examples).tobytes()]})


def train(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> np.ndarray:
    """Weights learned from at most ``max_train`` distinct texts of labelled ids."""
    at = F.xxhash64("doc_id")
    chosen = (labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull()
                           & ~held_out(F.col("doc_id"), FOLDS, FOLD))
              .groupBy("doc_id").agg(F.max("quality").alias("label"))
              .select(F.col("doc_id").alias("_id"), "label", at.alias("at")).orderBy("at", "_id").limit(max_train))
    own, text_hash = docs.select("doc_id", "text"), F.xxhash64("text")
    # An id may have any number of rows and texts: the pairs themselves are bounded, too.
    pairs = (own.join(F.broadcast(chosen), F.col("doc_id") == F.col("_id"))
             .select("_id", "label", "at", text_hash.alias("hash")).distinct()
             .orderBy(F.xxhash64("at", "hash"), "at", "hash").limit(max_train))
    # At most max_train rows of four numbers: a proven bound.
    rows = own.join(F.broadcast(pairs), (F.col("doc_id") == F.col("_id")) & (text_hash == F.col("hash")))
    rows = rows.select("at", "hash", "label", "text").mapInPandas(
        _featured, "at long, hash long, label int, ids binary, vals binary").dropDuplicates(["at", "hash"])
    # Sorted also by content, so repeated ids are met in one order.
    epochs = F.explode(F.sequence(F.lit(1), F.lit(EPOCHS))).alias("epoch")
    ordered = rows.select("*", epochs).repartition(1).sortWithinPartitions("epoch", "at", "ids")
    learned = ordered.mapInPandas(_trained, "weights binary").first()
    return np.frombuffer(learned["weights"], np.float32) if learned else follow_leader(iter(()))


def scored(docs: DataFrame, weights: np.ndarray, name: str) -> DataFrame:
    """``docs`` with the score in column ``name``; every other column stays."""
    shipped = docs.sparkSession.sparkContext.broadcast(weights)

    @F.pandas_udf("double")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        w = shipped.value.astype(float)
        for texts in batches:
            logits = np.array([w[i] @ v for i, v in map(features, texts)])
            yield pd.Series(1 / (1 + np.exp(-np.clip(logits, -30, 30))), dtype=float)

    return docs.withColumn(name, of(F.col("text")))


def op5(spark, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = scored(docs, train(docs, read_table(spark, sf_dir, "labels")), "score")
    return rows.select("doc_id", held_out(F.col("doc_id"), FOLDS, FOLD).alias("held_out"), "score",
                       (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
