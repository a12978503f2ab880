"""A corpus pipeline over ``documents``: each stage is written as Parquet and read again as the next one's input.

Quality classifier, toxicity, SimHash near-duplicates, mixing, packing: all
but the last return the columns of ``documents``; the last returns the packed
pieces. SQL can express none of the models, so there is no ORACLE_SQL; the
tests run the stages against a plain version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from annuity.llm import mixing, packing, quality_classifier, simhash, toxicity
from annuity.llm.common import fresh, read_table, stage

SHINGLE, MAX_BITS = 3, 3


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    (score,) = fresh(docs, "quality_score")
    weights = quality_classifier.train(docs, read_table(spark, sf_dir, "labels"))
    rows = quality_classifier.scored(docs, weights, score)
    return rows.where(F.col(score) >= quality_classifier.THRESHOLD).select(*docs.columns)


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity models do not reject."""
    score, measure = fresh(docs, "toxicity_score", "toxicity_measure")
    rows = toxicity.scored(docs, read_table(spark, sf_dir, "labels"), score, measure)
    return rows.where(F.col(score) < toxicity.THRESHOLD).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return simhash.keep_one(docs, SHINGLE, MAX_BITS)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample of the documents by their raked probabilities."""
    rows, names = mixing.mixed(*mixing.measured(docs))
    return rows.where(F.col(names["selected"])).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's pieces, placed in sequences."""
    return packing.op1(docs)


STAGES = [("quality classifier", quality), ("toxicity", without_toxic), ("simhash near-dedup", near_dedup),
          ("mixing sources", mixture), ("best-fit packing", packed)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
