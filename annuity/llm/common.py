"""Shared helpers: table reads, written intermediate tables, column naming."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WHITESPACE = " \t\n\x0b\f\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only where that is unset (tests, local runs) a folder under the SQL
    warehouse is used.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return named or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_stages"


NARROW = 8


def stage(df: DataFrame, name: str, narrow: bool = False) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    This cuts the lineage: a lost executor costs a re-read of files, not the
    steps before them. Unlike ``checkpoint()`` the plan runs only once.
    ``narrow`` tables have a few numbers a row and cheap steps before them: one
    file takes ``NARROW`` shuffle partitions, as many small files cost more
    than they save.
    """
    spark = df.sparkSession
    if narrow:
        df = df.coalesce(max(1, -(-int(spark.conf.get("spark.sql.shuffle.partitions")) // NARROW)))
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names like ``names`` that ``df`` does not have (case-insensitively)."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, UPPER.lower())


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    """Whether crc32 of the id's decimal text leaves ``fold`` modulo ``folds``; a null id never does."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(False))
