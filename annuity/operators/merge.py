"""Combining the two source systems and building the history table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annuity.schemas import (
    HISTORY_COLUMNS,
    KIND_LOR,
    KIND_RENEWAL,
    KIND_RESTORATION,
    RENEWAL_KEYS,
    ROWS,
    SOURCE_LEGACY,
    SOURCE_NEW,
)


def tag(df: DataFrame, source: str) -> DataFrame:
    return df.withColumn("source", F.lit(source))


def dedupe_union(legacy: DataFrame, new: DataFrame, kind: str | None = None) -> DataFrame:
    """Tag each system, union by name and drop identical rows.

    The tag is part of the row, so the same event held by both systems is kept
    once per system. Duplicates are removed by a hash aggregate with map-side
    partial aggregation, so a heavily repeated row collapses before the shuffle.
    """
    out = tag(legacy, SOURCE_LEGACY).unionByName(tag(new, SOURCE_NEW)).dropDuplicates()
    return out.withColumn("type_identifier", F.lit(kind)) if kind else out


def key_set(df: DataFrame, keys: list[str] = RENEWAL_KEYS) -> DataFrame:
    """Distinct merge keys (partial aggregation before the shuffle)."""
    return df.select(*keys).distinct()


def priority_merge(new: DataFrame, legacy: DataFrame, keys: list[str] = RENEWAL_KEYS) -> DataFrame:
    """All new-system rows plus the legacy rows whose key the new system lacks.

    Neither side is de-duplicated internally. Keys compare with ``=``, so a
    legacy row with a null key part never matches and is kept. The new side
    is reduced to its distinct keys first: the anti join then shuffles one
    row per key, and a key repeated across many rows cannot skew it.
    """
    remaining = legacy.join(key_set(new, keys), keys, "left_anti")
    merged = tag(new, SOURCE_NEW).unionByName(tag(remaining, SOURCE_LEGACY), allowMissingColumns=True)
    cols = [c for c in (*HISTORY_COLUMNS, ROWS) if c in merged.columns and c != "type_identifier"]
    return merged.select(*cols).withColumn("type_identifier", F.lit(KIND_RENEWAL))


def overlap_keys(new: DataFrame, legacy: DataFrame, keys: list[str] = RENEWAL_KEYS) -> DataFrame:
    """Distinct legacy keys that the new system also holds (same equality as the merge)."""
    return key_set(legacy, keys).join(key_set(new, keys), keys, "left_semi")


def key_counts(new: DataFrame, legacy: DataFrame, keys: list[str] = RENEWAL_KEYS) -> DataFrame:
    """Rows of each system per merge key, and whether the merge sees the key in both: (keys, new, legacy, shared).

    One aggregate over both systems in place of a join. A key with a null part matches nothing.
    """
    both = (new.select(*keys, F.lit(1).alias("_new"), F.lit(0).alias("_legacy"))
            .unionByName(legacy.select(*keys, F.lit(0).alias("_new"), F.lit(1).alias("_legacy"))))
    counted = both.groupBy(*keys).agg(F.sum("_new").alias("new"), F.sum("_legacy").alias("legacy"))
    whole = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    return counted.withColumn("shared", whole & (F.col("new") > 0) & (F.col("legacy") > 0))


def source_breakdown(renewals: DataFrame) -> DataFrame:
    return renewals.groupBy("source").agg(F.count(F.lit(1)).alias("renewal_count"))


def history(renewals: DataFrame, restorations: DataFrame, lor: DataFrame) -> DataFrame:
    """Renewals, restorations and licence-of-right cancellations in one table.

    Columns follow ``HISTORY_COLUMNS``; a column a kind lacks is a typed null.
    """
    cancelled = lor.where(F.col("Addition_Deletion") == "D").drop("Addition_Deletion")
    out = (renewals
           .unionByName(restorations.withColumn("type_identifier", F.lit(KIND_RESTORATION)),
                        allowMissingColumns=True)
           .unionByName(cancelled.withColumn("type_identifier", F.lit(KIND_LOR)),
                        allowMissingColumns=True))
    return out.select(*HISTORY_COLUMNS)
