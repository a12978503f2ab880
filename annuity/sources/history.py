"""The history table as versioned snapshots; a run writes only the partitions that changed.

Under the history folder:

* ``data/run=<run>/type_identifier=<kind>/processed_year=<year>``: what each run wrote;
* ``versions/version=<n>``: one small table per complete version, a row for each
  (kind, year) with the run that holds it, its row count and its digest.

A version is written last, as one file, and names only data that is complete. The
catalog's history table is a view of the newest version, replaced after that, so
readers see the last complete version while a run writes, and after a run that
broke. Older versions stay readable (``read_history``).

Digests are sums and exclusive ors of row hashes per partition: the same
whatever the order of rows, aggregated with partial sums. A version has as many rows
as kinds times years, so it is read on the driver.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from annuity.config import RunConfig
from annuity.schemas import PROCESSED_YEAR
from annuity.sources.sinks import history_path, stage

KIND = "type_identifier"
VERSION_SCHEMA = f"{KIND} string, {PROCESSED_YEAR} int, run string, rows long, hash_sum decimal(38,0), hash_xor long"


@dataclass(frozen=True)
class Snapshot:
    """A written version: its number and the (kind, year) partitions this run wrote."""

    version: int
    changed: list[tuple[str | None, int | None]]
    dropped: list[tuple[str | None, int | None]]


def digests(history: DataFrame) -> DataFrame:
    """(kind, year, rows, hash_sum, hash_xor) of every partition."""
    values = [c for c in history.columns if c not in (KIND, PROCESSED_YEAR)]
    # A hash leaves out nulls, so their places are part of it.
    row = F.xxhash64(*values, F.array(*[F.col(c).isNull() for c in values]))
    return history.select(KIND, PROCESSED_YEAR, row.alias("_hash")).groupBy(KIND, PROCESSED_YEAR).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.col("_hash").cast("decimal(20,0)")).cast("decimal(38,0)").alias("hash_sum"),
        F.bit_xor("_hash").alias("hash_xor"))


def versions(spark: SparkSession, root: str) -> DataFrame | None:
    """All complete versions, None where there is none."""
    try:
        return spark.read.schema(f"{VERSION_SCHEMA}, version long").parquet(f"{root}/versions")
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def _version_rows(spark: SparkSession, root: str, version: int | None = None) -> tuple[int, list[Row]]:
    """The newest version, or the one asked for; version 0 has no rows."""
    every = versions(spark, root)
    newest = every.agg(F.max("version")).first()[0] if every is not None else None
    wanted = newest if version is None else version
    if wanted is None:
        return 0, []
    rows = every.where(F.col("version") == wanted).collect() if every is not None else []
    if version is not None and not rows:
        raise ValueError(f"no history version {version} under {root}")
    return wanted, rows


def _text(value) -> str:
    return "null" if value is None else str(value) if isinstance(value, int) else "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _snapshot_sql(rows: list[Row], root: str, fmt: str, schema: T.StructType) -> str:
    """The rows of a version: of each run, the partitions that the version takes from it."""
    typed = [f"cast(`{f.name}` as {f.dataType.simpleString()}) as `{f.name}`" for f in schema]
    runs: dict[str, list[str]] = {}
    for r in rows:
        runs.setdefault(r["run"], []).append(f"({KIND} <=> {_text(r[KIND])} and {PROCESSED_YEAR} <=> {_text(r[PROCESSED_YEAR])})")
    parts = [f"select {', '.join(typed)} from {fmt}.`{root}/data/run={run}` where {' or '.join(taken)}" for run, taken in runs.items()]
    none = [f"cast(null as {f.dataType.simpleString()}) as `{f.name}`" for f in schema]
    return " union all ".join(parts) or f"select {', '.join(none)} where false"


def write_snapshot(spark: SparkSession, history: DataFrame, cfg: RunConfig) -> Snapshot:
    """Write a new version of the history and point the catalog's table at it.

    The merged history is derived once into the shared folder. Partitions whose
    digest is that of the version before are taken from it; the others
    are dealt by partition (adaptive execution splits the large ones and joins
    the small ones) and sorted by processing date, so row-group statistics narrow a period.
    """
    root = history_path(cfg)
    by = [KIND, PROCESSED_YEAR]
    staged = stage(history.withColumn(PROCESSED_YEAR, F.year("date_processed")), "history")
    number, before = _version_rows(spark, root)
    number += 1
    run = f"{number:08d}-{uuid.uuid4().hex[:8]}"
    old = {(r[KIND], r[PROCESSED_YEAR]): r for r in before}
    now = digests(staged).collect()
    same = lambda r: (o := old.get((r[KIND], r[PROCESSED_YEAR]))) is not None and all(
        o[c] == r[c] for c in ("rows", "hash_sum", "hash_xor"))
    changed = sorted(((r[KIND], r[PROCESSED_YEAR]) for r in now if not same(r)), key=str)
    gone = sorted(set(old) - {(r[KIND], r[PROCESSED_YEAR]) for r in now}, key=str)
    if changed:
        wanted = F.lit(False)
        for kind, year in changed:
            wanted = wanted | (F.col(KIND).eqNullSafe(F.lit(kind)) & F.col(PROCESSED_YEAR).eqNullSafe(F.lit(year).cast("int")))
        (staged.where(wanted).hint("rebalance", *by).sortWithinPartitions(*by, "date_processed")
         .write.format(cfg.table_format).partitionBy(*by).save(f"{root}/data/run={run}"))
    rows = [Row(**{**r.asDict(), "run": old[(r[KIND], r[PROCESSED_YEAR])]["run"] if same(r) else run}) for r in now]
    table = spark.createDataFrame([(r[KIND], r[PROCESSED_YEAR], r["run"], r["rows"], r["hash_sum"], r["hash_xor"]) for r in rows], VERSION_SCHEMA)
    table.coalesce(1).write.parquet(f"{root}/versions/version={number}")
    if "." in cfg.history_table:
        spark.sql(f"create database if not exists {cfg.history_table.rpartition('.')[0]}")
    spark.sql(f"create or replace view {cfg.history_table} as {_snapshot_sql(rows, root, cfg.table_format, staged.schema)}")
    return Snapshot(number, changed, gone)


def read_history(spark: SparkSession, cfg: RunConfig, schema: T.StructType, version: int | None = None) -> DataFrame:
    """The newest complete version, or an older one, without the catalog."""
    root = history_path(cfg)
    _, rows = _version_rows(spark, root, version)
    return spark.sql(_snapshot_sql(rows, root, cfg.table_format, schema))
