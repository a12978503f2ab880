"""The settlement run: history, reports and (quarterly) the exchange file.

Writes (quarterly): a history version, the two reports, the exchange file and
the rejects table. Counts for the run log come from ``observe`` on those
writes, not from extra count jobs.

The history is written first, as a new version, and read back (by kind and
year) for the period outputs, so they do not repeat the extracts and the
merge, and their lineage starts at a stored table. Small period frames used by
several outputs are persisted.

Every delivered output is read back once: its manifest (a row per part) is stored, and rows, order and
checksum are compared with what the write observed; the lines of the exchange
file are added up against its trailer. A run is "ok" only after that.
"""

from __future__ import annotations

import time
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from annuity.config import RunConfig
from annuity.operators import exchange
from annuity.operators.reports import MONTHLY_ORDER, STATUS_ORDER, is_cross_month
from annuity.plans.pipeline import Pipeline
from annuity.schemas import EVENT_COLUMNS, HISTORY_COLUMNS, KIND_LOR, KIND_RENEWAL, KIND_RESTORATION, PROCESSED_YEAR
from annuity.sources import manifest, sinks
from annuity.sources.history import write_snapshot
from annuity.sources.tables import SourceTables


@dataclass
class RunResult:
    """Outputs by name, counts, and how the run ended.

    ``status``: "ok"; "rejects" when rows were rejected or source values quarantined; "failed" when an output
    does not read back as it was written or the exchange file lacks its header or
    trailer or does not add up. ``faults``: what is wrong, by output.
    """

    status: str = "ok"
    outputs: dict[str, str] = field(default_factory=dict)
    metrics: dict[str, object] = field(default_factory=dict)
    faults: dict[str, list[str]] = field(default_factory=dict)


@contextmanager
def _timed(result: "RunResult", name: str):
    start = time.perf_counter()
    yield
    result.metrics[f"sec_{name}"] = round(time.perf_counter() - start, 3)


def _count_if(cond) -> F.Column:
    return F.sum(F.when(cond, 1).otherwise(0))


def _check(result: RunResult, cfg: RunConfig, name: str, read: DataFrame, order: list[str], noted: Observation) -> None:
    """Store the manifest of an output and note its faults; the rest of what was observed are run metrics."""
    seen = dict(noted.get)
    path = f"{cfg.out_root.rstrip('/')}/manifest/{cfg.run_stamp}/{name}"
    with _timed(result, f"check_{name}"):
        parts = manifest.write_manifest(manifest.manifest(read, order), path)
        found = manifest.faults(parts, seen.pop("rows"), seen.pop("checksum"))
    if found:
        result.faults[name] = found
    result.outputs[f"{name}_manifest"] = path
    result.metrics.update(seen)


def run(spark: SparkSession, src: SourceTables, cfg: RunConfig) -> RunResult:
    if not cfg.out_root:
        raise ValueError("RunConfig.out_root is required to run the job")
    result = RunResult()
    p = Pipeline(src, cfg)

    # 1. History: all renewals, restorations and licence cancellations. The
    #    combined licence-of-right events are cached by this write and reused
    #    by the endorsement and the reduced-year ranges.
    p.lor = p.lor.persist(StorageLevel.MEMORY_AND_DISK)
    kind = F.col("type_identifier")
    obs_history = Observation("history")
    history = p.history.observe(
        obs_history,
        _count_if(kind == KIND_RENEWAL).alias("renewals"),
        _count_if((kind == KIND_RENEWAL) & (F.col("source") == "Dynamics")).alias("renewals_new"),
        _count_if((kind == KIND_RENEWAL) & (F.col("source") == "Legacy")).alias("renewals_legacy"),
        _count_if(kind == KIND_RESTORATION).alias("restorations"),
        _count_if(~kind.isin(KIND_RENEWAL, KIND_RESTORATION)).alias("lor_cancellations"))
    with _timed(result, "history"):
        snapshot = write_snapshot(spark, history, cfg)
    result.outputs["history"] = cfg.history_table
    result.metrics.update(obs_history.get)
    result.metrics.update(history_version=snapshot.version, history_partitions_written=len(snapshot.changed))

    # Source values that do not fit their column, in a table of their own; there is nothing to do where all types fit.
    quarantine = src.quarantine
    if quarantine is not None:
        obs_quarantine = Observation("quarantine")
        with _timed(result, "quarantine"):
            result.outputs["quarantine"] = sinks.write_table(
                quarantine.observe(obs_quarantine, F.count(F.lit(1)).alias("quarantined_values")),
                f"{cfg.out_root.rstrip('/')}/quarantine/{cfg.run_stamp}")
        result.metrics.update(obs_quarantine.get)

    # 2. Downstream stages read the stored history instead of re-extracting.
    stored = spark.read.table(cfg.history_table)
    p.renewals = stored.where(kind == KIND_RENEWAL).select(*HISTORY_COLUMNS, PROCESSED_YEAR)
    p.restorations = stored.where(kind == KIND_RESTORATION).select(
        *EVENT_COLUMNS, "source", "type_identifier", PROCESSED_YEAR)

    obs_split = Observation("period")
    split = p.renewals_split.observe(
        obs_split,
        F.count(F.lit(1)).alias("renewals_in_period"),
        _count_if(is_cross_month()).alias("cross_month_renewals"),
        _count_if(exchange.missing_reason(exchange.RENEWAL_REQUIRED).isNotNull()).alias("renewals_with_missing_fields"),
    ).persist(StorageLevel.MEMORY_AND_DISK)
    p.renewals_split = split

    if not cfg.quarterly:
        report, totals = p.monthly_report, p.totals_table
        obs_report, obs_totals = Observation("monthly_report"), Observation("monthly_totals")
        with _timed(result, "monthly_report"):
            path = result.outputs["monthly_report"] = sinks.write_csv(
                report, sinks.report_path(cfg, sinks.MONTHLY_REPORT), MONTHLY_ORDER, files=cfg.output_files,
                observe=(obs_report, *manifest.observed(report.columns)))
        _check(result, cfg, "monthly_report", sinks.read_csv(spark, path, report.schema), MONTHLY_ORDER, obs_report)
        with _timed(result, "monthly_totals"):
            # Three rows by construction: always one file.
            path = result.outputs["monthly_totals"] = sinks.write_csv(
                totals, sinks.report_path(cfg, sinks.MONTHLY_TOTALS), [], files=1, small=True,
                observe=(obs_totals, *manifest.observed(totals.columns)))
        _check(result, cfg, "monthly_totals", sinks.read_csv(spark, path, totals.schema), [], obs_totals)
        result.metrics.update(obs_split.get)
    else:
        # Checked rows feed both the exchange file and the rejects table.
        kept = []
        for name in ["lapses", "lor_ranges_all", "renewal_rows", "lapse_rows", "restoration_rows", "lor_rows"]:
            df = getattr(p, name).persist(StorageLevel.MEMORY_AND_DISK)
            setattr(p, name, df)
            kept.append(df)
        status, totals = p.status_report, p.monthly_totals
        obs_status = Observation("status")
        status_metrics = (
            obs_status, *manifest.observed(status.columns),
            _count_if(F.col("type") == KIND_RESTORATION).alias("restorations_in_period"),
            _count_if(F.col("type") == KIND_LOR).alias("licences_of_right_in_period"),
            _count_if(F.col("to_year") < F.col("from_year")).alias("inverted_lor_ranges"),
            _count_if(~F.col("type").isin(KIND_RESTORATION, KIND_LOR) | F.col("type").isNull())
            .alias("lapses_in_period"))
        with _timed(result, "status_report"):
            path = result.outputs["status_report"] = sinks.write_csv(
                status, sinks.report_path(cfg, sinks.QUARTERLY_REPORT), STATUS_ORDER,
                files=cfg.output_files, observe=status_metrics)
        _check(result, cfg, "status_report", sinks.read_csv(spark, path, status.schema), STATUS_ORDER, obs_status)
        obs_totals, kept_columns = Observation("quarterly_totals"), ["Month", "Amount"]
        with _timed(result, "quarterly_totals"):
            # One row per month of the period plus the total: always one file.
            path = result.outputs["quarterly_totals"] = sinks.write_csv(
                totals, sinks.report_path(cfg, sinks.QUARTERLY_TOTALS), ["_total", "_month"],
                kept_columns, files=1, small=True, observe=(obs_totals, *manifest.observed(kept_columns)))
        _check(result, cfg, "quarterly_totals", sinks.read_csv(spark, path, totals.select(*kept_columns).schema), [], obs_totals)
        result.metrics.update(obs_split.get)
        obs_lines = Observation("exchange")
        line_metrics = (
            obs_lines, *manifest.observed(["record"]), F.count(F.lit(1)).alias("exchange_lines"),
            _count_if(F.col("type") == exchange.TYPE_RENEWAL).alias("renewal_lines"))
        with _timed(result, "exchange_file"):
            path = result.outputs["exchange_file"] = sinks.write_exchange_file(
                p.exchange_lines, sinks.exchange_path(cfg), cfg.output_files, observe=line_metrics)
        written = sinks.read_exchange_file(spark, path)
        _check(result, cfg, "exchange_file", written, ["record"], obs_lines)
        with _timed(result, "reconciliation"):
            sums = exchange.reconciled(written, cfg).collect()  # one row per record type
        result.metrics.update({f"lines_{r['type']}": r["lines"] for r in sums})
        wrong = [f"type {r['type']}: lines and trailer do not agree: {r.asDict()}" for r in sums if not r["balanced"]]
        if wrong:
            result.faults.setdefault("exchange_file", []).extend(wrong)
        obs_rejects = Observation("rejects")
        incomplete = F.col("reason").startswith("missing ") | F.col("reason").isin(*exchange.MISSING_REASONS.values())
        rejects = p.rejects.observe(
            obs_rejects, F.count(F.lit(1)).alias("rejects"),
            _count_if(F.col("type").isin(exchange.TYPE_HEADER, exchange.TYPE_TRAILER)).alias("rejected_control_lines"),
            *[F.coalesce(F.sum(F.when((F.col("type") == t) & incomplete, F.col("payments"))), F.lit(0)).alias(f"null_rows_{t}")
              for t in exchange.DETAIL_TYPES],
            *[F.sum(c).alias(f"rejected_{c}") for c in exchange.REJECT_AMOUNTS])
        with _timed(result, "rejects"):
            result.outputs["rejects"] = sinks.write_table(
                rejects, f"{cfg.out_root.rstrip('/')}/rejects/{cfg.run_stamp}")
        result.metrics.update(obs_rejects.get)
        if result.metrics["rejects"]:
            result.status = "rejects"
        if result.metrics["rejected_control_lines"]:
            result.faults.setdefault("exchange_file", []).append("header or trailer rejected")
        for df in kept:
            df.unpersist()
    if result.metrics.get("quarantined_values"):
        result.status = "rejects"
    if result.faults:
        result.status = "failed"
    split.unpersist()
    p.lor.unpersist()
    return result
