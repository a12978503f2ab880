"""Named queries: one per operator of the settlement run, over the fixture tables.

Every query reads the driver's parquet files through ``fixture_tables`` and
runs its stage over the whole tables. The test period is the quarter closed
by a run on 2001-01-03 (2000-10-01 .. 2000-12-31); monthly outputs use the
month closed by the same run date.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from annuity.config import RunConfig
from annuity.functions import money_parts
from annuity.operators import exchange, extracts, merge, reports, rules
from annuity.plans.pipeline import LOR_EXTRACTS, PERIOD_EXTRACTS, STATUS_EXTRACTS, Pipeline
from annuity.schemas import EVENT_COLUMNS, HISTORY_COLUMNS, LAPSE_COLUMNS, LOR_COLUMNS, SOURCE_NEW
from annuity.sources import manifest, sinks
from annuity.sources.tables import read_minimum_fees, rejected_minimum_fees
from annuity.sources.testdata import damaged_fee_lines, damaged_tables, fixture_tables

TEST_RUN_DATE = dt.date(2001, 1, 3)
TEST_CONFIG = RunConfig(run_date=TEST_RUN_DATE, quarterly=True)
TEST_CONFIG_MONTHLY = TEST_CONFIG.monthly()

Query = Callable[[SparkSession, str], DataFrame]


def pipeline(spark: SparkSession, sf_dir: str, cfg: RunConfig = TEST_CONFIG) -> Pipeline:
    return Pipeline(fixture_tables(spark, sf_dir), cfg)


def _q(stage: Callable[[Pipeline], DataFrame], cfg: RunConfig = TEST_CONFIG) -> Query:
    return lambda spark, sf_dir: stage(pipeline(spark, sf_dir, cfg))


# Stages that the exchange file and its rejects go through, each written once per query: of joined rows those of the period
# alone, beside the payments and licences of right that rules look at beyond it.
FILE_STAGES = ("renewals_in_period", "payments", "lor", "renewals_split", "lor_ranges_period")

NEW_RENEWAL_COLUMNS = [
    "application_num", "publication_num", "filing_date", "grant_date", "renewal_year", "renewal_fee",
    "prescribed_uk_fee", "lor_indicator", "renewal_due_date", "date_filed", "date_processed",
]
LEGACY_RENEWAL_COLUMNS = [
    "application_num", "publication_num", "filing_date", "grant_date", "renewal_year", "renewal_fee",
    "late_fee", "late_months", "next_renewal_date", "date_filed", "date_processed",
]
DUE_COLUMNS = [
    "application_num", "publication_num", "filing_date", "grant_date", "renewal_year",
    "date_filed", "date_processed", "source", "renewal_due_date",
]
ENDORSEMENT_COLUMNS = [
    "application_num", "renewal_year", "date_filed", "date_processed", "renewal_due_date",
    "renewal_comparison_date", "lor_endorsement", "source",
]
RANGE_COLUMNS = [
    "application_num", "publication_num", "filing_date", "date_filed", "date_processed",
    "Addition_Deletion", "source", "first_reduced_year", "last_reduced_year",
]
SPLIT_COLUMNS = [
    "application_num", "publication_num", "renewal_year", "date_filed", "date_processed",
    "renewal_due_date", "lor_endorsement", "renewal_fee", "renewal_fee_epo", "renewal_fee_year3",
    "renewal_fee_year4", "total_epo_amount", "source",
]
PERIOD_COLUMNS = [
    "application_num", "publication_num", "renewal_year", "date_filed", "date_processed",
    "renewal_due_date", "lor_endorsement", "source",
]


def _money_fields(p: Pipeline) -> DataFrame:
    cols = []
    for c in ["renewal_fee", "renewal_fee_epo", "total_epo_amount"]:
        whole, hundredths = money_parts(F.col(c), 8)
        cols += [whole.alias(f"{c}_whole"), hundredths.alias(f"{c}_hundredths")]
    return p.renewals_split.select("application_num", "publication_num", "renewal_year", "date_filed", *cols)


def _minimum_fee_lookup(p: Pipeline) -> DataFrame:
    return p.split(p.renewals_due).select(
        "application_num", "renewal_year", "date_filed", "date_processed", "renewal_due_date",
        "renewal_fee_year3", "renewal_fee_year4")


def _null_rows(p: Pipeline) -> DataFrame:
    return (p.renewals_split.withColumn("reason", exchange.missing_reason(exchange.RENEWAL_REQUIRED))
            .where(F.col("reason").isNotNull())
            .select("application_num", "publication_num", "renewal_year", "date_filed", "reason"))


def _period_file(p: Pipeline) -> Pipeline:
    """For the exchange file and its rejects."""
    return p.for_period(*PERIOD_EXTRACTS).staged(*FILE_STAGES)


def _period_lor(p: Pipeline) -> Pipeline:
    """For licences of right in the period, beside restorations and lapses."""
    return p.for_period(*STATUS_EXTRACTS).staged("lor")


RANGE_RENEWAL_COLUMNS = ["application_num", "publication_num", "renewal_year", "date_processed"]


def _lor_records(p: Pipeline) -> DataFrame:
    p = p.for_period(*LOR_EXTRACTS, columns=RANGE_RENEWAL_COLUMNS).staged("renewals", columns=RANGE_RENEWAL_COLUMNS).staged("lor")
    return exchange.records(p.lor_rows, exchange.TYPE_LOR)


def _lor_endorsement(p: Pipeline) -> DataFrame:
    """Renewals are read twice, those of the new system once more for the merge: each is derived once."""
    used = ["application_num", "publication_num", "filing_date", "grant_date", "renewal_year", "date_filed", "date_processed", "source"]
    return p.staged("renewals_new", "renewals", columns=used).renewals_enriched.select(*ENDORSEMENT_COLUMNS)


def _lor_year_range(p: Pipeline) -> DataFrame:
    """Licences are read four times and renewals twice: each is derived once."""
    return p.staged("renewals_new", "renewals", columns=RANGE_RENEWAL_COLUMNS).staged("lor").lor_ranges.select(*RANGE_COLUMNS)


def _audit_counts(p: Pipeline) -> DataFrame:
    """Run counts as (metric, value) rows.

    Each renewal extract is derived once; the merge, and the aggregate by its keys, start from
    the stored rows. Licences in the period come from the applications that have one.
    """
    lor_period = p.for_period(*LOR_EXTRACTS).staged("lor", "lor_period").lor_period
    p = Pipeline(p.src, p.cfg).staged("renewals_new", "renewals_legacy", columns=[*merge.RENEWAL_KEYS, "date_filed", "date_processed"])
    every = F.lit(True)
    period = F.col("date_processed").between(p.cfg.start, p.cfg.end) & F.col("publication_num").startswith(p.cfg.ep_prefix)
    passes = [
        (p.renewals, {"renewals_new": F.col("source") == SOURCE_NEW, "renewals_merged": every,
                      "renewals_in_period": period, "cross_month_renewals": period & reports.is_cross_month()}),
        (p.restorations, {"restorations": every, "restorations_in_period": period}),
        (p.lor, {"licences_of_right": every}),
        (p.lapses, {"lapses": every}),
        (lor_period, {"licences_of_right_in_period": every}),
    ]
    counted = [df.agg(*[F.count(F.when(on, 1)).alias(name) for name, on in counts.items()])
               .unpivot([], list(counts), "metric", "value") for df, counts in passes]
    keys = merge.key_counts(p.renewals_new, p.renewals_legacy).agg(
        F.coalesce(F.sum("legacy"), F.lit(0)).alias("renewals_legacy"), F.count_if("shared").alias("duplicate_renewal_keys"))
    counted.append(keys.unpivot([], keys.columns, "metric", "value"))
    return reduce(DataFrame.unionByName, counted)


def _minimum_fee_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The minimum-fee CSV as written and read back with its header."""
    path = f"{sinks.shared_folder(spark)}/minimum-fee-{uuid.uuid4().hex}"
    fixture_tables(spark, sf_dir).minimum_fee.write.option("header", True).csv(path)
    return read_minimum_fees(spark, path)


def _minimum_fee_lines(read: Callable[[SparkSession, str], DataFrame]) -> Query:
    """Over a minimum-fee CSV with damaged lines."""
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = f"{sinks.shared_folder(spark)}/minimum-fee-{uuid.uuid4().hex}"
        damaged_fee_lines(spark, sf_dir).write.text(path)
        return read(spark, path)

    return query


def _written_file(spark: SparkSession, sf_dir: str, files: int | None = None) -> DataFrame:
    """The exchange file as its sink wrote it, read back."""
    p = _period_file(pipeline(spark, sf_dir))
    path = sinks.write_exchange_file(p.exchange_lines, f"{sinks.shared_folder(spark)}/exchange-{uuid.uuid4().hex}", files)
    return sinks.read_exchange_file(spark, path)


def exchange_file_written(spark: SparkSession, sf_dir: str, files: int | None = None) -> DataFrame:
    """The written exchange file with its line numbers."""
    return manifest.numbered(_written_file(spark, sf_dir, files))


def _exchange_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The written exchange file's lines against its trailer."""
    return exchange.reconciled(_written_file(spark, sf_dir), TEST_CONFIG)


def status_report_written(spark: SparkSession, sf_dir: str, files: int | None = None) -> DataFrame:
    """The quarterly status report as its CSV sink wrote it, with line numbers: every column as text."""
    p = _period_lor(pipeline(spark, sf_dir))
    path = sinks.write_csv(p.status_report, f"{sinks.shared_folder(spark)}/status-{uuid.uuid4().hex}", reports.STATUS_ORDER,
                           files=files)
    return manifest.numbered(sinks.read_csv(spark, path, ", ".join(f"`{c}` string" for c in p.status_report.columns)))


def monthly_report_written(spark: SparkSession, sf_dir: str, files: int | None = None) -> DataFrame:
    """The monthly report as its CSV sink wrote it, with line numbers."""
    report = pipeline(spark, sf_dir, TEST_CONFIG_MONTHLY).monthly_report
    path = sinks.write_csv(report, f"{sinks.shared_folder(spark)}/monthly-{uuid.uuid4().hex}", reports.MONTHLY_ORDER, files=files)
    return manifest.numbered(sinks.read_csv(spark, path, report.schema))


def _records(rows: str, record_type: int) -> Callable[[Pipeline], DataFrame]:
    return lambda p: exchange.records(getattr(p, rows), record_type)


QUERIES: dict[str, Query] = {
    # sources and extracts
    "minimum_fee_csv": _minimum_fee_csv,
    "minimum_fee_good_lines": _minimum_fee_lines(read_minimum_fees),
    "minimum_fee_rejects": _minimum_fee_lines(rejected_minimum_fees),
    "quarantine": lambda spark, sf_dir: damaged_tables(spark, sf_dir).quarantine,
    "extract_renewals_damaged": lambda spark, sf_dir: extracts.renewals_legacy(damaged_tables(spark, sf_dir))
        .select(*LEGACY_RENEWAL_COLUMNS),
    "extract_renewals_new": _q(lambda p: p.renewals_new.select(*NEW_RENEWAL_COLUMNS)),
    "extract_renewals_legacy": _q(lambda p: p.renewals_legacy.select(*LEGACY_RENEWAL_COLUMNS)),
    "extract_restorations_legacy": _q(lambda p: p.restorations_legacy.select(*EVENT_COLUMNS)),
    "extract_restorations_new": _q(lambda p: p.restorations_new.select(*EVENT_COLUMNS)),
    "extract_lor_legacy": _q(lambda p: p.lor_legacy.select(*LOR_COLUMNS)),
    "extract_lor_new": _q(lambda p: p.lor_new.select(*LOR_COLUMNS)),
    "extract_lapses_legacy": _q(lambda p: p.lapses_legacy.select(*LAPSE_COLUMNS)),
    "extract_lapses_new": _q(lambda p: p.lapses_new.select(*LAPSE_COLUMNS)),
    "left_join_chain": _q(lambda p: extracts.incident_join_chain(p.src)),
    # merges
    "priority_merge": _q(lambda p: p.renewals.select(*HISTORY_COLUMNS)),
    "overlap_keys": _q(lambda p: merge.overlap_keys(p.renewals_new, p.renewals_legacy)),
    "source_breakdown": _q(lambda p: merge.source_breakdown(p.renewals)),
    "dedupe_union": _q(lambda p: p.restorations.select(*EVENT_COLUMNS, "source", "type_identifier")),
    "merged_lor": _q(lambda p: p.lor.select(*LOR_COLUMNS, "source", "type_identifier")),
    "merged_lapses": _q(lambda p: p.lapses.select(*LAPSE_COLUMNS, "source")),
    "history_union": _q(lambda p: p.history),
    "null_rows": _q(_null_rows),
    # rules
    "renewal_due_dates": _q(lambda p: p.renewals_due.select(*DUE_COLUMNS)),
    "multiple_renewals": _q(lambda p: rules.multiple_payment_groups(p.renewals)),
    "lor_pivot": _q(lambda p: rules.lor_pivot(p.lor)),
    "lor_endorsement": _q(_lor_endorsement),
    "lor_year_range": _q(_lor_year_range),
    "lor_inverted_ranges": _q(lambda p: rules.inverted_ranges(p.lor_period).select(*RANGE_COLUMNS)),
    "minimum_fee_lookup": _q(_minimum_fee_lookup),
    "fee_splits": _q(lambda p: p.renewals_split.select(*SPLIT_COLUMNS)),
    # reports
    "period_filter": _q(lambda p: p.renewals_period.select(*PERIOD_COLUMNS)),
    "cross_month": _q(lambda p: reports.cross_month(p.renewals_period)
        .select("application_num", "publication_num", "date_filed", "date_processed", "source")),
    "audit_counts": _q(_audit_counts),
    "grand_totals": _q(lambda p: p.totals),
    "monthly_totals": _q(lambda p: p.monthly_totals.select("Month", "Amount")),
    "monthly_report": _q(lambda p: p.monthly_report, TEST_CONFIG_MONTHLY),
    "monthly_report_totals": _q(lambda p: p.totals_table, TEST_CONFIG_MONTHLY),
    "status_report": _q(lambda p: _period_lor(p).status_report),
    # exchange file
    "money_fields": _q(_money_fields),
    "renewal_records": _q(_records("renewal_rows", exchange.TYPE_RENEWAL)),
    "lapse_records": _q(_records("lapse_rows", exchange.TYPE_LAPSE)),
    "restoration_records": _q(_records("restoration_rows", exchange.TYPE_RESTORATION)),
    "lor_records": _q(_lor_records),
    "exchange_file": _q(lambda p: _period_file(p).exchange_lines.select("record")),
    "exchange_file_written": exchange_file_written,
    "exchange_reconciliation": _exchange_reconciliation,
    "status_report_written": status_report_written,
    "monthly_report_written": monthly_report_written,
    "rejects": _q(lambda p: _period_file(p).rejects),
}
