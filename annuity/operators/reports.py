"""Period selection, totals and the internal reports."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annuity.schemas import MONEY_SUM, PROCESSED_YEAR

# Report headings and labels.
MONTHLY_REPORT_HEADINGS = {
    "publication_num": "European Patent (UK) Publication Number",
    "renewal_due_date": "Due Date For Payment Of Renewal",
    "renewal_year": "Ordinal Number (Annuity)",
    "lor_endorsement": "Licence Of Right Endorsement",
    "renewal_fee": "Prescribed UK Fee",
    "renewal_fee_epo": "Proportion of UK Prescribed Fee to be Remitted to EPO",
    "renewal_fee_year3": "3rd Year EPO Minimum Amount",
    "renewal_fee_year4": "4th Year EPO Minimum Amount",
    "total_epo_amount": "Total to be Remitted to EPO",
}
TOTAL_LABELS = {
    "grand_total_prescribed": "Grand Total Prescribed UK Fees",
    "grand_total_remitted": "Grand Total to be Remitted to EPO",
    "grand_total_retained": "Grand Total Retained",
}
QUARTER_TOTAL_LABEL = "EPO Total"


def in_period(df: DataFrame, start: dt.date, end: dt.date, ep_prefix: str = "EP") -> DataFrame:
    """Rows processed within [start, end] (whole days) for EP publications.

    Stored history is partitioned by year of processing; there the years of
    the period prune partitions.
    """
    rows = df.where(F.col("date_processed").between(F.lit(start), F.lit(end))
                    & F.col("publication_num").startswith(ep_prefix))
    return rows.where(F.col(PROCESSED_YEAR).between(start.year, end.year)) if PROCESSED_YEAR in df.columns else rows


def is_cross_month() -> F.Column:
    """Filed in one calendar month and processed in another."""
    return F.date_format("date_filed", "yyyy-MM") != F.date_format("date_processed", "yyyy-MM")


def cross_month(df: DataFrame) -> DataFrame:
    return df.where(is_cross_month())


def _sum(col: str) -> F.Column:
    return F.coalesce(F.sum(col), F.lit(Decimal("0.00"))).cast(MONEY_SUM)


def grand_totals(split: DataFrame) -> DataFrame:
    """One row: prescribed fees, amount remitted and amount retained."""
    return (split.agg(_sum("renewal_fee").alias("grand_total_prescribed"),
                      _sum("total_epo_amount").alias("grand_total_remitted"))
            .withColumn("grand_total_retained",
                        (F.col("grand_total_prescribed") - F.col("grand_total_remitted")).cast(MONEY_SUM)))


def totals_table(totals: DataFrame) -> DataFrame:
    """The three grand totals as labelled rows with formatted amounts."""
    labelled = totals.select(*[F.col(c).alias(label) for c, label in TOTAL_LABELS.items()])
    return (labelled.unpivot([], list(TOTAL_LABELS.values()), "Description", "Amount")
            .withColumn("Amount", F.format_number("Amount", 2)))


MONTHLY_ORDER = [MONTHLY_REPORT_HEADINGS["renewal_due_date"]]
STATUS_ORDER = ["type", "filing_date"]
MONTHLY_REPORT_COLUMNS = [*MONTHLY_REPORT_HEADINGS, "source"]


def monthly_report(split: DataFrame) -> DataFrame:
    """Renewals of the month with report headings (order is applied at the sink)."""
    return split.select(*MONTHLY_REPORT_COLUMNS).withColumnsRenamed(MONTHLY_REPORT_HEADINGS)


def monthly_totals(split: DataFrame) -> DataFrame:
    """Remitted amount per calendar month of filing, plus the period total.

    One aggregate with grouping sets (month) and (); ``_order`` sorts months
    chronologically with the total last.
    """
    g = (split.withColumn("_month", F.trunc("date_filed", "month"))
         .rollup("_month")
         .agg(F.sum("total_epo_amount").cast(MONEY_SUM).alias("_amount"),
              F.grouping("_month").alias("_total")))
    return g.select(
        F.when(F.col("_total") == 1, F.lit(QUARTER_TOTAL_LABEL))
        .otherwise(F.date_format("_month", "MMMM yyyy")).alias("Month"),
        F.format_number("_amount", 2).alias("Amount"),
        F.col("_total"), F.col("_month"),
    )


# Columns of the status report, and the column of each kind of event that fills them (null where none does).
STATUS_SCHEMA = {
    "publication_num": "string", "filing_date": "date", "date_processed": "date", "type": "string",
    "Addition_Deletion": "string", "from_year": "int", "to_year": "int",
}
STATUS_OF_LAPSE = {"type": "lapsed_reason"}
STATUS_OF_RESTORATION = {"type": "type_identifier"}
STATUS_OF_LOR = {"type": "type_identifier", "Addition_Deletion": "Addition_Deletion",
                 "from_year": "first_reduced_year", "to_year": "last_reduced_year"}
STATUS_COMMON = {c: c for c in ("publication_num", "filing_date", "date_processed")}


def _status_rows(df: DataFrame, filled_by: dict[str, str]) -> DataFrame:
    source = STATUS_COMMON | filled_by
    return df.select(*[(F.col(source[c]) if c in source else F.lit(None)).cast(kind).alias(c)
                       for c, kind in STATUS_SCHEMA.items()])


def status_report(lapses: DataFrame, restorations: DataFrame, lor_ranges: DataFrame) -> DataFrame:
    """Lapses, restorations and licence-of-right changes of the period in one table."""
    kinds = ((lapses, STATUS_OF_LAPSE), (restorations, STATUS_OF_RESTORATION), (lor_ranges, STATUS_OF_LOR))
    return reduce(DataFrame.unionByName, [_status_rows(df, filled_by) for df, filled_by in kinds])
