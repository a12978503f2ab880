"""Every stage of the settlement run, wired once for a set of sources and a config.

Attributes are lazy DataFrames built on first access, so a query touching one
stage plans only what it needs. Nothing but ``staged`` triggers a job.
"""

from __future__ import annotations

from functools import cached_property, reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annuity.config import RunConfig
from annuity.operators import exchange, extracts, merge, reports, rules
from annuity.schemas import KIND_LOR, KIND_RESTORATION
from annuity.sources.sinks import stage, stage_buckets
from annuity.sources.tables import SourceTables


BUCKETED = ("renewals", "lor")
LOR_EXTRACTS = ("lor_legacy", "lor_new")
STATUS_EXTRACTS = (*LOR_EXTRACTS, "restorations_legacy", "restorations_new")
PERIOD_EXTRACTS = ("renewals_legacy", "renewals_new", *STATUS_EXTRACTS)


class Pipeline:
    def __init__(self, src: SourceTables, cfg: RunConfig):
        self.src = src
        self.cfg = cfg
        # Whether renewals and licences of right are stored in buckets of application_num.
        self.bucketed = False

    def staged(self, *names: str, columns: list[str] | None = None) -> "Pipeline":
        """The same pipeline with these stages written once to the shared folder and read back.

        For outputs that need a stage several times: each is derived once, in
        the order given, and what follows starts from files. ``columns``: those that the output uses, where a stage has them.
        """
        for name in names:
            df = getattr(self, name)
            setattr(self, name, stage(df.select(*[c for c in df.columns if c in columns]) if columns else df, name))
        return self

    def for_period(self, *extracted: str, columns: list[str] | None = None) -> "Pipeline":
        """The same pipeline for outputs of the period, without the applications that have nothing in it.

        Every rule looks at one application at a time. So the sources of all applications that have a date in the
        period in one of the ``extracted`` extracts, whole, give the period's rows of those. They are written once and
        the extracts start from them, as do renewals and licences of right in any case. ``columns``: those of renewals that the output uses.
        """
        dated = [extracts.applications_dated(self.src, name, self.cfg.start, self.cfg.end, self.cfg.ep_prefix) for name in extracted]
        applications = stage(reduce(DataFrame.unionByName, dated).distinct(), "applications")
        every, named = applications.agg(F.count(F.lit(1)), F.count("application_num")).first()
        paid = "renewals_new" in extracted
        if every > named:
            # Payments without an application are counted together: nothing can be left out.
            if paid:
                self.staged("renewals_new", columns=columns)
                self.payments = self.counted_payments
            return self
        cut = extracts.of_applications(self.src, applications, stage, hashed=every > extracts.FEW_APPLICATIONS)
        out, of = Pipeline(self.src, self.cfg), Pipeline(cut, self.cfg)
        # The merge reads the new system's renewals twice.
        of.staged("renewals_new", columns=columns)
        for name in {*PERIOD_EXTRACTS[:2], *LOR_EXTRACTS, "lor", *extracted}:
            setattr(out, name, getattr(of, name))
        if paid:
            out.payments = of.counted_payments
        return out

    def bucket_staged(self, *names: str) -> "Pipeline":
        """``staged``, with renewals and licences of right in buckets of application_num first.

        Due dates, endorsement and ranges then work on co-located rows without an
        exchange on that key. An application that holds a large part of a table would fill one bucket: then
        the tables are stored plainly and adaptive execution splits the joins.
        """
        names = tuple(n for n in names if n not in BUCKETED)
        buckets = int(self.src.standing.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        stored = [stage_buckets(getattr(self, name), name, "application_num", buckets) for name in BUCKETED]
        self.renewals, self.lor = (df for df, _ in stored)
        self.bucketed = all(done for _, done in stored)
        return self.staged(*names)

    # ---- extracts ----------------------------------------------------------
    @cached_property
    def renewals_new(self) -> DataFrame:
        return extracts.renewals_new(self.src)

    @cached_property
    def renewals_legacy(self) -> DataFrame:
        return extracts.renewals_legacy(self.src)

    @cached_property
    def restorations_legacy(self) -> DataFrame:
        return extracts.restorations_legacy(self.src)

    @cached_property
    def restorations_new(self) -> DataFrame:
        return extracts.restorations_new(self.src)

    @cached_property
    def lor_legacy(self) -> DataFrame:
        return extracts.lor_legacy(self.src)

    @cached_property
    def lor_new(self) -> DataFrame:
        return extracts.lor_new(self.src)

    @cached_property
    def lapses_legacy(self) -> DataFrame:
        return extracts.lapses_legacy(self.src, self.cfg.start, self.cfg.end, self.cfg.ep_prefix)

    @cached_property
    def lapses_new(self) -> DataFrame:
        return extracts.lapses_new(self.src, self.cfg.start, self.cfg.end, self.cfg.ep_prefix)

    # ---- merges ------------------------------------------------------------
    @cached_property
    def renewals(self) -> DataFrame:
        return merge.priority_merge(self.renewals_new, self.renewals_legacy)

    @cached_property
    def payments(self) -> DataFrame:
        """Renewals as far as rules look at them beyond the period: how many on a day, and their dates by year."""
        return self.renewals

    @cached_property
    def counted_payments(self) -> DataFrame:
        """``payments`` from the extracts, in no more rows than there are payments, also where a right is in the register several times."""
        return merge.priority_merge(extracts.payments(self.renewals_new), extracts.payments_legacy(self.src))

    @cached_property
    def restorations(self) -> DataFrame:
        return merge.dedupe_union(self.restorations_legacy, self.restorations_new, KIND_RESTORATION)

    @cached_property
    def lor(self) -> DataFrame:
        # The union collapses identical rows of a system, so the extracts need not have done so before.
        return merge.dedupe_union(extracts.lor_legacy_rows(self.src), extracts.lor_new_rows(self.src), KIND_LOR)

    @cached_property
    def lapses(self) -> DataFrame:
        return merge.dedupe_union(self.lapses_legacy, self.lapses_new)

    @cached_property
    def history(self) -> DataFrame:
        return merge.history(self.renewals, self.restorations, self.lor)

    # ---- rules -------------------------------------------------------------
    @cached_property
    def renewals_due(self) -> DataFrame:
        return rules.renewal_due_dates(rules.with_payment_counts(self.renewals) if self.bucketed else self.renewals)

    @cached_property
    def renewals_enriched(self) -> DataFrame:
        return rules.lor_endorsement(self.renewals_due, self.lor)

    @cached_property
    def lor_ranges_all(self) -> DataFrame:
        """Ranges including cancellations without an entry (first year null)."""
        return rules.lor_year_ranges(self.lor, self.renewals if self.bucketed else self.payments, keep_unmatched=True, bucketed=self.bucketed)

    @cached_property
    def lor_ranges(self) -> DataFrame:
        return self.lor_ranges_all.where(F.col("gap").isNull()).drop("gap")

    @cached_property
    def fee_table(self) -> DataFrame:
        return rules.minimum_fee_table(self.src.minimum_fee)

    def split(self, renewals: DataFrame) -> DataFrame:
        c = self.cfg
        return rules.fee_splits(renewals, self.fee_table, c.pct_split, c.interest_year3, c.interest_year4)

    # ---- period ------------------------------------------------------------
    def _in_period(self, df: DataFrame) -> DataFrame:
        return reports.in_period(df, self.cfg.start, self.cfg.end, self.cfg.ep_prefix)

    @cached_property
    def renewals_in_period(self) -> DataFrame:
        return self._in_period(self.renewals)

    @cached_property
    def renewals_period(self) -> DataFrame:
        """Period renewals; only the counts of payments per day look beyond the period."""
        if self.bucketed:
            due = rules.renewal_due_dates(self._in_period(rules.with_payment_counts(self.renewals)))
        else:
            due = rules.renewal_due_dates(self.renewals_in_period, self.payments)
        return rules.lor_endorsement(due, self.lor)

    @cached_property
    def restorations_period(self) -> DataFrame:
        return self._in_period(self.restorations)

    @cached_property
    def lor_ranges_period(self) -> DataFrame:
        """``lor_ranges_all`` of the period, for the outputs that list both its ranges and its cancellations without an entry."""
        return self._in_period(self.lor_ranges_all)

    @cached_property
    def lor_period(self) -> DataFrame:
        return self.lor_ranges_period.where(F.col("gap").isNull()).drop("gap")

    @cached_property
    def lor_unmatched_period(self) -> DataFrame:
        return self.lor_ranges_period.where(F.col("gap").isNotNull())

    @cached_property
    def renewals_split(self) -> DataFrame:
        return self.split(self.renewals_period).drop("late_fee", "late_months")

    # ---- reports -----------------------------------------------------------
    @cached_property
    def totals(self) -> DataFrame:
        return reports.grand_totals(self.renewals_split)

    @cached_property
    def monthly_report(self) -> DataFrame:
        return reports.monthly_report(self.renewals_split)

    @cached_property
    def totals_table(self) -> DataFrame:
        return reports.totals_table(self.totals)

    @cached_property
    def monthly_totals(self) -> DataFrame:
        return reports.monthly_totals(self.renewals_split)

    @cached_property
    def status_report(self) -> DataFrame:
        return reports.status_report(self.lapses, self.restorations_period, self.lor_period)

    # ---- exchange file -----------------------------------------------------
    @cached_property
    def renewal_rows(self) -> DataFrame:
        return exchange.renewal_rows(self.renewals_split, self.cfg)

    @cached_property
    def lapse_rows(self) -> DataFrame:
        return exchange.lapse_rows(self.lapses)

    @cached_property
    def restoration_rows(self) -> DataFrame:
        return exchange.restoration_rows(self.restorations_period)

    @cached_property
    def lor_rows(self) -> DataFrame:
        return exchange.lor_rows(self.lor_period)

    @cached_property
    def exchange_lines(self) -> DataFrame:
        return exchange.exchange_lines(self.renewal_rows, self.lapse_rows, self.restoration_rows,
                                       self.lor_rows, self.cfg)

    @cached_property
    def rejects(self) -> DataFrame:
        return exchange.all_rejects(self.renewal_rows, self.lapse_rows, self.restoration_rows,
                                    self.lor_rows, self.cfg, self.lor_unmatched_period)
