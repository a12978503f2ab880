"""Business rules: due dates, licence-of-right endorsement and ranges, fee split."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from annuity.schemas import MONEY, ROWS

# The renewal year that carries the year 3 and 4 minimum fees,
# the fee years concerned, and the last year a licence of right can reduce.
SPLIT_RENEWAL_YEAR = 5
SHARED_FEE_YEARS = (3, 4)
LAST_REDUCED_YEAR = 20
GRACE_MONTHS = 3


def multiple_payment_groups(payments: DataFrame, among: DataFrame | None = None) -> DataFrame:
    """(application_num, date_filed) groups holding more than one payment.

    With ``among`` only the groups that occur in it are counted, over all of ``payments``. A payment with
    ``ROWS`` counts as so many.
    """
    keys = ["application_num", "date_filed"]
    counted = ROWS in payments.columns
    filed = payments.where(F.col("date_filed").isNotNull()).select(*keys, *([ROWS] if counted else []))
    if among is not None:
        wanted = among.select(*[F.col(k).alias(f"_{k}") for k in keys]).distinct()
        filed = filed.join(wanted, F.col("application_num").eqNullSafe(F.col("_application_num"))
                           & (F.col("date_filed") == F.col("_date_filed")), "left_semi")
    return (filed.groupBy(*keys).agg((F.sum(ROWS) if counted else F.count(F.lit(1))).alias("payments"))
            .where(F.col("payments") > 1))


PAYMENTS = "_payments"


def with_payment_counts(payments: DataFrame) -> DataFrame:
    """``payments`` with the size of each row's (application_num, date_filed) group, null where date_filed is.

    For tables bucketed by application_num, where a window over the group needs
    no exchange; a group is then in one task, so the table must hold no huge one.
    """
    group = Window.partitionBy("application_num", "date_filed")
    return payments.withColumn(PAYMENTS, F.when(F.col("date_filed").isNotNull(), F.count(F.lit(1)).over(group)))


def renewal_due_dates(df: DataFrame, payments: DataFrame | None = None) -> DataFrame:
    """Due date of the renewal year a payment settles.

    due = filing date + (renewal_year - 1) years; when the grant falls within
    the three months up to that date, due = grant + 3 months. When more than
    one row shares (application_num, date_filed), every row of that group moves
    on by 12 months. The groups are counted in ``payments`` when ``df`` is only
    a part of them (a period); a ``df`` from ``with_payment_counts`` has them already.

    The group size comes from an aggregate joined back rather than a window:
    the aggregate combines map-side, and the join back can be split by adaptive
    execution when one application holds a huge group, which a window over the
    group could not.
    """
    due = F.add_months(F.col("filing_date"), (F.col("renewal_year") - 1) * 12)
    grant = F.col("grant_date")
    due = F.when((grant >= F.add_months(due, -GRACE_MONTHS)) & (grant <= due),
                 F.add_months(grant, GRACE_MONTHS)).otherwise(due)
    keep = [c for c in df.columns if c not in ("renewal_due_date", "next_renewal_date", PAYMENTS)]
    if PAYMENTS in df.columns:
        shared = F.col(PAYMENTS) > 1
    else:
        counted = multiple_payment_groups(df) if payments is None else multiple_payment_groups(payments, df)
        groups = counted.select(F.col("application_num").alias("_app"), F.col("date_filed").alias("_filed"), "payments")
        df = df.join(groups, F.col("application_num").eqNullSafe(F.col("_app")) & (F.col("date_filed") == F.col("_filed")), "left")
        shared = F.col("payments").isNotNull()
    return df.select(*keep, F.when(shared, F.add_months(due, 12)).otherwise(due).alias("renewal_due_date"))


def lor_pivot(lor: DataFrame) -> DataFrame:
    """Latest entry (A) and cancellation (D) date per application.

    Pivot values are listed, so no job runs to discover them and both columns
    exist even when one kind is absent; ``max`` makes the choice independent
    of row order.
    """
    return lor.groupBy("application_num").pivot("Addition_Deletion", ["A", "D"]).agg(
        F.max("date_processed"))


def lor_endorsement(renewals_due: DataFrame, lor: DataFrame) -> DataFrame:
    """Flag renewals paid while the right was endorsed licence of right.

    comparison = the earlier of due date and processing date; YES when the
    entry is on or before it and there is no cancellation on or before it.
    """
    cmp = F.least(F.col("renewal_due_date"), F.col("date_processed"))
    endorsed = (F.col("A") <= cmp) & ((cmp < F.col("D")) | F.col("D").isNull())
    return renewals_due.join(lor_pivot(lor), "application_num", "left").select(
        *renewals_due.columns,
        cmp.alias("renewal_comparison_date"),
        F.when(endorsed, F.lit("YES")).otherwise(F.lit("NO")).alias("lor_endorsement"))


NO_ENTRY, NO_DATES = "cancellation without entry", "entry without dates"


def lor_year_ranges(lor: DataFrame, renewals: DataFrame, keep_unmatched: bool = False,
                    bucketed: bool = False) -> DataFrame:
    """First and last renewal years reduced by each licence-of-right event.

    Each event gets its ordinal year (year processed - filing year + 1) and
    that year's due date (``renewal_due_dates``). It is "on time" against a
    renewal payment of that (application, year) when it was processed no later
    than the earlier of the due date and the payment (the due date alone where
    there is no payment or it has no date). Payments may disagree, so an event
    has one row per outcome. The earliest and the latest dated payment, and
    whether one has no date, show every outcome there is. They are kept as one row per
    application, a map by year, so no event is multiplied by its payments and
    every join here is on the application alone.

    An entry (A) reduces from its year (the next year when late) to year 20.
    A cancellation (D) closes every range opened for the application: one row
    per first year that its entries have, ending the year before its own when
    on time, else at its own year. First years are made distinct before the
    join, so an application pairs with at most as many as there are years.
    Rows are distinct.

    Rows whose first year is beyond 20 are dropped, as are those without one
    unless ``keep_unmatched``, which adds ``gap``: why there is none. ``bucketed``: both tables are bucketed by
    application_num, and no step exchanges rows by it again.
    """
    year = F.col("renewal_year")
    events = lor.withColumn("renewal_year", (F.year("date_processed") - (F.year("filing_date") - 1)).cast("int"))
    staged = renewal_due_dates(with_payment_counts(events) if bucketed else events)
    of_year = (renewals.where(year.isNotNull()).groupBy("application_num", "renewal_year")
               .agg(F.min("date_processed").alias("first"), F.max("date_processed").alias("last"),
                    F.bool_or(F.col("date_processed").isNull()).alias("undated")))
    paid = of_year.groupBy(F.col("application_num").alias("_payer")).agg(F.map_from_entries(F.collect_list(
        F.struct("renewal_year", F.struct("first", "last", "undated")))).alias("_paid"))
    staged = staged.join(paid, F.col("application_num") == F.col("_payer"), "left")
    of = F.when(year.isNotNull(), F.try_element_at("_paid", year))
    # ``least`` leaves out nulls: without a payment date the due date decides.
    on_time = [F.coalesce(F.col("date_processed") <= F.least(F.col("renewal_due_date"), paid_on), F.lit(False))
               for paid_on in (of["first"], of["last"], F.lit(None).cast("date"))]
    on_time[2] = F.when(of["undated"], on_time[2])
    staged = staged.withColumn("_on_time", F.explode(F.array_distinct(F.array_compact(F.array(*on_time)))))
    own_first = F.when(F.col("_on_time"), year).otherwise(year + 1)
    entry = F.col("Addition_Deletion") == "A"
    opened = staged.where(entry).select(
        F.col("application_num").alias("_app"), own_first.alias("_opened")).distinct()
    first = F.when(entry, own_first).otherwise(F.col("_opened"))
    out = staged.join(opened, (F.col("application_num") == F.col("_app")) & ~entry, "left").select(
        *lor.columns,
        first.alias("first_reduced_year"),
        F.when(entry, F.lit(LAST_REDUCED_YEAR))
        .otherwise(F.when(F.col("_on_time"), year - 1).otherwise(year)).alias("last_reduced_year"),
        F.when(first.isNull(), F.when(~entry & F.col("_app").isNull(), NO_ENTRY).otherwise(NO_DATES)).alias("gap"),
    ).distinct()
    kept = F.col("first_reduced_year") <= LAST_REDUCED_YEAR
    return out.where(kept | F.col("gap").isNotNull()) if keep_unmatched else out.where(kept).drop("gap")


def inverted_ranges(ranges: DataFrame) -> DataFrame:
    """Ranges that end before they start. They are written as they are; the run counts them for someone to look at."""
    return ranges.where(F.col("last_reduced_year") < F.col("first_reduced_year"))


def minimum_fee_table(fee_rows: DataFrame) -> DataFrame:
    """One row per year: the year 3 and year 4 minimum fees in force that year.

    Fails when a year holds two different amounts for one fee year.
    """
    fy = F.col("minimum_fee_year").cast("int")
    amount = F.col("minimum_fee_amount").cast(MONEY)
    low_high = [f(F.when(F.col("fy") == y, F.col("amt"))).alias(f"_{name}{y}")
                for y in SHARED_FEE_YEARS for name, f in (("low", F.min), ("high", F.max))]
    two = F.raise_error(F.concat(F.lit("two minimum fees for "), F.col("year_set").cast("string"))).cast(MONEY)
    return (fee_rows
            .select(F.col("year_set").cast("int").alias("year_set"), fy.alias("fy"), amount.alias("amt"))
            .where(F.col("fy").isin(*SHARED_FEE_YEARS))
            .groupBy("year_set").agg(*low_high)
            .select("year_set", *[F.when(F.col(f"_low{y}") < F.col(f"_high{y}"), two)
                                  .otherwise(F.col(f"_high{y}")).alias(f"fee{y}") for y in SHARED_FEE_YEARS]))


def fee_splits(renewals: DataFrame, fees: DataFrame, pct_split: int,
               interest_year3: Decimal = Decimal("0.00"),
               interest_year4: Decimal = Decimal("0.00")) -> DataFrame:
    """Regional office's share of each renewal.

    For y in 3, 4: a year-5 renewal of a right granted no later than y-1 years
    after filing owes the minimum fee for year y in force in year
    year(due) - (5 - y); other renewals owe 0. A missing minimum fee stays
    null. share = round(fee * pct / 100, 2);
    total = round(share + fee3 + fee4 + interest3 + interest4, 2).
    ``fees`` is ``minimum_fee_table`` output; how it is joined is left to Spark's size
    estimates and adaptive execution.
    """
    due_year = F.year("renewal_due_date")
    out = renewals
    for y in SHARED_FEE_YEARS:
        lookup = fees.select(F.col("year_set").alias(f"_ys{y}"), F.col(f"fee{y}").alias(f"_min{y}"))
        out = out.join(lookup, (due_year - (5 - y)) == F.col(f"_ys{y}"), "left")
    owed = {y: (F.col("grant_date") <= F.add_months("filing_date", 12 * (y - 1)))
            & (F.col("renewal_year") == SPLIT_RENEWAL_YEAR) for y in SHARED_FEE_YEARS}
    fee = {y: F.when(owed[y], F.col(f"_min{y}")).otherwise(F.lit(Decimal("0.00"))).cast(MONEY)
           for y in SHARED_FEE_YEARS}
    prescribed = F.col("renewal_fee").cast(MONEY)
    share = F.round(prescribed * F.lit(Decimal(pct_split).scaleb(-2)), 2).cast(MONEY)
    interest = F.lit(Decimal(interest_year3) + Decimal(interest_year4))
    keep = [c for c in renewals.columns if c != "renewal_fee"]
    return out.select(
        *keep,
        prescribed.alias("renewal_fee"),
        *[fee[y].alias(f"renewal_fee_year{y}") for y in SHARED_FEE_YEARS],
        share.alias("renewal_fee_epo"),
        F.round(share + fee[3] + fee[4] + interest, 2).cast(MONEY).alias("total_epo_amount"))
