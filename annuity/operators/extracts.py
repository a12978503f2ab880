"""Event extracts from the two source systems.

Each extract is a join of source tables plus a projection onto canonical
columns. A filter on the optional side of an outer join would discard the
unmatched rows anyway, so such joins are written as inner joins; filters on
stored columns are written so Catalyst can push them into the scans.
Publication numbers are trimmed everywhere so keys compare equal across
systems.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from decimal import Decimal
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annuity.schemas import MONEY, ROWS
from annuity.sources.tables import SourceTables

# Form types in the legacy forms log.
FORM_RENEWAL = 12
FORM_RESTORATION = 16
FORM_LOR_ENTRY = 28
FORM_LOR_CANCEL = 30

# Case categories in the new system.
CATEGORY_RESTORATION = 31
CATEGORY_LOR = 17
LAPSE_CATEGORIES = ["Cessation", "Expiry", "Surrender", "Revocation"]

# Legacy reason-not-in-force codes and their descriptions.
LEGACY_LAPSE_REASONS = {"00": "Ceased", "04": "Expired", "05": "Surrendered", "07": "Revoked"}

SERVICE_RENEWAL = "Renewals"


def _pub(col: str = "publication_num") -> F.Column:
    return F.trim(F.col(col)).alias("publication_num")


def one_fee_per_right(fees: DataFrame) -> DataFrame:
    """(right_id, total_fee): fails when a right has several fee rows, which would multiply its payments."""
    several = F.raise_error(F.concat(F.lit("several fee rows for right "), F.col("right_id").cast("string")))
    return (fees.where(F.col("right_id").isNotNull()).groupBy("right_id")
            .agg(F.max("total_fee").alias("_fee"), F.count(F.lit(1)).alias("_rows"))
            .select("right_id", F.when(F.col("_rows") == 1, F.col("_fee")).otherwise(several.cast(MONEY))
                    .alias("total_fee")))


def applications_dated(src: SourceTables, extracted: str, start: dt.date, end: dt.date, ep_prefix: str = "EP") -> DataFrame:
    """(application_num): among them every application with a row of this extract in the period.

    An extract's ``date_processed`` is one of a few stored columns. Each table is filtered by its own, so the two large sides
    of an extract are not joined here; applications whose row drops out in that join are included too.
    """
    def dated(*columns: str) -> F.Column:
        return reduce(lambda a, b: a | b, [_between(c, start, end) for c in columns])

    ep = F.trim("publication_num").startswith(ep_prefix)

    def forms(form_type: int) -> DataFrame:
        # Without an application a form finds no right, so no publication and no period.
        return (src.formslog.where((F.col("form_type_num") == form_type) & dated("date_actioned") & F.col("case_key").isNotNull())
                .select(F.col("case_key").alias("application_num")).distinct())

    def of_rights(rights: DataFrame, rows: DataFrame) -> DataFrame:
        return _among(rights.where(ep), "right_id", rows, "right_id").select("application_num")

    if extracted == "renewals_new":
        return of_rights(src.right, src.incident.where(dated("date_completed")))
    if extracted == "renewals_legacy":
        return forms(FORM_RENEWAL)
    if extracted == "lor_legacy":
        own = src.standing.where(ep & dated("date_of_lor", "date_lor_cancel") & F.col("application_num").isNotNull())
        return forms(FORM_LOR_ENTRY).unionByName(own.select("application_num"))
    if extracted == "lor_new":
        return of_rights(src.register_right, src.licenceofright.where(dated("lor_granted_date", "lor_cancelled_date")))
    if extracted == "restorations_legacy":
        return src.standing.where(ep & dated("restore_allowed_date") & F.col("application_num").isNotNull()).select("application_num")
    if extracted == "restorations_new":
        return src.register_right.where(ep & dated("restoration_date")).select("application_num")
    raise ValueError(f"no extract of whole applications: {extracted}")


def _among(df: DataFrame, column: str, of: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` whose ``column`` is a ``key`` of ``of``."""
    return df.join(of.select(F.col(key).alias("_among")), F.col(column) == F.col("_among"), "left_semi")


# Up to so many applications the joins are left to Spark, which may broadcast them. Of more, the few are hashed
# after the exchange, so that the large tables need no sort.
FEW_APPLICATIONS = 1_000_000


def of_applications(src: SourceTables, applications: DataFrame, stored: Callable[[DataFrame, str], DataFrame],
                    hashed: bool = False) -> SourceTables:
    """The sources that renewals, restorations and licences of right of these applications (``application_num``, none null) come from.

    For extracts of whole applications only: their rows are all there, and no others. Other tables are as they are.
    ``stored`` (rows, table name) keeps what an extract reads, so that a large table is gone through once: incidents and cases
    without their own ids, and cases of the categories that are extracted. ``hashed``:
    the applications are more than ``FEW_APPLICATIONS``.
    """
    few = lambda df: df.hint("shuffle_hash") if hashed else df

    def own(table: str, column: str = "application_num") -> Callable[[], DataFrame]:
        return lambda: stored(_among(getattr(src, table), column, few(applications), "application_num"), table)

    def of_right(table: str, rights: str, read: Callable[[DataFrame], DataFrame]) -> Callable[[], DataFrame]:
        return lambda: stored(_among(read(getattr(src, table)), "right_id", few(getattr(out, rights)), "right_id"), table)

    def cases(df: DataFrame) -> DataFrame:
        return df.where(F.col("case_category_id").isin(CATEGORY_RESTORATION, CATEGORY_LOR)).drop("case_id")

    out = src.replaced(
        standing=own("standing"), formslog=own("formslog", "case_key"), right=own("right"), incident=of_right("incident", "right", lambda df: df.drop("incident_id")),
        register_right=own("register_right"), case=of_right("case", "register_right", cases))
    return out


def renewals_new(src: SourceTables) -> DataFrame:
    """Renewal payments recorded as service requests in the new system."""
    i = src.incident.alias("i")
    sr = src.servicerequest.where(F.col("type_name") == SERVICE_RENEWAL).alias("sr")
    r = src.right.alias("r")
    fee = one_fee_per_right(src.fees).alias("f")
    year = F.coalesce(
        F.col("sr.renewal_year"),
        F.col("r.renewal_year"),
        F.year("i.date_completed") - F.year("r.filing_date") + 1,
    ).cast("int")
    return (
        i.join(sr, F.col("i.servicerequest_id") == F.col("sr.id"), "inner")
        .join(r, F.col("i.right_id") == F.col("r.right_id"), "left")
        .join(fee, F.col("r.right_id") == F.col("f.right_id"), "left")
        .select(
            F.col("r.application_num").alias("application_num"),
            _pub("r.publication_num"),
            F.col("r.filing_date").alias("filing_date"),
            F.col("r.grant_date").alias("grant_date"),
            year.alias("renewal_year"),
            F.coalesce(F.col("f.total_fee"), F.lit(Decimal("0.00"))).cast(MONEY).alias("renewal_fee"),
            F.col("sr.prescribed_uk_fee").cast(MONEY).alias("prescribed_uk_fee"),
            F.col("sr.lor_indicator").alias("lor_indicator"),
            F.coalesce(F.col("r.next_renewal_date"),
                       F.add_months(F.col("r.filing_date"), year * 12)).alias("renewal_due_date"),
            F.col("i.date_filed").alias("date_filed"),
            F.col("i.date_completed").alias("date_processed"),
        )
    )


def renewals_legacy(src: SourceTables) -> DataFrame:
    """Renewal forms in the legacy forms log with the right's standing data."""
    f = src.formslog.where(F.col("form_type_num") == FORM_RENEWAL).alias("f")
    s = src.standing.alias("s")
    return f.join(s, F.col("f.case_key") == F.col("s.application_num"), "left").select(
        F.col("f.case_key").alias("application_num"),
        _pub("s.publication_num"),
        F.col("s.filing_date").alias("filing_date"),
        F.col("s.grant_date").alias("grant_date"),
        F.col("f.last_renewal_year").cast("int").alias("renewal_year"),
        F.col("f.fee_taken").cast(MONEY).alias("renewal_fee"),
        F.col("f.extension_fee_taken").cast(MONEY).alias("late_fee"),
        F.col("f.extension_months").cast("int").alias("late_months"),
        F.col("s.renewal_date").alias("next_renewal_date"),
        F.col("f.date_filed").alias("date_filed"),
        F.col("f.date_actioned").alias("date_processed"),
    )


PAYMENT_COLUMNS = ["application_num", "publication_num", "renewal_year", "date_filed", "date_processed"]


def payments(renewals: DataFrame) -> DataFrame:
    """The columns of renewals that rules look at beyond the period, with the number of rows each stands for."""
    return renewals.select(*PAYMENT_COLUMNS, F.lit(1).cast("long").alias(ROWS))


def payments_legacy(src: SourceTables) -> DataFrame:
    """``payments`` of ``renewals_legacy``, whose rows of one form and publication number are one row here.

    Where the register holds an application number several times, each form has a row per right. The rights are
    counted before the join, which so yields no more rows than there are forms and publication numbers.
    """
    f = src.formslog.where(F.col("form_type_num") == FORM_RENEWAL).alias("f")
    s = src.standing.groupBy("application_num", _pub()).agg(F.count(F.lit(1)).alias(ROWS)).alias("s")
    return f.join(s, F.col("f.case_key") == F.col("s.application_num"), "left").select(
        F.col("f.case_key").alias("application_num"),
        F.col("s.publication_num").alias("publication_num"),
        F.col("f.last_renewal_year").cast("int").alias("renewal_year"),
        F.col("f.date_filed").alias("date_filed"),
        F.col("f.date_actioned").alias("date_processed"),
        F.coalesce(F.col(f"s.{ROWS}"), F.lit(1)).cast("long").alias(ROWS),
    )


def restorations_legacy(src: SourceTables) -> DataFrame:
    s = src.standing.where(F.col("restore_date").isNotNull()).alias("s")
    f = src.formslog.where(F.col("form_type_num") == FORM_RESTORATION).alias("f")
    return s.join(f, F.col("s.application_num") == F.col("f.case_key"), "inner").select(
        F.col("s.application_num").alias("application_num"),
        _pub("s.publication_num"),
        F.col("s.filing_date").alias("filing_date"),
        F.col("s.grant_date").alias("grant_date"),
        F.col("f.date_filed").alias("date_filed"),
        F.col("s.restore_allowed_date").alias("date_processed"),
    )


def restorations_new(src: SourceTables) -> DataFrame:
    r = src.register_right.where(F.col("restoration_date").isNotNull()).alias("r")
    c = src.case.where(F.col("case_category_id") == CATEGORY_RESTORATION).alias("c")
    return r.join(c, F.col("r.right_id") == F.col("c.right_id"), "inner").select(
        F.col("r.application_num").alias("application_num"),
        _pub("r.publication_num"),
        F.col("r.filing_date").alias("filing_date"),
        F.col("r.grant_date").alias("grant_date"),
        F.col("c.case_create_date").alias("date_filed"),
        F.col("r.restoration_date").alias("date_processed"),
    )


def lor_legacy(src: SourceTables) -> DataFrame:
    """Licence-of-right entries (A) and cancellations (D) from the legacy system; identical rows collapse (UNION semantics)."""
    return lor_legacy_rows(src).distinct()


def lor_legacy_rows(src: SourceTables) -> DataFrame:
    """``lor_legacy`` before identical rows collapse, for a union that collapses them.

    Entries and cancellations come from one join of the register with the two
    form types; the event date is picked per form type and rows without one
    are dropped.
    """
    s = src.standing.alias("s")
    # Repeated forms make repeated rows, which collapse in any case.
    f = (src.formslog.where(F.col("form_type_num").isin(FORM_LOR_ENTRY, FORM_LOR_CANCEL))
         .select("case_key", "form_type_num", "date_filed", "date_actioned").distinct().alias("f"))
    entry = F.col("f.form_type_num") == FORM_LOR_ENTRY
    processed = F.when(entry, F.coalesce(F.col("f.date_actioned"), F.col("s.date_of_lor"))).otherwise(
        F.col("s.date_lor_cancel"))
    return (
        s.join(f, F.col("s.application_num") == F.col("f.case_key"), "inner")
        .select(
            F.col("s.application_num").alias("application_num"),
            _pub("s.publication_num"),
            F.col("s.filing_date").alias("filing_date"),
            F.col("s.grant_date").alias("grant_date"),
            F.col("f.date_filed").alias("date_filed"),
            processed.alias("date_processed"),
            F.when(entry, F.lit("A")).otherwise(F.lit("D")).alias("Addition_Deletion"),
        )
        .where(F.col("date_processed").isNotNull())
    )


def lor_new(src: SourceTables) -> DataFrame:
    """Licence-of-right grants (A) and cancellations (D) from the new system; identical rows collapse."""
    return lor_new_rows(src).distinct()


def lor_new_rows(src: SourceTables) -> DataFrame:
    """``lor_new`` before identical rows collapse, for a union that collapses them.

    One join yields both events of a licence: ``inline`` emits an (A, granted)
    and a (D, cancelled) row per joined row, and rows without a date drop out.
    """
    lic = src.licenceofright.alias("l")
    r = src.register_right.alias("r")
    c = src.case.where(F.col("case_category_id") == CATEGORY_LOR).alias("c")
    events = F.inline(F.array(
        F.struct(F.col("l.lor_granted_date").alias("date_processed"), F.lit("A").alias("Addition_Deletion")),
        F.struct(F.col("l.lor_cancelled_date").alias("date_processed"), F.lit("D").alias("Addition_Deletion")),
    ))
    return (
        lic.join(r, F.col("l.right_id") == F.col("r.right_id"), "inner")
        .join(c, F.col("r.right_id") == F.col("c.right_id"), "inner")
        .select(
            F.col("r.application_num").alias("application_num"),
            _pub("r.publication_num"),
            F.col("r.filing_date").alias("filing_date"),
            F.col("r.grant_date").alias("grant_date"),
            F.col("c.case_create_date").alias("date_filed"),
            events,
        )
        .where(F.col("date_processed").isNotNull())
    )


def _between(col: str, start: dt.date, end: dt.date) -> F.Column:
    return F.col(col).between(F.lit(start), F.lit(end))


def lapses_legacy(src: SourceTables, start: dt.date, end: dt.date, ep_prefix: str = "EP") -> DataFrame:
    """Rights recorded as not in force whose register entry falls in the period."""
    s = (src.standing
         .where(F.col("date_not_in_force").isNotNull()
                & F.col("reason_not_in_force").isin(*LEGACY_LAPSE_REASONS)
                & F.trim("publication_num").startswith(ep_prefix))
         .alias("s"))
    h = src.reghist.where(_between("reg_date", start, end)).alias("h")
    reason = F.coalesce(*[F.when(F.col("s.reason_not_in_force") == code, F.lit(text))
                          for code, text in LEGACY_LAPSE_REASONS.items()])
    return s.join(
        h,
        (F.col("s.application_num") == F.col("h.case_key"))
        & (F.col("s.date_not_in_force") == F.col("h.event_date")),
        "inner",
    ).select(
        _pub("s.publication_num"),
        F.col("s.filing_date").alias("filing_date"),
        reason.alias("lapsed_reason"),
        F.col("s.date_not_in_force").alias("lapsed_date"),
        F.col("h.event_date").alias("date_processed"),
    )


def lapses_new(src: SourceTables, start: dt.date, end: dt.date, ep_prefix: str = "EP") -> DataFrame:
    """Register events in the period for lapse-type cases of EP rights."""
    c = src.case.alias("c")
    cc = src.casecategory.where(F.col("case_category").isin(*LAPSE_CATEGORIES)).alias("cc")
    re_ = src.registerevent.where(
        _between("event_date", start, end) & (F.col("register_indicator") == 1)).alias("re")
    r = src.register_right.where(F.trim("publication_num").startswith(ep_prefix)).alias("r")
    t = src.terminationreason.alias("t")
    return (
        c.join(cc, F.col("c.case_category_id") == F.col("cc.case_category_id"), "inner")
        .join(re_, F.col("c.case_id") == F.col("re.case_id"), "inner")
        .join(r, F.col("c.right_id") == F.col("r.right_id"), "inner")
        .join(t, F.col("r.termination_reason_id") == F.col("t.termination_reason_id"), "left")
        .select(
            _pub("r.publication_num"),
            F.col("r.filing_date").alias("filing_date"),
            F.col("t.description").alias("lapsed_reason"),
            F.col("r.termination_date").alias("lapsed_date"),
            F.col("re.event_date").alias("date_processed"),
        )
    )


def incident_join_chain(src: SourceTables) -> DataFrame:
    """The new system's left-join chain incident -> request -> right -> fees, unfiltered."""
    i = src.incident.alias("i")
    sr = src.servicerequest.alias("sr")
    r = src.right.alias("r")
    fee = one_fee_per_right(src.fees).alias("f")
    return (
        i.join(sr, F.col("i.servicerequest_id") == F.col("sr.id"), "left")
        .join(r, F.col("i.right_id") == F.col("r.right_id"), "left")
        .join(fee, F.col("r.right_id") == F.col("f.right_id"), "left")
        .select(
            F.col("i.incident_id").alias("incident_id"),
            F.col("sr.type_name").alias("type_name"),
            F.col("r.application_num").alias("application_num"),
            F.col("i.date_filed").alias("date_filed"),
            F.col("f.total_fee").alias("total_fee"),
        )
    )
