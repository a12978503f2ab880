"""Fixed-width exchange file: typed 80-character records, header, trailer, rejects, and reading it back.

``LAYOUTS`` holds every record type as slots (name, width, kind); the writer
builds lines from it and the reader cuts them by it. Blanks are written as
``_`` until the line is accepted. Dates are ddMMyy, money is the whole part
and two decimals without a point.

  100 header, 200 renewal, 400 lapse, 500 restoration, 600 licence of right, 900 trailer

A renewal has a line of its own (its year, both amounts and the share) and
before it one line each for its year 3 and year 4 minimum fee, when that fee is at
least 1.00: year 03 or 04, nothing prescribed, the fee remitted.

A row with a missing required field, an unknown code or a field that does not
have its width goes to the rejects table with a reason. Rows that agree in
every field a record is made of are one row with their number; the repeats
are rejected as such. Lines are never made distinct after that: two payments of one day that
share a year 3 line both remit it. So the amounts of the lines add up to the
trailer (plus interest, which has no line), and the trailer plus the rejected
amounts are the totals of the period. ``reconciled`` checks this on the file as read back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from annuity.config import RunConfig
from annuity.functions import BLANK, Field, Layout, Slot, fixed_width, wrong_width
from annuity.schemas import MONEY, MONEY_SUM

RECORD_LENGTH = 80

# Record type codes and constant fields.
TYPE_HEADER, TYPE_RENEWAL, TYPE_LAPSE, TYPE_RESTORATION, TYPE_LOR, TYPE_TRAILER = 100, 200, 400, 500, 600, 900
DETAIL_TYPES = (TYPE_RENEWAL, TYPE_LAPSE, TYPE_RESTORATION, TYPE_LOR)
COUNTRY, CURRENCY = "GB", "GBP"
TRAILER_REFERENCE = "POA 35/28"
LOR_REDUCTION_PCT = "50"
# Lapse reason -> code; other reasons have no code ("Expired" rows are left out).
LAPSE_CODES = {"Ceased": "00", "Surrendered": "05", "Revoked": "07"}
EXCLUDED_LAPSE_REASON = "Expired"

RENEWAL_REQUIRED = [
    "publication_num", "filing_date", "renewal_due_date", "renewal_year", "lor_endorsement",
    "renewal_fee", "renewal_fee_epo", "renewal_fee_year3", "renewal_fee_year4",
    "total_epo_amount", "date_filed",
]
LAPSE_REQUIRED = ["publication_num", "filing_date", "lapsed_reason", "date_processed"]
RESTORATION_REQUIRED = ["publication_num", "filing_date", "date_processed"]
LOR_REQUIRED = ["publication_num", "filing_date", "date_processed", "Addition_Deletion",
                "first_reduced_year", "last_reduced_year"]


def _lit(s: str) -> Column:
    return F.lit(s)


_PUBLICATION = (Slot("record_type", 3), Slot("publication_prefix", 4), Slot("publication_number", 8))
# The record layouts.
LAYOUTS = {layout.record_type: layout for layout in (
    Layout(TYPE_HEADER, (
        Slot("record_type", 3), Slot("space1", 13, "blank"), Slot("start", 6, "date"), Slot("end", 6, "date"),
        Slot("country", 2), Slot("currency", 3), Slot("space2", 47, "blank"))),
    Layout(TYPE_RENEWAL, (
        *_PUBLICATION, Slot("payment_indicator", 1), Slot("filing_date", 6, "date"), Slot("renewal_due_date", 6, "date"),
        Slot("space", 2, "blank"), Slot("renewal_year", 2, "int"), Slot("reduced", 2), Slot("currency", 2, "blank"),
        Slot("prescribed", 10, "money"), Slot("remitted", 10, "money"), Slot("pct_split", 4), Slot("date_filed", 6, "date"),
        Slot("zeros", 10), Slot("end", 4, "blank"))),
    Layout(TYPE_LAPSE, (
        *_PUBLICATION, Slot("update_indicator", 1), Slot("filing_date", 6, "date"), Slot("space1", 10, "blank"),
        Slot("lapse_code", 2), Slot("space2", 26, "blank"), Slot("lapse_date", 6, "date"), Slot("space3", 14, "blank"))),
    Layout(TYPE_RESTORATION, (
        *_PUBLICATION, Slot("update_indicator", 1), Slot("filing_date", 6, "date"), Slot("space1", 38, "blank"),
        Slot("restore_date", 6, "date"), Slot("space2", 14, "blank"))),
    Layout(TYPE_LOR, (
        *_PUBLICATION, Slot("update_indicator", 1), Slot("filing_date", 6, "date"), Slot("lor_date", 6, "date"),
        Slot("first_reduced_year", 2, "int"), Slot("last_reduced_year", 2, "int"), Slot("pct_reduction", 2),
        Slot("space", 46, "blank"))),
    Layout(TYPE_TRAILER, (
        Slot("record_type", 3), Slot("space1", 12, "blank"), Slot("indicator", 1), Slot("space2", 2, "blank"),
        Slot("prescribed", 15, "money"), Slot("remitted", 15, "money"), Slot("run_date", 6, "date"), Slot("reference", 9),
        Slot("space3", 17, "blank"))),
)}
# A year 3 or 4 line has no share of its own.
NO_SHARE = "0000"


def _publication() -> dict[str, Column]:
    pub = F.col("publication_num")
    return {"publication_prefix": F.concat(_lit(BLANK), F.substring(pub, 1, 2), _lit("B")),
            "publication_number": F.concat(_lit(BLANK), F.substring(pub, 3, 1 << 20)),
            "filing_date": F.col("filing_date")}


def _renewal_fields(year: Column, reduced: Column, prescribed: Column, remitted: Column, pct: str) -> list[Field]:
    return LAYOUTS[TYPE_RENEWAL].fields(
        **_publication(), payment_indicator=_lit("C"), renewal_due_date=F.col("renewal_due_date"), renewal_year=year,
        reduced=reduced, prescribed=prescribed, remitted=remitted, pct_split=_lit(pct), date_filed=F.col("date_filed"),
        zeros=_lit("0" * 10))


def renewal_layout(pct_split: int) -> list[Field]:
    reduced = F.when(F.col("lor_endorsement") == "NO", _lit("00")).otherwise(_lit("02"))
    return _renewal_fields(F.col("renewal_year"), reduced, F.col("renewal_fee"), F.col("renewal_fee_epo"), f"{pct_split}00")


def year_share_layout(year: int) -> list[Field]:
    return _renewal_fields(F.lit(year), _lit("00"), F.lit(0).cast(MONEY), F.col(f"renewal_fee_year{year}"), NO_SHARE)


def lapse_layout() -> list[Field]:
    code = F.coalesce(*[F.when(F.col("lapsed_reason") == k, _lit(v)) for k, v in LAPSE_CODES.items()], _lit(""))
    return LAYOUTS[TYPE_LAPSE].fields(**_publication(), update_indicator=_lit(BLANK), lapse_code=code,
                                      lapse_date=F.col("date_processed"))


def restoration_layout() -> list[Field]:
    return LAYOUTS[TYPE_RESTORATION].fields(**_publication(), update_indicator=_lit(BLANK), restore_date=F.col("date_processed"))


def lor_layout() -> list[Field]:
    return LAYOUTS[TYPE_LOR].fields(
        **_publication(), update_indicator=F.when(F.col("Addition_Deletion") == "A", _lit(BLANK)).otherwise(_lit("D")),
        lor_date=F.col("date_processed"), first_reduced_year=F.col("first_reduced_year"),
        last_reduced_year=F.col("last_reduced_year"), pct_reduction=_lit(LOR_REDUCTION_PCT))


# A missing minimum fee leaves the renewal's year 3 or 4 amount empty.
MISSING_REASONS = {"renewal_fee_year3": "no minimum fee for year 3", "renewal_fee_year4": "no minimum fee for year 4"}
UNKNOWN_LAPSE = "unknown lapse reason"
DUPLICATES = {TYPE_RENEWAL: "duplicate payment"}
DUPLICATE_EVENT = "duplicate event"


def missing_reason(required: list[str]) -> Column:
    """Why the first required column that is null is missing, else null."""
    return F.coalesce(*[F.when(F.col(c).isNull(), _lit(MISSING_REASONS.get(c, f"missing {c}"))) for c in required])


def _checked(df: DataFrame, required: list[str], layouts: list[tuple[Column, list[Field]]],
             unknown: Column | None = None, where: Column | None = None) -> DataFrame:
    """One row per different record with ``_copies``, ``_lines`` (array) and ``_reason`` (null when accepted).

    Rows equal in every field of their lines are one, counted with partial
    sums. ``layouts``: the row's lines in order, each with the condition under
    which it is written. ``unknown``: a reason of its own, looked at once no field is
    missing. ``where`` keeps only the caller's rows.
    """
    if where is not None:
        df = df.where(where)
    missing = missing_reason(required)
    lines = F.filter(F.array(*[F.when(on, fixed_width(fields)) for on, fields in layouts]), lambda x: x.isNotNull())
    wrong = F.coalesce(*[F.when(on, wrong_width(fields)) for on, fields in layouts])
    return (df.groupBy(*required).agg(F.count(F.lit(1)).alias("_copies"))
            .withColumn("_lines", F.when(missing.isNull(), lines))
            .withColumn("_reason", F.coalesce(missing, *([] if unknown is None else [unknown]), wrong)))


def renewal_rows(split: DataFrame, cfg: RunConfig, where: Column | None = None) -> DataFrame:
    """Period renewals with their lines and reject reason (null when accepted)."""
    layouts = [(F.col(f"renewal_fee_year{y}") >= 1, year_share_layout(y)) for y in (3, 4)]
    return _checked(split, RENEWAL_REQUIRED, [*layouts, (F.lit(True), renewal_layout(cfg.pct_split))], where=where)


def not_expired() -> Column:
    return ~F.col("lapsed_reason").eqNullSafe(EXCLUDED_LAPSE_REASON)


def lapse_rows(lapses: DataFrame, where: Column | None = None) -> DataFrame:
    """Lapses but the expired ones; ``where`` replaces that choice."""
    unknown = F.when(~F.col("lapsed_reason").isin(*LAPSE_CODES), _lit(UNKNOWN_LAPSE))
    return _checked(lapses, LAPSE_REQUIRED, [(F.lit(True), lapse_layout())], unknown,
                    not_expired() if where is None else where)


def restoration_rows(restorations: DataFrame, where: Column | None = None) -> DataFrame:
    return _checked(restorations, RESTORATION_REQUIRED, [(F.lit(True), restoration_layout())], where=where)


def lor_rows(lor_ranges: DataFrame, where: Column | None = None) -> DataFrame:
    return _checked(lor_ranges, LOR_REQUIRED, [(F.lit(True), lor_layout())], where=where)


def records(rows: DataFrame, record_type: int) -> DataFrame:
    """Accepted lines of one record type: (publication_num, type, record)."""
    return (rows.where(F.col("_reason").isNull())
            .select("publication_num", F.lit(record_type).alias("type"),
                    F.explode("_lines").alias("record")))


REJECT_AMOUNTS = {"prescribed": "renewal_fee", "remitted": "total_epo_amount"}


def _reject_columns(record_type: int, reason: Column, record: Column, payments: Column,
                    amounts: dict[str, Column]) -> list[Column]:
    none = F.lit(None).cast(MONEY_SUM)
    return [F.lit(record_type).alias("type"), F.col("publication_num"), reason.alias("reason"), record.alias("record"),
            payments.cast("long").alias("payments"),
            *[amounts.get(name, none).cast(MONEY_SUM).alias(name) for name in REJECT_AMOUNTS]]


def rejects(rows: DataFrame, record_type: int) -> DataFrame:
    """Rejected rows of one record type with their reason and, for renewals, their amounts.

    A row stands for ``_copies`` equal rows: all of them when it is rejected,
    else all but the one that is written.
    """
    record = F.array_join("_lines", "|")
    repeated = F.col("_reason").isNull()
    n = F.when(repeated, F.col("_copies") - 1).otherwise(F.col("_copies"))
    amounts = {name: F.col(c) * n for name, c in REJECT_AMOUNTS.items()} if record_type == TYPE_RENEWAL else {}
    reason = F.coalesce("_reason", _lit(DUPLICATES.get(record_type, DUPLICATE_EVENT)))
    return rows.where(~repeated | (F.col("_copies") > 1)).select(*_reject_columns(record_type, reason, record, n, amounts))


def control_lines(accepted_renewals: DataFrame, cfg: RunConfig) -> DataFrame:
    """Header and trailer from one aggregate over the accepted renewal rows."""
    totals = accepted_renewals.agg(
        F.coalesce(F.sum("renewal_fee"), F.lit(0)).cast("decimal(18,2)").alias("_prescribed"),
        F.coalesce(F.sum("total_epo_amount"), F.lit(0)).cast("decimal(18,2)").alias("_remitted"))
    start, end = cfg.period
    header = fixed_width(LAYOUTS[TYPE_HEADER].fields(start=F.lit(start), end=F.lit(end), country=_lit(COUNTRY),
                                                     currency=_lit(CURRENCY)))
    trailer = fixed_width(LAYOUTS[TYPE_TRAILER].fields(
        indicator=_lit("C"), prescribed=F.col("_prescribed"), remitted=F.col("_remitted"), run_date=F.lit(cfg.run_date),
        reference=_lit(TRAILER_REFERENCE)))
    return totals.select(F.inline(F.array(
        F.struct(F.lit(TYPE_HEADER).alias("type"), header.alias("record")),
        F.struct(F.lit(TYPE_TRAILER).alias("type"), trailer.alias("record")))))


def exchange_lines(renewals: DataFrame, lapses: DataFrame, restorations: DataFrame,
                   lor: DataFrame, cfg: RunConfig) -> DataFrame:
    """All accepted lines with blanks as spaces: (type, record).

    Inputs are the ``*_rows`` outputs, in which repeats are one row already.
    Ordering is left to the sink.
    """
    details = (records(renewals, TYPE_RENEWAL)
               .unionByName(records(lapses, TYPE_LAPSE))
               .unionByName(records(restorations, TYPE_RESTORATION))
               .unionByName(records(lor, TYPE_LOR))
               .select("type", "record"))
    control = control_lines(renewals.where(F.col("_reason").isNull()), cfg)
    return (details.unionByName(control)
            .where(F.length("record") == RECORD_LENGTH)
            .select("type", F.translate("record", BLANK, " ").alias("record")))


def all_rejects(renewals: DataFrame, lapses: DataFrame, restorations: DataFrame,
                lor: DataFrame, cfg: RunConfig, unmatched_lor: DataFrame | None = None) -> DataFrame:
    """Every rejected row with its reason, including an over-long header or trailer."""
    control = control_lines(renewals.where(F.col("_reason").isNull()), cfg)
    bad_control = control.where(F.length("record") != RECORD_LENGTH).select(
        "type", F.lit(None).cast("string").alias("publication_num"),
        F.concat(_lit("length "), F.length("record").cast("string")).alias("reason"), "record")
    out = (rejects(renewals, TYPE_RENEWAL)
           .unionByName(rejects(lapses, TYPE_LAPSE))
           .unionByName(rejects(restorations, TYPE_RESTORATION))
           .unionByName(rejects(lor, TYPE_LOR)))
    if unmatched_lor is not None:
        out = out.unionByName(unmatched_lor.select(
            *_reject_columns(TYPE_LOR, F.col("gap"), F.lit(None).cast("string"), F.lit(1), {})))
    return out.unionByName(bad_control, allowMissingColumns=True)


def _latest_year(cfg: RunConfig) -> int:
    # Fees are due at most 20 years after filing, and paid before that.
    return cfg.run_date.year + 20


def parsed_lines(lines: DataFrame, record_type: int, cfg: RunConfig) -> DataFrame:
    """The lines (``record``) of one type with their fields as typed columns; other columns are kept."""
    fields = LAYOUTS[record_type].parsed(F.col("record"), _latest_year(cfg))
    keep = [c for c in lines.columns if c not in fields]
    return lines.where(F.substring("record", 1, 3) == str(record_type)).select(
        *keep, *[c.alias(name) for name, c in fields.items()])


def unreadable_lines(lines: DataFrame, cfg: RunConfig) -> DataFrame:
    """(record, reason): lines of no known type, and those with a field that does not read back as its kind."""
    code = F.substring("record", 1, 3)
    reason = F.coalesce(*[F.when(code == str(t), F.coalesce(layout.unreadable(F.col("record"), _latest_year(cfg)), _lit("")))
                          for t, layout in LAYOUTS.items()], _lit("unknown record type"))
    return lines.select("record", reason.alias("reason")).where(F.col("reason") != "")


def reconciled(lines: DataFrame, cfg: RunConfig) -> DataFrame:
    """The file as read back (``record``) against its own trailer, one row per record type.

    (type, lines, prescribed, remitted, interest, trailer_prescribed,
    trailer_remitted, balanced). The amounts of the renewal lines must be the
    trailer's; interest is charged once per renewal line that has a share and is in the
    trailer alone. There must be one header and one trailer. Amounts that do not read back are null
    and leave the file unbalanced. One pass over the lines.
    """
    types = F.create_map(*[x for t in LAYOUTS for x in (_lit(str(t)), F.lit(t))])
    amounts = {t: LAYOUTS[t].parsed(F.col("record"), _latest_year(cfg)) for t in (TYPE_RENEWAL, TYPE_TRAILER)}
    kind = F.try_element_at(types, F.substring("record", 1, 3))
    typed = lines.select(kind.alias("type"), *[
        F.coalesce(*[F.when(kind == t, amounts[t][name]) for t in amounts]).cast(MONEY_SUM).alias(name)
        for name in ("prescribed", "remitted")],
        F.when((kind == TYPE_RENEWAL) & (amounts[TYPE_RENEWAL]["pct_split"] != NO_SHARE), 1).alias("_shared"))
    broken = F.count_if(F.col("type").isin(TYPE_RENEWAL, TYPE_TRAILER)
                        & (F.col("prescribed").isNull() | F.col("remitted").isNull()))
    sums = typed.groupBy("type").agg(
        F.count(F.lit(1)).alias("lines"), F.sum("prescribed").cast(MONEY_SUM).alias("prescribed"),
        F.sum("remitted").cast(MONEY_SUM).alias("remitted"), F.count("_shared").alias("_shared"), broken.alias("_broken"))
    # Every type is listed, also where the file has none of it.
    listed = lines.sparkSession.createDataFrame([(t,) for t in LAYOUTS], "type int").join(sums, "type", "left")
    # At most one row per type is left: a window over them is one small task.
    every = Window.partitionBy()
    of_type = lambda t, c: F.max(F.when(F.col("type") == t, F.col(c))).over(every)
    zero = lambda c: F.coalesce(c, F.lit(0)).cast(MONEY_SUM)
    renewal = F.col("type") == TYPE_RENEWAL
    interest = F.when(renewal, zero(F.col("_shared") * F.lit(cfg.interest_year3 + cfg.interest_year4)))
    rows = listed.select(
        "type", F.coalesce("lines", F.lit(0)).alias("lines"),
        *[F.when(renewal, zero(F.col(c))).alias(c) for c in ("prescribed", "remitted")], interest.alias("interest"),
        *[F.when(renewal, of_type(TYPE_TRAILER, c)).alias(f"trailer_{c}") for c in ("prescribed", "remitted")],
        (F.coalesce("_broken", F.lit(0)) == 0).alias("_whole"))
    adds_up = ((F.col("prescribed") == F.col("trailer_prescribed"))
               & (F.col("remitted") + F.col("interest") == F.col("trailer_remitted")) & F.col("_whole"))
    balanced = (F.when(renewal, F.coalesce(adds_up, F.lit(False)))
                .when(F.col("type").isin(TYPE_HEADER, TYPE_TRAILER), (F.col("lines") == 1) & F.col("_whole")).otherwise(F.lit(True)))
    return rows.select(*[c for c in rows.columns if c != "_whole"], balanced.alias("balanced"))
