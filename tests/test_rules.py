"""Hand-made rows for each business rule (edge cases the fixtures hit rarely)."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from annuity.config import RunConfig, reporting_period
from annuity.operators import merge, reports, rules
from tests.helpers import D, frame, money

RENEWAL = ("application_num string, filing_date date, grant_date date, renewal_year int, "
           "date_filed date, date_processed date, next_renewal_date date")


def due_by(df, key="grant_date"):
    return {r[key]: r["renewal_due_date"] for r in rules.renewal_due_dates(df).collect()}


def test_due_date_grace_window(spark):
    # filing 2000-03-15, year 5 -> due 2004-03-15; window [2003-12-15, 2004-03-15]
    rows = [(f"A{i}", D(2000, 3, 15), g, 5, D(2004, 1, i + 1), D(2004, 2, 1), None)
            for i, g in enumerate([D(2003, 12, 14), D(2003, 12, 15), D(2004, 1, 20),
                                   D(2004, 3, 15), D(2004, 3, 16)])]
    due = due_by(frame(spark, RENEWAL, rows))
    assert due[D(2003, 12, 14)] == D(2004, 3, 15)      # before the window
    assert due[D(2003, 12, 15)] == D(2004, 3, 15)      # due - 3 months: grant + 3 months
    assert due[D(2004, 1, 20)] == D(2004, 4, 20)
    assert due[D(2004, 3, 15)] == D(2004, 6, 15)       # grant on the due date
    assert due[D(2004, 3, 16)] == D(2004, 3, 15)       # one day after: unchanged


def test_due_date_month_end_clamps(spark):
    rows = [("J", D(2000, 1, 31), D(1999, 1, 1), 2, D(2001, 1, 1), None, None),
            ("F", D(2000, 2, 29), D(1999, 1, 1), 2, D(2001, 1, 2), None, None),
            ("G", D(2000, 1, 31), D(2000, 11, 30), 2, D(2001, 1, 3), None, None)]
    got = {r.application_num: r.renewal_due_date
           for r in rules.renewal_due_dates(frame(spark, RENEWAL, rows)).collect()}
    assert got == {"J": D(2001, 1, 31), "F": D(2001, 2, 28), "G": D(2001, 2, 28)}


def test_two_payments_on_one_day_move_both(spark):
    rows = [("X", D(2000, 6, 1), D(1990, 1, 1), 3, D(2002, 5, 1), None, None),
            ("X", D(2000, 6, 1), D(1990, 1, 1), 4, D(2002, 5, 1), None, None),
            ("X", D(2000, 6, 1), D(1990, 1, 1), 5, None, None, None),
            ("X", D(2000, 6, 1), D(1990, 1, 1), 6, D(2002, 6, 1), None, None),
            (None, D(2000, 6, 1), D(1990, 1, 1), 3, D(2002, 7, 1), None, None),
            (None, D(2000, 6, 1), D(1990, 1, 1), 3, D(2002, 7, 1), None, None)]
    out = rules.renewal_due_dates(frame(spark, RENEWAL, rows)).collect()
    got = sorted((r.application_num or "", r.renewal_year, r.renewal_due_date) for r in out)
    assert got == [("", 3, D(2003, 6, 1)), ("", 3, D(2003, 6, 1)),
                   ("X", 3, D(2003, 6, 1)), ("X", 4, D(2004, 6, 1)),
                   ("X", 5, D(2004, 6, 1)), ("X", 6, D(2005, 6, 1))]
    assert "next_renewal_date" not in rules.renewal_due_dates(frame(spark, RENEWAL, rows)).columns


LOR = ("application_num string, publication_num string, filing_date date, grant_date date, "
       "date_filed date, date_processed date, Addition_Deletion string, source string, type_identifier string")


def lor_row(app, processed, ad, filing=D(2000, 6, 1), filed=None):
    return (app, f"EP{app}", filing, D(1990, 1, 1), filed or processed, processed, ad, "Legacy", "LoR")


def test_lor_endorsement_boundaries(spark):
    due = "application_num string, renewal_due_date date, date_processed date"
    renewals = frame(spark, due, [("E", D(2004, 6, 1), D(2004, 5, 1)),   # cmp 2004-05-01
                                  ("F", D(2004, 6, 1), D(2004, 7, 1)),   # cmp 2004-06-01
                                  ("G", D(2004, 6, 1), None),
                                  ("H", D(2004, 6, 1), D(2004, 5, 1))])
    lor = frame(spark, LOR, [lor_row("E", D(2004, 5, 1), "A"),               # A = cmp -> YES
                             lor_row("F", D(2004, 1, 1), "A"), lor_row("F", D(2004, 6, 1), "D"),  # D = cmp
                             lor_row("G", D(2003, 1, 1), "A"), lor_row("G", D(2002, 1, 1), "A"),
                             lor_row("H", D(2004, 1, 1), "D")])               # no entry -> NO
    got = {r.application_num: (r.renewal_comparison_date, r.lor_endorsement)
           for r in rules.lor_endorsement(renewals, lor).collect()}
    assert got == {"E": (D(2004, 5, 1), "YES"), "F": (D(2004, 6, 1), "NO"),
                   "G": (D(2004, 6, 1), "YES"), "H": (D(2004, 5, 1), "NO")}


def test_lor_year_ranges(spark):
    renewals = frame(spark, "application_num string, renewal_year int, date_processed date",
                     [("L", 5, D(2004, 4, 1)), ("L", 5, D(2004, 4, 20))])
    lor = frame(spark, LOR, [
        lor_row("L", D(2004, 5, 1), "A"),                        # year 5, cmp 2004-04-01: late -> 6
        lor_row("L", D(2004, 3, 1), "A", filed=D(2004, 2, 1)),   # on time -> 5
        lor_row("L", D(2006, 5, 1), "D"),                        # year 7, due 2006-06-01: on time -> 6
        lor_row("M", D(2006, 5, 1), "D"),                        # cancellation without entry
        lor_row("N", D(2000, 1, 1), "A", filing=D(1981, 6, 1)),  # year 20, on time -> 20
        lor_row("O", D(2001, 1, 1), "A", filing=D(1981, 6, 1)),  # year 21 -> dropped
    ])
    got = sorted((r.application_num, r.Addition_Deletion, r.first_reduced_year, r.last_reduced_year)
                 for r in rules.lor_year_ranges(lor, renewals).collect())
    assert got == [("L", "A", 5, 20), ("L", "A", 6, 20), ("L", "D", 5, 6), ("L", "D", 6, 6), ("N", "A", 20, 20)]
    kept = rules.lor_year_ranges(lor, renewals, keep_unmatched=True)
    assert kept.where(F.col("first_reduced_year").isNull()).select("application_num").collect()[0][0] == "M"


SPLIT = ("application_num string, filing_date date, grant_date date, renewal_year int, "
         "renewal_due_date date, renewal_fee decimal(12,2)")


def fee_rows(spark):
    return frame(spark, "year_set string, minimum_fee_year string, minimum_fee_amount string",
                 [("1998", "3", "40.00"), ("1999", "4", "55.50"), ("1999", "3", "41.00"),
                  ("2003", "4", "60.00"), ("1998", "5", "99.00")])


def test_fee_split(spark):
    fees = rules.minimum_fee_table(fee_rows(spark))
    rows = [("Y5", D(1995, 1, 1), D(1996, 6, 1), 5, D(2000, 1, 1), money(100)),   # owes both years
            ("G4", D(1995, 1, 1), D(1997, 6, 1), 5, D(2000, 1, 1), money(100)),   # granted after year 3 start
            ("Y4", D(1995, 1, 1), D(1996, 6, 1), 4, D(2000, 1, 1), money(100)),
            ("NF", D(1990, 1, 1), D(1990, 6, 1), 5, D(2004, 1, 1), money(100)),   # no year-3 fee for 2002
            ("RD", D(1995, 1, 1), D(2000, 6, 1), 6, D(2000, 1, 1), money("0.25"))]
    out = rules.fee_splits(frame(spark, SPLIT, rows), fees, 50, Decimal("1.00"), Decimal("0.50"))
    got = {r.application_num: (r.renewal_fee_year3, r.renewal_fee_year4, r.renewal_fee_epo, r.total_epo_amount)
           for r in out.collect()}
    assert got["Y5"] == (money(40), money("55.50"), money(50), money("147.00"))
    assert got["G4"] == (money(0), money("55.50"), money(50), money("107.00"))
    assert got["Y4"] == (money(0), money(0), money(50), money("51.50"))
    assert got["NF"] == (None, money(60), money(50), None)
    assert got["RD"] == (money(0), money(0), money("0.13"), money("1.63"))   # 0.125 rounds half up


def test_two_amounts_for_a_fee_year_fail(spark):
    import pytest

    same = fee_rows(spark).union(fee_rows(spark))
    assert rules.minimum_fee_table(same).count() == 3
    two = fee_rows(spark).union(frame(spark, "a string, b string, c string", [("1998", "3", "41.00")]))
    with pytest.raises(Exception, match="two minimum fees for 1998"):
        rules.minimum_fee_table(two).collect()


def test_several_fee_rows_for_a_right_fail(spark):
    import pytest

    from annuity.operators import extracts
    fees = frame(spark, "right_id string, total_fee decimal(12,2)", [("R", money(1)), ("S", money(2)), (None, money(3)), (None, money(4))])
    assert sorted(tuple(r) for r in extracts.one_fee_per_right(fees).collect()) == [("R", money(1)), ("S", money(2))]
    with pytest.raises(Exception, match="several fee rows for right S"):
        extracts.one_fee_per_right(fees.union(fees.where("right_id = 'S'"))).collect()


def test_lor_ranges_hold_every_outcome(spark):
    """Two payments of one year that disagree, and two entries with two cancellations."""
    renewals = frame(spark, "application_num string, renewal_year int, date_processed date",
                     [("P", 5, D(2004, 2, 1)), ("P", 5, D(2004, 4, 1)), ("P", 5, D(2004, 5, 1))])
    lor = frame(spark, LOR, [
        lor_row("P", D(2004, 3, 1), "A"),                        # before the later payments, after the first: 5 and 6
        lor_row("Q", D(2003, 5, 1), "A"),                        # year 4, no payment, on time -> 4
        lor_row("Q", D(2005, 5, 1), "A", filed=D(2004, 2, 1)),   # year 6 -> 6
        lor_row("Q", D(2004, 5, 1), "D", filed=D(2004, 3, 1)),   # year 5 -> to 4
        lor_row("Q", D(2007, 5, 1), "D", filed=D(2004, 4, 1)),   # year 8 -> to 7
        lor_row("R", None, "A"),
    ])
    got = sorted((r.application_num, r.Addition_Deletion, r.first_reduced_year, r.last_reduced_year)
                 for r in rules.lor_year_ranges(lor, renewals).collect())
    assert got == [("P", "A", 5, 20), ("P", "A", 6, 20), ("Q", "A", 4, 20), ("Q", "A", 6, 20),
                   ("Q", "D", 4, 4), ("Q", "D", 4, 7), ("Q", "D", 6, 4), ("Q", "D", 6, 7)]
    gaps = rules.lor_year_ranges(lor, renewals, keep_unmatched=True).where("gap is not null").collect()
    assert [(r.application_num, r.gap) for r in gaps] == [("R", rules.NO_DATES)]


def test_payments_without_a_date_show_their_outcome(spark):
    """Against an undated payment the due date alone decides; dated and undated payments may disagree."""
    renewals = frame(spark, "application_num string, renewal_year int, date_processed date",
                     [("P", 11, D(2000, 2, 1)), ("P", 11, None), ("Q", 11, None), ("R", 11, D(2000, 2, 1)), ("S", 11, D(2000, 7, 1)),
                      ("S", 11, None)])
    lor = frame(spark, LOR, [(f"{a}", "EP1", D(1990, 6, 1), None, D(2000, 4, 1), D(2000, 5, 1), "A", "Legacy", "Licence of Right")
                             for a in "PQRST"])
    got = sorted((r.application_num, r.first_reduced_year) for r in rules.lor_year_ranges(lor, renewals).collect())
    assert got == [("P", 11), ("P", 12), ("Q", 11), ("R", 12), ("S", 11), ("T", 11)]


KEYS = "application_num string, publication_num string, renewal_year int, renewal_fee decimal(12,2)"


def test_priority_merge_keeps_new_and_unmatched_legacy(spark):
    new = frame(spark, KEYS, [("A", "EP1", 5, money(1)), ("A", "EP1", 5, money(2)), ("B", "EP2", 3, money(3))])
    legacy = frame(spark, KEYS, [("A", "EP1", 5, money(9)), ("A", "EP1", 6, money(8)),
                                 (None, "EP1", 5, money(7)), ("B", None, 3, money(6))])
    out = merge.priority_merge(new, legacy)
    got = sorted((r.source, r.application_num or "", r.renewal_year, str(r.renewal_fee)) for r in out.collect())
    assert got == [("Dynamics", "A", 5, "1.00"), ("Dynamics", "A", 5, "2.00"), ("Dynamics", "B", 3, "3.00"),
                   ("Legacy", "", 5, "7.00"), ("Legacy", "A", 6, "8.00"), ("Legacy", "B", 3, "6.00")]
    assert {r.type_identifier for r in out.collect()} == {"Renewals"}
    overlap = merge.overlap_keys(new, legacy).collect()
    assert [(r.application_num, r.renewal_year) for r in overlap] == [("A", 5)]


def test_dedupe_union_keeps_one_copy_per_system(spark):
    schema = "application_num string, date_processed date"
    legacy = frame(spark, schema, [("A", D(2000, 1, 1)), ("A", D(2000, 1, 1))])
    new = frame(spark, schema, [("A", D(2000, 1, 1))])
    out = merge.dedupe_union(legacy, new, "Restoration").collect()
    assert sorted(r.source for r in out) == ["Dynamics", "Legacy"]


def test_reporting_periods():
    assert reporting_period(dt.date(2001, 1, 3), True) == (D(2000, 10, 1), D(2000, 12, 31))
    assert reporting_period(dt.date(2001, 2, 3), True) == (D(2000, 11, 1), D(2001, 1, 31))
    assert reporting_period(dt.date(2001, 3, 3), True) == (D(2000, 12, 1), D(2001, 2, 28))
    assert reporting_period(dt.date(2001, 3, 3), False) == (D(2001, 2, 1), D(2001, 2, 28))
    assert RunConfig(run_date=dt.date(2001, 1, 3)).run_stamp == "030101"


def test_pct_split_must_be_two_digits():
    import pytest

    with pytest.raises(ValueError):
        RunConfig(run_date=dt.date(2001, 1, 3), pct_split=5)


def test_totals_empty_period_is_zero(spark):
    empty = frame(spark, "renewal_fee decimal(12,2), total_epo_amount decimal(12,2)", [])
    row = reports.grand_totals(empty).collect()[0]
    assert (row.grand_total_prescribed, row.grand_total_remitted, row.grand_total_retained) == (
        money(0), money(0), money(0))


def test_monthly_totals_orders_chronologically_with_total(spark):
    split = frame(spark, "date_filed date, total_epo_amount decimal(12,2)",
                  [(D(2000, 12, 1), money("1000.50")), (D(2001, 1, 15), money(2)), (D(2000, 12, 20), money(1))])
    rows = reports.monthly_totals(split).orderBy("_total", "_month").collect()
    assert [(r.Month, r.Amount) for r in rows] == [
        ("December 2000", "1,001.50"), ("January 2001", "2.00"), ("EPO Total", "1,003.50")]
