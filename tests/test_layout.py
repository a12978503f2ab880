"""Fixed-width layouts: widths, field offsets and the length gate."""

from pyspark.sql import functions as F

from annuity.config import RunConfig
from annuity.functions import layout_width, money_parts, signed_int
from annuity.operators import exchange
from tests.helpers import D, frame, money

CFG = RunConfig(run_date=D(2001, 1, 3))


def test_every_layout_is_80_wide(spark):
    assert {layout.width for layout in exchange.LAYOUTS.values()} == {80}
    for layout in [exchange.renewal_layout(50), exchange.year_share_layout(3), exchange.year_share_layout(4),
                   exchange.lapse_layout(), exchange.restoration_layout(), exchange.lor_layout()]:
        assert layout_width(layout) == 80


def test_money_and_int_fields(spark):
    df = frame(spark, "x decimal(12,2), n int",
               [(money("123.45"), 5), (money("-3.5"), -5), (money("0.05"), 123), (money("123456789"), 12)])
    whole, cents = money_parts(F.col("x"), 8)
    got = [tuple(r) for r in df.select(whole, cents, signed_int(F.col("n"))).collect()]
    assert got == [("00000123", "45", "05"), ("-0000003", "50", "-5"), ("00000000", "05", "123"),
                   ("123456789", "00", "12")]


SPLIT = ("publication_num string, filing_date date, renewal_due_date date, renewal_year int, "
         "lor_endorsement string, renewal_fee decimal(12,2), renewal_fee_epo decimal(12,2), "
         "renewal_fee_year3 decimal(12,2), renewal_fee_year4 decimal(12,2), total_epo_amount decimal(12,2), "
         "date_filed date")


def test_renewal_lines(spark):
    split = frame(spark, SPLIT, [
        ("EP1234567", D(2000, 6, 1), D(2004, 6, 1), 5, "NO", money("123.45"), money("61.73"),
         money("40.00"), money("0.50"), money("102.23"), D(2004, 5, 15)),
        ("EP123456", D(2000, 6, 1), D(2004, 6, 1), 5, "YES", money(1), money("0.50"), money(0), money(0),
         money("0.50"), D(2004, 5, 15)),
        ("EP7654321", D(2000, 6, 1), None, 5, "YES", money(1), money("0.50"), money(0), money(0),
         money("0.50"), D(2004, 5, 15)),
    ])
    rows = exchange.renewal_rows(split, CFG)
    lines = sorted(r.record for r in exchange.records(rows, 200).collect())
    base = "200_EPB_1234567C010600010604"
    assert lines == [
        base + "__0300__0000000000" + "00000040" + "00" + "0000" + "150504" + "0000000000____",
        base + "__0500__" + "00000123" + "45" + "00000061" + "73" + "5000" + "150504" + "0000000000____",
    ]
    assert all(len(x) == 80 for x in lines)
    rejected = {r.publication_num: r.reason for r in exchange.rejects(rows, 200).collect()}
    assert rejected == {"EP123456": "width publication_number", "EP7654321": "missing renewal_due_date"}


def test_fields_that_make_up_for_each_other_are_rejected(spark):
    """An 11-character number and an empty code of no lapse make 80 characters, but no valid line."""
    lapses = frame(spark, "publication_num string, filing_date date, lapsed_reason string, date_processed date",
                   [("EP000000123", D(1999, 2, 3), "Revoked", D(2000, 11, 4))])
    year = frame(spark, SPLIT, [("EP123456", D(2000, 6, 1), D(2004, 6, 1), 123, "NO", money(1), money(1), money(0),
                                 money(0), money(1), D(2004, 5, 15))])
    assert [r.reason for r in exchange.rejects(exchange.lapse_rows(lapses), 400).collect()] == ["width publication_number"]
    rows = exchange.renewal_rows(year, CFG)
    assert rows.select(F.length(F.col("_lines")[0])).first()[0] == 80
    assert [r.reason for r in exchange.rejects(rows, 200).collect()] == ["width publication_number"]


def test_repeated_and_incomplete_payments_keep_their_amounts(spark):
    row = ("EP1234567", D(2000, 6, 1), D(2004, 6, 1), 5, "NO", money("10.00"), money("5.00"), money(0), money(0),
           money("5.00"), D(2004, 5, 15))
    no_fee = (*row[:7], None, money(0), None, row[-1])
    split = frame(spark, SPLIT, [row, row, row, no_fee])
    rows = exchange.renewal_rows(split, CFG)
    rejected = {r.reason: (r.payments, r.prescribed, r.remitted) for r in exchange.rejects(rows, 200).collect()}
    assert rejected == {"duplicate payment": (2, money("20.00"), money("10.00")),
                        "no minimum fee for year 3": (1, money("10.00"), None)}
    trailer = [r.record for r in exchange.control_lines(rows.where("_reason is null"), CFG).collect()][1]
    assert trailer[18:33] == "000000000001000" and trailer[33:48] == "000000000000500"


def test_two_payments_of_one_day_add_up_to_the_trailer(spark):
    """They share their year 3 and year 4 lines' text; both remit them."""
    row = lambda fee, share, total: ("EP1234567", D(2000, 6, 1), D(2004, 6, 1), 5, "NO", money(fee), money(share),
                                     money("20.00"), money("25.00"), money(total), D(2004, 5, 15))
    rows = exchange.renewal_rows(frame(spark, SPLIT, [row(100, 50, 95), row(120, 60, 105)]), CFG)
    none = [frame(spark, schema, []) for schema in (
        "publication_num string, filing_date date, lapsed_reason string, date_processed date",
        "publication_num string, filing_date date, date_processed date",
        "publication_num string, filing_date date, date_processed date, Addition_Deletion string, "
        "first_reduced_year int, last_reduced_year int")]
    others = exchange.lapse_rows(none[0]), exchange.restoration_rows(none[1]), exchange.lor_rows(none[2])
    lines = exchange.exchange_lines(rows, *others, CFG)
    sums = {r["type"]: r for r in exchange.reconciled(lines.select("record"), CFG).collect()}
    assert sums[200]["lines"] == 6 and all(r["balanced"] for r in sums.values())
    assert (sums[200]["prescribed"], sums[200]["remitted"], sums[200]["trailer_remitted"]) == (money(220), money(200), money(200))
    assert exchange.all_rejects(rows, *others, CFG).count() == 0
    # As the lines were before, made distinct: 155.00 of 200.00.
    sums = {r["type"]: r for r in exchange.reconciled(lines.select("record").distinct(), CFG).collect()}
    assert not sums[200]["balanced"] and sums[200]["remitted"] == money(155)
    assert not any(r["balanced"] for r in exchange.reconciled(lines.where("type = 200").select("record"), CFG).collect()
                   if r["type"] in (100, 200, 900))


def test_interest_is_in_the_trailer_alone(spark):
    cfg = RunConfig(run_date=D(2001, 1, 3), interest_year3="1.50", interest_year4="0.25")
    rows = exchange.renewal_rows(frame(spark, SPLIT, [
        ("EP1234567", D(2000, 6, 1), D(2004, 6, 1), 5, "NO", money(100), money(50), money(20), money(25), money("96.75"),
         D(2004, 5, 15))]), cfg)
    lines = exchange.records(rows, 200).select(F.translate("record", "_", " ").alias("record")).union(
        exchange.control_lines(rows, cfg).select(F.translate("record", "_", " ")))
    sums = {r["type"]: r for r in exchange.reconciled(lines, cfg).collect()}
    assert sums[200]["interest"] == money("1.75") and sums[200]["remitted"] == money(95)
    assert sums[200]["trailer_remitted"] == money("96.75") and sums[200]["balanced"]
    assert not {r["type"]: r for r in exchange.reconciled(lines, CFG).collect()}[200]["balanced"]


def test_equal_events_are_one_line_and_rejects(spark):
    lapse = ("EP0000001", D(1999, 2, 3), "Revoked", D(2000, 11, 4))
    lapses = frame(spark, "publication_num string, filing_date date, lapsed_reason string, date_processed date, source string",
                   [(*lapse, "Legacy"), (*lapse, "Dynamics"), (*lapse, "Legacy")])
    rows = exchange.lapse_rows(lapses)
    assert exchange.records(rows, 400).count() == 1
    (reject,) = exchange.rejects(rows, 400).collect()
    assert (reject.reason, reject.payments, reject.prescribed) == ("duplicate event", 2, None)


def test_lines_read_back_as_what_was_written(spark):
    split = frame(spark, SPLIT, [
        ("EP1234567", D(1985, 6, 1), D(2004, 6, 30), 5, "YES", money("99999999.99"), money("-3.50"), money("40.00"), money("0.50"),
         money("102.23"), D(2004, 5, 15))])
    lor = frame(spark, "publication_num string, filing_date date, date_processed date, Addition_Deletion string, "
                       "first_reduced_year int, last_reduced_year int", [("EP0000005", D(1999, 2, 3), D(2000, 11, 4), "D", 3, -1)])
    rows = exchange.renewal_rows(split, CFG)
    lines = exchange.records(rows, 200).union(exchange.records(exchange.lor_rows(lor), 600)).select(
        F.translate("record", "_", " ").alias("record")).union(
        exchange.control_lines(rows, CFG).select(F.translate("record", "_", " ")))
    assert exchange.unreadable_lines(lines, CFG).count() == 0
    own = [r for r in exchange.parsed_lines(lines, 200, CFG).collect() if r["renewal_year"] == 5][0]
    assert (own["filing_date"], own["renewal_due_date"], own["date_filed"]) == (D(1985, 6, 1), D(2004, 6, 30), D(2004, 5, 15))
    assert (own["prescribed"], own["remitted"], own["pct_split"], own["reduced"]) == (money("99999999.99"), money("-3.50"), "5000", "02")
    (event,) = exchange.parsed_lines(lines, 600, CFG).collect()
    assert (event["first_reduced_year"], event["last_reduced_year"], event["update_indicator"]) == (3, -1, "D")
    (header,), (trailer,) = (exchange.parsed_lines(lines, t, CFG).collect() for t in (100, 900))
    assert (header["start"], header["end"], header["currency"]) == (D(2000, 10, 1), D(2000, 12, 31), "GBP")
    assert (trailer["run_date"], trailer["reference"], trailer["prescribed"]) == (D(2001, 1, 3), "POA 35/28", money("99999999.99"))


def test_unreadable_lines_say_why(spark):
    lapses = frame(spark, "publication_num string, filing_date date, lapsed_reason string, date_processed date",
                   [("EP0000001", D(1999, 2, 3), "Revoked", D(2000, 11, 4))])
    good = exchange.records(exchange.lapse_rows(lapses), 400).first()["record"].replace("_", " ")
    bad = [good, good + " ", "700" + good[3:], good[:16] + "310299" + good[22:], good[:22] + "x" + good[23:], "", good[:16] + "+10299" + good[22:]]
    got = {r["record"]: r["reason"] for r in exchange.unreadable_lines(frame(spark, "record string", [(x,) for x in bad]), CFG).collect()}
    assert got == {bad[1]: "length", bad[2]: "unknown record type", bad[3]: "filing_date", bad[4]: "space1", "": "unknown record type",
                   bad[6]: "filing_date"}


def test_callers_choose_rows(spark):
    lapses = frame(spark, "publication_num string, filing_date date, lapsed_reason string, date_processed date",
                   [("EP0000001", D(1999, 2, 3), "Revoked", D(2000, 11, 4)), ("EP0000002", D(1999, 2, 3), "Ceased", D(2000, 11, 4))])
    got = exchange.records(exchange.lapse_rows(lapses, F.col("lapsed_reason") == "Ceased"), 400).collect()
    assert [r.publication_num for r in got] == ["EP0000002"]


def test_lapse_restoration_lor_lines(spark):
    lapses = frame(spark, "publication_num string, filing_date date, lapsed_reason string, date_processed date",
                   [("EP0000001", D(1999, 2, 3), "Revoked", D(2000, 11, 4)),
                    ("EP0000002", D(1999, 2, 3), "Expired", D(2000, 11, 4)),
                    ("EP0000003", D(1999, 2, 3), "Other", D(2000, 11, 4))])
    rows = exchange.lapse_rows(lapses)
    assert [r.record for r in exchange.records(rows, 400).collect()] == [
        "400_EPB_0000001_030299" + "_" * 10 + "07" + "_" * 26 + "041100" + "_" * 14]
    assert [r.reason for r in exchange.rejects(rows, 400).collect()] == ["unknown lapse reason"]

    rest = frame(spark, "publication_num string, filing_date date, date_processed date",
                 [("EP0000004", D(1999, 2, 3), D(2000, 11, 4))])
    assert [r.record for r in exchange.records(exchange.restoration_rows(rest), 500).collect()] == [
        "500_EPB_0000004_030299" + "_" * 38 + "041100" + "_" * 14]

    lor = frame(spark, "publication_num string, filing_date date, date_processed date, Addition_Deletion string, "
                       "first_reduced_year int, last_reduced_year int",
                [("EP0000005", D(1999, 2, 3), D(2000, 11, 4), "D", 3, 9),
                 ("EP0000006", D(1999, 2, 3), D(2000, 11, 4), "A", 12, 20)])
    assert sorted(r.record for r in exchange.records(exchange.lor_rows(lor), 600).collect()) == [
        "600_EPB_0000005D030299041100030950" + "_" * 46,
        "600_EPB_0000006_030299041100122050" + "_" * 46]


def test_header_and_trailer(spark):
    accepted = frame(spark, "renewal_fee decimal(12,2), total_epo_amount decimal(12,2)",
                     [(money("1000.10"), money("500.05")), (money("20.00"), money("10.00"))])
    lines = {r.type: r.record for r in exchange.control_lines(accepted, CFG).collect()}
    assert lines[100] == "100" + "_" * 13 + "011000" + "311200" + "GBGBP" + "_" * 47
    assert lines[900] == ("900" + "_" * 12 + "C__" + "0000000001020" + "10" + "0000000000510" + "05"
                          + "030101" + "POA 35/28" + "_" * 17)
    assert {len(v) for v in lines.values()} == {80}
