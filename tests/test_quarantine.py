"""Source values that do not fit their column, and lines of the fee list that are no fees."""

from annuity.operators import extracts
from annuity.sources.tables import (CANONICAL, checked_sources, misfits, read_minimum_fees, rejected_minimum_fees, typed)
from annuity.sources.testdata import fixture_tables
from tests.helpers import D, frame, money


def test_bad_values_leave_with_their_rows(spark):
    log = frame(spark, "case_key string, form_type_num string, date_filed string, fee_taken string, extension_months double", [
        ("EP1", "12", "2000-05-01", "10.50", 3.0), ("EP2", "12", "01/05/2000", "10.50", None), ("EP3", "twelve", None, "1,5", 1.0),
        ("EP4", None, None, None, None), ("EP5", "12", "2000-05-01 23:15:00", "1e30", 3.0)])
    got = sorted(map(tuple, misfits(log, "formslog").collect()))
    assert got == [("formslog", "EP2", "date_filed", "01/05/2000"), ("formslog", "EP3", "fee_taken", "1,5"),
                   ("formslog", "EP3", "form_type_num", "twelve"), ("formslog", "EP5", "fee_taken", "1e30")]
    good = {r.case_key: r for r in typed(log).collect()}
    assert set(good) == {"EP1", "EP4"}
    assert (good["EP1"].form_type_num, good["EP1"].date_filed, good["EP1"].fee_taken) == (12, D(2000, 5, 1), money("10.50"))


def test_codes_keep_their_zeros_and_bad_ones_leave(spark):
    rows = frame(spark, "application_num string, reason_not_in_force double", [("EP1", 4.0), ("EP2", float("nan")), ("EP3", None)])
    assert {r.application_num: r.reason_not_in_force for r in typed(rows).collect()} == {"EP1": "04", "EP3": None}
    assert [tuple(r) for r in misfits(rows, "standing").collect()] == [("standing", "EP2", "reason_not_in_force", "NaN")]


def test_nothing_to_quarantine_where_types_fit(spark, sf_small):
    src = fixture_tables(spark, sf_small)
    assert misfits(src.standing, "standing") is None
    whole = checked_sources({n: getattr(src, n) for n in CANONICAL if n != "minimum_fee"}, src.minimum_fee)
    assert whole.quarantine is None
    assert extracts.renewals_legacy(whole).exceptAll(extracts.renewals_legacy(src)).count() == 0


def test_fee_lines(spark, tmp_path):
    lines = ["year_set,minimum_fee_year,minimum_fee_amount", "2000,3,10.50", "2000,4", "2000,4,1,2", "2000,four,1", "2000,4,",
             '2001,"3","7"', " 2002 , 3 , 5 ", ",3,1", "x"]
    (tmp_path / "fees.csv").write_text("\n".join(lines) + "\n")
    path = str(tmp_path / "fees.csv")
    assert sorted(r.year_set.strip() for r in read_minimum_fees(spark, path).collect()) == ["2000", "2001", "2002"]
    assert {r.record: r.reason for r in rejected_minimum_fees(spark, path).collect()} == {
        "2000,4": "not 3 columns", "2000,4,1,2": "not 3 columns", "2000,four,1": "minimum_fee_year is no number",
        "2000,4,": "minimum_fee_amount is no number", ",3,1": "year_set is no number", "x": "not 3 columns"}


def test_run_over_damaged_sources_ends_with_rejects(spark, sf_small, scratch):
    from annuity.config import RunConfig
    from annuity.plans import job
    from annuity.sources.testdata import damaged_tables

    src = damaged_tables(spark, sf_small)
    cfg = RunConfig(run_date=D(2001, 1, 3), quarterly=False, out_root=scratch, history_table="damaged_history")
    result = job.run(spark, src, cfg)
    assert result.status == "rejects" and not result.faults
    stored = spark.read.parquet(result.outputs["quarantine"])
    assert stored.count() == result.metrics["quarantined_values"] == src.quarantine.count() > 0
