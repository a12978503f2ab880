"""Physical-plan properties: no Python workers, filters and projections reach the scans."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from annuity.operators import extracts
from annuity.plans.queries import QUERIES, TEST_CONFIG
from annuity.sources.tables import CANONICAL, from_storage, write_storage
from annuity.sources.testdata import fixture_tables


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_evaluation(spark, sf_small, name):
    text = plan(QUERIES[name](spark, sf_small))
    assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text


@pytest.fixture(scope="module")
def stored(spark, sf_small, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("stored"))
    write_storage(fixture_tables(spark, sf_small), root)
    return from_storage(spark, root)


def test_form_type_filter_pushed_to_scan(spark, stored):
    text = plan(extracts.renewals_legacy(stored))
    assert "PushedFilters: [IsNotNull(form_type_num), EqualTo(form_type_num,12)" in text


def test_period_filter_pushed_to_scan(spark, stored):
    text = plan(extracts.lapses_new(stored, *TEST_CONFIG.period))
    assert "GreaterThanOrEqual(event_date,2000-10-01)" in text
    assert "LessThanOrEqual(event_date,2000-12-31)" in text
    # Publication numbers are compared trimmed, so their prefix is tested above the scan.
    assert "StartsWith(trim(publication_num" in text


def test_scans_read_only_needed_columns(spark, stored):
    text = plan(extracts.lapses_new(stored, *TEST_CONFIG.period))
    reg = [line for line in text.splitlines() if "registerevent" in line and "ReadSchema" in line]
    assert reg and "ReadSchema: struct<case_id:string,event_date:date,register_indicator:int>" in reg[0]
    right = [line for line in text.splitlines() if "register_right" in line and "ReadSchema" in line]
    assert right and "restoration_date" not in right[0]


def test_stored_sources_give_the_same_extracts(spark, sf_small, stored):
    fixture = fixture_tables(spark, sf_small)
    for fn in [extracts.renewals_new, extracts.renewals_legacy, extracts.lor_legacy, extracts.lor_new]:
        a, b = fn(fixture), fn(stored)
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_minimum_fee_csv_is_read_as_text(stored):
    assert [f.dataType.simpleString() for f in stored.minimum_fee.schema.fields] == ["string"] * 3
    assert stored.minimum_fee.count() > 0


def test_period_outputs_sort_by_range_not_in_one_task(spark):
    from annuity.sources.sinks import _sorted_output
    lines = spark.range(0, 1000, 1, 4).selectExpr("format_string('%080d', id) AS record")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        spread = plan(_sorted_output(lines, ["record"], None))
        one = plan(_sorted_output(lines, ["record"], 1))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "rangepartitioning(record" in spread and "SinglePartition" not in spread
    # One file on request is one task by nature.
    assert "SinglePartition" in one and "rangepartitioning" not in one


def test_pipeline_triggers_no_job(spark, sf_small):
    from annuity.plans.queries import pipeline
    tracker = spark.sparkContext.statusTracker()
    p = pipeline(spark, sf_small)
    assert all(getattr(p.src, name).columns for name in CANONICAL)  # reading a file's schema is a job
    spark.sparkContext.setJobGroup("lazy", "plan building")
    assert p.exchange_lines.columns and p.rejects.columns and p.renewals_split.columns
    spark.sparkContext.setJobGroup("other", "")
    assert not tracker.getJobIdsForGroup("lazy")


def test_history_period_prunes_partitions(spark, sf_small, tmp_path):
    import datetime as dt

    from annuity.config import RunConfig
    from annuity.operators import reports
    from annuity.sources.history import write_snapshot
    cfg = RunConfig(run_date=dt.date(2001, 1, 3), out_root=str(tmp_path), history_table="pruned_history")
    from annuity.plans.queries import pipeline
    write_snapshot(spark, pipeline(spark, sf_small).history, cfg)
    stored = spark.read.table("pruned_history").where("type_identifier = 'Renewals'")
    text = plan(reports.in_period(stored, *cfg.period))
    line = next(x for x in text.splitlines() if "PartitionFilters" in x)
    filters = line[line.index("PartitionFilters"):line.index("PushedFilters")]
    assert "processed_year" in filters and ">= 2000" in filters and "type_identifier" in filters


def test_file_outputs_start_from_shared_stages(spark, sf_small):
    """Lines, trailer and rejects read the stages written once, not the sources again for every consumer."""
    for name in ("exchange_file", "rejects"):
        text = plan(QUERIES[name](spark, sf_small)).split("Initial Plan")[0]
        assert text.count("FileScan") <= 20


@pytest.fixture()
def shuffled_joins(spark):
    """Plans as for large tables: no join by broadcast, and the whole plan shown."""
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.maxPlanStringLength": "1000000"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def test_bucketed_stages_need_no_exchange_on_the_application(spark, sf_small, shuffled_joins, monkeypatch):
    from annuity.plans.queries import pipeline
    from annuity.sources import sinks

    monkeypatch.setattr(sinks, "BUCKET_ROWS", 0)
    bucketed = pipeline(spark, sf_small).bucket_staged()
    plain = pipeline(spark, sf_small).staged("renewals", "lor")
    assert bucketed.bucketed and not plain.bucketed
    for stage in ("lor_ranges_all", "renewals_due", "renewals_enriched", "renewals_period"):
        got, want = getattr(bucketed, stage), getattr(plain, stage)
        text = plan(got)
        assert "hashpartitioning(application_num" not in text and "hashpartitioning(_app" not in text, stage
        assert "hashpartitioning(application_num" in plan(want)
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0, stage
    # The fee lookup joins by year; nothing else is exchanged.
    assert "hashpartitioning(application_num" not in plan(bucketed.renewals_split)
    # Apart from the extracts of lapses and restorations, which join sources by it, the rejects need none either.
    assert "hashpartitioning(application_num" not in plan(
        pipeline(spark, sf_small).bucket_staged("renewals_split", "lor_ranges_all", "lapses", "restorations").rejects)


def test_a_hot_application_is_not_bucketed(spark, monkeypatch):
    from annuity.sources import sinks

    monkeypatch.setattr(sinks, "HOT_ROWS", 100)
    monkeypatch.setattr(sinks, "BUCKET_ROWS", 0)
    rows = spark.range(3000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).cast("string").alias("application_num"))
    stored, bucketed = sinks.stage_buckets(rows, "hot", "application_num", 64)
    assert not bucketed and stored.count() == 3000
    monkeypatch.setattr(sinks, "HOT_ROWS", 100_000)
    stored, bucketed = sinks.stage_buckets(rows, "hot", "application_num", 4)
    assert bucketed and stored.count() == 3000 and stored.groupBy("application_num").count().count() == 2001


def test_audit_counts_scan_less(spark, sf_small, shuffled_joins):
    text = plan(QUERIES["audit_counts"](spark, sf_small))
    assert text.count("FileScan") <= 25


def test_period_outputs_leave_out_applications_without_an_event_in_it(spark, sf_small):
    """The same rows of the period from fewer applications; a payment without an application leaves nothing out."""
    from annuity.plans.pipeline import PERIOD_EXTRACTS, Pipeline
    from annuity.plans.queries import pipeline

    whole = pipeline(spark, sf_small)
    own = whole.for_period(*PERIOD_EXTRACTS)
    for stage in ("renewals_period", "lor_period", "lor_unmatched_period", "lapses", "restorations_period"):
        got, want = getattr(own, stage), getattr(whole, stage)
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0, stage
    for stage in ("renewals", "lor"):
        assert getattr(own, stage).count() < 0.5 * getattr(whole, stage).count(), stage
    nameless = whole.src.replaced(right=lambda: whole.src.right.withColumn("application_num", F.lit(None).cast("string")))
    p = Pipeline(nameless, whole.cfg)
    assert p.for_period(*PERIOD_EXTRACTS) is p


def test_whole_outputs_derive_each_extract_once(spark, sf_small, shuffled_joins):
    for name in ("lor_endorsement", "lor_year_range"):
        assert plan(QUERIES[name](spark, sf_small)).count("FileScan") <= 12, name


def test_status_report_goes_through_the_line_items_for_lapses_alone(spark, sf_small, shuffled_joins):
    """Renewals, restorations and licences start from the stored sources of the period's applications."""
    assert plan(QUERIES["status_report"](spark, sf_small)).count("lineitem.parquet") <= 2


def test_licence_forms_are_not_joined_with_what_they_do_not_use(spark, sf_small, shuffled_joins):
    text = plan(extracts.lor_legacy(fixture_tables(spark, sf_small)))
    assert text.count("FileScan") == 2 and text.count("Join ") == 1


def test_dated_applications_hold_every_application_with_a_row_in_the_period(spark, sf_small, shuffled_joins):
    from annuity.operators import reports
    from annuity.plans.pipeline import PERIOD_EXTRACTS

    src = fixture_tables(spark, sf_small)
    for name in PERIOD_EXTRACTS:
        dated = extracts.applications_dated(src, name, *TEST_CONFIG.period)
        needed = reports.in_period(getattr(extracts, name)(src), *TEST_CONFIG.period).select("application_num")
        assert needed.count() > 0 and needed.exceptAll(needed.join(dated, "application_num", "left_semi")).count() == 0, name
        if name.endswith("_legacy"):
            assert "Join" not in plan(dated), name


def test_many_applications_give_the_same_rows(spark, sf_small, monkeypatch):
    """Beyond ``FEW_APPLICATIONS`` the applications are hashed; the rows of the period stay the same."""
    from annuity.plans.pipeline import PERIOD_EXTRACTS
    from annuity.plans.queries import pipeline

    monkeypatch.setattr(extracts, "FEW_APPLICATIONS", 0)
    whole = pipeline(spark, sf_small)
    own = whole.for_period(*PERIOD_EXTRACTS)
    for stage in ("renewals_period", "lor_period", "restorations_period"):
        got, want = getattr(own, stage), getattr(whole, stage)
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0, stage


@pytest.fixture()
def repeated_register(spark, sf_small):
    """The fixture with each application five times in the legacy register, with other dates, and one of them under another publication number."""
    src = fixture_tables(spark, sf_small)
    copy = F.explode(F.sequence(F.lit(0), F.lit(4)))
    standing = src.standing.withColumn("_copy", copy).select(*[
        (F.date_add(c, F.col("_copy") * 37) if c in ("filing_date", "grant_date", "date_of_lor", "date_lor_cancel")
         else F.when(F.col("_copy") == 4, F.concat(F.trim(c), F.lit("X"))).otherwise(F.col(c)) if c == "publication_num"
         else F.col(c)).alias(c) for c in CANONICAL["standing"]]).persist()
    yield src.replaced(standing=standing)
    standing.unpersist()


@pytest.fixture()
def stages(monkeypatch):
    """Names and rows of the stages that a pipeline writes."""
    from annuity.plans import pipeline
    written = {}

    def noted(df, name):
        written[name] = stage(df, name)
        return written[name]

    stage = pipeline.stage
    monkeypatch.setattr(pipeline, "stage", noted)
    return written


def test_period_file_writes_no_rows_beyond_the_period_but_payments_and_licences(spark, repeated_register, stages):
    """An application that the register holds several times multiplies payments and ranges in the period alone."""
    from annuity.operators import reports
    from annuity.plans.pipeline import Pipeline
    from annuity.plans.queries import _period_file

    whole, own = Pipeline(repeated_register, TEST_CONFIG), _period_file(Pipeline(repeated_register, TEST_CONFIG))
    for output in ("exchange_lines", "rejects"):
        assert Counter(getattr(own, output).collect()) == Counter(getattr(whole, output).collect()), output
    joined = {name: df for name, df in stages.items() if "date_processed" in df.columns and name not in ("payments", "lor", "renewals_new")}
    assert {"renewals_in_period", "renewals_split", "lor_ranges_period"} <= set(joined)
    for name, df in joined.items():
        assert df.count() == reports.in_period(df, *TEST_CONFIG.period).count(), name
    forms = repeated_register.formslog.where(F.col("form_type_num") == extracts.FORM_RENEWAL).count()
    assert 0 < stages["payments"].where("source = 'Legacy'").count() <= 2 * forms


def test_counted_payments_stand_for_the_renewals(spark, repeated_register):
    """Rows counted before the join are those of the join, by day and by year, with forms of unknown applications too."""
    from annuity.operators import rules
    from annuity.plans.pipeline import Pipeline

    src = repeated_register.replaced(standing=lambda: repeated_register.standing.where("length(trim(publication_num)) % 3 > 0 or substring(application_num, 9, 1) > '2'"))
    p = Pipeline(src, TEST_CONFIG)
    keys = [*extracts.PAYMENT_COLUMNS, "source"]
    want = p.renewals.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    assert Counter(p.counted_payments.groupBy(*keys).agg(F.sum("_rows").alias("n")).collect()) == Counter(want.collect())
    days, counted = ({tuple(r) for r in rules.multiple_payment_groups(x).collect()} for x in (p.renewals, p.counted_payments))
    assert days and days == counted


def test_stored_cases_and_incidents_have_no_ids_of_their_own(spark, sf_small, stages):
    from annuity.plans.pipeline import PERIOD_EXTRACTS
    from annuity.plans.queries import pipeline

    pipeline(spark, sf_small).for_period(*PERIOD_EXTRACTS)
    assert "incident_id" not in stages["incident"].columns and "case_id" not in stages["case"].columns
    kinds = {r[0] for r in stages["case"].select("case_category_id").distinct().collect()}
    assert kinds == {extracts.CATEGORY_RESTORATION, extracts.CATEGORY_LOR}


def test_licences_of_both_systems_collapse_once(spark, sf_small, shuffled_joins):
    """The forms before their join and the union after it: no aggregate of each system's rows between them."""
    from annuity.operators import merge
    from annuity.plans.queries import pipeline
    from annuity.schemas import KIND_LOR

    p = pipeline(spark, sf_small)
    twice = merge.dedupe_union(p.lor_legacy, p.lor_new, KIND_LOR)
    assert plan(p.lor).count("HashAggregate(keys") == 4 < plan(twice).count("HashAggregate(keys")
    assert Counter(p.lor.collect()) == Counter(twice.collect())


@pytest.mark.parametrize("name", ["exchange_file_written", "exchange_reconciliation"])
def test_written_file_stores_joined_rows_of_the_period_alone(spark, sf_small, stages, name):
    from annuity.operators import reports

    assert QUERIES[name](spark, sf_small).count() > 0
    assert not {"renewals", "lor_ranges_all"} & set(stages)
    for stage in ("renewals_in_period", "lor_ranges_period"):
        df = stages[stage]
        assert 0 < df.count() == reports.in_period(df, *TEST_CONFIG.period).count(), stage
