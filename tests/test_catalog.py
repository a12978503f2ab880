"""The metastore reader maps the source systems' own tables onto the canonical model."""

import pytest
from pyspark.sql import functions as F

from annuity.operators import extracts
from annuity.plans.queries import TEST_CONFIG
from annuity.sources.tables import CATALOG_LEGACY, from_catalog
from annuity.sources.testdata import fixture_tables


def _save(df, name, mapping):
    """Store ``df`` as the systems do: days as timestamps late on the day, codes and years as numbers or text."""
    for c, kind in df.dtypes:
        if kind == "date":
            df = df.withColumn(c, (F.col(c).cast("timestamp") + F.expr("interval 23 hours 15 minutes")))
        elif c == "reason_not_in_force":
            df = df.withColumn(c, F.col(c).cast("int"))
        elif c in ("renewal_year", "last_renewal_year", "register_indicator"):
            df = df.withColumn(c, F.col(c).cast("string"))
        elif c in ("fee_taken", "total_fee"):
            df = df.withColumn(c, F.col(c).cast("double"))
    df.select(*[F.col(canonical).alias(source) for canonical, source in mapping.items()]) \
        .write.mode("overwrite").saveAsTable(name)


@pytest.fixture(scope="module")
def catalog_sources(spark, sf_small, tmp_path_factory):
    fx = fixture_tables(spark, sf_small)
    for db in ["cops_ldb", "crm_ldb", "mds_ldb"]:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}")
    for name, (table, cols) in CATALOG_LEGACY.items():
        _save(getattr(fx, name), table, {v: k for k, v in cols.items()})
    _save(fx.incident, "crm_ldb.ipo_incident_iprights", {"incident_id": "incidentid", "right_id": "ipo_iprightId"})
    _save(fx.incident, "crm_ldb.incident", {
        "incident_id": "incidentid", "servicerequest_id": "ipo_servicerequestid",
        "date_filed": "ipo_datefiled", "date_completed": "ipo_datecompleted"})
    _save(fx.servicerequest, "crm_ldb.ipo_servicerequest", {
        "id": "Id", "type_name": "ipo_servicerequesttypeidname", "renewal_year": "ipo_renewalyear",
        "prescribed_uk_fee": "ipo_prescribedukfee", "lor_indicator": "ipo_lorindicator"})
    _save(fx.right, "crm_ldb.ipo_ipright", {
        "right_id": "ipo_iprightid", "application_num": "ipo_applicationid", "publication_num": "ipo_publicationid",
        "filing_date": "ipo_applicationdate", "grant_date": "ipo_bpublicationdate",
        "renewal_year": "ipo_renewalyear", "next_renewal_date": "ipo_nextrenewaldate"})
    _save(fx.fees, "crm_ldb.ipo_fees", {"fee_id": "ipo_feesid", "right_id": "ipo_rightid", "total_fee": "ipo_totalfee"})
    _save(fx.register_right, "mds_ldb.Right", {
        "right_id": "RightId", "termination_reason_id": "TerminationReasonId",
        "termination_date": "TerminationDate", "restoration_date": "RestorationDate"})
    _save(fx.register_right, "mds_ldb.Patent", {
        "right_id": "RightId", "application_num": "ApplicationNumber", "publication_num": "PublicationNumber",
        "filing_date": "LegalFilingDate", "grant_date": "BPublicationDate"})
    fx.case.select(F.col("case_id").alias("RightCaseId"), F.col("right_id").alias("RightId"),
                   F.col("case_id").alias("CaseId")).write.mode("overwrite").saveAsTable("mds_ldb.RightCase")
    _save(fx.case, "mds_ldb.Case", {
        "case_id": "CaseId", "case_category_id": "CaseCategoryId", "case_create_date": "CaseCreateDate"})
    _save(fx.casecategory, "mds_ldb.CaseCategory", {
        "case_category_id": "CaseCategoryId", "case_category": "CaseCategory"})
    _save(fx.terminationreason, "mds_ldb.TerminationReason", {
        "termination_reason_id": "TerminationReasonId", "description": "TerminationReasonDescription"})
    _save(fx.licenceofright, "mds_ldb.LicenceOfRight", {
        "right_id": "RightId", "lor_granted_date": "LORGrantedDate", "lor_cancelled_date": "LORCancelledDate"})
    _save(fx.registerevent, "mds_ldb.RegisterEvent", {
        "case_id": "RightCaseId", "event_date": "EventDate", "register_indicator": "RegisterIndicator"})
    fee_csv = str(tmp_path_factory.mktemp("fees") / "minimum_fees.csv")
    fx.minimum_fee.write.option("header", True).csv(fee_csv)
    return fx, from_catalog(spark, fee_csv)


@pytest.mark.parametrize("extract", [
    extracts.renewals_new, extracts.renewals_legacy, extracts.restorations_legacy, extracts.restorations_new,
    extracts.lor_legacy, extracts.lor_new,
    lambda s: extracts.lapses_legacy(s, *TEST_CONFIG.period),
    lambda s: extracts.lapses_new(s, *TEST_CONFIG.period),
])
def test_catalog_extract_equals_fixture_extract(catalog_sources, extract):
    fixture, catalog = catalog_sources
    a, b = extract(fixture), extract(catalog)
    assert a.count() > 0
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_catalog_events_of_the_last_day_stay_in_the_period(catalog_sources):
    """Stored at 23:15 of the period's last day."""
    _, catalog = catalog_sources
    start, end = TEST_CONFIG.period
    assert dict(catalog.reghist.dtypes)["reg_date"] == "date"
    assert catalog.registerevent.where(F.col("event_date") == end).count() == catalog.registerevent.where(
        F.col("event_date").between(end, end)).count()


def test_catalog_minimum_fees(catalog_sources):
    fixture, catalog = catalog_sources
    assert sorted(map(tuple, fixture.minimum_fee.collect())) == sorted(map(tuple, catalog.minimum_fee.collect()))
