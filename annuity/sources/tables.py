"""The canonical source model and readers for it.

Every operator reads ``SourceTables``: the legacy register (``standing``,
``formslog``, ``reghist``), the new case-management system (``incident``,
``servicerequest``, ``right``, ``fees``, ``register_right``, ``case``, ``casecategory``,
``terminationreason``, ``licenceofright``, ``registerevent``) and the
minimum-fee reference table. Column names are canonical (see ``CANONICAL``);
``from_catalog`` maps a metastore's own table and column names onto them.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from annuity.schemas import (
    CODE_SOURCE_COLUMNS,
    DATE_SOURCE_COLUMNS,
    INT_SOURCE_COLUMNS,
    MINIMUM_FEE_SCHEMA,
    MONEY,
    MONEY_SOURCE_COLUMNS,
)

CANONICAL = {
    "standing": [
        "application_num", "publication_num", "filing_date", "grant_date", "renewal_date",
        "restore_date", "restore_allowed_date", "date_of_lor", "date_lor_cancel",
        "date_not_in_force", "reason_not_in_force",
    ],
    "formslog": [
        "case_key", "form_type_num", "date_filed", "date_actioned", "last_renewal_year",
        "fee_taken", "extension_fee_taken", "extension_months",
    ],
    "reghist": ["case_key", "event_date", "reg_date"],
    "incident": ["incident_id", "servicerequest_id", "right_id", "date_filed", "date_completed"],
    "servicerequest": ["id", "type_name", "renewal_year", "prescribed_uk_fee", "lor_indicator"],
    "right": [
        "right_id", "application_num", "publication_num", "filing_date", "grant_date",
        "renewal_year", "next_renewal_date",
    ],
    "register_right": [
        "right_id", "application_num", "publication_num", "filing_date", "grant_date",
        "termination_reason_id", "termination_date", "restoration_date",
    ],
    "fees": ["fee_id", "right_id", "total_fee"],
    "case": ["case_id", "right_id", "case_create_date", "case_category_id"],
    "casecategory": ["case_category_id", "case_category"],
    "terminationreason": ["termination_reason_id", "description"],
    "licenceofright": ["right_id", "lor_granted_date", "lor_cancelled_date"],
    "registerevent": ["case_id", "event_date", "register_indicator"],
    "minimum_fee": ["year_set", "minimum_fee_year", "minimum_fee_amount"],
}


class SourceTables:
    """The canonical source tables; each may be given as a DataFrame or a zero-argument factory.

    Factories are called on first access, so a plan that reads two tables
    never builds the other twelve.
    """

    def __init__(self, quarantine: Callable[[], DataFrame | None] | None = None,
                 **tables: DataFrame | Callable[[], DataFrame]):
        self._quarantine = quarantine
        unknown = set(tables) - set(CANONICAL)
        missing = set(CANONICAL) - set(tables)
        if unknown or missing:
            raise ValueError(f"source tables: unknown {sorted(unknown)}, missing {sorted(missing)}")
        self._tables = dict(tables)

    def __getattr__(self, name: str) -> DataFrame:
        tables = self.__dict__.get("_tables", {})
        if name not in tables:
            raise AttributeError(name)
        value = tables[name]
        if not isinstance(value, DataFrame):
            value = tables[name] = value()
        return value

    @property
    def quarantine(self) -> DataFrame | None:
        """Values that are not of their column's type: (table, key, column, value).

        Their rows take no part in the run. None where no source column is cast.
        """
        return self._quarantine() if self._quarantine else None

    def replaced(self, **tables: DataFrame | Callable[[], DataFrame]) -> "SourceTables":
        """The same sources with some tables replaced."""
        own = {name: (lambda name=name: getattr(self, name)) for name in CANONICAL}
        return SourceTables(self._quarantine, **(own | tables))

    def __repr__(self) -> str:
        return f"SourceTables({', '.join(CANONICAL)})"

    def validate(self) -> "SourceTables":
        """Fail fast when a table lacks a canonical column."""
        for name, cols in CANONICAL.items():
            have = set(getattr(self, name).columns)
            missing = [c for c in cols if c not in have]
            if missing:
                raise ValueError(f"source table {name} lacks columns {missing}")
        return self


_CORRUPT = "_corrupt"


def _fee_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of the minimum-fee CSV as text columns with ``_reason``: why a line is no fee, else null."""
    schema = T.StructType([*MINIMUM_FEE_SCHEMA, T.StructField(_CORRUPT, T.StringType())])
    lines = (spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE")
             .option("columnNameOfCorruptRecord", _CORRUPT).csv(path))
    kinds = {"year_set": "int", "minimum_fee_year": "int", "minimum_fee_amount": MONEY.simpleString()}
    no_number = [F.when(F.trim(c).try_cast(kind).isNull(), F.lit(f"{c} is no number")) for c, kind in kinds.items()]
    return lines.withColumn("_reason", F.coalesce(
        F.when(F.col(_CORRUPT).isNotNull(), F.lit(f"not {len(kinds)} columns")), *no_number))


def read_minimum_fees(spark: SparkSession, path: str) -> DataFrame:
    """Minimum-fee CSV with a header row: its good lines, every column as text."""
    return _fee_lines(spark, path).where(F.col("_reason").isNull()).select(*MINIMUM_FEE_SCHEMA.names)


def rejected_minimum_fees(spark: SparkSession, path: str) -> DataFrame:
    """(record, reason): lines of the minimum-fee CSV that are too short, too long or hold no numbers."""
    text = F.coalesce(F.col(_CORRUPT), F.concat_ws(",", *[F.coalesce(c, F.lit("")) for c in MINIMUM_FEE_SCHEMA.names]))
    return (_fee_lines(spark, path).where(F.col("_reason").isNotNull())
            .select(text.alias("record"), F.col("_reason").alias("reason")))


def _casts(df: DataFrame) -> dict[str, Column]:
    """The columns of ``df`` that are not stored in their declared type, cast; null where a value does not fit."""
    out = {}
    for name, kind in df.dtypes:
        c = F.col(name)
        if name in DATE_SOURCE_COLUMNS and kind != "date":
            out[name] = c.try_cast("date")
        elif name in INT_SOURCE_COLUMNS and kind != "int":
            out[name] = c.try_cast("int")
        elif name in MONEY_SOURCE_COLUMNS and kind != MONEY.simpleString():
            out[name] = c.try_cast(MONEY)
        elif name in CODE_SOURCE_COLUMNS and kind != "string":
            out[name] = F.lpad(c.try_cast("decimal(20,0)").cast("string"), CODE_SOURCE_COLUMNS[name], "0")
    return out


def _misfits(casts: dict[str, Column]) -> dict[str, Column]:
    return {name: F.col(name).isNotNull() & cast.isNull() for name, cast in casts.items()}


def typed(df: DataFrame) -> DataFrame:
    """Source columns in the types the rules compute with; rows with a value that does not fit are left out.

    Systems store days as timestamps (an event timed on the last day of a
    period still belongs to it), years as text, and codes as numbers that have
    lost their leading zeros. A column that has its type already is left
    untouched, so filters on it still reach the scan. ``misfits`` has the values left out.
    """
    casts = _casts(df)
    for wrong in _misfits(casts).values():
        df = df.where(~wrong)
    return df.select([casts.get(name, F.col(name)).alias(name) for name in df.columns])


def misfits(df: DataFrame, table: str) -> DataFrame | None:
    """(table, key, column, value): the values of ``df`` that do not fit their declared type; None if nothing is cast."""
    wrong = _misfits(_casts(df))
    if not wrong:
        return None
    found = F.array_compact(F.array(*[F.when(bad, F.struct(F.lit(name).alias("column"), F.col(name).cast("string").alias("value")))
                                      for name, bad in wrong.items()]))
    key = F.col(CANONICAL[table][0]).cast("string")
    return df.select(F.lit(table).alias("table"), key.alias("key"), F.inline(found))


def checked_sources(tables: dict[str, DataFrame | Callable[[], DataFrame]], minimum_fee: DataFrame | Callable[[], DataFrame],
                    rejected_fees: DataFrame | None = None) -> SourceTables:
    """Tables as stored, brought to their declared types; what does not fit goes to ``quarantine``."""
    frame = lambda t: t if isinstance(t, DataFrame) else t()

    def quarantine() -> DataFrame | None:
        parts = [x for x in (misfits(frame(t), name) for name, t in tables.items()) if x is not None]
        if rejected_fees is not None:
            parts.append(rejected_fees.select(F.lit("minimum_fee").alias("table"), F.lit(None).cast("string").alias("key"),
                                              F.col("reason").alias("column"), F.col("record").alias("value")))
        return reduce(DataFrame.unionByName, parts) if parts else None

    return SourceTables(quarantine, **{name: (lambda t=t: typed(frame(t))) for name, t in tables.items()}, minimum_fee=minimum_fee)


def _renamed(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    return df.select([F.col(src).alias(dst) for src, dst in mapping.items()])


# Metastore table and column names of the two source systems,
# mapped to canonical names (source name -> canonical name).
CATALOG_LEGACY = {
    "standing": ("cops_ldb.PR4300STANDING", {
        "PK_I4300_CASE_KEY": "application_num",
        "FK_PS_4000_4300_PK_I4000_CS_KY": "publication_num",
        "I4300_FILING_DATE_Expanded": "filing_date",
        "I4300_GRANT_DATE_Expanded": "grant_date",
        "I4300_RENEWAL_DATE_Expanded": "renewal_date",
        "I4300_RESTORE_DATE_Expanded": "restore_date",
        "I4300_RESTORE_ALLOWED_DATE_Expanded": "restore_allowed_date",
        "I4300_DATE_OF_LOR_Expanded": "date_of_lor",
        "I4300_DATE_LOR_CANCEL_Expanded": "date_lor_cancel",
        "I4300_DATE_NOT_IN_FORCE_Expanded": "date_not_in_force",
        "I4300_REASON_NOT_IN_FORCE": "reason_not_in_force",
    }),
    "formslog": ("cops_ldb.PR4330FORMSLOG", {
        "FK_I4300_CASE_KEY": "case_key",
        "I4330_FORM_TYPE_NUM": "form_type_num",
        "I4330_FILING_DATE_Expanded": "date_filed",
        "I4330_ACTIONED_DATE_Expanded": "date_actioned",
        "I4330_LAST_RENEWAL_YEAR": "last_renewal_year",
        "I4330_FEE_TAKEN": "fee_taken",
        "I4330_EXTENSION_FEE_TAKEN": "extension_fee_taken",
        "I4330_EXTENSION_MONTH": "extension_months",
    }),
    "reghist": ("cops_ldb.PR4340REGHIST", {
        "FK_I4300_CASE_KEY": "case_key",
        "I4340_EVENT_DATE_Expanded": "event_date",
        "I4340_REG_DATE_Expanded": "reg_date",
    }),
}


def from_catalog(spark: SparkSession, minimum_fee_path: str) -> SourceTables:
    """Read both systems from the metastore and map them to the canonical model.

    The new system keeps link tables apart (incident-right, right-patent,
    right-case); they are joined here once so the extracts see one row per
    incident, register right and right-case. The case-management right
    (``right``) and the register right (``register_right``) stay separate.
    """
    t = spark.table
    legacy = {name: _renamed(t(table), cols) for name, (table, cols) in CATALOG_LEGACY.items()}

    link = t("crm_ldb.ipo_incident_iprights").select(
        F.col("incidentid").alias("incident_id"), F.col("ipo_iprightId").alias("right_id"))
    incident = link.join(
        t("crm_ldb.incident").select(
            F.col("incidentid").alias("incident_id"),
            F.col("ipo_servicerequestid").alias("servicerequest_id"),
            F.col("ipo_datefiled").alias("date_filed"),
            F.col("ipo_datecompleted").alias("date_completed")),
        "incident_id", "left")
    servicerequest = _renamed(t("crm_ldb.ipo_servicerequest"), {
        "Id": "id", "ipo_servicerequesttypeidname": "type_name", "ipo_renewalyear": "renewal_year",
        "ipo_prescribedukfee": "prescribed_uk_fee", "ipo_lorindicator": "lor_indicator"})
    crm_right = _renamed(t("crm_ldb.ipo_ipright"), {
        "ipo_iprightid": "right_id", "ipo_applicationid": "application_num",
        "ipo_publicationid": "publication_num", "ipo_applicationdate": "filing_date",
        "ipo_bpublicationdate": "grant_date", "ipo_renewalyear": "renewal_year",
        "ipo_nextrenewaldate": "next_renewal_date"})
    register_right = (
        _renamed(t("mds_ldb.Right"), {
            "RightId": "right_id", "TerminationReasonId": "termination_reason_id",
            "TerminationDate": "termination_date", "RestorationDate": "restoration_date"})
        .join(_renamed(t("mds_ldb.Patent"), {
            "RightId": "right_id", "ApplicationNumber": "application_num",
            "PublicationNumber": "publication_num", "LegalFilingDate": "filing_date",
            "BPublicationDate": "grant_date"}), "right_id", "left"))
    fees = _renamed(t("crm_ldb.ipo_fees"), {
        "ipo_feesid": "fee_id", "ipo_rightid": "right_id", "ipo_totalfee": "total_fee"})
    case = (_renamed(t("mds_ldb.RightCase"), {
                "RightCaseId": "case_id", "RightId": "right_id", "CaseId": "_case"})
            .join(_renamed(t("mds_ldb.Case"), {
                "CaseId": "_case", "CaseCategoryId": "case_category_id",
                "CaseCreateDate": "case_create_date"}), "_case", "left")
            .drop("_case"))
    tables = dict(
        **legacy,
        incident=incident,
        servicerequest=servicerequest,
        right=crm_right,
        register_right=register_right,
        fees=fees,
        case=case,
        casecategory=_renamed(t("mds_ldb.CaseCategory"), {
            "CaseCategoryId": "case_category_id", "CaseCategory": "case_category"}),
        terminationreason=_renamed(t("mds_ldb.TerminationReason"), {
            "TerminationReasonId": "termination_reason_id",
            "TerminationReasonDescription": "description"}),
        licenceofright=_renamed(t("mds_ldb.LicenceOfRight"), {
            "RightId": "right_id", "LORGrantedDate": "lor_granted_date",
            "LORCancelledDate": "lor_cancelled_date"}),
        registerevent=_renamed(t("mds_ldb.RegisterEvent"), {
            "RightCaseId": "case_id", "EventDate": "event_date",
            "RegisterIndicator": "register_indicator"}),
    )
    return checked_sources(tables, read_minimum_fees(spark, minimum_fee_path),
                           rejected_minimum_fees(spark, minimum_fee_path)).validate()


MINIMUM_FEE_CSV = "minimum_fee.csv"


def from_storage(spark: SparkSession, root: str, fmt: str = "parquet") -> SourceTables:
    """Canonical tables stored one folder per table under ``root``, fees as CSV.

    ``{root}/{table}`` holds each table in ``fmt``; ``{root}/minimum_fee.csv``
    is the minimum-fee file with a header row.
    """
    root = root.rstrip("/")
    tables = {name: spark.read.format(fmt).load(f"{root}/{name}") for name in CANONICAL if name != "minimum_fee"}
    fees = f"{root}/{MINIMUM_FEE_CSV}"
    return checked_sources(tables, read_minimum_fees(spark, fees), rejected_minimum_fees(spark, fees)).validate()


def write_storage(src: SourceTables, root: str, fmt: str = "parquet", files: int | None = None) -> str:
    """Store every table of ``src`` in the layout ``from_storage`` reads.

    ``files`` spreads each table over that many files (a lake table is rarely
    one file); by default each task writes its own file.
    """
    root = root.rstrip("/")
    for name in CANONICAL:
        df = getattr(src, name).select(*CANONICAL[name])
        if files and name != "minimum_fee":
            df = df.repartition(files)
        if name == "minimum_fee":
            df.write.mode("overwrite").option("header", True).csv(f"{root}/{MINIMUM_FEE_CSV}")
        else:
            df.write.mode("overwrite").format(fmt).save(f"{root}/{name}")
    return root
