"""Canonical column sets and types shared by every operator."""

from pyspark.sql import types as T

MONEY = T.DecimalType(12, 2)
MONEY_SUM = T.DecimalType(18, 2)

RENEWAL_KEYS = ["application_num", "publication_num", "renewal_year"]

RENEWAL_COLUMNS = [
    "application_num",
    "publication_num",
    "filing_date",
    "grant_date",
    "renewal_year",
    "renewal_fee",
    "prescribed_uk_fee",
    "lor_indicator",
    "renewal_due_date",
    "next_renewal_date",
    "late_fee",
    "late_months",
    "date_filed",
    "date_processed",
]

EVENT_COLUMNS = [
    "application_num",
    "publication_num",
    "filing_date",
    "grant_date",
    "date_filed",
    "date_processed",
]

LOR_COLUMNS = EVENT_COLUMNS + ["Addition_Deletion"]

LAPSE_COLUMNS = ["publication_num", "filing_date", "lapsed_reason", "lapsed_date", "date_processed"]

# Partition column of the stored history.
PROCESSED_YEAR = "processed_year"

# Merged history: every renewal column plus the system tag and event kind.
HISTORY_COLUMNS = RENEWAL_COLUMNS + ["source", "type_identifier"]

# Types of the canonical source columns that rules compute with. Other columns
# (keys, names, descriptions) keep the type they are stored with.
DATE_SOURCE_COLUMNS = {
    "filing_date", "grant_date", "renewal_date", "restore_date", "restore_allowed_date", "date_of_lor",
    "date_lor_cancel", "date_not_in_force", "date_filed", "date_actioned", "event_date", "reg_date",
    "date_completed", "next_renewal_date", "termination_date", "restoration_date", "case_create_date",
    "lor_granted_date", "lor_cancelled_date",
}
INT_SOURCE_COLUMNS = {
    "form_type_num", "last_renewal_year", "extension_months", "renewal_year", "case_category_id",
    "register_indicator",
}
MONEY_SOURCE_COLUMNS = {"fee_taken", "extension_fee_taken", "prescribed_uk_fee", "total_fee"}
# Codes written with leading zeros, and their width.
CODE_SOURCE_COLUMNS = {"reason_not_in_force": 2}

MINIMUM_FEE_SCHEMA = T.StructType(
    [
        T.StructField("year_set", T.StringType()),
        T.StructField("minimum_fee_year", T.StringType()),
        T.StructField("minimum_fee_amount", T.StringType()),
    ]
)

# How many equal rows one row stands for, in frames that count rows before they are joined.
ROWS = "_rows"

# Source-system tags and event kinds written to the history
# table and the reports.
SOURCE_NEW = "Dynamics"
SOURCE_LEGACY = "Legacy"
KIND_RENEWAL = "Renewals"
KIND_RESTORATION = "Restoration"
KIND_LOR = "Licence of Right"
