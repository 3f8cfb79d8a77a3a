"""Declared column lists of the claim data (fixed values)."""

from __future__ import annotations

from pyspark.sql import types as T

TEXT, NUMBER, WHOLE, DATE = T.StringType(), T.DoubleType(), T.LongType(), T.DateType()

# The 60 columns of a claim sheet, in order, with their type class.
CLAIM_SHEET = (
    ("CLAIM_NUMBER", TEXT), ("PRODUCT", TEXT), ("ACCIDENT_DATE", DATE), ("CLAIM_STATUS", TEXT),
    ("WC_CLAIM_TYPE", TEXT), ("CLAIMANT_NAME", TEXT), ("LOCATION_NAME", TEXT), ("ACCIDENT_CITY_OR_TOWN", TEXT),
    ("ACCIDENT_STATE", TEXT), ("TOTAL_PAID", NUMBER), ("TOTAL_INCURRED", NUMBER),
    ("ACCIDENT_DESCRIPTION_DETAILS", TEXT), ("CLAIM_DESCRIPTION", TEXT), ("NCCI_NATURE_OF_INJURY_DESCRIPT", TEXT),
    ("NCCI_BODY_PART_DESCRIPTION", TEXT), ("INJURY_SEVERITY_DESCRIPTION", TEXT), ("REPORTED_DATE", DATE),
    ("LAG_TIME_DAYS", WHOLE), ("EMPLOYER_REPORTED_DATE", DATE), ("RELEASED_TO_WORK_DATE", DATE),
    ("RETURNED_WITH_RESTRICTIONS_IND", TEXT), ("POLICY_NUMBER", TEXT), ("POLICY_EFFECTIVE_DATE", DATE),
    ("POLICY_EXPIRATION_DATE", DATE), ("POLICY_PERIOD", WHOLE), ("MEDICAL_OR_PD_PAID", NUMBER),
    ("INDEMNITY_OR_BI_PAID", NUMBER), ("EXPENSE_PAID", NUMBER), ("MEDICAL_OR_PD_INCURRED", NUMBER),
    ("INDEMNITY_OR_BI_INCURRED", NUMBER), ("EXPENSE_INCURRED", NUMBER), ("CLAIMANT_BIRTH_DATE", DATE),
    ("CLAIMANT_HIRE_DATE", DATE), ("CLAIMANT_OCCUPATION", TEXT), ("CLOSED_DATE", DATE), ("DRIVER", TEXT),
    ("AT_TIME_AWAY_FROM_WORK", WHOLE), ("NCCI_CAUSE_OF_INJURY_CODE", TEXT), ("NCCI_CAUSE_OF_INJURY_DESCRIPTI", TEXT),
    ("NCCI_NATURE_OF_INJURY_CODE", TEXT), ("NCCI_BODY_PART_CODE", TEXT), ("LITIGATION_STATUS", TEXT),
    ("LOCATION_CODE", TEXT), ("FULL_LOCATION_CODE", TEXT), ("HIERARCHY_OF_LOCATION_LEVEL_2", TEXT),
    ("HIERARCHY_OF_LOCATION_LEVEL_3", TEXT), ("HIERARCHY_OF_LOCATION_LEVEL_4", TEXT),
    ("HIERARCHY_OF_LOCATION_LEVEL_5", TEXT), ("VALUATION_DATE", DATE), ("MEDICAL_OR_PD_RESERVE", NUMBER),
    ("INDEMNITY_OR_BI_RESERVE", NUMBER), ("EXPENSE_RESERVE", NUMBER), ("TOTAL_RESERVE", NUMBER),
    ("TOTAL_RECOVERIES", NUMBER), ("CARRIER", TEXT), ("ENTITY", TEXT), ("EMAIL_FULL_SUBJECT_LINE", TEXT),
    ("ENTITY_FROM_EMAIL_SUBJECT_LINE", TEXT), ("ENTITY_FOR_TEXT_MATCHING", TEXT), ("RECORD_INSERTION_DATE", DATE),
)

# The history keeps the sheet's columns but for two working names, and adds these.
HISTORY_DROPS = ("ENTITY", "ENTITY_FROM_EMAIL_SUBJECT_LINE")
HISTORY_ADDS = (
    ("ACCOUNT_NAME", TEXT), ("NEW_RENEWAL", TEXT), ("STATUS", TEXT), ("IS_SHEET", WHOLE), ("CLM_IDNTFR", TEXT),
    ("ORGNZTN_IDNTFR", TEXT), ("IS_MASTER", WHOLE), ("ENTITY_FINAL", TEXT), ("OPRTNS_DSCRPTN", TEXT),
    ("TERM_EFFCTV_DATE", DATE), ("TERM_EXPRTN_DATE", DATE),
)


def struct(columns) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns])


def claim_sheet() -> T.StructType:
    return struct(CLAIM_SHEET)


def loss_history() -> T.StructType:
    return struct([c for c in CLAIM_SHEET if c[0] not in HISTORY_DROPS] + list(HISTORY_ADDS))
