"""Contact journey features: contact events counted per policy term in many breakdowns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.dates import band_of, phase_of, shift_months
from millrace.functions.text import recode, split_id
from millrace.operators.aggregates import pivot_counts, sum_across
from millrace.operators.joins import map_values
from millrace.operators.ranges import interval_join
from millrace.operators.shape import dim

# Listed breakdown values, in output order.
CHANNELS = ("Phone", "Email", "Fax", "SMS", "Mail", "Handler", "System", "Web")
DAY_PARTS = ("Morning", "Daytime", "Primetime", "Latenight", "Overnight")
PHASES = ("Startperiod", "Endperiod")
WEEKDAYS = ("Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun")
STATUSES = (
    "audit", "bill", "cancel", "email_tp", "endorsement", "evidence", "nonrenewal", "other", "pay", "quote",
    "renewal", "service", "unknown",
)

# Touch point to status.
TOUCH_STATUS = {
    "Pay my Bill": "pay", "Renewal Support": "renewal", "Renewal Statement": "renewal", "Fee / Tax": "bill",
    "Billing Statement": "bill", "Endorsement": "endorsement", "Cancellation": "cancel",
    "Change coverage": "endorsement", "Service": "service", "Email Event": "email_tp", "Get Quote": "quote",
    "Service Call": "service", "null": "unknown", "Evidence of Coverage": "evidence", "Delay Renewal": "renewal",
    "UW Call": "service", "Billing Call": "bill", "Purchase Policy": "quote", "Service Survey": "service",
    "Inbound eMail": "email_tp", "Disbursement": "bill", "Release Renewal Hold": "renewal",
    "Non Renew": "nonrenewal", "Do Not Renew": "nonrenewal", "Fee / Tax Reversal": "bill",
    "Post Issuance - Admin Work": "quote", "Missing Info": "unknown", "Coverage Checkup": "service",
    "Update Contact Info": "service", "General Notice": "service", "Cancellation Request": "cancel",
    "Issue Policy": "quote", "Playbook": "other", "Renewal": "renewal", "Payment Confirmation": "pay",
    "Reinstatement": "other", "Cancellation Notice": "cancel", "Welcome": "other",
    "Register for My Account": "other", "Audit Method Assigned": "audit", "Welcome Survey": "other",
    "Renwal Retention call": "renewal", "Collection": "bill", "Audit Complete": "audit",
    "Broker of Record": "other", "Audit Statement": "audit", "Audit Complete - prem adj": "audit",
    "Post Issuance - Loss Control": "other", "Audit Work Complete": "audit", "Audit Servicing": "audit",
    "Audit Due date": "audit", "Field Audit Travel": "audit", "Audit Notice": "audit",
    "Reprice Request": "other", "eConsent": "other", "Loss Payment": "other",
    "Disbute Bill": "bill", "Audit Scheduled": "audit", "Pre Issuance - Prep Work": "quote",
    "Reset Password": "other", "Billing": "bill", "Filings": "other", "Audit Survey": "audit",
    "Form Request": "other", "Audit Call": "audit", "Expensed": "other", "Payment Correciton": "bill",
    "E-mail Survey Delivered": "email_tp", "Reinstatements Call": "other", "Establish Bill Plan": "bill",
    "Report a Claim": "other", "VIP Service": "other", "Quote Survey": "other", "New Business": "other",
    "Post Issuance - Vendor Support": "other", "External Billing Services": "other", "Audit Uploaded": "other",
    "Directory Call": "other", "Post Issuance - Premium Finance": "other",
    "Refer to UW": "other", "Settle Claim": "other", "Post Issuance - General Admin": "other",
    "Claim Servicing": "other", "Charge Off": "other", "Survey Alert": "other", "Billing Adjustment": "other",
    "Spanish Speaker Call": "other", "Missing Information": "other", "Web Inquiry Call": "other",
    "Renewal Conversion": "other", "Change my Billing": "other", "Error": "other",
    "Technology UW": "other", "Reconciliation": "other", "Account unlock": "other", "Applications": "other",
    "Experience Mod": "other", "Coding": "other", "Invite to login": "other", "Collection Reversal": "other",
    "AMP Call": "other", "Process": "other", "Undefined Call": "other", "CRIT": "other",
    "UWA Quality Survey": "other", "Audit Documents Received": "other", "Quote": "other", "SMS Event": "other",
    "Cancellation awaiting Audit": "other", "Payment Reversal": "other",
    "Risk Engineering": "other", "Undefined": "other", "Evaluate": "other", "Alert": "other",
    "Communication": "other", "Commission": "other", "Agency Appointments": "other",
}


def touch_map(spark: SparkSession) -> DataFrame:
    return dim(spark, list(TOUCH_STATUS.items()), "touch_point string, touch_point_status string")


def with_term_end(terms: DataFrame, start: str = "term_eff_dt", end: str = "term_end_dt") -> DataFrame:
    """A term ends one average year, cut to whole days, after it starts."""
    return shift_months(terms, start, 12, mode="fixed", out=end)


def _name(value: str) -> str:
    return f"no_of_{value.lower()}_cnts"


def journey_events(events: DataFrame, terms: DataFrame, touches: DataFrame, fill_status: bool = False) -> DataFrame:
    """Events inside a policy term with their channel, day part, phase, weekday and touch status.

    An unmapped touch point keeps a null status unless ``fill_status`` calls it unknown.
    """
    ids = events.withColumn("pol_id", split_id(F.col("pol_id")))
    inside = interval_join(ids, with_term_end(terms), "pol_id", "date_time", "term_eff_dt", "term_end_dt")
    marked = recode(inside, "channel", {"eMail": "Email"}).withColumns({
        "day_part": band_of(F.hour("date_time")),
        "term_phase": phase_of(F.datediff("date_time", "term_eff_dt")),
        "weekday": F.date_format("date_time", "E"),
    })
    mapped = map_values(marked, "touch_point", touches)
    return mapped.fillna({"touch_point": "unknown", **({"touch_point_status": "unknown"} if fill_status else {})})


def journey_features(events: DataFrame, terms: DataFrame, touches: DataFrame, fill_status: bool = False,
                     null_as_zero: bool = False) -> DataFrame:
    """One wide row per (policy, term start): counts per listed value, all in one grouped pass."""
    specs = {
        "channel": {v: _name(v) for v in CHANNELS},
        "day_part": {v: _name(v) for v in DAY_PARTS},
        "term_phase": {v: _name(v) for v in PHASES},
        "weekday": {v: _name(v) for v in WEEKDAYS},
        "touch_point_status": {v: _name(v) for v in STATUSES},
    }
    wide = pivot_counts(journey_events(events, terms, touches, fill_status), ["pol_id", "term_eff_dt"], specs, ("channel", "no_of_cnts"))
    return wide.withColumns({
        "no_of_weekday_cnts": sum_across([_name(d) for d in WEEKDAYS[:5]], null_as_zero),
        "no_of_weekendday_cnts": sum_across([_name(d) for d in WEEKDAYS[5:]], null_as_zero),
    })
