"""Declination report: one row per account request, widened by keyed side tables.

Every lookup is a frame with at most one row per key, built by an aggregate or a
group-limited ranking, and left-joined once; nothing is looked up row by row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import as_plain, phone_of, scrubbed
from millrace.operators.aggregates import eav_scalars, eav_sums, list_values, pivot_first, share_columns
from millrace.operators.filters import exclude_like, optional_filter
from millrace.operators.joins import fallback_lookup, first_lookup
from millrace.operators.ranges import asof_latest
from millrace.operators.ranking import priority_of, top_one
from millrace.session import kept, passing

# Element numbers of the attribute store behind each measure.
SUMS = {
    "booked_premium": 125, "net_written_premium": 126, "first_dollar_premium": 127, "loss_pick": (87, 102),
    "actual_lc": 42, "required_lc": 43, "net_at_income": 128, "combined_roe": 147, "actual_treaty": 35,
    "net_premium": 126, "target_premium": 242, "retro_loss": [71, 75, 79, 83],
}
ZERO_FILL = (
    "loss_pick", "actual_lc", "required_lc", "net_at_income", "combined_roe", "actual_treaty", "net_premium", "target_premium",
)
SCALARS = {"wc_claim_admin": 189, "gl_claim_admin": 433, "al_claim_admin": 434}
PRODUCT_ORDER = ["WC", "AL", "PREM", "PROD"]
CONTACT_ROLES = ("CONTACT", "INVOICE RECIPIENT")
TEAM_ROLES = {
    "H/O UNDERWRITER": "ho_underwriter", "LOSS CONTROL CONSULTANT": "lc_consultant",
    "LOSS CONTROL ACCOUNT MANAGER": "lc_account_manager", "LOSS CONTROL ACCOUNT EXECUTIVE": "lc_account_executive",
}

# Report columns with their titles, in order.
REPORT = [
    ("accnt_name", "Account Name"), ("eff_date", "Eff.Date"), ("address_1", "Address 1"), ("address_2", "Address 2"),
    ("city", "City"), ("state", "State"), ("zip", "Zip"), ("zip_extn", "Extn"), ("main_phone", "Main Phone"),
    ("contact_name", "Account Contact Name"), ("contact_phone", "Account Contact Phone"),
    ("operations", "Operation Description"), ("producer", "Producer"), ("producer_code", "Producer Code"),
    ("producer_contact", "Producer Contact Name"), ("produced_by", "Produced By"), ("status", "Status"),
    ("reason", "Reason"), ("successful_carrier", "Successful Carrier"), ("current_carrier", "Current Carrier"),
    ("credit_rating", "Credit Rating"), ("products", "Products"), ("loss_pick", "Total Loss Pick @250"),
    ("wc_claim_admin", "WC Claim Admin"), ("gl_claim_admin", "GL Claim Admin"), ("al_claim_admin", "AL Claim Admin"),
    ("first_dollar_premium", "First $ Eq. Premium"), ("booked_premium", "Booked Premium"),
    ("net_written_premium", "Net Written Premium"), ("total_exposure", "Total Exposure"), ("ca_exposure", "CA Exposure"),
    ("ca_exposure_pct", "CA Exposure Percent"), ("ro_code", "RO Code"), ("ro_name", "RO Name"),
    ("request_type", "New/Renewal"), ("ho_underwriter", "H/O Underwriter"), ("lc_consultant", "LC Consultant"),
    ("lc_account_manager", "LC Account Manager"), ("lc_account_executive", "LC Account Executive"),
    ("actual_lc", "Actual LC"), ("required_lc", "Required LC"), ("net_at_income", "Net AT Income"),
    ("combined_roe", "Combined ROE"), ("sold_to_guide_pct", "Sold to Guide (STG) %"),
]


def base_requests(requests: DataFrame, orgs: DataFrame, people: DataFrame, first, last, status: str | None = None,
                  segment: str | None = None, skip_org: int | None = None) -> DataFrame:
    """Requests in the date range with account, producer, office and assignee names.

    ``orgs`` plays three roles (account, producer, office). Accounts marked as not to
    be used, and optionally one excluded account, drop out.
    """
    rq = requests.filter(F.col("term_effctv_date").between(F.lit(first).cast("date"), F.lit(last).cast("date")))
    rq = optional_filter(optional_filter(rq, "stts_name", status), "sgmnt_name", segment, within=True)
    if skip_org is not None:
        rq = rq.filter(F.col("cnsmr_orgnztn_id") != skip_org)
    account = exclude_like(orgs, "orgnztn_name").select(
        F.col("orgnztn_id").alias("cnsmr_orgnztn_id"), F.col("orgnztn_name").alias("accnt_name"), F.col("oprtns_dscrptn").alias("__ops")
    )
    producer = orgs.select(F.col("orgnztn_id").alias("sbmttng_prdcr_orgnztn_id"), F.col("orgnztn_name").alias("producer"))
    office = orgs.select(F.col("orgnztn_id").alias("ro_orgnztn_id"), F.col("orgnztn_name").alias("ro_name"), F.col("orgnztn_shrt_name").alias("ro_code"))
    carrier = orgs.select(F.col("orgnztn_id").alias("sccssfl_crrr_id"), F.col("orgnztn_name").alias("successful_carrier"))
    last_name, first_name = (F.coalesce(c, F.lit("")) for c in ("last_name", "frst_name"))
    unknown = F.col("last_name").isNull() & F.col("frst_name").isNull()
    assignee = people.select(
        F.col("prsn_id").alias("assgnd_to_prsn_id"), F.when(~unknown, F.concat(last_name, F.lit(","), first_name)).alias("produced_by")
    )
    agent = people.select(
        F.col("prsn_id").alias("sbmttng_agnt_prsn_id"), F.concat(first_name, F.lit(" "), last_name).alias("producer_contact")
    )
    return (
        rq.join(account, "cnsmr_orgnztn_id").join(producer, "sbmttng_prdcr_orgnztn_id")
        .join(office, "ro_orgnztn_id", "left").join(assignee, "assgnd_to_prsn_id", "left")
        .join(agent, "sbmttng_agnt_prsn_id", "left").join(carrier, "sccssfl_crrr_id", "left")
        .withColumns({"operations": scrubbed(F.col("__ops")), "reason": scrubbed(F.col("rsn_text"), drop_commas=True)})
        .drop("__ops", "rsn_text")
    )


def chosen_options(requests: DataFrame, options: DataFrame, approvals: DataFrame) -> DataFrame:
    """The pricing option behind each request.

    Sold (request successful) or approved (request not successful): the newest such
    approval decides, and only if its option exists; otherwise the newest option.
    """
    wanted = approvals.join(requests.select("cnsmr_rqst_id", "stts_name"), "cnsmr_rqst_id").filter(
        ((F.col("stts_name") == "SUCCESSFUL") & (F.col("sold_indctr") == "Y"))
        | ((F.col("stts_name") != "SUCCESSFUL") & (F.col("apprvd_indctr") == "Y"))
    )
    newest = top_one(wanted, ["cnsmr_rqst_id"], [F.col("apprvl_id").desc()])
    agreed = newest.select("cnsmr_rqst_id", "smmry_optn_id").join(
        options.select("smmry_optn_id", "wrksht_optn_id"), "smmry_optn_id"
    )
    tiers = [t.select("cnsmr_rqst_id", "smmry_optn_id", "wrksht_optn_id") for t in (agreed, options)]
    return fallback_lookup(requests, tiers, "cnsmr_rqst_id", "smmry_optn_id")


def lone_information(infos: DataFrame) -> DataFrame:
    """The account information of each option that has exactly one; options with several are left out, as those with none."""
    found = infos.groupBy("smmry_optn_id").agg(F.count("*").alias("__n"), F.max("accnt_infrmtn_id").alias("accnt_infrmtn_id"))
    return found.filter(F.col("__n") == 1).drop("__n")


def option_measures(values: DataFrame, elements: DataFrame) -> DataFrame:
    """All attribute measures of an option's account information, with the derived sold-to-guide percentage.

    Sums and text picks are two aggregates: sums alone can be hashed, while text makes an
    aggregate sort its rows, and only the few elements picked as text need that. Both are
    partitioned by account information, so joining them moves nothing.
    """
    number, value = F.col("elmnt_nmbr"), F.col("nmbr_vl")
    listed = values.join(elements, "elmnt_id")
    sums = listed.groupBy("accnt_infrmtn_id").agg(*eav_sums(number, value, SUMS, ZERO_FILL))
    picks = listed.filter(number.isin(*SCALARS.values())).groupBy("accnt_infrmtn_id").agg(
        *eav_scalars(number, as_plain(value), F.col("char_vl"), SCALARS)
    )
    wide = sums.join(picks, "accnt_infrmtn_id", "left")
    base = F.col("target_premium") - F.col("retro_loss")
    guide = F.round((F.col("actual_treaty") + F.col("net_premium") - F.col("retro_loss")) * 100 / F.nullif(base, F.lit(0.0)), 1)
    return wide.withColumns({
        "net_at_income": F.round("net_at_income"), "combined_roe": F.round("combined_roe", 1), "sold_to_guide_pct": guide,
    }).drop("actual_treaty", "net_premium", "target_premium", "retro_loss")


def current_carriers(ratings: DataFrame) -> DataFrame:
    """First carrier per (request, option) by product priority, then newest plan date, then name."""
    order = [priority_of("prdct_shrt_name", PRODUCT_ORDER).asc(), F.col("plan_effctv_date").desc_nulls_first(), F.col("carrier_name").asc_nulls_last()]
    keys = ["cnsmr_rqst_id", "smmry_optn_id"]
    return top_one(ratings, keys, order).select(*keys, F.col("carrier_name").alias("current_carrier"))


def account_contacts(contacts: DataFrame) -> DataFrame:
    """One contact per account; the greater role name (invoice recipient) comes first."""
    listed = contacts.filter(F.col("role_name").isin(*CONTACT_ROLES) & (F.col("phn_usg") == "WORK"))
    phone = phone_of(*[F.col(c) for c in ("phn_area", "phn_exchng", "phn_nmbr", "phn_extnsn")])
    named = listed.select(
        "orgnztn_id", "role_name",
        F.concat(F.coalesce("frst_name", F.lit("")), F.lit(", "), F.coalesce("last_name", F.lit(""))).alias("contact_name"),
        F.rtrim(phone).alias("contact_phone"),
    )
    order = [F.col("role_name").desc(), F.col("contact_name").asc(), F.col("contact_phone").asc()]
    return top_one(named, ["orgnztn_id"], order).drop("role_name")


def exposures(requests: DataFrame, snapshots: DataFrame, kind: str, state: str = "CA") -> DataFrame:
    """Exposure at the newest snapshot strictly before the term start: one state, all states, percentage."""
    amount = F.coalesce("expsr_amnt", F.lit(0).cast("double"))
    sums: list[Column] = [
        F.sum(F.when(F.col("stt_abbrvtn") == state, amount).otherwise(0.0)).alias("ca_exposure"), F.sum(amount).alias("total_exposure"),
    ]
    asked = requests.withColumnRenamed("cnsmr_orgnztn_id", "orgnztn_id")
    shot = asof_latest(
        asked, snapshots.filter(F.col("expsr_type") == kind).select("orgnztn_id", "as_of_date", "stt_abbrvtn", "expsr_amnt"),
        "orgnztn_id", "term_effctv_date", "as_of_date", sums,
    )
    return share_columns(shot, ("ca_exposure", "total_exposure", "ca_exposure_pct")).withColumnRenamed("orgnztn_id", "cnsmr_orgnztn_id")


def account_team(roles: DataFrame, groups: DataFrame, group_name: str) -> DataFrame:
    """Smallest last name per listed role, only from the named role group."""
    members = roles.filter(F.col("role_name").isin(*TEAM_ROLES)).join(
        groups.filter(F.col("grp_name") == group_name).select("role_grp_id"), "role_grp_id", "left_semi"
    )
    return pivot_first(members, "orgnztn_id", "role_name", "last_name", TEAM_ROLES)


def declination_report(src: dict[str, DataFrame], first, last, exposure_kind: str, status: str | None = None, segment: str | None = None,
                       skip_org: int | None = None, group_name: str = "ACCOUNT TEAM") -> DataFrame:
    """``src`` holds: requests, orgs, people, options, approvals, infos, values, elements, ratings, layers, addresses,
    phones, contacts, credits, snapshots, roles, groups. The result has the columns of ``REPORT``.

    The requests are kept after each group of lookups, and the elements, which are few (these run jobs): the shuffles of a group, and the rows before it, are gone
    when the next one begins. The larger other frames but the values are cut to their options, accounts and requests before they are aggregated. Lookups of one key
    follow each other, so that the rows move once for them.
    """
    spark = src["requests"].sparkSession
    address = src["addresses"].filter(F.col("city").isNotNull())
    main = src["phones"].filter(F.col("phn_usg") == "MAIN").select(
        "orgnztn_id", F.rtrim(phone_of(*[F.col(c) for c in ("phn_area", "phn_exchng", "phn_nmbr", "phn_extnsn")])).alias("main_phone")
    )
    rated = src["credits"].filter(F.col("review_status") == "COMPLETE").select("cnsmr_rqst_id", "review_id", "credit_rating")
    by_org = F.col("cnsmr_orgnztn_id").alias("orgnztn_id")

    def asked(name: str, key: str) -> DataFrame:
        return src[name].join(rows.select(key).distinct(), key, "left_semi").select(*src[name].columns)

    with passing(spark):
        rows = kept(base_requests(src["requests"], src["orgs"], src["people"], first, last, status, segment, skip_org))
        rows = kept(chosen_options(rows, src["options"], src["approvals"]).join(lone_information(src["infos"]), "smmry_optn_id", "left"))
        rows = kept(exposures(rows, src["snapshots"], exposure_kind).select("*", by_org))
        # Values are combined where they are read, many to one row; cutting them to the chosen options first would move every one of them.
        rows = kept(rows.join(option_measures(src["values"], kept(src["elements"])), "accnt_infrmtn_id", "left"))
        rows = rows.join(current_carriers(asked("ratings", "cnsmr_rqst_id")), ["cnsmr_rqst_id", "smmry_optn_id"], "left")
        rows = kept(first_lookup(rows, rated, "cnsmr_rqst_id", [F.col("review_id").desc()]))
        rows = kept(rows.join(list_values(asked("layers", "wrksht_optn_id"), "wrksht_optn_id", "prdct_shrt_name", "products"), "wrksht_optn_id", "left"), stays=True)
    rows = first_lookup(rows, address, "orgnztn_id", [F.col(c).asc_nulls_last() for c in ("addrss_id", "address_1")])
    rows = first_lookup(rows, main, "orgnztn_id", [F.col("main_phone").asc()])
    rows = rows.join(account_contacts(asked("contacts", "orgnztn_id")), "orgnztn_id", "left")
    rows = rows.join(account_team(asked("roles", "orgnztn_id"), src["groups"], group_name), "orgnztn_id", "left")
    rows = rows.withColumns({"eff_date": F.date_format("term_effctv_date", "MM/dd/yyyy"), "status": F.col("stts_name")})
    return rows.select("cnsmr_rqst_id", *[
        F.rtrim(F.col(c)).alias(c) if t == "string" else F.col(c) for c, t in ((c, dict(rows.dtypes)[c]) for c, _ in REPORT)
    ])
