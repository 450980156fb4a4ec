"""blended opportunity line items (EDH authoritative, ACS secondary).

Join order is chosen for the large line stream: the opportunity-grain rules
(window, account eligibility, anti join to EDH, country rule) and the latest
quote come before the fan-out, the lines are joined in one pass (a left join
in which the lines of hot opportunities are salted), and the line lookups
(offering, FX rate) see only the lines that survived it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimstar.functions import rules as R
from dimstar.operators import hot_keys, latest_per_key, not_in_authority, salted_left_join
from dimstar.params import Params
from dimstar.session import shared_folder
from dimstar.sources import Sources

ACV = "decimal(28,8)"
WEIGHTED_ACV = "decimal(32,10)"

COLUMNS = (
    "source_system", "opportunity_number", "line_item_number", "account_csn", "partner_csn",
    "opportunity_partner_account_csn", "opportunity_owner_id", "account_owner_id",
    "opportunity_projected_close_date", "quantity", "line_item_acv_usd", "line_item_weighted_acv_usd",
    "offer_type", "opportunity_line_status", "sales_motion_category", "action", "license_type", "term",
    "sales_motion_product_category", "offering_name", "solution_division", "focus_segment_group",
    "focus_segment", "quote_number", "quote_partner_account_csn", "quote_status", "quoted_on_date",
)


def eligible_accounts(src: Sources) -> DataFrame:
    """P5: EDH accounts a pipeline row may belong to."""
    a = src.edh_account
    return a.where(R.eligible_account(F.col("account_type"), F.col("is_visible"), F.col("account_category")))


def in_close_window(close: str, params: Params):
    d = F.col(close).cast("date")
    return d.between(F.lit(params.close_from), F.lit(params.close_to))


def opportunities_in_window(src: Sources, params: Params) -> DataFrame:
    """Unified EDH opportunities closing inside the window."""
    return src.edh_opportunity.where(
        (F.col("opportunity_type") == R.OPPORTUNITY_TYPE_UNIFIED) & in_close_window("projected_close_date", params)
    )


def latest_quote(src: Sources) -> DataFrame:
    """One quote per opportunity: dated before undated, newest date, highest number."""
    q = src.edh_quote
    return latest_per_key(
        q, ["opportunity_number"],
        [F.col("quote_date").isNull().asc(), F.col("quote_date").desc_nulls_last(),
         F.col("quote_number").desc_nulls_last()],
    )


def latest_fx_rate(src: Sources) -> DataFrame:
    """Newest rate per currency (the rate itself breaks ties, for a stable result)."""
    return latest_per_key(
        src.edh_exchange_rate, ["from_currency_code"],
        [F.col("effective_start_date").desc_nulls_last(), F.col("exchange_rate").desc_nulls_last()],
    )


def _with_lines(opportunities: DataFrame, lines: DataFrame, key: str, line_key: str, lookup, materialize: bool) -> DataFrame:
    """Opportunities left-joined to their lines; ``materialize`` writes the opportunity side as a table first."""
    if materialize:
        path = shared_folder(opportunities.sparkSession, "lineage_cut")
        opportunities.write.parquet(path)
        opportunities = opportunities.sparkSession.read.parquet(path).select(*opportunities.columns)
    return salted_left_join(opportunities, lines, key, line_key, hot_keys(lines, line_key), lookup)


def edh_opportunity_lines(src: Sources, params: Params, materialize: bool = False) -> DataFrame:
    """EDH branch: eligible in-window opportunities, fanned out to their lines."""
    acct = eligible_accounts(src).select(
        F.col("account_csn").alias("acct_csn"), F.col("sales_rep_number").alias("account_owner_id"))
    quote = latest_quote(src).select(
        F.col("opportunity_number").alias("q_opportunity_number"), "quote_number",
        F.col("sales_partner_account_csn").alias("quote_partner_account_csn"), "quote_status",
        F.col("quote_date").alias("quoted_on_date"))
    opp_side = (
        opportunities_in_window(src, params)
        .select("opportunity_number", "end_customer_account_csn", "sales_partner_account_csn",
                "sales_rep_number", "projected_close_date", "opportunity_stage")
        .join(acct, F.col("end_customer_account_csn") == F.col("acct_csn"), "inner")
        .join(quote, F.col("opportunity_number") == F.col("q_opportunity_number"), "left")
    )
    offering = src.edh_offering.select(
        F.col("offering_id").alias("o_offering_id"), "offering_name", "sales_motion_product_category",
        "solution_division", "focus_segment_group", "focus_segment")
    lines = src.edh_opportunity_line_item.select(
        F.col("opportunity_number").alias("line_opportunity_number"), "line_item_number", "offering_id",
        "quantity", F.col("line_item_acv_usd").alias("line_acv"),
        F.col("sales_revenue_group_detail").alias("offer_type"), "opportunity_line_status",
        "sales_motion_category", "action", F.col("access_model").alias("license_type"), "term")
    rows = _with_lines(opp_side, lines, "opportunity_number", "line_opportunity_number",
                       lambda df: df.join(offering, F.col("offering_id") == F.col("o_offering_id"), "left"), materialize)
    acv = F.col("line_acv").cast(ACV)
    return rows.select(
        F.lit(R.PIPELINE_EDH).alias("source_system"),
        "opportunity_number", "line_item_number",
        F.col("end_customer_account_csn").alias("account_csn"),
        F.col("sales_partner_account_csn").alias("partner_csn"),
        F.col("sales_partner_account_csn").alias("opportunity_partner_account_csn"),
        F.col("sales_rep_number").alias("opportunity_owner_id"),
        "account_owner_id",
        F.col("projected_close_date").cast("date").alias("opportunity_projected_close_date"),
        F.col("quantity").cast("double").alias("quantity"),
        acv.alias("line_item_acv_usd"),
        (acv * R.stage_weight(F.col("opportunity_stage"))).cast(WEIGHTED_ACV).alias("line_item_weighted_acv_usd"),
        "offer_type", "opportunity_line_status", "sales_motion_category", "action", "license_type", "term",
        "sales_motion_product_category", "offering_name", "solution_division", "focus_segment_group",
        "focus_segment", "quote_number", "quote_partner_account_csn", "quote_status", "quoted_on_date",
    )


def acs_opportunities_screened(src: Sources, params: Params) -> DataFrame:
    """ACS opportunities that pass every opportunity-grain rule (before lines).

    J6/J7 account joins, J9 anti-join to all EDH opportunities, P13 open-deal
    country rule, P14 lost reason, P5 eligibility and P6 window.
    """
    cust = eligible_accounts(src).select(
        F.col("account_csn").alias("cust_csn"), F.col("sales_rep_number").alias("account_owner_id"))
    acs_acct = src.acs_account.select(
        F.col("account_id").alias("a_account_id"), "child_csn",
        F.col("shipping_country").alias("account_shipping_country"))
    geo = src.country_region_map.select(F.col("country").alias("geo_country"))
    opp = src.acs_opportunity.where(
        in_close_window("close_date", params)
        & (F.coalesce(F.col("reason_lost_c"), F.lit("n/a")) != R.LOST_REASON_EXCLUDED)
    ).select("id", "opportunity_number__c", "account_id", "owner_id", "stage_name", "close_date",
             "shipping_country", "is_closed")
    opp = not_in_authority(opp, "opportunity_number__c", src.edh_opportunity, "opportunity_number")
    screened = (
        opp.join(acs_acct, F.col("account_id") == F.col("a_account_id"), "inner")
        .join(cust, F.trim(F.col("child_csn")) == F.trim(F.col("cust_csn")), "inner")
        .join(geo, F.lower(F.coalesce(F.col("shipping_country"), F.col("account_shipping_country")))
              == F.lower(F.col("geo_country")), "left")
    )
    return screened.where(~(F.col("geo_country").isNotNull() & (F.col("is_closed") == 0)))


def acs_opportunity_lines(src: Sources, params: Params, materialize: bool = False) -> DataFrame:
    """ACS branch: screened opportunities with their non-deleted lines in USD."""
    opp_side = acs_opportunities_screened(src, params)
    fx = latest_fx_rate(src).select(F.col("from_currency_code").alias("fx_currency"), "exchange_rate")
    lines = (
        src.acs_opportunity_line_item.where(F.col("is_deleted") == 0)
        .select(F.col("id").alias("line_id"), F.col("opportunity_id").alias("line_opportunity_id"),
                F.col("quantity"), "est_annualized_amount_c", "currency_iso_code", "subscription_name")
    )
    rows = _with_lines(opp_side, lines, "id", "line_opportunity_id",
                       lambda df: df.join(fx, F.col("currency_iso_code") == F.col("fx_currency"), "left"), materialize)
    acv = (F.col("est_annualized_amount_c") * F.col("exchange_rate")).cast(ACV)
    s = F.lit(params.sentinel)
    return rows.select(
        F.lit(R.PIPELINE_ACS).alias("source_system"),
        F.col("opportunity_number__c").alias("opportunity_number"),
        F.col("line_id").alias("line_item_number"),
        F.col("cust_csn").alias("account_csn"),
        F.col("child_csn").alias("partner_csn"),
        F.col("child_csn").alias("opportunity_partner_account_csn"),
        F.col("owner_id").alias("opportunity_owner_id"),
        "account_owner_id",
        F.col("close_date").cast("date").alias("opportunity_projected_close_date"),
        F.col("quantity").cast("double").alias("quantity"),
        acv.alias("line_item_acv_usd"),
        (acv * R.stage_weight(F.col("stage_name"), acs=True)).cast(WEIGHTED_ACV).alias("line_item_weighted_acv_usd"),
        s.alias("offer_type"), s.alias("opportunity_line_status"), s.alias("sales_motion_category"),
        s.alias("action"), s.alias("license_type"), s.alias("term"), s.alias("sales_motion_product_category"),
        F.col("subscription_name").alias("offering_name"),
        s.alias("solution_division"),
        F.lit(R.ACS_FOCUS_SEGMENT_GROUP).alias("focus_segment_group"),
        F.lit(R.ACS_FOCUS_SEGMENT).alias("focus_segment"),
        s.alias("quote_number"), s.alias("quote_partner_account_csn"), s.alias("quote_status"),
        F.lit(None).cast("date").alias("quoted_on_date"),
    )


def fct_blended_opportunities(src: Sources, params: Params, materialize: bool = False) -> DataFrame:
    """F1 = EDH lines UNION ALL ACS lines (27 columns).

    ``materialize`` writes the opportunity-grain side of each branch once as
    a table in the shared folder (a job runs when this is called), as a
    lineage cut.  A small job over a sample of each line table's key column
    looks for hot opportunities.
    """
    return edh_opportunity_lines(src, params, materialize).unionByName(
        acs_opportunity_lines(src, params, materialize)).select(*COLUMNS)
