"""The 18 CRM source tables, derived by Spark from the test tables.

The reference ships no data, so the sources are projections of the
TPC-H-style tables in ``/root/testdata`` (FIXTURES.md part C): integer
arithmetic and list picks only, so an independent SQL engine can repeat
them exactly.  Every source is a lazy DataFrame over the given parquet
files, so its size grows with the scale factor.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dimstar.functions.columns import key_text, pick
from dimstar.functions import rules as R
from dimstar.sources.catalog import Sources

# Fixed fixture lists (test-data design, FIXTURES.md part C/D).
EDH_STAGE_PICKS = (
    R.STAGE_LOST + R.STAGE_WON + R.STAGE_1 + R.STAGE_2 + R.STAGE_3 + R.STAGE_4 + R.STAGE_5
    + ("Stage4", None)
)
ACS_STAGE_PICKS = (
    R.STAGE_LOST + R.STAGE_WON + R.STAGE_1 + R.STAGE_2 + R.STAGE_3 + R.STAGE_4 + R.STAGE_5
    + R.STAGE_WON_ACS_ONLY + ("Stage4", "Other", None)
)
ACCOUNT_TYPE_PICKS = R.ELIGIBLE_ACCOUNT_TYPES + ("Reseller", "Distributor", "Education")
NAMED_GROUP_PICKS = ("Territory", "Individual", "Unknown", "Named Key", "Named Growth", None)
CATEGORY_PICKS = (None, "Internal", "Partner", "Commercial")
TARGETED_PICKS = (" y ", "YES", "true", "1", "Y", "N", "no", "FALSE", "0", "maybe", None)
DEPTH_PICKS = ("1", "2.6", "x", None)
TAG_PICKS = ("Partner Led;x", "LED BY PARTNER", "other", None, "")
MAIL_PICKS = (
    "User@ACME.com", "a@b@x.example", "noat", None, "",
    "p@mail.example.com", "Z@sub.Acme.example",
)
CURRENCY_PICKS = ("USD", "EUR", "GBP", "XXX")
EDH_SUBJECT_PICKS = (
    "Sub-Call follow up", "InMail outreach", "Quarterly review", None,
    "intro SUB-CALL", "LinkedIn inmail", "Misc",
)
EDH_DESCRIPTION_PICKS = ("External Email logged", "Email sent successfully", "notes", None, "Partner sync")
EDH_TASK_TYPE_PICKS = ("Inbound", "Outbound", None)
EDH_TASK_SUBTYPE_PICKS = ("Task", "Call", "Email", "ListEmail", None)
EDH_SALES_TYPE_PICKS = (
    " Call ", "Scheduled Call", "Email", "Meeting", "Chat", "Social", "Update",
    "", None, "Webinar", " Meeting",
)
EDH_SALES_SUBTYPE_PICKS = (
    "Email - Sent", "Email - Response Received", "Email - Engaged with Partner",
    "Engaged with partner", "Email - Bounced", "Connected", "Discovery call",
    "Meeting scheduled", "Meeting completed", "Demo Held",
    " Connected, business conversation ", "", None,
)
ACS_TASK_TYPE_PICKS = (
    "Call", "Connected Call", "Email", "Meeting",
    "Email - Sent", "Email - Response Received", "Email - Engaged with Partner", "Email - Bounced",
    "Meeting scheduled", "Set Appointment", "Discovery/Demo Held", "Discovery/Demo Scheduled",
    "Team meeting notes", "Meeting completed", "Demo Held",
    "LinkedIn: InMail", "Sent Message",
    "Connected", "Left Voicemail", "Discovery Call", "Discovery Held", "Demo", "Engaged with partner",
    "Action Item", "Other",
    " Chat ", "Follow up", "", None,
)
ACS_TASK_SUBTYPE_PICKS = (
    "Task", "Task", "Call", "Email", "Meeting", "ListEmail", "Cadence", "Chat ", " Update", "", None,
)
ACS_CALL_OUTCOME_PICKS = (
    "Qualified", "No Budget", "Left Voicemail", "Active License", None,
    "Gate Keeper - Follow Up", "Busy",
)
ACS_CALL_TYPE_PICKS = ("Outbound", "Inbound", None, "Outbound", "Internal", "Outbound", None)
ACS_DURATION_PICKS = (0.0, 0.4, 59.9, None)
ACS_DELETED_PICKS = (0, 1, None, 0)


def _div(c: Column, n: int) -> Column:
    """Integer division of a non-negative integer column."""
    return ((c - c % F.lit(n)) / F.lit(n)).cast("long")


def _plus_seconds(ts: Column, seconds: Column) -> Column:
    return ts + F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fixture_sources(spark: SparkSession, sf_dir: str) -> Sources:
    orders = _read(spark, sf_dir, "orders")
    lineitem = _read(spark, sf_dir, "lineitem")
    customer = _read(spark, sf_dir, "customer")
    nation = _read(spark, sf_dir, "nation")
    region = _read(spark, sf_dir, "region")
    supplier = _read(spark, sf_dir, "supplier")
    part = _read(spark, sf_dir, "part")
    events = _read(spark, sf_dir, "events")

    k = F.col("o_orderkey")
    edh_opportunity = orders.filter(k % 4 != 3).select(
        key_text("A-", k).alias("opportunity_number"),
        key_text("R-", k).alias("source_record_id"),
        key_text("Deal ", k).alias("opportunity_name"),
        pick(k, EDH_STAGE_PICKS).alias("opportunity_stage"),
        F.when(k % 11 == 0, F.lit("Legacy")).otherwise(F.lit(R.OPPORTUNITY_TYPE_UNIFIED)).alias("opportunity_type"),
        key_text("C-", F.col("o_custkey")).alias("end_customer_account_csn"),
        key_text("C-", F.col("o_custkey") + 1).alias("sales_partner_account_csn"),
        key_text("W-", k % 10).alias("sales_rep_number"),
        F.col("o_orderdate").alias("projected_close_date"),
        (F.col("o_orderdate") - F.expr("INTERVAL 90 DAYS")).alias("source_created_ts"),
        F.col("o_orderpriority").alias("primary_sales_motion"),
        F.col("o_orderstatus").alias("opportunity_forecast_category"),
        pick(k, ("Direct", "Partner", "Online")).alias("sales_channel"),
        pick(_div(k, 3), ("Yes", "No", None)).alias("customer_project"),
        pick(_div(k, 5), ("Renewal date", "Budget cycle", None)).alias("compelling_event"),
        pick(_div(k, 7), ("Yes", "No")).alias("access_to_funds"),
        pick(_div(k, 2), ("Known", "Unknown")).alias("formal_decision_process"),
        pick(_div(k, 11), ("Known", "Unknown", None)).alias("informal_decision_process"),
        pick(_div(k, 13), ("Cost", "Speed", "Quality")).alias("unique_business_value"),
    )

    lk, ln, lp, ls = F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey"), F.col("l_suppkey")
    edh_lines = lineitem.filter(lk % 4 != 3)
    edh_opportunity_line_item = edh_lines.select(
        key_text("A-", lk).alias("opportunity_number"),
        key_text("L-", lk, ln, lp, ls).alias("line_item_number"),
        key_text("P-", lp).alias("offering_id"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("line_item_acv_usd"),
        F.col("l_returnflag").alias("sales_revenue_group_detail"),
        F.col("l_linestatus").alias("opportunity_line_status"),
        pick(ln, ("Acquire", "Expand", "Renew")).alias("sales_motion_category"),
        pick(ls, ("Add", "Renew", "Upgrade", "Remove")).alias("action"),
        pick(lp, ("Subscription", "Perpetual", "Cloud")).alias("access_model"),
        pick(_div(ln, 2), ("Annual", "Monthly", "3-Year")).alias("term"),
    )

    pk = F.col("p_partkey")
    edh_offering = part.filter(pk % 19 != 0).select(
        key_text("P-", pk).alias("offering_id"),
        F.col("p_name").alias("offering_name"),
        pick(pk, ("Core", "Platform", "Add-on")).alias("sales_motion_product_category"),
        F.col("p_brand").alias("solution_division"),
        pick(F.col("p_size"), ("Design", "Make", "Media")).alias("focus_segment_group"),
        F.col("p_type").alias("focus_segment"),
    )

    ck = F.col("c_custkey")
    cust_geo = customer.join(nation, customer.c_nationkey == nation.n_nationkey, "inner")
    edh_account = cust_geo.join(region, F.col("n_regionkey") == F.col("r_regionkey"), "inner") \
        .filter(ck % 5 != 4).select(
            key_text("C-", ck).alias("account_csn"),
            F.col("c_name").alias("account_name"),
            F.col("r_name").alias("sales_geo"),
            F.col("n_name").alias("country_name"),
            F.concat(F.col("r_name"), F.lit("/"), F.col("c_mktsegment")).alias("sales_region_name"),
            pick(ck, NAMED_GROUP_PICKS).alias("named_account_group"),
            pick(ck, ACCOUNT_TYPE_PICKS).alias("account_type"),
            key_text("Group ", _div(ck, 10)).alias("corporate_account_name"),
            pick(ck, DEPTH_PICKS).alias("account_hierarchy_depth"),
            (ck % 3).alias("account_hierarchy_level"),
            pick(ck % 9, CATEGORY_PICKS).alias("account_category"),
            F.col("c_mktsegment").alias("industry_segment"),
            pick(ck, TARGETED_PICKS).alias("is_targeted_account"),
            key_text("W-", ck % 10).alias("sales_rep_number"),
            F.when(ck % 13 == 0, F.lit(0)).otherwise(F.lit(1)).alias("is_visible"),
        )

    edh_quote = edh_lines.filter(F.col("l_returnflag") == "R").select(
        key_text("A-", lk).alias("opportunity_number"),
        key_text("Q-", lp, ls, ln).alias("quote_number"),
        key_text("C-", ls).alias("sales_partner_account_csn"),
        pick(ln, ("Draft", "Approved", "Ordered")).alias("quote_status"),
        F.when(ln % 5 == 0, F.lit(None).cast("date")).otherwise(F.col("l_shipdate").cast("date")).alias("quote_date"),
    )

    # One rate row per currency and per month that occurs in the orders.
    month = F.trunc(F.col("o_orderdate").cast("date"), "MM")
    month_index = F.year("m") * 12 + F.month("m")
    rate_rows = F.array(
        F.struct(F.lit("USD").alias("c"), F.lit(1.0).alias("r")),
        F.struct(F.lit("EUR").alias("c"), ((F.lit(105) + month_index % 7) / 100).alias("r")),
        F.struct(F.lit("GBP").alias("c"), ((F.lit(120) + month_index % 5) / 100).alias("r")),
    )
    edh_exchange_rate = (
        orders.select(month.alias("m")).distinct()
        .select(F.col("m").alias("effective_start_date"), F.inline(rate_rows.cast(
            "array<struct<from_currency_code:string,exchange_rate:decimal(18,6)>>")))
        .select("from_currency_code", "effective_start_date", "exchange_rate")
    )

    crm_opportunity_tags = orders.filter((k % 4 != 3) & (k % 3 != 0)).select(
        key_text("R-", k).alias("id"),
        pick(k, TAG_PICKS).alias("opportunity_tags__c"),
    )

    acs_orders = orders.filter((k % 4 == 2) | (k % 4 == 3)).withColumn("id", key_text("S-", k)).join(
        cust_geo.select("c_custkey", "n_name"), F.col("o_custkey") == F.col("c_custkey"), "inner")
    acs_opportunity = acs_orders.select(
        "id",
        F.when(k % 23 == 0, F.lit(None).cast("string")).otherwise(key_text("A-", k)).alias("opportunity_number__c"),
        key_text("SA-", F.col("o_custkey")).alias("account_id"),
        key_text("U-", k % 10).alias("owner_id"),
        key_text("Site ", k).alias("name"),
        pick(k, ACS_STAGE_PICKS).alias("stage_name"),
        pick(k, ("New Business", "Renewal", "Upsell")).alias("type"),
        pick(_div(k, 4), ("Direct", "Partner")).alias("bmtchannel_c"),
        (F.col("o_orderdate") - F.expr("INTERVAL 30 DAYS")).alias("created_date"),
        F.col("o_orderdate").alias("close_date"),
        F.when(k % 3 == 0, F.lit(None).cast("string")).otherwise(F.upper("n_name")).alias("shipping_country"),
        F.when(F.col("o_orderstatus") == "F", F.lit(1)).when(F.col("o_orderstatus") == "O", F.lit(0))
        .alias("is_closed"),
        F.when(k % 29 == 0, F.lit(R.LOST_REASON_EXCLUDED)).when(k % 5 == 0, F.lit(None).cast("string"))
        .otherwise(F.lit("Price")).alias("reason_lost_c"),
    )

    acs_opportunity_line_item = lineitem.filter((lk % 4 == 2) | (lk % 4 == 3)).select(
        key_text("SL-", lk, ln, lp, ls).alias("id"),
        key_text("S-", lk).alias("opportunity_id"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("est_annualized_amount_c"),
        pick(ls, CURRENCY_PICKS).alias("currency_iso_code"),
        F.col("l_returnflag").alias("subscription_name"),
        F.when(ln % 7 == 0, F.lit(1)).otherwise(F.lit(0)).alias("is_deleted"),
    )

    acs_account = cust_geo.select(
        key_text("SA-", ck).alias("account_id"),
        F.when(ck % 31 == 0, F.lit(None).cast("string")).otherwise(key_text("C-", ck)).alias("own_csn"),
        F.concat(F.lit(" C-"), ck.cast("string"), F.lit(" ")).alias("child_csn"),
        F.col("c_name").alias("account_name"),
        key_text("GEO-", F.col("n_regionkey")).alias("geo_c"),
        F.upper("n_name").alias("account_country_c"),
        pick(_div(ck, 2), ("Customer", "Distributor", "Prospect", "Reseller")).alias("account_type"),
        F.upper("n_name").alias("shipping_country"),
    )

    nk = F.col("n_nationkey")
    country_region_map = nation.filter(nk % 2 == 0).select(F.col("n_name").alias("country"))

    sk = F.col("s_suppkey")
    edh_employee = supplier.select(
        key_text("W-", sk).alias("worker_id"),
        F.col("s_name").alias("preferred_name"),
        pick(sk, ("AE", "SDR", "CSM")).alias("sales_role"),
        key_text("Manager ", sk % 5).alias("manager_display_name"),
        F.concat(F.lit("w"), sk.cast("string"), F.lit("@corp.example")).alias("work_email"),
        F.when(sk % 10 == 2, F.lit(0)).otherwise(F.lit(1)).alias("is_active"),
    )
    acs_user = supplier.select(
        F.when(sk % 10 < 3, key_text("W-", sk)).otherwise(key_text("U-", sk)).alias("user_id"),
        key_text("Lead ", sk % 4).alias("manager_name"),
        F.concat(F.lit("u"), sk.cast("string"), F.lit("@crm.example")).alias("user_email"),
    )

    edh_contact = customer.filter(ck % 3 != 2).select(
        key_text("K-", ck).alias("contact_csn"),
        key_text("First", ck).alias("first_name"),
        F.col("c_name").alias("last_name"),
        pick(ck, MAIL_PICKS).alias("email_address"),
        key_text("P-", ck).alias("contact_phone_number"),
    )
    acs_contact = customer.select(
        key_text("SC-", ck).alias("contact_id"),
        F.when(ck % 4 == 0, F.lit(None).cast("string")).otherwise(key_text("K-", ck)).alias("contact_csn"),
        key_text("Given", ck).alias("first_name"),
        F.col("c_name").alias("last_name"),
        pick(ck + 3, MAIL_PICKS).alias("user_email"),
        key_text("SP-", ck).alias("phone"),
    )

    i = F.col("event_id")
    # Tasks refer to orders over their whole range of keys.
    order_keys = orders.agg(F.max("o_orderkey") + 1).scalar()
    status = F.when(F.col("event_type") == "error", F.lit("Open")).otherwise(F.lit("Completed"))
    finished = _plus_seconds(F.col("ts"), F.floor("value"))
    edh_opportunity_task = events.filter(i % 3 != 0).select(
        key_text("T-", i).alias("task_id"),
        key_text("A-", i * 7 % order_keys).alias("opportunity_number"),
        key_text("W-", F.col("user_id") % 10).alias("assigned_to_employee_number"),
        key_text("K-", F.col("user_id")).alias("end_customer_contact_csn"),
        pick(i, EDH_SUBJECT_PICKS).alias("subject_line"),
        pick(_div(i, 7), EDH_DESCRIPTION_PICKS).alias("task_description"),
        pick(_div(i, 2), EDH_TASK_TYPE_PICKS).alias("task_type"),
        pick(i, EDH_TASK_SUBTYPE_PICKS).alias("task_subtype"),
        status.alias("task_status"),
        pick(i, EDH_SALES_TYPE_PICKS).alias("sales_activity_type"),
        pick(i, EDH_SALES_SUBTYPE_PICKS).alias("sales_activity_subtype"),
        F.col("ts").alias("source_created_ts"),
        F.col("ts").alias("task_activity_date"),
        F.when(i % 4 == 0, F.lit(None).cast("timestamp_ntz")).otherwise(finished).alias("task_completed_ts"),
    )

    j = _div(i, 3)
    acs_task = events.filter(i % 3 == 0).select(
        key_text("ST-", i).alias("task_id"),
        key_text("S-", i * 7 % order_keys).alias("what_id"),
        key_text("U-", F.col("user_id") % 10).alias("owner_id"),
        key_text("SC-", F.col("user_id")).alias("sfdc_contact_id"),
        pick(j, ("Intro", "Follow up", None)).alias("task_subject"),
        pick(j, ACS_TASK_TYPE_PICKS).alias("task_type"),
        pick(j, ACS_TASK_SUBTYPE_PICKS).alias("task_subtype"),
        status.alias("task_status"),
        pick(_div(j, 2), ("Prospecting", "Follow-up", None)).alias("task_type_c"),
        pick(_div(j, 3), ACS_CALL_OUTCOME_PICKS).alias("call_outcome"),
        pick(j, ACS_CALL_TYPE_PICKS).alias("call_type"),
        pick(_div(j, 4), ACS_DURATION_PICKS).cast("double").alias("outreach_call_duration_c"),
        F.col("ts").alias("date_created"),
        F.col("ts").alias("date_activity"),
        F.when(_div(j, 4) % 3 == 0, F.lit(None).cast("timestamp_ntz")).otherwise(finished)
        .alias("completed_date_time"),
        pick(_div(j, 16), ACS_DELETED_PICKS).cast("int").alias("is_deleted"),
    )

    # Fiscal calendar over the years the data touches; fiscal year starts 1 February.
    bounds = (
        orders.select(F.col("o_orderdate").cast("date").alias("d"))
        .unionByName(events.select(F.col("ts").cast("date").alias("d")))
        .agg(F.min("d").alias("lo"), F.max("d").alias("hi"))
    )
    # Years first, spread over tasks, then the days of each year.
    years = bounds.select(F.explode(F.sequence(F.year("lo") - 1, F.year("hi"))).alias("y")).repartition("y")
    days = years.select(F.explode(F.sequence(
        F.make_date(F.col("y"), F.lit(1), F.lit(1)), F.make_date(F.col("y"), F.lit(12), F.lit(31)),
    )).alias("date_key"))
    fm = (F.month("date_key") + 10) % 12
    edh_finance_calendar = days.select(
        "date_key",
        F.concat(F.lit("FY"), (F.year("date_key") + F.when(F.month("date_key") >= 2, 1).otherwise(0))
                 .cast("string")).alias("fiscal_year_name"),
        F.concat(F.lit("Q"), ((fm - fm % 3) / 3 + 1).cast("int").cast("string")).alias("fiscal_year_quarter_name"),
        (fm % 3 + 1).cast("double").alias("month_number_in_fiscal_quarter"),
    )

    return Sources({
        "edh_opportunity": edh_opportunity,
        "edh_opportunity_line_item": edh_opportunity_line_item,
        "edh_offering": edh_offering,
        "edh_account": edh_account,
        "edh_quote": edh_quote,
        "edh_exchange_rate": edh_exchange_rate,
        "edh_opportunity_task": edh_opportunity_task,
        "edh_employee": edh_employee,
        "edh_finance_calendar": edh_finance_calendar,
        "edh_contact": edh_contact,
        "crm_opportunity_tags": crm_opportunity_tags,
        "acs_opportunity": acs_opportunity,
        "acs_opportunity_line_item": acs_opportunity_line_item,
        "acs_account": acs_account,
        "acs_user": acs_user,
        "acs_task": acs_task,
        "acs_contact": acs_contact,
        "country_region_map": country_region_map,
    })
