"""Conformed dimensions D1-D5 and the calendar spine."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimstar.functions import rules as R
from dimstar.functions.columns import mail_domain, parse_flag
from dimstar.operators import conform_union
from dimstar.params import Params
from dimstar.sources import Sources


def time_spine(spark: SparkSession, params: Params) -> DataFrame:
    """One row per day, ``spine_from`` .. ``spine_to`` inclusive: a distributed range of day offsets."""
    days = (params.spine_to - params.spine_from).days + 1
    return spark.range(days).select(F.date_add(F.lit(params.spine_from), F.col("id").cast("int")).alias("date_day"))


def dim_date(src: Sources) -> DataFrame:
    """Fiscal labels per calendar day."""
    cal = src.edh_finance_calendar
    fy, fq = F.col("fiscal_year_name"), F.col("fiscal_year_quarter_name")
    month_in_q = F.col("month_number_in_fiscal_quarter")
    return cal.select(
        F.col("date_key").alias("date_day"),
        fy, fq, month_in_q,
        F.concat(fy, F.lit("-"), fq).alias("fiscal_quarter"),
        F.concat(fy, F.lit("-"), fq, F.lit("-M"), month_in_q.cast("int").cast("string")).alias("fiscal_quarter_month"),
    )


def dim_unified_account(src: Sources) -> DataFrame:
    """EDH accounts plus ACS accounts whose CSN EDH does not have."""
    acc = src.edh_account
    edh = acc.where(F.col("account_csn").isNotNull()).select(
        "account_csn", "account_name",
        F.col("sales_geo").alias("account_geo"),
        F.col("country_name").alias("account_country"),
        F.col("sales_region_name").alias("account_region"),
        "named_account_group",
        R.account_segment(F.col("named_account_group")).alias("account_segment"),
        "account_type",
        F.col("corporate_account_name").alias("parent_account_name"),
        F.col("account_hierarchy_depth").cast("string").try_cast("decimal(18,0)").alias("account_hierarchy_depth"),
        F.col("account_hierarchy_level").cast("string").alias("account_hierarchy_level"),
        "account_category", "industry_segment",
        parse_flag(F.col("is_targeted_account")).alias("is_targeted_account"),
        F.col("sales_rep_number").cast("string").alias("account_sales_rep_number"),
        F.lit(R.DIM_EDH).alias("source_system"),
    )
    none = F.lit(None).cast("string")
    acs = src.acs_account.where(F.col("own_csn").isNotNull()).select(
        F.col("own_csn").alias("account_csn"),
        "account_name",
        F.col("geo_c").alias("account_geo"),
        F.col("account_country_c").alias("account_country"),
        none.alias("account_region"), none.alias("named_account_group"), none.alias("account_segment"),
        "account_type",
        none.alias("parent_account_name"),
        F.lit(None).cast("decimal(18,0)").alias("account_hierarchy_depth"),
        none.alias("account_hierarchy_level"), none.alias("account_category"), none.alias("industry_segment"),
        F.lit(None).cast("boolean").alias("is_targeted_account"),
        none.alias("account_sales_rep_number"),
        F.lit(R.DIM_ACS).alias("source_system"),
    )
    return conform_union(edh, acs, "account_csn", acc, "account_csn")


def dim_unified_contact(src: Sources) -> DataFrame:
    """D3: contacts with the mail domain; ACS only where EDH lacks the CSN."""
    edh_c = src.edh_contact
    edh = edh_c.where(F.col("contact_csn").isNotNull()).select(
        "contact_csn",
        F.col("first_name").alias("contact_first_name"),
        F.col("last_name").alias("contact_last_name"),
        F.col("email_address").alias("contact_email"),
        F.col("contact_phone_number").alias("contact_phone"),
        mail_domain(F.col("email_address")).alias("contact_email_domain"),
        F.lit(R.DIM_EDH).alias("source_system"),
    )
    acs = src.acs_contact.where(F.col("contact_csn").isNotNull()).select(
        "contact_csn",
        F.col("first_name").alias("contact_first_name"),
        F.col("last_name").alias("contact_last_name"),
        F.col("user_email").alias("contact_email"),
        F.col("phone").alias("contact_phone"),
        mail_domain(F.col("user_email")).alias("contact_email_domain"),
        F.lit(R.DIM_ACS).alias("source_system"),
    )
    return conform_union(edh, acs, "contact_csn", edh_c, "contact_csn")


def dim_unified_employee(src: Sources) -> DataFrame:
    """Active EDH workers plus ACS users unknown to EDH (active or not)."""
    emp = src.edh_employee
    edh = emp.where((F.col("is_active") == 1) & F.col("worker_id").isNotNull()).select(
        F.col("worker_id").alias("employee_id"),
        F.col("preferred_name").alias("employee_name"),
        "sales_role",
        F.col("manager_display_name").alias("manager_name"),
        "work_email",
        F.lit(R.DIM_EDH).alias("source_system"),
    )
    none = F.lit(None).cast("string")
    acs = src.acs_user.where(F.col("user_id").isNotNull()).select(
        F.col("user_id").alias("employee_id"),
        none.alias("employee_name"), none.alias("sales_role"),
        "manager_name",
        F.col("user_email").alias("work_email"),
        F.lit(R.DIM_ACS).alias("source_system"),
    )
    return conform_union(edh, acs, "employee_id", emp, "worker_id")


def dim_unified_opportunity(src: Sources, params: Params) -> DataFrame:
    """Unified EDH opportunities with CRM tags, plus ACS-only opportunities."""
    opp = src.edh_opportunity
    tags = src.crm_opportunity_tags.select(F.col("id").alias("tag_id"), "opportunity_tags__c")
    stage = F.col("opportunity_stage")
    edh = (
        opp.where((F.col("opportunity_type") == R.OPPORTUNITY_TYPE_UNIFIED) & F.col("opportunity_number").isNotNull())
        .join(tags, F.col("source_record_id") == F.col("tag_id"), "left")
        .select(
            "opportunity_number",
            F.lit(R.PIPELINE_EDH).alias("source_system"),
            F.col("source_record_id").alias("opportunity_id"),
            "opportunity_name",
            stage.alias("raw_stage"),
            R.stage_label(stage).alias("opportunity_stage"),
            R.stage_rank(stage).alias("opportunity_stage_rank"),
            R.stage_weight(stage).alias("opportunity_stage_weight"),
            "opportunity_type", "primary_sales_motion",
            F.col("opportunity_forecast_category").alias("forecast_category"),
            "sales_channel", "customer_project", "compelling_event", "access_to_funds",
            "formal_decision_process", "informal_decision_process", "unique_business_value",
            F.col("opportunity_tags__c").alias("opportunity_tags"),
            R.is_partner_led(F.col("opportunity_tags__c")).alias("is_partner_led"),
            F.col("source_created_ts").cast("date").alias("opportunity_created_date"),
            F.col("projected_close_date").cast("date").alias("opportunity_projected_close_date"),
            F.col("sales_rep_number").alias("opportunity_owner_id"),
        )
    )
    s = F.lit(params.sentinel)
    acs_stage = F.col("stage_name")
    acs = src.acs_opportunity.where(F.col("opportunity_number__c").isNotNull()).select(
        F.col("opportunity_number__c").alias("opportunity_number"),
        F.lit(R.PIPELINE_ACS).alias("source_system"),
        F.col("id").alias("opportunity_id"),
        F.col("name").alias("opportunity_name"),
        acs_stage.alias("raw_stage"),
        R.stage_label(acs_stage, acs=True).alias("opportunity_stage"),
        R.stage_rank(acs_stage, acs=True).alias("opportunity_stage_rank"),
        R.stage_weight(acs_stage, acs=True).alias("opportunity_stage_weight"),
        F.col("type").alias("opportunity_type"),
        s.alias("primary_sales_motion"), s.alias("forecast_category"),
        F.col("bmtchannel_c").alias("sales_channel"),
        s.alias("customer_project"), s.alias("compelling_event"), s.alias("access_to_funds"),
        s.alias("formal_decision_process"), s.alias("informal_decision_process"),
        s.alias("unique_business_value"), s.alias("opportunity_tags"), s.alias("is_partner_led"),
        F.col("created_date").cast("date").alias("opportunity_created_date"),
        F.col("close_date").cast("date").alias("opportunity_projected_close_date"),
        F.col("owner_id").alias("opportunity_owner_id"),
    )
    return conform_union(edh, acs, "opportunity_number", opp, "opportunity_number")
