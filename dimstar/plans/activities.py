"""blended sales activities (EDH tasks plus Construction tasks).

Tasks are the large, skew-prone stream (many tasks can hang off one
opportunity).  Lookups keyed by the opportunity and by the contact are
joined at their own grain first, so each task is shuffled once per key
(opportunity, contact) instead of once per lookup table.  Rules on a task's
own columns run before these joins, so its long texts are never shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimstar.functions import rules as R
from dimstar.operators import not_in_authority
from dimstar.params import Params
from dimstar.sources import Sources

COLUMNS = (
    "activity_id", "source_system", "account_csn", "ownerid", "account_contact_csn", "opportunity_number",
    "whatid", "activity_created_date", "activity_subject", "task_type", "task_subtype", "task_status",
    "activity_created_timestamp", "activity_date", "activity_completed_timestamp", "cadence_activity_type",
    "cadence_activity_sub_type", "new_activity_type", "activity_type", "activity_group", "call_outcome",
    "call_type_raw", "calldisposition", "calldurationinseconds", "call_attempt_outbound",
    "call_connected_outbound", "meeting_scheduled", "meeting_completed", "email_attempt_outbound",
    "email_received",
)
FLAGS = COLUMNS[-6:]


def _recent(created: str, params: Params) -> Column:
    """P8 look-back from ``as_of`` and P9 reporting floor, on the created timestamp."""
    ts = F.col(created)
    return (ts >= F.lit(params.lookback_start).cast("timestamp_ntz")) & (ts.cast("date") >= F.lit(params.report_from))


def edh_activities(src: Sources, params: Params) -> DataFrame:
    """EDH branch (before the shared flag columns)."""
    tasks = src.edh_opportunity_task.where(
        (F.col("task_status") == "Completed")
        & _recent("source_created_ts", params)
        & (F.coalesce(F.col("sales_activity_subtype"), F.lit("Blank")) != R.BOUNCED)
    )
    sat, tst, sas = F.col("sales_activity_type"), F.col("task_subtype"), F.col("sales_activity_subtype")
    tasks = tasks.withColumns({
        "new_activity_type": R.edh_activity_type(sat, tst, sas, F.col("subject_line"), F.col("task_description")),
        "activity_type": R.edh_direction(sat, tst, sas, F.col("task_type")),
    }).drop("task_description")
    opp_side = src.edh_opportunity.select(
        F.col("opportunity_number").alias("o_number"),
        F.col("end_customer_account_csn").alias("o_account_csn"),
        F.col("source_record_id").alias("o_record_id"),
    ).join(
        src.edh_account.select(F.col("account_csn").alias("acc_csn"), F.col("account_type").alias("acc_type")),
        F.col("o_account_csn") == F.col("acc_csn"), "left",
    )
    contacts = src.edh_contact.select(F.col("contact_csn").alias("con_csn"), F.col("email_address").alias("con_email"))
    rows = (
        tasks.join(opp_side, F.col("opportunity_number") == F.col("o_number"), "inner")
        .join(contacts, F.col("end_customer_contact_csn") == F.col("con_csn"), "left")
    )
    return rows.select(
        F.col("task_id").alias("activity_id"),
        F.col("o_account_csn").alias("account_csn"),
        F.col("o_number").alias("opportunity_number"),
        F.col("o_record_id").alias("whatid"),
        F.col("assigned_to_employee_number").alias("ownerid"),
        F.col("end_customer_contact_csn").alias("account_contact_csn"),
        F.col("subject_line").alias("activity_subject"),
        "task_type", "task_subtype", "task_status",
        F.col("source_created_ts").cast("date").alias("activity_created_date"),
        F.col("source_created_ts").alias("activity_created_timestamp"),
        F.col("task_activity_date").cast("date").alias("activity_date"),
        F.col("task_completed_ts").alias("activity_completed_timestamp"),
        F.trim(sas).alias("cadence_activity_sub_type"),
        F.trim(sat).alias("cadence_activity_type"),
        F.lit(None).cast("string").alias("call_outcome"),
        F.lit(None).cast("string").alias("call_type_raw"),
        F.lit(None).cast("double").alias("outreach_call_duration_seconds"),
        "new_activity_type", "activity_type",
        R.activity_group(F.trim(sas), F.col("acc_type"), F.col("con_email"), params.tenant_pattern)
        .alias("activity_group"),
        F.lit(R.ACTIVITY_EDH).alias("source_system"),
    )


def construction_activities(src: Sources, params: Params) -> DataFrame:
    """Construction branch: ACS tasks on opportunities EDH does not carry."""
    tasks = src.acs_task.where(
        (F.col("task_status") == "Completed")
        & (F.coalesce(F.col("is_deleted"), F.lit(0)) == 0)
        & _recent("date_created", params)
        & (F.col("task_type") != R.BOUNCED)
    )
    tt, ts = F.col("task_type"), F.col("task_subtype")
    tasks = tasks.withColumns({
        "new_activity_type": R.construction_activity_type(tt, ts),
        "activity_type": R.construction_direction(tt, ts, F.col("call_type")),
    })
    opp_side = (
        src.acs_opportunity.select(
            F.col("id").alias("opp_id"), F.col("opportunity_number__c").alias("opp_number"),
            F.col("account_id").alias("opp_account_id"))
        .join(src.acs_account.where(F.col("own_csn").isNotNull()).select(
            F.col("account_id").alias("ca_id"), F.col("own_csn").alias("ca_csn"), F.col("account_type").alias("ca_type")),
            F.col("opp_account_id") == F.col("ca_id"), "inner")
        .join(src.edh_account.select(F.col("account_csn").alias("acc_csn"), F.col("account_type").alias("acc_type")),
              F.col("ca_csn") == F.col("acc_csn"), "left")
    )
    opp_side = not_in_authority(opp_side, "opp_number", src.edh_opportunity, "opportunity_number")
    contact_side = src.acs_contact.select(
        F.col("contact_id").alias("cc_id"), F.col("contact_csn").alias("cc_csn"), F.col("user_email").alias("cc_email"),
    ).join(
        src.edh_contact.select(F.col("contact_csn").alias("ec_csn"), F.col("email_address").alias("ec_email")),
        F.col("cc_csn") == F.col("ec_csn"), "left",
    )
    rows = (
        tasks.join(opp_side, F.col("what_id") == F.col("opp_id"), "inner")
        .join(contact_side, F.col("sfdc_contact_id") == F.col("cc_id"), "left")
    )
    return rows.select(
        F.col("task_id").alias("activity_id"),
        F.col("ca_csn").alias("account_csn"),
        F.col("opp_number").alias("opportunity_number"),
        F.col("opp_id").alias("whatid"),
        F.col("owner_id").alias("ownerid"),
        F.coalesce(F.col("ec_csn"), F.col("cc_csn")).alias("account_contact_csn"),
        F.col("task_subject").alias("activity_subject"),
        "task_type", "task_subtype", "task_status",
        F.col("date_created").cast("date").alias("activity_created_date"),
        F.col("date_created").alias("activity_created_timestamp"),
        F.col("date_activity").cast("date").alias("activity_date"),
        F.col("completed_date_time").alias("activity_completed_timestamp"),
        F.col("call_outcome").alias("cadence_activity_sub_type"),
        F.col("task_type_c").alias("cadence_activity_type"),
        "call_outcome",
        F.col("call_type").alias("call_type_raw"),
        F.col("outreach_call_duration_c").alias("outreach_call_duration_seconds"),
        "new_activity_type", "activity_type",
        R.activity_group(F.nullif(F.trim(tt), F.lit("")), F.coalesce(F.col("acc_type"), F.col("ca_type")),
                         F.coalesce(F.col("ec_email"), F.col("cc_email")), params.tenant_pattern)
        .alias("activity_group"),
        F.lit(R.ACTIVITY_ACS).alias("source_system"),
    )


def with_activity_measures(df: DataFrame) -> DataFrame:
    """R17-R24 on the unioned rows, then the 30 published columns."""
    nt = F.col("new_activity_type")
    flags = R.kpi_flags(nt, F.col("activity_type"), F.col("activity_group"), F.col("source_system"),
                        F.col("cadence_activity_sub_type"), F.col("call_outcome"), F.col("task_type"))
    out = df.select(
        "*",
        R.call_disposition(nt, F.col("call_outcome"), F.col("cadence_activity_sub_type")).alias("calldisposition"),
        R.call_duration(nt, F.col("outreach_call_duration_seconds"), F.col("activity_created_timestamp"),
                        F.col("activity_completed_timestamp")).alias("calldurationinseconds"),
        *[c.alias(name) for name, c in flags.items()],
    )
    return out.select(*COLUMNS)


def fct_blended_opportunity_activities(src: Sources, params: Params) -> DataFrame:
    """F2 = measures over (EDH UNION ALL Construction), created on/after the floor."""
    both = edh_activities(src, params).unionByName(construction_activities(src, params))
    return with_activity_measures(both)
