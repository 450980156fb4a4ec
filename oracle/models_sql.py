"""DuckDB CTEs for the conformed dimensions and the two facts.

Written on its own terms, not mirroring the Spark plans: NOT EXISTS for "not
in the authoritative system", lookups pre-joined in subqueries, nested CASE
expressions for the taxonomies, QUALIFY ROW_NUMBER for the latest quote and
rate, a boolean CTE for the KPI flags.  Parameters are the test parameters.
"""

from __future__ import annotations

from dimstar.functions import rules as R
from dimstar.params import TEST_PARAMS
from oracle.sources_sql import in_list, lit

P = TEST_PARAMS
CLOSE_FROM, CLOSE_TO = f"DATE '{P.close_from}'", f"DATE '{P.close_to}'"
LOOKBACK = f"CAST(DATE '{P.lookback_start}' AS TIMESTAMP)"
REPORT_FROM = f"DATE '{P.report_from}'"
AS_OF = f"DATE '{P.as_of}'"
SENT = lit(P.sentinel)
TENANT = P.tenant_pattern


def stage_case(col: str, acs: bool, what: str) -> str:
    won = R.STAGE_WON + (R.STAGE_WON_ACS_ONLY if acs else ())
    steps = [(R.STAGE_1, "Stage 1", 1, "0.10"), (R.STAGE_2, "Stage 2", 2, "0.20"), (R.STAGE_3, "Stage 3", 3, "0.30"),
             (R.STAGE_4, "Stage 4", 4, "0.50"), (R.STAGE_5, "Stage 5", 5, "0.80")]
    if what == "label":
        arms = [f"WHEN {col} IN {in_list(R.STAGE_LOST)} THEN 'Closed/Lost'", f"WHEN {col} IN {in_list(won)} THEN 'Won'"]
        arms += [f"WHEN {col} IN {in_list(labels)} THEN '{name}'" for labels, name, _, _ in steps]
        return "CASE " + " ".join(arms) + f" ELSE {col} END"
    if what == "rank":
        arms = [f"WHEN {col} IN {in_list(labels)} THEN {rank}" for labels, _, rank, _ in steps]
        arms.append(f"WHEN {col} IN {in_list(won)} THEN 6")
        return "CASE " + " ".join(arms) + " ELSE 0 END"
    arms = [f"WHEN {col} IN {in_list(labels)} THEN {w}" for labels, _, _, w in steps]
    arms.append(f"WHEN {col} IN {in_list(won)} THEN 1.00")
    return "CAST(CASE " + " ".join(arms) + " ELSE 0.00 END AS DECIMAL(3,2))"


def domain(email: str) -> str:
    return f"substring(lower({email}), strpos(lower({email}), '@') + 1, length(lower({email})))"


ELIGIBLE = (f"{{a}}.account_type IN {in_list(R.ELIGIBLE_ACCOUNT_TYPES)} AND {{a}}.is_visible = 1 "
            f"AND COALESCE({{a}}.account_category, '') NOT IN ('Internal', 'Partner')")

TARGETED = ("CASE upper(trim(CAST(is_targeted_account AS VARCHAR))) "
            "WHEN '1' THEN true WHEN 'Y' THEN true WHEN 'YES' THEN true WHEN 'TRUE' THEN true "
            "WHEN '0' THEN false WHEN 'N' THEN false WHEN 'NO' THEN false WHEN 'FALSE' THEN false END")


def _not_in(table: str, col: str, outer: str) -> str:
    return f"NOT EXISTS (SELECT 1 FROM {table} z WHERE z.{col} = {outer})"


def model_ctes() -> list[tuple[str, str]]:
    c = []
    c.append(("m_dim_date", """
        SELECT date_key AS date_day, fiscal_year_name, fiscal_year_quarter_name, month_number_in_fiscal_quarter,
               concat_ws('-', fiscal_year_name, fiscal_year_quarter_name) AS fiscal_quarter,
               concat_ws('-', fiscal_year_name, fiscal_year_quarter_name,
                         'M' || CAST(CAST(month_number_in_fiscal_quarter AS INTEGER) AS VARCHAR)) AS fiscal_quarter_month
        FROM s_edh_finance_calendar"""))
    c.append(("m_dim_unified_account", f"""
        SELECT account_csn, account_name, sales_geo AS account_geo, country_name AS account_country,
               sales_region_name AS account_region, named_account_group,
               IF(named_account_group IN ('Territory', 'Individual', 'Unknown'), 'Territory', named_account_group)
                   AS account_segment,
               account_type, corporate_account_name AS parent_account_name,
               TRY_CAST(account_hierarchy_depth AS DECIMAL(18,0)) AS account_hierarchy_depth,
               CAST(account_hierarchy_level AS VARCHAR) AS account_hierarchy_level,
               account_category, industry_segment, {TARGETED} AS is_targeted_account,
               CAST(sales_rep_number AS VARCHAR) AS account_sales_rep_number, 'EDH' AS source_system
        FROM s_edh_account WHERE account_csn IS NOT NULL
        UNION ALL BY NAME
        SELECT own_csn AS account_csn, account_name, geo_c AS account_geo, account_country_c AS account_country,
               NULL AS account_region, NULL AS named_account_group, NULL AS account_segment, account_type,
               NULL AS parent_account_name, CAST(NULL AS DECIMAL(18,0)) AS account_hierarchy_depth,
               NULL AS account_hierarchy_level, NULL AS account_category, NULL AS industry_segment,
               CAST(NULL AS BOOLEAN) AS is_targeted_account, NULL AS account_sales_rep_number, 'ACS' AS source_system
        FROM s_acs_account ca
        WHERE own_csn IS NOT NULL AND {_not_in('s_edh_account', 'account_csn', 'ca.own_csn')}"""))
    c.append(("m_dim_unified_contact", f"""
        SELECT contact_csn, first_name AS contact_first_name, last_name AS contact_last_name,
               email_address AS contact_email, contact_phone_number AS contact_phone,
               IF(email_address IS NULL, NULL, {domain('email_address')}) AS contact_email_domain,
               'EDH' AS source_system
        FROM s_edh_contact WHERE contact_csn IS NOT NULL
        UNION ALL BY NAME
        SELECT contact_csn, first_name AS contact_first_name, last_name AS contact_last_name,
               user_email AS contact_email, phone AS contact_phone,
               IF(user_email IS NULL, NULL, {domain('user_email')}) AS contact_email_domain, 'ACS' AS source_system
        FROM s_acs_contact cc
        WHERE contact_csn IS NOT NULL AND {_not_in('s_edh_contact', 'contact_csn', 'cc.contact_csn')}"""))
    c.append(("m_dim_unified_employee", f"""
        SELECT worker_id AS employee_id, preferred_name AS employee_name, sales_role,
               manager_display_name AS manager_name, work_email, 'EDH' AS source_system
        FROM s_edh_employee WHERE is_active = 1 AND worker_id IS NOT NULL
        UNION ALL BY NAME
        SELECT user_id AS employee_id, NULL AS employee_name, NULL AS sales_role, manager_name,
               user_email AS work_email, 'ACS' AS source_system
        FROM s_acs_user u
        WHERE user_id IS NOT NULL AND {_not_in('s_edh_employee', 'worker_id', 'u.user_id')}"""))
    partner_led = " OR ".join(f"contains(lower(t.opportunity_tags__c), '{p}')" for p in R.PARTNER_LED_PHRASES)
    c.append(("m_dim_unified_opportunity", f"""
        SELECT o.opportunity_number, 'EDH_SFDC' AS source_system, o.source_record_id AS opportunity_id,
               o.opportunity_name, o.opportunity_stage AS raw_stage,
               {stage_case('o.opportunity_stage', False, 'label')} AS opportunity_stage,
               {stage_case('o.opportunity_stage', False, 'rank')} AS opportunity_stage_rank,
               {stage_case('o.opportunity_stage', False, 'weight')} AS opportunity_stage_weight,
               o.opportunity_type, o.primary_sales_motion, o.opportunity_forecast_category AS forecast_category,
               o.sales_channel, o.customer_project, o.compelling_event, o.access_to_funds,
               o.formal_decision_process, o.informal_decision_process, o.unique_business_value,
               t.opportunity_tags__c AS opportunity_tags,
               IF(COALESCE({partner_led}, false), 'Yes', 'No') AS is_partner_led,
               CAST(o.source_created_ts AS DATE) AS opportunity_created_date,
               CAST(o.projected_close_date AS DATE) AS opportunity_projected_close_date,
               o.sales_rep_number AS opportunity_owner_id
        FROM s_edh_opportunity o LEFT JOIN s_crm_opportunity_tags t ON t.id = o.source_record_id
        WHERE o.opportunity_type = 'UnifiedOpportunity' AND o.opportunity_number IS NOT NULL
        UNION ALL BY NAME
        SELECT a.opportunity_number__c AS opportunity_number, 'ACS_SFDC' AS source_system, a.id AS opportunity_id,
               a.name AS opportunity_name, a.stage_name AS raw_stage,
               {stage_case('a.stage_name', True, 'label')} AS opportunity_stage,
               {stage_case('a.stage_name', True, 'rank')} AS opportunity_stage_rank,
               {stage_case('a.stage_name', True, 'weight')} AS opportunity_stage_weight,
               a.type AS opportunity_type, {SENT} AS primary_sales_motion, {SENT} AS forecast_category,
               a.bmtchannel_c AS sales_channel, {SENT} AS customer_project, {SENT} AS compelling_event,
               {SENT} AS access_to_funds, {SENT} AS formal_decision_process, {SENT} AS informal_decision_process,
               {SENT} AS unique_business_value, {SENT} AS opportunity_tags, {SENT} AS is_partner_led,
               CAST(a.created_date AS DATE) AS opportunity_created_date,
               CAST(a.close_date AS DATE) AS opportunity_projected_close_date, a.owner_id AS opportunity_owner_id
        FROM s_acs_opportunity a
        WHERE a.opportunity_number__c IS NOT NULL
          AND {_not_in('s_edh_opportunity', 'opportunity_number', 'a.opportunity_number__c')}"""))
    c.append(("m_latest_quote", """
        SELECT opportunity_number, quote_number, sales_partner_account_csn, quote_status, quote_date
        FROM s_edh_quote
        QUALIFY row_number() OVER (PARTITION BY opportunity_number
                                   ORDER BY quote_date IS NULL, quote_date DESC NULLS LAST,
                                            quote_number DESC NULLS LAST) = 1"""))
    c.append(("m_latest_fx", """
        SELECT from_currency_code, effective_start_date, exchange_rate
        FROM s_edh_exchange_rate
        QUALIFY row_number() OVER (PARTITION BY from_currency_code
                                   ORDER BY effective_start_date DESC NULLS LAST, exchange_rate DESC NULLS LAST) = 1"""))
    c.append(("m_eligible", f"""
        SELECT * FROM s_edh_account a WHERE {ELIGIBLE.format(a='a')}"""))
    c.append(("m_edh_lines", f"""
        SELECT 'EDH_SFDC' AS source_system, o.opportunity_number, x.line_item_number,
               o.end_customer_account_csn AS account_csn, o.sales_partner_account_csn AS partner_csn,
               o.sales_partner_account_csn AS opportunity_partner_account_csn,
               o.sales_rep_number AS opportunity_owner_id, e.sales_rep_number AS account_owner_id,
               CAST(o.projected_close_date AS DATE) AS opportunity_projected_close_date,
               CAST(x.quantity AS DOUBLE) AS quantity, x.acv AS line_item_acv_usd,
               CAST(x.acv * {stage_case('o.opportunity_stage', False, 'weight')} AS DECIMAL(32,10))
                   AS line_item_weighted_acv_usd,
               x.sales_revenue_group_detail AS offer_type, x.opportunity_line_status, x.sales_motion_category,
               x.action, x.access_model AS license_type, x.term, x.sales_motion_product_category, x.offering_name,
               x.solution_division, x.focus_segment_group, x.focus_segment, q.quote_number,
               q.sales_partner_account_csn AS quote_partner_account_csn, q.quote_status, q.quote_date AS quoted_on_date
        FROM s_edh_opportunity o
        JOIN m_eligible e ON e.account_csn = o.end_customer_account_csn
        LEFT JOIN (SELECT l.*, CAST(l.line_item_acv_usd AS DECIMAL(28,8)) AS acv, f.sales_motion_product_category,
                          f.offering_name, f.solution_division, f.focus_segment_group, f.focus_segment
                   FROM s_edh_opportunity_line_item l LEFT JOIN s_edh_offering f ON f.offering_id = l.offering_id) x
               ON x.opportunity_number = o.opportunity_number
        LEFT JOIN m_latest_quote q ON q.opportunity_number = o.opportunity_number
        WHERE o.opportunity_type = 'UnifiedOpportunity'
          AND CAST(o.projected_close_date AS DATE) BETWEEN {CLOSE_FROM} AND {CLOSE_TO}"""))
    c.append(("m_acs_opps_ok", f"""
        SELECT o.*, aa.child_csn, aa.shipping_country AS account_shipping_country,
               e.account_csn AS cust_csn, e.sales_rep_number AS cust_rep
        FROM s_acs_opportunity o
        JOIN s_acs_account aa ON aa.account_id = o.account_id
        JOIN m_eligible e ON trim(e.account_csn) = trim(aa.child_csn)
        WHERE {_not_in('s_edh_opportunity', 'opportunity_number', 'o.opportunity_number__c')}
          AND COALESCE(o.reason_lost_c, 'n/a') <> 'Migrated to ENT'
          AND CAST(o.close_date AS DATE) BETWEEN {CLOSE_FROM} AND {CLOSE_TO}"""))
    c.append(("m_acs_lines", f"""
        SELECT 'ACS_SFDC' AS source_system, o.opportunity_number__c AS opportunity_number,
               x.id AS line_item_number, o.cust_csn AS account_csn, o.child_csn AS partner_csn,
               o.child_csn AS opportunity_partner_account_csn, o.owner_id AS opportunity_owner_id,
               o.cust_rep AS account_owner_id, CAST(o.close_date AS DATE) AS opportunity_projected_close_date,
               CAST(x.quantity AS DOUBLE) AS quantity, x.acv AS line_item_acv_usd,
               CAST(x.acv * {stage_case('o.stage_name', True, 'weight')} AS DECIMAL(32,10))
                   AS line_item_weighted_acv_usd,
               {SENT} AS offer_type, {SENT} AS opportunity_line_status, {SENT} AS sales_motion_category,
               {SENT} AS action, {SENT} AS license_type, {SENT} AS term,
               {SENT} AS sales_motion_product_category, x.subscription_name AS offering_name,
               {SENT} AS solution_division, 'Emerging Tech' AS focus_segment_group,
               'Construction' AS focus_segment, {SENT} AS quote_number, {SENT} AS quote_partner_account_csn,
               {SENT} AS quote_status, CAST(NULL AS DATE) AS quoted_on_date
        FROM m_acs_opps_ok o
        LEFT JOIN s_country_region_map g
               ON lower(g.country) = lower(COALESCE(o.shipping_country, o.account_shipping_country))
        LEFT JOIN (SELECT l.*, CAST(l.est_annualized_amount_c * r.exchange_rate AS DECIMAL(28,8)) AS acv
                   FROM s_acs_opportunity_line_item l
                   LEFT JOIN m_latest_fx r ON r.from_currency_code = l.currency_iso_code
                   WHERE l.is_deleted = 0) x ON x.opportunity_id = o.id
        WHERE g.country IS NULL OR o.is_closed <> 0"""))
    c.append(("m_fct_blended_opportunities", "SELECT * FROM m_edh_lines UNION ALL BY NAME SELECT * FROM m_acs_lines"))

    # ---- activities
    def edh_type(sat, s, sas, subj, descr):
        t = f"NULLIF(trim({sat}), '')"
        dflt = f"COALESCE(NULLIF(trim({s}), ''), 'Task')"
        return f"""CASE
            WHEN {t} IN ('Call', 'Scheduled Call') THEN 'Call'
            WHEN {t} IN ('Email', 'Meeting', 'Chat', 'Social', 'Update') THEN {t}
            WHEN {t} IS NULL AND {s} = 'Task' THEN CASE
                WHEN {sas} = 'Email - Response Received' THEN 'Email'
                WHEN contains(lower({subj}), 'sub-call') THEN 'Call'
                WHEN contains(lower({subj}), 'inmail') OR contains(lower({descr}), 'external email')
                     OR contains(lower({descr}), 'email sent successfully') THEN 'Email'
                ELSE {dflt} END
            ELSE {dflt} END"""
    sub = "NULLIF(trim(t.sales_activity_subtype), '')"
    typ = "NULLIF(trim(t.sales_activity_type), '')"
    edh_dir = f"""CASE
            WHEN {sub} IN ('Email - Sent', 'Email - Engaged with Partner') THEN 'Outbound'
            WHEN {sub} = 'Email - Response Received' THEN 'Inbound'
            WHEN {typ} IN ('Call', 'Scheduled Call') OR t.task_subtype = 'Call' THEN 'Outbound'
            WHEN {typ} = 'Email' THEN CASE
                WHEN t.task_type = 'Inbound' THEN 'Inbound'
                WHEN {sub} IS NULL AND t.task_subtype IN ('Email', 'ListEmail') THEN 'Outbound'
                ELSE trim(t.sales_activity_subtype) END
            ELSE trim(t.sales_activity_subtype) END"""
    c.append(("m_edh_activities", f"""
        SELECT t.task_id AS activity_id, oa.end_customer_account_csn AS account_csn,
               oa.opportunity_number, oa.source_record_id AS whatid,
               t.assigned_to_employee_number AS ownerid, t.end_customer_contact_csn AS account_contact_csn,
               t.subject_line AS activity_subject, t.task_type, t.task_subtype, t.task_status,
               CAST(t.source_created_ts AS DATE) AS activity_created_date,
               t.source_created_ts AS activity_created_timestamp,
               CAST(t.task_activity_date AS DATE) AS activity_date,
               t.task_completed_ts AS activity_completed_timestamp,
               trim(t.sales_activity_subtype) AS cadence_activity_sub_type,
               trim(t.sales_activity_type) AS cadence_activity_type,
               CAST(NULL AS VARCHAR) AS call_outcome, CAST(NULL AS VARCHAR) AS call_type_raw,
               CAST(NULL AS DOUBLE) AS outreach_call_duration_seconds,
               {edh_type('t.sales_activity_type', 't.task_subtype', 't.sales_activity_subtype',
                         't.subject_line', 't.task_description')} AS new_activity_type,
               {edh_dir} AS activity_type,
               CASE WHEN trim(t.sales_activity_subtype) IN ('Engaged with partner', 'Email - Engaged with Partner')
                         OR oa.account_type IN ('Distributor', 'Reseller') THEN 'Partner Activity'
                    WHEN contains({domain('con.email_address')}, '{TENANT}') THEN 'Internal Activity'
                    ELSE 'Customer Activity' END AS activity_group,
               'EDH' AS source_system
        FROM s_edh_opportunity_task t
        JOIN (SELECT o.opportunity_number, o.end_customer_account_csn, o.source_record_id, a.account_type
              FROM s_edh_opportunity o LEFT JOIN s_edh_account a ON a.account_csn = o.end_customer_account_csn) oa
          ON oa.opportunity_number = t.opportunity_number
        LEFT JOIN s_edh_contact con ON con.contact_csn = t.end_customer_contact_csn
        WHERE t.task_status = 'Completed' AND t.source_created_ts >= {LOOKBACK}
          AND t.sales_activity_subtype IS DISTINCT FROM 'Email - Bounced'"""))
    ct = "NULLIF(trim(ct.task_type), '')"
    s = "ct.task_subtype"
    rest = f"IF(NULLIF(trim({s}), '') IN ('Chat', 'Social', 'Update', 'ListEmail', 'Cadence'), {s}, " \
           f"COALESCE(NULLIF(trim({s}), ''), 'Task'))"
    acs_type = f"""CASE
            WHEN {ct} IN ('Call', 'Connected Call') THEN 'Call'
            WHEN {ct} IN ('Email', 'Meeting') THEN {ct}
            WHEN {s} IN ('Email', 'Call', 'Meeting') THEN {s}
            WHEN {s} = 'Task' THEN CASE
                WHEN {ct} IN {in_list(R.ACS_EMAIL_LABELS)} THEN 'Email'
                WHEN {ct} IN {in_list(R.ACS_MEETING_LABELS)} OR contains(lower({ct}), 'meeting') THEN 'Meeting'
                WHEN starts_with(lower({ct}), 'linkedin:') OR {ct} IN {in_list(R.ACS_SOCIAL_LABELS)} THEN 'Social'
                WHEN {ct} IN {in_list(R.ACS_CALL_LABELS)} THEN 'Call'
                WHEN {ct} IN {in_list(R.ACS_TASK_LABELS)} THEN 'Task'
                ELSE {rest} END
            ELSE {rest} END"""
    acs_dir = f"""CASE
            WHEN {s} = 'Email' OR {ct} IN ('Email - Sent', 'Email - Engaged with Partner') THEN 'Outbound'
            WHEN {ct} = 'Email - Response Received' THEN 'Inbound'
            WHEN {s} = 'Call' OR {ct} IN ('Call', 'Connected Call') THEN COALESCE(ct.call_type, 'Outbound')
            WHEN {s} = 'ListEmail' THEN 'Outbound' END"""
    mail = "COALESCE(cs.ec_email, cs.cc_email)"
    c.append(("m_construction_activities", f"""
        SELECT ct.task_id AS activity_id, os.own_csn AS account_csn, os.opportunity_number__c AS opportunity_number,
               os.id AS whatid, ct.owner_id AS ownerid,
               COALESCE(cs.ec_csn, cs.cc_csn) AS account_contact_csn,
               ct.task_subject AS activity_subject, ct.task_type, ct.task_subtype, ct.task_status,
               CAST(ct.date_created AS DATE) AS activity_created_date,
               ct.date_created AS activity_created_timestamp,
               CAST(ct.date_activity AS DATE) AS activity_date,
               ct.completed_date_time AS activity_completed_timestamp,
               ct.call_outcome AS cadence_activity_sub_type, ct.task_type_c AS cadence_activity_type,
               ct.call_outcome, ct.call_type AS call_type_raw,
               ct.outreach_call_duration_c AS outreach_call_duration_seconds,
               {acs_type} AS new_activity_type, {acs_dir} AS activity_type,
               CASE WHEN {ct} IN ('Engaged with partner', 'Email - Engaged with Partner')
                         OR COALESCE(os.edh_type, os.acs_type) IN ('Distributor', 'Reseller') THEN 'Partner Activity'
                    WHEN contains({domain(mail)}, '{TENANT}') THEN 'Internal Activity'
                    ELSE 'Customer Activity' END AS activity_group,
               'Construction' AS source_system
        FROM s_acs_task ct
        JOIN (SELECT o.id, o.opportunity_number__c, ca.own_csn, ca.account_type AS acs_type,
                     a.account_type AS edh_type
              FROM s_acs_opportunity o
              JOIN s_acs_account ca ON ca.account_id = o.account_id
              LEFT JOIN s_edh_account a ON a.account_csn = ca.own_csn
              WHERE ca.own_csn IS NOT NULL
                AND {_not_in('s_edh_opportunity', 'opportunity_number', 'o.opportunity_number__c')}) os
          ON os.id = ct.what_id
        LEFT JOIN (SELECT cc.contact_id, cc.contact_csn AS cc_csn, cc.user_email AS cc_email,
                          ec.contact_csn AS ec_csn, ec.email_address AS ec_email
                   FROM s_acs_contact cc LEFT JOIN s_edh_contact ec ON ec.contact_csn = cc.contact_csn) cs
          ON cs.contact_id = ct.sfdc_contact_id
        WHERE ct.task_status = 'Completed' AND COALESCE(ct.is_deleted, 0) = 0
          AND ct.date_created >= {LOOKBACK} AND ct.task_type <> 'Email - Bounced'"""))
    edh_conn = in_list(R.EDH_CONNECTED_SUBTYPES)
    acs_conn = in_list(R.ACS_CONNECTED_OUTCOMES)
    c.append(("m_activity_tests", f"""
        SELECT *,
               new_activity_type = 'Call' AS is_call, new_activity_type = 'Email' AS is_email,
               activity_group = 'Customer Activity' AS is_customer, source_system = 'EDH' AS is_edh
        FROM (SELECT * FROM m_edh_activities UNION ALL BY NAME SELECT * FROM m_construction_activities)
        WHERE activity_created_date >= {REPORT_FROM}"""))
    flag = "CAST(COALESCE({}, false) AS INTEGER)"
    c.append(("m_fct_blended_opportunity_activities", f"""
        SELECT activity_id, source_system, account_csn, ownerid, account_contact_csn, opportunity_number, whatid,
               activity_created_date, activity_subject, task_type, task_subtype, task_status,
               activity_created_timestamp, activity_date, activity_completed_timestamp, cadence_activity_type,
               cadence_activity_sub_type, new_activity_type, activity_type, activity_group, call_outcome, call_type_raw,
               IF(is_call, COALESCE(call_outcome, cadence_activity_sub_type), NULL) AS calldisposition,
               IF(is_call, COALESCE(
                   CAST(trunc(NULLIF(outreach_call_duration_seconds, 0)) AS INTEGER),
                   IF(activity_completed_timestamp > activity_created_timestamp,
                      CAST(date_diff('second', activity_created_timestamp, activity_completed_timestamp) AS INTEGER),
                      NULL)), NULL) AS calldurationinseconds,
               {flag.format("is_call AND activity_type = 'Outbound' AND is_customer")} AS call_attempt_outbound,
               {flag.format(f"is_call AND activity_type = 'Outbound' AND is_customer AND IF(is_edh, "
                            f"cadence_activity_sub_type IN {edh_conn}, call_outcome IN {acs_conn})")}
                   AS call_connected_outbound,
               {flag.format(f"new_activity_type = 'Meeting' AND is_customer AND IF(is_edh, "
                            f"activity_type = 'Outbound' AND cadence_activity_sub_type = 'Meeting scheduled', "
                            f"task_type IN {in_list(R.ACS_MEETING_SCHEDULED_TYPES)})")} AS meeting_scheduled,
               {flag.format(f"new_activity_type IN ('Meeting', 'Call') AND IF(is_edh, "
                            f"cadence_activity_sub_type IN {in_list(R.EDH_MEETING_COMPLETED_SUBTYPES)}, "
                            f"task_type IN {in_list(R.ACS_MEETING_COMPLETED_TYPES)})")} AS meeting_completed,
               {flag.format("is_email AND activity_type = 'Outbound' AND is_customer")} AS email_attempt_outbound,
               {flag.format("is_email AND activity_type = 'Inbound' AND is_customer")} AS email_received
        FROM m_activity_tests"""))
    return c
