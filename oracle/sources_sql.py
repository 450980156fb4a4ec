"""DuckDB CTEs that derive the 18 CRM sources from the test tables.

Written independently of the Spark code, from FIXTURES.md part C.  The
label lists are fixed values shared with the Spark side; the SQL that uses
them is this file's own.
"""

from __future__ import annotations

from dimstar.sources import fixture as FX


def lit(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    if isinstance(v, float):
        return f"CAST({v!r} AS DOUBLE)"
    return str(v)


def sql_list(values) -> str:
    return "[" + ", ".join(lit(v) for v in values) + "]"


def pick(expr: str, values) -> str:
    values = list(values)
    return f"({sql_list(values)})[1 + ({expr}) % {len(values)}]"


def in_list(values) -> str:
    return "(" + ", ".join(lit(v) for v in values) + ")"


def source_ctes() -> list[tuple[str, str]]:
    ok = "o_orderkey"
    ctes = []
    ctes.append(("s_edh_opportunity", f"""
        SELECT 'A-' || {ok} AS opportunity_number,
               'R-' || {ok} AS source_record_id,
               'Deal ' || {ok} AS opportunity_name,
               {pick(ok, FX.EDH_STAGE_PICKS)} AS opportunity_stage,
               CASE WHEN {ok} % 11 = 0 THEN 'Legacy' ELSE 'UnifiedOpportunity' END AS opportunity_type,
               'C-' || o_custkey AS end_customer_account_csn,
               'C-' || (o_custkey + 1) AS sales_partner_account_csn,
               'W-' || ({ok} % 10) AS sales_rep_number,
               o_orderdate AS projected_close_date,
               o_orderdate - INTERVAL 90 DAY AS source_created_ts,
               o_orderpriority AS primary_sales_motion,
               o_orderstatus AS opportunity_forecast_category,
               {pick(ok, ['Direct', 'Partner', 'Online'])} AS sales_channel,
               {pick(ok + ' // 3', ['Yes', 'No', None])} AS customer_project,
               {pick(ok + ' // 5', ['Renewal date', 'Budget cycle', None])} AS compelling_event,
               {pick(ok + ' // 7', ['Yes', 'No'])} AS access_to_funds,
               {pick(ok + ' // 2', ['Known', 'Unknown'])} AS formal_decision_process,
               {pick(ok + ' // 11', ['Known', 'Unknown', None])} AS informal_decision_process,
               {pick(ok + ' // 13', ['Cost', 'Speed', 'Quality'])} AS unique_business_value
        FROM orders WHERE {ok} % 4 <> 3"""))
    four_part = "l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey"
    ctes.append(("s_edh_opportunity_line_item", f"""
        SELECT 'A-' || l_orderkey AS opportunity_number,
               'L-' || {four_part} AS line_item_number,
               'P-' || l_partkey AS offering_id,
               l_quantity AS quantity,
               CAST(l_extendedprice AS DECIMAL(18,2)) AS line_item_acv_usd,
               l_returnflag AS sales_revenue_group_detail,
               l_linestatus AS opportunity_line_status,
               {pick('l_linenumber', ['Acquire', 'Expand', 'Renew'])} AS sales_motion_category,
               {pick('l_suppkey', ['Add', 'Renew', 'Upgrade', 'Remove'])} AS action,
               {pick('l_partkey', ['Subscription', 'Perpetual', 'Cloud'])} AS access_model,
               {pick('l_linenumber // 2', ['Annual', 'Monthly', '3-Year'])} AS term
        FROM lineitem WHERE l_orderkey % 4 <> 3"""))
    ctes.append(("s_edh_offering", f"""
        SELECT 'P-' || p_partkey AS offering_id, p_name AS offering_name,
               {pick('p_partkey', ['Core', 'Platform', 'Add-on'])} AS sales_motion_product_category,
               p_brand AS solution_division,
               {pick('p_size', ['Design', 'Make', 'Media'])} AS focus_segment_group,
               p_type AS focus_segment
        FROM part WHERE p_partkey % 19 <> 0"""))
    ck = "c_custkey"
    ctes.append(("s_edh_account", f"""
        SELECT 'C-' || {ck} AS account_csn, c_name AS account_name, r_name AS sales_geo, n_name AS country_name,
               r_name || '/' || c_mktsegment AS sales_region_name,
               {pick(ck, FX.NAMED_GROUP_PICKS)} AS named_account_group,
               {pick(ck, FX.ACCOUNT_TYPE_PICKS)} AS account_type,
               'Group ' || ({ck} // 10) AS corporate_account_name,
               {pick(ck, FX.DEPTH_PICKS)} AS account_hierarchy_depth,
               {ck} % 3 AS account_hierarchy_level,
               {pick(ck + ' % 9', FX.CATEGORY_PICKS)} AS account_category,
               c_mktsegment AS industry_segment,
               {pick(ck, FX.TARGETED_PICKS)} AS is_targeted_account,
               'W-' || ({ck} % 10) AS sales_rep_number,
               CASE WHEN {ck} % 13 = 0 THEN 0 ELSE 1 END AS is_visible
        FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
        WHERE {ck} % 5 <> 4"""))
    ctes.append(("s_edh_quote", f"""
        SELECT 'A-' || l_orderkey AS opportunity_number,
               'Q-' || l_partkey || '-' || l_suppkey || '-' || l_linenumber AS quote_number,
               'C-' || l_suppkey AS sales_partner_account_csn,
               {pick('l_linenumber', ['Draft', 'Approved', 'Ordered'])} AS quote_status,
               CASE WHEN l_linenumber % 5 = 0 THEN NULL ELSE CAST(l_shipdate AS DATE) END AS quote_date
        FROM lineitem WHERE l_orderkey % 4 <> 3 AND l_returnflag = 'R'"""))
    ctes.append(("s_rate_months", """
        SELECT m, year(m) * 12 + month(m) AS mi
        FROM (SELECT DISTINCT CAST(date_trunc('month', o_orderdate) AS DATE) AS m FROM orders)"""))
    ctes.append(("s_edh_exchange_rate", """
        SELECT c AS from_currency_code, m AS effective_start_date, CAST(r AS DECIMAL(18,6)) AS exchange_rate
        FROM (SELECT 'USD' AS c, m, CAST(1.0 AS DOUBLE) AS r FROM s_rate_months
              UNION ALL SELECT 'EUR', m, (105 + mi % 7) / 100 FROM s_rate_months
              UNION ALL SELECT 'GBP', m, (120 + mi % 5) / 100 FROM s_rate_months)"""))
    ctes.append(("s_crm_opportunity_tags", f"""
        SELECT 'R-' || {ok} AS id, {pick(ok, FX.TAG_PICKS)} AS opportunity_tags__c
        FROM orders WHERE {ok} % 4 <> 3 AND {ok} % 3 <> 0"""))
    ctes.append(("s_acs_opportunity", f"""
        SELECT 'S-' || {ok} AS id,
               CASE WHEN {ok} % 23 = 0 THEN NULL ELSE 'A-' || {ok} END AS opportunity_number__c,
               'SA-' || o_custkey AS account_id,
               'U-' || ({ok} % 10) AS owner_id,
               'Site ' || {ok} AS name,
               {pick(ok, FX.ACS_STAGE_PICKS)} AS stage_name,
               {pick(ok, ['New Business', 'Renewal', 'Upsell'])} AS type,
               {pick(ok + ' // 4', ['Direct', 'Partner'])} AS bmtchannel_c,
               o_orderdate - INTERVAL 30 DAY AS created_date,
               o_orderdate AS close_date,
               CASE WHEN {ok} % 3 = 0 THEN NULL ELSE upper(n_name) END AS shipping_country,
               CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 0 END AS is_closed,
               CASE WHEN {ok} % 29 = 0 THEN 'Migrated to ENT' WHEN {ok} % 5 = 0 THEN NULL ELSE 'Price' END
                   AS reason_lost_c
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
        WHERE {ok} % 4 IN (2, 3)"""))
    ctes.append(("s_acs_opportunity_line_item", f"""
        SELECT 'SL-' || {four_part} AS id, 'S-' || l_orderkey AS opportunity_id, l_quantity AS quantity,
               CAST(l_extendedprice AS DECIMAL(18,2)) AS est_annualized_amount_c,
               {pick('l_suppkey', FX.CURRENCY_PICKS)} AS currency_iso_code,
               l_returnflag AS subscription_name,
               CASE WHEN l_linenumber % 7 = 0 THEN 1 ELSE 0 END AS is_deleted
        FROM lineitem WHERE l_orderkey % 4 IN (2, 3)"""))
    ctes.append(("s_acs_account", f"""
        SELECT 'SA-' || {ck} AS account_id,
               CASE WHEN {ck} % 31 = 0 THEN NULL ELSE 'C-' || {ck} END AS own_csn,
               ' C-' || {ck} || ' ' AS child_csn,
               c_name AS account_name, 'GEO-' || n_regionkey AS geo_c, upper(n_name) AS account_country_c,
               {pick(ck + ' // 2', ['Customer', 'Distributor', 'Prospect', 'Reseller'])} AS account_type,
               upper(n_name) AS shipping_country
        FROM customer JOIN nation ON c_nationkey = n_nationkey"""))
    ctes.append(("s_country_region_map", "SELECT n_name AS country FROM nation WHERE n_nationkey % 2 = 0"))
    sk = "s_suppkey"
    ctes.append(("s_edh_employee", f"""
        SELECT 'W-' || {sk} AS worker_id, s_name AS preferred_name,
               {pick(sk, ['AE', 'SDR', 'CSM'])} AS sales_role,
               'Manager ' || ({sk} % 5) AS manager_display_name,
               'w' || {sk} || '@corp.example' AS work_email,
               CASE WHEN {sk} % 10 = 2 THEN 0 ELSE 1 END AS is_active
        FROM supplier"""))
    ctes.append(("s_acs_user", f"""
        SELECT CASE WHEN {sk} % 10 < 3 THEN 'W-' || {sk} ELSE 'U-' || {sk} END AS user_id,
               'Lead ' || ({sk} % 4) AS manager_name, 'u' || {sk} || '@crm.example' AS user_email
        FROM supplier"""))
    ctes.append(("s_edh_contact", f"""
        SELECT 'K-' || {ck} AS contact_csn, 'First' || {ck} AS first_name, c_name AS last_name,
               {pick(ck, FX.MAIL_PICKS)} AS email_address, 'P-' || {ck} AS contact_phone_number
        FROM customer WHERE {ck} % 3 <> 2"""))
    ctes.append(("s_acs_contact", f"""
        SELECT 'SC-' || {ck} AS contact_id,
               CASE WHEN {ck} % 4 = 0 THEN NULL ELSE 'K-' || {ck} END AS contact_csn,
               'Given' || {ck} AS first_name, c_name AS last_name,
               {pick(ck + ' + 3', FX.MAIL_PICKS)} AS user_email, 'SP-' || {ck} AS phone
        FROM customer"""))
    ev = "event_id"
    done = "ts + to_seconds(CAST(floor(value) AS BIGINT))"
    status = "CASE WHEN event_type = 'error' THEN 'Open' ELSE 'Completed' END"
    ctes.append(("s_edh_opportunity_task", f"""
        SELECT 'T-' || {ev} AS task_id,
               'A-' || ({ev} * 7 % (SELECT max(o_orderkey) + 1 FROM orders)) AS opportunity_number,
               'W-' || (user_id % 10) AS assigned_to_employee_number,
               'K-' || user_id AS end_customer_contact_csn,
               {pick(ev, FX.EDH_SUBJECT_PICKS)} AS subject_line,
               {pick(ev + ' // 7', FX.EDH_DESCRIPTION_PICKS)} AS task_description,
               {pick(ev + ' // 2', FX.EDH_TASK_TYPE_PICKS)} AS task_type,
               {pick(ev, FX.EDH_TASK_SUBTYPE_PICKS)} AS task_subtype,
               {status} AS task_status,
               {pick(ev, FX.EDH_SALES_TYPE_PICKS)} AS sales_activity_type,
               {pick(ev, FX.EDH_SALES_SUBTYPE_PICKS)} AS sales_activity_subtype,
               ts AS source_created_ts, ts AS task_activity_date,
               CASE WHEN {ev} % 4 = 0 THEN NULL ELSE {done} END AS task_completed_ts
        FROM events WHERE {ev} % 3 <> 0"""))
    j = f"({ev} // 3)"
    ctes.append(("s_acs_task", f"""
        SELECT 'ST-' || {ev} AS task_id,
               'S-' || ({ev} * 7 % (SELECT max(o_orderkey) + 1 FROM orders)) AS what_id,
               'U-' || (user_id % 10) AS owner_id,
               'SC-' || user_id AS sfdc_contact_id,
               {pick(j, ['Intro', 'Follow up', None])} AS task_subject,
               {pick(j, FX.ACS_TASK_TYPE_PICKS)} AS task_type,
               {pick(j, FX.ACS_TASK_SUBTYPE_PICKS)} AS task_subtype,
               {status} AS task_status,
               {pick(j + ' // 2', ['Prospecting', 'Follow-up', None])} AS task_type_c,
               {pick(j + ' // 3', FX.ACS_CALL_OUTCOME_PICKS)} AS call_outcome,
               {pick(j, FX.ACS_CALL_TYPE_PICKS)} AS call_type,
               CAST({pick(j + ' // 4', FX.ACS_DURATION_PICKS)} AS DOUBLE) AS outreach_call_duration_c,
               ts AS date_created, ts AS date_activity,
               CASE WHEN ({j} // 4) % 3 = 0 THEN NULL ELSE {done} END AS completed_date_time,
               CAST({pick(j + ' // 16', FX.ACS_DELETED_PICKS)} AS INTEGER) AS is_deleted
        FROM events WHERE {ev} % 3 = 0"""))
    ctes.append(("s_edh_finance_calendar", """
        SELECT d AS date_key,
               'FY' || (year(d) + CASE WHEN month(d) >= 2 THEN 1 ELSE 0 END) AS fiscal_year_name,
               'Q' || (((month(d) + 10) % 12) // 3 + 1) AS fiscal_year_quarter_name,
               CAST(((month(d) + 10) % 12) % 3 + 1 AS DOUBLE) AS month_number_in_fiscal_quarter
        FROM (SELECT CAST(unnest(generate_series(make_date(year(lo) - 1, 1, 1), make_date(year(hi), 12, 31),
                                                 INTERVAL 1 DAY)) AS DATE) AS d
              FROM (SELECT min(d) AS lo, max(d) AS hi
                    FROM (SELECT CAST(o_orderdate AS DATE) AS d FROM orders
                          UNION ALL SELECT CAST(ts AS DATE) FROM events)))"""))
    return ctes
