"""DuckDB twin of every registered query (``oracle_sql()`` in the entry file).

Each entry is a final SELECT over the source and model CTEs; ``full_sql``
prefixes the CTEs.  Column names and types follow the Spark queries.
"""

from __future__ import annotations

from dimstar.plans import quality as Q
from oracle.models_sql import AS_OF, CLOSE_FROM, CLOSE_TO, LOOKBACK, REPORT_FROM, model_ctes
from oracle.sources_sql import in_list, source_ctes


def money(x: str) -> str:
    return f"CAST(CAST(round({x}, 6) AS DECIMAL(38,6)) AS DOUBLE)"


def ratio(n: str, d: str) -> str:
    return f"(CAST({n} AS DOUBLE) / NULLIF(CAST({d} AS DOUBLE), 0))"


F1, F2 = "m_fct_blended_opportunities", "m_fct_blended_opportunity_activities"
OPP_COUNT = "count(DISTINCT source_system || '|' || opportunity_number)"
F1_DOUBLES = ("* REPLACE (CAST(line_item_acv_usd AS DOUBLE) AS line_item_acv_usd, "
              "CAST(line_item_weighted_acv_usd AS DOUBLE) AS line_item_weighted_acv_usd)")

PIPELINE_METRICS = {
    "total_pipeline_acv_usd": money("sum(line_item_acv_usd)"),
    "total_weighted_pipeline_acv_usd": money("sum(line_item_weighted_acv_usd)"),
    "opportunity_count": OPP_COUNT,
    "line_item_quantity_total": "CAST(sum(quantity) AS DOUBLE)",
}
PIPELINE_METRICS["pipeline_confidence_ratio"] = \
    f"round({ratio('sum(line_item_weighted_acv_usd)', 'sum(line_item_acv_usd)')}, 9)"
PIPELINE_METRICS["acv_per_opportunity"] = f"round({ratio('sum(line_item_acv_usd)', OPP_COUNT)}, 9)"


def _isum(c: str) -> str:
    return f"CAST(sum({c}) AS BIGINT)"


ACTIVITY_METRICS = {
    "total_activities": "count(DISTINCT activity_id)",
    "outbound_call_attempts": _isum("call_attempt_outbound"),
    "outbound_calls_connected": _isum("call_connected_outbound"),
    "meetings_scheduled": _isum("meeting_scheduled"),
    "meetings_completed": _isum("meeting_completed"),
    "outbound_email_attempts": _isum("email_attempt_outbound"),
    "inbound_emails_received": _isum("email_received"),
    "total_call_duration_seconds": _isum("calldurationinseconds"),
}
ACTIVITY_METRICS["call_connect_rate"] = ratio(ACTIVITY_METRICS["outbound_calls_connected"],
                                              ACTIVITY_METRICS["outbound_call_attempts"])
ACTIVITY_METRICS["avg_call_duration_seconds"] = ratio(ACTIVITY_METRICS["total_call_duration_seconds"],
                                                      ACTIVITY_METRICS["outbound_call_attempts"])


def agg(table: str, keys: list[str], metrics: dict[str, str], names: list[str]) -> str:
    """GROUP BY over a model; ``keys`` are 'expr AS name' or plain names."""
    sel = keys + [f"{metrics[n]} AS {n}" for n in names]
    group = f" GROUP BY {', '.join(str(i + 1) for i in range(len(keys)))}" if keys else ""
    return f"SELECT {', '.join(sel)} FROM {table}{group}"


MART_TABLE = {
    "dim_date": "m_dim_date", "dim_unified_account": "m_dim_unified_account",
    "dim_unified_contact": "m_dim_unified_contact", "dim_unified_employee": "m_dim_unified_employee",
    "dim_unified_opportunity": "m_dim_unified_opportunity",
    "fct_blended_opportunities": F1, "fct_blended_opportunity_activities": F2,
}


def failing_sql(t: Q.DataTest) -> str:
    """Failing rows of one data test as (failing_key, n_records)."""
    tbl, col = MART_TABLE[t.model], t.column
    if t.kind == "unique":
        return (f"SELECT CAST({col} AS VARCHAR) AS failing_key, count(*) AS n_records FROM {tbl} "
                f"WHERE {col} IS NOT NULL GROUP BY {col} HAVING count(*) > 1")
    if t.kind == "not_null":
        return f"SELECT CAST(NULL AS VARCHAR) AS failing_key, CAST(1 AS BIGINT) AS n_records FROM {tbl} WHERE {col} IS NULL"
    if t.kind == "accepted_values":
        return (f"SELECT CAST({col} AS VARCHAR) AS failing_key, count(*) AS n_records FROM {tbl} "
                f"WHERE {col} NOT IN {in_list(t.values)} GROUP BY {col}")
    parent = MART_TABLE[t.to_model]
    return (f"SELECT CAST(c.{col} AS VARCHAR) AS failing_key, count(*) AS n_records FROM {tbl} c "
            f"WHERE c.{col} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{t.to_column} = c.{col}) "
            f"GROUP BY c.{col}")


def summary_sql(tests) -> str:
    # Orphans are listed by key; each of their records is a failure.
    return " UNION ALL ".join(
        f"SELECT '{t.name}' AS test_name, '{t.kind}' AS test_kind, '{t.severity}' AS severity, "
        f"{'CAST(COALESCE(sum(n_records), 0) AS BIGINT)' if t.kind == 'relationships' else 'count(*)'} AS failures, CAST(COALESCE(sum(n_records), 0) AS BIGINT) AS failing_records "
        f"FROM ({failing_sql(t)})" for t in tests)


def final_queries() -> dict[str, str]:
    q: dict[str, str] = {}
    q["dim_date"] = "SELECT * FROM m_dim_date"
    q["eligible_accounts"] = f"""
        SELECT account_csn, account_type, is_visible, account_category FROM s_edh_account
        WHERE account_type IN ('End Customer', 'Strategic Account', 'Government', 'A.D.N.') AND is_visible = 1
          AND COALESCE(account_category, '') NOT IN ('Internal', 'Partner')"""
    q["opportunities_in_window"] = f"""
        SELECT opportunity_number, opportunity_type,
               CAST(projected_close_date AS DATE) AS opportunity_projected_close_date
        FROM s_edh_opportunity
        WHERE opportunity_type = 'UnifiedOpportunity'
          AND CAST(projected_close_date AS DATE) BETWEEN {CLOSE_FROM} AND {CLOSE_TO}"""
    q["activities_recent"] = f"""
        SELECT 'EDH' AS source_system, task_id, CAST(source_created_ts AS DATE) AS activity_created_date
        FROM s_edh_opportunity_task
        WHERE task_status = 'Completed' AND source_created_ts >= {LOOKBACK}
          AND CAST(source_created_ts AS DATE) >= {REPORT_FROM}
        UNION ALL
        SELECT 'Construction', task_id, CAST(date_created AS DATE) FROM s_acs_task
        WHERE task_status = 'Completed' AND COALESCE(is_deleted, 0) = 0 AND date_created >= {LOOKBACK}
          AND CAST(date_created AS DATE) >= {REPORT_FROM}"""
    q["activities_bounced_null_semantics"] = """
        SELECT 'EDH' AS source_system, count(*) AS n_tasks,
               count(*) FILTER (WHERE COALESCE(sales_activity_subtype, 'Blank') != 'Email - Bounced') AS n_kept,
               count(*) FILTER (WHERE sales_activity_subtype IS NULL) AS n_null,
               count(*) FILTER (WHERE sales_activity_subtype IS NULL
                                  AND COALESCE(sales_activity_subtype, 'Blank') != 'Email - Bounced') AS n_null_kept
        FROM s_edh_opportunity_task
        UNION ALL
        SELECT 'Construction', count(*), count(*) FILTER (WHERE task_type != 'Email - Bounced'),
               count(*) FILTER (WHERE task_type IS NULL),
               count(*) FILTER (WHERE task_type IS NULL AND task_type != 'Email - Bounced')
        FROM s_acs_task"""
    q["open_deal_country_exclusion"] = """
        SELECT g.country IS NOT NULL AS country_matched, o.is_closed,
               COALESCE(NOT (g.country IS NOT NULL AND o.is_closed = 0), false) AS kept,
               count(*) AS n_opportunities
        FROM s_acs_opportunity o JOIN s_acs_account aa ON o.account_id = aa.account_id
        LEFT JOIN s_country_region_map g ON lower(COALESCE(o.shipping_country, aa.shipping_country)) = lower(g.country)
        GROUP BY 1, 2, 3"""
    q["latest_quote"] = "SELECT * FROM m_latest_quote"
    q["latest_fx_rate"] = ("SELECT from_currency_code, effective_start_date, "
                           "CAST(exchange_rate AS DOUBLE) AS exchange_rate FROM m_latest_fx")
    q["edh_opportunity_lines"] = f"SELECT {F1_DOUBLES} FROM m_edh_lines"
    q["acs_opportunity_lines"] = f"SELECT {F1_DOUBLES} FROM m_acs_lines"
    q["fx_converted_acv"] = """
        SELECT l.id AS line_item_number, l.currency_iso_code,
               CAST(l.est_annualized_amount_c AS DOUBLE) AS est_annualized_amount_c,
               CAST(fx.exchange_rate AS DOUBLE) AS exchange_rate,
               CAST(CAST(l.est_annualized_amount_c * fx.exchange_rate AS DECIMAL(28,8)) AS DOUBLE) AS line_item_acv_usd
        FROM s_acs_opportunity_line_item l LEFT JOIN m_latest_fx fx ON l.currency_iso_code = fx.from_currency_code
        WHERE l.is_deleted = 0"""
    q["weighted_pipeline_lines"] = f"""
        SELECT source_system, opportunity_number, line_item_number,
               CAST(line_item_acv_usd AS DOUBLE) AS line_item_acv_usd,
               CAST(line_item_weighted_acv_usd AS DOUBLE) AS line_item_weighted_acv_usd
        FROM {F1}"""
    q["fct_blended_opportunities"] = f"SELECT {F1_DOUBLES} FROM {F1}"
    q["edh_activities"] = f"SELECT * FROM m_edh_activities WHERE activity_created_date >= {REPORT_FROM}"
    q["construction_activities"] = f"SELECT * FROM m_construction_activities WHERE activity_created_date >= {REPORT_FROM}"
    q["fct_blended_opportunity_activities"] = f"SELECT * FROM {F2}"
    q["call_detail"] = f"""
        SELECT activity_id, source_system, calldisposition, calldurationinseconds, activity_created_timestamp,
               activity_completed_timestamp FROM {F2} WHERE new_activity_type = 'Call'"""
    q["activity_kpi_flags"] = f"""
        SELECT activity_id, source_system, new_activity_type, activity_type, activity_group, call_attempt_outbound,
               call_connected_outbound, meeting_scheduled, meeting_completed, email_attempt_outbound, email_received
        FROM {F2}"""
    q["activity_group_mix"] = agg(F2, ["source_system", "activity_group"], ACTIVITY_METRICS, ["total_activities"])
    q["dim_unified_account"] = ("SELECT * REPLACE (CAST(account_hierarchy_depth AS DOUBLE) AS account_hierarchy_depth) "
                                "FROM m_dim_unified_account")
    q["dim_unified_contact"] = "SELECT * FROM m_dim_unified_contact"
    q["dim_unified_employee"] = "SELECT * FROM m_dim_unified_employee"
    q["dim_unified_opportunity"] = ("SELECT * REPLACE (CAST(opportunity_stage_weight AS DOUBLE) AS "
                                    "opportunity_stage_weight) FROM m_dim_unified_opportunity")
    q["stage_funnel"] = """
        SELECT source_system, opportunity_stage, opportunity_stage_rank,
               CAST(opportunity_stage_weight AS DOUBLE) AS opportunity_stage_weight, count(*) AS n_opportunities
        FROM m_dim_unified_opportunity GROUP BY 1, 2, 3, 4"""
    q["partner_led_share"] = """
        SELECT source_system, is_partner_led, count(*) AS n_opportunities,
               CAST(count(*) AS DOUBLE) / CAST(sum(count(*)) OVER (PARTITION BY source_system) AS DOUBLE) AS share
        FROM m_dim_unified_opportunity GROUP BY 1, 2"""
    q["contact_domain_profile"] = """
        SELECT source_system, contact_email_domain, count(*) AS n_contacts FROM m_dim_unified_contact GROUP BY 1, 2"""
    q["conform_union_counts"] = " UNION ALL ".join(
        f"SELECT '{name}' AS model, source_system, count(*) AS n_rows FROM {MART_TABLE[name]} GROUP BY 2"
        for name in ("dim_unified_account", "dim_unified_contact", "dim_unified_employee", "dim_unified_opportunity",
                     "fct_blended_opportunities", "fct_blended_opportunity_activities"))
    q["star_opportunities"] = f"""
        SELECT f.{F1_DOUBLES}, o.opportunity_stage AS opportunity__opportunity_stage,
               a.account_segment AS account__account_segment, e.employee_name AS opportunity_owner__employee_name,
               d.fiscal_quarter AS close_date__fiscal_quarter
        FROM {F1} f
        LEFT JOIN m_dim_unified_opportunity o ON f.opportunity_number = o.opportunity_number
        LEFT JOIN m_dim_unified_account a ON f.account_csn = a.account_csn
        LEFT JOIN m_dim_unified_employee e ON f.opportunity_owner_id = e.employee_id
        LEFT JOIN m_dim_date d ON f.opportunity_projected_close_date = d.date_day"""
    q["star_activities"] = f"""
        SELECT f.activity_id, f.source_system, o.opportunity_stage AS opportunity__opportunity_stage,
               a.account_segment AS account__account_segment, e.employee_name AS owner__employee_name,
               c.contact_email_domain AS contact__contact_email_domain,
               d.fiscal_quarter_month AS created_date__fiscal_quarter_month
        FROM {F2} f
        LEFT JOIN m_dim_unified_opportunity o ON f.opportunity_number = o.opportunity_number
        LEFT JOIN m_dim_unified_account a ON f.account_csn = a.account_csn
        LEFT JOIN m_dim_unified_employee e ON f.ownerid = e.employee_id
        LEFT JOIN m_dim_unified_contact c ON f.account_contact_csn = c.contact_csn
        LEFT JOIN m_dim_date d ON f.activity_created_date = d.date_day"""
    for name in ("total_pipeline_acv_usd", "total_weighted_pipeline_acv_usd", "opportunity_count",
                 "pipeline_confidence_ratio"):
        q[f"m_{name}"] = agg(F1, ["source_system"], PIPELINE_METRICS, [name])
    for name in ("total_activities", "outbound_call_attempts", "outbound_calls_connected", "call_connect_rate",
                 "meetings_scheduled", "meetings_completed", "outbound_email_attempts", "inbound_emails_received",
                 "total_call_duration_seconds", "avg_call_duration_seconds"):
        q[f"m_{name}"] = agg(F2, ["source_system"], ACTIVITY_METRICS, [name])
    q["pipeline_by_month"] = agg(
        F1, ["CAST(date_trunc('month', opportunity_projected_close_date) AS DATE) AS metric_time__month"],
        PIPELINE_METRICS, ["total_pipeline_acv_usd", "total_weighted_pipeline_acv_usd", "opportunity_count"])
    q["activities_by_week"] = agg(
        F2, ["CAST(date_trunc('week', activity_created_date) AS DATE) AS metric_time__week", "source_system"],
        ACTIVITY_METRICS, ["total_activities", "outbound_call_attempts"])
    q["pipeline_by_segment"] = agg(F1, ["focus_segment_group", "license_type"], PIPELINE_METRICS,
                                   ["total_pipeline_acv_usd", "line_item_quantity_total", "opportunity_count"])
    q["activities_by_type"] = agg(F2, ["new_activity_type", "activity_type", "activity_group"], ACTIVITY_METRICS,
                                  ["total_activities", "meetings_completed", "total_call_duration_seconds"])
    q["pipeline_by_account_segment"] = f"""
        SELECT a.account_segment AS account__account_segment,
               {money('sum(f.line_item_acv_usd)')} AS total_pipeline_acv_usd,
               count(DISTINCT f.source_system || '|' || f.opportunity_number) AS opportunity_count
        FROM {F1} f LEFT JOIN m_dim_unified_account a ON f.account_csn = a.account_csn
        GROUP BY 1 ORDER BY 2 DESC NULLS LAST"""
    q["pipeline_by_partner_account"] = f"""
        SELECT a.account_segment AS partner_account__account_segment, f.source_system,
               {money('sum(f.line_item_acv_usd)')} AS total_pipeline_acv_usd,
               count(DISTINCT f.source_system || '|' || f.opportunity_number) AS opportunity_count
        FROM {F1} f LEFT JOIN m_dim_unified_account a ON f.partner_csn = a.account_csn
        GROUP BY 1, 2"""
    q["pipeline_by_account_owner"] = f"""
        SELECT e.sales_role AS account_owner__sales_role, f.source_system,
               {money('sum(f.line_item_weighted_acv_usd)')} AS total_weighted_pipeline_acv_usd,
               count(DISTINCT f.source_system || '|' || f.opportunity_number) AS opportunity_count
        FROM {F1} f LEFT JOIN m_dim_unified_employee e ON f.account_owner_id = e.employee_id
        GROUP BY 1, 2"""
    q["activity_scorecard"] = agg(F2, ["source_system", "activity_group"], ACTIVITY_METRICS, [
        "total_activities", "outbound_call_attempts", "outbound_calls_connected", "call_connect_rate",
        "meetings_scheduled", "meetings_completed", "outbound_email_attempts", "inbound_emails_received",
        "total_call_duration_seconds", "avg_call_duration_seconds"])
    q["saved_quarterly_pipeline"] = f"""
        SELECT metric_time__quarter, account__account_segment, {money('acv')} AS total_pipeline_acv_usd,
               {money('weighted')} AS total_weighted_pipeline_acv_usd, n AS opportunity_count,
               round({ratio('weighted', 'acv')}, 9) AS pipeline_confidence_ratio, round({ratio('acv', 'n')}, 9) AS acv_per_opportunity
        FROM (
          SELECT CAST(date_trunc('quarter', f.opportunity_projected_close_date) AS DATE) AS metric_time__quarter,
                 a.account_segment AS account__account_segment, sum(f.line_item_acv_usd) AS acv,
                 sum(f.line_item_weighted_acv_usd) AS weighted,
                 count(DISTINCT f.source_system || '|' || f.opportunity_number) AS n
          FROM {F1} f JOIN m_dim_unified_account a ON f.account_csn = a.account_csn
          WHERE a.account_segment IS NOT NULL GROUP BY 1, 2)
        ORDER BY 1, 3 DESC NULLS LAST"""
    q["adhoc_region_month"] = f"""
        SELECT a.account_region,
               CAST(date_trunc('month', f.opportunity_projected_close_date) AS DATE) AS close_month,
               {money('sum(f.line_item_acv_usd)')} AS total_acv_usd,
               CAST(sum(f.quantity) AS DOUBLE) AS total_quantity
        FROM {F1} f LEFT JOIN m_dim_unified_account a ON f.account_csn = a.account_csn
        WHERE f.opportunity_projected_close_date >= {CLOSE_FROM}
        GROUP BY 1, 2 ORDER BY 1, 2"""
    q["dq_line_grain"] = f"""
        SELECT source_system, CAST(sum(n) AS BIGINT) AS n_rows,
               CAST(COALESCE(sum(CASE WHEN k IS NULL THEN n END), 0) AS BIGINT) AS n_null_key,
               count(k) AS n_distinct_key, count(CASE WHEN k IS NOT NULL AND n > 1 THEN 1 END) AS n_repeated_key
        FROM (SELECT source_system, source_system || '|' || opportunity_number || '|' || line_item_number AS k,
                     count(*) AS n
              FROM {F1} GROUP BY 1, 2)
        GROUP BY 1"""
    q["activities_daily_gapfilled"] = f"""
        SELECT s.d AS metric_time__day, COALESCE(x.total_activities, 0) AS total_activities,
               COALESCE(x.outbound_call_attempts, 0) AS outbound_call_attempts
        FROM (SELECT CAST(unnest(generate_series({REPORT_FROM}, {AS_OF}, INTERVAL 1 DAY)) AS DATE) AS d) s
        LEFT JOIN ({agg(F2, ['activity_created_date AS day'], ACTIVITY_METRICS,
                        ['total_activities', 'outbound_call_attempts'])}) x ON s.d = x.day"""
    q["pipeline_cumulative_by_month"] = f"""
        SELECT source_system, close_month, {money('acv')} AS monthly_acv_usd,
               {money('sum(acv) OVER (PARTITION BY source_system ORDER BY close_month '
                      'ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)')} AS cumulative_acv_usd
        FROM (SELECT source_system,
                     CAST(date_trunc('month', opportunity_projected_close_date) AS DATE) AS close_month,
                     sum(line_item_acv_usd) AS acv
              FROM {F1} GROUP BY 1, 2)"""
    q["acv_per_opportunity"] = agg(F1, ["source_system"], PIPELINE_METRICS,
                                   ["total_pipeline_acv_usd", "opportunity_count", "acv_per_opportunity"])
    q["pipeline_vs_activity_by_account"] = f"""
        SELECT COALESCE(p.account_csn, a.account_csn) AS account_csn, p.total_pipeline_acv_usd, p.opportunity_count,
               a.total_activities
        FROM ({agg(F1, ['account_csn'], PIPELINE_METRICS, ['total_pipeline_acv_usd', 'opportunity_count'])}) p
        FULL OUTER JOIN ({agg(F2, ['account_csn'], ACTIVITY_METRICS, ['total_activities'])}) a
          ON p.account_csn IS NOT DISTINCT FROM a.account_csn"""
    q["activities_by_account_segment"] = f"""
        SELECT a.account_segment AS account__account_segment, count(DISTINCT f.activity_id) AS total_activities
        FROM {F2} f LEFT JOIN m_dim_unified_account a ON f.account_csn = a.account_csn
        GROUP BY 1"""
    q["open_pipeline_by_account_segment"] = f"""
        SELECT a.account_segment AS account__account_segment, o.opportunity_stage AS opportunity__opportunity_stage,
               {money('sum(f.line_item_acv_usd)')} AS total_pipeline_acv_usd,
               count(DISTINCT f.source_system || '|' || f.opportunity_number) AS opportunity_count
        FROM {F1} f LEFT JOIN m_dim_unified_account a ON f.account_csn = a.account_csn
        LEFT JOIN m_dim_unified_opportunity o ON f.opportunity_number = o.opportunity_number
        WHERE o.opportunity_stage NOT IN ('Won', 'Lost')
        GROUP BY 1, 2"""
    q["pipeline_running_by_month"] = f"""
        SELECT s.d AS metric_time__month, {money('COALESCE(acv, 0)')} AS total_pipeline_acv_usd,
               {money('sum(COALESCE(acv, 0)) OVER (ORDER BY s.d)')} AS cumulative_pipeline_acv_usd,
               {money('sum(COALESCE(acv, 0)) OVER (ORDER BY s.d ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)')}
                 AS trailing_3_pipeline_acv_usd
        FROM (SELECT CAST(unnest(generate_series(date_trunc('month', {CLOSE_FROM}), {CLOSE_TO} + INTERVAL 6 MONTH,
                                                 INTERVAL 1 MONTH)) AS DATE) AS d) s
        LEFT JOIN (SELECT CAST(date_trunc('month', opportunity_projected_close_date) AS DATE) AS d,
                          sum(line_item_acv_usd) AS acv FROM {F1} GROUP BY 1) x ON x.d = s.d"""
    by_month = "CAST(date_trunc('month', f.opportunity_projected_close_date) AS DATE)"
    number = "count(DISTINCT f.source_system || '|' || f.opportunity_number)"

    def within(value: str, since: str) -> str:
        return f"""COALESCE((SELECT {value} FROM {F1} f WHERE f.source_system = k.source_system
                   AND {by_month} >= {since} AND {by_month} <= s.d), 0)"""

    start, three = f"date_trunc('month', {CLOSE_FROM})", f"greatest(date_trunc('month', {CLOSE_FROM}), s.d - INTERVAL 2 MONTH)"
    q["opportunities_running_by_month"] = f"""
        SELECT s.d AS metric_time__month, k.source_system,
               {within(number, 's.d')} AS opportunity_count,
               {within(number, start)} AS cumulative_opportunity_count,
               {within(number, three)} AS trailing_3_opportunity_count,
               {money(within('sum(f.line_item_acv_usd)', start))} AS cumulative_pipeline_acv_usd,
               {money(within('sum(f.line_item_acv_usd)', three))} AS trailing_3_pipeline_acv_usd
        FROM (SELECT CAST(unnest(generate_series(date_trunc('month', {CLOSE_FROM}), {CLOSE_TO} + INTERVAL 6 MONTH,
                                                 INTERVAL 1 MONTH)) AS DATE) AS d) s,
             (SELECT DISTINCT source_system FROM {F1}) k"""
    weeks = f"""SELECT DISTINCT activity_id, new_activity_type, CAST(date_trunc('week', activity_created_date) AS DATE) AS w
                FROM {F2}"""
    q["activities_trailing_by_week"] = f"""
        SELECT * FROM (WITH ids AS ({weeks}), series AS (SELECT DISTINCT w, new_activity_type FROM ids)
        SELECT s.w AS metric_time__week, s.new_activity_type,
               count(DISTINCT CASE WHEN i.w = s.w THEN i.activity_id END) AS total_activities,
               count(DISTINCT i.activity_id) AS cumulative_activities,
               count(DISTINCT CASE WHEN i.w > s.w - INTERVAL 4 WEEK THEN i.activity_id END) AS trailing_4_activities
        FROM series s JOIN ids i ON i.new_activity_type IS NOT DISTINCT FROM s.new_activity_type AND i.w <= s.w
        GROUP BY 1, 2)"""
    q["pipeline_vs_calls_filtered"] = f"""
        SELECT * FROM (WITH p AS (SELECT a.account_segment AS seg, {money('sum(f.line_item_acv_usd)')} AS acv, {number} AS n
                   FROM {F1} f LEFT JOIN m_dim_unified_account a ON f.account_csn = a.account_csn
                   WHERE f.quantity > 1 AND a.account_segment IS NOT NULL AND f.source_system <> 'none' GROUP BY 1),
             x AS (SELECT a.account_segment AS seg, count(DISTINCT f.activity_id) AS n,
                          CAST(sum(f.call_attempt_outbound) AS BIGINT) AS calls
                   FROM {F2} f LEFT JOIN m_dim_unified_account a ON f.account_csn = a.account_csn
                   WHERE f.new_activity_type IN ('Call', 'Meeting') AND a.account_segment IS NOT NULL
                     AND f.source_system <> 'none' GROUP BY 1)
        SELECT COALESCE(p.seg, x.seg) AS account__account_segment, p.acv AS total_pipeline_acv_usd,
               p.n AS opportunity_count, x.n AS total_activities, x.calls AS outbound_call_attempts
        FROM p FULL OUTER JOIN x ON p.seg IS NOT DISTINCT FROM x.seg)"""
    q["dq_unique"] = summary_sql(Q.UNIQUE_TESTS)
    q["dq_not_null"] = summary_sql(Q.NOT_NULL_TESTS)
    q["dq_accepted_values"] = summary_sql(Q.ACCEPTED_TESTS)
    q["dq_relationships_pipeline"] = summary_sql(Q.PIPELINE_REL_TESTS)
    q["dq_relationships_activities"] = summary_sql(Q.ACTIVITY_REL_TESTS)
    q["dq_failure_log"] = " UNION ALL ".join(
        f"SELECT '{t.name}' AS test_name, '{t.severity}' AS severity, failing_key, n_records FROM ({failing_sql(t)})"
        for t in Q.ALL_TESTS)
    q["publish_roundtrip"] = q["fct_blended_opportunities"]
    q["dq_coverage"] = " UNION ALL ".join(
        f"SELECT '{name}' AS model, (SELECT count(*) FROM {tbl}) AS transform_rows, "
        f"(SELECT count(*) FROM {tbl}) AS publish_rows" for name, tbl in MART_TABLE.items())
    fresh = (("edh_opportunity", "s_edh_opportunity", "source_created_ts"),
             ("edh_opportunity_task", "s_edh_opportunity_task", "source_created_ts"),
             ("acs_opportunity", "s_acs_opportunity", "created_date"),
             ("acs_task", "s_acs_task", "date_created"))
    q["dq_freshness"] = " UNION ALL ".join(
        f"SELECT '{name}' AS source, max({col}) AS latest, "
        f"CAST(date_diff('day', CAST(max({col}) AS DATE), {AS_OF}) AS INTEGER) AS age_days FROM {tbl}"
        for name, tbl, col in fresh)
    q["dq_parity"] = f"""
        SELECT source_system, count(*) AS transform_rows, count(*) AS publish_rows,
               {money('sum(line_item_acv_usd)')} AS transform_acv_usd,
               {money('sum(line_item_acv_usd)')} AS publish_acv_usd, true AS is_equal
        FROM {F1} GROUP BY 1"""
    return q


def full_sql(final: str) -> str:
    ctes = source_ctes() + model_ctes()
    body = ",\n".join(f"{name} AS ({sql})" for name, sql in ctes)
    return f"WITH {body}\n{final}"


def oracle_sql() -> dict[str, str]:
    return {name: full_sql(sql) for name, sql in final_queries().items()}
