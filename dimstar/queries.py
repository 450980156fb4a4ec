"""

Every query takes ``(spark, sf_dir)``, derives the CRM sources from the
test tables under ``sf_dir`` and returns a lazy DataFrame.  Money columns
are kept as exact decimals inside the jobs and handed out as doubles.
"""

from __future__ import annotations

import datetime as dt
import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from dimstar.functions import rules as R
from dimstar.params import TEST_PARAMS, Params
from dimstar.plans import activities as A
from dimstar.plans import dims as D
from dimstar.plans import opportunity_lines as P
from dimstar.plans import quality as Q
from dimstar.plans.metrics import metric_query, money
from dimstar.plans.publish import register_views, write_counted, write_tables
from dimstar.plans.saved import SAVED_QUERIES
from dimstar.plans.star import ACTIVITY_EDGES, PIPELINE_EDGES, star_join
from dimstar.session import ensure_checkpoint_dir
from dimstar.sources import Sources
from dimstar.sources.fixture import fixture_sources

QueryFn = Callable[[SparkSession, str], DataFrame]
F1, F2 = "fct_blended_opportunities", "fct_blended_opportunity_activities"
REGISTRY: dict[str, QueryFn] = {}


MartFn = Callable[[dict[str, DataFrame]], DataFrame]
MART_QUERIES: dict[str, MartFn] = {}


def query(fn: QueryFn) -> QueryFn:
    REGISTRY[fn.__name__] = fn
    return fn


def mart_query(fn: MartFn) -> MartFn:
    """A query over the published models only: registered as (spark, sf_dir) -> marts -> fn."""
    MART_QUERIES[fn.__name__] = fn

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(_marts(spark, sf_dir))

    run.__name__ = fn.__name__
    REGISTRY[fn.__name__] = run
    return fn


def to_doubles(df: DataFrame) -> DataFrame:
    """Decimal columns to double (exact decimals inside, doubles at the edge)."""
    return df.select(*[F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, DecimalType)
                       else F.col(f.name) for f in df.schema.fields])


def _session_key(spark: SparkSession) -> tuple[str, str]:
    """A name for the session that no later one gets: the application and a token kept in the session itself."""
    token = spark.conf.get("spark.dimstar.session.token", None)
    if token is None:
        token = uuid.uuid4().hex
        spark.conf.set("spark.dimstar.session.token", token)
    return spark.sparkContext.applicationId, token


_SOURCES: dict[tuple[tuple[str, str], str], Sources] = {}


def _ctx(spark: SparkSession, sf_dir: str, params: Params = TEST_PARAMS) -> tuple[Sources, Params]:
    """Sources for ``sf_dir``, built once per session (lazy plans, safe to share)."""
    key = (_session_key(spark), sf_dir)
    if key not in _SOURCES:
        _SOURCES[key] = fixture_sources(spark, sf_dir)
    return _SOURCES[key], params


_MARTS: dict[tuple[tuple[str, str], str], dict[str, DataFrame]] = {}


def _marts(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The marts for ``sf_dir`` with the test parameters, planned once per session."""
    key = (_session_key(spark), sf_dir)
    if key not in _MARTS:
        src, p = _ctx(spark, sf_dir)
        _MARTS[key] = marts(src, p)
    return dict(_MARTS[key])


def marts(src: Sources, params: Params, materialize: bool = False) -> dict[str, DataFrame]:
    """The seven published models (lazy, unless ``materialize`` cuts F1's parent side)."""
    return {
        "dim_date": D.dim_date(src),
        "dim_unified_account": D.dim_unified_account(src),
        "dim_unified_contact": D.dim_unified_contact(src),
        "dim_unified_employee": D.dim_unified_employee(src),
        "dim_unified_opportunity": D.dim_unified_opportunity(src, params),
        "fct_blended_opportunities": P.fct_blended_opportunities(src, params, materialize),
        "fct_blended_opportunity_activities": A.fct_blended_opportunity_activities(src, params),
    }


def star_dims(m: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {"opportunity": m["dim_unified_opportunity"], "account": m["dim_unified_account"],
            "employee": m["dim_unified_employee"], "contact": m["dim_unified_contact"], "date": m["dim_date"]}


def _f1(spark, sf_dir):
    return _marts(spark, sf_dir)[F1]


def _f2(spark, sf_dir):
    return _marts(spark, sf_dir)[F2]


def _storage_root(spark: SparkSession) -> str:
    return ensure_checkpoint_dir(spark).rstrip("/")


# --------------------------------------------------------------------------- sources, filters, windows

@query
def dim_date(spark, sf_dir):
    src, _ = _ctx(spark, sf_dir)
    return D.dim_date(src)


@query
def eligible_accounts(spark, sf_dir):
    src, _ = _ctx(spark, sf_dir)
    return P.eligible_accounts(src).select("account_csn", "account_type", "is_visible", "account_category")


@query
def opportunities_in_window(spark, sf_dir):
    src, p = _ctx(spark, sf_dir)
    return P.opportunities_in_window(src, p).select(
        "opportunity_number", "opportunity_type",
        F.col("projected_close_date").cast("date").alias("opportunity_projected_close_date"))


def _recent_tasks(src: Sources, p: Params) -> DataFrame:
    edh = src.edh_opportunity_task.where(
        (F.col("task_status") == "Completed") & A._recent("source_created_ts", p)
    ).select(F.lit(R.ACTIVITY_EDH).alias("source_system"), F.col("task_id"),
             F.col("source_created_ts").cast("date").alias("activity_created_date"))
    acs = src.acs_task.where(
        (F.col("task_status") == "Completed") & (F.coalesce(F.col("is_deleted"), F.lit(0)) == 0)
        & A._recent("date_created", p)
    ).select(F.lit(R.ACTIVITY_ACS).alias("source_system"), F.col("task_id"),
             F.col("date_created").cast("date").alias("activity_created_date"))
    return edh.unionByName(acs)


@query
def activities_recent(spark, sf_dir):
    """Completed, not deleted tasks inside the look-back and on/after the floor."""
    src, p = _ctx(spark, sf_dir)
    return _recent_tasks(src, p)


@query
def activities_bounced_null_semantics(spark, sf_dir):
    """EDH keeps a NULL sub-type, Construction drops a NULL type."""
    src, _ = _ctx(spark, sf_dir)
    edh_v, acs_v = F.col("sales_activity_subtype"), F.col("task_type")
    edh = src.edh_opportunity_task.groupBy(F.lit(R.ACTIVITY_EDH).alias("source_system")).agg(
        F.count(F.lit(1)).alias("n_tasks"),
        F.count(F.when(F.coalesce(edh_v, F.lit("Blank")) != R.BOUNCED, 1)).alias("n_kept"),
        F.count(F.when(edh_v.isNull(), 1)).alias("n_null"),
        F.count(F.when(edh_v.isNull() & (F.coalesce(edh_v, F.lit("Blank")) != R.BOUNCED), 1)).alias("n_null_kept"),
    )
    acs = src.acs_task.groupBy(F.lit(R.ACTIVITY_ACS).alias("source_system")).agg(
        F.count(F.lit(1)).alias("n_tasks"),
        F.count(F.when(acs_v != R.BOUNCED, 1)).alias("n_kept"),
        F.count(F.when(acs_v.isNull(), 1)).alias("n_null"),
        F.count(F.when(acs_v.isNull() & (acs_v != R.BOUNCED), 1)).alias("n_null_kept"),
    )
    return edh.unionByName(acs)


@query
def open_deal_country_exclusion(spark, sf_dir):
    """Screened ACS deals by country match and closed flag, kept or not."""
    src, p = _ctx(spark, sf_dir)
    geo = src.country_region_map.select(F.col("country").alias("geo_country"))
    acct = src.acs_account.select(F.col("account_id").alias("a_id"), F.col("shipping_country").alias("a_country"))
    rows = (src.acs_opportunity.join(acct, F.col("account_id") == F.col("a_id"), "inner")
            .join(geo, F.lower(F.coalesce(F.col("shipping_country"), F.col("a_country")))
                  == F.lower(F.col("geo_country")), "left"))
    kept = ~(F.col("geo_country").isNotNull() & (F.col("is_closed") == 0))
    return rows.groupBy(
        F.col("geo_country").isNotNull().alias("country_matched"), "is_closed",
        F.coalesce(kept, F.lit(False)).alias("kept"),
    ).agg(F.count(F.lit(1)).alias("n_opportunities"))


@query
def latest_quote(spark, sf_dir):
    src, _ = _ctx(spark, sf_dir)
    return P.latest_quote(src)


@query
def latest_fx_rate(spark, sf_dir):
    src, _ = _ctx(spark, sf_dir)
    return to_doubles(P.latest_fx_rate(src))


# --------------------------------------------------------------------------- facts and their parts

@query
def edh_opportunity_lines(spark, sf_dir):
    src, p = _ctx(spark, sf_dir)
    return to_doubles(P.edh_opportunity_lines(src, p))


@query
def acs_opportunity_lines(spark, sf_dir):
    src, p = _ctx(spark, sf_dir)
    return to_doubles(P.acs_opportunity_lines(src, p))


@query
def fx_converted_acv(spark, sf_dir):
    """Every live ACS line converted at its currency's latest rate (NULL without rate)."""
    src, _ = _ctx(spark, sf_dir)
    fx = P.latest_fx_rate(src).select(F.col("from_currency_code").alias("fx_currency"), "exchange_rate")
    lines = src.acs_opportunity_line_item.where(F.col("is_deleted") == 0) \
        .join(fx, F.col("currency_iso_code") == F.col("fx_currency"), "left")
    return to_doubles(lines.select(
        F.col("id").alias("line_item_number"), "currency_iso_code", "est_annualized_amount_c", "exchange_rate",
        (F.col("est_annualized_amount_c") * F.col("exchange_rate")).cast(P.ACV).alias("line_item_acv_usd"),
    ))


@query
def weighted_pipeline_lines(spark, sf_dir):
    """Stage-weighted ACV per line."""
    return to_doubles(_f1(spark, sf_dir).select(
        "source_system", "opportunity_number", "line_item_number", "line_item_acv_usd", "line_item_weighted_acv_usd"))


@query
def fct_blended_opportunities(spark, sf_dir):
    return to_doubles(_f1(spark, sf_dir))


@query
def edh_activities(spark, sf_dir):
    src, p = _ctx(spark, sf_dir)
    return A.edh_activities(src, p)


@query
def construction_activities(spark, sf_dir):
    src, p = _ctx(spark, sf_dir)
    return A.construction_activities(src, p)


@query
def fct_blended_opportunity_activities(spark, sf_dir):
    return _f2(spark, sf_dir)


@mart_query
def call_detail(m):
    """R17/R18 on calls."""
    return m[F2].where(F.col("new_activity_type") == "Call").select(
        "activity_id", "source_system", "calldisposition", "calldurationinseconds",
        "activity_created_timestamp", "activity_completed_timestamp")


@mart_query
def activity_kpi_flags(m):
    """R19-R24 per activity."""
    return m[F2].select("activity_id", "source_system", "new_activity_type", "activity_type",
                                     "activity_group", *A.FLAGS)


@mart_query
def activity_group_mix(m):
    return metric_query(m[F2], ["total_activities"], ["source_system", "activity_group"])


# --------------------------------------------------------------------------- dimensions

@query
def dim_unified_account(spark, sf_dir):
    src, _ = _ctx(spark, sf_dir)
    return to_doubles(D.dim_unified_account(src))


@query
def dim_unified_contact(spark, sf_dir):
    src, _ = _ctx(spark, sf_dir)
    return D.dim_unified_contact(src)


@query
def dim_unified_employee(spark, sf_dir):
    src, _ = _ctx(spark, sf_dir)
    return D.dim_unified_employee(src)


@query
def dim_unified_opportunity(spark, sf_dir):
    src, p = _ctx(spark, sf_dir)
    return to_doubles(D.dim_unified_opportunity(src, p))


@mart_query
def stage_funnel(m):
    """Opportunities per normalised stage, rank and weight."""
    return m["dim_unified_opportunity"].groupBy(
        "source_system", "opportunity_stage", "opportunity_stage_rank",
        F.col("opportunity_stage_weight").cast("double").alias("opportunity_stage_weight"),
    ).agg(F.count(F.lit(1)).alias("n_opportunities"))


@mart_query
def partner_led_share(m):
    """Partner-led flag counts and share within each source system."""
    counts = m["dim_unified_opportunity"].groupBy("source_system", "is_partner_led") \
        .agg(F.count(F.lit(1)).alias("n_opportunities"))
    total = F.sum("n_opportunities").over(Window.partitionBy("source_system"))
    return counts.select("*", (F.col("n_opportunities") / total.cast("double")).alias("share"))


@mart_query
def contact_domain_profile(m):
    """Contacts per mail domain."""
    return m["dim_unified_contact"].groupBy("source_system", "contact_email_domain") \
        .agg(F.count(F.lit(1)).alias("n_contacts"))


@mart_query
def conform_union_counts(m):
    """Rows per source system in every conformed output."""
    parts = [m[name].groupBy(F.lit(name).alias("model"), "source_system").agg(F.count(F.lit(1)).alias("n_rows"))
             for name in ("dim_unified_account", "dim_unified_contact", "dim_unified_employee",
                          "dim_unified_opportunity", "fct_blended_opportunities",
                          "fct_blended_opportunity_activities")]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


# --------------------------------------------------------------------------- star and metrics

@mart_query
def star_opportunities(m):
    out = star_join(m["fct_blended_opportunities"], star_dims(m), PIPELINE_EDGES, {
        "opportunity": ["opportunity_stage"], "account": ["account_segment"],
        "opportunity_owner": ["employee_name"], "close_date": ["fiscal_quarter"],
    })
    return to_doubles(out)


@mart_query
def star_activities(m):
    out = star_join(m["fct_blended_opportunity_activities"], star_dims(m), ACTIVITY_EDGES, {
        "opportunity": ["opportunity_stage"], "account": ["account_segment"], "owner": ["employee_name"],
        "contact": ["contact_email_domain"], "created_date": ["fiscal_quarter_month"],
    })
    return out.select("activity_id", "source_system", "opportunity__opportunity_stage", "account__account_segment",
                      "owner__employee_name", "contact__contact_email_domain", "created_date__fiscal_quarter_month")


def _metric_by_system(name: str, fact: str):
    def fn(m):
        return metric_query(m[F1] if fact == "p" else m[F2], [name], ["source_system"])
    fn.__name__ = f"m_{name}"
    return mart_query(fn)


for _name in ("total_pipeline_acv_usd", "total_weighted_pipeline_acv_usd", "opportunity_count",
              "pipeline_confidence_ratio"):
    _metric_by_system(_name, "p")
for _name in ("total_activities", "outbound_call_attempts", "outbound_calls_connected", "call_connect_rate",
              "meetings_scheduled", "meetings_completed", "outbound_email_attempts", "inbound_emails_received",
              "total_call_duration_seconds", "avg_call_duration_seconds"):
    _metric_by_system(_name, "a")


@mart_query
def pipeline_by_month(m):
    return metric_query(m[F1],
                        ["total_pipeline_acv_usd", "total_weighted_pipeline_acv_usd", "opportunity_count"],
                        ["metric_time__month"])


@mart_query
def activities_by_week(m):
    return metric_query(m[F2], ["total_activities", "outbound_call_attempts"],
                        ["metric_time__week", "source_system"])


@mart_query
def pipeline_by_segment(m):
    return metric_query(m[F1],
                        ["total_pipeline_acv_usd", "line_item_quantity_total", "opportunity_count"],
                        ["focus_segment_group", "license_type"])


@mart_query
def activities_by_type(m):
    return metric_query(m[F2], ["total_activities", "meetings_completed", "total_call_duration_seconds"],
                        ["new_activity_type", "activity_type", "activity_group"])


@mart_query
def pipeline_by_account_segment(m):
    return metric_query(m["fct_blended_opportunities"], ["total_pipeline_acv_usd", "opportunity_count"],
                        ["account__account_segment"], dims=star_dims(m), order_by=["-total_pipeline_acv_usd"])


@mart_query
def pipeline_by_partner_account(m):
    return metric_query(m["fct_blended_opportunities"], ["total_pipeline_acv_usd", "opportunity_count"],
                        ["partner_account__account_segment", "source_system"], dims=star_dims(m))


@mart_query
def pipeline_by_account_owner(m):
    return metric_query(m["fct_blended_opportunities"], ["total_weighted_pipeline_acv_usd", "opportunity_count"],
                        ["account_owner__sales_role", "source_system"], dims=star_dims(m))


def facts_of(m: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {"blended_opportunities": m[F1], "blended_opportunity_activities": m[F2]}


@mart_query
def activity_scorecard(m):
    """X4 saved query: every activity metric by system and group."""
    return SAVED_QUERIES["activity_scorecard"].run(facts_of(m), star_dims(m))


@mart_query
def saved_quarterly_pipeline(m):
    """X4 saved query with a filter on a dimension, a ratio, a derived metric and an order."""
    return SAVED_QUERIES["quarterly_pipeline"].run(facts_of(m), star_dims(m))


@mart_query
def adhoc_region_month(m):
    """A9/O1 ad-hoc SQL over the marts registered as views."""
    spark, p = m[F1].sparkSession, TEST_PARAMS
    views = register_views({k: m[k] for k in (F1, "dim_unified_account")}, suffix=f"_{uuid.uuid4().hex[:8]}")
    fct, acct = views[F1], views["dim_unified_account"]
    return spark.sql(f"""
        SELECT a.account_region,
               CAST(date_trunc('month', f.opportunity_projected_close_date) AS DATE) AS close_month,
               CAST(CAST(ROUND(SUM(f.line_item_acv_usd), 6) AS DECIMAL(38,6)) AS DOUBLE) AS total_acv_usd,
               CAST(SUM(f.quantity) AS DOUBLE) AS total_quantity
        FROM {fct} f
        LEFT JOIN {acct} a ON f.account_csn = a.account_csn
        WHERE f.opportunity_projected_close_date >= DATE'{p.close_from.isoformat()}'
        GROUP BY 1, 2
        ORDER BY 1, 2
    """)


@mart_query
def dq_line_grain(m):
    """The composite line key per system: rows, NULL keys, distinct and repeated keys."""
    f = m[F1]
    key = F.concat(F.col("source_system"), F.lit("|"), F.col("opportunity_number"), F.lit("|"),
                   F.col("line_item_number"))
    per_key = f.groupBy("source_system", key.alias("k")).agg(F.count(F.lit(1)).alias("n"))
    return per_key.groupBy("source_system").agg(
        F.sum("n").cast("bigint").alias("n_rows"),
        F.coalesce(F.sum(F.when(F.col("k").isNull(), F.col("n"))), F.lit(0)).cast("bigint").alias("n_null_key"),
        F.count("k").alias("n_distinct_key"),
        F.count(F.when(F.col("k").isNotNull() & (F.col("n") > 1), 1)).alias("n_repeated_key"),
    )


@query
def activities_daily_gapfilled(spark, sf_dir):
    """One row per day of the reporting period, 0 where nothing happened."""
    src, p = _ctx(spark, sf_dir)
    days = D.time_spine(spark, p).where(F.col("date_day").between(F.lit(p.report_from), F.lit(p.as_of)))
    return metric_query(A.fct_blended_opportunity_activities(src, p), ["total_activities", "outbound_call_attempts"],
                        ["metric_time__day"], spine=days)


@mart_query
def pipeline_cumulative_by_month(m):
    """Running ACV total by close month within each source system."""
    f = m[F1]
    monthly = f.groupBy("source_system",
                        F.date_trunc("month", "opportunity_projected_close_date").cast("date").alias("close_month")) \
        .agg(F.sum("line_item_acv_usd").alias("acv"))
    w = Window.partitionBy("source_system").orderBy("close_month").rowsBetween(Window.unboundedPreceding, 0)
    return monthly.select("source_system", "close_month", money(F.col("acv")).alias("monthly_acv_usd"),
                          money(F.sum("acv").over(w)).alias("cumulative_acv_usd"))


@mart_query
def acv_per_opportunity(m):
    """X3 derived metric."""
    return metric_query(m[F1], ["total_pipeline_acv_usd", "opportunity_count", "acv_per_opportunity"],
                        ["source_system"])


@mart_query
def pipeline_vs_activity_by_account(m):
    """Metrics of both facts in one request, each aggregated by account first."""
    return metric_query({"blended_opportunities": m[F1], "blended_opportunity_activities": m[F2]},
                        ["total_pipeline_acv_usd", "opportunity_count", "total_activities"], ["account_csn"])


@mart_query
def activities_by_account_segment(m):
    """A distinct count alone, by an attribute of a dimension."""
    return metric_query(m[F2], ["total_activities"], ["account__account_segment"], dims=star_dims(m))


@mart_query
def open_pipeline_by_account_segment(m):
    """A filter on an attribute of a dimension."""
    return metric_query(m[F1], ["total_pipeline_acv_usd", "opportunity_count"],
                        ["account__account_segment", "opportunity__opportunity_stage"], dims=star_dims(m),
                        where="opportunity__opportunity_stage NOT IN ('Won', 'Lost')")


@query
def pipeline_running_by_month(spark, sf_dir):
    """Running and trailing totals over a gap-free series that goes half a year past the window."""
    src, p = _ctx(spark, sf_dir)
    half_year_on = p.close_to + dt.timedelta(days=181)
    days = D.time_spine(spark, p.with_(spine_from=p.close_from.replace(day=1), spine_to=half_year_on))
    return metric_query(P.fct_blended_opportunities(src, p),
                        ["total_pipeline_acv_usd", "cumulative_pipeline_acv_usd", "trailing_3_pipeline_acv_usd"],
                        ["metric_time__month"], spine=days)


@query
def opportunities_running_by_month(spark, sf_dir):
    """Running and trailing totals and distinct counts within each source system; empty periods carry on."""
    src, p = _ctx(spark, sf_dir)
    days = D.time_spine(spark, p.with_(spine_from=p.close_from.replace(day=1), spine_to=p.close_to + dt.timedelta(days=181)))
    return metric_query(P.fct_blended_opportunities(src, p),
                        ["opportunity_count", "cumulative_opportunity_count", "trailing_3_opportunity_count",
                         "cumulative_pipeline_acv_usd", "trailing_3_pipeline_acv_usd"],
                        ["metric_time__month", "source_system"], spine=days)


@mart_query
def activities_trailing_by_week(m):
    """Running and trailing distinct counts by week and activity type, weeks with activities only."""
    return metric_query(m[F2], ["total_activities", "cumulative_activities", "trailing_4_activities"],
                        ["metric_time__week", "new_activity_type"])


@mart_query
def pipeline_vs_calls_filtered(m):
    """One filter over both facts; each condition goes to the facts that have its columns."""
    return metric_query({"blended_opportunities": m[F1], "blended_opportunity_activities": m[F2]},
                        ["total_pipeline_acv_usd", "opportunity_count", "total_activities", "outbound_call_attempts"],
                        ["account__account_segment"], dims=star_dims(m),
                        where="quantity > 1 AND new_activity_type IN ('Call', 'Meeting') "
                              "AND account__account_segment IS NOT NULL AND source_system <> 'none'")


# --------------------------------------------------------------------------- data quality and publishing

def _dq(tests):
    def fn(m):
        return Q.summary(tests, m)
    return fn


for _qname, _tests in (("dq_unique", Q.UNIQUE_TESTS), ("dq_not_null", Q.NOT_NULL_TESTS),
                       ("dq_accepted_values", Q.ACCEPTED_TESTS),
                       ("dq_relationships_pipeline", Q.PIPELINE_REL_TESTS),
                       ("dq_relationships_activities", Q.ACTIVITY_REL_TESTS)):
    _fn = _dq(_tests)
    _fn.__name__ = _qname
    mart_query(_fn)


@query
def dq_failure_log(spark, sf_dir):
    """This run's failing rows of every test, appended to the log table and read back."""
    root = os.path.join(_storage_root(spark), "dq_failure_log")
    return Q.failure_log(spark, Q.ALL_TESTS, _marts(spark, sf_dir), root)


def publish(spark: SparkSession, m: dict[str, DataFrame], names=None) -> dict[str, DataFrame]:
    """Write marts as parquet tables under the shared folder; return them read back."""
    return write_tables(spark, m, names)


@query
def publish_roundtrip(spark, sf_dir):
    m = _marts(spark, sf_dir)
    return to_doubles(publish(spark, m, ["fct_blended_opportunities"])["fct_blended_opportunities"])


@query
def dq_coverage(spark, sf_dir):
    """Rows per model in the transform, counted as they are written, and in its published table."""
    pub, rows = write_counted(spark, _marts(spark, sf_dir))
    parts = [pub[n].agg(F.count(F.lit(1)).alias("publish_rows")).select(
        F.lit(n).alias("model"), F.lit(rows[n]).cast("bigint").alias("transform_rows"), "publish_rows") for n in pub]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


@query
def dq_freshness(spark, sf_dir):
    """Newest timestamp per time-stamped source and its age in days at ``as_of``."""
    src, p = _ctx(spark, sf_dir)
    parts = [src[s].agg(F.max(c).alias("latest")).select(F.lit(s).alias("source"), "latest")
             for s, c in (("edh_opportunity", "source_created_ts"), ("edh_opportunity_task", "source_created_ts"),
                          ("acs_opportunity", "created_date"), ("acs_task", "date_created"))]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.select("source", "latest",
                      F.datediff(F.lit(p.as_of), F.col("latest").cast("date")).alias("age_days"))


@query
def dq_parity(spark, sf_dir):
    """Per-system totals of the transform against the published table."""
    m = _marts(spark, sf_dir)
    f = m["fct_blended_opportunities"]
    pub = publish(spark, m, ["fct_blended_opportunities"])["fct_blended_opportunities"]

    def totals(df, tag):
        return df.groupBy("source_system").agg(F.count(F.lit(1)).alias(f"{tag}_rows"),
                                               F.sum("line_item_acv_usd").alias(f"{tag}_acv"))
    a, b = totals(f, "transform"), totals(pub, "publish")
    j = a.join(b, "source_system", "full")
    return j.select("source_system", "transform_rows", "publish_rows",
                    money(F.col("transform_acv")).alias("transform_acv_usd"),
                    money(F.col("publish_acv")).alias("publish_acv_usd"),
                    (F.coalesce(F.col("transform_rows") == F.col("publish_rows"), F.lit(False))
                     & F.coalesce(F.col("transform_acv") == F.col("publish_acv"), F.lit(False))).alias("is_equal"))


def flagship_over(m: dict[str, DataFrame]) -> DataFrame:
    """Weighted pipeline ACV per source system and fiscal quarter of the close date."""
    return metric_query(m["fct_blended_opportunities"],
                        ["total_weighted_pipeline_acv_usd", "total_pipeline_acv_usd", "pipeline_confidence_ratio"],
                        ["source_system", "close_date__fiscal_quarter"], dims=star_dims(m))


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flagship_over(_marts(spark, sf_dir))
