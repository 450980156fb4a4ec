"""Source catalogue: the 18 CRM tables the jobs read, with their columns.

``load_sources`` reads real extracts (one parquet folder per source under a
root); ``dimstar.sources.fixture`` derives the same tables from the test
data.  Both return a :class:`Sources` mapping of lazy DataFrames.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

# Columns per source (lower-case names of the CRM extracts).
SOURCE_COLUMNS: dict[str, tuple[str, ...]] = {
    "edh_opportunity": (
        "opportunity_number", "source_record_id", "opportunity_name", "opportunity_stage",
        "opportunity_type", "end_customer_account_csn", "sales_partner_account_csn",
        "sales_rep_number", "projected_close_date", "source_created_ts", "primary_sales_motion",
        "opportunity_forecast_category", "sales_channel", "customer_project", "compelling_event",
        "access_to_funds", "formal_decision_process", "informal_decision_process",
        "unique_business_value",
    ),
    "edh_opportunity_line_item": (
        "opportunity_number", "line_item_number", "offering_id", "quantity", "line_item_acv_usd",
        "sales_revenue_group_detail", "opportunity_line_status", "sales_motion_category", "action",
        "access_model", "term",
    ),
    "edh_offering": (
        "offering_id", "offering_name", "sales_motion_product_category", "solution_division",
        "focus_segment_group", "focus_segment",
    ),
    "edh_account": (
        "account_csn", "account_name", "sales_geo", "country_name", "sales_region_name",
        "named_account_group", "account_type", "corporate_account_name", "account_hierarchy_depth",
        "account_hierarchy_level", "account_category", "industry_segment", "is_targeted_account",
        "sales_rep_number", "is_visible",
    ),
    "edh_quote": ("opportunity_number", "quote_number", "sales_partner_account_csn", "quote_status", "quote_date"),
    "edh_exchange_rate": ("from_currency_code", "effective_start_date", "exchange_rate"),
    "edh_opportunity_task": (
        "task_id", "opportunity_number", "assigned_to_employee_number", "end_customer_contact_csn",
        "subject_line", "task_description", "task_type", "task_subtype", "task_status",
        "sales_activity_type", "sales_activity_subtype", "source_created_ts", "task_activity_date",
        "task_completed_ts",
    ),
    "edh_employee": ("worker_id", "preferred_name", "sales_role", "manager_display_name", "work_email", "is_active"),
    "edh_finance_calendar": (
        "date_key", "fiscal_year_name", "fiscal_year_quarter_name", "month_number_in_fiscal_quarter",
    ),
    "edh_contact": ("contact_csn", "first_name", "last_name", "email_address", "contact_phone_number"),
    "crm_opportunity_tags": ("id", "opportunity_tags__c"),
    "acs_opportunity": (
        "id", "opportunity_number__c", "account_id", "owner_id", "name", "stage_name", "type",
        "bmtchannel_c", "created_date", "close_date", "shipping_country", "is_closed", "reason_lost_c",
    ),
    "acs_opportunity_line_item": (
        "id", "opportunity_id", "quantity", "est_annualized_amount_c", "currency_iso_code",
        "subscription_name", "is_deleted",
    ),
    "acs_account": (
        "account_id", "own_csn", "child_csn", "account_name", "geo_c", "account_country_c",
        "account_type", "shipping_country",
    ),
    "acs_user": ("user_id", "manager_name", "user_email"),
    "acs_task": (
        "task_id", "what_id", "owner_id", "sfdc_contact_id", "task_subject", "task_type",
        "task_subtype", "task_status", "task_type_c", "call_outcome", "call_type",
        "outreach_call_duration_c", "date_created", "date_activity", "completed_date_time", "is_deleted",
    ),
    "acs_contact": ("contact_id", "contact_csn", "first_name", "last_name", "user_email", "phone"),
    "country_region_map": ("country",),
}


# Declared types of the non-text columns; every other column is text.  A
# "number" keeps the extract's own numeric type, or takes the decimal given
# for extracts in text form (wide enough that a product of two stays exact);
# a "flag" is 1 or 0.
AMOUNT, RATE = "number decimal(20,6)", "number decimal(17,12)"
SOURCE_TYPES: dict[str, dict[str, str]] = {
    "edh_opportunity": {"projected_close_date": "timestamp_ntz", "source_created_ts": "timestamp_ntz"},
    "edh_opportunity_line_item": {"quantity": "double", "line_item_acv_usd": AMOUNT},
    "edh_account": {"is_visible": "flag"},
    "edh_quote": {"quote_date": "date"},
    "edh_exchange_rate": {"effective_start_date": "date", "exchange_rate": RATE},
    "edh_opportunity_task": {"source_created_ts": "timestamp_ntz", "task_activity_date": "timestamp_ntz",
                             "task_completed_ts": "timestamp_ntz"},
    "edh_employee": {"is_active": "flag"},
    "edh_finance_calendar": {"date_key": "date", "month_number_in_fiscal_quarter": "double"},
    "acs_opportunity": {"created_date": "timestamp_ntz", "close_date": "timestamp_ntz", "is_closed": "flag"},
    "acs_opportunity_line_item": {"quantity": "double", "est_annualized_amount_c": AMOUNT, "is_deleted": "flag"},
    "acs_task": {"outreach_call_duration_c": "double", "date_created": "timestamp_ntz",
                 "date_activity": "timestamp_ntz", "completed_date_time": "timestamp_ntz", "is_deleted": "flag"},
}
# Usual spellings of flags in extracts.
TRUE_WORDS, FALSE_WORDS = ("true", "t", "yes", "y", "1", "1.0"), ("false", "f", "no", "n", "0", "0.0")
# Columns kept in their extract type (free-form values the rules only pass through or parse themselves).
LOOSE_COLUMNS = {("edh_account", "account_hierarchy_depth"), ("edh_account", "account_hierarchy_level"),
                 ("edh_account", "is_targeted_account"), ("edh_account", "sales_rep_number")}


def _typed_column(df: DataFrame, name: str, c: str) -> Column:
    kind = SOURCE_TYPES.get(name, {}).get(c, "string")
    if (name, c) in LOOSE_COLUMNS:
        return F.col(c)
    if kind == "flag":
        word = F.lower(F.trim(F.col(c).cast("string")))
        return F.when(word.isin(*TRUE_WORDS), 1).when(word.isin(*FALSE_WORDS), 0) \
            .otherwise(F.col(c).cast("string").try_cast("int"))
    if kind.startswith("number "):
        if isinstance(df.schema[c].dataType, NumericType):
            return F.col(c)
        return F.trim(F.col(c).cast("string")).try_cast(kind.split(" ", 1)[1])
    return F.col(c).try_cast(kind)


def typed(name: str, df: DataFrame) -> DataFrame:
    """Project a raw extract onto the declared columns and types.

    A value that can't be read as its type becomes NULL; ``rejects`` counts
    such values, and ``build`` prints them.
    """
    return df.select(*[_typed_column(df, name, c).alias(c) for c in SOURCE_COLUMNS[name]])


def reject_counts(name: str, df: DataFrame) -> dict[str, Column]:
    """Of each typed column: an aggregate that counts the values which can't be read as its type."""
    cols = [c for c in SOURCE_COLUMNS[name] if c in SOURCE_TYPES.get(name, {})]
    return {c: F.count_if(F.col(c).isNotNull() & _typed_column(df, name, c).isNull()) for c in cols}


def rejects(name: str, df: DataFrame) -> DataFrame:
    """(source, column, rejected): how many values of each typed column can't be read as its type."""
    counts = reject_counts(name, df)
    if not counts:
        return df.sparkSession.createDataFrame([], "source string, column string, rejected bigint")
    return df.agg(*[a.alias(c) for c, a in counts.items()]).select(F.inline(F.array(*[
        F.struct(F.lit(name).alias("source"), F.lit(c).alias("column"), F.col(c).alias("rejected")) for c in counts])))


class Sources(Mapping[str, DataFrame]):
    """Read-only mapping of source name to DataFrame, also usable as attributes."""

    def __init__(self, frames: dict[str, DataFrame]):
        missing = set(SOURCE_COLUMNS) - set(frames)
        if missing:
            raise KeyError(f"missing sources: {sorted(missing)}")
        self._frames = {name: frames[name].select(*SOURCE_COLUMNS[name]) for name in SOURCE_COLUMNS}

    def __getitem__(self, name: str) -> DataFrame:
        return self._frames[name]

    def __getattr__(self, name: str) -> DataFrame:
        try:
            return self._frames[name]
        except KeyError as exc:
            raise AttributeError(name) from exc

    def __iter__(self):
        return iter(self._frames)

    def __len__(self) -> int:
        return len(self._frames)

    def replace(self, **frames: DataFrame) -> "Sources":
        merged = dict(self._frames)
        merged.update(frames)
        return Sources(merged)


def load_sources(spark: SparkSession, root: str, fmt: str = "parquet") -> Sources:
    """Read each source from ``{root}/{name}`` (one folder per source), typed as declared."""
    return Sources({name: typed(name, spark.read.format(fmt).load(f"{root}/{name}")) for name in SOURCE_COLUMNS})


def load_rejects(spark: SparkSession, root: str, fmt: str = "parquet") -> DataFrame:
    """The values that ``load_sources`` can't read as their type, for columns that have any."""
    out = None
    for name in SOURCE_TYPES:
        part = rejects(name, spark.read.format(fmt).load(f"{root}/{name}"))
        out = part if out is None else out.unionByName(part)
    return out.where(F.col("rejected") > 0)
