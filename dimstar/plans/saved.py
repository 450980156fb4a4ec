"""Saved queries: metric queries kept under a name, with their grouping, filter and order.

``SAVED_QUERIES`` holds the library's own; ``load_saved`` adds those of a
JSON file: a list of objects with the fields of ``SavedQuery``.  A query is
checked when it is read, so a misspelt metric fails before any data is.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, SparkSession

from dimstar.plans.metrics import METRICS, metric_query


@dataclass(frozen=True)
class SavedQuery:
    name: str
    metrics: tuple[str, ...]
    group_by: tuple[str, ...] = ()
    where: str | None = None
    order_by: tuple[str, ...] = ()
    description: str = ""

    def __post_init__(self):
        for part in ("metrics", "group_by", "order_by"):
            value = getattr(self, part)
            if isinstance(value, str):
                raise ValueError(f"saved query {self.name}: {part} must be a list")
            object.__setattr__(self, part, tuple(value))
        unknown = [m for m in self.metrics if m not in METRICS]
        if unknown or not self.metrics:
            raise ValueError(f"saved query {self.name}: " + (f"unknown metrics {', '.join(unknown)}" if unknown else "no metrics"))
        stray = [o for o in self.order_by if o.removeprefix("-") not in (*self.metrics, *self.group_by)]
        if stray:
            raise ValueError(f"saved query {self.name}: ordered by {', '.join(stray)}, which it does not return")

    @property
    def models(self) -> list[str]:
        return list(dict.fromkeys(METRICS[m].model for m in self.metrics))

    def run(self, facts: Mapping[str, DataFrame], dims: Mapping[str, DataFrame]) -> DataFrame:
        """The result over ``facts`` (by semantic model) and the dimensions."""
        return metric_query({m: facts[m] for m in self.models}, self.metrics, self.group_by, dims=dims,
                            where=self.where, order_by=self.order_by)


SAVED_QUERIES = {q.name: q for q in (
    SavedQuery("activity_scorecard",
               ("total_activities", "outbound_call_attempts", "outbound_calls_connected", "call_connect_rate",
                "meetings_scheduled", "meetings_completed", "outbound_email_attempts", "inbound_emails_received",
                "total_call_duration_seconds", "avg_call_duration_seconds"),
               ("source_system", "activity_group"),
               description="Every activity metric by system and activity group."),
    SavedQuery("quarterly_pipeline",
               ("total_pipeline_acv_usd", "total_weighted_pipeline_acv_usd", "opportunity_count", "pipeline_confidence_ratio",
                "acv_per_opportunity"),
               ("metric_time__quarter", "account__account_segment"), "account__account_segment IS NOT NULL",
               ("metric_time__quarter", "-total_pipeline_acv_usd"),
               description="Pipeline by quarter of the close date and segment of known accounts."),
)}


def load_saved(spark: SparkSession, path: str) -> dict[str, SavedQuery]:
    """The library's saved queries and those of a JSON file Spark can reach, which replace the ones of their names."""
    rows = spark.read.text(path, wholetext=True).collect()  # one small definition file
    known = {f.name for f in fields(SavedQuery)}
    out = dict(SAVED_QUERIES)
    for row in rows:
        for item in json.loads(row["value"]):
            stray = sorted(set(item) - known)
            if stray:
                raise ValueError(f"saved query {item.get('name')}: unknown fields {', '.join(stray)}")
            query = SavedQuery(**item)
            out[query.name] = query
    return out
