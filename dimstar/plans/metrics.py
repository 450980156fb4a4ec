"""Semantic layer: measures, metrics and ``metric_query``.

Metrics are plain aggregates over a fact.  When a query groups by an
attribute of a dimension, sums are first aggregated down to the
foreign-key grain and only that reduced set is joined to the dimension.
A distinct count would keep such an aggregate at the fact's own grain, so
there the dimension is joined to the fact directly.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dimstar.plans.star import ACTIVITY_EDGES, PIPELINE_EDGES, Edge, edge_by_role, join_edge


def money(c: Column) -> Column:
    """Money for display: the exact decimal sum with six decimals, as a double."""
    return F.round(c, 6).cast("decimal(38,6)").cast("double")


@dataclass(frozen=True)
class Measure:
    name: str
    agg: str  # "sum" | "count_distinct"
    expr: Callable[[], Column]
    kind: str = "int"  # "money" | "int" | "double" (sums) ; count_distinct -> bigint


@dataclass(frozen=True)
class SemanticModel:
    name: str
    time_dimension: str
    edges: tuple[Edge, ...]
    measures: Mapping[str, Measure] = field(default_factory=dict)


@dataclass(frozen=True)
class Metric:
    name: str
    model: str
    kind: str  # "simple" | "ratio" | "derived"
    measure: str | None = None
    numerator: str | None = None
    denominator: str | None = None
    inputs: tuple[str, ...] = ()
    formula: Callable[..., Column] | None = None
    window: int | None = None  # cumulative: periods of the query's grain; None: all before
    label: str = ""
    description: str = ""


def _m(name, agg, expr, kind="int"):
    return name, Measure(name, agg, expr, kind)


PIPELINE_MODEL = SemanticModel(
    "blended_opportunities", "opportunity_projected_close_date", PIPELINE_EDGES,
    dict([
        _m("line_item_acv_usd_total", "sum", lambda: F.col("line_item_acv_usd"), "money"),
        _m("line_item_weighted_acv_usd_total", "sum", lambda: F.col("line_item_weighted_acv_usd"), "money"),
        _m("line_item_quantity_total", "sum", lambda: F.col("quantity"), "double"),
        _m("opportunity_count", "count_distinct",
           lambda: F.concat(F.col("source_system"), F.lit("|"), F.col("opportunity_number"))),
    ]),
)

ACTIVITY_MODEL = SemanticModel(
    "blended_opportunity_activities", "activity_created_date", ACTIVITY_EDGES,
    dict([
        _m("activity_count", "count_distinct", lambda: F.col("activity_id")),
        _m("call_attempt_outbound_count", "sum", lambda: F.col("call_attempt_outbound")),
        _m("call_connected_outbound_count", "sum", lambda: F.col("call_connected_outbound")),
        _m("meeting_scheduled_count", "sum", lambda: F.col("meeting_scheduled")),
        _m("meeting_completed_count", "sum", lambda: F.col("meeting_completed")),
        _m("email_attempt_outbound_count", "sum", lambda: F.col("email_attempt_outbound")),
        _m("email_received_count", "sum", lambda: F.col("email_received")),
        _m("call_duration_seconds_sum", "sum", lambda: F.col("calldurationinseconds")),
    ]),
)

MODELS = {m.name: m for m in (PIPELINE_MODEL, ACTIVITY_MODEL)}

_P, _A = PIPELINE_MODEL.name, ACTIVITY_MODEL.name
METRICS: dict[str, Metric] = {m.name: m for m in (
    Metric("total_pipeline_acv_usd", _P, "simple", measure="line_item_acv_usd_total",
           label="Pipeline ACV (USD)", description="Sum of line item ACV in USD, open and closed."),
    Metric("total_weighted_pipeline_acv_usd", _P, "simple", measure="line_item_weighted_acv_usd_total",
           label="Weighted pipeline ACV (USD)", description="Sum of line item ACV times the weight of its stage."),
    Metric("opportunity_count", _P, "simple", measure="opportunity_count",
           label="Opportunities", description="Different opportunities of each source system."),
    Metric("line_item_quantity_total", _P, "simple", measure="line_item_quantity_total",
           label="Quantity", description="Sum of line item quantities."),
    Metric("pipeline_confidence_ratio", _P, "ratio",
           numerator="total_weighted_pipeline_acv_usd", denominator="total_pipeline_acv_usd",
           label="Pipeline confidence", description="Weighted over total pipeline ACV."),
    Metric("total_activities", _A, "simple", measure="activity_count",
           label="Activities", description="Different activities."),
    Metric("outbound_call_attempts", _A, "simple", measure="call_attempt_outbound_count",
           label="Outbound call attempts", description="Outbound calls to customers, connected or not."),
    Metric("outbound_calls_connected", _A, "simple", measure="call_connected_outbound_count",
           label="Outbound calls connected", description="Outbound calls that reached somebody."),
    Metric("call_connect_rate", _A, "ratio", numerator="outbound_calls_connected",
           denominator="outbound_call_attempts",
           label="Connect rate", description="Connected outbound calls over attempts."),
    Metric("meetings_scheduled", _A, "simple", measure="meeting_scheduled_count",
           label="Meetings scheduled", description="Meetings that were arranged."),
    Metric("meetings_completed", _A, "simple", measure="meeting_completed_count",
           label="Meetings completed", description="Meetings that took place."),
    Metric("outbound_email_attempts", _A, "simple", measure="email_attempt_outbound_count",
           label="Outbound emails", description="Emails sent to customers."),
    Metric("inbound_emails_received", _A, "simple", measure="email_received_count",
           label="Inbound emails", description="Emails received from customers."),
    Metric("total_call_duration_seconds", _A, "simple", measure="call_duration_seconds_sum",
           label="Call seconds", description="Sum of call durations in seconds."),
    Metric("avg_call_duration_seconds", _A, "ratio", numerator="total_call_duration_seconds",
           denominator="outbound_call_attempts",
           label="Seconds per call", description="Call seconds over outbound call attempts."),
    # Derived metric: an expression over other metrics (documented metric type).
    Metric("acv_per_opportunity", _P, "derived", inputs=("total_pipeline_acv_usd", "opportunity_count"),
           formula=lambda acv, n: F.try_divide(acv.cast("double"), n.cast("double")),
           label="ACV per opportunity", description="Pipeline ACV over the number of opportunities."),
    # Cumulative metrics: totals of a sum or a distinct count over the query's time key, running or trailing.
    Metric("cumulative_pipeline_acv_usd", _P, "cumulative", inputs=("total_pipeline_acv_usd",),
           label="Running pipeline ACV (USD)", description="Pipeline ACV of all periods up to this one."),
    Metric("trailing_3_pipeline_acv_usd", _P, "cumulative", inputs=("total_pipeline_acv_usd",), window=3,
           label="Pipeline ACV of three periods (USD)", description="Pipeline ACV of this period and the two before."),
    Metric("cumulative_opportunity_count", _P, "cumulative", inputs=("opportunity_count",),
           label="Running opportunities", description="Different opportunities of all periods up to this one."),
    Metric("trailing_3_opportunity_count", _P, "cumulative", inputs=("opportunity_count",), window=3,
           label="Opportunities of three periods", description="Different opportunities of this period and the two before."),
    Metric("cumulative_activities", _A, "cumulative", inputs=("total_activities",),
           label="Running activities", description="Different activities of all periods up to this one."),
    Metric("trailing_4_activities", _A, "cumulative", inputs=("total_activities",), window=4,
           label="Activities of four periods", description="Different activities of this period and the three before."),
    Metric("cumulative_outbound_call_attempts", _A, "cumulative", inputs=("outbound_call_attempts",),
           label="Running outbound call attempts", description="Outbound call attempts of all periods up to this one."),
)}

GRAINS = ("day", "week", "month", "quarter", "year")


def _simple_closure(names: Sequence[str]) -> list[str]:
    """All simple metrics needed to evaluate ``names`` (ratios/derived expand)."""
    out: list[str] = []

    def visit(n: str) -> None:
        m = METRICS[n]
        deps = {"simple": (), "ratio": (m.numerator, m.denominator), "derived": m.inputs,
                "cumulative": m.inputs}[m.kind]
        for d in deps:
            visit(d)
        if m.kind == "simple" and n not in out:
            out.append(n)

    for n in names:
        visit(n)
    return out


def _key_column(model: SemanticModel, name: str) -> tuple[str, Column | None, Edge | None, str | None]:
    """Resolve a group-by name: local column, metric_time__grain, or role__attribute."""
    if name.startswith("metric_time__"):
        grain = name.split("__", 1)[1]
        if grain not in GRAINS:
            raise ValueError(f"unknown grain {grain!r}")
        col = F.col(model.time_dimension)
        expr = col if grain == "day" else F.date_trunc(grain, col).cast("date")
        return name, expr, None, None
    if "__" in name:
        role, attr = name.split("__", 1)
        return name, None, edge_by_role(model.edges, role), attr
    return name, F.col(name), None, None


def dimensions_of(metrics: Sequence[str], dims: Mapping[str, DataFrame]) -> list[str]:
    """The names by which all of the metrics can be grouped: time grains and ``role__attribute``."""
    names: list[set[str]] = []
    for model in {METRICS[m].model for m in metrics}:
        edges = [e for e in MODELS[model].edges if e.dim in dims]
        names.append({f"metric_time__{g}" for g in GRAINS}
                     | {f"{e.role}__{a}" for e in edges for a in dims[e.dim].columns if a != e.key})
    return sorted(set.intersection(*names)) if names else []


def _where_roles(where: Column | str | None, model: SemanticModel, fact: DataFrame) -> dict[str, list[str]]:
    """The dimension attributes (``role__attribute``) that a filter in SQL names."""
    found: dict[str, list[str]] = {}
    if isinstance(where, str):
        outside = re.sub(r"'(?:[^']|'')*'", "''", where)  # without string literals
        roles = {e.role for e in model.edges}
        for role, attr in re.findall(r"\b([A-Za-z]\w*?)__(\w+)", outside):
            if role in roles and f"{role}__{attr}" not in fact.columns and attr not in found.setdefault(role, []):
                found[role].append(attr)
    return found


def _period(grain: str, c: Column) -> Column:
    """The number of a period, so that neighbours differ by one."""
    if grain == "day":
        return F.unix_date(c)
    if grain == "week":
        return F.floor((F.unix_date(c) + 3) / 7)  # weeks begin on Monday
    return {"month": F.year(c) * 12 + F.month(c), "quarter": F.year(c) * 4 + F.quarter(c), "year": F.year(c)}[grain]


NO_PERIOD = -(1 << 40)  # the number of the period of rows without a date: before all others


def _number(grain: str, c: Column) -> Column:
    return F.coalesce(_period(grain, c).cast("bigint"), F.lit(NO_PERIOD))


def distinct_changes(ids: DataFrame, keys: Sequence[str], period: str, value: str, window: int | None) -> DataFrame:
    """keys, ``period``, change: by how much the number of different values grows or falls at each period.

    ``ids`` has the keys, a period number and a value.  A running count
    grows where a value is first seen.  In a trailing window a value counts
    from a period it is seen in for ``window`` periods; overlapping stretches
    of a value are merged, so it counts once: +1 where a stretch begins, -1
    behind its end.  Values are compared with themselves only (one row per
    value and period), never with other periods of the series.
    """
    if window is None:
        first = ids.groupBy(*keys, value).agg(F.min(period).alias(period))
        return first.groupBy(*keys, period).agg(F.count(F.lit(1)).alias("change"))
    seen = ids.select(*keys, value, period).distinct()
    w = Window.partitionBy(*keys, value).orderBy(period)
    p = F.col(period)
    begins = F.coalesce(p - F.lag(p).over(w) >= window, F.lit(True))
    ends = F.coalesce(F.lead(p).over(w) - p >= window, F.lit(True))
    events = seen.select(*keys, F.array_compact(F.array(
        F.when(begins, F.struct(p.alias("at"), F.lit(1).alias("step"))),
        F.when(ends, F.struct((p + window).alias("at"), F.lit(-1).alias("step"))))).alias("e"))
    steps = events.select(*keys, F.inline("e"))
    return steps.groupBy(*keys, F.col("at").alias(period)).agg(F.sum("step").alias("change"))


def _running_distinct(out: DataFrame, changes: DataFrame, keys: Sequence[str], period: str, name: str) -> DataFrame:
    """``out`` with ``name``: the sum of all changes of its keys up to its period.

    Both sides are aggregated, a row for each key and period at most, and
    meet in one window over their union.
    """
    rows = out.withColumn("__own", F.lit(True)).withColumn("__change", F.lit(0).cast("bigint"))
    steps = changes.select(*keys, period, F.col("change").alias("__change"), F.lit(False).alias("__own"))
    w = Window.partitionBy(*keys).orderBy(period).rangeBetween(Window.unboundedPreceding, 0)
    both = rows.unionByName(steps, allowMissingColumns=True).withColumn(name, F.sum("__change").over(w).cast("bigint"))
    return both.where("__own").drop("__own", "__change")


def metric_query(fact: DataFrame | Mapping[str, DataFrame], metrics: Sequence[str], group_by: Sequence[str] = (),
                 dims: Mapping[str, DataFrame] | None = None, where: Column | str | None = None,
                 order_by: Sequence[str] = (), spine: DataFrame | None = None) -> DataFrame:
    """Evaluate metrics grouped by local columns, time grains and dimension attributes.

    ``where`` filters the fact's rows; a filter in SQL may also name
    dimension attributes (``role__attribute``).  ``order_by`` takes metric
    or key names, ``-name`` for descending.  With ``spine`` (a ``date_day``
    column) and a ``metric_time__<grain>`` key, the result has every period of
    the spine, and of no other, for every combination of the other keys that
    has data in any of them; metrics read 0 in empty periods, and running
    totals go on.

    Metrics of several models need ``fact`` as a mapping of model to fact;
    each model is aggregated by itself and the results meet on the group-by
    keys, NULL keys included; a metric without rows for a key is NULL.
    A filter in SQL may name columns of one fact only: see ``route_filter``.
    """
    models = list(dict.fromkeys(METRICS[m].model for m in metrics))
    if len(models) == 1:
        one = fact[models[0]] if isinstance(fact, Mapping) else fact
        return _order(_one_model(MODELS[models[0]], one, metrics, group_by, dims, where, spine), order_by)
    if not isinstance(fact, Mapping):
        raise ValueError("metrics of several semantic models need a mapping of model to fact")
    filters = route_filter(where, {model: fact[model] for model in models}, dims)
    parts = [_one_model(MODELS[model], fact[model], [m for m in metrics if METRICS[m].model == model],
                        group_by, dims, filters[model], spine) for model in models]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    # Each part has one row per key at most.
    return _order(out.groupBy(*group_by).agg(*[F.max(m).alias(m) for m in metrics]), order_by)


def split_conjuncts(condition: str) -> list[str]:
    """The parts of a SQL condition between its top-level ANDs (not those of BETWEEN, brackets, CASE or literals)."""
    parts, start, depth, between = [], 0, 0, 0
    for t in re.finditer(r"'(?:[^']|'')*'|`[^`]*`|\"[^\"]*\"|[()]|\b\w+\b", condition):
        word = t.group().upper()
        if word in ("(", "CASE"):
            depth += 1
        elif word in (")", "END"):
            depth -= 1
        elif depth == 0 and word == "OR":
            return [condition]  # its ANDs bind tighter
        elif depth == 0 and word == "BETWEEN":
            between += 1
        elif depth == 0 and word == "AND":
            if between:
                between -= 1
            else:
                parts.append(condition[start:t.start()])
                start = t.end()
    return [p.strip() for p in [*parts, condition[start:]] if p.strip()]


def _resolves(conjunct: str, model: SemanticModel, fact: DataFrame, dims: Mapping[str, DataFrame] | None) -> bool:
    """Whether all columns that the condition names are the fact's or its dimensions' (decided by the analyzer)."""
    df = fact
    try:
        for role, attrs in _where_roles(conjunct, model, fact).items():
            edge = edge_by_role(model.edges, role)
            df = join_edge(df, (dims or {})[edge.dim], edge, attrs)
        df.where(conjunct).schema  # noqa: B018
    except KeyError:
        return False
    except AnalysisException as e:
        if (e.getCondition() or "").startswith("UNRESOLVED_COLUMN"):
            return False
        raise
    return True


def route_filter(where: Column | str | None, facts: Mapping[str, DataFrame],
                 dims: Mapping[str, DataFrame] | None) -> dict[str, Column | str | None]:
    """The part of a filter that belongs to each model.

    A condition in SQL is taken apart at its top-level ANDs; each part goes
    to every model whose columns and dimensions it names.  A part that no
    model can resolve is an error.  A Column goes to all models as it is.
    """
    if not isinstance(where, str):
        return {model: where for model in facts}
    found: dict[str, list[str]] = {model: [] for model in facts}
    for part in split_conjuncts(where):
        takers = [m for m in facts if _resolves(part, MODELS[m], facts[m], dims)]
        if not takers:
            raise ValueError(f"no model has all columns of the filter {part!r}")
        for m in takers:
            found[m].append(part)
    return {m: " AND ".join(f"({p})" for p in parts) or None for m, parts in found.items()}


def _order(df: DataFrame, order_by: Sequence[str]) -> DataFrame:
    if not order_by:
        return df
    return df.orderBy(*[F.col(o[1:]).desc_nulls_last() if o.startswith("-") else F.col(o).asc_nulls_first()
                        for o in order_by])


def _one_model(model: SemanticModel, fact: DataFrame, metrics: Sequence[str], group_by: Sequence[str],
               dims: Mapping[str, DataFrame] | None, where: Column | str | None, spine: DataFrame | None) -> DataFrame:
    simple = _simple_closure(metrics)
    measures = {s: model.measures[METRICS[s].measure] for s in simple}
    keys = [_key_column(model, g) for g in group_by]

    df, joined = fact, _where_roles(where, model, fact)
    for role, attrs in joined.items():
        # A filter on a dimension: it is joined once, with what the grouping asks of it as well.
        edge = edge_by_role(model.edges, role)
        attrs += [a for _, _, e, a in keys if e is edge and a not in attrs]
        df = join_edge(df, dims[edge.dim], edge, attrs)
    if where is not None:
        df = df.where(where)
    local = [(n, F.col(n) if e is not None else c) for n, c, e, _ in keys if e is None or e.role in joined]
    by_edge: dict[str, tuple[Edge, list[str]]] = {}
    for _, _, e, attr in keys:
        if e is not None and e.role not in joined:
            by_edge.setdefault(e.role, (e, []))[1].append(attr)

    sums = {s: m for s, m in measures.items() if m.agg == "sum"}
    distincts = {s: m for s, m in measures.items() if m.agg == "count_distinct"}
    pre_keys = [c.alias(n) for n, c in local] + [F.col(e.fk).alias(f"__fk_{r}") for r, (e, _) in by_edge.items()]
    values = [m.expr().alias(f"__v_{s}") for s, m in measures.items()]
    if by_edge and not distincts:
        # Reduce the fact to (local keys, foreign keys) before any dimension join.
        rows = df.groupBy(*pre_keys).agg(*[F.sum(m.expr()).alias(f"__v_{s}") for s, m in sums.items()])
    else:
        rows = df.select(*pre_keys, *values)
    for role, (edge, attrs) in by_edge.items():
        rows = join_edge(rows, dims[edge.dim], Edge(f"__fk_{role}", edge.dim, edge.key, role, True), attrs)
    out = rows.groupBy(*group_by).agg(
        *[F.sum(f"__v_{s}").alias(f"__v_{s}") for s in sums],
        *[F.countDistinct(f"__v_{s}").cast("bigint").alias(f"__v_{s}") for s in distincts])

    time_key = next((g for g in group_by if g.startswith("metric_time__")), None)
    grain = time_key.split("__", 1)[1] if time_key else None
    others = [g for g in group_by if g != time_key]
    periods = None
    if spine is not None and time_key:
        day = F.col("date_day")
        periods = spine.select((day if grain == "day" else F.date_trunc(grain, day).cast("date")).alias(time_key)) \
            .distinct()
        if others:
            # The series of each key: all periods, exploded from the key's one row.
            series = periods.agg(F.sort_array(F.collect_list(time_key))).scalar()
            out = out.join(periods, time_key, "left_semi")
            dense = out.select(*others).distinct().withColumn(time_key, F.explode(series))
            # NULL keys are keys: rows of the series and of the data meet by grouping.
            out = dense.unionByName(out, allowMissingColumns=True).groupBy(*group_by) \
                .agg(*[F.max(f"__v_{s}").alias(f"__v_{s}") for s in simple])
        else:
            out = periods.join(out, time_key, "left")
        out = out.select(*group_by, *[F.coalesce(F.col(f"__v_{s}"), F.lit(0).cast(out.schema[f"__v_{s}"].dataType))
                                      .alias(f"__v_{s}") for s in simple])

    # Totals over the aggregated periods (one row per key and period), on the
    # exact sums; partitioned by the other keys.
    for c in (METRICS[n] for n in metrics if METRICS[n].kind == "cumulative"):
        if time_key is None:
            raise ValueError("a cumulative metric needs a metric_time__<grain> key")
        of = c.inputs[0]
        if measures[of].agg == "count_distinct":
            ids = rows if periods is None else rows.join(periods, time_key, "left_semi")
            ids = ids.where(F.col(f"__v_{of}").isNotNull()).withColumn("__period", _number(grain, F.col(time_key)))
            changes = distinct_changes(ids, others, "__period", f"__v_{of}", c.window)
            out = _running_distinct(out.withColumn("__period", _number(grain, F.col(time_key))), changes, others, "__period",
                                    f"__v_{c.name}").drop("__period")
            continue
        w = Window.partitionBy(*others).orderBy(_period(grain, F.col(time_key)))
        first = Window.unboundedPreceding if c.window is None else -(c.window - 1)
        out = out.withColumn(f"__v_{c.name}", F.sum(f"__v_{of}").over(w.rangeBetween(first, 0)))

    def exact(name: str) -> Column:
        return F.col(f"__v_{name}")

    def shown(name: str, measure: Measure) -> Column:
        c = exact(name)
        return money(c) if measure.kind == "money" else c.cast("double" if measure.kind == "double" else "bigint")

    cols = []
    for name in metrics:
        m = METRICS[name]
        if m.kind == "simple":
            c = shown(name, measures[name])
        elif m.kind == "cumulative":
            c = shown(name, measures[m.inputs[0]])
        else:
            # Ratios and formulas are taken of the exact sums; those of money show nine decimals.
            of = (m.numerator, m.denominator) if m.kind == "ratio" else m.inputs
            c = F.try_divide(exact(of[0]).cast("double"), exact(of[1]).cast("double")) if m.kind == "ratio" \
                else m.formula(*[exact(i) for i in of])
            if any(measures[i].kind == "money" for i in of):
                c = F.round(c, 9)
        cols.append(c.alias(name))
    return out.select(*group_by, *cols)
