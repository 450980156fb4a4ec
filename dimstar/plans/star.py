"""Star schema: fact-to-dimension relationships and the star join."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Edge:
    """Many-to-one relationship ``fact.fk -> dim.key``.

    ``role`` names the edge and prefixes the dimension's columns
    (``role__attribute``); inactive edges are joined only when asked for.
    """

    fk: str
    dim: str
    key: str
    role: str
    active: bool = True


PIPELINE_EDGES = (
    Edge("opportunity_number", "opportunity", "opportunity_number", "opportunity"),
    Edge("account_csn", "account", "account_csn", "account"),
    Edge("partner_csn", "account", "account_csn", "partner_account", active=False),
    Edge("opportunity_owner_id", "employee", "employee_id", "opportunity_owner"),
    Edge("account_owner_id", "employee", "employee_id", "account_owner", active=False),
    Edge("opportunity_projected_close_date", "date", "date_day", "close_date"),
)

ACTIVITY_EDGES = (
    Edge("opportunity_number", "opportunity", "opportunity_number", "opportunity"),
    Edge("account_csn", "account", "account_csn", "account"),
    Edge("ownerid", "employee", "employee_id", "owner"),
    Edge("account_contact_csn", "contact", "contact_csn", "contact"),
    Edge("activity_created_date", "date", "date_day", "created_date"),
)


def edge_by_role(edges: Sequence[Edge], role: str) -> Edge:
    for e in edges:
        if e.role == role:
            return e
    raise KeyError(f"no relationship with role {role!r}")


def join_edge(fact: DataFrame, dim: DataFrame, edge: Edge, attributes: Sequence[str]) -> DataFrame:
    """Left join one edge, adding ``role__attr`` columns.

    The dimension is cut to its key and the asked attributes before the
    join.  No hint: AQE broadcasts it when its measured size is under the
    threshold and keeps a sort-merge join otherwise.  Duplicate dimension
    keys fan out, as in the reference (the unique tests report them).
    """
    k = f"__{edge.role}__key"
    side = dim.select(F.col(edge.key).alias(k), *[F.col(a).alias(f"{edge.role}__{a}") for a in attributes])
    return fact.join(side, F.col(edge.fk) == F.col(k), "left").drop(k)


def star_join(fact: DataFrame, dims: Mapping[str, DataFrame], edges: Sequence[Edge],
              attributes: Mapping[str, Sequence[str]], roles: Sequence[str] = ()) -> DataFrame:
    """Join the active edges (plus the named inactive ``roles``) that ``attributes`` asks for."""
    out = fact
    for e in edges:
        if e.role not in attributes:
            continue
        if not e.active and e.role not in roles:
            raise ValueError(f"relationship {e.role!r} is inactive; pass it in roles=")
        out = join_edge(out, dims[e.dim], e, attributes[e.role])
    return out
