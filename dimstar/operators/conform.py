"""Conform-union: authoritative rows plus secondary rows the authority lacks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def not_in_authority(secondary: DataFrame, key: str | Column, authority: DataFrame,
                     authority_key: str) -> DataFrame:
    """Rows of ``secondary`` whose key is absent from the whole ``authority``.

    Written as ``left_anti`` (a plain LEFT JOIN + IS NULL is not rewritten by
    Catalyst and would carry every matched pair through the join).  Rows with
    a NULL key are kept, as LEFT JOIN ... IS NULL keeps them.  The authority
    side is reduced to its distinct keys first, so a key repeated many times
    in the authority collapses map-side instead of piling into one task.
    """
    keys = authority.select(F.col(authority_key).alias("__auth_key")).where(F.col("__auth_key").isNotNull()) \
        .distinct()
    left_key = F.col(key) if isinstance(key, str) else key
    return secondary.join(keys, left_key == F.col("__auth_key"), "left_anti")


def conform_union(primary_rows: DataFrame, secondary_rows: DataFrame, key: str | Column,
                  authority: DataFrame, authority_key: str) -> DataFrame:
    """``primary_rows UNION ALL (secondary_rows not in authority)``, matched by name.

    ``authority`` is the unfiltered authoritative table: a key the
    authoritative branch filters out is still not taken from the secondary.
    """
    return primary_rows.unionByName(not_in_authority(secondary_rows, key, authority, authority_key))
