"""Column helpers: built-in expressions only, so every rule stays inside
whole-stage code generation (no Python evaluation in the hot path)."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def blank_to_null(c: Column) -> Column:
    """``NULLIF(TRIM(x), '')``: blank text counts as missing."""
    return F.nullif(F.trim(c), F.lit(""))


def first_match(rules: Sequence[tuple[Column, object]], default: object = None) -> Column:
    """``CASE WHEN c1 THEN v1 WHEN c2 THEN v2 ... ELSE default END``; first match wins."""
    out = None
    for cond, value in rules:
        v = value if isinstance(value, Column) else F.lit(value)
        out = F.when(cond, v) if out is None else out.when(cond, v)
    if out is None:
        return default if isinstance(default, Column) else F.lit(default)
    if default is None:
        return out
    return out.otherwise(default if isinstance(default, Column) else F.lit(default))


def mail_domain(email: Column) -> Column:
    """Lower-cased text after the first '@'; the whole text when there is none."""
    low = F.lower(email)
    return F.when(email.isNotNull(), low.substr(F.locate("@", low) + 1, F.length(low)))


def _wall_seconds(ts: Column) -> Column:
    """Seconds since 1970-01-01 00:00 of a wall-clock timestamp, fraction dropped (no time zone)."""
    return (F.unix_date(ts.cast("date")).cast("long") * 86400 + F.hour(ts) * 3600 + F.minute(ts) * 60
            + F.second(ts))


def seconds_between(start: Column, end: Column) -> Column:
    """Whole-second boundaries crossed from ``start`` to ``end`` (T-SQL DATEDIFF(second)).

    Computed on the wall-clock fields, so the session time zone (and its
    daylight-saving jumps) cannot change the answer.
    """
    return _wall_seconds(end) - _wall_seconds(start)


# Fixed values that must equal the reference's: accepted spellings of a flag.
TRUE_WORDS = ("1", "Y", "YES", "TRUE")
FALSE_WORDS = ("0", "N", "NO", "FALSE")


def parse_flag(c: Column) -> Column:
    """Text flag to boolean: case- and blank-insensitive; anything else is NULL."""
    t = F.upper(F.trim(c.cast("string")))
    return F.when(t.isin(*TRUE_WORDS), F.lit(True)).when(t.isin(*FALSE_WORDS), F.lit(False))


def pick(key: Column, values: Iterable[object]) -> Column:
    """Deterministic choice ``values[key % n]`` (used by the test fixtures)."""
    vals = list(values)
    arr = F.array(*[F.lit(v).cast("string") if v is None else F.lit(v) for v in vals])
    return F.element_at(arr, F.pmod(key, F.lit(len(vals))).cast("int") + F.lit(1))


def key_text(prefix: str, *parts: Column, sep: str = "-") -> Column:
    """``prefix || p1 || sep || p2 ...``; NULL when any part is NULL."""
    items: list[Column] = [F.lit(prefix)]
    for i, p in enumerate(parts):
        if i:
            items.append(F.lit(sep))
        items.append(p.cast("string"))
    return F.concat(*items)
