"""URL filter: pattern rules fetched by their rarest literal token.

A rule is a pattern over ``host + path``.  Every rule is filed under one of
its literal tokens, the one that is rarest among the URLs at hand; a URL's
tokens fetch the rules filed under them, and only those run their regular
expression.  All of it is DataFrame work: token counts are one aggregation,
the fetch is an equi-join, the best rule per URL one more aggregation.

Two kinds of rules:

* ``HostRule(verdict, host, path)`` fits the host and its subdomains where
  the path starts with ``path``; the longest fitting one decides.
* ``Pattern(verdict, words)``: the words appear one after another as whole
  tokens, separated by characters that are neither letters nor digits, A-Z
  and a-z alike.  Where no host rule fits, a URL is blocked if a blocking
  pattern matches.

Rules are literal rows of the plan, whatever list they come from: the ones
below, or a table (``from_table``).
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SEPARATORS = "[^A-Za-z0-9]+"


@dataclass(frozen=True)
class HostRule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path

    @property
    def regex(self) -> str:
        return rf"(?s)^([^/]*\.)?{re.escape(self.host)}{re.escape(self.path)}"

    @property
    def tokens(self) -> list[str]:
        """Tokens, in lower case, that any fitting URL has whole: an open end of the path may run on."""
        whole = self.host + self.path
        closed = whole if not whole[-1:].isascii() or not whole[-1:].isalnum() else re.sub(r"[A-Za-z0-9]+$", "", whole)
        return [t for t in re.split(SEPARATORS, lowered(closed)) if t]


@dataclass(frozen=True)
class Pattern:
    verdict: str
    words: tuple[str, ...]

    @property
    def name(self) -> str:
        return "*" + "-".join(self.words) + "*"

    @property
    def regex(self) -> str:
        """Over the URL in lower case."""
        gap = "[^A-Za-z0-9]+"
        return rf"(?s)(^|[^A-Za-z0-9]){gap.join(re.escape(lowered(w)) for w in self.words)}([^A-Za-z0-9]|$)"

    @property
    def tokens(self) -> list[str]:
        return [lowered(w) for w in self.words]


def lowered(s: str) -> str:
    """A-Z as a-z, and nothing else changed."""
    return s.translate(str.maketrans(UPPER, LOWER))


HOST_RULES = (
    HostRule("allow", "com", "/"),
    HostRule("block", "example.com", "/en/"),
    HostRule("allow", "www.example.com", "/en/"),
    HostRule("block", "net", "/es/"),
    HostRule("block", "net", "/fr/"),
)

# Word sequences of unwanted sites (betting, pills, adult, spam, trackers).
PATTERNS = tuple(
    Pattern("block", tuple(words.split()))
    for words in (
        "casino", "poker", "jackpot", "slots", "free bets", "sports bets", "viagra", "cialis", "cheap pills",
        "payday loans", "porn", "xxx", "adult x", "escorts", "spam", "warez", "keygen", "ads track", "adserver",
        "doubleclick", "clicktracker", "phishing", "malware",
    )
)


def from_table(rules: DataFrame) -> tuple[tuple[HostRule, ...], tuple[Pattern, ...]]:
    """Host rules and patterns of a table (verdict, host, path, words).

    Rows with a host are host rules (a NULL path: any); others are patterns
    of their words, split at characters that are neither letters nor digits.
    Rows with neither, or with another verdict than allow or block, are an
    error.  Rules come to the driver: they make up the plan.
    """
    hosts, patterns = [], []
    for r in rules.select("verdict", "host", "path", "words").distinct().orderBy("verdict", "host", "path", "words").collect():
        words = tuple(w for w in re.split(SEPARATORS, r["words"] or "") if w)
        if r["verdict"] not in ("allow", "block") or not (r["host"] or words):
            raise ValueError(f"not a rule: {r.asDict()}")
        if r["host"]:
            hosts.append(HostRule(r["verdict"], lowered(r["host"]), r["path"] or ""))
        else:
            patterns.append(Pattern(r["verdict"], words))
    return tuple(hosts), tuple(patterns)


def _literal(spark, rows: list[tuple], names: list[str]) -> DataFrame:
    """A table of literal rows, made by the plan itself."""
    return spark.range(1).select(F.inline(F.array(*[F.struct(*[F.lit(v).alias(n) for v, n in zip(r, names)]) for r in rows])))


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty without ``://`` or URL."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substr(url, at + F.lit(3))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def judge(pages: DataFrame, key: str = "page_id", url: str = "url", rules=HOST_RULES, patterns=PATTERNS,
          default: str = "allow") -> DataFrame:
    """One row per input row: key, host, path, rule, verdict, pattern.

    * rule: name of the longest fitting host rule, NULL if none fits;
    * verdict: that rule's; else ``block`` if a pattern matches, else ``default``;
    * pattern: the smallest name of the matching patterns, NULL if none.

    NULL or malformed URLs: empty host and path, no rule, the default.
    Repeated rows give repeated rows; other columns of the input are ignored.
    Very long URLs are judged whole; an empty table gives an empty result.
    """
    spark = pages.sparkSession
    host, path = host_and_path(F.col(f"`{url}`"))
    rows = pages.select(F.col(f"`{key}`").alias(key), host.alias("host"), path.alias("path"))
    everything = [*rules, *patterns]
    if not everything:
        none = F.lit(None).cast("string")
        return rows.select(key, "host", "path", none.alias("rule"), F.lit(default).alias("verdict"), none.alias("pattern"))

    # A place (host and path) is judged once, however many pages have it.
    places = rows.select("host", "path").where("host != '' or path != ''").distinct()
    whole = F.concat("host", "path")
    tokens = places.select("host", "path", F.explode(F.array_distinct(F.split(F.translate(whole, UPPER, LOWER), SEPARATORS))).alias("token"))

    # The counts of the rules' own tokens: as many rows as rules have tokens.
    literal = sorted({t for r in everything for t in r.tokens})
    mine = _literal(spark, [(t,) for t in literal], ["token"])
    seen = tokens.groupBy("token").agg(F.count("*").alias("n")).join(mine, "token")
    counts = {r["token"]: r["n"] for r in seen.collect()}
    index = _literal(
        spark,
        [
            (min(r.tokens, key=lambda t: (counts.get(t, 0), t)), r.name, r.regex, r.verdict, isinstance(r, HostRule))
            for r in everything
        ],
        ["token", "name", "regex", "ruling", "by_host"],
    )
    best = (
        tokens.join(index, "token")
        .where(F.expr(f"CASE WHEN by_host THEN concat(host, path) ELSE translate(concat(host, path), '{UPPER}', '{LOWER}') END rlike regex"))
        .groupBy("host", "path")
        .agg(
            F.max(F.when(F.col("by_host"), F.struct(F.length("name").alias("size"), "name", "ruling"))).alias("fit"),
            F.min(F.when(~F.col("by_host") & (F.col("ruling") == "block"), F.col("name"))).alias("pattern"),
        )
    )
    return rows.join(best, ["host", "path"], "left").select(
        key, "host", "path", F.col("fit.name").alias("rule"),
        F.coalesce(F.col("fit.ruling"), F.when(F.col("pattern").isNotNull(), F.lit("block")), F.lit(default)).alias("verdict"),
        "pattern",
    )


def _quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def oracle_sql(rules=HOST_RULES, patterns=PATTERNS) -> str:
    """DuckDB SQL for ``judge(pages)``: every rule tried on every URL."""
    rule_rows = ", ".join(f"({_quoted(r.host)}, {_quoted(r.path)}, {_quoted(r.verdict)})" for r in rules)
    pattern_rows = ", ".join(f"({_quoted(p.name)}, {_quoted(' '.join(p.tokens))})" for p in patterns)
    return f"""
WITH rest AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r FROM pages
), parts AS (
  SELECT row_number() OVER () AS i, page_id,
         translate(regexp_extract(coalesce(r, ''), '^[^/?#]*'), '{UPPER}', '{LOWER}') AS host,
         regexp_extract(coalesce(r, ''), '^[^/?#]*([^?#]*)', 1) AS path FROM rest
), fits AS (
  SELECT i, h || p AS rule, v, row_number() OVER (PARTITION BY i ORDER BY length(h || p) DESC) AS k
  FROM parts, (VALUES {rule_rows}) AS t(h, p, v)
  WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
), spelt AS (
  SELECT i, ' ' || regexp_replace(translate(host || path, '{UPPER}', '{LOWER}'), '{SEPARATORS}', ' ', 'g') || ' ' AS s FROM parts
), hits AS (
  SELECT i, min(name) AS pattern FROM spelt, (VALUES {pattern_rows}) AS t(name, words)
  WHERE contains(s, ' ' || words || ' ') GROUP BY i
)
SELECT page_id, host, path, rule, coalesce(v, CASE WHEN pattern IS NOT NULL THEN 'block' END, 'allow') AS verdict, pattern
FROM parts LEFT JOIN fits ON fits.i = parts.i AND k = 1 LEFT JOIN hits ON hits.i = parts.i
"""
