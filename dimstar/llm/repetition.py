"""Quality rules on repetition, from a suffix array over the words of each text.

Inside a task, the texts of an Arrow batch are taken in blocks of bounded
size (one text at least).  One suffix array is built for a block by prefix
doubling in numpy: the first rank of a word is that of the pair (text,
word), so suffixes of different texts never share a prefix.  Only suffixes
that are still tied are sorted again.  The ranks of each doubling step are
kept; descending through them gives the longest common prefix of neighbours
in suffix order.  A position's longest match is the larger of the two, and
the spans [i, i + match) are the maximal repeated substrings' occurrences;
their union is the covered part of the text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from dimstar.llm.common import binary, keep_rows, map_texts

BLOCK_WORDS = 200_000


@dataclass(frozen=True)
class Rules:
    """Limits of the verdict.  A share is of the text's words, in percent."""

    min_words: int = 10
    window: int = 5  # shortest repeat that counts as covering
    max_covered_percent: int = 20
    max_longest: int = 200  # words in the longest repeated substring


def longest_matches(words: np.ndarray, text: np.ndarray, end: np.ndarray) -> np.ndarray:
    """For each position, how many words from there on occur once more in the same text.

    words: word codes of a block; text: index of each position's text;
    end: first position after that text.
    """
    n = len(words)
    if n == 0:
        return np.zeros(0, np.int64)
    pair = text.astype(np.int64) * (int(words.max()) + 1) + words
    order = np.argsort(pair, kind="stable")
    new = np.r_[True, pair[order][1:] != pair[order][:-1]]
    # A rank is the number of suffixes before the first of its equals.
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    levels, h = [rank], 1
    tied = np.flatnonzero(np.bincount(rank, minlength=n)[rank] > 1)
    while len(tied):
        there = tied + h
        second = np.where(there < end[tied], rank[np.minimum(there, n - 1)], -1)
        first = rank[tied]
        order = np.lexsort((second, first))
        a, b, at = first[order], second[order], np.arange(len(order))
        group = np.r_[True, a[1:] != a[:-1]]
        new = group | np.r_[True, b[1:] != b[:-1]]
        start = np.maximum.accumulate(np.where(group, at, 0))
        equal = np.maximum.accumulate(np.where(new, at, 0))
        rank = rank.copy()
        rank[tied[order]] = a + equal - start
        levels.append(rank)
        size = np.bincount(np.cumsum(new) - 1)
        tied = np.sort(tied[order][size[np.cumsum(new) - 1] > 1])
        h *= 2

    suffix = np.empty(n, np.int64)
    suffix[rank] = np.arange(n)
    same = levels[0][suffix[1:]] == levels[0][suffix[:-1]]
    left, right = suffix[:-1][same], suffix[1:][same]
    common = np.zeros(len(left), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        a, b = left + common, right + common
        ok = (a < end[left]) & (b < end[right])
        ok &= levels[k][np.minimum(a, n - 1)] == levels[k][np.minimum(b, n - 1)]
        common += ok * (1 << k)
    match = np.zeros(n, np.int64)
    np.maximum.at(match, left, common)
    np.maximum.at(match, right, common)
    return match


def covered_spans(match: np.ndarray, window: int) -> np.ndarray:
    """Whether each position lies in a repeated substring of ``window`` words or more."""
    at = np.flatnonzero(match >= window)
    step = np.zeros(len(match) + 1, np.int64)
    step[at] += 1
    np.add.at(step, at + match[at], -1)
    return np.cumsum(step[:-1]) > 0


def _blocks(texts: list[bytes | None]) -> Iterator[tuple[int, list[list[bytes]]]]:
    """Consecutive texts as word lists, ``BLOCK_WORDS`` words or one text at a time."""
    first, block, size = 0, [], 0
    for i, t in enumerate(texts):
        words = t.split() if t else []  # bytes.split() splits at space and U+0009 to U+000D alone
        if block and size + len(words) > BLOCK_WORDS:
            yield first, block
            first, block, size = i, [], 0
        block.append(words)
        size += len(words)
    if block:
        yield first, block


def measure(column: pa.Array, window: int) -> dict[str, np.ndarray]:
    """Per text: n_words, n_repeat_words (covered) and longest_repeat, in words."""
    texts = binary(column).to_pylist()
    out = {k: np.zeros(len(texts), np.int64) for k in ("n_words", "n_repeat_words", "longest_repeat")}
    for first, block in _blocks(texts):
        sizes = np.array([len(x) for x in block], np.int64)
        ids: dict[bytes, int] = {}
        words = np.array([ids.setdefault(w, len(ids)) for x in block for w in x], np.int64)
        text = np.repeat(np.arange(len(block)), sizes)
        end = np.repeat(np.cumsum(sizes), sizes)
        match = longest_matches(words, text, end)
        here = slice(first, first + len(block))
        out["n_words"][here] = sizes
        out["n_repeat_words"][here] = np.bincount(text[covered_spans(match, window)], minlength=len(block))
        longest = np.zeros(len(block), np.int64)
        np.maximum.at(longest, text, match)
        out["longest_repeat"][here] = longest
    return out


def repeated_spans(text: str | None, window: int = Rules.window) -> list[tuple[int, int]]:
    """The union of the repeated substrings of one text, as [first, last) word positions."""
    words = text.encode().split() if text else []
    ids: dict[bytes, int] = {}
    codes = np.array([ids.setdefault(w, len(ids)) for w in words], np.int64)
    match = longest_matches(codes, np.zeros(len(codes), np.int64), np.full(len(codes), len(codes)))
    edge = np.diff(np.r_[0, covered_spans(match, window).astype(int), 0])
    return list(zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist()))


def _per_text(column: pa.Array, weight: np.ndarray) -> np.ndarray:
    """Sums of a byte's weight (a table of 256) over each text."""
    col = binary(column)
    bounds = np.frombuffer(col.buffers()[1], np.int32)[col.offset : col.offset + len(col) + 1].astype(np.int64)
    data = np.frombuffer(col.buffers()[2] or b"", np.uint8)
    out = np.zeros(len(col), np.int64)
    full = np.flatnonzero(bounds[1:] > bounds[:-1])
    if len(full):
        out[full] = np.add.reduceat(weight[data[: bounds[-1]]], bounds[:-1][full], dtype=np.int64)
    return out


def _weights(bytes_: bytes) -> np.ndarray:
    w = np.zeros(256, np.uint8)
    w[list(bytes_)] = 1
    return w


# The symbols counted, white space, and the bytes that continue a code point.
SYMBOLS = _weights(b"#*$%&|<>")
SPACES = _weights(b" \t\n\x0b\x0c\r")
CONTINUES = _weights(bytes(range(0x80, 0xC0)))


def _dup_lines(text: bytes | None) -> int:
    lines = [x for x in (text or b"").split(b"\n") if x.strip()]
    return len(lines) - len(set(lines))


def _verdict(made: dict[str, np.ndarray], rules: Rules) -> tuple[np.ndarray, np.ndarray]:
    n, covered = made["n_words"], made["n_repeat_words"]
    failed = (n < rules.min_words) | (100 * covered > rules.max_covered_percent * n)
    return failed, ~failed & (made["longest_repeat"] <= rules.max_longest)


def judge(docs: DataFrame, key: str = "doc_id", text: str = "text", rules: Rules = Rules()) -> DataFrame:
    """One row per row: key, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    longest_repeat, base_failed, kept.

    base_failed: fewer than ``min_words`` words, or more than
    ``max_covered_percent`` of them inside repeats of ``window`` words or
    more.  kept: not base_failed, and the longest repeat is within
    ``max_longest``.  NULL and empty texts have no words: base_failed, not
    kept.  Repeated rows give repeated rows; an empty table gives an empty
    result.
    """

    def make():
        def work(column: pa.Array) -> dict:
            made = measure(column, rules.window)
            failed, kept = _verdict(made, rules)
            chars = _per_text(column, 1 - SPACES - CONTINUES)
            return {
                "n_words": made["n_words"],
                "word_chars": chars,
                "n_symbols": _per_text(column, SYMBOLS),
                "n_dup_lines": pa.array([_dup_lines(t) for t in binary(column).to_pylist()], pa.int64()),
                "n_repeat_words": made["n_repeat_words"],
                "longest_repeat": made["longest_repeat"],
                "base_failed": failed,
                "kept": kept,
            }

        return work

    schema = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
              "longest_repeat long, base_failed boolean, kept boolean")
    return map_texts(docs, [key], text, schema, make)


def keep(docs: DataFrame, text: str = "text", rules: Rules = Rules()) -> DataFrame:
    """The documents that the rules keep, with all their columns."""

    def make():
        return lambda column: pa.array(_verdict(measure(column, rules.window), rules)[1])

    return keep_rows(docs, text, make)


def oracle_sql(rules: Rules = Rules()) -> str:
    """DuckDB SQL for ``judge(documents)`` without longest_repeat, by comparing windows."""

    def windows(k: int) -> str:
        return f"""SELECT i, p FROM (
    SELECT i, p, count(*) OVER (PARTITION BY i, s) AS c FROM (
      SELECT i, p, array_to_string(w[p:p + {k - 1}], ' ') AS s
      FROM (SELECT i, w, unnest(range(1, len(w) - {k - 2})) AS p FROM d WHERE len(w) >= {k}))) WHERE c > 1"""

    return f"""
WITH d AS (
  SELECT row_number() OVER () AS i, doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), twice AS ({windows(rules.window)}
), covered AS (
  SELECT i, count(DISTINCT p + k) AS n FROM twice, range({rules.window}) AS r(k) GROUP BY i
), long AS (SELECT DISTINCT i FROM ({windows(rules.max_longest + 1)})
), lines AS (
  SELECT i, sum(c - 1) AS n FROM (
    SELECT i, s, count(*) AS c FROM (SELECT i, unnest(string_split(t, chr(10))) AS s FROM d)
    WHERE regexp_matches(s, '[^\\x20\\x09-\\x0D]') GROUP BY i, s) GROUP BY i
), base AS (
  SELECT d.i, doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, coalesce(lines.n, 0)::BIGINT AS n_dup_lines,
         coalesce(covered.n, 0)::BIGINT AS n_repeat_words
  FROM d LEFT JOIN covered ON covered.i = d.i LEFT JOIN lines ON lines.i = d.i
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < {rules.min_words} OR 100 * n_repeat_words > {rules.max_covered_percent} * n_words AS base_failed,
       NOT (n_words < {rules.min_words} OR 100 * n_repeat_words > {rules.max_covered_percent} * n_words)
         AND NOT EXISTS (FROM long WHERE long.i = base.i) AS kept
FROM base
"""
