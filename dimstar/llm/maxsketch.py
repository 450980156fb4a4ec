"""Ranked lexical search by hashed max-sketches and exact rescoring.

A document's impact of a term is its score for a weight of 1, a number that
depends on the term's count and the document's length alone.  The sketch of
a document hashes its terms to coordinates and keeps the largest impact of
each, so it never understates a term.  For a batch of queries, the weights
of a query's terms times the coordinates they hash to sum up to a bound that
the document's score cannot exceed.

Each query takes documents in descending order of their bounds and scores
them exactly, from the text, until the score in its k-th place is above the
next bound.  A round takes a chunk of documents for all queries at once, as a
Spark job; the chunks grow, so that few rounds are needed.  A first pass
over the index gives each task's best bounds only; the k-th best score among
those is the threshold below which a second pass leaves documents out.

Documents of equal term sequences have equal scores, and of each such group
only the k smallest ids can be answers: the index holds no more of them.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import blake2b
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dimstar.llm.common import binary, index_rows, map_texts, materialize, reachable

# Terms are runs of code points other than ASCII controls, spaces and signs; A-Z count as a-z.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or 48 <= c <= 57 or c > 127 else 32 for c in range(256))
LEVELS = 64  # ranges of bounds between a number and its double
PAIRS = "item long, doc_id long, bound long"


@dataclass(frozen=True)
class Params:
    k: int = 50
    coordinates: int = 1 << 14  # of a sketch
    items: int = 4096  # queries that are answered together
    rows: int = 1024  # documents whose bounds are in memory together
    chunk: int = 256  # documents that a query rescores in its first round after the threshold
    growth: int = 8  # chunks grow by this factor
    broadcast_rows: int = 1_000_000  # ids of documents are broadcast up to so many


def terms(text: bytes | None) -> list[bytes]:
    """The terms of a UTF-8 text, in order."""
    return text.translate(_TABLE).split() if text else []


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def length_part(n: int, n_docs: int, n_terms: int) -> int:
    return 50 + (50 * n * n_docs) // n_terms


def impact(tf: int, m: int) -> int:
    return (1_000_000_000 * tf) // (1000 * tf + 20 * m)


@dataclass
class Statistics:
    n_docs: int
    n_terms: int
    df: dict[bytes, int]


def statistics(docs: DataFrame, wanted: list[bytes], text: str = "text") -> Statistics:
    """Documents with a term, all terms, and in how many documents each wanted term is; counted within tasks first."""
    spark = docs.sparkSession
    reachable(spark)
    places = spark.sparkContext.broadcast({t: i + 2 for i, t in enumerate(wanted)})  # of one block of queries

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, found = places.value, Counter()
        for b in batches:
            for t in binary(b.column(0)).to_pylist():
                words = terms(t)
                if words:
                    found[0] += 1
                    found[1] += len(words)
                    found.update(known[w] for w in known.keys() & set(words))
        yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int64()), pa.array(list(found.values()), pa.int64())], ["place", "n"])

    parts = docs.select(F.col(f"`{text}`")).mapInArrow(run, "place long, n long")
    got = {r["place"]: r["n"] for r in parts.groupBy("place").agg(F.sum("n").alias("n")).collect()}
    places.unpersist()
    return Statistics(got.get(0, 0), got.get(1, 0), {t: got.get(i + 2, 0) for i, t in enumerate(wanted)})


def fold(counts: Counter, m: int, coordinates: int) -> tuple[np.ndarray, np.ndarray]:
    """The sketch of a document: its coordinates in use, and the largest impact of each."""
    at = np.fromiter((crc32(w) % coordinates for w in counts), np.int64, len(counts))
    tf = np.fromiter(counts.values(), np.int64, len(counts))
    out = np.zeros(coordinates, np.int64)
    np.maximum.at(out, at, (1_000_000_000 * tf) // (1000 * tf + 20 * m))
    used = np.flatnonzero(out)
    return used, out[used]


def index(docs: DataFrame, n_docs: int, n_terms: int, key: str = "doc_id", text: str = "text", params: Params = Params()) -> DataFrame:
    """doc_id, at, top: the sketch of each document with a term; of equal term sequences the ``k`` smallest ids.

    Needs the corpus only for the number of its documents and terms, not for
    any query.  NULL ids count as larger than all others.
    """
    coordinates = params.coordinates

    def make():
        def work(column: pa.Array) -> dict:
            same, ats, tops = [], [], []
            for t in binary(column).to_pylist():
                words = terms(t)
                if not words:
                    same.append(None), ats.append(None), tops.append(None)
                    continue
                used, top = fold(Counter(words), length_part(len(words), n_docs, n_terms), coordinates)
                same.append(blake2b(b" ".join(words), digest_size=16).digest())
                ats.append(used.astype("<i4").tobytes())
                tops.append(top.astype("<i4").tobytes())
            return {"same": pa.array(same, pa.binary()), "at": pa.array(ats, pa.binary()), "top": pa.array(tops, pa.binary())}

        return work

    made = map_texts(docs, [key], text, "same binary, at binary, top binary", make).where(F.col("same").isNotNull())
    place = F.row_number().over(Window.partitionBy("same").orderBy(F.asc_nulls_last(key)))
    kept = made.withColumn("place", place).where(F.col("place") <= params.k)
    return materialize(kept.select(F.col(key).cast("long").alias("doc_id"), "at", "top"), "sketches")


class Lookup:
    """The weights of a batch of queries by coordinate."""

    def __init__(self, queries: list[dict[bytes, int]], coordinates: int):
        self.n = len(queries)
        found: dict[int, Counter] = {}
        for q, weights in enumerate(queries):
            for term, w in weights.items():
                found.setdefault(crc32(term) % coordinates, Counter())[q] += w
        sizes = np.zeros(coordinates + 1, np.int64)
        for at, by in found.items():
            sizes[at + 1] = len(by)
        self.first = np.cumsum(sizes)
        order = sorted(found)
        self.query = np.array([q for at in order for q in found[at]], np.int64)
        self.weight = np.array([w for at in order for w in found[at].values()], np.int64)

    def bounds(self, ats: list[bytes], tops: list[bytes]) -> np.ndarray:
        """Documents x queries: sums of weight times coordinate.  Exact: all sums are integers below 2^53."""
        sizes = np.fromiter((len(a) // 4 for a in ats), np.int64, len(ats))
        at, top = np.frombuffer(b"".join(ats), "<i4"), np.frombuffer(b"".join(tops), "<i4").astype(np.int64)
        row = np.repeat(np.arange(len(ats)), sizes)
        many = self.first[at + 1] - self.first[at]
        hit = np.flatnonzero(many)
        many = many[hit]
        place = np.repeat(self.first[at[hit]] - np.cumsum(many) + many, many) + np.arange(many.sum())
        flat = np.repeat(row[hit], many) * self.n + self.query[place]
        sums = np.bincount(flat, np.repeat(top[hit], many) * self.weight[place].astype(float), len(ats) * self.n)
        return sums.reshape(len(ats), self.n)


def _bounds(sketches: DataFrame, lookup, params: Params, floor=None) -> DataFrame:
    """(item, doc_id, bound): each task's ``k`` largest bounds of each query, or all from ``floor`` up."""
    reachable(sketches.sparkSession)
    k, rows = params.k, params.rows

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for b in batches:
            for i in range(0, b.num_rows, rows):
                part = b.slice(i, rows)
                ids = part.column(0).fill_null(_NULL).to_numpy(zero_copy_only=False)
                yield ids, lookup.value.bounds(part.column(1).to_pylist(), part.column(2).to_pylist())

    def pairs(items: np.ndarray, ids: np.ndarray, bounds: np.ndarray) -> pa.RecordBatch:
        made = pa.array(ids, mask=ids == _NULL)
        return pa.RecordBatch.from_arrays([pa.array(items), made, pa.array(bounds.astype(np.int64))], ["item", "doc_id", "bound"])

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, held = None, None  # k x queries
        for own, bounds in blocks(batches):
            every = np.repeat(own[:, None], bounds.shape[1], axis=1)
            if held is not None:
                bounds, every = np.concatenate([held, bounds]), np.concatenate([ids, every])
            if len(bounds) > k:
                at = np.argpartition(bounds, len(bounds) - k, axis=0)[-k:]
                bounds, every = np.take_along_axis(bounds, at, 0), np.take_along_axis(every, at, 0)
            ids, held = every, bounds
        if held is not None:
            row, item = np.nonzero(held)
            yield pairs(item, ids[row, item], held[row, item])

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for own, bounds in blocks(batches):
            row, item = np.nonzero(bounds >= floor.value)
            if len(row):
                yield pairs(item, own[row], bounds[row, item])

    return sketches.select("doc_id", "at", "top").mapInArrow(best if floor is None else over, PAIRS)


_NULL = -(1 << 63)  # stands for a NULL id inside numpy


def _rescore(docs: DataFrame, pairs: DataFrame, weights, stats: Statistics, params: Params) -> DataFrame:
    """(item, doc_id, score) of the pairs, from the documents' texts."""
    n_docs, n_terms = stats.n_docs, stats.n_terms
    asked = materialize(pairs.groupBy(F.col("doc_id").alias("asked")).agg(F.collect_set("item").alias("items")), "asked")
    if asked.count() <= params.broadcast_rows:
        asked = F.broadcast(asked)
    rows = docs.join(asked, F.col("doc_id").eqNullSafe(F.col("asked"))).select("doc_id", "items", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = weights.value
        for b in batches:
            at, items, scores = [], [], []
            for i, (asking, t) in enumerate(zip(b.column(1).to_pylist(), binary(b.column(2)).to_pylist())):
                words = terms(t)
                if not words:
                    continue
                counts, m = Counter(words), length_part(len(words), n_docs, n_terms)
                parts = {w: impact(tf, m) for w, tf in counts.items()}
                for q in asking:
                    own = queries[q]
                    at.append(i), items.append(q)
                    scores.append(sum(own[w] * parts[w] for w in own.keys() & parts.keys()))
            yield pa.RecordBatch.from_arrays([pa.array(items, pa.int64()), b.column(0).take(pa.array(at, pa.int64())), pa.array(scores, pa.int64())], ["item", "doc_id", "score"])

    return rows.mapInArrow(run, "item long, doc_id long, score long").where(F.col("score") > 0)


def _leading(scored: DataFrame, k: int) -> DataFrame:
    place = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
    return scored.withColumn("rank", place).where(F.col("rank") <= k)


def _thresholds(best: DataFrame, n: int, k: int) -> np.ndarray:
    """The score in the k-th place of each query; 1 where there are fewer (a score of 0 is no answer)."""
    out = np.ones(n)
    for r in best.where(F.col("rank") == k).select("item", "score").collect():
        out[r["item"]] = r["score"]
    return out


def _answer(docs: DataFrame, sketches: DataFrame, queries: list[dict[bytes, int]], stats: Statistics, params: Params) -> DataFrame:
    """(item, doc_id, score, rank) of one batch of queries."""
    context, k = docs.sparkSession.sparkContext, params.k
    weights = context.broadcast(queries)  # a batch: at most ``items`` queries
    lookup = context.broadcast(Lookup(queries, params.coordinates))

    # The first chunk: the k largest bounds of each query give its threshold.
    place = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("bound"), "doc_id"))
    first = _bounds(sketches, lookup, params).withColumn("place", place).where(F.col("place") <= k)
    done = materialize(first.select("item", "doc_id"), "scored-pairs")
    best = materialize(_leading(_rescore(docs, done, weights, stats, params), k), "best")
    floor = _thresholds(best, len(queries), k)

    # All others that may still be answers, a range of bounds after the other, the highest first.
    shared = context.broadcast(floor)
    others = _bounds(sketches, lookup, params, shared).groupBy("item", "doc_id").agg(F.max("bound").alias("bound")).alias("o")
    same = (F.col("o.item") == F.col("d.item")) & F.col("o.doc_id").eqNullSafe(F.col("d.doc_id"))
    level = F.floor(F.log2("bound") * LEVELS).cast("int")
    waiting = materialize(others.join(done.alias("d"), same, "left_anti").withColumn("level", level), "waiting")
    held: list[list[tuple[int, int]]] = [[] for _ in queries]  # of each query: number of pairs by level
    for r in waiting.groupBy("item", "level").count().collect():
        held[r["item"]].append((r["level"], r["count"]))
    for own in held:
        own.sort()
    size = params.chunk
    while True:
        low, high = _next(held, floor, size)
        if not any(a <= b for a, b in zip(low, high)):
            return best
        at = (F.col("item") + 1).cast("int")
        pairs = waiting.where(F.col("level").between(F.element_at(F.lit(low), at), F.element_at(F.lit(high), at)))
        pairs = pairs.where(F.col("bound") >= F.element_at(F.lit(floor.astype(np.int64).tolist()).cast("array<long>"), at))
        found = _rescore(docs, pairs.select("item", "doc_id"), weights, stats, params)
        best = materialize(_leading(best.drop("rank").unionByName(found), k), "best")
        floor = _thresholds(best, len(queries), k)
        size *= params.growth


def _next(held: list[list[tuple[int, int]]], floor: np.ndarray, size: int) -> tuple[list[int], list[int]]:
    """The levels (lowest, highest) of each query's next chunk, taken off ``held``; lowest above highest: none."""
    low, high = [], []
    for own, least in zip(held, floor):
        taken, levels = 0, []
        # The largest bound of a level is below 2^((level + 1) / LEVELS).
        while own and taken < size and 2 ** ((own[-1][0] + 1.001) / LEVELS) >= least:
            at, n = own.pop()
            levels.append(at)
            taken += n
        low.append(levels[-1] if levels else 1)
        high.append(levels[0] if levels else 0)
    return low, high


def search(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id",
           item_text: str = "text", params: Params = Params()) -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` highest-scoring documents of each item.

    An item is all rows of one item_id (NULL included): its terms are those
    of any of them.  Items without terms, or without a document of a score
    above 0, have no rows.  NULL and empty texts have no terms; repeated
    rows of documents are documents each, and rank each; a NULL doc_id comes
    last among equal scores.  Very long texts are read whole.  Other columns
    are not read.  Items are answered in batches of ``items``; a batch comes
    to the driver, documents never do.
    """
    spark = docs.sparkSession
    reachable(spark)
    rows = docs.select(F.col(f"`{key}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    one = items.select(F.col(f"`{item_key}`").alias("item_id"), F.col(f"`{item_text}`").cast("string").alias("t")).where(F.col("t").isNotNull())
    named = index_rows(one.groupBy("item_id").agg(F.sort_array(F.collect_set("t")).alias("texts")))
    total, sketches, out = named.count(), None, None
    for start in range(0, total, params.items):
        batch = named.where((F.col("i") >= start) & (F.col("i") < start + params.items)).orderBy("i").collect()
        words = [list(dict.fromkeys(w for t in r["texts"] for w in terms(t.encode()))) for r in batch]
        stats = statistics(rows, sorted({w for own in words for w in own}))
        if not stats.n_docs:
            break
        if sketches is None:
            sketches = index(rows, stats.n_docs, stats.n_terms, "doc_id", "text", params)
        queries = [{w: x for w in own if stats.df[w] and (x := weight(stats.n_docs, stats.df[w]))} for own in words]
        best = _answer(rows, sketches, queries, stats, params).withColumn("i", F.col("item") + start)
        out = best if out is None else out.unionByName(best)
    if out is None:
        kind = items.schema[item_key].dataType.simpleString()
        return spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    return out.join(named.select("i", "item_id"), "i").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def oracle_sql() -> str:
    """DuckDB SQL of ``search`` over documents and benchmark: every document scored for every item."""
    upper = "".join(map(chr, range(65, 91)))
    found = f"unnest(regexp_extract_all(translate(text, '{upper}', '{upper.lower()}'), '{TERM}')) AS term"
    return f"""
WITH occurrences AS (SELECT doc_id, {found} FROM documents),
counts AS (SELECT doc_id, term, count(*) AS tf FROM occurrences GROUP BY doc_id, term),
lengths AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM counts GROUP BY doc_id),
totals AS (SELECT count(*)::BIGINT AS n_docs, sum(n)::BIGINT AS n_terms FROM lengths),
wanted AS (SELECT DISTINCT item_id, term FROM (SELECT item_id, {found} FROM benchmark)),
weights AS (
    SELECT term, floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1)))::BIGINT AS w
    FROM counts, totals WHERE term IN (SELECT term FROM wanted) GROUP BY term
),
scores AS (
    SELECT item_id, doc_id,
           sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // n_terms))))::BIGINT AS score
    FROM wanted JOIN weights USING (term) JOIN counts USING (term) JOIN lengths USING (doc_id), totals
    GROUP BY item_id, doc_id
),
ranked AS (
    SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS place, doc_id, score
    FROM scores WHERE score > 0
)
SELECT item_id, place::INTEGER AS rank, doc_id, score FROM ranked WHERE place <= 50
"""
