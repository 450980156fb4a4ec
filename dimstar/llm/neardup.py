"""Near-duplicates of word shingles: MinHash with tensored banding, exact verification.

Tensored banding: two collections of ``sketches`` sketches, each of ``width``
minhashes.  A table key joins one sketch of either collection, so
2 * sketches * width minhashes serve sketches^2 tables, about the square root
of what as many independent tables of that width would need.  Two documents
are candidates if they agree on a sketch of both collections.

Documents of equal shingle sets are one node, which takes care of copies.
Candidate pairs are confirmed on whole sets, in two steps that leave out
only pairs which are linked already:

1. in every bucket, each node is compared with the bucket's centre, the node
   that the most and largest buckets hold; confirmed links make components;
2. pairs of a bucket whose nodes are still in different components are
   compared, whatever their number.  A row of one-bit minhashes of either
   node comes first: pairs that differ in many more bits than a link would
   (``slack`` standard deviations) are no link and are not compared further.
   A bucket of more than ``side`` nodes (texts with the same boilerplate that
   are no links, say) is cut into parts of about that size, and each two parts
   meet in a cell of their own: no task holds more than a cell at a time.

So two documents that share a bucket end up in one component, or have been
compared on their whole sets, or differ in so many bits that they are no link:
a pair at the threshold fails that filter with a probability of 3e-6.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dimstar.llm.common import binary, map_texts, materialize, reachable

BLOCK_WORDS = 200_000
BROADCAST_IDS = 1_000_000  # at most so many ids (8 MB) are broadcast


@dataclass(frozen=True)
class Params:
    words: int = 5  # of a shingle
    percent: int = 75  # least similarity of a link
    sketches: int = 14  # in either collection
    width: int = 2  # minhashes of a sketch
    bits: int = 2048  # one-bit minhashes of a node with open pairs
    slack: float = 4.5
    side: int = 1024  # nodes on a side of a cell in which the pairs of a bucket are compared
    seed: int = 3


def _mix(x: np.ndarray) -> np.ndarray:
    """A finalizer that spreads every bit of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _blocks(column: pa.Array) -> Iterator[tuple[int, list[list[bytes]]]]:
    first, block, size = 0, [], 0
    for i, t in enumerate(binary(column).to_pylist()):
        words = t.lower().split() if t else []  # of bytes: A-Z alone, and white space of ASCII alone
        if block and size + len(words) > BLOCK_WORDS:
            yield first, block
            first, block, size = i, [], 0
        block.append(words)
        size += len(words)
    if block:
        yield first, block


def shingle_sets(block: list[list[bytes]], words: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of consecutive texts, ascending in each, and how many each text has."""
    sizes = np.array([len(x) for x in block], np.int64)
    codes: dict[bytes, int] = {}
    at = np.array([codes.setdefault(w, len(codes)) for x in block for w in x], np.int64)
    if not len(at):
        return np.zeros(0, np.uint64), np.zeros(len(block), np.int64)
    word = np.array([xxhash.xxh64_intdigest(w) for w in codes], np.uint64)[at]
    n = len(word)
    text = np.repeat(np.arange(len(block)), sizes)
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(n)  # words from here to the end of the text
    length = np.minimum(sizes, words)[text]
    first = left >= length
    first &= (sizes[text] >= words) | (left == sizes[text])
    value = length.astype(np.uint64)
    for k in range(words):
        step = np.zeros(n, np.uint64)
        step[: n - k] = word[k:]
        value = np.where(k < length, _mix(value * np.uint64(0x9E3779B97F4A7C15) + step), value)
    value, text = value[first], text[first]
    order = np.lexsort((value, text))
    value, text = value[order], text[order]
    new = np.r_[True, (value[1:] != value[:-1]) | (text[1:] != text[:-1])]
    return value[new], np.bincount(text[new], minlength=len(block)).astype(np.int64)


def _minhashes(value: np.ndarray, sizes: np.ndarray, number: int, seed: int) -> np.ndarray:
    """texts x number: smallest products with random odd factors; texts without shingles: 0."""
    factors = np.random.default_rng(seed).integers(0, 1 << 63, number, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    out = np.zeros((len(sizes), number), np.uint64)
    full = np.flatnonzero(sizes)
    starts = (np.cumsum(sizes) - sizes)[full]
    if len(full):
        for k, f in enumerate(factors):
            out[full, k] = np.minimum.reduceat(value * f, starts)
    return out


def profiles(docs: DataFrame, key: str = "doc_id", text: str = "text", params: Params = Params()) -> DataFrame:
    """key, n_shingles, h1, h2 (a hash of the set), left and right (sketches of both collections)."""

    def make():
        def work(column: pa.Array) -> dict:
            m, w = params.sketches, params.width
            parts = []
            for _, block in _blocks(column):
                value, sizes = shingle_sets(block, params.words)
                low = _minhashes(value, sizes, 2 * m * w, params.seed).reshape(len(block), 2 * m, w)
                sketch = np.zeros((len(block), 2 * m), np.uint64)
                for k in range(w):
                    sketch = _mix(sketch + low[:, :, k])
                sketch = _mix(sketch + np.arange(1, 2 * m + 1, dtype=np.uint64))  # the same value in another slot is another key
                h = np.zeros((2, len(block)), np.uint64)
                full = np.flatnonzero(sizes)
                if len(full):
                    starts = (np.cumsum(sizes) - sizes)[full]
                    for i in (0, 1):
                        h[i, full] = np.add.reduceat(_mix(value + np.uint64(i + 1)), starts)
                parts.append((sizes, h[0], h[1], sketch[:, :m], sketch[:, m:]))
            n, h1, h2, left, right = (np.concatenate(x) for x in zip(*parts))

            def lists(x: np.ndarray) -> pa.Array:
                return pa.FixedSizeListArray.from_arrays(pa.array(x.view(np.int64).ravel()), x.shape[1]).cast(pa.list_(pa.int64()))

            return {"n_shingles": n, "h1": h1.view(np.int64), "h2": h2.view(np.int64), "left": lists(np.ascontiguousarray(left)), "right": lists(np.ascontiguousarray(right))}

        return work

    return map_texts(docs, [key], text, "n_shingles long, h1 long, h2 long, left array<long>, right array<long>", make)


def _sets(docs: DataFrame, ids: DataFrame, key: str, text: str, params: Params) -> DataFrame:
    """node, grams: the sorted shingle hashes of the documents that stand for ``ids`` (node)."""
    chosen = docs.select(F.col(f"`{key}`").alias("node"), F.col(f"`{text}`").alias("text")).join(_few(ids), "node", "left_semi")

    def make():
        def work(column: pa.Array) -> dict:
            out = []
            for _, block in _blocks(column):
                value, sizes = shingle_sets(block, params.words)
                out += [x.tobytes() for x in np.split(value, np.cumsum(sizes)[:-1])]
            return {"grams": pa.array(out, pa.binary())}

        return work

    return map_texts(chosen, ["node"], "text", "grams binary", make).dropDuplicates(["node"])


def _bits(sets: DataFrame, ids: DataFrame, params: Params) -> tuple[DataFrame, list[str]]:
    """node and columns of 64 one-bit minhashes each, for the nodes in ``ids``; the columns' names."""
    factors = np.random.default_rng(params.seed + 1).integers(0, 1 << 63, params.bits, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def make():
        def signature(grams: bytes) -> np.ndarray:
            value, low = np.frombuffer(grams, np.uint64), np.full(len(factors), np.iinfo(np.uint64).max)
            for i in range(0, len(value), 64):
                np.minimum(low, (value[i : i + 64, None] * factors).min(axis=0), out=low)
            return np.packbits((_mix(low) & np.uint64(1)).astype(np.uint8)).view(np.int64)

        return lambda column: {"bits": pa.array([signature(g) for g in column.to_pylist()], pa.list_(pa.int64()))}

    names = [f"b{i}" for i in range(params.bits // 64)]
    made = map_texts(sets.join(ids, "node", "left_semi"), ["node"], "grams", "bits array<long>", make)
    return made.select("node", *(F.col("bits")[i].alias(n) for i, n in enumerate(names))), names


def _confirm(pairs: DataFrame, sets: DataFrame, params: Params) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough."""
    reachable(pairs.sparkSession)
    percent = params.percent
    rows = pairs.join(sets.select(F.col("node").alias("b"), F.col("grams").alias("gb")), "b")
    rows = rows.join(sets.select(F.col("node").alias("a"), F.col("grams").alias("ga")), "a").select("a", "b", "ga", "gb")

    def similar(x: bytes, y: bytes) -> bool:
        x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
        if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
            return False
        both = np.concatenate((x, y))
        both.sort(kind="stable")
        common = int((both[1:] == both[:-1]).sum())
        return 100 * common >= percent * (len(both) - common)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = pa.array([similar(x, y) for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())], pa.bool_())
            yield pa.RecordBatch.from_arrays(batch.columns[:2], ["a", "b"]).filter(ok)

    return rows.mapInArrow(run, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """node, root: for each node of the links (a, b) the smallest node it is connected with.

    Alternates two steps until nothing changes: every larger neighbour of a
    node is hooked to the node's smallest neighbour, then every smaller one.
    """

    def digest(edges: DataFrame) -> tuple:
        return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())

    edges = materialize(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct(), "edges")
    seen = digest(edges)
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        large = materialize(large, "edges")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        ends = large.join(low, "u").select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
        edges = materialize(ends.where("u != v").distinct(), "edges")
        now = digest(edges)
        if now == seen:
            break
        seen = now
    roots = edges.select(F.col("v").alias("node")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots.select("node", F.col("node").alias("root")))


def _similar_size(n: Column, other: Column, percent: int) -> Column:
    return (100 * F.least(n, other) >= percent * F.greatest(n, other))


def cells(members: DataFrame, side: int) -> tuple[DataFrame, DataFrame]:
    """Two copies of the rows (node, value, n), dealt over the cells (value, row, col) of their buckets.

    A bucket of n nodes has about n / ``side`` parts.  A node of part p stands
    in the first frame in the cells (p, p), (p, p + 1), ... and in the second
    in (0, p), ..., (p, p), so two nodes of different parts meet in one cell
    and those of the same part in its own, either way round.
    """
    parts = F.ceil(F.col("n") / F.lit(side)).cast("int")
    placed = members.withColumn("part", F.pmod(F.xxhash64("node", F.lit(side)), parts).cast("int")).withColumn("parts", parts)
    rows = placed.withColumn("col", F.explode(F.sequence("part", F.col("parts") - 1))).withColumn("row", F.col("part"))
    cols = placed.withColumn("row", F.explode(F.sequence(F.lit(0), F.col("part")))).withColumn("col", F.col("part"))
    return rows.drop("part", "parts", "n"), cols.drop("part", "parts", "n")


def nodes_and_roots(docs: DataFrame, key: str, text: str, params: Params) -> tuple[DataFrame, DataFrame]:
    """The profiles of the documents with their nodes, and the roots of linked nodes."""
    spark = docs.sparkSession
    profile = materialize(profiles(docs, key, text, params).withColumnRenamed(key, "id"), "profiles")
    filled = profile.where((F.col("n_shingles") > 0) & F.col("id").isNotNull())
    same = filled.groupBy("h1", "h2").agg(F.min(F.struct("id", "n_shingles", "left", "right")).alias("x"))
    nodes = materialize(same.select("h1", "h2", F.col("x.id").alias("node"), "x.n_shingles", "x.left", "x.right"), "nodes")

    # Sketches that several nodes have, then keys of both collections that several nodes have.
    m = params.sketches
    sketches = nodes.select("node", F.posexplode(F.concat("left", "right")).alias("slot", "value"))
    shared = sketches.groupBy("value").agg(F.count("*").alias("n")).where("n > 1").select("value")
    alive = sketches.join(shared, "value", "left_semi").groupBy("node").agg(
        F.sort_array(F.collect_list(F.when(F.col("slot") < m, F.col("value")))).alias("left"),
        F.sort_array(F.collect_list(F.when(F.col("slot") >= m, F.col("value")))).alias("right"),
    )
    alive = materialize(alive.where("size(left) > 0 and size(right) > 0"), "alive")
    keys = alive.select("node", F.explode("left").alias("x"), "right").select("node", F.explode(F.transform("right", lambda y: F.xxhash64("x", y))).alias("key"))
    keys = materialize(keys, "keys")
    held = keys.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    rank = keys.join(held, "key").groupBy("node").agg(F.round(F.sum(F.log("n")), 6).alias("rank"))
    rank = materialize(rank, "ranks")

    # Step 1: every node of a bucket against its centre.
    ranked = keys.join(rank, "node")
    centre = ranked.groupBy("key").agg(F.max(F.struct("rank", -F.col("node"))).alias("c"), F.count("*").alias("n")).where("n > 1")
    centre = centre.select("key", (-F.col("c.col2")).alias("a"))
    star = keys.join(centre, "key").where("node != a").select("a", F.col("node").alias("b")).distinct()
    size = nodes.select("node", "n_shingles")
    star = star.join(size.toDF("a", "na"), "a").join(size.toDF("b", "nb"), "b").where(_similar_size(F.col("na"), F.col("nb"), params.percent))
    star = materialize(star.select("a", "b"), "pairs")
    sets = materialize(_sets(docs, alive.join(rank, "node", "left_semi").select("node"), key, text, params), "sets")
    links = materialize(_confirm(star, sets, params), "links")
    roots = materialize(components(links), "roots")

    # Step 2: pairs of a sketch's bucket that agree on the other collection too and are in different components.
    member = (
        alive.join(rank, "node", "left_semi").join(size, "node").join(roots, "node", "left")
        .select("node", "n_shingles", "left", "right", F.coalesce("root", "node").alias("root"))
    )
    member = materialize(member, "members")
    spread = member.select("*", F.explode("left").alias("value"))
    open_ = spread.groupBy("value").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("n")).where("low != high")
    # A table of its own: a join right after the aggregation would share its shuffle, and a hot value could not be split.
    open_ = materialize(open_.select("value", "n"), "values")
    spread = materialize(spread.join(open_, "value"), "open")
    bits, names = _bits(sets, spread.select("node").distinct(), params)
    x, y = (c.alias(n) for c, n in zip(cells(spread.join(materialize(bits, "bits"), "node"), params.side), "xy"))
    differ = (1 - params.percent / 100) / 2  # the chance that a bit differs, at the threshold
    most = int(params.bits * differ + params.slack * (params.bits * differ * (1 - differ)) ** 0.5)
    apart = sum((F.bit_count(F.col(f"x.{n}").bitwiseXOR(F.col(f"y.{n}"))) for n in names), F.lit(0))
    first = F.array_min(F.array_intersect("x.left", "y.left")) == F.col("x.value")  # each pair in one bucket only
    meet = x.join(
        y,
        (F.col("x.value") == F.col("y.value")) & (F.col("x.row") == F.col("y.row")) & (F.col("x.col") == F.col("y.col"))
        & ((F.col("x.row") < F.col("x.col")) | (F.col("x.node") < F.col("y.node"))) & (F.col("x.root") != F.col("y.root"))
        & _similar_size(F.col("x.n_shingles"), F.col("y.n_shingles"), params.percent) & (apart <= most)
        & F.arrays_overlap("x.right", "y.right") & first,
    )
    rest = meet.select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b"))
    tried = star.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    rest = materialize(rest.join(tried, ["a", "b"], "left_anti"), "rest")
    more = materialize(_confirm(rest, sets, params), "links")
    if not more.isEmpty():
        stars = roots.where("node != root").select(F.col("node").alias("a"), F.col("root").alias("b"))
        roots = materialize(components(stars.unionByName(more)), "roots")
    placed = profile.select("id", "n_shingles", "h1", "h2").join(nodes.select("h1", "h2", "node"), ["h1", "h2"], "left")
    return placed, roots


def label(docs: DataFrame, key: str = "doc_id", text: str = "text", params: Params = Params()) -> DataFrame:
    """One row per row: key, n_shingles, component_id, kept.

    component_id is the smallest key reachable by links, kept whether that
    is the row's own.  Rows that share a key are one document and repeat
    its text.  Documents without words (NULL, empty or white space only)
    are linked with nothing.  Rows without a key have no component and are
    kept.
    """
    placed, roots = nodes_and_roots(docs, key, text, params)
    found = placed.join(roots, "node", "left")
    component = F.when(F.col("id").isNull(), F.lit(None)).otherwise(F.coalesce("root", "node", "id"))
    return found.select(
        F.col("id").alias(key), "n_shingles", component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )


def _few(ids: DataFrame) -> DataFrame:
    """``ids`` with a broadcast hint if they are few (counted), else as they are."""
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


def keep(docs: DataFrame, key: str = "doc_id", text: str = "text", params: Params = Params()) -> DataFrame:
    """One document of each group of near-duplicates, with all its columns; repeated rows of it once."""
    rows = materialize(label(docs, key, text, params).select(key, "kept"), "labels")
    gone = _few(rows.where("not kept").select(key).distinct())
    left = docs.join(gone, key, "left_anti")
    repeated = rows.where(F.col("kept") & F.col(f"`{key}`").isNotNull()).groupBy(key).agg(F.count("*").alias("n")).where("n > 1").select(key)
    if not repeated.isEmpty():
        repeated = _few(repeated)
        once = left.join(repeated, key, "left_semi").dropDuplicates([key])
        left = left.join(repeated, key, "left_anti").select(docs.columns).unionByName(once)
    return left.select(docs.columns)


def oracle_sql(params: Params = Params()) -> str:
    """DuckDB SQL for ``label(documents)``: all pairs that share a shingle."""
    w = params.words
    return f"""
WITH RECURSIVE d AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\\x20\\x09-\\x0D]+') AS t FROM documents
), s AS MATERIALIZED (
  SELECT DISTINCT doc_id, hash(g) AS g FROM (
    SELECT doc_id, array_to_string(t[p:p + {w - 1}], ' ') AS g FROM (SELECT doc_id, t, unnest(range(1, len(t) - {w - 2})) AS p FROM d WHERE len(t) >= {w})
    UNION ALL SELECT doc_id, array_to_string(t, ' ') AS g FROM d WHERE len(t) BETWEEN 1 AND {w - 1})
), n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), links AS MATERIALIZED (
  SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL)
  JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= {params.percent} * (na.n + nb.n - c)
), reach(a, b) AS (
  SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b
), low AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, least(d.doc_id, coalesce(low.b, d.doc_id)) AS component_id,
       d.doc_id = least(d.doc_id, coalesce(low.b, d.doc_id)) AS kept
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN low ON low.a = d.doc_id
"""
