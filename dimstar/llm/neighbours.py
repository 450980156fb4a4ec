"""Approximate nearest neighbours by cosine: NN-descent graph and greedy search.

Equal vectors are one node of the graph.  The graph starts from exact
neighbours inside blocks of vectors that lie on the same sides of random
hyperplanes.  Each round of NN-descent then joins a node's neighbours
and reverse neighbours with one another (neighbours of neighbours are
likely neighbours) and keeps each node's nearest, until a round changes
hardly an edge.  Edges are new until a round has joined them: only pairs with
a new edge are compared, and nodes without a new edge around them take no
part, so later rounds cost what has changed.  A query walks the graph: its
best candidates are expanded by their neighbours, scored, and the best kept,
until nothing new turns up.  Rounds and steps are Spark joins whose results
are written to the shared folder; numpy scores inside tasks, on unit vectors
of floats; the answers' scores are doubles of the original vectors.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dimstar.llm.common import materialize, reachable

EDGE = "u long, v long, s float"
BROADCAST_BYTES = 32 << 20  # at most so many bytes of query vectors are broadcast


@dataclass(frozen=True)
class Params:
    neighbours: int = 20  # of a node in the graph; as many reverse ones join in
    orders: int = 10  # random orders of the start
    bits: int = 20  # hyperplanes of an order
    block: int = 2048  # vectors compared with one another at the start
    changed: float = 0.001  # rounds go on until a smaller share of the edges is new
    rounds: int | None = None  # None: as many as that takes
    offers: int = 6  # pairs that a node's join proposes to each of its neighbours
    beam: int = 120  # candidates that a query keeps
    k: int = 5
    seed: int = 11


def usable(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """vec_id, vec (array of double): rows with a key and a finite vector that is neither NULL, empty nor zero.

    Vectors whose length is not the most frequent one (the larger of equally
    frequent ones) take no part: they have no cosine with the others.
    """
    v = vectors.select(F.col(f"`{key}`").cast("long").alias("vec_id"), F.col(f"`{vector}`").cast("array<double>").alias("vec"))
    fine = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    v = v.where(F.col("vec_id").isNotNull() & F.col("vec").isNotNull() & (F.size("vec") > 0)).where(fine)
    v = v.where(F.exists("vec", lambda x: x != 0))
    size = v.groupBy(F.size("vec").alias("n")).count().agg(F.max(F.struct("count", "n"))["n"]).first()[0]
    return v.where(F.size("vec") == F.lit(size if size is not None else 0)).distinct()


def _unit(batch: pa.Array) -> np.ndarray:
    """Rows of unit length of an array column."""
    x = batch.flatten().to_numpy(zero_copy_only=False).reshape(len(batch), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # else squares may overflow
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def unit_rows(vectors: DataFrame, key: str) -> DataFrame:
    """``key`` and vec as a unit vector of floats."""
    reachable(vectors.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                x = _unit(b.column(1)).astype(np.float32)
                listed = pa.ListArray.from_arrays(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32), pa.array(x.ravel()))
                yield pa.RecordBatch.from_arrays([b.column(0), listed], [key, "vec"])

    return vectors.select(key, "vec").mapInArrow(run, f"{key} long, vec array<float>")


def _floats(batch: pa.Array) -> np.ndarray:
    return batch.flatten().to_numpy(zero_copy_only=False).reshape(len(batch), -1)


def _best(ids: np.ndarray, x: np.ndarray, k: int, rows: int = 512, new: np.ndarray | None = None) -> pa.RecordBatch:
    """Edges from each of some nodes to its ``k`` nearest among them; ``rows`` nodes are compared at a time.

    With ``new``: only pairs of which at least one is new.
    """
    n = len(ids)
    k = min(k, n - 1)
    ats, values = [], []
    for i in range(0, n, rows):
        s = x[i : i + rows] @ x.T
        own = np.arange(len(s))
        s[own, own + i] = -2
        if new is not None:
            s[np.ix_(~new[i : i + rows], ~new)] = -2
        at = np.argpartition(s, n - k, axis=1)[:, n - k :]
        ats.append(at)
        values.append(np.take_along_axis(s, at, 1))
    u, v, s = np.repeat(ids, k), ids[np.concatenate(ats)].ravel(), np.concatenate(values).astype(np.float32).ravel()
    if new is not None:
        u, v, s = u[s > -2], v[s > -2], s[s > -2]
    return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v), pa.array(s)], ["u", "v", "s"])


def _start(nodes: DataFrame, params: Params) -> DataFrame:
    """Edges inside blocks of each random order; all orders are dealt out by one shuffle."""
    seed, block, k, orders = params.seed, params.block, params.neighbours, params.orders
    parts = max(1, nodes.count() * orders // (2 * block))

    def sides(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for order in range(orders if batch.num_rows else 0):
                x = _floats(batch.column(1))
                planes = np.random.default_rng([seed, order]).normal(size=(x.shape[1], params.bits))
                code = ((x @ planes) > 0) @ (1 << np.arange(params.bits))
                yield pa.RecordBatch.from_arrays([pa.array([order] * len(x), pa.int32()), pa.array(code.astype(np.int64)), *batch.columns], ["place", "code", "u", "vec"])

    def ends(ids: np.ndarray, xs: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Less than two blocks, in equal parts."""
        for own in np.array_split(np.arange(len(ids)), max(1, -(-len(ids) // block))):
            if len(own) > 1:
                yield _best(ids[own], xs[own], k)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, ids, xs = -1, np.zeros(0, np.int64), np.zeros((0, 0), np.float32)
        for batch in batches:
            order = batch.column(0).to_numpy()
            cuts = [*range(0, batch.num_rows, block), *(np.flatnonzero(order[1:] != order[:-1]) + 1).tolist(), batch.num_rows]
            cuts = sorted(set(cuts))
            for i, j in zip(cuts, cuts[1:]):
                part = batch.slice(i, j - i)
                if order[i] != at:
                    yield from ends(ids, xs)
                    at, ids, xs = order[i], np.zeros(0, np.int64), np.zeros((0, 0), np.float32)
                x = _floats(part.column(2))
                ids, xs = np.concatenate([ids, part.column(1).to_numpy()]), np.concatenate([xs, x]) if len(xs) else x
                while len(ids) >= 2 * block:
                    yield _best(ids[:block], xs[:block], k)
                    ids, xs = ids[block:], xs[block:]
        yield from ends(ids, xs)

    coded = nodes.mapInArrow(sides, "place int, code long, u long, vec array<float>")
    ordered = coded.repartitionByRange(parts, "place", "code", "u").sortWithinPartitions("place", "code", "u")
    return ordered.select("place", "u", "vec").mapInArrow(compare, EDGE)


def _sized(rows: DataFrame, n: int, of: int = 200_000) -> DataFrame:
    """``rows``, about ``n`` of them, in as many tasks as that needs; more tasks are put together."""
    return rows.coalesce(max(1, -(-n // of)))


def _top(edges: DataFrame, by: str, k: int) -> DataFrame:
    other = "v" if by == "u" else "u"
    place = F.row_number().over(Window.partitionBy(by).orderBy(F.desc("s"), other))
    return edges.withColumn("place", place).where(F.col("place") <= k).drop("place")


def _nearest(edges: DataFrame, k: int) -> DataFrame:
    """The ``k`` best edges of each node, each once."""
    return _top(edges.groupBy("u", "v").agg(F.max("s").alias("s")), "u", k)


def _both_ways(edges: DataFrame, k: int) -> DataFrame:
    """(node, others, fresh): each node's neighbours and its ``k`` nearest reverse neighbours; those of new edges."""
    back = _top(edges, "v", k).select(F.col("v").alias("node"), F.col("u").alias("other"), "new")
    both = edges.select(F.col("u").alias("node"), F.col("v").alias("other"), "new").union(back)
    near = both.groupBy("node").agg(F.collect_list(F.struct("other", "new")).alias("near"))
    others = F.array_distinct(F.transform("near", lambda e: e["other"]))
    fresh = F.array_distinct(F.transform(F.filter("near", lambda e: e["new"]), lambda e: e["other"]))
    return near.select("node", others.alias("others"), fresh.alias("fresh"))


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole groups of equal first columns in sorted batches, with the groups' first rows."""
    rest: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        now = pa.Table.from_batches([batch])
        now = pa.concat_tables([rest, now]) if rest is not None else now
        keys = now.column(0).to_numpy()
        first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        rest = now.slice(first[-1])
        if len(first) > 1:
            yield now.slice(0, first[-1]), first[:-1]
    if rest is not None:
        yield rest, np.zeros(1, np.int64)


def _join_round(edges: DataFrame, nodes: DataFrame, params: Params) -> DataFrame:
    """Edges that the neighbours of each node propose to one another, of pairs with a new edge."""
    around = _both_ways(edges, params.neighbours).where(F.size("fresh") > 0)
    changed = around.select("node", "fresh", F.explode("others").alias("other"))
    changed = changed.select("node", "other", F.array_contains("fresh", F.col("other")).alias("new"))
    rows = changed.join(nodes.withColumnRenamed("u", "other"), "other").select("node", "other", "new", "vec")
    offers = params.offers

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, first in _groups(batches):
            table = table.combine_chunks()
            ids, new = table.column(1).to_numpy(), table.column(2).to_numpy()
            x = _floats(table.column(3).chunk(0))
            made = [_best(ids[a:b], x[a:b], offers, new=new[a:b]) for a, b in zip(first, [*first[1:], len(ids)]) if b - a > 1]
            if made:
                yield pa.Table.from_batches(made).combine_chunks().to_batches()[0]

    dealt = rows.repartition("node").sortWithinPartitions("node")
    return dealt.mapInArrow(join, EDGE)


def build(nodes: DataFrame, params: Params = Params()) -> DataFrame:
    """The neighbour graph of ``nodes`` (u, vec: unit vectors of floats): edges u, v, s, and new of the last round."""
    reachable(nodes.sparkSession)
    n = nodes.count() * params.neighbours
    edges = materialize(_sized(_nearest(_start(nodes, params), params.neighbours).withColumn("new", F.lit(True)), n), "graph")
    for done in count():
        if done == params.rounds:
            break
        made = _join_round(edges, nodes, params).withColumn("new", F.lit(True))
        both = edges.withColumn("new", F.lit(False)).unionByName(made)
        # An edge that was there is not new, even where the join proposes it again.
        once = both.groupBy("u", "v").agg(F.max("s").alias("s"), F.min("new").alias("new"))
        edges = materialize(_sized(_top(once, "u", params.neighbours), n), "graph")
        fresh, total = edges.agg(F.count_if("new"), F.count("*")).first()
        if fresh <= params.changed * total:
            break
    return edges


def _cosine(a: str, b: str):
    """Cosine in double precision, summed in order."""
    def dot(x, y):
        return F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda s, t: s + t)

    x, y = F.col(a), F.col(b)
    return dot(x, y) / (F.sqrt(dot(x, x)) * F.sqrt(dot(y, y)))


def search(queries: DataFrame, nodes: DataFrame, edges: DataFrame, params: Params = Params()) -> DataFrame:
    """q, u, score: the ``beam`` best nodes that each query (q, a node; qvec) finds on its walk, itself among them."""
    adjacent = materialize(_sized(_both_ways(edges, params.neighbours).select("node", "others"), nodes.count(), 20_000), "adjacent")

    many, size = queries.agg(F.count("*"), F.count("*") * F.coalesce(F.max(F.size("qvec")), F.lit(0)) * 4).first()
    asked = F.broadcast(queries) if size <= BROADCAST_BYTES else queries

    def score(pairs: DataFrame) -> DataFrame:
        """(q, node) with the cosine, by numpy over Arrow batches."""
        rows = pairs.join(nodes.withColumnRenamed("u", "node"), "node").join(asked, "q").select("q", "node", "vec", "qvec")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                if b.num_rows:
                    s = (_floats(b.column(2)) * _floats(b.column(3))).sum(axis=1)
                    yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(s.astype(float))], ["q", "node", "s"])

        return rows.mapInArrow(run, "q long, node long, s double")

    # seen: the step in which a candidate was found; those of the last step are expanded next.
    pool = queries.select("q", F.col("q").alias("node"), F.lit(1.0).alias("s"), F.lit(0).alias("step"))
    # The beam only gets better, so the walk ends.
    for step in count(1):
        found = (
            pool.where(F.col("step") == step - 1)
            .join(adjacent, "node")
            .select("q", F.explode("others").alias("node"))
            .distinct()
            .join(pool.select("q", "node"), ["q", "node"], "left_anti")
        )
        fresh = score(found).withColumn("step", F.lit(step))
        place = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("s"), "node"))
        grown = pool.unionByName(fresh).withColumn("place", place).where(F.col("place") <= params.beam).drop("place")
        pool = materialize(_sized(grown, many * params.beam), "beam")
        if pool.where(F.col("step") == step).isEmpty():
            break
    return pool.select("q", F.col("node").alias("u"), "s")


def nearest(vectors: DataFrame, is_query, key: str = "vec_id", vector: str = "embedding", params: Params = Params()) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest rows that each query finds.

    ``is_query`` is a condition on vec_id.  Candidates are all usable rows
    but the query's own; equal scores go to the smaller vec_id.  Repeated
    rows count once.  Fewer candidates than ``k``: all that are found.
    """
    k = params.k
    rows = materialize(usable(vectors, key, vector), "vectors")
    # Of equal vectors the k + 1 smallest ids can be answers; the smallest is the node.
    place = F.row_number().over(Window.partitionBy("vec").orderBy("vec_id"))
    members = rows.withColumn("place", place).where(F.col("place") <= k + 1)
    members = materialize(members.withColumn("u", F.min("vec_id").over(Window.partitionBy("vec"))).select("u", "vec_id", "place", "vec"), "members")
    whole = members.where(F.col("place") == 1).select("u", "vec")
    nodes = materialize(unit_rows(whole, "u"), "nodes")
    edges = build(nodes, params)

    asked = rows.where(is_query).join(whole, "vec").select(F.col("vec_id").alias("query_id"), F.col("u").alias("q"), "vec")
    asked = materialize(asked, "asked")
    exact = asked.groupBy("q").agg(F.any_value("vec").alias("qvec"))
    asked = asked.select("query_id", "q")
    queries = materialize(unit_rows(exact.select("q", F.col("qvec").alias("vec")), "q").withColumnRenamed("vec", "qvec"), "queries")
    found = search(queries, nodes, edges, params)

    # Answers are members of the k + 1 best nodes, plus those of nodes that floats can't tell from the last.
    place = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("s"), "u"))
    last = F.min(F.when(F.col("place") <= k + 1, F.col("s"))).over(Window.partitionBy("q"))
    best = found.withColumn("place", place).withColumn("last", last).where(F.col("s") >= F.col("last") - 1e-5).select("q", "u")
    options = best.join(members.select("u", "vec_id", "vec"), "u").join(exact, "q").select("q", "vec_id", _cosine("vec", "qvec").alias("score"))
    place = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "vec_id"))
    options = options.withColumn("place", place).where(F.col("place") <= k + 1).select("q", "vec_id", "score")
    answers = asked.join(options, "q").where(F.col("vec_id") != F.col("query_id"))
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    out = answers.withColumn("rank", place).where(F.col("rank") <= k)
    return out.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
