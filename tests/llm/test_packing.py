from collections import defaultdict
from itertools import combinations

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from dimstar.llm.packing import Params, boundaries, pack


def padding(bounds, lengths, counts):
    return sum(c * (min(b for b in bounds if b >= n) - n) for n, c in zip(lengths, counts))


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.integers(0, 40), st.integers(1, 9), min_size=1, max_size=8), st.integers(1, 5))
def test_boundaries_are_optimal(histogram, buckets):
    lengths = sorted(histogram)
    counts = [histogram[n] for n in lengths]
    bounds, cost = boundaries(lengths, counts, buckets)
    best = min(padding((*c, lengths[-1]), lengths, counts)
               for k in range(min(buckets, len(lengths))) for c in combinations(lengths[:-1], k))
    assert cost == best == padding(bounds, lengths, counts) and len(bounds) <= buckets


def test_nothing_to_pack():
    assert boundaries([], [], 4) == ([], 0)


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, "w " * (i % 97)) for i in range(500)] + [(900, None), (901, ""), (902, "x " * 1234), (None, "a b"), (7, "w " * 7)]
    return spark.createDataFrame([(*r, 5, "b") for r in rows], "doc_id long, text string, start int, bucket string")


def test_batches(docs):
    params = Params(max_tokens=100, buckets=4, budget=400, group_rows=16)
    rows = pack(docs, params).collect()
    whole = defaultdict(list)
    for r in rows:
        whole[r["doc_id"]].append((r["start"], r["n_tokens"]))
        assert 0 <= r["n_tokens"] <= r["bucket"] <= 100 and r["padding"] == r["bucket"] - r["n_tokens"]
    assert sorted(whole[902]) == [(100 * i, 100 if i < 12 else 34) for i in range(13)]
    assert sorted(whole[7]) == [(0, 7), (0, 7)] and whole[900] == whole[901] == [(0, 0)] and whole[None] == [(0, 2)]
    assert {k: sum(n for _, n in v) for k, v in whole.items() if k is not None and k < 500 and k != 7} == {i: i % 97 for i in range(500) if i != 7}
    batches = defaultdict(list)
    for r in rows:
        batches[r["batch_id"]].append(r)
    for b in batches.values():
        assert len({r["bucket"] for r in b}) == 1
        assert len(b) * b[0]["bucket"] <= 400
        assert sorted(r["slot"] for r in b) == list(range(len(b)))
    # Full batches but for one of each group.
    groups = defaultdict(list)
    for name, b in batches.items():
        groups[name.rsplit("-", 1)[0]].append(len(b))
    for name, sizes in groups.items():
        hold = max(1, 400 // max(1, int(name.split("-")[0])))
        assert sorted(sizes)[1:] == [hold] * (len(sizes) - 1)


def test_empty_table(docs):
    assert pack(docs.limit(0)).count() == 0


def test_only_empty_texts(spark):
    rows = pack(spark.createDataFrame([(1, None), (2, " ")], "doc_id long, text string")).collect()
    assert {(r["n_tokens"], r["bucket"], r["padding"]) for r in rows} == {(0, 0, 0)}


def test_many_repeated_rows_are_dealt_over_groups(spark):
    copies = spark.range(100_000).selectExpr("CAST(NULL AS BIGINT) AS doc_id", "CAST(NULL AS STRING) AS text", "1 AS start")
    own = spark.range(2000).selectExpr("id AS doc_id", "repeat('w ', CAST(id % 50 AS INT)) AS text", "1 AS start")
    packed = pack(copies.unionByName(own).repartition(8), Params(max_tokens=100, buckets=3, budget=64, group_rows=100))
    groups = packed.groupBy(F.substring_index("batch_id", "-", 2).alias("g")).count().collect()
    # Each group fills whole batches of 64 at least; no group holds the copies.
    assert sum(r["count"] for r in groups) == 102_000
    assert max(r["count"] for r in groups) < 400
    batches = packed.groupBy("batch_id").agg(F.count("*").alias("n"), F.max("bucket").alias("b"), F.countDistinct("slot").alias("s")).collect()
    assert all(r["n"] == r["s"] and r["n"] * r["b"] <= 64 or r["n"] == 1 for r in batches)
