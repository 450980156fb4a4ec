"""Packing: optimal length buckets and token-budget batches.

A document is as many tokens long as it has words; one that exceeds the
longest sequence is cut into consecutive pieces, so nothing is lost and
there are at most ``max_tokens + 1`` different lengths.  Dynamic programming
over the histogram of all lengths chooses the bucket boundaries that pad
least: every sequence is padded to its bucket's boundary.  A batch of a
bucket holds as many sequences as the token budget allows at that boundary.

Batches are filled inside groups of about ``group_rows`` sequences of a
bucket, dealt by hash, so no task holds a whole bucket; the price is at most
one batch per group that is not full.  The hash is that of key and text, so
any run deals a document alike; rows that are repeated more often than a
group has room are dealt by their place in the written table as well.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dimstar.llm.common import WORD, materialize


BROADCAST_HASHES = 1_000_000  # at most so many hashes (8 MB) are broadcast


@dataclass(frozen=True)
class Params:
    max_tokens: int = 4096
    buckets: int = 16
    budget: int = 32768  # tokens of a batch, padding included
    group_rows: int = 512


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def sequences(docs: DataFrame, params: Params = Params(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, start, row, n_tokens, deal: one row for each piece of each document; no words: one piece of length 0.

    ``deal`` is a hash that spreads the pieces over groups, alike for equal
    rows; ``row`` a number of the piece.
    """
    t = F.col(f"`{text}`")
    n = docs.select(F.col(f"`{key}`").alias(key), word_count(t).alias("words"), F.xxhash64(F.col(f"`{key}`"), t).alias("deal"))
    step = F.lit(params.max_tokens).cast("long")
    cut = n.select(key, "words", "deal", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col("words") - 1, F.lit(0).cast("long")), step)).alias("start"))
    return cut.select(key, "start", F.monotonically_increasing_id().alias("row"), F.least(F.col("words") - F.col("start"), step).alias("n_tokens"), F.xxhash64("deal", "start").alias("deal"))


def boundaries(lengths: list[int], counts: list[int], buckets: int) -> tuple[list[int], int]:
    """The boundaries of at most ``buckets`` buckets with the least padding, and that padding.

    lengths: different lengths, ascending.  The last boundary is the largest length.
    """
    if not lengths:
        return [], 0
    size, number = np.array(lengths, np.int64), np.array(counts, np.int64)
    # Sequences and tokens before each position.
    seqs, tokens = np.r_[0, np.cumsum(number)], np.r_[0, np.cumsum(size * number)]
    m = len(size)
    cost = np.r_[0, np.full(m, np.iinfo(np.int64).max // 4)]  # by number of lengths covered
    choice = []
    for _ in range(min(buckets, m)):
        best, first = np.full(m + 1, np.iinfo(np.int64).max // 4), np.zeros(m + 1, np.int64)
        best[0] = 0
        for j in range(1, m + 1):
            pad = cost[:j] + size[j - 1] * (seqs[j] - seqs[:j]) - (tokens[j] - tokens[:j])
            first[j] = int(pad.argmin())
            best[j] = pad[first[j]]
        choice.append(first)
        cost = best
    out, j = [], m
    for first in reversed(choice):
        if j == 0:
            break
        out.append(int(size[j - 1]))
        j = int(first[j])
    return sorted(out), int(cost[m])


def pack(docs: DataFrame, params: Params = Params(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece: key, start, n_tokens, bucket, batch_id, slot, padding.

    bucket is the boundary the piece is padded to; slot its place (from 0)
    in the batch; a batch's slots times its bucket stay within the budget
    (a boundary above the budget: one piece per batch).  NULL and empty
    texts are pieces of length 0.  Repeated rows are packed each, very long
    texts whole, in pieces; a NULL key is a key.  An empty table gives an
    empty result; other columns are not read.
    """
    seqs = materialize(sequences(docs, params, key, text), "lengths")
    histogram = sorted((r[0], r[1]) for r in seqs.groupBy("n_tokens").count().collect())  # max_tokens + 1 rows at most
    bounds, _ = boundaries([n for n, _ in histogram], [c for _, c in histogram], params.buckets)
    often = seqs.groupBy("deal").agg(F.count("*").alias("n")).where(F.col("n") > params.group_rows).select("deal")
    if not often.isEmpty():
        # At most one hash for each group_rows rows.
        often = materialize(often, "often")
        often = F.broadcast(often) if often.count() <= BROADCAST_HASHES else often
        hot = often.withColumn("hot", F.lit(True))
        seqs = seqs.join(hot, "deal", "left").withColumn("deal", F.when(F.col("hot"), F.xxhash64("deal", "row")).otherwise(F.col("deal"))).drop("hot")
    bucket, capacity, groups = F.lit(None).cast("long"), F.lit(1), F.lit(1)
    low = -1
    for bound in bounds:
        count = sum(c for n, c in histogram if low < n <= bound)
        low = bound
        hold = max(1, params.budget // max(1, bound))
        whole = hold * -(-params.group_rows // hold)  # a group is meant to fill whole batches
        here = (F.col("n_tokens") <= bound) & bucket.isNull()
        capacity, groups = F.when(here, F.lit(hold)).otherwise(capacity), F.when(here, F.lit(-(-count // whole))).otherwise(groups)
        bucket = F.coalesce(bucket, F.when(F.col("n_tokens") <= bound, F.lit(bound).cast("long")))
    dealt = seqs.select(key, "start", "n_tokens", "deal", bucket.alias("bucket"), capacity.alias("capacity"), groups.alias("groups"))
    dealt = dealt.withColumn("group", F.pmod(F.col("deal"), F.col("groups").cast("long")))
    place = F.row_number().over(Window.partitionBy("bucket", "group").orderBy("deal", key, "start")) - 1
    placed = dealt.withColumn("place", place)
    return placed.select(
        key, "start", "n_tokens", "bucket",
        F.concat_ws("-", "bucket", "group", F.floor(F.col("place") / F.col("capacity"))).alias("batch_id"),
        (F.col("place") % F.col("capacity")).cast("int").alias("slot"),
        (F.col("bucket") - F.col("n_tokens")).alias("padding"),
    )
