"""Join shapes that stay balanced when one key holds a large share of rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimstar.session import shared_folder


def one_to_many_left_join(parents: DataFrame, children: DataFrame, parent_key: str, child_key: str,
                          lookup: Callable[[DataFrame], DataFrame] | None = None,
                          materialize_parents: bool = False) -> DataFrame:
    """``parents LEFT JOIN children ON parent_key = child_key``, child side large.

    In an outer join Spark can split a skewed partition only on the
    preserved side, and here the large, possibly skewed side is the child.
    So the join is written as

    * an inner join (AQE may split a hot key on either side), plus
    * the parents without any child: an anti join against the children's
      distinct keys, which collapse map-side, so a hot key costs one row.

    ``lookup`` adds columns to the matched rows (a join on a child column,
    say); parents without a child read NULL there.  Both branches read the
    parent side; with ``materialize_parents`` it is written once as a
    parquet table in a fresh folder under the shared checkpoint folder, and
    both read that table instead of recomputing it (the write runs when this
    is called).  Rows and multiplicities equal the plain left join.
    """
    shared = set(parents.columns) & set(children.columns)
    if shared:
        raise ValueError(f"rename shared columns before joining: {sorted(shared)}")
    if materialize_parents:
        path = shared_folder(parents.sparkSession, "lineage_cut")
        parents.write.parquet(path)
        parents = parents.sparkSession.read.parquet(path).select(*parents.columns)
    matched = parents.join(children, F.col(parent_key) == F.col(child_key), "inner")
    child_keys = children.select(F.col(child_key).alias("__child_key")).where(F.col("__child_key").isNotNull()) \
        .distinct()
    orphans = parents.join(child_keys, F.col(parent_key) == F.col("__child_key"), "left_anti")
    if lookup is not None:
        matched = lookup(matched)
    added = [f for f in matched.schema.fields if f.name not in parents.columns]
    orphans = orphans.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in added])
    return matched.unionByName(orphans)


HOT_ROWS = 2_000_000  # a key with more children than about this is dealt over several tasks
SALTS = 32
SAMPLE = 0.001


def hot_keys(rows: DataFrame, key: str, least: int = HOT_ROWS, share: float = SAMPLE, seed: int = 5) -> list:
    """Keys that hold about ``least`` rows or more, judged by a sample of the key column.

    Every key returned has a row.  There are fewer of them than rows / least.
    Runs a job over the key column alone; only plans depend on what it finds.
    """
    k = F.col(key).alias("k")
    found = rows.select(k).where(F.col("k").isNotNull())
    found = found.sample(share, seed) if share < 1 else found
    counted = found.groupBy("k").count().where(F.col("count") >= max(1, least * share))
    return sorted(r["k"] for r in counted.collect())


def salted_left_join(parents: DataFrame, children: DataFrame, parent_key: str, child_key: str, hot: Sequence,
                     lookup: Callable[[DataFrame], DataFrame] | None = None, salts: int = SALTS) -> DataFrame:
    """``parents LEFT JOIN children ON parent_key = child_key`` in one pass over either side.

    A left join keeps the parents without a child by itself, but Spark can't
    split a hot key of the child side in it.  So the children of the ``hot``
    keys (each must have a child) are dealt over ``salts``, and their parents
    are repeated once per salt.  A copy of a hot parent whose salt drew no
    child is dropped: the parent's children are with other copies.  Without
    hot keys this is the plain left join.

    ``lookup`` adds columns from left joins on child columns.
    """
    shared = set(parents.columns) & set(children.columns)
    if shared:
        raise ValueError(f"rename shared columns before joining: {sorted(shared)}")
    if not hot:
        joined = parents.join(children, F.col(parent_key) == F.col(child_key), "left")
        return joined if lookup is None else lookup(joined)
    is_hot = F.col(parent_key).isin(list(hot))
    copies = F.when(is_hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    left = parents.withColumn("__salt", F.explode(copies))
    # The hash of the whole row: a repeated task deals every row as before.
    salt = F.when(F.col(child_key).isin(list(hot)), F.pmod(F.xxhash64(*children.columns), F.lit(salts)).cast("int")).otherwise(0)
    right = children.withColumn("__child_salt", salt)
    joined = left.join(right, (F.col(parent_key) == F.col(child_key)) & (F.col("__salt") == F.col("__child_salt")), "left")
    joined = joined.where(F.col(child_key).isNotNull() | ~F.coalesce(is_hot, F.lit(False))).drop("__salt", "__child_salt")
    return joined if lookup is None else lookup(joined)
