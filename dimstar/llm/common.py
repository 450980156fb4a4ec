"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dimstar.session import ensure_checkpoint_dir, shared_folder

# A word is a run of code points other than space and U+0009 to U+000D.
WORD = r"[^\x20\x09-\x0D]+"


ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def reachable(spark: SparkSession) -> None:
    """Let the Python workers import this package from where the driver has it.

    Of use where they see the same path (local runs, an installation on all
    machines); elsewhere the package is shipped with --py-files.
    """
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, ROOT])


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def materialize(df: DataFrame, kind: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back.

    Cuts the lineage with a table that outlives lost executors.  The schema
    is kept, so an empty frame reads back as an empty frame.
    """
    spark = df.sparkSession
    folder = shared_folder(spark, f"llm-{kind}")
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def shared(spark: SparkSession) -> str:
    return ensure_checkpoint_dir(spark)


def crc_mod(key: Column, divisor: int) -> Column:
    """crc32 of the key as text, modulo ``divisor`` (NULL keys: NULL)."""
    return F.crc32(key.cast("string").cast("binary")) % F.lit(divisor)


def binary(column: pa.ChunkedArray | pa.Array) -> pa.Array:
    """A string column as UTF-8 bytes, without decoding."""
    return column.cast(pa.binary())


def map_texts(
    df: DataFrame, keep: list[str], text: str, schema: str, make: Callable[[], Callable[[pa.Array], dict]]
) -> DataFrame:
    """Apply a per-batch function to a text column inside the tasks.

    ``make`` runs once per task and returns a function from one Arrow array
    of UTF-8 texts to a dict of equally long columns, which are appended to
    the ``keep`` columns.  Spark streams Arrow batches, so a task holds one
    batch at a time.
    """
    reachable(df.sparkSession)
    fields = [df.schema[c] for c in keep]
    names = [f"k{i}" for i in range(len(keep))]
    kept = df.select(*(F.col(f"`{c}`").alias(n) for c, n in zip(keep, names)), F.col(f"`{text}`").alias("t"))
    ddl = ", ".join(f"{n} {f.dataType.simpleString()}" for n, f in zip(names, fields))
    schema = f"{ddl}, {schema}" if ddl else schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            if batch.num_rows == 0:
                continue
            made = work(batch.column(len(names)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(names)], *(v if isinstance(v, pa.Array) else pa.array(v) for v in made.values())],
                [*names, *made],
            )

    out = kept.mapInArrow(run, schema)
    return out.withColumnsRenamed(dict(zip(names, keep)))


def keep_rows(df: DataFrame, text: str, make: Callable[[], Callable[[pa.Array], pa.Array]]) -> DataFrame:
    """The rows of ``df`` whose text a per-batch function accepts; all columns as they are."""
    reachable(df.sparkSession)
    at = df.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            if batch.num_rows:
                yield batch.filter(work(batch.column(at)))

    return df.mapInArrow(run, df.schema)


def hash_share(key: Column) -> Column:
    """A number in [0, 1) that a key always gets, for samples that any run repeats."""
    return F.pmod(F.xxhash64(key.cast("string")), F.lit(1 << 30)) / F.lit(float(1 << 30))


def sample_per_class(rows: DataFrame, key: str, label: str, per_class: int) -> DataFrame:
    """About ``per_class`` rows of each label, picked by the hash of their key; never over twice as many in all.

    Labels are classes: their number is small and their counts come to the driver.
    """
    counts = {r[0]: r[1] for r in rows.where(F.col(label).isNotNull()).groupBy(label).count().collect()}
    share = F.lit(0.0)
    for value, n in sorted(counts.items()):
        share = F.when(F.col(label) == F.lit(value), F.lit(min(1.0, per_class / n))).otherwise(share)
    return rows.where(hash_share(F.col(key)) < share).limit(2 * per_class * max(1, len(counts)))


def index_rows(rows: DataFrame) -> DataFrame:
    """``rows`` with a column ``i``: 0, 1, 2, ... without gaps.

    The place inside its task is written with each row, so every later read
    and every repeated task finds the same; only the number of rows of each
    task comes to the driver.
    """
    low = F.lit((1 << 33) - 1)
    placed = rows.withColumn("part", F.spark_partition_id()).withColumn("place", F.monotonically_increasing_id().bitwiseAND(low))
    placed = materialize(placed, "indexed")
    counts = sorted(placed.groupBy("part").count().collect())
    starts, total = {}, 0
    for part, count in counts:
        starts[part], total = total, total + count
    if not starts:
        return placed.select("*", F.lit(0).cast("long").alias("i")).drop("part", "place")
    first = F.lit([starts.get(p, 0) for p in range(max(starts) + 1)]).cast("array<long>")
    return placed.withColumn("i", F.element_at(first, F.col("part") + 1) + F.col("place")).drop("part", "place")


def word_blocks(column: pa.Array, most: int = 200_000) -> Iterator[tuple[int, list[list[bytes]]]]:
    """Lower-cased words of consecutive texts: (first row, word lists), ``most`` words or one text at a time."""
    first, block, size = 0, [], 0
    for i, t in enumerate(column.to_pylist()):
        words = t.lower().encode().split() if t else []
        if block and size + len(words) > most:
            yield first, block
            first, block, size = i, [], 0
        block.append(words)
        size += len(words)
    if block:
        yield first, block


def segment_sums(values, sizes):
    """Sums of consecutive segments of ``values`` (along axis 0); empty segments: 0."""
    import numpy as np

    out = np.zeros((len(sizes), *values.shape[1:]), np.float64)
    full = np.flatnonzero(sizes)
    if len(full):
        starts = (np.cumsum(sizes) - sizes)[full]
        out[full] = np.add.reduceat(values, starts, axis=0)
    return out
