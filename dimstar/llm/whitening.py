"""Embedding whitening with Spark MLlib block matrices.

Entries become integers, x = floor(64 * c) + 1000000.  The fit list holds
each distinct x vector once; its rows, centred by the exact mean, are indexed
into the blocks of a distributed ``BlockMatrix`` A.  The transpose multiplied
by A is the scatter matrix, whose size depends on the dimensions only; its
eigenvectors are found locally.  A times the whitening matrix (eigenvectors
over the square roots of their eigenvalues) projects all rows, and the
projection's own transpose product measures how far its covariance is from
the identity.  Rows that share a vector share its projection.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.mllib.linalg import DenseMatrix
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimstar.llm.common import index_rows, materialize, reachable

# The scale and the shift that make integers of entries.
SCALE, SHIFT = 64, 1_000_000


@dataclass(frozen=True)
class Params:
    components: int = 16
    rows: int = 2048  # of a block
    dims: int = 1024  # of a block
    largest: int = 1 << 48  # floor(64 * c) is held between minus this and this
    flat: float = 1e-12  # an eigenvalue below this share of the largest counts as zero


def integers(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", params: Params = Params()) -> DataFrame:
    """vec_id and x (array of long) of the rows whose vector is there and finite throughout.

    Vectors whose length is not the most frequent one (the larger of equally
    frequent ones), empty ones included, take no part: no covariance holds
    them all.
    """
    v = vectors.select(F.col(f"`{key}`").alias("vec_id"), F.col(f"`{vector}`").cast("array<double>").alias("v"))
    fine = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    v = v.where(F.col("v").isNotNull() & (F.size("v") > 0)).where(fine)
    size = v.groupBy(F.size("v").alias("n")).count().agg(F.max(F.struct("count", "n"))["n"]).first()[0]
    top = float(params.largest)
    held = F.transform("v", lambda c: F.greatest(F.lit(-top), F.least(F.lit(top), F.floor(c * SCALE).cast("double"))).cast("long") + SHIFT)
    return v.where(F.size("v") == F.lit(size if size is not None else 0)).select("vec_id", held.alias("x"))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _sums(fit: DataFrame) -> tuple[int, list[int]]:
    """Number of rows, and the exact sum of each dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, None
        for b in batches:
            for i in range(0, b.num_rows, 4096):  # a part's sums stay within 64 bits
                part = [int(s) for s in _matrix(b.column(0).slice(i, 4096)).sum(axis=0)]
                total = part if total is None else [p + q for p, q in zip(total, part)]
            n += b.num_rows
        if total is not None:
            sums = pa.array([str(s) for s in [n, *total]])
            yield pa.RecordBatch.from_arrays([pa.array(range(len(sums)), pa.int32()), sums], ["dim", "total"])

    reachable(fit.sparkSession)
    parts = fit.select("x").mapInArrow(run, "dim int, total string")
    got = parts.groupBy("dim").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).orderBy("dim").collect()
    return (int(got[0]["total"]), [int(r["total"]) for r in got[1:]]) if got else (0, [])


def _deviation(x: np.ndarray, n: int, sums: list[int]) -> tuple[np.ndarray, list[int | None]]:
    """Centred rows as doubles, and the exact sums of (n * x - S)^2; None where a sum exceeds 64 bits."""
    if int(np.abs(x).max()) * n < 2**62 and max(map(abs, sums)) < 2**62:
        apart = x * n - np.array(sums, np.int64)
        if float((apart.astype(float) ** 2).sum(axis=1).max()) < 2**62:
            return apart / n, (apart * apart).sum(axis=1).tolist()
    big = x.astype(object) * n - np.array(sums, object)
    made = [s if s < 2**63 else None for s in (big * big).sum(axis=1).tolist()]
    return np.array([[int(c) / n for c in row] for row in big]), made


def _times(a: BlockMatrix, b: BlockMatrix, splits: int) -> BlockMatrix:
    """The product; the inner dimension is cut into ``splits``, which are multiplied apart and then added."""
    product = a._java_matrix_wrapper._java_model.multiply(b._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(product, a.rowsPerBlock, b.colsPerBlock)


def _scatter(a: BlockMatrix, splits: int) -> np.ndarray:
    return _times(a.transpose(), a, splits).toLocalMatrix().toArray()


def whiten(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", params: Params = Params()) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error for each usable row and component.

    Rows whose vector is NULL, empty, or holds NULL or non-finite entries are
    left out; zero vectors stay.  A NULL vec_id stays; repeated rows are
    returned each, but fitted once.  There are as many components as
    dimensions, at most ``components``.  A component without variance (as
    with fewer distinct vectors than dimensions) has whitened 0 and explained
    0 and doesn't count for identity_error.  A deviation beyond 64 bits is
    NULL; |floor(64 * c)| is held at 2^48.  No usable rows: an empty result.
    Other columns of ``vectors`` are not read.
    """
    spark = vectors.sparkSession
    reachable(spark)
    rows = materialize(integers(vectors, key, vector, params), "integers")
    fit = index_rows(rows.select("x").distinct())
    n, sums = _sums(fit)
    if not n:
        empty = "vec_id {}, component int, n long, deviation long, whitened double, explained double, identity_error double"
        return spark.createDataFrame([], empty.format(rows.schema["vec_id"].dataType.simpleString()))

    def centre(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                x = _matrix(b.column(1))
                apart, deviation = _deviation(x, n, sums)
                listed = pa.ListArray.from_arrays(np.arange(0, apart.size + 1, apart.shape[1], dtype=np.int32), pa.array(apart.ravel()))
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), listed, pa.array(deviation, pa.int64())], ["i", "x", "c", "deviation"])

    centred = materialize(fit.select("i", "x").mapInArrow(centre, "i long, x array<long>, c array<double>, deviation long"), "centred")
    indexed = MLUtils.convertVectorColumnsFromML(centred.select("i", array_to_vector("c").alias("c")), "c")
    blocks = IndexedRowMatrix(indexed, n, len(sums)).toBlockMatrix(params.rows, params.dims)
    splits = max(1, min(-(-n // params.rows), spark.sparkContext.defaultParallelism * 4))

    variance = _scatter(blocks, splits) / n
    values, axes = np.linalg.eigh((variance + variance.T) / 2)
    order = np.argsort(-values, kind="stable")[: params.components]
    values, axes, trace = values[order], axes[:, order], float(np.trace(variance))
    there = values > max(params.flat * values.max(initial=0.0), 0.0)
    matrix = np.where(there, axes / np.sqrt(np.where(there, values, 1.0)), 0.0)
    explained = [float(e) / trace if t else 0.0 for e, t in zip(values, there)]

    projection = blocks.multiply(_local(spark, matrix, params))
    apart = _scatter(projection, splits)[np.ix_(there, there)] / n - np.eye(int(there.sum()))
    error = float(np.abs(apart).max(initial=0.0))

    found = _rows(projection, centred, params)
    # A vector that many rows hold: a join that Spark can split, of rows against distinct vectors.
    whole = rows.join(found, "x").select("vec_id", "deviation", F.posexplode("w").alias("at", "whitened"))
    return whole.select(
        "vec_id",
        (F.col("at") + 1).cast("int").alias("component"),
        F.lit(n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.element_at(F.lit(explained).cast("array<double>"), F.col("at") + 1).alias("explained"),
        F.lit(error).alias("identity_error"),
    )


def _local(spark, matrix: np.ndarray, params: Params) -> BlockMatrix:
    """A matrix of the driver in blocks that fit the columns of the rows' blocks."""
    d, k = matrix.shape
    parts = [((i // params.dims, 0), DenseMatrix(min(params.dims, d - i), k, matrix[i : i + params.dims].ravel(order="F").tolist())) for i in range(0, d, params.dims)]
    return BlockMatrix(spark.sparkContext.parallelize(parts, len(parts)), params.dims, k, d, k)


def _rows(projection: BlockMatrix, centred: DataFrame, params: Params) -> DataFrame:
    """x, deviation and the projection w of each fitted vector."""
    height = params.rows

    def rows(block) -> Iterator[tuple[int, list[float]]]:
        (at, _), part = block
        return ((at * height + j, row) for j, row in enumerate(part.toArray().tolist()))

    values = materialize(projection.blocks.flatMap(rows).toDF("i long, w array<double>"), "projected")
    return centred.select("i", "x", "deviation").join(values, "i").drop("i")
