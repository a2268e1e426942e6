"""Whitening of embeddings with MLlib's BlockMatrix.

A vector's components c become whole numbers x = floor(64 * c) + 1000000. The fit list has every distinct
x once: n rows with sums S. Its rows, indexed 0 to n - 1 and centred as (n * x - S) / n, are laid into a
BlockMatrix; its transpose times itself is the scatter, and scatter / n the covariance. That matrix is as
small as the vectors are long, so its eigenvectors are found on the driver. The blocks times the whitening
matrix (eigenvectors over the roots of their eigenvalues) are the whitened rows, which join the vectors
again by x. They are centred and multiplied by their transpose in the same way, as a check of the result.

A product over many row blocks is split along them (`splits`), so no task adds up more than a share of
them. Blocks hold BLOCK_ROWS rows, or more if there were over MOST_BLOCKS blocks, which bounds what the
driver keeps of them. Repeated vectors are counted before the shuffle; the join back is between stored
tables, which adaptive execution splits on a hot vector.

Cases: vectors that are null or empty, or hold null or non-finite components, take no part and give no
rows; neither do those of another length than most have (of equally many, the longer). Null ids are ids;
rows that repeat an id or a vector are all returned, vectors count once in the fit. Components without
variance (eigenvalues within rounding of 0) can't be whitened and are left out: all of them if there is
but one distinct vector. Numbers beyond a long raise an error. No rows give none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import DenseMatrix
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.llm.common import narrow, numbered
from marketlens.session import durable

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 16
BLOCK_ROWS = 1024
BLOCK_COLUMNS = 1024
MOST_BLOCKS = 65_536
_LIMIT = float(2**62)


def whole_numbers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(vec_id, floor(64 * c) + 1000000 of each component) of the vectors that take part."""
    for batch in batches:
        vectors = batch.column(1)
        lengths = pc.list_value_length(vectors).fill_null(0).to_numpy(zero_copy_only=False)
        flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)  # null becomes NaN
        ends = np.cumsum(lengths)
        bad = np.append(0, np.cumsum(~np.isfinite(flat)))
        fine = (lengths > 0) & (bad[ends] == bad[ends - lengths])
        values = flat[np.repeat(fine, lengths)]
        with np.errstate(over="ignore"):
            scaled = np.floor(values * SCALE)
        if np.abs(scaled, out=np.zeros_like(scaled), where=True).max(initial=0.0) > _LIMIT:
            raise OverflowError("a component is too large for a long")
        x = scaled.astype(np.int64) + OFFSET
        offsets = np.append(0, np.cumsum(lengths[fine])).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).filter(pa.array(fine)), pa.ListArray.from_arrays(pa.array(offsets), pa.array(x))], names=["vec_id", "x"]
        )


def _dimension_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            x = batch.column(0).flatten().to_numpy().reshape(batch.num_rows, -1)
            high, low = (x >> 20).sum(axis=0), (x & 0xFFFFF).sum(axis=0)  # halves can't overflow
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(x.shape[1], dtype=np.int32)), pa.array(high), pa.array(low)], names=["dim", "high", "low"])


def sums(distinct: DataFrame) -> list[int]:
    """Exact sums of `x` by dimension."""
    parts = distinct.select("x").mapInArrow(_dimension_sums, "dim int, high long, low long").groupBy("dim")
    rows = parts.agg(F.sum("high").alias("high"), F.sum("low").alias("low")).collect()  # one per dimension
    return [(r["high"] << 20) + r["low"] for r in sorted(rows)]


def _centred(n: int, total: list[int], deviations: bool):
    """(idx, x) to (idx, (n * x - S) / n), and with the sum of the squares of n * x - S."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = np.array(total, dtype=np.int64)
        for batch in batches:
            x = batch.column(1).flatten().to_numpy().reshape(batch.num_rows, -1)
            near = x.astype(np.float64) * n
            apart = x * n - s if not batch.num_rows or np.abs(near).max() < _LIMIT else None
            if apart is None or ((near - s) ** 2).sum(axis=1).max(initial=0.0) > 2 * _LIMIT:
                raise OverflowError("a deviation is too large for a long")
            centred = apart / n
            offsets = np.arange(batch.num_rows + 1, dtype=np.int32) * len(s)
            arrays = [batch.column(0), pa.ListArray.from_arrays(pa.array(offsets), pa.array(centred.ravel()))]
            names = ["idx", "centred"]
            if deviations:
                arrays, names = [batch.column(0), pa.array((apart * apart).sum(axis=1))], ["idx", "deviation"]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return run


def blocks(rows: DataFrame, value: str, n: int, columns: int) -> BlockMatrix:
    """A BlockMatrix of `n` rows, from (idx, array `value`)."""
    vectors = MLUtils.convertVectorColumnsFromML(rows.select(F.col("idx").alias("index"), array_to_vector(value).alias("vector")), "vector")
    height = max(BLOCK_ROWS, -(-n // MOST_BLOCKS))
    return IndexedRowMatrix(vectors, n, columns).toBlockMatrix(height, BLOCK_COLUMNS)


def scatter(matrix: BlockMatrix, spark: SparkSession) -> np.ndarray:
    """The matrix's transpose times itself. Python's multiply has no number of splits along the
    rows, so the JVM's is called."""
    splits = min(matrix.numRowBlocks, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    turned = matrix.transpose()
    product = turned._java_matrix_wrapper.call("multiply", matrix._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(product, BLOCK_COLUMNS, BLOCK_COLUMNS).toLocalMatrix().toArray()


def times(matrix: BlockMatrix, local: np.ndarray, spark: SparkSession) -> DataFrame:
    """(idx, values) of the rows of `matrix` times a small matrix."""
    tall = range(0, local.shape[0], BLOCK_COLUMNS)
    parts = [local[at : at + BLOCK_COLUMNS] for at in tall]
    small = spark.sparkContext.parallelize([((k, 0), DenseMatrix(*p.shape, p.ravel(order="F"))) for k, p in enumerate(parts)], len(parts))
    product = matrix.multiply(BlockMatrix(small, BLOCK_COLUMNS, local.shape[1])).toIndexedRowMatrix()
    rows = callMLlibFunc("getIndexedRows", product._java_matrix_wrapper._java_model)
    rows = MLUtils.convertVectorColumnsToML(rows, "vector")
    return rows.select(F.col("index").alias("idx"), vector_to_array("vector").alias("values"))


def principal(covariance: np.ndarray, components: int) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors as columns, of those with variance. The largest
    entry of a vector is positive."""
    values, vectors = np.linalg.eigh((covariance + covariance.T) / 2)
    values, vectors = values[::-1], vectors[:, ::-1]
    keep = min(components, int((values > len(values) * np.finfo(float).eps * max(values[0], 0)).sum()))
    values, vectors = values[:keep], vectors[:, :keep]
    largest = vectors[np.abs(vectors).argmax(axis=0), np.arange(keep)]
    return values, vectors * np.where(largest < 0, -1.0, 1.0)


def whiten(vectors: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """A row per vector and component: vec_id, component from 1, n, deviation, whitened, explained,
    identity_error."""
    spark = vectors.sparkSession
    rows = narrow(vectors, vec_id=id_col, vector=vec_col).withColumn("vector", F.col("vector").cast("array<double>"))
    kind = rows.schema["vec_id"].dataType.simpleString()
    empty = spark.createDataFrame([], f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double")
    rows = durable(rows.mapInArrow(whole_numbers, f"vec_id {kind}, x array<long>"))
    lengths = rows.groupBy(F.size("x").alias("dim")).agg(F.count("*").alias("rows")).orderBy(F.desc("rows"), F.desc("dim")).first()
    if lengths is None:
        return empty
    dim = lengths["dim"]
    rows = rows.where(F.size("x") == dim)
    distinct = durable(numbered(rows.select("x", F.lit(0).alias("one")).distinct(), "one", [F.col("x")]).select("idx", "x"))
    n = distinct.count()
    total = sums(distinct)
    centred = distinct.select("idx", "x").mapInArrow(_centred(n, total, False), "idx long, centred array<double>")
    matrix = blocks(centred, "centred", n, dim)
    covariance = scatter(matrix, spark) / n
    values, basis = principal(covariance, components)
    if not len(values):
        return empty
    white = durable(times(matrix, basis / np.sqrt(values), spark))
    means = white.agg(*[F.avg(F.col("values")[k]).alias(str(k)) for k in range(len(values))]).first()
    level = white.select("idx", F.array(*[F.col("values")[k] - F.lit(means[k]) for k in range(len(values))]).alias("level"))
    error = float(np.abs(scatter(blocks(level, "level", n, len(values)), spark) / n - np.eye(len(values))).max())
    deviations = distinct.mapInArrow(_centred(n, total, True), "idx long, deviation long")
    fitted = durable(distinct.join(white, "idx").join(deviations, "idx").select("x", "deviation", "values"))
    explained = F.array(*[F.lit(float(v)) for v in values / np.trace(covariance)])
    out = rows.join(fitted, "x").select("vec_id", "deviation", F.posexplode("values").alias("k", "whitened"))
    return out.select(
        "vec_id", (F.col("k") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        F.element_at(explained, F.col("k") + 1).alias("explained"), F.lit(error).alias("identity_error"),
    )
