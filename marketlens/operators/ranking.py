"""Min-max scaling, weighted scores, shares and global ranks without a one-task window."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marketlens.operators.aggregates import ratio
from marketlens.session import durable

_ROW_BITS = 33  # monotonically_increasing_id keeps the partition above the row number


def minmax(df: DataFrame, features: Mapping[str, str]) -> DataFrame:
    """Add `(x - min) / (max - min)` over all rows for each `{new column: column}`; null for
    a constant feature. `df` is read twice, so pass a stored table; the bounds are one row and
    come back as a scalar subquery."""
    bounds = df.agg(
        F.struct(
            *[F.min(c).alias(f"min_{n}") for n, c in features.items()],
            *[F.max(c).alias(f"max_{n}") for n, c in features.items()],
        ).alias("bounds")
    )
    scaled = df.withColumn("_b", bounds.scalar())
    for name, c in features.items():
        low, high = F.col(f"_b.min_{name}"), F.col(f"_b.max_{name}")
        scaled = scaled.withColumn(name, ratio(F.col(c) - low, high - low))
    return scaled.drop("_b")


def weighted_score(weights: Mapping[str, float]) -> Column:
    """100 x the weighted sum of normalised features; a missing feature adds nothing."""
    total = None
    for name, weight in weights.items():
        part = F.lit(weight) * F.coalesce(F.col(name), F.lit(0.0))
        total = part if total is None else total + part
    return F.lit(100.0) * total


def share_of_parent(df: DataFrame, value: str, parent: Sequence[str], out: str) -> DataFrame:
    """`value` divided by its sum over `parent`, for an aggregated table with a bounded number
    of rows per parent. A row with a null parent key gets no share."""
    total = F.sum(value).over(Window.partitionBy(*parent))
    known = F.lit(True)
    for key in parent:
        known = known & F.col(key).isNotNull()
    return df.withColumn(out, F.when(known, ratio(F.col(value), total)))


def global_rank(
    df: DataFrame, order: Sequence[Column], out: str, reader: SparkSession | None = None, rows_of_a_file: int = 0
) -> DataFrame:
    """Rank 1..n in `order`, which must be unique for the result to be repeatable.

    Rows are range-partitioned and sorted, their places are fixed by storing them, and each
    partition adds the number of rows in front of it. Only the counts per partition, one
    row each, meet in one task. `reader` and `rows_of_a_file` are those of `durable`."""
    placed = durable(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_place", F.monotonically_increasing_id()),
        reader,
        rows_of_a_file,
    ).withColumn("_part", F.shiftright("_place", _ROW_BITS))
    counts = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    row = F.col("_place").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return (
        placed.join(F.broadcast(offsets), "_part")  # one row per partition
        .withColumn(out, (F.col("_before") + row + F.lit(1)).cast("long"))
        .drop("_place", "_part", "_before")
    )

