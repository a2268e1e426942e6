"""What several operators share: Arrow batches of bounded bytes, runs of equal keys, checked broadcasts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marketlens.session import durable

#: Rows and bytes that Spark hands to Python at once; texts can be long, so few.
BATCH_ROWS = 500
BATCH_BYTES = 16 << 20
#: Bytes of a stored table (compressed) up to which it may be broadcast; beyond that the join shuffles.
BROADCAST_BYTES = 4 << 20
LEAST = -(2**63)


def small_batches(spark: SparkSession) -> None:
    """Keep the Arrow batches of texts small, so that a worker holds few long texts at once."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def narrow(docs: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns under the operator's own names; other columns can't clash."""
    return docs.select(*[docs[c].alias(name) for name, c in columns.items()])


def free_names(docs: DataFrame, *names: str) -> list[str]:
    """The names, each with underscores added until `docs` has no such column."""
    taken = {c.lower() for c in docs.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out


def stored(df: DataFrame, limit: int = BROADCAST_BYTES) -> tuple[DataFrame, DataFrame]:
    """`df` as a table in the checkpoint folder, and the same with a broadcast hint if the
    stored bytes are at most `limit`. Either way a join gives the same rows."""
    table = durable(df)
    plan = table._jdf.queryExecution().optimizedPlan()
    size = int(str(plan.stats().sizeInBytes()))
    return table, F.broadcast(table) if size <= limit else table


def one_row_per_id(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of `docs` (doc_id, text) that belong to `ids` (doc_id and more, few rows), stored: of
    rows that repeat an id the one with the least hash of its text, so there are as many as ids."""
    rows = docs.join(F.broadcast(ids), "doc_id")
    least = F.min(F.struct(F.xxhash64("text").alias("hash"), "text"))["text"]
    return durable(rows.groupBy(*ids.columns).agg(least.alias("text")))


def texts(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; null counts as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables of whole runs of equal keys, of one or more runs each, from sorted batches.

    Holds one batch and the run that is open at its end."""
    rest: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([*rest, batch])
        last = table.num_rows - 1
        same = np.ones(table.num_rows, dtype=bool)
        for key in keys:
            column = table.column(key).combine_chunks()
            column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
            same &= pc.equal(column, column[last]).to_numpy(zero_copy_only=False)
        start = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0
        if start:
            yield table.slice(0, start)
        rest = table.slice(start).to_batches()
    if rest:
        yield pa.Table.from_batches(rest)


def starts_of_runs(table: pa.Table, keys: list[str]) -> np.ndarray:
    """Where runs of equal keys start, and the number of rows at the end."""
    new = np.zeros(table.num_rows + 1, dtype=bool)
    new[0] = new[-1] = True
    for key in keys:
        column = table.column(key).to_numpy()
        new[1:-1] |= column[1:] != column[:-1]
    return np.flatnonzero(new)


def numbered(rows: DataFrame, group: str, order: list[Column]) -> DataFrame:
    """`rows`, stored, with idx, a row's place from 0 in its `group` (a column without nulls) by `order`,
    and n, the rows of the group. Rows that tie are numbered in any order.

    One range shuffle, in which a large group and ties are split by a seeded column; the places in
    the ranges are then shifted by the rows of the ranges before, one row per range and group."""
    salted = rows.withColumn("__salt", F.rand(1))
    keys = [F.col(group), *order, F.col("__salt")]
    ranged = salted.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("__salt")
    table = durable(ranged.withColumn("__at", F.monotonically_increasing_id()))
    ranges = table.groupBy(F.col(group).alias("__group"), F.shiftright("__at", 33).alias("__range"))
    ranges = ranges.agg(F.min("__at").alias("__first"), F.count("*").alias("__rows"))
    whole = Window.partitionBy("__group")
    before = whole.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    shifts = ranges.select(
        "__group", "__range", (F.coalesce(F.sum("__rows").over(before), F.lit(0)) - F.col("__first")).alias("__shift"), F.sum("__rows").over(whole).alias("n")
    )
    _, shifts = stored(shifts)
    on = (F.col(group) == F.col("__group")) & (F.shiftright("__at", 33) == F.col("__range"))
    return table.join(shifts, on).withColumn("idx", F.col("__at") + F.col("__shift")).drop("__at", "__group", "__range", "__shift")
