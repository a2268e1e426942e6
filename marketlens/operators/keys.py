"""Key-set operators: semi and anti joins, overlaps, de-duplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlens.session import durable


def non_empty(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNotNull() & (F.col(column) != ""))


def distinct_keys(df: DataFrame, column: str, out: str | None = None) -> DataFrame:
    """The non-empty values of a column, once each."""
    return non_empty(df, column).select(F.col(column).alias(out or column)).distinct()


def stored_keys(df: DataFrame, column: str) -> DataFrame:
    """`distinct_keys`, stored: they are used more than once, have a known size, and a join
    with a stored table is one AQE can split when the other side has a hot key."""
    return durable(distinct_keys(df, column))


def keep_known(df: DataFrame, keys: DataFrame, on: str = "cnpj_basico") -> DataFrame:
    """Rows whose key occurs in `keys`, a table of distinct keys."""
    return df.join(keys.select(on), on, "left_semi")


#: Keys of so many digits are places in a bitmap: 10^8 bits, 12.5 MB, however many rows there are.
KEY_DIGITS = 8
_BITS = 1 << 15  # of a row of the bitmap, as `bitmap_construct_agg` makes them


def _is_number(column: str) -> Column:
    return F.coalesce(F.col(column).rlike(f"^[0-9]{{{KEY_DIGITS}}}$"), F.lit(False))


def key_bitmap(keys: DataFrame, on: str) -> DataFrame:
    """The numeric keys as at most 10^8 / 2^15 rows of bits."""
    number = keys.filter(_is_number(on)).select(F.col(on).try_cast("long").alias("number"))
    rows = number.groupBy((F.col("number") / _BITS).cast("long").alias("_row"))
    return rows.agg(F.bitmap_construct_agg(F.col("number") % _BITS).alias("_bits"))


def keep_known_numbers(df: DataFrame, keys: DataFrame, on: str = "cnpj_basico") -> DataFrame:
    """`keep_known` for keys of eight digits: their bitmap is broadcast, which its size allows for any
    number of keys, and the rows stay where they are. Other keys, which are exceptions, join."""
    number = F.col(on).try_cast("long")
    place = (number % _BITS).cast("int")
    byte = F.conv(F.hex(F.substring(F.col("_bits"), (place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    known = byte.bitwiseAND(F.element_at(F.array(*[F.lit(1 << k) for k in range(8)]), place % 8 + 1)) != 0
    numeric = df.filter(_is_number(on)).withColumn("_row", (number / _BITS).cast("long"))
    held = numeric.join(F.broadcast(key_bitmap(keys, on)), "_row").filter(known).select(*df.columns)
    others = keep_known(df.filter(~_is_number(on)), keys.filter(~_is_number(on)), on).select(*df.columns)
    return held.unionByName(others)


def missing_keys(required: DataFrame, found: DataFrame, on: Sequence[str]) -> DataFrame:
    """Required keys that were not found."""
    return required.join(found.select(*on).distinct(), list(on), "left_anti")


def key_overlap(left: DataFrame, right: DataFrame, left_key: str, right_key: str, name: str) -> DataFrame:
    """How many distinct keys of `left` occur in `right`: one row of counts and a percentage."""
    wanted = distinct_keys(left, left_key, "key")
    known = distinct_keys(right, right_key, "key").withColumn("known", F.lit(1))
    counts = wanted.join(known, "key", "left").agg(
        F.count(F.lit(1)).alias("distintos"), F.count("known").alias("com_match")
    )
    percent = F.lit(100.0) * F.col("com_match") / F.nullif(F.col("distintos"), F.lit(0))
    return counts.select(
        F.lit(name).alias("dimensao"),
        "distintos",
        "com_match",
        F.round(F.coalesce(percent, F.lit(0.0)), 2).alias("percentual_match"),
    )


def dedup_dim(df: DataFrame, key: str) -> DataFrame:
    """One row per key with the largest value of every other column, each on its own."""
    others = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(*[F.max(c).alias(c) for c in others])


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys occurring more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def union_parts(parts: Sequence[DataFrame]) -> DataFrame:
    """All parts of a table, one after the other."""
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole
