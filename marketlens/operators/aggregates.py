"""Aggregation helpers that stay exact and spread hot groups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlens.session import durable

# Bits that a round of the radix selection settles: a task sees at most 2^16 counts of a group.
_DIGIT = 16


# Amounts below this are added up exactly, with twelve decimals; 10^8 rows of them fit a sum.
_EXACT_BELOW = 1e18


def money_parts(c: str) -> dict[str, Column]:
    """Two sums that make up the total of a money column: of what fits a decimal, exact in any
    order of the rows, and of the rest as doubles."""
    fits = F.abs(c) < _EXACT_BELOW
    return {
        f"{c}_exact": F.sum(F.when(fits, F.col(c)).cast("decimal(30,12)")),
        f"{c}_rest": F.sum(F.when(~fits, F.col(c))),
    }


def sum_money(c: str) -> Column:
    exact, rest = money_parts(c).values()
    return F.coalesce(exact.cast("double"), F.lit(0.0)) + F.coalesce(rest, F.lit(0.0))


def ratio(a: Column, b: Column) -> Column:
    """a / b, null where b is null or 0."""
    return a / F.nullif(b, F.lit(0))


def value_histogram(df: DataFrame, keys: Sequence[str], measures: Sequence[str], count: Column | None = None) -> DataFrame:
    """One row per group, measure and distinct value, with `n` copies: rows, or `count` of them.

    Rows are counted before the shuffle and a group spreads over its values, so a group
    holding most of the rows is no heavier for a task than any other."""
    melted = df.withColumn(
        "_m",
        F.explode(
            F.array(*[F.struct(F.lit(m).alias("measure"), F.col(m).cast("double").alias("value")) for m in measures])
        ),
    )
    return melted.groupBy(*keys, F.col("_m.measure").alias("measure"), F.col("_m.value").alias("value")).agg(
        (F.count(F.lit(1)) if count is None else count).alias("n")
    )


def ordered_bits(value: Column) -> Column:
    """A double as the long that sorts like it: its bits, all but the sign turned over below zero."""
    bits = F.reflect(F.lit("java.lang.Double"), F.lit("doubleToLongBits"), value + F.lit(0.0)).cast("long")  # -0.0 as 0.0
    return F.when(bits < 0, bits.bitwiseXOR(F.lit(2**63 - 1))).otherwise(bits)


def histogram_medians(hist: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Exact interpolated median per group and measure from `value_histogram`, nulls left out.

    Radix selection for all groups at once: the 64 bits that sort like the values are settled 16 at a
    time. Counts per prefix of 48, 32 and 16 bits are added up from those per value; then the middle
    ranks go down from the shortest prefix, each to the one among its prefix's at most 2^16
    continuations that holds it. So no task handles more of a group than that, whatever the values
    and the group's size. The keys travel as one struct: as join keys, structs match null fields
    with each other."""
    group = ["key", "measure"]
    values = hist.filter(F.col("value").isNotNull()).select(
        F.struct(*keys).alias("key"), "measure", ordered_bits(F.col("value")).alias("prefix"), "value", "n"
    )
    levels = [values]
    for _ in range(64 // _DIGIT - 1):
        shorter = levels[0].groupBy(*group, F.shiftright("prefix", _DIGIT).alias("prefix"))
        levels.insert(0, shorter.agg(F.sum("n").alias("n")))
    first, *rest = levels
    counts = first.withColumns({"total": F.sum("n").over(Window.partitionBy(*group)), "end": F.lit(0)})
    middle = F.array_distinct(F.array(F.floor((F.col("total") - 1) / 2), F.floor(F.col("total") / 2)))
    counts = counts.withColumn("rank", F.explode(middle))
    for level in [*rest, None]:
        inside = Window.partitionBy(*group, "end", "rank").orderBy("prefix")
        upto = counts.withColumn("upto", F.sum("n").over(inside))
        held = (F.col("upto") > F.col("rank")) & (F.col("upto") - F.col("n") <= F.col("rank"))
        chosen = upto.filter(held).withColumn("rank", F.col("rank") - (F.col("upto") - F.col("n")))
        if level is not None:
            longer = level.withColumn("end", F.shiftright("prefix", _DIGIT))
            counts = longer.join(chosen.select(*group, F.col("prefix").alias("end"), "rank"), [*group, "end"])
    ends = chosen.groupBy(*group).agg((F.min("value") * F.lit(0.5) + F.max("value") * F.lit(0.5)).alias("median"))
    return ends.select("key.*", "measure", "median")


def grouped_medians(df: DataFrame, keys: Sequence[str], measures: Sequence[str], count: Column | None = None) -> DataFrame:
    """Exact median of each measure per group, one column per measure; groups without a value keep
    their row. `df` is read once; `count` is as in `value_histogram`."""
    hist = durable(value_histogram(df, keys, measures, count))
    medians = histogram_medians(hist, keys).select(F.struct(*keys).alias("key"), "measure", "median")
    wide = medians.groupBy("key").agg(*[F.max(F.when(F.col("measure") == m, F.col("median"))).alias(m) for m in measures])
    groups = hist.select(F.struct(*keys).alias("key")).distinct()
    return groups.join(wide, "key", "left").select("key.*", *measures)


def histogram(df: DataFrame, key: Column | str, name: str, n: str = "n") -> DataFrame:
    """Rows per value of `key`."""
    return df.groupBy((F.col(key) if isinstance(key, str) else key).alias(name)).agg(F.count(F.lit(1)).alias(n))


def with_empty(counts: DataFrame, keys: DataFrame, key: str = "source") -> DataFrame:
    """Rows `n` per key, 0 for those of `keys` that have none."""
    known = counts.join(keys.select(key).distinct(), key, "full_outer")
    return known.select(key, F.coalesce("n", F.lit(0)).alias("n"))


def top(df: DataFrame, count: str, keys: Sequence[str], n: int) -> DataFrame:
    """The n largest rows by `count`; ties go to the smaller key."""
    return df.orderBy(F.desc_nulls_last(count), *[F.asc_nulls_last(k) for k in keys]).limit(n)


def histogram_json(df: DataFrame, key: str, n: str, most: int = 1_000, others: str = "outros") -> DataFrame:
    """A histogram as one JSON object, largest count first. Beyond the `most` largest keys the counts are
    added up under `others`, last, so the object and the task that writes it stay small for any keys.
    Null and empty keys are one."""
    counts = durable(df.groupBy(F.coalesce(F.col(key), F.lit("")).alias("key")).agg(F.sum(n).alias("value")))
    largest = top(counts, "value", ["key"], most)
    kept = largest.agg(F.collect_list(F.struct((-F.col("value")).alias("rank"), "key", "value")).alias("kept"), F.sum("value").alias("sum"))
    rest = F.coalesce(F.col("whole") - F.col("sum"), F.lit(0))
    pair = lambda x: F.struct(x["key"].alias("key"), x["value"].alias("value"))
    same = F.filter("kept", lambda x: x["key"] == others)
    own = F.aggregate(same, F.lit(0).cast("long"), lambda total, x: total + x["value"])
    split = F.transform(F.array_sort(F.filter("kept", lambda x: x["key"] != others)), pair)
    last = F.array(F.struct(F.lit(others).alias("key"), (rest + own).alias("value")))
    pairs = F.when(rest > 0, F.concat(split, last)).otherwise(F.transform(F.array_sort("kept"), pair))
    return kept.withColumn("whole", counts.agg(F.sum("value")).scalar()).select(F.to_json(F.map_from_entries(pairs)).alias("json"))
