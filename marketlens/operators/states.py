"""Aggregates that can be taken from rows, or merged from partial states of them.

`partial_states` reads a table once and stores what aggregates need of it, at the finest cell: the
keys together with the measured values, so that also medians can be taken from the states. Every
coarser table is then an aggregate of the states, written with the same expressions: `ROWS` spells
them over rows, `STATES` over states."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlens.operators.aggregates import money_parts, ratio, sum_money
from marketlens.session import durable


@dataclass(frozen=True)
class _Rows:
    """Aggregates over rows."""

    def count(self, c: str | None = None) -> Column:
        return F.count(F.lit(1) if c is None else c)

    def money(self, c: str) -> Column:
        return sum_money(c)

    def mean(self, c: str) -> Column:
        return F.avg(c)


@dataclass(frozen=True)
class _States:
    """The same, merged from partial states."""

    def count(self, c: str | None = None) -> Column:
        rows = F.col("n") if c is None else F.when(F.col(c).isNotNull(), F.col("n"))
        return F.coalesce(F.sum(rows), F.lit(0))

    def money(self, c: str) -> Column:
        exact, rest = F.sum(f"{c}_exact").cast("double"), F.sum(f"{c}_rest")
        return F.coalesce(exact, F.lit(0.0)) + F.coalesce(rest, F.lit(0.0))

    def mean(self, c: str) -> Column:
        return ratio(F.sum(F.col(c) * F.col("n")).cast("double"), self.count(c))


ROWS, STATES = _Rows(), _States()


def partial_states(df: DataFrame, keys: Sequence[str], money: Sequence[str], values: Sequence[str], largest: Sequence[str]) -> DataFrame:
    """One stored row per keys, `money` and `values`: their count `n`, the exact and the other part
    of each money column's sum, and the `largest` value of some other columns.

    Rows are merged before the shuffle, and a hot key is spread over the values it holds. `values` are
    integers; the cell of a table whose amounts all differ is one row, with these columns alone."""
    return durable(
        df.groupBy(*keys, *money, *values).agg(
            F.count(F.lit(1)).alias("n"),
            *[part.alias(name) for c in money for name, part in money_parts(c).items()],
            *[F.max(c).alias(c) for c in largest],
        )
    )
