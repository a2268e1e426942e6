"""Connected components of links between long ids, by large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.session import durable


def _stars(near: DataFrame, both: DataFrame, keep: str, own: bool) -> DataFrame:
    """Join every neighbour of a node that `keep` lets through to the least one around the node."""
    least = durable(near.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")))
    out = both.where(keep).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    if own:
        out = out.unionByName(least.select("u", F.col("m").alias("v")))
    return out.where("u <> v").distinct()


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of `links` (u, v); root is the least node that can be reached.

    Each round's links are written to the checkpoint folder, so a lost executor costs a round at
    most. A node with very many links is aggregated before it is shuffled, and the joins are
    between stored tables, which adaptive execution splits on a hot key. Rounds grow with the
    logarithm of the longest path. Loops and repeated links do no harm; no links give no rows."""
    links = durable(links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    for _ in range(most_rounds):
        around = durable(links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v"))))
        large = durable(_stars(around, around, "v > u", own=False).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
        small = durable(_stars(large, large, "v < u", own=True).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
        if links.exceptAll(small).isEmpty() and small.exceptAll(links).isEmpty():
            return links.select(F.col("u").alias("node"), F.col("v").alias("root"))
        links = small
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")
