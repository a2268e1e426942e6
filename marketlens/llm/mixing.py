"""Mixing sources to target weights by Sainte-Laguë apportionment of equal-token blocks.

Sources, in the order of their names' code points and null last, weigh 5, 2, 1, repeating. The
words of all documents are shared out by weight; no target exceeds `cap` times its source's size,
and what is over goes to the others by weight.

The mix is cut into blocks of equally many words. Sources get blocks by the highest quotients
target / (2 * blocks + 1), then the shards of a source by the quotients of their sizes, which gives
every shard an integer quota. A shard holds a bounded number of documents on average, picked by a
seeded hash of id and text, so a source of any size, whatever its ids, is dealt over many. In a shard the documents stand
in seeded order on a circle; the quota's blocks are taken from a seeded place on, lap after lap. A
lap takes each word once, so no document is taken more than `cap` times.

The highest quotients are found among candidates: the number of blocks of a source differs from its
exact share by less than the share times the number of sources, and one.

Cases: null and empty texts have no words and none are taken. A null source is a source. Null ids
are ids; rows that repeat an id are documents of their own; rows that agree in id and text share a
shard. Equal quotients go by name or shard.
No rows, or no words, give targets of 0.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from marketlens.llm.common import free_names, narrow, small_batches, stored
from marketlens.session import durable

WEIGHTS = (5, 2, 1)
CAP = 3
#: Documents of a shard, on average.
SHARD_DOCS = 8_000
#: Words of a block: a thousandth of the smallest target, within these bounds.
BLOCK_WORDS = (1, 1024)
SEED = 20_240
_WHITE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])


def count_words(column: pa.Array) -> np.ndarray:
    """Runs of bytes other than ASCII white space, of each text."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    at = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    if len(at) < 2 or at[-1] == at[0]:
        return np.zeros(len(column), dtype=np.int64)
    white = _WHITE[np.frombuffer(column.buffers()[2], dtype=np.uint8)[at[0] : at[-1]]]
    at = at - at[0]
    first = np.append(True, white[:-1])  # what follows white space
    first[at[:-1][at[:-1] < len(first)]] = True
    return np.diff(np.searchsorted(np.flatnonzero(first & ~white), at))


@F.arrow_udf(LongType())
def _words(column: pa.Array) -> pa.Array:
    return pa.array(count_words(column), pa.int64())


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """`sources` (source, source_size) with weight and target: a row per source, so few rows."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    by_room = Window.orderBy("room", F.col("source").asc_nulls_last())
    kinds = F.array(*map(F.lit, weights))
    rows = sources.withColumn("weight", F.element_at(kinds, F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))).cast("int") + 1))
    rows = rows.withColumn("room", F.col("source_size") * cap / F.col("weight"))
    before = by_room.rowsBetween(Window.unboundedPreceding, -1)
    rest = by_room.rowsBetween(0, Window.unboundedFollowing)
    full = F.coalesce(F.sum("source_size").over(before), F.lit(0)) * cap
    whole = F.sum("source_size").over(Window.partitionBy())
    # the share of a unit of weight if all sources with less room are full
    rows = rows.withColumn("share", (whole - full) / F.sum("weight").over(rest))
    share = F.min(F.when(F.col("share") <= F.col("room"), F.struct("room", "share"))).over(Window.partitionBy())["share"]
    target = F.least((F.col("source_size") * cap).cast("double"), F.col("weight") * F.coalesce(share, F.lit(0.0)))
    return rows.select("source", "source_size", "docs", "weight", target.alias("target"))


def _apportion(rows: DataFrame, group: list[str], name: list[Column], claim: Column, blocks: Column, out: str) -> DataFrame:
    """`rows` with `out`: how many of a group's `blocks` each row gets by the highest quotients of `claim`."""
    all_of = Window.partitionBy(*group)
    rows = rows.withColumns({"__claim": claim.cast("double"), "__blocks": blocks})
    total, members = F.sum("__claim").over(all_of), F.count("*").over(all_of)
    fair = F.when(total > 0, F.col("__claim") / total * F.col("__blocks")).otherwise(0.0)
    part = F.when(total > 0, F.col("__claim") / total).otherwise(0.0)
    rows = rows.withColumns({"__fair": fair, "__slack": part * members + 1})
    rows = rows.withColumn("__sure", F.greatest(F.floor(F.col("__fair") - F.col("__slack")), F.lit(0).cast("long")))
    rows = rows.withColumn("__most", F.ceil(F.col("__fair") + F.col("__slack")))
    left = F.col("__blocks") - F.sum("__sure").over(all_of)
    seats = rows.withColumn("__left", left).where("__claim > 0 and __most > __sure")
    seats = seats.withColumn("__seat", F.explode(F.sequence("__sure", F.col("__most") - 1)))
    quotient = F.col("__claim") / (2 * F.col("__seat") + 1)
    place = F.row_number().over(Window.partitionBy(*group).orderBy(quotient.desc(), *name))
    key = [*group, *[c for c in ("source", "shard") if c in rows.columns and c not in group]]
    won = seats.withColumn("__place", place).where("__place <= __left")
    won = won.groupBy(*[F.col(k).alias(f"__{k}") for k in key]).agg(F.count("*").alias("__won"))
    joined = rows.join(won, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in key], "left").drop(*[f"__{k}" for k in key])
    return joined.withColumn(out, F.col("__sure") + F.coalesce("__won", F.lit(0))).drop(
        "__claim", "__blocks", "__fair", "__slack", "__sure", "__most", "__won"
    )


def shard_of(shards: Column, seed: int) -> Column:
    """The shard of a row (doc_id, text_hash): rows without an id, or with one id, are dealt as well."""
    return F.pmod(F.xxhash64("doc_id", "text_hash", F.lit(seed)), shards)


def mix(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    weights: tuple[int, ...] = WEIGHTS, cap: int = CAP, shard_docs: int = SHARD_DOCS, seed: int = SEED, also: tuple[Column, ...] = (),
) -> DataFrame:
    """A row per document: doc_id, size in words, source_size, target of its source, words taken.
    `also` are further columns of `docs` to keep."""
    small_batches(docs.sparkSession)
    rows = docs.select(
        docs[id_col].alias("doc_id"), docs[source_col].alias("source"), _words(docs[text_col]).alias("size"), F.xxhash64(docs[text_col]).alias("text_hash"), *also
    )
    sizes = durable(rows)
    extra = sizes.columns[3:]
    sources = durable(targets(sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("docs")), weights, cap))
    bounds = sources.agg(F.sum("source_size").alias("words"), F.min(F.when(F.col("target") > 0, F.col("target"))).alias("least")).first()
    block = int(min(max((bounds["least"] or 0) // 1000, BLOCK_WORDS[0]), BLOCK_WORDS[1]))
    blocks = F.lit(round((bounds["words"] or 0) / block)).cast("long")
    sources = sources.withColumn("shards", F.ceil(F.col("docs") / shard_docs))
    sources = _apportion(sources, [], [F.col("source").asc_nulls_last()], F.col("target"), blocks, "source_blocks")
    _, sources = stored(sources.select("source", "source_size", "target", "shards", "source_blocks"))
    sources = sources.withColumnRenamed("source", "__source_name")
    dealt = sizes.join(sources, F.col("source").eqNullSafe(F.col("__source_name"))).select(
        "doc_id", "source", "size", *extra, "source_size", "target", "source_blocks", shard_of(F.col("shards"), seed).alias("shard")
    )
    shards = dealt.groupBy("source", "shard", "source_blocks").agg(F.sum("size").alias("shard_size"))
    shards = _apportion(durable(shards), ["source"], [F.col("shard")], F.col("shard_size"), F.col("source_blocks"), "blocks")
    quota = F.least(F.col("blocks") * block, F.col("shard_size") * cap)
    start = F.when(F.col("shard_size") > 0, F.pmod(F.xxhash64(F.lit(seed + 1), "source", "shard"), F.col("shard_size"))).otherwise(0)
    _, shards = stored(shards.select(F.col("source").alias("s"), F.col("shard").alias("h"), "shard_size", quota.alias("quota"), start.alias("start")))
    seeded = Window.partitionBy("source", "shard").orderBy(F.xxhash64("doc_id", "text_hash", F.lit(seed + 2)), "doc_id", "size", *extra)
    placed = dealt.withColumn("end", F.sum("size").over(seeded.rowsBetween(Window.unboundedPreceding, 0)))
    placed = placed.join(shards, F.col("source").eqNullSafe(F.col("s")) & (F.col("shard") == F.col("h")))
    laps = F.when(F.col("shard_size") > 0, F.expr("quota div shard_size")).otherwise(F.lit(0).cast("long"))
    rest = F.when(F.col("shard_size") > 0, F.expr("quota % shard_size")).otherwise(F.lit(0).cast("long"))

    def overlap(begin: Column, stop: Column) -> Column:
        return F.greatest(F.least(F.col("end"), stop) - F.greatest(F.col("end") - F.col("size"), begin), F.lit(0).cast("long"))

    stop = F.col("start") + rest
    part = overlap(F.col("start"), stop) + overlap(F.lit(0).cast("long"), stop - F.col("shard_size"))
    return placed.select("doc_id", "size", "source_size", "target", (laps * F.col("size") + part).alias("taken"), *extra[1:])


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """`docs` as the mix has them: a document is repeated as often as its taken words, rounded to
    whole documents, say, and goes if that is 0. Documents without words stay as they are."""
    key = F.xxhash64(docs[text_col])
    shares = mix(docs, id_col, text_col, source_col, also=(key.alias("__key"), docs[source_col].alias("__source")))
    # rows that agree in id, source and text share what the mix takes of them
    shares = shares.groupBy("doc_id", "__source", "__key").agg(F.sum("taken").alias("__taken"), F.sum("size").alias("__size"))
    shares = shares.withColumnRenamed("doc_id", "__id")
    text, copy = free_names(docs, "__text", "__copy")
    rows = docs.withColumn(text, key)
    on = rows[id_col].eqNullSafe(shares["__id"]) & rows[source_col].eqNullSafe(shares["__source"]) & (rows[text] == shares["__key"])
    times = F.when(shares["__size"] > 0, F.floor(shares["__taken"] / shares["__size"] + 0.5).cast("int")).otherwise(1)
    repeated = rows.join(shares, on).withColumn(copy, F.explode(F.array_repeat(F.lit(0), times)))
    return repeated.select(*[rows[c] for c in docs.columns])
