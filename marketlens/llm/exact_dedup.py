"""Exact dedup by content-defined chunk recipes.

A text (null: empty) is lower-cased in A-Z alone and cut where a rolling hash of its last bytes
says so, so equal texts are cut alike. Chunks become identifiers: their XXH64, verified by
comparing the bytes of every chunk that has it. Texts are equal when their ordered lists of
identifiers are. Long texts move once, as chunks; after that only the lists do.

An identifier that two different chunks share is not verified; documents that hold one are
compared by the digest of their whole text besides, so the result doesn't depend on the hash.

Cases: null and empty texts are one group. Of equal texts the largest doc_id stays, a null
doc_id only among nulls. Rows that repeat a doc_id with an equal text are one document:
`dedup` marks each of them alike, `keep_one` leaves one row. No rows give no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from marketlens.llm.common import free_names, narrow, small_batches, texts
from marketlens.session import durable

WINDOW = 16
#: One place in so many is a cut, on average.
MEAN_CHUNK = 1024
#: A chunk without a cut ends here.
MAX_CHUNK = 1 << 16
_FACTOR = 0x01000193
_OUT = pa.schema(
    [("doc_id", pa.int64()), ("digest", pa.string()), ("recipe", pa.list_(pa.int64())), ("chunk_id", pa.int64()), ("chunk", pa.binary())]
)
_DDL = "doc_id long, digest string, recipe array<long>, chunk_id long, chunk binary"


def cuts(data: bytes, mean: int = MEAN_CHUNK, longest: int = MAX_CHUNK) -> list[int]:
    """Ends of the chunks of `data`, the last one its length."""
    if len(data) <= WINDOW:
        return [len(data)] if data else []
    sums, width = np.frombuffer(data, dtype=np.uint8).astype(np.uint32), 1
    while width < WINDOW:
        sums = sums[:-width] * np.uint32(pow(_FACTOR, width, 1 << 32)) + sums[width:]
        width *= 2
    sums ^= sums >> np.uint32(15)
    sums *= np.uint32(0x85EBCA6B)
    ends = np.flatnonzero((sums >> np.uint32(8)) % np.uint32(mean) == 0) + WINDOW
    out, last = [], 0
    for end in [*ends.tolist(), len(data)]:
        out.extend(range(last + longest, end, longest))
        if end > last:
            out.append(end)
        last = end
    return out


def _recipes(mean: int, bits: int):
    cover = (1 << bits) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, recipes, chunks = [], [], {}
            for data in texts(batch.column(1)):
                data = data.lower()  # of bytes: A-Z alone
                digests.append(hashlib.sha256(data).hexdigest())
                recipe, start = [], 0
                for end in cuts(data, mean):
                    chunk = data[start:end]
                    ident = (xxhash.xxh64_intdigest(chunk) & cover) - (1 << 63 if bits == 64 else 0)
                    recipe.append(ident)
                    chunks[ident, chunk] = None
                    start = end
                recipes.append(recipe)
            n, m = batch.num_rows, len(chunks)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.concat_arrays([batch.column(0), pa.nulls(m, pa.int64())]),
                    pa.array(digests + [None] * m, pa.string()),
                    pa.array(recipes + [None] * m, pa.list_(pa.int64())),
                    pa.array([None] * n + [k for k, _ in chunks], pa.int64()),
                    pa.array([None] * n + [c for _, c in chunks], pa.binary()),
                ],
                schema=_OUT,
            )

    return run


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", mean: int = MEAN_CHUNK, bits: int = 64) -> DataFrame:
    """A row per document: doc_id, keep_id, group_size, kept, text_sha256 of the lower-cased text.

    `bits` of the hash make an identifier; few of them serve to test what collisions do."""
    spark = docs.sparkSession
    small_batches(spark)
    rows = narrow(docs, doc_id=id_col, text=text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    table = durable(rows.mapInArrow(_recipes(mean, bits), _DDL))
    chunks = table.where("chunk is not null").groupBy("chunk_id").agg(F.min("chunk").alias("a"), F.max("chunk").alias("b"))
    unverified = durable(chunks.where("a <> b").select("chunk_id"))
    recipes = table.where("digest is not null").select("doc_id", "digest", "recipe")
    if unverified.isEmpty():
        recipes = recipes.withColumn("beside", F.lit(""))
    else:
        doubtful = recipes.select("digest", F.explode("recipe").alias("chunk_id")).join(unverified, "chunk_id", "left_semi")
        doubtful = doubtful.select("digest").distinct().withColumn("beside", F.col("digest"))
        recipes = recipes.join(doubtful, "digest", "left").withColumn("beside", F.coalesce("beside", F.lit("")))
    keys = ["folded", "recipe", "beside"]
    recipes = recipes.withColumn("folded", F.xxhash64("recipe"))
    groups = durable(recipes.groupBy(*keys).agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size")))
    return recipes.join(groups, keys).select(
        "doc_id", "keep_id", "group_size", F.expr("doc_id <=> keep_id").alias("kept"), F.col("digest").alias("text_sha256")
    )


@F.arrow_udf(StringType())
def text_digest(column: pa.Array) -> pa.Array:
    return pa.array([hashlib.sha256(x.lower()).hexdigest() for x in texts(column)], pa.string())


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs` that stay, in the columns of `docs`."""
    (digest,) = free_names(docs, "__digest")
    kept = dedup(docs, id_col, text_col).where("kept").select(F.col("doc_id").alias("__id"), F.col("text_sha256").alias("__sha")).distinct()
    rows = docs.withColumn(digest, text_digest(docs[text_col]))
    stay = rows.join(kept, rows[id_col].cast("long").eqNullSafe(kept["__id"]) & (rows[digest] == kept["__sha"]), "left_semi")
    return stay.dropDuplicates([id_col, digest]).drop(digest)
