"""SimHash near-dedup by covering locality-sensitive hashing.

A text is lower-cased in A-Z, cut at ASCII white space into words, and its word shingles (repeats
included; the whole sequence if it has fewer words) vote with their XXH64 of seed 42: a bit is
set if it is set in over half of the hashes. No words: fingerprint zero.

Two fingerprints link at up to `radius` differing bits. Every bit position gets one of the
2^(radius+1) - 1 nonzero vectors of radius+1 bits, in turn. For each such vector v there is a
table, keyed by the fingerprint under the mask of the positions whose vector has an odd product
with v. At most `radius` differing positions leave a nonzero v with even products for all of
them, so in v's table the pair collides: none within the radius is lost.

Distinct fingerprints are compared, not documents, so exact copies cost nothing. A bucket emits a
spanning forest of its links, never all of its pairs. A bucket of more than `limit` fingerprints
is covered again on the bits its mask leaves free: its members then agree on three quarters of the
bits, so a bucket holds at most 2^17 values at any size of the input, compared in blocks.
Components come from large-star and small-star rounds over the forests.

Cases: null and empty texts have fingerprint zero, linked like any other. A null doc_id is never
the least one, unless a component has no other. Repeated rows are all returned. No rows give none.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.llm.common import free_names, narrow, runs, small_batches, starts_of_runs, stored, texts
from marketlens.llm.components import components
from marketlens.session import durable

SHINGLE = 4
RADIUS = 4
#: Fingerprints of a bucket up to which it is compared as it is.
BUCKET_LIMIT = 4096
BITS = 64
_SLAB = 1 << 16
#: Of each byte value, its bits in eight lanes of a byte.
_LANES = (
    np.unpackbits(np.arange(256, dtype=np.uint8).reshape(-1, 1), axis=1, bitorder="little").copy().view(np.uint64).ravel()
)


def votes(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each bit, lowest bit first."""
    if not len(hashes):
        return np.zeros(BITS, dtype=np.int64)
    lanes = _LANES[hashes.view(np.uint8).reshape(-1, 8)]
    sums = np.add.reduceat(lanes, np.arange(0, len(lanes), 255), axis=0)  # 255 fit a byte
    return sums.view(np.uint8).reshape(-1, BITS).sum(axis=0, dtype=np.int64)


def fingerprint(data: bytes, shingle: int = SHINGLE) -> int:
    """Of the UTF-8 bytes of a text."""
    words = data.lower().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    if n == 1:
        return xxhash.xxh64_intdigest(b" ".join(words), 42)
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    begins = np.concatenate([[0], ends[:-1] + 1])
    total = np.zeros(BITS, dtype=np.int64)
    for at in range(0, n, _SLAB):
        a, b = begins[at : min(at + _SLAB, n)].tolist(), ends[at + shingle - 1 : min(at + _SLAB, n) + shingle - 1].tolist()
        total += votes(np.fromiter((digest(joined[i:j], 42) for i, j in zip(a, b)), np.uint64, len(a)))
    return int(np.packbits(2 * total > n, bitorder="little").view(np.uint64)[0])


def _fingerprints(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.array([fingerprint(x, shingle) for x in texts(batch.column(1))], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(prints.view(np.int64))], names=["doc_id", "sig", "fp"])

    return run


def covering_masks(positions: list[int], radius: int = RADIUS) -> list[int]:
    """Masks over the given bit positions, of which every `radius` positions miss one entirely."""
    vectors = range(1, 1 << (radius + 1))
    place = {p: 1 + i % len(vectors) for i, p in enumerate(positions)}
    return [sum(1 << p for p, own in place.items() if (own & v).bit_count() & 1) for v in vectors]


def signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def forest(prints: np.ndarray, radius: int, block: int = 2048) -> list[tuple[int, int]]:
    """Links (index, index of an earlier one) that join what is within the radius, fewer than rows."""
    parent = list(range(len(prints)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for a in range(0, len(prints), block):
        for b in range(a, len(prints), block):
            near = np.bitwise_count(prints[a : a + block, None] ^ prints[None, b : b + block]) <= radius
            for i, j in zip(*(x.tolist() for x in np.nonzero(np.triu(near, 1) if a == b else near))):
                x, y = root(a + i), root(b + j)
                if x != y:
                    parent[max(x, y)] = min(x, y)
    return [(i, root(i)) for i in range(len(prints)) if root(i) != i]


def _links(radius: int, keys: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in runs(batches, keys):
            at, prints = starts_of_runs(table, keys), table.column("fp").to_numpy().view(np.uint64)
            left, right = [], []
            for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
                for i, j in forest(prints[a:b], radius):
                    left.append(prints[a + i])
                    right.append(prints[a + j])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.array(x, dtype=np.uint64).view(np.int64)) for x in (left, right)], names=["u", "v"]
            )

    return run


def near_links(prints: DataFrame, radius: int = RADIUS, limit: int = BUCKET_LIMIT) -> DataFrame:
    """(u, v) of distinct fingerprints `fp` within the radius: enough to connect all that are linked."""
    masks = covering_masks(list(range(BITS)), radius)
    spread = prints.select(
        "fp", F.explode(F.array(*[F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(signed(m))).alias("key")) for t, m in enumerate(masks)])).alias("x")
    ).select("fp", "x.t", "x.key")
    sizes = spread.groupBy("t", "key").agg(F.count("*").alias("n"), F.min("fp").alias("u"), F.max("fp").alias("v")).where("n > 1")
    sizes = durable(sizes)
    pairs = sizes.where("n = 2").select("u", "v").where(F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= radius)
    _, larger = stored(sizes.where("n > 2").select("t", "key", (F.col("n") > limit).alias("hot")))
    members = spread.join(larger, ["t", "key"]).withColumns({"s": F.lit(-1), "sub": F.lit(0).cast("long")})
    if not sizes.where(F.col("n") > limit).isEmpty():
        again = [
            (t, s, signed(m))
            for t, mask in enumerate(masks)
            for s, m in enumerate(covering_masks([p for p in range(BITS) if not mask >> p & 1], radius))
        ]
        again = F.broadcast(prints.sparkSession.createDataFrame(again, "t int, s int, mask long"))  # as many rows at any size
        hot = members.where("hot").drop("s", "sub").join(again, "t").withColumn("sub", F.col("fp").bitwiseAND(F.col("mask")))
        members = members.where("not hot").unionByName(hot.select("fp", "t", "key", "hot", "s", "sub"))
    keys = ["t", "key", "s", "sub"]
    members = members.select(*keys, "fp").repartition(*keys).sortWithinPartitions(*keys, "fp")
    return pairs.unionByName(members.mapInArrow(_links(radius, keys), "u long, v long")).distinct()


def _labelled(docs: DataFrame, id_col: str, text_col: str, shingle: int, radius: int, limit: int) -> DataFrame:
    small_batches(docs.sparkSession)
    rows = narrow(docs, doc_id=id_col, text=text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    rows = rows.withColumn("sig", F.xxhash64("text"))
    table = durable(rows.mapInArrow(_fingerprints(shingle), "doc_id long, sig long, fp long"))
    nodes = durable(table.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = components(near_links(nodes.select("fp"), radius, limit)).withColumnRenamed("node", "fp")
    labels = durable(nodes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp")))
    least = durable(labels.groupBy("root").agg(F.min("least").alias("component_id")))
    labels = durable(labels.join(least, "root").select("fp", "root", "component_id"))
    return table.join(labels, "fp")


def simhash(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, radius: int = RADIUS, limit: int = BUCKET_LIMIT
) -> DataFrame:
    """A row per document: doc_id, fingerprint as 16 hex digits, component_id (its smallest doc_id)."""
    return _labelled(docs, id_col, text_col, shingle, radius, limit).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each component, of its smallest doc_id, in the columns of `docs`. Components are told
    apart by their root, since several can have one component_id (null, or that of different texts)."""
    first = _labelled(docs, id_col, text_col, SHINGLE, RADIUS, BUCKET_LIMIT).where("doc_id <=> component_id")
    kept = first.groupBy("root").agg(F.first("component_id").alias("__id"), F.min("sig").alias("__sig")).drop("root")
    (text,) = free_names(docs, "__text")
    rows = docs.withColumn(text, F.xxhash64(docs[text_col]))
    stay = rows.join(kept, rows[id_col].cast("long").eqNullSafe(kept["__id"]) & (rows[text] == kept["__sig"]), "left_semi")
    return stay.dropDuplicates([id_col, text]).drop(text)
