"""Nearest neighbours by a block matrix join: exact, with int8 products to spare the rest.

Vectors are packed into tiles of bounded rows where they lie. Every tile of queries meets every
tile of candidates once: query tiles are repeated for each group of candidate tiles, and the two
are joined on the group. For a pair of tiles the product of their int8 values gives all cosines
within a known error: with x = s*q + e for a unit vector x, |x.y - s*t*q.r| <= |e| + (1 + |e|)|f|
for the other vector's error f. A pair whose upper bound is below what its query has for certain
can't be among the nearest; the others are computed again from the original vectors in double
precision, dimension by dimension, so that equal vectors score equally in any tile. Each task
keeps a heap per query; the heaps are merged by rank, nearest first, ties to the smaller id.

No candidate is left out by sampling, so the recall is 1.

Cases: vectors that are null, empty or zero, or hold null or non-finite components, take no part,
neither do null ids. Vectors of different length are not compared. Rows that repeat an id count as
one candidate, the nearest of them, and never as neighbours of their own id. No rows give none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlens.llm.common import narrow

NEAREST = 5
CANDIDATE_ROWS = 1024
QUERY_ROWS = 256
#: Query tiles whose heaps a task holds before it hands them on.
HEAPS = 64
_MARGIN = 1e-9
_TILE = pa.schema([("dim", pa.int32()), ("ids", pa.binary()), ("vectors", pa.binary()), ("small", pa.binary()), ("scales", pa.binary()), ("errors", pa.binary())])
_TILE_DDL = "dim int, ids binary, vectors binary, small binary, scales binary, errors binary"
_TILE_COLUMNS = _TILE.names[1:]


def _sums(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row products, added up dimension by dimension."""
    total = np.zeros(len(a))
    for j in range(a.shape[1]):
        total += a[:, j] * b[:, j]
    return total


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.clip(_sums(a, b) / np.sqrt(_sums(a, a) * _sums(b, b)), -1.0, 1.0)


def quantised(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 values, scales and error lengths of the unit vectors."""
    unit = vectors / np.sqrt((vectors * vectors).sum(axis=1))[:, None]
    scales = np.abs(unit).max(axis=1) / 127
    small = np.rint(unit / scales[:, None]).astype(np.int8)
    return small, scales, np.sqrt(((unit - small * scales[:, None]) ** 2).sum(axis=1))


def _packed(dim: int, ids: np.ndarray, vectors: np.ndarray) -> list:
    small, scales, errors = quantised(vectors)
    return [dim, ids.tobytes(), vectors.tobytes(), small.tobytes(), scales.tobytes(), errors.tobytes()]


def _tiles(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}

        def tiles(last: bool) -> Iterator[list]:
            for dim, parts in waiting.items():
                ids, vectors = (np.concatenate(x) for x in zip(*parts))
                whole = len(ids) if last else len(ids) // size * size
                for at in range(0, whole, size):
                    yield _packed(dim, ids[at : min(at + size, whole)], vectors[at : min(at + size, whole)])
                waiting[dim] = [(ids[whole:], vectors[whole:])]

        def batch_of(rows: list[list]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows) if rows else [[]] * len(_TILE), _TILE)], schema=_TILE)

        for batch in batches:
            vectors = batch.column(1)
            lengths = pc.list_value_length(vectors).fill_null(0).to_numpy(zero_copy_only=False)
            for dim in np.unique(lengths[lengths > 0]).tolist():
                own = pa.array(lengths == dim)
                ids = batch.column(0).filter(own)
                flat = vectors.filter(own).flatten()
                rows = flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)  # null becomes NaN
                most = np.abs(rows).max(axis=1)
                fine = np.isfinite(rows).all(axis=1) & (most > 0) & ids.is_valid().to_numpy(zero_copy_only=False)
                rows, most = rows[fine], most[fine]
                with np.errstate(over="ignore", under="ignore"):
                    square = (rows * rows).sum(axis=1)
                far = ~np.isfinite(square) | (square < 1e-200) | (square > 1e150)
                rows[far] /= most[far, None]  # a cosine doesn't depend on the length
                waiting.setdefault(dim, []).append((ids.fill_null(0).to_numpy(zero_copy_only=False)[fine].astype(np.int64), rows))
            if any(sum(len(i) for i, _ in parts) >= size for parts in waiting.values()):
                yield from (batch_of([t]) for t in tiles(last=False))
        yield from (batch_of([t]) for t in tiles(last=True))

    return run


class _Tile:
    """A tile as arrays."""

    def __init__(self, dim: int, ids: bytes, vectors: bytes, small: bytes, scales: bytes, errors: bytes):
        self.ids = np.frombuffer(ids, dtype=np.int64)
        self.vectors = np.frombuffer(vectors).reshape(-1, dim)
        # sums of int8 products are exact in these types
        self.small = np.frombuffer(small, dtype=np.int8).reshape(-1, dim).astype(np.float32 if dim <= 1000 else np.float64)
        self.scales, self.errors = np.frombuffer(scales), np.frombuffer(errors)


def _best(query: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of each query's k nearest, an id once."""
    order = np.lexsort((-scores, ids, query))
    first = np.ones(len(order), dtype=bool)
    first[1:] = (query[order][1:] != query[order][:-1]) | (ids[order][1:] != ids[order][:-1])
    order = order[first]
    order = order[np.lexsort((ids[order], -scores[order], query[order]))]
    start = np.flatnonzero(np.append(True, query[order][1:] != query[order][:-1])) if len(order) else np.zeros(0, dtype=int)
    place = np.arange(len(order)) - np.repeat(start, np.diff(np.append(start, len(order))))
    return order[place < k]


def meet(queries: _Tile, candidates: _Tile, heap: tuple[np.ndarray, np.ndarray, np.ndarray], k: int):
    """The heap (query place, id, score) after this pair of tiles."""
    about = (queries.small @ candidates.small.T).astype(np.float64) * queries.scales[:, None] * candidates.scales[None, :]
    slack = queries.errors[:, None] + (1 + queries.errors[:, None]) * candidates.errors[None, :] + _MARGIN
    own = queries.ids[:, None] == candidates.ids[None, :]
    low = np.where(own, -2.0, about - slack)
    certain = np.full(len(queries.ids), -2.0)
    # repeated ids fill the k places of a tile together, so the bound of a tile with any is not used
    if low.shape[1] >= k and len(np.unique(candidates.ids)) == len(candidates.ids):
        certain = np.partition(low, low.shape[1] - k, axis=1)[:, low.shape[1] - k]
    place, ids, scores = heap
    counts = np.bincount(place, minlength=len(certain))
    kept = np.full(len(certain), np.inf)
    np.minimum.at(kept, place, scores)
    certain = np.maximum(certain, np.where(counts >= k, kept, -2.0) - _MARGIN)
    q, c = np.nonzero((about + slack >= certain[:, None]) & ~own)
    exact = cosines(queries.vectors[q], candidates.vectors[c])
    place, ids, scores = np.append(place, q), np.append(ids, candidates.ids[c]), np.append(scores, exact)
    best = _best(place, ids, scores, k)
    return place[best], ids[best], scores[best]


def _search(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heaps: dict[bytes, tuple] = {}
        none = np.zeros(0, dtype=np.int64)

        def out() -> pa.RecordBatch:
            parts = [(np.frombuffer(ids, dtype=np.int64)[heap[0]], heap[1], heap[2]) for ids, heap in heaps.items()]
            columns = [np.concatenate(x) for x in zip(*parts)] if parts else [none, none, none.astype(float)]
            heaps.clear()
            return pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=["query_id", "vec_id", "score"])

        for batch in batches:
            names = batch.schema.names
            for i in range(batch.num_rows):
                row = {n: batch.column(j)[i].as_py() for j, n in enumerate(names)}
                queries = _Tile(row["dim"], *[row[f"q_{n}"] for n in _TILE_COLUMNS])
                candidates = _Tile(row["dim"], *[row[n] for n in _TILE_COLUMNS])
                heap = heaps.get(row["q_ids"], (none, none, none.astype(float)))
                heaps[row["q_ids"]] = meet(queries, candidates, heap, k)
                if len(heaps) > HEAPS:
                    yield out()
        yield out()

    return run


def nearest(
    vectors: DataFrame, is_query: Column, k: int = NEAREST, id_col: str = "vec_id", vec_col: str = "embedding",
    candidate_rows: int = CANDIDATE_ROWS, query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """A row per query and neighbour: query_id, rank from 1, vec_id, score (cosine).

    `is_query` says of a row (vec_id, vector) whether it is a query."""
    spark = vectors.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))
    rows = narrow(vectors, vec_id=id_col, vector=vec_col).select(F.col("vec_id").cast("long").alias("vec_id"), F.col("vector").cast("array<double>").alias("vector"))
    groups = int(spark.conf.get("spark.sql.shuffle.partitions"))
    candidates = rows.mapInArrow(_tiles(candidate_rows), _TILE_DDL).withColumn("part", F.pmod(F.xxhash64("ids"), F.lit(groups)))
    queries = rows.where(is_query).mapInArrow(_tiles(query_rows), _TILE_DDL)
    queries = queries.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))))
    queries = queries.withColumnsRenamed({n: f"q_{n}" for n in _TILE_COLUMNS})
    found = candidates.join(queries, ["dim", "part"]).drop("part").mapInArrow(_search(k), "query_id long, vec_id long, score double")
    found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
