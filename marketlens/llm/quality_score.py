"""Quality by compression: which of two zstandard dictionaries makes a text smaller.

One dictionary is built from good labelled text, one from bad. A text is compressed with both,
piece by piece, so that its own repetitions don't hide what the dictionaries give; the difference
of the two sizes over its length is calibrated to a probability by a logistic curve, fitted on
labelled documents that the dictionaries were not built from.

Bounds, as parameters: SAMPLE documents of each label, those with the smallest hash of their id, one row
of each;
the dictionaries are built from one half of them and up to PIECES pieces of each, the curve is
fitted on the other half. Scoring reads every whole text.

Cases: null and empty texts score by the curve at difference 0. Without both labels to learn from
every score is the share of label 1 (0.5 if nothing is labelled). Null ids are never fitted on and
count as not held out. Repeated rows are scored alike. No rows give none.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.llm.common import narrow, one_row_per_id, small_batches, texts
from marketlens.llm.toxicity import held_out

SAMPLE = 2000
PIECES = 16
PIECE = 1024
DICTIONARY = 1 << 17
LEVEL = 3
THRESHOLD = 0.3


def pieces(data: bytes, size: int = PIECE) -> list[bytes]:
    """Equal parts of at most `size` bytes."""
    n = max(1, math.ceil(len(data) / size))
    step = math.ceil(len(data) / n)
    return [data[i * step : (i + 1) * step] for i in range(n)]


def build(good: list[bytes], bad: list[bytes], size: int = DICTIONARY) -> tuple[bytes, bytes]:
    """A dictionary of either kind of samples, of one size; the samples' ends as they are where
    there are too few to train on."""
    size = min(size, max(1024, min(sum(map(len, good)), sum(map(len, bad))) // 4))
    try:
        good_one, bad_one = (zstandard.train_dictionary(size, x, k=64, d=8).as_bytes() for x in (good, bad))
        return good_one, bad_one
    except zstandard.ZstdError:
        return b"".join(good)[-size:], b"".join(bad)[-size:]


@dataclass
class Curve:
    """score = logistic(slope * difference + offset)."""

    good: bytes = b""
    bad: bytes = b""
    slope: float = 0.0
    offset: float = 0.0
    _ready: list = field(default_factory=list, repr=False)

    def __getstate__(self):
        return {**self.__dict__, "_ready": []}

    def difference(self, data: bytes) -> float:
        """Bytes that the good dictionary saves over the bad one, for a byte of text."""
        if not self.good or not self.bad or not data:
            return 0.0
        if not self._ready:
            for own in (self.good, self.bad):
                known = zstandard.ZstdCompressionDict(own)
                known.precompute_compress(level=LEVEL)
                self._ready.append(
                    zstandard.ZstdCompressor(
                        dict_data=known, level=LEVEL, write_checksum=False, write_content_size=False, write_dict_id=False
                    ).compress
                )
        good, bad = self._ready
        return sum(len(bad(p)) - len(good(p)) for p in pieces(data)) / len(data)

    def score(self, data: bytes) -> float:
        return 1 / (1 + math.exp(-min(60, max(-60, self.slope * self.difference(data) + self.offset))))


def calibrate(differences: np.ndarray, labels: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """Slope and offset of the logistic curve, by Newton's method with a light prior on the slope."""
    scale = float(np.std(differences)) or 1.0
    x = np.stack([differences / scale, np.ones(len(differences))], axis=1)
    w, hold = np.zeros(2), np.diag([1e-2, 1e-3])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + hold, x.T @ (labels - p) - hold @ w)
        w = w + np.clip(step, -2, 2)
    return float(w[0] / scale), float(w[1])


def _sampled(sample_pieces: int):
    @F.arrow_udf("array<binary>")
    def some(column: pa.Array) -> pa.Array:
        out = []
        for data in texts(column):
            all_of = pieces(data)
            out.append([all_of[i] for i in np.unique(np.linspace(0, len(all_of) - 1, sample_pieces).astype(int))])
        return pa.array(out, pa.list_(pa.binary()))

    return some


def _differences(curve: Curve):
    @F.arrow_udf("double")
    def difference(column: pa.Array) -> pa.Array:
        return pa.array([curve.difference(x) for x in texts(column)], pa.float64())

    return difference


def _scores(curve: Curve):
    @F.arrow_udf("double")
    def score(column: pa.Array) -> pa.Array:
        return pa.array([curve.score(x) for x in texts(column)], pa.float64())

    return score


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Curve:
    """Dictionaries and curve for `docs` (doc_id, text) from `labels` (doc_id, quality) that are not held out."""
    known = labels.where("doc_id is not null and quality in (0, 1)").where(~held_out(parts=5, part=0))
    counts = {r["quality"]: r["n"] for r in known.groupBy("quality").agg(F.count("*").alias("n")).collect()}
    if len(counts) < 2:
        share = counts.get(1, 0) / max(1, sum(counts.values())) if counts else 0.5
        return Curve(offset=60.0 if share == 1 else -60.0 if share == 0 else 0.0)
    picked = None
    for label in (0, 1):
        ids = known.where(F.col("quality") == label).select("doc_id", "quality").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
        picked = ids if picked is None else picked.unionByName(ids)
    rows = one_row_per_id(docs, picked).withColumn("half", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(2)))
    build_from: dict[int, list[bytes]] = {0: [], 1: []}
    for r in rows.where("half = 0").select("doc_id", "quality", _sampled(PIECES)("text").alias("parts")).orderBy("quality", "doc_id").collect():
        build_from[r["quality"]] += map(bytes, r["parts"])
    curve = Curve(*build(build_from[1], build_from[0]))
    rest = rows.where("half = 1").select("doc_id", "quality", _differences(curve)("text").alias("x")).orderBy("doc_id", "quality").collect()
    # each label counts as often as it occurs among all labelled rows
    x, y = np.array([r["x"] for r in rest]), np.array([r["quality"] for r in rest], dtype=float)
    if len(np.unique(y)) < 2:
        return Curve(offset=math.log(counts[1] / counts[0]))
    slope, offset = calibrate(x, y)
    offset += math.log(counts[1] / counts[0]) - math.log(y.sum() / (len(y) - y.sum()))
    return Curve(curve.good, curve.bad, slope, offset)


def score(docs: DataFrame, labels: DataFrame, curve: Curve | None = None) -> DataFrame:
    """A row per document: doc_id, held_out, score (higher: label 1 is likelier), predicted."""
    small_batches(docs.sparkSession)
    rows = narrow(docs, doc_id="doc_id", text="text")
    curve = curve or fit(rows, narrow(labels, doc_id="doc_id", quality="quality"))
    rows = rows.select("doc_id", held_out(parts=5, part=0).alias("held_out"), _scores(curve)("text").alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
