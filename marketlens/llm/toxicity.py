"""Toxicity by non-negative positive-unlabelled learning.

Known: some confirmed toxic documents; all other text is unlabelled and holds toxic documents at
the class prior. A linear classifier in numpy minimises the class-prior-corrected risk

    prior * E_toxic[loss(g)] + max(0, E_unlabelled[loss(-g)] - prior * E_toxic[loss(-g)])

with the logistic loss; where the second part turns negative its gradient is reversed, which
keeps the classifier from memorising the toxic sample. With this loss the sigmoid of g is a
probability, which is the score.

Features are the distinct words of the whole text, lower-cased, and their beginnings of 4 to 7
characters. Those that stand out in the toxic sample against the unlabelled one are kept.

Bounds, as parameters: at most POSITIVES toxic and UNLABELLED documents are fitted on, those with
the smallest hash of their id, one row of each, and at most CANDIDATES features are counted, FEATURES kept. The
prior is counted over all labelled rows. Scoring reads every whole text.

Cases: null and empty texts have no features and get the classifier's base rate. Without a toxic
row to learn from every score is the prior, 0 if nothing is labelled. Null ids are never fitted
on and count as not held out. Repeated rows are scored alike. No rows give none.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlens.llm.common import narrow, one_row_per_id, small_batches

POSITIVES = 3000
UNLABELLED = 6000
CANDIDATES = 50_000
FEATURES = 2000
THRESHOLD = 0.3
#: Words whose weight a worker remembers.
REMEMBERED = 200_000
_WORD = re.compile(r"\w+")


def of_word(word: str) -> list[str]:
    """Features of a word: itself and its proper beginnings."""
    return ["=" + word, *("^" + word[:k] for k in range(4, min(8, len(word))))]


def of_text(text: str | None) -> set[str]:
    return {f for word in set(_WORD.findall((text or "").lower())) for f in of_word(word)}


@dataclass
class Classifier:
    """A linear classifier over the presence of features."""

    bias: float
    weights: dict[str, float] = field(default_factory=dict)

    def scorer(self):
        """Text to score. Words that begin like no feature cost one look-up."""
        weights = self.weights
        beginnings = {f[1:5] for f in weights}
        known: dict[str, tuple[str, ...]] = {}

        def score(text: str | None) -> float:
            found: set[str] = set()
            for word in {w for w in _WORD.findall((text or "").lower()) if w[:4] in beginnings}:
                own = known.get(word)
                if own is None:
                    if len(known) >= REMEMBERED:
                        known.clear()
                    own = known[word] = tuple(f for f in of_word(word) if f in weights)
                found.update(own)
            g = self.bias + sum(sorted(weights[f] for f in found))
            return float(1 / (1 + np.exp(-np.clip(g, -60, 60))))

        return score


def train(toxic: np.ndarray, other: np.ndarray, prior: float, steps: int = 400, rate: float = 0.05, decay: float = 1e-3):
    """Weights and bias of the non-negative risk's minimiser; rows are 0/1 features."""
    n = toxic.shape[1]
    w, b = np.zeros(n), float(np.log(max(prior, 1e-6) / max(1 - prior, 1e-6)))
    mean, square = np.zeros(n + 1), np.zeros(n + 1)
    sigmoid = lambda x: 1 / (1 + np.exp(-np.clip(x, -60, 60)))
    for step in range(1, steps + 1):
        own = w.astype(np.float32)  # as the rows are, or these would be copied
        gp, gu = toxic @ own + b, other @ own + b
        up, dp = -sigmoid(-gp) / len(gp), sigmoid(gp) / len(gp)  # slopes of the loss of g and of -g
        du = sigmoid(gu) / len(gu)
        clean = np.logaddexp(0, gu).mean() - prior * np.logaddexp(0, gp).mean()
        if clean < 0:
            rows_p, rows_u = prior * dp, -du
        else:
            rows_p, rows_u = prior * (up - dp), du
        slopes = toxic.T @ rows_p.astype(np.float32) + other.T @ rows_u.astype(np.float32)
        grad = np.append(slopes + (decay * w if clean >= 0 else 0), rows_p.sum() + rows_u.sum())
        mean, square = 0.9 * mean + 0.1 * grad, 0.999 * square + 0.001 * grad**2
        move = rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
        w, b = w - move[:-1], b - move[-1]
    return w, b


def select(toxic: dict[str, int], other: dict[str, int], n_toxic: int, n_other: int, most: int = FEATURES) -> list[str]:
    """Features that toxic documents have more often than chance allows, the most striking first."""
    excess = {f: (n - n_toxic * other.get(f, 0) / max(1, n_other)) / (n + other.get(f, 0) + 1) ** 0.5 for f, n in toxic.items()}
    return sorted((f for f, x in excess.items() if x > 1.5), key=lambda f: (-excess[f], f))[:most]


def _counts(wanted: frozenset[str] | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: Counter[str] = Counter()
            for text in batch.column(0).to_pylist():
                own = of_text(text)
                counts.update(own if wanted is None else own & wanted)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["feature", "n"]
            )

    return run


def _presence(features: dict[str, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [sorted(features[f] for f in of_text(t) if f in features) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.int32()))], names=["ids"])

    return run


def held_out(doc_id: str = "doc_id", parts: int = 4, part: int = 2) -> Column:
    """Whether a document's label is kept for tests."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % parts == part, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, positives: int = POSITIVES, unlabelled: int = UNLABELLED) -> Classifier:
    """The classifier for `docs` (doc_id, text) from `labels` (doc_id, toxic) that are not held out."""
    known = labels.where("doc_id is not null and toxic is not null").where(~held_out())
    counts = known.agg(F.count("*").alias("n"), F.sum(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic")).first()
    prior = (counts["toxic"] or 0) / max(1, counts["n"])
    if not counts["toxic"]:
        return Classifier(-60.0)
    sample = lambda ids, n: ids.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
    toxic = one_row_per_id(docs, sample(known.where("toxic = 1"), positives)).select("text")
    other = one_row_per_id(docs, sample(docs.where("doc_id is not null").where(~held_out()), unlabelled)).select("text")
    tally = lambda rows, wanted: rows.mapInArrow(_counts(wanted), "feature string, n long").groupBy("feature").agg(F.sum("n").alias("n"))
    top = tally(toxic, None).where("n >= 2").orderBy(F.desc("n"), "feature").limit(CANDIDATES)
    in_toxic = {r["feature"]: r["n"] for r in top.collect()}  # CANDIDATES rows at most
    in_other = {r["feature"]: r["n"] for r in tally(other, frozenset(in_toxic)).collect()}
    names = select(in_toxic, in_other, toxic.count(), other.count())
    place = {f: i for i, f in enumerate(names)}

    def matrix(rows: DataFrame) -> np.ndarray:
        ids = [r["ids"] for r in rows.mapInArrow(_presence(place), "ids array<int>").collect()]  # of the sample
        out = np.zeros((len(ids), len(names)), dtype=np.float32)
        for row, own in zip(out, ids):
            row[own] = 1
        return out

    a, b = matrix(toxic), matrix(other)
    if not len(a) or not len(b):
        return Classifier(float(np.log(prior / (1 - prior))) if prior < 1 else 60.0)
    weights, bias = train(a, b, prior)
    return Classifier(float(bias), dict(zip(names, weights.tolist())))


def _score_column(classifier: Classifier):
    @F.arrow_udf("double")
    def score(column: pa.Array) -> pa.Array:
        one = classifier.__dict__.get("_scorer")
        if one is None:
            one = classifier.__dict__["_scorer"] = classifier.scorer()
        return pa.array([one(t) for t in column.to_pylist()], pa.float64())

    return score


def score(docs: DataFrame, labels: DataFrame, classifier: Classifier | None = None) -> DataFrame:
    """A row per document: doc_id, held_out, score (higher: toxic is likelier), predicted."""
    small_batches(docs.sparkSession)
    rows = narrow(docs, doc_id="doc_id", text="text")
    classifier = classifier or fit(rows, narrow(labels, doc_id="doc_id", toxic="toxic"))
    rows = rows.select("doc_id", held_out().alias("held_out"), _score_column(classifier)("text").alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are not predicted toxic, in the columns of `docs`."""
    small_batches(docs.sparkSession)
    classifier = fit(narrow(docs, doc_id="doc_id", text="text"), narrow(labels, doc_id="doc_id", toxic="toxic"))
    return docs.where(_score_column(classifier)(docs["text"]) < THRESHOLD)
