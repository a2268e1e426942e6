"""The two classifiers: held-out accuracy, and what they never look at."""

import zlib

import numpy as np
import pytest
from cases import frame, odd_rows

from marketlens.llm import quality_score as Q
from marketlens.llm import toxicity as T

SF = "/root/testdata/sf0.1"


def auc(scores, labels):
    """Ties count half."""
    values, place, count = np.unique(scores, return_inverse=True, return_counts=True)
    rank = (np.cumsum(count) - (count - 1) / 2)[place]
    n = labels.sum()
    return (rank[labels == 1].mean() - (n + 1) / 2) / (len(labels) - n)


def held_out_accuracy(spark, rows, column):
    labels = {r.doc_id: r[column] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    own = [(r.score, r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    scores, predicted, truth = (np.array(x) for x in zip(*own))
    hit = (predicted == 1) & (truth == 1)
    return auc(scores, truth), hit.sum() / max(1, predicted.sum()), hit.sum() / truth.sum()


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


def test_toxicity_on_held_out_documents(spark, tables):
    area, precision, recall = held_out_accuracy(spark, T.score(*tables).collect(), "toxic")
    assert area > 0.9 and precision > 0.75 and recall > 0.8


def test_quality_on_held_out_documents(spark, tables):
    area, precision, recall = held_out_accuracy(spark, Q.score(*tables).collect(), "quality")
    assert area > 0.97 and precision > 0.95 and recall > 0.98


@pytest.mark.parametrize("module,column,parts,part", [(T, "toxic", 4, 2), (Q, "quality", 5, 0)])
def test_held_out_labels_and_other_columns_change_nothing(spark, module, column, parts, part):
    from pyspark.sql import functions as F

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    kept = module.held_out(parts=parts, part=part)
    lies = labels.withColumn(column, F.when(kept, 1 - F.col(column)).otherwise(F.col(column)))
    other = docs.withColumns({"lang": F.lit("xx"), "source": F.lit(None).cast("string"), "score": F.lit(9)})
    a = sorted(map(tuple, module.score(docs, labels).collect()))
    assert a == sorted(map(tuple, module.score(other, lies).collect()))
    assert all(h == (zlib.crc32(str(d).encode()) % parts == part) for d, h, _, _ in a)


@pytest.mark.parametrize("module,column", [(T, "toxic"), (Q, "quality")])
def test_odd_documents_and_labels(spark, module, column):
    docs = frame(spark, odd_rows())
    schema = f"doc_id long, {column} int"
    for labels in ([], [(1, 1)], [(7, 1), (8, 0), (None, 1), (9, None), (4, 0), (5, 1), (5, 1)]):
        rows = module.score(docs, spark.createDataFrame(labels, schema)).collect()
        assert len(rows) == len(odd_rows())
        assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
        assert all(not r.held_out for r in rows if r.doc_id is None)
    assert module.score(docs.limit(0), spark.createDataFrame([(1, 1)], schema)).collect() == []


def test_the_risk_is_not_driven_below_zero():
    rng = np.random.default_rng(0)
    # 30 signals of which a toxic row has some, 200 columns of noise
    signal = lambda n, rate: rng.random((n, 30)) < rate
    noise = lambda n: rng.random((n, 200)) < 0.05
    toxic = np.hstack([signal(300, 0.2), noise(300)]).astype(np.float32)
    mixed = np.hstack([np.vstack([signal(100, 0.2), signal(900, 0.002)]), noise(1000)]).astype(np.float32)
    w, b = T.train(toxic, mixed, 0.1)
    fresh = np.hstack([np.vstack([signal(200, 0.2), signal(1800, 0.002)]), noise(2000)])
    truth = np.repeat([1, 0], [200, 1800])
    scores = fresh @ w + b
    assert auc(scores, truth) > 0.95
    assert np.logaddexp(0, mixed @ w + b).mean() - 0.1 * np.logaddexp(0, toxic @ w + b).mean() > -0.02


def test_toxic_documents_are_dropped_and_the_rest_kept(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    stay = T.drop_toxic(docs, labels)
    assert stay.columns == docs.columns
    flagged = {r.doc_id for r in T.score(docs, labels).collect() if r.predicted}
    assert {r.doc_id for r in stay.collect()} == {r.doc_id for r in docs.collect()} - flagged and flagged


def test_curve_and_pieces():
    assert b"".join(Q.pieces(b"x" * 5000)) == b"x" * 5000 and max(map(len, Q.pieces(b"x" * 5000))) <= Q.PIECE
    assert Q.pieces(b"") == [b""]
    x = np.linspace(-1, 1, 400)
    slope, offset = Q.calibrate(x, (np.random.default_rng(1).random(400) < 1 / (1 + np.exp(-(5 * x + 1)))).astype(float))
    assert 3 < slope < 7 and 0.3 < offset < 1.7


@pytest.mark.parametrize("module,column", [(T, "toxic"), (Q, "quality")])
def test_many_rows_of_one_labelled_id_change_no_model(spark, module, column):
    """20,000 more rows of the id, all of them with texts that no sample takes first."""
    from pyspark.sql import functions as F

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    one = labels.where(f"{column} = 1").where(~module.held_out(parts=4, part=2) & ~module.held_out(parts=5, part=0)).orderBy("doc_id").first()["doc_id"]
    least = docs.where(F.col("doc_id") == one).select(F.xxhash64("text")).first()[0]
    more = spark.range(40_000).select(F.lit(one).alias("doc_id"), F.concat(F.lit("quite another text "), F.col("id").cast("string")).alias("text"))
    more = more.where(F.xxhash64("text") > least).limit(20_000)
    model = module.fit(docs, labels)
    again = module.fit(docs.unionByName(more), labels)
    if module is Q:
        assert (model.good, model.bad) == (again.good, again.bad) and model.slope == pytest.approx(again.slope)
    else:
        assert model.weights.keys() == again.weights.keys() and model.bias == pytest.approx(again.bias, abs=1e-3)


def test_one_row_of_an_id_is_read(spark):
    from marketlens.llm.common import one_row_per_id

    docs = frame(spark, [(1, f"t{k}") for k in range(500)] + [(2, None), (2, "b"), (3, None), (None, "x"), (4, "y")]).select("doc_id", "text")
    ids = spark.createDataFrame([(1, 0), (2, 1), (3, 1), (9, 0)], "doc_id long, label int")
    got = {(r.doc_id, r.label) for r in one_row_per_id(docs, ids).collect()}
    assert got == {(1, 0), (2, 1), (3, 1)} and one_row_per_id(docs, ids).count() == 3


def test_scores_are_those_of_the_curve_recomputed(spark, tables):
    """Sizes with either dictionary from the library, one text at a time."""
    import math

    import zstandard

    docs, labels = (t.limit(300) for t in tables)
    curve = Q.fit(*tables)
    got = Q.score(docs, labels, curve).collect()
    whole = {r.doc_id: r.text for r in docs.collect()}
    for r in got[:120]:
        data = (whole[r.doc_id] or "").encode()
        parts = Q.pieces(data)
        sizes = []
        for own in (curve.good, curve.bad):
            c = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(own), level=Q.LEVEL, write_checksum=False, write_content_size=False, write_dict_id=False)
            sizes.append(sum(len(c.compress(p)) for p in parts))
        difference = (sizes[1] - sizes[0]) / len(data) if data else 0.0
        assert r.score == pytest.approx(1 / (1 + math.exp(-(curve.slope * difference + curve.offset))), abs=2e-2)


def test_the_minimised_risk_is_the_formulas():
    """The weights found are a minimum of the risk: a plain recomputation is no lower around them."""
    rng = np.random.default_rng(3)
    toxic, other = (rng.random((n, 12)) < rate for n, rate in ((80, 0.3), (300, 0.1)))
    toxic, other = toxic.astype(np.float32), other.astype(np.float32)
    prior, decay = 0.2, 1e-3
    w, b = T.train(toxic, other, prior, steps=3000, rate=0.01, decay=decay)

    def risk(w, b):
        loss = lambda g: np.logaddexp(0, -g)
        gp, gu = toxic @ w + b, other @ w + b
        return prior * loss(gp).mean() + max(0.0, loss(-gu).mean() - prior * loss(-gp).mean()) + decay / 2 * (w @ w)

    at = risk(w, b)
    for _ in range(200):
        step = rng.normal(size=13) * 0.05
        assert risk(w + step[:12], b + step[12]) >= at - 1e-4
