import re
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
from cases import frame, odd_rows, words
from pyspark.sql import functions as F

from marketlens.llm import mixing as M
import random


def plain_size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def plain_targets(sizes, weights=(5, 2, 1), cap=3):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, full = sum(sizes.values()), set()
    while True:
        rest = total - sum(cap * sizes[s] for s in full)
        by = sum(weight[s] for s in names if s not in full)
        target = {s: float(cap * sizes[s]) if s in full else rest * weight[s] / by for s in names}
        over = {s for s in names if s not in full and target[s] > cap * sizes[s]}
        if not over:
            return target
        full |= over


def plain_seats(claims, seats):
    """By the highest quotients, one at a time."""
    got = [0] * len(claims)
    for _ in range(seats):
        best = max(range(len(claims)), key=lambda i: (claims[i] / (2 * got[i] + 1), -i))
        got[best] += 1
    return got


def corpus():
    rng = random.Random(6)
    sizes = {"a": 900, "b": 40, "c": 300, "é": 5, None: 120, "z": 60, "zero": 0}
    rows, doc = [(d, t, "en", "odd") for d, t in odd_rows()], 1000
    for source, n in sizes.items():
        for _ in range(max(1, n // 12)):
            rows.append((doc, words(rng, rng.randrange(25)) if n else "", "en", source))
            doc += 1
    return rows


@pytest.mark.parametrize("shard_docs", [M.SHARD_DOCS, 8])
def test_targets_sizes_and_takes(spark, shard_docs):
    rows = corpus()
    docs = frame(spark, rows)
    got = M.mix(docs, shard_docs=shard_docs).collect()
    assert len(got) == len(rows)
    sizes = defaultdict(int)
    for _, text, _, source in rows:
        sizes[source] += plain_size(text)
    want = plain_targets(sizes)
    assert Counter((r.doc_id, r["size"]) for r in got) == Counter((d, plain_size(t)) for d, t, _, _ in rows)
    source_of, taken = {(d, plain_size(t)): s for d, t, _, s in rows}, defaultdict(int)
    for r in got:
        source = source_of[r.doc_id, r["size"]]
        assert r.source_size == sizes[source] and r.target == pytest.approx(want[source])
        assert 0 <= r.taken <= 3 * r["size"]
        taken[source] += r.taken
    blocks = max(1, int(min(x for x in want.values() if x)) // 1000)
    for source in sizes:
        shards = -(-sum(s == source for s in source_of.values()) // shard_docs) + 1
        assert abs(taken[source] - want[source]) <= blocks * shards + 1
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, M.mix(docs.repartition(7), shard_docs=shard_docs).collect()), key=repr)


def test_blocks_go_by_the_highest_quotients(spark):
    from pyspark.sql import functions as F

    rng = random.Random(9)
    for claims, seats in (([5, 2, 1], 11), ([1] * 7, 10), ([1000, 1, 1, 1], 500), ([rng.random() ** 4 for _ in range(30)], 333), ([0.0, 3.0], 4), ([10**6, 1], 3)):
        rows = spark.createDataFrame([(f"{i:03}", float(c)) for i, c in enumerate(claims)], "source string, claim double")
        out = M._apportion(rows, [], [F.col("source")], F.col("claim"), F.lit(seats).cast("long"), "got")
        assert [r.got for r in out.orderBy("source").collect()] == plain_seats(claims, seats)


def test_words_of_sliced_and_odd_columns():
    column = pa.array([" a  b\tc", None, "", "x", "\x0b\x0c", "é ß\xa0ü", "a\n"])
    assert M.count_words(column).tolist() == [3, 0, 0, 1, 0, 2, 1]
    assert M.count_words(column.slice(2, 4)).tolist() == [0, 1, 0, 2]
    assert M.count_words(column.slice(0, 0)).tolist() == []


def test_the_mix_repeats_and_drops_documents(spark):
    rows = [(d, t, la, s) for d, t, la, s in corpus() if d is not None and d >= 1000]
    docs = frame(spark, rows)
    out = M.mixed(docs)
    assert out.columns == docs.columns
    got = Counter((r.doc_id, r.text) for r in out.collect())
    takes = {r.doc_id: (r.taken, r["size"]) for r in M.mix(docs).collect()}
    for doc, text, _, _ in rows:
        taken, size = takes[doc]
        assert got[doc, text] == (int(taken / size + 0.5) if size else 1)


def test_no_rows_and_no_words(spark):
    docs = frame(spark, [(1, None), (2, " ")])
    assert [(r["size"], r.target, r.taken) for r in M.mix(docs).collect()] == [(0, 0.0, 0)] * 2
    assert M.mix(docs.limit(0)).collect() == [] and M.mixed(docs.limit(0)).collect() == []


def test_rows_without_ids_are_dealt_over_all_shards(spark):
    """Half of the ids are null, a sixth are one id: no shard gets over twice the mean."""
    ids = F.when(F.col("id") % 2 == 0, F.lit(None)).when(F.col("id") % 6 == 1, F.lit(7)).otherwise(F.col("id"))
    rows = spark.range(24_000).select(ids.cast("long").alias("doc_id"), F.xxhash64(F.col("id").cast("string")).alias("text_hash"))
    counts = rows.groupBy(M.shard_of(F.lit(8), M.SEED).alias("shard")).count().collect()
    assert len(counts) == 8 and max(r["count"] for r in counts) < 2 * 24_000 / 8
