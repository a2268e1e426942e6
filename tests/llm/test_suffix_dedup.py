import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from cases import frame, odd_rows, words

from marketlens.llm import suffix_dedup as S


def expected(rows, length):
    """Rows of one id and text are one document; texts of one id come by their hash."""
    docs = sorted({(-(2**63) if d is None else d, t or "") for d, t in rows})
    seen, out = {}, {}
    for doc, text in docs:
        data = text.encode()
        for i in range(len(data) - length + 1):
            seen.setdefault(data[i : i + length], (doc, text, i))
    for doc, text in docs:
        data = text.encode()
        gone = bytearray(len(data))
        for i in range(len(data) - length + 1):
            if seen[data[i : i + length]] != (doc, text, i):
                gone[i : i + length] = b"\1" * length
        kept = bytes(b for b, g in zip(data, gone) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out[doc, text] = (len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return Counter((d, *out[-(2**63) if d is None else d, t or ""]) for d, t in rows)


def passages(seed):
    rng = random.Random(seed)
    shared = [words(rng, 40) for _ in range(4)]
    rows = [r for r in odd_rows() if r[0] not in (7, 8, 9, 12)]
    for i in range(120):
        parts = [words(rng, rng.randrange(30))] + [x for _ in range(rng.randrange(4)) for x in (rng.choice(shared)[rng.randrange(40) :], words(rng, 9))]
        rows.append((200 + i, " ".join(parts)))
    return [*rows, (500, "z" * 3000 + "end"), (501, "z" * 1500), (502, "né" * 800), (7, words(rng, 4000)), (8, words(rng, 200))]


@pytest.mark.parametrize(("length", "lead", "most"), [(100, 32, S.WINDOWS), (100, 32, 0), (40, 8, 50)])
def test_against_brute_force_also_across_buckets(spark, length, lead, most):
    rows = passages(length)
    got = S.dedup(frame(spark, rows), length=length, lead=lead, most=most).collect()
    assert Counter(map(tuple, got)) == expected(rows, length)


def test_slabs_and_long_stretches(spark, monkeypatch):
    rng = random.Random(2)
    rows = [(1, words(rng, 60_000)), (2, "y" * 20_000), (3, words(rng, 300) + "y" * 300)]
    rows.append((4, rows[0][1][100_000:200_000]))
    got = {r.doc_id: r for r in S.dedup(frame(spark, rows)).collect()}
    assert got[4].n_removed == got[4].n_bytes >= 100_000 and got[4].n_spans == 1
    assert got[2].n_removed == 20_000 - 1 and got[3].n_removed >= 300


def test_texts_of_one_id_are_documents_of_their_own(spark):
    a, b = "p" * 40 + "q" * 80, "q" * 80 + "r" * 60
    got = Counter((r.n_bytes, r.n_removed > 0) for r in S.dedup(frame(spark, [(1, a), (1, b + "s" * 150), (1, a)]), length=60, lead=16).collect())
    assert sum(got.values()) == 3 and got[120, True] in (0, 2)


@pytest.mark.parametrize("doc", [None, 1])
def test_many_texts_of_one_id_are_never_gathered(spark, monkeypatch, doc):
    plans = []
    for name in ("durable", "stored"):
        own = getattr(S, name)
        monkeypatch.setattr(S, name, lambda df, *a, own=own: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or own(df, *a))
    rng = random.Random(14)
    shared = words(rng, 60)
    rows = [(doc, f"{i} {words(rng, 5)} {shared if i % 2 else words(rng, 60)}") for i in range(300)] + [(2, shared)]
    out = S.dedup(frame(spark, rows))
    got = out.collect()
    assert not any("array_position" in p or "collect_list(sig" in p for p in [*plans, out._jdf.queryExecution().optimizedPlan().toString()])
    # all but one of the shared passages go; the null id and the smaller id come before 2
    assert len(got) == len(rows) and sum(r.n_removed >= len(shared.encode()) for r in got) == 150


def test_equal_windows_are_those_with_equal_bytes():
    rng = np.random.default_rng(3)
    data = bytes(rng.integers(0, 2, 3000, dtype=np.uint8))
    at = np.arange(0, 2900)
    for length in (5, 8, 13):
        seen, want = set(), []
        for i in at.tolist():
            want.append(data[i : i + length] in seen)
            seen.add(data[i : i + length])
        assert S.equal_windows(np.zeros(len(at), dtype=np.int64), data, at, length).tolist() == want


def test_kept_bytes_and_no_rows(spark):
    text = " ".join(map(str, range(100)))
    rows = S.dedup(frame(spark, [(1, text), (2, "new " + text)]), digest=False).collect()
    assert {r.doc_id: bytes(r.kept) for r in rows} == {1: text.encode(), 2: b"new "}
    assert S.dedup(frame(spark, [(1, "x")]).limit(0)).collect() == []


def dealt(spark, rows, common):
    """Rows of each pair of anchor and key that the stretches are dealt by."""
    found = rows.mapInArrow(S._stretch_rows(S.LENGTH, S.LEAD, common), S._STRETCH_DDL).where("not known")
    return Counter((r.lead, r.whole if r.common else None) for r in found.collect())


def test_a_line_that_all_documents_share_is_dealt_by_whole_text(spark):
    rng = random.Random(31)
    line = words(rng, 12)[:62]
    docs = frame(spark, [(i, f"{words(rng, 30)} {line} {words(rng, 30)}") for i in range(600)])
    rows = docs.selectExpr("doc_id", "0L as nth", "text")
    common = S.common_anchors(rows, S.LENGTH, S.LEAD)
    before, after = (dealt(spark, rows, x) for x in (frozenset(), common))
    even = sum(before.values()) / int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert max(before.values()) > even / 4 >= max(after.values()) and 1 <= len(common) <= 32
    got = S.dedup(docs).collect()
    assert Counter(map(tuple, got)) == expected([(r.doc_id, r.text) for r in docs.collect()], S.LENGTH)


@pytest.mark.parametrize("most", [S.WINDOWS, 0])
def test_brute_force_with_every_anchor_common(spark, monkeypatch, most):
    monkeypatch.setattr(S, "COMMON", 0)
    monkeypatch.setattr(S, "common_anchors", lambda rows, *a, own=S.common_anchors: own(rows, *a) | every(rows, *a))

    def every(rows, length, lead):
        found = rows.select("doc_id", "nth", "text").mapInArrow(S._stretch_rows(length, lead), S._STRETCH_DDL)
        return frozenset(r.lead for r in found.select("lead").distinct().collect())

    rows = passages(7)
    got = S.dedup(frame(spark, rows), length=40, lead=8, most=most).collect()
    assert Counter(map(tuple, got)) == expected(rows, 40)
