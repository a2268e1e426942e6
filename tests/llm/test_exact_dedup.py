import hashlib
from collections import Counter, defaultdict

import pytest
from cases import frame, odd_rows

from marketlens.llm import exact_dedup as E


def folded(text):
    return (text or "").translate({c: c + 32 for c in range(65, 91)})


def expected(rows):
    groups = defaultdict(list)
    for doc, text in rows:
        groups[folded(text)].append(doc)
    out = Counter()
    for doc, text in rows:
        group = groups[folded(text)]
        keep = max((d for d in group if d is not None), default=None)
        out[doc, keep, len(group), doc == keep, hashlib.sha256(folded(text).encode()).hexdigest()] += 1
    return out


@pytest.mark.parametrize("bits", [64, 3])
def test_against_brute_force_also_when_identifiers_collide(spark, bits):
    rows = odd_rows()
    got = E.dedup(frame(spark, rows), bits=bits, mean=64).collect()
    assert Counter(map(tuple, got)) == expected(rows)


def test_equal_texts_are_cut_alike_and_wholly():
    data = bytes(range(256)) * 700
    ends = E.cuts(data, 64)
    assert ends == sorted(set(ends)) and ends[-1] == len(data)
    assert max(b - a for a, b in zip([0, *ends], ends)) <= E.MAX_CHUNK
    assert E.cuts(b"") == [] and E.cuts(b"ab") == [2]
    shifted = E.cuts(b"xyz" + data, 64)
    assert {e + 3 for e in ends[:-1]} <= {*shifted}  # cuts follow the content


def test_keep_one_returns_the_rows_themselves(spark):
    rows = odd_rows()
    docs = frame(spark, rows)
    stay = E.keep_one(docs)
    assert stay.columns == docs.columns
    got = Counter((r.doc_id, folded(r.text)) for r in stay.collect())
    best = {}
    for doc, text in rows:
        key = folded(text)
        best[key] = doc if best.get(key) is None else best[key] if doc is None else max(doc, best[key])
    assert got == Counter((doc, text) for text, doc in best.items())


def test_no_rows(spark):
    docs = frame(spark, [(1, "x")]).limit(0)
    assert E.dedup(docs).collect() == [] and E.keep_one(docs).collect() == []
