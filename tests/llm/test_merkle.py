"""Trees, proofs and folded roots against a plain recomputation."""

import hashlib
import zlib
from collections import Counter

import pytest
from cases import CLASHING, SCHEMA, frame, odd_rows
from pyspark.sql import functions as F

from marketlens.llm import merkle


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def lower(text):
    return text and "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def climbed(digests, ways):
    """The top of the tree over `digests`; adds to ways[i] the (left, right) of leaf i's nodes."""
    nodes, under = list(digests), [[i] for i in range(len(digests))]
    while len(nodes) > 1:
        for k in range(len(nodes)):
            run = k // 16 * 16
            left, right = nodes[run:k], nodes[k + 1 : run + 16]
            for i in under[k]:
                ways[i].append(("".join(left), "".join(right)))
        under = [sum(under[k : k + 16], []) for k in range(0, len(nodes), 16)]
        nodes = [h(*nodes[k : k + 16]) for k in range(0, len(nodes), 16)]
    return nodes[0]


def expected(rows):
    """rows: (doc_id, text, lang, source, n_chars)."""
    leaf = lambda d, t, lang, s, n: h(*map(field, (d, s, lang, n, t)))
    trees = {}
    for r in rows:
        trees.setdefault(r[3], []).append(r)
    names = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    ways, subroots, members = {}, [], {}
    for s in names:
        members[s] = sorted(trees[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf(*r)))
        ways[s] = [[] for _ in members[s]]
        subroots.append(climbed([leaf(*r) for r in members[s]], ways[s]))
    above = [[] for _ in names]
    root = climbed(subroots, above) if names else None
    out = Counter()
    for k, s in enumerate(names):
        for r, way in zip(members[s], ways[s]):
            path = way + above[k]
            changed = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0
            top = leaf(r[0], lower(r[1]), *r[2:]) if changed else leaf(*r)
            for left, right in path:
                top = h(left, top, right)
            out[(r[0], leaf(*r), subroots[k], root, h(*(x for pair in path for x in pair)), top, top == root)] += 1
    return out


def full(rows):
    return [(d, t, lang, s, None if t is None else len(t)) for d, t, lang, s in rows]


def run(docs):
    rows = merkle.verified(docs, merkle.FIELDS, tampered=merkle.tampered_fifth(docs["doc_id"]))
    assert rows.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return Counter(map(tuple, rows.collect()))


@pytest.mark.parametrize(
    "sources",
    [
        {"only": 1}, {None: 1, "a": 1}, {"a": 300, "é": 1, "Z": 16, None: 5, "": 17, "s": 33}, {f"host{k}": 1 + k % 3 for k in range(40)},
    ],
)
def test_against_brute_force(spark, sources):
    rows, doc_id = [], 0
    for source, count in sources.items():
        for _ in range(count):
            rows.append((doc_id * 7 % 1009, f"Text {doc_id} À" if doc_id % 3 else "lower", "EN", source))
            doc_id += 1
    got = run(frame(spark, rows))
    assert got == expected(full(rows))
    assert doc_id < 20 or {v for *_, v in got} == {True, False}


def test_deep_trees_take_several_rounds(spark, monkeypatch):
    """Runs of two: nine levels, so that pointers span eight of them before they meet the root."""
    monkeypatch.setattr(merkle, "FANOUT", 2)
    rows = [(k, f"T{k}", "en", "a" if k % 3 else "b") for k in range(400)]
    docs = frame(spark, rows)
    got = merkle.verified(docs, merkle.FIELDS).collect()
    assert len(got) == 400 and all(r.verified for r in got) and len({r.root for r in got}) == 1
    assert len({r.proof_sha256 for r in got}) == 400
    wrong = merkle.verified(docs, merkle.FIELDS, tampered=F.lit(True)).collect()
    assert not any(r.verified for r in wrong)


def test_odd_rows(spark):
    rows = [(d, t, "en", "s") for d, t in odd_rows()] + [(None, "x", None, None), (None, "x", None, None), (50, "x" * 40_000, "", "")]
    assert run(frame(spark, rows)) == expected(full(rows))
    assert not run(frame(spark, []))


def test_a_large_group_of_equal_rows(spark):
    rows = [(None, "same", "en", "s")] * 700 + [(k, "other", "en", "s") for k in range(200)]
    assert run(frame(spark, rows)) == expected(full(rows))


def test_null_fields_and_empty_ones_differ(spark):
    docs = spark.createDataFrame([(1, None, None, None, None, *CLASHING), (1, "", "", "", 0, *CLASHING)], SCHEMA)
    assert len({r.leaf for r in merkle.verified(docs, merkle.FIELDS).collect()}) == 2


def test_proofs_hold_the_siblings(spark):
    docs = frame(spark, [(k, f"t{k}", "en", "s") for k in range(40)])
    built = merkle.manifest(docs, merkle.FIELDS)
    rows = merkle.proofs(built).select("digest", "path", "idx").collect()
    assert sorted(r.idx for r in rows) == list(range(40))
    for r in rows:
        top = r.digest
        for left, right in r.path:
            top = h(left.hex(), top, right.hex())
        assert top == built.root and len(r.path) == 2
