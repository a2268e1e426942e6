import itertools
import random
from collections import Counter

import numpy as np
import pytest
import xxhash
from cases import frame, odd_rows, words
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from marketlens.llm import simhash as S
from marketlens.llm.components import components


def plain_fingerprint(text, k=4):
    import re

    ws = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not ws:
        return 0
    shingles = [" ".join(ws[i : i + k]) for i in range(len(ws) - k + 1)] or [" ".join(ws)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_roots(rows, radius=4):
    """Of every row its fingerprint and the place of one row of its component."""
    prints = [plain_fingerprint(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        if (prints[i] ^ prints[j]).bit_count() <= radius:
            parent[root(i)] = root(j)
    return prints, [root(i) for i in range(len(rows))]


def plain_components(rows, radius=4):
    prints, roots = plain_roots(rows, radius)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[roots[i]] = min(doc, least.get(roots[i], doc))
    return Counter((doc, f"{prints[i]:016x}", least.get(roots[i])) for i, (doc, _) in enumerate(rows))


def representatives(rows):
    """One (doc_id, text) of every component; rows of one id and fingerprint are alike here."""
    _, roots = plain_roots(rows)
    best = {}
    for (doc, text), root in zip(rows, roots):
        rank = (doc is None, doc or 0, plain_fingerprint(text))
        if root not in best or rank < best[root][0]:
            best[root] = rank, (doc, text)
    return Counter(one for _, one in best.values())


def near_rows():
    rng = random.Random(8)
    out = odd_rows()
    for g in range(6):
        text = words(rng, 400).split()
        for c in range(7):
            own = list(text)
            for _ in range(c):
                own[rng.randrange(len(own))] = "edit%d" % rng.randrange(99)
            out.append((100 + g * 10 + c, " ".join(own)))
    return out


@pytest.mark.parametrize("limit", [S.BUCKET_LIMIT, 2])
def test_against_brute_force_also_when_every_bucket_is_split(spark, limit):
    rows = near_rows()
    assert Counter(map(tuple, S.simhash(frame(spark, rows), limit=limit).collect())) == plain_components(rows)


def test_fingerprints_agree_with_the_built_in_hash(spark):
    row = spark.range(1).select(F.xxhash64(F.lit("a b c d")).alias("h")).first()
    assert row.h & (1 << 64) - 1 == S.fingerprint(b"a b  c\td")


@settings(max_examples=300, deadline=None)
@given(st.sets(st.integers(0, 63), min_size=0, max_size=4))
def test_every_difference_within_the_radius_misses_a_mask(bits):
    difference = sum(1 << b for b in bits)
    assert any(not mask & difference for mask in S.covering_masks(list(range(64))))


def test_masks_are_half_full_and_again_on_the_free_bits():
    masks = S.covering_masks(list(range(64)))
    assert len(masks) == 31 and all(30 <= m.bit_count() <= 35 for m in masks)
    for mask in masks:
        free = [p for p in range(64) if not mask >> p & 1]
        for a in itertools.islice(itertools.combinations(free, 4), 0, 30_000, 997):
            assert any(not m & sum(1 << p for p in a) for m in S.covering_masks(free))
        assert all((mask | m).bit_count() >= 46 for m in S.covering_masks(free))


def test_votes():
    hashes = np.random.default_rng(1).integers(0, 2**63, 1000, dtype=np.uint64)
    assert S.votes(hashes).tolist() == [int((hashes >> np.uint64(b) & np.uint64(1)).sum()) for b in range(64)]
    assert S.votes(hashes[:0]).tolist() == [0] * 64


def test_one_row_of_each_component_stays(spark):
    rows = near_rows()
    docs = frame(spark, rows)
    stay = S.keep_representatives(docs)
    assert stay.columns == docs.columns
    assert Counter((r.doc_id, r.text) for r in stay.collect()) == representatives(rows)


def test_unrelated_components_with_one_id_or_none_all_stay(spark):
    rng = random.Random(4)
    a, b, c, d = (words(rng, 60) for _ in range(4))
    rows = [(None, a), (None, b), (None, b), (None, c), (7, c), (3, d), (3, "short"), (3, "short"), (5, d), (9, "short")]
    assert len({c for _, c, _ in plain_components(rows)}) == 5
    got = Counter((r.doc_id, r.text) for r in S.keep_representatives(frame(spark, rows)).collect())
    assert got == Counter([(None, a), (None, b), (7, c), (3, d), (3, "short")])


def test_components_of_long_paths_stars_and_loops(spark):
    links = [(i, i + 1) for i in range(0, 300)] + [(1000, 1000 + i) for i in range(400)] + [(5, 5), (2000, 2001), (2001, 2000)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(1, 301)}, **{1000 + i: 1000 for i in range(1, 400)}, 2001: 2000}
    assert components(spark.createDataFrame([], "u long, v long")).collect() == []


def test_no_rows(spark):
    docs = frame(spark, [(1, "x")]).limit(0)
    assert S.simhash(docs).collect() == [] and S.keep_representatives(docs).collect() == []
