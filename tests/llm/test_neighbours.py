import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from marketlens.llm import neighbours as N


def cosine(a, b):
    dot = sum(x * y for x, y in zip(a, b))
    return max(-1.0, min(1.0, dot / math.sqrt(sum(x * x for x in a) * sum(y * y for y in b))))


def fine(v):
    return v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)


def expected(rows, k, is_query):
    rows = [(i, v) for i, v in rows if i is not None and fine(v)]
    out = []
    for q in sorted({i for i, _ in rows if is_query(i)}):
        best = {}
        for own in [v for i, v in rows if i == q]:
            for i, v in rows:
                if i != q and len(v) == len(own):
                    best[i] = max(best.get(i, -2), cosine(own, v))
        out += [(q, r, i, s) for r, (i, s) in enumerate(sorted(best.items(), key=lambda x: (-x[1], x[0]))[:k], 1)]
    return out


def vectors():
    rng = random.Random(4)
    rows = [(i, [rng.gauss(0, 1) for _ in range(12)]) for i in range(300)]
    same = rows[7][1]
    rows += [(1000 + i, same) for i in range(60)] + [(2000 + i, [2 * x for x in same]) for i in range(5)]
    rows += [(3000, None), (3001, []), (3002, [0.0] * 12), (3003, [1.0, None] + [0.0] * 10), (3004, [math.nan] * 12), (3005, [math.inf] + [1.0] * 11)]
    rows += [(None, same), (3050, [1.0, 2.0]), (3051, [2.0, 1.0]), (100, [rng.gauss(0, 1) for _ in range(12)]), (50, rows[50][1]), (3100, [1e-170] * 12), (3101, [1e300] * 12)]
    return rows


@pytest.mark.parametrize(("tile", "queries"), [(1024, 256), (7, 3)])
def test_against_brute_force_in_tiles_of_any_size(spark, tile, queries):
    rows = vectors()
    table = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<double>, score int, part string").repartition(5)
    got = N.nearest(table, F.col("vec_id") % 50 == 0, candidate_rows=tile, query_rows=queries).collect()
    want = expected([(i, [x / 1e300 for x in v] if i == 3101 else [x * 1e170 for x in v] if i == 3100 else v) for i, v in rows], 5, lambda i: i % 50 == 0)
    got = sorted(map(tuple, got))
    assert [(q, r) for q, r, _, _ in got] == [(q, r) for q, r, _, _ in want]
    for g, w in zip(got, want):
        assert g[3] == pytest.approx(w[3], abs=1e-12)
        assert g[2] == w[2] or {g[0], w[0]} & {3100} or abs(g[3] - w[3]) < 1e-12


def test_int8_products_stay_within_the_bound():
    rng = np.random.default_rng(0)
    for scale in (1.0, 100.0):
        a, b = rng.normal(size=(200, 48)) ** 3 * scale, rng.normal(size=(150, 48))
        (qa, sa, ea), (qb, sb, eb) = N.quantised(a), N.quantised(b)
        about = (qa.astype(float) @ qb.T) * sa[:, None] * sb[None, :]
        true = (a / np.linalg.norm(a, axis=1)[:, None]) @ (b / np.linalg.norm(b, axis=1)[:, None]).T
        assert (np.abs(about - true) <= ea[:, None] + (1 + ea[:, None]) * eb[None, :] + 1e-12).all()


def test_fewer_candidates_than_wanted_and_no_rows(spark):
    table = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 1.0])], "vec_id long, embedding array<float>")
    assert [(r.query_id, r.rank, r.vec_id) for r in N.nearest(table, F.col("vec_id") == 0).collect()] == [(0, 1, 1)]
    assert N.nearest(table.limit(0), F.lit(True)).collect() == []
