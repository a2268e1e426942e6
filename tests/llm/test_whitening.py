"""Whitening against numpy over the distinct vectors."""

import math
import random

import numpy as np
import pytest

from marketlens.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, label int, x array<long>, idx long, n long, values array<double>"


def frame(spark, rows):
    return spark.createDataFrame([(i, e, 1, [5], 6, 7, [1.0]) for i, e in rows], SCHEMA)


def vectors(count, dim, seed=1):
    rng = np.random.default_rng(seed)
    mix = rng.normal(size=(dim, dim))
    return [(i, [float(c) for c in np.float32(v)]) for i, v in enumerate(rng.normal(size=(count, dim)) @ mix)]


def taking_part(rows):
    fine = [(i, e) for i, e in rows if e and all(c is not None and math.isfinite(c) for c in e)]
    lengths = [len(e) for _, e in fine]
    most = max(lengths, key=lambda d: (lengths.count(d), d), default=0)
    return [(i, e) for i, e in fine if len(e) == most]


def check(got, rows, components=16):
    fine = taking_part(rows)
    x = np.array([[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in e] for _, e in fine])
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(axis=0)
    centred = (n * fit - s) / n
    cov = centred.T @ centred / n
    values, basis = np.linalg.eigh(cov)
    values, basis = values[::-1], basis[:, ::-1]
    keep = min(components, int((values > 1e-9 * values[0]).sum()))
    expected = ((n * x - s) / n) @ basis[:, :keep] / np.sqrt(values[:keep])
    assert len(got) == len(fine) * keep
    by_key = {}
    for r in got:
        by_key.setdefault((r.vec_id, r.component), []).append(r)
    signs = {}
    for (i, _), row, want in zip(fine, x, expected):
        deviation = sum(int(v) ** 2 for v in n * row - s)
        for k in range(keep):
            found = by_key[i, k + 1]
            for r in found:
                assert (r.n, r.deviation if len(found) == 1 else deviation) == (n, deviation)
                assert r.explained == pytest.approx(values[k] / np.trace(cov), rel=1e-9)
            near = min(found, key=lambda r: abs(abs(r.whitened) - abs(want[k])))
            assert abs(near.whitened) == pytest.approx(abs(want[k]), abs=1e-8)
            if abs(want[k]) > 1e-3:
                signs.setdefault(k, set()).add(near.whitened * want[k] > 0)
    assert all(len(x) == 1 for x in signs.values())
    assert len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-9


@pytest.mark.parametrize("dim", [3, 24])
def test_against_numpy(spark, dim):
    rows = vectors(300, dim)
    rows += [(900 + k, rows[7][1]) for k in range(150)]  # copies count once in the fit
    out = whitening.whiten(frame(spark, rows))
    assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    check(out.collect(), rows)


def test_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(whitening, "BLOCK_ROWS", 16)
    monkeypatch.setattr(whitening, "BLOCK_COLUMNS", 7)
    rows = vectors(250, 20, seed=2)
    check(whitening.whiten(frame(spark, rows), components=5).collect(), rows, 5)


def test_odd_rows(spark):
    rows = vectors(60, 4, seed=3)
    nan, inf = float("nan"), float("inf")
    odd = [(70, None), (71, []), (72, [1.0, None, 2.0, 3.0]), (73, [nan, 1.0, 1.0, 1.0]), (74, [1.0, -inf, 1.0, 1.0]), (75, [1.0, 2.0])]
    again = [(None, rows[0][1]), (None, rows[1][1]), (5, rows[5][1]), (76, [0.0] * 4), (77, [-0.0] * 4)]
    got = whitening.whiten(frame(spark, rows + odd + again)).collect()
    assert not {r.vec_id for r in got} & {70, 71, 72, 73, 74, 75}
    check(got, rows + odd + again)


def test_no_variance_and_no_rows(spark):
    assert whitening.whiten(frame(spark, [])).collect() == []
    assert whitening.whiten(frame(spark, [(1, None)])).collect() == []
    assert whitening.whiten(frame(spark, [(k, [1.0, 2.0]) for k in range(9)])).collect() == []
    rows = [(k, [float(k), 2.0 * k]) for k in range(9)]  # a line: one component
    check(whitening.whiten(frame(spark, rows)).collect(), rows)


def test_too_large_for_a_long(spark):
    with pytest.raises(Exception, match="too large"):
        whitening.whiten(frame(spark, [(1, [1e30]), (2, [1.0])])).collect()


def test_random_small_inputs(spark):
    rng = random.Random(9)
    rows = [(k, [rng.choice([-1.5, 0.0, 0.25, 3.0]) for _ in range(3)]) for k in range(80)]
    check(whitening.whiten(frame(spark, rows)).collect(), rows)
