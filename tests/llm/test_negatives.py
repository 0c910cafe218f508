"""Hard negatives against all pairs."""

import math

import numpy as np
import pytest

from farelake.llm import op12_negatives as o12

SCHEMA = "vec_id long, embedding array<double>, label int, id string, score double, anchor string"


def brute(rows, positives=5, negatives=10, every=100):
    ok = {}
    for i, v, l in rows:
        if i is None or l is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        q = [math.floor(256 * x) for x in v]
        if sum(c * c for c in q) < 2 ** 62:
            key = (l, np.array(q, "<i4").tobytes(), q)
            ok[i] = min(ok.get(i, key), key)
    out = []
    for i, (l, _, q) in ok.items():
        if i % every:
            continue
        s = sorted((-sum(map(int.__mul__, q, p)), j, m) for j, (m, _, p) in ok.items() if j != i and len(p) == len(q))
        for ps, j in [(-a, j) for a, j, m in s if m == l][:positives]:
            hit = [(-a, k) for a, k, m in s if m != l and 30 * ps <= -100 * a <= 90 * ps]
            out += [(i, j, r + 1, k, ps, ns) for r, (ns, k) in enumerate(hit[:negatives])]
    return sorted(out)


def found(spark, rows, parts=3, **kw):
    df = spark.createDataFrame([(i, v, l, "x", 1.0, "y") for i, v, l in rows], SCHEMA).repartition(parts)
    return sorted(tuple(r) for r in o12.hard_negatives(df, **kw).collect())


def vectors(seed, n, dim, clusters, spread):
    rng = np.random.default_rng(seed)
    centre = rng.standard_normal((clusters, dim))
    return [(i, (rng.random() * (centre[i % clusters] + spread * rng.standard_normal(dim))).tolist(), int(rng.integers(0, 4))) for i in range(n)]


@pytest.mark.parametrize("spread", [0.05, 0.5, 3.0])
def test_against_all_pairs(spark, spread, monkeypatch):
    monkeypatch.setattr(o12, "STRETCH", 16)
    rows = vectors(int(spread * 100), 700, 8, 6, spread)
    assert found(spark, rows) == brute(rows)


def test_blocks_of_anchors(spark, monkeypatch):
    monkeypatch.setattr(o12, "ANCHOR_ROWS", 3)
    rows = vectors(5, 300, 4, 3, 0.3)
    assert found(spark, rows, anchor="id % 20 = 0") == brute(rows, every=20)


def test_unusual_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = vectors(6, 120, 4, 2, 0.5)
    rows += [(None, [1.0] * 4, 1), (200, None, 1), (201, [1.0, None, 1.0, 1.0], 1), (202, [nan] * 4, 1), (203, [inf] * 4, 1), (204, [1.0] * 4, None),
             (300, [0.0] * 4, 1), (400, [1e30] * 4, 1), (500, [], 2), (600, [1.0, 2.0], 1), (601, [1.0, 2.0], 1), (602, [1.0, 1.0], 2), (603, [0.5, 1.0], 3),
             (700, [4e6, 0.0, 0.0, 1.0], 1), (701, [4e6, 1.0, 0.0, 0.0], 1), (702, [2e6, 1.0, 0.0, 0.0], 2), (100, [9.0] * 4, 0), (5, [1.0] * 4, 2)]
    rows += [(800 + k, [0.3, 0.3, 0.0, 0.1], k % 2) for k in range(30)]  # ties
    assert found(spark, rows) == brute(rows)
    assert found(spark, []) == [] and found(spark, [(100, [1.0], 1)]) == []


def test_bounds_hold():
    """Scores never leave their bounds, for single rows and for stretches."""
    rng = np.random.default_rng(9)
    q = np.floor(300 * rng.standard_normal((400, 12)) * (rng.random((400, 1)) < 0.9)).astype(np.int64)
    q[:50] = q[50:100] + rng.integers(0, 2, (50, 12))
    norm = np.sqrt((q * q).sum(axis=1).astype(float))
    units = q[:5] / np.maximum(norm[:5], 1)[:, None]
    angles = np.arccos(np.clip(q @ units.T / np.maximum(norm, 1)[:, None], -1, 1)).astype("<f4")
    s = q @ q.T
    lo, hi = o12.bounds(angles, norm, angles, angles, norm, norm)
    assert (lo <= s).all() and (s <= hi).all()
    cut = np.arange(0, 400, 7)
    lo, hi = o12.bounds(angles, norm, np.minimum.reduceat(angles, cut), np.maximum.reduceat(angles, cut),
                        np.minimum.reduceat(norm, cut), np.maximum.reduceat(norm, cut))
    assert (lo[:, np.arange(400) // 7] <= s).all() and (s <= hi[:, np.arange(400) // 7]).all()
    big = np.array([[2 ** 30, -3], [2 ** 30 - 1, 5]])
    assert o12.scores(big, big, 2.0 ** 61).tolist() == [[2 ** 60 + 9, 2 ** 60 - 2 ** 30 - 15], [2 ** 60 - 2 ** 30 - 15, (2 ** 30 - 1) ** 2 + 25]]
