"""Whitening against a dense eigendecomposition in one process; rank-one updates with deflation; edge cases."""

import math
import random

import numpy as np
import pytest

from roomtide.llm import whitening as W

SCHEMA = "vec_id long, embedding array<float>, label int, x int, n string"


@pytest.mark.parametrize("kind", ["spread", "equal dimensions", "copies", "few values", "one", "zero"])
def test_spectrum_of_updates(kind):
    rng = np.random.default_rng(3)
    x = rng.normal(0, 1, (200, 24)) * np.linspace(1, 50, 24)
    if kind == "equal dimensions":
        x[:, :5] = x[:, 5:10]
    elif kind == "copies":
        x[40:] = x[0]
    elif kind == "few values":
        x = np.round(x / 40)
    elif kind == "one":
        x = x[:1]
    elif kind == "zero":
        x *= 0
    whole, a, b = (W.Spectrum(24) for _ in range(3))
    for i, v in enumerate(x):
        whole.add(v)
        (a if i % 3 else b).add(v)
    b.combine(a) if a.n else None
    away = x - x.mean(axis=0)
    scatter = away.T @ away
    for s in (whole, b):
        size = max(np.abs(scatter).max(), 1.0)
        assert s.n == len(x)
        assert np.abs(s.basis * s.values @ s.basis.T - scatter).max() <= 1e-11 * size
        assert np.abs(s.basis.T @ s.basis - np.eye(24)).max() <= 1e-11
        assert np.abs(np.sort(s.values) - np.linalg.eigvalsh(scatter)).max() <= 1e-11 * size


def test_secular_roots_of_near_poles():
    for gap in (1e-3, 1e-8, 1e-12):
        d = np.array([1.0, 1.0 + gap, 2.0, 1e6])
        z = np.array([1e-4, 0.7, 1e-6, 0.3])
        values, q = W.secular(d, z, 2.5)
        assert np.abs(q.T @ q - np.eye(4)).max() < 1e-13
        assert np.abs(q * values @ q.T - np.diag(d) - 2.5 * np.outer(z, z)).max() < 1e-9


def brute(rows):
    known = [(k, v) for k, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    sizes = sorted({len(v) for _, v in known}, key=lambda s: (-sum(len(v) == s for _, v in known), -s))
    known = [(k, v) for k, v in known if len(v) == sizes[0]]
    x = [[math.floor(1024 * float(np.float32(c))) + 100_000 for c in v] for _, v in known]
    n, sums = len(x), [sum(c) for c in zip(*x, strict=True)]
    exact = [[n * c - s for c, s in zip(v, sums, strict=True)] for v in x]
    away = np.array(exact, float) / n
    values, found = np.linalg.eigh(away.T @ away / n)
    return [k for k, _ in known], n, [sum(c * c for c in v) for v in exact], away, values[::-1], found[:, ::-1]


def check(rows, got, components=8):
    ids, n, deviation, away, values, found = brute(rows)
    k = min(components, len(values))
    by_key = sorted((r.vec_id is None, r.vec_id, r.deviation, r.component) for r in got)
    assert len(got) == len(ids) * k
    want = sorted((i is None, i, d, c + 1) for i, d in zip(ids, deviation, strict=True) for c in range(k))
    assert by_key == want
    live = [c for c in range(k) if values[c] > 1e-10 * values.sum()]
    for c in range(k):
        mine = [r for r in got if r.component == c + 1]
        assert all(r.explained == pytest.approx(max(values[c], 0) / values.sum(), rel=1e-9, abs=1e-12) for r in mine)
        if c in live and all(abs(values[c] - values[o]) > 1e-6 * values[0] for o in range(len(values)) if o != c):
            white = away @ found[:, c] / math.sqrt(values[c])
            expected = sorted((d, abs(w)) for d, w in zip(deviation, white.tolist(), strict=True))
            for (d, w), r in zip(expected, sorted(mine, key=lambda r: (r.deviation, abs(r.whitened))), strict=True):
                assert d == r.deviation and abs(r.whitened) == pytest.approx(w, abs=1e-8)
    assert {r.n for r in got} == {n} and all(r.identity_error < 1e-8 for r in got)


def test_whiten(spark, monkeypatch):
    monkeypatch.setattr(W, "FAN_IN", 2)
    r = random.Random(6)
    rows = [(i, [r.gauss(j / 9, 0.2 + j / 5) for j in range(12)]) for i in range(300)]
    rows += [(400 + i, rows[7][1]) for i in range(50)] + [(3, rows[3][1]), (None, rows[4][1]), (500, [0.0] * 12)]
    rows += [(600, None), (601, [None] + [1.0] * 11), (602, [float("nan")] * 12), (603, [float("-inf")] * 12), (604, [1.0] * 5), (605, [])]
    df = spark.createDataFrame([(*row, 1, 2, "a") for row in rows], SCHEMA).repartition(7)
    got = W.whiten(df).collect()
    check(rows, got)
    assert len({np.sign(x.whitened) for x in got if x.vec_id == 3 and x.component == 1}) == 1


@pytest.mark.parametrize("rows", [
    [(1, [0.5, 0.25])], [(1, [0.5] * 3), (1, [0.5] * 3), (2, [0.5] * 3)], [(i, [i / 7, i / 7, -i / 7]) for i in range(9)],
    [(1, [3e38, 1.0]), (2, [-3e38, 1.0]), (3, [0.0, 0.0])],
])
def test_degenerate(spark, rows):
    got = W.whiten(spark.createDataFrame([(*r, 1, 2, "a") for r in rows], SCHEMA)).collect()
    assert len(got) == len(rows) * len(rows[0][1])
    assert all(math.isfinite(r.whitened) and r.identity_error < 1e-6 for r in got)
    assert all(r.whitened == 0 for r in got if r.explained == 0)


def test_empty_table(spark):
    for rows in ([], [(1, None, 1, 2, "a")], [(1, [], 1, 2, "a")]):
        out = W.whiten(spark.createDataFrame(rows, SCHEMA))
        assert out.collect() == [] and out.columns[0] == "vec_id"
