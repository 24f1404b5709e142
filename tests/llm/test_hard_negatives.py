"""Hard negatives against brute force: ties, copies, nulls, other lengths, very large components, small blocks."""

import math
import random

import numpy as np
import pytest

from roomtide.llm import hard_negatives as H

SCHEMA = "vec_id long, embedding array<float>, label int, row string, x int, summary int"


def brute(rows, positives=H.POSITIVES, negatives=H.NEGATIVES):
    known = []
    for vec_id, vector, label in rows:
        if vec_id is None or label is None or vector is None or any(c is None or not math.isfinite(c) for c in vector):
            continue
        x = [math.floor(min(max(256 * float(np.float32(c)), -H.LIMIT), H.LIMIT)) for c in vector]
        known.append((vec_id, (label + 1) % 10 if vec_id % 7 == 0 else label, x))
    out = []
    for i, (a, al, ax) in enumerate(known):
        if a % 100:
            continue
        scored = [(-sum(p * q for p, q in zip(ax, x, strict=True)), v, lab) for j, (v, lab, x) in enumerate(known) if j != i and len(x) == len(ax)]
        for p, pid in [(-s, v) for s, v, lab in sorted(scored) if lab == al][:positives]:
            fits = sorted((s, v) for s, v, lab in scored if lab != al and 30 * p <= -100 * s <= 90 * p)[:negatives]
            out += [(a, pid, r + 1, v, p, -s) for r, (s, v) in enumerate(fits)]
    return sorted(out)


def found(df):
    return sorted(tuple(r) for r in df.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())


@pytest.fixture(scope="module")
def rows():
    r = random.Random(8)
    centre = [[r.gauss(0, 1) for _ in range(19)] for _ in range(6)]
    out = []
    for i in range(900):
        c = centre[i % 6]
        out.append((i * 5, [v + r.gauss(0, 0.7) for v in c], 3 if i % 3 else i % 10))
    copy = out[40][1]
    out += [(10_000 + i, copy, i % 4) for i in range(40)]
    out += [(20_000 + i * 100, [r.choice([-0.5, 0.5]) for _ in range(19)], 1) for i in range(30)]
    out += [(30_000 + i * 50, [r.gauss(0, 1) for _ in range(3)], i % 2) for i in range(20)]
    out += [(40_000, [3e38] * 19, 2), (40_001, [3e38] * 19, 2), (40_100, [-3e38] * 19, 2), (40_002, [1e30] * 19, 4)]
    out += [(50_000, None, 1), (50_100, [None] * 19, 1), (50_200, [float("nan")] * 19, 1), (50_300, copy, None), (None, copy, 1), (50_400, [float("inf")] * 19, 1)]
    out += [(60_000, [0.0] * 19, 1), (60_100, [], 1), (60_101, [], 1), (60_102, [], 2), (100, out[20][1], 3), (100, out[20][1], 3), (-700, copy, 9)]
    return out


@pytest.mark.parametrize("blocks", [(4096, 8192, 1024), (7, 100, 33)])
def test_equals_brute_force(spark, rows, monkeypatch, blocks):
    for name, value in zip(("ANCHORS", "ROWS", "CHUNK"), blocks, strict=True):
        monkeypatch.setattr(H, name, value)
    df = spark.createDataFrame([(*r, "a", 1, 2) for r in rows], SCHEMA).repartition(5)
    got = found(H.mine(df))
    assert got == brute(rows) and len(got) > 300


def test_empty_table(spark):
    assert found(H.mine(spark.createDataFrame([], SCHEMA))) == []


def test_bounds_hold_and_prune():
    rng = np.random.default_rng(2)
    x = np.concatenate([rng.normal(0, 60, (200, 33)) + 90 * np.repeat(rng.normal(0, 1, (200, 3)), 11, axis=1)]).round().astype(np.int64)
    for parts in H.SEGMENTS:
        m, d = H._level(x.astype(float), parts)
        middle, width = m @ m.T, d @ d.T
        assert (np.abs(x @ x.T - middle) <= width + 1e-6 * np.abs(middle) + 1e-3).all()
    # a wide gap between groups is seen by the first level alone
    far = np.concatenate([np.full((5, 32), 100), np.full((50, 32), -100)]) + rng.integers(-2, 3, (55, 32))
    m, d = H._level(far.astype(float), 1)
    assert ((m @ m.T + d @ d.T)[:5, 5:] < 0).all()
