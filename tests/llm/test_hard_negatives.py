import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tapeworks.llm import hard_negatives as H

SCHEMA = "vec_id long, label int, embedding array<float>"


def brute(rows, anchor, low=80, k=5, scale=256):
    own = {}
    for i, label, v in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        key = (label, [float(np.float32(x)) for x in v])
        if i not in own or key < own[i]:
            own[i] = key
    q = {i: (label, [math.floor(scale * x) for x in v]) for i, (label, v) in own.items()}
    out = []
    for a, (la, va) in q.items():
        if not anchor(a):
            continue
        s = {i: max(-H.MOST - 1, min(H.MOST, sum(x * y for x, y in zip(va, v)))) for i, (_, v) in q.items()}
        order = sorted((i for i in q if i != a), key=lambda i: (-s[i], i))
        for p in [i for i in order if q[i][0] == la][:k]:
            fit = [n for n in order if q[n][0] != la and low * s[p] <= 100 * s[n] <= 100 * s[p]][:k]
            out += [(a, p, r, n, s[p], s[n]) for r, n in enumerate(fit, 1)]
    return sorted(out)


def _rows(n, seed, kind):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(8)] for _ in range(5)]
    rows = []
    for i in range(n):
        label = rng.randrange(4)
        c = centres[rng.randrange(5)]
        v = [x + rng.gauss(0, .1 if kind == "clusters" else 2) for x in c]
        if kind == "ties":
            v = [rng.choice([-1.0, 0.0, 1.0]) for _ in range(3)]
        if kind == "sizes":
            v = [x * 10 ** rng.randint(-4, 4) for x in v]
        rows.append((i, label, v))
    return rows


def _got(spark, rows, block_rows=None, **kw):
    out = H.mine(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 10 == 0, block_rows=block_rows, **kw)
    assert out.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(map(tuple, out.collect()))


@pytest.mark.parametrize("kind", ["clusters", "plain", "ties", "sizes"])
@pytest.mark.parametrize("block_rows", [7, 60, None])
def test_equals_brute_force(spark, kind, block_rows):
    rows = _rows(220, 5, kind)
    assert _got(spark, rows, block_rows) == brute(rows, lambda i: i % 10 == 0)


def test_missing_and_odd_rows(spark):
    rows = _rows(60, 6, "clusters")
    rows += [(None, 1, [1.0] * 8), (100, None, [1.0] * 8), (110, 1, None), (120, 1, [1.0, None]), (130, 1, [math.nan] * 8),
             (140, 1, [math.inf] * 8), (150, 1, []), (160, 2, [0.0] * 8), (170, 2, [1.0, 2.0]), (171, 3, [1.0] * 12)]
    rows += [(10, 0, [9.0] * 8), (10, 0, [9.0] * 8), (180, 7, [1.0] * 8)]  # repeated ids; a label of its own
    assert _got(spark, rows, 9) == brute(rows, lambda i: i % 10 == 0)


def test_scores_beyond_doubles_and_longs(spark):
    rows = [(i, i % 3, [float(10 ** (6 + i % 5)) + i, -3.0, float(i)]) for i in range(40)]
    rows += [(100 + i, i % 2, [1e30 * (1 + i), 5.0, 0.0]) for i in range(6)]
    assert _got(spark, rows, 8) == brute(rows, lambda i: i % 10 == 0)


def test_empty_and_hot_vector(spark):
    assert _got(spark, []) == []
    rows = [(i, i % 2, [1.0, 2.0]) for i in range(90)] + _rows(30, 7, "clusters")[:0]
    assert _got(spark, rows, 8) == brute(rows, lambda i: i % 10 == 0)


def test_extra_columns(spark):
    rows = _rows(40, 8, "clusters")
    df = spark.createDataFrame(rows, SCHEMA)
    for c in ("id", "v", "cell", "score", "rank", "gid", "share", "kind", "angle", "norm", "is_anchor"):
        df = df.withColumn(c, F.lit("x"))
    got = sorted(map(tuple, H.mine(df, F.col("vec_id") % 10 == 0).collect()))
    assert got == brute(rows, lambda i: i % 10 == 0)


def test_bounds_hold():
    """No row outside a window, and no group left out, has a score between the limits."""
    rng = np.random.default_rng(9)
    refs = H.references(rng.normal(size=(50, 6)).tolist())
    x = np.floor(256 * rng.normal(size=(400, 6)) * 10 ** rng.uniform(-1, 2, (400, 1)))
    norms = np.linalg.norm(x, axis=1)
    angles = np.arccos(np.clip(x @ refs.T / norms[:, None], -1, 1))
    s = x @ x.T
    for a in range(0, 400, 7):
        near, far = angles.min(axis=0), angles.max(axis=0)
        least = np.maximum(0, np.maximum(near - angles[a], angles[a] - far)).max()
        assert H._product(norms[a], norms.min(), norms.max(), math.cos(max(0, least - H.EPS)), True) >= s[a].max()
        order = np.argsort(angles[:, 0])
        block = H._Block.__new__(H._Block)
        block.angles, block.small, block.large = angles[order, 0], norms.min(), norms.max()
        for floor, top in ((0.3 * s[a].max(), 0.6 * s[a].max()), (-1.0, 5.0), (0.9 * s[a].max(), math.inf)):
            lo, hi = block.window(0, 400, norms[a], angles[a, 0], floor, top)
            inside = set(order[lo:hi].tolist())
            assert all(i in inside for i in np.flatnonzero((s[a] >= floor) & (s[a] <= top)).tolist())


def test_packing_of_vectors():
    for v in ([1, -2], [40000, 1], [2.0**40, -1], []):
        v = np.array(v, float)
        assert H.unpacked([H.packed(v)])[0].tolist() == v.tolist()
