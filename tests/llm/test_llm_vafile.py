"""Clustering on a vector approximation file against a plain computation."""

import hashlib
import math

import numpy as np
import pytest
from compare import compare
from conftest import SF_GATE, SF_SMALL

from barlake.llm import vafile as V

VECTORS = "vec_id long, embedding array<double>, label int, cluster long, v string"


def plain(rows, k=16, rounds=3):
    kept = [(i, [math.floor(64 * x) for x in v]) for i, v in rows
            if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    key = lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), r[1])
    cents = [list(v) for _, v in sorted(kept, key=key)[:k]]
    gap = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    for r in range(rounds + 1):
        near = [min((gap(v, c), j) for j, c in enumerate(cents)) for _, v in kept]
        if r == rounds:
            break
        for j in range(len(cents)):
            mine = [v for (_, v), (_, c) in zip(kept, near) if c == j]
            if mine:
                cents[j] = [sum(x) // len(mine) for x in zip(*mine)]
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cents]
    per = [sum(d for d, c in near if c == j) for j in range(len(cents))]
    return sorted(((i, c, d, per[c], sum(per), digest[c]) for (i, _), (d, c) in zip(kept, near)), key=str)


def got(spark, rows, monkeypatch):
    df = spark.createDataFrame([(i, v, 0, 5, "z") for i, v in rows], VECTORS).repartition(3)
    monkeypatch.setattr(V, "table", lambda *a: df)
    return sorted(map(tuple, V.op11_centroids(spark, "").collect()), key=str)


@pytest.mark.parametrize("bits", [1, 3, 6, 8])
def test_equals_plain_computation_with_any_cells(spark, monkeypatch, bits):
    rng = np.random.default_rng(bits)
    middle = rng.normal(size=(5, 64))
    rows = [(i, (middle[i % 5] + rng.normal(size=64) * (0.02 if i % 3 else 1)).tolist()) for i in range(150)]
    rows += [(200 + i, [0.25 * (i % 2)] * 64) for i in range(40)]                           # ties and repeats
    rows += [(7, rows[7][1]), (7, rows[8][1]), (None, rows[3][1]), (300, [1e5] * 63 + [-1e5])]
    rows += [(400, None), (401, []), (402, [1.0] * 63), (403, [None] + [1.0] * 63), (404, [float("nan")] * 64), (405, [float("inf")] * 64)]
    monkeypatch.setattr(V, "CELL_BITS", bits)
    monkeypatch.setattr(V, "BATCH", 37)
    assert got(spark, rows, monkeypatch) == plain(rows)


def test_few_equal_and_no_vectors(spark, monkeypatch):
    for rows in ([], [(1, None)], [(1, [0.5] * 64)], [(i, [0.5] * 64) for i in range(30)], [(i, [i / 7] * 64) for i in range(5)]):
        assert got(spark, rows, monkeypatch) == plain(rows)


def test_a_component_beyond_the_bound_is_left_out(spark, monkeypatch):
    assert got(spark, [(1, [2.0 ** 20] * 64), (2, [2.0 ** 20 + 1] + [0.0] * 63), (3, [1e300] * 64)], monkeypatch) == \
        plain([(1, [2.0 ** 20] * 64)])


def test_intervals_decide_most_vectors_and_hold_the_distance(spark):
    rng = np.random.default_rng(1)
    centroids = rng.integers(-40, 40, (6, 64))
    v = centroids[rng.integers(0, 6, 500)] + rng.integers(-4, 5, (500, 64))
    edges = [np.unique([v[:, d].min(), *np.linspace(-30, 30, 7).astype(int), v[:, d].max() + 1]) for d in range(64)]
    edges = [e[(e >= v[:, d].min()) & (e <= v[:, d].max() + 1)] for d, e in enumerate(edges)]
    cells = np.stack([np.searchsorted(e[:-1], v[:, d], "right") - 1 for d, e in enumerate(edges)], 1)
    low, high = V.lookup(edges, centroids)
    exact = ((v[:, None] - centroids) ** 2).sum(2)
    shift = ((v - centroids.sum(0) // 6) ** 2).sum(1)[:, None]
    lows, highs = (sum(t[cells[:, d]] for d, t in enumerate(x)) for x in (low, high))
    assert (lows <= exact - shift).all() and (exact - shift <= highs).all()
    fetched = []
    near, n = V.nearest(cells, lambda rows: fetched.extend(rows) or v[rows], (low, high), centroids)
    assert (near == exact.argmin(1)).all() and n == len(fetched) < 100


def test_query_equals_sql(spark, con_small, con_gate):
    for sf, con in ((SF_SMALL, con_small), (SF_GATE, con_gate)):
        ok, msg = compare(V.op11_centroids(spark, sf), con, V.OP11_SQL)
        assert ok, msg
