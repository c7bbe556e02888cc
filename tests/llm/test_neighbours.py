import numpy as np
import pytest
from pyspark.sql import functions as F

from velatura.llm.neighbours import Heaps, _codes, nearest, recall


def brute(ids, xs, queries, k):
    out = {}
    for q in queries:
        if ids.count(q) == 0 or xs[ids.index(q)] is None:
            continue
        v = xs[ids.index(q)]
        scored = [(-sum(float(a) * float(b) for a, b in zip(v, x)), i) for i, x in zip(ids, xs) if x is not None and i != q and len(x) == len(v)]
        out[q] = [(i, -s) for s, i in sorted(scored)[:k]]
    return out


def ok(x):
    return x if x is not None and all(c is not None and np.isfinite(c) for c in x) and any(c != 0 for c in x) else None


@pytest.mark.parametrize("block,stripe", [(2048, 65_536), (7, 50)])
def test_against_brute_force(spark, block, stripe):
    r = np.random.default_rng(3)
    x = [[float(np.float32(c)) for c in v] for v in r.normal(size=(300, 16))]
    x[10] = x[11] = x[12]  # ties
    x[13] = None
    x[14] = [0.0] * 16
    x[15] = [float("nan")] * 16
    x[16] = [float("inf")] + [1.0] * 15
    x[17] = [None] + [1.0] * 15
    x[18] = [1.0, 2.0]
    x[20] = [1e6 * c for c in x[20]]
    rows = spark.createDataFrame([(i, v, "x") for i, v in enumerate(x)], "vec_id long, embedding array<float>, score string")
    got = {}
    out = nearest(rows, F.expr("vec_id % 20 = 0 or vec_id in (12, 13, 18)"), 20, query_block=block, stripe=stripe)
    for q in sorted(out.collect(), key=lambda q: (q["query_id"], q["rank"])):
        got.setdefault(q["query_id"], []).append((q["vec_id"], q["score"]))
    clean = [ok(None if v is None else [None if c is None else np.float32(c) for c in v]) for v in x]
    want = brute(list(range(300)), clean, [*range(0, 300, 20), 12, 13, 18], 20)
    assert {k: [i for i, _ in v] for k, v in got.items()} == {k: [i for i, _ in v] for k, v in want.items() if v}
    for k, v in got.items():
        assert [s for _, s in v] == pytest.approx([s for _, s in want[k]], rel=1e-12)
    assert recall(out, out) == 1.0


def test_bounds_hold():
    r = np.random.default_rng(5)
    x = r.normal(size=(200, 8)) * r.exponential(10, size=(200, 1))
    codes, scale, norm, error = _codes(x)
    whole = np.sqrt((x**2).sum(axis=1))
    h = Heaps(np.arange(5), codes[:5], scale[:5], norm[:5], error[:5], 7)
    for at in range(0, 200, 30):
        t = slice(at, min(200, at + 30))
        h.meet(np.arange(200)[t], codes[t], scale[t], error[t], whole[t])
    q, row, low, high = h.survivors()
    exact = (x[q] * x[row]).sum(axis=1)
    assert (low <= exact).all() and (exact <= high).all() and len(q) < 5 * 30
    for k in range(5):
        s = x @ x[k]
        s[k] = -np.inf
        assert set(np.argsort(-s)[:7]) <= set(row[q == k])


def test_rows_that_repeat_an_id(spark):
    rows = spark.createDataFrame([(20, [1.0, 0.0]), (20, [0.5, 0.5]), (3, [2.0, 1.0]), (None, [9.0, 9.0]), (0, None)], "vec_id long, embedding array<double>")
    got = sorted(tuple(r) for r in nearest(rows, F.col("vec_id") % 20 == 0, 5).collect())
    assert got == [(20, 1, 3, 1.5), (20, 1, 3, 2.0), (20, 2, 20, 0.5), (20, 2, 20, 0.5)]


def test_few_and_none(spark):
    rows = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.5])], "vec_id long, embedding array<double>")
    assert [tuple(r) for r in nearest(rows, F.expr("vec_id = 0"), 20).collect()] == [(0, 1, 1, 0.5)]
    assert nearest(rows.where("false"), F.lit(True), 20).count() == 0
    assert nearest(rows, F.lit(False), 20).count() == 0
