"""Threshold algorithm and forest search against brute force."""
import math

import numpy as np
import pytest

from feedlake.llm import forest, queries, threshold
from tests.conftest import SF0001


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id long, embedding array<double>, rank int")


def brute_top(rows, every, k, scale=1024):
    ok = {(i, tuple(math.floor(scale * x) for x in v)) for i, v in rows
          if i is not None and v and all(x is not None and math.isfinite(x) for x in v)}
    out = set()
    for q, a in ok:
        if q % every == 0:
            s = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in ok if i != q and len(a) == len(b))
            out |= {(q, r + 1, i, -sc) for r, (sc, i) in enumerate(s[:k])}
    return out


def test_threshold_cases(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=4).tolist()) for i in range(60)]
    rows += [(100 + i, [0.5, 0.5, 0.5, 0.5]) for i in range(40)]        # many ties
    rows += [(200, [0.0] * 4), (201, [0.0] * 4), (300, None), (400, []), (500, [1.0, None, 1.0, 1.0]),
             (600, [float("nan")] * 4), (700, [float("inf")] * 4), (800, [1.0, 2.0]), (801, [3.0, -1.0]),
             (None, [1.0] * 4), (100, [0.5, 0.5, 0.5, 0.5]), (900, [-0.001, 0.0, 0.0, 0.0])]
    got = {tuple(r) for r in threshold.exact_top_k(frame(spark, rows), k=5, every=10).collect()}
    assert got == brute_top(rows, 10, 5)
    assert threshold.exact_top_k(frame(spark, [])).count() == 0
    one = threshold.exact_top_k(frame(spark, [(0, [1.0]), (5, [2.0])])).collect()
    assert [tuple(r) for r in one] == [(0, 1, 5, 1024 * 2048)]


def test_threshold_large_components(spark):
    rows = [(0, [1e300, 1.0]), (1, [1.0, 1e5]), (2, [-1e300, 3.0]), (3, [1e9, 1e9]), (10, [1e9, 7.0])]
    got = [tuple(r) for r in threshold.exact_top_k(frame(spark, rows), k=3, every=10).orderBy("query_id", "rank").collect()]
    assert [r[2] for r in got if r[0] == 10] == [0, 3, 1]
    assert all(-2**63 <= r[3] < 2**63 for r in got)


@pytest.mark.parametrize("k", [1, 7])
def test_threshold_stops_early_and_exactly(k):
    rng = np.random.default_rng(4)
    x = np.floor(rng.normal(size=(500, 3)) * 50)
    ids = np.arange(500)
    q, c, s = threshold.threshold_search(ids, x, ids[:40], x[:40], k)
    for i in range(40):
        all_ = x @ x[i]
        want = [j for j in np.lexsort((ids, -all_)) if j != i][:k]
        assert c[q == i].tolist() == want and s[q == i].tolist() == all_[want].tolist()


def test_op1_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF0001}/embeddings.parquet").select("vec_id", "embedding").collect()]
    got = {tuple(r) for r in queries.op1_exact_topk(spark, SF0001).collect()}
    assert got == brute_top(rows, 100, 10)


def recall(rows, got, every, k):
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], float)
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    hit = total = 0
    for q in np.flatnonzero(ids % every == 0):
        s = u @ u[q]
        best = [ids[j] for j in np.lexsort((ids, -np.round(s, 12))) if ids[j] != ids[q]][:k]
        hit += len(set(best) & {r.vec_id for r in got if r.query_id == ids[q]})
        total += len(best)
    return hit / total


def test_forest_recall_over_several_blocks(spark):
    rng = np.random.default_rng(6)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(6000, 32)))]
    got = forest.nearest(frame(spark, rows)).collect()
    assert recall(rows, got, 50, 5) >= 0.9


def test_forest_cases(spark):
    rng = np.random.default_rng(7)
    rows = [(i, rng.normal(size=6).tolist()) for i in range(1, 300)]
    rows += [(i, [1.0, 2.0, 3.0, 4.0, 5.0, 6.0]) for i in range(1000, 1400)]     # equal vectors
    rows += [(0, [0.0] * 6), (2000, None), (2001, []), (2002, [None] * 6), (2050, [float("nan")] * 6), (None, [1.0] * 6),
             (3000, [1e-200] * 6), (3001, [1e200] * 6)]
    got = forest.nearest(frame(spark, rows)).orderBy("query_id", "rank").collect()
    assert [r.vec_id for r in got if r.query_id == 1050] == [1000, 1001, 1002, 1003, 1004]
    assert [r.vec_id for r in got if r.query_id == 1000] == [1001, 1002, 1003, 1004, 1005]
    assert {r.query_id for r in got} == {*range(50, 300, 50), *range(1000, 1400, 50), 3000}
    top = next(r for r in got if r.query_id == 3000)
    assert top.vec_id == 3001 and top.score == pytest.approx(1.0)
    assert forest.nearest(frame(spark, [])).count() == 0
    few = forest.nearest(frame(spark, [(0, [1.0, 0.0]), (7, [0.0, 2.0]), (8, [3.0, 4.0])])).orderBy("rank").collect()
    assert [(r.vec_id, r.score) for r in few] == [(8, 0.6), (7, 0.0)]


def test_op5_recall_and_scores(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF0001}/embeddings.parquet").select("vec_id", "embedding").collect()]
    got = queries.op5_ann_forest(spark, SF0001).collect()
    assert recall(rows, got, 50, 5) >= 0.9
    by = {i: np.array(v, float) for i, v in rows}
    for r in got:
        a, b = by[r.query_id], by[r.vec_id]
        assert r.score == pytest.approx(float(a @ b / np.sqrt((a @ a) * (b @ b))), abs=1e-12)
