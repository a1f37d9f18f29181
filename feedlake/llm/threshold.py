"""Exact top-k by inner product: Fagin's threshold algorithm.

Within a block of candidates (``blocks``) every dimension has its list of the
candidates sorted by that component. For a query, the lists are read from the
end where the product with the query's component is largest, some rows of all
lists at a time; candidates met for the first time are scored in full. No
unmet candidate can score more than the sum over the dimensions of query
component times the last component read. Reading stops once that bound is below
the k-th best score so far (not at equality: an unmet candidate might tie and
have the smaller id) or the lists end.

Components are ``floor(scale * x)`` and scores exact integers.

Defined results: vectors that are null, empty or hold null or non-finite
components take no part; null ids take no part; exact repeats of a row count
once, and rows of one id never answer that id's queries; ties go to the smaller
id; queries meet candidates of their own length; with fewer than k candidates
all are returned. Scores of 2**53 and more are rounded to a double, and held at
the ends of the long range beyond it.
"""
from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import finite, search

SCALE, K, EVERY = 1024, 10, 100
#: Rows of every list read before the first test of the bound; doubles each time.
FIRST_DEPTH = 16
_EXACT = float(1 << 53)


def threshold_search(ids, vectors, query_ids, queries, k: int):
    """Best ``k`` of each query in one block: (query number, candidate number,
    score), candidates being sorted by id. All numbers are whole doubles; the
    caller makes sure that sums of products are exact."""
    n, dims = vectors.shape
    lists = np.ascontiguousarray(np.argsort(vectors, axis=0, kind="stable").T)   # ascending per dimension
    values = np.sort(vectors, axis=0).T
    out = []
    for q in range(len(queries)):
        query = queries[q]
        up = query > 0
        used = query != 0
        own = np.searchsorted(ids, query_ids[q])
        met = np.zeros(n, bool)
        met[own:own + np.searchsorted(ids[own:], query_ids[q], "right")] = True
        found, scores = np.zeros(0, np.int64), np.zeros(0)
        depth, step = 0, FIRST_DEPTH
        while True:
            to = min(n, depth + step)
            new = np.zeros(n, bool)
            new[lists[up, n - to:n - depth].ravel()] = True
            new[lists[used & ~up, depth:to].ravel()] = True
            if not used.any():
                new[depth:to] = True  # a zero query: all scores are 0, smaller ids first
            fresh = np.flatnonzero(new & ~met)
            met |= new
            found = np.r_[found, fresh]
            scores = np.r_[scores, vectors[fresh] @ query]
            order = np.lexsort((found, -scores))[:k]
            found, scores = found[order], scores[order]
            depth, step = to, 2 * step
            if depth == n:
                break
            last = np.where(up, values[:, n - depth], values[:, depth - 1])
            bound = float(last[used] @ query[used])
            if len(found) == k and (bound < scores[-1] or not used.any()):
                break
        out.append((np.full(len(found), q), found, scores))
    return tuple(np.concatenate(x) for x in zip(*out))


def wide_search(ids, vectors, query_ids, queries, k: int):
    """The same results for components so large that doubles lose digits."""
    rows = [[int(x) for x in v] for v in vectors]
    out = []
    for q, query in enumerate(queries):
        w = [int(x) for x in query]
        scored = sorted((-sum(a * b for a, b in zip(w, v)), i) for i, v in enumerate(rows) if ids[i] != query_ids[q])
        out += [(q, i, float(max(min(-s, 2**63 - 1024), -2**63))) for s, i in scored[:k]]
    return tuple(np.array(x) for x in zip(*out)) if out else (np.zeros(0, np.int64),) * 3


def exact_top_k(embeddings: DataFrame, *, k: int = K, every: int = EVERY, scale: int = SCALE) -> DataFrame:
    """``query_id, rank, vec_id, score`` over rows ``vec_id, embedding``; see the
    module's text. Queries are the rows whose id is divisible by ``every``."""
    rows = (embeddings.select(F.col("vec_id").cast("long").alias("vec_id"),
                              F.col("embedding").cast("array<double>").alias("x")).where(finite(F.col("x"))))

    def whole(x):
        y = x * float(scale)
        # floor() gives a long; beyond 2**53 a double is whole already
        return F.when(F.abs(y) < _EXACT, F.floor(y).cast("double")).otherwise(y)

    rows = rows.select("vec_id", F.transform("x", whole).alias("v"))

    def within(ids, vectors, query_ids, queries):
        most = np.abs(vectors).max() * np.abs(queries).max() * vectors.shape[1]
        run = threshold_search if most < _EXACT else wide_search
        return run(ids, vectors, query_ids, queries, k)

    return search(rows, every, k, within).withColumn("score", F.col("score").cast("decimal(38,0)").cast("long"))
