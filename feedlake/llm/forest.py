"""Approximate nearest neighbours by cosine: a forest of random-projection trees.

Every block of candidates (``blocks``) carries its own forest, built over all of
the block's rows: a node splits its rows by the hyperplane half-way between two
random rows (by angle), or at the median of a random direction where that leaves
one side nearly empty; leaves hold up to ``LEAF`` rows. A query's search walks
all trees of the forest through one shared priority queue, keyed by the smallest
margin to a hyperplane on the way: the most promising branch of any tree comes
next, until leaves with ``SEARCH`` different candidates (or all) are met. Those
are reranked by exact cosine.

Defined results: vectors that are null, empty, zero or hold null or non-finite
components take no part; null ids take no part; exact repeats of a row count
once, and rows of one id never answer that id's queries; ties go to the smaller
id; queries meet candidates of their own length; with fewer than k candidates
all are returned. Equal vectors are one candidate with the ids that matter, so a
large group of copies neither fills leaves nor hides a smaller id.
"""
from __future__ import annotations

import heapq

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import finite, search

K, EVERY = 5, 50
TREES, LEAF, SEARCH, SEED = 16, 32, 2200, 11


def unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


class Forest:
    """Nodes of all trees in one list: ``children[i]`` is (left, right), or None
    for a leaf with ``rows[i]``; ``normals[i]`` is a node's hyperplane, ``offsets[i]`` its shift."""

    def __init__(self, vectors: np.ndarray, trees: int = TREES, leaf: int = LEAF, seed: int = SEED):
        self.units = unit(vectors)
        self.children, self.rows, self.normals, self.offsets = [], [], [], []
        rng = np.random.default_rng(seed)
        self.roots = [self._grow(np.arange(len(vectors)), leaf, rng) for _ in range(trees)]
        self.normals, self.offsets = np.array(self.normals), np.array(self.offsets)

    def _node(self, dims: int) -> int:
        self.children.append(None)
        self.rows.append(None)
        self.normals.append(np.zeros(dims))
        self.offsets.append(0.0)
        return len(self.children) - 1

    def _grow(self, rows: np.ndarray, leaf: int, rng) -> int:
        root = self._node(self.units.shape[1])
        todo = [(root, rows)]
        while todo:
            node, rows = todo.pop()
            if len(rows) <= leaf:
                self.rows[node] = rows
                continue
            a, b = rng.choice(len(rows), 2, replace=False)
            normal, shift = self.units[rows[a]] - self.units[rows[b]], 0.0
            margin = self.units[rows] @ normal
            right = margin > 0
            if not 0.1 < right.mean() < 0.9:
                normal = rng.normal(size=self.units.shape[1])
                margin = self.units[rows] @ normal
                order = np.argsort(margin, kind="stable")
                right = np.zeros(len(rows), bool)
                right[order[len(rows) // 2:]] = True
                shift = -float(margin[order[len(rows) // 2]])
            length = np.linalg.norm(normal)
            self.normals[node], self.offsets[node] = normal / length, shift / length
            sides = self._node(len(normal)), self._node(len(normal))
            self.children[node] = sides
            todo += [(sides[0], rows[~right]), (sides[1], rows[right])]
        return root

    def candidates(self, margins: list, least: int) -> np.ndarray:
        """Rows of the leaves met until ``least`` different ones are found;
        ``margins`` holds the query's signed distance to each node's hyperplane."""
        queue = [(-np.inf, r) for r in self.roots]
        heapq.heapify(queue)
        met: set = set()
        while queue and len(met) < least:
            minus, node = heapq.heappop(queue)
            sides = self.children[node]
            if sides is None:
                met.update(self.rows[node].tolist())
            else:
                m = margins[node]
                heapq.heappush(queue, (max(minus, m), sides[0]))
                heapq.heappush(queue, (max(minus, -m), sides[1]))
        return np.fromiter(sorted(met), np.int64, len(met))


def forest_search(ids, vectors, query_ids, queries, k: int, least: int, trees: int, leaf: int):
    """Best ``k`` of each query in one block, candidates being sorted by id."""
    vectors, queries = scaled(vectors), scaled(queries)
    forest = Forest(vectors, trees, leaf)
    norms, qnorms = np.linalg.norm(vectors, axis=1), np.linalg.norm(queries, axis=1)
    margins = unit(queries) @ forest.normals.T + forest.offsets
    out = []
    for q in range(len(queries)):
        near = forest.candidates(margins[q].tolist(), least)
        near = near[ids[near] != query_ids[q]]
        score = np.einsum("ij,j->i", vectors[near], queries[q]) / (norms[near] * qnorms[q])
        best = np.argsort(-score, kind="stable")[:k]
        out.append((np.full(len(best), q), near[best], score[best]))
    return tuple(np.concatenate(x) for x in zip(*out))


def scaled(vectors: np.ndarray) -> np.ndarray:
    """Each vector times a power of two that brings its largest component near
    1: exact, and squares neither overflow nor vanish."""
    return np.ldexp(vectors, -np.frexp(np.abs(vectors).max(axis=1, keepdims=True))[1])


def nearest(embeddings: DataFrame, *, k: int = K, every: int = EVERY, least: int = SEARCH, trees: int = TREES,
            leaf: int = LEAF) -> DataFrame:
    """``query_id, rank, vec_id, score`` over rows ``vec_id, embedding``; see the
    module's text. Queries are the rows whose id is divisible by ``every``."""
    rows = (embeddings.select(F.col("vec_id").cast("long").alias("vec_id"),
                              F.col("embedding").cast("array<double>").alias("v"))
            .where(finite(F.col("v"))).where(F.exists("v", lambda x: x != 0)))

    def within(ids, vectors, query_ids, queries):
        return forest_search(ids, vectors, query_ids, queries, k, least, trees, leaf)

    return search(rows, every, k, within)
