"""BK-trees over 64-bit fingerprints, many small ones at a time.

A tree's root is its first element; an element goes down the edge whose key is
its Hamming distance to the node it stands at, or becomes that child. A search
with radius r at a node of distance d follows only edges with keys in
``d - r .. d + r``. All trees of a batch are built and searched level by level
with numpy, so that thousands of small trees cost a few array operations.
"""
from __future__ import annotations

import numpy as np

#: (query, node) pairs held at once during a search.
FRONTIER = 1 << 20


def distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b).astype(np.int64)


class Forest:
    """``values`` uint64; ``tree`` the tree number of each value, ascending."""

    def __init__(self, values: np.ndarray, tree: np.ndarray):
        self.values = values
        n = len(values)
        first = np.flatnonzero(np.r_[True, tree[1:] != tree[:-1]]) if n else np.zeros(0, np.int64)
        sizes = np.diff(np.r_[first, n])
        self.root = np.repeat(first, sizes)
        self.size = np.repeat(sizes, sizes)
        parent, child, key = [], [], []
        active = np.flatnonzero(self.root != np.arange(n))
        at = self.root[active]
        while len(active):
            d = distance(values[active], values[at])
            slot, where, inverse = np.unique(at * 65 + d, return_index=True, return_inverse=True)
            parent.append(slot // 65)
            key.append(slot % 65)
            child.append(active[where])
            at = active[where][inverse]
            down = at != active
            active, at = active[down], at[down]
        none = [np.zeros(0, np.int64)]
        parent = np.concatenate(parent or none)
        order = np.argsort(parent, kind="stable")
        self.child = np.concatenate(child or none)[order]
        self.key = np.concatenate(key or none)[order]
        self.first = np.searchsorted(parent[order], np.arange(n + 1))

    def search(self, queries: np.ndarray, roots: np.ndarray, sizes: np.ndarray, radius: int):
        """Yields ``(query number, element)`` arrays of all pairs within the radius."""
        load = np.cumsum(sizes)
        begin = 0
        while begin < len(queries):
            end = max(begin + 1, int(np.searchsorted(load, (load[begin - 1] if begin else 0) + FRONTIER, "right")))
            q, node = np.arange(begin, end), roots[begin:end]
            while len(q):
                d = distance(queries[q], self.values[node])
                near = d <= radius
                if near.any():
                    yield q[near], node[near]
                lo, fan = self.first[node], self.first[node + 1] - self.first[node]
                q, d = np.repeat(q, fan), np.repeat(d, fan)
                edge = np.arange(len(q)) + np.repeat(lo - np.cumsum(fan) + fan, fan)
                follow = np.abs(self.key[edge] - d) <= radius
                q, node = q[follow], self.child[edge[follow]]
            begin = end


def spanning(n: int, links) -> tuple[np.ndarray, np.ndarray]:
    """Of ``links`` (arrays of pairs of elements below n) those that join two
    components when taken one after the other: fewer than n."""
    label = np.arange(n)
    out_a, out_b = [], []
    for a, b in links:
        while True:
            la, lb = label[a], label[b]
            apart = la != lb
            if not apart.any():
                break
            a, b, la, lb = a[apart], b[apart], la[apart], lb[apart]
            high, pick = np.unique(np.maximum(la, lb), return_index=True)
            out_a.append(a[pick])
            out_b.append(b[pick])
            up = np.arange(n)
            up[high] = np.minimum(la, lb)[pick]
            while True:
                further = up[up]
                if (further == up).all():
                    break
                up = further
            label = up[label]
    none = [np.zeros(0, np.int64)]
    return np.concatenate(out_a or none), np.concatenate(out_b or none)
