"""Disjoint sets in one task, with numpy."""

from __future__ import annotations

import numpy as np


class Sets:
    """Disjoint sets over 0..n-1; the smallest member stands for its set."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def find(self, k: int) -> int:
        parent = self.parent
        while parent[k] != k:
            parent[k] = parent[parent[k]]
            k = parent[k]
        return int(k)

    def join(self, a: int, b: int) -> bool:
        """Join two sets; False if they were one already."""
        a, b = self.find(a), self.find(b)
        if a == b:
            return False
        self.parent[max(a, b)] = min(a, b)
        return True

    def join_all(self, a: np.ndarray, b: np.ndarray) -> None:
        """Join many pairs by spreading smallest members until nothing changes."""
        while len(a):
            roots_a, roots_b = self.roots(a), self.roots(b)
            apart = roots_a != roots_b
            a, b = roots_a[apart], roots_b[apart]
            np.minimum.at(self.parent, np.maximum(a, b), np.minimum(a, b))

    def roots(self, k: np.ndarray | None = None) -> np.ndarray:
        """The member that stands for each node's set."""
        while True:
            up = self.parent[self.parent]
            if np.array_equal(up, self.parent):
                break
            self.parent = up
        return self.parent if k is None else self.parent[k]
