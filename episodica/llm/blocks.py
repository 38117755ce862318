"""Links within blocks: counts and spanning forests in place of pairs."""

from __future__ import annotations

import numpy as np


class Forest:
    """Union-find over the rows of a task; every root is the smallest id of its tree."""

    def __init__(self, ids: np.ndarray):
        self.ids, self.up = ids, np.arange(len(ids))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> None:
        i, j = self.root(i), self.root(j)
        if i != j:
            if (self.ids[j], j) < (self.ids[i], i):
                i, j = j, i
            self.up[j] = i

    def join_row(self, i: int, others: np.ndarray) -> None:
        """Join row ``i`` with all ``others``, most of which share a root in dense groups."""
        for r in np.unique(self.up[others]):
            self.join(i, int(r))

    def roots(self) -> np.ndarray:
        return self.ids[[self.root(i) for i in range(len(self.ids))]]


def add_links(
    linked: np.ndarray, rows: np.ndarray, columns: np.ndarray, weights: np.ndarray, counts: np.ndarray, forest: Forest
) -> None:
    """Add the links of a matrix (rows x columns, as positions in the task) to the counts and the forest."""
    counts[rows] += linked @ weights[columns]
    counts[columns] += weights[rows] @ linked
    for i in np.flatnonzero(linked.any(axis=1)):
        forest.join_row(int(rows[i]), columns[linked[i]])
