"""Links found inside one task, reduced to a forest before they leave it."""

from __future__ import annotations

import numpy as np


def forest(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every node of the links with the smallest node it is connected to through them: as many rows as nodes."""
    nodes, places = np.unique(np.concatenate([left, right]), return_inverse=True)
    a, b = places[: len(left)], places[len(left) :]
    root = np.arange(len(nodes))
    while True:
        lower = np.minimum(root[a], root[b])
        new = root.copy()
        # Roots of both ends hang below the smaller one; then paths are shortened to their ends.
        np.minimum.at(new, root[a], lower)
        np.minimum.at(new, root[b], lower)
        while True:
            shorter = new[new]
            if np.array_equal(shorter, new):
                break
            new = shorter
        if np.array_equal(new, root):
            return nodes, nodes[root]
        root = new
