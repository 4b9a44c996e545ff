"""A tree of balls over points: recursive splits at a few centres each, for exact pruning.

The tree is built from a bounded sample and only says which leaf a point belongs to; radii and
sizes of the leaves are then taken from all points, so bounds drawn from them hold for all.
"""

from __future__ import annotations

import numpy as np

#: Children of a node.
FAN = 8
ROUNDS = 4


def squared(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances by the product form: good for choosing, not for bounds."""
    return (points**2).sum(axis=1)[:, None] + (centres**2).sum(axis=1)[None, :] - 2.0 * (points @ centres.T)


def distances(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Distances by differences, one centre at a time, or one point where those are fewer."""
    out = np.empty((len(points), len(centres)))
    if len(points) < len(centres):
        for i, p in enumerate(points):
            out[i] = np.sqrt(((p - centres) ** 2).sum(axis=1))
        return out
    for i, c in enumerate(centres):
        out[:, i] = np.sqrt(((points - c) ** 2).sum(axis=1))
    return out


class BallTree:
    """``centres`` of the leaves, and for each inner node its children's centres and numbers."""

    def __init__(self, sample: np.ndarray, leaves: int, seed: int):
        self.draw = np.random.default_rng(seed)
        self.nodes: list[tuple[np.ndarray, list[int]] | int] = []
        self.leaf_centres: list[np.ndarray] = []
        self._grow(sample, max(1, leaves))
        self.centres = np.array(self.leaf_centres)
        del self.draw, self.leaf_centres

    def _grow(self, points: np.ndarray, leaves: int) -> int:
        at = len(self.nodes)
        self.nodes.append(-1)
        children = self._split(points, min(FAN, leaves)) if leaves > 1 and len(points) > 1 else []
        if len(children) < 2:
            self.nodes[at] = len(self.leaf_centres)
            self.leaf_centres.append(points.mean(axis=0))
            return at
        numbers = [self._grow(own, max(1, round(leaves * len(own) / len(points)))) for own in children]
        self.nodes[at] = (np.array([own.mean(axis=0) for own in children]), numbers)
        return at

    def _split(self, points: np.ndarray, parts: int) -> list[np.ndarray]:
        centres = points[self.draw.choice(len(points), min(parts, len(points)), replace=False)]
        for _ in range(ROUNDS):
            nearest = squared(points, centres).argmin(axis=1)
            centres = np.array([points[nearest == i].mean(axis=0) for i in np.unique(nearest)])
        nearest = squared(points, centres).argmin(axis=1)
        return [points[nearest == i] for i in np.unique(nearest)]

    def leaves_of(self, points: np.ndarray) -> np.ndarray:
        """The leaf that each point descends to."""
        out = np.zeros(len(points), np.int32)
        todo = [(0, np.arange(len(points)))]
        while todo:
            node, rows = todo.pop()
            if isinstance(self.nodes[node], int):
                out[rows] = self.nodes[node]
                continue
            centres, numbers = self.nodes[node]
            nearest = squared(points[rows], centres).argmin(axis=1)
            todo += [(n, rows[nearest == i]) for i, n in enumerate(numbers) if (nearest == i).any()]
        return out

    def away(self, points: np.ndarray, leaves: np.ndarray) -> np.ndarray:
        return np.sqrt(((points - self.centres[leaves]) ** 2).sum(axis=1))
