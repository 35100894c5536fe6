"""Gradient-boosted trees for several classes, small enough to be fitted on the driver's bounded sample."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Tree:
    """A complete binary tree: at inner node ``i`` rows with ``x[feature[i]] > cut[i]`` go right."""

    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray

    def predict(self, x: np.ndarray) -> np.ndarray:
        inner = len(self.feature)

        def at(node: int):
            if node >= inner:
                return self.value[node - inner]
            if self.cut[node] == np.inf:  # no split: nothing goes right
                return at(2 * node + 1)
            return np.where(x[:, self.feature[node]] > self.cut[node], at(2 * node + 2), at(2 * node + 1))

        return np.broadcast_to(at(0), len(x))


def _fit_tree(binned, edges, grad, hess, depth, bins, ridge=1.0) -> tuple[Tree, np.ndarray]:
    n, m = binned.shape
    inner = 2**depth - 1
    feature, cut = np.zeros(inner, dtype=np.int64), np.full(inner, np.inf)
    node = np.zeros(n, dtype=np.int64)
    for level in range(depth):
        first, width = 2**level - 1, 2**level
        local = node - first
        best_gain, best = np.full(width, 1e-9), np.full((width, 2), -1)
        for j in range(m):
            at = local * bins + binned[:, j]
            g = np.bincount(at, grad, width * bins).reshape(width, bins).cumsum(axis=1)
            h = np.bincount(at, hess, width * bins).reshape(width, bins).cumsum(axis=1)
            gt, ht = g[:, -1:], h[:, -1:]
            gain = g**2 / (h + ridge) + (gt - g) ** 2 / (ht - h + ridge) - gt**2 / (ht + ridge)
            gain[(h < 2) | (ht - h < 2)] = 0
            k = gain.argmax(axis=1)
            top = gain[np.arange(width), k]
            better = top > best_gain
            best_gain[better] = top[better]
            best[better, 0], best[better, 1] = j, k[better]
        split = np.full(n, bins)
        which = np.zeros(n, dtype=np.int64)
        for w in range(width):
            if best[w, 0] >= 0:
                feature[first + w] = best[w, 0]
                cut[first + w] = edges[best[w, 0]][best[w, 1]] if best[w, 1] < len(edges[best[w, 0]]) else np.inf
                own = local == w
                which[own], split[own] = best[w, 0], best[w, 1]
        node = 2 * node + 1 + (binned[np.arange(n), which] > split)
    leaf = node - inner
    g = np.bincount(leaf, grad, inner + 1)
    h = np.bincount(leaf, hess, inner + 1)
    value = -g / (h + ridge)
    return Tree(feature, cut, value), leaf


@dataclass
class Boosted:
    """Softmax over the summed trees of each class, divided by a temperature."""

    trees: list[list[Tree]]
    rate: float
    temperature: float = 1.0

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, classes: int, rounds: int = 40, depth: int = 3, rate: float = 0.3, bins: int = 32):
        edges = []
        binned = np.empty(x.shape, dtype=np.int64)
        for j in range(x.shape[1]):
            distinct = np.unique(x[:, j])
            if len(distinct) > bins:
                distinct = np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins)))
            edges.append((distinct[1:] + distinct[:-1]) / 2)
            binned[:, j] = np.searchsorted(edges[-1], x[:, j], side="left")
        share = np.bincount(y, minlength=classes) / len(y)
        weight = (1 / np.maximum(share, 1e-9) / classes)[y] ** 0.5
        hot = np.eye(classes)[y]
        score = np.zeros((len(x), classes))
        out = cls([[] for _ in range(classes)], rate)
        for _ in range(rounds):
            p = _softmax(score)
            for k in range(classes):
                tree, leaf = _fit_tree(
                    binned, edges, (p[:, k] - hot[:, k]) * weight, np.maximum(p[:, k] * (1 - p[:, k]), 1e-4) * weight, depth, bins + 1
                )
                out.trees[k].append(tree)
                score[:, k] += rate * tree.value[leaf]
        return out

    def scores(self, x: np.ndarray) -> np.ndarray:
        x = np.asfortranarray(x)  # trees look at columns
        return np.stack([self.rate * sum(t.predict(x) for t in own) for own in self.trees], axis=1)

    def calibrate(self, x: np.ndarray, y: np.ndarray) -> "Boosted":
        """Choose the temperature with the least log loss on a holdout."""
        score = self.scores(x)

        def loss(t):
            return -np.log(np.maximum(_softmax(score / t)[np.arange(len(y)), y], 1e-12)).mean()

        self.temperature = float(min(np.geomspace(0.25, 8, 41), key=loss))
        return self

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return _softmax(self.scores(x) / self.temperature)


def _softmax(score: np.ndarray) -> np.ndarray:
    e = np.exp(score - score.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)
