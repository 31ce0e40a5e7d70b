"""Gradient-boosted trees and isotonic calibration, small enough to be trained where they are used."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

#: Levels that a feature is cut into.
BINS = 32


@dataclass
class Tree:
    """A full binary tree of fixed depth in arrays: feature, threshold per inner node, value per leaf."""

    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray

    def predict(self, x: np.ndarray) -> np.ndarray:
        node = np.zeros(len(x), np.int64)
        rows, inner = np.arange(len(x)), len(self.feature)
        while len(x) and node[0] < inner:
            node = 2 * node + 1 + (x[rows, self.feature[node]] > self.threshold[node])
        return self.value[node - inner]


@dataclass
class Boosted:
    """Logistic gradient boosting; ``levels``/``calibrated`` map raw scores to probabilities."""

    base: float = 0.0
    rate: float = 0.15
    trees: list[Tree] = field(default_factory=list)
    levels: np.ndarray = field(default_factory=lambda: np.zeros(0))
    calibrated: np.ndarray = field(default_factory=lambda: np.zeros(0))

    def raw(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        for t in self.trees:
            out += self.rate * t.predict(x)
        return out

    def probability(self, x: np.ndarray) -> np.ndarray:
        raw = self.raw(x)
        if not len(self.levels):
            return 1 / (1 + np.exp(-raw))
        return np.interp(raw, self.levels, self.calibrated)

    def to_plain(self) -> dict:
        """The model as numbers and lists, rounded to what does not change a result; NULL is an endless threshold."""
        trees = [
            [t.feature.tolist(), [round(float(v), 5) if np.isfinite(v) else None for v in t.threshold], [round(float(v), 5) for v in t.value]] for t in self.trees
        ]
        return {
            "base": round(self.base, 6), "rate": self.rate, "trees": trees,
            "levels": [round(float(v), 5) for v in self.levels], "calibrated": [round(float(v), 5) for v in self.calibrated],
        }

    @classmethod
    def from_plain(cls, m: dict) -> Boosted:
        trees = [Tree(np.array(f, np.int64), np.array([np.inf if v is None else v for v in t]), np.array(v, float)) for f, t, v in m["trees"]]
        return cls(m["base"], m["rate"], trees, np.array(m["levels"], float), np.array(m["calibrated"], float))


def _cuts(x: np.ndarray) -> list[np.ndarray]:
    """Thresholds of each feature, at most BINS - 1."""
    out = []
    for f in range(x.shape[1]):
        values = np.unique(x[:, f]).astype(float)
        mids = (values[1:] + values[:-1]) / 2
        out.append(mids if len(mids) < BINS else np.unique(np.quantile(mids, np.linspace(0, 1, BINS - 1))))
    return out


def _grow(bins: np.ndarray, cuts: list[np.ndarray], use: np.ndarray, grad: np.ndarray, hess: np.ndarray, depth: int, least: float) -> tuple[Tree, np.ndarray]:
    """(tree, leaf of each row): level by level over histograms of the features in ``use``."""
    inner = 2**depth - 1
    tree = Tree(np.zeros(inner, np.int64), np.full(inner, np.inf), np.zeros(2**depth))
    at = np.zeros(len(bins), np.int64)
    width = len(use) * BINS
    offset = np.arange(len(use)) * BINS
    chosen = bins[:, use] + offset
    for level in range(depth):
        first, nodes = 2**level - 1, 2**level
        cell = (chosen + ((at - first) * width)[:, None]).ravel()
        g = np.bincount(cell, np.repeat(grad, len(use)), nodes * width).reshape(nodes, len(use), BINS)
        h = np.bincount(cell, np.repeat(hess, len(use)), nodes * width).reshape(nodes, len(use), BINS)
        gl, hl = g.cumsum(2), h.cumsum(2)
        gt, ht = gl[:, :, -1:], hl[:, :, -1:]
        gain = gl**2 / (hl + 1) + (gt - gl) ** 2 / (ht - hl + 1) - gt**2 / (ht + 1)
        gain = np.where((hl >= least) & (ht - hl >= least), gain, -1.0).reshape(nodes, -1)
        best = gain.argmax(1)
        for n in range(nodes):
            if gain[n, best[n]] > 1e-9:
                f, b = use[best[n] // BINS], best[n] % BINS
                tree.feature[first + n], tree.threshold[first + n] = f, cuts[f][b] if b < len(cuts[f]) else np.inf
        node_f = tree.feature[at]
        edge = np.array([np.searchsorted(cuts[f], t, side="left") if np.isfinite(t) else BINS for f, t in zip(tree.feature[first : first + nodes], tree.threshold[first : first + nodes])])
        at = 2 * at + 1 + (bins[np.arange(len(bins)), node_f] > edge[at - first])
    leaf = at - inner
    tree.value = -np.bincount(leaf, grad, 2**depth) / (np.bincount(leaf, hess, 2**depth) + 1.0)
    return tree, leaf


def _fit(x: np.ndarray, y: np.ndarray, rounds: int, depth: int, share: float, seed: int) -> Boosted:
    rng = np.random.default_rng(seed)
    rate = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    model = Boosted(base=float(np.log(rate / (1 - rate))))
    cuts = _cuts(x)
    bins = np.stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)], axis=1)
    able = np.array([f for f, c in enumerate(cuts) if len(c)])
    raw = np.full(len(x), model.base)
    for _ in range(rounds if len(able) else 0):
        p = 1 / (1 + np.exp(-raw))
        use = np.sort(rng.choice(able, max(1, int(np.ceil(share * len(able)))), replace=False))
        tree, leaf = _grow(bins, cuts, use, p - y, p * (1 - p), depth, 1.0)
        model.trees.append(tree)
        raw += model.rate * tree.value[leaf]
    return model


def isotonic(score: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(levels, values) of the least-squares non-decreasing fit, by pooling adjacent violators."""
    order = np.argsort(score, kind="stable")
    blocks: list[list[float]] = []
    for s, v in zip(score[order], y[order]):
        blocks.append([float(s), float(v), 1.0])
        while len(blocks) > 1 and blocks[-2][1] >= blocks[-1][1]:
            s2, v2, n2 = blocks.pop()
            s1, v1, n1 = blocks[-1]
            blocks[-1] = [s2, (v1 * n1 + v2 * n2) / (n1 + n2), n1 + n2]
    # A pinch of both classes keeps calibrated values off 0 and 1.
    return np.array([b[0] for b in blocks]), np.array([(b[1] * b[2] + 0.05) / (b[2] + 0.1) for b in blocks])


def fit(x: np.ndarray, y: np.ndarray, groups: np.ndarray, rounds: int = 120, depth: int = 4, folds: int = 3, share: float = 0.3) -> Boosted:
    """Trees on all rows, each of a ``share`` of the features, calibrated by scores of groups that each fold's trees have not seen."""
    fold = groups % folds
    held = np.zeros(len(x))
    for k in range(folds):
        held[fold == k] = _fit(x[fold != k], y[fold != k], rounds, depth, share, k).raw(x[fold == k])
    model = _fit(x, y, rounds, depth, share, folds)
    model.levels, model.calibrated = isotonic(held, y)
    return model
