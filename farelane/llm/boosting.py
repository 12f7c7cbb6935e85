"""Gradient-boosted trees for two classes, in numpy."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

BINS = 24


@dataclass
class Forest:
    """Trees of one depth as arrays: the feature and cut of each inner node, and the leaves' values."""

    features: np.ndarray
    cuts: np.ndarray
    leaves: np.ndarray
    start: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Log-odds of each row."""
        out = np.full(len(x), self.start)
        rows = np.arange(len(x))
        for features, cuts, leaves in zip(self.features, self.cuts, self.leaves, strict=True):
            at = np.zeros(len(x), np.int64)
            while at.size and at[0] < len(features):
                at = 2 * at + 1 + (x[rows, features[at]] > cuts[at])
            out += leaves[at - len(features)]
        return out


def boost(x: np.ndarray, y: np.ndarray, trees: int = 30, depth: int = 4, rate: float = 0.3, ridge: float = 1.0) -> Forest:
    """Newton boosting of the logistic loss on binned features."""
    mean = (y.sum() + 0.5) / (len(y) + 1)
    start = float(np.log(mean / (1 - mean)))
    useful = [f for f in range(x.shape[1]) if len(x) and x[:, f].min() < x[:, f].max()]
    flags = np.array([f for f in useful if set(np.unique(x[:, f])) == {0, 1}], np.int64)
    edges = {f: np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in useful if f not in set(flags.tolist())}
    # A row falls right of a cut if its value is greater.
    binned = {f: np.searchsorted(e, x[:, f], side="left") for f, e in edges.items()}
    flagged = x[:, flags].T.astype(np.float32)
    score = np.full(len(y), start)
    inner = 2**depth - 1
    all_features, all_cuts, all_leaves = [], [], []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-score))
        slope, curve = y - p, np.maximum(p * (1 - p), 1e-6)
        features, cuts, leaves = np.zeros(inner, np.int64), np.full(inner, np.inf), np.zeros(2**depth)
        at = np.zeros(len(y), np.int64)
        for level in range(depth):
            base, width = 2**level - 1, 2**level
            local = at - base
            best = np.full(width, 1e-9)
            here = np.zeros((len(y), 2 * width), np.float32)  # slopes and curvatures by tree node
            here[np.arange(len(y)), local], here[np.arange(len(y)), local + width] = slope, curve
            gt, ht = here[:, :width].sum(0, dtype=np.float64), here[:, width:].sum(0, dtype=np.float64)

            def take(gain: np.ndarray, which: np.ndarray, cut: np.ndarray) -> None:
                better = gain > best  # noqa: B023
                best[better] = gain[better]  # noqa: B023
                features[base : base + width][better] = which[better]  # noqa: B023
                cuts[base : base + width][better] = cut[better]  # noqa: B023

            if len(flags):
                right = flagged @ here
                gr, hr = right[:, :width].astype(np.float64), right[:, width:].astype(np.float64)
                gain = gr**2 / (hr + ridge) + (gt - gr) ** 2 / (np.maximum(ht - hr, 0) + ridge) - gt**2 / (ht + ridge)
                k = gain.argmax(0)
                take(gain[k, np.arange(width)], flags[k], np.full(width, 0.5))
            for f, e in edges.items():
                bins = len(e) + 1
                cell = local * bins + binned[f]
                gl = np.cumsum(np.bincount(cell, slope, width * bins).reshape(width, bins), 1)[:, :-1]
                hl = np.cumsum(np.bincount(cell, curve, width * bins).reshape(width, bins), 1)[:, :-1]
                if not len(e):
                    continue
                gain = gl**2 / (hl + ridge) + (gt[:, None] - gl) ** 2 / (np.maximum(ht[:, None] - hl, 0) + ridge) - (gt**2 / (ht + ridge))[:, None]
                k = gain.argmax(1)
                take(gain[np.arange(width), k], np.full(width, f), e[k])
            at = 2 * at + 1 + (x[np.arange(len(y)), features[at]] > cuts[at])
        leaf = at - inner
        g, h = np.bincount(leaf, slope, 2**depth), np.bincount(leaf, curve, 2**depth)
        leaves = rate * g / (h + ridge)
        score = score + leaves[leaf]
        all_features.append(features)
        all_cuts.append(cuts)
        all_leaves.append(leaves)
    return Forest(np.array(all_features), np.array(all_cuts), np.array(all_leaves), start)
