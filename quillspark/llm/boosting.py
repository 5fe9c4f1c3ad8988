"""Gradient-boosted trees for small labelled samples, in numpy.

Logistic loss, trees of fixed depth over quantile bins, Platt scaling of the
sum, and thresholds read off a calibration part. A fitted model is a few
arrays, so tasks carry it in their closure.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np


@dataclass
class Booster:
    """trees: (feature, cut, leaf values) in heap order, each of depth `depth`."""

    depth: int
    prior: float
    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)
    scale: float = 1.0
    shift: float = 0.0

    def raw(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.prior)
        rows = np.arange(len(x))
        for feature, cut, leaf in self.trees:
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > cut[node])
            out += leaf[node - (len(feature))]
        return out

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-(self.scale * self.raw(x) + self.shift)))


def _grow(x, gradient, hessian, cuts, depth, ridge):
    nodes = 2**depth - 1
    feature, cut = np.zeros(nodes, np.int64), np.full(nodes, np.inf)
    at = np.zeros(len(x), np.int64)
    for node in range(nodes):
        mine = np.flatnonzero(at == node)
        best = (1e-9, 0, np.inf)
        if len(mine) >= 10:
            g, h = gradient[mine], hessian[mine]
            total_g, total_h = g.sum(), h.sum()
            base = total_g**2 / (total_h + ridge)
            for j, edges in enumerate(cuts):
                right = x[mine, j][:, None] > edges[None, :]
                rg, rh = g @ right, h @ right
                gain = rg**2 / (rh + ridge) + (total_g - rg) ** 2 / (total_h - rh + ridge) - base
                if len(edges) and gain.max() > best[0]:
                    k = int(gain.argmax())
                    best = (float(gain[k]), j, float(edges[k]))
        feature[node], cut[node] = best[1], best[2]
        at[mine] = 2 * node + 1 + (x[mine, best[1]] > best[2])
    leaf = np.zeros(nodes + 1)
    for k in range(nodes + 1):
        mine = at == nodes + k
        leaf[k] = -gradient[mine].sum() / (hessian[mine].sum() + ridge)
    return feature, cut, leaf


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 40, depth: int = 3, rate: float = 0.3, ridge: float = 1.0, bins: int = 16) -> Booster:
    mean = min(max(float(y.mean()), 1e-3), 1 - 1e-3)
    model = Booster(depth, float(np.log(mean / (1 - mean))))
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[:-1])) for j in range(x.shape[1])]
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-model.raw(x)))
        feature, cut, leaf = _grow(x, p - y, p * (1 - p), cuts, depth, ridge)
        model.trees.append((feature, cut, rate * leaf))
    return model


def calibrate(model: Booster, x: np.ndarray, y: np.ndarray) -> Booster:
    """Platt scaling by Newton steps on rows that the trees have not seen."""
    raw, a, b = model.raw(x), 1.0, 0.0
    soft = np.where(y > 0, (y.sum() + 1) / (y.sum() + 2), 1 / (len(y) - y.sum() + 2))
    for _ in range(30):
        p = 1 / (1 + np.exp(-(a * raw + b)))
        w, r = np.maximum(p * (1 - p), 1e-9), p - soft
        hess = np.array([[(w * raw * raw).sum() + 1e-6, (w * raw).sum()], [(w * raw).sum(), w.sum() + 1e-6]])
        step = np.linalg.solve(hess, np.array([(r * raw).sum(), r.sum()]))
        a, b = a - step[0], b - step[1]
        if abs(step).max() < 1e-6:
            break
    model.scale, model.shift = float(a), float(b)
    return model


def threshold(p: np.ndarray, y: np.ndarray, precision: float) -> float:
    """The lowest probability from which up the labelled rows reach `precision`; 1.1 if none does."""
    order = np.argsort(-p, kind="stable")
    right = np.cumsum(y[order]) / np.arange(1, len(order) + 1)
    ends = np.append(p[order][1:] != p[order][:-1], True) if len(order) else np.empty(0, bool)
    good = np.flatnonzero((right >= precision) & ends)
    return max(0.5, float(p[order][good[-1]])) if len(good) else 1.1
