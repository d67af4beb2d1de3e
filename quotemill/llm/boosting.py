"""Gradient boosted trees on a small table of numbers, and the same trees as a column expression.

Training runs with numpy on the driver over a bounded sample; scoring is an expression of comparisons, computed by Spark.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass
class Leaf:
    value: float


@dataclass
class Split:
    feature: int
    border: float
    low: Leaf | Split
    high: Leaf | Split


@dataclass
class Boosted:
    """Trees on the scale of log odds, and a temperature."""

    base: float
    trees: list = field(default_factory=list)
    temperature: float = 1.0

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        return self.base + sum((_evaluate(t, x) for t in self.trees), np.zeros(len(x)))

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.log_odds(x) / self.temperature))

    def column(self, features: list[Column]) -> Column:
        """The probability as an expression of the features."""

        def tree(node) -> Column:
            if isinstance(node, Leaf):
                return F.lit(float(node.value))
            return F.when(features[node.feature] <= float(node.border), tree(node.low)).otherwise(tree(node.high))

        total = F.lit(float(self.base))
        for t in self.trees:
            total = total + tree(t)
        return 1 / (1 + F.exp(-total / float(self.temperature)))


def _evaluate(node, x: np.ndarray) -> np.ndarray:
    if isinstance(node, Leaf):
        return np.full(len(x), node.value)
    return np.where(x[:, node.feature] <= node.border, _evaluate(node.low, x), _evaluate(node.high, x))


def _grow(x, slope, curve, depth: int, least: float, smooth: float):
    """A tree by the gain of second-order boosting; borders lie between values that occur."""
    total_s, total_c = slope.sum(), curve.sum()
    best = (1e-9, None, None)
    if depth:
        for k in range(x.shape[1]):
            order = np.argsort(x[:, k], kind="stable")
            values, s, c = x[order, k], np.cumsum(slope[order]), np.cumsum(curve[order])
            cut = np.flatnonzero(values[1:] > values[:-1])
            cut = cut[(c[cut] >= least) & (total_c - c[cut] >= least)]
            if len(cut):
                gain = s[cut] ** 2 / (c[cut] + smooth) + (total_s - s[cut]) ** 2 / (total_c - c[cut] + smooth) - total_s**2 / (total_c + smooth)
                at = cut[int(np.argmax(gain))]
                if gain.max() > best[0]:
                    best = (float(gain.max()), k, (values[at] + values[at + 1]) / 2)
    if best[1] is None:
        return Leaf(-total_s / (total_c + smooth))
    low = x[:, best[1]] <= best[2]
    return Split(
        best[1], best[2], _grow(x[low], slope[low], curve[low], depth - 1, least, smooth),
        _grow(x[~low], slope[~low], curve[~low], depth - 1, least, smooth),
    )


def boost(
    x: np.ndarray, y: np.ndarray, kinds: list[str], trees: int = 24, depth: int = 3, rate: float = 0.3, least: float = 0.5,
    smooth: float = 1.0,
) -> Boosted:
    """Train on four of five rows of each kind; the fifth sets the temperature."""
    named = np.array(kinds, object)
    aside = np.zeros(len(y), bool)
    for kind in set(kinds):
        aside[np.flatnonzero(named == kind)[4::5]] = True
    tx, ty = x[~aside], y[~aside].astype(float)
    model = Boosted(float(np.log((ty.sum() + 1) / (len(ty) - ty.sum() + 1))))
    odds = np.full(len(ty), model.base)
    for _ in range(trees if 0 < ty.sum() < len(ty) else 0):
        p = 1 / (1 + np.exp(-odds))
        tree = _scaled(_grow(tx, p - ty, p * (1 - p), depth, least, smooth), rate)
        model.trees.append(tree)
        odds += _evaluate(tree, tx)
    held = aside if aside.any() else ~aside
    logit, truth = model.log_odds(x[held]), y[held].astype(float)
    options = np.exp(np.linspace(np.log(0.5), np.log(4), 31))
    loss = [np.mean(np.logaddexp(0, logit / t) - truth * logit / t) for t in options]
    model.temperature = float(options[int(np.argmin(loss))])
    return model


def _scaled(node, rate: float):
    if isinstance(node, Leaf):
        return Leaf(node.value * rate)
    return Split(node.feature, node.border, _scaled(node.low, rate), _scaled(node.high, rate))


#: The thresholds that are tried.
LEVELS = [float(t) for t in np.arange(0.3, 0.96, 0.05)]


def threshold(counts: dict[int, tuple[int, int]], precision: float = 0.95) -> float:
    """The least level above which the wanted share of rows is right, else the highest one.

    ``counts`` has rows and right rows by the number of levels that their probability reaches.
    """
    for k, level in enumerate(LEVELS):
        n, right = (sum(c[j] for reached, c in counts.items() if reached > k) for j in (0, 1))
        if n and right / n >= precision:
            return level
    return LEVELS[-1]
