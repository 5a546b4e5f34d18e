"""Gradient-boosted trees for two classes on binned features."""

from __future__ import annotations

import numpy as np

BINS, DEPTH, TREES, RATE, RIDGE, LEAST = 32, 4, 50, 0.25, 1.0, 8


def cuts_of(x: np.ndarray) -> np.ndarray:
    """(features, BINS - 1) thresholds: quantiles of what values there are."""
    q = np.linspace(0, 1, BINS + 1)[1:-1]
    return np.stack([np.quantile(np.unique(c), q, method="lower") for c in x.T])


def binned(x: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    return np.stack([np.searchsorted(c, v, side="left") for c, v in zip(cuts, x.T)], 1)


def fit(x: np.ndarray, y: np.ndarray) -> dict:
    """Trees as arrays: at each inner place a feature and threshold (values up to it go left), at each leaf a value."""
    cuts = cuts_of(x)
    b = binned(x, cuts)
    n, features = b.shape
    score = np.zeros(n)
    inner, leaves = 2**DEPTH - 1, 2**DEPTH
    model = {"feature": [], "threshold": [], "leaf": [], "rate": RATE}
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-score))
        g, h = y - p, p * (1 - p)
        place = np.zeros(n, np.int64)
        feature, threshold = np.zeros(inner, int), np.full(inner, np.inf)
        for level in range(DEPTH):
            width = 2**level
            best, choice = np.full(width, 1e-6), np.full((width, 2), -1)
            for f in range(features):
                at = place * BINS + b[:, f]
                sums = [np.bincount(at, w, width * BINS).reshape(width, BINS).cumsum(1) for w in (g, h, np.ones(n))]
                (gl, hl, nl), (ga, ha, na) = (s[:, :-1] for s in sums), (s[:, -1:] for s in sums)
                gain = gl**2 / (hl + RIDGE) + (ga - gl) ** 2 / (ha - hl + RIDGE) - ga**2 / (ha + RIDGE)
                gain[(nl < LEAST) | (na - nl < LEAST)] = -1
                k = gain.argmax(1)
                top = gain[np.arange(width), k]
                better = top > best
                best[better] = top[better]
                choice[better, 0], choice[better, 1] = f, k[better]
            for i, (f, k) in enumerate(choice):
                if f >= 0:
                    feature[width - 1 + i], threshold[width - 1 + i] = f, cuts[f][k]
            at = width - 1 + place
            place = place * 2 + (x[np.arange(n), feature[at]] > threshold[at])
        sums = [np.bincount(place, w, leaves) for w in (g, h)]
        leaf = sums[0] / (sums[1] + RIDGE)
        score += RATE * leaf[place]
        for name, v in (("feature", feature), ("threshold", threshold), ("leaf", leaf)):
            model[name].append(v.tolist())
    return model


def predict(model: dict, x: np.ndarray) -> np.ndarray:
    """Probability of the class 1."""
    score = np.zeros(len(x))
    rows = np.arange(len(x))
    for feature, threshold, leaf in zip(model["feature"], model["threshold"], model["leaf"]):
        feature, threshold, leaf = np.asarray(feature), np.asarray(threshold), np.asarray(leaf)
        place = np.zeros(len(x), np.int64)
        for level in range(DEPTH):
            at = 2**level - 1 + place
            place = place * 2 + (x[rows, feature[at]] > threshold[at])
        score += model["rate"] * leaf[place]
    return 1 / (1 + np.exp(-score))
