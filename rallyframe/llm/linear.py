"""Sparse multinomial logistic regression for small labelled tables, in plain Python on the driver."""

from __future__ import annotations

import math


def softmax(z: list[float]) -> list[float]:
    top = max(z)
    e = [math.exp(x - top) for x in z]
    total = sum(e)
    return [x / total for x in e]


def fit(rows: list[tuple[list[int], int]], classes: int, slots: int, epochs: int = 40, rate: float = 0.3, l2: float = 1e-4) -> tuple[list[list[float]], list[float]]:
    """Weights (classes x slots) and biases from rows (slots of features that are present, class), by stochastic gradient."""
    w, bias = [[0.0] * slots for _ in range(classes)], [0.0] * classes
    for epoch in range(epochs):
        step = rate / (1 + epoch / 4)
        for k in range(len(rows)):
            at, label = rows[(k * 7919 + epoch) % len(rows)]
            x = 1 / math.sqrt(max(1, len(at)))
            p = softmax([b + x * sum(wc[i] for i in at) for wc, b in zip(w, bias)])
            for c in range(classes):
                g = p[c] - (c == label)
                bias[c] -= step * g * 0.1
                wc = w[c]
                for i in at:
                    wc[i] -= step * (g * x + l2 * wc[i])
    return w, bias


def scores(at: list[int], w: list[list[float]], bias: list[float]) -> list[float]:
    x = 1 / math.sqrt(max(1, len(at)))
    return [b + x * sum(wc[i] for i in at) for wc, b in zip(w, bias)]


def calibrate(rows: list[tuple[list[float], int]]) -> float:
    """The temperature between 1/16 and 16 with the least negative log likelihood of (scores, class)."""
    best = (math.inf, 1.0)
    for k in range(-16, 17):
        t = 2 ** (k / 4)
        loss = sum(-math.log(max(softmax([z / t for z in s])[y], 1e-12)) for s, y in rows)
        best = min(best, (loss, t))
    return best[1]
