"""A small ridge logistic regression (Newton steps) for bounded training samples."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Rows taken at once: beside ``x`` no other matrix of its length is held.
BLOCK = 4096


def sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def logit(p):
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p / (1 - p))


def _blocks(x: np.ndarray, y: np.ndarray, rows: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """These rows of ``x`` with a column of ones, and of ``y``, a block at a time."""
    for at in range(0, len(rows), BLOCK):
        part = rows[at:at + BLOCK]
        x1 = np.ones((len(part), x.shape[1] + 1))
        x1[:, :-1] = x[part]
        yield x1, y[part]


def fit(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 25,
        rows: np.ndarray | None = None) -> np.ndarray:
    """Weights of the columns of ``x``, the last being the intercept (not penalised).

    ``rows`` are the numbers of the rows to learn from (default: all).
    """
    rows = np.arange(len(x)) if rows is None else rows
    w = np.zeros(x.shape[1] + 1)
    penalty = np.full(len(w), ridge)
    penalty[-1] = 1e-4
    w[-1] = logit((y[rows].sum() + 0.5) / (len(rows) + 1))

    def loss(w):
        total = 0.0
        for x1, y1 in _blocks(x, y, rows):
            z = np.clip(x1 @ w, -35, 35)
            total += np.log1p(np.exp(z)).sum() - y1 @ z
        return total + 0.5 * (penalty * w * w).sum()

    now = loss(w)
    for _ in range(steps):
        grad, hess = np.zeros(len(w)), np.zeros((len(w), len(w)))
        for x1, y1 in _blocks(x, y, rows):
            p = sigmoid(x1 @ w)
            grad += x1.T @ (y1 - p)
            hess += (x1 * (p * (1 - p))[:, None]).T @ x1
        step = np.linalg.solve(hess + np.diag(penalty), grad - penalty * w)
        while np.abs(step).max() > 1e-7 and (then := loss(w + step)) > now:
            step /= 2  # a full Newton step may overshoot where classes are nearly separate
        if np.abs(step).max() <= 1e-7:
            break
        w, now = w + step, then
    return w


def predict(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return sigmoid(x @ w[:-1] + w[-1])


def out_of_fold(x: np.ndarray, y: np.ndarray, folds: np.ndarray, ridge: float) -> np.ndarray:
    """Prediction of each row by a model that has not seen its fold."""
    out = np.empty(len(y))
    for f in np.unique(folds):
        test = folds == f
        if test.all():
            out[test] = (y.sum() + 0.5) / (len(y) + 1)
        else:
            out[test] = predict(x[test], fit(x, y, ridge, rows=np.flatnonzero(~test)))
    return out
