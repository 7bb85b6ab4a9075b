"""Cross products of columns, and the linear fits that need nothing else: ridge, lasso, Bayesian ridge, least-angle path."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F


def gram(df: DataFrame, cols: Sequence[str]) -> tuple[np.ndarray, int]:
    """Cross products of a constant and the columns over complete rows. Every task sums its own rows; the sums of a pair meet in one
    row, and p² / 2 numbers reach the driver."""
    p = len(cols) + 1

    def run(parts):
        total = np.zeros((p, p))
        for part in parts:
            x = np.c_[np.ones(len(part)), part.to_numpy("f8")]
            x = x[~np.isnan(x).any(axis=1)]
            total += x.T @ x
        i, j = np.triu_indices(p)
        yield pd.DataFrame({"i": i.astype("i4"), "j": j.astype("i4"), "v": total[i, j]})

    names = [f"c{k}" for k in range(len(cols))]
    rows = df.select(*[F.col(c).cast("double").alias(a) for c, a in zip(cols, names)])
    sums = rows.mapInPandas(run, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).toPandas()
    g = np.zeros((p, p))
    g[sums["i"], sums["j"]] = g[sums["j"], sums["i"]] = sums["v"]
    return g, int(g[0, 0])


def centred(g: np.ndarray) -> tuple[float, np.ndarray, np.ndarray, np.ndarray, np.ndarray, float]:
    """(n, means of x, mean of y, X'X, X'y, y'y) about the means, from products of (1, x..., y)."""
    n = max(g[0, 0], 1.0)
    mean = g[0, 1:] / n
    c = g[1:, 1:] - n * np.outer(mean, mean)
    return n, mean[:-1], mean[-1], c[:-1, :-1], c[:-1, -1], max(float(c[-1, -1]), 0.0)


def solve_ridge(xx, xy, n, penalty):
    return np.linalg.pinv(xx + penalty * np.eye(len(xy)), hermitian=True) @ xy


def solve_lasso(xx, xy, n, penalty, sweeps: int = 1000):
    """Coordinate descent for |y - Xw|² / 2n + penalty * sum of sd_j |w_j|."""
    w, scale = np.zeros(len(xy)), np.sqrt(np.maximum(np.diag(xx) / n, 0))
    for _ in range(sweeps):
        before = w.copy()
        for j in np.flatnonzero(scale > 0):
            pull = (xy[j] - xx[j] @ w + xx[j, j] * w[j]) / n
            w[j] = np.sign(pull) * max(abs(pull) - penalty * scale[j], 0.0) / (xx[j, j] / n)
        if np.abs((w - before) * scale).max(initial=0) < 1e-10:
            break
    return w


def solve_bayesian(xx, xy, n, yy, rounds: int = 300, tol: float = 1e-3, prior: float = 1e-6):
    """(w, alpha, lambda): evidence iteration on the eigenvalues of X'X; noise precision alpha, weight precision lambda, both with
    flat gamma priors."""
    values, vectors = np.linalg.eigh(xx)
    values, turned = np.maximum(values, 0.0), vectors.T @ xy
    alpha, lam = 1.0 / (yy / n + np.finfo(float).eps), 1.0
    w = np.zeros(len(xy))
    for turn in range(rounds):
        new = vectors @ (turned / (values + lam / alpha))
        rss = max(yy - 2 * new @ xy + new @ xx @ new, 0.0)
        known = float((alpha * values / (lam + alpha * values)).sum())
        lam = (known + 2 * prior) / (new @ new + 2 * prior)
        alpha = (n - known + 2 * prior) / (rss + 2 * prior)
        done, w = turn > 0 and np.abs(new - w).sum() < tol, new
        if done:
            break
    return vectors @ (turned / (values + lam / alpha)), alpha, lam


def lars_path(xx, xy, n, drop: bool = True):
    """[(penalty, weights)] of the least-angle path on columns of unit spread, from the empty fit on. With ``drop`` a weight that
    reaches zero leaves the active set, which makes the path that of the lasso."""
    scale = np.sqrt(np.maximum(np.diag(xx) / n, 0))
    usable = np.flatnonzero(scale > 1e-12)
    a = xx[np.ix_(usable, usable)] / np.outer(scale[usable], scale[usable]) / n
    corr, w = xy[usable] / scale[usable] / n, np.zeros(len(usable))
    full = lambda: np.bincount(usable, w / scale[usable], len(xy)) if len(usable) else np.zeros(len(xy))
    path, active, left = [], [], None
    while True:
        level = np.abs(corr).max(initial=0.0)
        path.append((level, full()))
        if level < 1e-12 or len(path) > 8 * len(usable) + 8:
            return path
        join = [j for j in np.flatnonzero(np.abs(corr) > level * (1 - 1e-9)) if j not in active and j != left]
        active += join[:1] if active else join[:1]
        signs = np.sign(corr[active])
        inner = np.linalg.pinv(a[np.ix_(active, active)], hermitian=True) @ signs
        move = np.zeros(len(usable))
        move[active] = inner
        slope = a @ move  # correlations fall by step * slope; those of the active set stay equal
        step, left = level, None
        for j in set(range(len(usable))) - set(active):
            for gap, rate in ((level - corr[j], 1 - slope[j]), (level + corr[j], 1 + slope[j])):
                if rate > 1e-12 and 1e-14 < gap / rate < step:
                    step = gap / rate
        if drop:
            for j in active:
                if move[j] * w[j] < 0 and -w[j] / move[j] < step:
                    step, left = -w[j] / move[j], j
        w = w + step * move
        corr = corr - step * slope
        if left is not None:
            active.remove(left)
            w[left] = 0.0
