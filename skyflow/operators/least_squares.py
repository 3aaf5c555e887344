"""Bounded Levenberg-Marquardt steps for many light curves at once, and a likelihood search for the random walk."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

from skyflow.operators.feature_kernel import Segments

#: Parameters (one column each, a value for every row) to the model's value at every row.
Model = Callable[[list[np.ndarray]], np.ndarray]
ROUNDS = 60


def fit_bounded(model: Model, start: np.ndarray, low: np.ndarray, high: np.ndarray, s: Segments, y: np.ndarray, w: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Parameters (curves x parameters) and chi2 of the weighted fit of ``y`` in each run of ``s``.

    All curves step together, each with its own damping; a step is projected onto the bounds and taken only where it
    lowers the curve's chi2, so no result is worse than its start. Derivatives are differences.
    """

    def rows(p: np.ndarray) -> list[np.ndarray]:
        return [p[s.of, k] for k in range(p.shape[1])]

    def chi_of(f: np.ndarray) -> np.ndarray:
        chi = s.sum(w * (y - f) ** 2)
        return np.where(np.isfinite(chi), chi, np.inf)

    low, high = np.minimum(low, start), np.maximum(high, start)
    p, n_par = start.astype(float), start.shape[1]
    f = model(rows(p))
    chi, damping = chi_of(f), np.full(len(p), 1e-2)
    moving = np.isfinite(chi)
    for _ in range(rounds):
        slopes = []
        for k in range(n_par):
            h = 1e-6 * np.maximum(np.abs(p[:, k]), 1e-2)
            h = np.where(p[:, k] + h > high[:, k], -h, h)
            moved = p.copy()
            moved[:, k] += h
            slopes.append((model(rows(moved)) - f) / h[s.of])
        rest = y - f
        a, g = np.empty((len(p), n_par, n_par)), np.empty((len(p), n_par))
        for i in range(n_par):
            g[:, i] = s.sum(w * slopes[i] * rest)
            for j in range(i + 1):
                a[:, i, j] = a[:, j, i] = s.sum(w * slopes[i] * slopes[j])
        fit = moving & np.isfinite(a).all(axis=(1, 2)) & np.isfinite(g).all(axis=1)
        scale = np.maximum(np.diagonal(a, axis1=1, axis2=2), 1e-12)
        system = np.where(fit[:, None, None], a + (damping[:, None] * scale)[:, :, None] * np.eye(n_par), np.eye(n_par))
        step = np.linalg.solve(system, np.where(fit[:, None], g, 0.0)[:, :, None])[:, :, 0]
        tried = np.clip(p + step, low, high)
        f_tried = model(rows(tried))
        chi_tried = chi_of(f_tried)
        better = fit & (chi_tried < chi)
        gain = np.where(better, chi - np.where(better, chi_tried, 0), 0.0)
        p, chi = np.where(better[:, None], tried, p), np.where(better, chi_tried, chi)
        f = np.where(better[s.of], f_tried, f)
        damping = np.where(better, np.maximum(damping / 5, 1e-12), damping * 4)
        moving = fit & ~(better & (gain <= 1e-9 * chi)) & (damping < 1e8)
        if not moving.any():
            break
    return p, chi


def walk_costs(t: np.ndarray, x: np.ndarray, e: np.ndarray, starts: np.ndarray, n: np.ndarray, sigma: np.ndarray, tau: np.ndarray) -> np.ndarray:
    """Negative log likelihood of a damped random walk for each curve (rows) and its (sigma, tau): a Kalman filter over the
    points in time, a point of all curves at once."""
    order = np.argsort(-n, kind="stable")  # the curves that still go on come first
    sigma, tau, starts, n = sigma[order], tau[order], starts[order], n[order]
    var = sigma**2
    mean, p, cost = np.zeros(sigma.shape), var.copy(), np.zeros(sigma.shape)
    for i in range(int(n[0]) if len(n) else 0):
        k = int(np.searchsorted(-n, -i, side="left"))
        at = starts[:k] + i
        if i:
            a = np.exp(-(t[at] - t[at - 1])[:, None] / tau[:k])
            mean[:k], p[:k] = a * mean[:k], a * a * p[:k] + var[:k] * (1 - a * a)
        q = np.maximum(p[:k] + e[at][:, None] ** 2, 1e-12)
        r, gain = x[at][:, None] - mean[:k], p[:k] / q
        cost[:k] += 0.5 * (np.log(q) + r * r / q)
        mean[:k], p[:k] = mean[:k] + gain * r, p[:k] * (1 - gain)
    out = np.empty_like(cost)
    out[order] = cost
    return out


def walk_cost(t: np.ndarray, x: np.ndarray, e: np.ndarray, sigma: np.ndarray, tau: np.ndarray) -> np.ndarray:
    """``walk_costs`` of one curve."""
    return walk_costs(t, x, e, np.zeros(1, int), np.array([len(t)]), sigma[None, :], tau[None, :])[0]


#: Curves x (sigma, tau) whose states are held at once.
WALK_CELLS = 1 << 16


def fit_walks(t: np.ndarray, x: np.ndarray, e: np.ndarray, s: Segments, sigmas: np.ndarray, taus: np.ndarray, zooms: int = 12) -> np.ndarray:
    """(sigma, tau, cost) of each curve: the best point of the grid, then of ever finer grids of 5 x 5 around it in logarithms."""
    grid = np.stack([v.ravel() for v in np.meshgrid(np.log(sigmas), np.log(taus), indexing="ij")])
    off = np.stack([v.ravel() for v in np.meshgrid(np.linspace(-1, 1, 5), np.linspace(-1, 1, 5), indexing="ij")])
    reach = np.array([float(np.diff(np.log(np.sort(v))).max()) if len(v) > 1 else 0.5 for v in (sigmas, taus)])
    out, step = np.empty((len(s.n), 3)), max(1, WALK_CELLS // max(grid.shape[1], 25))
    for a in range(0, len(s.n), step):
        starts, n = s.starts[a : a + step], s.n[a : a + step]
        rows = np.arange(len(n))
        tried = np.repeat(grid[:, None, :], len(n), axis=1)  # of sigma and tau, curves x points
        best, at = np.full(len(n), np.inf), tried[:, :, 0]
        for zoom in range(zooms + 1):
            if zoom:
                tried = at[:, :, None] + (reach * 0.6 ** (zoom - 1))[:, None, None] * off[:, None, :]
            cost = walk_costs(t, x, e, starts, n, np.exp(tried[0]), np.exp(tried[1]))
            k = np.argmin(cost, axis=1)
            better = cost[rows, k] < best if zoom else np.ones(len(n), bool)
            best, at = np.where(better, cost[rows, k], best), np.where(better, tried[:, rows, k], at)
        out[a : a + step] = np.column_stack([np.exp(at[0]), np.exp(at[1]), best])
    return out
