"""Numpy kernels of the period search: matrices of points x frequencies."""

from __future__ import annotations

import math

import numpy as np


def turns(t: np.ndarray, freqs: np.ndarray) -> np.ndarray:
    """exp(2 pi i t f) for all points and frequencies.

    Even steps go by recurrence: the first of every row of about sqrt(K) frequencies and the steps within a row
    are computed, all others are products of the two.
    """
    k = len(freqs)
    step = (freqs[-1] - freqs[0]) / (k - 1) if k > 1 else 0.0
    if k < 8 or np.abs(np.diff(freqs) - step).max() > 1e-9 * abs(step):
        return np.exp(2j * np.pi * np.mod(np.outer(t, freqs), 1.0))
    side = math.isqrt(k - 1) + 1
    rows = freqs[0] + step * side * np.arange(-(-k // side))
    first = np.exp(2j * np.pi * np.mod(np.outer(t, rows), 1.0))
    inner = np.exp(2j * np.pi * np.mod(np.outer(t, step * np.arange(side)), 1.0))
    return (first[:, :, None] * inner[:, None, :]).reshape(len(t), len(rows) * side)[:, :k]


def _weighed(weights: np.ndarray, waves: np.ndarray) -> np.ndarray:
    """Real weights (rows x points) times complex waves (points x frequencies)."""
    flat = np.ascontiguousarray(waves).view(np.float64)
    return (weights @ flat).view(np.complex128)


def band_waves(t: np.ndarray, ends: np.ndarray, freqs: np.ndarray, asked: list[tuple[np.ndarray, int]]) -> list[np.ndarray]:
    """For each (weights, h) the sums of weights * exp(2 pi i h t f) over every band's points, bands x frequencies; a band's
    points lie together and end before ``ends``.

    On even steps a wave is the product of one for its row of about sqrt(K) frequencies and one for its place in the row,
    so a band's sums are one matrix product, rows x points x places.
    """
    k = len(freqs)
    step = (freqs[-1] - freqs[0]) / (k - 1) if k > 1 else 0.0
    if k < 8 or np.abs(np.diff(freqs) - step).max() > 1e-9 * abs(step):
        side, rows = k, np.zeros(1)
        places = freqs
    else:
        side = math.isqrt(k - 1) + 1
        rows, places = freqs[0] + step * side * np.arange(-(-k // side)), step * np.arange(side)
    first, inner = (np.exp(2j * np.pi * np.mod(np.outer(t, x), 1.0)) for x in (rows, places))
    out, powers = [], {1: (first, inner)}
    for weights, h in asked:
        if h not in powers:
            powers[h] = (powers[h - 1][0] * first, powers[h - 1][1] * inner)
        left, right = powers[h]
        left = left * weights[:, None]
        sums, a = np.zeros((len(ends), len(rows) * side), complex), 0
        for band, b in enumerate(ends):
            if b > a:
                sums[band] = (left[a:b].T @ right[a:b]).ravel()
            a = b
        out.append(sums[:, :k])
    return out


def band_harmonics(t: np.ndarray, m: np.ndarray, e: np.ndarray, codes: np.ndarray, bands: int, freqs: np.ndarray, harmonics: int) -> dict[str, np.ndarray]:
    """For each band the sum of squares that ``harmonics`` explain at each frequency (``power``, bands x frequencies), and
    its ``wvar``, ``d2`` and number of points ``n``.

    Products of two sines or cosines are sines or cosines of sums and differences, so all normal equations come from
    weighted sums of the waves up to twice the order (``band_waves``).
    """
    good = np.flatnonzero(e > 0)
    good = good[np.argsort(codes[good], kind="stable")]
    t, m, e, codes = t[good], m[good], e[good], codes[good]
    w = e**-2.0
    n, sw = np.bincount(codes, minlength=bands), np.bincount(codes, w, bands)
    ends = np.cumsum(n)
    start = np.zeros(bands)
    start[n > 0] = m[(ends - n)[n > 0]]
    shifted = m - start[codes]
    mean = np.where(n > 0, np.bincount(codes, w * shifted, bands) / np.where(n > 0, sw, 1), 0.0)
    y = shifted - mean[codes]
    wvar = np.bincount(codes, w * y * y, bands)
    order = 2 * harmonics
    waves = band_waves(t, ends, freqs, [x for h in range(1, order + 1) for x in ((w, h), (w * y, h))[: 1 + (h <= harmonics)]])
    sums, ys = [np.repeat(sw[:, None], len(freqs), axis=1).astype(complex)], [None]
    for h in range(1, order + 1):
        sums.append(waves.pop(0))
        if h <= harmonics:
            ys.append(waves.pop(0))

    def product(i: int, j: int) -> np.ndarray:
        """Weighted sum of basis function i times j, i >= j; even numbers are cosines, odd ones sines."""
        h, g = i // 2 + 1, j // 2 + 1
        plus, minus = sums[h + g], sums[h - g]
        if i % 2 == j % 2:
            return (minus.real - plus.real) / 2 if i % 2 else (minus.real + plus.real) / 2
        return (plus.imag + minus.imag) / 2 if i % 2 else (plus.imag - minus.imag) / 2

    alone = [(sums[i // 2 + 1].imag if i % 2 else sums[i // 2 + 1].real) for i in range(order)]
    with_y = [(ys[i // 2 + 1].imag if i % 2 else ys[i // 2 + 1].real) for i in range(order)]
    weight = np.where(sw > 0, sw, 1)[:, None]
    tiny = 3e-5 * np.sqrt(sw)[:, None]  # below it a pivot is rounding: the points do not tell that term from the others
    factor: list[list[np.ndarray]] = []
    solved: list[np.ndarray] = []
    for i in range(order):
        row: list[np.ndarray] = []
        for j in range(i):
            x = product(i, j) - alone[i] * alone[j] / weight
            for q in range(j):
                x = x - row[q] * factor[j][q]
            usable = factor[j][j] > tiny
            row.append(np.where(usable, x / np.where(usable, factor[j][j], 1), 0.0))
        diagonal, rest = product(i, i) - alone[i] * alone[i] / weight, with_y[i]
        for q in range(i):
            diagonal, rest = diagonal - row[q] * row[q], rest - row[q] * solved[q]
        row.append(np.sqrt(np.maximum(diagonal, 0.0)))
        factor.append(row)
        usable = row[i] > tiny
        solved.append(np.where(usable, rest / np.where(usable, row[i], 1), 0.0))
    return {"power": sum(z * z for z in solved), "wvar": wvar, "d2": np.maximum(n - order - 1, 0).astype(float), "n": n}


def _phases(t: np.ndarray, freqs: np.ndarray) -> np.ndarray:
    """Phases of all frequencies (rows) and points."""
    return np.mod(np.outer(freqs, t), 1.0)


def bin_sums(t: np.ndarray, freqs: np.ndarray, bins: int, values: list[np.ndarray | None]) -> list[np.ndarray]:
    """For each of ``values`` (None counts) its sums over ``bins`` equal phase bins, frequencies x bins."""
    place = (np.floor(_phases(t, freqs) * bins).astype(np.int64) + bins * np.arange(len(freqs))[:, None]).ravel()
    size = len(freqs) * bins
    return [np.bincount(place, None if v is None else np.tile(v, len(freqs)), minlength=size)[:size].reshape(-1, bins) for v in values]


def string_lengths(t: np.ndarray, m: np.ndarray, e: np.ndarray, freqs: np.ndarray) -> np.ndarray:
    """Sum of squared differences of neighbours in phase over their squared errors, the last with the first."""
    order = np.argsort(_phases(t, freqs), axis=1, kind="stable")
    y, v = m[order], e[order] ** 2
    error = v + np.roll(v, 1, axis=1)
    good = error > 0
    return np.where(good, (y - np.roll(y, 1, axis=1)) ** 2 / np.where(good, error, 1), 0.0).sum(axis=1)


def _bessel(order: int, x: float) -> float:
    """Modified Bessel function of the first kind, by its series."""
    term = total = (x / 2) ** order / math.factorial(order)
    k = 0
    while term > 1e-18 * total:
        k += 1
        term *= (x / 2) ** 2 / (k * (k + order))
        total += term
    return total


def periodic_series(width: float, error: float) -> np.ndarray:
    """Coefficients c_0, c_1, ... of exp((cos a - 1) / width^2) = c_0 + 2 sum c_m cos(m a); what is left out is below ``error``."""
    x = width**-2.0
    out = [math.exp(-x) * _bessel(0, x)]
    while 2 * out[-1] > error / 4:  # the terms fall faster than geometrically once they are small
        out.append(math.exp(-x) * _bessel(len(out), x))
    return np.array(out)


def _shape(far: np.ndarray, kernel: str) -> np.ndarray:
    return np.exp(-(far**2) / 4) if kernel == "gaussian" else 1 / (1 + (far / 2) ** 2)


def magnitude_factor(y: np.ndarray, kernel: str, error: float) -> np.ndarray:
    """A with A @ A.T equal to the kernel's matrix of all points, to ``error``, of as few columns as the range of y needs.

    The kernel is interpolated at Chebyshev nodes; their number grows until the interpolation errs by less than ``error``
    everywhere on a finer grid. Few points are their own nodes.
    """
    low, high = float(y.min()), float(y.max())
    size = 16
    while True:
        if size >= len(y):
            nodes, onto = y, np.eye(len(y))
            break
        nodes = (low + high) / 2 + (high - low) / 2 * np.cos(np.pi * (np.arange(size) + 0.5) / size)
        fine = np.linspace(low, high, 4 * size + 1)
        rows = _interpolation(fine, nodes)
        core = _shape(nodes[:, None] - nodes[None, :], kernel)
        if np.abs(rows @ core @ rows.T - _shape(fine[:, None] - fine[None, :], kernel)).max() < error:
            onto = _interpolation(y, nodes)
            break
        size += 8
    values, vectors = np.linalg.eigh(_shape(nodes[:, None] - nodes[None, :], kernel))
    keep = values > max(values[-1], 0) * 1e-16
    return onto @ (vectors[:, keep] * np.sqrt(values[keep]))


def _interpolation(x: np.ndarray, nodes: np.ndarray) -> np.ndarray:
    """Values at ``x`` of the Lagrange polynomials of the Chebyshev nodes, by the barycentric formula."""
    k = np.arange(len(nodes))
    weights = (-1.0) ** k * np.sin(np.pi * (k + 0.5) / len(nodes))
    gap = x[:, None] - nodes[None, :]
    hit = gap == 0
    terms = weights / np.where(hit, 1, gap)
    out = terms / terms.sum(axis=1, keepdims=True)
    on = hit.any(axis=1)
    out[on] = hit[on]
    return out


def mutual_information(t: np.ndarray, y: np.ndarray, freqs: np.ndarray, width: float, kernel: str, error: float) -> tuple[np.ndarray, float, np.ndarray, np.ndarray]:
    """Sums over all pairs of points of the joint kernel, of the magnitude kernel, of the phase kernel (at each
    frequency), and of the product of the two kernels' sums over one point's partners."""
    series = periodic_series(width, error)
    factor = magnitude_factor(y, kernel, error)
    total = factor.sum(axis=0)
    marginal = factor @ total
    n, k = len(t), len(freqs)
    joint = np.full(k, series[0] * float(total @ total))
    phase = np.full(k, series[0] * n * n)
    cross = np.full(k, series[0] * n * float(marginal.sum()))
    rows = np.ascontiguousarray(np.column_stack((factor, np.ones(n), marginal)).T)
    wave = base = turns(t, freqs)
    for m in range(1, len(series)):
        s = _weighed(rows, wave)
        joint += 2 * series[m] * (np.abs(s[:-2]) ** 2).sum(axis=0)
        phase += 2 * series[m] * np.abs(s[-2]) ** 2
        cross += 2 * series[m] * (s[-1] * s[-2].conj()).real
        wave = wave * base
    return joint, float(total @ total), phase, cross
