"""The light-curve features of ``basic_features`` for many curves at once.

Rows are sorted by time once and by magnitude once; everything else is a sum, maximum or lookup over the segments of
these two orders. A feature without a value (no spread, no error, too few points) is NaN, never an error. Pairs
of points at one time have no slope and are left out of MaxSlope and Eta_e.
"""

from __future__ import annotations

import numpy as np

NAMES = [
    "Amplitude", "Rcs", "StetsonK", "Meanvariance", "Con", "SmallKurtosis", "Std", "Mean", "Skew", "MaxSlope", "MedianAbsDev", "MedianBRP", "PairSlopeTrend", "FluxPercentileRatioMid20", "FluxPercentileRatioMid35",
    "FluxPercentileRatioMid50", "FluxPercentileRatioMid65", "FluxPercentileRatioMid80", "PercentDifferenceFluxPercentile", "PercentAmplitude", "LinearTrend", "Eta_e", "Q31", "AndersonDarling", "Gskew", "ExcessVar", "Beyond1Std",
]


class Segments:
    """Sums and extremes over runs of rows that start at ``starts``."""

    def __init__(self, starts: np.ndarray, rows: int):
        self.starts, self.n = starts, np.diff(np.append(starts, rows))
        self.of = np.repeat(np.arange(len(starts)), self.n)
        self.at = np.arange(rows) - starts[self.of]

    def sum(self, x: np.ndarray) -> np.ndarray:
        return np.add.reduceat(x, self.starts)

    def max(self, x: np.ndarray) -> np.ndarray:
        return np.maximum.reduceat(x, self.starts)

    def min(self, x: np.ndarray) -> np.ndarray:
        return np.minimum.reduceat(x, self.starts)

    def count(self, x: np.ndarray) -> np.ndarray:
        return np.add.reduceat(x.astype(np.int64), self.starts)

    def shifted(self, x: np.ndarray, by: int) -> np.ndarray:
        """The value ``by`` rows later (before, if negative) in the same run; NaN where there is none."""
        out = np.full(len(x), np.nan)
        if by > 0:
            out[:-by] = x[by:]
            out[self.at >= self.n[self.of] - by] = np.nan
        else:
            out[-by:] = x[:by]
            out[self.at < -by] = np.nan
        return out

    def running(self, x: np.ndarray) -> np.ndarray:
        """Running sums within each run; they start anew, so that rounding stays in a run."""
        total = np.cumsum(x)
        before = total[self.starts] - x[self.starts]
        return total - before[self.of]

    def quantile(self, ordered: np.ndarray, p: float, first: np.ndarray | int = 0, n: np.ndarray | None = None) -> np.ndarray:
        """Interpolated quantile of ``n`` values from ``first`` on in each ascending run."""
        n = self.n if n is None else n
        pos = p * (n - 1)
        low, high = np.floor(pos).astype(np.int64), np.ceil(pos).astype(np.int64)
        a, b = ordered[self.starts + first + low], ordered[self.starts + first + high]
        return a + (pos - low) * (b - a)  # exactly the value where both are the same


def _normal_cdf(c: np.ndarray) -> np.ndarray:
    """Rational approximation 7.1.26 of Abramowitz and Stegun (error below 1.5e-7)."""
    x = np.abs(c) / 2**0.5
    t = 1 / (1 + 0.3275911 * x)
    tail = t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429)))) * np.exp(-x * x)
    return np.where(c >= 0, 1 - tail / 2, tail / 2)


def curve_features(data: dict[str, np.ndarray], starts: np.ndarray) -> dict[str, np.ndarray]:
    """NAMES for every curve of ``mjd``, ``mag``, ``e_mag`` in order of time."""
    t, m, e = data["mjd"], data["mag"], data["e_mag"]
    s = Segments(starts, len(m))
    n, of = s.n, s.of
    # about the first value, so that a constant curve has no spread at all
    first = m[starts][of]
    shift = s.sum(m - first) / n
    mean, dev = m[starts] + shift, (m - first) - shift[of]
    var = s.sum(dev * dev) / n
    sd = np.sqrt(var)
    flat = np.where(sd > 0, sd, np.nan)
    w = np.where(e > 0, e, np.nan) ** -2.0
    wmean = s.sum(m * w) / s.sum(w)
    off = m - wmean[of]
    sig = off / e
    sd1 = np.sqrt(s.sum(off * off) / (n - 1))

    order = np.lexsort((m, of))
    up = m[order]
    q = lambda p: s.quantile(up, p)
    med, low, high = q(0.5), up[starts], up[starts + n - 1]
    far = np.abs(m - med[of])
    mad = s.quantile(far[np.lexsort((far, of))], 0.5)

    def at(p: float, up_to: bool = True) -> np.ndarray:
        """The magnitude of rank ceil (or floor) of p * n, counted from 0; NaN past the last."""
        k = np.round(p * n, 9)
        k = (np.ceil(k) if up_to else np.floor(k)).astype(np.int64)
        return np.where(k < n, up[starts + np.minimum(k, n - 1)], np.nan)

    ratio = lambda a, b: np.where(b != 0, a / np.where(b != 0, b, 1), np.nan)
    wide = at(0.95) - at(0.05)
    edge = np.ceil(np.round(0.05 * n, 9)).astype(np.int64)
    p3, p97 = q(0.03), q(0.97)
    k3, k97 = s.count(up <= p3[of]), s.count(up >= p97[of])

    dm, dt = m - s.shifted(m, -1), t - s.shifted(t, -1)
    moved = dt > 0
    slope = np.where(moved, np.abs(dm) / np.where(moved, dt, 1), -np.inf)
    weight = np.where(moved, np.where(moved, dt, 1) ** -2.0, 0.0)
    dm0 = np.where(moved, dm, 0.0)
    late = s.at + 1 > n[of] - 29
    z = dev / flat[of]
    outside = np.abs(dev) > 2 * sd[of]
    three = outside & (s.shifted(outside.astype(float), 1) == 1) & (s.shifted(outside.astype(float), 2) == 1)
    run = s.running(dev) / (n * flat)[of]
    tz = t - (s.sum(t) / n)[of]
    ordered = z[order] / np.sqrt(n / (n - 1))[of]
    cdf = _normal_cdf(ordered)
    rank = s.at + 1
    a2 = -n - s.sum(((2 * rank - 1) * np.log(cdf) + (2 * (n[of] - rank) + 1) * np.log(1 - cdf)) / n[of])
    tenth = ((high - low) / 10)[of]
    return {
        "Amplitude": (s.quantile(up, 0.5, n - edge, edge) - s.quantile(up, 0.5, 0, edge)) / 2,
        "Rcs": s.max(run) - s.min(run),
        "StetsonK": ratio(s.sum(np.abs(sig)), np.sqrt(s.sum(sig * sig))) / np.sqrt(n),
        "Meanvariance": ratio(sd, mean),
        "Con": s.count(three) / (n - 2),
        "SmallKurtosis": s.sum(z**4) * n * (n + 1) / ((n - 1) * (n - 2) * (n - 3)) - 3 * (n - 1.0) ** 2 / ((n - 2) * (n - 3)),
        "Std": sd,
        "Mean": mean,
        "Skew": s.sum(z**3) / n,
        "MaxSlope": s.max(slope),
        "MedianAbsDev": mad,
        "MedianBRP": s.count((m > med[of] - tenth) & (m < med[of] + tenth)) / n,
        "PairSlopeTrend": (s.count(late & (dm > 0)) - s.count(late & (dm <= 0))) / 30,
        "FluxPercentileRatioMid20": ratio(at(0.60) - at(0.40), wide),
        "FluxPercentileRatioMid35": ratio(at(0.675) - at(0.325), wide),
        "FluxPercentileRatioMid50": ratio(at(0.75) - at(0.25), wide),
        "FluxPercentileRatioMid65": ratio(at(0.825) - at(0.175), wide),
        "FluxPercentileRatioMid80": ratio(at(0.90) - at(0.10), at(0.95, False) - at(0.05)),
        "PercentDifferenceFluxPercentile": ratio(wide, med),
        "PercentAmplitude": ratio(s.max(far), med),
        "LinearTrend": ratio(s.sum(tz * dev), s.sum(tz * tz)),
        "Eta_e": ratio(ratio(s.sum(weight * dm0 * dm0), s.sum(weight)), var),
        "Q31": q(0.75) - q(0.25),
        "AndersonDarling": 1 / (1 + np.exp(-10 * (a2 - 0.3))),
        "Gskew": s.quantile(up, 0.5, 0, k3) + s.quantile(up, 0.5, n - k97, k97) - 2 * med,
        "ExcessVar": ratio(s.sum(dev * dev - e * e), n * mean * mean),
        "Beyond1Std": np.where(np.isfinite(wmean), s.count(np.abs(off) > sd1[of]) / n, np.nan),
    }
