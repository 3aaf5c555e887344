"""Template fits: a grid of parameters with the linear ones in closed form, then bounded Levenberg-Marquardt steps.

The steps start at the grid's best point and never end with a worse one; ``refine=False`` keeps the grid's. Light
curves are shuffled once and fitted many at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyflow.operators.curves import map_curves
from skyflow.operators.feature_kernel import Segments
from skyflow.operators.least_squares import Model, fit_bounded, fit_walks

KEYS = ["oid", "fid"]


def _grid(df: DataFrame, **axes: list[float]) -> DataFrame:
    """Cross every row with the grid, by explode: a row grows by the constant number of grid points."""
    for name, values in axes.items():
        df = df.withColumn(name, F.explode(F.array(*(F.lit(float(v)) for v in values))))
    return df


def _polished(rows: DataFrame, names: list[str], build, bounds: dict[str, tuple[float, float]]) -> DataFrame:
    """(keys, names, chi2, n) after Levenberg-Marquardt steps from the parameters ``names`` of each light curve's rows.

    ``rows`` have mjd, y and w; ``build(t)`` is the model at times from the curve's ``t_zero``, which keeps numbers small.
    """
    low, high = ([bounds.get(c, (-np.inf, np.inf))[k] for c in names] for k in (0, 1))

    def kernel(data: dict[str, np.ndarray], starts: np.ndarray) -> dict[str, np.ndarray]:
        seg = Segments(starts, len(data["mjd"]))
        start = np.column_stack([data[c][starts] for c in names])
        shape = np.ones((len(starts), 1))
        p, chi = fit_bounded(build(data["mjd"] - data["t_zero"]), start, shape * low, shape * high, seg, data["y"], data["w"])
        return {**{c: p[:, k] for k, c in enumerate(names)}, "chi2": chi, "n": seg.n, "t_zero": data["t_zero"][starts]}

    columns = ["mjd", "y", "w", "t_zero", *names]
    return map_curves(rows, KEYS, ["mjd"], columns, kernel, ", ".join(f"{c} double" for c in [*names, "chi2", "n", "t_zero"]))


def _best_start(starts: Iterator[np.ndarray], model: Model, s: Segments, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The parameters (curves x parameters) of least chi2 among ``starts``, and that chi2."""
    best = chi = None
    for p in starts:
        own = s.sum(w * (y - model([p[s.of, k] for k in range(p.shape[1])])) ** 2)
        own = np.where(np.isfinite(own), own, np.inf)
        if best is None:
            best, chi = p, own
        else:
            better = own < chi
            best, chi = np.where(better[:, None], p, best), np.where(better, own, chi)
    return best, chi


def _magnitudes(det: DataFrame) -> DataFrame:
    """Detections and forced points with a magnitude, a time and a positive error."""
    return det.filter(F.col("mag").isNotNull() & F.col("mjd").isNotNull() & (F.col("e_mag") > 0))


#: Added to the errors of magnitudes that templates are fitted to.
ERROR_FLOOR = 1e-2


def _fleet_model(t: np.ndarray) -> Model:
    def model(p: list[np.ndarray]) -> np.ndarray:
        a, w, m0, t0 = p
        x = w * (t - t0)
        return np.exp(np.minimum(x, 50.0)) - a * x + m0

    return model


def fit_fleet(det: DataFrame, rates: list[float] | None = None, shifts: list[float] | None = None, refine: bool = True) -> DataFrame:
    """m = exp(w dt) - a w dt + m0, dt from t0, forced points included; at least four points with a positive error.

    w and t0 on a grid with a and m0 by least squares, then all four together within 0 <= a <= 10, -100 <= w <= 0,
    0 <= m0 <= 30 and -50 <= t0 <= 10000. fleet_t0 counts from the light curve's first point, as the grid's ``shifts`` do.
    """
    rates, shifts = rates or [-0.003, -0.01, -0.03, -0.05, -0.1, -0.3], shifts or [-30.0, -10.0, 0.0, 5.0]
    low, high = [0.0, -100.0, 0.0, -50.0], [10.0, 0.0, 30.0, 10_000.0]

    def kernel(data: dict[str, np.ndarray], starts: np.ndarray) -> dict[str, np.ndarray]:
        y, w = data["mag"], (data["e_mag"] + ERROR_FLOOR) ** -2.0
        s = Segments(starts, len(y))
        t = data["mjd"] - data["mjd"][starts][s.of]
        ones, model = np.ones(len(starts)), _fleet_model(t)
        mean = s.sum(y) / s.n

        def grid() -> Iterator[np.ndarray]:
            yield np.column_stack([0.6 * ones, -0.05 * ones, mean, 0 * ones])
            sw = s.sum(w)
            for rate in rates:
                for t0 in shifts:
                    x = -rate * (t - t0)
                    rest = y - np.exp(np.minimum(-x, 50.0))
                    mx, my = s.sum(w * x) / sw, s.sum(w * rest) / sw
                    spread = s.sum(w * (x - mx[s.of]) ** 2)
                    a = np.where(spread > 0, s.sum(w * (x - mx[s.of]) * rest) / np.where(spread > 0, spread, 1), 0.0)
                    a = np.clip(a, low[0], high[0])
                    yield np.column_stack([a, rate * ones, np.clip(my - a * mx, low[2], high[2]), t0 * ones])

        p, chi = _best_start(grid(), model, s, y, w)
        if refine:
            p, chi = fit_bounded(model, p, np.outer(ones, low), np.outer(ones, high), s, y, w)
        return {"fleet_a": p[:, 0], "fleet_w": p[:, 1], "fleet_chi": np.where(s.n > 4, chi / np.maximum(s.n - 4, 1), np.nan), "fleet_m0": p[:, 2], "fleet_t0": p[:, 3]}

    return map_curves(_magnitudes(det), KEYS, ["mjd", "candid"], ["mjd", "mag", "e_mag"], kernel, ", ".join(f"fleet_{c} double" for c in ("a", "w", "chi", "m0", "t0")), 4)


def _lens_model(t: np.ndarray) -> Model:
    def model(p: list[np.ndarray]) -> np.ndarray:
        u0, te, fs, t0, mag0 = p
        return mag0 - 2.5 * np.log10(fs * (_gain(t, u0, te, t0) - 1) + 1)

    return model


def _gain(t: np.ndarray, u0: np.ndarray, te: np.ndarray, t0: np.ndarray) -> np.ndarray:
    """Magnification by a point lens."""
    u2 = u0**2 + ((t - t0) / te) ** 2
    return (u2 + 2) / np.sqrt(u2 * (u2 + 4))


def fit_microlensing(det: DataFrame, u0: list[float] | None = None, te: list[float] | None = None, refine: bool = True) -> DataFrame:
    """Point-lens curve: mag = mag0 - 2.5 log10(fs (A(u) - 1) + 1), forced points included; at least four points with an
    error between 0 and 1.

    u0, tE, fs and t0 (around the brightest point) on a grid with mag0 by least squares, then all five together with
    u0 and tE positive and 0 <= fs <= 1. ulens_t0 counts from the object's first point.
    """
    axes = [(a, b, f, d) for a in u0 or [0.1, 0.3, 0.6, 1.0] for b in te or [2.0, 5.0, 10.0, 20.0, 30.0] for f in (0.3, 0.5, 1.0) for d in (-1.0, 0.0, 1.0)]
    low, high = [1e-6, 1e-3, 0.0, -np.inf, -np.inf], [np.inf, np.inf, 1.0, np.inf, np.inf]

    def kernel(data: dict[str, np.ndarray], starts: np.ndarray) -> dict[str, np.ndarray]:
        y, w, t = data["mag"], (data["e_mag"] + ERROR_FLOOR) ** -2.0, data["mjd"] - data["first"]
        s = Segments(starts, len(y))
        ones, model, sw = np.ones(len(starts)), _lens_model(t), s.sum(w)
        peak = t[np.lexsort((t, y, s.of))[starts]]

        def grid() -> Iterator[np.ndarray]:
            for a, b, f, d in axes:
                shape = 2.5 * np.log10(f * (_gain(t, a, b, peak[s.of] + d) - 1) + 1)
                yield np.column_stack([a * ones, b * ones, f * ones, peak + d, s.sum(w * (y + shape)) / sw])

        p, chi = _best_start(grid(), model, s, y, w)
        if refine:
            p, chi = fit_bounded(model, p, np.outer(ones, low), np.outer(ones, high), s, y, w)
        return {"ulens_u0": p[:, 0], "ulens_tE": p[:, 1], "ulens_fs": p[:, 2], "ulens_chi": np.where(s.n > 4, chi / np.maximum(s.n - 4, 1), np.nan), "ulens_t0": p[:, 3], "ulens_mag0": p[:, 4]}

    own = _magnitudes(det).filter("e_mag < 1").withColumn("first", F.min("mjd").over(Window.partitionBy("oid")))
    return map_curves(own, KEYS, ["mjd", "candid"], ["mjd", "mag", "e_mag", "first"], kernel, ", ".join(f"ulens_{c} double" for c in ("u0", "tE", "fs", "chi", "t0", "mag0")), 4)


SPM = ["gamma", "rise", "fall", "beta", "lead"]


SPM_BOUNDS = {"A": (0.0, np.inf), "gamma": (1.0, 120.0), "rise": (1.0, 100.0), "fall": (1.0, 180.0), "beta": (0.0, 1.0)}


def _spm_model(t: np.ndarray) -> Model:
    def model(p: list[np.ndarray]) -> np.ndarray:
        height, gamma, rise, fall, beta, lead = p
        dt = t + lead
        plateau, decline = 1 - beta * dt / gamma, (1 - beta) * np.exp(np.clip(-(dt - gamma) / fall, -50.0, 50.0))
        return height * np.where(dt < gamma, plateau, decline) / (1 + np.exp(np.clip(-dt / rise, -50.0, 50.0)))

    return model


def _spm_fit(d: DataFrame) -> DataFrame:
    """Best (A, parameters, chi2, n) of each light curve whose rows carry the parameters to try."""
    dt = F.col("mjd") - F.col("t_peak") + F.col("lead")
    plateau = 1 - F.col("beta") * dt / F.col("gamma")
    decline = (1 - F.col("beta")) * F.exp(-(dt - F.col("gamma")) / F.col("fall"))
    shape = F.when(dt < F.col("gamma"), plateau).otherwise(decline) / (1 + F.exp(F.greatest(F.least(-dt / F.col("rise"), F.lit(50.0)), F.lit(-50.0))))
    keys = [*KEYS, "t_peak", *SPM]
    sums = {"sf": "w * s * f", "ss": "w * s * s", "ff": "w * f * f"}
    s = d.withColumns({"s": shape, "f": F.col("flux"), "w": F.col("weight")}).groupBy(*keys).agg(*(F.sum(F.expr(v)).alias(k) for k, v in sums.items()), F.count("*").alias("n"))
    s = s.withColumn("A", F.greatest(F.col("sf") / F.nullif("ss", F.lit(0.0)), F.lit(0.0))).withColumn("chi2", F.expr("ff - 2 * A * sf + A * A * ss"))
    return s.filter("A is not null").groupBy(*KEYS).agg(F.min_by(F.struct("A", "t_peak", *SPM, "chi2", "n"), F.struct("chi2", *SPM)).alias("x"))


def fit_supernova(
    det: DataFrame, gamma: list[float] | None = None, rise: list[float] | None = None, fall: list[float] | None = None, beta: list[float] | None = None, lead: list[float] | None = None, prelude: float = 30.0,
    redshift: str | None = None, ebv: str | None = None, extinction: dict[str, float] | None = None, refine: bool = True,
) -> DataFrame:
    """Rise, plateau and fall of the flux per band; the amplitude in closed form and the rest on a grid, then all six
    parameters together within 1 <= gamma <= 120, 0 <= beta <= 1, 1 <= rise <= 100, 1 <= fall <= 180.

    Forced points up to ``prelude`` days before the first detection count too, and negative fluxes at a quarter of
    their weight. ``redshift`` and ``ebv`` name columns: times are divided by 1 + z, and fluxes corrected by
    ``extinction`` (magnitudes for each unit of reddening, by band).
    """
    g = Window.partitionBy(*KEYS)
    own = ~F.col("forced")
    d = det.withColumns({"__n": F.count(F.when(own, 1)).over(g), "__a": F.min(F.when(own, F.col("mjd"))).over(g), "t_peak": F.min(F.when(own, F.struct("mag", "mjd"))).over(g)["mjd"]})
    d = d.filter((F.col("__n") >= 5) & (own | F.col("mjd").between(F.col("__a") - prelude, F.col("__a"))))
    flux = F.pow(F.lit(10.0), -0.4 * (F.col("mag") - 23.9)) * F.col("isdiffpos")
    if ebv:
        dust = F.lit(0.0)
        for band, r in (extinction or {}).items():
            dust = F.when(F.col("fid") == band, r).otherwise(dust)
        flux = flux * F.pow(F.lit(10.0), 0.4 * dust * F.col(ebv))
    if redshift:
        d = d.withColumn("mjd", F.col("t_peak") + (F.col("mjd") - F.col("t_peak")) / (1 + F.coalesce(F.col(redshift), F.lit(0.0))))
    weight = F.pow(F.abs("flux") * F.col("e_mag") + 1e-6, -2) * F.when(F.col("flux") < 0, 0.25).otherwise(1.0)
    d = d.withColumn("flux", flux).withColumn("weight", weight).select(*KEYS, "mjd", "t_peak", "flux", "weight")
    best = _spm_fit(_grid(d, gamma=gamma or [5.0, 15.0, 40.0], rise=rise or [1.0, 4.0], fall=fall or [8.0, 30.0, 80.0], beta=beta or [0.2, 0.6], lead=lead or [2.0, 8.0]))
    best = best.select(*KEYS, "x.*")
    if refine:
        rows = d.join(best.drop("t_peak", "n", "chi2"), KEYS).select(*KEYS, "mjd", F.col("flux").alias("y"), F.col("weight").alias("w"), F.col("t_peak").alias("t_zero"), "A", *SPM)
        best = _polished(rows, ["A", *SPM], _spm_model, SPM_BOUNDS).withColumnRenamed("t_zero", "t_peak")
    return best.select(
        *KEYS, F.col("A").alias("SPM_A"), (F.col("t_peak") - F.col("lead")).alias("SPM_t0"), F.col("gamma").alias("SPM_gamma"), F.col("beta").alias("SPM_beta"), F.col("rise").alias("SPM_tau_rise"),
        F.col("fall").alias("SPM_tau_fall"), (F.col("chi2") / F.greatest(F.col("n") - 6, F.lit(1))).alias("SPM_chi"),
    )


def fit_drw(det: DataFrame, sigmas: list[float] | None = None, taus: list[float] | None = None, refine: bool = True) -> DataFrame:
    """Damped random walk by likelihood: the best (sigma, tau) of a grid, then of finer ones around it; five points at least.

    Points without an error count as exact.
    """
    s, u = np.array(sigmas or [0.05, 0.1, 0.2, 0.4, 0.8, 1.6]), np.array(taus or [0.3, 1.0, 3.0, 10.0, 30.0, 100.0])
    zooms = 12 if refine else 0

    def kernel(data: dict[str, np.ndarray], starts: np.ndarray) -> dict[str, np.ndarray]:
        seg = Segments(starts, len(data["mjd"]))
        m = data["mag"]
        found = fit_walks(data["mjd"], m - (seg.sum(m) / seg.n)[seg.of], np.nan_to_num(data["e_mag"]), seg, s, u, zooms)
        return dict(zip(("GP_DRW_sigma", "GP_DRW_tau", "GP_DRW_nll"), found.T))

    own = det.filter(~F.col("forced") & F.col("mag").isNotNull() & F.col("mjd").isNotNull())
    return map_curves(own, KEYS, ["mjd", "mag"], ["mjd", "mag", "e_mag"], kernel, "GP_DRW_sigma double, GP_DRW_tau double, GP_DRW_nll double", 5)


def fit_iar_phi(det: DataFrame, steps: int = 20) -> DataFrame:
    """Irregular autoregression: phi in (0, 1) of greatest likelihood for the standardised magnitudes, on ``steps``
    values and then on as many within the best one's step. A constant curve has no row."""
    g, o = Window.partitionBy(*KEYS), Window.partitionBy(*KEYS).orderBy("mjd", "candid")
    d = det.filter(~F.col("forced")).withColumns({"n": F.count("*").over(g), "z": F.try_divide(F.col("mag") - F.avg("mag").over(g), F.stddev_samp("mag").over(g))}).filter("n >= 6 and z is not null")
    d = d.withColumns({"pz": F.lag("z").over(o), "dt": F.col("mjd") - F.lag("mjd").over(o)}).select(*KEYS, "z", "pz", "dt")

    def best(rows: DataFrame) -> DataFrame:
        a = F.pow("phi", "dt")
        v = F.greatest(1 - a * a, F.lit(1e-6))
        cost = F.when(F.col("pz").isNull(), F.pow("z", 2)).otherwise(F.log(v) + F.pow(F.col("z") - a * F.col("pz"), 2) / v)
        nll = rows.groupBy(*KEYS, "phi").agg(F.round(F.sum(cost) / 2, 9).alias("nll"))
        return nll.groupBy(*KEYS).agg(F.min_by("phi", F.struct("nll", "phi")).alias("IAR_phi"))

    coarse = best(_grid(d, phi=[(k + 0.5) / steps for k in range(steps)]))
    offsets = F.explode(F.array(*(F.lit(((k + 0.5) / steps - 0.5) / steps) for k in range(steps))))
    fine = d.join(coarse, KEYS).withColumn("__o", offsets).withColumn("phi", F.col("IAR_phi") + F.col("__o"))
    return best(fine)


def _ciar_costs(t: np.ndarray, z: np.ndarray, starts: np.ndarray, n: np.ndarray, phi: np.ndarray) -> np.ndarray:
    """Negative log likelihood, curves x values of ``phi``: one Kalman step for a point of all curves and values at a time."""
    size, angle = np.abs(phi), np.angle(phi)
    order = np.argsort(-n, kind="stable")  # the curves that still go on come first
    state = np.zeros((6, len(n), len(phi)))  # x, y, p, q, r, cost
    state[2] = state[4] = 1.0
    for i in range(int(n.max())):
        k = int(np.searchsorted(-n[order], -i, side="left"))
        at = starts[order[:k]] + i
        x, y, p, q, r, cost = state[:, :k]
        before = t[at - 1] if i else np.full(k, np.nan)
        dt = np.nan_to_num(t[at] - before)[:, None]
        m = np.where(np.isnan(before)[:, None], 0.0, size**dt)
        c, w, rest = m * np.cos(dt * angle), m * np.sin(dt * angle), 1 - m * m
        x, y = c * x - w * y, w * x + c * y
        cc, ww, cw = c * c, w * w, c * w
        p, q, r = cc * p - 2 * cw * q + ww * r + rest, cw * (p - r) + (cc - ww) * q, ww * p + 2 * cw * q + cc * r + rest
        v, e = np.maximum(p, 1e-9), z[at][:, None] - x
        state[:, :k] = x + p / v * e, y + q / v * e, p - p * p / v, q - p * q / v, r - q * q / v, cost + (np.log(v) + e * e / v) / 2
    out = np.empty_like(state[5])
    out[order] = state[5]
    return out


#: Curves x values of phi whose states are held at once.
CIAR_CELLS = 1 << 18


def fit_ciar(det: DataFrame, real: list[float] | None = None, imaginary: list[float] | None = None) -> DataFrame:
    """Complex irregular autoregression: phi = (CIAR_phiR, CIAR_phiI) inside the unit circle of greatest likelihood, by
    a Kalman fold over the standardised light curve; six points at least, and not all alike."""
    axis = [-0.9, -0.6, -0.3, 0.1, 0.3, 0.6, 0.9, 0.99]
    phi = np.array(sorted({(float(a), float(b)) for a in real or axis for b in imaginary or axis if a * a + b * b < 1})).reshape(-1, 2)
    values, cells = phi[:, 0] + 1j * phi[:, 1], CIAR_CELLS

    def kernel(data: dict[str, np.ndarray], starts: np.ndarray) -> dict[str, np.ndarray]:
        s = Segments(starts, len(data["mjd"]))
        seen = ~np.isnan(data["mag"])
        n, m = s.count(seen), np.where(seen, data["mag"], 0.0)
        lowest = s.min(np.where(seen, m, np.inf))  # about it a constant curve has no spread at all
        about = np.where(seen, m - np.where(n > 0, lowest, 0.0)[s.of], 0.0)
        about = np.where(seen, about - (s.sum(about) / np.maximum(n, 1))[s.of], 0.0)
        spread = np.sqrt(s.sum(about * about) / np.maximum(n - 1, 1))
        kept = np.flatnonzero((n > 1) & (spread > 0))
        own = seen & np.isin(s.of, kept)
        z, t, n = (about / spread[s.of])[own], data["mjd"][own], n[kept]
        begin = np.cumsum(n) - n
        best = np.full((len(kept), 2), np.nan)
        step = max(1, cells // max(len(phi), 1))
        for k in range(0, len(kept) if len(phi) else 0, step):
            part = slice(k, k + step)
            cost = np.round(_ciar_costs(t, z, begin[part], n[part], values), 9)
            best[part] = phi[np.argmin(np.where(np.isnan(cost), np.inf, cost), axis=1)]
        return {"curve": kept, "CIAR_phiR": best[:, 0], "CIAR_phiI": best[:, 1]}

    return map_curves(det.filter(~F.col("forced")), KEYS, ["mjd", "mag"], ["mjd", "mag"], kernel, "CIAR_phiR double, CIAR_phiI double", 6)
