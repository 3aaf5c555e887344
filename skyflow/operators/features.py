"""Light-curve features.

``basic_features`` shuffles once by (oid, fid) and computes all its features in one pass over the sorted curves; the
other features are windows and aggregates over the same keys.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyflow.functions.columns import clean
from skyflow.operators.curves import map_curves
from skyflow.operators.feature_kernel import NAMES, Segments, curve_features

KEYS = ["oid", "fid"]
MIN_POINTS = 6


def _windows() -> dict[str, Column]:
    """What features added by users may build on."""
    g, o = Window.partitionBy(*KEYS), Window.partitionBy(*KEYS).orderBy("mjd", "candid")
    up = Window.partitionBy(*KEYS).orderBy("mag", "candid")
    w = F.pow(F.when(F.col("e_mag") > 0, F.col("e_mag")), -2)
    return {
        "n": F.count("*").over(g), "mean": F.avg("mag").over(g), "sd": F.stddev_pop("mag").over(g), "med": F.percentile("mag", 0.5).over(g), "lo": F.min("mag").over(g), "hi": F.max("mag").over(g),
        "p3": F.percentile("mag", 0.03).over(g), "p97": F.percentile("mag", 0.97).over(g), "wmean": F.try_divide(F.sum(F.col("mag") * w).over(g), F.sum(w).over(g)), "rank": F.row_number().over(up),
        "at": F.row_number().over(o), "pm": F.lag("mag").over(o), "pt": F.lag("mjd").over(o), "m1": F.lead("mag").over(o), "m2": F.lead("mag", 2).over(o), "run": F.sum("mag").over(o.rowsBetween(Window.unboundedPreceding, 0)),
    }


#: Features added by users: name to a function of options that returns an aggregate over the window columns.
_ADDED: dict[str, Callable[..., Column]] = {}


def register_feature(name: str, build: Callable[..., Column]) -> None:
    """Add a feature by name: ``build(**options)`` is an aggregate over mag, e_mag, mjd and the columns of ``_windows``."""
    _ADDED[name] = build


def basic_features(det: DataFrame, only: list[str] | None = None, options: dict[str, dict] | None = None) -> DataFrame:
    """One row per (oid, fid) with more than five detections, one column per feature; others have none.

    Detections without time or magnitude are left out. A feature that a curve does not determine is null: those
    divided by the spread of a constant curve, those by errors of zero, slopes of points at one time.
    """
    if unknown := set(only or ()) - set(NAMES) - set(_ADDED):
        raise ValueError(f"unknown features {sorted(unknown)}")
    own = det.filter(~F.col("forced") & F.col("mag").isNotNull() & F.col("mjd").isNotNull())
    names = [k for k in NAMES if only is None or k in only]
    added = {k: f(**(options or {}).get(k, {})) for k, f in _ADDED.items() if only is None or k in only}
    wide = map_curves(own, KEYS, ["mjd", "candid"], ["mjd", "mag", "e_mag"], curve_features, ", ".join(f"{k} double" for k in names), MIN_POINTS) if names else None
    if not added:
        return wide
    df = own.withColumns(_windows()).filter(F.col("n") >= MIN_POINTS)
    df = df.withColumn("sd1", F.sqrt(F.sum(F.pow(F.col("mag") - F.col("wmean"), 2)).over(Window.partitionBy(*KEYS)) / (F.col("n") - 1)))
    more = df.groupBy(*KEYS).agg(*(clean(v.cast("double")).alias(k) for k, v in added.items()))
    return more if wide is None else wide.join(more, KEYS)


def long_features(wide: DataFrame, version: str, keys: list[str] = KEYS) -> DataFrame:
    names = [c for c in wide.columns if c not in keys]
    return wide.unpivot(keys, names, "name", "value").withColumn("version", F.lit(version))


def near_pairs(a: DataFrame, b: DataFrame, keys: list[str], at: str, other: str, reach: float) -> DataFrame:
    """Pairs of rows of one key whose times ``at`` (of a) and ``other`` (of b) are at most ``reach`` apart.

    Times fall into cells as long as the reach, and only neighbouring cells meet, so a long light curve is
    never crossed with itself.
    """
    cell = lambda t: F.floor(F.col(t) / reach).cast("long")
    left = a.withColumn("__cell", F.explode(F.sequence(cell(at) - 1, cell(at) + 1)))
    pairs = left.join(b.withColumn("__cell", cell(other)), [*keys, "__cell"]).drop("__cell")
    return pairs.filter(F.abs(F.col(at) - F.col(other)) <= reach)


def pair_join(obs: DataFrame, within: float) -> DataFrame:
    """Pairs of one object's observations in a band, at most ``within`` days apart: dt, abs(dm), summed squared errors."""
    a = obs.select(*KEYS, F.col("mjd").alias("t1"), F.col("candid").alias("c1"), F.col("mag").alias("m1"), F.col("e_mag").alias("e1"))
    b = obs.select(*KEYS, F.col("mjd").alias("t2"), F.col("candid").alias("c2"), F.col("mag").alias("m2"), F.col("e_mag").alias("e2"))
    pairs = near_pairs(a, b, KEYS, "t1", "t2", within).filter(F.struct("t1", "c1") < F.struct("t2", "c2"))
    return pairs.select(*KEYS, (F.col("t2") - F.col("t1")).alias("dt"), F.abs(F.col("m2") - F.col("m1")).alias("dm"), (F.col("e1") * F.col("e1") + F.col("e2") * F.col("e2")).alias("err2"))


def structure_function(obs: DataFrame, low: float = 5.0, high: float = 365.0, step: float = 0.1, longest: float = 2000.0) -> DataFrame:
    """Slope (gamma) and amplitude (at a year) of the structure function in bins of ``step`` dex from ``low`` days.

    A bin's value is the root of its mean squared difference less the errors; negative means are left out. The line
    is fitted where 0.01 < tau <= 0.5 years. Amplitudes under 0.005 count as 0, with slope 0, and are at most 15;
    slopes lie between -0.5 and 3. Both are -0.5 where fewer than two bins, or fewer than two fitted ones, have a value.
    """
    last = int((math.log10(longest) - math.log10(low)) / step - 1e-9)
    k = F.floor((F.log10("dt") - math.log10(low)) / step + 1e-12).cast("int")
    edge = lambda n: F.pow(F.lit(10.0), math.log10(low) + step * n)
    pairs = pair_join(obs.filter(~F.col("forced")), high).filter(F.col("dt").between(low, high))
    binned = pairs.withColumn("bin", k).filter(F.col("bin") < last).groupBy(*KEYS, "bin").agg(F.avg(F.col("dm") * F.col("dm") - F.col("err2")).alias("sf2"))
    tau = (edge(F.col("bin")) + edge(F.col("bin") + 1)) / 2 / 365
    x, y = F.log10(tau), F.log10(F.sqrt("sf2"))
    fitted = (tau > 0.01) & (tau <= 0.5)
    fit = binned.filter("sf2 > 0").groupBy(*KEYS).agg(
        F.count("*").alias("n_bins"), F.count(F.when(fitted, 1)).alias("n_fit"), F.regr_slope(F.when(fitted, y), F.when(fitted, x)).alias("gamma"), F.pow(F.lit(10.0), F.regr_intercept(F.when(fitted, y), F.when(fitted, x))).alias("a")
    )
    all_keys = obs.filter(~F.col("forced")).select(*KEYS).distinct().join(fit, KEYS, "left")
    good, faint = (F.col("n_bins") >= 2) & (F.col("n_fit") >= 2), F.col("a") < 0.005
    gamma = F.when(faint, 0.0).otherwise(F.greatest(F.least("gamma", F.lit(3.0)), F.lit(-0.5)))
    return all_keys.select(*KEYS, F.when(good, gamma).otherwise(-0.5).alias("SF_ML_gamma"), F.when(good, F.when(faint, 0.0).otherwise(F.least("a", F.lit(15.0)))).otherwise(-0.5).alias("SF_ML_amplitude"))


def _even_steps(t: np.ndarray, m: np.ndarray, s: Segments, points: int) -> np.ndarray:
    """Each curve (of two points at least) interpolated at ``points`` even steps from its first to its last time."""
    lo, rows, j = t[s.starts], np.arange(len(s.n)), np.arange(points)
    step = (t[s.starts + s.n - 1] - lo) / (points - 1)
    # the grid points from an observation up to the next one are its own; the last of all belongs to the last piece
    first = np.ceil((t - lo[s.of]) / step[s.of] - 1e-9).astype(np.int64)
    own = (s.at < s.n[s.of] - 1) & (first < points)
    begun = np.bincount(s.of[own] * points + first[own], minlength=len(rows) * points).reshape(-1, points)
    at = s.starts[:, None] + begun.cumsum(axis=1) - 1
    return m[at] + (lo[:, None] + j * step[:, None] - t[at]) / (t[at + 1] - t[at]) * (m[at + 1] - m[at])


def structure_function_indices(obs: DataFrame, points: int = 100) -> DataFrame:
    """Slopes between the log structure functions of order 1, 2 and 3 of the light curve interpolated at equal steps."""
    series = obs.filter(~F.col("forced")).groupBy(*KEYS, "mjd").agg(F.avg("mag").alias("mag"))  # one value a time
    pairs = ((2, 1), (3, 1), (3, 2))

    def kernel(data: dict[str, np.ndarray], starts: np.ndarray) -> dict[str, np.ndarray]:
        seen = ~np.isnan(data["mjd"])
        n = Segments(starts, len(seen)).count(seen)
        kept = np.flatnonzero(n > 1)
        seen &= np.repeat(n > 1, np.diff(np.append(starts, len(seen))))
        s = Segments(np.cumsum(n[kept]) - n[kept], int(seen.sum()))
        c = np.ascontiguousarray(_even_steps(data["mjd"][seen], data["mag"][seen], s, points).T)
        y = np.full((3, points - 1, len(kept)), np.nan)
        for lag in range(1, points):
            gap = np.abs(c[lag:] - c[:-lag])
            square = gap * gap
            for k, x in enumerate((gap, square, square * gap)):
                y[k, lag - 1] = x.sum(axis=0) / (points - lag)
        used = y[0] > 0
        y = np.where(used, np.log10(np.where(used, y, 1)), 0.0)
        dev = np.where(used, y - (y.sum(axis=1) / used.sum(axis=0))[:, None], 0.0)
        spread = (dev * dev).sum(axis=1)
        slope = lambda b, a: np.where(spread[a] > 0, (dev[a] * dev[b]).sum(axis=0) / spread[a], np.nan)
        some = used.any(axis=0)
        return {"curve": kept[some]} | {f"StructureFunction_index_{b}{a}": slope(b - 1, a - 1)[some] for b, a in pairs}

    return map_curves(series, KEYS, ["mjd"], ["mjd", "mag"], kernel, ", ".join(f"StructureFunction_index_{b}{a} double" for b, a in pairs), MIN_POINTS)


def colors(det: DataFrame, a: str, b: str) -> DataFrame:
    """Differences of band means and of brightest magnitudes, and the ratio of 90th flux percentiles."""
    from skyflow.functions.columns import mag_to_flux

    flux = mag_to_flux(F.col("mag"), F.col("e_mag"), F.col("isdiffpos"))[0]
    d = det.filter(~F.col("forced")).withColumn("flux", F.abs(flux))
    x = {k: F.when(F.col("fid") == band, F.col("mag")) for k, band in (("a", a), ("b", b))}
    f = {k: F.percentile(F.when(F.col("fid") == band, F.col("flux")), 0.9) for k, band in (("a", a), ("b", b))}
    return d.groupBy("oid").agg((F.avg(x["a"]) - F.avg(x["b"])).alias("color_mean"), (F.min(x["a"]) - F.min(x["b"])).alias("color_max"), (f["a"] / (f["b"] + 1)).alias("color_flux_p90"))


def color_mean_max(det: DataFrame, bands: list[str], column: str = "mag", suffix: str = "") -> DataFrame:
    """Differences of neighbouring bands' means and brightest magnitudes; ``column`` holds corrected or difference magnitudes."""
    d = det.filter(~F.col("forced"))
    x = {b: F.when(F.col("fid") == b, F.col(column)) for b in bands}
    cols = [((f(x[a]) - f(x[b])).alias(f"{a}-{b}_{name}{suffix}")) for a, b in zip(bands, bands[1:]) for name, f in (("mean", F.avg), ("max", F.min))]
    return d.groupBy("oid").agg(*cols)


def q31_color(det: DataFrame, a: str, b: str) -> DataFrame:
    """Interquartile range of the colour at the times of band ``a``, against the point of ``b`` nearest in time."""
    own = det.filter(~F.col("forced") & F.col("fid").isin(a, b))
    o = Window.partitionBy("oid").orderBy("mjd", "candid")
    point = F.when(F.col("fid") == b, F.struct("mjd", "mag"))
    d = own.withColumns({
        "__p": F.last(point, ignorenulls=True).over(o.rowsBetween(Window.unboundedPreceding, 0)), "__n": F.first(point, ignorenulls=True).over(o.rowsBetween(0, Window.unboundedFollowing)),
    }).filter(F.col("fid") == a)
    before, after = F.col("mjd") - F.col("__p.mjd"), F.col("__n.mjd") - F.col("mjd")
    near = F.when(F.col("__n").isNull() | (before <= after), F.col("__p.mag")).otherwise(F.col("__n.mag"))
    c = F.col("mag") - near
    return d.groupBy("oid").agg((F.percentile(c, 0.75) - F.percentile(c, 0.25)).alias("Q31_color"))


def color_variation(det: DataFrame, a: str, b: str, days: float = 10.0, least: int = 3) -> DataFrame:
    """Sample spread of the mean colour over windows of ``days`` from the first point with ``least`` points in each band."""
    first = F.min("mjd").over(Window.partitionBy("oid"))
    d = det.filter(~F.col("forced")).withColumn("bucket", F.floor((F.col("mjd") - first) / days))
    xa, xb = (F.when(F.col("fid") == k, F.col("mag")) for k in (a, b))
    per = d.groupBy("oid", "bucket").agg((F.avg(xa) - F.avg(xb)).alias("c"), F.count(xa).alias("na"), F.count(xb).alias("nb"))
    return per.filter((F.col("na") >= least) & (F.col("nb") >= least)).groupBy("oid").agg(F.stddev_samp("c").alias("color_variation"), F.count("*").alias("n_windows"))


def reference_features(obs: DataFrame, references: DataFrame) -> DataFrame:
    """Mean and sample sigma of the distance to the reference, and sharpness and chi of the references weighted by their observations."""
    own = obs.groupBy("oid").agg(F.avg("distnr").alias("mean_distnr"), F.stddev_samp("distnr").alias("sigma_distnr"))
    used = obs.filter("rfid is not null").groupBy("oid", F.col("rfid").cast("long").alias("rfid")).agg(F.count("*").alias("n"))
    side = references.select("oid", F.col("rfid").cast("long").alias("rfid"), "sharpnr", "chinr")
    mean = lambda c: (F.sum(F.col(c) * F.col("n")) / F.sum("n")).alias(f"mean_{c}")
    return own.join(used.join(side, ["oid", "rfid"]).groupBy("oid").agg(mean("sharpnr"), mean("chinr")), "oid", "left")


def sn_features(det: DataFrame, column: str = "mag") -> DataFrame:
    """Positive share, forced points before and after the first detection, and the jumps from the former to it."""
    first = F.min(F.when(~F.col("forced"), F.col("mjd"))).over(Window.partitionBy("oid"))
    d = det.withColumn("__first", first)
    before, after = F.col("forced") & (F.col("mjd") < F.col("__first")), F.col("forced") & (F.col("mjd") > F.col("__first"))
    own, at = ~F.col("forced"), F.struct("mjd", "candid")
    x = lambda c: F.when(c, F.col(column))
    start, last, middle = F.min_by(x(own), F.when(own, at)), F.max_by(x(before), F.when(before, at)), F.percentile(x(before), 0.5)
    return d.groupBy("oid", "fid").agg(
        (F.count(F.when(own & (F.col("isdiffpos") > 0), 1)) / F.nullif(F.count(F.when(own, 1)), F.lit(0))).alias("positive_fraction"), F.count(F.when(before, 1)).alias("n_before"), F.max(x(before)).alias("max_before"),
        middle.alias("median_before"), last.alias("last_before"), (start - last).alias("dbrightness_first_det"), (start - middle).alias("dbrightness_forced_phot"), F.count(F.when(after, 1)).alias("n_after"),
        F.max(x(after)).alias("max_after"), F.percentile(x(after), 0.5).alias("median_after"),
    )


def coordinates_xyz(det: DataFrame) -> DataFrame:
    ra, dec = F.radians(F.avg("ra")), F.radians(F.avg("dec"))
    return det.groupBy("oid").agg((F.cos(ra) * F.cos(dec)).alias("x"), (F.sin(ra) * F.cos(dec)).alias("y"), F.sin(dec).alias("z"), (F.max("mjd") - F.min("mjd")).alias("timespan"))


def tde_tail(det: DataFrame, days: float = 200.0) -> DataFrame:
    """Weighted line of magnitude on 2.5 log10(t - t_peak + 40) after the peak; slope, intercept, chi2 per degree of freedom.

    Points without a positive error are left out; points at one time have no slope.
    """
    own = det.filter(~F.col("forced") & (F.col("e_mag") > 0))
    peak = F.min(F.struct("mag", "mjd")).over(Window.partitionBy("oid", "fid"))["mjd"]
    d = own.withColumn("dt", F.col("mjd") - peak).filter(F.col("dt").between(0, days)).withColumn("x", 2.5 * F.log10(F.col("dt") + 40)).withColumn("w", F.pow("e_mag", -2))
    s = {k: F.sum(v) for k, v in {"sw": F.col("w"), "sx": F.col("w") * F.col("x"), "sy": F.col("w") * F.col("mag"), "sxx": F.col("w") * F.col("x") * F.col("x"), "sxy": F.col("w") * F.col("x") * F.col("mag"), "syy": F.col("w") * F.col("mag") * F.col("mag")}.items()}
    g = d.groupBy("oid", "fid").agg(*(v.alias(k) for k, v in s.items()), F.count("*").alias("n")).filter("n >= 5")
    slope = F.expr("try_divide(sw * sxy - sx * sy, sw * sxx - sx * sx)")
    g = g.withColumn("slope", slope).withColumn("intercept", F.expr("(sy - slope * sx) / sw"))
    return g.select("oid", "fid", "slope", "intercept", F.expr("(syy - intercept * sy - slope * sxy) / (n - 2)").alias("chi"))


def folded_kim(det: DataFrame, periods: DataFrame) -> DataFrame:
    """Statistics of the curve folded at twice the period: range of the cumulative sum, and neighbour variance; null for a
    constant curve."""
    d = det.filter(~F.col("forced") & F.col("mag").isNotNull()).join(periods, "oid").withColumn("phase", F.pmod(F.try_divide("mjd", 2 * F.col("period")), F.lit(1.0)))
    g, o = Window.partitionBy("oid", "fid"), Window.partitionBy("oid", "fid").orderBy("phase", "candid")
    d = d.withColumns({"n": F.count("*").over(g), "mean": F.avg("mag").over(g), "sd": F.stddev_pop("mag").over(g), "run": F.sum("mag").over(o.rowsBetween(Window.unboundedPreceding, 0)), "at": F.row_number().over(o), "pm": F.lag("mag").over(o)}).filter("n >= 6")
    s = F.try_divide(F.col("run") - F.col("at") * F.col("mean"), F.col("n") * F.col("sd"))
    return d.groupBy("oid", "fid").agg((F.max(s) - F.min(s)).alias("Psi_CS"), F.try_divide(F.sum(F.pow(F.col("mag") - F.col("pm"), 2)) / (F.first("n") - 1), F.pow(F.first("sd"), 2)).alias("Psi_eta"))


def harmonics(det: DataFrame, periods: DataFrame, order: int = 7) -> DataFrame:
    """Weighted Fourier fit: amplitudes, phases relative to the first, and chi2 per degree of freedom.

    Spark groups the light curves; only the small dense solve of one (object, band) runs in Python. Points without a
    positive error are left out.
    """
    names = [f"Harmonics_mag_{k}" for k in range(1, order + 1)] + [f"Harmonics_phase_{k}" for k in range(2, order + 1)] + ["Harmonics_mse", "Harmonics_chi"]

    def solve(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        n = len(pdf)
        if n <= 2 * order + 1:
            return pd.DataFrame([[*key, *[None] * len(names)]], columns=["oid", "fid", *names])
        t = 2 * np.pi * pdf["mjd"].to_numpy() / pdf["period"].iloc[0]
        x = np.column_stack([np.ones(n)] + [f(k * t) for k in range(1, order + 1) for f in (np.cos, np.sin)])
        m, w = pdf["mag"].to_numpy(), 1 / pdf["e_mag"].to_numpy()
        fit = np.linalg.lstsq(x * w[:, None], m * w, rcond=None)[0]
        c, s, res = fit[1::2], fit[2::2], m - x @ fit
        phase = np.arctan2(s, c)
        rel = np.mod(phase - phase[0] * np.arange(1, order + 1), 2 * np.pi)[1:]
        return pd.DataFrame([[*key, *np.hypot(c, s), *rel, float(np.mean(res**2)), float(np.sum((res * w) ** 2) / (n - 2 * order - 1))]], columns=["oid", "fid", *names])

    schema = "oid string, fid string, " + ", ".join(f"`{x}` double" for x in names)
    own = det.filter(~F.col("forced") & (F.col("e_mag") > 0) & F.col("mag").isNotNull() & F.col("mjd").isNotNull())
    return own.join(periods.filter("period > 0"), "oid").select("oid", "fid", "mjd", "mag", "e_mag", "period").groupBy("oid", "fid").applyInPandas(solve, schema)
