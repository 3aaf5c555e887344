"""Further light-curve statistics: autocorrelation, slots, power at two time scales, clipping, colours from catalogues."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyflow.functions.columns import missing
from skyflow.operators.curves import map_curves
from skyflow.operators.feature_kernel import Segments
from skyflow.operators.features import KEYS, MIN_POINTS, near_pairs


#: Points x slots looked at together.
CELLS = 1 << 20


def _own(det: DataFrame) -> DataFrame:
    return det.filter(~F.col("forced") & F.col("mag").isNotNull() & F.col("mjd").isNotNull())


def _each(data: dict[str, np.ndarray], starts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Times and centred magnitudes of each curve; a constant one has exact zeros."""
    for a, b in zip(starts, [*starts[1:], len(data["mag"])]):
        z = data["mag"][a:b] - data["mag"][a]
        yield data["mjd"][a:b], z - z.mean()


def autocor_length(det: DataFrame, level: float = 0.36787944117144233) -> DataFrame:
    """First lag whose autocorrelation falls below 1/e (n if none); all lags of a curve come from one Fourier transform."""

    def kernel(data: dict[str, np.ndarray], starts: np.ndarray) -> dict[str, np.ndarray]:
        out = []
        for _, z in _each(data, starts):
            n = len(z)
            wave = np.fft.rfft(z, 1 << (2 * n - 1).bit_length())
            lags = np.fft.irfft(wave * wave.conj())[1:n]
            below = np.flatnonzero(lags < level * float(z @ z))
            out.append(below[0] + 1 if len(below) and z.any() else n)
        return {"Autocor_length": np.array(out)}

    found = map_curves(_own(det), KEYS, ["mjd", "candid"], ["mjd", "mag"], kernel, "Autocor_length double", MIN_POINTS)
    return found.select(*KEYS, F.col("Autocor_length").cast("long").alias("Autocor_length"))


def _slot_means(t: np.ndarray, z: np.ndarray, slot: float, first: int, last: int) -> np.ndarray:
    """Mean product of the pairs in slots ``first`` to ``last`` - 1, each point with itself in slot 0; NaN without pairs.

    The partners of a point in a slot are a run of the sorted times, so a difference of running sums adds them up: the
    work is points x slots, not pairs.
    """
    total = np.append(0.0, np.cumsum(z))
    edges = (np.arange(first, last + 1) - 0.5) * slot
    at = np.searchsorted(t, t[:, None] + edges[None, :], "left")
    if first == 0:
        at[:, 0] = np.arange(len(t))  # slot 0 looks forward only
    at = np.maximum(at, np.arange(len(t))[:, None])
    pairs = np.diff(at, axis=1).sum(axis=0)
    products = z @ np.diff(total[at], axis=1)
    return np.where(pairs > 0, products / np.maximum(pairs, 1), np.nan)


def slotted_autocorrelation(det: DataFrame, slot: float = 1.0, slots: int = 100, first: int = 0) -> DataFrame:
    """Mean product of centred magnitudes of the pairs in each slot of time difference, in units of slot 0.

    Slots ``first`` to ``slots`` - 1; a slot without pairs has no row, a constant curve has nulls. Slot 0 has each point with
    itself too.
    """
    cells = CELLS

    def kernel(data: dict[str, np.ndarray], starts: np.ndarray) -> dict[str, np.ndarray]:
        curve, at, values = [], [], []
        for i, (t, z) in enumerate(_each(data, starts)):
            zero = _slot_means(t, z, slot, 0, 1)[0]
            last = min(slots, int((t[-1] - t[0]) / slot + 0.5) + 1)
            step = max(1, cells // len(t))
            for k in range(first, last, step):
                r = _slot_means(t, z, slot, k, min(last, k + step))
                has = np.flatnonzero(~np.isnan(r))
                curve.append(np.full(len(has), i))
                at.append(has + k)
                values.append(r[has] / zero if zero > 0 else np.full(len(has), np.nan))
        join = lambda x: np.concatenate(x) if x else np.zeros(0, np.int64)
        return {"curve": join(curve), "slot": join(at), "r": join(values)}

    rows = map_curves(_own(det), KEYS, ["mjd", "candid"], ["mjd", "mag"], kernel, "slot double, r double", MIN_POINTS)
    return rows.select(*KEYS, F.col("slot").cast("int").alias("slot"), "r")


def slotted_length(det: DataFrame, slot: float = 1.0, slots: int = 100, level: float = 0.36787944117144233) -> DataFrame:
    """First slot whose autocorrelation is below 1/e, times the slot; null where no slot of the light curve is below.

    ``slots`` are searched at once, as far as each light curve reaches.
    """
    cells = CELLS

    def kernel(data: dict[str, np.ndarray], starts: np.ndarray) -> dict[str, np.ndarray]:
        out = []
        for t, z in _each(data, starts):
            zero, last, found, k = _slot_means(t, z, slot, 0, 1)[0], int((t[-1] - t[0]) / slot + 0.5) + 1, np.nan, 0
            while zero > 0 and np.isnan(found) and k < last:
                step = min(last - k, slots, max(1, cells // len(t)))
                below = np.flatnonzero(_slot_means(t, z, slot, k, k + step) / zero < level)
                found = (k + below[0]) * slot if len(below) else np.nan
                k += step
            out.append(found)
        return {"SlottedA_length": np.array(out)}

    return map_curves(_own(det), KEYS, ["mjd", "candid"], ["mjd", "mag"], kernel, "SlottedA_length double", MIN_POINTS)


def stetson_k_ac(acf: DataFrame) -> DataFrame:
    """Stetson's K of the slotted autocorrelation: how peaked its values are about their mean."""
    z = F.col("r") - F.avg("r").over(Window.partitionBy(*KEYS))
    g = acf.withColumn("z", z).groupBy(*KEYS).agg(F.count("*").alias("n"), F.sum(F.abs("z")).alias("a"), F.sum(F.col("z") * F.col("z")).alias("q"))
    return g.select(*KEYS, F.when((F.col("n") > 1) & (F.col("q") > 0), F.col("a") / F.sqrt(F.col("n") * F.col("q"))).alias("StetsonK_AC"))


def mhps(det: DataFrame, t1: float = 100.0, t2: float = 10.0, dt: float = 5.0, eps: float = 1.0, unit: str = "magnitude", zero_point: float = 19.0) -> DataFrame:
    """Mexican-hat power at two time scales: ratio, low, high, points used, and whether noise exceeds the high one.

    Each scale filters with the difference of two normalised Gaussians, of widths s and (1 + eps) * s with
    s = 0.225 * scale / sqrt(1 + eps), over 6 s (6 dt at least) to each side. A point with at most three within
    two thirds of that, itself included, is left out. Power is relative to the squared mean, and less the squared
    relative mean error. ``diff_flux`` takes mag and e_mag as fluxes; magnitudes are made fluxes first.
    """
    own = det.filter(~F.col("forced")).select(*KEYS, F.col("mjd").alias("t"), "candid", "mag", "e_mag")
    if unit == "magnitude":
        flux = F.pow(F.lit(10.0), (zero_point - F.col("mag")) * 0.4)
        own = own.withColumns({"y": flux, "e": math.log(10) * 0.4 * flux * F.col("e_mag")})
    else:
        own = own.withColumns({"y": F.col("mag"), "e": F.col("e_mag")})
    mean = F.avg("y").over(Window.partitionBy(*KEYS))
    d = own.withColumn("mean", mean).withColumn("x", F.col("y") - F.col("mean"))
    out = None
    for name, scale in (("low", t1), ("high", t2)):
        c1 = 0.225 * scale / math.sqrt(1 + eps)
        c2 = (1 + eps) * c1
        reach = max(6 * c1, 6 * dt)
        grid = [reach * (k / 500 - 1) for k in range(1001)]
        bell = [[math.exp(-(t * t) / (2 * c * c)) for t in grid] for c in (c1, c2)]
        area = [sum(b) * reach / 500 for b in bell]
        norm = sum((x / area[0] - y / area[1]) ** 2 for x, y in zip(*bell)) * reach / 500
        b = d.select(*KEYS, F.col("t").alias("u"), F.col("x").alias("v"))
        p = near_pairs(d, b, KEYS, "t", "u", reach).withColumn("gap", F.abs(F.col("t") - F.col("u"))).filter(F.col("gap") < reach)
        w = [F.exp(-F.pow("gap", 2) / (2 * c * c)) for c in (c1, c2)]
        point = p.groupBy(*KEYS, "candid").agg(*((F.sum(v * F.col("v")) / F.sum(v)).alias(f"f{k}") for k, v in enumerate(w)), F.count(F.when(F.col("gap") <= reach / 3 * 2, 1)).alias("near"), F.first("mean").alias("mean"), F.first("e").alias("e")).filter("near > 3")
        power = F.try_divide(F.avg(F.pow(F.col("f0") - F.col("f1"), 2)) / norm, F.pow(F.first("mean"), 2))
        side = point.groupBy(*KEYS).agg(power.alias(f"__{name}"), F.count("*").alias(f"n_{name}"), F.pow(F.try_divide(F.avg("e"), F.first("mean")), 2).alias(f"__noise_{name}"))
        out = side if out is None else out.join(side, KEYS)
    noise = F.col("__noise_low")
    quiet = F.col("__high") > noise
    high = F.when(quiet, F.col("__high") - noise).otherwise(F.col("__high"))
    out = out.withColumns({"MHPS_low": F.col("__low") - noise, "MHPS_high": high})
    return out.select(*KEYS, (F.col("MHPS_low") / F.nullif("MHPS_high", F.lit(0.0))).alias("MHPS_ratio"), "MHPS_low", "MHPS_high", F.col("n_high").alias("MHPS_non_zero"), F.when(quiet, 0).otherwise(1).alias("MHPS_PN_flag"))


def sigma_clip(det: DataFrame, width: float = 3.0, column: str = "mag") -> DataFrame:
    """Two passes of clipping; ``clipped`` marks what lies outside."""
    g = Window.partitionBy(*KEYS)
    x = F.col(column)
    df = det.withColumn("__c", F.abs(x - F.avg(x).over(g)) > width * F.stddev_pop(x).over(g))
    y = F.when(~F.col("__c"), x)
    return df.withColumn("clipped", F.col("__c") | (F.abs(x - F.avg(y).over(g)) > width * F.stddev_pop(y).over(g))).drop("__c")


def robust_scale(det: DataFrame) -> DataFrame:
    """Weighted median, and the lesser of the weighted deviation and IQR / 1.349 (weights 1 / error^2) of each light curve.

    Points without a positive error are left out. A quantile lies between the two points whose cumulated weights (their own counted half) enclose it.
    """
    w = F.pow("e_mag", -2)
    g, o = Window.partitionBy(*KEYS), Window.partitionBy(*KEYS).orderBy("mag", "candid")
    d = _own(det).filter("e_mag > 0").withColumns({"w": w, "q": (F.sum(w).over(o.rowsBetween(Window.unboundedPreceding, 0)) - w / 2) / F.sum(w).over(g)})
    d = d.withColumns({"q0": F.lag("q").over(o), "m0": F.lag("mag").over(o), "mean": F.sum(F.col("w") * F.col("mag")).over(g) / F.sum("w").over(g)})

    def at(p: float) -> Column:
        inside = (F.col("q") >= p) & (F.col("q0") < p)
        between = F.try_divide(F.col("m0") * (F.col("q") - p) + F.col("mag") * (p - F.col("q0")), F.col("q") - F.col("q0"))
        below = F.max(F.when(F.col("q") < p, F.struct("q", "mag")))["mag"]
        return F.coalesce(F.min(F.when(inside, between)), F.min(F.when((F.col("q") >= p) & F.col("q0").isNull(), F.col("mag"))), below)

    std = F.sqrt(F.sum(F.col("w") * F.pow(F.col("mag") - F.col("mean"), 2)) / F.sum("w"))
    return d.groupBy(*KEYS).agg(at(0.5).alias("location"), F.least(std, (at(0.75) - at(0.25)) / 1.349).alias("scale"))


def eligible_bands(det: DataFrame, n: int) -> DataFrame:
    """Rows of bands with at least ``n`` detections, of objects with at least ``n`` in these bands."""
    own = det.filter(~F.col("forced")).withColumn("__n", F.count("*").over(Window.partitionBy(*KEYS))).filter(F.col("__n") >= n)
    return own.withColumn("__n", F.count("*").over(Window.partitionBy("oid"))).filter(F.col("__n") >= n).drop("__n")


def for_every_object(values: DataFrame, objects: DataFrame, key: str = "oid") -> DataFrame:
    """Values of all objects; nulls where an object was not eligible."""
    return objects.select(key).distinct().join(values, key, "left")


def chi2_tail(x: Column, k: Column, terms: int = 200) -> Column:
    """Chi-square CDF as a column, by the series of the regularised lower gamma function; far beyond its mean it is 1.

    ``terms`` are enough for some hundred degrees of freedom; ``chi2_cdf`` has no such bound.
    """
    a, h = k / 2, x / 2
    series = F.aggregate(F.sequence(F.lit(1), F.lit(terms)), F.struct(F.lit(1.0).alias("t"), F.lit(1.0).alias("s")), lambda acc, i: F.struct((acc["t"] * h / (a + i)).alias("t"), (acc["s"] + acc["t"] * h / (a + i)).alias("s")))["s"]
    # log gamma(a + 1): Stirling's series at a + 6, brought down by the recurrence
    z = a + 6
    gamma = (z - 0.5) * F.log(z) - z + 0.9189385332046727 + 1 / (12 * z) - 1 / (360 * F.pow(z, 3))
    for k in range(1, 6):
        gamma = gamma - F.log(a + k)
    return F.when(x <= 0, 0.0).when(h > a + 20 * F.sqrt(a) + 60, 1.0).otherwise(F.least(F.exp(a * F.log(h) - h - gamma) * series, F.lit(1.0)))


_log_gamma = np.vectorize(math.lgamma, otypes=[float])


def chi2_cdf(x: np.ndarray, k: np.ndarray) -> np.ndarray:
    """Chi-square CDF of ``k`` degrees of freedom: the series of the lower incomplete gamma function up to its mean, the
    continued fraction of the upper one beyond."""
    a, h = np.asarray(k, float) / 2, np.maximum(np.asarray(x, float) / 2, 0.0)
    front = np.exp(a * np.log(np.where(h > 0, h, 1)) - h - _log_gamma(a))
    low = h < a + 1
    term = total = 1 / a
    n = 0
    while (np.where(low, term, 0) > 1e-17 * total).any():
        n += 1
        term = np.where(low, term * h / (a + n), 0.0)
        total = total + term
    # modified Lentz steps
    b = h + 1 - a
    c, d = np.full(len(h), 1e300), 1 / np.where(b == 0, 1e-300, b)
    fraction = d
    for i in range(1, 1000):
        an = -i * (i - a)
        b = b + 2
        d = an * d + b
        d = 1 / np.where(np.abs(d) < 1e-300, 1e-300, d)
        c = b + an / c
        c = np.where(np.abs(c) < 1e-300, 1e-300, c)
        step = np.where(low, 1.0, d * c)
        fraction = fraction * step
        if (np.abs(step - 1) < 1e-15).all():
            break
    return np.where(h > 0, np.clip(np.where(low, front * total, 1 - front * fraction), 0.0, 1.0), 0.0)


def pvar(det: DataFrame) -> DataFrame:
    """Probability that a constant source varies less: chi-square CDF about the mean, of points with a positive error."""

    def kernel(data: dict[str, np.ndarray], starts: np.ndarray) -> dict[str, np.ndarray]:
        s = Segments(starts, len(data["mag"]))
        m = data["mag"] - data["mag"][starts][s.of]
        r = (m - (s.sum(m) / s.n)[s.of]) / data["e_mag"]
        return {"Pvar": chi2_cdf(s.sum(r * r), s.n - 1)}

    return map_curves(_own(det).filter("e_mag > 0"), KEYS, ["mjd", "candid"], ["mag", "e_mag"], kernel, "Pvar double", MIN_POINTS)


def allwise_colors(det: DataFrame, xmatch: DataFrame) -> DataFrame:
    """Catalogue colours and band mean minus catalogue magnitudes (w1 to w4)."""
    m = det.filter(~F.col("forced")).groupBy(*KEYS).agg(F.avg("mag").alias("m"))
    j = m.join(xmatch, "oid").withColumns({f"w{k}": missing(F.col(f"w{k}")) for k in range(1, 5)})
    return j.select(*KEYS, *((F.col(f"w{k}") - F.col(f"w{k + 1}")).alias(f"W{k}_W{k + 1}") for k in range(1, 4)), *((F.col("m") - F.col(f"w{k}")).alias(f"mean_W{k}") for k in range(1, 5)))


def panstarrs_colors(meta: DataFrame) -> DataFrame:
    c = {k: missing(F.col(k), -999.0) for k in ("sgscore1", "distpsnr1", "sgmag1", "srmag1", "simag1", "szmag1")}
    return meta.select("oid", c["sgscore1"].alias("sgscore1"), c["distpsnr1"].alias("dist_nr"), (c["sgmag1"] - c["srmag1"]).alias("ps_g_r"), (c["srmag1"] - c["simag1"]).alias("ps_r_i"), (c["simag1"] - c["szmag1"]).alias("ps_i_z"))


def unique_neighbour_flags(alerts: DataFrame, stored: DataFrame, column: str) -> DataFrame:
    """``unique`` is false where a stored row of the object has the alert's neighbour, to 1e-3; see ``commands.close_neighbours``."""
    from skyflow.operators.commands import close_neighbours

    return close_neighbours(alerts, stored, [column], ["unique"])[0]


def merge_references(new: DataFrame, stored: DataFrame) -> DataFrame:
    """References of the message first, then stored ones; one per (oid, rfid)."""
    both = new.withColumn("__p", F.lit(0)).unionByName(stored.withColumn("__p", F.lit(1)), allowMissingColumns=True)
    w = Window.partitionBy("oid", "rfid").orderBy("__p")
    return both.withColumn("__n", F.row_number().over(w)).filter("__n = 1").drop("__n", "__p")


def helio_correct(det: DataFrame) -> DataFrame:
    """Add the light-travel time to the Sun, from the low-precision solar position of the Astronomical Almanac; keeps ``mjd_original``."""
    n = F.col("mjd") - 51544.5
    g = F.radians(357.528 + 0.9856003 * n)
    lam = F.radians(280.460 + 0.9856474 * n) + F.radians(1.915 * F.sin(g) + 0.020 * F.sin(2 * g))
    r = 1.00014 - 0.01671 * F.cos(g) - 0.00014 * F.cos(2 * g)
    tilt = F.radians(F.lit(23.439))
    ra, dec = F.radians("ra"), F.radians("dec")
    along = F.cos(dec) * F.cos(ra) * F.cos(lam) + F.cos(dec) * F.sin(ra) * F.cos(tilt) * F.sin(lam) + F.sin(dec) * F.sin(tilt) * F.sin(lam)
    return det.withColumn("mjd_original", F.col("mjd")).withColumn("mjd", F.col("mjd") - r * along * 0.0057755183)
