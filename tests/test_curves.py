"""Light-curve kernels against one curve at a time, and on degenerate curves."""

import math
import random

import numpy as np
import pyarrow as pa
import pytest

from skyflow.operators import curves, features
from skyflow.operators.feature_kernel import NAMES

SCHEMA = "oid string, fid string, candid long, mjd double, mag double, e_mag double, forced boolean, isdiffpos int, ra double, dec double"


def rows_of(curve, oid, fid="g"):
    return [(oid, fid, k, t, m, e, False, 1, 10.0, 5.0) for k, (t, m, e) in enumerate(curve)]


def some_curves():
    r = random.Random(8)
    out = {}
    for k in range(12):
        n = r.choice([6, 7, 20, 33, 90])
        t = sorted(r.uniform(0, 40) for _ in range(n))
        out[f"c{k}"] = [(x, 15 + r.gauss(0, 0.3), r.uniform(0.01, 0.1)) for x in t]
    return out


DEGENERATE = {
    "constant": [(float(k), 15.1, 0.1) for k in range(8)],
    "one_time": [(3.0, 15 + 0.1 * k, 0.1) for k in range(8)],
    "zero_errors": [(float(k), 15 + (k * 7 % 5) / 10, 0.0) for k in range(8)],
    "pairs_of_times": [(float(k // 2), 15 + (k * 7 % 5) / 10, 0.1) for k in range(12)],
    "one_point": [(1.0, 15.0, 0.1)],
    "two_points": [(1.0, 15.0, 0.1), (1.0, 15.0, 0.0)],
    "no_values": [(float(k), None, None) for k in range(9)],
    "no_errors": [(float(k), 15 + (k * 7 % 5) / 10, None) for k in range(9)],
    "all_same": [(2.0, 15.0, 0.0)] * 9,
    "zero_mean": [(float(k), float(k % 2 * 2 - 1), 0.1) for k in range(8)],
}


@pytest.fixture(scope="module")
def degenerate(spark):
    return spark.createDataFrame([x for k, c in DEGENERATE.items() for x in rows_of(c, k)], SCHEMA)


def plain_features(curve):
    """Some features of one curve from their definitions."""
    t, m, e = (np.array(x) for x in zip(*curve))
    n, w = len(m), 1 / np.array([x[2] for x in curve]) ** 2
    mean, sd, med = m.mean(), m.std(), np.median(m)
    up = np.sort(m)
    s = np.cumsum(m - mean) / (n * sd)
    wm = (m * w).sum() / w.sum()
    sig = (m - wm) / e
    k = math.ceil(round(0.05 * n, 9))
    slope = np.abs(np.diff(m)) / np.diff(t)
    wt = 1 / np.diff(t) ** 2
    out = np.abs(m - mean) > 2 * sd
    z = np.sort((m - m.mean()) / m.std(ddof=1))
    phi = np.array([0.5 * (1 + math.erf(x / 2**0.5)) for x in z])
    i = np.arange(1, n + 1)
    a2 = -n - np.sum(((2 * i - 1) * np.log(phi) + (2 * (n - i) + 1) * np.log(1 - phi)) / n)
    return {
        "Amplitude": (np.median(up[-k:]) - np.median(up[:k])) / 2, "Rcs": s.max() - s.min(), "StetsonK": np.abs(sig).sum() / math.sqrt((sig**2).sum()) / math.sqrt(n), "Meanvariance": sd / mean, "Std": sd, "Mean": mean,
        "Con": sum(out[j] and out[j + 1] and out[j + 2] for j in range(n - 2)) / (n - 2), "Skew": np.mean(((m - mean) / sd) ** 3), "MaxSlope": slope.max(), "MedianAbsDev": np.median(np.abs(m - med)),
        "MedianBRP": np.mean((m > med - np.ptp(m) / 10) & (m < med + np.ptp(m) / 10)), "PercentAmplitude": np.abs(m - med).max() / med, "LinearTrend": np.polyfit(t, m, 1)[0], "Eta_e": (wt * np.diff(m) ** 2).sum() / wt.sum() / sd**2,
        "Q31": np.percentile(m, 75) - np.percentile(m, 25), "AndersonDarling": 1 / (1 + math.exp(-10 * (a2 - 0.3))), "Gskew": np.median(m[m <= np.percentile(m, 3)]) + np.median(m[m >= np.percentile(m, 97)]) - 2 * med,
        "ExcessVar": ((m - mean) ** 2 - e**2).sum() / n / mean**2, "Beyond1Std": np.mean(np.abs(m - wm) > math.sqrt(((m - wm) ** 2).sum() / (n - 1))), "PairSlopeTrend": (np.sum(np.diff(m[-30:]) > 0) - np.sum(np.diff(m[-30:]) <= 0)) / 30,
    }


@pytest.mark.parametrize("part", [1 << 16, 1])
def test_features_of_many_curves_are_those_of_each(spark, monkeypatch, part):
    monkeypatch.setattr(curves, "CURVE_ROWS", part)
    own = some_curves()
    df = spark.createDataFrame([x for k, c in own.items() for x in rows_of(c, k)], SCHEMA).repartition(5)
    got = {r.oid: r.asDict() for r in features.basic_features(df).collect()}
    assert got.keys() == own.keys()
    for k, c in own.items():
        for name, want in plain_features(c).items():
            assert got[k][name] == pytest.approx(want, rel=1e-5, abs=1e-8), (k, name)


def test_batches_are_cut_where_curves_end():
    r = random.Random(1)
    keys = [None] * 3 + ["a"] * 4 + ["b"] * 1 + ["c"] * 17 + ["d"] * 2
    for _ in range(60):
        at, batches = 0, []
        while at < len(keys):
            n = r.randint(1, 6)
            batches.append(pa.RecordBatch.from_arrays([pa.array(keys[at : at + n], pa.string()), pa.array(range(at, at + len(keys[at : at + n])))], ["k", "i"]))
            at += n
        tables = list(curves.whole_curves(iter(batches), 1, r.randint(1, 12)))
        assert [i for t in tables for i in t.column("i").to_pylist()] == list(range(len(keys)))
        seen = [set(t.column("k").to_pylist()) for t in tables]
        assert sum(map(len, seen)) == len(set().union(*seen))
        for t in tables:
            k = t.column("k").to_pylist()
            assert curves.starts_of(t, 1).tolist() == [i for i in range(len(k)) if i == 0 or k[i] != k[i - 1]]


def test_degenerate_curves_have_null_features(degenerate):
    got = {r.oid: r.asDict() for r in features.basic_features(degenerate).collect()}
    assert set(got) == {k for k, c in DEGENERATE.items() if sum(m is not None for _, m, _ in c) >= 6}
    nulls = {k: {f for f in NAMES if v[f] is None} for k, v in got.items()}
    spread = {"Rcs", "SmallKurtosis", "Skew", "Eta_e", "AndersonDarling"}
    assert spread <= nulls["constant"] and "MaxSlope" not in nulls["constant"] and got["constant"]["Std"] == 0 and got["constant"]["Gskew"] == 0
    assert {"MaxSlope", "Eta_e", "LinearTrend"} <= nulls["one_time"] and got["one_time"]["Rcs"] is not None
    assert {"StetsonK", "Beyond1Std"} <= nulls["zero_errors"] and "Skew" not in nulls["zero_errors"]
    assert {"StetsonK", "ExcessVar"} <= nulls["no_errors"] and "Std" not in nulls["no_errors"]
    assert {"Meanvariance", "ExcessVar"} <= nulls["zero_mean"]
    assert got["pairs_of_times"]["MaxSlope"] is not None
    assert all(v is None or math.isfinite(v) for r in got.values() for f, v in r.items() if f in NAMES)


def test_every_operator_survives_degenerate_curves(spark, degenerate):
    from skyflow.operators import feature_sets, fits, ingest, period
    from skyflow.operators import variability as v

    det = degenerate.unionByName(spark.createDataFrame(rows_of(some_curves()["c4"], "good"), SCHEMA))
    objects = det.select("oid").distinct()
    periods = spark.createDataFrame([(k, 1.5) for k in [*DEGENERATE, "good"]] + [("good", 0.0)], "oid string, period double")
    grid = period.frequency_spec(det, 0.5, 10.0, least=20)
    power = period.mhaov_multiband(det, grid)
    bands = period.mhaov(det, grid)
    slots = v.slotted_autocorrelation(det)
    found = {
        "structure": features.structure_function(det), "indices": features.structure_function_indices(det), "pvar": v.pvar(det), "autocor": v.autocor_length(det), "slots": slots, "slotted": v.slotted_length(det), "k_ac": v.stetson_k_ac(slots),
        "mhps": v.mhps(det), "clip": v.sigma_clip(det), "scale": v.robust_scale(det), "tail": features.tde_tail(det), "sn": features.sn_features(det), "variation": features.color_variation(det, "g", "r"), "kim": features.folded_kim(det, periods),
        "harmonics": features.harmonics(det, periods), "xyz": features.coordinates_xyz(det), "colors": features.colors(det, "g", "r"), "mhaov": bands, "multiband": period.multiband(bands), "periods": period.period_features(power),
        "rates": period.power_rates(power), "pdm": period.pdm(det, grid), "aov": period.aov(det, grid), "weighted": period.aov(det, grid, weighted=True), "string": period.string_length(det, grid), "qmi": period.qmi(det, grid),
        "fleet": fits.fit_fleet(det), "lens": fits.fit_microlensing(det), "spm": fits.fit_supernova(det), "drw": fits.fit_drw(det), "iar": fits.fit_iar_phi(det), "ciar": fits.fit_ciar(det), "same": ingest.drop_same_mjd(det),
    }
    rows = {k: df.collect() for k, df in found.items()}
    for k, own in rows.items():
        assert any(r.oid == "good" for r in own) or k in ("variation", "colors"), k
    assert {r.oid: r.Autocor_length for r in rows["autocor"]}["constant"] == 8
    assert {r.oid: r.SlottedA_length for r in rows["slotted"]}["constant"] is None
    assert all(r.power is None for r in rows["qmi"] if r.oid in ("constant", "all_same")) and any(r.power is not None for r in rows["qmi"] if r.oid == "good")
    assert all(r.Psi_CS is None for r in rows["kim"] if r.oid == "constant") and not {"constant", "all_same"} & {r.oid for r in rows["iar"]}
    assert feature_sets.feature_set(det, "ztf", ["g", "r"], ["turbo", "mhps", "period", "folded_kim", "harmonics"]).select("oid").distinct().count() >= objects.count() - 3


def test_autocorrelations_against_all_pairs(spark):
    from skyflow.operators import variability as v

    own = some_curves() | {"even": [(float(k), 15 + math.sin(k), 0.1) for k in range(12)], "halves": [(k / 2, 15 + math.cos(k * k), 0.1) for k in range(12)] + [(5.5, 15.5, 0.1), (5.5, 14.2, 0.1)]}
    df = spark.createDataFrame([x for k, c in own.items() for x in rows_of(c, k)], SCHEMA)
    acf = {}
    for r in v.slotted_autocorrelation(df, 1.0, 1000).collect():
        acf.setdefault(r.oid, {})[r.slot] = r.r
    lengths = {r.oid: r.SlottedA_length for r in v.slotted_length(df, 1.0, 3).collect()}
    lags = {r.oid: r.Autocor_length for r in v.autocor_length(df).collect()}
    for k, c in own.items():
        t, z = np.array([x[0] for x in c]), np.array([x[1] for x in c])
        z = z - z.mean()
        pairs = {}
        for i in range(len(t)):
            for j in range(i, len(t)):
                pairs.setdefault(math.floor(t[j] - t[i] + 0.5), []).append(z[i] * z[j])
        want = {s: np.mean(p) / np.mean(pairs[0]) for s, p in pairs.items()}
        assert acf[k] == pytest.approx(want, abs=1e-9)
        assert lengths[k] == next((float(s) for s in sorted(want) if want[s] < math.exp(-1)), None)
        assert lags[k] == next((s for s in range(1, len(z)) if z[:-s] @ z[s:] < math.exp(-1) * (z @ z)), len(z))


@pytest.mark.parametrize("kernel", ["gaussian", "cauchy"])
@pytest.mark.parametrize("n", [5, 40, 700])
def test_expanded_kernels_against_all_pairs(kernel, n):
    from skyflow.operators import spectral

    r = np.random.default_rng(n)
    t, y = np.sort(r.uniform(0, 50, n)), r.normal(0, 3, n)
    f = np.array([0.013, 0.4, 1.7, 1.9, 9.1])
    j, m, p, c = spectral.mutual_information(t, y, f, 0.4, kernel, 1e-10)
    km = np.exp(-((y[:, None] - y) ** 2) / 4) if kernel == "gaussian" else 1 / (1 + ((y[:, None] - y) / 2) ** 2)
    assert m == pytest.approx(km.sum(), abs=1e-9 * n * n)
    for k, x in enumerate(f):
        kp = np.exp((np.cos(2 * np.pi * x * (t[:, None] - t)) - 1) / 0.16)
        assert (j[k], p[k], c[k]) == pytest.approx(((km * kp).sum(), kp.sum(), (km.sum(axis=1) * kp.sum(axis=1)).sum()), rel=1e-8)


def test_waves_by_recurrence():
    from skyflow.operators import spectral

    r = np.random.default_rng(3)
    t = r.uniform(0, 2000, 50)
    for f in (np.linspace(0.01, 22.0, 256), np.linspace(3, 3.0001, 7), np.sort(r.uniform(0, 9, 64)), np.array([1.5]), np.linspace(0.2, 5.0, 101)):
        assert np.abs(spectral.turns(t, f) - np.exp(2j * np.pi * np.outer(t, f))).max() < 1e-9


def test_refined_fits_are_no_worse_than_the_grid_and_find_the_truth(spark):
    from skyflow.operators import fits

    r = random.Random(2)
    grow = lambda t, a, w, m0, t0: math.exp(w * (t - t0)) - a * w * (t - t0) + m0

    def flux(t, a, t0, gamma, beta, rise, fall):
        dt = t - t0
        return a * (1 - beta * dt / gamma if dt < gamma else (1 - beta) * math.exp(-(dt - gamma) / fall)) / (1 + math.exp(-dt / rise))

    own = some_curves()
    own |= {f"fleet{k}": [(float(x), grow(float(x), 0.8 + k, -0.07, 15, 12.0) + r.gauss(0, 0.01), 0.01) for x in np.linspace(0, 60, 50)] for k in range(3)}
    sn = (400.0, 0.0, 25.0, 0.4, 3.0, 30.0)
    own["sn"] = [(float(x), 23.9 - 2.5 * math.log10(max(flux(x, *sn), 1e-3)) + r.gauss(0, 0.005), 0.01) for x in np.linspace(-8, 120, 90)]
    df = spark.createDataFrame([x for k, c in own.items() for x in rows_of(c, k)], SCHEMA)
    for fit, chi in ((fits.fit_fleet, "fleet_chi"), (fits.fit_microlensing, "ulens_chi"), (fits.fit_supernova, "SPM_chi"), (fits.fit_drw, "GP_DRW_nll")):
        coarse, fine = ({x.oid: x.asDict() for x in fit(df, refine=k).collect()} for k in (False, True))
        assert coarse.keys() == fine.keys() and len(fine) > 3
        assert all(fine[k][chi] <= coarse[k][chi] * (1 + 1e-9) + 1e-9 for k in fine), chi
        assert sum(fine[k][chi] < coarse[k][chi] for k in fine) > len(fine) / 2
        if chi == "fleet_chi":
            assert all(fine[f"fleet{k}"][chi] < 2 for k in range(3))
        if chi == "SPM_chi":
            x = fine["sn"]
            assert (x["SPM_A"], x["SPM_gamma"], x["SPM_beta"], x["SPM_tau_rise"], x["SPM_tau_fall"]) == pytest.approx((400, 25, 0.4, 3, 30), rel=0.1) and abs(x["SPM_t0"]) < 1


def test_steps_against_closed_form_and_bounds():
    from skyflow.operators.feature_kernel import Segments
    from skyflow.operators.least_squares import fit_bounded, walk_cost

    r = np.random.default_rng(5)
    sizes = np.array([5, 9, 30])
    starts, rows = np.cumsum(sizes) - sizes, int(sizes.sum())
    s = Segments(starts, rows)
    x, y, w = r.uniform(-3, 3, rows), r.normal(0, 1, rows), r.uniform(0.5, 2, rows)
    line = lambda p: p[0] + p[1] * x
    free = np.full((3, 2), np.inf)
    p, chi = fit_bounded(line, np.zeros((3, 2)), -free, free, s, y, w)
    for k, (a, n) in enumerate(zip(starts, sizes)):
        own = slice(a, a + n)
        want = np.polyfit(x[own], y[own], 1, w=np.sqrt(w[own]))[::-1]
        assert p[k] == pytest.approx(want, abs=1e-5) and chi[k] == pytest.approx((w[own] * (y[own] - want[0] - want[1] * x[own]) ** 2).sum(), rel=1e-8)
    p, _ = fit_bounded(line, np.zeros((3, 2)), np.array([[-0.01, -0.02]] * 3), np.array([[0.01, 0.02]] * 3), s, y, w)
    assert (np.abs(p) <= [0.01, 0.02]).all()
    # the filter's cost is that of the whole covariance
    t, e = np.sort(r.uniform(0, 20, 12)), r.uniform(0.05, 0.2, 12)
    m = r.normal(0, 0.5, 12)
    for sigma, tau in ((0.3, 2.0), (1.0, 15.0)):
        cov = sigma**2 * np.exp(-np.abs(t[:, None] - t) / tau) + np.diag(e**2)
        want = 0.5 * (np.linalg.slogdet(cov)[1] + m @ np.linalg.solve(cov, m))
        assert walk_cost(t, m, e, np.array([sigma]), np.array([tau]))[0] == pytest.approx(want)


def test_chi_square_against_known_values():
    from skyflow.operators.variability import chi2_cdf

    # two degrees of freedom have a closed form; others by their densities' integral
    x = np.array([0.0, 0.1, 1.0, 5.0, 40.0, 4000.0])
    assert chi2_cdf(x, np.full(6, 2)) == pytest.approx(1 - np.exp(-x / 2))
    for k in (1, 5, 30, 400):
        for top in (0.3 * k, float(k), 1.7 * k, 60.0 * k):
            u = np.linspace(1e-9, math.sqrt(top), 400_001)  # x = u^2 takes the pole away
            y = 2 * u ** (k - 1) * np.exp(-(u**2) / 2 - math.lgamma(k / 2) - k / 2 * math.log(2)) if k < 100 else 2 * np.exp((k - 1) * np.log(u) - u**2 / 2 - math.lgamma(k / 2) - k / 2 * math.log(2))
            assert chi2_cdf(np.array([top]), np.array([k]))[0] == pytest.approx(float(((y[1:] + y[:-1]) / 2 * np.diff(u)).sum()), abs=1e-7)
