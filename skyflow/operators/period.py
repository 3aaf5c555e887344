"""Period search: every object meets the blocks of its own frequency grid, and numpy kernels give the power of a block.

A row is one object's points with one block of BLOCK frequencies, so a fine grid is spread over many tasks and
nothing is ever crossed as rows: a kernel works on matrices of points x frequencies, a bounded number of cells at a time.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyflow.operators.curves import finite
from skyflow.operators.spectral import band_harmonics, bin_sums, mutual_information, string_lengths

BLOCK = 256
TWO_PI = 6.283185307179586
KEYS = ["oid", "block", "k", "freq"]
#: Cells of a points x frequencies matrix, and result rows sent back to Spark at once.
CELLS, SENT_ROWS = 1 << 20, 1 << 15


def frequency_spec(obs: DataFrame, pmin: float, pmax: float, shift: float = 0.1, least: int = 1000) -> DataFrame:
    """(oid, t0, n, lo, hi): each object's grid of n = max(least, ceil(range * timespan / (2 * shift))) equal steps from lo = 1 / pmax to hi = 1 / pmin."""
    lo, hi = 1 / pmax, 1 / pmin
    span = obs.groupBy("oid").agg((F.max("mjd") - F.min("mjd")).alias("span"), F.min("mjd").alias("t0"))
    n = F.greatest(F.lit(least), F.ceil((hi - lo) * F.col("span") / (2 * shift)).cast("int"))
    return span.select("oid", "t0", n.alias("n"), F.lit(lo).alias("lo"), F.lit(hi).alias("hi"))


def _frequency(k: Column) -> Column:
    return F.col("lo") + k * (F.col("hi") - F.col("lo")) / (F.col("n") - 1)


def frequency_grid(obs: DataFrame, pmin: float, pmax: float, shift: float = 0.1, least: int = 1000) -> DataFrame:
    """The rows (oid, t0, block, k, freq) of ``frequency_spec``; the searches take either form."""
    rows = frequency_spec(obs, pmin, pmax, shift, least).withColumn("k", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    return rows.select("oid", "t0", F.expr(f"k div {BLOCK}").cast("int").alias("block"), "k", _frequency(F.col("k")).alias("freq"))


def _dealt(obs: DataFrame, grid: DataFrame) -> DataFrame:
    """(oid, block, t0, ks, freqs, points): each object's detections, by candid, with each block of its grid."""
    own = obs.filter(~F.col("forced") & F.col("mag").isNotNull() & F.col("mjd").isNotNull())
    points = own.groupBy("oid").agg(F.sort_array(F.collect_list(F.struct("candid", "mjd", "mag", "e_mag", "fid"))).alias("p"))
    width = int(obs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if "freq" not in grid.columns:
        blocks = F.explode(F.sequence(F.lit(0), F.expr(f"cast((n - 1) div {BLOCK} as int)")))
        rows = points.join(grid, "oid").withColumn("block", blocks).repartition(width, "oid", "block")
        rows = rows.withColumn("ks", F.sequence(F.col("block") * BLOCK, F.least((F.col("block") + 1) * BLOCK, F.col("n")) - 1)).withColumn("freqs", F.transform("ks", _frequency))
    else:
        t0 = F.first("t0") if "t0" in grid.columns else F.lit(0.0)
        blocks = grid.groupBy("oid", "block").agg(t0.alias("t0"), F.sort_array(F.collect_list(F.struct("k", "freq"))).alias("g"))
        rows = points.join(blocks, "oid").repartition(width, "oid", "block").withColumns({"ks": F.col("g.k"), "freqs": F.col("g.freq")})
    return rows.select("oid", "block", "t0", F.col("ks").cast("array<int>").alias("ks"), "freqs", F.col("p.mjd").alias("mjd"), F.col("p.mag").alias("mag"), F.col("p.e_mag").alias("e_mag"), F.col("p.fid").alias("fid"))


#: (times from t0, magnitudes, errors, band codes, number of bands, frequencies) to arrays of bands x frequencies, or of frequencies.
Kernel = Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int, np.ndarray], dict[str, np.ndarray] | None]


def _search(obs: DataFrame, grid: DataFrame, kernel: Kernel, values: list[str], by_band: bool = False) -> DataFrame:
    """Rows (oid, [fid,] block, k, freq, *values) of a kernel that gives ``values`` for each frequency (of each band)."""
    dealt = _dealt(obs, grid)
    names = ["oid", *(["fid"] if by_band else []), "block", "k", "freq", *values]
    kinds = dict(dealt.dtypes)
    schema = ", ".join([f"oid {kinds['oid']}"] + ([f"fid {kinds['fid'][6:-1]}"] if by_band else []) + ["block int, k int, freq double"] + [f"{v} double" for v in values])
    cells, sent = CELLS, SENT_ROWS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = {c: b.column(c) for c in ("ks", "freqs", "mjd", "mag", "e_mag", "fid")}
            ends = {c: np.asarray(v.offsets) for c, v in lists.items()}
            flat = {c: (lists[c].values if c in ("fid", "ks") else pc.cast(lists[c].values, pa.float64()).to_numpy(zero_copy_only=False)) for c in lists}
            t0, ready, size = b.column("t0").to_numpy(zero_copy_only=False), [], 0
            for i in range(b.num_rows):
                part = {c: flat[c][ends[c][i] : ends[c][i + 1]] if c not in ("fid", "ks") else flat[c].slice(ends[c][i], ends[c][i + 1] - ends[c][i]) for c in flat}
                bands = pc.unique(part["fid"])
                codes = pc.index_in(part["fid"], bands).to_numpy(zero_copy_only=False)
                freqs = part["freqs"]
                step = max(1, cells // max(len(codes), 1))
                with np.errstate(all="ignore"):
                    outs = [kernel(part["mjd"] - t0[i], part["mag"], part["e_mag"], codes, len(bands), freqs[k : k + step]) for k in range(0, len(freqs), step)]
                if outs and outs[0] is not None:
                    ready.append((i, bands, part["ks"], freqs, {v: np.concatenate([np.atleast_2d(o[v]) for o in outs], axis=1) for v in values}))
                    size += ready[-1][4][values[0]].size
                if ready and (size >= sent or i == b.num_rows - 1):
                    yield _rows(b, ready)
                    ready, size = [], 0
            if ready:
                yield _rows(b, ready)

    def _rows(b: pa.RecordBatch, ready: list) -> pa.RecordBatch:
        times = [len(r[4][values[0]]) for r in ready]
        at = pa.array(np.repeat([r[0] for r in ready], [n * len(r[3]) for n, r in zip(times, ready)]))
        cols = [b.column("oid").take(at)]
        if by_band:
            cols.append(pa.concat_arrays([r[1].take(pa.array(np.repeat(np.arange(n), len(r[3])))) for n, r in zip(times, ready)]))
        cols += [b.column("block").take(at), pa.concat_arrays([x for n, r in zip(times, ready) for x in [r[2]] * n]), pa.array(np.concatenate([np.tile(r[3], n) for n, r in zip(times, ready)]))]
        return pa.RecordBatch.from_arrays(cols + [finite(np.concatenate([r[4][v].ravel() for r in ready])) for v in values], names)

    return dealt.mapInArrow(run, schema)


def mhaov(obs: DataFrame, grid: DataFrame, harmonics: int = 1) -> DataFrame:
    """Per band: sum of squares that a Fourier series explains (``power``), about the weighted mean (``wvar``),
    degrees of freedom ``d2``, and their variance ratio (``ratio``). Bands add up in ``multiband``.

    Points without a positive error are left out. The normal equations are centred and solved by a Cholesky factor,
    column by column.
    """

    def kernel(t, m, e, codes, bands, freqs):
        x = band_harmonics(t, m, e, codes, bands, freqs, harmonics)
        wide = lambda v: np.repeat(v[:, None], len(freqs), axis=1)
        return {"power": x["power"], "wvar": wide(x["wvar"]), "d2": wide(x["d2"]), "n": wide(x["n"])}

    out = _search(obs, grid, kernel, ["power", "wvar", "d2", "n"], by_band=True).filter("n > 0")
    return out.select("oid", "fid", *KEYS[1:], "power", "wvar", "d2", F.lit(2.0 * harmonics).alias("d1")).withColumn("ratio", _ratio())


def mhaov_multiband(obs: DataFrame, grid: DataFrame, harmonics: int = 1) -> DataFrame:
    """``multiband(mhaov(...))`` without a row for each band: the bands are added up where they are computed."""

    def kernel(t, m, e, codes, bands, freqs):
        x = band_harmonics(t, m, e, codes, bands, freqs, harmonics)
        if not x["n"].any():
            return None
        power = x["power"].sum(axis=0)
        return {"power": x["d2"].sum() * power / (2 * harmonics * np.maximum(x["wvar"].sum() - power, 1e-9))}

    return _search(obs, grid, kernel, ["power"])


def _ratio() -> Column:
    return F.col("d2") * F.col("power") / (F.col("d1") * F.greatest(F.col("wvar") - F.col("power"), F.lit(1e-9)))


def multiband(bands: DataFrame) -> DataFrame:
    """Variance ratio of all bands together: their explained sums, variances and degrees of freedom add up."""
    total = bands.groupBy(*KEYS).agg(F.sum("power").alias("power"), F.sum("wvar").alias("wvar"), F.sum("d2").alias("d2"), F.first("d1").alias("d1"))
    return total.select(*KEYS, _ratio().alias("power"))


def pdm(obs: DataFrame, grid: DataFrame, bins: int = 8) -> DataFrame:
    """Phase dispersion over bins with more than two points: pooled bin variance over total variance; null where no bin
    has so many, or without any variance."""

    def kernel(t, m, e, codes, bands, freqs):
        c = m - m[:1]
        n, total, squares = bin_sums(t, freqs, bins, [None, c, c * c])
        full = n > 2
        inside = np.where(full, squares - total * total / np.maximum(n, 1), 0.0).sum(axis=1)
        free = np.where(full, n - 1, 0).sum(axis=1)
        return {"theta": np.where(free > 0, inside / np.maximum(free, 1), np.nan) / (np.var(c, ddof=1) if len(c) > 1 and np.ptp(c) > 0 else np.nan)}

    return _search(obs, grid, kernel, ["theta"]).drop("block")


def aov(obs: DataFrame, grid: DataFrame, bins: int = 8, weighted: bool = False) -> DataFrame:
    """Analysis of variance over phase bins: between-bin against within-bin variance; bin and total means weighted or not.

    No row where fewer than two bins are filled or none has a second point; null where no bin has any variance.
    """

    def kernel(t, m, e, codes, bands, freqs):
        w = np.where(e > 0, e, np.nan) ** -2.0 if weighted else np.ones(len(m))
        c = m - m[:1]
        n, total, squares, wy, ws = bin_sums(t, freqs, bins, [None, c, c * c, w * c, w])
        filled = n > 0
        mean = np.where(filled, wy / np.where(filled, ws, 1), 0.0)
        middle = (wy.sum(axis=1) / ws.sum(axis=1))[:, None]
        between = (n * (mean - middle) ** 2).sum(axis=1)
        inside = np.where(filled, squares - 2 * mean * total + n * mean * mean, 0.0).sum(axis=1)
        r, all_n = filled.sum(axis=1), n.sum(axis=1)
        spread = inside > 1e-12 * max(float((c * c).sum()), 1e-300)
        return {"power": np.where(spread, between / (r - 1) / np.where(spread, inside / (all_n - r), 1), np.nan), "kept": ((all_n > r) & (r > 1)).astype(float)}

    return _search(obs, grid, kernel, ["power", "kept"]).filter("kept = 1").drop("block", "kept")


def string_length(obs: DataFrame, grid: DataFrame) -> DataFrame:
    """Error-weighted squared neighbour differences in phase order (ties by candid), wrap-around included; pairs without
    an error are left out."""
    return _search(obs, grid, lambda t, m, e, codes, bands, freqs: {"length": string_lengths(t, m, e, freqs)}, ["length"]).drop("block")


def qmi(obs: DataFrame, grid: DataFrame, mode: str = "cauchy_schwarz", h_phase: float = 0.4, kernel: str = "gaussian", error: float = 1e-10) -> DataFrame:
    """Quadratic mutual information of phase and magnitude per frequency, with a periodic kernel in phase.

    ``mode`` is cauchy_schwarz, euclidean or entropy; ``kernel`` (of magnitude) gaussian or cauchy. The kernels are
    expanded, in phase as a Fourier series and in magnitude by Chebyshev interpolation, so the sums over all pairs are linear
    in points; ``error`` bounds what either expansion of a kernel (at most 1) may miss. Constant magnitudes give null.
    """

    def value(t, m, e, codes, bands, freqs):
        n = len(m)
        h = 0.9 * np.std(m) * n**-0.2
        if not h > 0:
            return {"power": np.full(len(freqs), np.nan)}
        j, mm, pp, c = mutual_information(t, m / h, freqs, h_phase, kernel, error)
        vj, vm, vc = j / n**2, mm * pp / n**4, c / n**3
        return {"power": {"cauchy_schwarz": lambda: np.log(vj * vm / vc**2), "euclidean": lambda: vj + vm - 2 * vc, "entropy": lambda: np.abs(np.log(vj) - np.log(vm))}[mode]()}

    return _search(obs, grid, value, ["power"]).drop("block")


def local_maxima(power: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` highest grid points that exceed both neighbours."""
    o = Window.partitionBy("oid").orderBy("k")
    p = power.withColumns({"__a": F.lag("power").over(o), "__b": F.lead("power").over(o), "before": F.lag("freq").over(o), "after": F.lead("freq").over(o)})
    p = p.filter("power > __a and power > __b").drop("__a", "__b")
    return p.withColumn("rank", F.row_number().over(Window.partitionBy("oid").orderBy(F.col("power").desc(), "k"))).filter(F.col("rank") <= n)


def refine(obs: DataFrame, grid: DataFrame, bands: DataFrame, peaks: int = 10, finer: int = 10, harmonics: int = 1) -> tuple[DataFrame, DataFrame]:
    """(multiband power, power by band) with the best local maxima searched on a grid ``finer`` times as fine.

    Around each maximum 2 * finer points lie between its neighbours; where the best of them has more power than
    the grid point it takes its place. Both results keep every other grid point.
    """
    power = mhaov_multiband(obs, grid, harmonics)
    steps = 2 * finer
    near = local_maxima(power, peaks).select("oid", "k", F.col("power").alias("coarse"), "before", "after")
    start = grid.groupBy("oid").agg(F.first("t0").alias("t0"))
    j = F.explode(F.sequence(F.lit(0), F.lit(steps - 1))).alias("j")
    fine = near.join(start, "oid").select("*", j).select("oid", "t0", F.col("k").alias("block"), "j", (F.col("before") + F.col("j") * (F.col("after") - F.col("before")) / (steps - 1)).alias("freq"), "coarse")
    fine = fine.select("oid", "t0", "block", F.col("j").alias("k"), "freq")
    fine_bands = mhaov(obs, fine, harmonics)
    best = mhaov_multiband(obs, fine, harmonics).groupBy("oid", "block").agg(F.max_by(F.struct("k", "freq", "power"), F.struct("power", -F.col("k"))).alias("b"))
    won = best.join(near.select("oid", F.col("k").alias("block"), "coarse"), ["oid", "block"]).filter("b.power > coarse").select("oid", F.col("block").alias("k"), "b")
    out = power.join(won, ["oid", "k"], "left").select("oid", "block", "k", F.coalesce("b.freq", "freq").alias("freq"), F.coalesce("b.power", "power").alias("power"))
    chosen = won.select("oid", F.col("k").alias("block"), F.col("b.k").alias("k"))
    side = fine_bands.join(chosen, ["oid", "block", "k"]).select("oid", "fid", F.col("block").alias("k"), F.col("freq").alias("__freq"), F.col("ratio").alias("__ratio"))
    by_band = bands.join(side, ["oid", "fid", "k"], "left").select("oid", "fid", "block", "k", F.coalesce("__freq", "freq").alias("freq"), F.coalesce("__ratio", "ratio").alias("ratio"))
    return out, by_band


def period_features(power: DataFrame, top: int = 100) -> DataFrame:
    """Multiband period, its power, and PPE: 1 - entropy / log(top) of the largest powers, each + 0.01."""
    w = Window.partitionBy("oid").orderBy(F.col("power").desc(), "k")
    t = power.withColumn("r", F.row_number().over(w)).filter(F.col("r") <= top).withColumn("q", F.col("power") + 0.01)
    share = F.col("q") / F.sum("q").over(Window.partitionBy("oid"))
    best = F.max_by("freq", F.struct("power", -F.col("k")))
    return t.withColumn("p", share).groupBy("oid").agg((1 / best).alias("period"), F.max("power").alias("peak"), (1 + F.sum(F.col("p") * F.log("p")) / F.log(F.lit(float(top)))).alias("ppe"))


def band_periods(bands: DataFrame, periods: DataFrame) -> DataFrame:
    """Each band's own best period and its distance from the object's."""
    best = bands.groupBy("oid", "fid").agg((1 / F.max_by("freq", F.struct("ratio", -F.col("k")))).alias("Period_band"))
    return best.join(periods.select("oid", "period"), "oid").select("oid", "fid", "Period_band", F.abs(F.col("period") - F.col("Period_band")).alias("delta_period"))


RATES = ((0.25, "1/4"), (1 / 3, "1/3"), (0.5, "1/2"), (2.0, "2"), (3.0, "3"), (4.0, "4"))


def power_rates(power: DataFrame) -> DataFrame:
    """Power at 1/4, 1/3, 1/2, 2, 3 and 4 times the best period over the peak's, at the nearest grid point; null without a peak."""
    best = power.groupBy("oid").agg(F.max(F.struct("power", (-F.col("k")).alias("nk"), "freq")).alias("b"), F.min("freq").alias("f0"), F.max("freq").alias("f1"), F.max("k").alias("last"))
    rates = F.explode(F.array(*(F.struct(F.lit(x).alias("times"), F.lit(y).alias("name")) for x, y in RATES)))
    want = best.withColumn("x", rates).withColumn("f", F.col("b.freq") / F.col("x.times"))
    guess = F.round(F.coalesce(F.try_divide(F.col("f") - F.col("f0"), F.col("f1") - F.col("f0")), F.lit(0.0)) * F.col("last")).cast("int")
    guess = F.least(F.greatest(guess, F.lit(0)), F.col("last"))
    # a refined point may lie off the even grid, so the neighbours are looked at too
    near = want.select("oid", "x.name", F.col("b.power").alias("peak"), "f", "last", F.explode(F.array(guess - 1, guess, guess + 1)).alias("k")).filter("k between 0 and last")
    met = near.join(power.select("oid", "k", "freq", "power"), ["oid", "k"])
    found = met.groupBy("oid", "name", "peak").agg(F.min_by("power", F.struct(F.round(F.abs(F.col("freq") - F.col("f")), 12), "k")).alias("power"))
    return found.select("oid", "name", F.try_divide("power", "peak").alias("rate"))


# --- whole objects ------------------------------------------------------------------


def _maxima(power: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` highest places that exceed both neighbours; of equal ones the first."""
    k = 1 + np.flatnonzero((power[1:-1] > power[:-2]) & (power[1:-1] > power[2:]))
    return k[np.argsort(-power[k], kind="stable")[:n]]


def _highest(x: np.ndarray) -> np.ndarray:
    """The first place of the greatest value in each row; where none has a value, the first place."""
    return np.argmax(np.where(np.isfinite(x), x, -np.inf), axis=-1)


def _rates(freqs: np.ndarray, power: np.ndarray, at: int) -> list[float]:
    """``power_rates`` of one object."""
    f0, f1, last, out = freqs.min(), freqs.max(), len(freqs) - 1, []
    for times, _ in RATES:
        f = freqs[at] / times
        guess = int(min(max(np.floor((f - f0) / (f1 - f0) * last + 0.5) if f1 > f0 else 0, 0), last))
        near = np.arange(max(guess - 1, 0), min(guess + 1, last) + 1)
        found = power[near[np.argmin(np.round(np.abs(freqs[near] - f), 12))]]
        out.append(found / power[at] if power[at] else np.nan)
    return out


def _search_object(t: np.ndarray, m: np.ndarray, e: np.ndarray, codes: np.ndarray, bands: int, freqs: np.ndarray, harmonics: int, peaks: int, finer: int, top: int) -> tuple | None:
    """(period, peak, ppe, rates, bands seen, their periods) of one object's points; nothing without a positive error."""

    def powers(f: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(power of all bands together, ratio of each band, points of each band)"""
        x = band_harmonics(t, m, e, codes, bands, f, harmonics)
        together, d1 = x["power"].sum(axis=0), 2.0 * harmonics
        ratio = x["d2"][:, None] * x["power"] / (d1 * np.maximum(x["wvar"][:, None] - x["power"], 1e-9))
        return x["d2"].sum() * together / (d1 * np.maximum(x["wvar"].sum() - together, 1e-9)), ratio, x["n"]

    if not (e > 0).any():
        return None
    step = max(1, min(CELLS // 8 // bands, (CELLS // len(t)) ** 2))
    parts = [powers(freqs[k : k + step]) for k in range(0, len(freqs), step)]
    n, freqs = parts[0][2], freqs.copy()
    power, ratio = np.concatenate([x[0] for x in parts]), np.concatenate([x[1] for x in parts], axis=1)
    by_band = np.repeat(freqs[None, :], bands, axis=0)
    tops = _maxima(power, peaks) if peaks else np.zeros(0, int)
    if len(tops):
        steps = 2 * finer
        fine = (freqs[tops - 1][:, None] + np.arange(steps) * (freqs[tops + 1] - freqs[tops - 1])[:, None] / (steps - 1)).ravel()
        step = max(1, CELLS // len(t))
        parts = [powers(fine[k : k + step]) for k in range(0, len(fine), step)]
        finest, side = np.concatenate([x[0] for x in parts]).reshape(-1, steps), np.concatenate([x[1] for x in parts], axis=1)
        best = _highest(finest) + steps * np.arange(len(tops))
        better = finest.ravel()[best] > power[tops]
        tops, best = tops[better], best[better]
        freqs[tops], power[tops], by_band[:, tops] = fine[best], finest.ravel()[best], fine[best]
        ratio[:, tops] = np.where(np.isfinite(side[:, best]), side[:, best], ratio[:, tops])
    at = int(_highest(power))
    q = np.sort(power[np.isfinite(power)])[::-1][:top] + 0.01
    share = q / q.sum() if len(q) else q
    ppe = 1 + (share * np.log(share)).sum() / np.log(top) if len(q) else np.nan
    seen = np.flatnonzero(n > 0)
    return 1 / freqs[at], power[at], ppe, _rates(freqs, power, at), seen, 1 / by_band[seen, _highest(ratio[seen])]


def object_periods(obs: DataFrame, spec: DataFrame, harmonics: int = 1, peaks: int = 10, finer: int = 10, top: int = 100) -> DataFrame:
    """(oid, period, peak, ppe, rates, bands) by object: what ``refine``, ``period_features``, ``band_periods`` and
    ``power_rates`` find together on the grid of ``frequency_spec``, without a row for each frequency.

    ``peaks`` = 0 keeps the grid's points. ``rates`` are in the order of RATES, ``bands`` holds (fid, Period_band). A task
    searches whole objects, one after the other, and holds one object's powers by band and frequency.
    """
    own = obs.filter(~F.col("forced") & F.col("mag").isNotNull() & F.col("mjd").isNotNull())
    width = int(obs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    own = own.select("oid", "candid", "mjd", "mag", "e_mag", "fid").repartition(width, "oid")
    points = own.groupBy("oid").agg(F.sort_array(F.collect_list(F.struct("candid", "mjd", "mag", "e_mag", "fid"))).alias("p"))
    dealt = points.join(spec.select("oid", "t0", "n", "lo", "hi"), "oid").select("oid", "t0", "n", "lo", "hi", *(F.col(f"p.{c}").alias(c) for c in ("mjd", "mag", "e_mag", "fid")))
    kinds, sent = dict(dealt.dtypes), SENT_ROWS
    schema = f"oid {kinds['oid']}, period double, peak double, ppe double, rates array<double>, fids {kinds['fid']}, own array<double>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = {c: b.column(c) for c in ("mjd", "mag", "e_mag", "fid")}
            ends = np.asarray(lists["mjd"].offsets)
            flat = {c: pc.cast(lists[c].values, pa.float64()).to_numpy(zero_copy_only=False) for c in ("mjd", "mag", "e_mag")}
            t0, size, lo, hi = (b.column(c).to_numpy(zero_copy_only=False) for c in ("t0", "n", "lo", "hi"))
            found: list[tuple] = []
            for i in range(b.num_rows):
                part = {c: v[ends[i] : ends[i + 1]] for c, v in flat.items()}
                fid = lists["fid"].values.slice(ends[i], ends[i + 1] - ends[i])
                bands = pc.unique(fid)
                codes = pc.index_in(fid, bands).to_numpy(zero_copy_only=False)
                freqs = lo[i] + np.arange(size[i]) * (hi[i] - lo[i]) / (size[i] - 1)
                with np.errstate(all="ignore"):
                    out = _search_object(part["mjd"] - t0[i], part["mag"], part["e_mag"], codes, len(bands), freqs, harmonics, peaks, finer, top)
                if out:
                    found.append((i, *out[:4], bands.take(pa.array(out[4])), out[5]))
                if found and (len(found) >= sent or i == b.num_rows - 1):
                    yield rows(b, found)
                    found = []
            if found:
                yield rows(b, found)

    def rows(b: pa.RecordBatch, found: list[tuple]) -> pa.RecordBatch:
        at, period, peak, ppe, rates, fids, own = zip(*found)
        starts = pa.array(np.concatenate([[0], np.cumsum([len(x) for x in own])]), pa.int32())
        each = pa.array(np.arange(len(at) + 1) * len(RATES), pa.int32())
        cols = [b.column("oid").take(pa.array(at)), *(finite(np.array(x, float)) for x in (period, peak, ppe)), pa.ListArray.from_arrays(each, finite(np.concatenate(rates)))]
        cols += [pa.ListArray.from_arrays(starts, pa.concat_arrays(fids)), pa.ListArray.from_arrays(starts, finite(np.concatenate(own)))]
        return pa.RecordBatch.from_arrays(cols, ["oid", "period", "peak", "ppe", "rates", "fids", "own"])

    bands = F.arrays_zip(F.col("fids").alias("fid"), F.col("own").alias("Period_band")).alias("bands")
    return dealt.mapInArrow(run, schema).select("oid", "period", "peak", "ppe", "rates", bands)


def each_band(found: DataFrame) -> DataFrame:
    """``band_periods`` of ``object_periods``."""
    rows = found.select("oid", "period", F.inline("bands"))
    return rows.select("oid", "fid", "Period_band", F.abs(F.col("period") - F.col("Period_band")).alias("delta_period"))
