"""Feature sets: ordered lists of extractors, each a function from the inputs to wide or long features.

Every extractor is one of the operators of this package, so a set is a union of aggregations by object and
band; there is no loop over objects. Users register extractors and sets of their own.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyflow.functions.columns import clean, mag_to_flux
from skyflow.operators import features, fits, history, ingest, period, variability

LONG = ["oid", "fid", "name", "value", "version"]


@dataclass
class Inputs:
    """Observations (magnitudes, with forced ones marked), catalogue matches, metadata and references."""

    obs: DataFrame
    bands: list[str]
    unit: str = "magnitude"
    xmatch: DataFrame | None = None
    metadata: DataFrame | None = None
    references: DataFrame | None = None
    periods: dict = field(default_factory=lambda: {"pmin": 0.045, "pmax": 100.0, "days": 1000.0, "least": 15})

    def flux(self) -> DataFrame:
        """Observations whose mag and e_mag are difference fluxes."""
        f, e = mag_to_flux(F.col("mag"), F.col("e_mag"), F.col("isdiffpos"))
        return self.obs.withColumns({"__f": f, "__e": e}).withColumns({"mag": F.col("__f"), "e_mag": F.abs("__e")}).drop("__f", "__e")

    def in_unit(self) -> DataFrame:
        return self.obs if self.unit == "magnitude" else self.flux()


def long(wide: DataFrame, keys: list[str], version: str = "1.0.0") -> DataFrame:
    """Long rows (oid, fid, name, value, version); features of all bands have an empty fid."""
    names = [c for c in wide.columns if c not in keys]
    rows = wide.select(*keys, *(clean(F.col(c).cast("double")).alias(c) for c in names)).unpivot(keys, names, "name", "value")
    return rows.select(F.col("oid").cast("string").alias("oid"), (F.col("fid") if "fid" in keys else F.lit("")).alias("fid"), "name", "value", F.lit(version).alias("version"))


def _by_band(df: DataFrame) -> DataFrame:
    return long(df, ["oid", "fid"])


def _by_object(df: DataFrame) -> DataFrame:
    return long(df, ["oid"])


def _colors(x: Inputs) -> DataFrame:
    if x.unit != "magnitude":
        pairs = [features.colors(x.obs, a, b).select("oid", F.col("color_flux_p90").alias(f"{a}-{b}")) for a, b in zip(x.bands, x.bands[1:])]
        return reduce(DataFrame.unionByName, map(_by_object, pairs))
    out = _by_object(features.color_mean_max(x.obs, x.bands))
    if "mag_corr" in x.obs.columns:
        out = out.unionByName(_by_object(features.color_mean_max(x.obs, x.bands, "mag_corr", "_corr")))
    return out


def _periods(x: Inputs, peaks: int) -> DataFrame:
    """``object_periods`` of the bands with enough points; the grid's own best period where ``peaks`` is 0."""
    p = x.periods
    good = variability.eligible_bands(history.trim_to_span(x.in_unit().filter(~F.col("forced")), p["days"]), p["least"])
    return period.object_periods(good, period.frequency_spec(good, p["pmin"], p["pmax"]), peaks=peaks)


def _period(x: Inputs) -> DataFrame:
    """All long rows of an object from the one row of its search."""
    row = lambda name, value, fid="": F.struct(F.lit(fid).alias("fid") if isinstance(fid, str) else fid.cast("string").alias("fid"), F.lit(name).alias("name"), clean(value).alias("value"))
    own = [row("Multiband_period", F.col("period")), row("PPE", F.col("ppe")), *(row(f"Power_rate_{name}", F.col("rates")[k]) for k, (_, name) in enumerate(period.RATES))]
    bands = [F.transform("bands", lambda b: row("Period_band", b["Period_band"], b["fid"])), F.transform("bands", lambda b: row("delta_period", F.abs(F.col("period") - b["Period_band"]), b["fid"]))]
    rows = _periods(x, 10).select(F.col("oid").cast("string").alias("oid"), F.inline(F.concat(F.array(*own), *bands)))
    return rows.withColumn("version", F.lit("1.0.0"))


def _with_period(x: Inputs, extract: Callable[[DataFrame, DataFrame], DataFrame]) -> DataFrame:
    return _by_band(extract(x.in_unit(), _periods(x, 0).select("oid", "period")))


def _turbo(x: Inputs) -> DataFrame:
    det = ingest.drop_same_mjd(x.in_unit().filter(~F.col("forced")))
    parts = [features.basic_features(det), features.structure_function(det), features.structure_function_indices(det), variability.pvar(det), variability.autocor_length(det), fits.fit_iar_phi(det)]
    slots = variability.slotted_autocorrelation(det)
    parts += [variability.slotted_length(det), variability.stetson_k_ac(slots)]
    return reduce(DataFrame.unionByName, map(_by_band, parts))


def _mhps(t1: float, t2: float, suffix: str = "") -> Callable[[Inputs], DataFrame]:
    def run(x: Inputs) -> DataFrame:
        out = variability.mhps(x.flux(), t1, t2, unit="diff_flux")
        return _by_band(out.withColumnsRenamed({c: f"{c}{suffix}" for c in out.columns if c not in ("oid", "fid")}))

    return run


Extractor = Callable[[Inputs], DataFrame | None]

#: Extractors by name; one that lacks its input gives None.
EXTRACTORS: dict[str, Extractor] = {
    "color": _colors,
    "allwise": lambda x: None if x.xmatch is None else _by_band(variability.allwise_colors(x.obs, x.xmatch)),
    "panstarrs": lambda x: None if x.metadata is None else _by_object(variability.panstarrs_colors(x.metadata)),
    "mhps": _mhps(100.0, 10.0),
    "mhps_long": _mhps(365.0, 30.0, "_365_30"),
    "gp_drw": lambda x: _by_band(fits.fit_drw(x.flux())),
    "period": _period,
    "folded_kim": lambda x: _with_period(x, features.folded_kim),
    "harmonics": lambda x: _with_period(x, features.harmonics),
    "turbo": _turbo,
    "spm": lambda x: _by_band(fits.fit_supernova(x.obs)),
    "tde_tail": lambda x: _by_band(features.tde_tail(x.obs)),
    "fleet": lambda x: _by_band(fits.fit_fleet(x.obs.filter("isdiffpos > 0 and mag < 23.9"))),  # a positive flux of 1 uJy at least
    "color_variation": lambda x: _by_object(features.color_variation(x.obs, x.bands[0], x.bands[1])),
    "sn": lambda x: _by_band(features.sn_features(x.flux())),
    "microlensing": lambda x: _by_band(fits.fit_microlensing(x.obs)),
    "reference": lambda x: None if x.references is None else _by_object(features.reference_features(x.obs, x.references)),
    "timespan": lambda x: _by_object(features.coordinates_xyz(x.obs).select("oid", "timespan")),
    "coordinates": lambda x: _by_object(features.coordinates_xyz(x.obs).drop("timespan")),
}

#: Ordered extractors of each set, and how its inputs differ.
SETS: dict[str, tuple[list[str], dict]] = {
    "ztf": (
        ["color", "allwise", "panstarrs", "mhps", "mhps_long", "gp_drw", "period", "folded_kim", "harmonics", "turbo", "spm", "tde_tail", "fleet", "color_variation", "sn", "microlensing", "reference", "timespan", "coordinates"],
        {},
    ),
    "six_band": (
        ["color", "mhps", "period", "folded_kim", "harmonics", "turbo", "spm", "sn", "timespan", "coordinates"],
        {"unit": "diff_flux", "periods": {"pmin": 0.045, "pmax": 50.0, "days": 500.0, "least": 15}},
    ),
}


def register_extractor(name: str, extract: Extractor) -> None:
    EXTRACTORS[name] = extract


def register_set(name: str, extractors: list[str], **inputs) -> None:
    SETS[name] = (extractors, inputs)


def feature_set(obs: DataFrame, name: str, bands: list[str], only: list[str] | None = None, **sources: DataFrame) -> DataFrame:
    """Long features of a set's extractors in their order; those without their source are left out."""
    extractors, options = SETS[name]
    x = Inputs(obs, bands, **options, **sources)
    parts = [EXTRACTORS[e](x) for e in extractors if only is None or e in only]
    return reduce(DataFrame.unionByName, [p.select(*LONG) for p in parts if p is not None])
