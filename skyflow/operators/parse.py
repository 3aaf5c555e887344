"""From nested survey alerts to flat detections, limits and forced photometry."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyflow.functions.columns import band_letter, flux_to_mag, mjd

#: Default position errors in arcsec of each survey and band.
ERRORS = {"ztf": {"g": 0.065, "r": 0.085, "i": 0.01}, "atlas": 0.14, "lsst": 0.1}
STANDARD = ["oid", "tid", "sid", "pid", "candid", "mjd", "fid", "ra", "dec", "mag", "e_mag", "isdiffpos", "e_ra", "e_dec"]


def map_fields(df: DataFrame, mapping: dict[str, Column | str], optional: dict[str, str] | None = None) -> DataFrame:
    """Declarative mapping: target name to a column; optional source fields that are absent give null."""
    cols = [(F.col(v) if isinstance(v, str) else v).alias(k) for k, v in mapping.items()]
    cols += [(F.col(v) if v in df.columns else F.lit(None)).alias(k) for k, v in (optional or {}).items()]
    return df.select(*cols)


def extra_fields(df: DataFrame, used: list[str]) -> Column:
    """Map of the columns that a mapping leaves."""
    rest = [c for c in df.columns if c not in used]
    return F.create_map(*(x for c in rest for x in (F.lit(c), F.col(c).cast("string")))) if rest else F.create_map().cast("map<string,string>")


def _errors(e: Column, dec: Column) -> tuple[Column, Column]:
    return F.when(F.cos(F.radians(dec)) != 0, e / F.abs(F.cos(F.radians(dec)))).otherwise(float("nan")), e


def standardize_ztf(alerts: DataFrame) -> DataFrame:
    c = lambda n: F.col(f"candidate.{n}")
    band = band_letter(c("fid"))
    error = F.lit(None).cast("double")
    for b, e in ERRORS["ztf"].items():
        error = F.when(band == b, e).otherwise(error)
    e_ra, e_dec = _errors(error, c("dec"))
    return alerts.select(
        F.col("objectId").alias("oid"), F.lit("ZTF").alias("tid"), F.lit("ZTF").alias("sid"), c("pid").alias("pid"), F.col("candid").cast("string").alias("candid"), mjd(c("jd")).alias("mjd"), band.alias("fid"), c("ra").alias("ra"), c("dec").alias("dec"),
        c("magpsf").alias("mag"), c("sigmapsf").alias("e_mag"), F.when(c("isdiffpos").isin("t", "1"), 1).otherwise(-1).alias("isdiffpos"), e_ra.alias("e_ra"), e_dec.alias("e_dec"),
    )


def standardize_atlas(alerts: DataFrame) -> DataFrame:
    c = lambda n: F.col(f"candidate.{n}")
    e_ra, e_dec = _errors(F.lit(ERRORS["atlas"]), c("Dec"))
    return alerts.select(
        F.col("objectId").alias("oid"), F.col("publisher").alias("tid"), F.lit("ATLAS").alias("sid"), c("pid").alias("pid"), c("candid").cast("string").alias("candid"), c("mjd").alias("mjd"), c("filter").alias("fid"), c("RA").alias("ra"), c("Dec").alias("dec"),
        c("Mag").alias("mag"), c("Dmag").alias("e_mag"), F.when(c("isdiffpos").isin("t", "1"), 1).otherwise(-1).alias("isdiffpos"), e_ra.alias("e_ra"), e_dec.alias("e_dec"),
    )


def standardize_lsst(alerts: DataFrame) -> DataFrame:
    c = lambda n: F.col(f"diaSource.{n}")
    e_ra, e_dec = _errors(F.lit(ERRORS["lsst"]), c("decl"))
    return alerts.select(
        c("diaObjectId").cast("string").alias("oid"), F.lit("LSST").alias("tid"), F.lit("LSST").alias("sid"), F.lit(-999).cast("long").alias("pid"), F.col("alertId").cast("string").alias("candid"), c("midPointTai").alias("mjd"), c("filterName").alias("fid"),
        c("ra").alias("ra"), c("decl").alias("dec"), c("psFlux").alias("mag"), c("psFluxErr").alias("e_mag"), F.signum(c("psFlux")).cast("int").alias("isdiffpos"), e_ra.alias("e_ra"), e_dec.alias("e_dec"),
    )


def route_survey(alerts: DataFrame, parsers: dict[str, tuple[Column, Callable[[DataFrame], DataFrame]]]) -> DataFrame:
    """Send each row to the first parser whose test holds; a row that none takes is an error."""
    which = F.raise_error(F.lit("no parser for alert"))
    for name, (test, _) in reversed(parsers.items()):
        which = F.when(F.coalesce(test, F.lit(False)), name).otherwise(which)
    tagged = alerts.withColumn("__parser", which)
    out = None
    for name, (_, parse) in parsers.items():
        part = parse(tagged.filter(F.col("__parser") == name).drop("__parser"))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def has_stamp() -> Column:
    return F.col("cutoutScience").isNotNull() & F.col("cutoutTemplate").isNotNull() & F.col("cutoutDifference").isNotNull()


def _previous(alerts: DataFrame) -> DataFrame:
    return alerts.select(F.col("objectId").alias("oid"), F.col("candid").cast("string").alias("parent_candid"), F.explode("prv_candidates").alias("p"))


def explode_previous(alerts: DataFrame) -> DataFrame:
    """Previous candidates with a candid, as detections of the alert's object."""
    p = _previous(alerts).filter("p.candid is not null")
    return p.select("oid", "parent_candid", F.col("p.candid").cast("string").alias("candid"), mjd(F.col("p.jd")).alias("mjd"), band_letter(F.col("p.fid")).alias("fid"), "p.ra", "p.dec", F.col("p.magpsf").alias("mag"), F.col("p.sigmapsf").alias("e_mag"), F.when(F.col("p.isdiffpos").isin("t", "1"), 1).otherwise(-1).alias("isdiffpos"), F.lit(False).alias("has_stamp"), F.lit(False).alias("forced"))


def explode_limits(alerts: DataFrame) -> DataFrame:
    """Previous candidates without a candid, as non-detections."""
    return _previous(alerts).filter("p.candid is null").select("oid", F.lit("ZTF").alias("sid"), F.lit("ZTF").alias("tid"), band_letter(F.col("p.fid")).alias("fid"), mjd(F.col("p.jd")).alias("mjd"), "p.diffmaglim")


def explode_forced(alerts: DataFrame) -> DataFrame:
    """Forced photometry at the alert's position; rows without usable flux are dropped."""
    from skyflow.operators.filters import drop_bad_forced

    f = alerts.select(F.col("objectId").alias("oid"), F.col("candid").cast("string").alias("parent_candid"), F.col("candidate.ra").alias("ra"), F.col("candidate.dec").alias("dec"), F.inline("fp_hists"))
    f = drop_bad_forced(f)
    mag, e_mag = flux_to_mag(F.col("forcediffimflux"), F.col("forcediffimfluxunc"), F.col("magzpsci"))
    return f.select("oid", "parent_candid", F.concat("oid", F.col("pid").cast("string")).alias("candid"), "pid", mjd(F.col("jd")).alias("mjd"), band_letter(F.col("fid")).alias("fid"), "ra", "dec", F.lit(0.0).alias("e_ra"), F.lit(0.0).alias("e_dec"), mag.alias("mag"), e_mag.alias("e_mag"), F.when(F.col("forcediffimflux") >= 0, 1).otherwise(-1).alias("isdiffpos"), F.lit(True).alias("forced"), F.lit(False).alias("has_stamp"), "procstatus")


def stack_units(det: DataFrame) -> DataFrame:
    """Every detection twice: as magnitude and as difference flux."""
    from skyflow.functions.columns import mag_to_flux

    flux, e_flux = mag_to_flux(F.col("mag"), F.col("e_mag"), F.col("isdiffpos"))
    a = det.withColumns({"brightness": F.col("mag"), "e_brightness": F.col("e_mag"), "unit": F.lit("magnitude")})
    return a.unionByName(det.withColumns({"brightness": flux, "e_brightness": e_flux, "unit": F.lit("diff_flux")}))


def assemble_messages(objects: DataFrame, det: DataFrame, nd: DataFrame) -> DataFrame:
    """One message per object with its rows nested; objects without rows have empty arrays."""
    rows = lambda df, name: df.groupBy("oid").agg(F.sort_array(F.collect_list(F.struct("mjd", *(c for c in df.columns if c not in ("oid", "mjd"))))).alias(name))
    out = objects.join(rows(det, "detections"), "oid", "left").join(rows(nd, "non_detections"), "oid", "left")
    return out.withColumns({c: F.coalesce(c, F.array().cast(out.schema[c].dataType)) for c in ("detections", "non_detections")})


def explode_lsst(alerts: DataFrame) -> DataFrame:
    """Previous sources (forced = false) and forced sources (forced = true, at the alert's position) of the simulated survey."""
    base = [F.col("diaSource.diaObjectId").cast("string").alias("oid"), F.col("alertId").cast("string").alias("parent_candid")]
    shape = lambda ident, ra, dec, forced: [
        "oid", "parent_candid", F.col(f"s.{ident}").cast("string").alias("candid"), F.col("s.midPointTai").alias("mjd"), F.col("s.filterName").alias("fid"), ra.alias("ra"), dec.alias("dec"), F.col("s.psFlux").alias("mag"), F.col("s.psFluxErr").alias("e_mag"),
        F.signum("s.psFlux").cast("int").alias("isdiffpos"), F.lit(forced).alias("forced"), F.lit(False).alias("has_stamp"),
    ]
    own = alerts.select(*base, F.explode("prvDiaSources").alias("s")).select(*shape("diaSourceId", F.col("s.ra"), F.col("s.decl"), False))
    at = alerts.select(*base, F.col("diaSource.ra").alias("ra"), F.col("diaSource.decl").alias("dec"), F.explode("prvDiaForcedSources").alias("s"))
    return own.unionByName(at.select(*shape("diaForcedSourceId", F.col("ra"), F.col("dec"), True)))
