"""Statistics per object and band, per object, and of limits before the first detection."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SATURATION = {"ztf": 13.2}
ARCSEC = 3600.0


def _at(column: str, which: str) -> Column:
    """Value at the earliest or latest time; ties by candid."""
    f = F.min_by if which == "first" else F.max_by
    return f(column, F.struct("mjd", "candid"))


def magnitude_columns(column: str, suffix: str, where: Column | None = None) -> dict[str, Column]:
    x = F.col(column) if where is None else F.when(where, F.col(column))
    order = F.struct("mjd", "candid") if where is None else F.when(where, F.struct("mjd", "candid"))
    return {
        f"magmean{suffix}": F.avg(x), f"magmedian{suffix}": F.percentile(x, 0.5), f"magmax{suffix}": F.max(x), f"magmin{suffix}": F.min(x), f"magsigma{suffix}": F.stddev_pop(x),
        f"magfirst{suffix}": F.min_by(x, order), f"maglast{suffix}": F.max_by(x, order),
    }


#: Statistics added by users: name to a function that gives an aggregate column.
_ADDED: dict[str, Callable[[], Column]] = {}


def register_statistic(name: str, build: Callable[[], Column]) -> None:
    _ADDED[name] = build


def statistics() -> dict[str, Column]:
    """Every statistic of an (object, survey, band); one aggregation computes any choice of them."""
    saturated = F.lit(None).cast("double")
    for survey, limit in SATURATION.items():
        saturated = F.when(F.first("sid") == survey, F.count(F.when(F.col("mag_corr") < limit, 1)) / F.nullif(F.count(F.when(F.col("corrected"), 1)), F.lit(0)))
    return {
        **magnitude_columns("mag", ""), **magnitude_columns("mag_corr", "_corr", F.col("corrected")), "firstmjd": F.min("mjd"), "lastmjd": F.max("mjd"), "corrected": _at("corrected", "first"),
        "stellar": _at("stellar", "first"), "ndubious": F.count(F.when(F.col("dubious"), 1)), "saturation_rate": saturated, "ndet": F.count("*"), **{k: f() for k, f in _ADDED.items()},
    }


def generate_statistics(det: DataFrame, exclude: set[str] = frozenset(), only: set[str] | None = None) -> DataFrame:
    rows = det.filter(~F.col("forced")).dropDuplicates(["candid", "oid"])
    chosen = {k: v for k, v in statistics().items() if k not in exclude and (only is None or k in only)}
    return rows.groupBy("oid", "sid", "fid").agg(*(v.alias(k) for k, v in chosen.items()))


def dmdt(det: DataFrame, nd: DataFrame, dt_min: float = 0.5) -> DataFrame:
    """Of the limits more than ``dt_min`` days before the first detection, that of the least slope."""
    keys = ["oid", "sid", "fid"]
    first = det.filter(~F.col("forced")).groupBy(*keys).agg(*(_at(c, "first").alias(f"first_{c}") for c in ("mjd", "mag", "e_mag")))
    dt = F.col("first_mjd") - F.col("mjd")
    rows = nd.join(first, keys).filter(dt > dt_min).select(
        *keys, dt.alias("dt"), (F.col("first_mag") - F.col("diffmaglim")).alias("dm"), (F.col("first_e_mag") - F.col("diffmaglim")).alias("sigmadm"), ((F.col("first_mag") + F.col("first_e_mag") - F.col("diffmaglim")) / dt).alias("dmdt"), "mjd"
    )
    best = F.min_by(F.struct("dt", "dm", "sigmadm", "dmdt"), F.struct("dmdt", "mjd"))
    return rows.groupBy(*keys).agg(best.alias("b")).select(*keys, *(F.col(f"b.{c}").alias(f"{c}_first") for c in ("dt", "dm", "sigmadm", "dmdt")))


def object_statistics(det: DataFrame) -> DataFrame:
    """Position with its error in arcsec, times, surveys, flags and counts of each object."""
    rows = det.filter(~F.col("forced")).dropDuplicates(["candid", "oid"])
    out = {}
    for c in ("ra", "dec"):
        w = F.pow(F.col(f"e_{c}") / ARCSEC, -2)
        out |= {f"mean{c}": F.sum(F.col(c) * w) / F.sum(w), f"sigma{c}": F.sqrt(1 / F.sum(w)) * ARCSEC}
    ztf = F.when(F.col("sid") == "ztf", F.struct("mjd", "candid"))
    out |= {
        "firstmjd": F.min("mjd"), "lastmjd": F.max("mjd"), "deltamjd": F.max("mjd") - F.min("mjd"), "sids": F.array_join(F.sort_array(F.collect_set("sid")), ","), "corrected": F.min_by("corrected", ztf),
        "stellar": F.min_by("stellar", ztf), "ndet": F.count("*"), "diffpos": _at("isdiffpos", "first") > 0,
    }
    if "tid" in det.columns:
        out["tids"] = F.sort_array(F.collect_set("tid"))
    return rows.groupBy("oid").agg(*(v.alias(k) for k, v in out.items()))


def reference_change(det: DataFrame) -> DataFrame:
    """Whether the reference of an object's last row ended after its first."""
    return det.groupBy("oid").agg((F.max_by("mjdendref", F.struct("mjd", "candid")) > F.min("mjd")).alias("reference_change"))


def object_document(objects: DataFrame, magstats: DataFrame) -> DataFrame:
    """Object row with its per-band rows nested and a GeoJSON point."""
    from skyflow.functions.columns import geo_point

    nested = magstats.groupBy("oid").agg(F.sort_array(F.collect_list(F.struct("fid", "sid", "ndet", "magmean"))).alias("magstats"))
    return objects.join(nested, "oid", "left").withColumn("loc", geo_point(F.col("meanra"), F.col("meandec")))
