"""Magnitude correction with the reference source's flux."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyflow.functions.columns import ZERO_MAG, isclose

INF = float("inf")
NEAR_REFERENCE, NEAR_STAR, STAR_SCORE, CHI_MAX, SHARP_MIN, SHARP_MAX = 1.4, 1.0, 0.4, 2.0, -0.13, 0.1


def with_flags(det: DataFrame, sharpnr_mode: str = "documented") -> DataFrame:
    """corrected, dubious and stellar. Stored rows keep ``corrected``; their stellar is that of the object's first new row."""
    stored = F.col("corrected") if "corrected" in det.columns else F.lit(False)
    new = F.col("new")
    df = det.withColumn("corrected", F.when(new, F.coalesce(F.col("distnr") < NEAR_REFERENCE, F.lit(False))).otherwise(stored))
    first = F.min(F.when(new, F.struct("mjd", "candid", "corrected"))).over(Window.partitionBy("oid", "fid"))["corrected"]
    df = df.withColumn("__first", first)
    dubious = (~F.col("corrected") & (F.col("isdiffpos") == -1)) | (F.col("__first") & ~F.col("corrected")) | (~F.col("__first") & F.col("corrected"))
    near_star = F.col("distpsnr1") < NEAR_STAR
    sharp = (F.col("sharpnr") > SHARP_MIN) & (F.col("sharpnr") < SHARP_MAX) if sharpnr_mode == "documented" else (F.col("sharpnr") <= SHARP_MIN) | F.isnan("sharpnr")
    stellar = (F.col("distnr") < NEAR_REFERENCE) & ((near_star & (F.col("sgscore1") > STAR_SCORE)) | (~near_star & (F.col("chinr") < CHI_MAX) & sharp))
    df = df.withColumn("dubious", F.coalesce(dubious, F.lit(False))).withColumn("__stellar", F.coalesce(stellar, F.lit(False)))
    carried = F.min(F.when(new, F.struct("mjd", "candid", F.col("__stellar").alias("s")))).over(Window.partitionBy("oid"))["s"]
    return df.withColumn("stellar", F.when(new, F.col("__stellar")).otherwise(F.coalesce(carried, F.lit(False)))).drop("__first", "__stellar")


def corrected_magnitude() -> tuple[Column, Column, Column]:
    """(mag_corr, e_mag_corr, e_mag_corr_ext) of a new row; infinite where the flux sum or the variance is not positive."""
    reference, difference = F.pow(F.lit(10.0), -0.4 * F.col("magnr")), F.pow(F.lit(10.0), -0.4 * F.col("mag"))
    flux = F.greatest(reference + F.col("isdiffpos") * difference, F.lit(0.0))
    no_mag, no_error = isclose(F.col("mag"), ZERO_MAG), isclose(F.col("e_mag"), ZERO_MAG)
    mag = F.when(no_mag | (flux == 0), INF).otherwise(-2.5 * F.log10(flux))
    variance = F.pow(difference * F.col("e_mag"), 2) - F.pow(reference * F.col("sigmagnr"), 2)
    error = F.when(no_mag | no_error | (variance < 0) | (flux == 0), INF).otherwise(F.sqrt(variance) / flux)
    ext = F.when(no_mag | no_error | (flux == 0), INF).otherwise(difference * F.col("e_mag") / flux)
    return F.when(F.col("magnr").isNotNull(), mag), F.when(F.col("magnr").isNotNull(), error), F.when(F.col("magnr").isNotNull(), ext)


def correct_magnitudes(det: DataFrame) -> DataFrame:
    """Corrections of the corrected new rows, stored ones for the rest; +inf becomes 100, NaN and -inf null."""
    df = det
    for name, value in zip(("mag_corr", "e_mag_corr", "e_mag_corr_ext"), corrected_magnitude()):
        stored = F.col(name) if name in det.columns else F.lit(None).cast("double")
        x = F.when(F.col("corrected"), F.when(F.col("new"), value).otherwise(stored))
        df = df.withColumn(f"__{name}", F.when(x == INF, ZERO_MAG).when(F.isnan(x) | (x == -INF), None).otherwise(x))
    for name in ("mag_corr", "e_mag_corr", "e_mag_corr_ext"):
        df = df.withColumn(name, F.col(f"__{name}")).drop(f"__{name}")
    return df


def correct_lsst(value: Column) -> Column:
    return value * 10 ** (-3.9 / 2.5)


def by_survey(strategies: dict[str, Column], default, column: str = "sid") -> Column:
    """Pick each row's strategy by survey, case-insensitively."""
    out = F.lit(default)
    for name, expr in strategies.items():
        out = F.when(F.lower(F.col(column)) == name, expr).otherwise(out)
    return out


def mean_coordinates(det: DataFrame) -> DataFrame:
    """Weighted mean position of each object's detections, weights 1 / error^2."""
    w = {c: F.pow(F.col(f"e_{c}"), -2) for c in ("ra", "dec")}
    return det.filter(~F.col("forced")).groupBy("oid").agg(*((F.sum(F.col(c) * w[c]) / F.sum(w[c])).alias(f"mean{c}") for c in w))


#: Columns that only serve the correction.
HELPERS = ["magnr", "sigmagnr", "distnr", "distpsnr1", "sgscore1", "chinr", "sharpnr"]


def corrected_output(det: DataFrame, helpers: list[str] = HELPERS, keep: str = "extra_fields") -> DataFrame:
    """Corrected rows as they leave the stage: infinities as 100 or null, helper columns gone, extra fields with
    no ids of their own, ordered by object and time."""
    out = det
    for c in ("mag_corr", "e_mag_corr", "e_mag_corr_ext"):
        x = F.col(c)
        out = out.withColumn(c, F.when(x == INF, ZERO_MAG).when(F.isnan(x) | (x == -INF), None).otherwise(x))
    if keep in out.columns:
        out = out.withColumn(keep, F.map_filter(keep, lambda k, _: ~k.isin("oid", "candid")))
    return out.drop(*helpers).orderBy("oid", "mjd", "candid")


def correct_multistream(batch: DataFrame, *stored: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(corrected rows, mean coordinates) of a batch keyed by measurement_id and band, with the stored history:
    union, one row a measurement, as-of cut, correction and ordered output."""
    from skyflow.operators.history import as_of_cut, dedup_detections, union_history

    names = {"measurement_id": "candid", "band": "fid"}
    named = lambda df: df.withColumnsRenamed({k: v for k, v in names.items() if k in df.columns})
    new = named(batch).withColumn("new", F.lit(True))
    det = as_of_cut(dedup_detections(union_history(new, *map(named, stored))), new)
    rows = correct_magnitudes(with_flags(det))
    back = {v: k for k, v in names.items()}
    return corrected_output(rows).withColumnsRenamed(back), mean_coordinates(rows)
