"""Ingestion: alert batches to stored tables, serial ids, and stored rows back to the shape of messages."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyflow.functions.columns import ZERO_MAG, band_letter, isclose, masterid_encode, mjd
from skyflow.operators.filters import drop_bad_forced
from skyflow.operators.history import first_row
from skyflow.operators.merge import insert_ignore

Step = Callable[[DataFrame], DataFrame]

#: Default position errors in arcsec by band number, and the marker of a missing flux.
BAND_ERRORS = {1: 0.065, 2: 0.085, 3: 0.01}
NO_FLUX = -99999
#: Key columns of the stored tables.
TABLE_KEYS = {"object": ["oid"], "detection": ["oid", "measurement_id"], "forced_photometry": ["oid", "measurement_id"], "non_detection": ["oid", "band", "mjd"]}


def stamp_ingest_time(df: DataFrame, published: str = "timestamp", topic: str = "topic") -> DataFrame:
    """Seconds of arrival and of publication, and the source topic ('' where unknown)."""
    at = F.unix_timestamp(F.col(published)) if published in df.columns else F.lit(None).cast("long")
    source = F.coalesce(F.col(topic).cast("string"), F.lit("")) if topic in df.columns else F.lit("")
    return df.withColumns({"brokerIngestTimestamp": F.unix_timestamp(F.current_timestamp()), "surveyPublishTimestamp": at, "topic": source})


def passthrough_alert(alerts: DataFrame) -> DataFrame:
    """Surveys without a strategy of their own: the alert alone, with empty arrays beside it."""
    none = F.array().cast("array<string>")
    return alerts.withColumns({"non_detections": none, "prv_detections": none, "forced_photometries": none})


# --- ordered transforms -------------------------------------------------------------


def apply_transforms(df: DataFrame, steps: Sequence[Step]) -> DataFrame:
    for step in steps:
        df = df.transform(step)
    return df


def numeric_oid(df: DataFrame) -> DataFrame:
    return df.withColumn("oid", masterid_encode(F.col("objectId")))


def measurement_id(column: str) -> Step:
    return lambda df: df.withColumn("measurement_id", F.col(column).cast("long"))


def zero_survey(df: DataFrame) -> DataFrame:
    return df.withColumns({"tid": F.lit(0), "sid": F.lit(0)})


def band_from_fid(df: DataFrame) -> DataFrame:
    return df.withColumn("band", F.col("fid").cast("long"))


def mjd_from_jd(df: DataFrame) -> DataFrame:
    return df.withColumn("mjd", mjd(F.col("jd")).cast("double"))


def position_errors(df: DataFrame) -> DataFrame:
    """The survey's own errors where there are any, else the band's default, in right ascension over |cos dec|."""
    error = F.lit(None).cast("double")
    for band, e in BAND_ERRORS.items():
        error = F.when(F.col("fid") == band, e).otherwise(error)
    e_ra = F.coalesce(error / F.abs(F.cos(F.radians("dec"))), F.lit(float("nan")))
    return df.withColumn("e_ra", F.col("sigmara") if "sigmara" in df.columns else e_ra).withColumn("e_dec", F.col("sigmadec") if "sigmadec" in df.columns else error)


def zero_errors(df: DataFrame) -> DataFrame:
    return df.withColumns({"e_ra": F.lit(0.0), "e_dec": F.lit(0.0)})


def sign_of_difference(df: DataFrame) -> DataFrame:
    return df.withColumn("isdiffpos", F.when(F.col("isdiffpos").isin("t", "1"), 1).otherwise(-1))


def psf_magnitudes(df: DataFrame) -> DataFrame:
    return df.withColumns({"mag": F.col("magpsf").cast("double"), "e_mag": F.col("sigmapsf").cast("double")})


def forced_magnitudes(df: DataFrame) -> DataFrame:
    """Magnitude of the absolute difference flux; 100 where the marker stands for it. Its sign goes to isdiffpos."""
    flux, error = F.col("forcediffimflux"), F.col("forcediffimfluxunc")
    scaled = F.abs(flux) * F.pow(F.lit(10.0), (8.9 - F.col("magzpsci")) / 2.5) * 1e6
    lost, no_error = isclose(flux, NO_FLUX), isclose(error, NO_FLUX)
    mag = F.when(lost, ZERO_MAG).otherwise(-2.5 * F.log10(scaled) + 23.9)
    e_mag = F.when(lost | no_error, ZERO_MAG).otherwise(1.0857 * error / F.abs(flux))
    return df.withColumns({"mag": mag, "e_mag": e_mag, "isdiffpos": F.when(flux > 0, 1).otherwise(-1)})


def null_columns(**kinds: str) -> Step:
    return lambda df: df.withColumns({c: F.lit(None).cast(k) for c, k in kinds.items() if c not in df.columns})


CANDIDATE_STEPS = (numeric_oid, measurement_id("candid"), zero_survey, band_from_fid, mjd_from_jd, position_errors, sign_of_difference, psf_magnitudes)
PREVIOUS_STEPS = (*CANDIDATE_STEPS, null_columns(drb="double", drbversion="string", rfid="long"))
FORCED_STEPS = (drop_bad_forced, numeric_oid, measurement_id("pid"), zero_survey, band_from_fid, mjd_from_jd, forced_magnitudes, zero_errors)


def extract_four_tables(alerts: DataFrame) -> dict[str, DataFrame]:
    """Objects, detections, non-detections and forced photometry of a batch of nested alerts.

    Rows know their alert by (objectId, candid). An object is seen through its earliest alert; previous
    candidates with a candid are detections, those without are non-detections. Each table has one row
    a key; the alert itself wins over a previous candidate of the same candid.
    """
    stamp = {"has_stamp": F.col("cutoutScience").isNotNull() if "cutoutScience" in alerts.columns else F.lit(True)}
    own = alerts.withColumns(stamp).select("objectId", F.col("candid").alias("__alert"), "has_stamp", "candidate.*")
    own = own.drop("candid").withColumnRenamed("__alert", "candid").withColumn("parent_candid", F.lit(None).cast("long"))
    candidates = apply_transforms(own, CANDIDATE_STEPS)
    old = alerts.select("objectId", F.col("candid").alias("parent_candid"), F.lit(False).alias("has_stamp"), F.explode("prv_candidates").alias("p")).select("objectId", "parent_candid", "has_stamp", "p.*")
    previous = apply_transforms(old, PREVIOUS_STEPS)
    where = [F.col("candidate.ra").alias("ra"), F.col("candidate.dec").alias("dec")]
    fp = alerts.select("objectId", F.col("candid").alias("parent_candid"), F.lit(False).alias("has_stamp"), *where, F.explode("fp_hists").alias("p"))
    forced = apply_transforms(fp.select("objectId", "parent_candid", "has_stamp", "ra", "dec", "p.*"), FORCED_STEPS)
    seen = previous.filter("candid is not null")
    detections = candidates.withColumn("__p", F.lit(0)).unionByName(seen.withColumn("__p", F.lit(1)), allowMissingColumns=True)
    return {
        "object": first_row(candidates, ["oid"], F.col("mjd"), F.col("candid")),
        "detection": first_row(detections, TABLE_KEYS["detection"], F.col("__p"), F.col("parent_candid")).drop("__p"),
        "non_detection": first_row(previous.filter("candid is null").select("oid", "band", "mjd", "diffmaglim"), TABLE_KEYS["non_detection"], F.col("diffmaglim")),
        "forced_photometry": first_row(forced, TABLE_KEYS["forced_photometry"], F.col("parent_candid")),
    }


def _only(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*(F.col(c) if c in df.columns else F.lit(None).alias(c) for c in columns))


def initial_object_rows(candidates: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(base, survey) rows of objects first seen: the mean position is the position, one of each kind, no flags."""
    none, no = F.lit(None).cast("double"), F.lit(False)
    base = candidates.select(
        "oid", "tid", "sid", F.col("ra").alias("meanra"), F.col("dec").alias("meandec"), none.alias("sigmara"), none.alias("sigmadec"), F.col("mjd").alias("firstmjd"), F.col("mjd").alias("lastmjd"),
        F.lit(0.0).alias("deltamjd"), F.lit(1).alias("n_det"), F.lit(1).alias("n_forced"), F.lit(1).alias("n_non_det"), no.alias("corrected"), no.alias("stellar"),
    )
    return base, candidates.select("oid", *(none.alias(c) for c in ("g_r_max", "g_r_max_corr", "g_r_mean", "g_r_mean_corr")))


#: Columns of the stored tables.
BASE = ["oid", "measurement_id", "mjd", "ra", "dec", "band"]
DETECTION = "pid diffmaglim isdiffpos nid magpsf sigmapsf magap sigmagap distnr rb rbversion drb drbversion magapbig sigmagapbig rfid".split()
FORCED = (
    "field rcid rfid sciinpseeing scibckgnd scisigpix magzpsci magzpsciunc magzpscirms clrcoeff clrcounc exptime adpctdif1 adpctdif2 diffmaglim programid procstatus distnr ranr decnr magnr sigmagnr chinr sharpnr"
).split()


def _uncorrected(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.lit(None).cast("double") for c in names} | {"corrected": F.lit(False), "dubious": F.lit(False)})


def initial_detection_rows(det: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(base, survey) rows of detections not corrected yet."""
    corr = ["magpsf_corr", "sigmapsf_corr", "sigmapsf_corr_ext"]
    return _only(det, BASE), _only(_uncorrected(det, corr), ["oid", "measurement_id", *DETECTION, *corr, "corrected", "dubious", "parent_candid", "has_stamp"])


def initial_forced_rows(fp: DataFrame) -> tuple[DataFrame, DataFrame]:
    corr = ["mag_corr", "e_mag_corr", "e_mag_corr_ext"]
    return _only(fp, BASE), _only(_uncorrected(fp, corr), ["oid", "measurement_id", "pid", "mag", "e_mag", *corr, "isdiffpos", "corrected", "dubious", "parent_candid", "has_stamp", *FORCED])


def ingest_tables(batch: dict[str, DataFrame], stored: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """All base and survey tables after the batch: rows whose key is stored already are ignored."""
    o, d, f = initial_object_rows(batch["object"]), initial_detection_rows(batch["detection"]), initial_forced_rows(batch["forced_photometry"])
    new = {"object": o[0], "survey_object": o[1], "detection": d[0], "survey_detection": d[1], "forced_photometry": f[0], "survey_forced_photometry": f[1], "non_detection": batch["non_detection"]}
    return {name: insert_ignore(stored[name], df, TABLE_KEYS[name.removeprefix("survey_")]) if name in stored else df for name, df in new.items()}


def surrogate_ids(df: DataFrame, lookup: DataFrame, key: str = "objectId", serial: str = "id", buckets: int = 256) -> tuple[DataFrame, DataFrame]:
    """(rows with their serial, lookup with the new keys). Known keys keep theirs; new ones go on from the largest.

    New keys are numbered within hash buckets, and the buckets by their counts, so no task sorts all of them.
    """
    fresh = df.select(key).filter(F.col(key).isNotNull()).distinct().join(lookup.select(key), key, "left_anti").withColumn("__b", F.pmod(F.xxhash64(key), F.lit(buckets)))
    counts = fresh.groupBy("__b").agg(F.count("*").alias("__n"))  # at most ``buckets`` rows
    before = F.coalesce(F.sum("__n").over(Window.partitionBy(F.lit(0)).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    last = lookup.agg(F.max(serial)).first()[0] or 0
    first = counts.select("__b", (before + F.lit(last)).alias("__first"))
    own = F.row_number().over(Window.partitionBy("__b").orderBy(key))
    new = fresh.withColumn("__k", own).join(F.broadcast(first), "__b").select(key, (F.col("__first") + F.col("__k")).cast("long").alias(serial))
    known = lookup.select(key, F.col(serial).cast("long").alias(serial)).unionByName(new)
    return df.join(known, key, "left"), known


# --- stored rows to message shape ---------------------------------------------------

_GENERIC = "tid sid aid oid pid mjd fid ra dec isdiffpos candid parent_candid has_stamp".split()
_STORED_NAMES = {"magpsf_corr": "mag_corr", "sigmapsf_corr": "e_mag_corr", "sigmapsf_corr_ext": "e_mag_corr_ext"}


def _extra(df: DataFrame, used: Sequence[str]) -> Column:
    rest = [c for c in df.columns if c not in used]
    pairs = [x for c in rest for x in (F.lit(_STORED_NAMES.get(c, c)), F.col(c).cast("string"))]
    return (F.create_map(*pairs) if pairs else F.create_map().cast("map<string,string>")).alias("extra_fields")


def shape_detections(stored: DataFrame) -> DataFrame:
    """Stored detections as messages: band letters, default errors, corrections among the extra fields."""
    dec_error = F.lit(None).cast("double")
    for band, e in BAND_ERRORS.items():
        dec_error = F.when(F.col("fid") == band, e).otherwise(dec_error)
    cos = F.abs(F.cos(F.radians("dec")))
    used = [*_GENERIC, "magpsf", "sigmapsf"]
    head = [F.lit("ZTF").alias("tid"), F.lit("ZTF").alias("sid"), *(F.col(c) for c in ("oid", "pid", "mjd", "ra", "dec", "isdiffpos", "candid", "parent_candid", "has_stamp") if c in stored.columns)]
    return stored.select(
        *head, band_letter(F.col("fid")).alias("fid"), F.col("magpsf").alias("mag"), F.col("sigmapsf").alias("e_mag"), F.when(cos != 0, dec_error / cos).otherwise(float("nan")).alias("e_ra"),
        dec_error.alias("e_dec"), F.lit(False).alias("forced"), F.lit(False).alias("new"), _extra(stored, used),
    )


def shape_limits(stored: DataFrame) -> DataFrame:
    return stored.select(F.lit("ZTF").alias("tid"), F.lit("ZTF").alias("sid"), "oid", "mjd", band_letter(F.col("fid")).alias("fid"), "diffmaglim")


def shape_forced(stored: DataFrame) -> DataFrame:
    """Stored forced photometry as messages: the candid is oid and pid; flags of earlier corrections go."""
    used = ["tid", "sid", "aid", "oid", "pid", "mjd", "fid", "ra", "dec", "mag", "e_mag", "isdiffpos", "parent_candid", "has_stamp", "stellar", "corrected", "dubious"]
    head = [F.lit("ZTF").alias("tid"), F.lit("ZTF").alias("sid"), *(F.col(c) for c in ("oid", "pid", "mjd", "ra", "dec", "mag", "e_mag", "isdiffpos", "parent_candid", "has_stamp") if c in stored.columns)]
    return stored.select(
        *head, band_letter(F.col("fid")).alias("fid"), F.concat(F.col("oid").cast("string"), F.col("pid").cast("string")).alias("candid"), F.lit(0.0).alias("e_ra"), F.lit(0.0).alias("e_dec"),
        F.lit(True).alias("forced"), F.lit(False).alias("new"), _extra(stored, used),
    )


#: Column names of light curves by where they come from.
PROFILES = {
    "database": {"oid": "oid", "time": "mjd", "band": "fid", "magnitude": "magpsf", "error": "sigmapsf", "corrected_magnitude": "magpsf_corr", "corrected_error": "sigmapsf_corr_ext"},
    "explorer": {"oid": "oid", "time": "mjd", "band": "fid", "magnitude": "mag", "error": "e_mag", "corrected_magnitude": "mag_corr", "corrected_error": "e_mag_corr_ext"},
    "batch": {"oid": "objectId", "time": "jd", "band": "fid", "magnitude": "magpsf", "error": "sigmapsf", "corrected_magnitude": "magpsf_corr", "corrected_error": "sigmapsf_corr_ext"},
}


def column_profile(df: DataFrame, origin: str, columns: Sequence[str] | None = None) -> DataFrame:
    """The columns of a light curve under common names; an unknown origin is an error."""
    names = PROFILES[origin]
    return df.select(*(F.col(names[c]).alias(c) for c in (columns or names) if names[c] in df.columns))


def forced_service_observations(lc: DataFrame, least: int = 8, lead: float = 30.0, detected: str = "detected") -> DataFrame:
    """Offline light curves: bands g and r with a good processing status, objects with ``least`` detected
    points, cut from ``lead`` days before the first of these to the last."""
    good = lc.filter(F.col("fid").isin("g", "r") & F.col("procstatus").cast("string").isin("0", "57"))
    own, hit = Window.partitionBy("oid"), F.when(F.col(detected), F.col("mjd"))
    d = good.withColumns({"__n": F.count(hit).over(own), "__a": F.min(hit).over(own), "__b": F.max(hit).over(own)})
    return d.filter((F.col("__n") >= least) & F.col("mjd").between(F.col("__a") - lead, F.col("__b"))).drop("__n", "__a", "__b")


def stamp_shape_ok(df: DataFrame, side: int = 63, rows: str = "stamp_rows", columns: str = "stamp_columns") -> DataFrame:
    return df.filter((F.col(rows) == side) & (F.col(columns) == side))


def valid_reference(ref: DataFrame) -> DataFrame:
    return ref.filter("chinr >= 0")


def drop_same_mjd(obs: DataFrame) -> DataFrame:
    """One observation for each object and time: that with the smallest candid."""
    return first_row(obs, ["oid", "mjd"], F.col("candid"))
