"""Further registered queries: surveys' parsers, catalogue matches, the whole feature set and the forest."""

from __future__ import annotations

from pyspark.sql import functions as F

from skyflow.operators import feature_sets, outputs, parse, sky, variability
from skyflow.operators.merge import KeyedTable
from skyflow.plans import driver_tables as T
from skyflow.plans.catalog import register
from skyflow.sources.readers import replay_alert_dir, shared_folder
from skyflow.streaming.stages import state_stage
from skyflow.streaming.state import STATISTICS


@register(
    "standardized_atlas",
    """SELECT 'A' || oid AS oid, candid::VARCHAR AS candid, mjd, fid, ra, dec, mag, e_mag, CASE WHEN isdiffpos = 1 THEN 1 ELSE -1 END AS isdiffpos, 0.14::double / abs(cos(radians(dec))) AS e_ra, 0.14::double AS e_dec,
 'ATLAS-' || sid AS tid, 'ATLAS' AS sid, candid * 7 AS pid FROM det""",
    "mjd ra dec mag e_mag e_ra e_dec",
    5,
)
def standardized_atlas(s, d):
    det = T.detections(s, d)
    sign = F.when(F.col("isdiffpos") == 1, "t").otherwise("f").alias("isdiffpos")
    inner = F.struct((F.col("candid") * 7).alias("pid"), "candid", "mjd", F.col("fid").alias("filter"), F.col("ra").alias("RA"), F.col("dec").alias("Dec"), F.col("mag").alias("Mag"), F.col("e_mag").alias("Dmag"), sign)
    return parse.standardize_atlas(det.select(F.concat(F.lit("A"), "oid").alias("objectId"), F.concat(F.lit("ATLAS-"), "sid").alias("publisher"), inner.alias("candidate")))


@register(
    "standardized_lsst",
    """SELECT oid, candid::VARCHAR AS candid, mjd, fid, ra, dec, mag * isdiffpos AS mag, e_mag, isdiffpos, 0.1::double / abs(cos(radians(dec))) AS e_ra, 0.1::double AS e_dec, 'LSST' AS tid, 'LSST' AS sid, (-999)::BIGINT AS pid FROM det""",
    "mjd ra dec mag e_mag e_ra e_dec",
    5,
)
def standardized_lsst(s, d):
    det = T.detections(s, d)
    source = F.struct(
        F.col("oid").cast("long").alias("diaObjectId"), F.col("mjd").alias("midPointTai"), F.col("fid").alias("filterName"), "ra", F.col("dec").alias("decl"), (F.col("mag") * F.col("isdiffpos")).alias("psFlux"), F.col("e_mag").alias("psFluxErr")
    )
    return parse.standardize_lsst(det.select(F.col("candid").alias("alertId"), source.alias("diaSource")))


@register(
    "attach_xmatch",
    """SELECT o.oid, arg_max(c.cat_id, (c.sep, c.cat_id)) AS cat_id, max(c.sep) AS sep FROM (SELECT DISTINCT oid FROM det) o
 LEFT JOIN (SELECT s_suppkey::VARCHAR AS oid, k AS cat_id, ((s_suppkey * 31 + k * 17) % 97) / 100.0::double AS sep FROM supplier, range(3) t(k)) c USING (oid) GROUP BY o.oid""",
    "sep",
)
def attach_xmatch(s, d):
    matches = T.table(s, d, "supplier").select(F.col("s_suppkey").cast("string").alias("oid"), F.explode(F.array(*(F.lit(k).cast("long") for k in range(3)))).alias("cat_id"), "s_suppkey")
    matches = matches.withColumn("sep", (F.col("s_suppkey") * 31 + F.col("cat_id") * 17) % 97 / 100)
    found = sky.attach_xmatch(T.detections(s, d).select("oid").distinct(), matches)
    return found.select("oid", F.col("xmatches.allwise.cat_id").alias("cat_id"), F.col("xmatches.allwise.sep").alias("sep"))


@register(
    "heliocentric_times",
    """SELECT candid, mjd_original - r * 0.0057755183::double * (cos(radians(dec)) * cos(radians(ra)) * cos(lam) + cos(radians(dec)) * sin(radians(ra)) * cos(radians(23.439::double)) * sin(lam)
 + sin(radians(dec)) * sin(radians(23.439::double)) * sin(lam)) AS mjd FROM (
 SELECT *, radians(280.460::double + 0.9856474::double * n) + radians(1.915::double * sin(g) + 0.020::double * sin(2 * g)) AS lam, 1.00014::double - 0.01671::double * cos(g) - 0.00014::double * cos(2 * g) AS r
 FROM (SELECT *, mjd AS mjd_original, mjd - 51544.5::double AS n, radians(357.528::double + 0.9856003::double * (mjd - 51544.5::double)) AS g FROM det))""",
    "mjd",
    9,
)
def heliocentric_times(s, d):
    return variability.helio_correct(T.detections(s, d)).select("candid", "mjd")


@register(
    "constant_probability",
    """SELECT oid, fid, CASE WHEN h <= 0 THEN 0.0::double ELSE least(list_sum(list_transform(range(0, CAST(h + 40 * sqrt(h) + 200 AS BIGINT)), lambda i: exp((a + i) * ln(h) - h - lgamma(a + i + 1)))), 1.0::double) END AS Pvar FROM (
 SELECT oid, fid, sum(pow((mag - mean) / e_mag, 2)) / 2 AS h, (count(*) - 1) / 2 AS a, count(*) AS n FROM (SELECT *, avg(mag) OVER (PARTITION BY oid, fid) AS mean FROM det WHERE NOT forced) GROUP BY oid, fid) WHERE n >= 6""",
    "Pvar",
    5,
)
def constant_probability(s, d):
    return variability.pvar(T.detections(s, d))


@register("whole_feature_set")
def whole_feature_set(s, d):
    """Every extractor of the set, with catalogue matches, metadata and references derived from the given tables."""
    det = T.detections(s, d).withColumn("rfid", F.col("candid") % 3)
    refs = det.select("oid", "rfid", F.col("rfid").cast("double").alias("sharpnr"), (2.0 * F.col("rfid")).alias("chinr")).distinct()
    xmatch = T.catalog(s, d).select(F.col("cat_id").cast("string").alias("oid"), *((F.col("w1") + k).alias(f"w{k + 1}") for k in range(4)))
    mags = [F.min(F.col("mag") + k).alias(f"s{b}mag1") for k, b in enumerate("griz")]
    metadata = det.groupBy("oid").agg(F.min("sgscore1").alias("sgscore1"), F.min("distpsnr1").alias("distpsnr1"), *mags)
    return feature_sets.feature_set(det, "ztf", ["click", "view"], xmatch=xmatch, metadata=metadata, references=refs)


@register("hierarchical_forest")
def hierarchical_forest(s, d):
    """Return flags, and line status below them, predicted for every order line from its numbers."""
    lines = T.table(s, d, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_returnflag").alias("top"), F.concat("l_returnflag", "l_linestatus").alias("child"), *(F.col(c).cast("double").alias(c) for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax"))
    )
    predict = outputs.hierarchical_forest(lines, "top", "child", ["l_quantity", "l_extendedprice", "l_discount", "l_tax"], trees=5, depth=4)
    return predict(lines).drop("l_quantity", "l_extendedprice", "l_discount", "l_tax")


@register(
    "streamed_object_state",
    """SELECT oid, sid, fid, avg(mag) magmean, max(mag) magmax, min(mag) magmin, stddev_pop(mag) magsigma, arg_min(mag, (mjd, candid)) magfirst, arg_max(mag, (mjd, candid)) maglast, min(mjd) firstmjd,
 max(mjd) lastmjd, count(*) ndet FROM det WHERE NOT forced GROUP BY ALL""",
    " ".join(STATISTICS[:-1]),
)
def streamed_object_state(s, d):
    """Statistics held in a stream's state after all detections came, out of order and a third of them twice."""
    det = T.detections(s, d).drop("new")
    folder = shared_folder(s, "streamed")
    for k in (1, 0, 1, 2):
        det.filter(F.col("candid") % 3 == k).write.mode("append").parquet(f"{folder}/in")
    table = KeyedTable(s, f"{folder}/state", ["oid", "sid", "fid"], ["oid"])
    state_stage(replay_alert_dir(s, f"{folder}/in", det.schema, files_per_batch=16), table, f"{folder}/checkpoint").awaitTermination()
    return table.read().select("oid", "sid", "fid", *STATISTICS)
