"""The given tables seen as survey tables, in Spark and as the same SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def detections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as detections: an object is a user, a band an event type."""
    e = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("double")
    n = F.col("event_id")
    us = F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', cast(ts as timestamp_ntz))")
    return e.select(
        F.col("user_id").cast("string").alias("oid"), n.alias("candid"), F.col("event_type").alias("fid"), (us / 86400e6 + 40587).alias("mjd"),
        (14 + F.log(1 + F.col("value"))).alias("mag"), (0.02 + 0.001 * (n % 50)).alias("e_mag"), (n % 10 == 0).alias("forced"), F.when(n % 2 == 0, 1).otherwise(-1).alias("isdiffpos"),
        (k / 40).alias("distnr"), (k / 100).alias("rb"), (16 + (n % 40) / 20).alias("magnr"), F.lit(0.05).alias("sigmagnr"), ((n % 30) / 10).alias("distpsnr1"), ((n % 11) / 10).alias("sgscore1"),
        ((n % 7) / 2).alias("chinr"), ((n % 9 - 4) / 20).alias("sharpnr"), (n % 4 != 0).alias("new"), F.when(n % 3 == 0, "atlas").otherwise("ztf").alias("sid"),
        ((F.col("user_id") * 137.508) % 360 + (n % 5) * 1e-5).alias("ra"), (((F.col("user_id") * 7919) % 16000) / 100 - 80 + (n % 7) * 1e-5).alias("dec"),
        (0.1 + 0.01 * (n % 4)).alias("e_ra"), (0.1 + 0.01 * (n % 6)).alias("e_dec"),
    )


DET = """det AS (SELECT CAST(user_id AS VARCHAR) AS oid, event_id AS candid, event_type AS fid, epoch_us(ts) / 86400e6 + 40587 AS mjd,
 14 + ln(1 + value) AS mag, 0.02::double + 0.001::double * (event_id % 50) AS e_mag, event_id % 10 = 0 AS forced, CASE WHEN event_id % 2 = 0 THEN 1 ELSE -1 END AS isdiffpos,
 CAST(json_extract_string(props, '$.k') AS DOUBLE) / 40 AS distnr, CAST(json_extract_string(props, '$.k') AS DOUBLE) / 100 AS rb, 16 + (event_id % 40) / 20 AS magnr, 0.05::double AS sigmagnr,
 (event_id % 30) / 10 AS distpsnr1, (event_id % 11) / 10 AS sgscore1, (event_id % 7) / 2 AS chinr, (event_id % 9 - 4) / 20 AS sharpnr, event_id % 4 <> 0 AS new,
 CASE WHEN event_id % 3 = 0 THEN 'atlas' ELSE 'ztf' END AS sid, (user_id * 137.508::double) % 360 + (event_id % 5) * 1e-5::double AS ra, ((user_id * 7919) % 16000) / 100 - 80 + (event_id % 7) * 1e-5::double AS dec,
 0.1::double + 0.01::double * (event_id % 4) AS e_ra, 0.1::double + 0.01::double * (event_id % 6) AS e_dec FROM events)"""


def limits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Non-detections: one for each event, a day earlier and a magnitude fainter."""
    return detections(spark, sf_dir).select("oid", "sid", "fid", (F.col("mjd") - 1).alias("mjd"), (F.col("mag") + 1).alias("diffmaglim"))


ND = "nd AS (SELECT oid, sid, fid, mjd - 1 AS mjd, mag + 1 AS diffmaglim FROM det )"


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    return s.select(F.col("s_suppkey").alias("cat_id"), ((F.col("s_suppkey") * 137.508) % 360).alias("ra"), ((F.col("s_suppkey") * 7919) % 18000 / 100 - 90).alias("dec"), F.col("s_acctbal").alias("w1"))


CAT = "cat AS (SELECT s_suppkey AS cat_id, (s_suppkey * 137.508::double) % 360 AS ra, (s_suppkey * 7919) % 18000 / 100 - 90 AS dec, s_acctbal AS w1 FROM supplier)"


def objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    return c.select(k.alias("oid"), ((k * 137.508) % 360).alias("ra"), ((k * 7919) % 18000 / 100 - 90 + (k % 7) * 1e-4).alias("dec"))


OBJ = "obj AS (SELECT c_custkey AS oid, (c_custkey * 137.508::double) % 360 AS ra, (c_custkey * 7919) % 18000 / 100 - 90 + (c_custkey % 7) * 1e-4::double AS dec FROM customer)"


def probabilities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long class probabilities: an order's share of quantity by line status and return flag."""
    li = table(spark, sf_dir, "lineitem").withColumn("class_name", F.concat("l_returnflag", "l_linestatus"))
    g = li.groupBy(F.col("l_orderkey").alias("oid"), "class_name").agg(F.sum("l_quantity").alias("q"))
    total = li.groupBy(F.col("l_orderkey").alias("oid")).agg(F.sum("l_quantity").alias("t"))
    return g.join(total, "oid").select("oid", F.lit("share").alias("classifier_name"), F.lit("1.0").alias("classifier_version"), "class_name", (F.col("q") / F.col("t")).alias("probability"))


PROB = """prob AS (SELECT oid, 'share' AS classifier_name, '1.0' AS classifier_version, class_name, q / sum(q) OVER (PARTITION BY oid) AS probability
 FROM (SELECT l_orderkey AS oid, l_returnflag || l_linestatus AS class_name, sum(l_quantity) AS q FROM lineitem GROUP BY ALL))"""


def alerts(spark: SparkSession, sf_dir: str, distinct: bool = False) -> DataFrame:
    """Every event as a nested alert: a candidate, one previous candidate or limit, and one forced measurement.

    Names have a year and two letters of their own, so they come again after 67,600 users; ``distinct`` names go on in the
    other five letters and never do.
    """
    det = detections(spark, sf_dir)
    uid, n = F.col("oid").cast("long"), F.col("candid")
    letter = lambda x: F.char((97 + x % 26).cast("int"))
    over = lambda n: F.call_function("div", uid, F.lit(n))
    more = [letter(over(67600 * 26**k)) for k in (4, 3, 2, 1, 0)] if distinct else [F.lit("aaaaa")]
    name = F.concat(F.lit("ZTF"), F.lpad((over(676) % 100).cast("string"), 2, "0"), *more, letter(over(26)), letter(uid))
    jd, band, sign = F.col("mjd") + 2400000.5, (1 + n % 3).alias("fid"), F.when(F.col("isdiffpos") == 1, "t").otherwise("f").alias("isdiffpos")
    candidate = F.struct(jd.alias("jd"), band, "ra", "dec", F.col("mag").alias("magpsf"), F.col("e_mag").alias("sigmapsf"), sign, (n * 7).alias("pid"), (F.col("mag") + 1).alias("diffmaglim"), "rb", "distnr")
    seen = F.when(n % 2 == 0, n * 1000003 + 1)
    previous = F.struct(
        seen.alias("candid"), (jd - 1).alias("jd"), band, "ra", "dec", (F.col("mag") + 0.5).alias("magpsf"), F.col("e_mag").alias("sigmapsf"), sign, (n * 7 + 2).alias("pid"), (F.col("mag") + 1).alias("diffmaglim")
    )
    flux = (10.0 * (n % 5)).alias("forcediffimflux")
    forced = F.struct((n * 7 + 1).alias("pid"), (jd - 2).alias("jd"), band, flux, F.lit(1.0).alias("forcediffimfluxunc"), F.lit(26.0).alias("magzpsci"), F.lit("0").alias("procstatus"))
    return det.select(name.alias("objectId"), n.alias("candid"), candidate.alias("candidate"), F.array(previous).alias("prv_candidates"), F.array(forced).alias("fp_hists"))
