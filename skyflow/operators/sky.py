"""Joins on the sphere.

The right side lives in one cell each: a declination band, and in it a cell of right ascension whose
width follows the band's cosine. A left row is sent to the bands and cells its radius touches, so the
join is an equi-join on the cell; an exact separation test follows. Poles and the 0/360 seam need no
special case. The join key is shuffled by Spark, and a crowded field splits under adaptive skew joins.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyflow.functions.columns import aid_encode, aid_number, separation


def _cells(band: Column, step: float) -> Column:
    """Number of cells of a declination band."""
    low, high = F.radians(band * step - 90), F.radians((band + 1) * step - 90)
    widest = F.when((band * step - 90 <= 0) & ((band + 1) * step - 90 >= 0), 1.0).otherwise(F.greatest(F.cos(low), F.cos(high)))
    return F.greatest(F.floor(360 * widest / step), F.lit(1)).cast("long")


def sky_join(left: DataFrame, right: DataFrame, radius: Column, max_radius: float) -> DataFrame:
    """All pairs within ``radius`` degrees (a column of the left side, at most ``max_radius``).

    Both sides have ra and dec in degrees; the right side's are renamed ra_right and dec_right. Adds
    ``sep`` in arcsec. Rows with a null position or radius match nothing.
    """
    step = max(max_radius, 0.01)
    top = math.floor(180 / step)
    home = F.floor((F.col("dec_right") + 90) / step).cast("long")
    r = right.withColumnsRenamed({"ra": "ra_right", "dec": "dec_right"}).withColumn("__band", home)
    n = _cells(F.col("__band"), step)
    r = r.withColumn("__cell", F.pmod(F.floor(F.col("ra_right") / 360 * n), n))
    l = left.withColumn("__r", radius.cast("double")).withColumn("__b0", F.floor((F.col("dec") + 90) / step).cast("long"))
    l = l.filter("__b0 is not null and __r is not null and ra is not null").withColumn("__band", F.explode(F.sequence(F.greatest(F.col("__b0") - 1, F.lit(0)), F.least(F.col("__b0") + 1, F.lit(top)))))
    n = _cells(F.col("__band"), step)
    reach = F.sin(F.radians(F.col("__r"))) / F.cos(F.radians(F.col("dec")))
    half = F.when((F.abs(F.col("dec")) + F.col("__r") >= 90) | (reach >= 1), 180.0).otherwise(F.degrees(F.asin(F.least(reach, F.lit(1.0)))))
    first, last = F.floor((F.col("ra") - half) / 360 * n), F.floor((F.col("ra") + half) / 360 * n)
    cells = F.sequence(first, F.least(last, first + n - 1))
    l = l.withColumn("__cell", F.explode(F.array_distinct(F.transform(cells, lambda c: F.pmod(c, n)))))
    sep = separation(F.col("ra"), F.col("dec"), F.col("ra_right"), F.col("dec_right"))
    pairs = l.join(r, ["__band", "__cell"]).withColumn("sep", sep).filter(F.col("sep") <= F.col("__r") * 3600)
    return pairs.drop("__band", "__cell", "__b0", "__r")


def crossmatch(objects: DataFrame, catalog: DataFrame, radius_arcsec: float = 1.0, k: int = 1, key: str = "oid", tie: str = "cat_id") -> DataFrame:
    """The ``k`` nearest catalogue rows of each object within the radius."""
    pairs = sky_join(objects, catalog, F.lit(radius_arcsec / 3600), radius_arcsec / 3600)
    w = Window.partitionBy(key).orderBy("sep", tie)
    return pairs.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def watchlist_match(alerts: DataFrame, targets: DataFrame, cap_arcsec: float = 30.0) -> DataFrame:
    """All (target, alert) pairs within least(target radius in degrees, cap)."""
    cap = cap_arcsec / 3600
    return sky_join(targets, alerts, F.least(F.col("radius"), F.lit(cap)), cap)


def assign_aid(alerts: DataFrame, known: DataFrame, radius_arcsec: float = 1.5) -> DataFrame:
    """Give each object of the batch an aid: the known one, else the nearest object's, else a new one from its first position."""
    first = alerts.groupBy("oid").agg(F.min_by(F.struct("ra", "dec", "mjd"), F.struct("mjd", "candid")).alias("p")).select("oid", "p.ra", "p.dec", "p.mjd")
    by_oid = first.join(known.select("oid", F.col("aid").alias("known_aid")).dropDuplicates(["oid"]), "oid", "left")
    lost = by_oid.filter("known_aid is null")
    near = crossmatch(lost, known.select("aid", "ra", "dec"), radius_arcsec, 1, "oid", "aid").select("oid", F.col("aid").alias("near_aid"))
    year = F.lpad((F.floor((F.col("mjd") - 51544) / 365.25) % 100).cast("string"), 2, "0")
    new = F.concat(F.lit("AL"), year, aid_encode(aid_number(F.col("ra"), F.col("dec"))))
    return by_oid.join(near, "oid", "left").select("oid", F.coalesce("known_aid", "near_aid", new).alias("aid"), F.when(F.col("known_aid").isNotNull(), "known").when(F.col("near_aid").isNotNull(), "near").otherwise("new").alias("how"))


def attach_xmatch(lightcurves: DataFrame, matches: DataFrame) -> DataFrame:
    """Nested match, null where there is none; the last match of an object wins."""
    last = matches.groupBy("oid").agg(F.max_by(F.struct("cat_id", "sep"), F.struct("sep", "cat_id")).alias("allwise"))
    return lightcurves.join(last, "oid", "left").withColumn("xmatches", F.when(F.col("allwise").isNotNull(), F.struct("allwise"))).drop("allwise")
