"""Registered queries over the given tables, each with the same result in SQL where SQL can say it."""

from __future__ import annotations

import math
import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyflow.functions import columns as C
from skyflow.operators import classify, correct, features, filters, history, merge, period, sky, stats, training
from skyflow.plans import driver_tables as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
DET, ND, CAT, OBJ, PROB = (f"{x}" for x in (T.DET, T.ND, T.CAT, T.OBJ, T.PROB))


def _rounded(df: DataFrame, cols: list[str], digits: int) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) + F.lit(0.0) for c in cols})


def register(name: str, sql: str | None = None, floats: str = "", digits: int = 6, longs: str = ""):
    """Register a query; doubles in ``floats`` are rounded on both sides, so that sums in another order agree; ``longs`` are widened."""
    cols = floats.split()

    def run(fn, s, d):
        df = fn(s, d).withColumns({c: F.col(c).cast("long") for c in longs.split()}) if longs else fn(s, d)
        return _rounded(df, cols, digits) if cols else df

    def add(fn):
        QUERIES[name] = lambda s, d: run(fn, s, d)
        if sql:
            named = lambda cte: re.search(rf"\b{cte.split()[0]}\b", sql)
            ctes = ", ".join(x for x in (DET, ND, CAT, OBJ, PROB) if named(x) or x is DET and named(ND))
            head = f"WITH {ctes} " if ctes else ""
            body = f"SELECT * REPLACE ({', '.join(f'round({c}, {digits}) + 0.0::double AS {c}' for c in cols)}) FROM ({sql})" if cols else sql
            ORACLE[name] = head + body
        return fn

    return add


MAGS = "magmean magmedian magmax magmin magsigma magfirst maglast"


@register(
    "mag_stats",
    """SELECT oid, sid, fid, avg(mag) magmean, quantile_cont(mag, 0.5) magmedian, max(mag) magmax, min(mag) magmin, stddev_pop(mag) magsigma, arg_min(mag, (mjd, candid))
 magfirst, arg_max(mag, (mjd, candid)) maglast, min(mjd) firstmjd, max(mjd) lastmjd, count(*) ndet FROM det WHERE NOT forced GROUP BY ALL""",
    MAGS + " firstmjd lastmjd",
)
def mag_stats(s, d):
    det = correct.correct_magnitudes(correct.with_flags(T.detections(s, d)))
    return stats.generate_statistics(det, only={*MAGS.split(), "firstmjd", "lastmjd", "ndet"})


FLAGS = """f1 AS (SELECT *, CASE WHEN new THEN coalesce(distnr < 1.4, false) ELSE false END AS corrected FROM det ),
f2 AS (SELECT *, min(CASE WHEN new THEN (mjd, candid, corrected) END) OVER (PARTITION BY oid, fid) AS fr FROM f1),
f3 AS (SELECT *, coalesce((NOT corrected AND isdiffpos = -1) OR (fr[3] AND NOT corrected) OR (NOT fr[3] AND corrected), false) AS dubious,
  coalesce(distnr < 1.4 AND ((distpsnr1 < 1 AND sgscore1 > 0.4) OR (NOT distpsnr1 < 1 AND chinr < 2 AND sharpnr > -0.13 AND sharpnr < 0.1)), false) AS st FROM f2),
f4 AS (SELECT *, CASE WHEN new THEN st ELSE coalesce((min(CASE WHEN new THEN (mjd, candid, st) END) OVER (PARTITION BY oid))[3], false) END AS stellar,
  pow(10, -0.4 * magnr) AS a1, pow(10, -0.4 * mag) AS a2, greatest(a1 + isdiffpos * a2, 0) AS a3, pow(a2 * e_mag, 2) - pow(a1 * sigmagnr, 2) AS a4 FROM f3),
corr AS (SELECT *, CASE WHEN corrected AND new THEN CASE WHEN a3 = 0 THEN 100 ELSE -2.5 * log10(CASE WHEN a3 > 0 THEN a3 END) END END AS mag_corr,
  CASE WHEN corrected AND new THEN CASE WHEN a4 < 0 OR a3 = 0 THEN 100 ELSE sqrt(CASE WHEN a4 >= 0 THEN a4 END) / a3 END END AS e_mag_corr,
  CASE WHEN corrected AND new THEN CASE WHEN a3 = 0 THEN 100 ELSE a2 * e_mag / a3 END END AS e_mag_corr_ext FROM f4)"""


@register(
    "correct_magnitudes",
    f"""SELECT oid, candid, corrected, dubious, stellar, mag_corr, e_mag_corr, e_mag_corr_ext FROM (WITH {FLAGS} SELECT * FROM corr)""",
    "mag_corr e_mag_corr e_mag_corr_ext",
)
def correct_magnitudes(s, d):
    return correct.correct_magnitudes(correct.with_flags(T.detections(s, d))).select("oid", "candid", "corrected", "dubious", "stellar", "mag_corr", "e_mag_corr", "e_mag_corr_ext")


@register("corrected_stats", f"""SELECT oid, sid, fid, avg(mag_corr) FILTER (corrected) magmean_corr, quantile_cont(mag_corr, 0.5) FILTER (corrected) magmedian_corr, stddev_pop(mag_corr) FILTER (corrected) magsigma_corr,
 arg_min(corrected, (mjd, candid)) corrected, arg_min(stellar, (mjd, candid)) stellar, count(*) FILTER (dubious) ndubious,
 CASE WHEN sid = 'ztf' THEN count(*) FILTER (mag_corr < 13.2) / nullif(count(*) FILTER (corrected), 0) END saturation_rate FROM (WITH {FLAGS} SELECT * FROM corr) WHERE NOT forced GROUP BY oid, sid, fid""", "magmean_corr magmedian_corr magsigma_corr saturation_rate")
def corrected_stats(s, d):
    det = correct.correct_magnitudes(correct.with_flags(T.detections(s, d)))
    return stats.generate_statistics(det, only={"magmean_corr", "magmedian_corr", "magsigma_corr", "corrected", "stellar", "ndubious", "saturation_rate"})


@register("dmdt", """SELECT oid, sid, fid, b.dt AS dt_first, b.dm AS dm_first, b.sigmadm AS sigmadm_first, b.dmdt AS dmdt_first FROM (
 SELECT oid, sid, fid, arg_min({'dt': f.mjd - n.mjd, 'dm': f.mag - diffmaglim, 'sigmadm': f.e - diffmaglim, 'dmdt': (f.mag + f.e - diffmaglim) / (f.mjd - n.mjd)}, ((f.mag + f.e - diffmaglim) / (f.mjd - n.mjd), n.mjd)) AS b
 FROM nd n JOIN (SELECT oid, sid, fid, min(mjd) mjd, arg_min(mag, (mjd, candid)) mag, arg_min(e_mag, (mjd, candid)) e FROM det WHERE NOT forced GROUP BY ALL) f USING (oid, sid, fid) WHERE f.mjd - n.mjd > 0.5 GROUP BY ALL)""", "dt_first dm_first sigmadm_first dmdt_first")
def dmdt(s, d):
    return stats.dmdt(T.detections(s, d), T.limits(s, d))


@register("object_stats", f"""SELECT oid, sum(ra / pow(e_ra / 3600, 2)) / sum(1 / pow(e_ra / 3600, 2)) meanra, sqrt(1 / sum(1 / pow(e_ra / 3600, 2))) * 3600 sigmara, sum(dec / pow(e_dec / 3600, 2)) / sum(1 / pow(e_dec / 3600, 2)) meandec,
 sqrt(1 / sum(1 / pow(e_dec / 3600, 2))) * 3600 sigmadec, min(mjd) firstmjd, max(mjd) lastmjd, max(mjd) - min(mjd) deltamjd, string_agg(DISTINCT sid, ',' ORDER BY sid) sids,
 arg_min(corrected, (mjd, candid)) FILTER (sid = 'ztf') corrected, arg_min(stellar, (mjd, candid)) FILTER (sid = 'ztf') stellar, count(*) ndet, arg_min(isdiffpos, (mjd, candid)) > 0 diffpos
 FROM (WITH {FLAGS} SELECT * FROM corr) WHERE NOT forced GROUP BY oid""", "meanra sigmara meandec sigmadec firstmjd lastmjd deltamjd")
def object_stats(s, d):
    return stats.object_statistics(correct.with_flags(T.detections(s, d)))


@register(
    "mean_coordinates",
    """SELECT oid, sum(ra / pow(e_ra, 2)) / sum(1 / pow(e_ra, 2)) meanra, sum(dec / pow(e_dec, 2)) / sum(1 / pow(e_dec, 2)) meandec FROM det WHERE NOT forced GROUP BY oid""",
    "meanra meandec",
)
def mean_coordinates(s, d):
    return correct.mean_coordinates(T.detections(s, d))


@register(
    "survey_dispatch",
    """SELECT candid, CASE WHEN lower(sid) = 'ztf' THEN mag WHEN lower(sid) = 'atlas' THEN mag * pow(10, -3.9 / 2.5) END AS value FROM det""",
    "value",
)
def survey_dispatch(s, d):
    return T.detections(s, d).select("candid", correct.by_survey({"ztf": F.col("mag"), "atlas": correct.correct_lsst(F.col("mag"))}, None).alias("value"))


@register("dedup_detections", "SELECT oid, candid, fid, new, mag FROM det ", "mag")
def dedup_detections(s, d):
    det = T.detections(s, d)
    both = det.unionByName(det.withColumns({"new": F.lit(False), "mag": F.col("mag") + 1}))
    # of a new row and its copy the new one stays, of two old ones the brighter
    return history.dedup_detections(both).select("oid", "candid", "fid", "new", "mag")


@register("dedup_limits", "SELECT DISTINCT oid, fid, mjd FROM nd ")
def dedup_limits(s, d):
    nd = T.limits(s, d)
    return history.dedup_limits(nd.unionByName(nd)).select("oid", "fid", "mjd")


@register("keep_last_earliest", "SELECT oid, arg_max(candid, mjd) last_candid, arg_min(candid, mjd) first_candid FROM det GROUP BY oid")
def keep_last_earliest(s, d):
    det = T.detections(s, d).select("oid", "candid", "mjd")
    return history.keep_last(det, "oid", "mjd").select("oid", F.col("candid").alias("last_candid")).join(history.keep_earliest(det, "oid", "mjd").select("oid", F.col("candid").alias("first_candid")), "oid")


@register(
    "union_history",
    """SELECT x.oid, candid, new FROM det x JOIN (SELECT oid, max(mjd) m FROM det WHERE new GROUP BY oid) l
 ON x.oid = l.oid AND x.mjd <= l.m""",
)
def union_history(s, d):
    det = T.detections(s, d)
    batch, stored = det.filter("new"), det.filter("not new")
    return history.as_of_cut(history.union_history(batch, stored), batch).select("oid", "candid", "new")


@register(
    "top_k_magnitudes",
    """SELECT oid, candid, mag, rank FROM (SELECT *, row_number() OVER (PARTITION BY oid ORDER BY mag DESC, candid) rank FROM det ) WHERE rank <= 5""",
    "mag",
    longs="rank",
)
def top_k_magnitudes(s, d):
    return history.top_k(T.detections(s, d), ["oid"], "mag", 5, "candid").select("oid", "candid", "mag", "rank")


@register(
    "bundle_by_object",
    """SELECT oid, array_to_string(list_sort(list(DISTINCT candid)), ',') candids, count(*) n_rows, string_agg(DISTINCT fid, ',' ORDER BY fid) bands FROM det GROUP BY oid""",
)
def bundle_by_object(s, d):
    return history.bundle_by_object(T.detections(s, d)).withColumn("candids", F.array_join(F.col("candids").cast("array<string>"), ","))


@register("shorten_days", """SELECT oid, candid FROM (SELECT *, max(CASE WHEN k THEN mjd END) OVER (PARTITION BY oid) l FROM
 (SELECT *, NOT forced AND mjd <= min(CASE WHEN NOT forced THEN mjd END) OVER (PARTITION BY oid) + 8 k FROM det )) WHERE k OR (forced AND mjd < l)""")
def shorten_days(s, d):
    return history.shorten_days(T.detections(s, d), 8).select("oid", "candid")


@register("shorten_ndet", """SELECT oid, candid FROM (SELECT *, max(CASE WHEN k THEN mjd END) OVER (PARTITION BY oid) l FROM
 (SELECT *, NOT forced AND row_number() OVER (PARTITION BY oid, forced ORDER BY mjd, candid) <= 7 k FROM det )) WHERE k OR (forced AND mjd < l)""")
def shorten_ndet(s, d):
    return history.shorten_ndet(T.detections(s, d), 7).select("oid", "candid")


@register("trim_to_span", """SELECT oid, count(*) n, min(mjd) start FROM (SELECT *, min((-c, mjd)) OVER (PARTITION BY oid) b FROM (SELECT *, count(*) OVER (PARTITION BY oid ORDER BY mjd RANGE BETWEEN CURRENT ROW AND 5 FOLLOWING) c FROM det )) WHERE mjd >= b[2] AND mjd <= b[2] + 5 GROUP BY oid""", "start")
def trim_to_span(s, d):
    return history.trim_to_span(T.detections(s, d), 5.0).groupBy("oid").agg(F.count("*").alias("n"), F.min("mjd").alias("start"))


@register(
    "quality_filters",
    """SELECT oid, candid FROM (SELECT *, count(*) FILTER (NOT forced) OVER (PARTITION BY oid) n FROM det WHERE forced OR rb >= 0.55) WHERE n >= 20 AND lower(sid) = 'ztf'""",
)
def quality_filters(s, d):
    return filters.min_detections(filters.drop_bogus(T.detections(s, d)), 20).filter(filters.survey_mask("ZTF")).select("oid", "candid")


@register(
    "reference_close",
    """SELECT oid, fid, count(*) n, avg(distnr) mean_distnr, stddev_samp(distnr) sigma_distnr, sum(sharpnr) / count(*) mean_sharpnr FROM det WHERE distnr BETWEEN 0 AND 5 AND
 e_mag > 0 AND fid IN ('click', 'view') GROUP BY oid, fid""",
    "mean_distnr sigma_distnr mean_sharpnr",
)
def reference_close(s, d):
    obs = filters.reference_close(T.detections(s, d).withColumn("e_brightness", F.col("e_mag")), ["click", "view"])
    return obs.groupBy("oid", "fid").agg(F.count("*").alias("n"), F.avg("distnr").alias("mean_distnr"), F.stddev_samp("distnr").alias("sigma_distnr"), F.avg("sharpnr").alias("mean_sharpnr"))


WATCH = {"type": "and", "params": {"filters": [{"type": "constant", "params": {"field": "mag", "constant": 18, "op": "less"}}, {"type": "or", "params": {"filters": [{"type": "constant", "params": {"field": "rb", "constant": 0.5, "op": "greater eq"}}, {"type": "constant", "params": {"field": "isdiffpos", "constant": 1, "op": "eq"}}]}}]}}


@register("watchlist_filter", "SELECT candid, coalesce(rb IS NOT NULL AND mag < 18 AND (rb >= 0.5 OR isdiffpos = 1), false) AS ready_to_notify FROM det")
def watchlist_filter(s, d):
    return filters.ready_to_notify(T.detections(s, d), WATCH, ["mag", "rb"]).select("candid", "ready_to_notify")


@register(
    "exclude_objects",
    """SELECT oid, candid FROM det WHERE CAST(oid AS BIGINT) NOT IN
 (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""",
)
def exclude_objects(s, d):
    listed = T.table(s, d, "customer").filter("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").cast("string").alias("oid"))
    return filters.exclude_objects(T.detections(s, d), listed).select("oid", "candid")


SEP = "2 * degrees(asin(sqrt(least(pow(sin(radians({b}.dec - {a}.dec) / 2), 2) + cos(radians({a}.dec)) * cos(radians({b}.dec)) * pow(sin(radians({b}.ra - {a}.ra) / 2), 2), 1)))) * 3600".format(a="o", b="c")


@register(
    "crossmatch",
    f"""SELECT oid, cat_id, sep, rank FROM (SELECT *, row_number() OVER (PARTITION BY oid ORDER BY sep, cat_id) rank FROM (SELECT o.oid, cat_id, {SEP} sep FROM obj o, cat c)
 WHERE sep <= 1800) WHERE rank <= 2""",
    "sep",
    3,
    longs="rank",
)
def crossmatch(s, d):
    return sky.crossmatch(T.objects(s, d), T.catalog(s, d), 1800.0, 2).select("oid", "cat_id", "sep", "rank")


@register(
    "watchlist_match",
    f"""SELECT cat_id AS target, oid, sep FROM (SELECT o.oid, cat_id, {SEP} sep, least((cat_id % 7) / 1000, 30 / 3600) r FROM obj o, cat c) WHERE sep <= r * 3600""",
    "sep",
    3,
)
def watchlist_match(s, d):
    targets = T.catalog(s, d).withColumn("radius", (F.col("cat_id") % 7) / 1000).drop("w1")
    return sky.watchlist_match(T.objects(s, d), targets).select(F.col("cat_id").alias("target"), "oid", "sep")


@register("neighbour_distance", f"SELECT o.oid, {SEP} sep, nullif(w1, -9999) w1 FROM obj o JOIN cat c ON o.oid = c.cat_id", "sep w1", 4)
def neighbour_distance(s, d):
    j = T.objects(s, d).join(T.catalog(s, d).withColumnsRenamed({"cat_id": "oid", "ra": "ra2", "dec": "dec2"}), "oid")
    return j.select("oid", C.separation(F.col("ra"), F.col("dec"), F.col("ra2"), F.col("dec2")).alias("sep"), C.missing(F.col("w1")).alias("w1"))


POWERS = [26**k for k in range(13, -1, -1)]


def aid_sql(rows: str) -> str:
    """Number and code of the positions of a table (oid, ra, dec)."""
    return f"""WITH d AS (SELECT oid, ra / 15 AS h, abs(dec) AS d, dec FROM {rows} ),
 m AS (SELECT *, (h - floor(h)) * 60 AS mh, (d - floor(d)) * 60 AS md FROM d),
 s AS (SELECT *, (mh - floor(mh)) * 60 AS sh, (md - floor(md)) * 60 AS sd FROM m),
 n AS (SELECT oid, 1000000000000000000 + floor(h)::bigint * 10000000000000000 + floor(mh)::bigint * 100000000000000 + floor(sh)::bigint * 1000000000000
 + floor((sh - floor(sh)) * 100)::bigint * 10000000000 + CASE WHEN dec >= 0 THEN 1000000000 ELSE 0 END + floor(d)::bigint * 10000000
 + floor(md)::bigint * 100000 + floor(sd)::bigint * 1000 + floor((sd - floor(sd)) * 10)::bigint * 100 AS number FROM s)
 SELECT oid, number, array_to_string([chr((97 + number // p % 26)::int) for p in {POWERS!r}::bigint[] if number >= p], '') AS code FROM n"""


@register(
    "assign_aid",
    f"""SELECT * FROM (WITH firsts AS (SELECT oid, arg_min(ra, (mjd, candid)) AS ra, arg_min(dec, (mjd, candid)) AS dec, min(mjd) AS mjd FROM det GROUP BY oid),
 known AS (SELECT oid, min(ra) AS ra, min(dec) AS dec, 'AL' || oid AS aid FROM det WHERE mjd < 60320 GROUP BY oid), lost AS (SELECT * FROM firsts ANTI JOIN known USING (oid)),
 near AS (SELECT o.oid, arg_min(c.aid, ({SEP}, c.aid)) AS near_aid FROM lost o, known c WHERE {SEP} <= 1.5 GROUP BY o.oid), codes AS ({aid_sql('firsts')})
 SELECT oid, coalesce(k.aid, near_aid, 'AL' || lpad(CAST(floor((f.mjd - 51544) / 365.25::double)::int % 100 AS VARCHAR), 2, '0') || code) AS aid,
 CASE WHEN k.aid IS NOT NULL THEN 'known' WHEN near_aid IS NOT NULL THEN 'near' ELSE 'new' END AS how
 FROM firsts f LEFT JOIN known k USING (oid) LEFT JOIN near USING (oid) JOIN codes USING (oid))""",
)
def assign_aid(s, d):
    # known are the objects of the first ten days, and each alert is looked up by object, then by position
    alerts = T.detections(s, d)
    early = alerts.filter("mjd < 60320")
    known = early.groupBy("oid").agg(F.min("ra").alias("ra"), F.min("dec").alias("dec")).withColumn("aid", F.concat(F.lit("AL"), "oid"))
    return sky.assign_aid(alerts, known)


@register(
    "master_ids",
    """SELECT p_partkey, 36028797018963968 + (p_partkey % 100) * 8031810176 + (p_partkey % 26) * 308915776 + (p_partkey % 17) AS master, 'ZTF' AS survey, 'ZTF' ||
 lpad(CAST(p_partkey % 100 AS VARCHAR), 2, '0') || chr(CAST(97 + p_partkey % 26 AS INTEGER)) || 'aaaaa' || chr(CAST(97 + p_partkey % 17 AS INTEGER)) AS oid FROM part""",
)
def master_ids(s, d):
    k = F.col("p_partkey")
    letter = lambda m: F.char((97 + k % m).cast("int"))
    oid = F.concat(F.lit("ZTF"), F.lpad((k % 100).cast("string"), 2, "0"), letter(26), F.lit("aaaaa"), letter(17))
    m = T.table(s, d, "part").select("p_partkey", C.masterid_encode(oid).alias("master"))
    survey, back = C.masterid_decode(F.col("master"))
    return m.select("p_partkey", "master", survey.alias("survey"), back.alias("oid"))


@register(
    "position_ids",
    f"SELECT *, number AS back FROM ({aid_sql('obj')})",
)
def position_ids(s, d):
    o = T.objects(s, d).withColumn("number", C.aid_number(F.col("ra"), F.col("dec")))
    return o.select("oid", "number", C.aid_encode(F.col("number")).alias("code"), C.aid_decode(C.aid_encode(F.col("number"))).alias("back"))


@register("jd_dates", "SELECT event_id, CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month, CAST(day(ts) AS INTEGER) AS day FROM events")
def jd_dates(s, d):
    e = T.detections(s, d).select(F.col("candid").alias("event_id"), (F.col("mjd") + 2400000.5).alias("jd"))
    y, m, day = C.jd_to_date(F.col("jd"))
    return e.select("event_id", y.alias("year"), m.alias("month"), F.floor(day).cast("int").alias("day"))


@register(
    "flux_conversions",
    """SELECT candid, pow(10, -(mag - 23.9) / 2.5) * isdiffpos AS flux, e_mag * pow(10, -(mag - 23.9) / 2.5) * ln(10) / 2.5 AS e_flux, reverse(CAST(candid AS VARCHAR)) ||
 '.avro' AS key FROM det""",
    "flux e_flux",
    4,
)
def flux_conversions(s, d):
    f, e = C.mag_to_flux(F.col("mag"), F.col("e_mag"), F.col("isdiffpos"))
    return T.detections(s, d).select("candid", f.alias("flux"), e.alias("e_flux"), C.object_key(F.col("candid")).alias("key"))


@register(
    "rank_probabilities",
    """SELECT oid, class_name, probability, row_number() OVER (PARTITION BY oid ORDER BY probability DESC, class_name) ranking FROM prob""",
    "probability",
    longs="ranking",
)
def rank_probabilities(s, d):
    return classify.rank_probabilities(T.probabilities(s, d)).select("oid", "class_name", "probability", "ranking")


@register("dense_rank_probabilities", "SELECT oid, class_name, dense_rank() OVER (PARTITION BY oid ORDER BY probability DESC) ranking FROM prob", longs="ranking")
def dense_rank_probabilities(s, d):
    return classify.rank_probabilities(T.probabilities(s, d), "dense").select("oid", "class_name", "ranking")


@register(
    "class_distribution",
    """SELECT class_name, count(*) n FROM (SELECT oid, (min((-probability, class_name)))[2] AS class_name FROM prob GROUP BY oid) GROUP BY class_name""",
)
def class_distribution(s, d):
    return classify.class_distribution(T.probabilities(s, d))


@register("score_rows", "SELECT oid, 'share' AS detector_name, '1' AS detector_version, class_name AS category, probability AS score FROM prob", "score")
def score_rows(s, d):
    return classify.flatten_scores(classify.score_rows(T.probabilities(s, d), "share", "1"))


@register(
    "melt_probabilities",
    """SELECT oid, class_name, CASE class_name WHEN 'a' THEN quantity WHEN 'b' THEN discount END AS probability FROM (SELECT l_orderkey * 10 + l_linenumber AS oid, l_quantity /
 50 AS quantity, l_discount AS discount FROM lineitem), (VALUES ('a'), ('b')) v(class_name)""",
    "probability",
)
def melt_probabilities(s, d):
    wide = T.table(s, d, "lineitem").select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("oid"), (F.col("l_quantity") / 50).alias("a"), F.col("l_discount").alias("b"))
    return classify.melt_probabilities(wide, "oid", ["a", "b"])


@register("insert_if_absent", "SELECT oid, class_name FROM prob WHERE oid NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')")
def insert_if_absent(s, d):
    stored = T.table(s, d, "orders").filter("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("oid"), F.lit("share").alias("classifier_name"))
    return classify.insert_if_absent(stored, T.probabilities(s, d)).select("oid", "class_name")


@register(
    "replace_probabilities",
    """SELECT oid, class_name, round(probability, 6) + 0.0::double AS probability, ranking FROM
 (SELECT *, row_number() OVER (PARTITION BY oid ORDER BY probability DESC, class_name) ranking FROM prob )
 UNION ALL SELECT o_orderkey, 'old', 1.0::double, 1 FROM orders WHERE o_orderdate >= '1998-01-01' OR o_orderkey NOT IN (SELECT oid FROM prob )""",
    longs="ranking",
)
def replace_probabilities(s, d):
    version = F.when(F.col("o_orderdate") < "1998-01-01", "1.0").otherwise("0.9")
    fixed = {"classifier_name": F.lit("share"), "classifier_version": version, "class_name": F.lit("old"), "probability": F.lit(1.0), "ranking": F.lit(1)}
    stored = T.table(s, d, "orders").select(F.col("o_orderkey").alias("oid"), *(v.alias(k) for k, v in fixed.items()))
    out = classify.replace_probabilities(stored, T.probabilities(s, d))
    return out.select("oid", "class_name", (F.round("probability", 6) + F.lit(0.0)).alias("probability"), "ranking")


@register(
    "wide_features",
    """SELECT oid, arg_max(mag, candid) FILTER (fid = 'click') AS click, arg_max(mag, candid) FILTER (fid = 'view') AS view FROM det GROUP BY oid""",
    "click view",
)
def wide_features(s, d):
    return classify.wide_features(T.detections(s, d).select("oid", "candid", F.col("fid").alias("name"), F.col("mag").alias("value")), ["click", "view"])


# stored are the orders up to 1997; the batch has sums of all lines, so later orders are new to the store
NEW = "SELECT l_orderkey AS k, sum(l_extendedprice) AS v FROM lineitem GROUP BY l_orderkey"
STORED = "SELECT o_orderkey AS k, o_totalprice AS v FROM orders WHERE o_orderdate < '1998-01-01'"


def _updates(s, d):
    return T.table(s, d, "lineitem").groupBy(F.col("l_orderkey").alias("k")).agg(F.sum("l_extendedprice").alias("v"))


def _target(s, d):
    return T.table(s, d, "orders").filter(F.col("o_orderdate") < "1998-01-01").select(F.col("o_orderkey").alias("k"), F.col("o_totalprice").alias("v"))


@register("upsert", f"SELECT coalesce(n.k, o.k) AS k, coalesce(n.v, o.v) AS v FROM ({STORED}) o FULL JOIN ({NEW}) n ON o.k = n.k", "v", 2)
def upsert(s, d):
    return merge.upsert(_target(s, d), _updates(s, d), ["k"])


@register("insert_ignore", f"SELECT coalesce(o.k, n.k) AS k, coalesce(o.v, n.v) AS v FROM ({STORED}) o FULL JOIN ({NEW}) n ON o.k = n.k", "v", 2)
def insert_ignore(s, d):
    return merge.insert_ignore(_target(s, d), _updates(s, d), ["k"])


@register("update_columns", f"SELECT o.k, coalesce(n.v, o.v) AS v FROM ({STORED}) o LEFT JOIN ({NEW}) n ON o.k = n.k", "v", 2)
def update_columns(s, d):
    return merge.update_columns(_target(s, d), _updates(s, d), ["k"], ["v"])


@register("last_write_wins", "SELECT l_partkey, arg_max(l_quantity, l_orderkey * 100 + l_linenumber) AS l_quantity FROM lineitem GROUP BY l_partkey", "l_quantity")
def last_write_wins(s, d):
    li = T.table(s, d, "lineitem").withColumn("at", F.col("l_orderkey") * 100 + F.col("l_linenumber"))
    return merge.last_write_wins(li, ["l_partkey"], "at").select("l_partkey", "l_quantity")


@register("command_roundtrip", "SELECT CASE WHEN candid % 2 = 0 THEN 'upsert_detections' END AS kind, candid % 2 = 0 AS valid, count(*) AS n FROM det GROUP BY ALL")
def command_roundtrip(s, d):
    det = T.detections(s, d)
    good = merge.command_rows(det.filter("candid % 2 = 0"), "detection", "update", ["candid", "oid"], ["mag"], upsert=True)
    bad = merge.command_rows(det.filter("candid % 2 <> 0"), "detection", "unknown", ["candid", "oid"], ["mag"])
    return merge.parse_commands(good.unionByName(bad)).groupBy("kind", "valid").agg(F.count("*").alias("n"))


def _predicted(s, d):
    docs, labels = T.table(s, d, "documents"), T.table(s, d, "labels")
    return labels.join(docs.select("doc_id", "n_chars"), "doc_id").select(F.col("quality").alias("truth"), (F.col("n_chars") > 600).cast("int").alias("guess"))


PRED = "SELECT quality AS truth, CAST(n_chars > 600 AS INTEGER) AS guess FROM labels JOIN documents USING (doc_id)"


@register("classification_report", f"""SELECT class_name, coalesce(tp / nullif(said, 0), 0) AS precision, coalesce(tp / nullif(support, 0), 0) AS recall, coalesce(2 * (tp / said) * (tp / support) / nullif(tp / said + tp / support, 0), 0) AS f1, support
 FROM (SELECT c AS class_name, count(*) FILTER (truth = c) AS support, count(*) FILTER (guess = c) AS said, count(*) FILTER (truth = c AND guess = c) AS tp FROM ({PRED}), (VALUES (0), (1)) v(c) GROUP BY c)""", "precision recall f1")
def classification_report(s, d):
    return training.classification_report(_predicted(s, d), "truth", "guess")


@register(
    "confusion_matrix",
    f"""SELECT truth, guess, count(*) AS n, count(*) / sum(count(*)) OVER (PARTITION BY truth) AS share FROM ({PRED}) GROUP BY truth, guess""",
    "share",
)
def confusion_matrix(s, d):
    return training.confusion_matrix(_predicted(s, d), "truth", "guess")


@register(
    "precision_recall_curve",
    """SELECT score, sum(h) OVER w / sum(n) OVER w AS precision, sum(h) OVER w / sum(h) OVER () AS recall FROM (SELECT n_chars // 50 AS score, count(*) n, sum(quality) h FROM
 labels JOIN documents USING (doc_id) GROUP BY ALL) WINDOW w AS (ORDER BY score DESC ROWS UNBOUNDED PRECEDING)""",
    "precision recall",
)
def precision_recall_curve(s, d):
    j = T.table(s, d, "labels").join(T.table(s, d, "documents").select("doc_id", F.expr("n_chars div 50").alias("score")), "doc_id")
    return training.precision_recall_curve(j, "score", "quality")


SPLIT = "(row_number() OVER (PARTITION BY label ORDER BY md5(CAST(oid AS VARCHAR) || ':0'), oid) - 0.5) / count(*) OVER (PARTITION BY label)"


@register(
    "stratified_split",
    f"""SELECT oid, label, CASE WHEN p < 0.2 THEN 'test' WHEN p < 0.2 + 0.8 * 0.25 THEN 'validation' ELSE 'train' END AS partition FROM (SELECT *, {SPLIT} AS p FROM (SELECT
 doc_id AS oid, quality AS label FROM labels))""",
)
def stratified_split(s, d):
    return training.stratified_split(T.table(s, d, "labels").select(F.col("doc_id").alias("oid"), F.col("quality").alias("label")))


@register(
    "stratified_kfold",
    """SELECT oid, label, ntile(5) OVER (PARTITION BY label ORDER BY md5(CAST(oid AS VARCHAR) || ':0'), oid) - 1 AS fold FROM (SELECT doc_id AS oid, quality AS label FROM
 labels)""",
    longs="fold",
)
def stratified_kfold(s, d):
    return training.stratified_kfold(T.table(s, d, "labels").select(F.col("doc_id").alias("oid"), F.col("quality").alias("label")))


@register("count_windows", "SELECT oid || '_' || (row_number() OVER (PARTITION BY oid ORDER BY mjd, candid) - 1) // 20 AS window_id, candid FROM det")
def count_windows(s, d):
    return training.count_windows(T.detections(s, d), 20).select("window_id", "candid")


@register("feature_quantiles", "SELECT i AS name, k AS step, quantile_cont(v, 0.0) * 0 + CASE k " + " ".join(f"WHEN {k} THEN quantile_cont(v, {k / 10})" for k in range(11)) + " END AS quantile FROM (SELECT unnest(range(1, len(embedding) + 1)) AS i, unnest(embedding)::double AS v FROM embeddings), range(11) t(k) GROUP BY i, k", "quantile", longs="step")
def feature_quantiles(s, d):
    long = T.table(s, d, "embeddings").select(F.posexplode("embedding").alias("i", "v")).select((F.col("i") + 1).cast("long").alias("name"), F.col("v").cast("double").alias("v"))
    return training.feature_quantiles(long, "name", "v")


@register(
    "profile_features",
    """SELECT fid, count(*) AS n, avg(CASE WHEN mag IS NULL THEN 1.0::double ELSE 0 END) AS null_share, avg(mag) AS mean, stddev_samp(mag) AS std, min(mag) AS low,
 quantile_cont(mag, 0.25) AS q25, quantile_cont(mag, 0.5) AS q50, quantile_cont(mag, 0.75) AS q75, max(mag) AS high FROM det GROUP BY fid""",
    "null_share mean std low q25 q50 q75 high",
)
def profile_features(s, d):
    return training.profile_features(T.detections(s, d), "mag", "fid")


@register(
    "multi_horizon",
    """SELECT oid, h AS horizon, count(*) AS n, avg(mag) AS mean FROM (SELECT *, min(CASE WHEN NOT forced THEN mjd END) OVER (PARTITION BY oid) AS f FROM det ) , (VALUES
 (4.0::double), (16.0::double), (NULL)) v(h) WHERE h IS NULL OR mjd <= f + h GROUP BY oid, h""",
    "mean",
)
def multi_horizon(s, d):
    return training.multi_horizon(T.detections(s, d), [4, 16]).groupBy("oid", "horizon").agg(F.count("*").alias("n"), F.avg("mag").alias("mean"))


@register(
    "sequence_sample",
    """SELECT oid, fid, row_number() OVER (PARTITION BY oid, fid ORDER BY mjd, mag) - 1 AS at, mjd AS time, mag AS value FROM
 (SELECT *, row_number() OVER (PARTITION BY oid, fid ORDER BY mjd, candid) - 1 AS i, count(*) OVER (PARTITION BY oid, fid) AS m FROM det )
 WHERE m <= 8 OR list_contains([j * (m - 1) // 7 for j in range(8)], i)""",
    "time value",
    longs="at",
)
def sequence_sample(s, d):
    seq = training.sequence_sample(T.detections(s, d), 8)
    rows = seq.select("oid", "fid", F.posexplode(F.arrays_zip("time", "value", "mask")).alias("at", "x")).filter("x.mask = 1")
    return rows.select("oid", "fid", "at", "x.time", "x.value")


BASIC = "Amplitude Rcs StetsonK Meanvariance Con SmallKurtosis Std Mean Skew MaxSlope MedianAbsDev MedianBRP PairSlopeTrend FluxPercentileRatioMid20 FluxPercentileRatioMid50 FluxPercentileRatioMid80 PercentDifferenceFluxPercentile PercentAmplitude LinearTrend Eta_e Q31 Gskew ExcessVar Beyond1Std"
_SORTED = "max(mag) FILTER (rank = {f}(round({p} * n, 9)) + 1)"


def _at(p, f="ceil"):
    return _SORTED.format(p=p, f=f)


@register("basic_features", f"""SELECT oid, fid, (quantile_cont(mag, 0.5) FILTER (rank > n - ceil(round(0.05 * n, 9))) - quantile_cont(mag, 0.5) FILTER (rank <= ceil(round(0.05 * n, 9)))) / 2 AS Amplitude,
 max(s) - min(s) AS Rcs, sum(abs(sig)) / sqrt(sum(sig * sig)) / sqrt(count(*)) AS StetsonK, any_value(sd) / any_value(mean) AS Meanvariance,
 count(*) FILTER (abs(mag - mean) > 2 * sd AND abs(m1 - mean) > 2 * sd AND abs(m2 - mean) > 2 * sd) / (count(*) - 2) AS Con,
 sum(pow((mag - mean) / sd, 4)) * any_value(n) * (any_value(n) + 1) / ((any_value(n) - 1) * (any_value(n) - 2) * (any_value(n) - 3)) - 3 * pow(any_value(n) - 1, 2) / ((any_value(n) - 2) * (any_value(n) - 3)) AS SmallKurtosis,
 any_value(sd) AS Std, any_value(mean) AS Mean, sum(pow((mag - mean) / sd, 3)) / count(*) AS Skew, max(abs(mag - pm) / (mjd - pt)) AS MaxSlope, quantile_cont(abs(mag - med), 0.5) AS MedianAbsDev,
 count(*) FILTER (mag > med - (hi - lo) / 10 AND mag < med + (hi - lo) / 10) / count(*) AS MedianBRP, (count(*) FILTER (tim > n - 29 AND mag > pm) - count(*) FILTER (tim > n - 29 AND mag <= pm)) / 30 AS PairSlopeTrend,
 ({_at(0.6)} - {_at(0.4)}) / ({_at(0.95)} - {_at(0.05)}) AS FluxPercentileRatioMid20, ({_at(0.75)} - {_at(0.25)}) / ({_at(0.95)} - {_at(0.05)}) AS FluxPercentileRatioMid50,
 ({_at(0.9)} - {_at(0.1)}) / ({_at(0.95, "floor")} - {_at(0.05)}) AS FluxPercentileRatioMid80, ({_at(0.95)} - {_at(0.05)}) / any_value(med) AS PercentDifferenceFluxPercentile,
 max(abs(mag - med)) / any_value(med) AS PercentAmplitude, regr_slope(mag, mjd) AS LinearTrend, sum(pow((mag - pm) / (mjd - pt), 2)) / sum(1 / pow(mjd - pt, 2)) / pow(any_value(sd), 2) AS Eta_e,
 quantile_cont(mag, 0.75) - quantile_cont(mag, 0.25) AS Q31, quantile_cont(mag, 0.5) FILTER (mag <= p3) + quantile_cont(mag, 0.5) FILTER (mag >= p97) - 2 * any_value(med) AS Gskew,
 sum(pow(mag - mean, 2) - e_mag * e_mag) / (count(*) * pow(any_value(mean), 2)) AS ExcessVar, count(*) FILTER (abs(mag - wmean) > sd1) / count(*) AS Beyond1Std
 FROM (SELECT *, (run - tim * mean) / (n * sd) AS s, (mag - wmean) / e_mag AS sig, sqrt(sum(pow(mag - wmean, 2)) OVER (PARTITION BY oid, fid) / (n - 1)) AS sd1 FROM
 (SELECT *, count(*) OVER g AS n, avg(mag) OVER g AS mean, stddev_pop(mag) OVER g AS sd, quantile_cont(mag, 0.5) OVER g AS med, min(mag) OVER g AS lo, max(mag) OVER g AS hi, quantile_cont(mag, 0.03) OVER g AS p3, quantile_cont(mag, 0.97) OVER g AS p97,
 sum(mag / pow(e_mag, 2)) OVER g / sum(1 / pow(e_mag, 2)) OVER g AS wmean, row_number() OVER (PARTITION BY oid, fid ORDER BY mag, candid) AS rank, row_number() OVER o AS tim, lag(mag) OVER o AS pm, lag(mjd) OVER o AS pt, lead(mag) OVER o AS m1, lead(mag, 2) OVER o AS m2,
 sum(mag) OVER (PARTITION BY oid, fid ORDER BY mjd, candid ROWS UNBOUNDED PRECEDING) AS run FROM det WHERE NOT forced WINDOW g AS (PARTITION BY oid, fid), o AS (PARTITION BY oid, fid ORDER BY mjd, candid)) WHERE n >= 6) GROUP BY oid, fid""", BASIC, 4)
def basic_features(s, d):
    return features.basic_features(T.detections(s, d), BASIC.split())


@register(
    "anderson_darling",
    f"""WITH q AS (SELECT *, row_number() OVER (PARTITION BY oid, fid ORDER BY mag, candid) AS rank, count(*) OVER g AS n, (mag - avg(mag) OVER g) / stddev_pop(mag) OVER g AS c0
 FROM det WHERE NOT forced WINDOW g AS (PARTITION BY oid, fid)),
 c AS (SELECT *, c0 / sqrt(n / (n - 1)) AS c FROM q WHERE n >= 6),
 t AS (SELECT *, abs(c) / sqrt(2) AS x, 1 / (1 + 0.3275911::double * abs(c) / sqrt(2)) AS t FROM c),
 z AS (SELECT *, t * (0.254829592::double + t * (-0.284496736::double + t * (1.421413741::double + t * (-1.453152027::double + t * 1.061405429::double)))) * exp(-x * x) AS tail FROM t),
 p AS (SELECT *, CASE WHEN c >= 0 THEN 1 - tail / 2 ELSE tail / 2 END AS z FROM z)
 SELECT oid, fid, 1 / (1 + exp(-10 * (-any_value(n) - sum(((2 * rank - 1) * ln(z) + (2 * (n - rank) + 1) * ln(1 - z)) / n) - 0.3))) AS AndersonDarling,
 ({_at(0.675)} - {_at(0.325)}) / ({_at(0.95)} - {_at(0.05)}) AS FluxPercentileRatioMid35, ({_at(0.825)} - {_at(0.175)}) / ({_at(0.95)} - {_at(0.05)}) AS FluxPercentileRatioMid65 FROM p GROUP BY oid, fid""",
    "AndersonDarling FluxPercentileRatioMid35 FluxPercentileRatioMid65",
    4,
)
def anderson_darling(s, d):
    return features.basic_features(T.detections(s, d), ["AndersonDarling", "FluxPercentileRatioMid35", "FluxPercentileRatioMid65"])


@register(
    "colors",
    """SELECT oid, avg(mag) FILTER (fid = 'click') - avg(mag) FILTER (fid = 'view') AS color_mean, min(mag) FILTER (fid = 'click') - min(mag) FILTER (fid = 'view') AS color_max,
 quantile_cont(fl, 0.9) FILTER (fid = 'click') / (quantile_cont(fl, 0.9) FILTER (fid = 'view') + 1) AS color_flux_p90 FROM (SELECT *, pow(10, -(mag - 23.9) / 2.5) AS fl
 FROM det WHERE NOT forced) GROUP BY oid""",
    "color_mean color_max color_flux_p90",
    5,
)
def colors(s, d):
    return features.colors(T.detections(s, d), "click", "view")


@register(
    "color_variation",
    """SELECT oid, stddev_samp(c) AS color_variation, count(*) AS n_windows FROM (SELECT oid, b,
 avg(mag) FILTER (fid = 'click') - avg(mag) FILTER (fid = 'view') AS c, count(*) FILTER (fid = 'click') AS na, count(*) FILTER (fid = 'view') AS nb
 FROM (SELECT *, floor((mjd - min(mjd) OVER (PARTITION BY oid)) / 10) AS b FROM det WHERE NOT forced) GROUP BY oid, b)
 WHERE na >= 3 AND nb >= 3 GROUP BY oid""",
    "color_variation",
)
def color_variation(s, d):
    return features.color_variation(T.detections(s, d), "click", "view")


@register(
    "sn_features",
    """SELECT * EXCLUDE (first), first - last_before AS dbrightness_first_det, first - median_before AS dbrightness_forced_phot FROM (
 SELECT oid, fid, count(*) FILTER (NOT forced AND isdiffpos > 0) / nullif(count(*) FILTER (NOT forced), 0) AS positive_fraction,
 count(*) FILTER (b) AS n_before, max(mag) FILTER (b) AS max_before, quantile_cont(mag, 0.5) FILTER (b) AS median_before,
 arg_max(mag, (mjd, candid)) FILTER (b) AS last_before, arg_min(mag, (mjd, candid)) FILTER (NOT forced) AS first,
 count(*) FILTER (a) AS n_after, max(mag) FILTER (a) AS max_after, quantile_cont(mag, 0.5) FILTER (a) AS median_after
 FROM (SELECT *, forced AND mjd < f AS b, forced AND mjd > f AS a FROM
 (SELECT *, min(CASE WHEN NOT forced THEN mjd END) OVER (PARTITION BY oid) AS f FROM det )) GROUP BY oid, fid)""",
    "positive_fraction max_before median_before last_before max_after median_after dbrightness_first_det dbrightness_forced_phot",
)
def sn_features(s, d):
    return features.sn_features(T.detections(s, d))


@register(
    "coordinates_xyz",
    """SELECT oid, cos(radians(avg(ra))) * cos(radians(avg(dec))) AS x, sin(radians(avg(ra))) * cos(radians(avg(dec))) AS y, sin(radians(avg(dec))) AS z, max(mjd) - min(mjd) AS
 timespan FROM det GROUP BY oid""",
    "x y z timespan",
)
def coordinates_xyz(s, d):
    return features.coordinates_xyz(T.detections(s, d))


@register("tde_tail", """SELECT oid, fid, slope, off AS intercept, (syy - off * sy - slope * sxy) / (n - 2) AS chi FROM (SELECT *, (sy - slope * sx) / sw AS off FROM (SELECT *, (sw * sxy - sx * sy) / (sw * sxx - sx * sx) AS slope FROM (
 SELECT oid, fid, sum(w) sw, sum(w * x) sx, sum(w * mag) sy, sum(w * x * x) sxx, sum(w * x * mag) sxy, sum(w * mag * mag) syy, count(*) n FROM (SELECT *, 2.5 * log10(mjd - p + 40) AS x, 1 / pow(e_mag, 2) AS w FROM
 (SELECT *, (min((mag, mjd)) OVER (PARTITION BY oid, fid))[2] AS p FROM det WHERE NOT forced) WHERE mjd - p BETWEEN 0 AND 200) GROUP BY oid, fid) WHERE n >= 5))""", "slope intercept chi", 2)
def tde_tail(s, d):
    return features.tde_tail(T.detections(s, d))


@register(
    "structure_function",
    """WITH p AS (SELECT a.oid, a.fid, b.mjd - a.mjd AS dt, pow(b.mag - a.mag, 2) - pow(a.e_mag, 2) - pow(b.e_mag, 2) AS d
 FROM det a JOIN det b ON a.oid = b.oid AND a.fid = b.fid AND (a.mjd, a.candid) < (b.mjd, b.candid) AND NOT a.forced AND NOT b.forced
 WHERE b.mjd - a.mjd BETWEEN 5 AND 365),
b AS (SELECT oid, fid, floor((log10(dt) - log10(5)) / 0.1::double + 1e-12)::int AS k, avg(d) AS s FROM p GROUP BY ALL HAVING s > 0),
t AS (SELECT *, (pow(10, log10(5) + 0.1::double * k) + pow(10, log10(5) + 0.1::double * (k + 1))) / 730 AS tau FROM b WHERE k < 26),
f AS (SELECT oid, fid, count(*) AS n, count(*) FILTER (tau > 0.01 AND tau <= 0.5) AS m,
 regr_slope(log10(sqrt(s)), log10(tau)) FILTER (tau > 0.01 AND tau <= 0.5) AS g,
 pow(10, regr_intercept(log10(sqrt(s)), log10(tau)) FILTER (tau > 0.01 AND tau <= 0.5)) AS a FROM t GROUP BY oid, fid)
SELECT oid, fid, CASE WHEN n >= 2 AND m >= 2 THEN CASE WHEN a < 0.005 THEN 0 ELSE greatest(least(g, 3), -0.5) END ELSE -0.5 END AS SF_ML_gamma,
 CASE WHEN n >= 2 AND m >= 2 THEN CASE WHEN a < 0.005 THEN 0 ELSE least(a, 15) END ELSE -0.5 END AS SF_ML_amplitude
FROM (SELECT DISTINCT oid, fid FROM det WHERE NOT forced) LEFT JOIN f USING (oid, fid)""",
    "SF_ML_gamma SF_ML_amplitude",
    4,
)
def structure_function(s, d):
    return features.structure_function(T.detections(s, d))


def _periods(s, d):
    return T.detections(s, d).select("oid").distinct().withColumn("period", 1.5 + (F.col("oid").cast("int") % 7) * 0.25)


@register("folded_kim", """SELECT oid, fid, max(s) - min(s) AS Psi_CS, sum(pow(mag - pm, 2)) / (count(*) - 1) / pow(any_value(sd), 2) AS Psi_eta FROM (SELECT *, (run - tim * mean) / (n * sd) AS s FROM (SELECT *, count(*) OVER g AS n, avg(mag) OVER g AS mean, stddev_pop(mag) OVER g AS sd,
 row_number() OVER o AS tim, lag(mag) OVER o AS pm, sum(mag) OVER (PARTITION BY oid, fid ORDER BY phase, candid ROWS UNBOUNDED PRECEDING) AS run FROM (SELECT *, mjd / (2 * per) - floor(mjd / (2 * per)) AS phase FROM (SELECT *, 1.5::double + (CAST(oid AS INTEGER) % 7) * 0.25::double AS per FROM det WHERE NOT forced))
 WINDOW g AS (PARTITION BY oid, fid), o AS (PARTITION BY oid, fid ORDER BY phase, candid)) WHERE n >= 6) GROUP BY oid, fid""", "Psi_CS Psi_eta", 5)
def folded_kim(s, d):
    return features.folded_kim(T.detections(s, d), _periods(s, d))


@register("harmonics")
def harmonics(s, d):
    return features.harmonics(T.detections(s, d), _periods(s, d))


def _grid(s, d):
    return period.frequency_spec(T.detections(s, d), 0.045, 100.0)


LO, STEP = "0.01::double", "(1 / 0.045::double - 0.01::double)"
GRID = f"""(SELECT oid, t0, unnest(range(n)) AS k, n FROM (SELECT oid, min(mjd) AS t0,
 greatest(1000, ceil({STEP} * (max(mjd) - min(mjd)) / 0.2::double)::int) AS n FROM det GROUP BY oid))"""
PHASED = f"""(SELECT *, (mjd - t0) * freq - floor((mjd - t0) * freq) AS phase FROM (SELECT det.*, t0, CAST(k AS INTEGER) AS k,
 {LO} + k * {STEP} / (n - 1) AS freq FROM det JOIN {GRID} USING (oid) WHERE NOT forced))"""
BAND_POWER = f"""(SELECT *, greatest(n - 3, 0) AS d2, syy - sy * sy / sw AS wvar,
 CASE WHEN cc > 9e-10 * sw THEN yc * yc / cc ELSE 0 END + CASE WHEN ss - l * l > 9e-10 * sw THEN pow(ys - l * z, 2) / (ss - l * l) ELSE 0 END AS power FROM (SELECT *, CASE WHEN cc > 9e-10 * sw THEN cs / sqrt(cc) ELSE 0 END AS l, CASE WHEN cc > 9e-10 * sw THEN yc / sqrt(cc) ELSE 0 END AS z FROM (
 SELECT oid, fid, k, freq, count(*) AS n, sum(w) AS sw, sum(w * mag) AS sy, sum(w * mag * mag) AS syy,
 sum(w * c * c) - pow(sum(w * c), 2) / sum(w) AS cc, sum(w * s * s) - pow(sum(w * s), 2) / sum(w) AS ss,
 sum(w * c * s) - sum(w * c) * sum(w * s) / sum(w) AS cs, sum(w * mag * c) - sum(w * mag) * sum(w * c) / sum(w) AS yc,
 sum(w * mag * s) - sum(w * mag) * sum(w * s) / sum(w) AS ys
 FROM (SELECT *, 1 / pow(e_mag, 2) AS w, cos(2 * pi() * phase) AS c, sin(2 * pi() * phase) AS s FROM {PHASED}) GROUP BY oid, fid, k, freq)))"""
POWER = f"""(SELECT oid, k, freq, sum(d2) * sum(power) / (2 * greatest(sum(wvar) - sum(power), 1e-9)) AS power FROM {BAND_POWER} GROUP BY oid, k, freq)"""


def _power(s, d):
    return period.mhaov_multiband(T.detections(s, d), _grid(s, d))


@register("mhaov_periodogram", f"SELECT oid, k, freq, power FROM {POWER}", "freq power", 3)
def mhaov_periodogram(s, d):
    return _power(s, d).select("oid", "k", "freq", "power")


@register(
    "pdm_periodogram",
    f"""SELECT oid, k, freq, pooled / total AS theta FROM (SELECT oid, k, freq, sum(sq - su * su / n) FILTER (n > 2) / sum(n - 1) FILTER (n > 2) AS pooled
 FROM (SELECT oid, k, freq, floor(phase * 8) AS b, count(*) AS n, sum(mag * mag) AS sq, sum(mag) AS su FROM {PHASED} GROUP BY ALL) GROUP BY oid, k, freq)
 JOIN (SELECT oid, var_samp(mag) AS total FROM det WHERE NOT forced GROUP BY oid) USING (oid)""",
    "freq theta",
    3,
)
def pdm_periodogram(s, d):
    return period.pdm(T.detections(s, d), _grid(s, d))


def _aov_sql(weight: str) -> str:
    return f"""SELECT oid, k, freq, (nmm - 2 * total * nm + n * total * total) / (r - 1) / (inside / (n - r)) AS power FROM (
 SELECT oid, k, freq, sum(n) AS n, count(*) AS r, sum(wy) / sum(w) AS total, sum(n * mean * mean) AS nmm, sum(n * mean) AS nm, sum(sq - 2 * mean * su + n * mean * mean) AS inside
 FROM (SELECT *, wy / w AS mean FROM (SELECT oid, k, freq, floor(phase * 8) AS b, count(*) AS n, sum(mag * mag) AS sq, sum(mag) AS su, sum({weight} * mag) AS wy, sum({weight}) AS w
 FROM {PHASED} GROUP BY ALL)) GROUP BY oid, k, freq) WHERE n > r AND r > 1"""


@register("aov_periodogram", _aov_sql("1"), "freq power", 3)
def aov_periodogram(s, d):
    return period.aov(T.detections(s, d), _grid(s, d))


@register("weighted_aov_periodogram", _aov_sql("1 / pow(e_mag, 2)"), "freq power", 3)
def weighted_aov_periodogram(s, d):
    return period.aov(T.detections(s, d), _grid(s, d), weighted=True)


@register(
    "string_length",
    f"""SELECT oid, k, freq, sum(pow(mag - pm, 2) / (pow(e_mag, 2) + pow(pe, 2))) AS length FROM (SELECT *, coalesce(lag(mag) OVER o, last_value(mag) OVER e) AS pm,
 coalesce(lag(e_mag) OVER o, last_value(e_mag) OVER e) AS pe FROM {PHASED} WINDOW o AS (PARTITION BY oid, k ORDER BY phase, candid),
 e AS (PARTITION BY oid, k ORDER BY phase, candid ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) GROUP BY oid, k, freq""",
    "freq length",
    3,
)
def string_length(s, d):
    return period.string_length(T.detections(s, d), _grid(s, d))


@register(
    "period_features",
    f"""SELECT oid, 1 / arg_max(freq, (power, -k)) AS period, max(power) AS peak, 1 + sum(p * ln(p)) / ln(100) AS ppe FROM (SELECT *, (power + 0.01::double) / sum(power + 0.01::double) OVER (PARTITION BY oid) AS p
 FROM (SELECT *, row_number() OVER (PARTITION BY oid ORDER BY power DESC, k) AS r FROM {POWER}) WHERE r <= 100) GROUP BY oid""",
    "period peak ppe",
    4,
)
def period_features(s, d):
    return period.period_features(_power(s, d))


@register(
    "power_rates",
    f"""WITH pw AS MATERIALIZED (SELECT * FROM {POWER}), best AS (SELECT oid, arg_max(freq, (power, -k)) AS bf, max(power) AS peak, min(freq) AS f0, max(freq) AS f1, max(k) AS last FROM pw GROUP BY oid),
 want AS (SELECT *, bf / times AS f FROM best, (VALUES (0.25::double, '1/4'), (1 / 3::double, '1/3'), (0.5::double, '1/2'), (2.0::double, '2'), (3.0::double, '3'), (4.0::double, '4')) v(times, name))
 SELECT want.oid, name, power / peak AS rate FROM want JOIN pw ON pw.oid = want.oid AND pw.k = least(greatest(round((f - f0) / (f1 - f0) * last)::int, 0), last)""",
    "rate",
    3,
)
def power_rates(s, d):
    return period.power_rates(_power(s, d))


@register("refined_periods")
def refined_periods(s, d):
    best = period.object_periods(T.detections(s, d), _grid(s, d))
    bands = F.transform("bands", lambda x: F.abs(F.col("period") - x["Period_band"]))
    return best.select("oid", "period", "peak", "ppe", F.size("bands").cast("long").alias("bands"), F.array_max(bands).alias("delta_period"))


from skyflow.operators import fits, variability  # noqa: E402


@register("fleet_fits")
def fleet_fits(s, d):
    return fits.fit_fleet(T.detections(s, d))


@register("microlensing_fits")
def microlensing_fits(s, d):
    return fits.fit_microlensing(T.detections(s, d))


@register("supernova_fits")
def supernova_fits(s, d):
    return fits.fit_supernova(T.detections(s, d))


@register("random_walk_fits")
def random_walk_fits(s, d):
    return fits.fit_drw(T.detections(s, d))


def _iar_best(rows: str) -> str:
    """Phi of the least cost among the rows' values, each light curve for itself."""
    return f"""SELECT oid, fid, arg_min(phi, (nll, phi)) AS IAR_phi FROM (SELECT oid, fid, phi, round(sum(CASE WHEN pz IS NULL THEN z * z ELSE ln(v) + pow(z - a * pz, 2) / v END) / 2, 9) AS nll FROM (
 SELECT *, pow(phi, dt) AS a, greatest(1 - pow(phi, 2 * dt), 1e-6) AS v FROM ({rows})) GROUP BY oid, fid, phi) GROUP BY oid, fid"""


_STEPS = [(k + 0.5) / 20 for k in range(20)]
IAR = f"""WITH s AS MATERIALIZED (SELECT *, lag(z) OVER o AS pz, mjd - lag(mjd) OVER o AS dt FROM (SELECT *, count(*) OVER g AS n, (mag - avg(mag) OVER g) / stddev_samp(mag) OVER g AS z
 FROM det WHERE NOT forced WINDOW g AS (PARTITION BY oid, fid)) WHERE n >= 6 WINDOW o AS (PARTITION BY oid, fid ORDER BY mjd, candid)),
 c AS MATERIALIZED ({_iar_best(f"SELECT s.*, phi FROM s, (SELECT unnest({_STEPS!r}::double[]) AS phi)")})
 {_iar_best(f"SELECT s.*, IAR_phi + step AS phi FROM s JOIN c USING (oid, fid), (SELECT unnest({[(x - 0.5) / 20 for x in _STEPS]!r}::double[]) AS step)")}"""


@register("autoregression_fits", IAR, "IAR_phi")
def autoregression_fits(s, d):
    return fits.fit_iar_phi(T.detections(s, d))


@register(
    "autocor_length",
    """SELECT * FROM (WITH z AS (SELECT *, row_number() OVER (PARTITION BY oid, fid ORDER BY mjd, candid) AS r, count(*) OVER g AS n, mag - avg(mag) OVER g AS z, var_pop(mag) OVER g AS v
 FROM det WHERE NOT forced WINDOW g AS (PARTITION BY oid, fid)),
 l AS (SELECT a.oid, a.fid, b.r - a.r AS k, sum(a.z * b.z) AS s, any_value(a.n) AS n, any_value(a.v) AS v FROM z a JOIN z b ON a.oid = b.oid AND a.fid = b.fid AND a.r < b.r AND a.n >= 6 GROUP BY ALL)
 SELECT oid, fid, coalesce(min(k) FILTER (s < exp(-1) * n * v), any_value(n)) AS Autocor_length FROM l GROUP BY oid, fid)""",
)
def autocor_length(s, d):
    return variability.autocor_length(T.detections(s, d))


ACF = """(WITH z AS (SELECT *, mag - avg(mag) OVER (PARTITION BY oid, fid) AS z FROM det WHERE NOT forced QUALIFY count(*) OVER (PARTITION BY oid, fid) >= 6)
 SELECT oid, fid, slot, r / first_value(r) OVER (PARTITION BY oid, fid ORDER BY slot) AS r FROM (
 SELECT a.oid, a.fid, CAST(floor(b.mjd - a.mjd + 0.5::double) AS INTEGER) AS slot, avg(a.z * b.z) AS r
 FROM z a JOIN z b ON a.oid = b.oid AND a.fid = b.fid AND (a.mjd, a.candid) <= (b.mjd, b.candid) GROUP BY ALL))"""


@register("slotted_autocorrelation", f"SELECT * FROM {ACF} WHERE slot < 100", "r", 4)
def slotted_autocorrelation(s, d):
    return variability.slotted_autocorrelation(T.detections(s, d))


def _mhps_sql(t1: float, t2: float) -> str:
    """The same filter in SQL; its constants are sums over the support as in the operator."""
    parts = []
    for name, scale in (("low", t1), ("high", t2)):
        c1 = 0.225 * scale / math.sqrt(2)
        c2, reach = 2 * c1, max(6 * c1, 30.0)
        bell = [[math.exp(-((reach * (k / 500 - 1)) ** 2) / (2 * c * c)) for k in range(1001)] for c in (c1, c2)]
        area = [sum(b) * reach / 500 for b in bell]
        norm = sum((x / area[0] - y / area[1]) ** 2 for x, y in zip(*bell)) * reach / 500
        gap = "(a.mjd - b.mjd)"
        w = [f"exp(-pow({gap}, 2) / {2 * c * c!r}::double)" for c in (c1, c2)]
        parts.append(
            f"""{name} AS (SELECT oid, fid, avg(pow(f0 - f1, 2)) / {norm!r}::double / pow(any_value(mean), 2) AS p_{name}, count(*) AS n_{name}, pow(avg(e) / any_value(mean), 2) AS noise_{name} FROM (
 SELECT a.oid, a.fid, a.candid, sum({w[0]} * b.x) / sum({w[0]}) AS f0, sum({w[1]} * b.x) / sum({w[1]}) AS f1, count(*) FILTER (abs{gap} <= {reach!r}::double / 3 * 2) AS near, any_value(a.mean) AS mean, any_value(a.e) AS e
 FROM y a JOIN y b ON a.oid = b.oid AND a.fid = b.fid AND abs{gap} < {reach!r}::double GROUP BY a.oid, a.fid, a.candid) WHERE near > 3 GROUP BY oid, fid)"""
        )
    return f"""WITH y AS (SELECT *, y - mean AS x FROM (SELECT *, avg(y) OVER (PARTITION BY oid, fid) AS mean FROM (SELECT *, pow(10, (19 - mag) * 0.4::double) AS y, ln(10) * 0.4::double * pow(10, (19 - mag) * 0.4::double) * e_mag AS e FROM det WHERE NOT forced))),
 {", ".join(parts)}, q AS (SELECT *, p_low - noise_low AS lo, CASE WHEN p_high > noise_low THEN p_high - noise_low ELSE p_high END AS hi FROM low JOIN high USING (oid, fid))
 SELECT oid, fid, lo / nullif(hi, 0) AS MHPS_ratio, lo AS MHPS_low, hi AS MHPS_high, n_high AS MHPS_non_zero, CASE WHEN p_high > noise_low THEN 0 ELSE 1 END AS MHPS_PN_flag FROM q"""


@register("mhps", _mhps_sql(100.0, 10.0), "MHPS_ratio MHPS_low MHPS_high", 4)
def mhps(s, d):
    return variability.mhps(T.detections(s, d))


@register(
    "sigma_clip",
    """SELECT candid, c OR abs(mag - avg(CASE WHEN NOT c THEN mag END) OVER g) > 1.5 * stddev_pop(CASE WHEN NOT c THEN mag END) OVER g AS clipped FROM (SELECT *, abs(mag -
 avg(mag) OVER g) > 1.5 * stddev_pop(mag) OVER g AS c FROM det WINDOW g AS (PARTITION BY oid, fid)) WINDOW g AS (PARTITION BY oid, fid)""",
)
def sigma_clip(s, d):
    return variability.sigma_clip(T.detections(s, d), 1.5).select("candid", "clipped")


@register(
    "robust_scale",
    """WITH q AS (SELECT *, lag(q) OVER o AS q0, lag(mag) OVER o AS m0 FROM (SELECT *, (sum(w) OVER (PARTITION BY oid, fid ORDER BY mag, candid ROWS UNBOUNDED PRECEDING) - w / 2) / sum(w) OVER g AS q,
 sum(w * mag) OVER g / sum(w) OVER g AS mean FROM (SELECT *, 1 / pow(e_mag, 2) AS w FROM det WHERE NOT forced) WINDOW g AS (PARTITION BY oid, fid)) WINDOW o AS (PARTITION BY oid, fid ORDER BY mag, candid)),
 a AS (SELECT oid, fid, p, coalesce(min((m0 * (q - p) + mag * (p - q0)) / (q - q0)) FILTER (q >= p AND q0 < p), min(mag) FILTER (q >= p AND q0 IS NULL), max(mag) FILTER (q < p)) AS v
 FROM q, (VALUES (0.25::double), (0.5::double), (0.75::double)) t(p) GROUP BY oid, fid, p),
 s AS (SELECT oid, fid, sqrt(sum(w * pow(mag - mean, 2)) / sum(w)) AS sd FROM q GROUP BY oid, fid)
 SELECT oid, fid, max(v) FILTER (p = 0.5) AS location, least(any_value(sd), (max(v) FILTER (p = 0.75) - max(v) FILTER (p = 0.25)) / 1.349) AS scale FROM a JOIN s USING (oid, fid) GROUP BY oid, fid""",
    "location scale",
)
def robust_scale(s, d):
    return variability.robust_scale(T.detections(s, d))


@register("pvar")
def pvar(s, d):
    return variability.pvar(T.detections(s, d))


@register("helio_times")
def helio_times(s, d):
    return variability.helio_correct(T.detections(s, d)).select("oid", "candid", "mjd", "mjd_original")


from skyflow.operators import outputs  # noqa: E402


@register("latest_stamp_detection", "SELECT oid, arg_min(candid, (NOT new, -mjd, candid)) AS candid FROM det WHERE candid % 5 <> 1 GROUP BY oid")
def latest_stamp_detection(s, d):
    return outputs.latest_stamp_detection(T.detections(s, d).withColumn("has_stamp", F.col("candid") % 5 != 1)).select("oid", "candid")


@register("patch_features", "SELECT oid, candid, fid AS name, CASE WHEN fid IN ('click', 'view') THEN mag + 1 ELSE mag END AS value FROM det ", "value", 4)
def patch_features(s, d):
    old = T.detections(s, d).select("oid", "candid", F.col("fid").alias("name"), F.col("mag").alias("value"))
    return outputs.patch_features(old, old.withColumn("value", F.col("value") + 1), ["click", "view"])


@register(
    "align_partitions",
    """SELECT doc_id AS oid, quality AS partition, row_number() OVER (PARTITION BY quality ORDER BY doc_id) - 1 AS row_id FROM labels WHERE doc_id IN (SELECT doc_id FROM
 documents WHERE n_chars > 500)""",
    longs="row_id",
)
def align_partitions(s, d):
    parts = T.table(s, d, "labels").select(F.col("doc_id").alias("oid"), F.col("quality").alias("partition"))
    return outputs.align_partitions(parts, T.table(s, d, "documents").filter("n_chars > 500").select(F.col("doc_id").alias("oid")))


@register("split_table_history", "SELECT p_partkey AS oid, p_size AS measurement_id, p_retailprice AS mag, p_brand AS e_mag FROM part")
def split_table_history(s, d):
    p = T.table(s, d, "part").select(F.col("p_partkey").alias("oid"), F.col("p_size").alias("measurement_id"), F.col("p_retailprice").alias("mag"), F.col("p_brand").alias("e_mag"))
    return outputs.split_table_history(p.drop("e_mag"), p.drop("mag"))


@register("merge_json_values", """SELECT event_id, '{"k":' || json_extract_string(props, '$.k') || ',"kind":"' || event_type || '","value":' || (event_id % 7) || '}' AS v FROM events""")
def merge_json_values(s, d):
    new = F.to_json(F.struct(F.col("event_type").alias("kind"), (F.col("event_id") % 7).alias("value")))
    e = T.table(s, d, "events").withColumn("new", new)
    return e.select("event_id", outputs.merge_json("props", "new").alias("v"))


@register(
    "attach_output",
    """SELECT o_orderkey AS oid, arg_max(class_name, (probability, class_name)) AS class, count(*) AS n FROM orders JOIN prob ON o_orderkey = oid GROUP BY o_orderkey""",
)
def attach_output(s, d):
    f = T.table(s, d, "orders").select(F.col("o_orderkey").alias("oid"))
    return outputs.attach_output(f, T.probabilities(s, d)).select("oid", "class", F.size("probabilities").cast("long").alias("n"))


@register(
    "debias_positions",
    """SELECT oid FROM (SELECT *, row_number() OVER (PARTITION BY k, dec < 0 ORDER BY md5(CAST(oid AS VARCHAR))) AS n FROM (SELECT *, oid % 3 AS k FROM obj )) WHERE NOT (k = 1
 AND dec < 0) OR n <= 20""",
)
def debias_positions(s, d):
    return outputs.debias_positions(T.objects(s, d).withColumn("k", (F.col("oid") % 3).cast("string")), "k", "1", 20).select("oid")


@register(
    "pull_training_set",
    """SELECT oid, candid FROM det WHERE CAST(oid AS BIGINT) IN (SELECT c_custkey FROM customer) AND oid IN (SELECT oid FROM det WHERE fid = 'purchase')""",
)
def pull_training_set(s, d):
    det = T.detections(s, d)
    objs = T.table(s, d, "customer").select(F.col("c_custkey").cast("string").alias("oid"))
    processed = det.filter("fid = 'purchase'")
    return outputs.pull_training_set(objs, processed, det, objs.withColumn("w1", F.lit(1.0))).select("oid", "candid")


from skyflow.operators import parse  # noqa: E402


@register(
    "pair_join",
    """SELECT a.oid, a.fid, count(*) AS n, sum(b.mjd - a.mjd) AS dt, sum(abs(b.mag - a.mag)) AS dm FROM det a JOIN det b ON a.oid = b.oid AND a.fid = b.fid AND (a.mjd, a.candid)
 < (b.mjd, b.candid) AND b.mjd - a.mjd <= 6 GROUP BY a.oid, a.fid""",
    "dt dm",
    4,
)
def pair_join(s, d):
    return features.pair_join(T.detections(s, d), 6.0).groupBy("oid", "fid").agg(F.count("*").alias("n"), F.sum("dt").alias("dt"), F.sum("dm").alias("dm"))


@register(
    "stack_units",
    """SELECT unit, count(*) AS n, avg(b) AS brightness FROM (SELECT 'magnitude' AS unit, mag AS b FROM det UNION ALL SELECT 'diff_flux', pow(10, -(mag - 23.9) / 2.5) *
 isdiffpos FROM det ) GROUP BY unit""",
    "brightness",
    4,
)
def stack_units(s, d):
    return parse.stack_units(T.detections(s, d)).groupBy("unit").agg(F.count("*").alias("n"), F.avg("brightness").alias("brightness"))


@register("eligible_bands", "SELECT oid, fid, count(*) AS n FROM det WHERE NOT forced GROUP BY oid, fid HAVING count(*) >= 12")
def eligible_bands(s, d):
    return variability.eligible_bands(T.detections(s, d), 12).groupBy("oid", "fid").agg(F.count("*").alias("n"))


@register(
    "hierarchical_tables",
    """SELECT oid, 'forest_top' AS classifier_name, class_name, probability FROM prob
 UNION ALL SELECT oid, 'forest_late', class_name, probability FROM prob WHERE starts_with(class_name, 'N')""",
    "probability",
)
def hierarchical_tables(s, d):
    p = T.probabilities(s, d)
    return classify.hierarchical_tables("forest", p, {"Late": p.filter("class_name like 'N%'")}).select("oid", "classifier_name", "class_name", "probability")


@register(
    "fill_not_classified",
    """SELECT o_orderkey AS oid, CASE WHEN a IS NULL THEN 1.0::double ELSE 0 END AS NotClassified, coalesce(a, 0) AS a FROM orders
 LEFT JOIN (SELECT l_orderkey, sum(l_discount) AS a FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1) ON o_orderkey = l_orderkey""",
    "a NotClassified",
)
def fill_not_classified(s, d):
    prob = T.table(s, d, "lineitem").filter("l_returnflag = 'R'").groupBy(F.col("l_orderkey").alias("oid")).agg(F.sum("l_discount").alias("a"))
    return classify.fill_not_classified(T.table(s, d, "orders").select(F.col("o_orderkey").alias("oid")), prob, ["a"])


@register(
    "undersample_windows",
    """SELECT window_id FROM (SELECT *, row_number() OVER (PARTITION BY oid ORDER BY md5(window_id), window_id) AS n FROM (SELECT DISTINCT oid, oid || '_' || w AS window_id FROM
 (SELECT oid, (row_number() OVER (PARTITION BY oid ORDER BY mjd, candid) - 1) // 10 AS w FROM det ))) WHERE CAST(oid AS BIGINT) % 2 = 0 OR n = 1""",
)
def undersample_windows(s, d):
    w = training.count_windows(T.detections(s, d), 10).select("oid", "window_id").distinct()
    labels = w.select("oid").distinct().withColumn("label", F.when(F.col("oid").cast("bigint") % 2 == 0, "keep").otherwise("rest"))
    return training.undersample_windows(w, labels, ["keep"]).select("window_id")


@register("object_document", "SELECT oid, avg(ra) - 180 AS x, avg(dec) AS y, count(DISTINCT (fid, sid)) AS bands FROM det WHERE NOT forced GROUP BY oid", "x y", 3)
def object_document(s, d):
    det = T.detections(s, d)
    obj = det.filter("not forced").groupBy("oid").agg(F.avg("ra").alias("meanra"), F.avg("dec").alias("meandec"))
    doc = stats.object_document(obj, stats.generate_statistics(correct.with_flags(det).withColumn("mag_corr", F.col("mag")), only={"magmean", "ndet"}))
    return doc.select("oid", F.col("loc.coordinates")[0].alias("x"), F.col("loc.coordinates")[1].alias("y"), F.size("magstats").cast("long").alias("bands"))


@register(
    "slotted_length",
    f"""SELECT oid, fid, min(slot) FILTER (r < exp(-1)) * 1.0::double AS SlottedA_length FROM {ACF} GROUP BY oid, fid""",
    "SlottedA_length",
)
def slotted_length(s, d):
    return variability.slotted_length(T.detections(s, d))


from skyflow.plans import catalog_more, catalog_sources  # noqa: E402, F401
