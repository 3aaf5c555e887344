"""Further registered queries: ingestion, commands, periods by band, training tables and feature sets."""

from __future__ import annotations

from pyspark.sql import functions as F

from skyflow.functions import columns as C
from skyflow.operators import classify, commands, correct, feature_sets, features, filters, fits, history, ingest, merge, outputs, parse, period, stats, training, variability
from skyflow.plans import catalog
from skyflow.plans import driver_tables as T
from skyflow.plans.catalog import PRED, QUERIES, _predicted, register
from skyflow.sources import avro

_BEFORE = set(QUERIES)


# --- alerts and ingestion -----------------------------------------------------------


@register(
    "four_tables",
    """WITH a AS (SELECT *, 36028797018963968 + (uid // 676) % 100 * 8031810176 + (uid // 26) % 26 * 26 + uid % 26 AS moid, 1 + candid % 3 AS band FROM
 (SELECT *, CAST(oid AS BIGINT) AS uid FROM det ))
 SELECT 'object' AS kind, moid AS oid, arg_min(candid, (mjd, candid)) AS id, min(mjd) AS mjd, arg_min(mag, (mjd, candid)) AS mag FROM a GROUP BY moid
 UNION ALL SELECT 'detection', moid, candid, mjd, mag FROM a
 UNION ALL SELECT 'detection', moid, candid * 1000003 + 1, mjd - 1, mag + 0.5 FROM a WHERE candid % 2 = 0
 UNION ALL SELECT 'non_detection', moid, band, mjd - 1, min(mag + 1) FROM a WHERE candid % 2 = 1 GROUP BY moid, band, mjd
 UNION ALL SELECT 'forced_photometry', moid, candid * 7 + 1, mjd - 2, -2.5 * log10(10.0::double * (candid % 5) * pow(10, (8.9 - 26.0::double) / 2.5) * 1e6) + 23.9 FROM a WHERE candid % 5 > 0""",
    "mjd mag",
    5,
    longs="id",
)
def four_tables(s, d):
    t = ingest.extract_four_tables(T.alerts(s, d))
    out = t["object"].select(F.lit("object").alias("kind"), "oid", F.col("candid").alias("id"), "mjd", "mag")
    out = out.unionByName(t["detection"].select(F.lit("detection").alias("kind"), "oid", F.col("measurement_id").alias("id"), "mjd", "mag"))
    out = out.unionByName(t["non_detection"].select(F.lit("non_detection").alias("kind"), "oid", F.col("band").alias("id"), "mjd", F.col("diffmaglim").alias("mag")))
    return out.unionByName(t["forced_photometry"].select(F.lit("forced_photometry").alias("kind"), "oid", F.col("measurement_id").alias("id"), "mjd", "mag"))


@register(
    "ingest_tables",
    """SELECT 'object' AS kind, count(DISTINCT oid) AS n FROM det UNION ALL SELECT 'survey_object', count(DISTINCT oid) FROM det
 UNION ALL SELECT k, count(*) + count(*) FILTER (candid % 2 = 0) FROM det , (VALUES ('detection'), ('survey_detection')) v(k) GROUP BY k
 UNION ALL SELECT k, count(*) FROM det , (VALUES ('forced_photometry'), ('survey_forced_photometry')) v(k) WHERE candid % 5 > 0 GROUP BY k
 UNION ALL SELECT 'non_detection', count(*) FROM (SELECT DISTINCT oid, candid % 3, mjd FROM det WHERE candid % 2 = 1)""",
)
def ingest_tables(s, d):
    batch = ingest.extract_four_tables(T.alerts(s, d, distinct=True))
    stored = ingest.ingest_tables(batch, {})
    again = ingest.ingest_tables(batch, stored)  # a replay adds nothing
    parts = [df.groupBy(F.lit(name).alias("kind")).agg(F.count("*").alias("n")) for name, df in again.items()]
    return history.union_aligned(*parts)


@register(
    "surrogate_ids",
    """SELECT count(*) AS n, count(DISTINCT id) AS ids, min(id) AS low, max(id) AS high, count(DISTINCT oid) FILTER (id <= 1000) AS known FROM
 (SELECT oid, dense_rank() OVER (ORDER BY oid) + 1000 AS id FROM det )""",
)
def surrogate_ids(s, d):
    det = T.detections(s, d).select("oid", "candid")
    lookup = s.createDataFrame([("not in the table", 1000)], "oid string, id long")
    rows, _ = ingest.surrogate_ids(det, lookup, "oid")
    return rows.agg(F.count("*").alias("n"), F.count_distinct("id").alias("ids"), F.min("id").alias("low"), F.max("id").alias("high"), F.count_distinct(F.when(F.col("id") <= 1000, F.col("oid"))).alias("known"))


@register(
    "shape_history",
    """SELECT oid, candid, CASE 1 + candid % 3 WHEN 1 THEN 'g' WHEN 2 THEN 'r' ELSE 'i' END AS fid, mag, e_mag,
 CASE 1 + candid % 3 WHEN 1 THEN 0.065::double WHEN 2 THEN 0.085::double ELSE 0.01::double END / abs(cos(radians(dec))) AS e_ra,
 CAST(CAST(mag - 1 AS DOUBLE) AS VARCHAR) IS NOT NULL AS has_extra, FALSE AS forced, FALSE AS new FROM det """,
    "mag e_mag e_ra",
)
def shape_history(s, d):
    det = T.detections(s, d)
    stored = det.select(
        "oid", "candid", "mjd", "ra", "dec", "isdiffpos", (1 + F.col("candid") % 3).alias("fid"), F.col("mag").alias("magpsf"), F.col("e_mag").alias("sigmapsf"), (F.col("mag") - 1).alias("magpsf_corr"), "rb"
    )
    out = ingest.shape_detections(stored)
    return out.select("oid", "candid", "fid", "mag", "e_mag", "e_ra", F.col("extra_fields")["mag_corr"].isNotNull().alias("has_extra"), "forced", "new")


@register(
    "forced_service_observations",
    """SELECT oid, candid FROM (SELECT *, count(*) FILTER (hit) OVER o AS n, min(CASE WHEN hit THEN mjd END) OVER o AS a, max(CASE WHEN hit THEN mjd END) OVER o AS b FROM
 (SELECT *, rb > 0.5 AS hit FROM det WHERE fid IN ('click', 'view') AND candid % 3 < 2) WINDOW o AS (PARTITION BY oid)) WHERE n >= 8 AND mjd BETWEEN a - 30 AND b""",
)
def forced_service_observations(s, d):
    band = F.when(F.col("fid") == "click", "g").when(F.col("fid") == "view", "r").otherwise("i")
    status = F.element_at(F.array(F.lit("0"), F.lit("57"), F.lit("255")), (F.col("candid") % 3 + 1).cast("int"))
    lc = T.detections(s, d).withColumns({"fid": band, "procstatus": status, "detected": F.col("rb") > 0.5})
    return ingest.forced_service_observations(lc).select("oid", "candid")


@register("drop_same_mjd", "SELECT oid, min(candid) AS candid FROM det GROUP BY oid, mjd")
def drop_same_mjd(s, d):
    det = T.detections(s, d)
    return ingest.drop_same_mjd(det.unionByName(det.withColumn("candid", F.col("candid") + 10**9))).select("oid", "candid")


@register(
    "forced_and_limits",
    """SELECT oid, candid, 'forced' AS kind FROM det WHERE forced UNION ALL SELECT oid, candid, 'limit' FROM
 (SELECT DISTINCT oid FROM det WHERE new) JOIN det USING (oid) WHERE NOT new AND NOT forced""",
)
def forced_and_limits(s, d):
    det = T.detections(s, d)
    forced = history.read_forced(det.filter("forced"), det).select("oid", "candid", F.lit("forced").alias("kind"))
    return forced.unionByName(history.read_limits(det.filter("not new and not forced"), det.filter("new")).select("oid", "candid", F.lit("limit").alias("kind")))


@register(
    "standardized_alerts",
    """SELECT candid, mag, e_mag, CASE 1 + candid % 3 WHEN 1 THEN 'g' WHEN 2 THEN 'r' ELSE 'i' END AS fid, isdiffpos, mjd FROM det """,
    "mag e_mag mjd",
)
def standardized_alerts(s, d):
    routed = parse.route_survey(T.alerts(s, d), {"ztf": (F.col("objectId").startswith("ZTF"), parse.standardize_ztf)})
    return routed.select(F.col("candid").cast("long").alias("candid"), "mag", "e_mag", "fid", "isdiffpos", "mjd")


@register(
    "previous_and_limits",
    """SELECT candid * 1000003 + 1 AS id, 'previous' AS kind, mag + 0.5 AS mag FROM det WHERE candid % 2 = 0
 UNION ALL SELECT 0, 'limit', mag + 1 FROM det WHERE candid % 2 = 1
 UNION ALL SELECT candid * 7 + 1, 'forced', -2.5 * log10(10.0::double * (candid % 5) * pow(10, (8.9 - 26.0::double) / 2.5) * 1e6) + 23.9 FROM det WHERE candid % 5 > 0""",
    "mag",
    5,
)
def previous_and_limits(s, d):
    a = T.alerts(s, d)
    old = parse.explode_previous(a).select(F.col("candid").cast("long").alias("id"), F.lit("previous").alias("kind"), "mag")
    limits = parse.explode_limits(a).select(F.lit(0).cast("long").alias("id"), F.lit("limit").alias("kind"), F.col("diffmaglim").alias("mag"))
    forced = parse.explode_forced(a).select((F.col("pid")).cast("long").alias("id"), F.lit("forced").alias("kind"), "mag")
    return old.unionByName(limits).unionByName(forced)


@register(
    "assembled_messages",
    "SELECT oid, count(*) FILTER (NOT forced) AS n_detections, count(*) AS n_limits FROM det GROUP BY oid",
)
def assembled_messages(s, d):
    det, nd = T.detections(s, d), T.limits(s, d)
    objects = det.select("oid").distinct()
    out = parse.assemble_messages(objects, det.filter("not forced").select("oid", "mjd", "candid", "mag"), nd.select("oid", "mjd", "diffmaglim"))
    return out.select("oid", F.size("detections").cast("long").alias("n_detections"), F.size("non_detections").cast("long").alias("n_limits"))


# --- statistics, correction, outputs ------------------------------------------------


@register("reference_change", "SELECT oid, arg_max(mjd + candid % 9 - 20, (mjd, candid)) > min(mjd) AS reference_change FROM det GROUP BY oid")
def reference_change(s, d):
    return stats.reference_change(T.detections(s, d).withColumn("mjdendref", F.col("mjd") + F.col("candid") % 9 - 20))


@register(
    "correct_multistream",
    f"SELECT oid, candid AS measurement_id, corrected, dubious, stellar, mag_corr FROM (WITH {catalog.FLAGS} SELECT * FROM corr) x JOIN (SELECT oid, max(mjd) AS m FROM det WHERE new GROUP BY oid) l USING (oid) WHERE mjd <= m",
    "mag_corr",
)
def correct_multistream(s, d):
    det = T.detections(s, d).withColumnsRenamed({"candid": "measurement_id", "fid": "band"})
    rows, _ = correct.correct_multistream(det.filter("new").drop("new"), det.filter("not new").drop("new"))
    return rows.select("oid", "measurement_id", "corrected", "dubious", "stellar", "mag_corr")


@register(
    "stamp_output",
    "SELECT oid, (min((-probability, class_name)))[2] AS first, count(*) AS n FROM prob GROUP BY oid",
)
def stamp_output(s, d):
    out = classify.stamp_output(T.probabilities(s, d), "stamps", "1")
    return out.select("oid", F.col("classifications")[0]["class_name"].alias("first"), F.size("classifications").cast("long").alias("n"))


@register("attach_labels", "SELECT doc_id AS oid, n_chars, quality AS label FROM documents JOIN labels USING (doc_id)")
def attach_labels(s, d):
    f = T.table(s, d, "documents").select(F.col("doc_id").alias("oid"), "n_chars")
    return training.attach_labels(f, T.table(s, d, "labels").select(F.col("doc_id").alias("oid"), F.col("quality").alias("label")))


@register(
    "output_names",
    "SELECT candid, replace(fid || '-x', '-', '_') || CASE 1 + candid % 3 WHEN 1 THEN '_1' WHEN 2 THEN '_2' ELSE '' END AS name, CASE WHEN rb > 0 THEN mag / rb END AS value FROM det ",
    "value",
)
def output_names(s, d):
    band = F.element_at(F.array(F.lit("g"), F.lit("r"), F.lit("")), (F.col("candid") % 3 + 1).cast("int"))
    ratio = F.when(F.col("rb") == 0, float("inf")).otherwise(F.col("mag") / F.nullif("rb", F.lit(0.0)))
    det = T.detections(s, d).select("candid", F.concat("fid", F.lit("-x")).alias("name"), band.alias("fid"), ratio.alias("value"))
    return C.clean_for_output(det).drop("fid")


@register(
    "watchlist_matches",
    """SELECT oid, candid, CASE WHEN fid IN ('click', 'view') THEN '{"mag":' || candid || ',"rb":' || isdiffpos || '}' ELSE '{}' END AS values,
 fid = 'click' AS ready_to_notify FROM det """,
)
def watchlist_matches(s, d):
    det = T.detections(s, d)
    m = det.select("oid", "candid", F.lit(1).alias("target_id"), "fid", F.col("candid").alias("mag"), F.col("isdiffpos").alias("rb"))
    none = m.select("oid", "candid", "target_id", F.lit("{}").alias("values"), F.lit(False).alias("ready_to_notify")).limit(0)
    stored = commands.insert_matches(commands.insert_matches(none, m), m)  # twice: known ones stay
    values = outputs.watchlist_values(m, {"click": ["mag", "rb"], "view": ["mag", "rb"]}, by="fid")
    stored = commands.update_match_values(stored, values)
    return commands.mark_notify(stored, m.filter("fid = 'click'")).select("oid", "candid", "values", "ready_to_notify")


# --- commands -----------------------------------------------------------------------


def _commands(df, collection, kind, criteria, data, **options):
    rows = merge.command_rows(df, collection, kind, criteria, data, **options)
    return merge.parse_commands(rows).select("kind", "valid", "cmd.criteria", "cmd.data", F.monotonically_increasing_id().alias("seq"))


@register(
    "upsert_detections",
    "SELECT oid, candid, CASE 1 + candid % 3 WHEN 1 THEN 1 WHEN 2 THEN 2 ELSE 3 END AS fid, mag AS magpsf, CAST(rb AS DOUBLE) AS rb FROM det ",
    "magpsf rb",
)
def upsert_detections(s, d):
    band = F.element_at(F.array(F.lit("g"), F.lit("r"), F.lit("i")), (F.col("candid") % 3 + 1).cast("int"))
    det = T.detections(s, d).withColumns({"band": F.col("fid"), "fid": band, "extra_fields": F.struct("rb")})
    stored = det.filter("not new").select("oid", "candid", F.lit(0).alias("fid"), F.lit(0.0).alias("magpsf"), F.lit(0.0).alias("rb"))
    cmds = _commands(det, "detection", "update", ["candid", "oid"], ["mag", "fid", "extra_fields"], upsert=True)
    return commands.apply_commands({"detection": stored}, cmds, ["upsert_detections"])["detection"]


@register(
    "upsert_forced",
    "SELECT oid, candid AS pid, CASE 1 + candid % 3 WHEN 1 THEN 1 WHEN 2 THEN 2 ELSE 3 END AS fid, mag, rb AS distnr FROM det ",
    "mag distnr",
)
def upsert_forced(s, d):
    band = F.element_at(F.array(F.lit("g"), F.lit("r"), F.lit("i")), (F.col("candid") % 3 + 1).cast("int"))
    det = T.detections(s, d).withColumns({"fid": band, "pid": F.col("candid"), "extra_fields": F.struct(F.col("rb").alias("distnr"))})
    stored = det.filter("forced").select("oid", "pid", F.lit(0).alias("fid"), F.lit(0.0).alias("mag"), F.lit(0.0).alias("distnr"))
    cmds = _commands(det, "forced_photometry", "update", ["pid", "oid"], ["mag", "fid", "extra_fields"], upsert=True)
    return commands.apply_commands({"forced_photometry": stored}, cmds, ["upsert_forced"])["forced_photometry"]


@register(
    "upsert_object_stats",
    """SELECT 'object' AS kind, oid, 0 AS fid, CAST(count(*) AS DOUBLE) AS value FROM det GROUP BY oid
 UNION ALL SELECT 'magstats', oid, f, CAST(count(*) AS DOUBLE) FROM (SELECT oid, 1 + candid % 3 AS f FROM det ) GROUP BY oid, f""",
)
def upsert_object_stats(s, d):
    band = F.element_at(F.array(F.lit("g"), F.lit("r"), F.lit("i")), (F.col("candid") % 3 + 1).cast("int"))
    per = T.detections(s, d).withColumn("fid", band).groupBy("oid", "fid").agg(F.count("*").alias("ndet"))
    obj = per.groupBy("oid").agg(F.sum("ndet").alias("ndet"), F.collect_list(F.struct("fid", "ndet")).alias("magstats")).withColumnRenamed("oid", "_id")
    stored = {"object": per.select("oid", F.lit(0).cast("long").alias("ndet")).distinct(), "magstats": per.select("oid", F.lit(1).alias("fid"), F.lit(0).cast("long").alias("ndet"), F.lit(True).alias("stellar")).limit(0)}
    cmds = _commands(obj, "magstats", "upsert", ["_id"], ["ndet", "magstats"])
    out = commands.apply_commands(stored, cmds, ["upsert_object_stats"])
    a = out["object"].select(F.lit("object").alias("kind"), "oid", F.lit(0).alias("fid"), F.col("ndet").cast("double").alias("value"))
    return a.unionByName(out["magstats"].select(F.lit("magstats").alias("kind"), "oid", "fid", F.col("ndet").cast("double").alias("value")))


@register(
    "update_object_from_stats",
    "SELECT oid, count(*) AS ndet, min(mjd) AS firstmjd, 'kept' AS note FROM det GROUP BY oid",
    "firstmjd",
)
def update_object_from_stats(s, d):
    det = T.detections(s, d)
    new = det.groupBy("oid").agg(F.count("*").alias("ndet"), F.min("mjd").alias("firstmjd"), F.lit("changed").alias("note"))
    stored = det.select("oid", F.lit(0).cast("long").alias("ndet"), F.lit(0.0).alias("firstmjd"), F.lit("kept").alias("note")).distinct()
    cmds = _commands(new, "object", "update", ["oid"], ["ndet", "firstmjd", "note"])
    return commands.apply_commands({"object": stored}, cmds, ["update_object_from_stats"])["object"]


@register("insert_object", "SELECT oid, CASE WHEN bool_or(NOT new) THEN 0.0::double ELSE min(mjd) END AS firstmjd FROM det GROUP BY oid", "firstmjd")
def insert_object(s, d):
    det = T.detections(s, d)
    stored = det.filter("not new").select("oid", F.lit(0.0).alias("firstmjd")).distinct()
    cmds = _commands(det.groupBy("oid").agg(F.min("mjd").alias("firstmjd")), "object", "insert", ["oid"], ["firstmjd"])
    return commands.apply_commands({"object": stored}, cmds, ["insert_object"])["object"]


@register("upsert_non_detections", "SELECT oid, 1 + candid % 3 AS fid, mjd, max(mag) AS diffmaglim FROM det GROUP BY ALL", "diffmaglim", longs="fid")
def upsert_non_detections(s, d):
    band = F.element_at(F.array(F.lit("g"), F.lit("r"), F.lit("i")), (F.col("candid") % 3 + 1).cast("int"))
    det = T.detections(s, d).withColumns({"fid": band, "diffmaglim": F.col("mag")})
    stored = det.filter("not new").select("oid", (F.col("candid") % 3 + 1).cast("int").alias("fid"), "mjd", F.lit(0.0).alias("diffmaglim")).distinct()
    cmds = _commands(det, "non_detection", "update", ["oid", "fid", "mjd"], ["diffmaglim"], upsert=True)
    return commands.apply_commands({"non_detection": stored}, cmds, ["upsert_non_detections"])["non_detection"]


@register("upsert_features", "SELECT oid, fid AS name, 12 AS fid, 'v1' AS version, avg(mag) AS value FROM det GROUP BY oid, fid", "value")
def upsert_features(s, d):
    wide = T.detections(s, d).groupBy("oid", F.col("fid").alias("name")).agg(F.avg("mag").alias("value"))
    rows = wide.groupBy(F.col("oid").alias("_id")).agg(F.collect_list(F.struct("name", F.lit("gr").alias("fid"), "value")).alias("features"))
    rows = rows.withColumns({"features_version": F.lit("v1"), "features_group": F.lit("g")})
    stored = wide.select("oid", "name", F.lit(12).alias("fid"), F.lit("v1").alias("version"), F.lit(0.0).alias("value")).filter("name = 'click'")
    cmds = _commands(rows, "object", "update_features", ["_id"], ["features", "features_version", "features_group"])
    return commands.apply_commands({"feature": stored}, cmds, ["upsert_features"])["feature"]


@register(
    "upsert_probabilities",
    "SELECT CAST(oid AS VARCHAR) AS oid, class_name, 'share' AS classifier_name, '1.0' AS classifier_version, probability, row_number() OVER (PARTITION BY oid ORDER BY probability DESC, class_name) AS ranking FROM prob ",
    "probability",
    longs="ranking",
)
def upsert_probabilities(s, d):
    prob = T.probabilities(s, d)
    classes = [r[0] for r in prob.select("class_name").distinct().orderBy("class_name").collect()]  # the classes
    wide = prob.groupBy(F.col("oid").cast("string").alias("_id")).pivot("class_name", classes).agg(F.max("probability"))
    wide = wide.withColumns({"classifier_name": F.lit("share"), "classifier_version": F.lit("1.0")})
    stored = prob.select(F.col("oid").cast("string").alias("oid"), "class_name", "classifier_name", "classifier_version", F.lit(0.0).alias("probability"), F.lit(9).alias("ranking")).filter(F.col("class_name") == classes[0])
    cmds = _commands(wide, "object", "update_probabilities", ["_id"], ["classifier_name", "classifier_version", *classes])
    return commands.apply_commands({"probability": stored}, cmds, ["upsert_probabilities"])["probability"]


@register(
    "upsert_xmatch",
    "SELECT CAST(c_custkey AS VARCHAR) AS oid, 'wise' AS catid, CAST(c_nationkey AS VARCHAR) AS oid_catalog, c_acctbal AS dist FROM customer",
    "dist",
)
def upsert_xmatch(s, d):
    c = T.table(s, d, "customer").select(F.col("c_custkey").cast("string").alias("_id"), F.struct(F.struct(F.col("c_nationkey").cast("string").alias("catoid"), F.col("c_acctbal").alias("dist")).alias("wise")).alias("xmatch"), "c_mktsegment")
    stored = c.filter("c_mktsegment = 'BUILDING'").select(F.col("_id").alias("oid"), F.lit("wise").alias("catid"), F.lit("").alias("oid_catalog"), F.lit(0.0).alias("dist"))
    cmds = _commands(c, "object", "update", ["_id"], ["xmatch"])
    return commands.apply_commands({"xmatch": stored}, cmds, ["upsert_xmatch"])["xmatch"]


@register(
    "upsert_score",
    "SELECT CAST(oid AS VARCHAR) AS oid, 'share' AS detector_name, '1' AS detector_version, class_name AS category_name, probability AS score FROM prob ",
    "score",
)
def upsert_score(s, d):
    rows = T.probabilities(s, d).groupBy(F.col("oid").cast("string").alias("_id")).agg(F.collect_list(F.struct(F.col("class_name").alias("name"), F.col("probability").alias("score"))).alias("categories"))
    rows = rows.withColumns({"detector_name": F.lit("share"), "detector_version": F.lit("1")})
    stored = rows.select(F.col("_id").alias("oid"), "detector_name", "detector_version", F.col("categories")[0]["name"].alias("category_name"), F.lit(0.0).alias("score"))
    cmds = _commands(rows, "score", "insert", ["_id"], ["detector_name", "detector_version", "categories"])
    return commands.apply_commands({"score": stored}, cmds, ["upsert_score"])["score"]


@register(
    "upsert_seen_objects",
    """SELECT oid, max(candid) AS ndethist, CASE WHEN bool_or(NOT new) THEN 0.0::double ELSE arg_max(ra, (mjd, candid)) END AS meanra FROM det GROUP BY oid""",
    "meanra",
)
def upsert_seen_objects(s, d):
    det = T.detections(s, d).withColumns({"jdstarthist": F.col("mjd") + 2400000.5, "jdendhist": F.col("mjd") + 2400000.5, "ncovhist": F.lit(1).cast("long")})
    last = det.groupBy("oid").agg(F.max(F.struct("mjd", "candid", "ra", "dec", "jdstarthist", "jdendhist", "ncovhist")).alias("x"), F.max("candid").alias("ndethist")).select("oid", "x.*", "ndethist")
    known = det.filter("not new").select("oid").distinct()
    zero = {c: F.lit(0.0) for c in ("mjdstarthist", "mjdendhist", "meanra", "meandec", "firstmjd", "lastmjd", "deltajd")} | {c: F.lit(0).cast("long") for c in ("ndethist", "ncovhist")}
    return commands.upsert_seen_objects(known.withColumns(zero), last).select("oid", "ndethist", "meanra")


@register(
    "upsert_metadata",
    """SELECT 'ss' AS kind, candid, TRUE AS unique1 FROM det UNION ALL
 SELECT 'ps1', candid, CASE WHEN forced THEN NOT (bool_or(NOT forced) OVER (PARTITION BY oid)) ELSE NOT (bool_or(forced) OVER (PARTITION BY oid)) END FROM det """,
)
def upsert_metadata(s, d):
    det = T.detections(s, d)
    # an object's neighbour is the same in all its alerts; forced rows are stored, the others are new
    ps1 = det.select("oid", "candid", "forced", *(F.col("oid").cast("double").alias(f"objectidps{k}") for k in (1, 2, 3)))
    flags = {f"unique{k}": F.lit(True) for k in (1, 2, 3)}
    gaia = det.groupBy("oid").agg(F.max("candid").alias("candid")).withColumns({"maggaia": F.lit(15.0), "maggaiabright": F.lit(14.0), "unique1": F.lit(True)})
    ref = det.select("oid", "candid", (F.col("candid") % 3).alias("rfid"))
    rows = det.select("oid", "candid")
    stored = {"ss": rows.limit(0), "dataquality": rows.limit(0), "reference": ref.limit(0), "gaia": gaia, "ps1": ps1.filter("forced").drop("forced").withColumns(flags)}
    out = commands.upsert_metadata(stored, {"ss": rows, "dataquality": rows, "reference": ref, "gaia": gaia.drop("unique1"), "ps1": ps1.filter("not forced").drop("forced")})
    return out["ss"].select(F.lit("ss").alias("kind"), "candid", F.lit(True).alias("unique1")).unionByName(out["ps1"].select(F.lit("ps1").alias("kind"), "candid", "unique1"))


@register(
    "document_updates",
    """SELECT oid, (min((-probability, class_name)))[2] AS best, 1 AS classifiers, 1 AS groups, count(*) AS n FROM prob GROUP BY oid""",
    longs="classifiers groups",
)
def document_updates(s, d):
    prob = T.probabilities(s, d)
    docs = prob.select(F.col("oid").alias("_id")).distinct()
    docs = commands.document_insert(docs.limit(0), docs)
    docs = commands.document_update(docs.withColumn("seen", F.lit(False)), docs.withColumns({"seen": F.lit(True), "seq": F.lit(1)}), ["_id"])
    docs = commands.document_probabilities(commands.document_probabilities(docs, prob), prob)  # the second replaces the first
    f = prob.select("oid", F.lit("share").alias("survey"), F.lit("1").alias("version"), F.col("class_name").alias("name"), F.lit(0).alias("fid"), F.col("probability").alias("value"))
    docs = commands.document_features(commands.document_features(docs, f, set_on_insert=True), f, set_on_insert=True)
    return docs.filter("seen").select(
        F.col("_id").alias("oid"), F.col("probabilities")[0]["class_rank_1"].alias("best"), F.size("probabilities").alias("classifiers"), F.size("features").alias("groups"),
        F.size(F.col("features")[0]["features"]).cast("long").alias("n"),
    )


# --- features and training ----------------------------------------------------------


@register(
    "color_mean_max",
    """SELECT oid, avg(mag) FILTER (fid = 'click') - avg(mag) FILTER (fid = 'view') AS "click-view_mean", min(mag) FILTER (fid = 'click') - min(mag) FILTER (fid = 'view') AS "click-view_max" FROM det WHERE NOT forced GROUP BY oid""",
)
def color_mean_max(s, d):
    return features.color_mean_max(T.detections(s, d), ["click", "view"])


@register(
    "reference_features",
    """SELECT oid, avg(distnr) AS mean_distnr, stddev_samp(distnr) AS sigma_distnr, avg(CAST(candid % 3 AS DOUBLE)) AS mean_sharpnr, avg(2.0::double * (candid % 3)) AS mean_chinr FROM det GROUP BY oid""",
    "mean_distnr sigma_distnr mean_sharpnr mean_chinr",
)
def reference_features(s, d):
    det = T.detections(s, d).withColumn("rfid", F.col("candid") % 3)
    refs = det.select("oid", "rfid", F.col("rfid").cast("double").alias("sharpnr"), (2.0 * F.col("rfid")).alias("chinr")).distinct()
    return features.reference_features(det, ingest.valid_reference(refs))


@register(
    "q31_color",
    """SELECT oid, quantile_cont(c, 0.75) - quantile_cont(c, 0.25) AS Q31_color FROM (SELECT a.oid, a.mag - CASE WHEN n.mag IS NULL OR a.mjd - p.mjd <= n.mjd - a.mjd THEN p.mag ELSE n.mag END AS c
 FROM (SELECT * FROM det WHERE NOT forced AND fid = 'click') a ASOF LEFT JOIN (SELECT * FROM det WHERE NOT forced AND fid = 'view') p ON a.oid = p.oid AND a.mjd >= p.mjd
 ASOF LEFT JOIN (SELECT * FROM det WHERE NOT forced AND fid = 'view') n ON a.oid = n.oid AND a.mjd <= n.mjd) GROUP BY oid""",
    "Q31_color",
)
def q31_color(s, d):
    return features.q31_color(T.detections(s, d), "click", "view")


@register("structure_function_indices")
def structure_function_indices(s, d):
    return features.structure_function_indices(T.detections(s, d))


@register(
    "stetson_k_ac",
    f"SELECT oid, fid, CASE WHEN count(*) > 1 AND sum(z * z) > 0 THEN sum(abs(z)) / sqrt(count(*) * sum(z * z)) END AS StetsonK_AC FROM (SELECT *, r - avg(r) OVER (PARTITION BY oid, fid) AS z FROM {catalog.ACF} WHERE slot < 100) GROUP BY oid, fid",
    "StetsonK_AC",
)
def stetson_k_ac(s, d):
    return variability.stetson_k_ac(variability.slotted_autocorrelation(T.detections(s, d)))


@register(
    "band_periods",
    f"""WITH b AS MATERIALIZED (SELECT * FROM {catalog.BAND_POWER}), best AS (SELECT oid, 1 / arg_max(freq, (power, -k)) AS period FROM (
 SELECT oid, k, freq, sum(d2) * sum(power) / (2 * greatest(sum(wvar) - sum(power), 1e-9)) AS power FROM b GROUP BY oid, k, freq) GROUP BY oid),
 own AS (SELECT oid, fid, 1 / arg_max(freq, (greatest(d2, 0) * power / (2 * greatest(wvar - power, 1e-9)), -k)) AS Period_band FROM b GROUP BY oid, fid)
 SELECT oid, fid, Period_band, abs(period - Period_band) AS delta_period FROM own JOIN best USING (oid)""",
    "Period_band delta_period",
    4,
)
def band_periods(s, d):
    return period.each_band(period.object_periods(T.detections(s, d), catalog._grid(s, d), peaks=0))


@register(
    "mutual_information",
    """WITH pts AS (SELECT oid, candid, mjd, mag, count(*) OVER o AS n, 0.9::double * stddev_pop(mag) OVER o * pow(count(*) OVER o, -0.2::double) AS h FROM det WHERE NOT forced WINDOW o AS (PARTITION BY oid)),
 grid AS (SELECT oid, CAST(k AS INTEGER) AS k, 0.05::double + k * (1 - 0.05::double) / (n - 1) AS freq FROM (SELECT oid, unnest(range(n)) AS k, n FROM (
 SELECT oid, greatest(64, ceil((1 - 0.05::double) * (max(mjd) - min(mjd)) / 0.2::double)::int) AS n FROM det GROUP BY oid))),
 pairs AS (SELECT a.oid, a.candid AS i, a.n, a.mjd - b.mjd AS dt, exp(-pow((a.mag - b.mag) / a.h, 2) / 4) AS km FROM pts a JOIN pts b ON a.oid = b.oid),
 points AS (SELECT oid, k, freq, i, any_value(n) AS n, sum(km * kp) AS j, sum(km) AS m, sum(kp) AS p FROM (
 SELECT pairs.*, k, freq, exp((cos(2 * pi() * dt * freq) - 1) / 0.16::double) AS kp FROM pairs JOIN grid USING (oid)) GROUP BY oid, k, freq, i)
 SELECT oid, k, freq, ln(vj * vm / (vc * vc)) AS power FROM (
 SELECT oid, k, freq, sum(j) / pow(any_value(n), 2) AS vj, sum(m) * sum(p) / pow(any_value(n), 4) AS vm, sum(m * p) / pow(any_value(n), 3) AS vc FROM points GROUP BY oid, k, freq)""",
    "freq power",
    5,
)
def mutual_information(s, d):
    det = T.detections(s, d)
    return period.qmi(det, period.frequency_spec(det, 1.0, 20.0, least=64))


@register("alert_containers", "SELECT candid, isdiffpos, mjd + 2400000.5::double AS jd, mag + 0.5::double AS previous FROM det", "jd previous", 6)
def alert_containers(s, d):
    """Nested alerts written as Avro containers and read again."""
    alerts = T.alerts(s, d)
    again = avro.from_containers(avro.to_containers(alerts), alerts.schema)
    sign = F.when(F.col("candidate.isdiffpos") == "t", 1).otherwise(-1)
    return again.select("candid", sign.alias("isdiffpos"), "candidate.jd", F.col("prv_candidates")[0]["magpsf"].alias("previous"))


@register("two_harmonics")
def two_harmonics(s, d):
    return period.period_features(period.mhaov_multiband(T.detections(s, d), catalog._grid(s, d), 2))


@register("feature_set")
def feature_set(s, d):
    """The cheap half of the set; the registered period queries show the rest."""
    det = T.detections(s, d)
    only = ["color", "mhps", "mhps_long", "gp_drw", "turbo", "tde_tail", "fleet", "color_variation", "sn", "microlensing", "timespan", "coordinates"]
    return feature_sets.feature_set(det, "ztf", ["click", "view"], only)


@register(
    "multi_horizon_features",
    "SELECT oid, '' AS fid, 'timespan' AS name, max(mjd) - min(mjd) AS value, h AS horizon FROM (SELECT *, min(CASE WHEN NOT forced THEN mjd END) OVER (PARTITION BY oid) AS f FROM det ), (VALUES (4.0::double), (16.0::double), (NULL)) v(h) WHERE h IS NULL OR mjd <= f + h GROUP BY oid, h",
    "value",
)
def multi_horizon_features(s, d):
    compute = lambda obs: feature_sets.feature_set(obs, "ztf", ["click", "view"], ["timespan"])
    return training.multi_horizon_features(T.detections(s, d), [4, 16], compute).drop("version")


@register(
    "consolidate",
    """SELECT oid, NULL::double AS horizon, max(mag) FILTER (fid = 'click') AS m_click, max(mag) FILTER (fid = 'view') AS m_view FROM det GROUP BY oid""",
    "m_click m_view",
)
def consolidate(s, d):
    f = T.detections(s, d).select("oid", F.lit(None).cast("double").alias("horizon"), F.lit("m").alias("name"), "fid", F.col("mag").alias("value"))
    return training.consolidate(f, ["m_click", "m_view"])


@register(
    "training_partitions",
    "SELECT count(*) AS n, count(*) FILTER (test) AS held FROM (SELECT row_number() OVER (PARTITION BY quality ORDER BY md5(CAST(doc_id AS VARCHAR) || ':0'), doc_id) - 0.5 < 0.2 * count(*) OVER (PARTITION BY quality) AS test FROM labels)",
)
def training_partitions(s, d):
    parts = training.partitions(T.table(s, d, "labels").select(F.col("doc_id").alias("oid"), F.col("quality").alias("label")))
    return parts.agg(F.count("*").alias("n"), F.count(F.when(F.col("blind_label") == "unknown", 1)).alias("held"))


@register(
    "reports_by_group",
    f"""SELECT g, class_name, coalesce(tp / nullif(said, 0), 0) AS precision, coalesce(tp / nullif(support, 0), 0) AS recall, support FROM (
 SELECT g, c AS class_name, count(*) FILTER (truth = c) AS support, count(*) FILTER (guess = c) AS said, count(*) FILTER (truth = c AND guess = c) AS tp
 FROM (SELECT *, truth AS g FROM ({PRED})), (VALUES (0), (1)) v(c) GROUP BY g, c) WHERE support + said > 0""",
    "precision recall",
)
def reports_by_group(s, d):
    p = _predicted(s, d).withColumn("g", F.col("truth"))
    return training.reports(p, "truth", "guess", ["g"]).drop("f1")


@register("per_class_accuracy", f"SELECT truth, avg(CAST(truth = guess AS INTEGER)) AS accuracy, count(*) AS n FROM ({PRED}) GROUP BY truth", "accuracy")
def per_class_accuracy(s, d):
    return training.per_class_accuracy(_predicted(s, d), "truth", "guess")


@register(
    "quantile_transform",
    """SELECT candid, CASE WHEN v <= q[1] THEN 0.0::double WHEN v >= q[11] THEN 1.0::double ELSE (k - 1 + (v - q[k]) / (q[k + 1] - q[k])) / 10 END AS uniform FROM (
 SELECT candid, mag AS v, q, len(list_filter(q, lambda x: x <= mag)) AS k FROM det , (SELECT """
    + "["
    + ", ".join(f"quantile_cont(mag, {k / 10})" for k in range(11))
    + "] AS q FROM det ))",
    "uniform",
    4,
)
def quantile_transform(s, d):
    det = T.detections(s, d).select("candid", F.lit("mag").alias("name"), F.col("mag").alias("v"))
    return training.quantile_transform(det, training.feature_quantiles(det, "name", "v"), "name", "v").select("candid", "uniform")


@register("metadata_quantiles")
def metadata_quantiles(s, d):
    labels = T.table(s, d, "labels").select(F.col("doc_id").alias("oid"), F.col("quality").alias("label"))
    md = T.table(s, d, "documents").select(F.col("doc_id").alias("oid"), "n_chars", F.col("lang").alias("code"))
    return training.metadata_quantiles(md, training.stratified_split(labels), ["n_chars", "code"])


@register(
    "sample_objects",
    "SELECT doc_id AS oid, quality AS label FROM labels QUALIFY row_number() OVER (PARTITION BY quality ORDER BY md5(CAST(doc_id AS VARCHAR) || ':0'), doc_id) <= 20",
)
def sample_objects(s, d):
    return training.sample_objects(T.table(s, d, "labels").select(F.col("doc_id").alias("oid"), F.col("quality").alias("label")), 20)


@register("sequence_sample_log_time")
def sequence_sample_log_time(s, d):
    return training.sequence_sample(T.detections(s, d), 8, "log_time")


@register("sequence_sample_mixed")
def sequence_sample_mixed(s, d):
    return training.sequence_sample(T.detections(s, d), 8, "linear_log_time")


@register("quality_of_rows", "SELECT candid FROM det WHERE NOT (abs(mag - 100) <= 1e-8 + 1e-5 * 100) AND mag > 6 AND mag < 30 AND e_mag < 1")
def quality_of_rows(s, d):
    det = filters.drop_sentinel_mags(T.detections(s, d))
    obs = det.select("candid", F.lit("magnitude").alias("unit"), F.col("mag").alias("brightness"), F.col("e_mag").alias("e_brightness"))
    return filters.drop_absurd(obs).select("candid")


@register(
    "merge_references",
    "SELECT oid, candid % 3 AS rfid, bool_or(new) AS from_message FROM det GROUP BY ALL",
)
def merge_references(s, d):
    det = T.detections(s, d).select("oid", (F.col("candid") % 3).alias("rfid"), "new")
    rows = lambda new: det.filter(F.col("new") == new).select("oid", "rfid", F.lit(new).alias("from_message")).distinct()
    return variability.merge_references(rows(True), rows(False))


@register("complex_autoregression_fits")
def complex_autoregression_fits(s, d):
    return fits.fit_ciar(T.detections(s, d))


@register(
    "metadata_tables",
    """SELECT 'gaia' AS kind, candid, NULL::double AS magnr FROM det UNION ALL SELECT 'ps1', candid, NULL::double FROM det
 UNION ALL SELECT 'ss', candid, NULL::double FROM det UNION ALL SELECT 'dataquality', candid, NULL::double FROM det UNION ALL SELECT 'reference', candid, mag + 1 FROM det """,
    "magnr",
)
def metadata_tables(s, d):
    a = T.alerts(s, d)
    a = a.withColumn("candidate", F.col("candidate").withField("magnr", F.col("candidate.diffmaglim")).withField("jdstartref", F.col("candidate.jd")))
    parts = [t.select(F.lit(n).alias("kind"), F.col("candid").cast("long").alias("candid"), (F.col("magnr") if n == "reference" else F.lit(None).cast("double")).alias("magnr")) for n, t in outputs.metadata_tables(a).items()]
    return history.union_aligned(*parts)


@register(
    "public_classification",
    """SELECT p.oid, arg_max(candid, (new, mjd, -candid)) AS candid, any_value(n) AS n, any_value(best) AS best FROM
 (SELECT oid, count(*) AS n, max(probability) AS best FROM prob GROUP BY oid) p JOIN det ON CAST(p.oid AS VARCHAR) = det.oid GROUP BY p.oid""",
    "best",
)
def public_classification(s, d):
    prob = T.probabilities(s, d).withColumn("oid", F.col("oid").cast("string"))
    names = [r[0] for r in prob.select("class_name").distinct().orderBy("class_name").collect()]  # the classes
    det = T.detections(s, d).withColumn("has_stamp", F.lit(True))
    out = outputs.public_classification(prob, det, {n: k for k, n in enumerate(names)}, "share")
    given = F.filter("classifications", lambda x: x["probability"] > 0)
    return out.select(F.col("oid").cast("long").alias("oid"), "candid", F.size(given).cast("long").alias("n"), F.array_max(F.transform("classifications", lambda x: x["probability"])).alias("best"))


@register(
    "split_metadata",
    """SELECT oid, 'meta' AS kind, max(ra) AS value FROM det GROUP BY oid UNION ALL SELECT oid, 'feature', max(mag) FILTER (fid = 'click') FROM det GROUP BY oid""",
    "value",
)
def split_metadata(s, d):
    g = T.detections(s, d).groupBy("oid", "fid").agg(F.max("mag").alias("m"), F.max("ra").alias("r"))
    m = g.select("oid", F.lit(1).alias("horizon"), F.lit("m").alias("name"), "fid", F.col("m").alias("value"))
    r = g.groupBy("oid").agg(F.max("r").alias("value")).select("oid", F.lit(1).alias("horizon"), F.lit("r").alias("name"), F.lit("all").alias("fid"), "value")
    md, fe = outputs.split_metadata(m.unionByName(r), ["r_all"], ["m_click"])
    return md.select("oid", F.lit("meta").alias("kind"), F.col("r_all").alias("value")).unionByName(fe.select("oid", F.lit("feature").alias("kind"), F.col("m_click").alias("value")))


@register(
    "sequence_masks",
    """SELECT oid, fid, max(mjd) - min(mjd) AS span, count(*) AS n FROM (SELECT *, row_number() OVER (PARTITION BY oid, fid ORDER BY mjd, candid) - 1 AS i, count(*) OVER (PARTITION BY oid, fid) AS m FROM det )
 WHERE m <= 8 OR list_contains([j * (m - 1) // 7 for j in range(8)], i) GROUP BY oid, fid""",
    "span",
)
def sequence_masks(s, d):
    seq = outputs.sequence_masks(training.sequence_sample(T.detections(s, d), 8))
    return seq.select("oid", "fid", F.array_max("relative").alias("span"), F.aggregate("mask", F.lit(0).cast("long"), lambda a, x: a + x).alias("n"))


@register(
    "drop_bad_supernovae",
    """SELECT * FROM (WITH p AS (SELECT CAST(oid AS VARCHAR) AS oid, CASE class_name WHEN 'NO' THEN 'SN' ELSE class_name END AS class_name, probability FROM prob ),
 t AS (SELECT oid, (min((-probability, class_name)))[2] AS best FROM p GROUP BY oid)
 SELECT oid, class_name FROM p WHERE oid NOT IN (SELECT oid FROM t WHERE best = 'SN' AND oid IN (SELECT oid FROM det WHERE isdiffpos = -1 OR (sgscore1 > 0.5 AND distpsnr1 < 1))))""",
)
def drop_bad_supernovae(s, d):
    name = F.when(F.col("class_name") == "NO", "SN").otherwise(F.col("class_name"))
    prob = T.probabilities(s, d).withColumns({"oid": F.col("oid").cast("string"), "class_name": name})
    return classify.drop_bad_supernovae(prob, T.detections(s, d)).select("oid", "class_name")


@register(
    "asteroids_and_bands",
    """SELECT candid, candid % 4 > 0 AS asteroid, CASE 1 + candid % 3 WHEN 1 THEN 'g' WHEN 2 THEN 'r' ELSE 'i' END AS band, 1 + candid % 3 AS number, TRUE AS valid FROM det """,
    longs="number",
)
def asteroids_and_bands(s, d):
    a = T.alerts(s, d).withColumns({"ssdistnr": F.when(F.col("candid") % 4 == 0, -999.0).otherwise(1.0), "band": C.band_letter(F.col("candidate.fid"))})
    return a.select("candid", filters.is_asteroid().alias("asteroid"), "band", C.band_number(F.col("band")).alias("number"), C.valid_oid(F.col("objectId")).alias("valid"))


@register(
    "catalogue_colors",
    """SELECT oid, fid, w1 - (w1 + 1) AS W1_W2, m - w1 AS mean_W1 FROM (SELECT oid, fid, avg(mag) AS m FROM det WHERE NOT forced GROUP BY oid, fid) JOIN (SELECT CAST(cat_id AS VARCHAR) AS oid, nullif(w1, -9999) AS w1 FROM cat ) USING (oid)""",
    "W1_W2 mean_W1",
    4,
)
def catalogue_colors(s, d):
    w = T.catalog(s, d).select(F.col("cat_id").cast("string").alias("oid"), *((F.col("w1") + k).alias(f"w{k + 1}") for k in range(4)))
    return variability.allwise_colors(T.detections(s, d), w).select("oid", "fid", "W1_W2", "mean_W1")


@register("survey_colors", "SELECT candid AS oid, nullif(sgscore1, -999) AS sgscore1, mag - (mag + 1) AS ps_g_r FROM det ", "ps_g_r sgscore1")
def survey_colors(s, d):
    mags = {f"s{b}mag1": F.col("mag") + k for k, b in enumerate("griz")}
    return variability.panstarrs_colors(T.detections(s, d).withColumn("oid", F.col("candid")).withColumns(mags)).select("oid", "sgscore1", "ps_g_r")


@register(
    "unique_neighbours",
    'SELECT candid, NOT bool_or(forced) OVER (PARTITION BY oid) AS "unique" FROM det QUALIFY NOT forced',
)
def unique_neighbours(s, d):
    det = T.detections(s, d).withColumn("neighbour", F.col("oid").cast("double"))
    rows = det.select("oid", "candid", "neighbour", "forced")
    return variability.unique_neighbour_flags(rows.filter("not forced"), rows.filter("forced"), "neighbour").select("candid", "unique")


@register(
    "report_averages",
    f"""SELECT avg(precision) AS macro_precision, sum(recall * support) / sum(support) AS weighted_recall, sum(support) AS support FROM (
 SELECT coalesce(tp / nullif(said, 0), 0) AS precision, coalesce(tp / nullif(support, 0), 0) AS recall, support FROM (
 SELECT c, count(*) FILTER (truth = c) AS support, count(*) FILTER (guess = c) AS said, count(*) FILTER (truth = c AND guess = c) AS tp FROM ({PRED}), (VALUES (0), (1)) v(c) GROUP BY c))""",
    "macro_precision weighted_recall",
    longs="support",
)
def report_averages(s, d):
    return training.report_averages(training.classification_report(_predicted(s, d), "truth", "guess")).select("macro_precision", "weighted_recall", "support")


#: The names registered here.
NAMES = [n for n in QUERIES if n not in _BEFORE]
