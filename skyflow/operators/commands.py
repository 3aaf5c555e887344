"""Commands applied to stored tables: one function a kind, all of them keyed, so a replayed batch changes nothing.

A command table has ``kind``, ``criteria`` and ``data`` (maps of strings; nested values are JSON) and
``seq``, its place in the stream: of several commands for one key the last wins.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyflow.operators.merge import KEYS, one_a_key

Tables = dict[str, DataFrame]

#: Columns that statistics may set, band numbers of commands and features, and renamed magnitudes.
OBJECT_COLUMNS = (
    "ndethist ncovhist mjdstarthist mjdendhist corrected stellar ndet g_r_max g_r_max_corr g_r_mean g_r_mean_corr meanra meandec sigmara sigmadec deltajd firstmjd lastmjd step_id_corr diffpos"
).split()
BAND_NUMBERS = {"g": 1, "r": 2, "i": 3}
FEATURE_BANDS = {"": 0, "g": 1, "r": 2, "gr": 12, "rg": 12}
RENAMED = {"magpsf": "mag", "sigmapsf": "e_mag", "magpsf_corr": "mag_corr", "sigmapsf_corr": "e_mag_corr", "sigmapsf_corr_ext": "e_mag_corr_ext"}
DETECTION_EXTRA = "nid magap sigmagap rfid diffmaglim distnr magapbig rb rbversion sigmagapbig drb drbversion".split()
FORCED_DROPPED = "brokerIngestTimestamp surveyPublishTimestamp parent_candid forcediffimfluxunc".split()
HISTORY = "ndethist ncovhist mjdstarthist mjdendhist".split()


def _number(band: Column, numbers: dict[str, int]) -> Column:
    out = F.try_to_number(band, F.lit("99")).cast("int")
    for name, k in numbers.items():
        out = F.when(band == name, k).otherwise(out)
    return out


def object_of() -> Column:
    """The object that a command is about."""
    return F.coalesce(F.col("criteria")["oid"], F.col("criteria")["_id"])


def _given(name: str) -> Column:
    return F.coalesce(F.col("data")[name], F.col("criteria")[name])


def _typed(cmds: DataFrame, target: DataFrame, **special: Column) -> DataFrame:
    """Rows with the target's columns, read from data and criteria, and ``seq``."""
    own = {c: special.get(c, object_of() if c == "oid" else _given(c)) for c in target.columns}
    return cmds.select(*(own[f.name].cast(f.dataType).alias(f.name) for f in target.schema), "seq")


def set_columns(target: DataFrame, new: DataFrame, keys: list[str], columns: list[str], insert: bool = True, order: str = "seq") -> DataFrame:
    """Stored rows take ``columns`` of the last new row of their key; other keys are inserted whole, or ignored.

    Both tables are read once, in one join, so a table that does not come out the same twice still has each key once.
    """
    last = one_a_key(new, keys, order).drop(order)
    given = [c for c in dict.fromkeys([*(last.columns if insert else []), *columns]) if c not in keys]
    side = last.select(*keys, F.lit(True).alias("__hit"), *(F.col(c).alias(f"__{c}") for c in given))
    out = target.withColumn("__stored", F.lit(True)).join(side, keys, "full" if insert else "left")
    stored = F.col("__stored").isNotNull()

    def value(c: str) -> Column:
        if c in keys:
            return F.col(c)
        kept, taken = F.col(c) if c in target.columns else F.lit(None), F.col(f"__{c}") if c in given else F.lit(None)
        return F.when(stored & (F.col("__hit").isNull() | F.lit(c not in columns or c not in target.columns)), kept).otherwise(taken).alias(c)

    added = [c for c in last.columns if c not in target.columns] if insert else []
    return out.select(*(value(c) for c in [*target.columns, *added]))


def replace_rows(target: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    return set_columns(target, new, keys, [c for c in target.columns if c not in keys])


def insert_object(tables: Tables, cmds: DataFrame) -> Tables:
    new = one_a_key(_typed(cmds, tables["object"]), KEYS["object"], "seq").drop("seq")
    return {"object": tables["object"].unionByName(new.join(tables["object"].select("oid"), "oid", "left_anti"))}


def update_object_from_stats(tables: Tables, cmds: DataFrame, allowed: list[str] = OBJECT_COLUMNS) -> Tables:
    """Only listed columns that a command names are set; objects not stored are ignored."""
    target = tables["object"]
    columns = [c for c in allowed if c in target.columns]
    last = one_a_key(_typed(cmds, target), ["oid"], "seq").select("oid", *(F.col(c).alias(f"__{c}") for c in columns))
    return {"object": target.join(last, "oid", "left").withColumns({c: F.coalesce(f"__{c}", c) for c in columns}).select(*target.columns)}


def upsert_detections(tables: Tables, cmds: DataFrame) -> Tables:
    target, extra = tables["detection"], F.from_json(F.col("data")["extra_fields"], "map<string,string>")
    special = {new: _given(old) for new, old in RENAMED.items()} | {c: F.coalesce(extra[c], _given(c)) for c in DETECTION_EXTRA}
    parent = _given("parent_candid")
    special |= {"fid": _number(_given("fid"), BAND_NUMBERS), "parent_candid": F.when(~parent.isin("None", ""), parent)}
    return {"detection": replace_rows(target, _typed(cmds, target, **special), KEYS["detection"])}


def upsert_forced(tables: Tables, cmds: DataFrame) -> Tables:
    target, extra = tables["forced_photometry"], F.from_json(F.col("data")["extra_fields"], "map<string,string>")
    special = {c: F.coalesce(extra[c], _given(c)) for c in target.columns if c not in ("oid", "pid", "fid", *FORCED_DROPPED)}
    return {"forced_photometry": replace_rows(target, _typed(cmds, target, fid=_number(_given("fid"), BAND_NUMBERS), **special), KEYS["forced_photometry"])}


def upsert_object_stats(tables: Tables, cmds: DataFrame) -> Tables:
    """Object columns are set where the object is stored; its rows by band are replaced."""
    out = update_object_from_stats(tables, cmds, [c for c in tables["object"].columns if c != "oid"])
    target = tables["magstats"]
    rows = cmds.select("seq", "criteria", F.explode(F.from_json(F.col("data")["magstats"], "array<map<string,string>>")).alias("data"))
    new = _typed(rows, target, fid=_number(F.col("data")["fid"], BAND_NUMBERS), stellar=F.coalesce(F.col("data")["stellar"], F.lit("false")))
    return out | {"magstats": replace_rows(target, new, KEYS["magstats"])}


def upsert_non_detections(tables: Tables, cmds: DataFrame) -> Tables:
    target = tables["non_detection"]
    return {"non_detection": set_columns(target, _typed(cmds, target, fid=_number(_given("fid"), BAND_NUMBERS)), KEYS["non_detection"], ["diffmaglim"])}


def upsert_features(tables: Tables, cmds: DataFrame) -> Tables:
    target = tables["feature"]
    parsed = F.from_json(F.col("data")["features"], "array<struct<name: string, fid: string, value: double>>")
    rows = cmds.select("seq", object_of().alias("oid"), F.col("data")["features_version"].alias("version"), F.inline(parsed))
    new = rows.withColumn("fid", _number(F.coalesce("fid", F.lit("")), FEATURE_BANDS))
    return {"feature": set_columns(target, new.select(*target.columns, "seq"), KEYS["feature"], ["value"])}


def upsert_probabilities(tables: Tables, cmds: DataFrame) -> Tables:
    """Every other entry of the data is a class; ranks go by probability, then by name."""
    target = tables["probability"]
    classes = F.map_filter("data", lambda k, _: ~k.isin("classifier_name", "classifier_version"))
    head = [object_of().alias("oid"), F.col("data")["classifier_name"].alias("classifier_name"), F.col("data")["classifier_version"].alias("classifier_version")]
    rows = cmds.select("seq", *head, F.explode(classes).alias("class_name", "probability")).withColumn("probability", F.col("probability").cast("double"))
    w = Window.partitionBy("seq", "oid", "classifier_name", "classifier_version").orderBy(F.col("probability").desc(), "class_name")
    new = rows.withColumn("ranking", F.row_number().over(w))
    return {"probability": set_columns(target, new.select(*target.columns, "seq"), KEYS["probability"], ["ranking", "probability"])}


def upsert_xmatch(tables: Tables, cmds: DataFrame) -> Tables:
    target = tables["xmatch"]
    found = F.from_json(F.col("data")["xmatch"], "map<string, struct<catoid: string, dist: double>>")
    rows = cmds.select("seq", object_of().alias("oid"), F.explode(found).alias("catid", "m"))
    new = rows.select("oid", "catid", F.col("m.catoid").alias("oid_catalog"), F.col("m.dist").alias("dist"), "seq")
    return {"xmatch": set_columns(target, new, KEYS["xmatch"], ["oid_catalog", "dist"])}


def upsert_score(tables: Tables, cmds: DataFrame) -> Tables:
    target = tables["score"]
    parsed = F.from_json(F.col("data")["categories"], "array<struct<name: string, score: double>>")
    rows = cmds.select("seq", object_of().alias("oid"), F.col("data")["detector_name"].alias("detector_name"), F.col("data")["detector_version"].alias("detector_version"), F.inline(parsed))
    return {"score": set_columns(target, rows.withColumnRenamed("name", "category_name").select(*target.columns, "seq"), KEYS["score"], ["score"])}


KINDS: dict[str, Callable[[Tables, DataFrame], Tables]] = {
    f.__name__: f
    for f in (insert_object, update_object_from_stats, upsert_detections, upsert_forced, upsert_object_stats, upsert_features, upsert_non_detections, upsert_probabilities, upsert_xmatch, upsert_score)
}


def apply_commands(tables: Tables, cmds: DataFrame, kinds: list[str] | None = None) -> Tables:
    """The tables after all valid commands, kind by kind; invalid ones change nothing (see ``rejected``)."""
    out = dict(tables)
    for kind in kinds or KINDS:
        out |= KINDS[kind](out, cmds.filter((F.col("kind") == kind) & F.col("valid")))
    return out


def rejected(cmds: DataFrame) -> DataFrame:
    """How many commands each unknown or incomplete form had; they are skipped, not fatal."""
    return cmds.filter(~F.col("valid")).groupBy(F.col("cmd.type").alias("type"), F.col("cmd.collection").alias("collection")).agg(F.count("*").alias("n"))


# --- objects at first sight, and metadata -------------------------------------------


def upsert_seen_objects(target: DataFrame, seen: DataFrame, order: str = "mjd") -> DataFrame:
    """Objects seen first are inserted with their position and time; of known ones only the history counters change."""
    new = seen.select(
        "oid", "ndethist", "ncovhist", (F.col("jdstarthist") - 2400000.5).alias("mjdstarthist"), (F.col("jdendhist") - 2400000.5).alias("mjdendhist"), F.col("ra").alias("meanra"), F.col("dec").alias("meandec"),
        F.col("mjd").alias("firstmjd"), F.col("mjd").alias("lastmjd"), F.lit(0.0).alias("deltajd"), F.col(order).alias("seq"),
    )
    return set_columns(target, new, ["oid"], HISTORY)


def close_neighbours(alerts: DataFrame, stored: DataFrame, columns: list[str], names: list[str], every: bool = False, tolerance: float = 1e-3) -> tuple[DataFrame, DataFrame]:
    """(alerts with the flags ``names``, stored rows with theirs): false where a stored row of the object is close.

    Each column has its flag; with ``every`` the one flag asks that all columns are close.
    """
    near = [F.abs(F.col(f"__{c}") - F.col(c)) <= tolerance + tolerance * F.abs(F.col(c)) for c in columns]
    if every:
        both = near[0]
        for x in near[1:]:
            both &= x
        near = [both]
    pairs = alerts.select("oid", "candid", *columns).join(stored.select("oid", F.col("candid").alias("__candid"), *(F.col(c).alias(f"__{c}") for c in columns)), "oid")
    hit = pairs.select("oid", "candid", "__candid", *(F.coalesce(x, F.lit(False)).alias(n) for x, n in zip(near, names)))
    new = hit.groupBy("oid", "candid").agg(*(F.max(n).alias(f"__{n}") for n in names))
    old = hit.groupBy("oid", F.col("__candid").alias("candid")).agg(*(F.max(n).alias(f"__{n}") for n in names))
    flagged = lambda df, side, base: df.join(side, ["oid", "candid"], "left").withColumns({n: base(n) & ~F.coalesce(f"__{n}", F.lit(False)) for n in names}).drop(*(f"__{n}" for n in names))
    return flagged(alerts, new, lambda n: F.lit(True)), flagged(stored, old, lambda n: F.coalesce(n, F.lit(True)) if n in stored.columns else F.lit(True))


#: Key columns of the metadata tables.
METADATA_KEYS = {"ss": ["candid"], "dataquality": ["candid"], "reference": ["oid", "rfid"], "gaia": ["oid"], "ps1": ["candid"]}


def upsert_metadata(tables: Tables, new: Tables) -> Tables:
    """Solar-system, quality and reference rows keep the first; of gaia only unique1 changes; ps1 has one row a
    candid, and stored rows near a new one lose their flag."""
    out = {}
    for name in ("ss", "dataquality", "reference"):
        keys = METADATA_KEYS[name]
        out[name] = tables[name].unionByName(one_a_key(new[name], keys).join(tables[name].select(*keys), keys, "left_anti"), allowMissingColumns=True)
    first = one_a_key(tables["gaia"], ["oid"])
    gaia, _ = close_neighbours(new["gaia"], first, ["maggaia", "maggaiabright"], ["unique1"], every=True)
    out["gaia"] = set_columns(tables["gaia"], gaia.withColumn("seq", F.col("candid")), ["oid"], ["unique1"])
    ps1, stored = close_neighbours(new["ps1"], tables["ps1"], [f"objectidps{k}" for k in (1, 2, 3)], [f"unique{k}" for k in (1, 2, 3)])
    out["ps1"] = stored.unionByName(one_a_key(ps1, ["candid"]).join(stored.select("candid"), "candid", "left_anti"), allowMissingColumns=True)
    return out


# --- documents ----------------------------------------------------------------------


def document_insert(target: DataFrame, new: DataFrame) -> DataFrame:
    return target.unionByName(new, allowMissingColumns=True)


def document_update(target: DataFrame, new: DataFrame, keys: list[str], upsert: bool = False, set_on_insert: bool = False, order: str = "seq") -> DataFrame:
    """Set the columns of ``new`` where the criteria match; with ``set_on_insert`` only documents not there yet take them."""
    columns = [c for c in new.columns if c not in keys and c != order]
    if not set_on_insert:
        return set_columns(target, new, keys, columns, insert=upsert, order=order)
    fresh = one_a_key(new, keys, order).drop(order).join(target.select(*keys), keys, "left_anti")
    return target.unionByName(fresh, allowMissingColumns=True) if upsert else target


def _element_merge(target: DataFrame, new: DataFrame, array: str, name: str, upsert: bool, set_on_insert: bool) -> DataFrame:
    """``new`` has _id and ``__elements``, an array of elements with distinct ``name``: each replaces its namesake or is pushed."""
    kind = new.schema["__elements"].dataType
    none = F.array().cast(kind)
    there = F.coalesce(F.col(array), none) if array in target.columns else none
    base = target.withColumn("__old", there).drop(array).join(new, "_id", "full" if upsert else "left")
    old, fresh = F.coalesce("__old", none), F.coalesce("__elements", none)
    known = lambda side: F.transform(side, lambda x: x[name])
    if set_on_insert:
        merged = F.concat(old, F.filter(fresh, lambda x: ~F.array_contains(known(old), x[name])))
    else:
        merged = F.concat(F.filter(old, lambda x: ~F.array_contains(known(fresh), x[name])), fresh)
    return base.withColumn(array, merged).drop("__old", "__elements")


def document_probabilities(target: DataFrame, prob: DataFrame, upsert: bool = True, set_on_insert: bool = False) -> DataFrame:
    """One nested element for each classifier: version, rank-1 class with its probability, and all values by rank."""
    w = Window.partitionBy("oid", "classifier_name").orderBy(F.col("probability").desc(), "class_name")
    ranked = prob.withColumn("ranking", F.row_number().over(w))
    values = F.sort_array(F.collect_list(F.struct("ranking", "class_name", "probability")))
    by = ranked.groupBy("oid", "classifier_name").agg(F.max("classifier_version").alias("version"), values.alias("v"))
    shaped = F.transform("v", lambda x: F.struct(x["class_name"].alias("class_name"), x["probability"].alias("probability"), x["ranking"].alias("ranking")))
    element = F.struct("classifier_name", "version", F.col("v")[0]["class_name"].alias("class_rank_1"), F.col("v")[0]["probability"].alias("probability_rank_1"), shaped.alias("values"))
    new = by.groupBy(F.col("oid").alias("_id")).agg(F.sort_array(F.collect_list(element)).alias("__elements"))
    return _element_merge(target, new, "probabilities", "classifier_name", upsert, set_on_insert)


def document_features(target: DataFrame, features: DataFrame, upsert: bool = True, set_on_insert: bool = False) -> DataFrame:
    """One nested element for each feature group (``survey``): version and its features (name, fid, value)."""
    own = F.sort_array(F.collect_list(F.struct("name", "fid", "value"))).alias("features")
    by = features.groupBy("oid", "survey").agg(F.max("version").alias("version"), own)
    new = by.groupBy(F.col("oid").alias("_id")).agg(F.sort_array(F.collect_list(F.struct("survey", "version", "features"))).alias("__elements"))
    return _element_merge(target, new, "features", "survey", upsert, set_on_insert)


# --- watch-list matches -------------------------------------------------------------

MATCH_KEYS = ["oid", "candid", "target_id"]


def insert_matches(target: DataFrame, matches: DataFrame) -> DataFrame:
    """New (oid, candid, target) rows, not ready, without values; known ones stay."""
    new = one_a_key(matches.select(*MATCH_KEYS), MATCH_KEYS).withColumns({"values": F.lit("{}"), "ready_to_notify": F.lit(False)})
    return target.unionByName(new.join(target.select(*MATCH_KEYS), MATCH_KEYS, "left_anti"), allowMissingColumns=True)


def update_match_values(target: DataFrame, values: DataFrame) -> DataFrame:
    """The stored JSON object updated by the new one (``values``)."""
    from skyflow.operators.outputs import merge_json

    side = values.select(*MATCH_KEYS, F.col("values").alias("__new"))
    out = target.join(side, MATCH_KEYS, "left").withColumn("__merged", merge_json("values", "__new"))
    return out.withColumn("values", F.when(F.col("__new").isNotNull(), F.col("__merged")).otherwise(F.col("values"))).select(*target.columns)


def mark_notify(target: DataFrame, ready: DataFrame) -> DataFrame:
    side = ready.select(*MATCH_KEYS).distinct().withColumn("__hit", F.lit(True))
    out = target.join(side, MATCH_KEYS, "left")
    return out.withColumn("ready_to_notify", F.col("ready_to_notify") | F.coalesce("__hit", F.lit(False))).select(*target.columns)
