"""Public records, per-alert metadata tables, watch-list values, split stores and further training tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyflow.functions.columns import band_number, mjd
from skyflow.operators.history import first_row
from skyflow.operators.ranking import hash_ranked


def metadata_tables(alerts: DataFrame) -> dict[str, DataFrame]:
    """Solar-system, data-quality, reference, bright-star and catalogue rows of each alert."""
    key = [F.col("objectId").alias("oid"), F.col("candid").cast("string").alias("candid")]
    fields = {"ss": ["ssdistnr", "ssmagnr", "ssnamenr"], "dataquality": ["fid", "rcid", "nid"], "reference": ["rfid", "rcid", "field", "magnr", "sigmagnr", "chinr", "sharpnr"], "gaia": ["neargaia", "neargaiabright", "maggaia", "maggaiabright"], "ps1": [f"{c}{k}" for k in (1, 2, 3) for c in ("objectidps", "sgmag", "srmag", "simag", "szmag", "sgscore", "distpsnr")]}
    there = set(alerts.schema["candidate"].dataType.names)
    out = {name: alerts.select(*key, *((F.col(f"candidate.{c}") if c in there else F.lit(None).cast("double")).alias(c) for c in cols)) for name, cols in fields.items()}
    for c in ("jdstartref", "jdendref"):
        if c in there:
            side = alerts.select(*key, mjd(F.col(f"candidate.{c}")).alias(c.replace("jd", "mjd")))
            out["reference"] = out["reference"].join(side, ["oid", "candid"])
    return out


def latest_stamp_detection(det: DataFrame) -> DataFrame:
    """Of each object the newest row with a stamp, new rows first; an object without any is an error."""
    best = first_row(det.filter("has_stamp"), ["oid"], F.col("new").desc(), F.col("mjd").desc(), F.col("candid"))
    lost = det.select("oid").distinct().join(best.select("oid", F.lit(True).alias("__ok")), "oid", "left")
    checked = lost.select("oid", F.when(F.col("__ok").isNull(), F.raise_error(F.concat(F.lit("no stamp for "), "oid"))).otherwise(True).alias("__ok")).filter("__ok").select("oid")
    return checked.join(best, "oid")


def public_classification(prob: DataFrame, det: DataFrame, class_ids: dict[str, int], name: str) -> DataFrame:
    """One record per object: every class id with its probability (0 where missing), and the alert it rests on."""
    ids = F.create_map(*(F.lit(x) for kv in class_ids.items() for x in kv))
    all_ids = F.array(*map(F.lit, class_ids.values()))
    own = prob.groupBy("oid").agg(F.map_from_entries(F.collect_list(F.struct(ids[F.col("class_name")].alias("id"), F.col("probability").alias("p")))).alias("m"))
    filled = F.transform(all_ids, lambda i: F.struct(i.alias("classId"), F.coalesce(F.col("m")[i], F.lit(0.0)).alias("probability")))
    return own.select("oid", filled.alias("classifications")).join(latest_stamp_detection(det).select("oid", "candid", "mjd"), "oid").withColumn("classifierName", F.lit(name))


def attach_output(features: DataFrame, prob: DataFrame) -> DataFrame:
    """Objects that have features, with nested probabilities and the top class."""
    nested = prob.groupBy("oid").agg(F.map_from_entries(F.collect_list(F.struct("class_name", "probability"))).alias("probabilities"), F.max_by("class_name", F.struct("probability", "class_name")).alias("class"))
    return features.join(nested, "oid")


def _watched_alerts(matches: DataFrame, fields: list[str]) -> DataFrame:
    cols = [band_number(F.col(c)).alias(c) if c == "fid" and dict(matches.dtypes)[c] == "string" else F.col(c) for c in fields if c in matches.columns]
    return matches.withColumn("values", F.to_json(F.struct(*cols)))


#: How the values of matches are made, by name; users add their own.
WATCHLIST_STRATEGIES: dict[str, Callable[[DataFrame, list[str]], DataFrame]] = {"alerts": _watched_alerts}


def watchlist_values(matches: DataFrame, fields: list[str] | dict[str, list[str]], strategy: str = "alerts", by: str = "filter_type") -> DataFrame:
    """The asked fields of each match as a JSON object; absent ones are left out, band letters become numbers.

    ``fields`` may depend on the match's filter, a dict by the value of column ``by``; others ask for nothing.
    """
    make = WATCHLIST_STRATEGIES[strategy]
    if not isinstance(fields, dict):
        return make(matches, fields)
    out = matches.filter(~F.coalesce(F.col(by).isin(*fields), F.lit(False))).withColumn("values", F.lit("{}"))
    for name, cols in fields.items():
        out = out.unionByName(make(matches.filter(F.col(by) == name), cols))
    return out


def merge_json(old: str, new: str):
    """Column: JSON object ``old`` updated by ``new``; numbers, booleans and nested values stay what they are."""
    kind = "map<string,variant>"
    a, b = (F.coalesce(F.from_json(F.col(c), kind), F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<variant>"))) for c in (old, new))
    return F.to_json(F.map_concat(F.map_filter(a, lambda k, _: ~F.array_contains(F.map_keys(b), k)), b))


def split_table_history(base: DataFrame, survey: DataFrame, keys: tuple[str, ...] = ("oid", "measurement_id")) -> DataFrame:
    """Base and survey-specific columns of a stored row, joined on its key pair."""
    extra = [c for c in survey.columns if c in keys or c not in base.columns]
    return base.join(survey.select(*extra), list(keys))


def patch_features(old: DataFrame, new: DataFrame, names: list[str]) -> DataFrame:
    return old.filter(~F.col("name").isin(names)).unionByName(new.filter(F.col("name").isin(names)).select(*old.columns))


def align_partitions(parts: DataFrame, present: DataFrame, key: str = "oid") -> DataFrame:
    """Partition rows of objects that are present, with dense row numbers."""
    kept = parts.join(present.select(key).distinct(), key, "left_semi")
    return kept.withColumn("row_id", F.row_number().over(Window.partitionBy("partition").orderBy(key)) - 1)


def split_metadata(features: DataFrame, metadata: list[str], names: list[str]) -> tuple[DataFrame, DataFrame]:
    """Wide per-object metadata, and wide per-horizon features, columns named feature_band."""
    named = features.withColumn("column", F.concat_ws("_", "name", "fid"))
    wide = lambda keys, cols: named.filter(F.col("column").isin(cols)).groupBy(*keys).pivot("column", cols).agg(F.first("value"))
    return wide(["oid"], metadata), wide(["oid", "horizon"], names)


def sequence_masks(seq: DataFrame) -> DataFrame:
    """Times relative to the first, and the mask of real points."""
    first = F.get("time", F.lit(0))
    return seq.withColumn("relative", F.zip_with("time", "mask", lambda t, m: F.when(m == 1, t - first).otherwise(0.0)))


def debias_positions(features: DataFrame, label: str, rare: str, most: int, dec: str = "dec", resampled: list[str] | None = None) -> DataFrame:
    """At most ``most`` southern objects of a class, chosen by hash, keep their place.

    The others go; with ``resampled`` they stay, and take these columns from the class's objects that kept theirs,
    in turn by hash, so that each of these gives about as often.
    """
    south = (F.col(label) == rare) & (F.col(dec) < 0)
    digest, tie = F.md5(F.col("oid").cast("string")), F.col("oid")
    ranked = hash_ranked(features, [F.coalesce(south, F.lit(False))], digest, tie)
    moved = F.coalesce(south, F.lit(False)) & (F.col("rank") > most)
    kept = ranked.filter(~moved).drop("rank", "size")
    if not resampled:
        return kept
    givers = hash_ranked(kept.filter(F.col(label) == rare).select("oid", *resampled), [F.lit(0)], digest, tie)
    side = givers.select((F.col("rank") - 1).alias("__k"), "size", *(F.col(c).alias(f"__{c}") for c in resampled))
    total = side.agg(F.max("size")).first()[0] or 1
    taken = hash_ranked(ranked.filter(moved).drop("rank", "size"), [F.lit(0)], digest, tie).withColumn("__k", (F.col("rank") - 1) % total).drop("rank", "size")
    out = taken.join(side.drop("size"), "__k").withColumns({c: F.col(f"__{c}") for c in resampled})
    return kept.unionByName(out.select(*kept.columns))


def pull_training_set(objects: DataFrame, processed: DataFrame, light_curves: DataFrame, catalog: DataFrame) -> DataFrame:
    """Light curves of objects processed before, with one catalogue row each."""
    wanted = objects.join(processed.select("oid").distinct(), "oid", "left_semi").select("oid")
    return light_curves.join(wanted, "oid", "left_semi").join(catalog.dropDuplicates(["oid"]), "oid", "left")


def hierarchical_forest(train: DataFrame, top: str, child: str, inputs: list[str], trees: int = 500, depth: int = 10):
    """Random forests for the top level and each branch; returns a function that scores a table with products of probabilities."""
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.feature import StringIndexer, VectorAssembler
    from pyspark.ml.functions import vector_to_array

    vec = VectorAssembler(inputCols=inputs, outputCol="__x", handleInvalid="keep")

    def fit(df: DataFrame, label: str):
        index = StringIndexer(inputCol=label, outputCol="__y", stringOrderType="alphabetAsc").fit(df)
        counts = df.groupBy(label).count().collect()  # one row a class
        least = min(r["count"] for r in counts)
        balanced = index.transform(vec.transform(df)).sampleBy(label, {r[label]: min(1.0, least / r["count"]) for r in counts}, seed=1)
        model = RandomForestClassifier(labelCol="__y", featuresCol="__x", numTrees=trees, maxDepth=depth, seed=1).fit(balanced)
        return index.labels, model

    def score(df: DataFrame, fitted, prefix: str) -> DataFrame:
        labels, model = fitted
        out = model.setProbabilityCol("__p").setRawPredictionCol("__r").setPredictionCol("__k").transform(df)
        return out.withColumns({f"{prefix}{x}": vector_to_array("__p")[i] for i, x in enumerate(labels)}).drop("__p", "__r", "__k")

    branches = [r[top] for r in train.select(top).distinct().collect()]  # the classes of the top level
    upper = fit(train, top)
    lower = {}
    for b in branches:
        part = train.filter(F.col(top) == b)
        kinds = [r[child] for r in part.select(child).distinct().limit(2).collect()]
        lower[b] = fit(part, child) if len(kinds) > 1 else (kinds, None)

    def predict(df: DataFrame) -> DataFrame:
        out = score(vec.transform(df), upper, "__top_")
        names = []
        for b, (labels, model) in lower.items():
            if model is None:
                out = out.withColumn(labels[0], F.col(f"__top_{b}"))
            else:
                out = score(out, (labels, model), "__c_")
                out = out.withColumns({x: F.col(f"__c_{x}") * F.col(f"__top_{b}") for x in labels}).drop(*(f"__c_{x}" for x in labels))
            names += labels
        return out.drop("__x", *(f"__top_{b}" for b in branches))

    return predict
