"""Classification tables: melting, ranking, top classes, scores."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def melt_probabilities(wide: DataFrame, key: str, classes: list[str]) -> DataFrame:
    return wide.unpivot([key], classes, "class_name", "probability")


def top_class(prob: DataFrame) -> DataFrame:
    """Most probable class of each object and classifier; ties by class name."""
    best = F.min(F.struct((-F.col("probability")).alias("p"), "class_name"))
    return prob.groupBy("oid", "classifier_name").agg(best.alias("b")).select("oid", "classifier_name", F.col("b.class_name").alias("class_name"), (-F.col("b.p")).alias("probability"))


def rank_probabilities(prob: DataFrame, method: str = "row") -> DataFrame:
    """Ranking 1..n by probability: ``row`` breaks ties by class name, ``dense`` shares ranks."""
    w = Window.partitionBy("oid", "classifier_name", "classifier_version")
    rank = F.dense_rank().over(w.orderBy(F.col("probability").desc())) if method == "dense" else F.row_number().over(w.orderBy(F.col("probability").desc(), "class_name"))
    return prob.withColumn("ranking", rank)


def hierarchical_tables(name: str, top: DataFrame, children: dict[str, DataFrame]) -> DataFrame:
    out = top.withColumn("classifier_name", F.lit(f"{name}_top"))
    for child, df in children.items():
        out = out.unionByName(df.withColumn("classifier_name", F.lit(f"{name}_{child.lower()}")))
    return out


def score_rows(prob: DataFrame, detector: str, version: str) -> DataFrame:
    """One row per object with an array of (category, score)."""
    return prob.groupBy("oid").agg(F.sort_array(F.collect_list(F.struct(F.col("class_name").alias("category"), F.col("probability").alias("score")))).alias("categories")).withColumns({"detector_name": F.lit(detector), "detector_version": F.lit(version)})


def flatten_scores(scores: DataFrame) -> DataFrame:
    return scores.select("oid", "detector_name", "detector_version", F.inline("categories"))


def class_distribution(prob: DataFrame) -> DataFrame:
    return top_class(prob).groupBy("class_name").agg(F.count("*").alias("n"))


def insert_if_absent(stored: DataFrame, prob: DataFrame) -> DataFrame:
    """Rows of objects that have none of that classifier yet."""
    return prob.join(stored.select("oid", "classifier_name").distinct(), ["oid", "classifier_name"], "left_anti")


def replace_probabilities(stored: DataFrame, prob: DataFrame) -> DataFrame:
    keys = ["oid", "classifier_name", "classifier_version"]
    return stored.join(prob.select(*keys).distinct(), keys, "left_anti").unionByName(rank_probabilities(prob), allowMissingColumns=True)


def fill_not_classified(messages: DataFrame, prob: DataFrame, classes: list[str]) -> DataFrame:
    """Every object appears; those without probabilities are NotClassified = 1."""
    out = messages.select("oid").distinct().join(prob, "oid", "left")
    none = F.col(classes[0]).isNull()
    return out.withColumn("NotClassified", F.when(none, 1.0).otherwise(0.0)).withColumns({c: F.coalesce(c, F.lit(0.0)) for c in classes})


def wide_features(features: DataFrame, names: list[str]) -> DataFrame:
    """One row per object and one column per feature; the last message wins."""
    return features.groupBy("oid").pivot("name", names).agg(F.max_by("value", F.struct("candid", "value")))


def drop_bad_supernovae(prob: DataFrame, det: DataFrame) -> DataFrame:
    """Drop objects whose top class is SN and whose detection is negative or sits on a star."""
    bad = det.filter((F.col("isdiffpos") == -1) | ((F.col("sgscore1") > 0.5) & (F.col("distpsnr1") < 1))).select("oid").distinct()
    sn = top_class(prob).filter("class_name = 'SN'").select("oid").join(bad, "oid", "left_semi")
    return prob.join(sn, "oid", "left_anti")


def stamp_output(prob: DataFrame, name: str, version: str) -> DataFrame:
    """One message per object: its classes by probability, the classifier, and the time of publication in ms."""
    rows = F.sort_array(F.collect_list(F.struct((-F.col("probability")).alias("o"), "class_name", "probability")))
    out = prob.groupBy("oid").agg(F.transform(rows, lambda x: F.struct(x["class_name"].alias("class_name"), x["probability"].alias("probability"))).alias("classifications"))
    return out.withColumns({"classifier_name": F.lit(name), "classifier_version": F.lit(version), "brokerPublishTime": F.unix_millis(F.current_timestamp())})


#: Classifiers by name: how features become the model's input, and how this becomes long probabilities.
CLASSIFIERS: dict[str, tuple[Callable[[DataFrame], DataFrame], Callable[[DataFrame], DataFrame]]] = {}


def register_classifier(name: str, mapper: Callable[[DataFrame], DataFrame], predict: Callable[[DataFrame], DataFrame]) -> None:
    CLASSIFIERS[name] = (mapper, predict)


def classify(name: str, features: DataFrame) -> DataFrame:
    """Long probabilities (oid, class_name, probability) of a registered classifier, ranked."""
    mapper, predict = CLASSIFIERS[name]
    prob = predict(mapper(features)).withColumns({"classifier_name": F.lit(name)})
    return rank_probabilities(prob if "classifier_version" in prob.columns else prob.withColumn("classifier_version", F.lit("1.0")))
