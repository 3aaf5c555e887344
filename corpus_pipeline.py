"""The corpus job: toxicity, line dedup, n-gram Jaccard join, benchmark decontamination, packing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyflow.llm import decontaminate, jaccard_join, line_dedup, packing, toxicity
from skyflow.llm.common import materialize, text_of

#: Ids up to which a list of rejected documents is broadcast; longer lists are joined by shuffle.
BROADCAST_IDS = 1_000_000


def _key(docs: DataFrame) -> Column:
    """A row is known by its id and its text's hash: ids may be null or repeat, and such rows are judged apart."""
    return F.struct(docs["doc_id"].alias("id"), F.xxhash64(text_of(docs)).alias("hash"))


def _without(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """The documents whose key is not in the column ``__doc_key`` of ``keys``."""
    keys = materialize(keys.select("__doc_key").distinct(), "stage-keys")
    side = F.broadcast(keys) if keys.count() <= BROADCAST_IDS else keys
    return docs.withColumn("__doc_key", _key(docs)).join(side, "__doc_key", "left_anti").select(*docs.columns)


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    scores = toxicity.toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return _without(docs, scores.filter("predicted = 1").select(F.struct(F.col("doc_id").alias("id"), F.col("text_hash").alias("hash")).alias("__doc_key")))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rewrites texts and their n_chars; documents stay, even when every line is a repeat."""
    out = line_dedup.line_dedup(docs).select(*docs.columns)
    if "n_chars" not in docs.columns:
        return out
    n_chars = F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.char_length("text").cast("long"))
    return out.withColumn("n_chars", n_chars)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each component stays, null first; of rows equal in id and text one."""
    groups = materialize(jaccard_join.jaccard_components(docs.withColumn("__doc_key", _key(docs)), id_col="__doc_key"), "stage-components")
    kept = _without(docs, groups.filter("__doc_key <> component_id"))
    again = groups.filter("n_shingles > 0 and __doc_key = component_id").groupBy("__doc_key").agg(F.count("*").alias("rows")).filter("rows > 1").select("__doc_key")
    again = materialize(again, "stage-repeats")
    n = again.count()
    if not n:
        return kept
    keyed = kept.withColumn("__doc_key", _key(kept))
    side = F.broadcast(again) if n <= BROADCAST_IDS else again
    repeats = keyed.join(side, "__doc_key", "left_semi").dropDuplicates(["__doc_key"])
    return keyed.join(side, "__doc_key", "left_anti").unionByName(repeats).select(*docs.columns)


def reject_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    keyed = docs.withColumn("__doc_key", _key(docs))
    return _without(docs, decontaminate.contained_items(keyed, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), id_col="__doc_key"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("toxicity", reject_toxic),
    ("line dedup", drop_repeated_lines),
    ("n-gram Jaccard join", keep_one_of_near_copies),
    ("benchmark decontamination", reject_benchmark),
    ("packing", pack),
]

#: The toxicity and packing stages have no SQL form; tests/llm/test_pipeline.py holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
