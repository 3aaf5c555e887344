"""Sources and sinks: alert files, topics, archives."""

from __future__ import annotations

import json
import tempfile
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from skyflow.sources.avro import read_containers


def struct_of(spark: SparkSession, schema: StructType | str | None) -> StructType | None:
    return spark.createDataFrame([], schema).schema if isinstance(schema, str) else schema


def shared_folder(spark: SparkSession, label: str) -> str:
    """A new name in the folder that driver and executors share, ``spark.checkpoint.dir``; in local mode a temporary one where the session names none."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="spark-")
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def read_alert_dir(spark: SparkSession, path: str, fmt: str = "avro", schema: StructType | str | None = None) -> DataFrame:
    """All files of a folder. ``avro`` takes containers by ``sources.avro``; another name of Spark's own package may be given."""
    if fmt == "avro":
        return read_containers(spark, path, struct_of(spark, schema))
    r = spark.read.format(fmt)
    return (r.schema(schema) if schema else r).load(path)


def replay_alert_dir(spark: SparkSession, path: str, schema: StructType | str, fmt: str = "parquet", files_per_batch: int = 1) -> DataFrame:
    """A stream of a folder's files in batches of some files each; ``avro`` as in ``read_alert_dir``."""
    if fmt == "avro":
        return read_containers(spark, path, struct_of(spark, schema), stream=True, maxFilesPerTrigger=str(files_per_batch))
    return spark.readStream.format(fmt).schema(schema).option("maxFilesPerTrigger", files_per_batch).load(path)


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None, **options) -> DataFrame:
    r = spark.read.options(**({"header": True} | options))
    return (r.schema(schema) if schema else r.option("inferSchema", True)).csv(path)


def read_json_array(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    r = spark.read.option("multiLine", True)
    return (r.schema(schema) if schema else r).json(path)


def read_topic(spark: SparkSession, servers: str, topics: str, stream: bool = True, max_messages: int | None = None, min_messages: int | None = None, max_delay: str | None = None, start_ms: int | None = None, end_ms: int | None = None, pattern: bool = False, **options) -> DataFrame:
    """Kafka rows with key, value, topic and timestamp; bounded by messages per trigger and by start and end times.

    With ``min_messages`` a batch waits for so many, or for ``max_delay`` (such as 10s) since the one before it, the earlier of both.
    """
    r = (spark.readStream if stream else spark.read).format("kafka").option("kafka.bootstrap.servers", servers).option("subscribePattern" if pattern else "subscribe", topics)
    waits = (("minOffsetsPerTrigger", min_messages if stream else None), ("maxTriggerDelay", max_delay if stream else None))
    for k, v in (*waits, ("maxOffsetsPerTrigger", max_messages), ("startingTimestamp", start_ms), ("endingTimestamp", None if stream else end_ms)):
        if v is not None:
            r = r.option(k, v)
    return r.options(**options).load()


def decode_value(df: DataFrame, schema: str, fmt: str = "json") -> DataFrame:
    """Columns of the decoded ``value`` beside topic and timestamp; undecodable values give nulls."""
    if fmt == "json":
        value = F.from_json(F.col("value").cast("string"), schema)
    else:
        from pyspark.sql.avro.functions import from_avro

        value = from_avro("value", schema)
    return df.withColumn("__v", value).select(*(c for c in ("topic", "timestamp") if c in df.columns), "__v.*")


def encode_value(df: DataFrame, schema: str | None = None, strict: bool = False) -> DataFrame:
    """One ``value`` column: JSON, or Avro (without container) where a schema is given.

    ``strict`` asks that the rows have exactly the schema's fields; else missing ones are null and others left out.
    """
    if schema is None:
        return df.select(F.to_json(F.struct(*df.columns)).alias("value"))
    from pyspark.sql.avro.functions import to_avro

    names = [f["name"] for f in json.loads(schema)["fields"]]
    if strict and set(names) != set(df.columns):
        raise ValueError(f"fields differ from the schema: {sorted(set(names) ^ set(df.columns))}")
    row = F.struct(*(F.col(n) if n in df.columns else F.lit(None).alias(n) for n in names))
    return df.select(to_avro(row, schema).alias("value"))


def mirror_topic(records: DataFrame, keep_timestamp: bool = True, keep_topic: bool = True, topic: str | None = None) -> DataFrame:
    """Raw records for another cluster: key and value as they are, with their topic and time or a new topic and none."""
    head = [F.col("topic") if keep_topic else F.lit(topic).alias("topic")]
    return records.select("key", "value", *head, *(["timestamp"] if keep_timestamp else []))


def write_metrics(metrics: DataFrame, path: str | None = None, servers: str | None = None, topic: str = "metrics") -> None:
    """Metric rows as JSON, appended to text files or sent to a topic."""
    rows = metrics.select(F.to_json(F.struct(*metrics.columns)).alias("value"))
    if path:
        rows.write.mode("append").text(path)
    if servers:
        rows.withColumn("topic", F.lit(topic)).write.format("kafka").option("kafka.bootstrap.servers", servers).save()


#: Sources and sinks by name, as configuration names them; users add their own.
SOURCES: dict[str, Callable[..., DataFrame]] = {}
SINKS: dict[str, Callable[..., None]] = {}


def from_config(spark: SparkSession, config: dict) -> DataFrame:
    """Read as a configuration says: ``kind`` is a registered name, else a format of Spark's; the rest are options."""
    options = {k: v for k, v in config.items() if k not in ("kind", "path", "stream")}
    if config["kind"] in SOURCES:
        return SOURCES[config["kind"]](spark, path=config.get("path"), **options)
    r = spark.readStream if config.get("stream") else spark.read
    return r.format(config["kind"]).options(**options).load(config.get("path"))


def to_config(df: DataFrame, config: dict) -> None:
    options = {k: v for k, v in config.items() if k not in ("kind", "path", "mode")}
    if config["kind"] in SINKS:
        return SINKS[config["kind"]](df, path=config.get("path"), **options)
    df.write.format(config["kind"]).mode(config.get("mode", "append")).options(**options).save(config.get("path"))


def keyed_records(df: DataFrame, key: str, topics: Sequence[str]) -> DataFrame:
    """(key, value, topic) rows for one or several topics; integer keys become strings."""
    return df.select(F.col(key).cast("string").alias("key"), F.to_json(F.struct(*df.columns)).alias("value"), F.explode(F.array(*map(F.lit, topics))).alias("topic"))


def write_topic(df: DataFrame, servers: str, key: str, topics: Sequence[str]) -> None:
    keyed_records(df, key, topics).write.format("kafka").option("kafka.bootstrap.servers", servers).save()


def daily_topics(spark: SparkSession, template: str, now: str, change_hour: int, days: int) -> DataFrame:
    """Topic names of the last ``days`` UTC days; after the change hour tomorrow's too. ``template`` has one %s."""
    t = F.to_timestamp(F.lit(now))
    last = F.date_add(F.to_date(t), F.when(F.hour(t) >= change_hour, 1).otherwise(0))
    days_col = F.explode(F.sequence(F.date_sub(F.to_date(t), days - 1), last)).alias("day")
    return spark.range(1).select(days_col).select("day", F.format_string(template, F.date_format("day", "yyyyMMdd")).alias("topic"))


def topic_pattern(template: str) -> str:
    """A pattern for ``read_topic(pattern=True)`` that takes every daily topic, so a new day is joined when it appears."""
    return template.replace(".", r"\.").replace("%s", "[0-9]{8}")


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("append").option("header", False).csv(path)


def write_json(df: DataFrame, path: str, buffer_size: int) -> None:
    df.write.mode("append").option("maxRecordsPerFile", buffer_size).json(path)


def archive_alerts(df: DataFrame, root: str, jd: str = "jd", fmt: str = "parquet", survey: str | None = None) -> None:
    """Alerts by calendar date of their Julian day, compressed with snappy.

    Folders are date=2024-01-31 of Spark's own layout; with ``survey`` each date is a folder survey_20240131, one
    write a date of the batch.
    """
    date = F.to_date(F.timestamp_seconds((F.col(jd) - 2440587.5) * 86400))
    rows = df.withColumn("date", date)
    if survey is None:
        rows.write.mode("append").partitionBy("date").option("compression", "snappy").format(fmt).save(root)
        return
    for r in rows.select("date").distinct().collect():  # the few nights of a batch
        day = rows.filter(F.col("date").eqNullSafe(F.lit(r["date"]))).drop("date")
        day.write.mode("append").option("compression", "snappy").format(fmt).save(f"{root}/{survey}_{r['date']:%Y%m%d}")


def compact_archive(spark: SparkSession, path: str, out: str, files: int, per_part: int = 2200, fmt: str = "parquet") -> None:
    spark.read.format(fmt).load(path).repartition(max(1, -(-files // per_part))).write.format(fmt).save(out)


def stamp_objects(df: DataFrame, buckets: dict[str, str], topic: str = "topic", candid: str = "candid") -> DataFrame:
    """Storage key and bucket of each stamp; a topic without a bucket is an error."""
    from skyflow.functions.columns import object_key

    bucket: Column = F.raise_error(F.concat(F.lit("no bucket for topic "), topic))
    for prefix, name in buckets.items():
        bucket = F.when(F.col(topic).startswith(prefix), F.lit(name)).otherwise(bucket)
    return df.withColumn("key", object_key(F.col(candid))).withColumn("bucket", bucket)
