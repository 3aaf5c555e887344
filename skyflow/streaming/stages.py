"""Streaming stages: one foreachBatch query with a checkpoint, idempotent writes behind it."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from skyflow.operators import correct, history, stats
from skyflow.operators.commands import KINDS, object_of, rejected
from skyflow.operators.merge import KeyedTable, parse_commands
from skyflow.sources.readers import read_topic, topic_pattern
from skyflow.streaming.state import object_state

Frame = Callable[[DataFrame], DataFrame]

#: Tables that each kind of command writes.
TABLES_OF = {
    "insert_object": ["object"], "update_object_from_stats": ["object"], "upsert_detections": ["detection"], "upsert_forced": ["forced_photometry"], "upsert_object_stats": ["object", "magstats"],
    "upsert_non_detections": ["non_detection"], "upsert_features": ["feature"], "upsert_probabilities": ["probability"], "upsert_xmatch": ["xmatch"], "upsert_score": ["score"],
}


def run_stage(stream: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, pre: Frame | None = None, execute: Frame | None = None, post: Frame | None = None, available_now: bool = True, every: str = "30 seconds", mode: str = "append") -> StreamingQuery:
    """Consume, pre, execute, post, produce, commit. Empty batches are skipped; an exception stops the stage; offsets are committed after the sink.

    A batch is read once, whatever its steps do with it, so metrics that ``metrics.observed`` adds to the stream count each row once.
    """

    def once(df: DataFrame, number: int) -> None:
        df = df.persist()
        try:
            batch(df, number)
        finally:
            df.unpersist()

    def batch(df: DataFrame, number: int) -> None:
        if df.isEmpty():
            return
        for step in (pre, execute, post):
            df = step(df) if step else df
        sink(df, number)

    w = stream.writeStream.outputMode(mode).foreachBatch(once).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime=every)).start()


def fan_out(*sinks: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """One batch to several sinks, computed once."""

    def sink(df: DataFrame, number: int) -> None:
        df = df.persist()
        try:
            for s in sinks:
                s(df, number)
        finally:
            df.unpersist()

    return sink


def metric_columns(df: DataFrame, fields: dict[str, str] | list[dict] | None) -> list[Column]:
    """An array column for each field of ``batch_metrics``."""
    fields = [{"key": k, "alias": v} for k, v in fields.items()] if isinstance(fields, dict) else fields or []
    extra = []
    for f in fields:
        c = F.col(f["key"]) if f["key"].split(".")[0] in df.columns else F.lit(None)
        c = f["format"](c) if f.get("format") else c
        c = F.coalesce(c.cast("string"), F.lit(f["default"]).cast("string")) if "default" in f else c.cast("string")
        extra.append(F.collect_list(c).alias(f.get("alias", f["key"])))
    return extra


def batch_metrics(df: DataFrame, number: int, fields: dict[str, str] | list[dict] | None = None, received: float | None = None, sent: float | None = None) -> DataFrame:
    """One row: batch number, received and sent time with the seconds between, messages, and arrays of chosen fields.

    A field is a name with its alias, or a dict of ``key`` (dots go into nested rows), ``alias``, ``format`` (a
    function of the column) and ``default`` for nulls.
    """
    extra = metric_columns(df, fields)
    now = time.time()
    received, sent = now if received is None else received, now if sent is None else sent
    times = [F.timestamp_seconds(F.lit(x)).alias(n) for n, x in (("timestamp_received", received), ("timestamp_sent", sent))]
    return df.agg(F.lit(number).alias("batch"), *times, F.lit(sent - received).alias("execution_time"), F.count("*").alias("n_messages"), *extra)


def topic_stage(spark: SparkSession, servers: str, template: str, sink: Callable[[DataFrame, int], None], checkpoint: str, max_messages: int = 1000, every: str = "1 second", max_delay: str = "30s", **parts: Frame) -> StreamingQuery:
    """A stage over daily topics that rolls over by itself; a batch ends at ``max_messages`` or ``max_delay`` after the one before it."""
    stream = read_topic(spark, servers, topic_pattern(template), max_messages=max_messages, min_messages=max_messages, max_delay=max_delay, pattern=True)
    return run_stage(stream, sink, checkpoint, available_now=False, every=every, **parts)


def bounded_replay(spark: SparkSession, servers: str, topics: str, start_ms: int | None = None, end_ms: int | None = None) -> DataFrame:
    """All records between two times, as a batch; it ends at the ends of the partitions or at the given time."""
    return read_topic(spark, servers, topics, stream=False, start_ms=start_ms, end_ms=end_ms)


def command_stage(tables: dict[str, KeyedTable], metrics: Callable[[DataFrame], None] | None = None) -> Callable[[DataFrame, int], None]:
    """Apply a batch of JSON commands (column ``payload``, ordered by ``seq``) to stored tables.

    Kinds go in the order of ``KINDS``, so an object inserted and updated in one batch is both. Of tables that are
    partitioned by object only the partitions of the commands' objects are read and rewritten. A table never written
    needs a schema. Invalid commands are skipped and counted; anything else that fails stops the stage.
    """

    def sink(batch: DataFrame, number: int) -> None:
        cmds = parse_commands(batch).select("kind", "valid", "cmd", "cmd.criteria", "cmd.data", "seq").persist()
        try:
            if metrics:
                metrics(rejected(cmds))
            present = {r["kind"] for r in cmds.filter("valid").select("kind").distinct().collect()}  # the few kinds
            for kind in [k for k in KINDS if k in present]:
                own = cmds.filter((F.col("kind") == kind) & F.col("valid"))
                stored, touched = {}, {}
                for n in TABLES_OF[kind]:
                    if (schema := tables[n].stored_schema()) is None:
                        raise ValueError(f"table {n} was never written and has no schema")
                    by_object = tables[n].by == ["oid"]
                    touched[n] = tables[n].touched(own.select(object_of().cast(schema["oid"].dataType).alias("oid"))) if by_object else list(range(tables[n].buckets))
                    stored[n] = tables[n].read(only=touched[n])
                for n, df in KINDS[kind](stored, own).items():
                    tables[n].replace(df, touched[n])
        finally:
            cmds.unpersist()

    return sink


def state_stage(stream: DataFrame, table: KeyedTable, checkpoint: str, remember_days: float | None = None, available_now: bool = True, every: str = "30 seconds") -> StreamingQuery:
    """Running statistics of ``object_state`` merged into a table keyed by (oid, sid, fid); no stored history is read."""
    updates = object_state(stream, remember_days)
    return run_stage(updates, lambda df, number: table.merge(df), checkpoint, available_now=available_now, every=every, mode="update")


def light_curve_stage(stored: KeyedTable, statistics: KeyedTable) -> Callable[[DataFrame, int], None]:
    """Join a batch with stored history, correct it, store the rows and refresh its objects' statistics.

    The tables are partitioned by object, so a batch reads and rewrites the partitions of its objects only. Both merges are keyed, so a replayed batch changes nothing.
    """

    def sink(batch: DataFrame, number: int) -> None:
        batch = batch.withColumn("new", F.lit(True)).persist()
        old = stored.read(batch)
        det = history.union_history(batch, old) if old is not None else batch
        det = history.as_of_cut(history.dedup_detections(det), batch)
        det = correct.correct_magnitudes(correct.with_flags(det)).persist()
        stored.merge(det)
        statistics.merge(stats.generate_statistics(det))
        det.unpersist()
        batch.unpersist()

    return sink
