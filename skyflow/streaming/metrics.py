"""Metrics that a stream counts while its batches run, given to a sink by a listener: no job of their own."""

from __future__ import annotations

import datetime
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener
from pyspark.sql.types import ArrayType, DoubleType, LongType, StringType, StructField, StructType, TimestampType

from skyflow.streaming.stages import metric_columns

#: What a row of metrics holds before the chosen fields.
_HEAD = [("batch", LongType()), ("timestamp_received", TimestampType()), ("timestamp_sent", TimestampType()), ("execution_time", DoubleType()), ("n_messages", LongType())]


def observed(stream: DataFrame, name: str, fields: dict[str, str] | list[dict] | None = None) -> DataFrame:
    """The stream, which now counts its messages and gathers the fields of ``batch_metrics`` as ``name``.

    The values of a batch's fields reach the driver with its progress, as a metric row does: choose short fields, or none.
    """
    return stream.observe(name, F.count(F.lit(1)).alias("n_messages"), *metric_columns(stream, fields))


class MetricsListener(StreamingQueryListener):
    """Hands one row (a dict with the columns of ``batch_metrics``) a batch of every query that observes ``name`` to ``sink``.

    Received and sent are the start and the end of the batch's trigger. A sink that fails does not stop the stream; its
    error is kept in ``errors``.
    """

    def __init__(self, name: str, sink: Callable[[dict], None]):
        self.name, self.sink, self.errors = name, sink, []

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        seen = p.observedMetrics.get(self.name)
        if seen is None or not seen["n_messages"]:
            return
        start = datetime.datetime.fromisoformat(p.timestamp.replace("Z", "+00:00"))
        seconds = p.batchDuration / 1000
        row = {"batch": p.batchId, "timestamp_received": start, "timestamp_sent": start + datetime.timedelta(seconds=seconds), "execution_time": seconds, **seen.asDict()}
        try:
            self.sink(row)
        except Exception as e:  # a listener must not stop the stream
            self.errors.append(e)


def metric_rows(spark: SparkSession, rows: list[dict]) -> DataFrame:
    """Rows of a listener as a frame, for ``write_metrics``."""
    known = [n for n, _ in _HEAD]
    more = [n for n in (rows[0] if rows else {}) if n not in known]
    kind = StructType([StructField(n, t) for n, t in _HEAD] + [StructField(n, ArrayType(StringType())) for n in more])
    return spark.createDataFrame([tuple(r[f.name] for f in kind) for r in rows], kind)
