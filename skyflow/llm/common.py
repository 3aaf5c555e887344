"""Helpers shared by the training-data operators."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows and bytes in one Arrow batch: a batch of long texts must fit a small worker.
ARROW_ROWS, ARROW_BYTES = 1000, 2 << 20

WHITESPACE = "[\\x20\\x09-\\x0D]"


def tune(spark: SparkSession) -> None:
    """Bound the Arrow batches that Spark hands to Python workers."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BYTES)


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; a temporary one only in local mode, where the session names none (tests)."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    schema = df.schema
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(schema).parquet(path)


def text_of(df: DataFrame, name: str = "text") -> Column:
    """The text column, null as empty."""
    return F.coalesce(df[name].cast("string"), F.lit(""))


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def buckets_for(spark: SparkSession, rows: int, each: int) -> int:
    """So many buckets that one holds about ``each`` rows, and at least one for every shuffle partition."""
    return max(shuffle_width(spark), -(-rows // each))


# --- word hashes over Arrow strings -------------------------------------------------

_MULT = np.uint64(0x9E3779B97F4A7C15 | 1)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SEGMENT = 1 << 18
_POWERS = np.zeros(0, dtype=np.uint64)


def _powers(n: int) -> np.ndarray:
    global _POWERS
    if len(_POWERS) < n:
        p = np.full(max(n, 64, 2 * len(_POWERS)), _MULT, dtype=np.uint64)
        p[0] = 1
        _POWERS = np.multiply.accumulate(p)
    return _POWERS


def mix64(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit hashes so that all bits depend on all others."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def string_buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of an Arrow string array without nulls."""
    col = col.cast(pa.large_string()) if not pa.types.is_large_string(col.type) else col
    _, offs, data = col.buffers()
    offsets = np.frombuffer(offs, dtype=np.int64)[col.offset : col.offset + len(col) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def word_spans(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end byte of every word; words never cross the texts' borders."""
    ink = ~_SPACE[raw]
    first = np.zeros(len(raw) + 1, dtype=bool)
    first[offsets] = True
    before = np.empty_like(ink)
    if len(ink):
        before[0] = False
        before[1:] = ink[:-1]
    starts = np.flatnonzero(ink & (~before | first[:-1]))
    after = np.empty_like(ink)
    if len(ink):
        after[-1] = False
        after[:-1] = ink[1:]
    ends = np.flatnonzero(ink & (~after | first[1:])) + 1
    return starts, ends


def hash_spans(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte span, A-Z lower-cased; memory is bounded by working in segments."""
    out = np.empty(len(starts), dtype=np.uint64)
    lens = ends - starts
    cum = np.concatenate(([0], np.cumsum(lens)))
    lo = 0
    while lo < len(starts):
        hi = max(lo + 1, int(np.searchsorted(cum, cum[lo] + _SEGMENT, "right")) - 1)
        n = lens[lo:hi]
        begin = cum[lo:hi] - cum[lo]
        place = np.arange(int(cum[hi] - cum[lo])) - np.repeat(begin, n)
        value = _LOWER[raw[place + np.repeat(starts[lo:hi], n)]].astype(np.uint64) + np.uint64(1)
        value *= _powers(int(n.max()) + 1)[place]
        out[lo:hi] = np.add.reduceat(value, begin)
        lo = hi
    return mix64(out + lens.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def shingle_sets(col: pa.Array, width: int) -> Iterator[np.ndarray]:
    """For each text its sorted distinct ``width``-word shingle hashes (int64); shorter texts give one, empty texts none."""
    raw, offsets = string_buffers(col)
    starts, ends = word_spans(raw, offsets)
    words = hash_spans(raw, starts, ends)
    border = np.searchsorted(starts, offsets)
    with np.errstate(over="ignore"):
        rolled = np.zeros(max(0, len(words) - width + 1), dtype=np.uint64)
        for j in range(width):
            rolled = mix64(rolled * np.uint64(0xC2B2AE3D27D4EB4F) + words[j : j + len(rolled)]) if j else words[: len(rolled)].copy()
    for i in range(len(col)):
        a, b = int(border[i]), int(border[i + 1])
        if b - a >= width:
            yield np.unique(rolled[a : b - width + 1].view(np.int64))
        elif b > a:
            h = np.uint64(b - a)
            with np.errstate(over="ignore"):
                for w in words[a:b]:
                    h = mix64(np.array([h * np.uint64(0xC2B2AE3D27D4EB4F) + w]))[0]
            yield np.array([h]).view(np.int64)
        else:
            yield np.zeros(0, dtype=np.int64)


def id_crc_mod(col: Column, mod: int) -> Column:
    """crc32 of the id's decimal text modulo ``mod``: the fixed folds of the labelled tables."""
    return F.pmod(F.crc32(col.cast("string").cast("binary")), F.lit(mod))


#: At most so many groups can hold more than a share of 1 / HEAVY_GROUPS of all rows.
HEAVY_GROUPS = 1000


def join_groups(rows: DataFrame, groups: DataFrame, on: str, size: str, total: int) -> DataFrame:
    """Inner join of rows to their group's row, whatever a group's share of the rows.

    ``size`` counts a group's rows. Groups of more than total / HEAVY_GROUPS rows are fewer than
    HEAVY_GROUPS, so these are broadcast; the others are shuffled, and none of them fills a task.
    """
    bound = max(1000, total // HEAVY_GROUPS)
    heavy, light = groups.filter(F.col(size) > bound), groups.filter(F.col(size) <= bound)
    rest = rows.join(F.broadcast(heavy.select(on)), on, "left_anti")
    return rows.join(F.broadcast(heavy), on).unionByName(rest.join(light, on))


def connected_components(edges: DataFrame) -> DataFrame:
    """Label (``v``, ``label``) every vertex of the edges (``a``, ``b``) with the smallest vertex it reaches.

    Each round takes the smallest label among a vertex and its neighbours and then the label of that
    label, so paths halve; every round is written to the shared folder.
    """
    both = materialize(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "cc-edges")
    labels = materialize(both.groupBy(F.col("a").alias("v")).agg(F.least(F.col("a"), F.min("b")).alias("label")), "cc")
    while True:
        seen = both.join(labels.withColumnRenamed("v", "b"), "b").groupBy(F.col("a").alias("v")).agg(F.min("label").alias("near"))
        near = labels.join(seen, "v").select("v", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        up = labels.select(F.col("v").alias("label"), F.col("label").alias("above"))
        new = materialize(near.join(up, "label", "left").select("v", "old", F.least("label", F.coalesce("above", "label")).alias("label")), "cc")
        labels = new.select("v", "label")
        if not new.filter("old <> label").limit(1).count():
            return labels
