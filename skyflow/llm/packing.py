"""Packing: shortest-pack-first over the length histogram, patterns joined back to documents by rank.

Each document's ids are cut into whole sequences of ``seq_len`` ids and one tail. Only the tails are
packed. Their histogram has at most ``seq_len - 1`` entries, so the placing works on counts alone:
lengths go longest first, each into the shortest open pack that has room, and a group of equal packs
is handled as one pattern with a count. At the end the emptiest packs are taken apart and their
tails cut to fill the gaps of the others, so all padding together is less than one sequence.

A pattern's slot owns a range of ranks of one tail length. Tails are ranked within their length by
a window over hash buckets plus bucket offsets, so no length, however common, meets in one task.
"""

from __future__ import annotations

import heapq
import zlib
from bisect import insort
from collections.abc import Iterator
from dataclasses import dataclass, replace

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skyflow.llm.common import buckets_for, materialize, text_of, tune
from skyflow.llm.tokens import column_encoder, default_tokenizer

BUCKET_ROWS = 500_000


@dataclass(frozen=True)
class Slot:
    """``copies`` consecutive ranks of tails of ``size`` go to each pack; of each tail the ids from ``a`` to ``b``."""

    size: int
    rank: int
    copies: int
    a: int
    b: int

    @property
    def used(self) -> int:
        return self.copies * (self.b - self.a)


@dataclass
class Pattern:
    slots: list[Slot]
    count: int

    @property
    def used(self) -> int:
        return sum(s.used for s in self.slots)

    def split(self, n: int) -> Pattern:
        """Take the first ``n`` packs off; the rest keeps the later ranks."""
        first = Pattern(list(self.slots), n)
        self.slots = [replace(s, rank=s.rank + n * s.copies) for s in self.slots]
        self.count -= n
        return first


def shortest_pack_first(histogram: dict[int, int], seq_len: int) -> list[Pattern]:
    """Place lengths longest first, each into the shortest open pack with room, on counts."""
    open_packs: list[tuple[int, int, Pattern]] = []  # by ids used
    full, ticket = [], 0

    def put(p: Pattern) -> None:
        nonlocal ticket
        if p.used == seq_len:
            full.append(p)
        else:
            ticket += 1
            heapq.heappush(open_packs, (p.used, ticket, p))

    for size in sorted(histogram, reverse=True):
        left, rank = histogram[size], 0
        while left:
            if open_packs and open_packs[0][0] + size <= seq_len:
                p = heapq.heappop(open_packs)[2]
                if p.count > left:
                    first = p.split(left)
                    put(p)
                    p = first
                p.slots.append(Slot(size, rank, 1, 0, size))
                rank, left = rank + p.count, left - p.count
                put(p)
            else:  # no room: new packs, each filled in turn with as many of this length as fit
                each = min(left, seq_len // size)
                n = left // each
                put(Pattern([Slot(size, rank, each, 0, size)], n))
                rank, left = rank + n * each, left - n * each
    return full + [p for _, _, p in sorted(open_packs, key=lambda x: x[:2])]


def fill_gaps(patterns: list[Pattern], seq_len: int) -> list[Pattern]:
    """Take the emptiest packs apart and cut their tails to fill the gaps of the fuller ones."""
    done = [p for p in patterns if p.used == seq_len]
    rest = sorted((p for p in patterns if p.used < seq_len), key=lambda p: p.used)
    gaps = sum((seq_len - p.used) * p.count for p in rest)
    while gaps >= seq_len:
        donor = rest[0]
        if len(rest) == 1:  # equal packs: some give, the others take
            rest.append(donor.split(max(1, donor.count * donor.used // seq_len)))
            continue
        into = rest[-1]
        t = min(donor.count, into.count)
        giver = rest.pop(0) if donor.count == t else donor.split(t)
        into = rest.pop() if into.count == t else into.split(t)
        s = giver.slots.pop()
        if s.copies > 1:  # its ranks are one range: deal them copy by copy, so that one copy can go
            giver.slots += [Slot(s.size, s.rank + j * t, 1, s.a, s.b) for j in range(s.copies)]
            s = giver.slots.pop()
        part = min(s.b - s.a, seq_len - into.used)
        into.slots.append(replace(s, b=s.a + part))
        if s.a + part < s.b:
            giver.slots.append(replace(s, a=s.a + part))
        gaps -= 0 if giver.slots else t * seq_len
        for p in (into, giver):
            if p.used == seq_len:
                done.append(p)
            elif p.slots:
                insort(rest, p, key=lambda p: p.used)
    return done + rest


def _encoded(docs: DataFrame, id_col: str, text_col: str, path: str, seq_len: int) -> DataFrame:
    """One row for each document: token count, checksums of its whole sequences, and its tail."""
    size = 4 * seq_len

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = column_encoder(path)
        for b in batches:
            n, sums, tails = [], [], []
            for ids in enc.column(b.column(2)):
                ids += b"\0\0\0\0"
                whole = len(ids) // size * size
                n.append(len(ids) // 4)
                sums.append([zlib.crc32(ids[k : k + size]) for k in range(0, whole, size)])
                tails.append(ids[whole:])
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(n, pa.int64()), pa.array(sums, pa.list_(pa.int64())), pa.array(tails, pa.binary())], ["row", "id", "doc_tokens", "sums", "tail"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.monotonically_increasing_id().alias("row"), docs[id_col].alias("id"), text_of(docs, text_col).alias("text")).mapInArrow(run, f"row bigint, id {kind}, doc_tokens bigint, sums array<bigint>, tail binary")


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None, seq_len: int = 1024) -> DataFrame:
    """Pack the ids of all texts, each followed by id 0, into sequences of at most ``seq_len``.

    Returns one row for each piece: the id, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``,
    ``sequence_id``, ``offset``. Null and empty texts are the lone id 0. Repeated rows are packed
    each by itself. An empty table gives an empty result; other columns are ignored.
    """
    spark = docs.sparkSession
    tune(spark)
    enc = materialize(_encoded(docs, id_col, text_col, tokenizer or default_tokenizer(), seq_len), "packing")
    size = (F.col("doc_tokens") % seq_len).cast("int")
    rows = enc.select("row", "id", "doc_tokens", "sums", "tail", size.alias("size"))
    buckets = buckets_for(spark, enc.count(), BUCKET_ROWS)
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("row"), F.lit(buckets)))

    by_size = materialize(rows.groupBy("bucket", "size").agg(F.count("*").alias("n"), F.sum(F.size("sums")).alias("whole")), "packing-counts")
    histogram = {r["size"]: r["n"] for r in by_size.filter("size > 0").groupBy("size").agg(F.sum("n").alias("n")).collect()}  # at most seq_len - 1 rows
    patterns = fill_gaps(shortest_pack_first(histogram, seq_len), seq_len)
    slots, seq = [], 0
    for p in patterns:
        at = 0
        for s in p.slots:
            slots.append((s.size, s.rank, s.rank + p.count * s.copies, s.copies, s.a, s.b, seq, at))
            at += s.used
        seq += p.count
    cut_sizes = sorted({x[0] for x in slots if x[5] - x[4] < x[0]})

    # where a bucket's tails of one length begin among all of that length, and its whole sequences among all
    in_size = Window.partitionBy("size").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    in_bucket = Window.partitionBy("bucket").orderBy("size").rowsBetween(Window.unboundedPreceding, -1)
    none = F.lit(0).cast("long")
    starts = by_size.select("bucket", "size", (F.coalesce(F.sum("n").over(in_size), none) - F.coalesce(F.sum("n").over(in_bucket), none)).alias("shift"))
    wholes = by_size.groupBy("bucket").agg(F.sum("whole").alias("whole"))
    whole_starts = wholes.select("bucket", (F.coalesce(F.sum("whole").over(Window.partitionBy(F.lit(0)).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), none) + seq).alias("first"))

    own = Window.partitionBy("bucket").orderBy("size", "row")
    ranked = (
        rows.select("row", "id", "doc_tokens", "sums", "size", "bucket", F.crc32("tail").alias("tail_crc"), F.when(F.col("size").isin(cut_sizes), F.col("tail")).alias("cut_tail"))
        .withColumn("n", F.row_number().over(own) - 1)
        .withColumn("before", F.sum(F.size("sums")).over(own.rowsBetween(Window.unboundedPreceding, 0)) - F.size("sums"))
    )
    whole = (
        ranked.filter(F.size("sums") > 0).join(whole_starts, "bucket")
        .select("id", "doc_tokens", (F.col("first") + F.col("before")).alias("seq0"), F.posexplode("sums").alias("k", "ids_crc32"))
        .select("id", (F.col("k").cast("long") * seq_len).alias("start"), F.lit(seq_len).cast("long").alias("length"), "ids_crc32", "doc_tokens", (F.col("seq0") + F.col("k")).alias("sequence_id"), none.alias("offset"))
    )
    # bounded by the histogram: some thousand slots at most; as an Arrow table it needs no Python workers of its own
    names = ["s_size", "lo", "hi", "copies", "a", "b", "seq", "at"]
    places = spark.createDataFrame(pa.table([pa.array([x[k] for x in slots], pa.int64()) for k in range(len(names))], names))
    tails = ranked.filter("size > 0").join(starts, ["bucket", "size"]).withColumn("rank", F.col("n") + F.col("shift"))
    place = (F.col("size") == F.col("s_size")) & (F.col("rank") >= F.col("lo")) & (F.col("rank") < F.col("hi"))
    i = F.col("rank") - F.col("lo")
    length = F.col("b") - F.col("a")
    part = F.expr("substring(cut_tail, cast(4 * a + 1 as int), cast(4 * (b - a) as int))")
    placed = tails.join(F.broadcast(places), place).select(
        "id",
        (F.col("doc_tokens") - F.col("size") + F.col("a")).alias("start"),
        length.alias("length"),
        F.when(length == F.col("size"), F.col("tail_crc")).otherwise(F.crc32(part)).alias("ids_crc32"),
        "doc_tokens",
        (F.col("seq") + F.expr("(rank - lo) div copies")).alias("sequence_id"),
        (F.col("at") + (i % F.col("copies")) * length).alias("offset"),
    )
    return whole.unionByName(placed).withColumnRenamed("id", id_col)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"))
