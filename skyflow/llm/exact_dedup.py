"""Exact dedup: a cuckoo-filter index over text digests with insertion and deletion.

The digest of a normalised text names a shard; the number of shards grows with the table, so a
shard's content stays small. In a shard, a cuckoo table holds a 16-bit fingerprint and the place of
the stored key in each slot. A digest whose fingerprint is in neither of its two buckets is new; a hit
is verified against the full keys stored in those buckets, so fingerprint collisions never merge
different texts. When an insertion finds no free slot, the table doubles and is rebuilt from the
stored keys. Copies are combined before the shuffle, so a very common text costs a shard one row
for each flush of a map task.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyflow.llm.common import buckets_for, join_groups, materialize, text_of, tune

SHARD_KEYS = 50_000
COMBINE_KEYS = 100_000
SLOTS, MAX_KICKS, SEEDED = 4, 200, 0x5BD1E995


class CuckooTable:
    """Fingerprints and places of keys. ``keys`` is the shard's stored content, a list of 32-byte digests."""

    def __init__(self, keys: list[bytes | None], buckets: int = 16):
        self.keys, self.grown = keys, 0
        self._allot(buckets)

    def _allot(self, buckets: int) -> None:
        self.mask = buckets - 1
        self.marks = array("H", bytes(2 * SLOTS * buckets))
        self.places = array("q", bytes(8 * SLOTS * buckets))

    @staticmethod
    def _mark(digest: bytes) -> int:
        return (digest[12] << 8 | digest[13]) or 1

    def _home(self, digest: bytes) -> int:
        return int.from_bytes(digest[14:20], "little") & self.mask

    def _other(self, bucket: int, mark: int) -> int:
        return bucket ^ (mark * SEEDED & self.mask)

    def find(self, digest: bytes) -> int:
        """The slot that holds this very key, or -1."""
        mark, b = self._mark(digest), self._home(digest)
        for at in (b, self._other(b, mark)):
            for s in range(at * SLOTS, at * SLOTS + SLOTS):
                if self.marks[s] == mark and self.keys[self.places[s]] == digest:  # a hit is verified
                    return s
        return -1

    def _settle(self, mark: int, b: int, place: int) -> bool:
        for kick in range(MAX_KICKS):
            for at in (b, self._other(b, mark)):
                for s in range(at * SLOTS, at * SLOTS + SLOTS):
                    if not self.marks[s]:
                        self.marks[s], self.places[s] = mark, place
                        return True
            s = b * SLOTS + kick % SLOTS
            mark, self.marks[s] = self.marks[s], mark
            place, self.places[s] = self.places[s], place
            b = self._other(b, mark)
        return False

    def insert(self, place: int) -> None:
        digest = self.keys[place]
        if not self._settle(self._mark(digest), self._home(digest), place):
            self.resize()

    def resize(self) -> None:
        """Double until every stored key has a slot again."""
        buckets = self.mask + 1
        while True:
            buckets *= 2
            self.grown += 1
            self._allot(buckets)
            if all(self._settle(self._mark(d), self._home(d), i) for i, d in enumerate(self.keys) if d is not None):
                return

    def delete(self, digest: bytes) -> int:
        """Free the key's slot and return its place, or -1."""
        if (s := self.find(digest)) < 0:
            return -1
        place, self.marks[s] = self.places[s], 0
        return place


@dataclass
class DedupIndex:
    """``keys``: live digests with their kept row; ``filters``: each shard's fingerprints and size."""

    keys: DataFrame
    filters: DataFrame
    shards: int
    entries: DataFrame


_ENTRY = "shard int, kind int, digest binary, keep_row bigint, keep_id {id}, keep_len bigint, group_size bigint, marks binary, grown int"


def normalised(text):
    return F.translate(text, "\x20\t\n\x0b\x0c\r", "")


def digests(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """row, id, digest of the normalised text, code points of the original."""
    text = text_of(docs, text_col)
    return docs.select(F.monotonically_increasing_id().alias("row"), docs[id_col].alias("id"), F.unhex(F.sha2(normalised(text).cast("binary"), 256)).alias("digest"), F.length(text).cast("long").alias("len"))


def _better(a: tuple, b: tuple) -> bool:
    """(len, id, row): longer first, then the smaller id (null last), then the earlier row."""
    return (-a[0], a[1] is None, a[1], a[2]) < (-b[0], b[1] is None, b[1], b[2]) if (a[1] is None) == (b[1] is None) and a[1] is not None else (-a[0], a[1] is None, a[2]) < (-b[0], b[1] is None, b[2])


def _combine(rows: DataFrame, id_type: str) -> DataFrame:
    """Copies that one map task meets become one row before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: dict[bytes, tuple] = {}

        def flush() -> pa.RecordBatch:
            keep = list(met.values())
            return pa.RecordBatch.from_arrays([pa.array(list(met), pa.binary()), pa.array([k[2] for k in keep], pa.int64()), pa.array([k[1] for k in keep], id_kind), pa.array([k[0] for k in keep], pa.int64()), pa.array([k[3] for k in keep], pa.int64())], ["digest", "keep_row", "keep_id", "keep_len", "group_size"])

        id_kind = None
        for b in batches:
            id_kind = b.column(1).type
            for row, i, d, n in zip(*(c.to_pylist() for c in b.columns)):
                new, old = (n, i, row), met.get(d)
                met[d] = (*new, 1) if old is None else (*(new if _better(new, old) else old[:3]), old[3] + 1)
            if len(met) > COMBINE_KEYS:
                yield flush()
                met.clear()
        if met:
            yield flush()

    return rows.mapInArrow(run, f"digest binary, keep_row bigint, keep_id {id_type}, keep_len bigint, group_size bigint")


def _shard_of(digest, shards: int):
    return F.pmod(F.xxhash64(digest), F.lit(shards)).cast("int")


def _apply(changes: DataFrame, id_type: str, label: str) -> DataFrame:
    """Run each shard's stored keys (kind 0), deletions (1) and insertions (2) through its table."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by("kind")  # a stable sort
        keys: list[bytes | None] = []
        kept: list[tuple] = []
        cuckoo = CuckooTable(keys)
        for kind, d, row, i, n, c in zip(*(table[x].to_pylist() for x in ("kind", "digest", "keep_row", "keep_id", "keep_len", "group_size"))):
            if kind == 1:
                if (place := cuckoo.delete(d)) >= 0:
                    keys[place] = None
                continue
            new, s = (n, i, row), cuckoo.find(d)
            if s < 0:
                keys.append(d)
                kept.append((*new, c))
                cuckoo.insert(len(keys) - 1)
            else:
                old = kept[cuckoo.places[s]]
                kept[cuckoo.places[s]] = (*(new if _better(new, old) else old[:3]), old[3] + c)
        live = [(d, *k) for d, k in zip(keys, kept) if d is not None]
        n = len(live)
        digest, length, ids, row, copies = zip(*live) if live else [()] * 5
        marks = [None] * n + [cuckoo.marks.tobytes()]
        cols = [[key[0].as_py()] * (n + 1), [0] * n + [3], [*digest, None], [*row, 0], [*ids, None], [*length, 0], [*copies, 0], marks, [0] * n + [cuckoo.grown]]
        kinds = [pa.int32(), pa.int32(), pa.binary(), pa.int64(), table.schema.field("keep_id").type, pa.int64(), pa.int64(), pa.binary(), pa.int32()]
        names = ["shard", "kind", "digest", "keep_row", "keep_id", "keep_len", "group_size", "marks", "grown"]
        return pa.table([pa.array(c, k) for c, k in zip(cols, kinds)], names)

    return materialize(changes.groupBy("shard").applyInArrow(run, _ENTRY.format(id=id_type)), label)


def _index(entries: DataFrame, shards: int) -> DedupIndex:
    return DedupIndex(entries.filter("kind = 0").drop("kind", "marks", "grown"), entries.filter("kind = 3").select("shard", "marks", "grown"), shards, entries)


def _changes(rows: DataFrame, shards: int, kind: int) -> DataFrame:
    return rows.select(_shard_of(F.col("digest"), shards).alias("shard"), F.lit(kind).alias("kind"), "digest", "keep_row", "keep_id", "keep_len", "group_size")


def build(rows: DataFrame, shards: int) -> DedupIndex:
    """Index ``rows`` (see ``digests``)."""
    kind = rows.schema["id"].dataType.simpleString()
    return _index(_apply(_changes(_combine(rows, kind), shards, 2), kind, "dedup-index"), shards)


def insert(index: DedupIndex, rows: DataFrame) -> DedupIndex:
    """Add ``rows``; digests that are live already keep the better row and grow their group."""
    kind = rows.schema["id"].dataType.simpleString()
    both = _changes(index.keys, index.shards, 0).unionByName(_changes(_combine(rows, kind), index.shards, 2))
    return _index(_apply(both, kind, "dedup-index"), index.shards)


def delete(index: DedupIndex, gone: DataFrame) -> DedupIndex:
    """Delete the live digests that ``gone`` (a column ``digest``) lists; unknown ones are ignored."""
    kind = index.keys.schema["keep_id"].dataType.simpleString()
    none = F.lit(0).cast("long")
    marks = gone.select("digest").distinct().select("digest", none.alias("keep_row"), F.lit(None).cast(kind).alias("keep_id"), none.alias("keep_len"), none.alias("group_size"))
    return _index(_apply(_changes(index.keys, index.shards, 0).unionByName(_changes(marks, index.shards, 1)), kind, "dedup-index"), index.shards)


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Find exact copies: texts equal after deleting ASCII white space.

    Returns one row for each input row: the id, ``keep_id`` (longest original text, then smallest id,
    null ids last), ``group_size``, ``kept``, ``text_sha256``. Null and empty texts are equal to each
    other. Of repeated rows exactly one is kept. An empty table gives an empty result; other columns
    are ignored.
    """
    spark = docs.sparkSession
    tune(spark)
    rows = materialize(digests(docs, id_col, text_col), "dedup-digests")
    total = rows.count()
    keys = build(rows, buckets_for(spark, total, SHARD_KEYS)).keys.select("digest", "keep_row", "keep_id", "group_size")
    found = join_groups(rows, keys, "digest", "group_size", total)
    return found.select(F.col("id").alias(id_col), "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"))


ORACLE = r"""
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY h) AS group_size,
       row_number() OVER w = 1 AS kept, h AS text_sha256
FROM (SELECT doc_id, length(coalesce(text, '')) AS n, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS h FROM documents)
WINDOW w AS (PARTITION BY h ORDER BY n DESC, doc_id)
"""
