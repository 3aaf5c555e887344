r"""Conversation prefix trie: padded turn-id matrices in range shards, whose boundary nodes recombine.

A conversation is cut into segments of SEGMENT turns, so a row stays short however long it is. Segments are
range-sharded by (segment, digest of the turns before it, turn ids, conversation); equal prefixes are neighbours, and a
shard holds whole ranges of them. In a shard the turn ids form a padded matrix: numpy lexsort orders it, masks of column
changes accumulated by OR mark where nodes start at every depth, and reduceat aggregates each depth's nodes. Only nodes
at a shard's two borders can lie in other shards too; Spark adds these up by key.

Sums over subtrees go through owners. A node's owner is its smallest member, and a member owns the end of its path, so a
subtree's sum is that of everything its other members own, and of what the owner owns from the node on.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skyflow.llm.common import join_groups, materialize, shuffle_width, text_of, tune

#: Turns in a row of the matrices, rows of a shard, and depths that one window adds up.
SEGMENT, SHARD_ROWS, BLOCK = 16, 1 << 15, 4096
KEY = ["depth", "z1", "z2"]


def _turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, h1, h2, words): a turn's 128-bit id from its role and text, and the words of its text."""
    role, text = text_of(conversations, "role"), text_of(conversations, "text")
    digest = F.sha2(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256)
    half = lambda at: F.conv(F.substring("d", at, 16), 16, -10).cast("long")
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", digest.alias("d"), F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"))
    return rows.filter("conv_id is not null").select("conv_id", "turn", half(1).alias("h1"), half(17).alias("h2"), "words")


def _ranked(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns with their ``rank`` from 0 in their conversation (null turns first, ties by digest), and the
    conversations with their number of turns.

    Sorted ranges are counted by run; a conversation that lies in several ranges has an offset in each, and there are
    fewer such conversations than ranges.
    """
    order = ["conv_id", F.col("turn").asc_nulls_first(), "h1", "h2"]
    dealt = turns.repartitionByRange(shuffle_width(turns.sparkSession), *order).sortWithinPartitions(*order).select("conv_id", "h1", "h2", "words", F.spark_partition_id().alias("part"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, seen = None, 0
        for b in batches:
            if not b.num_rows:
                continue
            c = b.column(0).to_numpy()
            first = np.flatnonzero(np.append(True, c[1:] != c[:-1]))
            begin = np.repeat(first, np.diff(np.append(first, len(c))))
            local = np.arange(len(c)) - begin + np.where(c == last, seen, 0)
            last, seen = c[-1], int(local[-1]) + 1
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(local, pa.int64())], ["conv_id", "h1", "h2", "words", "part", "local"])

    rows = materialize(dealt.mapInArrow(count, "conv_id bigint, h1 bigint, h2 bigint, words bigint, part int, local bigint"), "turns")
    by_part = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = rows.groupBy("conv_id", "part").agg(F.count("*").alias("n"))
    placed = runs.withColumns({"offset": F.coalesce(F.sum("n").over(by_part), F.lit(0)), "parts": F.count("*").over(Window.partitionBy("conv_id"))})
    spread = placed.filter("parts > 1").select("conv_id", "part", "offset")
    ranked = rows.join(F.broadcast(spread), ["conv_id", "part"], "left").select("conv_id", "h1", "h2", "words", (F.col("local") + F.coalesce("offset", F.lit(0))).alias("rank"))
    return ranked, runs.groupBy("conv_id").agg(F.sum("n").alias("n_turns"))


def _segments(conversations: DataFrame, stride: int, shared: int) -> tuple[DataFrame, DataFrame, int]:
    """The rebuilt conversations in segments, all conversations with their sizes, and the number of original turns.

    Segment: conv_id, seg, last (its conversation ends here), length (turns of the conversation), p1 and p2 (digest of
    the turns before), x1 and x2 (its own), t (turn ids, two halves each), z1 and z2 (digests of single turns), w (words).
    """
    ranked, sizes = _ranked(materialize(_turns(conversations), "turn-ids"))  # sorting by ranges reads its input twice
    h = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(shared + 1))
    base = ranked.filter((F.col("conv_id") % stride == 0) & (F.col("rank") < shared)).groupBy(F.col("conv_id").alias("base")).agg(F.sort_array(F.collect_list(F.struct("rank", "h1", "h2", "words"))).alias("head"))
    convs = sizes.withColumns({"h": h, "base": F.col("conv_id") - F.col("conv_id") % stride}).join(base, "base", "left")
    head = F.slice(F.coalesce("head", F.array()), F.lit(1), F.col("h").cast("int"))
    convs = convs.withColumn("head", head).withColumn("given", F.size("head").cast("long"))
    convs = materialize(convs.withColumn("length", F.col("given") + F.greatest(F.col("n_turns") - F.col("h"), F.lit(0))).drop("base"), "conversations")
    total = convs.agg(F.sum("n_turns")).first()[0] or 0

    own = join_groups(ranked, convs.select("conv_id", "h", "given", "length", "n_turns"), "conv_id", "n_turns", total).filter("rank >= h")
    own = own.select("conv_id", "length", (F.col("rank") - F.col("h") + F.col("given")).alias("pos"), "h1", "h2", "words")
    given = convs.select("conv_id", "length", F.posexplode("head").alias("pos", "x")).select("conv_id", "length", F.col("pos").cast("long").alias("pos"), "x.h1", "x.h2", "x.words")
    turns = own.unionByName(given)
    z = lambda k: F.xxhash64(F.lit(k), "h1", "h2", "pos")
    turns = turns.withColumns({"seg": F.floor(F.col("pos") / SEGMENT), "z1": z(11), "z2": z(29)})
    g = turns.groupBy("conv_id", "seg").agg(F.first("length").alias("length"), F.bit_xor("z1").alias("x1"), F.bit_xor("z2").alias("x2"), F.sort_array(F.collect_list(F.struct("pos", "h1", "h2", "z1", "z2", "words"))).alias("s"))
    zero = F.lit(0).cast("long")
    part = lambda name: F.transform("s", lambda x: x[name]).alias({"words": "w"}.get(name, name))
    filled = g.select("conv_id", "seg", "length", "x1", "x2", F.flatten(F.transform("s", lambda x: F.array(x["h1"], x["h2"]))).alias("t"), part("z1"), part("z2"), part("words"))
    none = F.array().cast("array<bigint>")
    empty = convs.filter("length = 0").select("conv_id", zero.alias("seg"), "length", zero.alias("x1"), zero.alias("x2"), none.alias("t"), none.alias("z1"), none.alias("z2"), none.alias("w"))
    rows = materialize(filled.unionByName(empty), "segments")

    long = rows.filter(F.col("length") > SEGMENT)
    before = _running(long.select("conv_id", "seg", "x1", "x2"), "conv_id", F.col("seg"), {"p1": "x1", "p2": "x2"}, F.bit_xor, lambda a, b: a.bitwiseXOR(b)).select("conv_id", "seg", "p1", "p2")
    short = rows.filter(F.col("length") <= SEGMENT).withColumns({"p1": zero, "p2": zero})
    rows = short.unionByName(long.join(before, ["conv_id", "seg"])).withColumn("last", (F.col("seg") + 1) * SEGMENT >= F.col("length"))
    return materialize(rows, "segments-placed"), convs, total


def _running(df: DataFrame, key: str, order: Column, values: dict[str, str], add: Callable[[Column], Column], join: Callable[[Column, Column], Column]) -> DataFrame:
    """Aggregates (``add``) of all rows of a group before each row in ascending ``order`` (a long from 0), BLOCK steps to a window.

    ``values`` are columns by the names of their results; ``join`` combines what blocks before hold with what this one does.
    """
    rows = df.withColumns({"__o": order, "__b": F.floor(order / BLOCK)})
    blocks = rows.groupBy(key, "__b").agg(*(add(F.col(c)).alias(k) for k, c in values.items()))
    before = Window.partitionBy(key).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.select(key, "__b", *(F.coalesce(add(F.col(k)).over(before), F.lit(0)).alias(f"__{k}") for k in values))
    inside = Window.partitionBy(key, "__b").orderBy("__o").rowsBetween(Window.unboundedPreceding, -1)
    out = rows.withColumns({k: F.coalesce(add(F.col(c)).over(inside), F.lit(0)) for k, c in values.items()}).join(offsets, [key, "__b"])
    return out.withColumns({k: join(F.col(k), F.col(f"__{k}")) for k in values}).drop("__o", "__b", *(f"__{k}" for k in values))


_NODE = ["depth", "z1", "z2", "pz1", "pz2", "conv", "n", "words", "saved", "leaves", "whole"]
_NODE_SCHEMA = ", ".join(f"{c} bigint" for c in _NODE[:-1]) + ", whole boolean"


def _dense(*columns: np.ndarray) -> np.ndarray:
    """Ranks from 0 of rows of several columns, equal rows alike, in the rows' order."""
    order = np.lexsort(columns[::-1])
    new = np.zeros(len(order), bool)
    for c in columns:
        new[1:] |= c[order][1:] != c[order][:-1]
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(new)
    return out


def shard_nodes(seg: np.ndarray, p1: np.ndarray, p2: np.ndarray, conv: np.ndarray, lens: np.ndarray, t: np.ndarray, z1: np.ndarray, z2: np.ndarray, w: np.ndarray, saved: np.ndarray, leaves: np.ndarray, segment: int = SEGMENT) -> Iterator[dict[str, np.ndarray]]:
    """The nodes of one shard, depth by depth.

    Rows are segments with their flat lists ``t`` (two halves a turn), ``z1``, ``z2``, ``w``; ``saved`` and ``leaves``
    are values of the rows to add up by node.
    """
    n, width = len(seg), int(lens.max(initial=0))
    filled = np.arange(width) < lens[:, None]

    def matrix(flat: np.ndarray) -> np.ndarray:
        out = np.zeros((n, width), np.int64)
        out[filled] = flat
        return out

    ids = matrix(_dense(t[::2], t[1::2]) + 1 if len(t) else np.zeros(0, np.int64))  # 0 pads
    group = _dense(seg, p1, p2)
    order = np.lexsort((conv, *(ids[:, j] for j in range(width - 1, -1, -1)), group))
    ids, group, seg, conv, lens, saved, leaves = ids[order], group[order], seg[order], conv[order], lens[order], saved[order], leaves[order]
    words = matrix(w)[order]
    change = np.zeros((n, width + 1), bool)
    change[0] = True
    change[1:, 0] = group[1:] != group[:-1]
    change[1:, 1:] = ids[1:] != ids[:-1]
    np.logical_or.accumulate(change, axis=1, out=change)
    key1, key2 = (np.bitwise_xor.accumulate(np.column_stack((p[order], matrix(z)[order])), axis=1) for p, z in ((p1, z1), (p2, z2)))
    for j in range(width + 1):
        starts = np.flatnonzero(change[:, j])
        ends = np.append(starts[1:], n)
        keep = lens[starts] >= j if j else seg[starts] == 0
        s = starts[keep]
        zeros = np.zeros(len(s), np.int64)
        yield {
            "depth": seg[s] * segment + j, "z1": key1[s, j], "z2": key2[s, j], "pz1": key1[s, j - 1] if j else zeros, "pz2": key2[s, j - 1] if j else zeros, "conv": np.minimum.reduceat(conv, starts)[keep], "n": (ends - starts)[keep],
            "words": words[s, j - 1] if j else zeros, "saved": np.add.reduceat(saved, starts)[keep], "leaves": np.add.reduceat(leaves, starts)[keep],
            "whole": ((starts > 0) & (ends < n))[keep],
        }


def _nodes(segments: DataFrame, n_rows: int) -> DataFrame:
    """The nodes over all shards; ``segments`` have the values ``saved`` and ``leaves``."""
    segment = SEGMENT

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [b for b in batches if b.num_rows]
        if not got:
            return
        table = pa.Table.from_batches(got).combine_chunks()
        plain = {c: table.column(c).to_numpy() for c in ("seg", "p1", "p2", "conv_id", "saved", "leaves")}
        flat = {c: table.column(c).combine_chunks().flatten().to_numpy(zero_copy_only=False) for c in ("t", "z1", "z2", "w")}
        lens = np.array(table.column("w").combine_chunks().value_lengths(), np.int64)
        del table, got
        for part in shard_nodes(plain["seg"], plain["p1"], plain["p2"], plain["conv_id"], lens, flat["t"], flat["z1"], flat["z2"], flat["w"], plain["saved"], plain["leaves"], segment):
            for lo in range(0, len(part["n"]), 10_000):
                yield pa.RecordBatch.from_arrays([pa.array(part[c][lo : lo + 10_000]) for c in _NODE], _NODE)

    shards = max(shuffle_width(segments.sparkSession), -(-n_rows // SHARD_ROWS))
    dealt = segments.select("seg", "p1", "p2", "t", "conv_id", "z1", "z2", "w", "saved", "leaves").repartitionByRange(shards, "seg", "p1", "p2", "t", "conv_id")
    parts = materialize(dealt.mapInArrow(run, _NODE_SCHEMA), "shard-nodes")
    first = lambda c: F.first(c).alias(c)
    border = parts.filter("not whole").groupBy(*KEY).agg(first("pz1"), first("pz2"), F.min("conv").alias("conv"), F.sum("n").alias("n"), first("words"), F.sum("saved").alias("saved"), F.sum("leaves").alias("leaves"))
    return parts.filter("whole").drop("whole").unionByName(border)


def _ends(segments: DataFrame) -> DataFrame:
    """SHA-256 of the ids of the conversations that end at each node, ascending and comma-joined.

    Sorted ranges are first joined to strings of a batch's ids each; then one pass over a node's strings feeds its hash, so
    memory is bounded however many end there.
    """
    ends = segments.filter("last").select(F.col("length").alias("depth"), F.col("p1").bitwiseXOR(F.col("x1")).alias("z1"), F.col("p2").bitwiseXOR(F.col("x2")).alias("z2"), "conv_id")
    order = [*KEY, "conv_id"]
    key_schema = "depth bigint, z1 bigint, z2 bigint"

    def borders(b: pa.RecordBatch) -> np.ndarray:
        cols = [b.column(k).to_numpy() for k in range(3)]
        return np.flatnonzero(np.append(True, np.logical_or.reduce([c[1:] != c[:-1] for c in cols])))

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                starts = borders(b)
                ids = b.column(3).to_pylist()
                strings = [",".join(map(str, ids[i:j])) for i, j in zip(starts, [*starts[1:], len(ids)])]
                yield pa.RecordBatch.from_arrays([b.column(k).take(pa.array(starts)) for k in range(4)] + [pa.array(strings, pa.string())], [*order, "ids"])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, sha = None, None
        for b in batches:
            keys = list(zip(*(b.column(k).to_pylist() for k in range(3))))
            out = []
            for key, ids in zip(keys, b.column(4).to_pylist()):
                if key == last:
                    sha.update(b"," + ids.encode())
                    continue
                if last is not None:
                    out.append((*last, sha.hexdigest()))
                last, sha = key, hashlib.sha256(ids.encode())
            yield _rows(out)
        if last is not None:
            yield _rows([(*last, sha.hexdigest())])

    def _rows(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([*(pa.array([r[k] for r in out], pa.int64()) for k in range(3)), pa.array([r[3] for r in out], pa.string())], [*KEY, "ends_sha256"])

    width = shuffle_width(segments.sparkSession)
    strings = ends.repartitionByRange(width, *order).sortWithinPartitions(*order).mapInArrow(join, f"{key_schema}, conv_id bigint, ids string")
    return strings.repartition(width, *KEY).sortWithinPartitions(*order).mapInArrow(digest, f"{key_schema}, ends_sha256 string")


def prefix_trie(conversations: DataFrame, stride: int = 20, shared: int = 3) -> DataFrame:
    """The trie of the rebuilt conversations, one row for each node: conv_id (smallest member), depth, parent_conv_id,
    n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Conversation c is rebuilt as the first h turns of c - c % stride (h = crc32(c) % (shared + 1)) and its own turns after
    its first h. Null roles and texts are empty, null turns come first, equal turns go by the digest of their role
    and text (repeated rows count each). Rows without conv_id belong to no conversation. Other columns are ignored; an empty
    table has no nodes. A conversation of any length is cut into segments, ranks go by sorted ranges, and a node of any
    size is spread over shards.
    """
    tune(conversations.sparkSession)
    segments, convs, total = _segments(conversations, stride, shared)
    n_rows = segments.count()
    zero = F.lit(0).cast("long")
    nodes = materialize(_nodes(segments.withColumns({"saved": zero, "leaves": zero}), n_rows).select(*KEY, "pz1", "pz2", "conv", "n", "words"), "nodes")
    children = nodes.filter("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("pz1").alias("z1"), F.col("pz2").alias("z2")).agg(F.count("*").alias("n_children"))
    nodes = nodes.join(children, KEY, "left").withColumn("n_children", F.coalesce("n_children", zero))
    nodes = materialize(nodes.withColumns({"saved": (F.col("n") - 1) * F.col("words"), "leaf": (F.col("n_children") == 0).cast("long")}), "nodes-valued")

    # what each conversation owns, and what it owns before each of its nodes
    owned = nodes.groupBy("conv").agg(F.sum("saved").alias("saved"), F.sum("leaf").alias("leaves"))
    before = _running(nodes.select("conv", "depth", "saved", "leaf"), "conv", F.col("depth"), {"b_saved": "saved", "b_leaves": "leaf"}, F.sum, lambda a, b: a + b).select("conv", "depth", "b_saved", "b_leaves")
    values = convs.select("conv_id", "n_turns").join(owned.withColumnRenamed("conv", "conv_id"), "conv_id", "left").fillna(0, ["saved", "leaves"])
    sums = _nodes(join_groups(segments, values, "conv_id", "n_turns", total), n_rows)
    # all that members own, less what the owner owns above the node
    sums = sums.join(before, ["conv", "depth"]).select(*KEY, (F.col("saved") - F.col("b_saved")).alias("saved_tokens"), (F.col("leaves") - F.col("b_leaves")).alias("n_leaves"))

    parents = nodes.filter("n_children > 0").select(F.struct(*KEY).alias("pkey"), F.col("conv").alias("parent_conv_id"), "n_children")
    below = nodes.filter("depth > 0").select(*KEY, F.struct((F.col("depth") - 1).alias("depth"), F.col("pz1").alias("z1"), F.col("pz2").alias("z2")).alias("pkey"))
    n_nodes = below.count()
    above = join_groups(below, parents, "pkey", "n_children", n_nodes).select(*KEY, "parent_conv_id")
    out = nodes.join(above, KEY, "left").join(sums, KEY).join(_ends(segments), KEY, "left")
    return out.select(
        F.col("conv").alias("conv_id"), "depth", "parent_conv_id", F.col("n").alias("n_convs"), "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256")
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


ORACLE = r"""
WITH turns AS (
 SELECT conv_id, md5(length(role) || ':' || role || text) AS id, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words,
  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(length(role) || ':' || role || text)) - 1 AS r
 FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL)),
convs AS (
 SELECT conv_id, conv_id - conv_id % 20 AS base,
  xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ord(x)::BIGINT)), lambda c, b:
   list_reduce(list_prepend(xor(c, b), range(1, 9)), lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::BIGINT) ELSE x >> 1 END)), 4294967295::BIGINT) % 4 AS h
 FROM (SELECT DISTINCT conv_id FROM turns)),
rebuilt AS (
 SELECT c.conv_id, 0 AS side, t.r, t.id, t.words FROM convs c JOIN turns t ON t.conv_id = c.base AND t.r < c.h
 UNION ALL SELECT c.conv_id, 1, t.r, t.id, t.words FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.r >= c.h),
path AS (
 SELECT conv_id, row_number() OVER w AS d, md5(string_agg(id, ',') OVER (w ROWS UNBOUNDED PRECEDING)) AS prefix, words
 FROM rebuilt WINDOW w AS (PARTITION BY conv_id ORDER BY side, r)),
rows AS (
 SELECT conv_id, d, prefix, words, lag(prefix) OVER w AS parent, lead(d) OVER w IS NULL AS ends
 FROM (SELECT conv_id, d, prefix, words FROM path UNION ALL SELECT conv_id, 0, '', 0 FROM convs) WINDOW w AS (PARTITION BY conv_id ORDER BY d)),
nodes AS (
 SELECT d, prefix, any_value(parent) AS parent, min(conv_id) AS conv_id, count(*) AS n, any_value(words) AS words,
  sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
 FROM rows GROUP BY d, prefix),
counted AS (SELECT v.*, (SELECT count(*) FROM nodes c WHERE c.parent = v.prefix AND c.d = v.d + 1) AS n_children FROM nodes v),
below AS (
 SELECT a.d, a.prefix, sum((v.n - 1) * v.words) AS saved_tokens, sum(CASE WHEN v.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves
 FROM counted v JOIN rows a ON a.conv_id = v.conv_id AND a.d <= v.d GROUP BY a.d, a.prefix)
SELECT v.conv_id, v.d AS depth, p.conv_id AS parent_conv_id, v.n AS n_convs, v.n_children, b.n_leaves::BIGINT AS n_leaves, b.saved_tokens::BIGINT AS saved_tokens, v.ends_sha256
FROM counted v JOIN below b ON b.d = v.d AND b.prefix = v.prefix LEFT JOIN nodes p ON p.d = v.d - 1 AND p.prefix = v.parent
"""
