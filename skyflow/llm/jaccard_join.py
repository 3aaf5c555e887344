"""N-gram Jaccard join by T-occurrence search, and its connected components.

1. Every text becomes a set of shingle hashes; texts with equal sets form one class. A count sketch
   of fixed size over all shingles gives a global order, rare first.
2. Two sets with Jaccard similarity t or more share a shingle among the first n - ceil(t * n) + 1 of
   each in that order. Of each set (1 - t) / 2 * n more are indexed, so that linked sets share at least
   about as many. These go to inverted lists; lists with one member end here, and sets with too few
   shared shingles to reach the needed overlap with any partner leave.
3. Members of a short list are compared with each other where they share enough lists. The members of a
   long list are compared with its leader first. Those that are not linked to it are then searched in
   the leader's whole group, in blocks and by size, leaving out who is in their component already. So a
   large group of near copies takes a linear number of pairs, and no link between components is lost.
4. Comparing is T-occurrence search (DivideSkip): a query's inverted lists over a block of sets are
   divided; the short ones are merged, and who can still reach the needed overlap is looked up in the
   long ones by binary search.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skyflow.llm.common import connected_components, join_groups, materialize, shingle_sets, text_of, tune
from skyflow.llm.decontaminate import SHINGLES

SKETCH_BITS, SKETCH_PARTS = 22, 64
SHORT_LIST = 16
PRUNINGS = 2
BLOCK_SETS = 256
FILTER_BITS = 24
SEEN_CLASSES = 200_000
#: Up to so many classes a list of them is broadcast.
BROADCAST_CLASSES = 200_000


def needed_overlap(a, b, percent: int):
    """Least intersection of sets of a and b shingles: 100 * inter >= percent * union."""
    return -((-percent * (a + b)) // (100 + percent))


def _class_of(s: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(s.tobytes(), digest_size=8).digest(), "little", signed=True)


def _slot(tokens: np.ndarray) -> np.ndarray:
    return (tokens.view(np.uint64) >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)


def _signatures(docs: DataFrame, width: int) -> DataFrame:
    """For each document its set's size and class; for each task its part of the count sketch."""
    part = (1 << SKETCH_BITS) // SKETCH_PARTS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch, kind = np.zeros(1 << SKETCH_BITS, dtype=np.int32), None
        names = ["id", "n", "cls", "part", "counts"]
        for b in batches:
            kind, n, cls = b.column(0).type, [], []
            for s in shingle_sets(b.column(1), width):
                n.append(len(s))
                cls.append(_class_of(s) if len(s) else None)
                np.add.at(sketch, _slot(s), 1)
            none = pa.nulls(len(n))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(cls, pa.int64()), none.cast(pa.int32()), none.cast(pa.binary())], names)
        if kind is not None:
            none = pa.nulls(SKETCH_PARTS)
            yield pa.RecordBatch.from_arrays([pa.nulls(SKETCH_PARTS, kind), none.cast(pa.int64()), none.cast(pa.int64()), pa.array(range(SKETCH_PARTS), pa.int32()), pa.array([np.minimum(sketch[k * part : (k + 1) * part], 65535).astype(np.uint16).tobytes() for k in range(SKETCH_PARTS)], pa.binary())], names)

    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(run, f"id {kind}, n bigint, cls bigint, part int, counts binary")


def _sketch(parts: DataFrame) -> np.ndarray:
    """Sum the tasks' sketches part by part, streaming; its size does not depend on the data."""
    part = (1 << SKETCH_BITS) // SKETCH_PARTS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for b in batches:
            for k, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                total[k] = total.get(k, 0) + np.frombuffer(raw, dtype=np.uint16).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([np.minimum(x, 2**31 - 1).astype(np.int32).tobytes() for x in total.values()], pa.binary())], ["part", "counts"])

    out = np.zeros(1 << SKETCH_BITS, dtype=np.int32)
    for r in parts.select("part", "counts").repartition(SKETCH_PARTS, "part").mapInArrow(run, "part int, counts binary").collect():
        out[r["part"] * part : (r["part"] + 1) * part] = np.frombuffer(r["counts"], dtype=np.int32)
    return out


def _once(seen: set[int], cls: int) -> bool:
    """True for a class this task has not met lately; the memory of classes is bounded."""
    if cls in seen:
        return False
    if len(seen) >= SEEN_CLASSES:
        seen.clear()
    seen.add(cls)
    return True


def _postings(docs: DataFrame, width: int, percent: int, sketch) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, seen = sketch.value, set()
        for b in batches:
            tokens, cls, n, size = [], [], [], []
            for s in shingle_sets(b.column(1), width):
                if not len(s) or not _once(seen, c := _class_of(s)):
                    continue
                k = min(len(s), len(s) + (-percent * len(s)) // 100 + 1 + (100 - percent) * len(s) // 200)
                tokens.append(s[np.lexsort((s, counts[_slot(s)]))[:k]])
                cls.append(c)
                n.append(len(s))
                size.append(k)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(tokens) if tokens else [], pa.int64()), pa.array(np.repeat(np.array(cls, dtype=np.int64), size), pa.int64()), pa.array(np.repeat(np.array(n, dtype=np.int32), size), pa.int32())], ["token", "cls", "n"])

    return docs.mapInArrow(run, "token bigint, cls bigint, n int")


def _sets(docs: DataFrame, width: int, wanted: DataFrame) -> DataFrame:
    """The sets of the wanted classes. A bit filter of fixed size spares shuffling most others."""
    bits = np.zeros(1 << FILTER_BITS, dtype=bool)
    places = wanted.select((F.shiftrightunsigned("cls", 64 - FILTER_BITS)).alias("p")).distinct()
    blob = places.groupBy((F.col("p") / (1 << 16)).cast("int").alias("hi")).agg(F.collect_set((F.col("p") % (1 << 16)).cast("int")).alias("lo"))
    for r in blob.toLocalIterator():  # at most 2^FILTER_BITS places in all
        bits[np.array(r["lo"], dtype=np.int64) + (r["hi"] << 16)] = True
    shared = docs.sparkSession.sparkContext.broadcast(np.packbits(bits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed, seen = shared.value, set()
        for b in batches:
            cls, sets = [], []
            for s in shingle_sets(b.column(1), width):
                if len(s):
                    c = _class_of(s)
                    p = (c & (1 << 64) - 1) >> (64 - FILTER_BITS)
                    if packed[p >> 3] >> (7 - (p & 7)) & 1 and _once(seen, c):
                        cls.append(c)
                        sets.append(s.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(cls, pa.int64()), pa.array(sets, pa.binary())], ["cls", "items"])

    return docs.mapInArrow(run, "cls bigint, items binary").join(wanted.select("cls").distinct(), "cls", "left_semi").groupBy("cls").agg(F.first("items").alias("items"))


class BlockIndex:
    """Inverted lists over a block of sets."""

    def __init__(self, sets: list[np.ndarray]):
        owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        items = np.concatenate(sets)
        order = np.argsort(items, kind="stable")  # each list sorted by set
        self.n, self.owner = len(sets), owner[order]
        self.tokens, first = np.unique(items[order], return_index=True)
        self.first = np.append(first, len(items))

    def search(self, query: np.ndarray, least: np.ndarray) -> np.ndarray:
        """Overlap of the query with each set that reaches ``least[i]``, else -1 (DivideSkip)."""
        out = np.full(self.n, -1, dtype=np.int64)
        at = np.searchsorted(self.tokens, query)
        at[at == len(self.tokens)] = 0
        at = at[self.tokens[at] == query]
        bar = int(least.min())
        if len(at) < bar:
            return out
        size = self.first[at + 1] - self.first[at]
        at = at[np.argsort(size, kind="stable")]
        size = self.first[at + 1] - self.first[at]
        n_long = max(0, min(bar - 1, int(bar / (0.01 * np.log2(max(2, int(size[-1]))) + 1)))) if len(at) else 0
        short, ends = at[: len(at) - n_long], np.cumsum(size[: len(at) - n_long])
        total = int(ends[-1]) if len(ends) else 0
        place = np.arange(total) - np.repeat(ends - size[: len(short)], size[: len(short)]) + np.repeat(self.first[short], size[: len(short)])
        count = np.bincount(self.owner[place], minlength=self.n)  # the short lists, merged
        alive = np.flatnonzero(count >= least - n_long)
        for k, lst in enumerate(at[len(at) - n_long :][::-1]):
            if not len(alive):
                break
            own = self.owner[self.first[lst] : self.first[lst + 1]]
            p = np.searchsorted(own, alive)
            p[p == len(own)] = 0
            count[alive] += own[p] == alive
            alive = alive[count[alive] + (n_long - 1 - k) >= least[alive]]
        out[alive] = count[alive]
        return out


def compare(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Overlap of every pair (``q``, ``m``; sizes ``nq``, ``nm``) with similarity of ``percent`` or more.

    A query meets its partners in blocks, so one query with very many partners is spread too.
    """
    many = pairs.groupBy("q").agg(F.ceil(F.count("*") / BLOCK_SETS).cast("int").alias("blocks"))
    dealt = pairs.join(many, "q").withColumn("block", F.pmod(F.xxhash64("m"), F.col("blocks")).cast("int"))
    members = dealt.select(F.col("m").alias("cls"), "q", "block", "m", "nq", "nm")
    queries = many.select(F.col("q").alias("cls"), "q", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.lit(0).cast("bigint").alias("m"), F.lit(-1).alias("nq"), F.lit(-1).alias("nm"))
    rows = members.unionByName(queries).join(sets, "cls").select("q", "block", "m", "nq", "nm", "items")  # the sets are shuffled once for both

    def search(q: int, query: np.ndarray, rest: list[tuple[int, int, bytes]]) -> tuple[np.ndarray, ...]:
        m, nm = np.array([r[0] for r in rest], dtype=np.int64), np.array([r[1] for r in rest], dtype=np.int64)
        overlap = BlockIndex([np.frombuffer(r[2], dtype=np.int64) for r in rest]).search(query, needed_overlap(len(query), nm, percent))
        ok = overlap >= 0
        k = int(ok.sum())
        return np.full(k, q, dtype=np.int64), m[ok], np.full(k, len(query), dtype=np.int32), nm[ok].astype(np.int32), overlap[ok]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, query, rest, found = None, None, [], []

        def out() -> pa.RecordBatch:
            cols = [np.concatenate(c) for c in zip(*found)]
            found.clear()
            return pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["q", "m", "nq", "nm", "overlap"])

        for b in batches:
            for q, block, m, nq, nm, items in zip(*(c.to_pylist() for c in b.columns)):
                if (q, block) != at:
                    if rest:
                        found.append(search(at[0], query, rest))
                    at, query, rest = (q, block), None, []
                if nq < 0:
                    query = np.frombuffer(items, dtype=np.int64)
                else:
                    rest.append((m, nm, items))
            if len(found) > 1000:
                yield out()
        if rest:
            found.append(search(at[0], query, rest))
        if found:
            yield out()

    # a block's query comes first, then its members
    return rows.repartition("q", "block").sortWithinPartitions("q", "block", "nq").mapInArrow(run, "q bigint, m bigint, nq int, nm int, overlap bigint")


def search_groups(groups: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (``a``, ``b``) of the open members of each group with all its members of another label.

    ``groups`` has g, cls, n, label, open. Members lie in bands of size, so that linked ones are at most a
    band apart, and in blocks of BLOCK_SETS. Every open member is searched in the blocks of the bands
    around it; only links leave a block, never candidate pairs, however large a group is.
    """
    step = np.log(100 / percent)
    banded = groups.withColumn("band", F.floor(F.log("n") / step + 1e-9).cast("int"))
    blocks = banded.groupBy("g", "band").agg(F.ceil(F.count("*") / BLOCK_SETS).cast("int").alias("blocks"), F.max("open").alias("open_here"))
    asked = banded.filter("open").select("g", F.explode(F.sequence(F.col("band") - 1, F.col("band") + 1)).alias("band")).distinct()
    blocks = blocks.drop("open_here").join(asked, ["g", "band"])
    members = banded.join(blocks, ["g", "band"]).withColumn("block", F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int")).withColumn("asks", F.lit(False))
    queries = banded.filter("open").withColumn("band", F.explode(F.sequence(F.col("band") - 1, F.col("band") + 1))).join(blocks, ["g", "band"]).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumn("asks", F.lit(True))
    cols = ["g", "band", "block", "asks", "cls", "n", "label", "open"]
    rows = members.select(*cols).unionByName(queries.select(*cols)).join(sets, "cls").select(*cols, "items")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, index, held, found = None, None, [], []
        for b in batches:
            for g, band, block, asks, cls, n, label, is_open, items in zip(*(c.to_pylist() for c in b.columns)):
                if (g, band, block) != at:
                    at, index, held = (g, band, block), None, []
                if not asks:
                    held.append((cls, n, label, is_open, np.frombuffer(items, dtype=np.int64)))
                elif held:
                    if index is None:
                        index = BlockIndex([h[4] for h in held])
                        ids, sizes, labels, opens = (np.array([h[k] for h in held]) for k in range(4))
                    least = needed_overlap(n, sizes.astype(np.int64), percent)
                    least[(labels == label) | (opens & (ids <= cls))] = 1 << 40  # of two open members one asks
                    found.extend((cls, int(m)) for m in ids[index.search(np.frombuffer(items, dtype=np.int64), least) >= 0])
            if found:
                yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.int64()), pa.array([y for _, y in found], pa.int64())], ["a", "b"])
                found = []

    keys = ("g", "band", "block")
    return rows.repartition(*keys).sortWithinPartitions(*keys, "asks").mapInArrow(run, "a bigint, b bigint")


def _sized(a: str, b: str, percent: int):
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def _pairs(df: DataFrame) -> DataFrame:
    """Distinct pairs, the query being the smaller class, and how many lists each pair shares."""
    first = F.col("q") < F.col("m")
    return df.select(F.when(first, F.col("q")).otherwise(F.col("m")).alias("q"), F.when(first, F.col("m")).otherwise(F.col("q")).alias("m"), F.when(first, F.col("nq")).otherwise(F.col("nm")).alias("nq"), F.when(first, F.col("nm")).otherwise(F.col("nq")).alias("nm")).groupBy("q", "m", "nq", "nm").agg(F.count("*").alias("shared"))


def _beyond(n: str, percent: int):
    """Shingles of a set of n that are not among its indexed ones."""
    return F.expr(f"greatest(0, ({percent} * {n} + 99) div 100 - 1 - ({100 - percent} * {n}) div 200)")


def _prune(lists: DataFrame, percent: int) -> DataFrame:
    """Leave out classes with too few shared shingles to reach the needed overlap with any size of partner."""
    by_cls = Window.partitionBy("cls")
    kept = lists.withColumn("own", F.count("*").over(by_cls)).filter(F.col("own") >= F.expr(f"({100 - percent} * n) div 200 - 2")).select("token", "cls", "n")
    return materialize(kept.withColumn("members", F.count("*").over(Window.partitionBy("token"))).filter("members > 1"), "jaccard-lists")


def _can_reach(pairs: DataFrame, lists: DataFrame, short_list: int, percent: int) -> DataFrame:
    """Pairs that can still reach the needed overlap.

    All common shingles up to the end of the prefix that ends first are common to both prefixes: those
    in short lists are counted, those in long lists are at most as many as either set has there.
    The rest lies beyond that prefix.
    """
    many = lists.filter(F.col("members") > short_list).groupBy("cls").agg(F.count("*").alias("long"))
    both = pairs.join(many.select(F.col("cls").alias("q"), F.col("long").alias("lq")), "q", "left").join(many.select(F.col("cls").alias("m"), F.col("long").alias("lm")), "m", "left")
    seen = F.col("shared") + F.least(F.coalesce("lq", F.lit(0)), F.coalesce("lm", F.lit(0)))
    beyond = F.greatest(_beyond("nq", percent), _beyond("nm", percent))
    return both.filter(seen + beyond >= F.expr(f"({percent} * (nq + nm) + {99 + percent}) div {100 + percent}")).select("q", "m", "nq", "nm")


class Components:
    """Components of the links so far; new links are contracted to the known labels first."""

    def __init__(self, spark: SparkSession):
        self.labels = spark.range(0).select(F.col("id").alias("v"), F.col("id").alias("label"))

    def of(self, df: DataFrame, cls: str, label: str) -> DataFrame:
        return df.join(self.labels.select(F.col("v").alias(cls), F.col("label").alias(label)), cls, "left").withColumn(label, F.coalesce(label, cls))

    def add(self, links: DataFrame) -> None:
        ends = self.of(self.of(links.select("a", "b"), "a", "la"), "b", "lb")
        new = materialize(ends.select("a", "b", "la", "lb").filter("la <> lb"), "jaccard-contracted")
        if not new.limit(1).count():
            return
        joined = connected_components(new.select(F.col("la").alias("a"), F.col("lb").alias("b")))
        known = self.labels.unionByName(joined.join(self.labels.select(F.col("v")), "v", "left_anti"))
        up = joined.select(F.col("v").alias("label"), F.col("label").alias("above"))
        self.labels = materialize(known.join(up, "label", "left").select("v", F.coalesce("above", "label").alias("label")), "jaccard-labels")


def class_components(docs: DataFrame, width: int, percent: int, sketch: np.ndarray) -> DataFrame:
    """Labels (``v``, ``label``) of all classes that are linked to another."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(sketch)
    by_token = Window.partitionBy("token")
    rows = _postings(docs, width, percent, shared).repartition("token").groupBy("token", "cls").agg(F.first("n").alias("n"))
    lists = materialize(rows.withColumn("members", F.count("*").over(by_token)).filter("members > 1"), "jaccard-lists")
    for _ in range(PRUNINGS):
        lists = _prune(lists, percent)
    short_lists, long_lists = lists.filter(F.col("members") <= SHORT_LIST), lists.filter(F.col("members") > SHORT_LIST)
    others = F.collect_list(F.struct(F.col("cls").alias("q"), F.col("n").alias("nq"))).over(by_token.orderBy("cls").rowsBetween(-SHORT_LIST, -1))
    short = short_lists.withColumn("others", others).select(F.col("cls").alias("m"), F.col("n").alias("nm"), F.inline("others")).filter(_sized("nq", "nm", percent))
    pairs = materialize(_can_reach(_pairs(short), lists, SHORT_LIST, percent), "jaccard-pairs")
    # every long list has one leader; who shares a list shares its leader
    lead = F.min(F.struct(F.xxhash64("cls").alias("h"), "cls", "n")).alias("lead")
    groups = materialize(long_lists.join(long_lists.groupBy("token").agg(lead), "token").select(F.col("lead.cls").alias("g"), F.col("lead.n").alias("ng"), "cls", "n").distinct().filter("g <> cls"), "jaccard-led")
    wanted = pairs.select(F.col("q").alias("cls")).unionByName(pairs.select(F.col("m").alias("cls"))).unionByName(groups.select("cls")).unionByName(groups.select(F.col("g").alias("cls")))
    sets = materialize(_sets(docs, width, wanted), "jaccard-sets")
    star = groups.filter(_sized("ng", "n", percent)).select(F.col("g").alias("q"), F.col("cls").alias("m"), F.col("ng").alias("nq"), F.col("n").alias("nm"))
    links = materialize(compare(pairs.unionByName(star).dropDuplicates(["q", "m"]), sets, percent).select(F.col("q").alias("a"), F.col("m").alias("b")), "jaccard-links")
    led = links.join(star.select(F.col("q").alias("a"), F.col("m").alias("b")), ["a", "b"], "left_semi")
    known = Components(spark)
    known.add(links)
    # who is not linked to the leader, against the leader's whole group in other components
    linked = led.select(F.col("a").alias("g"), F.col("b").alias("cls"), F.lit(True).alias("linked"))
    state = known.of(groups.join(linked, ["g", "cls"], "left"), "cls", "label").select("g", "cls", "n", "label", F.col("linked").isNull().alias("open"))
    mixed = state.groupBy("g").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo <> hi").select("g")
    state = materialize(state.join(mixed, "g", "left_semi"), "jaccard-state")
    asked = materialize(state.select("cls").distinct(), "jaccard-asked")
    n = asked.count()
    if n:  # few classes are picked where the sets lie; many are left to the join of the search
        known.add(search_groups(state, sets.join(F.broadcast(asked), "cls", "left_semi") if n <= BROADCAST_CLASSES else sets, percent))
    return known.labels


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """Group texts linked by a Jaccard similarity of ``percent`` or more between their shingle sets.

    Words are split at ASCII white space, A-Z lower-cased. A text of fewer than ``width`` words is one
    shingle; null, empty and blank texts have no shingles and no links. Returns one row for each input
    row: the id, ``n_shingles``, ``component_id`` (the smallest id in its component; its own id for
    texts without shingles). Repeated rows are copies of each other. Null ids join a component under
    its smallest id. An empty table gives an empty result; other columns are ignored.
    """
    tune(docs.sparkSession)
    texts = docs.select(docs[id_col].alias("id"), text_of(docs, text_col).alias("text"))
    marked = materialize(_signatures(texts, width), "jaccard-signatures")
    rows = marked.filter("part is null").select("id", "n", "cls")
    labels = class_components(texts, width, percent, _sketch(marked.filter("part is not null")))
    classes = rows.filter("n > 0").groupBy("cls").agg(F.min("id").alias("least"), F.count("*").alias("copies"))
    labelled = classes.join(labels.withColumnRenamed("v", "cls"), "cls", "left").withColumn("label", F.coalesce("label", "cls"))
    least = labelled.groupBy("label").agg(F.min("least").alias("component_id"))
    groups = materialize(labelled.join(least, "label").select("cls", "copies", "component_id"), "jaccard-groups")
    found = join_groups(rows.filter("n > 0"), groups, "cls", "copies", rows.count()).select("id", "n", "component_id")
    alone = rows.filter("n = 0").select("id", "n", F.col("id").alias("component_id"))
    return found.unionByName(alone).select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(spark.read.parquet(f"{sf_dir}/documents.parquet"))


ORACLE = f"""
WITH RECURSIVE s AS MATERIALIZED ({SHINGLES.format(id="doc_id", table="documents")}),
n AS MATERIALIZED (SELECT doc_id, count(s) AS n FROM documents LEFT JOIN s USING (doc_id) GROUP BY doc_id),
pairs AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL),
links AS MATERIALIZED (SELECT a, b FROM pairs JOIN n na ON a = na.doc_id JOIN n nb ON b = nb.doc_id WHERE 100 * c >= 80 * (na.n + nb.n - c)),
reach AS (SELECT doc_id, doc_id AS other FROM documents UNION SELECT reach.doc_id, b FROM reach JOIN links ON other = a)
SELECT doc_id, n AS n_shingles, component_id FROM n JOIN (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id) USING (doc_id)
"""
