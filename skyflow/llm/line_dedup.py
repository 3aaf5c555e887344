"""Line dedup: segment-partition edit join over the distinct lines, DataFrame functions only.

With an edit threshold of one, a line is split into threshold-plus-one = two segments. Of two lines one
edit apart, one segment is untouched: it begins both lines or ends both. So a line of length l is
indexed by (l, first half) and (l, second half), and a line of length l or l + 1 probes with its own
beginning and end of these lengths. Small groups under one key give candidate pairs, which a banded
bit-parallel edit distance verifies. In a large group the region outside the untouched segment is split again in
the same way, until groups are small or the region is so short that the lines must match: a line is
then a repeat unless it is the group's first. So no group, however common its segment, is paired
with itself.

Exact repeats of any length are joined first, by digest; only lines of NEAR_CHARS or more are searched for
near ones, as one character is much of a shorter line. Each distinct line is known by the place where it occurs first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skyflow.llm.common import join_groups, materialize, text_of

MIN_CHARS, NEAR_CHARS = 1, 20
SMALL_GROUP = 16
BROADCAST_ROWS = 1_000_000


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = text_of(docs, text_col)
    return docs.select(docs[id_col].alias("id"), F.xxhash64(docs[id_col], text).alias("key"), text.alias("text"))


def _lines(keyed: DataFrame) -> DataFrame:
    return keyed.select("id", "key", F.posexplode(F.split("text", "\n")).alias("at", "line")).withColumn("line", F.trim("line", F.lit(" \t\r\x0b\x0c")))


def within_edits(a: Column, b: Column, k: int) -> Column:
    """Whether ``a`` and ``b``, which hold no newline, are at most ``k`` (1 to 31) edits apart.

    Bit d of the state r_e says that the characters of ``b`` so far can be had from d - k more of ``a``
    with e edits. A character of ``b`` meets 2 k + 1 of ``a`` at once: matches stay on their diagonal,
    and each edit moves bits by one place or none.
    """
    # arrays are made once and met element by element; inside a lambda they would be made again each time
    padded, chars = F.split(F.concat(F.lit("\n" * k), a), ""), F.split(b, "")
    full, names = (1 << 2 * k + 1) - 1, [f"r{e}" for e in range(k + 1)]

    def same(t: int) -> Column:
        bit, none = F.lit(1 << t).cast("long"), F.lit(0).cast("long")
        return F.zip_with(F.slice(padded, F.lit(t + 1), F.char_length(b)), chars, lambda x, y: F.when(x.eqNullSafe(y), bit).otherwise(none))

    here = [same(t) for t in range(2 * k + 1)]
    matches = here[0]
    for m in here[1:]:
        matches = F.zip_with(matches, m, lambda x, y: x.bitwiseOR(y))

    def step(r: Column, m: Column) -> Column:
        new = [r["r0"].bitwiseAND(m)]
        for e in range(1, k + 1):
            less = r[f"r{e - 1}"]
            moved = less.bitwiseOR(F.shiftright(less, 1)).bitwiseOR(F.shiftleft(new[-1], 1)).bitwiseAND(F.lit(full).cast("long"))
            new.append(r[f"r{e}"].bitwiseAND(m).bitwiseOR(moved))
        return F.struct(*(x.alias(n) for x, n in zip(new, names)))

    first = F.struct(*(F.lit(((2 << e) - 1) << k).cast("long").alias(n) for e, n in enumerate(names)))
    more = F.char_length(a) - F.char_length(b) + k
    last = F.aggregate(matches, first, step, lambda r: r[f"r{k}"])
    last = F.when(F.char_length(b) == 0, F.lit(full).cast("long")).otherwise(last)
    return F.when(more.between(0, 2 * k), F.call_function("shiftright", last, more).bitwiseAND(1) == 1).otherwise(False)


def _marked(lines: DataFrame, min_chars: int, near_chars: int) -> DataFrame:
    """Every line's place, digest and the four keys of the first split: two as indexed, two as probe."""
    size = F.char_length("line")
    own = "xxhash64(size, 0, substring(line, 1, size div 2)), xxhash64(size, 1, substring(line, size div 2 + 1, size))"
    other = "xxhash64(size - 1, 0, substring(line, 1, (size - 1) div 2)), xxhash64(size - 1, 1, substring(line, (size - 1) div 2 + 2, size))"
    long = lines.withColumn("size", size).filter(F.col("size") >= min_chars)
    return long.select("id", "key", "at", F.unhex(F.md5(F.col("line").cast("binary"))).alias("mark"), F.expr(f"if(size >= {near_chars}, array({own}, {other}), null)").alias("keys"))


def _texts(keyed: DataFrame, wanted: DataFrame) -> DataFrame:
    """Text of the wanted distinct lines (``lid``, ``first``), read at their first place."""
    places = wanted.select("lid", F.col("first.id").alias("own"), F.col("first.key").alias("key"), F.col("first.at").alias("at"))
    few = wanted.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS  # the check; beyond it the join is shuffled
    keys = places.select("key").distinct()
    rows = _lines(keyed.join(F.broadcast(keys) if few else keys, "key", "left_semi"))
    return rows.join(F.broadcast(places) if few else places, ["key", "at"]).filter(F.col("id").eqNullSafe(F.col("own"))).groupBy("lid").agg(F.first("line").alias("line"))


def _grouped(rows: DataFrame) -> DataFrame:
    """Rows whose key joins an indexed line with another, and how many it joins."""
    sizes = rows.groupBy("key").agg(F.count("*").alias("members"), F.min("probe").alias("none")).filter("members > 1 and not none").select("key", "members")
    return join_groups(rows, materialize(sizes, "line-sizes"), "key", "members", rows.count())


def _pairs(groups: DataFrame) -> DataFrame:
    """Pairs (``a`` indexed, ``b``) within the small groups."""
    before = Window.partitionBy("key").orderBy("probe", "lid").rowsBetween(-SMALL_GROUP, -1)
    small = groups.filter(F.col("members") <= SMALL_GROUP).withColumn("others", F.collect_list(F.struct(F.col("lid").alias("a"), F.col("probe").alias("as_probe"))).over(before))
    return small.select(F.col("lid").alias("b"), F.inline("others")).filter("not as_probe and a <> b").select("a", "b").distinct()


def _first_regions(large: DataFrame, texts: DataFrame) -> DataFrame:
    """After the first split: what lies between ``lo`` and ``hi`` is not matched; in an indexed line it has ``r`` characters."""
    base = large.join(texts, "lid").withColumn("size", F.char_length("line")).withColumn("l", F.when(F.col("probe"), F.col("size") - 1).otherwise(F.col("size")))
    begins = F.col("key") == F.expr("xxhash64(l, 0, substring(line, 1, l div 2))")
    half = F.expr("cast(l div 2 as int)")
    rest = F.col("l") - half
    return base.select("lid", "line", "probe", "key", F.when(begins, half).otherwise(0).alias("lo"), F.when(begins, F.col("size")).otherwise(F.col("size") - rest).alias("hi"), F.when(begins, rest).otherwise(half).alias("r"))


def _split(regions: DataFrame) -> DataFrame:
    """Match the first or the second half of each region and leave the other."""
    df = regions.filter("r >= 1").withColumn("one", F.expr("cast(greatest(1, r div 2) as int)")).withColumn("two", F.expr("cast(greatest(1, r - r div 2) as int)"))
    begins = F.struct(F.expr("xxhash64(key, 0, substring(line, lo + 1, one))").alias("key"), F.expr("lo + one").alias("lo"), F.col("hi").alias("hi"), F.expr("r - one").alias("r"))
    ends = F.struct(F.expr("xxhash64(key, 1, substring(line, hi - two + 1, two))").alias("key"), F.col("lo").alias("lo"), F.expr("hi - two").alias("hi"), F.expr("r - two").alias("r"))
    return df.withColumn("kid", F.explode(F.array(begins, ends))).select("lid", "line", "probe", "kid.*")


def _must_match(regions: DataFrame, places: DataFrame) -> DataFrame:
    """Repeats in groups that differ in one character at one place, or in one character more."""
    df = regions.filter("r <= 1").select("lid", "key", "probe", "r").join(places, "lid")
    least = df.groupBy("key").agg(F.min(F.when(~F.col("probe"), F.col("first"))).alias("own"), F.min(F.when(F.col("probe"), F.col("first"))).alias("other"))
    return df.join(least, "key").filter("(r = 1 and not probe and first > own) or (r = 0 and probe and first > own) or (r = 0 and not probe and first > other)").select("lid")


def _near_repeats(keyed: DataFrame, distinct: DataFrame) -> DataFrame:
    """``lid`` of every distinct line that has another within one edit whose first place is earlier."""
    rows = distinct.select("lid", F.posexplode("keys").alias("k", "key")).select("lid", "key", (F.col("k") >= 2).alias("probe"))
    groups = materialize(_grouped(materialize(rows, "line-keys")), "line-groups")
    texts = materialize(_texts(keyed, groups.select("lid").distinct().join(distinct.select("lid", "first"), "lid")), "line-texts")
    places = distinct.select("lid", "first")
    known = texts.join(places, "lid")
    a, b = (known.select(*(F.col(c).alias(f"{c}_{x}") for c in ("lid", "line", "first"))) for x in "ab")
    hits, regions = [], None
    while True:
        close = _pairs(groups).join(a, F.col("a") == F.col("lid_a")).join(b, F.col("b") == F.col("lid_b")).filter(within_edits(F.col("line_a"), F.col("line_b"), 1))
        hits.append(materialize(close.select(F.when(F.col("first_a") < F.col("first_b"), F.col("b")).otherwise(F.col("a")).alias("lid")), "line-hits"))
        large = groups.filter(F.col("members") > SMALL_GROUP).select("lid", "key", "probe")
        if not large.limit(1).count():
            break
        regions = _first_regions(large, texts) if regions is None else regions.join(large, ["lid", "key", "probe"], "left_semi")
        regions = materialize(regions, "line-regions")
        hits.append(materialize(_must_match(regions, places), "line-hits"))
        regions = _split(regions)
        regions = materialize(regions, "line-regions")
        groups = materialize(_grouped(regions.select("lid", "key", "probe")), "line-groups")
    out = hits[0]
    for h in hits[1:]:
        out = out.unionByName(h)
    return out.distinct()


def repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS, near_chars: int = NEAR_CHARS) -> DataFrame:
    """Places (``id``, ``key``, ``at``) of lines that repeat an earlier one, exactly or within one edit."""
    keyed = _keyed(docs, id_col, text_col)
    marked = materialize(_marked(_lines(keyed), min_chars, near_chars), "line-marks")
    firsts = marked.groupBy("mark").agg(F.min(F.struct("id", "key", "at")).alias("first"), F.count("*").alias("n"), F.first("keys").alias("keys"))
    distinct = materialize(firsts.withColumn("lid", F.monotonically_increasing_id()), "line-distinct")
    near = _near_repeats(keyed, distinct).withColumn("near", F.lit(True))
    groups = materialize(distinct.select("lid", "mark", "first", "n").join(near, "lid", "left").filter("n > 1 or near").select("mark", "first", "n", F.coalesce("near", F.lit(False)).alias("near")), "line-repeats")
    found = join_groups(marked.select("mark", "id", "key", "at"), groups, "mark", "n", distinct.count())
    return found.filter(F.col("near") | ~F.struct("id", "key", "at").eqNullSafe(F.col("first"))).select("id", "key", "at")


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS, near_chars: int = NEAR_CHARS) -> DataFrame:
    """Drop every line that repeats an earlier line exactly or within one character edit.

    Lines are split at newlines and compared without white space at their ends. Lines of fewer than
    ``min_chars`` characters (blank ones by default) always stay; lines of fewer than ``near_chars``
    go as exact repeats only. Earlier means a smaller id (null first), then the earlier
    line; a line stays unless a line within one edit first occurs earlier. Returns the input's columns
    with the text rewritten, and ``n_lines`` and ``n_dropped``: one row for each input row, null and
    empty texts included (one empty line, nothing dropped; null stays null). Rows that repeat an id and
    text drop the same lines. Input columns named n_lines or n_dropped are replaced.
    """
    drops = repeated_lines(docs, id_col, text_col, min_chars, near_chars).distinct().groupBy("id", "key").agg(F.collect_set("at").alias("__drop")).withColumnsRenamed({"id": "__id", "key": "__key"})
    text = text_of(docs, text_col)
    keyed = docs.withColumn("__own", F.xxhash64(docs[id_col], text))
    joined = keyed.join(drops, (F.col("__own") == F.col("__key")) & docs[id_col].eqNullSafe(F.col("__id")), "left")
    parts, gone = F.split(text_of(joined, text_col), "\n"), F.col("__drop")
    kept = F.array_join(F.transform(F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), gone), lambda i: F.get(parts, i)), "\n")
    out = joined.withColumn("n_lines", F.size(parts).cast("long")).withColumn("n_dropped", F.coalesce(F.size(gone), F.lit(0)).cast("long")).withColumn(text_col, F.when(gone.isNull(), F.col(text_col)).otherwise(kept))
    return out.select(*docs.columns, *(c for c in ("n_lines", "n_dropped") if c not in docs.columns))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))


ORACLE = f"""
WITH parts AS (SELECT doc_id, string_split(text, chr(10)) AS p FROM documents),
occ AS (SELECT doc_id, i AS k, trim(translate(p[i], chr(9) || chr(13) || chr(11) || chr(12), '    ')) AS line FROM (SELECT doc_id, p, unnest(range(1, len(p) + 1)) AS i FROM parts)),
firsts AS (SELECT line, min((doc_id, k)) AS f, length(line) AS n FROM occ WHERE length(line) >= {MIN_CHARS} GROUP BY line),
near AS (
  SELECT DISTINCT x.line FROM firsts x JOIN firsts y ON y.n BETWEEN x.n - 1 AND x.n + 1 AND x.n >= {NEAR_CHARS} AND y.n >= {NEAR_CHARS} AND y.f < x.f
    AND (left(x.line, 9) = left(y.line, 9) OR right(x.line, 9) = right(y.line, 9)) AND levenshtein(x.line, y.line) <= 1
),
kept AS (
  SELECT occ.doc_id, occ.k, occ.line, f IS NULL OR ((doc_id, k) = f AND near.line IS NULL) AS keep
  FROM occ LEFT JOIN firsts USING (line) LEFT JOIN near ON occ.line = near.line
)
SELECT doc_id, coalesce(string_agg(p[k], chr(10) ORDER BY k) FILTER (keep), '') AS text, count(*) AS n_lines, count(*) FILTER (NOT keep) AS n_dropped
FROM kept JOIN parts USING (doc_id) GROUP BY doc_id
"""
