"""URL filters: rules, and a path-template tree per host for what no rule fits. DataFrame functions only.

The tree grows level by level; what all pages of a node share goes in one step, and pages at their end are set aside. Below a node, a path segment that looks like a number, or whose siblings
are mostly different from each other, becomes a wildcard. The other labelled siblings are put in order of
their share of blocked pages, in BINS steps, and neighbours whose shares do not differ significantly from
each other are merged into one branch; siblings without labels form one branch too. The pages that a
rule fits are the labelled ones. A template is rejected when its purity, the share of blocked among its
labelled pages, reaches the threshold. Purity is smoothed towards that of its parent, which is smoothed
in the same way; so a template without labels follows its nearest labelled ancestor, and a host without
any is allowed.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skyflow.llm.common import join_groups, materialize

#: (verdict, host and path)
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
_KEPT = ["page", "host", "path", "rule", "verdict", "blocked"]
#: Levels of the SQL; the tree itself grows as deep as the paths.
LEVELS = 3
VARIABLE_FROM = 8
BINS = 20
SMOOTHING, THRESHOLD, CHI2 = 4.0, 0.5, 3.84
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NUMBER = r"^[0-9]+(\.[a-z]+)?$"


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path): both empty for null and where ``://`` is missing."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    return F.translate(host, _UPPER, _LOWER), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict; null where none does. Ties go to the longer host, then by text."""
    rule = verdict = None
    for what, text in sorted(rules, key=lambda r: (-len(r[1]), -r[1].index("/"), r[1])):
        own, _, start = text.partition("/")
        fits = ((host == own) | host.endswith("." + own)) & path.startswith("/" + start)
        rule = F.when(fits, text) if rule is None else rule.when(fits, text)
        verdict = F.when(fits, what) if verdict is None else verdict.when(fits, what)
    none = F.lit(None).cast("string")
    return (none, none) if rule is None else (rule.otherwise(none), verdict.otherwise(none))


def _branches(kids: DataFrame) -> DataFrame:
    """For each node, the branch of each step of shares among its labelled children: at most BINS + 1 rows a node."""
    named = kids.filter((F.col("l") > 0) & ~F.col("seg").rlike(NUMBER))
    bins = named.groupBy("node", F.floor(BINS * F.col("b") / F.col("l") + 0.5).cast("int").alias("bin")).agg(F.sum("l").alias("l"), F.sum("b").alias("b"), F.count("*").alias("segs"))
    in_order = Window.partitionBy("node").orderBy("bin")
    bins = bins.withColumn("l0", F.lag("l").over(in_order)).withColumn("b0", F.lag("b").over(in_order))
    p = (F.col("b") + F.col("b0")) / (F.col("l") + F.col("l0"))
    differs = F.pow(F.col("b") / F.col("l") - F.col("b0") / F.col("l0"), 2) > CHI2 * p * (1 - p) * (1 / F.col("l") + 1 / F.col("l0")) + 1e-9
    bins = bins.withColumn("branch", F.sum(F.coalesce(differs.cast("int"), F.lit(0))).over(in_order.rowsBetween(Window.unboundedPreceding, 0)))
    bins = bins.withColumn("segs", F.sum("segs").over(Window.partitionBy("node", "branch")))
    entry = F.struct(F.col("bin"), F.struct(F.col("branch"), F.col("segs")))
    return bins.groupBy("node").agg(F.map_from_entries(F.collect_list(entry)).alias("branches"))


def _chains(rows: DataFrame, total: int) -> DataFrame:
    """Move the rows of every node, which all have segments left, down the segments that they all share."""
    nodes = rows.groupBy("node").agg(
        F.count("*").alias("n"), F.count("blocked").alias("l"), F.coalesce(F.sum("blocked"), F.lit(0)).alias("b"), F.first("prior").alias("prior"), F.min("segs").alias("low"), F.max("segs").alias("high")
    )
    apart = F.array_position(F.zip_with("low", "high", lambda x, y: x.eqNullSafe(y)), False)  # the shorter ends apart from the longer
    nodes = nodes.withColumn("shared", F.when(apart > 0, apart - 1).otherwise(F.size("low")).cast("int"))
    prior = F.aggregate(F.slice("low", 1, F.col("shared")), F.col("prior"), lambda p, _: (F.col("b") + SMOOTHING * p) / (F.col("l") + SMOOTHING))
    found = join_groups(rows.drop("prior"), nodes.select("node", F.col("n").alias("n_node"), "shared", prior.alias("prior")), "node", "n_node", total)
    passed = F.transform(F.slice("segs", 1, F.col("shared")), lambda s: F.when(s.rlike(NUMBER), "*").otherwise(s))
    segs = F.slice("segs", F.col("shared") + 1, F.size("segs"))
    return found.select(*_KEPT, segs.alias("segs"), F.concat_ws("/", "node", passed).alias("node"), "prior")


def _level(going: DataFrame, total: int) -> DataFrame:
    """Move rows, which all have segments left, to their child node."""
    going = going.withColumn("seg", F.element_at("segs", 1)).withColumn("key", F.concat_ws("\n", "node", "seg"))
    kids = going.groupBy("key").agg(F.first("node").alias("node"), F.first("seg").alias("seg"), F.first("prior").alias("prior"), F.count("*").alias("n"), F.count("blocked").alias("l"), F.coalesce(F.sum("blocked"), F.lit(0)).alias("b"))
    kids = materialize(kids, "url-kids")
    homes = kids.groupBy("node").agg(F.count("*").alias("kids"), F.sum("n").alias("pn"), F.sum("l").alias("pl"), F.sum("b").alias("pb"))
    both = join_groups(kids, homes.join(_branches(kids), "node", "left"), "node", "kids", kids.count())
    wild = F.col("seg").rlike(NUMBER) | ((F.col("kids") >= VARIABLE_FROM) & (2 * F.col("kids") >= F.col("pn")))
    branch = F.col("branches")[F.floor(BINS * F.col("b") / F.col("l") + 0.5).cast("int")]
    alone = F.when(F.col("l") > 0, branch["segs"] == 1).otherwise(F.col("kids") == 1)
    own = F.when(wild, "*").when(alone, F.col("seg")).when(F.col("l") > 0, F.concat(F.lit("~"), branch["branch"].cast("string"))).otherwise("~")
    prior = (F.col("pb") + SMOOTHING * F.col("prior")) / (F.col("pl") + SMOOTHING)
    moved = both.select("key", F.col("n").alias("n_key"), F.concat_ws("/", "node", own).alias("child"), prior.alias("prior"))
    found = join_groups(going.drop("node", "prior"), moved, "key", "n_key", total)
    return found.select(*_KEPT, F.slice("segs", 2, F.size("segs")).alias("segs"), F.col("child").alias("node"), "prior")


def _set_aside(rows: DataFrame, done: list[DataFrame]) -> DataFrame:
    """The rows that have segments left; the others are at their template."""
    done.append(rows.filter(F.size("segs") == 0).select(*_KEPT, "node", "prior"))
    return rows.filter(F.size("segs") > 0)


def filter_urls(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES) -> DataFrame:
    """Judge every URL by rule, else by its template.

    Returns one row for each input row: the id, ``host``, ``path``, ``rule`` (null if none fits),
    ``verdict``, ``template``, ``purity``. Null, empty and malformed URLs have an empty host and path,
    fit no rule and are allowed. Repeated rows count each; an empty table gives an empty result; other
    columns are ignored. The tree is as deep as the longest path, but takes a round only for each depth at which
    paths part: segments that all pages of a node share are passed at once.
    """
    url = pages[url_col].cast("string")
    host, path = split_url(url)
    rows = pages.select(pages[id_col].alias("page"), host.alias("host"), path.alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    rows = rows.withColumn("rule", rule).withColumn("verdict", verdict).withColumn("blocked", (F.col("verdict") == "block").cast("int"))
    segs = F.filter(F.split("path", "/"), lambda s: s != "")
    rows = materialize(rows.withColumn("segs", segs).withColumn("node", F.col("host")).withColumn("prior", F.lit(0.0)), "url-rows")
    total, done, open_rows = rows.count(), [], rows
    while n := (open_rows := _set_aside(open_rows, done)).count():
        open_rows = _set_aside(materialize(_chains(open_rows, n), "url-rows"), done)
        open_rows = materialize(_level(open_rows, n), "url-rows")
    rows = reduce(DataFrame.unionByName, done)
    stats = rows.groupBy("node").agg(F.count("*").alias("n"), F.count("blocked").alias("l"), F.coalesce(F.sum("blocked"), F.lit(0)).alias("b"))
    found = join_groups(rows, stats, "node", "n", total)
    purity = (F.col("b") + SMOOTHING * F.col("prior")) / (F.col("l") + SMOOTHING)
    judged = F.when(purity >= THRESHOLD, "block").otherwise("allow")
    return found.select(F.col("page").alias(id_col), "host", "path", "rule", F.coalesce("verdict", judged).alias("verdict"), F.col("node").alias("template"), F.round(purity, 6).alias("purity"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def _oracle() -> str:
    order = sorted(RULES, key=lambda r: (-len(r[1]), -r[1].index("/"), r[1]))
    fits = [(f"(host = '{t.partition('/')[0]}' OR ends_with(host, '.{t.partition('/')[0]}')) AND starts_with(path, '/{t.partition('/')[2]}')", w, t) for w, t in order]
    rule, verdict = (f"CASE {' '.join(f"WHEN {c} THEN '{(w, t)[k]}'" for c, w, t in fits)} END" for k in (1, 0))
    sql = f"""
WITH u AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
hp AS (SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), '{_UPPER}', '{_LOWER}') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
r0 AS (SELECT *, {rule} AS rule, {verdict} AS verdict, list_filter(string_split(path, '/'), lambda s: s <> '') AS segs, host AS node, 0.0::double AS prior FROM hp)"""
    for k in range(1, LEVELS + 1):
        sql += f""",
k{k} AS (SELECT node, segs[{k}] AS seg, regexp_matches(seg, '{NUMBER}') AS numeral, any_value(prior) AS prior, count(*) AS n, count(verdict) AS l, count(*) FILTER (verdict = 'block') AS b,
  CASE WHEN l > 0 THEN floor({BINS} * b / l + 0.5)::int END AS bin FROM r{k - 1} WHERE len(segs) >= {k} GROUP BY node, seg),
h{k} AS (SELECT node, count(*) AS kids, sum(n) AS pn, sum(l) AS pl, sum(b) AS pb FROM k{k} GROUP BY node),
b{k} AS (SELECT *, lag(l) OVER w AS l0, lag(b) OVER w AS b0, (b + b0) / (l + l0) AS p
  FROM (SELECT node, bin, sum(l) AS l, sum(b) AS b, count(*) AS segs FROM k{k} WHERE l > 0 AND NOT numeral GROUP BY node, bin) WINDOW w AS (PARTITION BY node ORDER BY bin)),
g{k} AS (SELECT node, bin, segs, sum(CASE WHEN pow(b / l - b0 / l0, 2) > {CHI2} * p * (1 - p) * (1 / l + 1 / l0) + 1e-9 THEN 1 ELSE 0 END) OVER (PARTITION BY node ORDER BY bin) AS branch FROM b{k}),
e{k} AS (SELECT node, bin, branch, sum(segs) OVER (PARTITION BY node, branch) AS segs FROM g{k}),
m{k} AS (SELECT node, seg, node || '/' || CASE WHEN numeral OR (kids >= {VARIABLE_FROM} AND 2 * kids >= pn) THEN '*' WHEN CASE WHEN l > 0 THEN e.segs = 1 ELSE kids = 1 END THEN seg
  WHEN l > 0 THEN '~' || e.branch::int ELSE '~' END AS child, (pb + {SMOOTHING} * prior) / (pl + {SMOOTHING}) AS p FROM k{k} JOIN h{k} USING (node) LEFT JOIN e{k} e USING (node, bin)),
r{k} AS (SELECT page_id, host, path, rule, verdict, segs, coalesce(child, r.node) AS node, coalesce(p, prior) AS prior
  FROM r{k - 1} r LEFT JOIN m{k} m ON r.node = m.node AND segs[{k}] = m.seg)"""
    return sql + f""",
t AS (SELECT node, count(verdict) AS l, count(*) FILTER (verdict = 'block') AS b FROM r{LEVELS} GROUP BY node),
s AS (SELECT *, (b + {SMOOTHING} * prior) / (l + {SMOOTHING}) AS pure FROM r{LEVELS} JOIN t USING (node))
SELECT page_id, host, path, rule, coalesce(verdict, CASE WHEN pure >= {THRESHOLD} THEN 'block' ELSE 'allow' END) AS verdict, node AS template, round(pure, 6) AS purity FROM s
"""


ORACLE = _oracle()
