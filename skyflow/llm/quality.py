"""Quality classifier: a sparse rule ensemble compiled into Spark columns.

Statistics of every whole text are computed in Arrow functions. On a bounded sample of labelled rows,
small trees are grown on bootstrap rows; every path from a root to a node is a rule, a conjunction of
comparisons. A lasso logistic regression keeps few of them, and these are compiled into column
expressions over the statistics, so scoring is plain Spark.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyflow.llm.common import hash_spans, id_crc_mod, materialize, string_buffers, text_of, tune, word_spans

FOLDS, HELD_OUT = 4, 2
#: Labelled training rows used for the fit, chosen by hash of the id.
SAMPLE_ROWS = 20_000
TREES, DEPTH, LEAF, BINS = 24, 3, 5, 16
#: Rows that each tree draws from the sample, with repetition; trees only propose rules, the weights are fitted on the whole sample.
TREE_ROWS = 4000
LASSO = 0.002
THRESHOLD = 0.7

_SETS = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "lower": b"abcdefghijklmnopqrstuvwxyz", "digit": b"0123456789", "stop": b".", "comma": b",", "mark": b"!?", "bar": b"|", "symbol": b"#$%&*@^~=+<>{}[]\\/_", "line": b"\n", "space": b" \t",
}
STATISTICS = [f"{k}_share" for k in _SETS] + ["words", "word_length", "distinct_share", "top_share", "short_share", "lines", "line_words", "repeated_lines", "mark_words", "capital_words"]


def _statistics(col: pa.Array) -> np.ndarray:
    """One row of STATISTICS for each text; zeros for texts without words."""
    raw, offsets = string_buffers(col)
    n = len(col)
    size = np.diff(offsets)
    out = np.zeros((n, len(STATISTICS)))

    def per_text(flags: np.ndarray) -> np.ndarray:
        cum = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
        return cum[offsets[1:]] - cum[offsets[:-1]]

    for k, chars in enumerate(_SETS.values()):
        lut = np.zeros(256, dtype=bool)
        lut[list(chars)] = True
        out[:, k] = per_text(lut[raw]) / np.maximum(size, 1)
    starts, ends = word_spans(raw, offsets)
    lens, first = ends - starts, np.searchsorted(starts, offsets)
    count = np.diff(first)
    words, has = np.maximum(count, 1), count > 0
    hashes = hash_spans(raw, starts, ends)
    at = len(_SETS)

    def per_word(flags: np.ndarray) -> np.ndarray:
        cum = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
        return (cum[first[1:]] - cum[first[:-1]]) / words

    last = raw[ends - 1] if len(ends) else raw[:0]
    capital = (raw[starts] >= 65) & (raw[starts] <= 90) if len(starts) else np.zeros(0, dtype=bool)
    out[:, at], out[:, at + 1], out[:, at + 4] = count, per_word(lens), per_word(lens <= 3)
    out[:, at + 8] = per_word(~((last >= 97) & (last <= 122) | (last >= 65) & (last <= 90) | (last >= 128) | (last == 44) | (last == 46)))
    out[:, at + 9] = per_word(capital)
    breaks = np.flatnonzero(raw == 10)
    for i in np.flatnonzero(has):
        own = np.unique(hashes[first[i] : first[i + 1]], return_counts=True)[1]
        out[i, at + 2], out[i, at + 3] = len(own) / count[i], own.max() / count[i]
        lo, hi = offsets[i], offsets[i + 1]
        edges = np.concatenate(([lo - 1], breaks[np.searchsorted(breaks, lo) : np.searchsorted(breaks, hi)], [hi]))
        out[i, at + 5] = len(edges) - 1
        out[i, at + 6] = count[i] / (len(edges) - 1)
        if len(edges) > 2:
            body = raw[lo:hi].tobytes()
            lines = [x for x in body.split(b"\n") if x]
            out[i, at + 7] = 1 - len(set(lines)) / max(1, len(lines))
    return out


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The id and STATISTICS (doubles) of every whole text; null counts as empty, empty texts have zeros."""
    tune(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = _statistics(b.column(1))
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(np.ascontiguousarray(x[:, k])) for k in range(x.shape[1]))], ["id", *STATISTICS])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(docs[id_col].alias("id"), text_of(docs, text_col).alias("text")).mapInArrow(run, f"id {kind}, " + ", ".join(f"{s} double" for s in STATISTICS))


Rule = tuple[tuple[int, bool, float], ...]  # (statistic, greater than?, bound)


def grow_rules(x: np.ndarray, y: np.ndarray, seed: int = 1) -> list[Rule]:
    """Rules of all tree paths; trees see bootstrap rows and a random half of the statistics at each node."""
    r = np.random.default_rng(seed)
    rules: dict[Rule, None] = {}

    def node(rows: np.ndarray, path: Rule) -> None:
        if path:
            rules[path] = None
        own = y[rows]
        if len(path) == DEPTH or len(rows) < 2 * LEAF or own.min() == own.max():
            return
        best = (0.0, None)
        base = own.mean() * (1 - own.mean()) * len(own)
        for f in r.permutation(x.shape[1])[: max(2, x.shape[1] // 2)]:
            v = x[rows, f]
            for cut in np.unique(np.quantile(v, np.linspace(0.02, 0.98, BINS))):
                right = v > cut
                k = int(right.sum())
                if k < LEAF or len(rows) - k < LEAF:
                    continue
                p, q = own[right].mean(), own[~right].mean()
                gain = base - k * p * (1 - p) - (len(rows) - k) * q * (1 - q)
                if gain > best[0] + 1e-12:
                    best = (gain, (int(f), float(cut)))
        if best[1]:
            f, cut = best[1]
            right = x[rows, f] > cut
            node(rows[right], (*path, (f, True, cut)))
            node(rows[~right], (*path, (f, False, cut)))

    for _ in range(TREES):
        node(r.integers(0, len(y), min(len(y), TREE_ROWS)), ())
    return list(rules)


def apply_rules(rules: list[Rule], x: np.ndarray) -> np.ndarray:
    out = np.ones((len(x), len(rules)))
    for k, rule in enumerate(rules):
        for f, greater, cut in rule:
            out[:, k] *= (x[:, f] > cut) == greater
    return out


def lasso_logistic(z: np.ndarray, y: np.ndarray, penalty: float = LASSO, steps: int = 400) -> tuple[np.ndarray, float]:
    """L1-penalised logistic weights by accelerated proximal gradient; the intercept is free."""
    n, k = z.shape
    w, b, u, c, t = np.zeros(k), 0.0, np.zeros(k), 0.0, 1.0
    rate = 4 * n / (np.linalg.norm(np.column_stack([z, np.ones(n)]), 2) ** 2 + 1e-9)
    for _ in range(steps):
        g = 1 / (1 + np.exp(-np.clip(z @ u + c, -30, 30))) - y
        new = u - rate * (z.T @ g) / n
        new = np.sign(new) * np.maximum(np.abs(new) - rate * penalty, 0)
        nb, nt = c - rate * g.mean(), (1 + np.sqrt(1 + 4 * t * t)) / 2
        u, c = new + (t - 1) / nt * (new - w), nb + (t - 1) / nt * (nb - b)
        w, b, t = new, nb, nt
    return w, float(b)


def compile_score(rules: list[Rule], weights: np.ndarray, intercept: float) -> Column:
    """Score column: every rule with a weight as a conjunction over the statistics."""
    total = F.lit(float(intercept))
    for rule, w in zip(rules, weights):
        if w:
            holds = F.lit(True)
            for f, greater, cut in rule:
                c = F.col(STATISTICS[f])
                holds = holds & ((c > cut) if greater else (c <= cut))
            total = total + F.when(holds, float(w)).otherwise(0.0)
    return 1 / (1 + F.exp(-total))


def fit(x: np.ndarray, y: np.ndarray) -> tuple[list[Rule], np.ndarray, float]:
    if len(y) == 0 or y.min() == y.max():
        return [], np.zeros(0), 0.0 if len(y) == 0 else float(4 * (y[0] - 0.5))
    rules = grow_rules(x, y)
    z = apply_rules(rules, x)
    z, keep = np.unique(z, axis=1, return_index=True)
    w, b = lasso_logistic(z, y)
    return [rules[k] for k in keep], w, b


def quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """Score every whole text for quality.

    Labels count only from rows whose crc32(id) mod 4 is not 2. Returns one row for each input row: the
    id, ``held_out``, ``score`` (0 to 1), ``predicted`` (score >= 0.7). Null and empty texts have zero
    statistics and are scored as such. Without labels the score is 0.5; with labels of one class it is
    constant. A null id is held out. Repeated rows answer each for itself; an empty table gives an
    empty result; other columns are ignored.
    """
    stats = materialize(statistics(docs, id_col, text_col), "quality-statistics")
    own = labels.select(labels[id_col].alias("id"), labels[label_col].cast("double").alias("label")).filter(F.col("id").isNotNull() & F.col("label").isNotNull() & (id_crc_mod(F.col("id"), FOLDS) != HELD_OUT))
    sample = own.groupBy("id").agg(F.max("label").alias("label")).orderBy(F.xxhash64("id"), "id").limit(SAMPLE_ROWS)
    rows = stats.join(F.broadcast(sample), "id").orderBy(F.xxhash64("id"), "id", *STATISTICS).limit(SAMPLE_ROWS).toPandas()  # bounded; rows that tie are equal
    rules, weights, intercept = fit(rows[STATISTICS].to_numpy(dtype=float), (rows["label"].to_numpy(dtype=float) > 0).astype(float))
    score = compile_score(rules, weights, intercept)
    held = F.coalesce(id_crc_mod(F.col("id"), FOLDS) == HELD_OUT, F.lit(True))
    return stats.select(F.col("id").alias(id_col), held.alias("held_out"), score.alias("score")).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
