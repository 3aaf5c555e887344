"""Training tables, splits and reports."""

from __future__ import annotations

from collections.abc import Callable

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyflow.operators.ranking import hash_ranked


def _digest(key: str, seed: int) -> Column:
    return F.md5(F.concat_ws(":", F.col(key).cast("string"), F.lit(str(seed))))


def stratified_split(labels: DataFrame, test: float = 0.2, validation: float = 0.25, key: str = "oid", label: str = "label", seed: int = 0) -> DataFrame:
    """Train, validation (a share of the rest) and test, keeping class shares; by hash of the key."""
    ranked = hash_ranked(labels, [F.col(label)], _digest(key, seed), F.col(key))
    place = (F.col("rank") - 0.5) / F.col("size")
    part = F.when(place < test, "test").when(place < test + (1 - test) * validation, "validation").otherwise("train")
    return ranked.withColumn("partition", part).drop("rank", "size")


def stratified_kfold(labels: DataFrame, k: int = 5, key: str = "oid", label: str = "label", seed: int = 0) -> DataFrame:
    """Equal folds of each class by hash of the key; the first folds take what does not divide."""
    ranked = hash_ranked(labels, [F.col(label)], _digest(key, seed), F.col(key))
    small, more, at = F.expr(f"size div {k}"), F.col("size") % k, F.col("rank") - 1
    fold = F.when(at < more * (small + 1), F.call_function("div", at, small + 1)).otherwise(more + F.call_function("div", at - more * (small + 1), F.greatest(small, F.lit(1))))
    return ranked.withColumn("fold", fold).drop("rank", "size")


def partitions(labels: DataFrame, k: int = 5, test: float = 0.2, key: str = "oid", label: str = "label", seed: int = 0) -> DataFrame:
    """A test part, folds of the rest, class numbers in order of names, and a blind label ('unknown') for the test part."""
    split = stratified_split(labels, test, 0.0, key, label, seed)
    rest = stratified_kfold(split.filter("partition <> 'test'"), k, key, label, seed + 1)
    both = rest.unionByName(split.filter("partition = 'test'").withColumn("fold", F.lit(None).cast("long")))
    numbers = labels.select(label).distinct()  # the classes
    numbers = numbers.withColumn("class_id", F.dense_rank().over(Window.partitionBy(F.lit(0)).orderBy(label)) - 1)
    blind = F.when(F.col("partition") == "test", "unknown").otherwise(F.col(label).cast("string"))
    return both.join(F.broadcast(numbers), label).withColumn("blind_label", blind)


def attach_labels(features: DataFrame, labels: DataFrame, keys: tuple[str, ...] = ("oid",)) -> DataFrame:
    """Features with the class and partition of their object (and horizon)."""
    return features.join(labels, list(keys))


def confusion_matrix(pred: DataFrame, truth: str, guess: str) -> DataFrame:
    """Long form with the share of its true class."""
    n = pred.groupBy(truth, guess).agg(F.count("*").alias("n"))
    return n.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy(truth)))


def classification_report(pred: DataFrame, truth: str, guess: str) -> DataFrame:
    """Precision, recall, F1 and support of every class."""
    pairs = pred.groupBy(truth, guess).agg(F.count("*").alias("n"))
    hit = F.sum(F.when(F.col(truth) == F.col(guess), F.col("n")).otherwise(0))
    real = pairs.groupBy(F.col(truth).alias("class_name")).agg(F.sum("n").alias("support"), hit.alias("tp"))
    said = pairs.groupBy(F.col(guess).alias("class_name")).agg(F.sum("n").alias("predicted"))
    out = real.join(said, "class_name", "full").na.fill(0, ["support", "tp", "predicted"])
    p, r = F.coalesce(F.col("tp") / F.nullif("predicted", F.lit(0)), F.lit(0.0)), F.coalesce(F.col("tp") / F.nullif("support", F.lit(0)), F.lit(0.0))
    return out.select("class_name", p.alias("precision"), r.alias("recall"), F.coalesce(2 * p * r / F.when(p + r > 0, p + r), F.lit(0.0)).alias("f1"), "support")


def reports(pred: DataFrame, truth: str, guess: str, groups: list[str]) -> DataFrame:
    """Precision, recall, F1 and support of every class in each group, such as horizon and partition."""
    pairs = pred.groupBy(*groups, truth, guess).agg(F.count("*").alias("n"))
    hit = F.sum(F.when(F.col(truth) == F.col(guess), F.col("n")).otherwise(0))
    real = pairs.groupBy(*groups, F.col(truth).alias("class_name")).agg(F.sum("n").alias("support"), hit.alias("tp"))
    said = pairs.groupBy(*groups, F.col(guess).alias("class_name")).agg(F.sum("n").alias("predicted"))
    out = real.join(said, [*groups, "class_name"], "full").na.fill(0, ["support", "tp", "predicted"])
    p, r = F.coalesce(F.col("tp") / F.nullif("predicted", F.lit(0)), F.lit(0.0)), F.coalesce(F.col("tp") / F.nullif("support", F.lit(0)), F.lit(0.0))
    f1 = F.coalesce(2 * p * r / F.when(p + r > 0, p + r), F.lit(0.0))
    return out.select(*groups, "class_name", p.alias("precision"), r.alias("recall"), f1.alias("f1"), "support")


def report_averages(report: DataFrame, groups: list[str] | None = None) -> DataFrame:
    """Macro and support-weighted averages, of all classes or of each group's."""
    out = [F.avg(c).alias(f"macro_{c}") for c in ("precision", "recall", "f1")]
    out += [(F.sum(F.col(c) * F.col("support")) / F.sum("support")).alias(f"weighted_{c}") for c in ("precision", "recall", "f1")]
    return report.groupBy(*(groups or [])).agg(*out, F.sum("support").alias("support"))


def per_class_accuracy(pred: DataFrame, truth: str, guess: str) -> DataFrame:
    return pred.groupBy(truth).agg(F.avg(F.coalesce(F.col(truth) == F.col(guess), F.lit(False)).cast("int")).alias("accuracy"), F.count("*").alias("n"))


#: Ranges of scores that running sums are dealt to.
RANGES = 200


def precision_recall_curve(prob: DataFrame, score: str, positive: str) -> DataFrame:
    """Precision and recall at every distinct score, by prefix sums over ranges of scores.

    Scores are counted first; approximate quantiles cut the counts into RANGES ranges of similar size. Running sums go
    within a range, and the ranges' own sums, a list of at most RANGES + 1, give where each begins. Rows without a score
    are left out; without a positive row recall is null.
    """
    by = prob.filter(F.col(score).isNotNull()).groupBy(score).agg(F.count("*").alias("n"), F.sum(F.coalesce(F.col(positive).cast("long"), F.lit(0))).alias("hits"))
    cuts = by.agg(F.percentile_approx(score, F.array(*(F.lit(k / RANGES) for k in range(1, RANGES))), 10 * RANGES)).scalar()
    dealt = by.withColumn("__cuts", cuts).withColumn("__r", F.size(F.filter("__cuts", lambda x: x > F.col(score)))).drop("__cuts")
    sums = dealt.groupBy("__r").agg(F.sum("n").alias("n"), F.sum("hits").alias("hits")).agg(F.collect_list(F.struct("__r", "n", "hits"))).scalar()
    before = lambda name, range_: F.aggregate("__sums", F.lit(0).cast("long"), lambda acc, x: acc + F.when(x["__r"] < range_, x[name]).otherwise(0))
    w = Window.partitionBy("__r").orderBy(F.col(score).desc()).rowsBetween(Window.unboundedPreceding, 0)
    run = dealt.withColumns({"said": F.sum("n").over(w), "tp": F.sum("hits").over(w), "__sums": sums})
    said, tp, real = F.col("said") + before("n", F.col("__r")), F.col("tp") + before("hits", F.col("__r")), before("hits", F.lit(RANGES + 1))
    return run.select(score, (tp / said).alias("precision"), F.try_divide(tp.cast("double"), real).alias("recall"))


def fill_missing(df: DataFrame, columns: list[str], marker: float = -9999.0) -> DataFrame:
    return df.withColumns({c: F.when(F.col(c).isNull() | F.isnan(c) | (F.abs(F.col(c)) == float("inf")), marker).otherwise(F.col(c)) for c in columns})


def feature_quantiles(features: DataFrame, name: str, value: str, steps: int = 10, accuracy: int | None = None) -> DataFrame:
    """Quantiles of every feature at equal steps: exact, or within 1 / ``accuracy`` of rank in bounded memory."""
    at = F.array(*(F.lit(k / steps) for k in range(steps + 1)))
    q = F.percentile(value, at) if accuracy is None else F.percentile_approx(value, at, accuracy)
    return features.groupBy(name).agg(q.alias("q")).select(name, F.posexplode("q").alias("step", "quantile"))


def feature_sketches(features: DataFrame, name: str, value: str, k: int = 400) -> DataFrame:
    """(name, sketch): a KLL sketch of every feature's values; nulls and NaN are left out.

    A sketch holds some kilobytes however many values it saw, and sketches of batches add up, so each batch's may be
    kept and quantiles asked of any of them together. Ranks err by about 2.3 / k^0.9 (1 % for k = 400), with 99 % confidence.
    """
    v = F.col(value).cast("double")
    return features.filter(v.isNotNull() & ~F.isnan(v)).groupBy(name).agg(F.kll_sketch_agg_double(v, F.lit(k)).alias("sketch"))


def merge_sketches(*parts: DataFrame, name: str = "name") -> DataFrame:
    """One sketch of each feature from those of several batches."""
    return reduce(DataFrame.unionByName, parts).groupBy(name).agg(F.kll_merge_agg_double("sketch").alias("sketch"))


def sketch_quantiles(sketches: DataFrame, name: str = "name", steps: int = 10) -> DataFrame:
    """Quantiles at equal steps, as of ``feature_quantiles``, from sketches."""
    at = F.array(*(F.lit(k / steps) for k in range(steps + 1)))
    return sketches.select(name, F.posexplode(F.kll_sketch_get_quantile_double("sketch", at)).alias("step", "quantile"))


def quantile_transform(features: DataFrame, quantiles: DataFrame, name: str, value: str, steps: int = 10) -> DataFrame:
    """Map values to their place between a feature's quantiles, from 0 to 1 and linear in between: the middle of
    the places where quantiles are equal; values beyond the ends take these."""
    table = quantiles.groupBy(name).agg(F.transform(F.sort_array(F.collect_list(F.struct("step", "quantile"))), lambda x: x["quantile"]).alias("__q"))
    v = F.col(value)

    def side(low: bool) -> Column:
        inside = F.size(F.filter("__q", lambda x: (x < v) if low else (x <= v)))  # points on the left
        at = F.least(F.greatest(inside, F.lit(1)), F.lit(steps))
        a, b = F.element_at("__q", at), F.element_at("__q", at + 1)
        place = at - 1 + F.coalesce((v - a) / F.nullif(b - a, F.lit(0.0)), F.lit(0.0) if low else F.lit(1.0))
        return F.least(F.greatest(place / steps, F.lit(0.0)), F.lit(1.0))

    return features.join(table, name).withColumn("uniform", F.when(v.isNotNull(), (side(True) + side(False)) / 2)).drop("__q")


def metadata_quantiles(metadata: DataFrame, parts: DataFrame, columns: list[str], steps: int = 10, training: str = "train", windows: DataFrame | None = None) -> DataFrame:
    """Metadata made numbers (what is none, NaN or infinite becomes -9999), expanded to the windows of each object,
    and mapped by quantiles of the training rows only."""
    number = metadata.select("oid", *(F.expr(f"try_cast(`{c}` AS double)").alias(c) for c in columns))
    rows = fill_missing(number, columns)
    if windows is not None:
        rows = rows.join(windows.select("oid", "window_id"), "oid")
    long = rows.unpivot([c for c in rows.columns if c not in columns], columns, "name", "value")
    fitted = feature_quantiles(long.join(parts.filter(F.col("partition") == training).select("oid").distinct(), "oid", "left_semi"), "name", "value", steps)
    return quantile_transform(long, fitted, "name", "value", steps)


def count_windows(obs: DataFrame, size: int = 200) -> DataFrame:
    """Light curves chopped into windows of ``size`` rows, ids suffixed."""
    n = F.row_number().over(Window.partitionBy("oid").orderBy("mjd", "candid")) - 1
    return obs.withColumn("window_id", F.concat_ws("_", "oid", F.floor(n / size).cast("string")))


def undersample_windows(windows: DataFrame, labels: DataFrame, keep: list[str], label: str = "label") -> DataFrame:
    """Every window of the listed classes, one (by hash) of each object of the rest."""
    df = windows.join(labels, "oid")
    n = F.row_number().over(Window.partitionBy("oid").orderBy(F.md5("window_id"), "window_id"))
    return df.withColumn("__n", n).filter(F.col(label).isin(keep) | (F.col("__n") == 1)).drop("__n")


def _padded(kept: DataFrame, n: int) -> DataFrame:
    seq = kept.groupBy("oid", "fid").agg(F.sort_array(F.collect_list(F.struct("mjd", "mag"))).alias("s"))
    fill = lambda c, pad: F.slice(F.concat(c, F.array_repeat(pad, n)), 1, n)
    return seq.select("oid", "fid", fill(F.col("s.mjd"), F.lit(0.0)).alias("time"), fill(F.col("s.mag"), F.lit(0.0)).alias("value"), fill(F.array_repeat(F.lit(1), F.size("s")), F.lit(0)).alias("mask"))


def _nearest_in_time(df: DataFrame, marks: Column, keep: Column) -> DataFrame:
    """Of the ordered points of each light curve those nearest to the marks, each mark a point not taken yet; the
    marks and the sequence are as short as the sample. Ties go to the earlier point."""
    points = F.sort_array(F.collect_list(F.when(keep, F.struct("mjd", "candid", "mag"))))
    g = df.groupBy("oid", "fid").agg(points.alias("p"), F.first("__start").alias("__start"))

    def take(acc: Column, mark: Column) -> Column:
        free = F.filter(acc["free"], lambda x: x.isNotNull())
        best = F.array_min(F.transform(free, lambda x: F.struct(F.abs(x["mjd"] - mark).alias("d"), x.alias("x"))))["x"]
        return F.struct(F.filter(free, lambda x: x != best).alias("free"), F.when(best.isNull(), acc["got"]).otherwise(F.concat(acc["got"], F.array(best))).alias("got"))

    none = F.array().cast("array<struct<mjd: double, candid: bigint, mag: double>>")
    got = F.aggregate(F.transform(marks, lambda m: m + F.col("__start")), F.struct(F.col("p").alias("free"), none.alias("got")), take, lambda acc: acc["got"])
    return g.select("oid", "fid", F.inline(got))


def sequence_sample(obs: DataFrame, n: int, mode: str = "linear", max_days: float = 1500.0, before: int = 5) -> DataFrame:
    """``n`` points of each light curve as time-ordered arrays padded with zeros.

    ``windows`` keeps light curves of at most n points; ``linear`` and ``log_index`` take points at linear and at
    logarithmic index steps; ``log_time`` the points nearest to logarithmic times after the first;
    ``linear_log_time`` ``before`` points at linear steps before the first detection and the rest as ``log_time`` after it.
    """
    w = Window.partitionBy("oid", "fid")
    df = obs.withColumn("candid", F.col("candid").cast("long")).withColumns({"__i": F.row_number().over(w.orderBy("mjd", "candid")) - 1, "__n": F.count("*").over(w)})
    last, k = F.col("__n") - 1, F.sequence(F.lit(0), F.lit(n - 1))
    if mode == "windows":
        return _padded(df.filter(F.col("__n") <= n), n)
    if mode == "linear":
        places = F.transform(k, lambda j: F.floor(j * last / (n - 1)))
        return _padded(df.filter((F.col("__n") <= n) | F.array_contains(places, F.col("__i").cast("long"))), n)
    if mode == "log_index":
        places = F.transform(k, lambda j: F.least(F.rint(F.pow(F.col("__n").cast("double"), j / (n - 1)) - 1).cast("long"), last))
        return _padded(df.filter(F.array_contains(places, F.col("__i").cast("long"))), n)
    if mode == "log_time":
        marks = F.transform(k, lambda j: F.pow(F.lit(max_days), j / (n - 1)))
        return _padded(_nearest_in_time(df.withColumn("__start", F.min("mjd").over(w)), marks, F.lit(True)), n)
    if mode != "linear_log_time":
        raise ValueError(f"unknown mode {mode!r}")
    seen = F.min(F.when(~F.col("forced"), F.col("mjd"))).over(w)
    df = df.withColumn("__start", seen).withColumn("__after", F.coalesce(F.col("mjd") >= F.col("__start"), F.lit(False)))
    df = df.withColumns({"__b": F.count(F.when(~F.col("__after"), 1)).over(w), "__i": F.row_number().over(w.orderBy("mjd", "candid")) - 1})
    places = F.transform(F.sequence(F.lit(0), F.lit(before - 1)), lambda j: F.floor(j * (F.col("__b") - 1) / max(1, before - 1)))
    early = df.filter(~F.col("__after") & ((F.col("__b") <= before) | F.array_contains(places, F.col("__i").cast("long"))))
    marks = F.transform(F.sequence(F.lit(0), F.lit(n - before - 1)), lambda j: 0.5 * F.pow(F.lit(2 * max_days), j / max(1, n - before - 1)))
    late = _nearest_in_time(df.filter("__after"), marks, F.col("__after"))
    return _padded(early.select("oid", "fid", "mjd", "candid", "mag").unionByName(late), n)


def profile_features(df: DataFrame, value: str, label: str) -> DataFrame:
    v = F.col(value)
    return df.groupBy(label).agg(
        F.count("*").alias("n"), F.avg(v.isNull().cast("double")).alias("null_share"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"), F.min(v).alias("low"), F.percentile(v, 0.25).alias("q25"),
        F.percentile(v, 0.5).alias("q50"), F.percentile(v, 0.75).alias("q75"), F.max(v).alias("high"),
    )


def sample_objects(labels: DataFrame, n: int, key: str = "oid", label: str = "label", seed: int = 0) -> DataFrame:
    """``n`` objects of each class, by hash of the key."""
    return hash_ranked(labels, [F.col(label)], _digest(key, seed), F.col(key)).filter(F.col("rank") <= n).drop("rank", "size")


def multi_horizon(obs: DataFrame, days: list[float]) -> DataFrame:
    """Each light curve cut at every horizon (null: uncut); one explode, keyed by (oid, horizon)."""
    first = F.min(F.when(~F.col("forced"), F.col("mjd"))).over(Window.partitionBy("oid"))
    horizons = F.array(*(F.lit(float(d)) for d in days), F.lit(None).cast("double"))
    return obs.withColumn("__first", first).withColumn("horizon", F.explode(horizons)).filter(F.col("horizon").isNull() | (F.col("mjd") <= F.col("__first") + F.col("horizon"))).drop("__first")


def multi_horizon_features(obs: DataFrame, days: list[float], compute: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Long features (oid, fid, name, value, version) of the light curves cut at every horizon and uncut, keyed by horizon."""
    cut = multi_horizon(obs, days).withColumn("oid", F.concat_ws("@", "oid", F.coalesce(F.col("horizon").cast("string"), F.lit(""))))
    horizon = F.nullif(F.substring_index("oid", "@", -1), F.lit("")).cast("double")
    oid = F.expr("substring(oid, 1, length(oid) - length(substring_index(oid, '@', -1)) - 1)")
    return compute(cut.drop("horizon")).withColumn("horizon", horizon).withColumn("oid", oid)


def consolidate(features: DataFrame, names: list[str]) -> DataFrame:
    """One row for each object and horizon, columns named feature_band (feature alone without a band)."""
    column = F.concat_ws("_", "name", F.nullif("fid", F.lit("")))
    return features.withColumn("column", column).groupBy("oid", "horizon").pivot("column", names).agg(F.max("value"))
