"""Union, deduplication, ordering and cuts of light curves."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_row(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """One row per key, the first in ``order``."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__n", F.row_number().over(w)).filter("__n = 1").drop("__n")


def union_aligned(*dfs: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def read_history(stored: DataFrame, batch: DataFrame, key: str = "oid", **flags) -> DataFrame:
    """Stored rows of the batch's objects, tagged ``new`` = false and other flags."""
    out = stored.join(batch.select(key).distinct(), key, "left_semi").withColumn("new", F.lit(False))
    return out.withColumns({k: F.lit(v) for k, v in flags.items()})


def read_limits(stored: DataFrame, batch: DataFrame, key: str = "oid") -> DataFrame:
    """Stored non-detections of the batch's objects."""
    return stored.join(batch.select(key).distinct(), key, "left_semi")


def read_forced(stored: DataFrame, batch: DataFrame, key: str = "oid") -> DataFrame:
    return read_history(stored, batch, key, forced=True)


def union_history(batch: DataFrame, *stored: DataFrame) -> DataFrame:
    return union_aligned(batch, *(read_history(s, batch) for s in stored))


def dedup_detections(det: DataFrame) -> DataFrame:
    """One row per (candid, oid): with a stamp first, then new first."""
    stamp = F.col("has_stamp").desc() if "has_stamp" in det.columns else F.lit(0).asc()
    order = [F.col(c) for c in ("mjd", "mag") if c in det.columns]
    return first_row(det, ["candid", "oid"], stamp, F.col("new").desc(), *order)


def dedup_limits(nd: DataFrame) -> DataFrame:
    return nd.dropDuplicates(["oid", "fid", "mjd"])


def _ties(df: DataFrame, tie: str | None) -> list[Column]:
    """The tie column, or every orderable one in order of names: equal rows remain only where whole rows are equal."""
    if tie:
        return [F.col(tie)]
    return [F.col(f.name) for f in sorted(df.schema, key=lambda f: f.name) if f.dataType.typeName() not in ("map", "variant")]


def keep_last(df: DataFrame, key: str, order: str, tie: str | None = None) -> DataFrame:
    """The latest row of each key; of rows at the same time the greatest by ``tie``."""
    return first_row(df, [key], F.col(order).desc(), *(c.desc() for c in _ties(df, tie)))


def keep_earliest(df: DataFrame, key: str, order: str, tie: str | None = None) -> DataFrame:
    """The earliest row of each key; of rows at the same time the smallest by ``tie``."""
    return first_row(df, [key], F.col(order).asc(), *_ties(df, tie))


def as_of_cut(det: DataFrame, batch: DataFrame) -> DataFrame:
    """Drop rows later than the newest row of their object in the batch."""
    last = batch.groupBy("oid").agg(F.max("mjd").alias("__last"))
    return det.join(last, "oid").filter(F.col("mjd") <= F.col("__last")).drop("__last")


def top_k(df: DataFrame, keys: list[str], value: str, k: int, tie: str) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(F.col(value).desc(), F.col(tie))
    return df.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def bundle_by_object(msgs: DataFrame) -> DataFrame:
    """One row per object: its candids and how many rows and bands it has."""
    return msgs.groupBy("oid").agg(F.sort_array(F.collect_set("candid")).alias("candids"), F.count("*").alias("n_rows"), F.array_join(F.sort_array(F.collect_set("fid")), ",").alias("bands"))


def shorten_days(obs: DataFrame, days: float) -> DataFrame:
    """Detections within ``days`` of the first; forced rows before the last of these."""
    o = Window.partitionBy("oid")
    first = F.min(F.when(~F.col("forced"), F.col("mjd"))).over(o)
    df = obs.withColumn("__keep", ~F.col("forced") & (F.col("mjd") <= first + days))
    return df.withColumn("__last", F.max(F.when(F.col("__keep"), F.col("mjd"))).over(o)).filter(F.col("__keep") | (F.col("forced") & (F.col("mjd") < F.col("__last")))).drop("__keep", "__last")


def shorten_ndet(obs: DataFrame, n: int) -> DataFrame:
    """The first ``n`` detections; forced rows strictly before the last of these."""
    rank = F.row_number().over(Window.partitionBy("oid", "forced").orderBy("mjd", "candid"))
    df = obs.withColumn("__keep", ~F.col("forced") & (rank <= n))
    return df.withColumn("__last", F.max(F.when(F.col("__keep"), F.col("mjd"))).over(Window.partitionBy("oid"))).filter(F.col("__keep") | (F.col("forced") & (F.col("mjd") < F.col("__last")))).drop("__keep", "__last")


def trim_to_span(obs: DataFrame, days: float) -> DataFrame:
    """The window of ``days`` with most points of each object: the earliest among equals."""
    o = Window.partitionBy("oid")
    df = obs.withColumn("__n", F.expr(f"count(*) over (partition by oid order by mjd range between current row and {float(days)}D following)"))
    return df.withColumn("__start", F.min(F.struct((-F.col("__n")).alias("n"), F.col("mjd").alias("t"))).over(o)).filter((F.col("mjd") >= F.col("__start.t")) & (F.col("mjd") <= F.col("__start.t") + days)).drop("__n", "__start")
