"""Ranks within groups of any size: no task sorts a whole group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def hash_ranked(df: DataFrame, by: list[Column], digest: Column, tie: Column, digits: int = 3) -> DataFrame:
    """``rank`` (from 1) in the order of a hexadecimal digest within groups ``by``, and the group's ``size``.

    The digest's first digits deal a group into buckets that are in order already: rows are ranked in their
    bucket, and buckets by their counts, of which a group has at most 16^digits.
    """
    names = [f"__g{k}" for k in range(len(by))]
    rows = df.withColumns(dict(zip(names, by)) | {"__d": digest, "__tie": tie}).withColumn("__b", F.substring("__d", 1, digits))
    counts = rows.groupBy(*names, "__b").agg(F.count("*").alias("__n"))
    g = Window.partitionBy(*names)
    before = F.sum("__n").over(g.orderBy("__b").rowsBetween(Window.unboundedPreceding, -1))
    counts = counts.select(*(F.col(n).alias(f"{n}_") for n in names), F.col("__b").alias("__b_"), F.coalesce(before, F.lit(0)).alias("__first"), F.sum("__n").over(g).alias("size"))
    same = F.col("__b") == F.col("__b_")
    for n in names:
        same &= F.col(n).eqNullSafe(F.col(f"{n}_"))
    own = F.row_number().over(Window.partitionBy(*names, "__b").orderBy("__d", "__tie"))
    ranked = rows.withColumn("__k", own).join(counts, same).withColumn("rank", F.col("__first") + F.col("__k"))
    return ranked.select(*df.columns, "rank", "size")
