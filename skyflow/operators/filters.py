"""Row filters of detections and forced photometry."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyflow.functions.columns import ZERO_MAG, isclose


def drop_bogus(det: DataFrame, rb_min: float = 0.55) -> DataFrame:
    """Alerts under the real-bogus threshold go, forced rows with a bad processing status too."""
    status = F.col("procstatus").isin("0", "57") if "procstatus" in det.columns else F.lit(True)
    return det.filter(F.when(F.col("forced"), status).otherwise(F.col("rb") >= rb_min))


def min_detections(det: DataFrame, n: int) -> DataFrame:
    count = F.count(F.when(~F.col("forced"), 1)).over(Window.partitionBy("oid"))
    return det.withColumn("__n", count).filter(F.col("__n") >= n).drop("__n")


def drop_sentinel_mags(det: DataFrame, both: bool = False) -> DataFrame:
    a, b = isclose(F.col("mag"), ZERO_MAG), isclose(F.col("e_mag"), ZERO_MAG)
    return det.filter(~((a & b) if both else (a | b)))


def drop_bad_forced(fp: DataFrame, flux: str = "forcediffimflux", error: str = "forcediffimfluxunc") -> DataFrame:
    good = lambda c: F.col(c).isNotNull() & (F.col(c) != 0) & ~isclose(F.col(c), -99999)
    return fp.filter(good(flux) & good(error))


def drop_absurd(obs: DataFrame) -> DataFrame:
    """Magnitude rows stay when 6 < brightness < 30 and error < 1; flux rows stay."""
    return obs.filter((F.col("unit") != "magnitude") | ((F.col("brightness") > 6) & (F.col("brightness") < 30) & (F.col("e_brightness") < 1)))


def reference_close(obs: DataFrame, bands: list[str]) -> DataFrame:
    return obs.filter(F.col("distnr").between(0, 5) & (F.col("e_brightness") > 0) & F.col("fid").isin(bands))


def survey_mask(name: str, column: str = "sid") -> Column:
    return F.lower(F.col(column)) == name.lower()


def exclude_objects(df: DataFrame, listed: DataFrame, key: str = "oid") -> DataFrame:
    return df.join(listed.select(key).distinct(), key, "left_anti")


def is_asteroid(column: str = "ssdistnr") -> Column:
    return F.coalesce(F.col(column) != -999, F.lit(False))


_OPS = {"less": lambda a, b: a < b, "less eq": lambda a, b: a <= b, "greater": lambda a, b: a > b, "greater eq": lambda a, b: a >= b, "eq": lambda a, b: a == b}


def compile_filter(spec: dict | str) -> Column:
    """A watch-list predicate tree as one column: constant, and, or, no filter; others raise ValueError."""
    spec = json.loads(spec) if isinstance(spec, str) else spec
    kind, params = spec["type"], spec.get("params", {})
    if kind == "constant":
        if params["op"] not in _OPS:
            raise ValueError(f"unknown operator {params['op']!r}")
        return _OPS[params["op"]](F.col(params["field"]), F.lit(params["constant"]))
    if kind in ("and", "or"):
        out = F.lit(kind == "and")
        for f in params["filters"]:
            out = out & compile_filter(f) if kind == "and" else out | compile_filter(f)
        return out
    if kind == "no filter":
        return F.lit(True)
    raise ValueError(f"unknown filter type {kind!r}")


def ready_to_notify(matches: DataFrame, spec: dict | None, fields: list[str]) -> DataFrame:
    """Without a filter always; else when all fields are there and the filter holds."""
    if not spec:
        return matches.withColumn("ready_to_notify", F.lit(True))
    there = F.lit(True)
    for f in fields:
        there = there & F.col(f).isNotNull()
    return matches.withColumn("ready_to_notify", there & F.coalesce(compile_filter(spec), F.lit(False)))
