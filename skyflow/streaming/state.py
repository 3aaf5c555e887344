"""Statistics of objects held in the stream's own state, with no stored table to read for a batch."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

_BAND = "ndet bigint, measured bigint, mean double, m2 double, low double, high double, first_mjd double, first_mag double, last_mjd double, last_mag double"
#: Running statistics, named as ``generate_statistics`` names them.
STATISTICS = ["magmean", "magmax", "magmin", "magsigma", "magfirst", "maglast", "firstmjd", "lastmjd", "ndet"]


def use_state_store(spark: SparkSession) -> None:
    """Keep the state of this session's streams in RocksDB: on local disk, with its changes in the checkpoint."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")


def merge_moments(n: int, mean: float, m2: float, x: np.ndarray) -> tuple[int, float, float]:
    """Count, mean and squared deviations of a sample that grows by the values ``x``."""
    if not len(x):
        return n, mean, m2
    k, own = len(x), float(x.mean())
    d, total = own - mean, n + k
    return total, mean + d * k / total, m2 + float(((x - own) ** 2).sum()) + d * d * n * k / total


class ObjectState(StatefulProcessor):
    """An object's state: the ids of its detections, its newest time, and one row of running sums for a band.

    Every sum is the same in any order of rows, so a late row counts as it would have in time; a row whose id was
    seen is left out, so a replayed one changes nothing.
    """

    def __init__(self, id_type: str, remember_ms: int | None):
        self.id_type, self.remember_ms = id_type, remember_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getMapState("seen", f"candid {self.id_type}", "mjd double", self.remember_ms)
        self.bands = handle.getMapState("bands", "sid string, fid string", f"{_BAND}, first_id {self.id_type}, last_id {self.id_type}")
        self.newest = handle.getValueState("newest", "mjd double, late bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        newest, late = self.newest.get() if self.newest.exists() else (None, 0)
        latest, fresh = newest, {}
        for part in rows:
            for sid, fid, candid, mjd, mag in zip(*(part[c].tolist() for c in ("sid", "fid", "candid", "mjd", "mag"))):
                if self.seen.containsKey((candid,)):
                    continue
                self.seen.updateValue((candid,), (mjd,))
                late += newest is not None and mjd < newest
                latest = mjd if latest is None else max(latest, mjd)
                fresh.setdefault((sid, fid), []).append((mjd, candid, mag))
        if not fresh:
            return
        self.newest.update((latest, late))
        out = []
        for band, new in fresh.items():
            state = self._grown(self.bands.getValue(band) if self.bands.containsKey(band) else None, new)
            self.bands.updateValue(band, state)
            ndet, n, mean, m2, low, high, first_mjd, first_mag, last_mjd, last_mag, *_ = state
            known = (mean, high, low, float(np.sqrt(m2 / n))) if n else (None,) * 4
            out.append((key[0], *band, *known, first_mag, last_mag, first_mjd, last_mjd, ndet, latest, late))
        yield pd.DataFrame(out, columns=["oid", "sid", "fid", *STATISTICS, "newest_mjd", "late"])

    @staticmethod
    def _grown(old: tuple | None, new: list[tuple]) -> tuple:
        ndet, n, mean, m2, low, high, first_mjd, first_mag, last_mjd, last_mag, first_id, last_id = old or (0, 0, 0.0, 0.0) + (None,) * 8
        x = np.array([np.nan if r[2] is None else r[2] for r in new], dtype=float)
        x = x[~np.isnan(x)]
        n, mean, m2 = merge_moments(n, mean, m2, x)
        if len(x):
            low = float(x.min()) if low is None else min(low, float(x.min()))
            high = float(x.max()) if high is None else max(high, float(x.max()))
        ends = [(r[0], r[1], None if r[2] is None or np.isnan(r[2]) else r[2]) for r in (min(new, key=lambda r: r[:2]), max(new, key=lambda r: r[:2]))]
        if old is None or ends[0][:2] < (first_mjd, first_id):
            first_mjd, first_id, first_mag = ends[0]
        if old is None or ends[1][:2] > (last_mjd, last_id):
            last_mjd, last_id, last_mag = ends[1]
        return ndet + len(new), n, mean, m2, low, high, first_mjd, first_mag, last_mjd, last_mag, first_id, last_id

    def close(self) -> None:
        pass


def object_state(detections: DataFrame, remember_days: float | None = None) -> DataFrame:
    """Running statistics of every (object, survey, band) that a batch touches, for output mode ``update``.

    The columns are ``STATISTICS`` as ``generate_statistics`` gives them (its medians need the whole curve and are not
    held), ``newest_mjd`` of the object, and ``late``, how many of its rows came behind a newer one of an earlier batch.
    Forced rows and rows without object, id or time are left out; a row without magnitude, or with NaN, counts
    in ``ndet`` alone. Repeated ids of an object count once, for ``remember_days`` of processing time where given: then
    state does not grow with the age of an object, and later repeats count again. Other columns are ignored. One object's rows of one batch meet in one task, as its state is one.
    """
    if not detections.isStreaming:
        raise ValueError("a batch has no state; generate_statistics computes its statistics")
    use_state_store(detections.sparkSession)
    types = {c: detections.schema[c].dataType.simpleString() for c in ("oid", "sid", "fid", "candid")}
    rows = detections.filter(~F.coalesce("forced", F.lit(False))) if "forced" in detections.columns else detections
    whole = F.col("oid").isNotNull() & F.col("candid").isNotNull() & F.col("mjd").isNotNull()
    rows = rows.filter(whole).select("oid", F.col("sid").cast("string"), F.col("fid").cast("string"), "candid", F.col("mjd").cast("double"), F.col("mag").cast("double"))
    schema = f"oid {types['oid']}, sid string, fid string, {', '.join(f'{c} double' for c in STATISTICS[:-1])}, ndet bigint, newest_mjd double, late bigint"
    out = rows.groupBy("oid").transformWithStateInPandas(
        ObjectState(types["candid"], None if remember_days is None else int(remember_days * 86_400_000)),
        outputStructType=schema, outputMode="update", timeMode="None" if remember_days is None else "ProcessingTime",
    )
    return out.withColumns({c: F.col(c).cast(types[c]) for c in ("sid", "fid")})
