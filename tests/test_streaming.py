import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyflow.operators.merge import KeyedTable
from skyflow.operators.stats import generate_statistics
from skyflow.plans import driver_tables as T
from skyflow.sources.readers import replay_alert_dir, write_metrics
from skyflow.streaming.metrics import MetricsListener, metric_rows, observed
from skyflow.streaming.stages import batch_metrics, fan_out, light_curve_stage, run_stage, state_stage
from skyflow.streaming.state import STATISTICS, merge_moments, object_state

DIR = "/root/testdata/sf0.001"


def test_light_curve_stage_replays_without_change(spark, tmp_path):
    det = T.detections(spark, DIR).filter("cast(oid as int) < 20").drop("new")
    det.repartition(2).write.parquet(str(tmp_path / "in"))
    stored, stats = KeyedTable(spark, str(tmp_path / "det"), ["candid", "oid"], ["oid"], 8), KeyedTable(spark, str(tmp_path / "stats"), ["oid", "sid", "fid"], ["oid"], 8)
    seen = []
    sink = fan_out(light_curve_stage(stored, stats), lambda df, n: seen.append(batch_metrics(df, n, {"candid": "candids"}).first().n_messages))

    def go(checkpoint):
        run_stage(replay_alert_dir(spark, str(tmp_path / "in"), det.schema), sink, str(tmp_path / checkpoint)).awaitTermination()

    go("c1")
    n, rows = det.count(), sorted((r.oid, r.fid, r.ndet) for r in stats.read().collect())
    assert sum(seen) == n and stored.read().count() <= n and rows
    go("c1")  # nothing new behind the checkpoint
    assert sum(seen) == n
    go("c2")  # a full replay
    assert sum(seen) == 2 * n and stored.read().dropDuplicates(["candid", "oid"]).count() == stored.read().count()


def test_object_state_of_replayed_and_late_rows(spark, tmp_path):
    det = T.detections(spark, DIR).drop("new")
    parts = [det.filter("candid % 3 = 1"), det.filter("candid % 3 = 0"), det.filter("candid % 3 = 1"), det.filter("candid % 3 = 2")]  # the third is a replay
    odd = det.limit(1).select(*(F.lit(None).cast(f.dataType).alias(f.name) for f in det.schema))
    blank = odd.withColumns({"oid": F.lit("blank"), "sid": F.lit("ztf"), "candid": F.lit(-1).cast("long"), "mjd": F.lit(1.0)})
    nan = blank.withColumns({"candid": F.lit(-2).cast("long"), "mag": F.lit(float("nan"))})
    for k, p in enumerate([*parts, odd.unionByName(blank).unionByName(nan).unionByName(nan)]):
        p.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        time.sleep(0.01)
    table = KeyedTable(spark, str(tmp_path / "state"), ["oid", "sid", "fid"], ["oid"], 8)

    def go(checkpoint):
        state_stage(replay_alert_dir(spark, str(tmp_path / "in"), det.schema), table, str(tmp_path / checkpoint)).awaitTermination()
        return {(r.oid, r.sid, r.fid): r for r in table.read().collect()}

    got = go("c1")
    marks = {"corrected": F.lit(False), "mag_corr": F.col("mag"), "dubious": F.lit(False), "stellar": F.lit(False)}
    want = {(r.oid, r.sid, r.fid): r for r in generate_statistics(det.withColumns(marks), only=set(STATISTICS)).collect()}
    empty = got.pop(("blank", "ztf", None))
    assert (empty.ndet, empty.magmean, empty.magsigma, empty.magfirst, empty.lastmjd) == (2, None, None, None, 1.0)
    assert got.keys() == want.keys() and len(got) > 50
    for k, r in want.items():
        for c in STATISTICS:
            assert got[k][c] == pytest.approx(r[c], rel=1e-9, abs=1e-9), (k, c)
    newest = {r.oid: r.m for r in det.filter("not forced").groupBy("oid").agg(F.max("mjd").alias("m")).collect()}
    last = {o: max(r.newest_mjd for k, r in got.items() if k[0] == o) for o in newest}
    assert last == newest and sum(r.late for r in got.values()) > 0
    assert {k: r[:11] for k, r in go("c2").items() if k[0] != "blank"} == {k: r[:11] for k, r in got.items()}  # a stream from the start
    with pytest.raises(ValueError):
        object_state(det)


def test_merged_moments():
    rng = np.random.default_rng(3)
    x = 1e6 + rng.normal(size=1000)
    state = (0, 0.0, 0.0)
    for part in np.split(x, [0, 1, 7, 7, 400]):
        state = merge_moments(*state, part)
    assert state[0] == 1000 and state[1] == pytest.approx(x.mean(), rel=1e-14) and state[2] / 1000 == pytest.approx(x.var(), rel=1e-9)


def test_observed_metrics_are_those_of_a_pass_of_its_own(spark, tmp_path):
    det = T.detections(spark, DIR).select("oid", "candid", "mag")
    det.repartition(3).write.parquet(str(tmp_path / "in"))
    fields = [{"key": "candid", "alias": "candids"}, {"key": "absent", "alias": "none", "default": "-"}]
    own, rows, two = {}, [], []

    def sink(df, n):
        two.append(df.filter("mag > 15").count())  # a second action over the batch
        own[n] = batch_metrics(df, n, fields).first()

    listener = MetricsListener("detections", rows.append)
    spark.streams.addListener(listener)
    try:
        stream = observed(replay_alert_dir(spark, str(tmp_path / "in"), det.schema), "detections", fields)
        run_stage(stream, sink, str(tmp_path / "c")).awaitTermination()
        end = time.time() + 20
        while len(rows) < len(own) and time.time() < end:
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(listener)
    assert not listener.errors and {r["batch"] for r in rows} == set(own) and len(own) == 3
    for r in rows:
        w = own[r["batch"]]
        assert r["n_messages"] == w.n_messages and sorted(r["candids"]) == sorted(w.candids) and set(r["none"]) == {"-"}
        assert r["execution_time"] > 0 and r["timestamp_sent"] > r["timestamp_received"]
    frame = metric_rows(spark, rows)
    assert frame.columns == batch_metrics(det, 0, fields).columns and frame.agg(F.sum("n_messages")).first()[0] == det.count()
    write_metrics(frame, str(tmp_path / "log"))
    assert spark.read.json(str(tmp_path / "log")).count() == 3
    assert metric_rows(spark, []).count() == 0
    bad = MetricsListener("detections", lambda row: 1 / 0)
    bad.onQueryProgress(type("Event", (), {"progress": type("P", (), {"observedMetrics": {"detections": frame.first()}, "timestamp": "2026-01-01T00:00:00.000Z", "batchDuration": 5, "batchId": 0})})())
    assert len(bad.errors) == 1
