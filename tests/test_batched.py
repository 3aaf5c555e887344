import time

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from skyflow.sources import batched
from skyflow.sources.batched import WaitingReader, batched_files
from skyflow.streaming.stages import run_stage

SCHEMA = "k long, extra string"


def write(folder, name, lo, hi):
    folder.mkdir(exist_ok=True)
    hidden = folder / f"_{name}"
    pq.write_table(pa.table({"k": pa.array(range(lo, hi), pa.int64()), "other": ["x"] * (hi - lo)}), hidden, row_group_size=7)
    hidden.rename(folder / f"{name}.parquet")
    time.sleep(0.02)


def reader(spark, tmp_path, rows, seconds, settle=0):
    kind = spark.createDataFrame([], SCHEMA).schema
    return WaitingReader(kind, {"path": str(tmp_path / "in"), "checkpoint": str(tmp_path / "c"), "rows": str(rows), "seconds": str(seconds), "settle": str(settle)})


def taken(r, start, end):
    return [k for p in r.partitions(start, end) for b in r.read(p) for k in b.column(0).to_pylist()]


def test_either_bound_ends_a_batch(spark, tmp_path, monkeypatch):
    now = [time.time() + 100]
    monkeypatch.setattr(batched.time, "time", lambda: now[0])
    r = reader(spark, tmp_path, 20, 30)
    start = r.initialOffset()
    assert r.latestOffset() == start  # no folder yet
    write(tmp_path / "in", "a", 0, 15)
    now[0] += 29
    assert r.latestOffset() == start  # too few, too soon
    write(tmp_path / "in", "b", 15, 50)
    first = r.latestOffset()  # by count, within a file
    assert taken(r, start, first) == list(range(20)) and first["rows"] == 5
    second = r.latestOffset()
    assert taken(r, first, second) == list(range(20, 40))
    assert r.latestOffset() == second
    now[0] += 29.9
    assert r.latestOffset() == second
    now[0] += 0.2
    third = r.latestOffset()  # by time
    assert taken(r, second, third) == list(range(40, 50))
    now[0] += 100
    assert r.latestOffset() == third and r.partitions(third, third) == []
    write(tmp_path / "in", "empty", 0, 0)
    write(tmp_path / "in", "c", 50, 51)
    assert taken(r, third, r.latestOffset()) == [50]  # the time was over when it came
    assert taken(r, start, third) == list(range(50))  # ranges may be planned again


def test_unsettled_and_hidden_files_wait(spark, tmp_path):
    write(tmp_path / "in", "a", 0, 5)
    write(tmp_path / "in", "_b", 5, 9)
    write(tmp_path / "in", ".c", 5, 9)
    (tmp_path / "in" / "notes.txt").write_text("x")
    assert reader(spark, tmp_path, 5, 30, settle=60).latestOffset() == batched._START
    r = reader(spark, tmp_path, 5, 30)
    assert taken(r, r.initialOffset(), r.latestOffset()) == list(range(5))


def test_a_stream_goes_on_where_it_stopped(spark, tmp_path):
    seen = {}

    def sink(df, n):
        seen[n] = sorted(r.k for r in df.collect())
        assert df.columns == ["k", "extra"] and df.filter("extra is not null").isEmpty()

    def go(rows, wanted):
        q = run_stage(batched_files(spark, str(tmp_path / "in"), SCHEMA, str(tmp_path / "c"), rows, 2), sink, str(tmp_path / "c"), available_now=False, every="200 milliseconds")
        end = time.time() + 60
        while sum(map(len, seen.values())) < wanted and time.time() < end and q.isActive:
            time.sleep(0.1)
        q.stop()
        assert q.exception() is None

    write(tmp_path / "in", "a", 0, 25)
    go(10, 25)
    assert [len(v) for v in seen.values()] == [10, 10, 5]  # two by count, the last by time
    write(tmp_path / "in", "b", 25, 45)
    go(20, 45)
    assert sorted(k for v in seen.values() for k in v) == list(range(45)) and len(seen[3]) == 20


def test_a_batch_takes_no_more_than_waits():
    with pytest.raises(ValueError):
        WaitingReader._moved([(1, "a", 0, 3)], 4)
