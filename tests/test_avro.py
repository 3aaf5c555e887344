import json
import math
import struct

import pytest
from pyspark.sql import functions as F

from skyflow.plans import driver_tables as D
from skyflow.sources import avro

DIR = "/root/testdata/sf0.001"


def test_bytes_of_the_specification():
    """Values whose encoding the specification spells out."""
    import io

    for n, raw in ((0, "00"), (-1, "01"), (1, "02"), (-2, "03"), (-64, "7f"), (64, "8001"), (2**63 - 1, "feffffffffffffffff01"), (-(2**63), "ffffffffffffffffff01")):
        out = io.BytesIO()
        avro._put_long(out, n)
        assert out.getvalue().hex() == raw and avro._long(io.BytesIO(bytes.fromhex(raw))) == n
    # a container written by hand: enum, fixed, union order, negative block counts, a named type used again
    schema = {
        "type": "record", "name": "alert", "namespace": "x", "fields": [
            {"name": "id", "type": "long"}, {"name": "band", "type": {"type": "enum", "name": "b", "symbols": ["g", "r"]}}, {"name": "raw", "type": {"type": "fixed", "name": "two", "size": 2}},
            {"name": "again", "type": ["two", "null"]}, {"name": "mags", "type": {"type": "array", "items": "float"}}, {"name": "more", "type": {"type": "map", "values": ["null", "int"]}},
            {"name": "at", "type": {"type": "long", "logicalType": "timestamp-millis"}}, {"name": "p", "type": ["null", {"type": "record", "name": "point", "fields": [{"name": "ra", "type": "double"}]}]},
        ],
    }
    body = b"\x0a" + b"\x02" + b"ab" + b"\x00cd" + b"\x03\x10" + struct.pack("<ff", 1.5, 2.5) + b"\x00" + b"\x02\x02k\x02\x06\x00" + b"\x08" + b"\x02" + struct.pack("<d", 9.25)
    text = json.dumps(schema).encode()
    head = io.BytesIO()
    avro._put_long(head, 1)
    avro._put_bytes(head, b"avro.schema")
    avro._put_bytes(head, text)
    sync = bytes(range(16))
    raw = avro.MAGIC + head.getvalue() + b"\x00" + sync + b"\x02" + bytes([2 * len(body)]) + body + sync
    want = {"id": 5, "band": "r", "raw": b"ab", "again": b"cd", "mags": [1.5, 2.5], "more": [("k", 3)], "at": 4, "p": {"ra": 9.25}}
    assert list(avro.records(raw)) == [want]
    assert avro.spark_type(schema).simpleString() == "struct<id:bigint,band:string,raw:binary,again:binary,mags:array<float>,more:map<string,int>,at:bigint,p:struct<ra:double>>"
    for bad in (b"nope" + raw[4:], raw[:-1] + b"x", raw[:-30]):
        with pytest.raises((ValueError, EOFError, struct.error)):
            list(avro.records(bad))


@pytest.mark.parametrize("codec", ["null", "deflate"])
def test_round_trip_through_files(spark, tmp_path, codec):
    rows = [(1, "a", [1.5, None], {"k": 2}, (3, "x"), b"\x00\xff", True), (None, None, None, None, None, None, None), (2**62, "é" * 300, [], {}, (None, None), b"", False)]
    schema = "id long, name string, xs array<double>, m map<string,int>, s struct<a: int, b: string>, raw binary, flag boolean"
    df = spark.createDataFrame(rows * 700, schema)
    for k, r in enumerate(avro.to_containers(df.repartition(2), codec).collect()):
        (tmp_path / f"night{k % 2}").mkdir(exist_ok=True)
        (tmp_path / f"night{k % 2}" / f"{k}.avro").write_bytes(bytes(r.content))
    key = lambda r: str(sorted(r.asDict(True).items()))
    got = avro.read_containers(spark, str(tmp_path))
    assert got.schema == df.schema and sorted(map(key, got.collect())) == sorted(map(key, df.collect()))
    assert avro.read_containers(spark, str(tmp_path), spark.createDataFrame([], "name string, none int").schema).filter("none is null and name = 'a'").count() == 700
    stream = avro.read_containers(spark, str(tmp_path), df.schema, stream=True).writeStream.format("memory").queryName(f"avro_{codec}").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    stream.awaitTermination(120)
    assert spark.table(f"avro_{codec}").count() == 2100
    from skyflow.sources import readers

    assert readers.read_alert_dir(spark, str(tmp_path)).count() == 2100 and readers.replay_alert_dir(spark, str(tmp_path), schema, "avro").isStreaming
    with pytest.raises(ValueError, match="no \\*.avro"):
        (tmp_path / "none").mkdir()
        avro.read_containers(spark, str(tmp_path / "none"))


def test_alerts_with_nested_history(spark):
    alerts = D.alerts(spark, DIR)
    again = avro.from_containers(avro.to_containers(alerts), alerts.schema)
    assert again.exceptAll(alerts).count() == 0 and again.count() == alerts.count()
    one = again.select(F.size("prv_candidates").alias("n"), "candidate.jd").first()
    assert one.n == 1 and math.isfinite(one.jd)
