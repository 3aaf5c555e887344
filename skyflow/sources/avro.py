"""Avro object containers without the cluster's package: bytes to rows and rows to bytes in Arrow functions.

Files come by Spark's ``binaryFile`` source, so any file system and streams of new files work; a task holds one
file, of at most 2 GiB. The layout (magic, metadata with schema and codec, blocks between sync marks) and the
encoding are those of the Avro 1.11 specification; codecs are null, deflate and zstandard.
"""

from __future__ import annotations

import hashlib
import io
import json
import struct
import zlib
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

MAGIC = b"Obj\x01"
_PLAIN = {"string": T.StringType(), "bytes": T.BinaryType(), "int": T.IntegerType(), "long": T.LongType(), "float": T.FloatType(), "double": T.DoubleType(), "boolean": T.BooleanType()}
_NAMES = {type(v): k for k, v in _PLAIN.items()} | {T.ShortType: "int", T.ByteType: "int"}
#: Rows that one message to Spark, one container or one of its blocks has.
ROWS, BLOCK_ROWS = 1000, 100


def _is_nullable(schema: Any) -> tuple[Any, bool]:
    """The type of a union with null, and whether it is one; other unions have no column type."""
    if not isinstance(schema, list):
        return schema, False
    rest = [s for s in schema if s != "null"]
    if len(rest) != 1:
        raise ValueError(f"a union of several types has no column type: {schema}")
    return rest[0], len(rest) < len(schema)


def spark_type(schema: Any, known: dict | None = None) -> T.DataType:
    """The column type of an Avro schema; ``known`` has its named types."""
    known = {} if known is None else known
    schema = _is_nullable(schema)[0]
    if isinstance(schema, str):
        return _PLAIN[schema] if schema in _PLAIN else known[schema]
    kind = schema["type"]
    if kind == "array":
        return T.ArrayType(spark_type(schema["items"], known))
    if kind == "map":
        return T.MapType(T.StringType(), spark_type(schema["values"], known))
    if kind == "record":
        out = T.StructType([T.StructField(f["name"], spark_type(f["type"], known)) for f in schema["fields"]])
    elif kind in ("enum", "fixed"):
        out = T.StringType() if kind == "enum" else T.BinaryType()
    else:
        return spark_type(kind, known)
    for name in {schema["name"], f"{schema['namespace']}.{schema['name']}" if schema.get("namespace") else schema["name"]}:
        known[name] = out
    return out


def avro_schema(kind: T.DataType, name: str = "row") -> Any:
    """The Avro schema of a column type; everything may be null."""
    if isinstance(kind, T.StructType):
        return {"type": "record", "name": name, "fields": [{"name": f.name, "type": ["null", avro_schema(f.dataType, f"{name}_{f.name}")]} for f in kind]}
    if isinstance(kind, T.ArrayType):
        return {"type": "array", "items": ["null", avro_schema(kind.elementType, f"{name}_item")]}
    if isinstance(kind, T.MapType):
        return {"type": "map", "values": ["null", avro_schema(kind.valueType, f"{name}_value")]}
    return _NAMES[type(kind)]


# --- bytes ---------------------------------------------------------------------------


def _long(f: io.BytesIO) -> int:
    n = shift = 0
    while True:
        byte = f.read(1)
        if not byte:
            raise EOFError("the container ends inside a number")
        n |= (byte[0] & 0x7F) << shift
        if byte[0] < 0x80:
            return (n >> 1) ^ -(n & 1)
        shift += 7


def _put_long(out: io.BytesIO, n: int) -> None:
    n = (n << 1) ^ (n >> 63)
    while n > 0x7F:
        out.write(bytes([n & 0x7F | 0x80]))
        n >>= 7
    out.write(bytes([n]))


def _blocks(f: io.BytesIO, one: Callable[[], Any]) -> list:
    out = []
    while n := _long(f):
        if n < 0:  # a negative count is followed by the block's size
            n = -n
            _long(f)
        out += [one() for _ in range(n)]
    return out


def _decoder(schema: Any, known: dict) -> Callable[[io.BytesIO], Any]:
    """A function that reads one value of ``schema``."""
    if isinstance(schema, list):
        kinds = [_decoder(s, known) for s in schema]
        return lambda f: kinds[_long(f)](f)
    kind = schema if isinstance(schema, str) else schema["type"]
    if isinstance(schema, dict) and kind in ("record", "enum", "fixed"):
        holder: list = []
        for name in {schema["name"], f"{schema.get('namespace', '')}.{schema['name']}"}:
            known[name] = lambda f: holder[0](f)
        if kind == "record":
            fields = [(x["name"], _decoder(x["type"], known)) for x in schema["fields"]]
            holder.append(lambda f: {n: read(f) for n, read in fields})
        elif kind == "enum":
            holder.append(lambda f: schema["symbols"][_long(f)])
        else:
            holder.append(lambda f: f.read(schema["size"]))
        return holder[0]
    if kind == "array":
        item = _decoder(schema["items"], known)
        return lambda f: _blocks(f, lambda: item(f))
    if kind == "map":
        value = _decoder(schema["values"], known)
        return lambda f: _blocks(f, lambda: (f.read(_long(f)).decode(), value(f)))
    simple = {
        "null": lambda f: None, "boolean": lambda f: f.read(1) == b"\x01", "int": _long, "long": _long, "float": lambda f: struct.unpack("<f", f.read(4))[0], "double": lambda f: struct.unpack("<d", f.read(8))[0],
        "bytes": lambda f: f.read(_long(f)), "string": lambda f: f.read(_long(f)).decode(),
    }
    if isinstance(kind, str) and kind in simple:
        return simple[kind]
    return known[kind] if isinstance(kind, str) else _decoder(kind, known)


def _encode(out: io.BytesIO, kind: T.DataType, value: Any) -> None:
    """One nullable value, as ``avro_schema`` says."""
    if value is None:
        _put_long(out, 0)
        return
    _put_long(out, 1)
    if isinstance(kind, T.StructType):
        for field in kind:
            _encode(out, field.dataType, value[field.name])
    elif isinstance(kind, (T.ArrayType, T.MapType)):
        if len(value):
            _put_long(out, len(value))
            for x in value:
                if isinstance(kind, T.MapType):
                    _put_bytes(out, x[0].encode())
                    _encode(out, kind.valueType, x[1])
                else:
                    _encode(out, kind.elementType, x)
        _put_long(out, 0)
    elif isinstance(kind, (T.StringType, T.BinaryType)):
        _put_bytes(out, value.encode() if isinstance(value, str) else value)
    elif isinstance(kind, T.BooleanType):
        out.write(b"\x01" if value else b"\x00")
    elif isinstance(kind, (T.FloatType, T.DoubleType)):
        out.write(struct.pack("<f" if isinstance(kind, T.FloatType) else "<d", value))
    else:
        _put_long(out, value)


def _put_bytes(out: io.BytesIO, value: bytes) -> None:
    _put_long(out, len(value))
    out.write(value)


def header(content: bytes) -> tuple[Any, str, bytes, io.BytesIO]:
    """(schema, codec, sync mark, reader at the first block) of a container."""
    f = io.BytesIO(content)
    if f.read(4) != MAGIC:
        raise ValueError("not an Avro container")
    meta = dict(_blocks(f, lambda: (f.read(_long(f)).decode(), f.read(_long(f)))))
    return json.loads(meta["avro.schema"]), meta.get("avro.codec", b"null").decode(), f.read(16), f


def records(content: bytes) -> Iterator[dict]:
    """The records of a container, block by block."""
    schema, codec, sync, f = header(content)
    read = _decoder(schema, {})
    while f.tell() < len(content):
        n, data = _long(f), f.read(_long(f))
        if f.read(16) != sync:
            raise ValueError("a block does not end with the container's sync mark")
        if codec == "deflate":
            data = zlib.decompress(data, -15)
        elif codec == "zstandard":
            import zstandard

            data = zstandard.ZstdDecompressor().decompressobj().decompress(data)
        elif codec != "null":
            raise ValueError(f"codec {codec} is not supported")
        block = io.BytesIO(data)
        for _ in range(n):
            yield read(block)


def container(rows: list[dict], kind: T.StructType, codec: str = "deflate") -> bytes:
    """A container of ``rows``; the same rows give the same bytes."""
    out = io.BytesIO(MAGIC)
    out.seek(4)
    schema = json.dumps(avro_schema(kind)).encode()
    _put_long(out, 2)
    for k, v in (("avro.schema", schema), ("avro.codec", codec.encode())):
        _put_bytes(out, k.encode())
        _put_bytes(out, v)
    _put_long(out, 0)
    sync = hashlib.md5(schema).digest()
    out.write(sync)
    for lo in range(0, len(rows), BLOCK_ROWS):
        part, block = rows[lo : lo + BLOCK_ROWS], io.BytesIO()
        for r in part:
            for field in kind:
                _encode(block, field.dataType, r[field.name])
        data = block.getvalue()
        if codec == "deflate":
            packer = zlib.compressobj(wbits=-15)
            data = packer.compress(data) + packer.flush()
        _put_long(out, len(part))
        _put_bytes(out, data)
        out.write(sync)
    return out.getvalue()


# --- frames --------------------------------------------------------------------------


def to_containers(df: DataFrame, codec: str = "deflate") -> DataFrame:
    """(content, n): the rows of every partition as containers of at most ROWS rows each."""
    kind = df.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, ROWS):
                part = b.slice(lo, ROWS)
                yield pa.RecordBatch.from_arrays([pa.array([container(part.to_pylist(), kind, codec)], pa.binary()), pa.array([part.num_rows], pa.int64())], ["content", "n"])

    return df.mapInArrow(run, "content binary, n bigint")


def from_containers(df: DataFrame, schema: T.StructType, content: str = "content") -> DataFrame:
    """The records of all containers in a column, with the columns of ``schema`` that they have; others are null."""
    kinds = [(f.name, to_arrow_type(f.dataType)) for f in schema]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for raw in b.column(0):
                if not raw.is_valid:
                    continue
                rows: list[dict] = []
                for r in records(raw.as_py()):
                    rows.append(r)
                    if len(rows) == ROWS:
                        yield _batch(rows)
                        rows = []
                if rows:
                    yield _batch(rows)

    def _batch(rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r.get(n) for r in rows], k) for n, k in kinds], [n for n, _ in kinds])

    return df.select(content).mapInArrow(run, schema)


def read_containers(spark: SparkSession, path: str, schema: T.StructType | None = None, stream: bool = False, pattern: str = "*.avro", **more: str) -> DataFrame:
    """Rows of all containers below ``path``, as a batch or as a stream of files that arrive; without ``schema`` that of
    one of the files counts. ``more`` are options of Spark's file source, such as maxFilesPerTrigger."""
    options = {"pathGlobFilter": pattern, "recursiveFileLookup": "true", **more}
    if schema is None:
        first = spark.read.format("binaryFile").options(**options).load(path).select(F.substring("content", 1, 1 << 22)).first()
        if first is None:
            raise ValueError(f"no {pattern} below {path}")
        schema = spark_type(header(bytes(first[0]))[0])
    if stream:
        files = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length bigint, content binary").options(**options).load(path)
    else:
        files = spark.read.format("binaryFile").options(**options).load(path)
    return from_containers(files, schema)
