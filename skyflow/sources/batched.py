"""A stream of Parquet files whose batches end at a number of rows or after a time, whichever comes first.

Spark's own file source bounds a batch from above only, so a slow stream gives a batch for each trigger, however few rows
there are. Here rows wait, unread, until enough are there or the time is over; a batch never holds more than its bound,
so a file that holds more is cut, and every file range of a batch is one task.
"""

from __future__ import annotations

import json
import time
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

_START = {"time": 0, "name": "", "rows": 0}
#: Rows in one Arrow batch.
ROWS = 10_000


def _files(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if ":" in path.partition("/")[0] else (pafs.LocalFileSystem(), path)


class Range(InputPartition):
    """Rows ``lo`` to ``hi`` of a file."""

    def __init__(self, name: str, lo: int, hi: int):
        self.name, self.lo, self.hi = name, lo, hi


class WaitingReader(DataSourceStreamReader):
    """An offset names the last file of a batch, in order of time and name, and how many of its rows were taken."""

    def __init__(self, schema: StructType, options: dict[str, str]):
        self.schema, self.path, self.checkpoint = schema, options["path"], options["checkpoint"]
        self.rows, self.seconds, self.settle = int(options["rows"]), float(options["seconds"]), float(options.get("settle", 0))
        self.at, self.since, self.sizes = None, 0.0, {}

    # --- offsets, on the driver

    def initialOffset(self) -> dict:
        return dict(_START)

    def latestOffset(self) -> dict:
        now = time.time()
        if self.at is None:
            self.at, self.since = self._resumed(), now
        waiting = self._after(self.at, now - self.settle)
        n = sum(size - lo for _, _, lo, size in waiting)
        if n >= self.rows or n and now - self.since >= self.seconds:
            self.at, self.since = self._moved(waiting, min(n, self.rows)), now
        return dict(self.at)

    def _resumed(self) -> dict:
        """Where a query with this checkpoint goes on: the last end it wrote to its offset log."""
        fs, base = _files(self.checkpoint)
        found = fs.get_file_info(pafs.FileSelector(f"{base}/offsets", allow_not_found=True))
        logs = [f for f in found if f.base_name.isdigit()]
        if not logs:
            return dict(_START)
        with fs.open_input_stream(max(logs, key=lambda f: int(f.base_name)).path) as f:
            last = f.read().decode().strip().splitlines()[-1]
        return dict(_START) if last == "-" else json.loads(last)

    def _after(self, at: dict, before: float | None = None) -> list[tuple[int, str, int, int]]:
        """(time, path, first row not taken, rows) of the files from ``at`` on."""
        fs, base = _files(self.path)
        out = []
        for f in fs.get_file_info(pafs.FileSelector(base, recursive=True, allow_not_found=True)):
            hidden = any(p[:1] in "._" for p in f.path[len(base) :].strip("/").split("/"))
            key = (f.mtime_ns, f.path)
            if f.type != pafs.FileType.File or hidden or not f.path.endswith(".parquet") or key < (at["time"], at["name"]) or before is not None and f.mtime_ns > before * 1e9:
                continue
            if key not in self.sizes:
                with fs.open_input_file(f.path) as file:
                    self.sizes[key] = pq.read_metadata(file).num_rows
            out.append((*key, at["rows"] if key == (at["time"], at["name"]) else 0, self.sizes[key]))
        self.sizes = {(t, name): size for t, name, _, size in out}
        return sorted(out)

    @staticmethod
    def _moved(waiting: list[tuple[int, str, int, int]], n: int) -> dict:
        for t, name, lo, size in waiting:
            if n <= size - lo:
                return {"time": t, "name": name, "rows": lo + n}
            n -= size - lo
        raise ValueError("fewer rows wait than a batch takes")

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        last = (end["time"], end["name"])
        cut = [(name, lo, end["rows"] if (t, name) == last else size) for t, name, lo, size in self._after(start) if (t, name) <= last]
        return [Range(name, lo, hi) for name, lo, hi in cut if hi > lo]

    def commit(self, end: dict) -> None:
        pass

    # --- rows, in tasks

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        kind = to_arrow_schema(self.schema)
        fs, _ = _files(self.path)
        with fs.open_input_file(partition.name) as f:
            file = pq.ParquetFile(f)
            groups, first = [], 0
            for g in range(file.num_row_groups):
                size = file.metadata.row_group(g).num_rows
                if first < partition.hi and first + size > partition.lo:
                    groups.append((g, first))
                first += size
            if not groups:
                return
            at = groups[0][1]
            present = [n for n in kind.names if n in file.schema_arrow.names]
            for b in file.iter_batches(ROWS, [g for g, _ in groups], present):
                lo, hi = max(partition.lo - at, 0), min(partition.hi - at, b.num_rows)
                at += b.num_rows
                if hi > lo:
                    part = b.slice(lo, hi - lo)
                    cols = [part.column(f.name).cast(f.type) if f.name in present else pa.nulls(part.num_rows, f.type) for f in kind]
                    yield pa.RecordBatch.from_arrays(cols, kind.names)


class WaitingFiles(DataSource):
    """Options: ``path``, ``checkpoint`` of the query, ``rows``, ``seconds``, ``settle`` (0)."""

    @classmethod
    def name(cls) -> str:
        return "waiting_files"

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return WaitingReader(schema, self.options)


def batched_files(spark: SparkSession, path: str, schema: StructType | str, checkpoint: str, rows: int, seconds: float, settle: float = 0) -> DataFrame:
    """Rows of the Parquet files that arrive below ``path``; a batch ends at ``rows`` rows or ``seconds`` after the one
    before it, the earlier of both, and there is none without rows.

    ``checkpoint`` is that of the query which reads the stream, so that it goes on where it stopped. Files are taken by
    time and name; where the clocks of writers differ, ``settle`` seconds more than they differ by let none be missed.
    A file must be whole when it appears. Columns that a file lacks are null. Trigger it by a processing time shorter than ``seconds``.
    """
    spark.dataSource.register(WaitingFiles)
    return spark.readStream.format("waiting_files").schema(schema).options(path=path, checkpoint=checkpoint, rows=rows, seconds=seconds, settle=settle).load()
