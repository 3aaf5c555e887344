"""Whole light curves in Arrow batches.

Spark partitions rows by the curve's key and sorts them within partitions; a task reads its sorted rows as a stream and
cuts it where a curve ends, so numpy works on many curves at once. A worker holds one part of CURVE_ROWS rows, or one
curve where that is longer.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

#: Rows handed to a kernel at once; a longer curve is handed over whole.
CURVE_ROWS = 1 << 16

#: (columns, first row of each curve) to the kernel's columns, which have one row for each curve it keeps.
Kernel = Callable[[dict[str, np.ndarray], np.ndarray], dict[str, np.ndarray]]


def _last_start(b: pa.RecordBatch | pa.Table, n_keys: int) -> int:
    """The row at which the batch's last curve starts."""
    same = np.ones(b.num_rows, bool)
    for k in range(n_keys):
        last = b.column(k)[b.num_rows - 1]
        equal = pc.equal(b.column(k), last) if last.is_valid else pc.is_null(b.column(k))
        same &= pc.fill_null(equal, False).to_numpy(zero_copy_only=False)
    return b.num_rows - int(same.sum())


def _row(b: pa.RecordBatch, at: int, n_keys: int) -> tuple:
    return tuple(b.column(k)[at].as_py() for k in range(n_keys))


def whole_curves(batches: Iterator[pa.RecordBatch], n_keys: int, rows: int) -> Iterator[pa.Table]:
    """Tables of whole curves from batches that are sorted by their first ``n_keys`` columns."""
    done: list[pa.RecordBatch] = []
    held: list[pa.RecordBatch] = []  # the curve that may go on
    size = 0
    for b in batches:
        if not b.num_rows:
            continue
        cut = _last_start(b, n_keys)
        if cut == 0 and held and _row(held[-1], 0, n_keys) == _row(b, 0, n_keys):
            held.append(b)
            continue
        done += held
        size += sum(x.num_rows for x in held)
        if cut:
            done.append(b.slice(0, cut))
            size += cut
        held = [b.slice(cut)]
        if size >= rows:
            yield pa.Table.from_batches(done).combine_chunks()
            done, size = [], 0
    if done or held:
        yield pa.Table.from_batches(done + held).combine_chunks()


def starts_of(table: pa.Table, n_keys: int) -> np.ndarray:
    """The first row of each curve."""
    new = np.zeros(table.num_rows, bool)
    new[:1] = True
    for k in range(n_keys):
        codes = table.column(k).combine_chunks().dictionary_encode().indices
        codes = pc.fill_null(codes, -1).to_numpy(zero_copy_only=False)
        new[1:] |= codes[1:] != codes[:-1]
    return np.flatnonzero(new)


def finite(values: np.ndarray) -> pa.Array:
    """An Arrow column; what is not finite is null."""
    values = np.asarray(values, np.float64)
    return pa.array(values, mask=~np.isfinite(values))


def map_curves(df: DataFrame, keys: list[str], order: list[str], columns: list[str], kernel: Kernel, schema: str, least: int = 1) -> DataFrame:
    """Apply ``kernel`` to all light curves of at least ``least`` rows, sorted by ``order``.

    ``columns`` come as float64 arrays (null as NaN). The kernel's columns, named by ``schema``, have one row for each
    curve that was handed over, or for each number of a curve in its column ``curve``; values that are not finite become
    null. The result has the keys before them.
    """
    names = [x.strip().split(" ")[0] for x in schema.split(",")]
    n_keys, rows, own = len(keys), CURVE_ROWS, [*keys, *columns]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_curves(batches, n_keys, rows):
            starts = starts_of(table, n_keys)
            sizes = np.diff(np.append(starts, table.num_rows))
            if (sizes < least).any():
                table = table.filter(pa.array(np.repeat(sizes >= least, sizes))).combine_chunks()
                starts = np.cumsum(sizes[sizes >= least]) - sizes[sizes >= least]
            if not len(starts):
                continue
            data = {c: pc.cast(table.column(c), pa.float64()).to_numpy() for c in columns}
            with np.errstate(all="ignore"):
                out = kernel(data, starts)
            at = pa.array(starts[out["curve"]] if "curve" in out else starts)
            yield pa.RecordBatch.from_arrays([table.column(k).combine_chunks().take(at) for k in range(n_keys)] + [finite(out[c]) for c in names], [*keys, *names])

    kinds = ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys)
    dealt = df.select(*dict.fromkeys([*own, *order])).repartition(*keys).sortWithinPartitions(*keys, *order).select(*own)
    return dealt.mapInArrow(run, f"{kinds}, {schema}")
