"""Small helpers for Arrow-batch functions that read whole texts."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 4 << 20


def slices(batches: Iterable[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches into zero-copy slices of at most ``limit`` bytes of
    ``column`` (one row at least), so working arrays stay bounded whatever
    the row lengths are. No row is cut or skipped."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes.astype(np.int64))
        start = 0
        while start < n:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def released(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches; between two of them what Arrow's memory pool holds unused goes back to the system."""
    for batch in batches:
        yield batch
        del batch
        pa.default_memory_pool().release_unused()


def mix64(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finalizer, element by element (uint64 in, uint64 out)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def list_column(values: np.ndarray, offsets: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))


def groups(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Whole groups of consecutive rows with equal ``keys``; the input must be
    sorted by them inside the partition. Holds one group at a time."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        cols = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        cuts = np.zeros(n, bool)
        for c in cols:
            cuts[1:] |= c[1:] != c[:-1]
        first = tuple(c[0] for c in cols)
        cuts[0] = last is not None and first != last
        start = 0
        for at in np.flatnonzero(cuts):
            if at > start:
                held.append(batch.slice(start, at - start))
            if held:
                yield pa.Table.from_batches(held)
            held, start = [], int(at)
        held.append(batch.slice(start))
        last = tuple(c[-1] for c in cols)
    if held:
        yield pa.Table.from_batches(held)
