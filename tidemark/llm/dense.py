"""Counts in an array of fixed size, summed over all tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

CHUNK = 1 << 12


def count_rows(counts: np.ndarray) -> list[pa.Array]:
    """The array as rows (chunk, counts); its size must be a multiple of ``CHUNK``."""
    ends = pa.array(np.arange(0, len(counts) + 1, CHUNK), pa.int32())
    return [pa.array(np.arange(len(counts) // CHUNK), pa.int32()), pa.ListArray.from_arrays(ends, pa.array(counts))]


def _add(rows: pa.Table) -> pa.Table:
    lists = rows["counts"].combine_chunks()
    total = lists.flatten().to_numpy().reshape(len(lists), CHUNK).sum(axis=0)
    return pa.table({"chunk": rows["chunk"].slice(0, 1), "counts": pa.array([total], pa.list_(pa.int64()))})


def summed(rows: DataFrame, size: int) -> np.ndarray:
    """Add the tasks' arrays chunk by chunk; ``size`` numbers come to the driver, whatever the input."""
    out = np.zeros(size, dtype=np.int64)
    for r in rows.groupBy("chunk").applyInArrow(_add, "chunk int, counts array<long>").toLocalIterator():
        out[r.chunk * CHUNK : (r.chunk + 1) * CHUNK] = r.counts
    return out


def counted(frame: DataFrame, size: int, add: Callable[[np.ndarray, pa.RecordBatch], None]) -> np.ndarray:
    """Run ``add(counts, batch)`` over all batches of a frame and sum the counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(size, dtype=np.int64)
        for batch in batches:
            add(counts, batch)
        yield pa.RecordBatch.from_arrays(count_rows(counts), ["chunk", "counts"])

    return summed(frame.mapInArrow(run, "chunk int, counts array<long>"), size)
