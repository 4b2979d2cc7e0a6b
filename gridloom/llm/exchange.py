"""Shuffle of packed records: fixed-width numpy records travel as a few binary rows a task, not as a row each.

A map task deals its records into buckets and flushes one blob for each; the reduce side gets all blobs of a
bucket as one array. Buckets are sized by the caller from the bytes of the input, so memory stays bounded as
the input grows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

SCHEMA = "bucket int, blob binary"
FLUSH = 16 << 20


def dealt(records: np.ndarray, bucket: np.ndarray) -> pa.RecordBatch:
    """One row for each bucket that has records."""
    order = np.argsort(bucket, kind="stable")
    records, bucket = records[order], bucket[order]
    edges = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1], [True]])) if len(bucket) else np.zeros(1, np.int64)
    return pa.RecordBatch.from_arrays(
        [pa.array(bucket[edges[:-1]].astype(np.int32), pa.int32()), pa.array([records[a:b].tobytes() for a, b in zip(edges[:-1], edges[1:])], pa.binary())],
        ["bucket", "blob"],
    )


def packed(heads: np.ndarray, body: np.ndarray, size: np.ndarray, bucket: np.ndarray) -> pa.RecordBatch:
    """One row for each bucket of records that each have a head and ``size`` values of ``body``."""
    order = np.argsort(bucket, kind="stable")
    end = np.cumsum(size)[order]
    heads, bucket, start = heads[order], bucket[order], end - size[order]
    edge = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1], [True]])) if len(bucket) else np.zeros(1, np.int64)
    # Stretches are joined as they lie: an index of each value would take many times the body's bytes.
    view = memoryview(np.ascontiguousarray(body))
    join = lambda a, b: b"".join([view[x:y] for x, y in zip(start[a:b].tolist(), end[a:b].tolist())])
    return pa.RecordBatch.from_arrays(
        [pa.array(bucket[edge[:-1]].astype(np.int32), pa.int32()), pa.array([heads[a:b].tobytes() for a, b in zip(edge[:-1], edge[1:])], pa.binary()), pa.array([join(a, b) for a, b in zip(edge[:-1], edge[1:])], pa.binary())],
        ["bucket", "heads", "body"],
    )


def flushed(parts: Iterable[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
    """Gather (records, bucket) parts and emit blobs whenever FLUSH bytes are held."""
    held, size = [], 0
    for records, bucket in parts:
        if len(records):
            held.append((records, bucket))
            size += records.nbytes
        if size >= FLUSH:
            yield dealt(*(np.concatenate(x) for x in zip(*held)))
            held, size = [], 0
    if held:
        yield dealt(*(np.concatenate(x) for x in zip(*held)))


def reduce_buckets(packed: DataFrame, dtype: np.dtype, f: Callable[[int, np.ndarray], Iterable[pa.RecordBatch]], schema: str, arrow: pa.Schema) -> DataFrame:
    """Apply f(bucket, records) to each bucket."""

    def apply(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        blob = b"".join(x for chunk in table.column("blob").chunks for x in chunk.to_pylist())
        return pa.Table.from_batches(list(f(bucket, np.frombuffer(blob, dtype))), arrow)

    return packed.groupBy("bucket").applyInArrow(apply, schema)
