"""Anchors that repeated windows must share, and a count-min sketch of them.

Every window of ``width`` elements is known by its smallest hashed gram (a minimiser): equal windows have equal
minimisers at equal places, so a window can only repeat if its minimiser's hash does. Windows of one text that
share a minimiser make a segment. Counting minimisers therefore overestimates the counts of windows, with some
twenty times fewer entries.

The sketch has two rows of cells for saturating counts. Each task sends the cells it touched; slices of the rows
are summed apart, and one bit a cell, "twice or more", goes to the second pass. Cells grow with the input up to
``MOST_BITS``, which bounds what is broadcast to 128 MB: beyond that the sketch lets more through (``share_let_through``
says how much), and still loses nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from gridloom.llm.exchange import SCHEMA, flushed, reduce_buckets
from gridloom.llm.session import plan_bytes
from gridloom.llm.textkit import U64

MOST_BITS = 29
SLICE_BITS = 20
#: Places take the low bits of what is compared; Arrow holds no longer text than they count.
_PLACE = U64((1 << 31) - 1)


def segments(grams: np.ndarray, first: np.ndarray, per_window: int, width: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of windows with one minimiser: text, first window, windows, and the minimiser's place.

    grams: hashes of all grams of all texts, text i having first[i]:first[i + 1]; a window is ``per_window`` grams
    in a row and is known by the place of its first gram. width: places that a window needs, where ``first``
    counts more places than a text has grams.
    """
    none = np.zeros(0, np.int64)
    n = len(grams) - per_window + 1
    if n <= 0:
        return none, none, none, none
    low = (grams & ~_PLACE) | np.arange(len(grams), dtype=U64)
    span = 1
    while span * 2 <= per_window:
        low = np.minimum(low[: len(low) - span], low[span:])
        span *= 2
    low = np.minimum(low[:n], low[per_window - span : per_window - span + n])
    count = np.maximum(np.diff(first) - (width or per_window) + 1, 0)
    begin = np.repeat(first[:-1], count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    if not len(begin):
        return none, none, none, none
    text = np.repeat(np.arange(len(count)), count)
    place = (low[begin] & _PLACE).astype(np.int64)
    new = np.ones(len(begin), bool)
    new[1:] = (place[1:] != place[:-1]) | (text[1:] != text[:-1])
    head = np.flatnonzero(new)
    return text[head], begin[head], np.diff(np.append(head, len(begin))), place[head]


def cell_bits(docs: DataFrame, bytes_per_anchor: float) -> int:
    """Sketch size: four cells or more for each expected anchor, 2**MOST_BITS at most."""
    expected = plan_bytes(docs) * 2 / bytes_per_anchor
    return int(min(MOST_BITS, max(SLICE_BITS, np.ceil(np.log2(max(expected * 4, 2))))))


def share_let_through(anchors: float, bits: int) -> float:
    """Expected share of anchors met once that the sketch takes for repeated, with so many different anchors in it."""
    return float((1 - np.exp(-anchors / 2**bits)) ** 2)


def cells(anchors: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The cell of each anchor in either row."""
    return (anchors >> U64(64 - bits)).astype(np.int64), ((anchors * U64(0xA24BAED4963EE407)) >> U64(64 - bits)).astype(np.int64)


class Sketch:
    """Which cells of the two rows were counted twice or more."""

    def __init__(self, bits: int, rows: list[np.ndarray]):
        self.bits, self.rows = bits, rows

    def repeated(self, anchors: np.ndarray) -> np.ndarray:
        out = np.ones(len(anchors), bool)
        for row, at in zip(self.rows, cells(anchors, self.bits)):
            out &= ((row[at >> 3] >> (at & 7).astype(np.uint8)) & 1).astype(bool)
        return out


def sketch(docs: DataFrame, anchors: Callable[[Iterator[pa.RecordBatch]], Iterator[np.ndarray]], bits: int) -> Sketch:
    """Count-min sketch of all anchors that ``anchors`` gives for the batches of each task."""
    record = np.dtype([("cell", "<u4"), ("twice", "u1")])
    per_row = 1 << (bits - SLICE_BITS)

    def touched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def parts():
            held, size = [], 0
            for a in anchors(batches):
                held.append(a)
                size += len(a)
                if size >= 1 << 20:
                    yield from dealt(np.concatenate(held))
                    held, size = [], 0
            if held:
                yield from dealt(np.concatenate(held))

        def dealt(a: np.ndarray):
            for row, at in enumerate(cells(a, bits)):
                at, n = np.unique(at, return_counts=True)
                out = np.empty(len(at), record)
                out["cell"], out["twice"] = at & ((1 << SLICE_BITS) - 1), n > 1
                yield out, row * per_row + (at >> SLICE_BITS)

        yield from flushed(parts())

    def merge(bucket: int, got: np.ndarray) -> Iterator[pa.RecordBatch]:
        count = np.bincount(got["cell"], 1.0 + got["twice"], 1 << SLICE_BITS)
        bits_ = np.packbits(count >= 2, bitorder="little")
        yield pa.RecordBatch.from_arrays([pa.array([bucket], pa.int32()), pa.array([bits_.tobytes()], pa.binary())], ["bucket", "blob"])

    arrow = pa.schema([("bucket", pa.int32()), ("blob", pa.binary())])
    rows = [np.zeros((1 << bits) // 8, np.uint8) for _ in range(2)]
    step = (1 << SLICE_BITS) // 8
    for bucket, blob in reduce_buckets(docs.mapInArrow(touched, SCHEMA), record, merge, SCHEMA, arrow).toLocalIterator():
        row, at = divmod(bucket, per_row)
        rows[row][at * step : (at + 1) * step] = np.frombuffer(blob, np.uint8)
    return Sketch(bits, rows)
