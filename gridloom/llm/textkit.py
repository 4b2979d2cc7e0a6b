"""Vectorised work on whole batches of texts: numpy over Arrow's own buffers, no loop over words.

Words are maximal runs of bytes other than 0x20 and 0x09-0x0D. Those are ASCII, so UTF-8 text can be cut
byte by byte. Hashes are 64-bit polynomials modulo 2**64, mixed at the end. Such polynomials agree on some long
strings of two letters (Thue-Morse words of 1,024 letters and more), so stretches of over ``SHORT`` bytes are hashed
by XXH3. Hashes depend on nothing but the bytes, so every executor gets the same; where equality decides a result,
operators compare the bytes, or words, as well.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

U64 = np.uint64
BYTE_BASE = U64(0x9E3779B97F4A7C15)
WORD_BASE = U64(0xC2B2AE3D27D4EB4F)
#: Longest stretch of bytes known by a polynomial.
SHORT = 32
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32
#: Bytes that are in no letter: ASCII other than A-Z and a-z.
NO_LETTER = np.ones(256, bool)
NO_LETTER[0x41:0x5B] = NO_LETTER[0x61:0x7B] = NO_LETTER[0x80:] = False


@dataclass
class Block:
    """Some rows of a batch: their texts end to end in ``data``, text i in offs[i]:offs[i + 1]."""

    rows: pa.RecordBatch
    data: np.ndarray
    offs: np.ndarray

    @property
    def n(self) -> int:
        return len(self.offs) - 1

    def text(self, i: int) -> bytes:
        return self.data[self.offs[i] : self.offs[i + 1]].tobytes()


def blocks(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = 1 << 20) -> Iterator[Block]:
    """Cut batches into blocks of about ``most`` bytes of text (one row at least); a null text is an empty one."""
    for batch in batches:
        if not batch.num_rows:
            continue
        col = pc.fill_null(batch.column(column).cast(pa.large_string()), "")
        offs = np.frombuffer(col.buffers()[1], np.int64)[col.offset : col.offset + len(col) + 1]
        raw = col.buffers()[2]
        data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
        at = 0
        while at < len(col):
            end = max(at + 1, int(np.searchsorted(offs, offs[at] + most, "right")) - 1)
            yield Block(batch.slice(at, end - at), data[offs[at] : offs[end]], offs[at : end + 1] - offs[at])
            at = end


def words(data: np.ndarray, offs: np.ndarray, gap: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and for each text the number of the first of its words (n + 1 entries).

    gap: the bytes that part words, as a table of 256 booleans.
    """
    return runs(~gap[data], offs)


def runs(word: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True in ``word``, none of which crosses the end of a text; see ``words``."""
    n = len(word)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offs), np.int64)
    edge = np.zeros(n + 1, bool)
    edge[offs] = True
    before = np.empty(n, bool)
    before[0], before[1:] = False, word[:-1]
    after = np.empty(n, bool)
    after[-1], after[:-1] = False, word[1:]
    starts = np.flatnonzero(word & (~before | edge[:-1]))
    ends = np.flatnonzero(word & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offs)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread all bits of 64-bit values (a bijection)."""
    h = h ^ (h >> U64(30))
    h *= U64(0xBF58476D1CE4E5B9)
    h ^= h >> U64(27)
    h *= U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


@lru_cache(4)
def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for b in (base, pow(base, -1, 1 << 64)):
        p = np.full(n, b, U64)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return tuple(out)


def powers(base: np.uint64, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i for i below n, modulo 2**64."""
    p, q = _powers(int(base), 1 << max(16, int(max(n, 1) - 1).bit_length()))
    return p[:n], q[:n]


def prefix(values: np.ndarray, base: np.uint64) -> np.ndarray:
    """Running polynomial sums, one more than values."""
    out = np.zeros(len(values) + 1, U64)
    np.cumsum(values * powers(base, len(values))[0], out=out[1:])
    return out


def spans(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: np.uint64) -> np.ndarray:
    """Hash of each stretch starts[i]:ends[i] of the values behind ``sums``."""
    if not len(starts):
        return np.zeros(0, U64)
    inv = powers(base, len(sums))[1]
    return mix((sums[ends] - sums[starts]) * inv[starts] + (ends - starts).astype(U64) * U64(0x9FB21C651E98DF25))


def byte_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit hash of each stretch of bytes, whatever its length."""
    out = spans(prefix(data.astype(U64) + U64(1 + seed), BYTE_BASE), starts, ends, BYTE_BASE)
    long = np.flatnonzero(ends - starts > SHORT)
    if len(long):
        view = memoryview(np.ascontiguousarray(data))
        out[long] = np.fromiter((xxhash.xxh3_64_intdigest(view[a:b], seed) for a, b in zip(starts[long].tolist(), ends[long].tolist())), U64, len(long))
    return out


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each word's bytes."""
    return byte_hashes(data, starts, ends)


def grams(hashes: np.ndarray, first: np.ndarray, n: int, short: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all n-word windows of each text, and per text the number of its first window (one more entry).

    short: a text of 1 to n - 1 words gives its whole sequence as one window.
    """
    count = np.diff(first)
    have = np.maximum(count - n + 1, 0)
    if short:
        have = np.where((have == 0) & (count > 0), 1, have)
    at = np.concatenate([[0], np.cumsum(have)])
    text = np.repeat(np.arange(len(count)), have)
    begin = first[:-1][text] + (np.arange(at[-1]) - at[:-1][text])
    end = np.minimum(begin + n, first[1:][text])
    return spans(prefix(hashes, WORD_BASE), begin, end, WORD_BASE), at


def covered(length: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Boolean mask of 0..length-1 with every starts[i]:ends[i] set."""
    if not len(starts):
        return np.zeros(length, bool)
    step = np.zeros(length + 1, np.int32)
    np.add.at(step, starts, 1)
    np.add.at(step, ends, -1)
    return np.cumsum(step[:-1]) > 0
