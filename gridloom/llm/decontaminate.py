"""Benchmark decontamination by greedy string tiling.

Words are runs of letters and digits, ASCII lower-cased. A document is compared with a benchmark item only where
they share seeds (five words in a row), found by joining the seeds of each batch of documents with the sorted
seeds of the items. Each pair is tiled: running Karp-Rabin finds the longest matches between words that no tile
covers yet, they are marked without overlap, longest first, and the search length falls until five. Coverage is
the share of the item's words under tiles, so passages that were reordered or broken up still count. Pairs at
``threshold`` or more are reported.

The items travel in blocks of about ``block_bytes`` of text (all items of one item_id, at least); a larger benchmark
takes a scan of the documents for each block, and a block's results are written before the next block is read, so
neither what is sent to a task nor what the driver holds grows with it.

Items under five words match where a document holds their whole word sequence, as one tile.

Defined results: null or empty documents and items match nothing; an item without an item_id is reported with none,
unless one with an item_id has the same text, which then stands for it; items that repeat an item_id are tiled each, and
a document is reported once with that item_id, by the best coverage; a document row that repeats a doc_id is reported for each row; other columns are ignored; empty tables give no rows.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from gridloom.llm.session import materialize, release
from gridloom.llm.textkit import LOWER, Block, blocks, grams, word_hashes, words

MIN_TILE = 5
THRESHOLD = 0.5
BLOCK_BYTES = 16 << 20
GAP = np.ones(256, bool)
GAP[0x30:0x3A] = GAP[0x41:0x5B] = GAP[0x61:0x7B] = GAP[0x80:] = False
RADIX, MODULUS = 1_000_003, (1 << 61) - 1
SCHEMA = "doc_id bigint, item_id bigint, item_words int, matched_words int, n_tiles int, coverage double"


def karp_rabin(tokens: list[int], free: list[bool], length: int) -> Iterator[tuple[int, int]]:
    """(hash, start) of each stretch of ``length`` unmarked tokens, by a rolling hash."""
    top = pow(RADIX, length, MODULUS)
    h = run = 0
    for i, (t, ok) in enumerate(zip(tokens, free)):
        if not ok:
            h = run = 0
            continue
        h = (h * RADIX + t) % MODULUS
        run += 1
        if run > length:
            h = (h - tokens[i - length] * top) % MODULUS
        if run >= length:
            yield h, i - length + 1


def tile(item: list[int], text: list[int], least: int = MIN_TILE) -> list[tuple[int, int, int]]:
    """Greedy string tiling: (item start, text start, length) of tiles. Negative tokens match nothing.

    A match that could begin a word earlier is part of a longer one, so only matches that could not are walked: a text
    that repeats one phrase costs a look, not a walk, at each of its places.
    """
    free_a, free_b = [t >= 0 for t in item], [t >= 0 for t in text]
    tiles: list[tuple[int, int, int]] = []
    search = max(least, len(item) // 2)
    while True:
        table: dict[int, list[int]] = {}
        for h, j in karp_rabin(text, free_b, search):
            table.setdefault(h, []).append(j)
        longest, found = search, []
        for h, i in karp_rabin(item, free_a, search):
            for j in table.get(h, ()):
                if i and j and free_a[i - 1] and free_b[j - 1] and item[i - 1] == text[j - 1]:
                    continue
                k = 0
                while i + k < len(item) and j + k < len(text) and free_a[i + k] and free_b[j + k] and item[i + k] == text[j + k]:
                    k += 1
                if k > longest:
                    longest, found = k, []
                if k == longest:
                    found.append((i, j))
        for i, j in found:
            if all(free_a[i : i + longest]) and all(free_b[j : j + longest]):
                free_a[i : i + longest] = free_b[j : j + longest] = [False] * longest
                tiles.append((i, j, longest))
        if not found:
            if search == least:
                return tiles
            search = max(least, search // 2)


class Items:
    """A block of the benchmark: its words, and where each seed stands."""

    def __init__(self, ids: list[int], texts: list[str]):
        raw = [t.encode() for t in texts]
        data = LOWER[np.frombuffer(b"".join(raw), np.uint8)]
        offs = np.concatenate([[0], np.cumsum([len(t) for t in raw])]).astype(np.int64)
        starts, ends, first = words(data, offs, GAP)
        hashed = word_hashes(data, starts, ends)
        seeds, at = grams(hashed, first, MIN_TILE)
        item = np.repeat(np.arange(len(ids)), np.diff(at))
        order = np.argsort(seeds, kind="stable")
        self.ids, self.first = ids, first
        self.tokens = (hashed >> np.uint64(4)).astype(np.int64)
        self.seeds, self.items = seeds[order], item[order]
        self.distinct, self.begin = np.unique(self.seeds, return_index=True)
        self.begin = np.append(self.begin, len(self.seeds))
        #: By number of words below a seed's: the sequences of items of so many words, in order, and those items.
        self.short: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for n in range(1, MIN_TILE):
            whole, at = grams(hashed, first, n)
            own = np.flatnonzero(np.diff(first) == n)
            if len(own):
                order = np.argsort(whole[at[own]], kind="stable")
                self.short[n] = whole[at[own]][order], own[order]


def short_hits(items: Items, hashed: np.ndarray, first: np.ndarray) -> Iterator[tuple[int, int, tuple]]:
    """(row, item, result) of each document and item under a seed's length that it holds whole."""
    for n, (whole, own) in items.short.items():
        seen, at = grams(hashed, first, n)
        lo, hi = np.searchsorted(whole, seen, "left"), np.searchsorted(whole, seen, "right")
        hit = np.flatnonzero(hi > lo)
        doc = np.searchsorted(at, hit, "right") - 1
        for d, i in sorted({(d, i) for d, a, b in zip(doc.tolist(), lo[hit].tolist(), hi[hit].tolist()) for i in own[a:b].tolist()}):
            yield d, i, (n, n, 1, 1.0)


def long_hits(items: Items, hashed: np.ndarray, first: np.ndarray, threshold: float) -> Iterator[tuple[int, int, tuple]]:
    """(row, item, result) of each document and item whose tiles cover enough of the item."""
    seeds, at = grams(hashed, first, MIN_TILE)
    if not len(seeds) or not len(items.distinct):
        return
    where = np.minimum(np.searchsorted(items.distinct, seeds), len(items.distinct) - 1)
    hit = np.flatnonzero(items.distinct[where] == seeds)
    tokens = (hashed >> np.uint64(4)).astype(np.int64)
    doc = np.searchsorted(at, hit, "right") - 1
    edge = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1], [True]])) if len(hit) else np.zeros(1, np.int64)
    for a, b in zip(edge[:-1], edge[1:]):
        d = doc[a]
        for i, result in tiled(items, where[hit[a:b]], hit[a:b] - at[d], tokens[first[d] : first[d + 1]], threshold):
            yield int(d), i, result


def hits(items: Items, block: Block, threshold: float) -> Iterator[tuple[int, tuple]]:
    """(row, (item_id, ...)) of each document of a block and item_id at ``threshold`` or more, by the best coverage."""
    data = LOWER[block.data]
    starts, ends, first = words(data, block.offs, GAP)
    hashed = word_hashes(data, starts, ends)
    best: dict[tuple, tuple] = {}
    for d, i, result in itertools.chain(short_hits(items, hashed, first), long_hits(items, hashed, first, threshold)):
        known = items.ids[i]
        key = (d, known is None, i if known is None else known)
        if key not in best or (result[3], result[0]) > (best[key][4], best[key][1]):  # of equal coverage the longer item
            best[key] = (known, *result)
    for key in sorted(best):
        yield key[0], best[key]


def compared(items: Items, threshold: float):
    """Batches of documents to rows of SCHEMA."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            ids = block.rows.column("doc_id").to_pylist()
            out = [(ids[d], *result) for d, result in hits(items, block, threshold)]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.float64()))], ["doc_id", "item_id", "item_words", "matched_words", "n_tiles", "coverage"])

    return apply


def tiled(items: Items, seeds: np.ndarray, places: np.ndarray, tokens: np.ndarray, threshold: float) -> Iterator[tuple]:
    """Tile one document with each item that its seeds could cover enough."""
    count = items.begin[seeds + 1] - items.begin[seeds]
    rep = np.repeat(np.arange(len(seeds)), count)
    item = items.items[np.repeat(items.begin[seeds], count) + np.arange(len(rep)) - np.repeat(np.cumsum(count) - count, count)]
    place = places[rep]
    for i in np.unique(item):
        size = int(items.first[i + 1] - items.first[i])
        own = np.unique(place[item == i])
        if len(own) + (MIN_TILE - 1) * (1 + np.count_nonzero(np.diff(own) > 1)) < threshold * size:
            continue
        # Only words under shared seeds can be in a tile: the rest of the text falls away, a break in its place.
        text: list[int] = []
        end = -1
        for p in own.tolist():
            if p > end:
                text.append(-1)
                end = p
            text += tokens[end : p + MIN_TILE].tolist()
            end = p + MIN_TILE
        tiles = tile(items.tokens[items.first[i] : items.first[i + 1]].tolist(), text)
        matched = sum(k for _, _, k in tiles)
        if matched >= threshold * size:
            yield int(i), (size, matched, len(tiles), matched / size)


def item_blocks(benchmark: DataFrame, block_bytes: int) -> Iterator[Items]:
    """The benchmark in blocks, items of one item_id in one block; the driver holds one at a time."""
    ids, texts, size = [], [], 0
    texts_of = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), "text").filter("text IS NOT NULL")
    named = texts_of.filter("item_id IS NOT NULL")
    nameless = texts_of.filter("item_id IS NULL").join(named.select("text").distinct(), "text", "left_anti").select("item_id", "text")
    for item_id, text in named.unionByName(nameless).orderBy(F.col("item_id").asc_nulls_last(), "text").toLocalIterator():
        if size >= block_bytes and (item_id is None or item_id != ids[-1]):
            yield Items(ids, texts)
            ids, texts, size = [], [], 0
        ids.append(item_id)
        texts.append(text)
        size += len(text.encode())
    if ids:
        yield Items(ids, texts)


def decontaminate(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row for each document and item of which it holds ``threshold`` of the words or more."""
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").filter("text IS NOT NULL")
    done, waiting = [], None
    for items in item_blocks(benchmark, block_bytes):
        if waiting is not None:  # another block follows: write what this one found and let go of its items
            done.append(materialize(waiting, "contaminated"))
        waiting = texts.mapInArrow(compared(items, threshold), SCHEMA)
    if waiting is None:
        return docs.sparkSession.createDataFrame([], SCHEMA)
    return reduce(DataFrame.unionByName, [*done, waiting])


def clean(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows that hold no benchmark item, with all their columns; nothing is joined or shuffled."""

    def without(items: Items):
        def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for block in blocks(batches):
                keep = np.ones(block.n, bool)
                for d, _ in hits(items, block, threshold):
                    keep[d] = False
                yield block.rows.filter(pa.array(keep))

        return apply

    schema, written, waiting = docs.schema, None, None
    for items in item_blocks(benchmark, block_bytes):
        if waiting is not None:
            left = materialize(waiting, "clean")
            if written is not None:
                release(written)
            docs = written = left
        waiting = docs.mapInArrow(without(items), schema)
    return docs if waiting is None else waiting
