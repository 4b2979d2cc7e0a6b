"""Suffix-array dedup of byte strings.

Every ``WIDTH``-byte string that also starts earlier (smaller doc_id, or earlier in the same document) is
removed, overlaps included. Which strings can repeat at all is found first: the windows of a text fall into
segments by their minimiser, minimisers are sketched, and segments whose minimiser may repeat are grouped by
it. Segments equal as a whole (of one minimiser and one 128-bit hash) repeat as a whole; where one minimiser has
different segments, their bytes go to the minimiser's bucket, and there a suffix array by linear grouping brings
equal windows side by side, each run checked byte for byte; all but the earliest of a run are marked. Every window
lies in one segment, and equal windows have one minimiser, so nothing is lost between buckets.

Texts equal as a whole need no windows: only the smallest doc_id's is searched, later copies go entirely.
Records are packed; memory holds one bucket at a time, and a task sends one of equal segments on.

Defined results: null text counts as empty; texts under ``WIDTH`` bytes lose nothing; a null doc_id comes last
of all; rows that repeat both doc_id and text are one document, given once for each row; rows that repeat a
doc_id with other texts are ordered by a hash of the text; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F

from gridloom.llm import gsaca
from gridloom.llm.anchors import Sketch, cell_bits, segments, sketch
from gridloom.llm.exchange import dealt, packed
from gridloom.llm.gsaca import HEAD, MARK
from gridloom.llm.session import buckets_for, materialize
from gridloom.llm.textkit import BYTE_BASE, U64, WORD_BASE, Block, blocks, covered, mix, powers, prefix, spans

WIDTH = 100
GRAM = 20
BYTES_PER_ANCHOR = 35
LAST = (1 << 63) - 1
SECOND = U64(0xD6E8FEB86659FD93)
#: place: of the minimiser in the segment; often: its minimiser has over ``OFTEN`` different segments.
SEGMENT = np.dtype([("anchor", "<u4"), ("n", "u1"), ("place", "u1"), ("often", "<u2"), ("seg", "<u8"), ("seg2", "<u8"), ("doc", "<i8"), ("key", "<i8"), ("start", "<u4")])
OFTEN = 10_000
#: Windows of such segments are dealt by where they lie to the minimiser, in steps of PART, and by the bytes they all hold.
PART = 16
SENT, MARKED, COPY = 0, 1, 2
ROW = "bucket int, kind int, blob binary"
BLOCK = 1 << 20


def keyed(docs: DataFrame) -> DataFrame:
    """doc (null last), key (of doc and text), the text's own hash, the text, and doc_id."""
    text = F.coalesce(F.col("text"), F.lit(""))
    doc = F.col("doc_id").cast("bigint")
    return docs.select(doc.alias("doc_id"), F.coalesce(doc, F.lit(LAST)).alias("doc"), text.alias("text"), F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(1), text).alias("k2")).withColumn("key", F.xxhash64("doc", "k1", "k2"))


def cut(block: Block, width: int):
    """Segments of a block: text, first window, windows, the minimiser's place, its hash, and the segment's two hashes.

    A segment is hashed by the mixed hashes of all its grams, which are no polynomial of its bytes.
    """
    sums = prefix(block.data.astype(U64) + U64(1), BYTE_BASE)
    n = len(block.data) - GRAM + 1
    small = mix((sums[GRAM:] - sums[:-GRAM]) * powers(BYTE_BASE, n)[1]) if n > 0 else np.zeros(0, U64)
    text, begin, count, place = segments(small, block.offs, width - GRAM + 1, width)
    end = begin + count + width - GRAM
    seg = spans(prefix(small, WORD_BASE), begin, end, WORD_BASE) + mix((place - begin).astype(U64))
    return text, begin, count, place, small[place], seg, spans(prefix(mix(small ^ SECOND), BYTE_BASE), begin, end, BYTE_BASE)


def searched(block: Block, seen: dict[tuple[int, int], int]) -> np.ndarray:
    """Texts that may be the first of their copies, as far as this task has read."""
    out = np.zeros(block.n, bool)
    for i, (a, b, doc) in enumerate(zip(*(block.rows.column(c).to_pylist() for c in ("k1", "k2", "doc")))):
        out[i] = doc < seen.get((a, b), LAST + 1)
        if out[i]:
            seen[a, b] = doc
    return out


def split(records: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The first of equal segments, and marks for the others, whose windows all start earlier as well."""
    order = np.lexsort((records["start"], records["key"], records["doc"], records["seg2"], records["seg"], records["anchor"]))
    r = records[order]
    same = (r["anchor"][1:] == r["anchor"][:-1]) & (r["seg"][1:] == r["seg"][:-1]) & (r["seg2"][1:] == r["seg2"][:-1])
    twin = same & (r["doc"][1:] == r["doc"][:-1]) & (r["key"][1:] == r["key"][:-1]) & (r["start"][1:] == r["start"][:-1])
    first = np.concatenate([[True], ~same])[: len(r)]
    again = r[~first & ~np.concatenate([[False], twin])[: len(r)]]
    marks = np.zeros(len(again), MARK)
    marks["doc"], marks["key"], marks["start"], marks["end"] = again["doc"], again["key"], again["start"], again["start"] + again["n"].astype(np.uint32) - 1 + width
    return r[first], marks


def rows(records: np.ndarray, bucket: np.ndarray, kind: int) -> pa.RecordBatch:
    batch = dealt(records, bucket)
    return pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.full(batch.num_rows, kind, np.int32)), batch.column(1)], ["bucket", "kind", "blob"])


def of_doc(records: np.ndarray, n: int) -> np.ndarray:
    return np.mod(records["key"], n)


def blobs(table: pa.Table, column: str, dtype: np.dtype, kind: int | None = None) -> np.ndarray:
    if kind is not None:
        table = table.filter(pa.compute.equal(table.column("kind"), kind))
    return np.frombuffer(b"".join(x for c in table.column(column).chunks for x in c.to_pylist()), dtype)


def grouped(texts: DataFrame, found: Broadcast, n_buckets: int, n_docs: int, width: int) -> DataFrame:
    """By document bucket: marks of segments that repeat as a whole, and segments to be compared (SENT)."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: Sketch = found.value
        seen: dict[tuple[int, int], int] = {}
        held, size = [], 0

        def flush():
            keep, marks = split(np.concatenate(held), width)
            yield rows(keep, keep["anchor"].astype(np.int64) % n_buckets, SENT)
            yield rows(marks, of_doc(marks, n_buckets), MARKED)

        for block in blocks(batches, most=BLOCK):
            text, begin, n, place, anchor, seg, seg2 = cut(block, width)
            use = np.flatnonzero(searched(block, seen)[text] & known.repeated(anchor))
            out = np.zeros(len(use), SEGMENT)
            owner = text[use]
            out["place"] = (place - begin)[use]
            out["seg"], out["seg2"] = seg[use], seg2[use]
            out["anchor"], out["n"], out["start"] = anchor[use] & U64(0xFFFFFFFF), n[use], begin[use] - block.offs[:-1][owner]
            out["doc"], out["key"] = block.rows.column("doc").to_numpy()[owner], block.rows.column("key").to_numpy()[owner]
            held.append(out)
            size += out.nbytes
            if size > 16 << 20:
                yield from flush()
                held, size = [], 0
        if held:
            yield from flush()

    def group(table: pa.Table) -> pa.Table:
        keep, marks = split(blobs(table, "blob", SEGMENT, SENT), width)
        marks = np.concatenate([marks, blobs(table, "blob", MARK, MARKED)])
        lone = np.ones(len(keep), bool)
        equal = keep["anchor"][1:] == keep["anchor"][:-1]
        lone[1:] &= ~equal
        lone[:-1] &= ~equal
        keep = keep[~lone]
        _, back, count = np.unique(keep["anchor"], return_inverse=True, return_counts=True)
        keep["often"] = count[back] > OFTEN
        return pa.Table.from_batches([rows(keep, of_doc(keep, n_docs), SENT), rows(marks, of_doc(marks, n_docs), MARKED)])

    sent = texts.select("doc", "key", "k1", "k2", "text").mapInArrow(send, ROW)
    return sent.groupBy("bucket").applyInArrow(group, ROW)


def by_doc(texts: DataFrame, n_docs: int):
    return texts.select(F.pmod(F.col("key"), F.lit(n_docs)).cast("int").alias("bucket"), "doc_id", "doc", "key", "text").groupBy("bucket")


def lookup(table: pa.Table, records: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each record, the row of its document in the table, or -1: records and rows (first of twins)."""
    key = table.column("key").to_numpy()
    if not len(key):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    order = np.argsort(key, kind="stable")
    at = np.minimum(np.searchsorted(key[order], records["key"]), len(key) - 1)
    hit = np.flatnonzero(key[order][at] == records["key"])
    return hit, order[at[hit]]


def parted(records: np.ndarray, data: np.ndarray, width: int, n_buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Segments of one text and their buckets; those of very common minimisers cut up.

    Equal windows lie alike to their minimiser, so they fall into one step of PART places, and hold the bytes that
    all windows of that step hold: those bytes choose the bucket, so one common passage fills many of them.
    """
    often = records["often"] > 0
    out, where = [records[~often]], [records["anchor"][~often].astype(np.int64) % n_buckets]
    for r in records[often]:
        n, place = int(r["n"]), int(r["place"])
        step = (place - np.arange(n)) // PART
        for k in np.unique(step):
            own = np.flatnonzero(step == k)
            low = int(r["start"]) + place - PART * int(k)
            core = int.from_bytes(hashlib.blake2b(data[low : low + width - PART + 1].tobytes() + bytes([int(k)]), digest_size=8).digest(), "little")
            part = np.array([r], SEGMENT)
            part["start"], part["n"], part["anchor"] = int(r["start"]) + own[0], len(own), core & 0xFFFFFFFF
            out.append(part)
            where.append(np.array([(core >> 32) % n_buckets]))
    return np.concatenate(out), np.concatenate(where)


def compared(texts: DataFrame, wanted: DataFrame, n_buckets: int, n_docs: int, width: int) -> DataFrame:
    """Marks from the suffix arrays of the segments in ``wanted``."""

    def fetch(left: pa.Table, right: pa.Table) -> pa.Table:
        records = blobs(right, "blob", SEGMENT)
        hit, row = lookup(left, records)
        records, out = records[hit], []
        order = np.argsort(row, kind="stable")
        records, row = records[order], row[order]
        edge = np.append(np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]])) if len(row) else np.zeros(0, np.int64), len(row))
        text = left.column("text")
        heads, bodies, sizes, buckets = [], [], [], []
        for a, b in zip(edge[:-1], edge[1:]):
            data = np.frombuffer(text[int(row[a])].as_py().encode(), np.uint8)
            own, where = parted(records[a:b], data, width, n_buckets)
            buckets.append(where)
            size = own["n"].astype(np.int64) - 1 + width
            at = np.repeat(own["start"].astype(np.int64) - (np.cumsum(size) - size), size) + np.arange(size.sum())
            heads.append(own)
            bodies.append(data[at])
            sizes.append(size)
        if heads:
            own = np.concatenate(heads)
            head = np.zeros(len(own), HEAD)
            for name in HEAD.names:
                head[name] = own[name]
            out.append(packed(head, np.concatenate(bodies), np.concatenate(sizes), np.concatenate(buckets)))
        return pa.Table.from_batches(out, pa.schema([("bucket", pa.int32()), ("heads", pa.binary()), ("body", pa.binary())]))

    kernel = gsaca.register(texts.sparkSession)
    sent = by_doc(texts, n_docs).cogroup(wanted.groupBy("bucket")).applyInArrow(fetch, "bucket int, heads binary, body binary")
    found = sent.groupBy("bucket").agg(F.collect_list(F.struct("heads", "body")).alias("parts")).select(F.call_function(kernel, F.col("parts.heads"), F.col("parts.body"), F.lit(width)).alias("blob"))

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for blob in batch.column("blob").to_pylist():
                marks = np.frombuffer(blob, MARK)
                yield rows(marks, of_doc(marks, n_docs), MARKED)

    return found.mapInArrow(spread, ROW)


def later_copies(texts: DataFrame, n_docs: int) -> DataFrame:
    """(bucket, COPY, key) of texts of which a smaller doc_id has the same."""
    groups = texts.groupBy("k1", "k2").agg(F.min("doc").alias("first"), F.count("*").alias("n")).filter("n > 1").select("k1", "k2", "first")
    groups = materialize(groups, "copies")
    later = texts.select("k1", "k2", "doc", "key").join(groups, ["k1", "k2"]).filter("doc > first").select("key")

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            records = np.zeros(batch.num_rows, MARK)
            records["key"] = batch.column("key").to_numpy()
            yield rows(records, of_doc(records, n_docs), COPY)

    return later.mapInArrow(keys, ROW)


def suffix_dedup(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    if not GRAM <= width < GRAM + 255:
        raise ValueError(f"width must be {GRAM} to {GRAM + 254} bytes")
    texts = keyed(docs)
    n_docs, n_buckets = buckets_for(docs, 2.0), buckets_for(docs, 1.0, 2 << 20)

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        seen: dict[tuple[int, int], int] = {}
        for block in blocks(batches, most=BLOCK):
            text, _, _, _, anchor, *_ = cut(block, width)
            yield anchor[searched(block, seen)[text]]

    counted = sketch(texts.select("doc", "k1", "k2", "text"), anchors, cell_bits(docs, BYTES_PER_ANCHOR))
    found = docs.sparkSession.sparkContext.broadcast(counted)
    segs = materialize(grouped(texts, found, n_buckets, n_docs, width), "segments")
    marks = materialize(compared(texts, segs.filter(F.col("kind") == SENT), n_buckets, n_docs, width), "window-marks")
    every = segs.filter(F.col("kind") == MARKED).unionByName(marks).unionByName(later_copies(texts, n_docs))

    def cleaned(left: pa.Table, right: pa.Table) -> pa.Table:
        n = left.num_rows
        copy = np.zeros(n, bool)
        key = left.column("key").to_numpy() if n else np.zeros(0, np.int64)
        copy |= np.isin(key, blobs(right, "blob", MARK, COPY)["key"])
        records = blobs(right, "blob", MARK, MARKED)
        records = records[np.argsort(records["key"], kind="stable")]
        a, b = np.searchsorted(records["key"], key, "left"), np.searchsorted(records["key"], key, "right")
        sizes, removed, runs = (np.zeros(n, np.int64) for _ in range(3))
        shas = []
        for i, text in enumerate(left.column("text").to_pylist()):
            raw = text.encode()
            sizes[i] = len(raw)
            if copy[i] and len(raw) >= width:
                removed[i], runs[i], raw = len(raw), 1, b""
            elif b[i] > a[i]:
                gone = covered(len(raw), records["start"][a[i] : b[i]].astype(np.int64), records["end"][a[i] : b[i]].astype(np.int64))
                removed[i], runs[i] = gone.sum(), np.count_nonzero(gone[1:] & ~gone[:-1]) + gone[0]
                raw = np.frombuffer(raw, np.uint8)[~gone].tobytes()
            shas.append(hashlib.sha256(raw).hexdigest())
        return pa.table({"doc_id": left.column("doc_id"), "n_bytes": pa.array(sizes), "n_removed": pa.array(removed), "n_spans": pa.array(runs), "kept_sha256": pa.array(shas, pa.string())})

    return by_doc(texts, n_docs).cogroup(every.groupBy("bucket")).applyInArrow(cleaned, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string")


ORACLE = f"""
WITH d AS (SELECT row_number() OVER (ORDER BY doc_id NULLS LAST) AS r, doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
b AS (SELECT r, o, substr(x, 2 * o + 1, {2 * (1000 + WIDTH - 1)}) AS y FROM (SELECT r, x, unnest(range(0, greatest(length(x) // 2 - {WIDTH - 1}, 0), 1000)) AS o FROM d)),
w AS (SELECT r, o + i AS i, substr(y, 2 * i + 1, {2 * WIDTH}) AS g FROM (SELECT r, o, y, unnest(range(0, least(1000, length(y) // 2 - {WIDTH - 1}))) AS i FROM b)),
again AS (SELECT r, i FROM (SELECT r, i, row_number() OVER (PARTITION BY md5_number(g) ORDER BY r, i) AS k FROM w) WHERE k > 1),
s AS (SELECT r, min(i) AS a, max(i) + {WIDTH} AS b FROM (SELECT r, i, sum(new) OVER (PARTITION BY r ORDER BY i) AS k FROM (SELECT r, i, (i > coalesce(lag(i) OVER (PARTITION BY r ORDER BY i) + {WIDTH}, -1))::INT AS new FROM again)) GROUP BY r, k),
g AS (SELECT r, a, b, coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 0) AS z, lead(a) OVER (PARTITION BY r ORDER BY a) IS NULL AS last FROM s),
k AS (SELECT r, sum(b - a) AS removed, count(*) AS n, string_agg(substr(x, 2 * z + 1, 2 * (a - z)) || CASE WHEN last THEN substr(x, 2 * b + 1) ELSE '' END, '' ORDER BY a) AS kept FROM g JOIN d USING (r) GROUP BY r)
SELECT doc_id, (length(x) // 2)::BIGINT AS n_bytes, coalesce(removed, 0)::BIGINT AS n_removed, coalesce(n, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(kept, x))) AS kept_sha256 FROM d LEFT JOIN k USING (r)
"""
