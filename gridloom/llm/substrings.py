"""Substring dedup of word windows with a count-min prefilter.

A window is ``WINDOW`` words in a row. First pass: every task sketches the minimisers of its windows, and the
merged sketch gives each window an estimate that is never below its count. Second pass: the words of windows
estimated to repeat, and only they, go to their minimiser's bucket, where windows are grouped by their words: each
word is numbered by its bytes, windows are sorted by a hash of those numbers, and neighbours of one hash are equal
only if all their numbers are. Every window that occurs twice or more, wherever, marks its words.

A text that one task reads more than once is sent once, and so are the words of segments that a task meets again
(byte for byte), so a hot group of copies or a hot passage costs each task one text or segment; that texts with
copies lose all their windows follows from counting whole texts. What is marked is keyed by the text's own 128-bit
hash and joined back to every copy.

Defined results: null text has no words; texts under ``WINDOW`` words lose nothing; rows that repeat a document
are repeats as any other; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F

from gridloom.llm.anchors import Sketch, cell_bits, segments, sketch
from gridloom.llm.exchange import packed
from gridloom.llm.session import buckets_for, materialize, release, small_batches
from gridloom.llm.textkit import U64, WORD_BASE, Block, blocks, covered, grams, mix, prefix, spans, word_hashes, words

WINDOW = 35
GRAM = 8
#: One anchor in 14 words or so.
BYTES_PER_ANCHOR = 80
HEAD = np.dtype([("k1", "<i8"), ("k2", "<i8"), ("start", "<u4"), ("n", "<u4"), ("size", "<u4"), ("kind", "<u4")])
#: A segment with its words; one that this task met again, so that all its windows repeat; one met before, without them.
ONCE, AGAIN, BEFORE = 0, 1, 2
FLUSH = 8 << 20
#: Bytes of text that are worked on at once; numbers about them take some sixty times as much.
BLOCK = 1 << 18
#: Partitions of texts whose results share a file.
PARTITIONS_PER_FILE = 16


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text (never null), and the text's hash in two columns."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(1), text).alias("k2"))


def cut(block: Block, window: int):
    """Starts, ends and first words of a block, and its segments (places count words of the block)."""
    starts, ends, first = words(block.data, block.offs)
    small, at = grams(word_hashes(block.data, starts, ends), first, GRAM)
    text, begin, n, place = segments(small, at, window - GRAM + 1)
    begin = begin - at[:-1][text] + first[:-1][text]
    return starts, ends, first, text, begin, n, small[place]


def unsent(block: Block, seen: set[tuple[int, int]]) -> np.ndarray:
    """Which texts of a block this task has not sent yet."""
    new = np.zeros(block.n, bool)
    for i, k in enumerate(zip(block.rows.column("k1").to_pylist(), block.rows.column("k2").to_pylist())):
        new[i] = k not in seen
        seen.add(k)
    return new


def spaced(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All words with one space behind each, and where each begins (one more entry)."""
    at = np.concatenate([[0], np.cumsum(ends - starts + 1)])
    out = np.full(at[-1], 0x20, np.uint8)
    word = np.ones(at[-1], bool)
    word[at[1:] - 1] = False
    inside = np.zeros(len(data) + 1, np.int8)
    inside[starts] += 1
    inside[ends] -= 1
    out[word] = data[np.cumsum(inside[:-1], dtype=np.int8).astype(bool)]
    return out, at


def numbers(body: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A number for each stretch at[i]:at[i + 1] of ``body``: the same for the same bytes, and only for them."""
    if len(at) < 2:
        return np.zeros(0, np.int64)
    col = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(at) - 1, [None, pa.py_buffer(np.ascontiguousarray(at, np.int64)), pa.py_buffer(np.ascontiguousarray(body))])
    return col.dictionary_encode().indices.to_numpy().astype(np.int64)


def met_before(heads: np.ndarray, body: np.ndarray, bucket: np.ndarray, n_buckets: int):
    """Of segments with the same words keep those of one; the others, dealt by text, only say where they are.

    A passage that many texts share so costs each task one segment in the passage's bucket.
    """
    size = heads["size"].astype(np.int64)
    same = numbers(body, np.concatenate([[0], np.cumsum(size)]))
    _, first, back, count = np.unique(same, return_index=True, return_inverse=True, return_counts=True)
    keep = np.zeros(len(heads), bool)
    keep[first] = True
    heads["kind"] = np.where(keep, np.where(count[back] > 1, AGAIN, ONCE), BEFORE)
    body = body[np.repeat(keep, size)]
    heads["size"][~keep] = 0
    return heads, body, heads["size"].astype(np.int64), np.where(keep, bucket, np.mod(heads["k1"], n_buckets))


def equal_windows(word: np.ndarray, begin: np.ndarray, window: int) -> np.ndarray:
    """Which of the windows word[b : b + window], b in ``begin``, occur at two places or more."""
    hit = np.zeros(len(begin), bool)
    if len(begin) < 2:
        return hit
    hashed = spans(prefix(mix(word.astype(U64) + U64(1)), WORD_BASE), begin, begin + window, WORD_BASE)
    order = np.argsort(hashed, kind="stable")
    pair = np.flatnonzero(hashed[order][1:] == hashed[order][:-1])
    x, y = begin[order[pair]], begin[order[pair + 1]]
    equal = np.ones(len(pair), bool)
    for k in range(window):
        equal &= word[x + k] == word[y + k]
    hit[order[pair[equal]]] = hit[order[pair[equal] + 1]] = True
    if not equal.all():  # one hash for different words: such windows are sorted by their words
        doubtful = np.flatnonzero(np.isin(hashed, hashed[order[pair[~equal]]]))
        _, back, count = np.unique(word[begin[doubtful][:, None] + np.arange(window)], axis=0, return_inverse=True, return_counts=True)
        hit[doubtful] = count[back.ravel()] > 1
    return hit


def repeated_windows(texts: DataFrame, found: Broadcast, n_buckets: int, window: int) -> DataFrame:
    """(k1, k2, start, end) in words: stretches of each text that repeated windows cover."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: Sketch = found.value
        seen: set[tuple[int, int]] = set()
        heads, bodies, buckets, size = [], [], [], 0

        def flush():
            own, body, sizes, bucket = met_before(np.concatenate(heads), np.frombuffer(b"".join(bodies), np.uint8), np.concatenate(buckets), n_buckets)
            return packed(own, body, sizes, bucket)

        for block in blocks(batches, most=BLOCK):
            starts, ends, first, text, begin, n, anchor = cut(block, window)
            use = np.flatnonzero(unsent(block, seen)[text] & known.repeated(anchor))
            if not len(use):
                continue
            text, begin, n, anchor = text[use], begin[use], n[use], anchor[use]
            flat, at = spaced(block.data, starts, ends)
            low, high = at[begin], at[begin + n - 1 + window]
            own = np.zeros(len(use), HEAD)
            own["k1"] = block.rows.column("k1").to_numpy()[text]
            own["k2"] = block.rows.column("k2").to_numpy()[text]
            own["start"], own["n"], own["size"] = begin - first[:-1][text], n, high - low
            heads.append(own)
            buckets.append((anchor % U64(n_buckets)).astype(np.int64))
            view = memoryview(flat)
            bodies.append(b"".join([view[a:b] for a, b in zip(low.tolist(), high.tolist())]))
            size += int((high - low).sum()) + own.nbytes
            if size > FLUSH:
                yield flush()
                heads, bodies, buckets, size = [], [], [], 0
        if heads:
            yield flush()

    def group(table: pa.Table) -> pa.Table:
        join = lambda name: b"".join(x.as_buffer() for c in table.column(name).chunks for x in c)
        heads, body = np.frombuffer(join("heads"), HEAD), np.frombuffer(join("body"), np.uint8)
        whole = heads[heads["kind"] == BEFORE]
        heads = heads[heads["kind"] != BEFORE]
        size = heads["size"].astype(np.int64)
        starts, ends, first = words(body, np.concatenate([[0], np.cumsum(size)]))
        word = numbers(body, np.append(starts, len(body)))
        n = heads["n"].astype(np.int64)
        owner = np.repeat(np.arange(len(heads)), n)
        inner = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
        hit = equal_windows(word, first[:-1][owner] + inner, window) | (heads["kind"] == AGAIN)[owner]
        at = np.flatnonzero(hit)
        start = heads["start"][owner[at]].astype(np.int64) + inner[at]
        new = np.ones(len(at), bool)
        new[1:] = (owner[at][1:] != owner[at][:-1]) | (start[1:] != start[:-1] + 1)
        head = np.flatnonzero(new)
        tail = np.append(head[1:], len(at))[: len(head)] - 1
        who = np.concatenate([heads[owner[at[head]]], whole])
        begin = np.concatenate([start[head], whole["start"].astype(np.int64)])
        end = np.concatenate([start[tail] + window, whole["start"].astype(np.int64) + whole["n"] - 1 + window])
        return pa.table({"k1": pa.array(who["k1"].copy()), "k2": pa.array(who["k2"].copy()), "start": pa.array(begin.astype(np.int32)), "end": pa.array(end.astype(np.int32))})

    sent = texts.select("k1", "k2", "text").mapInArrow(send, "bucket int, heads binary, body binary")
    return sent.groupBy("bucket").applyInArrow(group, "k1 bigint, k2 bigint, start int, end int")


def runs_of(stretches: DataFrame) -> DataFrame:
    """(k1, k2, start, end): the stretches of each text, with those that overlap or touch made one."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(runs: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(runs[0]), pa.array(runs[1]), pa.array(runs[2].astype(np.int32)), pa.array(runs[3].astype(np.int32))], ["k1", "k2", "start", "end"])

        last = np.zeros((4, 0), np.int64)  # the run that the next batch may carry on
        for batch in batches:
            k1, k2, start, end = np.concatenate([last, np.stack([batch.column(k).to_numpy().astype(np.int64) for k in ("k1", "k2", "start", "end")])], axis=1)
            if not len(k1):
                continue
            new = np.ones(len(k1), bool)
            new[1:] = (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])
            base = np.cumsum(new) << 32  # so that no text's ends reach into the next
            reach = np.maximum.accumulate(base + end)
            new[1:] |= base[1:] + start[1:] > reach[:-1]
            head = np.flatnonzero(new)
            runs = np.stack([k1[head], k2[head], start[head], (reach - base)[np.append(head[1:], len(k1)) - 1]])
            last = runs[:, -1:]
            yield rows(runs[:, :-1])
        yield rows(last)

    ordered = stretches.repartition("k1", "k2").sortWithinPartitions("k1", "k2", "start")
    return ordered.mapInArrow(merge, "k1 bigint, k2 bigint, start int, end int")


def substring_dedup(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_removed, kept_sha256. Written, so that the last pass over the texts
    has small batches too."""
    with small_batches(docs.sparkSession):
        return deduped(docs, window)


def deduped(docs: DataFrame, window: int) -> DataFrame:
    texts = keyed(docs)

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        seen: set[tuple[int, int]] = set()
        for block in blocks(batches, most=BLOCK):
            _, _, _, text, _, _, anchor = cut(block, window)
            yield anchor[unsent(block, seen)[text]]

    counted = sketch(texts.select("k1", "k2", "text"), anchors, cell_bits(docs, BYTES_PER_ANCHOR))
    found = docs.sparkSession.sparkContext.broadcast(counted)
    stretches = repeated_windows(texts, found, buckets_for(docs, 2.0, 2 << 20), window)
    # Tasks that read copies of one text mark it alike, and segments of one text overlap: runs are listed, not stretches.
    marks = runs_of(stretches).groupBy("k1", "k2").agg(F.collect_list(F.struct("start", "end")).alias("marks"))
    copies = texts.groupBy("k1", "k2").agg(F.count("*").alias("copies")).filter("copies > 1")
    marks = materialize(marks.join(copies, ["k1", "k2"], "full_outer"), "marks")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, most=BLOCK):
            starts, ends, first = words(block.data, block.offs)
            n = np.diff(first)
            marked = block.rows.column("marks")
            at = np.repeat(first[:-1], marked.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
            flat = marked.flatten()
            gone = covered(len(starts), *(at + flat.field(k).to_numpy(zero_copy_only=False) for k in ("start", "end")))
            copied = block.rows.column("copies").is_valid().to_numpy(zero_copy_only=False) & (n >= window)
            gone |= np.repeat(copied, n)
            removed = np.diff(np.concatenate([[0], np.cumsum(gone)])[first])
            shas = [hashlib.sha256(kept_text(block.data, starts[a:b], ends[a:b], ~gone[a:b])).hexdigest() for a, b in zip(first[:-1].tolist(), first[1:].tolist())]
            yield pa.RecordBatch.from_arrays([block.rows.column("doc_id"), pa.array(n), pa.array(removed), pa.array(shas)], ["doc_id", "n_words", "n_removed", "kept_sha256"])

    kept = texts.join(marks, ["k1", "k2"], "left").select("doc_id", "text", "marks", "copies").mapInArrow(keep, "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string")
    # Its rows are short: a few files, since a local file system starts a process or two for each file.
    files = max(4, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")) // PARTITIONS_PER_FILE)
    kept = materialize(kept.repartition(files), "kept")
    release(marks)
    return kept


def kept_text(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, keep: np.ndarray) -> bytes:
    """Kept words joined by one space."""
    starts, ends = starts[keep], ends[keep]
    if not len(starts):
        return b""
    low, high = starts[0], ends[-1]
    mask = covered(high - low + 1, starts - low, ends - low + 1)
    out = np.append(data[low:high], np.uint8(32))
    out[ends - low] = 32
    return out[mask][:-1].tobytes()


ORACLE = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
k AS (SELECT r, i, array_to_string(ws[i:i + {WINDOW - 1}], ' ') AS g FROM (SELECT r, ws, unnest(generate_series(1, len(ws) - {WINDOW - 1})) AS i FROM d WHERE len(ws) >= {WINDOW})),
again AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY g) AS n FROM k) WHERE n > 1),
gone AS (SELECT DISTINCT r, unnest(generate_series(i, i + {WINDOW - 1})) AS j FROM again),
x AS (SELECT r, unnest(ws) AS word, generate_subscripts(ws, 1) AS j FROM d),
kept AS (SELECT r, string_agg(word, ' ' ORDER BY j) AS words FROM x ANTI JOIN gone USING (r, j) GROUP BY r),
n AS (SELECT r, count(*) AS n FROM gone GROUP BY r)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n.n, 0)::BIGINT AS n_removed, sha256(coalesce(kept.words, '')) AS kept_sha256 FROM d LEFT JOIN kept USING (r) LEFT JOIN n USING (r)
"""
