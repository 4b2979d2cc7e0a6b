"""Line deduplication by content-defined chunks of lines, completed to every repeated passage of two lines or more.

A hash rolls over the hashes of three lines in a row; where its low bits are 0 a chunk ends after the line, so an
insertion moves no boundary but those beside it. A chunk is known by the sequence of its lines' hashes, and all
lines are grouped by hash and bytes: should one hash stand for two lines, all is hashed anew with another seed, so
that equal sequences are equal bytes. Chunks of two lines or more that occur more than once anywhere are removed, all
but the first (by doc_id, null last, then place). They are pre-aggregated in each task, so a chunk that most documents
share moves once a task. ``line_dedup`` stops there.

A passage that no boundary delimits on both sides is in no chunk of its own. ``passage_dedup``, which op9 runs,
goes on with the windows of two lines that are not within a removed chunk: of a window that occurs more than once the
first occurrence stays, and the lines under each later one go; where a later one overlaps the first (a run of one
repeated line, of which the first two stay) only the line outside it goes. The first occurrence of any line stays.

Defined results: lines end at \\n; null text counts as empty; an empty text has one empty line; rows that repeat
a doc_id are documents each, ties between equal doc_ids going to the row read first; other columns are ignored.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from gridloom.llm.session import materialize, release
from gridloom.llm.textkit import U64, WORD_BASE, Block, blocks, byte_hashes, covered, prefix, spans

ROLL = 3
#: One line in four ends a chunk.
MASK = 3
NEWLINE = 0x0A


def cut_lines(block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Byte start and end of each line, lines of each document, and the number of each document's first line (one more entry)."""
    data, offs = block.data, block.offs
    breaks = np.flatnonzero(data == NEWLINE)
    doc = np.searchsorted(offs, breaks, "right") - 1
    n_lines = np.bincount(doc, minlength=block.n) + 1
    first = np.concatenate([[0], np.cumsum(n_lines)])
    starts = np.empty(first[-1], np.int64)
    ends = np.empty(first[-1], np.int64)
    starts[first[:-1]], ends[first[1:] - 1] = offs[:-1], offs[1:]
    inner = np.ones(first[-1], bool)
    inner[first[:-1]] = False
    starts[inner] = breaks + 1
    inner = np.ones(first[-1], bool)
    inner[first[1:] - 1] = False
    ends[inner] = breaks
    return starts, ends, n_lines, first


def line_hashes(block: Block, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    return byte_hashes(block.data, starts, ends, seed)


def chunks(block: Block, seed: int = 0):
    """Per chunk: document, first line, lines, byte start and end; all lines' hashes, and lines of each document."""
    starts, ends, n_lines, first = cut_lines(block)
    line = line_hashes(block, starts, ends, seed)
    rolled = spans(prefix(line, WORD_BASE), np.maximum(np.arange(len(line)) - ROLL + 1, 0), np.arange(1, len(line) + 1), WORD_BASE)
    owner = np.repeat(np.arange(block.n), n_lines)
    last = ((rolled & U64(MASK)) == 0) & (np.arange(len(line)) - first[:-1][owner] >= ROLL - 1)
    last[first[1:] - 1] = True
    tail = np.flatnonzero(last)
    head = np.concatenate([[0], tail[:-1] + 1])
    return owner[head], head - first[:-1][owner[head]], tail - head + 1, starts[head], ends[tail], line.view(np.int64), n_lines


CUT = "rid bigint, doc_id bigint, n_lines int, chunks array<struct<line:int,keys:array<bigint>>>"
PARTS = "array<struct<a:int,b:int>>"
RESULT = "doc_id bigint, n_lines bigint, n_removed bigint, removed string"


def cut_docs(texts: DataFrame, seed: int) -> DataFrame:
    """Rows of CUT: a document's chunks, each as the hashes of its lines."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            doc, line, n, _, _, hashes, n_lines = chunks(block, seed)
            keys = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32)), pa.array(hashes))
            at = np.searchsorted(doc, np.arange(block.n + 1)).astype(np.int32)
            parts = pa.ListArray.from_arrays(pa.array(at), pa.StructArray.from_arrays([pa.array(line.astype(np.int32)), keys], ["line", "keys"]))
            yield pa.RecordBatch.from_arrays([block.rows.column("rid"), block.rows.column("doc_id"), pa.array(n_lines.astype(np.int32)), parts], ["rid", "doc_id", "n_lines", "chunks"])

    return texts.mapInArrow(apply, CUT)


def one_hash_for_two(texts: DataFrame, seed: int) -> bool:
    """Whether any hash stands for lines of different bytes; a line alone in its document matters to nothing."""

    def bodies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            starts, ends, n_lines, _ = cut_lines(block)
            many = np.repeat(n_lines > 1, n_lines)
            starts, ends = starts[many], ends[many]
            view = memoryview(np.ascontiguousarray(block.data))
            body = pa.array([bytes(view[s:e]) for s, e in zip(starts.tolist(), ends.tolist())], pa.binary()).dictionary_encode()
            _, one = np.unique(body.indices.to_numpy(), return_index=True)
            yield pa.RecordBatch.from_arrays([pa.array(line_hashes(block, starts[one], ends[one], seed).view(np.int64)), body.dictionary], ["k", "body"])

    compared = texts.select("text").mapInArrow(bodies, "k bigint, body binary").groupBy("k", "body").agg(F.count("*").alias("times"))
    found = materialize(compared.groupBy("k").agg(F.count("*").alias("texts")).filter("texts > 1").select("k"), "lines-of-one-hash")
    clash = found.limit(1).count() > 0
    release(found)
    return clash


def place(line: str) -> Column:
    return F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "rid", line)


def without_chunks(docs: DataFrame) -> DataFrame:
    """Rows of CUT with ``parts``: the stretches of lines of chunks that occur earlier. Written."""
    texts = docs.select(F.monotonically_increasing_id().alias("rid"), F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    seed = next(k for k in itertools.count() if not one_hash_for_two(texts, k))
    cut = materialize(cut_docs(texts, seed), "line-chunks")
    refs = cut.select("rid", "doc_id", F.explode("chunks").alias("c")).select("rid", "doc_id", "c.line", "c.keys").filter(F.size("keys") > 1)
    repeated = refs.groupBy("keys").agg(F.count("*").alias("times"), F.min(place("line")).alias("keep")).filter("times > 1").select("keys", "keep")
    repeated = materialize(repeated, "repeated-chunks")
    gone = refs.join(repeated, "keys").filter(place("line") != F.col("keep"))
    gone = gone.groupBy("rid").agg(F.collect_list(F.struct(F.col("line").alias("a"), (F.col("line") + F.size("keys")).alias("b"))).alias("parts"))
    out = materialize(cut.join(gone, "rid", "left").withColumn("parts", F.coalesce("parts", F.array().cast(PARTS))), "without-chunks")
    release(cut, repeated)
    return out


def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of ``without_chunks`` to windows of two lines that are not within one removed chunk."""
    for batch in batches:
        n = batch.column("n_lines").to_numpy(zero_copy_only=False).astype(np.int64)
        first = np.concatenate([[0], np.cumsum(n)])
        line = batch.column("chunks").flatten().field("keys").flatten().to_numpy(zero_copy_only=False)
        parts = batch.column("parts")
        flat, base = parts.flatten(), np.repeat(first[:-1], parts.value_lengths().to_numpy(zero_copy_only=False))
        a, b = (base + flat.field(k).to_numpy(zero_copy_only=False) for k in ("a", "b"))
        use = ~covered(len(line), a, b - 1)  # a window is known by the first of its lines
        use[first[1:] - 1] = False
        at = np.flatnonzero(use)
        owner = np.searchsorted(first, at, "right") - 1
        ids = pa.array(owner)
        yield pa.RecordBatch.from_arrays([batch.column("rid").take(ids), batch.column("doc_id").take(ids), pa.array((at - first[owner]).astype(np.int32)), pa.array(line[at]), pa.array(line[at + 1])], ["rid", "doc_id", "line", "k1", "k2"])


def rendered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, n_lines and ``parts`` (stretches of lines, which may overlap) to what ``passage_dedup`` returns."""
    for batch in batches:
        n = batch.column("n_lines").to_numpy(zero_copy_only=False).astype(np.int64)
        parts = batch.column("parts")
        flat = parts.flatten()
        a, b = (flat.field(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in ("a", "b"))
        base = np.concatenate([[0], np.cumsum(n + 1)])  # one place more for each document, so that stretches end there
        at = np.repeat(base[:-1], parts.value_lengths().to_numpy(zero_copy_only=False))
        gone = np.concatenate([[False], covered(int(base[-1]), at + a, at + b), [False]])
        edges = np.flatnonzero(gone[1:] != gone[:-1])
        heads, ends = edges[::2], edges[1::2]
        doc = np.searchsorted(base, heads, "right") - 1
        said = [[] for _ in range(len(n))]
        for d, x, y in zip(doc.tolist(), (heads - base[doc]).tolist(), (ends - base[doc]).tolist()):
            said[d].append(f"{x}:{y}")
        removed = np.bincount(doc, (ends - heads), len(n)).astype(np.int64)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n), pa.array(removed), pa.array([",".join(x) for x in said], pa.string())], ["doc_id", "n_lines", "n_removed", "removed"])


def passage_dedup(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_lines, n_removed, removed (first:end of stretches of removed lines)."""
    chunked = without_chunks(docs)
    refs = materialize(chunked.mapInArrow(windows, "rid bigint, doc_id bigint, line int, k1 bigint, k2 bigint"), "windows")
    repeated = refs.groupBy("k1", "k2").agg(F.count("*").alias("times"), F.min(place("line")).alias("keep")).filter("times > 1").select("k1", "k2", "keep")
    repeated = materialize(repeated, "repeated-windows")
    inside = (F.col("rid") == F.col("keep.rid")) & (F.col("line") == F.col("keep.line") + 1)
    gone = refs.join(repeated, ["k1", "k2"]).filter(place("line") != F.col("keep"))
    gone = gone.groupBy("rid").agg(F.collect_list(F.struct((F.col("line") + inside.cast("int")).alias("a"), (F.col("line") + 2).alias("b"))).alias("more"))
    whole = chunked.select("rid", "doc_id", "n_lines", "parts").join(gone, "rid", "left")
    whole = whole.select("doc_id", F.col("n_lines").cast("bigint").alias("n_lines"), F.concat("parts", F.coalesce("more", F.array().cast(PARTS))).alias("parts"))
    return whole.mapInArrow(rendered, RESULT)


def line_dedup(docs: DataFrame) -> DataFrame:
    """By chunks alone: one row per row of ``docs``: doc_id, n_lines, n_removed, removed (first:end of stretches of removed lines)."""
    return without_chunks(docs).select("doc_id", F.col("n_lines").cast("bigint").alias("n_lines"), "parts").mapInArrow(rendered, RESULT)


ORACLE = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT r, doc_id, unnest(ls) AS x, generate_subscripts(ls, 1) - 1 AS i FROM d),
w AS (SELECT r, doc_id, i, x, lead(x) OVER (PARTITION BY r ORDER BY i) AS y FROM l QUALIFY y IS NOT NULL),
f AS (SELECT r, i, first_value(r) OVER p AS fr, first_value(i) OVER p AS fi FROM w WINDOW p AS (PARTITION BY x, y ORDER BY doc_id NULLS LAST, r, i)),
g AS (SELECT DISTINCT r, j FROM (SELECT r, fr, fi, unnest([i, i + 1]) AS j FROM f WHERE r <> fr OR i <> fi) WHERE r <> fr OR j NOT BETWEEN fi AND fi + 1),
s AS (SELECT r, min(j) AS a, max(j) + 1 AS b FROM (SELECT r, j, j - row_number() OVER (PARTITION BY r ORDER BY j) AS k FROM g) GROUP BY r, k)
SELECT doc_id, len(ls)::BIGINT AS n_lines, coalesce(sum(b - a), 0)::BIGINT AS n_removed, coalesce(string_agg(a || ':' || b, ',' ORDER BY a), '') AS removed FROM d LEFT JOIN s USING (r) GROUP BY r, doc_id, ls
"""
