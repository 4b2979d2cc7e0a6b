"""Toxicity by a factorization machine over hashed terms.

Terms are letter runs (ASCII lower-cased) and their first five and four bytes, hashed to 2**20 places; a text's
features are the terms it has, so long and short texts are scored by the same evidence. The score is
sigmoid(b + sum w_i + sum_{i<j} <v_i, v_j>): the pairwise part learns combinations that additive weights miss.

The model is fitted on a sample of the labelled rows, at most about ``most_toxic`` toxic and ``most_clean`` other
ones, drawn by hash and weighted back to the full counts. Terms that tell the classes apart in the sample enter the
machine: those that do so alone (at most ``most_terms``), and those of pairs that do so together, whatever each does
alone, such as two words of which exactly one marks a toxic text. Pairs are tried among the ``most_paired`` commonest
terms; rarer ones are not together often enough to tell. Scoring covers whole texts, by table lookup, in one scan.

Defined results: empty or null text scores the base rate; a null doc_id is in no fold and is not held out; rows
that repeat a doc_id are scored each; labels that repeat are toxic if any says so; null labels are no labels;
with no usable label every score is 0.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from gridloom.llm.session import fold
from gridloom.llm.textkit import BYTE_BASE, LOWER, NO_LETTER, U64, Block, blocks, prefix, spans, words

BITS = 20
FACTORS = 8
MOST_TOXIC = 5_000
MOST_CLEAN = 7_000
MOST_TERMS = 20_000
MOST_PAIRED = 3_000
#: How many standard errors a term, or a pair of some millions tried, has to be off to count.
SINGLE, PAIR = 3, 7
#: Texts of the sample that hold both terms of a pair, at least, and by how much their rate is off, at least.
TOGETHER, EFFECT = 30, 0.3
THRESHOLD = 0.3
HELD_OUT = 2


@dataclass
class Machine:
    """terms: hashed places, ascending; the rest by term."""

    bias: float
    terms: np.ndarray
    w: np.ndarray
    v: np.ndarray


def places(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text, hashed place) pairs of a block, by text."""
    data = LOWER[block.data]
    starts, ends, first = words(data, block.offs, NO_LETTER)
    text = np.repeat(np.arange(block.n), np.diff(first))
    sums = prefix(data.astype(U64) + U64(1), BYTE_BASE)
    kinds = [spans(sums, starts, ends, BYTE_BASE)]
    kinds += [spans(sums, starts, np.minimum(starts + k, ends), BYTE_BASE) + U64(k) for k in (5, 4)]
    key = np.concatenate([(text.astype(U64) << U64(BITS)) | (h >> U64(64 - BITS)) for h in kinds])
    key = np.unique(key)
    return (key >> U64(BITS)).astype(np.int64), (key & U64((1 << BITS) - 1)).astype(np.int64)


def paired_terms(rows: list[np.ndarray], toxic: np.ndarray, df: np.ndarray, df_pos: np.ndarray, most_paired: int) -> np.ndarray:
    """Terms of pairs whose texts are toxic more, or less, often than the two terms' own rates add up to."""
    terms = np.flatnonzero(df >= TOGETHER)
    terms = np.sort(terms[np.argsort(-df[terms], kind="stable")[:most_paired]])
    place = np.full(1 << BITS, -1, np.int32)
    place[terms] = np.arange(len(terms))
    both, positive = (np.zeros((len(terms), len(terms)), np.float32) for _ in range(2))
    for k in range(0, len(rows), 1000):
        x = np.zeros((len(rows[k : k + 1000]), len(terms)), np.float32)
        for i, r in enumerate(rows[k : k + 1000]):
            at = place[r]
            x[i, at[at >= 0]] = 1
        both += x.T @ x
        x = x[toxic[k : k + 1000] == 1]
        positive += x.T @ x
    rate = toxic.sum() / len(toxic)
    own = (df_pos[terms] / df[terms]).astype(np.float32)
    use = np.zeros(len(terms), bool)
    for a in range(0, len(terms), 500):  # rows of the table, a few at a time
        n, p = both[a : a + 500], positive[a : a + 500]
        expected = np.clip(own[a : a + 500, None] + own[None, :] - rate, 0.01, 0.99)
        off = np.abs(p - n * expected) >= PAIR * np.sqrt(n * expected * (1 - expected))
        off &= (n >= TOGETHER) & (np.abs(p - n * expected) >= EFFECT * n)
        off[np.arange(off.shape[0]), a + np.arange(off.shape[0])] = False
        use[a : a + 500] |= off.any(1)
    return terms[use]


def fit(rows: list[np.ndarray], toxic: np.ndarray, weight: np.ndarray, factors: int = FACTORS, most_terms: int = MOST_TERMS, most_paired: int = MOST_PAIRED, seed: int = 0) -> Machine:
    """Fit on texts given by their distinct terms; toxic and weight by text. Works through the texts a thousand at a time."""
    n, size = len(toxic), 1 << BITS
    if not n or not weight.sum():
        return Machine(-np.inf, np.zeros(0, np.int64), np.zeros(0), np.zeros((0, factors)))
    total, positive = weight.sum(), float((weight * toxic).sum())
    base = np.clip(positive / total, 1e-6, 1 - 1e-6)
    df, df_pos = np.zeros(size, np.int32), np.zeros(size, np.int32)
    for k in range(0, n, 1000):
        for counts, own in ((df, rows[k : k + 1000]), (df_pos, [r for r, y in zip(rows[k : k + 1000], toxic[k : k + 1000]) if y])):
            if own:
                counts += np.bincount(np.concatenate(own), minlength=size).astype(np.int32)
    rate = toxic.sum() / n
    with np.errstate(all="ignore"):
        z = np.where(df >= 2, (df_pos - df * rate) / np.sqrt(df * rate * (1 - rate)), 0.0)
    z = np.nan_to_num(z)
    chosen = np.flatnonzero(np.abs(z) >= SINGLE)
    if len(chosen) > most_terms:
        chosen = chosen[np.argsort(-np.abs(z[chosen]), kind="stable")[:most_terms]]
    if 0 < rate < 1:
        chosen = np.union1d(chosen, paired_terms(rows, toxic, df, df_pos, most_paired))
    chosen = np.sort(chosen)
    place = np.full(size, -1, np.int32)
    place[chosen] = np.arange(len(chosen))
    found = [at[at >= 0] for at in (place[r] for r in rows)]
    texts = np.repeat(np.arange(n), [len(x) for x in found])
    cols, m = np.concatenate(found), len(chosen)
    rng = np.random.default_rng(seed)
    w, v, b = np.zeros(m), rng.normal(0, 0.02, (m, factors)), float(np.log(base / (1 - base)))
    share = weight / total
    state = [[np.zeros_like(x), np.zeros_like(x)] for x in (w, v)]
    for step in range(1, 151):
        vs = np.stack([np.bincount(texts, v[cols, f], n) for f in range(factors)], 1) if m else np.zeros((n, factors))
        squares = np.bincount(texts, (v * v).sum(1)[cols], n) if m else np.zeros(n)
        margin = b + np.bincount(texts, w[cols], n) + 0.5 * ((vs**2).sum(1) - squares)
        error = share * (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - toxic)
        b -= 2.0 * float(error.sum())
        if not m:
            continue
        e = error[texts]
        gw = np.bincount(cols, e, m) + 1e-5 * w
        es = np.bincount(cols, e, m)
        gv = np.stack([np.bincount(cols, e * vs[texts, f], m) for f in range(factors)], 1) - es[:, None] * v + 1e-4 * v
        for x, g, (m1, m2) in ((w, gw, state[0]), (v, gv, state[1])):
            m1 += 0.1 * (g - m1)
            m2 += 0.01 * (g * g - m2)
            x -= (0.05 if x is w else 0.01) * (m1 / (1 - 0.9**step)) / (np.sqrt(m2 / (1 - 0.99**step)) + 1e-8)
    return Machine(b, chosen, w, v)


def scores(machine: Machine, block: Block) -> np.ndarray:
    """Scores of the texts of a block; all 0 where nothing could be learned."""
    if machine.bias == -np.inf:
        return np.zeros(block.n)
    rows, terms = places(block)
    table = np.full(1 << BITS, -1, np.int32)
    table[machine.terms] = np.arange(len(machine.terms))
    at = table[terms]
    rows, at, n = rows[at >= 0], at[at >= 0], block.n
    margin = machine.bias + np.bincount(rows, machine.w[at], n)
    for f in range(machine.v.shape[1]):
        x = machine.v[at, f]
        margin += 0.5 * (np.bincount(rows, x, n) ** 2 - np.bincount(rows, x * x, n))
    return 1 / (1 + np.exp(-np.clip(margin, -500, 500)))


def train(docs: DataFrame, labels: DataFrame, most_toxic: int = MOST_TOXIC, most_clean: int = MOST_CLEAN) -> Machine:
    """Fit on a bounded sample of labelled rows outside the held-out fold."""
    known = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & (fold(F.col("doc_id")) != HELD_OUT)).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    n = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    part = {y: min(1.0, most / max(n.get(y, 0), 1)) for y, most in ((1, most_toxic), (0, most_clean))}
    draw = (F.pmod(F.xxhash64(F.lit(17), "doc_id"), F.lit(1 << 30)) / (1 << 30)) < F.when(F.col("toxic") == 1, part[1]).otherwise(part[0])
    sample = docs.select("doc_id", "text").join(F.broadcast(known.filter(draw)), "doc_id")  # bounded by the two limits
    sample = sample.dropDuplicates(["doc_id", "text"])  # a row that repeats without end counts once

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, most=2 << 20):
            rows, terms = places(block)
            edges = np.searchsorted(rows, np.arange(block.n + 1))
            terms = terms.astype(np.int32)
            yield pa.RecordBatch.from_arrays([block.rows.column("toxic"), pa.array([terms[a:b].tobytes() for a, b in zip(edges[:-1], edges[1:])], pa.binary())], ["toxic", "terms"])

    got = sample.mapInArrow(features, "toxic int, terms binary").toArrow()
    found = sorted(zip(got.column("toxic").to_pylist(), got.column("terms").to_pylist()))  # whatever order the rows came in
    del got
    toxic = np.array([y for y, _ in found], np.int64)
    return fit([np.frombuffer(x, np.int32) for _, x in found], toxic, np.where(toxic == 1, 1 / part[1], 1 / part[0]))


def score(docs: DataFrame, machine: Machine) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, most=2 << 20):
            yield pa.RecordBatch.from_arrays([block.rows.column("doc_id"), pa.array(scores(machine, block), pa.float64())], ["doc_id", "score"])

    scored = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(apply, "doc_id bigint, score double")
    return scored.select("doc_id", (fold(F.col("doc_id")) == HELD_OUT).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def kept(docs: DataFrame, machine: Machine, threshold: float = THRESHOLD) -> DataFrame:
    """The rows that score under ``threshold``, with all their columns; nothing is joined or shuffled."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, most=2 << 20):
            yield block.rows.filter(pa.array(scores(machine, block) < threshold))

    return docs.mapInArrow(apply, docs.schema)


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score(docs, train(docs, labels))
