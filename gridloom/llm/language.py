"""Language identification of mixed text: scripts narrow the candidates, Viterbi labels the words.

A word is a run of letters; marks inside one belong to it. Each word gets a score for each learned language, from
byte trigrams and from the word itself where it is known; the script of its letters, by ranges of code points, leaves
out languages that are not written in it. Viterbi then finds the best labels of all words of a text under a penalty
for each switch, which gives spans; a text's language is the one that has most letters.

Trigram and word tables are fitted on a sample of at most about ``most_per_language`` labelled texts of each
language, drawn by hash from outside the held-out fold; every text is labelled whole. Viterbi runs over many
texts side by side, a step for each word of the longest, so no work is done word by word.

Defined results: null text and text without letters give ``und`` with score 0, as do all texts where nothing
could be learned; a null doc_id is in no fold; rows that repeat a doc_id are labelled each; ties go to the
language that sorts first.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from gridloom.llm.session import fold
from gridloom.llm.textkit import LOWER, U64, Block, blocks, runs, word_hashes

WORD_BITS, GRAM_BITS = 18, 16
MOST_PER_LANGUAGE = 1_500
PENALTY = 4.0
FLOOR = -6.0
HELD_OUT = 2
#: Bytes of text that Viterbi steps through side by side.
BLOCK = 3 << 20
#: Ranges of code points of scripts, by name (letters of no range are one more script). Fixed values, from the Unicode blocks.
SCRIPT_RANGES = {
    "Latin": ((0x41, 0x5A), (0x61, 0x7A), (0xAA, 0xAA), (0xBA, 0xBA), (0xC0, 0x2AF), (0x1D00, 0x1DBF), (0x1E00, 0x1EFF), (0x2C60, 0x2C7F), (0xA720, 0xA7FF), (0xAB30, 0xAB6F), (0xFB00, 0xFB06), (0xFF21, 0xFF3A), (0xFF41, 0xFF5A)),
    "Greek": ((0x370, 0x3FF), (0x1F00, 0x1FFF)),
    "Cyrillic": ((0x400, 0x52F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF), (0xA640, 0xA69F)),
    "Armenian": ((0x531, 0x58F), (0xFB13, 0xFB17)),
    "Hebrew": ((0x590, 0x5FF), (0xFB1D, 0xFB4F)),
    "Arabic": ((0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF)),
    "Devanagari": ((0x900, 0x97F), (0xA8E0, 0xA8FF)),
    "Bengali": ((0x980, 0x9FF),),
    "Gurmukhi": ((0xA00, 0xA7F),),
    "Gujarati": ((0xA80, 0xAFF),),
    "Tamil": ((0xB80, 0xBFF),),
    "Telugu": ((0xC00, 0xC7F),),
    "Kannada": ((0xC80, 0xCFF),),
    "Malayalam": ((0xD00, 0xD7F),),
    "Sinhala": ((0xD80, 0xDFF),),
    "Thai": ((0xE00, 0xE7F),),
    "Lao": ((0xE80, 0xEFF),),
    "Tibetan": ((0xF00, 0xFFF),),
    "Myanmar": ((0x1000, 0x109F),),
    "Georgian": ((0x10A0, 0x10FF), (0x1C90, 0x1CBF), (0x2D00, 0x2D2F)),
    "Ethiopic": ((0x1200, 0x139F), (0x2D80, 0x2DDF)),
    "Khmer": ((0x1780, 0x17FF),),
    "Hangul": ((0x1100, 0x11FF), (0x3130, 0x318F), (0xA960, 0xA97F), (0xAC00, 0xD7FF)),
    "Kana and Han": ((0x2E80, 0x2FDF), (0x3005, 0x3007), (0x3031, 0x312F), (0x31A0, 0x31FF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0xFF66, 0xFF9F), (0x20000, 0x3FFFF)),
}
#: 0 is no script: marks, and what is no letter.
SCRIPTS = len(SCRIPT_RANGES) + 2


@lru_cache(1)
def code_points() -> tuple[np.ndarray, np.ndarray]:
    """For each code point, its script (0 unless it is a letter), and whether it stands in a word: letters and marks."""
    script = np.full(0x110000, SCRIPTS - 1, np.int8)
    for k, ranges in enumerate(SCRIPT_RANGES.values()):
        for low, high in ranges:
            script[low : high + 1] = k + 1
    letter = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    mark = np.fromiter((unicodedata.category(chr(c))[0] == "M" for c in range(0x110000)), bool, 0x110000)
    return np.where(letter, script, 0).astype(np.int8), letter | mark


def by_byte(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For UTF-8 bytes: the script of the letter that starts there (else 0), and whether the byte stands in a word."""
    script, inside = code_points()
    out, word = script[data], inside[data]  # right where a character is one byte
    high = np.flatnonzero(data >= 0x80)
    if len(high):
        out[high], word[high] = 0, False
        at = high[data[high] >= 0xC0]
        b = [data[np.minimum(at + k, len(data) - 1)].astype(np.int32) & 0x3F for k in (1, 2, 3)]
        first = data[at].astype(np.int32)
        size = 2 + (first >= 0xE0) + (first >= 0xF0)
        code = np.select([size == 2, size == 3], [(first & 0x1F) << 6 | b[0], (first & 0x0F) << 12 | b[0] << 6 | b[1]], (first & 0x07) << 18 | b[0] << 12 | b[1] << 6 | b[2])
        out[at] = script[code]
        stands = inside[code]
        for k in range(4):
            word[at[stands & (size > k)] + k] = True
    return out, word


@dataclass
class Model:
    languages: list[str]
    grams: np.ndarray  # (2**GRAM_BITS, languages) log probabilities
    words: np.ndarray  # (2**WORD_BITS, languages), 0 where unknown
    allowed: np.ndarray  # (SCRIPTS, languages)


def gram_ids(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashed trigrams at every letter of every word, with a blank at each side, and each word's first."""
    wide = np.zeros(len(data) + 2, np.uint32)
    inside = np.zeros(len(data) + 1, np.int8)
    np.add.at(inside, starts, 1)
    np.add.at(inside, ends, -1)
    inside = np.cumsum(inside[:-1]).astype(bool)
    wide[1:-1] = np.where(inside, data, 32)
    ids = ((wide[:-2] * np.uint32(0x01000193) + wide[1:-1]) * np.uint32(0x01000193) + wide[2:]) * np.uint32(0x9E3779B1)
    at = np.flatnonzero(inside)
    return (ids[at] >> np.uint32(32 - GRAM_BITS)).astype(np.int64), np.concatenate([[0], np.cumsum(ends - starts)])


def parsed(block: Block):
    """Words of a block: starts, ends, first words, trigrams and the first of each word, hashes, scripts, letters.

    A word's script is that of its first letter; a run without a letter (marks alone) is no word.
    """
    data = LOWER[block.data]
    script, inside = by_byte(data)
    starts, ends, first = runs(inside, block.offs)
    before = np.zeros(len(data) + 1, np.int32)
    np.cumsum(script > 0, out=before[1:])
    letters = (before[ends] - before[starts]).astype(np.int64)
    use = letters > 0
    first = np.concatenate([[0], np.cumsum(use)])[first]
    starts, ends, letters = starts[use], ends[use], letters[use]
    own = script[starts]
    for i in np.flatnonzero(own == 0):  # a mark stands before the first letter
        own[i] = next(x for x in script[starts[i] : ends[i]] if x)
    ids, at = gram_ids(data, starts, ends)
    hashed = (word_hashes(data, starts, ends) >> U64(64 - WORD_BITS)).astype(np.int64)
    return starts, ends, first, ids, at, hashed, own, letters


def counted(docs: DataFrame) -> DataFrame:
    """(lang, kind, blob of (place, count)) for each task."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, list[np.ndarray]] = {}
        for block in blocks(batches, most=BLOCK):
            _, _, first, ids, at, hashed, script, _ = parsed(block)
            langs = np.array(block.rows.column("lang").to_pylist(), object)
            text = np.repeat(np.arange(block.n), np.diff(first))
            for lang in sorted(set(langs)):
                own = (langs == lang)[text]
                table = sums.setdefault(lang, [np.zeros(1 << GRAM_BITS, np.int64), np.zeros(1 << WORD_BITS, np.int64), np.zeros(SCRIPTS, np.int64)])
                table[0] += np.bincount(ids[np.repeat(own, np.diff(at))], minlength=1 << GRAM_BITS)
                table[1] += np.bincount(hashed[own], minlength=1 << WORD_BITS)
                table[2] += np.bincount(script[own], minlength=SCRIPTS)
        for lang, tables in sums.items():
            for kind, t in enumerate(tables):
                at = np.flatnonzero(t)
                yield pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([kind], pa.int32()), pa.array([np.stack([at, t[at]]).astype(np.uint32).tobytes()], pa.binary())], ["lang", "kind", "blob"])

    return docs.mapInArrow(apply, "lang string, kind int, blob binary")


def train(docs: DataFrame, most_per_language: int = MOST_PER_LANGUAGE) -> Model:
    known = docs.select("doc_id", "text", "lang").filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & (fold(F.col("doc_id")) != HELD_OUT))
    n = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    langs = sorted(n)
    size = len(langs)
    tables = [np.zeros((1 << GRAM_BITS, size)), np.zeros((1 << WORD_BITS, size)), np.zeros((SCRIPTS, size))]
    if langs:
        part = F.create_map(*(F.lit(x) for lang in langs for x in (lang, min(1.0, most_per_language / n[lang]))))
        sample = known.filter((F.pmod(F.xxhash64(F.lit(29), "doc_id"), F.lit(1 << 30)) / (1 << 30)) < part[F.col("lang")])
        for lang, kind, blob in counted(sample).toLocalIterator():
            at, count = np.frombuffer(blob, np.uint32).reshape(2, -1)
            tables[kind][at, langs.index(lang)] += count
    grams, known_words, scripts = tables
    with np.errstate(divide="ignore"):
        g = np.log((grams + 0.5) / (grams.sum(0) + 0.5 * grams.shape[0]))
        p = (known_words + 0.5) / (known_words.sum(0) + 0.5 * known_words.shape[0])
        w = np.where(known_words.sum(1, keepdims=True) >= 3, np.log(p), 0.0)
    w -= w.max(1, keepdims=True) if size else 0
    share = scripts / np.maximum(scripts.sum(0), 1)
    allowed = share >= 0.01
    allowed[~allowed.any(1)] = True
    return Model(langs, g.astype(np.float32), w.astype(np.float32), allowed)


def word_scores(model: Model, ids: np.ndarray, at: np.ndarray, hashed: np.ndarray, script: np.ndarray) -> np.ndarray:
    """(words, languages): how far each language is behind the word's best, FLOOR at most."""
    s = np.add.reduceat(model.grams[ids], at[:-1]) if len(hashed) else np.zeros((0, len(model.languages)), np.float32)
    s = s + model.words[hashed]
    s = np.where(model.allowed[script], s, -np.inf)
    return np.maximum(s - s.max(1, keepdims=True), FLOOR).astype(np.float32)


def viterbi(scores: np.ndarray, first: np.ndarray, penalty: float = PENALTY) -> np.ndarray:
    """Best label of every word of every text; texts advance side by side, the longest ones last to end."""
    length = np.diff(first)
    order = np.argsort(-length, kind="stable")
    begin, length = first[:-1][order], length[order]
    labels = np.zeros(len(scores), np.int32)
    if not len(scores):
        return labels
    back = np.zeros(scores.shape, bool)  # came from the best label before, by a switch
    best = np.zeros(len(scores), np.int32)
    live = np.searchsorted(-length, -np.arange(length[0]), "left")  # texts longer than t
    d = scores[begin[: live[0]]].copy()
    for t in range(1, len(live)):
        k = live[t]
        d = d[:k]
        top = d.argmax(1)
        switch = d[np.arange(k), top] - penalty
        at = begin[:k] + t
        moved = switch[:, None] > d
        back[at], best[at] = moved, top
        d = np.where(moved, switch[:, None], d) + scores[at]
        ending = d  # rows past the next live count end here
        if t + 1 == len(live) or live[t + 1] < k:
            stop = live[t + 1] if t + 1 < len(live) else 0
            labels[at[stop:]] = ending[stop:].argmax(1)
    if len(live) > 1:
        stop = live[1]
        one = begin[stop : live[0]]
        labels[one] = scores[one].argmax(1)
    else:
        labels[begin[: live[0]]] = scores[begin[: live[0]]].argmax(1)
    for t in range(len(live) - 1, 0, -1):
        at = begin[: live[t]] + t
        own = labels[at]
        labels[at - 1] = np.where(back[at, own], best[at], own)
    return labels


def labelled(model: Model, block: Block, penalty: float = PENALTY):
    """Word starts, ends, first words, letters and labels of a block."""
    starts, ends, first, ids, at, hashed, script, letters = parsed(block)
    return starts, ends, first, letters, viterbi(word_scores(model, ids, at, hashed, script), first, penalty)


def identify(docs: DataFrame, model: Model, penalty: float = PENALTY) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, lang_pred, score, spans (lang:start:end in bytes, at label changes)."""
    names = np.array([*model.languages, "und"], object)
    size = len(model.languages)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, most=BLOCK):
            none = np.zeros(0, np.int64)
            starts, ends, first, count, labels = labelled(model, block, penalty) if size else (none, none, np.zeros(block.n + 1, np.int64), none, none)
            text = np.repeat(np.arange(block.n), np.diff(first))
            letters = np.bincount(text * max(size, 1) + labels, count.astype(float), block.n * max(size, 1)).reshape(block.n, -1)
            total, top = letters.sum(1), letters.argmax(1)
            pred = np.where(total > 0, top, size)
            new = np.ones(len(labels), bool)
            new[1:] = (labels[1:] != labels[:-1]) | (text[1:] != text[:-1])
            head = np.flatnonzero(new)
            tail = np.append(head[1:], len(labels))[: len(head)] - 1
            owner = np.searchsorted(text[head], np.arange(block.n + 1))
            said = [f"{names[labels[h]]}:{a}:{b}" for h, a, b in zip(head, starts[head] - block.offs[:-1][text[head]], ends[tail] - block.offs[:-1][text[head]])]
            yield pa.RecordBatch.from_arrays(
                [block.rows.column("doc_id"), pa.array(names[pred], pa.string()), pa.array(np.where(total > 0, letters.max(1) / np.maximum(total, 1), 0.0)), pa.array([",".join(said[a:b]) if t else "" for a, b, t in zip(owner[:-1], owner[1:], total)], pa.string())],
                ["doc_id", "lang_pred", "score", "spans"],
            )

    out = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(apply, "doc_id bigint, lang_pred string, score double, spans string")
    return out.select("doc_id", (fold(F.col("doc_id")) == HELD_OUT).alias("held_out"), "lang_pred", "score", "spans")


def language_id(docs: DataFrame) -> DataFrame:
    return identify(docs, train(docs))
