"""Similarity join on word shingles: Jaccard 0.8 or more, by prefix filters under several global orders.

Two sets of Jaccard t or more share k tokens of the first n - ceil(t n) + k of each, whatever order all sets are
sorted by. Three orders are used: rare tokens first, and two by hash. Under the first, prefixes are posted and sets
meet in the lists of their tokens; under the two others, prefixes of two sets must share k tokens as well before
the sets themselves are compared.

Texts with one set are one class from the start, so copies cost nothing more. Counts for the first order cover
all documents: each task reports the tokens it met in several texts; any function of the token serves as a
global order, so what a task leaves out costs speed and never a link. No list gives its pairs: it is cut by size
(two sets that link are of like size), and each part names a group that its members belong to, so what comes out
grows with the postings. Filters by set come first: one that meets others in fewer lists than a link needs goes (sets
that share a phrase by chance), lists are made anew of those left, and then one goes too many of whose shingles no
other candidate has. Members are compared with one member of their group, its centre,
with one text of each set, in buckets of pairs; an end that has many pairs is dealt to many buckets. Groups whose members are not all connected by then are compared in blocks, where products of incidence
matrices of the prefixes under the other orders leave the pairs whose sets are multiplied out; links between
components come out, never the pairs tried.

Defined results: empty and null texts have no shingles, link with nothing and are their own component; texts of
1 to 4 words have their whole sequence as one shingle; a component's id is its smallest doc_id, null where all
are null; rows that repeat a doc_id are nodes each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, functions as F

from gridloom.llm.components import components
from gridloom.llm.exchange import SCHEMA, dealt, flushed, reduce_buckets
from gridloom.llm.session import buckets_for, materialize, numbered, plan_bytes, release
from gridloom.llm.textkit import LOWER, U64, Block, blocks, grams, mix, word_hashes, words

SHINGLE = 5
PERCENT = 80
#: Tokens that are ranked by count; the rest come first, by hash. Bounds what is sent to tasks: 16 bytes each.
MOST_COMMON = 1 << 20
LEAST_COMMON = 8
LOCAL_COMMON = 3
COUNTED = 1 << 22
PAIRS_AT_ONCE = 2_000
GROUP_BLOCK = 512
EXTENDED = 20
#: More than there are classes of sizes.
WIDE = 1 << 24
ORDERS = (U64(0xD1342543DE82EF95), U64(0xAF251AF3B0F025B5))
#: A token of a set's prefix, the set, its size, and its first token under another order, by which groups are named.
POST = np.dtype([("tok", "<u8"), ("cls", "<i8"), ("first", "<u8"), ("n", "<u4")])
COUNT = np.dtype([("tok", "<u8"), ("n", "<u4")])
MEMBER = np.dtype([("grp", "<i8"), ("x", "<i8")])
#: A set, its size, and in how many lists of a bucket it meets others.
MEET = np.dtype([("cls", "<i8"), ("n", "<u4"), ("lists", "<u4")])


def keyed(docs: DataFrame, rid: Column | None) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    rid = F.monotonically_increasing_id() if rid is None else rid
    return docs.select(rid.alias("rid"), F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("text")).withColumn("key", F.xxhash64("doc_id", "text"))


def shingle_sets(block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each text in ascending order, where each text's begin, and each set's signature."""
    data = LOWER[block.data]
    starts, ends, first = words(data, block.offs)
    tokens, at = grams(word_hashes(data, starts, ends), first, SHINGLE, short=True)
    text = np.repeat(np.arange(block.n), np.diff(at))
    for i, j in zip(at[:-1].tolist(), at[1:].tolist()):
        tokens[i:j].sort()
    new = np.ones(len(tokens), bool)
    new[1:] = (tokens[1:] != tokens[:-1]) | (text[1:] != text[:-1])
    tokens, text = tokens[new], text[new]
    at = np.searchsorted(text, np.arange(block.n + 1))
    sums = np.concatenate([np.zeros(1, U64), np.cumsum(mix(tokens ^ ORDERS[0]), dtype=U64)])
    sig = mix(sums[at[1:]] - sums[at[:-1]] + np.diff(at).astype(U64)).view(np.int64)
    return tokens, at, sig


def prefix_size(n: np.ndarray, percent: int) -> np.ndarray:
    """Tokens of a set's prefix, of which sets that link share one at least."""
    return np.where(n > 0, n - -(-percent * n // 100) + 1, 0)


def needed(n: np.ndarray) -> np.ndarray:
    """With so many tokens less one added to each prefix, sets that link share so many of them (the least of the two)."""
    return 1 + n // EXTENDED


def profile(texts: DataFrame) -> DataFrame:
    """Rows of documents (kind 0: rid, doc_id, key, n, sig) and packed local counts of tokens (kind 1: bucket in n)."""
    schema = "kind int, rid bigint, doc_id bigint, key bigint, n int, sig bigint, blob binary"

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def common():
            tok, n = np.unique(np.concatenate(held), return_counts=True)
            keep = n >= LOCAL_COMMON
            out = np.zeros(keep.sum(), COUNT)
            out["tok"], out["n"] = tok[keep], n[keep]
            for bucket in range(16):
                part = out[out["tok"] >> U64(60) == bucket]
                yield pa.RecordBatch.from_arrays([pa.array([1], pa.int32()), *[pa.nulls(1, pa.int64())] * 3, pa.array([bucket], pa.int32()), pa.nulls(1, pa.int64()), pa.array([part.tobytes()], pa.binary())], ["kind", "rid", "doc_id", "key", "n", "sig", "blob"])

        for block in blocks(batches):
            tokens, at, sig = shingle_sets(block)
            yield pa.RecordBatch.from_arrays([pa.array(np.zeros(block.n, np.int32)), block.rows.column("rid"), block.rows.column("doc_id"), block.rows.column("key"), pa.array(np.diff(at).astype(np.int32)), pa.array(sig), pa.nulls(block.n, pa.binary())], ["kind", "rid", "doc_id", "key", "n", "sig", "blob"])
            held.append(tokens)
            size += len(tokens)
            if size >= COUNTED:
                yield from common()
                held, size = [], 0
        if held:
            yield from common()

    return texts.mapInArrow(apply, schema)


def common_tokens(profiles: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The commonest tokens, ascending, and their counts; MOST_COMMON at most."""

    def add(_: int, got: np.ndarray) -> Iterator[pa.RecordBatch]:
        tok, at = np.unique(got["tok"], return_inverse=True)
        n = np.bincount(at, got["n"]).astype(np.int64) if len(got) else np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(tok[n >= LEAST_COMMON].view(np.int64)), pa.array(n[n >= LEAST_COMMON])], ["tok", "n"])

    counts = profiles.filter("kind = 1").select(F.col("n").alias("bucket"), "blob")
    counts = materialize(reduce_buckets(counts, COUNT, add, "tok bigint, n bigint", pa.schema([("tok", pa.int64()), ("n", pa.int64())])), "token-counts")
    least, left = 1 << 62, MOST_COMMON
    for level, n in sorted(((r["level"], r["n"]) for r in counts.groupBy(F.floor(F.log2("n")).alias("level")).agg(F.count("*").alias("n")).collect()), reverse=True):
        left -= n
        if left < 0:
            break
        least = 1 << level
    got = counts.filter(F.col("n") >= least).toArrow()
    tok, n = got.column("tok").to_numpy().view(U64), got.column("n").to_numpy()
    order = np.argsort(tok)
    return tok[order], n[order]


def first_tokens(tokens: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The first token of each set under the second order (of an empty set: any)."""
    if not len(tokens):
        return np.zeros(len(at) - 1, U64)
    return np.minimum.reduceat(tokens * ORDERS[0], np.minimum(at[:-1], len(tokens) - 1))


def postings(texts: DataFrame, common: Broadcast, n_buckets: int, percent: int) -> DataFrame:
    """Packed postings of the prefixes under the first order, once for each set and task."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, counts = common.value
        seen: set[int] = set()

        def parts():
            for block in blocks(batches):
                tokens, at, sig = shingle_sets(block)
                new = np.zeros(block.n, bool)
                for i, s in enumerate(sig.tolist()):
                    new[i] = s not in seen
                    seen.add(s)
                text = np.repeat(np.arange(block.n), np.diff(at))
                rank = np.zeros(len(tokens), np.int64)
                if len(known):
                    where = np.minimum(np.searchsorted(known, tokens), len(known) - 1)
                    rank = np.where(known[where] == tokens, counts[where], 0)
                order = np.lexsort((rank, text))  # tokens ascend within a text
                n = np.diff(at)
                take = (np.arange(len(tokens)) - at[:-1][text]) < np.where(new, prefix_size(n, percent) + needed(n) - 1, 0)[text]
                own = order[take]
                out = np.zeros(len(own), POST)
                out["tok"], out["cls"], out["n"] = tokens[own], sig[text[own]], n[text[own]]
                out["first"] = first_tokens(tokens, at)[text[own]]
                yield out, (tokens[own] % U64(n_buckets)).astype(np.int64)

        yield from flushed(parts())

    return texts.select("text").mapInArrow(apply, SCHEMA)


def size_classes(n: np.ndarray, percent: int) -> np.ndarray:
    """Classes of sizes; sets that link are of one class or of two neighbours."""
    steps = [1]
    while len(n) and steps[-1] <= n.max():
        steps.append(steps[-1] * 100 // percent + 1)
    return np.searchsorted(steps, n, "right")


def groups(got: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lists of postings as groups: name, member, the member's size, and in how many lists the group holds it. Two sets of
    one list whose sizes allow a link are in one group.

    A group is named by the least of its members' first tokens under another order. Sets that are alike have few first
    tokens between them, so the many lists that near copies share name one group or two, not one each.
    """
    got = got[np.lexsort((got["cls"], got["n"], got["tok"]))]
    new = np.ones(len(got), bool)
    new[1:] = (got["tok"][1:] != got["tok"][:-1]) | (got["cls"][1:] != got["cls"][:-1])
    got = got[new]
    size = got["n"].astype(np.int64)
    head = np.flatnonzero(np.concatenate([[True], got["tok"][1:] != got["tok"][:-1]])) if len(got) else np.zeros(0, np.int64)
    count = np.diff(np.append(head, len(got)))
    last = head + count - 1
    part = np.where(np.repeat(100 * size[head] >= percent * size[last], count), 0, size_classes(size, percent))  # a list of like sizes stays whole
    part = np.repeat(np.cumsum(count) - count, count) * WIDE + part
    # Part c holds class c and the next; one that has none of class c is held by the next part.
    below = np.flatnonzero(np.isin(part - 1, part))
    at, part = np.concatenate([np.arange(len(got)), below]), np.concatenate([part, part[below] - 1])
    order = np.lexsort((got["first"][at], part))
    at, part = at[order], part[order]
    head = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]])) if len(part) else np.zeros(0, np.int64)
    count = np.diff(np.append(head, len(part)))
    name = got["first"][at][np.repeat(head, count)].view(np.int64)
    use = np.repeat(count > 1, count)
    edges = np.stack([name[use], got["cls"][at][use], size[at][use]], 1)
    edges, lists = np.unique(edges, axis=0, return_counts=True)
    return edges[:, 0].copy(), edges[:, 1].copy(), edges[:, 2].copy(), lists


def candidates(packed: DataFrame, n_buckets: int, percent: int) -> DataFrame:
    """(grp, x): sets that meet in lists of the first order, by group; each once, however many lists say so."""

    def said(_: int, got: np.ndarray) -> Iterator[pa.RecordBatch]:
        name, member, *_ = groups(got, percent)
        out = np.zeros(len(name), MEMBER)
        out["grp"], out["x"] = name, member
        where = mix(out["grp"].view(U64) ^ mix(out["x"].view(U64)))  # members of one large group go to many buckets
        yield dealt(out, (where % U64(n_buckets)).astype(np.int64))

    def once(_: int, got: np.ndarray) -> Iterator[pa.RecordBatch]:
        got = np.unique(got)
        yield pa.RecordBatch.from_arrays([pa.array(got[c].copy()) for c in MEMBER.names], MEMBER.names)

    every = reduce_buckets(packed, POST, said, SCHEMA, pa.schema([("bucket", pa.int32()), ("blob", pa.binary())]))
    return reduce_buckets(every, MEMBER, once, "grp bigint, x bigint", pa.schema([("grp", pa.int64()), ("x", pa.int64())]))


def enough_lists(packed: DataFrame, n_buckets: int, percent: int) -> DataFrame:
    """(sig) of the sets that meet others in as many lists as a link needs at least."""

    def met(_: int, got: np.ndarray) -> Iterator[pa.RecordBatch]:
        _, member, n, lists = groups(got, percent)
        cls, first, at = np.unique(member, return_index=True, return_inverse=True)
        out = np.zeros(len(cls), MEET)
        out["cls"], out["n"], out["lists"] = cls, n[first], np.bincount(at, lists, len(cls))
        yield dealt(out, np.mod(cls, n_buckets))

    def enough(_: int, got: np.ndarray) -> Iterator[pa.RecordBatch]:
        cls, first, at = np.unique(got["cls"], return_index=True, return_inverse=True)
        n = got["n"][first].astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(cls[np.bincount(at, got["lists"], len(cls)) >= needed(-(-percent * n // 100))])], ["sig"])

    counted = reduce_buckets(packed, POST, met, SCHEMA, pa.schema([("bucket", pa.int32()), ("blob", pa.binary())]))
    return reduce_buckets(counted, MEET, enough, "sig bigint", pa.schema([("sig", pa.int64())]))


def bounds(held: DataFrame, n_buckets: int) -> DataFrame:
    """(sig, n, dead): of each set, how many shingles no other set in ``held`` has.

    Shingles are compared by 32 bits within a bucket; two that fall together only count as shared, which loosens
    the bound and loses nothing.
    """
    record = np.dtype([("tok", "<u4"), ("cls", "<i8")])

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def parts():
            for block in blocks(batches):
                tokens, at, sig = shingle_sets(block)
                out = np.zeros(len(tokens), record)
                out["tok"], out["cls"] = tokens >> U64(32), np.repeat(sig, np.diff(at))
                yield out, (tokens % U64(n_buckets)).astype(np.int64)

        yield from flushed(parts())

    def lone(_: int, got: np.ndarray) -> Iterator[pa.RecordBatch]:
        got = got[np.argsort(got["tok"], kind="stable")]
        alone = np.ones(len(got), bool)
        same = got["tok"][1:] == got["tok"][:-1]
        alone[1:] &= ~same
        alone[:-1] &= ~same
        cls, n = np.unique(got["cls"][alone], return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(cls), pa.array(n)], ["sig", "dead"])

    dead = reduce_buckets(held.select("text").mapInArrow(send, SCHEMA), record, lone, "sig bigint, dead bigint", pa.schema([("sig", pa.int64()), ("dead", pa.int64())]))
    dead = dead.groupBy("sig").agg(F.sum("dead").alias("dead"))
    return held.select("sig", "n").join(dead, "sig", "left").select("sig", F.col("n").cast("bigint").alias("n"), F.coalesce("dead", F.lit(0)).alias("dead"))


def may_link(n_a, dead_a, n_b, dead_b, percent: int):
    """Whether sets of these sizes can link: they share no more than the lesser number of shingles that are not theirs alone."""
    alive = F.least(n_a - dead_a, n_b - dead_b)
    return 100 * alive >= percent * (n_a + n_b - alive)


def bounded(pairs: DataFrame, bound: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) that their bounds allow."""
    of = lambda s: bound.select(F.col("sig").alias(f"{s}_sig"), F.col("n").alias(f"{s}_n"), F.col("dead").alias(f"{s}_dead"))
    both = pairs.join(of("a"), F.col("a") == F.col("a_sig")).join(of("b"), F.col("b") == F.col("b_sig"))
    return both.filter(may_link(*(F.col(c) for c in ("a_n", "a_dead", "b_n", "b_dead")), percent)).select("a", "b")


def with_texts(texts: DataFrame, profiles: DataFrame, wanted: DataFrame) -> DataFrame:
    """``wanted`` (sig, ...) with the text of one document that has the set."""
    own = profiles.filter("kind = 0").groupBy("sig").agg(F.min("key").alias("key"), F.first("n").alias("n"))  # copies fall together before the shuffle
    chosen = own.join(wanted, "sig")
    return texts.select("key", "text").join(chosen, "key").drop("key")


def prefixes(own: np.ndarray, percent: int) -> tuple[np.ndarray, ...]:
    """The extended prefixes of a set under the other orders."""
    n = np.array([len(own)])
    p = int((prefix_size(n, percent) + needed(n) - 1)[0])
    if not p:
        return (own,) * len(ORDERS)
    return tuple(np.partition(own * order, p - 1)[:p] for order in ORDERS)


def meet(x: np.ndarray, y: np.ndarray) -> int:
    """How many values two arrays of distinct values share."""
    both = np.concatenate([x, y])
    both.sort(kind="stable")
    return int(np.count_nonzero(both[1:] == both[:-1]))


def may_meet(x: np.ndarray, y: np.ndarray, x_prefixes, y_prefixes, percent: int) -> bool:
    """Whether two sets pass the filters: like sizes, and prefixes that share what a link needs under each other order."""
    low, high = sorted((len(x), len(y)))
    need = 1 + low // EXTENDED
    return 100 * low >= percent * high and all(meet(p, q) >= need for p, q in zip(x_prefixes, y_prefixes))


def linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    shared = meet(x, y)
    return 100 * shared >= percent * (len(x) + len(y) - shared)


def sets_of(table: pa.Table) -> Iterator[tuple[int, int, np.ndarray]]:
    """(row, sig, set) of rows (sig, text) whose text has that signature."""
    row = 0
    for block in blocks(iter(table.combine_chunks().to_batches())):
        tokens, at, sig = shingle_sets(block)
        for i in np.flatnonzero(sig == block.rows.column("sig").to_numpy()):
            yield row + int(i), int(sig[i]), tokens[at[i] : at[i + 1]]
        row += block.n


def verified(pairs: DataFrame, held: DataFrame, n_buckets: int, percent: int) -> DataFrame:
    """(a, b) of the pairs that link. held: sig, text.

    Pairs are dealt by the end that has more of them; its text goes to the bucket once, the others' texts once a
    pair. An end with over ``PAIRS_AT_ONCE`` pairs is dealt to several buckets.
    """
    ends = pairs.select(F.col("a").alias("v")).unionByName(pairs.select(F.col("b").alias("v"))).groupBy("v").agg(F.count("*").alias("degree"))
    of_a, of_b = (ends.select(F.col("v").alias(f"v_{s}"), F.col("degree").alias(f"degree_{s}")) for s in "ab")
    both = pairs.join(of_a, F.col("a") == F.col("v_a")).join(of_b, F.col("b") == F.col("v_b"))
    swap = F.col("degree_b") > F.col("degree_a")
    both = both.select(F.when(swap, F.col("b")).otherwise(F.col("a")).alias("a"), F.when(swap, F.col("a")).otherwise(F.col("b")).alias("b"), F.greatest("degree_a", "degree_b").alias("degree"))
    parts = F.ceil(F.col("degree") / PAIRS_AT_ONCE)
    bucket = F.pmod(F.xxhash64("a", "part"), F.lit(n_buckets)).cast("int").alias("bucket")
    both = materialize(both.withColumn("parts", parts).withColumn("part", F.pmod(F.xxhash64("b"), parts)), "pairs")
    other = held.select(F.col("sig").alias("b_sig"), F.col("text").alias("b_text"))
    right = other.join(both.select("a", "b", bucket), F.col("b_sig") == F.col("b")).select(F.col("bucket").alias("b_bucket"), F.col("a").alias("hub"), "b_sig", "b_text")
    hubs = both.select("a", "parts").distinct().select("a", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)).alias("part"))
    left = held.select("sig", "text").join(hubs.select("a", bucket), F.col("sig") == F.col("a")).select("bucket", "sig", "text")

    def apply(hub: pa.Table, other: pa.Table) -> pa.Table:
        sets = {sig: (own, prefixes(own, percent)) for _, sig, own in sets_of(hub.select(["sig", "text"]))}
        a, out = other.column("hub").to_pylist(), []
        for row, sig, own in sets_of(other.select(["b_sig", "b_text"]).rename_columns(["sig", "text"])):
            if a[row] in sets:
                centre, own_prefixes = sets[a[row]]
                if may_meet(centre, own, own_prefixes, prefixes(own, percent), percent) and linked(centre, own, percent):
                    out.append((a[row], sig))
        cols = list(zip(*out)) or [[]] * 2
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip("ab", cols)})

    return left.groupBy("bucket").cogroup(right.groupBy("b_bucket")).applyInArrow(apply, "a bigint, b bigint")


def ordered(df: DataFrame) -> DataFrame:
    return df.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b").distinct()


def unresolved(members: DataFrame, label: DataFrame) -> DataFrame:
    """(v, label, grp) of the groups whose members are not all of one component yet. members: grp, x."""
    of = label.select(F.col("v").alias("l_v"), F.col("label").alias("l_label"))
    left = members.join(of, F.col("x") == F.col("l_v"), "left").select("grp", F.col("x").alias("v"), F.coalesce("l_label", "x").alias("label"))
    mixed = left.groupBy(F.col("grp").alias("m_grp")).agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low < high").select("m_grp")
    mixed = materialize(mixed, "mixed-groups")
    return left.join(mixed, F.col("grp") == F.col("m_grp"), "left_semi")


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Shared values of every two of some sets, exactly, as products of their incidence matrices, columns in blocks."""
    m = len(sets)
    size = np.array([len(x) for x in sets])
    _, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    keep = count[column] > 1  # what one set alone has is shared with none
    column, row = column[keep], np.repeat(np.arange(m), size)[keep]
    order = np.argsort(column, kind="stable")
    column, row = np.unique(column[order], return_inverse=True)[1], row[order]
    out = np.zeros((m, m), np.float32)
    width = 2048
    for first in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        a, b = np.searchsorted(column, (first, first + width))
        x = np.zeros((m, width), np.float32)
        x[row[a:b], column[a:b] - first] = 1
        out += x @ x.T
    return out.astype(np.int64)


def near_pairs(sets: list[np.ndarray], label: np.ndarray, percent: int) -> np.ndarray:
    """Pairs of sets of different labels that pass the filters under the other orders: like sizes and enough shared tokens."""
    n = np.array([len(x) for x in sets])
    low, high = np.minimum(n[:, None], n[None, :]), np.maximum(n[:, None], n[None, :])
    near = (100 * low >= percent * high) & (label[:, None] < label[None, :])
    parts = [prefixes(x, percent) for x in sets]
    for k in range(len(ORDERS)):
        if near.any():
            near &= overlaps([p[k] for p in parts]) >= 1 + low // EXTENDED
    return near


def block_links(sets: list[np.ndarray], label: np.ndarray, percent: int) -> set[tuple[int, int]]:
    """Labels that links between sets of a block join."""
    near = near_pairs(sets, label, percent)
    use = np.flatnonzero(near.any(0) | near.any(1))
    if not len(use):
        return set()
    both, n = overlaps([sets[k] for k in use]), np.array([len(sets[k]) for k in use])
    i, j = np.nonzero(near[np.ix_(use, use)] & (100 * both >= percent * (n[:, None] + n[None, :] - both)))
    return set(zip(label[use[i]].tolist(), label[use[j]].tolist()))


def group_links(left: DataFrame, held: DataFrame, n_buckets: int, percent: int) -> DataFrame:
    """(a, b): labels of sets of one group that link. A group of over ``GROUP_BLOCK`` sets is dealt out as pairs of blocks.

    Sets are compared where they lie together; what comes out are links between components, not pairs of sets.
    """
    size = left.groupBy(F.col("grp").alias("s_grp")).agg(F.ceil(F.count("*") / GROUP_BLOCK).alias("parts"))
    left = left.join(size, F.col("grp") == F.col("s_grp")).withColumn("part", F.pmod(F.xxhash64("v"), F.col("parts")))
    other = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)).alias("other")
    tasks = left.select("v", "label", "grp", "part", other).select("v", "label", F.xxhash64("grp", F.least("part", "other"), F.greatest("part", "other")).alias("task"))
    sent = held.select("sig", "text").join(tasks, F.col("sig") == F.col("v")).select(F.pmod("task", F.lit(n_buckets)).cast("int").alias("bucket"), "task", "sig", "label", "text")

    def apply(table: pa.Table) -> pa.Table:
        task, label = table.column("task").to_numpy(), table.column("label").to_numpy()
        rows, sets = [], []
        for row, _, own in sets_of(table.select(["sig", "text"])):
            rows.append(row)
            sets.append(own)
        rows, found = np.array(rows, np.int64), set()
        for t in np.unique(task):
            at = np.flatnonzero(task[rows] == t)
            found |= block_links([sets[k] for k in at], label[rows[at]], percent)
        both = np.array(sorted(found), np.int64).reshape(-1, 2)
        return pa.table({"a": pa.array(both[:, 0].copy()), "b": pa.array(both[:, 1].copy())})

    return sent.groupBy("bucket").applyInArrow(apply, "a bigint, b bigint").distinct()


def ngram_join(docs: DataFrame, percent: int = PERCENT, rid: Column | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept (one row of each component), rid.

    rid: a number of each row, where the caller has one to join by.
    """
    texts = keyed(docs, rid)
    profiles = materialize(profile(texts), "shingle-profiles")
    common = docs.sparkSession.sparkContext.broadcast(common_tokens(profiles))
    n_buckets = buckets_for(docs, 1.5)
    wanted = enough_lists(postings(texts, common, n_buckets, percent), n_buckets, percent)
    held = materialize(with_texts(texts, profiles, wanted).dropDuplicates(["sig"]), "candidate-texts")
    found = materialize(candidates(postings(held, common, n_buckets, percent), n_buckets, percent), "candidates")
    bound = materialize(bounds(held, max(8, plan_bytes(docs) // (20 << 20))), "bounds")
    open_ = 100 * (F.col("n") - F.col("dead")) >= percent * F.col("n")  # else it links with nothing
    members = materialize(found.join(bound.filter(open_).select(F.col("sig").alias("x"), "dead"), "x"), "members")
    release(found)
    centre = members.groupBy(F.col("grp").alias("c_grp")).agg(F.min(F.struct("dead", "x")).alias("c"), F.count("*").alias("size")).filter("size > 1")
    centre = materialize(centre, "centres")  # its size shows whether members of a large group need to be dealt by group at all
    members = materialize(members.join(centre, F.col("grp") == F.col("c_grp")).select("grp", "x", F.col("c.x").alias("centre")), "groups")
    pairs = materialize(bounded(ordered(members.select(F.col("x").alias("a"), F.col("centre").alias("b"))), bound, percent), "candidate-pairs")
    n_buckets = buckets_for(docs, 1.0)
    links = materialize(verified(pairs, held, n_buckets, percent), "links")
    label = components(links)
    left = materialize(unresolved(members, label), "unresolved")
    more = materialize(group_links(left, held, n_buckets, percent), "group-links")
    if more.limit(1).count():
        label = components(links.unionByName(more))
    release(held, bound, members, pairs, left)
    rows = profiles.filter("kind = 0").select("rid", "doc_id", "n", "sig")
    rows = materialize(rows.join(label, rows["sig"] == label["v"], "left").select("rid", "doc_id", "n", F.coalesce("label", "sig").alias("root")), "rooted")
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "rid")).alias("least")
    least = materialize(rows.filter("n > 0").groupBy("root").agg(least), "component-ids")
    n = F.col("n").cast("bigint").alias("n_shingles")
    empty = rows.filter("n = 0").select("doc_id", n, F.col("doc_id").alias("component_id"), F.lit(True).alias("kept"), "rid")
    full = rows.filter("n > 0").join(least, "root").select("doc_id", n, F.col("least.doc_id").alias("component_id"), (F.col("least.rid") == F.col("rid")).alias("kept"), "rid")
    return full.unionByName(empty)


def deduplicated(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One row of each component, with all its columns."""
    rows, row = numbered(docs)
    dropped = ngram_join(rows, percent, rid=F.col(row)).filter("NOT kept").select(F.col("rid").alias(row))
    return rows.join(dropped, row, "left_anti").select(*docs.columns)


ORACLE = f"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + {SHINGLE - 1}], ' ') AS g FROM (SELECT doc_id, ws, unnest(generate_series(1, greatest(len(ws) - {SHINGLE - 1}, 1))) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS both_have FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
e AS (SELECT x, y FROM c JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * both_have >= {PERCENT} * (p.n + q.n - both_have)),
r(x, y) AS (SELECT doc_id, doc_id FROM w UNION SELECT r.x, e.y FROM r JOIN e ON e.x = r.y)
SELECT r.x AS doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(r.y) AS component_id FROM r LEFT JOIN n ON n.doc_id = r.x GROUP BY r.x
"""
