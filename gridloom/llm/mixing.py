"""Mixing sources to target weights by Sainte-Laguë apportionment.

Sources share all words by weight; a target stops at ``repeats`` times its source's words and the excess goes to
the others by weight. The mix is dealt in blocks of equal words: sources get whole numbers of blocks by highest
quotients target / (2k + 1), then each source's blocks go to its shards (documents by seeded hash) the same way.
Within a shard the documents, in seeded order, make one stream of words cut into blocks; whole passes take all
of it and the rest takes blocks by seeded rank, so a document's taken words are what the chosen blocks hold.

Only totals of shards reach the driver, at most ``most_shards`` plus one for each source. Shards split a hot
source, and a shard is a bounded share of the corpus: rows that are alike in doc_id, source and size are counted
first and dealt to shards ``COPIES`` at a time, so a doc_id that repeats without end fills no shard.

Defined results: null text has size 0; a null source is a source of its own, ordered last; documents without
words take 0; with no words at all every target is 0; rows that repeat a doc_id count each; an empty table
gives no rows.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from gridloom.llm.session import materialize, release

WEIGHTS = (5.0, 2.0, 1.0)
REPEATS = 3
#: A block is a 20,000th of all words, 1,024 at most until shards would be more than MOST_SHARDS.
BLOCK_WORDS = 1 << 10
BLOCKS_PER_MIX = 20_000
MOST_SHARDS = 200_000
BLOCKS_PER_SHARD = 64
#: Rows alike that go to one shard together.
COPIES = 256


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("bigint")


def targets(sizes: list[int], weights: list[float], repeats: float = REPEATS) -> list[float]:
    """Share sum(sizes) by weights; each stops at repeats * size, the excess reshared by weight."""
    out, open_, left = [0.0] * len(sizes), list(range(len(sizes))), float(sum(sizes))
    while open_:
        total = sum(weights[i] for i in open_)
        over = [i for i in open_ if left * weights[i] / total > repeats * sizes[i]]
        if not over:
            for i in open_:
                out[i] = left * weights[i] / total
            break
        for i in over:
            out[i] = float(repeats * sizes[i])
        left -= sum(out[i] for i in over)
        open_ = [i for i in open_ if i not in set(over)]
    return out


def sainte_lague(votes: list[float], seats: int, most: list[int] | None = None) -> list[int]:
    """Seats by highest quotients votes / (2k + 1), ties to the earlier; at most most[i] each."""
    v = np.asarray(votes, float)
    cap = np.asarray(most if most is not None else [seats] * len(v), np.int64)
    got = np.zeros(len(v), np.int64)
    if not len(v) or v.sum() <= 0:
        return got.tolist()
    seats = int(min(seats, cap[v > 0].sum()))
    low, high = 0.0, 2 * float(v.max()) + 1  # a divisor that gives no more than all seats
    for _ in range(200):
        mid = (low + high) / 2
        given = np.minimum(np.floor(v / mid + 0.5), cap).sum()
        low, high = (low, mid) if given <= seats else (mid, high)
    got = np.minimum(np.floor(v / high + 0.5), cap).astype(np.int64)
    heap = [(-v[i] / (2 * got[i] + 1), i) for i in range(len(v)) if got[i] < cap[i] and v[i] > 0]
    heapq.heapify(heap)
    for _ in range(seats - int(got.sum())):
        _, i = heapq.heappop(heap)
        got[i] += 1
        if got[i] < cap[i]:
            heapq.heappush(heap, (-v[i] / (2 * got[i] + 1), i))
    return got.tolist()


def plan(shards: pd.DataFrame, block: int, weights=WEIGHTS, repeats: int = REPEATS) -> tuple[pd.DataFrame, pd.DataFrame]:
    """Targets by source, and quotas in blocks by (source, shard). shards: source, shard, words."""
    sources = shards.groupby("source", dropna=False, sort=False)["words"].sum().reset_index()
    sources["key"] = [(s is None or s != s, "" if s is None or s != s else s) for s in sources["source"]]
    sources = sources.sort_values("key", key=lambda c: c.map(lambda k: (k[0], [ord(x) for x in k[1]])), ignore_index=True)
    sources["target"] = targets(sources["words"].tolist(), [weights[i % len(weights)] for i in range(len(sources))], repeats)
    total = int(round(sources["target"].sum() / block))
    room = [-(-repeats * int(w) // block) for w in sources["words"]]
    sources["quota"] = sainte_lague(sources["target"].tolist(), total, room)
    shards = shards.assign(source_key=[(s is None or s != s, "" if s is None or s != s else s) for s in shards["source"]])
    shards = shards.sort_values(["source_key", "shard"], ignore_index=True)
    quota = dict(zip(sources["key"], sources["quota"]))
    parts = []
    for key, own in shards.groupby("source_key", sort=False):
        room = (-(-repeats * own["words"] // block)).tolist()
        parts.append(own.assign(quota=sainte_lague(own["words"].tolist(), int(quota[key]), room)))
    out = pd.concat(parts) if parts else shards.assign(quota=0)
    return sources[["source", "words", "target", "quota"]], out[["source", "shard", "words", "quota"]]


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", weights=WEIGHTS, repeats: int = REPEATS, seed: int = 0, block_words: int = BLOCK_WORDS, most_shards: int = MOST_SHARDS) -> DataFrame:
    """One row per row of ``docs``: doc_id, size, source_size, target, taken."""
    spark = docs.sparkSession
    sized = docs.select(F.col(doc_id).alias("doc_id"), F.col(source).cast("string").alias("source"), n_words(F.col(text)).alias("size"), F.xxhash64(F.lit(seed), F.col(doc_id), F.col(source)).alias("h"))
    sized = materialize(sized.groupBy("doc_id", "source", "size", "h").agg(F.count("*").alias("n")), "sizes")
    words = sized.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    total = words.agg(F.sum("source_size")).first()[0] or 0
    block = max(1, min(block_words, total // BLOCKS_PER_MIX), -(-total // (most_shards * BLOCKS_PER_SHARD)))
    shard_words = block * BLOCKS_PER_SHARD
    cut = words.select(F.col("source").alias("c_source"), "source_size", F.greatest(F.lit(1), F.ceil(F.col("source_size") / shard_words)).cast("bigint").alias("shards"))
    some = F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("n") - 1) / COPIES))).alias("part")
    dealt = sized.select("*", some).withColumn("copies", F.least(F.col("n") - F.col("part") * COPIES, F.lit(COPIES)))
    dealt = dealt.withColumn("h", F.when(F.col("part") == 0, F.col("h")).otherwise(F.xxhash64("h", "part")))
    dealt = dealt.join(cut, F.col("source").eqNullSafe(F.col("c_source"))).select("doc_id", "source", "size", "h", "copies", "source_size", F.pmod(F.shiftright("h", 20), F.col("shards")).alias("shard"))
    dealt = materialize(dealt, "shards")
    release(sized)
    table = dealt.groupBy("source", "shard").agg(F.sum(F.col("size") * F.col("copies")).alias("words")).toPandas()
    by_source, by_shard = plan(table, block, weights, repeats)
    goals = spark.createDataFrame([(None if s is None or s != s else s, float(t)) for s, t in zip(by_source["source"], by_source["target"])], "g_source string, target double")
    quotas = spark.createDataFrame([(None if s is None or s != s else s, int(k), int(w), int(q)) for s, k, w, q in by_shard.itertuples(index=False)], "source string, shard long, words long, quota long")
    quotas = quotas.join(goals, F.col("source").eqNullSafe(F.col("g_source"))).drop("g_source")
    return taken(dealt, quotas, block, repeats, seed)


def taken(dealt: DataFrame, quotas: DataFrame, block: int, repeats: int, seed: int) -> DataFrame:
    """Words that each document gives, from its shard's quota of blocks."""
    order = W.partitionBy("source", "shard").orderBy("h", "doc_id", "size")
    held = F.col("size") * F.col("copies")
    rows = dealt.withColumn("end", F.sum(held).over(order.rowsBetween(W.unboundedPreceding, 0))).withColumn("begin", F.col("end") - held)
    due = F.col("quota") * block
    q = quotas.withColumn("passes", F.when(F.col("words") > 0, F.floor(due / F.greatest("words", F.lit(1)))).otherwise(0)).withColumn("rest", F.when(F.col("words") > 0, due - F.col("passes") * F.col("words")).otherwise(0))
    # The blocks that the last, partial pass takes: a shard's first by seeded hash, the last one cut to the words due.
    blocks = F.sequence(F.lit(0).cast("bigint"), F.greatest(F.ceil(F.col("words") / block), F.lit(1)).cast("bigint") - 1)
    ranked = F.array_sort(F.transform(blocks, lambda b: F.struct(F.xxhash64(F.lit(seed), "source", "shard", b).alias("h"), (b * block).alias("begin"), F.least((b + 1) * block, F.col("words")).alias("end"))))
    empty = F.struct(F.col("rest").cast("bigint").alias("left"), F.array().cast("array<struct<begin:bigint,end:bigint>>").alias("out"))

    def step(acc, x):
        take = F.least(acc["left"], x["end"] - x["begin"])
        more = F.array_append(acc["out"], F.struct(x["begin"].alias("begin"), (x["begin"] + take).alias("end")))
        return F.struct((acc["left"] - take).alias("left"), F.when(take > 0, more).otherwise(acc["out"]).alias("out"))

    q = q.withColumn("chosen", F.aggregate(ranked, empty, step, lambda acc: acc["out"]))
    q = q.select(F.col("source").alias("q_source"), F.col("shard").alias("q_shard"), "target", "passes", "chosen")
    rows = rows.join(q, rows["source"].eqNullSafe(q["q_source"]) & (rows["shard"] == q["q_shard"]))
    rows = rows.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("copies") - 1)))
    rows = rows.withColumn("begin", F.col("begin") + F.col("copy") * F.col("size")).withColumn("end", F.col("begin") + F.col("size"))
    inside = lambda b: F.greatest(F.lit(0), F.least(F.col("end"), b["end"]) - F.greatest(F.col("begin"), b["begin"]))
    part = F.aggregate("chosen", F.lit(0).cast("bigint"), lambda a, b: a + inside(b))
    return rows.select("doc_id", "size", "source_size", "target", F.least(F.col("passes") * F.col("size") + part, F.lit(repeats) * F.col("size")).cast("bigint").alias("taken"))
