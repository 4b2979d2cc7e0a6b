"""Exact deduplication by content-defined chunk recipes (DataFrame functions only).

Every normalised text is cut into chunks at places that its own bytes choose, so equal texts have equal chunks
wherever they lie. A chunk's identifier is its 64-bit hash, verified against its SHA-256: where one hash stands
for several digests, the identifier also carries the digest's place among them. A text's recipe is the ordered
list of its identifiers; texts are equal when their recipes are. Texts are read once and never shuffled: only
recipes travel, 16 bytes for about 1.5 KB of text. ``deduplicated`` writes the rows with their chunks and reads
them back beside a bit for each row.

Defined results: null text counts as empty, and an empty text has the empty recipe, so all empty texts are
equal. Of equal texts the smallest doc_id stays (null ids last); of rows that repeat that doc_id exactly one is
kept. Other columns of the input are ignored. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from gridloom.llm.session import files_for, fresh, materialize, small_batches, without

SPACES = "[\\x20\\x09-\\x0D]+"
#: A chunk ends after the first word past 1,024 characters whose end is one of 10 letter pairs, or at 8,192.
CHUNK = "(?s).{1024,8191}?(?:(?:er|on|ti|an|ed|le|re|nd|es|ch) |\\z)|.{1,8192}"


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACES, " ")


def exact_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rid: Column | None = None, chunk_hash: Callable[[Column], Column] = F.xxhash64) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256, rid.

    rid: a number of each row, where the caller has one to join by.
    """
    rows = docs.select((F.monotonically_increasing_id() if rid is None else rid).alias("rid"), F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    cut = chunked(rows, "text", "text_sha256", "chunks", chunk_hash).drop("text")
    return grouped(with_recipes(materialize(cut, "recipes")))


def chunked(rows: DataFrame, text: str, sha: str, chunks: str, chunk_hash: Callable[[Column], Column] = F.xxhash64) -> DataFrame:
    """Add two columns: the normalised text's SHA-256, and its chunks' hashes and digests in order."""
    digest = lambda c: F.struct(chunk_hash(c).alias("h"), F.unhex(F.sha2(c.cast("binary"), 256)).alias("sha"))
    rows = rows.withColumn(chunks, normalised(F.col(text)))
    found = F.transform(F.regexp_extract_all(chunks, F.lit(CHUNK), F.lit(0)), digest)
    return rows.withColumns({sha: F.sha2(F.col(chunks).cast("binary"), 256), chunks: found})


def with_recipes(cut: DataFrame) -> DataFrame:
    """Each row's recipe: its chunks' verified identifiers in order. ``cut`` is written; it is read again, and nothing
    joined nor written, where no hash stands for several digests."""
    refs = cut.select("rid", F.posexplode("chunks").alias("at", "c")).select("rid", "at", "c.h", "c.sha")
    clashing = refs.groupBy("h", "sha").agg(F.lit(1).alias("one")).groupBy("h").agg(F.count("*").alias("n"), F.sort_array(F.collect_list("sha")).alias("shas")).filter("n > 1").select("h", "shas")
    clashing = materialize(clashing, "clashing")  # all but empty: what its size shows lets the join be a broadcast
    place = lambda c, i: F.struct(c["h"].alias("h"), F.coalesce(F.try_element_at("variants", i), F.lit(1).cast("bigint")).alias("variant"))
    recipe = F.transform("chunks", place).alias("recipe")
    if not clashing.limit(1).count():
        return cut.withColumn("variants", F.lit(None).cast("map<int,bigint>")).select("rid", "doc_id", "text_sha256", recipe)
    doubtful = refs.join(clashing, "h").select("rid", "at", F.array_position("shas", F.col("sha")).alias("variant"))
    doubtful = doubtful.groupBy("rid").agg(F.map_from_entries(F.collect_list(F.struct("at", "variant"))).alias("variants"))
    return materialize(cut.join(doubtful, "rid", "left").select("rid", "doc_id", "text_sha256", recipe), "with-recipes")


def grouped(recipes: DataFrame) -> DataFrame:
    """Compare recipes: the first row of each group stays. Groups are pre-aggregated before the shuffle and
    written, so that the join back is between two plain exchanges, which AQE can split at a hot recipe."""
    own = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "rid")
    groups = materialize(recipes.groupBy("recipe").agg(F.min(own).alias("keep"), F.count("*").alias("group_size")), "recipe-groups")
    return recipes.join(groups, "recipe").select("doc_id", F.col("keep.doc_id").alias("keep_id"), "group_size", (F.col("keep.rid") == F.col("rid")).alias("kept"), "text_sha256", "rid")


def deduplicated(docs: DataFrame) -> DataFrame:
    """One row of each group of equal texts, with all its columns. Rows are numbered and cut in one pass over the texts."""
    row, sha, chunks = (fresh(docs, name) for name in ("gridloom_row", "gridloom_sha256", "gridloom_chunks"))
    with small_batches(docs.sparkSession):
        rows = chunked(docs.withColumn(row, F.monotonically_increasing_id()), "text", sha, chunks)
        rows = materialize(rows.coalesce(files_for(docs)), "numbered")
        cut = rows.select(F.col(row).alias("rid"), "doc_id", F.col(sha).alias("text_sha256"), F.col(chunks).alias("chunks"))
        dropped = grouped(with_recipes(cut)).filter("NOT kept").select(F.col("rid").alias(row))
        return without(rows.drop(sha, chunks), row, dropped).select(*docs.columns)


ORACLE = r"""
WITH d AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = min(doc_id) OVER w AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256)
"""
