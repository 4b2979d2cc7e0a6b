"""Lineage: freshness, completeness, hashes, provenance, product identity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F


def stale(source: DataFrame, output: DataFrame, keys: tuple[str, ...], time: str = "mtime", digest: str | None = None) -> DataFrame:
    """Sources whose output is missing or not newer (strictly); with ``digest``, missing or made from other bytes."""
    right = output.select(*keys, F.col(digest or time).alias("_made"))
    same = (F.col("_made") == F.col(digest)) if digest else (F.col("_made") > F.col(time))
    return source.join(right, list(keys), "left").filter(~F.coalesce(same, F.lit(False))).drop("_made")


def audit(listed: DataFrame, local: DataFrame, name: str = "file", size: str = "size") -> DataFrame:
    """Listed files with status ok, stale (other size) or missing."""
    right = local.select(name, F.col(size).alias("_local"))
    status = F.when(F.col("_local").isNull(), "missing").when(F.col("_local") != F.col(size), "stale").otherwise("ok")
    return listed.join(right, name, "left").withColumn("status", status).drop("_local")


def verify(files: DataFrame, manifest: DataFrame) -> DataFrame:
    """Counts of files that match their record, have none, or differ. files: file, sha256."""
    both = files.join(manifest.select("file", F.col("sha256").alias("_wanted")), "file", "left")
    return both.agg(F.count_if(F.col("_wanted") == F.col("sha256")).alias("verified"), F.count_if(F.col("_wanted").isNull()).alias("no_record"), F.count_if(F.col("_wanted") != F.col("sha256")).alias("mismatch"))


def hashed_files(spark: SparkSession, path: str) -> DataFrame:
    """file, sha256 of the files under a path."""
    return spark.read.format("binaryFile").load(path).select(F.regexp_extract("path", r"([^/]+)$", 1).alias("file"), F.sha2("content", 256).alias("sha256"))


def _hash_order(seed: int, key: str) -> tuple[Column, Column]:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")).cast("binary")), F.col(key)


def seeded_sample(df: DataFrame, key: str, share: float, least: int, most: int, seed: int = 42) -> DataFrame:
    """A sample by hash order: a share of the rows, within bounds; the same rows every time. At most ``most`` rows are ranked."""
    order = _hash_order(seed, key)
    n = df.agg(F.greatest(F.lit(least), F.floor(F.count("*") * share)).alias("_wanted"))
    top = df.orderBy(*order).limit(most).withColumn("_rank", F.row_number().over(W.orderBy(*order)))
    return top.join(F.broadcast(n), F.col("_rank") <= F.col("_wanted")).drop("_rank", "_wanted")  # one row


def stratified_sample(df: DataFrame, key: str, stratum: str, most: int, seed: int = 42, parts: int = 64) -> DataFrame:
    """The first ``most`` rows of each stratum by hash order. A stratum is ranked in parts first, so none is sorted in one task."""
    order = _hash_order(seed, key)
    first = df.withColumn("_part", F.pmod(F.xxhash64(key), F.lit(parts)))
    first = first.withColumn("_rank", F.row_number().over(W.partitionBy(stratum, "_part").orderBy(*order))).filter(F.col("_rank") <= most)
    return first.withColumn("_rank", F.row_number().over(W.partitionBy(stratum).orderBy(*order))).filter(F.col("_rank") <= most).drop("_rank", "_part")


def completeness(expected: DataFrame, actual: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    return expected.join(actual, list(keys), "left_anti")


def schema_drift(df: DataFrame, reference: dict[str, str]) -> dict[str, list[str]]:
    """Columns added, lost or retyped against a reference of names and types; empty lists: no drift."""
    own = dict(df.dtypes)
    return {"added": sorted(set(own) - set(reference)), "lost": sorted(set(reference) - set(own)), "retyped": sorted(c for c in set(own) & set(reference) if own[c] != reference[c])}


def parity(left: DataFrame, right: DataFrame) -> list[tuple[str, str]]:
    """(column, what differs) of two outputs: a column of one side only, another type, or other attributes."""
    l, r = ({f.name: f for f in d.schema.fields} for d in (left, right))  # noqa: E741
    out = [(c, "left only" if c in l else "right only") for c in sorted(set(l) ^ set(r))]
    for c in sorted(set(l) & set(r)):
        if l[c].dataType != r[c].dataType:
            out.append((c, "type"))
        if (l[c].metadata or {}) != (r[c].metadata or {}):
            out.append((c, "attributes"))
    return out


def bless(spark: SparkSession, df: DataFrame, path: str) -> dict[str, list[str]] | None:
    """Compare with the schema stored at ``path``: None where there is none yet, else the drift. Without drift, or without
    a stored one, this schema becomes the reference."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    there = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)
    drift = schema_drift(df, {r["name"]: r["type"] for r in spark.read.parquet(path).collect()}) if there else None  # a row for each column
    if drift is None or not any(drift.values()):
        spark.createDataFrame(df.dtypes, "name string, type string").coalesce(1).write.mode("ignore" if there else "overwrite").parquet(path)
    return drift


def copy_plan(remote: DataFrame, local: DataFrame, clobber: bool = True) -> DataFrame:
    """What to fetch: of each file the first source's that has it, where it is not here, or (clobbering) is newer there.

    remote: file, source, priority, mtime; local: file, mtime. Running the plan leaves nothing to fetch.
    """
    best = remote.groupBy("file").agg(F.min_by(F.struct("source", "mtime"), F.struct("priority", "source")).alias("r")).select("file", "r.source", "r.mtime")
    both = best.join(local.select("file", F.col("mtime").alias("_here")), "file", "left")
    newer = F.col("mtime") > F.col("_here") if clobber else F.lit(False)
    return both.filter(F.col("_here").isNull() | newer).select("file", "source", "mtime", F.when(F.col("_here").isNull(), "new").otherwise("newer").alias("why"))


def difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of one side only, with the side."""
    return left.exceptAll(right).withColumn("side", F.lit("left")).unionByName(right.exceptAll(left).withColumn("side", F.lit("right")))


def provenance(base: Column, extra: Column) -> Column:
    """Attributes with ``extra`` winning; empty ones left out."""
    kept = F.map_filter(base, lambda k, v: ~F.array_contains(F.map_keys(extra), k))
    return F.map_filter(F.map_concat(kept, extra), lambda k, v: v.isNotNull() & (F.trim(v) != ""))


def append_history(attributes: Column, line: Column) -> Column:
    """The attributes with a line added to their history."""
    rest = F.map_filter(attributes, lambda k, v: k != "history")
    return F.map_concat(rest, F.create_map(F.lit("history"), F.concat_ws("\n", F.try_element_at(attributes, F.lit("history")), line)))


def sorted_text(attributes: Column) -> Column:
    """'key: value' lines in order of keys."""
    return F.array_join(F.transform(F.array_sort(F.map_entries(attributes)), lambda e: F.concat_ws(": ", e["key"], e["value"])), "\n")


def identity_diff(stored: Column, current: Column) -> Column:
    """Keys that the current run declares and the store has otherwise, as 'key: stored != current'."""
    both = F.map_zip_with(current, stored, lambda k, c, s: F.when(c.isNotNull() & ~c.eqNullSafe(s), F.concat(k, F.lit(": "), F.coalesce(s, F.lit("(none)")), F.lit(" != "), c)))
    return F.array_sort(F.filter(F.map_values(both), lambda x: x.isNotNull()))


def enforce_identity(stored: dict[str, str] | None, current: dict[str, str], mixed_allowed: bool = False) -> str:
    """'created', 'match' or 'mixed'; a mismatch that was not allowed is refused before anything is written."""
    if stored is None:
        return "created"
    if all(stored.get(k) == v for k, v in current.items()):
        return "match"
    if mixed_allowed:
        return "mixed"
    raise ValueError("the product there has another identity: " + ", ".join(f"{k}={stored.get(k)!r} not {v!r}" for k, v in sorted(current.items()) if stored.get(k) != v))


def series_gate(df: DataFrame, first: int, last: int, key: str = "ym") -> DataFrame:
    """``df`` itself, or an error once it is computed: every month from first to last is there."""
    n = df.filter(F.col(key).between(first, last)).agg(F.countDistinct(key).alias("_n"))
    wrong = F.col("_n") != last - first + 1
    refuse = F.raise_error(F.format_string("%d of %d months are there", F.col("_n"), F.lit(last - first + 1)))
    return df.crossJoin(F.broadcast(n)).withColumn(key, F.when(wrong, refuse.cast("int")).otherwise(F.col(key))).drop("_n")  # one row


def variables_everywhere(df: DataFrame, variables: tuple[str, ...], months: int) -> list[str]:
    """Variables that every month has; refuses a table with another number of months."""
    got = df.agg(F.countDistinct("ym").alias("n"), *(F.countDistinct(F.when(F.col(v).isNotNull(), F.col("ym"))).alias(v) for v in variables)).first()
    if got["n"] != months:
        raise ValueError(f"{got['n']} months, not {months}")
    return [v for v in variables if got[v] == months]


def report(df: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Coverage by stream: first and last month, years, months from a climatology."""
    return df.groupBy(*keys).agg(F.min("ym").alias("first"), F.max("ym").alias("last"), F.array_join(F.array_sort(F.collect_set(F.floor(F.col("ym") / 12).cast("string"))), " ").alias("years"), F.count("*").alias("n"))
