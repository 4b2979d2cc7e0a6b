"""Text sources: configuration, manifests, listings, logs, tower files."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from gridloom.schema import MANIFEST


def conf(lines: DataFrame, value: str = "value") -> DataFrame:
    """(key, value) of KEY="VALUE" lines; comments and other lines are left out, quotes stripped."""
    pattern = r"""^\s*(?:export\s+)?([A-Za-z_][A-Za-z0-9_]*)=(?:"([^"]*)"|'([^']*)'|([^\s#]*))"""
    x = F.col(value)
    part = lambda g: F.regexp_extract(x, pattern, g)
    return lines.filter(~x.rlike(r"^\s*#") & x.rlike(pattern)).select(part(1).alias("key"), F.coalesce(F.nullif(part(2), F.lit("")), F.nullif(part(3), F.lit("")), part(4)).alias("value"))


def manifest(lines: DataFrame, value: str = "value") -> DataFrame:
    """Run manifest of seven tab-separated columns, and whether each line is malformed."""
    cells = F.split(F.col(value), "\t", -1)
    kept = lines.filter(~F.col(value).startswith("#") & (F.length(F.trim(value)) > 0)).withColumn("_c", cells)
    return kept.select(*(F.get("_c", F.lit(i)).alias(n) for i, n in enumerate(MANIFEST)), (F.size("_c") != len(MANIFEST)).alias("malformed"))


def manifest_line(*columns: Column) -> Column:
    """One line of the manifest; tabs and newlines in values become spaces."""
    return F.concat_ws("\t", *(F.translate(F.coalesce(c.cast("string"), F.lit("")), "\t\n\r", "   ") for c in columns))


def hash_manifest(lines: DataFrame, value: str = "value", manifest_name: str = "manifest") -> DataFrame:
    """(file, sha256) of 'hash  path' lines, path reduced to its last part; of several manifests the last in order wins."""
    cells = F.split(F.trim(value), r"\s+", 2)
    rows = lines.filter(F.trim(value).rlike(r"^[0-9a-fA-F]{64}\s+\S")).select(F.lower(F.get(cells, F.lit(0))).alias("sha256"), F.regexp_replace(F.get(cells, F.lit(1)), r"^\*|^.*/", "").alias("file"), manifest_name)
    return rows.groupBy("file").agg(F.max_by("sha256", F.struct(manifest_name, "sha256")).alias("sha256"))


def listing(pages: DataFrame, html: str = "html", pattern: str = r"""href="([^"/?]+)"[^<]*<""", keys: tuple[str, ...] = ()) -> DataFrame:
    """Names that an index page links to, one row each."""
    return pages.select(*keys, F.explode(F.array_distinct(F.regexp_extract_all(html, F.lit(pattern), F.lit(1)))).alias("file"))


#: A row of an index page: link, date, size with a unit.
LISTING_ROW = r"""href="([^"/?]+)"[^>]*>[^<]*</a>\s*([0-9]{4}-[0-9]{2}-[0-9]{2})(?: [0-9:]+)?\s+([0-9.]+)([KMG]?)"""


def listing_rows(pages: DataFrame, html: str = "html", keys: tuple[str, ...] = ()) -> DataFrame:
    """(file, date, size in bytes) of the rows of an index page; sizes with a unit are as exact as the page."""
    rows = pages.select(*keys, F.explode(F.regexp_extract_all(html, F.lit(LISTING_ROW), F.lit(0))).alias("_row"))
    part = lambda k: F.regexp_extract("_row", LISTING_ROW, k)
    unit = F.when(part(4) == "K", 1 << 10).when(part(4) == "M", 1 << 20).when(part(4) == "G", 1 << 30).otherwise(1)
    return rows.select(*keys, part(1).alias("file"), F.to_date(part(2)).alias("date"), F.round(part(3).cast("double") * unit).cast("bigint").alias("size")).distinct()


def append_manifest(lines: DataFrame, path: str) -> None:
    """Add lines (one string column) to the manifest at ``path``."""
    lines.write.mode("append").text(path)


def log_errors(lines: DataFrame, value: str = "value", pattern: str = r"(?i)\b(error|fatal|traceback|killed)\b", skip: tuple[str, ...] = ()) -> DataFrame:
    """Lines that name an error and match nothing on the skip list."""
    out = lines.filter(F.col(value).rlike(pattern))
    for s in skip:
        out = out.filter(~F.col(value).rlike(s))
    return out


def tower_csv(spark: SparkSession, path: str, columns: list[str], skip: int = 2, missing: str = "-9999") -> DataFrame:
    """Half-hourly tower files: ``skip`` lines before each file's header, ``missing`` for no value, rows with gaps left out.

    Each file has a header of its own; nothing is read until the result is.
    """
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_start"), F.monotonically_increasing_id().alias("_n"))
    first = lines.filter("_start = 0").groupBy(F.col("_file").alias("_of")).agg(F.min("_n").alias("_zero"))  # the first split of a file
    placed = lines.join(first, F.col("_file") == F.col("_of"), "left").withColumn("_at", F.when(F.col("_start") == 0, F.col("_n") - F.col("_zero")))
    cells = F.transform(F.split("value", ",", -1), lambda x: F.trim(x))
    header = placed.filter(F.col("_at") == skip).select(F.col("_file").alias("_h_file"), cells.alias("_names"))
    rows = placed.filter(F.col("_at").isNull() | (F.col("_at") > skip)).join(header, F.col("_file") == F.col("_h_file")).select(cells.alias("_cells"), "_names")
    value = lambda c: F.nullif(F.get("_cells", (F.array_position("_names", c) - 1).cast("int")), F.lit(missing))
    return rows.select(*(F.nullif(value(c), F.lit("")).alias(c) for c in columns)).dropna()


#: VAR[_PI][_F]_H_V_R: worked up by the investigator, gap-filled, then horizontal, vertical and replicate (a number or a letter).
TOWER_NAME = r"^([A-Z][A-Z0-9]*(?:_[A-Z0-9]*[A-Z][A-Z0-9]*)*?)(_PI)?(_F)?_(\d+)_(\d+)_(\d+|[A-Z])$"
#: Marks of quality columns, which hold no measurement.
TOWER_QUALITY = ("QC", "SSITC")


def parse_column(name: str) -> tuple[str, int, int, int, str] | None:
    """(variable, rank, horizontal, vertical, replicate) of a tower column; rank: 0 raw, 1 PI, 2 gap-filled."""
    m = re.fullmatch(TOWER_NAME, name)
    if not m or any(q in name for q in TOWER_QUALITY):
        return None
    return m[1], 2 if m[3] else 1 if m[2] else 0, int(m[4]), int(m[5]), m[6]


def pick_column(columns: list[str], variable: str, shallowest: bool = False, filled: bool = False) -> str | None:
    """The column of a variable: raw before PI, gap-filled only where ``filled`` allows it, the shallowest first if asked."""
    found = [(p[3] if shallowest else 0, p[1], c) for c in columns if (p := parse_column(c)) and p[0] == variable and (filled or p[1] < 2)]
    return min(found)[-1] if found else None


def pick_flux(columns: list[str]) -> str | None:
    """The measured net flux: NEE, else FC; never gap-filled, which is a model."""
    return pick_column(columns, "NEE") or pick_column(columns, "FC")


def picked_columns(names: DataFrame, site: str, column: str, variable: str, shallowest: bool = False, filled: bool = False) -> DataFrame:
    """(site, column) that ``pick_column`` gives for the columns of each site."""
    part = lambda k: F.regexp_extract(column, TOWER_NAME, k)
    rank = F.when(part(3) != "", 2).when(part(2) != "", 1).otherwise(0)
    own = names.filter(F.col(column).rlike(TOWER_NAME) & (part(1) == variable) & ~F.col(column).rlike("|".join(TOWER_QUALITY)))
    own = own if filled else own.filter(rank < 2)
    order = F.struct((part(5).cast("int") if shallowest else F.lit(0)).alias("depth"), rank.alias("rank"), F.col(column).alias("name"))
    return own.groupBy(site).agg(F.min_by(column, order).alias(column))
