"""Cell-by-month series: scaffolds, climatologies, supersession, gap filling."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from gridloom.functions.calendar import days_in_month, month_axis, start_day


def month_mean(df: DataFrame, keys: tuple[str, ...] = ("cell",), values: tuple[str, ...] = ("u",), baseline: tuple[int, int] | None = None) -> DataFrame:
    """Mean for each calendar month (0..11), missing values left out; baseline: first and last year, inclusive.

    Every key gets all twelve months; one with no sample is NULL. A baseline that holds no year is refused.
    """
    use = df
    if baseline:
        use = df.filter(F.floor(F.col("ym") / 12).between(*baseline))
        if use.limit(1).count() == 0:
            raise ValueError(f"no year of the series lies in {baseline}")
    means = use.groupBy(*keys, (F.col("ym") % 12).alias("month")).agg(*(F.avg(v).alias(v) for v in values), F.count("*").alias("n"))
    months = df.sparkSession.range(12).select(F.col("id").cast("int").alias("month"))
    frame = df.select(*keys).distinct().crossJoin(F.broadcast(months))  # twelve rows
    return frame.join(means, [*keys, "month"], "left").withColumn("n", F.coalesce("n", F.lit(0)))


def doy_mean(df: DataFrame, keys: tuple[str, ...] = ("cell",), value: str = "v", filled: str = "is_clim") -> DataFrame:
    """Mean for each day of the year from real inputs only; refuses a table without any."""
    real = df.filter(~F.col(filled))
    if real.limit(1).count() == 0:
        raise ValueError("no input that is not itself a climatology")
    return real.groupBy(*keys, "month", "day").agg(F.avg(value).alias(value))


def scaffold(df: DataFrame, key: str = "cell") -> DataFrame:
    """Every key with every month from the first to the last of the whole table."""
    return df.select(key).distinct().crossJoin(F.broadcast(month_axis(df)))  # months of the record: hundreds


def missing(df: DataFrame, key: str = "cell") -> DataFrame:
    """Key months of the scaffold that ``df`` lacks."""
    return scaffold(df, key).join(df, [key, "ym"], "left_anti")


def filled(df: DataFrame, key: str = "cell", values: tuple[str, ...] = ("u", "v")) -> DataFrame:
    """The series on its scaffold, gaps taken from the month's climatology, with a flag. (key, ym) is unique.

    A key's months meet in one row (bounded by the record), are laid on the calendar there, and stay partitioned by
    key for the climatology's window and for what follows: no join, and one scan beside that of the record's ends.
    """
    held = df.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("ym", F.struct(*values).alias("v")))).alias("_held"))
    ends = df.agg(F.min("ym").alias("_lo"), F.max("ym").alias("_hi"))
    laid = F.transform(F.sequence("_lo", "_hi"), lambda m: F.struct(m.alias("ym"), F.try_element_at("_held", m).alias("v")))
    rows = held.crossJoin(F.broadcast(ends)).select(key, F.inline(laid))  # one row
    month = W.partitionBy(key, F.col("ym") % 12)
    return rows.select(key, "ym", *(F.coalesce(F.col("v")[x], F.avg(F.col("v")[x]).over(month)).alias(x) for x in values), F.col("v").isNull().alias("from_clim"))


def with_knots(series: DataFrame) -> DataFrame:
    """Add each piece's start (days since 1970) and width (days)."""
    return series.withColumn("t0", start_day(F.col("ym")).cast("double")).withColumn("h", days_in_month(F.col("ym")).cast("double"))


def supersede(df: DataFrame, keys: tuple[str, ...], priority: str) -> DataFrame:
    """The row of least priority number for each key: earlier versions always win."""
    w = W.partitionBy(*keys).orderBy(priority)
    return df.withColumn("_rank", F.row_number().over(w)).filter("_rank = 1").drop("_rank")


def replicate(clim: DataFrame, first: int, last: int) -> DataFrame:
    """A climatology repeated over a span of months; knows 'month' (0..11)."""
    span = clim.sparkSession.range(first, last + 1).select(F.col("id").cast("int").alias("ym"))
    return clim.join(F.broadcast(span), F.col("month") == F.col("ym") % 12)  # months of a span


def impose(series: DataFrame, imposed: DataFrame, keys: tuple[str, ...], values: tuple[str, ...]) -> DataFrame:
    """Variables carried over unchanged from another table, flagged where they were found."""
    right = imposed.select(*keys, *values, F.lit(True).alias("_found"))
    return series.join(right, list(keys), "left").withColumn("imposed", F.coalesce("_found", F.lit(False))).drop("_found")


def partial_months(df: DataFrame, keys: tuple[str, ...] = ("cell", "ym"), day: str = "day") -> DataFrame:
    """Days present by month, and whether some are missing (provisional)."""
    return df.groupBy(*keys).agg(F.countDistinct(day).alias("n_days")).withColumn("provisional", F.col("n_days") < days_in_month(F.col("ym")))


def resolve_source(df: DataFrame, keys: tuple[str, ...], source: str, priority: str, variable: str, needed: int) -> DataFrame:
    """For each key the first source, by priority, that holds all variables; NULL where none does."""
    held = df.groupBy(*keys, source, priority).agg(F.countDistinct(variable).alias("n"))
    best = held.filter(F.col("n") >= needed).groupBy(*keys).agg(F.min_by(source, F.struct(priority, source)).alias("resolved"))
    return df.select(*keys).distinct().join(best, list(keys), "left")


def runs(df: DataFrame, keys: tuple[str, ...], day: str, label: str) -> DataFrame:
    """Run-length text of labels over days: 'a:1-30 b:31'. One window by key; gaps and islands."""
    order = W.partitionBy(*keys).orderBy(day)
    within = W.partitionBy(*keys, label).orderBy(day)
    marked = df.withColumn("_island", F.col(day) - F.row_number().over(within)).withColumn("_n", F.row_number().over(order))
    island = marked.groupBy(*keys, label, "_island").agg(F.min(day).alias("first"), F.max(day).alias("last"))
    said = F.when(F.col("first") == F.col("last"), F.format_string("%s:%d", label, "first")).otherwise(F.format_string("%s:%d-%d", label, "first", "last"))
    return island.groupBy(*keys).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("first", said.alias("s")))), lambda x: x["s"]), " ").alias("runs"))
