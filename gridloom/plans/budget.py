"""Budgets: integrals over area and time, band summaries, trends and anomalies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from gridloom.functions.flux import clean
from gridloom.functions.grid import BANDS, in_band


def pgc(value: Column, area: Column, seconds: Column) -> Column:
    """An aggregate: Pg from grams per square metre and second."""
    return F.sum(clean(value) * area) * seconds / 1e15


def band_summary(df: DataFrame, values: tuple[str, ...], lat: str = "lat", area: str = "area_m2", scale: float = 1.0) -> DataFrame:
    """One row a month: every value summed over the whole grid and each (overlapping) band, in one aggregation."""
    sums = [F.sum(F.when(in_band(F.col(lat), band), clean(F.col(v)) * F.col(area))) * scale for v in values for band in BANDS]
    names = [f"{v}_{band}" for v in values for band in BANDS]
    return df.groupBy("ym").agg(*(F.coalesce(s, F.lit(0.0)).alias(n) for s, n in zip(sums, names)))


def rollup(df: DataFrame, keys: tuple[str, ...], value: str) -> DataFrame:
    """Sums by keys, by their prefixes, and over all."""
    return df.rollup(*keys).agg(F.sum(value).alias(value), F.count("*").alias("n"))


def annual(df: DataFrame, value: str, keys: tuple[str, ...] = ()) -> DataFrame:
    """Sums of complete years."""
    return df.groupBy(*keys, F.floor(F.col("ym") / 12).cast("int").alias("year")).agg(F.sum(value).alias(value), F.count("*").alias("n")).filter("n >= 12").drop("n")


def year_on_year(df: DataFrame, value: str, keys: tuple[str, ...] = ()) -> DataFrame:
    w = W.partitionBy(*keys).orderBy("year")
    last = F.lag(value).over(w)
    return df.withColumn("pct", 100 * F.try_divide(F.col(value) - last, last))


def seasonality(df: DataFrame, value: str, keys: tuple[str, ...] = (), years: int = 5) -> DataFrame:
    """Amplitude and months of the extremes of the mean year over the last full years."""
    year = F.floor(F.col("ym") / 12)
    full = df.groupBy(*keys, year.alias("_y")).agg(F.count("*").alias("_n")).filter("_n >= 12")
    last = full.withColumn("_r", F.dense_rank().over(W.partitionBy(*keys).orderBy(F.desc("_y")))).filter(F.col("_r") <= years).drop("_n", "_r")
    mean = df.withColumn("_y", year).join(last, [*keys, "_y"]).groupBy(*keys, (F.col("ym") % 12 + 1).alias("month")).agg(F.avg(value).alias("m"))
    return mean.groupBy(*keys).agg((F.max("m") - F.min("m")).alias("amplitude"), F.max_by("month", F.struct("m", -F.col("month"))).alias("peak_month"), F.min_by("month", F.struct("m", "month")).alias("low_month"))


def month_cov(df: DataFrame, value: str, keys: tuple[str, ...] = ()) -> DataFrame:
    """Coefficient of variation of each calendar month between years; none where the mean is 0."""
    return df.groupBy(*keys, (F.col("ym") % 12 + 1).alias("month")).agg(F.try_divide(F.stddev_samp(value), F.nullif(F.abs(F.avg(value)), F.lit(0.0))).alias("cov"))


def trend(df: DataFrame, y: str, x: str = "year", keys: tuple[str, ...] = ()) -> DataFrame:
    return df.groupBy(*keys).agg(F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"), F.regr_r2(y, x).alias("r2"))


def q10_of(df: DataFrame, log_flux: str, temperature: str, keys: tuple[str, ...] = ()) -> DataFrame:
    """Apparent Q10 and R2 of log flux against temperature."""
    return df.groupBy(*keys).agg(F.exp(10 * F.regr_slope(log_flux, temperature)).alias("q10"), F.regr_r2(log_flux, temperature).alias("r2"))


def two_predictors(df: DataFrame, y: str, a: str, s: str, keys: tuple[str, ...] = ()) -> DataFrame:
    """Standardised coefficients of y on a and s, their correlation and the variance inflation, from correlations."""
    ya, ys, r = F.corr(y, a), F.corr(y, s), F.corr(a, s)
    g = df.groupBy(*keys).agg(ya.alias("ya"), ys.alias("ys"), r.alias("r"))
    free = F.nullif(1 - F.col("r") * F.col("r"), F.lit(0.0))
    return g.select(*keys, F.try_divide(F.col("ya") - F.col("r") * F.col("ys"), free).alias("beta_a"), F.try_divide(F.col("ys") - F.col("r") * F.col("ya"), free).alias("beta_s"), "r", F.try_divide(F.lit(1.0), free).alias("vif"))


def window_trends(df: DataFrame, y: str, windows: dict[str, tuple[int, int]], least: int = 4) -> DataFrame:
    """Slopes over overlapping spans of years, and whether all have one sign."""
    year = F.col("year")
    slopes = [F.when(F.count_if(year.between(*s)) >= least, F.regr_slope(F.when(year.between(*s), F.col(y)), F.when(year.between(*s), year))).alias(n) for n, s in windows.items()]
    out = df.agg(*slopes)
    signs = F.array_compact(F.array(*(F.signum(n) for n in windows)))
    return out.withColumn("consistent", F.size(F.array_distinct(signs)) == 1)


def event_anomaly(df: DataFrame, value: str, event: list[int], baseline: list[int], keys: tuple[str, ...] = ()) -> DataFrame:
    mean = lambda years: F.avg(F.when(F.col("year").isin(years), F.col(value)))
    return df.groupBy(*keys).agg((mean(event) - mean(baseline)).alias("anomaly"))


def band_annual_mean(df: DataFrame, value: str, band: Column, weight: str = "coslat") -> DataFrame:
    """Mean over longitude, then latitude by weight, then months."""
    rows = df.groupBy("ym", "j", weight, band.alias("band")).agg(F.avg(value).alias("m"))
    months = rows.groupBy("ym", "band").agg(F.try_divide(F.sum(F.col("m") * F.col(weight)), F.sum(F.when(F.col("m").isNotNull(), F.col(weight)))).alias("m"))
    return months.groupBy("band", F.floor(F.col("ym") / 12).cast("int").alias("year")).agg(F.avg("m").alias(value))


def diurnal_cycle(df: DataFrame, value: str, keys: tuple[str, ...], hour: Column) -> DataFrame:
    """Mean by hour of the day."""
    return df.groupBy(*keys, hour.alias("hour")).agg(F.avg(value).alias("m"))


def diurnal_shape(cycle: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Amplitude and hour of the least value (ties to the first) of a cycle."""
    return cycle.groupBy(*keys).agg((F.max("m") - F.min("m")).alias("amplitude"), F.min_by("hour", F.struct("m", "hour")).alias("low_hour"), F.count("*").alias("bins"))


def splice_step(df: DataFrame, value: str, at: int, keys: tuple[str, ...] = ()) -> DataFrame:
    """Relative step of the monthly sum across the month where one version follows another."""
    m = df.groupBy(*keys, "ym").agg(F.sum(value).alias("s"))
    last = F.lag("s").over(W.partitionBy(*keys).orderBy("ym"))
    return m.withColumn("step", F.try_divide(F.abs(F.col("s") - last), F.nullif(F.abs(last), F.lit(0.0)))).filter(F.col("ym") == at)
