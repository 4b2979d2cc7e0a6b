"""Hourly redistribution of monthly fluxes under exact mass rules.

meteo (cell, ym, ts, driver columns) is joined with the month's means and fit on (cell, ym); one window over the
same keys gives driver means and the renormalisation, so a plan has one shuffle of the hourly table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from gridloom.functions import flux
from gridloom.plans.fits import month_mean_fit

#: Respiration responses by name.
RESPONSES: dict[str, Callable[[Column], Column]] = {"q10": flux.q10_factor, "lt": flux.lloyd_taylor}
#: Temperature columns by driver name.
DRIVERS = {"air": "t2m", "soil": "stl1"}


def response(driver: str = "air", function: str = "q10") -> Column:
    if driver not in DRIVERS:
        raise ValueError(f"no driver {driver!r}; there are {', '.join(DRIVERS)}")
    if function not in RESPONSES:
        raise ValueError(f"no response {function!r}; there are {', '.join(RESPONSES)}")
    return RESPONSES[function](F.col(DRIVERS[driver]))


def monthly_or_climatology(months: DataFrame, monthly: DataFrame, clim: DataFrame, values: tuple[str, ...]) -> DataFrame:
    """Each month's values, from the climatology of its calendar month where it has none, with a flag."""
    left = months.withColumn("month", F.col("ym") % 12).join(monthly.withColumn("_own", F.lit(True)), ["cell", "ym"], "left")
    right = clim.select("cell", "month", *(F.col(v).alias(f"_{v}") for v in values))
    return left.join(right, ["cell", "month"], "left").select("cell", "ym", *(F.when(F.col("_own"), F.col(v)).otherwise(F.col(f"_{v}")).alias(v) for v in values), F.col("_own").isNull().alias("flux_from_climatology"))


def fit_or_month_mean(months: DataFrame, fitted: DataFrame, strict: bool = False) -> DataFrame:
    """Each month's coefficients, else the mean ones of its calendar month; strict refuses the latter."""
    means = month_mean_fit(fitted).select("cell", "month", *(F.col(x).alias(f"_{x}") for x in "abc"))
    own = fitted.select("cell", "ym", *"abc", F.lit(True).alias("_own"))
    out = months.withColumn("month", F.col("ym") % 12).join(own, ["cell", "ym"], "left").join(means, ["cell", "month"], "left")
    if strict:
        out = out.withColumn("_own", F.coalesce("_own", F.raise_error(F.lit("a month has no fit")).cast("boolean")))
    pick = lambda x: F.when(F.col("_own"), F.col(x)).otherwise(F.col(f"_{x}")).alias(x)
    return out.select(*[c for c in months.columns], *(pick(x) for x in "abc"), F.col("_own").isNull().alias("fit_from_climatology"))


def elapsed(dt_origin: str = "first_slot") -> Column:
    """Time since the origin of the month's piece, in days: its first slot that is there, or the month's start."""
    month = W.partitionBy("cell", "ym")
    t = F.unix_timestamp(F.col("ts").cast("timestamp"))
    if dt_origin == "first_slot":
        return (t - F.min(t).over(month)) / 86400.0
    if dt_origin == "month_start":
        return t / 86400.0 - F.col("t0")
    raise ValueError(f"no origin {dt_origin!r}")


def diurnalize(hours: DataFrame, monthly: DataFrame, fit_gpp: DataFrame, fit_resp: DataFrame, driver: str = "air", function: str = "q10", clip: str = "conserve", atmc: str | None = None, dt_origin: str = "first_slot") -> DataFrame:
    """Hourly gpp, resp and nee. hours: cell, ym, t0, ts, ssrd and temperatures; monthly: cell, ym, gpp_mn, resp_mn[, atmc_mn].

    clip 'conserve' spreads what dark hours lose over the month's lit hours; 'plain' only zeroes them.
    """
    return spread(with_month(hours, monthly, fit_gpp, fit_resp), driver, function, clip, atmc, dt_origin)


def with_month(df: DataFrame, monthly: DataFrame, fit_gpp: DataFrame, fit_resp: DataFrame) -> DataFrame:
    """Hours, or the months that they will be made of, with the month's means and both fits."""
    co = lambda fit, p: fit.select("cell", "ym", *(F.col(x).alias(f"{p}_{x}") for x in "abc"))
    return df.join(monthly, ["cell", "ym"]).join(co(fit_gpp, "g"), ["cell", "ym"]).join(co(fit_resp, "r"), ["cell", "ym"])


def spread(df: DataFrame, driver: str = "air", function: str = "q10", clip: str = "conserve", atmc: str | None = None, dt_origin: str = "first_slot") -> DataFrame:
    """As ``diurnalize``, of hours that have their month's means and fits: windows only, so hours made of months that
    were dealt by cell are not dealt again."""
    month = W.partitionBy("cell", "ym")
    df = df.withColumn("dt", elapsed(dt_origin)).withColumn("w", response(driver, function))
    df = df.withColumn("w_mn", F.avg("w").over(month)).withColumn("ssr_mn", flux.guarded_mean(F.avg("ssrd").over(month)))
    q = lambda p: flux.evaluate(F.col(f"{p}_a"), F.col(f"{p}_b"), F.col(f"{p}_c"), F.col("dt"))
    df = df.withColumn("qgpp", q("g")).withColumn("qresp", q("r"))
    df = df.withColumn("gpp", flux.polar_clip(flux.diurnal_flux(F.col("ssrd"), F.col("gpp_mn"), F.col("ssr_mn"), F.col("qgpp")), F.col("ssrd")))
    df = df.withColumn("resp", flux.diurnal_flux(F.col("w"), F.col("resp_mn"), F.col("w_mn"), F.col("qresp")))
    if atmc:
        df = df.withColumn("removed", flux.atmc_removal(atmc, F.col("atmc_mn"), F.col("w"), F.col("w_mn"))).withColumn("resp", F.col("resp") - F.col("removed"))
    if clip == "conserve":
        df = df.withColumn("gpp", renormalised("gpp", "gpp_mn", month))
    elif clip != "plain":
        raise ValueError(f"no clip mode {clip!r}")
    return df.withColumn("nee", flux.nan_to_zero(F.col("gpp") + F.col("resp")))


def renormalised(value: str, mean: str, month) -> Column:
    """Scale to the month's mean where there is something of the right sign to scale."""
    total, wanted = F.sum(value).over(month), F.col(mean) * F.count("*").over(month)
    scale = F.try_divide(wanted, F.nullif(total, F.lit(0.0)))
    return F.col(value) * F.when(scale.isNull() | F.isnan(scale) | (F.signum(total) != F.signum(wanted)), 1.0).otherwise(scale)


def mean_gate(hourly: DataFrame, value: str, mean: str, tolerance: float = 1e-12) -> DataFrame:
    """By month: the error of the hourly mean against the given one, and whether it passes."""
    g = hourly.groupBy("cell", "ym").agg(F.avg(value).alias("mean"), F.first(mean).alias("wanted"), F.max(F.abs(value)).alias("scale"))
    return g.select("cell", "ym", F.abs(F.col("mean") - F.col("wanted")).alias("error"), (F.abs(F.col("mean") - F.col("wanted")) <= tolerance * F.col("scale")).alias("ok"))


def gated(hourly: DataFrame, value: str, mean: str, tolerance: float = 1e-12) -> DataFrame:
    """``hourly`` itself, or an error once it is computed: no month may miss the mean it was given."""
    month = W.partitionBy("cell", "ym")
    error, scale = F.abs(F.avg(value).over(month) - F.col(mean)), F.max(F.abs(value)).over(month)
    refuse = F.raise_error(F.format_string("month %d of cell %s misses its mean", F.col("ym"), F.col("cell").cast("string")))
    return hourly.withColumn(value, F.when(error > tolerance * scale, refuse.cast("double")).otherwise(F.col(value)))


def sign_flips(hourly: DataFrame, value: str, sign: int) -> DataFrame:
    """Cells with any hour of the wrong sign, and such hours, with denominators; by month."""
    wrong = F.col(value) * sign < 0
    by_cell = hourly.groupBy("ym", "cell").agg(F.bool_or(wrong).alias("any"), F.count_if(wrong).alias("flips"), F.count(value).alias("n"))
    return by_cell.groupBy("ym").agg(F.count_if("any").alias("cells_flipped"), F.count("*").alias("cells"), F.sum("flips").alias("hours_flipped"), F.sum("n").alias("hours"))


def negativity(df: DataFrame, value: str, keys: tuple[str, ...] = ()) -> DataFrame:
    """How often and how far a delivered field is below 0."""
    x = F.when(~F.isnan(value), F.col(value))
    g = df.groupBy(*keys).agg(F.count_if(x < 0).alias("n"), F.count(x).alias("total"), F.coalesce(F.min(F.when(x < 0, x)), F.lit(0.0)).alias("worst"), F.coalesce(F.max(F.abs(x)), F.lit(0.0)).alias("scale"))
    return g.withColumn("frac", F.coalesce(F.try_divide("n", "total"), F.lit(0.0))).withColumn("worst_frac", F.coalesce(F.try_divide(F.abs("worst"), "scale"), F.lit(0.0)))
