"""The registry of fits, and fits made of others."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from gridloom.functions.flux import evaluate, piece_max, piece_min
from gridloom.operators.series import month_mean, with_knots
from gridloom.operators.windows import by_cell, envelope
from gridloom.plans.kernels import KERNELS, fit as kernel_fit
from gridloom.plans.window_fits import FITS, limited_linear

NAMES = (*FITS, *KERNELS, "hybrid")


def fit(series: DataFrame, name: str) -> DataFrame:
    """cell, ym, t0, h, u -> with a, b, c."""
    if name in FITS:
        return FITS[name](series)
    if name in KERNELS:
        return kernel_fit(series, name)
    if name == "hybrid":
        return hybrid(series)
    raise ValueError(f"no fit named {name!r}; there are {', '.join(NAMES)}")


def hybrid(series: DataFrame, sign: float | None = None) -> DataFrame:
    """The integral quadratic spline, with the limited line where a piece has the wrong sign."""
    own = F.when(F.avg("u").over(W.partitionBy("cell")) < 0, -1.0).otherwise(1.0) if sign is None else F.lit(sign)
    smooth = kernel_fit(series, "piqs").withColumn("_sign", own).withColumn("_env", envelope(F.col("u"), by_cell()))
    line = limited_linear(series.select("cell", "ym", "t0", "h", "u")).select("cell", "ym", F.col("b").alias("_b"), F.col("c").alias("_c"))
    a, b, c, h = (F.col(x) for x in "abch")
    wrong = F.when(F.col("_sign") > 0, piece_min(a, b, c, h)).otherwise(-piece_max(a, b, c, h)) < -1e-9 * F.col("_env")
    both = smooth.join(line, ["cell", "ym"]).withColumn("patched", wrong)
    return both.select("cell", "ym", "t0", "h", "u", F.when(wrong, 0.0).otherwise(a).alias("a"), F.when(wrong, F.col("_b")).otherwise(b).alias("b"), F.when(wrong, F.col("_c")).otherwise(c).alias("c"), "patched")


def padded_fit(series: DataFrame, name: str, left: int = 12, right: int = 12) -> DataFrame:
    """Fit with the ends padded by each month's climatology, the padding taken off again."""
    bounds = series.groupBy("cell").agg(F.min("ym").alias("lo"), F.max("ym").alias("hi"))
    clim = month_mean(series.select("cell", "ym", "u")).select("cell", "month", "u")
    pads = bounds.select("cell", F.explode(F.concat(F.sequence(F.col("lo") - left, F.col("lo") - 1), F.sequence(F.col("hi") + 1, F.col("hi") + right))).alias("ym")).withColumn("month", F.col("ym") % 12)
    pads = with_knots(pads.join(clim, ["cell", "month"]).select("cell", "ym", "u"))
    whole = series.select("cell", "ym", "u", "t0", "h").withColumn("pad", F.lit(False)).unionByName(pads.withColumn("pad", F.lit(True)))
    fitted = fit(whole.drop("pad"), name)
    return fitted.join(bounds, "cell").filter(F.col("ym").between(F.col("lo"), F.col("hi"))).drop("lo", "hi")


def month_mean_fit(fitted: DataFrame) -> DataFrame:
    """Mean coefficients of each calendar month: what stands in for a month without a fit."""
    return fitted.groupBy("cell", (F.col("ym") % 12).alias("month")).agg(*(F.avg(x).alias(x) for x in "abc"))


def refit_climatology(clim: DataFrame, first: int, last: int, name: str = "pchip") -> DataFrame:
    """Fit of a climatology repeated over a span, so that a month's fit is the same in every year inside."""
    from gridloom.operators.series import replicate

    return fit(with_knots(replicate(clim, first, last).select("cell", "ym", "u")), name)


def daily(fitted: DataFrame) -> DataFrame:
    """Values at the middle of every day: cell, ym, day, value."""
    days = fitted.select("*", F.explode(F.sequence(F.lit(1), F.col("h").cast("int"))).alias("day"))
    return days.select("cell", "ym", "day", "u", evaluate(F.col("a"), F.col("b"), F.col("c"), F.col("day") - 0.5).alias("value"))


def order_of_averaging(fine: DataFrame, name: str, group: str) -> DataFrame:
    """Fit fine cells then average, against average then fit: (group, ym, a/b/c of both). fine: cell, group, ym, t0, h, u."""
    first = fit(fine.select("cell", "ym", "t0", "h", "u"), name).join(fine.select("cell", group).distinct(), "cell")
    first = first.groupBy(group, "ym").agg(*(F.avg(x).alias(f"{x}_fit_first") for x in "abc"))
    mean = fine.groupBy(F.col(group).alias("cell"), "ym").agg(F.first("t0").alias("t0"), F.first("h").alias("h"), F.avg("u").alias("u"))
    second = fit(mean, name).select(F.col("cell").alias(group), "ym", *(F.col(x).alias(f"{x}_mean_first") for x in "abc"))
    return first.join(second, [group, "ym"])
