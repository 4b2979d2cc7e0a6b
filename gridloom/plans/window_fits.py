"""Mean-preserving fits that need neighbours only: windows over each cell in time order.

Input rows: cell, ym, t0, h, u (start, width and mean of a piece). Output adds a, b, c with
f(t) = a (t - t0)^2 + b (t - t0) + c, whose mean over the piece is u. No Python runs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from gridloom.functions.flux import minmod, minmod3
from gridloom.operators.windows import after, before, by_cell


def _coefficients(df: DataFrame, a: Column, b: Column, c: Column) -> DataFrame:
    """Set a, b, c; a cell that is zero throughout keeps zeros."""
    silent = F.max(F.abs("u")).over(W.partitionBy("cell")) == 0
    drop = [x for x in df.columns if x.startswith("_")]
    return df.select("*", *(F.when(silent, 0.0).otherwise(x).alias(n) for n, x in (("a", a), ("b", b), ("c", c)))).drop(*drop)


def constant(df: DataFrame) -> DataFrame:
    return _coefficients(df, F.lit(0.0), F.lit(0.0), F.col("u"))


def van_leer(x: Column, y: Column) -> Column:
    return F.when(x * y > 0, F.try_divide(2 * x * y, x + y)).otherwise(0.0)


def monotonized_central(x: Column, y: Column) -> Column:
    return minmod3((x + y) / 2, 2 * x, 2 * y)


def superbee(x: Column, y: Column) -> Column:
    first, second = minmod(2 * x, y), minmod(x, 2 * y)
    return F.when(F.abs(first) > F.abs(second), first).otherwise(second)


def limited_linear(df: DataFrame, limiter: Callable[[Column, Column], Column] = minmod) -> DataFrame:
    """A line through each mean at the piece's centre; its slope is the limiter of the two secants, 0 at the ends."""
    w = by_cell()
    centre = F.col("t0") + F.col("h") / 2
    df = df.withColumn("_left", F.try_divide(F.col("u") - F.lag("u").over(w), centre - F.lag(centre).over(w)))
    df = df.withColumn("_right", F.lead("_left").over(w))
    slope = F.coalesce(limiter(F.col("_left"), F.col("_right")), F.lit(0.0))
    slope = F.when(F.col("_left").isNull() | F.col("_right").isNull(), 0.0).otherwise(slope)
    return _coefficients(df, F.lit(0.0), slope, F.col("u") - slope * F.col("h") / 2)


def _edges(df: DataFrame) -> DataFrame:
    """Left and right edge values of each piece from limited differences; the record's first and last are flat."""
    w = by_cell()
    u = F.col("u")
    df = df.withColumn("_lo", before(u, w)).withColumn("_hi", after(u, w)).withColumn("_end", F.lag("u").over(w).isNull() | F.lead("u").over(w).isNull())
    df = df.withColumn("_dm", minmod3((F.col("_hi") - F.col("_lo")) / 2, 2 * (u - F.col("_lo")), 2 * (F.col("_hi") - u)))
    df = df.withColumn("_edge", u + (F.col("_hi") - u) / 2 - (after(F.col("_dm"), w) - F.col("_dm")) / 6)
    df = df.withColumn("_l", F.when(F.col("_end"), u).otherwise(F.lag("_edge").over(w)))
    return df.withColumn("_r", F.when(F.col("_end"), u).otherwise(F.col("_edge")))


def _parabola(df: DataFrame, left: Column, right: Column) -> DataFrame:
    bend = 6 * (F.col("u") - (left + right) / 2)
    return _coefficients(df, -bend / (F.col("h") * F.col("h")), (right - left + bend) / F.col("h"), left)


def parabola(df: DataFrame) -> DataFrame:
    """The parabola of the edges, with no limiter."""
    df = _edges(df)
    return _parabola(df, F.col("_l"), F.col("_r"))


def limited_parabola(df: DataFrame) -> DataFrame:
    """PPM: flat at extrema, and the far edge moved where the parabola would overshoot."""
    df = _edges(df)
    u, left, right = F.col("u"), F.col("_l"), F.col("_r")
    df = df.withColumn("_flat", (right - u) * (u - left) <= 0)
    df = df.withColumn("_dd", right - left).withColumn("_off", u - (left + right) / 2)
    over, limit = F.col("_dd") * F.col("_off"), F.col("_dd") * F.col("_dd") / 6
    new_left = F.when(F.col("_flat"), u).when(over > limit, 3 * u - 2 * right).otherwise(left)
    new_right = F.when(F.col("_flat"), u).when(-limit > over, 3 * u - 2 * left).otherwise(right)
    df = df.withColumn("_nl", new_left).withColumn("_nr", new_right)
    return _parabola(df, F.col("_nl"), F.col("_nr"))


def _hermite(df: DataFrame, left: Column, right: Column, sign: Column) -> DataFrame:
    """Derivative of a cubic on the cumulative integral with slopes ``left`` and ``right`` at its knots."""
    u = sign * F.col("u")
    q, line = -6 * u + 3 * left + 3 * right, 6 * u - 4 * left - 2 * right
    return _coefficients(df, sign * q / (F.col("h") * F.col("h")), sign * line / F.col("h"), sign * left)


def steffen(df: DataFrame) -> DataFrame:
    """Steffen's monotone slopes on the cumulative integral."""
    w = by_cell()
    sign = F.when(F.avg("u").over(W.partitionBy("cell")) < 0, -1.0).otherwise(1.0)
    df = df.withColumn("_sign", sign).withColumn("_s", F.col("_sign") * F.col("u")).withColumn("_s0", F.lag("_s").over(w)).withColumn("_h0", F.lag("h").over(w))
    p = (F.col("_s0") * F.col("h") + F.col("_s") * F.col("_h0")) / (F.col("_h0") + F.col("h"))
    inner = (F.signum("_s0") + F.signum("_s")) * F.least(F.abs("_s0"), F.abs("_s"), 0.5 * F.abs(p))
    df = df.withColumn("_m", F.coalesce(inner, F.col("_s")))
    df = df.withColumn("_m1", F.coalesce(F.lead("_m").over(w), F.col("_s")))
    return _hermite(df, F.col("_m"), F.col("_m1"), F.col("_sign"))


def trapezoid(df: DataFrame) -> DataFrame:
    """The continuous line through knots y with y' = 2 u - y: an alternating running sum, unstable by nature."""
    w = by_cell()
    df = df.withColumn("_k", F.row_number().over(w) - 1)
    sign = F.when(F.col("_k") % 2 == 0, 1.0).otherwise(-1.0)
    first = F.first("u").over(w)
    run = F.coalesce(F.sum(sign * F.col("u")).over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0))
    df = df.withColumn("_y", sign * (first - 2 * run))
    return _coefficients(df, F.lit(0.0), (2 * F.col("u") - 2 * F.col("_y")) / F.col("h"), F.col("_y"))


FITS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "constant": constant, "minmod": limited_linear, "van_leer": lambda d: limited_linear(d, van_leer), "mc": lambda d: limited_linear(d, monotonized_central),
    "superbee": lambda d: limited_linear(d, superbee), "parabola": parabola, "ppm": limited_parabola, "steffen": steffen, "trapezoid": trapezoid,
}
