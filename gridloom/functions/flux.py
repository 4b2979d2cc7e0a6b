"""Flux algebra on columns. All are built-in expressions, so they stay inside generated code.

Positive is a source to the atmosphere. Spark is ANSI here: ratios guard their divisors.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

from gridloom.schema import GC_PER_MOL, GC_PER_MOL_PIPELINE, LAND, SENTINEL


def kg_to_g(x: Column) -> Column:
    return x * 1e3


def gpp(npp: Column) -> Column:
    return -2 * npp


def rtot(npp: Column, rh: Column) -> Column:
    return rh + npp


def nee(npp: Column, rh: Column) -> Column:
    return clean(rh) - clean(npp)


def nbe(npp: Column, rh: Column, fire: Column, fuel: Column) -> Column:
    return nee(npp, rh) + clean(fire) + clean(fuel)


def gc_to_mol(x: Column, gc_per_mol: float = GC_PER_MOL_PIPELINE) -> Column:
    return x / gc_per_mol


def mol_to_gc(x: Column, gc_per_mol: float = GC_PER_MOL) -> Column:
    return clean(x) * gc_per_mol


def to_null(x: Column) -> Column:
    """NaN and sentinels to NULL: what a scan does."""
    return F.when(F.isnan(x) | (F.abs(x) > SENTINEL), None).otherwise(x)


def clean(x: Column) -> Column:
    """Missing, NaN, infinite and sentinel values to 0: what a sum takes."""
    return F.coalesce(F.when(~F.isnan(x) & (F.abs(x) <= SENTINEL), x), F.lit(0.0))


def active(npp_max: Column, rh_max: Column) -> Column:
    """Whether a cell is fitted; others keep zero coefficients (they are not dropped)."""
    return ~((npp_max < LAND) & (rh_max < LAND))


def land(npp_max: Column) -> Column:
    return npp_max > LAND


def q10_factor(t: Column, base: float = 1.5, ref: float = 273.15) -> Column:
    return F.pow(F.lit(base), (t - ref) / 10)


def lloyd_taylor(t: Column, e0: float = 308.56, t0: float = 227.13) -> Column:
    return F.exp(-e0 / (F.greatest(t, F.lit(t0 + 0.1)) - t0))


def diurnal_flux(driver: Column, mean: Column, mean_driver: Column, qmod: Column) -> Column:
    """The month's mean spread by the driver, with its flat mean swapped for the fitted shape."""
    return driver * mean / mean_driver - mean + qmod


def guarded_mean(driver_mean: Column) -> Column:
    """A driver mean that can divide: dark months get a tiny value."""
    return F.when(driver_mean == 0, 1e-16).otherwise(driver_mean)


def polar_clip(flux: Column, driver: Column) -> Column:
    return F.when(driver == 0, 0.0).otherwise(flux)


def atmc_removal(mode: str, atmc: Column, driver: Column | None = None, mean_driver: Column | None = None) -> Column:
    if mode == "flat":
        return atmc
    if mode == "q10":
        if driver is None or mean_driver is None:
            raise ValueError("q10 removal needs a driver and its mean")
        return atmc * driver / mean_driver
    raise ValueError(f"unknown removal mode {mode!r}")


def evaluate(a: Column, b: Column, c: Column, dt: Column) -> Column:
    return a * dt * dt + b * dt + c


def piece_mean(a: Column, b: Column, c: Column, h: Column) -> Column:
    return a * h * h / 3 + b * h / 2 + c


def vertex(a: Column, b: Column, c: Column, h: Column) -> Column:
    """Value at the interior extremum of a piece, NULL where it has none."""
    at = F.try_divide(-b, 2 * a)
    return F.when((a != 0) & (at > 0) & (at < h), c - F.try_divide(b * b, 4 * a))


def piece_max(a: Column, b: Column, c: Column, h: Column) -> Column:
    return F.greatest(c, evaluate(a, b, c, h), vertex(a, b, c, h))


def piece_min(a: Column, b: Column, c: Column, h: Column) -> Column:
    return F.least(c, evaluate(a, b, c, h), vertex(a, b, c, h))


def piece_peak(a: Column, b: Column, c: Column, h: Column) -> Column:
    return F.greatest(F.abs(c), F.abs(evaluate(a, b, c, h)), F.abs(vertex(a, b, c, h)))


def monthly_sd(var_gpp: Column, var_resp: Column) -> Column:
    return F.sqrt(var_gpp + var_resp) / GC_PER_MOL_PIPELINE


def minmod(x: Column, y: Column) -> Column:
    return 0.5 * (F.signum(x) + F.signum(y)) * F.least(F.abs(x), F.abs(y))


def minmod3(x: Column, y: Column, z: Column) -> Column:
    same = (F.signum(x) == F.signum(y)) & (F.signum(x) == F.signum(z))
    return F.when(same, F.signum(x) * F.least(F.abs(x), F.abs(y), F.abs(z))).otherwise(0.0)


def solar_noon(lon: Column) -> Column:
    """UTC hour of local solar noon."""
    return F.pmod(12 - lon / 15, F.lit(24.0))


def hours_apart(x: Column, y: Column) -> Column:
    d = F.abs(x - y)
    return F.least(d, 24 - d)


def signed_shift(x: Column, y: Column) -> Column:
    """y - x on the circle of 24 hours, from -12."""
    return F.pmod(y - x + 12, F.lit(24)) - 12


def night_id(ts: Column) -> Column:
    return F.date_format(ts - F.expr("INTERVAL 12 HOURS"), "yyyyMMdd")


def season(month: Column) -> Column:
    return F.when(month.isin(12, 1, 2), "DJF").when(month.isin(3, 4, 5), "MAM").when(month.isin(6, 7, 8), "JJA").otherwise("SON")


def night(sw: Column, ustar: Column, flux: Column) -> Column:
    return (sw < 20) & (ustar > 0.2) & (flux > 0)


def crude_global(mean: Column, earth_area: float = 4 * math.pi * 6378137.0**2, seconds: float = 365.25 * 86400) -> Column:
    """Pg a year from an unweighted mean flux per square metre and second."""
    return mean * earth_area * seconds / 1e15


def decimal_year(ts: Column) -> Column:
    year = F.year(ts)
    days = F.when(((year % 4 == 0) & (year % 100 != 0)) | (year % 400 == 0), 366).otherwise(365)
    seconds = F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)
    return year + (F.dayofyear(ts) - 1 + seconds / 86400.0) / days


def nan_to_zero(x: Column) -> Column:
    return F.coalesce(F.when(~F.isnan(x), x), F.lit(0.0))
