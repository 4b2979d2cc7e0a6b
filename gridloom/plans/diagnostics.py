"""Diagnostics of fits and products: overshoot, smoothness, revision footprint, fidelity, bootstrap."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from gridloom.functions.flux import evaluate, piece_max, piece_mean, piece_min, piece_peak, signed_shift
from gridloom.operators.quantiles import exact_quantiles
from gridloom.operators.windows import by_cell, envelope, weighted_quantile
from gridloom.plans.fits import daily, fit
from gridloom.plans.kernels import all_kriging_weights, by_whole_cells, cells_of, kriged

#: An extremum so near to a piece's end, as a share of its width, lies on it: limiters put them there.
EDGE = 1e-9


def residual(fitted: DataFrame, last: bool = False) -> DataFrame:
    """|piece mean - u| over |u|; the last piece is left out unless asked for."""
    w = by_cell()
    out = fitted.withColumn("rel", F.try_divide(F.abs(piece_mean(F.col("a"), F.col("b"), F.col("c"), F.col("h")) - F.col("u")), F.nullif(F.abs(F.col("u")), F.lit(0.0)))).withColumn("_last", F.lead("ym").over(w).isNull())
    return (out if last else out.filter("NOT _last")).drop("_last")


def overshoot(fitted: DataFrame, least: float = 1e-12) -> DataFrame:
    """Peak of each piece over the envelope of the means around it."""
    env = envelope(F.col("u"), by_cell())
    return fitted.withColumn("env", env).withColumn("ratio", F.when(F.col("env") > least, piece_peak(F.col("a"), F.col("b"), F.col("c"), F.col("h")) / F.col("env")))


def overshoot_summary(fitted: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    r = F.col("ratio")
    share = lambda x: F.avg(F.when(r.isNotNull(), (r > x).cast("double")))
    ratios, probs = overshoot(fitted), {f"p{round(100 * p)}": p for p in (0.5, 0.95, 0.99)}
    rest = F.max("ratio").alias("max"), share(1.0 + 1e-9).alias("over_1"), share(1.2).alias("over_12"), share(1.5).alias("over_15")
    if "cell" in keys:  # a cell's pieces are bounded by the months there are
        return ratios.groupBy(*keys).agg(*(F.percentile("ratio", p).alias(name) for name, p in probs.items()), *rest)
    return exact_quantiles(ratios, "ratio", probs, keys, also=rest)


def joints(fitted: DataFrame) -> DataFrame:
    """Jumps of value and slope at each piece's right end, curvature, and whether it turns inside."""
    w = by_cell()
    turn = F.try_divide(-F.col("b"), 2 * F.col("a"))
    return overshoot(fitted).select(
        *fitted.columns, "env", F.abs(evaluate(F.col("a"), F.col("b"), F.col("c"), F.col("h")) - F.lead(F.col("c")).over(w)).alias("jump"), F.abs(2 * F.col("a") * F.col("h") + F.col("b") - F.lead(F.col("b")).over(w)).alias("slope_jump"), F.abs(2 * F.col("a") * F.col("h") * F.col("h")).alias("curvature"),
        F.coalesce((F.col("a") != 0) & (turn > EDGE * F.col("h")) & (turn < (1 - EDGE) * F.col("h")), F.lit(False)).alias("turns"), "ratio",
    )


def scores(series: DataFrame, names: tuple[str, ...]) -> DataFrame:
    """One row for each fit: overshoot, jumps, gradients, interior extrema."""
    every = None
    for name in names:
        one = joints(fit(series, name).select("cell", "ym", "t0", "h", "u", "a", "b", "c")).withColumn("fitter", F.lit(name))
        every = one if every is None else every.unionByName(one)
    rel = F.try_divide("jump", F.nullif(F.col("env"), F.lit(0.0)))
    rest = (
        F.max("ratio").alias("max_overshoot"), F.avg(F.when(F.col("ratio").isNotNull(), (F.col("ratio") > 1 + 1e-9).cast("double"))).alias("share_over"),
        F.avg(F.when(rel.isNotNull(), (rel > 1e-9).cast("double"))).alias("share_discontinuous"), F.avg(F.abs(F.col("a") * F.col("h") + F.col("b"))).alias("gradient"), F.avg(F.col("turns").cast("double")).alias("share_turning"),
    )
    return exact_quantiles(every, rel, {"jump_median": 0.5, "jump_p99": 0.99}, ("fitter",), few=True, also=rest)


def footprint(series: DataFrame, name: str, bump: float = 1.10, tolerance: float = 0.01) -> DataFrame:
    """By cell: how many months before the last one move when its mean is revised."""
    last = F.lead("ym").over(by_cell()).isNull()
    revised = series.withColumn("u", F.when(last, F.col("u") * bump).otherwise(F.col("u")))
    keep = lambda d, p: d.select("cell", "ym", *(F.col(x).alias(f"{p}{x}") for x in ("c", "a", "b", "h")))
    both = keep(fit(series, name), "o_").join(keep(fit(revised, name), "n_"), ["cell", "ym"]).join(series.groupBy("cell").agg(F.max(F.abs("u")).alias("scale"), F.max("ym").alias("last")), "cell")
    at = lambda p, s: evaluate(F.col(f"{p}a"), F.col(f"{p}b"), F.col(f"{p}c"), s * F.col("o_h"))
    moved = F.greatest(*(F.abs(at("n_", s) - at("o_", s)) for s in (0.0, 0.5, 1.0))) > tolerance * F.col("scale")
    return both.groupBy("cell").agg(F.coalesce(F.max(F.when(moved, F.col("last") - F.col("ym"))), F.lit(0)).alias("months"))


def sign_violations(fitted: DataFrame, sign: int, slack: float = 1e-12) -> DataFrame:
    """Pieces that reach the wrong side of 0, among pieces with a signal."""
    bad = (piece_min(F.col("a"), F.col("b"), F.col("c"), F.col("h")) < -slack) if sign > 0 else (piece_max(F.col("a"), F.col("b"), F.col("c"), F.col("h")) > slack)
    return fitted.filter(F.abs(F.col("u")) > 0).agg(F.count_if(bad).alias("violations"), F.count("*").alias("pieces"))


def continuity(fitted: DataFrame) -> DataFrame:
    return exact_quantiles(joints(fitted), "jump", {"p99_jump": 0.99}, also=(F.max("jump").alias("max_jump"),))


def fidelity(fitted: DataFrame, truth: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """RMSE of daily values against daily truth (cell, ym, day, value), over the envelope: by cell month, then averaged."""
    env = fitted.withColumn("env", envelope(F.col("u"), by_cell())).select("cell", "ym", "env")
    d = daily(fitted).join(truth.select("cell", "ym", "day", F.col("value").alias("truth")), ["cell", "ym", "day"])
    month = d.groupBy("cell", "ym").agg(F.sqrt(F.avg(F.pow(F.col("value") - F.col("truth"), 2))).alias("rmse"), F.var_samp("value").alias("var_fit"), F.var_samp("truth").alias("var_truth")).join(env, ["cell", "ym"])
    month = month.withColumn("score", F.try_divide("rmse", F.nullif(F.col("env"), F.lit(0.0)))).withColumn("variance_fraction", F.try_divide("var_fit", F.nullif(F.col("var_truth"), F.lit(0.0))))
    return month.groupBy(*keys).agg(F.avg("score").alias("mean"), F.percentile("score", 0.5).alias("median"), F.avg("variance_fraction").alias("variance_fraction"), F.count("*").alias("n"))


def structural_band(series: DataFrame, names: tuple[str, ...]) -> DataFrame:
    """Spread between fits at the middle of each piece."""
    every = None
    for name in names:
        one = fit(series, name).select("cell", "ym", evaluate(F.col("a"), F.col("b"), F.col("c"), F.col("h") / 2).alias("v"))
        every = one if every is None else every.unionByName(one)
    return every.groupBy("cell", "ym").agg((F.max("v") - F.min("v")).alias("band"))


def heterogeneity(df: DataFrame, value: str, keys: tuple[str, ...]) -> DataFrame:
    """Spread within coarse cells over their magnitude."""
    return df.groupBy(*keys).agg(F.try_divide(F.stddev_samp(value), F.nullif(F.abs(F.avg(value)), F.lit(0.0))).alias("spread"), F.count("*").alias("n"))


def poisson_bootstrap(df: DataFrame, value: str, unit: str, replicates: int = 200, seed: int = 42, p: tuple[float, float] = (0.025, 0.975)) -> DataFrame:
    """Interval of a mean under resampling of blocks: each block's weight in a replicate is a Poisson(1) draw by hash.

    Blocks are summed first, so only (block, replicate) pairs are made; no block is drawn on the driver.
    """
    blocks = df.groupBy(unit).agg(F.sum(value).alias("s"), F.count(value).alias("n"))
    each = blocks.select("*", F.explode(F.sequence(F.lit(1), F.lit(replicates))).alias("r")).withColumn("w", poisson_weight(F.lit(seed), F.col(unit), F.col("r")))
    means = each.groupBy("r").agg(F.try_divide(F.sum(F.col("w") * F.col("s")), F.nullif(F.sum(F.col("w") * F.col("n")), F.lit(0))).alias("m"))
    return means.agg(F.percentile("m", p[0]).alias("low"), F.percentile("m", 0.5).alias("median"), F.percentile("m", p[1]).alias("high"))


def refit_band(daily_values: DataFrame, name: str, replicates: int = 100, seed: int = 42, p: tuple[float, float] = (0.025, 0.975)) -> DataFrame:
    """Interval of each piece's middle value when days are resampled and the series is fitted again. daily_values: cell, ym, day, value.

    Days of a month come together once; its means in all replicates are worked out there, and only they are dealt out again.
    """
    from gridloom.operators.series import with_knots

    days = daily_values.groupBy("cell", "ym").agg(F.sort_array(F.collect_list(F.struct("day", "value"))).alias("days"))

    def mean(r: Column) -> Column:
        drawn = F.transform("days", lambda d: F.struct(seeded(F.lit(seed), F.col("cell"), F.col("ym"), d["day"], r).alias("u"), d["value"].alias("v")))
        drawn = F.transform(drawn, lambda d: F.struct(poisson_of(d["u"]).cast("double").alias("w"), d["v"].alias("v")))
        plain = F.aggregate("days", F.lit(0.0), lambda acc, d: acc + d["value"]) / F.size("days")
        zero = F.struct(F.lit(0.0).alias("w"), F.lit(0.0).alias("s"))
        add = lambda acc, d: F.struct((acc["w"] + d["w"]).alias("w"), (acc["s"] + d["w"] * d["v"]).alias("s"))
        return F.aggregate(drawn, zero, add, lambda acc: F.coalesce(F.try_divide(acc["s"], F.nullif(acc["w"], F.lit(0.0))), plain))

    means = days.select("cell", "ym", F.posexplode(F.transform(F.sequence(F.lit(1), F.lit(replicates)), mean)).alias("r", "u"))
    fitted = fit(with_knots(means.select(F.concat_ws(":", "cell", F.col("r") + 1).alias("cell"), "ym", "u")), name)
    middle = fitted.select(F.split("cell", ":")[0].cast("int").alias("cell"), "ym", evaluate(F.col("a"), F.col("b"), F.col("c"), F.col("h") / 2).alias("v"))
    return middle.groupBy("cell", "ym").agg(F.percentile("v", p[0]).alias("low"), F.percentile("v", p[1]).alias("high"))


#: Chances that a Poisson(1) draw is 0, at most 1, and so on.
POISSON = tuple(float(c) for c in np.cumsum([math.exp(-1) / math.factorial(k) for k in range(8)]))


def seeded(*key: Column) -> Column:
    """A number from 0 to 1 that the key alone decides, in any engine that has MD5."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *(k.cast("string") for k in key)).cast("binary")), 1, 10), 16, 10).cast("double") / F.lit(float(1 << 40))


def poisson_of(u: Column) -> Column:
    """The Poisson(1) draw at a number from 0 to 1."""
    return sum(((u > c).cast("int") for c in POISSON), F.lit(0))


def poisson_weight(*key: Column) -> Column:
    """A Poisson(1) draw that the key alone decides."""
    return poisson_of(seeded(*key))


def shadow_diff(left: DataFrame, right: DataFrame, keys: tuple[str, ...] = ("cell",)) -> DataFrame:
    """Two diurnal cycles (cell, hour, m): ratio of means, ratio of amplitudes, shift of the least hour."""
    s = lambda d, p: d.groupBy(*keys).agg(F.avg("m").alias(f"{p}mean"), (F.max("m") - F.min("m")).alias(f"{p}amp"), F.min_by("hour", F.struct("m", "hour")).alias(f"{p}low"))
    both = s(left, "l").join(s(right, "r"), list(keys))
    return both.select(*keys, F.try_divide("rmean", "lmean").alias("mass"), F.try_divide("ramp", F.nullif(F.col("lamp"), F.lit(0.0))).alias("amplitude"), signed_shift(F.col("llow"), F.col("rlow")).cast("int").alias("shift"))


def weighted_median(df: DataFrame, value: str, weight: str, keys: tuple[str, ...] = ()) -> DataFrame:
    return weighted_quantile(df, value, weight, 0.5, keys)


def shape_error(cycle: DataFrame, obs: str, model: str, keys: tuple[str, ...]) -> DataFrame:
    """RMSE between cycles that were each brought to unit mean."""
    w = W.partitionBy(*keys)
    norm = lambda x: F.try_divide(F.col(x), F.avg(x).over(w))
    return cycle.withColumn("_d", norm(obs) - norm(model)).groupBy(*keys).agg(F.sqrt(F.avg(F.col("_d") * F.col("_d"))).alias("rmse"))


def binomial_p(successes: int, n: int, p: float = 0.5) -> float:
    """Two-sided exact binomial probability."""
    pmf = [math.comb(n, k) * p**k * (1 - p) ** (n - k) for k in range(n + 1)]
    return min(1.0, sum(x for x in pmf if x <= pmf[successes] * (1 + 1e-12)))


def binomial(successes: Column, n: Column) -> Column:
    """Two-sided exact binomial probability of a fair draw, as an expression; n in the hundreds."""
    log_pmf = lambda k: F.aggregate(F.when(k > 0, F.sequence(F.lit(1), k)).otherwise(F.array().cast("array<int>")), n.cast("double") * math.log(0.5), lambda acc, i: acc + F.log((n - i + 1) / i))
    own = log_pmf(successes.cast("int"))
    likely = F.transform(F.sequence(F.lit(0), n.cast("int")), lambda k: log_pmf(k))
    return F.least(F.aggregate(likely, F.lit(0.0), lambda acc, x: acc + F.when(x <= own + 1e-9, F.exp(x)).otherwise(0.0)), F.lit(1.0))


def kriging_against(fitted: DataFrame, other: DataFrame) -> DataFrame:
    """By cell: RMS distance of two fits at the middle of pieces over the largest mean, and the mean width of the kriging band."""
    at = lambda d, name: d.select("cell", "ym", evaluate(F.col("a"), F.col("b"), F.col("c"), F.col("h") / 2).alias(name))
    both = fitted.select("cell", "ym", "u", "var").join(at(fitted, "own"), ["cell", "ym"]).join(at(other, "theirs"), ["cell", "ym"])
    return both.groupBy("cell").agg(F.try_divide(F.sqrt(F.avg(F.pow(F.col("own") - F.col("theirs"), 2))), F.max(F.abs("u"))).alias("rms"), F.try_divide(F.avg(2 * F.sqrt("var")), F.max(F.abs("u"))).alias("band"))


def seasonal_and_nightly(df: DataFrame, log_flux: str, temps: tuple[str, str], site: str, night: str) -> DataFrame:
    """R2 and Q10 of two temperatures at each site: over the seasons, and within nights (means of the night taken off)."""
    w = W.partitionBy(site, night)
    within = df.select(site, night, *(F.col(c).alias(c) for c in (log_flux, *temps)), *((F.col(c) - F.avg(c).over(w)).alias(f"d_{c}") for c in (log_flux, *temps)))
    out = [F.regr_r2(log_flux, t).alias(f"r2_{t}") for t in temps] + [F.regr_r2(f"d_{log_flux}", f"d_{t}").alias(f"r2_night_{t}") for t in temps] + [F.exp(10 * F.regr_slope(log_flux, t)).alias(f"q10_{t}") for t in temps]
    g = within.groupBy(site).agg(*out, F.countDistinct(night).alias("nights"), F.count("*").alias("n"))
    return g.withColumn("winner", F.when(F.col(f"r2_{temps[0]}") > F.col(f"r2_{temps[1]}"), temps[0]).otherwise(temps[1]))


def spectrum(series: DataFrame, value: str, key: str = "cell") -> DataFrame:
    """Power by frequency (cycles a step) of each key's series in order of ym."""

    def fft(table: pa.Table) -> pa.Table:
        x, at = table.column(value).to_numpy().astype(float), cells_of(table, key)
        powers = [np.abs(np.fft.rfft(x[a:b] - x[a:b].mean())) ** 2 / (b - a) for a, b in zip(at[:-1], at[1:])]
        of = np.repeat(at[:-1], [len(p) for p in powers])
        return pa.table({key: table.column(key).take(pa.array(of)), "frequency": np.concatenate([np.fft.rfftfreq(b - a) for a, b in zip(at[:-1], at[1:])]), "power": np.concatenate(powers)})

    return by_whole_cells(series.select(key, "ym", value), key, fft, f"{key} {dict(series.dtypes)[key]}, frequency double, power double")


def flat_rate(fitted: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """Share of pieces that fell back to a flat line."""
    return fitted.groupBy(*keys).agg((F.count_if((F.col("a") == 0) & (F.col("b") == 0)) / F.count("*")).alias("flat"))


def compare(left: DataFrame, right: DataFrame, keys: tuple[str, ...], value: str) -> DataFrame:
    """Correlation, RMS difference and largest difference of two tables on their keys."""
    both = left.select(*keys, F.col(value).alias("l")).join(right.select(*keys, F.col(value).alias("r")), list(keys))
    return both.agg(F.corr("l", "r").alias("corr"), F.sqrt(F.avg(F.pow(F.col("l") - F.col("r"), 2))).alias("rms"), F.max(F.abs(F.col("l") - F.col("r"))).alias("max_diff"), F.count("*").alias("n"))


def range_sweep(series: DataFrame, ranges: tuple[float, ...]) -> DataFrame:
    """Kriging under several covariance ranges: by range, the mean variance and roughness.

    Weights depend on a record's length and the range alone; a task works them out once for each.
    """

    def sweep(table: pa.Table) -> pa.Table:
        h, u, at = table.column("h").to_numpy(), table.column("u").to_numpy(), cells_of(table, "cell")
        weights = {(n, r): all_kriging_weights(n, range_=r) for n in set(np.diff(at).tolist()) for r in ranges}
        cells, rows = [], []
        for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
            for r in ranges:
                curve, _, _, var = kriged(h[a:b], u[a:b], weights[b - a, r])
                cells.append(a)
                rows.append((r, float(var.mean()), float(np.abs(2 * curve * h[a:b] ** 2).mean())))
        return pa.table({"cell": table.column("cell").take(pa.array(cells)), **{n: pa.array(c, pa.float64()) for n, c in zip(("range", "variance", "roughness"), zip(*rows))}})

    each = by_whole_cells(series.select("cell", "ym", "h", "u"), "cell", sweep, f"cell {dict(series.dtypes)['cell']}, range double, variance double, roughness double")
    return each.groupBy("range").agg(F.avg("variance").alias("variance"), F.avg("roughness").alias("roughness"))


def float_ulps(left: Column, right: Column, peak: Column) -> Column:
    """Difference in units of single precision at the peak's magnitude."""
    return F.try_divide(F.abs(left - right), F.lit(float(np.finfo(np.float32).eps)) * F.nullif(F.abs(peak), F.lit(0.0)))
