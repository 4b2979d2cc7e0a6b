"""Positional operators. All share one window, by cell in time order, so Catalyst plans one sort for them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, WindowSpec, functions as F

from gridloom.operators.quantiles import exact_quantiles


def by_cell(key: str = "cell", order: str = "ym") -> WindowSpec:
    return W.partitionBy(key).orderBy(order)


def before(x: Column, w: WindowSpec) -> Column:
    """The neighbour to the left; the first stands for its own."""
    return F.coalesce(F.lag(x).over(w), x)


def after(x: Column, w: WindowSpec) -> Column:
    return F.coalesce(F.lead(x).over(w), x)


def envelope(x: Column, w: WindowSpec) -> Column:
    """Largest magnitude of a value and its two neighbours."""
    return F.max(F.abs(x)).over(w.rowsBetween(-1, 1))


def moving_mean(x: Column, w: WindowSpec) -> Column:
    """Mean of three, of two at the ends."""
    return F.avg(x).over(w.rowsBetween(-1, 1))


def cumulative(x: Column, w: WindowSpec) -> Column:
    return F.sum(x).over(w.rowsBetween(W.unboundedPreceding, 0))


def step(x: Column, w: WindowSpec) -> Column:
    return x - F.lag(x).over(w)


def around(x: Column, w: WindowSpec, reach: int = 6) -> Column:
    """The values up to ``reach`` rows to either side, in order."""
    return F.collect_list(x).over(w.rowsBetween(-reach, reach))


def group_anomaly(x: Column, *keys: str) -> Column:
    return x - F.avg(x).over(W.partitionBy(*keys))


def unit_mean(x: Column, *keys: str) -> Column:
    return F.try_divide(x, F.avg(x).over(W.partitionBy(*keys)))


def z_score(x: Column, *keys: str) -> Column:
    w = W.partitionBy(*keys)
    return F.try_divide(x - F.avg(x).over(w), F.nullif(F.stddev_pop(x).over(w), F.lit(0.0)))


def weighted_quantile(df: DataFrame, value: str, weight: str, p: float, keys: tuple[str, ...] = ()) -> DataFrame:
    """The least value up to which the weights reach the share p of their sum, by key.

    Weights are summed by distinct value before the window, so its partitions hold distinct values only.
    """
    steps = df.groupBy(*keys, value).agg(F.sum(weight).alias("_w"))
    run = W.partitionBy(*keys).orderBy(value)
    steps = steps.withColumn("_c", F.sum("_w").over(run)).withColumn("_t", F.sum("_w").over(W.partitionBy(*keys)))
    return steps.filter(F.col("_c") >= p * F.col("_t")).groupBy(*keys).agg(F.min(value).alias(value))


def first_mid_last(df: DataFrame, key: str, order: str) -> DataFrame:
    """The first, middle and last row of each key."""
    w = W.partitionBy(key)
    n, r = F.count("*").over(w), F.row_number().over(w.orderBy(order))
    out = df.withColumn("_n", n).withColumn("_r", r)
    return out.filter((F.col("_r") == 1) | (F.col("_r") == F.floor(F.col("_n") / 2) + 1) | (F.col("_r") == F.col("_n"))).drop("_n", "_r")


def rank_top(df: DataFrame, keys: tuple[str, ...], order: list[Column], k: int) -> DataFrame:
    """The first k rows of each key."""
    return df.withColumn("_r", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).filter(F.col("_r") <= k).drop("_r")


def tail_sweep(df: DataFrame, key: str, order: str, value: str, most: int = 12) -> DataFrame:
    """For k = 1..most, the median of ``value`` over the last k rows of all keys."""
    tail = df.withColumn("_back", F.row_number().over(W.partitionBy(key).orderBy(F.desc(order)))).filter(F.col("_back") <= most)
    ks = F.explode(F.sequence(F.col("_back"), F.lit(most))).alias("k")
    return exact_quantiles(tail.select(ks, value), value, {"median": 0.5}, ("k",), few=True, also=(F.count("*").alias("n"),))


def neighbour_pairs(df: DataFrame, value: str, keys: tuple[str, ...] = ()) -> DataFrame:
    """Each cell's value with that of its eastern and its northern neighbour; rows and columns do not wrap."""
    east = W.partitionBy(*keys, "j").orderBy("i")
    north = W.partitionBy(*keys, "i").orderBy("j")
    v = F.col(value)
    return df.withColumn("east", F.when(F.lead("i").over(east) == F.col("i") + 1, F.lead(v).over(east))).withColumn("north", F.when(F.lead("j").over(north) == F.col("j") + 1, F.lead(v).over(north)))
