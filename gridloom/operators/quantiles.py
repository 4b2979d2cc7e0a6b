"""Exact quantiles of groups of any size, without a group in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

#: Steps of the sketched quantiles that bracket a rank, and how exact the sketch is: a bracket holds a 100th or so of a group.
GRID, ACCURACY = 500, 5_000
#: Equal parts of a bracket.
BINS = 4_096


def exact_quantiles(df: DataFrame, value: Column | str, probs: dict[str, float], keys: tuple[str, ...] = (), few: bool = False, also: tuple[Column, ...] = ()) -> DataFrame:
    """keys, and a column for each of ``probs``: quantiles by linear interpolation between ranks, as percentile() gives.

    A mergeable sketch brackets each rank; one more pass counts what lies below the bracket and each value inside it.
    Counts by equal parts of the bracket say which part holds the rank, and only that part is put in order. few: the
    caller knows that the keys take few values, so that brackets are sent to all tasks and nothing is dealt by key. also:
    named aggregates of the same groups, taken in the first pass; with any, groups without a value are there too.
    """
    group = F.struct(*(F.col(k) for k in keys)) if keys else F.lit(0)
    own = df.withColumns({"_k": group, "_v": (F.col(value) if isinstance(value, str) else value).cast("double")})
    v = own.select("_k", "_v").filter("_v IS NOT NULL")
    steps = ", ".join(f"{i / GRID!r}D" for i in range(GRID + 1))  # as text: a literal each would be a call to the JVM each
    sketch = (own if also else v).groupBy("_k").agg(F.count("_v").alias("_n"), F.expr(f"percentile_approx(_v, array({steps}), {ACCURACY})").alias("_q"), *also)
    wanted = F.explode(F.array(*(F.struct(F.lit(name).alias("name"), F.lit(float(p)).alias("p")) for name, p in probs.items()))).alias("_w")
    at = F.col("_w.p") * (F.col("_n") - 1)
    low = F.greatest(F.floor(F.floor(at) / F.col("_n") * GRID) - 2, F.lit(0)).cast("int")
    high = F.least(F.ceil((F.floor(at) + 2) / F.col("_n") * GRID) + 2, F.lit(GRID)).cast("int")
    target = sketch.filter("_n > 0").select("_k", "_n", "_q", wanted).select(F.col("_k").alias("_g"), F.col("_w.name").alias("_name"), F.floor(at).alias("_rank"), (at - F.floor(at)).alias("_part"), F.get("_q", low).alias("_lo"), F.get("_q", high).alias("_hi"))
    # Without keys there is a row for each quantile, with few keys a few times as many.
    both = v.join(F.broadcast(target) if few else target, v["_k"] == target["_g"]) if keys else v.crossJoin(F.broadcast(target))
    inside = F.col("_v").between(F.col("_lo"), F.col("_hi"))
    part = F.coalesce(F.least(F.floor(F.try_divide(F.col("_v") - F.col("_lo"), F.nullif(F.col("_hi") - F.col("_lo"), F.lit(0.0))) * BINS), F.lit(BINS - 1)), F.lit(0))
    counts = both.filter(F.col("_v") <= F.col("_hi")).groupBy("_k", "_name", "_rank", "_part", F.when(inside, part).otherwise(-1).alias("_bin"), F.when(inside, F.col("_v")).alias("_v")).agg(F.count("*").alias("_c"))
    bins = counts.groupBy("_k", "_name", "_rank", "_bin").agg(F.sum("_c").alias("_m"))
    upto = F.sum("_m").over(W.partitionBy("_k", "_name").orderBy("_bin"))
    bins = bins.withColumn("_before", upto - F.col("_m")).filter((F.col("_before") <= F.col("_rank") + 1) & (F.col("_before") + F.col("_m") > F.col("_rank")))
    bins = bins.select(F.col("_k").alias("_bk"), F.col("_name").alias("_bname"), F.col("_bin").alias("_bbin"), "_before")
    held = counts.join(bins, (F.col("_k") == F.col("_bk")) & (F.col("_name") == F.col("_bname")) & (F.col("_bin") == F.col("_bbin")))
    last = F.col("_before") + F.sum("_c").over(W.partitionBy("_k", "_name", "_bin").orderBy("_v"))
    held = held.withColumn("_last", last).withColumn("_first", F.col("_last") - F.col("_c"))
    of_rank = lambda r: F.max(F.when((F.col("_first") <= r) & (F.col("_last") > r), F.col("_v")))
    found = held.groupBy("_k", "_name", "_rank", "_part").agg(of_rank(F.col("_rank")).alias("_low"), of_rank(F.col("_rank") + 1).alias("_high"))
    exact = F.when(F.col("_low").isNull(), F.raise_error(F.lit("a rank lies outside its bracket"))).when(F.col("_part") == 0, F.col("_low")).otherwise(F.col("_low") + (F.col("_high") - F.col("_low")) * F.col("_part"))
    found = found.select("_k", "_name", exact.alias("_x"))
    named = [F.max(F.when(F.col("_name") == name, F.col("_x"))).alias(name) for name in probs]
    out = found.groupBy("_k").agg(*named) if keys else found.agg(*named).withColumn("_k", F.lit(0))
    if also:
        extra = sketch.drop("_n", "_q").withColumnRenamed("_k", "_e")
        out = extra.join(F.broadcast(out) if few or not keys else out, F.col("_e") == F.col("_k"), "left").drop("_k").withColumnRenamed("_e", "_k")
    return out.select(*(F.col("_k")[k].alias(k) for k in keys), *probs, *(c for c in out.columns if c != "_k" and c not in probs))
