"""Queries of the flux algebra, the grid, budgets, joins and the diurnal transform."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from gridloom.functions import calendar, flux, grid
from gridloom.operators import series as S, windows
from gridloom.operators.quantiles import exact_quantiles
from gridloom.plans import budget, diagnostics as D, diurnal
from gridloom.plans.fits import fit
from gridloom.queries import base as B
from gridloom.queries.base import HOURLY, MONTHLY, REGIONAL, SERIES, W, q4, query, r4, read, series
from gridloom.schema import RADIUS_BUDGET
from gridloom.session import scratch
from gridloom.sources.tables import hourly, monthly, regional, signs, write_flux

# 2.2 projections
@query("p_flux_channels", f"WITH {MONTHLY} SELECT cell, ym, {q4('v * 1e3')} AS grams, {q4('-2 * v')} AS gpp, {q4('u + v')} AS rtot, {q4('u - v')} AS nee, {q4('u - v + 1.5 + 2.5')} AS nbe, {q4('u / 12')} AS mol, {q4('u * 12.011')} AS gc FROM m")
def _(spark, root):
    return monthly(spark, root).select("cell", "ym", r4(flux.kg_to_g(F.col("v"))).alias("grams"), r4(flux.gpp(F.col("v"))).alias("gpp"), r4(flux.rtot(F.col("v"), F.col("u"))).alias("rtot"), r4(flux.nee(F.col("v"), F.col("u"))).alias("nee"), r4(flux.nbe(F.col("v"), F.col("u"), F.lit(1.5), F.lit(2.5))).alias("nbe"), r4(flux.gc_to_mol(F.col("u"))).alias("mol"), r4(flux.mol_to_gc(F.col("u"))).alias("gc"))


@query("p4_clean", f"WITH {MONTHLY}, x AS (SELECT cell, ym, CASE WHEN ym % 5 = 0 THEN -1e34 WHEN ym % 5 = 1 THEN 'nan'::DOUBLE WHEN ym % 5 = 2 THEN NULL WHEN ym % 5 = 3 THEN 'inf'::DOUBLE ELSE v END AS x, v FROM m) SELECT cell, ym, CASE WHEN ym % 5 = 4 THEN {q4('v')} ELSE {q4('0.0')} END AS cleaned, ym % 5 <> 4 AS missing FROM x")
def _(spark, root):
    k = F.col("ym") % 5
    x = F.when(k == 0, -1e34).when(k == 1, float("nan")).when(k == 2, None).when(k == 3, float("inf")).otherwise(F.col("v"))
    return monthly(spark, root).select("cell", "ym", r4(flux.clean(x)).alias("cleaned"), flux.to_null(x).isNull().alias("missing"))


@query("p5_activity", f"WITH {MONTHLY} SELECT cell, NOT (max(abs(u)) < 1e-15 AND max(abs(v)) < 1e-15) AS active, max(abs(v)) > 1e-15 AS land, {q4('max(abs(u))')} AS largest FROM m GROUP BY 1")
def _(spark, root):
    return monthly(spark, root).groupBy("cell").agg(flux.active(F.max(F.abs("u")), F.max(F.abs("v"))).alias("active"), flux.land(F.max(F.abs("v"))).alias("land"), r4(F.max(F.abs("u"))).alias("largest"))


@query("p7_temperature_factors", f"WITH {HOURLY} SELECT cell, ts, {q4('pow(1.5, (value + 100 - 273.15) / 10)', 8)} AS q10, {q4('exp(-308.56 / (greatest(value + 100, 227.23) - 227.13))', 8)} AS lt FROM e")
def _(spark, root):
    t = F.col("value") + 100
    return hourly(spark, root).select("cell", "ts", r4(flux.q10_factor(t), 8).alias("q10"), r4(flux.lloyd_taylor(t), 8).alias("lt"))


@query("p11_removal", f"WITH {HOURLY}, x AS (SELECT *, avg(value) OVER (PARTITION BY cell) AS mn FROM e) SELECT cell, ts, {q4('2.5 * value / mn')} AS q10, {q4('2.5')} AS flat FROM x")
def _(spark, root):
    x = hourly(spark, root).withColumn("mn", F.avg("value").over(Window.partitionBy("cell")))
    return x.select("cell", "ts", r4(flux.atmc_removal("q10", F.lit(2.5), F.col("value"), F.col("mn"))).alias("q10"), r4(flux.atmc_removal("flat", F.lit(2.5))).alias("flat"))


@query("p17_clock", f"WITH {HOURLY}, x AS (SELECT cell, ts, hour(ts) AS h, length(cell) * 20 - 100 AS lon FROM e), y AS (SELECT *, (((12 - lon / 15) % 24) + 24) % 24 AS noon FROM x) SELECT cell, ts, {q4('noon')} AS noon, {q4('least(abs(h - noon), 24 - abs(h - noon))')} AS apart, {q4('(((noon - h + 12) % 24) + 24) % 24 - 12')} AS shift, strftime(ts - INTERVAL 12 HOURS, '%Y%m%d') AS night, CASE WHEN month(ts) IN (12, 1, 2) THEN 'DJF' WHEN month(ts) IN (3, 4, 5) THEN 'MAM' WHEN month(ts) IN (6, 7, 8) THEN 'JJA' ELSE 'SON' END AS season FROM y")
def _(spark, root):
    ts, h = F.col("ts"), F.hour("ts")
    noon = flux.solar_noon((F.length("cell") * 20 - 100).cast("double"))
    return hourly(spark, root).select("cell", "ts", r4(noon).alias("noon"), r4(flux.hours_apart(h, noon)).alias("apart"), r4(flux.signed_shift(h, noon)).alias("shift"), flux.night_id(ts).alias("night"), flux.season(F.month(ts)).alias("season"))


@query("p21_night_filter", "SELECT event_id, value, user_id FROM events WHERE user_id < 20 AND value / 100 > 0.2 AND value > 0")
def _(spark, root):
    return read(spark, root, "events").filter(flux.night(F.col("user_id"), F.col("value") / 100, F.col("value"))).select("event_id", "value", "user_id")


@query("p22_crude_global", f"WITH {MONTHLY} SELECT ym, {q4(f'avg(v) * {4 * math.pi * 6378137.0**2!r} * {365.25 * 86400!r} / 1e15', 2)} AS pg FROM m GROUP BY 1")
def _(spark, root):
    return monthly(spark, root).groupBy("ym").agg(r4(flux.crude_global(F.avg("v")), 2).alias("pg"))


@query("p23_decimal_year", f"WITH {HOURLY} SELECT cell, ts, round(year(ts) + (dayofyear(ts) - 1 + (hour(ts) * 3600 + minute(ts) * 60 + second(ts)) / 86400.0) / CASE WHEN year(ts) % 4 = 0 THEN 366 ELSE 365 END, 8) AS year FROM e")
def _(spark, root):
    return hourly(spark, root).select("cell", "ts", F.round(flux.decimal_year(F.col("ts")), 8).alias("year"))


# 2.3 grid
_AREA = f"(sin(radians(-90 + j + 1)) - sin(radians(-90 + j))) * {math.radians(1.0)!r} * {RADIUS_BUDGET**2!r}"
_GRID = f"gr AS (SELECT id::INT AS cell_id, (id % 360)::INT AS i, (id // 360)::INT AS j, -179.5 + id % 360 AS lon, -89.5 + id // 360 AS lat FROM range(64800) t(id))"


@query("g3_grid", f"WITH {_GRID} SELECT cell_id, i, j, lon, lat, {q4(_AREA + ' / 1e6', 2)} AS km2, {q4('greatest(cos(radians(lat)), 0)')} AS coslat FROM gr")
def _(spark, root):
    return grid.grid(spark).select("cell_id", "i", "j", "lon", "lat", r4(F.col("area_m2") / 1e6, 2).alias("km2"), r4("coslat").alias("coslat"))


@query("g2_latitude_area", f"SELECT j::INT AS j, {q4(f'(sin(radians(-90 + j * 0.1 + 0.1)) - sin(radians(-90 + j * 0.1))) * {math.radians(0.1)!r} * {6371007.2**2!r} / 1e6', 3)} AS km2 FROM range(1800) t(j)")
def _(spark, root):
    return grid.latitude_area(spark).select("j", r4(F.col("area_m2") / 1e6, 3).alias("km2"))


@query("g4_regrid", f"WITH {_GRID}, x AS (SELECT i, j, {_AREA} AS w, CASE WHEN (i * 7 + j * 13) % 100 = 0 OR i < 20 THEN NULL ELSE sin(radians(lat)) * 100 + i END AS x FROM gr) SELECT (i // 10)::INT AS i, (j // 10)::INT AS j, {q4('sum(w * x) / sum(CASE WHEN x IS NOT NULL THEN w END)')} AS x FROM x GROUP BY 1, 2")
def _(spark, root):
    i, j = F.col("i"), F.col("j")
    x = F.when(((i * 7 + j * 13) % 100 == 0) | (i < 20), None).otherwise(F.sin(F.radians("lat")) * 100 + i)
    return grid.regrid(grid.grid(spark).withColumn("x", x), "x", 10, 10).select("i", "j", r4("x").alias("x"))


@query("g6_coarse_regrid", f"WITH {_GRID} SELECT (i // 6)::INT AS i, (j // 4)::INT AS j, {q4(f'sum({_AREA} * (i + j)) / sum({_AREA})')} AS x FROM gr GROUP BY 1, 2")
def _(spark, root):
    return grid.regrid(grid.grid(spark).withColumn("x", (F.col("i") + F.col("j")).cast("double")), "x", 6, 4).select("i", "j", r4("x").alias("x"))


@query("g7_bands", f"WITH {_GRID} SELECT (CASE WHEN abs(lat) >= 60 THEN 2 WHEN abs(lat) >= 30 THEN 1 ELSE 0 END)::INT AS band, count(*) AS cells, count(*) FILTER (lat >= -23.5 AND lat < 23.5) AS tropical, count(*) FILTER (lat >= 50) AS boreal, count(DISTINCT (i // 10)::INT * 1000 + (j // 10)::INT) AS blocks FROM gr GROUP BY 1")
def _(spark, root):
    lat = F.col("lat")
    return grid.grid(spark).groupBy(grid.disjoint_band(lat).alias("band")).agg(F.count("*").alias("cells"), F.count_if(grid.in_band(lat, "trop")).alias("tropical"), F.count_if(grid.in_band(lat, "boreal")).alias("boreal"), F.countDistinct(grid.block_id(F.col("i"), F.col("j"))).alias("blocks"))


@query("g8_nearest", f"WITH {_GRID} SELECT cell_id, lon, lat FROM gr ORDER BY abs(lat - 48.3), abs(lon - 2.2), cell_id LIMIT 1")
def _(spark, root):
    return grid.nearest(grid.grid(spark).select("cell_id", "lon", "lat"), 2.2, 48.3)


@query("g10_neighbour_correlation", f"WITH {_GRID}, x AS (SELECT i, j, sin(i / 20.0) * cos(j / 15.0) AS v FROM gr WHERE abs(i - 2 * j) > 3), y AS (SELECT *, CASE WHEN lead(i) OVER e = i + 1 THEN lead(v) OVER e END AS east, CASE WHEN lead(j) OVER n = j + 1 THEN lead(v) OVER n END AS north FROM x WINDOW e AS (PARTITION BY j ORDER BY i), n AS (PARTITION BY i ORDER BY j)) SELECT {q4('corr(v, east)')} AS east, {q4('corr(v, north)')} AS north, count(east) AS pairs FROM y")
def _(spark, root):
    i, j = F.col("i"), F.col("j")
    x = grid.grid(spark).filter(F.abs(i - 2 * j) > 3).select("i", "j", (F.sin(i / 20.0) * F.cos(j / 15.0)).alias("v"))
    return windows.neighbour_pairs(x, "v").agg(r4(F.corr("v", "east")).alias("east"), r4(F.corr("v", "north")).alias("north"), F.count("east").alias("pairs"))


# 2.4 joins
@query("j1_cell_month_join", f"WITH {SERIES}, {B.PPM}, x AS (SELECT l_suppkey::INT AS cell, (year(l_shipdate) * 12 + month(l_shipdate) - 1)::INT AS ym, sum(l_quantity) AS q FROM lineitem GROUP BY 1, 2) SELECT f.cell, f.ym, {q4('c')} AS c, {q4('q')} AS q, n_name FROM f JOIN x USING (cell, ym) JOIN supplier ON s_suppkey = f.cell JOIN nation ON n_nationkey = s_nationkey")
def _(spark, root):
    x = read(spark, root, "lineitem").groupBy(F.col("l_suppkey").cast("int").alias("cell"), calendar.ym(F.col("l_shipdate")).cast("int").alias("ym")).agg(F.sum("l_quantity").alias("q"))
    place = read(spark, root, "supplier").join(F.broadcast(read(spark, root, "nation")), F.col("n_nationkey") == F.col("s_nationkey"))  # 25 rows
    return fit(series(spark, root), "ppm").join(x, ["cell", "ym"]).join(place, F.col("s_suppkey") == F.col("cell")).select("cell", "ym", r4("c").alias("c"), r4("q").alias("q"), "n_name")


@query("j2_monthly_or_climatology", f"WITH {SERIES} SELECT cell, ym, {q4('u')} AS u, from_clim AS flux_from_climatology FROM s")
def _(spark, root):
    m = monthly(spark, root)
    out = diurnal.monthly_or_climatology(S.scaffold(m), m, S.month_mean(m, ("cell",), ("u", "v")), ("u", "v"))
    return out.select("cell", "ym", r4("u").alias("u"), "flux_from_climatology")


@query("j3_fit_or_month_mean", f"WITH {SERIES}, {B.PPM}, k AS (SELECT * FROM f WHERE ym < (SELECT max(ym) FROM f) - 11), mm AS (SELECT cell, ym % 12 AS month, avg(c) AS c FROM k GROUP BY 1, 2) SELECT s.cell, s.ym, {q4('CASE WHEN k.cell IS NOT NULL THEN k.c ELSE mm.c END')} AS c, k.cell IS NULL AS fit_from_climatology FROM s LEFT JOIN k ON k.cell = s.cell AND k.ym = s.ym LEFT JOIN mm ON mm.cell = s.cell AND mm.month = s.ym % 12")
def _(spark, root):
    months = series(spark, root).select("cell", "ym")
    last = months.agg(F.max("ym").alias("last"))
    fitted = fit(series(spark, root), "ppm").join(F.broadcast(last), F.col("ym") < F.col("last") - 11).drop("last")  # one row
    return diurnal.fit_or_month_mean(months, fitted).select("cell", "ym", r4("c").alias("c"), "fit_from_climatology")


@query("j5_products_compared", f"WITH {MONTHLY}, o AS (SELECT l_suppkey::INT AS cell, (year(l_shipdate) * 12 + month(l_shipdate) - 1)::INT AS ym, avg(l_extendedprice * (1 - l_discount)) AS u FROM lineitem GROUP BY 1, 2) SELECT {q4('corr(m.u, o.u)')} AS corr, {q4('sqrt(avg((m.u - o.u) ** 2))')} AS rms, {q4('max(abs(m.u - o.u))')} AS max_diff, count(*) AS n FROM m JOIN o USING (cell, ym)")
def _(spark, root):
    o = read(spark, root, "lineitem").groupBy(F.col("l_suppkey").cast("int").alias("cell"), calendar.ym(F.col("l_shipdate")).cast("int").alias("ym")).agg(F.avg(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("u"))
    out = D.compare(monthly(spark, root), o, ("cell", "ym"), "u")
    return out.select(*(r4(c).alias(c) for c in ("corr", "rms", "max_diff")), "n")


@query("j6_intersection", f"WITH {MONTHLY}, {REGIONAL} SELECT DISTINCT ym FROM m WHERE ym IN (SELECT ym FROM g)")
def _(spark, root):
    return monthly(spark, root).select("ym").join(regional(spark, root).select("ym"), "ym", "left_semi").distinct()


@query("j7_missing_months", f"WITH {SERIES} SELECT cell, ym FROM fr WHERE NOT EXISTS (SELECT 1 FROM m WHERE m.cell = fr.cell AND m.ym = fr.ym)")
def _(spark, root):
    return S.missing(monthly(spark, root))


@query("j8_difference", "WITH a AS (SELECT l_suppkey AS k, l_returnflag AS f FROM lineitem WHERE l_discount > 0.05), b AS (SELECT l_suppkey AS k, l_returnflag AS f FROM lineitem WHERE l_tax > 0.04) SELECT side, count(*) AS n, sum(k)::BIGINT AS k FROM (SELECT 'left' AS side, * FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b) UNION ALL SELECT 'right', * FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a)) GROUP BY 1")
def _(spark, root):
    from gridloom.plans.lineage import difference

    x = read(spark, root, "lineitem")
    a, b = (x.filter(c).select(F.col("l_suppkey").alias("k"), F.col("l_returnflag").alias("f")) for c in ("l_discount > 0.05", "l_tax > 0.04"))
    return difference(a, b).groupBy("side").agg(F.count("*").alias("n"), F.sum("k").alias("k"))


@query("j12_site_metadata", "SELECT coalesce(toxic::VARCHAR, '?') AS biome, count(*) AS n FROM documents LEFT JOIN labels USING (doc_id) GROUP BY 1")
def _(spark, root):
    return read(spark, root, "documents").select("doc_id").join(read(spark, root, "labels"), "doc_id", "left").groupBy(F.coalesce(F.col("toxic").cast("string"), F.lit("?")).alias("biome")).agg(F.count("*").alias("n"))


# 2.5 aggregates
@query("a1_month_mean", f"WITH {MONTHLY}, x AS (SELECT cell, ym % 12 AS month, avg(u) AS u, count(*) AS n FROM m WHERE ym // 12 BETWEEN 1996 AND 1999 GROUP BY 1, 2) SELECT c.cell, t.month::INT AS month, {q4('u')} AS u, coalesce(n, 0) AS n FROM (SELECT DISTINCT cell FROM m) c CROSS JOIN range(12) t(month) LEFT JOIN x ON x.cell = c.cell AND x.month = t.month")
def _(spark, root):
    return S.month_mean(monthly(spark, root), baseline=(1996, 1999)).select("cell", F.col("month").cast("int").alias("month"), r4("u").alias("u"), "n")


@query("a3_doy_mean", f"WITH x AS (SELECT event_type AS cell, month(ts)::INT AS month, day(ts)::INT AS day, avg(value) AS v FROM events WHERE NOT value < 5 GROUP BY 1, 2, 3) SELECT cell, month, day, {q4('v')} AS v FROM x")
def _(spark, root):
    x = read(spark, root, "events").select(F.col("event_type").alias("cell"), F.month("ts").alias("month"), F.dayofmonth("ts").alias("day"), F.col("value").alias("v"), (F.col("value") < 5).alias("is_clim"))
    return S.doy_mean(x).select("cell", "month", "day", r4("v").alias("v"))


@query("a5_partial_months", "SELECT l_suppkey::INT AS cell, (year(l_shipdate) * 12 + month(l_shipdate) - 1)::INT AS ym, count(DISTINCT day(l_shipdate)) AS n_days, count(DISTINCT day(l_shipdate)) < day(last_day(min(l_shipdate)::DATE)) AS provisional FROM lineitem GROUP BY 1, 2")
def _(spark, root):
    x = read(spark, root, "lineitem").select(F.col("l_suppkey").cast("int").alias("cell"), calendar.ym(F.col("l_shipdate")).cast("int").alias("ym"), F.dayofmonth("l_shipdate").alias("day"))
    return S.partial_months(x)


_PLACED = f"{REGIONAL}, x AS (SELECT *, cos(radians(lat)) * 1e12 AS area_m2 FROM g)"


def _placed(spark, root):
    return regional(spark, root).withColumn("area_m2", F.cos(F.radians("lat")) * 1e12)


@query("a6_budget", f"WITH {_PLACED} SELECT ym, {q4('sum(u * area_m2) * 86400 * 30 / 1e24', 6)} AS pg FROM x GROUP BY 1")
def _(spark, root):
    return _placed(spark, root).groupBy("ym").agg(r4(budget.pgc(F.col("u"), F.col("area_m2"), F.lit(86400.0 * 30)) / 1e9, 6).alias("pg"))


def _in_band(b: str) -> str:
    low, high = grid.BANDS[b]
    return f"lat >= {low} AND lat < {high}" if high < 90 else f"lat >= {low}"


@query("a7_band_summary", f"WITH {_PLACED} SELECT ym, " + ", ".join(q4(f"coalesce(sum(CASE WHEN {_in_band(b)} THEN u * area_m2 END), 0) * 1e-12") + f" AS u_{b}" for b in grid.BANDS) + " FROM x GROUP BY 1")
def _(spark, root):
    out = budget.band_summary(_placed(spark, root), ("u",), scale=1e-12)
    return out.select("ym", *(r4(c).alias(c) for c in out.columns if c != "ym"))


_YEARS = f"{MONTHLY}, y AS (SELECT cell, (ym // 12)::INT AS year, sum(u) AS u, count(*) AS n FROM m GROUP BY 1, 2 HAVING count(*) >= 12)"


@query("a8_annual", f"WITH {_YEARS} SELECT cell, year, {q4('u')} AS u FROM y")
def _(spark, root):
    return budget.annual(monthly(spark, root), "u", ("cell",)).select("cell", "year", r4("u").alias("u"))


@query("a9_year_on_year", f"WITH {_YEARS} SELECT cell, year, {q4('100 * (u - lag(u) OVER w) / lag(u) OVER w')} AS pct FROM y WINDOW w AS (PARTITION BY cell ORDER BY year)")
def _(spark, root):
    return budget.year_on_year(budget.annual(monthly(spark, root), "u", ("cell",)), "u", ("cell",)).select("cell", "year", r4("pct").alias("pct"))


@query("a10_seasonality", f"WITH {MONTHLY}, fy AS (SELECT cell, ym // 12 AS y, dense_rank() OVER (PARTITION BY cell ORDER BY ym // 12 DESC) AS r FROM m GROUP BY 1, 2 HAVING count(*) >= 12), mm AS (SELECT m.cell, (ym % 12 + 1)::INT AS month, avg(u) AS v FROM m JOIN fy ON fy.cell = m.cell AND fy.y = m.ym // 12 AND r <= 5 GROUP BY 1, 2) SELECT cell, {q4('max(v) - min(v)')} AS amplitude, arg_max(month, v) AS peak_month, arg_min(month, v) AS low_month FROM mm GROUP BY 1")
def _(spark, root):
    out = budget.seasonality(monthly(spark, root), "u", ("cell",))
    return out.select("cell", r4("amplitude").alias("amplitude"), F.col("peak_month").cast("int").alias("peak_month"), F.col("low_month").cast("int").alias("low_month"))


@query("a11_month_cov", f"WITH {MONTHLY} SELECT cell, (ym % 12 + 1)::INT AS month, {q4('stddev_samp(u) / abs(avg(u))')} AS cov FROM m GROUP BY 1, 2")
def _(spark, root):
    return budget.month_cov(monthly(spark, root), "u", ("cell",)).select("cell", F.col("month").cast("int").alias("month"), r4("cov").alias("cov"))


@query("a13_newest_by_key", "SELECT user_id, arg_max(event_id, (ts, event_id)) AS newest FROM events GROUP BY 1")
def _(spark, root):
    return read(spark, root, "events").groupBy("user_id").agg(F.max_by("event_id", F.struct("ts", "event_id")).alias("newest"))


@query("a15_percentiles", f"SELECT l_returnflag, {q4('quantile_cont(l_extendedprice, 0.5)')} AS p50, {q4('quantile_cont(l_extendedprice, 0.95)')} AS p95, {q4('quantile_cont(l_extendedprice, 0.99)')} AS p99 FROM lineitem GROUP BY 1")
def _(spark, root):
    out = exact_quantiles(read(spark, root, "lineitem"), "l_extendedprice", {"p50": 0.5, "p95": 0.95, "p99": 0.99}, ("l_returnflag",), few=True)
    return out.select("l_returnflag", *(r4(p).alias(p) for p in ("p50", "p95", "p99")))


@query("a16_weighted_quantile", "WITH x AS (SELECT l_returnflag, l_quantity AS q, sum(l_linenumber) AS w FROM lineitem GROUP BY 1, 2), y AS (SELECT *, sum(w) OVER (PARTITION BY l_returnflag ORDER BY q) AS c, sum(w) OVER (PARTITION BY l_returnflag) AS t FROM x) SELECT l_returnflag, min(q) AS l_quantity FROM y WHERE c >= 0.5 * t GROUP BY 1")
def _(spark, root):
    return windows.weighted_quantile(read(spark, root, "lineitem"), "l_quantity", "l_linenumber", 0.5, ("l_returnflag",))


@query("a17_trend", f"WITH {_YEARS} SELECT cell, {q4('regr_slope(u, year)', 3)} AS slope, {q4('regr_r2(u, year)')} AS r2 FROM y GROUP BY 1")
def _(spark, root):
    return budget.trend(budget.annual(monthly(spark, root), "u", ("cell",)), "u", keys=("cell",)).select("cell", r4("slope", 3).alias("slope"), r4("r2").alias("r2"))


@query("a18_q10", f"WITH {HOURLY} SELECT cell, {q4('exp(10 * regr_slope(ln(value), hour(ts) / 10.0))')} AS q10, {q4('regr_r2(ln(value), hour(ts) / 10.0)')} AS r2 FROM e GROUP BY 1")
def _(spark, root):
    x = hourly(spark, root).select("cell", F.log("value").alias("y"), (F.hour("ts") / 10.0).alias("t"))
    return budget.q10_of(x, "y", "t", ("cell",)).select("cell", r4("q10").alias("q10"), r4("r2").alias("r2"))


@query("a19_two_predictors", f"WITH x AS (SELECT l_returnflag, corr(l_extendedprice, l_quantity) AS ya, corr(l_extendedprice, l_tax) AS ys, corr(l_quantity, l_tax) AS r FROM lineitem GROUP BY 1) SELECT l_returnflag, {q4('(ya - r * ys) / (1 - r * r)')} AS beta_a, {q4('(ys - r * ya) / (1 - r * r)')} AS beta_s, {q4('r')} AS r, {q4('1 / (1 - r * r)')} AS vif FROM x")
def _(spark, root):
    out = budget.two_predictors(read(spark, root, "lineitem"), "l_extendedprice", "l_quantity", "l_tax", ("l_returnflag",))
    return out.select("l_returnflag", *(r4(c).alias(c) for c in ("beta_a", "beta_s", "r", "vif")))


_CYCLE = f"{HOURLY}, cy AS (SELECT cell, hour(ts)::INT AS hour, avg(value) AS m FROM e GROUP BY 1, 2)"


@query("a20_diurnal_cycle", f"WITH {_CYCLE} SELECT cell, hour, {q4('m')} AS m FROM cy")
def _(spark, root):
    return budget.diurnal_cycle(hourly(spark, root), "value", ("cell",), F.hour("ts")).select("cell", "hour", r4("m").alias("m"))


@query("a21_diurnal_shape", f"WITH {_CYCLE} SELECT cell, {q4('max(m) - min(m)')} AS amplitude, arg_min(hour, m) AS low_hour, count(*) AS bins FROM cy GROUP BY 1")
def _(spark, root):
    out = budget.diurnal_shape(budget.diurnal_cycle(hourly(spark, root), "value", ("cell",), F.hour("ts")), ("cell",))
    return out.select("cell", r4("amplitude").alias("amplitude"), "low_hour", "bins")


@query("a22_largest", f"WITH {MONTHLY} SELECT cell, arg_max(ym, (u, -ym)) AS at, {q4('max(u)')} AS u FROM m GROUP BY 1")
def _(spark, root):
    return monthly(spark, root).groupBy("cell").agg(F.max_by("ym", F.struct("u", -F.col("ym"))).alias("at"), r4(F.max("u")).alias("u"))


@query("a23_sign_flips", f"WITH {HOURLY}, x AS (SELECT 24288 AS ym, cell, bool_or(value < 20) AS b, count(*) FILTER (value < 20) AS f, count(*) AS n FROM e GROUP BY 2) SELECT ym::INT AS ym, count(*) FILTER (b) AS cells_flipped, count(*) AS cells, sum(f)::BIGINT AS hours_flipped, sum(n)::BIGINT AS hours FROM x GROUP BY 1")
def _(spark, root):
    return diurnal.sign_flips(hourly(spark, root).withColumn("ym", F.lit(24288)).withColumn("x", F.col("value") - 20), "x", 1)


@query("a24_negativity", f"WITH {HOURLY}, x AS (SELECT cell, value - 20 AS x FROM e) SELECT cell, count(*) FILTER (x < 0) AS n, count(*) AS total, {q4('coalesce(min(x) FILTER (x < 0), 0)')} AS worst, {q4('max(abs(x))')} AS scale, {q4('count(*) FILTER (x < 0) / count(*)::DOUBLE')} AS frac FROM x GROUP BY 1")
def _(spark, root):
    out = diurnal.negativity(hourly(spark, root).select("cell", (F.col("value") - 20).alias("x")), "x", ("cell",))
    return out.select("cell", "n", "total", r4("worst").alias("worst"), r4("scale").alias("scale"), r4("frac").alias("frac"))


@query("a26_residual_cutoff", f"WITH {SERIES}, x AS (SELECT cell, abs(u - avg(u) OVER (PARTITION BY cell)) AS rel FROM s), c AS (SELECT quantile_cont(rel, 0.99) AS p FROM x) SELECT cell % 10 AS band, count(*) FILTER (rel > (SELECT p FROM c)) AS n FROM x GROUP BY 1")
def _(spark, root):
    x = series(spark, root).select("cell", F.abs(windows.group_anomaly(F.col("u"), "cell")).alias("rel"))
    cut = exact_quantiles(x, "rel", {"p": 0.99})
    return x.crossJoin(F.broadcast(cut)).groupBy((F.col("cell") % 10).alias("band")).agg(F.count_if(F.col("rel") > F.col("p")).alias("n"))  # one row


@query("a27_outliers", f"WITH {SERIES}, z AS (SELECT cell, ym, abs(u - avg(u) OVER a) / stddev_pop(u) OVER a AS z, abs(u - avg(u) OVER b) / nullif(stddev_pop(u) OVER b, 0) AS zm FROM s WINDOW a AS (PARTITION BY cell), b AS (PARTITION BY cell, ym % 12)) SELECT cell, count(*) FILTER (z > 2.5) AS n, count(*) FILTER (zm > 2) AS by_month, bool_or(z > 6) AS any FROM z GROUP BY 1")
def _(spark, root):
    x = series(spark, root).withColumn("month", F.col("ym") % 12)
    z = x.select("cell", F.abs(windows.z_score(F.col("u"), "cell")).alias("z"), F.abs(windows.z_score(F.col("u"), "cell", "month")).alias("zm"))
    return z.groupBy("cell").agg(F.count_if(F.col("z") > 2.5).alias("n"), F.count_if(F.col("zm") > 2).alias("by_month"), F.bool_or(F.col("z") > 6).alias("any"))


@query("a29_event_anomaly", f"WITH {_YEARS} SELECT cell, {q4('avg(u) FILTER (year IN (1998)) - avg(u) FILTER (year IN (1996, 1997, 1999))')} AS anomaly FROM y GROUP BY 1")
def _(spark, root):
    return budget.event_anomaly(budget.annual(monthly(spark, root), "u", ("cell",)), "u", [1998], [1996, 1997, 1999], ("cell",)).select("cell", r4("anomaly").alias("anomaly"))


@query("a30_window_trends", f"WITH {_YEARS}, z AS (SELECT year, sum(u) AS u FROM y GROUP BY 1), t AS (SELECT regr_slope(u, year) FILTER (year BETWEEN 1995 AND 1998) AS a, regr_slope(u, year) FILTER (year BETWEEN 1997 AND 2000) AS b FROM z) SELECT {q4('a', 2)} AS a, {q4('b', 2)} AS b, sign(a) = sign(b) AS consistent FROM t")
def _(spark, root):
    y = budget.annual(monthly(spark, root), "u", ("cell",)).groupBy("year").agg(F.sum("u").alias("u"))
    return budget.window_trends(y, "u", {"a": (1995, 1998), "b": (1997, 2000)}).select(r4("a", 2).alias("a"), r4("b", 2).alias("b"), "consistent")


@query("a31_band_annual_mean", f"WITH {REGIONAL}, x AS (SELECT ym, lat, cos(radians(lat)) AS w, (CASE WHEN abs(lat) >= 60 THEN 2 WHEN abs(lat) >= 30 THEN 1 ELSE 0 END)::INT AS band, avg(u) AS v FROM g GROUP BY 1, 2, 3, 4), y AS (SELECT ym, band, sum(v * w) / sum(w) AS v FROM x GROUP BY 1, 2) SELECT band, (ym // 12)::INT AS year, {q4('avg(v)')} AS u FROM y GROUP BY 1, 2")
def _(spark, root):
    x = regional(spark, root).withColumn("j", F.col("cell")).withColumn("coslat", grid.coslat(F.col("lat")))
    return budget.band_annual_mean(x, "u", grid.disjoint_band(F.col("lat"))).select("band", "year", r4("u").alias("u"))


@query("a32_label_counts", "SELECT lang, source, count(*) AS n FROM documents GROUP BY 1, 2")
def _(spark, root):
    return read(spark, root, "documents").groupBy("lang", "source").agg(F.count("*").alias("n"))


@query("a33_flags", "SELECT l_suppkey AS cell, bool_and(l_quantity > 0) AS all_pos, bool_or(l_discount > 0.09) AS any_high, count(DISTINCT l_shipdate::DATE) AS days FROM lineitem GROUP BY 1")
def _(spark, root):
    return read(spark, root, "lineitem").groupBy(F.col("l_suppkey").alias("cell")).agg(F.bool_and(F.col("l_quantity") > 0).alias("all_pos"), F.bool_or(F.col("l_discount") > 0.09).alias("any_high"), F.countDistinct(F.to_date("l_shipdate")).alias("days"))


@query("a37_rollup", f"SELECT r_name, n_name, {q4('sum(c_acctbal)', 2)} AS c_acctbal, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ROLLUP (r_name, n_name)")
def _(spark, root):
    place = F.broadcast(read(spark, root, "nation").join(read(spark, root, "region"), F.col("n_regionkey") == F.col("r_regionkey")))  # 25 rows
    x = read(spark, root, "customer").join(place, F.col("c_nationkey") == F.col("n_nationkey"))
    return budget.rollup(x, ("r_name", "n_name"), "c_acctbal").select("r_name", "n_name", r4("c_acctbal", 2).alias("c_acctbal"), "n")


@query("a39_splice_step", f"WITH {MONTHLY}, x AS (SELECT ym, sum(u) AS s FROM m GROUP BY 1), y AS (SELECT ym, abs(s - lag(s) OVER (ORDER BY ym)) / abs(lag(s) OVER (ORDER BY ym)) AS step, s FROM x) SELECT ym, {q4('s')} AS s, {q4('step')} AS step FROM y WHERE ym = 23976")
def _(spark, root):
    return budget.splice_step(monthly(spark, root).withColumn("all", F.lit(1)), "u", 23976, ("all",)).select("ym", r4("s").alias("s"), r4("step").alias("step"))


# 2.6, 2.7
@query("w9_top_ranks", f"WITH {MONTHLY}, x AS (SELECT cell, ym, u, row_number() OVER (PARTITION BY cell ORDER BY u DESC, ym) AS r FROM m) SELECT cell, ym, {q4('u')} AS u FROM x WHERE r <= 5")
def _(spark, root):
    return windows.rank_top(monthly(spark, root), ("cell",), [F.desc("u"), F.col("ym")], 5).select("cell", "ym", r4("u").alias("u"))


@query("w11_first_mid_last", f"WITH {MONTHLY}, x AS (SELECT cell, ym, count(*) OVER (PARTITION BY cell) AS n, row_number() OVER (PARTITION BY cell ORDER BY ym) AS r FROM m) SELECT cell, ym FROM x WHERE r = 1 OR r = n // 2 + 1 OR r = n")
def _(spark, root):
    return windows.first_mid_last(monthly(spark, root).select("cell", "ym"), "cell", "ym")


@query("w8_group_normalised", f"WITH {HOURLY} SELECT cell, ts, {q4('value - avg(value) OVER (PARTITION BY cell, ts::DATE)')} AS anomaly, {q4('value / avg(value) OVER (PARTITION BY cell)')} AS unit FROM e")
def _(spark, root):
    x = hourly(spark, root).withColumn("d", F.to_date("ts"))
    return x.select("cell", "ts", r4(windows.group_anomaly(F.col("value"), "cell", "d")).alias("anomaly"), r4(windows.unit_mean(F.col("value"), "cell")).alias("unit"))


@query("o3_top_differences", f"WITH {MONTHLY}, x AS (SELECT cell, max(u) - min(u) AS d FROM m GROUP BY 1) SELECT cell, {q4('d')} AS d FROM x ORDER BY x.d DESC, cell LIMIT 10")
def _(spark, root):
    return monthly(spark, root).groupBy("cell").agg((F.max("u") - F.min("u")).alias("d")).orderBy(F.desc("d"), "cell").limit(10).select("cell", r4("d").alias("d"))


@query("o5_set_operators", f"WITH {MONTHLY}, {REGIONAL}, a AS (SELECT ym FROM m), b AS (SELECT ym FROM g) SELECT 'union' AS op, count(*) AS n FROM (SELECT * FROM a UNION ALL SELECT * FROM b) UNION ALL SELECT 'intersect', count(*) FROM (SELECT * FROM a INTERSECT SELECT * FROM b) UNION ALL SELECT 'except', count(*) FROM (SELECT * FROM a EXCEPT SELECT * FROM b) UNION ALL SELECT 'distinct', count(*) FROM (SELECT DISTINCT * FROM a)")
def _(spark, root):
    a, b = monthly(spark, root).select("ym"), regional(spark, root).select("ym")
    parts = {"union": a.unionByName(b), "intersect": a.intersect(b), "except": a.subtract(b), "distinct": a.distinct()}
    out = None
    for name, df in parts.items():
        row = df.agg(F.lit(name).alias("op"), F.count("*").alias("n"))
        out = row if out is None else out.unionByName(row)
    return out


_ORDER = "md5('42:' || doc_id), doc_id"


@query("o9_seeded_sample", f"SELECT doc_id FROM documents ORDER BY {_ORDER} LIMIT (SELECT least(30, greatest(1, floor(count(*) * 0.01)))::BIGINT FROM documents)")
def _(spark, root):
    from gridloom.plans.lineage import seeded_sample

    return seeded_sample(read(spark, root, "documents").select("doc_id"), "doc_id", 0.01, 1, 30)


@query("o9_stratified_sample", f"SELECT source, doc_id FROM documents QUALIFY row_number() OVER (PARTITION BY source ORDER BY {_ORDER}) <= 7")
def _(spark, root):
    from gridloom.plans.lineage import stratified_sample

    return stratified_sample(read(spark, root, "documents").select("source", "doc_id"), "doc_id", "source", 7)


# 2.10 diurnal
_DIURNAL = f"""WITH {HOURLY}, x AS (SELECT cell, (year(ts) * 12 + month(ts) - 1)::INT AS ym, ts, CASE WHEN hour(ts) < 6 THEN 0 ELSE value END AS ssrd, value + 250 AS t2m FROM e),
mn AS (SELECT cell, ym, -avg(ssrd) AS gpp_mn, avg(t2m) / 10 AS resp_mn FROM x GROUP BY 1, 2),
y AS (SELECT x.*, gpp_mn, resp_mn, (epoch(ts) - epoch(min(ts) OVER k)) / 86400.0 AS dt, pow(1.5, (t2m - 273.15) / 10) AS w, avg(pow(1.5, (t2m - 273.15) / 10)) OVER k AS w_mn, avg(ssrd) OVER k AS ssr_mn FROM x JOIN mn USING (cell, ym) WINDOW k AS (PARTITION BY cell, ym)),
z AS (SELECT *, CASE WHEN ssrd = 0 THEN 0 ELSE ssrd * gpp_mn / ssr_mn - gpp_mn + (gpp_mn + 0.1 * dt) END AS g0, w * resp_mn / w_mn - resp_mn + (resp_mn - 0.05 * dt) AS resp FROM y),
t AS (SELECT *, g0 * CASE WHEN sum(g0) OVER k = 0 OR sign(sum(g0) OVER k) <> sign(gpp_mn * count(*) OVER k) THEN 1 ELSE gpp_mn * count(*) OVER k / sum(g0) OVER k END AS gpp FROM z WINDOW k AS (PARTITION BY cell, ym))
SELECT cell, ts, {q4('gpp')} AS gpp, {q4('resp')} AS resp, {q4('gpp + resp')} AS nee FROM t"""


def _diurnal(spark, root, **kw):
    e = hourly(spark, root)
    x = e.select("cell", calendar.ym(F.col("ts")).cast("int").alias("ym"), "ts", F.when(F.hour("ts") < 6, 0.0).otherwise(F.col("value")).alias("ssrd"), (F.col("value") + 250).alias("t2m"))
    mn = x.groupBy("cell", "ym").agg((-F.avg("ssrd")).alias("gpp_mn"), (F.avg("t2m") / 10).alias("resp_mn"))
    line = lambda c, b: mn.select("cell", "ym", F.lit(0.0).alias("a"), F.lit(b).alias("b"), F.col(c).alias("c"))
    return diurnal.diurnalize(x, mn, line("gpp_mn", 0.1), line("resp_mn", -0.05), **kw)


@query("h1_diurnalize", _DIURNAL)
def _(spark, root):
    return _diurnal(spark, root).select("cell", "ts", r4("gpp").alias("gpp"), r4("resp").alias("resp"), r4("nee").alias("nee"))


@query("h3_mean_gate", f"SELECT cell, ym, n, {q4('resp_mn')} AS resp_mn, true AS ok FROM (WITH {_DIURNAL[5:].rsplit('SELECT', 1)[0]} SELECT cell, ym, count(*) AS n, any_value(resp_mn) AS resp_mn FROM t GROUP BY 1, 2)")
def _(spark, root):
    # Each month's respiration is shifted to its mean, so that the gate lets it pass.
    month = Window.partitionBy("cell", "ym")
    h = _diurnal(spark, root).withColumn("kept", F.col("resp") - F.avg("resp").over(month) + F.col("resp_mn"))
    gate = diurnal.mean_gate(diurnal.gated(h, "kept", "resp_mn"), "kept", "resp_mn")
    n = h.groupBy("cell", "ym").agg(F.count("*").alias("n"), F.first("resp_mn").alias("resp_mn"))
    return gate.join(n, ["cell", "ym"]).select("cell", "ym", "n", r4("resp_mn").alias("resp_mn"), "ok")


_RESPONSE = {"q10": lambda t: f"pow(1.5, ({t} - 273.15) / 10)", "lt": lambda t: f"exp(-308.56 / (greatest({t}, 227.23) - 227.13))"}
_TEMPERATURE = {"air": "(value + 250)", "soil": "(value / 2 + 265)"}


@query("h4_responses", " UNION ALL ".join(f"(WITH {HOURLY} SELECT '{d}' AS driver, '{k}' AS function, cell, {q4(f'avg({f(t)})', 9)} AS factor FROM e GROUP BY cell)" for d, t in _TEMPERATURE.items() for k, f in _RESPONSE.items()))
def _(spark, root):
    e = hourly(spark, root).select("cell", (F.col("value") + 250).alias("t2m"), (F.col("value") / 2 + 265).alias("stl1"))
    each = [e.groupBy("cell").agg(r4(F.avg(diurnal.response(d, k)), 9).alias("factor")).select(F.lit(d).alias("driver"), F.lit(k).alias("function"), "cell", "factor") for d in diurnal.DRIVERS for k in diurnal.RESPONSES]
    return reduce(DataFrame.unionByName, each)


@query("h5_chosen_months", f"WITH {MONTHLY} SELECT cell, ym, {q4('u')} AS u FROM m WHERE ym IN (1995 * 12 + 2, 1996 * 12 + 10)")
def _(spark, root):
    return calendar.chosen_months(monthly(spark, root), "1995-03, 199611").select("cell", "ym", r4("u").alias("u"))


@query("h9_parity", "WITH l AS (SELECT column_name AS c, column_type AS t FROM (DESCRIBE orders)), r AS (SELECT replace(column_name, 'l_', 'o_') AS c, column_type AS t FROM (DESCRIBE lineitem)) SELECT coalesce(l.c, r.c) AS name, CASE WHEN r.c IS NULL THEN 'left only' WHEN l.c IS NULL THEN 'right only' ELSE 'type' END AS what FROM l FULL JOIN r ON l.c = r.c WHERE l.c IS NULL OR r.c IS NULL OR l.t <> r.t UNION ALL SELECT column_name, 'attributes' FROM (DESCRIBE orders) WHERE column_name = 'o_orderkey'")
def _(spark, root):
    from gridloom.plans.lineage import parity

    l_ = read(spark, root, "lineitem")
    right = l_.select(*(F.col(c).alias(c.replace("l_", "o_"), metadata={"units": "1"} if c == "l_orderkey" else {}) for c in l_.columns))
    return spark.createDataFrame(parity(read(spark, root, "orders"), right), "name string, what string")


@query("h10_round_trip", f"WITH e AS ({_DIURNAL.replace(q4('gpp'), 'gpp').replace(q4('resp'), 'resp').replace(q4('gpp + resp'), 'gpp + resp')}), h AS (SELECT cell, (year(ts) * 12 + month(ts) - 1)::INT AS ym, avg(gpp) AS gpp FROM e GROUP BY 1, 2), x AS (SELECT event_type AS cell, (year(ts) * 12 + month(ts) - 1)::INT AS ym, avg(CASE WHEN hour(ts) < 6 THEN 0 ELSE value END) AS v FROM (SELECT event_type, date_trunc('hour', ts) AS ts, avg(value) AS value FROM events GROUP BY 1, 2) GROUP BY 1, 2) SELECT h.cell, {q4('max(abs(h.gpp + v) / v)', 6)} AS worst, {q4('avg(h.gpp / -v)', 6)} AS ratio FROM h JOIN x USING (cell, ym) GROUP BY 1")
def _(spark, root):
    h = _diurnal(spark, root).groupBy("cell", "ym").agg(F.avg("gpp").alias("gpp"), F.first("gpp_mn").alias("given"))
    return h.groupBy("cell").agg(r4(F.max(F.abs(F.col("gpp") - F.col("given")) / F.abs("given")), 6).alias("worst"), r4(F.avg(F.col("gpp") / F.col("given")), 6).alias("ratio"))


@query("h12_parsed_months", "SELECT o_orderkey, (CASE WHEN o_orderkey % 3 = 2 THEN -1 ELSE year(o_orderdate) * 12 + month(o_orderdate) - 1 END)::INT AS ym FROM orders")
def _(spark, root):
    d = F.col("o_orderdate")
    said = F.when(F.col("o_orderkey") % 3 == 0, F.date_format(d, "yyyy-MM")).when(F.col("o_orderkey") % 3 == 1, F.date_format(d, " yyyyMM")).otherwise(F.date_format(d, "yyyy-'13'"))
    return read(spark, root, "orders").select("o_orderkey", F.coalesce(calendar.month_of(said), F.lit(-1)).alias("ym"))


@query("a28_month_z", f"WITH {SERIES}, z AS (SELECT cell, ym % 12 AS month, ym, abs(u - avg(u) OVER b) / nullif(stddev_pop(u) OVER b, 0) AS z FROM s WINDOW b AS (PARTITION BY cell, ym % 12)) SELECT month, count(*) FILTER (z > 2) AS n, {q4('max(z)')} AS worst, count(z) AS total FROM z GROUP BY 1")
def _(spark, root):
    x = series(spark, root).withColumn("month", F.col("ym") % 12)
    x = x.select("month", F.abs(windows.z_score(F.col("u"), "cell", "month")).alias("z"))
    return x.groupBy("month").agg(F.count_if(F.col("z") > 2).alias("n"), r4(F.max("z")).alias("worst"), F.count("z").alias("total"))


@query("s7_flux_round_trip", f"SELECT cell, month(ts)::INT AS month, count(*) AS n, {q4('sum(gpp)', 2)} AS gpp, {q4('sum(nee)', 2)} AS nee, 'negative: uptake by land' AS sign FROM ({_DIURNAL.replace(q4('gpp'), 'gpp').replace(q4('resp'), 'resp').replace(q4('gpp + resp'), 'gpp + resp')}) GROUP BY 1, 2")
def _(spark, root):
    path = scratch(spark, "flux")
    write_flux(_diurnal(spark, root).select("cell", "ts", "gpp", "resp", "nee"), path)
    stored = spark.read.parquet(path)
    out = stored.groupBy("cell", (F.col("month") % 100).alias("month")).agg(F.count("*").alias("n"), r4(F.sum("gpp"), 2).alias("gpp"), r4(F.sum("nee"), 2).alias("nee"))
    return out.withColumn("sign", F.lit(signs(stored)["gpp"]))


@query("h2_conserved_mean", _DIURNAL.rpartition("SELECT")[0] + f"SELECT cell, ym, {q4('avg(gpp)')} AS mean, abs(avg(gpp) - any_value(gpp_mn)) <= 1e-9 * max(abs(gpp)) AS ok FROM t GROUP BY 1, 2")
def _(spark, root):
    h = _diurnal(spark, root)
    gate = diurnal.mean_gate(h, "gpp", "gpp_mn", 1e-9).select("cell", "ym", "ok")
    return h.groupBy("cell", "ym").agg(r4(F.avg("gpp")).alias("mean")).join(gate, ["cell", "ym"])


@query("h6_replicated_series", f"WITH {MONTHLY}, c AS (SELECT cell, ym % 12 AS month, avg(u) AS u FROM m GROUP BY 1, 2) SELECT cell, y.ym::INT AS ym, {q4('u')} AS u FROM c JOIN range(24120, 24192) y(ym) ON y.ym % 12 = month")
def _(spark, root):
    clim = S.month_mean(monthly(spark, root)).filter("n > 0")
    return S.replicate(clim, 24120, 24191).select("cell", "ym", r4("u").alias("u"))


@query("h7_imposed", f"WITH {SERIES}, x AS (SELECT l_suppkey::INT AS cell, (year(l_shipdate) * 12 + month(l_shipdate) - 1)::INT AS ym, avg(l_tax) AS tax FROM lineitem GROUP BY 1, 2) SELECT s.cell, s.ym, {q4('tax')} AS tax, x.cell IS NOT NULL AS imposed FROM s LEFT JOIN x USING (cell, ym)")
def _(spark, root):
    x = read(spark, root, "lineitem").groupBy(F.col("l_suppkey").cast("int").alias("cell"), calendar.ym(F.col("l_shipdate")).cast("int").alias("ym")).agg(F.avg("l_tax").alias("tax"))
    return S.impose(series(spark, root).select("cell", "ym"), x, ("cell", "ym"), ("tax",)).select("cell", "ym", r4("tax").alias("tax"), "imposed")


@query("d18_shadow_diff", f"WITH {_CYCLE}, o AS (SELECT cell, hour, m * (1 + hour / 50.0) AS m FROM cy), a AS (SELECT cell, avg(m) AS mean, max(m) - min(m) AS amp, arg_min(hour, m) AS low FROM cy GROUP BY 1), b AS (SELECT cell, avg(m) AS mean, max(m) - min(m) AS amp, arg_min(hour, m) AS low FROM o GROUP BY 1) SELECT cell, {q4('b.mean / a.mean')} AS mass, {q4('b.amp / a.amp')} AS amplitude, ((((b.low - a.low + 12) % 24) + 24) % 24 - 12)::INT AS shift FROM a JOIN b USING (cell)")
def _(spark, root):
    cy = budget.diurnal_cycle(hourly(spark, root), "value", ("cell",), F.hour("ts"))
    other = cy.select("cell", "hour", (F.col("m") * (1 + F.col("hour") / 50.0)).alias("m"))
    return D.shadow_diff(cy, other).select("cell", r4("mass").alias("mass"), r4("amplitude").alias("amplitude"), "shift")


@query("d20_seasonal_and_nightly", f"WITH x AS (SELECT l_returnflag AS site, strftime(l_shipdate, '%Y%m') AS night, ln(l_extendedprice) AS y, l_quantity AS ta, l_tax AS ts FROM lineitem), z AS (SELECT *, y - avg(y) OVER w AS dy, ta - avg(ta) OVER w AS dta, ts - avg(ts) OVER w AS dts FROM x WINDOW w AS (PARTITION BY site, night)) SELECT site, {q4('regr_r2(y, ta)')} AS r2_ta, {q4('regr_r2(y, ts)')} AS r2_ts, {q4('regr_r2(dy, dta)')} AS r2_night_ta, {q4('regr_r2(dy, dts)')} AS r2_night_ts, count(DISTINCT night) AS nights, CASE WHEN regr_r2(y, ta) > regr_r2(y, ts) THEN 'ta' ELSE 'ts' END AS winner FROM z GROUP BY 1")
def _(spark, root):
    x = read(spark, root, "lineitem").select(F.col("l_returnflag").alias("site"), F.date_format("l_shipdate", "yyyyMM").alias("night"), F.log("l_extendedprice").alias("y"), F.col("l_quantity").alias("ta"), F.col("l_tax").alias("ts"))
    out = D.seasonal_and_nightly(x, "y", ("ta", "ts"), "site", "night")
    return out.select("site", *(r4(c).alias(c) for c in ("r2_ta", "r2_ts", "r2_night_ta", "r2_night_ts")), "nights", "winner")


@query("d21_shape_error", f"WITH {_CYCLE}, x AS (SELECT cell, m / avg(m) OVER (PARTITION BY cell) - (m * (1 + hour / 50.0)) / avg(m * (1 + hour / 50.0)) OVER (PARTITION BY cell) AS d FROM cy) SELECT cell, {q4('sqrt(avg(d * d))')} AS rmse FROM x GROUP BY 1")
def _(spark, root):
    cy = budget.diurnal_cycle(hourly(spark, root), "value", ("cell",), F.hour("ts")).withColumn("model", F.col("m") * (1 + F.col("hour") / 50.0))
    return D.shape_error(cy, "m", "model", ("cell",)).select("cell", r4("rmse").alias("rmse"))


@query("d23_budget_invariance", f"WITH {SERIES}, {B.MINMOD}, x AS (SELECT (ym // 12)::INT AS year, sum((a * h * h / 3 + b * h / 2 + c) * h) AS fitted, sum(u * h) AS given FROM f GROUP BY 1) SELECT year, {q4('fitted', 1)} AS fitted, abs(fitted - given) < 1e-9 * given AS same FROM x")
def _(spark, root):
    f = fit(series(spark, root), "minmod")
    m = flux.piece_mean(*(F.col(x) for x in "abch")) * F.col("h")
    x = f.groupBy(F.floor(F.col("ym") / 12).cast("int").alias("year")).agg(F.sum(m).alias("fitted"), F.sum(F.col("u") * F.col("h")).alias("given"))
    return x.select("year", r4("fitted", 1).alias("fitted"), (F.abs(F.col("fitted") - F.col("given")) < 1e-9 * F.col("given")).alias("same"))


@query("d19_block_bootstrap", f"WITH {MONTHLY}, {B.bootstrap('m', 'cell // 10')}")
def _(spark, root):
    x = monthly(spark, root).withColumn("block", F.floor(F.col("cell") / 10))
    return D.poisson_bootstrap(x, "u", "block").select(*(r4(c, 2).alias(c) for c in ("low", "median", "high")))


@query("h11_float_ulps", f"WITH {SERIES}, x AS (SELECT cell, u, u::FLOAT::DOUBLE AS r, max(abs(u)) OVER (PARTITION BY cell) AS p FROM s) SELECT cell, max(abs(u - r) / (1.1920928955078125e-07 * p)) <= 1 AS within, count(*) AS n FROM x GROUP BY 1")
def _(spark, root):
    peak = F.max(F.abs("u")).over(Window.partitionBy("cell"))
    x = series(spark, root).withColumn("ulps", D.float_ulps(F.col("u"), F.col("u").cast("float").cast("double"), peak))
    return x.groupBy("cell").agg((F.max("ulps") <= 1).alias("within"), F.count("*").alias("n"))


@query("a25_never_present", f"WITH {SERIES}, x AS (SELECT cell, (cell * 7 % 180) // 10 AS band, count(m.u) AS n FROM fr LEFT JOIN m USING (cell, ym) GROUP BY 1, 2) SELECT band::INT AS band, count(*) AS cells, count(*) FILTER (n < 83) AS with_gaps FROM x GROUP BY 1 ORDER BY with_gaps DESC, band LIMIT 5")
def _(spark, root):
    m = monthly(spark, root)
    x = S.scaffold(m).join(m.select("cell", "ym", "u"), ["cell", "ym"], "left").groupBy("cell", F.floor((F.col("cell") * 7 % 180) / 10).cast("int").alias("band")).agg(F.count("u").alias("n"))
    return x.groupBy("band").agg(F.count("*").alias("cells"), F.count_if(F.col("n") < 83).alias("with_gaps")).orderBy(F.desc("with_gaps"), "band").limit(5)


@query("h8_spinup", f"WITH {MONTHLY}, c AS (SELECT cell, ym % 12 AS month, avg(u) AS u FROM m GROUP BY 1, 2) SELECT c.cell, y.ym::INT AS ym, {q4('u')} AS u, true AS flux_from_climatology FROM c JOIN range(23904, 23928) y(ym) ON y.ym % 12 = month")
def _(spark, root):
    m = monthly(spark, root)
    early = spark.range(23904, 23928).select(F.col("id").cast("int").alias("ym"))
    months = m.select("cell").distinct().crossJoin(F.broadcast(early))  # months of the spin-up
    return diurnal.monthly_or_climatology(months, m, S.month_mean(m, ("cell",), ("u",)), ("u",)).filter("u IS NOT NULL").select("cell", "ym", r4("u").alias("u"), "flux_from_climatology")


@query("s10_day_split", f"WITH {HOURLY} SELECT cell, ts::DATE::VARCHAR AS date, {q4('avg(value)')} AS nee, count(*) AS slots FROM e GROUP BY 1, 2")
def _(spark, root):
    x = hourly(spark, root).withColumn("date", F.to_date("ts").cast("string"))
    return x.groupBy("cell", "date").agg(r4(F.avg("value")).alias("nee"), F.count("*").alias("slots"))


@query("j9_lag_pairs", f"WITH {MONTHLY}, x AS (SELECT cell, ym, u, CASE WHEN lead(ym) OVER w = ym + 1 THEN lead(u) OVER w END AS n FROM m {W}) SELECT cell, {q4('corr(u, n)')} AS r, count(n) AS pairs FROM x GROUP BY 1")
def _(spark, root):
    w = windows.by_cell()
    x = monthly(spark, root).withColumn("n", F.when(F.lead("ym").over(w) == F.col("ym") + 1, F.lead("u").over(w)))
    return x.groupBy("cell").agg(r4(F.corr("u", "n")).alias("r"), F.count("n").alias("pairs"))


@query("w6_december_to_january", f"WITH {SERIES}, x AS (SELECT cell, ym, u - lag(u) OVER w AS d FROM s {W}) SELECT cell, {q4('avg(abs(d)) FILTER (ym % 12 = 0)')} AS january, {q4('avg(abs(d)) FILTER (ym % 12 <> 0)')} AS others FROM x GROUP BY 1")
def _(spark, root):
    x = series(spark, root).withColumn("d", F.abs(windows.step(F.col("u"), windows.by_cell())))
    january = F.col("ym") % 12 == 0
    return x.groupBy("cell").agg(r4(F.avg(F.when(january, F.col("d")))).alias("january"), r4(F.avg(F.when(~january, F.col("d")))).alias("others"))


@query("d13_refit_band", f"""WITH tr AS (SELECT l_suppkey::INT AS cell, (year(l_shipdate) * 12 + month(l_shipdate) - 1)::INT AS ym, day(l_shipdate)::INT AS day, avg(l_extendedprice) AS v FROM lineitem GROUP BY 1, 2, 3),
wt AS (SELECT cell, ym, v, r, {B.poisson("concat_ws(':', 42, cell, ym, day, r)")} AS w FROM tr, range(1, 21) k(r)),
s0 AS (SELECT cell || ':' || r AS cell, ym, coalesce(sum(w * v) / nullif(sum(w), 0), avg(v)) AS u FROM wt GROUP BY cell, r, ym),
s AS (SELECT cell, ym, u, (d - DATE '1970-01-01')::DOUBLE AS t0, day(last_day(d))::DOUBLE AS h FROM (SELECT *, make_date((ym // 12)::INT, (ym % 12 + 1)::INT, 1) AS d FROM s0)),
{B.MINMOD}, v AS (SELECT split_part(cell, ':', 1)::INT AS cell, ym, a * h * h / 4 + b * h / 2 + c AS v FROM f)
SELECT cell, ym, {q4('quantile_cont(v, 0.025)', 2)} AS low, {q4('quantile_cont(v, 0.975)', 2)} AS high FROM v GROUP BY 1, 2""")
def _(spark, root):
    from gridloom.queries.fitting import _truth

    return D.refit_band(_truth(spark, root), "minmod", 20).select("cell", "ym", r4("low", 2).alias("low"), r4("high", 2).alias("high"))
