"""Queries of the fits and of what is read off them."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from gridloom.functions import flux
from gridloom.operators.quantiles import exact_quantiles
from gridloom.operators.windows import after, before, by_cell, cumulative, envelope, moving_mean, step, tail_sweep
from gridloom.plans import diagnostics as D
from gridloom.plans.fits import daily, fit, hybrid, month_mean_fit, order_of_averaging, padded_fit, refit_climatology
from gridloom.queries import base as B
from gridloom.queries.base import ORACLES, QUERIES, SERIES, W, q4, query, r4, series
from gridloom.session import scratch
from gridloom.sources.tables import monthly, read_fit, write_fit

SQL_FITS = {"f7_constant": ("constant", B.CONSTANT), "f3_minmod": ("minmod", B.MINMOD), "f2_ppm": ("ppm", B.PPM), "f8_van_leer": ("van_leer", B.VAN_LEER), "f8_mc": ("mc", B.MC), "f8_superbee": ("superbee", B.SUPERBEE), "f9_parabola": ("parabola", B.PARABOLA), "f10_steffen": ("steffen", B.STEFFEN), "f14_trapezoid": ("trapezoid", B.TRAPEZOID)}


def _show(df):
    """End values and middle of each piece: what the coefficients mean, at a scale that rounds well."""
    a, b, c, h = (F.col(x) for x in "abch")
    return df.select("cell", "ym", r4(c).alias("at_start"), r4(flux.evaluate(a, b, c, h / 2)).alias("at_middle"), r4(flux.evaluate(a, b, c, h)).alias("at_end"))


SHOW = f"SELECT cell, ym, {q4('c')} AS at_start, {q4('a * h * h / 4 + b * h / 2 + c')} AS at_middle, {q4(B.END)} AS at_end FROM f"

for _name, (_fit, _sql) in SQL_FITS.items():
    QUERIES[_name] = lambda spark, root, k=_fit: _show(fit(series(spark, root), k))
    ORACLES[_name] = f"WITH {SERIES},\n{_sql}\n{SHOW}"

# Fritsch-Carlson's scan as a recursive query: pieces in order, the slope at each right knot carried on.
_PCHIP = f"""z AS (SELECT *, CASE WHEN avg(u) OVER (PARTITION BY cell) < 0 THEN -1.0 ELSE 1.0 END AS sg FROM s),
y AS (SELECT cell, ym, t0, h, u, sg, sg * u AS x, row_number() OVER w AS k, coalesce((sg * u + lead(sg * u) OVER w) / 2, sg * u) AS nxt FROM z {W}),
walk(cell, k, m0, m1) AS (
  SELECT cell, k, CASE WHEN x = 0 THEN 0 WHEN sqrt(1 + (nxt / x) * (nxt / x)) > 3 THEN 3 * x / sqrt(1 + (nxt / x) * (nxt / x)) ELSE x END,
    CASE WHEN x = 0 THEN 0 WHEN sqrt(1 + (nxt / x) * (nxt / x)) > 3 THEN 3 * nxt / sqrt(1 + (nxt / x) * (nxt / x)) ELSE nxt END FROM y WHERE k = 1
  UNION ALL
  SELECT y.cell, y.k, CASE WHEN x = 0 THEN 0 WHEN sqrt((m1 / x) * (m1 / x) + (nxt / x) * (nxt / x)) > 3 THEN 3 * m1 / sqrt((m1 / x) * (m1 / x) + (nxt / x) * (nxt / x)) ELSE m1 END,
    CASE WHEN x = 0 THEN 0 WHEN sqrt((m1 / x) * (m1 / x) + (nxt / x) * (nxt / x)) > 3 THEN 3 * nxt / sqrt((m1 / x) * (m1 / x) + (nxt / x) * (nxt / x)) ELSE nxt END
  FROM walk JOIN y ON y.cell = walk.cell AND y.k = walk.k + 1),
f AS (SELECT y.cell, ym, t0, h, u, sg * (-6 * x + 3 * a.m0 + 3 * coalesce(b.m0, a.m1)) / (h * h) AS a, sg * (6 * x - 4 * a.m0 - 2 * coalesce(b.m0, a.m1)) / h AS b, sg * a.m0 AS c
  FROM y JOIN walk a ON a.cell = y.cell AND a.k = y.k LEFT JOIN walk b ON b.cell = y.cell AND b.k = y.k + 1)"""
QUERIES["f1_pchip"] = lambda spark, root: _show(fit(series(spark, root), "pchip"))
ORACLES["f1_pchip"] = f"WITH RECURSIVE {SERIES},\n{_PCHIP}\n{SHOW}"
for _name, _fit in {"f4_piqs": "piqs", "f5_mss": "mss", "f6_atpk": "atpk", "f11_histospline": "histospline"}.items():
    QUERIES[_name] = lambda spark, root, k=_fit: _show(fit(series(spark, root), k))
ORACLES["f4_piqs"] = f"WITH RECURSIVE {SERIES},\n{B.PIQS}\n{SHOW}"
ORACLES["f11_histospline"] = f"WITH RECURSIVE {SERIES},\n{B.HISTOSPLINE}\n{SHOW}"


@query("f13_hybrid", f"""WITH RECURSIVE {SERIES},
{B.over(B.PIQS, 's', '_s')},
{B.over(B.MINMOD, 's', '_l')},
e AS (SELECT *, avg(u) OVER (PARTITION BY cell) < 0 AS falls, max(abs(u)) OVER (PARTITION BY cell ORDER BY ym ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS env FROM f_s),
x AS (SELECT *, CASE WHEN falls THEN -greatest(c, {B.END}, coalesce({B.VERTEX}, c)) ELSE least(c, {B.END}, coalesce({B.VERTEX}, c)) END < -1e-9 * env AS wrong FROM e),
f AS (SELECT x.cell, x.ym, x.h, CASE WHEN wrong THEN 0 ELSE x.a END AS a, CASE WHEN wrong THEN l.b ELSE x.b END AS b, CASE WHEN wrong THEN l.c ELSE x.c END AS c FROM x JOIN f_l l USING (cell, ym))
{SHOW}""")
def _(spark, root):
    return _show(hybrid(series(spark, root)))


# The bound is the largest mean, so the smoothing around each record's peaks is clipped in every round.
@query("f12_bounded_iterative", f"""WITH RECURSIVE {SERIES}, x AS (SELECT cell, ym, u, max(u) OVER (PARTITION BY cell) AS top FROM s),
it(k, cell, ym, p, y) AS (SELECT 0, cell, ym, p.p, u FROM x, range(30) p(p)
  UNION ALL SELECT k + 1, cell, ym, p, least(top, sm + (u - avg(sm) OVER (PARTITION BY cell, ym)))
  FROM (SELECT k, cell, ym, p, CASE WHEN lag(y) OVER w IS NULL THEN (y + lead(y) OVER w) / 2 WHEN lead(y) OVER w IS NULL THEN (lag(y) OVER w + y) / 2 ELSE (lag(y) OVER w + y + lead(y) OVER w) / 3 END AS sm FROM it WHERE k < 100 WINDOW w AS (PARTITION BY cell ORDER BY ym, p)) JOIN x USING (cell, ym))
SELECT cell, ym, {q4('max(y) FILTER (p = 0)')} AS first, {q4('max(y) FILTER (p = 29)')} AS last, {q4('avg(y)')} AS mean, {q4('max(y)')} AS top FROM it WHERE k = 100 GROUP BY 1, 2""")
def _(spark, root):
    from gridloom.plans.kernels import bounded

    return bounded(series(spark, root)).select("cell", "ym", *(r4(x).alias(x) for x in ("first", "last", "mean", "top")))


@query("f15_padded_fit", f"""WITH {SERIES}, b0 AS (SELECT min(ym) AS lo, max(ym) AS hi FROM s), c0 AS (SELECT cell, ym % 12 AS month, avg(u) AS u FROM s GROUP BY 1, 2),
s2 AS (SELECT cell, ym, u FROM s UNION ALL SELECT c0.cell, p.ym, c0.u FROM (SELECT unnest(generate_series(lo - 12, lo - 1)) AS ym FROM b0 UNION ALL SELECT unnest(generate_series(hi + 1, hi + 12)) FROM b0) p JOIN c0 ON c0.month = p.ym % 12),
s3 AS (SELECT cell, ym::INT AS ym, u, (d - DATE '1970-01-01')::DOUBLE AS t0, day(last_day(d))::DOUBLE AS h FROM (SELECT *, make_date((ym // 12)::INT, (ym % 12 + 1)::INT, 1) AS d FROM s2)),
{B.MINMOD.replace(' FROM s ', ' FROM s3 ')} {SHOW} WHERE ym BETWEEN (SELECT lo FROM b0) AND (SELECT hi FROM b0)""")
def _(spark, root):
    return _show(padded_fit(series(spark, root), "minmod"))


@query("f16_order_of_averaging", f"""WITH {SERIES}, {B.MINMOD}, r1 AS (SELECT cell % 10 AS grp, ym, avg(c) AS fit_first FROM f GROUP BY 1, 2),
s9 AS (SELECT cell % 10 AS cell, ym, any_value(t0) AS t0, any_value(h) AS h, avg(u) AS u FROM s GROUP BY 1, 2),
{B.MINMOD.replace(' FROM s ', ' FROM s9 ').replace('l1', 'k1').replace('l2', 'k2').replace('l3', 'k3').replace('f AS', 'f2 AS')}
SELECT r1.grp, r1.ym, {q4('fit_first')} AS fit_first, {q4('f2.c')} AS mean_first FROM r1 JOIN f2 ON f2.cell = r1.grp AND f2.ym = r1.ym""")
def _(spark, root):
    fine = series(spark, root).withColumn("grp", F.col("cell") % 10)
    return order_of_averaging(fine, "minmod", "grp").select("grp", "ym", r4("c_fit_first").alias("fit_first"), r4("c_mean_first").alias("mean_first"))


@query("f17_climatology_refit", f"""WITH RECURSIVE {SERIES}, c0 AS (SELECT cell, ym % 12 AS month, avg(u) AS u FROM s GROUP BY 1, 2),
s2 AS (SELECT cell, p.ym::INT AS ym, u, (d - DATE '1970-01-01')::DOUBLE AS t0, day(last_day(d))::DOUBLE AS h FROM (SELECT ym, make_date((ym // 12)::INT, (ym % 12 + 1)::INT, 1) AS d FROM range(2001 * 12, 2006 * 12) r(ym)) p JOIN c0 ON c0.month = p.ym % 12),
{B.over(_PCHIP, 's2', '_2')}
{SHOW.replace(' FROM f', ' FROM f_2')}""")
def _(spark, root):
    from gridloom.operators.series import month_mean

    return _show(refit_climatology(month_mean(series(spark, root).select("cell", "ym", "u")), 2001 * 12, 2005 * 12 + 11))


@query("s9_stored_fit", f"WITH {SERIES},\n{B.PPM}\n{SHOW} WHERE ym BETWEEN 1994 * 12 + 5 AND 1996 * 12 + 2")
def _(spark, root):
    path = scratch(spark, "fit")
    write_fit(fit(series(spark, root), "ppm"), path)
    return _show(read_fit(spark, path, 1994 * 12 + 5, 1996 * 12 + 2))


@query("a36_month_mean_fit", f"WITH {SERIES}, {B.PPM} SELECT cell, ym % 12 AS month, {q4('avg(a)', 6)} AS a, {q4('avg(b)')} AS b, {q4('avg(c)')} AS c FROM f GROUP BY 1, 2")
def _(spark, root):
    return month_mean_fit(fit(series(spark, root), "ppm")).select("cell", "month", r4("a", 6).alias("a"), r4("b").alias("b"), r4("c").alias("c"))


@query("flagship_daily_peaks", f"""WITH {SERIES}, {B.MINMOD}, d AS (SELECT cell, ym, u, unnest(generate_series(1, h::INT)) AS day, a, b, c FROM f),
v AS (SELECT cell, ym, u, day, a * (day - 0.5) * (day - 0.5) + b * (day - 0.5) + c AS value FROM d)
SELECT cell, ym, {q4('avg(value)')} AS mean, {q4('max(value)')} AS peak, count(*) AS days FROM v GROUP BY 1, 2""")
def flagship(spark, root):
    return daily(fit(series(spark, root), "minmod")).groupBy("cell", "ym").agg(r4(F.avg("value")).alias("mean"), r4(F.max("value")).alias("peak"), F.count("*").alias("days"))


@query("p13_piece_lookup", f"""WITH {SERIES}, x AS (SELECT l_suppkey::INT AS cell, l_orderkey, l_linenumber, l_shipdate::DATE AS day FROM lineitem)
SELECT x.cell, l_orderkey, l_linenumber, s.ym, ((day - DATE '1970-01-01') - s.t0)::BIGINT AS dt FROM x JOIN s ON s.cell = x.cell AND (day - DATE '1970-01-01') >= s.t0 AND (day - DATE '1970-01-01') < s.t0 + s.h""")
def _(spark, root):
    from gridloom.functions.calendar import ym

    x = B.read(spark, root, "lineitem").select(F.col("l_suppkey").cast("int").alias("cell"), "l_orderkey", "l_linenumber", F.col("l_shipdate").cast("date").alias("day"))
    # The range join of a time with pieces is an equi-join here: pieces are months.
    pieces = series(spark, root).select("cell", "ym", "t0")
    return x.withColumn("ym", ym(F.col("day")).cast("int")).join(pieces, ["cell", "ym"]).select("cell", "l_orderkey", "l_linenumber", "ym", (F.datediff("day", F.lit("1970-01-01").cast("date")) - F.col("t0")).cast("bigint").alias("dt"))


@query("p14_piece_extrema", f"WITH {SERIES}, {B.PARABOLA} SELECT cell, ym, {q4(f'greatest(c, {B.END}, coalesce({B.VERTEX}, c))')} AS top, {q4(f'least(c, {B.END}, coalesce({B.VERTEX}, c))')} AS low, {q4(B.PEAK)} AS peak FROM f")
def _(spark, root):
    f = fit(series(spark, root), "parabola")
    abch = [F.col(x) for x in "abch"]
    return f.select("cell", "ym", r4(flux.piece_max(*abch)).alias("top"), r4(flux.piece_min(*abch)).alias("low"), r4(flux.piece_peak(*abch)).alias("peak"))


@query("p15_piece_mean", f"WITH {SERIES}, {B.PPM} SELECT cell, ym, {q4('a * h * h / 3 + b * h / 2 + c')} AS mean, {q4('u')} AS u FROM f")
def _(spark, root):
    return fit(series(spark, root), "ppm").select("cell", "ym", r4(flux.piece_mean(*(F.col(x) for x in "abch"))).alias("mean"), r4("u").alias("u"))


_ENV = f"n AS (SELECT *, max(abs(u)) OVER (PARTITION BY cell ORDER BY ym ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS env FROM f)"


@query("w_neighbours", f"""WITH {SERIES} SELECT cell, ym, {q4('coalesce(lag(u) OVER w, u)')} AS prev, {q4('coalesce(lead(u) OVER w, u)')} AS next,
{q4('max(abs(u)) OVER (PARTITION BY cell ORDER BY ym ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING)')} AS env, {q4('avg(u) OVER (PARTITION BY cell ORDER BY ym ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING)')} AS smooth,
{q4('sum(u * h) OVER (PARTITION BY cell ORDER BY ym ROWS UNBOUNDED PRECEDING)', 2)} AS total, {q4('u - lag(u) OVER w')} AS step FROM s {W}""")
def _(spark, root):
    w, u = by_cell(), F.col("u")
    return series(spark, root).select("cell", "ym", r4(before(u, w)).alias("prev"), r4(after(u, w)).alias("next"), r4(envelope(u, w)).alias("env"), r4(moving_mean(u, w)).alias("smooth"), r4(cumulative(u * F.col("h"), w), 2).alias("total"), r4(step(u, w)).alias("step"))


@query("w7_window_weights", f"WITH {SERIES} SELECT cell, ym, {q4('avg(u) OVER (PARTITION BY cell ORDER BY ym ROWS BETWEEN 6 PRECEDING AND 6 FOLLOWING)')} AS mean, count(*) OVER (PARTITION BY cell ORDER BY ym ROWS BETWEEN 6 PRECEDING AND 6 FOLLOWING) AS n FROM s")
def _(spark, root):
    from gridloom.operators.windows import around

    x = series(spark, root).withColumn("x", around(F.col("u"), by_cell()))
    return x.select("cell", "ym", r4(F.aggregate("x", F.lit(0.0), lambda a, v: a + v) / F.size("x")).alias("mean"), F.size("x").cast("bigint").alias("n"))


@query("w12_tail_sweep", f"""WITH {SERIES}, {B.PPM}, b AS (SELECT *, row_number() OVER (PARTITION BY cell ORDER BY ym DESC) AS back FROM f)
SELECT k.k::INT AS k, {q4('quantile_cont(abs(c - u) / u, 0.5)')} AS median, count(*) AS n FROM b JOIN (SELECT unnest(generate_series(1, 12)) AS k) k ON back <= k.k GROUP BY 1""")
def _(spark, root):
    f = fit(series(spark, root), "ppm").withColumn("rel", F.abs(F.col("c") - F.col("u")) / F.col("u"))
    return tail_sweep(f, "cell", "ym", "rel").select("k", r4("median").alias("median"), "n")


@query("d1_overshoot", f"WITH {SERIES}, {B.PARABOLA}, {_ENV}, r AS (SELECT cell, {B.PEAK} / env AS ratio FROM n WHERE env > 1e-12) SELECT cell, {q4('quantile_cont(ratio, 0.5)')} AS p50, {q4('quantile_cont(ratio, 0.95)')} AS p95, {q4('quantile_cont(ratio, 0.99)')} AS p99, {q4('max(ratio)')} AS max, {q4('avg((ratio > 1.000000001)::INT)')} AS over_1, {q4('avg((ratio > 1.2)::INT)')} AS over_12, {q4('avg((ratio > 1.5)::INT)')} AS over_15 FROM r GROUP BY 1")
def _(spark, root):
    out = D.overshoot_summary(fit(series(spark, root), "parabola"), ("cell",))
    return out.select("cell", *(r4(c).alias(c) for c in out.columns if c != "cell"))


_SCORED = {"constant": B.CONSTANT, "minmod": B.MINMOD, "ppm": B.PPM}
_JOINT = f"j AS (SELECT *, abs({B.END} - lead(c) OVER w) AS jump, {B.PEAK} / env AS ratio, {B.TURNS} AS turns FROM n {W})"


@query("d2_scores", " UNION ALL ".join(f"""(WITH {SERIES}, {sql}, {_ENV}, {_JOINT} SELECT '{k}' AS fitter, {q4('max(ratio)')} AS max_overshoot, {q4('avg((ratio > 1.000000001)::INT)')} AS share_over, {q4('quantile_cont(jump / env, 0.5)')} AS jump_median, {q4('quantile_cont(jump / env, 0.99)')} AS jump_p99, {q4('avg((jump / env > 1e-9)::INT)')} AS share_discontinuous, {q4('avg(abs(a * h + b))')} AS gradient, {q4('avg(turns::INT)')} AS share_turning FROM j)""" for k, sql in _SCORED.items()))
def _(spark, root):
    out = D.scores(series(spark, root), tuple(_SCORED))
    return out.select("fitter", *(r4(c).alias(c) for c in out.columns if c != "fitter"))


@query("d3_joints", f"WITH {SERIES}, {B.PPM}, {_ENV} SELECT cell, ym, {q4(f'abs({B.END} - lead(c) OVER w)')} AS jump, {q4('abs(2 * a * h + b - lead(b) OVER w)')} AS slope_jump, {q4('abs(2 * a * h * h)')} AS curvature, {B.TURNS} AS turns FROM n {W}")
def _(spark, root):
    return D.joints(fit(series(spark, root), "ppm")).select("cell", "ym", r4("jump").alias("jump"), r4("slope_jump").alias("slope_jump"), r4("curvature").alias("curvature"), "turns")


def _at(f: str, share: float) -> str:
    return f"({f}.a * {share} * o.h * {share} * o.h + {f}.b * {share} * o.h + {f}.c)"


for _k, _sql in {"minmod": B.MINMOD, "ppm": B.PPM, "pchip": _PCHIP}.items():
    QUERIES[f"d4_footprint_{_k}"] = lambda spark, root, k=_k: D.footprint(series(spark, root), k).select("cell", F.col("months").cast("int").alias("months"))
    ORACLES[f"d4_footprint_{_k}"] = f"""WITH RECURSIVE {SERIES}, s2 AS (SELECT * REPLACE (CASE WHEN lead(ym) OVER w IS NULL THEN u * 1.10 ELSE u END AS u) FROM s {W}),
{B.over(_sql, 's', '_o')},
{B.over(_sql, 's2', '_n')},
x AS (SELECT cell, max(abs(u)) AS scale, max(ym) AS last FROM s GROUP BY 1)
SELECT cell, coalesce(max(last - ym) FILTER (greatest({', '.join(f"abs({_at('n', p)} - {_at('o', p)})" for p in (0.0, 0.5, 1.0))}) > 0.01 * scale), 0)::INT AS months FROM f_o o JOIN f_n n USING (cell, ym) JOIN x USING (cell) GROUP BY 1"""


@query("d5_residual", f"WITH {SERIES}, {B.PPM}, x AS (SELECT cell, abs(a * h * h / 3 + b * h / 2 + c - u) / abs(u) AS rel, lead(ym) OVER w IS NULL AS tail FROM f {W}) SELECT cell, max(rel) < 1e-9 AS preserved, count(*) AS pieces FROM x WHERE NOT tail GROUP BY 1")
def _(spark, root):
    return D.residual(fit(series(spark, root), "ppm")).groupBy("cell").agg((F.max("rel") < 1e-9).alias("preserved"), F.count("*").alias("pieces"))


@query("d6_continuity", f"WITH {SERIES}, {B.MINMOD}, x AS (SELECT abs({B.END} - lead(c) OVER w) AS jump FROM f {W}) SELECT {q4('max(jump)')} AS max_jump, {q4('quantile_cont(jump, 0.99)')} AS p99_jump FROM x")
def _(spark, root):
    return D.continuity(fit(series(spark, root), "minmod")).select(r4("max_jump").alias("max_jump"), r4("p99_jump").alias("p99_jump"))


@query("d7_sign_violations", f"WITH {SERIES}, {B.PARABOLA} SELECT count(*) FILTER (least(c, {B.END}, coalesce({B.VERTEX}, c)) < -1e-12) AS violations, count(*) AS pieces FROM f WHERE abs(u) > 0")
def _(spark, root):
    return D.sign_violations(fit(series(spark, root), "parabola"), 1)


_TRUTH = "tr AS (SELECT l_suppkey::INT AS cell, (year(l_shipdate) * 12 + month(l_shipdate) - 1)::INT AS ym, day(l_shipdate)::INT AS day, avg(l_extendedprice) AS truth FROM lineitem GROUP BY 1, 2, 3)"


def _truth(spark, root):
    from gridloom.functions.calendar import ym

    t = F.col("l_shipdate")
    return B.read(spark, root, "lineitem").groupBy(F.col("l_suppkey").cast("int").alias("cell"), ym(t).cast("int").alias("ym"), F.dayofmonth(t).alias("day")).agg(F.avg("l_extendedprice").alias("value"))


@query("d9_daily_fidelity", f"""WITH {SERIES}, {B.PPM}, {_ENV}, {_TRUTH}, d AS (SELECT f.cell, f.ym, day, truth, a * (day - 0.5) * (day - 0.5) + b * (day - 0.5) + c AS value FROM f JOIN tr USING (cell, ym)),
mo AS (SELECT cell, ym, sqrt(avg((value - truth) * (value - truth))) AS rmse FROM d GROUP BY 1, 2)
SELECT mo.cell, {q4('avg(rmse / env)')} AS mean, {q4('quantile_cont(rmse / env, 0.5)')} AS median, count(*) AS n FROM mo JOIN n ON n.cell = mo.cell AND n.ym = mo.ym GROUP BY 1""")
def _(spark, root):
    return D.fidelity(fit(series(spark, root), "ppm"), _truth(spark, root), ("cell",)).select("cell", r4("mean").alias("mean"), r4("median").alias("median"), "n")


@query("a35_variance_fraction", f"""WITH {SERIES}, {B.PPM}, {_TRUTH}, d AS (SELECT f.cell, f.ym, truth, a * (day - 0.5) * (day - 0.5) + b * (day - 0.5) + c AS value FROM f JOIN tr USING (cell, ym)),
mo AS (SELECT cell, ym, var_samp(value) / nullif(var_samp(truth), 0) AS x FROM d GROUP BY 1, 2) SELECT cell, {q4('avg(x)')} AS variance_fraction FROM mo GROUP BY 1""")
def _(spark, root):
    return D.fidelity(fit(series(spark, root), "ppm"), _truth(spark, root), ("cell",)).select("cell", r4("variance_fraction").alias("variance_fraction"))


@query("d12_structural_band", f"WITH {SERIES}, {B.MINMOD}, f1 AS (SELECT cell, ym, a * h * h / 4 + b * h / 2 + c AS v FROM f), {B.PPM.replace('f AS (', 'g AS (')}, f2 AS (SELECT cell, ym, a * h * h / 4 + b * h / 2 + c AS v FROM g) SELECT cell, ym, {q4('abs(f1.v - f2.v)')} AS band FROM f1 JOIN f2 USING (cell, ym)")
def _(spark, root):
    return D.structural_band(series(spark, root), ("minmod", "ppm")).select("cell", "ym", r4("band").alias("band"))


@query("d14_heterogeneity", f"WITH {SERIES} SELECT cell % 10 AS grp, ym, {q4('stddev_samp(u) / abs(avg(u))')} AS spread, count(*) AS n FROM s GROUP BY 1, 2")
def _(spark, root):
    out = D.heterogeneity(series(spark, root).withColumn("grp", F.col("cell") % 10), "u", ("grp", "ym"))
    return out.select("grp", "ym", r4("spread").alias("spread"), "n")


@query("d15_range_sweep")
def _(spark, root):
    return D.range_sweep(series(spark, root), (1.0, 1.5, 3.0)).select("range", r4("variance", 2).alias("variance"), r4("roughness", 2).alias("roughness"))


@query("d16_flat_rate", f"WITH {SERIES}, {B.PPM} SELECT cell, {q4('count(*) FILTER (a = 0 AND b = 0) / count(*)::DOUBLE')} AS flat FROM f GROUP BY 1")
def _(spark, root):
    return D.flat_rate(fit(series(spark, root), "ppm"), ("cell",)).select("cell", r4("flat").alias("flat"))


@query("d17_discontinuity", f"WITH {SERIES}, {B.MINMOD}, {_ENV}, x AS (SELECT abs({B.END} - lead(c) OVER w) / env AS rel, abs(b) * h AS rise, u FROM n {W}) SELECT {q4('quantile_cont(rel, 0.5)')} AS p50, {q4('quantile_cont(rel, 0.95)')} AS p95, {q4('sum(rise) / sum(abs(u))')} AS l1 FROM x")
def _(spark, root):
    j = D.joints(fit(series(spark, root), "minmod"))
    rel = F.col("jump") / F.col("env")
    out = exact_quantiles(j, rel, {"p50": 0.5, "p95": 0.95}, also=((F.sum(F.abs("b") * F.col("h")) / F.sum(F.abs("u"))).alias("l1"),))
    return out.select(*(r4(c).alias(c) for c in ("p50", "p95", "l1")))


@query("d10_bootstrap", f"WITH {B.MONTHLY}, {B.bootstrap('m', 'cell')}")
def _(spark, root):
    out = D.poisson_bootstrap(monthly(spark, root), "u", "cell")
    return out.select(*(r4(c, 2).alias(c) for c in out.columns))


@query("d11_spectrum", f"""WITH {SERIES}, x AS (SELECT cell, u - avg(u) OVER (PARTITION BY cell) AS x, row_number() OVER w - 1 AS j, count(*) OVER (PARTITION BY cell) AS n FROM s {W}),
p AS (SELECT cell, n, k.k, sum(x * cos(2 * pi() * k.k * j / n)) AS re, sum(x * sin(2 * pi() * k.k * j / n)) AS im FROM x JOIN range(10000) k(k) ON k.k <= n // 2 GROUP BY 1, 2, 3)
SELECT cell, {q4('k::DOUBLE / n')} AS frequency, {q4('(re * re + im * im) / n', 0)} AS power FROM p""")
def _(spark, root):
    return D.spectrum(series(spark, root), "u").select("cell", r4("frequency").alias("frequency"), r4("power", 0).alias("power"))


@query("d24_kriging_coherence")
def _(spark, root):
    x = series(spark, root)
    f = fit(x, "atpk")
    rel = F.abs(flux.piece_mean(*(F.col(x) for x in "abch")) - F.col("u")) / F.abs("u")
    own = f.groupBy("cell").agg((F.max(rel) < 1e-9).alias("coherent"), (F.min("var") >= 0).alias("variance_ok"), F.count_if(flux.piece_min(*(F.col(x) for x in "abch")) < -1e-9).alias("wrong_sign"))
    return own.join(D.kriging_against(f, fit(x, "pchip")), "cell").select("cell", "coherent", "variance_ok", "wrong_sign", r4("rms").alias("rms"), r4("band").alias("band"))


@query("d22_binomial", f"""WITH {SERIES}, x AS (SELECT cell, count(*) FILTER (d > 0) AS k, count(*) AS n FROM (SELECT cell, u - lag(u) OVER w AS d FROM s {W}) WHERE d IS NOT NULL GROUP BY 1),
p AS (SELECT cell, n, k, i.i, exp(lgamma(n + 1) - lgamma(i.i + 1) - lgamma(n - i.i + 1) + n * ln(0.5)) AS p, exp(lgamma(n + 1) - lgamma(k + 1) - lgamma(n - k + 1) + n * ln(0.5)) AS own FROM x JOIN range(1000) i(i) ON i.i <= n)
SELECT cell, any_value(k) AS rises, any_value(n) AS steps, {q4('least(sum(p) FILTER (p <= own * (1 + 1e-9)), 1)')} AS p FROM p GROUP BY 1""")
def _(spark, root):
    steps = series(spark, root).withColumn("d", step(F.col("u"), by_cell())).filter("d IS NOT NULL")
    x = steps.groupBy("cell").agg(F.count_if(F.col("d") > 0).alias("rises"), F.count("*").alias("steps"))
    return x.select("cell", "rises", "steps", r4(D.binomial(F.col("rises"), F.col("steps"))).alias("p"))


@query("p16_monthly_sd", f"SELECT l_suppkey::INT AS cell, (year(l_shipdate) * 12 + month(l_shipdate) - 1)::INT AS ym, {q4('sqrt(var_samp(l_extendedprice) + var_samp(l_quantity)) / 12')} AS sd FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def _(spark, root):
    from gridloom.functions.calendar import ym

    x = B.read(spark, root, "lineitem").groupBy(F.col("l_suppkey").cast("int").alias("cell"), ym(F.col("l_shipdate")).cast("int").alias("ym")).agg(F.var_samp("l_extendedprice").alias("x"), F.var_samp("l_quantity").alias("y"), F.count("*").alias("n"))
    return x.filter("n > 1").select("cell", "ym", r4(flux.monthly_sd(F.col("x"), F.col("y"))).alias("sd"))
