"""Registration of queries with their DuckDB SQL, and the pieces of SQL that several share."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from gridloom.operators.series import filled, with_knots
from gridloom.plans.diagnostics import POISSON
from gridloom.sources.tables import monthly, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

#: Added before rounding: means of cents lie on decimal ties, which engines break differently.
NUDGE = 1e-7


def query(name: str, sql: str | None = None):
    def add(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return add


def r4(x: Column | str, digits: int = 4) -> Column:
    return F.round((F.col(x) if isinstance(x, str) else x) + NUDGE, digits)


def q4(x: str, digits: int = 4) -> str:
    return f"round(({x}) + {NUDGE}, {digits})"


def series(spark: SparkSession, root: str) -> DataFrame:
    """Monthly means by supplier on the whole calendar, gaps from the climatology, with knots."""
    return with_knots(filled(monthly(spark, root)))


def read(spark: SparkSession, root: str, name: str) -> DataFrame:
    return table(spark, root, name)


MONTHLY = "m AS (SELECT l_suppkey::INT AS cell, (year(l_shipdate) * 12 + month(l_shipdate) - 1)::INT AS ym, avg(l_extendedprice) AS u, avg(l_quantity) AS v FROM lineitem GROUP BY 1, 2)"
SERIES = MONTHLY + """,
ax AS (SELECT unnest(generate_series((SELECT min(ym) FROM m), (SELECT max(ym) FROM m)))::INT AS ym),
kn AS (SELECT ym, (d - DATE '1970-01-01')::DOUBLE AS t0, day(last_day(d))::DOUBLE AS h FROM (SELECT ym, make_date((ym // 12)::INT, (ym % 12 + 1)::INT, 1) AS d FROM ax)),
fr AS (SELECT cell, ym FROM (SELECT DISTINCT cell FROM m), ax),
cl AS (SELECT cell, ym % 12 AS month, avg(u) AS u, avg(v) AS v FROM m GROUP BY 1, 2),
s AS (SELECT fr.cell, fr.ym, coalesce(m.u, cl.u) AS u, coalesce(m.v, cl.v) AS v, m.u IS NULL AS from_clim, kn.t0, kn.h
  FROM fr LEFT JOIN m USING (cell, ym) LEFT JOIN cl ON cl.cell = fr.cell AND cl.month = fr.ym % 12 JOIN kn ON kn.ym = fr.ym)"""


def minmod(x: str, y: str) -> str:
    return f"(0.5 * (sign({x}) + sign({y})) * least(abs({x}), abs({y})))"


def minmod3(x: str, y: str, z: str) -> str:
    return f"(CASE WHEN sign({x}) = sign({y}) AND sign({x}) = sign({z}) THEN sign({x}) * least(abs({x}), abs({y}), abs({z})) ELSE 0 END)"


#: f(s): relations l1.., ending in one named ``f`` with a, b, c added to the series s.
W = "WINDOW w AS (PARTITION BY cell ORDER BY ym)"


def linear(limiter: Callable[[str, str], str] = minmod) -> str:
    return f"""l1 AS (SELECT *, (u - lag(u) OVER w) / ((t0 + h / 2) - lag(t0 + h / 2) OVER w) AS lf FROM s {W}),
l2 AS (SELECT *, lead(lf) OVER w AS rt FROM l1 {W}),
l3 AS (SELECT *, CASE WHEN lf IS NULL OR rt IS NULL THEN 0 ELSE {limiter('lf', 'rt')} END AS b FROM l2),
f AS (SELECT cell, ym, t0, h, u, 0.0 AS a, b, u - b * h / 2 AS c FROM l3)"""


EDGES = f"""p1 AS (SELECT *, coalesce(lag(u) OVER w, u) AS lo, coalesce(lead(u) OVER w, u) AS hi, lag(u) OVER w IS NULL OR lead(u) OVER w IS NULL AS ends FROM s {W}),
p2 AS (SELECT *, {minmod3('((hi - lo) / 2)', '(2 * (u - lo))', '(2 * (hi - u))')} AS dm FROM p1),
p3 AS (SELECT *, u + (hi - u) / 2 - (coalesce(lead(dm) OVER w, dm) - dm) / 6 AS edge FROM p2 {W}),
p4 AS (SELECT *, CASE WHEN ends THEN u ELSE lag(edge) OVER w END AS l, CASE WHEN ends THEN u ELSE edge END AS r FROM p3 {W})"""
PARABOLA = EDGES + ",\nf AS (SELECT cell, ym, t0, h, u, -6 * (u - (l + r) / 2) / (h * h) AS a, (r - l + 6 * (u - (l + r) / 2)) / h AS b, l AS c FROM p4)"
PPM = EDGES + """,
p5 AS (SELECT *, (r - u) * (u - l) <= 0 AS flat, (r - l) * (u - (l + r) / 2) AS over, (r - l) * (r - l) / 6 AS lim FROM p4),
p6 AS (SELECT *, CASE WHEN flat THEN u WHEN over > lim THEN 3 * u - 2 * r ELSE l END AS nl, CASE WHEN flat THEN u WHEN -lim > over THEN 3 * u - 2 * l ELSE r END AS nr FROM p5),
f AS (SELECT cell, ym, t0, h, u, -6 * (u - (nl + nr) / 2) / (h * h) AS a, (nr - nl + 6 * (u - (nl + nr) / 2)) / h AS b, nl AS c FROM p6)"""
STEFFEN = f"""t1 AS (SELECT *, CASE WHEN avg(u) OVER (PARTITION BY cell) < 0 THEN -1.0 ELSE 1.0 END AS sg FROM s),
t2 AS (SELECT *, sg * u AS x, lag(sg * u) OVER w AS x0, lag(h) OVER w AS h0 FROM t1 {W}),
t3 AS (SELECT *, coalesce((sign(x0) + sign(x)) * least(abs(x0), abs(x), 0.5 * abs((x0 * h + x * h0) / (h0 + h))), x) AS m0 FROM t2),
t4 AS (SELECT *, coalesce(lead(m0) OVER w, x) AS m1 FROM t3 {W}),
f AS (SELECT cell, ym, t0, h, u, sg * (-6 * x + 3 * m0 + 3 * m1) / (h * h) AS a, sg * (6 * x - 4 * m0 - 2 * m1) / h AS b, sg * m0 AS c FROM t4)"""
TRAPEZOID = f"""z1 AS (SELECT *, row_number() OVER w - 1 AS k, first_value(u) OVER w AS u0 FROM s {W}),
z2 AS (SELECT *, CASE WHEN k % 2 = 0 THEN 1.0 ELSE -1.0 END AS sg FROM z1),
z3 AS (SELECT *, sg * (u0 - 2 * coalesce(sum(sg * u) OVER (PARTITION BY cell ORDER BY ym ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS y FROM z2),
f AS (SELECT cell, ym, t0, h, u, 0.0 AS a, (2 * u - 2 * y) / h AS b, y AS c FROM z3)"""
CONSTANT = "f AS (SELECT cell, ym, t0, h, u, 0.0 AS a, 0.0 AS b, u AS c FROM s)"
VAN_LEER = linear(lambda x, y: f"(CASE WHEN {x} * {y} > 0 THEN 2 * {x} * {y} / ({x} + {y}) ELSE 0 END)")
MC = linear(lambda x, y: minmod3(f"(({x} + {y}) / 2)", f"(2 * {x})", f"(2 * {y})"))
SUPERBEE = linear(lambda x, y: f"(CASE WHEN abs({minmod(f'(2 * {x})', y)}) > abs({minmod(x, f'(2 * {y})')}) THEN {minmod(f'(2 * {x})', y)} ELSE {minmod(x, f'(2 * {y})')} END)")
MINMOD = linear()

def poisson(key: str) -> str:
    """A Poisson(1) draw that the key alone decides."""
    u = f"(('0x' || substr(md5({key}), 1, 10))::BIGINT / 1099511627776.0)"
    return "(" + " + ".join(f"({u} > {c!r})::INT" for c in POISSON) + ")"


def bootstrap(source: str, unit: str) -> str:
    """Interval of the mean of u under resampling of units, 200 times."""
    return f"""bl AS (SELECT {unit} AS unit, sum(u) AS s, count(u) AS n FROM {source} GROUP BY 1),
dr AS (SELECT r, s, n, {poisson("concat_ws(':', 42, unit, r)")} AS w FROM bl, range(1, 201) k(r)),
me AS (SELECT sum(w * s) / nullif(sum(w * n), 0) AS m FROM dr GROUP BY r)
SELECT {q4('quantile_cont(m, 0.025)', 2)} AS low, {q4('quantile_cont(m, 0.5)', 2)} AS median, {q4('quantile_cont(m, 0.975)', 2)} AS high FROM me"""


def thomas(eq: str, out: str, rhs: tuple[str, ...]) -> str:
    """Relations that solve the tridiagonal systems of eq(cell, k, low, mid, up, rhs..), k from 1: out(cell, k, rhs..)."""
    cols = ", ".join(rhs)
    e = ", ".join(f"e.{r} - e.low / p.mid * p.{r}" for r in rhs)
    first = ", ".join(f"{r} / mid AS {r}" for r in rhs)
    back = ", ".join(f"(p.{r} - p.up * o.{r}) / p.mid" for r in rhs)
    return f"""{eq}_fwd(cell, k, mid, up, {cols}) AS (SELECT cell, k, mid, up, {cols} FROM {eq} WHERE k = 1
  UNION ALL SELECT e.cell, e.k, e.mid - e.low / p.mid * p.up, e.up, {e} FROM {eq}_fwd p JOIN {eq} e ON e.cell = p.cell AND e.k = p.k + 1),
{out}(cell, k, {cols}) AS (SELECT cell, k, {first} FROM (SELECT *, max(k) OVER (PARTITION BY cell) AS last FROM {eq}_fwd) WHERE k = last
  UNION ALL SELECT p.cell, p.k, {back} FROM {out} o JOIN {eq}_fwd p ON p.cell = o.cell AND p.k = o.k - 1)"""


def of_slopes(knots: str) -> str:
    """f from knot values y of ``knots``(cell, k, y), k from 0, and pieces q."""
    return f"f AS (SELECT q.cell, ym, t0, h, u, (3 * (l.y + r.y) - 6 * u) / (h * h) AS a, (6 * u - 4 * l.y - 2 * r.y) / h AS b, l.y AS c FROM q JOIN {knots} l ON l.cell = q.cell AND l.k = q.k - 1 JOIN {knots} r ON r.cell = q.cell AND r.k = q.k)"


PIECES = f"q AS (SELECT *, row_number() OVER w AS k, count(*) OVER (PARTITION BY cell) AS n, lead(h) OVER w AS hn, lead(u) OVER w AS un FROM s {W})"
HISTOSPLINE = PIECES + f""",
hq AS (SELECT cell, k, 1 / lag(h) OVER w AS low, CASE WHEN k = 1 THEN 2 / h ELSE 2 / lag(h) OVER w + 2 / h END AS mid, 1 / h AS up, CASE WHEN k = 1 THEN 3 * u / h ELSE 3 * (lag(u) OVER w / lag(h) OVER w + u / h) END AS y FROM q {W}
  UNION ALL SELECT cell, n + 1, 1 / h, 2 / h, 0, 3 * u / h FROM q WHERE k = n),
{thomas('hq', 'hs', ('y',))},
hk AS (SELECT cell, k - 1 AS k, y FROM hs),
""" + of_slopes("hk")
#: Knot values are linear in the two end values: three right-hand sides, then the ends by least squares of the jumps in curvature.
PIQS = PIECES + f""",
pq AS (SELECT cell, k, hn AS low, 2 * (h + hn) AS mid, h AS up, CASE WHEN k = 1 THEN -hn ELSE 0.0 END AS r0, CASE WHEN k = n - 1 THEN -h ELSE 0.0 END AS r1, 3 * (h * un + hn * u) AS r2 FROM q WHERE k < n),
{thomas('pq', 'ps', ('r0', 'r1', 'r2'))},
pk AS (SELECT cell, k, r0, r1, r2 FROM ps UNION ALL SELECT cell, 0, 1, 0, 0 FROM q WHERE k = 1 UNION ALL SELECT cell, n, 0, 1, 0 FROM q WHERE k = n),
pp AS (SELECT q.cell, 1 / (h * h * h) AS wt, 2 * u AS uu, x.r0 + y.r0 AS c0, x.r1 + y.r1 AS c1, x.r2 + y.r2 AS c2 FROM q JOIN pk x ON x.cell = q.cell AND x.k = q.k - 1 JOIN pk y ON y.cell = q.cell AND y.k = q.k),
pn AS (SELECT cell, sum(wt * c0 * c0) AS n00, sum(wt * c0 * c1) AS n01, sum(wt * c1 * c1) AS n11, sum(wt * c0 * (uu - c2)) AS b0, sum(wt * c1 * (uu - c2)) AS b1 FROM pp GROUP BY 1),
pe AS (SELECT cell, (b0 * n11 - n01 * b1) / (n00 * n11 - n01 * n01) AS y0, (n00 * b1 - n01 * b0) / (n00 * n11 - n01 * n01) AS yn FROM pn),
pv AS (SELECT pk.cell, k, r0 * y0 + r1 * yn + r2 AS y FROM pk JOIN pe USING (cell)),
""" + of_slopes("pv")


def over(sql: str, source: str, suffix: str) -> str:
    """The relations of a fit over another series than s, each with ``suffix`` to its name."""
    names = set(re.findall(r"(?:^|,\n)\s*(\w+)(?:\([\w, ]*\))? AS \(", sql))
    return re.sub(r"\b(\w+)\b(?!\s*=)", lambda m: source if m[1] == "s" else m[1] + suffix if m[1] in names else m[1], sql)


#: Value at the right end, at an interior extremum (or NULL), and the largest magnitude of a piece.
END = "(a * h * h + b * h + c)"
VERTEX = "(CASE WHEN a <> 0 AND -b / (2 * a) > 0 AND -b / (2 * a) < h THEN c - b * b / (4 * a) END)"
TURNS = "coalesce(a <> 0 AND -b / (2 * a) > 1e-9 * h AND -b / (2 * a) < (1 - 1e-9) * h, false)"
PEAK = f"greatest(abs(c), abs{END}, coalesce(abs{VERTEX}, 0))"
HOURLY = "e AS (SELECT event_type AS cell, date_trunc('hour', ts) AS ts, avg(value) AS value FROM events GROUP BY 1, 2)"
REGIONAL = "g AS (SELECT n_nationkey::INT AS cell, (year(o_orderdate) * 12 + month(o_orderdate) - 1)::INT AS ym, avg(o_totalprice) AS u, n_nationkey * 7.25 - 88 AS lat FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2, 4)"
