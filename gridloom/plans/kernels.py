"""Fits of whole series, in numpy: what a window cannot say (scans, linear systems, quadratic programs).

Each takes piece widths h and means u and gives a, b, c (kriging a variance as well). Cells are independent: tasks
stream through them in Arrow batches.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

Fit = tuple[np.ndarray, np.ndarray, np.ndarray]

#: Fixed values, which results depend on: points of a piece at which the constrained smoothing keeps its sign; range (in
#: months), nugget, points a month and months to each side of kriging; values a piece and rounds of the bounded iteration.
SIGN_POINTS = 8
RANGE_MONTHS, NUGGET, POINTS, REACH = 1.5, 1e-3, 6, 6
VALUES_A_PIECE, ROUNDS = 30, 100


def _of_slopes(h: np.ndarray, u: np.ndarray, m: np.ndarray) -> Fit:
    """Derivative of the cubic Hermite on the cumulative integral with slopes m at the knots."""
    left, right = m[:-1], m[1:]
    return (3 * (left + right) - 6 * u) / h**2, (6 * u - 4 * left - 2 * right) / h, left.copy()


def _signed(u: np.ndarray) -> float:
    return -1.0 if u.mean() < 0 else 1.0


def monotone_slopes(u: np.ndarray) -> np.ndarray:
    """Fritsch-Carlson slopes from secants u: a left-to-right pass pulls pairs into the monotone circle."""
    m = np.concatenate([u[:1], (u[:-1] + u[1:]) / 2, u[-1:]])
    for k, s in enumerate(u):
        if s == 0:
            m[k] = m[k + 1] = 0.0
            continue
        alpha, beta = m[k] / s, m[k + 1] / s
        reach = np.hypot(alpha, beta)
        if reach > 3:
            m[k], m[k + 1] = 3 * s * alpha / reach, 3 * s * beta / reach
    return m


def pchip(h: np.ndarray, u: np.ndarray) -> Fit:
    """Monotone cubic on the cumulative integral."""
    s = _signed(u)
    return tuple(s * x for x in _of_slopes(h, s * u, monotone_slopes(s * u)))


def _tridiagonal(low: np.ndarray, mid: np.ndarray, up: np.ndarray, rhs: np.ndarray) -> np.ndarray:
    """Thomas's elimination; rhs may hold several columns."""
    mid, rhs = mid.astype(float).copy(), rhs.astype(float).copy()
    for i in range(1, len(mid)):
        z = low[i] / mid[i - 1]
        mid[i] -= z * up[i - 1]
        rhs[i] -= z * rhs[i - 1]
    out = np.empty_like(rhs)
    out[-1] = rhs[-1] / mid[-1]
    for i in range(len(mid) - 2, -1, -1):
        out[i] = (rhs[i] - up[i] * out[i + 1]) / mid[i]
    return out


def piqs(h: np.ndarray, u: np.ndarray) -> Fit:
    """Integral quadratic spline: continuous, smooth inside, end values that make the least jump in curvature.

    Knot values are linear in the two end values; three right-hand sides give that map, a 2x2 system the ends.
    """
    n = len(u)
    if n < 3:
        raise ValueError("an integral quadratic spline needs three pieces")
    rhs = np.zeros((n - 1, 3))
    rhs[0, 0], rhs[-1, 1] = -h[1], -h[-2]
    rhs[:, 2] = 3 * (h[:-1] * u[1:] + h[1:] * u[:-1])
    inner = _tridiagonal(h[1:], 2 * (h[:-1] + h[1:]), h[:-1], rhs)
    knots = np.vstack([[1.0, 0.0, 0.0], inner, [0.0, 1.0, 0.0]])
    pair = knots[:-1] + knots[1:]
    weight = 1 / h**3
    normal = (pair[:, :2] * weight[:, None]).T @ pair[:, :2]
    y0, yn = np.linalg.solve(normal, (pair[:, :2] * weight[:, None]).T @ (2 * u - pair[:, 2]))
    y = knots @ np.array([y0, yn, 1.0])
    return _of_slopes(h, u, y)


def _quadratic_program(g: np.ndarray, linear: np.ndarray, rows: np.ndarray, least: np.ndarray, rounds: int = 400) -> np.ndarray | None:
    """min x'gx/2 - linear'x with rows x >= least, g positive definite: the dual active-set method (Goldfarb-Idnani)."""
    inv = np.linalg.inv(g)
    x = inv @ linear
    active: list[int] = []
    lam = np.zeros(0)
    scale = 1e-11 * (1 + np.abs(least).max(initial=0) + np.abs(rows @ x).max(initial=0))
    for _ in range(rounds):
        slack = rows @ x - least
        if active:
            slack[active] = 0
        p = int(np.argmin(slack))
        if slack[p] >= -scale:
            return x
        new = 0.0
        while True:
            n_p = rows[p]
            if active:
                a = rows[active]
                small = a @ inv @ a.T
                try:
                    r = np.linalg.solve(small, a @ inv @ n_p)
                except np.linalg.LinAlgError:
                    return None
                z = inv @ (n_p - a.T @ r)
            else:
                r, z = np.zeros(0), inv @ n_p
            falling = np.flatnonzero(r > 1e-14)
            t1 = min(((lam[k] / r[k], k) for k in falling), default=(np.inf, -1))
            curve = float(z @ n_p)
            t2 = (least[p] - n_p @ x) / curve if curve > 1e-14 * float(n_p @ inv @ n_p) else np.inf
            t = min(t1[0], t2)
            if not np.isfinite(t):
                return None
            if np.isfinite(t2):
                x = x + t * z
            lam, new = lam - t * r, new + t
            if t == t2:
                active.append(p)
                lam = np.append(lam, new)
                break
            k = t1[1]
            active.pop(k)
            lam = np.delete(lam, k)
    return None


def mss(h: np.ndarray, u: np.ndarray, tests: int = SIGN_POINTS) -> Fit:
    """Smoothest cubic on the cumulative integral whose derivative keeps its sign at test points.

    A quadratic program in the knots' slopes; where it cannot be solved the monotone cubic stands in.
    """
    n, s = len(u), _signed(u)
    v = s * u
    unit = h.mean()
    w = h / unit
    g = np.zeros((n + 1, n + 1))
    k = np.arange(n)
    np.add.at(g, (k, k), 8 / w)
    np.add.at(g, (k + 1, k + 1), 8 / w)
    np.add.at(g, (k, k + 1), 4 / w)
    np.add.at(g, (k + 1, k), 4 / w)
    linear = np.zeros(n + 1)
    np.add.at(linear, k, 12 * v / w)
    np.add.at(linear, k + 1, 12 * v / w)
    at = (np.arange(tests) + 0.5) / tests
    rows = np.zeros((n * tests + 2, n + 1))
    own = np.arange(n * tests)
    rows[own, own // tests] = np.tile(3 * at**2 - 4 * at + 1, n)
    rows[own, own // tests + 1] = np.tile(3 * at**2 - 2 * at, n)
    rows[-2, 0] = rows[-1, -1] = 1
    least = np.append(-np.repeat(v, tests) * np.tile(6 * at - 6 * at**2, n), [0.0, 0.0])
    size = np.abs(v).max()
    m = _quadratic_program(g + 1e-12 * np.eye(n + 1), linear / size, rows, least / size)
    m = monotone_slopes(v) if m is None else m * size
    return tuple(s * x for x in _of_slopes(h, v, m))


def kriging_weights(m: int, p: int, points: int = POINTS, range_: float = RANGE_MONTHS, nugget: float = NUGGET) -> tuple[np.ndarray, np.ndarray]:
    """Area-to-point kriging in a window of m months: weights (m, points) for month p's points, and unit variances.

    They depend on the geometry only, so one set serves every cell.
    """
    t = (np.arange(m * points) + 0.5) / points
    cov = np.exp(-np.abs(t[:, None] - t) / range_) + nugget * np.eye(m * points)
    mean = np.kron(np.eye(m), np.full((1, points), 1 / points))
    to_point = mean @ cov[:, p * points : (p + 1) * points]
    system = np.ones((m + 1, m + 1))
    system[:m, :m], system[m, m] = mean @ cov @ mean.T, 0
    both = np.linalg.solve(system, np.vstack([to_point, np.ones(points)]))
    return both[:m], np.maximum(1 + nugget - (to_point * both[:m]).sum(0) - both[m], 0)


def all_kriging_weights(n: int, reach: int = REACH, **kw) -> list[tuple[int, int, np.ndarray, np.ndarray]]:
    """For each of n months: window, weights and variances; equal geometries are solved once."""
    known: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}
    out = []
    for i in range(n):
        lo, hi = max(0, i - reach), min(n, i + reach + 1)
        key = hi - lo, i - lo
        if key not in known:
            known[key] = kriging_weights(*key, **kw)
        out.append((lo, hi, *known[key]))
    return out


def points_to_quadratic(z: np.ndarray, h: np.ndarray, u: np.ndarray, sign: float) -> Fit:
    """Least-squares quadratic through each piece's points with the piece's mean exact; flat where it would change sign."""
    points = z.shape[1]
    s = (np.arange(points) + 0.5) / points
    x = np.stack([s * s, s, np.ones(points)], 1)
    inv = np.linalg.inv(x.T @ x)
    g = np.array([1 / 3, 1 / 2, 1.0])
    free = z @ x @ inv
    beta = free + ((u - free @ g) / (g @ inv @ g))[:, None] * (inv @ g)
    a, b, c = beta.T
    if sign:
        with np.errstate(divide="ignore", invalid="ignore"):
            at = -b / (2 * a)
            turn = np.where((a != 0) & (at > 0) & (at < 1), c - b * b / (4 * a), c)
        wrong = np.minimum.reduce([sign * c, sign * (a + b + c), sign * turn]) < -1e-12 * np.abs(u)
        a, b, c = np.where(wrong, 0, a), np.where(wrong, 0, b), np.where(wrong, u, c)
    return a / h**2, b / h, c


def kriged(h: np.ndarray, u: np.ndarray, weights=None, positive: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Area-to-point kriging over windows of months: a, b, c and each piece's variance."""
    n = len(u)
    sill = u.var(ddof=1) if n > 1 else 0.0
    if not sill > 0:
        return np.zeros(n), np.zeros(n), u.copy(), np.zeros(n)
    weights = weights or all_kriging_weights(n)
    z = np.stack([lam.T @ u[lo:hi] for lo, hi, lam, _ in weights])
    z += (u - z.mean(1))[:, None]
    var = sill * np.array([v.mean() for *_, v in weights])
    sign = (_signed(u) if positive else 0.0)
    return *points_to_quadratic(z, h, u, sign), var


def positive_points(z: np.ndarray, u: np.ndarray, sign: float, rounds: int = 500) -> np.ndarray:
    """Nearest points with every month's mean kept and no wrong sign: alternating projections. z: (months, points)."""
    for _ in range(rounds):
        before = z
        z = np.where(sign * z < 0, 0.0, z)
        z = z + (u - z.mean(1))[:, None]
        if np.abs(z - before).max() < 1e-14 * (abs(u.mean()) + 1e-30):
            break
    return z


def histospline(h: np.ndarray, u: np.ndarray) -> Fit:
    """Derivative of the natural cubic spline on the cumulative integral."""
    n = len(u)
    low = np.append(1 / h, 0.0)
    mid = np.concatenate([[2 / h[0]], 2 / h[:-1] + 2 / h[1:], [2 / h[-1]]])
    rhs = np.concatenate([[3 * u[0] / h[0]], 3 * (u[:-1] / h[:-1] + u[1:] / h[1:]), [3 * u[-1] / h[-1]]])
    m = _tridiagonal(np.concatenate([[0.0], 1 / h]), mid, low[:n], rhs)
    return _of_slopes(h, u, m)


def bounded_iterative(u: np.ndarray, per_piece: int = VALUES_A_PIECE, rounds: int = ROUNDS, upper: float | None = None) -> np.ndarray:
    """Smooth, restore means, clip, again and again: (pieces, per_piece) values."""
    y = np.repeat(u, per_piece).astype(float)
    for _ in range(rounds):
        smooth = y.copy()
        smooth[1:-1] = (y[:-2] + y[1:-1] + y[2:]) / 3
        smooth[0], smooth[-1] = (y[0] + y[1]) / 2, (y[-2] + y[-1]) / 2
        grid = smooth.reshape(len(u), per_piece)
        grid = grid + (u - grid.mean(1))[:, None]
        y = grid.ravel() if upper is None else np.minimum(grid.ravel(), upper)
    return y.reshape(len(u), per_piece)


KERNELS: dict[str, Callable[[np.ndarray, np.ndarray], Fit]] = {"pchip": pchip, "piqs": piqs, "mss": mss, "atpk": lambda h, u: kriged(h, u)[:3], "histospline": histospline}


def many_monotone_slopes(u: np.ndarray) -> np.ndarray:
    """monotone_slopes of every row of u at once: the pass goes over pieces, each step over all rows."""
    m = np.concatenate([u[:, :1], (u[:, :-1] + u[:, 1:]) / 2, u[:, -1:]], axis=1)
    for k in range(u.shape[1]):
        s = u[:, k]
        still = s == 0
        safe = np.where(still, 1.0, s)
        alpha, beta = m[:, k] / safe, m[:, k + 1] / safe
        reach = np.hypot(alpha, beta)
        pull = np.where(reach > 3, 3 / np.maximum(reach, 3), 1.0)
        m[:, k] = np.where(still, 0.0, np.where(reach > 3, safe * alpha * pull, m[:, k]))
        m[:, k + 1] = np.where(still, 0.0, np.where(reach > 3, safe * beta * pull, m[:, k + 1]))
    return m


def many_pchip(h: np.ndarray, u: np.ndarray) -> Fit:
    """pchip of every row."""
    s = np.where(u.mean(1, keepdims=True) < 0, -1.0, 1.0)
    v = s * u
    m = many_monotone_slopes(v)
    left, right = m[:, :-1], m[:, 1:]
    return s * (3 * (left + right) - 6 * v) / h**2, s * (6 * v - 4 * left - 2 * right) / h, s * left


#: Kernels that take many records of one length at once.
TOGETHER = {"pchip": many_pchip}
HELD_ROWS = 200_000


def fitted(table: pa.Table, key: str, kernel: str) -> pa.Table:
    """a, b, c (and var) for whole cells, in order of key and time."""
    n, at = table.num_rows, cells_of(table, key)
    h, u = table.column("h").to_numpy(), table.column("u").to_numpy()
    out = np.zeros((4 if kernel == "atpk" else 3, n))
    weights: dict[int, list] = {}
    length = np.diff(at)
    for size in np.unique(length):
        start = at[:-1][length == size]
        rows = start[:, None] + np.arange(size)
        live = np.any(u[rows] != 0, axis=1)  # a silent record keeps zeros
        rows = rows[live]
        if kernel in TOGETHER and len(rows):
            for x, values in zip(out, TOGETHER[kernel](h[rows], u[rows])):
                x[rows] = values
            continue
        for own in rows:
            if kernel == "atpk":
                weights.setdefault(size, all_kriging_weights(int(size)))
                values = kriged(h[own], u[own], weights[size])
            else:
                values = KERNELS[kernel](h[own], u[own])
            for x, v in zip(out, values):
                x[own] = v
    for name, x in zip(("a", "b", "c", "var"), out):
        table = table.append_column(name, pa.array(x))
    return table


def by_whole_cells(rows: DataFrame, key: str, f: Callable[[pa.Table], pa.Table], schema: str, order: str = "ym", rows_at_once: int = HELD_ROWS) -> DataFrame:
    """Apply f to tables of whole cells in order of key and time.

    One shuffle and sort by cell; a task streams through its cells some hundreds at a time, and holds no more.
    """

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) < rows_at_once:
                continue
            table = pa.Table.from_batches(held)
            k = table.column(key).combine_chunks()
            last = pc.index(k, k[-1]).as_py()  # the last cell may go on in the next batch
            if last:
                yield from f(table.slice(0, last)).combine_chunks().to_batches()
            held = table.slice(last).to_batches()
        if held:
            table = pa.Table.from_batches(held)
            if table.num_rows:
                yield from f(table).combine_chunks().to_batches()

    return rows.repartition(key).sortWithinPartitions(key, order).mapInArrow(apply, schema)


def cells_of(table: pa.Table, key: str) -> np.ndarray:
    """Where each cell's rows begin, and the number of rows."""
    n = table.num_rows
    k = table.column(key).combine_chunks()
    new = np.ones(n, bool)
    if n > 1:
        new[1:] = pc.not_equal(k.slice(1), k.slice(0, n - 1)).to_numpy(zero_copy_only=False)
    return np.append(np.flatnonzero(new), n)


def fit(series: DataFrame, kernel: str, key: str = "cell", rows_at_once: int = HELD_ROWS) -> DataFrame:
    """Fit every cell of (cell, ym, t0, h, u): adds a, b, c, and var for kriging."""
    extra = ", var double" if kernel == "atpk" else ""
    schema = f"{key} {dict(series.dtypes)[key]}, ym int, t0 double, h double, u double, a double, b double, c double{extra}"
    return by_whole_cells(series.select(key, "ym", "t0", "h", "u"), key, lambda table: fitted(table, key, kernel), schema, rows_at_once=rows_at_once)


def bounded(series: DataFrame, upper: float | None = None, key: str = "cell") -> DataFrame:
    """(cell, ym, first, last, mean, top) of the bounded iterative smoothing; the bound is the cell's largest mean unless given."""

    def smoothed(table: pa.Table) -> pa.Table:
        u, at = table.column("u").to_numpy(), cells_of(table, key)
        out = np.zeros((4, table.num_rows))
        for a, b in zip(at[:-1], at[1:]):
            y = bounded_iterative(u[a:b], upper=u[a:b].max() if upper is None else upper)
            out[:, a:b] = y[:, 0], y[:, -1], y.mean(1), y.max(1)
        table = table.select([key, "ym"])
        for name, x in zip(("first", "last", "mean", "top"), out):
            table = table.append_column(name, pa.array(x))
        return table

    return by_whole_cells(series.select(key, "ym", "u"), key, smoothed, f"{key} {dict(series.dtypes)[key]}, ym int, first double, last double, mean double, top double")
