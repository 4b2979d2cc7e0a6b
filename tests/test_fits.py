"""Invariants of the fits, and the window forms against plain numpy ones."""

import itertools

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from gridloom.operators.series import with_knots
from gridloom.plans import kernels, window_fits
from gridloom.plans.fits import fit, hybrid, month_mean_fit, padded_fit
from gridloom.plans.diagnostics import footprint, kriging_against, overshoot, range_sweep

H = np.array([31, 28, 31, 30, 31, 30, 31, 31, 30, 31, 30, 31], float)


def mean(h, a, b, c):
    return a * h * h / 3 + b * h / 2 + c


def series(spark, rows):
    return with_knots(spark.createDataFrame([(cell, 24000 + k, float(u)) for cell, us in rows.items() for k, u in enumerate(us)], "cell int, ym int, u double"))


@pytest.mark.parametrize("name", list(kernels.KERNELS))
@pytest.mark.parametrize("h,u", [(np.ones(6), [7, 2.5, 9, 0.5, 4, 4]), (np.array([2.0, 0.5, 3, 1.5]), [3, 11, 2, 7]), (np.full(5, 2.0), [-4, -0.3, -6, -0.2, -9]), (np.array([1.0, 2, 1, 3, 2]), [6, 3, 6, 2, 5])])
def test_kernels_keep_means(name, h, u):
    u = np.array(u, float)
    assert np.allclose(mean(h, *kernels.KERNELS[name](h, u)), u, atol=1e-9)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.floats(0.1, 100), min_size=4, max_size=30), st.sampled_from(["pchip", "piqs", "histospline", "atpk"]))
def test_kernels_keep_means_of_anything(u, name):
    u = np.array(u)
    h = np.resize(H, len(u))
    assert np.allclose(mean(h, *kernels.KERNELS[name](h, u)), u, rtol=1e-8)


def test_constant_series_is_flat():
    for name in ("pchip", "histospline"):
        a, b, c = kernels.KERNELS[name](np.ones(4), np.full(4, 5.0))
        assert np.allclose(a, 0) and np.allclose(b, 0) and np.allclose(c, 5)


def test_monotone_slopes_stay_in_the_circle():
    rng = np.random.default_rng(0)
    for _ in range(200):
        u = rng.uniform(0, 5, 12)
        m = kernels.monotone_slopes(u)
        assert (np.hypot(m[:-1] / u, m[1:] / u) <= 3 + 1e-9).all()


def test_many_records_at_once_are_as_one():
    rng = np.random.default_rng(9)
    u = rng.uniform(0, 5, (40, 15)) * rng.choice([1, -1], (40, 1))
    u[rng.random(u.shape) < 0.1] = 0
    h = np.tile(np.resize(H, 15), (40, 1))
    many = kernels.many_pchip(h, u)
    for i in range(40):
        for x, y in zip(many, kernels.pchip(h[i], u[i])):
            assert np.allclose(x[i], y, atol=1e-12)


def test_cells_that_span_batches(spark):
    df = series(spark, {k: np.random.default_rng(k).uniform(1, 9, 20 + k % 3) for k in range(30)})
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        out = kernels.fit(df, "pchip", rows_at_once=25).toPandas()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(out) == df.count() and np.allclose(mean(out.h, out.a, out.b, out.c), out.u)


def test_smoothest_fit_keeps_its_sign_at_test_points():
    rng = np.random.default_rng(3)
    for _ in range(50):
        u, h = rng.uniform(0, 5, 10), np.resize(H, 10)
        a, b, c = kernels.mss(h, u)
        s = ((np.arange(8) + 0.5) / 8)[:, None] * h
        assert (a * s * s + b * s + c).min() > -1e-7


def test_kriging_weights_sum_to_one_and_variance_is_not_negative():
    lam, var = kernels.kriging_weights(13, 6)
    assert np.allclose(lam.sum(0), 1) and (var >= 0).all()
    u = np.random.default_rng(1).uniform(0, 3, 24)
    *_, var = kernels.kriged(np.resize(H, 24), u)
    assert (var >= 0).all()
    assert (kernels.kriged(np.resize(H, 4), np.full(4, 2.0))[3] == 0).all()


def test_positive_points_keep_means():
    u = np.array([1.0, 0.1, 2.0])
    z = kernels.positive_points(u[:, None] + np.array([[0, 1, -1], [0.5, -0.5, 0], [0, 0, 0.0]]), u, 1.0)
    assert np.allclose(z.mean(1), u) and z.min() > -1e-9


def test_bounded_iterative_keeps_means_without_a_bound():
    y = kernels.bounded_iterative(np.array([1.0, 4, 2]), 10, 20)
    assert np.allclose(y.mean(1), [1, 4, 2])


@pytest.mark.parametrize("name", list(window_fits.FITS) + ["pchip", "piqs"])
def test_fits_keep_means_and_silence(spark, name):
    rng = np.random.default_rng(5)
    df = series(spark, {1: rng.uniform(1, 9, 24), 2: -rng.uniform(1, 9, 24), 3: np.zeros(24)})
    out = fit(df, name).toPandas()
    assert np.allclose(mean(out.h, out.a, out.b, out.c), out.u, atol=1e-7)
    assert (out.loc[out.cell == 3, ["a", "b", "c"]] == 0).all().all()


def test_limited_fits_do_not_overshoot(spark):
    rng = np.random.default_rng(6)
    df = series(spark, {1: rng.uniform(1, 9, 36)})
    for name in ("minmod", "ppm"):
        assert overshoot(fit(df, name)).toPandas()["ratio"].max() <= 1 + 1e-9
    assert overshoot(fit(df, "piqs")).toPandas()["ratio"].max() > 1  # the gate can fail


def test_revision_footprint_is_local(spark):
    df = series(spark, {1: np.random.default_rng(7).uniform(1, 9, 30)})
    months = {n: footprint(df, n).first()["months"] for n in ("constant", "minmod", "ppm", "piqs")}
    assert months["constant"] == 0 and months["minmod"] <= 1 and months["ppm"] <= 2


def test_hybrid_patches_wrong_signs(spark):
    u = np.tile([0.01, 9, 0.01, 0.02], 6)
    out = hybrid(series(spark, {1: u})).toPandas()
    assert out.patched.any() and np.allclose(mean(out.h, out.a, out.b, out.c), out.u, atol=1e-9)


def test_padding_is_taken_off_again(spark):
    df = series(spark, {1: np.arange(1, 25)})
    out = padded_fit(df, "pchip").toPandas()
    assert len(out) == 24 and np.allclose(mean(out.h, out.a, out.b, out.c), out.u)
    assert month_mean_fit(fit(df, "minmod")).count() == 12


def test_unknown_fit_is_refused(spark):
    with pytest.raises(ValueError):
        fit(series(spark, {1: [1, 2, 3]}), "nothing")


def test_window_fits_run_no_python(spark):
    plan = fit(series(spark, {1: [1, 2, 3]}), "ppm")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def rough(h, u, m):
    """Integral of the squared slope of a fit with knot values m, by quadrature."""
    a, b, _ = kernels._of_slopes(h, u, m)
    s = (np.arange(400) + 0.5)[:, None] / 400 * h
    return (((2 * a * s + b) ** 2).mean(0) * h).sum()


def test_smoothest_fit_is_the_smoothest():
    """Against every set of constraints that could bind, solved one by one."""
    for u in ([4.0, 0.2, 3.0], [0.1, 5.0, 0.3], [2.0, 2.5, 2.0]):
        u, h = np.array(u), np.array([1.0, 1.5, 0.8])
        n = len(u) + 1
        unit = np.eye(n)
        base = rough(h, u, np.zeros(n))
        line = np.array([(rough(h, u, e) - rough(h, u, -e)) / 2 for e in unit])
        quad = np.array([[(rough(h, 0 * u, e + f) - rough(h, 0 * u, e - f)) / 4 for f in unit] for e in unit])
        at = (np.arange(8) + 0.5) / 8

        def values(m):
            a, b, c = kernels._of_slopes(h, u, m)
            s = at[:, None] * h
            return np.concatenate([(a * s * s + b * s + c).ravel(), m[[0, -1]]])

        zero = values(np.zeros(n))
        rows = np.array([values(e) - zero for e in unit]).T
        best = np.inf
        for k in range(4):
            for own in itertools.combinations(range(len(rows)), k):
                own = list(own)
                system = np.block([[2 * quad, -rows[own].T], [rows[own], np.zeros((k, k))]])
                m = np.linalg.lstsq(system, np.concatenate([-line, -zero[own]]), rcond=None)[0][:n]
                if (rows @ m + zero > -1e-9).all():
                    best = min(best, base + line @ m + m @ quad @ m)
        a, b, c = kernels.mss(h, u)
        got = rough(h, u, np.append(c, a[-1] * h[-1] ** 2 + b[-1] * h[-1] + c[-1]))
        assert got == pytest.approx(best, rel=1e-5)


def test_kriging_against_a_dense_solution():
    """Each month's points from its window's system, then a quadratic by least squares under its mean."""
    rng = np.random.default_rng(11)
    n, per = 20, 6
    u, h = rng.uniform(5, 9, n), np.resize(H, n)
    a, b, c, var = kernels.kriged(h, u, positive=False)
    for k in (0, 3, 10, 19):
        window = range(max(0, k - 6), min(n, k + 7))
        t = np.array([m + (i + 0.5) / per for m in window for i in range(per)])
        cov = np.exp(-np.abs(t[:, None] - t) / 1.5) + 1e-3 * np.eye(len(t))
        block = lambda x: np.array([x[j : j + per].mean(0) for j in range(0, len(t), per)])
        areas = block(block(cov).T)
        z, variance = [], []
        for i in range(per):
            p = list(window).index(k) * per + i
            system = np.block([[areas, np.ones((len(window), 1))], [np.ones((1, len(window))), np.zeros((1, 1))]])
            right = np.append(block(cov[:, p]), 1)
            weights = np.linalg.solve(system, right)
            z.append(weights[:-1] @ u[list(window)])
            variance.append(max(1 + 1e-3 - weights @ right, 0))
        z = np.array(z) + u[k] - np.mean(z)
        s = (np.arange(per) + 0.5) / per
        x = np.stack([s * s, s, np.ones(per)], 1)
        own = np.array([1 / 3, 1 / 2, 1])
        beta = np.linalg.solve(np.block([[x.T @ x, own[:, None]], [own[None], np.zeros((1, 1))]]), np.append(x.T @ z, u[k]))[:3]
        assert np.allclose([a[k] * h[k] ** 2, b[k] * h[k], c[k]], beta) and var[k] == pytest.approx(u.var(ddof=1) * np.mean(variance))


def test_range_sweep_and_distance_of_fits(spark):
    rows = {k: np.random.default_rng(k).uniform(1, 9, 24 + k) for k in range(3)}
    df = series(spark, rows)
    got = {r["range"]: (r["variance"], r["roughness"]) for r in range_sweep(df, (1.0, 3.0)).collect()}
    h = {r["ym"]: r["h"] for r in df.select("ym", "h").distinct().collect()}
    for reach in (1.0, 3.0):
        each = []
        for u in rows.values():
            own = np.array([h[24000 + k] for k in range(len(u))])
            a, _, _, var = kernels.kriged(own, u, kernels.all_kriging_weights(len(u), range_=reach))
            each.append((var.mean(), np.abs(2 * a * own**2).mean()))
        assert got[reach] == pytest.approx(tuple(np.mean(each, 0)))
    fits = fit(df, "atpk"), fit(df, "pchip")
    d = {r["cell"]: r for r in kriging_against(*fits).collect()}
    mid = [f.toPandas().assign(v=lambda x: x.a * x.h**2 / 4 + x.b * x.h / 2 + x.c).set_index(["cell", "ym"]) for f in fits]
    for cell, u in rows.items():
        off = mid[0].v.loc[cell] - mid[1].v.loc[cell]
        assert d[cell]["rms"] == pytest.approx(np.sqrt((off**2).mean()) / np.abs(u).max())
        assert d[cell]["band"] == pytest.approx((2 * np.sqrt(mid[0].loc[cell]["var"])).mean() / np.abs(u).max())
