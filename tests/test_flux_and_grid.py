import math

import pytest
from pyspark.sql import Row, functions as F

from gridloom.functions import calendar, flux, grid
from gridloom.plans import diurnal
from gridloom.plans.budget import event_anomaly, two_predictors


def values(spark, column, xs, kind="double"):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(xs)], f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(column(F.col("x"))).collect()]


def test_sentinels_are_zero_in_sums_and_null_in_scans(spark):
    xs = [1.0, float("nan"), -1e34, 2.0, float("inf"), None]
    assert values(spark, flux.clean, xs) == [1, 0, 0, 2, 0, 0]
    assert values(spark, flux.to_null, xs) == [1, None, None, 2, None, None]


def test_temperature_factors(spark):
    xs = [273.15 + t for t in (-20, 0, 10, 35)]
    assert values(spark, flux.q10_factor, xs) == pytest.approx([1.5 ** (t / 10) for t in (-20, 0, 10, 35)])
    assert values(spark, flux.lloyd_taylor, [100.0])[0] < 1e-30


def test_dark_hours_are_zero(spark):
    df = spark.createDataFrame([(1.0, 0.0), (2.0, 9.0), (3.0, 0.0), (4.0, 9.0), (5.0, 0.0)], "g double, d double")
    assert [r[0] for r in df.select(flux.polar_clip(F.col("g"), F.col("d"))).collect()] == [0, 2, 0, 4, 0]


def test_removal_modes():
    with pytest.raises(ValueError):
        flux.atmc_removal("q10", F.lit(1.0))
    with pytest.raises(ValueError):
        flux.atmc_removal("no", F.lit(1.0))


def test_the_sphere_closes(spark):
    total = grid.grid(spark).agg(F.sum("area_m2")).first()[0]
    assert total == pytest.approx(4 * math.pi * 6371000.0**2, rel=1e-12)
    half = grid.grid(spark).filter("lat > 0").agg(F.sum("area_m2")).first()[0]
    assert half == pytest.approx(total / 2, rel=1e-12)


def test_parallels_out_of_order_are_refused(spark):
    with pytest.raises(Exception, match="parallels"):
        spark.range(1).select(grid.checked_area(F.lit(10.0), F.lit(5.0), 1.0)).collect()


def test_regrid_of_constant_and_missing(spark):
    g = grid.grid(spark).withColumn("x", F.when(F.col("i") >= 10, 7.5))
    out = {(r["i"], r["j"]): r["x"] for r in grid.regrid(g, "x", 10, 10).collect()}
    assert out[0, 0] is None and out[5, 5] == pytest.approx(7.5, abs=1e-10)


def test_cells(spark):
    row = spark.range(1).select(grid.cell_id(F.lit(-179.5), F.lit(-89.5)).alias("a"), grid.cell_id(F.lit(179.5), F.lit(89.5)).alias("b"), grid.cell_id(F.lit(180.0), F.lit(90.0)).alias("c")).first()
    assert (row["a"], row["b"]) == (0, 64799) and row["c"] == 64440


def test_months(spark):
    assert calendar.parse_month("2020-11") == calendar.parse_month("202011") == 2020 * 12 + 10
    assert calendar.span(*map(calendar.parse_month, ("2020-11", "2021-02"))) == [24250, 24251, 24252, 24253]
    for bad in ("2020-13", "x"):
        with pytest.raises(ValueError):
            calendar.parse_month(bad)
    with pytest.raises(ValueError):
        calendar.span(2, 1)
    assert values(spark, calendar.midpoint_seconds, [2001 * 12], "int") == [979646400]


def hours(spark, dark=lambda h: h < 8):
    rows = [(1, 24000, 0.0, f"2000-01-{d:02d} {h:02d}:00:00", 0.0 if dark(h) else 5.0 + h, 270.0 + h, 275.0 + h / 2) for d in (1, 2) for h in range(24)]
    return spark.createDataFrame(rows, "cell int, ym int, t0 double, ts string, ssrd double, t2m double, stl1 double").withColumn("ts", F.col("ts").cast("timestamp_ntz"))


def fits(spark, c):
    return spark.createDataFrame([(1, 24000, 0.0, 0.0, c)], "cell int, ym int, a double, b double, c double")


def test_diurnal_means_are_conserved(spark):
    mn = spark.createDataFrame([(1, 24000, -3.0, 2.0, 0.5)], "cell int, ym int, gpp_mn double, resp_mn double, atmc_mn double")
    out = diurnal.diurnalize(hours(spark), mn, fits(spark, -3.0), fits(spark, 2.0), atmc="q10")
    row = out.agg(F.avg("gpp"), F.avg("resp"), F.avg("removed"), F.max(F.when(F.col("ssrd") == 0, F.abs("gpp")))).first()
    assert row[0] == pytest.approx(-3, abs=1e-12) and row[1] == pytest.approx(1.5, abs=1e-12) and row[2] == pytest.approx(0.5, abs=1e-12) and row[3] == 0
    assert diurnal.mean_gate(out, "gpp", "gpp_mn").first()["ok"]
    assert not diurnal.mean_gate(out.withColumn("gpp", F.col("gpp") * 1.01), "gpp", "gpp_mn").first()["ok"]


def test_all_dark_month_stays_zero(spark):
    mn = spark.createDataFrame([(1, 24000, -3.0, 2.0)], "cell int, ym int, gpp_mn double, resp_mn double")
    out = diurnal.diurnalize(hours(spark, lambda h: True), mn, fits(spark, -3.0), fits(spark, 2.0))
    assert out.agg(F.max(F.abs("gpp"))).first()[0] == 0


def test_reference_temperature_cancels(spark):
    h = hours(spark).withColumn("r", flux.q10_factor(F.col("t2m"))).withColumn("s", flux.q10_factor(F.col("t2m"), ref=280.0))
    m = h.agg(F.avg("r"), F.avg("s")).first()
    assert h.select(F.max(F.abs(F.col("r") / m[0] - F.col("s") / m[1]))).first()[0] < 1e-12


def test_strict_months_are_refused(spark):
    months = spark.createDataFrame([Row(cell=1, ym=24000), Row(cell=1, ym=24001)])
    df = diurnal.fit_or_month_mean(months, fits(spark, 1.0).withColumn("ym", F.lit(24000)), strict=True)
    with pytest.raises(Exception, match="no fit"):
        df.collect()


def test_names_are_checked(spark):
    for call in (lambda: diurnal.response("sea"), lambda: diurnal.response("air", "x"), lambda: diurnal.elapsed("never")):
        with pytest.raises(ValueError):
            call()


def test_two_predictors_match_least_squares(spark):
    import numpy as np

    rng = np.random.default_rng(0)
    a, s = rng.normal(size=50), rng.normal(size=50)
    y = 2 * a - s + rng.normal(size=50) * 0.1
    z = lambda v: (v - v.mean()) / v.std()
    want = np.linalg.lstsq(np.stack([z(a), z(s), np.ones(50)], 1), z(y), rcond=None)[0]
    got = two_predictors(spark.createDataFrame([tuple(map(float, r)) for r in zip(y, a, s)], "y double, a double, s double"), "y", "a", "s").first()
    assert (got["beta_a"], got["beta_s"]) == pytest.approx(tuple(want[:2]))


def test_event_anomaly(spark):
    df = spark.createDataFrame([(2019, 1.0), (2020, 5.0), (2021, 3.0)], "year int, v double")
    assert event_anomaly(df, "v", [2020], [2019, 2021]).first()[0] == 3
