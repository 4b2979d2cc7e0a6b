"""An input for every check that it must not pass, and limits and sites against the reference's."""

import datetime as dt
import os
import re

import pytest
from pyspark.sql import functions as F

from gridloom.plans import checks

YEAR = range(24000, 24012)
from gridloom.functions.grid import BANDS


def at(lon, lat):
    return int(lon + 180), int(lat + 90)


def monthly(spark, flux, cells=((0, 100),), months=YEAR):
    """flux(cell's number, ym) -> npp, rh."""
    rows = [(k, i, j, i - 179.5, j - 89.5, 1e10, ym, *map(float, flux(k, ym)), 0.0, 0.0) for k, (i, j) in enumerate(cells) for ym in months]
    return spark.createDataFrame(rows, "cell int, i int, j int, lon double, lat double, area_m2 double, ym int, npp double, rh double, fire double, fuel double")


def fits(spark, u=lambda ym: 1.0, c=lambda ym: 1.0, channel="gpp", months=YEAR):
    return spark.createDataFrame([(0, channel, ym, ym * 30.0, 30.0, float(u(ym)), 0.0, 0.0, float(c(ym))) for ym in months], "cell int, channel string, ym int, t0 double, h double, u double, a double, b double, c double")


def summary(spark, value, column=None, months=YEAR):
    """value(ym) in one column or all, 1 elsewhere; or value(ym, column) in all."""
    names = [f"{v}_{b}" for v in ("nee", "gpp", "resp") for b in BANDS]
    of = value if column is None and value.__code__.co_argcount == 2 else lambda ym, _: value(ym)
    return spark.createDataFrame([(ym, *(float(of(ym, n)) if column in (n, None) else 1.0 for n in names)) for ym in months], "ym int, " + ", ".join(f"{n} double" for n in names))


def hourly(spark, gpp=lambda h: 0.0, ssrd=lambda h: 0.0, nee=0.0, resp=1.0, start=dt.datetime(2000, 7, 1), hours=48, lat=10.0, lon=0.0, step=60, first=30):
    """By hour of the day; slots at half past."""
    ts = [start + dt.timedelta(minutes=first + step * k) for k in range(hours)]
    return spark.createDataFrame([(0, lon, lat, t, t.year * 12 + t.month - 1, float(gpp(t.hour)), resp, float(nee(t) if callable(nee) else nee), float(ssrd(t.hour))) for t in ts], "cell int, lon double, lat double, ts timestamp, ym int, gpp double, resp double, nee double, ssrd double")


def logs(spark, line):
    return spark.createDataFrame([(line,)], "value string")


def files(spark, *rows):
    return spark.createDataFrame([(*r, 0) for r in rows], "file string, stream string, exists boolean, sha256 string, recorded string, mtime long, size long")


def attributes(spark, **said):
    return spark.createDataFrame([(said,)], "attributes map<string,string>")


def manifest(spark, **other):
    row = {"timestamp": "t", "step": "diurnalize", "status": "ok", "elapsed_s": "9", "malformed": False} | other
    return spark.createDataFrame([tuple(row.values())], "timestamp string, step string, status string, elapsed_s string, malformed boolean")


ONE = lambda k, ym: (1.0, 1.0)
FIVE, LONG = range(24000, 24060), range(24000, 24288)
month = lambda ym: ym % 12 + 1
least_in = lambda m: lambda k, ym: (1e-6 if month(ym) == m else 0.0, 0.0)
january = lambda ym: -9.0 if month(ym) == 1 else -1.0

#: A year of each band: amplitudes, the south half a year behind; or one value for all months.
AMPLITUDES = {"nh_mid": 5, "boreal": 3, "trop": 1, "sh_mid": 2, "polar_n": 1}


def wave(peak=9, **amplitudes):
    own = AMPLITUDES | amplitudes
    return lambda ym, name: own.get(name.partition("_")[2], 1) * (1.0 if month(ym) == (peak if name.endswith("sh_mid") else 3) else 0.0)


def pair(spark, flux):
    return monthly(spark, flux, cells=((0, 90), (5, 95), (9, 99)))


def south(spark, ratio):
    return hourly(spark, nee=1.0).unionByName(hourly(spark, nee=ratio, lat=-70.5).withColumn("cell", F.lit(1)))


FEB = dict(start=dt.datetime(2000, 2, 1), hours=29 * 24)
SAYS = dict(flux_from_climatology="yes", prior_variant="p", climatology_baseline="2001-2020", climatology_method="m", scope_note="s", respiration_temperature_driver="airtemp", respiration_temperature_function="q10")
years = lambda s, f: hourly(s, nee=f, hours=3, step=366 * 24 * 60)

#: What each check must fail on; WARNS have no failure, only a warning, and TELLS judge nothing.
WARNS = ("7.3", "20.2", "C1.3", "C1.6", "C5.3", "C5.6")
TELLS = ("6.2", "16.1", "16.2", "16.3", "X.budget")
BAD = {
    "1.1": lambda s: {"monthly": monthly(s, ONE).drop("fuel")},
    "1.2": lambda s: {"fits": fits(s).drop("c")},
    "1.3": lambda s: {"monthly": monthly(s, lambda k, ym: (1 if month(ym) > 1 else "nan", 1))},
    "1.4": lambda s: {"hourly": hourly(s)},
    "2.1": lambda s: {"fits": fits(s, c=lambda ym: 2)},
    "2.1r": lambda s: {"fits": fits(s, c=lambda ym: 2, channel="rtot")},
    "2.2": lambda s: {"hourly": hourly(s, start=dt.datetime(2000, 1, 1), gpp=lambda h: 2), "fits": fits(s)},
    "2.3": lambda s: {"monthly": monthly(s, ONE).filter("ym != 24005")},
    "2.4": lambda s: {"hourly": hourly(s, gpp=lambda h: -1.0), "monthly": monthly(s, ONE)},
    "3.1": lambda s: {"logs": logs(s, "sign-flip rate 20.0 %")},
    "4.1": lambda s: {"monthly": monthly(s, lambda k, ym: (1 + (ym >= 24012), 1), months=range(24000, 24024)).withColumn("version", F.when(F.col("ym") < 24012, "v1").otherwise("vNRT"))},
    "P2.0": lambda s: {"summary": summary(s, lambda ym: 1).filter("ym != 24003")},
    "5.1": lambda s: {"summary": summary(s, lambda ym: 0, "gpp_global")},
    "5.1r": lambda s: {"summary": summary(s, lambda ym: 1e4, "resp_global")},
    "5.2": lambda s: {"summary": summary(s, lambda ym: -1 - 9 * (ym >= 24012), "gpp_global", range(24000, 24024))},
    "5.3": lambda s: {"summary": summary(s, wave(peak=3, trop=9), months=FIVE)},
    "6.1": lambda s: {"monthly": pair(s, lambda k, ym: (k, 0)), "other": pair(s, lambda k, ym: (k if ym > 24000 else -k, 0))},
    "6.2": lambda s: {"monthly": pair(s, ONE), "other": pair(s, lambda k, ym: (9 if ym > 24008 else 2, 1))},
    "7.1": lambda s: {"hourly": hourly(s, nee=1e-9), "monthly": monthly(s, lambda k, ym: (1e-16, 0))},
    "7.2": lambda s: {"hourly": south(s, 0.2)},
    "7.3": lambda s: {"summary": summary(s, january, "nee_boreal")},
    "7.4": lambda s: {"summary": summary(s, lambda ym: 2, "nee_global")},
    "8.1": lambda s: {"summary": summary(s, lambda ym: ym // 12 * 50 + ym % 2, "nee_global", FIVE)},
    "8.2": lambda s: {"summary": summary(s, lambda ym: (-1) ** (ym // 12) * 5 + 1, "nee_global", FIVE)},
    "8.3": lambda s: {"summary": summary(s, wave(polar_n=20), months=FIVE)},
    "9.1": lambda s: {"files": files(s, ("a", "s", False, "x", "x", 1))},
    "9.2": lambda s: {"files": files(s, ("a", "s", True, "x", "y", 1))},
    "10.1": lambda s: {"attributes": attributes(s, provisional="yes")},
    "11.1": lambda s: {"logs": logs(s, "FATAL: no space")},
    "11.2": lambda s: {"fits": fits(s, c=lambda ym: 2), "previous": fits(s)},
    "12.1": lambda s: {"hourly": hourly(s, start=dt.datetime(2000, 2, 1))},
    "12.2": lambda s: {"hourly": hourly(s, gpp=lambda h: -1)},
    "13.1": lambda s: {"files": files(s, ("a", "s", True, "x", "x", 2), ("b", "s", True, "x", "x", 1))},
    "13.2": lambda s: {"monthly": monthly(s, lambda k, ym: (k % 2, 1), cells=[(i, 100) for i in range(6)])},
    "14.1": lambda s: {"monthly": monthly(s, lambda k, ym: (0, 1e-6), cells=(at(-60.5, -3.5),))},
    "14.2": lambda s: {"monthly": monthly(s, least_in(1), cells=(at(23.5, 60.5),))},
    "14.3": lambda s: {"monthly": monthly(s, least_in(1), cells=(at(19.5, 12.5),))},
    "15.1": lambda s: {"summary": summary(s, lambda ym: ym // 12, "nee_global", range(24000, 24120))},
    "15.2": lambda s: {"summary": summary(s, lambda ym: 1, "nee_trop", range(24120, 24240))},
    "15.3": lambda s: {"summary": summary(s, lambda ym: ym // 12 == 2020, "nee_global", range(24228, 24264))},
    "16.1": lambda s: {"monthly": monthly(s, ONE), "hourly": hourly(s, gpp=lambda h: "nan")},
    "16.2": lambda s: {"summary": summary(s, lambda ym: abs(ym // 12 - 2012), "nee_global", range(24012, 24288))},
    "16.3": lambda s: {"fits": fits(s, c=lambda ym: 1 + (ym == 24003)), "grid": monthly(s, ONE).select("cell", "lat").distinct()},
    "16.4": lambda s: {"fits": fits(s, c=lambda ym: 2), "previous": fits(s)},
    "17.1": lambda s: {"hourly": hourly(s, gpp=lambda h: -1)},
    "17.2": lambda s: {"hourly": hourly(s, gpp=lambda h: -1.0 * (h == 0))},
    "17.3": lambda s: {"hourly": hourly(s, gpp=lambda h: -1.0)},
    "18.1": lambda s: {"fits": fits(s)},
    "18.2": lambda s: {"fits": fits(s, c=lambda ym: ym, channel="rtot")},
    "19.1": lambda s: {"monthly": monthly(s, least_in(1), cells=(at(-156.5, 70.5),))},
    "19.2": lambda s: {"monthly": monthly(s, least_in(8), cells=(at(-40.5, -10.5),))},
    "19.3": lambda s: {"monthly": monthly(s, lambda k, ym: (0, 1e-6), cells=(at(114.5, -2.5),))},
    "19.4": lambda s: {"monthly": monthly(s, lambda k, ym: (0, 2e-6), cells=(at(134.5, -25.5),))},
    "20.1": lambda s: {"monthly": monthly(s, ONE), "other": monthly(s, lambda k, ym: (2, 1))},
    "20.2": lambda s: {"monthly": monthly(s, lambda k, ym: (0, 1), months=range(24012, 24024))},
    "21.1": lambda s: {"monthly": monthly(s, lambda k, ym: (1, ym == 24003), months=FIVE)},
    "21.2": lambda s: {"monthly": monthly(s, lambda k, ym: (1, ym == 24012), months=range(24000, 24720, 12))},
    "22.1": lambda s: {"manifest": manifest(s, elapsed_s="9999")},
    "23.1": lambda s: {"attributes": attributes(s, history="h", commit="c")},
    "23.2": lambda s: {"attributes": attributes(s, source="s", commit="c")},
    "23.3": lambda s: {"attributes": attributes(s, source="s", history="h")},
    "24.1": lambda s: {"manifest": manifest(s, malformed=True)},
    "24.2": lambda s: {"manifest": manifest(s, status="fail")},
    "C1.1": lambda s: {"series": monthly(s, ONE), "delivery": monthly(s, ONE)},
    "C1.4": lambda s: {"series": monthly(s, lambda k, ym: (ym, 1), months=FIVE)},
    "C1.5": lambda s: {"series": monthly(s, ONE, months=range(24000, 24013))},
    "C1.7": lambda s: {"series": monthly(s, ONE, months=FIVE)},
    "C2.2": lambda s: {"fits": fits(s, c=lambda ym: 2)},
    "C2.3": lambda s: {"fits": fits(s, c=lambda ym: ym, months=FIVE)},
    "C3.c": lambda s: {"hourly": hourly(s, hours=96).filter("day(ts) != 2")},
    "C3.d": lambda s: {"hourly": hourly(s, hours=47)},
    "C5.1": lambda s: {"hourly": hourly(s, nee=1.0), "monthly": monthly(s, lambda k, ym: (1, 3))},
    "C5.2": lambda s: {"series": monthly(s, lambda k, ym: (ym // 12, 1), months=FIVE)},
    "C1.2": lambda s: {"series": monthly(s, ONE), "delivery": monthly(s, ONE, months=FIVE)},
    "C1.3": lambda s: {"series": monthly(s, ONE), "delivery": monthly(s, ONE)},
    "C1.6": lambda s: {"attributes": attributes(s, climatology_baseline="2001-2019", climatology_baseline_requested="2001-2020")},
    "C2.1": lambda s: {"fits": fits(s).filter("ym != 24004"), "delivery": monthly(s, ONE)},
    "C3.1": lambda s: {"hourly": hourly(s, hours=365 * 24, start=dt.datetime(2000, 1, 1)), "delivery": monthly(s, ONE)},
    "C3.a": lambda s: {"hourly": hourly(s, hours=365 * 24, start=dt.datetime(2000, 1, 1)), "delivery": monthly(s, ONE)},
    "C3.b": lambda s: {"files": files(s, ("a", "s", True, "x", "x", 1))},
    "C3.e": lambda s: {"hourly": hourly(s, first=0)},
    "C3.f": lambda s: {"hourly": hourly(s, nee=lambda t: min(t.day, 28), **FEB), "delivery": monthly(s, ONE)},
    "C4.0": lambda s: {"hourly": hourly(s), "reference": hourly(s, start=dt.datetime(2001, 7, 1))},
    "C4.1": lambda s: {"hourly": hourly(s).withColumn("nee", F.col("nee").cast("float")), "reference": hourly(s)},
    "C4.2": lambda s: {"attributes": attributes(s, flux_from_climatology="yes")},
    "C4.3": lambda s: {"attributes": attributes(s, flux_from_climatology="no")},
    "C5.1b": lambda s: {"hourly": hourly(s, nee=1.0), "monthly": monthly(s, lambda k, ym: (1, 3)), "reference": hourly(s, nee=1.9), "reference_monthly": monthly(s, lambda k, ym: (1, 3))},
    "C5.3": lambda s: {"hourly": years(s, lambda t: t.year), "reference": years(s, lambda t: 2 * t.year)},
    "C5.4": lambda s: {"hourly": hourly(s, nee=1.0), "reference": hourly(s, nee=1.0)},
    "C5.6": lambda s: {"hourly": hourly(s, nee=1.0)},
    "X.count": lambda s: {"hourly": hourly(s)},
    "X.stamp": lambda s: {"attributes": attributes(s, **SAYS | {"climatology_baseline": "2001-2019"})},
    "X.live": lambda s: {"hourly": hourly(s, nee=1.0), "reference_year": hourly(s, nee=1.0, start=dt.datetime(1999, 7, 1))},
    "X.budget": lambda s: {"monthly": monthly(s, ONE), "other": monthly(s, ONE)},
    "C5.5": lambda s: {"hourly": hourly(s, nee=float("nan"))},
    "X.mean": lambda s: {"monthly": monthly(s, ONE), "other": monthly(s, lambda k, ym: (1.1, 1))},
    "X.false": lambda s: {"monthly": monthly(s, ONE), "other": monthly(s, ONE)},
}


def test_every_check_has_an_input_it_does_not_pass():
    assert set(BAD) == set(checks.REGISTRY)


@pytest.mark.parametrize("id_", sorted(BAD))
def test_check_does_not_pass(spark, id_):
    row = checks.run(BAD[id_](spark), (id_,)).first()
    assert row["status"] == ("INFO" if id_ in TELLS else "WARN" if id_ in WARNS else "FAIL"), row


def status(tables, id_):
    return checks.run(tables, (id_,)).first()["status"]


@pytest.mark.parametrize("id_, column, good, bad", [("5.1", "gpp_global", -10, (0, -1, -1e4, 10)), ("5.1r", "resp_global", 10, (0, 1, 1e4, -10))])
def test_annual_ranges(spark, id_, column, good, bad):
    assert status({"summary": summary(spark, lambda ym: good, column)}, id_) == "PASS"
    assert {status({"summary": summary(spark, lambda ym: b, column)}, id_) for b in bad} == {"FAIL"}
    assert status({"summary": summary(spark, lambda ym: good, column, range(24000, 24005))}, id_) == "SKIP"


@pytest.mark.parametrize("id_, site, flux", [
    ("14.1", (-60.5, -3.5), lambda k, ym: (1e-6, 1e-6)), ("14.2", (23.5, 60.5), lambda k, ym: (1e-6 if month(ym) == 7 else 0.0, 1e-7 if month(ym) == 1 else 0.0)), ("14.3", (19.5, 12.5), least_in(8)),
    ("19.1", (-156.5, 70.5), least_in(7)), ("19.2", (-40.5, -10.5), least_in(3)), ("19.3", (114.5, -2.5), lambda k, ym: (1, 1)), ("19.4", (134.5, -25.5), lambda k, ym: (0, 9e-7)),
])
def test_sites(spark, id_, site, flux):
    assert status({"monthly": monthly(spark, flux, cells=(at(*site),), months=FIVE)}, id_) == "PASS"


def test_hourly_and_exchange_limits(spark):
    assert status({"hourly": hourly(spark, gpp=lambda h: -1.0 * (6 <= h < 18))}, "17.3") == "PASS"
    assert status({"monthly": monthly(spark, lambda k, ym: (0, 1e-6), months=range(24012, 24024))}, "20.2") == "PASS"
    m = monthly(spark, lambda k, ym: (1, 3))
    assert status({"hourly": hourly(spark, nee=2.0), "monthly": m}, "C5.1") == "PASS" and status({"hourly": hourly(spark, gpp=lambda h: -2.0), "monthly": m}, "2.4") == "PASS"


#: What the checks of the climatology batteries must pass.
GOOD = {
    "C1.2": lambda s: {"series": monthly(s, ONE, months=FIVE), "delivery": monthly(s, ONE)},
    "C1.3": lambda s: {"series": monthly(s, ONE, months=range(23988, 24024)), "delivery": monthly(s, ONE)},
    "C1.6": lambda s: {"attributes": attributes(s, climatology_baseline="2001-2020", climatology_baseline_requested="2001-2020")},
    "C2.1": lambda s: {"fits": fits(s), "delivery": monthly(s, ONE)},
    "C3.1": lambda s: {"hourly": hourly(s, hours=366 * 24, start=dt.datetime(2000, 1, 1)), "delivery": monthly(s, ONE)},
    "C3.a": lambda s: {"hourly": hourly(s, hours=366 * 24, start=dt.datetime(2000, 1, 1)), "delivery": monthly(s, ONE)},
    "C3.e": lambda s: {"hourly": hourly(s)},
    "C3.f": lambda s: {"hourly": hourly(s, nee=lambda t: t.day, **FEB), "delivery": monthly(s, ONE)},
    "C4.0": lambda s: {"hourly": hourly(s), "reference": hourly(s)},
    "C4.1": lambda s: {"hourly": hourly(s), "reference": hourly(s)},
    "C4.2": lambda s: {"attributes": attributes(s, **SAYS)},
    "C4.3": lambda s: {"attributes": attributes(s, **SAYS)},
    "C5.1b": lambda s: {"hourly": hourly(s, nee=1.9), "monthly": monthly(s, lambda k, ym: (1, 3)), "reference": hourly(s, nee=1.9), "reference_monthly": monthly(s, lambda k, ym: (1, 3))},
    "C5.3": lambda s: {"hourly": years(s, lambda t: 1), "reference": years(s, lambda t: t.year)},
    "C5.4": lambda s: {"hourly": hourly(s, nee=1.0), "reference": hourly(s, nee=1.5)},
    "C5.6": lambda s: {"hourly": hourly(s, nee=1e-5)},
    "X.count": lambda s: {"hourly": hourly(s, **FEB)},
    "X.stamp": lambda s: {"attributes": attributes(s, **SAYS)},
    "X.live": lambda s: {"hourly": hourly(s, nee=1.0), "reference_year": hourly(s, nee=2.0, start=dt.datetime(1999, 7, 1))},
}


GOOD |= {
    "5.2": lambda s: {"summary": summary(s, lambda ym: -10 - (ym >= 24012), months=range(24000, 24024))},
    "5.3": lambda s: {"summary": summary(s, wave(), months=FIVE)},
    "6.1": lambda s: {"monthly": pair(s, lambda k, ym: (k, 0)), "other": pair(s, lambda k, ym: (2 * k, 0))},
    "7.1": lambda s: {"hourly": hourly(s, nee=0.0), "monthly": monthly(s, lambda k, ym: (1e-16, 0))},
    "7.2": lambda s: {"hourly": south(s, 0.005)},
    "7.3": lambda s: {"summary": summary(s, lambda ym: -9.0 if month(ym) == 7 else -1.0, "nee_boreal")},
    "8.1": lambda s: {"summary": summary(s, lambda ym: ym % 2, "nee_global", FIVE)},
    "8.2": lambda s: {"summary": summary(s, lambda ym: 10 + ym // 12 % 2, "nee_global", FIVE)},
    "8.3": lambda s: {"summary": summary(s, wave(), months=FIVE)},
    "15.1": lambda s: {"summary": summary(s, lambda ym: 3, "nee_global", range(24000, 24120))},
    "15.2": lambda s: {"summary": summary(s, lambda ym: 1 + (ym // 12 in (2015, 2016)), "nee_trop", range(24120, 24240))},
    "15.3": lambda s: {"summary": summary(s, lambda ym: 1, "nee_global", range(24228, 24264))},
}
#: Between the two limits.
BETWEEN = {
    "5.2": lambda s: {"summary": summary(s, lambda ym: -10 - 1.5 * (ym >= 24012), months=range(24000, 24024))},
    "6.1": lambda s: {"monthly": pair(s, lambda k, ym: (k + 1, 0)), "other": pair(s, lambda k, ym: ((1.0, 2.0, 2.1)[k], 0))},
    "7.2": lambda s: {"hourly": south(s, 0.05)},
    "8.1": lambda s: {"summary": summary(s, lambda ym: ym % 12 * 1.0 if month(ym) < 12 else 2.0, "nee_global", FIVE)},
    "8.2": lambda s: {"summary": summary(s, lambda ym: 1 + 1.6 * (ym // 12 % 2), "nee_global", FIVE)},
    "8.3": lambda s: {"summary": summary(s, wave(polar_n=2), months=FIVE)},
    "15.1": lambda s: {"summary": summary(s, lambda ym: (ym // 12) / 48, "nee_global", range(24000, 24120))},
    "15.2": lambda s: {"summary": summary(s, lambda ym: 1 + 0.005 * (ym // 12 in (2015, 2016)), "nee_trop", range(24120, 24240))},
    "15.3": lambda s: {"summary": summary(s, lambda ym: (ym // 12 == 2020) / 16, "nee_global", range(24228, 24264))},
}


@pytest.mark.parametrize("id_", sorted(BETWEEN))
def test_check_warns(spark, id_):
    row = checks.run(BETWEEN[id_](spark), (id_,)).first()
    assert row["status"] == "WARN", row


@pytest.mark.parametrize("id_", sorted(GOOD))
def test_check_passes(spark, id_):
    row = checks.run(GOOD[id_](spark), (id_,)).first()
    assert row["status"] == "PASS", row


def test_leap_day_that_is_missing(spark):
    assert status({"hourly": hourly(spark, start=dt.datetime(2000, 2, 1), hours=28 * 24), "delivery": monthly(spark, ONE)}, "C3.f") == "FAIL"


def test_a_check_without_its_table_is_skipped(spark):
    rows = {r["check_id"]: r for r in checks.run({"manifest": manifest(spark)}).collect()}
    assert set(rows) == set(checks.REGISTRY)
    assert (rows["17.1"]["status"], rows["17.1"]["detail"]) == ("SKIP", "no table: hourly") and rows["24.1"]["status"] == "PASS"


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="the example tables are not there")
def test_example_tables(spark):
    """Every table that a check reads is there, and those held against one another are not the same."""
    from gridloom.queries.sources import check_tables

    t = check_tables(spark, "/root/testdata/sf0.001")
    assert {n for c in checks.REGISTRY.values() for n in c.needs} <= set(t)
    for a, b, columns in (("monthly", "other", ("cell", "ym", "npp", "rh")), ("fits", "previous", ("cell", "channel", "ym", "c")), ("hourly", "reference", ("cell", "ts", "nee"))):
        assert t[a].count() == t[b].count() and t[a].select(*columns).exceptAll(t[b].select(*columns)).count() > 0
    assert t["hourly"].select("ym").distinct().count() == 3
    results = checks.run(t, ("11.2", "12.1", "2.4", "9.2", "10.1", "3.1", "C5.4")).collect()
    assert {r["check_id"]: r["status"] for r in results} == {"11.2": results[0]["status"]} | {i: "PASS" for i in ("12.1", "2.4", "9.2", "10.1", "3.1", "C5.4")} and results[0]["detail"] != "value=0.0"


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="the example tables are not there")
def test_hours_are_not_dealt_and_nothing_is_left(spark):
    """No shuffle carries hours, whatever two hourly tables are held against each other for; results are those of ``run``."""
    from gridloom.queries.sources import check_tables
    from gridloom.session import keeping

    key = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(key)
    with keeping(spark) as keep:
        t = check_tables(spark, "/root/testdata/sf0.001", keep)
        whole = checks.digested(t, keep)
        for tables, i in ((t, "C3.d"), (t, "C3.e"), (t, "17.2"), (whole, "C5.4"), (whole, "X.live")):
            plan = checks.run(tables, (i,))._jdf.queryExecution().executedPlan().toString()
            dealt = re.findall(r"Exchange hashpartitioning\(([^)]*), \d+\), ENSURE_REQUIREMENTS", plan)
            assert not [d for d in dealt if re.search(r"\b(ts|k|d|hour)#", d)], (i, dealt)
        ids = ("2.4", "7.1", "12.1", "12.2", "16.1", "17.1", "C3.c", "C3.d", "C3.e", "C4.0", "C5.4", "C5.5", "X.count", "X.live")
        assert checks.run(whole, ids).select("check_id", "status").collect() == checks.run(t, ids).select("check_id", "status").collect()
        files = whole["hourly by day"].inputFiles()
        assert files and "ts" not in whole["hourly by day"].columns
    assert spark.conf.get(key) == before and not any(os.path.exists(f.removeprefix("file://")) for f in files)


def test_collected_is_run(spark):
    from gridloom.session import keeping

    tables = {"hourly": hourly(spark, gpp=lambda h: -1.0 * (6 <= h < 18), nee=0.5), "reference": hourly(spark, nee=1.0), "monthly": monthly(spark, ONE)}
    with keeping(spark) as keep:
        got = checks.collected(tables, keep)
    want = checks.run(tables).collect()
    assert len(want) == len(checks.REGISTRY) and sorted(got.collect()) == sorted(want)
