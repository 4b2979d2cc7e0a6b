"""Assertion queries: each gives (check_id, name, status, detail), computed where the data are.

A check is a measure (one aggregate row) and limits on it. The registry holds which table a check reads, its
measure and its limits; ``run`` unions any set of them. Tables, all long:

monthly: cell, i, j, lon, lat, area_m2, ym, npp, rh, fire, fuel, is_clim | fits: cell, channel, ym, t0, h, u, a, b, c
hourly: cell, lon, lat, ts, ym, gpp, resp, nee, ssrd (fluxes in the units of monthly) | summary: ym, {nee,gpp,resp}_{band} in Pg a month
reference, reference_year: hourly of the other product, of the year that an extension is held against
reference_monthly: monthly of the other product | series, delivery: monthly of a climatology, of what is delivered
files: file, stream, exists, size, sha256, recorded, mtime | attributes: a map for each file
manifest, logs as their sources give them.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from gridloom.functions.flux import clean, piece_max, piece_mean, piece_min, solar_noon
from gridloom.functions.grid import cell_area, disjoint_band
from gridloom.operators.quantiles import exact_quantiles
from gridloom.operators.windows import neighbour_pairs
from gridloom.plans import budget, diagnostics
from gridloom.schema import GC_PER_MOL, SECONDS_PER_DAY

Tables = dict[str, DataFrame]


@dataclass(frozen=True)
class Check:
    """measure: tables -> one row with ``value``; good(value) passes, else warn(value) warns, else it fails.

    An empty measure (NULL) is skipped. info: the value is told and judged by nothing, as in the reference.
    """

    id: str
    name: str
    needs: tuple[str, ...]
    measure: Callable[[Tables], DataFrame]
    good: Callable[[Column], Column]
    warn: Callable[[Column], Column] | None = None
    info: bool = False

    def measured(self, tables: Tables) -> DataFrame:
        """check_id, name, status, value."""
        v = F.col("value")
        status = F.when(v.isNull(), "SKIP")
        status = status.when(F.lit(self.info), "INFO").when(self.good(v), "PASS")
        status = (status.when(self.warn(v), "WARN") if self.warn else status).otherwise("FAIL")
        return self.measure(tables).select(F.lit(self.id).alias("check_id"), F.lit(self.name).alias("name"), status.alias("status"), v.cast("double").alias("value"))

    def run(self, tables: Tables) -> DataFrame:
        said = F.format_string("value=%s", F.coalesce(F.col("value").cast("string"), F.lit("none")))
        return self.measured(tables).select("check_id", "name", "status", said.alias("detail"))


def one(df: DataFrame, value: Column) -> DataFrame:
    return df.agg(value.cast("double").alias("value"))


def below(x: float) -> Callable[[Column], Column]:
    return lambda v: v < x


def within(low: float, high: float) -> Callable[[Column], Column]:
    return lambda v: v.between(low, high)


def zero(v: Column) -> Column:
    return v == 0


def count_of(condition: Column) -> Column:
    return F.count_if(condition)


REGISTRY: dict[str, Check] = {}


def always(v: Column) -> Column:
    return F.lit(True)


def check(id_: str, name: str, needs: str, good, warn=None, info: bool = False):
    def add(measure: Callable[[Tables], DataFrame]):
        REGISTRY[id_] = Check(id_, name, tuple(needs.split()), measure, good, warn, info)
        return measure

    return add


def expected_columns(id_: str, name: str, table: str, columns: tuple[str, ...]) -> None:
    def measure(t: Tables) -> DataFrame:
        lost = len(set(columns) - set(t[table].columns))
        return t[table].limit(1).agg(F.lit(float(lost)).alias("value"))

    REGISTRY[id_] = Check(id_, name, (table,), measure, zero)


def day_of(hourly: DataFrame) -> Column:
    """The nominal day of a file where the table says it, else that of the time."""
    return F.col("date") if "date" in hourly.columns else F.to_date("ts")


def slot_off(hourly: DataFrame) -> Column:
    """Days between an hour and its slot, 00:30 to 23:30 by its place in its nominal day; none where that has not 24 hours."""
    w = W.partitionBy("cell", day_of(hourly))
    past = (F.unix_micros(F.col("ts").cast("timestamp")) - F.unix_micros(day_of(hourly).cast("timestamp"))) / 86400e6
    return F.when(F.count("*").over(w) == 24, F.abs(past - (F.row_number().over(w.orderBy("ts")) - 0.5) / 24))


#: What checks take of hours, by day.
DAY: dict[str, Callable[[], Column]] = {
    "n": lambda: F.count("*"), "n_ts": lambda: F.count("ts"), "slot_off": lambda: F.max("_off"), "ssrd_most": lambda: F.max("ssrd"),
    "gpp_sum": lambda: F.sum("gpp"), "gpp_n": lambda: F.count("gpp"), "gpp_held": lambda: F.count(F.when(~F.isnan("gpp"), F.col("gpp"))),
    "gpp_most": lambda: F.max(F.abs("gpp")), "gpp_dark": lambda: F.max(F.when(F.col("ssrd") == 0, F.abs("gpp"))),
    "nee_sum": lambda: F.sum("nee"), "nee_n": lambda: F.count("nee"), "nee_clean": lambda: F.sum(clean(F.col("nee"))),
    "nee_most": lambda: F.max(F.abs(clean(F.col("nee")))), "nee_bad": lambda: F.count_if((F.abs("nee") > 1e30) | F.isnan("nee")),
}
GPP, NEE = ("gpp_sum", "gpp_n"), ("nee_sum", "nee_n")


def mean(total: str, n: str) -> Column:
    """Mean of hours from sums and counts."""
    return F.try_divide(F.sum(total), F.sum(n))


def by_day(t: Tables, name: str, *what: str) -> DataFrame:
    """cell, ym, d (the day of the time), date (the nominal one), and ``what`` of DAY, lon and lat, and maybe more, of an
    hourly table: the one that ``digested`` kept, else made now. A day may have more than one row."""
    if f"{name} by day" in t:
        return t[f"{name} by day"]
    h, place = t[name], [x for x in what if x not in DAY]
    if "slot_off" in what:
        h = h.withColumn("_off", slot_off(h))
    values = [DAY[x]().alias(x) for x in what if x in DAY]
    return h.groupBy("cell", "ym", *place, F.to_date("ts").alias("d"), day_of(h).alias("date")).agg(*(values or [F.count("*").alias("n")]))


def by_hour(t: Tables, *place: str) -> DataFrame:
    """cell, hour of the day, gpp_sum and gpp_n: kept, else made now."""
    return t["hourly by hour"] if "hourly by hour" in t else t["hourly"].groupBy("cell", *place, F.hour("ts").alias("hour")).agg(*(DAY[x]().alias(x) for x in GPP))


def diurnal_cycle(t: Tables, place: str) -> DataFrame:
    return by_hour(t, place).groupBy("cell", place, "hour").agg(mean(*GPP).alias("m"))


def digested(t: Tables, keep: Callable[[DataFrame, str], DataFrame]) -> Tables:
    """With what checks take of hours, kept: a row a day, not an hour, for all of them."""
    out = dict(t)
    if "hourly" in t:
        out |= {"hourly by day": keep(by_day(t, "hourly", "lon", "lat", *DAY), "days"), "hourly by hour": keep(by_hour(t, "lon", "lat"), "cycle")}
    if "reference" in t:
        out["reference by day"] = keep(by_day(t, "reference", "lat", "nee_clean", "n"), "reference_days")
    return out


expected_columns("1.1", "monthly schema", "monthly", ("cell", "ym", "npp", "rh", "fire", "fuel"))
expected_columns("1.2", "fit schema", "fits", ("cell", "channel", "ym", "t0", "h", "u", "a", "b", "c"))


@check("1.3", "missing values on land", "monthly", lambda v: v <= 0.01)
def _(t):
    land = F.max(F.abs("npp")).over(W.partitionBy("cell")) > 1e-15
    return one(t["monthly"].withColumn("_land", land).filter("_land"), F.avg((F.col("npp").isNull() | F.isnan("npp")).cast("double")))


@check("1.4", "hours covered by meteo", "hourly", zero)
def _(t):
    h = by_day(t, "hourly", "n_ts").groupBy("cell", "ym").agg(F.sum("n_ts").alias("n"), F.first("ym").alias("m"))
    from gridloom.functions.calendar import days_in_month

    return one(h, F.sum(F.greatest(days_in_month(F.col("m")) * 24 - F.col("n"), F.lit(0))))


@check("2.1", "integral preserved", "fits", below(1e-9), below(1e-6))
def _(t):
    return one(diagnostics.residual(t["fits"].filter("channel = 'gpp'")), F.max("rel"))


@check("2.1r", "integral preserved, respiration", "fits", below(1e-9), below(1e-6))
def _(t):
    return one(diagnostics.residual(t["fits"].filter("channel = 'rtot'")), F.max("rel"))


@check("2.2", "hourly mean against the month's", "hourly fits", below(0.05))
def _(t):
    h = by_day(t, "hourly", *GPP).groupBy("cell", "ym").agg(mean(*GPP).alias("m"))
    f = t["fits"].filter("channel = 'gpp'").select("cell", "ym", "u")
    return exact_quantiles(h.join(f, ["cell", "ym"]), F.try_divide(F.abs(F.col("m") - F.col("u")), F.nullif(F.abs(F.col("u")), F.lit(0.0))), {"value": 0.99})


@check("2.3", "months follow each other", "monthly", zero)
def _(t):
    gap = F.col("ym") - F.lag("ym").over(W.partitionBy("cell").orderBy("ym"))
    return one(t["monthly"].select("cell", "ym").distinct().withColumn("_g", gap), F.count_if(F.col("_g") != 1))


@check("2.4", "daily mean against the month's", "hourly monthly", below(0.01))
def _(t):
    d = by_day(t, "hourly", *GPP).groupBy("cell", "ym", "d").agg(mean(*GPP).alias("v")).groupBy("cell", "ym").agg(F.avg("v").alias("m"))
    m = t["monthly"].filter(F.abs("npp") > 1e-15).select("cell", "ym", (-2 * F.col("npp")).alias("w"))
    return one(d.join(m, ["cell", "ym"]), F.max(F.abs(F.col("m") - F.col("w")) / F.abs("w")))


@check("3.1", "sign flips that logs report", "logs", lambda v: v <= 5, lambda v: v <= 15)
def _(t):
    rate = F.regexp_extract("value", r"sign-flip.*?([0-9.]+)\s*%", 1)
    return one(t["logs"].filter(F.col("value").contains("sign-flip")), F.max(F.nullif(rate, F.lit("")).cast("double")))


@check("4.1", "step where versions join", "monthly", below(0.10), below(0.25))
def _(t):
    steps = t["monthly"].groupBy("ym").agg(F.sum(clean(F.col("npp"))).alias("s"), F.max("version").alias("version")) if "version" in t["monthly"].columns else t["monthly"].groupBy("ym").agg(F.sum(clean(F.col("npp"))).alias("s"), F.lit("v1").alias("version"))
    w = W.partitionBy(F.col("ym") % 12).orderBy("ym")
    last = F.lag("s").over(w)
    return one(steps.withColumn("_d", F.when(F.lag("version").over(w) != F.col("version"), F.try_divide(F.abs(F.col("s") - last), F.abs(last)))), F.coalesce(F.max("_d"), F.lit(0.0)))


@check("P2.0", "summary has every month once", "summary", zero)
def _(t):
    return one(t["summary"], F.max("ym") - F.min("ym") + 1 - F.countDistinct("ym") + (F.count("*") - F.countDistinct("ym")))


def annual_range(id_: str, name: str, column: str, low: float, high: float) -> None:
    REGISTRY[id_] = Check(id_, name, ("summary",), lambda t: one(budget.annual(t["summary"], column), F.when(F.count("*") > 0, F.count_if(~F.coalesce(F.col(column).between(low, high), F.lit(False))))), zero)


annual_range("5.1", "annual uptake in range", "gpp_global", -200.0, -50.0)
annual_range("5.1r", "annual respiration in range", "resp_global", 30.0, 200.0)


def recent(summary: DataFrame, years: int = 5) -> DataFrame:
    """Months of the last years; the year in course does not count until it is whole."""
    y = F.floor(F.col("ym") / 12)
    n = summary.groupBy(y.alias("_y")).agg(F.count("*").alias("_n"))
    last = n.agg((F.max("_y") - (F.max_by("_n", "_y") < 12).cast("int")).alias("_last"))
    return summary.crossJoin(F.broadcast(last)).filter(y.between(F.col("_last") - years + 1, F.col("_last"))).drop("_last")  # one row


def calendar(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """The mean year: a row for each calendar month."""
    return df.groupBy((F.col("ym") % 12 + 1).alias("month")).agg(*(F.avg(c).alias(c) for c in columns))


def top_month(c: str) -> Column:
    return F.max_by("month", F.struct(c, -F.col("month")))


@check("5.2", "year-on-year changes", "summary", lambda v: v <= 10, lambda v: v <= 20)
def _(t):
    each = [budget.year_on_year(budget.annual(t["summary"], c), c).select("pct") for c in ("gpp_global", "resp_global")]
    return one(each[0].unionByName(each[1]), F.max(F.abs("pct")))


@check("5.3", "seasons of the bands: middle north against boreal, tropics and south", "summary", zero)
def _(t):
    bands = ("nee_nh_mid", "nee_boreal", "nee_trop", "nee_sh_mid")
    amplitude = {c: F.max(c) - F.min(c) for c in bands}
    apart = F.abs(top_month("nee_nh_mid") - top_month("nee_sh_mid"))
    wrong = [amplitude["nee_nh_mid"] < amplitude["nee_boreal"] * 0.5, amplitude["nee_trop"] > amplitude["nee_nh_mid"], ~apart.between(4, 8)]
    return one(calendar(recent(t["summary"]), bands), F.when(F.count("*") > 0, sum((w.cast("int") for w in wrong), F.lit(0))))


@check("6.1", "correlation with the other product, the worst month", "monthly other", lambda v: v >= 0.95, lambda v: v >= 0.85)
def _(t):
    nee = lambda d, name: d.select("cell", "ym", (clean(F.col("rh")) - clean(F.col("npp"))).alias(name))
    both = nee(t["monthly"], "l").join(nee(t["other"], "r"), ["cell", "ym"]).filter((F.abs("l") > 1e-15) | (F.abs("r") > 1e-15))
    return one(both.groupBy("ym").agg(F.corr("l", "r").alias("r")), F.min("r"))


@check("6.2", "how much more edge months differ than inner ones", "monthly other", always, info=True)
def _(t):
    nee = lambda d, name: d.filter(F.abs("lat") <= 60).select("cell", "ym", (clean(F.col("rh")) - clean(F.col("npp"))).alias(name))
    rms = nee(t["monthly"], "l").join(nee(t["other"], "r"), ["cell", "ym"]).groupBy("ym").agg(F.sqrt(F.avg(F.pow(F.col("l") - F.col("r"), 2))).alias("rms"))
    rms = rms.crossJoin(F.broadcast(rms.agg((F.max("ym") - 3).alias("_edge"))))  # one row
    of = lambda edge: F.percentile(F.when((F.col("ym") > F.col("_edge")) == edge, F.col("rms")), 0.5)  # noqa: E731 (months: hundreds of rows)
    return one(rms, F.try_divide(of(True), F.greatest(of(False), F.lit(1e-30))))


@check("7.1", "oceans are 0", "hourly monthly", lambda v: v <= 1e-12)
def _(t):
    sea = t["monthly"].groupBy("cell").agg(F.max(F.abs("npp")).alias("_land")).filter("coalesce(_land, 0) <= 1e-15").select("cell")
    own = by_day(t, "hourly", *NEE).groupBy("cell").agg(mean(*NEE).alias("v"))
    return one(own.join(sea, "cell", "left_semi"), F.coalesce(F.max(F.abs("v")), F.lit(0.0)))


@check("7.2", "Antarctic fluxes beside tropical ones", "hourly", lambda v: v <= 0.01, lambda v: v <= 0.1)
def _(t):
    own = by_day(t, "hourly", "lat", *NEE).groupBy("cell", "lat").agg(F.abs(mean(*NEE)).alias("v"))
    return one(own, F.max(F.when(F.col("lat") < -65, F.col("v"))) / F.greatest(F.max(F.when(F.abs("lat") < 23.5, F.col("v"))), F.lit(1e-30)))


@check("7.3", "boreal uptake peaks in June to August", "summary", lambda v: v.isin(6, 7, 8), always)
def _(t):
    return one(calendar(recent(t["summary"], 1), ("nee_boreal",)), F.min_by("month", F.struct("nee_boreal", "month")))


@check("7.4", "annual net flux within 10 Pg", "summary", lambda v: v <= 10)
def _(t):
    return one(budget.annual(t["summary"], "nee_global"), F.max(F.abs("nee_global")))


@check("8.1", "December to January steps are like the others", "summary", lambda v: v <= 1.5, lambda v: v <= 3)
def _(t):
    d = t["summary"].withColumn("_d", F.abs(F.col("nee_global") - F.lag("nee_global").over(W.orderBy("ym"))))  # months: hundreds of rows
    of = lambda january: F.percentile(F.when((F.col("ym") % 12 == 0) == january, F.col("_d")), 0.5)
    return one(d, F.when(F.count("*") >= 24, of(True) / F.greatest(of(False), F.lit(1e-30))))


@check("8.2", "variation between years by month", "summary", lambda v: v <= 0.5, lambda v: v <= 1.0)
def _(t):
    own = recent(t["summary"])
    spread = own.groupBy((F.col("ym") % 12).alias("month")).agg(F.try_divide(F.stddev_samp("nee_global"), F.nullif(F.abs(F.avg("nee_global")), F.lit(0.0))).alias("cov"), F.count("*").alias("n"))
    return one(spread, F.when(F.sum("n") >= 60, F.max("cov")))


@check("8.3", "polar seasons are small beside boreal ones", "summary", lambda v: v <= 0.5, lambda v: v <= 1.0)
def _(t):
    amplitude = lambda c: F.max(c) - F.min(c)
    return one(recent(t["summary"]), amplitude("nee_polar_n") / F.greatest(F.abs(amplitude("nee_boreal")), F.lit(1e-30)))


@check("9.1", "files that links name exist", "files", zero)
def _(t):
    return one(t["files"], F.count_if(~F.col("exists")))


@check("9.2", "sampled hashes match", "files", zero)
def _(t):
    return one(t["files"], F.count_if(F.col("sha256") != F.col("recorded")))


@check("10.1", "provisional files say why", "attributes", zero)
def _(t):
    has = lambda k: F.coalesce(F.try_element_at("attributes", F.lit(k)), F.lit("")) != ""
    return one(t["attributes"], F.count_if(has("provisional") != has("provisional_reason")))


@check("11.1", "no errors in logs", "logs", zero)
def _(t):
    from gridloom.sources.text import log_errors

    return one(log_errors(t["logs"], skip=("sign-flip", "0 errors")), F.count("*"))


@check("11.2", "tail is stable against the last fit", "fits previous", below(0.05), below(0.25))
def _(t):
    both = t["fits"].join(t["previous"].select("cell", "channel", "ym", F.col("c").alias("p")), ["cell", "channel", "ym"])
    back = F.row_number().over(W.partitionBy("cell", "channel").orderBy(F.desc("ym")))
    return exact_quantiles(both.withColumn("_b", back).filter("_b <= 3"), F.try_divide(F.abs(F.col("c") - F.col("p")), F.nullif(F.abs("p"), F.lit(0.0))), {"value": 0.5})


@check("12.1", "leap February has 696 hours", "hourly", zero)
def _(t):
    leap = (F.month("d") == 2) & (F.year("d") % 4 == 0) & ((F.year("d") % 100 != 0) | (F.year("d") % 400 == 0))
    return one(by_day(t, "hourly", "n").filter(leap).groupBy("cell", "ym").agg(F.sum("n").alias("n")), F.count_if(F.col("n") != 696))


@check("12.2", "no uptake in polar night", "hourly", zero)
def _(t):
    months = by_day(t, "hourly", "ssrd_most", "gpp_most").groupBy("cell", "ym").agg(F.max("ssrd_most").alias("light"), F.max("gpp_most").alias("v"))
    return one(months.filter("light = 0"), F.coalesce(F.max("v"), F.lit(0.0)))


@check("13.1", "files were written in order", "files", zero)
def _(t):
    last = F.lag("mtime").over(W.partitionBy("stream").orderBy("file"))
    return one(t["files"].withColumn("_back", F.col("mtime") < last), F.coalesce(F.count_if("_back"), F.lit(0)))


@check("13.2", "neighbours resemble each other", "monthly", lambda v: v >= 0.5)
def _(t):
    mean = t["monthly"].groupBy("cell", "i", "j").agg(F.avg("npp").alias("v"))
    return one(neighbour_pairs(mean, "v"), F.corr("v", "east"))


def biome(id_: str, name: str, lon: float, lat: float, value: str, good, warn=None) -> None:
    """Of NEE in the cell at a point: its mean over all months; or, of its mean year over the last five years, the month
    of least NEE, or how many marks of a boreal forest it lacks (least in May to September, most in November to April,
    an amplitude over 5e-7)."""

    def measure(t: Tables) -> DataFrame:
        i, j = int((lon + 180) // 1), int((lat + 90) // 1)
        own = t["monthly"].filter((F.col("i") == i) & (F.col("j") == j)).withColumn("nee", clean(F.col("rh")) - clean(F.col("npp")))
        if value == "mean":
            return one(own, F.avg("nee"))
        year = F.floor(F.col("ym") / 12)
        recent = own.withColumn("_y", year).withColumn("_last", F.max(year).over(W.partitionBy("cell"))).filter("_y >= _last - 4")
        mean = recent.groupBy((F.col("ym") % 12 + 1).alias("month")).agg(F.avg("nee").alias("m"))
        low, high = F.min_by("month", F.struct("m", "month")), F.max_by("month", F.struct("m", -F.col("month")))
        if value == "low":
            return one(mean, low)
        lacks = (~low.between(5, 9)).cast("int") + high.between(5, 10).cast("int") + (F.max("m") - F.min("m") <= 5e-7).cast("int")
        return one(mean, lacks)

    REGISTRY[id_] = Check(id_, name, ("monthly",), measure, good, warn)


# Cells that the reference finds nearest to its sites; of two as near, the one in the south or west.
biome("14.1", "Manaus: no large source", -60.5, -3.5, "mean", lambda v: v <= 5e-7)
biome("14.2", "Hyytiala: seasons of a boreal forest", 23.5, 60.5, "boreal", zero)
biome("14.3", "Sahel: uptake in the monsoon", 19.5, 12.5, "low", lambda v: v.isin(7, 8, 9, 10))
biome("19.1", "Utqiagvik: summer uptake", -156.5, 70.5, "low", lambda v: v.isin(6, 7, 8))
biome("19.2", "Caatinga: uptake in the wet season", -40.5, -10.5, "low", lambda v: v.isin(12, 1, 2, 3, 4, 5))
biome("19.3", "Kalimantan: no large source", 114.5, -2.5, "mean", lambda v: v <= 5e-7)
biome("19.4", "Central Australia: small net flux", 134.5, -25.5, "mean", lambda v: F.abs(v) <= 1e-6)


@check("15.1", "trend of net flux", "summary", lambda v: v.between(-0.5, 0.1), lambda v: F.abs(v) <= 0.5)
def _(t):
    return one(budget.annual(t["summary"], "nee_global"), F.when(F.count("*") >= 10, F.regr_slope("nee_global", "year")))


def anomaly(id_: str, name: str, column: str, event: list[int], baseline: list[int], good, warn) -> None:
    """Mean of the event's years less that of the baseline's; none unless all of them are there."""

    def measure(t: Tables) -> DataFrame:
        y = budget.annual(t["summary"], column)
        mean = lambda years: F.avg(F.when(F.col("year").isin(years), F.col(column)))
        return one(y, F.when(F.count_if(F.col("year").isin(event + baseline)) == len(event + baseline), mean(event) - mean(baseline)))

    REGISTRY[id_] = Check(id_, name, ("summary",), measure, good, warn)


anomaly("15.2", "the tropics release more in El Nino years", "nee_trop", [2015, 2016], [2010, 2011, 2012, 2013, 2014, 2017, 2018, 2019], lambda v: v > 0.1, lambda v: v > 0)
anomaly("15.3", "2020 is no outlier", "nee_global", [2020], [2019, 2021], lambda v: F.abs(v) <= 0.5, lambda v: F.abs(v) <= 1)


@check("16.1", "land cells that hourly uptake never reaches", "hourly monthly", always, info=True)
def _(t):
    land = t["monthly"].groupBy("cell").agg(F.max(F.abs("npp")).alias("_land")).filter("_land > 1e-15").select("cell")
    never = by_day(t, "hourly", "gpp_held").groupBy("cell").agg(F.sum("gpp_held").alias("n"))
    return one(never.join(land, "cell", "left_semi"), F.count_if(F.col("n") == 0))


@check("16.2", "whether sub-period trends agree", "summary", always, info=True)
def _(t):
    spans = {"first": (2001, 2012), "second": (2013, 9999), "v1": (2001, 2024), "full": (2001, 9999)}
    y = budget.annual(t["summary"], "nee_global")
    slopes = [F.when(F.count_if(F.col("year").between(*s)) >= 4, F.regr_slope(F.when(F.col("year").between(*s), F.col("nee_global")), F.col("year"))) for s in spans.values()]
    return y.agg(F.array_compact(F.array(*slopes)).alias("s")).select(F.when(F.size("s") > 0, F.forall("s", lambda x: x > 0) | F.forall("s", lambda x: x < 0)).cast("double").alias("value"))


@check("16.3", "share of the large residuals that lie in one band", "fits grid", always, info=True)
def _(t):
    r = diagnostics.residual(t["fits"]).join(t["grid"].select("cell", "lat"), "cell").select("lat", "rel")
    cut = exact_quantiles(r, "rel", {"p99": 0.99})
    over = r.crossJoin(F.broadcast(cut)).groupBy(F.floor(F.col("lat") / 30).alias("band")).agg(F.count_if(F.col("rel") > F.col("p99")).alias("n"))  # one row
    return one(over, F.coalesce(F.try_divide(F.max("n"), F.sum("n")), F.lit(0.0)))


@check("16.4", "revision horizon", "fits previous", below(0.25))
def _(t):
    both = t["fits"].join(t["previous"].select("cell", "channel", "ym", F.col("c").alias("p")), ["cell", "channel", "ym"]).withColumn("rel", F.try_divide(F.abs(F.col("c") - F.col("p")), F.nullif(F.abs("p"), F.lit(0.0))))
    from gridloom.operators.windows import tail_sweep

    return one(tail_sweep(both, "cell", "ym", "rel"), F.min("median"))


@check("17.1", "no uptake in dark hours", "hourly", zero)
def _(t):
    return one(by_day(t, "hourly", "gpp_dark"), F.coalesce(F.max("gpp_dark"), F.lit(0.0)))


@check("17.2", "uptake peaks near solar noon", "hourly", below(2.0), below(3.0))
def _(t):
    from gridloom.functions.flux import hours_apart

    cycle = diurnal_cycle(t, "lon")
    shape = budget.diurnal_shape(cycle, ("cell", "lon")).filter("amplitude > 0")
    return one(shape, F.percentile(hours_apart(F.col("low_hour") + 0.5, solar_noon(F.col("lon"))), 0.5))


@check("17.3", "daily cycle in the tropics", "hourly", lambda v: v >= 1.5)
def _(t):
    cycle = diurnal_cycle(t, "lat")
    ratio = cycle.groupBy("cell", "lat").agg((F.max("m") - F.min("m")).alias("range"), F.abs(F.avg("m")).alias("mean")).filter("mean > 1e-8").withColumn("r", F.col("range") / F.col("mean"))
    south, north = (F.percentile(F.when((F.col("lat") >= lo) & (F.col("lat") < lo + 30), F.col("r")), 0.5) for lo in (-30, 0))
    return one(ratio, F.coalesce((south + north) / 2, south, north))


@check("18.1", "pieces keep their sign", "fits", below(0.01), below(0.05))
def _(t):
    g = t["fits"].filter("channel = 'gpp' AND u != 0")
    return one(g, F.avg((piece_max(F.col("a"), F.col("b"), F.col("c"), F.col("h")) > 1e-12).cast("double")))


@check("18.2", "fit is continuous", "fits", below(1e-9))
def _(t):
    r = t["fits"].filter("channel = 'rtot'")
    return diagnostics.continuity(r).select(F.col("max_jump").alias("value"))


@check("20.1", "bands agree with the other product", "monthly other", below(0.05), below(0.15))
def _(t):
    m = lambda d: budget.band_annual_mean(d.withColumn("coslat", F.greatest(F.cos(F.radians("lat")), F.lit(0.0))), "npp", disjoint_band(F.col("lat")))
    both = m(t["monthly"]).join(m(t["other"]).withColumnRenamed("npp", "o"), ["band", "year"])
    return one(both, F.max(F.try_divide(F.abs(F.col("npp") - F.col("o")), F.nullif(F.abs("o"), F.lit(0.0)))))


@check("20.2", "net biome exchange within 3 Pg a year", "monthly", lambda v: F.abs(v) <= 3, always)
def _(t):
    nbe = clean(F.col("rh")) - clean(F.col("npp")) + clean(F.col("fire")) + clean(F.col("fuel"))
    months = t["monthly"].groupBy("ym").agg((F.sum(nbe * F.col("area_m2")) * (365.25 * SECONDS_PER_DAY / 1e15)).alias("s"))
    years = months.groupBy(F.floor(F.col("ym") / 12).alias("year")).agg(F.avg("s").alias("s"))
    return one(years.filter("year BETWEEN 2001 AND 2024"), F.avg("s"))


def outliers(id_: str, name: str, keys: tuple[str, ...]) -> None:
    def measure(t: Tables) -> DataFrame:
        from gridloom.operators.windows import z_score

        x = t["monthly"].withColumn("month", F.col("ym") % 12).withColumn("_x", clean(F.col("rh")))
        return one(x.withColumn("_z", z_score(F.col("_x"), *keys)), F.coalesce(F.count_if(F.abs("_z") > 6), F.lit(0)))

    REGISTRY[id_] = Check(id_, name, ("monthly",), measure, zero)


outliers("21.1", "outliers by cell", ("cell",))
outliers("21.2", "outliers by cell and calendar month", ("cell", "month"))


@check("22.1", "median wall time", "manifest", lambda v: v <= 1500, lambda v: v <= 1800)
def _(t):
    return one(t["manifest"].filter("NOT malformed AND step = 'diurnalize' AND status = 'ok'"), F.percentile(F.expr("try_cast(elapsed_s AS double)"), 0.5))


def attribute(id_: str, name: str, key: str) -> None:
    REGISTRY[id_] = Check(id_, name, ("attributes",), lambda t: one(t["attributes"], F.count_if(F.coalesce(F.try_element_at("attributes", F.lit(key)), F.lit("")) == "")), zero)


attribute("23.1", "attributes name a source", "source")
attribute("23.2", "attributes name a history", "history")
attribute("23.3", "attributes name a commit", "commit")


@check("24.1", "manifest lines have seven columns", "manifest", zero)
def _(t):
    return one(t["manifest"], F.count_if("malformed"))


@check("24.2", "no recent failures", "manifest", zero)
def _(t):
    last = t["manifest"].filter("NOT malformed").groupBy("step").agg(F.max_by("status", F.struct("timestamp")).alias("status"))
    return one(last, F.count_if(F.col("status") != "ok"))


# Climatology prior: series, fit, delivery, round trip.
@check("C1.1", "series covers the delivery on both sides", "series delivery", zero)
def _(t):
    s, d = t["series"].agg(F.min("ym").alias("lo"), F.max("ym").alias("hi")), t["delivery"].agg(F.min("ym").alias("dlo"), F.max("ym").alias("dhi"))
    return one(s.crossJoin(F.broadcast(d)), F.max(((F.col("lo") >= F.col("dlo")) | (F.col("hi") <= F.col("dhi"))).cast("int")))  # one row each


def year_of(ym: str = "ym") -> Column:
    return F.floor(F.col(ym) / 12).cast("int")


def delivered_years(t: Tables) -> DataFrame:
    """One row for each year from the first to the last of the delivery."""
    return t["delivery"].agg(F.min(year_of()).alias("lo"), F.max(year_of()).alias("hi")).filter("lo IS NOT NULL").select(F.explode(F.sequence("lo", "hi")).alias("year"))


@check("C1.2", "series covers every delivered year", "series delivery", zero)
def _(t):
    return one(delivered_years(t).join(t["series"].select(year_of().alias("year")).distinct(), "year", "left_anti"), F.count("*"))


@check("C1.3", "series is padded on both sides", "series delivery", zero, always)
def _(t):
    s, d = t["series"].agg(F.min(year_of()).alias("lo"), F.max(year_of()).alias("hi")), delivered_years(t).agg(F.min("year").alias("dlo"), F.max("year").alias("dhi"))
    return one(s.crossJoin(F.broadcast(d)), F.max(((F.col("lo") >= F.col("dlo")) | (F.col("hi") <= F.col("dhi"))).cast("int")))  # one row each


@check("C1.4", "a calendar month is the same in every year", "series", zero)
def _(t):
    return one(t["series"].groupBy("cell", (F.col("ym") % 12).alias("month")).agg((F.max("npp") - F.min("npp")).alias("spread")), F.max("spread"))


@check("C1.5", "calendar months rest on equal counts", "series", zero)
def _(t):
    return one(t["series"].groupBy("cell", (F.col("ym") % 12).alias("month")).agg(F.count("*").alias("n")), F.max("n") - F.min("n"))


def said(key: str) -> Column:
    return F.try_element_at("attributes", F.lit(key))


@check("C1.6", "the baseline asked for was there", "attributes", zero, always)
def _(t):
    actual = F.coalesce(said("climatology_baseline"), F.lit("?"))
    return one(t["attributes"], F.count_if(F.coalesce(said("climatology_baseline_requested"), actual) != actual))


@check("C1.7", "imposed variables vary between years", "series", lambda v: v > 0)
def _(t):
    july = t["series"].filter(F.col("ym") % 12 == 6)
    return one(july.groupBy("cell").agg((F.max("fire") - F.min("fire")).alias("spread")), F.max("spread"))


@check("C2.1", "every delivered month has its own coefficients", "fits delivery", zero)
def _(t):
    return one(t["delivery"].select("cell", "ym").distinct().join(t["fits"].select("cell", "ym"), ["cell", "ym"], "left_anti"), F.count("*"))


@check("C2.2", "fit of the climatology keeps means", "fits", below(1e-6))
def _(t):
    return one(diagnostics.residual(t["fits"]), F.max("rel"))


@check("C2.3", "fit is the same in every year", "fits", below(1e-9))
def _(t):
    inner = t["fits"].withColumn("_n", F.row_number().over(W.partitionBy("cell", "channel").orderBy("ym"))).withColumn("_m", F.row_number().over(W.partitionBy("cell", "channel").orderBy(F.desc("ym")))).filter("_n > 12 AND _m > 12")
    same = inner.groupBy("cell", "channel", (F.col("ym") % 12).alias("month"), "h").agg(F.try_divide(F.max("c") - F.min("c"), F.nullif(F.max(F.abs("c")), F.lit(0.0))).alias("spread"))
    return one(same, F.max("spread"))


def lost_days(t: Tables) -> DataFrame:
    """By cell and delivered year: days without an hour."""
    h = by_day(t, "hourly").select("cell", F.col("date").alias("d"))
    found = h.distinct().groupBy("cell", F.year("d").alias("year")).agg(F.count("*").alias("n"))
    wanted = h.select("cell").distinct().crossJoin(F.broadcast(delivered_years(t)))  # years of a record
    days = F.datediff(F.make_date(F.col("year") + 1, F.lit(1), F.lit(1)), F.make_date("year", F.lit(1), F.lit(1)))
    return wanted.join(found, ["cell", "year"], "left").select("cell", "year", (days - F.coalesce("n", F.lit(0))).alias("lost"))


@check("C3.1", "every delivered year has its days", "hourly delivery", zero)
def _(t):
    """3.1, 3.2, ... of the reference, a year each: the worst year."""
    return one(lost_days(t), F.max("lost"))


@check("C3.a", "all days of the delivery are there", "hourly delivery", zero)
def _(t):
    return one(lost_days(t), F.sum("lost"))


@check("C3.b", "no file is empty", "files", zero)
def _(t):
    return one(t["files"], F.count_if(F.col("size") == 0))


@check("C3.c", "no day is missing", "hourly", zero)
def _(t):
    d = by_day(t, "hourly").select("cell", "d").distinct().groupBy("cell").agg(F.count("*").alias("n"), F.datediff(F.max("d"), F.min("d")).alias("span"))
    return one(d, F.max(F.col("span") + 1 - F.col("n")))


@check("C3.d", "days have 24 hours", "hourly", zero)
def _(t):
    return one(by_day(t, "hourly", "n").groupBy("cell", "d").agg(F.sum("n").alias("n")), F.count_if(F.col("n") != 24))


def round_trip(days: DataFrame, monthly: DataFrame) -> DataFrame:
    """The worst deviation of a month's hourly means from the monthly field they were made of, by its largest value."""
    h = days.groupBy("cell", "ym").agg(mean("nee_clean", "n").alias("m"))
    field = monthly.select("cell", "ym", (clean(F.col("rh")) - clean(F.col("npp"))).alias("w"))
    peak = field.groupBy("ym").agg(F.max(F.abs("w")).alias("p"))
    worst = h.join(field, ["cell", "ym"]).groupBy("ym").agg(F.max(F.abs(F.col("m") - F.col("w"))).alias("d")).join(peak, "ym")
    return one(worst, F.max(F.col("d") / F.when(F.col("p") == 0, 1.0).otherwise(F.col("p"))))


@check("C3.e", "slots are 00:30 to 23:30 of their day", "hourly", below(1e-9))
def _(t):
    return one(by_day(t, "hourly", "slot_off"), F.max("slot_off"))


@check("C3.f", "29 February is there and unlike the 28th", "hourly delivery", zero)
def _(t):
    y = F.col("year")
    leap = delivered_years(t).filter((y % 4 == 0) & ((y % 100 != 0) | (y % 400 == 0)))
    h = by_day(t, "hourly", "nee_clean", "n").withColumn("d", F.col("date")).filter((F.month("d") == 2) & (F.dayofmonth("d") >= 28))
    on = lambda k: F.try_divide(*(F.sum(F.when(F.dayofmonth("d") == k, F.col(c))) for c in ("nee_clean", "n")))
    apart = h.groupBy("cell", F.year("d").alias("year")).agg(F.abs(on(29) - on(28)).alias("d")).groupBy("year").agg(F.max("d").alias("d"))
    return one(leap.join(apart, "year", "left"), F.when(F.count("*") > 0, F.count_if(~F.coalesce(F.col("d") > 0, F.lit(False)))))


# Parity with the other product, of what a table shows: columns and types, not chunking or compression.
@check("C4.0", "the other product has a day of these", "hourly reference", lambda v: v > 0)
def _(t):
    days = lambda name: by_day(t, name).select("date").distinct()
    return one(days("hourly").join(days("reference"), "date"), F.count("*"))


@check("C4.1", "columns and types are those of the other product", "hourly reference", zero)
def _(t):
    from gridloom.plans.lineage import schema_drift

    drift = schema_drift(t["hourly"], dict(t["reference"].dtypes))
    return t["hourly"].sparkSession.range(1).select(F.lit(float(sum(map(len, drift.values())))).alias("value"))


CLIMATOLOGY_SAYS = ("flux_from_climatology", "prior_variant", "climatology_baseline", "climatology_method", "scope_note")


@check("C4.2", "files say that they are a climatology", "attributes", zero)
def _(t):
    return one(t["attributes"], F.count_if(F.exists(F.array(*map(F.lit, CLIMATOLOGY_SAYS)), lambda k: F.try_element_at("attributes", k).isNull())))


@check("C4.3", "flux_from_climatology is yes", "attributes", zero)
def _(t):
    own = said("flux_from_climatology")
    return one(t["attributes"], F.when(F.count(own) > 0, F.count_if(own != "yes")))


@check("C5.1", "hourly means return the month's", "hourly monthly", below(5e-3))
def _(t):
    return round_trip(by_day(t, "hourly", "nee_clean", "n"), t["monthly"])


@check("C5.1b", "the deviation is no more than twice the other product's", "hourly monthly reference reference_monthly", lambda v: v <= 2)
def _(t):
    days = lambda name: by_day(t, name, "nee_clean", "n")
    own, other = round_trip(days("hourly"), t["monthly"]), round_trip(days("reference"), t["reference_monthly"]).withColumnRenamed("value", "o")
    ratio = F.when(F.col("o") == 0, F.lit(float("inf"))).otherwise(F.col("value") / F.col("o"))
    return own.crossJoin(F.broadcast(other)).select(ratio.alias("value"))  # one row each


@check("C5.2", "no trend in a climatology", "series", below(1e-9))
def _(t):
    y = t["series"].groupBy(F.floor(F.col("ym") / 12).alias("year")).agg(F.sum("npp").alias("s"), F.count("*").alias("n")).withColumn("full", F.max("n").over(W.partitionBy())).filter("n = full")  # years
    return one(y, F.abs(F.try_divide(F.regr_slope("s", "year"), F.nullif(F.avg(F.abs("s")), F.lit(0.0)))))


def hourly_trend(days: DataFrame) -> DataFrame:
    """Pg a year and year, of net flux over cells of one degree."""
    year = days.groupBy(year_of().alias("year")).agg((F.sum(F.col("nee_clean") * cell_area(F.col("lat") - 0.5, F.col("lat") + 0.5, 1.0)) * 3600 / 1e15).alias("s"))
    return one(year, F.regr_slope("s", "year"))


@check("C5.3", "the other product does show a trend", "hourly reference", lambda v: v > 10, always)
def _(t):
    """Its trend by this one's."""
    own, other = (hourly_trend(by_day(t, name, "lat", "nee_clean")) for name in ("hourly", "reference"))
    other = other.withColumnRenamed("value", "o")
    ratio = F.when(F.col("value") == 0, F.when(F.col("o") != 0, F.lit(float("inf"))).otherwise(0.0)).otherwise(F.abs(F.col("o") / F.col("value")))
    return own.crossJoin(F.broadcast(other)).select(F.when(F.col("o").isNotNull(), ratio).alias("value"))  # one row each


@check("C5.4", "hours differ from the other product's", "hourly reference", lambda v: v > 0)
def _(t):
    both = t["hourly"].select("cell", "ts", clean(F.col("nee")).alias("v")).join(t["reference"].select("cell", "ts", clean(F.col("nee")).alias("o")), ["cell", "ts"])
    return one(both, F.when(F.count("*") > 0, F.count_if(F.col("v") != F.col("o"))))


@check("C5.5", "no sentinel is delivered", "hourly", zero)
def _(t):
    return one(by_day(t, "hourly", "nee_bad"), F.coalesce(F.sum("nee_bad"), F.lit(0)))


@check("C5.6", "peak is plausible", "hourly", lambda v: (v > 1e-8) & (v < 1e-3), always)
def _(t):
    return one(by_day(t, "hourly", "nee_most"), F.max("nee_most") / GC_PER_MOL)


# Extension of a climatology.
@check("X.count", "months have all their days", "hourly", zero)
def _(t):
    d = by_day(t, "hourly").select("cell", F.col("date").alias("d")).distinct().groupBy("cell")
    return one(d.agg((F.datediff(F.last_day(F.max("d")), F.trunc(F.min("d"), "month")) + 1 - F.count("*")).alias("lost")), F.sum("lost"))


STAMP = {"flux_from_climatology": "yes", "climatology_baseline": "2001-2020", "respiration_temperature_driver": "airtemp", "respiration_temperature_function": "q10"}


@check("X.stamp", "attributes are those of the product", "attributes", zero)
def _(t):
    wrong = F.lit(False)
    for k, v in STAMP.items():
        wrong = wrong | ~said(k).eqNullSafe(F.lit(v))
    return one(t["attributes"], F.count_if(wrong))


@check("X.live", "hours differ from those of the reference year", "hourly reference_year", lambda v: v > 0.99)
def _(t):
    """Share of slots on land, by their number in the month; 0 where months have other numbers of slots."""
    keys = ["cell", "month"]
    slot = lambda h, v: h.select("cell", (F.col("ym") % 12).alias("month"), F.row_number().over(W.partitionBy("cell", "ym").orderBy("ts")).alias("k"), F.col("nee").alias(v))
    own, other = slot(t["hourly"], "v"), slot(t["reference_year"], "o")
    land = by_day(t, "hourly", "nee_clean", "n").groupBy("cell", (F.col("ym") % 12).alias("month")).agg(F.abs(mean("nee_clean", "n")).alias("_m")).filter("_m > 0")
    both = own.withColumn("a", F.lit(1)).join(other.withColumn("b", F.lit(1)), [*keys, "k"], "full")
    differ = F.col("v") != F.col("o")
    months = both.groupBy(*keys).agg(F.count("a").alias("a"), F.count("b").alias("b"), F.count("*").alias("n"), F.count_if(differ).alias("differ"), F.count(differ).alias("compared"))
    months = months.filter("a > 0 AND b > 0").join(land, keys, "left_semi")
    return one(months, F.when(F.sum(2 * F.col("n") - F.col("a") - F.col("b")) > 0, 0.0).otherwise(F.try_divide(F.sum("differ"), F.sum("compared"))))


@check("X.budget", "difference of the yearly net flux, Pg", "monthly other", zero, info=True)
def _(t):
    year = lambda d: one(d, F.sum((clean(F.col("rh")) - clean(F.col("npp"))) * F.col("area_m2")) / F.countDistinct("ym") * (365 * SECONDS_PER_DAY / 1e15))
    return year(t["monthly"]).crossJoin(F.broadcast(year(t["other"]).withColumnRenamed("value", "o"))).select((F.col("value") - F.col("o")).alias("value"))  # one row each


@check("X.mean", "means agree to 10 units of single precision", "monthly other", lambda v: v <= 10)
def _(t):
    both = t["monthly"].select("cell", "ym", "npp").join(t["other"].select("cell", "ym", F.col("npp").alias("o")), ["cell", "ym"])
    peak = F.max(F.abs("o")).over(W.partitionBy("cell"))
    return one(both.withColumn("_p", peak), F.max(diagnostics.float_ulps(F.col("npp"), F.col("o"), F.col("_p"))))


@check("X.false", "another month does not agree", "monthly other", lambda v: v > 10)
def _(t):
    both = t["monthly"].select("cell", "ym", "npp").join(t["other"].select("cell", (F.col("ym") + 1).alias("ym"), F.col("npp").alias("o")), ["cell", "ym"])
    peak = F.max(F.abs("o")).over(W.partitionBy("cell"))
    return one(both.withColumn("_p", peak), F.max(diagnostics.float_ulps(F.col("npp"), F.col("o"), F.col("_p"))))


def measured(tables: Tables, ids: tuple[str, ...]) -> DataFrame:
    """check_id, name, status and value of the checks named; their tables are all there."""
    return reduce(DataFrame.unionByName, [REGISTRY[i].measured(tables) for i in ids])


def run(tables: Tables, ids: tuple[str, ...] | None = None) -> DataFrame:
    """Results of all checks (or of those named), one row each; one whose tables are not all there is skipped and says which."""
    spark = next(iter(tables.values())).sparkSession if tables else SparkSession.active()
    out = None
    for c in [REGISTRY[i] for i in ids] if ids else REGISTRY.values():
        lost = [n for n in c.needs if n not in tables]
        row = spark.range(1).select(F.lit(c.id).alias("check_id"), F.lit(c.name).alias("name"), F.lit("SKIP").alias("status"), F.lit("no table: " + ", ".join(lost)).alias("detail")) if lost else c.run(tables)
        out = row if out is None else out.unionByName(row)
    return out


#: Checks that run at once: more would keep more shuffles at a time.
AT_ONCE = 4


def collected(tables: Tables, keep: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """As ``run`` of all checks, a few at a time: what one shuffles is gone before the next begin, and hours are read
    for a row a day. Only the rows told, one a check, reach the driver."""
    whole, ids, rows = digested(tables, keep), tuple(REGISTRY), []
    for k in range(0, len(ids), AT_ONCE):
        part = run(whole, ids[k : k + AT_ONCE])
        rows += part.collect()
    return part.sparkSession.createDataFrame(rows, part.schema)


def summary(results: DataFrame) -> DataFrame:
    return results.groupBy("status").agg(F.count("*").alias("n"))
