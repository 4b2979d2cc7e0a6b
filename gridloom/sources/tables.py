"""Tables: canonical stores, path templates, and the example tables read as series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from gridloom.functions.calendar import ym


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{name}.parquet")


def write_partitioned(df: DataFrame, path: str, *by: str) -> None:
    """Overwrite only the partitions that ``df`` has; rows of one partition go to one file."""
    df.repartition(*by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def months_together(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Monthly files as one table."""
    return spark.read.parquet(*paths)


#: Layouts of stores by what their paths look like, the most particular first.
LAYOUTS = {"partitioned": r"/year=\d{4}/month=\d{2}/", "nested": r"/\d{4}/\d{2}/[^/]+$", "yearly": r"/\d{4}/[^/]+$", "flat": r""}


def layout(path: Column) -> Column:
    """The name of a path's layout."""
    out = F.lit("flat")
    for name, pattern in reversed(LAYOUTS.items()):
        out = F.when(path.rlike(pattern), name).otherwise(out) if pattern else out
    return out


def daily_path(version: Column, ts: Column, root: str = "daily") -> Column:
    return F.format_string(f"{root}/version=%s/year=%04d/month=%02d/%s.nc", version, F.year(ts), F.month(ts), F.date_format(ts, "yyyyMMdd"))


def meteo_path(template: str, ts: Column, variable: Column) -> Column:
    """Fill {year}, {month}, {day} and {var} of a template."""
    out = F.lit(template)
    for name, x in (("year", F.date_format(ts, "yyyy")), ("month", F.date_format(ts, "MM")), ("day", F.date_format(ts, "dd")), ("var", variable)):
        out = F.replace(out, F.lit("{" + name + "}"), x)
    return out


#: Which way each flux counts, kept with its column.
SIGNS = {"gpp": "negative: uptake by land", "resp": "positive: release to air", "nee": "positive: release to air"}


def write_flux(hourly: DataFrame, path: str) -> None:
    """Hourly fluxes by month, each flux with its sign convention among its column's attributes."""
    said = [F.col(c).alias(c, metadata={"sign": SIGNS[c]}) if c in SIGNS else F.col(c) for c in hourly.columns]
    write_partitioned(hourly.select(*said, F.date_format("ts", "yyyyMM").cast("int").alias("month")), path, "month")


def signs(df: DataFrame) -> dict[str, str]:
    """The sign conventions that a stored table's columns carry."""
    return {f.name: f.metadata["sign"] for f in df.schema.fields if "sign" in (f.metadata or {})}


def write_fit(fitted: DataFrame, path: str) -> None:
    """Coefficients by year: what a later run reads in place of fitting again."""
    write_partitioned(fitted.withColumn("year", F.floor(F.col("ym") / 12).cast("int")), path, "year")


def read_fit(spark: SparkSession, path: str, first: int, last: int) -> DataFrame:
    """Stored coefficients of the months first..last; other years' files are not opened."""
    return spark.read.parquet(path).filter(F.col("year").between(first // 12, last // 12) & F.col("ym").between(first, last)).drop("year")


def day_files(hourly: DataFrame, path: str) -> None:
    """Daily files of net flux alone."""
    write_partitioned(hourly.select("cell", "ts", "nee", F.to_date("ts").alias("date")), path, "date")


def monthly(spark: SparkSession, root: str) -> DataFrame:
    """cell, ym, u, v: monthly means of price and quantity by supplier."""
    return table(spark, root, "lineitem").groupBy(F.col("l_suppkey").cast("int").alias("cell"), ym(F.col("l_shipdate")).cast("int").alias("ym")).agg(F.avg("l_extendedprice").alias("u"), F.avg("l_quantity").alias("v"))


def hourly(spark: SparkSession, root: str) -> DataFrame:
    """cell, ts (hour), value: hourly means of events by type."""
    return table(spark, root, "events").groupBy(F.col("event_type").alias("cell"), F.date_trunc("hour", "ts").alias("ts")).agg(F.avg("value").alias("value"))


def regional(spark: SparkSession, root: str) -> DataFrame:
    """cell (nation), ym, u, lat: monthly order values with a made-up latitude for each nation."""
    orders, customer = table(spark, root, "orders"), table(spark, root, "customer")
    place = F.broadcast(table(spark, root, "nation"))  # 25 rows
    joined = orders.join(customer, orders["o_custkey"] == customer["c_custkey"]).join(place, F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.groupBy(F.col("n_nationkey").alias("cell"), ym(F.col("o_orderdate")).cast("int").alias("ym")).agg(F.avg("o_totalprice").alias("u")).withColumn("lat", (F.col("cell") * 7.25 - 88).cast("double"))
