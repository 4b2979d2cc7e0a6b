"""Time fits at the size of a whole one-degree grid: one JSON line.

Two channels of 64,800 cells by 303 months, made up and written first; then each fit is read from Parquet, computed and
written to Spark's no-op sink. Arguments: the fits to time (pchip, ppm and minmod unless given). BENCH_CPUS: local cores.
"""

import json
import os
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"

CELLS, MONTHS, FIRST = 64_800, 303, 2001 * 12


def main(names: list[str]) -> None:
    from pyspark.sql import SparkSession, functions as F

    from gridloom.operators.series import with_knots
    from gridloom.plans.fits import fit

    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = SparkSession.builder.master(f"local[{cpus}]").appName("bench-grid").config("spark.sql.shuffle.partitions", str(4 * int(cpus))).config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "8g").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    took = {}
    with tempfile.TemporaryDirectory() as folder:
        cells = spark.range(CELLS).select(F.col("id").cast("int").alias("cell"))
        own = cells.select("cell", F.explode(F.sequence(F.lit(FIRST), F.lit(FIRST + MONTHS - 1))).alias("ym"))
        season = 1 + F.cos((F.col("ym") % 12 - 6) * (3.141592653589793 / 6)) * 0.9
        noise = lambda k: 0.8 + 0.4 * (F.pmod(F.xxhash64(F.lit(k), "cell", "ym"), F.lit(1 << 20)) / (1 << 20))
        for channel in ("gpp", "resp"):
            with_knots(own.select("cell", "ym", (season * noise(channel)).alias("u"))).write.parquet(f"{folder}/{channel}")
        for name in names:
            began = time.time()
            for channel in ("gpp", "resp"):
                fit(spark.read.parquet(f"{folder}/{channel}"), name).write.format("noop").mode("overwrite").save()
            took[name] = round(time.time() - began, 2)
    print(json.dumps({"metric": "fits_of_a_whole_grid", "unit": "sec", "cells": CELLS, "months": MONTHS, "channels": 2, "fits": took, "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:] or ["pchip", "ppm", "minmod"])
