"""Exact quantiles against sorting."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridloom.operators import quantiles
from gridloom.operators.quantiles import exact_quantiles


@pytest.mark.parametrize("grid,bins", [(500, 4_096), (10, 3)])
def test_as_sorting_gives_them(spark, monkeypatch, grid, bins):
    monkeypatch.setattr(quantiles, "GRID", grid)
    monkeypatch.setattr(quantiles, "ACCURACY", grid * 10)
    monkeypatch.setattr(quantiles, "BINS", bins)
    rng = random.Random(3)
    rows = [("wide", rng.lognormvariate(0, 3)) for _ in range(3_000)] + [("ties", float(rng.randrange(4))) for _ in range(2_000)] + [("one", 5.0), (None, -1.0), (None, 2.0), ("one", None), ("all null", None), ("signs", -0.5), ("signs", 1e300), ("signs", -1e300)]
    df = spark.createDataFrame(rows, "key string, x double").repartition(7)
    probs = {"low": 0.0, "mid": 0.5, "p99": 0.99, "p975": 0.975, "top": 1.0}
    got = {r["key"]: r for r in exact_quantiles(df, "x", probs, ("key",)).collect()}
    assert got == {r["key"]: r for r in exact_quantiles(df, "x", probs, ("key",), few=True).collect()}
    keys = {k for k, x in rows if x is not None}
    assert set(got) == keys
    for key in keys:
        own = [x for k, x in rows if k == key and x is not None]
        for name, p in probs.items():
            assert got[key][name] == pytest.approx(np.quantile(own, p), rel=1e-12), (key, name)
    more = {r["key"]: r for r in exact_quantiles(df, "x", probs, ("key",), also=(F.count("*").alias("rows"), F.max("x").alias("most"))).collect()}
    assert {k: tuple(r)[: 1 + len(probs)] for k, r in more.items() if k in keys} == {k: tuple(r) for k, r in got.items()}
    assert set(more) == keys | {"all null"} and more["all null"]["mid"] is None and more["all null"]["rows"] == 1 and more["ties"]["most"] == 3.0 and more["one"]["rows"] == 2
    whole = exact_quantiles(df, "x", {"mid": 0.5}, also=(F.count("*").alias("rows"),)).collect()
    assert len(whole) == 1 and whole[0]["rows"] == len(rows)
    alone = exact_quantiles(df.filter("key = 'wide'"), F.col("x") * 2, {"mid": 0.5}).collect()
    assert len(alone) == 1 and alone[0]["mid"] == pytest.approx(2 * np.median([x for k, x in rows if k == "wide"]))


def test_of_nothing(spark):
    df = spark.createDataFrame([], "key string, x double")
    assert exact_quantiles(df, "x", {"mid": 0.5}, ("key",)).count() == 0
    assert exact_quantiles(df, "x", {"mid": 0.5}).collect()[0]["mid"] is None
