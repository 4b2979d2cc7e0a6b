import datetime as dt

import pytest
from pyspark.sql import functions as F

from gridloom.operators import series as S
from gridloom.plans import checks, lineage
from gridloom.plans.diagnostics import binomial_p
from gridloom.sources import tables, text
from gridloom.streaming.monthly import partial_days, upsert


def test_freshness_is_strict(spark):
    src = spark.createDataFrame([(1, 5), (2, 5), (3, 5)], "k int, mtime int")
    out = spark.createDataFrame([(1, 6), (2, 5)], "k int, mtime int")
    assert sorted(r["k"] for r in lineage.stale(src, out, ("k",)).collect()) == [2, 3]


def test_runs(spark):
    rows = [(1, d, "primary" if d < 31 else "fasttrack") for d in range(1, 32)]
    df = spark.createDataFrame(rows, "ym int, d int, src string")
    assert S.runs(df, ("ym",), "d", "src").first()["runs"] == "primary:1-30 fasttrack:31"


def test_source_resolution_needs_all_variables(spark):
    df = spark.createDataFrame([(1, "a", 0, "t"), (1, "b", 1, "t"), (1, "b", 1, "s"), (2, "a", 0, "t")], "day int, src string, prio int, var string")
    got = {r["day"]: r["resolved"] for r in S.resolve_source(df, ("day",), "src", "prio", "var", 2).collect()}
    assert got == {1: "b", 2: None}


def test_climatology_window(spark):
    df = spark.createDataFrame([(1, y * 12, float(y)) for y in range(2001, 2026)], "cell int, ym int, u double")
    got = S.month_mean(df, baseline=(2001, 2020)).filter("month = 0").first()
    assert got["u"] == pytest.approx(2010.5) and got["n"] == 20
    assert S.month_mean(df).filter("month = 0").first()["u"] != got["u"]
    assert S.month_mean(df).filter("month = 5").first()["u"] is None
    with pytest.raises(ValueError):
        S.month_mean(df, baseline=(1990, 1991))
    with pytest.raises(ValueError):
        S.doy_mean(spark.createDataFrame([(1, 1, 1, 1.0, True)], "cell int, month int, day int, v double, is_clim boolean"))


def test_manifest(spark):
    lines = spark.createDataFrame([("# c",), ("a\tb",), ("t\tdiurnalize\tok\th\tc\t1200\td",)], "value string")
    got = text.manifest(lines).collect()
    assert [r["malformed"] for r in got] == [True, False] and got[1]["elapsed_s"] == "1200"


def test_hashes(spark):
    lines = spark.createDataFrame([("a" * 64 + "  x/f1", "1"), ("b" * 64 + "  f1", "2"), ("bad", "2"), ("c" * 64 + " *f2", "1")], "value string, manifest string")
    got = {r["file"]: r["sha256"][0] for r in text.hash_manifest(lines).collect()}
    assert got == {"f1": "b", "f2": "c"}
    files = spark.createDataFrame([("f1", "b" * 64), ("f2", "x" * 64), ("f3", "y" * 64)], "file string, sha256 string")
    assert tuple(lineage.verify(files, text.hash_manifest(lines)).first()) == (1, 1, 1)


def test_conf(spark):
    lines = spark.createDataFrame([('A="x y"',), ("#B=1",), ("export C=3 # c",), ("D=''",)], "value string")
    assert {r["key"]: r["value"] for r in text.conf(lines).collect()} == {"A": "x y", "C": "3", "D": ""}


def test_tower_columns():
    names = ["TA_F_1_1_1", "TA_PI_1_1_1", "TA_1_2_1", "TA_1_1_1", "TIMESTAMP_START", "SW_IN_F", "SW_IN_F_1_1_1", "TS_1_2_A", "TS_PI_1_1_1", "NEE_PI_F_1_1_1", "FC_1_1_1", "FC_SSITC_TEST_1_1_1", "TA_QC_1_1_1"]
    assert text.pick_column(names, "TA") == "TA_1_1_1"
    assert text.pick_column(names, "SW_IN") is None and text.pick_column(names, "SW_IN", filled=True) == "SW_IN_F_1_1_1"
    assert text.pick_column(names, "TS") == "TS_1_2_A" and text.pick_column(names, "TS", shallowest=True) == "TS_PI_1_1_1"
    assert text.pick_column(names, "USTAR") is None and text.pick_column(["TA_QC_1_1_1", "TA_1_1"], "TA") is None
    assert text.pick_flux(names) == "FC_1_1_1" and text.pick_flux([*names, "NEE_PI_1_1_1"]) == "NEE_PI_1_1_1"


def test_tower_files(spark, tmp_path):
    (tmp_path / "t.csv").write_text("# a\n# b\nTA,NEE\n1.5,2\n-9999,3\n")
    (tmp_path / "u.csv").write_text("# a\n# b\nNEE,X, TA\n7,,8\n9,1\n5,1,\n")
    assert [tuple(r) for r in text.tower_csv(spark, str(tmp_path / "t.csv"), ["TA", "NEE"]).collect()] == [("1.5", "2")]
    assert sorted(tuple(r) for r in text.tower_csv(spark, str(tmp_path / "*.csv"), ["TA", "NEE"]).collect()) == [("1.5", "2"), ("8", "7")]


def test_grid_files_are_read_a_step_at_a_time(monkeypatch):
    import sys
    import types

    import numpy as np
    import pyarrow as pa

    from gridloom.sources import netcdf

    steps = np.ma.masked_array(np.arange(24, dtype="float32").reshape(2, 3, 4), mask=False)
    steps[0, 1, 2], steps.mask[1, 0, 0] = -1e34, True
    flat = np.array([[1.0, np.nan], [np.inf, 4.0]])

    class Dataset:
        def __init__(self, path):
            self.variables = {"NPP": steps, "area": flat}

        def __enter__(self):
            return self

        def __exit__(self, *_):
            pass

    monkeypatch.setitem(sys.modules, "netCDF4", types.SimpleNamespace(Dataset=Dataset))
    reader = netcdf.GridFiles({"paths": "a.nc,b.nc", "vars": "NPP,area"}).reader(None)
    assert [p.value for p in reader.partitions()] == ["a.nc", "b.nc"]
    batches = list(reader.read(reader.partitions()[0]))
    assert [b.num_rows for b in batches] == [12, 12, 4]
    rows = pa.Table.from_batches(batches).to_pylist()
    assert {(r["t"], r["j"], r["i"]): r["value"] for r in rows if r["name"] == "NPP"} == {(t, j, i): None if (t, j, i) in ((0, 1, 2), (1, 0, 0)) else float(t * 12 + j * 4 + i) for t in range(2) for j in range(3) for i in range(4)}
    assert [r["value"] for r in rows if r["name"] == "area"] == [1.0, None, None, 4.0]
    assert {r["path"] for r in rows} == {"a.nc"}


def test_identity():
    assert lineage.enforce_identity(None, {"fit": "a"}) == "created"
    assert lineage.enforce_identity({"fit": "a", "x": "1"}, {"fit": "a"}) == "match"
    assert lineage.enforce_identity({"fit": "b"}, {"fit": "a"}, True) == "mixed"
    with pytest.raises(ValueError):
        lineage.enforce_identity({"fit": "b"}, {"fit": "a"})


def test_writes_only_the_partitions_given(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_partitioned(spark.createDataFrame([(1, 1), (2, 2)], "v int, p int"), path, "p")
    tables.write_partitioned(spark.createDataFrame([(9, 2)], "v int, p int"), path, "p")
    assert sorted(map(tuple, spark.read.parquet(path).collect())) == [(1, 1), (9, 2)]


def test_checks_pass_and_fail(spark):
    good = spark.createDataFrame([("t", "diurnalize", "ok", "h", "c", "1200", "d", False)], "timestamp string, step string, status string, host string, commit string, elapsed_s string, detail string, malformed boolean")
    bad = good.withColumn("elapsed_s", F.lit("9999")).withColumn("status", F.lit("fail")).withColumn("malformed", F.lit(False))
    status = lambda df, i: checks.run({"manifest": df}, (i,)).first()["status"]
    assert status(good, "22.1") == "PASS" and status(good.withColumn("elapsed_s", F.lit("1600")), "22.1") == "WARN" and status(good.withColumn("elapsed_s", F.lit("9999")), "22.1") == "FAIL"
    assert status(bad, "22.1") == "SKIP" and status(bad, "24.2") == "FAIL" and status(good, "24.2") == "PASS"
    m = spark.createDataFrame([(1, 24000, 0.0), (1, 24001, 0.0), (2, 24000, 5.0)], "cell int, ym int, npp double")
    sea = spark.createDataFrame([(1, 0.0), (1, 0.0), (2, 7.0)], "cell int, nee double")
    assert checks.run({"monthly": m, "hourly": sea}, ("7.1",)).first()["status"] == "PASS"
    assert checks.run({"monthly": m, "hourly": sea.withColumn("nee", F.col("nee") + 1e-9)}, ("7.1",)).first()["status"] == "FAIL"
    h = spark.createDataFrame([(0.0, -1.0), (5.0, -2.0)], "ssrd double, gpp double")
    assert checks.run({"hourly": h}, ("17.1",)).first()["status"] == "FAIL" and checks.run({"hourly": h.filter("ssrd > 0")}, ("17.1",)).first()["status"] == "PASS"


def test_registry_is_complete():
    wanted = "1.1 1.2 1.3 1.4 2.1 2.2 2.3 2.4 3.1 4.1 P2.0 5.1 5.2 5.3 6.1 6.2 7.1 7.2 7.3 7.4 8.1 8.2 8.3 9.1 9.2 10.1 11.1 11.2 12.1 12.2 13.1 13.2 14.1 14.2 14.3 15.1 15.2 15.3 16.1 16.2 16.3 16.4 17.1 17.2 17.3 18.1 18.2 19.1 19.2 19.3 19.4 20.1 20.2 21.1 21.2 22.1 23.1 23.2 23.3 24.1 24.2".split()
    assert set(wanted) <= set(checks.REGISTRY)


def test_binomial():
    assert binomial_p(7, 14) == 1.0 and binomial_p(0, 5) == pytest.approx(2 / 32)


def test_stream_upsert(spark, tmp_path):
    src, out, check = (str(tmp_path / x) for x in ("src", "out", "check"))
    schema = "cell int, ym int, v double, prio int"
    spark.createDataFrame([(1, 1, 5.0, 2), (2, 1, 6.0, 2)], schema).write.parquet(src)
    start = lambda: upsert(spark.readStream.schema(schema).parquet(src), out, ("cell", "ym"), "prio", check).awaitTermination(120)
    start()
    spark.createDataFrame([(1, 1, 7.0, 1), (3, 2, 8.0, 2)], schema).write.mode("append").parquet(src)
    start()
    assert sorted((r["cell"], r["ym"], r["v"]) for r in spark.read.parquet(out).collect()) == [(1, 1, 7.0), (2, 1, 6.0), (3, 2, 8.0)]


def test_partial_days_stream(spark, tmp_path):
    src = str(tmp_path / "h")
    spark.createDataFrame([("a", f"2024-01-01 {h:02d}:00:00", 1.0) for h in range(24)] + [("a", "2024-01-02 00:00:00", 2.0)], "cell string, ts string, value double").withColumn("ts", F.col("ts").cast("timestamp")).write.parquet(src)
    q = partial_days(spark.readStream.schema("cell string, ts timestamp, value double").parquet(src)).writeStream.format("memory").queryName("days").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert {str(r["day"]): r["provisional"] for r in spark.table("days").collect()} == {"2024-01-01": False, "2024-01-02": True}


def test_a_month_that_misses_its_mean_is_refused(spark):
    from gridloom.plans.diurnal import gated

    rows = [(1, 24000, 1.0, 2.0), (1, 24000, 3.0, 2.0), (2, 24000, 5.0, 5.0)]
    df = spark.createDataFrame(rows, "cell int, ym int, x double, mean double")
    assert sorted(map(tuple, gated(df, "x", "mean").collect())) == sorted(rows)
    with pytest.raises(Exception, match="month 24000 of cell 2 misses its mean"):
        gated(df.withColumn("mean", F.when(F.col("cell") == 2, 5.1).otherwise(F.col("mean"))), "x", "mean").collect()


def test_a_series_with_a_gap_is_refused(spark):
    df = spark.range(24000, 24012).select(F.col("id").cast("int").alias("ym"))
    assert lineage.series_gate(df, 24000, 24011).count() == 12 and len(lineage.series_gate(df, 24000, 24011).collect()) == 12
    with pytest.raises(Exception, match="11 of 12 months"):
        lineage.series_gate(df.filter("ym != 24003"), 24000, 24011).collect()


def test_copy_plan_leaves_nothing_to_copy(spark):
    remote = spark.createDataFrame([("a", "v1", 0, 5), ("a", "nrt", 1, 9), ("b", "nrt", 1, 3), ("c", "v1", 0, 4)], "file string, source string, priority int, mtime int")
    here = spark.createDataFrame([("a", 4), ("c", 4)], "file string, mtime int")
    plan = lineage.copy_plan(remote, here)
    assert sorted(map(tuple, plan.collect())) == [("a", "v1", 5, "newer"), ("b", "nrt", 3, "new")]
    assert [tuple(r) for r in lineage.copy_plan(remote, here, clobber=False).collect()] == [("b", "nrt", 3, "new")]
    after = here.join(plan, "file", "left_anti").unionByName(plan.select("file", "mtime"))
    assert lineage.copy_plan(remote, after).count() == 0


def test_schema_is_blessed_without_drift(spark, tmp_path):
    path = str(tmp_path / "schema")
    one = spark.createDataFrame([(1, "a")], "x int, y string")
    assert lineage.bless(spark, one, path) is None
    assert not any(lineage.bless(spark, one, path).values())
    drift = lineage.bless(spark, one.withColumn("x", F.col("x").cast("long")).drop("y").withColumn("z", F.lit(1)), path)
    assert drift == {"added": ["z"], "lost": ["y"], "retyped": ["x"]}
    assert not any(lineage.bless(spark, one, path).values())  # what drifted was not stored


def test_parity_of_outputs(spark):
    one = spark.createDataFrame([(1, 2.0, "a")], "x int, y double, z string")
    other = spark.createDataFrame([(1, 2.0)], "x long, y double").select("x", F.col("y").alias("y", metadata={"sign": "up"}), F.lit(1).alias("w"))
    assert lineage.parity(one, one) == []
    assert lineage.parity(one, other) == [("w", "right only"), ("z", "left only"), ("x", "type"), ("y", "attributes")]


def test_stored_fluxes_keep_their_signs(spark, tmp_path):
    from gridloom.sources.tables import SIGNS, layout, signs, write_flux

    rows = [(1, dt.datetime(2000, 1, 1), -1.0, 2.0, 1.0), (1, dt.datetime(2000, 2, 1), -3.0, 2.0, -1.0)]
    df = spark.createDataFrame(rows, "cell int, ts timestamp, gpp double, resp double, nee double")
    write_flux(df, str(tmp_path / "flux"))
    write_flux(df.filter("gpp = -1").withColumn("gpp", F.lit(-7.0)), str(tmp_path / "flux"))  # one month anew, the other stays
    back = spark.read.parquet(str(tmp_path / "flux"))
    assert signs(back) == SIGNS and sorted(r["gpp"] for r in back.collect()) == [-7.0, -3.0]
    assert [layout(F.lit(p)) is not None for p in ("/a/year=2001/month=02/x",)] == [True]
    paths = {"/a/year=2001/month=02/x.nc": "partitioned", "/a/2001/02/x.nc": "nested", "/a/2001/x.nc": "yearly", "/a/x200102.nc": "flat"}
    got = spark.createDataFrame([(p,) for p in paths], "p string").select("p", layout(F.col("p")).alias("l")).collect()
    assert {r["p"]: r["l"] for r in got} == paths


def test_months_in_text(spark):
    from gridloom.functions.calendar import chosen_months, month_of

    said = {"2001-02": 24013, " 200112 ": 24023, "2001-13": None, "2001": None, "x": None, "200100": None}
    got = spark.createDataFrame([(s,) for s in said], "s string").select("s", month_of(F.col("s")).alias("m")).collect()
    assert {r["s"]: r["m"] for r in got} == said
    df = spark.range(24000, 24024).select(F.col("id").alias("ym"))
    assert chosen_months(df, None).count() == 24 and chosen_months(df, " ").count() == 24
    assert [r["ym"] for r in chosen_months(df, "2000-01, 200112").orderBy("ym").collect()] == [24000, 24023]
    with pytest.raises(ValueError):
        chosen_months(df, "2000-00")


def test_binomial_expression(spark):
    from gridloom.plans.diagnostics import binomial, binomial_p

    pairs = [(k, n) for n in (1, 2, 9, 83) for k in (0, n // 3, n // 2, n)]
    got = spark.createDataFrame(pairs, "k int, n int").select("k", "n", binomial(F.col("k"), F.col("n")).alias("p")).collect()
    assert all(r["p"] == pytest.approx(binomial_p(r["k"], r["n"])) for r in got)


def test_samples_are_the_same_every_time(spark):
    df = spark.range(500).select(F.col("id").alias("k"), (F.col("id") % 3).alias("s"))
    one, two = (sorted(r["k"] for r in lineage.seeded_sample(df.repartition(p), "k", 0.1, 5, 40).collect()) for p in (1, 7))
    assert one == two and len(one) == 40
    assert lineage.seeded_sample(df, "k", 0.001, 5, 40).count() == 5 and lineage.seeded_sample(df.limit(0), "k", 0.1, 5, 40).count() == 0
    strata = lineage.stratified_sample(df, "k", "s", 4)
    assert sorted(r["count"] for r in strata.groupBy("s").count().collect()) == [4, 4, 4]
    assert {r["k"] for r in strata.collect()} == {r["k"] for r in lineage.stratified_sample(df.repartition(9), "k", "s", 4, parts=3).collect()}
