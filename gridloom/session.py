"""Session defaults: UTC, ANSI, adaptive plans, Arrow."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def session(app: str = "gridloom", **more: str) -> SparkSession:
    """A session with the defaults; ``more`` overrides them (dots as double underscores)."""
    builder = SparkSession.builder.appName(app)
    for k, v in (DEFAULTS | {k.replace("__", "."): v for k, v in more.items()}).items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the folder that driver and executors share (spark.checkpoint.dir; unset, a local one, on one machine
    only). It goes when the application ends."""
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named and not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    path = f"{named or '/tmp/checkpoints'}/{name}-{uuid.uuid4().hex}"
    place = context._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(context._jsc.hadoopConfiguration()).deleteOnExit(place)
    return path


@contextmanager
def keeping(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """Gives keep(df, name): writes a table to the shared folder and reads it back. Inside, shuffle files go as soon as
    their query has ended, not when the driver collects garbage, and tables dealt alike by some of a join's keys are
    joined as they lie; what was kept goes at the end."""
    own, paths = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.requireAllClusterKeysForCoPartition": "false"}, []
    before = {k: spark.conf.get(k, None) for k in own}
    for k, v in own.items():
        spark.conf.set(k, v)

    def keep(df: DataFrame, name: str) -> DataFrame:
        paths.append(scratch(spark, name))
        df.write.option("compression", "zstd").parquet(paths[-1])
        return spark.read.schema(df.schema).parquet(paths[-1])

    try:
        yield keep
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
        for p in paths:
            place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p)
            place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
