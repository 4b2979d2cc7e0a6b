"""Partial days and late supersession as streams."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from gridloom.operators.series import supersede


def partial_days(hours: DataFrame, late: str = "2 days") -> DataFrame:
    """Daily means with the number of hours they rest on; a day is final once the watermark has passed it."""
    return hours.withWatermark("ts", late).groupBy("cell", F.window("ts", "1 day")).agg(F.avg("value").alias("mean"), F.count("*").alias("n_hours")).select("cell", F.to_date("window.start").alias("day"), "mean", "n_hours", (F.col("n_hours") < 24).alias("provisional"))


def upsert(incoming: DataFrame, path: str, keys: tuple[str, ...], priority: str, checkpoint: str) -> StreamingQuery:
    """Keep, by key, the row of least priority number of all that has come: each batch rewrites the months it touches.

    The table is partitioned by ym; a batch that runs again gives the same table.
    """

    def merge(batch: DataFrame, epoch: int) -> None:
        spark: SparkSession = batch.sparkSession
        months = [r["ym"] for r in batch.select("ym").distinct().collect()]  # months of one batch
        try:
            both = spark.read.schema(batch.schema).parquet(path).filter(F.col("ym").isin(months)).unionByName(batch)
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            both = batch
        staged = f"{checkpoint}/staged/{epoch}"  # a table is not overwritten while it is read
        supersede(both, keys, priority).write.mode("overwrite").parquet(staged)
        spark.read.schema(batch.schema).parquet(staged).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("ym").parquet(path)

    return incoming.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
