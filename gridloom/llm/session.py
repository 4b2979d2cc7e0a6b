"""Places and sizes that the operators ask of the running session."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import AbstractContextManager, contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: Used only where the session names no shared folder, as in local tests.
LOCAL_SHARED = "/tmp/checkpoints"
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Blocks of ``without`` that are broadcast at most: 32 MB, or 268 million rows where all blocks are full.
MOST_BLOCKS = 8192
BATCHES = {"spark.sql.execution.arrow.maxBytesPerBatch": "2m", "spark.sql.parquet.columnarReaderBatchSize": "512"}


def shared_dir(spark: SparkSession) -> str:
    """This application's place in the folder that driver and executors share: spark.checkpoint.dir, or a local one
    where that is unset and all runs on one machine. It goes when the application ends."""
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named and not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    place = f"{named or LOCAL_SHARED}/gridloom-{context.applicationId}"
    path = context._jvm.org.apache.hadoop.fs.Path(place)
    files = path.getFileSystem(context._jsc.hadoopConfiguration())
    files.mkdirs(path)
    files.deleteOnExit(path)
    return place


@contextmanager
def settings(spark: SparkSession, own: dict[str, str]) -> Iterator[None]:
    """Inside, the session has these settings as well; after it, what it had before."""
    before = {k: spark.conf.get(k, None) for k in own}
    for k, v in own.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def shuffles_cleaned(spark: SparkSession) -> AbstractContextManager[None]:
    """Inside, shuffle files go as soon as their query has ended, not when the driver collects garbage."""
    return settings(spark, {CLEANUP: "true"})


def small_batches(spark: SparkSession) -> AbstractContextManager[None]:
    """Inside, what is run holds few texts at once in the JVM: a batch for Python has some 2 MB whatever the rows' length
    (one row at least), not 10,000 rows, and a reader's batch 512 rows, not 4,096. All rows are read and sent."""
    return settings(spark, BATCHES)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    with shuffles_cleaned(spark):
        df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.gridloom_path = path
    return out


def release(*written: DataFrame) -> None:
    """Remove what ``materialize`` wrote for these frames, once all that reads them has been written as well."""
    for df in written:
        spark = df.sparkSession
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(df.gridloom_path)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def plan_bytes(df: DataFrame) -> int:
    """Bytes that Catalyst's statistics give for ``df`` (file sizes for a scan); runs no job."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def buckets_for(df: DataFrame, factor: float, target: int = 8 << 20) -> int:
    """Buckets so that ``factor`` times the bytes of ``df`` make about ``target`` bytes in each, however large ``df`` is;
    as many as shuffle partitions at least."""
    shuffle = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return min((1 << 31) - 1, max(4, shuffle, int(plan_bytes(df) * factor / target)))


def files_for(df: DataFrame, target: int = 64 << 20) -> int:
    """Tasks that write ``df``, so that a file has some ``target`` bytes, but two for each core at least."""
    return min((1 << 31) - 1, max(2 * df.sparkSession.sparkContext.defaultParallelism, plan_bytes(df) // target))


def fold(doc_id: Column) -> Column:
    """crc32(doc_id as text) mod 4; 2 is the held-out part."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)), F.lit(0))


def fresh(docs: DataFrame, name: str) -> str:
    """``name``, made longer until no column of ``docs`` has it."""
    while name.lower() in {c.lower() for c in docs.columns}:
        name += "_"
    return name


def numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a number for each row, written so that the numbers stay whatever is computed again, and the name of
    that column, which no column of ``docs`` has."""
    name = fresh(docs, "gridloom_row")
    return materialize(docs.withColumn(name, F.monotonically_increasing_id()), "numbered"), name


def without(rows: DataFrame, row: str, dropped: DataFrame, most_blocks: int = MOST_BLOCKS) -> DataFrame:
    """The rows whose number ``row`` is not in ``dropped``. Bits of the dropped numbers are broadcast, 4 KB for each 32,768
    numbers in a row that have one, so that no row of ``rows`` is shuffled; beyond ``most_blocks`` of them both sides are
    joined by number."""
    at, bits = fresh(rows, "gridloom_block"), fresh(rows, "gridloom_bits")
    block, place = F.bitmap_bucket_number(row), F.bitmap_bit_position(row)
    # Numbers are dealt by block before bits are made of them: a task that meets all blocks would send 4 KB for each.
    marks = dropped.withColumn(at, block).repartition(at).groupBy(at).agg(F.bitmap_construct_agg(place).alias(bits))
    marks = materialize(marks, "dropped")
    if marks.count() > most_blocks:
        return rows.join(dropped, row, "left_anti")
    byte = F.conv(F.hex(F.substring(F.col(bits), (place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    gone = F.getbit(byte, (place % 8).cast("int")) == 1
    return rows.withColumn(at, block).join(F.broadcast(marks), at, "left").filter(F.col(bits).isNull() | ~gone).select(*rows.columns)
