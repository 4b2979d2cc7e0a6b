"""netCDF files as a Spark data source, where a reader is installed."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Larger magnitudes stand for no value.
SENTINEL = 1e30
SCHEMA = "path string, t long, j int, i int, name string, value double"


class GridFiles(DataSource):
    """format("gridnc"): a row for each file, step, place and variable named by option ``vars``; sentinels and NaN are NULL."""

    @classmethod
    def name(cls) -> str:
        return "gridnc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return GridReader(self.options)


class GridReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.paths, self.names = options["paths"].split(","), options["vars"].split(",")

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(p) for p in self.paths]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        """A batch for each variable and step."""
        try:
            import netCDF4
        except ImportError as e:
            raise RuntimeError("reading netCDF needs the netCDF4 package; the canonical store is Parquet") from e

        with netCDF4.Dataset(partition.value) as f:
            for name in self.names:
                variable = f.variables[name]
                flat = len(variable.shape) == 2
                for t in range(1 if flat else variable.shape[0]):  # a step at a time, so a file is never held whole
                    yield step_batch(partition.value, t, name, variable[:] if flat else variable[t])


def step_batch(path: str, t: int, name: str, grid: np.ndarray) -> pa.RecordBatch:
    """Rows of SCHEMA for one step of one variable."""
    x = np.ma.filled(np.ma.asarray(grid).astype("float64"), np.nan)
    with np.errstate(invalid="ignore"):
        gone = ~np.isfinite(x) | (np.abs(x) > SENTINEL)
    j, i = np.indices(x.shape, dtype=np.int32)
    n = x.size
    columns = [pa.array([path]).take(pa.array(np.zeros(n, np.int32))), pa.array(np.full(n, t)), pa.array(j.ravel()), pa.array(i.ravel()), pa.array([name]).take(pa.array(np.zeros(n, np.int32))), pa.array(x.ravel(), mask=gone.ravel())]
    return pa.RecordBatch.from_arrays(columns, ["path", "t", "j", "i", "name", "value"])


def register(spark) -> None:
    spark.dataSource.register(GridFiles)
