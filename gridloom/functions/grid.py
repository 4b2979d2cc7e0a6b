"""The regular grid: cells, areas, bands, blocks."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from gridloom.schema import RADIUS_BUDGET, RADIUS_INGEST

#: Overlapping bands, as predicates on latitude.
BANDS = {"global": (-90.0, 90.0), "nh": (0.0, 90.0), "sh": (-90.0, 0.0), "trop": (-23.5, 23.5), "boreal": (50.0, 90.0), "nh_mid": (23.5, 50.0), "sh_mid": (-50.0, -23.5), "polar_n": (66.5, 90.0), "polar_s": (-90.0, -66.5)}


def cell_id(lon: Column, lat: Column, nlon: int = 360, nlat: int = 180) -> Column:
    """The cell that holds a point: 0 at the south-west corner, rows from the south."""
    i = F.pmod(F.floor((lon + 180) * nlon / 360), F.lit(nlon))
    j = F.least(F.floor((lat + 90) * nlat / 180), F.lit(nlat - 1))
    return (j * nlon + i).cast("int")


def cell_area(south: Column, north: Column, dlon: float, radius: float = RADIUS_BUDGET) -> Column:
    """Area between two parallels over ``dlon`` degrees (Archimedes)."""
    return (F.sin(F.radians(north)) - F.sin(F.radians(south))) * math.radians(dlon) * radius * radius


def checked_area(south: Column, north: Column, dlon: float, radius: float = RADIUS_INGEST) -> Column:
    """cell_area that refuses parallels out of order or range."""
    good = (south < north) & (south >= -90) & (north <= 90)
    return F.when(good, cell_area(south, north, dlon, radius)).otherwise(F.raise_error(F.lit("parallels out of order or range")).cast("double"))


def grid(spark: SparkSession, nlon: int = 360, nlat: int = 180, radius: float = RADIUS_BUDGET) -> DataFrame:
    """One row for each cell: a dimension of fixed size, small enough to broadcast."""
    j, i = F.floor(F.col("id") / nlon), F.col("id") % nlon
    dlat, dlon = 180 / nlat, 360 / nlon
    south = -90 + j * dlat
    return spark.range(nlon * nlat).select(
        F.col("id").cast("int").alias("cell_id"), i.cast("int").alias("i"), j.cast("int").alias("j"), (-180 + (i + 0.5) * dlon).alias("lon"), (south + dlat / 2).alias("lat"),
        cell_area(south, south + dlat, dlon, radius).alias("area_m2"), coslat(south + dlat / 2).alias("coslat"),
    )


def latitude_area(spark: SparkSession, nlat: int = 1800, dlon: float = 0.1, radius: float = RADIUS_INGEST) -> DataFrame:
    """Cell area for each row of a fine grid."""
    south = -90 + F.col("id") * (180 / nlat)
    return spark.range(nlat).select(F.col("id").cast("int").alias("j"), checked_area(south, south + 180 / nlat, dlon, radius).alias("area_m2"))


def regrid(fine: DataFrame, value: str, factor_i: int, factor_j: int, weight: str = "area_m2", keys: tuple[str, ...] = ()) -> DataFrame:
    """Block mean weighted by area over what is present; NULL where a block has nothing."""
    x, w = F.col(value), F.col(weight)
    return fine.groupBy(*keys, F.floor(F.col("i") / factor_i).cast("int").alias("i"), F.floor(F.col("j") / factor_j).cast("int").alias("j")).agg(F.try_divide(F.sum(w * x), F.sum(F.when(x.isNotNull(), w))).alias(value))


def coslat(lat: Column) -> Column:
    return F.greatest(F.cos(F.radians(lat)), F.lit(0.0))


def in_band(lat: Column, band: str) -> Column:
    low, high = BANDS[band]
    return (lat >= low) & (lat < high) if high < 90 else (lat >= low)


def disjoint_band(lat: Column, edges: tuple[float, ...] = (30.0, 60.0)) -> Column:
    """Band number by distance from the equator: 0 below the first edge."""
    out = F.lit(0)
    for k, e in enumerate(edges, 1):
        out = F.when(F.abs(lat) >= e, k).otherwise(out)
    return out


def block_id(i: Column, j: Column, size: int = 10) -> Column:
    return (F.floor(i / size) * 1000 + F.floor(j / size)).cast("int")


def nearest(cells: DataFrame, lon: float, lat: float) -> DataFrame:
    """The cell whose centre is nearest in longitude among those nearest in latitude."""
    return cells.select(F.min_by(F.struct(*cells.columns), F.struct(F.abs(F.col("lat") - lat), F.abs(F.col("lon") - lon), F.col("cell_id"))).alias("cell")).select("cell.*")
