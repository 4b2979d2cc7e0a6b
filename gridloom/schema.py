"""Canonical tables and constants.

Long tables keyed by ``cell_id`` (= j * 360 + i on the one-degree grid) and time; one row of ``grid`` describes a
cell. Months are numbers, year * 12 + month - 1, so spans and neighbours are plain arithmetic. Times are days or
seconds since 1970 in UTC; values are doubles, with NULL for what is missing.
"""

from __future__ import annotations

#: Radii in use (m), molar mass of carbon, sentinel bound, land threshold, year length (s).
RADIUS_INGEST = 6371007.2
RADIUS_BUDGET = 6371000.0
GC_PER_MOL = 12.011
GC_PER_MOL_PIPELINE = 12.0
SENTINEL = 1e30
LAND = 1e-15
SECONDS_PER_DAY = 86400.0

GRID = "cell_id int, i int, j int, lon double, lat double, area_m2 double, coslat double"
MONTHLY = "cell_id int, ym int, npp double, rh double"
FIT = "cell_id int, piece int, t0 double, h double, u double, a double, b double, c double"
METEO = "cell_id int, ts timestamp_ntz, src string, ssrd double, t2m double, stl1 double, swvl1 double"
MANIFEST = ("timestamp", "step", "status", "host", "commit", "elapsed_s", "detail")
CHECK = "check_id string, name string, status string, detail string"
