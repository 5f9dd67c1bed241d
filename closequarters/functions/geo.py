"""Geometry as native Spark column expressions (whole-stage codegen, no UDF)."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..params import DEFAULTS, METRES_PER_NM


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _sq(x: Column) -> Column:
    return x * x


def haversine_nm(lat1, lon1, lat2, lon2, earth_radius_nm: float = DEFAULTS.earth_radius_nm) -> Column:
    """Great-circle distance in nautical miles between two (lat, lon) points in degrees."""
    la1, la2 = F.radians(_col(lat1)), F.radians(_col(lat2))
    dlat = la2 - la1
    dlon = F.radians(_col(lon2)) - F.radians(_col(lon1))
    a = _sq(F.sin(dlat / 2.0)) + F.cos(la1) * F.cos(la2) * _sq(F.sin(dlon / 2.0))
    # near antipodes rounding can push a over 1; a null stays null (least() alone would skip it)
    return F.lit(2.0 * earth_radius_nm) * F.asin(F.sqrt(F.when(a > 1.0, F.lit(1.0)).otherwise(a)))


def nm_to_m(x: Column) -> Column:
    return x * F.lit(METRES_PER_NM)


def grid_cell(x, step_deg: float) -> Column:
    """Index of the uniform degree grid cell holding ``x`` (floor, so negatives work)."""
    return F.floor(_col(x) / F.lit(step_deg)).cast("int")
