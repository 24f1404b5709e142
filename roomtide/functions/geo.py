"""Distances on the sphere (mean earth radius; up to about 0.5 % off the ellipsoid)."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scalars import col

EARTH_M = 6_371_008.8
METRES_PER_DEGREE = EARTH_M * math.pi / 180


def haversine_m(lat1, lng1, lat2, lng2) -> Column:
    a, b = F.radians(col(lat1)), F.radians(col(lat2))
    dlat, dlng = (b - a) / 2, F.radians(col(lng2) - col(lng1)) / 2
    h = F.pow(F.sin(dlat), 2) + F.cos(a) * F.cos(b) * F.pow(F.sin(dlng), 2)
    return F.lit(2 * EARTH_M) * F.asin(F.least(F.lit(1.0), F.sqrt(h)))


def within_radius(df: DataFrame, lat: float, lng: float, radius_m: float) -> DataFrame:
    """Rows within `radius_m` of a point. The bounding box is a plain range on the coordinates,
    which the Parquet scan can use to skip row groups; the exact distance decides."""
    dlat = radius_m / METRES_PER_DEGREE * 1.001
    shrink = math.cos(math.radians(min(abs(lat) + dlat, 89.9)))
    dlng = dlat / shrink
    box = F.col("lat").between(lat - dlat, lat + dlat) & F.col("lng").between(lng - dlng, lng + dlng)
    return df.where(box).where(
        haversine_m(F.lit(lat), F.lit(lng), F.col("lat"), F.col("lng")) <= F.lit(float(radius_m))
    )
