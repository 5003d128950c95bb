"""World Cylindrical Equal Area (WGS84) as column arithmetic."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

# WGS84 semi-major axis in metres and reciprocal flattening.
SEMI_MAJOR = 6378137.0
RECIPROCAL_FLATTENING = 298.257223563

_FLATTENING = 1.0 / RECIPROCAL_FLATTENING
_E2 = _FLATTENING * (2.0 - _FLATTENING)
_E = math.sqrt(_E2)


def easting(lon: Column) -> Column:
    """Metres east of Greenwich."""
    return F.radians(lon) * SEMI_MAJOR


def northing(lat: Column) -> Column:
    """Metres north of the equator on the equal-area cylinder.

    Fails for a latitude beyond the poles: such a map is not in degrees.
    """
    s = F.sin(F.radians(lat))
    es = s * _E
    metres = (SEMI_MAJOR / 2.0 * (1.0 - _E2)) * (
        s / (F.lit(1.0) - es * es) - F.log((F.lit(1.0) - es) / (F.lit(1.0) + es)) / (2.0 * _E)
    )
    told = F.concat(F.lit("latitude beyond the poles, the map is not in degrees: "), lat.cast("string"))
    return F.when(F.abs(lat) > 90.0, F.raise_error(told).cast("double")).otherwise(metres)


def project_points(points: Column) -> Column:
    """ARRAY<STRUCT<lon,lat>> to ARRAY<STRUCT<x,y>> in metres."""
    return F.transform(
        points,
        lambda p: F.struct(easting(p["lon"]).alias("x"), northing(p["lat"]).alias("y")),
    )


def project_lonlat(lon: np.ndarray, lat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eastings and northings of arrays of degrees; the same rule for work on batches."""
    beyond = np.abs(lat) > 90.0
    if beyond.any():
        raise ValueError(f"latitude beyond the poles, the map is not in degrees: {lat[beyond][0]}")
    s = np.sin(np.radians(lat))
    es = s * _E
    curved = s / (1.0 - es * es) - np.log((1.0 - es) / (1.0 + es)) / (2.0 * _E)
    return np.radians(lon) * SEMI_MAJOR, (SEMI_MAJOR / 2.0 * (1.0 - _E2)) * curved


def rotated(ring: Column) -> Column:
    """The ring started at its second point: element i is the successor of point i."""
    return F.concat(
        F.slice(ring, F.lit(2), F.greatest(F.size(ring) - 1, F.lit(0))),
        F.slice(ring, F.lit(1), F.lit(1)),
    )


def twice_signed_area(ring: Column, successors: Column) -> Column:
    """Twice the signed area of an open ring ARRAY<STRUCT<x,y>> and its ``rotated`` form.

    Sums trapezoids, whose terms stay small for small rings far from the origin;
    the walk refers to nothing but its own elements, so it stays linear wherever
    the optimizer copies it.
    """
    strips = F.zip_with(ring, successors, lambda a, b: (a["x"] + b["x"]) * (b["y"] - a["y"]))
    return F.aggregate(strips, F.lit(0.0), lambda total, strip: total + strip)
